"""Chat formatting in budgeted windows.

Prefix sums of turn tokens choose spans of whole turns: a span holds the turns that
begin in the same stretch of ``budget`` tokens and end in it, and a turn that crosses
the end of a stretch is a span of its own. A window is a span with what a model needs
to read it: the conversation's system turn and a few turns from before the span, both
repeated from earlier windows. The loss mask covers the assistant turns of the span,
not the repeated ones, so every target counts once.

Turns are dealt by range of (conversation, turn), so a long conversation spans tasks.
Sums are taken inside a task, then over the tasks' totals; a window is bounded by its
budget, or by one turn longer than it.

Each turn reads ``[INST]role[/INST]text</s>``. Control strings inside a role or text get
a backslash after their first character, and backslashes are doubled, so a mark in the
output is always a mark and the original comes back exactly.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tallyguard.llm.common import stage
from tallyguard.llm.encoders import encoder

# The control strings of the template and of the models it is for.
OPEN, MIDDLE, CLOSE = "[INST]", "[/INST]", "</s>"
CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>")
_ESCAPE = re.compile("|".join([r"\\", *map(re.escape, CONTROLS)]))
_UNESCAPE = re.compile(r"\\(.)", re.S)

BUDGET = 1024       # tokens of a span, marks included
HISTORY = 2         # turns repeated before a span
HISTORY_TOKENS = 256  # a turn longer than this isn't repeated
MARKS = 8           # tokens that the marks of a turn count as
TARGET, SYSTEM = "assistant", "system"


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _UNESCAPE.sub(r"\1", text)


def format_turns(turns: list[tuple[str, str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of (role, text, is_target) turns, and the (start, end) code points under the loss mask."""
    parts, spans, at = [], [], 0
    for role, text, target in turns:
        head, body = f"{OPEN}{escape(role)}{MIDDLE}", escape(text)
        parts += [head, body, CLOSE]
        if target:
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def parse_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted text."""
    turns = []
    for part in text.split(CLOSE)[:-1]:
        head, body = part[len(OPEN):].split(MIDDLE, 1)
        turns.append((unescape(head), unescape(body)))
    return turns


def _numbered(turns: DataFrame, tokenizer: str) -> DataFrame:
    """(conv_id, role, text, tokens, idx, before): the turn's place in its conversation and the tokens before it.

    Turns are ordered by turn, nulls first, then by where they stand in the input.
    """
    def run(batches):
        encode, conv, idx, before = encoder(tokenizer).encode, object(), 0, 0
        for batch in batches:
            rows = []
            for c, text in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if c != conv:
                    conv, idx, before = c, 0, 0
                tokens = len(encode(text)) // 4 + MARKS
                rows.append((tokens, idx, before))
                idx, before = idx + 1, before + tokens
            extra = [pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "tokens", "idx", "before"])

    spark = turns.sparkSession
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(n, "conv_id", "turn", "row").sortWithinPartitions("conv_id", "turn", "row")
    inside = stage(dealt.select(F.spark_partition_id().alias("part"), "conv_id", "role", "text").mapInArrow(
        run, "part int, conv_id long, role string, text string, tokens long, idx long, before long"), "turns")
    zero = F.lit(0).cast("long")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per task
    totals = inside.groupBy("conv_id", "part").agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n"))
    totals = totals.select(F.col("conv_id").alias("c"), F.col("part").alias("p"), F.coalesce(F.sum("t").over(earlier), zero).alias("t"),
                           F.coalesce(F.sum("n").over(earlier), zero).alias("n"))
    return inside.join(totals, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).select(
        "conv_id", "role", "text", "tokens", (F.col("idx") + F.col("n")).alias("idx"), (F.col("before") + F.col("t")).alias("before"))


def _formatted(batches):
    for batch in batches:
        out = [[], [], [], []]
        for turns in batch.column(2).to_pylist():
            turns.sort(key=lambda t: t["idx"])
            text, spans = format_turns([(t["role"], t["text"], t["role"] == TARGET and not t["repeated"]) for t in turns])
            out[0].append(sum(t["repeated"] for t in turns))
            out[1].append(text)
            out[2].append([a for a, _ in spans])
            out[3].append([b for _, b in spans])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(out[0], pa.int32()), pa.array(out[1], pa.string()),
             pa.array(out[2], pa.list_(pa.int32())), pa.array(out[3], pa.list_(pa.int32()))],
            ["conv_id", "span", "repeated", "text", "loss_starts", "loss_ends"])


def windows(turns: DataFrame, tokenizer: str, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, span, repeated, text, loss_starts, loss_ends): the formatted windows of every conversation.

    ``turns`` has conv_id, turn, role and text; a null role or text is empty, rows of a null conv_id are
    one conversation, repeated rows are turns of their own, other columns are not read. ``repeated``
    counts the turns at the window's start that earlier windows hold already. Masked spans are code points of ``text``.
    """
    numbered = stage(_numbered(turns, tokenizer), "numbered-turns")
    stretch = F.floor(F.col("before") / budget)
    crosses = F.floor((F.col("before") + F.col("tokens") - 1) / budget) > stretch
    own = numbered.withColumn("span", 2 * stretch + crosses.cast("long"))
    first = own.groupBy("conv_id", "span").agg(F.min("idx").alias("first")).where("first > 0")
    wanted = first.select(F.col("conv_id").alias("c"), "span", "first", F.explode(F.array_distinct(F.concat(
        F.array(F.lit(0).cast("long")),
        F.sequence(F.greatest(F.lit(0).cast("long"), F.col("first") - history), F.col("first") - 1)))).alias("want"))
    near = (F.col("idx") >= F.col("first") - history) & (F.col("tokens") <= HISTORY_TOKENS)
    repeated = numbered.join(wanted, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("idx") == F.col("want"))).where(
        near | ((F.col("idx") == 0) & (F.col("role") == SYSTEM)))
    turn = lambda again: F.struct("idx", F.lit(again).alias("repeated"), "role", "text").alias("t")
    rows = own.select("conv_id", "span", turn(False)).unionByName(repeated.select("conv_id", "span", turn(True)))
    # at most budget / MARKS turns, and those repeated
    grouped = rows.groupBy("conv_id", "span").agg(F.collect_list("t").alias("turns"))
    return grouped.mapInArrow(_formatted, "conv_id long, span long, repeated int, text string, "
                                          "loss_starts array<int>, loss_ends array<int>")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars) from the windows alone.

    The digests run over a conversation's windows in order, one window in memory at a time.
    """
    def digests(batches):
        conv, state = None, None

        def row():
            return (conv, state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for batch in batches:
            done = []
            for c, repeated, text, starts, ends in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if state is None or c != conv:
                    if state is not None:
                        done.append(row())
                    conv, state = c, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                for role, said in parse_turns(text)[repeated:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                for a, b in zip(starts, ends):
                    said = unescape(text[a:b])
                    state[2] += len(said)
                    state[3].update(said.encode("utf-8", "surrogatepass"))
                state[4] += len(text)
            yield table(done)
        yield table([row()] if state is not None else [])

    kinds = [("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
             ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())]

    def table(rows):
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(columns, kinds)], [n for n, _ in kinds])

    n = int(formatted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = formatted.repartition(n, "conv_id").sortWithinPartitions("conv_id", "span")
    return ordered.select("conv_id", "repeated", "text", "loss_starts", "loss_ends").mapInArrow(
        digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
