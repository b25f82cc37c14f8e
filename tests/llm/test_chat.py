import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, strategies as st

from tallyguard.llm import chat

BYTE = public_tokenizers.path("byte_bpe_50k.json")
TRICKY = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "<", "\\<", "[", "<\\/s>", "a", "\n", "<<SYS>>", "😀"]


@given(st.lists(st.sampled_from(TRICKY), max_size=12).map("".join))
def test_escape_is_reversible_and_leaves_no_control_string(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROLS)


@given(st.lists(st.tuples(st.lists(st.sampled_from(TRICKY), max_size=3).map("".join),
                          st.lists(st.sampled_from(TRICKY), max_size=8).map("".join), st.booleans()), max_size=5))
def test_formatted_turns_parse_back(turns):
    text, spans = chat.format_turns(turns)
    assert chat.parse_turns(text) == [t[:2] for t in turns]
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t[1] for t in turns if t[2]]


def conversations(seed=3):
    rng, rows = random.Random(seed), []
    for c in range(25):
        for turn in range(rng.choice([1, 2, 5, 30])):
            role = "system" if turn == 0 and c % 3 == 0 else rng.choice(["user", "assistant", "tool"])
            rows.append((c, turn, role, "".join(rng.choice([" and", " x", "é", *TRICKY]) for _ in range(rng.choice([0, 3, 60])))))
    rows += [(50, i, "assistant", "word " * 9) for i in range(1500)]  # one with a third of all rows and more
    rows += [(60, 0, "user", "long " * 4000), (60, 1, "assistant", "more " * 4000), (61, 3, None, None), (61, None, "assistant", None),
             (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (62, 1, "assistant", "same"), (62, 1, "assistant", "same")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string, idx string, span string, tokens string"


@pytest.fixture(scope="module")
def turns(spark):
    # one partition: turns of equal number keep the order of the list
    return spark.createDataFrame([(*r, "i", "s", "t") for r in conversations()], SCHEMA).coalesce(1).cache()


@pytest.mark.parametrize("budget,history", [(1024, 2), (100, 2), (100, 0), (40, 5)])
def test_read_back_equals_the_turns(turns, budget, history):
    made = chat.windows(turns, BYTE, budget, history)
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    rows = conversations()
    for c in {r[0] for r in rows}:
        own = sorted([r for r in rows if r[0] == c], key=lambda r: (r[1] is not None, r[1] or 0))
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        assert (got[c].n_turns, got[c].turns_sha256) == (len(own), digest)
        assert (got[c].loss_chars, got[c].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert len(got) == len({r[0] for r in rows})


def test_windows_keep_the_budget_the_system_turn_and_history(turns):
    made = chat.windows(turns, BYTE, 100, 2).collect()
    from tallyguard.llm.encoders import Encoder
    encode = Encoder(BYTE).encode
    rows = conversations()
    for w in made:
        parsed = chat.parse_turns(w.text)
        own = parsed[w.repeated:]
        tokens = [len(encode(t)) // 4 + chat.MARKS for _, t in own]
        assert own and (sum(tokens) <= 100 or len(own) == 1)
        first = next(((r[2], r[3]) for r in rows if r[0] == w.conv_id and r[1] == 0), None)
        if first and first[0] == "system":
            assert parsed[0] == first
        targets = [t for r, t in own if r == "assistant"]
        assert [chat.unescape(w.text[a:b]) for a, b in zip(w.loss_starts, w.loss_ends)] == targets
    assert any(w.repeated > 1 for w in made)


def test_empty_table(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert chat.read_back(chat.windows(none, BYTE)).collect() == []
