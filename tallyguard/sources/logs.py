"""Text sources: structured logs and metric exposition lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tallyguard import schemas

# Keys of an error line that have their own columns.
ERROR_KEYS = ("error_type", "error_message", "timestamp", "exception_type", "exception_details")


def json_rows(lines: DataFrame, schema: str) -> DataFrame:
    """The fields of JSON ``value``s, and ``_corrupt`` for a value that doesn't fit.

    The generator keeps filters on the fields from parsing the value again.
    """
    parsed = F.from_json("value", f"{schema}, {schemas.CORRUPT} string",
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": schemas.CORRUPT})
    return lines.select(F.inline(F.array(parsed)))


def scan_access_log(lines: DataFrame) -> DataFrame:
    """JSON request lines as typed rows; an unreadable line is kept in ``_corrupt``."""
    return json_rows(lines, schemas.ACCESS_LOG)


def scan_error_log(lines: DataFrame) -> DataFrame:
    """JSON error lines: known keys as columns, all other keys in the ``context`` map."""
    keyed = lines.select("value", F.explode(F.array(F.from_json("value", "map<string,string>"))).alias("_row"))
    known = F.array(*[F.lit(k) for k in ERROR_KEYS])
    context = F.map_filter("_row", lambda k, v: ~F.array_contains(known, k))
    return keyed.select(
        *[F.try_element_at("_row", F.lit(k)).alias(k) for k in ERROR_KEYS if k != "timestamp"],
        F.try_to_timestamp(F.try_element_at("_row", F.lit("timestamp"))).alias("timestamp"),
        context.alias("context"),
        F.when(F.col("_row").isNull(), F.col("value")).alias(schemas.CORRUPT))


# name, labels in braces, value, the sample's own time in milliseconds, perhaps an exemplar
SAMPLE_LINE = (r'^\s*([a-zA-Z_:][a-zA-Z0-9_:]*)\s*(?:\{((?:[^"}]|"(?:[^"\\]|\\.)*")*)\})?\s+(\S+)'
               r'(?:\s+(-?\d+))?(?:\s+#.*)?\s*$')
LABEL = r'([a-zA-Z_][a-zA-Z0-9_]*)\s*=\s*"((?:[^"\\]|\\.)*)"'
CUT = "\u0001"


def _replaced(found: str, wanted: str):
    return lambda text: F.replace(text, F.lit(found), F.lit(wanted))


def parse_exposition(lines: DataFrame, scraped_at: str | None = None) -> DataFrame:
    """Scrape text as (name, labels, value, ts, _corrupt); comments and blank lines are skipped.

    ``ts`` is a line's own time, or else the column ``scraped_at``. Escapes in label values are
    undone. A line that can't be read, or that repeats a label, is kept in ``_corrupt``. A line is
    matched once: the match is rewritten with separators, which a line that doesn't match lacks,
    and the generator keeps its parts from being matched again.
    """
    text = F.trim("value")
    parts = F.split(F.regexp_replace("value", SAMPLE_LINE, f"$1{CUT}$2{CUT}$3{CUT}$4"), CUT)
    seen = F.col(scraped_at).cast("timestamp") if scraped_at else F.lit(None).cast("timestamp")
    matched = (lines.filter((text != "") & ~text.startswith("#"))
               .select("value", seen.alias("_seen"), F.explode(F.array(parts)).alias("_p"))
               .select("value", "_seen", F.when(F.size("_p") == 4, F.col("_p")).alias("_p")))
    plain = F.col("_p")
    number = F.regexp_replace(plain[2], "Inf$", "Infinity").try_cast("double")
    whole = F.regexp_extract_all(plain[1], F.lit(LABEL), F.lit(2))
    for found, wanted in (("\\\\", CUT), ('\\"', '"'), ("\\n", "\n"), (CUT, "\\")):
        whole = F.transform(whole, _replaced(found, wanted))
    read = matched.select("value", "_seen", "_p", number.alias("_number"), whole.alias("_values"),
                          F.regexp_extract_all(plain[1], F.lit(LABEL), F.lit(1)).alias("_names"))
    good = F.coalesce(F.col("_number").isNotNull() & (F.size("_names") == F.size(F.array_distinct("_names"))), F.lit(False))
    own = F.timestamp_millis(F.nullif(plain[3], F.lit("")).try_cast("long"))
    return read.select(
        F.when(good, plain[0]).alias("name"), F.when(good, F.map_from_arrays("_names", "_values")).alias("labels"),
        F.when(good, F.col("_number")).alias("value"), F.when(good, F.coalesce(own, "_seen")).alias("ts"),
        F.when(~good, F.col("value")).alias(schemas.CORRUPT))
