"""Quality rules by cross-document line frequency, in DataFrame functions only.

A document first has to pass two rules on its own text (enough words, few
repeated 3-word windows). Then every line is normalised and hashed, the distinct
documents that hold it are counted per host, and lines above the limit are
removed; a document of which too little is left, by its own share or for the rule
on words, is depleted and rejected.

Scale: the text is read once, into a slim written table (counts and 8-byte line
hashes). Distinct documents are counted by text digest, so a thousand exact
copies count as one, and the count is two partial aggregations: a line that is in
a third of all documents costs each map task one row. Of the texts that share a
line above the limit the one with the smallest id keeps it, so shared content never
vanishes from the corpus. A text that stands in several hosts loses what any of them
removes, so that equal texts stay equal. What is removed is found where lines above a
limit are: texts move nowhere.

Exactness: lines and texts are told apart by 64-bit hashes.

Defined results: a null or empty text has no words and fails the base rules; a
null host is a host of its own; repeated rows each get their verdict; columns
besides the three named ones are ignored, whatever their names; an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh import scratch
from quillmesh.llm import _text

#: Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class LineLimits:
    """A line is above the limit in a host if over ``min_docs`` distinct documents hold it, or over ``least`` and
    ``host_share`` of the host's distinct documents; a document is depleted if under ``min_left`` of its words, or fewer
    than MIN_WORDS, are left."""

    min_docs: int = 20
    host_share: float = 0.05
    least: int = 3
    min_left: float = 0.3


def _base(docs: DataFrame, doc_id: str, text: str, host: str, row: Column) -> DataFrame:
    """One row per document: its counts and its lines as (hash, words); projections only, no shuffle."""
    whole = _text.whole(F.col(text))
    d = docs.select(row.alias("row"), F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), whole.alias("text"))
    d = d.select(
        "*",
        _text.words(F.col("text")).alias("w"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(_text.WORD)).alias("lines"),
    )
    size = F.size("w")
    d = d.select(
        "row",
        "doc_id",
        "host",
        F.xxhash64("text", F.length("text")).alias("text_key"),
        size.cast("long").alias("n_words"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _lines(F.col("lines")).alias("lines"),
        "w",
        F.when(size >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), size - 3), _window))).alias("sorted"),
    )
    # windows of one hash stand side by side once sorted; they are equal if their words are
    m = F.greatest(F.size("sorted") - 1, F.lit(0))
    beside = F.arrays_zip(F.slice("sorted", F.lit(1), m).alias("x"), F.slice("sorted", F.lit(2), m).alias("y"))
    alike = F.filter(beside, lambda p: p["x"]["h"] == p["y"]["h"])
    same = F.filter(alike, lambda p: _word(p["x"], 0).eqNullSafe(_word(p["y"], 0)) & (_word(p["x"], 1) == _word(p["y"], 1)) & (_word(p["x"], 2) == _word(p["y"], 2)))
    d = d.withColumn("same", same).drop("sorted", "w")
    at = F.flatten(F.transform("same", lambda p: F.array(*[p[k]["at"] + i for k in ("x", "y") for i in range(3)])))
    return d.withColumn("n_repeat_words", F.coalesce(F.size(F.array_distinct(at)), F.lit(0)).cast("long")).drop("same")


def _window(k: Column) -> Column:
    """The window of three words from place ``k`` on: its hash and place."""
    return F.struct(F.xxhash64(*[F.get("w", k + i) for i in range(3)]).alias("h"), k.alias("at"))


def _word(window: Column, i: int) -> Column:
    return F.get("w", window["at"] + i)


def _normalised(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")))


def _lines(lines: Column) -> Column:
    """Every line of a document as the hash of its normalised form and its number of words."""
    return F.transform(
        lines, lambda x: F.struct(F.xxhash64(_normalised(x)).alias("line"), F.regexp_count(x, F.lit(_text.WORD)).alias("words"))
    )


def quality_rules(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    host: str = "source",
    limits: LineLimits = LineLimits(),
    row: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: row, doc_id, n_words, the base counts, base_failed, removed_words, kept. ``row`` names
    a column that tells rows apart; without one, rows are numbered."""
    return _judged(docs, doc_id, text, host, limits, row)[0]


def _judged(docs: DataFrame, doc_id: str, text: str, host: str, limits: LineLimits, row: str | None) -> tuple[DataFrame, DataFrame]:
    """(verdicts, removed lines): the lines have row, line and words, one row per line that goes."""
    base = _base(docs, doc_id, text, host, F.col(row) if row else F.monotonically_increasing_id())
    slim = scratch.table(base, "quality-base")

    held = slim.select("row", "doc_id", "host", "text_key", F.explode("lines").alias("l")).select(
        "row", "doc_id", "host", "text_key", "l.line", "l.words"
    )
    by_text = held.groupBy("host", "line", "text_key").agg(F.min("doc_id").alias("first_id"))
    earliest = F.struct(F.col("first_id").isNull(), "first_id", "text_key")
    spread = by_text.groupBy("host", "line").agg(F.count("*").alias("n"), F.min(earliest).alias("first"))
    of_host = slim.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    many = (F.col("n") > limits.min_docs) | (F.col("n") > F.lit(limits.host_share) * F.col("host_docs"))
    above = (
        spread.filter(F.col("n") > min(limits.least, limits.min_docs))
        .join(of_host.select(F.col("host").alias("h"), "host_docs"), F.col("host").eqNullSafe(F.col("h")))
        .filter(many)
        .select(F.col("host").alias("above_host"), F.col("line").alias("above_line"), F.col("first.text_key").alias("first_key"))
    )
    above = scratch.bounded(scratch.table(above, "quality-lines"))

    off = (
        held.join(above, (F.col("line") == F.col("above_line")) & F.col("host").eqNullSafe(F.col("above_host")))
        .filter(F.col("text_key") != F.col("first_key"))
        .select(F.col("text_key").alias("off_text"), F.col("line").alias("off_line"))
        .distinct()
    )
    off = scratch.bounded(scratch.table(off, "quality-off"))
    gone = held.join(off, (F.col("text_key") == F.col("off_text")) & (F.col("line") == F.col("off_line"))).select("row", "line", "words")
    removed = gone.groupBy(F.col("row").alias("removed_row")).agg(F.sum("words").cast("long").alias("removed"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    verdicts = (
        slim.drop("lines")
        .join(removed, F.col("row") == F.col("removed_row"), "left")
        .withColumn("removed_words", F.coalesce("removed", F.lit(0).cast("long")))
        .select(
            "row",
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            "n_dup_lines",
            "n_repeat_words",
            failed.alias("base_failed"),
            "removed_words",
            (~failed & (left >= F.lit(limits.min_left) * F.col("n_words")) & (left >= MIN_WORDS)).alias("kept"),
        )
    )
    return verdicts, gone


def cleaned(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source", limits: LineLimits = LineLimits()) -> DataFrame:
    """The rows of ``docs`` that pass, with the columns of ``docs`` and their texts without the lines that are removed."""
    row, of, lines, off = (scratch.free_name(f"__qm_{x}", docs) for x in ("row", "of", "lines", "off"))
    located = scratch.with_row_locator(docs, row)
    verdicts, gone = _judged(located, doc_id, text, host, limits, row)
    rejected = scratch.bounded(scratch.table(verdicts.filter("not kept").select(F.col("row").alias(off)), "quality-gone"))
    stay = located.join(rejected, F.col(row) == F.col(off), "left_anti")
    removed = scratch.table(gone.groupBy(F.col("row").alias(of)).agg(F.collect_set("line").alias(lines)), "quality-removed")
    stay = stay.join(scratch.bounded(removed), F.col(row) == F.col(of), "left")
    left = F.filter(
        F.split(_text.whole(F.col(f"`{text}`")), "\n"),
        lambda x: ~(x.rlike(_text.WORD) & F.array_contains(lines, F.xxhash64(_normalised(x)))),
    )
    kept = F.when(F.col(lines).isNull(), F.col(f"`{text}`")).otherwise(F.array_join(left, "\n")).alias(text)
    return stay.select(*[kept if c == text else F.col(f"`{c}`") for c in docs.columns])
