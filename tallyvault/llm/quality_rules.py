"""Quality rules per document, and boilerplate by cross-document line frequency per host.

One pass over the texts writes, per row, its base counts and a (hash, words) pair for each
line; everything after that works on this small table.  A line is boilerplate on a host when
it stands in at least ``min_docs`` different texts of the host (copies of one text count
once), whatever the host's size; ``min_share`` may ask for a percentage of them besides.
Boilerplate lines are taken out of the count; a document left with under ``keep_percent``
percent of its words is depleted.

Defined results: a null or empty text has no words and fails the base rule; a null host
(``source``) is a host of its own; repeated rows are judged alike; an empty table gives an
empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, ascii_lower, packed, stored, whole_text, words

MIN_DOCS = 20
MIN_SHARE = 0
KEEP_PERCENT = 30
SYMBOLS = "#*$%&|<>"


def packed_windows(w: Column, shift: Column) -> Column:
    """Every 3-word window of ``w`` as one long: hash bits above ``shift``, its position below."""
    def window(i: Column) -> Column:
        h = F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
        top = F.call_function("shiftleft", F.call_function("shiftright", h, shift), shift)
        return top.bitwiseOR(i.cast("long"))

    return F.when(F.size(w) >= 4, F.transform(F.sequence(F.lit(0), F.size(w) - 3), window)).otherwise(
        F.array().cast("array<bigint>"))


def _neighbours(col: str, pair) -> Column:
    """``pair(x, next x)`` for every element of the array (the last one meets null)."""
    return F.zip_with(col, F.expr(f"slice({col}, 2, greatest(size({col}) - 1, 0))"), pair)


def agreeing_pairs(sorted_windows: str, shift: str) -> Column:
    """Positions of neighbours that agree above the position bits: windows that are equal, or seldom agree by chance."""
    mask = F.expr(f"shiftleft(1L, {shift}) - 1")

    def pair(a: Column, b: Column) -> Column:
        same = F.call_function("shiftright", a.bitwiseXOR(b), F.col(shift)) == 0
        return F.when(same, F.array(a.bitwiseAND(mask), b.bitwiseAND(mask)))

    return F.filter(_neighbours(sorted_windows, pair), lambda x: x.isNotNull())


def positions(pairs: str) -> Column:
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def agree_by_chance(pairs: str) -> Column:
    """Whether the words of any of the ``pairs`` differ."""
    def differ(x: Column) -> Column:
        i, j = (F.get(x, F.lit(k)).cast("int") for k in (0, 1))
        a, b, c = (F.get("w", i + k) != F.get("w", j + k) for k in range(3))
        return a | b | c

    return F.exists(pairs, differ)


def windows_by_words(places: Column) -> Column:
    """The 3-word windows at ``places``, sorted by their words."""
    def window(p: Column) -> Column:
        i = p.cast("int")
        return F.struct(F.get("w", i).alias("a"), F.get("w", i + 1).alias("b"), F.get("w", i + 2).alias("c"), p.alias("p"))

    return F.sort_array(F.transform(places, window))


def equal_positions(sorted_windows: str) -> Column:
    """Positions of the windows whose words stand at another one too."""
    def pair(x: Column, y: Column) -> Column:
        same = (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])
        return F.when(same, F.array(x["p"], y["p"]))

    pairs = F.filter(_neighbours(sorted_windows, pair), lambda x: x.isNotNull())
    return F.sort_array(F.array_distinct(F.flatten(pairs)))


def covered_words(positions: str) -> Column:
    """Words inside the 3-word windows that start at the sorted ``positions``."""
    three = F.lit(3).cast("long")
    steps = _neighbours(positions, lambda a, b: F.least(F.coalesce(b - a, three), three))
    return F.aggregate(steps, F.lit(0).cast("long"), lambda x, y: x + y)


def base_counts(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, host, digest, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lines)."""
    text = F.col("text")
    drop = lambda chars: F.length(F.translate(text, chars, ""))
    bare = lambda x: F.btrim(x, F.lit(WHITESPACE))
    step = docs.select("doc_id", F.col("source").alias("host"), whole_text().alias("text"))
    step = step.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", "host", "text",
        words(text).alias("w"),
        F.filter(F.split(text, "\n", -1), lambda x: F.length(bare(x)) > 0).alias("l"),
    )
    shift = F.length(F.bin(F.size("w").cast("long")))  # bits that hold any position
    step = step.select("row_id", "doc_id", "host", "text", "l", "w", shift.alias("shift"))
    step = step.withColumn("s", F.sort_array(packed_windows(F.col("w"), F.col("shift"))))
    step = step.select("row_id", "doc_id", "host", "text", "l", "w", agreeing_pairs("s", "shift").alias("pairs"))
    step = step.select("row_id", "doc_id", "host", "text", "l", F.size("w").cast("long").alias("n_words"), "pairs",
                       F.when(agree_by_chance("pairs"), windows_by_words(positions("pairs"))).alias("s"))
    step = step.withColumn("r", F.when(F.col("s").isNull(), positions("pairs")).otherwise(equal_positions("s")))
    line = lambda x: F.struct(
        F.xxhash64(ascii_lower(bare(x))).alias("h"), F.regexp_count(x, F.lit("[^ \\t\\n\\x0B\\f\\r]+")).alias("n"))
    return step.select(
        "row_id", "doc_id", "host", F.xxhash64("text").alias("digest"), "n_words",
        drop(WHITESPACE).cast("long").alias("word_chars"),
        (F.length(text) - drop(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        covered_words("r").alias("n_repeat_words"),
        F.transform("l", line).alias("lines"),
    )


def boilerplate(base: DataFrame, min_docs: int, min_share: int) -> DataFrame:
    """(host, h): lines at or above the limits, counted over the different texts of a host."""
    counts = (
        base.select("host", "digest", F.explode(F.array_distinct(F.col("lines.h"))).alias("h"))
        .distinct()
        .groupBy("host", "h").agg(F.count("*").alias("n_docs"))
        .where(F.col("n_docs") >= min_docs)
    )
    if min_share:
        sizes = base.select("host", "digest").distinct().groupBy(F.col("host").alias("s_host")).agg(F.count("*").alias("n_texts"))
        counts = (counts.join(sizes, F.col("host").eqNullSafe(F.col("s_host")))
                  .where(F.col("n_docs") * 100 >= F.col("n_texts") * min_share))
    return counts.select(F.col("host").alias("b_host"), F.col("h").alias("b_h"))


def judged(docs: DataFrame, min_docs: int = MIN_DOCS, min_share: int = MIN_SHARE,
           keep_percent: int = KEEP_PERCENT) -> DataFrame:
    """Base counts of every row with ``base_failed``, the words left and the verdict ``kept``."""
    base = stored(base_counts(docs), "quality")
    lost = (
        base.select("row_id", "host", F.explode("lines").alias("line"))
        .join(boilerplate(base, min_docs, min_share),
              F.col("host").eqNullSafe(F.col("b_host")) & (F.col("line.h") == F.col("b_h")))
        .groupBy(F.col("row_id").alias("l_row")).agg(F.sum("line.n").alias("n_lost"))
    )
    out = base.drop("lines").join(lost, F.col("row_id") == F.col("l_row"), "left")
    n, left = F.col("n_words"), F.col("n_words") - F.coalesce("n_lost", F.lit(0))
    failed = (n < 50) | (F.col("n_repeat_words") * 100 > n * 50)
    return (
        out.withColumn("n_words_left", left)
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (left * 100 >= n * keep_percent))
        .drop("l_row", "n_lost")
    )


def quality_report(docs: DataFrame, **limits: int) -> DataFrame:
    return judged(docs.select("doc_id", "source", "text"), **limits).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_words_left")


def keep_good(docs: DataFrame, **limits: int) -> DataFrame:
    """The rows whose verdict is ``kept``, unchanged.  Rejected (id, host, text) triples go wherever they stand."""
    bad = (
        judged(docs.select("doc_id", "source", "text"), **limits).where("not kept")
        .select(F.col("doc_id").alias("b_id"), F.col("host").alias("b_host"), F.col("digest").alias("b_digest"))
    )
    rows = packed(docs)
    same = (
        F.col("row.doc_id").eqNullSafe(F.col("b_id")) & F.col("row.source").eqNullSafe(F.col("b_host"))
        & (F.xxhash64(whole_text("row.text")) == F.col("b_digest"))
    )
    return rows.join(bad, same, "left_anti").select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
