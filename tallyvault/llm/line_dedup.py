"""Lines that many documents share, decided once per line and sent back as bitmaps.

Every line becomes a (hash, document, position) row without its text.  The rows are
range-partitioned by hash and sorted by document and position inside a partition, so that
one pass streams the occurrences of a line in order: the first row of a document counts the
document, the very first row is the line's first occurrence.  A frequent hash is spread over
``SALTS`` ranges, whose counts are added up afterwards.  What returns to a document is a
bitmap of its dropped lines, 62 lines to a word; the text itself moves once, for the join
with its bitmap.

Defined results: a null or empty text is one empty line; lines without a key (only white
space) are never dropped; rows that repeat a doc_id count as one document, each keeps its
own bitmap; null doc_ids count together as one document; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WHITESPACE, ascii_lower, packed, shuffle_partitions, stored, whole_text, with_text

BITS = 62
SALTS = 32
MIN_DOCS = 10


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITESPACE)))


def _hash(key: Column) -> Column:
    return F.when(F.length(key) > 0, F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2")))


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, digest, pos, h1, h2) of every line that has a key; ``digest`` tells repeated ids apart."""
    return (
        docs.select("doc_id", whole_text().alias("text"))
        .select("doc_id", F.xxhash64("text").alias("digest"),
                F.posexplode(F.transform(lines_of(F.col("text")), lambda x: _hash(line_key(x)))).alias("pos", "h"))
        .where("h is not null")
        .select("doc_id", "digest", "pos", "h.h1", "h.h2")
    )


def _salted(lines: DataFrame) -> DataFrame:
    return lines.withColumn("salt", F.pmod(F.hash("doc_id"), F.lit(SALTS)))


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h1, h2, first) of the lines found in ``min_docs`` documents or more."""
    n = shuffle_partitions(lines.sparkSession)
    ranged = (_salted(lines).repartitionByRange(n, "h1", "h2", "salt")
              .sortWithinPartitions("h1", "h2", "salt", "doc_id", "digest", "pos"))
    stream = Window.partitionBy("h1", "h2", "salt").orderBy("doc_id", "digest", "pos")
    new_doc = (F.row_number().over(stream) == 1) | ~F.lag("doc_id").over(stream).eqNullSafe(F.col("doc_id"))
    return (
        ranged.withColumn("new_doc", new_doc)
        .where("new_doc")
        .groupBy("h1", "h2")
        .agg(F.count("*").alias("n_docs"), F.min(F.struct("doc_id", "digest", "pos")).alias("first"))
        .where(F.col("n_docs") >= min_docs)
        .select("h1", "h2", "first")
    )


def drop_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none") -> DataFrame:
    """(doc_id, digest, drops): bit ``i % 62`` of word ``i / 62`` is set when line ``i`` goes.

    ``keep="none"``: every occurrence of a frequent line goes; ``keep="first"``: its first
    occurrence (by document, then position) stays.  Documents that lose nothing have no row.
    """
    lines = stored(line_rows(docs), "lines")
    # every frequent line once per salt, so that the rows of a hot one are many keys
    frequent = frequent_lines(lines, min_docs).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    hits = _salted(lines).join(frequent, ["h1", "h2", "salt"])
    if keep == "first":
        hits = hits.where(~F.col("first").eqNullSafe(F.struct("doc_id", "digest", "pos")))
    word = F.floor(F.col("pos") / BITS).cast("int")
    bits = (
        hits.select("doc_id", "digest", word.alias("word"), F.expr(f"shiftleft(1L, pos % {BITS})").alias("bits"))
        .groupBy("doc_id", "digest", "word").agg(F.bit_or("bits").alias("bits"))
    )
    bits = stored(bits, "bits")
    zeros = (
        bits.groupBy("doc_id", "digest").agg(F.max("word").alias("last"))
        .select("doc_id", "digest", F.explode(F.sequence(F.lit(0), "last")).alias("word"), F.lit(0).cast("long").alias("bits"))
    )
    return (
        bits.unionByName(zeros)
        .groupBy("doc_id", "digest", "word").agg(F.bit_or("bits").alias("bits"))
        .groupBy("doc_id", "digest")
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dense"))
        .select("doc_id", "digest", F.col("dense.bits").alias("drops"))
    )


def _kept(text: Column, drops: Column) -> Column:
    def stays(_line: Column, i: Column) -> Column:
        word = F.get(drops, F.floor(i / BITS).cast("int"))
        return F.coalesce(F.getbit(word, (i % BITS).cast("int")), F.lit(0)) == 0

    lines = lines_of(text)
    return F.when(drops.isNull(), lines).otherwise(F.filter(lines, stays))


def with_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none") -> DataFrame:
    """(row, text, drops): each input row packed, with its whole text and bitmap (null: nothing goes)."""
    bitmaps = drop_bitmaps(docs, min_docs, keep).select(
        F.col("doc_id").alias("b_id"), F.col("digest").alias("b_digest"), "drops")
    rows = packed(docs).withColumn("text", whole_text("row.text"))
    same = F.col("row.doc_id").eqNullSafe(F.col("b_id")) & (F.xxhash64("text") == F.col("b_digest"))
    return rows.join(bitmaps, same, "left").select("row", "text", "drops")


def drop_frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, keep: str = "none") -> DataFrame:
    """The documents with frequent lines cut out; a document that loses all its lines goes too."""
    cut = with_bitmaps(docs, min_docs, keep).withColumn("kept", _kept(F.col("text"), F.col("drops")))
    stays = F.col("drops").isNull() | (F.length(F.btrim(F.concat_ws("\n", "kept"), F.lit(WHITESPACE))) > 0)
    new_text = F.when(F.col("drops").isNull(), F.col("row.text")).otherwise(F.concat_ws("\n", "kept"))
    return with_text(cut.where(stays), docs.columns, new_text)


def line_report(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document."""
    cut = with_bitmaps(docs.select("doc_id", "text"), min_docs)
    dropped = F.coalesce(F.aggregate("drops", F.lit(0), lambda n, w: n + F.bit_count(w)), F.lit(0))
    return cut.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
        dropped.cast("long").alias("n_dropped"),
        F.sha2(F.concat_ws("\n", _kept(F.col("text"), F.col("drops"))), 256).alias("kept_sha256"),
    )
