"""Repeated passages: windows of ``WINDOW`` words that also start in an earlier document.

1. Copies: of documents with the same words only the first is looked at further.
2. Anchors: among the ``WINDOW - ANCHOR + 1`` shingles of ``ANCHOR`` words in a window the one
   with the least hash is its anchor, so equal windows have equal anchors, about one in four
   words is one, and a window can only repeat where its anchor does.  Anchors go in packed
   batches to the task of their hash range, which says which of them stand in two documents.
   Within a batch an anchor is told once however many documents have it.
3. Shards: the words around each shared anchor, as far as windows with this anchor reach, go
   to the shard of the anchor: equal stretches once, with the least and the greatest document
   that has them, told apart by 128-bit marks.  A shard builds a compressed FM-index over its
   stretches and streams them through it by backward search; the interval of a window gives
   the first document that has it.  The stretches of an anchor with more than ``HOT_BYTES`` of
   different ones fit no shard; their windows are combined map-side by 128-bit digests instead.
4. What is found, as runs of windows with the same first owner, returns to the rows of the
   stretches by mark, and the words in the intervals go.

Each step is stored on its own; its shuffle files go when it is written, and what later steps
don't read goes with them, so the disk holds one step at a time.

Defined results: a null text has no words; rows that repeat a doc_id are never repeats of each
other; a null doc_id counts as larger than any other; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.storage import remove, scratch_path
from .common import map_frames, shuffle_files_dropped, shuffle_partitions, ship, stored, whole_text
from .fm_index import FMIndex, least_in
from .shingles import windows, word_hashes

WINDOW, ANCHOR = 13, 7
#: Anchors held by a task before it sends them; words of different stretches in one index.
HELD, INDEXED = 1_000_000, 1_000_000
#: Bytes of different stretches from which an anchor's are dealt out by their content; other anchors' go to one task each.
HOT_BYTES = 1 << 20
LAST = (1 << 63) - 1
#: Bytes of an anchor's hash that are sent; a clash only makes a stretch be looked at in vain.
KEY_BYTES = 5
#: Bytes of a stretch's mark, the first ones of its SHA-256.
MARK_BYTES = 16


def words_of(text: str) -> list[bytes]:
    return text.encode().split()


def anchors(words: list[bytes], window: int = WINDOW, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each anchor, the first window that has it, and the last one; in order of place."""
    if len(words) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    shingle = windows(word_hashes(words), size)
    view = np.lib.stride_tricks.sliding_window_view(shingle, window - size + 1)
    place = view.argmin(1) + np.arange(len(view))  # never falls from one window to the next
    at, first = np.unique(place, return_index=True)
    return shingle[at], first, np.append(first[1:], len(view)) - 1


def _short(keys: np.ndarray) -> np.ndarray:
    return keys >> np.uint64(64 - 8 * KEY_BYTES)


def _pack(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES].tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // KEY_BYTES, 8), np.uint8)
    out[:, :KEY_BYTES] = np.frombuffer(data, np.uint8).reshape(-1, KEY_BYTES)
    return out.reshape(-1).view("<u8")


PASS = "row_id long, doc_id long, digest long, n_words long, words_sha string, bucket int, keys binary, rows binary"


def first_pass(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of three kinds: each document's counts; (bucket, keys, rows) batches; keys known to be shared (row_id, keys)."""
    def told(rows: list[int], keys: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        key = np.concatenate(keys)
        row = np.repeat(np.array(rows, np.int64), [len(k) for k in keys])
        order = np.lexsort((row, key))
        key, row = key[order], row[order]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        starts = np.flatnonzero(new)
        counts = np.diff(np.append(starts, len(key)))
        shared = np.repeat(counts > 1, counts)
        if shared.any():
            own = np.argsort(row[shared], kind="stable")
            r, k = row[shared][own], key[shared][own]
            ids, at = np.unique(r, return_index=True)
            yield pd.DataFrame({"row_id": ids, "keys": [_pack(x) for x in np.split(k, at[1:])]})
        key, row = key[starts], row[starts]  # one document speaks for all of the batch
        bucket = (key * np.uint64(buckets) >> np.uint64(8 * KEY_BYTES)).astype(np.int64)
        names, at = np.unique(bucket, return_index=True)
        yield pd.DataFrame({"bucket": names, "keys": [_pack(x) for x in np.split(key, at[1:])],
                            "rows": [x.astype("<i8").tobytes() for x in np.split(row, at[1:])]})

    def shaped(df: pd.DataFrame) -> pd.DataFrame:
        for c in ("row_id", "doc_id", "digest", "n_words", "bucket"):
            df[c] = df[c].astype("Int64") if c in df else pd.array([None] * len(df), "Int64")
        for c in ("words_sha", "keys", "rows"):
            df[c] = df[c] if c in df else None
        return df[[x.split()[0] for x in PASS.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows, keys, held = [], [], 0
        for batch in batches:
            n, sha = [], []
            for row_id, text in zip(batch["row_id"], batch["text"]):
                words = words_of(text)
                n.append(len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
                found = np.unique(_short(anchors(words)[0]))
                if len(found):
                    rows.append(row_id)
                    keys.append(found)
                    held += len(found)
                if held >= HELD:
                    yield from map(shaped, told(rows, keys))
                    rows, keys, held = [], [], 0
            yield shaped(pd.DataFrame({"row_id": batch["row_id"], "doc_id": batch["doc_id"], "digest": batch["digest"], "n_words": n, "words_sha": sha}))
        if rows:
            yield from map(shaped, told(rows, keys))

    rows = (docs.select("doc_id", whole_text().alias("text"))
            .select(F.monotonically_increasing_id().alias("row_id"), "doc_id", F.xxhash64("text").alias("digest"), "text"))
    return map_frames(rows, run, PASS)


def shared_anchors(batches: DataFrame) -> DataFrame:
    """(row_id, key) of anchors that stand in more than one batch."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        key = np.concatenate([_unpack(x) for x in group["keys"]])
        row = np.concatenate([np.frombuffer(x, "<i8") for x in group["rows"]])
        order = np.argsort(key, kind="stable")
        key, row = key[order], row[order]
        same = key[1:] == key[:-1]
        shared = np.concatenate([same, [False]]) | np.concatenate([[False], same])
        return pd.DataFrame({"row_id": row[shared], "key": key[shared].astype(np.int64)})

    return batches.select("bucket", "keys", "rows").groupBy("bucket").applyInPandas(run, "row_id long, key long")


def stretches(docs: DataFrame, live: DataFrame) -> DataFrame:
    """(key, owner, row_id, first, words) around each live anchor; owner orders the documents."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {"key": [], "owner": [], "row_id": [], "first": [], "words": []}
            for row_id, owner, text, told, known in zip(batch["row_id"], batch["owner"], batch["text"], batch["keys"], batch["known"]):
                words = words_of(text)
                key, first, last = anchors(words)
                alive = np.asarray(told, np.int64).astype(np.uint64) if told is not None else np.zeros(0, np.uint64)
                if known is not None:
                    alive = np.concatenate([alive, *[_unpack(x) for x in known]])
                for k in np.flatnonzero(np.isin(_short(key), alive)):
                    out["key"].append(int(key[k].view(np.int64)))
                    out["owner"].append(owner)
                    out["row_id"].append(row_id)
                    out["first"].append(int(first[k]))
                    out["words"].append(b" ".join(words[first[k]:last[k] + WINDOW]))
            yield pd.DataFrame(out)

    rows = docs.select(F.col("doc_id").alias("d_id"), whole_text().alias("text")).withColumn("d_digest", F.xxhash64("text"))
    rows = (live.join(rows, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("digest") == F.col("d_digest")))
            .select("row_id", F.coalesce("doc_id", F.lit(LAST)).alias("owner"), "text", "keys", "known"))
    return rows.mapInPandas(run, "key long, owner long, row_id long, first long, words binary")


def _symbols(texts: list[list[bytes]], known: dict[bytes, int], add: bool) -> list[np.ndarray]:
    if add:
        return [np.fromiter((known.setdefault(w, len(known) + 1) for w in t), np.int64, len(t)) for t in texts]
    return [np.fromiter((known.get(w, 0) for w in t), np.int64, len(t)) for t in texts]


def first_owners(texts: list[list[bytes]], owners: np.ndarray, window: int = WINDOW, indexed: int = INDEXED) -> tuple[np.ndarray, np.ndarray]:
    """The least owner of a text that has it, for each window of each text; and where each text's windows begin."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    counts = np.array([max(0, len(t) - window + 1) for t in texts])
    starts = np.concatenate([[0], np.cumsum(counts)])
    least = np.full(starts[-1], LAST)
    size = np.cumsum([len(t) + 1 for t in texts])
    cuts = [0, *(np.searchsorted(size, np.arange(indexed, size[-1], indexed), "right") + 1).tolist(), len(texts)]
    for a, b in zip(cuts, cuts[1:]):  # one index after the other, all texts streamed through each
        if a >= b:
            continue
        known: dict[bytes, int] = {}
        own = _symbols(texts[a:b], known, add=True)
        index = FMIndex(np.concatenate([np.append(t, 0) for t in own]), window)
        holder = np.repeat(owners[a:b], [len(t) + 1 for t in own])[index.suffixes]
        for c, d in zip(cuts, cuts[1:]):
            query = own if (c, d) == (a, b) else _symbols(texts[c:d], known, add=False)
            query = [t for t in query if len(t) >= window]
            if not query:
                continue
            patterns = np.concatenate([np.lib.stride_tricks.sliding_window_view(t, window) for t in query])
            low, high, alone = index.intervals(patterns, own=(c, d) == (a, b))
            found = least_in(holder, np.where(alone, 0, low), np.where(alone, 0, high))
            found[alone] = holder[low[alone]]
            least[starts[c]:starts[d]] = np.minimum(least[starts[c]:starts[d]], found)
    return least, starts


def _mark(words: bytes) -> bytes:
    return hashlib.sha256(words).digest()[:MARK_BYTES]


def _told(rows: pd.DataFrame) -> pd.DataFrame:
    """(mark, at, upto, holder) of the windows of different stretches that some owner has before another.

    Neighbouring windows with the same holder are one row, from the window ``at`` to the window ``upto``.
    """
    least, starts = first_owners([w.split(b" ") for w in rows["words"]], rows["least"].to_numpy(np.int64))
    counts = np.diff(starts)
    line = np.repeat(np.arange(len(rows)), counts)
    known = np.flatnonzero(least < rows["most"].to_numpy(np.int64)[line])
    line, at, holder = line[known], known - starts[:-1][line[known]], least[known]
    new = np.ones(len(known), bool)
    new[1:] = (line[1:] != line[:-1]) | (at[1:] != at[:-1] + 1) | (holder[1:] != holder[:-1])
    last = np.append(new[1:], True)[:len(known)]
    words = rows["words"].to_numpy()
    marks = {k: _mark(words[k]) for k in np.unique(line).tolist()}
    return pd.DataFrame({"mark": [marks[k] for k in line[new].tolist()], "at": at[new].astype(np.int32), "upto": at[last].astype(np.int32),
                         "holder": holder[new]})


def different(parts: DataFrame) -> DataFrame:
    """(key, words, least, most): each anchor's different stretches with their least and greatest owner.

    Equal stretches meet before they are shuffled, so a passage that a third of the documents hold
    is a row per task from here on.
    """
    return parts.groupBy("key", "words").agg(F.min("owner").alias("least"), F.max("owner").alias("most"))


def hot_anchors(each: DataFrame) -> DataFrame:
    """The anchors with more than ``HOT_BYTES`` of different stretches."""
    return each.groupBy(F.col("key").alias("h_key")).agg(F.sum(F.octet_length("words")).alias("size")).where(F.col("size") > HOT_BYTES).select("h_key")


def repeated_intervals(parts: DataFrame, work: str) -> DataFrame:
    """(row_id, begin, end): word intervals to remove; ``work`` names the folder of what is stored on the way."""
    each = stored(different(parts), f"{work}/different")
    hot, same = stored(hot_anchors(each), f"{work}/hot"), F.col("key") == F.col("h_key")
    found = sharded_intervals(each.join(hot, same, "left_anti")).unionByName(dealt_intervals(each.join(hot, same, "left_semi"), work))
    # stored, so that the join below has plain shuffles on both sides and Spark can split the rows of a common stretch
    found = stored(found.groupBy(F.col("mark").alias("t_mark")).agg(F.collect_list(F.struct("at", "upto", "holder")).alias("found")), f"{work}/found")
    return (parts.select(F.substring(F.unhex(F.sha2("words", 256)), 1, MARK_BYTES).alias("mark"), "owner", "row_id", "first")
            .join(found, F.col("mark") == F.col("t_mark"))
            .select("row_id", "owner", "first", F.explode("found").alias("x")).where("x.holder < owner")
            .select("row_id", (F.col("first") + F.col("x.at")).cast("int").alias("begin"), (F.col("first") + F.col("x.upto") + WINDOW).cast("int").alias("end")))


FOUND = "mark binary, at int, upto int, holder long"


def dealt_intervals(each: DataFrame, work: str) -> DataFrame:
    """(mark, at, upto, holder) from anchors of any size: no task needs all stretches of an anchor, or of a window."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out: dict[str, list] = {"mark": [], "least": [], "most": [], "at": [], "window": []}
            for words, least, most in zip(batch["words"], batch["least"], batch["most"]):
                mark, w = _mark(words), words.split(b" ")
                for at in range(len(w) - WINDOW + 1):
                    for name, value in zip(out, (mark, least, most, at, hashlib.blake2b(b" ".join(w[at:at + WINDOW]), digest_size=16).digest())):
                        out[name].append(value)
            yield pd.DataFrame(out)

    windows_ = stored(each.mapInPandas(run, "mark binary, least long, most long, at int, window binary"), f"{work}/windows")
    first = windows_.groupBy(F.col("window").alias("f_window")).agg(F.min("least").alias("holder"))
    return (windows_.join(first, F.col("window") == F.col("f_window")).where("holder < most")
            .select("mark", "at", F.col("at").alias("upto"), "holder"))


def sharded_intervals(each: DataFrame) -> DataFrame:
    """(mark, at, upto, holder) from shards of whole anchors."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, size = [], 0
        for batch in batches:
            rest.append(batch)
            size += int(batch["words"].str.len().sum()) // 6
            if size < INDEXED:
                continue
            rows = pd.concat(rest, ignore_index=True)
            last = rows["key"] == rows["key"].iloc[-1]  # its rows may go on in the next batch
            if not last.all():
                yield _told(_met_twice(rows[~last]))
            rest = [rows[last]]
            size = int(rows["words"][last].str.len().sum()) // 6
        if rest:
            yield _told(_met_twice(pd.concat(rest, ignore_index=True)))

    n = shuffle_partitions(each.sparkSession)
    return each.repartition(n, "key").sortWithinPartitions("key").mapInPandas(run, FOUND)


def _met_twice(rows: pd.DataFrame) -> pd.DataFrame:
    """Without the anchors that only one owner has; ``rows`` stand in the order of their keys."""
    if not len(rows):
        return rows
    key = rows["key"].to_numpy(np.int64)
    start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    least = np.minimum.reduceat(rows["least"].to_numpy(np.int64), start)
    most = np.maximum.reduceat(rows["most"].to_numpy(np.int64), start)
    return rows[np.repeat(least != most, np.diff(np.append(start, len(key))))].reset_index(drop=True)


def _kept_words(words: list[bytes], begins, ends) -> list[bytes]:
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, np.asarray(begins, np.int64), 1)
    np.add.at(cover, np.asarray(ends, np.int64), -1)
    stays = np.cumsum(cover)[:len(words)] == 0
    return [w for w, s in zip(words, stays) if s]


def _documents_and_hits(docs: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """Each document's counts and digests; (h_sha, h_id, begins, ends): the word intervals to remove from its words."""
    spark = docs.sparkSession
    passed = scratch_path(spark, "llm", work, "pass")
    first_pass(docs, max(64, 2 * shuffle_partitions(spark))).write.parquet(passed)
    done = spark.read.schema(PASS).parquet(passed)
    each = done.where("n_words is not null").select("row_id", "doc_id", "digest", "n_words", "words_sha")
    order = F.coalesce("doc_id", F.lit(LAST))
    first = each.groupBy("words_sha").agg(F.min(F.struct(order.alias("owner"), "row_id")).alias("first"))
    first = first.select(F.col("words_sha").alias("f_sha"), "first")
    each = stored(each.join(first, F.col("words_sha") == F.col("f_sha"))
                  .withColumn("leads", F.col("first.row_id") == F.col("row_id"))
                  .withColumn("copy", order > F.col("first.owner"))
                  .drop("first", "f_sha"), "documents")

    told = (shared_anchors(done.where("bucket is not null")).groupBy(F.col("row_id").alias("t_row")).agg(F.collect_list("key").alias("keys")))
    known = (done.where("n_words is null and bucket is null").groupBy(F.col("row_id").alias("k_row")).agg(F.collect_list("keys").alias("known")))
    live = (each.where("leads").join(told, F.col("row_id") == F.col("t_row"), "left").join(known, F.col("row_id") == F.col("k_row"), "left")
            .where("keys is not null or known is not null").select("row_id", "doc_id", "digest", "keys", "known"))
    live = stored(live, f"{work}/live")
    remove(spark, passed)  # all that is needed of it stands in the two stored tables
    gone = (repeated_intervals(stored(stretches(docs, live), f"{work}/stretches"), work)
            .groupBy(F.col("row_id").alias("g_row")).agg(F.collect_list("begin").alias("begins"), F.collect_list("end").alias("ends")))
    # rows with the same id and words as a leading one lose the same words
    hits = stored(gone.join(each.select("row_id", "words_sha", "doc_id"), F.col("g_row") == F.col("row_id"))
                  .select(F.col("words_sha").alias("h_sha"), F.col("doc_id").alias("h_id"), "begins", "ends"), "repeats")
    remove(spark, scratch_path(spark, "llm", work))
    return each, hits


def substring_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    spark = docs.sparkSession
    ship(spark)
    docs = docs.select("doc_id", "text")
    with shuffle_files_dropped(spark):
        each, hits = _documents_and_hits(docs, f"anchors-{uuid.uuid4().hex[:12]}")

    same = (F.col("words_sha") == F.col("h_sha")) & F.col("doc_id").eqNullSafe(F.col("h_id"))
    each = each.withColumn("gone", F.col("copy") & (F.col("n_words") >= WINDOW))
    plain = each.where("gone").unionByName(each.where("not gone").join(hits, same, "left_anti"))
    empty = hashlib.sha256(b"").hexdigest()
    plain = plain.select("doc_id", "n_words", F.when(F.col("gone"), F.col("n_words")).otherwise(F.lit(0).cast("long")).alias("n_removed"),
                         F.when(F.col("gone"), F.lit(empty)).otherwise(F.col("words_sha")).alias("kept_sha256"))
    cut = each.where("not gone").join(hits, same).select(F.col("doc_id").alias("c_id"), F.col("digest").alias("c_digest"), "begins", "ends")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            n, removed, sha = [], [], []
            for text, begins, ends in zip(batch["text"], batch["begins"], batch["ends"]):
                words = words_of(text)
                kept = _kept_words(words, begins, ends)
                n.append(len(words))
                removed.append(len(words) - len(kept))
                sha.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "n_words": n, "n_removed": removed, "kept_sha256": sha})

    rows = docs.withColumn("text", whole_text()).withColumn("digest", F.xxhash64("text"))
    cut = (rows.join(cut.dropDuplicates(["c_id", "c_digest"]), F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("digest") == F.col("c_digest")))
           .select("doc_id", "text", "begins", "ends"))
    return plain.unionByName(map_frames(cut, run, "doc_id long, n_words long, n_removed long, kept_sha256 string"))
