"""Exact n-gram Jaccard self-join in metric space: pivots, their regions, windows, recursion.

Jaccard distance is a metric.  Documents become shingle sets; equal sets are one class.  Two
sets that link share ``COMMON`` of the first ``n - ceil(t n) + COMMON`` shingles of each in
any common order of all shingles (all that very small sets have), so every shingle that heads
two or more sets is a place where links may be.  Classes that share too few places with
classes of a size that could link are put aside; the smallest class left at a place is the
pivot there.  A pivot's region holds every class that
meets it at some shingle; a class at a border stands in several regions.  The order puts rare
shingles first (frequent ones, counted over all documents, last; among the others the longest
first); it decides the cost only, never the result.

In a region, distances to the pivot are taken first.  Members within the radius are one
component at once; by the triangle inequality two members can only link if their distances
to the pivot differ by no more than the radius, and so on with further pivots for what is
not connected yet.  A pair inside one component needs no test, which keeps large groups of
near copies from costing all their pairs.  A region above ``MEMBERS`` classes or ``SHINGLES``
shingles is cut into blocks, and each pair of blocks is a region of its own.

Defined results: a null text, or one without words, has no set and is linked with nothing;
rows that repeat a doc_id are documents of their own that share the id; an empty table gives
an empty one.  Shingles and sets are told apart by 64-bit fingerprints under a key drawn for each
run: no texts can be made up whose fingerprints meet, and by chance two given ones do once in 2^64.
"""

from __future__ import annotations

import hashlib
import math
import secrets
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import map_frames, packed, ship, stored, whole_text
from .components import connected_components
from .shingles import shingle_set, shingle_set_with_lengths

#: A shingle in so many documents of one task counts as frequent.
FREQUENT = 4
#: The most frequent shingles that the order knows by count (8 bytes each, sent to every task).
KNOWN = 400_000
#: Each head has so many shingles more than one common shingle would need; linked sets share at least as many.
COMMON = 5
#: Rounds in which classes without enough shared places go, and places that they leave alone.
PEELS = 2
MEMBERS = 4096
SHINGLES = 2_000_000
FLUSH = 4_000_000


def _long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def class_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def frequent_shingles(docs: DataFrame, size: int, key: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted fingerprints and counts of frequent shingles, ``KNOWN`` at most."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = [], 0

        def told() -> pd.DataFrame:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            some = counts >= FREQUENT
            return pd.DataFrame({"key": _long(keys[some]), "n": counts[some]})

        for batch in batches:
            for text in batch["text"]:
                held.append(shingle_set(text, size, key))
                n += len(held[-1])
                if n >= FLUSH:
                    yield told()
                    held, n = [], 0
        if held:
            yield told()

    found = stored(docs.select(whole_text().alias("text")).mapInPandas(run, "key long, n long")
                   .groupBy("key").agg(F.sum("n").alias("n")), "frequent")
    count = found.count()
    if count > KNOWN:
        floor = found.approxQuantile("n", [1 - 0.9 * KNOWN / count], 0.001)[0]
        found = found.where(F.col("n") > floor)
    rows = found.toPandas()
    keys = rows["key"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return keys[order], rows["n"].to_numpy(np.int64)[order]


class RareFirst:
    """The common order of all shingles: by known count, longest first, then by fingerprint."""

    BITS = 22

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.maybe = np.zeros(1 << self.BITS, bool)
        self.maybe[(keys >> np.uint64(64 - self.BITS)).astype(np.int64)] = True

    def head(self, s: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, int]:
        """The first ``n`` shingles in the order, and the order's rank of the last one."""
        weight = np.zeros(len(s), np.int64)
        hits = np.flatnonzero(self.maybe[(s >> np.uint64(64 - self.BITS)).astype(np.int64)])
        if len(hits):
            at = np.minimum(np.searchsorted(self.keys, s[hits]), len(self.keys) - 1)
            weight[hits] = np.where(self.keys[at] == s[hits], self.counts[at], 0)
        first = np.lexsort((s, -lengths, weight))[:n]
        last = first[-1]
        return s[first], int(weight[last] << 32) - int(lengths[last])


def signatures(docs: DataFrame, size: int, percent: int, key: int) -> DataFrame:
    """(doc_id, digest, n, class_id, head, last, last_rank) of every document.

    ``head``: its first shingles in the common order, the last of which is ``last`` and has ``last_rank`` (ties by
    fingerprint); empty where a task has given the class' head already.
    """
    order = RareFirst(*frequent_shingles(docs, size, key))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        given = set()
        for batch in batches:
            ids, ns, heads, lasts, ranks = [], [], [], [], []
            for text in batch["text"]:
                s, lengths = shingle_set_with_lengths(text, size, key)
                n = len(s)
                head, rank = order.head(s, lengths, _head_size(n, percent)) if n else (s, 0)
                head = _long(head)
                ids.append(class_id(s) if n else None)
                ns.append(n)
                lasts.append(head[-1] if n else 0)
                ranks.append(rank)
                heads.append(head[:0] if ids[-1] in given else head)
                given.add(ids[-1])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64").array, "digest": batch["digest"].to_numpy(), "n": ns,
                                "class_id": pd.array(ids, "Int64"), "head": heads, "last": lasts, "last_rank": ranks})

    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("digest", F.xxhash64("text"))
    return stored(map_frames(rows, run, "doc_id long, digest long, n long, class_id long, head array<long>, last long, last_rank long"), "signatures")


def _head_size(n, percent: int):
    """Shingles in the head of a set of ``n`` (an int or an array)."""
    return np.minimum(n, n - -(-percent * n // 100) + COMMON)


def _least_common(n: Column, percent: int) -> Column:
    """How many of its first shingles a set of size ``n`` shares at least with whatever it links to."""
    least = F.ceil(F.lit(percent) * F.ceil(F.lit(percent) * n / 100) / 100)
    return F.least(least, F.lit(COMMON)).cast("int")


def _without_strays(places: DataFrame, percent: int) -> DataFrame:
    """Without classes that can't link: too few places shared with classes of a like size."""
    step = math.log(100 / percent) + 1e-9  # sizes that may link lie in the same or the next class of sizes
    rows = places.withColumn("b", F.floor(F.log("n") / F.lit(step)))
    counts = rows.groupBy("key", "b").agg(F.count("*").alias("c"))
    near = (counts.select(F.col("key").alias("n_key"), F.explode(F.array(F.col("b") - 1, F.col("b"), F.col("b") + 1)).alias("n_b"), "c")
            .groupBy("n_key", "n_b").agg(F.sum("c").alias("c")).where("c > 1"))
    rows = rows.join(near, (F.col("key") == F.col("n_key")) & (F.col("b") == F.col("n_b"))).select("key", "class_id", "n")
    strong = (rows.groupBy("class_id", "n").agg(F.count("*").alias("c"))
              .where(F.col("c") >= _least_common(F.col("n"), percent)).select(F.col("class_id").alias("s_id")))
    return rows.join(strong, F.col("class_id") == F.col("s_id"), "left_semi")


def region_members(signs: DataFrame, percent: int) -> DataFrame:
    """(region, i, j, class_id): the classes of each pivot's region, cut into pairs of blocks where large.

    Of a region's members only those go on that could link to another one by what their heads
    say: of two heads the one that ends first in the common order holds all shingles of its set
    up to there, so what it doesn't share with the other head the other set doesn't have.
    """
    heads = signs.select("class_id", "n", F.explode("head").alias("key"))
    here = Window.partitionBy("key")  # the heads, most of the bytes that move, are dealt by shingle once and never joined
    places = (heads.withColumn("least", F.min("class_id").over(here)).withColumn("most", F.max("class_id").over(here))
              .where("least != most").select("class_id", "n", "key"))
    places = stored(places.dropDuplicates(["key", "class_id"]), "places")  # heads of equal sets, given by several tasks
    for _ in range(PEELS):
        places = stored(_without_strays(places, percent), "places")
    pivots = places.groupBy("key").agg(F.min("class_id").alias("pivot")).withColumnRenamed("key", "p_key")
    members = places.join(pivots, F.col("key") == F.col("p_key")).select("pivot", "class_id", "n").distinct()
    members = stored(members, "members")
    blocks = members.groupBy("pivot").agg(F.ceil(F.greatest(F.count("*") / MEMBERS, F.sum("n") / SHINGLES)).cast("int").alias("blocks"))
    cut = members.join(blocks.withColumnRenamed("pivot", "b_pivot"), F.col("pivot") == F.col("b_pivot"))
    own = F.pmod(F.xxhash64("class_id"), F.col("blocks")).cast("int")
    cut = (cut.withColumn("own", own)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select(F.col("pivot").alias("region"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "class_id", "n"))
    ends = (signs.where("n > 0").groupBy(F.col("class_id").alias("e_id")).agg(F.min(F.struct("last", "last_rank")).alias("end"))
            .select("e_id", "end.last", "end.last_rank"))
    keys = places.groupBy(F.col("class_id").alias("k_id")).agg(F.collect_list("key").alias("keys"))
    keys = keys.join(ends, F.col("k_id") == F.col("e_id")).drop("e_id")
    rows = cut.join(keys, F.col("class_id") == F.col("k_id")).drop("k_id")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        r = Region([np.unique(np.asarray(x, np.int64).view(np.uint64)) for x in group["keys"]])
        n, ids = group["n"].to_numpy(), group["class_id"].to_numpy()
        size = _head_size(n, percent)
        ends_at = np.empty(len(n), np.int64)
        ends_at[np.lexsort((group["last"].to_numpy(np.int64).view(np.uint64), group["last_rank"].to_numpy()))] = np.arange(len(n))
        links = np.zeros(len(n), bool)
        for k in range(len(n)):
            common = r.common(k)
            first = ends_at <= ends_at[k]  # the other head ends first
            most = np.where(first, n - size, n[k] - size[k]) + common
            most = np.minimum(most, np.minimum(n, n[k]))
            near = (common > 0) & (100 * most >= percent * (n + n[k] - most)) & (ids != ids[k])
            if near.any():
                links[k] = True
                links |= near
        return group.loc[links, ["region", "i", "j", "class_id"]]

    return rows.groupBy("region", "i", "j").applyInPandas(run, "region long, i int, j int, class_id long")


def live_sets(docs: DataFrame, signs: DataFrame, members: DataFrame, size: int, key: int) -> DataFrame:
    """(class_id, shingles) of the classes that stand in a region, from one document of each (repeated rows repeat it)."""
    live = members.select(F.col("class_id").alias("c")).distinct()
    first = (signs.join(live, F.col("class_id") == F.col("c"), "left_semi")
             .groupBy("class_id").agg(F.min(F.struct("doc_id", "digest")).alias("first"))
             .select(F.col("class_id").alias("c"), F.col("first.doc_id").alias("f_id"), F.col("first.digest").alias("f_digest")))
    rows = docs.select("doc_id", whole_text().alias("text")).withColumn("digest", F.xxhash64("text"))
    rows = rows.join(first, F.col("doc_id").eqNullSafe(F.col("f_id")) & (F.col("digest") == F.col("f_digest"))).select("c", "text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [shingle_set(t, size, key) for t in batch["text"]]
            found = pd.DataFrame({"class_id": batch["c"].to_numpy(), "shingles": [s.tobytes() for s in sets]})
            # a text of the same id and digest may be another one
            yield found[np.array([class_id(s) == c for s, c in zip(sets, batch["c"])], bool)]

    return rows.mapInPandas(run, "class_id long, shingles binary")


class Region:
    """The sets of one region, with an index from shingle to members."""

    def __init__(self, sets: list[np.ndarray]):
        self.n = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.n)
        flat = np.concatenate(sets)
        order = np.argsort(flat, kind="stable")
        self.owner = owner[order]
        self.keys, self.starts = np.unique(flat[order], return_index=True)
        self.ends = np.append(self.starts[1:], len(flat))
        self.sets = sets

    def common(self, k: int) -> np.ndarray:
        """Size of the intersection of member ``k`` with each member."""
        at = np.searchsorted(self.keys, self.sets[k])
        starts, lengths = self.starts[at], self.ends[at] - self.starts[at]
        rows = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        return np.bincount(self.owner[rows], minlength=len(self.n))


def region_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Links that join the same members as all pairs above the threshold would; a spanning set of them."""
    r = Region(sets)
    label = np.arange(len(sets))
    todo = np.ones(len(sets), bool)
    first_far = None
    while True:
        names, sizes = np.unique(label, return_counts=True)
        if len(names) == 1:
            return
        main = names[np.argmax(sizes)]
        outside = todo & (label != main)
        if not outside.any():
            return  # every member outside the main component has met all the others
        # a pivot from the main component while that still pays, members left outside afterwards
        inside = np.flatnonzero(todo & (label == main))
        grows = first_far is None or (sizes.max() > 1 and tries < 16 and outside.sum() > 32)
        k = inside[0] if grows and len(inside) else np.flatnonzero(outside)[0]
        tries = 0 if first_far is None else tries + 1
        todo[k] = False
        near = label != label[k]
        common = r.common(k)
        union = r.n + r.n[k] - common
        if first_far is None:
            first_far = 1 - common / union  # distances to the first pivot
        else:
            near &= np.abs(first_far - first_far[k]) <= (100 - percent) / 100 + 1e-9
        for other in np.flatnonzero(near & (100 * common >= percent * union)):
            if label[other] != label[k]:
                yield int(k), int(other)
                label[label == label[other]] = label[k]


def similar_classes(docs: DataFrame, signs: DataFrame, size: int, percent: int, key: int) -> DataFrame:
    """Links (a, b) between classes whose sets are similar enough: a spanning set for each region."""
    members = stored(region_members(signs, percent), "regions")
    sets = stored(live_sets(docs, signs, members, size, key), "sets")
    rows = members.join(sets.withColumnRenamed("class_id", "c"), F.col("class_id") == F.col("c")).select("region", "i", "j", "class_id", "shingles")

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop_duplicates("class_id")  # rows that repeat id and text
        ids = group["class_id"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
        links = [(ids[a], ids[b]) for a, b in region_links(sets, percent)]
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    return rows.groupBy("region", "i", "j").applyInPandas(run, "a long, b long")


def with_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, digest, n_shingles, component_id, group) of every document.

    ``component_id`` is what a group reports, its least doc_id, which other groups may share;
    ``group`` names it: the least class id in it, null without a set.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text")
    key = secrets.randbits(64)
    signs = signatures(docs, size, percent, key)
    labels = connected_components(similar_classes(docs, signs, size, percent, key))
    classes = signs.where("class_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("least"))
    linked = labels.join(classes, F.col("id") == F.col("class_id")).select("id", "label", "least")
    groups = linked.groupBy("label").agg(F.min("least").alias("component")).withColumnRenamed("label", "g")
    found = linked.join(groups, F.col("label") == F.col("g")).select(F.col("id").alias("l_id"), "label", "component")
    found = (classes.join(found, F.col("class_id") == F.col("l_id"), "left")
             .select(F.col("class_id").alias("c"), F.coalesce("component", "least").alias("component"),
                     F.coalesce("label", "class_id").alias("group")))
    return (signs.join(found, F.col("class_id") == F.col("c"), "left")
            .select("doc_id", "digest", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"), "group"))


def jaccard_report(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    return with_components(docs, size, percent).select("doc_id", "n_shingles", "component_id")


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id (then text digest)."""
    parts = with_components(docs, size, percent)
    first = (parts.where("n_shingles > 0").groupBy("group")
             .agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "digest")).alias("first"))
             .select("first.doc_id", "first.digest"))
    keep = first.unionByName(parts.where("n_shingles = 0").select("doc_id", "digest").distinct())
    key = ["nameless", "id", "digest"]  # without nulls, so that the join deals the texts as the window needs them, and they move once

    def named(rows: DataFrame, doc_id: str) -> DataFrame:
        return rows.withColumn("nameless", F.col(doc_id).isNull()).withColumn("id", F.coalesce(F.col(doc_id), F.lit(0).cast("long")))

    rows = named(packed(docs).withColumn("digest", F.xxhash64(whole_text("row.text"))), "row.doc_id")
    kept = rows.join(named(keep, "doc_id").select(key), key, "left_semi")
    # rows that repeat both id and text are copies too
    again = Window.partitionBy(key).orderBy(F.lit(0))
    kept = kept.withColumn("again", F.row_number().over(again)).where("again = 1")
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
