"""Token ids in word-aligned binary form: Simple-8b words, read and written in blocks.

A 64-bit word holds a selector in its top four bits and 60 bits of payload: as many equal-width
ids as the selector says.  Words never cross a block of ``BLOCK`` ids, so blocks are packed
and unpacked side by side with numpy; the offset of every block is stored.  A value of more
than 60 bits leaves an escape word, and stands raw in the block's list of exceptions.

A file is one Parquet row per segment (about ``SEGMENT`` ids of consecutive documents):
part and seq (their order is the order of the documents), n_tokens, the documents' ids and
token counts, the words, the block offsets and the exceptions.  Spark commits the files, so
a lost executor leaves no half-written one.

Documents are ordered by doc_id (nulls first), repeated ids by a digest of their text.
Defined results: a null or empty text has only the end id; an empty table gives no files'
rows and an empty result.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.storage import scratch_path
from .common import shuffle_partitions, ship, whole_text

BLOCK = 1024
SEGMENT = 1 << 20
END_ID = 2
ESCAPE = 15
#: Selector -> (ids in a word, bits of each); selector 0 is a run of zeros.
LAYOUT = ((240, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8),
          (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
COUNTS = np.array([n for n, _ in LAYOUT] + [1])


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit length of each uint64: the exponents of the high and the low halves as floats."""
    out = np.frexp((values & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
    high = values >> np.uint64(32)
    if high.any():
        long = high > 0
        out[long] = 32 + np.frexp(high[long].astype(np.float64))[1]
    return out


def _best_selectors(bits: np.ndarray) -> np.ndarray:
    """For every position of every block (rows): the selector that packs the most ids from there on."""
    best = np.full(bits.shape, ESCAPE, np.uint8)
    width = bits.shape[1]

    def longest(power: np.ndarray, step: int, n: int) -> np.ndarray:
        ahead = np.zeros_like(power)
        if n - step < width:
            ahead[:, : width - (n - step)] = power[:, n - step:]
        return np.maximum(power, ahead)

    power, step = bits, 1  # the most bits among ``step`` ids from each position on
    for selector in range(len(LAYOUT) - 1, -1, -1):
        n, size = LAYOUT[selector]
        while step * 2 <= n:
            power, step = longest(power, step, step * 2), step * 2
        best[longest(power, step, n) <= size] = selector
    return best


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, offset of each block's first word and the end, exceptions as (index, value) pairs)."""
    n = len(values)
    blocks = -(-n // BLOCK)
    table = np.zeros(blocks * BLOCK, np.uint64)
    table[:n] = values
    table = table.reshape(blocks, BLOCK)
    best = _best_selectors(_bits(table))
    here, alive = np.zeros(blocks, np.int64), np.arange(blocks)
    starts, owners, selectors = [], [], []
    ends = np.minimum(n - np.arange(blocks) * BLOCK, BLOCK)
    while len(alive):  # one word of every unfinished block at a time
        s = best[alive, here[alive]]
        starts.append(here[alive].copy())
        owners.append(alive)
        selectors.append(s)
        here[alive] += COUNTS[s]
        alive = alive[here[alive] < ends[alive]]
    if not starts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.uint64)
    start, owner, selector = map(np.concatenate, (starts, owners, selectors))
    order = np.lexsort((start, owner))
    start, owner, selector = start[order], owner[order], selector[order].astype(np.uint64)
    words = selector << np.uint64(60)
    flat = np.concatenate([table.reshape(-1), np.zeros(256, np.uint64)])
    at = owner * BLOCK + start
    room = BLOCK - start
    for s, (count, size) in enumerate(LAYOUT):
        rows = np.flatnonzero(selector == s)
        if size:
            for j in range(count):
                x = flat[at[rows] + j]
                x[j >= room[rows]] = 0
                words[rows] |= x << np.uint64(j * size)
    big = np.flatnonzero(selector == ESCAPE)
    exceptions = np.stack([at[big].astype(np.uint64), flat[at[big]]], axis=1).reshape(-1)
    return words, np.searchsorted(owner, np.arange(blocks + 1)), exceptions


def unpack(words: np.ndarray, offsets: np.ndarray, exceptions: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` values that :func:`pack` was given."""
    selector = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[selector]
    before = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = before[:-1] - before[offsets[:-1]][owner] + owner * BLOCK
    room = BLOCK - (at - owner * BLOCK)
    out = np.zeros((len(offsets) - 1) * BLOCK, np.uint64)
    for s, (count, size) in enumerate(LAYOUT):
        rows = np.flatnonzero(selector == s)
        if size:
            mask = np.uint64((1 << size) - 1)
            for j in range(count):
                ok = rows[room[rows] > j]
                out[at[ok] + j] = (words[ok] >> np.uint64(j * size)) & mask
    out[exceptions[::2].astype(np.int64)] = exceptions[1::2]
    return out[:n]


class ByteEncoder:
    """``text -> ids`` of a byte-level BPE file, equal to the tokenizers library's.

    tiktoken's core with the file's vocabulary gives the same ids (tested) at a quarter of the time.
    The library itself takes the texts with the string of an added token, and those with white space
    so long that the pattern engine of the core has no stack for it (it panics, which is no Exception).
    """

    def __init__(self, tokenizer_file: str) -> None:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(tokenizer_file).encode
        with open(tokenizer_file) as f:
            file = json.load(f)
        self.added = [x["content"] for x in file["added_tokens"]]
        # the 256 bytes as the printable characters that byte-level vocabularies write them with
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        ranks = {bytes(shown[c] for c in piece): i for piece, i in file["model"]["vocab"].items() if piece not in self.added}
        self.core = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> list[int]:
        if not any(s in text for s in self.added):
            try:
                return self.core(text)
            except BaseException as e:
                if type(e).__name__ != "PanicException":
                    raise
        return self.library(text, add_special_tokens=False).ids


@lru_cache(maxsize=2)
def encoder(tokenizer_file: str) -> ByteEncoder:
    return ByteEncoder(tokenizer_file)


FILE_SCHEMA = ("part int, seq int, n_tokens long, n_docs int, doc_ids array<long>, counts array<long>, "
               "words binary, offsets binary, exceptions binary")
FILE_ARROW = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_tokens", pa.int64()), ("n_docs", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
                        ("counts", pa.list_(pa.int64())), ("words", pa.binary()), ("offsets", pa.binary()), ("exceptions", pa.binary())])


def _segment(part: int, seq: int, docs: list, counts: list[int], ids: list[np.ndarray]) -> pa.RecordBatch:
    values = np.concatenate(ids).astype(np.uint64)
    words, offsets, exceptions = pack(values)
    row = {"part": part, "seq": seq, "n_tokens": len(values), "n_docs": len(docs), "doc_ids": docs, "counts": counts,
           "words": words.astype("<u8").tobytes(), "offsets": offsets.astype("<i8").tobytes(), "exceptions": exceptions.astype("<u8").tobytes()}
    return pa.RecordBatch.from_pylist([row], schema=FILE_ARROW)


def write_token_files(docs: DataFrame, tokenizer_file: str, path: str, end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id``, and write the ids to ``path`` in ascending doc_id order."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, seq = encoder(tokenizer_file), TaskContext.get().partitionId(), 0
        names, counts, ids, size = [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.array([*encode(text.as_py()), end_id], np.uint32)
                names.append(doc_id)
                counts.append(len(own))
                ids.append(own)
                size += len(own)
                if size >= SEGMENT:
                    yield _segment(part, seq, names, counts, ids)
                    names, counts, ids, size, seq = [], [], [], 0, seq + 1
        if names:
            yield _segment(part, seq, names, counts, ids)

    n = shuffle_partitions(docs.sparkSession)
    (docs.select("doc_id", whole_text().alias("text"))
     .withColumn("tie", F.xxhash64("text"))
     .repartitionByRange(n, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "text")
     .mapInArrow(run, FILE_SCHEMA)
     .write.option("compression", "zstd").parquet(path))


def read_token_files(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids) of every document in the files."""
    ship(spark)
    files = spark.read.schema(FILE_SCHEMA).parquet(path)
    schema = "part int, seq int, doc_id long, local long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: column[at].as_py() for name, column in zip(batch.schema.names, batch.columns)}
                values = unpack(*(np.frombuffer(row[c], t) for c, t in (("words", "<u8"), ("offsets", "<i8"), ("exceptions", "<u8"))), row["n_tokens"])
                ids = values.astype("<u4")
                cuts = [0, *np.cumsum(np.asarray(row["counts"], np.int64)).tolist()]
                n = len(row["counts"])
                out = {"part": pa.array([row["part"]] * n, pa.int32()), "seq": pa.array([row["seq"]] * n, pa.int32()),
                       "doc_id": pa.array(row["doc_ids"], pa.int64()), "local": pa.array(cuts[:-1], pa.int64()), "n_tokens": pa.array(row["counts"], pa.int64()),
                       "ids_crc32": pa.array([zlib.crc32(ids[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])], pa.int64())}
                if with_ids:
                    out["ids"] = pa.array([ids[a:b].astype(np.int64) for a, b in zip(cuts, cuts[1:])], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(out)

    # ids before a segment: those of the parts before, and of the part's segments before
    sizes = files.select("part", "seq", "n_tokens")
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = (sizes.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
              .join(parts, "part").select("part", "seq", (F.col("base") + F.col("within")).alias("first")))
    return (files.mapInArrow(run, schema).join(starts, ["part", "seq"])
            .select("doc_id", (F.col("first") + F.col("local")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])))


def token_report(docs: DataFrame, tokenizer_file: str) -> DataFrame:
    """Write the files to the shared scratch folder and report what is read back from them."""
    path = scratch_path(docs.sparkSession, "llm", f"tokens-{uuid.uuid4().hex[:12]}")
    write_token_files(docs, tokenizer_file, path)
    return read_token_files(docs.sparkSession, path)
