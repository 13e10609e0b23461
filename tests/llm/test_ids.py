"""Ids that a double can't hold, beside null ids in the same task: the results are those of small ids, renamed."""

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyvault.llm import decontamination, html_extract, jaccard_join, license_scan, line_dedup, pii, quality_rules, sentencepieces, substring_dedup, token_files

TEXT = " ".join(f"Word{k}" for k in range(60))
OTHER = " ".join(f"other{k}" for k in range(80))
ROWS = [(1, TEXT), (2, "x " + TEXT), (2, OTHER), (3, TEXT + " end"), (None, "y " + TEXT + "\nmail a@b.cd"), (None, " ".join(f"u{k}" for k in range(70))),
        (4, " ".join(f"v{k}" for k in range(70)) + " 10.0.0.1"), (4, None), (5, TEXT)]


def big(i):
    return None if i is None else (1 << 60) + 2 * i + 1


def both(spark):
    """The rows under small and under big ids, in one task each."""
    for name in (lambda i: i, big):
        yield spark.createDataFrame([(name(i), t, "h") for i, t in ROWS], "doc_id long, text string, source string").coalesce(1), name


PIECES, BYTES = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def items(spark):
    return spark.createDataFrame([(9, OTHER), (None, " ".join(f"u{k}" for k in range(70)))], "item_id long, text string")


OPERATORS = {
    "pieces": lambda s, d: sentencepieces.encode_and_decode(d, PIECES),
    "leaks": lambda s, d: decontamination.find_leaks(d, items(s)),
    "without_leaks": lambda s, d: decontamination.without_leaks(d, items(s)),
    "licences": lambda s, d: license_scan.scan(d),
    "personal": lambda s, d: pii.find_personal_data(d),
    "jaccard": lambda s, d: jaccard_join.jaccard_report(d),
    "one_of_each": lambda s, d: jaccard_join.one_of_each(d),
    "substrings": lambda s, d: substring_dedup.substring_report(d),
    "quality": lambda s, d: quality_rules.quality_report(d),
    "keep_good": lambda s, d: quality_rules.keep_good(d),
    "lines": lambda s, d: line_dedup.line_report(d),
    "frequent_lines": lambda s, d: line_dedup.drop_frequent_lines(d, keep="first"),
    "pages": lambda s, d: html_extract.extract_main_text(d.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.concat(F.lit("<p>"), "text").alias("html"))),
}
IDS = {"doc_id", "component_id", "page_id"}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_big_ids_beside_nulls(spark, name):
    found = []
    for docs, named in both(spark):
        rows = OPERATORS[name](spark, docs).collect()
        if named is big:
            found.append(sorted((tuple(r) for r in rows), key=str))
        else:
            found.append(sorted((tuple(big(v) if c in IDS else v for c, v in r.asDict().items()) for r in rows), key=str))
    assert found[0] == found[1]
    if name == "one_of_each":
        assert len(found[1]) == 5          # TEXT and its like, OTHER, u, v, and the empty one


def test_token_files_with_big_and_null_ids(spark, tmp_path):
    found = []
    for docs, named in both(spark):
        path = f"{tmp_path}/{named(0)}"
        token_files.write_token_files(docs, BYTES, path)
        rows = token_files.read_token_files(spark, path, with_ids=True).collect()
        found.append(sorted((r.start, str(r.doc_id if named is big else big(r.doc_id)), r.n_tokens, r.ids_crc32, tuple(r.ids)) for r in rows))
    assert found[0] == found[1]


def test_token_files_of_awkward_texts(spark, tmp_path):
    """Strings of added tokens, a million spaces or letters, white space of all kinds: the library's ids, inside Spark."""
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(BYTES)
    texts = ["a <|endoftext|> b", "x  <|endoftext|>  y", " " * 1_000_000, "a" * 200_000, "\n" * 100_000 + " b", "a \x1c b  c　d  \t e ", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    token_files.write_token_files(docs, BYTES, f"{tmp_path}/files")
    for r in token_files.read_token_files(spark, f"{tmp_path}/files", with_ids=True).collect():
        expected = [*library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids, 2]
        assert r.n_tokens == len(expected)
        assert hashlib.sha256(str(list(r.ids)).encode()).digest() == hashlib.sha256(str(expected).encode()).digest()


def test_pipeline_stages_keep_big_ids(spark, tmp_path):
    docs = spark.createDataFrame([(big(i), t, "h", "en", 1) for i, t in ROWS], "doc_id long, text string, source string, lang string, n_chars long").coalesce(1)
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert {r.doc_id for r in docs.collect()} <= {big(i) for i, _ in ROWS}, name
    assert sorted((r.doc_id for r in docs.collect()), key=str) == sorted([big(1), big(4)], key=str)
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()} == {big(1), big(4)}
