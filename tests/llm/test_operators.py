"""Each training-data operator against a plain version, on the small tables and on odd rows."""


import os
import random
import struct
import tracemalloc
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
import plain
from tallyvault.llm import (block_labeller, decontamination, html_blocks, html_extract, jaccard_join, license_scan, line_dedup,
                            pii, quality_rules, sentencepieces, shingles, substring_dedup, token_files)
from tallyvault.llm import queries as Q

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
LONG = " ".join(f"w{k % 977}" for k in range(30_000))
BASE = " ".join(f"Word{k}" for k in range(60))
ODD = [(1, BASE, "a"), (2, BASE, "a"), (2, BASE, "a"), (3, None, None), (4, "", "a"), (None, BASE + " end", "b"), (5, LONG, "b"),
       (6, "short", "b"), (7, " \t\n\x0b ", "b"), (8, "SHORT", None), (9, "x " + BASE.replace("Word7 ", "Word8 "), "a")]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{plain.SF}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.source, r.text) for r in docs.select("doc_id", "source", "text").collect()]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows with extra columns whose names the operators use inside."""
    return spark.createDataFrame(ODD, "doc_id long, text string, source string").selectExpr(
        "*", "1 AS digest", "2 AS row", "3 AS kept", "array(1) AS drops", "'x' AS host", "4 AS row_id", "5 AS n_chars")


def as_set(rows):
    return sorted(rows, key=str)


def collected(df, *cols):
    return as_set(tuple(r) for r in (df.select(*cols) if cols else df).collect())


@pytest.fixture(scope="module")
def library():
    import sentencepiece
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_pieces_equal_the_library_on_any_text(library):
    coder = sentencepieces.coder(PIECES)
    r = random.Random(1)
    alphabet = [chr(k) for k in range(32, 127)] + list("éèüßñ中文字の🙂\n\t ▁ａ\x00")
    texts = ["", " ", "  a  b ", "▁", "<s>", "a" * 300, " " * 40 + "x", " ,", "jMO\tp ,"]
    texts += ["".join(r.choices(alphabet, k=r.randint(1, 30))) for _ in range(2000)]
    texts += ["".join(r.choices("aeinrst ", k=r.randint(1, 40))) for _ in range(2000)]
    for t in texts:
        ids = library.encode(t)
        assert coder.encode(t) == ids, t
        assert coder.decode(ids) == library.decode(ids), t
        assert coder.round_trip(t) == (len(ids), ",".join(map(str, ids)), library.decode(ids)), t
    for _ in range(300):
        ids = [r.choice([r.randint(3, 258), r.randint(259, 31999)]) for _ in range(6)]
        assert coder.decode(ids) == library.decode(ids)


def test_op1_on_whole_tables_and_odd_rows(spark, odd, rows, library):
    def expected(pairs):
        out = []
        for d, t in pairs:
            ids = library.encode(t or "")
            out.append((d, len(ids), plain.sha(",".join(map(str, ids))), plain.sha(library.decode(ids))))
        return as_set(out)
    assert collected(Q.op1_sentencepiece(spark, plain.SF)) == expected((d, t) for d, _, t in rows)
    assert collected(sentencepieces.encode_and_decode(odd, PIECES)) == expected((d, t) for d, t, _ in ODD)
    assert sentencepieces.encode_and_decode(odd.limit(0), PIECES).count() == 0
    r = sentencepieces.encode_and_decode(odd.where("doc_id = 1"), PIECES, with_ids=True).first()
    assert r.decoded == BASE and list(r.ids) == library.encode(BASE)


def test_op2_finds_leaks_and_only_leaks(spark, docs, rows, odd):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    expected = as_set((d, i) for d, _, t in rows for i in plain.leak(t, items))
    assert expected and collected(Q.op2_decontamination(spark, plain.SF), "doc_id", "item_id") == expected
    bench = spark.createDataFrame([(1, " ".join(f"wOrd{k}" for k in range(10, 40))), (2, None), (None, "short"), (3, "")], "item_id long, text string")
    found = decontamination.find_leaks(odd, bench)
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(d, 1) for d in (1, 2, 9, None)} | {(6, None), (8, None)}
    r = found.where("doc_id = 9").first()
    assert (r.similarity, r.first_word, r.end_word) == (1.0, 11, 41)
    left = decontamination.without_leaks(odd, bench)
    assert left.columns == odd.columns and sorted(r.doc_id for r in left.collect()) == [3, 4, 5, 7]
    assert decontamination.find_leaks(odd.limit(0), bench).count() == 0
    assert decontamination.find_leaks(odd, bench.limit(0)).count() == 0


def _benchmark_of(items):
    keys, n = np.unique(np.concatenate([decontamination.shingle_set(t, decontamination.SIZE) for _, t in items]), return_counts=True)
    return decontamination.Benchmark(tuple(items), (keys[n > 1].tobytes(), n[n > 1].astype(np.int64).tobytes()))


def test_op2_finds_leaks_of_text_that_many_items_share():
    r = random.Random(5)
    for k, n in ((10, 229), (5, 134), (3, 100), (1, 60)):
        base = [f"w{k}x{j}" for j in range(n)]
        items = [(i, " ".join(base)) for i in range(k)] + [(90, " ".join(f"o{j}" for j in range(n)))]
        b, leaked = _benchmark_of(items), 0
        for d in range(12):
            text = [f"d{j}" for j in range(9)] + base + [f"e{j}" for j in range(9)]
            text[9 + r.randrange(n)] = f"new{d}"
            found = b.leaks(" ".join(text))
            assert sorted(x[0] for x in found) == sorted(plain.leak(" ".join(text), items))
            leaked += len(found)
        assert leaked == 12 * k


def test_op2_slices_give_what_the_whole_benchmark_gives(spark, monkeypatch):
    r = random.Random(6)
    base = [[f"w{k}x{j}" for j in range(40)] for k in range(6)]
    items = [(10 * k + i, " ".join(base[k] + [f"i{k}{i}y{j}" for j in range(30)])) for k in range(6) for i in range(3)]
    rows = []
    for d, (_, t) in enumerate(items * 2):
        w = t.split()
        w[r.randrange(8, 34) if d % 2 else r.randrange(46, 65)] = f"new{d}"
        rows.append((d, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    expected = as_set((d, i) for d, t in rows for i in plain.leak(t, items))
    assert 0 < len(expected) and collected(decontamination.find_leaks(docs, bench), "doc_id", "item_id") == expected
    monkeypatch.setattr(decontamination, "SLICE_BYTES", 2000)
    assert len(decontamination.slices(bench)) > 3
    assert collected(decontamination.find_leaks(docs, bench), "doc_id", "item_id") == expected
    left = decontamination.without_leaks(docs, bench)
    assert {x.doc_id for x in left.collect()} == {d for d, _ in rows} - {d for d, _ in expected}


def test_multi_index_gives_every_item_within_the_radius():
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    index = decontamination.SameSize(list(range(40)), marks)
    probes = np.concatenate([marks ^ np.uint64(sum(1 << int(b) for b in rng.choice(64, n, replace=False))) for n in range(0, 26)])
    near = np.bitwise_count(probes[:, None] ^ marks) <= decontamination.RADIUS
    assert {(int(a), int(b)) for a, b in zip(*index.within_radius(probes))} == {(int(a), int(b)) for a, b in zip(*np.nonzero(near))}


def test_op3_canonical_forms(spark):
    assert all(any(m in text.lower() for m in license_scan.MARKERS) for _, text in license_scan.KNOWN)
    mit = license_scan.KNOWN[0][1]
    rows = [(1, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(", ", " ,\n  ")), (2, "text\nLICENSED under the Apache Licence -- version 2.0\nmore"),
            (3, mit + " and more"), (4, None), (5, ""), (6, "All rights reserved.\nall rights RESERVED"), (6, "All rights reserved."), (None, "Licensed under the GNU GPL v3.")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS digest", "2 AS license")
    assert collected(license_scan.scan(d)) == as_set([
        (1, "MIT", True, 0), (2, "Apache-2.0", False, 1), (6, "all-rights-reserved", False, 2), (6, "all-rights-reserved", True, 1),
        (None, "GPL-3.0", True, 1)])
    assert license_scan.scan(d.limit(0)).count() == 0


def test_op3_whole_texts_and_their_forms(spark):
    folder = "/usr/share/common-licenses"
    names = {"Apache-2.0": "Apache-2.0", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1",
             "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0", "BSD": "BSD-3-Clause"}
    names = {f: n for f, n in names.items() if os.path.exists(f"{folder}/{f}")}
    texts = {f: open(f"{folder}/{f}", encoding="utf-8").read() for f in names}
    rows = [(n, texts[f]) for f, n in names.items()]
    rows += [("GPL-3.0", texts["GPL-3"].split("END OF TERMS")[0])] if "GPL-3" in texts else []
    known = license_scan.KNOWN
    bsd3 = next(t for n, t in known if n == "BSD-3-Clause")
    rows += [("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, Someone\nAll rights reserved.\n\n{bsd3}"),
             ("MIT", "MIT License\n\nCopyright © 2020 Someone\n\n" + known[0][1].replace('"Software"', "\u201cSoftware\u201d").replace(", ", ",\u00a0")),
             ("MIT", known[0][1].replace("The above copyright", "The above\ncopyright").replace("OR COPYRIGHT", "OR\nCOPYRIGHT")),
             ("all-rights-reserved", "Copyright 2020 Someone\nAll rights reserved.")]
    d = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    assert {(r.doc_id, r.license) for r in license_scan.scan(d).where("whole_text").collect()} == {(k, n) for k, (n, _) in enumerate(rows)}
    # the SQL says the same of whole texts, of changed ones, and of lines that do or don't name a holder
    rows += [(None, t) for t in (None, "", "copyright notice\n" + known[0][1], "(c) copyright\nall rights reserved", "x\n(c) 2020\n All Rights Reserved.\n" + known[0][1],
                                 "COPYRIGHT [yyyy]\n" + known[0][1] + "\n\u00a9 me", "Copyright the owner\n" + known[0][1], "copyright licensing co\n" + known[0][1],
                                 known[0][1] + "\nCopyright 2020\nall rights reserved", known[0][1].replace(" ", "\u2003\u200b"), known[0][1][:-9])]
    d = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(rows)], "doc_id long, text string")
    con = duckdb.connect()
    con.register("documents", d.toPandas())
    assert collected(license_scan.scan(d)) == as_set(con.execute(Q.op3_sql()).fetchall())


def test_op4_base_spans_and_added_ones(spark, odd, rows):
    r = random.Random(3)
    for n in range(20_000):
        t = "".join(r.choices("a@.-+0123 (1)b%" if n % 2 else "0123456789.- +@a", k=r.randint(0, 30)))
        assert [x[:3] for x in pii.spans(t) if x[0] in pii.KINDS[:4]] == plain.base_spans(t), t
    text = "My IBAN is GB82 WEST 1234 5698 7654 32 OK, social security 123-45-6789, not 123-45-6780"
    assert [x[0] for x in pii.spans(text)] == ["iban", "national_id", "national_id"] and not pii.spans("number 123-45-6789")
    assert pii.redacted(text, pii.spans(text)[:1]).startswith("My IBAN is <iban> OK")
    near, far = (pii.spans(x + "4111 1111 1111 1111")[0][3] for x in ("pay by card ", "serial "))
    assert near > far
    for text in ("at midnight 123-45-6789", "a hotel ssns 123-45-6789", "x" * 60 + "ssn 123-45-6789", "123-45-6789 " + "a " * 22 + "dniz"):
        assert not pii.spans(text), text                                  # parts of words are no context
    for text in ("123-45-6789 is my SSN", "Social\nSecurity: 123-45-6789", "(dni)123-45-6789"):
        assert [x[0] for x in pii.spans(text)] == ["national_id"], text   # whole words on both sides are
    pii.spans("1" * 50_000 + "@" * 20_000 + "a" * 50_000)                 # long runs take linear time
    got = {x.doc_id: x for x in Q.op4_pii(spark, plain.SF).collect()}
    for d, _, t in rows:
        base = plain.base_spans(t or "")
        assert got[d].base_sha256 == plain.sha(",".join(f"{k}:{a}:{b}" for k, a, b in base))
        assert [got[d].n_email, got[d].n_ip, got[d].n_card, got[d].n_phone] == [sum(x[0] == k for x in base) for k in pii.KINDS[:4]]
    assert pii.find_personal_data(odd).count() == len(ODD) and pii.find_personal_data(odd.limit(0)).count() == 0


def test_op5_links_as_all_pairs_do(spark, docs, rows, odd):
    assert collected(Q.op5_jaccard_join(spark, plain.SF)) == as_set(plain.components([(d, t) for d, _, t in rows], 3, 90))
    expected = [(d, n, None if c == plain.LAST else c) for d, n, c in plain.components([(d, t) for d, t, _ in ODD], 3, 80)]
    assert collected(jaccard_join.jaccard_report(odd, 3, 80)) == as_set(expected)
    assert jaccard_join.jaccard_report(odd.limit(0)).count() == 0
    left = jaccard_join.one_of_each(odd, 3, 80)
    assert left.columns == odd.columns and as_set(r.doc_id for r in left.collect()) == [1, 3, 4, 5, 6, 7]


def test_shingles_of_equal_fingerprint_under_a_fixed_key_stay_apart(spark):
    """Words searched so that the first two of each pair have the fingerprint of the other two without a key."""
    pairs = [("a1843969 b3435980", "a2552772 b1160978"), ("a1258775 b3836334", "a1187871 b3799049"), ("a1004087 b2618753", "a468135 b1247216")]
    rows = [(10 * k + j, t) for k, (a, b) in enumerate(pairs) for j, t in enumerate((f"{a} z", f"{b} z", f"{a} z {b} z", f"{b} Z {a} z", f"{b}\tZ"))]
    assert collected(jaccard_join.jaccard_report(spark.createDataFrame(rows, "doc_id long, text string"))) == as_set(plain.components(rows, 3, 90))
    keys = {len(shingles.shingle_set(pairs[0][0] + " z " + pairs[0][1] + " z", 3, k)) for k in (1, 2, 1 << 63, (1 << 64) - 1)}
    assert keys == {4} and len(shingles.shingle_set(pairs[0][0] + " z " + pairs[0][1] + " z", 3)) == 3


def test_one_of_each_keeps_one_of_every_group_whatever_the_ids(spark):
    texts = [" ".join(f"t{n}w{k}" for k in range(40)) for n in range(6)]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[1] + " end"), (7, texts[2]), (7, texts[3]), (8, texts[3] + " end"),
            (9, texts[4]), (9, texts[4]), (None, texts[4] + " end"), (None, texts[5]), (None, texts[5]), (None, None), (7, "")]
    left = [(r.doc_id, r.text) for r in jaccard_join.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    one = [x for x in left if x[1] not in (texts[1], texts[1] + " end")]
    assert as_set(one) == as_set([(None, texts[0]), (7, texts[2]), (7, texts[3]), (9, texts[4]), (None, texts[5]), (None, None), (7, "")])
    assert len(left) == len(one) + 1


def _shuffles_above(df, what):
    """How many shuffles the rows made by the first step that shows ``what`` go through."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" :+-*")) for x in lines]
    at = max(k for k, x in enumerate(lines) if what in x)
    found, d = 0, depth[at]
    for k in range(at, -1, -1):
        if depth[k] < d:
            found, d = found + ("Exchange" in lines[k]), depth[k]
    return found


def test_heads_and_texts_are_dealt_once(spark, monkeypatch):
    """Of what the join moves, heads and texts are most: each goes through one shuffle."""
    texts = [" ".join(f"t{n // 3}w{k}" for k in range(40 + n % 3)) for n in range(12)]
    docs = spark.createDataFrame([(n, texts[n % 12]) for n in range(36)], "doc_id long, text string").coalesce(1)
    moved, real = {}, jaccard_join.stored

    def told(df, name):
        moved.setdefault(name, df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return real(df, name)

    heads = jaccard_join.signatures(docs, 5, 80, 7).where("size(head) > 0").groupBy("class_id").count().collect()
    assert len(heads) == 12 and {r["count"] for r in heads} == {1}  # copies in one task give their head once
    monkeypatch.setattr(jaccard_join, "stored", told)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = jaccard_join.one_of_each(docs)
        assert moved["places"] == 1 and _shuffles_above(left, "AS row#") == 1
        assert as_set(r.doc_id for r in left.collect()) == [0, 3, 6, 9]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_regions_join_as_all_pairs_do():
    rng = np.random.default_rng(1)
    for _ in range(40):
        base, sets = rng.integers(0, 1 << 60, 200).astype(np.uint64), []
        for _ in range(int(rng.integers(2, 100))):
            s = base.copy() if rng.random() > 0.2 else rng.integers(0, 1 << 60, int(rng.integers(1, 200))).astype(np.uint64)
            k = min(len(s), int(rng.integers(0, 25)))
            s[rng.integers(0, len(s), k)] = rng.integers(0, 1 << 60, k).astype(np.uint64)
            sets.append(np.unique(s))
        pairs = [(a, b) for a in range(len(sets)) for b in range(a)
                 if 100 * (i := len(np.intersect1d(sets[a], sets[b]))) >= 90 * (len(sets[a]) + len(sets[b]) - i)]
        got = list(jaccard_join.region_links(sets, 90))
        assert len(got) < len(sets) and _groups(len(sets), got) == _groups(len(sets), pairs)


def _groups(n, links):
    label = list(range(n))
    for a, b in links:
        label = [label[a] if x == label[b] else x for x in label]
    return sorted(tuple(k for k in range(n) if label[k] == g) for g in set(label))


def test_op6_words_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 1023, 1024, 1025, 5000):
        for high in (1, 2, 300, 50257, 1 << 31, 1 << 59, (1 << 64) - 1):
            v = rng.integers(0, high, n, dtype=np.uint64)
            words, offsets, exceptions = token_files.pack(v)
            assert (token_files.unpack(words, offsets, exceptions, n) == v).all()


def test_op6_files_hold_the_library_s_ids(spark, odd, rows):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(BYTES)
    t.encode_special_tokens = True
    encode = token_files.encoder(BYTES)
    r = random.Random(2)
    alphabet = [chr(k) for k in range(300)] + list("中文ßÑ🙂🏽​ 　'sIt've<|endoftext|>½²Ⅷ́")
    for _ in range(3000):
        x = "".join(r.choices(alphabet, k=r.randint(0, 25)))
        assert encode(x) == t.encode(x, add_special_tokens=False).ids, x

    def expected(pairs):
        start, out = 0, []
        for d, x in pairs:
            ids = [*t.encode(x or "", add_special_tokens=False).ids, 2]
            out.append((d, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
            start += len(ids)
        return as_set(out)
    assert collected(Q.op6_token_files(spark, plain.SF)) == expected(sorted((d, x) for d, _, x in rows))
    assert collected(token_files.token_report(odd, BYTES)) == expected(sorted(((d, x) for d, x, _ in ODD), key=lambda y: (y[0] is not None, y[0] or 0)))
    assert token_files.token_report(odd.limit(0), BYTES).count() == 0


def test_op7_removes_what_all_windows_say(spark, rows):
    assert collected(Q.op7_substring_dedup(spark, plain.SF)) == as_set(plain.substrings([(d, t) for d, _, t in rows]))
    w = [f"w{k}" for k in range(40)]
    small = [(1, " ".join(w)), (2, " ".join(w)), (2, "x " + " ".join(w[:13]) + " y"), (3, " ".join(w[5:30] + w[:20])), (None, " ".join(w)),
             (4, None), (5, ""), (1, "  ".join(w)), (7, "a " * 30), (8, "a " * 14), (9, LONG), (10, LONG + " z")]
    d = spark.createDataFrame(small, "doc_id long, text string").selectExpr("*", "1 AS owner", "2 AS key", "3 AS digest")
    assert collected(substring_dedup.substring_report(d)) == as_set(plain.substrings(small))
    assert substring_dedup.substring_report(d.limit(0)).count() == 0


def test_op7_hot_anchors_are_dealt_out(spark, monkeypatch):
    r = random.Random(7)
    line = [f"hot{k}" for k in range(20)]
    rows = [(d if d % 9 else None, " ".join([*r.choices("abc", k=14), *line, *r.choices("abc", k=14), *(line if d % 5 == 0 else [])])) for d in range(60)]
    rows += [(3, " ".join(line[2:18])), (70, LONG), (71, "q " * 40), (71, "q " * 50)]
    sharded, seen = substring_dedup.sharded_intervals, []

    def watched(parts):
        seen.append(parts.selectExpr("key", "length(words) AS n").groupBy("key").sum("n").toDF("key", "n").agg({"n": "max"}).first()[0] or 0)
        return sharded(parts)
    monkeypatch.setattr(substring_dedup, "sharded_intervals", watched)
    monkeypatch.setattr(substring_dedup, "HOT_BYTES", 500)
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(substring_dedup.substring_report(d)) == as_set(plain.substrings(rows))
    assert seen[0] <= 500


def test_op7_keeps_no_step_s_files(spark):
    """When the operator returns, the shuffle files of its steps are gone, and so are the tables that nothing reads any more."""
    from tallyvault.plans.storage import folders, scratch_path

    def shuffles():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    r = random.Random(11)
    line = " ".join(f"line{k}" for k in range(30))
    rows = [(d, " ".join([*r.choices("abcdef", k=20), line, *r.choices("abcdef", k=20)])) for d in range(80)]
    before, tables, setting = shuffles(), set(folders(spark, scratch_path(spark, "llm", "*"))), spark.conf.get(name)
    report = substring_dedup.substring_report(spark.createDataFrame(rows, "doc_id long, text string"))
    assert not shuffles() - before
    assert sorted(f.split("/")[-1].split("-")[0] for f in set(folders(spark, scratch_path(spark, "llm", "*"))) - tables) == ["documents", "repeats"]
    assert spark.conf.get(name) == setting
    assert collected(report) == as_set(plain.substrings(rows)) == collected(report)


def test_op7_windows_in_a_row_with_one_holder_are_one_row():
    w = [f"w{k}".encode() for k in range(40)]
    texts = [w[:20], w[:30], [b"x", *w[5:25]], w[20:]]
    rows = pd.DataFrame({"key": [1, 1, 1, 2], "words": [b" ".join(t) for t in texts], "least": [1, 2, 0, 5], "most": [3, 4, 0, 5]})
    told = substring_dedup._told(rows)
    windows = {t: [tuple(t[k:k + 13]) for k in range(len(t) - 12)] for t in map(tuple, texts)}
    expected = []
    for t, most in zip(texts, rows["most"]):
        for k, x in enumerate(windows[tuple(t)]):
            least = min(n for u, n in zip(texts, rows["least"]) if x in windows[tuple(u)])
            if least < most:
                expected.append((substring_dedup._mark(b" ".join(t)), k, least))
    assert [(m, k, h) for m, a, b, h in zip(told["mark"], told["at"], told["upto"], told["holder"]) for k in range(a, b + 1)] == expected
    assert len(told) < len(expected)
    assert not len(substring_dedup._told(rows[:0])) and not len(substring_dedup._told(rows[3:].reset_index(drop=True)))


def test_op7_index_gives_first_owners_whatever_fits_in_it():
    r = random.Random(4)
    for _ in range(20):
        texts = [list(x) for x in {tuple(r.choices([b"a", b"b", b"c"], k=r.randint(0, 30))) for _ in range(30)}]
        owners = np.array([r.randint(0, 9) for _ in texts])
        first = {}
        for t, o in zip(texts, owners):
            for k in range(len(t) - 3):
                first[tuple(t[k:k + 4])] = min(first.get(tuple(t[k:k + 4]), 99), o)
        for indexed in (10 ** 6, 60):
            least, _ = substring_dedup.first_owners(texts, owners, 4, indexed)
            assert list(least) == [first[tuple(t[k:k + 4])] for t in texts for k in range(len(t) - 3)]


def test_op8_verdicts(spark, odd, rows):
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in Q.op8_quality_rules(spark, plain.SF).collect()}
    assert got == {d: plain.base_counts(t) for d, _, t in rows}
    # a page with one line of its own among lines that 30 pages of the host share
    shared = "\n".join(f"shared line number {k} of the menu of this host" for k in range(8))
    site = [(k, f"{shared}\nown words {k} of page", "h") for k in range(30)] + [(99, BASE, "h"), (98, BASE, None), (97, None, "h"), (97, None, "h")]
    d = spark.createDataFrame(site, "doc_id long, text string, source string").selectExpr("*", "1 AS digest", "2 AS host", "3 AS kept")
    kept = quality_rules.judged(d).where("kept")
    assert sorted(r.doc_id for r in kept.collect()) == [98, 99]
    # lines on 30 pages are boilerplate on a large host too, unless a share of its texts is asked for
    menu = "\n".join(" ".join(f"menu{k}x{i}" for i in range(10)) for k in range(8))
    large = [(k, f"{menu}\nown words {k} of page", "h") for k in range(30)] + [(k, " ".join(f"w{k}x{i}" for i in range(60)), "h") for k in range(100, 3200)]
    large = spark.createDataFrame(large, "doc_id long, text string, source string")
    assert quality_rules.judged(large).where("kept and doc_id < 100").count() == 0
    assert quality_rules.judged(large, min_share=1).where("kept and doc_id < 100").count() == 30
    left = quality_rules.keep_good(d)
    assert left.columns == d.columns and sorted(r.doc_id for r in left.collect()) == [98, 99]
    table = [(d, h, t) for d, t, h in ODD]
    assert sorted(str(r.doc_id) for r in quality_rules.keep_good(odd).collect()) == sorted(str(d) for (d, _, _), ok in zip(table, plain.quality(table)) if ok)
    assert quality_rules.quality_report(odd.limit(0)).count() == 0


def test_op8_repeats_are_repeats_of_words(spark, monkeypatch):
    """Windows whose hash bits agree by chance are told apart by their words (here all bits of all windows agree)."""
    monkeypatch.setattr(quality_rules, "packed_windows", lambda w, shift: F.when(F.size(w) >= 4, F.transform(
        F.sequence(F.lit(0), F.size(w) - 3), lambda i: i.cast("long"))).otherwise(F.array().cast("array<bigint>")))
    texts = ["a b c d e a b c x a b c", "a a a a a", "a b c d", "a b", "", "x y z x y z q x y"]
    d = spark.createDataFrame([(k, "h", t) for k, t in enumerate(texts)], "doc_id long, source string, text string")
    got = {r.doc_id: r.n_repeat_words for r in quality_rules.quality_report(d).collect()}
    assert got == {k: plain.base_counts(t)[4] for k, t in enumerate(texts)}


def test_op9_bitmaps(spark, odd):
    many = "\n".join(f"line {k}" for k in range(200))
    rows = [(k, f"own {k}\n  Common LINE\t\n\n{many}" if k % 2 else "common line") for k in range(24)] + [(50, None), (51, ""), (None, "common line\nz")]
    d = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS drops", "2 AS h1", "7 AS n_chars")
    got = {r.doc_id: r for r in line_dedup.line_report(d).collect()}
    for (i, t), kept in zip(rows[:-1], plain.cut_lines(rows[:-1])):
        lines = (t or "").split("\n")
        assert (got[i].n_lines, got[i].n_dropped, got[i].kept_sha256) == (len(lines), len(lines) - len(kept), plain.sha("\n".join(kept)))
    assert (got[None].n_dropped, got[None].kept_sha256) == (1, plain.sha("z"))
    first = {r.doc_id: r for r in line_dedup.drop_frequent_lines(d.where("doc_id is not null"), keep="first").collect()}
    kept = plain.cut_lines(rows[:-1], keep="first")
    for (i, t), k in zip(rows[:-1], kept):
        if i in (50, 51):
            assert first[i].text == t
        else:
            assert ("\n".join(k).strip() and first[i].text) == ("\n".join(k).strip() and "\n".join(k)) if i in first else not "\n".join(k).strip()
    assert all(r.n_chars == len(r.text) for r in first.values() if r.text)
    assert line_dedup.line_report(d.limit(0)).count() == 0


def test_op10_labels_held_out_pages():
    test = block_labeller.training_set(200, seed=99)
    said = block_labeller.trained().label([p for p, _ in test])
    right = sum((a.astype(int) == np.array(b)).sum() for a, (_, b) in zip(said, test))
    assert right / sum(len(b) for _, b in test) > 0.99


def test_op10_hidden_elements_take_no_text_of_the_page():
    def texts(html):
        return [b.text for b in html_blocks.blocks(html)]
    for start in ("<video-player src=x>", "<object-viewer>", "<svg viewBox='0 0 1 1'/>", "<math/>", "<object data=x />", "<select>", "<canvas>", "<audio src=x>",
                  "<script-x>", "<canvas><canvas>no</canvas>"):
        assert texts(f"<article><p>one {start} two</p><p>three</p></article><p>four <video>no</video>") == ["one two", "three", "four"], start
    assert texts("<p>a <math><mi>x</mi>=<mn>2</mn></math> <object><b>fallback</b></object> <noscript>plain</noscript> z") == ["a x=2 fallback plain z"]
    assert texts("<p>a <select><option>no<option>no</select><svg><svg><text>no</text></svg>no</svg> b") == ["a b"]
    assert texts("<div>a <video>no <p>no</p> no</div><p>b</p></video><p>c") == ["a", "b", "c"]
    assert texts("<p>a<script>if (x) '<canvas>'</script ><p>b<style>no</style>c<textarea>no</textarea><template><p>no</template>d<script>no") == ["a", "bcd"]


def test_op10_deep_pages_share_their_paths():
    deep = 50_000
    for tag in ("div", "li"):
        tracemalloc.start()
        page = html_blocks.blocks(f"<{tag} class='x'>a" * deep + f"</{tag}>" * deep + "<p>b")
        features = [block_labeller.path_features(b.path) for b in page]
        assert tracemalloc.get_traced_memory()[1] < 100 << 20
        tracemalloc.stop()
        assert len(page) == deep + 1 and len(list(page[-2].path)) in (deep, 1) and list(page[-1].path) == ["p"]
        assert features[deep - 1] == features[2]
    assert html_blocks.blocks("<svg>" + "<div>" * deep + "</div>" * deep + "</svg>b")[0].text == "b"


def test_op10_text_of_pages(spark):
    for r in spark.read.parquet(f"{plain.SF}/pages.parquet").collect():
        page = html_blocks.blocks(r.html)
        article = "\n".join(b.text for b in page if any(e.split(" ")[0] == "article" for e in b.path))
        assert html_extract.main_texts([r.html], block_labeller.trained()) == [article]
    rows = [(None, None, None), (1, "u", ""), (2, "u", "<p"), (3, "x", "<nav><a href=1>menu</a></nav><article><p>hi &amp;\n <b>you</b><p>two<script>x"), (3, "x", "<article><p>hi")]
    d = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' AS text")
    assert collected(html_extract.extract_main_text(d)) == as_set([(None, None, "", 0), (1, "u", "", 0), (2, "u", "", 0), (3, "x", "hi & you\ntwo", 12), (3, "x", "hi", 2)])
    assert html_extract.extract_main_text(d.limit(0)).count() == 0


def test_pipeline_equals_its_plain_version(spark, rows, library):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "n-gram Jaccard join", "benchmark decontamination",
                                                      "SentencePiece encoding and decoding"]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{plain.SF}/benchmark.parquet").collect()]
    expected = {d: len(library.encode(t)) for d, t in plain.pipeline(rows, items)}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, plain.SF).collect()} == expected


def test_stages_keep_the_columns_and_take_odd_rows(spark, odd):
    d = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, plain.SF)
        assert out.columns == d.columns
        assert stage(spark, d.limit(0), plain.SF).count() == 0
