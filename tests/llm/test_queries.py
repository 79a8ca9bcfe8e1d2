"""The registered queries on a small data directory against the plain versions in
``brute.py``, and the edge rows every operator must take."""

import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kestrel.llm import queries as Q

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 977}" for i in range(60_000))
EDGE = [
    (0, None, None, "s", 1), (1, "", "en", None, 0), (2, "   \n\t ", "en", "s", None), (3, "one", "fr", "s", 3),
    (4, "Released under the MIT License. password=hunter2secret", "en", "s", 3), (5, LONG, "en", "s", 3),
    (6, LONG + " end", "en", "s", 3), (7, LONG, "en", "s", 3), (8, "12 34 !!", "de", "s", 3),
    (9, "naïve <|endoftext|> ünïcödé 　x", "de", "s", 3), (9, "naïve <|endoftext|> ünïcödé 　x", "de", "s", 3),
    (None, "no id here at all", "en", "s", 3), (10, "a b c d e f g h " * 4, "en", "s", 3),
]
ITEMS = [(1, LONG[:200]), (1, LONG[:200]), (2, "one"), (3, None), (4, ""), (None, "no id here at all")]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """Edge rows; documents also carry columns named like results."""
    path = str(tmp_path_factory.mktemp("edge"))
    docs = spark.createDataFrame(EDGE, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.selectExpr("*", "'x' AS n_words", "1 AS kept", "2 AS score", "3 AS start", "4 AS size", "5 AS label", "6 AS row")
    docs.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    urls = [(1, "https://A.example.org/es/1?q"), (2, None), (3, "no scheme"), (4, "http://x.com/de/"), (4, "http://x.com/de/"),
            (5, "http://x.com/other#f"), (6, "http://y.net"), (7, "://"), (None, "http://notcom/de/")]
    spark.createDataFrame(urls, "page_id bigint, url string").selectExpr("*", "1 AS host").write.parquet(f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="module")
def empty_dir(spark, edge_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "pages"):
        spark.read.parquet(f"{edge_dir}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    for name, schema in (("embeddings", "vec_id bigint, embedding array<float>, label int"),
                         ("conversations", "conv_id bigint, turn bigint, role string, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{path}/{name}.parquet")
    return path


def rows(spark, name, path):
    return Q.QUERIES[name](spark, path).collect()


def documents(spark, path):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]


def bag(items):
    return sorted(items, key=repr)


@pytest.fixture(scope="module", params=["sf", "edge"])
def data(request, spark, edge_dir):
    path = SF if request.param == "sf" else edge_dir
    return path, documents(spark, path)


def test_op1(spark, data):
    path, docs = data
    got = rows(spark, "op1_quality_rules", path)
    assert bag(tuple(r)[:7] for r in got) == bag((d, *brute.quality(t)) for d, t in docs)
    assert not any(r["kept"] for r in got if r["base_failed"])


def test_op2(spark, data):
    path, docs = data
    got = rows(spark, "op2_secret_scans", path)
    want = {d: brute.secret_spans(t) for d, t in docs}
    assert bag(tuple(r)[:5] for r in got) == bag((d, *brute.secret_spans(t)[:4]) for d, t in docs)
    for r in got:
        assert set(filter(None, want[r["doc_id"]][4].split(","))) <= set(r["spans"].split(","))


def test_op3_and_op10(spark, data):
    path, docs = data
    tok = Tokenizer.from_file(Q.TOKENIZER)
    ids = [(d, tok.encode(t or "", add_special_tokens=False).ids) for d, t in docs]
    start, want = 0, []
    for d, x in sorted(ids, key=lambda r: (r[0] is not None, r[0] or 0)):
        want.append((d, start, len(x) + 1, brute.crc(x + [2])))
        start += len(x) + 1
    assert bag(tuple(r) for r in rows(spark, "op3_token_files", path)) == bag(want)

    pieces = rows(spark, "op10_packing", path)
    assert sum(r["length"] for r in pieces) == start
    whole = {}
    for r in pieces:
        assert r["offset"] + r["length"] <= 2048
        whole.setdefault(r["doc_id"], []).append(r)
    if len({d for d, _ in ids}) == len(ids):
        for d, x in ids:
            at = 0
            for r in sorted(whole[d], key=lambda r: r["start"]):
                assert r["start"] == at and r["doc_tokens"] == len(x) + 1
                assert r["ids_crc32"] == brute.crc((x + [1])[at:at + r["length"]])
                at += r["length"]
            assert at == len(x) + 1
    by_sequence = {}
    for r in pieces:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by_sequence.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
    assert sum(sum(n for _, n in own) < 2048 for own in by_sequence.values()) <= 1


def test_op4(spark, data):
    path, docs = data
    got = rows(spark, "op4_license_scans", path)
    assert bag((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got) == bag(
        (d, *brute.license_base(t)) for d, t in docs)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_op5(spark, data):
    path, docs = data
    items = [("" if r[0] is None else r[0], r[1]) for r in spark.read.parquet(f"{path}/benchmark.parquet").collect()]
    docs = [(d, t) for d, t in docs if t != LONG + " end"] if path != SF else docs
    got = [r for r in rows(spark, "op5_benchmark_decontamination", path) if path == SF or r["doc_id"] != 6]
    assert bag(tuple(r)[:6] for r in got) == bag((d, *brute.contamination(t, items)) for d, t in docs)


def test_op6(spark, data):
    path, docs = data
    known = [(d, t) for d, t in docs if d is not None]
    want = brute.components(known)
    got = rows(spark, "op6_jaccard_join", path)
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got if r["doc_id"] is not None) == bag(
        (d, *want[d]) for d, _ in known)
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] is None


def test_op7(spark, data):
    path, docs = data
    got = rows(spark, "op7_language_id", path)
    assert len(got) == len(docs)
    texts = dict(docs)
    langs = {r[0] for r in spark.read.parquet(f"{path}/documents.parquet").select("lang").distinct().collect()}
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
            letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letters) and (not letters or r["lang_pred"] in langs)
        assert 0 <= r["score"] <= 1


def test_op7_accuracy(spark):
    path = "/root/testdata/sf0.01"
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in rows(spark, "op7_language_id", path) if r["held_out"]]
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in got]) > 0.98


def test_op8_edges(spark, edge_dir):
    got = {r["page_id"]: tuple(r)[1:] for r in rows(spark, "op8_url_filters", edge_dir)}
    assert got == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("", "", None, "allow"), 3: ("", "", None, "allow"),
        4: ("x.com", "/de/", "com/de/", "block"), 5: ("x.com", "/other", None, "block"), 6: ("y.net", "", None, "allow"),
        7: ("", "", None, "allow"), None: ("notcom", "/de/", None, "allow")}


def test_op9(spark, data):
    path, docs = data
    tok = Tokenizer.from_file(Q.TOKENIZER)
    want = []
    for d, t in docs:
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        want.append((d, len((t or "").encode()), n, n > 512))
    got = rows(spark, "op9_token_counts", path)
    assert bag(tuple(r)[:4] for r in got) == bag(want)
    texts = dict(docs)
    for r in got:
        if r["over_limit"]:
            cut = texts[r["doc_id"]].encode()[:r["limit_bytes"]].decode()
            assert len(tok.encode(cut, add_special_tokens=False).ids) <= 512


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_empty_tables(spark, empty_dir, name):
    assert rows(spark, name, empty_dir) == []


def test_pipeline(spark, edge_dir, empty_dir):
    assert corpus_pipeline.run(spark, empty_dir).collect() == []
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, edge_dir)
        assert "n_words" in docs.columns and "label" in docs.columns
        kept.append({r["doc_id"] for r in docs.collect()})
    assert kept[0] == {3, 4, 5, 6, 7, 9, 10, None}
    assert kept[1] == {3, 4, 5, 9, 10, None}
    assert kept[2] == {4, 9, 10} and kept[3] == kept[2]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert "hunter2" not in text[4] and text[4].startswith("Released under the MIT License.")
    assert docs.count() == 3
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, edge_dir).collect()
    assert {r["doc_id"] for r in pieces} == {4, 9, 10}


def _repeated_ids():
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(80)) for x in "abcde")
    near = b.replace("b40", "other")
    # 5 has a copy and a text of its own, 7 two texts, 8 a near copy and a text of its own
    return {(3, a), (5, a), (5, b), (9, near), (7, c), (7, d), (8, c + " end"), (8, e)}


def test_op6_repeated_ids_with_different_texts(spark, tmp_path):
    docs = sorted(_repeated_ids())
    spark.createDataFrame([*docs, docs[0]], "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = brute.components(docs)
    got = rows(spark, "op6_jaccard_join", str(tmp_path))
    assert {(r["doc_id"], r["component_id"]) for r in got} == {(d, want[d][1]) for d, _ in docs}
    assert want[9][1] == 3


def test_pipeline_keeps_different_texts_of_an_id(spark):
    docs = _repeated_ids()
    df = spark.createDataFrame([*sorted(docs), *sorted(docs)], "doc_id bigint, text string").selectExpr("*", "'x' AS _key")
    left = corpus_pipeline.drop_near_duplicates(spark, df, "")
    assert left.columns == df.columns
    gone = {r for r in docs if r in {(5, next(t for i, t in docs if i == 3)), (9, next(t for i, t in docs if i == 9))}
            or r[1].endswith("end")}
    assert len(gone) == 3 and bag((r["doc_id"], r["text"]) for r in left.collect()) == bag(docs - gone)


def test_language_stage_without_labels(spark, edge_dir):
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet").withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, docs, edge_dir)
    assert {r["doc_id"] for r in kept.collect()} == {3, 4, 5, 6, 7, 9, 10, None}
