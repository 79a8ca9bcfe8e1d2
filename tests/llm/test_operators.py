"""Operators on their own: formats, edge cases and the paths that the small
tables don't reach."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kestrel.llm import bpe, credentials, decontaminate, jaccard, langid, licenses, packing, quality, token_counts, token_files, urls
from kestrel.llm.queries import TOKENIZER

PIECES = ["'s", "'re", "'ll", "'v", " ", "  ", "\n", "\t", "a", "Ba", "ß", "é", "\xa0", "　", "“", "中文", "<|endoftext|>",
          "<|end", "1", "23", "!", "...", "\x1c", "\x85", " ", "\r\n", "😀", "the", " word", "'", "|", "aé,b"]


@pytest.fixture(scope="module")
def texts():
    rnd = random.Random(5)
    return ["".join(rnd.choices(PIECES, k=rnd.randint(0, 12))) for _ in range(1500)]


def test_encoder_equals_the_library(texts):
    tok = Tokenizer.from_file(TOKENIZER)
    encoder = bpe.ChunkEncoder(TOKENIZER)
    for a, b, ids, counts in encoder.encode(pa.array([*texts, None, ""])):
        at = 0
        for text, n in zip([*texts, "", ""][a:b], counts.tolist()):
            assert ids[at:at + n].tolist() == tok.encode(text, add_special_tokens=False).ids, text
            at += n


def test_hash_collisions_of_chunks_are_noticed(texts, monkeypatch):
    tok = Tokenizer.from_file(TOKENIZER)
    monkeypatch.setattr(bpe.T, "span_hashes", lambda buf, start, end: (end - start).astype(np.uint64))
    for a, b, ids, _ in bpe.ChunkEncoder(TOKENIZER).encode(pa.array(texts)):
        assert ids.tolist() == [i for t in texts[a:b] for i in tok.encode(t, add_special_tokens=False).ids]


def test_prefix_counts_of_every_prefix(texts):
    tok = Tokenizer.from_file(TOKENIZER)
    counter = bpe.PrefixCounter(TOKENIZER)
    for text in texts[:400]:
        counts = counter.prefix_counts(text)
        for j in range(len(text) + 1):
            want = len(tok.encode(text[:j], add_special_tokens=False).ids)
            assert counts[len(text[:j].encode())] == want, (text, j)


def test_prefix_table_and_limit(spark):
    df = spark.createDataFrame([(1, "one two three four"), (2, None)], "doc_id long, text string")
    table = {r.doc_id: r.prefix_tokens for r in token_counts.prefix_tables(df, TOKENIZER).collect()}
    assert table[2] == [0] and len(table[1]) == 19 and table[1][-1] == 4
    r = {r.doc_id: r for r in token_counts.token_counts(df, TOKENIZER, 2).collect()}
    assert r[1].limit_bytes == 7 and r[1].over_limit and r[2].limit_bytes == 0


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 5000])
def test_dac_round_trip_and_random_access(n):
    rnd = np.random.default_rng(n)
    ids = rnd.integers(0, [256, 70_000, 1 << 32][n % 3], n).astype(np.uint32)
    dac = token_files.Dac(token_files.dac_encode(ids))
    assert len(dac) == n and np.array_equal(dac.slice(0, n), ids)
    for i in rnd.integers(0, n, min(n, 60)):
        assert dac[int(i)] == ids[i]
        j = int(rnd.integers(i, n + 1))
        assert np.array_equal(dac.slice(int(i), j), ids[i:j])


def test_read_ids_across_documents(spark, tmp_path):
    df = spark.createDataFrame([(i, f"text number {i} " * 5) for i in range(40)], "doc_id long, text string")
    token_files.write_tokens(df, f"{tmp_path}/ids", TOKENIZER, 2)
    tok = Tokenizer.from_file(TOKENIZER)
    want = [x for i in range(40) for x in [*tok.encode(f"text number {i} " * 5).ids, 2]]
    assert token_files.read_ids(spark, f"{tmp_path}/ids", 17, 300) == want[17:317]


def test_hilbert_numbers_are_a_curve():
    side = 8
    cells = np.array([(x, y, z) for x in range(side) for y in range(side) for z in range(side)])
    numbers = packing.hilbert(cells, bits=3)
    assert sorted(numbers) == list(range(side ** 3))
    path = cells[np.argsort(numbers)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def test_copies_lie_side_by_side(spark):
    df = spark.createDataFrame([(i, ["alpha beta gamma", "uno dos tres"][i % 2] * 20) for i in range(20)], "doc_id long, text string")
    rows = packing.pack(df, TOKENIZER, 1, 64).orderBy("sequence_id", "offset").select("doc_id").collect()
    order = list(dict.fromkeys(r.doc_id % 2 for r in rows))
    kinds = [r.doc_id % 2 for r in rows]
    assert kinds == sorted(kinds, key=order.index)


def test_constants_are_handed_on():
    text = 'x = "Zk93jd82kLq0"\nother = "plain words here"\nclient_secret_value = x\nname = "Zk93jd82kLq1"\n'
    assert [text[a:b] for a, b in credentials.literal_spans(text)] == ["Zk93jd82kLq0"]
    text = 'db = {"accessKey": "Ab12Cd34Ef" + "Gh56Ij78Kl"}'
    assert [text[a:b] for a, b in credentials.literal_spans(text)] == ["Ab12Cd34Ef", "Gh56Ij78Kl"]
    assert credentials.literal_spans("A clean text: nothing = here, the token was a word.") == []
    assert credentials.redacted("password=abcdef1 and AKIA" + "A" * 16) == "[REDACTED] and [REDACTED]"


@pytest.mark.parametrize("text, secrets", [
    ('const apiKey: string = "sk-9aZ81kLmQ2xT7vB4"', ["sk-9aZ81kLmQ2xT7vB4"]),
    ('db_password: str = "Zx81kLmQ2xT7vB4"', ["Zx81kLmQ2xT7vB4"]),
    ("signing_secret: Optional[str] | None = 'Zx81kLmQ2xT7vB4'", ["Zx81kLmQ2xT7vB4"]),
    ('config: signing_key = "Zk93jd82kLq0"', ["Zk93jd82kLq0"]),
    ('os.environ["AWS_SECRET_ACCESS_KEY"] = "wJalrXUtnFEMI/K7"', ["wJalrXUtnFEMI/K7"]),
    ("SECRET=ab$9kLmQ2xT7vB4", ["ab$9kLmQ2xT7vB4"]),
    ("export DB_PASSWORD=Tr0ub4dor&3xyzQ!\n", ["Tr0ub4dor&3xyzQ!"]),
    ("f(access_key=Zx81kLmQ2xT7vB4)", ["Zx81kLmQ2xT7vB4"]),
    ("u?access_key=Zx81kLmQ2x&client_secret=Ab12Cd34Ef", ["Zx81kLmQ2x", "Ab12Cd34Ef"]),
    ('passphrase = "correct horse battery staple"', ["correct horse battery staple"]),
    ('client_secret: "aB3$x9"', ["aB3$x9"]),
    ("access_key=${ACCESS_KEY}", []), ("access_key: CredentialProvider = f()", []), ('auth = "short words here"', []),
])
def test_syntaxes_of_literals(text, secrets):
    assert [text[a:b] for a, b in credentials.literal_spans(text)] == secrets
    assert not any(s in credentials.redacted(text) for s in secrets)


def test_base_matches_consume_text_before_the_length_test():
    text = "password: token: abcdefg ſecret=abcdefgh"
    assert brute.secret_spans(text)[:3] == (0, 0, 0) and credentials.base_spans(text) == []


def test_notices_with_errors(spark):
    texts = ["Relesed under teh MIT Licence", "gnu genral public license", "a walk under the public trees",
             "x" * 30 + " permission is hereby granted, free of chrge to any persn obtaining a copy"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[1].labels == "gpl" and 0.9 < got[1].score < 1 and got[1].n_base == 0
    assert got[2].labels == "" and got[2].score == 0
    assert got[3].labels == "mit" and got[3].matches == "mit:1:14:2"


def test_benchmark_in_slices_gives_the_same(spark):
    rnd = random.Random(2)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rnd.choices(words, k=60))) for i in range(30)]
    items = [(i, " ".join(docs[i][1].split()[5:5 + 3 * i + 1])) for i in range(12)] + [(99, "w1")]
    items += [(100 + i, " ".join(docs[3][1].split()[:10])) for i in range(40)]  # a window of many items
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    want = sorted((i, *brute.contamination(t, items)) for i, t in docs)
    for size in (1 << 20, 6_000):  # one slice, then several of the index and of the counts
        got = decontaminate.contamination(d, b, max_index_bytes=size).collect()
        assert sorted(tuple(r)[:6] for r in got) == want
        left = decontaminate.without_contaminated(d, b, max_index_bytes=size).collect()
        assert {r.doc_id for r in left} == {r[0] for r in want if not r[5]}


def _near_copies(seed, groups, copies, edits):
    rnd = random.Random(seed)
    common = " ".join(f"c{i}" for i in range(25))
    docs = []
    for g in range(groups):
        base = [f"g{g}w{i}" for i in range(rnd.choice([12, 40, 90]))]
        for _ in range(copies):
            own = list(base)
            for _ in range(rnd.randint(0, edits)):
                own[rnd.randrange(len(own))] = f"e{rnd.random()}"
            docs.append(" ".join(own) + (" " + common if rnd.random() < 0.7 else ""))
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("thinned,marked", [(0.7, 1 << 26), (0.0, 0)])
def test_join_with_large_and_common_buckets(spark, monkeypatch, thinned, marked):
    monkeypatch.setattr(jaccard, "SMALL_BUCKET", 2)
    monkeypatch.setattr(jaccard, "CELL_VALUES", 3)
    monkeypatch.setattr(jaccard, "MOST_MARKED", marked)
    monkeypatch.setattr(jaccard, "THINNED", thinned)
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 7)
    docs = _near_copies(3, 12, 9, 2) + [(1000, None), (1001, ""), (1002, "a b"), (1003, "a b"), (1004, "b a")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute.components(docs)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similar_components(df).collect()}
    assert got == want


@pytest.mark.parametrize("percent,values", [(75, 1 << 19), (75, 30), (100, 1 << 19)])
def test_residual_buckets_join_all_that_links_join(spark, monkeypatch, percent, values):
    monkeypatch.setattr(jaccard, "BLOCK_MEMBERS", 4)
    monkeypatch.setattr(jaccard, "BLOCK_VALUES", values)
    rnd = random.Random(percent)
    docs = []
    for i in range(60):
        n = rnd.choice([1, 2, 3, 4, 9, 12, 16, 27, 36])  # sizes on the edges of ranges too
        docs.append((i, " ".join(f"{rnd.choice('ab')}{k}" if rnd.random() < 0.1 else f"w{k}" for k in range(n))))
    df = spark.createDataFrame(docs + docs[:5], "doc_id long, text string")
    described = jaccard._describe(df, 1, percent)
    bucket = {i: i % 2 for i, _ in docs}
    label = {i: 0 if i % 3 else i for i, _ in docs}  # 0: the largest of each bucket
    rows = spark.createDataFrame([(bucket[i], i, label[i]) for i in bucket], "bucket long, id long, label long")
    got = {tuple(r) for r in jaccard._between(df, rows, described, 1, percent).collect()}
    words = {i: set(t.split()) for i, t in docs}
    links = {(a, b) for a in bucket for b in bucket if a < b and bucket[a] == bucket[b] and label[a] != label[b]
             and 100 * len(words[a] & words[b]) >= percent * len(words[a] | words[b])}
    assert got and got <= links

    def groups(pairs):
        at = dict(label)
        for a, b in pairs:
            x, y = at[a], at[b]
            at = {i: min(x, y) if v in (x, y) else v for i, v in at.items()}
        return at

    assert groups(sorted(got)) == groups(sorted(links))


def test_allocation_orders_hot_segments_last():
    filled = np.full(512, 400)
    filled[[3, 77]] = 3000, 2000
    place, units = jaccard.allocation(filled)
    assert place[3] == 511 and place[77] == 510 and sorted(place) == list(range(512))
    assert (units == 2).sum() == 2 and units[3] == units[77] == 1


def test_units_of_two_lose_no_link():
    # every pair of similar sets shares an entry whatever the allocation
    rnd = np.random.default_rng(0)
    base = rnd.integers(0, 1 << 62, 400).astype(np.uint64)
    sets = jaccard.Sets(np.empty(0, np.uint8), np.zeros(1, np.int64), 5)
    rows = [np.unique(np.concatenate([base[rnd.permutation(400)[:400 - k]], rnd.integers(0, 1 << 62, k).astype(np.uint64)]))
            for k in (0, 20, 40, 55)]
    sets.size = np.array([len(r) for r in rows])
    sets.values, sets.ends = np.concatenate(rows), np.cumsum(sets.size)
    m = jaccard.segment_count(4)
    place = rnd.permutation(m)
    for share in (0.0, 0.5, 1.0):
        units = np.where(rnd.random(m) < share, 2, 1).astype(np.int8)
        owners = {}
        for which, bands, bound in jaccard.roles(sets.size, 75):
            for k in np.unique(bands).tolist():
                own = bands == k
                e, o = jaccard.entries(sets, which[own], k, bound[own], (place, units) if k == 4 else None)
                for x, y in zip(e.tolist(), o.tolist()):
                    owners.setdefault(x, set()).add(y)
        for i in range(4):
            for j in range(i):
                both = len(np.intersect1d(rows[i], rows[j]))
                if 100 * both >= 75 * (len(rows[i]) + len(rows[j]) - both):
                    assert any({i, j} <= s for s in owners.values())


def test_code_lengths_are_the_plain_model():
    samples = {"x": [b"abracadabra abracadabra"], "y": [b"hocus pocus hocus pocus", b"abc"]}
    model = langid.Model(samples)

    def bits(lang, data):
        symbol = model.symbol
        total = 0.0
        for i in range(len(data)):
            escape = 0.0
            for order in range(min(i, langid.ORDER), -1, -1):
                context = [symbol[b] for b in data[i - order:i]]
                after = [symbol[d[k + order]] for d in samples[lang] for k in range(len(d) - order)
                         if [symbol[b] for b in d[k:k + order]] == context]
                if symbol[data[i]] in after:
                    total += escape + np.log2((len(after) + len(set(after))) / after.count(symbol[data[i]]))
                    break
                if after:
                    escape += np.log2((len(after) + len(set(after))) / len(set(after)))
            else:
                total += escape + 8
        return total

    for data in (b"abra", b"pocus pocus", b"zzz abq", b""):
        got = model.code_lengths(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        assert got == pytest.approx([bits(x, data) for x in model.langs], rel=1e-5)


def test_small_languages_of_other_scripts_keep_their_bytes():
    rnd = random.Random(4)
    # two of each script, whose letters differ in the last byte alone
    letters = {"el1": "αβγδ", "el2": "εζηθ", "he1": "אבגד", "he2": "הוזח", "ru1": "абвг", "ru2": "дежз", "th1": "กขคง", "th2": "จฉชซ"}

    def text(own, words):
        return " ".join("".join(rnd.choices(own, k=5)) for _ in range(words)).encode()

    ascii = bytes(range(32, 127)).decode() * 200
    model = langid.Model({"en": [ascii.encode()], **{x: [text(own, 60)] for x, own in letters.items()}})
    for lang, own in letters.items():
        data = text(own, 20)
        bits = model.code_lengths(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0]
        assert model.langs[bits.argmin()] == lang


def test_training_sample_is_of_distinct_whole_texts(spark):
    texts = [f"text number {i} " * 600 for i in range(6)]
    docs = spark.createDataFrame([("en", t) for t in texts for _ in range(50)] + [("fr", "un texte"), ("fr", ""), ("fr", None)],
                                 "lang string, text string").repartition(5)

    def sample(**bounds):
        return sorted((r["lang"], bytes(r["data"]).decode()) for r in langid.training_sample(docs, F.lit(True), **bounds).collect())

    assert sample() == sorted([("en", t) for t in texts] + [("fr", "un texte")])
    for bounds in ({"sample_docs": 4}, {"sample_bytes": 3 * len(texts[0]) + 1}):
        some = sample(**bounds)
        assert len(some) == 5 and set(some) < set(sample())


@pytest.mark.parametrize("n,size", [(3000, urls.MAX_BYTES), (3000, 192), (90, 8)])
def test_cascade_is_exact_in_one_shard_or_many(spark, n, size):
    keys = spark.range(n).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    rows = keys.select("key", F.col("listed").alias("want")).union(spark.createDataFrame([("host7", True)] * 40 + [("", False)], "key string, want boolean"))
    got = urls.with_listed(rows, keys, "key", size)
    assert got.columns == ["key", "want", "listed"]
    assert got.where("NOT want <=> listed").count() == 0 and got.count() == n + 41
    shards = list(urls.cascades(keys, size))
    assert (len(shards) > 1) == (size < urls.MAX_BYTES)
    assert all(level.size <= 8 * size for _, levels in shards for level in levels)
    plan = got._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan.split("Subquery")[0]


def test_cascade_levels(spark):
    keys = spark.range(3000).select(F.concat(F.lit("host"), "id").alias("key"), (F.col("id") % 7 == 0).alias("listed"))
    assert len(urls.build_cascade(keys)) > 1
    assert urls.build_cascade(keys.where("NOT listed")) == []


def test_cascade_order_prefers_rejections_per_work(spark):
    df = spark.range(100).select("id")
    rules = [quality.Rule("dear", F.col("id") < 60, F.lit(100.0)), quality.Rule("cheap", F.col("id") < 50, F.lit(1.0)),
             quality.Rule("covered", F.col("id") < 40, F.lit(2.0))]
    assert [r.name for r in quality.cascade_order(df, rules)] == ["cheap", "dear", "covered"]


def test_kept_can_be_filtered(spark):
    df = spark.createDataFrame([(1, "word " * 30), (2, " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))), (3, None)], "doc_id long, text string")
    assert [r.doc_id for r in quality.judge(df).where("kept").collect()] == [2]
