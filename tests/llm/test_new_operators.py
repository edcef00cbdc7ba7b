"""Operators 11 to 13 against brute force, and their defined cases."""

import math
import zlib
from collections import Counter
from hashlib import sha256

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from retentio.llm import hard_negatives, importance, token_files
from retentio.llm.perfect_hash import PerfectHash, words64
from retentio.llm.token_encoder import TokenEncoder
from retentio.llm.tokenizer_files import tokenizer_path

SF = "/root/testdata/sf0.001"


# -- operator 13 ------------------------------------------------------------
@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    with open(tokenizer_path(), encoding="utf-8") as f:
        return TokenEncoder(f.read(), memo=2000)


def _ids(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


def test_encoder_equals_the_library_on_code_points(library, encoder):
    points = [*range(0x2500), *range(0x2500, 0x110000, 61), *range(0x32300, 0x33500, 7)]
    for c in points:
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}B 7{chr(c)}́"
            assert encoder.encode(text) == _ids(library, text), hex(c)


def test_encoder_equals_the_library_on_texts(library, encoder):
    rng = np.random.default_rng(3)
    parts = ["a", "B", "'s", "'Re", " ", "ll", "é", "É", "İ", "²", "9", "\n", "\x1c", "\xa0", "　",
             "<|endoftext|>", "<|", "x-", "ß", "ſ", "語", "é", "|", "_", ".,", "\x00"]
    for _ in range(4000):
        text = "".join(rng.choice(parts, rng.integers(0, 12)))
        assert encoder.encode(text) == _ids(library, text), repr(text)
    assert encoder.encode(None) == encoder.encode("") == b""


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 20000])
def test_perfect_hash_is_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    k1, k2 = (words64(rng.integers(-2**63, 2**63 - 1, n)) for _ in range(2))
    index = PerfectHash.build(k1, k2)
    assert sorted(index.slots(k1, k2).tolist()) == list(range(n))
    other = index.slots(~k1, k2)
    assert ((other >= -1) & (other < max(n, 1))).all()
    assert sum(index.sizes) * 64 <= 5 * n + 64 * 70     # a few bits per key


def test_hashes_outside_spark_are_sparks(spark):
    keys = ["1", "", "é" * 50, None, "x" * 33]
    rows = spark.createDataFrame([(k,) for k in keys], "key string").select(
        "key", *token_files.key_hashes(F.col("key"))).collect()
    assert {r["key"]: (r["k1"], r["k2"]) for r in rows} == {k: token_files.hashes_of(k) for k in keys}


def test_token_files_query_equals_brute_force(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in token_files.token_file_query(docs, tokenizer_path()).collect()}
    start, want = 0, {}
    for r in sorted(docs.select("doc_id", "text").collect()):
        ids = _ids(library, r["text"] or "") + (1).to_bytes(4, "little")
        want[r["doc_id"]] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    assert got == want


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows = [("a", "x y"), (None, "n1"), ("b", None), ("b", "zz " * 50), ("b", "w"), ("c", ""),
            (None, "n2"), ("a", "x y")] * 3 + [("long", "word " * 40000)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").withColumn("start", F.lit(9))
    path = f"file://{tmp_path_factory.mktemp('ids')}/f"
    return docs.repartition(3), token_files.write_token_files(
        docs.repartition(3), path, tokenizer_path(), shard_bytes=100, keys_per_index=2)


def test_token_files_defined_cases(folder, library):
    docs, files = folder
    got = files.read(docs, "doc_id").collect()
    assert Counter((r["key"], bytes(r["token_ids"])) for r in got) == Counter(
        (r["doc_id"], _ids(library, r["text"] or "") + b"\1\0\0\0") for r in docs.collect())
    at = 0                                      # one run of ids, in key order
    for r in sorted(got, key=lambda r: r["start"]):
        assert (r["start"], len(r["token_ids"])) == (at, 4 * r["n_tokens"])
        at += r["n_tokens"]
    keys = [r["key"] or "" for r in sorted(got, key=lambda r: r["start"])]
    assert keys == sorted(keys)
    assert files.shards.count() > 3 and files.buckets.count() == 3


def test_token_files_single_keys(folder, spark):
    docs, files = folder
    for key, n in (("a", 6), ("b", 9), ("c", 3), (None, 6), ("long", 1), ("no such key", 0)):
        one = files.read(spark.createDataFrame([(key,)], "key string")).collect()
        want = sorted(np.frombuffer(r["token_ids"], "<u4").tolist() for r in one)
        assert sorted(ids.tolist() for ids in files.get(key)) == want and len(want) == n


def test_token_files_of_an_empty_table(folder, spark, tmp_path):
    docs, _ = folder
    files = token_files.write_token_files(docs.limit(0), f"{tmp_path}/e", tokenizer_path())
    assert files.read(docs, "doc_id").count() == 0 and files.get("a") == []


def test_token_files_wide_ids(spark, tmp_path):
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    files = token_files.write_token_files(docs, f"{tmp_path}/w", tokenizer_path(), end_id=70000)
    assert [ids[-1] for k in (1, 2) for ids in files.get(k)] == [70000, 70000]
    assert {r["width"] for r in files.shards.collect()} == {4}


# -- operator 12 ------------------------------------------------------------
def _words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in low).split(" ")


def brute_importance(docs, target, buckets, max_n, percent, min_words):
    def features(text):
        w = [x for x in _words(text) if x]
        return len(w), [zlib.crc32(" ".join(w[i:i + n]).encode()) % buckets
                        for n in range(1, max_n + 1) for i in range(len(w) - n + 1)]

    s = Counter(b for _, t in docs for b in features(t)[1])
    t = Counter(b for x in target for b in features(x)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
            for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        n, f = features(text)
        weight = sum(gain[b] for b in f)
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, n, len(f), weight, score))
    may = sorted((r for r in rows if r[1] >= min_words),
                 key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    drawn = Counter()
    for i, r in enumerate(may[:percent * len(may) // 100]):
        drawn[r, i + 1] += 1
    rest = Counter((r, None) for r in may[percent * len(may) // 100:])
    return drawn + rest + Counter((r, None) for r in rows if r[1] < min_words)


TEXTS = ["The cat's tail, the CAT; 7 lives", "éA ÀÉ naïve naïve", None, "", "?!", "a b c d e f g",
         "word " * 30, "\x00a\x7fb", "日本 語 x"]


@pytest.mark.parametrize("max_n,head", [(1, 3), (1, 50), (2, 2), (2, 50), (3, 4)])
def test_importance_equals_brute_force(spark, monkeypatch, max_n, head):
    monkeypatch.setattr(importance, "PART", 8)       # long texts: cut between words
    rows = [(i if i % 5 else None, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(1, TEXTS[1])] * 2
    target = [t for t in TEXTS[:4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_features", F.lit(0))
    bench = spark.createDataFrame([(t,) for t in target], "words string")
    scored = importance.importance_scores(docs, bench, target_text="words", buckets=97,
                                          max_n=max_n, head=head)
    got = importance.draw(scored, percent=50, min_words=3)
    assert got.columns == ["doc_id", "text", "n_features", "importance", "rank"]
    found = Counter(((r["doc_id"], r["importance"]["n_words"], r["importance"]["n_features"],
                      r["importance"]["weight"], r["importance"]["score"]), r["rank"])
                    for r in got.collect())
    assert found == brute_importance(rows, target, 97, max_n, 50, 3)


def test_importance_query_equals_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    want = sorted(con.execute(importance.IMPORTANCE_SQL).fetchall())
    got = importance.importance_query(*[spark.read.parquet(f"{SF}/{n}.parquet")
                                        for n in ("documents", "benchmark")])
    assert sorted(map(tuple, got.collect())) == want


def test_importance_of_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = docs.limit(0)
    assert importance.importance_query(none, docs).count() == 0
    row = importance.importance_query(docs, none).first()
    assert (row["n_features"], row["rank"]) == (3, None)
    kept = importance.resample(docs.withColumn("rank", F.lit("own")), none, percent=100, min_words=1)
    assert [tuple(r) for r in kept.collect()] == [(1, "a b c", "own")]


# -- operator 11 ------------------------------------------------------------
def brute_negatives(rows, anchor, k=5, m=5):
    sound = {(i, l, tuple(v)) for i, l, v in rows if None not in (i, l, v)
             and all(x is not None and math.isfinite(x) for x in v)}
    vec = [(i, l, [math.floor(256 * x) for x in v]) for i, l, v in sound]
    out = []
    for a in vec:
        if not anchor(a[0]):
            continue
        score = {id(r): sum(x * y for x, y in zip(a[2], r[2])) for r in vec}
        order = sorted(vec, key=lambda r: (-score[id(r)], r[0]))
        for p in [r for r in order if r[1] == a[1] and r is not a][:k]:
            s = score[id(p)]
            near = [r for r in order if r[1] != a[1]
                    and 80 * s <= 100 * score[id(r)] <= 100 * s][:m]
            out += [(a[0], p[0], n + 1, r[0], s, score[id(r)]) for n, r in enumerate(near)]
    return sorted(out)


def _clusters(n, d, labels, seed, spread):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(6, d))
    v = mid[rng.integers(0, 6, n)] + spread * rng.normal(size=(n, d))
    v *= rng.choice([0.2, 1, 5], n)[:, None]          # lengths differ
    return [(int(i), int(rng.integers(0, labels)), [float(np.float32(x)) for x in v[i]])
            for i in range(n)]


@pytest.mark.parametrize("n,d,labels,spread", [(1500, 12, 3, 0.1), (700, 3, 2, 0.02), (400, 40, 40, 1.0)])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, n, d, labels, spread):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 64)
    rows = _clusters(n, d, labels, n, spread)
    got = hard_negatives.mine(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").repartition(5),
        F.col("vec_id") % 20 == 0)
    want = brute_negatives(rows, lambda i: i % 20 == 0)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 100


def test_coordinate_lists_prune_and_lose_nothing():
    rows = _clusters(3000, 8, 2, 5, 0.05)
    m = np.floor(256 * np.array([v for _, _, v in rows]))
    n = np.linalg.norm(m, axis=1)
    unit = m / n[:, None]
    block = hard_negatives.Rows(hard_negatives._pack(
        m=m.astype(np.int32), id=np.arange(3000), hash=np.zeros(3000), label=np.zeros(3000),
        order=np.argsort(unit, axis=0).T.astype(np.uint16)))
    few = 0
    for q in m[:60]:
        score = m @ q
        least = int(np.sort(score)[-20])
        found = block.candidates(q, float(np.linalg.norm(q)), least)
        found = np.arange(3000) if found is None else found
        assert set(np.flatnonzero(score >= least)) <= set(found.tolist())
        few += len(found) < 1500
    assert few > 10
    assert len(block.candidates(m[0], float(n[0]), int(n[0] * n.max() * 1.01) + 1)) == 0


def test_hard_negatives_defined_cases(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (2, 2, [0.95, 0.0]),
            (2, 2, [0.95, 0.0]), (3, 2, [0.95, 0.5]), (4, 2, [0.95, 0.5]), (5, 2, None), (6, None, [1.0, 0.0]),
            (None, 2, [1.0, 0.0]), (7, 2, [nan, 0.0]), (8, 2, [inf, 0.0]), (9, 2, [None, 0.0]),
            (10, 1, [-1.0, 0.0]), (11, 3, [0.9]), (12, 3, []), (13, 3, [0.9, 0.0, 4.0])]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    table = table.withColumn("hash", F.lit("own")).withColumn("wants", F.lit(1))
    got = sorted(map(tuple, hard_negatives.mine(table, F.col("vec_id") == 0).collect()))
    assert got == brute_negatives(rows, lambda i: i == 0)
    assert hard_negatives.mine(table.limit(0), F.col("vec_id") == 0).count() == 0
    assert hard_negatives.mine(table, F.lit(None).cast("boolean")).count() == 0
    huge = spark.createDataFrame([(0, 1, [1e300]), (1, 1, [1e300]), (2, 2, [1e300])],
                                 "vec_id long, label int, embedding array<double>")
    assert [r["negative_id"] for r in hard_negatives.mine(huge, F.col("vec_id") == 0).collect()] == [2]


def test_hard_negatives_send_nothing_through_the_driver(spark):
    """Anchor blocks are copied once per chunk: however small Spark takes the
    two sides for, no join is broadcast."""
    rows = _clusters(300, 6, 3, 11, 0.2)
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    own = {"spark.sql.autoBroadcastJoinThreshold": "1g", "spark.sql.maxBroadcastTableSize": "1b",
           "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k) for k in own}
    try:
        for k, v in own.items():
            spark.conf.set(k, v)
        with pytest.raises(Exception, match="(?i)broadcast"):      # the limit holds
            table.join(table.select("vec_id"), "vec_id").collect()
        got = hard_negatives.mine(table, F.col("vec_id") % 20 == 0).collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    want = brute_negatives(rows, lambda i: i % 20 == 0)
    assert sorted(map(tuple, got)) == want and len(want) > 50


def test_hot_vector_stays_whole(spark):
    """A third of the rows share one vector: ties go by id, none is lost."""
    rows = [(i, i % 2, [1.0, 0.5] if i % 3 == 0 else [0.9, (i % 7) / 7]) for i in range(900)]
    got = hard_negatives.mine(
        spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"),
        F.col("vec_id") % 90 == 0)
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows, lambda i: i % 90 == 0)
