"""Operators 3, 4 and 7 against brute force."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import xxhash

from retentio.llm import exact_dedup, line_dedup, simhash

from .conftest import SF


# -- operator 3 ------------------------------------------------------------
def brute_lines(rows):
    """rows: distinct (doc_id, text); text after removal by (doc_id, text)."""
    first, gone = {}, defaultdict(set)
    for d, t in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        ls = t.split("\n")
        for i in range(len(ls) - 2):
            w = tuple(ls[i:i + 3])
            if w in first:
                gone[d, t] |= {i, i + 1, i + 2}
            else:
                first[w] = (d, i)
    return {(d, t): "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d, t])
            for d, t in rows}


def test_lines_equal_brute_force(spark, docs):
    r = random.Random(5)
    rows = [(i, "\n".join(r.choice("abcde") for _ in range(r.randint(0, 12)))) for i in range(120)]
    rows += [(200, ""), (201, "\n\n\n\n"), (202, "a\na\na\na\na"), (None, "a\nb\nc"),
             (203, "long " * 30000 + "\nx\ny"), (204, "z\nlong\nx"), (205, "q\nw")]
    want = brute_lines(rows)
    out = line_dedup.dedup_lines(docs(rows + [(206, None), (3, rows[3][1])]))
    assert out.columns == ["doc_id", "text", "lang", "source", "_k1", "fp", "label",
                           "lines_removed"]
    got = out.collect()
    assert len(got) == len(rows) + 2
    left = defaultdict(list)
    for g in got:
        left[g["doc_id"]].append(g["text"])
    assert left[206] == [None] and len(left[3]) == 2
    for (d, _), text in want.items():
        assert set(left[d]) == {text}
    assert line_dedup.dedup_lines(docs([])).count() == 0


# -- operator 4 ------------------------------------------------------------
def brute_print(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, bits=3):
    """prints: list of (doc_id, fp); doc_id -> smallest doc_id reachable."""
    fps = np.array([p for _, p in prints], dtype=np.uint64)
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        near = np.bitwise_count(fps ^ fps[i]) <= bits
        for j in np.flatnonzero(near):
            a, b = find(i), find(int(j))
            parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(prints):
        r = find(i)
        least[r] = d if r not in least else min(least[r], d)
    return {d: least[find(i)] for i, (d, _) in enumerate(prints)}


def test_prints_and_components_equal_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = [(r["doc_id"], brute_print(r["text"])) for r in rows.collect()]
    reach = brute_components(want)
    got = simhash.simhash_query(rows).collect()
    assert {g["doc_id"]: g["fingerprint"] for g in got} == {d: f"{p:016x}" for d, p in want}
    assert {g["doc_id"]: g["component_id"] for g in got} == reach
    assert len(got) == len(want)


def test_links_equal_all_pairs(spark, monkeypatch):
    """A dense group, dealt out in small chunks, loses no link."""
    monkeypatch.setattr(simhash, "CHUNK", 16)
    r = random.Random(2)
    fps = {r.getrandbits(64) for _ in range(150)} | {0, (1 << 64) - 1, 1 << 63}
    base = r.getrandbits(64)
    for _ in range(250):
        fps.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = [(x["a"], x["b"]) for x in simhash.links(df).collect()]
    want = {(min(a, b), max(a, b)) for a in signed for b in signed
            if a != b and ((a ^ b) & (1 << 64) - 1).bit_count() <= 3}
    assert len(got) == len(set(got)) and set(got) == want


def test_keep_one_edges(docs):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (2, text), (2, text), (None, text), (7, None), (8, ""), (9, " \n"),
            (10, "other words that stand alone here"), (11, "A"), (12, "a"),
            (13, "word " * 40000)]
    out = simhash.keep_one(docs(rows))
    assert out.columns[:2] == ["doc_id", "text"] and "_n" not in out.columns
    assert sorted(r["doc_id"] for r in out.collect()) == [2, 7, 10, 11, 13]
    assert simhash.keep_one(docs([])).count() == 0
    only_null = simhash.keep_one(docs([(None, "x"), (None, "x")])).collect()
    assert len(only_null) == 1


def test_keep_one_tells_components_apart(docs):
    """Null ids and a doc_id on unlinked texts name no component alone."""
    apart = ["alpha beta gamma delta", "one two three four five", "red green blue"]
    rows = [*[(None, t) for t in apart], (None, apart[0]), (4, "he said so to her"),
            (4, "rain fell on the town"), (4, "rain fell on the town"), (3, "red green blue")]
    assert len({brute_print(t) for _, t in rows}) == 5
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.keep_one(docs(rows)).collect()),
                 key=str)
    assert got == sorted([(None, apart[0]), (None, apart[1]), (3, apart[2]),
                          (4, "he said so to her"), (4, "rain fell on the town")], key=str)
    # linked prints of null ids alone are one component, others stay apart
    near = " ".join(f"w{i}" for i in range(80))
    pair = [(None, near), (None, near + " w80"), (None, "far away")]
    a, b, c = (brute_print(t) for _, t in pair)
    assert 0 < (a ^ b).bit_count() <= simhash.BITS < (a ^ c).bit_count()
    assert len(simhash.keep_one(docs(pair)).collect()) == 2


def test_chain_of_links(spark):
    from retentio.llm.components import connected_components
    chain = [(i, i + 1) for i in range(40)] + [(100, 102), (102, 101)]
    got = connected_components(spark.createDataFrame(chain, "a long, b long")).collect()
    assert {r["node"]: r["label"] for r in got} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    empty = spark.createDataFrame([], "a long, b long")
    assert connected_components(empty).count() == 0


# -- operator 7 ------------------------------------------------------------
def test_chunks_cover_and_follow_content():
    r = random.Random(1)
    data = bytes(r.getrandbits(8) for _ in range(200_000))
    ends = exact_dedup.chunk_ends(data)
    assert ends[-1] == len(data) and ends == sorted(set(ends))
    sizes = np.diff([0, *ends])
    assert sizes.max() <= exact_dedup.MOST and sizes[:-1].min() >= exact_dedup.LEAST
    moved = exact_dedup.chunk_ends(b"x" * 700 + data)
    cut = {data[a:b] for a, b in zip([0, *ends], ends)}
    both = {(b"x" * 700 + data)[a:b] for a, b in zip([0, *moved], moved)}
    assert len(cut & both) > 0.9 * len(cut)
    assert exact_dedup.chunk_ends(b"") == [] and exact_dedup.chunk_ends(b"ab") == [2]


def _groups(rows):
    g = defaultdict(list)
    for d, t in rows:
        g[t or ""].append(d)
    return g


def test_groups_equal_brute_force(docs):
    r = random.Random(4)
    long = "".join(r.choice("abcdef \n") for _ in range(60_000))
    rows = [(i, r.choice(["x", "y ", "Y", "", None, long, long + "!", "é", "é"]))
            for i in range(90)] + [(4, "x"), (4, "x"), (None, "x"), (None, "alone")]
    got = exact_dedup.exact_groups(docs(rows)).collect()
    groups = _groups(rows)
    assert len(got) == len(rows)
    by_hash = {hashlib.sha256(t.encode()).hexdigest(): g for t, g in groups.items()}
    for x in got:
        g = by_hash[x["text_sha256"]]
        keep = max((d for d in g if d is not None), default=None)
        assert (x["keep_id"], x["group_size"]) == (keep, len(g))
        assert x["kept"] == (x["doc_id"] == keep)
    assert exact_dedup.exact_groups(docs([])).count() == 0


def test_colliding_chunk_hashes_are_told_apart(docs, monkeypatch):
    from pyspark.sql import functions as F
    real = F.xxhash64
    monkeypatch.setattr(exact_dedup.F, "xxhash64",
                        lambda *c: F.lit(1).cast("long") if len(c) == 1 else real(*c))
    got = {r["doc_id"]: r["keep_id"] for r in exact_dedup.exact_groups(
        docs([(1, "a"), (2, "b"), (3, "a"), (4, "c" * 9000), (5, "d" * 9000)])).collect()}
    assert got == {1: 3, 2: 2, 3: 3, 4: 4, 5: 5}


def test_sf_copies_match(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    groups = _groups([(r["doc_id"], r["text"]) for r in rows.collect()])
    got = exact_dedup.exact_query(rows).collect()
    assert {g["keep_id"] for g in got} == {max(v) for v in groups.values()}
