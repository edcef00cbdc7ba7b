"""Operator 12: target-distribution importance resampling.

Features are all runs of 1 to `max_n` consecutive words, repeats counted; a
feature's bucket is the CRC-32 of its UTF-8 bytes modulo `buckets`.

1. Head vocabulary. Words (and pairs, where max_n > 1) are counted over all
   documents; the HEAD most frequent are broadcast, a word with its exact
   CRC state and bucket, a pair with its bucket. HEAD bounds the broadcast,
   whatever the corpus; it changes the speed only.
2. Bucket totals. Each task counts its features by bucket: a head word or
   pair by look-up, any other by direct CRC (a run goes on from the state of
   the run before it). One row per task and bucket is summed: exact totals
   of the documents and of the target texts.
3. A bucket's gain is the floored 1000-fold log ratio of its two smoothed
   shares; a document's weight is the sum of its features' gains, in the
   same head-tail way. A hash of doc_id adds Gumbel noise: the highest
   scores are a draw without replacement in proportion to the weights.
4. Ranks come from range-partitioned running totals (plans/prefix.py).

Words: ASCII letters (A-Z lower-cased) and digits and every code point
above U+007F. Defined cases: a null or empty text has no feature, weight 0
and is no candidate; long texts are read in parts cut between words; a null
doc_id takes the noise of the empty id and loses ties; rows that repeat
doc_id and score rank by their n_features and weight, then in any order
(they agree in every result); an empty table or target gives S or T 0.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retentio.plans.prefix import running_totals
from retentio.plans.tables import materialize

from .common import bounded_batches

BUCKETS = 10_000
MAX_N = 1
PERCENT = 10
MIN_WORDS = 20
SEED = 2024
#: words and pairs of the head, each
HEAD = 50_000
#: different features that a task counts before it hands their counts on
FLUSH = 200_000
#: bytes of a long text that are cut into words at once
PART = 1 << 22
COUNTS = "pair boolean, feature binary, n long"
TOTALS = "target boolean, bucket int, n long"
SCORED = "n_words long, n_features long, weight long"


def _byte_table() -> bytes:
    """Word bytes stand for themselves (A-Z for a-z), others are a space."""
    table = bytearray(b" " * 256)
    for b in range(256):
        if b > 127 or chr(b).isalnum():
            table[b] = ord(chr(b).lower()) if b < 128 else b
    return bytes(table)


_TABLE = _byte_table()


def word_parts(text: str | None, overlap: int = 0):
    """Lists of the text's words (bytes); each list after the first starts
    with the `overlap` words before it."""
    data = (text or "").encode("utf-8").translate(_TABLE)
    at, last = 0, []
    while at < len(data):
        end = data.find(b" ", at + PART)
        end = len(data) if end < 0 else end
        words = data[at:end].split()
        yield last + words
        last = (last + words)[-overlap:] if overlap else []
        at = end


class Vocabulary:
    """Head words with CRC state and bucket, head pairs with bucket."""

    def __init__(self, words: list[bytes], pairs: list[bytes], buckets: int, max_n: int):
        self.buckets, self.max_n = buckets, max_n
        self.state = {w: zlib.crc32(w) for w in words}
        self.word_bucket = {w: s % buckets for w, s in self.state.items()}
        self.pair_bucket = {tuple(p.split(b" ")): zlib.crc32(p) % buckets for p in pairs}

    def part_buckets(self, words: list[bytes], seen: int) -> np.ndarray:
        """Buckets of all runs that end after the first `seen` words."""
        m, crc = self.buckets, zlib.crc32
        known = self.word_bucket.get
        out = [b if (b := known(w)) is not None else crc(w) % m for w in words[seen:]]
        if self.max_n > 1:
            out += self._longer(words, seen)
        return np.array(out, dtype=np.int64)

    def _longer(self, words: list[bytes], seen: int) -> list[int]:
        m, crc, state_of, pair_of = self.buckets, zlib.crc32, self.state.get, self.pair_bucket.get
        states = [s if (s := state_of(w)) is not None else crc(w) for w in words]
        out = []
        first = max(0, seen - 1)
        if self.max_n == 2:
            for i, pair in enumerate(pairwise(words[first:]), first):
                b = pair_of(pair)
                out.append(crc(pair[1], crc(b" ", states[i])) % m if b is None else b)
            return out
        for n in range(2, self.max_n + 1):
            # states[i] is the CRC of the run of n - 1 words from word i
            states = [crc(w, crc(b" ", s)) for s, w in zip(states, words[n - 1:])]
            out += [s % m for s in states[max(0, seen - n + 1):]]
        return out

    def text_buckets(self, text: str | None):
        """Arrays of buckets of the text's features, and how many words."""
        k = self.max_n - 1
        for i, words in enumerate(word_parts(text, k)):
            seen = min(k, len(words)) if i else 0
            yield self.part_buckets(words, seen), len(words) - seen


@lru_cache(maxsize=2)
def _vocabulary(words: tuple, pairs: tuple, buckets: int, max_n: int) -> Vocabulary:
    return Vocabulary(list(words), list(pairs), buckets, max_n)


def _counter(pairs: bool):
    """Counts of words, and of pairs, of a task's texts."""
    def batch(counts: Counter, pair: bool):
        return pa.RecordBatch.from_arrays(
            [pa.array([pair] * len(counts), pa.bool_()), pa.array(list(counts), pa.binary()),
             pa.array(list(counts.values()), pa.int64())], ["pair", "feature", "n"])

    def count(batches):
        single, double = Counter(), Counter()
        for b in batches:
            for text in b.column(0).to_pylist():
                for i, words in enumerate(word_parts(text, int(pairs))):
                    single.update(words[1:] if pairs and i else words)
                    if pairs:
                        double.update(map(b" ".join, pairwise(words)))
                    if len(single) + len(double) >= FLUSH:
                        yield batch(single, False)
                        yield batch(double, True)
                        single.clear()
                        double.clear()
        yield batch(single, False)
        yield batch(double, True)

    return count


def head_vocabulary(docs: DataFrame, text: str = "text", max_n: int = MAX_N,
                    head: int = HEAD) -> tuple[tuple, tuple]:
    """The most frequent words and pairs (at most `head` of each)."""
    counts = materialize(
        docs.select(F.col(f"`{text}`").alias("t")).mapInArrow(_counter(max_n > 1), COUNTS)
        .groupBy("pair", "feature").agg(F.sum("n").alias("n")), "feature_counts")

    def top(pair: bool) -> tuple:
        rows = (counts.filter(F.col("pair") == pair).orderBy(F.col("n").desc(), "feature")
                .limit(head).select("feature").collect())
        return tuple(bytes(r[0]) for r in rows)

    return top(False), top(True) if max_n > 1 else ()


def bucket_totals(docs: DataFrame, target: DataFrame, vocabulary, text: str = "text",
                  target_text: str = "text") -> DataFrame:
    """target, bucket, n: exact feature counts of both sides."""
    def one(flag: bool):
        def total(batches):
            v = _vocabulary(*vocabulary.value)
            sums = np.zeros(v.buckets, dtype=np.int64)
            for b in batches:
                for t in b.column(0).to_pylist():
                    for found, _ in v.text_buckets(t):
                        sums += np.bincount(found, minlength=v.buckets)
            at = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array([flag] * len(at), pa.bool_()), pa.array(at.astype(np.int32)), pa.array(sums[at])],
                ["target", "bucket", "n"])
        return total

    sides = [df.select(F.col(f"`{c}`").alias("t")).mapInArrow(one(flag), TOTALS)
             for df, c, flag in ((docs, text, False), (target, target_text, True))]
    return sides[0].union(sides[1]).groupBy("target", "bucket").agg(F.sum("n").alias("n"))


def gains(totals: DataFrame, buckets: int) -> np.ndarray:
    """Gain of each bucket; two rows per bucket come to the driver."""
    s, t = [0] * buckets, [0] * buckets
    for r in totals.collect():
        (t if r["target"] else s)[r["bucket"]] = r["n"]
    all_s, all_t = sum(s), sum(t)
    return np.array([math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) /
                                                ((s[b] + 1) * (all_t + buckets))))
                     for b in range(buckets)], dtype=np.int64)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Floored 1000-fold Gumbel noise from the first 32 bits of a SHA-256."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def importance_scores(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
                      target_text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N,
                      head: int = HEAD, seed: int = SEED, out: str = "importance") -> DataFrame:
    """`docs` with struct `out`(n_words, n_features, weight, score); `target`
    holds the texts whose distribution is wanted."""
    spark = docs.sparkSession
    bounded_batches(spark)
    words, pairs = head_vocabulary(docs, text, max_n, head)
    vocabulary = spark.sparkContext.broadcast((words, pairs, buckets, max_n))
    totals = bucket_totals(docs, target, vocabulary, text, target_text)
    gain = spark.sparkContext.broadcast(gains(totals, buckets))

    @F.arrow_udf(SCORED)
    def weigh(texts: pa.Array) -> pa.Array:
        v, g, rows = _vocabulary(*vocabulary.value), gain.value, []
        for t in texts.to_pylist():
            n = features = weight = 0
            for found, size in v.text_buckets(t):
                n, features = n + size, features + len(found)
                weight += int(g[found].sum())
            rows.append((n, features, weight))
        columns = zip(*rows) if rows else ((), (), ())
        return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns],
                                          ["n_words", "n_features", "weight"])

    k = F.col(f"`{key}`")
    return (docs.withColumn(out, weigh(F.col(f"`{text}`")))
            .withColumn(out, F.col(out).withField("score", F.col(f"{out}.weight") + noise(k, seed))))


def draw(scored: DataFrame, key: str = "doc_id", percent: int = PERCENT,
         min_words: int = MIN_WORDS, scores: str = "importance", out: str = "rank") -> DataFrame:
    """Rows with `out`: 1, 2, ... in order of score for the drawn share of
    the candidates (rows of at least `min_words` words), null for the others."""
    rows = materialize(scored.select(F.struct("*").alias("row")), "importance_scores")
    s = F.col(f"row.{scores}")
    may = s["n_words"] >= min_words
    n = rows.filter(may).count()
    slim = rows.filter(may).select("row", (-s["score"]).alias("a"), F.col(f"row.`{key}`").alias("b"),
                                   s["n_features"].alias("c"), s["weight"].alias("d"))
    order = [F.col("a").asc(), F.col("b").asc_nulls_last(), F.col("c").asc(), F.col("d").asc()]
    ranked = running_totals(slim, order, [], index="at").select(
        "row", F.when(F.col("at") < percent * n // 100, F.col("at") + 1).cast("long").alias(out))
    rest = rows.filter(~may).select("row", F.lit(None).cast("long").alias(out))
    own = [f"row.`{c}`" for c in scored.columns if c != out]
    return ranked.union(rest).select(*own, out)


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text",
             percent: int = PERCENT, min_words: int = MIN_WORDS, **options) -> DataFrame:
    """The drawn rows of `docs`, with their own columns."""
    name = "_importance"
    drawn = draw(importance_scores(docs, target, key, text, out=name, **options), key, percent,
                 min_words, name, "_rank")
    return drawn.filter(F.col("_rank").isNotNull()).drop(name, "_rank")


def importance_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    scored = importance_scores(docs.select("doc_id", "text"), benchmark.select("text"))
    drawn = draw(scored.drop("text"))
    return drawn.select("doc_id", "importance.n_features", "importance.weight",
                        "importance.score", "rank")


# CRC-32 one byte at a time over the different words; the table follows
# from the reversed polynomial.
IMPORTANCE_SQL = r"""
WITH RECURSIVE steps AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1
  FROM steps WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
listed AS (
  SELECT doc_id, FALSE AS target, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
  UNION ALL
  SELECT NULL, TRUE, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
each_word AS (SELECT doc_id, target, unnest(w) AS word FROM listed),
words AS (SELECT doc_id, target, word, count(*) AS n FROM each_word GROUP BY ALL),
hashed AS (
  SELECT word, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(word))),
      lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT word FROM words), crc_table),
totals AS (
  SELECT bucket, sum(n) FILTER (WHERE NOT target) AS s, sum(n) FILTER (WHERE target) AS t
  FROM words JOIN hashed USING (word) GROUP BY bucket),
sums AS (SELECT coalesce(sum(s), 0)::DOUBLE AS all_s, coalesce(sum(t), 0)::DOUBLE AS all_t FROM totals),
gain AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * (all_s + 10000)
                                 / ((coalesce(s, 0) + 1) * (all_t + 10000))))::BIGINT AS g
  FROM totals, sums),
weights AS (
  SELECT doc_id, sum(n) AS n, sum(n * g) AS weight
  FROM words JOIN hashed USING (word) JOIN gain USING (bucket) WHERE NOT target GROUP BY doc_id),
scored AS (
  SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))
      ::BIGINT + 0.5) / 4294967296))))::BIGINT AS score
  FROM documents d LEFT JOIN weights w ON w.doc_id = d.doc_id),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r,
         floor(10 * count(*) OVER () / 100) AS most
  FROM scored WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= most THEN r END AS rank
FROM scored s LEFT JOIN ranked USING (doc_id)
"""
