"""Operator 11: hard negatives by LEMP-style coordinate pruning.

Vectors become integers (floor of SCALE times a component); a score is the
integer inner product with the anchor. Two searches run over all rows: an
anchor's best rows of its own label (positives), then, for each positive,
the best rows of other labels whose score lies between LOW and HIGH per cent
of the positive's (negatives).

* Length buckets. Rows are range-partitioned by length, longest first, and
  cut into blocks of some thousand rows. A block keeps its greatest length
  and, for each coordinate, the rows sorted by the value of the normalised
  vectors.
* A block is skipped when no row of its length can reach the least score
  that the anchor still asks for. Otherwise that score bounds the cosine
  from below, which bounds each of the anchor's FOCUS largest coordinates to
  a feasible range of values; the sorted lists give the rows inside, and
  their intersection is the candidate set. Candidates are verified with
  exact integer scores. The least score rises as better rows are found.
* Anchors stand in blocks too. Row blocks and anchor blocks meet in an
  equi-join on a grid of chunks x groups (`_grid`), whose shuffle grows with
  the root of the cluster, and each task keeps the best few rows per anchor:
  what leaves it does not grow with a label or a group of equal vectors. No
  join is broadcast, so neither rows nor anchors pass through the driver.

Nothing is capped: a block is a unit of work, all rows are in one, and
ties go by smaller id, then by a hash of the row.

Defined cases: rows whose id, label or vector is null, or that have a null
or non-finite component, take no part; rows that agree in id, label and
vector are one row, rows that agree in the id alone are different ones; a
missing component counts as 0; scores beyond 64 bits count as the greatest
64-bit value; an empty table, or one without anchors, gives no row.
"""

from __future__ import annotations

import io
import math
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from retentio.plans.tables import materialize

from .common import bounded_batches

SCALE = 256
POSITIVES = NEGATIVES = 5
LOW, HIGH = 80, 100
#: coordinates that prune, rows and bytes of a block, anchors of a block
FOCUS = 4
BLOCK_ROWS, BLOCK_BYTES, ANCHOR_ROWS = 4096, 1 << 20, 256
#: anchor blocks whose best rows a task holds at once
HELD = 256
EXACT = 1 << 53
MOST = (1 << 63) - 1

BLOCK = "part int, seq int, block binary"
BEST = ("anchor_id long, anchor_hash long, want int, positive_id long, positive_hash long, "
        "positive_score long, id long, hash long, score long")


def _pack(**arrays) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _smallest(m: np.ndarray) -> np.ndarray:
    """The same integers in the narrowest type that holds them."""
    most = np.abs(m).max(initial=0)
    kind = np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64
    return m.astype(kind)


def _matrix(column: pa.Array) -> np.ndarray:
    """Scaled integers (as float64) of lists of numbers, filled with 0."""
    at = column.offsets.to_numpy().astype(np.int64)
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.diff(at)
    with np.errstate(over="ignore"):
        out = np.zeros((len(size), int(size.max(initial=0))))
        out[np.arange(out.shape[1]) < size[:, None]] = np.floor(SCALE * values[at[0]:at[-1]])
    return np.clip(out, -np.finfo(float).max, np.finfo(float).max)


def _lengths(m: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.sqrt(np.square(m.astype(np.float64)).sum(axis=1))


def _blocks(rows: int, lists: bool):
    """Cuts a task's rows into blocks; `lists` adds the sorted coordinates."""
    def cut(batches):
        part, seq, held, size, last = TaskContext.get().partitionId(), 0, [], 0, None
        for batch in batches:
            m = _matrix(batch.column("vec"))
            own = {c: batch.column(c).to_numpy(zero_copy_only=False)
                   for c in ("id", "hash", "label")}
            wants = batch.column("wants").to_pylist()
            name = np.stack([own["id"], own["hash"]], axis=1)
            before = np.concatenate([name[:1] * 0 if last is None else last, name[:-1]])
            keep = (name != before).any(axis=1)
            keep[:1] |= last is None
            last = name[-1:] if len(name) else last
            most = max(64, min(rows, BLOCK_BYTES // (2 * max(1, m.shape[1]))))
            at = np.flatnonzero(keep)
            while len(at):
                now, at = at[:most - size], at[most - size:]
                held.append((m[now], {c: v[now] for c, v in own.items()}, [wants[i] for i in now]))
                size += len(now)
                if size >= most:
                    yield _block(part, seq, held, lists)
                    seq, held, size = seq + 1, [], 0
        if size:
            yield _block(part, seq, held, lists)

    return cut


def _block(part: int, seq: int, held: list, lists: bool) -> pa.RecordBatch:
    wide = max(m.shape[1] for m, _, _ in held)
    m = np.concatenate([np.pad(m, ((0, 0), (0, wide - m.shape[1]))) for m, _, _ in held])
    out = {"m": _smallest(m), "part": np.array([part, seq])}
    for c in ("id", "hash", "label"):
        out[c] = np.concatenate([own[c] for _, own, _ in held])
    if lists:
        n = _lengths(m)
        unit = m / np.where(n > 0, n, 1)[:, None]
        out["order"] = np.argsort(unit, axis=0, kind="stable").T.astype(np.uint16)
    wants = [w or [] for _, _, ws in held for w in ws]
    out["n_wants"] = np.array([len(w) for w in wants])
    out["wants"] = np.array([[x["id"], x["hash"], x["score"]] for w in wants for x in w],
                            dtype=np.int64).reshape(-1, 3)
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([_pack(**out)])],
        ["part", "seq", "block"])


class Rows:
    """A block of rows with its sorted coordinate lists."""

    def __init__(self, raw: bytes):
        with np.load(io.BytesIO(raw)) as z:
            self.m = z["m"].astype(np.float64)
            self.id, self.hash, self.label = z["id"], z["hash"], z["label"]
            self.order = z["order"]
        n = _lengths(self.m)
        self.longest = float(n.max(initial=0.0))
        self.unit = (self.m / np.where(n > 0, n, 1)[:, None]).T
        self.sorted = np.take_along_axis(self.unit, self.order.astype(np.int64), axis=1)
        self.most = float(np.abs(self.m).max(initial=0.0))

    def candidates(self, q: np.ndarray, length: float, least: int | None) -> np.ndarray | None:
        """Rows that can score `least` or more; None for all."""
        if least is None or least <= 0:
            return None
        reach = length * self.longest
        if reach < least * (1 - 1e-9):
            return np.empty(0, dtype=np.int64)
        cosine = min(1.0, least / reach)
        lists = []
        unit = q[:len(self.unit)] / length
        spread = math.sqrt(max(0.0, 1 - cosine * cosine))
        for f in np.argsort(-np.abs(unit), kind="stable")[:FOCUS]:
            x = float(unit[f])
            away = math.sqrt(max(0.0, 1 - x * x)) * spread
            # beyond its own direction a component is bounded by 1 only
            low = -1.0 if -x >= cosine else x * cosine - away
            high = 1.0 if x >= cosine else x * cosine + away
            low, high = low - 1e-9, high + 1e-9
            a, b = np.searchsorted(self.sorted[f], [low, high])
            lists.append((b - a, int(f), a, b, low, high))
        n, f, a, b, _, _ = min(lists)
        if n == len(self.id):
            return None
        found = self.order[f, a:b].astype(np.int64)
        for size, g, _, _, low, high in lists:
            if g != f and size < len(self.id):
                v = self.unit[g, found]
                found = found[(v >= low) & (v <= high)]
        return found

    def scores(self, q: np.ndarray, at: np.ndarray | None) -> np.ndarray:
        d = min(len(q), self.m.shape[1])
        m = self.m[:, :d] if at is None else self.m[at, :d]
        if self.most * float(np.abs(q).max(initial=0.0)) * max(1, d) < EXACT:
            return (m @ q[:d]).astype(np.int64)
        whole = [int(x) for x in q[:d]]
        return np.array([max(-MOST, min(MOST, sum(int(x) * y for x, y in zip(r, whole))))
                         for r in m], dtype=np.int64)


class Anchor:
    """One anchor, and the best rows found for each of its wants."""

    def __init__(self, ident: tuple, label: int, q: np.ndarray, wants: list):
        self.ident, self.label, self.q = ident, label, q
        self.length = float(_lengths(q[None])[0])
        self.wants = wants           # (low, high, want number, positive)
        self.best: list[list[tuple]] = [[] for _ in wants]

    def least(self, k: int) -> int | None:
        """The least score that can still change anything."""
        out = [best[-1][0] * -1 if len(best) == k else low
               for (low, _, _, _), best in zip(self.wants, self.best)]
        return None if None in out else min(out, default=MOST)

    def search(self, rows: Rows, same: bool, k: int) -> None:
        least = self.least(k)
        at = rows.candidates(self.q, self.length, least)
        if at is not None and not len(at):
            return
        score = rows.scores(self.q, at)
        at = np.arange(len(score)) if at is None else at
        good = (rows.label[at] == self.label) == same
        if least is not None:
            good &= score >= least
        if same:
            good &= (rows.id[at] != self.ident[0]) | (rows.hash[at] != self.ident[1])
        at, score = at[good], score[good]
        if not len(at):
            return
        for j, (low, high, _, _) in enumerate(self.wants):
            best = self.best[j]
            low = -best[-1][0] if len(best) == k else low
            ok = np.ones(len(at), bool) if low is None else score >= low
            if high is not None:
                ok &= score <= high
            if ok.any():
                i, s = at[ok], score[ok]
                top = np.lexsort((rows.hash[i], rows.id[i], -s))[:k]
                new = zip((-s[top]).tolist(), rows.id[i[top]].tolist(), rows.hash[i[top]].tolist())
                self.best[j] = sorted({*best, *new})[:k]


def _anchors(raw: bytes, low: int, high: int) -> tuple[tuple, list[Anchor]]:
    with np.load(io.BytesIO(raw)) as z:
        z = {name: z[name] for name in z.files}
    ends = np.cumsum(z["n_wants"])
    out = []
    for i in range(len(z["id"])):
        asked = z["wants"][ends[i] - z["n_wants"][i]:ends[i]].tolist()
        # the least and greatest n with low*p <= 100*n <= high*p
        wants = [(-(-low * p // 100), high * p // 100, j, (pid, ph, p))
                 for j, (pid, ph, p) in enumerate(asked)] or [(None, None, 0, (0, 0, 0))]
        out.append(Anchor((int(z["id"][i]), int(z["hash"][i])), z["label"][i],
                          z["m"][i].astype(np.float64), wants))
    return tuple(z["part"].tolist()), out


def _meeting(same: bool, k: int, low: int, high: int):
    """Row and anchor blocks that meet, to the best rows of each anchor."""
    def out(anchors: list[Anchor]):
        found = [(*a.ident, j, *positive, i, h, -s) for a in anchors
                 for (_, _, j, positive), best in zip(a.wants, a.best) for s, i, h in best]
        columns = list(zip(*found)) or [()] * 9
        types = [pa.int64()] * 2 + [pa.int32()] + [pa.int64()] * 6
        names = [c.split()[0] for c in BEST.split(", ")]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names)

    def meet(batches):
        held: OrderedDict = OrderedDict()
        parsed: OrderedDict = OrderedDict()
        for batch in batches:
            for part, seq, raw, a_part, a_seq, a_raw in zip(*[c.to_pylist() for c in batch.columns]):
                if (a_part, a_seq) not in held:
                    held[a_part, a_seq] = _anchors(a_raw, low, high)[1]
                    if len(held) > HELD:
                        yield out(held.popitem(last=False)[1])
                if (part, seq) not in parsed:
                    parsed[part, seq] = Rows(raw)
                    if len(parsed) > 16:
                        parsed.popitem(last=False)
                for anchor in held[a_part, a_seq]:
                    anchor.search(parsed[part, seq], same, k)
        for anchors in held.values():
            yield out(anchors)

    return meet


def _grid(spark) -> tuple[int, int]:
    """Chunks of rows and groups of anchors whose tasks fill the shuffle
    partitions: rows move once per group, anchors once per chunk; anchors are
    few, so there is one group up to a hundred chunks."""
    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    groups = max(1, round(math.sqrt(tasks / 100)))
    return -(-tasks // groups), groups


def _searched(blocks: DataFrame, anchors: DataFrame, same: bool, k: int,
              low: int = LOW, high: int = HIGH) -> DataFrame:
    """The best k rows of every anchor and want."""
    spark = blocks.sparkSession
    chunks, groups = _grid(spark)
    n = max(1, -(-anchors.count() // (8 * ANCHOR_ROWS)))
    asked = (anchors.repartition(n, "hash").mapInArrow(_blocks(ANCHOR_ROWS, False), BLOCK)
             .select(F.pmod(F.hash("part", "seq"), F.lit(groups)).alias("group"),
                     F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
                     F.col("part").alias("a_part"), F.col("seq").alias("a_seq"),
                     F.col("block").alias("a_block")))
    rows = blocks.select(F.pmod("part", F.lit(chunks)).alias("chunk"),
                         F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
                         "part", "seq", "block")
    # merged, never broadcast: the copies of anchor blocks are as many as chunks,
    # and Spark's estimate of their size, by which it broadcasts, leaves that out
    met = (rows.join(asked.hint("merge"), ["chunk", "group"])
           .select("part", "seq", "block", "a_part", "a_seq", "a_block")
           .mapInArrow(_meeting(same, k, low, high), BEST))
    by = Window.partitionBy("anchor_id", "anchor_hash", "want").orderBy(
        F.col("score").desc(), "id", "hash")
    # a row that repeats may have been found in several chunks
    best = materialize(met, "best_rows").distinct().withColumn("rank", F.row_number().over(by))
    return best.filter(F.col("rank") <= k)


def mine(rows: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label",
         vector: str = "embedding", positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score for the rows of `rows` where `is_anchor` holds."""
    bounded_batches(rows.sparkSession)
    slim = rows.select(
        F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").alias("vec"), is_anchor.alias("anchor"))
    d = F.col("vec").cast("array<double>")
    slim = slim.filter(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull()
        & F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    slim = slim.withColumn("hash", F.xxhash64("label", "vec"))
    length = F.aggregate(d, F.lit(0.0), lambda a, x: a + x * x)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("length").desc(), F.col("id"), F.col("hash")]
    none = F.lit(None).cast("array<struct<id:long,hash:long,score:long>>").alias("wants")
    blocks = materialize(
        slim.withColumn("length", length)
        .repartitionByRange(n, *order, F.monotonically_increasing_id()).sortWithinPartitions(*order)
        .select("id", "hash", "label", "vec", none).mapInArrow(_blocks(BLOCK_ROWS, True), BLOCK),
        "row_blocks")
    anchors = materialize(slim.filter("anchor").dropDuplicates(["id", "hash"])
                          .select("id", "hash", "label", "vec"), "anchors")
    close = _searched(blocks, anchors.withColumn("wants", none), True, positives)
    wanted = close.groupBy("anchor_id", "anchor_hash").agg(F.sort_array(F.collect_list(
        F.struct("rank", "id", "hash", "score"))).alias("wants"))
    # at most `positives` of them for each anchor
    wants = F.transform("wants", lambda w: F.struct(w["id"].alias("id"), w["hash"].alias("hash"),
                                                    w["score"].alias("score")))
    wanted = wanted.select(F.col("anchor_id").alias("id"), F.col("anchor_hash").alias("hash"),
                           wants.alias("wants"))
    asking = materialize(anchors.join(wanted.hint("merge"), ["id", "hash"])
                         .select("id", "hash", "label", "vec", "wants"), "asking")
    return _searched(blocks, asking, False, negatives, low, high).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def hard_negative_query(embeddings: DataFrame) -> DataFrame:
    """Five hard negatives of every anchor and positive; labels of rows
    whose vec_id is divisible by 7 are shifted first."""
    label = F.col("label").cast("long")
    shifted = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = embeddings.select("vec_id", "embedding", shifted.alias("label"))
    return mine(rows, F.col("vec_id") % 100 == 0)
