"""A fitted boosted model as tables.

* `node_table`: one row per node (tree, node, feature slot, cut, children,
  gain, cover, leaf value), read from the model's own saved folder.
* `leaf_table`: one row per leaf. Its path is kept per feature: the interval
  of values that goes this way and the path weight, the share of the
  training weight that went this way at the path's splits on that feature.
* `leaf_scores`: a row's margin is the sum of the leaves whose every interval
  holds the row's values.
* `tree_shapley`: exact Shapley values of the path-dependent tree game. In
  it an unknown feature takes both ways in proportion to the training
  weight. A leaf with d features on its path gives feature j

      value * (o_j - w_j) * sum over s of s!(d-1-s)!/d! * p_s

  where o_k tells whether the row's value lies in the interval, w_k is the
  path weight and p_s the coefficients of the product of (o_k z + w_k) over
  k other than j. That depends on the row through the bits o only, so the
  2^d answers of each leaf are tabled once; a row then looks them up and
  sums. Values and margins are log-odds (MLlib's margin twice).

Both meet every row with every leaf of one model. The leaves are bounded by
trees x 2^depth, checked before they are broadcast; a task takes its rows a
batch at a time and a leaf as one step over the batch's columns, so no row
of a row and a leaf is ever made.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.lookup import MAX_BROADCAST_ROWS
from ..plans.tables import materialize

MAX_DEPTH = 10


def node_table(spark: SparkSession, path: str, model: str = "model") -> DataFrame:
    """model, tree, node, feature, cut, left, right, gain, cover, value of
    the boosted model that is saved at `path`. Children are -1 in a leaf;
    `value` counts in a leaf only and holds the tree's weight."""
    data = spark.read.parquet(f"{path.rstrip('/')}/data")
    weights = (spark.read.parquet(f"{path.rstrip('/')}/treesMetadata")
               .toDF("treeID", "metadata", "weight").select("treeID", "weight"))
    n = F.col("nodeData")
    return data.join(weights, "treeID").select(
        F.lit(model).alias("model"), F.col("treeID").alias("tree"), n["id"].alias("node"),
        n["split"]["featureIndex"].alias("feature"),
        F.get(n["split"]["leftCategoriesOrThreshold"], 0).alias("cut"),
        n["leftChild"].alias("left"), n["rightChild"].alias("right"), n["gain"].alias("gain"),
        F.get(n["impurityStats"], 0).alias("cover"),
        # a margin m means odds of exp(2 m)
        F.when(n["leftChild"] < 0, 2 * n["prediction"] * F.col("weight")).alias("value"))


def leaf_table(nodes: DataFrame) -> DataFrame:
    """model, tree, leaf, value, features, low, high, weight: one row per
    leaf; the arrays have an entry per feature of its path (low < x <= high)."""
    nodes = materialize(nodes, "nodes")
    at = nodes.filter("node = 0").withColumn("steps", F.array().cast(
        "array<struct<feature:int,low:double,high:double,share:double>>"))
    done = None
    for _ in range(MAX_DEPTH + 1):
        leaves = at.filter("left < 0")
        done = leaves if done is None else done.union(leaves)
        open_ = at.filter("left >= 0")
        if open_.isEmpty():
            break
        child = nodes.select("model", "tree", *[F.col(c).alias(f"c_{c}") for c in nodes.columns
                                                if c not in ("model", "tree")])
        sides = open_.withColumn("side", F.explode(F.array(
            F.struct(F.col("left").alias("to"), F.lit(None).cast("double").alias("low"),
                     F.col("cut").alias("high")),
            F.struct(F.col("right").alias("to"), F.col("cut").alias("low"),
                     F.lit(None).cast("double").alias("high")))))
        sides = sides.withColumn("c_node", F.col("side.to"))
        step = F.struct("feature", "side.low", "side.high", (F.col("c_cover") / F.col("cover")).alias("share"))
        at = materialize(sides.join(child, ["model", "tree", "c_node"]).select(
            "model", "tree", *[F.col(f"c_{c}").alias(c) for c in nodes.columns
                               if c not in ("model", "tree")],
            F.concat("steps", F.array(step)).alias("steps")), "paths")
    else:
        raise ValueError(f"trees deeper than {MAX_DEPTH}")
    features = F.array_distinct(F.transform("steps", lambda s: s["feature"]))
    # of one feature: the steps on it; null bounds are ignored by max and min
    on = F.transform("features", lambda f: F.filter("steps", lambda s: s["feature"] == f))
    return (done.withColumn("features", features).withColumn("on", on).select(
        "model", "tree", F.col("node").alias("leaf"), "value", "features",
        F.transform("on", lambda ss: F.array_max(F.transform(ss, lambda s: s["low"]))).alias("low"),
        F.transform("on", lambda ss: F.array_min(F.transform(ss, lambda s: s["high"]))).alias("high"),
        F.transform("on", lambda ss: F.aggregate(ss, F.lit(1.0), lambda a, s: a * s["share"]))
        .alias("weight")))


def _power(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1), k)


def _bit(mask: Column, k: Column) -> Column:
    return F.call_function("shiftright", mask, k).bitwiseAND(F.lit(1))


def leaf_contributions(leaves: DataFrame) -> DataFrame:
    """`leaves` with `phi`: for each of the 2^d sets of bits o, the share of
    every feature of the path."""
    d = F.size("features")
    places = F.when(d > 0, F.sequence(F.lit(0), d - 1)).otherwise(F.array().cast("array<int>"))

    def times(p: Column, o: Column, w: Column) -> Column:
        zero = F.array(F.lit(0.0))
        return F.zip_with(F.concat(F.transform(p, lambda a: a * w), zero),
                          F.concat(zero, F.transform(p, lambda a: a * o)), lambda a, b: a + b)

    def share(mask: Column, j: Column) -> Column:
        p = F.aggregate(
            "places", F.array(F.lit(1.0)),
            lambda a, k: F.when(k == j, a).otherwise(times(a, _bit(mask, k).cast("double"),
                                                           F.get("weight", k))))
        total = F.aggregate(
            F.transform(p, lambda c, s: c * F.factorial(s) * F.factorial(F.col("d") - 1 - s)
                        / F.factorial("d")), F.lit(0.0), lambda a, c: a + c)
        return F.col("value") * (_bit(mask, j) - F.get("weight", j)) * total

    sets = F.sequence(F.lit(0), _power(F.col("d")) - 1)
    phi = F.transform(sets, lambda m: F.transform("places", lambda j: share(m, j)))
    return leaves.withColumn("d", d).withColumn("places", places).withColumn("phi", phi).drop("places")


def _collected(leaves: DataFrame, *columns: str):
    """The leaves of one model as a broadcast list, tree by tree. A leaf is
    the slots of its path, low and high (nan: no bound) and `columns`."""
    n = leaves.count()
    if n > MAX_BROADCAST_ROWS:
        raise ValueError(f"a model of {n} leaves is more than the {MAX_BROADCAST_ROWS} that are broadcast")
    table = leaves.select("tree", "leaf", "features", "low", "high", *columns).toArrow()
    table = table.sort_by([("tree", "ascending"), ("leaf", "ascending")])

    def array(cell, kind=float) -> np.ndarray:
        return np.array(cell.as_py(), dtype=kind)

    trees: dict[int, list] = {}
    for i, tree in enumerate(table["tree"].to_pylist()):
        trees.setdefault(tree, []).append((
            array(table["features"][i], int), array(table["low"][i]), array(table["high"][i]),
            *[array(table[c][i]) for c in columns]))
    return leaves.sparkSession.sparkContext.broadcast(list(trees.values()))


def _used(model) -> list[int]:
    """The slots that stand in some tree."""
    return sorted({int(f) for tree in model.value for leaf in tree for f in leaf[0]})


def _rows(rows: DataFrame, slots: list[int], key: str, x: str) -> DataFrame:
    """key and `x` as the values of `slots`, spread over the tasks: a written
    table of few bytes is read by few. Nan counts as larger than any number."""
    spread = rows.select(key, F.col(x).alias("x")).repartition(F.xxhash64(F.col(key), F.col("x")))
    at = F.array(*map(F.lit, slots)) if slots else F.array().cast("array<int>")
    value = F.col("x").cast("array<double>")
    return spread.select(key, F.transform(F.transform(at, lambda f: F.get(value, f)), lambda v: F.when(
        F.isnan(v), F.lit(float("inf"))).otherwise(v)).alias("x"))


def _values(batch: pa.RecordBatch, n_slots: int) -> np.ndarray:
    """One line per slot; a missing value is nan."""
    flat = pc.list_flatten(batch.column(1)).to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(batch.num_rows, n_slots).T, dtype=float)


def _held(values: np.ndarray, place: dict[int, int], leaf, seen: dict) -> list[np.ndarray]:
    """For each slot of a leaf's path, which rows lie in its interval (no
    bound and a missing value hold). `seen` keeps the intervals of a tree."""
    out = []
    for f, low, high in zip(*(part.tolist() for part in leaf[:3])):
        name = (f, str(low), str(high))
        if name not in seen:
            v = values[place[f]]
            seen[name] = ~(v <= low) & ~(v > high)
        out.append(seen[name])
    return out


def leaf_scores(rows: DataFrame, leaves: DataFrame, key: str = "customerID", x: str = "x",
                out: str = "margin") -> DataFrame:
    """key, `out` (log-odds): the sum of the leaves that a row reaches."""
    model = _collected(leaves, "value")
    slots = _used(model)
    place = {f: i for i, f in enumerate(slots)}

    def score(batches):
        for b in batches:
            values, n = _values(b, len(slots)), b.num_rows
            margin, met = np.zeros(n), np.zeros(n, dtype=bool)
            for tree in model.value:
                seen: dict = {}
                for leaf in tree:
                    hit = np.logical_and.reduce([np.ones(n, dtype=bool), *_held(values, place, leaf, seen)])
                    margin[hit] += leaf[3]
                    met |= hit
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(margin, mask=~met)], ["key", "margin"])

    rows = _rows(rows, slots, key, x)
    found = rows.mapInArrow(score, T.StructType([
        T.StructField("key", rows.schema[key].dataType), T.StructField("margin", T.DoubleType())]))
    return (found.filter(F.col("margin").isNotNull()).groupBy(F.col("key").alias(key))
            .agg(F.sum("margin").alias(out)))


def base_value(leaves: DataFrame) -> DataFrame:
    """One row, `base`: the margin with every feature unknown."""
    w = F.aggregate("weight", F.lit(1.0), lambda a, b: a * b)
    return leaves.agg(F.sum(F.col("value") * w).alias("base"))


def tree_shapley(rows: DataFrame, leaves: DataFrame, names: list[str], key: str = "customerID",
                 x: str = "x") -> DataFrame:
    """key, feature, contribution: exact Shapley values in log-odds of the
    model's encoded features (those that stand in some tree)."""
    table = materialize(leaf_contributions(leaves).select(
        "tree", "leaf", "features", "low", "high", "phi"), "leaf_contributions")
    model = _collected(table, "phi")
    slots = _used(model)
    place = {f: i for i, f in enumerate(slots)}

    def share(batches):
        for b in batches:
            values, n = _values(b, len(slots)), b.num_rows
            total = np.zeros((len(slots), n))
            for tree in model.value:
                seen: dict = {}
                for leaf in tree:
                    mask = np.zeros(n, dtype=np.intp)
                    for k, held in enumerate(_held(values, place, leaf, seen)):
                        mask += held.astype(np.intp) << k
                    for k, f in enumerate(leaf[0].tolist()):
                        total[place[f]] += leaf[3][:, k].take(mask)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.FixedSizeListArray.from_arrays(total.T.ravel(), len(slots))
                 .cast(pa.list_(pa.float64()))], ["key", "total"])

    rows = _rows(rows, slots, key, x)
    if not slots:                       # every tree is one leaf
        return rows.limit(0).select(key, F.lit("").alias("feature"), F.lit(0.0).alias("contribution"))
    found = rows.mapInArrow(share, T.StructType([
        T.StructField("key", rows.schema[key].dataType),
        T.StructField("total", T.ArrayType(T.DoubleType()))]))
    named = F.array(*[F.lit(names[f]) for f in slots])
    # rows of one key add up
    return (found.select("key", F.posexplode("total").alias("slot", "share"))
            .groupBy("key", "slot").agg(F.sum("share").alias("contribution"))
            .select(F.col("key").alias(key), F.get(named, F.col("slot")).alias("feature"), "contribution"))
