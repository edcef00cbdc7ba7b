"""Sampled Shapley contributions for a fitted MLlib model.

Permutation sampling (Strumbelj & Kononenko 2014) as one Spark job. For
each cohort row x and permutation m: pick a background row z, walk the
features in a random order and switch them one at a time from z's value to
x's value. The F + 1 hybrid rows of this chain are scored by the model, and
the margin difference at each step is that feature's contribution. Per
chain the contributions add up exactly to margin(x) - margin(z); averaged
over permutations they estimate the Shapley values in log-odds, the unit
of the tree explainer upstream.

Each scored row adds its margin to the feature just switched and takes it
from the next one, so a chain's contributions are sums of two signed rows:
plain aggregation, no window. The rows of a key share a partition from
before the chains are unrolled, so both aggregations need no further shuffle.

The background rows of a chain come from the whole training set: rows get
positions 0..n-1 and each chain joins the position its hash names (spread
evenly, so no hot key). Work is cohort x permutations x (F + 1) scored rows.
Permutations and picks are hashes of (seed, key, m), so a recomputed task
builds the same chains. `permutations` sets the precision; `std_error` is
the standard error of each contribution over its chains (NULL for one).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.prefix import position_in_group
from .models import ChurnModel

#: chains per row: more give a smaller standard error
PERMUTATIONS = 8
EPS = 1e-12


def background_sample(df: DataFrame, cols, n: int, key: str = "customerID",
                      seed: int = 42) -> DataFrame:
    """n rows with the smallest hash of (seed, key): a per-task top-n and a
    merge of n rows per task; `_b` numbers them 0..n-1 (window over n rows)."""
    h = F.xxhash64(F.lit(seed), F.col(key))
    top = df.select(key, *cols).withColumn("_h", h).orderBy("_h", key).limit(n)
    return top.withColumn("_b", F.row_number().over(Window.orderBy("_h", key)) - 1).drop("_h", key)


def sampled_shapley(model: ChurnModel, cohort: DataFrame, background: DataFrame,
                    permutations: int = PERMUTATIONS, key: str = "customerID",
                    seed: int = 42, background_rows: int | None = None) -> DataFrame:
    """Long table (key, feature, contribution, std_error) with encoded feature
    names (`num__col`, `cat__col_value`). `background_rows` draws from that
    many rows only; None: from all of them."""
    feats = list(model.numeric) + list(model.categorical)
    nf = len(feats)
    if background_rows is None:
        bg = position_in_group(background.select(key, *feats), [], [F.col(key)], "_b")
    else:
        bg = F.broadcast(background_sample(background, feats, background_rows, key, seed))
    n_bg = max(bg.count(), 1)
    bg = bg.select("_b", *[F.col(f).alias(f"_z{j}") for j, f in enumerate(feats)])

    x = cohort.select(key, *feats)
    x = x.select(key, *[F.col(f).alias(f"_x{j}") for j, f in enumerate(feats)])
    chains = x.withColumn("_m", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    chains = chains.withColumn("_b", F.pmod(F.xxhash64(F.lit(seed), F.col(key), F.col("_m")),
                                            F.lit(n_bg)))
    chains = chains.join(bg, "_b", "inner").repartition(key)
    order = F.transform(
        F.sort_array(F.array(*[F.struct(F.xxhash64(F.lit(seed), F.col(key), F.col("_m"), F.lit(j)).alias("h"),
                                        F.lit(j).alias("j")) for j in range(nf)])),
        lambda s: s["j"])
    chains = chains.withColumn("_order", order)
    steps = chains.withColumn("_k", F.explode(F.sequence(F.lit(0), F.lit(nf))))
    hybrid = {f: F.when(F.array_position(F.col("_order"), j) <= F.col("_k"), F.col(f"_x{j}"))
              .otherwise(F.col(f"_z{j}")) for j, f in enumerate(feats)}
    steps = steps.withColumns(hybrid)
    scored = model.transform(steps, "_p")
    p = F.least(F.greatest(F.col("_p"), F.lit(EPS)), F.lit(1 - EPS))
    scored = scored.withColumn("_margin", F.log(p / (1 - p)))
    switched = F.struct(F.get("_order", F.col("_k") - 1).alias("j"), F.col("_margin").alias("d"))
    following = F.struct(F.get("_order", F.col("_k")).alias("j"), (-F.col("_margin")).alias("d"))
    signed = (scored.withColumn("_s", F.explode(F.array(switched, following)))
              .withColumn("_j", F.col("_s.j")).filter(F.col("_j").isNotNull()))
    name = None
    for j, f in enumerate(feats):
        nm = (F.lit(f"num__{f}") if f in model.numeric
              else F.concat(F.lit(f"cat__{f}_"), F.coalesce(F.col(f"_x{j}").cast("string"), F.lit("nan"))))
        name = F.when(F.col("_j") == j, nm) if name is None else name.when(F.col("_j") == j, nm)
    steps = signed.groupBy(key, "_m", name.alias("feature")).agg(F.sum("_s.d").alias("_d"))
    return steps.groupBy(key, "feature").agg(
        F.avg("_d").alias("contribution"),
        (F.stddev_samp("_d") / F.sqrt(F.count("_d"))).alias("std_error"))


def contribution_arrays(long: DataFrame, key: str = "customerID") -> DataFrame:
    """(key, contribs array<struct<name, contrib>>) for the reason-code
    operator; one element per model feature (bounded)."""
    return long.groupBy(key).agg(F.collect_list(F.struct(
        F.col("feature").alias("name"), F.col("contribution").alias("contrib"))).alias("contribs"))
