"""Evidence scorecard: an additive churn model trained by one aggregation
(G7a), with exact per-feature contributions.

Fit = one pass over the training rows: every row emits one (feature,
value) pair per feature, and `groupBy(feature, value)` counts rows and
positives per label with map-side partial aggregation (a value holding a
third of all rows costs one partial row per task). Several labels are fit
in the same pass. Per (feature, value) and label:

    woe   = ln((pos + .5) / (P + 1)) - ln((neg + .5) / (N + 1))
    mean  = sum over the feature's values of n * woe / n_train
    contribution = woe - mean       (unseen value: woe = 0)
    margin = ln((P + .5) / (N + .5)) + sum of woe
           = base + sum of contributions,  base = prior + sum of means
    prob  = 1 / (1 + exp(-margin))

For an additive model `woe - mean` is the exact Shapley value against the
training distribution, so reason codes are exact, not sampled.

The inputs are all text and numeric columns of the table. Scoring is one
narrow stage: a small model's weights are literal maps in the expression;
a larger one's are lookup tables, one per feature, broadcast when its row
count is under the limit (known from the fitted model), else joined through
a salted shuffle. The results are the same.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.lookup import MAX_BROADCAST_ROWS, lookup_join
from .features import MODEL_EXCLUDE, split_by_dtype


@dataclass(frozen=True)
class Feature:
    name: str
    kind: str = "cat"        # cat | num
    width: float = 1.0       # bin width for num features

    def value(self) -> Column:
        """Binned value as text; NULL is its own category 'nan'."""
        c = F.col(self.name)
        if self.kind == "num":
            c = F.floor(c / F.lit(float(self.width))).cast("bigint")
        return F.coalesce(c.cast("string"), F.lit("nan"))

    def encoded(self, value: Column) -> Column:
        """Encoded feature name in the `cat__col_value` / `num__col` style."""
        if self.kind == "num":
            return F.lit(f"num__{self.name}")
        return F.concat(F.lit(f"cat__{self.name}_"), value)


#: bin width of a numeric input; 1 for any other
BIN_WIDTHS = {"tenure": 12.0, "MonthlyCharges": 20.0, "TotalCharges": 500.0,
              "Avg_Historical_Charge": 20.0}
#: up to this many weights in all are literals of the scoring expression
MAX_LITERAL_VALUES = 2_000


def features_by_dtype(df: DataFrame, exclude=MODEL_EXCLUDE, widths=BIN_WIDTHS) -> tuple[Feature, ...]:
    """Every model input of a table: text and boolean columns as categories,
    then numeric columns in bins; keys, split flag and labels are left out."""
    num, cat = split_by_dtype(df, exclude)
    return (tuple(Feature(c) for c in cat)
            + tuple(Feature(c, "num", widths.get(c, 1.0)) for c in num))


def _ln(x: Column) -> Column:
    return F.log(x)


@dataclass
class Scorecard:
    table: DataFrame                 # feature, value, n, c_<label>...
    labels: tuple[str, ...]
    features: tuple[Feature, ...]
    base: dict                       # label -> base margin
    defaults: dict                   # (feature, label) -> contribution of an unseen value
    sizes: dict                      # feature -> number of values
    max_broadcast_rows: int = MAX_BROADCAST_ROWS

    def transform(self, df: DataFrame, outputs: dict[str, str],
                  contributions: str | None = None, contrib_label: str | None = None) -> DataFrame:
        """Adds one probability column per label (`outputs` maps label ->
        column name) and, optionally, an array<struct<name, contrib>> for
        `contrib_label` ordered as the features."""
        out = df.withColumns({f"_fv{i}": f.value() for i, f in enumerate(self.features)})
        if sum(self.sizes.values()) <= min(MAX_LITERAL_VALUES, self.max_broadcast_rows):
            out = out.withColumns(self._literal_weights())
        else:
            for i, f in enumerate(self.features):
                small = (self.table.filter(F.col("feature") == f.name)
                         .select(F.col("value").alias(f"_fv{i}"),
                                 *[F.col(f"c_{l}").alias(f"_c{i}_{l}") for l in self.labels]))
                out = lookup_join(out, small, f"_fv{i}", "left",
                                  max_broadcast_rows=self.max_broadcast_rows,
                                  small_rows=self.sizes.get(f.name, 0))

        def contrib(i: int, f: Feature, label: str) -> Column:
            return F.coalesce(F.col(f"_c{i}_{label}"), F.lit(self.defaults[(f.name, label)]))

        cols = {}
        for label, name in outputs.items():
            margin = F.lit(self.base[label])
            for i, f in enumerate(self.features):
                margin = margin + contrib(i, f, label)
            cols[name] = 1.0 / (1.0 + F.exp(-margin))
        if contributions:
            lab = contrib_label or next(iter(outputs))
            cols[contributions] = F.array(*[
                F.struct(f.encoded(F.col(f"_fv{i}")).alias("name"),
                         contrib(i, f, lab).alias("contrib"))
                for i, f in enumerate(self.features)])
        out = out.withColumns(cols)
        helpers = [c for c in out.columns if c.startswith("_fv") or c.startswith("_c")]
        return out.drop(*helpers)


    def _literal_weights(self) -> dict[str, Column]:
        """The weight columns as look-ups in literal maps: no join. Reads the
        model table once (at most MAX_LITERAL_VALUES rows)."""
        entries: dict[str, list] = {f.name: [] for f in self.features}
        for r in self.table.select("feature", "value", *[f"c_{l}" for l in self.labels]).collect():
            entries[r["feature"]].append(r)
        out = {}
        for i, f in enumerate(self.features):
            rows = sorted(entries[f.name], key=lambda r: r["value"])
            for l in self.labels:
                pairs = [F.lit(x) for r in rows for x in (r["value"], r[f"c_{l}"])]
                out[f"_c{i}_{l}"] = (F.try_element_at(F.create_map(*pairs), F.col(f"_fv{i}"))
                                     if pairs else F.lit(None).cast("double"))
        return out


def fit_scorecard(train: DataFrame, labels, features=None,
                  max_broadcast_rows: int = MAX_BROADCAST_ROWS,
                  materialize: bool = True) -> Scorecard:
    labels = tuple(labels)
    features = features_by_dtype(train) if features is None else tuple(features)
    pairs = F.array(*[F.struct(F.lit(f.name).alias("feature"), f.value().alias("value"))
                      for f in features])
    long = (train.select(*[F.coalesce(F.col(l).cast("int"), F.lit(0)).alias(l) for l in labels],
                         F.explode(pairs).alias("fv"))
            .select("fv.feature", "fv.value", *labels))
    agg = long.groupBy("feature", "value").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(l).alias(f"pos_{l}") for l in labels])

    # totals and means are per feature: aggregate to one row per feature
    # (bounded by the feature list, so broadcasting them is safe) and join
    # back; no window, so a feature with millions of values is not one task
    tot = agg.groupBy("feature").agg(F.sum("n").alias("n_train"),
                                     *[F.sum(f"pos_{l}").alias(f"P_{l}") for l in labels])
    t = agg.join(F.broadcast(tot), "feature")
    cols = {}
    for l in labels:
        P = F.col(f"P_{l}")
        N = F.col("n_train") - P
        pos, neg = F.col(f"pos_{l}"), F.col("n") - F.col(f"pos_{l}")
        cols[f"woe_{l}"] = _ln((pos + 0.5) / (P + 1.0)) - _ln((neg + 0.5) / (N + 1.0))
    t = t.withColumns(cols)
    means = t.groupBy("feature").agg(*[
        (F.sum(F.col("n") * F.col(f"woe_{l}")) / F.first("n_train")).alias(f"mean_{l}")
        for l in labels])
    t = t.join(F.broadcast(means), "feature")
    t = t.withColumns({f"c_{l}": F.col(f"woe_{l}") - F.col(f"mean_{l}") for l in labels})
    if materialize:
        # the small model table is written once to the shared folder (one
        # job; lineage cut, later lookups read Parquet)
        from ..plans.tables import materialize as write_back
        t = write_back(t, "scorecard")

    # per-feature summary: one row per feature (bounded by the feature list)
    summary = t.groupBy("feature").agg(
        F.count(F.lit(1)).alias("values"), F.first("n_train").alias("n_train"),
        *[F.first(f"P_{l}").alias(f"P_{l}") for l in labels],
        *[F.first(f"mean_{l}").alias(f"mean_{l}") for l in labels]).collect()
    sizes = {r["feature"]: r["values"] for r in summary}
    defaults = {(r["feature"], l): -r[f"mean_{l}"] for r in summary for l in labels}
    import math
    base = {}
    for l in labels:
        n_train, P = summary[0]["n_train"], summary[0][f"P_{l}"]
        prior = math.log((P + 0.5) / (n_train - P + 0.5))
        # sum the means in feature order (deterministic)
        means = {r["feature"]: r[f"mean_{l}"] for r in summary}
        base[l] = prior + sum(means[f.name] for f in features if f.name in means)
    table = t.select("feature", "value", "n", *[f"pos_{l}" for l in labels],
                     *[f"woe_{l}" for l in labels], *[f"c_{l}" for l in labels])
    return Scorecard(table, labels, features, base, defaults, sizes, max_broadcast_rows)
