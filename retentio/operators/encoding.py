"""Bounded encoding of model inputs and the written fit matrix.

`plan_encoding` looks at the training rows in a fixed number of jobs:

* a distinct-count sketch per text column decides how it is encoded. Up to
  MAX_VALUES values: a dictionary, one slot per value (an unseen value has
  all slots 0). More: HASH_SLOTS hashed slots, so an id or free-text column
  never brings its vocabulary to the driver. NULL is the value 'nan'.
* one pass of exact quantiles gives every numeric column its median (the
  imputation value) and up to BINS - 1 cuts.

`build_matrix` writes one table: keys, labels, and `x`, an array of small
integers (bin numbers and 0/1 slots). All models of these rows fit from it,
so the engineered table is computed once, whatever the number of models.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.quantiles import cuts_and_median, ranked_values
from ..plans.tables import materialize
from .features import MODEL_EXCLUDE, split_by_dtype

#: values of a dictionary column, slots of a hashed one, bins of a numeric one
MAX_VALUES = 200
HASH_SLOTS = 64
BINS = 64
MISSING = "nan"
SCHEMA = "place int, name string, kind string, fill double, cuts array<double>, values array<string>, slots int"


@dataclass
class Encoding:
    """How each input column becomes slots of `x`."""

    numeric: list[str] = field(default_factory=list)
    fill: dict[str, float] = field(default_factory=dict)
    cuts: dict[str, list[float]] = field(default_factory=dict)
    #: values of a dictionary column, or the number of slots of a hashed one
    text: dict[str, list[str] | int] = field(default_factory=dict)

    @property
    def categorical(self) -> list[str]:
        return list(self.text)

    def names(self) -> list[str]:
        """Name of every slot, in order: num__col, cat__col_value, cat__col_#slot."""
        out = [f"num__{c}" for c in self.numeric]
        for c, how in self.text.items():
            each = [f"#{i}" for i in range(how)] if isinstance(how, int) else how
            out += [f"cat__{c}_{v}" for v in each]
        return out

    def filled(self, c: str) -> Column:
        """A numeric input as a double, the median where it is missing."""
        v = F.col(f"`{c}`").cast("double")
        return F.coalesce(F.when(~F.isnan(v), v), F.lit(self.fill[c]))

    def column(self) -> Column:
        """`x` as array<double>: one narrow expression per slot."""
        slots = []
        for c in self.numeric:
            slots.append(_bin(self.filled(c), self.cuts[c]))
        for c, how in self.text.items():
            v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING))
            if isinstance(how, int):
                at = F.pmod(F.xxhash64(v), F.lit(how))
                slots += [(at == i).cast("double") for i in range(how)]
            else:
                slots += [(v == value).cast("double") for value in how]
        return F.array(*slots).cast("array<double>")

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per input column: its kind and what encodes it."""
        rows = [(i, c, "numeric", float(self.fill[c]), [float(x) for x in self.cuts[c]], None, None)
                for i, c in enumerate(self.numeric)]
        for i, (c, how) in enumerate(self.text.items(), len(rows)):
            hashed = isinstance(how, int)
            rows.append((i, c, "hashed" if hashed else "dictionary", None, None,
                         None if hashed else list(how), how if hashed else None))
        return spark.createDataFrame(rows, SCHEMA)

    @classmethod
    def from_table(cls, table: DataFrame) -> "Encoding":
        """Read back (one row per column)."""
        out = cls()
        for r in table.orderBy("place").collect():
            if r["kind"] == "numeric":
                out.numeric.append(r["name"])
                out.fill[r["name"]], out.cuts[r["name"]] = r["fill"], list(r["cuts"])
            else:
                out.text[r["name"]] = r["slots"] if r["kind"] == "hashed" else list(r["values"])
        return out


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cuts lie below a value. The value is a lambda's variable, so
    it is computed once a row."""
    edges = F.array(*map(F.lit, cuts)).cast("array<double>")
    return F.get(F.transform(F.array(value), lambda v: F.size(
        F.filter(edges, lambda cut: cut < v))), 0).cast("double")


def plan_encoding(train: DataFrame, exclude=MODEL_EXCLUDE, max_values: int = MAX_VALUES,
                  hash_slots: int = HASH_SLOTS, bins: int = BINS) -> Encoding:
    num, cat = split_by_dtype(train, exclude)
    out = Encoding(numeric=num)
    if cat:
        out.text = _text_columns(train, cat, max_values, hash_slots)
    if num:
        pairs = F.explode(F.array(*[F.struct(
            F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in num])).alias("p")
        long = train.select(pairs).select("p.feature", "p.value").filter(~F.isnan("value"))
        ranked = ranked_values(long, F.col("value"), ["feature"])
        # a row per numeric column
        found = {r["feature"]: r for r in cuts_and_median(ranked, bins, ["feature"]).collect()}
        out.cuts = {c: list(found[c]["cuts"]) if c in found else [] for c in num}
        out.fill = {c: found[c]["median"] if c in found else 0.0 for c in num}
    return out


def _text_columns(train: DataFrame, cat: list[str], max_values: int, slots: int) -> dict:
    """Dictionary or number of slots of each text column. Only columns whose
    sketch allows a dictionary are listed, at most max_values + 1 values each."""
    value = {c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING)) for c in cat}
    guess = train.agg(*[F.approx_count_distinct(v).alias(f"n{i}")
                        for i, v in enumerate(value.values())]).first()
    small = [c for i, c in enumerate(cat) if guess[i] <= max_values]
    found: dict[str, list[str]] = {c: [] for c in small}
    if small:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), value[c].alias("value"))
                                    for c in small])).alias("p")
        # the sketch bounds the rows: columns x (max_values and its error)
        for r in train.select(pairs).select("p.*").distinct().collect():
            found[r["name"]].append(r["value"])
    return {c: sorted(found[c]) if c in found and len(found[c]) <= max_values else slots
            for c in cat}


def build_matrix(rows: DataFrame, encoding: Encoding, keep: list[str]) -> DataFrame:
    """The written fit matrix: `keep` columns and `x` (array<smallint>)."""
    return materialize(rows.select(*keep, encoding.column().cast("array<smallint>").alias("x")),
                       "matrix")


def with_features(df: DataFrame, x: str = "x", out: str = "features") -> DataFrame:
    return df.withColumn(out, array_to_vector(F.col(x).cast("array<double>")))
