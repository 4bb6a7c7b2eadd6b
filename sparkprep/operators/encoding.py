"""Categorical encodings: multi-label top-N, one-hot and smoothed target encoding."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkprep import presets
from sparkprep.functions.columns import col, number, value
from sparkprep.functions.text import tokens
from sparkprep.operators.frequent import most_frequent
from sparkprep.operators.lookup import FOUND, attach
from sparkprep.operators.stages import FittedModel, FittingStage, listed, parameter
from sparkprep.operators.tally import ROWS, Tally, cell, indicator_statistics, weighted_statistics


def top_tokens(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent tokens of a comma-joined column, equal counts by token."""
    return (
        df.select(F.explode(tokens(col(column))).alias("token"))
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "token")
        .limit(n)
    )


def frequent_tokens(df: DataFrame, column: str, n: int) -> DataFrame:
    """:func:`top_tokens` for columns with very many tokens: these are summarised per task, not shuffled."""
    return most_frequent(df.select(F.explode(tokens(col(column))).alias("token")), n)


def categories(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    values = df.select(value(df, column).alias("category")).where("category IS NOT NULL")
    return values.distinct().orderBy("category")


def multilabel_columns(parts: Column, column: str, names: list[str]) -> dict[str, Column]:
    """0/1 integer column per kept token, from an array of tokens."""
    return {f"{column}_{n}": F.array_contains(parts, F.lit(n)).cast("int") for n in names}


def onehot_columns(c: Column, column: str, names: list) -> dict[str, Column]:
    """0/1 double column per category; unknown and missing ones give all zeros."""
    return {f"{column}_{n}": c.eqNullSafe(F.lit(n)).cast("double") for n in names}


def label_target(df: DataFrame, label: str) -> Column:
    """The number a label stands for in target encoding.

    A continuous label stands for itself. Otherwise the label is a class: of two classes
    the second in order counts as 1, of more the first does.
    """
    y = value(df, label)
    if isinstance(df.schema[label].dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        number_y = number(df, label)
        broken = df.agg(F.count_if(number_y != F.floor(number_y)).alias("n")).first()["n"]
        if broken:
            return number_y
    ordered = (
        df.select(y.alias("y")).where("y IS NOT NULL").distinct().orderBy("y").limit(3).collect()
    )
    if len(ordered) > 2:
        chosen = ordered[0]["y"]
    elif len(ordered) == 2:
        chosen = ordered[1]["y"]
    else:
        return F.when(y.isNotNull(), F.lit(0.0))
    return F.when(y.isNotNull(), (y == F.lit(chosen)).cast("double"))


def target_statistics(df: DataFrame, column: str, target: Column) -> DataFrame:
    """Rows, mean and population variance of the target per category (NULL included)."""
    found = target_tables(df, [column], target).where("NOT whole")
    return found.select("category", "n", "mean", "variance")


def target_tables(df: DataFrame, columns: list[str], target: Column) -> DataFrame:
    """:func:`target_statistics` of several columns in one pass, by ``position``.

    The rows marked ``whole`` hold a column's statistics over all categories.
    """
    cells = [F.struct(F.lit(i).alias("position"), value(df, c).cast("string").alias("category")) for i, c in enumerate(columns)]
    rows = df.select(target.alias("y"), F.inline(F.array(*cells))).where("y IS NOT NULL")
    keys = [F.col("position"), F.col("category")]
    sets = rows.groupingSets([keys, keys[:1]], *keys)
    return sets.agg(
        F.grouping("category").cast("boolean").alias("whole"),
        F.count(F.lit(1)).alias("n"),
        F.avg("y").alias("mean"),
        F.var_pop("y").alias("variance"),
    )


def shrunk(n, mean, variance, whole_mean: float, whole_variance: float):
    """Empirical-Bayes mean of a category, shrunk towards the global mean.

    For columns and numbers alike; undefined where neither variance is positive.
    """
    spread = whole_variance * n
    weight = spread / (spread + variance)
    return weight * mean + (1.0 - weight) * whole_mean


ENCODING_SCHEMA = "category string, n long, encoding double"


def _fitted_target(whole, missing) -> dict:
    """Fitted values of one column, from the rows of all categories and of the missing one (None: no such rows)."""
    mean, variance = (whole["mean"], whole["variance"]) if whole and whole["filled"] else (0.0, 0.0)
    own = mean
    if missing and missing["filled"] and variance * missing["filled"] + missing["variance"]:
        own = shrunk(missing["filled"], missing["mean"], missing["variance"], mean, variance)
    return {"mean": mean, "variance": variance, "missing": own, "rows": whole["filled"] if whole else 0}


def _encodings(categories: DataFrame, state: dict) -> DataFrame:
    """(category, n, rows, encoding) of the categories (token, n, filled, mean, variance) of one column.

    ``n`` counts the labelled rows that decide, ``rows`` all; a category without labelled rows has the global mean.
    """
    n, mean, variance = F.col("filled"), F.col("mean"), F.col("variance")
    whole_mean, whole_variance = F.lit(state["mean"]), F.lit(state["variance"])
    guarded = F.when(
        (n > 0) & (whole_variance * n + variance != 0), shrunk(n, mean, variance, whole_mean, whole_variance)
    ).otherwise(whole_mean)
    return categories.select(
        F.col("token").alias("category"), n.alias("n"), F.col("n").alias("rows"), guarded.alias("encoding")
    )


def attach_encoding(df: DataFrame, column: str, state: dict, table: DataFrame) -> DataFrame:
    """Replace ``column`` by its encoding; unseen categories take the global mean."""
    text = value(df, column).cast("string")
    values = table.select(F.col("category").alias("key"), "n", F.col("encoding").alias("value"))
    joined = attach(df, text, values, state["rows"])
    encoding = (
        F.when(text.isNull(), F.lit(state["missing"]))
        .otherwise(F.coalesce(FOUND, F.lit(state["mean"])))
        .alias(column)
    )
    return joined.select(*[encoding if c == column else col(c) for c in df.columns])


class _EncoderParams:
    top_n_countries = parameter("top_n_countries", "tokens kept per multi-label column")
    multilabel_cols = parameter("multilabel_cols", "comma-joined columns")
    onehot_cols = parameter("onehot_cols", "columns encoded one-hot")
    target_cols = parameter("target_cols", "columns encoded by the label")
    max_categories = parameter("max_categories", "one-hot columns allowed before it is an error")


class FeatureEncoder(FittingStage, _EncoderParams):
    @keyword_only
    def __init__(
        self,
        *,
        top_n_countries=15,
        multilabel_cols=tuple(presets.MULTI_LABEL),
        onehot_cols=tuple(presets.ONE_HOT),
        target_cols=tuple(presets.TARGET_ENCODED),
        max_categories=10_000,
        label=presets.LABEL,
        split_col=presets.SPLIT,
        preserve_cols=tuple(presets.PRESERVED),
    ):
        super().__init__()
        self._setDefault(
            top_n_countries=15,
            multilabel_cols=list(presets.MULTI_LABEL),
            onehot_cols=list(presets.ONE_HOT),
            target_cols=list(presets.TARGET_ENCODED),
            max_categories=10_000,
            label=presets.LABEL,
            split_col=presets.SPLIT,
            preserve_cols=list(presets.PRESERVED),
        )
        self._set(**listed(self._input_kwargs))

    def present(self, df: DataFrame, role: str) -> list[str]:
        return [c for c in self.value(role) if c in df.columns]

    def asks(self, df: DataFrame) -> dict[str, Column]:
        """The cells that fitting needs to know of ``df``."""
        asks = {}
        for c in self.present(df, "multilabel_cols"):
            # A token that a cell repeats counts each time, but fills its column once. The tokens are bound
            # as a variable: an expression in the inner function would be worked out for each of them.
            once = F.transform(
                F.array(tokens(col(c))),
                lambda parts: F.transform(
                    parts, lambda t, i: cell(t, F.when(F.array_position(parts, t) == i + 1, F.lit(1.0)))
                ),
            )
            asks[f"list {c}"] = F.flatten(once)
        for c in self.present(df, "onehot_cols"):
            asks[f"single {c}"] = F.filter(F.array(cell(value(df, c))), lambda x: x["token"].isNotNull())
        by_label = self.present(df, "target_cols")
        if by_label:
            label = self.value("label")
            if label not in df.columns:
                raise ValueError(f"target encoding of {by_label} needs the label column {label}")
            y = label_target(df, label)
            asks["label"] = F.array(cell(None, y))
            for c in by_label:
                asks[f"target {c}"] = F.array(cell(value(df, c), y))
        return asks

    def bounds(self, df: DataFrame) -> dict[str, int]:
        """How many tokens of each place come to the driver."""
        out = {f"list {c}": self.value("top_n_countries") for c in self.present(df, "multilabel_cols")}
        out |= {f"single {c}": self.value("max_categories") + 1 for c in self.present(df, "onehot_cols")}
        by_label = self.present(df, "target_cols")
        return out | {f"target {c}": 1 for c in by_label} | ({"label": 1} if by_label else {})

    def model_of(self, df: DataFrame, tally: Tally, few: dict[str, list]) -> "FeatureEncoderModel":
        """The model for ``df``, whose :meth:`asks` are tallied; ``few`` are the rows of :meth:`bounds`."""
        state: dict = {"multilabel": {}, "onehot": {}, "target": {}}
        tables: dict[str, DataFrame] = {}
        for c in self.present(df, "multilabel_cols"):
            state["multilabel"][c] = [r["token"] for r in few[f"list {c}"]]
        for c in self.present(df, "onehot_cols"):
            limit = self.value("max_categories")
            found = [r["token"] for r in few[f"single {c}"]]
            if len(found) > limit:
                raise ValueError(f"{c} has more than {limit} categories for one-hot")
            state["onehot"][c] = _as_values(found, df.schema[c].dataType)
        for c in self.present(df, "target_cols"):
            whole = few["label"][0] if few["label"] else None
            missing = [r for r in few[f"target {c}"] if r["token"] is None]
            state["target"][c] = _fitted_target(whole, missing[0] if missing else None)
            known = tally.of(f"target {c}").where(F.col("token").isNotNull())
            tables[c] = _encodings(known, state["target"][c]).where("n > 0").select("category", "n", "encoding")
        model = self.fitted_model(FeatureEncoderModel, state)
        model.tables = tables
        return model

    def column_statistics(self, df: DataFrame, tally: Tally, few: dict[str, list], model: FeatureEncoderModel) -> dict:
        """Statistics of the columns that ``model`` makes of ``df``, from what was tallied; no further pass over rows."""
        rows = few[ROWS][0]["n"] if few[ROWS] else 0
        out: dict[str, dict] = {}
        for c, names in model.fitted["multilabel"].items():
            counts = {r["token"]: r["filled"] for r in few[f"list {c}"]}
            out |= {f"{c}_{t}": indicator_statistics(counts[t], rows) for t in names}
        for c, names in model.fitted["onehot"].items():
            counts = {r["token"]: r["n"] for r in few[f"single {c}"]}
            texts = _as_values(sorted(counts), df.schema[c].dataType, keep=True)
            out |= {f"{c}_{v}": indicator_statistics(counts[texts[v]], rows) for v in names}
        tables, centres = {}, {}
        for c, state in model.fitted["target"].items():
            coded = _encodings(tally.of(f"target {c}"), state)
            own = F.when(F.col("category").isNull(), F.lit(state["missing"])).otherwise(F.col("encoding"))
            tables[c], centres[c] = coded.select(own.alias("value"), F.col("rows").alias("n")), state["mean"]
        return out | weighted_statistics(tables, centres)

    def _fit(self, dataset: DataFrame) -> "FeatureEncoderModel":
        tally = Tally(dataset, self.asks(dataset))
        return self.model_of(dataset, tally, tally.most(self.bounds(dataset)))


def _as_values(texts: list[str], kind: T.DataType, keep: bool = False):
    """Sorted values of ``kind`` from their texts; with ``keep`` a dictionary from value to text."""
    read = {
        T.BooleanType: lambda x: x == "true",
        T.ByteType: int, T.ShortType: int, T.IntegerType: int, T.LongType: int,
        T.FloatType: float, T.DoubleType: float,
    }.get(type(kind), str)
    found = {read(x): x for x in texts}
    return found if keep else sorted(found)


class _EncoderWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for i, c in enumerate(self.instance.fitted["target"]):
            self.instance.tables[c].write.parquet(f"{path}/target/{i}")


class _EncoderReader(DefaultParamsReader):
    def load(self, path: str):
        model = super().load(path)
        spark = self.sparkSession
        for i, c in enumerate(model.fitted["target"]):
            model.tables[c] = spark.read.schema(ENCODING_SCHEMA).parquet(f"{path}/target/{i}")
        return model


class FeatureEncoderModel(FittedModel, _EncoderParams):
    def __init__(self, state: dict | None = None, **settings):
        super().__init__(state, **settings)
        self.tables: dict[str, DataFrame] = {}

    def copy(self, extra=None):
        that = super().copy(extra)
        that.tables = dict(self.tables)
        return that

    def write(self):
        return _EncoderWriter(self)

    @classmethod
    def read(cls):
        return _EncoderReader(cls)

    @property
    def top_countries(self) -> dict[str, list[str]]:
        return self.fitted["multilabel"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = dataset
        for c, state in self.fitted["target"].items():
            if c in df.columns:
                df = attach_encoding(df, c, state, self.tables[c])
        new: dict[str, Column] = {}
        replaced = set()
        for c, names in self.fitted["multilabel"].items():
            if c in df.columns:
                # The token array is its own projection, so it is built once per row.
                df = df.withColumn(c, tokens(col(c)))
                new.update(multilabel_columns(col(c), c, names))
                replaced.add(c)
        for c, names in self.fitted["onehot"].items():
            if c in df.columns:
                new.update(onehot_columns(value(df, c), c, names))
                replaced.add(c)
        kept = [col(c) for c in df.columns if c not in replaced]
        return df.select(*kept, *[e.alias(n) for n, e in new.items()])
