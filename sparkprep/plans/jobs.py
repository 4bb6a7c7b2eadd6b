"""Whole-file jobs: acquire a raw dump, prepare its cells, split it."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkprep import presets
from sparkprep.functions.columns import col, require, value
from sparkprep.functions.countries import country_aliases
from sparkprep.operators.dictionary import Aliases, clean_lists
from sparkprep.operators.missing import MissingValueModel, MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.profile import class_distribution
from sparkprep.operators.sampling import exact_sample
from sparkprep.operators.splitting import split_data, verify_stratification
from sparkprep.plans.preparation import PreprocessingPipeline
from sparkprep.sources.reports import write_report
from sparkprep.sources.splits import save_split_metadata, save_splits
from sparkprep.sources.tables import header_names, missing_names, read_delimited, write_table
from sparkprep.workspace import land


def keep_labelled(df: DataFrame, label: str, valid: Sequence[str]) -> DataFrame:
    """Rows whose label, in lower case, is one of ``valid``; its own case is kept."""
    return df.where(col(label).isNotNull() & F.lower(col(label)).isin(list(valid)))


@dataclass
class Acquired:
    table: DataFrame
    distribution: DataFrame
    metadata: DataFrame


def acquire(
    spark: SparkSession,
    input_path: str,
    label: str = presets.LABEL,
    columns: Sequence[str] = tuple(presets.RAW_COLUMNS),
    numeric: Sequence[str] = tuple(presets.NUMERIC_COLUMNS),
    valid: Sequence[str] = tuple(presets.VALID_LABELS),
    sample_size: int | None = None,
    key: Sequence[str] | None = ("code",),
    seed: int = 42,
    multi_line: bool | None = None,
    spread: int | None = None,
) -> Acquired:
    """Read a tab-separated dump, keep known columns and valid labels, sample exactly.

    One gzip file is read by one task, so its projected rows are spread over ``spread``
    partitions; the rows are landed as Parquet once and every later pass reads that.
    """
    names = header_names(spark, input_path, "\t")
    if label not in names:
        raise ValueError(f"label column {label} not found")
    kept = [c for c in columns if c in names]
    raw = read_delimited(
        spark, input_path, columns=kept, numeric=numeric, multi_line=multi_line
    )
    if input_path.endswith(".gz"):
        raw = raw.repartition(spread or int(spark.conf.get("spark.sql.shuffle.partitions")))
    landed = land(raw, "raw")
    valid_rows = keep_labelled(landed, label, valid)
    table = valid_rows if sample_size is None else exact_sample(valid_rows, sample_size, key, seed)
    distribution = class_distribution(table, label)
    counts = landed.agg(
        F.count(F.lit(1)).alias("total_products"),
        F.count(col(label)).alias("labelled_products"),
        F.count_if(col(label).isNotNull() & F.lower(col(label)).isin(list(valid))).alias(
            "filtered_products"
        ),
    )
    per_class = {r["label"]: r["n"] for r in distribution.collect()}
    metadata = counts.select(
        "*",
        F.lit(sum(per_class.values())).cast("long").alias("kept_products"),
        F.lit(len(kept)).alias("columns"),
        F.lit(",".join(missing_names(names, columns))).alias("missing_columns"),
        F.lit(json.dumps(per_class)).alias("grade_distribution"),
        F.lit(input_path).alias("data_source"),
        F.lit(datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")).alias("acquired_at"),
    )
    return Acquired(table, distribution, metadata)


def load_and_filter_data(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    metadata_path: str | None = None,
    format: str = "parquet",
    **settings,
) -> DataFrame:
    """:func:`acquire`, written to ``output_path`` with its metadata beside it."""
    found = acquire(spark, input_path, **settings)
    write_table(found.table, output_path, format)
    if metadata_path:
        write_report(found.metadata, metadata_path)
    return found.table


def clean_countries(df: DataFrame, column: str = "countries", aliases: Aliases | None = None) -> DataFrame:
    """Canonical, sorted, deduplicated country lists in place of the raw cells.

    ``aliases`` is a table (alias, name) or a dictionary; by default that of :func:`country_aliases`.
    """
    return clean_lists(df, column, country_aliases(df.sparkSession) if aliases is None else aliases)


def drop_wide_text(df: DataFrame, columns: Sequence[str], bound: int = 10_000) -> DataFrame:
    """Drop those columns with more than ``bound`` distinct non-null values.

    A sketch decides clear cases; a count within ten standard errors of the bound is
    repeated exactly.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    error = 0.01
    rough = df.agg(
        *[F.approx_count_distinct(value(df, c), error).alias(f"d{i}") for i, c in enumerate(present)]
    ).first()
    close = [
        c for i, c in enumerate(present) if abs(rough[f"d{i}"] - bound) <= 10 * error * bound + 1
    ]
    exact = (
        df.agg(*[F.count_distinct(value(df, c)).alias(f"d{i}") for i, c in enumerate(close)]).first()
        if close
        else None
    )
    counts = {c: rough[f"d{i}"] for i, c in enumerate(present)}
    counts.update({c: exact[f"d{i}"] for i, c in enumerate(close)})
    return df.drop(*[c for c in present if counts[c] > bound])


def preprocess(
    df: DataFrame,
    label: str = presets.LABEL,
    key: Sequence[str] = ("code",),
    countries: str | None = "countries",
    aliases: Aliases | None = None,
    redundant: Sequence[str] = tuple(presets.REDUNDANT),
    wide_text: Sequence[str] = tuple(presets.WIDE_TEXT),
    wide_text_bound: int = 10_000,
    threshold: float = 0.95,
) -> tuple[DataFrame, MissingValueModel]:
    """Missing values, country lists, redundant and wide text columns of one whole table."""
    model = MissingValueTransformer(
        threshold_drop_feature=threshold, label=label, preserve_cols=list(key)
    ).fit(df)
    filled = model.transform(df)
    if countries and countries in filled.columns:
        filled = clean_countries(filled, countries, aliases)
    return drop_wide_text(filled.drop(*redundant), wide_text, wide_text_bound), model


def read_table(
    spark: SparkSession, path: str, numeric: Sequence[str] = tuple(presets.NUMERIC_COLUMNS)
) -> DataFrame:
    """A table written by an earlier stage, as CSV or Parquet."""
    if path.endswith((".csv", ".csv.gz")):
        return read_delimited(spark, path, sep=",", numeric=numeric)
    return spark.read.parquet(path)


def preprocess_dataset(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    report_path: str | None = None,
    numeric: Sequence[str] = tuple(presets.NUMERIC_COLUMNS),
    format: str = "parquet",
    **settings,
) -> tuple[DataFrame, MissingValueModel]:
    """Read a table written by an earlier stage, :func:`preprocess` it, write it and a report."""
    df = read_table(spark, input_path, numeric)
    done, model = preprocess(df, **settings)
    write_table(done, output_path, format)
    if report_path:
        write_report(model.imputation_report(spark), report_path)
    return done, model


def split_dataset(
    df: DataFrame,
    splits_path: str,
    metadata_path: str | None = None,
    label: str = presets.LABEL,
    train_ratio: float = 0.7,
    val_ratio: float = 0.15,
    test_ratio: float = 0.15,
    random_state: int = 42,
    key: Sequence[str] | None = ("code",),
) -> dict:
    """Split, write one folder per part, and return counts, shares and balance."""
    require(df, [label])
    config = {
        "train_ratio": train_ratio,
        "val_ratio": val_ratio,
        "test_ratio": test_ratio,
        "random_state": random_state,
        "target_col": label,
    }
    tagged = split_data(
        df, label, train_ratio, val_ratio, test_ratio, random_state, key=key
    )
    save_splits(tagged, splits_path)
    saved = df.sparkSession.read.parquet(splits_path)
    if metadata_path:
        save_split_metadata(saved, config, metadata_path, label)
    return verify_stratification(saved, label)


def remove_outliers(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    report_path: str | None = None,
    numeric: Sequence[str] = tuple(presets.NUMERIC_COLUMNS),
    format: str = "parquet",
    **settings,
) -> DataFrame:
    """Read a table, remove outliers, write it and, one folder for each part, the report."""
    df = read_table(spark, input_path, numeric)
    model = OutlierRemovalTransformer(**settings).fit(df)
    write_table(model.transform(df), output_path, format)
    if report_path:
        for name, part in model.outlier_report(df).items():
            write_report(part, f"{report_path}/{name}")
    return spark.read.parquet(output_path) if format == "parquet" else read_table(spark, output_path, numeric)


def prepare_dataset(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    chain_path: str | None = None,
    numeric: Sequence[str] = tuple(presets.NUMERIC_COLUMNS),
    **settings,
) -> PreprocessingPipeline:
    """From a split table to the model-ready one: read, fit on train, transform, write table and chain.

    ``settings`` go to :class:`PreprocessingPipeline`.
    """
    df = read_table(spark, input_path, numeric)
    chain = PreprocessingPipeline(**settings).fit(df)
    write_table(chain.transform(df), output_path)
    if chain_path:
        chain.save(chain_path)
    return chain
