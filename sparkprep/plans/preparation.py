"""The preparation of a model-ready table as one fitted chain of stages."""

from __future__ import annotations

import json
import warnings
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession

from sparkprep import presets
from sparkprep.functions.columns import col
from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.missing import MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler
from sparkprep.plans.fitting import fit_stages
from sparkprep.sources.reports import read_report, write_report


def preparation_stages(
    missing_threshold: float = 0.95,
    top_n_countries: int = 15,
    scaling_method: str = "auto",
    scaling_skew_threshold: float = 1.0,
    pca_variance_threshold: float = 0.95,
    target_col: str = presets.LABEL,
    include_feature_engineering: bool = True,
    feature_engineering_kwargs: dict | None = None,
    remove_statistical_outliers: bool = False,
    include_pca: bool = True,
    split_group_col: str = presets.SPLIT,
    preserve_cols: Sequence[str] = tuple(presets.PRESERVED),
    stats_from: str = "fit",
    quantiles: str = "exact",
    valid_ranges: dict | None = None,
    zero_fill: Sequence[str] = tuple(presets.ZERO_FILLED),
    multilabel_cols: Sequence[str] = tuple(presets.MULTI_LABEL),
    onehot_cols: Sequence[str] = tuple(presets.ONE_HOT),
    target_encoded_cols: Sequence[str] = tuple(presets.TARGET_ENCODED),
) -> dict:
    """Step name -> unfitted stage, in order."""
    roles = dict(
        label=target_col, split_col=split_group_col, preserve_cols=list(preserve_cols)
    )
    stages = {
        "missing_values": MissingValueTransformer(
            threshold_drop_feature=missing_threshold,
            zero_fill=list(zero_fill),
            stats_from=stats_from,
            quantiles=quantiles,
            **roles,
        ),
        "outlier_removal": OutlierRemovalTransformer(
            valid_ranges=valid_ranges,
            remove_statistical_outliers=remove_statistical_outliers,
            stats_from=stats_from,
            quantiles=quantiles,
            **roles,
        ),
        "encoding": FeatureEncoder(
            top_n_countries=top_n_countries,
            multilabel_cols=list(multilabel_cols),
            onehot_cols=list(onehot_cols),
            target_cols=list(target_encoded_cols),
            **roles,
        ),
        "feature_engineering": FeatureEngineer(**(feature_engineering_kwargs or {})),
        "scaling": FeatureScaler(
            method=scaling_method, skew_threshold=scaling_skew_threshold, quantiles=quantiles, **roles
        ),
        "pca": FeatureReducer(variance_threshold=pca_variance_threshold, **roles),
    }
    if not include_feature_engineering:
        del stages["feature_engineering"]
    if not include_pca:
        del stages["pca"]
    return stages


def create_preprocessing_pipeline(**settings) -> Pipeline:
    """The stages as a plain ``pyspark.ml`` pipeline, fitted on whatever it is given."""
    return Pipeline(stages=list(preparation_stages(**settings).values()))


class PreprocessingPipeline:
    """Fits the stages on the training rows and transforms whole tables.

    Label, split column and preserved columns stay in their rows, so nothing has to be
    aligned afterwards. Every fitted transform is a projection or filter (target encoding
    adds joins), so fitting passes read the source columns they need and no intermediate table of rows is
    kept. Stages share passes (:mod:`sparkprep.plans.fitting`).
    """

    def __init__(
        self,
        target_col: str = presets.LABEL,
        split_group_col: str = presets.SPLIT,
        preserve_cols: Sequence[str] = (),
        **settings,
    ):
        self.target_col = target_col
        self.split_group_col = split_group_col
        self.preserve_cols = list(preserve_cols)
        self.stages = preparation_stages(
            target_col=target_col,
            split_group_col=split_group_col,
            preserve_cols=self.preserve_cols,
            **settings,
        )
        self.model: PipelineModel | None = None

    def train_rows(self, df: DataFrame) -> DataFrame:
        if self.split_group_col in df.columns:
            return df.where(col(self.split_group_col) == "train")
        warnings.warn(
            f"no column {self.split_group_col}: fitting on all rows, test rows included",
            UserWarning,
            stacklevel=3,
        )
        return df

    def fit(self, df: DataFrame) -> "PreprocessingPipeline":
        self.model = fit_stages(list(self.stages.values()), self.train_rows(df))
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        if self.model is None:
            raise ValueError("call fit first")
        return self.model.transform(df)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def get_pipeline_steps(self) -> list[str]:
        return list(self.stages)

    def get_transformer(self, step_name: str):
        """The fitted stage of that name (unfitted before ``fit``), None when unknown."""
        if step_name not in self.stages:
            return None
        if self.model is None:
            return self.stages[step_name]
        return self.model.stages[list(self.stages).index(step_name)]

    def roles(self) -> dict:
        return {
            "target_col": self.target_col,
            "split_group_col": self.split_group_col,
            "preserve_cols": self.preserve_cols,
            "steps": list(self.stages),
        }

    def save(self, path: str) -> None:
        if self.model is None:
            raise ValueError("call fit first")
        spark = SparkSession.active()
        self.model.write().overwrite().save(f"{path}/stages")
        write_report(spark.createDataFrame([(json.dumps(self.roles()),)], "roles string"), f"{path}/roles")

    @classmethod
    def load(cls, path: str) -> "PreprocessingPipeline":
        spark = SparkSession.active()
        roles = json.loads(read_report(spark, f"{path}/roles").first()["roles"])
        loaded = cls(roles["target_col"], roles["split_group_col"], roles["preserve_cols"])
        loaded.model = PipelineModel.load(f"{path}/stages")
        loaded.stages = dict(zip(roles["steps"], loaded.model.stages))
        return loaded
