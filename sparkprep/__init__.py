"""Preparation of large labelled tables as Spark DataFrame jobs."""

from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.missing import MissingValueTransformer
from sparkprep.operators.outliers import OutlierRemovalTransformer
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler
from sparkprep.operators.splitting import split_data
from sparkprep.plans.preparation import PreprocessingPipeline, create_preprocessing_pipeline

__all__ = [
    "FeatureEncoder",
    "FeatureEngineer",
    "FeatureReducer",
    "FeatureScaler",
    "MissingValueTransformer",
    "OutlierRemovalTransformer",
    "PreprocessingPipeline",
    "create_preprocessing_pipeline",
    "split_data",
]
