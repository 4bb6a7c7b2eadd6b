"""Fits a chain of stages with few passes over the fitted rows.

Stages state the aggregates they need (``asks``) of the version of the columns that they see. The encoder reads
rows as the outlier stage leaves them; so does the scaler for every column that the encoder passes on and for those
derived from them. Both share one table of statistics: one pass for their texts, one for numbers. The columns that the encoder makes need none: their statistics follow
from its own counts. The reducer's means follow from the scaler's.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel, Transformer
from pyspark.sql import DataFrame

from sparkprep.functions.columns import numeric_columns
from sparkprep.operators.derived import FeatureEngineer
from sparkprep.operators.encoding import FeatureEncoder
from sparkprep.operators.reduction import FeatureReducer
from sparkprep.operators.scaling import FeatureScaler, FeatureScalerModel, scaling_state
from sparkprep.operators.tally import ROWS, Tally, number_statistics


def fit_stages(stages: list, df: DataFrame) -> PipelineModel:
    """What fitting the stages one after another on ``df`` gives."""
    fitted: list[Transformer] = []
    at = 0
    known: dict | None = None  # statistics of the scaled columns of ``df``
    while at < len(stages):
        stage = stages[at]
        sharing = _shared(stages[at:], df)
        if sharing:
            models, known = _fit_together(*sharing, df)
            at += len(models)
        elif isinstance(stage, FeatureReducer) and known:
            models, at = [_fit_reducer(stage, df, known)], at + 1
        else:
            models, at = [stage if isinstance(stage, Transformer) else stage.fit(df)], at + 1
        for model in models:
            df = model.transform(df) if at < len(stages) else df
        fitted += models
    return PipelineModel(fitted)


def _shared(stages: list, df: DataFrame) -> tuple | None:
    """Encoder, derived columns and scaler, if these come next and can share a pass."""
    if not stages or not isinstance(stages[0], FeatureEncoder):
        return None
    encoder, rest = stages[0], stages[1:]
    engineer = rest[0] if rest and isinstance(rest[0], FeatureEngineer) else None
    rest = rest[1:] if engineer else rest
    if not rest or not isinstance(rest[0], FeatureScaler):
        return None
    encoded = [c for role in ("multilabel_cols", "onehot_cols", "target_cols") for c in encoder.present(df, role)]
    if len(set(encoded)) < len(encoded):
        return None
    if engineer:
        after = engineer.transform(df.drop(*encoded))
        # A derived column that is made of an encoded one, or replaces a column, sees another version.
        if set(engineer.transform(df).columns) - set(encoded) != set(after.columns):
            return None
        new = [c for c in after.columns if c not in df.columns]
        if len(after.columns) != len(df.columns) - len(encoded) + len(new) or set(new) & set(encoded):
            return None
    return encoder, engineer, rest[0], encoded


def _fit_together(encoder, engineer, scaler, encoded: list[str], df: DataFrame) -> tuple[list, dict | None]:
    derived = engineer.transform(df) if engineer else df
    plain = [c for c in numeric_columns(derived, scaler.metadata()) if c not in encoded]
    tally = Tally(derived, encoder.asks(derived), {"numbers": plain})
    few = tally.most(encoder.bounds(derived) | {"numbers": len(plain)})
    encoding = encoder.model_of(df, tally, few)
    shown = encoding.transform(df)
    shown = engineer.transform(shown) if engineer else shown
    columns = numeric_columns(shown, scaler.metadata())
    if not columns:
        raise ValueError("no numeric columns to scale")
    empty = dict.fromkeys(("n", "mean", "std", "min", "max", "skew"))
    found = {c: empty for c in plain} | number_statistics(few["numbers"])
    made = encoder.column_statistics(derived, tally, few, encoding)
    if set(made) & set(plain):  # a made column has the name of one that was there
        models = [encoding, *([engineer] if engineer else []), scaler.fit(shown)]
        return models, None
    found |= made
    state = scaling_state(
        shown, found, columns, *(scaler.value(p) for p in ("method", "skew_threshold", "quantiles"))
    )
    scaling = scaler.fitted_model(FeatureScalerModel, state)
    known = {"rows": few[ROWS][0]["n"] if few[ROWS] else 0, "means": {}}
    for c in columns:
        mean = found[c]["mean"]
        known["means"][c] = None if mean is None else (mean - state[c]["centre"]) / state[c]["scale"]
    return [encoding, *([engineer] if engineer else []), scaling], known


def _fit_reducer(reducer: FeatureReducer, df: DataFrame, known: dict):
    columns = reducer.columns_of(df)
    if any(known["means"].get(c) is None for c in columns):
        return reducer.fit(df)
    return reducer.fit_centred(df, columns, [known["means"][c] for c in columns], known["rows"])
