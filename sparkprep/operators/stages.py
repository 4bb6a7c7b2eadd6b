"""Shared base of the estimators and models: parameters and persistence."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable


def parameter(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


class Stage(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose settings are all parameters, so they are saved with it."""

    def value(self, name: str):
        return self.getOrDefault(getattr(self, name))

    def settings(self) -> dict:
        return {p.name: self.getOrDefault(p) for p in self.params if self.isDefined(p)}

    def metadata(self) -> set[str]:
        """Columns the stage passes through untouched."""
        return {self.value("label"), self.value("split_col"), *self.value("preserve_cols")}


class CommonParams(Params):
    label = parameter("label", "label column")
    split_col = parameter("split_col", "column with train, val or test")
    preserve_cols = parameter("preserve_cols", "key and text columns carried along untouched")


class FittedModel(Model, CommonParams, Stage):
    """A model whose fitted values are one JSON-able dictionary."""

    state = parameter("state", "fitted values")

    def __init__(self, state: dict | None = None, **settings):
        super().__init__()
        if state is not None:
            # JSON has no tuples; keep what a reloaded model would hold.
            self._set(state=json.loads(json.dumps(state)))
        self._set(**{k: v for k, v in settings.items() if self.hasParam(k)})

    @property
    def fitted(self) -> dict:
        return self.value("state")


def listed(settings: dict) -> dict:
    """Tuples as lists, as they come back from saved metadata."""
    return {k: list(v) if isinstance(v, tuple) else v for k, v in settings.items()}


class FittingStage(Estimator, CommonParams, Stage):
    def fitted_model(self, model_class, state: dict) -> FittedModel:
        model = model_class(state, **self.settings())
        model._resetUid(f"{model_class.__name__}_{uuid.uuid4().hex[:12]}")
        return model
