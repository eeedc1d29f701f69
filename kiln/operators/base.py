"""Fitted column rules: one persistable Transformer for every fitted step.

A fit is one aggregate that returns a small parameter dict; ``transform`` is a
single projection of column expressions built from those parameters, so the
fitted step runs inside whole-stage codegen and works on streaming frames.
``ColumnRules`` is a ``pyspark.ml`` Transformer with default param
persistence, so fitted steps compose with Spark ML models in a
``PipelineModel`` and save/load with ``.write().save()`` / ``.load()``.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

# kind -> function(spec, df) -> DataFrame
_APPLY: dict[str, Callable[[dict, DataFrame], DataFrame]] = {}


def register(kind: str):
    def deco(fn):
        _APPLY[kind] = fn
        return fn
    return deco


class ColumnRules(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted step: ``kind`` names the rule family, ``spec`` its JSON params."""

    kind = Param(Params._dummy(), "kind", "rule family", typeConverter=TypeConverters.toString)
    spec = Param(Params._dummy(), "spec", "fitted parameters as JSON", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, kind: str = "", spec: str = "{}"):
        super().__init__()
        self._setDefault(kind="", spec="{}")
        self._set(**self._input_kwargs)

    @classmethod
    def of(cls, kind: str, params: dict) -> "ColumnRules":
        return cls(kind=kind, spec=json.dumps(params))

    @property
    def params_dict(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    def _transform(self, df: DataFrame) -> DataFrame:
        kind = self.getOrDefault(self.kind)
        _ensure_loaded()
        return _APPLY[kind](self.params_dict, df)


def _ensure_loaded():
    # rule families register on import
    from kiln.operators import (cluster, encode, features, impute, mixtures, multikmeans, outliers,  # noqa: F401
                                scale, transform)
