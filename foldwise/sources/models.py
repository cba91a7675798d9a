"""Fitted models on disk: a plan in JSON, tables in Parquet, MLlib models in their own folders.

Everything that ``fit_...`` returns and a ``CvResult`` are dataclasses of plain values, tables and
MLlib models. ``save_model`` writes them under one folder and publishes it as a version; ``load_model``
checks the format, the classes and the tables' schemas before it builds them again, also in another session.
"""

from __future__ import annotations

import dataclasses
import datetime
import decimal
import importlib
import json
import math
from collections.abc import Mapping

import numpy as np
from pyspark.ml.util import MLWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from foldwise.sources.versions import latest, read_text, replace, write_text

FORMAT, VERSION = "foldwise-model", 1
PACKAGE = "foldwise."


class _Writer:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder, self.parts = spark, folder, 0

    def place(self, kind: str) -> str:
        self.parts += 1
        return f"{kind}-{self.parts}"

    def plain(self, value):
        """The value as JSON; what JSON has no form for is an object with the key ``is``."""
        if value is None or isinstance(value, (bool, str, int)):
            return value
        if isinstance(value, float):
            return value if math.isfinite(value) else {"is": "float", "value": repr(value)}
        if isinstance(value, datetime.datetime):
            return {"is": "datetime", "value": value.isoformat()}
        if isinstance(value, datetime.date):
            return {"is": "date", "value": value.isoformat()}
        if isinstance(value, decimal.Decimal):
            return {"is": "decimal", "value": str(value)}
        if isinstance(value, np.generic):
            return self.plain(value.item())
        if isinstance(value, np.ndarray):
            return {"is": "array", "type": str(value.dtype), "shape": list(value.shape), "value": self.plain(value.ravel().tolist())}
        if isinstance(value, list):
            return [self.plain(v) for v in value]
        if isinstance(value, (tuple, frozenset, set, range)):
            kind = "tuple" if isinstance(value, (tuple, range)) else "set"
            return {"is": kind, "value": [self.plain(v) for v in (sorted(value, key=repr) if kind == "set" else value)]}
        if isinstance(value, Mapping):
            return {"is": "map", "value": [[self.plain(k), self.plain(v)] for k, v in value.items()]}
        if isinstance(value, T.DataType):
            return {"is": "type", "value": json.loads(value.json())}
        if isinstance(value, DataFrame):
            place = self.place("table")
            value.write.parquet(f"{self.folder}/{place}")
            return {"is": "table", "value": place, "schema": json.loads(value.schema.json())}
        if dataclasses.is_dataclass(value) and not isinstance(value, type):
            kind = type(value)
            return {"is": "model", "class": f"{kind.__module__}.{kind.__qualname__}",
                    "value": {f.name: self.plain(getattr(value, f.name)) for f in dataclasses.fields(value)}}
        if isinstance(value, MLWritable):
            place = self.place("mllib")
            value.write().save(f"{self.folder}/{place}")
            return {"is": "mllib", "class": f"{type(value).__module__}.{type(value).__qualname__}", "value": place}
        raise TypeError(f"a {type(value).__name__} cannot be saved")


def _class_of(name: str, package: str) -> type:
    """A class of this package or of MLlib; the file is data and names nothing else."""
    if not name.startswith(package):
        raise ValueError(f"'{name}' is not a model class")
    module, _, kind = name.rpartition(".")
    found = getattr(importlib.import_module(module), kind, None)
    if not isinstance(found, type):
        raise ValueError(f"unknown model class '{name}'")
    return found


class _Reader:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def value(self, given):
        if isinstance(given, list):
            return [self.value(v) for v in given]
        if not isinstance(given, dict):
            return given
        kind, value = given["is"], given["value"]
        if kind == "float":
            return float(value)
        if kind == "datetime":
            return datetime.datetime.fromisoformat(value)
        if kind == "date":
            return datetime.date.fromisoformat(value)
        if kind == "decimal":
            return decimal.Decimal(value)
        if kind == "array":
            return np.array([self.value(v) for v in value], dtype=given["type"]).reshape(given["shape"])
        if kind == "tuple":
            return tuple(self.value(v) for v in value)
        if kind == "set":
            return frozenset(self.value(v) for v in value)
        if kind == "map":
            return {self.value(k): self.value(v) for k, v in value}
        if kind == "type":
            return T._parse_datatype_json_value(value)
        if kind == "table":
            schema = T.StructType.fromJson(given["schema"])
            found = self.spark.read.parquet(f"{self.folder}/{value}")
            want = [(f.name, f.dataType.simpleString()) for f in schema.fields]
            have = [(f.name, f.dataType.simpleString()) for f in found.schema.fields]
            if want != have:
                raise ValueError(f"table '{value}' has the columns {have}, the model needs {want}")
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{value}")
        if kind == "model":
            found = _class_of(given["class"], PACKAGE)
            fields = {f.name for f in dataclasses.fields(found)}
            if set(value) - fields:
                raise ValueError(f"{given['class']} has no fields {sorted(set(value) - fields)}")
            return found(**{k: self.value(v) for k, v in value.items()})
        if kind == "mllib":
            return _class_of(given["class"], "pyspark.ml.").load(f"{self.folder}/{value}")
        raise ValueError(f"unknown kind of value '{kind}'")


def save_model(model, path: str, spark: SparkSession | None = None) -> None:
    """Write a fitted model (or a list, tuple or mapping of them); a later save replaces it as a whole."""
    spark = spark or SparkSession.getActiveSession()

    def write(folder: str, before) -> None:
        plan = _Writer(spark, folder).plain(model)
        write_text(spark, f"{folder}/model.json", json.dumps({"format": FORMAT, "version": VERSION, "model": plan}))

    replace(spark, path, write)


def load_model(spark: SparkSession, path: str):
    """The model that ``save_model`` wrote last."""
    found = latest(spark, path)
    if found is None:
        raise FileNotFoundError(f"no model in {path}")
    given = json.loads(read_text(spark, f"{found.folder}/model.json"))
    if given.get("format") != FORMAT or given.get("version") != VERSION:
        raise ValueError(f"{path} is not a model of format {FORMAT} {VERSION}")
    return _Reader(spark, found.folder).value(given["model"])
