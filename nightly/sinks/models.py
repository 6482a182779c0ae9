"""Saved forecasters: a folder with `model.json` and a coefficient table or trees."""

from __future__ import annotations

import dataclasses
import json

from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from nightly.operators.models import Fitted
from nightly.sinks.writers import save_coefficients, save_model, write_text


def save_fitted(spark: SparkSession, fitted: Fitted, path: str) -> str:
    """Write the data, then `model.json`, which makes the folder a model."""
    doc = {k: v for k, v in dataclasses.asdict(dataclasses.replace(fitted, table=None, trees=None)).items() if v is not None}
    if fitted.table is not None:
        save_coefficients(fitted.table, f"{path}/table")
        doc["columns"] = fitted.table.schema.jsonValue()
    if fitted.trees is not None:
        save_model(fitted.trees, f"{path}/trees")
    write_text(spark, f"{path}/model.json", json.dumps(doc, indent=2))
    return path


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """The model of a folder, ready to score."""
    doc = json.loads(spark.read.text(f"{path}/model.json", wholetext=True).first()["value"])
    table = spark.read.parquet(f"{path}/table") if doc.pop("columns", None) else None
    trees = GBTRegressionModel.load(f"{path}/trees") if doc["name"] == "gbt" else None
    return Fitted(**{**doc, "keys": tuple(doc["keys"])}, table=table, trees=trees)


def saved_models(spark: SparkSession, path: str) -> DataFrame:
    """name, target, keys, path of every model below ``path``."""
    found = (
        spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "model.json")
        .schema("name string, target string, keys array<string>").json(path, multiLine=True)
    )
    return found.withColumn("path", F.regexp_replace(F.input_file_name(), "/model[.]json$", ""))
