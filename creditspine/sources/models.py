"""Saving and loading fitted models with their side tables."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from creditspine.operators.modelling import FittedModel
from creditspine.sources.snapshots import write_table


def model_version(name: str, train_date: str) -> str:
    return f"loan_default_{name}_{train_date.replace('-', '_')}"


def save_model(spark: SparkSession, model: FittedModel, bank: str, side_tables: dict[str, DataFrame] | None = None) -> str:
    """Write the pipeline, its description and its side tables under the version."""
    root = f"{bank.rstrip('/')}/{model.version}"
    model.pipeline.write().overwrite().save(f"{root}/pipeline")
    row = (
        model.name, model.version, model.role, model.numeric, model.categorical,
        {k: float(v) for k, v in model.params.items()}, float(model.validation_auc), model.names,
    )
    card = spark.createDataFrame([row], (
        "model_name string, model_version string, model_role string, numeric array<string>, "
        "categorical array<string>, params map<string,double>, validation_auc double, feature_names array<string>"
    ))
    card.write.mode("overwrite").json(f"{root}/card")
    for name, table in (side_tables or {}).items():
        write_table(table, f"{root}/{name}")
    return root


def load_model(spark: SparkSession, bank: str, version: str) -> FittedModel:
    root = f"{bank.rstrip('/')}/{version}"
    card = spark.read.schema(
        "model_name string, model_version string, model_role string, numeric array<string>, "
        "categorical array<string>, params map<string,double>, validation_auc double, feature_names array<string>"
    ).json(f"{root}/card").first()
    return FittedModel(
        name=card["model_name"], pipeline=PipelineModel.load(f"{root}/pipeline"), numeric=list(card["numeric"]),
        categorical=list(card["categorical"]), params=dict(card["params"]), validation_auc=card["validation_auc"],
        role=card["model_role"], version=card["model_version"], names=list(card["feature_names"]),
    )


def side_table(spark: SparkSession, bank: str, version: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{bank.rstrip('/')}/{version}/{name}")
