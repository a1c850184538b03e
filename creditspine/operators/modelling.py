"""Champion / challenger models on Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from contextvars import copy_context
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from creditspine import schemas as S
from creditspine.operators.medians import ExactMedianImputer
from creditspine.operators.metrics import auc_by
from creditspine.sources.session import cut_lineage

# Candidate grids -------------------------------------------------
LR_GRID = [{"C": 0.1}, {"C": 1.0}, {"C": 10.0}]
BOOSTED_GRID = [
    {"trees": 100, "depth": 3, "rate": 0.1},
    {"trees": 200, "depth": 4, "rate": 0.1},
    {"trees": 200, "depth": 6, "rate": 0.05},
]
MODEL_SEED = 611
MISSING_CATEGORY = "Unknown"
#: Candidates fitted at the same time.
PARALLEL_FITS = 8
#: Rows of a part of the table that candidates are fitted from, up to two parts a core; then up to the larger number.
ROWS_PER_PART = 1 << 14
MOST_ROWS_PER_PART = 1 << 18


def usable_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns with at least one value (an all-null column has no median)."""
    row = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if row[c] > 0]


def prepare_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Numbers as double and null categories as their own token."""
    return df.withColumns({
        **{c: F.col(c).cast("double") for c in numeric},
        **{c: F.coalesce(F.col(c).cast("string"), F.lit(MISSING_CATEGORY)) for c in categorical},
    })


def build_preprocessor(numeric: Sequence[str], categorical: Sequence[str]) -> Pipeline:
    """Exact median imputation and standardising of numbers, one-hot of categories.

    The indexer keeps one extra index for unseen categories and the encoder
    drops exactly that last one, so an unseen category becomes all zeros.
    """
    numeric, categorical = list(numeric), list(categorical)
    stages = [
        ExactMedianImputer(numeric, [f"{c}__filled" for c in numeric]),
        VectorAssembler(inputCols=[f"{c}__filled" for c in numeric], outputCol="numeric_raw"),
        StandardScaler(inputCol="numeric_raw", outputCol="numeric_scaled", withMean=True, withStd=True),
    ]
    parts = ["numeric_scaled"]
    if categorical:
        stages += [
            StringIndexer(inputCols=categorical, outputCols=[f"{c}__idx" for c in categorical], handleInvalid="keep"),
            OneHotEncoder(
                inputCols=[f"{c}__idx" for c in categorical],
                outputCols=[f"{c}__vec" for c in categorical],
                dropLast=True,
            ),
        ]
        parts += [f"{c}__vec" for c in categorical]
    stages.append(VectorAssembler(inputCols=parts, outputCol="features"))
    return Pipeline(stages=stages)


def feature_names(preprocessor: PipelineModel, numeric: Sequence[str], categorical: Sequence[str]) -> list[str]:
    """Names of the entries of the feature vector."""
    names = list(numeric)
    for stage in preprocessor.stages:
        if hasattr(stage, "labelsArray"):
            for column, labels in zip(categorical, stage.labelsArray):
                names += [f"{column}={v}" for v in labels]
    return names


@dataclass(frozen=True)
class ClassWeights:
    """Label counts and the weights derived from them."""

    negatives: int
    positives: int

    @property
    def balanced(self) -> tuple[float, float]:
        """(weight of 0, weight of 1): n / (2 * class count)."""
        n = self.negatives + self.positives
        return n / (2.0 * self.negatives), n / (2.0 * self.positives)

    @property
    def positive(self) -> float:
        return self.negatives / self.positives


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """One row: counts per class, balanced weights and the positive weight."""
    bad = F.col(label) == 1
    n = F.col("negatives") + F.col("positives")
    return df.agg(F.count_if(~bad).alias("negatives"), F.count_if(bad).alias("positives")).select(
        "*",
        F.try_divide(n.cast("double"), F.col("negatives") * 2).alias("weight_0"),
        F.try_divide(n.cast("double"), F.col("positives") * 2).alias("weight_1"),
        F.try_divide(F.col("negatives").cast("double"), F.col("positives")).alias("positive_weight"),
    )


def fit_class_weights(df: DataFrame, label: str = "label") -> ClassWeights:
    row = class_counts(df, label).first()
    return ClassWeights(row["negatives"], row["positives"])


def logistic_candidate(params: dict, n_rows: int) -> LogisticRegression:
    """L2 logistic regression; strength C over n weighted rows is 1 / (C * n)."""
    return LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight_balanced", family="binomial",
        elasticNetParam=0.0, regParam=1.0 / (params["C"] * n_rows), maxIter=1000, standardization=False,
    )


def boosted_candidate(params: dict, n_rows: int) -> GBTClassifier:
    return GBTClassifier(
        featuresCol="features", labelCol="label", weightCol="weight_positive", maxIter=params["trees"],
        maxDepth=params["depth"], stepSize=params["rate"], seed=MODEL_SEED,
    )


FAMILIES = {
    "logistic_regression": (logistic_candidate, LR_GRID),
    "boosted_trees": (boosted_candidate, BOOSTED_GRID),
}


@dataclass
class FittedModel:
    """A selected model with what scoring and monitoring need."""

    name: str
    pipeline: PipelineModel
    numeric: list[str]
    categorical: list[str]
    params: dict
    validation_auc: float
    role: str = ""
    version: str = ""
    names: list[str] = field(default_factory=list)

    @property
    def classifier(self) -> Model:
        return self.pipeline.stages[-1]

    def owners(self) -> np.ndarray:
        """For each entry of the feature vector the number of its raw feature, numbers first."""
        out = list(range(len(self.numeric)))
        for stage in self.pipeline.stages:
            if hasattr(stage, "labelsArray"):
                for j, labels in enumerate(stage.labelsArray):
                    out += [len(self.numeric) + j] * len(labels)
        return np.array(out)


def add_weights(df: DataFrame, w: ClassWeights) -> DataFrame:
    w0, w1 = w.balanced
    bad = F.col("label") == 1
    return df.withColumns({
        "weight_balanced": F.when(bad, F.lit(w1)).otherwise(F.lit(w0)),
        "weight_positive": F.when(bad, F.lit(w.positive)).otherwise(F.lit(1.0)),
    })


def score_column(df: DataFrame) -> DataFrame:
    """Add ``score``, the probability of class 1."""
    return df.withColumn("score", vector_to_array("probability")[1])


def fit_families(split: DataFrame, numeric: Sequence[str], categorical: Sequence[str],
                 grids: dict[str, list[dict]] | None = None) -> dict[str, FittedModel]:
    """Fit every candidate on ``split == 'train'`` and keep, per family, the
    best validation AUC (the first one wins ties).

    The preprocessor does not depend on the candidate, so it is fitted once; its
    output, weights included, is stored once and all candidates of all families
    are fitted from it at the same time. A boosted candidate is a long chain of
    short jobs, so together they take about as long as the longest of them.
    """
    numeric = usable_columns(split.where(F.col("split") == "train"), numeric)
    inputs = prepare_inputs(split, numeric, categorical)
    train = inputs.where(F.col("split") == "train")
    preprocessor = build_preprocessor(numeric, categorical).fit(train)
    weights = fit_class_weights(train)
    n_rows = weights.negatives + weights.positives
    ready = add_weights(preprocessor.transform(inputs), weights).select(
        "split", "label", "features", "weight_balanced", "weight_positive"
    )
    ready = evened(cut_lineage(ready.where(F.col("split").isin("train", "val")))).persist(StorageLevel.MEMORY_AND_DISK)
    names = feature_names(preprocessor, numeric, categorical)
    jobs = [(family, params) for family, grid in (grids or {f: g for f, (_, g) in FAMILIES.items()}).items() for params in grid]

    def fit(job: tuple[str, dict]) -> tuple[float, Model]:
        family, params = job
        model = FAMILIES[family][0](params, n_rows).fit(ready.where(F.col("split") == "train"))
        auc = auc_by(score_column(model.transform(ready.where(F.col("split") == "val"))), ["split"]).first()["auc"]
        return float("-inf") if auc is None else auc, model

    try:
        ready.count()
        with ThreadPool(min(len(jobs), PARALLEL_FITS)) as pool:
            # the threads write their intermediate tables into the scope of the caller
            here = copy_context()
            fitted = pool.map(inheritable_thread_target(split.sparkSession)(lambda job: here.copy().run(fit, job)), jobs)
    finally:
        ready.unpersist()
    out: dict[str, FittedModel] = {}
    for (family, params), (auc, model) in zip(jobs, fitted):
        if model.numFeatures != len(names):
            raise ValueError("the feature names do not fit the feature vector")
        if family not in out or auc > out[family].validation_auc:
            out[family] = FittedModel(
                name=family, pipeline=PipelineModel(stages=[*preprocessor.stages, model]), numeric=list(numeric),
                categorical=list(categorical), params=params, validation_auc=auc, role=S.MODEL_ROLES.get(family, ""), names=names,
            )
    return out


def evened(df: DataFrame) -> DataFrame:
    """As many parts of equal size as the rows fill, up to two a core; every level of a
    tree and every step of a descent is one job over them, and each task reports to the driver."""
    rows, most = df.count(), 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(-(-rows // ROWS_PER_PART), most), -(-rows // MOST_ROWS_PER_PART)))


def score(df: DataFrame, model: FittedModel) -> DataFrame:
    """Rows with ``score``; helper columns of the pipeline are removed."""
    inputs = prepare_inputs(df, model.numeric, model.categorical)
    keep = [c for c in df.columns]
    scored = score_column(model.pipeline.transform(inputs))
    return scored.select(*[c for c in keep if c not in (*model.numeric, *model.categorical)], "score")


def predictions(features: DataFrame, model: FittedModel) -> DataFrame:
    """The prediction table of a batch of feature rows."""
    return score(features, model).select(
        S.CUSTOMER, S.SNAPSHOT, F.lit(model.name).alias("model_name"),
        F.lit(model.version).alias("model_version"), F.col("score").alias("model_predictions"),
    )


def scoring_metadata(preds: DataFrame) -> DataFrame:
    """Rows scored and share of null scores per month and version."""
    return preds.groupBy(S.SNAPSHOT, "model_name", "model_version").agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.coalesce(F.avg(F.col("model_predictions").isNull().cast("double")), F.lit(0.0)).alias("error_rate"),
    )


def coefficient_ranking(df: DataFrame, model: FittedModel, n: int = 10) -> DataFrame:
    """Largest coefficients of a linear model by absolute value."""
    values = model.classifier.coefficients.toArray().tolist()
    rows = [(name, float(v)) for name, v in zip(model.names, values)]
    table = df.sparkSession.createDataFrame(rows, "feature string, coefficient double")
    return table.orderBy(F.abs("coefficient").desc(), "feature").limit(n)


def compare_models(metrics: DataFrame, champion: str, challenger: str, split: str = "oot",
                   threshold: float = S.CHALLENGER_UPLIFT) -> DataFrame:
    """Champion against challenger on one split, per extra key of ``metrics``
    (columns model_version, split, auc). Uplift at the threshold recommends an
    A/B test."""
    rows = metrics.where(F.col("split") == split)
    return rows.agg(
        F.max(F.when(F.col("model_version") == champion, F.col("auc"))).alias("champion_auc_oot"),
        F.max(F.when(F.col("model_version") == challenger, F.col("auc"))).alias("challenger_auc_oot"),
    ).select(
        F.lit(champion).alias("champion_model_version"),
        F.lit(challenger).alias("challenger_model_version"),
        "champion_auc_oot",
        "challenger_auc_oot",
        (F.col("challenger_auc_oot") - F.col("champion_auc_oot")).alias("challenger_auc_uplift"),
        ((F.col("challenger_auc_oot") - F.col("champion_auc_oot")) >= threshold).alias("ab_test_recommended"),
    )
