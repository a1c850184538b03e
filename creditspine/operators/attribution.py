"""Feature attribution: mean absolute contribution of each raw feature."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditspine.operators.modelling import FittedModel, prepare_inputs
from creditspine.operators.projection import hash_order, sample_rows, sample_rows_by
from creditspine.operators.scorers import Scorer, scorer_of

BACKGROUND_ROWS = 100
SAMPLE_ROWS = 200
#: Walks scored at a time in a task.
PAIRS = 1 << 13
#: With no more orders of the features than this, all are walked.
ALL_ORDERS = 24


def _vectors(df: DataFrame, model: FittedModel) -> DataFrame:
    return model.pipeline.transform(prepare_inputs(df, model.numeric, model.categorical))


def linear_attribution(reference: DataFrame, current: DataFrame, model: FittedModel, by: Sequence[str] = ()) -> DataFrame:
    """Exact attribution of a linear model on the margin: ``beta * (x - mean)``,
    summed over the vector entries of a raw feature, mean of the absolute value
    over all current rows of a group. ``(by..., feature, mean_abs_shap)``."""
    mean = _vectors(reference, model).select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    beta = model.classifier.coefficients.toArray()
    features = [*model.numeric, *model.categorical]
    entries: dict[str, list[int]] = {}
    for i, j in enumerate(model.owners()):
        entries.setdefault(features[j], []).append(i)
    x = F.col("x")
    aggs = []
    for owner, idx in entries.items():
        phi = sum(((F.get(x, F.lit(i)) - float(mean[i])) * float(beta[i]) for i in idx), F.lit(0.0))
        aggs.append(F.avg(F.abs(phi)).alias(owner))
    wide = _vectors(current, model).select(*by, vector_to_array("features").alias("x")).groupBy(*by).agg(*aggs)
    return wide.unpivot(list(by), list(entries), "feature", "mean_abs_shap")


def walk_orders(rows: np.ndarray, background: int, m: int, seed: int) -> np.ndarray:
    """Step (from 1) at which each feature is switched, for every (row, background row, walk).

    Few features: all orders, so the contributions are exact. Else one random
    order per pair, drawn from seed and row hash; every second background row
    takes the order of the one before it backwards.
    """
    if math.factorial(m) <= ALL_ORDERS:
        every = np.array(list(permutations(range(1, m + 1))), dtype=np.int32)
        return np.broadcast_to(every, (len(rows), background, *every.shape))
    out = np.empty((len(rows), background, 1, m), dtype=np.int32)
    for k, row in enumerate(rows):
        draws = np.random.default_rng([seed, int(row) & 0xFFFFFFFFFFFFFFFF]).random(((background + 1) // 2, m))
        steps = draws.argsort(axis=1).argsort(axis=1).astype(np.int32) + 1
        out[k, ::2, 0] = steps
        out[k, 1::2, 0] = m + 1 - steps[:background // 2]
    return out


def contributions(scorer: Scorer, x: np.ndarray, background: np.ndarray, owner: np.ndarray, m: int,
                  rows: np.ndarray, seed: int) -> np.ndarray:
    """Shapley contribution of each raw feature to the score of each row, against all background rows."""
    switched = walk_orders(rows, len(background), m, seed)
    walks = switched.shape[2]
    each = len(background) * walks
    flat = switched.reshape(-1, m)
    scores = scorer.walks(np.repeat(x, each, axis=0), np.tile(np.repeat(background, walks, axis=0), (len(x), 1)), flat, owner)
    steps = np.diff(scores, axis=1)
    return np.take_along_axis(steps, flat - 1, axis=1).reshape(len(x), each, m).mean(axis=1)


def shapley_rows(rows: DataFrame, by: Sequence[str], scorer: Scorer, background: np.ndarray, owner: np.ndarray, m: int,
                 seed: int = 42) -> DataFrame:
    """(by..., phi) from rows (by..., _row, x): one pass per task over pairs of row and background row.

    A row with a null among its entries gives nothing.
    """
    by = list(by)
    most = max(1, PAIRS // max(1, len(background)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, most):
                part = batch.slice(at, most)
                x = np.array(part.column("x").to_pylist(), dtype=float)
                phi = contributions(scorer, x, background, owner, m, part.column("_row").to_numpy(), seed)
                held = pa.FixedSizeListArray.from_arrays(pa.array(phi.ravel()), m).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in by), held], names=[*by, "phi"])

    types = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {types[c]}" for c in by], "phi array<double>"])
    whole = rows.where(~F.exists("x", lambda v: v.isNull())).select(*by, "_row", "x")
    return whole.mapInArrow(run, schema)


def mean_absolute(phi: DataFrame, by: Sequence[str], features: Sequence[str]) -> DataFrame:
    """(by..., feature, mean_abs_shap): mean absolute contribution over the rows of a group."""
    names = F.array(*[F.lit(c) for c in features])
    each = phi.select(*by, F.posexplode("phi").alias("j", "value"))
    out = each.groupBy(*by, "j").agg(F.avg(F.abs("value")).alias("mean_abs_shap"))
    return out.select(*by, F.get(names, F.col("j")).alias("feature"), "mean_abs_shap")


def sampled_attribution(reference: DataFrame, current: DataFrame, model: FittedModel, keys: Sequence[str],
                        by: Sequence[str] = (), sample: int = SAMPLE_ROWS, background: int = BACKGROUND_ROWS,
                        seed: int = 42) -> DataFrame:
    """Shapley attribution of any model on the probability scale, ``(by..., feature, mean_abs_shap)``.

    Up to ``sample`` rows of each group (a month, say) against up to
    ``background`` reference rows. Each pair walks from the background row to the
    row, switching one raw feature at a time in a random order; a feature's
    contribution is the mean change of the score at its switch. All groups are
    sampled and attributed in one job; the background, of bounded size, and the
    model travel with the tasks.
    """
    spark = current.sparkSession
    features = [*model.numeric, *model.categorical]
    owner = model.owners()
    prepare = PipelineModel(stages=model.pipeline.stages[:-1])

    def vectors(df: DataFrame, carried: Sequence[str]) -> DataFrame:
        ready = prepare.transform(prepare_inputs(df, model.numeric, model.categorical))
        return ready.select(*carried, hash_order(keys, seed).alias("_row"), vector_to_array("features").alias("x"))

    # in the order of a hash of the row, so the walks don't hang on the layout
    base = vectors(sample_rows(reference, keys, background, seed), []).orderBy("_row").select("x")
    z = np.array([r["x"] for r in base.collect()], dtype=float)
    if not len(z):
        raise ValueError("no reference rows to attribute against")
    rows = vectors(sample_rows_by(current, keys, by, sample, seed), by)
    phi = shapley_rows(rows, by, scorer_of(spark, model.classifier), z, owner, len(features), seed)
    return mean_absolute(phi, by, features)


def top_features_json(attribution: DataFrame, by: Sequence[str] = (), n: int = 5) -> DataFrame:
    """The ``n`` largest attributions, rounded to 6 places, as JSON text per key.

    The input has one row per feature, so a group is as long as the feature list.
    """
    entry = F.struct(
        (-F.col("mean_abs_shap")).alias("neg"), F.col("feature"),
        F.round("mean_abs_shap", 6).alias("mean_abs_shap"),
    )
    best = F.slice(F.array_sort(F.collect_list(entry)), 1, n)
    text = F.to_json(F.transform(best, lambda e: F.struct(
        e["feature"].alias("feature"), e["mean_abs_shap"].alias("mean_abs_shap")
    )))
    grouped = attribution.groupBy(*by) if by else attribution
    return grouped.agg(text.alias("top5_shap"))
