"""Boosted-tree classifiers on representation and strain: frames, random search, evaluation."""

from __future__ import annotations

import random

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import none_if_nan, one_hot
from . import metrics, scoring

#: Trees deeper than this are not supported by the learner.
MOST_DEPTH = 30
GRID = {"maxDepth": [3, 5, 10, 30], "stepSize": [0.05, 0.1, 0.3], "maxIter": [10, 30, 60], "subsamplingRate": [0.5, 0.8, 1.0]}


def draw(grid: dict[str, list], n: int, seed: int) -> list[dict]:
    """``n`` different random settings of a grid (fewer if it has fewer)."""
    rng, out = random.Random(seed), []
    total = 1
    for values in grid.values():
        total *= len(values)
    while len(out) < min(n, total):
        one = {k: rng.choice(v) for k, v in grid.items()}
        if one not in out:
            out.append(one)
    return out


def training_frame(screen: DataFrame, vectors: DataFrame, strains: DataFrame, splits: DataFrame, width: int) -> DataFrame:
    """Screen rows (chem_id, strain_name, label) with features and split; compounds without vector are left out."""
    joined = screen.join(vectors, "chem_id").join(strains, "strain_name").join(splits, "chem_id")
    both = F.concat(F.transform("vector", lambda x: x.cast("double")), one_hot(F.col("strain_ord"), width).cast("array<double>"))
    return joined.withColumn("features", array_to_vector(both)).withColumn("label", F.coalesce(F.col("label"), F.lit(0)).cast("double"))


def fit(frame: DataFrame, settings: dict, seed: int = 1):
    """A fitted classifier; a depth over ``MOST_DEPTH`` is an error."""
    if settings.get("maxDepth", 0) > MOST_DEPTH:
        raise ValueError(f"trees deeper than {MOST_DEPTH} are not supported")
    tree = GBTClassifier(seed=seed, **settings)
    return Pipeline(stages=[tree]).fit(frame)


def probabilities(model, frame: DataFrame) -> DataFrame:
    """``frame`` with ``p``."""
    return model.transform(frame).withColumn("p", none_if_nan(F.element_at(vector_to_array("probability"), 2))).drop("rawPrediction", "probability", "prediction", "features")


def evaluate(scored: DataFrame, threshold: float = 0.5) -> dict[str, float | None]:
    """AUROC, area under the precision-recall curve, and F1 at a threshold."""
    curve = metrics.pr_curve(scored, "label", "p")
    return {
        "auroc": metrics.auroc(scored, "label", "p").first()[0],
        "prauc": metrics.pr_auc(curve).first()[0],
        "f1": metrics.confusion(scored, "label", F.col("p") >= threshold).first()["f1"],
    }


def search(frame: DataFrame, n: int = 3, seed: int = 1, grid: dict[str, list] = GRID) -> list[dict]:
    """Random search: fitted on "train", measured on "valid" and "test"; the log has a row a setting."""
    out = []
    for settings in draw(grid, n, seed):
        model = fit(frame.where("split = 'train'"), settings, seed)
        row = {"model_params": settings}
        for part in ("valid", "test"):
            row |= {f"{part}_{k}": v for k, v in evaluate(probabilities(model, frame.where(F.col("split") == part))).items()}
        out.append(row)
    return out


def save(model, folder: str, name: str, stamp: str | None = None) -> str:
    """Save a fitted model under a name with the time, and return its path."""
    from datetime import datetime

    path = f"{folder}/{name}_{stamp or datetime.now().strftime('%d.%m.%Y_%H.%M')}"
    model.write().overwrite().save(path)
    return path


def load(path: str):
    """A model that ``save`` wrote."""
    return PipelineModel.load(path)


def predict(model, vectors: DataFrame, strains: DataFrame, width: int) -> DataFrame:
    """``chem_id, strain_name, p`` of a loaded model for every compound and strain."""
    pairs = scoring.pair_all(vectors, strains)
    both = F.concat(F.transform("vector", lambda x: x.cast("double")), one_hot(F.col("strain_ord"), width).cast("array<double>"))
    return probabilities(model, pairs.withColumn("features", array_to_vector(both))).select("chem_id", "strain_name", "p")


def repeated(frame: DataFrame, settings: dict, n_train: int = 5, seed: int = 1) -> list[dict]:
    """One setting fitted ``n_train`` times with other seeds; the log has a row a fit."""
    out = []
    for k in range(n_train):
        model = fit(frame.where("split = 'train'"), settings, seed + k)
        row = {"model_params": settings, "train": k}
        for part in ("valid", "test"):
            row |= {f"{part}_{name}": v for name, v in evaluate(probabilities(model, frame.where(F.col("split") == part))).items()}
        out.append(row)
    return out


def evaluate_models(frame: DataFrame, representation: str, n_models: int = 1, n_train: int = 1, seed: int = 1, grid: dict[str, list] = GRID) -> DataFrame:
    """Settings times repeats: a table with a row a fit, as ``model, train, model_type, model_params, representation, seed`` and metrics on both held-out parts.

    ``n_models`` random settings of ``grid``, each fitted ``n_train`` times with other seeds on "train".
    """
    spark, rows = frame.sparkSession, []
    for m, settings in enumerate(draw(grid, n_models, seed)):
        for t in range(n_train):
            own = seed + 1000 * m + t
            model = fit(frame.where("split = 'train'"), settings, own)
            row = {"model": f"model_{m}", "train": f"train_{t}", "model_type": "GBT", "model_params": str(settings), "representation": representation, "seed": own}
            for part, name in (("valid", "validation"), ("test", "test")):
                row |= {f"{name}_{k}": v for k, v in evaluate(probabilities(model, frame.where(F.col("split") == part))).items()}
            rows.append(row)
    measures = ", ".join(f"{p}_{k} double" for p in ("validation", "test") for k in ("auroc", "prauc", "f1"))
    names = "model string, train string, model_type string, model_params string, representation string, seed long"
    return spark.createDataFrame([tuple(r.values()) for r in rows], f"{names}, {measures}")
