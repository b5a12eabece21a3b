"""Spark ML classifiers, cross-validation, out-of-fold scores, search and comparison tables."""

from __future__ import annotations

import random
import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import number, quoted, text, with_exprs
from ..session import ensure_checkpoint_dir, materialize, new_path, spread
from .encoding import PreprocessorModel, build_preprocessor, fit_folds
from .evaluation import auc
from .newton import NewtonLogistic
from .ranking import argmax, summarise_folds, top_k
from .sampling import class_counts

Resample = Callable[[DataFrame, str, str], DataFrame]
Learner = Callable[[int], Any]


def scale_pos_weight(df: DataFrame, label: str) -> int:
    """Negatives per positive, truncated."""
    counts = class_counts(df, label)
    if not counts.get(1):
        raise ValueError(f"{label} has no positive rows")
    return counts.get(0, 0) // counts[1]


def class_weights(df: DataFrame, label: str) -> dict[object, float]:
    """Balanced weights: rows / (classes x rows of the class)."""
    counts = {g: n for g, n in class_counts(df, label).items() if g is not None}
    n = sum(counts.values())
    return {g: n / (len(counts) * c) for g, c in counts.items()}


def add_class_weight(df: DataFrame, label: str, weights: Mapping[object, float], out: str) -> DataFrame:
    """The weight of each row's class as a column."""
    branches = " ".join(f"WHEN {quoted(label)} = {text(g) if isinstance(g, str) else g} THEN {number(w)}" for g, w in weights.items())
    return with_exprs(df, {out: f"CASE {branches} END"})


def logistic(c: float = 1.0, max_iter: int = 1000) -> Learner:
    """Ridge logistic regression with inverse strength ``c``; the mean loss makes it 1 / (c x rows)."""
    return lambda n: LogisticRegression(
        maxIter=max_iter, regParam=1.0 / (c * n), elasticNetParam=0.0, standardization=False
    )


def logistic_newton(c: float = 1.0, max_steps: int = 50) -> Learner:
    """The same regression, taken to its optimum by Newton steps."""
    return lambda n: NewtonLogistic(1.0 / (c * n), max_steps)


def random_forest(trees: int = 100, depth: int = 10, seed: int = 42) -> Learner:
    """Random forest. Spark grows trees level by level, so a depth is needed (at most 30)."""
    return lambda n: RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed)


def boosted(
    rounds: int = 300,
    rate: float = 0.05,
    depth: int = 5,
    min_leaf: int = 1,
    rows: float = 1.0,
    columns: float = 1.0,
    seed: int = 42,
) -> Learner:
    """Gradient-boosted trees. ``columns`` is drawn per node; there is no leaf limit and no L1/L2."""
    return lambda n: GBTClassifier(
        maxIter=rounds,
        stepSize=rate,
        maxDepth=depth,
        minInstancesPerNode=min_leaf,
        subsamplingRate=rows,
        featureSubsetStrategy="all" if columns >= 1.0 else f"{columns:.4f}",
        seed=seed,
    )


#: Published parameter names that :func:`boosted_from` uses.
USED_PARAMS = ("n_estimators", "learning_rate", "max_depth", "min_child_samples", "subsample", "colsample_bytree")


def boosted_from(params: Mapping[str, float], max_rounds: int | None = None, seed: int = 42) -> Learner:
    """A boosted learner from published parameter names; those without a Spark twin are not used. ``max_rounds`` serves quick runs."""
    rounds = int(params["n_estimators"])
    return boosted(
        rounds if max_rounds is None else min(rounds, max_rounds),
        params["learning_rate"],
        int(params["max_depth"]),
        int(params["min_child_samples"]),
        params["subsample"],
        params["colsample_bytree"],
        seed,
    )


@dataclass(frozen=True)
class ModelSpec:
    """A named candidate.

    ``features`` limits the columns (all others too if ``None``). ``learner`` is ``None`` for the
    majority-class baseline. ``weight`` is ``"balanced"``, ``"positive"`` or ``None``. ``resample``
    takes (encoded training rows, label, key) and returns the rows to learn from.
    """

    name: str
    learner: Learner | None
    features: Sequence[str] | None = None
    weight: str | None = None
    resample: Resample | None = None


@dataclass(frozen=True)
class FittedModel:
    """A preprocessor and a classifier, both fitted on the same training rows."""

    spec: ModelSpec
    preprocessor: PreprocessorModel | None
    classifier: Any
    constant: float | None = None

    def score(self, df: DataFrame, keep: Sequence[str], out: str = "SCORE") -> DataFrame:
        """``keep`` columns and the probability of class 1."""
        if self.constant is not None:
            return df.select(*keep, F.lit(self.constant).alias(out))
        encoded = self.preprocessor.encode(df, keep)
        return self.score_encoded(encoded.withColumn("features", array_to_vector("x")), out).select(*keep, out)

    def score_encoded(self, df: DataFrame, out: str = "SCORE") -> DataFrame:
        """Add the probability of class 1 to a table with a ``features`` vector."""
        scored = self.classifier.transform(df).withColumn(out, vector_to_array("probability")[1])
        return scored.drop("rawPrediction", "probability", "prediction")

    def importances(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): impurity gain of a tree model, |weight| of a linear one."""
        values = (
            self.classifier.featureImportances
            if hasattr(self.classifier, "featureImportances")
            else abs(self.classifier.coefficients.toArray())
        )
        rows = [(f, float(v)) for f, v in zip(self.preprocessor.feature_names, values)]
        return spark.createDataFrame(rows, "feature string, importance double")

    def idle_features(self) -> list[str]:
        """Features that no split of a tree model looks at; none for other models."""
        if not hasattr(self.classifier, "trees"):
            return []
        used = {int(i) for t in self.classifier.trees for i in re.findall(r"\(feature (\d+) ", t.toDebugString)}
        return [f for i, f in enumerate(self.preprocessor.feature_names) if i not in used]

    def top_features(self, spark: SparkSession, k: int = 25) -> DataFrame:
        return top_k(self.importances(spark), "importance", k, "feature")


def fit_encoder(
    train: DataFrame, features: Sequence[str] | None, label: str, key: str, exclude: Sequence[str] = ()
) -> tuple[PreprocessorModel, DataFrame]:
    """Fit the preprocessing on ``train`` and write its encoded rows: (key, label, x).

    The learners pass over the rows many times, so they read them as a table.
    """
    chosen = train if features is None else train.select(key, label, *features)
    chosen = spread(chosen, len(chosen.columns), "training")
    encoder = build_preprocessor(chosen, [key, label, *exclude]).fit(chosen)
    return encoder, materialize(encoder.encode(chosen, [key, label]), "encoded")


def fit_encoded(
    spec: ModelSpec, encoder: PreprocessorModel, rows: DataFrame, label: str, key: str
) -> FittedModel:
    """Resample and weight encoded training rows as ``spec`` says, and fit its classifier."""
    ensure_checkpoint_dir(rows.sparkSession)
    if spec.resample is not None:
        rows = materialize(spec.resample(rows, label, key), "resampled")
    if spec.weight == "balanced":
        rows = add_class_weight(rows, label, class_weights(rows, label), "weight")
    elif spec.weight == "positive":
        rows = add_class_weight(rows, label, {0: 1.0, 1: float(scale_pos_weight(rows, label))}, "weight")
    elif spec.weight is not None:
        raise ValueError(f"unknown weight {spec.weight!r}")
    learner = spec.learner(rows.count()).setLabelCol(label).setFeaturesCol("features")
    if spec.weight is not None:
        learner = learner.setWeightCol("weight")
    ready = rows.withColumns({"features": array_to_vector("x"), label: F.col(label).cast("double")})
    # Spark's learners keep the rows in memory as they are dealt, and pass over them many times.
    ready = spread(ready.drop("x"), len(encoder.feature_names))
    return FittedModel(spec, encoder, learner.fit(ready))


def fit_majority(spec: ModelSpec, train: DataFrame, label: str) -> FittedModel:
    """The most frequent label as a constant score; the smaller label among equals."""
    counts = class_counts(train, label)
    return FittedModel(spec, None, None, float(min(counts, key=lambda g: (-counts[g], g))))


def fit_model(
    spec: ModelSpec, train: DataFrame, label: str, key: str, exclude: Sequence[str] = ()
) -> FittedModel:
    """Fit preprocessing and classifier on ``train``. The key and the label are never features."""
    if spec.learner is None:
        return fit_majority(spec, train, label)
    encoder, rows = fit_encoder(train, spec.features, label, key, exclude)
    return fit_encoded(spec, encoder, rows, label, key)


def _run(spark: SparkSession, tasks: Iterable[Callable[[], Any]], parallelism: int) -> list[Any]:
    tasks = list(tasks)
    if parallelism <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda t: inheritable_thread_target(spark)(t)(), tasks)


def _encoded_folds(
    df: DataFrame, lists: Sequence[tuple[str, ...] | None], label: str, key: str, k: int, fold: str, kept: Sequence[str]
) -> dict[tuple, tuple[PreprocessorModel, DataFrame, DataFrame]]:
    """(feature list, fold) -> the encoder fitted outside the fold, and the rows outside and inside it, encoded.

    Columns are fitted once for all folds and lists; one job per list writes the encoded rows of all folds.
    """
    rest = [c for c in df.columns if c not in {label, key, fold}]
    wanted = rest if None in lists else [c for c in rest if any(c in features for features in lists)]
    df = spread(df, len(df.columns), "folded")
    whole = build_preprocessor(df.select(*wanted), [])
    fitted = fit_folds(df, whole.numeric, whole.categorical, fold, range(k))
    out = {}
    for features in lists:
        encoders = [fitted[i] if features is None else fitted[i].only(features) for i in range(k)]
        parts = [
            e.encode(df, kept).select("*", F.lit(i).alias("_left_out"), (F.col(fold) == i).alias("_held"))
            for i, e in enumerate(encoders)
        ]
        path = new_path(df.sparkSession, "encoded-folds")
        every = reduce(DataFrame.unionByName, parts).where("_held IS NOT NULL")
        every.write.partitionBy("_left_out", "_held").parquet(path)
        table = df.sparkSession.read.schema(every.schema).parquet(path)
        for i, e in enumerate(encoders):
            own = table.where(F.col("_left_out") == i)
            out[features, i] = e, own.where("NOT _held").select(key, label, "x"), own.where("_held").select(*kept, "x")
    return out


def out_of_fold(
    df: DataFrame,
    specs: Sequence[ModelSpec],
    label: str,
    key: str,
    k: int,
    fold: str = "fold",
    keep: Sequence[str] = (),
    parallelism: int = 1,
) -> DataFrame:
    """Each row scored, per model, by the fit that did not see it: (model, fold, key, label, ..., SCORE).

    ``df`` carries the fold column and should be a table or otherwise cheap to read again.
    Preprocessing is fitted on the training part of each fold, in passes that all folds and models
    share. Fits run side by side up to ``parallelism``.
    """
    spark, kept = df.sparkSession, list(dict.fromkeys([fold, key, label, *keep]))
    learned = [s for s in specs if s.learner is not None]
    lists = list(dict.fromkeys(None if s.features is None else tuple(s.features) for s in learned))
    encoded = _encoded_folds(df, lists, label, key, k, fold, kept) if lists else {}

    def held_out(spec: ModelSpec, i: int) -> DataFrame:
        if spec.learner is None:
            model = fit_majority(spec, df.filter(F.col(fold) != i), label)
            scored = model.score(df.filter(F.col(fold) == i), kept)
        else:
            encoder, rows, held = encoded[None if spec.features is None else tuple(spec.features), i]
            model = fit_encoded(spec, encoder, rows, label, key)
            scored = model.score_encoded(held.withColumn("features", array_to_vector("x"))).select(*kept, "SCORE")
        return scored.withColumn("model", F.lit(spec.name))

    fits = [lambda s=s, i=i: held_out(s, i) for s in specs for i in range(k)]
    return reduce(DataFrame.unionByName, _run(spark, fits, parallelism))


def fold_metrics(oof: DataFrame, label: str, fold: str = "fold") -> DataFrame:
    """AUC and accuracy at 0.5 per model and fold."""
    hit = (F.col("SCORE") >= 0.5) == (F.col(label) == 1)
    hits = oof.groupBy("model", fold).agg(F.avg(hit.cast("double")).alias("accuracy"))
    return auc(oof, label, "SCORE", by=["model", fold]).join(hits, ["model", fold])


def cross_validate(
    df: DataFrame,
    specs: Sequence[ModelSpec],
    label: str,
    key: str,
    k: int,
    fold: str = "fold",
    parallelism: int = 1,
) -> DataFrame:
    """Mean and population standard deviation of the AUC over the folds, and mean accuracy, per model."""
    oof = out_of_fold(df, specs, label, key, k, fold, parallelism=parallelism)
    metrics = fold_metrics(materialize(oof, "oof"), label, fold)
    accuracy = metrics.groupBy("model").agg(F.avg("accuracy").alias("mean_accuracy"))
    return summarise_folds(metrics, "model", "auc").join(accuracy, "model")


def draw_params(space: Mapping[str, tuple], n: int, seed: int) -> list[dict[str, float]]:
    """``n`` seeded draws: ("int", low, high) excludes high, ("float", low, width) is [low, low + width]."""
    rng = random.Random(seed)

    def one(kind: str, low: float, other: float) -> float:
        return rng.randrange(low, other) if kind == "int" else low + rng.random() * other

    return [{name: one(*bounds) for name, bounds in space.items()} for _ in range(n)]


def random_search(
    df: DataFrame,
    space: Mapping[str, tuple],
    label: str,
    key: str,
    k: int,
    n_iter: int = 20,
    seed: int = 42,
    parallelism: int = 1,
) -> DataFrame:
    """Cross-validate seeded draws of the boosted model's parameters: (draw, mean_auc, std_auc, params...).

    Parameters that the learner does not use are neither drawn nor reported.
    """
    space = {name: bounds for name, bounds in space.items() if name in USED_PARAMS}
    draws = draw_params(space, n_iter, seed)
    specs = [
        ModelSpec(str(i), boosted_from(p, seed=seed), weight="positive") for i, p in enumerate(draws)
    ]
    results = cross_validate(df, specs, label, key, k, parallelism=parallelism)
    rows = [(str(i), *[float(v) for v in p.values()]) for i, p in enumerate(draws)]
    schema = "model string, " + ", ".join(f"{c} double" for c in space)
    params = df.sparkSession.createDataFrame(rows, schema)
    return (
        results.join(params, "model")
        .withColumn("draw", F.col("model").cast("int"))
        .select("draw", "mean_auc", "std_auc", *space)
    )


def best_draw(results: DataFrame) -> DataFrame:
    """The draw with the highest mean AUC; the earliest among equals."""
    return argmax(results, "mean_auc", "draw")


def renamed(spec: ModelSpec, name: str, features: Sequence[str] | None = None) -> ModelSpec:
    """The same model on another feature list, for ablations over one fold column."""
    return replace(spec, name=name, features=features if features is not None else spec.features)
