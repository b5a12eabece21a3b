"""Ridge logistic regression by Newton steps from distributed sums.

Beside Spark's optimiser, which stops near the optimum, this one can be checked: each step is one pass that adds up the
gradient and the Hessian, and a linear solve in as many unknowns as there are features. It reaches the optimum to the
last digits in a handful of passes, and the same steps can be written in SQL.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import number

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Features that one pass adds up a Hessian for; it has their square of entries.
MAX_FEATURES = 2_000


def _sums(b: np.ndarray, rows: Iterator[pa.RecordBatch]) -> np.ndarray | None:
    """Weight, loss, gradient and upper triangle of the Hessian, of some rows, without the penalty."""
    d = len(b)
    upper, total = np.triu_indices(d), None
    for batch in rows:
        if not batch.num_rows:
            continue
        x = np.ones((batch.num_rows, d))
        x[:, 1:] = batch["x"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, d - 1)
        y, w = (batch[c].to_numpy(zero_copy_only=False) for c in ("y", "w"))
        margin = x @ b
        p = 0.5 * (1 + np.tanh(margin / 2))  # the logistic function, for margins of any size
        loss = w * (np.logaddexp(0, margin) - y * margin)
        hessian = (x * (w * p * (1 - p))[:, None]).T @ x
        own = np.concatenate([[w.sum(), loss.sum()], x.T @ (w * (p - y)), hessian[upper]])
        total = own if total is None else total + own
    return total


class NewtonLogistic:
    """Minimises mean loss + ``reg`` / 2 x squared weights; the intercept is free.

    Takes Spark's setters and gives a model with ``coefficients``, ``intercept`` and ``transform``. A step that
    would raise the objective is halved.
    """

    def __init__(self, reg: float, max_steps: int = 50, tol: float = 1e-12):
        self.reg, self.max_steps, self.tol = reg, max_steps, tol
        self.label, self.features, self.weight = "label", "features", None

    def setLabelCol(self, name: str) -> NewtonLogistic:
        self.label = name
        return self

    def setFeaturesCol(self, name: str) -> NewtonLogistic:
        self.features = name
        return self

    def setWeightCol(self, name: str) -> NewtonLogistic:
        self.weight = name
        return self

    def fit(self, df: DataFrame) -> NewtonModel:
        weight = F.lit(1.0) if self.weight is None else F.col(self.weight).cast("double")
        rows = df.select(
            vector_to_array(self.features).alias("x"), F.col(self.label).cast("double").alias("y"), weight.alias("w")
        )
        first = rows.first()
        if first is None:
            raise ValueError("no rows to learn from")
        d = len(first["x"]) + 1
        if d > MAX_FEATURES:
            raise ValueError(f"more than {MAX_FEATURES} features: use Spark's optimiser")
        b, step, best = np.zeros(d), np.zeros(d), np.inf
        for _ in range(self.max_steps):
            value, gradient, hessian = self._at(rows, b)
            if value > best + 1e-15 * abs(best):
                step = step / 2
                b = b - step
                continue
            best = value
            step = -np.linalg.lstsq(hessian, gradient, rcond=None)[0]
            b = b + step
            if np.abs(step).max() <= self.tol * max(1.0, np.abs(b).max()):
                break
        return NewtonModel(b, self.features)

    def _at(self, rows: DataFrame, b: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = _sums(b, batches)
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["sums"])

        parts = rows.mapInArrow(partial, "sums array<double>").select(F.posexplode("sums").alias("i", "v"))
        found = {r["i"]: r["v"] for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect()}
        sums, d = np.array([found[i] for i in range(len(found))]), len(b)
        penalty = np.r_[0.0, np.full(d - 1, self.reg)]
        hessian = np.zeros((d, d))
        hessian[np.triu_indices(d)] = sums[2 + d :] / sums[0]
        hessian = hessian + np.triu(hessian, 1).T + np.diag(penalty)
        return sums[1] / sums[0] + (penalty * b**2).sum() / 2, sums[2 : 2 + d] / sums[0] + penalty * b, hessian


class NewtonModel:
    """A fitted :class:`NewtonLogistic`."""

    def __init__(self, b: np.ndarray, features: str):
        self.intercept, self.coefficients, self.features = float(b[0]), Vectors.dense(b[1:]), features

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``probability`` vector, as Spark's classifiers do."""
        terms = [f"_x[{i}] * {number(w)}" for i, w in enumerate(self.coefficients.toArray())]
        margin = " + ".join([number(self.intercept), *terms])
        scored = df.withColumn("_x", vector_to_array(self.features)).withColumn("_p", F.expr(f"1 / (1 + exp(-({margin})))"))
        return scored.withColumn("probability", array_to_vector(F.array(1 - F.col("_p"), "_p"))).drop("_x", "_p")
