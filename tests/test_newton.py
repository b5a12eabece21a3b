"""Newton steps reach the optimum that Spark's optimiser comes near to."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from creditloom.operators.newton import NewtonLogistic


@pytest.fixture(scope="module")
def rows(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(2000, 6)) * [1, 2, 0.5, 1, 30, 1]
    x[:, 5] = x[:, 0] + 1e-3 * draw.normal(size=2000)  # nearly the same column twice
    y = (x @ [1, -0.5, 2, 0, 0.02, 0] + draw.logistic(size=2000) > 1.5).astype(float)
    table = [(v.tolist(), float(t), 1.0 + 10 * float(t)) for v, t in zip(x, y)]
    df = spark.createDataFrame(table, "x array<double>, y double, w double").repartition(7)
    return df.select(array_to_vector("x").alias("features"), "y", "w")


@pytest.mark.parametrize("weight", [None, "w"])
def test_coefficients_are_those_of_the_optimum(rows, weight):
    reg = 1 / (0.1 * 2000)
    own = NewtonLogistic(reg).setLabelCol("y").setFeaturesCol("features")
    other = LogisticRegression(labelCol="y", maxIter=2000, tol=1e-14, regParam=reg, elasticNetParam=0.0, standardization=False)
    if weight:
        own, other = own.setWeightCol(weight), other.setWeightCol(weight)
    a, b = own.fit(rows), other.fit(rows)
    assert a.coefficients.toArray() == pytest.approx(b.coefficients.toArray(), abs=1e-5)
    assert a.intercept == pytest.approx(b.intercept, abs=1e-5)
    # At the optimum the gradient is nothing.
    solver = NewtonLogistic(reg).setLabelCol("y")
    flat = rows.select(vector_to_array("features").alias("x"), "y", "w" if weight else F.lit(1.0).alias("w"))
    _, gradient, _ = solver._at(flat, np.r_[a.intercept, a.coefficients.toArray()])
    assert np.abs(gradient).max() < 1e-12


def test_probabilities_agree(rows):
    model = NewtonLogistic(0.01).setLabelCol("y").setFeaturesCol("features").fit(rows)
    got = model.transform(rows).select("features", "probability").collect()
    for r in got[:50]:
        margin = model.intercept + float(np.dot(r.features.toArray(), model.coefficients.toArray()))
        assert r.probability[1] == pytest.approx(1 / (1 + np.exp(-margin))) and sum(r.probability) == pytest.approx(1)


def test_separable_and_constant_labels(spark):
    rows = [([float(i)], float(i > 5)) for i in range(12)]
    df = spark.createDataFrame(rows, "x array<double>, y double").select(array_to_vector("x").alias("features"), "y")
    model = NewtonLogistic(0.001).setLabelCol("y").fit(df)
    assert 0 < model.coefficients[0] < 100 and -model.intercept / model.coefficients[0] == pytest.approx(5.5, abs=0.05)
    with pytest.raises(ValueError, match="no rows"):
        NewtonLogistic(0.1).setLabelCol("y").fit(df.limit(0))
