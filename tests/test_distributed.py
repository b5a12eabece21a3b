"""The operators that replace a single-task sort, against brute force and with tiny limits."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from creditloom.functions import portable_order, xxhash_order
from creditloom.operators import evaluation, neighbours, running, sampling
from creditloom.operators.quantiles import exact_medians


def _median_cases():
    rng = random.Random(1)
    return {
        "spread": [rng.random() for _ in range(5000)],
        "even": [rng.random() for _ in range(5001)],
        "hot_middle": [0.5] * 2500 + [rng.random() for _ in range(2500)],
        "hot_low": [0.0] * 2400 + [rng.random() for _ in range(2600)],
        "hot_high": [rng.random() for _ in range(2499)] + [1.0] * 2501,
        "two_values": [1.0] * 2500 + [2.0] * 2500,
        "one_value": [7.0] * 5000,
        "negative": [-rng.random() * 1e9 for _ in range(5000)],
        "tiny_gap": [1 + i * 2**-52 for i in range(5000)],
    }


def test_exact_medians_against_brute_force(spark):
    cases = _median_cases()
    n = max(map(len, cases.values()))
    rows = [tuple(v[i] if i < len(v) else None for v in cases.values()) for i in range(n)]
    rows += [(None,) * len(cases), (float("nan"),) * len(cases)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cases)).repartition(7)
    want = {c: statistics.median(v) for c, v in cases.items()}
    assert exact_medians(df, list(cases)) == want
    assert exact_medians(df, list(cases), settle_values=3) == want


def test_exact_medians_with_coarse_sketch(spark, monkeypatch):
    from creditloom.operators import quantiles

    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 10)
    values = [float(v) for v in random.Random(3).sample(range(100_000), 4000)]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(5)
    assert exact_medians(df, ["x"], settle_values=5) == {"x": statistics.median(values)}


def test_exact_medians_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert exact_medians(df, ["x"]) == {"x": None}
    assert exact_medians(df, []) == {}


def _scores(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.2)
        # A third of all rows share one score.
        s = 0.5 if i % 3 == 0 else round(min(1.0, max(0.0, rng.gauss(0.4 + 0.2 * y, 0.2))), 3)
        rows.append((i, y, s, i % 4))
    return rows, spark.createDataFrame(rows, "id bigint, y int, s double, g int").repartition(6)


def _auc(pairs):
    pos = np.array([s for y, s in pairs if y == 1])
    neg = np.array([s for y, s in pairs if y == 0])
    gap = pos[:, None] - neg[None, :]
    return ((gap > 0).sum() + 0.5 * (gap == 0).sum()) / gap.size


@pytest.mark.parametrize("rows_per_slice", [250_000, 100, 7])
def test_auc_with_many_slices(spark, monkeypatch, rows_per_slice):
    monkeypatch.setattr(running, "ROWS_PER_SLICE", rows_per_slice)
    rows, df = _scores(spark)
    assert evaluation.auc(df, "y", "s").first()["auc"] == pytest.approx(_auc([(r[1], r[2]) for r in rows]), abs=1e-12)
    by = {r["g"]: r["auc"] for r in evaluation.auc(df, "y", "s", by=["g"]).collect()}
    for g in range(4):
        assert by[g] == pytest.approx(_auc([(r[1], r[2]) for r in rows if r[3] == g]), abs=1e-12)


def test_auc_properties(spark):
    _, df = _scores(spark)
    straight = evaluation.auc(df, "y", "s").first()["auc"]
    turned = evaluation.auc(df.withColumn("s", 1 - F.col("s")), "y", "s").first()["auc"]
    assert straight + turned == pytest.approx(1, abs=1e-12)
    assert evaluation.auc(df.filter("y = 0"), "y", "s").first()["auc"] is None
    assert evaluation.auc(df.withColumn("s", F.lit(0.3)), "y", "s").first()["auc"] == 0.5
    assert evaluation.auc(df, "y", "s", bins=1000).first()["auc"] == pytest.approx(straight, abs=0.01)


@pytest.mark.parametrize("rows_per_slice", [250_000, 50])
def test_roc_curve(spark, monkeypatch, rows_per_slice):
    monkeypatch.setattr(running, "ROWS_PER_SLICE", rows_per_slice)
    rows, df = _scores(spark)
    points = sorted((tuple(p) for p in evaluation.roc_curve(df, "y", "s").collect()), reverse=True)
    neg, pos = (sum(1 for r in rows if r[1] == y) for y in (0, 1))
    for t, fpr, tpr in points:
        assert fpr == sum(1 for r in rows if r[1] == 0 and r[2] >= t) / neg
        assert tpr == sum(1 for r in rows if r[1] == 1 and r[2] >= t) / pos
    assert points[0][1:] == (0.0, 0.0) and points[-1][1:] == (1.0, 1.0)


@pytest.fixture
def small_ranges(monkeypatch):
    monkeypatch.setattr(sampling, "SETTLE_ROWS", 5)
    monkeypatch.setattr(sampling, "FANOUT", 6)


def _labelled(spark, n=700):
    return spark.range(n).selectExpr("id * 3 AS id", "int(id % 10 = 0) AS y").repartition(5)


@pytest.mark.parametrize("order", [portable_order(42), xxhash_order(42)])
@pytest.mark.parametrize("n", [0, 1, 333, 699, 700, 9999])
def test_sample_n(spark, small_ranges, order, n):
    df = _labelled(spark)
    got = [r["id"] for r in sampling.sample_n(df, n, "id", order=order).collect()]
    want = [r["id"] for r in df.orderBy(F.expr(order.of("id")), "id").limit(n).collect()]
    assert sorted(got) == sorted(want)


def test_sample_where_hashes_collide(spark, small_ranges):
    from creditloom.functions import HashOrder

    order = HashOrder(lambda key: f"pmod({key}, 3L)", 3)
    df = _labelled(spark)
    got = sampling.sample_n(df, 250, "id", order=order)
    want = df.orderBy(F.expr("pmod(id, 3)"), "id").limit(250)
    assert sorted(r["id"] for r in got.collect()) == sorted(r["id"] for r in want.collect())


@pytest.mark.parametrize("equal", [0, 30, 50])
@pytest.mark.parametrize("settle", [5, 10_000])
def test_repeated_keys(spark, monkeypatch, settle, equal):
    """Cuts go between the rows of one key, and between rows that are equal in all columns."""
    monkeypatch.setattr(sampling, "SETTLE_ROWS", settle)
    rows = [(7, 0, max(0, i - equal + 1)) for i in range(50)] + [(i, i % 2, 0) for i in range(60)]
    df = spark.createDataFrame(rows, "id bigint, y int, v int").repartition(6)
    one = df.where("id = 7 AND y = 0")
    for n in (0, 1, 10, 49, 50, 99):
        assert sampling.sample_n(one, n, "id").count() == min(n, 50)
        assert sampling.sample_n(df, n, "id").count() == n
    taken = sampling.sample_n(df, 40, "id")
    assert sorted(taken.collect()) == sorted(sampling.sample_n(df.repartition(3), 40, "id").collect())
    assert taken.columns == df.columns
    folded = sampling.stratified_folds(df, "y", 3, "id")
    sizes = {(r.y, r.fold): r["count"] for r in folded.groupBy("y", "fold").count().collect()}
    for y, n in ((0, 80), (1, 30)):
        assert sorted(sizes[y, f] for f in range(3)) == sorted(n // 3 + (i < n % 3) for i in range(3))
    assert sorted(folded.drop("fold").collect()) == sorted(df.collect())
    halved = sampling.undersample(df, "y", "id", 1.0).groupBy("y").count().collect()
    assert {r.y: r["count"] for r in halved} == {0: 30, 1: 30}
    many = sampling.oversample(df.selectExpr("id", "1 - y AS y", "v").unionByName(df.where("y = 1").selectExpr("id + 100 AS id", "y - 1 AS y", "v")), "y", "id", 1.0)
    assert {r.y: r["count"] for r in many.groupBy("y").count().collect()} == {0: 80, 1: 80}


def test_null_keys_are_refused(spark):
    df = spark.createDataFrame([(1, 0), (None, 1)], "id bigint, y int")
    with pytest.raises(ValueError, match="null"):
        sampling.sample_n(df, 1, "id")


def test_sample_does_not_depend_on_partitioning(spark):
    df = _labelled(spark)
    one = {r["id"] for r in sampling.sample_n(df.coalesce(1), 100, "id").collect()}
    many = {r["id"] for r in sampling.sample_n(df.repartition(13), 100, "id").collect()}
    assert one == many and len(one) == 100


@pytest.mark.parametrize("k", [2, 3, 5])
def test_folds_partition_the_rows(spark, small_ranges, k):
    folded = sampling.stratified_folds(_labelled(spark, 703), "y", k, "id")
    sizes = {}
    for r in folded.groupBy("y", "fold").count().collect():
        sizes.setdefault(r["y"], []).append(r["count"])
    assert folded.filter("fold IS NULL").isEmpty()
    for counts in sizes.values():
        assert len(counts) == k and max(counts) - min(counts) <= 1


def test_class_smaller_than_the_folds(spark):
    df = spark.createDataFrame([(i, int(i == 0)) for i in range(20)], "id bigint, y int")
    folded = sampling.stratified_folds(df, "y", 3, "id")
    assert folded.filter("fold IS NULL").isEmpty()


def test_null_and_text_labels_are_strata(spark):
    df = spark.createDataFrame([(i, [None, "a'b", "c"][i % 3]) for i in range(90)], "id bigint, y string")
    counts = {r["y"]: r["count"] for r in sampling.sample_stratified(df, "y", 30, "id").groupBy("y").count().collect()}
    assert counts == {None: 10, "a'b": 10, "c": 10}


def test_resampling_sizes(spark, small_ranges):
    df = _labelled(spark)  # 70 positives, 630 negatives
    under = {r["y"]: r["count"] for r in sampling.undersample(df, "y", "id", 0.3).groupBy("y").count().collect()}
    assert under == {1: 70, 0: 233}
    over = sampling.oversample(df, "y", "id", 0.5)
    assert {r["y"]: r["count"] for r in over.groupBy("y").count().collect()} == {0: 630, 1: 315}
    copies = {r["count"] for r in over.filter("y = 1").groupBy("id").count().collect()}
    assert copies == {4, 5}
    with pytest.raises(ValueError):
        sampling.undersample(df, "y", "id", 0.01)
    with pytest.raises(ValueError):
        sampling.undersample(df.filter("y = 0"), "y", "id")


def _points(copies):
    rng = np.random.default_rng(2)
    points = rng.normal(size=(300, 3)).round(2).tolist()
    return points + [[0.5, 0.5, 0.5]] * copies


def _brute(points, k):
    p = np.array(points)
    out = set()
    for i in range(len(p)):
        d = np.zeros(len(p))
        for j in range(p.shape[1]):
            d += (p[:, j] - p[i, j]) ** 2
        d = np.sqrt(d)
        order = [j for j in np.lexsort((np.arange(len(p)), d)) if j != i][:k]
        out |= {(i, r + 1, int(j), float(d[j])) for r, j in enumerate(order)}
    return out


@pytest.mark.parametrize("slab_rows", [10_000, 40])
@pytest.mark.parametrize("copies", [0, 150])
def test_nearest_neighbours_against_brute_force(spark, monkeypatch, slab_rows, copies):
    monkeypatch.setattr(neighbours, "VISITORS_PER_TASK", 17)
    points = _points(copies)
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id bigint, x array<double>")
    got = neighbours.nearest_neighbours(df.repartition(4), "id", "x", 4, slab_rows)
    assert {tuple(r) for r in got.collect()} == _brute(points, 4)


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, x array<double>")
    got = {tuple(r) for r in neighbours.nearest_neighbours(df, "id", "x", 5).collect()}
    assert got == {(1, 1, 2, 1.0), (2, 1, 1, 1.0)}


def test_smote_lies_between_minority_rows(spark):
    rows = [(i, int(i % 10 == 0), [float(i), float(i * i % 37)]) for i in range(400)]
    df = spark.createDataFrame(rows, "id bigint, y int, x array<double>")
    out = neighbours.smote(df, "y", "id", "x", 0.3, 3)
    sizes = {(r["y"], r["synthetic"]): r["count"] for r in out.groupBy("y", "synthetic").count().collect()}
    assert sizes == {(0, False): 360, (1, False): 40, (1, True): 68}
    real = [r[2] for r in rows if r[1] == 1]
    low, high = np.min(real, axis=0), np.max(real, axis=0)
    for r in out.filter("synthetic").collect():
        assert r["id"] is None and (low <= np.array(r["x"])).all() and (np.array(r["x"]) <= high).all()
    again = neighbours.smote(df.repartition(9), "y", "id", "x", 0.3, 3)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, again.collect()))


def test_smote_leaves_a_balanced_table(spark):
    rows = [(i, i % 2, [float(i)]) for i in range(20)]
    df = spark.createDataFrame(rows, "id bigint, y int, x array<double>")
    assert neighbours.smote(df, "y", "id").filter("synthetic").isEmpty()


def test_hot_vectors_take_the_broadcast_path(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "HOT_ENTRIES", 4)
    points = _points(150)
    df = spark.createDataFrame([(i, p) for i, p in enumerate(points)], "id bigint, x array<double>")
    got = neighbours.nearest_neighbours(df, "id", "x", 4, 60)
    assert {tuple(r) for r in got.collect()} == _brute(points, 4)
    assert neighbours.nearest_neighbours(df.limit(0), "id", "x", 4).isEmpty()


def test_copies_are_thinned_before_the_shuffle(spark):
    from pyspark.sql.window import Window

    df = spark.createDataFrame([(1, [0.0])], "key bigint, x array<double>")
    w = Window.partitionBy("x").orderBy("key").rowsBetween(Window.unboundedPreceding, 0)
    kept = df.select("*", F.row_number().over(w).alias("copy"), F.min("key").over(w).alias("vid")).filter("copy <= 6")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_search_functions_travel_with_the_job():
    from pyspark import cloudpickle

    assert neighbours.__name__ in cloudpickle.list_registry_pickle_by_value()
