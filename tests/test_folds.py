"""What all folds share: medians, moments, modes and levels equal those fitted fold by fold."""

import random
import statistics

import pytest

from creditloom.operators import encoding, models, quantiles


@pytest.fixture(scope="module")
def table(spark):
    source, rows = random.Random(5), []
    for i in range(3000):
        f = 0 if i % 10 < 8 else i % 2 + 1  # one fold holds most rows
        rows.append(
            (
                i,
                f,
                int(source.random() < 0.3),
                source.gauss(1e6, 3.0) + 5 * f if i % 7 else None,
                float(source.randrange(3)) if i % 3 else float("nan"),
                7.5 if f else None,
                source.choice([None, "a", "b", f"only{f}"]),
                f"v{source.randrange(400)}",
                bool(i % 2),
            )
        )
    schema = "id long, fold int, y int, far double, few double, gone double, c string, many string, flag boolean"
    return spark.createDataFrame(rows, schema)


@pytest.mark.parametrize("settle", [3, 100, 10_000])
def test_medians_of_all_folds(table, settle):
    rows = table.select("fold", "far", "few", "gone").collect()
    found = quantiles.leave_one_out_medians(table, ["far", "few", "gone"], "fold", range(4), settle)
    for g in range(4):
        for c in ("far", "few", "gone"):
            own = [r[c] for r in rows if r.fold != g and r[c] is not None and r[c] == r[c]]
            assert found[g][c] == (statistics.median(own) if own else None), (g, c)


@pytest.mark.parametrize("driver_levels", [10, 10_000])
def test_fits_of_all_folds(table, driver_levels):
    numeric, other = ["far", "few", "gone", "flag"], ["c", "many"]
    found = encoding.fit_folds(table, numeric, other, "fold", range(3), driver_levels)
    for g, fit in found.items():
        own = encoding.Preprocessor(numeric, other).fit(table.where(f"fold <> {g}"))
        assert fit.medians == own.medians and fit.modes == own.modes
        for c in numeric:
            assert fit.scales[c] == pytest.approx(own.scales[c], rel=1e-9), (g, c)
        levels = {c: tuple(r.level for r in t.orderBy("at").collect()) for c, t in fit.ordinal.tables.items()}
        assert {**fit.ordinal.levels, **levels} == dict(own.ordinal.levels)
        assert (len(levels) > 0) == (driver_levels == 10)
        for t in fit.ordinal.tables.values():
            assert sorted(r["at"] for r in t.collect()) == list(range(t.count()))


def test_preparation_jobs_do_not_depend_on_the_folds(spark, table):
    tracker, jobs = spark.sparkContext.statusTracker(), []
    for k in (3, 9):
        group = f"folds-{k}"
        spark.sparkContext.setJobGroup(group, "")
        encoding.fit_folds(table.selectExpr("*").withColumn("fold", table.id % k), ["far", "few"], ["c"], "fold", range(k))
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setJobGroup("rest", "")
    assert 0 < jobs[1] <= jobs[0] + 2


def test_out_of_fold_scores_are_those_of_separate_fits(table):
    specs = [models.ModelSpec("all", models.logistic(1.0, 20)), models.ModelSpec("two", models.logistic(1.0, 20), ["far", "c"]), models.ModelSpec("m", None)]
    oof = models.out_of_fold(table, specs, "y", "id", 3).collect()
    assert len(oof) == 3 * 3000
    score = {(r.model, r.id): r.SCORE for r in oof}
    for spec in specs[:2]:
        for g in range(3):
            own = models.fit_model(spec, table.where(f"fold <> {g}").drop("fold"), "y", "id")
            for r in own.score(table.where(f"fold = {g}"), ["id"]).collect():
                assert score[spec.name, r.id] == pytest.approx(r.SCORE, abs=1e-6)


def test_medians_of_many_columns_share_rows_in_their_passes(spark):
    rows = [tuple([i % 4, *[None if (i + c) % 11 == 0 else float("nan") if (i * c) % 17 == 5 else float((i * 37 + c * c) % 1009) for c in range(23)]]) for i in range(3_000)]
    columns = [f"c{c}" for c in range(23)]
    df = spark.createDataFrame(rows, "fold int, " + ", ".join(f"{c} double" for c in columns)).repartition(3)
    brackets = [[quantiles._Search(c, 0)] for c in columns]
    steps = quantiles._steps(df, brackets)
    for c, found in enumerate(steps):
        values = [r[c + 1] for r in rows if r[c + 1] is not None and r[c + 1] == r[c + 1]]
        assert (found[0], found[-1], len(found)) == (min(values), max(values), quantiles.SKETCH_STEPS + 1)
    found = quantiles.leave_one_out_medians(df, columns, "fold", range(4), 20)
    for g in range(4):
        own = [[r[c + 1] for r in rows if r[0] != g and r[c + 1] is not None and r[c + 1] == r[c + 1]] for c in range(23)]
        assert [found[g][c] for c in columns] == [statistics.median(v) for v in own]
