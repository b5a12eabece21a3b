import pytest
from pyspark.sql import functions as F

from creditloom.operators import decisions, evaluation, explanation, fairness, ranking
from creditloom.plans import loan_columns as names

COST = decisions.CostModel(22_000.0, 1000.0, 40.0, 450.0)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(i, int(i % 7 == 0), (i * 37 % 101) / 100) for i in range(500)] + [(900, 1, None), (901, None, 0.5)]
    return spark.createDataFrame(rows, "id bigint, y int, s double").cache()


def test_sweep_matches_single_thresholds(spark, scored):
    clean = scored.filter("y IS NOT NULL AND s IS NOT NULL")
    sweep = {r["threshold"]: r for r in decisions.threshold_sweep(scored, "y", "s", COST).collect()}
    assert len(sweep) == 99
    for t in (0.01, 0.29, 0.57, 0.58, 0.63, 0.99):
        one = evaluation.metrics_at(clean, "y", "s", t).first()
        assert sum(one[c] for c in evaluation.COUNTS) == 500
        for c in ("precision", "recall", "approval_rate"):
            assert sweep[t][c] == one[c]
    counts = decisions.sweep_counts(scored, "y", "s").orderBy("threshold").collect()
    caught = [r["tp"] for r in counts]
    assert caught == sorted(caught, reverse=True)


def test_best_threshold_prefers_the_lowest_of_equals(spark):
    df = spark.createDataFrame([(0.3, 5.0), (0.2, 5.0), (0.1, 1.0), (0.4, None), (0.5, float("nan"))], "threshold double, net_value_m double")
    assert tuple(decisions.best_threshold(df).first()) == (0.2, 5.0)


def test_policies_and_net_value(spark, scored):
    table = {r["policy"]: r for r in decisions.policy_table(scored, "y", "s", {"all": None, "half": 0.5}, COST).collect()}
    n0, n1 = (scored.filter(f"y = {y}").count() for y in (0, 1))
    assert table["all"]["net_value"] == n0 * COST.profit - n1 * COST.loss
    half = table["half"]
    assert half["net_value"] == (half["tn"] - half["fp"]) * COST.profit - half["fn"] * COST.loss


def test_sensitivity_of_one_is_the_plain_optimum(spark, scored):
    counts = decisions.sweep_counts(scored, "y", "s")
    by = {r["factor"]: r for r in decisions.cost_sensitivity(counts, COST, [0.8, 1.0, 1.2]).collect()}
    best = decisions.best_threshold(decisions.threshold_sweep(scored, "y", "s", COST)).first()
    assert by[1.0]["threshold"] == best["threshold"]
    assert by[0.8]["threshold"] >= by[1.2]["threshold"]


def test_cost_model_reproduces_published_figures(spark):
    df = spark.createDataFrame([(513_531.0,)] * 3, "AMT_CREDIT double")
    cost = decisions.cost_model(df, "AMT_CREDIT", names.EXCHANGE_RATE, names.NET_MARGIN, names.LOSS_GIVEN_DEFAULT, names.RECOVERY)
    assert round(cost.profit) == 934 and round(cost.loss, -2) == 10_500
    assert round(cost.loss / cost.profit, 2) == 11.25


def test_band_edges_go_to_review(spark):
    df = spark.createDataFrame([(0.49,), (0.5,), (0.75,), (0.76,), (None,)], "s double")
    assert [r[0] for r in df.select(decisions.tier("s", 0.5, 0.75)).collect()] == ["approve", "review", "review", "deny", None]


def test_too_fine_a_grid_is_refused(spark, scored):
    with pytest.raises(ValueError):
        decisions.sweep_counts(scored, "y", "s", [i / 10_000 for i in range(10_000)])


def test_fairness(spark):
    rows = [("F", 0, 0.1)] * 8 + [("F", 1, 0.9)] * 2 + [("M", 0, 0.9)] * 4 + [("M", 1, 0.1)] * 1 + [(None, 0, 0.1)]
    df = spark.createDataFrame(rows, "g string, y int, s double")
    rates = fairness.group_rates(df, "g", "y", "s", 0.63)
    got = {r["g"]: (r["n"], r["actual_default_rate"], r["model_approval_rate"]) for r in rates.collect()}
    assert got == {"F": (10, 0.2, 0.8), "M": (5, 0.2, 0.2)}
    gap = fairness.flag_disparity(fairness.rate_gap(rates, "g", "F", "M")).first()
    assert gap["approval_gap_pp"] == pytest.approx(60) and gap["default_gap_pp"] == 0 and gap["disparity"]


def test_ranking(spark):
    df = spark.createDataFrame([("b", 0.70004), ("a", 0.70001), ("c", 0.9), ("d", None)], "m string, auc double")
    assert [r["m"] for r in ranking.leaderboard(df, "auc", "m").collect()] == ["c", "a", "b", "d"]
    assert [r["m"] for r in ranking.top_k(df, "auc", 2, "m").collect()] == ["c", "b"]
    grouped = spark.createDataFrame([("x", 1.0, 2.0), ("x", 1.0, 1.0), ("y", 3.0, 9.0)], "g string, v double, t double")
    assert {tuple(r) for r in ranking.argmax(grouped, "v", "t", ["g"]).collect()} == {("x", 1.0, 1.0), ("y", 9.0, 3.0)}
    assert ranking.argmax(df.filter("auc > 1"), "auc", "auc").count() == 0


def test_linear_attributions_sum_to_the_margin(spark):
    df = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 1.0)], "id bigint, a double, b double")
    weights, means = {"a": 0.5, "b": -2.0}, {"a": 3.0, "b": 3.0}
    phi = explanation.linear_attributions(df, weights, means)
    total = explanation.total_attribution(phi, ["PHI_a", "PHI_b"], "t").orderBy("id").collect()
    assert [r["t"] for r in total] == [0.5 * -1 - 2 * 2, 0.5 * 1 - 2 * -2]
    best = explanation.mean_abs_attribution(phi, {"a": "PHI_a", "b": "PHI_b"}, 1).collect()
    assert [tuple(r) for r in best] == [("b", 4.0)]


@pytest.mark.parametrize("players", [None, ["a", "c"]])
def test_sampled_shapley_is_efficient_and_exact_for_additive_scores(spark, players):
    from pyspark.ml.functions import vector_to_array

    rows = [(i, [float(i), float(i * i % 5), 1.5]) for i in range(6)]
    df = spark.createDataFrame(rows, "id bigint, x array<double>")

    def score(t):
        v = vector_to_array("features")
        return t.withColumn("score", 2 * v[0] - v[1] + v[0] * v[2])

    base = [1.0, 1.0, 1.0]
    out = explanation.sampled_shapley(df, "id", "x", ["a", "b", "c"], base, score, 5, 3, players).collect()
    total = {}
    for r in out:
        total[r["id"]] = total.get(r["id"], 0) + r["phi"]
    moving = set(players or ["a", "b", "c"])
    assert {r["feature"] for r in out} == moving
    for i, x in rows:
        start = [b if n in moving else v for b, n, v in zip(base, "abc", x)]
        want = (2 * x[0] - x[1] + x[0] * x[2]) - (2 * start[0] - start[1] + start[0] * start[2])
        assert total[i] == pytest.approx(want)
    if players is None:
        for r in out:
            if r["feature"] == "b":
                assert r["phi"] == pytest.approx(-(dict(rows)[r["id"]][1] - 1.0))


def test_adverse_actions(spark):
    reasons = [(("a", "b"), "R1", "C1"), (("c",), "R2", "C2"), (("g",), "R3", "C3"), (("d",), "R4", "C4")]
    rows = [
        (1, 0.9, 0.1, 0.4, 0.4, 9.0, -1.0),
        (2, 0.9, None, None, None, None, None),
        (3, 0.1, 1.0, 1.0, 1.0, 1.0, 1.0),
        (4, None, 1.0, 1.0, 1.0, 1.0, 1.0),
    ]
    df = spark.createDataFrame(rows, "id bigint, s double, PHI_a double, PHI_b double, PHI_c double, PHI_g double, PHI_d double")
    got = [tuple(r) for r in explanation.adverse_actions(df, "id", "s", 0.63, reasons, k=3, exclude=["g"]).collect()]
    assert got == [(1, 1, "R1", "C1", 0.4), (1, 2, "R2", "C2", 0.4)]
    plan = explanation.adverse_actions(df, "id", "s", 0.63, reasons)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_reason_dictionary(spark):
    table = explanation.reason_codes(spark, names.REASONS).collect()
    assert len(table) == 11 and len({r["reason"] for r in table}) == 8
    assert not {r["feature"] for r in table} & set(names.PROTECTED)


def test_labels(spark):
    df = spark.createDataFrame([("F", "Secondary / secondary special"), ("?", "Lower secondary")], "g string, e string")
    df = fairness.relabel(df, "g", "gn", names=names.GENDER_NAMES)
    df = fairness.relabel(df, "e", "en", replace=names.EDUCATION_SHORTENING)
    assert [(r["gn"], r["en"]) for r in df.collect()] == [("Female", "Secondary"), (None, "Lower Secondary")]


def test_sweep_reads_the_table_once(spark, scored):
    plan = decisions.sweep_counts(scored.filter(F.col("id") >= 0), "y", "s")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("InMemoryTableScan") == 1 and "Join" not in plan
