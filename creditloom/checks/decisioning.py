"""Evaluation, value analysis, fairness and reasons, on the scored table and the joined features."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import finite_or_null, with_exprs
from ..operators import decisions, evaluation, explanation, fairness, ranking, sampling
from ..plans import application as app
from ..plans import loan_columns as names
from ..plans.history import join_histories
from .fixtures import children, fixture
from .registry import ORDER, SEED, check, settle
from .sql import check_sql, dbl, rounded, settled_select

Y, S, KEY = names.LABEL, "SCORE", names.KEY
_T = names.CHOSEN_THRESHOLD


def _scored(spark, sf) -> DataFrame:
    return fixture(spark, sf, "scored")


def _cost(spark, sf) -> decisions.CostModel:
    return decisions.cost_model(
        fixture(spark, sf, "application"),
        "AMT_CREDIT",
        names.EXCHANGE_RATE,
        names.NET_MARGIN,
        names.LOSS_GIVEN_DEFAULT,
        names.RECOVERY,
    )


def _counts_sql(test: str) -> str:
    return (
        f"count(*) FILTER (WHERE TARGET=0 AND NOT ({test})) AS tn, count(*) FILTER (WHERE TARGET=0 AND ({test})) AS fp, "
        f"count(*) FILTER (WHERE TARGET=1 AND NOT ({test})) AS fn, count(*) FILTER (WHERE TARGET=1 AND ({test})) AS tp"
    )


_METRICS_SQL = (
    f"coalesce({dbl('tp')}/nullif(tp+fp,0),0) AS precision, coalesce({dbl('tp')}/nullif(tp+fn,0),0) AS recall, "
    f"{dbl('tn+fn')}/(tn+fp+fn+tp) AS approval_rate"
)
_AT_CHOSEN = f"SELECT {_counts_sql(f'SCORE >= {_T}')} FROM scored"


@check(
    "k1_accuracy",
    check_sql("SELECT avg(CASE WHEN (SCORE >= 0.5) = (TARGET = 1) THEN 1.0 ELSE 0.0 END)::DOUBLE AS accuracy FROM scored"),
)
def accuracy(spark, sf):
    return evaluation.accuracy(evaluation.decide(_scored(spark, sf), S, 0.5), Y, "DECISION")


# Rank sums by windows, unlike the operator's running totals.
def _auc_sql(source: str, by: str) -> str:
    keys = f"{by}, " if by else ""
    part = f"PARTITION BY {by} " if by else ""
    tie = f"PARTITION BY {by}, SCORE" if by else "PARTITION BY SCORE"
    return (
        f"SELECT {keys}(sum(CASE WHEN TARGET=1 THEN rk END) - {dbl('count(*) FILTER (WHERE TARGET=1)')}"
        f"*(count(*) FILTER (WHERE TARGET=1)+1)/2) / ({dbl('count(*) FILTER (WHERE TARGET=1)')}"
        f"*count(*) FILTER (WHERE TARGET=0)) AS auc FROM (SELECT *, rank() OVER ({part}ORDER BY SCORE) "
        f"+ (count(*) OVER ({tie}) - 1)/{dbl(2)} AS rk FROM {source}) AS r" + (f" GROUP BY {by}" if by else "")
    )


@check("k2_auc", check_sql(_auc_sql("scored", "")))
def auc(spark, sf):
    return evaluation.auc(_scored(spark, sf), Y, S)


@check(
    "k3_roc",
    check_sql(
        "SELECT CAST(NULL AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS fpr, CAST(0 AS DOUBLE) AS tpr UNION ALL "
        "SELECT SCORE, CAST(sum(n0) OVER w AS DOUBLE)/sum(n0) OVER (), CAST(sum(n1) OVER w AS DOUBLE)/sum(n1) OVER () "
        "FROM s WINDOW w AS (ORDER BY SCORE DESC)",
        s="SELECT SCORE, count(*) FILTER (WHERE TARGET=0) AS n0, count(*) FILTER (WHERE TARGET=1) AS n1 "
        "FROM scored GROUP BY SCORE",
    ),
)
def roc(spark, sf):
    points = evaluation.roc_curve(_scored(spark, sf), Y, S)
    return with_exprs(points, {"threshold": finite_or_null("threshold")})


@check("k5_confusion", check_sql(_AT_CHOSEN))
def confusion(spark, sf):
    return evaluation.confusion(evaluation.decide(_scored(spark, sf), S, _T), Y, "DECISION")


@check("k6_metrics", check_sql(f"SELECT *, {_METRICS_SQL} FROM c", c=_AT_CHOSEN))
def metrics(spark, sf):
    return evaluation.metrics_at(_scored(spark, sf), Y, S, _T)


@check("v1_cost_model", check_sql("SELECT * FROM cost"))
def cost_model(spark, sf):
    cost = _cost(spark, sf)
    row = (cost.median_amount, cost.loan, cost.profit, cost.loss)
    return spark.createDataFrame([row], "median_amount double, loan double, profit double, loss double")


@check(
    "v2_net_value",
    check_sql(
        "SELECT c.*, tn*profit-fn*loss-fp*profit AS net_value, tn*profit-fn*loss AS net_value_no_opportunity FROM c, cost",
        c=_AT_CHOSEN,
    ),
)
def net_value(spark, sf):
    cost, counts = _cost(spark, sf), confusion(spark, sf)
    return counts.withColumns(
        {
            "net_value": decisions.net_value(cost.profit, cost.loss),
            "net_value_no_opportunity": decisions.net_value(cost.profit, cost.loss, opportunity_cost=False),
        }
    )


def _sweep(spark, sf) -> DataFrame:
    return decisions.threshold_sweep(_scored(spark, sf), Y, S, _cost(spark, sf))


@check("v4_sweep", check_sql("SELECT * FROM sweep"))
def sweep(spark, sf):
    return _sweep(spark, sf)


@check("v5_best_threshold", check_sql("SELECT * FROM sweep ORDER BY net_value_m DESC, threshold LIMIT 1"))
def best_threshold(spark, sf):
    return decisions.best_threshold(_sweep(spark, sf))


_POLICIES = {"approve_all": None, "at_default": names.DEFAULT_THRESHOLD, "at_chosen": _T}


@check(
    "v6_policy_table",
    check_sql(
        f"SELECT p.*, tn*profit-fn*loss-fp*profit AS net_value, {_METRICS_SQL} FROM p, cost",
        p=" UNION ALL ".join(
            f"SELECT '{n}' AS policy, CAST({'NULL' if t is None else t} AS DOUBLE) AS threshold, "
            f"{_counts_sql('FALSE' if t is None else f'SCORE >= {t}')} FROM scored"
            for n, t in _POLICIES.items()
        ),
    ),
)
def policies(spark, sf):
    return decisions.policy_table(_scored(spark, sf), Y, S, _POLICIES, _cost(spark, sf))


@check(
    "v7_sensitivity",
    check_sql(
        "SELECT factor, threshold, net_value FROM (SELECT *, row_number() OVER (PARTITION BY factor "
        "ORDER BY net_value DESC, threshold) AS rn FROM v) AS r WHERE rn = 1",
        v="SELECT factor, threshold, tn*profit-fn*(factor*loss)-fp*profit AS net_value FROM grid_counts, cost, "
        f"(VALUES {', '.join(f'({dbl(f)})' for f in names.COST_FACTORS)}) AS f(factor)",
    ),
)
def sensitivity(spark, sf):
    counts = decisions.sweep_counts(_scored(spark, sf), Y, S)
    return decisions.cost_sensitivity(counts, _cost(spark, sf), names.COST_FACTORS)


@check(
    "v8_tiers",
    check_sql(
        settled_select("t", ["default_rate"], ["band", "n"]),
        t="SELECT CASE WHEN SCORE < 0.5 THEN 'approve' WHEN SCORE <= 0.75 THEN 'review' ELSE 'deny' END AS band, "
        "count(*) AS n, avg(TARGET) AS default_rate FROM scored GROUP BY 1",
    ),
)
def tiers(spark, sf):
    return settle(decisions.tier_summary(_scored(spark, sf), Y, S, *names.REVIEW_BAND))


_RATES = {
    by: f"SELECT {by}, count(*) AS n, avg(TARGET) AS actual_default_rate, "
    f"avg(CASE WHEN SCORE < {_T} THEN 1 ELSE 0 END) AS model_approval_rate FROM scored "
    f"WHERE {by} IS NOT NULL GROUP BY {by}"
    for by in names.PROTECTED
}
_RATE_COLUMNS = ["actual_default_rate", "model_approval_rate"]


def _rates(spark, sf, by: str) -> DataFrame:
    return fairness.group_rates(_scored(spark, sf), by, Y, S, _T)


@check("q1_gender", check_sql(settled_select("g", _RATE_COLUMNS, ["CODE_GENDER", "n"]), g=_RATES["CODE_GENDER"]))
def gender(spark, sf):
    return settle(_rates(spark, sf, "CODE_GENDER"))


@check(
    "q2_education",
    check_sql(settled_select("g", _RATE_COLUMNS, ["NAME_EDUCATION_TYPE", "n"]), g=_RATES["NAME_EDUCATION_TYPE"]),
)
def education(spark, sf):
    return settle(_rates(spark, sf, "NAME_EDUCATION_TYPE"))


_GAPS = [("CODE_GENDER", "F", "M"), ("NAME_EDUCATION_TYPE", "Higher education", "Lower secondary")]


def _gap_sql(by: str, a: str, b: str) -> str:
    return (
        f"SELECT '{a}' AS favoured, '{b}' AS other, (x.model_approval_rate-y.model_approval_rate)*100 AS approval_gap_pp, "
        f"(y.actual_default_rate-x.actual_default_rate)*100 AS default_gap_pp FROM ({_RATES[by]}) AS x, "
        f"({_RATES[by]}) AS y WHERE x.{by}='{a}' AND y.{by}='{b}'"
    )


@check(
    "q3_gaps",
    check_sql(
        settled_select("d", ["approval_gap_pp", "default_gap_pp"], ["favoured", "other", "disparity"]),
        d="SELECT *, approval_gap_pp > default_gap_pp AS disparity FROM ("
        + " UNION ALL ".join(_gap_sql(*g) for g in _GAPS)
        + ") AS u",
    ),
)
def gaps(spark, sf):
    found = [fairness.rate_gap(_rates(spark, sf, by), by, a, b) for by, a, b in _GAPS]
    return settle(fairness.flag_disparity(reduce(DataFrame.unionByName, found)))


@check(
    "q5_labels",
    check_sql(
        "SELECT SK_ID_CURR, CASE CODE_GENDER WHEN 'F' THEN 'Female' WHEN 'M' THEN 'Male' END AS gender, "
        "replace(replace(NAME_EDUCATION_TYPE, ' / secondary special', ''), 'secondary', 'Secondary') AS education FROM scored"
    ),
)
def labels(spark, sf):
    named = fairness.relabel(_scored(spark, sf), "CODE_GENDER", "gender", names=names.GENDER_NAMES)
    named = fairness.relabel(named, "NAME_EDUCATION_TYPE", "education", replace=names.EDUCATION_SHORTENING)
    return named.select(KEY, "gender", "education")


# A leaderboard of single-score rankings: each imputed external score, turned round, as a "model".
_LONG = " UNION ALL ".join(
    f"SELECT '{c}' AS model, fold, TARGET, 1 - coalesce({c}, (SELECT {c} FROM all_medians)) AS SCORE FROM folds"
    for c in names.EXTERNAL_SCORES
)


@check(
    "t1_leaderboard",
    check_sql(
        settled_select("b", ["mean_auc", "std_auc"], ["model", "folds", f"row_number() OVER (ORDER BY {rounded('mean_auc', 4)} DESC, model) AS place"]),
        long=_LONG,
        per_fold=_auc_sql("long", "model, fold"),
        b="SELECT model, avg(auc) AS mean_auc, stddev_pop(auc) AS std_auc, count(*) AS folds FROM per_fold GROUP BY model",
    ).replace("(mean_auc+1e-6)", "(mean_auc+0)"),
)
def leaderboard(spark, sf):
    table = app.impute_scores(fixture(spark, sf, "application"))
    table = sampling.stratified_folds(table, Y, 3, KEY, SEED, ORDER)
    scores = F.array(
        *[F.struct(F.lit(c).alias("model"), (1 - F.col(c)).alias(S)) for c in names.EXTERNAL_SCORES]
    )
    long = table.select("fold", Y, F.inline(scores))
    per_fold = evaluation.auc(long, Y, S, by=["model", "fold"])
    board = ranking.leaderboard(ranking.summarise_folds(per_fold, "model", "auc"), "mean_auc", "model", place="place")
    return settle(board)


# Fixed weights over prepared columns: a stand-in for a fitted linear model that SQL can follow.
_WEIGHTS = {"EXT_SOURCE_MEAN": -2.5, "AGE_YEARS": -0.03, "LOAN_TO_VALUE_RATIO": 0.8, "EMPLOYED_YEARS": -0.05}


@check(
    "x2_linear_attribution",
    check_sql(
        settled_select("a", [*[f"PHI_{c}" for c in _WEIGHTS], "TOTAL"], [KEY]),
        means="SELECT " + ", ".join(f"avg({c}) AS {c}" for c in _WEIGHTS) + " FROM prepared_all",
        phi="SELECT SK_ID_CURR, "
        + ", ".join(f"{dbl(w)}*({c}-(SELECT {c} FROM means)) AS PHI_{c}" for c, w in _WEIGHTS.items())
        + " FROM prepared_all",
        a="SELECT *, " + "+".join(f"PHI_{c}" for c in _WEIGHTS) + " AS TOTAL FROM phi",
    ),
)
def linear_attribution(spark, sf):
    table = app.engineer_features(app.clean_application(fixture(spark, sf, "application")))
    means = table.agg(*[F.avg(c).alias(c) for c in _WEIGHTS]).first().asDict()
    phi = explanation.linear_attributions(table, _WEIGHTS, means)
    phi = explanation.total_attribution(phi, [f"PHI_{c}" for c in _WEIGHTS], "TOTAL")
    return settle(phi.select(KEY, *[f"PHI_{c}" for c in _WEIGHTS], "TOTAL"))


# Per reason feature: weight and the value it is measured from.
_REASON_WEIGHTS = {
    "EXT_SOURCE_MEAN": (-3.0, 0.5),
    "EXT_SOURCE_2x3": (-2.0, 0.25),
    "EXT_SOURCE_1x3": (-2.0, 0.25),
    "INST_LATE_RATIO": (1.5, 0.4),
    "BUREAU_DEBT_CREDIT_RATIO": (2.0, 0.2),
    "LOAN_TO_VALUE_RATIO": (1.0, 1.0),
    "PREV_REFUSAL_RATE": (1.0, 0.1),
    "PREV_CREDIT_REQUEST_RATIO": (0.5, 0.5),
    "CREDIT_TERM_MONTHS": (0.01, 24.0),
    "EMPLOYED_YEARS": (-0.05, 9.0),
    "ANNUITY_INCOME_RATIO": (0.7, 0.15),
}


def _reasons_sql() -> dict[str, str]:
    phi = ", ".join(
        f"CASE WHEN isfinite({c}) THEN {dbl(w)}*({c}-{dbl(m)}) END AS PHI_{c}"
        for c, (w, m) in _REASON_WEIGHTS.items()
    )
    joined = "prepared_all " + " ".join(
        f"LEFT JOIN {t}_agg USING (SK_ID_CURR)" for t in ("bureau", "previous_application", "installments")
    )
    rows = " UNION ALL ".join(
        f"SELECT SK_ID_CURR, {at} AS pos, '{reason}' AS reason, '{category}' AS category, "
        f"greatest({', '.join(f'PHI_{f}' for f in fs)}) AS attribution FROM phi"
        for at, (fs, reason, category) in enumerate(names.REASONS)
    )
    return {
        "phi": f"SELECT SK_ID_CURR, {phi} FROM {joined} WHERE 1-EXT_SOURCE_MEAN >= 0.5",
        "reason_rows": rows,
        "cited": "SELECT *, row_number() OVER (PARTITION BY SK_ID_CURR ORDER BY attribution DESC, pos) AS rk "
        "FROM reason_rows WHERE attribution > 0",
    }


@check(
    "x5_adverse_actions",
    check_sql(
        "SELECT SK_ID_CURR, CAST(rk AS INTEGER) AS rank, reason, category, attribution FROM cited WHERE rk <= 4",
        **_reasons_sql(),
    ),
)
def adverse_actions(spark, sf):
    table = app.engineer_features(app.clean_application(fixture(spark, sf, "application")))
    found = children(spark, sf)
    joined = join_histories(table, {t: found[t] for t in ("bureau", "previous_application", "installments")})
    joined = with_exprs(joined, {c: finite_or_null(c) for c in _REASON_WEIGHTS})
    phi = explanation.linear_attributions(
        joined,
        {c: w for c, (w, _) in _REASON_WEIGHTS.items()},
        {c: m for c, (_, m) in _REASON_WEIGHTS.items()},
    ).withColumn(S, 1 - F.col("EXT_SOURCE_MEAN"))
    return explanation.adverse_actions(phi, KEY, S, 0.5, names.REASONS, exclude=names.PROTECTED)
