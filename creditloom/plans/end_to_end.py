"""From the raw tables to out-of-fold scores, report tables and the submission table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import HashOrder, finite_or_null, with_exprs
from ..operators import alignment, decisions, evaluation, fairness, models, sampling
from ..operators.models import FittedModel, ModelSpec
from ..session import materialize, spread, tune
from ..sources import score_table
from . import loan_columns as names
from .application import FittedParams, fit_params, prepare_application
from .history import join_histories


@dataclass(frozen=True)
class FeatureTables:
    """Applicants of both splits with their features, ``split`` telling them apart."""

    joined: DataFrame
    params: FittedParams

    @property
    def train(self) -> DataFrame:
        return self.joined.filter("split = 'train'").drop("split")

    @property
    def test(self) -> DataFrame:
        return self.joined.filter("split = 'test'").drop("split", names.LABEL, "fold")

    def written(self) -> FeatureTables:
        """The same, written once: the child tables are read and joined once for both splits."""
        return FeatureTables(materialize(self.joined, "features"), self.params)


def feature_tables(
    train: DataFrame,
    test: DataFrame,
    children: dict[str, DataFrame],
    k: int | None = None,
    seed: int = 42,
    order: HashOrder | None = None,
) -> FeatureTables:
    """Prepare both splits and join the child aggregates to them together.

    Medians and columns come from training only; the test rows get exactly the feature columns of
    the training table. With ``k`` the training rows carry their stratified fold, found from label
    and key before the joins, so that the counting passes stay narrow.
    """
    train, test = (spread(t, len(t.columns), "applications") for t in (train, test))
    fitted = fit_params(train)
    prepared, fitted = prepare_application(train, fitted, is_train=True)
    scoring, _ = prepare_application(test, fitted, is_train=False)
    if k is not None:
        prepared = sampling.stratified_folds(prepared, names.LABEL, k, names.KEY, seed, order)
    scoring = alignment.align_to(scoring, prepared.schema)
    both = with_exprs(prepared, {"split": "'train'"}).unionByName(with_exprs(scoring, {"split": "'test'"}))
    return FeatureTables(join_histories(both, children), fitted)


@dataclass
class Reports:
    oof: DataFrame
    submission: DataFrame
    model: FittedModel
    tables: dict[str, DataFrame] = field(default_factory=dict)


def decision_reports(scored: DataFrame, amounts: DataFrame, score: str = "SCORE") -> dict[str, DataFrame]:
    """Every table the decision report is made of, from one scored table."""
    cost = decisions.cost_model(
        amounts,
        "AMT_CREDIT",
        names.EXCHANGE_RATE,
        names.NET_MARGIN,
        names.LOSS_GIVEN_DEFAULT,
        names.RECOVERY,
    )
    y = names.LABEL
    sweep = decisions.threshold_sweep(scored, y, score, cost)
    gender = fairness.group_rates(scored, "CODE_GENDER", y, score, names.CHOSEN_THRESHOLD)
    education = fairness.group_rates(scored, "NAME_EDUCATION_TYPE", y, score, names.CHOSEN_THRESHOLD)
    policies = {
        "approve_all": None,
        "at_default": names.DEFAULT_THRESHOLD,
        "at_chosen": names.CHOSEN_THRESHOLD,
    }
    return {
        "auc": evaluation.auc(scored, y, score),
        "roc": evaluation.roc_curve(scored, y, score),
        "metrics": evaluation.metrics_at(scored, y, score, names.CHOSEN_THRESHOLD),
        "sweep": sweep,
        "best_threshold": decisions.best_threshold(sweep),
        "policies": decisions.policy_table(scored, y, score, policies, cost),
        "sensitivity": decisions.cost_sensitivity(
            decisions.sweep_counts(scored, y, score), cost, names.COST_FACTORS
        ),
        "bands": decisions.tier_summary(scored, y, score, *names.REVIEW_BAND),
        "gender": gender,
        "education": education,
        "gender_gap": fairness.flag_disparity(fairness.rate_gap(gender, "CODE_GENDER", "F", "M")),
        "education_gap": fairness.flag_disparity(
            fairness.rate_gap(education, "NAME_EDUCATION_TYPE", "Higher education", "Lower secondary")
        ),
    }


def run(
    train: DataFrame,
    test: DataFrame,
    children: dict[str, DataFrame],
    spec: ModelSpec,
    k: int = 3,
    seed: int = 42,
    order: HashOrder | None = None,
    parallelism: int = 1,
) -> Reports:
    """The whole job. The joined table and the out-of-fold scores are written once and read often."""
    tune(train.sparkSession)
    tables = feature_tables(train, test, children, k, seed, order).written()
    features = tables.train
    oof = models.out_of_fold(
        features,
        [spec],
        names.LABEL,
        names.KEY,
        k,
        keep=["AMT_CREDIT", *names.PROTECTED],
        parallelism=parallelism,
    )
    scored = materialize(oof, "oof")
    model = models.fit_model(spec, features.drop("fold"), names.LABEL, names.KEY)
    submission = score_table(model.score(tables.test, [names.KEY]), names.KEY, "SCORE", names.LABEL)
    # The report reads the loan amounts from the scored table, which holds one row per applicant.
    return Reports(scored, submission, model, decision_reports(scored, scored.select("AMT_CREDIT")))


def flagship(application: DataFrame, bureau: DataFrame) -> DataFrame:
    """Fit, clean, engineer, aggregate and join, then a report per external-score bin."""
    prepared, _ = prepare_application(application, fit_params(application))
    joined = join_histories(prepared, {"bureau": bureau})
    return joined.groupBy("EXT_SOURCE_MEAN_BIN").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(names.LABEL).alias("default_rate"),
        F.avg(F.expr(finite_or_null("BUREAU_DEBT_CREDIT_RATIO"))).alias("mean_debt_credit_ratio"),
    )
