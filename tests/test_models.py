import pytest

from creditloom.functions import portable_order
from creditloom.operators import encoding, models, sampling
from creditloom.plans import candidates, end_to_end
from creditloom.plans import loan_columns as names
from creditloom.session import ensure_checkpoint_dir, materialize, new_path, scratch_dir
from creditloom.checks.fixtures import children, fixture

SF = "/root/testdata/sf0.01"


def test_scratch_folder(spark):
    folder = scratch_dir(spark)
    assert scratch_dir(spark) == folder and new_path(spark, "a") != new_path(spark, "a")
    ensure_checkpoint_dir(spark)
    df = materialize(spark.range(3), "t")
    assert df.count() == 3 and df.dtypes == spark.range(3).dtypes


def test_ordinal_paths_agree(spark, monkeypatch):
    rows = [(i, f"v{i % 40:02d}", "x" if i % 3 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "id bigint, a string, b string")
    modes = encoding.fit_mode_imputer(df, ["a", "b"])
    assert modes == {"a": "v00", "b": "x"}
    unseen = spark.createDataFrame([(0, "v05", None), (1, "zzz", "y"), (2, None, "x")], "id bigint, a string, b string")
    want = [(0, 5.0, 0.0), (1, -1.0, -1.0), (2, 0.0, 0.0)]

    def run():
        fit = encoding.fit_ordinal(df, ["a", "b"], modes, driver_levels=limit)
        return fit, [tuple(r) for r in encoding.apply_ordinal(unseen, fit, modes).orderBy("id").collect()]

    limit = 1000
    assert run()[1] == want
    monkeypatch.setattr(encoding, "LITERAL_LEVELS", 3)
    assert run()[1] == want
    limit = 10
    fit, got = run()
    assert set(fit.tables) == {"a"} and got == want
    limit = 1000
    monkeypatch.setattr(encoding, "BROADCAST_CHARS", 1)
    assert run()[1] == want


def test_preprocessor(spark):
    rows = [(1, 0, 1.0, True, "b", 5.0), (2, 1, None, False, "a", 5.0), (3, 0, float("inf"), None, None, 5.0), (4, 1, 3.0, True, "b", 5.0)]
    df = spark.createDataFrame(rows, "id bigint, y int, n double, f boolean, c string, same double")
    fitted = encoding.build_preprocessor(df, ["id", "y"]).fit(df)
    assert fitted.feature_names == ["n", "f", "same", "c"]
    assert fitted.medians == {"n": 2.0, "f": 1.0, "same": 5.0} and fitted.scales["same"] == (5.0, 1.0)
    x = {r["id"]: r["x"] for r in fitted.encode(df, ["id"]).collect()}
    assert x[2][0] == x[3][0] == 0.0 and x[3][3] == 1.0 and x[2][3] == 0.0
    assert fitted.transform(df).columns == [*df.columns, "features"]
    empty = encoding.Preprocessor([], []).fit(df)
    assert empty.feature_names == []


def test_all_null_column_does_not_break_the_features(spark):
    df = spark.createDataFrame([(1, None, None), (2, None, None)], "id bigint, n double, c string")
    fitted = encoding.build_preprocessor(df, ["id"]).fit(df)
    assert fitted.encode(df, ["id"]).first()["x"] == [0.0, -1.0]


@pytest.fixture(scope="module")
def folded(spark):
    tables = end_to_end.feature_tables(fixture(spark, SF, "train"), fixture(spark, SF, "test"), {}, 3, 42, portable_order(42))
    return materialize(tables.train)


def test_out_of_fold_scores_every_row_once_by_an_unseen_fit(spark, folded):
    oof = models.out_of_fold(folded, candidates.baselines(20), names.LABEL, names.KEY, 3, parallelism=3)
    assert oof.count() == 2 * folded.count()
    assert oof.select("model", names.KEY).distinct().count() == 2 * folded.count()
    assert oof.join(folded, [names.KEY, "fold"]).count() == oof.count()
    table = {r["model"]: r for r in models.cross_validate(folded, candidates.baselines(20), names.LABEL, names.KEY, 3).collect()}
    assert table["majority"]["mean_auc"] == 0.5 and table["majority"]["std_auc"] == 0.0
    assert table["lr_external"]["mean_auc"] > 0.65


def test_fits_repeat(spark, folded):
    spec = candidates.candidates(folded.columns, 3, 3, 3)[3]
    train = folded.drop("fold")

    def scores():
        model = models.fit_model(spec, train, names.LABEL, names.KEY)
        return {r[0]: r[1] for r in model.score(train, [names.KEY]).collect()}, model

    (one, model), (two, _) = scores(), scores()
    assert one == two and all(0 <= v <= 1 for v in one.values())
    assert names.KEY not in model.preprocessor.feature_names and names.LABEL not in model.preprocessor.feature_names
    top = model.top_features(spark, 5).collect()
    assert len(top) == 5 and top[0]["importance"] >= top[-1]["importance"]


def test_weights(spark):
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(13)], "id bigint, y int")
    assert models.scale_pos_weight(df, "y") == 3
    assert models.class_weights(df, "y") == {0: 13 / 20, 1: 13 / 6}


def test_search_draws(spark):
    draws = models.draw_params(names.SEARCH_SPACE, 200, 1)
    assert draws == models.draw_params(names.SEARCH_SPACE, 200, 1)
    assert {d["max_depth"] for d in draws} == set(range(3, 10))
    assert all(0.6 <= d["subsample"] <= 1.0 for d in draws)


def test_resampling_sees_training_rows_only(spark, folded):
    seen = []

    def spy(rows, label, key):
        seen.append({r[0] for r in rows.select(key).collect()})
        return sampling.undersample(rows, label, key, 1.0)

    spec = models.ModelSpec("spied", models.logistic(1.0, 5), names.EXTERNAL_SCORES, resample=spy)
    oof = models.out_of_fold(folded, [spec], names.LABEL, names.KEY, 3)
    held = {}
    for r in oof.select(names.KEY, "fold").collect():
        held.setdefault(r["fold"], set()).add(r[0])
    assert len(seen) == 3 and all(not seen[i] & held[i] for i in range(3))


def test_whole_job(spark):
    spec = models.ModelSpec("lr", models.logistic(1.0, 20), names.EXTERNAL_SCORES)
    splits = fixture(spark, SF, "train"), fixture(spark, SF, "test")
    reports = end_to_end.run(*splits, children(spark, SF), spec, order=portable_order(42))
    assert reports.submission.columns == [names.KEY, names.LABEL]
    assert reports.submission.count() == splits[1].count() and reports.oof.count() == splits[0].count()
    assert reports.tables["auc"].first()["auc"] > 0.65
    for name, table in reports.tables.items():
        assert not table.isEmpty(), name
