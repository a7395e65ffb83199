from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.config import CleaningConfig, FeatureConfig, SplitConfig, TrainingConfig
from opinara.operators import classifiers
from opinara.operators.classifiers import MODELS, MarginClassifier, fit_linear_svm, load_model, model_fitter, save_model
from opinara.operators import profiling
from opinara.plans.evaluate import evaluate
from opinara.plans.prepare import prepare
from opinara.plans.profile import profile, profile_report
from opinara.plans.score import load_scorer, main as score_main, predict_batch, score, score_table
from opinara.plans.train import Steps, clean_splits, feature_table, run_job, save, train, train_all
from opinara.staging import stage, staging_path
from opinara.streaming.scoring import score_stream, start_scoring

FEATURES = FeatureConfig(max_features=500, ngram_range=(1, 1), min_df=1, max_df=1.0)
PLAIN = TrainingConfig(
    cleaning=CleaningConfig(lemmatize=False),
    features=FEATURES,
    active_models=("logistic_regression", "multinomial_nb"),
    model_params={"logistic_regression": {"max_iter": 50}},
)


@pytest.fixture(scope="module")
def split_rows(review_rows):
    return prepare(review_rows, "full", SplitConfig(test_size=0.2, val_size=0.2)).cache()


@pytest.fixture(scope="module")
def saved(spark, split_rows):
    trained = train(split_rows, PLAIN)
    path = staging_path(spark, "model")
    save(spark, trained, path)
    return trained, path


def test_job_end_to_end(spark, saved):
    trained, path = saved
    assert trained.champion in PLAIN.active_models
    rows = trained.validation.collect()
    assert {r.model for r in rows} == set(PLAIN.active_models)
    assert all(0 <= r.f1 <= 1 for r in rows)
    assert spark.read.json(f"{path}/metrics/validation").count() == 2


def test_evaluation_skips_unsaved_models(spark, saved, split_rows):
    _, path = saved
    rows = evaluate(spark, path, split_rows.where("split = 'test'"), ["multinomial_nb", "random_forest"]).collect()
    assert [r.model for r in rows] == ["multinomial_nb"]
    assert spark.read.parquet(f"{path}/metrics/test_roc").count() > 1
    with pytest.raises(ValueError):
        evaluate(spark, path, split_rows, ["random_forest"])


def test_scoring_keeps_rows_and_columns(spark, saved):
    trained, path = saved
    rows = spark.createDataFrame(
        [(1, "superb and charming"), (2, None), (3, "!!!"), (4, "dull and dreadful")], "key int, review string"
    )
    scorer = load_scorer(spark, path, "multinomial_nb")
    out = score(rows, scorer)
    assert out.columns == ["key", "review", "predicted_label", "confidence"]
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.key: r for r in out.collect()}
    assert got[1].predicted_label == "positive" and got[4].predicted_label == "negative"
    assert got[1].confidence > 0.5 > got[4].confidence
    assert got[2].confidence == got[3].confidence
    assert predict_batch(rows, scorer).columns == ["text", "predicted_label", "confidence", "model_used"]
    assert load_scorer(spark, path).model_name == trained.champion
    with pytest.raises(ValueError, match="no saved model"):
        load_scorer(spark, path, "other")
    with pytest.raises(ValueError, match="found columns"):
        score(rows, scorer, "text")


def test_score_table_from_csv(spark, saved, tmp_path):
    _, path = saved
    (tmp_path / "in.csv").write_text('review,extra\n"superb, charming",1\n"dull",2\n')
    out = score_table(spark, str(tmp_path / "in.csv"), load_scorer(spark, path), out=str(tmp_path / "out"))
    assert out.count() == 2 and set(out.columns) == {"review", "extra", "predicted_label", "confidence"}
    assert spark.read.option("header", True).csv(str(tmp_path / "out")).count() == 2


def test_stream_equals_batch(spark, saved, tmp_path, review_rows):
    _, path = saved
    scorer = load_scorer(spark, path, "multinomial_nb")
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    texts = review_rows.select("id", "review")
    texts.where("id < 30").write.parquet(source)
    for part in ("id >= 30", None):
        stream = spark.readStream.schema(texts.schema).parquet(source)
        start_scoring(stream, scorer, out, mark).awaitTermination()
        if part:
            texts.where(part).write.mode("append").parquet(source)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    assert got == sorted(map(tuple, score(texts, scorer).collect()))


@pytest.fixture(scope="module")
def features(split_rows):
    terms, rows = feature_table(clean_splits(split_rows, PLAIN)[0], PLAIN)
    return terms, rows.cache()


@pytest.mark.parametrize("name", ["logistic_regression", "linear_svm", "multinomial_nb", "random_forest", "sgd_linear"])
def test_models_fit_save_and_repeat(spark, features, tmp_path, name):
    terms, rows = features
    params = {"max_iter": 20, "class_weight": "balanced", "n_estimators": 5, "max_depth": 30, "alpha": 0.1}
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    model = model_fitter(name)(fitted, params, 42, len(terms.vocabulary))
    scored = [tuple(r) for r in model.score(fitted.select("id", "label", "features")).select("id", "prediction", "score").orderBy("id").collect()]
    assert all(0 <= s <= 1 and p in (0.0, 1.0) for _, p, s in scored)
    labels = [r.label for r in fitted.orderBy("id").collect()]
    assert sum(p == y for (_, p, _), y in zip(scored, labels)) / len(labels) > 0.8
    save_model(spark, model, str(tmp_path / name))
    again = load_model(spark, str(tmp_path / name)).score(fitted).select("id", "prediction", "score").orderBy("id")
    assert [tuple(r) for r in again.collect()] == scored


def test_fits_side_by_side_give_the_models_of_single_fits(spark, features, monkeypatch):
    terms, rows = features
    names = ("logistic_regression", "linear_svm", "multinomial_nb", "random_forest", "sgd_linear")
    config = replace(PLAIN, active_models=names, model_params={n: {"max_iter": 10, "n_estimators": 4} for n in names})
    pools = {}

    def noting(name):
        def fit(*given):
            pools[name] = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            return model_fitter(name)(*given)

        return fit

    monkeypatch.setattr("opinara.plans.train.model_fitter", noting)
    together = train_all(rows, terms, config)
    assert pools == {name: name for name in names} and list(together) == list(names)
    single = train_all(rows, terms, config, at_once=1)
    for name in names:
        scores = [[r.score for r in m[name].score(rows.select("id", "features")).orderBy("id").collect()] for m in (together, single)]
        assert scores[0] == pytest.approx(scores[1], abs=1e-9)
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None
    assert train_all(rows, terms, replace(config, active_models=())) == {}


def test_bare_svm_scores_margins(features):
    terms, rows = features
    model = fit_linear_svm(rows.where("split = 'train'").select("id", "label", "features"), {"max_iter": 10}, 42, 0)
    assert isinstance(model, MarginClassifier)
    assert model.score(rows).where((F.col("score") > 0) != (F.col("prediction") == 1)).count() == 0


def test_deeper_trees_than_the_library_grows_are_refused(features):
    terms, rows = features
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    with pytest.raises(ValueError, match="30 levels"):
        model_fitter("random_forest")(fitted, {"max_depth": 40}, 42, len(terms.vocabulary))


def test_forest_uses_every_feature(features):
    terms, rows = features
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    model = model_fitter("random_forest")(fitted, {"n_estimators": 2}, 42, len(terms.vocabulary))
    assert model.model.numFeatures == len(terms.vocabulary)
    assert model.score(fitted).columns[:3] == ["id", "label", "features"]


def test_forest_keeps_no_more_nodes_than_a_task_has_memory_for(spark, features, monkeypatch):
    terms, rows = features
    given, fit = [], classifiers.RandomForestClassifier.fit
    monkeypatch.setattr(classifiers.RandomForestClassifier, "fit", lambda self, *a: given.append(self.getMaxMemoryInMB()) or fit(self, *a))
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    for memory, want in ((450, 112), (100, 64), (9000, 1024)):
        monkeypatch.setattr(classifiers, "_memory_of_a_task", lambda spark, memory=memory: memory)
        model_fitter("random_forest")(fitted, {"n_estimators": 2}, 42, len(terms.vocabulary))
        assert given.pop() == want
    model_fitter("random_forest")(fitted, {"n_estimators": 2, "max_memory_mb": 300}, 42, len(terms.vocabulary))
    assert given.pop() == 300
    monkeypatch.undo()
    heap = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory() / 2**20
    assert 0 < classifiers._memory_of_a_task(spark) <= heap * 0.6 / spark.sparkContext.defaultParallelism


def test_forest_reads_even_partitions_and_remembers_nodes(spark, features, monkeypatch):
    terms, rows = features
    given, fit = {}, classifiers.RandomForestClassifier.fit

    def noting(self, df, params=None):
        given["sizes"], given["cached"] = df.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect(), self.getCacheNodeIds()
        return fit(self, df, params)

    monkeypatch.setattr(classifiers.RandomForestClassifier, "fit", noting)
    monkeypatch.setattr(classifiers, "ROWS_PER_TASK", 10)
    fitted = rows.where("split = 'train'").select("id", "label", "features").coalesce(1)
    model_fitter("random_forest")(fitted, {"n_estimators": 2}, 42, len(terms.vocabulary))
    assert given["cached"] and len(given["sizes"]) >= spark.sparkContext.defaultParallelism
    assert sum(given["sizes"]) == fitted.count() and max(given["sizes"]) - min(given["sizes"]) <= 1


def matrix(rows):
    rows = rows.where("split = 'train'").orderBy("id").collect()
    return np.array([r.features.toArray() for r in rows]), np.array([r.label for r in rows])


@pytest.mark.parametrize("name, params", [
    ("logistic_regression", {"C": 1.0, "max_iter": 2000, "tol": 1e-10, "class_weight": "balanced"}),
    ("logistic_regression", {"C": 4.0, "max_iter": 2000, "tol": 1e-10}),
    ("sgd_linear", {"alpha": 0.01, "max_iter": 2000, "tol": 1e-10}),
])
def test_logistic_fits_end_where_the_gradient_vanishes(features, name, params):
    """Summed weighted log loss and half the squared norm over C; the mean loss and alpha for the other."""
    terms, rows = features
    x, y = matrix(rows)
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    model = model_fitter(name)(fitted, params, 42, len(terms.vocabulary)).model
    w, b = model.coefficients.toArray(), model.intercept
    weight = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum()))) if "class_weight" in params else np.ones(len(y))
    error = weight * (1 / (1 + np.exp(-(x @ w + b))) - y)
    penalty = params.get("alpha", 1 / (params.get("C", 1.0) * weight.sum()))
    gradient = np.append(x.T @ error / weight.sum() + penalty * w, error.sum() / weight.sum())
    start = np.append(x.T @ (weight * (0.5 - y)), (weight * (0.5 - y)).sum()) / weight.sum()
    assert np.linalg.norm(gradient) < 1e-4 * max(1.0, np.linalg.norm(start))


def test_no_step_lowers_the_hinge_loss_of_a_fitted_svm(features):
    terms, rows = features
    x, y = matrix(rows)
    fitted = rows.where("split = 'train'").select("id", "label", "features")
    model = fit_linear_svm(fitted, {"C": 1.0, "max_iter": 2000, "tol": 1e-9}, 42, 0).model

    def loss(w, b):
        return np.maximum(0, 1 - (2 * y - 1) * (x @ w + b)).mean() + (w @ w) / (2 * len(y))

    w, b = model.coefficients.toArray(), model.intercept
    best, draw = loss(w, b), np.random.default_rng(1)
    for size in (1e-3, 1e-2, 1e-1, 1.0):
        for _ in range(100):
            step = draw.normal(size=len(w) + 1)
            step *= size / np.linalg.norm(step)
            assert loss(w + step[:-1], b + step[-1]) > best - 1e-4
        assert loss(w * (1 - size / 10), b) > best - 1e-4 and loss(w * (1 + size / 10), b) > best - 1e-4


def test_every_step_of_a_job_can_be_replaced(spark, split_rows, tmp_path):
    ran = []

    def noting(name, step):
        def run(*given):
            ran.append(name)
            return step(*given)

        return run

    plain = Steps()
    names = ("clean", "build_features", "fit", "evaluate", "choose", "persist")
    steps = replace(plain, **{name: noting(name, getattr(plain, name)) for name in names})
    config = replace(PLAIN, active_models=("multinomial_nb",))
    trained = run_job(split_rows, str(tmp_path / "model"), config, steps=steps)
    assert ran == list(names) and trained.champion == "multinomial_nb"
    assert load_scorer(spark, str(tmp_path / "model")).model_name == "multinomial_nb"

    def last_named(validation, config):
        return config.active_models[-1]

    for order in (PLAIN.active_models, PLAIN.active_models[::-1]):
        chosen = train(split_rows, replace(PLAIN, active_models=order), steps=replace(plain, choose=last_named))
        assert chosen.champion == order[-1] and chosen.scorer().model_name == order[-1]


def test_scoring_job_reads_one_format_and_writes_another(spark, saved, tmp_path, capsys):
    _, path = saved
    rows = spark.createDataFrame([(1, "superb and charming"), (2, "dull, dreadful"), (3, None)], "key int, review string")
    rows.write.parquet(str(tmp_path / "in"))
    given = ["--model", path, "--input", str(tmp_path / "in"), "--format", "parquet"]
    score_main([*given, "--output", str(tmp_path / "out"), "--output-format", "json", "--preview", "2"])
    assert "only showing top 2 rows" in capsys.readouterr().out
    written = spark.read.json(str(tmp_path / "out"))
    assert set(written.columns) == {"key", "review", "predicted_label", "confidence"} and written.count() == 3
    score_main([*given, "--output", str(tmp_path / "same")])
    assert capsys.readouterr().out == "" and spark.read.parquet(str(tmp_path / "same")).count() == 3
    score_main(["--model", path, "--model-name", "multinomial_nb", "--text", "superb"])
    assert "positive" in capsys.readouterr().out
    with pytest.raises(SystemExit):
        score_main(["--model", path])


def test_registry():
    assert {"logistic_regression", "linear_svm", "multinomial_nb", "random_forest", "sgd_linear"} <= set(MODELS)
    with pytest.raises(ValueError, match="choose one of"):
        model_fitter("not_a_model")


def test_lemmas_in_training_and_scoring(spark, split_rows, tmp_path):
    config = TrainingConfig(features=FEATURES, active_models=("multinomial_nb",))
    trained = train(split_rows, config)
    save(spark, trained, str(tmp_path / "model"))
    scorer = load_scorer(spark, str(tmp_path / "model"))
    rows = spark.createDataFrame([("superb scores",), ("dull stories",), (None,)], "review string")
    assert score(rows, scorer).count() == 3


@pytest.mark.parametrize("most", [None, 0])
def test_stream_with_lemmas_equals_batch_through_restarts(spark, split_rows, tmp_path, monkeypatch, most):
    """Twice over new files, also where the lexicon is too large to travel."""
    if most is not None:
        monkeypatch.setattr("opinara.operators.lemmas.LEXICON_ENTRIES", most)
    config = TrainingConfig(features=FEATURES, active_models=("multinomial_nb",))
    scorer = train(split_rows, config).scorer()
    more = spark.createDataFrame([(901, "superb gardens rivers"), (902, None), (903, "stations")], "id long, review string")
    texts = split_rows.select(F.col("id").cast("long").alias("id"), "review").unionByName(more)
    source, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    texts.where("id < 30").write.parquet(source)
    for part in ("id >= 30", None):
        stream = spark.readStream.schema(texts.schema).parquet(source)
        run = start_scoring(stream, scorer, out, mark)
        run.awaitTermination()
        assert ("ForeachBatch" in str(run.lastProgress["sink"])) == (most is not None)
        if part:
            texts.where(part).write.mode("append").parquet(source)
    got = sorted(map(str, map(tuple, spark.read.parquet(out).select("id", "review", "predicted_label", "confidence").collect())))
    assert got == sorted(map(str, map(tuple, score(texts, scorer).collect())))
    if most is None:
        with pytest.raises(ValueError, match="lexicon alone"):
            score_stream(spark.readStream.schema(texts.schema).parquet(source), replace(scorer, lexicon=None))


def test_length_sections_come_from_one_table_and_equal_the_operators(spark):
    rows = spark.range(90).selectExpr(
        "id", "if(id % 10 = 0, null, repeat(concat('w', id, ' '), int(id % 13))) review",
        "case id % 3 when 0 then 'positive' when 1 then 'negative' end sentiment",
    )
    sections = profile(stage(rows, "rows"))
    operators = (
        profiling.char_length_stats, profiling.word_count_stats, profiling.length_histogram, profiling.word_histogram,
        profiling.classwise_word_stats, profiling.classwise_boxplot,
    )
    for operator in operators:
        section, alone = sections[operator.__name__], operator(rows)
        assert section.columns == alone.columns
        assert sorted(map(str, section.collect())) == sorted(map(str, alone.collect())), operator.__name__
        assert "review" not in section._jdf.queryExecution().optimizedPlan().toString()
    nothing = profile(stage(rows.limit(0), "rows"))
    assert nothing["word_count_stats"].first()["count"] == profiling.word_count_stats(rows.limit(0)).first()["count"]


def test_profile_report(split_rows):
    train_rows = split_rows.where("split = 'train'").select("id", "review", "sentiment")
    sections = profile(train_rows, None, split_rows)
    values = {(r.section, r.key, r.stat): r.value for r in profile_report(sections).collect()}
    n = train_rows.count()
    assert values[("dataset_overview", "review|string", "n_rows")] == n
    assert values[("char_length_stats", "", "count")] == n
    assert sum(v for (s, _, stat), v in values.items() if s == "word_histogram" and stat == "n") == n
    assert sum(v for (s, _, stat), v in values.items() if s == "split_inspection" and stat == "n") == 60
