import pytest
from pyspark.sql import functions as F

from opinara.config import JobConfig, read_config, subset_size
from opinara.operators.profiling import missing_values
from opinara.sources.reviews import dedupe_reviews, drop_missing, load_audit, load_reviews, normalize_columns
from opinara.sources.splits import load_splits, write_splits


def test_csv_with_quotes_newlines_and_missing_values(spark, tmp_path):
    path = tmp_path / "reviews.csv"
    path.write_text(
        ' Review ,SENTIMENT\n"say ""hi"",\nthen go",positive\nNA,negative\nplain,\nplain,negative\nplain,positive\n'
    )
    rows = load_reviews(spark, str(path)).collect()
    assert {(r.review, r.sentiment) for r in rows} == {('say "hi",\nthen go', "positive"), ("plain", "negative")}
    assert len({r.id for r in rows}) == 2


def test_missing_column_lists_what_was_found(spark):
    with pytest.raises(ValueError, match="sentiment.*other"):
        normalize_columns(spark.createDataFrame([("a", 1)], ["Review", "Other"]))


def test_missing_file_raises(spark):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_reviews(spark, "/nowhere/reviews.csv")


def test_missing_values_go_before_copies(spark):
    rows = spark.createDataFrame(
        [(1, "a", None), (2, "a", "positive"), (3, "a", "negative"), (4, None, "positive")],
        "id bigint, review string, sentiment string",
    )
    kept = dedupe_reviews(drop_missing(rows))
    assert [tuple(r) for r in kept.collect()] == [(2, "a", "positive")]
    assert tuple(load_audit(rows, kept).first()) == (4, 1, 3)


def test_dedupe_keeps_lowest_id_of_a_hot_text_and_other_columns(spark):
    rows = spark.range(3000).selectExpr("id", "if(id % 3 = 0, 'hot', concat('t', id)) review", "id % 7 extra")
    kept = dedupe_reviews(rows)
    assert kept.count() == 2001
    assert tuple(kept.where("review = 'hot'").first()) == (0, "hot", 0)
    assert "Window" not in kept._jdf.queryExecution().optimizedPlan().toString()


def test_splits_round_trip_and_prune(spark, tmp_path, review_rows):
    path = str(tmp_path / "splits")
    write_splits(review_rows.selectExpr("*", "if(id % 2 = 0, 'train', 'test') split"), path)
    assert load_splits(spark, path).count() == 60
    assert load_splits(spark, path, "test").count() == 30
    with pytest.raises(ValueError):
        load_splits(spark, path, "other")


def test_subset_names():
    assert subset_size("dev") == 2000 and subset_size("full") is None
    with pytest.raises(ValueError):
        subset_size("tiny")


def test_text_ids_and_names_given_twice(spark, tmp_path):
    path = str(tmp_path / "in.csv")
    (tmp_path / "in.csv").write_text("Id,review,sentiment\na1,fine,positive\na2,poor,negative\n")
    assert {r.id for r in load_reviews(spark, path, id_col="id").collect()} == {"a1", "a2"}
    (tmp_path / "twice.csv").write_text("review,Review ,sentiment\nx,y,positive\n")
    with pytest.raises(ValueError, match="more than once"):
        load_reviews(spark, str(tmp_path / "twice.csv"))


def test_csv_splits_and_dotted_names(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b"\nc', "positive", "train"), (2, "d", "negative", "test")], "id bigint, review string, sentiment string, split string")
    write_splits(rows, str(tmp_path / "splits"), "csv")
    back = load_splits(spark, str(tmp_path / "splits"), fmt="csv")
    assert sorted(map(tuple, back.select(rows.columns).collect())) == sorted(map(tuple, rows.collect()))
    dotted = rows.withColumn("a.b", F.lit(None).cast("string"))
    assert {r.column_name: r.n_missing for r in missing_values(dotted).collect()}["a.b"] == 2
    assert dedupe_reviews(dotted).count() == 2


def test_configuration_files(tmp_path):
    path = tmp_path / "job.json"
    path.write_text(
        '{"split": {"test_size": 0.2}, "training": {"cleaning": {"strategy": "minimal"}, "features": {"ngram_range": [1, 1]},'
        ' "active_models": ["multinomial_nb"], "model_params": {"multinomial_nb": {"alpha": 0.5}}}}'
    )
    config = read_config(str(path))
    assert config.split.test_size == 0.2 and config.split.val_size == 0.15
    assert config.training.cleaning.strategy == "minimal" and config.training.features.ngram_range == (1, 1)
    assert config.training.active_models == ("multinomial_nb",)
    assert config.training.params_for("multinomial_nb") == {"alpha": 0.5}
    assert read_config(None) == JobConfig()
    path.write_text('{"training": {"colour": 1}}')
    with pytest.raises(ValueError, match="colour"):
        read_config(str(path))
