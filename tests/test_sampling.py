import hashlib
import math

import pytest
from pyspark.sql import functions as F

from opinara.operators import sampling
from opinara.operators.sampling import sample_reviews, stratified_folds, stratified_split, stratified_subset


@pytest.fixture(scope="module")
def rows(spark):
    label = "case when id % 10 < 7 then 'positive' when id % 10 < 9 then 'negative' else 'neutral' end"
    return spark.range(1000).selectExpr("id", f"{label} sentiment", "repeat('x', 3) review").cache()


def key(i, seed=42):
    return hashlib.md5(f"{i}:{seed}".encode()).hexdigest()


def by_rank(rows):
    classes = {}
    for r in rows.collect():
        classes.setdefault(r.sentiment, []).append(r.id)
    return {c: sorted(ids, key=lambda i: (key(i), i)) for c, ids in classes.items()}


@pytest.mark.parametrize("rank_at_once", [1_000_000, 100, 1])
def test_split_equals_the_global_rank(rows, monkeypatch, rank_at_once):
    """Also with one or two rounds of prefix counts."""
    monkeypatch.setattr(sampling, "ROWS_TO_RANK", rank_at_once)
    got = {r.id: r.split for r in stratified_split(rows).collect()}
    assert len(got) == 1000
    for ids in by_rank(rows).values():
        n = len(ids)
        test = sum(got[i] == "test" for i in ids)
        val = sum(got[i] == "val" for i in ids)
        assert abs(test - 0.15 * n) <= 1 and abs(val - 0.15 * n) <= 1
        assert [got[i] for i in ids] == ["test"] * test + ["val"] * val + ["train"] * (n - test - val)


def test_held_out_sizes_round_up(spark):
    rows = spark.range(385).selectExpr("id", "if(id < 328, 'positive', 'negative') sentiment")
    sizes = {(r.split, r.sentiment): r["count"] for r in stratified_split(rows).groupBy("split", "sentiment").count().collect()}
    assert sizes[("test", "positive")] == 49 and sizes[("test", "negative")] == 9
    assert sizes[("val", "positive")] == 49 and sizes[("val", "negative")] == 9
    assert sum(n for (s, _), n in sizes.items() if s == "test") == math.ceil(0.15 * 385)


def test_split_does_not_depend_on_partitioning(rows):
    once = {r.id: r.split for r in stratified_split(rows.repartition(7)).collect()}
    again = {r.id: r.split for r in stratified_split(rows.coalesce(1)).collect()}
    assert once == again


def test_split_applies_without_shuffling_texts(rows):
    plan = stratified_split(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Repartition" not in plan


def test_subset_quotas_and_membership(rows):
    got = {r.id for r in stratified_subset(rows, 101).collect()}
    for ids in by_rank(rows).values():
        quota = round(101 / 1000 * len(ids))
        assert got & set(ids) == set(ids[:quota])


def test_subset_of_everything(rows):
    assert stratified_subset(rows, None).count() == 1000
    assert stratified_subset(rows, 5000).count() == 1000


def test_string_ids(spark):
    rows = spark.range(60).selectExpr("md5(cast(id as string)) id", "if(id % 2 = 0, 'a', 'b') sentiment")
    assert stratified_split(rows).groupBy("split").count().count() == 3


def test_folds_are_even(rows):
    folds = stratified_folds(rows, 3, label="sentiment").groupBy("sentiment").pivot("fold").count().collect()
    for row in folds:
        counts = [row[str(i)] for i in range(3)]
        assert max(counts) - min(counts) <= 1


def test_sample_is_reproducible(rows):
    once = [tuple(r) for r in sample_reviews(rows, 5).orderBy("id").collect()]
    ranked = sorted(range(1000), key=lambda i: (key(i), i))[:5]
    assert [r[0] for r in once] == sorted(ranked)
    assert rows.select(F.max("id")).first()[0] == 999


def test_rows_without_a_label_are_left_out(spark):
    rows = spark.createDataFrame([(i, "positive" if i < 40 else None) for i in range(80)], "id int, sentiment string")
    counts = {r.split: r["count"] for r in stratified_split(rows).groupBy("split").count().collect()}
    assert counts == {"train": 28, "val": 6, "test": 6, None: 40}
