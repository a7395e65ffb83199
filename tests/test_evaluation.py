import random

import pytest

from opinara.contract import queries
from opinara.operators import evaluation as ev


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(7)
    rows = []
    for model in ("a", "b"):
        for i in range(400):
            label = float(rng.random() < 0.3)
            score = round(min(max(rng.gauss(0.4 + 0.2 * label, 0.2), 0.0), 1.0), 2)
            rows.append((model, i, label, float(score > 0.5), score))
    return spark.createDataFrame(rows, "model string, id int, label double, prediction double, score double").cache()


def brute(rows):
    tp = sum(r.label == 1 and r.prediction == 1 for r in rows)
    fp = sum(r.label == 0 and r.prediction == 1 for r in rows)
    fn = sum(r.label == 1 and r.prediction == 0 for r in rows)
    tn = sum(r.label == 0 and r.prediction == 0 for r in rows)
    pos = [r.score for r in rows if r.label == 1]
    neg = [r.score for r in rows if r.label == 0]
    auc = sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))
    return tn, fp, fn, tp, auc


def test_metrics_equal_brute_force(scored):
    got = {r.model: r for r in ev.metrics(scored).collect()}
    for model in ("a", "b"):
        tn, fp, fn, tp, auc = brute([r for r in scored.collect() if r.model == model])
        assert got[model].accuracy == pytest.approx((tp + tn) / 400, abs=5e-5)
        assert got[model].precision == pytest.approx(tp / (tp + fp), abs=5e-5)
        assert got[model].recall == pytest.approx(tp / (tp + fn), abs=5e-5)
        assert got[model].f1 == pytest.approx(2 * tp / (2 * tp + fp + fn), abs=5e-5)
        assert got[model].roc_auc == pytest.approx(auc, abs=5e-5)


@pytest.mark.parametrize("per_range", [1_000_000, 10, 1])
def test_auc_and_curve_over_score_ranges(scored, per_range):
    got = {r.model: r.roc_auc for r in ev.roc_auc(scored, per_range=per_range).collect()}
    for model in ("a", "b"):
        assert got[model] == pytest.approx(brute([r for r in scored.collect() if r.model == model])[4], abs=5e-5)
    whole = sorted(map(str, ev.roc_curve(scored).collect()))
    assert whole == sorted(map(str, ev.roc_curve(scored, per_range=per_range).collect()))


@pytest.mark.parametrize("per_range", [1_000_000, 7, 1])
def test_curve_keeps_corners_and_its_area(spark, per_range):
    draw = random.Random(per_range)
    rows = [("m", float(draw.random() < 0.4 + 0.5 * (s > 30)), 0.0, s / 64) for s in range(64) for _ in range(draw.choice([1, 1, 1, 2, 3]))]
    rows += [("one", 1.0, 0.0, 0.5), ("two", 1.0, 0.0, 0.5), ("two", 0.0, 0.0, 0.25)]
    df = spark.createDataFrame(rows, "model string, label double, prediction double, score double")

    def points(**options):
        found = ev.roc_curve(df, per_range=per_range, **options).collect()
        return sorted((r.model, -2.0 if r.threshold is None else -r.threshold, r.fpr, r.tpr) for r in found)

    every, corners = points(corners_only=False), points()
    assert set(corners) < set(every) and len([p for p in corners if p[0] != "m"]) == 5
    by_score = {}
    for _, y, _, s in rows[: len(rows) - 3]:
        pos, neg = by_score.get(s, (0, 0))
        by_score[s] = pos + (y == 1), neg + (y == 0)
    down = sorted(by_score, reverse=True)
    steps = [by_score[s] for s in down]
    kept = [s for i, s in enumerate(down) if i == 0 or i == len(down) - 1 or steps[i] != steps[i + 1]]
    assert [-p[1] for p in corners if p[0] == "m" and p[1] != -2.0] == kept

    def area(found):
        line = [(x, y) for m, _, x, y in found if m == "m"]
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(line, line[1:]))

    assert area(corners) == pytest.approx(area(every), abs=1e-12)


def test_confusion_lists_empty_cells(spark):
    rows = spark.createDataFrame([("m", 1.0, 1.0, 0.9)], "model string, label double, prediction double, score double")
    cells = {(r.actual, r.predicted): r.n for r in ev.confusion_matrix(rows).collect()}
    assert cells == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 1}


def test_undefined_metrics(spark):
    rows = spark.createDataFrame([("m", 1.0, 0.0, 0.2), ("m", 1.0, 0.0, 0.1)], "model string, label double, prediction double, score double")
    row = ev.metrics(rows).first()
    assert (row.precision, row.recall, row.f1, row.roc_auc) == (0.0, 0.0, 0.0, None)


def test_comparison_and_champion(spark):
    schema = "model string, accuracy double, precision double, recall double, f1 double, roc_auc double"
    rows = spark.createDataFrame(
        [("x", 0.8, 0.8, 0.8, 0.8, 0.85), ("y", 0.9, 0.9, 0.9, 0.9, None), ("z", 0.7, 0.7, 0.7, 0.9, 0.5)], schema
    )
    assert [r.model for r in ev.comparison(rows).orderBy("rank").collect()] == ["y", "z", "x"]
    assert ev.select_best(rows, "f1", ("z", "y")).first().model == "z"
    assert ev.select_best(rows, "roc_auc", ("y", "x")).first().model == "x"


@pytest.mark.parametrize("per_range", [1_000_000, 2])
def test_rows_without_a_score_take_no_part(spark, per_range):
    rows = [("m", 1.0, 0.9), ("m", 0.0, 0.1), ("m", 1.0, 0.3), ("m", 0.0, 0.4), ("m", 1.0, 0.8)]
    odd = [("m", 1.0, None), ("m", 0.0, float("nan")), ("m", 0.0, None)]
    schema = "model string, label double, score double"
    plain = ev.roc_auc(spark.createDataFrame(rows, schema), per_range=per_range).collect()
    assert ev.roc_auc(spark.createDataFrame(rows + odd, schema), per_range=per_range).collect() == plain
    assert plain[0].roc_auc == round(5 / 6, 4)


def test_curve_query_has_a_point_per_score(spark, monkeypatch):
    """Three positives, then two negatives: corners alone would be three points."""
    scored = [("tfidf", "val", label, score) for label, score in [(1, 5.0), (1, 4.0), (1, 3.0), (0, 2.0), (0, 1.0)]]
    rows = spark.createDataFrame(scored, "variant string, split string, label int, score double")
    monkeypatch.setattr(queries, "_variants", lambda spark, folder: rows)
    points = {(r.threshold, r.fpr, round(r.tpr, 3)) for r in queries.roc_curve(spark, "").collect()}
    assert points == {
        (None, 0.0, 0.0), (5.0, 0.0, 0.333), (4.0, 0.0, 0.667), (3.0, 0.0, 1.0), (2.0, 0.5, 1.0), (1.0, 1.0, 1.0)
    }
