import random

import numpy as np
import pytest

from opinara.llm.source_mixing import MixConfig, mix, mix_sources, pivot

SCHEMA = "doc_id long, text string, source string, size string, bucket string"


def targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, out = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in out]
        rest = total - sum(out.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in above}


@pytest.mark.parametrize("bucket_rows", [50_000, 7])
def test_targets_are_met(spark, bucket_rows):
    draw = random.Random(6)
    names = ["b", "a", "Z", "é", None, "\U0001f600", "small", "hot"]
    rows = [
        (i, " ".join(["w"] * draw.randrange(1, 200)) if i % 11 else draw.choice(["", None, " \n"]), "hot" if i % 3 == 0 else draw.choice(names), "", "")
        for i in range(900)
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    config = MixConfig(bucket_rows=bucket_rows, fan_in=3)
    out = {r.doc_id: r for r in mix(df, config).collect()}
    assert len(out) == 900
    sizes, taken, most = {}, {}, {}
    for i, t, s, *_ in rows:
        n = len((t or "").split())
        assert out[i].size == n and out[i].taken <= 3 * n
        sizes[s] = sizes.get(s, 0) + n
        taken[s] = taken.get(s, 0) + out[i].taken
        most[s] = max(most.get(s, 0), n)
    want = targets(sizes)
    for i, _, s, *_ in rows:
        assert out[i].source_size == sizes[s] and abs(out[i].target - want[s]) < 1e-6 * max(1, want[s])
    assert all(abs(taken[s] - want[s]) <= most[s] for s in sizes)
    again = {r.doc_id: r.taken for r in mix(df.repartition(5), config).collect()}
    assert again == {i: r.taken for i, r in out.items()}


def test_pivot_keeps_words_and_expectations():
    sizes = np.array([3.0, 10, 1, 7, 5, 20])
    runs = np.array([pivot(sizes, np.full(6, 0.3), np.random.default_rng(s)) for s in range(4000)])
    assert np.allclose(runs @ sizes, 0.3 * sizes.sum())
    assert (((runs > 0) & (runs < 1)).sum(axis=1) <= 1).all()
    assert np.allclose(runs.mean(axis=0), 0.3, atol=0.03)


def test_stage_repeats_and_drops(spark):
    rows = [(i, "w " * 10, "a" if i < 10 else "b", "x", "y") for i in range(100)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = mix_sources(spark, df, "")
    assert out.columns == df.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert all(counts[i] == 3 for i in range(10)) and sum(counts.values()) == 100


def test_repeated_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a b", "s", "", ""), (1, "a b", "s", "", ""), (None, None, None, "", "")], SCHEMA)
    out = mix(df).collect()
    assert sorted(r.taken for r in out) == [0, 2, 2]
    assert mix(df.limit(0)).count() == 0
    assert [r.target for r in mix(df.where("doc_id is null")).collect()] == [0.0]
