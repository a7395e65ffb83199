"""Passes that spare a shuffle: heavy hitters, recurring terms, ranks by label."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from opinara.config import FeatureConfig
from opinara.operators.features import fit_vocabulary
from opinara.operators.heavy_hitters import most_frequent, reduced, run_hashes, summary
from opinara.operators.profiling import class_term_freq, describe
from opinara.operators.ranking import top_per_group
from opinara.operators.recurrence import recurring, without_single_terms


def lists(spark, rows, parts=6):
    return spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id int, terms array<string>").repartition(parts)


def best(rows, k):
    counts = Counter(t for r in rows or [] if r for t in r if t is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0].encode()))[:k]


def adversaries():
    draw = random.Random(3)
    zipf = [[f"t{min(int(draw.paretovariate(0.8)), 5000)}" for _ in range(40)] for _ in range(200)]
    # Every count is the same, so no bound can tell; the first by name have to come out.
    flat = [[f"u{(7 * i + j) % 700:03d}" for j in range(7)] for i in range(700)]
    once = [[f"o{i}-{j}" for j in range(5)] for i in range(300)]
    # Each task's favourite is a stranger elsewhere, and the true first is never ahead in any.
    spread = [[*(f"s{i % 6}" for _ in range(5)), "true", "true", "true", f"x{i}"] for i in range(240)]
    ties = [["a", "b"], ["b", "a"], ["c"], [None, "c"], None, []]
    return {"zipf": zipf, "flat": flat, "once": once, "spread": spread, "ties": ties, "none": [None, []]}


@pytest.mark.parametrize("name", ["zipf", "flat", "once", "spread", "ties", "none"])
@pytest.mark.parametrize("counters,most", [(8, 512), (64, 64)])
def test_heavy_hitters_are_exact(spark, name, counters, most):
    rows = adversaries()[name]
    for k in (1, 5):
        got = [tuple(r) for r in most_frequent(lists(spark, rows), F.col("terms"), k, counters, most).collect()]
        assert got == best(rows, k)


@pytest.mark.parametrize("name", ["zipf", "spread", "ties", "none"])
@pytest.mark.parametrize("counters,most", [(64, 64)])
def test_frequent_runs_are_exact(spark, name, counters, most):
    rows = adversaries()[name]
    for low, high in ((1, 2), (2, 3)):
        runs = [
            [" ".join(r[i : i + n]) for n in range(low, high + 1) for i in range(len(r) - n + 1) if None not in r[i : i + n]]
            for r in rows if r
        ]
        got = most_frequent(lists(spark, rows), F.col("terms"), 5, counters, most, low, high)
        assert [tuple(r) for r in got.collect()] == best(runs, 5)


def test_runs_are_hashed_in_place():
    lists = pa.array([[1, 2, 3], None, [], [1, 2], [9]], pa.list_(pa.int64()))
    (pairs, two), (triples, three) = run_hashes(lists.slice(0, 5), 2, 3)
    assert pairs.tolist() == [0, 1, 3] and triples.tolist() == [0]
    assert two[0] == two[2] != two[1] and len(three) == 1
    assert [p.tolist() for p, _ in run_hashes(lists.slice(3), 1, 2)] == [[0, 1, 2], [0]]


def test_summaries_bound_every_count(spark):
    rows = adversaries()["zipf"]
    truth = Counter(t for r in rows for t in r)
    df = lists(spark, rows, 40)
    hashes, bound = summary(df, F.col("terms"), 50)
    assert len(hashes) <= 50 and 0 < bound <= sum(truth.values()) / 51
    codes = {r.t: r.h for r in df.select(F.explode("terms").alias("t")).distinct().select("t", F.xxhash64("t").alias("h")).collect()}
    assert all(n <= bound for t, n in truth.items() if codes[t] not in set(hashes))


def test_reduced_keeps_the_largest():
    hashes, counts, taken = reduced(np.array([1, 2, 3, 1, 4]), np.array([5, 2, 1, 1, 2]), 2)
    assert (hashes.tolist(), counts.tolist(), taken) == ([1], [4], 2)


@pytest.mark.parametrize("bits", [6, 8, 12, 20])
def test_recurring_terms_keep_every_occurrence(spark, bits):
    draw = random.Random(bits)
    rows = [[f"r{min(int(draw.paretovariate(0.7)), 900)}" for _ in range(draw.randrange(30))] for _ in range(120)]
    rows += [None, [], [None, "only", "only", None], ["last"]]
    df = lists(spark, rows, 5)
    docs = Counter(t for r in rows if r for t in set(r) if t is not None)
    out = {r.id: r.terms for r in without_single_terms(df, bits=bits).collect()}
    dropped = 0
    for i, r in enumerate(rows):
        if r is None:
            assert out[i] is None
            continue
        again = iter(r)
        assert all(any(t == x for x in again) for t in out[i])  # in order
        for t in set(filter(None, r)):
            kept = out[i].count(t)
            assert kept == r.count(t) if docs[t] > 1 else kept in (0, r.count(t))
            dropped += kept == 0
    assert dropped > 0 or bits < 12
    words = recurring(df, bits=bits)
    assert words.dtype == np.dtype("<i8") and len(words) == (1 << bits) // 64
    plan = without_single_terms(df, bits=20)._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan


def test_vocabulary_is_the_same_without_single_terms(spark):
    draw = random.Random(9)
    rows = [[f"v{min(int(draw.paretovariate(0.6)), 3000)}" for _ in range(30)] for _ in range(150)]
    df = lists(spark, rows)
    for config in (FeatureConfig(), FeatureConfig(min_df=3, max_features=40), FeatureConfig(min_df=1)):
        want, got = (sorted(map(tuple, fit_vocabulary(df, config, spare_singles=s).collect())) for s in (False, True))
        assert got == want and len(got) > 10


@pytest.mark.parametrize("k", [1, 7, 5000])
def test_top_rows_of_a_hot_group(spark, k):
    draw = random.Random(k)
    rows = [("hot" if i % 3 else f"g{i % 9}", draw.randrange(50), f"t{i}") for i in range(20_000)] + [(None, 1, "x")]
    df = spark.createDataFrame(rows, "label string, n int, term string").repartition(8)
    got = top_per_group(df, ["label"], [F.desc("n"), F.col("term")], "term", k, buckets=4)
    assert got.columns == df.columns
    want = []
    for label in {r[0] for r in rows}:
        want += sorted((r for r in rows if r[0] == label), key=lambda r: (-r[1], r[2].encode()))[:k]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    # The first ranking's key has the bucket, so no task sorts a whole label.
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 2 and "[label#" in plan and ", __bucket#" in plan


def test_class_terms_beyond_the_group_limit(spark):
    draw = random.Random(1)
    texts = [(" ".join(f"w{draw.randrange(4000)}x" for _ in range(30)), draw.choice(["a", "b", None])) for _ in range(300)]
    df = spark.createDataFrame(texts, "clean_review string, sentiment string")
    out = class_term_freq(df, k=1500).collect()
    for label in "ab":
        counts = Counter(w for t, s in texts if s == label for w in t.split())
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:1500]
        assert sorted((r.term, r.n) for r in out if r.sentiment == label) == sorted(want)


@pytest.mark.parametrize("base", [0, 10**9, 10**12])
def test_deviation_of_values_far_from_zero(spark, base):
    draw = np.random.default_rng(2)
    values = (base + draw.integers(0, 40, 300)).tolist()
    counts = spark.createDataFrame(sorted(Counter(values).items()), "value long, n long")
    got = describe(counts.repartition(3)).first()
    assert got.std == pytest.approx(np.std([v - base for v in values], ddof=1), abs=0.006)
    assert got["mean"] == pytest.approx(np.mean(values), abs=0.006) and got["count"] == 300
    alone = describe(counts.limit(1).withColumn("n", F.lit(1))).first()
    assert alone.std is None
