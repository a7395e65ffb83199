import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm.hard_negatives import OP13_SQL, Best, MiningConfig, mine_hard_negatives, op13_hard_negatives

SCHEMA = "vec_id long, embedding array<float>, label int, anchor string, rank string, block string, __key string"
SMALL = MiningConfig(anchor_rows=5, block_rows=7, slice_blocks=2)


def vectors(n=400, seed=13):
    draw = np.random.default_rng(seed)
    hot = draw.normal(size=8).astype(np.float32)
    rows = []
    for i in range(n):
        v = (hot if i % 3 == 0 else draw.normal(size=8) * draw.choice([0.3, 1.0])).astype(np.float32).tolist()
        rows.append((i, v, int(draw.choice([0, 0, 0, 1, 2, 3])), "a", "r", "b", "k"))
    rows[5] = (5, None, 1, "", "", "", "")
    rows[50] = (50, rows[50][1], None, "", "", "", "")
    rows[7] = (7, [*rows[7][1][:7], None], 1, "", "", "", "")
    rows[100] = (100, [float("nan")] * 8, 1, "", "", "", "")
    rows[9] = (9, [float("inf")] * 8, 1, "", "", "", "")
    rows[11] = (11, [], 2, "", "", "", "")
    rows[12] = (12, [0.5, 0.25], 2, "", "", "", "")
    return rows


def brute(rows, is_anchor, positives=5, negatives=3):
    usable = []
    for i, v, label, *_ in rows:
        if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v], label))
    out = []
    for a, (i, v, label) in enumerate(usable):
        if not is_anchor(i):
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, l) for b, (j, w, l) in enumerate(usable) if a != b)
        for p, j, _ in [s for s in scored if s[2] == label][:positives]:
            fit = [(s, k) for s, k, l in scored if l != label and 50 * -p <= 100 * -s <= 95 * -p]
            out += [(i, j, r + 1, k, -p, -s) for r, (s, k) in enumerate(fit[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("config", [MiningConfig(), SMALL, MiningConfig(positives=40, negatives=1, anchor_rows=3, block_bytes=200)])
def test_equals_brute_force(spark, config):
    rows = vectors()
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    got = sorted(map(tuple, mine_hard_negatives(df, F.col("vec_id") % 10 == 0, config).collect()))
    assert got == brute(rows, lambda i: i % 10 == 0, config.positives, config.negatives)
    assert len(got) > 100


def test_query_equals_sql(spark, tmp_path):
    rows = vectors(700, 3)
    spark.createDataFrame(rows, SCHEMA).select("vec_id", "embedding", "label").write.parquet(str(tmp_path / "embeddings.parquet"))
    db = duckdb.connect()
    # DuckDB multiplies lists of one length only.
    db.execute(
        f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')"
        " WHERE embedding IS NULL OR len(embedding) = 8"
    )
    theirs = db.execute(OP13_SQL)
    ours = op13_hard_negatives(spark, str(tmp_path))
    assert sorted(d[0] for d in theirs.description) == sorted(ours.columns)
    names = [d[0] for d in theirs.description]
    short = {11, 12}
    got = sorted(tuple(r[c] for c in names) for r in ours.collect())
    assert sorted(theirs.fetchall()) == [r for r in got if not short & {r[1], r[3]}] and len(got) > 50


def test_large_components_stay_exact(spark):
    draw = random.Random(5)
    rows = [(i, [float(draw.randrange(-60_000, 60_000)) for _ in range(12)], i % 2, "", "", "", "") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(map(tuple, mine_hard_negatives(df, F.col("vec_id") < 9, SMALL).collect()))
    assert got == brute(rows, lambda i: i < 9) and max(r[4] for r in got) > 1 << 45
    huge = df.withColumn("embedding", F.transform("embedding", lambda x: x * 1e30))
    assert mine_hard_negatives(huge, F.col("vec_id") < 9, SMALL).count() > 0


def test_repeated_null_and_no_rows(spark):
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [1.0, 0.0], 0), (2, [0.75, 0.0], 1), (2, [0.75, 0.0], 1), (None, [0.75, 0.0], 1)]
    df = spark.createDataFrame([(*r, "", "", "", "") for r in rows], SCHEMA)
    found = mine_hard_negatives(df, F.col("vec_id") == 1)
    # Both anchors have the other row of their id and the null id as positives.
    got = sorted(map(str, map(tuple, found.collect())))
    want = [(1, p, r, n, 65536, 49152) for p in (None, 1) for r, n in ((1, None), (2, 2), (3, 2))] * 2
    assert got == sorted(map(str, want))
    assert got == sorted(map(str, map(tuple, mine_hard_negatives(df.repartition(3), F.col("vec_id") == 1).collect())))
    for none in (df.limit(0), df.where("label = 0"), df.where("vec_id is null")):
        assert mine_hard_negatives(none, F.col("vec_id") == 1).count() == 0
    assert mine_hard_negatives(df, F.lit(None).cast("boolean")).columns == found.columns


def test_best_keeps_ties_by_key():
    scores = np.array([[5, 5, 5, 5, 9, 1]])
    best = Best(np.array([[9, 6]]), np.array([[0, 0]]), 2)
    best.add(scores, np.ones_like(scores, bool), np.array([10, 11, 12, 13, 14, 15]))
    best.add(scores, np.ones_like(scores, bool), np.array([1, 2, 3, 4, 5, 6]))
    assert [(s.tolist(), k.tolist()) for _, s, k in best.kept] == [([9, 9], [5, 14]), ([5, 5], [1, 2])]
