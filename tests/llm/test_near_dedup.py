import random

import numpy as np
from pyspark.sql import functions as F

from opinara.llm.components import components
from opinara.llm.near_dedup import (
    BLOCK, NearConfig, Sketcher, keep_one_of_each_family, near_components, residual_pairs, set_of,
    set_sketch, surely,
)
from opinara.llm.shingles import WordCodes

SCHEMA = "doc_id long, text string, kept string, key string, bands string"


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    width = min(width, len(words))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


def brute(rows):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    return sorted((i, len(sets[i]), top(i), top(i) == i) for i in ids)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "x", "y", "z") for i, t in rows], SCHEMA)
    out = near_components(df).select("doc_id", "n_shingles", "component_id", "kept").collect()
    return sorted(tuple(r) for r in out)


def changed(draw, words, times):
    words = list(words)
    for _ in range(times):
        words[draw.randrange(len(words))] = f"new{draw.randrange(10**6)}"
    return words


def test_families_chains_and_edges(spark):
    draw = random.Random(3)
    fresh = lambda n: [f"w{draw.randrange(5000)}" for _ in range(n)]
    texts = [None, "", " \n", "one", "ONE", "one two", "one two three four", "One Two Three Four ", "a b c d e"]
    for size in (30, 120, 400):
        base = fresh(size)
        for _ in range(12):
            texts.append(" ".join(changed(draw, base, draw.randrange(0, size // 12))))
        chain = fresh(size)
        for _ in range(6):
            chain = changed(draw, chain, max(1, size // 50))
            texts.append(" ".join(chain))
    shared = fresh(150)
    texts += [" ".join(shared + fresh(100)) for _ in range(40)]
    texts += [" ".join(fresh(60)) for _ in range(30)] + ["very long " * 5000, "Very long " * 5000]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    assert run(spark, rows) == brute(rows)


def test_blocks_find_close_pairs_across_components(spark):
    """A bucket larger than a block: a family, and two of its members that no star has joined."""
    config, codes = NearConfig(), WordCodes()
    sketcher = Sketcher(config)
    texts = [" ".join(f"b{i}" for i in range(200)) + f" end{n}" for n in range(BLOCK + 60)]
    sets = [set_of(t, codes, config.width) for t in texts]
    samples = [sketcher.samples(x) for x in sets]
    bands = [sketcher.bands(x).tolist() for x in samples]
    shared = next(b for n, b in enumerate(bands[-1]) if sum(x[n] == b for x in bands) > BLOCK)
    inside = [n for n, x in enumerate(bands) if shared in x]
    reps = [(n, len(sets[n]), sketcher.sketch(samples[n]).tolist(), bands[n], set_sketch(sets[n])) for n in inside]
    members = spark.createDataFrame([(shared, inside[0], len(inside), n) for n in inside], "bucket long, center long, size long, key long")
    x, y = inside[-2:]
    labels = spark.createDataFrame([(n, inside[0]) for n in inside[1:-2]], "u long, v long")
    schema = "key long, n_shingles long, sketch array<long>, bands array<long>, whole binary"
    found = {tuple(r) for r in residual_pairs(members, labels, spark.createDataFrame(reps, schema), config).collect()}
    assert found and {b for _, b in found} <= {x, y}
    assert len(found) < 3 * (len(inside) // BLOCK + 2)


def test_set_sketches_tell_similar_sets():
    draw = np.random.default_rng(9)
    for size in (3, 40, 500, 9000):
        for alike in (0.3, 0.7, 0.79, 0.81, 0.9, 1.0):
            both = round(size * alike)
            base = draw.integers(0, 2**63, 2 * size, dtype=np.uint64)
            a = np.concatenate([base[:both], base[size : size + (size - both) // 2]])
            b = np.concatenate([base[:both], base[2 * size - (size - both - (size - both) // 2) :]])
            similar = 100 * both >= 80 * (len(a) + len(b) - both)
            verdict = surely(set_sketch(a), set_sketch(b), len(a) + len(b), 80)
            assert verdict == 0 or (verdict > 0) == similar
            assert size < 500 or 0.75 < alike < 0.85 or verdict


def test_set_sketches_never_refuse_similar_sets():
    draw = np.random.default_rng(4)
    refused = 0
    for _ in range(4000):
        size, apart = int(draw.integers(5, 120)), float(draw.uniform(0, 0.5))
        pool = draw.integers(0, 2**63, 2 * size, dtype=np.uint64)
        a = pool[:size]
        b = np.concatenate([a[: size - int(apart * size)], pool[size : size + int(draw.integers(0, int(apart * size) + 1))]])
        both = len(np.intersect1d(a, b))
        similar = 100 * both >= 80 * (len(a) + len(b) - both)
        verdict = surely(set_sketch(a), set_sketch(b), len(a) + len(b), 80)
        assert not (similar and verdict < 0) and not (verdict > 0 and not similar)
        refused += verdict < 0
    assert refused > 1000


def test_repeated_rows_null_ids_and_empty_table(spark):
    t = "a b c d e f g h"
    rows = [(1, t), (1, t), (None, t), (2, "q r s t u"), (None, None)]
    df = spark.createDataFrame([(i, x, "", "", "") for i, x in rows], SCHEMA)
    out = near_components(df).collect()
    assert len(out) == 5 and sum(r.kept for r in out) == 3
    kept = keep_one_of_each_family(spark, df, "")
    assert kept.columns == df.columns and kept.count() == 3
    assert near_components(df.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(5)
    pairs = [(i, i + 1) for i in range(60)] + [(100, draw.randrange(101, 300)) for _ in range(80)] + [(400, 401), (401, 400), (7, 7)]
    out = {r.u: r.v for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert all(out[i] == 0 for i in range(1, 61)) and out[401] == 400
    assert all(v == 100 for u, v in out.items() if 100 < u < 300)
    assert components(spark.createDataFrame([], "a long, b long")).agg(F.count("*")).first()[0] == 0
