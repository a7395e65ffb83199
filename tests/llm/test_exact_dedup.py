import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm.exact_dedup import _words, build_levels, exact_dedup, find_slots, keep_first_copies

SCHEMA = "doc_id long, text string, keep_id string, digest string"


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    return sorted(
        (i, max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g
    )


def run(spark, rows, **kwargs):
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = exact_dedup(df, **kwargs)
    return sorted(tuple(r) for r in out.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_every_slot_is_taken_once_and_strangers_are_told_apart():
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    words = _words(digests)
    sizes, bits = build_levels(words)
    assert sorted(find_slots(words, sizes, bits)) == list(range(3000))
    assert bits.sum() == 3000


@pytest.mark.parametrize("split", [None, True, False])
def test_groups(spark, split):
    texts = ["a", None, "", "a", "b", "long " * 20_000, "a", "c", "long " * 20_000, "A", "d", "b"]
    rows = list(enumerate(texts))
    kwargs = {} if split is None else {"is_history": F.lit(split)}
    assert run(spark, rows, **kwargs) == expected(rows)


def test_hot_group(spark):
    rows = [(i, "same" if i % 3 == 0 else str(i)) for i in range(900)]
    assert run(spark, rows) == expected(rows)


def test_repeated_rows_and_null_ids_keep_one(spark):
    rows = [(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, "c"), (2, "d")]
    df = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    out = exact_dedup(df).collect()
    assert len(out) == 6
    kept = sorted((r.keep_id or 0, r.group_size) for r in out if r.kept)
    assert kept == [(0, 1), (1, 3), (2, 1), (2, 1)]
    assert keep_first_copies(spark, df, "").count() == 4


def test_empty_table(spark):
    assert run(spark, []) == []


def test_index_is_compact():
    words = _words([hashlib.sha256(str(i).encode()).digest() for i in range(5000)])
    sizes, bits = build_levels(words)
    assert len(bits) < 4 * 5000
    assert np.all(find_slots(_words([hashlib.sha256(b"x%d" % i).digest() for i in range(50)]), sizes, bits) < 5000)
