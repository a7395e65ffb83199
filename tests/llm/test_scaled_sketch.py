import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from opinara.llm import scaled_sketch
from opinara.llm.scaled_sketch import (
    SketchConfig,
    containment,
    fingerprints,
    likeness,
    merged,
    read,
    sketch,
    sketch_neighbours,
    written,
)
from opinara.llm.shingles import WordCodes

SCHEMA = "doc_id long, text string, part string, fingerprint string, first_text string"
VOCABULARY = [f"w{i}" for i in range(3000)]


def shingles(text, width=5):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def drawn_text(draw, words):
    return draw.choice([" ", "\n", "  "]).join(draw.choices(VOCABULARY, k=words))


def table(n=240):
    draw = random.Random(11)
    texts = [None, "", " \n\t", "one", "one two", "One TWO", "é\U0001f600 x", drawn_text(draw, 30_000), "q" * 100_000]
    while len(texts) < n:
        texts.append(draw.choice([drawn_text(draw, draw.randrange(1, 400)), draw.choice(texts), "the same text again and once more"]))
    draw.shuffle(texts)
    return [(7 * i + 3, t, "part", "f", "x") for i, t in enumerate(texts)]


def test_neighbours_against_brute_force(spark):
    rows = table()
    out = {r.doc_id: r for r in sketch_neighbours(spark.createDataFrame(rows, SCHEMA).repartition(5, F.rand(1))).collect()}
    assert len(out) == len(rows)
    down = sorted(rows, reverse=True, key=lambda r: r[0])
    by_text, errors = {}, []
    for (i, text, *_), (_, following, *_) in zip(down, down[1:] + down[:1]):
        text, following = text or "", following or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        got = out[i]
        assert (got.n_chars, got.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert by_text.setdefault(text, got.fingerprint) == got.fingerprint
        codes = WordCodes()
        own, made, after = (sketch(t, codes) for t in (text, new, following))
        assert (got.fingerprint, got.edited_fingerprint) == (written(own), written(made))
        assert got.near_edited == likeness(own, made) and got.near_next == likeness(own, after)
        assert got.contained_edited == containment(own, made)
        for estimate, other in ((got.near_edited, new), (got.near_next, following)):
            a, b = shingles(text), shingles(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            if len(a | b) >= 100:
                errors.append(abs(estimate - exact))
            if a == b:
                assert estimate == 1.0
    assert np.mean(errors) < 0.05 and max(errors) < 0.35


def test_result_does_not_depend_on_partitions(spark):
    rows = table(60)
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted(map(tuple, sketch_neighbours(df).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for width in ("1", "97"):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            assert sorted(map(tuple, sketch_neighbours(df).collect())) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_sketches_merge_and_tell_containment():
    draw, codes = random.Random(2), WordCodes()
    config = SketchConfig()
    small, large = drawn_text(draw, 3000), drawn_text(draw, 60_000)
    both = large + " " + small
    a, b = sketch(small, codes), sketch(both, codes)
    assert containment(a, b) == 1.0 and likeness(a, b) < 0.1
    assert abs(containment(sketch(small + " " + drawn_text(draw, 3000), codes), b) - 0.5) < 0.06
    # Five words that join the halves are shingles of neither.
    joined = large.split()[-4:] + small.split()[:4]
    parts = [sketch(large, codes), a, sketch(" ".join(joined), codes)]
    assert (merged(parts) == b).all()
    assert (read(written(b)) == b).all() and written(read("")) == ""
    tiny = [sketch(t, codes) for t in ("a", "b", "a b c d e f")]
    assert all(len(t) >= 1 for t in tiny)
    assert len(merged(tiny)) >= 1 and (merged([merged(tiny[:2]), tiny[2]]) == merged(tiny)).all()
    assert (np.diff(b.astype(np.int64)) > 0).all() and b.max() < config.bound


@pytest.mark.parametrize("words", [1, 5, 7, 20, 21, 23, 24, 41])
def test_blocks_give_the_sketch_of_the_whole(monkeypatch, words):
    text = drawn_text(random.Random(words), words)
    config = SketchConfig(scale=2)
    whole = sketch(text, WordCodes(), config)
    monkeypatch.setattr(scaled_sketch, "BLOCK_WORDS", 10)
    assert (sketch(text, WordCodes(), config) == whole).all()


def test_repeated_null_and_no_rows(spark):
    rows = [(1, "a b c d e f", "", "", ""), (1, "a b c d e f", "", "", ""), (None, None, "", "", ""), (None, "x", "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    first, again = (sorted(map(str, sketch_neighbours(d).collect())) for d in (df, df.repartition(3)))
    assert len(first) == 4 and first == again
    one = sketch_neighbours(df.where("text = 'x'")).first()
    assert (one.n_chars, one.near_next, one.near_edited, one.doc_id) == (1, 1.0, 1.0, None)
    assert sketch_neighbours(df.limit(0)).count() == 0 and fingerprints(df.limit(0)).count() == 0
    assert sorted(r.fingerprint for r in fingerprints(df).collect())[0] == ""
