import random
import zlib

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from opinara.llm.tokens import vocabulary_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    """Rows, and the ids that the first three stages leave: the last copy, then the first near copy."""
    draw = random.Random(11)
    common = "the of and to in a is that it for".split()
    sentence = lambda: " ".join(f"{draw.choice(common)} w{draw.randrange(9000)}a" for _ in range(4))
    rows, left = [], {}

    def add(text, stays):
        i = len(rows)
        rows.append((i, text, "en", f"s{i % 3}" if i % 10 else None, len(text or "")))
        if stays:
            left[i] = text

    for n in range(40):
        text = ".\n".join(sentence() for _ in range(draw.randrange(12, 40)))
        if n % 4 == 0:
            add(text, False)
            add(text, True)
        elif n % 4 == 1:
            add(text, True)
            add("Another " + text.split(" ", 1)[1], False)
        else:
            add(text, True)
    add("too short", False)
    add(None, False)
    add(" ".join(f"{w}###%%%" for w in left[1].split()), False)
    add("say it again " * 60, False)
    return rows, left


def test_stages_take_effect_one_after_another(spark, tmp_path):
    rows, left = corpus()
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "exact_dedup", "near_dedup", "source_mixing", "best_fit_packing"]
    docs = corpus_pipeline.documents(spark, str(tmp_path))
    kept = []
    for n, (_, apply) in enumerate(corpus_pipeline.STAGES[:-1]):
        docs = apply(spark, docs, str(tmp_path))
        assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        docs.write.parquet(str(tmp_path / f"out{n}"))
        docs = spark.read.parquet(str(tmp_path / f"out{n}"))
        kept.append(sorted(r.doc_id for r in docs.select("doc_id").collect()))
    assert kept[2] == sorted(left)
    assert set(kept[0]) > set(kept[1]) > set(kept[2]) >= set(kept[3])
    assert all(kept[3].count(i) <= 3 for i in left)
    size = {i: len(t.split()) for i, t in left.items()}
    assert abs(sum(size[i] for i in kept[3]) - sum(size.values())) <= 4 * max(size.values())

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokenizer = Tokenizer.from_file(vocabulary_path())
    pieces = sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out)
    want = []
    for i in kept[3]:
        ids = [*tokenizer.encode(left[i], add_special_tokens=False).ids, 2]
        cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
        want += [
            (i, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    assert pieces == sorted(want)
    fills = {}
    for r in out:
        fills[r.sequence_id] = fills.get(r.sequence_id, 0) + r.length
    assert max(fills.values()) <= 1024
    # No two sequences could be one.
    first, second = sorted(fills.values())[:2]
    assert first + second > 1024


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
