import random
from collections import Counter

import pyarrow as pa
import pytest

from opinara.config import FeatureConfig
from opinara.functions.rows import slices
from opinara.functions.tokens import char_wb_ngrams, with_terms, with_tokens
from opinara.operators import term_batches
from opinara.operators.features import TermModel, fit_vocabulary, term_statistics

DRAW = random.Random(3)
TEXTS = [" ".join(DRAW.choice(["ab", "cd", "éf", "日本語", "a", "lantern"]) for _ in range(DRAW.randrange(9))) for _ in range(40)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([*enumerate([*TEXTS, ""]), (99, None)], "id bigint, text string").repartition(3)


@pytest.mark.parametrize("low, high", [(1, 1), (1, 2), (2, 3), (3, 3)])
@pytest.mark.parametrize("most", [5, 1000])
def test_slices_count_every_run_of_tokens(monkeypatch, low, high, most):
    monkeypatch.setattr(term_batches, "SLICE_TERMS", most)
    lists = [text.split() for text in TEXTS] + [None, []]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.string()))], ["tokens"])
    df, cf = Counter(), Counter()
    for found in term_batches.counted_terms(FeatureConfig(ngram_range=(low, high)))(iter([batch])):
        for term, in_rows, times in zip(*[c.to_pylist() for c in found.columns]):
            df[term] += in_rows
            cf[term] += times
    grams = [[" ".join(t[i : i + n]) for n in range(low, high + 1) for i in range(len(t) - n + 1)] for t in lists if t]
    assert cf == Counter(g for row in grams for g in row)
    assert df == Counter(g for row in grams for g in set(row))


def test_a_slice_is_bounded_but_for_one_long_row():
    lists = pa.array([["x"] * n for n in (3, 3, 3, 50, 1, 0, 2)])
    assert [len(part.flatten()) for part in slices(lists, 7)] == [6, 3, 50, 3]


def test_windows_of_words_of_any_script(spark):
    words = ["a", "éa", "日本語テキスト", "😀x", "lantern", "a"]
    df = spark.createDataFrame([(0, " ".join(words)), (1, ""), (2, None)], "id int, text string")
    rows = dict(df.select("id", char_wb_ngrams(df.text)).collect())
    padded = [f" {word} " for word in words]
    assert rows[0] == [p[i : i + n] for p in padded for n in range(3, min(5, len(p)) + 1) for i in range(len(p) - n + 1)]
    assert rows[1] == [] and rows[2] is None


@pytest.mark.parametrize("config", [FeatureConfig(max_df=1.0), FeatureConfig(strategy="tfidf_char", max_df=1.0)])
def test_terms_made_in_tasks_are_those_of_the_rows(docs, config):
    listed, made = with_terms(docs, "text", config), with_tokens(docs, "text", config)
    assert sorted(term_statistics(listed).collect()) == sorted(term_statistics(made, "tokens", config).collect())
    want = sorted(fit_vocabulary(listed, config).collect())
    for spare in (False, True):
        assert want == sorted(fit_vocabulary(made, config, "tokens", spare, of_tokens=True).collect())


def test_vectors_are_built_without_a_detour(docs):
    """Vectors went through JSON text, and every n-gram through a row of its own."""
    model = TermModel.fit(docs, FeatureConfig(max_df=1.0), "text")
    plan = model.transform(docs, "text")._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "zip_with" not in plan
    assert sum(r.features.numNonzeros() == 0 for r in model.transform(docs, "text").collect()) >= 2


def test_a_stream_gets_the_same_vectors_by_projections(spark, docs, tmp_path):
    rows, out = docs.where("text is not null"), str(tmp_path / "out")
    rows.write.parquet(str(tmp_path / "in"))
    model = TermModel.fit(docs, FeatureConfig(max_df=1.0), "text")
    stream = model.transform(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "text")
    sink = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "checkpoint"))
    sink.trigger(availableNow=True).start().awaitTermination()
    found = {r.id: r.features.toArray() for r in spark.read.parquet(out).collect()}
    want = {r.id: r.features.toArray() for r in model.transform(rows, "text").collect()}
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i]) for i in want)
