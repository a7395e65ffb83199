import math
from collections import Counter

import numpy as np
import pytest

from opinara.config import FeatureConfig
from opinara.functions.tokens import with_terms
from opinara.operators.features import TermModel, fit_vocabulary, term_counts, term_statistics, vector_entries, vocab_join
from opinara.operators.labels import check_labels, class_weights, with_class_weights
from opinara.operators.naive_bayes import LinearClassifier, fit_naive_bayes

TEXTS = ["amber lantern near it", "rusty lantern under it it", "an iron lantern upstairs", "", "zz"]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id bigint, clean_review string")


def brute_weights(texts, config, fit_on=None):
    lists = [[w for w in t.split() if len(w) > 1] for t in texts]
    fit_lists = lists if fit_on is None else [lists[i] for i in fit_on]
    df = Counter(w for ws in fit_lists for w in set(ws))
    cf = Counter(w for ws in fit_lists for w in ws)
    kept = [w for w in df if config.min_df <= df[w] <= config.max_df * len(fit_lists)]
    kept = sorted(kept, key=lambda w: (-cf[w], w))[: config.max_features]
    idf = {w: math.log((1 + len(fit_lists)) / (1 + df[w])) + 1 for w in kept}
    found = {}
    for i, words in enumerate(lists):
        raw = {w: (1 + math.log(n) if config.sublinear_tf else n) * idf[w] for w, n in Counter(words).items() if w in idf}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        found.update({(i, w): v / norm for w, v in raw.items()})
    return found


@pytest.mark.parametrize("sublinear", [True, False])
@pytest.mark.parametrize("max_features", [500, 3])
def test_tfidf_equals_brute_force(docs, sublinear, max_features):
    config = FeatureConfig(ngram_range=(1, 1), min_df=1, max_df=1.0, sublinear_tf=sublinear, max_features=max_features)
    rows = TermModel.fit(docs, config).weights(docs).collect()
    want = brute_weights(TEXTS, config)
    assert {(r.id, r.term) for r in rows} == set(want)
    for r in rows:
        assert r.weight == pytest.approx(want[(r.id, r.term)], abs=1e-12)


@pytest.mark.parametrize("strategy", ["tfidf", "count", "tfidf_char"])
def test_strategies_keep_every_row(docs, strategy):
    config = FeatureConfig(strategy=strategy, max_features=500, min_df=1, max_df=1.0)
    model = TermModel.fit(docs, config)
    vectors = {r.id: r.features for r in model.transform(docs).collect()}
    assert len(vectors) == len(TEXTS) and vectors[3].numNonzeros() == 0
    assert all(v.size == len(model.vocabulary) for v in vectors.values())
    if strategy != "count":
        assert vectors[0].norm(2) == pytest.approx(1.0)


def test_transform_is_row_by_row(docs):
    model = TermModel.fit(docs, FeatureConfig(min_df=1, max_df=1.0))
    assert "Exchange" not in model.transform(docs)._jdf.queryExecution().executedPlan().toString()


def test_document_bounds_as_counts_and_shares(docs):
    def kept(**options):
        config = FeatureConfig(ngram_range=(1, 1), **options)
        return {r.term for r in fit_vocabulary(with_terms(docs, "clean_review", config), config).collect()}

    assert kept(min_df=2, max_df=1.0) == {"lantern", "it"}
    assert kept(min_df=2, max_df=0.5) == {"it"}
    assert kept(min_df=1, max_df=1) == {"amber", "near", "rusty", "under", "an", "iron", "upstairs", "zz"}
    assert kept(min_df=0.5, max_df=1.0) == {"lantern"}


def test_ties_at_the_cap_go_by_term(docs):
    config = FeatureConfig(ngram_range=(1, 1), min_df=1, max_df=1.0, max_features=4)
    rows = fit_vocabulary(with_terms(docs, "clean_review", config), config).collect()
    assert {r.term: r.idx for r in rows} == {"amber": 0, "an": 1, "it": 2, "lantern": 3}


def test_statistics_and_vocabulary_join(docs):
    config = FeatureConfig(ngram_range=(1, 1), min_df=2, max_df=1.0)
    terms = with_terms(docs, "clean_review", config)
    stats = {r.term: (r.df, r.cf) for r in term_statistics(terms).collect()}
    assert stats["it"] == (2, 3) and stats["lantern"] == (3, 3) and stats["zz"] == (1, 1)
    joined = vocab_join(term_counts(terms), fit_vocabulary(terms, config)).collect()
    assert {(r.id, r.term, r.n) for r in joined} == {(0, "it", 1), (1, "it", 2), (0, "lantern", 1), (1, "lantern", 1), (2, "lantern", 1)}


def test_fit_reads_training_rows_only(docs):
    train = docs.where("id in (0, 2)")
    config = FeatureConfig(ngram_range=(1, 1), min_df=1, max_df=1.0)
    model = TermModel.fit(train, config)
    assert not {"rusty", "under", "zz"} & set(model.vocabulary)
    want = brute_weights(TEXTS, config, fit_on=[0, 2])
    got = {(r.id, r.term): r.weight for r in model.weights(docs).collect()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(want[k]) for k in got)


def test_save_and_load(spark, docs, tmp_path):
    model = TermModel.fit(docs, FeatureConfig(min_df=1, max_df=1.0))
    model.save(spark, str(tmp_path / "terms"))
    assert TermModel.load(spark, str(tmp_path / "terms")) == model


def brute_bayes(matrix, labels, alpha, weights=None):
    weights = np.ones(len(labels)) if weights is None else weights
    logs, prior = [], []
    for c in (0, 1):
        rows = labels == c
        mass = (matrix[rows] * weights[rows, None]).sum(axis=0) + alpha
        logs.append(np.log(mass) - np.log(mass.sum()))
        prior.append(math.log(weights[rows].sum()))
    return logs[1] - logs[0], prior[1] - prior[0]


@pytest.mark.parametrize("weighted", [False, True])
def test_naive_bayes_equals_brute_force(spark, docs, weighted, tmp_path):
    labels = np.array([1.0, 0.0, 1.0, 1.0, 0.0])
    config = FeatureConfig(strategy="count", ngram_range=(1, 1), min_df=1, max_df=1.0)
    terms = TermModel.fit(docs, config)
    coded = docs.join(spark.createDataFrame([(i, float(v)) for i, v in enumerate(labels)], "id bigint, label double"), "id")
    rows = terms.transform(coded)
    if weighted:
        rows = with_class_weights(rows, out="row_weight")
    model = fit_naive_bayes(rows, len(terms.vocabulary), 1.0, weight="row_weight" if weighted else None)
    dense = {r.id: r.features.toArray() for r in rows.collect()}
    matrix = np.array([dense[i] for i in range(len(TEXTS))])
    balance = np.where(labels == 1, 5 / (2 * 3), 5 / (2 * 2)) if weighted else None
    slope, intercept = brute_bayes(matrix, labels, 1.0, balance)
    assert np.allclose(model.weights, slope) and model.intercept == pytest.approx(intercept)
    model.save(spark, str(tmp_path / "nb"))
    again = LinearClassifier.load(spark, str(tmp_path / "nb"))
    margins = matrix @ slope + intercept
    for r in again.score(rows).collect():
        assert r.score == pytest.approx(1 / (1 + math.exp(-margins[r.id])))
        assert r.prediction == float(margins[r.id] > 1e-9)


def test_class_weights_and_labels(spark):
    rows = spark.createDataFrame([(1.0,)] * 3 + [(0.0,)], "label double")
    assert {r.label: r.weight for r in class_weights(rows).collect()} == {1.0: 4 / 6, 0.0: 2.0}
    assert with_class_weights(rows).selectExpr("sum(weight)").first()[0] == pytest.approx(4.0)
    unlabelled = spark.createDataFrame([(1.0,), (0.0,), (None,), (None,), (None,)], "label double")
    assert {r.label: r.weight for r in class_weights(unlabelled).collect()} == {1.0: 1.0, 0.0: 1.0}
    with pytest.raises(ValueError, match="unknown label code 2.0"):
        with_class_weights(spark.createDataFrame([(1.0,), (0.0,), (2.0,)], "label double"))
    with pytest.raises(ValueError, match="mixed"):
        check_labels(spark.createDataFrame([("mixed",)], "sentiment string"))


def test_entries_skip_empty_rows(docs):
    vectors = TermModel.fit(docs, FeatureConfig(min_df=1, max_df=1.0)).transform(docs)
    assert 3 not in {r.id for r in vector_entries(vectors, "id").collect()}
