"""Every operator as a query over the given tables: name -> function(spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.config import CleaningConfig, FeatureConfig, TrainingConfig
from opinara.functions import text as x
from opinara.functions.rows import element_rows
from opinara.functions.numeric import round_half_up
from opinara.functions.tokens import char_wb_ngrams, with_terms, with_tokens, word_ngrams, word_tokens
from opinara.operators import evaluation as ev
from opinara.operators import profiling as p
from opinara.operators.classifiers import fit_linear_svm, model_fitter
from opinara.operators.cleaning import clean_table, empty_after_clean, stopword_antijoin
from opinara.operators.features import (
    TermModel,
    fit_vocabulary,
    term_counts,
    term_statistics,
    vector_entries,
    vocab_join,
)
from opinara.operators.labels import class_weights, decode_label, encode_label, with_class_weights
from opinara.operators.lemmas import corpus_lexicon, lemma_table, term_frequencies
from opinara.operators.naive_bayes import fit_naive_bayes
from opinara.operators.sampling import sample_reviews, stratified_split, stratified_subset
from opinara.plans.evaluate import evaluate, held_out_predictions
from opinara.plans.prepare import prepare
from opinara.plans.profile import profile, profile_report
from opinara.plans.score import Scorer, champion, load_scorer, predict_batch, preview, score, score_table
from opinara.plans.train import clean_splits, feature_table, predictions, run_job, save, train, train_all
from opinara.sources import reviews as src
from opinara.sources.sinks import write_result
from opinara.sources.splits import load_splits, write_splits
from opinara.staging import stage, staging_path
from opinara.streaming.scoring import start_scoring

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

#: Cleaning of the queries: the defaults, lemmas included.
CLEANING = CleaningConfig()
WORDS = FeatureConfig()
COUNTS = FeatureConfig(strategy="count")
CHARS = FeatureConfig(strategy="tfidf_char")
BAYES = TrainingConfig(cleaning=CLEANING, active_models=("multinomial_nb",))

#: Rows the subset query draws; the whole table if it has no more.
SUBSET_ROWS = 200


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


#: Tables with texts, whose rows are worth dealing out.
TEXT_TABLES = ("documents", "pages", "conversations")


#: A table of texts up to this size may lie in one row group, which is one task however it is split.
DEALT_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table; a small one with texts is dealt out to the cores, so what moves is bounded.

    Any larger table is read as its files and row groups are split.
    """
    df = spark.read.parquet(f"{folder}/{name}.parquet")
    if name in TEXT_TABLES and int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= DEALT_BYTES:
        return df.repartition(spark.sparkContext.defaultParallelism)
    return df


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return src.raw_reviews(table(spark, folder, "documents"), table(spark, folder, "labels"))


def loaded(spark: SparkSession, folder: str) -> DataFrame:
    return src.reviews(raw(spark, folder))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text")


def splits(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(loaded(spark, folder))


def cleaned(spark: SparkSession, folder: str) -> DataFrame:
    return clean_splits(splits(spark, folder), BAYES)[0]


def _plain(spark: SparkSession, folder: str) -> DataFrame:
    """Documents cleaned up to the lemma step."""
    text = x.clean_expr(F.col("text"), CLEANING)
    return stage(documents(spark, folder).select("id", text.alias("text")), "plain")


# ------------------------------------------------------------------ sources


@query("load_reviews")
def load_reviews(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "reviews-csv")
    write_result(raw(spark, folder), path, "csv")
    return src.load_reviews(spark, path, "csv", id_col="id").select("id", "review", "sentiment")


@query("normalize_columns")
def normalize_columns(spark: SparkSession, folder: str) -> DataFrame:
    odd = raw(spark, folder).toDF("ID", " Review ", "SENTIMENT")
    return src.normalize_columns(odd)


@query("drop_missing")
def drop_missing(spark: SparkSession, folder: str) -> DataFrame:
    return src.drop_missing(raw(spark, folder))


@query("dedupe_reviews")
def dedupe_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return src.dedupe_reviews(raw(spark, folder))


@query("load_audit")
def load_audit(spark: SparkSession, folder: str) -> DataFrame:
    return src.load_audit(raw(spark, folder), loaded(spark, folder))


def _written_splits(spark: SparkSession, folder: str) -> str:
    path = staging_path(spark, "splits")
    write_splits(splits(spark, folder), path)
    return path


@query("write_splits")
def write_split_table(spark: SparkSession, folder: str) -> DataFrame:
    return load_splits(spark, _written_splits(spark, folder)).select("id", "review", "sentiment", "split")


@query("load_splits")
def load_test_split(spark: SparkSession, folder: str) -> DataFrame:
    return load_splits(spark, _written_splits(spark, folder), "test").select("id", "review", "sentiment", "split")


# ------------------------------------------------------------------ cleaning


def _documents_with(step: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return documents(spark, folder).select("id", step(F.col("text")).alias("text"))

    return run


def _pages_with(step: Callable[[Column], Column]) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, "pages").select("page_id", step(F.col("html")).alias("text"))

    return run


QUERIES["strip_html"] = _pages_with(x.strip_html)
QUERIES["strip_urls"] = _pages_with(x.strip_urls)
QUERIES["lowercase_text"] = _documents_with(x.lowercase_text)
QUERIES["strip_numbers"] = _documents_with(x.strip_numbers)
QUERIES["strip_punct"] = _documents_with(x.strip_punct)
QUERIES["normalize_ws"] = _documents_with(x.normalize_ws)
QUERIES["remove_stopwords"] = _documents_with(
    lambda t: F.array_join(x.remove_stopwords(x.split_words(F.lower(t))), " ")
)
QUERIES["drop_short_tokens"] = _documents_with(lambda t: F.array_join(x.drop_short_tokens(x.split_words(t)), " "))
QUERIES["clean_minimal"] = _pages_with(lambda t: x.clean_expr(t, CleaningConfig(strategy="minimal")))


@query("clean_standard")
def clean_standard(spark: SparkSession, folder: str) -> DataFrame:
    return clean_table(documents(spark, folder), CleaningConfig(), "text").select("id", "clean_review")


@query("clean_aggressive")
def clean_aggressive(spark: SparkSession, folder: str) -> DataFrame:
    config = CleaningConfig(strategy="aggressive")
    return clean_table(documents(spark, folder), config, "text").select("id", "clean_review")


@query("clean_table")
def clean_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return clean_table(raw(spark, folder), CLEANING)


@query("empty_after_clean")
def empty_after_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    return empty_after_clean(clean_table(raw(spark, folder), CLEANING))


@query("lemmatize_tokens")
def lemmatize_tokens(spark: SparkSession, folder: str) -> DataFrame:
    words = _plain(spark, folder)
    return lemma_table(term_frequencies(words, "text"), corpus_lexicon(words, "text"))


# ------------------------------------------------------------------ joins


@query("lexicon_join")
def lexicon_join(spark: SparkSession, folder: str) -> DataFrame:
    words = _plain(spark, folder)
    terms = term_frequencies(words, "text")
    lemmas = lemma_table(terms, corpus_lexicon(words, "text"))
    listed = terms.join(lemmas.select("term", "lemma"), "term", "left")
    return listed.groupBy(F.coalesce("lemma", "term").alias("lemma")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_forms")
    )


@query("stopword_antijoin")
def stopword_antijoin_terms(spark: SparkSession, folder: str) -> DataFrame:
    words = element_rows(documents(spark, folder), x.split_words(F.lower("text")), "term")
    return stopword_antijoin(words.groupBy("term").agg(F.count(F.lit(1)).alias("n")))


@query("label_encode")
def label_encode(spark: SparkSession, folder: str) -> DataFrame:
    return raw(spark, folder).select("id", "sentiment", encode_label(F.col("sentiment")).alias("label"))


@query("label_decode")
def label_decode(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(
        "doc_id", "quality", decode_label(F.col("quality")).alias("sentiment")
    )


@query("vocab_join")
def vocabulary_join(spark: SparkSession, folder: str) -> DataFrame:
    """Known terms of held-out rows, with the vocabulary of the training rows."""
    rows = with_terms(cleaned(spark, folder), "clean_review", WORDS)
    vocabulary = stage(fit_vocabulary(rows.where("split = 'train'"), WORDS), "vocabulary")
    return vocab_join(term_counts(rows.where("split = 'test'")), vocabulary)


# ------------------------------------------------------------------ profile


@query("dataset_overview")
def dataset_overview(spark: SparkSession, folder: str) -> DataFrame:
    return p.dataset_overview(raw(spark, folder))


@query("missing_values")
def missing_values(spark: SparkSession, folder: str) -> DataFrame:
    return p.missing_values(raw(spark, folder))


@query("duplicate_stats")
def duplicate_stats(spark: SparkSession, folder: str) -> DataFrame:
    return p.duplicate_stats(raw(spark, folder))


@query("label_distribution")
def label_distribution(spark: SparkSession, folder: str) -> DataFrame:
    return p.label_distribution(raw(spark, folder))


@query("char_length_stats")
def char_length_stats(spark: SparkSession, folder: str) -> DataFrame:
    return p.char_length_stats(raw(spark, folder))


@query("word_count_stats")
def word_count_stats(spark: SparkSession, folder: str) -> DataFrame:
    return p.word_count_stats(raw(spark, folder))


@query("length_histogram")
def length_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return p.length_histogram(raw(spark, folder))


@query("word_histogram")
def word_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return p.word_histogram(raw(spark, folder))


@query("classwise_word_stats")
def classwise_word_stats(spark: SparkSession, folder: str) -> DataFrame:
    return p.classwise_word_stats(raw(spark, folder))


@query("classwise_boxplot")
def classwise_boxplot(spark: SparkSession, folder: str) -> DataFrame:
    return p.classwise_boxplot(raw(spark, folder))


def _clean_documents(spark: SparkSession, folder: str) -> DataFrame:
    """The clean text in place of the raw one, which need not be written then."""
    return clean_table(documents(spark, folder).withColumnRenamed("text", "clean_review"), CLEANING, "clean_review")


@query("top_words")
def top_words(spark: SparkSession, folder: str) -> DataFrame:
    return p.top_words(_clean_documents(spark, folder))


@query("top_ngrams")
def top_ngrams(spark: SparkSession, folder: str) -> DataFrame:
    return p.top_ngrams(_clean_documents(spark, folder))


@query("ngram_stopwords")
def ngram_stopwords(spark: SparkSession, folder: str) -> DataFrame:
    """The counter's own stop list over raw text."""
    tokens = p.counted_tokens(documents(spark, folder), "text")
    return tokens.select("id", F.size("tokens").cast("bigint").alias("n"), F.array_join("tokens", " ").alias("tokens"))


@query("class_term_freq")
def class_term_freq(spark: SparkSession, folder: str) -> DataFrame:
    rows = raw(spark, folder).select("sentiment", F.col("review").alias("clean_review"))
    return p.class_term_freq(clean_table(rows, CLEANING, "clean_review"))


@query("split_inspection")
def split_inspection(spark: SparkSession, folder: str) -> DataFrame:
    return p.split_inspection(splits(spark, folder))


def _report(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage(splits(spark, folder), "splits", partition_by="split")
    train_rows = rows.where("split = 'train'").select("id", "review", "sentiment")
    clean = stage(clean_table(train_rows, CLEANING), "clean")
    return profile_report(profile(train_rows, clean, rows))


@query("profile_report")
def profile_sections(spark: SparkSession, folder: str) -> DataFrame:
    return _report(spark, folder)


@query("eda_sink")
def profile_sink(spark: SparkSession, folder: str) -> DataFrame:
    path = staging_path(spark, "profile")
    report = _report(spark, folder)
    write_result(report, path, "json")
    return spark.read.schema(report.schema).json(path)


# ------------------------------------------------------------------ sampling


@query("stratified_subset")
def stratified_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_subset(stage(loaded(spark, folder), "reviews"), SUBSET_ROWS).select("id", "sentiment")


@query("stratified_split")
def stratified_split_rows(spark: SparkSession, folder: str) -> DataFrame:
    return stratified_split(stage(loaded(spark, folder), "reviews")).select("id", "sentiment", "split")


@query("sample_reviews")
def random_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return sample_reviews(raw(spark, folder))


# ------------------------------------------------------------------ features


def _listing(df: DataFrame) -> DataFrame:
    """Number and digest of each row's terms, in order."""
    return df.select(
        "id", F.size("terms").cast("bigint").alias("n_terms"), F.md5(F.array_join("terms", "\n")).alias("digest")
    )


@query("word_tokens")
def word_token_lists(spark: SparkSession, folder: str) -> DataFrame:
    return _listing(documents(spark, folder).select("id", word_tokens(F.col("text")).alias("terms")))


@query("word_ngrams")
def word_ngram_lists(spark: SparkSession, folder: str) -> DataFrame:
    tokens = documents(spark, folder).select("id", word_tokens(F.col("text")).alias("tokens"))
    return _listing(tokens.select("id", word_ngrams(F.col("tokens"), 1, 3).alias("terms")))


@query("char_wb_ngrams")
def char_ngram_lists(spark: SparkSession, folder: str) -> DataFrame:
    return _listing(documents(spark, folder).select("id", char_wb_ngrams(F.col("text")).alias("terms")))


@query("char_ngram_statistics")
def char_ngram_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return term_statistics(with_tokens(documents(spark, folder), "text", CHARS), "tokens", CHARS)


@query("count_features")
def count_features(spark: SparkSession, folder: str) -> DataFrame:
    return term_counts(with_terms(_clean_documents(spark, folder), "clean_review", FeatureConfig(ngram_range=(1, 1))))


def _rounded_vocabulary(vocabulary: DataFrame) -> DataFrame:
    return vocabulary.withColumn("idf", round_half_up(F.col("idf"), 6))


@query("vocab_fit")
def vocabulary_fit(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded_vocabulary(fit_vocabulary(with_tokens(documents(spark, folder), "text", WORDS), WORDS, "tokens", of_tokens=True))


@query("vocab_cap")
def vocabulary_cap(spark: SparkSession, folder: str) -> DataFrame:
    """A cap that bites at every scale."""
    config = FeatureConfig(max_features=500)
    return _rounded_vocabulary(fit_vocabulary(with_tokens(documents(spark, folder), "text", config), config, "tokens", of_tokens=True))


def _weights(spark: SparkSession, folder: str, config: FeatureConfig) -> DataFrame:
    rows = documents(spark, folder)
    found = TermModel.fit(rows, config, "text").weights(rows, "text")
    return found.select("id", "term", round_half_up(F.col("weight"), 6).alias("weight"))


@query("tfidf_features")
def tfidf_features(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, WORDS)


@query("tfidf_without_sublinear")
def tfidf_without_sublinear(spark: SparkSession, folder: str) -> DataFrame:
    return _weights(spark, folder, FeatureConfig(ngram_range=(1, 1), sublinear_tf=False))


@query("sublinear_tf")
def sublinear_tf(spark: SparkSession, folder: str) -> DataFrame:
    counts = term_counts(with_terms(documents(spark, folder), "text", FeatureConfig(ngram_range=(1, 1))))
    return counts.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_terms"), round_half_up(F.sum(1.0 + F.log("n")), 6).alias("damped")
    )


@query("tfidf_char_features")
def tfidf_char_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = documents(spark, folder)
    entries = vector_entries(TermModel.fit(rows, CHARS, "text").transform(rows, "text"), "id")
    return entries.groupBy("id").agg(
        F.count(F.lit(1)).alias("n_terms"), round_half_up(F.sum("weight"), 6).alias("total")
    )


@query("l2_normalize")
def l2_norms(spark: SparkSession, folder: str) -> DataFrame:
    """Norm of every row, rows without known terms included."""
    rows = documents(spark, folder)
    vectors = TermModel.fit(rows, WORDS, "text").transform(rows, "text")
    squares = F.transform(F.unwrap_udt("features")["values"], lambda v: v * v)
    total = F.aggregate(squares, F.lit(0.0), lambda a, v: a + v)
    return vectors.select("id", round_half_up(F.sqrt(total), 6).alias("norm"))


@query("transform_split")
def transform_split(spark: SparkSession, folder: str) -> DataFrame:
    """Held-out rows under a model of the training rows; empty rows survive."""
    terms, features = feature_table(cleaned(spark, folder), BAYES)
    values = F.unwrap_udt("features")["values"]
    total = F.aggregate(values, F.lit(0.0), lambda a, v: a + v)
    return features.where("split <> 'train'").select(
        "id", "split", F.size(values).cast("bigint").alias("n_terms"), round_half_up(total, 6).alias("total")
    )


@query("feature_vectors")
def feature_vectors(spark: SparkSession, folder: str) -> DataFrame:
    """Entries of the vectors models are fitted on."""
    terms, features = feature_table(cleaned(spark, folder), BAYES)
    return vector_entries(features, "id", "split").select(
        "id", "split", "idx", round_half_up(F.col("weight"), 6).alias("weight")
    )


# ------------------------------------------------------------------ models


@query("class_weights")
def class_weight_table(spark: SparkSession, folder: str) -> DataFrame:
    rows = loaded(spark, folder).select(encode_label(F.col("sentiment")).alias("label"))
    return class_weights(rows).withColumn("weight", round_half_up(F.col("weight"), 6))


def _held_out_scores(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        terms, features = feature_table(cleaned(spark, folder), BAYES)
        rows = features.where("split = 'train'").select("id", "label", "features")
        model = model_fitter(name)(rows, BAYES.params_for(name), BAYES.seed, len(terms.vocabulary))
        held_out = features.where("split = 'test'").select("id", "label", "features")
        scored = model.score(held_out)
        return scored.select("id", "label", "prediction", round_half_up(F.col("score"), 6).alias("score"))

    return run


def _bare_svm(spark: SparkSession, folder: str) -> DataFrame:
    terms, features = feature_table(cleaned(spark, folder), BAYES)
    rows = features.where("split = 'train'").select("id", "label", "features")
    model = fit_linear_svm(rows, BAYES.params_for("linear_svm"), BAYES.seed, len(terms.vocabulary))
    held_out = features.where("split = 'test'").select("id", "label", "features")
    return model.score(held_out).select("id", "label", "prediction", round_half_up(F.col("score"), 6).alias("score"))


QUERIES["multinomial_nb"] = _held_out_scores("multinomial_nb")
QUERIES["logistic_regression"] = _held_out_scores("logistic_regression")
QUERIES["linear_svm"] = _bare_svm
QUERIES["calibrated_svm"] = _held_out_scores("linear_svm")
QUERIES["random_forest"] = _held_out_scores("random_forest")
QUERIES["sgd_linear"] = _held_out_scores("sgd_linear")


@query("train_all")
def train_models(spark: SparkSession, folder: str) -> DataFrame:
    config = TrainingConfig(cleaning=CLEANING)
    terms, features = feature_table(cleaned(spark, folder), config)
    models = train_all(features, terms, config)
    scored = predictions(features.where("split = 'val'"), models)
    return scored.withColumn("score", round_half_up(F.col("score"), 6))


@query("train_all_bayes")
def train_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """``train_all`` for the model whose fit is exact."""
    terms, features = feature_table(cleaned(spark, folder), BAYES)
    scored = predictions(features.where("split = 'val'"), train_all(features, terms, BAYES))
    return scored.withColumn("score", round_half_up(F.col("score"), 6))


@query("train_job_bayes")
def train_job_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """The job for the exact model, written and read back."""
    path = staging_path(spark, "job")
    trained = run_job(splits(spark, folder), path, BAYES)
    rows = ev.comparison(spark.read.schema(trained.validation.schema).json(f"{path}/metrics/validation"))
    return rows.withColumn("champion", F.col("model") == champion(spark, path))


@query("train_job")
def train_job(spark: SparkSession, folder: str) -> DataFrame:
    """The default job, lemmas included, with its champion marked."""
    trained = train(splits(spark, folder))
    return ev.comparison(trained.validation).withColumn("champion", F.col("model") == trained.champion)


# ------------------------------------------------------------------ evaluation


def _variants(spark: SparkSession, folder: str) -> DataFrame:
    """``(variant, split, id, label, margin, score)`` of three exact naive Bayes models on held-out rows."""
    rows = cleaned(spark, folder)
    parts = []

    def written(terms: TermModel) -> DataFrame:
        features = terms.transform(rows).select("id", "split", "label", "features")
        return stage(features, "features", partition_by="split")

    def add(variant: str, features: DataFrame, weight: str | None = None) -> None:
        fitted_on = features.where("split = 'train'")
        if weight:
            fitted_on = with_class_weights(fitted_on, out=weight)
        model = fit_naive_bayes(fitted_on, len(words.vocabulary), weight=weight)
        margins = model.margin(features.where("split <> 'train'"))
        parts.append(margins.select(F.lit(variant).alias("variant"), "split", "id", "label", "margin"))

    words = TermModel.fit(rows.where("split = 'train'"), WORDS)
    tfidf = written(words)
    add("tfidf", tfidf)
    add("count", written(replace(words, config=COUNTS)))
    add("weighted", tfidf, "row_weight")
    scored = reduce(DataFrame.unionByName, parts)
    return stage(scored.withColumn("score", round_half_up(F.col("margin"), 9)), "variants")


def graded(spark: SparkSession, folder: str) -> DataFrame:
    """The variants at two cuts: margin 0 and the median margin of the split."""
    scored = _variants(spark, folder)
    # The median from running counts: the scores that hold the two middle places.
    ranks = ev.ranked_scores(scored, ("variant", "split"))
    rows, before = F.col("n_pos") + F.col("n_neg"), F.col("n_pos") + F.col("n_neg") - F.col("pos_from") - F.col("neg_from")
    middle = lambda place: F.max(F.when((before <= place) & (place < before + F.col("pos") + F.col("neg")), F.col("score")))
    median = ranks.groupBy("variant", "split").agg(
        ((middle(F.floor((rows - 1) / 2)) + middle(F.ceil((rows - 1) / 2))) / 2).alias("median")
    )
    cuts = scored.join(median, ["variant", "split"]).select(
        "*",
        F.inline(
            F.array(
                F.struct(F.lit("zero").alias("cut"), F.lit(0.0).alias("at")),
                F.struct(F.lit("median").alias("cut"), F.col("median").alias("at")),
            )
        ),
    )
    return cuts.select(
        "variant", "split", "cut", "id", "label", (F.col("score") > F.col("at")).cast("double").alias("prediction"), "score"
    )


GRID = ("variant", "split", "cut")


@query("confusion_matrix")
def confusion_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return ev.confusion_matrix(graded(spark, folder), GRID)


@query("accuracy")
def accuracy(spark: SparkSession, folder: str) -> DataFrame:
    return ev.accuracy(graded(spark, folder), GRID)


@query("precision_recall_f1")
def precision_recall_f1(spark: SparkSession, folder: str) -> DataFrame:
    return ev.precision_recall_f1(graded(spark, folder), GRID)


@query("roc_auc")
def roc_auc(spark: SparkSession, folder: str) -> DataFrame:
    return ev.roc_auc(_variants(spark, folder), ("variant", "split"))


@query("roc_curve")
def roc_curve(spark: SparkSession, folder: str) -> DataFrame:
    """A point per distinct score, those between equal steps included."""
    points = ev.roc_curve(_variants(spark, folder), ("variant", "split"), corners_only=False)
    return points.select("variant", "split", *[round_half_up(F.col(c), 6).alias(c) for c in ("threshold", "fpr", "tpr")])


@query("score_column")
def score_column(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of the positive class of every held-out row."""
    probability = 1.0 / (1.0 + F.exp(-F.col("margin")))
    return _variants(spark, folder).select("variant", "split", "id", round_half_up(probability, 6).alias("score"))


def _grid_metrics(spark: SparkSession, folder: str, split: str, cut: str) -> DataFrame:
    rows = graded(spark, folder).where((F.col("split") == split) & (F.col("cut") == cut))
    return ev.metrics(rows.withColumnRenamed("variant", "model"))


@query("comparison_table")
def comparison_table(spark: SparkSession, folder: str) -> DataFrame:
    return ev.comparison(_grid_metrics(spark, folder, "val", "median"))


@query("model_comparison")
def model_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return ev.comparison(_grid_metrics(spark, folder, "test", "zero"))


@query("select_best")
def select_best(spark: SparkSession, folder: str) -> DataFrame:
    return ev.select_best(_grid_metrics(spark, folder, "val", "median"), "accuracy", ("weighted", "tfidf", "count"))


@query("metrics_sink")
def metrics_sink(spark: SparkSession, folder: str) -> DataFrame:
    rows = _grid_metrics(spark, folder, "test", "median")
    path = staging_path(spark, "metrics")
    write_result(rows, path, "json")
    return spark.read.schema(rows.schema).json(path)


@query("evaluate_test")
def evaluate_test(spark: SparkSession, folder: str) -> DataFrame:
    """Saved models on the test rows; one that was never saved is skipped."""
    path, rows = _saved(spark, folder, ("sgd_linear", "multinomial_nb"))
    names = ["multinomial_nb", "sgd_linear", "random_forest"]
    return ev.comparison(ev.metrics(held_out_predictions(spark, path, rows.where("split = 'test'"), names)))


@query("evaluate_test_bayes")
def evaluate_test_bayes(spark: SparkSession, folder: str) -> DataFrame:
    """The saved exact model on the test rows."""
    path, rows = _saved(spark, folder, ("multinomial_nb",))
    return evaluate(spark, path, rows.where("split = 'test'"), write=False)


# ------------------------------------------------------------------ scoring


def _saved(spark: SparkSession, folder: str, names: tuple[str, ...]) -> tuple[str, DataFrame]:
    rows = stage(splits(spark, folder), "splits", partition_by="split")
    path = staging_path(spark, "model")
    save(spark, train(rows, TrainingConfig(cleaning=CLEANING, active_models=names)), path)
    return path, rows


def _bayes_scorer(spark: SparkSession, folder: str) -> Scorer:
    path, _ = _saved(spark, folder, ("multinomial_nb",))
    return load_scorer(spark, path)


@query("attach_predictions")
def attach_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Scores kept in a table of their own, joined back by id."""
    rows = documents(spark, folder)
    scored = stage(score(rows, _bayes_scorer(spark, folder), "text").drop("text"), "scores")
    source = table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "lang", "source")
    return source.join(scored, "id")


@query("score_table")
def score_stored_table(spark: SparkSession, folder: str) -> DataFrame:
    """A CSV in, its columns with label and confidence out, written and read back."""
    path, out = staging_path(spark, "documents-csv"), staging_path(spark, "scored-csv")
    write_result(table(spark, folder, "documents").select("doc_id", "text", "source"), path, "csv")
    score_table(spark, path, _bayes_scorer(spark, folder), "text", "csv", out)
    return src.read_table(spark, out).select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "source", "predicted_label",
        F.col("confidence").cast("double").alias("confidence"),
    )


@query("write_model")
def saved_model(spark: SparkSession, folder: str) -> DataFrame:
    """The champion, saved and loaded, on the test rows."""
    path, rows = _saved(spark, folder, ("multinomial_nb",))
    scored = score(rows.where("split = 'test'"), load_scorer(spark, path))
    return scored.select("id", "sentiment", "predicted_label", "confidence")


@query("predict_with_model")
def predict_with_model(spark: SparkSession, folder: str) -> DataFrame:
    """A model asked for by name, though another may be the champion."""
    path, rows = _saved(spark, folder, ("sgd_linear", "multinomial_nb"))
    scored = predict_batch(rows.where("split = 'test'"), load_scorer(spark, path, "multinomial_nb"))
    return scored.select(F.md5("text").alias("text_digest"), "predicted_label", "confidence", "model_used")


@query("predict_batch")
def predict_texts(spark: SparkSession, folder: str) -> DataFrame:
    return predict_batch(table(spark, folder, "conversations"), _bayes_scorer(spark, folder), "text")


@query("confidence")
def confidence(spark: SparkSession, folder: str) -> DataFrame:
    """Probability of *positive*, and of the label given."""
    scored = score(table(spark, folder, "conversations"), _bayes_scorer(spark, folder), "text")
    shown = F.when(F.col("predicted_label") == "positive", F.col("confidence")).otherwise(1.0 - F.col("confidence"))
    return scored.select("conv_id", "turn", "confidence", round_half_up(shown, 4).alias("label_confidence"))


@query("preview")
def preview_rows(spark: SparkSession, folder: str) -> DataFrame:
    scored = score(documents(spark, folder), _bayes_scorer(spark, folder), "text")
    return preview(scored).select("id", "predicted_label", "confidence")


@query("score_stream")
def score_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The conversations as a file stream, scored until none is left."""
    scorer = _bayes_scorer(spark, folder)
    schema = table(spark, folder, "conversations").schema
    stream = spark.readStream.schema(schema).parquet(f"{folder}/conversations.parquet*")
    out = staging_path(spark, "scored-stream")
    start_scoring(stream, scorer, out, staging_path(spark, "stream-checkpoint"), "text").awaitTermination()
    return spark.read.parquet(out).select("conv_id", "turn", "predicted_label", "confidence")
