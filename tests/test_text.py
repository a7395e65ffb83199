import random

import pytest
from pyspark.sql import functions as F

from opinara.config import CleaningConfig, FeatureConfig
from opinara.functions import text as x
from opinara.functions.text import clean_expr
from opinara.functions.tokens import char_wb_ngrams, word_ngrams, word_tokens, with_terms
from opinara.functions.wordlists import CLEANER_STOPWORDS, COUNTER_STOPWORDS
from opinara.operators.cleaning import clean_table, cleaned_words, empty_after_clean, lemmas_of_words
from opinara.operators.dictionary import dictionary
from opinara.operators.lemmas import (
    lemma_table,
    lemmatize,
    lemmatize_in_place,
    numbered,
    recurring_forms,
    row_frequencies,
    term_frequencies,
)


def cleaned(spark, text, **options):
    config = CleaningConfig(**options)
    frame = spark.createDataFrame([(text,)], "t string")
    return frame.select(clean_expr(F.col("t"), config)).first()[0]


def test_minimal(spark):
    assert cleaned(spark, "<br/>This Movie WAS Great!!", strategy="minimal") == "this movie was great!!"


def test_standard(spark):
    assert cleaned(spark, "<p>This movie was NOT good at all.</p>") == "movie good"


def test_aggressive(spark):
    out = cleaned(spark, "I am go to a it 123 movie", strategy="aggressive")
    assert out == "movie" and all(len(t) >= 3 for t in out.split())


def test_unknown_strategy():
    with pytest.raises(ValueError, match="minimal"):
        clean_expr(F.lit(""), CleaningConfig(strategy="other"))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a <b\nc> d", "a <b c> d"),
        ("see HTTP://X and http://y/z now", "see http://x and now"),
        ("café x²\u0085y_z", "café x² y_z"),
        (None, ""),
        ("  ", ""),
    ],
)
def test_minimal_edges(spark, text, expected):
    assert cleaned(spark, text, strategy="minimal") == expected


def test_punctuation_keeps_word_characters(spark):
    out = cleaned(spark, "café-x²_y 5%!", remove_stopwords=False, lemmatize=False)
    assert out == "café x²_y 5"


def test_flags_switch_steps_off(spark):
    off = dict(remove_html=False, lowercase=False, remove_punctuation=False, remove_stopwords=False, lemmatize=False)
    assert cleaned(spark, "<i>The  End</i> http://x", **off) == "<i>The End</i> http://x"
    assert cleaned(spark, "The <i>End</i> 42", remove_numbers=True) == "end"
    assert cleaned(spark, "a  b", normalize_whitespace=False, remove_stopwords=False, lemmatize=False) == "a  b"


def test_stop_lists():
    assert len(CLEANER_STOPWORDS) == 179 and {"not", "no", "don", "t"} <= set(CLEANER_STOPWORDS)
    assert len(COUNTER_STOPWORDS) == 318 and "does" not in COUNTER_STOPWORDS and "whereupon" in COUNTER_STOPWORDS


def test_tokens_and_ngrams(spark):
    frame = spark.createDataFrame([("A Big reéd barn x",), ("one",), ("",)], "t string")
    tokens = frame.select(word_tokens(F.col("t")).alias("k"))
    got = [r[0] for r in tokens.select(word_ngrams(F.col("k"), 1, 3)).collect()]
    assert got == [["big", "reéd", "barn", "big reéd", "reéd barn", "big reéd barn"], ["one"], []]


def brute_char_grams(text, low=3, high=5):
    found = []
    for word in text.lower().split():
        padded = f" {word} "
        for n in range(low, high + 1):
            if len(padded) < n:
                break
            found += [padded[i : i + n] for i in range(len(padded) - n + 1)]
    return found


def test_char_ngrams(spark):
    texts = ["a ab abc Longer words", "", "x"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i")
    got = [r[0] for r in frame.select(char_wb_ngrams(F.col("t"))).collect()]
    assert got == [brute_char_grams(t) for t in texts]


def test_unknown_feature_strategy(spark):
    with pytest.raises(ValueError):
        with_terms(spark.createDataFrame([("a",)], "t string"), "t", FeatureConfig(strategy="other"))


LEXICON = ["movie", "dress", "box", "church", "woman", "women", "wolf", "city", "bus", "bu", "glass", "goose", "quiz"]
LEMMAS = {
    "movies": "movie", "dresses": "dress", "boxes": "box", "churches": "church", "women": "women",
    "cities": "city", "bus": "bu", "unknowns": "unknowns", "glassses": "glass", "quizzes": "quizzes",
    "wolves": "wolf", "cat": "cat",
}


def test_lemma_rules(spark):
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "form string")
    terms = spark.createDataFrame([(w, 1) for w in LEMMAS], "term string, n bigint")
    got = {r.term: r.lemma for r in lemma_table(terms, lexicon).collect()}
    assert got == {k: v for k, v in LEMMAS.items() if k.endswith(("s", "men"))}


def test_lemma_exceptions(spark):
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "form string")
    terms = spark.createDataFrame([("geese", 1), ("movies", 2), ("cat", 3)], "term string, n bigint")
    exceptions = spark.createDataFrame([("geese", "goose")], "form string, lemma string")
    got = {r.term: r.lemma for r in lemma_table(terms, lexicon, exceptions).collect()}
    assert got == {"geese": "goose", "movies": "movie", "cat": "cat"}


def test_lemmatize_keeps_order_and_empty_rows(spark):
    rows = spark.createDataFrame([(1, "two movies two boxes the cities"), (2, ""), (3, "boxes movies cat")], "id int, text string")
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "form string")
    table = lemma_table(term_frequencies(rows, "text", changeable_only=True), lexicon)
    got = {r.id: r.text for r in lemmatize(numbered(rows, "rows"), "text", table).collect()}
    assert got == {1: "two movie two box the city", 2: "", 3: "box movie cat"}


def test_null_and_repeated_ids_keep_their_rows(spark):
    rows = spark.createDataFrame(
        [(1, "a dog"), (None, "two dogs"), (3, "cats"), (3, "dogs run"), (4, "the dog")], "id int, review string"
    ).withColumn("a.b", F.lit(1))
    out = clean_table(rows, CleaningConfig())
    assert out.columns == [*rows.columns, "clean_review"]
    got = sorted((r.id or 0, r.clean_review) for r in out.collect())
    assert got == [(0, "two dog"), (1, "dog"), (3, "cats"), (3, "dog run"), (4, "dog")]


def test_a_small_dictionary_is_probed_in_the_row(spark):
    rows = numbered(spark.createDataFrame([(1, "two movies here"), (2, "boxes")], "id int, text string"), "rows")
    lexicon = spark.createDataFrame([(w,) for w in LEXICON], "form string")
    out = lemmatize(rows, "text", lemma_table(term_frequencies(rows, "text", True), lexicon))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "from_json" not in plan
    assert sorted(map(tuple, out.collect())) == [(1, "two movie here"), (2, "box")]


@pytest.mark.parametrize("most", [1, 3, 6])
def test_a_large_dictionary_keeps_frequent_words_in_the_row(spark, most):
    draw = random.Random(most)
    texts = [" ".join(draw.choices([*LEMMAS, "is", "was"], k=draw.randrange(12))) for _ in range(200)]
    rows = numbered(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "rows")
    lexicon = spark.createDataFrame([(w,) for w in [*LEXICON, "is", "was"]], "form string")
    table = lemma_table(term_frequencies(rows, "text", True), lexicon)
    want = sorted(map(tuple, lemmatize(rows, "text", table).collect()))
    tiered = lemmatize(rows, "text", table, most=most)
    assert sorted(map(tuple, tiered.collect())) == want
    assert {r[0]: r[1] for r in want} == {i: " ".join(LEMMAS.get(w, w) if w.endswith(("s", "men")) else w for w in t.split()) for i, t in enumerate(texts)}
    assert "Join" in tiered._jdf.queryExecution().optimizedPlan().toString()
    in_place = lemmatize_in_place(rows.drop("__row"), "text", lexicon)
    assert sorted(map(tuple, in_place.collect())) == want


def test_dictionary_keys_and_bounds(spark):
    entries = {"a": 1, 'q"\\\n': 2, "é\U0001f600": 3, "": 4, "'": 5} | {f"w{i}": i for i in range(300)}
    table = spark.createDataFrame(list(entries.items()), "k string, v int")
    lookup = dictionary(table, "k", "v")
    asked = spark.createDataFrame([(w,) for w in [*entries, "absent", None]], "w string")
    got = {r.w: r.v for r in asked.select("w", lookup(F.col("w")).alias("v")).collect()}
    assert got == entries | {"absent": None, None: None}
    assert dictionary(table, "k", "v", most=304) is None and dictionary(table, "k", "v", chars=20) is None
    assert dictionary(table, "k", "v", most=305) is not None
    none = dictionary(table.limit(0), "k", "v")
    assert asked.select(none(F.col("w")).alias("v")).where("v is not null").count() == 0


def test_clean_table_with_corpus_lexicon(spark):
    rows = spark.createDataFrame([(1, "The cats!"), (2, "a cat"), (3, "One cat, two dogs"), (4, "!!!")], "id int, review string")
    out = clean_table(rows, CleaningConfig())
    assert {r.id: r.clean_review for r in out.collect()} == {1: "cat", 2: "cat", 3: "one cat two dogs", 4: ""}
    assert tuple(empty_after_clean(out).first()) == (4, 1)


def test_words_are_cut_in_one_pass_with_the_same_result(spark):
    texts = [
        None, "", " ", "a<b>c http://x.y/<i>z</i> www.<b>q</b>.de", "https:/no HTTP://Yes <not\nclosed> wwW.x www",
        "It's 2nd-hand, x\u00b2 \u0663 _a_ \u2028b\u00a0c\x85d\x1ce", "\u0130\u00c9\ufb01 \u01c5 e\u0301 \U0001d400 \u2167 12", "the  The 3 men's boxes",
    ]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    flags = ("lowercase", "remove_html", "remove_punctuation", "remove_numbers", "normalize_whitespace", "remove_stopwords", "lemmatize")
    for strategy in ("standard", "aggressive"):
        for off in (None, *flags):
            config = CleaningConfig(strategy, **{**{f: True for f in flags}, **({off: False} if off else {})})
            plain = F.coalesce("text", F.lit(""))
            if config.remove_html:
                plain = x.strip_urls(x.strip_html(plain))
            plain = F.lower(plain) if config.lowercase else plain
            plain = x.strip_numbers(plain) if config.remove_numbers or strategy == "aggressive" else plain
            plain = x.strip_punct(plain) if config.remove_punctuation else plain
            words = x.split_words(x.normalize_ws(plain))
            if strategy == "aggressive":
                words = x.drop_short_tokens(words)
            words = x.remove_stopwords(words) if config.remove_stopwords else words
            want, got = F.array_join(words, " "), x.clean_expr(F.col("text"), config)
            assert rows.select(want.alias("want"), got.alias("got")).where("not (want <=> got)").collect() == []
    steps = str(x.clean_expr(F.col("text"), CleaningConfig()))
    assert x.SPACE_PATTERN not in steps and x.PUNCT_PATTERN not in steps


def test_words_are_counted_once_for_lexicon_and_terms(spark):
    texts = ["cats cats dog", "cats boxes", "", "box dog"]
    rows = cleaned_words(spark.createDataFrame([(t,) for t in texts], "text string"), CleaningConfig(), "text", "text")
    terms = row_frequencies(rows, "text")
    assert {r.term: r.n for r in terms.collect()} == {"cats": 2, "dog": 2, "boxes": 1, "box": 1}
    assert {r.form for r in recurring_forms(terms).collect()} == {"cats", "dog"}
    assert {r.term for r in row_frequencies(rows, "text", changeable_only=True).collect()} == {"cats", "boxes"}
    out = lemmas_of_words(rows, "text", spark.createDataFrame([("cat",), ("box",)], "form string"))
    assert sorted(r.text for r in out.collect()) == ["", "box dog", "cat box", "cat cat dog"]
