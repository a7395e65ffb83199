"""DuckDB SQL each query must equal.

Statements are put together from named common table expressions; ``statement`` adds those a final
select needs, in order.
"""

from __future__ import annotations

import re

from opinara.config import FeatureConfig, ProfileConfig, SplitConfig
from opinara.contract.queries import SUBSET_ROWS
from opinara.functions.wordlists import CLEANER_STOPWORDS, COUNTER_STOPWORDS

SPLIT = SplitConfig()
PROFILE = ProfileConfig()
WORDS = FeatureConfig()

# Fixed values, stated here for themselves: a change in the library has to show as a difference.
TAGS = r"<[^>\n]*>"
URLS = r"https?://[^\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]+|www\.[^\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]+"
NUMBERS = r"\p{Nd}+"
PUNCTUATION = r"[^\p{L}\p{N}_\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]"
SPACES = r"[\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]+"
NO_SPACES = r"[^\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}]+"
TOKEN = r"[\p{L}\p{N}_]{2,}"
SHORTEST_AGGRESSIVE = 3
CHAR_NGRAMS = (3, 5)
LEMMA_SUFFIXES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def listed(words) -> str:
    return "[" + ", ".join(quoted(w) for w in words) + "]"


def rounded(value: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"(sign({value}) * floor(abs({value}) * {scale} + 0.5) / {scale})"


def replaced(text: str, pattern: str) -> str:
    return f"regexp_replace({text}, {quoted(pattern)}, ' ', 'g')"


def words_of(text: str) -> str:
    return f"regexp_extract_all({text}, {quoted(NO_SPACES)})"


def tokens_of(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {quoted(TOKEN)})"


def without(tokens: str, words) -> str:
    return f"list_filter({tokens}, lambda w: NOT list_contains({listed(words)}, w))"


def joined(tokens: str, separator: str = " ") -> str:
    return f"coalesce(array_to_string({tokens}, {quoted(separator)}), '')"


def order_key(id_: str = "id", seed: int = SPLIT.seed) -> str:
    return f"md5(concat(CAST({id_} AS VARCHAR), ':{seed}'))"


def stripped(text: str) -> str:
    return replaced(replaced(text, TAGS), URLS)


def spaced(text: str) -> str:
    return f"trim({replaced(text, SPACES)}, ' ')"


def minimal(text: str) -> str:
    return spaced(f"lower({stripped(text)})")


def standard(text: str) -> str:
    """The standard strategy without lemmas."""
    return joined(without(words_of(spaced(replaced(f"lower({stripped(text)})", PUNCTUATION))), CLEANER_STOPWORDS))


def aggressive(text: str) -> str:
    plain = spaced(replaced(replaced(f"lower({stripped(text)})", NUMBERS), PUNCTUATION))
    long = f"list_filter({words_of(plain)}, lambda w: length(w) >= {SHORTEST_AGGRESSIVE})"
    return joined(without(long, CLEANER_STOPWORDS))


def ngrams_of(tokens: str, low: int, high: int) -> str:
    """n-grams of a list column, shorter ones first."""

    def of(n: int) -> str:
        if n == 1:
            return tokens
        shifted = ", ".join([tokens, *(f"{tokens}[{i}:]" for i in range(2, n + 1))])
        gram = " || ' ' || ".join(f"p[{i}]" for i in range(1, n + 1))
        return f"list_transform(list_zip({shifted}, true), lambda p: {gram})"

    return " || ".join(of(n) for n in range(low, high + 1))


def char_ngrams_of(text: str) -> str:
    low, high = CHAR_NGRAMS
    per_word = (
        f"flatten(list_transform(range({low}, least({high}, length(w) + 2) + 1), "
        "lambda n: list_transform(range(1, length(w) + 4 - n), lambda i: substring(' ' || w || ' ', i, n))))"
    )
    return f"flatten(list_transform({words_of(f'lower({text})')}, lambda w: {per_word}))"


CTES: dict[str, str] = {}

CTES["raw_reviews"] = """
SELECT d.doc_id AS id, d.text AS review,
       CASE l.quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
CTES["whole_reviews"] = "SELECT * FROM raw_reviews WHERE review IS NOT NULL AND sentiment IS NOT NULL"
CTES["reviews"] = """
SELECT id, review, sentiment
FROM (SELECT *, row_number() OVER (PARTITION BY review ORDER BY id) AS copy FROM whole_reviews)
WHERE copy = 1"""
CTES["class_sizes"] = "SELECT sentiment, count(*) AS n FROM reviews GROUP BY sentiment"


def apportioned(source: str, size: str, draws: str, out: str) -> str:
    return f"""
SELECT * EXCLUDE (ideal, draws),
       CAST(floor(ideal) AS BIGINT)
       + CAST(row_number() OVER (ORDER BY ideal - floor(ideal) DESC, sentiment)
              <= draws - sum(floor(ideal)) OVER () AS BIGINT) AS {out}
FROM (SELECT s.*, {draws} AS draws,
             CAST({size} AS DOUBLE) / sum({size}) OVER () * {draws} AS ideal FROM {source} s)"""


_REST = f"(SELECT sum(n) - CAST(ceil({SPLIT.test_size}::DOUBLE * sum(n)) AS BIGINT) FROM class_sizes)"
_TRAIN = (
    f"(SELECT sum(rest) - CAST(ceil(({SPLIT.val_size}::DOUBLE / (1 - {SPLIT.test_size}::DOUBLE)) * sum(rest)) AS BIGINT)"
    " FROM rest_sizes)"
)
CTES["rest_sizes"] = apportioned("class_sizes", "n", _REST, "rest")
CTES["split_sizes"] = apportioned("rest_sizes", "rest", _TRAIN, "train")
CTES["splits"] = f"""
SELECT r.id, r.review, r.sentiment,
       CASE WHEN place <= n - rest THEN 'test' WHEN place <= n - train THEN 'val' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {order_key()}, id) AS place FROM reviews) r
JOIN split_sizes s ON r.sentiment = s.sentiment"""


def add_lemmas(prefix: str, source: str, known: str = "true", lexicon: str | None = None) -> None:
    """CTEs ``{prefix}_lemmas(term, lemma, n)`` and ``{prefix}_lemmatized`` over ``(id, text)``.

    The lexicon is that of the rows of ``source`` for which ``known`` holds, or another CTE.
    """
    rewritten = ", ".join(
        f"CASE WHEN ends_with(form, {quoted(old)}) THEN {{'place': {i}, "
        f"'form': left(form, length(form) - {len(old)}) || {quoted(new)}}} END"
        for i, (old, new) in enumerate(LEMMA_SUFFIXES, 1)
    )
    grown = f"unnest(list_filter([{rewritten}], lambda r: r IS NOT NULL))"
    CTES[f"{prefix}_words"] = f"""
SELECT id, unnest({words_of('text')}) AS term, generate_subscripts({words_of('text')}, 1) AS pos FROM {source}"""
    CTES[f"{prefix}_lexicon"] = f"SELECT form FROM {lexicon}" if lexicon else f"""
SELECT term AS form FROM (SELECT DISTINCT id, term FROM {prefix}_words SEMI JOIN (SELECT id FROM {source} WHERE {known}) USING (id))
GROUP BY term HAVING count(*) >= 2"""
    CTES[f"{prefix}_terms"] = f"""
SELECT term, count(*) AS n FROM {prefix}_words
WHERE ends_with(term, 's') OR ends_with(term, 'men') GROUP BY term"""
    # The rules may apply to their own results, so the reach is a recursive expression.
    CTES[f"{prefix}_reach"] = f"""
SELECT term, 0 AS round, CAST([0] AS INTEGER[]) AS place, term AS form FROM {prefix}_terms
UNION ALL
SELECT term, round + 1, list_append(place, r.place), r.form
FROM (SELECT term, round, place, {grown} AS r FROM {prefix}_reach)"""
    CTES[f"{prefix}_lemmas"] = f"""
SELECT t.term, coalesce(b.form, t.term) AS lemma, t.n
FROM {prefix}_terms t LEFT JOIN (
  SELECT term, form FROM (
    SELECT term, form, row_number() OVER (
      PARTITION BY term ORDER BY greatest(round, 1), length(form), place) AS choice
    FROM {prefix}_reach SEMI JOIN {prefix}_lexicon USING (form))
  WHERE choice = 1) b ON t.term = b.term"""
    CTES[f"{prefix}_lemmatized"] = f"""
SELECT s.id, coalesce(t.text, '') AS text
FROM {source} s LEFT JOIN (
  SELECT id, string_agg(coalesce(lemma, w.term), ' ' ORDER BY pos) AS text
  FROM {prefix}_words w LEFT JOIN {prefix}_lemmas l ON w.term = l.term GROUP BY id) t ON s.id = t.id"""


CTES["plain"] = f"SELECT doc_id AS id, {standard('text')} AS text FROM documents"
CTES["terse"] = f"SELECT doc_id AS id, {aggressive('text')} AS text FROM documents"
add_lemmas("plain", "plain")
add_lemmas("terse", "terse")
CTES["clean_documents"] = "SELECT id, text AS clean_review FROM plain_lemmatized"
# Models know the words of the training rows, whatever text they clean.
CTES["split_plain"] = f"SELECT id, split, {standard('review')} AS text FROM splits"
add_lemmas("split", "split_plain", "split = 'train'")
CTES["cleaned"] = """
SELECT id, split, CASE sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'negative' THEN 0.0::DOUBLE END AS label,
       text AS clean_review FROM splits JOIN split_lemmatized USING (id)"""
add_lemmas("scored_doc", "plain", lexicon="split_lexicon")
CTES["scored_documents"] = "SELECT id, text AS clean_review FROM scored_doc_lemmatized"


def add_features(prefix: str, source: str, tokens: str, grams: str, config: FeatureConfig, fitted_on: str = "true") -> None:
    """CTEs from ``(id, ..., text)`` to ``{prefix}_vocabulary`` and ``{prefix}_weights``."""
    CTES[f"{prefix}_grams"] = f"SELECT id, {grams} AS terms FROM (SELECT id, {tokens} AS t FROM {source})"
    CTES[f"{prefix}_counts"] = f"""
SELECT id, term, count(*) AS n FROM (SELECT id, unnest(terms) AS term FROM {prefix}_grams) GROUP BY id, term"""
    CTES[f"{prefix}_fitted"] = f"SELECT id FROM {source} WHERE {fitted_on}"
    CTES[f"{prefix}_vocabulary"] = f"""
SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
       ln((1.0 + n_docs) / (1.0 + df)) + 1.0 AS idf
FROM (SELECT term, count(*) AS df, CAST(sum(n) AS BIGINT) AS cf, (SELECT count(*) FROM {prefix}_fitted)::DOUBLE AS n_docs
      FROM {prefix}_counts SEMI JOIN {prefix}_fitted USING (id)
      GROUP BY term
      HAVING df >= {config.min_df} AND df <= {config.max_df}::DOUBLE * n_docs
      ORDER BY cf DESC, term LIMIT {config.max_features})"""
    tf = "(1.0 + ln(n))" if config.sublinear_tf else "n"
    if config.strategy == "count":
        CTES[f"{prefix}_weights"] = f"""
SELECT id, term, idx, CAST(n AS DOUBLE) AS weight FROM {prefix}_counts JOIN {prefix}_vocabulary USING (term)"""
    else:
        CTES[f"{prefix}_weights"] = f"""
SELECT id, term, idx, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight
FROM (SELECT id, term, idx, {tf} * idf AS w FROM {prefix}_counts JOIN {prefix}_vocabulary USING (term))"""


PAIRS = ngrams_of("t", *WORDS.ngram_range)

CTES["texts"] = "SELECT doc_id AS id, text FROM documents"
UNIGRAMS = FeatureConfig(ngram_range=(1, 1))
add_features("doc", "texts", tokens_of("text"), PAIRS, WORDS)
add_features("cap", "texts", tokens_of("text"), PAIRS, FeatureConfig(max_features=500))
add_features("raw", "texts", tokens_of("text"), "t", FeatureConfig(ngram_range=(1, 1), sublinear_tf=False))
add_features("uni", "clean_documents", tokens_of("clean_review"), "t", UNIGRAMS)
add_features("char", "texts", char_ngrams_of("text"), "t", FeatureConfig(strategy="tfidf_char"))
add_features("nb", "cleaned", tokens_of("clean_review"), PAIRS, WORDS, "split = 'train'")
add_features("cnt", "cleaned", tokens_of("clean_review"), PAIRS, FeatureConfig(strategy="count"), "split = 'train'")
# Unlabelled texts scored with the vocabulary of the training rows.
add_features("talk", "talk", tokens_of("clean_review"), PAIRS, WORDS)
add_features("all", "scored_documents", tokens_of("clean_review"), PAIRS, WORDS)
CTES["said"] = """
SELECT row_number() OVER (ORDER BY conv_id, turn, role, text) AS id, conv_id, turn, text FROM conversations"""
CTES["talk_words"] = f"SELECT id, {standard('text')} AS text FROM said"
add_lemmas("said", "talk_words", lexicon="split_lexicon")
CTES["talk"] = """
SELECT s.id, conv_id, turn, s.text, l.text AS clean_review FROM said s JOIN said_lemmatized l ON s.id = l.id"""
for _prefix in ("talk", "all"):
    CTES[f"{_prefix}_weights"] = CTES[f"{_prefix}_weights"].replace(f"{_prefix}_vocabulary", "nb_vocabulary")

CTES["balance"] = """
SELECT label, count(*) AS n, sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight
FROM cleaned WHERE split = 'train' GROUP BY label"""


def add_bayes(prefix: str, features: str, weighted: bool = False) -> None:
    """CTEs ``{prefix}_model`` (weight per term) and ``{prefix}_prior`` (intercept)."""
    factor = "b.weight" if weighted else "1.0::DOUBLE"
    CTES[f"{prefix}_mass"] = f"""
SELECT v.term, coalesce(sum(w.weight * {factor}) FILTER (c.label = 0), 0) + 1.0 AS mass_0,
       coalesce(sum(w.weight * {factor}) FILTER (c.label = 1), 0) + 1.0 AS mass_1
FROM {features}_vocabulary v
LEFT JOIN {features}_weights w ON v.term = w.term
LEFT JOIN (SELECT id, label FROM cleaned WHERE split = 'train') c ON w.id = c.id
LEFT JOIN balance b ON c.label = b.label
GROUP BY v.term"""
    CTES[f"{prefix}_model"] = f"""
SELECT term, (ln(mass_1) - ln(sum(mass_1) OVER ())) - (ln(mass_0) - ln(sum(mass_0) OVER ())) AS slope
FROM {prefix}_mass"""
    CTES[f"{prefix}_prior"] = f"""
SELECT ln(sum({factor}) FILTER (c.label = 1)) - ln(sum({factor}) FILTER (c.label = 0)) AS intercept
FROM cleaned c JOIN balance b ON c.label = b.label WHERE c.split = 'train'"""


def margins(prefix: str, features: str, source: str, keep: str, where: str = "true") -> str:
    return f"""
SELECT {keep}, coalesce(m.total, 0) + (SELECT intercept FROM {prefix}_prior) AS margin
FROM {source} s LEFT JOIN (
  SELECT id, sum(weight * slope) AS total FROM {features}_weights JOIN {prefix}_model USING (term) GROUP BY id
) m ON s.id = m.id WHERE {where}"""


add_bayes("tfidf_nb", "nb")
add_bayes("count_nb", "cnt")
add_bayes("weighted_nb", "nb", weighted=True)
CTES["variants"] = " UNION ALL ".join(
    margins(f"{v}_nb", f, "cleaned", f"'{v}' AS variant, s.split, s.id, s.label", "s.split <> 'train'")
    for v, f in (("tfidf", "nb"), ("count", "cnt"), ("weighted", "nb"))
)
CTES["scored"] = f"SELECT *, {rounded('margin', 9)} AS score FROM variants"
CTES["graded"] = """
SELECT s.variant, s.split, c.cut, s.id, s.label,
       CAST(s.score > CASE c.cut WHEN 'zero' THEN 0.0 ELSE m.median END AS DOUBLE) AS prediction, s.score
FROM scored s
JOIN (SELECT variant, split, quantile_cont(score, 0.5) AS median FROM scored GROUP BY variant, split) m
  ON s.variant = m.variant AND s.split = m.split
CROSS JOIN (SELECT unnest(['zero', 'median']) AS cut) c"""
CTES["cells"] = """
SELECT variant, split, cut,
       count(*) FILTER (label = 0 AND prediction = 0) AS tn, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
       count(*) FILTER (label = 1 AND prediction = 0) AS fn, count(*) FILTER (label = 1 AND prediction = 1) AS tp
FROM graded GROUP BY variant, split, cut"""
CTES["ranked"] = """
SELECT variant, split, score, pos, neg,
       sum(pos) OVER down AS pos_from, sum(neg) OVER down AS neg_from,
       sum(pos) OVER whole AS n_pos, sum(neg) OVER whole AS n_neg
FROM (SELECT variant, split, score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
      FROM scored GROUP BY variant, split, score)
WINDOW down AS (PARTITION BY variant, split ORDER BY score DESC), whole AS (PARTITION BY variant, split)"""
_AREA = "CAST(sum(pos * (n_neg - neg_from + neg / 2.0)) AS DOUBLE) / (CAST(max(n_pos) AS DOUBLE) * max(n_neg))"
CTES["areas"] = f"""
SELECT variant, split, CASE WHEN max(n_pos) * max(n_neg) > 0 THEN {rounded(_AREA, 4)} END AS roc_auc
FROM ranked GROUP BY variant, split"""
_ACC = "CAST(tp + tn AS DOUBLE) / (tp + tn + fp + fn)"
_PRECISION = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0.0)"
_RECALL = "coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0.0)"
_F1 = "coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0.0)"
_METRICS = (
    f"{rounded(_ACC, 4)} AS accuracy, {rounded(_PRECISION, 4)} AS precision, "
    f"{rounded(_RECALL, 4)} AS recall, {rounded(_F1, 4)} AS f1"
)
CTES["metrics"] = f"""
SELECT c.variant AS model, c.split, c.cut, {_METRICS}, roc_auc
FROM cells c JOIN areas a ON c.variant = a.variant AND c.split = a.split"""


def probability(margin: str = "margin", digits: int = 4) -> str:
    return rounded(f"(1.0 / (1.0 + exp(-({margin}))))", digits)


_LABEL = f"CASE WHEN {rounded('margin', 9)} > 0 THEN 'positive' ELSE 'negative' END"
CTES["held_out"] = margins("tfidf_nb", "nb", "cleaned", "s.id, s.split, s.label", "s.split = 'test'")
CTES["talk_scored"] = margins("tfidf_nb", "talk", "talk", "s.id, s.conv_id, s.turn, s.text")
CTES["all_scored"] = margins("tfidf_nb", "all", "scored_documents", "s.id")


# ------------------------------------------------------------------ profile

CTES["train_reviews"] = "SELECT id, review, sentiment FROM splits WHERE split = 'train'"
CTES["raw_words"] = f"SELECT id, {standard('review')} AS text FROM raw_reviews"
CTES["train_words"] = f"SELECT id, {standard('review')} AS text FROM train_reviews"
add_lemmas("raw_text", "raw_words")
add_lemmas("train_text", "train_words")
CTES["clean_reviews"] = """
SELECT r.id, review, sentiment, text AS clean_review FROM raw_reviews r JOIN raw_text_lemmatized l ON r.id = l.id"""
CTES["train_clean"] = """
SELECT r.id, sentiment, text AS clean_review FROM train_reviews r JOIN train_text_lemmatized l ON r.id = l.id"""
_CHARS = "length(coalesce(review, ''))"
_WORDS = f"len({words_of("coalesce(review, '')")})"


def overview(source: str) -> str:
    columns = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS dtype"
        for c, t in (("id", "bigint"), ("review", "string"), ("sentiment", "string"))
    )
    return f"SELECT c.column_name, c.dtype, (SELECT count(*) FROM {source}) AS n_rows, CAST(3 AS BIGINT) AS n_columns FROM ({columns}) c"


def missing(source: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, "
        f"{rounded(f'((count(*) - count({c})) * 100.0::DOUBLE / count(*))', 3)} AS pct_missing FROM {source}"
        for c in ("id", "review", "sentiment")
    )


def duplicates(source: str) -> str:
    return f"""SELECT n_rows, n_duplicates, {rounded('(n_duplicates * 100.0::DOUBLE / n_rows)', 3)} AS pct_duplicates
FROM (SELECT count(*) AS n_rows, count(*) - count(DISTINCT review) - CAST(count(*) > count(review) AS BIGINT) AS n_duplicates
      FROM {source})"""


def distribution(source: str) -> str:
    return f"""SELECT sentiment, n, {rounded('(n * 100.0::DOUBLE / total)', 2)} AS pct
FROM (SELECT sentiment, count(*) AS n, sum(count(*)) OVER () AS total FROM {source} GROUP BY sentiment)
WHERE sentiment IS NOT NULL"""


def described(value: str, source: str, by: str = "") -> str:
    key, group, where = (f"{by}, ", f"GROUP BY {by}", f"WHERE {by} IS NOT NULL") if by else ("", "", "")
    stats = {
        "count": "count(*)", "mean": "avg(v)", "std": "stddev_samp(v)", "min": "min(v)",
        "q25": "quantile_cont(v, 0.25)", "q50": "quantile_cont(v, 0.5)", "q75": "quantile_cont(v, 0.75)", "max": "max(v)",
    }
    columns = ", ".join(f"{rounded(f'CAST({e} AS DOUBLE)', 2)} AS {n}" for n, e in stats.items())
    return f"SELECT {key}{columns} FROM (SELECT {key}CAST({value} AS DOUBLE) AS v FROM {source} {where}) {group}"


def binned(value: str, source: str, bins: int = PROFILE.histogram_bins) -> str:
    edge = "low + width * {} / %d" % bins
    return f"""SELECT CAST(b.bin AS BIGINT) AS bin, {rounded(f'({edge.format("b.bin")})', 6)} AS bin_start,
       {rounded(f'({edge.format("(b.bin + 1)")})', 6)} AS bin_end, count(v.v) AS n
FROM (SELECT CASE WHEN max(v) = min(v) THEN min(v) - 0.5 ELSE min(v) END AS low,
             CASE WHEN max(v) = min(v) THEN 1.0 ELSE max(v) - min(v) END AS width
      FROM (SELECT CAST({value} AS DOUBLE) AS v FROM {source})) e
CROSS JOIN (SELECT unnest(range(0, {bins})) AS bin) b
LEFT JOIN (SELECT CAST({value} AS DOUBLE) AS v FROM {source}) v
  ON least(floor((v.v - e.low) / e.width * {bins}), {bins - 1}) = b.bin
GROUP BY b.bin, low, width"""


def boxes(source: str) -> str:
    return f"""SELECT sentiment, q25, q50, q75,
       least(min(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)), q25) AS whisker_low,
       greatest(max(v) FILTER (v BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)), q75) AS whisker_high,
       count(*) FILTER (v NOT BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25)) AS n_outliers
FROM (SELECT sentiment, v, quantile_cont(v, 0.25) OVER s AS q25, quantile_cont(v, 0.5) OVER s AS q50,
             quantile_cont(v, 0.75) OVER s AS q75
      FROM (SELECT sentiment, CAST({_WORDS} AS DOUBLE) AS v FROM {source} WHERE sentiment IS NOT NULL)
      WINDOW s AS (PARTITION BY sentiment))
GROUP BY sentiment, q25, q50, q75"""


def frequent(grams: str, source: str, k: int) -> str:
    return f"""SELECT term, count(*) AS n FROM (SELECT unnest({grams}) AS term FROM (
  SELECT {without(tokens_of('clean_review'), COUNTER_STOPWORDS)} AS t FROM {source}))
GROUP BY term ORDER BY n DESC, term LIMIT {k}"""


def class_terms(source: str, k: int = PROFILE.class_terms) -> str:
    return f"""SELECT sentiment, term, n, {rounded('(CAST(n AS DOUBLE) / best)', 6)} AS weight
FROM (SELECT sentiment, term, count(*) AS n, max(count(*)) OVER (PARTITION BY sentiment) AS best,
             row_number() OVER (PARTITION BY sentiment ORDER BY count(*) DESC, term) AS place
      FROM (SELECT sentiment, unnest({without(tokens_of('clean_review'), COUNTER_STOPWORDS)}) AS term
            FROM {source} WHERE sentiment IS NOT NULL)
      GROUP BY sentiment, term)
WHERE place <= {k}"""


INSPECTION = f"""SELECT split, sentiment, n, n_split, {rounded('(CAST(n AS DOUBLE) / n_split)', 3)} AS share
FROM (SELECT split, sentiment, count(*) AS n, CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS n_split
      FROM splits GROUP BY split, sentiment)"""


def sampled(source: str) -> str:
    return f"""SELECT id, sentiment, substring(review, 1, {PROFILE.snippet_chars}) AS review_snippet
FROM {source} ORDER BY {order_key(seed=PROFILE.seed)}, id LIMIT {PROFILE.sample_rows}"""


LOW, HIGH = PROFILE.ngram_range
SECTIONS = {
    "dataset_overview": (overview, ("column_name", "dtype"), ("n_rows", "n_columns")),
    "missing_values": (missing, ("column_name",), ("n_missing", "pct_missing")),
    "duplicate_stats": (duplicates, (), ("n_rows", "n_duplicates", "pct_duplicates")),
    "label_distribution": (distribution, ("sentiment",), ("n", "pct")),
    "char_length_stats": (lambda s: described(_CHARS, s), (), ("count", "mean", "std", "min", "q25", "q50", "q75", "max")),
    "word_count_stats": (lambda s: described(_WORDS, s), (), ("count", "mean", "std", "min", "q25", "q50", "q75", "max")),
    "length_histogram": (lambda s: binned(_CHARS, s), ("bin",), ("bin_start", "bin_end", "n")),
    "word_histogram": (lambda s: binned(_WORDS, s), ("bin",), ("bin_start", "bin_end", "n")),
    "classwise_word_stats": (
        lambda s: described(_WORDS, s, "sentiment"), ("sentiment",),
        ("count", "mean", "std", "min", "q25", "q50", "q75", "max"),
    ),
    "classwise_boxplot": (
        boxes, ("sentiment",), ("q25", "q50", "q75", "whisker_low", "whisker_high", "n_outliers"),
    ),
    "top_words": (lambda s: frequent("t", "train_clean", PROFILE.top_n_words), ("term",), ("n",)),
    "top_ngrams": (
        lambda s: frequent(ngrams_of("t", LOW, HIGH), "train_clean", PROFILE.top_n_ngrams), ("term",), ("n",),
    ),
    "class_term_freq": (lambda s: class_terms("train_clean"), ("sentiment", "term"), ("n", "weight")),
    "sample_reviews": (sampled, ("id", "sentiment", "review_snippet"), ()),
    "split_inspection": (lambda s: INSPECTION, ("split", "sentiment"), ("n", "n_split", "share")),
}


def tidy_report(source: str) -> str:
    parts = []
    for section, (build, keys, values) in SECTIONS.items():
        key = "concat_ws('|', " + ", ".join(f"CAST({k} AS VARCHAR)" for k in keys) + ")" if keys else "''"
        for value in values or ("row",):
            number = f'CAST("{value}" AS DOUBLE)' if values else "1.0::DOUBLE"
            parts.append(
                f"SELECT '{section}' AS section, {key} AS key, '{value}' AS stat, {number} AS value FROM ({build(source)})"
            )
    return " UNION ALL ".join(parts)


# ------------------------------------------------------------------ statements


def statement(sql: str) -> str:
    """``sql`` with the common table expressions it names, dependencies first."""
    order: list[str] = []

    def visit(text: str, above: tuple[str, ...]) -> None:
        for name, body in CTES.items():
            if name in order or name in above or not re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                continue
            visit(body, (*above, name))
            order.append(name)

    visit(sql, ())
    if not order:
        return sql
    recursive = "RECURSIVE " if any(n.endswith("_reach") for n in order) else ""
    return f"WITH {recursive}" + ",\n".join(f"{n} AS ({CTES[n]})" for n in order) + f"\n{sql}"


def listing(tokens: str, grams: str = "t") -> str:
    return f"""SELECT id, CAST(len(terms) AS BIGINT) AS n_terms, md5({joined('terms', chr(10))}) AS digest
FROM (SELECT id, {grams} AS terms FROM (SELECT doc_id AS id, {tokens} AS t FROM documents))"""


_IDF = rounded("idf", 6)
_WEIGHT = rounded("weight", 6)
_RANK = "CAST(row_number() OVER (ORDER BY f1 DESC, model) AS BIGINT) AS rank"
_MEASURES = "accuracy, precision, recall, f1, roc_auc"
_METRIC_COLUMNS = f"model, {_MEASURES}"
_CONFIDENCE = probability()

_SUBSET = f"""SELECT r.id, r.sentiment
FROM (SELECT *, row_number() OVER (PARTITION BY sentiment ORDER BY {order_key()}, id) AS place FROM reviews) r
JOIN class_sizes s ON r.sentiment = s.sentiment CROSS JOIN (SELECT sum(n) AS total FROM class_sizes) t
WHERE {SUBSET_ROWS} >= total OR place <= round_even({SUBSET_ROWS}::DOUBLE / total * n, 0)"""

_SELECTS: dict[str, str] = {
    "load_reviews": "SELECT id, review, sentiment FROM reviews",
    "normalize_columns": "SELECT id, review, sentiment FROM raw_reviews",
    "drop_missing": "SELECT id, review, sentiment FROM whole_reviews",
    "dedupe_reviews": """SELECT id, review, sentiment FROM (
  SELECT *, row_number() OVER (PARTITION BY review ORDER BY id) AS copy FROM raw_reviews) WHERE copy = 1""",
    "load_audit": """SELECT b.n AS rows_before, a.n AS rows_after, b.n - a.n AS rows_dropped
FROM (SELECT count(*) AS n FROM raw_reviews) b, (SELECT count(*) AS n FROM reviews) a""",
    "write_splits": "SELECT id, review, sentiment, split FROM splits",
    "load_splits": "SELECT id, review, sentiment, split FROM splits WHERE split = 'test'",
    "strip_html": f"SELECT page_id, {replaced('html', TAGS)} AS text FROM pages",
    "strip_urls": f"SELECT page_id, {replaced('html', URLS)} AS text FROM pages",
    "lowercase_text": "SELECT doc_id AS id, lower(text) AS text FROM documents",
    "strip_numbers": f"SELECT doc_id AS id, {replaced('text', NUMBERS)} AS text FROM documents",
    "strip_punct": f"SELECT doc_id AS id, {replaced('text', PUNCTUATION)} AS text FROM documents",
    "normalize_ws": f"SELECT doc_id AS id, {spaced('text')} AS text FROM documents",
    "remove_stopwords": "SELECT doc_id AS id, "
    + joined(without(words_of("lower(text)"), CLEANER_STOPWORDS))
    + " AS text FROM documents",
    "drop_short_tokens": "SELECT doc_id AS id, "
    + joined(f"list_filter({words_of('text')}, lambda w: length(w) >= 3)")
    + " AS text FROM documents",
    "clean_minimal": f"SELECT page_id, {minimal('html')} AS text FROM pages",
    "clean_standard": "SELECT id, text AS clean_review FROM plain_lemmatized",
    "clean_aggressive": "SELECT id, text AS clean_review FROM terse_lemmatized",
    "clean_table": "SELECT id, review, sentiment, clean_review FROM clean_reviews",
    "empty_after_clean": """SELECT count(*) AS n_rows, count(*) FILTER (trim(clean_review) = '') AS n_empty
FROM clean_reviews""",
    "lemmatize_tokens": "SELECT term, lemma, n FROM plain_lemmas",
    "lexicon_join": """SELECT coalesce(l.lemma, t.term) AS lemma, CAST(sum(t.n) AS BIGINT) AS n, count(*) AS n_forms
FROM (SELECT term, count(*) AS n FROM plain_words GROUP BY term) t LEFT JOIN plain_lemmas l ON t.term = l.term
GROUP BY 1""",
    "stopword_antijoin": f"""SELECT term, count(*) AS n
FROM (SELECT unnest({words_of('lower(text)')}) AS term FROM documents)
WHERE NOT list_contains({listed(CLEANER_STOPWORDS)}, term) GROUP BY term""",
    "label_encode": """SELECT id, sentiment,
       CASE sentiment WHEN 'positive' THEN 1.0::DOUBLE WHEN 'negative' THEN 0.0::DOUBLE END AS label FROM raw_reviews""",
    "label_decode": """SELECT doc_id, quality, CASE quality WHEN 1 THEN 'positive' WHEN 0 THEN 'negative' END AS sentiment
FROM labels""",
    "vocab_join": """SELECT c.id, c.term, v.idx, c.n FROM nb_counts c JOIN nb_vocabulary v ON c.term = v.term
JOIN cleaned d ON c.id = d.id WHERE d.split = 'test'""",
    "top_words": frequent("t", "clean_documents", PROFILE.top_n_words),
    "top_ngrams": frequent(ngrams_of("t", LOW, HIGH), "clean_documents", PROFILE.top_n_ngrams),
    "ngram_stopwords": f"""SELECT doc_id AS id, CAST(len(t) AS BIGINT) AS n, {joined('t')} AS tokens
FROM (SELECT doc_id, {without(tokens_of('text'), COUNTER_STOPWORDS)} AS t FROM documents)""",
    "class_term_freq": class_terms("clean_reviews"),
    "split_inspection": INSPECTION,
    "profile_report": tidy_report("train_reviews"),
    "eda_sink": tidy_report("train_reviews"),
    "stratified_subset": _SUBSET,
    "stratified_split": "SELECT id, sentiment, split FROM splits",
    "sample_reviews": sampled("raw_reviews"),
    "word_tokens": listing(tokens_of("text")),
    "word_ngrams": listing(tokens_of("text"), ngrams_of("t", 1, 3)),
    "char_wb_ngrams": listing(char_ngrams_of("text")),
    "char_ngram_statistics": "SELECT term, count(*) AS df, CAST(sum(n) AS BIGINT) AS cf FROM char_counts GROUP BY term",
    "count_features": "SELECT id, term, n FROM uni_counts",
    "vocab_fit": f"SELECT term, idx, df, cf, {_IDF} AS idf FROM doc_vocabulary",
    "vocab_cap": f"SELECT term, idx, df, cf, {_IDF} AS idf FROM cap_vocabulary",
    "tfidf_features": f"SELECT id, term, {_WEIGHT} AS weight FROM doc_weights",
    "tfidf_without_sublinear": f"SELECT id, term, {_WEIGHT} AS weight FROM raw_weights",
    "sublinear_tf": f"""SELECT id, count(*) AS n_terms, {rounded('sum(1.0 + ln(n))', 6)} AS damped
FROM raw_counts GROUP BY id""",
    "tfidf_char_features": f"""SELECT id, count(*) AS n_terms, {rounded('sum(weight)', 6)} AS total
FROM char_weights GROUP BY id""",
    "l2_normalize": f"""SELECT t.id, {rounded('sqrt(coalesce(sum(w.weight * w.weight), 0))', 6)} AS norm
FROM texts t LEFT JOIN doc_weights w ON t.id = w.id GROUP BY t.id""",
    "transform_split": f"""SELECT c.id, c.split, count(w.term) AS n_terms, {rounded('coalesce(sum(w.weight), 0)', 6)} AS total
FROM cleaned c LEFT JOIN nb_weights w ON c.id = w.id WHERE c.split <> 'train' GROUP BY c.id, c.split""",
    "feature_vectors": f"""SELECT w.id, c.split, w.idx, {rounded('w.weight', 6)} AS weight
FROM nb_weights w JOIN cleaned c ON w.id = c.id""",
    "class_weights": f"""SELECT label, n, {rounded('(CAST(total AS DOUBLE) / (classes * n))', 6)} AS weight
FROM (SELECT CASE sentiment WHEN 'positive' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label, n,
             sum(n) OVER () AS total, count(*) OVER () AS classes FROM class_sizes)""",
    "multinomial_nb": f"""SELECT id, label, CAST({rounded('margin', 9)} > 0 AS DOUBLE) AS prediction,
       {probability(digits=6)} AS score FROM held_out""",
    "train_all_bayes": f"""SELECT 'multinomial_nb' AS model, id, label, CAST({rounded('margin', 9)} > 0 AS DOUBLE) AS prediction,
       {probability(digits=6)} AS score FROM variants WHERE variant = 'tfidf' AND split = 'val'""",
    "train_job_bayes": f"""SELECT 'multinomial_nb' AS model, {_MEASURES}, CAST(1 AS BIGINT) AS rank, true AS champion
FROM metrics WHERE model = 'tfidf' AND split = 'val' AND cut = 'zero'""",
    "evaluate_test_bayes": f"""SELECT 'multinomial_nb' AS model, {_MEASURES}, CAST(1 AS BIGINT) AS rank
FROM metrics WHERE model = 'tfidf' AND split = 'test' AND cut = 'zero'""",
    "confusion_matrix": " UNION ALL ".join(
        f"SELECT variant, split, cut, CAST({a} AS INTEGER) AS actual, CAST({b} AS INTEGER) AS predicted, {c} AS n FROM cells"
        for a, b, c in ((0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp"))
    ),
    "accuracy": f"SELECT variant, split, cut, {rounded(_ACC, 4)} AS accuracy FROM cells",
    "precision_recall_f1": f"""SELECT variant, split, cut, {rounded(_PRECISION, 4)} AS precision,
       {rounded(_RECALL, 4)} AS recall, {rounded(_F1, 4)} AS f1 FROM cells""",
    "roc_auc": "SELECT variant, split, roc_auc FROM areas",
    "roc_curve": f"""SELECT variant, split, {rounded('score', 6)} AS threshold,
       {rounded('(CAST(neg_from AS DOUBLE) / n_neg)', 6)} AS fpr, {rounded('(CAST(pos_from AS DOUBLE) / n_pos)', 6)} AS tpr
FROM ranked UNION ALL SELECT DISTINCT variant, split, CAST(NULL AS DOUBLE), 0.0::DOUBLE, 0.0::DOUBLE FROM ranked""",
    "score_column": f"SELECT variant, split, id, {probability(digits=6)} AS score FROM variants",
    "comparison_table": f"SELECT {_METRIC_COLUMNS}, {_RANK} FROM metrics WHERE split = 'val' AND cut = 'median'",
    "model_comparison": f"SELECT {_METRIC_COLUMNS}, {_RANK} FROM metrics WHERE split = 'test' AND cut = 'zero'",
    "select_best": f"""SELECT {_METRIC_COLUMNS} FROM metrics WHERE split = 'val' AND cut = 'median'
ORDER BY accuracy DESC NULLS LAST, list_position(['weighted', 'tfidf', 'count'], model) LIMIT 1""",
    "metrics_sink": f"SELECT {_METRIC_COLUMNS} FROM metrics WHERE split = 'test' AND cut = 'median'",
    "attach_predictions": f"""SELECT d.doc_id AS id, d.lang, d.source, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence
FROM documents d JOIN all_scored s ON d.doc_id = s.id""",
    "score_table": f"""SELECT d.doc_id, d.source, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence
FROM documents d JOIN all_scored s ON d.doc_id = s.id""",
    "write_model": f"""SELECT h.id, r.sentiment, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence
FROM held_out h JOIN splits r ON h.id = r.id""",
    "predict_with_model": f"""SELECT md5(r.review) AS text_digest, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence,
       'multinomial_nb' AS model_used FROM held_out h JOIN splits r ON h.id = r.id""",
    "predict_batch": f"""SELECT text, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence,
       'multinomial_nb' AS model_used FROM talk_scored""",
    "confidence": f"""SELECT conv_id, turn, confidence,
       {rounded("(CASE WHEN predicted_label = 'positive' THEN confidence ELSE 1.0 - confidence END)", 4)} AS label_confidence
FROM (SELECT conv_id, turn, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence FROM talk_scored)""",
    "preview": f"""SELECT id, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence
FROM all_scored ORDER BY id LIMIT 10""",
    "score_stream": f"""SELECT conv_id, turn, {_LABEL} AS predicted_label, {_CONFIDENCE} AS confidence FROM talk_scored""",
}
for _name in (
    "dataset_overview", "missing_values", "duplicate_stats", "label_distribution", "char_length_stats",
    "word_count_stats", "length_histogram", "word_histogram", "classwise_word_stats", "classwise_boxplot",
):
    _SELECTS[_name] = SECTIONS[_name][0]("raw_reviews")

ORACLES: dict[str, str] = {name: statement(sql) for name, sql in _SELECTS.items()}
