"""Quality rules: base measures, and how far a document's histograms lie from its language's.

A document is compared with a reference of its language in two histograms: character classes, and
common words of the language against all other words. References are sums over every document of
the language that passes the base rules. The Jensen-Shannon distance (base 2, from 0 to 1) of each
decides, if the document is long enough for its histogram to mean something and the reference
rests on enough words. Expressions only; no row is exploded and no text is shuffled.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, SPACE, WORD, documents, whole_text, with_key, without_key
from opinara.staging import stage

# Frequent function words of four languages.
COMMON_WORDS = {
    "en": "the of and to in a is that it for was with as on be by this are or an".split(),
    "fr": "de la le et les des en un une du est que dans pour sur par au avec ce il".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als".split(),
    "es": "de la que el en y los del se las por un para con una su al es lo como".split(),
}
# Fixed value: symbols counted by the base measures.
SYMBOLS = r"[#*$%&|<>]+"

#: Lower case, upper case, digits, white space, other ASCII, everything else.
N_CLASSES = 6


@dataclass(frozen=True)
class QualityConfig:
    min_words: int = 50
    max_repeat_percent: int = 50
    #: Character classes are judged from so many words on, and rejected beyond this distance.
    min_words_for_classes: int = 50
    max_class_distance: float = 0.28
    #: The same for common words; short texts vary more.
    min_words_for_common: int = 100
    max_common_distance: float = 0.27
    #: Words a language's reference has to rest on.
    min_reference_words: int = 1000
    common_words: dict[str, list[str]] = field(default_factory=lambda: dict(COMMON_WORDS))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _removed(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def repeat_words(words: Column) -> Column:
    """Words within a window of three words that the array holds twice or more."""

    def windows(full: bool) -> Column:
        def window(i: Column) -> Column:
            three = [F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)]
            code = F.xxhash64(*three)
            if not full:
                return code
            return F.struct(code.alias("h"), *(w.alias(n) for w, n in zip(three, "abc")), i.alias("i"))

        return F.transform(F.sequence(F.lit(0), F.size(words) - 3), window)

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda x, j: same(x, F.get(s, j + 1)) | same(x, F.get(s, j - 1)))
        reach = F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))
        return F.size(F.array_distinct(F.flatten(reach)))

    some = let(windows(False), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    return (
        F.when(F.size(words) < 4, F.lit(0))
        .when(some, let(F.sort_array(windows(True)), covered))
        .otherwise(F.lit(0))
        .cast("long")
    )


def measures(text: Column, lang: Column, common_words: dict[str, list[str]]) -> Column:
    """A struct of the base measures and the two histograms; a null text counts as empty."""
    text = whole_text(text)
    lists = F.create_map(*(x for k, v in common_words.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    vocabulary = sorted({w for v in common_words.values() for w in v})

    def repeated_lines(lines: Column) -> Column:
        with_word = F.filter(lines, lambda x: x.rlike(WORD))
        return let(with_word, lambda x: F.size(x) - F.size(F.array_distinct(x)))

    def of_words(words: Column) -> Column:
        joined = F.array_join(words, "")

        def classes(j: Column) -> Column:
            return let(
                F.array(j, _removed(j, "[a-z]+")),
                lambda a: let(
                    F.array(a[1], _removed(a[1], "[A-Z]+")),
                    lambda b: let(
                        F.array(b[1], _removed(b[1], "[0-9]+")),
                        lambda c: let(
                            _removed(c[1], r"[\x00-\x7F]+"),
                            lambda rest: F.struct(
                                F.length(j).cast("long").alias("word_chars"),
                                (F.length(c[1]) - F.length(_removed(c[1], SYMBOLS))).cast("long").alias("n_symbols"),
                                F.array(
                                    F.length(j) - F.length(a[1]),
                                    F.length(a[1]) - F.length(b[1]),
                                    F.length(b[1]) - F.length(c[1]),
                                    F.length(text) - F.length(j),
                                    F.length(c[1]) - F.length(rest),
                                    F.length(rest),
                                )
                                .cast("array<long>")
                                .alias("classes"),
                            ),
                        ),
                    ),
                ),
            )

        common = F.filter(F.split(F.lower(F.array_join(words, " ")), " "), lambda w: w.isin(vocabulary))
        counts = let(
            common,
            lambda found: F.transform(F.element_at(lists, lang), lambda w: F.size(found) - F.size(F.array_remove(found, w))),
        )
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            let(joined, classes).alias("chars"),
            repeat_words(words).alias("n_repeat_words"),
            counts.cast("array<long>").alias("common"),
        )

    return F.struct(
        let(F.array_remove(F.split(text, SPACE), ""), of_words).alias("words"),
        repeated_lines(F.split(text, "\n")).cast("long").alias("n_dup_lines"),
    )


def measure(docs: DataFrame, config: QualityConfig) -> DataFrame:
    """``__key, doc_id, lang`` and the measures of every row, written once."""
    m = F.col("m")
    rows = docs.select(KEY, "doc_id", "lang", measures(F.col("text"), F.col("lang"), config.common_words).alias("m"))
    flat = rows.select(
        KEY,
        "doc_id",
        "lang",
        m["words"]["n_words"].alias("n_words"),
        m["words"]["chars"]["word_chars"].alias("word_chars"),
        m["words"]["chars"]["n_symbols"].alias("n_symbols"),
        m["n_dup_lines"].alias("n_dup_lines"),
        m["words"]["n_repeat_words"].alias("n_repeat_words"),
        m["words"]["chars"]["classes"].alias("classes"),
        m["words"]["common"].alias("common"),
    )
    failed = (F.col("n_words") < config.min_words) | (
        100 * F.col("n_repeat_words") > config.max_repeat_percent * F.col("n_words")
    )
    return stage(flat.withColumn("base_failed", failed), "quality")


def references(rows: DataFrame, config: QualityConfig) -> DataFrame:
    """``(lang, ref_words, ref_classes, ref_common)``: sums over the rows that pass the base rules."""
    longest = max([0, *map(len, config.common_words.values())])
    sums = lambda name, n: F.array(*(F.sum(F.get(name, F.lit(i))) for i in range(n)))
    grouped = rows.where("not base_failed").groupBy("lang").agg(
        F.sum("n_words").alias("ref_words"),
        sums("classes", N_CLASSES).alias("ref_classes"),
        sums("common", longest).alias("ref_common"),
    )
    return stage(grouped.withColumnRenamed("lang", "ref_lang"), "quality-references")


def js_distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance of two arrays of counts, null if either has no mass."""

    def mass(a: Column) -> Column:
        return F.aggregate(a, F.lit(0.0), lambda t, x: t + x)

    def part(x: Column, y: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (x + y))).otherwise(0.0)

    def distance(tp: Column, tq: Column) -> Column:
        terms = F.zip_with(p, q, lambda x, y: (part(x / tp, y / tq) + part(y / tq, x / tp)) / 2)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda t, x: t + x)))

    return let(F.array(mass(p), mass(q)), lambda t: F.when((t[0] > 0) & (t[1] > 0), distance(t[0], t[1])))


def with_rest(counts: str, total: str) -> Column:
    """The non-null counts and what remains of the total."""
    known = F.filter(counts, lambda x: x.isNotNull())
    return F.concat(known, F.array(F.col(total) - F.aggregate(known, F.lit(0).cast("long"), lambda t, x: t + x)))


def quality_rules(docs: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """A row per row of ``docs``: key, id, measures, both distances and ``kept``.

    Null texts are empty and fail the base rules, as every text below ``min_words`` does. A null
    or unknown language has a reference of character classes only. A distance is null where its
    guard (length of the document, size of the reference) isn't met, and then rejects nothing.
    Texts of any length are measured whole, repeated rows are judged alike; an empty table gives no
    rows; other columns are ignored.
    """
    rows = measure(with_key(docs), config)
    known = references(rows, config)
    joined = rows.join(known, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    grounded = F.col("ref_words") >= config.min_reference_words
    classes = F.when(
        grounded & (F.col("n_words") >= config.min_words_for_classes), js_distance(F.col("classes"), F.col("ref_classes"))
    )
    common = F.when(
        grounded & (F.col("n_words") >= config.min_words_for_common) & F.col("common").isNotNull(),
        js_distance(with_rest("common", "n_words"), with_rest("ref_common", "ref_words")),
    )
    far = (F.coalesce(F.col("class_distance"), F.lit(0.0)) > config.max_class_distance) | (
        F.coalesce(F.col("common_distance"), F.lit(0.0)) > config.max_common_distance
    )
    return (
        joined.withColumn("class_distance", classes)
        .withColumn("common_distance", common)
        .withColumn("kept", ~F.col("base_failed") & ~far)
        .select(
            KEY, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
            "class_distance", "common_distance", "kept",
        )
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).drop(KEY, "class_distance", "common_distance")


def keep_good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents that the rules reject go.

    Null and empty texts, repeated rows and null ids follow the operator's rule; all columns are
    kept, whatever their names, and an empty table gives an empty one.
    """
    keyed = with_key(docs)
    good = quality_rules(keyed).where("kept").select(KEY)
    return without_key(keyed.join(good, KEY, "left_semi"), docs)


OP9_SQL = """
WITH vocabulary(lang, words) AS (VALUES
  ('en', string_split('the of and to in a is that it for was with as on be by this are or an', ' ')),
  ('fr', string_split('de la le et les des en un une du est que dans pour sur par au avec ce il', ' ')),
  ('de', string_split('der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als', ' ')),
  ('es', string_split('de la que el en y los del se las por un para con una su al es lo como', ' '))),
texts AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
tokens AS (SELECT doc_id, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM texts),
places AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM tokens WHERE len(w) > 2),
windows AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times FROM places),
repeats AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM windows WHERE times > 1) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM texts),
dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines
         WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
found AS (SELECT doc_id, lang, w, [unicode(c) FOR c IN regexp_extract_all(array_to_string(w, ''), '(?s).')] AS u, length(t) AS n
          FROM texts JOIN tokens USING (doc_id)),
counted AS (SELECT doc_id, f.lang, len(w) AS n_words, len(u) AS word_chars,
    len([x FOR x IN u IF chr(x) IN ('#', '*', '$', '%', '&', '|', '<', '>')]) AS n_symbols,
    [len([x FOR x IN u IF x BETWEEN 97 AND 122]), len([x FOR x IN u IF x BETWEEN 65 AND 90]),
     len([x FOR x IN u IF x BETWEEN 48 AND 57]), n - len(u),
     len([x FOR x IN u IF x < 128 AND NOT (x BETWEEN 97 AND 122 OR x BETWEEN 65 AND 90 OR x BETWEEN 48 AND 57)]),
     len([x FOR x IN u IF x > 127])] AS classes,
    CASE WHEN words IS NOT NULL THEN [len([x FOR x IN w IF lower(x) = c]) FOR c IN words] END AS common
  FROM found f LEFT JOIN vocabulary v ON f.lang = v.lang),
base AS (SELECT c.*, coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
  FROM counted c LEFT JOIN dups USING (doc_id) LEFT JOIN repeats USING (doc_id)),
sums AS (SELECT lang, sum(n_words) AS ref_words FROM base WHERE NOT base_failed GROUP BY lang),
class_items AS (SELECT doc_id, lang, base_failed, unnest(classes) AS x, unnest(range(len(classes))) AS k FROM base),
common_items AS (SELECT doc_id, lang, base_failed, unnest(common || [n_words - list_sum(common)]) AS x,
                        unnest(range(len(common) + 1)) AS k FROM base WHERE common IS NOT NULL),
items AS (SELECT 'class' AS kind, * FROM class_items UNION ALL SELECT 'common', * FROM common_items),
refs AS (SELECT kind, lang, k, sum(x) AS y FROM items WHERE NOT base_failed GROUP BY ALL),
shares AS (SELECT i.kind, doc_id, x / nullif(sum(x) OVER (PARTITION BY i.kind, doc_id), 0) AS p,
                  y / nullif(sum(y) OVER (PARTITION BY i.kind, doc_id), 0) AS q
           FROM items i JOIN refs r ON i.kind = r.kind AND i.k = r.k AND i.lang IS NOT DISTINCT FROM r.lang),
far AS (SELECT doc_id, kind, sqrt(greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS d FROM shares GROUP BY ALL)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed
  AND NOT coalesce(n_words >= 50 AND ref_words >= 1000 AND a.d > 0.28, FALSE)
  AND NOT coalesce(n_words >= 100 AND ref_words >= 1000 AND b.d > 0.27, FALSE) AS kept
FROM base LEFT JOIN sums ON base.lang IS NOT DISTINCT FROM sums.lang
LEFT JOIN (FROM far WHERE kind = 'class') a USING (doc_id) LEFT JOIN (FROM far WHERE kind = 'common') b USING (doc_id)
"""
