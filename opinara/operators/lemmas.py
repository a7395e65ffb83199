"""Noun lemmas by a dictionary.

A term's candidates are the term itself and what the suffix rules make of it; the candidates found
in a lexicon of known forms compete, and the shortest wins. All of it works on distinct terms, of
which those that change are a dictionary. Rows probe it in place (see ``dictionary``). Of one too
large to travel, the most frequent terms travel, and only the rare words of a row are looked up by
a join on the word, whose keys are all rare: a frequent word is never a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opinara.functions.rows import element_rows, struct_rows
from opinara.functions.text import joined_words, split_words
from opinara.operators.dictionary import MOST_CHARS, MOST_ENTRIES, Lookup, dictionary
from opinara.staging import stage

# Noun suffixes and their replacements, in order of preference.
SUFFIX_RULES = (
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
)

#: Only terms with one of these endings can change by rule.
RULE_ENDINGS = ("s", "men")


def can_change(term: Column) -> Column:
    found = F.lit(False)
    for ending in RULE_ENDINGS:
        found = found | term.endswith(ending)
    return found


def _rewritten(form: Column) -> Column:
    """What each matching rule makes of ``form``, in rule order."""
    made = [
        F.when(form.endswith(old), F.concat(F.substring(form, F.lit(1), F.length(form) - len(old)), F.lit(new)))
        for old, new in SUFFIX_RULES
    ]
    return F.filter(F.array(*made), lambda x: x.isNotNull())


def candidates(term: Column) -> Column:
    """Array of ``(round, place, form)``: the term and every form the rules reach.

    The term competes with the forms of the first round. Later rounds rewrite the forms of the
    round before and count only if no earlier round is known.
    """
    entry = "array<struct<round:int,place:int,form:string>>"
    start = F.struct(
        F.array(term).alias("forms"),
        F.array(F.struct(F.lit(1).alias("round"), F.lit(0).alias("place"), term.alias("form"))).cast(entry).alias("found"),
    )

    def grow(state: Column, step: Column) -> Column:
        forms = F.flatten(F.transform(state["forms"], _rewritten))
        new = F.transform(forms, lambda f, i: F.struct(step.alias("round"), (i + 1).alias("place"), f.alias("form")))
        return F.struct(forms.alias("forms"), F.concat(state["found"], new.cast(entry)).alias("found"))

    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(term), F.lit(1))), start, grow, lambda s: s["found"])


def corpus_lexicon(df: DataFrame, text: str, min_docs: int = 2) -> DataFrame:
    """``(form)``: terms of the corpus found in at least ``min_docs`` rows."""
    terms = element_rows(df, F.array_distinct(split_words(F.col(text))), "form")
    return terms.groupBy("form").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("form")


def term_frequencies(df: DataFrame, text: str, changeable_only: bool = False) -> DataFrame:
    words = split_words(F.col(text))
    tokens = element_rows(df, F.filter(words, can_change) if changeable_only else words, "term")
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def row_frequencies(rows: DataFrame, text: str, changeable_only: bool = False) -> DataFrame:
    """``(term, n)``: rows with each word of a cleaned text, in one pass; written once."""
    words = joined_words(F.col(text))
    tokens = element_rows(rows, F.array_distinct(F.filter(words, can_change) if changeable_only else words), "term")
    counts = tokens.where("term <> ''").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return stage(counts, "terms")


def recurring_forms(frequencies: DataFrame, min_docs: int = 2) -> DataFrame:
    """As ``corpus_lexicon``, of ``row_frequencies``."""
    return frequencies.where(F.col("n") >= min_docs).select(F.col("term").alias("form"))


def lemma_table(terms: DataFrame, lexicon: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """``(term, lemma, n)`` for every term of ``(term, n)`` that may change by rule.

    With exceptions every term is listed. ``exceptions(form, lemma)`` lists irregular forms; a listed term takes the shortest of itself
    and its listed lemmas that the lexicon knows, and skips the rules. A term nothing is known
    about keeps its form.
    """
    by_rule = terms.where(can_change(F.col("term")))
    listed = None
    if exceptions is not None:
        irregular = exceptions.select(F.col("form").alias("term"), F.col("lemma").alias("form")).distinct()
        by_rule = by_rule.join(irregular.select("term").distinct(), "term", "left_anti")
        listed_terms = terms.join(irregular.select("term").distinct(), "term", "left_semi")
        round_one = F.lit(1).alias("round")
        listed = listed_terms.select("term", "n", round_one, F.lit(0).alias("place"), F.col("term").alias("form")).union(
            listed_terms.join(irregular, "term").select("term", "n", round_one, F.lit(1).alias("place"), "form")
        )
    reached = struct_rows(by_rule, candidates(F.col("term")), "term", "n", required="form")
    if listed is not None:
        reached = reached.unionByName(listed)
    known = reached.join(lexicon.select("form").distinct(), "form", "left_semi")
    best = known.groupBy("term").agg(
        F.min(F.struct("round", F.length("form").alias("chars"), "place", "form")).alias("best")
    )
    subject = by_rule if listed is None else terms
    return subject.join(best, "term", "left").select(
        "term", F.coalesce("best.form", "term").alias("lemma"), "n"
    )


#: Column that tells the rows of a written table apart.
ROW = "__row"


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once, with a number per row."""
    return stage(df.withColumn(ROW, F.monotonically_increasing_id()), name)


def _with_lemmas(rows: DataFrame, text: str, lemma: Lookup, may_change: Lookup, joined: bool = False) -> DataFrame:
    """``text`` with ``lemma(word)`` for every word that may change; null leaves a word as it is.

    A ``joined`` text is its words with single spaces, and need not be kept where no word changes.
    """
    words = joined_words(F.col(text)) if joined else split_words(F.col(text))
    new = F.transform(words, lambda w: F.when(may_change(w), F.coalesce(lemma(w), w)).otherwise(w))
    if joined:
        return rows.withColumn(text, F.array_join(new, " "))
    return rows.withColumn(text, F.when(F.exists(words, may_change), F.array_join(new, " ")).otherwise(F.col(text)))


def lemmatize(
    rows: DataFrame, text: str, lemmas: DataFrame, by_rule_only: bool = True, most: int = MOST_ENTRIES,
    joined: bool = False,
) -> DataFrame:
    """Replace every word of ``text`` by its lemma, keeping word order and every row.

    ``rows`` is a ``numbered`` table; the number is dropped. ``lemmas(term, lemma, n)`` lists every
    term that may change; words it does not list pass through. Without exceptions only words with a
    rule ending are looked up (``by_rule_only``). Up to ``most`` terms travel to the rows; no row is
    exchanged unless there are more. ``joined`` tells that words have single spaces between them.
    """
    may_change: Lookup = can_change if by_rule_only else lambda word: F.lit(True)
    known = stage(lemmas.select("term", "lemma", "n"), "lemmas")
    changed = known.where("lemma <> term").select("term", "lemma")
    lookup = dictionary(changed, "term", "lemma", most)
    if lookup is not None:
        return _with_lemmas(rows, text, lookup, may_change, joined).drop(ROW)
    return _lemmatize_tiered(rows, text, known, may_change, most, joined)


def _lemmatize_tiered(
    rows: DataFrame, text: str, known: DataFrame, may_change: Lookup, most: int, joined: bool
) -> DataFrame:
    """The ``most`` most frequent terms, changed or not, in place; all others by a join."""
    tier = known.orderBy(F.desc("n"), "term").limit(most)
    # Long terms may need fewer entries to stay within the bound of characters.
    chars = tier.agg(F.max(F.char_length("term") + F.char_length("lemma"))).first()[0] or 1
    tier = stage(known.orderBy(F.desc("n"), "term").limit(max(1, min(most, MOST_CHARS // chars))), "frequent-lemmas")
    frequent = dictionary(tier, "term", "lemma", most)
    words = joined_words(F.col(text)) if joined else split_words(F.col(text))
    rare = F.filter(words, lambda w: may_change(w) & frequent(w).isNull())
    asked = element_rows(rows, F.array_distinct(rare), "term", ROW)
    changed = known.where("lemma <> term").select("term", "lemma")
    found = asked.join(changed, "term").groupBy(ROW).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "lemma"))).alias("__lemmas")
    )

    def lemma(word: Column) -> Column:
        return F.coalesce(frequent(word), F.try_element_at(F.col("__lemmas"), word))

    return _with_lemmas(rows.join(found, ROW, "left"), text, lemma, may_change, joined).drop(ROW, "__lemmas")


def lemma_of(word: Column, known: Lookup) -> Column:
    """The lemma of one word by the rules, given which forms are known; a word may be looked up
    without any table of terms, as a stream needs it."""
    found = F.filter(candidates(word), lambda c: known(c["form"]).isNotNull())
    order = F.transform(found, lambda c: F.struct(c["round"].alias("round"), F.length(c["form"]).alias("chars"), c["place"].alias("place"), c["form"].alias("form")))
    return F.array_min(order)["form"]


#: Forms of a lexicon that may travel to every task.
LEXICON_ENTRIES = MOST_ENTRIES


def lemmatize_in_place(df: DataFrame, text: str, lexicon: DataFrame) -> DataFrame | None:
    """As ``lemmatize`` by the rules alone, without a table of terms: a projection, for streams too.

    None if the lexicon is too large to travel.
    """
    lookup = dictionary(lexicon.select("form", F.lit(True).alias("known")).distinct(), "form", "known", LEXICON_ENTRIES)
    if lookup is None:
        return None
    return _with_lemmas(df, text, lambda word: lemma_of(word, lookup), can_change)
