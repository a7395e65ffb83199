"""Text cleaning as Column expressions.

Configuration flags are read while the expression is built, so a disabled step never reaches the
plan. Character classes are written out: Java's ``\\w`` and ``\\s`` are ASCII.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, functions as F

from opinara.config import CleaningConfig
from opinara.functions.wordlists import CLEANER_STOPWORDS

# Members of the Unicode white-space class.
SPACE_CLASS = r"\t\n\x0B\f\r \x1C-\x1F\x{85}\p{Z}"
# Members of the Unicode word class.
WORD_CLASS = r"\p{L}\p{N}_"

TAG_PATTERN = r"<[^>\n]*>"
URL_PATTERN = rf"https?://[^{SPACE_CLASS}]+|www\.[^{SPACE_CLASS}]+"
NUMBER_PATTERN = r"\p{Nd}+"
PUNCT_PATTERN = rf"[^{WORD_CLASS}{SPACE_CLASS}]"
# Runs of word characters, and of those but digits; the first range answers for most characters.
WORD_PATTERN = rf"[a-z{WORD_CLASS}]+"
DIGITLESS_PATTERN = r"[a-z\p{L}\p{Nl}\p{No}_]+"
SPACE_PATTERN = rf"[{SPACE_CLASS}]+"
NONSPACE_PATTERN = rf"[^{SPACE_CLASS}]+"

#: Shortest token the aggressive strategy keeps.
AGGRESSIVE_MIN_CHARS = 3


def strip_html(text: Column) -> Column:
    return F.regexp_replace(text, TAG_PATTERN, " ")


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, " ")


def strip_markup(text: Column) -> Column:
    """``strip_urls(strip_html(text))``; a text without the letters every match holds is not searched.

    A tag becomes a space, so no address forms where the text had none.
    """
    plain = F.when(text.contains("<"), strip_html(text)).otherwise(text)
    address = text.contains("http") | text.contains("www.")
    return F.when(address, strip_urls(plain)).otherwise(plain)


def lowercase_text(text: Column) -> Column:
    return F.lower(text)


def strip_numbers(text: Column) -> Column:
    return F.regexp_replace(text, NUMBER_PATTERN, " ")


def strip_punct(text: Column) -> Column:
    return F.regexp_replace(text, PUNCT_PATTERN, " ")


def normalize_ws(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE_PATTERN, " "))


def split_words(text: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.regexp_extract_all(text, F.lit(NONSPACE_PATTERN), F.lit(0))


def joined_words(text: Column) -> Column:
    """``split_words`` of a text whose words are joined by single spaces; an empty text is one empty word."""
    return F.split(text, " ")


def remove_stopwords(tokens: Column, stopwords: Sequence[str] = CLEANER_STOPWORDS) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(list(stopwords)))


def drop_short_tokens(tokens: Column, min_chars: int = AGGRESSIVE_MIN_CHARS) -> Column:
    return F.filter(tokens, lambda token: F.length(token) >= min_chars)


def _minimal(text: Column, config: CleaningConfig) -> Column:
    if config.remove_html:
        text = strip_markup(text)
    if config.lowercase:
        text = lowercase_text(text)
    if config.normalize_whitespace:
        text = normalize_ws(text)
    return text


def _standard_text(text: Column, config: CleaningConfig, numbers: bool, spaces: bool) -> Column:
    if config.remove_html:
        text = strip_markup(text)
    if config.lowercase:
        text = lowercase_text(text)
    if numbers:
        text = strip_numbers(text)
    if config.remove_punctuation:
        text = strip_punct(text)
    if spaces:
        text = normalize_ws(text)
    return text


def _standard_words(text: Column, config: CleaningConfig, numbers: bool) -> Column:
    """``split_words`` of the standard text, whatever its spaces.

    Without punctuation a word is a run of word characters, so words are cut in one pass.
    """
    if not config.remove_punctuation:
        return split_words(_standard_text(text, config, numbers, spaces=False))
    text = _standard_text(text, replace(config, remove_punctuation=False), numbers=False, spaces=False)
    return F.regexp_extract_all(text, F.lit(DIGITLESS_PATTERN if numbers else WORD_PATTERN), F.lit(0))


def _standard(text: Column, config: CleaningConfig) -> Column:
    if config.remove_stopwords:
        return F.array_join(remove_stopwords(_standard_words(text, config, config.remove_numbers)), " ")
    if config.lemmatize:
        return F.array_join(_standard_words(text, config, config.remove_numbers), " ")
    return _standard_text(text, config, config.remove_numbers, config.normalize_whitespace)


def _aggressive(text: Column, config: CleaningConfig) -> Column:
    tokens = drop_short_tokens(_standard_words(text, config, numbers=True))
    if config.remove_stopwords:
        tokens = remove_stopwords(tokens)
    return F.array_join(tokens, " ")


STRATEGIES = {"minimal": _minimal, "standard": _standard, "aggressive": _aggressive}


def clean_expr(text: Column, config: CleaningConfig) -> Column:
    """The cleaned text, before lemmas (a join, see ``operators.lemmas``). Null text becomes ''."""
    if config.strategy not in STRATEGIES:
        raise ValueError(
            f"Unknown cleaning strategy {config.strategy!r}; choose one of {sorted(STRATEGIES)}"
        )
    return STRATEGIES[config.strategy](F.coalesce(text, F.lit("")), config)


def wants_lemmas(config: CleaningConfig) -> bool:
    return config.lemmatize and config.strategy != "minimal"
