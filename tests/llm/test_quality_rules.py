import math
import re
from collections import Counter

from opinara.llm.quality_rules import KEY, QualityConfig, js_distance, keep_good_documents, quality_rules
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, kept string, n_words string"
SENTENCE = "the cat of the house and a dog in {} to it is for was as on be by this are or an old {} tree"


def text(n, salt):
    return "\n".join(SENTENCE.format(f"{salt}{i}", f"{i}{salt}") for i in range(n))


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(zip(words, words[1:], words[2:]))
    repeats = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeats),
        len(words) < 50 or 100 * len(repeats) > 50 * len(words),
    )


def test_base_measures(spark):
    texts = [
        None, "", " \n\t ", "a a a a", "a b c", "one two three four one two three", "x\nx\n\nx \ny", "#| tag é😀 <b>",
        " lead\x0bvt\x0cff ", "a b a b a b a", text(30, "q"), "word " * 20_000, "ß" * 5000, "a\x00b c", "a b c d",
    ]
    rows = [(i, t, None, "x", "y") for i, t in enumerate(texts)]
    out = quality_rules(spark.createDataFrame(rows, SCHEMA)).orderBy("doc_id").collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert [tuple(r[n] for n in names) for r in out] == [brute(t) for t in texts]


def test_distance(spark):
    df = spark.createDataFrame([([1, 2, 3], [3, 2, 1]), ([1, 0], [0, 1]), ([2, 4], [1, 2]), ([0, 0], [1, 1])], "p array<long>, q array<long>")
    got = [r.d for r in df.select(js_distance(F.col("p"), F.col("q")).alias("d")).collect()]
    p, q = (1 / 6, 2 / 6, 3 / 6), (3 / 6, 2 / 6, 1 / 6)
    want = math.sqrt(sum(x * math.log2(2 * x / (x + y)) + y * math.log2(2 * y / (x + y)) for x, y in zip(p, q)) / 2)
    assert math.isclose(got[0], want, rel_tol=1e-12)
    assert (round(got[1], 12), got[2], got[3]) == (1.0, 0.0, None)


def test_junk_goes_and_clean_stays(spark):
    clean = [(i, text(8, f"k{i}"), "en", "", "") for i in range(40)]
    symbols = " ".join(f"{w}###%" for w in text(8, "s").split())
    strange = " ".join(f"zw{i}k" for i in range(300))
    rows = clean + [(100, symbols, "en", "", ""), (101, strange, "en", "", ""), (102, strange, None, "", ""), (100, symbols, "en", "", "")]
    config = QualityConfig(max_repeat_percent=100)
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame(rows, SCHEMA), config).collect()}
    assert all(out[i].kept for i in range(40))
    assert not out[100].kept and not out[101].kept
    assert out[102].common_distance is None and out[102].kept != out[102].base_failed


def test_stage_and_empty_table(spark):
    good = " ".join(f"the w{i}a of" for i in range(60))
    df = spark.createDataFrame([(1, good, "xx", "a", "b"), (1, good, "xx", "a", "b"), (2, "short", "xx", "a", "b"), (None, good, None, "a", "b")], SCHEMA)
    kept = keep_good_documents(spark, df, "")
    assert kept.columns == df.columns and kept.count() == 3
    assert quality_rules(df.limit(0)).count() == 0
    assert KEY not in kept.columns
