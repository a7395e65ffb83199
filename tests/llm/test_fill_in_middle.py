import hashlib
import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from opinara.llm.fill_in_middle import OP12_SQL, FimConfig, fill_in_middle, op12_fill_in_middle, restored

SCHEMA = "doc_id long, text string, n string, form string, output string, first string"


def expected(doc_id, text, seed=7, rewritten=100, suffix_first=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    hexed = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(hexed[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rewritten:
        return n, "plain", None, None, text
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < suffix_first:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def texts():
    draw = random.Random(12)
    parts = ["\n", "\n\n", "a", "$1", "\\", "\r\n", "é\U0001f600", "<P", "S>", "<", "[x]", "\\Q\\E", " "]
    made = ["".join(draw.choices(parts, k=draw.randrange(40))) for _ in range(300)]
    long = ["x\n" * 100_000, "y" * 300_000, "\n" * 50_000 + "z", "ab <M> c\nd", "<P>", "<S>\n"]
    return [None, "", "\n", "one", *long, *made]


def test_equals_slices_of_lines(spark):
    rows = [(i, t, "n", "f", "o", "x") for i, t in enumerate(texts())] + [(None, "p\nq\nr", "", "", "", ""), (7, "same\nid", "", "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    out = fill_in_middle(df).select("*", restored(F.col("output"), F.col("form")).alias("back")).collect()
    got = sorted(((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in out), key=repr)
    assert got == sorted(((i, t or "", *expected(i, t)) for i, t, *_ in rows), key=repr)
    assert all(r.back == r.text for r in out)
    assert {r.form for r in out} == {"plain", "psm", "spm"}


def test_shares_and_other_units(spark):
    df = spark.createDataFrame([(i, "a b c d", "", "", "", "") for i in range(400)], SCHEMA)
    config = FimConfig(seed=3, rewritten=70, suffix_first=20, unit=r" *[^ ]+| +")
    rows = fill_in_middle(df, config).collect()
    share = {form: sum(r.form == form for r in rows) / 400 for form in ("plain", "psm", "spm")}
    assert abs(share["plain"] - 0.3) < 0.08 and abs(share["spm"] - 0.14) < 0.06
    assert {r.n for r in rows} == {4}
    with pytest.raises(ValueError):
        FimConfig(prefix_mark="aba", suffix_mark="ac")


def test_query_equals_sql_and_empty_table(spark, tmp_path):
    rows = [(i, t, "", "", "", "") for i, t in enumerate(texts())]
    spark.createDataFrame(rows, SCHEMA).select("doc_id", "text").write.parquet(str(tmp_path / "documents.parquet"))
    ours = op12_fill_in_middle(spark, str(tmp_path))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    theirs = db.execute(OP12_SQL)
    assert [d[0] for d in theirs.description] == ours.columns
    assert sorted(map(tuple, ours.collect())) == sorted(theirs.fetchall())
    assert fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
