import csv
import random

import pytest
from pyspark.sql import functions as F

from opinara.sources.quoted_csv import CSV_OPTIONS, block_states, _lines, ends_inside, read_quoted_csv
from opinara.sources.reviews import load_reviews, read_table

PIECES = ["plain", 'say "hi"', "a,b", "two\nlines", "\n", '"', '""', ",", "", "x\n\ny", "é z", "long " * 40, '\n"\n', " pad "]


@pytest.fixture
def small_splits(spark):
    """Blocks of so many bytes."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    yield lambda size: spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def by_spark(spark, path):
    rows = spark.read.options(header=True, **CSV_OPTIONS).csv(path)
    return sorted(map(str, map(tuple, rows.collect())))


def drawn(seed, n):
    draw = random.Random(seed)
    return [["".join(draw.choices(PIECES, k=draw.randrange(1, 4))) or "e" for _ in range(3)] for _ in range(n)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("size", [7, 64, 1000])
def test_rows_are_those_of_one_task_a_file(spark, tmp_path, small_splits, size, end):
    for number in range(2):
        with open(tmp_path / f"part{number}.csv", "w", newline="", encoding="utf-8") as out:
            rows = csv.writer(out, lineterminator=end, quoting=csv.QUOTE_MINIMAL if number else csv.QUOTE_ALL)
            rows.writerow(["Review", "b c", "senti`ment"])
            rows.writerows(drawn(size + number, 12))
    expected = by_spark(spark, str(tmp_path))
    small_splits(size)
    found = read_quoted_csv(spark, str(tmp_path), "place")
    assert found.columns == ["Review", "b c", "senti`ment", "place"]
    assert sorted(str(tuple(r)[:3]) for r in found.collect()) == expected
    assert found.select("place").distinct().count() == len(expected) == 24
    assert _lines(spark, str(tmp_path)).rdd.getNumPartitions() > 3 or size == 1000


def test_a_cell_over_many_blocks_and_quotes_within_unquoted_cells(spark, tmp_path, small_splits):
    path = tmp_path / "one.csv"
    long = "\n".join(f"line {n}, of ""many""" for n in range(60))
    path.write_text(f'a,b\n5" nail,x\n"{long}",y\n\nz,6" and 7"\n"",last\nshort\n')
    expected = by_spark(spark, str(path))
    small_splits(32)
    found = read_quoted_csv(spark, str(path))
    assert sorted(map(str, map(tuple, found.collect()))) == expected
    states = block_states(_lines(spark, str(path))).where("inside").agg(F.count("*"), F.countDistinct("opener")).first()
    assert states[0] > 10 and states[1] == 1


@pytest.mark.parametrize("most", [100_000, 0])
def test_lines_are_exchanged_only_beyond_the_bound_on_blocks(spark, tmp_path, small_splits, monkeypatch, most):
    monkeypatch.setattr("opinara.sources.quoted_csv.BROADCAST_BLOCKS", most)
    path = tmp_path / "one.csv"
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out).writerows([["a", "b", "c"], *drawn(3, 40)])
    expected = by_spark(spark, str(path))
    small_splits(50)
    found = read_quoted_csv(spark, str(path))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert ("RepartitionByExpression" in plan) == (most == 0)
    assert sorted(map(str, map(tuple, found.collect()))) == expected


def test_states_of_lines(spark):
    cases = [
        ("a,b", False, True), ('"a', True, False), ('a"b', False, False), ('"a",b', False, False), ('"a""', True, False),
        ('x","y', True, True), ('x",y', False, False), ('""', False, True), ("", False, True), ('a,"', True, False),
    ]
    rows = spark.createDataFrame([(c[0],) for c in cases], "line string")
    out, into = ends_inside(F.col("line"))
    found = {r.line: (r.o, r.i) for r in rows.select("line", out.alias("o"), into.alias("i")).collect()}
    assert found == {line: (o, i) for line, o, i in cases}


def test_empty_file_and_header_alone(spark, tmp_path):
    (tmp_path / "head.csv").write_text("a,b\n")
    assert read_quoted_csv(spark, str(tmp_path / "head.csv")).count() == 0


def test_large_files_are_split_by_default(spark, tmp_path, small_splits):
    path = str(tmp_path / "r.csv")
    with open(path, "w", newline="") as out:
        rows = csv.writer(out)
        rows.writerow([" Review", "sentiment "])
        rows.writerows([[f"text\n{n % 40}, more", "positive" if n % 2 else "NA"] for n in range(200)])
    whole = load_reviews(spark, path, split=False)
    expected = sorted(map(str, map(tuple, whole.collect())))
    small_splits(500)
    split = load_reviews(spark, path)
    assert sorted(map(str, map(tuple, split.collect()))) == expected and len(expected) == 20
    assert read_table(spark, path).count() == 200
