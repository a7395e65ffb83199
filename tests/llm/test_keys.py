import random

import pytest
from pyspark.sql import functions as F

from opinara.llm.best_fit_packing import default_config, pack_documents
from opinara.llm.chained_passages import repeated_passages
from opinara.llm.common import KEY, id_is_key, with_key, without_key
from opinara.llm.exact_dedup import exact_dedup, keep_first_copies
from opinara.llm.fill_in_middle import fill_in_middle
from opinara.llm.hilbert_sharding import assign_shards, write_shards
from opinara.llm.near_dedup import keep_one_of_each_family, near_components
from opinara.llm.quality_rules import keep_good_documents, quality_rules
from opinara.llm.scaled_sketch import sketch_neighbours
from opinara.llm.source_mixing import mix, mix_sources
from opinara.llm.suffix_dedup import suffix_dedup
from opinara.llm.token_files import TokenFileConfig, read_back, write_tokens
from opinara.llm.tokens import vocabulary_path
from opinara.staging import staging_path

#: Names that the operators use inside, all as extra columns.
EXTRA = [KEY, "__copy", "__at", "__part", "__place", "__before", "rank", "row", "whole", "shard_number", "key", "a.b", "kept"]
SCHEMA = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` long" for c in EXTRA)


def rows():
    draw = random.Random(4)
    texts = [None, "", "one", *(" ".join(f"w{draw.randrange(99)}" for _ in range(draw.randrange(60, 90))) for _ in range(20))]
    made = [(i % 30 if i % 7 else None, draw.choice(texts), "en", draw.choice("abc")) for i in range(120)]
    # Rows that differ in their other columns only, and rows that are equal.
    made += [(3, "same", "en", s) for s in "abcabc"] + [(4, "same", None, None)] * 3
    return [(*r, *[0 if n % 2 else n for _ in EXTRA]) for n, r in enumerate(made)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def contents(df, *columns):
    return sorted(map(repr, (df.select(*columns) if columns else df).collect()))


def from_files(spark, df):
    folder = staging_path(spark, "files")
    return contents(read_back(write_tokens(df, folder, TokenFileConfig(vocabulary_path())), folder))


OPERATORS = {
    "suffix_dedup": lambda spark, df: contents(suffix_dedup(df).drop(KEY)),
    "best_fit_packing": lambda spark, df: contents(pack_documents(df, default_config()), "doc_id", "piece", "start", "length", "ids_crc32"),
    "hilbert_sharding": lambda spark, df: contents(assign_shards(df)),
    "source_mixing": lambda spark, df: contents(mix(df)),
    "near_dedup": lambda spark, df: contents(near_components(df)),
    "chained_passages": lambda spark, df: contents(repeated_passages(df)),
    "quality_rules": lambda spark, df: contents(quality_rules(df)),
    "exact_dedup": lambda spark, df: contents(exact_dedup(df)),
    "token_files": from_files,
    "scaled_sketch": lambda spark, df: contents(sketch_neighbours(df)),
    "fill_in_middle": lambda spark, df: contents(fill_in_middle(df)),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_reruns_agree_with_repeated_ids_and_own_names_taken(spark, table, name):
    run = OPERATORS[name]
    first = run(spark, table)
    assert first == run(spark, table.repartition(7, F.rand(5)))
    assert len(first) > 20 or name == "chained_passages"


STAGES = [keep_good_documents, keep_first_copies, keep_one_of_each_family, mix_sources]


@pytest.mark.parametrize("apply", STAGES, ids=lambda f: f.__name__)
def test_stages_keep_columns_of_any_name(spark, table, apply):
    out = apply(spark, table, "")
    assert out.columns == table.columns
    every = set(contents(table))
    assert set(contents(out)) <= every and (apply is keep_good_documents or out.count() > 5)


def test_a_column_named_key_decides_nothing(spark):
    df = spark.createDataFrame([(1, "a", 0), (2, "a", 0), (3, "b", 0)], f"doc_id long, text string, {KEY} long")
    out = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup(df).collect()}
    assert out == {1: (2, False), 2: (2, True), 3: (3, True)}
    upper = df.withColumnRenamed(KEY, KEY.upper())
    assert sorted(r.doc_id for r in keep_first_copies(spark, upper, "").collect()) == [2, 3]
    keyed = with_key(df)
    assert id_is_key(keyed) and with_key(keyed) is keyed
    assert contents(without_key(keyed, df)) == contents(df)


def test_shards_are_written_with_a_column_of_that_name(spark, table, tmp_path):
    write_shards(table, str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.columns == [*table.columns, "shard_number_"]
    assert contents(back.drop("shard_number_")) == contents(table)


def test_keys_are_places_of_rows(spark, table):
    keyed = with_key(table)
    assert not id_is_key(keyed)
    got = [tuple(r) for r in keyed.orderBy(KEY).collect()]
    assert [r[0] for r in got] == list(range(len(rows())))
    ids = [r[1] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
