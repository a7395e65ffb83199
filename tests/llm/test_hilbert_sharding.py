import random
import zlib

import numpy as np

from opinara.llm.hilbert_sharding import ShardConfig, assign_shards, hilbert_index, write_shards

SCHEMA = "doc_id long, text string, source string, lang string, shard string, size string"


def test_curve_visits_every_cell_by_single_steps():
    for bits, dims in ((1, 2), (3, 2), (2, 3), (3, 3)):
        side = 1 << bits
        cells = np.array(np.meshgrid(*[range(side)] * dims)).reshape(dims, -1).T
        order = np.argsort(hilbert_index(cells, bits))
        assert sorted(hilbert_index(cells, bits)) == list(range(side**dims))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def frame(spark, n=500):
    draw = random.Random(8)
    rows = [
        (i, draw.choice([None, "", "é" * draw.randrange(300), "same text", "w " * draw.randrange(4000)]), "hot" if i % 3 == 0 else f"s{draw.randrange(9)}", draw.choice(["en", "de", None]), "", "")
        for i in range(n)
    ]
    return rows, spark.createDataFrame(rows, SCHEMA)


def test_shards(spark):
    rows, df = frame(spark)
    out = {r.doc_id: r for r in assign_shards(df.repartition(7)).collect()}
    shards = {}
    for i, t, *_ in rows:
        data = (t or "").encode()
        assert (out[i].size, out[i].text_crc32, out[i].law, out[i].grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
        shards.setdefault(out[i].shard, []).append(out[i])
    assert sorted(shards) == list(range(16))
    assert {len(s) for s in shards.values()} <= {31, 32}
    last = -1
    for n in range(16):
        rows_of = sorted(shards[n], key=lambda r: r.slot)
        assert [r.slot for r in rows_of] == list(range(len(rows_of)))
        assert rows_of[0].curve >= last and all(a.curve <= b.curve for a, b in zip(rows_of, rows_of[1:]))
        last = rows_of[-1].curve
    again = {r.doc_id: (r.shard, r.slot) for r in assign_shards(df.repartition(3)).collect()}
    assert again == {i: (r.shard, r.slot) for i, r in out.items()}


def test_written_shards_hold_every_row(spark, tmp_path):
    rows, df = frame(spark, 90)
    write_shards(df, str(tmp_path / "shards"), ShardConfig(shards=4))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(r["count"] for r in back.groupBy("shard_number").count().collect()) == [22, 22, 23, 23]
    assert sorted((r.doc_id, r.text) for r in back.collect() if r.text) == sorted((i, t) for i, t, *_ in rows if t)


def test_few_repeated_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a", "s", "en", "", ""), (1, "a", "s", "en", "", ""), (None, None, None, None, "", "")], SCHEMA)
    out = assign_shards(df).collect()
    assert len(out) == 3 and len({(r.shard, r.slot) for r in out}) == 3 and {r.slot for r in out} == {0}
    assert assign_shards(df.limit(0)).count() == 0
