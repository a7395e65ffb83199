import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from opinara.llm import tokens
from opinara.llm.best_fit_packing import PackConfig, SwapSearch, best_fit, pack, pack_documents
from opinara.llm.token_files import SequenceFile, TokenFileConfig, read_back, write_tokens
from opinara.llm.tokens import Encoder, vocabulary_path

PATH = vocabulary_path()
SCHEMA = "doc_id long, text string, length string, part string, uid string"
LETTERS = " \n\t\r\x0b\xa0　​ abcXYZ019.,!?'s't\"éßñ中文😀#<>-_/\x00\x1f\x85 "
TEXTS = [
    None, "", " ", "\n\n", "a", "Don't stop.\nNow, é. go  on ", "word " * 9000, "x" * 20_000, "é ê\nà", "<|endoftext|> a",
    "The cat sat, and the dog ran. " * 90, "tail\n",
]


def plain():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_chunked_ids_are_the_tokenizers(monkeypatch):
    draw, whole = random.Random(2), plain()
    texts = TEXTS + ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(60))) for _ in range(3000)]
    encoder = Encoder(PATH, 2)
    assert [i.tolist() for i in encoder.encode(texts)] == [whole(t) for t in texts]
    monkeypatch.setattr(tokens, "REMEMBERED", 50)
    monkeypatch.setattr(tokens, "BATCH_CHARS", 200)
    encoder = Encoder(PATH, 2)
    assert [i.tolist() for i in encoder.encode(texts)] == [whole(t) for t in texts]
    assert len(encoder) <= 50


def test_files_round_trip(spark, tmp_path):
    whole = plain()
    rows = [(7 * n, t, "", "", "") for n, t in enumerate(TEXTS * 3)]
    draw = random.Random(4)
    shuffled = draw.sample(rows, len(rows))
    config = TokenFileConfig(PATH, length=64, batch=4)
    index = write_tokens(spark.createDataFrame(shuffled, SCHEMA).repartition(3), str(tmp_path / "files"), config)
    got = sorted(tuple(r) for r in read_back(index, str(tmp_path / "files")).collect())
    want, start = [], 0
    for i, t, *_ in rows:
        ids = whole(t)
        want.append((i, start, len(ids), crc(ids)))
        start += len(ids)
    assert got == want
    name, size = index.groupBy("file").agg({"n_tokens": "sum"}).orderBy("file").first()
    file = SequenceFile(str(tmp_path / "files"), name)
    flat = np.concatenate([file.sequences(b).reshape(-1) for b in range(file.reader.num_record_batches)])
    mask = np.concatenate([np.unpackbits(file.mask(b).reshape(-1)) for b in range(file.reader.num_record_batches)])
    assert mask.sum() == size and mask[:size].all() and not flat[size:].any() and len(flat) == len(mask)
    assert not file.sequences(0).flags.owndata


def test_files_of_null_and_repeated_ids_and_empty_table(spark, tmp_path):
    rows = [(1, "b", "", "", ""), (1, "a", "", "", ""), (None, "c", "", "", ""), (1, "a", "", "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    config = TokenFileConfig(PATH)
    index = write_tokens(df, str(tmp_path / "x"), config)
    got = read_back(index, str(tmp_path / "x")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, 1, 1, 1] and [r.start for r in got] == [0, 2, 4, 6]
    index = write_tokens(df.limit(0), str(tmp_path / "y"), config)
    assert read_back(index, str(tmp_path / "y")).count() == 0


@pytest.mark.parametrize("low, high, n", [(1, 1024, 3000), (300, 700, 2000), (1, 40, 500), (600, 1024, 50), (1, 2, 0)])
def test_packing_keeps_every_piece_and_swaps_never_add_sequences(low, high, n):
    lengths = np.random.default_rng(3).integers(low, high, n)
    packed = pack(lengths, 1024)
    assert sorted(i for b in packed for i in b) == list(range(n))
    assert all(lengths[b].sum() <= 1024 for b in packed)
    assert len(packed) <= len(best_fit(lengths, 1024))


def test_swaps_empty_a_sequence():
    """Best fit leaves three sequences; an exchange leaves two."""
    lengths = np.array([6, 5, 4, 3, 2])
    assert len(pack(lengths, 10)) == 2
    lengths = np.array([44, 24, 24, 22, 21, 17, 8, 8, 6, 6])
    assert len(pack(lengths, 61)) <= len(best_fit(lengths, 61))


def test_documents_of_equal_length_are_offered_as_a_pair():
    search = SwapSearch([[0, 1, 2]], np.array([2, 2, 5]), 10)
    assert sorted(sorted(int(search.lengths[i]) for i in o) for o in search._offers_of(0)) == [[], [2], [2, 2], [2, 5], [5]]


def test_a_changed_sequence_lists_all_its_offers():
    lengths = np.array([6, 1, 2, 3, 4])
    search = SwapSearch([[0], [1, 2, 3, 4]], lengths, 12)
    search.bins, search.fill = [[0, 1, 2], [3, 4]], np.array([9, 7])
    for at in (0, 1):
        search._refresh(at)
        listed = [e for kind in search.offers for same in kind for e in same if e[1] == at]
        assert sorted(e[2] for e in listed) == sorted(search._offers_of(at))
        assert {e[0] for e in listed} == {12 - int(search.fill[at])}


def test_search_goes_on_until_every_open_sequence_was_tried(monkeypatch):
    tried, empty = [], SwapSearch.empty
    monkeypatch.setattr(SwapSearch, "empty", lambda self, donor: tried.append(donor) or empty(self, donor))
    lengths = np.full(200, 6)
    assert len(pack(lengths, 10)) == 200 and sorted(tried) == list(range(200))


def test_packed_documents(spark):
    whole = plain()
    rows = [(n, t, "", "", "") for n, t in enumerate(TEXTS * 4)]
    out = pack_documents(spark.createDataFrame(rows, SCHEMA), PackConfig(PATH, group_pieces=20)).collect()
    by_doc, by_sequence = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert sorted(by_doc) == [r[0] for r in rows]
    for n, t, *_ in rows:
        ids, pieces = whole(t), sorted(by_doc[n], key=lambda r: r.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert [p.start for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) == len(ids)
        assert all(p.length == 1024 for p in pieces[1:]) and pieces[0].length <= 1024
        assert all(p.ids_crc32 == crc(ids[p.start : p.start + p.length]) for p in pieces)
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [p.offset for p in pieces] == [sum(q.length for q in pieces[:i]) for i in range(len(pieces))]
        assert sum(p.length for p in pieces) <= 1024


def test_packing_of_repeated_rows_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a", "", "", ""), (1, "a", "", "", ""), (None, None, "", "", "")], SCHEMA)
    out = pack_documents(df, PackConfig(PATH)).collect()
    assert sorted((r.doc_id or 0, r.length) for r in out) == [(0, 1), (1, 2), (1, 2)]
    assert pack_documents(df.limit(0), PackConfig(PATH)).count() == 0
