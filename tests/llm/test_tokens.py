"""Byte-pair encoding and token-id files against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from obsengine.llm import bpe, rans
from obsengine.session import fresh_folder

PATH = public_tokenizers.path("byte_bpe_50k.json")

ODD = [
    "", " ", "  ", "a  b", "a   b", " a", "a ", "a  ", "\n \n", "x\n \ny", "foo.\n bar", "foo\nbar",
    "it's we'll 'S", "<|endoftext|>", "a<|endoftext|> b <|endoftext|>", "日本語 テスト 🙂", "\x85 \x85a",
    "\t \t", "1234 5678 9.0", "a\x1c \x1cb", "İstanbul ſ K", "word, word. word!! (word)", "é x",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(seed: int, n: int) -> list[str]:
    rnd = random.Random(seed)
    return ["".join(rnd.choice(" \n\tab1.é'  thing") for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def expected(library, batch) -> list[bytes]:
    found = library.encode_batch(batch, add_special_tokens=False)
    return [np.array(e.ids, "<u4").tobytes() for e in found]


def test_merges_agree_with_the_library(library):
    batch = ODD + texts(1, 4000)
    codec = bpe.BytePairCodec(PATH)
    ids = codec.encode(batch)
    assert ids == expected(library, batch)
    for text, found in zip(batch, ids, strict=True):
        assert codec.decode(found) == text
    numbers = [[198, 225], [447], [50256, 0]]
    for ids in numbers:
        decoded = library.decode(ids, skip_special_tokens=False)
        assert codec.decode(np.array(ids, "<u4").tobytes()) == decoded


def test_a_full_cache_changes_nothing(library):
    batch = texts(2, 500)
    codec = bpe.BytePairCodec(PATH, max_words=3)
    assert codec.encode(batch) == expected(library, batch)


def test_digests_of_odd_rows(spark, library):
    rows = [(i, t, "extra") for i, t in enumerate([*ODD, None, "same", "same", "long " * 40_000])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = {r.doc_id: r for r in bpe.round_trip_digests(docs, PATH, with_ids=True).collect()}
    for i, text, _ in rows:
        [ids] = expected(library, [text or ""])
        assert found[i].n_tokens == len(ids) // 4
        assert found[i].ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
        assert bytes(found[i].token_ids) == ids
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.round_trip_digests(empty, PATH).count() == 0


def test_columns_of_ids_and_texts(spark):
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "id int, text string")
    there = bpe.encode(docs, PATH)
    back = bpe.decode(there, PATH)
    assert [tuple(r) for r in back.orderBy("id").select("text", "decoded").collect()] == [
        ("some text", "some text"),
        (None, ""),
    ]


@pytest.mark.parametrize("n, lanes, interval", [(0, 4, 2), (1, 4, 2), (9, 4, 2), (5000, 64, 8)])
def test_blocks_round_trip(n, lanes, interval):
    ids = np.random.default_rng(n).zipf(1.5, n).astype(np.uint32) % 3000
    table = rans.FrequencyTable(rans.scaled_frequencies(np.bincount(ids, minlength=3)))
    lengths = [n // 3, 0, n - n // 3]
    data = rans.encode_block([5, None, 7], lengths, ids, table, lanes, interval)
    block = rans.Block(data)
    parts = list(block.documents(table))
    assert [k for k, _ in parts] == [5, None, 7]
    assert np.array_equal(np.concatenate([p for _, p in parts]), ids)
    for i in range(block.segments):  # any segment alone, from its checkpoint
        first = i * lanes * interval
        assert np.array_equal(block.segment(i, table), ids[first : first + lanes * interval])


def test_damage_is_found():
    ids = np.arange(1000, dtype=np.uint32) % 50
    table = rans.FrequencyTable(rans.scaled_frequencies(np.bincount(ids)))
    data = bytearray(rans.encode_block([1], [1000], ids, table, 16, 8))
    data[-30] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        rans.Block(bytes(data))
    data[-4:] = zlib.crc32(bytes(data[:-4])).to_bytes(4, "little")
    block = rans.Block(bytes(data))
    with pytest.raises((ValueError, IndexError)):
        list(block.documents(table))


def test_frequencies_keep_rare_symbols_and_add_up():
    counts = np.array([10**9, 1, 0, 1])
    freq = rans.scaled_frequencies(counts)
    assert freq.sum() == 1 << 16 and list(freq[1:]) == [1, 0, 1]
    assert rans.scaled_frequencies(np.ones(40_000)).min() >= 1


def test_files_in_ascending_order(spark, library):
    rows = [(i * 3, t) for i, t in enumerate([*ODD, *texts(3, 200)])]
    rows += [(None, "no id"), (9, "again"), (9, "again"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    folder = rans.write_folder(
        docs, fresh_folder(spark, "t"), PATH, 2, block_tokens=50, file_tokens=300, lanes=8
    )
    found = rans.read_folder(spark, folder).orderBy("start").collect()
    assert len(found) == len(rows)
    keys = [-1 if r.doc_id is None else r.doc_id for r in found]
    assert keys == sorted(keys)
    start, left = 0, {}
    for key, text in rows:
        left.setdefault(key, []).append(expected(library, [text or ""])[0] + b"\x02\0\0\0")
    for r in found:
        assert r.start == start and r.n_tokens == len(r.ids) // 4
        assert r.ids_crc32 == zlib.crc32(r.ids)
        assert bytes(r.ids) in left[r.doc_id], r
        left[r.doc_id].remove(bytes(r.ids))
        start += r.n_tokens
    assert not any(left.values())


def test_no_documents(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    folder = rans.write_folder(docs, fresh_folder(spark, "t"), PATH, 2)
    assert rans.read_folder(spark, folder).collect() == []


def test_other_tokenizers_are_not_cut_at_spaces(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    docs = spark.createDataFrame([(1, "Two  Words"), (2, "x")], "doc_id long, text string")
    found = rans.tokenize(docs, path, None).orderBy("key").collect()
    wanted = library.encode_batch(["Two  Words", "x"], add_special_tokens=False)
    kind = rans.id_kind(path)
    assert [np.frombuffer(r.ids, kind).tolist() for r in found] == [e.ids for e in wanted]
