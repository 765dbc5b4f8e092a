"""BPE and record files against the tokenizers library and an exact round trip."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from skygrain.llm import bpe, queries, records

SF = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["", " ", "  ", "a  b", " a", "a \n b", "\n", "a\n \nb", "  b", "a   ", "x<|endoftext|>y <|endoftext|>", "it's 's 'S",
       "\x1c \x1c a\x85b", "é" * 3000, "aaaa" * 5000, "​　x", "1234 ½٣", "🙂🙂", "a   b", " " * 5000, "\x00 �"]
SCHEMA = "doc_id long, text string, ids string, start int"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "x", 1) for k, t in enumerate(ODD)] + [(None, None, None, None), (3, ODD[3], "x", 1), (50, None, None, 2)]
    return spark.createDataFrame(rows, SCHEMA)


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_encode_decode_odd_rows(odd, library):
    rows = bpe.decode(bpe.encode(odd, PATH), PATH).collect()
    texts = {k: t for k, t in enumerate(ODD)}
    assert len(rows) == len(ODD) + 3
    for r in rows:
        expected = _ids(library, texts.get(r.doc_id))
        assert r.ids == expected
        assert r.decoded == library.decode(expected, skip_special_tokens=False)


def test_encode_random_text(library):
    codec, pick = bpe.Codec(open(PATH).read()), random.Random(5)
    letters = "abcdeé ßж漢\n\t '.,!1239  <|>"
    for _ in range(300):
        text = "".join(pick.choices(letters, k=pick.randrange(60)))
        assert codec.encode(text).tolist() == _ids(library, text)


def test_shared_trees_equal_library(library):
    pick = random.Random(8)
    words = ["".join(pick.choices("abeinorst", k=pick.randrange(1, 70))) for _ in range(3000)] + ["é漢" * n for n in range(40)]
    texts = [" ".join(pick.choices(words, k=pick.randrange(400))) + pick.choice(["", ".", ", a", "  b", " 's"]) for _ in range(60)]
    codec = bpe.Codec(open(PATH).read())
    for _ in range(2):  # new words, then known ones
        for text, ids in zip(texts, codec.encode_all(texts)):
            assert ids.tolist() == _ids(library, text)


def test_decode_broken_bytes(library):
    codec = bpe.Codec(open(PATH).read())
    for ids in ([227], [227, 210, 50256, 0], list(range(128, 256)), []):
        assert codec.decode(np.array(ids, np.int32)) == library.decode(ids, skip_special_tokens=False)


def test_library_words_equal_whole_texts(library):
    encoder = records.LibraryEncoder(open(PATH).read())
    for _ in range(2):
        assert [e.tolist() for e in encoder.encode(ODD)] == [_ids(library, t) for t in ODD]


def test_op8_query(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op8_bpe(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = _ids(library, texts[r.doc_id])
        decoded = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_op6_query(spark, library):
    texts = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())
    rows = {r.doc_id: r for r in queries.op6_token_records(spark, SF).collect()}
    assert len(rows) == len(texts)
    start = 0
    for key, text in texts:
        ids = [*_ids(library, text), 0]
        r = rows[key]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_records_of_odd_rows(spark, odd, library, tmp_path):
    written = records.write(odd, str(tmp_path / "a"), PATH)
    rows = records.read(spark, written).collect()
    assert len(rows) == len(ODD) + 3
    texts = {k: t for k, t in enumerate(ODD)}
    assert all(r.ids == [*_ids(library, texts.get(r.key)), 0] for r in rows)
    ordered = sorted(rows, key=lambda r: r.start)
    assert [r.key for r in ordered] == sorted((r.key for r in rows), key=lambda k: (k is not None, k))
    assert [r.start for r in ordered] == np.cumsum([0] + [len(r.ids) for r in ordered])[:-1].tolist()
    some = written.index(spark).filter("key in (1, 14)")
    assert sorted(r.key for r in records.pick(spark, written, some).collect()) == [1, 14]
    order = [r.start for r in records.shuffled(spark, written, 7).orderBy("position").collect()]
    assert sorted(order) == [r.start for r in ordered] != order
    assert order == [r.start for r in records.shuffled(spark, written, 7).orderBy("position").collect()]


def test_records_of_an_empty_table(spark, odd, tmp_path):
    written = records.write(odd.limit(0), str(tmp_path / "a"), PATH)
    assert records.read(spark, written).count() == 0
    assert bpe.decode(bpe.encode(odd.limit(0), PATH), PATH).count() == 0


def test_damage_is_found():
    good = records.frame(-5, np.array([1, 70000], np.uint32)) + b"\n"
    assert records.unframe(good, 0)[0] == -5 and records.unframe(good, 0)[1].tolist() == [1, 70000]
    for at in range(len(good) - 1):
        bad = bytearray(good)
        bad[at] ^= 4
        with pytest.raises(ValueError):
            records.unframe(bytes(bad), 0)
    with pytest.raises(ValueError):
        records.unframe(good[:-3], 0)
