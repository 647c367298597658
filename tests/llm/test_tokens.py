"""op1, op2 and op8 against the public libraries."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tablewright.llm import bpe, token_counts, token_files
from tablewright.llm.common import new_folder

WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = [
    None, "", " ", "\n\n", "a", "It's I'LL they've", "a<|endoftext|>b <|startoftext|> <|x|>", "ΣΑΣ ΟΔΟΣ İstanbul ﬁn", "é é \x1c a\x1fb",
    "漢字 1234 ²Ⅷ 😀", "a b c\u0085d", "ab" * 3000, "x" * 200 + " " + "é" * 90, "<s> </s> <unk> ▁x", "two  spaces \t tab", "\r\n{\r\n", "\x00z",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD)


@pytest.fixture(scope="module")
def ranks():
    with open(WORD, encoding="utf-8") as f:
        return bpe.RankArrays(f.read())


@pytest.fixture(scope="module")
def counter():
    with open(PIECE, "rb") as f:
        return token_counts.PieceCounter(f.read(), {"the": 1})


def ids_of(ranks, texts):
    flat, offsets = ranks.encode(pa.array(texts, pa.string()))
    return [flat[a:b].tolist() for a, b in zip(offsets, offsets[1:], strict=False)]


def wanted(library, texts):
    return [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_odd_texts(library, ranks):
    assert ids_of(ranks, ODD) == wanted(library, ODD)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abcdehinorst'.,<|>#é漢1 \n\x1cΣ"), max_size=80), max_size=8))
def test_any_text(texts):
    with open(WORD, encoding="utf-8") as f:
        content = f.read()
    assert ids_of(bpe.encoder(content), texts) == wanted(Tokenizer.from_file(WORD), texts)


def test_long_words_take_the_same_merges(ranks):
    words = ["theinteresting" * n for n in (1, 2, 3, 4)] + ["a" * n for n in range(1, 60)]
    assert ranks.encode_words(words) == [ranks._encode_long(w.encode()) for w in words]


def test_a_full_table_starts_anew(library, ranks):
    entries, ranks.units.entries = ranks.units.entries, 10
    try:
        for _ in range(3):
            assert ids_of(ranks, ODD) == wanted(library, ODD)
    finally:
        ranks.units.entries = entries


def test_decoding(spark, library):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(ODD)], "id int, text string, ids string")
    rows = bpe.decode(bpe.encode(df, WORD), WORD).orderBy("id").collect()
    ids = wanted(library, ODD)
    assert [r["ids"] for r in rows] == ids
    assert [r["decoded"] for r in rows] == library.decode_batch(ids, skip_special_tokens=False)
    both = bpe.round_trip(df.withColumn("decoded", F.lit("clash")), WORD).orderBy("id")
    assert both.columns == ["id", "ids", "decoded"] and both.collect() == [r[:1] + r[2:] for r in rows]
    assert bpe.round_trip(df.limit(0), WORD).count() == 0
    nothing = spark.createDataFrame([(1, None), (2, "")], "id int, text string")
    assert [tuple(r) for r in bpe.round_trip(nothing, WORD).collect()] == [(1, [], ""), (2, [], "")]
    odd = spark.createDataFrame([(None,), ([],), ([320, -1, 10**6, 321],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(odd, WORD).collect()] == [None, "", library.decode([320, 321])]
    assert bpe.encode(df.limit(0), WORD).count() == 0


def test_files_without_word_ends_are_refused():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, pytest.raises(ValueError):
        bpe.RankArrays(f.read())


def test_piece_counts(counter):
    texts = [t or "" for t in ODD]
    assert counter.counts(ODD) == [len(i) for i in counter.processor.encode(texts, num_threads=1)]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(["a", "the", " ", "  ", "\n", "\r\n", "▁", "é", "\x00", "<s>", ";", " \n", "\n "]), max_size=12))
def test_piece_counts_of_any_text(parts):
    with open(PIECE, "rb") as f:
        counter = token_counts._counter(f.read(), b"")
    text = "".join(parts)
    assert counter.counts([text]) == [len(counter.processor.encode(text))]


def test_count_operator(spark, counter):
    df = spark.createDataFrame([(i, t, -1) for i, t in enumerate(ODD * 3)], "id int, text string, n_tokens int")
    for sizes in ({}, {"sample_rows": 0}, {"entries": 3}):
        rows = token_counts.count_tokens(df, PIECE, **sizes).orderBy("id").collect()
        assert [r["n_tokens"] for r in rows] == counter.counts(ODD * 3)
    assert token_counts.count_tokens(df.limit(0), PIECE).count() == 0


def test_segments_round_trip():
    rng = np.random.default_rng(1)
    for n, top in ((1, 1), (5, 3), (1000, 50_000), (70_000, 40), (200_000, 49_408), (300, 2**31)):
        ids = (rng.random(n) ** 3 * top).astype(np.uint32)
        counts = np.diff(np.concatenate([[0], np.sort(rng.integers(0, n + 1, 3)), [n]]))
        data = token_files.encode_segment(np.array([token_files.NULL_KEY, -5, 0, 7]), counts, ids)
        keys, got_counts, got = token_files.decode_segment(data)
        assert keys.tolist() == [token_files.NULL_KEY, -5, 0, 7] and (got_counts == counts).all() and (got == ids).all()


def test_a_changed_segment_is_noticed():
    ids = np.random.default_rng(2).integers(0, 500, 10_000).astype(np.uint32)
    data = bytearray(token_files.encode_segment(np.array([1]), np.array([len(ids)]), ids))
    data[-100] ^= 4
    with pytest.raises(ValueError):
        token_files.decode_segment(bytes(data))


def test_files(spark, library):
    texts = ODD + ["the end"] * 5
    keys = [None, 3, 3, 3, *range(10, 10 + len(texts) - 4)][::-1]
    rows = list(zip(keys, texts, strict=True))
    df = spark.createDataFrame([(k, t, "x") for k, t in rows], "doc_id long, text string, start string").repartition(3)
    folder = new_folder(spark)
    token_files.write_files(df, folder, WORD, parts=4)
    got = sorted(token_files.read_digests(spark, folder).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(keys, key=lambda k: (k is not None, k))
    assert [r["start"] for r in got] == np.concatenate([[0], np.cumsum([r["n_tokens"] for r in got])[:-1]]).tolist()
    want = {(k, zlib.crc32(np.array([*i, 1], "<u4").tobytes())) for (k, _), i in zip(rows, wanted(library, texts), strict=True)}
    assert {(r["doc_id"], r["ids_crc32"]) for r in got} == want
    ids = {(r["doc_id"], tuple(r["ids"])) for r in token_files.read_ids(spark, folder).collect()}
    assert ids == {(k, (*i, 1)) for (k, _), i in zip(rows, wanted(library, texts), strict=True)}


def test_files_of_nothing(spark):
    folder = new_folder(spark)
    token_files.write_files(spark.createDataFrame([], "doc_id long, text string"), folder, WORD)
    assert token_files.read_digests(spark, folder).count() == 0


def test_queries_on_documents(spark, library, counter):
    from tablewright.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").collect()
    ids = wanted(library, [d["text"] for d in docs])
    one = {r["doc_id"]: r for r in QUERIES["op1_bpe"](spark, "/root/testdata/sf0.001").collect()}
    for d, i in zip(docs, ids, strict=True):
        r = one[d["doc_id"]]
        assert r["n_tokens"] == len(i) and r["ids_sha256"] == hashlib.sha256(" ".join(map(str, i)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()
    two = {r["doc_id"]: r for r in QUERIES["op2_token_counts"](spark, "/root/testdata/sf0.001").collect()}
    for d, n in zip(docs, counter.counts([d["text"] for d in docs]), strict=True):
        assert two[d["doc_id"]]["n_tokens"] == n and two[d["doc_id"]]["n_bytes"] == len(d["text"].encode())
    eight = sorted(QUERIES["op8_token_files"](spark, "/root/testdata/sf0.001").collect(), key=lambda r: r["doc_id"])
    start = 0
    for r, i in zip(eight, ids, strict=True):
        assert (r["start"], r["n_tokens"]) == (start, len(i) + 1)
        start += len(i) + 1
