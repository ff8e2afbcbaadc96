"""Token files, packing and byte-level BPE against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from siftlake.llm import byte_bpe, common, packing, token_files, word_cache
from siftlake.session import scratch_path

BYTE, RANKS, WORD = (public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "word_bpe_49k.json"))
TEXTS = [
    "The cat sat. It slept!", None, "", " ", "  two  blanks ", "line\nbreak\n\n\nthree", "it's 'll\t\tx", "日本語 テキスト 😀", "<|endoftext|> plain",
    "é é x", "İstanbul ΣΑΣ", "1234 5.6 a1b2", "foo\x1cbar\x85q", "x" * 3000, "word " * 4000, "The cat sat. It slept!", "ends\n",
]


@pytest.fixture
def documents(spark):
    rows = [(i, t, "en", i) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids_crc32 string, start int").repartition(3)


SPECIAL = ["plain <|endoftext|> x", "<|startoftext|>a<|endoftext|>", "<|ENDOFTEXT|> <|EndOfText|>!", "a<|endoftext|> b\n<|endoftext|>\n", "<|endoftext|>" * 3, " <|endoftext|> "]


def test_added_tokens_as_the_library_takes_them(spark):
    rows = [(i, x, 0) for i, x in enumerate([*SPECIAL, *TEXTS[:3]])]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int")
    for path, end, found in ((BYTE, 2, token_files.token_digests(df, BYTE, 2)), (WORD, 1, packing.pack(df, WORD, 1).filter("start = 0"))):
        encode, got = library(path), {r["doc_id"]: r for r in found.collect()}
        for i, text, _ in rows:
            ids = encode(text, end)
            size = got[i]["n_tokens"] if path == BYTE else got[i]["doc_tokens"]
            assert size == len(ids) and got[i]["ids_crc32"] == zlib.crc32(ids[:got[i]["n_tokens" if path == BYTE else "length"]].tobytes())


def library(path):
    found = Tokenizer.from_file(path)
    return lambda text, end: np.array([*found.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_token_files_hold_every_id(spark, documents):
    encode, start = library(BYTE), 0
    got = {r["doc_id"]: r for r in token_files.token_digests(documents, BYTE, 2).collect()}
    for i, text in enumerate(TEXTS):
        ids = encode(text, 2)
        assert (got[i]["start"], got[i]["n_tokens"], got[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(got) == len(TEXTS)


def test_sequences_are_views_of_the_file(spark, documents):
    folder = scratch_path(spark, "test")
    files = token_files.write_token_files(documents, folder, BYTE, 2, length=64).orderBy("ordinal").collect()
    encode = library(BYTE)
    stream = np.concatenate([encode(t, 2) for t in TEXTS])
    got = []
    for row in files:
        file = token_files.TokenFile(f"{folder}/{row['file']}")
        assert len(file) == row["sequences"]
        for i in range(len(file)):
            tokens, (attention, end) = file.tokens(i), file.masks(i)
            assert len(tokens) == len(attention) == len(end) == 64 and not tokens.flags.owndata
            got.append(tokens[np.asarray(attention)])
    assert np.array_equal(np.concatenate(got), stream)


def test_repeated_and_null_ids(spark):
    rows = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (1, "a")], "doc_id long, text string")
    got = token_files.token_digests(rows, BYTE, 2).orderBy("start").collect()
    assert [r["doc_id"] for r in got] == [None, 1, 1, 1] and [r["start"] for r in got] == [0, 2, 4, 6]


def check_pieces(rows, ids_of, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, ids in ids_of.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r["start"]):
            part = ids[at:at + r["length"]]
            assert (r["start"], r["ids_crc32"], r["doc_tokens"]) == (at, zlib.crc32(part.tobytes()), len(ids))
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for rows in by_sequence.values():
        at = 0
        for r in sorted(rows, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    return padding


def test_packing_covers_every_id_once(documents):
    encode = library(WORD)
    check_pieces(packing.pack(documents, WORD, 1).collect(), {i: encode(t, 1) for i, t in enumerate(TEXTS)}, 2048)


def least_cost(places, penalty, length):
    cost = [0] + [None] * (len(places) - 1)
    for j in range(1, len(places)):
        for i in range(j):
            size = int(places[j] - places[i])
            if size <= length:
                own = cost[i] + (0 if size & (size - 1) == 0 else length - size) + int(penalty[j]) + packing.PRICE
                cost[j] = own if cost[j] is None else min(cost[j], own)
    return cost[-1]


@pytest.mark.parametrize("seed", range(6))
def test_cuts_are_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    places = np.concatenate([[0], np.cumsum(rng.integers(1, 40, 150))])
    penalty = rng.choice([0, packing.SENTENCE, packing.INSIDE], len(places))
    cuts, length, cost, before = packing.best_cuts(places, penalty, 64), 64, 0, 0
    for j in cuts:
        size = int(places[j] - before)
        assert size <= length
        cost += (0 if size & (size - 1) == 0 else length - size) + int(penalty[j]) + packing.PRICE
        before = places[j]
    assert cuts[-1] == len(places) - 1 and cost == least_cost(places, penalty, length)


def test_long_sentences_are_cut_inside():
    ids = np.zeros(10_000, np.uint32)
    places, penalty = packing.cut_places(ids, np.array([10_000]), np.zeros(5, bool), 2048)
    assert places.tolist() == [0, 2048, 4096, 6144, 8192, 10_000] and penalty.tolist() == [0, 64, 64, 64, 64, 0]


def test_byte_bpe_is_the_libraries(spark, documents):
    ranks = byte_bpe.read_ranks(RANKS)
    known = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in byte_bpe.bpe_digests(documents, RANKS, public_tokenizers.PATTERN).collect()}
    for i, text in enumerate(TEXTS):
        ids = np.array(known.encode_ordinary(text or ""), "<u4")
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
    back = byte_bpe.decode_documents(byte_bpe.encode_documents(documents, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(TEXTS)}


def test_recursion_and_heap_contract_alike():
    engine = byte_bpe.engine(RANKS, public_tokenizers.PATTERN)
    words = [b"x" * 300, b"banana", b"abababab" * 20, "überraschungs".encode(), bytes(range(128, 200)), b"a"]
    for word, ids in zip(words, engine.encode_words(words), strict=True):
        assert ids.tolist() == byte_bpe.contract(word, engine.ranks)


def test_words_that_go_on_coming_outlast_a_full_cache(monkeypatch):
    monkeypatch.setattr(byte_bpe, "CACHE", 40)
    bpe, contracted = byte_bpe.DuckBpe(RANKS, public_tokenizers.PATTERN), []
    encode_words = bpe.encode_words
    monkeypatch.setattr(bpe, "encode_words", lambda words: contracted.extend(words) or encode_words(words))
    want = tiktoken.Encoding("x", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})
    for batch in range(8):
        text = " ".join(["x", "cat", *[f"w{chr(97 + batch)}{chr(97 + i)}" for i in range(26)], "cat"])
        ids, back = bpe.encode(pa.array([text, None]))
        assert ids == [np.array(want.encode_ordinary(text), "<u4").tobytes(), b""] and back == [text.encode(), b""]
    assert contracted.count(b" cat") == 1
    assert max(len(bpe.words), len(bpe.chunks)) <= 40 + 28


def test_a_word_is_one_chunk_whatever_follows_it():
    words = word_cache.CachedEncoder(WORD, False)
    texts = ["Dose dose, DOSE.\ndose\nÉté! ×, x(,) don't. DON'T", "<|endoftext|>. <|EndOfText|>.", None, "ΑΣ. aΣ, é. 'S. a\u0301. \n.x.\r\ny."]
    assert words.encode(pa.array(texts)) == [words.whole(x or "") for x in texts]
    assert {"dose", ",", "."} <= words.chunks.keys() and not [x for x in words.chunks if x.lower().startswith("dose") and x != "dose"]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_files.token_digests(none, BYTE, 2).isEmpty()
    assert packing.pack(none, WORD, 1).isEmpty()
    assert byte_bpe.bpe_digests(none, RANKS, public_tokenizers.PATTERN).isEmpty()


def test_rows_of_one_id_spread_and_stay_in_order(spark):
    rows = [(None, f"no id {i}") for i in range(3000)] + [(7, "same") for _ in range(3000)] + [(i, "x") for i in range(100, 400)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows make one task
    df = common.in_order(spark.createDataFrame(rows, "doc_id long, text string").repartition(8))
    parts = df.select(F.spark_partition_id().alias("part"), "doc_id").groupBy("part").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).orderBy("part").collect()
    assert len(parts) > 2 and max(r["n"] for r in parts) < 3000
    ids = [r["doc_id"] for r in df.collect()]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0)) and len(ids) == len(rows)
    found = token_files.token_digests(spark.createDataFrame(rows, "doc_id long, text string"), BYTE, 2).collect()
    spans = sorted((r["start"], r["n_tokens"]) for r in found)
    assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
