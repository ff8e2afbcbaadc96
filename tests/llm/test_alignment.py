"""Token alignment against plain loops over every token pair."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from siftlake.llm import queries
from siftlake.llm.token_alignment import align, alignment_report, gallop, overlaps


@pytest.fixture(scope="module")
def libraries():
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.BYTE_VOCABULARY)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def tokens(libraries, text):
    """(id, bytes) of both sides, by the libraries alone."""
    a, b = libraries
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in plain} | {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in plain)}
    left = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids] if text else []
    right = []
    for i in b.encode(text) if text else []:
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    return (left, right) if text and all(b"".join(x for _, x in side) == wanted for side in (left, right)) else ([], [])


def spans(side):
    ends = np.cumsum([0, *[len(x) for _, x in side]]).tolist()
    return list(zip([i for i, _ in side], ends, ends[1:], strict=False))


def brute(libraries, rows):
    """The report by comparing byte ranges, in no order."""
    seen, links = [], []
    for doc_id, text in rows:
        a, b = (spans(x) for x in tokens(libraries, text or ""))
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = [";".join("%s|%s" % tuple(",".join(str(i) for i, _, e in side if low < e <= high) for side in (a, b))
                           for low, high in zip([0, *cuts], cuts, strict=False))][0]
        seen.append((doc_id, len(a), len(b), len(cuts), groups))
    counts = Counter(x for found in links for x in found)
    highest = Counter()
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    return sorted(((d, a, b, g, len(found), sum(counts[x] == highest[x[1]] for x in found), sum(counts[x] for x in found),
                   hashlib.sha256(groups.encode()).hexdigest() if a else "") for (d, a, b, g, groups), found in zip(seen, links, strict=True)), key=str)


TEXTS = [
    "The quick brown fox.", "", None, " leading and  double blanks ", "tabs\tand\nlines\n\n\nmore", "naïve café Ünïcödé über straße", "日本語のテキスト 漢字",
    "emoji 👩‍👩‍👧 family", "<|endoftext|> and <s> and </s> <unk> <0x41>", "under▁score", "a▁b c", "zero\x00byte", "ﬁ ligature é combining", "   ", "\n", "nb sp　ce ​",
    "supercalifragilisticexpialidocious " * 3, "!!!???...;;;", "1234567890 12 3", "x" * 300, "mixed日本 text▁", "The quick brown fox.", "Den Haag, größer; ñandú"]


def report(df):
    return alignment_report(df, queries.BYTE_VOCABULARY, queries.PIECE_MODEL)


def test_report_against_all_pairs(spark, libraries):
    rows = [(i if i != 4 else None, x) for i, x in enumerate(TEXTS)] + [(3, TEXTS[3]), (3, TEXTS[3])]
    df = spark.createDataFrame([(i, x, "p", 1) for i, x in rows], "doc_id long, text string, pairs string, block int").repartition(3)
    got = [tuple(r) for r in report(df).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()]
    assert sorted(got, key=str) == brute(libraries, rows)
    assert [r for r in got if r[0] == 9] == [(9, 0, 0, 0, 0, 0, 0, "")]
    assert report(df.limit(0)).isEmpty()
    assert [tuple(r) for r in report(df.filter("doc_id IN (1, 2)")).collect()] in ([(i, 0, 0, 0, 0, 0, 0, "") for i in x] for x in ((1, 2), (2, 1)))


def test_report_of_the_given_documents(spark, libraries):
    folder = "/root/testdata/sf0.001"
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet' WHERE length(text) < 1500").fetchall()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = report(df).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()
    assert len(rows) > 50 and sorted(map(tuple, got), key=str) == brute(libraries, rows)


def test_groups_give_the_text_back(spark, libraries):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for row in align(df, queries.BYTE_VOCABULARY, queries.PIECE_MODEL).collect():
        a, b = tokens(libraries, TEXTS[row["doc_id"]] or "")
        assert (row["a_ids"], row["b_ids"]) == ([i for i, _ in a], [i for i, _ in b])
        at = (0, 0)
        for i, j in row["groups"]:
            assert b"".join(x for _, x in a[at[0]:i]) == b"".join(x for _, x in b[at[1]:j]) != b""
            at = (i, j)
        assert at == (len(a), len(b))


@pytest.mark.parametrize("steps", [1, 2, 7, 4096])
def test_gallop_ranks(steps):
    rng = np.random.default_rng(steps)
    for sizes in ((1, 1), (3, 500), (200, 210), (40, 4000)):
        long = np.cumsum(rng.integers(1, 9, sizes[1]))
        short = np.unique(np.append(rng.integers(1, long[-1] + 1, sizes[0] - 1), long[-1]))
        assert gallop(short, long, steps).tolist() == np.searchsorted(long, short).tolist()


def test_links_are_the_overlapping_ranges():
    rng = np.random.default_rng(3)
    for _ in range(30):
        a, b = (np.unique(np.append(rng.integers(1, 60, n), 60)) for n in rng.integers(0, 40, 2))
        found = overlaps(a, b)
        assert a[found.a].tolist() == b[found.b].tolist() == sorted(set(a.tolist()) & set(b.tolist()))
        starts = [np.concatenate([[0], x[:-1]]) for x in (a, b)]
        want = {(i, j) for i in range(len(a)) for j in range(len(b)) if starts[0][i] < b[j] and starts[1][j] < a[i]}
        assert set(zip(found.link_a.tolist(), found.link_b.tolist(), strict=True)) == want and len(found.link_a) == len(want)


def test_a_long_word_without_blanks(spark, libraries):
    text = "abc1é" * 40_000
    row = report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    a, b = tokens(libraries, text)
    assert (row["n_a"], row["n_b"]) == (len(a), len(b)) and row["n_links"] >= max(len(a), len(b)) and row["count_sum"] >= row["n_links"]
