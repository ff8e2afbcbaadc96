"""Language, SimHash, quality rules and quality classifier against brute force, gradients and held-out rows."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from siftlake.llm import language_id, quality_mil, quality_rules, simhash_ring

WORDS = {"en": "the of and thing over water light house", "de": "der und nicht haus über wasser licht straße", "fr": "le dans maison être lumière août mère"}


def corpus(n=360, seed=1):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        lang = list(WORDS)[i % 3]
        own = WORDS[lang].split()
        lines = [" ".join(rng.choice(own, 14)) + f" {i}." for _ in range(6)]
        out.append((i, "\n".join(lines), lang))
    return out


@pytest.fixture(scope="module")
def documents(spark):
    return spark.createDataFrame([(i, t, lang, "s", 0.5, "x") for i, t, lang in corpus()], "doc_id long, text string, lang string, source string, score double, lang_pred string")


def test_languages_on_held_out_rows(spark, documents):
    odd = spark.createDataFrame([(1000, None, "en", "s", 0.1, "y"), (1001, "", "en", "s", 0.1, "y"), (1002, "12 34 !", None, "s", 0.1, "y"), (None, "der und nicht", "de", "s", 0.1, "y"), (3, "the of and " * 9000, "en", "s", 0.1, "y")], documents.schema)
    got = {}
    for r in language_id.predict_languages(documents.unionByName(odd)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    right = [got[i][0]["lang_pred"] == lang for i, _, lang in corpus() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) > 0.95
    assert all(got[i][0]["lang_pred"] == "und" and got[i][0]["score"] == 0 for i in (1000, 1001, 1002))
    assert len(got[3]) == 2 and all(0 <= r["score"] <= 1 for rows in got.values() for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, rows in got.items() for r in rows if i is not None)


def test_nothing_to_learn_from(spark, documents):
    none = documents.limit(0)
    assert language_id.predict_languages(none).isEmpty()
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert language_id.predict_languages(unlabelled).first()["lang_pred"] == "und"
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in quality_mil.quality_scores(documents, labels).collect()} == {0.5}


def numeric(f, w, key, at, step=1e-4):
    w[key][at] += step
    up = f(w)
    w[key][at] -= 2 * step
    down = f(w)
    w[key][at] += step
    return (up - down) / (2 * step)


def test_gradients_through_time():
    rng = np.random.default_rng(0)
    w = {k: v.astype(np.float64) for k, v in language_id.new_weights(3, 4).items()}
    codes, labels = rng.integers(0, 257, (5, 6)), rng.integers(0, 3, 6)
    _, g = language_id.loss_and_gradients(w, codes, labels)
    for key in w:
        at = (int(codes[2, 1]), 3) if key[0] == "x" else (1,) * w[key].ndim
        assert g[key][at] == pytest.approx(numeric(lambda w: language_id.loss_and_gradients(w, codes, labels)[0], w, key, at), rel=0.05, abs=2e-6)


def test_gradients_of_attention():
    rng = np.random.default_rng(0)
    w = quality_mil.new_weights()
    x, first, y = rng.random((9, quality_mil.BUCKETS)), np.array([0, 1, 5]), np.array([1.0, 0.0, 1.0])
    _, g = quality_mil.loss_and_gradients(w, x, first, y)
    for key in w:
        at = (0,) * w[key].ndim
        assert g[key][at] == pytest.approx(numeric(lambda w: quality_mil.loss_and_gradients(w, x, first, y)[0], w, key, at), rel=1e-3, abs=1e-8)


def test_quality_on_held_out_rows(spark):
    rng = np.random.default_rng(3)
    own = sum((x.split() for x in WORDS.values()), [])
    rows = []
    for i in range(600):
        words = rng.choice(own, rng.integers(20, 300))
        rows.append((i, " ".join(words) if i % 3 else " ".join(x.upper() + "!!" for x in words)))
    df = spark.createDataFrame([*rows, (900, None), (901, ""), (None, "the of")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(600)] + [(None, 1, 0)], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r for r in quality_mil.quality_scores(df, labels).collect()}
    assert len(got) == 603 and all(r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    held = [(r["score"], i % 3 > 0) for i, r in got.items() if r["held_out"] and i < 600]
    good, bad = [s for s, y in held if y], [s for s, y in held if not y]
    assert np.mean([np.mean(np.array(good) > b) for b in bad]) > 0.97
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got.values())


def brute_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def brute_classes(values):
    root = list(range(len(values)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(values):
        for j in range(i):
            if bin(a ^ values[j]).count("1") <= 2:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(values))]


def test_simhash_classes(spark):
    texts = [t for _, t, _ in corpus(40)]
    texts += [texts[0], texts[0] + " tail", None, "", " \t", "one two", "One TWO", "x " * 50_000, "ÄÖ é", texts[3].upper()]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in enumerate(texts)], "doc_id long, text string, fp string, component_id int")
    prints = [brute_fingerprint(t) for t in texts]
    got = {r["doc_id"]: r for r in simhash_ring.near_duplicates(df).collect()}
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_classes(prints)
    assert simhash_ring.near_duplicates(df.limit(0)).isEmpty()


@pytest.mark.parametrize("crowd", [2, 64])
def test_links_in_crowds(spark, crowd):
    rng = np.random.default_rng(5)
    values = [int(x) for x in rng.integers(0, 1 << 63, 30)]
    for base in values[:4]:
        values += [base ^ int(sum(1 << int(b) for b in rng.choice(64, 2, False))) for _ in range(40)]
    values = sorted(set(values))
    df = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    pairs = [(r["a"], r["b"]) for r in simhash_ring.links(df, crowd=crowd).collect()]
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    assert all(bin((a ^ b) & (1 << 64) - 1).count("1") <= 2 for a, b in pairs)
    roots = {r["node"]: r["root"] for r in simhash_ring.components(simhash_ring.links(df, crowd=crowd)).collect()}
    want = brute_classes(values)
    assert len({roots.get(v, v) for v in signed}) == len(set(want))
    assert {(want[i], roots.get(v, v)) for i, v in enumerate(signed)}.__len__() == len(set(want))


def test_one_of_each_class_stays(spark):
    df = spark.createDataFrame([(5, "a b c d", "x"), (2, "a b c d", "y"), (2, "a b c d", "y"), (7, "other words here", "z"), (None, None, None)], "doc_id long, text string, _place string")
    kept = simhash_ring.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["_place"]) for r in kept.collect()) == [(0, None), (2, "y"), (7, "z")]


def test_classes_are_told_apart_by_their_texts(spark):
    rows = [(None, "a b c d"), (None, "other words here"), (None, "a b c d"), (2, "first text of two"), (2, "quite another one"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in simhash_ring.keep_one(df).collect()]
    assert len(kept) == 5 and set(kept) == set(rows)
    found = simhash_ring.near_duplicates(df).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in found) == [(0, 0)] * 4 + [(2, 2)] * 2


def brute_rules(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered), failed


def test_quality_rules(spark):
    texts = [t for _, t, _ in corpus(60)]
    texts += [None, "", " \n\t ", "a b c a b c", "x\x0by z\x0cw", "#*$ <b> 100% |", "same line\nsame line\n\n \nsame line", "a " * 30_000, "日本 語 é b " * 40, texts[0], "### *** " * 80 + "junk $$$ " * 80]
    df = spark.createDataFrame([(i, t, [1]) for i, t in enumerate(texts)], "doc_id long, text string, tokens array<int>")
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,), (2,)], "doc_id long")
    got = {r["doc_id"]: r for r in quality_rules.rule_report(df, trusted).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == brute_rules(t), (i, t and t[:40])
        assert r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.THRESHOLD)
    assert got[0]["score"] > got[len(texts) - 1]["score"]
    assert quality_rules.rule_report(df.limit(0), trusted).isEmpty()
    kept = quality_rules.keep_good(df, trusted)
    assert kept.columns == df.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, r in got.items() if r["kept"])


def test_ratio_is_the_two_multinomials(spark):
    docs = [(0, "aa bb aa"), (1, "cc dd"), (2, "aa cc")]
    df, trusted = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(0,)], "doc_id long")

    def grams(text):
        t = text.split()
        hashes = [xxhash.xxh64_intdigest(x, 42) for x in t]
        as_bytes = [x.to_bytes(8, "little") for x in hashes]
        hashes += [xxhash.xxh64_intdigest(b, xxhash.xxh64_intdigest(a, 42)) for a, b in zip(as_bytes, as_bytes[1:], strict=False)]
        return [int(np.uint64(h).astype(np.int64)) % quality_rules.BUCKETS for h in hashes]

    raw, target = Counter(x for _, t in docs for x in grams(t)), Counter(grams(docs[0][1]))
    size = quality_rules.BUCKETS
    weight = lambda x: np.log((target[x] + 1) / (sum(target.values()) + size)) - np.log((raw[x] + 1) / (sum(raw.values()) + size))
    got = {r["doc_id"]: r["score"] for r in quality_rules.rule_report(df, trusted).collect()}
    for i, t in docs:
        assert got[i] == pytest.approx(np.mean([weight(x) for x in grams(t)]))


def test_copies_do_not_mark_a_text_down(spark):
    rows = [(i, t) for i, t, _ in corpus(60)]
    copied = corpus(61)[60][1]
    df = spark.createDataFrame([*rows, *[(1000 + i, copied) for i in range(300)]], "doc_id long, text string")
    trusted = spark.createDataFrame([(i,) for i in range(60)], "doc_id long")
    got = {r["doc_id"]: r for r in quality_rules.rule_report(df, trusted).collect()}
    assert len(got) == 360 and all(got[1000 + i]["kept"] for i in range(300))
    once = spark.createDataFrame([*rows, (1000, copied)], df.schema)
    single = {r["doc_id"]: r["score"] for r in quality_rules.rule_report(once, trusted).collect()}
    assert all(got[i]["score"] == pytest.approx(s) for i, s in single.items())
    # trusted through one of its copies: each text once on both sides
    more = trusted.unionByName(spark.createDataFrame([(1007,)], "doc_id long"))
    a = {r["doc_id"]: r["score"] for r in quality_rules.rule_report(df, more).collect()}
    b = {r["doc_id"]: r["score"] for r in quality_rules.rule_report(once, trusted.unionByName(spark.createDataFrame([(1000,)], "doc_id long"))).collect()}
    assert all(a[i] == pytest.approx(s) for i, s in b.items())


def test_one_id_in_most_rows_leaves_the_samples_whole(spark):
    rows = [(i, t, "en" if i % 2 else "fr") for i, t, _ in corpus(60)]
    hot = next(i for i in range(1000, 1100) if zlib.crc32(str(i).encode()) % 4 != 2 and zlib.crc32(str(i).encode()) % 5)
    df = spark.createDataFrame([*rows, *[(hot, f"row {n} of one id", "de") for n in range(2000)], (hot + 1, "two languages", "en"), (hot + 1, "two languages", "fr")],
                               "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(hot, 1)] * 50 + [(59, 0)], "doc_id long, quality int")
    x, bags, y = quality_mil.sample(df, labels, docs=20, bag=4)
    learnt = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert set(y.tolist()) == {0.0, 1.0} and len(y) == sum(min(20, sum(i % 2 == c for i in [*learnt, hot] if i != 59)) for c in (0, 1))
    assert len(x) == len(bags) <= 4 * len(y)
    codes, numbers, names = language_id.sample(df, docs=5, per_doc=1)
    assert names == ["de", "en", "fr"] and np.bincount(numbers).tolist() == [1, 5, 5]
