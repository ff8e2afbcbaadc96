"""Quality rules with an importance score (operator 9); DataFrame functions only.

Base rules count words, repeated windows, repeated lines and symbols. A document that passes them is judged by
the log-likelihood ratio of its hashed n-grams under two smoothed multinomials, one counted over the trusted
documents and one over the whole raw corpus, divided by the number of its n-grams. It is kept if that mean is
at least ``THRESHOLD``. Tokens are runs of letters, digits and underscores, or of other marks; n-grams are
single tokens and pairs of neighbours, hashed into ``BUCKETS``.

Both multinomials are counts over all their documents, each distinct text once however many rows hold it, so
that no text is marked down for being copied; it is trusted if one of its rows is. Only the weights per bucket,
of fixed number, pass through the driver. Without a trusted document every ratio is zero.

A null or empty text has no words and fails the base rules; null ids are documents that are never trusted;
repeated rows are rows of their own and are judged each; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.functions.plan import fence
from siftlake.session import checkpointed

BUCKETS, SMOOTHING, THRESHOLD = 1 << 16, 1.0, -0.4
#: Trusted ids, and trusted or repeated texts, that are sent to every executor, 16 MB or so; above it the documents are shuffled to them.
TRUSTED_ROWS = 1_000_000
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
TOKEN = r"[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_\s]+"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(0))


def hashed(strings: Column) -> Column:
    """The hash of each string: what follows works on plain longs."""
    return F.transform(strings, lambda x: F.xxhash64(x))


def runs(hashes: Column, length: int) -> Column:
    """A hash of each run of ``length`` neighbours."""
    each = F.transform(hashes, lambda x, i: F.xxhash64(x, *[F.get(hashes, i + k) for k in range(1, length)]))
    return F.slice(each, 1, F.greatest(F.size(hashes) - (length - 1), F.lit(0)))


def bucket(value: Column) -> Column:
    return F.pmod(value, F.lit(BUCKETS)).cast("int")


def bucketed(documents: DataFrame, *keep: str) -> DataFrame:
    """The columns ``keep`` and ``bucket``, a row for each token and each pair of neighbours."""
    rows = fence(documents.select(*keep, hashed(tokens(F.col("text"))).alias("hashes")), "hashes")
    rows = fence(rows.select(*keep, F.concat("hashes", runs(F.col("hashes"), 2)).alias("grams")), "grams")
    rows = rows.select(*keep, F.explode("grams").alias("gram"))
    return rows.select(*keep, bucket(F.col("gram")).alias("bucket"))


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= TRUSTED_ROWS else df


def text_facts(documents: DataFrame, trusted: DataFrame) -> DataFrame:
    """text_hash, copies (rows), trusted (1 or null) of the texts that are trusted or in several rows."""
    ids = trusted.select(F.col("doc_id").cast("long").alias("doc_id")).filter("doc_id IS NOT NULL").distinct()
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))
    marked = rows.join(_few(ids).withColumn("trusted", F.lit(1)), "doc_id", "left")
    facts = marked.groupBy("text_hash").agg(F.count("*").alias("copies"), F.max("trusted").alias("trusted"))
    return checkpointed(facts.filter("copies > 1 OR trusted = 1"))


def weights(documents: DataFrame, trusted: DataFrame) -> list[float]:
    """Per bucket, the logarithm of its trusted over its raw probability. ``trusted``: doc_id."""
    rows = documents.select(F.col("text").cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))
    marked = rows.join(_few(text_facts(documents, trusted)), "text_hash", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))
    each = bucketed(marked, "copies", "trusted")
    # All rows of texts with the same number of copies count together, so that number divides the counts.
    counts = each.groupBy("bucket", "copies").agg(F.count("*").alias("raw"), F.count("trusted").alias("target"))
    counts = counts.groupBy("bucket").agg(F.expr("sum(raw div copies)").alias("raw"), F.expr("sum(target div copies)").alias("target"))
    raw, target = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():  # BUCKETS rows at most
        raw[row["bucket"]], target[row["bucket"]] = row["raw"], row["target"]
    if not sum(target):
        return [0.0] * BUCKETS
    from math import log

    base = log(sum(target) + SMOOTHING * BUCKETS) - log(sum(raw) + SMOOTHING * BUCKETS)
    return [log(t + SMOOTHING) - log(r + SMOOTHING) - base for t, r in zip(target, raw, strict=True)]


def _repeat_words(windows: Column) -> Column:
    """From the sorted (hash, place) of all windows, the places of those that occur twice, sorted."""
    size = F.size(windows)
    return F.filter(windows, lambda x, i: ((i > 0) & (F.get(windows, F.greatest(i - 1, F.lit(0)))["h"] == x["h"]))
                    | ((i < size - 1) & (F.get(windows, i + 1)["h"] == x["h"])))


def _score(hashes: Column, bucket_weights: list[float]) -> Column:
    """The mean weight of the tokens and pairs whose tokens have these hashes."""
    literal = F.split(F.lit(",".join(map(repr, bucket_weights))), ",").cast("array<double>")
    pair = lambda x, i: F.when(i > 0, F.get(literal, bucket(F.xxhash64(F.get(hashes, i - 1), x)))).otherwise(F.lit(0.0))
    each = F.transform(hashes, lambda x, i: F.get(literal, bucket(x)) + pair(x, i))
    return F.aggregate(each, F.lit(0.0), lambda a, x: a + x) / F.greatest(2 * F.size(hashes) - 1, F.lit(1))


def judged(documents: DataFrame, bucket_weights: list[float]) -> DataFrame:
    """The documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, score."""
    own = documents.columns
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    df = documents.select("*", text.alias("_text"))
    trimmed = F.btrim(F.col("_text"), F.lit(BLANK))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t\\n\\x0B\\f\\r]+"))
    worded = F.filter(F.split(F.col("_text"), "\n"), lambda x: x.rlike("[^ \\t\\n\\x0B\\f\\r]"))
    df = fence(df.select("*", words.alias("_words"), worded.alias("_lines"), hashed(tokens(F.col("_text"))).alias("_tokens")), "_words", "_lines", "_tokens")
    kept = [F.col(f"`{c}`") for c in own] + [
        F.size("_words").cast("long").alias("_n"), F.length(F.array_join("_words", "")).cast("long").alias("_chars"),
        (F.size(F.split("_text", f"[{SYMBOLS}]")) - 1).cast("long").alias("_symbols"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("_dup")]
    df = fence(df.select(*kept, "_tokens", hashed(F.col("_words")).alias("_words")), "_words")
    kept = [F.col(f"`{c}`") for c in (*own, "_n", "_chars", "_symbols", "_dup")]
    df = fence(df.select(*kept, runs(F.col("_words"), 3).alias("_windows"), _score(F.col("_tokens"), bucket_weights).alias("_score")), "_windows", "_score")
    # Only a text that repeats a window needs the windows' places.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    placed = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    df = fence(df.select("*", F.when(repeats, placed).alias("_sorted")), "_sorted")
    df = fence(df.select("*", F.when(F.col("_sorted").isNotNull(), F.sort_array(F.transform(_repeat_words(F.col("_sorted")), lambda x: x["i"]))).alias("_places")), "_places")
    covered = F.aggregate("_places", F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
                          lambda a, x: F.struct(x.alias("last"), (a["n"] + F.least(F.lit(3), x - a["last"])).alias("n")), lambda a: a["n"])
    return df.select(
        *[F.col(f"`{c}`") for c in own], F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"), F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.col("_score").alias("score"))


def _named(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _verdicts(rows: DataFrame, threshold: float) -> DataFrame:
    rows = fence(rows, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("score") >= threshold))


def rule_report(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, the five counts, base_failed, kept, score."""
    rows = _verdicts(judged(_named(documents), weights(documents, trusted)), threshold)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "score")


def keep_good(documents: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with their own columns."""
    whole = F.struct(*[F.col(f"`{c}`") for c in documents.columns])
    packed = documents.select(whole.alias("_row"), F.col("text").cast("string").alias("text"))
    rows = _verdicts(judged(packed, weights(documents, trusted)), threshold).filter("kept")
    return rows.select("_row.*")
