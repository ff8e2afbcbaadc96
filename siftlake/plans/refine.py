"""The whole pipeline: normalize, validate, dedup, route."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftlake.functions.timestamps import as_instant
from siftlake.operators.dedup import DedupPolicy, mark_duplicates
from siftlake.operators.normalize import Mapping, normalize
from siftlake.operators.validate import error_reason, validate
from siftlake.schema import CANONICAL_COLUMNS
from siftlake.session import remove_path, scratch_path
from siftlake.sources.kafka import MALFORMED_REASON

PROCESSED, DUPLICATE, VALIDATION, UNHANDLED = "processed", "duplicate", "validation", "unhandled_error"
MALFORMED = "malformed"
OUTCOMES = (PROCESSED, DUPLICATE, VALIDATION, UNHANDLED, MALFORMED)
REJECTED = (VALIDATION, UNHANDLED, MALFORMED)
UNHANDLED_REASON = "unhandled processing error"


def evaluate(
    raw: DataFrame, as_of: object = None, mappers: dict[str, Mapping] | None = None
) -> DataFrame:
    """Normalize and validate; ``verdict`` is the outcome before dedup (NULL: still open).

    Every event carries one payload: the cleaned one, or for a rejected event
    ``raw_payload``, as it came. Events the source marks as ``malformed`` are
    rejected unseen; one without a usable id gets an empty one.
    """
    checked = validate(normalize(raw, as_of, mappers), as_of)
    malformed = F.col("malformed") if "malformed" in checked.columns else F.lit(False)
    verdict = (
        F.when(malformed, F.lit(MALFORMED)).when(F.col("parse_error"), F.lit(UNHANDLED))
        .when(~F.col("is_valid"), F.lit(VALIDATION))
    )
    reason = (
        F.when(malformed, F.lit(MALFORMED_REASON)).when(F.col("parse_error"), F.lit(UNHANDLED_REASON))
        .when(~F.col("is_valid"), error_reason(F.col("violations")))
    )
    rejected = F.col("verdict").isNotNull()
    columns = {name: F.col(name) for name in CANONICAL_COLUMNS}
    if "malformed" in checked.columns:
        columns["event_id"] = F.when(malformed, F.coalesce("event_id", F.lit(""))).otherwise(F.col("event_id")).alias("event_id")
    columns["payload"] = F.when(~rejected, F.col("payload")).alias("payload")
    return checked.withColumn("verdict", verdict).select(
        *columns.values(), "seq", F.when(rejected, F.col("raw_payload")).alias("raw_payload"),
        "ts_fallback", "verdict",
        reason.alias("error_reason"),
        F.when(F.col("verdict") == VALIDATION, F.col("violations")["rule"]).alias("failed_rules"),
    )


def outcome_column() -> Column:
    return (
        F.when(F.col("verdict").isNotNull(), F.col("verdict"))
        .when(F.col("is_duplicate"), F.lit(DUPLICATE))
        .otherwise(F.lit(PROCESSED))
    )


def _with_outcome(marked: DataFrame) -> DataFrame:
    return marked.withColumn("outcome", outcome_column()).drop("verdict", "is_duplicate")


@dataclass(frozen=True)
class RefineResult:
    """``classified`` holds every input event once, with its ``outcome``.

    ``source`` is that frame, or what makes it: duplicates are decided when it
    is first asked for, so ``dlq`` alone costs no decision.
    """

    source: DataFrame | Callable[[], DataFrame]
    as_of: object = None
    stage_path: str | None = None
    rejected: DataFrame | None = None

    @cached_property
    def classified(self) -> DataFrame:
        return self.source() if callable(self.source) else self.source

    @property
    def valid(self) -> DataFrame:
        return self.classified.filter(F.col("outcome") == PROCESSED).select(*CANONICAL_COLUMNS, "seq")

    @property
    def duplicates(self) -> DataFrame:
        return self.classified.filter(F.col("outcome") == DUPLICATE).select(*CANONICAL_COLUMNS, "seq")

    @property
    def dlq(self) -> DataFrame:
        return dlq_records(self.classified if self.rejected is None else self.rejected, self.as_of)

    @property
    def metrics(self) -> DataFrame:
        """Events per source and outcome; every counter is a sum over it."""
        return self.classified.groupBy("source", "outcome").agg(F.count("*").alias("n"))

    def discard(self) -> None:
        """Remove the stage once all outputs are written."""
        if self.stage_path is not None:
            remove_path((self.classified if self.rejected is None else self.rejected).sparkSession, self.stage_path)


def dlq_records(classified: DataFrame, as_of: object = None) -> DataFrame:
    """Rejected events with their payload as it came, before any mapping."""
    rejected = classified.filter(F.col("outcome").isin(*REJECTED))
    return rejected.select(
        "seq", "event_id", "source", "raw_payload", "error_reason",
        as_instant(as_of).alias("first_seen_at"),
        "outcome",
        "failed_rules",
    )


def staged(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet and read from there; a folder that exists is refused."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refine(
    raw: DataFrame,
    as_of: object = None,
    policy: DedupPolicy | str = "first",
    mappers: dict[str, Mapping] | None = None,
    stage: bool = True,
    stage_path: str | None = None,
) -> RefineResult:
    """Classify raw events (``seq, event_id, source, payload, received_at``).

    ``as_of`` is the processing time: None for the current one, or an instant
    (ISO text with zone, or a Column) for repeatable runs. A rejected event
    never registers its id. ``raw`` may have ``malformed`` beside these columns,
    as from ``kafka_to_raw`` and ``merge_sources``.

    Dedup looks at the events twice: at three columns to decide, and at all of
    them to mark. Parsing costs far more than writing and reading, so the
    evaluated events are staged once, and the first look reads only its columns.
    ``stage=False`` parses twice and writes nothing. The stage goes to
    ``stage_path``, which must not exist yet; by default it is under the shared folder.
    """
    policy = DedupPolicy(policy) if isinstance(policy, str) else policy
    evaluated = evaluate(raw, as_of, mappers)
    path = None
    if stage and policy.kind != "off":
        path = stage_path or scratch_path(raw.sparkSession, "stage")
        evaluated = staged(evaluated, path)
    if path is None:
        return RefineResult(lambda: _with_outcome(mark_duplicates(evaluated, policy, eligible=F.col("verdict").isNull())), as_of, path)
    # Rejected events need no decision: they go around the dedup join.
    rejected = _with_outcome(evaluated.filter(F.col("verdict").isNotNull()).withColumn("is_duplicate", F.lit(False)))
    open_events = evaluated.filter(F.col("verdict").isNull())
    return RefineResult(lambda: _with_outcome(mark_duplicates(open_events, policy)).unionByName(rejected), as_of, path, rejected)
