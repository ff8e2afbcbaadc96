"""Event refinement on Spark: DataFrame in, DataFrame out, batch or stream."""

from siftlake.plans.refine import RefineResult, refine
from siftlake.session import build_session, configure

__all__ = ["RefineResult", "build_session", "configure", "refine"]
