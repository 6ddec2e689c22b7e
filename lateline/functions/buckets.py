"""Bucketing: fixed edges, quantile edges and severity bands.

Intervals are open-left, closed-right like ``pd.cut`` (S11); a value outside
every interval gets a null label.  With duplicate edges the first matching
bucket wins (S12) instead of raising.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from lateline.functions import labels as L
from lateline.functions.columns import col_of

__all__ = ["bucketize", "bucket_ord", "severity_band", "risk_level"]


def _edge(e) -> Column:
    return e if isinstance(e, Column) else F.lit(float(e))


def _chain(c: Column, edges: Sequence, outputs: Sequence, include_lowest: bool) -> Column:
    if len(edges) != len(outputs) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    expr = None
    for i, out in enumerate(outputs):
        lo, hi = _edge(edges[i]), _edge(edges[i + 1])
        cond = ((c >= lo) if (include_lowest and i == 0) else (c > lo)) & (c <= hi)
        expr = F.when(cond, F.lit(out)) if expr is None else expr.when(cond, F.lit(out))
    return expr


def bucketize(c, edges: Sequence, labels: Sequence[str], include_lowest: bool = False) -> Column:
    """Label of the interval (edges[i], edges[i+1]] holding ``c``; null outside.
    Edges may be numbers or Columns (e.g. quantiles from a one-row aggregate)."""
    return _chain(col_of(c), edges, list(labels), include_lowest)


def bucket_ord(c, edges: Sequence, include_lowest: bool = False) -> Column:
    """0-based index of the interval holding ``c`` (for ordering labels)."""
    return _chain(col_of(c), edges, list(range(len(edges) - 1)), include_lowest)


def severity_band(c, high: float, mid: float) -> Column:
    """``red`` at or above ``high``, ``orange`` at or above ``mid``, else ``green``."""
    c = col_of(c)
    return (F.when(c >= high, F.lit("red")).when(c >= mid, F.lit("orange"))
            .when(c.isNotNull(), F.lit("green")))


def risk_level(p) -> Column:
    """(0,.3] Low, (.3,.6] Medium, (.6,1] High; exactly 0 has no level (S11)."""
    return bucketize(p, L.RISK_EDGES, L.RISK_LABELS)
