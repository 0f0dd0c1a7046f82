"""Aggregate helpers that stay defined on degenerate input under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_corr(a, b) -> Column:
    """Pearson correlation; null (pandas NaN) when either side has zero variance.
    ``F.corr`` divides by zero on a constant column when ANSI mode is on."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    both = a.isNotNull() & b.isNotNull()  # pairwise-complete rows, like corr()
    aa, bb = F.when(both, a), F.when(both, b)
    den = F.stddev_pop(aa) * F.stddev_pop(bb)
    return F.try_divide(F.covar_pop(aa, bb), F.nullif(den, F.lit(0.0)))
