"""Score-vector column functions, all computed in double precision."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(x: Column) -> Column:
    return F.transform(x, lambda v: v.cast("double"))


def _minus_each(xd: Column, c: Column) -> Column:
    """``xd - c`` element-wise. ``c`` is passed as an argument (evaluated once),
    never captured in the lambda (which Spark evaluates per element)."""
    return F.zip_with(xd, F.array_repeat(c, F.size(xd)), lambda v, k: v - k)


def logsumexp(x: Column) -> Column:
    """``log(sum(exp(x)))`` shifted by the maximum for stability."""
    xd = as_double(x)
    m = F.array_max(xd)
    return m + F.log(F.aggregate(_minus_each(xd, m), F.lit(0.0), lambda acc, v: acc + F.exp(v)))


def log_softmax(x: Column) -> Column:
    """Log-softmax over the vocabulary axis of one score vector."""
    return _minus_each(as_double(x), logsumexp(x))


def top1(x: Column) -> Column:
    """0-based index of the best score; ties go to the lowest index."""
    return F.array_position(x, F.array_max(x)).cast("int") - 1


def nll(x: Column, target: Column) -> Column:
    """Negative log-likelihood of the 0-based ``target`` under scores ``x``."""
    return logsumexp(x) - F.element_at(x, target + 1).cast("double")


def uniform_nll(x: Column) -> Column:
    """Mean over the vocabulary of ``-log_softmax(x)`` (the smoothing term)."""
    xd = as_double(x)
    mean = F.aggregate(xd, F.lit(0.0), lambda acc, v: acc + v) / F.size(xd)
    return logsumexp(x) - mean


def smoothed_nll(x: Column, target: Column, smoothing: float) -> Column:
    """Label-smoothed cross-entropy of one position:
    ``(1 - e) * nll + e * mean_k(-log_softmax_k)``."""
    if smoothing == 0:
        return nll(x, target)
    return (1.0 - smoothing) * nll(x, target) + smoothing * uniform_nll(x)
