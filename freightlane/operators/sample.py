"""Row differences on a sample of keys, with an exact bound on what the sample may have missed.

A key is in the sample if the first digits of its MD5 are below a threshold. That is the same choice on both sides and in any
engine, so a database can make it in its own query, and a larger sample holds a smaller one. Rows outside the sample are
neither compared nor shuffled. reconcile.row_diff() remains the way to be certain.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from freightlane.functions.scalars import quoted
from freightlane.operators.reconcile import row_diff

DIGITS = 8


class SampledDiff(NamedTuple):
    """keys: distinct keys of either side in the sample; differing: those that differ; bound: with the given confidence at
    most that share of all keys differs; differences: their rows, as row_diff() gives them."""

    keys: int
    differing: int
    bound: float
    differences: DataFrame


def threshold(rate: float) -> str:
    """The hexadecimal number below which that share of all hashes lies."""
    if not 0 < rate <= 1:
        raise ValueError("a rate is above 0 and at most 1")
    return f"{min(round(rate * 16**DIGITS), 16**DIGITS - 1):0{DIGITS}x}" if rate < 1 else "g"


def in_sample(key: Sequence[str], rate: float) -> Column:
    """Whether a row's key is in the sample. Key parts are compared as text, NULL as the empty text, joined by '|'."""
    parts = [F.coalesce(F.col(quoted(k)).cast("string"), F.lit("")) for k in key]
    return F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, DIGITS) < threshold(rate)


def _beta_share(x: float, a: float, b: float) -> float:
    """The regularized incomplete beta function, by the convergents of its continued fraction."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - _beta_share(1 - x, b, a)
    ratio_up, ratio_down, value = 1.0, 0.0, 1.0
    for i in range(20_000):
        m = (i + 1) // 2
        if i % 2:
            step = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        else:
            step = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        ratio_down = 1 / (1 + step * ratio_down)
        ratio_up = 1 + step / ratio_up
        value *= ratio_up * ratio_down
        if abs(ratio_up * ratio_down - 1) < 1e-14:
            break
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    return math.exp(log_front) / (a * value)


def share_bound(differing: int, keys: int, confidence: float = 0.99) -> float:
    """The largest share of differing keys with which so few in a sample still have a chance of 1 - confidence.

    This is the exact (Clopper-Pearson) bound of the binomial distribution; without a sample it is 1.
    """
    if differing >= keys:
        return 1.0
    low, high = 0.0, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        # The chance of more than `differing` among `keys`, if that were the share.
        low, high = (middle, high) if _beta_share(middle, differing + 1, keys - differing) < confidence else (low, middle)
    return high


def sampled_diff(source: DataFrame, target: DataFrame, key: Sequence[str], rate: float, confidence: float = 0.99) -> SampledDiff:
    """Compare the rows of a share of all keys. Both sides are scanned, and only sampled rows are shuffled."""
    chosen = [df.filter(in_sample(key, rate)) for df in (source, target)]
    names = [quoted(k) for k in key]
    differences = row_diff(*chosen, key)
    both = chosen[0].select(*names).unionByName(chosen[1].select(*names)).distinct()
    keys, differing = both.count(), differences.count()
    return SampledDiff(keys, differing, share_bound(differing, keys, confidence), differences)
