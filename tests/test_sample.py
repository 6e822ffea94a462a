"""Differences on a sample of keys and their bound."""

import hashlib
import math

import pytest

from freightlane.operators import reconcile, sample
from tests.conftest import rows


def table(spark, n, changed=()):
    return spark.createDataFrame([(i, None if i % 5 == 0 else f"p{i % 3}", "other" if i in changed else "v") for i in range(n)], "k long, p string, v string")


def chosen(k, p, rate):
    return hashlib.md5(f"{k}|{p or ''}".encode()).hexdigest()[:8] < f"{round(rate * 16**8):08x}"


@pytest.mark.parametrize("rate", [0.05, 0.3])
def test_the_sample_is_the_same_on_both_sides(spark, rate):
    source, target = table(spark, 2000), table(spark, 2000, changed=set(range(0, 2000, 4))).filter("k <> 17")
    found = sample.sampled_diff(source, target, ["k", "p"], rate, confidence=0.9999)
    picked = {(r["k"], r["p"]) for r in source.collect() if chosen(r["k"], r["p"], rate)}
    full = [r for r in rows(reconcile.row_diff(source, target, ["k", "p"])) if (r[0], r[1]) in picked]
    assert rows(found.differences) == full and (found.keys, found.differing) == (len(picked), len(full))
    assert found.differing / found.keys < 501 / 2000 + 0.2 and found.bound >= 501 / 2000  # but for one sample in 10,000


def test_rates(spark):
    assert sample.sampled_diff(table(spark, 50), table(spark, 50), ["k"], 1).keys == 50
    assert sample.sampled_diff(table(spark, 0), table(spark, 0), ["k"], 0.5)[:3] == (0, 0, 1.0)
    for wrong in (0, 1.5):
        with pytest.raises(ValueError):
            sample.threshold(wrong)


@pytest.mark.parametrize(("differing", "keys"), [(0, 1), (0, 1000), (3, 50), (49, 50), (20, 200), (500, 1000)])
@pytest.mark.parametrize("confidence", [0.9, 0.99, 0.9999])
def test_bound_against_sums_of_the_binomial_distribution(differing, keys, confidence):
    share = sample.share_bound(differing, keys, confidence)
    below = math.fsum(math.comb(keys, i) * share**i * (1 - share) ** (keys - i) for i in range(differing + 1))
    assert below == pytest.approx(1 - confidence, rel=1e-6)


def test_bounds_of_large_samples():
    assert sample.share_bound(5, 5) == 1.0 and sample.share_bound(0, 0) == 1.0
    assert sample.share_bound(0, 10**8) == pytest.approx(-math.log(0.01) / 10**8, rel=1e-6)
    assert 0.005 < sample.share_bound(500_000, 10**8) < 0.00503
