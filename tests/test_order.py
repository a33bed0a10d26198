"""The order of an autoregression, searched as far as the number of rows allows."""

import numpy as np
import pytest

from barforge.operators import series
from barforge.plans import features
from barforge.plans.registry import QUERIES


@pytest.fixture(scope="module")
def seasonal(spark):
    """Two series that depend on their value of six rows before."""
    rng, rows = np.random.default_rng(3), []
    for symbol in "ab":
        y = rng.normal(size=600)
        for i in range(6, 600):
            y[i] += 0.9 * y[i - 6]
        rows += [(symbol, i, float(v + 50)) for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "symbol string, idx long, value double").cache()


def test_order_above_four_is_found(spark, seasonal, monkeypatch):
    monkeypatch.setattr(features, "_close", lambda *_: seasonal)
    row = QUERIES["ar_order"](spark, "").first()
    inflation = series.vif(seasonal, 6)
    assert (row.p, row.advice) == (6, series.recommend(inflation)) and abs(row.largest_vif - max(inflation)) < 1e-9


@pytest.mark.parametrize("block", [64, 65_536])
def test_blocks_sum_to_the_gram_matrix(seasonal, block):
    g, n = series.wide_gram(seasonal, 8, block=block)
    want, m = series.gram(seasonal, 8)
    assert n == m == 2 * (600 - 8)
    np.testing.assert_allclose(g, want, rtol=1e-10)
