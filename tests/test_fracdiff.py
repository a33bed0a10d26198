"""Fractional differences with all of their weights."""

import numpy as np

from barforge.operators import series
from barforge.plans.registry import QUERIES
from barforge.sources import tape
from tests.conftest import SMALL


def test_weights_reach_the_operators_threshold(spark):
    w = series.fracdiff_weights(0.5, 5000)
    rows = tape.trades_from_lineitem(spark, SMALL).where("symbol = 'A'").orderBy("seq").toPandas()["price"].to_numpy()
    got = QUERIES["frac_diff_wide"](spark, SMALL).where("symbol = 'A'").orderBy("idx").toPandas()
    assert len(w) == 928 and got["idx"].tolist() == list(range(927, len(rows)))
    want = [w @ rows[i - 927 : i + 1][::-1] for i in range(927, len(rows))]
    np.testing.assert_allclose(got["value"].to_numpy(), want, atol=1e-4)
