"""Regressions from Gram matrices, whole grids, and models, each against a plain version."""

import math

import numpy as np
import pytest

from barforge.functions.ticks import with_net, with_side
from barforge.operators import entropy, forest, regress, series, validation
from barforge.sources import shared


@pytest.fixture(scope="module")
def lagged():
    rng, p, n = np.random.default_rng(5), 5, 400
    y = rng.normal(size=n + p)
    for i in range(p, n + p):
        y[i] += 0.5 * y[i - 1] + 0.3 * y[i - 4]
    x = np.stack([y[p - k : n + p - k] for k in range(1, p + 1)], 1)
    whole = np.c_[np.ones(n), y[p:], x]
    return whole.T @ whole, n, x, y[p:]


def test_least_squares_and_ridge(lagged):
    g, n, x, y = lagged
    want = np.linalg.lstsq(np.c_[np.ones(n), x], y, rcond=None)[0]
    made = regress.fit(g, n, 5, "ols")
    np.testing.assert_allclose(made["params"], want, atol=1e-9)
    error = y - np.c_[np.ones(n), x] @ want
    assert abs(made["r2"] - (1 - error.var() / y.var())) < 1e-9 and abs(made["rmse"] - np.sqrt((error**2).mean())) < 1e-9
    xc, yc = x - x.mean(0), y - y.mean()
    np.testing.assert_allclose(regress.fit(g, n, 5, "ridge", 7.0)["params"][1:], np.linalg.solve(xc.T @ xc + 7 * np.eye(5), xc.T @ yc), atol=1e-9)
    assert regress.fit(g, n, 5)["method"] == "ols"
    with pytest.raises(ValueError):
        regress.fit(g, n, 5, "none")


@pytest.mark.parametrize(("method", "share"), [("lasso", 1.0), ("elastic_net", 0.5)])
def test_penalised_fits_are_optimal(lagged, method, share):
    """No coefficient can move to a smaller penalised error."""
    g, n, x, y = lagged
    alpha = 0.1
    w = regress.fit(g, n, 5, method, alpha)["params"][1:]
    slope = (x - x.mean(0)).T @ (y - y.mean() - (x - x.mean(0)) @ w) / n - alpha * (1 - share) * w
    for j in range(5):
        assert abs(slope[j] - alpha * share * np.sign(w[j])) < 1e-7 if w[j] else abs(slope[j]) <= alpha * share + 1e-9
    assert (w == 0).any() or method == "elastic_net"


def test_a_singular_design_takes_ridge(lagged):
    _, n, x, y = lagged
    whole = np.c_[np.ones(n), y, x[:, 0], x[:, 0]]
    assert regress.fit(whole.T @ whole, n, 2)["method"] == "ridge"


def test_components(lagged):
    g, n, x, _ = lagged
    axes, ratio = regress.components(g, n, 0.8)
    _, s, v = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = s**2 / (s**2).sum()
    k = int(np.argmax(np.cumsum(want) >= 0.8)) + 1
    assert len(ratio) == k
    np.testing.assert_allclose(ratio, want[:k], atol=1e-9)
    np.testing.assert_allclose(np.abs(axes @ v[:k].T), np.eye(k), atol=1e-6)


def test_t_probability():
    three = 1 - 2 / math.pi * (math.atan(0.5 / 3**0.5) + 0.5 / 3**0.5 / (1 + 0.25 / 3))  # the closed form for 3
    for t, free, want in ((2.0, 10, 0.07338803), (0.5, 3, three), (1.959964, 10**6, 0.05000006), (0.0, 5, 1.0), (30.0, 40, 0.0)):
        assert abs(regress.t_probability(t, free) - want) < 1e-6


def test_stepwise_finds_the_lags(lagged):
    g, n, x, y = lagged
    chosen = regress.stepwise(g, n)
    assert set(chosen[:2]) == {1, 4}
    one = [abs(np.corrcoef(x[:, j], y)[0, 1]) for j in range(5)]
    assert chosen[0] == int(np.argmax(one)) + 1


def _longest(s, i):
    """The longest run from ``i`` that also occurs earlier without reaching past it, by looking."""
    best = 0
    for j in range(i):
        k = 0
        while i + k < len(s) and j + k < i and s[j + k] == s[i + k]:
            k += 1
        best = max(best, k)
    return best


def test_match_lengths_by_looking():
    rng = np.random.default_rng(0)
    for bins in (1, 2, 5, 30):
        view = rng.integers(0, bins, (7, 40))
        assert entropy.match_lengths(view).tolist() == [[_longest(r, i) for i in range(40)] for r in view]


def test_grids_by_row(spark):
    """Every column of both grids at some rows, window by window."""
    rng = np.random.default_rng(1)
    values = np.cumsum(rng.normal(size=460)).round(3)
    rows = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(values)], "symbol string, idx long, value double")
    for made, kernel, cut, name, least in ((entropy.lz(rows), entropy.lempel_ziv, entropy.cut_equal, "lz", 2), (entropy.kont(rows), entropy.kontoyiannis, entropy.cut_quantile, "kont", 4)):
        assert len(made.columns) - 2 == {"lz": 36, "kont": 20}[name]
        for r in made.where("idx in (48, 49, 200, 459)").collect():
            for w in entropy.WINDOWS:
                for b in entropy.BINS:
                    if w >= least * b:
                        got = r[f"{name}_w{w}_b{b}"]
                        assert got is None if r.idx < w - 1 else abs(got - kernel(cut(values[r.idx - w + 1 : r.idx + 1], b))) < 1e-12


def test_sides_in_chunks_and_single_precision(spark):
    prices = [10.0, 11.0, 11.0, 9.0, 9.0, 12.0, 12.0, 8.0, 8.0 + 1e-9]
    rows = spark.createDataFrame([("a", i, p, 1.1) for i, p in enumerate(prices)], "symbol string, seq long, price double, quoteQty double")

    def plain(part):
        out, last = [], 1
        for i, p in enumerate(part):
            if i and part[i - 1] != p:
                last = 1 if part[i - 1] > p else -1
            out.append(last)
        return out

    got = lambda **how: [r.side for r in with_side(rows, **how).orderBy("seq").collect()]
    assert got() == plain(prices) and got(reset_rows=4) == plain(prices[:4]) + plain(prices[4:8]) + plain(prices[8:])
    assert got(single=True) == plain([np.float32(p) for p in prices])
    assert with_net(with_side(rows), single=True).first().net == float(np.float32(1.1))


def test_rows_are_numbered_in_order(spark):
    rows = spark.createDataFrame([(int(k), f"k{k}") for k in np.random.default_rng(0).permutation(500)], "a long, b string").repartition(5)
    got = shared.numbered(rows, "a").collect()
    assert len(got) == 500 and all(r.idx == r.a for r in got)
    assert shared.numbered(rows.limit(0), "a").count() == 0


@pytest.fixture(scope="module")
def learnable(spark):
    from datetime import datetime, timedelta

    rng, rows = np.random.default_rng(2), []
    for i in range(240):
        y = int(rng.random() < 0.5)
        rows.append((i, datetime(2024, 1, 1) + timedelta(hours=i), datetime(2024, 1, 1) + timedelta(hours=i + 3), float(y), 1.0 + i % 3, float(y + rng.normal(0, 0.3)), float(rng.normal())))
    frame = spark.createDataFrame(rows, "idx long, t0 timestamp_ntz, t1 timestamp_ntz, y double, weight double, good double, noise double")
    return forest.assembled(frame, ["good", "noise"]).cache()


def test_models(learnable):
    parts = validation.splits(learnable.select("idx", "t0", "t1"), 2, 1, 0.0)
    found = forest.trials(learnable, parts, "y", {"numTrees": (3,), "maxDepth": (1, 2)}, "weight")
    assert [loss for loss, _ in found] == sorted(loss for loss, _ in found) and found[0][0] < math.log(2)
    s = forest.selected(learnable, parts, "y", ["good", "noise"], top=1, weight="weight", numTrees=3, maxDepth=2)
    assert s["features"] == ["good"] and s["auc_selected"] > 0.9 and s["use_selected"] == (s["auc_selected"] > s["auc_all"])
    folds = forest.stratified(learnable, "y", 3).collect()
    y = {r.idx: r.y for r in learnable.collect()}
    for c in range(3):
        test = [r.idx for r in folds if r.comb_idx == c and r.part == "test"]
        assert abs(sum(y[i] for i in test) - sum(y.values()) / 3) < 1 and len([r for r in folds if r.comb_idx == c]) == 240
    assert forest.stratified_search(learnable, "y", 2, {"numTrees": (3,), "maxDepth": (2,)})[0][0] > 0.8


def test_volumes_are_estimated_where_they_are_not_known(spark):
    """Without buy volume: all of a bar's volume where the close did not fall, 0.3 of it otherwise; and the other way for sells."""
    from barforge.operators import microstructure as M

    close, volume = [10.0, 11.0, 10.5, 10.5, 12.0, 9.0], [4.0, 2.0, 8.0, 1.0, 3.0, 5.0]
    rows = spark.createDataFrame([("a", i, c, v) for i, (c, v) in enumerate(zip(close, volume, strict=True))], "symbol string, idx long, close double, volume double")
    change = np.diff(close, prepend=close[0])
    buy, sell = np.where(change >= 0, volume, 0.3 * np.array(volume)), np.where(change < 0, volume, 0.3 * np.array(volume))
    got = [r.vpin_fixed_3 for r in M.features(rows, (3,), (3,)).orderBy("idx").collect()]
    want = [None, None] + [abs(buy - sell)[i - 2 : i + 1].sum() / sum(volume[i - 2 : i + 1]) for i in range(2, 6)]
    assert got[:2] == want[:2] and np.allclose(got[2:], want[2:]) and "buy" not in M.features(rows, (3,), (3,)).columns


def test_area_counts_pairs(spark):
    rng = np.random.default_rng(3)
    pred, y = rng.integers(0, 6, 80) / 5, rng.integers(0, 2, 80)
    pairs = [(a > b) + 0.5 * (a == b) for a, s in zip(pred, y, strict=True) if s for b, t in zip(pred, y, strict=True) if not t]
    rows = spark.createDataFrame([(float(p), int(v)) for p, v in zip(pred, y, strict=True)], "pred double, y int")
    assert abs(forest.area(rows) - np.mean(pairs)) < 1e-9


def test_least_difference_is_searched(spark):
    walk = np.cumsum(np.random.default_rng(4).normal(size=900)) + 100
    rows = spark.createDataFrame([("a", i, float(v)) for i, v in enumerate(walk)], "symbol string, idx long, value double")

    def passes(d):
        w = series.fracdiff_weights(d, 900, 1e-2)
        return series.adf(np.convolve(walk, w, "valid"))["pvalue"] < 0.05

    coarse = next((k / 10 for k in range(1, 11) if passes(k / 10)), 1.0)
    want = next((d for d in (round(coarse - 0.1 + k * 0.02, 2) for k in range(1, 5)) if d > 0 and passes(d)), coarse)
    assert series.search_d(rows, threshold=1e-2) == want
