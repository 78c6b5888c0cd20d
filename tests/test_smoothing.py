"""Batched Holt-Winters: passes, slopes, the solved first state, the search, and the Spark job around them."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.operators import forecast as I
from tillroll.operators import smoothing as S

KINDS = 6


def series(rng, n, m, kind):
    t = np.arange(n)
    wave = np.sin(2 * np.pi * t / m)
    return [1000 + 50 * wave + rng.normal(0, 20, n), np.cumsum(rng.normal(0, 30, n)) + 500, rng.lognormal(6, 1, n),
            (rng.random(n) < 0.3) * rng.lognormal(5, 1, n), 1000 + 3 * t + 200 * wave * (1 + t / n) + rng.normal(0, 60, n),
            rng.normal(0, 1e4, n) + 1e5][kind]


def population(seed, n, m, each):
    rng = np.random.default_rng(seed)
    return [series(rng, n, m, kind) for kind in range(KINDS) for _ in range(each)]


def plain(y, m, a, b, g, level, trend, season, start):
    """Textbook recursion: the errors from week ``start`` and the last state."""
    season, errors = list(season), []
    for t in range(start, len(y)):
        e = y[t] - (level + trend + season[t % m])
        errors.append(e)
        up = a * (y[t] - season[t % m]) + (1 - a) * (level + trend)
        trend = b * (up - level) + (1 - b) * trend
        season[t % m] = g * (y[t] - up) + (1 - g) * season[t % m]
        level = up
    return errors, [level, trend, *season]


def block_of(ys, m):
    return S.Block(np.stack(ys, axis=1), m)


def test_pass_equals_the_textbook_recursion():
    m, ys = 4, population(1, 23, 4, 2)
    block = block_of(ys, m)
    params = np.random.default_rng(2).uniform(0, 1, (len(ys), 3))
    for start in (0, m):
        errors, _, last = S.run(block, params, block.first_state(), start)
        for k, y in enumerate(ys):
            e, state = plain(y, m, *params[k], block.first_state()[0, k], block.first_state()[1, k], block.first_state()[2:, k], start)
            assert np.allclose(errors[start:, k], e) and np.allclose(last[:, k], state) and not errors[:start, k].any()


def test_same_figures_as_the_grid_at_its_triples():
    m, ys = 13, population(3, 60, 13, 3)
    for y in ys:
        best = I._fit_best(y, m)
        got = S.fit_block([y], m, estimated=False, params=(best["alpha"], best["beta"], best["gamma"]))[0]
        for c in ("sse", "level", "trend", "mae_in_sample"):
            assert np.isclose(got[c], best[c])
        assert np.allclose(got["season"], best["season"])


@pytest.mark.parametrize("estimated", [False, True])
def test_slopes_equal_finite_differences(estimated):
    m = 4
    block = block_of(population(4, 30, m, 1), m)
    search, rows = S.Search(block, estimated), np.arange(block.size)
    params = np.random.default_rng(5).uniform(0.1, 0.9, (block.size, 3))
    gradient, matrix = search.slopes(rows, params)
    for c in range(3):
        step = np.zeros(3)
        step[c] = 1e-6
        finite = (search.value(rows, params + step) - search.value(rows, params - step)) / 2e-6
        assert np.allclose(2 * gradient[:, c], finite, rtol=1e-4, atol=1e-5 * search.value(rows, params))
    assert (np.linalg.eigvalsh(matrix) > -1e-6 * np.abs(matrix).max(axis=(1, 2))[:, None]).all()


def test_first_state_solves_the_least_squares_problem():
    for m, n in ((4, 8), (4, 30), (13, 60), (52, 106)):
        ys = population(6, n, m, 1)
        block = block_of(ys, m)
        params = np.random.default_rng(7).uniform(0.05, 0.6, (len(ys), 3))
        state, _, _ = S.estimated_state(block, params)
        errors, _, _ = S.run(block, params, state, 0)
        for k, y in enumerate(ys):
            unit = []
            for u in range(m + 1):                  # answers of the plain recursion to each unknown alone
                level, trend, season = float(u == 0), float(u == 1), np.zeros(m)
                if u > 1:
                    season[u - 2], season[m - 1] = 1, -1
                unit.append(plain(np.zeros(n), m, *params[k], level, trend, season, 0)[0])
            base = plain(y, m, *params[k], 0.0, 0.0, np.zeros(m), 0)[0]
            x, *_ = np.linalg.lstsq(-np.array(unit).T, np.array(base), rcond=None)
            least = np.square(np.array(base) + np.array(unit).T @ x).sum()
            assert np.square(errors[:, k]).sum() <= least * (1 + 1e-6) + 1e-12 * np.square(y).sum()
            assert abs(state[2:, k].sum()) < 1e-6 * max(1, np.abs(state[:, k]).max())


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 10 ** 6), st.sampled_from([(4, 8), (4, 25), (13, 26), (13, 93)]), st.integers(0, KINDS - 1))
def test_solved_state_is_never_worse_than_the_heuristic_one(seed, shape, kind):
    m, n = shape
    rng = np.random.default_rng(seed)
    block = block_of([series(rng, n, m, kind)], m)
    params = rng.uniform(S.LOW, S.HIGH, (1, 3))
    solved, _, _ = S.run(block, params, S.estimated_state(block, params)[0], 0)
    heuristic, _, _ = S.run(block, params, block.first_state(), 0)
    assert np.square(solved).sum() <= np.square(heuristic).sum() * (1 + 1e-9)


def test_search_stays_below_the_full_grid_at_a_fraction_of_its_passes():
    above = count = 0
    for n in (26, 40, 93):
        ys = population(8, n, 13, 100)
        grid = np.array([I._fit_best(y, 13)["sse"] for y in ys])
        params, best, passes = S.optimise(block_of(ys, 13))
        assert ((params >= S.LOW) & (params <= S.HIGH)).all()
        errors, _, _ = S.run(block_of(ys, 13), params, block_of(ys, 13).first_state(), 13)
        assert np.allclose(np.square(errors).sum(axis=0), best)
        assert passes / len(ys) < 729 / 5
        above, count = above + int((best > grid * (1 + 1e-9)).sum()), count + len(ys)
        assert best.mean() < grid.mean()
        checked, lower = S.below_grid(block_of(ys, 13), params, best)
        assert (lower <= best).all() and (lower <= grid * (1 + 1e-9)).all()
        errors, _, _ = S.run(block_of(ys, 13), checked, block_of(ys, 13).first_state(), 13)
        assert np.allclose(np.square(errors).sum(axis=0), lower)
    assert above <= count * 0.003


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10 ** 6), st.sampled_from([(4, 8), (4, 30), (13, 27)]))
def test_checked_search_against_a_dense_grid(seed, shape):
    m, n = shape
    rng = np.random.default_rng(seed)
    ys = [series(rng, n, m, k) for k in range(KINDS)]
    block = block_of(ys, m)
    got = S.below_grid(block, *S.optimise(block)[:2])[1]
    for y, best in zip(ys, got):
        dense = I._fit_best(y, m, steps=tuple(np.linspace(0.05, 0.95, 13)))["sse"]
        ordinary = I._fit_best(y, m)["sse"]
        assert best <= ordinary * (1 + 1e-9) and best <= dense * 1.05


def test_a_solved_search_is_below_the_solved_coarse_grid():
    ys = population(9, 60, 13, 3)
    block = block_of(ys, 13)
    params, best, _ = S.optimise(block, estimated=True)
    search = S.Search(block, True)
    for triple in ((0.1, 0.1, 0.1), (0.35, 0.1, 0.65), (0.9, 0.1, 0.9), (0.65, 0.35, 0.1)):
        assert (best <= search.value(np.arange(len(ys)), np.tile(triple, (len(ys), 1))) * (1 + 1e-9)).all()


def test_blocks_hold_one_length_and_stay_in_bounds():
    lengths = np.array([30, 26, 30, 26, 26, 107])
    blocks = list(S._blocks(lengths, 13, True))
    assert sorted(np.concatenate(blocks).tolist()) == list(range(6)) and all(len(set(lengths[b])) == 1 for b in blocks)
    many = list(S._blocks(np.full(50_000, 104), 52, True))
    assert len(many) > 50 and all(len(b) * 104 * 53 <= S.BLOCK_NUMBERS for b in many)


def _frame(spark, ys):
    rows = [(key, dt.date(2010, 1, 4) + dt.timedelta(weeks=i), None if v is None else float(v)) for key, y in ys.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "series_key string, week date, y double")


def test_fit_over_mixed_series(spark):
    rng = np.random.default_rng(10)
    ys = {f"s{i}": list(series(rng, n, 13, i % KINDS)) for i, n in enumerate((60, 60, 39, 26, 75, 60))}
    ys |= {"short": [1.0] * 25, "flat": [5.0] * 40, "zero": [0.0] * 40, "gaps": [None, 2.0, 3.0] * 20}
    got = {r.series_key: r for r in S.fit(_frame(spark, ys), 13).collect()}
    assert set(got) == set(ys) and got["short"].status == "skipped: fewer than 26 weeks" and got["short"].sse is None
    assert got["flat"].sse < 1e-12 and got["zero"].sse == 0.0 and got["gaps"].n == 60
    for key, y in ys.items():
        if key == "short":
            continue
        alone = S.fit_block([np.array([v or 0.0 for v in y])], 13, True)[0]
        assert np.isclose(got[key].sse, alone["sse"], rtol=1e-6, atol=1e-9) and got[key].last_week == dt.date(2010, 1, 4) + dt.timedelta(weeks=len(y) - 1)
    trained = {r.series_key: r for r in S.fit(_frame(spark, ys), 13, estimated=False, train_only=True).collect()}
    assert trained["s0"].n == 47 and trained["s3"].status.startswith("skipped") and trained["s3"].n == 13
    assert S.fit(_frame(spark, {}), 13).collect() == []


def test_fits_feed_scores_and_projections(spark):
    t = np.arange(80)
    y = 5000 + 20 * t + 800 * np.sin(2 * np.pi * t / 13)
    frame = _frame(spark, {"S": y, "short": y[:20]})
    scored = {r.series_key: r for r in I.score(S.fit(frame, 13, train_only=True), frame).collect()}
    assert scored["S"].mape < 0.01 and scored["short"].mae is None        # trend and season are found exactly
    ahead = sorted((r.h, r.week, r.yhat) for r in I.future_of(S.fit(frame, 13), m=13).collect() if r.series_key == "S")
    wanted = 5000 + 20 * np.arange(80, 93) + 800 * np.sin(2 * np.pi * np.arange(80, 93) / 13)
    assert [w for _, w, _ in ahead] == [d.date() for d in pd.date_range("2010-01-04", periods=93, freq="7D")[80:]]
    assert np.allclose([v for _, _, v in ahead], wanted, rtol=1e-3)
