"""Parameter search and initial state of additive Holt-Winters, for many series at once.

``forecast`` scores a fixed grid of 729 triples per series.  Here a block of series
moves through the weeks together and every series finds its own triple:

* In error-correction form a week adds the error times (alpha, alpha beta,
  gamma (1 - alpha)) to level, trend and season, so the errors' derivatives follow the
  same short recursion: one pass gives errors, gradient and Gauss-Newton matrix.  A
  bounded Levenberg-Marquardt search uses them, from the best points of a coarse grid;
  a step counts only where it lowers the errors, so no result is worse than those.
* For given parameters the errors are linear in the state before the first week
  (level, trend and one value per season slot, summing to zero), so that state is the
  solution of normal equations whose rows the same recursion gives.  The search then
  runs over the three parameters only, with the state solved at each point.

A block holds series of one length, week by week, and is bounded in numbers, so memory
does not depend on how many series there are or how they are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .forecast import FIT_SCHEMA, GRID_STEPS, HOLDOUT_WEEKS, spread

LOW, HIGH = 1e-4, 1 - 1e-4          # bounds of each parameter
COARSE = (0.1, 0.35, 0.65, 0.9)     # values of each parameter in the coarse grid
STARTS = 3                          # points of the coarse grid that a search starts from
STEPS = 25                          # steps of a search, at most
GAIN = 1e-6                         # a search ends once a step gains less than this share
BLOCK_NUMBERS = 4_000_000           # numbers in the largest array of a block (32 MB)


class Block:
    """Series of one length and season, week by week: y[week, series]."""

    def __init__(self, y: np.ndarray, m: int):
        self.y, self.m = np.ascontiguousarray(y, dtype=float), m
        self.weeks, self.size = self.y.shape

    def take(self, which: np.ndarray) -> Block:
        return self if len(which) == self.size else Block(self.y[:, which], self.m)

    def first_state(self) -> np.ndarray:
        """The heuristic state: mean of season 1, per-week change to season 2, deviations of season 1."""
        first, second = self.y[:self.m].mean(axis=0), self.y[self.m:2 * self.m].mean(axis=0)
        return np.concatenate([first[None], ((second - first) / self.m)[None], self.y[:self.m] - first])


def _weights(params: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    a, b, g = params.T
    return a, a * b, g * (1 - a)


def run(block: Block, params: np.ndarray, state: np.ndarray, start: int, slopes: bool = False):
    """One pass from week ``start``: errors[week, series], their slopes [week, parameter, series] (or None), the last state.

    ``params`` is [series, 3]; ``state`` is (level, trend, seasons) by series.  Season
    slot j serves the weeks t with t mod m = j.
    """
    m, y = block.m, block.y
    wl, wt, ws = _weights(params)
    level, trend, season = state[0].copy(), state[1].copy(), state[2:].copy()
    errors = np.zeros_like(y)
    if slopes:
        by_weight = np.zeros((block.weeks, 3, block.size))
        dl, dt, ds = np.zeros((3, block.size)), np.zeros((3, block.size)), np.zeros((m, 3, block.size))
    for t in range(start, block.weeks):
        j = t % m
        level += trend
        e = y[t] - level - season[j]
        errors[t] = e
        if slopes:                          # by the three weights first
            dl += dt
            de = -(dl + ds[j])
            by_weight[t] = de
            dl += wl * de
            dt += wt * de
            ds[j] += ws * de
            dl[0] += e
            dt[1] += e
            ds[j, 2] += e
        level += wl * e
        trend += wt * e
        season[j] += ws * e
    jac = None
    if slopes:                              # then by alpha, beta, gamma
        a, b, g = params.T
        jac = np.stack([by_weight[:, 0] + b * by_weight[:, 1] - g * by_weight[:, 2], a * by_weight[:, 1], (1 - a) * by_weight[:, 2]], axis=1)
    return errors, jac, np.concatenate([level[None], trend[None], season])


def responses(block: Block, params: np.ndarray) -> np.ndarray:
    """How the errors answer, with opposite sign, to the state before the first week: [week, unknown, series].

    Unknowns are the level, the trend and the first m - 1 season slots; the last slot is minus their sum.
    """
    m = block.m
    wl, wt, ws = _weights(params)
    level, trend = np.zeros((m + 1, block.size)), np.zeros((m + 1, block.size))
    level[0], trend[1] = 1, 1
    season = np.zeros((m, m + 1, block.size))
    season[np.arange(m - 1), np.arange(2, m + 1)] = 1
    season[m - 1, 2:] = -1
    out = np.empty((block.weeks, m + 1, block.size))
    for t in range(block.weeks):
        j = t % m
        level += trend
        out[t] = level + season[j]
        level -= wl * out[t]
        trend -= wt * out[t]
        season[j] -= ws * out[t]
    return out


def estimated_state(block: Block, params: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The state before the first week with the least squared errors; with the responses [series, week, unknown] and
    the normal matrices.

    The heuristic state is the point of departure, so the equations are solved for the
    difference from it; a trace of ridge settles directions that no week speaks of.
    """
    begin = block.first_state()
    errors, _, _ = run(block, params, begin, 0)
    a = np.ascontiguousarray(responses(block, params).transpose(2, 0, 1))
    normal = a.transpose(0, 2, 1) @ a
    diagonal = np.einsum("sii->si", normal)
    normal = normal + (1e-12 * diagonal.mean(axis=1))[:, None, None] * np.eye(block.m + 1)
    move = np.linalg.solve(normal, a.transpose(0, 2, 1) @ errors.T[:, :, None])[..., 0].T
    return begin + np.concatenate([move, -move[2:].sum(axis=0, keepdims=True)]), a, normal


class Search:
    """The objective of a block: squared errors by parameters, with a fixed or a solved first state."""

    def __init__(self, block: Block, estimated: bool):
        self.block, self.estimated = block, estimated
        self.start = 0 if estimated else block.m
        self.passes = 0

    def _state(self, block: Block, params: np.ndarray):
        return estimated_state(block, params) if self.estimated else (block.first_state(), None, None)

    def value(self, which: np.ndarray, params: np.ndarray) -> np.ndarray:
        block = self.block.take(which)
        errors, _, _ = run(block, params, self._state(block, params)[0], self.start)
        self.passes += len(which)
        return (errors * errors).sum(axis=0)

    def slopes(self, which: np.ndarray, params: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Half the gradient of the squared errors, and the Gauss-Newton matrix (seen past the solved state)."""
        block = self.block.take(which)
        state, a, normal = self._state(block, params)
        errors, jac, _ = run(block, params, state, self.start, slopes=True)
        self.passes += 4 * len(which)
        jac = np.ascontiguousarray(jac.transpose(2, 0, 1))
        matrix = jac.transpose(0, 2, 1) @ jac
        if a is not None:
            across = a.transpose(0, 2, 1) @ jac
            matrix = matrix - across.transpose(0, 2, 1) @ np.linalg.solve(normal, across)
        return (jac.transpose(0, 2, 1) @ errors.T[:, :, None])[..., 0], matrix

    def descend(self, params: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounded Levenberg-Marquardt from one point per series; a step counts only where it lowers the errors."""
        params, best = params.copy(), best.copy()
        damp = np.full(len(params), 1e-2)
        rows = np.arange(len(params))
        for _ in range(STEPS):
            if not len(rows):
                break
            gradient, matrix = self.slopes(rows, params[rows])
            at = params[rows]
            held = ((at <= LOW) & (gradient > 0)) | ((at >= HIGH) & (gradient < 0))
            gradient = np.where(held, 0.0, gradient)
            scale = np.einsum("sii->si", matrix)
            scale = np.maximum(scale, 1e-12 * scale.max(axis=1, keepdims=True) + 1e-300)
            matrix = np.where(held[:, :, None] | held[:, None, :], 0.0, matrix)
            open_rows, gained = np.ones(len(rows), bool), np.zeros(len(rows))
            for _ in range(6):                                   # a step that fails is tried again, shorter
                k = np.flatnonzero(open_rows)
                if not len(k):
                    break
                damped = matrix[k] + np.eye(3)[None] * (np.where(held[k], 1.0, damp[rows[k], None]) * scale[k])[:, None, :]
                step = -np.linalg.solve(damped, gradient[k][..., None])[..., 0]
                trial = np.clip(at[k] + step, LOW, HIGH)
                value = self.value(rows[k], trial)
                good = value < best[rows[k]]
                won = rows[k[good]]
                gained[k[good]] = (best[won] - value[good]) / np.maximum(best[won], 1e-300)
                params[won], best[won] = trial[good], value[good]
                damp[won] = np.maximum(damp[won] / 5, 1e-9)
                damp[rows[k[~good]]] *= 8
                open_rows[k[good]] = False
            rows = rows[gained > GAIN]
        return params, best


def _basins(values: np.ndarray) -> np.ndarray:
    """Which points of each series' coarse grid, values[series, i, j, k], have no lower neighbour along an axis."""
    low = np.ones(values.shape, bool)
    for axis in (1, 2, 3):
        step = np.diff(values, axis=axis) >= 0           # not falling towards the next point
        edge = np.ones_like(step.take([0], axis=axis))
        low &= np.concatenate([step, edge], axis=axis) & np.concatenate([edge, np.diff(values, axis=axis) < 0], axis=axis)
    return low.reshape(len(values), -1)


def optimise(block: Block, estimated: bool = False, starts: int = STARTS) -> tuple[np.ndarray, np.ndarray, int]:
    """Parameters and squared errors of each series, and the passes over single series that it took.

    A search starts from each of the ``starts`` lowest points of the coarse grid that no
    neighbouring point undercuts.
    """
    search = Search(block, estimated)
    everyone, k = np.arange(block.size), len(COARSE)
    grid = np.array(np.meshgrid(COARSE, COARSE, COARSE, indexing="ij")).reshape(3, -1).T
    values = np.stack([search.value(everyone, np.tile(p, (block.size, 1))) for p in grid], axis=1)
    first = values.argmin(axis=1)
    params, best = grid[first], values[everyone, first]
    ranked = np.where(_basins(values.reshape(-1, k, k, k)), values, np.inf)
    ranked[everyone, first] = best
    order = np.argsort(ranked, axis=1, kind="stable")
    for s in range(starts):
        at = order[:, s]
        which = np.flatnonzero(np.isfinite(ranked[everyone, at]))
        if not len(which):
            break
        part = Search(block.take(which), estimated)
        p, v = part.descend(grid[at[which]], values[which, at[which]])
        search.passes += part.passes
        better = v < best[which]
        params[which[better]], best[which[better]] = p[better], v[better]
    return params, best, search.passes


def below_grid(block: Block, params: np.ndarray, best: np.ndarray, steps=GRID_STEPS) -> tuple[np.ndarray, np.ndarray]:
    """The same for errors after the first season, held against every triple of the full grid.

    Squared errors only grow from week to week, so a series leaves a triple as soon as its
    sum passes the best one known; where a triple is better the search goes on from it.
    """
    params, best = params.copy(), best.copy()
    marks = np.unique(np.linspace(block.m, block.weeks, 5).astype(int))[1:]
    for triple in np.array(np.meshgrid(steps, steps, steps, indexing="ij")).reshape(3, -1).T:
        which, part, total = np.arange(block.size), block, np.zeros(block.size)
        state, start = block.first_state(), block.m
        for mark in marks:
            errors, _, state = run(Block(part.y[:mark], block.m), np.tile(triple, (len(which), 1)), state, start)
            total, start = total + (errors[start:] ** 2).sum(axis=0), mark
            on = total < best[which]
            if not on.any():
                which = which[:0]
                break
            if not on.all():
                which, total, state, part = which[on], total[on], state[:, on], Block(part.y[:, on], block.m)
        if len(which):
            params[which], best[which] = triple, total
            p, v = Search(block.take(which), False).descend(params[which], total)
            params[which], best[which] = p, v
    return params, best


def _blocks(lengths: np.ndarray, m: int, estimated: bool) -> Iterator[np.ndarray]:
    """Numbers of series of one length, as many as keep the largest array in bounds."""
    order = np.argsort(lengths, kind="stable")
    for same in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
        most = max(1, BLOCK_NUMBERS // (int(lengths[same[0]]) * ((m + 1) if estimated else 3)))
        for at in range(0, len(same), most):
            yield same[at:at + most]


def fit_block(ys: list[np.ndarray], m: int, estimated: bool, params=None, checked: bool = False) -> list[dict]:
    """Fits of series that hold two seasons each, in their order; with ``params`` only the state is found.

    ``checked`` holds each search against the full grid (errors after the first season only)."""
    out: list[dict] = [{} for _ in ys]
    for which in _blocks(np.array([len(y) for y in ys]), m, estimated) if ys else ():
        block = Block(np.stack([ys[i] for i in which], axis=1), m)
        if params is None:
            chosen, best, _ = optimise(block, estimated)
            chosen = below_grid(block, chosen, best)[0] if checked and not estimated else chosen
        else:
            chosen = np.tile(np.array(params, float), (len(which), 1))
        begin = estimated_state(block, chosen)[0] if estimated else block.first_state()
        errors, _, state = run(block, chosen, begin, 0 if estimated else m)
        sse, mae = (errors * errors).sum(axis=0), np.abs(errors[m:]).mean(axis=0)
        for k, i in enumerate(which):
            out[i] = dict(level=state[0, k], trend=state[1, k], season=state[2:, k].tolist(), sse=sse[k], mae_in_sample=mae[k],
                          alpha=chosen[k, 0], beta=chosen[k, 1], gamma=chosen[k, 2], level0=begin[0, k], trend0=begin[1, k])
    return out


def fit(series: DataFrame, m: int, estimated: bool = True, train_only: bool = False, params=None, checked: bool = False) -> DataFrame:
    """One row per series, as ``forecast.fit`` gives, with the parameters searched and (``estimated``) the first state
    solved; ``level0`` and ``trend0`` are that state.  ``score`` and ``future_of`` read it like any fit.

    With a solved state the squared errors run over all weeks, without over those after
    the first season; the in-sample error always over the latter.  ``params`` fixes the
    triple.  ``checked`` also holds a search without solved state against every triple of
    the full grid, at about the cost of that grid; unchecked, about one series in a
    thousand ends in a basin that is not the lowest.  A series of fewer than two seasons is listed as skipped; missing values
    count as 0; an empty table gives no rows.
    """
    points = series.groupBy("series_key").agg(F.sort_array(F.collect_list(F.struct("week", "y"))).alias("pts"))
    rows = spread(points.select("series_key", F.element_at("pts", -1)["week"].alias("last"), F.col("pts.week").alias("weeks"),
                                F.transform("pts", lambda p: F.coalesce(p["y"], F.lit(0.0))).alias("y")))
    schema = f"{FIT_SCHEMA}, level0 double, trend0 double"
    names = [f.split()[0] for f in schema.split(", ")]

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, weeks, values = (batch.column(c).to_pylist() for c in ("series_key", "weeks", "y"))
            cut = HOLDOUT_WEEKS if train_only else 0
            ys = [np.array(v[:max(len(v) - cut, 0)], float) for v in values]
            long = [i for i, y in enumerate(ys) if len(y) >= 2 * m]
            found = dict(zip(long, fit_block([ys[i] for i in long], m, estimated, params, checked)))
            out = [dict(series_key=keys[i], n=len(y), last_week=weeks[i][len(y) - 1] if len(y) else None,
                        status="fitted" if i in found else f"skipped: fewer than {2 * m} weeks", **found.get(i, {})) for i, y in enumerate(ys)]
            kinds = {"series_key": pa.string(), "status": pa.string(), "n": pa.int32(), "last_week": pa.date32(), "season": pa.list_(pa.float64())}
            yield pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in out], kinds.get(c, pa.float64())) for c in names], names=names)

    return rows.mapInArrow(block, schema)
