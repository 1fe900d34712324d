"""Numpy helpers that run inside Spark tasks on one bounded batch or group."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Executors need not have this package installed: send these functions by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Step and ceiling of the SAR acceleration.
SAR_STEP = 0.02
SAR_CEILING = 0.2


class SarWalk:
    """State of a parabolic SAR between two bars."""

    def __init__(self, high: float, low: float):
        self.extreme, self.stop, self.rising, self.speed = high, low, True, SAR_STEP

    def values(self, highs, lows):
        extreme, stop, rising, speed = self.extreme, self.stop, self.rising, self.speed
        out = []
        for high, low in zip(highs, lows):
            stop += speed * (extreme - stop)
            crossed = low if rising else high
            if (crossed < stop) if rising else (crossed > stop):
                stop, extreme, rising, speed = extreme, crossed, not rising, SAR_STEP
            if speed < SAR_CEILING:
                speed += SAR_STEP
            out.append(stop)
        self.extreme, self.stop, self.rising, self.speed = extreme, stop, rising, speed
        return out


def walk_sar(batches):
    """Batches of bars sorted by series and time -> the same rows with ``sar`` and ``bar_index``."""
    series, state, position = None, None, 0
    for batch in batches:
        if not len(batch):
            continue
        keys = list(zip(batch["symbol"], batch["interval"]))
        cuts = [0] + [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]] + [len(keys)]
        high, low = batch["high"].tolist(), batch["low"].tolist()
        sar, index = [], []
        for begin, end in zip(cuts, cuts[1:]):
            first = begin
            if keys[begin] != series:
                series, position = keys[begin], 0
                state = SarWalk(high[begin], low[begin])
                sar.append(None)
                index.append(0)
                first, position = begin + 1, 1
            sar.extend(state.values(high[first:end], low[first:end]))
            index.extend(range(position, position + end - first))
            position += end - first
        yield batch.assign(sar=np.array(sar, dtype="float64"), bar_index=np.array(index, dtype="int64"))


def _points(frame):
    ordered = frame.sort_values("member", kind="stable")
    return ordered, np.array(ordered["point"].tolist(), dtype="float64").reshape(len(ordered), -1)


def _distances(a, b):
    """Euclidean distances of all rows of ``a`` to all rows of ``b``, to nine places."""
    total = np.zeros((len(a), len(b)))
    for i in range(a.shape[1]):
        total += np.square(a[:, i, None] - b[None, :, i])
    return np.round(np.sqrt(total), 9)


def _closest(distances, k):
    """Per row the columns of the ``k`` least distances, nearest first; the earlier column wins a tie."""
    k = min(k, distances.shape[1])
    chosen = np.sort(np.argpartition(distances, k - 1, axis=1)[:, :k], axis=1)
    limit = np.take_along_axis(distances, chosen, axis=1).max(axis=1)
    # Where more rows are as near as the last one chosen, which of them were is not settled yet.
    tied = np.flatnonzero((distances <= limit[:, None]).sum(axis=1) > k)
    chosen[tied] = np.sort(np.argsort(distances[tied], axis=1, kind="stable")[:, :k], axis=1)
    order = np.argsort(np.take_along_axis(distances, chosen, axis=1), axis=1, kind="stable")
    return np.take_along_axis(chosen, order, axis=1)


def _search(asking, points, hosting_members, hosts, k, skip_self):
    names, lengths = [], []
    for begin in range(0, len(points), 512):
        distances = _distances(points[begin : begin + 512], hosts)
        if skip_self:
            rows = np.arange(len(distances))
            distances[rows, rows + begin] = np.inf
        columns = _closest(distances, k)
        names.append(hosting_members[columns])
        lengths.append(np.take_along_axis(distances, columns, axis=1))
    names, lengths = np.concatenate(names), np.concatenate(lengths)
    if skip_self and len(hosts) <= k:  # then the row itself, infinitely far, is the last of its own hits
        names, lengths = names[:, :-1], lengths[:, :-1]
    return asking.assign(neighbours=list(names), distances=list(lengths))


def nearest_inside(cell, k):
    """Neighbours of every row within its cell, and the distance a nearer row must beat."""
    rows, points = _points(cell)
    out = _search(rows, points, rows["member"].to_numpy(), points, k, skip_self=True)
    return out.assign(bound=[d[-1] if len(d) == k else np.inf for d in out["distances"]])


def nearest_across(asking, hosting, k):
    rows, points = _points(asking)
    hosts, host_points = _points(hosting)
    return _search(rows, points, hosts["member"].to_numpy(), host_points, k, skip_self=False)


def solve_least_squares(batch):
    """One row of moments per series -> intercept and weights."""
    intercepts, weights = [], []
    for means, covariances in zip(batch["means"], batch["covariances"]):
        means = np.asarray(means, dtype="float64")
        width = len(means) - 1
        table = np.asarray(covariances, dtype="float64").reshape(width, width + 1)
        solution = np.linalg.lstsq(table[:, :width], table[:, width], rcond=1e-11)[0]
        intercepts.append(float(means[-1] - solution @ means[:-1]))
        weights.append(solution.tolist())
    return batch.assign(intercept=intercepts, weights=weights)


def partial_products(batches, size):
    """Arrow batches of (symbol, interval, v) -> per series of a batch: rows and the sum of v v'."""
    for batch in batches:
        if not batch.num_rows:
            continue
        names = [batch.column(k).dictionary_encode() for k in ("symbol", "interval")]
        codes = [n.indices.to_numpy(zero_copy_only=False) for n in names]
        series, first, place = np.unique(codes[0].astype(np.int64) * (len(names[1].dictionary) + 1) + codes[1], return_index=True, return_inverse=True)
        values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
        rows, sums = [], []
        for i in range(len(series)):
            own = values[place == i]
            rows.append(len(own))
            sums.append((own.T @ own).ravel().tolist())
        keys = [pa.array([batch.column(k)[int(f)].as_py() for f in first], pa.string()) for k in ("symbol", "interval")]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(rows, pa.int64()), pa.array(sums, pa.list_(pa.float64()))], ["symbol", "interval", "rows", "sums"])


def _lag_vectors(prices, first, size):
    """v of the prices from position ``first`` on; rows that lack a price are left out."""
    prices = np.asarray([np.nan if p is None else p for p in prices], dtype="float64")
    changes = np.diff(prices)
    rows = [[1.0, prices[t - 1], *changes[t - 1 :: -1][: size - 2]] for t in range(max(first, size - 2), len(prices))]
    table = np.array(rows, dtype="float64").reshape(-1, size)
    return table[np.isfinite(table).all(axis=1)]


def joined_products(batch, size):
    """Stored sums, the sums of the stretch that follows, and the rows whose lags reach over the seam."""
    rows, sums, tails = [], [], []
    for old_tail, head, tail, old_rows, new_rows, old, new in zip(
        batch["_old_tail"], batch["head"], batch["tail"], batch["_old_rows"], batch["rows"], batch["_old_sums"], batch["sums"]
    ):
        # The first prices of the new stretch have no row of their own there.
        seam = _lag_vectors([*old_tail, *head], len(old_tail), size)
        rows.append(int(old_rows + new_rows + len(seam)))
        sums.append((np.asarray(old) + np.asarray(new) + (seam.T @ seam).ravel()).tolist())
        tails.append([*old_tail, *tail][-(size - 2) :])
    return batch.assign(rows=rows, sums=sums, tail=tails)


def _least_squares(products, target, columns):
    """Coefficients, squared residuals and the inverse of the normal matrix, from a matrix of products."""
    normal = products[np.ix_(columns, columns)]
    inverse = np.linalg.pinv(normal, rcond=1e-12, hermitian=True)
    solution = inverse @ products[columns, target]
    return solution, float(products[target, target] - solution @ products[columns, target]), inverse


def dickey_fuller(sums, rows, size):
    """Augmented Dickey-Fuller statistic from the products of v; the number of lags has the least Akaike criterion."""
    products = np.asarray(sums, dtype="float64").reshape(size, size)
    best = None
    for lags in range(size - 2):
        columns = [1, *range(3, 3 + lags), 0]
        if rows <= len(columns):
            break
        solution, squares, inverse = _least_squares(products, 2, columns)
        if squares <= 0.0 or inverse[0, 0] <= 0.0:
            continue
        criterion = rows * np.log(squares / rows) + 2 * len(columns)
        if best is None or criterion < best[0]:
            best = (criterion, float(solution[0] / np.sqrt(inverse[0, 0] * squares / (rows - len(columns)))))
    return None if best is None else best[1]


def dickey_fuller_batch(batch, size):
    found = [dickey_fuller(s, n, size) for s, n in zip(batch["sums"], batch["rows"])]
    return batch.assign(tau=np.array([np.nan if v is None else v for v in found], dtype="float64"))


def arima_criterion(sums, rows, p, d, q, size, long_order):
    """Akaike criterion of an ARIMA fit in two regressions; None where it cannot be fitted.

    A long autoregression estimates the shocks, then the series is regressed on its own lags and the lagged
    shocks. Shocks are differences of lags, so both regressions are on linear forms of v.
    """
    forms = np.zeros((long_order + q + 2, size))  # the constant, then the series and its lags
    forms[0, 0] = 1.0
    for lag in range(long_order + q + 1):
        if d:
            forms[1 + lag, 2 + lag] = 1.0
        else:
            forms[1 + lag, 1] = 1.0
            if lag:
                forms[1 + lag, 3 : 2 + lag] = -1.0
            else:
                forms[1, 2] = 1.0
    products = np.asarray(sums, dtype="float64").reshape(size, size)
    constant = [] if d else [0]
    if rows < max(2 * (p + q) + 5, 2 * long_order):
        return None
    moments = forms @ products @ forms.T
    weights = _least_squares(moments, 1, [*constant, *range(2, 2 + long_order)])[0]
    shocks = np.zeros((q, len(forms)))
    for j in range(1, q + 1):
        shocks[j - 1, 1 + j] = 1.0
        shocks[j - 1, constant] -= weights[: len(constant)]
        shocks[j - 1, 2 + j : 2 + j + long_order] -= weights[len(constant) :]
    chosen = np.vstack([np.eye(len(forms))[[1, *constant, *range(2, 2 + p)]], shocks])
    moments = chosen @ moments @ chosen.T
    columns = list(range(1, len(chosen)))
    squares = _least_squares(moments, 0, columns)[1] if columns else float(moments[0, 0])
    if not np.isfinite(squares) or squares <= 0.0:
        return None
    return rows * (np.log(2 * np.pi * squares / rows) + 1) + 2 * (len(columns) + 1)


def arima_criteria(batch, size, long_order):
    found = [
        arima_criterion(s, n, p, d, q, size, long_order)
        for s, n, p, d, q in zip(batch["sums"], batch["rows"], batch["p"], batch["d"], batch["q"])
    ]
    return batch.assign(aic=np.array([np.nan if v is None else v for v in found], dtype="float64"))
