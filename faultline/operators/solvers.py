"""Fits of networks and kernel machines on many rows.

Spark ML's own fits keep a copy of the assembled features (hundreds of bytes
a row for Fourier features) and read it once per step of each setting.  Here
the scaled rows are kept once, as packed blocks of doubles, and a step is one
pass over them for all settings: tasks return sums of loss and gradient, the
driver holds the optimisers.  Loss, start, steps and end are those of Spark's
classifiers: Breeze's L-BFGS with its strong Wolfe search (network), and its
OWL-QN without L1 on centred features of unit deviation (linear SVM)."""
from __future__ import annotations

import math
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel

CHUNK = 4096         # rows of a packed block


class StepFailed(Exception):
    """A search for a step found none."""


def _direction(grad, steps, changes):
    """Two-loop recursion over the last steps and gradient changes, newest first."""
    d, a, rho = grad.copy(), [], []
    for s, y in zip(steps, changes, strict=True):
        rho.append(s @ y)
        a.append((s @ d) / rho[-1])
        if math.isnan(a[-1]):
            raise StepFailed
        d -= a[-1] * y
    if steps:
        if rho[0] < 0:
            raise StepFailed
        d *= rho[0] / (changes[0] @ changes[0])
    for s, y, ai, r in reversed(list(zip(steps, changes, a, rho, strict=True))):
        d += (ai - (y @ d) / r) * s
    return -d


def _wolfe(phi, t, f0, d0):
    """Strong Wolfe search by bracketing and cubic interpolation; the last point tried is the step."""
    def interp(a, b):
        d1 = a[1] + b[1] - 3 * (a[2] - b[2]) / (a[0] - b[0])
        d2 = np.sqrt(d1 * d1 - a[1] * b[1])
        x = b[0] - (b[0] - a[0]) * (b[1] + d2 - d1) / (b[1] - a[1] + 2 * d2)
        lo, hi = a[0] + 0.1 * (b[0] - a[0]), a[0] + 0.9 * (b[0] - a[0])
        return lo if x < lo else hi if x > hi else x

    def zoom(low, high):
        for _ in range(10):
            x = interp(high, low) if low[0] > high[0] else interp(low, high)
            c = (x, *(yield from phi(x)))
            if c[2] > f0 + 1e-4 * x * d0 or c[2] >= low[2]:
                high = c
            else:
                if abs(c[1]) <= 0.9 * abs(d0):
                    return x
                if c[1] * (high[0] - low[0]) >= 0:
                    high = low
                low = c
        raise StepFailed

    if d0 > 0:
        raise StepFailed
    low = (0.0, d0, f0)
    for i in range(10):
        c = (t, *(yield from phi(t)))
        if math.isinf(c[2]) or math.isnan(c[2]):
            t /= 2
            continue
        if c[2] > f0 + 1e-4 * t * d0 or (c[2] >= low[2] and i > 0):
            return (yield from zoom(low, c))
        if abs(c[1]) <= 0.9 * abs(d0):
            return t
        if c[1] >= 0:
            return (yield from zoom(c, low))
        low = c
        t *= 1.5
    raise StepFailed


def _backtracking(phi, t, f0, d0, shrink):
    """Steps shrunk and grown until the Wolfe conditions hold, at most 19 tries.  As Breeze takes the value before the
    step for that of the first trial, the first trial is always shrunk: it need not be evaluated."""
    t *= shrink
    for _ in range(18):
        d, f = yield from phi(t)
        if f > f0 + t * d0 * 1e-4:
            by = shrink
        elif d < 0.9 * d0:
            by = 2.1
        elif d > -0.9 * d0:
            by = shrink
        else:
            return t
        t *= by
        if not 1e-10 <= t <= 1e10:
            raise StepFailed
    yield from phi(t)
    return t


def search(x, max_iter: int, orthant: bool = False, tol: float = 1e-6, memory: int = 10):
    """Minimises a function: yields points, is sent (value, gradient) of each, returns the best point.

    ``orthant``: steps are kept in the orthant of the point and found by
    backtracking, as OWL-QN does, else by the strong Wolfe search."""
    value, grad = yield x
    first, seen, steps, changes, it, failed = value, [math.inf], [], [], 0, False
    while it < max_iter and not (len(seen) > 1 and abs(value - max(seen)) <= tol * first) \
            and not np.linalg.norm(grad) <= max(tol * value, 1e-8):
        try:
            d = _direction(grad, steps, changes)
            if orthant:
                d = np.where(d * grad < 0, d, 0.0)
                side = np.where(x != 0, np.sign(x), np.sign(-grad))
            last = []

            def at(t, x=x, d=d):
                p = x + t * d
                return np.where(np.sign(p) == side, p, 0.0) if orthant else p

            def phi(t, d=d, last=last):
                p = at(t)
                v, g = yield p
                last[:] = [t, p, v, g]
                return g @ d, v

            if orthant:
                t = yield from _backtracking(phi, 0.5 / np.linalg.norm(grad) if it == 0 else 1.0, value, grad @ d,
                                             0.1 if it == 0 else 0.5)
            else:
                t = yield from _wolfe(phi, 1.0 / np.linalg.norm(d) if it == 0 else 1.0, value, grad @ d)
                if t * np.linalg.norm(grad) < 1e-10:
                    raise StepFailed
        except StepFailed:
            if failed:
                break
            failed, steps, changes = True, [], []       # once more without a history
            continue
        _, p, v, g = last
        steps, changes = [p - x, *steps][:memory], [g - grad, *changes][:memory]
        x, value, grad, it, failed = p, v, g, it + 1, False
        seen = [*seen, value][-20:]
    return x


def lockstep(searches, evaluate) -> list:
    """Runs several searches side by side: ``evaluate`` gets {search: point} and gives {search: (value, gradient)}."""
    wanted, done = {i: next(s) for i, s in enumerate(searches)}, {}
    while wanted:
        got, wanted = evaluate(wanted), {}
        for i, vg in got.items():
            try:
                wanted[i] = searches[i].send(vg)
            except StopIteration as end:
                done[i] = end.value
    return [done[i] for i in range(len(searches))]


@contextmanager
def packed(rows):
    """Blocks of ``CHUNK`` consecutive rows of a partition (the last one shorter) as bytes, kept for the block and dealt
    to all cores if the table has fewer partitions.  ``rows``: columns of finite doubles; others are refused, as in
    Spark's fits."""
    width = len(rows.columns)

    def blocks(batches):
        kept = np.empty((0, width))
        for b in batches:
            d = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
            if not np.isfinite(d).all():
                raise ValueError("rows to fit on must not hold NULL, NaN or infinite values")
            kept = np.concatenate([kept, d])
            full = len(kept) // CHUNK * CHUNK
            for k in range(0, full, CHUNK):
                yield pa.RecordBatch.from_arrays([pa.array([kept[k:k + CHUNK].tobytes()], pa.binary())], names=["block"])
            kept = kept[full:]
        if len(kept):
            yield pa.RecordBatch.from_arrays([pa.array([kept.tobytes()], pa.binary())], names=["block"])

    held, cores = rows.mapInArrow(blocks, "block binary").rdd.map(lambda r: bytes(r[0])), rows.sparkSession.sparkContext.defaultParallelism
    if held.getNumPartitions() < cores:
        held = held.mapPartitionsWithIndex(lambda p, it: ((p + i, b) for i, b in enumerate(it))).partitionBy(cores, lambda k: k).values()
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()


def _totals(blocks, add) -> dict:
    """{key: sum of the arrays that ``add(block, {key: array})`` gathers}, added in the order of the partitions."""
    def run(it):
        total = {}
        with np.errstate(all="ignore"):
            for b in it:
                add(np.frombuffer(b), total)
        return [total]

    out = {}
    for part in blocks.mapPartitions(run).collect():        # an array per partition and search
        for k, v in part.items():
            out[k] = out[k] + v if k in out else v
    return out


def fit_networks(blocks, features: int, layers: list, starts: list, max_iter: int, size: int = 256) -> list:
    """Weights of several networks (``layers`` of each) on the same packed rows: ``features`` scaled columns, the label.

    The loss is the mean over runs of ``size`` consecutive rows of a
    partition of each run's mean cross-entropy.  Weights are in the
    classifier's order: per layer the matrix by inputs, then the bias."""
    def evaluate(points):
        def unpack(w, shape):
            out, at = [], 0
            for a, b in zip(shape, shape[1:]):
                out.append((w[at:at + a * b].reshape(a, b), w[at + a * b:at + a * b + b]))
                at += a * b + b
            return out

        nets = {i: unpack(w, layers[i]) for i, w in points.items()}

        def add(block, total):
            d = block.reshape(-1, features + 1)
            x, y, at = np.ascontiguousarray(d[:, :features]), d[:, features].astype(np.int64), np.arange(len(d))
            share = np.full((len(d), 1), 1.0 / size)
            if len(d) % size:
                share[len(d) // size * size:] = 1.0 / (len(d) % size)
            for i, net in nets.items():
                if i not in total:
                    total[i] = np.zeros(2 + sum(m.size + b.size for m, b in net))
                ins = [x]
                for m, b in net[:-1]:
                    z = ins[-1] @ m
                    z += b
                    np.negative(z, out=z)
                    np.exp(z, out=z)
                    z += 1.0
                    ins.append(np.reciprocal(z, out=z))
                z = ins[-1] @ net[-1][0] + net[-1][1]
                z = np.exp(z - z.max(axis=1, keepdims=True))
                z /= z.sum(axis=1, keepdims=True)
                total[i][0] -= np.log(z[at, y]) @ share[:, 0]
                total[i][1] += share.sum()
                z[at, y] -= 1.0
                z *= share
                for h, (m, _), (gm, gb) in reversed(list(zip(ins, net, unpack(total[i][2:], layers[i])))):
                    gm += h.T @ z
                    gb += z.sum(axis=0)
                    if h is not x:
                        z = z @ m.T
                        z *= h
                        np.subtract(1.0, h, out=h)
                        z *= h

        return {i: (t[0] / t[1], t[2:] / t[1]) for i, t in _totals(blocks, add).items()}

    return lockstep([search(np.asarray(w, float), max_iter) for w in starts], evaluate)


def fourier_map(features: int, gamma: float, n_components: int, seed: int):
    """Frequencies and phases of random Fourier features of the RBF kernel."""
    rng = np.random.default_rng(seed)
    return rng.normal(0.0, math.sqrt(2.0 * gamma), size=(n_components, features)), rng.uniform(0.0, 2.0 * math.pi, size=n_components)


def _fourier():
    def features(x, freq, phase):       # made here, so that workers need no module of ours
        z = x @ freq.T
        z += phase
        np.cos(z, out=z)
        z *= math.sqrt(2.0 / len(phase))
        return z
    return features


def margins(rows, features: int, freq, phase, coefficients, intercept: float, label: str):
    """(label, margin) of every row of ``rows``: ``features`` scaled columns, then the label."""
    fourier = _fourier()

    def run(batches):
        for b in batches:
            x = np.column_stack([b.column(k).to_numpy(zero_copy_only=False) for k in range(features)])
            with np.errstate(all="ignore"):
                m = [fourier(x[k:k + CHUNK], freq, phase) @ coefficients + intercept for k in range(0, len(x), CHUNK)]
            yield pa.RecordBatch.from_arrays([b.column(features), pa.array(np.concatenate([*m, np.empty(0)]))], names=[label, "margin"])
    return rows.mapInArrow(run, f"`{label}` double, margin double")


def fit_hinges(blocks, features: int, maps: list, settings: list, max_iter: int) -> list:
    """(coefficients, intercept) of several linear SVMs on Fourier features of the same packed rows: ``features`` scaled
    columns, the label, the weight.  ``maps``: (frequencies, phases) of each feature map; ``settings``: (map, L2)."""
    fourier = _fourier()

    def moments(block, total):
        d = block.reshape(-1, features + 2)
        w = d[:, features + 1]
        for k, m in enumerate(maps):
            z = fourier(d[:, :features], *m)
            v = np.concatenate([[w.sum(), (w * w).sum()], w @ z, w @ (z * z)])
            total[k] = total[k] + v if k in total else v

    scale, middle, weight = {}, {}, 0.0
    for k, v in _totals(blocks, moments).items():
        n = len(maps[k][1])
        weight, squares, mean, power = v[0], v[1], v[2:2 + n] / v[0], v[2 + n:]
        std = np.sqrt(np.maximum(power - weight * mean * mean, 0.0) / (weight - squares / weight))
        scale[k] = np.divide(1.0, std, out=np.zeros(n), where=std > 0)
        middle[k] = mean * scale[k]

    def plain(i, p):        # a point on scaled, centred features as one on the features themselves
        k = settings[i][0]
        return np.append(p[:-1] * scale[k], p[-1] - p[:-1] @ middle[k])

    def evaluate(points):
        by = {}
        for i, p in points.items():
            by.setdefault(settings[i][0], []).append((i, plain(i, p)))

        def add(block, total):
            d = block.reshape(-1, features + 2)
            side, w = d[:, features] * 2.0 - 1.0, d[:, features + 1]
            for k, some in by.items():
                z = fourier(d[:, :features], *maps[k])
                for i, p in some:
                    miss = 1.0 - side * (z @ p[:-1] + p[-1])
                    pull = np.where(miss > 0, -side * w, 0.0)
                    v = np.concatenate([[w @ np.maximum(miss, 0.0)], pull @ z, [pull.sum()]])
                    total[i] = total[i] + v if i in total else v

        out = {}
        for i, v in _totals(blocks, add).items():
            k, l2 = settings[i]
            c, pull = points[i][:-1], v[-1] / weight
            loss = v[0] / weight + 0.5 * l2 * float(c @ (c * scale[k] ** 2))
            out[i] = loss, np.append(v[1:-1] / weight * scale[k] - middle[k] * pull + l2 * c * scale[k] ** 2, pull)
        return out

    found = lockstep([search(np.zeros(len(maps[k][1]) + 1), max_iter, orthant=True) for k, _ in settings], evaluate)
    return [(p[:-1], float(p[-1])) for p in (plain(i, p) for i, p in enumerate(found))]
