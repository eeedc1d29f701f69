"""Gaussian mixtures of every k in one pass per EM step (CLU-04/05).

All models of a k sweep advance together: a pass works out, in each task, the
responsibilities of every model's components and sums them, with the first and
second moments about the component's present mean, per (model, component).  The
sums merge by one ``groupBy`` to models x k x (2 + d + d (d + 1) / 2) numbers,
whatever the number of rows; the driver makes the next parameters from them.
Moments about the present mean keep their digits where a component is narrow and
far from the centre.

Starts are k-means centres (one start a model, all in one sweep): the first sums
use whole memberships.  A model is done when its mean log-likelihood grows by
less than ``tol``; every covariance has ``REG_COVAR`` added to its diagonal.  A
component without members keeps its mean and has weight 0.  Meant for few
dimensions (reduce first): a covariance has d^2 numbers.

The fitted step is a projection of column expressions: it scores streams too.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.base import ColumnRules, register
from kiln.operators.multikmeans import _chunks, _points, _sq_dist, fit_points

try:
    import sys as _sys

    from pyspark import cloudpickle as _cloudpickle
    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: ship kiln with --py-files instead
    pass

REG_COVAR = 1e-6   # fixed value: added to the diagonal of each covariance
TOL = 1e-3         # fixed value: least growth of the mean log-likelihood
MAX_ITER = 100     # fixed value: EM steps
LEAST = 1e-300     # weight of an empty component, as its logarithm must be a number


@dataclass
class Mixture:
    """Weights (k), means (k, d) and covariances (k, d, d) of one model; of the last
    pass: log-likelihood of all ``n`` rows and rows by likeliest component."""

    weights: np.ndarray
    means: np.ndarray
    covs: np.ndarray
    log_likelihood: float = float("nan")
    n: int = 0
    sizes: np.ndarray | None = None

    def factors(self):
        """(log weight + log of the normaliser, mean, whitening matrix) of each component."""
        d = self.means.shape[1]
        out = []
        for w, mu, cov in zip(self.weights, self.means, self.covs):
            white = np.linalg.inv(np.linalg.cholesky(cov))
            const = math.log(max(w, LEAST)) + float(np.log(np.diag(white)).sum()) - 0.5 * d * math.log(2 * math.pi)
            out.append((const, mu, white))
        return out

    @property
    def bic(self) -> float:
        """-2 log L + p ln n, p = (k - 1) + k d + k d (d + 1) / 2."""
        k, d = self.means.shape
        return -2.0 * self.log_likelihood + ((k - 1) + k * d + k * d * (d + 1) / 2) * math.log(self.n)

    def model(self, input_col: str = "features", prediction_col: str = "prediction",
              probability_col: str = "probability") -> ColumnRules:
        """Persistable transformer: likeliest component and the membership of each."""
        comps = [{"const": c, "mean": mu.tolist(), "white": w.tolist()} for c, mu, w in self.factors()]
        return ColumnRules.of("mixture", {"components": comps, "inputCol": input_col,
                                          "predictionCol": prediction_col, "probabilityCol": probability_col,
                                          "logLikelihood": self.log_likelihood})


@register("mixture")
def _apply_mixture(spec: dict, df: DataFrame) -> DataFrame:
    def dot(a, b):
        return F.aggregate(F.zip_with(a, b, lambda u, v: u * v), F.lit(0.0), lambda acc, y: acc + y)

    x = vector_to_array(F.col(spec["inputCol"]))
    logs = []
    for c in spec["components"]:
        off = F.zip_with(x, F.lit(c["mean"]), lambda a, b: a - b)
        squares = [F.pow(dot(off, F.lit(row)), 2.0) for row in c["white"]]
        logs.append(F.lit(float(c["const"])) - F.lit(0.5) * sum(squares[1:], squares[0]))
    pred, prob = spec["predictionCol"], spec["probabilityCol"]
    out = df.withColumn(prob, F.array(*logs))
    top = F.array_max(prob)
    out = out.withColumn(pred, (F.array_position(prob, top) - 1).cast("int"))
    out = out.withColumn(prob, F.transform(prob, lambda v: F.exp(v - top)))
    total = F.aggregate(prob, F.lit(0.0), lambda acc, y: acc + y)
    return out.withColumn(prob, F.transform(prob, lambda v: v / total))


def _memberships(factors, x: np.ndarray):
    """Responsibilities (rows, k) and log density of each row."""
    logs = np.stack([const - 0.5 * (((x - mu) @ white.T) ** 2).sum(1) for const, mu, white in factors], 1)
    top = logs.max(1)
    part = np.exp(logs - top[:, None])
    total = part.sum(1)
    return part / total[:, None], top + np.log(total)


def _em_pass(pts: DataFrame, at: dict[int, Mixture], d: int, whole: bool = False) -> dict[int, tuple]:
    """One pass for all models: {m: (log-likelihood, mass, first moments, second moments, sizes)}
    about the present means.  ``whole``: memberships are 1 for the nearest mean."""
    state = {m: (mix.means, None if whole else mix.factors()) for m, mix in at.items()}
    bc = pts.sparkSession.sparkContext.broadcast(state)
    tri = np.triu_indices(d)
    width = 2 + d + len(tri[0])

    def run(batches):
        sums = {m: np.zeros((len(mu), width)) for m, (mu, _f) in bc.value.items()}
        likely = {m: 0.0 for m in sums}
        for x, _rid in _chunks(batches, d):
            for m, (means, factors) in bc.value.items():
                if factors is None:
                    near = _sq_dist(x, means).argmin(1)
                    resp = np.eye(len(means))[near]
                else:
                    resp, log = _memberships(factors, x)
                    near = resp.argmax(1)
                    likely[m] += float(log.sum())
                s = sums[m]
                s[:, 0] += resp.sum(0)
                s[:, 1] += np.bincount(near, minlength=len(means))
                for c, mu in enumerate(means):
                    off = x - mu
                    heavy = resp[:, c][:, None] * off
                    s[c, 2:2 + d] += heavy.sum(0)
                    s[c, 2 + d:] += (heavy.T @ off)[tri]
        rows = [(m, c, j, float(v)) for m, s in sums.items() for c, vals in enumerate(s) for j, v in enumerate(vals)]
        rows += [(m, -1, 0, v) for m, v in likely.items()]
        yield pd.DataFrame(rows, columns=["m", "c", "j", "v"])

    # models x components x moments rows, whatever the data size
    got = pts.mapInPandas(run, "m int, c int, j int, v double").groupBy("m", "c", "j").agg(F.sum("v").alias("v")).toPandas()
    bc.unpersist()
    out = {}
    for m, mix in at.items():
        mine = got[got["m"] == m]
        cells = mine[mine["c"] >= 0]
        s = np.zeros((len(mix.means), width))
        s[cells["c"].to_numpy(), cells["j"].to_numpy()] = cells["v"].to_numpy()
        second = np.zeros((len(s), d, d))
        second[:, tri[0], tri[1]] = s[:, 2 + d:]
        second[:, tri[1], tri[0]] = s[:, 2 + d:]
        out[m] = (float(mine[mine["c"] < 0]["v"].sum()), s[:, 0], s[:, 2:2 + d], second, s[:, 1].astype(int))
    return out


def _next(mix: Mixture, sums: tuple, reg: float) -> Mixture:
    """The M step: parameters from a pass's sums."""
    _log, mass, first, second, _sizes = sums
    d = mix.means.shape[1]
    safe = np.where(mass > 0, mass, 1.0)
    step = first / safe[:, None]
    covs = second / safe[:, None, None] - step[:, :, None] * step[:, None, :]
    return Mixture(mass / mass.sum(), mix.means + step, covs + reg * np.eye(d))


def em_step(vec: DataFrame, mix: Mixture, features: str = "features", reg: float = REG_COVAR) -> Mixture:
    """One E and M step from given parameters; the result holds the log-likelihood,
    number of rows and sizes under the given ones."""
    pts, d, shift = _points(vec, features)
    at = Mixture(mix.weights, mix.means - shift, mix.covs)
    sums = _em_pass(pts, {0: at}, d)[0]
    pts.unpersist()
    new = _next(at, sums, reg)
    return Mixture(new.weights, new.means + shift, new.covs, sums[0], int(sums[4].sum()), sums[4])


def multi_gmm(vec: DataFrame, ks, seed: int = 42, features: str = "features", max_iter: int = MAX_ITER,
              tol: float = TOL, reg: float = REG_COVAR) -> dict[int, Mixture]:
    """CLU-04 for every k in ``ks`` together: {k: fitted mixture}, full covariances."""
    ks = list(ks)
    pts, d, shift = _points(vec, features)
    fits = fit_points(pts, d, [(k, seed) for k in ks])
    at = {k: Mixture(np.ones(k) / k, fits[(k, seed)][0], np.zeros((k, d, d))) for k in ks}
    at = {k: _next(at[k], sums, reg) for k, sums in _em_pass(pts, at, d, whole=True).items()}
    before = {k: -math.inf for k in ks}
    active, done = set(ks), {}
    for it in range(max_iter + 1):
        for k, sums in _em_pass(pts, {k: at[k] for k in sorted(active)}, d).items():
            n = int(sums[4].sum())
            now = sums[0] / n
            if now - before[k] < tol or it == max_iter:
                mix = at[k]
                done[k] = Mixture(mix.weights, mix.means + shift, mix.covs, sums[0], n, sums[4])
                active.discard(k)
            else:
                before[k], at[k] = now, _next(at[k], sums, reg)
        if not active:
            break
    pts.unpersist()
    return done
