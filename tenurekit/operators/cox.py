"""Cox proportional hazards with Efron ties and a ridge penalty.

The risk set of a time is everybody whose duration is at least as long, so
every Newton step needs running sums of w, w z and w z z' (w = exp(z b)) in
falling order of time.  Rows are split once into ranges of time and sorted
within them (a time shared by very many rows may span several ranges); the
split is checkpointed.  A step then takes two scans without any shuffle:

1. every range returns the totals of its rows: one vector each;
2. every range walks its times with the totals of the ranges before it as the
   start, and returns the sum of its contributions to the log-likelihood, the
   gradient and the Hessian.  Its first and last time may go on in a neighbour,
   so these two come back as sums of their own, and are put together.

The driver sees at most three vectors of each range, never a row per duration.
Equal rows (time, event and covariates) are counted first and enter every sum
with their number, so with few distinct covariates a step reads few rows,
however many there were.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .prefix import running_sums


#: fewer ranges than shuffle partitions while a range has fewer distinct rows than this
ROWS_PER_RANGE = 100


def _safe_exp(c: float) -> float:
    return math.exp(c) if c < 709 else float("inf")


def _norm_sf(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2.0))


def _digamma(x: float) -> float:
    out = 0.0
    while x < 8.0:
        out, x = out - 1.0 / x, x + 1.0
    y = 1.0 / (x * x)
    return out + math.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y * (1 / 132)))))


def _trigamma(x: float) -> float:
    out = 0.0
    while x < 8.0:
        out, x = out + 1.0 / (x * x), x + 1.0
    y = 1.0 / (x * x)
    return out + (1 + 0.5 / x + y * (1 / 6 - y * (1 / 30 - y * (1 / 42 - y * (1 / 30 - y * (5 / 66)))))) / x


def _power_means(d: int, top: int) -> list[float]:
    """sum over l < d of (l / d)^k for k = 0..top (Bernoulli's formula)."""
    bernoulli = [1.0]
    for m in range(1, top + 1):
        bernoulli.append(-sum(math.comb(m + 1, j) * bernoulli[j] for j in range(m)) / (m + 1))
    return [sum(math.comb(k + 1, j) * bernoulli[j] * float(d) ** (1 - j) for j in range(k + 1)) / (k + 1) for k in range(top + 1)]


def tie_sums(s0: float, d0: float, d: int) -> tuple[float, float, float, float, float, float]:
    """Efron's sums over the d tied events of one time, with f = l / d and
    a = s0 - f d0: of log a, 1/a, f/a, 1/a^2, f/a^2 and f^2/a^2.

    Few ties are summed one by one.  Many take a constant number of steps: a
    power series in d0 / s0 where that is small, else the gamma function and
    its derivatives (a = (d0 / d) (m - l) with m = d s0 / d0)."""
    if d <= 64 or d0 <= 0:
        f = np.arange(d) / d
        a = s0 - f * d0
        return (float(np.log(a).sum()), float((1 / a).sum()), float((f / a).sum()), float((1 / a**2).sum()),
                float((f / a**2).sum()), float((f * f / a**2).sum()))
    x = d0 / s0
    if x < 0.05:
        p = _power_means(d, 14)
        return (d * math.log(s0) - sum(x**k / k * p[k] for k in range(1, 13)), sum(x**k * p[k] for k in range(13)) / s0,
                sum(x**k * p[k + 1] for k in range(13)) / s0, sum((k + 1) * x**k * p[k] for k in range(13)) / s0**2,
                sum((k + 1) * x**k * p[k + 1] for k in range(13)) / s0**2, sum((k + 1) * x**k * p[k + 2] for k in range(13)) / s0**2)
    m, unit = d / x, d0 / d
    logs = d * math.log(unit) + math.lgamma(m + 1) - math.lgamma(m - d + 1)
    a1 = (_digamma(m + 1) - _digamma(m - d + 1)) / unit
    a2 = (_trigamma(m - d + 1) - _trigamma(m + 1)) / unit**2
    return logs, a1, (s0 * a1 - d) / d0, a2, (s0 * a2 - a1) / d0, (s0 * s0 * a2 - 2 * s0 * a1 + d) / d0**2


def _layout(p: int):
    """Where w, w z and the upper triangle of w z z' stand in a vector of sums."""
    i, j = np.triu_indices(p)
    return 1 + p + len(i), i, j


def _matrix(flat: np.ndarray, p: int) -> np.ndarray:
    """Full symmetric matrices from upper triangles (rows)."""
    _, i, j = _layout(p)
    out = np.zeros((len(flat), p, p))
    out[:, i, j] = flat
    out[:, j, i] = flat
    return out


def contributions(total: np.ndarray, tied: np.ndarray, count: np.ndarray, eta: np.ndarray, z: np.ndarray, p: int) -> np.ndarray:
    """[log-likelihood, gradient, Hessian] summed over times: ``total`` holds
    the sums over the risk set, ``tied`` those over the events of the time,
    ``count`` the events, ``eta`` and ``z`` their sums of z b and z."""
    at = np.flatnonzero(count > 0)
    if not len(at):
        return np.zeros(1 + p + p * p)
    total, tied, count, eta, z = total[at], tied[at], count[at], eta[at], z[at]
    s0 = total[:, 0]
    c = np.zeros((6, len(at)))  # sums over the ties, see tie_sums
    c[0], c[1], c[3] = np.log(s0), 1 / s0, 1 / s0 ** 2
    for k in np.flatnonzero(count > 1):
        c[:, k] = tie_sums(float(s0[k]), float(tied[k, 0]), int(count[k]))
    s1, d1 = total[:, 1:1 + p], tied[:, 1:1 + p]
    s2, d2 = _matrix(total[:, 1 + p:], p), _matrix(tied[:, 1 + p:], p)
    w = lambda k: c[k][:, None]
    g = z - (s1 * w(1) - d1 * w(2))
    outer = lambda a, b, k: np.einsum("ni,nj,n->ij", a, b, c[k])
    cross = outer(s1, d1, 4)
    h = (s2 * c[1][:, None, None] - d2 * c[2][:, None, None]).sum(axis=0) - (outer(s1, s1, 3) - (cross + cross.T) + outer(d1, d1, 5))
    return np.concatenate([[eta.sum() - c[0].sum()], g.sum(axis=0), (-h).ravel()])


def _read(batch: pa.RecordBatch, beta: np.ndarray):
    """Times, events, z b, z, and the summands w, w z, w z z' of a batch; the last
    four times the number of equal rows where they are summed."""
    p = len(beta)
    z = np.column_stack([batch.column(f"_z{k}").to_numpy() for k in range(p)]) if p else np.zeros((batch.num_rows, 0))
    eta = z @ beta
    w = np.exp(eta)
    _, i, j = _layout(p)
    n = batch.column("_n").to_numpy().astype(float)
    event = batch.column("_e").to_numpy().astype(float)
    w = w * n
    return (batch.column("_t").to_numpy(), event, n * event, eta, z,
            np.column_stack([w, w[:, None] * z, w[:, None] * z[:, i] * z[:, j]]))


def _range_totals(beta: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, pid = None, None
        for batch in batches:
            if batch.num_rows:
                pid = batch.column("_pid")[0].as_py()
                x = _read(batch, beta)[5].sum(axis=0)
                total = x if total is None else total + x
        if pid is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pid], pa.int32()), pa.array([total.tolist()], pa.list_(pa.float64()))], ["pid", "v"])
    return run


def _times(batches: Iterator[pa.RecordBatch], beta: np.ndarray):
    """Groups of equal time in a range, batch by batch: times and, per time,
    [sums over all rows | sums over events | events, z b and z of events].  The
    last time of a batch is held back, as the next batch may go on with it."""
    held_t, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        t, e, events, eta, z, x = _read(batch, beta)
        head = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        y = np.add.reduceat(np.column_stack([x, e[:, None] * x, events, events * eta, events[:, None] * z]), head)
        t = t[head]
        if held_t is not None:
            if t[0] == held_t:
                y[0] += held
            else:
                t, y = np.concatenate(([held_t], t)), np.vstack([held[None], y])
        held_t, held = t[-1], y[-1]
        if len(t) > 1:
            yield t[:-1], y[:-1]
    if held_t is not None:
        yield np.array([held_t]), held[None]


SCAN = "kind int, pid int, t double, v array<double>"


def _range_scan(beta: np.ndarray, before: dict[int, list[float]]):
    """kind 0: contributions of the inner times; kind 1: an outer time with the
    sums before it and its own."""
    p = len(beta)
    q = _layout(p)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid = None

        def tagged():
            nonlocal pid
            for batch in batches:
                if batch.num_rows:
                    pid = batch.column("_pid")[0].as_py()
                yield batch

        carry, out, first, last = None, np.zeros(1 + p + p * p), None, None
        for t, y in _times(tagged(), beta):
            if carry is None:
                carry = np.array(before[pid])
            upto = carry + np.cumsum(y[:, :q], axis=0)
            prior = np.vstack([carry[None], upto[:-1]])
            carry = upto[-1]
            if last is not None:  # was not the last after all
                t, y, prior, upto = (np.concatenate([a, b]) for a, b in zip(last, (t, y, prior, upto)))
            if first is None:
                first = (t[0], prior[0], y[0])
                t, y, prior, upto = t[1:], y[1:], prior[1:], upto[1:]
            last = tuple(a[-1:] for a in (t, y, prior, upto)) if len(t) else None
            if len(t) > 1:
                out += contributions(upto[:-1], y[:-1, q:2 * q], y[:-1, 2 * q], y[:-1, 2 * q + 1], y[:-1, 2 * q + 2:], p)
        if pid is None:
            return
        rows = [(0, pid, None, out.tolist()), (1, pid, float(first[0]), [*first[1], *first[2]])]
        if last is not None:
            rows.append((1, pid, float(last[0][0]), [*last[2][0], *last[1][0]]))
        k, i, t, v = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(i, pa.int32()), pa.array(t, pa.float64()), pa.array([list(map(float, x)) for x in v])],
                                         ["kind", "pid", "t", "v"])
    return run


def _risk_rows(beta: np.ndarray, before: dict[int, list[float]]):
    """Per range and time: events, sum of w, and the sum of w before it."""
    q = _layout(len(beta))[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pid, carry = None, None

        def tagged():
            nonlocal pid
            for batch in batches:
                if batch.num_rows:
                    pid = batch.column("_pid")[0].as_py()
                yield batch

        for t, y in _times(tagged(), beta):
            carry = before[pid][0] if carry is None else carry
            prior = carry + np.cumsum(y[:, 0]) - y[:, 0]
            carry += float(y[:, 0].sum())
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(y[:, 2 * q].astype(np.int64)), pa.array(y[:, 0]), pa.array(prior)], ["t", "d", "own", "prior"])
    return run


def _before(data: DataFrame, beta: np.ndarray) -> dict[int, list[float]]:
    """Sums over the ranges of longer durations, by range."""
    rows = sorted(data.mapInArrow(_range_totals(beta), "pid int, v array<double>").collect(), key=lambda r: r["pid"])  # a row per range
    out, at = {}, np.zeros(_layout(len(beta))[0])
    for r in rows:
        out[r["pid"]] = at.tolist()
        at = at + np.array(r["v"])
    return out


def step_sums(data: DataFrame, beta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Log-likelihood, gradient and Hessian at ``beta``."""
    p = len(beta)
    q = _layout(p)[0]
    total = np.zeros(1 + p + p * p)
    outer: dict[float, list] = {}
    rows = data.mapInArrow(_range_scan(beta, _before(data, beta)), SCAN).collect()  # at most three rows per range
    for r in sorted(rows, key=lambda r: r["pid"]):
        v = np.array(r["v"])
        if r["kind"] == 0:
            total += v
        elif r["t"] in outer:  # goes on in a later range: what stands before it is known already
            outer[r["t"]][1] += v[q:]
        else:
            outer[r["t"]] = [v[:q], v[q:].copy()]
    if outer:
        y = np.array([own for _, own in outer.values()])
        upto = np.array([prior for prior, _ in outer.values()]) + y[:, :q]
        total += contributions(upto, y[:, q:2 * q], y[:, 2 * q], y[:, 2 * q + 1], y[:, 2 * q + 2:], p)
    return float(total[0]), total[1:1 + p], total[1 + p:].reshape(p, p)


def fit_cox(df: DataFrame, duration: str, event: str, features: Sequence[str],
            penalizer: float = 0.1, tol: float = 1e-7, max_iter: int = 50):
    """I8 + I10: Cox model with Efron ties and a ridge penalty
    ``n·penalizer/2·‖β‖²`` on standardised covariates.  Returns
    ``(coef_frame, baseline_frame, info)``: per term coef, se, z, p, hazard
    ratio and significance; the Breslow baseline cumulative hazard at the
    covariate means (one row per distinct duration, never collected)."""
    spark = df.sparkSession
    p = len(features)
    base = df.select(F.col(duration).cast("double").alias("_t"), F.col(event).cast("int").alias("_e"),
                     *[F.col(c).cast("double").alias(c) for c in features]).dropna()
    base = cut_lineage(base.groupBy(*base.columns).agg(F.count(F.lit(1)).alias("_n")))
    st = base.agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("distinct"),
                  *[(F.sum(F.col("_n") * F.col(c)) / F.sum("_n")).alias(f"m_{c}") for c in features],
                  *[(F.max(c) == F.min(c)).alias(f"c_{c}") for c in features]).collect()[0]
    n = int(st["n"] or 0)
    if n == 0:
        raise ValueError("the Cox fit has no complete row")
    mean = np.array([st[f"m_{c}"] for c in features], dtype=float)
    spread = base.agg(F.sum("_n"), *[F.sqrt(F.sum(F.col("_n") * (F.col(c) - float(mean[i])) ** 2) / F.sum("_n")) for i, c in enumerate(features)]).first()
    sd = np.array([0.0 if st[f"c_{c}"] else spread[i + 1] for i, c in enumerate(features)], dtype=float)
    sd[sd == 0] = 1.0
    ranges = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-st["distinct"] // ROWS_PER_RANGE)))
    data = base.select("_t", "_e", "_n", *[((F.col(c) - float(mean[i])) / float(sd[i])).alias(f"_z{i}") for i, c in enumerate(features)],
                       F.xxhash64(F.monotonically_increasing_id()).alias("_salt"))
    data = (data.repartitionByRange(ranges, F.desc("_t"), F.col("_salt")).drop("_salt").sortWithinPartitions(F.desc("_t"))
            .withColumn("_pid", F.spark_partition_id()))
    data = cut_lineage(data)
    beta = np.zeros(p)
    pen = lambda b: 0.5 * n * penalizer * float(b @ b)
    ll, g, H = step_sums(data, beta)
    obj = ll - pen(beta)
    it, converged = 0, False
    for it in range(1, max_iter + 1):
        gp = g - n * penalizer * beta
        Hp = H - n * penalizer * np.eye(p)
        try:
            step = np.linalg.solve(Hp, gp)
        except np.linalg.LinAlgError as e:
            raise ValueError("Cox information matrix is singular") from e
        t = 1.0
        while True:
            nb = beta - t * step
            ll_n, g_n, H_n = step_sums(data, nb)
            obj_n = ll_n - pen(nb)
            if obj_n >= obj - 1e-9 * max(1.0, abs(obj)) or t < 1e-4:
                break
            t /= 2.0
        if obj_n < obj - 1e-9 * max(1.0, abs(obj)):  # no step improves: keep the point reached
            break
        delta = np.max(np.abs(nb - beta))
        beta, ll, g, H, obj = nb, ll_n, g_n, H_n, obj_n
        if delta < tol:
            converged = True
            break
    if not converged:
        raise ValueError(f"the Cox fit did not converge in {it} steps")
    cov = np.linalg.inv(-(H - n * penalizer * np.eye(p)))
    coef = beta / sd
    se = np.sqrt(np.diag(cov)) / sd
    out = []
    for i, c in enumerate(features):
        z = coef[i] / se[i] if se[i] > 0 else float("nan")
        pv = 2 * _norm_sf(abs(z))
        out.append((c, float(coef[i]), float(se[i]), float(z), float(pv), _safe_exp(coef[i]), bool(pv < 0.05)))
    coefs = spark.createDataFrame(out, "term string, coef double, se double, z double, p_value double, "
                                       "hazard_ratio double, significant boolean")
    # Breslow baseline at the covariate means (z centred): events over the sum
    # of w at risk, then a running sum over the distinct times
    risk = (data.mapInArrow(_risk_rows(beta, _before(data, beta)), "t double, d long, own double, prior double")
            .groupBy("t").agg(F.sum("d").alias("d"), (F.min("prior") + F.sum("own")).alias("s0")))
    steps = risk.select("t", F.when(F.col("s0") > 0, F.col("d") / F.col("s0")).otherwise(0.0).alias("h"))
    baseline = running_sums(steps, [], ["t"], {"_h": "h"}).select(F.col("t").alias("time"), (F.col("_h") + F.col("h")).alias("cum_hazard"))
    info = {"iterations": it, "converged": converged, "loglik": ll, "n": n, "means": dict(zip(features, mean.tolist()))}
    return coefs, baseline, info
