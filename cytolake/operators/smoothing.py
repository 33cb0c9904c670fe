"""Levels smoothed by local likelihood, t statistics with smoothed deviations, and their local correction.

Work goes by chunks of consecutive sites with the neighbours that they need on
both sides, so a reference of any length is dealt out in parts of one size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.tables import dealt_out, stored
from .intervals import BLOCK

#: Sites of a chunk, and sites that are fitted together.
SIZE, STEP = 4096, 512
#: Keeps a fit finite where all reads agree: the weight of a pull of the coefficients towards 0.
RIDGE = 1e-4
#: Residuals beyond this many deviations count less in a robust fit (Huber's usual constant).
HUBER = 1.345


def with_neighbours(rows: DataFrame, by: list[str], at: str, reach: int, size: int = SIZE) -> DataFrame:
    """rows in chunks of `size` by the order of `at` within `by`: chunk, own (false for the `reach` neighbours on either side), and total, the rows of `by`.

    `at` is distinct within `by`. Rows are numbered by blocks of positions, of which only counts meet.
    """
    placed = rows.withColumn("block", F.floor(F.col(at) / BLOCK))
    counts = placed.groupBy(*by, "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy(*by).orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    counts = counts.withColumns({"before": before, "total": F.sum("n").over(W.partitionBy(*by))}).drop("n")
    number = F.col("before") + F.row_number().over(W.partitionBy(*by, "block").orderBy(at)) - 1
    size = max(size, reach)
    numbered = dealt_out(placed, *by, "block").join(counts, [*by, "block"]).withColumn("i", number).withColumn("home", F.floor(F.col("i") / size))
    inside = F.col("i") % size
    chunks = F.array("home", F.when(inside < reach, F.col("home") - 1), F.when(inside >= size - reach, F.col("home") + 1))
    spread = numbered.withColumn("chunk", F.explode(F.filter(chunks, lambda c: c >= 0)))
    return dealt_out(spread.withColumn("own", F.col("chunk") == F.col("home")).select(*rows.columns, "chunk", "own", "total"), *by, "chunk")


def nearest_reach(x: np.ndarray, at: np.ndarray, ns: int) -> np.ndarray:
    """Distance from x[at] to the farthest of its ns nearest values, itself included. x is sorted."""
    best = np.full(len(at), np.inf)
    for j in range(ns):
        low, high = at - j, at - j + ns - 1
        fits = (low >= 0) & (high < len(x))
        reach = np.maximum(x[at] - x[np.maximum(low, 0)], x[np.minimum(high, len(x) - 1)] - x[at])
        best = np.where(fits & (reach < best), reach, best)
    return best


def local_fit(x: np.ndarray, m: np.ndarray, n: np.ndarray, at: np.ndarray, ns: int, h: float) -> np.ndarray:
    """Levels at x[at] of a quadratic logistic curve fitted to m of n there: tricube weights within h, or as far as the ns nearest sites lie."""
    width = np.maximum(nearest_reach(x, at, ns), h)
    low, high = np.searchsorted(x, x[at] - width, "right"), np.searchsorted(x, x[at] + width, "left")
    sizes = high - low
    row = np.repeat(np.arange(len(at)), sizes)
    near = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes - low, sizes)
    u = (x[near] - x[at][row]) / width[row]
    weight = (1 - np.abs(u) ** 3) ** 3
    basis = np.stack([np.ones_like(u), u, u * u])
    total = lambda v: np.bincount(row, v, len(at))
    hits, reads = weight * m[near], weight * n[near]
    beta = np.zeros((len(at), 3))
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip((beta[row] * basis.T).sum(1), -40, 40)))
        rest, curve = hits - reads * p, reads * p * (1 - p)
        slope = np.stack([total(rest * b) for b in basis], 1) - RIDGE * beta
        hess = np.empty((len(at), 3, 3))
        for i in range(3):
            for j in range(i, 3):
                hess[:, i, j] = hess[:, j, i] = total(curve * basis[i] * basis[j])
        hess[:, range(3), range(3)] += RIDGE
        step = np.linalg.solve(hess, slope[..., None])[..., 0]
        step *= np.minimum(1, 4 / np.maximum(np.abs(step).max(1), 1e-12))[:, None]
        beta += step
        if np.abs(step).max(initial=0) < 1e-9:
            break
    return 1 / (1 + np.exp(-beta[:, 0]))


def local_levels(sites: DataFrame, ns: int = 70, h: int = 1000, by: tuple[str, ...] = ("sample", "ref")) -> DataFrame:
    """(by, start_pos, smoothed): levels by local likelihood (see local_fit) at every covered site; null where `by` has no more than `ns` of them.

    sites: by, start_pos (once each), m, cov. Sites without reads take no part.
    Positions are whole numbers, so what a fit needs lies within ns + h sites.
    """
    keys = list(by)
    rows = sites.filter("cov > 0").select(*keys, "start_pos", F.col("m").cast("double").alias("m"), F.col("cov").cast("double").alias("cov"))
    parts = with_neighbours(rows, keys, "start_pos", ns + h)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("start_pos")
        x, m, n = (table[c].to_numpy().astype(float) for c in ("start_pos", "m", "cov"))
        own = np.flatnonzero(table["own"].to_numpy())
        levels = [local_fit(x, m, n, own[i : i + STEP], ns, h) for i in range(0, len(own), STEP)] if table["total"][0].as_py() > ns else []
        out = table.select([*keys, "start_pos"]).take(pa.array(own))
        return out.append_column("smoothed", pa.array(np.concatenate(levels)) if levels else pa.nulls(len(own), pa.float64()))

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in [*keys, "start_pos"]) + ", smoothed double"
    return parts.groupBy(*keys, "chunk").applyInArrow(run, schema)


def _deviation(a: list[str], b: list[str], variance: str) -> tuple[Column, float]:
    """Raw deviation of a site and what it is scaled by."""
    n1, n2 = len(a), len(b)
    level = {s: F.max(F.when(F.col("sample") == s, F.col("smoothed"))) for s in (*a, *b)}
    of = lambda names: F.var_samp(F.when(F.col("sample").isin(*names), F.col("smoothed")))
    if variance == "same":
        return F.sqrt(((n1 - 1) * of(a) + (n2 - 1) * of(b)) / (n1 + n2 - 2)), (1 / n1 + 1 / n2) ** 0.5
    if variance == "group2":
        return F.sqrt(of(b)), (1 / n1 + 1 / n2) ** 0.5
    if variance != "paired" or n1 != n2:
        raise ValueError("variance is same, group2 or, for groups of one size, paired")
    gaps = [level[x] - level[y] for x, y in zip(a, b, strict=True)]
    mean = sum(gaps[1:], gaps[0]) / n1
    squares = [(g - mean) * (g - mean) for g in gaps]
    return F.sqrt(sum(squares[1:], squares[0]) / (n1 - 1)), (1 / n1) ** 0.5


def local_t(levels: DataFrame, a: list[str], b: list[str], variance: str = "same", correct: bool = True, k: int = 101, floor_at: float = 0.75, every: int = 2000, h: int = 25_000) -> DataFrame:
    """(ref, start_pos, mean1, mean2, diff, sd, raw_t, t) at sites that all samples have, from smoothed levels.

    The deviation of a site, pooled ("same"), of b alone ("group2") or of the
    differences of pairs ("paired", in the order of a and b), is raised to the
    reference's quantile `floor_at`, then averaged over k sites (the median
    stands in beyond the ends). t is corrected by a robust curve (see local_correction).
    """
    n, half = len(a) + len(b), k // 2
    raw, scale = _deviation(a, b, variance)
    side = lambda names: F.avg(F.when(F.col("sample").isin(*names), F.col("smoothed")))
    own = levels.filter(F.col("sample").isin(*a, *b) & F.col("smoothed").isNotNull())
    both = own.groupBy("ref", "start_pos").agg(F.count("*").alias("n"), side(a).alias("mean1"), side(b).alias("mean2"), raw.alias("raw")).filter(F.col("n") == n).drop("n")
    both = stored(both, "deviations")
    cuts = both.groupBy("ref").agg(F.percentile_approx("raw", floor_at, 100_000).alias("least"), F.percentile_approx("raw", 0.5, 100_000).alias("mid"))
    rows = with_neighbours(both.join(cuts, "ref"), ["ref"], "start_pos", half)
    frame = W.partitionBy("ref", "chunk").orderBy("start_pos").rowsBetween(-half, half)
    raised = F.greatest("raw", "least")
    sd = (F.sum(raised).over(frame) + (k - F.count("*").over(frame)) * F.col("mid")) / k
    rows = rows.withColumn("sd", sd).filter("own").withColumn("diff", F.col("mean1") - F.col("mean2"))
    rows = rows.withColumn("raw_t", F.try_divide(F.col("diff"), F.col("sd") * scale)).select("ref", "start_pos", "mean1", "mean2", "diff", "sd", "raw_t")
    return local_correction(stored(rows, "raw-t"), every, h) if correct else rows.withColumn("t", F.col("raw_t"))


def robust_fit(t: np.ndarray, reach: int, every: float, h: float) -> np.ndarray:
    """A local quadratic curve through evenly spaced values, far ones counting less: tricube weights times Huber's, the deviation from the median residual of each window."""
    n, steps = len(t), np.arange(-reach, reach + 1)
    at = np.arange(n)[:, None] + steps
    there = (at >= 0) & (at < n)
    y = np.where(there, t[np.clip(at, 0, n - 1)], 0.0)
    u = steps * every / h
    kernel = np.where(there, (1 - np.abs(u) ** 3) ** 3, 0.0)
    basis = np.stack([np.ones_like(u), u, u * u])
    weight = kernel
    for _ in range(30):
        hess = np.einsum("nk,ik,jk->nij", weight, basis, basis) + 1e-9 * np.eye(3)
        beta = np.linalg.solve(hess, np.einsum("nk,ik,nk->ni", weight, basis, y)[..., None])[..., 0]
        rest = np.abs(y - beta @ basis)
        scale = 1.4826 * np.nanmedian(np.where(there, rest, np.nan), 1)[:, None]
        fresh = kernel * np.minimum(1, HUBER * np.maximum(scale, 1e-12) / np.maximum(rest, 1e-12))
        if np.abs(fresh - weight).max(initial=0) < 1e-9:
            break
        weight = fresh
    return beta[:, 0]


def local_correction(tested: DataFrame, every: int = 2000, h: int = 25_000) -> DataFrame:
    """tested (ref, start_pos, raw_t, ...) with t, raw_t less its slow drift along the reference.

    raw_t is read off at every `every` positions, between sites in proportion; a
    robust local quadratic of half-width h goes through these points, and its
    height at a site, in proportion between points, is taken away. References
    of h positions or less, and sites without raw_t, stay as they are.
    """
    known = tested.filter("raw_t IS NOT NULL").select("ref", "start_pos", "raw_t")
    spans = known.groupBy("ref").agg(F.min("start_pos").alias("low"), F.max("start_pos").alias("high")).filter(F.col("high") - F.col("low") > h)
    order = W.partitionBy("ref", "chunk").orderBy("start_pos")
    steps = with_neighbours(known, ["ref"], "start_pos", 1).withColumns({"x2": F.lead("start_pos").over(order), "t2": F.lead("raw_t").over(order)}).filter("own").join(spans, "ref")
    first, last = F.ceil((F.col("start_pos") - F.col("low")) / every), F.ceil((F.coalesce("x2", F.col("start_pos") + 1) - F.col("low")) / every) - 1
    grid = steps.filter(last >= first).withColumn("g", F.explode(F.sequence(first, last)))
    share = (F.col("low") + F.col("g") * every - F.col("start_pos")) / (F.col("x2") - F.col("start_pos"))
    grid = grid.select("ref", "g", (F.col("raw_t") + F.coalesce(share * (F.col("t2") - F.col("raw_t")), F.lit(0.0))).alias("t"))

    reach = -(-h // every)
    home = F.floor(F.col("g") / SIZE)
    inside = F.col("g") % SIZE
    chunks = F.filter(F.array(home, F.when(inside < reach, home - 1), F.when(inside >= SIZE - reach, home + 1)), lambda c: c >= 0)
    parts = grid.withColumn("chunk", F.explode(chunks))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("g")
        g = table["g"].to_numpy()
        keep = np.flatnonzero(g // SIZE == key[1].as_py())
        fit = robust_fit(table["t"].to_numpy(), reach - 1 if h % every == 0 else reach, every, h)
        return pa.table({"ref": table["ref"].take(pa.array(keep)), "g": pa.array(g[keep]), "drift": pa.array(fit[keep])})

    fitted = stored(parts.groupBy("ref", "chunk").applyInArrow(run, "ref string, g long, drift double"), "drift")
    # a site takes from the points on both sides of it; behind the last point that one holds
    placed = tested.join(spans, "ref", "left").withColumn("g", F.floor((F.col("start_pos") - F.col("low")) / every))
    after = fitted.select("ref", (F.col("g") - 1).alias("g"), F.col("drift").alias("drift2"))
    out = placed.join(fitted, ["ref", "g"], "left").join(after, ["ref", "g"], "left")
    part = (F.col("start_pos") - F.col("low") - F.col("g") * every) / every
    drift = F.col("drift") + part * (F.coalesce("drift2", "drift") - F.col("drift"))
    return out.withColumn("t", F.col("raw_t") - F.coalesce(drift, F.lit(0.0))).select(*tested.columns, "t")
