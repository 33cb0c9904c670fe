"""Local likelihood, smoothed deviations and drift against plain computations over whole references."""

import math
import random
import statistics

import numpy as np
import pytest

from cytolake.operators import smoothing as sm


def made(seed, n, sample="a", ref="c1", spread=120):
    rng = random.Random(seed)
    out, x = [], 0
    for i in range(n):
        x += rng.randint(1, spread) + (5000 if i % 97 == 50 else 0)
        cov = rng.randint(1, 20)
        level = 0.5 + 0.45 * math.sin(x / 3000)
        out.append((sample, ref, x, sum(rng.random() < level for _ in range(cov)), cov))
    return out


def plain_level(rows, x0, ns, h):
    """Newton's method for one site over all rows."""
    width = max(h, sorted(abs(r[2] - x0) for r in rows)[ns - 1])
    near = [((r[2] - x0) / width, r[3], r[4]) for r in rows if abs(r[2] - x0) < width]
    beta = np.zeros(3)
    for _ in range(200):
        grad, hess = -sm.RIDGE * beta, sm.RIDGE * np.eye(3)
        for u, m, n in near:
            z = np.array([1, u, u * u])
            w = (1 - abs(u) ** 3) ** 3
            p = 1 / (1 + math.exp(-max(-40.0, min(40.0, float(z @ beta)))))
            grad = grad + w * (m - n * p) * z
            hess = hess + w * n * p * (1 - p) * np.outer(z, z)
        step = np.linalg.solve(hess, grad)
        beta = beta + step * min(1, 4 / max(abs(step).max(), 1e-12))
        if abs(step).max() < 1e-10:
            break
    return 1 / (1 + math.exp(-beta[0]))


SITES = "sample string, ref string, start_pos long, m long, cov long"


@pytest.mark.parametrize("size", [4096, 300])
def test_levels_equal_a_plain_fit(spark, monkeypatch, size):
    monkeypatch.setattr(sm, "SIZE", size)
    monkeypatch.setattr(sm.with_neighbours, "__defaults__", (size,))
    rows = made(1, 900) + made(2, 150, "b") + made(3, 20, "few") + [("all", "c1", 10 * i, 7, 7) for i in range(60)] + [("a", "c1", 10**8, 0, 0)]
    got = {(r["sample"], r["start_pos"]): r["smoothed"] for r in sm.local_levels(spark.createDataFrame(rows, SITES), 20, 250).collect()}
    assert len(got) == 900 + 150 + 20 + 60
    assert all(v is None for (s, _), v in got.items() if s == "few")
    assert min(v for (s, _), v in got.items() if s == "all") > 0.999
    own = {s: [r for r in rows if r[0] == s and r[4]] for s in "ab"}
    rng = random.Random(8)
    for s in "ab":
        for r in [own[s][0], own[s][-1], *rng.sample(own[s], 25)]:
            assert got[s, r[2]] == pytest.approx(plain_level(own[s], r[2], 20, 250), abs=1e-6)


def test_nearest_reach():
    x = np.array([0, 1, 5, 6, 20, 100])
    assert sm.nearest_reach(x, np.arange(6), 3).tolist() == [5, 4, 4, 5, 15, 94]


def levels(seed, samples, xs, ref="c1"):
    rng = random.Random(seed)
    return [(s, ref, x, min(1.0, max(0.0, 0.4 + 0.1 * i + rng.gauss(0, 0.05)))) for x in xs for i, s in enumerate(samples)]


def plain_t(table, a, b, variance, k=101, q=0.75):
    by = {}
    for s, _, x, v in table:
        by.setdefault(x, {})[s] = v
    xs = sorted(x for x, v in by.items() if len(v) == len(a) + len(b))
    raw = []
    for x in xs:
        one, two = [by[x][s] for s in a], [by[x][s] for s in b]
        if variance == "paired":
            raw.append(statistics.stdev([p - r for p, r in zip(one, two, strict=True)]))
        elif variance == "group2":
            raw.append(statistics.stdev(two))
        else:
            raw.append(math.sqrt(((len(a) - 1) * statistics.variance(one) + (len(b) - 1) * statistics.variance(two)) / (len(a) + len(b) - 2)))
    ordered = sorted(raw)
    at = lambda share: ordered[math.ceil(share * len(raw)) - 1]
    line = [at(0.5)] * (k // 2) + [max(v, at(q)) for v in raw] + [at(0.5)] * (k // 2)
    scale = math.sqrt(1 / len(a)) if variance == "paired" else math.sqrt(1 / len(a) + 1 / len(b))
    mean = lambda x, names: sum(by[x][s] for s in names) / len(names)
    return {x: (mean(x, a) - mean(x, b)) / (sum(line[i : i + k]) / k * scale) for i, x in enumerate(xs)}


@pytest.mark.parametrize("variance", ["same", "group2", "paired"])
def test_t_equals_a_plain_one(spark, monkeypatch, variance):
    monkeypatch.setattr(sm.with_neighbours, "__defaults__", (64,))
    samples = ["a1", "a2", "a3", "b1", "b2", "b3"]
    table = levels(4, samples, range(5, 40_000, 97)) + [("a1", "c1", 7, 0.5)]
    got = sm.local_t(spark.createDataFrame(table, "sample string, ref string, start_pos long, smoothed double"), samples[:3], samples[3:], variance, correct=False)
    expected = plain_t(table, samples[:3], samples[3:], variance)
    found = {r["start_pos"]: r["t"] for r in got.collect()}
    assert found.keys() == expected.keys()
    assert all(found[x] == pytest.approx(t, rel=1e-9) for x, t in expected.items())


def test_groups_of_other_size_have_no_pairs(spark):
    with pytest.raises(ValueError, match="paired"):
        sm.local_t(spark.createDataFrame([], "sample string, ref string, start_pos long, smoothed double"), ["a", "b"], ["c"], "paired")


def test_drift_is_taken_away_and_jumps_stay(spark, monkeypatch):
    """A slow wave goes, a jump over some sites stays; a short reference keeps its t."""
    monkeypatch.setattr(sm, "SIZE", 64)
    rng = random.Random(6)
    rows = [("c1", x, 3 * math.sin(x / 120_000) + (8 if 200_000 <= x < 204_000 else 0) + rng.gauss(0, 0.1)) for x in range(13, 600_000, 211)]
    short = [("c2", x, 2.0 + x / 20_000) for x in range(0, 20_000, 100)]
    tested = spark.createDataFrame([*rows, *short, ("c1", 700_000, None)], "ref string, start_pos long, raw_t double")
    got = {(r["ref"], r["start_pos"]): r["t"] for r in sm.local_correction(tested).collect()}
    assert len(got) == len(rows) + len(short) + 1
    assert all(got["c2", x] == t for _, x, t in short)
    assert got["c1", 700_000] is None
    for _, x, _t in rows:
        if 30_000 < x < 570_000:
            assert abs(got["c1", x] - (8 if 200_000 <= x < 204_000 else 0)) < 1.6
    inside = [got["c1", x] for _, x, _t in rows if 200_000 <= x < 204_000]
    assert min(inside) > 6


def test_robust_fit_equals_a_plain_one():
    rng = random.Random(9)
    t = np.array([math.sin(i / 9) + rng.gauss(0, 0.1) + (20 if i in (30, 31) else 0) for i in range(80)])
    fit = sm.robust_fit(t, 12, 2000, 25_000)
    for i in (0, 5, 30, 40, 79):
        at = [j for j in range(i - 12, i + 13) if 0 <= j < 80]
        u = np.array([(j - i) * 2000 / 25_000 for j in at])
        basis, kernel = np.stack([np.ones_like(u), u, u * u], 1), (1 - abs(u) ** 3) ** 3
        weight = kernel
        for _ in range(30):
            beta = np.linalg.solve((basis.T * weight) @ basis + 1e-9 * np.eye(3), (basis.T * weight) @ t[at])
            rest = abs(t[at] - basis @ beta)
            fresh = kernel * np.minimum(1, sm.HUBER * 1.4826 * np.median(rest) / np.maximum(rest, 1e-12))
            if abs(fresh - weight).max() < 1e-9:
                break
            weight = fresh
        assert fit[i] == pytest.approx(beta[0], abs=1e-3)
    assert abs(fit[30] - math.sin(30 / 9)) < 0.5
