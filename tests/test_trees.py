"""Linkages, distances, branch cuts, odds ratios and the variance guard against naive versions and known values."""

import random
from itertools import combinations

import numpy as np
import pandas as pd
import pytest

from cytolake.functions import special
from cytolake.operators import multivariate as mv
from cytolake.operators import patterns as pt
from cytolake.operators import stats as ts


def distances(n, seed):
    x = np.random.default_rng(seed).random((n, 3))
    return np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))


def naive(far, method):
    """All pairs of clusters looked at for every merge; the distance of clusters by definition where there is one."""
    groups, d = {i: [i] for i in range(len(far))}, {(i, j): far[i][j] for i, j in combinations(range(len(far)), 2)}
    size, merges = dict.fromkeys(groups, 1), []
    while len(groups) > 1:
        a, b = min(d, key=lambda x: (d[x], x))
        h = d.pop((a, b))
        merges.append((a, b, h))
        for k in groups:
            if k in (a, b):
                continue
            x, y = d.pop(tuple(sorted((a, k)))), d.pop(tuple(sorted((b, k))))
            i, j, m = size[a], size[b], size[k]
            d[tuple(sorted((a, k)))] = {"complete": max(x, y), "single": min(x, y), "average": np.mean([far[p][q] for p in groups[a] + groups[b] for q in groups[k]]), "mcquitty": 0.5 * x + 0.5 * y, "ward": ((i + m) * x + (j + m) * y - m * h) / (i + j + m), "ward2": (((i + m) * x**2 + (j + m) * y**2 - m * h**2) / (i + j + m)) ** 0.5, "median": 0.5 * x + 0.5 * y - 0.25 * h, "centroid": i / (i + j) * x + j / (i + j) * y - i * j / (i + j) ** 2 * h}[method]
        groups[a] += groups.pop(b)
        size[a] += size[b]
    return merges


@pytest.mark.parametrize("method", pt.LINKAGES)
def test_linkages_equal_naive_ones(method):
    for seed, n in ((1, 40), (2, 7), (3, 2), (4, 1)):
        far = distances(n, seed)
        leaves, merges = pt.linkage(far, method)
        expected = naive(far.tolist(), method)
        assert sorted(leaves) == list(range(n))
        if method not in ("median", "centroid"):
            expected = sorted(expected, key=lambda m: m[2])
        assert [m[:2] for m in merges] == [m[:2] for m in expected]
        assert [m[2] for m in merges] == pytest.approx([m[2] for m in expected])
        place, groups = {x: k for k, x in enumerate(leaves)}, {i: [i] for i in range(n)}
        for a, b, _ in naive(far.tolist(), method):  # every branch lies together
            groups[a] += groups.pop(b)
            at = [place[x] for x in groups[a]]
            assert max(at) - min(at) == len(at) - 1


def test_linkage_takes_ties():
    far = np.ones((6, 6)) - np.eye(6)
    for method in pt.LINKAGES:
        leaves, merges = pt.linkage(far, method)
        assert sorted(leaves) == list(range(6))
        assert len(merges) == 5


def test_row_distances():
    x = np.array([[1.0, 2, 3, 9], [2, 2, 1, 0], [0, 0, 4, 1], [3, 1, 0, 0], [1, 1, 5, 2]])
    for metric, of in {"euclidean": lambda a, b: ((a - b) ** 2).sum() ** 0.5, "manhattan": lambda a, b: abs(a - b).sum(), "maximum": lambda a, b: abs(a - b).max(), "minkowski": lambda a, b: ((a - b) ** 2).sum() ** 0.5, "binary": lambda a, b: ((a != 0) != (b != 0)).sum() / ((a != 0) | (b != 0)).sum()}.items():
        assert np.allclose(mv.row_distances(x, metric), [[of(a, b) for b in x] for a in x]), metric
    assert np.allclose(mv.row_distances(x, "minkowski", 3), [[(abs(a - b) ** 3).sum() ** (1 / 3) for b in x] for a in x])
    for metric in ("pearson", "spearman", "kendall"):
        assert np.allclose(mv.row_distances(x, metric), 1 - pd.DataFrame(x.T).corr(metric) if metric != "kendall" else [[1 - tau_b(a, b) for b in x] for a in x], atol=1e-9), metric


def tau_b(a, b):
    signs = [(np.sign(a[i] - a[j]), np.sign(b[i] - b[j])) for i, j in combinations(range(len(a)), 2)]
    return sum(p * q for p, q in signs) / (sum(p * p for p, _ in signs) * sum(q * q for _, q in signs)) ** 0.5


@pytest.mark.parametrize("method", ["average", "ward2"])
def test_rows_come_in_the_order_of_their_tree(spark, method):
    rng = random.Random(4)
    rows = [(f"r{k:02}", *(rng.random() for _ in range(4))) for k in range(30)]
    table = spark.createDataFrame(rows, "id string, a double, b double, c double, d double")
    found = [r["id"] for r in sorted(mv.cluster_rows(table, list("abcd"), 30, method=method).collect(), key=lambda r: r["place"])]
    leaves, _ = pt.linkage(mv.row_distances(np.array([r[1:] for r in rows]), "euclidean"), method)
    assert found == [rows[k][0] for k in leaves]


def points(*groups):
    at = np.array([x for g in groups for x in g], float)
    return np.abs(at[:, None] - at)


def test_branch_cut_of_hand_made_trees():
    cut = lambda far, **k: pt.branch_cut(len(far), pt.linkage(far)[1], **k)
    assert cut(points((0, 0.1, 0.2), (5, 5.1), (9, 9.1, 9.2, 9.3))) == [1, 1, 1, 2, 2, 3, 3, 3, 3]
    assert cut(points((0, 0.1), (10,), (30, 30.1))) == [1, 1, 1, 2, 2]
    # two pairs far apart in heights: a wide branch and a tight one are both found
    four = points((0, 1), (20, 21), (100, 100.1), (110, 110.1))
    assert cut(four, depth=3) == [1, 1, 2, 2, 3, 3, 4, 4]
    assert cut(four, depth=0) == [1, 1, 1, 1, 2, 2, 2, 2]
    assert cut(points((0, 0.1, 0.2), (5, 5.1)), least=3) == [1, 1, 1, 0, 0]
    assert cut(points((0,))) == [0]
    assert cut(np.zeros((0, 0))) == []


def test_branch_cut_gives_branches_of_the_least_size():
    for seed in range(8):
        far = distances(40, seed)
        merges = pt.linkage(far)[1]
        groups, branches = {i: frozenset([i]) for i in range(40)}, set()
        for a, b, _ in merges:
            groups[a] |= groups.pop(b)
            branches.add(groups[a])
        for depth in range(5):
            number = pt.branch_cut(40, merges, 3, depth)
            clusters = {frozenset(i for i, k in enumerate(number) if k == x) for x in set(number) - {0}}
            assert clusters <= branches
            assert all(len(c) >= 3 for c in clusters)
    assert len(set(pt.branch_cut(40, merges, 3, 4))) >= len(set(pt.branch_cut(40, merges, 3, 0)))


def test_clones_by_branches(spark):
    rows = [("c", 1, p, 1) for p in ("0000", "0001", "1110", "1111")]
    found = {r["pattern"]: r["clone"] for r in pt.clones(spark.createDataFrame(rows, "ref string, w_start long, pattern string, n long"), None).collect()}
    assert found["0000"] == found["0001"] != found["1110"] == found["1111"]


def test_odds_have_known_values_and_the_mean_of_the_table():
    """The tea tasting and the convictions of twins have published estimates."""
    a, b, c, d = (np.array(x) for x in zip((3, 1, 1, 3), (2, 15, 10, 3), (0, 5, 4, 2), (5, 0, 2, 4), (0, 0, 1, 2), (4, 0, 6, 0), (7, 9, 20, 1), strict=True))
    odds = ts.conditional_odds(a, b, c, d)
    assert odds[0] == pytest.approx(6.408309, rel=1e-5)
    assert odds[1] == pytest.approx(0.04693661, rel=1e-4)
    assert odds[2] == 0
    assert odds[3] == np.inf
    assert np.isnan(odds[4])
    assert np.isnan(odds[5])
    k = np.arange(max(0, 7 - 1), min(16, 27) + 1)
    weight = np.exp(-sum(special.log_factorial(x) for x in (k, 16 - k, 27 - k, 1 - 7 + k)) + k * np.log(odds[6]))
    assert (weight * k).sum() / weight.sum() == pytest.approx(7, abs=1e-9)
    assert ts.conditional_odds(*(np.zeros(0, int),) * 4).tolist() == []


def test_log_factorials():
    import math

    n = np.array([0, 1, 2, 20, 255, 256, 257, 1000, 10**7])
    assert np.allclose(special.log_factorial(n), [math.lgamma(x + 1) for x in n], rtol=1e-13)


def test_variances_of_nothing(spark):
    rows = [(k, g, v) for k, (x, y) in {"both": ((0.5, 0.5), (0.25, 0.25)), "first": ((0.5, 0.5), (0.1, 0.3)), "second": ((0.1, 0.4), (0.5, 0.5)), "none": ((0.1, 0.4), (0.5, 0.9)), "few": ((0.1,), (0.5, 0.9))}.items() for g, values in (("a", x), ("b", y)) for v in values]
    out = {r["k"]: (r["f"], r["p"]) for r in ts.variance_ratio(spark.createDataFrame(rows, "k string, grp string, pct double"), "a", "b", keys=("k",)).collect()}
    assert out["both"] == out["second"] == (float("inf"), 0)
    assert out["first"] == (0, 0)
    assert out["none"][0] == pytest.approx(0.5625)
    assert 0 < out["none"][1] < 1
    assert "few" not in out


def test_reports_hold_every_key_and_part_them(spark):
    rng = random.Random(5)
    shift = {"far": 0.6, "near": 0.02, "flat": 0.0}
    rows = [(k, f"{k}{i}", g, 0.2 + shift[k] * (g == "b") + (0 if k == "flat" else rng.gauss(0, 0.01))) for k in shift for i in range(4) for g in "abc" for _ in range(4)]
    rows += [("lone", "lone0", "a", 0.5)]
    table = spark.createDataFrame(rows, "kind string, site string, grp string, pct double")
    tests = ts.welch(table, "a", "b", keys=("site",))
    report = ts.two_group_report(table, "a", "b", tests.filter("site <> 'near3'"), ("site",))
    found = {r["site"]: r for r in report.collect()}
    assert len(found) == 13
    assert (found["lone0"]["diff"], found["lone0"]["p"], found["lone0"]["mean2"]) == (0, 1, None)
    assert found["near3"]["p"] == 1
    order = sorted(r["p"] for r in found.values())
    for r in found.values():
        assert r["q"] == pytest.approx(min(1, min(p * 13 / (13 - order[::-1].index(p)) for p in order if p >= r["p"])), rel=1e-9)
    tables = ts.report_tables(report, 0.01, 0.05, 0.25, 1)
    names = lambda t: {r["site"] for r in t.collect()}
    assert names(tables["by_p"]) == names(tables["by_q"]) == {f"far{i}" for i in range(4)}
    assert names(tables["top"]) == {max((s for s in found if s.startswith("far")), key=lambda s: abs(found[s]["diff"]))}
    assert names(ts.report_tables(report, 0.01, 0.05, 0.25, 2)["top"]) == {f"far{i}" for i in range(4)}
    whole = ts.anova_report(table, keys=("site",))
    assert {r["site"] for r in whole.filter("p = 1").collect()} >= {"lone0"}
    parts = ts.anova_tables(whole, [("a", "b"), ("c", "a"), ("b", "c")])
    assert names(parts["a", "b"]) == names(parts["b", "c"]) == {f"far{i}" for i in range(4)}
    assert not names(parts["c", "a"])
