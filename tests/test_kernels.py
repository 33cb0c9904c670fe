"""Kernels that SQL can't express, against values from tables, enumeration or a plain computation."""

import re
import itertools
import math
import random

import numpy as np
import pytest

from cytolake.functions import special
from cytolake.operators import multivariate as mv
from cytolake.operators import patterns as pt
from cytolake.operators import stats as ts


@pytest.mark.parametrize(("t", "df", "p"), [(12.706, 1, 0.05), (2.228, 10, 0.05), (2.845, 20, 0.01), (1.96, 1e6, 0.05), (0.0, 5, 1.0)])
def test_t_tails_equal_the_tables(t, df, p):
    assert math.isclose(float(special.t_two_sided(np.array([t]), np.array([df]))[0]), p, rel_tol=2e-3)


@pytest.mark.parametrize(("f", "d1", "d2", "p"), [(4.965, 1, 10, 0.05), (3.098, 3, 20, 0.05), (9.330, 1, 12, 0.01)])
def test_f_tails_equal_the_tables(f, d1, d2, p):
    assert math.isclose(float(special.f_upper(*map(np.array, ([f], [d1], [d2])))[0]), p, rel_tol=2e-3)


@pytest.mark.parametrize(("x", "df", "p"), [(3.841, 1, 0.05), (11.070, 5, 0.05), (30.578, 15, 0.01)])
def test_chi_squared_tails_equal_the_tables(x, df, p):
    assert math.isclose(float(special.chi2_upper(np.array([x]), np.array([df]))[0]), p, rel_tol=2e-3)


@pytest.mark.parametrize(("q", "groups", "df", "p"), [(3.877, 3, 10, 0.05), (4.654, 5, 10, 0.05), (3.314, 3, 1e5, 0.05), (5.270, 3, 10, 0.01), (17.97, 2, 1, 0.05), (8.331, 3, 2, 0.05)])
def test_studentised_range_equals_the_tables(q, groups, df, p):
    assert math.isclose(float(special.tukey_upper(np.array([q]), np.array([groups]), np.array([df]))[0]), p, rel_tol=1e-2)


def test_studentised_range_of_two_groups_is_t():
    q = np.linspace(0.1, 9, 30)
    assert np.allclose(special.tukey_upper(q, np.full(30, 2), np.full(30, 7.0)), special.t_two_sided(q / math.sqrt(2), np.full(30, 7.0)), atol=1e-5)


def splits(values, n):
    every = set(range(len(values)))
    return [([values[i] for i in c], [values[i] for i in sorted(every - set(c))]) for c in itertools.combinations(range(len(values)), n)]


@pytest.mark.parametrize(("n", "m"), [(3, 3), (2, 5), (4, 4)])
def test_exact_rank_tests_equal_enumeration(n, m):
    rng = random.Random(n * 10 + m)
    values = rng.sample(range(1000), n + m)
    x, y = np.array(values[:n], float), np.array(values[n:], float)
    rank = {v: i + 1 for i, v in enumerate(sorted(values))}
    middle = lambda v: min(rank[v], n + m + 1 - rank[v])
    for test, statistic in ((special.rank_sum, lambda a: sum(rank[v] for v in a) - n * (n + 1) / 2), (special.ansari_bradley, lambda a: sum(map(middle, a)))):
        all_values = [statistic(a) for a, _ in splits(values, n)]
        own = statistic(values[:n])
        low, high = (sum(f(v, own) for v in all_values) / len(all_values) for f in (lambda v, o: v <= o, lambda v, o: v >= o))
        found = test(x, y)
        assert found[0] == own and math.isclose(found[1], min(1.0, 2 * min(low, high)), rel_tol=1e-9)
    d = lambda a, b: max(abs(sum(v <= t for v in a) / len(a) - sum(v <= t for v in b) / len(b)) for t in values)
    own = d(values[:n], values[n:])
    p = sum(d(a, b) >= own - 1e-9 for a, b in splits(values, n)) / math.comb(n + m, n)
    assert np.allclose(special.ks_distance(x, y), (own, p))
    for test, statistic in ((special.cucconi, special.cucconi_statistic), (special.lepage, special.lepage_statistic)):
        of = lambda a, b, s=statistic: s(np.array([rank[v] for v in a + b], float), n)
        own = of(values[:n], values[n:])
        p = sum(of(a, b) >= own - 1e-12 for a, b in splits(values, n)) / math.comb(n + m, n)
        assert np.allclose(test(x, y), (own, p))


def test_cucconi_worked_by_hand():
    """Ranks 1, 2 of 4 against 3, 4: squares 5 and contrary squares 25, of 15 expected on average."""
    den = math.sqrt(2 * 2 * 5 * 9 * 43 / 5)
    u, v, rho = (6 * 5 - 2 * 5 * 9) / den, (6 * 25 - 2 * 5 * 9) / den, 2 * 12 / (9 * 43) - 1
    assert math.isclose(special.cucconi(np.array([1.0, 2]), np.array([3.0, 4]))[0], (u * u + v * v - 2 * rho * u * v) / (2 * (1 - rho * rho)))


def test_signed_rank_equals_enumeration():
    d = np.array([1.5, -0.3, 2.2, 0.9, -1.1])
    ranks = special.average_ranks(np.abs(d))
    sums = [sum(r for r, s in zip(ranks, signs, strict=True) if s) for signs in itertools.product((0, 1), repeat=5)]
    own = ranks[d > 0].sum()
    low, high = np.mean([s <= own for s in sums]), np.mean([s >= own for s in sums])
    assert np.allclose(special.signed_rank(d), (own, min(1.0, 2 * min(low, high))))
    assert math.isnan(special.signed_rank(np.zeros(3))[1])


def test_welch_guard_and_p(spark):
    rows = [("c", 1, s, g, v) for s, g, v in (("a1", "F", 0.5), ("a2", "F", 0.5), ("b1", "O", 0.25), ("b2", "O", 0.25))] + [("c", 2, s, g, v) for s, g, v in (("a1", "F", 1.0), ("a2", "F", 2.0), ("a3", "F", 3.0), ("b1", "O", 4.0), ("b2", "O", 5.0), ("b3", "O", 6.0))]
    found = {r["start_pos"]: r for r in ts.welch(spark.createDataFrame(rows, "ref string, start_pos long, sample string, grp string, pct double"), "F", "O").collect()}
    assert math.isclose(found[1]["t"], 0.25 / math.sqrt(1e-20 / 4), rel_tol=1e-6) and found[1]["df"] == 1
    assert math.isclose(found[2]["t"], -3 / math.sqrt(2 / 3)) and math.isclose(found[2]["df"], 4) and math.isclose(found[2]["p"], 0.02131164, rel_tol=1e-5)


def matrix(spark, n, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.random((n, 4)).round(3)
    return x, spark.createDataFrame([(f"r{i:04d}", *map(float, v)) for i, v in enumerate(x)], "id string, a double, b double, c double, d double")


def test_components_equal_a_decomposition(spark):
    x, table = matrix(spark, 50)
    found = {(r["sample"], r["component"]): r for r in mv.principal_components(table, list("abcd")).collect()}
    own = x.T - x.T.mean(0)
    u, s, _ = np.linalg.svd(own, full_matrices=False)
    for k in range(3):
        score = u[:, k] * s[k] * np.sign(u[0, k])
        assert np.allclose([found[(c, k + 1)]["score"] for c in "abcd"], score, atol=1e-8)
        assert math.isclose(found[("a", k + 1)]["sdev"], s[k] / math.sqrt(3), rel_tol=1e-8)


def test_medoids_equal_partitioning_around_medoids(spark):
    x, table = matrix(spark, 30)
    found = sorted(mv.medoids(table, list("abcd"), 2).collect())
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    cost = lambda m: far[:, list(m)].min(1).sum()
    picked = {int(r["medoid"][1:]) for r in found}
    assert len(found) == 30 and len(picked) == 2
    assert all(cost((picked - {old}) | {new}) >= cost(picked) - 1e-9 for old in picked for new in range(30) if new not in picked)
    assert all(far[i, int(r["medoid"][1:])] == min(far[i, m] for m in picked) for i, r in enumerate(found))
    assert len(mv.medoids(table, list("abcd"), 3, candidates=10).collect()) == 30
    assert mv.medoids(table.limit(0), list("abcd"), 2).count() == 0


def brute_linkage(far, cut):
    groups = [[i] for i in range(len(far))]
    while len(groups) > 1:
        height, a, b = min((max(far[i][j] for i in g for j in h), k, m) for k, g in enumerate(groups) for m, h in enumerate(groups) if k < m)
        if height > cut:
            break
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def test_clusters_equal_brute_force(spark):
    x, table = matrix(spark, 25, 3)
    far = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    for cut in (0.2, 0.5, 0.8, 9):
        numbers = pt.complete_linkage(far, cut)
        assert {frozenset(i for i, n in enumerate(numbers) if n == k) for k in set(numbers)} == brute_linkage(far.tolist(), cut)
        assert numbers[0] == 0
    samples = mv.cluster_samples(table, list("abcd"), 1.9).collect()
    across = np.sqrt(((x.T[:, None] - x.T[None]) ** 2).sum(2))
    assert [r["cluster"] for r in samples] == pt.complete_linkage(across, 1.9)
    order = [int(r["id"][1:]) for r in sorted(mv.cluster_rows(table, list("abcd"), 20).collect(), key=lambda r: r["place"])]
    spread = x.max(1) - x.min(1)
    assert set(order) == set(np.argsort(-spread, kind="stable")[:20].tolist())


def test_clones_equal_brute_force(spark):
    rows = [("c", 1, p, 1) for p in ("1100", "1101", "0011", "0-11", "1-00", "----", "0111")]
    found = {r["pattern"]: r["clone"] for r in pt.clones(spark.createDataFrame(rows, "ref string, w_start long, pattern string, n long")).collect()}
    names = sorted(r[2] for r in rows)
    far = [[0.0 if not (both := [(a, b) for a, b in zip(p, q, strict=True) if "-" not in (a, b)]) else sum(a != b for a, b in both) / len(both) for q in names] for p in names]
    assert np.allclose(pt.pattern_distances(names), far)
    groups = {frozenset(n for n in names if found[n] == k) for k in set(found.values())}
    assert all(max(far[names.index(a)][names.index(b)] for a in g for b in g) <= 0.5 for g in groups)


def test_kmeans_profiles(spark):
    rows = [(f"r{k}", *(c + 0.01 * (k % 3) for c in centre)) for k in range(30) for centre in [((0.1, 0.1), (0.9, 0.1), (0.5, 0.9))[k % 3]]]
    table = spark.createDataFrame(rows, "id string, a double, b double")
    found = sorted((r["n"], round(r["a_mean"], 3), round(r["b_median"], 3)) for r in mv.cluster_profiles(mv.kmeans_rows(table, ["a", "b"], 3, ["id"]), ["a", "b"]).collect())
    assert found == sorted([(10, 0.1, 0.1), (10, 0.91, 0.11), (10, 0.52, 0.92)])


def test_deviance_density(spark):
    """The density of chi-squared with 15 degrees of freedom is (integrated) its tail."""
    x = np.linspace(1e-6, 80, 4001)
    table = spark.createDataFrame([(float(v),) for v in x], "g2 double")
    density = np.array([r[0] for r in table.select(ts.deviance_density(table["g2"])).collect()])
    assert math.isclose(np.trapezoid(density, x), 1, rel_tol=1e-4)
    assert math.isclose(np.trapezoid(density[x >= 20], x[x >= 20]), float(special.chi2_upper(np.array([20.0]), np.array([15]))[0]), rel_tol=1e-2)


def test_reads_alike_meet_their_window_as_one_row(spark):
    """Below the join of a window's patterns with its positions reads are counted by their calls; before, every read went through it."""
    from cytolake.operators import patterns as pt

    calls = spark.range(900).selectExpr("id as read_id", "'c' as ref", "explode(array(10L, 30L + id % 2 * 20)) as pos", "cast(id % 3 = 0 as int) as meth")
    found = pt.read_patterns(calls, 200)
    assert re.search(r"Aggregate \[ref#\d+, w_start#\d+L, marks#\d+\]", found._jdf.queryExecution().analyzed().toString())
    assert {(r["pattern"], r["n"]) for r in found.collect()} == {("00-", 300), ("0-0", 300), ("11-", 150), ("1-1", 150)}
