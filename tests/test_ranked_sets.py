"""Ranked sets with random draws against enumeration and a plain computation."""

import random
from itertools import combinations

import numpy as np
import pytest

from cytolake.operators import annotation as an

RNG = random.Random(3)
GENES = [(f"g{i}", float(RNG.randint(-20, 20))) for i in range(60)]
SETS = {f"s{k}": RNG.sample([g for g, _ in GENES], 3 + k % 4) for k in range(12)} | {"top": [g for g, _ in sorted(GENES, key=lambda x: (-x[1], x[0]))[:5]], "unknown": ["x", "y"], "one": ["g7"]}


def plain_score(at, score, total):
    chosen, best, run = set(at), 0.0, 0.0
    weight = sum(abs(score[i]) for i in at)
    hi, lo = -1e9, 1e9
    for i in range(1, total + 1):
        if i in chosen:
            lo = min(lo, run)
            run += abs(score[i]) / weight
            hi = max(hi, run)
        else:
            run -= 1 / (total - len(at))
    return hi if hi >= -lo - 1e-12 else lo


def plain(draws, seed, least, most):
    order = sorted(GENES, key=lambda x: (-x[1], x[0]))
    score, place, total = {i: s for i, (_, s) in enumerate(order, 1)}, {g: i for i, (g, _) in enumerate(order, 1)}, len(GENES)
    sets = {k: sorted(place[g] for g in genes if g in place) for k, genes in SETS.items()}
    sets = {k: at for k, at in sets.items() if least <= len(at) <= most}
    nulls = {n: [plain_score(an.drawn_ranks(seed, n, d, total).tolist(), score, total) for d in range(draws)] for n in {len(at) for at in sets.values()}}
    mean = lambda n, s: np.mean([abs(x) for x in nulls[n] if (x >= 0) == s])
    es = {k: plain_score(at, score, total) for k, at in sets.items()}
    nes = {k: e / mean(len(sets[k]), e >= 0) for k, e in es.items()}
    pool = [(x >= 0, abs(x) / mean(len(at), x >= 0)) for at in sets.values() for x in nulls[len(at)]]
    out = {}
    for k, e in es.items():
        same = [abs(x) for x in nulls[len(sets[k])] if (x >= 0) == (e >= 0)]
        far, far_all = [v for s, v in pool if s == (e >= 0)], [abs(v) for j, v in nes.items() if (es[j] >= 0) == (e >= 0)]
        share = lambda values: sum(v >= abs(nes[k]) - 1e-12 for v in values) / len(values)  # noqa: B023, E731
        out[k] = (len(sets[k]), e, nes[k], sum(x >= abs(e) - 1e-12 for x in same) / len(same), min(1.0, share(far) / share(far_all)))
    return out


@pytest.mark.parametrize("sent", [4_000_000, 0])
def test_draws_equal_a_plain_computation(spark, monkeypatch, sent):
    monkeypatch.setattr(an, "SENT_GENES", sent)
    ranked = spark.createDataFrame(GENES, "gene string, score double")
    sets = spark.createDataFrame([(k, g) for k, genes in SETS.items() for g in [*genes, genes[0]]], "set_name string, gene string")
    got = {r["set_name"]: tuple(r)[1:] for r in an.permuted_enrichment(ranked, sets, 120, 5, 2, 6).collect()}
    expected = plain(120, 5, 2, 6)
    assert got.keys() == expected.keys()
    for k, row in expected.items():
        assert got[k] == pytest.approx(row, abs=1e-9)


def test_draws_approach_enumeration():
    """Means and chances over all sets of 2 of 7."""
    weights = np.array([9.0, 5, 4, 2, 1, 3, 8])
    every = [an.drawn_score(np.array(at), weights[np.array(at) - 1], 7) for at in combinations(range(1, 8), 2)]
    drawn = [an.drawn_score(at, weights[at - 1], 7) for at in (an.drawn_ranks(1, 2, d, 7) for d in range(6000))]
    assert np.mean(drawn) == pytest.approx(np.mean(every), abs=0.03)
    assert np.mean([x >= 0.5 for x in drawn]) == pytest.approx(np.mean([x >= 0.5 for x in every]), abs=0.03)
    assert {round(x, 9) for x in drawn} == {round(x, 9) for x in every}


def test_no_sets(spark):
    ranked = spark.createDataFrame(GENES, "gene string, score double")
    assert an.permuted_enrichment(ranked, spark.createDataFrame([("a", "none")], "set_name string, gene string"), 10).count() == 0
