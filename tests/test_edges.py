"""Values on a cut, zeros and other odd ends of the tests between groups, against their SQL."""

from math import comb

import duckdb
import numpy as np
import pandas as pd
from oracle import difference
from pyspark.sql import functions as F

from cytolake.operators import annotation as an
from cytolake.operators import matrix as mx
from cytolake.operators import multivariate as mv
from cytolake.operators import patterns as pt
from cytolake.operators import stats as ts
from cytolake.plans import fixtures
from cytolake.queries import relational_queries, relational_sql, statistics


def tables(spark, tmp_path, rows):
    """lineitem of rows (sample, partkey, suppkey, quantity, discount): a folder and a connection that have it."""
    lines = [(k, int(p), int(s), 1, float(q), 1.0, float(d), 0.0, sample[0].upper(), sample[1].upper()) for k, (sample, p, s, q, d) in enumerate(rows)]
    names = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    spark.createDataFrame(lines, names).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{tmp_path}/lineitem.parquet/*.parquet'")
    return str(tmp_path), con


def test_pairs_that_differ_by_nothing_on_average(spark, tmp_path):
    """Differences 0.2 and -0.2: t is 0, and dividing by it stopped the query."""
    rows = [("af", 1, 1, 10, 0.04), ("ao", 1, 1, 10, 0.02), ("nf", 1, 1, 10, 0.02), ("no", 1, 1, 10, 0.04), ("af", 2, 1, 10, 0.08), ("ao", 2, 1, 10, 0.02), ("nf", 2, 1, 10, 0.03), ("no", 2, 1, 10, 0.02)]
    folder, con = tables(spark, tmp_path, rows)
    assert not difference(relational_queries()["t1_paired"](spark, folder), con, relational_sql()["t1_paired"])


def test_p_on_the_cut_falls_as_in_sql(spark, tmp_path):
    """The p of these tables is 1/20, so which side of 0.05 it falls on depends on how it is added up."""
    cases = [(0, 12, 2, 2), (2, 2, 12, 0), (19, 0, 4, 2), (2, 2, 0, 12)]
    fresh = spark.createDataFrame([("chr1", i, i + 2, s, g, m, m + u) for i, (a, b, c, d) in enumerate(cases) for s, g, m, u in (("af", "F", a, b), ("ao", "O", c, d))], "ref string, start_pos long, end_pos long, sample string, grp string, m long, cov long")
    table = fresh.toPandas()
    con = duckdb.connect()
    con.register("given", table)
    sql = relational_sql()["g3_volcano_counts"]
    inner = fixtures.TEXTS["sites"].format(lineitem="lineitem")
    expected = con.execute(sql.replace(inner, "SELECT * FROM given")).fetchone()
    found = ts.volcano(ts.fisher_pairs(fresh, "F", "O").withColumn("q", F.col("p")), 0.25, 0.05).first()
    assert tuple(found) == expected


def test_p_of_large_tables_is_exact():
    """Weights of tables with thousands of reads are beyond what a number holds."""
    a, b, c, d = 1500, 1400, 1200, 1500
    n, k, whole = a + b, a + c, a + b + c + d
    ways = [comb(n, i) * comb(c + d, k - i) for i in range(max(0, k - c - d), min(n, k) + 1)]
    own = comb(n, a) * comb(c + d, k - a)
    exact = sum(w for w in ways if w <= own) / comb(whole, k)
    assert np.allclose(ts.two_sided_fisher(*(np.array([x]) for x in (a, b, c, d))), [exact], rtol=1e-7)


def test_contingency_by_hand_without_sorting_cells(spark):
    """Cells of a key meet in one aggregate; before, three windows and a distinct count each held a sorted copy of all cells in a task."""
    cells = [("a", "x", "m", 3), ("a", "x", "u", 7), ("a", "y", "m", 6), ("a", "y", "u", 4), ("b", "x", "m", 0), ("b", "x", "u", 0), ("c", "x", "m", 5), ("c", "y", "u", None), ("c", "y", "m", 2)]
    table = spark.createDataFrame(cells, "key string, sample string, kind string, n long").repartition(3)
    out = ts.contingency(table, ["key"], "sample", "kind", with_p=False)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    found = {r["key"]: r for r in out.collect()}
    g2 = 2 * sum(o * np.log(o / e) for o, e in ((3, 4.5), (7, 5.5), (6, 4.5), (4, 5.5)))
    assert np.isclose(found["a"]["chi2"], 2 * 1.5**2 / 4.5 + 2 * 1.5**2 / 5.5) and np.isclose(found["a"]["g2"], g2) and found["a"]["df"] == 1
    assert found["b"]["chi2"] is None and found["b"]["g2"] == 0 and found["b"]["df"] == 0
    assert np.isclose(found["c"]["chi2"], 0) and found["c"]["df"] == 1


def test_figures_on_the_edge_of_six_places(spark):
    """1e-5 by the JVM's pow is 1.0000000000000001e-5, so a ratio on the edge of two roundings differed from SQL's."""
    values = [k * 5e-7 * 10.0**e for e in (-2, -1, 0, 1, 3, 9, 15) for k in range(21, 200, 2)] + [9.98555e-05, 9.9693e-05]
    found = [r["y"] for r in spark.createDataFrame([(i, x) for i, x in enumerate(values)], "i long, x double").withColumn("y", statistics.signif(F.col("x"))).orderBy("i").collect()]
    con = duckdb.connect()
    con.register("given", pd.DataFrame({"i": range(len(values)), "x": values}))
    expected = [y for (y,) in con.execute(f"SELECT {statistics.signif_sql('x')} FROM given ORDER BY i").fetchall()]
    assert found == expected


def counted(spark, frame, column):
    """frame with `column` through a function, and the number of rows that went through it so far."""
    seen = spark.sparkContext.accumulator(0)

    def same(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return frame.mapInArrow(same, frame.schema), seen


def test_adjusting_makes_each_test_once(spark):
    """Bounds, counts and the join each made all tests anew."""
    rows = [(i, i % 3, (i * 37 % 101) / 101 if i % 10 else None) for i in range(300)]
    tests, seen = counted(spark, spark.createDataFrame(rows, "i long, family int, p double"), "p")
    found = {r["i"]: r["q"] for r in ts.bh_adjust(tests, missing="skip", by=("family",)).collect()}
    assert seen.value == len(rows)
    for family in range(3):
        own = sorted((p, i) for i, f, p in rows if f == family and p is not None)
        least = 1.0
        for k in range(len(own), 0, -1):
            last = max(j for j, (p, _) in enumerate(own, 1) if p == own[k - 1][0])
            least = min(least, own[k - 1][0] * len(own) / last)
            assert np.isclose(found[own[k - 1][1]], least)
    assert all(found[i] is None for i, _, p in rows if p is None)


def test_analysis_of_variance_reads_its_rows_once(spark):
    """Keys, groups, pairs and the test as a whole each read all rows anew; keys without a test or a pair keep a row."""
    values = [(i, g, float((i * 7 + k * k * 5 + ord(g)) % 11)) for i in range(20) for g in "abc" for k in range(3)] + [(20, "a", 1.0), (20, "b", 2.0), (21, "a", 1.0), (22, "a", 1.0), (22, "a", 1.0), (22, "b", 3.0), (23, "c", None)]
    rows, seen = counted(spark, spark.createDataFrame(values, "site long, grp string, pct double"), "pct")
    found = ts.anova_report(rows, keys=("site",)).collect()
    assert seen.value == len(values)
    assert {r["site"] for r in found} == set(range(23)) and sum(r["site"] < 20 for r in found) == 60
    for r in found:
        if r["site"] >= 20:
            assert r["f"] is None and r["p"] == 1 and r["g1"] is None and r["pair_p"] is None
            continue
        sets = {g: np.array([v for i, h, v in values if i == r["site"] and h == g]) for g in "abc"}
        whole = np.concatenate(list(sets.values()))
        within = sum(((x - x.mean()) ** 2).sum() for x in sets.values())
        between = sum(len(x) * (x.mean() - whole.mean()) ** 2 for x in sets.values())
        assert np.isclose(r["f"], between / 2 / (within / 6)) and np.isclose(r["pair_diff"], sets[r["g2"]].mean() - sets[r["g1"]].mean(), atol=1e-12) and 0 <= r["pair_p"] <= 1


def test_medoids_read_their_rows_once(spark):
    """Every step of the search made the whole table anew."""
    rows, seen = counted(spark, spark.createDataFrame([(f"r{i}", i * 7 % 40 / 40, i * 11 % 40 / 40) for i in range(40)], "id string, a double, b double"), "a")
    assert mv.medoids(rows, ["a", "b"], 3).count() == 40 and seen.value == 40


def test_kmeans_reads_its_rows_once(spark):
    """Fitting and assigning each made the whole table anew."""
    rows, seen = counted(spark, spark.createDataFrame([(f"r{i}", i % 2 + i * 7 % 40 / 400, i * 11 % 40 / 400) for i in range(40)], "id string, a double, b double"), "a")
    assert [r["n"] for r in mv.cluster_profiles(mv.kmeans_rows(rows, ["a", "b"], 2, ["id"]), ["a", "b"]).collect()] == [20, 20] and seen.value == 40


def test_group_fraction_brings_rows_together_once(spark):
    """Keys were counted apart and joined with all rows again; a group without samples asks for one, others don't count."""
    rows = [("chr1", p, s, g, c) for p, have in enumerate(["af nf ao no", "af ao no", "af nf rf ao", "af nf ao no x", "af nf ao0 no0", "x"]) for s in have.split() for g, c in [("X" if s == "x" else s[1].upper(), 0 if s.endswith("0") else 5)]]
    table = spark.createDataFrame(rows, "ref string, start_pos long, sample string, grp string, cov long")
    out = mx.group_fraction(table, spark.createDataFrame([("F", 3), ("O", 3)], "grp string, size int"), 0.6)
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    assert sorted((r["start_pos"], r["sample"]) for r in out.collect()) == sorted((p, s) for _, p, s, _, _ in rows if p in (0, 3)) and out.columns == table.columns


def test_class_statistics_bring_a_site_together_once(spark):
    """Sites were counted apart and joined with all hits again, and counted once more by class."""
    rows = [(1, 7, "body"), (1, 7, "upstream"), (1, 8, "body"), (2, 7, "body"), (3, 9, "upstream"), (3, 9, "upstream")]
    out = an.class_statistics(spark.createDataFrame(rows, "site long, feature_id long, label string"), ["site"])
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = {r["label"]: (r["n"], r["weight"], r["n_sites"]) for r in out.collect()}
    assert found == {"body": (3, 2.0, 2), "upstream": (3, 2.5, 2)}


def test_gene_labels_make_their_hits_once(spark):
    """Labels of exons were made from all hits again and compared as whole rows."""
    kinds = "start_pos long, end_pos long, f_start long, f_end long, strand string, exons array<struct<s: long, e: long>>, cds_start long, cds_end long"
    model = (1000, 1300, "+", [(1000, 1100), (1200, 1300)], 1050, 1250)
    rows = [(p, p + 2, *model) for p in (1049, 1150, 1299, 2000)] + [(1010, 1012, 1000, 1300, "-", [], None, None), (1010, 1012, 1000, 1300, "-", [(1000, 1300)], None, None)]
    hits, seen = counted(spark, spark.createDataFrame(rows, kinds), "start_pos")
    out = an.gene_labels(hits, 300, 100)
    assert "Aggregate" not in out._jdf.queryExecution().optimizedPlan().toString()
    found = {}
    for r in out.collect():
        found.setdefault((r["start_pos"], r["strand"], len(r["exons"])), []).append(r["label"])
    assert seen.value == len(rows)
    assert {k: sorted(v) for k, v in found.items()} == {(1049, "+", 2): ["5UTR", "CDS", "exon"], (1150, "+", 2): ["intron"], (1299, "+", 2): ["3UTR", "downstream", "exon"], (2000, "+", 2): ["fardown"], (1010, "-", 0): ["body"], (1010, "-", 1): ["exon"]}


def test_regions_read_their_tests_once(spark):
    """The blocks of a reference, their last sites and the join each made the smoothed tests anew."""
    rows, seen = counted(spark, spark.createDataFrame([("chr1", i * 100, 2.0 if i % 10 < 6 else -2.0, 0.3 if i % 10 < 6 else -0.3) for i in range(20)], "ref string, start_pos long, t double, diff double"), "t")
    found = sorted((r["start_pos"], r["direction"], r["n_sites"]) for r in pt.differing_regions(rows, 1.0, 300, 2, 0.1).collect())
    assert seen.value == 20 and found == [(0, "up", 6), (600, "down", 4), (1000, "up", 6), (1600, "down", 4)]
