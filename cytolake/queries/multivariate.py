"""Queries on samples as columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as mx
from ..operators import multivariate as mv
from ..operators import sites as st
from ..plans.fixtures import SAMPLES, sites
from .registry import query, r6
from .sites import PCT

COLUMNS = [f"{s}_pct" for s in SAMPLES]
WIDE = "wide AS (SELECT ref, start_pos, " + ", ".join(f"max(CASE WHEN sample = '{s}' THEN {PCT} END) AS {s}_pct" for s in SAMPLES) + " FROM sites GROUP BY 1, 2 HAVING count(DISTINCT sample) = 6)"


def wide(spark, sf):
    return mx.outer_matrix(sites(spark, sf).withColumn("pct", st.level()), SAMPLES, ["pct"], ("ref", "start_pos"), common=True)


def _corr(table: str) -> str:
    pairs = [(a, b) for i, a in enumerate(COLUMNS) for b in COLUMNS[i:]]
    return " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 5) AS r FROM {table}" for a, b in pairs)


@query("m1_g6_pearson", f"WITH {WIDE} {_corr('wide')}")
def m1(spark, sf):
    return mv.correlations(wide(spark, sf), COLUMNS).withColumn("r", F.round("r", 5))


RANKS = "ranks AS (SELECT " + ", ".join(f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in COLUMNS) + " FROM wide)"


@query("m1_w10_spearman", f"WITH {WIDE}, {RANKS} {_corr('ranks')}")
def m1s(spark, sf):
    return mv.correlations(mv.ranked(wide(spark, sf), COLUMNS, ["ref", "start_pos"]), COLUMNS).withColumn("r", F.round("r", 5))


@query("m2_g7_components")
def m2(spark, sf):
    return mv.principal_components(wide(spark, sf), COLUMNS)


@query("m3_sample_distances", f"WITH {WIDE} " + " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(sqrt(sum(pow({a} - {b}, 2))), 5) AS distance FROM wide" for i, a in enumerate(COLUMNS) for b in COLUMNS[i + 1 :]))
def m3(spark, sf):
    return mv.sample_distances(wide(spark, sf), COLUMNS).withColumn("distance", F.round("distance", 5))


@query("m3_g5_sample_clusters")
def m3c(spark, sf):
    return mv.cluster_samples(wide(spark, sf), COLUMNS, 5.0)


@query("m4_m6_g8_kmeans_profiles")
def m4(spark, sf):
    rows = mv.kmeans_rows(wide(spark, sf), COLUMNS, 4, ["ref", "start_pos"])
    return mv.cluster_profiles(rows, COLUMNS)


def named(spark, sf):
    return wide(spark, sf).withColumn("id", F.concat_ws(":", "ref", "start_pos"))


@query("m5_medoids")
def m5(spark, sf):
    return mv.medoids(named(spark, sf), COLUMNS, 4)


@query("m3_m7_row_order")
def m7(spark, sf):
    return mv.cluster_rows(named(spark, sf), COLUMNS, 500).select("id", "place")


@query("f11_row_spread", f"WITH {WIDE} SELECT ref, start_pos, round(greatest({', '.join(COLUMNS)}) - least({', '.join(COLUMNS)}), 6) AS spread FROM wide ORDER BY spread DESC, ref, start_pos LIMIT 500")
def f11(spark, sf):
    spread = F.round(F.greatest(*COLUMNS) - F.least(*COLUMNS), 6)
    return wide(spark, sf).select("ref", "start_pos", spread.alias("spread")).orderBy(F.desc("spread"), "ref", "start_pos").limit(500).withColumn("spread", r6("spread"))
