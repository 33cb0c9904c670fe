"""Queries on windows, intervals and nearest features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import intervals as iv
from ..operators import matrix as mx
from ..operators import sites as st
from ..plans.fixtures import SAMPLES, features, sites
from .registry import query, r6
from .sites import MEMBERS_SQL, PCT, membership

#: Sites in windows of 1000 stepping 500, as SQL.
SPREAD = """(SELECT *, unnest(generate_series(greatest(0, cast(trunc((start_pos - 500) / 500.0) as bigint)), cast(trunc((end_pos - 2) / 500.0) as bigint))) AS p FROM sites WHERE cov >= 5)"""
WINDOWS = f"SELECT sample, ref, p * 500 AS w_start, p * 500 + 1000 AS w_end, count(*) AS n_cpg, cast(sum(m) as bigint) AS m, cast(sum(cov) as bigint) AS cov, avg({PCT}) AS mean_pct, stddev_pop({PCT}) AS sd_pct FROM {SPREAD} GROUP BY 1, 2, 3, 4"
ROUNDED = "sample, ref, w_start, w_end, n_cpg, m, cov, round(mean_pct, 6) AS mean_pct, round(sd_pct, 6) AS sd_pct"


def windows(spark, sf):
    return iv.genome_windows(st.filter_sites(sites(spark, sf), 5), 1000, 500)


@query("w1_a7_genome_windows", f"SELECT {ROUNDED} FROM ({WINDOWS})")
def w1(spark, sf):
    return windows(spark, sf).withColumns({"mean_pct": r6("mean_pct"), "sd_pct": r6("sd_pct")})


@query("w1_gapped_grid", "SELECT ref, p * 700 AS w_start, count(*) AS n FROM (SELECT *, unnest(CASE WHEN trunc((end_pos - 2) / 700.0) >= greatest(0, trunc((start_pos + 700 - 300) / 700.0)) THEN generate_series(cast(greatest(0, trunc((start_pos + 700 - 300) / 700.0)) as bigint), cast(trunc((end_pos - 2) / 700.0) as bigint)) ELSE [] END) AS p FROM sites) GROUP BY 1, 2")
def w1_gap(spark, sf):
    return iv.sliding_windows(sites(spark, sf), 300, 700).groupBy("ref", "w_start").agg(F.count("*").alias("n"))


@query("f7_min_cpgs", f"WITH w AS ({WINDOWS}) SELECT {ROUNDED} FROM w WHERE (ref, w_start) IN (SELECT ref, w_start FROM w GROUP BY 1, 2 HAVING count(DISTINCT sample) = 6 AND min(n_cpg) >= 3)")
def f7(spark, sf):
    return mx.min_cpgs(windows(spark, sf), 3, 6).withColumns({"mean_pct": r6("mean_pct"), "sd_pct": r6("sd_pct")})


@query("a5_group_windows", f"WITH w AS ({WINDOWS}) SELECT ref, w_start, w_end, mem.grp AS grp, max(n_cpg) AS n_cpg, cast(sum(m) as bigint) AS m, cast(sum(cov) as bigint) AS cov, round(avg(mean_pct), 6) AS mean_pct, round(avg(sd_pct), 6) AS sd_pct FROM w JOIN {MEMBERS_SQL} ON w.sample = mem.sample GROUP BY 1, 2, 3, 4")
def a5(spark, sf):
    return st.group_windows(windows(spark, sf), membership(spark)).withColumns({"mean_pct": r6("mean_pct"), "sd_pct": r6("sd_pct")})


@query("j3_window_matrix", f"WITH w AS ({WINDOWS}) SELECT ref, w_start, w_end, " + ", ".join(f"max(CASE WHEN sample = '{s}' THEN n_cpg END) AS {s}_n_cpg, max(CASE WHEN sample = '{s}' THEN cov END) AS {s}_cov" for s in SAMPLES) + " FROM w GROUP BY 1, 2, 3")
def j3w(spark, sf):
    return mx.outer_matrix(windows(spark, sf), SAMPLES, ["n_cpg", "cov"], ("ref", "w_start", "w_end"))


HELD = "sites s JOIN features f ON s.ref = f.ref AND s.start_pos >= f.f_start AND s.start_pos <= f.f_end"


@query("j6_point_in_interval", f"SELECT s.sample, s.ref, s.start_pos, s.cov, f.feature_id, f.f_start, f.f_end, f.strand FROM {HELD}")
def j6(spark, sf):
    return iv.interval_join(sites(spark, sf), features(spark, sf)).select("sample", "ref", "start_pos", "cov", "feature_id", "f_start", "f_end", "strand")


@query("a7_feature_summary", f"SELECT s.sample, f.feature_id, count(*) AS n_cpg, cast(sum(s.m) as bigint) AS m, cast(sum(s.cov) as bigint) AS cov, round(avg(cast(s.m as double) / s.cov), 6) AS mean_pct, round(stddev_pop(cast(s.m as double) / s.cov), 6) AS sd_pct FROM {HELD} WHERE s.cov > 0 GROUP BY 1, 2")
def a7(spark, sf):
    held = iv.interval_join(sites(spark, sf).filter("cov > 0"), features(spark, sf))
    return iv.window_summary(held, ["sample", "feature_id"]).withColumns({"mean_pct": r6("mean_pct"), "sd_pct": r6("sd_pct")})


@query("w2_v10_feature_windows", """
    SELECT feature_id, ref, l + i * 200 AS f_start, l + i * 200 + 200 AS f_end, strand FROM (
        SELECT *, unnest(CASE WHEN ceil((r - l - 100) / 200.0) >= 1 THEN generate_series(0, cast(ceil((r - l - 100) / 200.0) as bigint) - 1) ELSE [] END) AS i
        FROM (SELECT *, CASE WHEN strand <> '-' THEN f_start - 200 - 800 ELSE f_end END AS l, CASE WHEN strand <> '-' THEN f_start ELSE f_end + 1000 END AS r FROM features))""")
def w2(spark, sf):
    return iv.feature_windows(features(spark, sf), 200, 200, "up", 1000).select("feature_id", "ref", "f_start", "f_end", "strand")


POINTS = "(SELECT DISTINCT ref, start_pos + 7000 AS start_pos, end_pos + 7000 AS end_pos FROM sites)"
DIST = "CASE WHEN start_pos < f_end AND f_start < end_pos THEN 0 WHEN f_end <= start_pos THEN start_pos - f_end + 1 ELSE end_pos - f_start - 1 END"

#: Points beyond the features as well, so both sides and far distances occur.
FAR = f"(SELECT * FROM {POINTS} UNION SELECT ref, start_pos + 400000, end_pos + 400000 FROM {POINTS} UNION SELECT ref, start_pos - 900000, end_pos - 900000 FROM {POINTS})"


def far(spark, sf):
    p = sites(spark, sf).select("ref", "start_pos", "end_pos").distinct()
    shifts = F.explode(F.array(*[F.lit(x).cast("long") for x in (7000, 407000, -893000)]))
    moved = p.withColumn("by", shifts).select("ref", (F.col("start_pos") + F.col("by")).alias("start_pos"), (F.col("end_pos") + F.col("by")).alias("end_pos"))
    return moved.distinct()


@query("j7_nearest_feature", f"SELECT ref, start_pos, feature_id, cast(dist as bigint) AS dist FROM (SELECT q.ref, start_pos, feature_id, {DIST} AS dist, min(abs({DIST})) OVER (PARTITION BY q.ref, start_pos, end_pos) AS least FROM {FAR} q JOIN features f ON q.ref = f.ref) WHERE abs(dist) = least OR abs(dist) <= 50")
def j7(spark, sf):
    return iv.nearest_join(far(spark, sf), features(spark, sf), 50).select("ref", "start_pos", "feature_id", "dist")


@query("j8_nearest_by_strand", f"SELECT ref, start_pos, strand, feature_id, cast(dist as bigint) AS dist FROM (SELECT q.ref, start_pos, strand, feature_id, {DIST} AS dist, min(abs({DIST})) OVER (PARTITION BY q.ref, start_pos, end_pos, strand) AS least FROM {FAR} q JOIN features f ON q.ref = f.ref) WHERE abs(dist) = least")
def j8(spark, sf):
    return iv.nearest_join(far(spark, sf), features(spark, sf), 0, stranded=True).select("ref", "start_pos", "strand", "feature_id", "dist")


@query("j12_target_sites", "SELECT s.sample, s.ref, s.start_pos, s.m, s.cov, f.feature_id AS target, s.start_pos - f.f_start AS place FROM sites s JOIN features f ON s.ref = f.ref AND s.start_pos >= f.f_start AND s.start_pos < f.f_end WHERE f.kind = 'ECONOMY'")
def j12(spark, sf):
    held = iv.interval_join(sites(spark, sf), features(spark, sf).filter("kind = 'ECONOMY'"), inclusive=False)
    return held.select("sample", "ref", "start_pos", "m", "cov", F.col("feature_id").alias("target"), (F.col("start_pos") - F.col("f_start")).alias("place"))


@query("a12_depth_islands", """
    WITH e AS (SELECT ref, place, sum(step) AS step FROM (SELECT ref, f_start AS place, 1 AS step FROM features UNION ALL SELECT ref, f_end, -1 FROM features) GROUP BY 1, 2 HAVING sum(step) <> 0)
    SELECT ref, start_pos, end_pos, depth FROM (SELECT ref, place AS start_pos, lead(place) OVER w AS end_pos, cast(sum(step) OVER w as bigint) AS depth FROM e WINDOW w AS (PARTITION BY ref ORDER BY place)) WHERE depth > 0""")
def a12(spark, sf):
    return iv.depth_islands(features(spark, sf).select("ref", F.col("f_start").alias("start_pos"), F.col("f_end").alias("end_pos")))


@query("w5_site_islands", """
    SELECT ref, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS n_sites FROM (
        SELECT *, sum(brk) OVER (PARTITION BY ref ORDER BY start_pos) AS island FROM (
            SELECT DISTINCT ref, start_pos, end_pos, 0 AS z, CASE WHEN start_pos - lag(start_pos) OVER (PARTITION BY ref ORDER BY start_pos) > 250 THEN 1 ELSE 0 END AS brk FROM (SELECT DISTINCT ref, start_pos, end_pos FROM sites)))
    GROUP BY ref, island""")
def w5(spark, sf):
    return iv.site_islands(sites(spark, sf), 250)
