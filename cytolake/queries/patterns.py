"""Queries on read patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import patterns as pt
from ..operators import smoothing as sm
from ..plans.fixtures import calls, sites
from .registry import query, r6

#: Patterns of reads per window of 200, as SQL over `calls`.
PATTERNS = """
    wc AS (SELECT ref, (pos - 1) // 200 * 200 + 1 AS w_start, read_id, pos, max(meth) AS meth FROM calls WHERE pos >= 1 GROUP BY 1, 2, 3, 4),
    ps AS (SELECT ref, w_start, list_sort(list(DISTINCT pos)) AS positions FROM wc GROUP BY 1, 2),
    rp AS (SELECT wc.ref, wc.w_start, read_id, positions, array_to_string(list_transform(positions, lambda p: coalesce(cast(list_extract(map_extract(map_from_entries(list(struct_pack(k := pos, v := meth))), p), 1) as varchar), '-')), '') AS pattern
           FROM wc JOIN ps ON wc.ref = ps.ref AND wc.w_start = ps.w_start GROUP BY 1, 2, 3, 4),
    pat AS (SELECT ref, w_start, positions, pattern, count(*) AS n FROM rp GROUP BY 1, 2, 3, 4)"""


def patterns(spark, sf):
    return pt.read_patterns(calls(spark, sf), 200)


@query("w3_e2_read_patterns", f"WITH {PATTERNS} SELECT ref, w_start, len(positions) AS n_sites, pattern, n FROM pat")
def e2(spark, sf):
    return patterns(spark, sf).select("ref", "w_start", F.size("positions").cast("long").alias("n_sites"), "pattern", "n")


@query("e1_methylation_entropy", f"""
    WITH {PATTERNS}, t AS (SELECT *, sum(n) OVER (PARTITION BY ref, w_start) AS total FROM pat)
    SELECT ref, w_start, len(positions) AS n_sites, cast(max(total) as bigint) AS n_reads, count(*) AS n_patterns,
           round(-sum(n / total * ln(n / total)) / len(positions) / ln(2), 6) AS entropy,
           round(cast(sum(n * length(regexp_replace(pattern, '[^1]', '', 'g'))) as double) / sum(n * length(replace(pattern, '-', ''))), 6) AS mean_level
    FROM t WHERE len(positions) >= 3 AND total >= 10 GROUP BY 1, 2, 3, positions""")
def e1(spark, sf):
    out = pt.entropy(patterns(spark, sf), 3, 10)
    return out.select("ref", "w_start", F.col("n_sites").cast("long").alias("n_sites"), "n_reads", "n_patterns", r6("entropy"), r6("mean_level"))


#: The same over reads of two halves, and with states of two site types.
HALVES = "".join(f"""
    wc{h} AS (SELECT ref, (pos - 1) // 200 * 200 + 1 AS w_start, read_id, pos, max(meth) AS meth FROM calls WHERE pos >= 1 AND read_id % 80 {op} 40 GROUP BY 1, 2, 3, 4),
    ps{h} AS (SELECT ref, w_start, list_sort(list(DISTINCT pos)) AS positions FROM wc{h} GROUP BY 1, 2),
    tt{h} AS (SELECT ref, w_start, count(DISTINCT read_id) AS total FROM wc{h} GROUP BY 1, 2),""" for h, op in (("1", "<"), ("2", ">=")))
TYPED = """
    ty AS (SELECT ref, (pos - 1) // 200 * 200 + 1 AS w_start, read_id, pos, pos // 20 % 2 AS type, max(pos // 20 % 2 * 2 + meth) AS state FROM calls WHERE pos >= 1 GROUP BY 1, 2, 3, 4, 5),
    po AS (SELECT ref, w_start, list_sort(list(DISTINCT pos)) AS positions FROM ty GROUP BY 1, 2 HAVING count(DISTINCT type) = 2),
    rp AS (SELECT ty.ref, ty.w_start, read_id, positions, array_to_string(list_transform(positions, lambda p: coalesce(cast(list_extract(map_extract(map_from_entries(list(struct_pack(k := pos, v := state))), p), 1) as varchar), '-')), '') AS pattern
           FROM ty JOIN po ON ty.ref = po.ref AND ty.w_start = po.w_start GROUP BY 1, 2, 3, 4),
    pat AS (SELECT ref, w_start, positions, pattern, count(*) AS n FROM rp GROUP BY 1, 2, 3, 4), t AS (SELECT *, sum(n) OVER (PARTITION BY ref, w_start) AS total FROM pat)"""


@query("e3_e4_joint_entropy", f"WITH {TYPED} SELECT ref, w_start, cast(len(positions) as int) AS n_sites, cast(max(total) as bigint) AS n_reads, count(*) AS n_patterns, round(-sum(n / total * ln(n / total)) / len(positions) / ln(2), 6) AS entropy FROM t WHERE total >= 5 GROUP BY 1, 2, positions")
def e3(spark, sf):
    return pt.joint_entropy(calls(spark, sf).withColumn("type", (F.floor(F.col("pos") / 20) % 2).cast("int")), 200, 1, 5).withColumn("entropy", r6("entropy"))


def half(h: str) -> str:
    return f"""
    rp{h} AS (SELECT wc{h}.ref, wc{h}.w_start, read_id, array_to_string(list_transform(keep, lambda p: coalesce(cast(list_extract(map_extract(map_from_entries(list(struct_pack(k := pos, v := meth))), p), 1) as varchar), '-')), '') AS pattern
           FROM wc{h} JOIN kp ON wc{h}.ref = kp.ref AND wc{h}.w_start = kp.w_start GROUP BY wc{h}.ref, wc{h}.w_start, read_id, keep),
    pn{h} AS (SELECT ref, w_start, pattern, count(*) AS n FROM rp{h} WHERE pattern <> '' GROUP BY 1, 2, 3)"""


@query("e5_e6_relative_entropy", f"""
    WITH {HALVES} kp AS (SELECT ps1.ref, ps1.w_start, list_sort(list_intersect(ps1.positions, ps2.positions)) AS keep FROM ps1 JOIN ps2 ON ps1.ref = ps2.ref AND ps1.w_start = ps2.w_start), {half("1")}, {half("2")},
    b AS (SELECT pn1.ref, pn1.w_start, cast(pn1.n as double) AS na, cast(pn2.n as double) AS nb, tt1.total AS ta, tt2.total AS tb, sum(pn1.n) OVER w AS sa, sum(pn2.n) OVER w AS sb FROM pn1 JOIN pn2 ON pn1.ref = pn2.ref AND pn1.w_start = pn2.w_start AND pn1.pattern = pn2.pattern
          JOIN tt1 ON tt1.ref = pn1.ref AND tt1.w_start = pn1.w_start JOIN tt2 ON tt2.ref = pn1.ref AND tt2.w_start = pn1.w_start WINDOW w AS (PARTITION BY pn1.ref, pn1.w_start)),
    f AS (SELECT ref, w_start, count(*) AS n_common, sum(na / ta * ln(na / ta * tb / nb)) AS divergence, sum(pow(na - sa * (na + nb) / (sa + sb), 2) / (sa * (na + nb) / (sa + sb)) + pow(nb - sb * (na + nb) / (sa + sb), 2) / (sb * (na + nb) / (sa + sb))) AS chi2 FROM b GROUP BY 1, 2)
    SELECT kp.ref, kp.w_start, cast(len(keep) as int) AS n_sites, coalesce(n_common, 0) AS n_common, round(divergence, 6) AS divergence, round(chi2, 5) AS chi2 FROM kp LEFT JOIN f ON kp.ref = f.ref AND kp.w_start = f.w_start""")
def e5(spark, sf):
    c = calls(spark, sf)
    out = pt.relative_entropy(pt.read_patterns(c.filter("read_id % 80 < 40"), 200), pt.read_patterns(c.filter("read_id % 80 >= 40"), 200))
    return out.withColumns({"divergence": r6("divergence"), "chi2": F.round("chi2", 5)})


@query("w4_e7_spanning_intervals", """
    WITH e AS (SELECT ref, read_id, min(pos) AS lo, max(pos) AS hi FROM calls GROUP BY 1, 2), b AS (SELECT DISTINCT ref, lo FROM e), q AS (SELECT DISTINCT ref, hi FROM e)
    SELECT b.ref, b.lo AS start_pos, q.hi AS end_pos, count(*) AS n_reads FROM b JOIN q ON b.ref = q.ref AND b.lo < q.hi AND q.hi <= b.lo + 100 JOIN e ON e.ref = b.ref AND e.lo <= b.lo AND q.hi <= e.hi GROUP BY 1, 2, 3""")
def w4(spark, sf):
    return pt.spanning_intervals(calls(spark, sf), 100)


@query("e7_interval_patterns", """
    WITH marks AS (SELECT ref, read_id, pos, CASE WHEN baseq >= 5 THEN meth END AS state FROM calls),
    e AS (SELECT ref, read_id, min(pos) AS lo, max(pos) AS hi FROM marks GROUP BY 1, 2),
    places AS (SELECT ref, pos, avg(cast(state AS double)) AS level FROM marks GROUP BY 1, 2 HAVING count(state) >= 4),
    pairs AS (SELECT a.ref, lo AS p, hi AS q FROM (SELECT DISTINCT ref, lo FROM e) a JOIN (SELECT DISTINCT ref, hi FROM e) b ON a.ref = b.ref AND lo < hi AND hi <= lo + 100),
    held AS (SELECT i.ref, p, q, count(*) AS n_sites, avg(level) AS level FROM pairs i JOIN places s ON s.ref = i.ref AND pos BETWEEN p AND q GROUP BY 1, 2, 3 HAVING count(*) >= 3),
    spanning AS (SELECT h.ref, p, q, x.read_id FROM held h JOIN marks x ON x.ref = h.ref AND x.pos = p AND x.state IS NOT NULL JOIN marks y ON y.ref = h.ref AND y.read_id = x.read_id AND y.pos = q AND y.state IS NOT NULL),
    deep AS (SELECT ref, p, q FROM spanning GROUP BY 1, 2, 3 HAVING count(*) >= 4),
    cells AS (SELECT ref, p, q, s.read_id, l.pos, m.state FROM spanning s JOIN deep USING (ref, p, q) JOIN places l USING (ref) LEFT JOIN marks m USING (ref, read_id, pos) WHERE l.pos BETWEEN p AND q),
    turned AS (SELECT ref, p, q, count(*) FILTER (k > 1) AS n_changed FROM (SELECT ref, p, q, pos, count(DISTINCT state) AS k FROM cells GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
    texts AS (SELECT ref, p, q, read_id, string_agg(coalesce(cast(state AS varchar), '-'), '' ORDER BY pos) AS pattern FROM cells GROUP BY 1, 2, 3, 4 HAVING count(state) >= 3),
    found AS (SELECT ref, p, q, pattern, count(*) AS n FROM texts GROUP BY 1, 2, 3, 4)
    SELECT ref, p AS start_pos, q AS end_pos, n_sites, round(level, 6) AS level, cast(sum(n) AS bigint) AS n_reads, cast(count(*) AS integer) AS n_patterns, cast(n_changed AS integer) AS n_changed, string_agg(pattern || '=' || n, ':' ORDER BY pattern) AS patterns
    FROM found JOIN turned USING (ref, p, q) JOIN held USING (ref, p, q) GROUP BY ref, p, q, n_sites, level, n_changed""")
def e7(spark, sf):
    return pt.interval_patterns(calls(spark, sf), 100, min_sites=3, quality=5).withColumn("level", r6("level"))


@query("a9_read_levels", "SELECT read_id, ref, min(pos) AS start_pos, max(pos) AS end_pos, count(*) AS n_sites, cast(sum(meth) as bigint) AS m, round(cast(sum(meth) as double) / count(*), 6) AS level FROM calls GROUP BY 1, 2")
def a9(spark, sf):
    return pt.read_levels(calls(spark, sf)).withColumn("level", r6("level"))


@query("a10_calls_per_read", "SELECT read_id, ref, pos, meth, baseq FROM calls")
def a10(spark, sf):
    return calls(spark, sf)


@query("a11_read_states", """
    WITH l AS (SELECT read_id, ref, min(pos) AS s, cast(sum(meth) as double) / count(*) AS v FROM calls GROUP BY 1, 2),
    c AS (SELECT ref, (s - 1) // 500 * 500 + 1 AS w_start, CASE WHEN v < 0.2 THEN 'L' WHEN v > 0.8 THEN 'H' ELSE 'M' END AS state, count(*) AS n FROM l WHERE s >= 1 GROUP BY 1, 2, 3),
    t AS (SELECT *, sum(n) OVER (PARTITION BY ref, w_start) AS total FROM c)
    SELECT ref, w_start, cast(max(total) as bigint) AS n_reads, count(*) AS n_states, round(-sum(n / total * ln(n / total)), 6) AS entropy,
           cast(coalesce(sum(CASE WHEN state = 'L' THEN n END), 0) as bigint) AS n_l, cast(coalesce(sum(CASE WHEN state = 'M' THEN n END), 0) as bigint) AS n_m, cast(coalesce(sum(CASE WHEN state = 'H' THEN n END), 0) as bigint) AS n_h
    FROM t GROUP BY 1, 2""")
def a11(spark, sf):
    return pt.read_states(pt.read_levels(calls(spark, sf)), 500).withColumn("entropy", r6("entropy"))


@query("a11_nine_states", """
    WITH l AS (SELECT read_id, ref, min(pos) AS s, max(pos) + 1 AS e, cast(sum(meth) as double) / count(*) AS level, avg(CASE WHEN baseq >= 25 THEN 1.0 ELSE 0.0 END) AS op FROM calls GROUP BY 1, 2),
    w AS (SELECT ref, unnest(CASE WHEN trunc((e - 2) / 250.0) >= greatest(0, trunc((s + 250 - 500) / 250.0)) THEN generate_series(cast(greatest(0, trunc((s + 250 - 500) / 250.0)) as bigint), cast(trunc((e - 2) / 250.0) as bigint)) ELSE [] END) * 250 + 1 AS w_start,
                 CASE WHEN 1 - op < 0.2 THEN 'O' WHEN 1 - op > 0.8 THEN 'C' ELSE 'M' END || CASE WHEN level < 0.2 THEN 'L' WHEN level > 0.8 THEN 'H' ELSE 'M' END AS state FROM l),
    c AS (SELECT ref, w_start, state, count(*) AS n FROM w GROUP BY 1, 2, 3), t AS (SELECT *, sum(n) OVER (PARTITION BY ref, w_start) AS total FROM c)
    SELECT ref, w_start, cast(max(total) as bigint) AS n_reads, count(*) AS n_states, round(-sum(n / total * ln(n / total)), 6) AS entropy, """ + ", ".join(f"cast(coalesce(sum(CASE WHEN state = '{a}{b}' THEN n END), 0) as bigint) AS n_{a}{b}" for a in "OMC" for b in "LMH") + " FROM t GROUP BY 1, 2")
def a11_nine(spark, sf):
    rows = calls(spark, sf).groupBy("read_id", "ref").agg(F.min("pos").alias("start_pos"), (F.max("pos") + 1).alias("end_pos"), (F.sum("meth") / F.count("*")).alias("level"), F.avg((F.col("baseq") >= 25).cast("double")).alias("open"))
    return pt.read_state_windows(rows, 500, 250).withColumn("entropy", r6("entropy"))


@query("u3_u4_zero_filled", f"""
    WITH {HALVES} {"".join(f"rq{h} AS (SELECT wc{h}.ref, wc{h}.w_start, read_id, array_to_string(list_transform(positions, lambda p: coalesce(cast(list_extract(map_extract(map_from_entries(list(struct_pack(k := pos, v := meth))), p), 1) as varchar), '-')), '') AS pattern FROM wc{h} JOIN ps{h} ON wc{h}.ref = ps{h}.ref AND wc{h}.w_start = ps{h}.w_start GROUP BY wc{h}.ref, wc{h}.w_start, read_id, positions), pn{h} AS (SELECT ref, w_start, pattern, count(*) AS n FROM rq{h} GROUP BY 1, 2, 3), " for h in "12")}
    s AS (SELECT DISTINCT pn1.ref, pn1.w_start FROM pn1 JOIN pn2 ON pn1.ref = pn2.ref AND pn1.w_start = pn2.w_start)
    SELECT ref, w_start, pattern, coalesce(pn1.n, 0) AS n1, coalesce(pn2.n, 0) AS n2 FROM pn1 FULL JOIN pn2 USING (ref, w_start, pattern) JOIN s USING (ref, w_start)""")
def u4(spark, sf):
    c = calls(spark, sf)
    return pt.zero_filled(pt.read_patterns(c.filter("read_id % 80 < 40"), 200), pt.read_patterns(c.filter("read_id % 80 >= 40"), 200))


@query("e8_clones")
def e8(spark, sf):
    return pt.clones(patterns(spark, sf))


@query("e8_dynamic_clones")
def e8_dynamic(spark, sf):
    return pt.clones(patterns(spark, sf), None)


@query("m8_smoothed_levels", """
    SELECT a.sample, a.ref, a.start_pos, round(sum(pow(1 - pow(abs(b.start_pos - a.start_pos) / 1000.0, 3), 3) * b.m) / sum(pow(1 - pow(abs(b.start_pos - a.start_pos) / 1000.0, 3), 3) * b.cov), 6) AS smoothed, count(*) AS n_near
    FROM sites a JOIN sites b ON a.sample = b.sample AND a.ref = b.ref AND abs(b.start_pos - a.start_pos) < 1000 WHERE a.cov > 0 GROUP BY 1, 2, 3""")
def m8(spark, sf):
    return pt.smooth(sites(spark, sf), 1000).withColumn("smoothed", r6("smoothed"))


SMOOTHED = """sm AS (SELECT a.sample, a.ref, a.start_pos, sum(pow(1 - pow(abs(b.start_pos - a.start_pos) / 1000.0, 3), 3) * b.m) / sum(pow(1 - pow(abs(b.start_pos - a.start_pos) / 1000.0, 3), 3) * b.cov) AS v
        FROM sites a JOIN sites b ON a.sample = b.sample AND a.ref = b.ref AND abs(b.start_pos - a.start_pos) < 1000 WHERE a.cov > 0 GROUP BY 1, 2, 3),
    g AS (SELECT ref, start_pos, avg(CASE WHEN sample LIKE '%f' THEN v END) AS m1, avg(CASE WHEN sample LIKE '%o' THEN v END) AS m2, var_samp(CASE WHEN sample LIKE '%f' THEN v END) AS v1, var_samp(CASE WHEN sample LIKE '%o' THEN v END) AS v2 FROM sm GROUP BY 1, 2 HAVING count(*) = 6),
    tt AS (SELECT ref, start_pos, m1 - m2 AS diff, (m1 - m2) / sqrt((2 * v1 + 2 * v2) / 4 * (1 / 3.0 + 1 / 3.0)) AS t FROM g)"""


def tested(spark, sf):
    return pt.smoothed_t(sites(spark, sf), ["af", "nf", "rf"], ["ao", "no", "ro"], 1000)


@query("m8_smoothed_t", f"WITH {SMOOTHED} SELECT ref, start_pos, round(diff, 6) AS diff, round(t, 4) AS t FROM tt")
def m8t(spark, sf):
    return tested(spark, sf).select("ref", "start_pos", r6("diff"), F.round("t", 4).alias("t"))


@query("m8_g15_regions", f"""
    WITH {SMOOTHED}, d AS (SELECT *, CASE WHEN t >= 1.5 THEN 'up' WHEN t <= -1.5 THEN 'down' ELSE 'none' END AS direction FROM tt WHERE t IS NOT NULL),
    n AS (SELECT *, CASE WHEN start_pos - lag(start_pos) OVER w > 2000 OR direction <> lag(direction) OVER w THEN 1 ELSE 0 END AS brk FROM d WINDOW w AS (PARTITION BY ref ORDER BY start_pos)),
    r AS (SELECT *, sum(brk) OVER (PARTITION BY ref ORDER BY start_pos) AS run FROM n)
    SELECT ref, direction, min(start_pos) AS start_pos, max(start_pos) AS end_pos, count(*) AS n_sites, round(avg(diff), 5) AS mean_diff, round(sum(t), 3) AS area_t FROM r WHERE direction <> 'none' GROUP BY ref, run, direction HAVING count(*) >= 2 AND abs(avg(diff)) >= 0.05""")
def m8r(spark, sf):
    out = pt.differing_regions(tested(spark, sf), 1.5, 2000, 2, 0.05)
    return out.withColumns({"mean_diff": F.round("mean_diff", 5), "area_t": F.round("area_t", 3)})


F_SIDE, O_SIDE = ["af", "nf", "rf"], ["ao", "no", "ro"]


@query("m8_local_levels")
def m8_local(spark, sf):
    return sm.local_levels(sites(spark, sf), 20, 1000).withColumn("smoothed", r6("smoothed"))


@query("m8_local_t", f"""
    WITH {SMOOTHED}, r AS (SELECT ref, start_pos, m1, m2, sqrt(v2) AS raw FROM g),
    q AS (SELECT ref, quantile_disc(raw, 0.75) AS least, quantile_disc(raw, 0.5) AS mid FROM r GROUP BY 1),
    d AS (SELECT ref, start_pos, m1 - m2 AS diff, (sum(greatest(raw, least)) OVER w + (101 - count(*) OVER w) * mid) / 101 AS sd FROM r JOIN q USING (ref) WINDOW w AS (PARTITION BY ref ORDER BY start_pos ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING))
    SELECT ref, start_pos, round(diff, 6) AS diff, round(sd, 6) AS sd, round(diff / (sd * sqrt(1 / 3.0 + 1 / 3.0)), 4) AS t FROM d""")
def m8_local_t(spark, sf):
    out = sm.local_t(pt.smooth(sites(spark, sf), 1000), F_SIDE, O_SIDE, "group2", correct=False)
    return out.select("ref", "start_pos", r6("diff"), r6("sd"), F.round("t", 4).alias("t"))


@query("m8_local_regions")
def m8_local_regions(spark, sf):
    tested = sm.local_t(sm.local_levels(sites(spark, sf), 20, 1000), F_SIDE, O_SIDE, "paired")
    out = pt.differing_regions(tested, 1.0, 2000, 2, 0.02)
    return out.withColumns({"mean_diff": F.round("mean_diff", 5), "area_t": F.round("area_t", 3)})
