"""Queries on sites and matrices."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import matrix as mx
from ..operators import sites as st
from ..plans.fixtures import GROUPS, SAMPLES, calls, sites
from .registry import query, r6

PAIRS = [(a, b) for a in GROUPS["F"] for b in GROUPS["O"]]
PAIR_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in PAIRS) + ") AS pairs(a, b)"
PCT = "cast(m as double) / cov"


def pairs(spark):
    return spark.createDataFrame(PAIRS, "a string, b string")


def membership(spark):
    return spark.createDataFrame([(s, g) for g, members in GROUPS.items() for s in members] + [("af", "F"), ("af", "all"), ("ao", "all")], "sample string, grp string")


MEMBERS_SQL = "(VALUES " + ", ".join(f"('{s}', '{g}')" for g, members in [*GROUPS.items(), ("all", ["af", "ao"])] for s in members) + ") AS mem(sample, grp)"


@query("f1_coverage_filter", "SELECT * FROM sites WHERE cov >= 5")
def f1(spark, sf):
    return st.filter_sites(sites(spark, sf), 5)


@query("f1_include_positions", "SELECT * FROM sites WHERE cov >= 5 AND (ref, start_pos) IN (SELECT ref, start_pos FROM sites WHERE sample = 'ro' AND cov >= 20)")
def f1_include(spark, sf):
    s = sites(spark, sf)
    return st.filter_sites(s, 5, s.filter("sample = 'ro' AND cov >= 20"))


@query("f1_u7_exclude_positions", "SELECT * FROM sites WHERE cov >= 5 AND (ref, start_pos) NOT IN (SELECT ref, start_pos FROM sites WHERE sample = 'ro' AND cov >= 20)")
def f1_exclude(spark, sf):
    s = sites(spark, sf)
    return st.filter_sites(s, 5, s.filter("sample = 'ro' AND cov >= 20"), exclude=True)


@query(
    "a1_a2_pileup",
    """SELECT ref, pos, cast(sum(meth) as bigint) AS m, cast(sum(1 - meth) as bigint) AS u, cast(sum(meth * baseq) as bigint) AS mqual, cast(sum((1 - meth) * baseq) as bigint) AS uqual,
              round(cast(sum(meth) as double) / count(*), 6) AS score, round(coalesce(cast(sum(meth * baseq) as double) / nullif(sum(baseq), 0), -1), 6) AS qscore
       FROM calls WHERE baseq >= 10 GROUP BY 1, 2""",
)
def a1(spark, sf):
    out = st.pileup(calls(spark, sf), 10)
    return out.select("ref", "pos", "m", "u", "mqual", "uqual", r6("score"), r6("qscore"))


@query(
    "a3_palindrome_merge",
    """SELECT ref, start_pos, max(end_pos) AS end_pos, cast(sum(cov) as bigint) AS cov, cast(sum(m) as bigint) AS m,
              CASE WHEN count(DISTINCT strand) > 1 THEN '.' ELSE min(strand) END AS strand
       FROM (SELECT *, CASE WHEN grp = 'F' THEN '+' ELSE '-' END AS strand FROM sites) GROUP BY 1, 2""",
)
def a3(spark, sf):
    return st.merge_palindromes(sites(spark, sf).withColumn("strand", F.when(F.col("grp") == "F", "+").otherwise("-")))


@query(
    "a4_merge_tracks",
    f"SELECT grp, ref, start_pos, max(end_pos) AS end_pos, cast(sum(cov) as bigint) AS cov, cast(sum(m) as bigint) AS m, round(cast(sum(m) as double) / sum(cov), 6) AS pct FROM sites GROUP BY 1, 2, 3",
)
def a4(spark, sf):
    return st.merge_tracks(sites(spark, sf), ("grp",)).withColumn("pct", r6("pct"))


@query(
    "a5_u6_group_levels",
    f"""SELECT ref, start_pos, mem.grp AS grp, round(avg({PCT}), 6) AS mean_pct, cast(sum(m) as bigint) AS m, cast(sum(cov) as bigint) AS cov, count(*) AS n_samples
        FROM sites JOIN {MEMBERS_SQL} ON sites.sample = mem.sample WHERE cov > 0 GROUP BY 1, 2, 3""",
)
def a5(spark, sf):
    return st.group_levels(sites(spark, sf).drop("grp"), membership(spark)).withColumn("mean_pct", r6("mean_pct"))


@query(
    "a6_sample_differences",
    f"""SELECT ref, start_pos, a, b, round(max(CASE WHEN sample = a THEN {PCT} END) - max(CASE WHEN sample = b THEN {PCT} END), 6) AS diff
        FROM sites JOIN {PAIR_SQL} ON sample = a OR sample = b GROUP BY 1, 2, 3, 4""",
)
def a6(spark, sf):
    return st.differences(sites(spark, sf).withColumn("pct", st.level()), pairs(spark)).withColumn("diff", r6("diff"))


@query(
    "j4_j5_pair_difference",
    f"""SELECT x.ref, x.start_pos, x.end_pos, a, b, least(x.cov, y.cov) AS cov, round(cast(x.m as double) / x.cov - cast(y.m as double) / y.cov, 6) AS diff
        FROM sites x JOIN {PAIR_SQL} ON x.sample = a JOIN sites y ON y.sample = b AND x.ref = y.ref AND x.start_pos = y.start_pos""",
)
def j4(spark, sf):
    return st.pair_difference(sites(spark, sf), pairs(spark)).drop("m").withColumn("diff", r6("diff"))


@query(
    "v7_hydroxymethylation",
    f"""SELECT x.ref, x.start_pos, a || '-' || b AS sample, '5mC' AS mark, least(x.cov, y.cov) AS cov, round(cast(x.m as double) / x.cov - cast(y.m as double) / y.cov, 6) AS pct
        FROM sites x JOIN {PAIR_SQL} ON x.sample = a JOIN sites y ON y.sample = b AND x.ref = y.ref AND x.start_pos = y.start_pos
        UNION ALL SELECT ref, start_pos, a || '-' || b, '5hmC', cov, round({PCT}, 6) FROM sites JOIN {PAIR_SQL} ON sample = b""",
)
def v7(spark, sf):
    return st.hydroxy(sites(spark, sf), pairs(spark), "tab").withColumn("pct", r6("pct"))


def _wide(values: list[tuple[str, str]]) -> str:
    return ", ".join(f"max(CASE WHEN sample = '{s}' THEN {e} END) AS {s}_{v}" for s in SAMPLES for v, e in values)


@query("j1_outer_matrix", f"SELECT ref, start_pos, end_pos, {_wide([('pct', f'round({PCT}, 6)')])} FROM sites WHERE cov >= 5 GROUP BY 1, 2, 3")
def j1(spark, sf):
    rows = sites(spark, sf).filter("cov >= 5").withColumn("pct", F.round(st.level(), 6))
    return mx.outer_matrix(rows, SAMPLES, ["pct"])


@query("j2_inner_matrix", f"SELECT ref, start_pos, end_pos, {_wide([('pct', f'round({PCT}, 6)')])} FROM sites WHERE cov >= 5 GROUP BY 1, 2, 3 HAVING count(DISTINCT sample) = 6")
def j2(spark, sf):
    rows = sites(spark, sf).filter("cov >= 5").withColumn("pct", F.round(st.level(), 6))
    return mx.outer_matrix(rows, SAMPLES, ["pct"], common=True)


@query("j3_nread_matrix", "SELECT ref, start_pos, end_pos, " + ", ".join(f"coalesce(max(CASE WHEN sample = '{s}' THEN {v} END), 0) AS {s}_{v}" for s in SAMPLES for v in ("m", "cov")) + " FROM sites WHERE cov >= 5 GROUP BY 1, 2, 3")
def j3(spark, sf):
    return mx.outer_matrix(sites(spark, sf).filter("cov >= 5"), SAMPLES, ["m", "cov"], missing=0)


@query("s14_s7_matrix_to_long", f"SELECT ref, start_pos, end_pos, sample, round({PCT}, 6) AS pct FROM sites WHERE cov >= 5")
def s14(spark, sf):
    return mx.to_long(j1(spark, sf), SAMPLES, "pct")


@query("f11_complete_sites", "SELECT * FROM sites WHERE (ref, start_pos) IN (SELECT ref, start_pos FROM sites GROUP BY 1, 2 HAVING count(DISTINCT sample) = 6)")
def f11(spark, sf):
    return mx.complete(sites(spark, sf), 6)


@query(
    "f8_group_fraction",
    """SELECT * FROM sites WHERE (ref, start_pos) IN (SELECT ref, start_pos FROM (SELECT ref, start_pos, grp, count(DISTINCT sample) AS n FROM sites WHERE cov > 0 GROUP BY 1, 2, 3) WHERE n >= 2 GROUP BY 1, 2 HAVING count(*) = 2)""",
)
def f8(spark, sf):
    return mx.group_fraction(sites(spark, sf), spark.createDataFrame([("F", 3), ("O", 3)], "grp string, size int"), 0.6)


@query("f9_value_range", f"SELECT ref, start_pos, round(max({PCT}) - min({PCT}), 6) AS spread, count(*) AS n FROM sites GROUP BY 1, 2 HAVING max({PCT}) - min({PCT}) >= 0.25")
def f9(spark, sf):
    return mx.value_range(sites(spark, sf).withColumn("pct", st.level()), 0.25).withColumn("spread", r6("spread"))


@query("a20_missing_by_sample", "SELECT sample, (SELECT count(*) FROM (SELECT DISTINCT ref, start_pos FROM sites)) - count(*) AS n_missing FROM (SELECT DISTINCT sample, ref, start_pos FROM sites) GROUP BY 1")
def a20(spark, sf):
    return mx.missing_counts(sites(spark, sf), spark.createDataFrame([(s,) for s in SAMPLES], "sample string"))


@query("a20_missing_by_site", "SELECT ref, start_pos, 6 - count(DISTINCT sample) AS n_missing FROM sites GROUP BY 1, 2")
def a20_site(spark, sf):
    return sites(spark, sf).groupBy("ref", "start_pos").agg((6 - F.count_distinct("sample")).alias("n_missing"))


@query(
    "o3_top_fraction",
    f"""WITH d AS (SELECT ref, start_pos, cast(round((cast(sum(m) as double) / sum(cov)) * 1e9) as bigint) AS score FROM sites GROUP BY 1, 2),
        r AS (SELECT *, row_number() OVER (ORDER BY score DESC, ref, start_pos) AS k, count(*) OVER () AS n FROM d)
        SELECT ref, start_pos, score FROM r WHERE k <= floor(0.05 * n + 0.5)""",
)
def o3(spark, sf):
    rows = sites(spark, sf).groupBy("ref", "start_pos").agg(F.round(F.sum("m").cast("double") / F.sum("cov") * 1e9).cast("long").alias("score"))
    return mx.top_fraction(rows, "score", 0.05, ("ref", "start_pos"))


@query("o1_natural_order", "SELECT ref, start_pos, end_pos, sample, cov, cast(row_number() OVER (PARTITION BY ref ORDER BY start_pos, end_pos, sample) as bigint) AS place, cast(regexp_extract(ref, '([0-9]+)', 1) as bigint) AS ref_no FROM sites")
def o1(spark, sf):
    from pyspark.sql import Window as W

    number, _ = mx.natural_order()
    rows = sites(spark, sf).withColumn("ref_no", number).withColumn("place", F.row_number().over(W.partitionBy("ref").orderBy("start_pos", "end_pos", "sample")).cast("long"))
    return rows.orderBy("ref_no", "ref", "start_pos", "end_pos").select("ref", "start_pos", "end_pos", "sample", "cov", "place", "ref_no")


@query("o4_top_sites", "SELECT ref, start_pos, cast(sum(cov) as bigint) AS cov FROM sites GROUP BY 1, 2 ORDER BY cov DESC, ref, start_pos LIMIT 500")
def o4(spark, sf):
    return sites(spark, sf).groupBy("ref", "start_pos").agg(F.sum("cov").alias("cov")).orderBy(F.desc("cov"), "ref", "start_pos").limit(500)


@query("u1_union_tracks", "SELECT 'sum' AS part, ref, start_pos, cast(sum(cov) as bigint) AS cov FROM sites GROUP BY 2, 3 UNION ALL SELECT sample, ref, start_pos, cov FROM sites")
def u1(spark, sf):
    s = sites(spark, sf)
    total = s.groupBy("ref", "start_pos").agg(F.sum("cov").alias("cov")).withColumn("part", F.lit("sum"))
    return total.unionByName(s.select("ref", "start_pos", "cov", F.col("sample").alias("part")))


@query(
    "p19_co_modification",
    """SELECT ref, start_pos, a, b, CASE WHEN a > 0 AND b > 0 THEN 'both' WHEN a > 0 THEN 'first' WHEN b > 0 THEN 'second' ELSE '-' END AS state
       FROM (SELECT ref, start_pos, cast(sum(CASE WHEN sample = 'af' THEN m ELSE 0 END) as bigint) AS a, cast(sum(CASE WHEN sample = 'ao' THEN m ELSE 0 END) as bigint) AS b FROM sites GROUP BY 1, 2)""",
)
def p19(spark, sf):
    both = sites(spark, sf).groupBy("ref", "start_pos").agg(*[F.sum(F.when(F.col("sample") == s, F.col("m")).otherwise(0)).alias(n) for n, s in (("a", "af"), ("b", "ao"))])
    state = F.when((F.col("a") > 0) & (F.col("b") > 0), "both").when(F.col("a") > 0, "first").when(F.col("b") > 0, "second").otherwise("-")
    return both.withColumn("state", state)


@query(
    "p20_sign_split",
    f"""WITH d AS (SELECT ref, start_pos, a, b, max(CASE WHEN sample = a THEN {PCT} END) - max(CASE WHEN sample = b THEN {PCT} END) AS diff FROM sites JOIN {PAIR_SQL} ON sample = a OR sample = b GROUP BY 1, 2, 3, 4)
        SELECT ref, start_pos, CASE WHEN max(diff) > 0 THEN 'hyper' ELSE 'hypo' END AS side, count(*) AS n FROM d WHERE diff <> 0 GROUP BY 1, 2 HAVING NOT (max(diff) > 0 AND min(diff) < 0)""",
)
def p20(spark, sf):
    d = st.differences(sites(spark, sf).withColumn("pct", st.level()), pairs(spark)).filter("diff <> 0")
    signs = d.groupBy("ref", "start_pos").agg(F.max("diff").alias("hi"), F.min("diff").alias("lo"), F.count("*").alias("n"))
    return signs.filter("NOT (hi > 0 AND lo < 0)").select("ref", "start_pos", F.when(F.col("hi") > 0, "hyper").otherwise("hypo").alias("side"), "n")


@query("v5_pair_merge", f"SELECT substr(sample, 1, 1) AS sample, ref, start_pos, max(end_pos) AS end_pos, cast(sum(cov) as bigint) AS cov, cast(sum(m) as bigint) AS m, round(cast(sum(m) as double) / sum(cov), 6) AS pct FROM sites GROUP BY 1, 2, 3")
def v5(spark, sf):
    s = sites(spark, sf)
    first, second = (s.filter(F.col("grp") == g).withColumn("sample", F.substring("sample", 1, 1)) for g in ("F", "O"))
    return st.merge_pairs(first, second).withColumn("pct", r6("pct"))


@query("v6_merged_groups", "SELECT grp, ref, start_pos, cast(sum(cov) as bigint) AS cov, cast(sum(m) as bigint) AS m FROM sites GROUP BY 1, 2, 3")
def v6(spark, sf):
    return st.merge_products({"bed": sites(spark, sf)}, ("bed", "sum"))["bed"].select("grp", "ref", "start_pos", "cov", "m")


@query("j16_target_positions", "SELECT DISTINCT t.ref, t.start_pos FROM sites t WHERE t.sample = 'ro' AND (t.ref, t.start_pos) IN (SELECT ref, start_pos FROM sites WHERE cov >= 60)")
def j16(spark, sf):
    s = sites(spark, sf)
    return st.target_positions(s.filter("sample = 'ro'"), s, 60)


@query("p21_ranked_list", "SELECT ref || ':' || start_pos AS name, cast(max(m) as bigint) AS score FROM sites GROUP BY 1")
def p21(spark, sf):
    s = sites(spark, sf).groupBy(F.concat_ws(":", "ref", "start_pos").alias("place")).agg(F.max("m").alias("best"))
    return st.ranked_list(s, "place", "best")
