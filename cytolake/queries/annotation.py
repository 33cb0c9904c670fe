"""Queries on annotation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import annotation as an
from ..operators import intervals as iv
from ..plans.fixtures import features, sites
from .registry import query, r6

KEYS = ["ref", "start_pos"]
PLACES = "(SELECT ref, start_pos, max(end_pos) AS end_pos, cast(sum(cov) as bigint) AS score FROM sites GROUP BY 1, 2)"
#: The site as [x0, x1) from the gene's start along its strand, the gene as [0, size), with 300 before and 100 behind it near, and inner margins of 20.
ALONG = "CASE strand WHEN '-' THEN f_end - end_pos ELSE start_pos - f_start END"
CLASS = """CASE WHEN x0 - size >= 100 THEN 'fardown' WHEN x1 <= -300 THEN 'farup' WHEN x1 <= margin OR x0 >= size - margin THEN CASE WHEN x0 <= margin THEN 'upstream' ELSE 'downstream' END ELSE 'body' END"""
HITS = f"""hits AS (SELECT ref, start_pos, end_pos, score, feature_id, f_start, f_end, strand, gene, {CLASS} AS label FROM (SELECT *, x0 + end_pos - start_pos AS x1 FROM (SELECT p.*, f.feature_id, f.f_start, f.f_end, f.strand, f.gene, {ALONG} AS x0, f_end - f_start AS size,
           CASE WHEN f_end - f_start > 60 THEN 20 ELSE (f_end - f_start) // 3 END AS margin
           FROM {PLACES} p JOIN features f ON p.ref = f.ref AND p.start_pos < f.f_end + 400 AND f.f_start - 400 < p.end_pos)))"""
LABELS = ["upstream", "body", "downstream"]


def hits(spark, sf):
    places = sites(spark, sf).groupBy("ref", "start_pos").agg(F.max("end_pos").alias("end_pos"), F.sum("cov").alias("score"))
    wide = features(spark, sf).withColumns({"b": F.col("f_start"), "e": F.col("f_end"), "f_start": F.col("f_start") - 400, "f_end": F.col("f_end") + 400})
    near = iv.overlap_join(places, wide).withColumns({"f_start": F.col("b"), "f_end": F.col("e")}).drop("b", "e")
    return near.withColumns({"label": an.location_class(300, 20, 100, 20), "dist": iv.distance()})


@query("n2_n5_location_class", f"WITH {HITS} SELECT ref, start_pos, feature_id, label FROM hits")
def n2(spark, sf):
    return hits(spark, sf).select("ref", "start_pos", "feature_id", "label")


@query("n2_near_only", f"WITH {HITS} SELECT ref, start_pos, feature_id, label FROM (SELECT *, max(CASE WHEN label NOT LIKE 'far%' THEN 1 ELSE 0 END) OVER (PARTITION BY ref, start_pos) AS near FROM hits) WHERE near = 0 OR label NOT LIKE 'far%'")
def n2_near(spark, sf):
    return an.near_only(hits(spark, sf), KEYS).select("ref", "start_pos", "feature_id", "label")


RANK = "CASE label WHEN 'upstream' THEN 0 WHEN 'downstream' THEN 3 WHEN 'body' THEN 7 WHEN 'farup' THEN 8 WHEN 'fardown' THEN 9 ELSE 12 END"
TSS = "CASE WHEN strand = '-' THEN f_end - (start_pos + end_pos) // 2 ELSE (start_pos + end_pos) // 2 - f_start END"


@query("w7_n3_n6_best_gene", f"WITH {HITS} SELECT ref, start_pos, feature_id, label, tss_dist FROM (SELECT *, {TSS} AS tss_dist, row_number() OVER (PARTITION BY ref, start_pos ORDER BY {RANK}, abs({TSS}), feature_id) AS k FROM hits) WHERE k = 1")
def w7(spark, sf):
    return an.best_hit(hits(spark, sf), KEYS).select("ref", "start_pos", "feature_id", "label", "tss_dist")


COMBINED = f"""WITH {HITS}, b AS (SELECT ref, start_pos, strand, arg_min(label, {RANK}) AS label, min({RANK}) AS k FROM hits GROUP BY 1, 2, 3),
    s AS (SELECT ref, start_pos, max(CASE WHEN strand = '+' THEN CASE WHEN label LIKE 'far%' THEN 'intergenic' ELSE label END END) AS top, max(CASE WHEN strand = '-' THEN CASE WHEN label LIKE 'far%' THEN 'intergenic' ELSE label END END) AS bot, max(CASE WHEN strand = '+' THEN k END) AS tk, max(CASE WHEN strand = '-' THEN k END) AS bk FROM b GROUP BY 1, 2),
    c AS (SELECT ref, start_pos, coalesce(top, 'intergenic') AS top, coalesce(bot, 'intergenic') AS bot, coalesce(tk, 99) AS tk, coalesce(bk, 99) AS bk FROM s),
    combined AS (SELECT ref, start_pos, CASE WHEN top = bot THEN CASE WHEN top = 'intergenic' THEN top WHEN top IN ('upstream', 'downstream') THEN 'bi_' || top || '*' ELSE top || '*' END WHEN bk < tk THEN bot || '-' ELSE top || '+' END AS label FROM c)"""


@query("n4_combined_strands", f"{COMBINED} SELECT * FROM combined")
def n4(spark, sf):
    return an.combine_strands(hits(spark, sf), KEYS).select("ref", "start_pos", "label")


@query("a25_o7_combined_totals", f"{COMBINED} SELECT label, count(*) AS n FROM combined GROUP BY 1 ORDER BY n DESC, label")
def a25(spark, sf):
    return n4(spark, sf).groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


@query("a26_g11_figure_table", f"""{COMBINED}, f AS (SELECT CASE rtrim(label, '+-*') WHEN 'upstream' THEN 'promoter' WHEN 'bi_upstream' THEN 'promoter' WHEN 'body' THEN 'intron' WHEN 'downstream' THEN 'downstream' WHEN 'bi_downstream' THEN 'downstream' WHEN 'intergenic' THEN 'intergenic' ELSE 'other' END AS part FROM combined)
    SELECT part, count(*) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent FROM f GROUP BY 1""")
def a26(spark, sf):
    return an.figure_table(a25(spark, sf)).withColumn("percent", r6("percent"))


@query("a8_gene_lists", f"""WITH {HITS}, c AS (SELECT label AS category, gene, score FROM hits WHERE label NOT LIKE 'far%' UNION ALL SELECT 'all', gene, score FROM hits WHERE label NOT LIKE 'far%')
    SELECT category, gene, count(*) AS n, min(score) AS min, round(avg(score), 6) AS avg, max(score) AS max FROM c GROUP BY 1, 2""")
def a8(spark, sf):
    return an.gene_lists(hits(spark, sf)).withColumn("avg", r6("avg"))


@query("a21_a24_class_statistics", f"WITH {HITS}, n AS (SELECT *, count(*) OVER (PARTITION BY ref, start_pos) AS k FROM hits) SELECT label, count(*) AS n, round(sum(1.0 / k), 4) AS weight, count(DISTINCT ref || ':' || start_pos) AS n_sites FROM n GROUP BY 1")
def a21(spark, sf):
    return an.class_statistics(hits(spark, sf), KEYS).withColumn("weight", F.round("weight", 4))


@query("a22_feature_summary", f"WITH {HITS} SELECT feature_id, count(*) AS n, " + ", ".join(f"count(*) FILTER (label = '{x}') AS {x}" for x in LABELS) + " FROM hits GROUP BY 1")
def a22(spark, sf):
    return an.feature_summary(hits(spark, sf), LABELS)


@query("a23_gene_matrix", f"WITH {HITS} SELECT gene, " + ", ".join(f"coalesce((SELECT string_agg(t, '|' ORDER BY s, e) FROM (SELECT DISTINCT start_pos AS s, end_pos AS e, start_pos || '-' || end_pos AS t FROM hits h WHERE h.gene = g.gene AND h.label = '{x}')), '') AS {x}" for x in LABELS) + " FROM (SELECT DISTINCT gene FROM hits) g")
def a23(spark, sf):
    return an.gene_matrix(hits(spark, sf), LABELS)


PARTS = """(SELECT s.ref, s.start_pos, f.feature_id, f.strand, f.f_start AS b, f.f_start + (f.f_end - f.f_start) // 3 AS b1, f.f_start + 2 * ((f.f_end - f.f_start) // 3) AS b2, f.f_end AS e, s.end_pos FROM (SELECT DISTINCT ref, start_pos, end_pos FROM sites) s
           JOIN features f ON s.ref = f.ref AND s.start_pos < f.f_end AND f.f_start < s.end_pos)"""


@query("j9_exon_parts", f"""
    SELECT ref, start_pos, feature_id, part, count(*) AS n FROM (
        SELECT ref, start_pos, feature_id, 'exon' AS part FROM {PARTS} WHERE start_pos < b1 AND b < end_pos AND b < b1 UNION ALL SELECT ref, start_pos, feature_id, 'exon' FROM {PARTS} WHERE start_pos < e AND b2 < end_pos AND b2 < e
        UNION ALL SELECT ref, start_pos, feature_id, 'intron' FROM {PARTS} WHERE start_pos < b2 AND b1 < end_pos AND b1 < b2) GROUP BY 1, 2, 3, 4""")
def j9(spark, sf):
    third = F.floor((F.col("f_end") - F.col("f_start")) / 3)
    parts = F.array(F.struct(F.col("f_start").alias("s"), (F.col("f_start") + third).alias("e")), F.struct((F.col("f_start") + 2 * third).alias("s"), F.col("f_end").alias("e")))
    model = features(spark, sf).withColumns({"exons": parts, "cds_start": F.lit(0), "cds_end": F.lit(0)})
    held = iv.overlap_join(sites(spark, sf).select("ref", "start_pos", "end_pos").distinct(), model)
    return an.exon_parts(held).groupBy("ref", "start_pos", "feature_id", "part").agg(F.count("*").alias("n"))


#: Genes of two exons, a third of the gene each, coding from the middle of a third on to as far before the end.
MODEL = f"""model AS (SELECT *, f_start + t AS b1, f_start + 2 * t AS b2, f_start + t // 2 AS c0, f_end - t // 2 AS c1 FROM (SELECT *, x0 + end_pos - start_pos AS x1, size // 3 AS t FROM (SELECT p.*, f.feature_id, f.f_start, f.f_end, f.strand, {ALONG} AS x0, f_end - f_start AS size
           FROM {PLACES} p JOIN features f ON p.ref = f.ref AND p.start_pos < f.f_end + 400 AND f.f_start - 400 < p.end_pos))),
    labels AS (SELECT *, unnest(CASE WHEN x0 >= size + 100 THEN ['fardown'] WHEN x1 <= -300 THEN ['farup'] ELSE list_filter([
           CASE WHEN x0 < 0 THEN 'upstream' END, CASE WHEN x1 > size THEN 'downstream' END,
           CASE WHEN start_pos < c0 AND f_start < end_pos AND f_start < c0 THEN CASE strand WHEN '-' THEN '3UTR' ELSE '5UTR' END END, CASE WHEN start_pos < f_end AND c1 < end_pos AND c1 < f_end THEN CASE strand WHEN '-' THEN '5UTR' ELSE '3UTR' END END,
           CASE WHEN (start_pos < b1 AND c0 < end_pos AND c0 < b1) OR (start_pos < c1 AND b2 < end_pos AND b2 < c1) THEN 'CDS' END,
           CASE WHEN (start_pos < b1 AND f_start < end_pos AND f_start < b1) OR (start_pos < f_end AND b2 < end_pos AND b2 < f_end) THEN 'exon' END,
           CASE WHEN start_pos < b2 AND b1 < end_pos AND b1 < b2 THEN 'intron' END], lambda x: x IS NOT NULL) END) AS label FROM model)"""


def gene_hits(spark, sf):
    """Sites near genes with exons, a row for each label."""
    third = F.floor((F.col("f_end") - F.col("f_start")) / 3)
    exons = F.array(F.struct(F.col("f_start").alias("s"), (F.col("f_start") + third).alias("e")), F.struct((F.col("f_start") + 2 * third).alias("s"), F.col("f_end").alias("e")))
    model = hits(spark, sf).drop("label").withColumns({"exons": exons, "cds_start": F.col("f_start") + F.floor(third / 2), "cds_end": F.col("f_end") - F.floor(third / 2)})
    return an.gene_labels(model, 300, 100)


@query("n1_n2_gene_labels", f"WITH {MODEL} SELECT label, count(*) AS n, count(DISTINCT (ref, start_pos)) AS n_sites, count(DISTINCT feature_id) AS n_genes FROM labels GROUP BY 1")
def n1_labels(spark, sf):
    return gene_hits(spark, sf).groupBy("label").agg(F.count("*").alias("n"), F.count_distinct("ref", "start_pos").alias("n_sites"), F.count_distinct("feature_id").alias("n_genes"))


@query("n1_n3_best_gene_part", f"""
    WITH {MODEL}, r AS (SELECT *, CASE label WHEN 'upstream' THEN 0 WHEN '5UTR' THEN 1 WHEN '3UTR' THEN 2 WHEN 'downstream' THEN 3 WHEN 'CDS' THEN 4 WHEN 'exon' THEN 5 WHEN 'intron' THEN 6 WHEN 'farup' THEN 8 ELSE 9 END AS k FROM labels)
    SELECT ref, start_pos, feature_id, label, tss_dist FROM (SELECT *, {TSS} AS tss_dist, row_number() OVER (PARTITION BY ref, start_pos ORDER BY k, abs({TSS}), feature_id) AS place FROM r) WHERE place = 1""")
def n1_best(spark, sf):
    return an.best_hit(an.near_only(gene_hits(spark, sf), KEYS), KEYS).select("ref", "start_pos", "feature_id", "label", "tss_dist")


@query("j10_j11_id_lookup", "SELECT p.start_pos, p.ref, string_agg(DISTINCT f.gene, '|' ORDER BY f.gene) AS symbols FROM (SELECT DISTINCT ref, start_pos FROM sites) p JOIN features f ON p.ref = f.ref AND p.start_pos >= f.f_start AND p.start_pos <= f.f_end GROUP BY 1, 2")
def j10(spark, sf):
    f = features(spark, sf)
    held = iv.interval_join(sites(spark, sf).select("ref", "start_pos").distinct(), f)
    ids = held.groupBy("ref", "start_pos").agg(F.array_join(F.sort_array(F.collect_set(F.concat(F.col("feature_id").cast("string"), F.lit(".2(x,y)")))), "|").alias("ids"))
    return an.lookup_ids(ids, f.select(F.col("feature_id").cast("string").alias("id"), F.col("gene").alias("symbol")), ["ref", "start_pos"])


@query("a29_g14_feature_levels", f"WITH {HITS} SELECT label, quantile_cont(score, 0.5) AS median, quantile_cont(score, 0.25) AS q1, cast(min(score) as double) AS low, cast(max(score) as double) AS high FROM hits GROUP BY 1")
def a29(spark, sf):
    q = F.percentile("score", F.array(*[F.lit(x) for x in (0.0, 0.25, 0.5, 1.0)]))
    return hits(spark, sf).groupBy("label").agg(q.alias("q")).select("label", F.col("q")[2].alias("median"), F.col("q")[1].alias("q1"), F.col("q")[0].alias("low"), F.col("q")[3].alias("high"))


#: Sets of features by kind, hit ones being those with a well covered site in their body; log factorials give the tail.
ENRICHED = """
    b AS (SELECT kind AS set_name, feature_id FROM features), h AS (SELECT DISTINCT feature_id FROM hits WHERE label = 'body' AND score > 60),
    n AS (SELECT set_name, count(*) AS n_set, count(h.feature_id) AS n_overlap FROM b LEFT JOIN h USING (feature_id) GROUP BY 1), t AS (SELECT (SELECT count(*) FROM b) AS a, (SELECT count(*) FROM h) AS d),
    lf AS (SELECT n, sum(CASE WHEN n > 0 THEN ln(greatest(n, 1)) ELSE 0 END) OVER (ORDER BY n) AS v FROM (SELECT unnest(generate_series(0, (SELECT count(*) FROM b))) AS n)),
    r AS (SELECT set_name, n_set, n_overlap, a, d, unnest(generate_series(greatest(0, d + n_set - a), least(n_set, d))) AS k FROM n, t),
    lp AS (SELECT r.*, exp(f1.v - f2.v - f3.v + g1.v - g2.v - g3.v - c1.v + c2.v + c3.v) AS p FROM r JOIN lf f1 ON f1.n = n_set JOIN lf f2 ON f2.n = k JOIN lf f3 ON f3.n = n_set - k
           JOIN lf g1 ON g1.n = a - n_set JOIN lf g2 ON g2.n = d - k JOIN lf g3 ON g3.n = a - n_set - d + k JOIN lf c1 ON c1.n = a JOIN lf c2 ON c2.n = d JOIN lf c3 ON c3.n = a - d),
    e AS (SELECT set_name, n_set, n_overlap, max(n_overlap * cast(a as double) / (n_set * d)) AS fold, least(1.0, coalesce(sum(p) FILTER (k >= n_overlap), 0)) AS p, least(1.0, coalesce(sum(p) FILTER (k >= n_overlap - 1), 0)) AS ease FROM lp GROUP BY 1, 2, 3)"""


def enriched(spark, sf):
    h, f = hits(spark, sf), features(spark, sf)
    sets = f.select(F.col("kind").alias("set_name"), F.col("feature_id").alias("gene"))
    return an.enrichment(h.filter("label = 'body' AND score > 60").select(F.col("feature_id").alias("gene")), f.select(F.col("feature_id").alias("gene")), sets)


@query("n7_enrichment", f"""WITH {HITS}, {ENRICHED}, a AS (SELECT *, least(1.0, ease * count(*) OVER ()) AS bonferroni, ease * count(*) OVER () / count(*) OVER (ORDER BY ease RANGE UNBOUNDED PRECEDING) AS raw FROM e)
    SELECT set_name, n_set, n_overlap, round(fold, 6) AS fold, round(p, 6) AS p, round(ease, 6) AS ease, round(bonferroni, 6) AS bonferroni, round(least(1.0, min(raw) OVER (ORDER BY ease RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 6) AS q FROM a""")
def n7(spark, sf):
    return enriched(spark, sf).select("set_name", "n_set", "n_overlap", *[r6(c) for c in ("fold", "p", "ease", "bonferroni", "q")])


@query("o6_g12_top_terms", f"WITH {HITS}, {ENRICHED} SELECT substr(set_name, 1, 10) AS term, round(-log10(p), 5) AS score FROM (SELECT * FROM e ORDER BY round(p, 9), set_name LIMIT 10)")
def o6(spark, sf):
    return an.top_terms(enriched(spark, sf).withColumn("p", F.round("p", 9)), 10, width=10).withColumn("score", F.round("score", 5))


@query("n8_running_enrichment", f"""
    WITH {HITS}, g AS (SELECT feature_id, cast(sum(score) - 500 as double) AS score FROM hits GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY score DESC, feature_id) AS place, count(*) OVER () AS total FROM g),
    m AS (SELECT kind AS set_name, r.*, count(*) OVER s AS n, sum(abs(score)) OVER s AS weight, row_number() OVER o AS k, sum(abs(score)) OVER o AS upto FROM r JOIN features USING (feature_id) WINDOW s AS (PARTITION BY kind), o AS (PARTITION BY kind ORDER BY place)),
    d AS (SELECT set_name, n, max(upto / weight - (place - k) / cast(total - n as double)) AS hi, min((upto - abs(score)) / weight - (place - k) / cast(total - n as double)) AS lo FROM m GROUP BY 1, 2)
    SELECT set_name, n, round(CASE WHEN hi >= -lo THEN hi ELSE lo END, 6) AS es FROM d""")
def n8(spark, sf):
    h, f = hits(spark, sf), features(spark, sf)
    ranked = h.groupBy(F.col("feature_id").alias("gene")).agg((F.sum("score") - 500).cast("double").alias("score"))
    return an.running_enrichment(ranked, f.select(F.col("kind").alias("set_name"), F.col("feature_id").alias("gene"))).withColumn("es", r6("es"))


@query("n8_permuted_enrichment")
def n8_permuted(spark, sf):
    h, f = hits(spark, sf), features(spark, sf)
    ranked = h.groupBy(F.col("feature_id").alias("gene")).agg((F.sum("score") - 500).cast("double").alias("score"))
    out = an.permuted_enrichment(ranked, f.select(F.col("kind").alias("set_name"), F.col("feature_id").alias("gene")))
    return out.select("set_name", "n", *(r6(c) for c in ("es", "nes", "p", "q")))


@query("o5_o6_top_genes", f"WITH {HITS} SELECT gene, cast(sum(score) as bigint) AS total FROM hits GROUP BY 1 ORDER BY total DESC, gene LIMIT 20")
def o5(spark, sf):
    return hits(spark, sf).groupBy("gene").agg(F.sum("score").alias("total")).orderBy(F.desc("total"), "gene").limit(20)


@query("f13_same_sign_genes", "SELECT gene, min(d) AS lo, max(d) AS hi FROM (SELECT gene || kind AS gene, f_end - f_start - 500 AS d FROM features) GROUP BY 1 HAVING (min(d) < 0 AND max(d) < 0) OR (min(d) > 0 AND max(d) > 0)")
def f13(spark, sf):
    rows = features(spark, sf).select(F.concat("gene", "kind").alias("gene"), (F.col("f_end") - F.col("f_start") - 500).alias("d"))
    return rows.groupBy("gene").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).filter("(lo < 0 AND hi < 0) OR (lo > 0 AND hi > 0)")
