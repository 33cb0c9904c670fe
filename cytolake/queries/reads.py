"""Queries on sequences, reads and QC tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import sequence as sq
from ..operators import alignment as al
from ..plans.fixtures import calls, dna, reads, sites
from ..sources.sequences import chunk_rows
from .registry import query, r6
from .sites import PCT


@query("p1_convert_reads", "SELECT doc_id, md5(translate(seq, 'Tt', 'Cc')) AS c_mode, md5(translate(seq, 'Aa', 'Gg')) AS g_mode, length(seq) AS n FROM dna")
def p1(spark, sf):
    d = dna(spark, sf)
    return d.select("doc_id", F.md5(sq.convert(F.col("seq"), "C")).alias("c_mode"), F.md5(sq.convert(F.col("seq"), "G")).alias("g_mode"), F.length("seq").cast("long").alias("n"))


@query("p5_reverse_complement", "SELECT doc_id, md5(translate(reverse(seq), 'ACGT', 'TGCA')) AS digest FROM dna")
def p5(spark, sf):
    return dna(spark, sf).select("doc_id", F.md5(sq.reverse_complement(F.col("seq"))).alias("digest"))


@query("p3_trim", "SELECT doc_id, md5(regexp_replace(regexp_replace(substr(s, 6, greatest(length(s) - 8, 0)), '^N+', ''), 'N+$', '')) AS digest FROM (SELECT doc_id, translate(seq, 'A', 'N') AS s FROM dna)")
def p3(spark, sf):
    return dna(spark, sf).select("doc_id", F.md5(sq.trim(F.translate("seq", "A", "N"), 5, 3)).alias("digest"))


QUALITIES = ("ACGT", "+5?I")


@query("p3_trimmed_lengths", """
    WITH r AS (SELECT doc_id, 'NN' || seq AS seq, 'II' || translate(seq, 'ACGT', '+5?I') AS qual FROM dna), m AS (SELECT *, substr(qual, 5, greatest(cast(length(seq) as bigint) - 3 - 4, 0)) AS q FROM r),
    t AS (SELECT length(q) - length(regexp_extract(q, '^([+]*)', 1)) - length(regexp_extract(q, '([+5]*)$', 1)) AS n, length(seq) AS whole FROM m)
    SELECT cast(greatest(n, 0) as int) AS length, greatest(n, 0) >= 0.5 * whole AS kept, count(*) AS n FROM t GROUP BY 1, 2""")
def p3_lengths(spark, sf):
    r = dna(spark, sf).select(F.col("doc_id").alias("id"), F.concat(F.lit("NN"), "seq").alias("seq"), F.lit("+").alias("plus"), F.concat(F.lit("II"), F.translate("seq", *QUALITIES)).alias("qual"))
    return sq.trim_reads(r, 4, 3, True, ord("5"), ord("?"), 0.5).groupBy("length", "kept").agg(F.count("*").alias("n"))


@query("p2_two_genomes", "SELECT 'c' AS genome, cast(doc_id as varchar) AS ref, md5(translate(seq, 'T', 'C')) AS digest FROM dna UNION ALL SELECT 'g', cast(doc_id as varchar), md5(translate(seq, 'A', 'G')) FROM dna")
def p2(spark, sf):
    both = sq.two_genomes(dna(spark, sf).select(F.col("doc_id").cast("string").alias("ref"), "seq"))
    return both.select("genome", "ref", F.md5("seq").alias("digest"))


@query("p4_phred_offset", "SELECT lang, CASE WHEN min(lo) < 59 THEN 33 WHEN max(hi) > 74 THEN 64 ELSE 33 END AS phred FROM (SELECT lang, CASE WHEN contains(seq, 'A') THEN 65 ELSE 67 END AS lo, CASE WHEN contains(seq, 'T') THEN 84 ELSE 71 END AS hi FROM dna) GROUP BY 1")
def p4(spark, sf):
    codes = dna(spark, sf).select("lang", F.array_min(F.transform(F.array_distinct(F.split("seq", "")), lambda c: F.ascii(c))).alias("lo"), F.array_max(F.transform(F.array_distinct(F.split("seq", "")), lambda c: F.ascii(c))).alias("hi"))
    codes = codes.withColumn("lo", F.when(F.col("lo") < 65, 67).otherwise(F.col("lo"))).withColumn("hi", F.greatest("hi", F.lit(71)))
    return codes.groupBy("lang").agg(sq.phred_offset(F.min("lo"), F.max("hi")).alias("phred"))


@query("s5_sequence_lengths", "SELECT source AS ref, cast(sum(length(seq)) as bigint) AS len FROM dna GROUP BY 1")
def s5(spark, sf):
    return dna(spark, sf).groupBy(F.col("source").alias("ref")).agg(F.sum(F.length("seq")).alias("len"))


SITES = "(SELECT doc_id AS ref, unnest(regexp_extract_all(seq, 'CCGG')) AS x FROM dna)"


@query("p15_motif_counts", f"SELECT ref, count(*) AS n FROM {SITES} GROUP BY 1")
def p15(spark, sf):
    return al.motif_sites(dna(spark, sf).withColumnRenamed("doc_id", "ref"), "CCGG", 1).groupBy("ref").agg(F.count("*").alias("n"))


@query("p16_digest", "SELECT doc_id AS ref, count(*) AS n, max(length(f)) AS longest FROM (SELECT doc_id, unnest(string_split(replace(seq, 'CCGG', 'C|CGG'), '|')) AS f FROM dna) WHERE length(f) > 0 GROUP BY 1")
def p16(spark, sf):
    out = al.digest(dna(spark, sf).withColumnRenamed("doc_id", "ref"), "CCGG", 1)
    return out.groupBy("ref").agg(F.count("*").alias("n"), F.max(F.length("seq")).cast("long").alias("longest"))


@query("p17_p18_cg_fragments", "SELECT doc_id AS ref, length(f) AS n, count(*) AS times FROM (SELECT doc_id, unnest(string_split(replace(seq, 'CCGG', 'C|CGG'), '|')) AS f FROM dna) WHERE starts_with(f, 'CG') GROUP BY 1, 2")
def p17(spark, sf):
    out = al.digest(dna(spark, sf).withColumnRenamed("doc_id", "ref"), "CCGG", 1).filter("upper(seq) like 'CG%'")
    return out.groupBy("ref", F.length("seq").cast("long").alias("n")).agg(F.count("*").alias("times"))


@query("p6_context_kmers", """
    WITH iupac (code, bases) AS (VALUES ('C', 'C'), ('G', 'G'), ('H', 'ACT')), ctx (context) AS (VALUES ('CG'), ('CHG'), ('CHH'), ('GCH'), ('HCG')),
    letters AS (SELECT context, i, unnest(string_split(bases, '')) AS base FROM ctx, (VALUES (1), (2), (3)) AS n (i) JOIN iupac ON code = substr(context, i, 1))
    SELECT context, a.base || b.base || coalesce(c.base, '') AS kmer, cast(instr(context, 'C') - 1 as int) AS c_offset
    FROM (SELECT * FROM letters WHERE i = 1) a JOIN (SELECT * FROM letters WHERE i = 2) b USING (context) LEFT JOIN (SELECT * FROM letters WHERE i = 3) c USING (context)""")
def p6(spark, sf):
    rows = [(c, w, o) for c in ("CG", "CHG", "CHH", "GCH", "HCG") for w, o in sq.expand_context(c)]
    return spark.createDataFrame(rows, "context string, kmer string, c_offset int")


CIGAR = "concat(soft, 'S', len - soft - ins, 'M', ins, 'I', del, 'D')"


@query("p8_cigar_sums", "SELECT qname, mate, ref, pos, cast(soft as bigint) AS clipped, cast(ins + del as bigint) AS gaps, cast(len as bigint) AS query_len, count(*) AS n FROM reads GROUP BY ALL")
def p8(spark, sf):
    r = reads(spark, sf).withColumn("cigar", F.expr(CIGAR))
    cigar = F.col("cigar")
    out = r.select("qname", "mate", "ref", "pos", sq.cigar_sum(cigar, "SH").alias("clipped"), sq.cigar_sum(cigar, "ID").alias("gaps"), sq.cigar_sum(cigar, "MIS").alias("query_len"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("p9_md_counts", "SELECT qname, mate, mism AS mismatches, del AS deleted, count(*) AS n FROM reads GROUP BY ALL")
def p9(spark, sf):
    md = F.concat(F.lit("10"), F.repeat(F.lit("A0"), F.col("mism")), F.when(F.col("del") > 0, F.concat(F.lit("^"), F.repeat(F.lit("C"), F.col("del").cast("int")), F.lit("5"))).otherwise(""))
    out = reads(spark, sf).select("qname", "mate", sq.md_mismatches(md).alias("mismatches"), sq.md_deletions(md).alias("deleted"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("p11_sam_tags", "SELECT qname, 'C' AS mode, len AS n_meth, count(*) AS n FROM reads GROUP BY 1, 3")
def p11(spark, sf):
    tags = F.concat(F.lit("NM:i:1\tZT:Z:C\tZM:i:"), F.col("len").cast("string"))
    out = reads(spark, sf).select("qname", sq.sam_tag(tags, "ZT").alias("mode"), sq.sam_tag(tags, "ZM").cast("int").alias("n_meth"))
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


MAPPED = "SELECT *, count(*) OVER (PARTITION BY qname, mate) AS places FROM reads WHERE (flag & 1540) = 0"


@query("f3_w9_read_filter", f"SELECT qname, mate, ref, pos, mapq, count(*) AS n FROM ({MAPPED}) WHERE places = 1 AND mapq > 3 AND soft <= floor(0.2 * len + 0.5) AND mism + ins + del <= floor(0.15 * len + 0.5) AND ins + del <= 4 GROUP BY ALL")
def f3(spark, sf):
    out = al.filter_reads(reads(spark, sf), 3, "0.2", "0.15", gaps="4").select("qname", "mate", "ref", "pos", "mapq")
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


@query("w8_best_alignment", "SELECT qname, mate, ref, pos, cost, count(*) AS n FROM (SELECT *, mism + ins + del + soft AS cost, rank() OVER (PARTITION BY qname, mate ORDER BY mism + ins + del + soft) AS k FROM reads) WHERE k = 1 GROUP BY ALL")
def w8(spark, sf):
    hits = reads(spark, sf).withColumn("cost", (F.col("mism") + F.col("ins") + F.col("del") + F.col("soft")).cast("int"))
    out = al.best_alignments(hits).select("qname", "mate", "ref", "pos", "cost")
    return out.groupBy(*out.columns).agg(F.count("*").alias("n"))


#: Reads as alignments of a report, every seventh without a mate; ties of place are of no account, as copies agree.
PLACED = "placed AS (SELECT qname, CASE WHEN qname % 7 = 0 THEN 0 ELSE mate END AS mate, flag, ref, pos, mapq, len, soft, qname % 3 AS hard, ins, del, mism, cast(qname % 5 as bigint) * 100 AS tlen FROM reads)"


def placed(spark, sf):
    r = reads(spark, sf)
    return r.withColumns({"mate": F.when(F.col("qname") % 7 == 0, 0).otherwise(F.col("mate")), "hard": F.col("qname") % 3, "tlen": F.col("qname") % 5 * 100})


@query("a13_mapping_summary", f"""
    WITH {PLACED}, p AS (SELECT qname, mate, count(*) AS places, min(struct_pack(ref := ref, pos := pos, flag := flag, mapq := mapq, len := len, soft := soft, hard := hard, mism := mism, tlen := tlen, gaps := ins + del)) AS v, min(ref) AS ref FROM placed GROUP BY 1, 2),
    m AS (SELECT *, CASE WHEN places > 1 THEN 3 WHEN v.flag & 4 = 0 THEN 1 ELSE 0 END AS code FROM p),
    q AS (SELECT qname, coalesce(max(CASE WHEN mate = 1 THEN code END), -1) AS c1, coalesce(max(CASE WHEN mate = 2 THEN code END), -1) AS c2, max(CASE WHEN mate = 1 THEN ref END) AS r1, max(CASE WHEN mate = 2 THEN ref END) AS r2, max(CASE WHEN mate = 1 THEN v.tlen END) AS t FROM m WHERE mate > 0 GROUP BY 1),
    c AS (SELECT 'reads' AS section, 'total' AS key FROM m UNION ALL SELECT 'reads', 'multi' FROM m WHERE code = 3 UNION ALL SELECT 'reads', 'low unique' FROM m WHERE code = 1 AND v.mapq <= 10
          UNION ALL SELECT 'reads', 'unique ' || CASE WHEN v.flag & 16 > 0 THEN 'reverse' ELSE 'forward' END FROM m WHERE code = 1 UNION ALL SELECT 'reads', CASE WHEN mate = 0 THEN 'single' ELSE 'read' || mate END FROM m
          UNION ALL SELECT 'locations', cast(places as varchar) FROM m WHERE code > 0 UNION ALL SELECT 'lengths', cast(v.len as varchar) FROM m WHERE code > 0
          UNION ALL SELECT unnest(['unique lengths', 'mismatches', 'gaps', 'errors', 'soft clips', 'hard clips']), unnest([cast(v.len as varchar), cast(v.mism as varchar), cast(v.gaps as varchar), cast(v.mism + v.gaps as varchar), cast(v.soft as varchar), cast(v.hard as varchar)]) FROM m WHERE code = 1
          UNION ALL SELECT 'pairs', c1 || '=' || c2 FROM q UNION ALL SELECT 'inserts', CASE WHEN r1 <> r2 THEN 'other reference' WHEN t = 0 THEN 'none' ELSE 'some' END FROM q WHERE c1 = 1 AND c2 = 1
          UNION ALL SELECT 'references', placed.ref || CASE WHEN code = 1 THEN ' unique' ELSE ' multi' END || CASE WHEN flag & 16 > 0 THEN ' reverse' ELSE ' forward' END FROM placed JOIN m USING (qname, mate) WHERE code > 0)
    SELECT section, key, count(*) AS n FROM c GROUP BY 1, 2""")
def a13(spark, sf):
    return al.mapping_summary(placed(spark, sf))


@query("a14_a15_merged_summary", f"""
    WITH {PLACED}, p AS (SELECT qname, mate, ref, count(*) AS places, min(struct_pack(pos := pos, flag := flag, mapq := mapq, len := len)) AS v FROM placed GROUP BY 1, 2, 3),
    c AS (SELECT 'lengths' AS section, cast(v.len as varchar) AS key, count(*) AS n FROM p WHERE places > 1 OR v.flag & 4 = 0 GROUP BY 2)
    SELECT section, key, n, round(100.0 * n / sum(n) OVER (), 6) AS percent FROM c""")
def a14(spark, sf):
    one = al.mapping_summary(placed(spark, sf).withColumn("qname", F.concat_ws(":", "qname", "ref")))
    return al.merge_summaries(one.filter("section = 'lengths'")).withColumn("percent", r6("percent"))


BIAS = "(SELECT (pos // 20) % 8 AS offs, substr('ACGT', cast(pos % 4 + 1 as int), 1) AS base, CASE WHEN read_id % 2 = 0 THEN 'forward' ELSE 'reverse' END AS strand, meth FROM calls)"


def bias(spark, sf):
    c = calls(spark, sf).withColumns({"offs": (F.floor(F.col("pos") / 20) % 8).cast("long"), "strand": F.when(F.col("read_id") % 2 == 0, "+").otherwise("-")})
    return al.methylation_bias(c.withColumn("context", F.concat(F.lit("C"), F.substring(F.lit("ACGT"), (F.col("pos") % 4 + 1).cast("int"), F.lit(1)))), "offs")


@query("a16_g9_methylation_bias", f"SELECT offs, 'C' || coalesce(base, '') AS code, coalesce(strand, 'both') AS strand, cast(sum(meth) as bigint) AS m, cast(sum(1 - meth) as bigint) AS u, round(cast(sum(meth) as double) / count(*), 6) AS level FROM {BIAS} GROUP BY GROUPING SETS ((offs, base, strand), (offs, base), (offs, strand), (offs))")
def a16(spark, sf):
    return bias(spark, sf).withColumn("level", r6("level"))


@query("a17_non_cg_bias", f"SELECT offs, 'CH' AS code, coalesce(strand, 'both') AS strand, cast(sum(meth) as bigint) AS m, cast(sum(1 - meth) as bigint) AS u, round(cast(sum(meth) as double) / count(*), 6) AS level FROM {BIAS} WHERE base <> 'G' GROUP BY GROUPING SETS ((offs, strand), (offs))")
def a17(spark, sf):
    return al.non_cg_bias(bias(spark, sf), "offs").withColumn("level", r6("level"))


@query("a18_g10_level_by_coverage", f"""
    WITH c AS (SELECT CASE WHEN cov <= 1 THEN '0-1' WHEN cov <= 5 THEN '1-5' WHEN cov <= 10 THEN '5-10' WHEN cov <= 20 THEN '10-20' ELSE '>20' END AS coverage, cast(least(floor({PCT} * 10 + 1e-9), 9) as bigint) AS decile, count(*) AS n FROM sites WHERE cov > 0 GROUP BY 1, 2)
    SELECT coverage, decile, n, round(sum(n) OVER (PARTITION BY coverage ORDER BY decile DESC) / sum(n) OVER (PARTITION BY coverage), 6) AS share_above FROM c""")
def a18(spark, sf):
    return al.level_by_coverage(sites(spark, sf)).withColumn("share_above", r6("share_above"))


@query("a19_level_histogram", f"SELECT sample, cast(floor({PCT} / 0.01 + 1e-9) as bigint) AS bin, count(*) AS n FROM sites WHERE cov > 0 GROUP BY 1, 2")
def a19(spark, sf):
    return al.histogram(sites(spark, sf).filter("cov > 0"), F.col("m").cast("double") / F.col("cov"), 0.01, ("sample",))


@query("f5_f6_call_filters", "SELECT read_id, ref, pos, meth, baseq FROM calls WHERE baseq >= 20 AND (ref, pos) NOT IN (SELECT ref, pos FROM calls WHERE read_id % 97 = 0)")
def f5(spark, sf):
    c = calls(spark, sf)
    return c.filter("baseq >= 20").join(c.filter("read_id % 97 = 0").select("ref", "pos").distinct(), ["ref", "pos"], "left_anti").select("read_id", "ref", "pos", "meth", "baseq")


#: Reads laid over the sequences: one from every 40th base on, 36 long, with C as T where the place is even, in both modes and strands; the fixture of the call path.
SPANS = """
    spans AS (SELECT doc_id AS ref, seq, unnest(generate_series(0, greatest(cast(length(seq) as bigint) - 36, -1), 40)) AS x0 FROM dna),
    laid AS (SELECT ref || ':' || x0 AS qname, ref, seq AS whole, x0 + 1 AS pos, CASE WHEN x0 // 40 % 2 = 0 THEN 'C' ELSE 'G' END AS mode, CASE WHEN x0 // 40 % 3 = 0 THEN 16 ELSE 0 END AS flag, substr(seq, x0 + 1, 36) AS own FROM spans),
    bases AS (SELECT qname, ref, whole, pos, mode, flag, own, unnest(generate_series(1, cast(length(own) as bigint))) AS o FROM laid),
    called AS (SELECT *, (pos + o) % 2 AS meth, pos + o - 1 AS place FROM bases WHERE substr(own, o, 1) = mode),
    kept AS (SELECT * FROM called WHERE NOT (meth = 1 AND CASE WHEN mode = 'C' THEN o >= length(own) - 1 ELSE o <= 2 END AND CASE WHEN flag = 0 THEN mode = 'C' AND substr(whole, place - 1, 4) = 'CCGG' ELSE mode = 'G' AND substr(whole, place - 2, 4) = 'CCGG' END))"""
FIXES = [("CCGG", "+", 2), ("CCGG", "-", 3)]


def laid(spark, sf):
    d = dna(spark, sf).select(F.col("doc_id").cast("string").alias("ref"), "seq")
    # cut in one pass: a row that took the whole sequence along would make the work grow with the square of its length
    pieces = d.select("ref", F.posexplode(F.regexp_extract_all("seq", F.lit("(?s).{1,40}"), F.lit(0))).alias("k", "piece")).filter(F.length("piece") >= 36)
    rows = pieces.select("ref", "k", (F.col("k").cast("long") * 40).alias("at"), F.left("piece", F.lit(36)).alias("own"), (F.col("k") % 2 == 0).alias("even"))
    # places are odd, so every other base from the first on is turned where it is the mode's
    turned = F.when(F.col("even"), F.regexp_replace("own", r"\G((?:[^C].)*+)C(.?)", "$1T$2")).otherwise(F.regexp_replace("own", r"\G((?:[^G].)*+)G(.?)", "$1A$2"))
    mode, flag = F.when(F.col("even"), "C").otherwise("G"), F.when(F.col("k") % 3 == 0, 16).otherwise(0)
    return rows.select(F.concat_ws(":", "ref", "at").alias("qname"), F.lit(1).alias("mate"), mode.alias("mode"), flag.alias("flag"), "ref", (F.col("at") + 1).alias("pos"), F.lit("36M").alias("cigar"), turned.alias("seq"), F.lit("I" * 36).alias("qual")), d


@query("p7_p12_read_calls", f"WITH {SPANS} SELECT qname, mode, count(*) AS n_calls, cast(sum(meth) as bigint) AS m, cast(sum(place) as bigint) AS places FROM called GROUP BY 1, 2")
def p7(spark, sf):
    r, d = laid(spark, sf)
    c = al.calls_of(al.rescore(r, chunk_rows(d)), 40)
    return c.groupBy("qname", "mode").agg(F.count("*").alias("n_calls"), F.sum("meth").cast("long").alias("m"), F.sum("pos").alias("places"))


@query("v4_p13_p14_called_sites", f"""
    WITH {SPANS}, t AS (SELECT cast(ref as varchar) AS ref, place, CASE mode WHEN 'C' THEN '+' ELSE '-' END AS strand, CASE mode WHEN 'C' THEN substr(whole, place, 3) ELSE translate(reverse(substr(whole, greatest(place - 2, 1), least(place, 3))), 'ACGT', 'TGCA') END AS context, meth FROM kept)
    SELECT ref, place AS pos, strand, context, cast(sum(meth) as bigint) AS m, cast(sum(1 - meth) as bigint) AS u, round(cast(sum(meth) as double) / count(*), 6) AS score FROM t GROUP BY 1, 2, 3, 4""")
def v4(spark, sf):
    r, d = laid(spark, sf)
    return al.call_methylation(r, d, FIXES).select("ref", "pos", "strand", "context", "m", "u", r6("score"))


@query("v4_a3_palindrome_sites", f"""
    WITH {SPANS} SELECT cast(ref as varchar) AS ref, CASE mode WHEN 'C' THEN place - 1 ELSE place - 2 END AS start_pos, cast(count(*) as bigint) AS cov, cast(sum(meth) as bigint) AS m, CASE WHEN count(DISTINCT mode) > 1 THEN '.' ELSE max(CASE mode WHEN 'C' THEN '+' ELSE '-' END) END AS strand
    FROM kept WHERE CASE mode WHEN 'C' THEN substr(whole, place, 2) ELSE substr(whole, greatest(place - 1, 1), 2) END = 'CG' AND place + (mode = 'C')::int > 1 GROUP BY 1, 2""")
def v4_sites(spark, sf):
    r, d = laid(spark, sf)
    return al.palindrome_sites(al.call_methylation(r, d, FIXES)).select("ref", "start_pos", "cov", "m", "strand")


@query("p14_a27_fill_in_log", f"""
    WITH {SPANS} SELECT cast(ref as varchar) AS ref, pos + o - 1 AS pos, count(*) AS n_reads FROM bases WHERE CASE mode WHEN 'C' THEN o >= length(own) - 1 ELSE o <= 2 END AND NOT (substr(own, o, 1) = mode AND (pos + o) % 2 = 0)
        AND CASE flag WHEN 0 THEN substr(own, o, 1) = 'C' AND substr(whole, pos + o - 2, 4) = 'CCGG' ELSE substr(own, o, 1) = 'G' AND substr(whole, pos + o - 3, 4) = 'CCGG' END GROUP BY 1, 2""")
def p14(spark, sf):
    r, d = laid(spark, sf)
    return al.fill_in_log(al.filled_calls(r, al.fix_places(d, FIXES)))


@query("s18_bedgraph", f"SELECT sample, ref, start_pos, start_pos + 1 AS end_pos, round({PCT} + 0.1, 6) AS value FROM sites WHERE cov >= 5")
def s18(spark, sf):
    from ..sources.writers import bedgraph

    return bedgraph(sites(spark, sf), shift=0.1, min_cov=5).withColumn("value", r6("value"))


@query("s20_s21_coloured_bed", f"SELECT sample, ref, start_pos, end_pos, cast(cast(trunc(least(greatest({PCT}, 0), 1) * 255) as int) as varchar) || ',' || cast(255 - cast(trunc(least(greatest({PCT}, 0), 1) * 255) as int) as varchar) || ',0' AS rgb FROM sites WHERE cov >= 5")
def s20(spark, sf):
    from ..sources.writers import coloured_bed

    return coloured_bed(sites(spark, sf).filter("cov >= 5")).select("sample", "ref", "start_pos", "end_pos", "rgb")
