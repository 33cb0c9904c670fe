"""Annotation of sites by features: location classes, priorities, genes and summaries."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.tables import stored

#: What a letter of the priority string stands for (fixed values).
LETTERS = {"U": ["upstream"], "5": ["5UTR"], "3": ["3UTR"], "D": ["downstream"], "E": ["CDS", "exon"], "I": ["intron", "body"]}
LAST = ["farup", "fardown", "intergenic", "none"]


def priority_order(letters: str = "U53DEI") -> list[str]:
    """Location classes in the order of a priority string; far and none come last."""
    return [c for x in letters for c in LETTERS[x]] + LAST


def priority(label: Column, letters: str = "U53DEI") -> Column:
    """Rank of a label from 0; unknown ones come last. Digits of exon3 and the like don't count."""
    order = priority_order(letters)
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.regexp_replace(label, "(?<=[A-Za-z])[0-9]+$", ""))
    return F.when(place > 0, place - 1).otherwise(len(order))


def location_class(up5: int = 1000, down5: int = 0, up3: int = 0, down3: int = 0) -> Column:
    """One label for a site (start_pos, end_pos) and a feature (f_start, f_end, strand).

    Two lengths along the gene's own direction say it all: how far the site
    reaches in from the gene's start (`entered`, negative before it), and how
    much gene lies ahead of the site's near end (`ahead`, negative past it). The
    strand only swaps them. The inner margins are a third of the feature where
    they would meet.
    """
    from_left, from_right = F.col("end_pos") - F.col("f_start"), F.col("f_end") - F.col("start_pos")
    minus = F.col("strand") == "-"
    entered, ahead = F.when(minus, from_right).otherwise(from_left), F.when(minus, from_left).otherwise(from_right)
    size = F.col("f_end") - F.col("f_start")
    meet = size <= down5 + down3 + max(down5, down3)
    margin5, margin3 = (F.when(meet, F.floor(size / 3)).otherwise(m) for m in (down5, down3))
    inside = F.when((entered > margin5) & (ahead > margin3), "body").when(size - ahead <= margin5, "upstream").otherwise("downstream")
    return F.when(ahead <= -up3, "fardown").when(entered <= -up5, "farup").otherwise(inside)


def _met_parts() -> Column:
    """Parts of a row's feature that its site meets, as an array of part and number (see exon_parts)."""
    n, minus = F.size("exons"), F.col("strand") == "-"
    cds_start, cds_end = F.coalesce("cds_start", F.lit(0)), F.coalesce("cds_end", F.lit(0))

    def meets(lo: Column, hi: Column) -> Column:
        return (F.col("start_pos") < hi) & (lo < F.col("end_pos")) & (lo < hi)

    def of(exon: Column, i: Column) -> Column:
        s, e, after = exon["s"], exon["e"], F.try_element_at("exons", i + 2)["s"]
        number = F.when(minus, n - i).otherwise(i + 1)
        gap = F.when(minus, n - i - 1).otherwise(i + 1)
        left, right = F.least(e, cds_start), F.greatest(s, cds_end)
        coding = cds_end > cds_start
        return F.array(
            F.when(meets(s, e), F.struct(F.lit("exon").alias("part"), number.alias("number"))),
            F.when(meets(e, after), F.struct(F.lit("intron").alias("part"), gap.alias("number"))),
            F.when(coding & meets(F.greatest(s, cds_start), F.least(e, cds_end)), F.struct(F.lit("CDS").alias("part"), number.alias("number"))),
            F.when(coding & meets(s, left), F.struct(F.when(minus, "3UTR").otherwise("5UTR").alias("part"), number.alias("number"))),
            F.when(coding & meets(right, e), F.struct(F.when(minus, "5UTR").otherwise("3UTR").alias("part"), number.alias("number"))),
        )

    return F.filter(F.flatten(F.transform("exons", of)), lambda x: x.isNotNull())


def exon_parts(sites: DataFrame) -> DataFrame:
    """Exons, introns, UTRs and coding parts that a site (start_pos, end_pos) meets in its feature (strand, exons array of s, e, cds_start, cds_end).

    Exons count along the strand; rows: the site's columns, part, number.
    """
    return sites.withColumn("hit", F.explode(_met_parts())).select(*sites.columns, "hit.*")


def gene_labels(hits: DataFrame, up5: int = 1000, up3: int = 0, down5: int = 0, down3: int = 0) -> DataFrame:
    """hits (site, gene: see location_class) with a row for each label that holds, the gene's direction taken into account.

    A site reaching less than up5 before the start is upstream, less than up3
    behind the end downstream, and it can be both of these and in the body, all at
    once; farther away it is farup or fardown alone. Where the gene has exons
    (see exon_parts), 5UTR, CDS, exon, intron and 3UTR stand in place of the body.
    """
    minus = F.col("strand") == "-"
    begin, end = F.when(minus, F.col("f_end") - F.col("end_pos")).otherwise(F.col("start_pos") - F.col("f_start")), F.when(minus, F.col("f_end") - F.col("start_pos")).otherwise(F.col("end_pos") - F.col("f_start"))
    size = F.col("f_end") - F.col("f_start")
    meet = size <= down5 + down3 + max(down5, down3)
    margin5, margin3 = (F.when(meet, F.floor(size / 3)).otherwise(m) for m in (down5, down3))
    far = F.when(begin >= size + up3, "fardown").when(end <= -up5, "farup")
    known = F.coalesce(F.size("exons"), F.lit(0)) > 0 if "exons" in hits.columns else F.lit(False)
    near = F.array(
        F.when((begin < size - margin3) & (end > margin5) & ~known, "body"),
        F.when((begin < margin5) & (end > -up5), "upstream") if up5 != -down5 else F.lit(None).cast("string"),
        F.when((begin < size + up3) & (end > size - margin3), "downstream") if up3 != -down3 else F.lit(None).cast("string"),
    )
    labels = F.filter(near, lambda x: x.isNotNull())
    if "exons" in hits.columns:  # a hit's own array, so that no rows are compared to make labels distinct
        parts = F.transform(_met_parts(), lambda x: x["part"])
        labels = F.concat(labels, F.coalesce(F.array_distinct(parts), F.array().cast("array<string>")))
    return hits.withColumn("label", F.explode(F.when(far.isNotNull(), F.array(far)).otherwise(labels)))


def near_only(hits: DataFrame, keys: list[str], label: str = "label") -> DataFrame:
    """hits without the far ones of a site that also has near ones."""
    near = F.max(~F.col(label).startswith("far")).over(W.partitionBy(*keys))
    return hits.withColumn("has_near", near).filter(~F.col("has_near") | ~F.col(label).startswith("far")).drop("has_near")


def best_hit(hits: DataFrame, keys: list[str], letters: str = "U53DEI") -> DataFrame:
    """Per site the hit of first priority, then least distance to the gene's start (tss_dist, signed along the strand), then feature_id."""
    centre = F.floor((F.col("start_pos") + F.col("end_pos")) / 2)
    minus = F.col("strand") == "-"
    raw = centre - F.when(minus, F.col("f_end")).otherwise(F.col("f_start"))
    rows = hits.withColumns({"tss_dist": F.when(minus, -raw).otherwise(raw), "rank": priority(F.col("label"), letters)})
    order = W.partitionBy(*keys).orderBy("rank", F.abs("tss_dist"), "feature_id")
    return rows.withColumn("hit_no", F.row_number().over(order)).filter("hit_no = 1").drop("hit_no", "rank")


def combine_strands(hits: DataFrame, keys: list[str], letters: str = "U53DEI") -> DataFrame:
    """One label per site from the best of each strand: equal ones are marked * (upstream and downstream become bi_...), else the better with its strand."""
    rank = priority(F.col("label"), letters)
    best = {}
    for side, sign in (("top", "+"), ("bot", "-")):
        own = F.when(F.col("strand") == sign, F.struct(rank.alias("rank"), F.when(F.col("label").startswith("far"), "intergenic").otherwise(F.col("label")).alias("label")))
        best[side] = F.min(own).alias(side)
    rows = hits.groupBy(*keys).agg(best["top"], best["bot"], F.min(F.abs("dist")).alias("dist"))
    top, bot = F.coalesce("top.label", F.lit("intergenic")), F.coalesce("bot.label", F.lit("intergenic"))
    both = F.when(top == "intergenic", "intergenic").when(top.isin("upstream", "downstream"), F.concat(F.lit("bi_"), top, F.lit("*"))).otherwise(F.concat(top, F.lit("*")))
    better = F.coalesce(F.col("bot.rank"), F.lit(99)) < F.coalesce(F.col("top.rank"), F.lit(99))
    one = F.when(better, F.concat(bot, F.lit("-"))).otherwise(F.concat(top, F.lit("+")))
    return rows.select(*keys, F.when(top == bot, both).otherwise(one).alias("label"), "dist")


#: Categories that a location also counts for (fixed values).
WIDER = {"cds": ["exon", "body"], "5utr": ["exon", "body"], "3utr": ["exon", "body"], "exon": ["body"], "intron": ["body"]}


def gene_lists(hits: DataFrame, score: str = "score") -> DataFrame:
    """Genes per category (all included): hits, and least, mean and largest score; far and intergenic hits don't count."""
    label = F.lower(F.regexp_replace("label", "(?<=[A-Za-z])[0-9]+$", ""))
    own = hits.filter(~F.col("label").startswith("far") & (F.col("label") != "intergenic")).withColumn("cat", label)
    wider = F.lit(None).cast("array<string>")
    for name, more in WIDER.items():
        wider = F.when(F.col("cat") == name, F.array(*[F.lit(x) for x in more])).otherwise(wider)
    rows = own.withColumn("category", F.explode(F.concat(F.array("cat", F.lit("all")), F.coalesce(wider, F.array().cast("array<string>")))))
    return rows.groupBy("category", "gene").agg(F.count("*").alias("n"), F.min(score).alias("min"), F.avg(score).alias("avg"), F.max(score).alias("max"))


def class_statistics(hits: DataFrame, keys: list[str]) -> DataFrame:
    """Hits per class, whole and as shares of 1 / (number of distinct features of the site). A site's labels come together once, as a list."""
    site = hits.groupBy(*keys).agg(F.size(F.collect_set("feature_id")).alias("n_hits"), F.collect_list("label").alias("labels"))
    each = site.select("n_hits", "labels", F.explode(F.array_distinct("labels")).alias("label"))
    own = F.size(F.filter("labels", lambda x: x == F.col("label")))
    return each.groupBy("label").agg(F.sum(own).alias("n"), F.sum(own * (1.0 / F.col("n_hits"))).alias("weight"), F.count("*").alias("n_sites"))


def feature_summary(hits: DataFrame, labels: list[str]) -> DataFrame:
    """Hits per feature and class, one column per class."""
    return hits.groupBy("feature_id").agg(F.count("*").alias("n"), *[F.count_if(F.col("label") == x).alias(x) for x in labels])


def gene_matrix(hits: DataFrame, labels: list[str]) -> DataFrame:
    """Per gene and class the sites that hit it, `start-end` joined by |, in order."""
    place = F.format_string("%d-%d", "start_pos", "end_pos")
    cells = [F.array_join(F.transform(F.array_sort(F.collect_set(F.when(F.col("label") == x, F.struct("start_pos", "end_pos", place.alias("t"))))), lambda s: s["t"]), "|").alias(x) for x in labels]
    return hits.groupBy("gene").agg(*cells)


#: Classes of the figure table (fixed values).
FIGURE = {"upstream": "promoter", "bi_upstream": "promoter", "5UTR": "5'UTR", "CDS": "exon", "exon": "exon", "3UTR": "3'UTR", "intron": "intron", "body": "intron", "downstream": "downstream", "bi_downstream": "downstream", "farup": "intergenic", "fardown": "intergenic", "intergenic": "intergenic"}


def figure_table(counts: DataFrame) -> DataFrame:
    """Class counts (label, n) regrouped for a figure, with percent."""
    name = F.lit("other")
    for label, group in FIGURE.items():
        name = F.when(F.regexp_replace("label", r"[-+*]$", "") == label, group).otherwise(name)
    out = counts.groupBy(name.alias("part")).agg(F.sum("n").alias("n"))
    return out.withColumn("percent", 100 * F.col("n") / F.sum("n").over(W.partitionBy()))


def lookup_ids(rows: DataFrame, names: DataFrame, keys: list[str], column: str = "ids", keep_unknown: bool = False) -> DataFrame:
    """keys and `symbols`: ids joined by | as names (id, symbol; the largest symbol of an id), in order and once each.

    Parentheses and versions of ids don't count; unknown ids go or stay.
    """
    known = names.groupBy("id").agg(F.max("symbol").alias("symbol"))
    each = rows.select(*keys, F.explode(F.split(column, r"\|")).alias("raw"))
    each = each.withColumn("id", F.regexp_replace(F.regexp_replace("raw", r"\(.*\)", ""), r"\.[0-9]+$", ""))
    found = each.join(known, "id", "left").withColumn("symbol", F.coalesce("symbol", F.col("id")) if keep_unknown else F.col("symbol"))
    return found.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_set("symbol")), "|").alias("symbols"))


def enrichment(hits: DataFrame, background: DataFrame, sets: DataFrame) -> DataFrame:
    """Tests of each set (set_name, gene) among hit genes, within the background (gene).

    n_set, n_overlap, fold; p is the hypergeometric tail, ease the same with one
    hit less (a gentler score that single genes can't carry), bonferroni and q
    (Benjamini and Hochberg) adjust ease over all sets. Sets are as many as a
    table of annotations has, so they may be ranked together.
    """
    from .stats import bh_adjust, upper_hypergeometric

    universe = background.select("gene").distinct()
    inside, chosen = sets.select("set_name", "gene").distinct().join(universe, "gene"), hits.select("gene").distinct().join(universe, "gene")
    n_all, n_hit = universe.count(), chosen.count()
    counts = inside.join(chosen.withColumn("hit", F.lit(1)), "gene", "left").groupBy("set_name").agg(F.count("*").alias("n_set"), F.count("hit").alias("n_overlap"))
    tail = lambda k: upper_hypergeometric(k, F.col("n_set"), F.lit(n_hit), F.lit(n_all))
    fold = F.expr(f"try_divide(n_overlap * cast({n_all} as double), n_set * {n_hit})")
    tested = counts.withColumns({"fold": fold, "p": tail(F.col("n_overlap")), "ease": tail(F.greatest(F.col("n_overlap") - 1, F.lit(0)))})
    tested = tested.withColumn("bonferroni", F.least(F.lit(1.0), F.col("ease") * F.count("*").over(W.partitionBy())))
    return bh_adjust(tested, "ease")


def top_terms(terms: DataFrame, n: int, value: str = "p", label: str = "set_name", width: int = 50) -> DataFrame:
    """The n terms of the least `value`: the label cut to `width` letters, and -log10 of the value (300 for 0)."""
    score = F.when(F.col(value) > 0, -F.log10(value)).otherwise(300.0)
    return terms.filter(F.col(value).isNotNull()).orderBy(value, label).limit(n).select(F.substring(label, 1, width).alias("term"), score.alias("score"))


def running_enrichment(ranked: DataFrame, sets: DataFrame) -> DataFrame:
    """Largest deviation of the running sum of each set along ranked genes (gene, score), weighted by |score|: set_name, n, es."""
    members = sets.join(ranked_genes(ranked), "gene")
    return _enriched(members, ["set_name"], ranked.count()).withColumnRenamed("size", "n")


#: Genes up to which the scores go to every task of the draws (32 MB); beyond it draws are joined with them.
SENT_GENES = 4_000_000
#: Deviations on both sides that differ by less are the same, and the upper one counts.
NOISE = 1e-12
#: Draws that a task makes together.
DRAWS = 50


def drawn_ranks(seed: int, n: int, draw: int, total: int) -> np.ndarray:
    """n distinct ranks (from 1, in order) of `total`, the same wherever they are drawn."""
    return np.sort(np.random.default_rng([seed, n, draw]).choice(total, n, replace=False, shuffle=False)) + 1


def drawn_score(at: np.ndarray, weights: np.ndarray, total: int) -> float:
    """The enrichment score of a set that lies at these ranks, with these |score|."""
    upto, all_of = np.cumsum(weights), weights.sum()
    missed = (at - np.arange(1, len(at) + 1)) / (total - len(at))
    hi, lo = (upto / all_of - missed).max(), ((upto - weights) / all_of - missed).min()
    return float(hi if hi >= -lo - NOISE else lo)


def _drawn(ranked: DataFrame, sizes: DataFrame, total: int, draws: int, seed: int) -> DataFrame:
    """(n, draw, es) of `draws` random sets of each size. Sets of one size share them, as only their size matters."""
    spark, schema = ranked.sparkSession, "n long, draw int, at long"
    blocks = sizes.select("n", F.explode(F.sequence(F.lit(0), F.lit(draws - 1), F.lit(DRAWS))).alias("first")).repartition("n", "first")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
        for batch in batches:
            for n, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for draw in range(first, min(first + DRAWS, draws)):
                    yield n, draw, drawn_ranks(seed, n, draw, total)

    if total <= SENT_GENES:
        table = ranked.select("at", F.abs("score").alias("weight")).toPandas()
        weights = np.zeros(total)
        weights[table["at"].to_numpy() - 1] = table["weight"]
        sent = spark.sparkContext.broadcast(weights)

        def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for n, draw, at in each(batches):
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "draw": pa.array([draw], pa.int32()), "es": [drawn_score(at, sent.value[at - 1], total)]})

        return blocks.mapInArrow(scores, "n long, draw int, es double")

    def ranks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for n, draw, at in each(batches):
            yield pa.RecordBatch.from_pydict({"n": pa.array([n] * n, pa.int64()), "draw": pa.array([draw] * n, pa.int32()), "at": pa.array(at, pa.int64())})

    members = blocks.mapInArrow(ranks, schema).join(ranked.select("at", "score"), "at")
    return _enriched(members, ["n", "draw"], total).select("n", "draw", "es")


def _enriched(members: DataFrame, key: list[str], total: int) -> DataFrame:
    """(key, n, es) of sets whose members have a rank `at` and a score."""
    by = W.partitionBy(*key)
    order = by.orderBy("at")
    rows = members.withColumns({"size": F.count("*").over(by), "weight": F.sum(F.abs("score")).over(by), "k": F.row_number().over(order), "upto": F.sum(F.abs("score")).over(order)})
    missed = (F.col("at") - F.col("k")) / (total - F.col("size"))
    peak, dip = F.col("upto") / F.col("weight") - missed, (F.col("upto") - F.abs("score")) / F.col("weight") - missed
    best = rows.groupBy(*key, "size").agg(F.max(peak).alias("hi"), F.min(dip).alias("lo"))
    return best.select(*key, "size", F.when(F.col("hi") >= -F.col("lo") - NOISE, F.col("hi")).otherwise(F.col("lo")).alias("es"))


def ranked_genes(ranked: DataFrame) -> DataFrame:
    """ranked (gene, score) with `at`, the rank from 1 by falling score, ties by gene; counted in ranges of the score."""
    from .stats import ranges

    parts, sizes = ranges(ranked.select("gene", "score"), "score", "gene", descending=True)
    return parts.join(sizes, "part").select("gene", "score", (F.col("before") + F.row_number().over(W.partitionBy("part").orderBy(F.desc("score"), "gene"))).alias("at"))


def permuted_enrichment(ranked: DataFrame, sets: DataFrame, draws: int = 1000, seed: int = 1, least: int = 1, most: int = 500) -> DataFrame:
    """Sets (set_name, gene) of `least` to `most` ranked genes along ranked (gene, score): set_name, n, es, nes, p, q.

    es is the largest deviation of the running sum; random sets of the same size
    give its chance p among draws of the same sign (null without any) and nes,
    es over their mean. q is the share of random nes as far out or farther, each
    size as often as it occurs, over the share of sets as far out, on the same side.
    """
    place = stored(ranked_genes(ranked), "ranked-genes")
    total = place.count()
    members = sets.select("set_name", "gene").distinct().join(place, "gene")
    even = lambda scores: scores.withColumn("es", F.round("es", 12))  # so that ties are ties, however they were added up
    found = stored(even(_enriched(members, ["set_name"], total)).withColumnRenamed("size", "n").filter(F.col("n").between(least, min(most, total - 1))), "sets")
    side = F.when(F.col("es") >= 0, 1).otherwise(-1)
    sizes = found.groupBy("n").agg(F.count("*").alias("times"))
    drawn = stored(even(_drawn(place, sizes.select("n"), total, draws, seed)).withColumn("side", side), "draws")
    of_size = drawn.groupBy("n", "side").agg(F.avg(F.abs("es")).alias("mean"), F.count("*").alias("n_drawn"), F.collect_list(F.abs("es")).alias("all"))
    tested = found.withColumn("side", side).join(of_size, ["n", "side"], "left")
    p = F.size(F.filter("all", lambda x: x >= F.abs("es"))) / F.col("n_drawn")
    tested = stored(tested.select("set_name", "n", "es", "side", F.try_divide("es", "mean").alias("nes"), p.alias("p")), "tested-sets")
    return _pooled_q(tested, drawn.join(of_size.select("n", "side", "mean"), ["n", "side"]).join(sizes, "n").select("side", F.abs(F.try_divide("es", "mean")).alias("far"), F.col("times").alias("weight")))


def _pooled_q(tested: DataFrame, drawn: DataFrame) -> DataFrame:
    """tested with q: shares of drawn and of tested as far out, from counts per range of distance and order within it."""
    from .stats import ranges

    both = stored(drawn.select("side", "far", "weight", F.lit(0).alias("one")).unionByName(tested.select("side", F.abs("nes").alias("far"), F.lit(0).cast("long").alias("weight"), F.lit(1).alias("one"))).filter("far IS NOT NULL"), "pooled")
    parts, _ = ranges(both, "far", descending=True)
    sums = parts.groupBy("side", "part").agg(F.sum("weight").alias("w"), F.sum("one").alias("o"))
    line = W.partitionBy("side").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    before = {f"{c}_before": F.coalesce(F.sum(c).over(line), F.lit(0)) for c in "wo"} | {f"{c}_all": F.sum(c).over(W.partitionBy("side")) for c in "wo"}
    inside = W.partitionBy("side", "part").orderBy(F.desc("far"))
    rows = parts.groupBy("side", "part", "far").agg(F.sum("weight").alias("weight"), F.sum("one").alias("one"))
    rows = rows.withColumns({"w_in": F.sum("weight").over(inside), "o_in": F.sum("one").over(inside)}).filter("one > 0").join(sums.withColumns(before), ["side", "part"])
    share = lambda c: (F.col(f"{c}_before") + F.col(f"{c}_in")) / F.col(f"{c}_all")
    q = rows.select("side", "far", F.least(F.lit(1.0), F.try_divide(share("w"), share("o"))).alias("q"))
    return tested.withColumn("far", F.abs("nes")).join(q, ["side", "far"], "left").select("set_name", "n", "es", "nes", "p", "q")
