"""Methylation sites: calls to counts, filters, merges, groups and differences.

A site row has ref, start_pos, end_pos (0-based, half open), cov and m, often
with sample and grp. Levels are m / cov and are derived, never stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def level(m: str = "m", cov: str = "cov") -> Column:
    """Share of methylated reads; null without coverage."""
    return F.expr(f"try_divide(cast({m} as double), {cov})")


def filter_sites(sites: DataFrame, min_cov: int = 1, positions: DataFrame | None = None, exclude: bool = False) -> DataFrame:
    """Sites with enough coverage, and on (or, with `exclude`, off) a list of ref, start_pos."""
    kept = sites.filter(F.col("cov") >= min_cov)
    if positions is None:
        return kept
    return kept.join(positions.select("ref", "start_pos").distinct(), ["ref", "start_pos"], "left_anti" if exclude else "left_semi")


def pileup(calls: DataFrame, min_quality: int = 0, by: tuple[str, ...] = ("ref", "pos")) -> DataFrame:
    """Methylated and other reads and their base qualities for each position; score is -1 without any."""
    counted = calls.filter(F.col("baseq") >= min_quality).groupBy(*by)
    both = counted.agg(
        F.sum("meth").cast("long").alias("m"),
        F.sum(1 - F.col("meth")).cast("long").alias("u"),
        F.sum(F.col("meth") * F.col("baseq")).cast("long").alias("mqual"),
        F.sum((1 - F.col("meth")) * F.col("baseq")).cast("long").alias("uqual"),
    )
    return both.withColumns({"score": F.coalesce(F.expr("try_divide(cast(m as double), m + u)"), F.lit(-1.0)), "qscore": F.coalesce(F.expr("try_divide(cast(mqual as double), mqual + uqual)"), F.lit(-1.0))})


def merge_palindromes(sites: DataFrame) -> DataFrame:
    """Both strands of a palindromic site in one row; the strand is '.' where two were merged."""
    strand = F.when(F.count_distinct("strand") > 1, F.lit(".")).otherwise(F.min("strand"))
    return sites.groupBy("ref", "start_pos").agg(F.max("end_pos").alias("end_pos"), F.sum("cov").alias("cov"), F.sum("m").alias("m"), strand.alias("strand"))


def merge_tracks(sites: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Replicates or a group in one track: reads add up, levels follow; negative starts are left out."""
    merged = sites.filter("start_pos >= 0").groupBy(*by, "ref", "start_pos")
    return merged.agg(F.max("end_pos").alias("end_pos"), F.sum("cov").alias("cov"), F.sum("m").alias("m")).withColumn("pct", level())


def group_levels(sites: DataFrame, membership: DataFrame) -> DataFrame:
    """Mean of the samples' levels, and sums of reads, per group; a sample may be in several groups, repeats don't count."""
    rows = sites.filter("cov > 0").join(membership.select("sample", "grp").distinct(), "sample")
    return rows.groupBy("ref", "start_pos", "grp").agg(F.avg(level()).alias("mean_pct"), F.sum("m").alias("m"), F.sum("cov").alias("cov"), F.count("*").alias("n_samples"))


def group_windows(windows: DataFrame, membership: DataFrame) -> DataFrame:
    """Windows per group: most CpGs, sums of reads, means of the samples' means and deviations."""
    rows = windows.join(membership.select("sample", "grp").distinct(), "sample")
    sums = [F.max("n_cpg").alias("n_cpg"), F.sum("m").alias("m"), F.sum("cov").alias("cov"), F.avg("mean_pct").alias("mean_pct"), F.avg("sd_pct").alias("sd_pct")]
    return rows.groupBy("ref", "w_start", "w_end", "grp").agg(*sums)


def differences(levels: DataFrame, pairs: DataFrame, key: str = "sample", value: str = "pct") -> DataFrame:
    """value of the pair's first less that of its second, per ref and start_pos; null where one of them lacks."""
    long = levels.select("ref", "start_pos", F.col(key).alias("who"), F.col(value).alias("value"))
    small = pairs.select("a", "b")
    sides = long.join(small, (F.col("who") == F.col("a")) | (F.col("who") == F.col("b")))
    first, second = F.max(F.when(F.col("who") == F.col("a"), F.col("value"))), F.max(F.when(F.col("who") == F.col("b"), F.col("value")))
    return sides.groupBy("ref", "start_pos", "a", "b").agg((first - second).alias("diff"))


def pair_difference(sites: DataFrame, pairs: DataFrame, legacy_rounding: bool = False) -> DataFrame:
    """Sites that both samples of a pair have: least coverage, difference of levels, and that many reads.

    legacy_rounding cuts toward zero after adding 0.5, as the format's other
    writers do; otherwise halves go away from zero.
    """
    long = sites.select("ref", "start_pos", "end_pos", "sample", "cov", level().alias("pct"))
    first = long.join(pairs.select("a", "b"), F.col("sample") == F.col("a")).drop("sample")
    second = long.select("ref", "start_pos", F.col("sample").alias("b"), F.col("cov").alias("cov_b"), F.col("pct").alias("pct_b"))
    both = first.join(second, ["ref", "start_pos", "b"])
    both = both.select("ref", "start_pos", "end_pos", "a", "b", F.least("cov", "cov_b").alias("cov"), (F.col("pct") - F.col("pct_b")).alias("diff"))
    reads = F.col("cov") * F.col("diff")
    return both.withColumn("m", (reads + 0.5).cast("long") if legacy_rounding else F.round(reads).cast("long"))


def hydroxy(sites: DataFrame, pairs: DataFrame, protocol: str) -> DataFrame:
    """5mC and 5hmC tracks of pairs (a total, b the treated sample); which one the difference is depends on the protocol, tab or oxbs."""
    if protocol not in ("tab", "oxbs"):
        raise ValueError("protocol is tab or oxbs")
    diff, own = ("5mC", "5hmC") if protocol == "tab" else ("5hmC", "5mC")
    subtracted = pair_difference(sites, pairs).select("ref", "start_pos", F.concat_ws("-", "a", "b").alias("sample"), F.lit(diff).alias("mark"), "cov", F.col("diff").alias("pct"))
    treated = sites.join(pairs.select("a", "b"), F.col("sample") == F.col("b"))
    return subtracted.unionByName(treated.select("ref", "start_pos", F.concat_ws("-", "a", "b").alias("sample"), F.lit(own).alias("mark"), "cov", level().alias("pct")))


def merge_pairs(first: DataFrame, second: DataFrame, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """Tracks of first and second mates, whose samples have the same name, as one track each."""
    return merge_tracks(first.unionByName(second), by)


def merge_products(inputs: dict[str, DataFrame], products: tuple[str, ...] = ("bed", "sum"), by: tuple[str, ...] = ("grp",)) -> dict[str, DataFrame]:
    """The chosen products of a merge: bed (tracks, by group) and sum (mapping summaries); others of `inputs` are left alone."""
    from .alignment import merge_summaries

    makers = {"bed": lambda df: merge_tracks(df, by), "sum": merge_summaries}
    return {name: makers[name](inputs[name]) for name in products if name in inputs}


def target_positions(targets: DataFrame, counts: DataFrame | None = None, depth: int = 0) -> DataFrame:
    """Distinct places of interest (ref, start_pos), with `counts` those alone that some track covers `depth` times."""
    places = targets.select("ref", "start_pos").distinct()
    if counts is None or depth <= 0:
        return places
    return places.join(counts.filter(F.col("cov") >= depth).select("ref", "start_pos").distinct(), ["ref", "start_pos"], "left_semi")


def ranked_list(rows: DataFrame, name: str, score: str) -> DataFrame:
    """Name and score alone, largest first, as rank-based tools read them; rows without a score are left out."""
    return rows.filter(F.col(score).isNotNull()).select(F.col(name).alias("name"), F.col(score).alias("score")).orderBy(F.desc("score"), "name")
