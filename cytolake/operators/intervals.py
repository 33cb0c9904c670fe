"""Interval operators: joins over bins, nearest features, sliding windows, islands.

Coordinates are 0-based and half open.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.tables import dealt_out

BIN = 10_000
#: Positions of a reference that are put in order together.
BLOCK = 1 << 20


def grid(low: Column, high: Column) -> Column:
    """low..high as an array, empty if high < low (where sequence() would count down)."""
    return F.when(high >= low, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))


def div(value: Column, by: int) -> Column:
    """Integer division toward zero."""
    return (value / by).cast("long")


def interval_join(points: DataFrame, intervals: DataFrame, inclusive: bool = True, size: int = BIN) -> DataFrame:
    """points (ref, start_pos) joined with the intervals (ref, f_start, f_end) that hold them.

    Intervals are laid out over bins and meet the points on (ref, bin), so the
    join stays an equi-join on a key that spreads large chromosomes; a point is
    in one bin alone, so no pair comes twice. Parts are as many as the points'
    files ask for (see dealt_out), as a part is put in order in one task.
    """
    spread = intervals.withColumn("bin", F.explode(F.sequence(F.floor(F.col("f_start") / size), F.floor(F.col("f_end") / size))))
    inside = (F.col("start_pos") <= F.col("f_end")) if inclusive else (F.col("start_pos") < F.col("f_end"))
    binned = dealt_out(points.withColumn("bin", F.floor(F.col("start_pos") / size)), "ref", "bin")
    return binned.join(spread, ["ref", "bin"]).filter((F.col("start_pos") >= F.col("f_start")) & inside).drop("bin")


def overlap_join(left: DataFrame, right: DataFrame, size: int = BIN) -> DataFrame:
    """Pairs of (ref, start_pos, end_pos) and (ref, f_start, f_end) that overlap; each in the bin where the later one begins."""
    a = left.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start_pos") / size), F.floor((F.col("end_pos") - 1) / size))))
    b = right.filter("f_end > f_start").withColumn("bin", F.explode(F.sequence(F.floor(F.col("f_start") / size), F.floor((F.col("f_end") - 1) / size))))
    meet = (F.col("start_pos") < F.col("f_end")) & (F.col("f_start") < F.col("end_pos"))
    once = F.col("bin") == F.floor(F.greatest("start_pos", "f_start") / size)
    return a.join(b, ["ref", "bin"]).filter(meet & once).drop("bin")


def distance(start: str = "start_pos", end: str = "end_pos") -> Column:
    """0 if they overlap; else start less the feature's end plus 1 (feature on the left), or end less its start less 1 (negative: on the right)."""
    s, e = F.col(start), F.col(end)
    return F.when((s < F.col("f_end")) & (F.col("f_start") < e), 0).when(F.col("f_end") <= s, s - F.col("f_end") + 1).otherwise(e - F.col("f_start") - 1)


def _blocks(rows: DataFrame, by: list[str], at: str, size: int) -> DataFrame:
    """rows with the block of `size` positions that holds `at`, the unit in which ordered work is dealt out."""
    return rows.withColumn("block", F.floor(F.col(at) / size))


def nearest_bounds(queries: DataFrame, features: DataFrame, by: list[str], size: int = BLOCK) -> DataFrame:
    """queries (by, start_pos, end_pos) with left_end, the largest f_end up to start_pos, and right_start, the least f_start from end_pos on.

    Ordered within blocks of positions; of other blocks only the last end before
    and the first start behind are carried, a row per block.
    """
    none = F.lit(None).cast("long")
    ends = features.select(*by, F.col("f_end").cast("long").alias("at"), F.col("f_end").cast("long").alias("mark"), none.alias("other"), F.lit(0).alias("kind"))
    starts = features.select(*by, F.col("f_start").cast("long").alias("at"), F.col("f_start").cast("long").alias("mark"), none.alias("other"), F.lit(2).alias("kind"))
    left = queries.select(*by, F.col("start_pos").cast("long").alias("at"), none.alias("mark"), F.col("end_pos").cast("long").alias("other"), F.lit(1).alias("kind"))
    right = queries.select(*by, F.col("end_pos").cast("long").alias("at"), none.alias("mark"), F.col("start_pos").cast("long").alias("other"), F.lit(1).alias("kind"))

    def nearest(line: DataFrame, agg, towards, name: str) -> DataFrame:
        # frames that grow are added to row by row; those that shrink would be computed anew for each row
        frame, order = (W.unboundedPreceding, -1), [towards("at"), towards("kind")]
        rows = _blocks(line, by, "at", size)
        carried = rows.groupBy(*by, "block").agg(agg("mark").alias("own"))
        whole = W.partitionBy(*by).orderBy(towards("block")).rowsBetween(*frame)
        carried = carried.withColumn("carried", agg("own").over(whole)).drop("own")
        inside = agg("mark").over(W.partitionBy(*by, "block").orderBy(*order).rowsBetween(*frame))
        return rows.withColumn("inside", inside).filter("kind = 1").join(carried, [*by, "block"]).select(*by, "at", "other", F.coalesce("inside", "carried").alias(name))

    lefts = nearest(left.unionByName(ends), F.max, F.asc, "left_end").withColumnsRenamed({"at": "start_pos", "other": "end_pos"})
    rights = nearest(right.unionByName(starts), F.min, F.desc, "right_start").withColumnsRenamed({"at": "end_pos", "other": "start_pos"})
    return lefts.join(rights, [*by, "start_pos", "end_pos"])


def nearest_join(queries: DataFrame, features: DataFrame, allow: int = 0, stranded: bool = False, size: int = BIN) -> DataFrame:
    """queries (ref, start_pos, end_pos) with their nearest features (ref, f_start, f_end, strand, ...) and `dist`, all ties and all within `allow`.

    Features within `allow` (0: those that overlap) come from a join over bins.
    A query without one takes the features that end at its nearest end on the
    left or start at its nearest start on the right: two equi-joins, however
    far away they are. `stranded` treats strands apart. Repeated queries count once.
    """
    by = ["ref", "strand"] if stranded else ["ref"]
    asked = queries.select("ref", "start_pos", "end_pos").distinct()
    key = [*by, "start_pos", "end_pos"]
    wide = asked.select("ref", F.col("start_pos").alias("q_start"), F.col("end_pos").alias("q_end"), (F.col("start_pos") - allow - int(allow > 0)).alias("start_pos"), (F.col("end_pos") + allow + int(allow > 0)).alias("end_pos"))
    near = overlap_join(wide, features, size).drop("start_pos", "end_pos").withColumnsRenamed({"q_start": "start_pos", "q_end": "end_pos"})
    near = near.withColumn("dist", distance().cast("long")).filter(F.abs("dist") <= allow)
    if stranded:
        asked = asked.crossJoin(F.broadcast(features.select("strand").distinct()))  # two or three rows
    bounds = nearest_bounds(asked.join(near.select(*key).distinct(), key, "left_anti"), features, by)
    to_left, to_right = F.col("start_pos") - F.col("left_end") + 1, F.col("right_start") - F.col("end_pos") + 1
    bounds = bounds.withColumn("reach", F.least(to_left, to_right))
    left = bounds.filter(to_left == F.col("reach")).select(*key, F.col("left_end").alias("f_end")).join(features, [*by, "f_end"])
    right = bounds.filter(to_right == F.col("reach")).select(*key, F.col("right_start").alias("f_start")).join(features, [*by, "f_start"])
    names = [c for c in near.columns if c != "dist"]
    far = left.select(*names).unionByName(right.filter("f_start >= end_pos").select(*names)).withColumn("dist", distance().cast("long"))
    return near.unionByName(far)


def sliding_windows(sites: DataFrame, width: int, step: int) -> DataFrame:
    """A row per site and window [w_start, w_end) of a grid of `step`; none where the grid leaves a gap."""
    low = F.greatest(F.lit(0).cast("long"), div(F.col("start_pos") + step - width, step))
    high = div(F.col("end_pos") - 2, step)
    rows = sites.withColumn("p", F.explode(grid(low, high)))
    return rows.withColumns({"w_start": F.col("p") * step, "w_end": F.col("p") * step + width}).drop("p")


def window_summary(rows: DataFrame, by: list[str]) -> DataFrame:
    """CpGs, reads, mean and population deviation of levels."""
    pct = F.col("m").cast("double") / F.col("cov")
    return rows.groupBy(*by).agg(F.count("*").alias("n_cpg"), F.sum("m").alias("m"), F.sum("cov").alias("cov"), F.avg(pct).alias("mean_pct"), F.stddev_pop(pct).alias("sd_pct"))


def genome_windows(sites: DataFrame, width: int, step: int, by: tuple[str, ...] = ("sample",)) -> DataFrame:
    """window_summary over sliding windows, per sample."""
    return window_summary(sliding_windows(sites.filter("cov > 0"), width, step), [*by, "ref", "w_start", "w_end"])


def feature_windows(features: DataFrame, width: int, step: int, part: str = "body", flank: int = 1000) -> DataFrame:
    """Windows (f_start, f_end) laid over each feature's body, upstream or downstream side by strand, as long as their centre lies inside."""
    if part not in ("body", "up", "down"):
        raise ValueError("part is body, up or down")
    before = F.lit(part == "up") & (F.col("strand") != "-") | F.lit(part == "down") & (F.col("strand") == "-")
    after = F.lit(part == "up") & (F.col("strand") == "-") | F.lit(part == "down") & (F.col("strand") != "-")
    reach = int((flank - width / 2) / step) * step
    left = F.when(before, F.col("f_start") - width - reach).when(after, F.col("f_end")).otherwise(F.col("f_start"))
    right = F.when(before, F.col("f_start")).when(after, F.col("f_end") + flank).otherwise(F.col("f_end"))
    # left + i * step + width / 2 < right
    last = F.ceil((right - left - width / 2) / step) - 1
    rows = features.withColumns({"left": left.cast("long"), "last": last.cast("long")}).withColumn("i", F.explode(grid(F.lit(0).cast("long"), F.col("last"))))
    return rows.withColumns({"f_start": F.col("left") + F.col("i") * step, "f_end": F.col("left") + F.col("i") * step + width}).drop("left", "last", "i")


def depth_islands(spans: DataFrame, by: tuple[str, ...] = ("ref",), size: int = BLOCK) -> DataFrame:
    """Runs of equal depth above 0 under (start_pos, end_pos): changes at the ends, a running sum, and runs between changes.

    Sums run within blocks of positions and go on from what the blocks before add up to.
    """
    changes = spans.select(*by, F.col("start_pos").alias("at"), F.lit(1).alias("step")).unionByName(spans.select(*by, F.col("end_pos").alias("at"), F.lit(-1).alias("step")))
    steps = _blocks(changes.groupBy(*by, "at").agg(F.sum("step").alias("step")).filter("step <> 0"), list(by), "at", size)
    line, order = W.partitionBy(*by).orderBy("block"), W.partitionBy(*by, "block").orderBy("at")
    sums = steps.groupBy(*by, "block").agg(F.sum("step").alias("sum"), F.min("at").alias("first"))
    sums = sums.select(*by, "block", F.coalesce(F.sum("sum").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"), F.lead("first").over(line).alias("next"))
    runs = steps.withColumns({"inside": F.sum("step").over(order), "end_pos": F.lead("at").over(order)}).join(sums, [*by, "block"])
    runs = runs.withColumns({"depth": F.col("before") + F.col("inside"), "end_pos": F.coalesce("end_pos", "next")})
    return runs.filter("depth > 0").select(*by, F.col("at").alias("start_pos"), "end_pos", "depth")


def numbered_islands(sites: DataFrame, gap: int, by: tuple[str, ...] = ("ref",), size: int = BLOCK) -> DataFrame:
    """Distinct sites (by, start_pos, end_pos) with the number of their run of sites no more than `gap` apart.

    As in depth_islands, blocks hand on their last site and how many runs began in them.
    """
    rows = _blocks(sites.select(*by, "start_pos", "end_pos").distinct(), list(by), "start_pos", size)
    line, order = W.partitionBy(*by).orderBy("block"), W.partitionBy(*by, "block").orderBy("start_pos", "end_pos")
    last = rows.groupBy(*by, "block").agg(F.max("start_pos").alias("last")).select(*by, "block", F.lag("last").over(line).alias("before"))
    rows = rows.withColumn("lag", F.lag("start_pos").over(order)).join(last, [*by, "block"])
    rows = rows.withColumn("new", F.coalesce((F.col("start_pos") - F.coalesce("lag", "before") > gap).cast("int"), F.lit(0)))
    began = rows.groupBy(*by, "block").agg(F.sum("new").alias("new")).select(*by, "block", F.coalesce(F.sum("new").over(line.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("began"))
    runs = rows.withColumn("inside", F.sum("new").over(order)).join(began, [*by, "block"])
    return runs.select(*by, "start_pos", "end_pos", (F.col("began") + F.col("inside")).alias("island"))


def site_islands(sites: DataFrame, gap: int, by: tuple[str, ...] = ("ref",), size: int = BLOCK) -> DataFrame:
    """Runs of sites no more than `gap` apart: start, end and number of sites."""
    runs = numbered_islands(sites, gap, by, size).groupBy(*by, "island")
    return runs.agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("n_sites")).drop("island")
