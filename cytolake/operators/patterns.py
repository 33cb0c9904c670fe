"""Read patterns and their entropy, within windows of a fixed grid.

Windows are [w_start, w_start + width) in 1-based positions. A read's pattern
has a character per site of the window: its state, or '-' where the read has
none. The grid is fixed, so a window does not depend on where others end.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.tables import dealt_out, stored

WINDOW = ["ref", "w_start"]


def windowed_calls(calls: DataFrame, width: int, step: int | None = None) -> DataFrame:
    """calls (read_id, ref, pos, meth) with the windows that hold them."""
    step = step or width
    last = ((F.col("pos") - 1) / step).cast("long")
    first = F.greatest(F.lit(0).cast("long"), ((F.col("pos") - 1 - width + step) / step).cast("long"))
    rows = calls.withColumn("p", F.explode(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))))
    return rows.withColumn("w_start", F.col("p") * step + 1).drop("p")


def read_patterns(calls: DataFrame, width: int, step: int | None = None, state: str = "meth") -> DataFrame:
    """Per window: positions, and reads per pattern (ref, w_start, positions, pattern, n). Repeated calls of a read at a place give the larger state.

    Reads alike in all calls of a window are one row with a count before the
    window's reads meet, so a window is as large as its patterns, not its reads.
    """
    calls = windowed_calls(calls, width, step).select(*WINDOW, "read_id", "pos", state).repartition(*WINDOW, "read_id")  # dealt out once for both groupings
    rows = calls.groupBy(*WINDOW, "read_id", "pos").agg(F.max(state).cast("string").alias("state"))
    reads = rows.groupBy(*WINDOW, "read_id").agg(F.sort_array(F.collect_list(F.struct("pos", "state"))).alias("marks"))
    alike = reads.groupBy(*WINDOW, "marks").agg(F.count("*").alias("n"))
    sites = alike.select(*WINDOW, F.explode("marks.pos").alias("pos")).groupBy(*WINDOW).agg(F.sort_array(F.collect_set("pos")).alias("positions"))
    known = alike.select(*WINDOW, F.map_from_entries("marks").alias("marks"), "n")
    text = F.array_join(F.transform("positions", lambda p: F.coalesce(F.element_at("marks", p), F.lit("-"))), "")
    return known.join(sites, WINDOW).groupBy(*WINDOW, "positions", text.alias("pattern")).agg(F.sum("n").alias("n"))


def entropy(patterns: DataFrame, min_sites: int = 1, min_reads: int = 1) -> DataFrame:
    """Per window: sites, reads, patterns, entropy (bits per site) and mean level over all called sites."""
    ones = F.length(F.regexp_replace("pattern", "[^1]", ""))
    called = F.length(F.regexp_replace("pattern", "-", ""))
    total = F.sum("n").over(W.partitionBy(*WINDOW))
    rows = patterns.withColumns({"n_reads": total, "n_sites": F.size("positions"), "ones": ones * F.col("n"), "called": called * F.col("n")})
    share = F.col("n") / F.col("n_reads")
    out = rows.groupBy(*WINDOW, "n_sites", "n_reads").agg(F.count("*").alias("n_patterns"), (-F.sum(share * F.log(share))).alias("nats"), (F.sum("ones") / F.sum("called")).alias("mean_level"))
    out = out.withColumn("entropy", F.col("nats") / F.col("n_sites") / F.log(F.lit(2.0))).drop("nats")
    return out.filter((F.col("n_sites") >= min_sites) & (F.col("n_reads") >= min_reads))


def joint_entropy(calls: DataFrame, width: int, min_sites: int = 1, min_reads: int = 1) -> DataFrame:
    """Entropy over patterns of several site types (calls have `type`), for windows with enough sites of each; a state is type * 2 + meth."""
    n_types = calls.select("type").distinct()
    sites = windowed_calls(calls, width).select(*WINDOW, "type", "pos").distinct().groupBy(*WINDOW, "type").agg(F.count("*").alias("n"))
    enough = sites.filter(F.col("n") >= min_sites).groupBy(*WINDOW).agg(F.count("*").alias("n_types"))
    enough = enough.join(F.broadcast(n_types.agg(F.count("*").alias("n_types"))), "n_types", "left_semi").select(*WINDOW)
    patterns = read_patterns(calls.withColumn("state", F.col("type") * 2 + F.col("meth")), width, state="state")
    return entropy(patterns.join(enough, WINDOW, "left_semi"), 1, min_reads).drop("mean_level")


def restricted(patterns: DataFrame, positions: DataFrame) -> DataFrame:
    """Patterns cut to the positions of another table (ref, w_start, keep); those that become equal add up."""
    both = patterns.join(positions, WINDOW)
    places = F.filter(F.sequence(F.lit(1), F.size("positions")), lambda i: F.array_contains("keep", F.element_at("positions", i)))
    cut = F.array_join(F.transform(places, lambda i: F.substring(F.col("pattern"), i, F.lit(1))), "")
    both = both.select(*WINDOW, F.col("keep").alias("kept"), cut.alias("part"), "n", "total")
    return both.groupBy(*WINDOW, "kept", "part").agg(F.sum("n").alias("n"), F.max("total").alias("total")).withColumnsRenamed({"kept": "positions", "part": "pattern"})


def relative_entropy(a: DataFrame, b: DataFrame) -> DataFrame:
    """Divergence (nats) of a's pattern shares from b's over common sites and patterns, with chi-squared of the common patterns.

    Shares are of all reads of a window, before patterns without common sites
    go. Windows without a common site or pattern have null divergence.
    """
    sides = []
    for name, side in (("a", a), ("b", b)):
        sides.append(side.withColumn("total", F.sum("n").over(W.partitionBy(*WINDOW))).withColumn("side", F.lit(name)))
    places = sides[0].select(*WINDOW, F.col("positions").alias("p1")).distinct().join(sides[1].select(*WINDOW, F.col("positions").alias("p2")).distinct(), WINDOW)
    places = places.select(*WINDOW, F.sort_array(F.array_intersect("p1", "p2")).alias("keep"))
    cut_a, cut_b = (restricted(s, places).withColumn("pattern", F.col("pattern")) for s in sides)
    both = cut_a.select(*WINDOW, "pattern", F.col("n").alias("na"), F.col("total").alias("ta")).join(cut_b.select(*WINDOW, "pattern", F.col("n").alias("nb"), F.col("total").alias("tb")), [*WINDOW, "pattern"])
    both = both.filter(F.col("pattern") != "").withColumns({"sa": F.sum("na").over(W.partitionBy(*WINDOW)), "sb": F.sum("nb").over(W.partitionBy(*WINDOW))})
    share = F.col("na") / F.col("ta")
    e = (F.col("na") + F.col("nb")) / (F.col("sa") + F.col("sb"))
    cell = (F.col("na") - F.col("sa") * e) ** 2 / (F.col("sa") * e) + (F.col("nb") - F.col("sb") * e) ** 2 / (F.col("sb") * e)
    found = both.groupBy(*WINDOW).agg(F.count("*").alias("n_common"), F.sum(share * F.log(share * F.col("tb") / F.col("nb"))).alias("divergence"), F.sum(cell).alias("chi2"))
    return places.select(*WINDOW, F.size("keep").alias("n_sites")).join(found, WINDOW, "left").withColumn("n_common", F.coalesce("n_common", F.lit(0)))


def spanning_intervals(calls: DataFrame, read_length: int) -> DataFrame:
    """Intervals from a read's first site to the last of a read, no longer than a read (ref, start_pos, end_pos), with the reads that span them."""
    ends = calls.groupBy("ref", "read_id").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"))
    block = F.floor(F.col("p") / read_length)
    starts = ends.select("ref", F.col("lo").alias("p")).distinct().withColumn("block", F.explode(F.array(block, block + 1)))
    stops = ends.select("ref", F.col("hi").alias("q")).distinct().withColumn("block", F.floor(F.col("q") / read_length))
    pairs = starts.join(stops, ["ref", "block"]).filter((F.col("p") < F.col("q")) & (F.col("q") <= F.col("p") + read_length)).select("ref", "p", "q")
    binned = ends.withColumn("block", F.explode(F.sequence(F.floor(F.col("lo") / read_length), F.floor(F.col("hi") / read_length))))
    spans = pairs.withColumn("block", F.floor(F.col("p") / read_length)).join(binned, ["ref", "block"]).filter("lo <= p AND q <= hi")
    return spans.groupBy("ref", F.col("p").alias("start_pos"), F.col("q").alias("end_pos")).agg(F.count("*").alias("n_reads"))


def interval_patterns(calls: DataFrame, read_length: int, min_sites: int = 4, depth: int = 4, quality: int = 0, by: tuple[str, ...] = ("ref",)) -> DataFrame:
    """Epiallele patterns of the intervals from a read's first site to a read's last, no longer than a read.

    calls: read_id, pos, meth, `by` (reference, strand) and, if there is a
    least `quality`, baseq; a call below it is none, though its place can still begin or
    end a read. A site counts where `depth` reads or more are called; an interval needs
    `min_sites` of them, and `depth` reads called at both of its ends. Those are its
    reads: they give the number of sites with more than one state (n_changed) and,
    with `min_sites` calls or more, the patterns (a character a site, '-' for none).

    Reads alike in all calls are one row with a count, met by the intervals that
    begin at one of their sites; sites come as an array for each stretch of a
    read's length, so neither reads nor sites are spread over intervals.
    """
    keys, state = list(by), F.max("meth")
    if quality:
        state = F.max(F.when(F.col("baseq") >= quality, F.col("meth")))
    marks = dealt_out(calls, *keys, "read_id").groupBy(*keys, "read_id", "pos").agg(state.cast("string").alias("state"))
    reads = marks.groupBy(*keys, "read_id").agg(F.sort_array(F.collect_list(F.struct("pos", "state"))).alias("marks"))
    alike = reads.groupBy(*keys, "marks").agg(F.count("*").alias("n"))

    lows, highs = (alike.select(*keys, F.element_at("marks", i)["pos"].alias("p")).distinct() for i in (1, -1))
    block = F.floor(F.col("p") / read_length)
    pairs = lows.withColumn("block", F.explode(F.array(block, block + 1))).join(highs.select(*keys, F.col("p").alias("q"), block.alias("block")), [*keys, "block"])
    pairs = pairs.filter((F.col("p") < F.col("q")) & (F.col("q") <= F.col("p") + read_length)).drop("block")

    sites = marks.groupBy(*keys, "pos").agg(F.count("state").alias("n_calls"), F.avg(F.col("state").cast("double")).alias("level")).filter(F.col("n_calls") >= depth)
    stretch = sites.groupBy(*keys, F.floor(F.col("pos") / read_length).alias("block")).agg(F.collect_list(F.struct("pos", "level")).alias("sites"))
    spread = pairs.withColumn("block", F.explode(F.sequence(F.floor(F.col("p") / read_length), F.floor(F.col("q") / read_length))))
    held = spread.join(stretch, [*keys, "block"]).groupBy(*keys, "p", "q").agg(F.flatten(F.collect_list("sites")).alias("sites"))
    held = held.withColumn("sites", F.sort_array(F.filter("sites", lambda x: (x["pos"] >= F.col("p")) & (x["pos"] <= F.col("q"))))).filter(F.size("sites") >= min_sites)
    level = F.aggregate("sites", F.lit(0.0), lambda acc, x: acc + x["level"]) / F.size("sites")
    held = held.select(*keys, "p", "q", F.transform("sites", lambda x: x["pos"]).alias("places"), level.alias("level"))

    known = F.map_from_entries(F.filter("marks", lambda m: m["state"].isNotNull()))
    called = alike.select(*keys, known.alias("known"), "n").select(*keys, F.explode(F.map_keys("known")).alias("p"), "known", "n")
    met = held.join(called, [*keys, "p"]).filter(F.map_contains_key("known", F.col("q")))
    pattern = F.array_join(F.transform("places", lambda x: F.coalesce(F.element_at("known", x), F.lit("-"))), "")
    interval = [*keys, "p", "q"]
    counts = met.withColumn("pattern", pattern).groupBy(*interval, "pattern").agg(F.sum("n").alias("n"), F.first("places").alias("places"), F.first("level").alias("level"))
    out = counts.groupBy(*interval).agg(F.first(F.size("places")).alias("n_sites"), F.first("level").alias("level"), F.sum("n").alias("n_spanning"), F.sort_array(F.collect_list(F.struct("pattern", "n"))).alias("all"))
    valid = F.filter("all", lambda x: F.length(F.replace(x["pattern"], F.lit("-"), F.lit(""))) >= min_sites)
    states = lambda i: F.array_remove(F.array_distinct(F.transform("all", lambda x: F.substring(x["pattern"], i, F.lit(1)))), "-")
    changed = F.size(F.filter(F.sequence(F.lit(1), F.col("n_sites")), lambda i: F.size(states(i)) > 1))
    out = out.filter(F.col("n_spanning") >= depth).withColumns({"valid": valid, "n_changed": changed}).filter("size(valid) > 0")
    total = F.aggregate("valid", F.lit(0).cast("long"), lambda acc, x: acc + x["n"])
    text = F.array_join(F.transform("valid", lambda x: F.concat(x["pattern"], F.lit("="), x["n"].cast("string"))), ":")
    return out.select(*keys, F.col("p").alias("start_pos"), F.col("q").alias("end_pos"), "n_sites", "level", total.alias("n_reads"), F.size("valid").alias("n_patterns"), "n_changed", text.alias("patterns"))


def read_levels(calls: DataFrame) -> DataFrame:
    """Per read: span, called and methylated sites and their share."""
    out = calls.groupBy("read_id", "ref").agg(F.min("pos").alias("start_pos"), F.max("pos").alias("end_pos"), F.count("*").alias("n_sites"), F.sum("meth").cast("long").alias("m"))
    return out.withColumn("level", F.col("m") / F.col("n_sites"))


def read_states(levels: DataFrame, width: int, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Reads per window by level (L, M, H), number of states and their entropy (nats)."""
    state = F.when(F.col("level") < low, "L").when(F.col("level") > high, "H").otherwise("M")
    rows = levels.withColumns({"state": state, "w_start": F.floor((F.col("start_pos") - 1) / width) * width + 1})
    counts = rows.groupBy(*WINDOW, "state").agg(F.count("*").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(W.partitionBy(*WINDOW)))
    share = F.col("n") / F.col("total")
    each = [F.coalesce(F.sum(F.when(F.col("state") == s, F.col("n"))), F.lit(0)).alias(f"n_{s.lower()}") for s in "LMH"]
    return counts.groupBy(*WINDOW).agg(F.first("total").alias("n_reads"), F.count("*").alias("n_states"), (-F.sum(share * F.log(share))).alias("entropy"), *each)


def pattern_distances(patterns: list[str]) -> np.ndarray:
    """Mean difference of each pair over the columns that both have; 0 if there is none."""
    codes = np.array([[-1 if c == "-" else int(c) for c in p] for p in patterns], np.int8).reshape(len(patterns), -1)
    both, far = np.zeros((len(patterns),) * 2), np.zeros((len(patterns),) * 2)
    for column in codes.T:
        known = np.outer(column >= 0, column >= 0)
        both += known
        far += np.abs(column[:, None].astype(float) - column[None]) * known
    return np.divide(far, both, out=np.zeros_like(far), where=both > 0)


#: How the distance of an item to two merged clusters follows from those to each (and theirs, with all sizes).
LINKAGES = {
    "complete": lambda x, y, xy, i, j, k: np.maximum(x, y),
    "single": lambda x, y, xy, i, j, k: np.minimum(x, y),
    "average": lambda x, y, xy, i, j, k: (i * x + j * y) / (i + j),
    "mcquitty": lambda x, y, xy, i, j, k: (x + y) / 2,
    "ward": lambda x, y, xy, i, j, k: ((i + k) * x + (j + k) * y - k * xy) / (i + j + k),
    "ward2": lambda x, y, xy, i, j, k: np.sqrt(np.maximum(((i + k) * x**2 + (j + k) * y**2 - k * xy**2) / (i + j + k), 0)),
    "median": lambda x, y, xy, i, j, k: (x + y) / 2 - xy / 4,
    "centroid": lambda x, y, xy, i, j, k: (i * x + j * y) / (i + j) - i * j * xy / (i + j) ** 2,
}


def linkage(distance: np.ndarray, method: str = "complete") -> tuple[list[int], list[tuple[int, int, float]]]:
    """Leaves in the order of the tree, and its merges (first item of either side, height) by height; those of median and centroid, whose heights may fall, as they come.

    Every cluster keeps its nearest one, so a merge costs a row of the matrix,
    and rows anew of those whose nearest was merged. Of equal ones the smaller number is nearer.
    """
    n, joined = len(distance), LINKAGES[method]
    far = distance.astype(float).copy()
    np.fill_diagonal(far, np.inf)
    size, members, merges = np.ones(n), {i: [i] for i in range(n)}, []
    near = far.argmin(1) if n else np.zeros(0, int)
    least = far[np.arange(n), near]
    for _ in range(n - 1):
        i = int(least.argmin())
        a, b = sorted((i, int(near[i])))
        merges.append((a, b, float(far[a, b])))
        members[a] += members.pop(b)
        others = np.array([k for k in members if k != a], int)
        far[a, others] = far[others, a] = joined(far[a, others], far[b, others], far[a, b], size[a], size[b], size[others])
        size[a] += size[b]
        far[b], far[:, b] = np.inf, np.inf
        least[b] = np.inf
        closer = others[(far[others, a] < least[others]) | (far[others, a] == least[others]) & (a < near[others])]
        near[closer], least[closer] = a, far[closer, a]
        lost = others[np.isin(near[others], (a, b)) & (far[others, a] != least[others])]
        for k in (a, *lost.tolist(), *others[(near[others] == b)].tolist()):
            near[k] = far[k].argmin()
            least[k] = far[k, near[k]]
    leaves = [x for m in members.values() for x in m]
    return leaves, merges if method in ("median", "centroid") else sorted(merges, key=lambda m: m[2])


def complete_linkage(distance: np.ndarray, cut: float) -> list[int]:
    """Cluster number of each item after all merges whose farthest items are within `cut`; numbers by first item."""
    root = list(range(len(distance)))

    def top(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    for a, b, height in linkage(distance)[1]:
        if height <= cut:
            root[max(top(a), top(b))] = min(top(a), top(b))
    numbers = {r: k for k, r in enumerate(sorted({top(i) for i in range(len(root))}))}
    return [numbers[top(i)] for i in range(len(root))]


#: Scatter of a cluster's core, as a share of the tree's height, up to which it is a cluster, by depth of splitting (fixed values).
CORE_SCATTER = (0.64, 0.73, 0.82, 0.91, 0.95)


def branch_cut(n: int, merges: list[tuple[int, int, float]], least: int = 2, depth: int = 1) -> list[int]:
    """Cluster numbers from 1, by first item, of the branches of a tree of n items by their shape; 0 for items of no cluster.

    Heights count from their 5th percentile up to 99 % of the way to the top. Where
    two branches meet below that, each is a cluster of its own if both have `least` items or more,
    a core (the items joined first) of little scatter, and a gap between that
    scatter and the meeting; else they go on as one. A branch that meets parted
    ones is a cluster on the same terms, or of none. A larger `depth` (0 to 4) parts more.
    """
    heights = [h for _, _, h in merges]
    low, top = (float(np.quantile(heights, 0.05)), max(heights)) if heights else (0.0, 0.0)
    cut = low + 0.99 * (top - low)
    scatter, gap = CORE_SCATTER[depth], (1 - CORE_SCATTER[depth]) * 3 / 4
    branch: dict[int, tuple[list[int], list[float]] | None] = {i: ([i], []) for i in range(n)}  # items and heights; None: parted
    number, found = [0] * n, []

    def stands(items: list[int], joins: list[float], at: float) -> bool:
        if len(items) < least:
            return False
        base = least // 2 + 1
        core = int(base + (len(items) - base) ** 0.5) if len(items) > base else len(items)
        mean = float(np.mean(sorted(joins)[: max(core - 1, 1)]))
        return mean <= low + scatter * (cut - low) and at - mean >= gap * (cut - low)

    for a, b, h in merges:
        if h > cut:
            continue
        sides = [branch[a], branch.pop(b)]
        own = [x for x in sides if x is not None]
        good = [x for x in own if stands(*x, h)]
        if len(own) == 2 and len(good) < 2:
            branch[a] = (own[0][0] + own[1][0], [*own[0][1], *own[1][1], h])
        else:
            found += [items for items, _ in good]
            branch[a] = None
    found += [x[0] for x in branch.values() if x is not None and stands(*x, cut)]
    for k, items in enumerate(sorted(found, key=min), 1):
        for i in items:
            number[i] = k
    return number


def clones(patterns: DataFrame, cut: float | None = 0.5, least: int = 2, depth: int = 1) -> DataFrame:
    """Patterns of each window in clusters by complete linkage (ref, w_start, pattern, n, clone), up to a height or, if `cut` is None, by the shape of branches (see branch_cut). A window's patterns number 2^sites at most."""

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pattern", ignore_index=True)
        far = pattern_distances(pdf["pattern"].tolist())
        pdf["clone"] = branch_cut(len(far), linkage(far)[1], least, depth) if cut is None else complete_linkage(far, cut)
        return pdf[["ref", "w_start", "pattern", "n", "clone"]]

    return patterns.select(*WINDOW, "pattern", "n").groupBy(*WINDOW).applyInPandas(cluster, "ref string, w_start long, pattern string, n long, clone int")


def zero_filled(a: DataFrame, b: DataFrame) -> DataFrame:
    """Patterns of two samples in the windows that both have (ref, w_start, pattern, n1, n2), 0 where one lacks a pattern."""
    one, two = a.select(*WINDOW, "pattern", F.col("n").alias("n1")), b.select(*WINDOW, "pattern", F.col("n").alias("n2"))
    shared = one.select(*WINDOW).distinct().join(two.select(*WINDOW).distinct(), WINDOW)
    return one.join(two, [*WINDOW, "pattern"], "full").join(shared, WINDOW).fillna(0, ["n1", "n2"])


#: Names of levels by two contexts: open, mixed and closed; low, middle and high (fixed values).
OPEN, LEVELS = ("O", "M", "C"), ("L", "M", "H")


def three_way(value, names: tuple[str, str, str], low: float, high: float):
    return F.when(value < low, names[0]).when(value > high, names[2]).otherwise(names[1])


def read_state_windows(reads: DataFrame, width: int, step: int, low: float = 0.2, high: float = 0.8) -> DataFrame:
    """Reads (ref, start_pos, end_pos, open, level) per sliding window by one of nine states, openness by methylation level.

    n_reads, n_states, their entropy (nats) and a count of each state. A read
    counts in every window of the grid that it meets. A high first level is open.
    """
    state = F.concat(three_way(1 - F.col("open"), OPEN, low, high), three_way(F.col("level"), LEVELS, low, high))
    first = F.greatest(F.lit(0).cast("long"), ((F.col("start_pos") + step - width) / step).cast("long"))
    last = ((F.col("end_pos") - 2) / step).cast("long")
    windows = F.explode(F.when(last >= first, F.sequence(first, last)))
    rows = reads.select("ref", state.alias("state"), windows.alias("p")).groupBy("ref", (F.col("p") * step + 1).alias("w_start"), "state").agg(F.count("*").alias("n"))
    rows = rows.withColumn("total", F.sum("n").over(W.partitionBy(*WINDOW)))
    share = F.col("n") / F.col("total")
    each = [F.coalesce(F.sum(F.when(F.col("state") == a + b, F.col("n"))), F.lit(0)).alias(f"n_{a}{b}") for a in OPEN for b in LEVELS]
    return rows.groupBy(*WINDOW).agg(F.first("total").alias("n_reads"), F.count("*").alias("n_states"), (-F.sum(share * F.log(share))).alias("entropy"), *each)


def smooth(sites: DataFrame, width: int, by: tuple[str, ...] = ("sample", "ref")) -> DataFrame:
    """Levels smoothed with a tricube kernel of half-width `width`, weighted by coverage; sites meet those of the next blocks only."""
    block = F.floor(F.col("start_pos") / width)
    near = sites.select(*by, F.col("start_pos").alias("x"), F.col("m").alias("xm"), F.col("cov").alias("xcov"), F.explode(F.array(block - 1, block, block + 1)).alias("block"))
    both = sites.filter("cov > 0").withColumn("block", block).join(near, [*by, "block"]).filter(F.abs(F.col("x") - F.col("start_pos")) < width)
    weight = (1 - F.pow(F.abs(F.col("x") - F.col("start_pos")) / width, 3)) ** 3
    return both.groupBy(*by, "start_pos").agg((F.sum(weight * F.col("xm")) / F.sum(weight * F.col("xcov"))).alias("smoothed"), F.count("*").alias("n_near"))



def smoothed_t(sites: DataFrame, a: list[str], b: list[str], width: int, by: tuple[str, ...] = ("ref",)) -> DataFrame:
    """Per site that all samples of both groups have: means of their smoothed levels and t (equal variances) of the difference."""
    levels = smooth(sites.filter(F.col("sample").isin(*a, *b)), width)
    side = lambda names, f: f(F.when(F.col("sample").isin(*names), F.col("smoothed")))
    n1, n2 = len(a), len(b)
    both = levels.groupBy(*by, "start_pos").agg(F.count("*").alias("n"), side(a, F.avg).alias("mean1"), side(b, F.avg).alias("mean2"), side(a, F.var_samp).alias("v1"), side(b, F.var_samp).alias("v2"))
    pooled = F.sqrt(((n1 - 1) * F.col("v1") + (n2 - 1) * F.col("v2")) / (n1 + n2 - 2) * (1 / n1 + 1 / n2))
    both = both.filter(F.col("n") == n1 + n2).withColumns({"diff": F.col("mean1") - F.col("mean2"), "se": pooled})
    return both.select(*by, "start_pos", "mean1", "mean2", "diff", F.expr("try_divide(diff, se)").alias("t"))


def differing_regions(tested: DataFrame, cut: float, gap: int = 300, least_sites: int = 3, least_diff: float = 0.1) -> DataFrame:
    """Runs of sites no more than `gap` apart whose t lies beyond `cut` on one side: ref, start_pos, end_pos, direction, n_sites, mean_diff, area_t."""
    from .intervals import numbered_islands

    side = F.when(F.col("t") >= cut, "up").when(F.col("t") <= -cut, "down").otherwise("none")
    rows = stored(tested.filter("t IS NOT NULL").select("ref", "start_pos", side.alias("direction"), "t", "diff"), "directions")
    # a run ends where the direction changes, so a site counts how many of other directions lie before it
    marks = rows.withColumn("end_pos", F.col("start_pos"))
    runs = numbered_islands(marks, gap).join(rows, ["ref", "start_pos"])
    order = W.partitionBy("ref", "island").orderBy("start_pos")
    turned = (F.col("direction") != F.lag("direction").over(order)).cast("int")
    runs = runs.withColumn("turn", F.coalesce(turned, F.lit(0))).withColumn("part", F.sum("turn").over(order)).filter("direction <> 'none'")
    out = runs.groupBy("ref", "island", "part", "direction").agg(F.min("start_pos").alias("start_pos"), F.max("start_pos").alias("end_pos"), F.count("*").alias("n_sites"), F.avg("diff").alias("mean_diff"), F.sum("t").alias("area_t"))
    return out.filter((F.col("n_sites") >= least_sites) & (F.abs("mean_diff") >= least_diff)).drop("island", "part")
