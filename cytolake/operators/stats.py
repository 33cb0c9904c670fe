"""Tests between groups of samples for each site or window, and adjustment for many tests.

Statistics come from aggregates where they can; tail probabilities and rank
tests run as Arrow-backed kernels over rows that Spark deals out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from ..functions import special
from ..plans.tables import stored

KEYS = ("ref", "start_pos")
TINY = 1e-10


def ranges(rows: DataFrame, value: str, *ties: str, by: tuple[str, ...] = (), descending: bool = False, n: int = 64) -> tuple[DataFrame, DataFrame]:
    """rows with `part`, a range of `value` (in order over the parts), and per part and `by` its size and the rows before it.

    Bounds of the ranges are approximate quantiles, so a part is the same for a
    row wherever the plan computes it; equal values share a part.
    """
    cuts = rows.agg(F.percentile_approx(value, F.array(*[F.lit(k / n) for k in range(1, n)]), F.lit(10_000)).alias("cuts")).first()["cuts"] or []
    part = F.lit(0)
    for cut in sorted(set(cuts)):
        part = part + ((F.col(value) < cut) if descending else (F.col(value) > cut)).cast("int")
    parts = rows.withColumn("part", part)
    line = W.partitionBy(*by).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    sizes = parts.groupBy(*by, "part").agg(F.count("*").alias("size"))
    return parts, sizes.withColumns({"before": F.coalesce(F.sum("size").over(line), F.lit(0)), "total": F.sum("size").over(W.partitionBy(*by))})


def bh_adjust(tests: DataFrame, p: str = "p", missing: str = "one", by: tuple[str, ...] = ()) -> DataFrame:
    """Adds q, Benjamini and Hochberg's adjusted p, within each family `by`.

    missing: "one" sets null p to 1 and counts it, "skip" leaves it null and out
    of the count. Ranks are taken in ranges of p: counts within each range, those
    of the ranges before it, and the least of the ranges behind; only a row per
    range and family meets in one place. The tests are stored first, as bounds,
    counts and the join each read them.
    """
    rows = stored(tests.withColumn(p, F.coalesce(F.col(p), F.lit(1.0))) if missing == "one" else tests, "tests")
    known, sizes = ranges(rows.filter(F.col(p).isNotNull()), p, by=by)
    counts = known.groupBy(*by, "part", F.col(p).alias("bh_p")).agg(F.count("*").alias("n"))
    key = [*by, "part"]
    within = W.partitionBy(*key).orderBy("bh_p")
    ranked = counts.withColumn("upto", F.sum("n").over(within)).join(sizes, key)
    ranked = ranked.withColumn("raw", F.col("bh_p") * F.col("total") / (F.col("before") + F.col("upto")))
    # from the largest p down, so that frames grow; one that shrinks is computed anew for each row
    behind = F.min("least").over(W.partitionBy(*by).orderBy(F.desc("part")).rowsBetween(W.unboundedPreceding, -1))
    least = ranked.groupBy(*key).agg(F.min("raw").alias("least")).withColumn("behind", behind)
    inside = F.min("raw").over(W.partitionBy(*key).orderBy(F.desc("bh_p")).rowsBetween(W.unboundedPreceding, 0))
    adjusted = ranked.withColumn("inside", inside).join(least.select(*key, "behind"), key)
    adjusted = adjusted.select(*by, F.col("bh_p").alias(p), F.least(F.lit(1.0), "inside", F.coalesce("behind", F.lit(1.0))).alias("q"))
    return rows.join(adjusted, [*by, p], "left").select(*rows.columns, "q")


def mean_sd(rows: DataFrame, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """n, mean and sample deviation per key and group."""
    return rows.filter(F.col(value).isNotNull()).groupBy(*keys, "grp").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))


def two_groups(rows: DataFrame, a: str, b: str, value: str = "pct", keys: tuple[str, ...] = KEYS, **others: Column) -> DataFrame:
    """Per key: sizes, means and sample variances of groups a (1) and b (2), and `others`, aggregates of all rows of the key, those of further groups included."""
    aggs = []
    for i, g in ((1, a), (2, b)):
        own = F.when(F.col("grp") == g, F.col(value))
        aggs += [F.count(own).alias(f"n{i}"), F.avg(own).alias(f"mean{i}"), F.var_samp(own).alias(f"var{i}")]
    known = rows if others else rows.filter(F.col("grp").isin(a, b))
    return known.groupBy(*keys).agg(*aggs, *[c.alias(n) for n, c in others.items()])


def welch(rows: DataFrame, a: str, b: str, value: str = "pct", keys: tuple[str, ...] = KEYS, with_p: bool = True) -> DataFrame:
    """Welch's t, its degrees of freedom and p. If neither group varies, 1e-10 goes onto the first value of a, so the test still has a result."""
    both = two_groups(rows, a, b, value, keys).filter("n1 > 1 AND n2 > 1")
    flat = (F.col("var1") == 0) & (F.col("var2") == 0)
    mean1 = F.when(flat, F.col("mean1") + TINY / F.col("n1")).otherwise(F.col("mean1"))
    var1 = F.when(flat, F.lit(TINY**2) / F.col("n1")).otherwise(F.col("var1"))
    se1, se2 = var1 / F.col("n1"), F.col("var2") / F.col("n2")
    out = both.withColumns({"diff": F.col("mean1") - F.col("mean2"), "t": (mean1 - F.col("mean2")) / F.sqrt(se1 + se2), "df": (se1 + se2) ** 2 / (se1**2 / (F.col("n1") - 1) + se2**2 / (F.col("n2") - 1))})
    return out.withColumn("p", t_p(F.col("t"), F.col("df"))) if with_p else out


def variance_ratio(rows: DataFrame, a: str, b: str, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Ratio of sample variances, degrees of freedom and two-sided p.

    A variance below TINY squared is none. Without one in b the ratio is infinite
    and p 0, even without one in a, whose first value then counts as moved by TINY.
    """
    none = lambda v: F.when(v < TINY**2, 0.0).otherwise(v)
    both = two_groups(rows, a, b, value, keys).filter("n1 > 1 AND n2 > 1")
    ratio = F.when(none(F.col("var2")) > 0, none(F.col("var1")) / F.col("var2")).otherwise(float("inf"))
    out = both.withColumns({"f": ratio, "df1": F.col("n1") - 1, "df2": F.col("n2") - 1})
    upper = f_p(F.col("f"), F.col("df1"), F.col("df2"))
    return out.withColumn("p", F.when((F.col("f") == 0) | (F.col("f") == float("inf")), 0.0).otherwise(2 * F.least(upper, 1 - upper)))


def anova(rows: DataFrame, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One-way analysis of variance over grp: F, degrees of freedom and p, from sums per group."""
    groups = rows.filter(F.col(value).isNotNull()).groupBy(*keys, "grp").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"))
    every = W.partitionBy(*keys)
    groups = groups.withColumn("grand", F.sum(F.col("n") * F.col("mean")).over(every) / F.sum("n").over(every))
    totals = groups.groupBy(*keys).agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("mean") - F.col("grand")) ** 2).alias("ss_between"), F.sum(F.col("n") * F.col("var")).alias("ss_within"))
    out = totals.filter("k > 1 AND n > k").withColumns({"df1": F.col("k") - 1, "df2": F.col("n") - F.col("k")})
    out = out.withColumn("f", F.expr("try_divide(ss_between / df1, ss_within / df2)")).drop("k", "n")
    return out.withColumn("p", f_p(F.col("f"), F.col("df1"), F.col("df2")))


@F.pandas_udf(DoubleType())
def tukey_p(q: pd.Series, k: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(special.tukey_upper(q.to_numpy(float), k.to_numpy(int), df.to_numpy(float)))


def with_pairs(rows: DataFrame, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Every key's analysis of variance (k, df1, df2, ss_between, ss_within; see anova) and `pairs` of its groups (g1, g2, diff, range), from one pass over the rows."""
    groups = rows.filter(F.col(value).isNotNull()).groupBy(*keys, "grp").agg(F.count("*").alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"))
    held = groups.groupBy(*keys).agg(F.count("*").alias("k"), F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"), F.sum(F.col("n") * F.col("var")).alias("ss_within"), F.sort_array(F.collect_list(F.struct("grp", "n", "mean"))).alias("groups"))
    between = F.aggregate("groups", F.lit(0.0), lambda acc, g: acc + g["n"] * (g["mean"] - F.col("grand")) ** 2)
    out = held.withColumns({"ss_between": between, "df1": F.col("k") - 1, "df2": F.col("total") - F.col("k")})
    error = F.when((F.col("k") > 1) & (F.col("df2") > 0), F.col("ss_within") / F.col("df2") / 2)

    def pair(a: Column, b: Column) -> Column:
        spread, diff = F.sqrt(error * (1 / a["n"] + 1 / b["n"])), b["mean"] - a["mean"]
        return F.when(spread > 0, F.struct(a["grp"].alias("g1"), b["grp"].alias("g2"), diff.alias("diff"), (F.abs(diff) / spread).alias("range")))

    every = F.flatten(F.transform("groups", lambda a: F.transform(F.filter("groups", lambda b: b["grp"] > a["grp"]), lambda b: pair(a, b))))
    return out.withColumn("pairs", F.filter(every, lambda x: x.isNotNull())).select(*keys, "k", "df1", "df2", "ss_between", "ss_within", "pairs")


def tukey(rows: DataFrame, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Honest significant differences between all pairs of groups: diff, studentised range and p."""
    both = with_pairs(rows, value, keys).select(*keys, "k", "df2", F.explode("pairs").alias("pair")).select(*keys, "k", "df2", "pair.*")
    return both.withColumn("p", tukey_p(F.col("range"), F.col("k"), F.col("df2").cast("double"))).select(*keys, "g1", "g2", "diff", "range", "p")


@F.pandas_udf(DoubleType())
def t_p(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(special.t_two_sided(t.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def f_p(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series(special.f_upper(f.to_numpy(float), d1.to_numpy(float), d2.to_numpy(float))).where(f.notna())


@F.pandas_udf(DoubleType())
def chi2_p(x: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(special.chi2_upper(x.to_numpy(float), df.to_numpy(float)))


@F.pandas_udf(DoubleType())
def fisher_p(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided p of 2x2 tables: tables with the same margins that are as likely or less; null without reads on a side."""
    return pd.Series(two_sided_fisher(*(x.to_numpy(np.int64) for x in (a, b, c, d))))


def two_sided_fisher(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """See fisher_p. Weights are added up as they are and divided once, so a p that lies on a cut falls on the side on which the plain sums have it."""
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, (a + b + c + d).max(initial=0) + 1)))])
    low, high = np.maximum(0, a - d), np.minimum(a + b, a + c)
    size = high - low + 1
    begin = np.cumsum(size) - size
    row = np.repeat(np.arange(len(a)), size)
    k = np.arange(len(row)) - begin[row] + low[row]
    one, two, rest = (a + b)[row], (c + d)[row], (a + c)[row] - k
    chance = log_factorial[one] - log_factorial[k] - log_factorial[one - k] + log_factorial[two] - log_factorial[rest] - log_factorial[two - rest]
    peak = np.maximum.reduceat(chance, begin) if len(row) else np.zeros(0)
    own, shift = chance[begin + a - low], np.where(peak > 600, peak, 0.0)  # beyond that weights are no longer numbers
    weight = np.exp(chance - shift[row])
    p = np.bincount(row, np.where(chance <= own[row] + 1e-7, weight, 0.0), len(a)) / np.bincount(row, weight, len(a)) if len(row) else np.zeros(0)
    return np.where((a + b > 0) & (c + d > 0), np.minimum(1.0, p), np.nan)


@F.pandas_udf(DoubleType())
def fisher_odds(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Conditional estimate of the odds ratio of 2x2 tables: the one at which the mean of the first cell, its margins given, is what it is. 0 or infinite at the ends of its range; null without reads on a side or where the margins leave no choice."""
    return pd.Series(conditional_odds(*(x.to_numpy(np.int64) for x in (a, b, c, d))))


def conditional_odds(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """See fisher_odds. The mean grows with the odds, so its root is found by halving the range of their logarithm for all tables at once."""
    low, high = np.maximum(0, a - d), np.minimum(a + b, a + c)
    size = high - low + 1
    begin = np.cumsum(size) - size
    row = np.repeat(np.arange(len(a)), size)
    k = np.arange(len(row)) - begin[row] + low[row]
    base = -sum(special.log_factorial(x) for x in (k, (a + b)[row] - k, (a + c)[row] - k, (d - a)[row] + k))
    left, right = np.full(len(a), -60.0), np.full(len(a), 60.0)
    for _ in range(64 if len(row) else 0):
        middle = (left + right) / 2
        weight = base + k * middle[row]
        weight = np.exp(weight - np.maximum.reduceat(weight, begin)[row])
        mean = np.bincount(row, weight * k, len(a)) / np.bincount(row, weight, len(a))
        left, right = np.where(mean < a, middle, left), np.where(mean < a, right, middle)
    odds = np.where(a == low, 0.0, np.where(a == high, np.inf, np.exp((left + right) / 2)))
    return np.where((a + b > 0) & (c + d > 0) & (low < high), odds, np.nan)


def fisher_pairs(sites: DataFrame, a: str, b: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Every sample of group a against every one of b at each key: p, conditional odds ratio and difference of levels."""
    long = sites.filter(F.col("grp").isin(a, b) & (F.col("cov") > 0)).select(*keys, "grp", "sample", "m", "cov")
    one = long.filter(F.col("grp") == a).select(*keys, F.col("sample").alias("s1"), F.col("m").alias("m1"), F.col("cov").alias("cov1"))
    two = long.filter(F.col("grp") == b).select(*keys, F.col("sample").alias("s2"), F.col("m").alias("m2"), F.col("cov").alias("cov2"))
    both = one.join(two, list(keys))
    cells = (F.col("m1"), F.col("cov1") - F.col("m1"), F.col("m2"), F.col("cov2") - F.col("m2"))
    return both.withColumns({"p": fisher_p(*cells), "odds": fisher_odds(*cells), "diff": F.col("m1") / F.col("cov1") - F.col("m2") / F.col("cov2")})


def fisher_groups(tests: DataFrame, cut: float = 0.05, least: float = 0.25, rule: str = "common", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """One result per key from its sample pairs (q, diff): significant if all ("common") or any ("union") are.

    Then the least q of the significant ones, else the largest of the others;
    diff is null where one lacks or significant ones point both ways.
    """
    hit = (F.col("q") < cut) & (F.abs("diff") > least)
    pair = F.struct("q", "diff")
    grouped = tests.withColumn("hit", F.coalesce(hit, F.lit(False))).groupBy(*keys).agg(
        (F.min("hit") if rule == "common" else F.max("hit")).alias("significant"),
        F.min(F.when(F.col("hit"), pair)).alias("best"), F.max(F.when(~F.col("hit"), pair)).alias("worst"),
        F.max(F.col("diff").isNull()).alias("lacking"), F.min(F.when(F.col("hit"), F.signum("diff"))).alias("down"), F.max(F.when(F.col("hit"), F.signum("diff"))).alias("up"),
    )
    chosen = F.when(F.col("significant"), F.col("best")).otherwise(F.col("worst"))
    mixed = F.col("lacking") | F.coalesce(F.col("down") != F.col("up"), F.lit(False))
    return grouped.select(*keys, "significant", chosen["q"].alias("q"), F.when(~mixed, chosen["diff"]).alias("diff"))


def contingency(cells: DataFrame, keys: list[str], row: str, col: str, n: str = "n", with_p: bool = True) -> DataFrame:
    """Chi-squared and G2 of each key's table of counts, degrees of freedom and p; cells that lack are 0 and add nothing to G2.

    A key's cells come together once, as a list; margins are added up a batch of keys at a time.
    """
    held = cells.groupBy(*keys).agg(F.collect_list(F.struct(F.col(row).cast("string").alias("r"), F.col(col).cast("string").alias("c"), F.col(n).cast("long").alias("n"))).alias("cells"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, size = batch.column(len(keys)), batch.num_rows
            key = np.repeat(np.arange(size), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
            flat = lists.flatten()
            given = flat.field("n").is_valid().to_numpy(zero_copy_only=False)
            o = flat.field("n").fill_null(0).to_numpy(zero_copy_only=False)
            total = np.bincount(key, o, size)
            margins, lines = [], []
            for name in ("r", "c"):
                codes = flat.field(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64) + 1  # 0: a line without a name
                line, which = np.unique(key * (codes.max(initial=0) + 1) + codes, return_inverse=True)
                margins.append(np.bincount(which, o, len(line))[which])
                owner, code = np.divmod(line, codes.max(initial=0) + 1)
                lines.append(np.bincount(owner[code > 0], minlength=size))
            with np.errstate(divide="ignore", invalid="ignore"):
                e = margins[0] * margins[1] / total[key]
                chi2 = np.bincount(key, np.where((e > 0) & given, (o - e) ** 2 / e, 0.0), size)
                g2 = 2 * np.bincount(key, np.where((o > 0) & (e > 0), o * np.log(np.where(o > 0, o / e, 1.0)), 0.0), size)
            df = (lines[0] - 1) * (lines[1] - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keys)], pa.array(chi2, mask=~(total > 0)), pa.array(g2), pa.array(df.astype(np.int64))], [*keys, "chi2", "g2", "df"])

    kinds = ", ".join(f"`{k}` {held.schema[k].dataType.simpleString()}" for k in keys)
    out = held.mapInArrow(add, f"{kinds}, chi2 double, g2 double, df long")
    return out.withColumn("p", chi2_p(F.col("chi2"), F.col("df").cast("double"))) if with_p else out


def deviance_density(g2: Column, df: int = 15) -> Column:
    """Chi-squared density with a fixed 15 degrees of freedom, as the multinomial test of this format reports in place of a p."""
    half = df / 2
    from math import lgamma, log

    return F.when(g2 > 0, F.exp((half - 1) * F.log(g2) - g2 / 2 - half * log(2) - lgamma(half))).otherwise(0.0)


def rao_scott(sites: DataFrame, a: str, b: str, keys: tuple[str, ...] = KEYS, with_p: bool = True) -> DataFrame:
    """Rao and Scott's chi-squared on counts divided by each group's design effect."""
    rows = sites.filter(F.col("grp").isin(a, b) & (F.col("cov") > 0))
    group = rows.groupBy(*keys, "grp").agg(F.count("*").alias("k"), F.sum("cov").alias("n"), F.sum("m").alias("y"), F.sum(F.col("m") * F.col("m")).alias("yy"), F.sum(F.col("m") * F.col("cov")).alias("yn"), F.sum(F.col("cov") * F.col("cov")).alias("nn"))
    pi = F.col("y") / F.col("n")
    squares = F.col("yy") - 2 * pi * F.col("yn") + pi * pi * F.col("nn")
    var = F.expr("try_divide(k, k - 1)") * squares / (F.col("n") * F.col("n"))
    effect = F.coalesce(F.expr("try_divide(v, b)"), F.lit(1.0))
    group = group.withColumns({"pi": pi, "v": var, "b": pi * (1 - pi) / F.col("n")}).withColumn("d", F.when(F.col("k") > 1, effect).otherwise(1.0)).withColumn("d", F.when(F.col("d") > TINY, F.col("d")))  # samples that agree wholly have no effect to divide by
    group = group.withColumns({"n_adj": F.expr("try_divide(n, d)"), "y_adj": F.expr("try_divide(y, d)")})
    sums = group.groupBy(*keys).agg(F.count("*").alias("g"), F.sum("n_adj").alias("tn"), F.sum("y_adj").alias("ty"), F.sum(F.col("y_adj") * F.col("y_adj") / F.col("n_adj")).alias("sq"), F.count("n_adj").alias("ok"))
    pooled = F.col("ty") / F.col("tn")
    x2 = F.expr("try_divide(sq - ty * ty / tn, (ty / tn) * (1 - ty / tn))")
    out = sums.filter("g = 2 AND ok = 2").select(*keys, pooled.alias("pooled"), x2.alias("x2"), (F.col("g") - 1).alias("df"))
    return out.withColumn("p", chi2_p(F.col("x2"), F.col("df").cast("double"))) if with_p else out


#: Tests on two lists of values; add your own with register_test.
RANK_TESTS: dict[str, Callable[[np.ndarray, np.ndarray], tuple[float, float]]] = {"wilcoxon": special.rank_sum, "ks": special.ks_without_ties, "ks_ties": special.ks_distance, "ansari": special.ansari_bradley, "cucconi": special.cucconi, "lepage": special.lepage}


def register_test(name: str, test: Callable[[np.ndarray, np.ndarray], tuple[float, float]]) -> None:
    """Makes a test known to rank_test: two arrays to a statistic and a p."""
    RANK_TESTS[name] = test


def rank_test(rows: DataFrame, a: str, b: str, name: str, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """statistic and p of a registered test per key. A key's values are one per sample, so the lists are short."""
    test = RANK_TESTS[name]
    lists = rows.filter(F.col("grp").isin(a, b) & F.col(value).isNotNull()).groupBy(*keys).agg(F.sort_array(F.collect_list(F.when(F.col("grp") == a, F.col(value)))).alias("x"), F.sort_array(F.collect_list(F.when(F.col("grp") == b, F.col(value)))).alias("y"))

    @F.pandas_udf("statistic double, p double")
    def both(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        # the tests see ranks alone, and few samples have few orders: each order is tested once
        known: dict[tuple, tuple[float, float]] = {}
        out = []
        for p, q in zip(x, y, strict=True):
            ranks = tuple(special.average_ranks(np.concatenate([p, q])).tolist())
            if (order := (len(p), ranks)) not in known:
                known[order] = test(np.array(ranks[: len(p)]), np.array(ranks[len(p) :]))
            out.append(known[order])
        return pd.DataFrame(out, columns=["statistic", "p"])

    return lists.filter("size(x) > 0 AND size(y) > 0").withColumn("r", both("x", "y")).select(*keys, "r.statistic", "r.p")


def paired_differences(rows: DataFrame, pairs: list[tuple[str, str]], value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """keys and d: first less second value of each pair of samples that both have one (a sample has one value a key)."""
    one = F.create_map(*[F.lit(x) for i, (a, b) in enumerate(pairs) for x in (a, i, b, i)])
    sign = F.create_map(*[F.lit(x) for a, b in pairs for x in (a, 1, b, -1)])
    known = rows.filter(F.col("sample").isin([s for p in pairs for s in p]) & F.col(value).isNotNull())
    both = known.groupBy(*keys, F.element_at(one, F.col("sample")).alias("pair")).agg(F.count("*").alias("n"), F.sum(F.element_at(sign, F.col("sample")) * F.col(value)).alias("d"))
    return both.filter("n = 2").drop("n", "pair")


def paired_t(rows: DataFrame, pairs: list[tuple[str, str]], value: str = "pct", keys: tuple[str, ...] = KEYS, with_p: bool = True) -> DataFrame:
    """Student's t on the differences of paired samples: n, diff, t, df and p; pairs that never differ have no t."""
    sums = paired_differences(rows, pairs, value, keys).groupBy(*keys).agg(F.count("*").alias("n"), F.avg("d").alias("diff"), F.var_samp("d").alias("var")).filter("n > 1")
    out = sums.withColumns({"t": F.expr("try_divide(diff, sqrt(var / n))"), "df": F.col("n") - 1}).drop("var")
    return out.withColumn("p", t_p(F.col("t"), F.col("df").cast("double"))) if with_p else out


def signed_rank(rows: DataFrame, pairs: list[tuple[str, str]], value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Wilcoxon's signed-rank V and p on the differences of paired samples; equal pairs don't count."""

    @F.pandas_udf("statistic double, p double")
    def test(d: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([special.signed_rank(np.asarray(x, float)) for x in d], columns=["statistic", "p"])

    lists = paired_differences(rows, pairs, value, keys).groupBy(*keys).agg(F.sort_array(F.collect_list("d")).alias("d"))
    return lists.withColumn("r", test("d")).select(*keys, "r.statistic", "r.p")


def significant(tests: DataFrame, cut: float, least: float, by: str = "p") -> DataFrame:
    """Tests below the cut whose groups differ by more than `least`; a null p counts as 1, a null diff as 0."""
    return tests.filter((F.coalesce(F.col(by), F.lit(1.0)) < cut) & (F.abs(F.coalesce("diff", F.lit(0.0))) > least))


def two_group_report(rows: DataFrame, a: str, b: str, tests: DataFrame | Column, keys: tuple[str, ...] = KEYS, value: str = "pct", where: Column | None = None, adjust: bool = True) -> DataFrame:
    """The table of a test between two groups: every key of rows with mean1, mean2, diff (0 where a group has no value), p (1 where there is no test) and q over all keys, those without a test included.

    tests is a table with p, or p as an aggregate of a key's rows; means and p
    then come from one pass, in which p is of all rows, and keys and means are of
    those `where` holds (all). Without `adjust` there is no q.
    """
    diff = F.coalesce(F.col("mean1") - F.col("mean2"), F.lit(0.0)).alias("diff")
    if isinstance(tests, Column):
        where = F.lit(True) if where is None else where
        means = two_groups(rows.withColumn(value, F.when(where, F.col(value))), a, b, value, keys, p=tests, known=F.count_if(where))
        both = means.filter("known > 0").select(*keys, "mean1", "mean2", diff, "p")
    else:
        both = two_groups(rows, a, b, value, keys).select(*keys, "mean1", "mean2", diff).join(tests.select(*keys, "p"), list(keys), "left")
    report = both.withColumn("p", F.coalesce(F.nanvl("p", F.lit(None).cast("double")), F.lit(1.0)))
    return bh_adjust(report) if adjust else report


def report_tables(report: DataFrame, p_cut: float = 0.01, q_cut: float = 0.05, least: float = 0.25, top: int = 500) -> dict[str, DataFrame]:
    """A report's tables: all of it, the significant keys by p and, where it has q, by q, and the `top` largest differences of the latter (all of them up to twice as many)."""
    tables = {"all": report, "by_p": significant(report, p_cut, least)}
    if "q" not in report.columns:
        return tables
    by_q = significant(report, q_cut, least, "q")
    far = by_q.orderBy(F.desc(F.abs("diff")), *[c for c in report.columns if c not in ("mean1", "mean2", "diff", "p", "q")])
    return tables | {"by_q": by_q, "top": far.limit(top) if by_q.limit(2 * top + 1).count() > 2 * top else by_q}


def anova_report(rows: DataFrame, value: str = "pct", keys: tuple[str, ...] = KEYS) -> DataFrame:
    """The table of an analysis of variance: every key with f, p (1 where there is none) and q over all keys, and a row for each pair of its groups (g1, g2, pair_diff, pair_p; null where there is none)."""
    whole = with_pairs(rows, value, keys)
    whole = whole.withColumn("f", F.when((F.col("df1") > 0) & (F.col("df2") > 0), F.expr("try_divide(ss_between / df1, ss_within / df2)")))
    known = f_p(F.coalesce("f", F.lit(0.0)), F.greatest(F.col("df1"), F.lit(1)), F.greatest(F.col("df2"), F.lit(1)))
    p = F.when(F.col("f").isNotNull(), known).otherwise(1.0)
    tested = bh_adjust(whole.select(*keys, "f", p.alias("p"), "k", "df2", "pairs"))
    pairs = tested.select(*keys, "f", "p", "q", "k", "df2", F.explode_outer("pairs").alias("pair")).select(*keys, "f", "p", "q", "k", "df2", "pair.*")
    own = F.when(F.col("g1").isNotNull(), tukey_p(F.coalesce("range", F.lit(0.0)), F.col("k"), F.greatest(F.col("df2"), F.lit(1)).cast("double")))
    return pairs.select(*keys, "f", "p", "q", "g1", "g2", F.col("diff").alias("pair_diff"), own.alias("pair_p"))


def anova_tables(report: DataFrame, pairs: list[tuple[str, str]], cut: float = 0.05, least: float = 0.25, by: str = "q") -> dict[tuple[str, str], DataFrame]:
    """For each pair of groups the keys that are significant as a whole (p or q) and between the two, whose means differ by more than `least`."""
    hit = report.filter((F.col(by) < cut) & (F.col("pair_p") < cut) & (F.abs("pair_diff") > least))
    return {(a, b): hit.filter((F.least("g1", "g2") == min(a, b)) & (F.greatest("g1", "g2") == max(a, b))) for a, b in pairs}


def volcano(tests: DataFrame, least: float, cut: float) -> DataFrame:
    """Counts behind a volcano plot."""
    d, q = F.col("diff"), F.col("q") < cut
    counts = {"below": d < -least, "above": d > least, "down_q": (d < 0) & q, "up_q": (d > 0) & q, "below_q": (d < -least) & q, "above_q": (d > least) & q}
    return tests.agg(*[F.count_if(c).alias(k) for k, c in counts.items()])


@F.pandas_udf(DoubleType())
def upper_hypergeometric(k: pd.Series, good: pd.Series, drawn: pd.Series, total: pd.Series) -> pd.Series:
    """P(at least k good ones among those drawn)."""
    lf = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, int(total.max()) + 1)))]) if len(total) else np.zeros(1)

    def choose(n: int, r: np.ndarray) -> np.ndarray:
        return lf[n] - lf[r] - lf[n - r]

    out = []
    for x, g, d, n in zip(k, good, drawn, total, strict=True):
        r = np.arange(max(x, d - (n - g), 0), min(g, d) + 1)
        out.append(float(min(1.0, np.exp(choose(g, r) + choose(n - g, d - r) - choose(n, d)).sum())) if len(r) else 0.0)
    return pd.Series(out, dtype=float)
