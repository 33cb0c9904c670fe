"""URL filter: host and path rules, then a Bloom filter cascade over the corpus's hosts.

Built from DataFrame functions alone. The cascade's first level encodes the
listed keys, the second the unlisted keys that pass the first, the third the
listed keys that pass the second, and so on until no key passes wrongly. Since
the levels were built against every key of the corpus, a probe of the levels is
an exact answer for those keys and needs no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without `://`."""
    parts = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, parts, 1), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, parts, 2), F.lit(""))


def rule_column(host: Column, path: Column, rules: Sequence[tuple[str, str]], value: int) -> Column:
    """`value` 1: the longest rule (host and path prefix) that fits; 0: its verdict. Ties: the smaller rule."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (-len(r[1]), r[1]))[::-1]:
        rule_host, slash, rest = rule[1].partition("/")
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(rule[value])).otherwise(found)
    return found


@dataclass(frozen=True)
class Level:
    words: Column  # array<bigint> as a scalar subquery
    n_words: int
    seed: int

    def holds(self, key: Column) -> Column:
        place, mask = _probe(key, self.n_words, self.seed)
        return F.get(self.words, place.cast("int")).bitwiseAND(mask) == mask


def _probe(key: Column, n_words: int, seed: int) -> tuple[Column, Column]:
    """A word of the filter, and four bits in it, as one mask."""
    bits = F.xxhash64(key, F.lit(2 * seed + 1))
    mask = F.lit(0).cast("bigint")
    for i in range(4):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(bits, 6 * i).bitwiseAND(F.lit(63)).cast("int")))
    return F.pmod(F.xxhash64(key, F.lit(2 * seed)), F.lit(n_words).cast("bigint")), mask


def encode(keys: DataFrame, n_keys: int, seed: int, bits_per_key: int) -> Level:
    """A level that holds `keys.key`; one row of longs, written to the shared folder."""
    n_words = max(1, -(-n_keys * bits_per_key // 64))
    place, mask = _probe(F.col("key"), n_words, seed)
    set_words = keys.select(place.alias("id"), mask.alias("mask")).groupBy("id").agg(F.bit_or("mask").alias("mask"))
    dense = keys.sparkSession.range(n_words).join(set_words, "id", "left")
    row = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("mask", F.lit(0).cast("bigint")).alias("mask")))).alias("all"))
    table = materialise(row.select(F.transform("all", lambda x: x["mask"]).alias("words")), "cascade")
    return Level(table.select("words").scalar(), n_words, seed)


def build_cascade(universe: DataFrame, bits_per_key: int = 16, max_bytes: int = 64 << 20) -> list[Level] | None:
    """Levels for `universe` (key, listed), every key once; null keys are ignored.

    None if the first level would go over `max_bytes`, the bound on what is sent
    to the executors; callers then join with the list.
    """
    inside, outside = universe.filter("listed"), universe.filter("NOT listed")
    levels: list[Level] = []
    while n := inside.count():
        if n * bits_per_key // 8 > max_bytes:
            return None
        levels.append(level := encode(inside, n, len(levels), bits_per_key))
        inside, outside = outside.filter(level.holds(F.col("key"))), inside
    return levels


def listed(levels: list[Level], key: Column) -> Column:
    """Whether the cascade holds the key."""
    answer = F.lit(len(levels) % 2 == 1)
    for depth in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[depth].holds(key), answer).otherwise(F.lit(depth % 2 == 1))
    return answer


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]], blocklist: DataFrame, page_id: str = "page_id", url: str = "url", max_bytes: int = 64 << 20) -> DataFrame:
    """page_id, host, path, rule, verdict (allow or block) and `listed` for every page.

    rules: (verdict, host/path-prefix). Without a fitting rule, a page is blocked
    if its host is in `blocklist` (a table with the column host, of any length):
    the list is cut to the hosts that the corpus has and encoded by a cascade
    over all of these. A null url has empty host and path and is allowed, unless
    the empty host is listed; null and repeated hosts of the list don't count;
    an empty table gives an empty result; repeated rows stay.
    """
    host, path = split_url(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = blocklist.select(F.col("host").alias("key")).filter("key IS NOT NULL").distinct().withColumn("listed", F.lit(True))
    hosts = rows.select(F.col("host").alias("key")).distinct().join(known, "key", "left")
    hosts = materialise(hosts.select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "hosts")
    levels = build_cascade(hosts, max_bytes=max_bytes)
    if levels is None:
        rows = rows.join(hosts.filter("listed").withColumnRenamed("key", "host"), "host", "left").withColumn("listed", F.coalesce("listed", F.lit(False)))
    else:
        rows = rows.withColumn("listed", listed(levels, F.col("host")))
    rule = rule_column(F.col("host"), F.col("path"), rules, 1)
    verdict = F.coalesce(rule_column(F.col("host"), F.col("path"), rules, 0), F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "listed")


def hosts_named(pages: DataFrame, names: Sequence[str], url: str = "url") -> DataFrame:
    """A block list (host): the hosts of pages that have one of `names` among their labels."""
    listed_names = F.array(*[F.lit(x) for x in names]).cast("array<string>")
    hosts = pages.select(split_url(F.col(url))[0].alias("host")).distinct()
    return hosts.filter(F.arrays_overlap(F.split("host", r"\."), listed_names))
