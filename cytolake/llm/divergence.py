"""Divergence of sources by a systolic rotation of term vectors.

Every source of a language is compared with every other one and with the whole
language over the terms that at least `least_docs` of its documents hold. The
terms of a language are cut into slices of bounded size, and the counts of a
group (lang, source) in a slice are one compressed vector. Vectors sit in
seats, a few groups each. In the home round the groups of a seat meet each other
and the language; after that each round of a round-robin tournament sends the
vectors of one half of the seats to the other half, whose own stay in their
partitions, and a meeting is evaluated in both directions. Sums over slices
are added up at the end. The terms of a group are ranked by a heap in each slice.

All values are whole numbers and exact. A null text, language or source counts
as ''. Repeated rows count each, ties are ordered by name, groups without terms
and languages without kept terms take part (value 0); ids and further columns
of any name don't matter; no rows give no rows. A text is read whole.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import find_words, fresh_path, materialise, text_blocks
from .phrases import slices

#: Terms in a slice (about), groups in a seat, parts in which a group's best terms are ranked first.
TERMS, SEAT, PARTS = 8192, 4, 64
#: Bytes of terms that are counted at a time, and of text from which they are taken at a time.
HELD, STEP = 16 << 20, 1 << 20
#: Chances are whole parts of this number (fixed value), reached by steps of a thousand.
UNIT_STEPS, UNIT_STEP = 3, 1000

_GAPS = np.ones(256, bool)
_GAPS[0x80:] = False
_GAPS[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _named(docs: DataFrame) -> DataFrame:
    return docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) by runs of documents: occurrences and documents with the term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[pa.Array, np.ndarray]] = []
        group_of: list[int] = []
        groups: dict[tuple[str, str], int] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            terms = pa.chunked_array([h[0] for h in held]).combine_chunks().dictionary_encode()
            ids, texts = terms.indices.to_numpy().astype(np.int64), np.concatenate([h[1] for h in held])
            size, own = max(1, len(terms.dictionary)), np.array(group_of, np.int64)
            cells, n = np.unique(own[texts] * size + ids, return_counts=True)
            once = np.unique(texts * size + ids)
            _, with_term = np.unique(own[once // size] * size + once % size, return_counts=True)
            names = list(groups)
            lang, source = (pa.array([x[i] for x in names], pa.string()).take(pa.array(cells // size)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([lang, source, terms.dictionary.take(pa.array(cells % size)).cast(pa.binary()).cast(pa.string()), pa.array(n), pa.array(with_term)], ["lang", "source", "term", "n", "docs"])
            held.clear()
            group_of.clear()
            groups.clear()

        size = 0
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for a, b, data, offsets in text_blocks(batch.column(2), STEP):
                first = len(group_of)
                group_of += [groups.setdefault(x, len(groups)) for x in names[a:b]]
                begins, ends, rows = find_words(data, offsets, _GAPS)
                low = _LOWER[data]
                for i in range(0, len(begins), STEP >> 2):
                    part = slices(low, begins[i : i + (STEP >> 2)], ends[i : i + (STEP >> 2)])
                    held.append((part, first + rows[i : i + (STEP >> 2)]))
                    size += part.nbytes
                if size > HELD:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()

    return _named(docs).mapInArrow(run, "lang string, source string, term string, n long, docs long")


def kept_cells(docs: DataFrame, least_docs: int) -> DataFrame:
    """(lang, source, term, n, lang_n, first) of the terms in `least_docs` documents of a language or more; first: one row of each term."""
    cells = term_counts(docs).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")
    cells = cells.withColumns({"lang_n": F.sum("n").over(term), "lang_docs": F.sum("docs").over(term), "first": F.min("source").over(term) == F.col("source")})
    return materialise(cells.filter(F.col("lang_docs") >= least_docs).drop("docs", "lang_docs"), "kept-terms")


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """A vector: steps between ids and counts, each in as few bytes as they need, compressed."""
    parts = []
    for values in (np.diff(ids, prepend=-1), counts):
        small = values.astype(np.min_scalar_type(int(values.max(initial=0))))
        parts.append(bytes([small.itemsize]) + small.tobytes())
    return len(ids).to_bytes(4, "little") + zlib.compress(b"".join(parts), 1)


def unpack(vector: bytes | None, size: int) -> np.ndarray:
    """The counts of all terms of a slice."""
    out = np.zeros(size, np.int64)
    if vector:
        n, raw = int.from_bytes(vector[:4], "little"), zlib.decompress(vector[4:])
        steps = np.frombuffer(raw, f"<u{raw[0]}", n, 1)
        a = 1 + n * raw[0]
        out[np.cumsum(steps.astype(np.int64)) - 1] = np.frombuffer(raw, f"<u{raw[a]}", n, a + 1)
    return out


def chances(counts: np.ndarray, total: int, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 1) / (total + terms)), by long division, so that no product passes 64 bits."""
    whole, rest = np.divmod(counts + 1, total + terms)
    for _ in range(UNIT_STEPS):
        digit, rest = np.divmod(rest * UNIT_STEP, total + terms)
        whole = whole * UNIT_STEP + digit
    return whole + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / q)"""
    return (p - q) ** 2 // q


class Seat:
    """The vectors of some groups in one slice."""

    def __init__(self, table: pa.Table):
        rows = table.select(["source", "total", "terms", "size", "vector"]).to_pylist()
        self.names = [r["source"] for r in rows]
        self.size = rows[0]["size"] if rows else 0
        self.counts = [unpack(r["vector"], r["size"]) for r in rows]
        self.p = [chances(c, r["total"], r["terms"]) for c, r in zip(self.counts, rows, strict=True)]
        self.none = [chances(np.zeros(1, np.int64), r["total"], r["terms"]) if r["size"] else np.ones(1, np.int64) for r in rows]

    def meet(self, i: int, other: Seat, j: int) -> tuple[int, int]:
        """Both directions: from group i here to j there, and back. Terms that neither has are alike."""
        some = np.flatnonzero((self.counts[i] > 0) | (other.counts[j] > 0))
        p, q, rest = self.p[i][some], other.p[j][some], self.size - len(some)
        return tuple(int(gaps(x, y).sum()) + rest * int(gaps(x0, y0)[0]) for x, y, x0, y0 in ((p, q, self.none[i], other.none[j]), (q, p, other.none[j], self.none[i])))

    def best(self, i: int, q: np.ndarray, top: int) -> list[tuple[int, int]]:
        """(value, term) of the first terms that group i uses more than q, by a heap."""
        over = np.flatnonzero((self.counts[i] > 0) & (self.p[i] > q))
        values = gaps(self.p[i][over], q[over])
        return [(-v, t) for v, t in heapq.nsmallest(top, zip((-values).tolist(), over.tolist(), strict=True))]


MEETING = "lang string, slice int, source string, item string, term int, value long"


def _meetings(lang: str, part: int, found: list[tuple]) -> pa.Table:
    names = ["source", "item", "term", "value"]
    columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int32(), pa.int64()))]
    return pa.table([pa.array([lang] * len(found), pa.string()), pa.array([part] * len(found), pa.int32()), *columns], ["lang", "slice", *names])


def _home(top: int):
    def run(key: tuple, own: pa.Table, whole: pa.Table) -> pa.Table:
        seat, lang, found = Seat(own), Seat(whole), []
        for i, name in enumerate(seat.names):
            for j in range(i):
                there, back = seat.meet(i, seat, j)
                found += [(name, seat.names[j], None, there), (seat.names[j], name, None, back)]
            if lang.names:
                found += [(name, None, t, v) for v, t in seat.best(i, lang.p[0], top)]
        return _meetings(key[0].as_py(), key[1].as_py(), found)

    return run


def _away(key: tuple, own: pa.Table, visitors: pa.Table) -> pa.Table:
    seat, other, found = Seat(own), Seat(visitors), []
    for i, name in enumerate(seat.names):
        for j, peer in enumerate(other.names):
            there, back = seat.meet(i, other, j)
            found += [(name, peer, None, there), (peer, name, None, back)]
    return _meetings(key[0].as_py(), key[1].as_py(), found)


def partner(seat: Column, seats: Column, turn: int) -> Column:
    """Whom a seat meets in a round of the circle method; seats is even, and turn below seats - 1."""
    last = seats - 1
    return F.when(seat == last, F.lit(turn)).when(seat == turn, last).otherwise(F.pmod(F.lit(2 * turn) - seat, last)).cast("int")


def vectors(cells: DataFrame, most_terms: int) -> tuple[DataFrame, DataFrame]:
    """Vectors (lang, slice, source, sum, size, vector) with null as the source of a language's own, and the terms (lang, slice, id, term)."""
    count = max(1, -(-most_terms // TERMS))
    part = Window.partitionBy("lang", "slice").orderBy("term")
    numbered = cells.withColumn("slice", F.pmod(F.xxhash64("term"), F.lit(count)).cast("int")).withColumn("id", F.dense_rank().over(part) - 1)
    numbered = materialise(numbered, "numbered-terms")
    both = numbered.select("lang", "slice", "source", "id", "n").unionByName(numbered.filter("first").select("lang", "slice", F.lit(None).cast("string").alias("source"), "id", F.col("lang_n").alias("n")))

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("id")
        ids, n = rows["id"].to_numpy().astype(np.int64), rows["n"].to_numpy()
        values = [key[0].as_py(), key[1].as_py(), key[2].as_py(), int(n.sum()), int(ids[-1]) + 1, pack(ids, n)]
        return pa.table([pa.array([v], k) for v, k in zip(values, (pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.binary()), strict=True)], ["lang", "slice", "source", "sum", "size", "vector"])

    packed = both.groupBy("lang", "slice", "source").applyInArrow(run, "lang string, slice int, source string, sum long, size int, vector binary")
    return materialise(packed, "vectors"), numbered.filter("first").select("lang", "slice", "id", "term")


def audit_sources(docs: DataFrame, least_docs: int = 3, top: int = 200) -> DataFrame:
    """(lang, source, part, item, value, rank): part `pair` has every other source of the language by falling divergence, part `term` the first `top` terms that a source uses more than its language."""
    cells = kept_cells(docs, least_docs)
    most = cells.filter("first").groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    packed, terms = vectors(cells, most)

    # all groups, each with its seat and totals; a language without terms has one empty slice
    groups = _named(docs).select("lang", "source").distinct()
    own, whole = packed.filter("source IS NOT NULL"), packed.filter("source IS NULL")
    langs = whole.groupBy("lang").agg(F.sum("sum").alias("lang_total"), F.sum("size").alias("terms"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    seats = F.ceil(F.count("*").over(Window.partitionBy("lang")) / F.lit(SEAT))
    groups = groups.withColumns({"seat": F.floor(number / F.lit(SEAT)).cast("int"), "seats": (seats + seats % 2).cast("int")})
    groups = groups.join(own.groupBy("lang", "source").agg(F.sum("sum").alias("total")), ["lang", "source"], "left").join(langs, "lang", "left")
    groups = materialise(groups.fillna(0, ["total", "terms", "lang_total"]), "groups")
    grid = groups.join(whole.select("lang", "slice", "size"), "lang", "left").fillna(0, ["slice", "size"])
    seated = materialise(grid.join(own.drop("sum", "size"), ["lang", "slice", "source"], "left"), "seats")

    spark, key = docs.sparkSession, ["lang", "slice", "seat"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_path(spark, "meetings")
    resident = seated.repartition(parts, *key).persist(StorageLevel.MEMORY_AND_DISK)
    at_home = groups.select("lang", "seat", "lang_total", "terms").distinct().join(whole, "lang").withColumnRenamed("lang_total", "total")
    resident.groupBy(key).cogroup(at_home.groupBy(key)).applyInArrow(_home(top), MEETING).write.parquet(path)
    most_seats, last_seat = groups.agg(F.max("seats"), F.max("seat")).first()
    for turn in range(most_seats - 1 if last_seat else 0):
        visitors = seated.filter(F.col("seats") - 1 > turn).withColumn("home", partner(F.col("seat"), F.col("seats"), turn)).filter("home < seat")
        visitors = visitors.drop("seat").withColumnRenamed("home", "seat")
        resident.groupBy(key).cogroup(visitors.groupBy(key)).applyInArrow(_away, MEETING).write.mode("append").parquet(path)
    resident.unpersist()

    met = spark.read.schema(MEETING).parquet(path)
    order = [F.desc("value"), F.asc("item")]
    pairs = met.filter("term IS NULL").groupBy("lang", "source", "item").agg(F.sum("value").alias("value")).withColumn("part", F.lit("pair"))
    pairs = pairs.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    best = met.filter("term IS NOT NULL").drop("item").withColumnRenamed("term", "id").join(terms.withColumnRenamed("term", "item"), ["lang", "slice", "id"]).withColumn("part", F.lit("term"))
    for by in (["lang", "source", F.pmod("slice", F.lit(PARTS))], ["lang", "source"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= top)
    names = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(names).unionByName(best.select(names))
