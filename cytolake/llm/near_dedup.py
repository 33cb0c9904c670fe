"""Near-duplicate documents by Order MinHash, verified by a banded alignment.

A text is the sequence of its five-word shingles, each labelled with how often
it has occurred before, so labels are distinct within a text. A sketch takes
the two labelled shingles with the smallest values of a hash and keeps them in
text order; texts that share a sketch are candidates if their min-hash
signatures don't rule it out. A pair is verified by an alignment of the labelled shingles in a band: matches in order, s of them, with
s / (n + m - s) at least 0.8.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, find_words, hash_words, materialise, mix, shingle, text_blocks, trimmed

WORDS, SKETCHES = 5, 10
#: Values of a signature, 16 bits each; an estimate is within 0.04 or so of the similarity.
SIGNATURE, SLACK = 96, 0.16
#: Bits of a wide signature, from one bit of each minimum; four standard deviations of its estimate are 0.053.
BITS, WIDE_SLACK = 2048, 0.055
#: Rounds in which each text meets the most alike alone.
ROUNDS = 2
#: Pairs of ids that are broadcast at most, 16 bytes each.
MOST_SENT = 500_000
#: Texts of a set of one sketch that meet in one place; larger sets are dealt out in parts.
PART = 1000


def labelled_shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Labelled shingle hashes in text order, their rows, word hashes and theirs. A text of 1 to 4 words is one shingle."""
    starts, ends, rows = find_words(data, offsets)
    words = hash_words(data, starts, ends)
    counts = np.bincount(rows, minlength=len(offsets) - 1)
    runs = shingle(words, WORDS)
    inside = np.flatnonzero(rows[: len(runs)] == rows[WORDS - 1 :]) if len(runs) else np.zeros(0, np.int64)
    few = np.flatnonzero((counts > 0) & (counts < WORDS))
    first = np.concatenate([[0], np.cumsum(counts)])
    short = np.zeros(len(few), U64)
    for j in range(WORDS - 1):
        have = counts[few] > j
        short[have] = mix(short[have] * U64(0xD6E8FEB86659FD93) + words[first[few[have]] + j] + U64(1))
    values, of = np.concatenate([runs[inside], short]), np.concatenate([rows[inside], few])
    order = np.argsort(of, kind="stable")
    values, of = values[order], of[order]
    order = np.argsort(mix(values + of.astype(U64) * U64(0x9E3779B97F4A7C15)), kind="stable")
    v, o = values[order], of[order]
    new = np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]) if len(v) else np.zeros(0, bool)
    place = np.arange(len(v))
    occurrence = np.empty(len(v), U64)
    occurrence[order] = place - np.maximum.accumulate(np.where(new, place, 0))
    return mix(values + occurrence * U64(0xA0761D6478BD642F)), of, words, rows


def sketch(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, k1 and k2 (hashes of all words), sketches and signature (none without words)."""

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, SKETCHES + 1, dtype=U64))
        factors = mix(np.arange(1000, 1000 + SIGNATURE, dtype=U64)) | U64(1)
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                n = b - a
                labels, of, words, rows = labelled_shingles(data, offsets)
                counts = np.bincount(rows, minlength=n)
                place = (np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)).astype(U64)
                whole = []
                for seed in (U64(0x2545F4914F6CDD1D), U64(0x9FB21C651E98DF25)):
                    total = np.zeros(n, U64)
                    np.add.at(total, rows, mix(words + place * seed + seed))
                    whole.append(pa.array(total.view(np.int64)))
                have = np.unique(of)
                size = np.bincount(of, minlength=n)[have]
                first = np.cumsum(size) - size
                keys = np.zeros((len(have), SKETCHES), np.int64)
                for k in range(SKETCHES if len(have) else 0):
                    value = mix(labels ^ seeds[k])
                    places = []
                    for _ in range(2):
                        least = np.minimum.reduceat(value, first)
                        at = np.flatnonzero(value == np.repeat(least, size))
                        at = at[np.unique(of[at], return_index=True)[1]]
                        places.append(at)
                        value[at] = U64(2**64 - 1)
                    low, high = np.minimum(*places), np.maximum(*places)
                    one = size == 1
                    low[one] = high[one] = places[0][one]
                    keys[:, k] = mix(labels[low] * U64(0xD6E8FEB86659FD93) + labels[high] + seeds[k]).view(np.int64)
                least = np.zeros((n, SIGNATURE), "<u2")
                for k in range(SIGNATURE if len(have) else 0):
                    least[have, k] = mix(np.minimum.reduceat(labels * factors[k], first)) >> U64(48)
                signature = [x.tobytes() if c else None for x, c in zip(least, counts, strict=True)]
                ends = np.zeros(n + 1, np.int32)
                ends[have + 1] = SKETCHES
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(ends, dtype=np.int32)), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, n), pa.array(counts.astype(np.int64)), *whole, lists, pa.array(signature, pa.binary())], ["doc_id", "n_words", "k1", "k2", "sketches", "signature"])

    return docs.mapInArrow(trimmed(sketches), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, k1 long, k2 long, sketches array<long>, signature binary")


def shingle_table(docs: DataFrame) -> DataFrame:
    """node (doc_id) and labels: 32 bits of each labelled shingle, in text order."""

    def labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                values, of, _, _ = labelled_shingles(data, offsets)
                parts = np.split((values >> U64(32)).astype("<u4"), np.searchsorted(of, np.arange(1, b - a)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array([p.tobytes() for p in parts], pa.binary())], ["node", "labels"])

    return docs.mapInArrow(trimmed(labels), f"node {docs.schema['doc_id'].dataType.simpleString()}, labels binary")


def wide_signatures(table: DataFrame) -> DataFrame:
    """node and signature (BITS bits) of a shingle table."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = mix(np.arange(5000, 5000 + BITS, dtype=U64)) | U64(1)
        for batch in batches:
            out = []
            for raw in batch.column(1).to_pylist():
                labels, least = mix(np.frombuffer(raw, "<u4").astype(U64)), np.full(BITS, 2**64 - 1, U64)
                for at in range(0, len(labels), 512):
                    part = labels[at : at + 512, None]
                    for k in range(0, BITS, 256):
                        least[k : k + 256] = np.minimum(least[k : k + 256], (part * factors[k : k + 256]).min(0))
                out.append(np.packbits(mix(least) >> U64(63) == 1).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["node", "signature"])

    return table.mapInArrow(trimmed(sign), f"node {table.schema['node'].dataType.simpleString()}, signature binary")


def aligned(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether enough labels match in order; those further off than the allowed number of misses lie outside the band."""
    need = int(np.ceil(least * (len(a) + len(b)) / (1 + least) - 1e-9))
    if min(len(a), len(b)) < need:
        return False
    _, i, j = np.intersect1d(a, b, return_indices=True)
    band = len(a) + len(b) - 2 * need
    close = np.abs(i - j) <= band
    i, j = i[close], j[close]
    if len(i) < need:
        return False
    j = j[np.argsort(i)]
    if (j[1:] > j[:-1]).all():
        return True
    tails: list[int] = []  # longest rising run of places in b
    for x in j.tolist():
        at = bisect_left(tails, x)
        tails[at : at + 1] = [x]
    return len(tails) >= need


def verify(pairs: DataFrame, table: DataFrame, least: float) -> DataFrame:
    """Those of `pairs` (a table of node and leader, once each) whose texts are near.

    Up to MOST_SENT pairs are sent to the texts, more meet them in a shuffle;
    then only the texts of pairs are shuffled.
    """
    sent = F.broadcast(pairs) if pairs.count() <= MOST_SENT else pairs
    theirs = table.withColumnsRenamed({"node": "leader", "labels": "theirs"})
    both = table.join(sent, "node").join(theirs.join(sent, "leader"), ["node", "leader"])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [aligned(np.frombuffer(a.as_py(), "<u4"), np.frombuffer(b.as_py(), "<u4"), least) for a, b in zip(batch.column(2), batch.column(3), strict=True)]
            yield batch.select(["node", "leader"]).filter(pa.array(keep, pa.bool_()))

    return both.select("node", "leader", "labels", "theirs").mapInArrow(trimmed(near), pairs.select("node", "leader").schema)


def components(edges: DataFrame) -> DataFrame:
    """node and label (the least node it is linked with, over any number of links) of edges (node, leader)."""
    both = materialise(edges.select("node", F.col("leader").alias("other")).union(edges.select("leader", "node")).distinct(), "edges")
    labels = both.groupBy("node").agg(F.min("other").alias("label")).select("node", F.least("node", "label").alias("label"))
    labels = materialise(labels, "labels")
    while True:
        best = both.join(labels.withColumnsRenamed({"node": "other", "label": "found"}), "other").groupBy("node").agg(F.min("found").alias("found"))
        step = labels.join(best, "node").select("node", F.least("label", "found").alias("next"), F.col("label").alias("old"))
        jump = step.join(labels.withColumnsRenamed({"node": "next", "label": "further"}), "next", "left")
        moved = materialise(jump.select("node", F.least("next", F.coalesce("further", "next")).alias("label"), "old"), "labels")
        labels = moved.select("node", "label")
        if moved.filter("label <> old").isEmpty():
            return labels


def linked(labels: DataFrame | None, found: DataFrame) -> DataFrame:
    """Labels (node, label) after more links (node, leader)."""
    known = found if labels is None else found.union(labels.filter("node <> label").select("node", F.col("label").alias("leader")))
    return components(known)


def apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Those of `pairs` (node, leader and other columns) whose nodes are not in the same class so far."""
    joined = pairs.join(labels.withColumnRenamed("label", "own"), "node", "left").join(labels.withColumnsRenamed({"node": "leader", "label": "theirs"}), "leader", "left")
    return joined.filter("coalesce(own, node) <> coalesce(theirs, leader)").select(pairs.columns)


def open_sets(bands: DataFrame, waiting: DataFrame, labels: DataFrame, signatures: DataFrame) -> DataFrame:
    """Bands of the sets of several classes in which nodes of `waiting` (node, sketch, value) wait, with labels and signatures (node, signature)."""
    waiting = waiting.select("sketch", "value", "node").distinct()
    rows = bands.select("node", "sketch", "value").join(waiting.select("sketch", "value").distinct(), ["sketch", "value"], "left_semi")
    rows = rows.join(waiting.withColumn("open", F.lit(True)), ["sketch", "value", "node"], "left").join(labels, "node", "left")
    rows = materialise(rows.select("node", F.coalesce("label", "node").alias("label"), "sketch", "value", F.coalesce("open", F.lit(False)).alias("waiting")), "open")
    several = rows.groupBy("sketch", "value").agg(F.min("label").alias("low"), F.max("label").alias("high")).filter("low < high").select("sketch", "value")
    return rows.join(several, ["sketch", "value"], "left_semi").join(signatures, "node")


def parted_sets(bands: DataFrame, labels: DataFrame, table: DataFrame) -> DataFrame:
    """Bands of the sets of several classes of texts in `table`, with labels, sketches and wide signatures.

    All wait but those of a set's largest class, so of two texts of different
    classes in a set one waits.
    """
    rows = bands.join(table.select("node"), "node", "left_semi").join(labels, "node", "left")
    rows = materialise(rows.select("node", F.coalesce("label", "node").alias("label"), "sketch", "value"), "open")
    sizes = rows.groupBy("sketch", "value", "label").agg(F.count("*").alias("n"))
    several = materialise(sizes.groupBy("sketch", "value").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count("*").alias("classes")).filter("classes > 1"), "several")
    rows = materialise(rows.join(several, ["sketch", "value"]).select("node", "label", "sketch", "value", (F.col("label") != F.col("largest")).alias("waiting")), "parted")
    signatures = wide_signatures(table.join(rows.select("node").distinct(), "node", "left_semi"))
    lists = bands.join(rows.select("node").distinct(), "node", "left_semi").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("sketch", "value")))["value"].alias("sketches"))
    return rows.join(signatures.join(lists, "node"), "node")


def large_sets(bands: DataFrame) -> DataFrame | None:
    """sketch, value and `parts` of the sets of more than PART nodes, if there are any."""
    sizes = bands.groupBy("sketch", "value").agg(F.count("*").alias("n")).filter(F.col("n") > PART)
    large = materialise(sizes.select("sketch", "value", F.ceil(F.col("n") / PART).cast("int").alias("parts")), "large")
    return None if large.isEmpty() else large


def dealt(bands: DataFrame, large: DataFrame | None, mode: str) -> DataFrame:
    """bands with part and home: a node of a large set lies in the part of its hash, and in mode all, while it waits, in every part, so it meets each other node where that is at home."""
    if large is None:
        return bands.withColumns({"part": F.lit(0), "home": F.lit(True)})
    rows = bands.join(large, ["sketch", "value"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    rows = rows.withColumn("own_part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    every = F.col("waiting") if mode == "all" else F.lit(False)
    rows = rows.withColumn("part", F.explode(F.when(every, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array("own_part"))))
    return rows.withColumn("home", F.col("part") == F.col("own_part")).drop("parts", "own_part")


def spokesmen(bands: DataFrame, labels: DataFrame, large: DataFrame) -> DataFrame:
    """Of each class in a large set the least node, waiting, so that parts whose classes are near come together."""
    rows = bands.join(large.select("sketch", "value"), ["sketch", "value"], "left_semi").join(labels, "node", "left")
    least = rows.groupBy("sketch", "value", F.coalesce("label", "node").alias("label")).agg(F.min("node").alias("node"))
    return least.join(bands.select("node", "sketch", "value", "signature"), ["sketch", "value", "node"]).withColumn("waiting", F.lit(True))


def candidates(bands: DataFrame, n_buckets: int, least: float, mode: str, large: DataFrame | None = None) -> DataFrame:
    """Pairs (node, leader, sketch, value, alike) of bands (node, label, sketch, value, signature, waiting) with the same sketch.

    In each set the first waiting node is compared by signature with all that
    have another label, which are not known to be in its class; `alike` is the
    estimate of the similarity, and pairs that it rules out are dropped. Then the
    next waiting node is first, until none waits. By mode:

    - leader: waiting nodes that may be near the first form pairs with it and wait no longer, and the first forms one with the most alike of those that had stopped;
    - best: the first forms a pair with the most alike alone;
    - all: the first forms a pair with each that may be near by wide signatures.

    A part of a set lies in one task, which holds some 200 bytes for each of its nodes.
    """

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["sketch", "value", "part", "node"], ignore_index=True)
        change = np.logical_or.reduce([pdf[c].values[1:] != pdf[c].values[:-1] for c in ("sketch", "value", "part")])
        key = np.cumsum(np.concatenate([[0], change.astype(np.int64)]))
        size = np.bincount(key)
        rows = np.flatnonzero(np.repeat(size > 1, size))
        wide = mode == "all"
        if wide:
            sketches, number = np.stack([*pdf["sketches"].iloc[rows], np.zeros(SKETCHES, np.int64)])[:-1], pdf["sketch"].to_numpy()[rows]
        signature = np.frombuffer(b"".join(pdf["signature"].iloc[rows]), U64 if wide else "<u2").reshape(len(rows), BITS // 64 if wide else SIGNATURE)
        group, waiting, label, home = key[rows], pdf["waiting"].to_numpy()[rows].copy(), pdf["label"].to_numpy()[rows], pdf["home"].to_numpy()[rows].astype(bool)
        at, pairs, estimates = np.arange(len(rows)), [np.zeros((0, 2), np.int64)], [np.zeros(0)]
        while waiting[at].any():
            begin = np.flatnonzero(np.concatenate([[True], group[at][1:] != group[at][:-1]]))
            size = np.diff(np.concatenate([begin, [len(at)]]))
            first = np.minimum.reduceat(np.where(waiting[at], np.arange(len(at)), len(at)), begin)
            leader = at[np.minimum(np.repeat(first, size), len(at) - 1)]
            open_rows = np.repeat(first < len(at), size)
            at, leader = at[open_rows], leader[open_rows]
            alike = np.zeros(len(at))
            for lo in range(0, len(at), 100_000):
                part = slice(lo, lo + 100_000)
                a, b = signature[at[part]], signature[leader[part]]
                alike[part] = 1 - np.bitwise_count(a ^ b).sum(1, dtype=np.int64) * (2 / BITS) if wide else (a == b).mean(1)
            alike[label[at] == label[leader]] = 0
            near = (alike >= least - (WIDE_SLACK if wide else SLACK)) & home[at]
            if wide:  # a pair that shares several sketches comes from the first alone
                near[near] = (sketches[at[near]] == sketches[leader[near]]).argmax(1) == number[at[near]]
            fresh = np.flatnonzero(near & waiting[at] if mode == "leader" else near & False)
            known = np.flatnonzero(near & ~waiting[at] if mode == "leader" else near)
            if mode != "all":  # the most alike, one of each set
                known = known[np.lexsort((known, -alike[known], group[at[known]]))]
                known = known[np.unique(group[at[known]], return_index=True)[1]]
            waiting[at[fresh]] = False
            pairs += [np.stack([rows[at[fresh]], rows[leader[fresh]]], 1), np.stack([rows[leader[known]], rows[at[known]]], 1)]
            estimates += [alike[fresh], alike[known]]
            waiting[leader] = False
        both = np.concatenate(pairs)
        asked = pdf.iloc[both[:, 0]][["node", "sketch", "value"]]
        asked.insert(1, "leader", pdf["node"].to_numpy()[both[:, 1]])
        return asked.assign(alike=np.concatenate(estimates))

    kind = bands.schema["node"].dataType.simpleString()
    bucket = F.pmod(F.xxhash64("sketch", "value", "part"), F.lit(n_buckets))
    return dealt(bands, large, mode).withColumn("bucket", bucket).groupBy("bucket").applyInPandas(meet, f"node {kind}, leader {kind}, sketch int, value long, alike double")


def near_duplicates(docs: DataFrame, least: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of docs: doc_id, class_id (the least id of its class), n_words and kept (it has that id).

    Texts with the same words, but for case and white space, are copies; of
    those one stands for all. Candidates are verified by alignment, first the
    most alike one for each text. A text that is then not in the class of one it
    is a candidate with is compared with those of its sets that are in other
    classes: in one more round with the most alike. In the end all texts of
    sets of several classes meet all of other classes that a wide signature does
    not rule out, so links between classes are not lost. Sets of more than PART
    texts are dealt out: each part finds its own classes, of which one text each
    then meet, and in the end a text that is not in its set's largest class meets
    every part. Classes are the connected components. A text without
    words, null or empty, and a row without id are classes of their own. Rows
    with the same id count as one document. Whole texts of any length are read;
    an empty table gives no row, and other columns don't matter.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = materialise(sketch(own), "sketches")
    real = rows.filter("n_words > 0 AND doc_id IS NOT NULL")
    copies = materialise(real.groupBy("k1", "k2", "n_words").agg(F.min("doc_id").alias("node"), F.min_by(F.struct("sketches", "signature"), "doc_id").alias("own")).select("k1", "k2", "n_words", "node", "own.*"), "copies")
    n_copies = copies.count()
    n_buckets = max(8, n_copies // 400)
    bands = copies.select("node", "signature", F.posexplode("sketches").alias("sketch", "value"))
    large = large_sets(bands)
    asked = materialise(candidates(bands.withColumns({"label": F.col("node"), "waiting": F.lit(True)}), n_buckets, least, "leader", large), "asked")
    ids = materialise(asked.select(F.col("node").alias("doc_id")).union(asked.select("leader")).distinct(), "ids")
    texts = own.join(F.broadcast(ids) if ids.count() <= MOST_SENT else ids, "doc_id", "left_semi")
    table = materialise(shingle_table(texts), "shingles")
    labels, waiting = None, asked
    if large is not None:
        best = materialise(asked.groupBy("node").agg(F.max_by("leader", F.struct("alike", "leader")).alias("leader")), "best")
        labels = linked(labels, verify(best, table, least))
        told = materialise(candidates(spokesmen(bands, labels, large), n_buckets, least, "leader"), "asked")
        more = materialise(shingle_table(own.join(told.select(F.col("node").alias("doc_id")).union(told.select("leader")).distinct().join(ids, "doc_id", "left_anti"), "doc_id", "left_semi")), "shingles")
        table = table.union(more)
        asked = waiting = materialise(asked.union(told), "asked")
    for _ in range(ROUNDS):
        best = materialise(asked.groupBy("node").agg(F.max_by("leader", F.struct("alike", "leader")).alias("leader")), "best")
        labels = linked(labels, verify(best, table, least))
        waiting = materialise(apart(waiting, labels), "waiting")
        asked = materialise(candidates(open_sets(bands, waiting, labels, copies.select("node", "signature")), n_buckets, least, "best", large), "asked")
        if asked.isEmpty():
            break
    asked = materialise(candidates(parted_sets(bands.select("node", "sketch", "value"), labels, table), n_buckets, least, "all", large), "asked")
    pairs = asked.groupBy(F.greatest("node", "leader").alias("node"), F.least("node", "leader").alias("leader")).agg(F.max("alike").alias("alike"))
    pairs = materialise(pairs, "pairs")
    for low, most in ((least, 2.0), (0.0, least)):
        some = materialise(apart(pairs.filter((F.col("alike") >= low) & (F.col("alike") < most)), labels), "some")
        labels = linked(labels, verify(some.select("node", "leader"), table, least))
    result = rows.join(copies.select("k1", "k2", "n_words", "node"), ["k1", "k2", "n_words"], "left")
    real_row = F.expr("n_words > 0 AND doc_id IS NOT NULL")
    result = result.join(labels, "node", "left")
    class_id = F.when(real_row, F.coalesce("label", "node")).otherwise(F.col("doc_id"))
    return result.select("doc_id", class_id.alias("class_id"), "n_words", (F.col("doc_id").isNull() | (F.col("doc_id") == class_id)).alias("kept"))
