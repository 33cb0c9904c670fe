"""Language-model scoring with a log-frequency Bloom filter.

Counts of words and word pairs are quantised to levels 1 + floor(log_b count);
the filter holds (n-gram, 1) to (n-gram, level). A worker finds a level by
probing for 1, 2, ... until one is missing, and smooths the probabilities.
The filter is cut into segments by the n-gram's hash, so each is built where
its counts meet and no one merges whole filters. A corpus is scored in chunks:
a chunk's n-grams meet their segment where it is built, and only their levels
and exact counts go back to the chunk, so nothing but totals is held whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LARGE_ROWS, U64, find_words, give_back, hash_words, materialise, mix, text_blocks, trimmed

END = U64(0xA0761D6478BD642F)
GROWTH = 1.5
LEVELS = 64
#: Tokens that a task counts before it sends them on.
FLUSH = 1_000_000
#: Bytes of text in a chunk, at least, but for the last of a task.
CHUNK = 4 << 20

#: Count that stands for each level: the mean of the counts that have it.
_bounds = np.ceil(GROWTH ** np.arange(LEVELS + 1) - 1e-9)
ESTIMATE = np.concatenate([[0.0], np.maximum(1.0, (_bounds[:-1] + np.maximum(_bounds[1:] - 1, _bounds[:-1])) / 2)])


def level_of(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / np.log(GROWTH) + 1e-9).astype(np.int64)


def tokens_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each token (words lower-cased A-Z, then an end per text), that of the pair with the one before, and the row."""
    starts, ends, rows = find_words(data, offsets)
    n = len(offsets) - 1
    out, of = np.full(len(starts) + n, END, U64), np.empty(len(starts) + n, np.int64)
    at = np.arange(len(starts)) + rows
    out[at] = hash_words(data, starts, ends)
    of[at] = rows
    tail = np.cumsum(np.bincount(rows, minlength=n)) + np.arange(n)
    of[tail] = np.arange(n)
    before = np.concatenate([[END], out[:-1]])
    return out, mix(before * U64(0xD6E8FEB86659FD93) + out + U64(1)), of


def count_ngrams(docs: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, n (1 or 2), keys (sorted 64-bit hashes), counts (32-bit): counts of a task's tokens, added up before they are shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list] = ([], [])

        def flush() -> pa.RecordBatch:
            bucket, order, keys, counts = [], [], [], []
            for n, parts in enumerate(held, 1):
                distinct, times = np.unique(np.concatenate(parts), return_counts=True)
                cut = np.searchsorted(distinct, np.arange(1, n_buckets, dtype=U64) << U64(64 - n_buckets.bit_length() + 1))
                for b, (k, c) in enumerate(zip(np.split(distinct, cut), np.split(times.astype("<u4"), cut), strict=True)):
                    if len(k):
                        bucket.append(b)
                        order.append(n)
                        keys.append(k.tobytes())
                        counts.append(c.tobytes())
                parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(order, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "n", "keys", "counts"])

        size = 0
        for batch in batches:
            for _, _, data, offsets in text_blocks(batch.column(0), 1 << 20):
                one, two, _ = tokens_of(data, offsets)
                held[0].append(one)
                held[1].append(two)
                size += len(one)
                if size >= FLUSH:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return docs.select("text").mapInArrow(count, "bucket int, n int, keys binary, counts binary")


def probe_places(keys: np.ndarray, level: int | np.ndarray, n_words: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The word of a segment for (n-gram, level), and four bits in it."""
    h = mix(keys + np.asarray(level, U64) * U64(0x9E3779B97F4A7C15))
    mask = np.zeros(len(h), U64)
    for shift in (0, 6, 12, 18):
        mask |= U64(1) << ((h >> U64(shift)) & U64(63))
    return ((h >> U64(24)) % np.asarray(n_words, U64)).astype(np.int64), mask


def summed(keys: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of several lists, their summed counts, and which of them each key in the lists is."""
    every = np.frombuffer(b"".join(keys), U64)
    distinct, which = np.unique(every, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, which, np.frombuffer(b"".join(counts), "<u4").astype(np.int64))
    return distinct, total, which


def segment(keys: np.ndarray, counts: np.ndarray, bits_per_key: int) -> np.ndarray:
    """The filter's words for n-grams and their counts; it grows with them."""
    levels = level_of(counts)
    words = np.zeros(int(levels.sum()) * bits_per_key // 64 + 1, U64)
    for level in range(1, int(levels.max(initial=0)) + 1):
        place, mask = probe_places(keys[levels >= level], level, len(words))
        np.bitwise_or.at(words, place, mask)
    return words


def packed(counts: np.ndarray) -> bytes:
    """Exact counts in 4 bytes each, or in 8 if one needs them."""
    return counts.astype("<u4" if counts.max(initial=0) < 2**32 else "<i8").tobytes()


def build_segments(counted: DataFrame, bits_per_key: int) -> DataFrame:
    """Per bucket: number of tokens and of distinct ones, their hashes and exact counts, and the filter's segment."""

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        keys, totals = {}, {}
        for n in (1, 2):
            part = pdf[pdf["n"] == n]
            keys[n], totals[n], _ = summed(part["keys"].tolist(), part["counts"].tolist())
        words = segment(np.concatenate([keys[1], keys[2]]), np.concatenate([totals[1], totals[2]]), bits_per_key)
        return pd.DataFrame({"bucket": pdf["bucket"].iloc[:1], "tokens": totals[1].sum(), "types": len(keys[1]), "mass": ESTIMATE[level_of(totals[1])].sum(), "keys": [keys[1].tobytes()], "counts": [packed(totals[1])], "segment": [words.tobytes()]})

    return counted.groupBy("bucket").applyInPandas(build, "bucket int, tokens long, types long, mass double, keys binary, counts binary, segment binary")


@dataclass
class Filter:
    n_buckets: int
    words: np.ndarray
    first: np.ndarray  # of each bucket's segment
    sizes: np.ndarray  # 0: no n-gram
    tokens: int
    types: int
    mass: float = 0.0  # sum of what the words' levels stand for

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """Level of each n-gram by repeated probes; 0 if it has none."""
        out = np.zeros(len(keys), np.int64)
        bucket = (keys >> U64(64 - self.n_buckets.bit_length() + 1)).astype(np.int64) if self.n_buckets > 1 else np.zeros(len(keys), np.int64)
        left = np.flatnonzero(self.sizes[bucket] > 0)
        level = 1
        while len(left) and level <= LEVELS:
            b = bucket[left]
            place, mask = probe_places(keys[left], level, self.sizes[b])
            left = left[self.words[self.first[b] + place] & mask == mask]
            out[left] = level
            level += 1
        return out


def buckets(docs: DataFrame) -> int:
    return 1 << min(22, max(4, (docs.count() // 1000).bit_length()))


def train(docs: DataFrame, bits_per_key: int = 10, max_bytes: int = 256 << 20) -> tuple[Filter, DataFrame]:
    """The filter, to be broadcast, and the exact counts of words as a table (bucket, keys, counts).

    Buckets follow the number of documents. The filter grows with the n-grams
    and is held whole, here and in the tasks of `score`: one of more than
    `max_bytes` raises. score_corpus takes a corpus of any size and holds none.
    """
    n_buckets = buckets(docs)
    table = materialise(build_segments(count_ngrams(docs, n_buckets), bits_per_key), "ngrams")
    rows = table.select("bucket", "tokens", "types", "mass", (F.length("segment") / 8).cast("long").alias("size")).collect()
    first, sizes = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
    for r in rows:
        sizes[r["bucket"]] = r["size"]
    first[1:] = np.cumsum(sizes)[:-1]
    if 8 * int(sizes.sum()) > max_bytes:
        raise ValueError("the filter is too large to be broadcast; use score_corpus")
    words = np.zeros(int(sizes.sum()) + 1, U64)
    for r in table.select("bucket", "segment").toLocalIterator():
        words[first[r["bucket"]] :][: sizes[r["bucket"]]] = np.frombuffer(r["segment"], U64)
    return Filter(n_buckets, words, first, sizes, sum(r["tokens"] for r in rows), sum(r["types"] for r in rows), sum(r["mass"] for r in rows)), table.select("bucket", "types", "keys", "counts")


def score(docs: DataFrame, model: Filter, vocabulary: DataFrame, weight: float = 10.0, max_words: int = 4_000_000) -> DataFrame:
    """Per row of docs (doc_id, text): n_tokens, n_known, base_score and score.

    score is the sum of log10 ((c(vw) + weight * p(w)) / (c(v) + weight)), with
    counts c from the filter, that is what their levels stand for, and
    p(w) = (c(w) + 1) / (sum of all c(w) + types + 1), so p adds up to 1. The
    base needs exact counts: the vocabulary goes to the tasks in blocks of at
    most `max_words` words; with several blocks, every block sees all rows, and
    the parts are added up by row. A null or empty text is its end alone.
    """
    context = docs.sparkSession.sparkContext
    blocks: list[list[int]] = [[]]
    types, held = {}, 0
    for r in vocabulary.select("bucket", "types").orderBy("bucket").collect():
        if blocks[-1] and held + r["types"] > max_words:
            blocks.append([])
            held = 0
        blocks[-1].append(r["bucket"])
        types[r["bucket"]] = r["types"]
        held += r["types"]
    if len(blocks) > 1:
        docs = materialise(docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id()), "rows")
    else:
        docs = docs.select("doc_id", "text", F.lit(0).cast("long").alias("row"))
    shared = context.broadcast(model)
    del model
    out = None
    for number, block in enumerate(blocks):
        begin = dict(zip(block, np.cumsum([0, *(types[b] for b in block[:-1])]).tolist(), strict=True)) if block else {}
        keys = np.zeros(sum(types[b] for b in block), U64)
        counts, large = np.zeros(len(keys), np.uint32), []
        for r in vocabulary.filter(F.col("bucket").between(block[0], block[-1]) if block else F.lit(False)).select("bucket", "keys", "counts").toLocalIterator():
            at, n = begin[r["bucket"]], types[r["bucket"]]
            exact = np.frombuffer(r["counts"], "<u4" if len(r["counts"]) == 4 * n else "<i8")
            keys[at : at + n] = np.frombuffer(r["keys"], U64)
            counts[at : at + n] = np.minimum(exact, 2**32 - 1)
            large += [(at + i, int(exact[i])) for i in np.flatnonzero(exact >= 2**32 - 1)]
        exact = context.broadcast((keys, counts, large))
        del keys, counts

        def rate(batches: Iterator[pa.RecordBatch], exact=exact, main=number == 0) -> Iterator[pa.RecordBatch]:
            model = shared.value
            keys, counts, large = exact.value
            total = np.log10(model.tokens + model.types + 1)
            for batch in batches:
                for a, b, data, offsets in text_blocks(batch.column(1), 1 << 20):
                    one, two, row = tokens_of(data, offsets)
                    n = b - a
                    distinct, back = np.unique(one, return_inverse=True)
                    at = np.minimum(np.searchsorted(keys, distinct), max(0, len(keys) - 1))
                    c = np.where(keys[at] == distinct, counts[at], 0).astype(np.int64) if len(keys) else np.zeros(len(distinct), np.int64)
                    for k, v in large:
                        c[distinct == keys[k]] = v
                    tokens = np.bincount(row, minlength=n)
                    known = np.bincount(row, (c > 0)[back], n).astype(np.int64)
                    base = np.bincount(row, np.log10(c + 1.0)[back], n) - (total * tokens if main else 0)
                    mine = np.zeros(n)
                    if main:
                        single = ESTIMATE[model.levels(distinct)]
                        now = single[back]
                        before = np.concatenate([[ESTIMATE[model.levels(np.array([END]))[0]]], now[:-1]])
                        pair = np.minimum(ESTIMATE[model.levels(two)], np.minimum(before, now))
                        chance = (now + 1) / (model.mass + model.types + 1)
                        mine = np.bincount(row, np.log10((pair + weight * chance) / (before + weight)), n)
                    columns = [batch.column(0).slice(a, n), batch.column(2).slice(a, n), *map(pa.array, (tokens if main else tokens * 0, known, base, mine))]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row", "n_tokens", "n_known", "base_score", "score"])

        kind = docs.schema["doc_id"].dataType.simpleString()
        part = docs.select("doc_id", "text", "row").mapInArrow(rate, f"doc_id {kind}, row long, n_tokens long, n_known long, base_score double, score double")
        out = part if out is None else out.unionByName(part)
    if len(blocks) > 1:
        out = out.groupBy("row").agg(F.first("doc_id").alias("doc_id"), *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return out.drop("row")


def held_out(doc_id: str) -> Column:
    """One in seven documents is kept from training; a null id is not."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def chunks(docs: DataFrame) -> DataFrame:
    """chunk, and lists of the columns of docs (doc_id, text, trained), one row per chunk."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, held = TaskContext.get().partitionId() << 32, 0, []

        def whole() -> pa.RecordBatch:
            lists = [pa.concat_arrays(c) for c in zip(*[p.columns for p in held], strict=True)]
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *[pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c) for c in lists]], ["chunk", "doc_id", "text", "trained"])

        for batch in batches:
            for a, b, data, _ in text_blocks(batch.column(1), CHUNK):
                held.append(batch.slice(a, b - a))
                size += len(data)
                if size >= CHUNK:
                    yield whole()
                    number, size = number + 1, 0
        if held:
            yield whole()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "trained").mapInArrow(trimmed(gather), f"chunk long, doc_id array<{kind}>, text array<string>, trained array<boolean>")


def chunk_tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """tokens_of all texts of a chunk."""
    parts = [(one, two, row + a) for a, _, data, offsets in text_blocks(texts, 1 << 20) for one, two, row in [tokens_of(data, offsets)]]
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


def count_chunks(table: DataFrame, n_buckets: int) -> DataFrame:
    """bucket, chunk, n (1 or 2), keys (sorted hashes of all the chunk's n-grams in the bucket) and counts (in texts to train on; 32-bit)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.arange(1, n_buckets, dtype=U64) << U64(64 - n_buckets.bit_length() + 1)
        for batch in batches:
            for i in range(batch.num_rows):
                one, two, row = chunk_tokens(batch.column(1)[i].values)
                mine = batch.column(2)[i].values.to_numpy(zero_copy_only=False).astype(bool)[row]
                bucket, order, keys, counts = [], [], [], []
                for n, tokens in enumerate((one, two), 1):
                    distinct = np.unique(tokens)
                    known, times = np.unique(tokens[mine], return_counts=True)
                    all_times = np.zeros(len(distinct), "<u4")
                    all_times[np.searchsorted(distinct, known)] = times
                    cut = np.searchsorted(distinct, edges)
                    for b, (k, c) in enumerate(zip(np.split(distinct, cut), np.split(all_times, cut), strict=True)):
                        if len(k):
                            bucket.append(b)
                            order.append(n)
                            keys.append(k.tobytes())
                            counts.append(c.tobytes())
                chunk = pa.array([batch.column(0)[i].as_py()] * len(bucket), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), chunk, pa.array(order, pa.int32()), pa.array(keys, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "chunk", "n", "keys", "counts"])

    return table.select("chunk", "text", "trained").mapInArrow(trimmed(count), "bucket int, chunk long, n int, keys binary, counts binary")


def answer_chunks(counted: DataFrame, bits_per_key: int) -> DataFrame:
    """Per row of counted: chunk, bucket, n, the keys' levels in the filter (a byte each), exact counts of words, and the bucket's tokens, types and mass."""

    def answer(pdf: pd.DataFrame) -> pd.DataFrame:
        out, found = [], {}
        for n in (1, 2):
            found[n] = summed(pdf["keys"][pdf["n"] == n].tolist(), pdf["counts"][pdf["n"] == n].tolist())
        every, totals = (np.concatenate([found[1][k], found[2][k]]) for k in (0, 1))
        words = segment(every[totals > 0], totals[totals > 0], bits_per_key)
        model = Filter(1, words, np.array([0]), np.array([len(words)]), 0, 0)
        for n, (keys, totals, which) in found.items():
            rows = pdf.loc[pdf["n"] == n, ["chunk", "bucket", "n"]]
            sizes = pdf["keys"][pdf["n"] == n].str.len().to_numpy(np.int64) // 8
            ends = np.cumsum(sizes)
            levels = model.levels(keys).astype(np.uint8)[which]
            exact = totals[which]
            out.append(rows.assign(levels=[levels[e - s : e].tobytes() for s, e in zip(sizes, ends, strict=True)], counts=[packed(exact[e - s : e]) if n == 1 else b"" for s, e in zip(sizes, ends, strict=True)]))
        totals = found[1][1]
        return pd.concat(out).assign(tokens=totals.sum(), types=(totals > 0).sum(), mass=ESTIMATE[level_of(totals[totals > 0])].sum())

    return counted.groupBy("bucket").applyInPandas(answer, "chunk long, bucket int, n int, levels binary, counts binary, tokens long, types long, mass double")


def score_chunks(table: DataFrame, answers: DataFrame, tokens: int, types: int, mass: float, weight: float) -> DataFrame:
    """Per text of the chunks what `score` gives."""
    total = np.log10(tokens + types + 1)

    def rate(texts: pa.Table, found: pa.Table) -> pa.Table:
        ids, column = (texts.column(c).combine_chunks()[0].values for c in ("doc_id", "text"))
        one, two, row = chunk_tokens(column)
        n = len(column)
        rows = found.sort_by("bucket").select(["n", "levels", "counts"]).to_pylist()  # buckets are in the order of the hashes
        single, pair = (ESTIMATE[np.frombuffer(b"".join(r["levels"] for r in rows if r["n"] == k), np.uint8)] for k in (1, 2))
        exact = np.concatenate([np.frombuffer(r["counts"], "<u4" if len(r["counts"]) == 4 * len(r["levels"]) else "<i8").astype(np.int64) for r in rows if r["n"] == 1])
        distinct, pairs = np.unique(one), np.unique(two)
        back = np.searchsorted(distinct, one)
        c, now = exact[back], single[back]
        before = np.concatenate([[single[np.searchsorted(distinct, END)]], now[:-1]])
        both = np.minimum(pair[np.searchsorted(pairs, two)], np.minimum(before, now))
        chance = (now + 1) / (mass + types + 1)
        mine = np.bincount(row, np.log10((both + weight * chance) / (before + weight)), n)
        length = np.bincount(row, minlength=n)
        known = np.bincount(row[c > 0], minlength=n)
        base = np.bincount(row, np.log10(c + 1.0), n) - total * length
        give_back()  # a chunk takes some 50 times its text for a moment
        return pa.table([ids, *map(pa.array, (length, known, base, mine))], ["doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = table.schema["doc_id"].dataType.elementType.simpleString()
    asked = table.select("chunk", "doc_id", "text").groupBy("chunk").cogroup(answers.select("chunk", "bucket", "n", "levels", "counts").groupBy("chunk"))
    return asked.applyInArrow(rate, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def score_corpus(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", bits_per_key: int = 10, weight: float = 10.0) -> DataFrame:
    """Trains on the documents that are not held out and scores all of them (see `score`), one row each.

    doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score. A null
    or empty text is its end alone; a row without an id is trained on; repeated
    rows each count and are each scored; a very long text is a chunk of its own;
    an empty table gives no row; other columns don't matter.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    table = materialise(chunks(own.withColumn("trained", ~held_out("doc_id"))), "chunks", LARGE_ROWS)
    answers = materialise(answer_chunks(count_chunks(table, buckets(own)), bits_per_key), "levels")
    each = answers.groupBy("bucket").agg(*[F.first(c).alias(c) for c in ("tokens", "types", "mass")])
    tokens, types, mass = (x or 0 for x in each.agg(F.sum("tokens"), F.sum("types"), F.sum("mass")).first())
    rows = score_chunks(table, answers, tokens, types, mass, weight)
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
