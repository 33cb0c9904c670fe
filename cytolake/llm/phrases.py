"""Phrase collocations by Suffix-sigma.

Every word of a text stands for the suffix of its piece that starts there, cut
after `longest` words. Suffixes are added up where they are read, shuffled by
language and first word, and sorted in reverse order, so that a phrase follows
all suffixes that begin with it and one stack of open phrases counts them all.
A first word (or first few) that holds too much of a sample of the texts is
dealt out by its next word as well, and at full length by a salt; the parts of
such a phrase's count are added up afterwards. Which phrases are dealt out so
changes where they are counted, never the counts.

Rules: A-Z are lower-cased, pieces end at any of `.,;:!?` and at line ends,
words at spaces and tabs. A null text is empty, a null language is `und`.
Repeated rows count each; ids, other columns and their names don't matter; no
rows or no phrase of `least` occurrences give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import U64, find_words, give_back, hash_words, materialise, mix, text_blocks

LONGEST = 5
#: A phrase with more than this share of the sampled suffixes is dealt out by its next word.
HOT_SHARE = 1 / 2000
#: About so many documents are looked at for such phrases.
SAMPLE = 1000
#: Parts of a full-length suffix that is hot itself.
SALTS = 16
#: Bytes of suffixes that are added up at a time, and text bytes from which they are made at a time.
HELD, STEP = 4 << 20, 1 << 18
#: Rows that are counted at a time.
ROWS = 1 << 15

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E))] = True
_GAPS = _ENDS.copy()
_GAPS[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def slices(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """data[begin:end] of each row as binary values."""
    sizes = ends - begins
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    where = np.arange(offsets[-1]) + np.repeat(begins - offsets[:-1], sizes)
    return pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[where])])


class Suffixes:
    """Suffixes of a run of texts: words joined by single spaces, each with a space behind it."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, longest: int):
        low = _LOWER[data]
        begins, ends, rows = find_words(low, offsets, _GAPS)
        n = len(begins)
        breaks = np.concatenate([[0], np.cumsum(_ENDS[data])])[begins]
        fresh = np.ones(n, bool)
        fresh[1:] = (rows[1:] != rows[:-1]) | (breaks[1:] != breaks[:-1])
        piece_ends = np.append(np.flatnonzero(fresh), n)[np.cumsum(fresh)] if n else np.zeros(0, np.int64)
        self.left = np.minimum(piece_ends - np.arange(n), longest)
        # the words one behind the other, so that each suffix is a slice
        sizes = ends - begins + 1
        self.at = np.concatenate([[0], np.cumsum(sizes)])
        where = np.arange(self.at[-1]) + np.repeat(begins - self.at[:-1], sizes)
        self.joined = np.append(low, np.uint8(0x20))[where]
        self.joined[self.at[1:] - 1] = 0x20
        # hashes of the first 1, 2, ... words
        words = hash_words(low, begins, ends, lower=False)
        total, hashes = np.zeros(n, U64), []
        for k in range(longest):
            total = total * U64(0xD6E8FEB86659FD93)
            total[: max(0, n - k)] += words[k:]
            hashes.append(mix(total + U64(k)))
        self.hashes = hashes

    def keys(self, lang: np.uint64, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The key of each suffix, and how many words it stands for: the first, and the next as long as the phrase so far is hot; longest + 1 where the whole suffix is."""
        n, longest = len(self.left), len(self.hashes)
        depth, key = np.ones(n, np.int32), mix(self.hashes[0] ^ lang)
        deeper = np.isin(key, hot)
        for k in range(1, longest + 1):
            depth[deeper] = k + 1
            ended = deeper & (self.left <= k)
            depth[ended] = longest + 1
            deeper &= ~ended
            if k == longest or not deeper.any():
                break
            key = np.where(deeper, mix(self.hashes[k] ^ lang), key)
            deeper &= np.isin(key, hot)
        return key, depth

    def bytes(self, a: int, b: int) -> pa.Array:
        return slices(self.joined, self.at[a:b], self.at[np.arange(a, b) + self.left[a:b]])


def lang_hash(lang: str) -> np.uint64:
    raw = lang.encode()
    return hash_words(np.frombuffer(raw, np.uint8), np.array([0]), np.array([len(raw)]), lower=False)[0] if raw else U64(1)


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, pa.Array]]:
    for batch in batches:
        for a, b, _, _ in text_blocks(batch.column(1), 4 * STEP):
            codes, texts = batch.column(0).slice(a, b - a).dictionary_encode(), batch.column(1).slice(a, b - a)
            which = codes.indices.to_numpy(zero_copy_only=False)
            for i, lang in enumerate(codes.dictionary.to_pylist()):
                yield lang, texts.filter(pa.array(which == i))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))


def hot_prefixes(docs: DataFrame, longest: int) -> np.ndarray:
    """Hashes of the phrases that begin more than HOT_SHARE of a sample's suffixes: longest / HOT_SHARE of them at most."""
    texts = _texts(docs)
    sample = texts.sample(min(1.0, SAMPLE / max(1, texts.count())), seed=SAMPLE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, texts in _by_lang(batches):
            own = lang_hash(lang)
            for _, _, data, offsets in text_blocks(texts, STEP):
                s = Suffixes(data, offsets, longest)
                found = [np.unique(mix(s.hashes[k][s.left > k] ^ own), return_counts=True) for k in range(longest)]
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*found, strict=True)], ["hash", "n"])

    counts = sample.mapInArrow(run, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    path = materialise(counts, "sampled-phrases")
    # each suffix counts once at each of its lengths
    total = path.agg(F.sum("n")).first()[0] or 0
    hot = path.filter(F.col("n") > F.lit(total / longest * HOT_SHARE)).select("hash").toPandas()["hash"]
    return np.sort(hot.to_numpy(np.int64).view(U64))


def packed(values: pa.Array, counts: np.ndarray, depths: np.ndarray) -> bytes:
    """Suffixes with their counts and depths, sorted nearly and compressed."""
    _, offsets, data = values.buffers()
    sizes = np.diff(np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1])
    small = [x.astype(np.min_scalar_type(int(x.max()))) for x in (counts, sizes, depths)]
    body = b"".join([bytes([x.itemsize]) + x.tobytes() for x in small] + [data])
    return len(values).to_bytes(4, "little") + zstandard.ZstdCompressor(level=1).compress(body)


def unpacked(blob: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    n, body, at, out = int.from_bytes(blob[:4], "little"), zstandard.ZstdDecompressor().decompress(blob[4:]), 0, []
    for _ in range(3):
        out.append(np.frombuffer(body, f"<u{body[at]}", n, at + 1).astype(np.int64))
        at += 1 + n * body[at]
    counts, sizes, depths = out
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(body[at:])]), counts, depths


def suffixes(docs: DataFrame, hot: np.ndarray, longest: int, parts: int) -> DataFrame:
    """(suffix, n, depth), dealt out by language and first words: suffixes added up by runs of texts, with the language as their first word.

    They travel compressed, one value for each run of texts and part. What begins
    with less than `depth` words of a suffix may lie in several parts.
    """

    def blobs(lang: str, held: list, salt: int) -> pa.RecordBatch:
        values = pa.chunked_array([h[0] for h in held]).combine_chunks().dictionary_encode()
        where, values = values.indices.to_numpy(), values.dictionary
        first = np.zeros(len(values), np.int64)
        first[where[::-1]] = np.arange(len(where))[::-1]
        keys, depths = (np.concatenate([h[i] for h in held])[first] for i in (1, 2))
        keys = keys + U64(salt % SALTS) * (depths > longest).astype(U64)
        counts, part = np.bincount(where, minlength=len(first)), (keys % U64(parts)).astype(np.int64)
        _, offsets, data = values.buffers()
        data, at = np.append(np.frombuffer(data, np.uint8), np.zeros(8, np.uint8)), np.frombuffer(offsets, np.int64)[: len(values)]
        order = np.lexsort((np.ascontiguousarray(data[at[:, None] + np.arange(8)]).view(">u8")[:, 0], part))
        values, counts, depths, part = values.take(pa.array(order)), counts[order], depths[order], part[order]
        begins = np.flatnonzero(np.diff(part, prepend=-1))
        ends = [*begins[1:].tolist(), len(part)]
        made = [packed(pa.concat_arrays([values.slice(a, b - a)]), counts[a:b], depths[a:b]) for a, b in zip(begins.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(part[begins].astype(np.int32)), pa.array([lang] * len(begins), pa.string()), pa.array(made, pa.binary())], ["part", "lang", "blob"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        salt, size = 0, 0
        for lang, texts in _by_lang(batches):
            for _, _, data, offsets in text_blocks(texts, STEP):
                s = Suffixes(data, offsets, longest)
                keys, depths = s.keys(lang_hash(lang), hot)
                for a in range(0, len(keys), STEP >> 3):
                    b = min(len(keys), a + (STEP >> 3))
                    part = s.bytes(a, b)
                    held.setdefault(lang, []).append((part, keys[a:b], depths[a:b]))
                    size += part.nbytes
                    if size > HELD:
                        for name in list(held):
                            yield blobs(name, held.pop(name), salt)
                        size, salt = 0, salt + 1
        for name in list(held):
            yield blobs(name, held.pop(name), salt)
        give_back()

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, blob in zip(batch.column(0), batch.column(1), strict=True):
                values, counts, depths = unpacked(blob.as_py())
                values = pc.binary_join_element_wise(pa.scalar(as_word(lang.as_py()) + b" "), values, pa.scalar(b""))
                yield pa.RecordBatch.from_arrays([values, pa.array(counts), pa.array(depths.astype(np.int32) + 1)], ["suffix", "n", "depth"])
        give_back()

    dealt = _texts(docs).mapInArrow(pack, "part int, lang string, blob binary").repartitionById(parts, "part")
    return dealt.select("lang", "blob").mapInArrow(unpack, "suffix binary, n long, depth int")


def as_word(lang: str) -> bytes:
    """A language as the first word of a suffix: without spaces, and told apart from every other."""
    return lang.encode().replace(b"%", b"%25").replace(b" ", b"%20")


def same_words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many words each value shares with the one before (0 for the first), and how many it has."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data else np.zeros(0, np.uint8)
    at, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    most = np.zeros(len(sizes), np.int64)
    most[1:] = np.minimum(sizes[1:], sizes[:-1])
    same, open_rows, step = np.zeros(len(sizes), np.int64), np.flatnonzero(most), 8
    padded = np.append(data, np.zeros(8, np.uint8))
    while len(open_rows):
        here, i = same[open_rows], np.arange(8)
        if step > 256:  # few and long
            for r in open_rows:
                a, b = data[at[r] : at[r] + most[r]], data[at[r - 1] : at[r - 1] + most[r]]
                other = np.flatnonzero(a != b)
                same[r] = other[0] if len(other) else most[r]
            break
        unlike = padded[(at[open_rows] + here)[:, None] + i] != padded[(at[open_rows - 1] + here)[:, None] + i]
        first = np.where(unlike.any(1), unlike.argmax(1), 8)
        same[open_rows] = np.minimum(here + first, most[open_rows])
        open_rows = open_rows[(first == 8) & (same[open_rows] < most[open_rows])]
        step += 8
    spaces = np.concatenate([[0], np.cumsum(data == 0x20)])
    return spaces[at + same] - spaces[at], spaces[at + sizes] - spaces[at]


def count_sorted(batches: Iterator[pa.RecordBatch], longest: int, least: int) -> Iterator[pa.RecordBatch]:
    """Counts of phrases of 0 to `longest` words of each language from suffixes in reverse order.

    The stack holds the open phrase of each length (its language is the first
    word) with its count so far: those that the last suffix begins with. A batch closes and opens many
    at once: the rows at which less than k words are shared with the row before
    part the phrases of k words. Phrases of less than `least` are left out, unless
    other tasks count them too.
    """
    stack: list[tuple[bytes, int, bool] | None] = [None] * (longest + 2)
    last = None

    def rows(closed: list[tuple[bytes, int, bool]], k: int) -> Iterator[pa.RecordBatch]:
        kept = [c for c in closed if c[1] >= least or c[2]]
        if kept:
            words = [c[0].split(b" ", k)[:k] for c in kept]
            langs = [w[0].replace(b"%20", b" ").replace(b"%25", b"%").decode() for w in words]
            out = [pa.array(langs, pa.string()), pa.array([k - 1] * len(kept), pa.int32()), pa.array([b" ".join(w[1:]).decode() for w in words], pa.string()), pa.array([c[1] for c in kept], pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["lang", "size", "phrase", "n"])

    for batch in joined(batches):
        suffix = batch.column(0)
        n, depth = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        same, size = same_words(suffix)
        if last is not None:
            mine, other = suffix[0].as_py().split(b" ")[:-1], last.split(b" ")[:-1]
            same[0] = next((i for i, (x, y) in enumerate(zip(mine, other, strict=False)) if x != y), min(len(mine), len(other)))
        for k in range(1, longest + 2):
            begins = np.flatnonzero(same < k)
            going_on = not len(begins) or begins[0] > 0
            cuts = np.append([0], begins) if going_on else begins
            sums = np.add.reduceat(n, cuts)
            closed = []
            if going_on and stack[k]:
                stack[k] = (stack[k][0], stack[k][1] + int(sums[0]), stack[k][2])
            if len(begins) and stack[k]:
                closed.append(stack[k])
                stack[k] = None
            ready = np.flatnonzero((size[cuts] >= k) & ((sums >= least) | (depth[cuts] > k)))
            ready = ready[(ready >= going_on) & (ready < len(cuts) - 1)]
            closed += [(suffix[int(cuts[i])].as_py(), int(sums[i]), bool(depth[cuts[i]] > k)) for i in ready]
            if len(begins):
                row = int(cuts[-1])
                stack[k] = (suffix[row].as_py(), int(sums[-1]), bool(depth[row] > k)) if size[row] >= k else None
            yield from rows(closed, k)
        last = suffix[-1].as_py()
    for k in range(1, longest + 2):
        yield from rows([stack[k]] if stack[k] else [], k)
    give_back()


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, about ROWS rows at a time; none is empty."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += len(batch)
        if n >= ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if n:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = 100) -> DataFrame:
    """(lang, size, phrase, n): phrases of 1 to `longest` words found `least` times or more, and with size 0 each language's words; written as a table."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = suffixes(docs, hot_prefixes(docs, longest), longest, parts).sortWithinPartitions(F.desc("suffix"))
    counted = ordered.mapInArrow(lambda b: count_sorted(b, longest, least), "lang string, size int, phrase string, n long")
    added = counted.groupBy("lang", "size", "phrase").agg(F.sum("n").alias("n"))
    return materialise(added.filter((F.col("n") >= least) | (F.col("size") == 0)), "phrases")


def score_phrases(counts: DataFrame, share: int = 100, least: int = 100) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of candidates: phrases of two words or more at their weakest cut.

    Those lying in a longer candidate with at least `share` % of their count are
    dropped. Parts of a candidate are at least as frequent as itself, so they
    are in counts too.
    """
    words = F.split("phrase", " ")
    candidates = counts.filter((F.col("size") >= 2) & (F.col("n") >= least)).withColumnRenamed("n", "a")
    inner = candidates.filter("size > 2").select("lang", "a", F.explode(_inner_phrases(words, F.col("size"))).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")

    totals = counts.filter("size = 0").select("lang", F.col("n").alias("n"))
    ones = counts.filter("size > 0")
    cuts = kept.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.array_join(F.slice(words, F.lit(1), F.col("k")), " "), "right": F.array_join(F.slice(words, F.col("k") + 1, F.size(words)), " ")})
    cuts = cuts.join(ones.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(ones.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    cuts = cuts.join(totals, "lang")
    score = F.expr("cast(1000 as decimal(4,0)) * cast(a as decimal(16,0)) * cast(n as decimal(17,0)) div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    weakest = cuts.groupBy("lang", "phrase").agg(F.min(F.struct(score.alias("score"), "k", "a", "l", "r", "n")).alias("cut"))
    return weakest.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def _inner_phrases(words, size):
    """All phrases of two words or more within a phrase, but for itself; distinct."""
    spans = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    return F.array_distinct(spans)


def strongest_phrases(docs: DataFrame, longest: int = LONGEST, least: int = 100, share: int = 100, top: int = 2000) -> DataFrame:
    """The first `top` phrases of each language by score, count and phrase."""
    scored = score_phrases(phrase_counts(docs, longest, least), share, least)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are ranked in parts first, so that a task gets at most SALTS * top of them
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).orderBy(*order)
    first = scored.withColumn("rank", F.row_number().over(part)).filter(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
