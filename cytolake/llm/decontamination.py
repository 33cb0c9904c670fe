"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A region within e edits of an item of m letters shares at least m - q + 1 - q*e
of the item's q-grams, and their diagonals (place in text less place in item)
differ by e at most. Diagonals fall into bands of 2w that start every w >= e,
so one band holds them all: bands with too few shared q-grams are dropped, the
others are verified by a banded alignment. q is 10, and less for items that
would be too short for it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import U64, materialise, mix, trimmed

Q, BUDGET = 10, 0.06
#: Letters of a text that are looked at together.
SPAN = 1 << 20
NOT_LETTERS = re.compile(r"[\W_]+")


def plain(text: str | None) -> str:
    """Lower case; each run of anything but letters and digits is one space."""
    return NOT_LETTERS.sub(" ", (text or "").lower()).strip()


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(U64)


def grams(letters: np.ndarray, q: int) -> np.ndarray:
    """Hash of each run of q letters, by doubling."""
    base, width, have, out = letters * U64(0x9E3779B97F4A7C15) ^ letters, 1, None, None
    done = 0
    factor = pow(0xD6E8FEB86659FD93, 1, 1 << 64)
    while True:
        if q & width:
            if out is None:
                out, done = base, width
            else:
                n = min(len(out), len(base) - done) if len(base) > done else 0
                out, done = out[:n] * U64(pow(factor, width, 1 << 64)) + base[done : done + n], done + width
        width *= 2
        if width > q:
            break
        half = width // 2
        base = base[: max(0, len(base) - half)] * U64(pow(factor, half, 1 << 64)) + base[half:]
    return mix(out)


def edits(length: int) -> int:
    return int(BUDGET * length)


def gram_length(length: int) -> int:
    """Q, or for items too short for the lemma at Q the largest q at which an item within its budget still shares a gram."""
    return min(Q, length // (1 + edits(length))) if need(length, Q) <= 0 else Q


def need(length: int, q: int) -> int:
    """Grams of q letters that a region within the budget shares at least."""
    return length - q + 1 - q * edits(length)


class Grams:
    """The q-grams of items of one gram length: a bit table that most of a text's grams fail, then sorted lists."""

    def __init__(self, items: list[tuple[int, np.ndarray]], q: int):
        self.q = q
        hashes = [grams(x, q) for _, x in items]
        all_grams = np.concatenate([*hashes, np.zeros(0, U64)])
        order = np.argsort(all_grams, kind="stable")
        self.gram = all_grams[order]
        self.item = np.repeat(np.array([k for k, _ in items], np.int64), [len(h) for h in hashes])[order]
        self.place = np.concatenate([*(np.arange(len(h)) for h in hashes), np.zeros(0, np.int64)])[order]
        self.bits = max(16, int(len(self.gram) * 32).bit_length())
        self.table = np.zeros(1 << self.bits, bool)
        self.table[(self.gram >> U64(64 - self.bits)).astype(np.int64)] = True

    def hits(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place in the text, item, diagonal) of each shared gram."""
        have = grams(letters, self.q) if len(letters) >= self.q else np.zeros(0, U64)
        at = np.flatnonzero(self.table[(have >> U64(64 - self.bits)).astype(np.int64)])
        lo, hi = np.searchsorted(self.gram, have[at], "left"), np.searchsorted(self.gram, have[at], "right")
        n = hi - lo
        entry = np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())
        text_at = np.repeat(at, n)
        return text_at, self.item[entry], text_at - self.place[entry]


class Items:
    """Benchmark items that have letters, and their q-grams."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.rows = [(k, t) for k, t in ((k, plain(t)) for k, t in rows) if t]
        self.items = [codes(t) for _, t in self.rows]
        self.texts = [t for _, t in self.rows]
        lengths = np.array([len(x) for x in self.items], np.int64)
        own = [gram_length(n) for n in lengths]
        self.grams = [Grams([(k, x) for k, x in enumerate(self.items) if own[k] == q], q) for q in sorted(set(own))]
        self.least = np.array([need(n, q) for n, q in zip(lengths, own, strict=True)], np.int64)
        self.step = np.array([max(8, edits(n)) for n in lengths], np.int64)

    def bands(self, letters: np.ndarray) -> list[tuple[int, int, int]]:
        """(item, least diagonal, largest diagonal) of bands with enough shared grams."""
        hits = [g.hits(letters) for g in self.grams]
        text_at, item, diagonal = (np.concatenate([h[k] for h in hits]) for k in range(3)) if hits else (np.zeros(0, np.int64),) * 3
        if not len(text_at):
            return []
        found = []
        for shift in (0, 1):
            band = diagonal // self.step[item] - shift
            order = np.lexsort((text_at, band, item))
            i, b, p = item[order], band[order], text_at[order]
            new = np.concatenate([[True], (i[1:] != i[:-1]) | (b[1:] != b[:-1])])
            distinct = new | np.concatenate([[True], p[1:] != p[:-1]])
            counts = np.bincount(np.cumsum(new) - 1, distinct)
            found.append(np.stack([i[new], b[new], counts.astype(np.int64)]))
        # band b holds diagonals of b and b + 1; both halves were counted under the same number
        both = np.concatenate(found, 1)
        order = np.lexsort((both[1], both[0]))
        i, b, c = both[:, order]
        new = np.concatenate([[True], (i[1:] != i[:-1]) | (b[1:] != b[:-1])])
        total = np.bincount(np.cumsum(new) - 1, c).astype(np.int64)
        i, b = i[new], b[new]
        return [(k, int(d) * int(self.step[k]), (int(d) + 2) * int(self.step[k]) - 1) for k, d in zip(i[total >= self.least[i]].tolist(), b[total >= self.least[i]].tolist(), strict=True)]


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the whole item in the text with diagonals low..high, if within the budget.

    A banded alignment: cell d of a row stands for diagonal low + d; beginning
    and end in the text are free.
    """
    width, n = high - low + 1, len(text)
    far = 1 << 30
    diagonals = np.arange(low, high + 1)
    cost = np.where((diagonals >= 0) & (diagonals <= n), 0, far)
    start = diagonals.copy()
    steps = np.arange(width)
    for i, letter in enumerate(item):
        at = diagonals + i
        inside = (at >= 0) & (at < n)
        same = np.zeros(width, bool)
        same[inside] = text[at[inside]] == letter
        best = np.where(inside, cost + ~same, far)
        begin = start.copy()
        down = np.concatenate([cost[1:] + 1, [far]])  # the item's letter is missing in the text
        better = down < best
        best, begin = np.where(better, down, best), np.where(better, np.concatenate([start[1:], [0]]), begin)
        run = np.minimum.accumulate(best - steps)  # letters of the text that the item lacks
        source = np.maximum.accumulate(np.where(best - steps == run, steps, 0))
        cost, start = np.minimum(run + steps, far), begin[source]
        if cost.min() > budget:
            return None
    end = int(cost.argmin())
    return int(cost[end]), int(start[end]), min(n, int(diagonals[end]) + len(item))


def find_items(items: Items, text: str) -> list[tuple[int, int, int, int]]:
    """(item number, edits, start, end) for each place of an item in a plain text, the best of those that overlap."""
    hits: list[tuple[int, int, int, int]] = []
    longest = max((len(x) for x in items.items), default=0)
    overlap = longest + 2 * (edits(longest) + 16)
    for at in range(0, max(1, len(text)), SPAN):
        letters = codes(text[at : at + SPAN + overlap])
        for k, low, high in items.bands(letters):
            item = items.items[k]
            exact = text.find(items.texts[k], max(0, at + low), max(0, at + high + len(item)))
            if exact >= 0:
                hits.append((k, 0, exact, exact + len(item)))
                continue
            begin = max(0, low)
            found = align(item, letters[begin : high + len(item) + edits(len(item))], low - begin, high - begin, edits(len(item)))
            if found:
                hits.append((k, found[0], at + begin + found[1], at + begin + found[2]))
    kept: list[tuple[int, int, int, int]] = []
    for hit in sorted(set(hits), key=lambda h: (h[0], h[2], h[1])):
        if kept and kept[-1][0] == hit[0] and hit[2] < kept[-1][3]:
            if hit[1] < kept[-1][1]:
                kept[-1] = hit
        else:
            kept.append(hit)
    return kept


def item_blocks(benchmark: DataFrame, max_letters: int) -> Iterator[list[tuple]]:
    """Items (id, text) in blocks of at most `max_letters` letters, one at a time; a longer item is a block of its own, and no items are one empty block."""
    block, size, given = [], 0, False
    for row in benchmark.select("item_id", "text").filter("text IS NOT NULL").orderBy("item_id", "text").toLocalIterator():
        if block and size + len(row["text"]) > max_letters:
            yield block
            block, size, given = [], 0, True
        block.append((row["item_id"], row["text"]))
        size += len(row["text"])
    if block or not given:
        yield block


def find_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", max_letters: int = 4 << 20) -> DataFrame:
    """doc_id, item_id, edits, start_char, end_char for each place of a benchmark item in a document.

    Offsets count letters of the plain text (see `plain`). Items of less than 17
    letters have no budget: they are found as they are, wherever the letters
    stand. Items go to the tasks in blocks of at most `max_letters` letters, and
    every block sees all documents, so driver and tasks hold one block at a time.
    Null items and items without letters are never found; null, empty and
    letterless texts give no row, nor does an empty table. Repeated items and
    repeated rows are all reported. Texts are read whole, in overlapping parts of
    SPAN letters.
    """
    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    context = own.sparkSession.sparkContext
    kinds = [own.schema["doc_id"].dataType, benchmark.schema["item_id"].dataType]
    schema = f"doc_id {kinds[0].simpleString()}, item_id {kinds[1].simpleString()}, edits int, start_char long, end_char long"
    item_type = to_arrow_type(kinds[1])

    def scan(block: list[tuple]) -> tuple[DataFrame, Broadcast]:
        shared = context.broadcast(Items(block))

        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = shared.value
            for batch in batches:
                rows, found = [], []
                for row, text in enumerate(batch.column(1).to_pylist()):
                    for hit in find_items(items, plain(text)):
                        rows.append(row)
                        found.append((items.rows[hit[0]][0], *hit[1:]))
                columns = list(zip(*found, strict=True)) or [[]] * 4
                types = [item_type, pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], ["doc_id", "item_id", "edits", "start_char", "end_char"])

        return own.mapInArrow(trimmed(search), schema), shared

    parts, last = [], None
    for block in item_blocks(benchmark, max_letters):
        if last is not None:
            parts.append(materialise(last[0], "leaks"))
            last[1].destroy()
        last = scan(block)
    return reduce(DataFrame.unionByName, parts, last[0])


def without_leaks(docs: DataFrame, benchmark: DataFrame, max_letters: int = 4 << 20) -> DataFrame:
    """The rows of docs, with all their columns, in which find_leaks finds no item, decided where the row is."""
    context, text_at = docs.sparkSession.sparkContext, docs.columns.index("text")

    def scan(rows: DataFrame, block: list[tuple]) -> tuple[DataFrame, Broadcast]:
        shared = context.broadcast(Items(block))

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not find_items(shared.value, plain(t)) for t in batch.column(text_at).to_pylist()], pa.bool_()))

        return rows.mapInArrow(trimmed(keep), rows.schema), shared

    last = None
    for block in item_blocks(benchmark, max_letters):
        if last is not None:
            docs = materialise(last[0], "clean")
            last[1].destroy()
        last = scan(docs, block)
    return last[0]
