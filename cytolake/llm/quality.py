"""Quality rules: a linear-chain conditional random field marks each line as content or boilerplate.

A line's observations are a few yes/no facts, so it is one small integer (its
signs); a chain's score is the sum of the signs' weights and of the steps
between labels. Viterbi decoding gives the labels, and the share of words in
content lines decides whether a document stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, find_words, hash_words, mix, row_counts, shingle, text_blocks

SIGNS = 12
WINDOW = 5
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
BLANK = " \t\r\v\f"
STOPS = (".", "!", "?", "…", ":", '"', "»", "”")


def signs(line: str, words: list[str], seen: bool) -> int:
    """The facts of a line with words: length (3), end of a sentence, bars, other symbols, capitals, digits, repeated words, seen before, marks of shouting, very long words."""
    n, size = len(words), len(line)
    out = (n <= 2) | (3 <= n <= 7) << 1 | (n >= 20) << 2
    out |= (words[-1][-1] in STOPS) << 3
    out |= (5 * line.count("|") >= n) << 4
    out |= (5 * sum(map(line.count, "#*$%&<>@{}")) >= n) << 5
    out |= line.isupper() << 6
    out |= (4 * sum(map(line.count, "0123456789")) > size) << 7
    out |= (n >= 4 and 2 * len(set(words)) <= n) << 8
    out |= seen << 9
    out |= (4 * line.count("!!") >= n) << 10
    out |= (size > 14 * n) << 11
    return out


def chain(text: str | None) -> tuple[list[int], list[int], int]:
    """Signs and words of each line that has words, and how many of them equal an earlier line."""
    marks, sizes, seen, again = [], [], set(), 0
    for line in (text or "").split("\n"):
        if words := line.strip(BLANK).split():
            known = line in seen
            again += known
            seen.add(line)
            marks.append(signs(line, words, known))
            sizes.append(len(words))
        elif line.strip(BLANK):  # a word of Unicode spaces alone
            again += line in seen
            seen.add(line)
    return marks, sizes, again


@dataclass(frozen=True)
class LineField:
    """weights: of each sign (and a constant, last) for content; steps: between labels (0 boilerplate, 1 content)."""

    weights: np.ndarray
    steps: np.ndarray

    def emissions(self) -> np.ndarray:
        """For every combination of signs, how much it speaks for content."""
        bits = (np.arange(1 << SIGNS)[:, None] >> np.arange(SIGNS)) & 1
        return bits @ self.weights[:-1] + self.weights[-1]

    def decode(self, marks: list[int], emissions: list[float]) -> list[int]:
        """The best chain of labels; ties go to content."""
        (bb, bc), (cb, cc) = self.steps.tolist()
        b, c, back = 0.0, emissions[marks[0]], []
        for m in marks[1:]:
            from_b, from_c = c + cb < b + bb, c + cc < b + bc  # true: the label before is boilerplate
            b, c = (b + bb if from_b else c + cb), (b + bc if from_c else c + cc) + emissions[m]
            back.append((from_b, from_c))
        label, out = int(c >= b), []
        for step in reversed(back):
            out.append(label)
            label = int(not step[label])
        out.append(label)
        return out[::-1]


def fit_field(chains: list[np.ndarray], labels: list[int], steps: int = 120, penalty: float = 1e-3) -> LineField:
    """Maximum conditional likelihood of the chains by forward and backward sums.

    All lines of a chain have the label of its document, which is what the
    label table tells; lines that look alike in good and bad documents end up
    with the majority. Without two labels, everything is content.
    """
    if len(set(labels)) < 2:
        return LineField(np.append(np.zeros(SIGNS), 1.0), np.zeros((2, 2)))
    order = sorted(range(len(chains)), key=lambda i: -len(chains[i]))
    chains, y = [chains[i] for i in order], np.array([labels[i] for i in order])
    n, longest = len(chains), len(chains[0])
    lengths = np.array([len(c) for c in chains])
    alive = [int((lengths > t).sum()) for t in range(longest)]
    marks = np.zeros((longest, n), np.int64)
    for i, c in enumerate(chains):
        marks[: len(c), i] = c
    there = np.arange(longest)[:, None] < lengths
    bits = np.concatenate([(np.arange(1 << SIGNS)[:, None] >> np.arange(SIGNS)) & 1, np.ones((1 << SIGNS, 1), int)], 1)
    share = np.where(y == 1, 0.5 / max(1, (lengths * (y == 1)).sum()), 0.5 / max(1, (lengths * (y == 0)).sum()))  # both labels weigh the same
    params = np.zeros(SIGNS + 1 + 4)
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, trans = params[: SIGNS + 1], params[SIGNS + 1 :].reshape(2, 2)
        score = np.stack([np.zeros((longest, n)), (bits @ w)[marks]], 2)
        forward, backward = score.copy(), np.zeros((longest, n, 2))
        for t in range(1, longest):
            k = alive[t]
            forward[t, :k] += np.logaddexp.reduce(forward[t - 1, :k, :, None] + trans, 1)
        for t in range(longest - 2, -1, -1):
            k = alive[t + 1]
            backward[t, :k] = np.logaddexp.reduce(trans + (score[t + 1, :k] + backward[t + 1, :k])[:, None, :], 2)
        total = np.logaddexp.reduce(forward[lengths - 1, np.arange(n)], 1)
        content = np.exp(forward[:, :, 1] + backward[:, :, 1] - total) * there
        error = (content - y * there) * share
        grad_w = bits.T @ np.bincount(marks.ravel(), error.ravel(), 1 << SIGNS) + penalty * w
        pair = np.exp(np.minimum(0, forward[:-1, :, :, None] + trans + (score + backward)[1:, :, None, :] - total[None, :, None, None])) * (there[1:] * share)[:, :, None, None]
        grad_t = pair.sum((0, 1))
        np.subtract.at(grad_t, (y, y), np.maximum(lengths - 1, 0) * share)
        grad = np.concatenate([grad_w, (grad_t + penalty * trans).ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return LineField(params[: SIGNS + 1], params[SIGNS + 1 :].reshape(2, 2))


def train_field(docs: DataFrame, labels: DataFrame, limit: int = 3000, most_lines: int = 300) -> LineField:
    """Fits on at most `limit` labelled rows (doc_id, text; labels: doc_id, quality), those with the smallest hash of their id.

    Only a number per line of this bounded sample goes to the driver; documents
    of more than `most_lines` lines aren't used for training. Without labels or
    documents everything is content.
    """
    chosen = labels.filter("quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").cast("int").alias("label_quality"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [chain(t)[0] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m if len(m) <= most_lines else [] for m in marks], pa.list_(pa.int32()))], ["quality", "marks"])

    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(limit)
    rows = texts.select("label_quality", "text").mapInArrow(lines, "quality int, marks array<int>").collect()
    rows = sorted((r["marks"], r["quality"]) for r in rows if r["marks"])
    return fit_field([np.array(m) for m, _ in rows], [int(q > 0) for _, q in rows])


def base_counts(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Per text: words, code points in words, symbols, words in repeated windows."""
    n = len(offsets) - 1
    starts, ends, rows = find_words(data, offsets)
    letters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    points = np.bincount(rows, letters[ends] - letters[starts], n).astype(np.int64)
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[data])])[offsets]
    windows = shingle(hash_words(data, starts, ends, lower=False), WINDOW)
    inside = np.flatnonzero(rows[: len(windows)] == rows[WINDOW - 1 :]) if len(windows) else np.zeros(0, np.int64)
    keys = mix(windows[inside] + rows[inside].astype(U64) * U64(0x9E3779B97F4A7C15))
    _, back, times = np.unique(keys, return_inverse=True, return_counts=True)
    covered = np.zeros(len(rows) + 1, np.int64)
    again = inside[times[back] > 1]
    np.add.at(covered, again, 1)
    np.subtract.at(covered, again + WINDOW, 1)
    repeated = np.bincount(rows, np.cumsum(covered[:-1]) > 0, n).astype(np.int64)
    return [row_counts(rows, n), points, np.diff(symbols), repeated]


def judge_quality(docs: DataFrame, field: LineField, least_content: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, content_share, base_failed and kept.

    content_share is the share of words in lines that the field marks as
    content; a document is kept if the base rules pass and the share is
    `least_content` or more. Null and empty texts have no words and fail.
    Repeated rows and rows without an id are each judged, whole texts of any
    length are read, an empty table gives no row, and other columns don't matter.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        emissions = field.emissions().tolist()
        for batch in batches:
            for a, b, data, offsets in text_blocks(batch.column(1)):
                words, points, symbols, repeated = base_counts(data, offsets)
                again, share = [], []
                for text in batch.column(1).slice(a, b - a).to_pylist():
                    marks, sizes, dup = chain(text)
                    content = sum(s for s, y in zip(sizes, field.decode(marks, emissions), strict=True) if y) if marks else 0
                    again.append(dup)
                    share.append(content / max(1, sum(sizes)))
                failed = (words < 10) | (100 * repeated > 20 * words)
                share = np.array(share, float)
                columns = [words, points, symbols, np.array(again, np.int64), repeated, share, failed, ~failed & (share >= least_content)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *map(pa.array, columns)], NAMES)

    own = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(judge, f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, content_share double, base_failed boolean, kept boolean")


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "content_share", "base_failed", "kept"]
