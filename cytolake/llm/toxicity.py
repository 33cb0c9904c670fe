"""Toxicity: cumulative-link ordinal regression over sparse text features.

P(grade > j) = sigmoid(w . x - t_j) for rising thresholds t: one weight vector
is shared by all of them, and the expected severity is the sum over j. A
feature is a word or a word's first letters, hashed; its value is how many of a
hundred words have it, where a word counts as MOST of a hundred at most.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import trimmed

LETTERS = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 6)
BITS = 18
MOST = 5.0
#: Words that a worker keeps with their features or weight.
CACHE = 400_000


def features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself, and its beginnings if longer."""
    parts = [word, *(f"{word[:n]}-" for n in PREFIXES if len(word) > n)]
    return tuple({zlib.crc32(p.encode()) % (1 << BITS) for p in parts})


def word_counts(text: str | None) -> Counter:
    return Counter(LETTERS.findall((text or "").lower()))


@dataclass(frozen=True)
class OrdinalModel:
    weights: np.ndarray  # of 2^BITS features
    thresholds: np.ndarray  # rising, one less than the grades

    def chances(self, x: np.ndarray) -> np.ndarray:
        """P(grade > j) for each row and threshold."""
        return 1 / (1 + np.exp(-np.clip(x[:, None] - self.thresholds, -40, 40)))


def sample_features(docs: DataFrame, labels: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, their values, how many each has, and grades of at most `limit` labelled rows of docs, those with the smallest hash of their id.

    This bounded sample is all that goes to the driver; of rows with the same id
    those of the smallest text hash come first.
    """
    chosen = labels.filter("grade IS NOT NULL").groupBy("doc_id").agg(F.max("grade").cast("int").alias("label_grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values = [], []
            for text in batch.column(1).to_pylist():
                total, share = word_counts(text), Counter()
                n = total.total()
                for word, c in total.items():
                    for f in features(word):
                        share[f] += min(100 * c / n, MOST)
                ids.append(list(share))
                values.append(list(share.values()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:1], batch.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["doc_id", "grade", "ids", "values"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", F.xxhash64("text")).limit(limit)
    rows = texts.mapInArrow(sparse, f"doc_id {kind}, grade int, ids array<int>, values array<float>").toArrow().sort_by("doc_id")
    lengths = pa.compute.list_value_length(rows["ids"]).to_numpy().astype(np.int64)
    return pa.compute.list_flatten(rows["ids"]).to_numpy(), pa.compute.list_flatten(rows["values"]).to_numpy(), lengths, rows["grade"].to_numpy()


def fit(ids: np.ndarray, values: np.ndarray, lengths: np.ndarray, grades: np.ndarray, n_grades: int, steps: int = 150, penalty: float = 3e-3, rate: float = 0.05, least_docs: int = 3) -> OrdinalModel:
    """Maximum likelihood with an L2 penalty, by Adam over the whole sample; rare grades weigh more.

    Features of fewer than `least_docs` documents have no weight. Without
    examples of two grades, all weights are 0 and so is severity.
    """
    if len(set(grades.tolist())) < 2:
        return OrdinalModel(np.zeros(1 << BITS, np.float32), np.full(n_grades - 1, 40.0))
    n = len(lengths)
    frequent = np.bincount(ids, minlength=1 << BITS) >= least_docs
    chosen = frequent[ids]
    place = np.cumsum(frequent) - 1
    flat, x, row = place[ids[chosen]].astype(np.int32), values[chosen].astype(np.float32), np.repeat(np.arange(n, dtype=np.int32), lengths)[chosen]
    size = int(frequent.sum())
    above = (grades[:, None] > np.arange(n_grades - 1)).astype(float)
    weight = np.where(grades > 0, np.sqrt((grades == 0).sum() / max(1, (grades > 0).sum())), 1.0)[:, None] / n
    params = np.concatenate([np.zeros(size), [1.0], np.zeros(n_grades - 2)])  # weights, first threshold, log steps between thresholds
    m, v = np.zeros_like(params), np.zeros_like(params)
    for step in range(1, steps + 1):
        w, gaps = params[:size], np.exp(params[size + 1 :])
        t = params[size] + np.concatenate([[0.0], np.cumsum(gaps)])
        z = np.bincount(row, w.astype(np.float32)[flat] * x, n)
        error = (1 / (1 + np.exp(-np.clip(z[:, None] - t, -40, 40))) - above) * weight
        back = -error.sum(0)
        grad = np.concatenate([np.bincount(flat, error.sum(1).astype(np.float32)[row] * x, size) + penalty * w, [back.sum()], [back[j + 1 :].sum() * g for j, g in enumerate(gaps)]])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        params = params - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[frequent] = params[:size]
    return OrdinalModel(weights, params[size] + np.concatenate([[0.0], np.cumsum(np.exp(params[size + 1 :]))]))


def rater(model: OrdinalModel, cut: float) -> Callable[[list[str | None]], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """A function of texts to their words, severities and grades; it keeps the weights of words that it has met."""
    known: dict[str, float] = {}

    def rate(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sums, counts = [], []
        for text in texts:
            total = word_counts(text)
            if new := [w for w in total if w not in known]:
                if len(known) > CACHE:
                    known.clear()
                    new = list(total)
                known.update((w, float(sum(model.weights[f] for f in features(w)))) for w in new)
            n = total.total()
            counts.append(n)
            sums.append(sum([min(100 * c / n, MOST) * known[w] for w, c in total.items()]))
        words = np.array(counts, np.int64)
        chance = model.chances(np.array(sums, float)) * (words > 0)[:, None]
        return words, chance.sum(1), (chance >= cut).sum(1).astype(np.int32)

    return rate


def score(docs: DataFrame, model: OrdinalModel, cut: float = 0.5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, severity (expected grade), grade (of the thresholds passed with `cut` or more), toxic (grade > 0).

    Whole texts, of any length; a null or empty text, or one without letters, has
    severity 0. Repeated rows and rows without an id are each scored, an empty
    table gives none, and other columns don't matter. The model has a fixed size
    (2^18 weights) and is sent with the tasks.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = rater(shared.value, cut)
        for batch in batches:
            words, severity, grade = of(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, (words, severity, grade, grade > 0))], ["doc_id", "n_words", "severity", "grade", "toxic"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(trimmed(rate), f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_words long, severity double, grade int, toxic boolean")


def grades_of(labels: DataFrame) -> DataFrame:
    """Grades from the label table: 0 not toxic, 1 toxic, 2 toxic and of low quality; null where toxic is null."""
    return labels.select("doc_id", (F.col("toxic") * (2 - F.coalesce("quality", F.lit(1)))).cast("int").alias("grade"))


def judge(docs: DataFrame, labels: DataFrame, limit: int = 4000, cut: float = 0.5) -> DataFrame:
    """Fits on at most `limit` labelled documents and scores all of `docs` (doc_id, text)."""
    own = docs.select("doc_id", "text")
    return score(own, fit(*sample_features(own, grades_of(labels), limit), n_grades=3), cut)


def without_toxic(docs: DataFrame, labels: DataFrame, limit: int = 4000, cut: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose grade is 0: judge's verdict, taken where the row is, so rows without an id are judged as well."""
    own = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(fit(*sample_features(own, grades_of(labels), limit), n_grades=3))
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = rater(shared.value, cut)
        for batch in batches:
            yield batch.filter(pa.array(of(batch.column(text_at).to_pylist())[2] == 0))

    return docs.mapInArrow(trimmed(keep), docs.schema)
