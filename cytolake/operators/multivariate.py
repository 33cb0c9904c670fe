"""Correlation, principal components and clustering of samples and sites."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.tables import stored
from .patterns import complete_linkage, linkage
from .stats import ranges


def correlations(matrix: DataFrame, samples: list[str]) -> DataFrame:
    """Pearson's r of all pairs of columns over complete rows, in one aggregate (a, b, r)."""
    pairs = list(combinations_with_replacement(samples, 2))
    row = matrix.dropna(subset=samples).agg(*[F.corr(a, b).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("r")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def ranked(matrix: DataFrame, samples: list[str], keys: list[str]) -> DataFrame:
    """Columns as average ranks over complete rows, for Spearman's r.

    Ranks come from counts of distinct values per column, in ranges of values;
    only a row per range and column meets in one place.
    """
    long = matrix.dropna(subset=samples).unpivot(keys, samples, "column", "v")
    parts, sizes = ranges(long, "v", by=("column",))
    values = parts.groupBy("part", "column", "v").agg(F.count("*").alias("n"))
    upto = F.sum("n").over(W.partitionBy("part", "column").orderBy("v"))
    ranks = values.withColumn("upto", upto).join(sizes, ["part", "column"]).select("column", "v", (F.col("before") + F.col("upto") - (F.col("n") - 1) / 2).alias("place"))
    placed = long.join(ranks, ["column", "v"])
    return placed.groupBy(*keys).agg(*[F.max(F.when(F.col("column") == s, F.col("place"))).alias(s) for s in samples])


def principal_components(matrix: DataFrame, samples: list[str], scale: bool = False) -> DataFrame:
    """Scores of samples on principal components (sample, component, score, sdev), each site centred.

    The Gram matrix of the samples is summed over all sites in one aggregate;
    only its few cells go to the driver. Signs make the first score positive.
    """
    full = matrix.dropna(subset=samples)
    mean = sum((F.col(s) for s in samples[1:]), F.col(samples[0])) / len(samples)
    full = full.withColumn("pca_mean", mean)
    if scale:
        var = sum(((F.col(s) - F.col("pca_mean")) ** 2 for s in samples[1:]), (F.col(samples[0]) - F.col("pca_mean")) ** 2) / (len(samples) - 1)
        full = full.withColumn("pca_sd", F.sqrt(var)).filter("pca_sd > 0")
    centred = {s: (F.col(s) - F.col("pca_mean")) / (F.col("pca_sd") if scale else 1) for s in samples}
    pairs = list(combinations_with_replacement(range(len(samples)), 2))
    row = full.agg(*[F.sum(centred[samples[i]] * centred[samples[j]]) for i, j in pairs]).first()
    gram = np.zeros((len(samples), len(samples)))
    for (i, j), v in zip(pairs, row, strict=True):
        gram[i, j] = gram[j, i] = v or 0.0
    values, vectors = np.linalg.eigh(gram)
    rows = []
    for k, c in enumerate(np.argsort(-values)[: len(samples) - 1], 1):
        score = vectors[:, c] * np.sqrt(max(values[c], 0))
        score = score * (-1 if score[np.argmax(np.abs(score) > 1e-12)] < 0 else 1)
        rows += [(s, k, float(x), float(np.sqrt(max(values[c], 0) / (len(samples) - 1)))) for s, x in zip(samples, score, strict=True)]
    return matrix.sparkSession.createDataFrame(rows, "sample string, component int, score double, sdev double")


def sample_distances(matrix: DataFrame, samples: list[str], metric: str = "euclidean") -> DataFrame:
    """Distances of all pairs of samples over complete rows (a, b, distance)."""
    x = {"euclidean": lambda a, b: F.sqrt(F.sum((a - b) ** 2)), "manhattan": lambda a, b: F.sum(F.abs(a - b)), "maximum": lambda a, b: F.max(F.abs(a - b)), "canberra": lambda a, b: F.sum(F.coalesce(F.try_divide(F.abs(a - b), F.abs(a + b)), F.lit(0.0))), "pearson": lambda a, b: 1 - F.corr(a, b)}[metric]
    pairs = [(a, b) for a, b in combinations_with_replacement(samples, 2) if a != b]
    row = matrix.dropna(subset=samples).agg(*[x(F.col(a), F.col(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"`{i}`").alias("distance")) for i, (a, b) in enumerate(pairs)])
    return row.select(F.explode(cells).alias("cell")).select("cell.*")


def cluster_samples(matrix: DataFrame, samples: list[str], cut: float, metric: str = "euclidean") -> DataFrame:
    """Samples in clusters by complete linkage up to a distance; only a cell per pair of samples goes to the driver."""
    far = np.zeros((len(samples), len(samples)))
    for r in sample_distances(matrix, samples, metric).collect():
        i, j = samples.index(r["a"]), samples.index(r["b"])
        far[i, j] = far[j, i] = r["distance"]
    return matrix.sparkSession.createDataFrame(pd.DataFrame({"sample": samples, "cluster": complete_linkage(far, cut)}), "sample string, cluster int")


def kmeans_rows(matrix: DataFrame, samples: list[str], k: int, keys: list[str], seed: int = 1) -> DataFrame:
    """Rows (keys) in k clusters of their sample profiles, with the samples' values. The rows are stored first, as fitting and assigning read them."""
    full = stored(matrix.dropna(subset=samples).select(*keys, *samples), "profiles").withColumn("profile", array_to_vector(F.array(*[F.col(s).cast("double") for s in samples])))
    model = KMeans(k=k, seed=seed, featuresCol="profile", predictionCol="cluster").fit(full)
    return model.transform(full).select(*keys, *samples, "cluster")


def cluster_profiles(clustered: DataFrame, samples: list[str]) -> DataFrame:
    """Size, means and medians of the samples per cluster."""
    return clustered.groupBy("cluster").agg(F.count("*").alias("n"), *[F.avg(s).alias(f"{s}_mean") for s in samples], *[F.percentile(s, F.lit(0.5)).alias(f"{s}_median") for s in samples])


def medoids(matrix: DataFrame, samples: list[str], k: int, candidates: int = 256) -> DataFrame:
    """Complete rows (id, samples) around k medoids, the rows of least total distance: id, cluster, medoid.

    Medoids are chosen among at most `candidates` rows, those of smallest id
    hash, but every cost is a sum over all rows of the table: first medoid by
    medoid, then by the best exchange of a medoid and a candidate until none
    lowers the cost. With no more rows than candidates it is partitioning around
    medoids itself. Tasks hold a batch and the candidates; a sum per candidate
    and medoid goes to the driver. The rows are stored first, as every step reads them.
    """
    full = stored(matrix.dropna(subset=samples).select("id", F.array(*[F.col(s).cast("double") for s in samples]).alias("profile")), "profiles")
    chosen = full.orderBy(F.xxhash64("id"), "id").limit(candidates).collect()
    names, points = [r["id"] for r in chosen], np.array([r["profile"] for r in chosen], float).reshape(len(chosen), len(samples))
    k = min(k, len(names))

    def distances(batch: pa.RecordBatch) -> np.ndarray:
        x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        return np.sqrt(((x[:, None] - points[None]) ** 2).sum(2))

    def costs(picked: list[int], exchange: bool) -> np.ndarray:
        """Total cost of picking each candidate as well, or (a row per medoid) in place of a medoid."""

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(picked) if exchange else 1, len(names)))
            for batch in batches:
                for at in range(0, batch.num_rows, 1000):
                    far = distances(batch.slice(at, 1000))
                    if not exchange:
                        near = far[:, picked].min(1) if picked else np.full(len(far), np.inf)
                        total[0] += np.minimum(near[:, None], far).sum(0)
                    for i in range(len(picked) if exchange else 0):
                        others = [p for j, p in enumerate(picked) if j != i]
                        near = far[:, others].min(1) if others else np.full(len(far), np.inf)
                        total[i] += np.minimum(near[:, None], far).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], ["cell", "cost"])

        rows = full.mapInArrow(add, "cell long, cost double").groupBy("cell").agg(F.sum("cost").alias("cost")).orderBy("cell").collect()
        return np.array([r["cost"] for r in rows]).reshape(-1, len(names))

    picked: list[int] = []
    while len(picked) < k:
        cost = costs(picked, False)[0]
        cost[picked] = np.inf
        picked.append(int(cost.argmin()))
    best = np.inf
    while picked:
        cost = costs(picked, True)
        now = cost[0, picked[0]]  # a medoid in its own place
        cost[:, picked] = np.inf
        i, c = np.unravel_index(int(cost.argmin()), cost.shape)
        if not cost[i, c] < min(now, best) - 1e-9 * max(1.0, now):
            break
        best, picked[int(i)] = float(cost[i, c]), int(c)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.concatenate([distances(batch.slice(at, 1000))[:, picked].argmin(1) for at in range(0, batch.num_rows, 1000)] or [np.zeros(0, int)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own.astype(np.int32)), pa.array([names[picked[c]] for c in own], pa.string())], ["id", "cluster", "medoid"])

    return full.mapInArrow(around, "id string, cluster int, medoid string")


def row_distances(x: np.ndarray, metric: str, power: float = 2) -> np.ndarray:
    """Distances between the rows of a table: those of geometry, or 1 less a correlation. binary: of the columns in which one of two rows isn't 0, the share in which the other is."""
    if metric == "kendall":
        pairs = np.triu_indices(x.shape[1], 1)
        x = np.sign(x[:, pairs[0]] - x[:, pairs[1]])
    elif metric == "spearman":
        x = pd.DataFrame(x).rank(axis=1).to_numpy()
    if metric in ("pearson", "spearman", "kendall"):
        x = x if metric == "kendall" else x - x.mean(1, keepdims=True)
        size = np.sqrt((x * x).sum(1))
        return 1 - (x @ x.T) / np.maximum(np.outer(size, size), 1e-300)
    if metric == "binary":
        on = (x != 0).astype(float)
        both, one = on @ on.T, on.sum(1)
        either = one[:, None] + one - both
        return np.divide(either - both, either, out=np.zeros_like(either), where=either > 0)
    out = np.zeros((len(x), len(x)))
    for column in x.T:  # a column at a time, so memory is that of the result
        gap = np.abs(column[:, None] - column)
        if metric == "maximum":
            out = np.maximum(out, gap)
        elif metric == "canberra":
            whole = np.abs(column[:, None] + column)
            out += np.divide(gap, whole, out=np.zeros_like(gap), where=whole > 0)
        else:
            out += gap ** {"euclidean": 2, "manhattan": 1, "minkowski": power}[metric]
    return out ** (1 / {"euclidean": 2, "minkowski": power}.get(metric, 1))


def cluster_rows(matrix: DataFrame, samples: list[str], n: int, metric: str = "euclidean", most: int = 5000, method: str = "complete") -> DataFrame:
    """The n rows (id, samples) that vary most, in the order of their tree (place), as a heatmap has them.

    A tree needs all distances, so n is `most` at most; the rows are ranked in
    Spark and only they meet in one task.
    """
    if n > most:
        raise ValueError(f"a tree of rows has {most} of them at most")
    spread = F.greatest(*samples) - F.least(*samples)
    top = matrix.dropna(subset=samples).withColumn("spread", spread).orderBy(F.desc("spread"), "id").limit(n)

    def order(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id", ignore_index=True)
        leaves, _ = linkage(row_distances(pdf[samples].to_numpy(float), metric), method)
        return pdf.iloc[leaves].assign(place=np.arange(len(pdf)))[["id", "place"]]

    placed = top.withColumn("tree", F.lit(0)).groupBy("tree").applyInPandas(order, "id string, place long")
    return top.drop("spread").join(placed, "id")
