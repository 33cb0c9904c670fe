"""Packing: first-fit decreasing over a tournament tree of bin capacities, in randomised groups."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, trimmed
from .tokens import encoder

PIECES = "doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False) -> DataFrame:
    """Token ids of whole texts (null: empty), each followed by end_id, in pieces of at most `size` ids.

    Returns doc_id, start, length, ids_crc32, doc_tokens, and with `with_ids` also
    `ids` (little-endian unsigned 32-bit). A text without tokens gives one piece
    that holds end_id. Rows with the same id are documents of their own.
    """
    end, width = np.array([end_id], "<u4").tobytes(), 4 * size

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows, start, length, crc, total, kept = [], [], [], [], [], []
                for row, ids in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    for lo in range(0, len(ids), width):
                        piece = ids[lo : lo + width]
                        rows.append(row)
                        start.append(lo // 4)
                        length.append(len(piece) // 4)
                        crc.append(zlib.crc32(piece))
                        total.append(len(ids) // 4)
                        if with_ids:
                            kept.append(piece)
                columns = [part.column(0).take(pa.array(rows)), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, names + ["ids"] * with_ids)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()) + ", ids binary" * with_ids
    return rows.mapInArrow(trimmed(pieces), schema)


def first_fit(lengths: list[int], size: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length (given in falling order), each in the leftmost bin with room.

    A tournament tree holds the largest free capacity below each node; a search
    goes down to the leftmost leaf with room in log2(bins) steps.
    """
    leaves = 1
    while leaves < 2 * (sum(lengths) // size + 1):  # two bins that are next to each other hold more than `size` together
        leaves *= 2
    tree = [size] * (2 * leaves)
    bins, offsets = [], []
    for n in lengths:
        node = 1
        while node < leaves:
            node *= 2
            if tree[node] < n:
                node += 1
        free = tree[node]
        bins.append(node - leaves)
        offsets.append(size - free)
        tree[node] = free - n
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def pack(pieces: DataFrame, size: int = 2048, group_rows: int = 16384, seed: int = 7) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, start, length at least).

    Pieces fall into groups by a seeded hash of document and start, about
    `group_rows` a group, so that a group fits in one task at any input size;
    first-fit decreasing runs in each. An id is the group times 2^32 plus the
    bin. Ties in length go by doc_id and start. An empty table stays empty; a
    length outside 1..size raises.
    """
    groups = max(1, -(-pieces.count() // group_rows))
    name = "pack_group"
    while name in pieces.columns:
        name += "_"
    group = F.pmod(F.xxhash64("doc_id", "start", F.lit(seed)), F.lit(groups))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], na_position="first", kind="stable")
        if len(pdf) and not (pdf["length"].iloc[-1] > 0 and pdf["length"].iloc[0] <= size):
            raise ValueError(f"lengths must lie in 1..{size}")
        full = int((pdf["length"] == size).sum())  # these come first and fill a bin each
        bins, offsets = first_fit(pdf["length"].iloc[full:].tolist(), size)
        pdf["sequence_id"] = pdf.pop(name) * 2**32 + np.concatenate([np.arange(full), np.array(bins, np.int64) + full]).astype(np.int64)
        pdf["offset"] = np.concatenate([np.zeros(full, np.int64), np.array(offsets, np.int64)]).astype(np.int64)
        return pdf

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return pieces.withColumn(name, group).groupBy(name).applyInPandas(place, schema)


def pack_documents(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, with_ids: bool = False, **columns: str) -> DataFrame:
    """cut_pieces, kept as a table, then pack."""
    return pack(materialise(cut_pieces(docs, vocabulary, size, end_id, with_ids=with_ids, **columns), "pieces"), size)
