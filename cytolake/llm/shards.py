"""Training-order materialisation: a keyed permutation gives each sequence its slot; shards hold slots in order.

A shard is a file of fixed-stride records, so slot s lies in file s div
records_per_shard at byte (s mod records_per_shard) * stride, and a reader can
go on from any slot.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import U64, materialise, mix, scratch
from .tokens import encoder

ROUNDS = 6


def permute(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: a balanced Feistel network over the next even power of two, walked along its cycle until it falls below n."""
    half = U64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    low = (U64(1) << half) - U64(1)
    keys = mix(np.arange(1, ROUNDS + 1, dtype=U64) + U64(key & (2**64 - 1)))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        return left << half | right

    out = once(index.astype(U64))
    while (outside := out >= U64(n)).any():
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def cut_sequences(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Token ids of a task's documents one after another, each with end_id behind it, cut every `size` ids.

    Returns task, number (in the task), doc_id and start of the first id, n_tokens
    and tokens (16-bit ids, zstd; a larger id raises). Only a task's last sequence
    is shorter. A null or empty text is its end_id alone, a row without an id or
    a repeated row is a document like others, and a very long text goes on over
    as many sequences as it needs. An empty table gives none.
    """
    end = np.array([end_id], "<u4").tobytes()

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, squeeze, task = encoder(vocabulary).encode, zstandard.ZstdCompressor(3).compress, TaskContext.get().partitionId()
        number, pending, spans, held = 0, bytearray(), [], 0  # spans: (position in pending, doc_id)

        def emit(lengths: list[int], typ: pa.DataType) -> pa.RecordBatch:
            nonlocal number, spans
            firsts, starts, tokens, at, k = [], [], [], 0, 0
            for n in lengths:
                while k + 1 < len(spans) and spans[k + 1][0] <= at:
                    k += 1
                firsts.append(spans[k][1])
                starts.append(at - spans[k][0])
                own = np.frombuffer(pending, "<u4", n, 4 * at)
                if own.max(initial=0) > 0xFFFF:
                    raise ValueError("an id needs more than 16 bits; shards hold two bytes an id")
                tokens.append(squeeze(own.astype("<u2").tobytes()))
                del own  # `pending` can't shrink under a view
                at += n
            numbers = list(range(number, number + len(lengths)))
            number += len(lengths)
            while k + 1 < len(spans) and spans[k + 1][0] <= at:
                k += 1
            spans = [(p - at, d) for p, d in spans[k:]]
            del pending[: 4 * at]
            long = [pa.array(x, pa.int64()) for x in ([task] * len(lengths), numbers)]
            return pa.RecordBatch.from_arrays([*long, pa.array(firsts, typ), pa.array(starts, pa.int64()), pa.array(lengths, pa.int64()), pa.array(tokens, pa.binary())], ["task", "number", "doc_id", "start", "n_tokens", "tokens"])

        typ = pa.int64()
        for batch in batches:
            typ = batch.column(0).type
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                for key, ids in zip(part.column(0).to_pylist(), encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    spans.append((len(pending) // 4, key))
                    pending += ids + end
                if held := len(pending) // 4 // size:
                    yield emit([size] * held, typ)
        if pending:
            yield emit([len(pending) // 4], typ)

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(sequences, f"task long, number long, doc_id {rows.schema['doc_id'].dataType.simpleString()}, start long, n_tokens long, tokens binary")


def write_shards(sequences: DataFrame, path: str, key: int, size: int = 2048, records_per_shard: int = 8192, pad_id: int = 49407, shards_per_task: int = 32) -> DataFrame:
    """Writes `sequences` (a table of cut_sequences) to `path` in a keyed order when it is run; gives one row per sequence.

    slot, shard, record, doc_id, start, n_tokens, ids_crc32 (of the record as
    written). The dense index before the permutation is the order of task and
    number; only a count per task goes to the driver. A task writes a range of
    shards one after another, at most `shards_per_task`, and fewer where that
    keeps all cores busy. A file is written under another name and then renamed,
    so a repeated task does no harm. An empty table writes nothing.
    """
    counts = sorted((r["task"], r["n"]) for r in sequences.groupBy("task").agg(F.count("*").alias("n")).collect())
    total, before = 0, {}
    for task, n in counts:
        before[task] = total
        total += n
    n_shards = max(1, -(-total // records_per_shard))
    together = max(1, min(shards_per_task, n_shards // (4 * sequences.sparkSession.sparkContext.defaultParallelism)))
    base = [0] * (max(before, default=0) + 1)
    for task, n in before.items():
        base[task] = n

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.array(base, np.int64)
        for batch in batches:
            slot = permute(first[batch.column(0).to_numpy()] + batch.column(1).to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays([pa.array(slot // records_per_shard), pa.array(slot), *batch.columns[2:]], ["shard", "slot", *batch.schema.names[2:]])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(path)
        unpack, out, shard, attempt = zstandard.ZstdDecompressor().decompress, None, -1, TaskContext.get().taskAttemptId()
        part = ""

        def close() -> None:
            if out is not None:
                out.close()
                system.move(part, f"{root}/shard-{shard:06d}.bin")

        for batch in batches:
            crc = []
            for k, tokens in zip(batch.column(0).to_pylist(), batch.column(5).to_pylist(), strict=True):
                if k != shard:
                    close()
                    shard, part = k, f"{root}/.shard-{k:06d}-{attempt}"
                    system.create_dir(root, recursive=True)
                    out = system.open_output_stream(part)
                record = unpack(tokens)
                record += np.full(size - len(record) // 2, pad_id, "<u2").tobytes()
                out.write(record)
                crc.append(zlib.crc32(record))
            slot = batch.column(1).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(1), batch.column(0), pa.array(slot % records_per_shard), *batch.columns[2:5], pa.array(crc, pa.int64())], ["slot", "shard", "record", "doc_id", "start", "n_tokens", "ids_crc32"])
        close()

    kind = sequences.schema["doc_id"].dataType.simpleString()
    placed = sequences.mapInArrow(slots, f"shard long, slot long, doc_id {kind}, start long, n_tokens long, tokens binary")
    ordered = placed.repartitionById(-(-n_shards // together), (F.col("shard") / together).cast("int")).sortWithinPartitions("slot")
    return ordered.mapInArrow(write, f"slot long, shard long, record long, doc_id {kind}, start long, n_tokens long, ids_crc32 long")


def materialise_order(docs: DataFrame, vocabulary: str, path: str | None = None, key: int = 20240229, size: int = 2048, records_per_shard: int = 8192, **columns: str) -> DataFrame:
    """Writes all of docs as shards in a keyed order, at once, and gives the manifest (a row per record, see write_shards) that lies beside them.

    Without `path`, shards/<name> in the shared folder, where they stay. Columns
    of docs other than id and text don't matter.
    """
    path = path or f"{scratch(docs.sparkSession)}/shards/{uuid.uuid4().hex}"
    sequences = materialise(cut_sequences(docs, vocabulary, size, **columns), "sequences")
    rows = write_shards(sequences, path, key, size, records_per_shard)
    rows.write.parquet(f"{path}/manifest")
    return docs.sparkSession.read.schema(rows.schema).parquet(f"{path}/manifest")


def read_records(path: str, slot: int, n: int, size: int = 2048, records_per_shard: int = 8192) -> Iterator[np.ndarray]:
    """`n` records from `slot` on, read in order; fewer at the end."""
    system, root = pafs.FileSystem.from_uri(path)
    while n > 0:
        shard, record = divmod(slot, records_per_shard)
        name = f"{root}/shard-{shard:06d}.bin"
        if system.get_file_info(name).type != pafs.FileType.File:
            return
        with system.open_input_file(name) as file:
            file.seek(record * size * 2)
            while n > 0 and record < records_per_shard and (raw := file.read(size * 2)):
                yield np.frombuffer(raw, "<u2")
                slot, record, n = slot + 1, record + 1, n - 1
        if record < records_per_shard:
            return
