"""Sequences as chunks, read so that no sequence is ever one row.

The lines of FASTA files are dealt out by file splits. Where a line lies in its
sequence follows from prefix sums of lengths: within a split in the order of
its lines, across splits from one row a split. Chunks are then put together
from the lines that they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bases of a chunk, bases that it reaches on behind its own (reads of 1000 and their margins), and bases that it reaches back.
CHUNK, OVERLAP, BEFORE = 10_000, 1016, 16


def fasta_lines(spark: SparkSession, path: str, full_header: bool = False) -> DataFrame:
    """The base lines of FASTA files: file, record (its number in the file), ref, at (bases of the record before the line) and bases.

    Blank lines and white space are left out; lines before the first header belong to no record and go.
    """
    value = F.regexp_replace("value", r"\s+$", "")
    source = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), value.alias("value"))
    head = F.col("value").startswith(">")
    name = F.regexp_replace(F.substring("value", 2, 2_147_483_647), r"^\s+", "")
    lines = source.select("file", "block", "id", head.cast("int").alias("head"), F.when(head, name if full_header else F.regexp_extract(name, r"^(\S*)", 1)).alias("name"), F.when(~head, F.regexp_replace("value", r"\s", "")).alias("bases"))
    split = W.partitionBy("file", "block").orderBy("id").rowsBetween(W.unboundedPreceding, 0)
    lines = lines.withColumn("inside", F.sum("head").over(split))
    run = W.partitionBy("file", "block", "inside").orderBy("id")
    size = F.coalesce(F.length("bases"), F.lit(0)).cast("long")
    lines = lines.withColumns({"own": size, "upto": F.sum(size).over(run.rowsBetween(W.unboundedPreceding, 0)), "own_name": F.first("name").over(run)})

    # a row a split: its records, and the bases before its first header and behind its last
    last = lines.groupBy("file", "block").agg(F.max("inside").alias("heads"), F.max(F.struct("inside", "upto", "own_name")).alias("tail"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    last = last.withColumn("record", F.coalesce(F.sum("heads").over(before), F.lit(0)))
    # splits without a header go on with the record of those before; their bases add up
    last = last.withColumn("ends_in", F.col("record") + F.col("heads"))
    same = W.partitionBy("file", "ends_in").orderBy("block")
    last = last.withColumn("carried", F.sum("tail.upto").over(same.rowsBetween(W.unboundedPreceding, 0))).withColumn("named", F.first("tail.own_name").over(same))
    line = W.partitionBy("file").orderBy("block")
    carried = last.select("file", "block", "record", F.coalesce(F.lag("carried").over(line), F.lit(0)).alias("carried"), F.lag("named").over(line).alias("named"))

    placed = lines.filter("head = 0 AND own > 0").join(carried, ["file", "block"])
    first = F.col("inside") == 0
    return placed.select("file", (F.col("record") + F.col("inside")).alias("record"), F.when(first, F.col("named")).otherwise(F.col("own_name")).alias("ref"), (F.col("upto") - F.col("own") + F.when(first, F.col("carried")).otherwise(0)).alias("at"), "bases").filter("record > 0")


def fasta_chunks(spark: SparkSession, path: str, size: int = CHUNK, overlap: int = OVERLAP, before: int = BEFORE, full_header: bool = False) -> DataFrame:
    """Sequences of FASTA files as chunks (ref, chunk, chunk_start, bases) that reach `before` bases back and `overlap` on.

    A line goes to the chunks that it reaches into, each of which gets its part
    alone. A name that comes twice raises where the chunk is put together.
    """
    lines = fasta_lines(spark, path, full_header)
    end = F.col("at") + F.length("bases")
    low, high = F.floor((F.col("at") - overlap) / size), F.floor((end - 1 + before) / size)
    rows = _cut_long(lines, size).withColumn("chunk", F.explode(F.sequence(F.greatest(low, F.lit(0)), high)))
    start, stop = F.greatest(F.col("chunk") * size - before, F.lit(0)), F.col("chunk") * size + size + overlap
    skip = F.greatest(start - F.col("at"), F.lit(0))
    part = F.substring("bases", (skip + 1).cast("int"), (F.least(stop, end) - F.col("at") - skip).cast("int"))
    pieces = rows.select("file", "record", "ref", "chunk", start.alias("chunk_start"), F.struct(F.greatest(F.col("at"), start).alias("at"), part.alias("part")).alias("piece")).filter("length(piece.part) > 0")
    chunk = pieces.groupBy("ref", "chunk", "chunk_start").agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.count_distinct("file", "record").alias("records"))
    bases = F.when(F.col("records") > 1, F.raise_error(F.concat(F.lit("two sequences have the name "), "ref"))).otherwise(F.array_join(F.transform("pieces", lambda p: p["part"]), ""))
    # a chunk that would hold bases of the one before alone is none
    return chunk.select("ref", F.col("chunk").cast("long").alias("chunk"), F.col("chunk_start").cast("long").alias("chunk_start"), bases.alias("bases")).filter((F.col("chunk") == 0) | (F.col("chunk_start") + F.length("bases") > F.col("chunk") * size))


def _cut_long(lines: DataFrame, size: int) -> DataFrame:
    """Lines of more than `size` bases as several."""
    parts = F.regexp_extract_all("bases", F.lit(f"(?s).{{1,{size}}}"), F.lit(0))
    cut = lines.withColumn("parts", F.when(F.length("bases") > size, parts).otherwise(F.array("bases"))).drop("bases")
    return cut.select("*", F.posexplode("parts").alias("k", "bases")).withColumn("at", F.col("at") + F.col("k") * size).drop("parts", "k")


def chunk_rows(refs: DataFrame, size: int = CHUNK, overlap: int = OVERLAP, before: int = BEFORE) -> DataFrame:
    """refs (ref, seq), sequences that are rows already, as such chunks. A sequence is cut once, and a chunk takes its margins from its neighbours."""
    seq = F.coalesce("seq", F.lit(""))
    parts = F.when(F.length(seq) == 0, F.array(F.lit(""))).otherwise(F.regexp_extract_all(seq, F.lit(f"(?s).{{1,{size}}}"), F.lit(0)))
    back, on = -(-before // size), -(-overlap // size)

    def chunk(part: Column, k: Column) -> Column:
        near = lambda step: F.coalesce(F.get("parts", k + step), F.lit(""))
        left = F.concat(*[near(i) for i in range(-back, 0)]) if back else F.lit("")
        right = F.concat(*[near(i) for i in range(1, on + 1)]) if on else F.lit("")
        bases = F.concat(F.right(left, F.lit(before)), part, F.left(right, F.lit(overlap)))
        return F.struct(k.cast("long").alias("chunk"), F.greatest(k.cast("long") * size - before, F.lit(0).cast("long")).alias("chunk_start"), bases.alias("bases"))

    return refs.select("ref", parts.alias("parts")).select("ref", F.explode(F.transform("parts", chunk)).alias("c")).select("ref", "c.*")


def as_chunks(refs: DataFrame, size: int = CHUNK, overlap: int = OVERLAP, before: int = BEFORE) -> DataFrame:
    """refs, be they sequences (ref, seq) or chunks of `size` with margins that wide or wider, as chunks with these margins."""
    if "bases" not in refs.columns:
        return chunk_rows(refs, size, overlap, before)
    start = F.greatest(F.col("chunk") * size - before, F.lit(0))
    bases = F.substring("bases", (start - F.col("chunk_start") + 1).cast("int"), (F.col("chunk") * size + size + overlap - start).cast("int"))
    return refs.select("ref", "chunk", start.cast("long").alias("chunk_start"), bases.alias("bases"))


def sequence_lengths(refs: DataFrame) -> DataFrame:
    """(ref, length) of sequences or chunks."""
    if "bases" not in refs.columns:
        return refs.select("ref", F.length("seq").cast("long").alias("length"))
    return refs.groupBy("ref").agg(F.max(F.col("chunk_start") + F.length("bases")).alias("length"))
