"""Writers and the projections that they write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import item_rgb
from ..operators.sites import level

#: Track lines by the end of a file's name (fixed values).
TRACKS = (
    ("%.bam", "type=bam"), ("%.met.bw", "type=bigWig viewLimits=0:1"), ("%.diff.bw", "type=bigWig viewLimits=-1:1"), ("%.bw", "type=bigWig"), ("%.bb", "type=bigBed"), ("%.bed", 'type=bed itemRgb="On"'),
)


def bedgraph(sites: DataFrame, shift: float = 0.0, min_cov: int = 1) -> DataFrame:
    """One base per site with its level, shifted so that 0 shows."""
    return sites.filter(F.col("cov") >= min_cov).select("sample", "ref", "start_pos", (F.col("start_pos") + 1).alias("end_pos"), (level() + shift).alias("value"))


def coloured_bed(sites: DataFrame) -> DataFrame:
    """BED with nine columns; name and score tell coverage and level, the colour the level."""
    pct = level()
    score = F.least(F.greatest((pct * 1000).cast("int"), F.lit(0)), F.lit(1000))
    return sites.select("sample", "ref", "start_pos", "end_pos", F.col("cov").cast("string").alias("name"), score.alias("score"), F.lit(".").alias("strand"), F.col("start_pos").alias("thick_start"), F.col("end_pos").alias("thick_end"), item_rgb(pct).alias("rgb"))


def track_lines(files: DataFrame, url: str) -> DataFrame:
    """A browser's track line for each file name; names of no known kind are left out."""
    kind = F.lit(None).cast("string")
    for pattern, text in reversed(TRACKS):
        kind = F.when(F.col("name").like(pattern), text).otherwise(kind)
    return files.withColumn("kind", kind).filter("kind IS NOT NULL").select("name", F.format_string(f'track name="%s" %s bigDataUrl={url}/%s', "name", "kind", "name").alias("line"))


def gct_rows(matrix: DataFrame, samples: list[str]) -> DataFrame:
    """Complete rows of a matrix in GCT form (line_no, line): version, size, header, rows named ref*start*end."""
    full = matrix.dropna(subset=samples)
    head = full.agg(F.concat_ws("\t", F.count("*").cast("string"), F.lit(str(len(samples)))).alias("line")).select(F.lit(1).alias("line_no"), "line")
    first = matrix.sparkSession.createDataFrame([(0, "#1.2"), (2, "\t".join(["NAME", "Description", *samples]))], "line_no int, line string")
    rows = full.select(F.lit(3).alias("line_no"), F.concat_ws("\t", F.concat_ws("*", "ref", "start_pos", "end_pos"), F.col("ref"), *[F.col(s).cast("string") for s in samples]).alias("line"))
    return first.unionByName(head).unionByName(rows)


def write_tsv(rows: DataFrame, path: str, partition_by: list[str] | None = None, compression: str = "gzip", missing: str = "NA") -> None:
    """Tab-separated files with a header, one folder per value of `partition_by`."""
    writer = rows.write.option("sep", "\t").option("header", True).option("nullValue", missing).option("compression", compression)
    (writer.partitionBy(*partition_by) if partition_by else writer).csv(path)


def split_by_key(rows: DataFrame, key: str, path: str, exclude: DataFrame | None = None) -> None:
    """A folder per key, without the excluded keys."""
    write_tsv(rows.join(exclude.select(key).distinct(), key, "left_anti") if exclude is not None else rows, path, [key])


def split_reads(reads: DataFrame, n: int) -> DataFrame:
    """Reads with `part`, n runs of whole records in their order."""
    return reads.repartitionByRange(n, "file", "ord").sortWithinPartitions("file", "ord").withColumn("part", F.spark_partition_id())


def call_gff(pileup: DataFrame, context: str, program: str = "cytolake") -> DataFrame:
    """Counts per position as GFF columns; the score has three places."""
    note = F.format_string("mread=%d;uread=%d;mqual=%d;uqual=%d", "m", "u", "mqual", "uqual")
    return pileup.select("ref", F.lit(program).alias("program"), F.lit(context).alias("context"), F.col("pos").alias("start"), F.col("pos").alias("end"), F.format_string("%.3f", "score").alias("score"), F.lit("+").alias("strand"), F.lit(".").alias("frame"), note.alias("attributes"))
