"""Readers. All go through Spark's text and CSV readers, so any store and codec (gz, bz2) that Spark knows works."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SITE = "ref string, start_pos long, end_pos long, cov long, pct double, strand string, m long"
FASTQ_NAME = r"^(.+?)(?:_R?([12]))?\.(?:fastq|fq)(?:\.gz|\.bz2)?$"
SAM = ("qname", "flag", "ref", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")


def table(spark: SparkSession, path: str, schema: str, header: bool = False, comment: str = "#") -> DataFrame:
    """A tab-separated table with a declared schema; comment and blank lines are skipped."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", header)
    return (reader.option("comment", comment) if comment else reader).csv(path)


def site_beds(spark: SparkSession, path: str, context: str) -> DataFrame:
    """Methylation BED files <sample>.<...>.<context>.bed[.gz] with their sample from the file name."""
    rows = table(spark, path, SITE).withColumn("file", F.regexp_extract(F.input_file_name(), "([^/]+)$", 1))
    named = rows.withColumn("sample", F.regexp_extract("file", rf"^([^.]+)\..*\b{re.escape(context)}\.bed", 1))
    return named.filter("sample <> ''").drop("file").withColumn("ctx", F.lit(context))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their number in their file (file, line_no, value).

    Lines are numbered within each split of a file and go on from the splits
    before it; only a count per split meets in one place.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), "value")
    counts = lines.groupBy("file", "block").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.row_number().over(W.partitionBy("file", "block").orderBy("id")) - 1
    return lines.withColumn("inside", inside).join(counts.withColumn("before", before), ["file", "block"]).select("file", (F.col("inside") + F.col("before")).alias("line_no"), "value")


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Reads of FASTQ files: file, ord, id, seq, plus, qual. A record is four lines."""
    lines = numbered_lines(spark, path).withColumns({"ord": F.floor(F.col("line_no") / 4), "k": (F.col("line_no") % 4).cast("int")})
    record = lines.groupBy("file", "ord").agg(*[F.max(F.when(F.col("k") == k, F.col("value"))).alias(c) for k, c in enumerate(("id", "seq", "plus", "qual"))])
    return record.withColumn("id", F.regexp_replace("id", "^@", ""))


def fasta(spark: SparkSession, path: str, full_header: bool = False) -> DataFrame:
    """Sequences of FASTA files (ref, seq). A record begins with '>' at the start of a line, so records are read as such."""
    rows = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("v")).filter("trim(v) <> ''")
    name = F.regexp_extract("v", r"^([^\r\n]*)", 1)
    ref = name if full_header else F.regexp_extract(name, r"^(\S+)", 1)
    return rows.select(ref.alias("ref"), F.regexp_replace(F.regexp_replace("v", r"^[^\r\n]*", ""), r"\s", "").alias("seq"))


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text: the eleven columns and `tags`, the rest of the line."""
    parts = F.split("value", "\t", 12)
    rows = spark.read.text(path).filter(~F.col("value").startswith("@") & (F.col("value") != ""))
    numbers = {"flag": "int", "pos": "long", "mapq": "int", "pnext": "long", "tlen": "long"}
    return rows.select(*[F.get(parts, i).cast(numbers.get(c, "string")).alias(c) for i, c in enumerate(SAM)], F.coalesce(F.get(parts, 11), F.lit("")).alias("tags"))


def sample_sheet(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Samples (file, mode, sample, grp) and, from rows whose second column is no digit, hydroxymethylation pairs (a, b, sample, grp)."""
    rows = table(spark, path, "c1 string, c2 string, c3 string, c4 string")
    one = F.col("c2").rlike("^[0-9]$")
    samples = rows.filter(one).select(F.col("c1").alias("file"), F.col("c2").cast("int").alias("mode"), F.col("c3").alias("sample"), F.col("c4").alias("grp"))
    return samples, rows.filter(~one).select(F.col("c1").alias("a"), F.col("c2").alias("b"), F.col("c3").alias("sample"), F.col("c4").alias("grp"))


def make_sample_sheet(spark: SparkSession, path: str, groups: list[tuple[str, str]]) -> DataFrame:
    """A sample sheet from the names of FASTQ files: sample and mate from the name, group of the first pattern that fits, else the sample."""
    names = spark.read.format("binaryFile").load(path).select("path", F.regexp_extract("path", "([^/]+)$", 1).alias("name"))
    sample, mate = F.regexp_extract("name", FASTQ_NAME, 1), F.regexp_extract("name", FASTQ_NAME, 2)
    grp = F.col("sample")
    for pattern, name in reversed(groups):
        grp = F.when(F.col("sample").rlike(pattern), name).otherwise(grp)
    rows = names.withColumns({"sample": sample, "mode": F.when(mate == "", "1").otherwise(mate).cast("int")}).filter("sample <> ''")
    return rows.select(F.col("path").alias("file"), "mode", "sample", grp.alias("grp"))


def joined_matrix(spark: SparkSession, path: str, n_keys: int = 3) -> DataFrame:
    """A joined file as long rows (keys, sample, values).

    The kind follows from how often a sample's name repeats in the header: 1
    level, 2 counts (m, cov), 3 window values; windows hold counts if a second
    value goes over 1, else means.
    """
    header = spark.read.text(path).first()[0].lstrip("#").split("\t")
    keys, names = [k.lower() for k in header[:n_keys]], header[n_keys:]
    samples = list(dict.fromkeys(names))
    per = len(names) // len(samples)
    raw = spark.read.option("sep", "\t").option("comment", "#").option("nullValue", "NA").schema(", ".join(f"c{i} string" for i in range(len(header)))).csv(path)
    if per == 3:
        second = F.max(F.greatest(*[F.col(f"c{n_keys + 3 * i + 1}").cast("double") for i in range(len(samples))], F.lit(0.0)))
        values = ["n_cpg", "m", "cov"] if raw.agg(second).first()[0] > 1 else ["n_cpg", "mean_pct", "sd_pct"]
    else:
        values = ["pct"] if per == 1 else ["m", "cov"]
    cells = F.array(*[F.struct(F.lit(s).alias("sample"), *[F.col(f"c{n_keys + per * i + j}").cast("double").alias(v) for j, v in enumerate(values)]) for i, s in enumerate(samples)])
    return raw.select(*[F.col(f"c{i}").alias(k) for i, k in enumerate(keys)], F.explode(cells).alias("cell")).select(*keys, "cell.*")


#: The columns of a feature catalog, in order (fixed values).
CATALOG = ("file", "name", "is_gene", "id", "id2", "unique", "use", "chrom", "start", "end", "strand", "up", "down", "info", "exon_start", "exon_end", "cds_start", "cds_end", "parameter")


def feature_table(spark: SparkSession, path: str, entry: dict[str, int | None]) -> DataFrame:
    """Features of a raw annotation table by an entry's column numbers from 1 (see CATALOG); exon lists become arrays."""
    raw = F.split("value", "\t")

    def column(name: str):
        return F.get(raw, entry[name] - 1) if entry.get(name) else F.lit(None).cast("string")

    def places(name: str):
        return F.transform(F.filter(F.split(column(name), ","), lambda x: x != ""), lambda x: x.cast("long"))

    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.col("value") != ""))
    return rows.select(
        column("chrom").alias("ref"), column("id").alias("feature_id"), column("start").cast("long").alias("f_start"), column("end").cast("long").alias("f_end"),
        F.coalesce(column("strand"), F.lit(".")).alias("strand"), F.arrays_zip(places("exon_start").alias("s"), places("exon_end").alias("e")).alias("exons"),
        column("cds_start").cast("long").alias("cds_start"), column("cds_end").cast("long").alias("cds_end"), column("info").alias("info"),
    )


def enzyme_config(lines: list[str]) -> dict:
    """Enzyme settings from lines `name X`, `site C-CGG` and `fix MOTIF strand offset`."""
    out: dict = {"fix": []}
    for line in lines:
        words = line.split()
        if not words or words[0].startswith("#"):
            continue
        if words[0] == "fix":
            out["fix"].append((words[1], words[2], int(words[3])))
        elif words[0] == "site":
            out["motif"], out["cut"] = words[1].replace("-", ""), words[1].index("-")
        else:
            out[words[0]] = words[1]
    return out


def fasta_records(spark: SparkSession, path: str, kind: str = "id") -> DataFrame:
    """FASTA records with a name for a file of their own (name, ref, seq).

    kind: id (the first word), last (the last part between bars), no (their
    number), or a database's name, whose part between bars is taken.
    """
    rows = fasta(spark, path, full_header=True)
    header = F.col("ref")
    if kind == "no":
        counted = rows.withColumn("id", F.monotonically_increasing_id())
        name = F.row_number().over(W.orderBy("id")).cast("string")  # a file's records are few; use another kind for many
        return counted.select(name.alias("name"), "ref", "seq")
    patterns = {"id": r"^\s*(\S+)", "last": r"\|([^|\s]+)(?:\s|$)"}
    return rows.select(F.regexp_extract(header, patterns.get(kind, rf"{re.escape(kind)}\|([^|]+)"), 1).alias("name"), "ref", "seq")


def clean_bed(spark: SparkSession, path: str, every_column: bool = False) -> DataFrame:
    """A BED-like table for annotation: no track or browser lines, names from its header or the usual ones, six columns unless `every_column`."""
    lines = spark.read.text(path).filter("trim(value) <> '' AND NOT value RLIKE '^(track|brows)'")
    first = lines.first()
    if first is None:
        return spark.createDataFrame([], "chrom string, start long, `end` long")
    words = first["value"].split("\t")
    last = len(words) if every_column or len(words) <= 6 else 6
    usual = [*BED_NAMES, *(f"Col{k}" for k in range(len(BED_NAMES), last))][:last]
    names = [w.lstrip("#") or f"Col{k}" for k, w in enumerate(words[:last])] if "start" in first["value"] else usual
    parts = F.split("value", "\t")
    rows = lines.filter(~F.col("value").startswith("#") & (F.col("value") != first["value"]) | (F.lit("start" not in first["value"]) & (F.col("value") == first["value"])))
    kinds = {1: "long", 2: "long"}
    return rows.select(*[F.get(parts, k).cast(kinds.get(k, "string")).alias(n) for k, n in enumerate(names)])


#: Columns of a BED file without a header (fixed values).
BED_NAMES = ("chrom", "start", "end", "name", "score", "strand")


def numbered_probes(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A probe table with the running number of its lines, from 1 (no)."""
    fields = [f.strip().split() for f in schema.split(",")]
    lines = numbered_lines(spark, path).filter("trim(value) <> '' AND NOT value LIKE '#%'")
    skipped = numbered_lines(spark, path).filter("trim(value) = '' OR value LIKE '#%'").select("file", F.col("line_no").alias("gone"))
    before = lines.join(skipped, (lines["file"] == skipped["file"]) & (F.col("gone") < F.col("line_no")), "left").groupBy(lines["file"], "line_no", "value").agg(F.count("gone").alias("n"))
    parts = F.split("value", "\t")
    return before.select((F.col("line_no") - F.col("n") + 1).alias("no"), *[F.get(parts, k).cast(kind).alias(name) for k, (name, kind) in enumerate(fields)])
