"""Catalogs: where settings lie, reference and feature lists, and annotation by a whole feature list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotation as an
from ..operators import intervals as iv
from .readers import CATALOG, feature_table

#: Columns of a catalog that hold column numbers (fixed values).
NUMBERED = ("chrom", "start", "end", "strand", "exon_start", "exon_end", "cds_start", "cds_end")


def find_file(spark: SparkSession, name: str, folders: list[str]) -> str:
    """The first of folder/name, as it is or as .gz, that exists in any store that Spark reads."""
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        for end in ("", ".gz"):
            one = path(f"{folder.rstrip('/')}/{name}{end}")
            if one.getFileSystem(conf).exists(one):
                return one.toString()
    raise FileNotFoundError(f"{name} is in none of {', '.join(folders)}")


def _lines(spark: SparkSession, path: str) -> list[list[str]]:
    """Fields of a settings file, which has a line per genome file or feature set: some dozens."""
    rows = spark.read.text(path).filter("trim(value) <> '' AND NOT value LIKE '#%'").collect()
    return [r["value"].split("\t") for r in rows]


def reference_catalog(spark: SparkSession, path: str) -> dict:
    """`files` (name: file) and `indexes` (mapper: kind: prefix, from lines index_<kind>) of a reference list."""
    out: dict = {"files": {}, "indexes": {}}
    for words in _lines(spark, path):
        if words[0].startswith("index_"):
            out["indexes"].setdefault(words[1], {})[words[0].removeprefix("index_")] = words[2]
        else:
            out["files"][words[0]] = words[1]
    return out


def feature_catalog(spark: SparkSession, path: str, stream: int = 2000) -> list[dict]:
    """Entries of a feature list (see CATALOG), with column numbers as integers, flags as booleans, and up and down as lengths (`stream` where there is none)."""
    entries = []
    for words in _lines(spark, path):
        entry: dict = dict(zip(CATALOG, [*words, *["."] * len(CATALOG)], strict=False))
        if len(words) < 9 or not all(entry[c].replace(",", "").isdigit() for c in ("chrom", "start", "end")):
            raise ValueError(f"not a line of a feature list: {words}")
        for c in NUMBERED:
            entry[c] = int(entry[c].split(",")[0]) if entry[c] != "." else None
        for c in ("up", "down"):
            entry[c] = int(entry[c]) if entry[c] != "." else stream
        for c in ("id", "id2", "info"):
            entry[c] = int(entry[c].split(",")[0]) if entry[c].split(",")[0].isdigit() else None
        entry["is_gene"], entry["unique"] = entry["is_gene"] != "F", entry["unique"] != "F"
        entries.append(entry)
    return entries


def feature_sets(features: DataFrame, entry: dict) -> dict[str, DataFrame]:
    """A feature table's own set, and by its lengths the flanks before and behind it along the strand: name, name + up, name + dn."""
    minus = F.col("strand") == "-"

    def flank(length: int, before: bool) -> DataFrame:
        left = minus if not before else ~minus
        low = F.when(left, F.col("f_start") - length).otherwise(F.col("f_end"))
        return features.withColumns({"f_start": F.greatest(low, F.lit(0)), "f_end": low + length})

    out = {entry["name"]: features}
    if entry["up"]:
        out[entry["name"] + "up"] = flank(entry["up"], True)
    if entry["down"]:
        out[entry["name"] + "dn"] = flank(entry["down"], False)
    return out


def annotate_by(sites: DataFrame, features: DataFrame, entry: dict, letters: str = "U53DEI") -> DataFrame:
    """Sites (ref, start_pos, end_pos) annotated by one set: set_name, label, dist.

    A set with exons is looked at strand by strand and combined, another one
    with both strands pooled. Gene sets also take all features within their
    flanks, of which near ones go before far ones, and all labels that hold (see
    gene_labels), of which the first by priority stays.
    """
    stranded = entry.get("exon_start") is not None
    allow = max(entry["up"], entry["down"]) if entry["is_gene"] else 0
    near = iv.nearest_join(sites, features, allow, stranded)
    keys = ["ref", "start_pos", "end_pos"]
    labelled = an.gene_labels(near, entry["up"], entry["down"]) if entry["is_gene"] else near.withColumn("label", an.location_class(entry["up"], 0, entry["down"], 0))
    hits = an.near_only(labelled, keys)
    out = an.combine_strands(hits, keys, letters) if stranded else an.best_hit(hits, keys, letters).select(*keys, "label", F.abs("dist").alias("dist"))
    return out.withColumn("set_name", F.lit(entry["name"]))


def annotate(spark: SparkSession, sites: DataFrame, entries: list[dict], folder: str, letters: str = "U53DEI") -> DataFrame:
    """annotate_by for every entry of a list whose tables lie in `folder`."""
    parts = [annotate_by(sites, feature_table(spark, f"{folder}/{e['file']}", e), e, letters) for e in entries]
    return reduce(DataFrame.unionByName, parts)
