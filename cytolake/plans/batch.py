"""The whole analysis as one lazy plan: sites to windows, groups, tests and annotation, with tables where results are used again."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotation as an
from ..operators import intervals as iv
from ..operators import matrix as mx
from ..operators import sites as st
from ..operators import stats as ts
from .tables import fingerprint


@dataclass
class Settings:
    """Defaults of the analysis."""

    min_cov: int = 5
    width: int = 1000
    step: int = 500
    min_cpgs: int = 5
    least_diff: float = 0.25
    p_cut: float = 0.01
    q_cut: float = 0.05
    pairs: list[tuple[str, str]] = field(default_factory=list)


def batch(sites: DataFrame, features: DataFrame, settings: Settings, path: str, samples: list[str], resume: bool = False) -> dict[str, DataFrame]:
    """Writes windows, matrix, tests and annotated regions below `path` and returns them as tables.

    With `resume`, tables that are there (with their _SUCCESS mark) and were made
    of the same inputs (see fingerprint) with the same settings are read and not made again.
    """
    spark = sites.sparkSession
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path

    def keep(name: str, df: DataFrame) -> DataFrame:
        target = f"{path}/{mark}/{name}"
        done = hadoop(f"{target}/_SUCCESS")
        if not (resume and done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done)):
            df.write.mode("overwrite").parquet(target)
        return spark.read.schema(df.schema).parquet(target)

    # other settings or inputs, another folder
    mark = hashlib.sha256(repr((settings, sorted(samples), fingerprint(sites), fingerprint(features))).encode()).hexdigest()[:12]
    kept = st.filter_sites(sites, settings.min_cov)
    windows = keep("windows", iv.genome_windows(kept, settings.width, settings.step, ("sample", "grp")))
    matrix = keep("matrix", mx.outer_matrix(windows, samples, ["n_cpg", "mean_pct", "sd_pct"], ("ref", "w_start", "w_end")))
    keys = ("ref", "w_start", "w_end")
    rich = mx.min_cpgs(windows, settings.min_cpgs, len(samples))
    tests = None
    for a, b in settings.pairs:
        one = ts.bh_adjust(ts.welch(rich, a, b, "mean_pct", keys)).withColumns({"g1": F.lit(a), "g2": F.lit(b)})
        tests = one if tests is None else tests.unionByName(one)
    out = {"windows": windows, "matrix": matrix}
    if tests is not None:
        out["tests"] = keep("tests", tests)
        regions = ts.significant(out["tests"], settings.p_cut, settings.least_diff).withColumnsRenamed({"w_start": "start_pos", "w_end": "end_pos"})
        near = iv.nearest_join(regions.select("ref", "start_pos", "end_pos").distinct(), features).withColumn("label", an.location_class())
        out["annotated"] = keep("annotated", an.best_hit(an.near_only(near, ["ref", "start_pos"]), ["ref", "start_pos"]))
    return out
