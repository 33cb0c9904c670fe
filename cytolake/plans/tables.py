"""Intermediate tables that several branches of a plan read."""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the folder that driver and executors share (spark.checkpoint.dir), and read again. It goes when the session ends.

    Without that setting a local session gets a folder of its own; a cluster must name one.
    """
    spark = df.sparkSession
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="cytolake-")
        spark.conf.set("spark.checkpoint.dir", base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of files whose rows meet in one task.
SHARE = 8 << 20


def dealt_out(df: DataFrame, *keys: str, share: int = SHARE) -> DataFrame:
    """df by keys in a part for each `share` bytes of the files that it reads, so that a task's memory does not grow with them; as it is where spark.sql.shuffle.partitions are enough."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()) if leaves.apply(i).getClass().getSimpleName().startswith("LogicalRelation"))
    n = -(-size // share)
    return df.repartition(n, *keys) if n > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def fingerprint(df: DataFrame) -> str:
    """What df is made of: where it reads files alone, their names, lengths and times and the plan over them; else the number of its rows and the sum of their hashes, which takes a pass over them."""
    plan = df._jdf.queryExecution().optimizedPlan()
    leaves = plan.collectLeaves()
    kinds = [leaves.apply(i) for i in range(leaves.size())]
    if kinds and all(x.getClass().getSimpleName().startswith("LogicalRelation") and x.relation().getClass().getSimpleName() == "HadoopFsRelation" for x in kinds):
        spark = df.sparkSession
        conf, path, parts = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path, [re.sub(r"#\d+L?", "", plan.toString())]
        for name in sorted(df.inputFiles()):
            file = path(name)
            status = file.getFileSystem(conf).getFileStatus(file)
            parts.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    else:
        parts = [df.schema.simpleString(), str(tuple(df.agg(F.count("*"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))).first()))]
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()
