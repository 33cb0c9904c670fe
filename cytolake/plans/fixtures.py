"""Projections of the driver's tables to this library's data model.

One text serves Spark and the SQL check, so both see the same rows.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .tables import dealt_out

#: Samples, in two groups of three.
SAMPLES = ["af", "ao", "nf", "no", "rf", "ro"]
GROUPS = {"F": ["af", "nf", "rf"], "O": ["ao", "no", "ro"]}

#: What a row of lineitem is to `sites`: its site, and its reads and methylated ones.
SITE = """lower(l_returnflag || l_linestatus) as sample, l_linestatus as grp,
               'chr' || cast(l_suppkey % 5 + 1 as varchar(20)) as ref,
               l_partkey * 50 as start_pos, l_partkey * 50 + 2 as end_pos"""
READS, METHYLATED = "cast(l_quantity as bigint)", "cast(floor(cast(l_quantity as bigint) * cast(round(l_discount * 100) as bigint) / 10.0) as bigint)"

#: name: (table, text). Dependent ones name another projection.
TEXTS = {
    "sites": f"""
        select {SITE},
               cast(sum({READS}) as bigint) as cov,
               cast(sum({METHYLATED}) as bigint) as m
        from {{lineitem}} group by 1, 2, 3, 4, 5""",
    "features": """
        select p_partkey as feature_id, 'chr' || cast(p_partkey % 5 + 1 as varchar(20)) as ref,
               p_partkey * 50 - 100 as f_start, p_partkey * 50 - 100 + p_size * 20 as f_end,
               case when p_size % 2 = 0 then '+' else '-' end as strand, p_brand as gene, p_type as kind
        from {part}""",
    "calls": """
        select l_orderkey as read_id, 'chr' || cast(l_orderkey % 5 + 1 as varchar(20)) as ref,
               (l_orderkey % 40) * 200 + l_linenumber * 20 as pos,
               max(case when l_discount >= 0.05 then 1 else 0 end) as meth,
               max(cast(l_quantity as int)) as baseq
        from {lineitem} group by 1, 2, 3""",
    "dna": """
        select doc_id, lang, source, regexp_replace(translate(lower(text), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC'), '[^ACGT]', '', 'g') as seq
        from {documents}""",
    "reads": """
        select l_orderkey as qname, l_linenumber % 2 + 1 as mate, 'chr' || cast(l_suppkey % 5 + 1 as varchar(20)) as ref, l_partkey * 50 as pos,
               cast(l_suppkey % 61 as int) as mapq, cast(case when l_tax > 0.06 then 4 else 0 end + case when l_discount > 0.09 then 1024 else 0 end + case when l_returnflag = 'R' then 16 else 0 end as int) as flag,
               cast(l_quantity as int) + 30 as len, l_linenumber % 4 as soft, cast(round(l_tax * 100) as int) % 5 as ins, l_linenumber % 3 as del, cast(round(l_discount * 100) as int) as mism
        from {lineitem}""",
}
TABLES = {"sites": "lineitem", "features": "part", "calls": "lineitem", "dna": "documents", "reads": "lineitem"}


def fixture(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    table = TABLES[name]
    text = TEXTS[name].replace(", 'g')", ")")  # Spark replaces all matches without being told
    return spark.sql(text, **{table: spark.read.parquet(f"{sf_dir}/{table}.parquet")})


#: What a byte of a text is in `dna`, 0 for none.
BASES = np.zeros(256, np.uint8)
for _k in range(26):
    BASES[[65 + _k, 97 + _k]] = ord("ACGT"[_k % 4])


@F.arrow_udf(StringType())
def bases(text: pa.Array) -> pa.Array:
    """`seq` of the text of `dna`, by a table of bytes in place of a look-up and a match for each letter."""
    text = text.cast(pa.binary())
    for letter, small in ((b"\xc4\xb0", b"i"), (b"\xe2\x84\xaa", b"k")):  # the two letters beyond ASCII whose small ones hold one of a to z
        text = pc.replace_substring(text, letter, small)
    text = text.cast(pa.large_binary())
    _, at, data = text.buffers()
    at = np.frombuffer(at, np.int64)[text.offset : text.offset + len(text) + 1] if len(text) else np.zeros(1, np.int64)
    turned = BASES[np.frombuffer(data, np.uint8)[at[0] : at[-1]]] if data else np.zeros(0, np.uint8)
    before = np.concatenate([[0], np.cumsum(turned > 0)])[at - at[0]]
    seq = pa.LargeStringArray.from_buffers(len(text), pa.py_buffer(before), pa.py_buffer(turned[turned > 0]))
    return pc.if_else(text.is_null(), None, seq).cast(pa.string())


def dna(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the text of that name."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "source", bases("text").alias("seq"))


sites, features, calls, reads = (partial(fixture, n) for n in TEXTS if n != "dna")


def sites_by_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of `sites`, all of a place (ref, start_pos) in one partition.

    Few rows of a split share a site, so sums over a split would cost more than
    they save; groups by place behind it need no exchange of their own.
    """
    place = ("ref", "start_pos")
    rows = spark.sql(f"select {SITE}, {READS} as cov, {METHYLATED} as m from {{lineitem}}", lineitem=spark.read.parquet(f"{sf_dir}/lineitem.parquet"))
    return dealt_out(rows.repartition(*place), *place).groupBy("sample", "grp", *place, "end_pos").agg(F.sum("cov").alias("cov"), F.sum("m").alias("m"))


def with_fixtures(sql: str) -> str:
    """The query behind the texts that it names, for an engine that has the driver's tables."""
    ctes = [f"{name} AS ({text.format(**{TABLES[name]: TABLES[name]})})" for name, text in TEXTS.items() if name in sql]
    sql = sql.strip()
    if not ctes:
        return sql
    return "WITH " + ", ".join(ctes) + (", " + sql[5:] if sql[:5].upper() == "WITH " else "\n" + sql)
