"""Cuts out of chunks and the projection of texts to bases."""

import random

from pyspark.sql import functions as F

from cytolake.operators import alignment as al
from cytolake.plans.fixtures import TEXTS, dna


def test_cut_is_a_substring(spark):
    rng = random.Random(1)
    texts = ["", "A", "ACGT" * 32, "".join(rng.choices("ACGTacgtN\n", k=700)), "AéC" * 100]
    places = [(t, at, n) for t in texts for at in (1, 2, 127, 128, 129, 257, 300, 699, 900) for n in (0, 1, 36, 128, 129, 400)]
    rows = spark.createDataFrame([(t, t, at, n) for t, at, n in places], "whole string, bases string, at int, n int")
    out = al.in_blocks(rows).select(al.cut(F.col("at"), F.col("n")).alias("found"), F.substring("whole", F.col("at"), F.col("n")).alias("expected"))
    assert all(r["found"] == r["expected"] for r in out.collect())


def test_spans_are_not_counted_out_of_whole_chunks(spark):
    """A read's span is joined from blocks: a substring of the chunk costs in proportion to the place in it, for every read."""
    reads = spark.createDataFrame([("r", 1, "C", 0, "s", 300, "4M", "ACGT")], "qname string, mate int, mode string, flag int, ref string, pos long, cigar string, seq string")
    chunks = spark.createDataFrame([("s", 0, 0, "ACGT" * 100)], "ref string, chunk long, chunk_start long, bases string")
    for frame in (al.rescore(reads, chunks), al.context_calls(reads.withColumn("qual", F.lit("IIII")), chunks)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert "slice(bases" in plan and "substring(bases" not in plan


def test_quality_is_looked_at_for_each_read_not_call(spark):
    """Whether a read is aligned in one piece is known before its calls are dealt out."""
    scored = spark.range(1).selectExpr("'r' qname", "1 mate", "'C' mode", "0 flag", "'s' ref", "5L pos", "concat(id + 2, 'M1I2M') cigar", "'IIIII' qual", "array(1L, id + 3) ym", "array(2L) yu")
    calls = al.calls_of(scored, 20)
    plan = calls._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan.split("Generate")[0]
    assert sorted((r["offset"], r["pos"], r["meth"], r["baseq"]) for r in calls.collect()) == [(1, 5, 1, 40), (2, 6, 0, 40), (3, 7, 1, 40)]


def test_dna_is_its_text(spark, tmp_path):
    rng = random.Random(2)
    texts = [None, "", "Az zA", "İKÅßΣ \U0001f600q", "1,2;3\n", *("".join(rng.choices("abXYZ İKé.,", k=rng.randrange(60))) for _ in range(300))]
    spark.createDataFrame([(i, t, "en", "web") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    expected = spark.sql(TEXTS["dna"].replace(", 'g')", ")"), documents=spark.read.parquet(f"{tmp_path}/documents.parquet"))
    assert sorted(map(tuple, dna(spark, str(tmp_path)).collect()), key=lambda r: r[0]) == sorted(map(tuple, expected.collect()), key=lambda r: r[0])
    assert "ArrowEvalPython" in dna(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
