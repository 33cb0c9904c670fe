"""Reports of two groups: means and p from one pass, and q alone where it is asked for."""

import duckdb
import pytest
from oracle import connection, difference
from pyspark.sql import functions as F

from cytolake.operators import stats as ts
from cytolake.plans import tables
from cytolake.plans.fixtures import sites, sites_by_place
from cytolake.queries import relational_queries, relational_sql

SF_DIR = "/root/testdata/sf0.001"


def leaves_of(frame) -> int:
    return frame._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_significant_by_p_reads_lineitem_once(spark):
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("by_p", "made, not run")
    frame = relational_queries()["t15_significant_by_p"](spark, SF_DIR)
    spark.sparkContext._jsc.clearJobGroup()
    assert leaves_of(frame) == 1  # five reads of stored tests before
    assert [f.rsplit("/", 1)[-1] for f in frame.inputFiles()] == ["lineitem.parquet"]
    assert len(jobs("by_p")) <= 1  # the schema of the file, if anything


@pytest.mark.parametrize("name", ["t15_significant_by_p", "t15_report"])
@pytest.mark.parametrize("share", [tables.SHARE, 8 << 10])
def test_reports_of_dealt_out_places_are_the_same(spark, monkeypatch, name, share):
    monkeypatch.setattr(tables.dealt_out, "__kwdefaults__", {"share": share})
    frame = relational_queries()[name](spark, SF_DIR)
    assert not difference(frame, connection(SF_DIR), relational_sql()[name])


@pytest.mark.parametrize("name", ["t15_significant_by_p", "t15_report"])
def test_reports_of_odd_rows(spark, tmp_path, name):
    """Rows without a part, a supplier, a quantity, a discount or a status, and sites of few reads."""
    duckdb.sql(f"""COPY (SELECT * REPLACE (CASE WHEN l_orderkey % 11 <> 0 THEN l_partkey % 400 END AS l_partkey, CASE WHEN l_orderkey % 7 <> 0 THEN l_suppkey END AS l_suppkey,
        CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity % 9 END AS l_quantity, CASE WHEN l_orderkey % 13 <> 0 THEN l_linestatus END AS l_linestatus,
        CASE WHEN l_partkey % 3 <> 0 THEN l_discount END AS l_discount)
        FROM '{SF_DIR}/lineitem.parquet') TO '{tmp_path}/lineitem.parquet' (FORMAT parquet)""")
    frame = relational_queries()[name](spark, str(tmp_path))
    assert not difference(frame, connection(str(tmp_path)), relational_sql()[name])


def test_sites_by_place_are_the_sites(spark):
    found, expected = sites_by_place(spark, SF_DIR), sites(spark, SF_DIR)
    assert dict(found.dtypes) == dict(expected.dtypes)
    found = found.select(expected.columns)
    assert found.exceptAll(expected).isEmpty() and expected.exceptAll(found).isEmpty()
    grouped = sites_by_place(spark, SF_DIR).groupBy("ref", "start_pos").agg(F.sum("m"))
    assert grouped._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_p_of_the_pass_is_that_of_a_table(spark):
    rows = [("x", "a", 0.5, 3), ("x", "b", 0.25, 4), ("x", "a", 0.9, 2), ("y", "a", 0.3, 1), ("z", "b", 0.75, 5), ("z", "c", 0.1, 3), ("w", "b", None, 4)]
    table = spark.createDataFrame(rows, "site string, grp string, pct double, m long")
    p = F.sum("m") / 10
    one = ts.two_group_report(table, "a", "b", F.when(F.col("site") != "z", p), ("site",), where=F.col("m") > 2)
    two = ts.two_group_report(table.filter("m > 2"), "a", "b", table.groupBy("site").agg(p.alias("p")).filter("site <> 'z'"), ("site",))
    assert sorted(one.collect()) == sorted(two.collect())
    bare = ts.two_group_report(table, "a", "b", F.when(F.col("site") != "z", p), ("site",), where=F.col("m") > 2, adjust=False)
    assert sorted(bare.collect()) == sorted(one.drop("q").collect())
    assert set(ts.report_tables(bare, 0.95, 0.9, 0.1)) == {"all", "by_p"}
    assert [r["site"] for r in ts.report_tables(bare, 0.95, 0.9, 0.1)["by_p"].collect()] == ["x"]
