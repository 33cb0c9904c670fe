"""Parts of joins and groupings follow the size of the files that are read."""

import pytest

from cytolake.operators import intervals as iv
from cytolake.plans import tables
from cytolake.queries import relational_queries, relational_sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def small_shares(monkeypatch):
    """Shares of 8 kB, so that small tables are dealt out."""
    monkeypatch.setattr(tables.dealt_out, "__kwdefaults__", {"share": 8 << 10})


def parts_of(frame) -> int:
    return frame._jdf.queryExecution().optimizedPlan().toString().count("RepartitionByExpression")


def test_parts_follow_the_files(spark, tmp_path):
    spark.range(1000).selectExpr("id", "'chr1' ref", "id * 10 start_pos").write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    size = sum(f.stat().st_size for f in (tmp_path / "p").glob("*.parquet"))
    assert tables.dealt_out(rows, "ref", share=size // 10).rdd.getNumPartitions() in (10, 11)
    assert parts_of(tables.dealt_out(rows, "ref")) == 0
    features = spark.createDataFrame([("chr1", 5, 25)], "ref string, f_start long, f_end long")
    assert iv.interval_join(rows, features).count() == 2


@pytest.mark.parametrize("name", ["a7_feature_summary", "e7_interval_patterns"])
def test_dealt_out_rows_are_the_same(spark, small_shares, name):
    from oracle import connection, difference

    frame = relational_queries()[name](spark, SF_DIR)
    assert parts_of(frame) > 0
    assert not difference(frame, connection(SF_DIR), relational_sql()[name])


def test_smoothed_levels_are_the_same(spark, monkeypatch):
    from cytolake.operators import smoothing as sm
    from cytolake.plans.fixtures import sites

    def levels() -> tuple[int, list]:
        frame = sm.local_levels(sites(spark, SF_DIR), 20, 1000)
        return parts_of(frame), sorted((r["sample"], r["ref"], r["start_pos"], r["smoothed"]) for r in frame.collect())

    whole = levels()
    monkeypatch.setattr(tables.dealt_out, "__kwdefaults__", {"share": 8 << 10})
    dealt = levels()
    assert whole[0] == 0 and dealt[0] == 2  # rows that are numbered, and chunks
    assert whole[1] == dealt[1]
