"""Every query of the library's own operators against its SQL, or for rows alone where SQL can't express it."""

import pytest
from oracle import connection, difference

from cytolake.queries import relational_queries, relational_sql

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(relational_queries()))
def test_query(spark, tables, name):
    frame = relational_queries()[name](spark, SF_DIR)
    if name in relational_sql():
        assert not difference(frame, tables, relational_sql()[name])
    else:
        # values of these are tested by kernel (test_kernels.py); here: rows, once each, without nulls in their keys
        rows = frame.collect()
        keys = [c for c in frame.columns if c in ("ref", "start_pos", "w_start", "pattern", "sample", "component", "cluster", "id", "g1", "g2", "s1", "s2", "set_name")]
        assert rows and len({tuple(r[k] for k in keys) for r in rows}) == (len(rows) if name != "m5_medoids" else len({r["id"] for r in rows}))
        assert all(r[k] is not None for r in rows for k in keys if (name, k) not in (("t17_report", "g1"), ("t17_report", "g2")))  # sites without a pair of groups have a row too


def test_every_sql_has_a_query():
    assert set(relational_sql()) <= set(relational_queries())


def test_entry_without_the_corpus_operators(tmp_path):
    """The library imports, lists and runs its own queries where the corpus operators are deleted."""
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).parent.parent
    shutil.copytree(root / "cytolake", tmp_path / "cytolake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 100 and not any(k.startswith('op') for k in q) and 'pipeline' not in q and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": str(tmp_path)})
