"""Every registered query against its SQL in DuckDB, on whole tables."""

import duckdb
import pytest

import __spark_entry__ as entry_module
from keylane.plans import QUERIES, SQL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    return None if value is None or value != value else value


#: Queries whose windows are cut into slices on a large table.
SLICED = ("backpressure concurrency_peak dedup_consecutive failure_rate fair_order grouped_messages in_flight monopolization "
          "monopolization_clipped ordering_violations overlap_violations saga_states sequence_per_key stall_gaps timer_accuracy "
          "timer_firings timer_operations timer_pending timer_scheduled virtual_time").split()


def test_sliced_names_are_queries():
    assert set(SLICED) <= set(QUERIES)


@pytest.mark.parametrize("name", SLICED)
def test_matches_sql_in_small_slices(name, spark, sf_dir, duck, monkeypatch):
    monkeypatch.setattr("keylane.operators.ordered.SLICE_ROWS", 100)
    test_matches_sql(name, spark, sf_dir, duck)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(name, spark, sf_dir, duck):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    assert found, "no rows"
    assert name in SQL, "a query without SQL"
    result = duck.execute(SQL[name])
    order = [d[0] for d in result.description]
    assert sorted(order) == columns
    expected = [tuple(plain(r[order.index(c)]) for c in columns) for r in result.fetchall()]
    assert found == sorted(expected, key=repr)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry_without_the_document_operators(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    root = Path(entry_module.__file__).parent
    shutil.copytree(root / "keylane", tmp_path / "keylane", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"],
                          cwd=tmp_path, capture_output=True, text=True, check=True)
    assert said.stdout.split() == [str(len(QUERIES)), str(len(SQL))]
