"""Registered queries against their SQL, and the entry point without the training-data operators."""

import subprocess
import sys
import textwrap

import duckdb
import pytest

from skein.plans import queries

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, sf, db, name):
    got, want = queries.queries()[name](spark, sf).toPandas(), db.sql(queries.oracle_sql()[name]).df()
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a, b = (x[columns].astype(str).sort_values(columns).reset_index(drop=True) for x in (got, want))
    assert a.equals(b)


@pytest.mark.parametrize("name", ["note_records", "detail_fields", "normalize_labels"])
def test_payload_fields_are_read_once(spark, sf, name):
    """The optimizer doesn't copy a field's reading into all that is built on it."""
    plan = queries.queries()[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("variant_get") <= 60 and len(plan) < 60_000


def test_danmaku_query(spark, sf):
    lines = sum(1 for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for x in (r.text or "").split("\n") if x.strip())
    assert queries.danmaku_xml(spark, sf).count() == lines


def test_entry_without_training_data_operators():
    code = """
        import sys

        class Gone:
            def find_spec(self, name, path=None, target=None):
                if name == "corpus_pipeline" or name.startswith("skein.llm"):
                    raise ModuleNotFoundError(f"No module named {name!r}", name=name)

        sys.meta_path.insert(0, Gone())
        import __spark_entry__ as e
        assert len(e.queries()) == 68 and "pipeline" not in e.queries() and not any(q.startswith("op") for q in e.queries())
        assert set(e.oracle_sql()) == set(e.queries())
    """
    subprocess.run([sys.executable, "-c", textwrap.dedent(code)], check=True, timeout=120)
