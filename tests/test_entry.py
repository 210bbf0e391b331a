import importlib.util
import os
import subprocess
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"


def load():
    spec = importlib.util.spec_from_file_location("entry", f"{ROOT}/__spark_entry__.py")
    module = importlib.util.module_from_spec(spec)
    sys.path.insert(0, ROOT)
    spec.loader.exec_module(module)
    return module


def test_names_are_read_without_a_session():
    said = subprocess.run([sys.executable, "-c", "import __spark_entry__ as e; print(len(e.queries()), set(e.oracle_sql()) <= set(e.queries()))"], cwd=ROOT, capture_output=True, text=True)
    assert said.stdout.split()[1] == "True" and int(said.stdout.split()[0]) > 90


def test_entry(spark):
    assert load().entry(spark).count() > 0


@pytest.mark.parametrize("name", ["p3_found", "p4_found", "program_capture", "annotate_multi", "count_pixels", "bedgraph_n_cis", "dedup_stats", "digest_sequence"])
def test_queries_match_their_sql(spark, name):
    entry = load()
    df = entry.queries()[name](spark, DATA)
    con = duckdb.connect()
    con.sql("SET enable_progress_bar = false")
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{DATA}/{f}'")
    columns = sorted(df.columns)
    want = con.sql(entry.oracle_sql()[name])
    at = [want.columns.index(c) for c in columns]
    rows = sorted(repr([r[i] for i in at]) for r in want.fetchall())
    assert sorted(repr([r[c] for c in columns]) for r in df.collect()) == rows
