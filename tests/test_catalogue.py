"""Queries against their SQL on the smallest tables, and the entry module."""

import decimal
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from threadloom.plans import catalogue

CHEAP = [n for n in catalogue.ORACLES if n in ("p2_found", "p7_found", "q01_thread_manifest", "q04_corpus_summary", "q06_dedupe_submissions", "q09_passages", "q13_quote_candidates", "q15_state_scores", "q22_matched_terms", "q25_evidence_status", "q27_evidence_walk", "q28_packs", "q36_variant_props")]


def cell(v):
    return None if v is None or v != v else f"{float(v):.6f}" if isinstance(v, (float, decimal.Decimal)) else str(v)


@pytest.mark.parametrize("name", CHEAP)
def test_against_sql(spark, small, name):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for f in os.listdir(small):
        con.execute(f"create view {f.split('.')[0]} as select * from '{small}/{f}'")
    df = catalogue.QUERIES[name](spark, small)
    cur = con.execute(catalogue.ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(columns) == sorted(df.columns)
    mine = sorted(tuple(str(cell(r[c])) for c in columns) for r in df.collect())
    assert mine == sorted(tuple(str(cell(v)) for v in row) for row in cur.fetchall())


def test_descendants_against_sql(spark, small):
    test_against_sql(spark, small, "p7_members")


def test_every_query_has_a_plan(spark, small):
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert entry_module.entry(spark).columns
