"""Driver contract: entry() runs, every query has an oracle, and all agree at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from clickweave.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["events", "documents", "labels"]


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["userid", "pos", "neg1", "neg2", "neg3", "n_negs", "r"]
    assert df.count() >= 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(QUERIES) <= set(E.queries())
    assert len(QUERIES) >= 39


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver data")
def test_all_queries_match_oracles(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    bad = []
    for k, q in QUERIES.items():
        df = q(spark, SF)
        res = con.execute(E.oracle_sql()[k])
        dcols = [d[0] for d in res.description]
        if sorted(df.columns) != sorted(dcols) or _rows(df.columns, df.collect()) != _rows(dcols, res.fetchall()):
            bad.append(k)
    assert not bad


TIME_KEYS = ["event_weights", "user_stats", "qualified_users", "doc_labels", "train_rows", "fn_time"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no driver data")
def test_time_queries_do_not_depend_on_session_zone(spark):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        bad = []
        for k in TIME_KEYS:
            df = E.queries()[k](spark, SF)
            res = con.execute(E.oracle_sql()[k])
            dcols = [d[0] for d in res.description]
            if _rows(df.columns, df.collect()) != _rows(dcols, res.fetchall()):
                bad.append(k)
        assert not bad
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
