"""Every registered query with an oracle against DuckDB on the smallest
tables (the same row-count / column / value-hash comparison the driver makes
at sf0.01, which ``scripts/check_oracle.py`` runs)."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as E
from scripts.check_oracle import digest, rows_of
from tessera.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
SUBSET = sorted(E.oracle_sql())  # every query that has an oracle

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    sdf = E.queries()[name](spark, SF)
    srows, scols = rows_of(sdf.columns, [tuple(r) for r in sdf.collect()])
    res = con.execute(E.oracle_sql()[name])
    drows, dcols = rows_of([d[0] for d in res.description], res.fetchall())
    assert scols == dcols
    assert len(srows) == len(drows)
    assert digest(srows) == digest(drows)


def test_every_query_has_a_builder_and_most_have_an_oracle():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # the training-data queries (opN_..., pipeline) are tested on their own
    rows_only = {n for n in set(qs) - set(sql) if not re.match(r"op\d+_|pipeline$", n)}
    assert rows_only <= {"rf_logloss", "rf_probabilities", "dt_predict", "gbt_binary", "gbt_multiclass",
                         "cv_first_fold"}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "guid" in df.columns


def test_streaming_query_leaves_session_settings(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    E.queries()["tumbling_word_count_3s"](spark, SF).count()
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
