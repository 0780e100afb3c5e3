"""The driver contract at sf0.001: every registered query runs through
``__spark_entry__`` and, where an oracle exists, matches it in DuckDB."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from charloom.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["documents", "benchmark", "conversations"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for _, r in pdf.iterrows()), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET enable_progress_bar=false")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_registry_shape():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(QUERIES) <= set(q) and len(QUERIES) >= 35
    assert set(QUERIES) <= set(o)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    sql = E.oracle_sql()[name]
    assert _rows(got) == _rows(con.execute(sql).fetchdf())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "n_pred", "mean_loss", "perplexity", "n_unknown"] and df.count() > 0


@pytest.mark.parametrize("layers", [1, 2])
def test_the_compared_models_show_a_broken_recurrence(layers):
    """Losses of the models that SQL follows change beyond the compared digits
    when the recurrent weights are dropped or transposed."""
    import numpy as np

    from charloom.functions import kernels as K
    from charloom.queries import SQL_HIDDEN
    ids = [np.random.default_rng(0).integers(0, 100, 400)]
    p = K.init_params(layers, SQL_HIDDEN, 100, "sine")
    base = K.sequence_losses(p, ids)[0][0] / 399
    for broken in (np.zeros_like(p["Wh"]), p["Wh"].transpose(0, 2, 1)):
        assert abs(K.sequence_losses({**p, "Wh": broken}, ids)[0][0] / 399 - base) > 2e-6
