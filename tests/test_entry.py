"""Driver contract: entry smoke run, query / SQL keys, DuckDB oracle on sf0.001."""

import importlib.util
import math
import os
import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from helpers import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def _entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


se = _entry_module()


def test_entry_smoke(spark):
    df = se.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 100
    assert df.columns == ["antecedent", "consequent", "ant_support", "cons_support", "support", "confidence", "lift"]


def test_sql_keys_are_queries():
    assert set(se.oracle_sql()) <= set(se.queries())
    own = {q for q in se.queries() if not re.match(r"op\d+_|pipeline$", q)}  # the text operators have tests of their own
    assert own <= set(se.oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES.split():
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _norm(v):
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if v is pd.NA or (isinstance(v, float) and math.isnan(v)):  # missing numbers, as either side's frames show them
        return "NaN"
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(se.oracle_sql()))
def test_oracle(spark, con, name):
    got = se.queries()[name](spark, SF_SMALL).toPandas()
    exp = con.sql(se.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _rows(got) == _rows(exp)
