"""A sample of registered queries against their DuckDB oracle at sf 0.001 (the driver checks all of
them at sf 0.01 with ``scripts/check_oracle.py``)."""

import math

import duckdb
import pytest

from chronoframe.plans.catalog import TABLES, load_all
from conftest import SF_SMALL

SAMPLE = ["ts_samples", "ffill", "resample_dense", "chrono_split", "describe", "histogram", "kfold", "stratified_split",
          "roc_auc", "corr_three", "ens_rank", "ens_vote_weighted", "knn", "mixup", "impute_median", "label_index",
          "csv_roundtrip", "path_parts", "trial_table", "bootstrap", "tree_nodes", "gbt_nodes", "gbt_scores", "tree_importances", "ridge_search",
          "bias_variance_refit", "bootstrap_tree", "samples_batches", "one_hot_wide", "stages_saved"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(recs, cols):
    return sorted((tuple(_norm(r[c]) for c in cols) for r in recs), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    q = load_all()[name]
    df = q.build(spark, SF_SMALL)
    cols = sorted(df.columns)
    got = _rows([r.asDict() for r in df.collect()], cols)
    res = con.execute(q.sql)
    dcols = [d[0] for d in res.description]
    assert sorted(dcols) == cols
    want = _rows([dict(zip(dcols, r)) for r in res.fetchall()], cols)
    assert got == want


def test_every_query_has_a_unique_name_and_builder():
    cat = load_all()
    assert len(cat) > 150
    assert all(callable(q.build) for q in cat.values())
