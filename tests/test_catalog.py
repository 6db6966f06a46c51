"""Registered queries next to their SQL on the smallest tables (tools/check_oracles.py runs all of them)."""

from __future__ import annotations

import glob
import importlib.util
import os
import re

import duckdb
import pytest

from riskspark.catalog import oracles, queries

SF = "/root/testdata/sf0.001"
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
CHECKED = (
    "io02_column_contract", "cl01_dedup_keep_first", "cl04_impute_medians", "cl07_cleaning_log", "sp01_stratified_split",
    "jn01_card_mean_lookup", "jn05_cross_split_overlap", "ag03_category_median", "ag08_cardinality", "ag16_label_correlations",
    "wn01_velocity_1h", "wn01b_velocity_hot_cards", "wn04_curve_points", "tk03_top_factors", "tk05_case_studies", "sc12_rule_engine",
    "sc19_behaviour_score", "sc21_fused_score", "sc27_feature_sentences", "ev01_comprehensive_metrics", "ev09_weight_grid",
    "cf03_cost_sweep", "lk01_id_overlap", "jb01_preprocess", "jb03_score", "jb06_explanations",
)


@pytest.fixture(scope="module")
def tool():
    spec = importlib.util.spec_from_file_location("check_oracles", f"{ROOT}/tools/check_oracles.py")
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, tool, duck, name):
    assert tool.difference(queries()[name](spark, SF).toPandas(), duck.execute(oracles()[name]).df()) is None


def test_names_and_sql():
    assert set(oracles()) <= set(queries())
    assert all(re.fullmatch(r"[a-z]{2}\d\d[b-c]?_[a-z0-9_]+", n) for n in queries())
