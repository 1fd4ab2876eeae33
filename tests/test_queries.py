"""Every query of the core against its SQL over the smallest tables; those without SQL must give rows of a stable schema."""

from __future__ import annotations

import pytest
from compare import differences

from tideglass.plans.catalogue import ORACLE, QUERIES

#: Sources without a time that lacks a zone are in the SQL but not in the estimate; the smallest tables have such sources.
PARTIAL = {"p4_zones"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - PARTIAL))
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    if name in ORACLE:
        assert differences(df, ORACLE[name], small) == ""
    else:
        rows = df.collect()
        assert len(df.columns) == len(set(df.columns)) and isinstance(rows, list)


def test_entry(spark, small):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_columns_of_found_queries(spark, small):
    kinds = {n: QUERIES[n](spark, small).dtypes for n in QUERIES if n.endswith("_found")}
    assert kinds == {
        "p1_found": [("symbol", "string"), ("period_start", "bigint")],
        "p2_found": [("tick_id", "bigint")],
        "p3_found": [("tick_id", "bigint"), ("outcome", "string")],
        "p4_found": [("src", "string"), ("row_key", "string"), ("normal_form", "string")],
        "p5_found": [("symbol", "string"), ("day_utc", "string")],
        "p7_found": [("source_file", "string"), ("child_kind", "string"), ("child_pos", "int")],
    }
