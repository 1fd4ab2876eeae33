from __future__ import annotations

import pytest
from compare import differences

from tideglass.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    df = QUERIES[name](spark, small)
    if name in ORACLE:
        assert differences(df, ORACLE[name], small) == ""
    else:
        assert df.count() > 0 and len(df.columns) == len(set(df.columns))


def test_columns(spark, small):
    kinds = {n: [(k, t) for k, t in QUERIES[n](spark, small).dtypes] for n in ("p6_found", "p8_ids", "p10_found")}
    assert kinds == {"p6_found": [("news_id", "bigint"), ("tick_id", "bigint")], "p8_ids": [("doc_id", "bigint"), ("ids", "array<int>")], "p10_found": [("doc_id", "bigint")]}
