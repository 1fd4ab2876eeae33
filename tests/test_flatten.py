from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideglass.operators.flatten import analyse, children, filing_tables, inline, read_json, unknown_fields
from tideglass.sources.tables import table


def test_schema_graph(spark):
    s = T._parse_datatype_string("a struct<b:int,c:array<struct<d:string,e:array<array<int>>,c:struct<d:int>>>>, a_b int, k string, tags array<string>")
    got = {t.name: ([path for path, _ in t.places[0].steps], t.columns) for t in analyse(s, "root", "k")}
    assert got["root"][1] == [("a_b", ("a", "b")), ("a_b_2", ("a_b",)), ("k_2", ("k",))]
    assert got["a_c"] == ([("a", "c")], [("d", ("d",)), ("c_d", ("c", "d"))])
    assert got["tags"] == ([("tags",)], [("value", ())])
    assert got["a_c_e"][0] == [("a", "c"), ("e",)] and got["a_c_e_element"][0] == [("a", "c"), ("e",), ()]


def test_children_keep_positions_and_parents(spark):
    df = spark.createDataFrame([(1, {"a": {"c": [{"d": "x", "e": [1, None, 3]}, None, {"d": "y", "e": None}]}}), (2, {"a": None}), (3, None)], "k int, r struct<a:struct<c:array<struct<d:string,e:array<int>>>>>")
    t = inline(df.selectExpr("*", "5 AS position", "6 AS value"), "k", "r", "root")
    assert [tuple(r) for r in t["a_c"].orderBy("position").collect()] == [(1, 0, "x"), (1, 2, "y")]
    assert [tuple(r) for r in t["a_c_e"].orderBy("position").collect()] == [(1, 0, 0, 1), (1, 0, 2, 3)]
    assert t["root"].count() == 3


def test_recursive_elements_share_a_table(spark):
    node = "text:string"
    for _ in range(3):
        node = f"text:string,replies:array<struct<{node}>>"
    leaf = lambda t, *r: {"text": t, "replies": list(r)}
    rows = [(1, leaf("a", leaf("b", leaf("c", {"text": "d"})), None, leaf("e"))), (2, leaf("f")), (3, None)]
    t = inline(spark.createDataFrame(rows, f"k int, r struct<{node}>"), "k", "r", "post")
    assert set(t) == {"post", "replies"}
    got = {(r.k, r.place, tuple(r["at"]), tuple(r.parent) if r.parent is not None else None, r.text) for r in t["replies"].collect()}
    assert got == {(1, "replies", (0,), None, "b"), (1, "replies", (2,), None, "e"), (1, "replies.replies", (0, 0), (0,), "c"), (1, "replies.replies.replies", (0, 0, 0), (0, 0), "d")}


def test_shared_types_and_maps(spark):
    person, address = "struct<name:string,address:struct<city:string,zip:string>>", "struct<city:string,zip:string>"
    schema = f"k int, r struct<owner:{person},office:{address},agents:array<{person}>,tags:map<string,struct<n:int>>,counts:map<string,int>>"
    who = lambda n, c: {"name": n, "address": {"city": c, "zip": None}}
    rows = [(1, {"owner": who("o", "A"), "office": {"city": "B", "zip": "9"}, "agents": [None, who("p", "C")], "tags": {"x": {"n": 1}}, "counts": {"y": 2}}), (2, None)]
    df = spark.createDataFrame(rows, schema)
    t = inline(df, "k", "r", "root", shared=True)
    assert {(r.place, tuple(r["at"]), r.name) for r in t["owner"].collect()} == {("owner", (), "o"), ("agents", (1,), "p")}
    assert {(r.place, tuple(r["at"]), r.city) for r in t["address"].collect()} == {("owner.address", (), "A"), ("office", (), "B"), ("agents.address", (1,), "C")}
    assert [tuple(r) for r in t["tags"].select("key", "value_n").collect()] == [("x", 1)] and [tuple(r) for r in t["counts"].select("k", "key", "value").collect()] == [(1, "y", 2)]
    plain = inline(df, "k", "r", "root")
    assert "owner_address_city" in plain["root"].columns and "address_city" in plain["agents"].columns and plain["root"].count() == 2


def test_unknown_fields_are_kept_aside(spark):
    kind = T._parse_datatype_string("a struct<b:int>, xs array<struct<n:int>>")
    texts = [(1, json.dumps({"a": {"b": 1, "c": {"d": 2}}, "xs": [{"n": 1}, None, {"n": 2, "m": "q"}], "z": [1]})), (2, json.dumps({"xs": {"m": 1}})), (3, None), (4, "no json"), (5, "[1]")]
    df = spark.createDataFrame(texts, "id int, payload string")
    got = {tuple(r) for r in unknown_fields(df, F.col("id"), "payload", kind).collect()}
    assert got == {(1, "$", "z", "[1]"), (1, "$.a", "c", '{"d":2}'), (1, "$.xs[2]", "m", '"q"'), (2, "$.xs[0]", "m", "1")}


def test_json_variants(spark, small):
    form4 = table(spark, small, "form4")
    base = {"filing_metadata": {"source_file": "x.html"}, "reporting_person": {"name": None, "address": {"city": "C"}}, "transactions": {"shares_traded": "10,555", "price_per_share": "89.08", "transaction_date": "2025-10-01", "new": [1]}, "derivative_transactions": [None, {"title": "T", "acquired": "12.0"}], "extra": 1}
    payloads = [json.dumps(base), json.dumps(base), json.dumps(base)[:50], "<html>", "", None, "[]", "1", json.dumps({"filing_metadata": {"source_file": "y.html"}, "transactions": []}), json.dumps({"transactions": [{}]})]
    raw = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "raw_id bigint, payload string")
    read = read_json(raw, "payload", T.StructType(form4.schema.fields)).where(F.col("record").isNotNull())
    assert {r.raw_id for r in read.collect()} == {0, 1, 8, 9}
    t = filing_tables(form4.limit(0), raw)
    got = {tuple(r) for r in children(t).collect()}
    assert got == {("x.html", "reporting_person", 0), ("x.html", "address", 0), ("x.html", "transactions", 0), ("x.html", "derivative_transactions", 1)}
    x = t["transactions"].first()
    assert (x.shares_traded, x.price_per_share, x.transaction_date) == (10555, 89.08, "2025-10-01")
    assert t["derivative_transactions"].first().acquired == 12
    assert children(filing_tables(form4.limit(0), raw.limit(0))).collect() == []
