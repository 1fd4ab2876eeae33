from __future__ import annotations

import duckdb
from compare import differences
from pyspark.sql import functions as F

from tideglass.operators import filings as fl
from tideglass.operators import transcripts as tr
from tideglass.plans.filings import ORACLE, QUERIES
from tideglass.sources.market import cik_map, json_lines, previous_quarter

PAGE = """<html><table><tr><td>outer<table><tr><td>1. Name and Address of Reporting Person</td></tr><tr><td>DOE&nbsp;JANE</td></tr></table></td></tr></table>
<table><tr><td><b>Table I - Non-Derivative Securities Acquired</b></td></tr><tr><td>Common</td><td>100</td></tr></table>
<table><tr><td><b>Table II - Derivative Securities</b></td></tr></table><table><tr><td><b>Explanation of Responses:</b></td></tr><tr><td>1. None &amp; none</td></tr></table>
<table><tr><td>/s/ Jane</td></tr><tr><td>** Signature of Reporting Person</td></tr></table></html>"""


def test_sections():
    parts = fl.section_text(PAGE).split("\n\n")
    assert parts[0] == "--- FILING METADATA ---\n1. Name and Address of Reporting Person\nDOE JANE"
    assert [p.split("\n")[0] for p in parts[1:]] == ["Table I - Non-Derivative Securities Acquired", "Table II - Derivative Securities", "Explanation of Responses:", "--- SIGNATURES ---"]
    assert "1. None & none" in parts[3] and fl.section_text("<p>nothing</p>") is None and fl.section_text(None) is None and fl.section_text("") is None


def test_market_value_published(spark):
    rows = [(3500, 254.83, "S"), (8100, 255.96, "S"), (13974, 256.6, "S"), (21551, 257.54, "S"), (1, 9.0, "M"), (2, 9.0, "F"), (None, 1.0, "P"), (5, None, "P")]
    df = spark.createDataFrame([([{"shares_traded": a, "price_per_share": b, "transaction_code": c} for a, b, c in rows],)], "t array<struct<shares_traded:bigint,price_per_share:double,transaction_code:string>>")
    assert df.select(fl.market_value(F.col("t")).alias("v")).first().v == 12101153.94


def test_validity(spark):
    good = "FORM 4 Statement of changes in beneficial ownership Table I - Non-Derivative Securities Name and Address of Reporting Person Relationship of Reporting Person Transaction Code"
    cases = {good: None, good + " Annual Meeting": "excluded", good.replace("FORM 4", ""): "no title", good.replace("Table I", ""): "no table", good.replace("Transaction Code", ""): "structure", "": "no title"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r.t: r.p for r in df.select("t", fl.form4_problem(F.col("t")).alias("p")).collect()} == cases


INSTANCE = """<x xmlns="http://www.xbrl.org/2003/instance" xmlns:us="http://us" xmlns:xbrldi="http://xbrl.org/2006/xbrldi" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
<context id="c1"><entity><identifier>9</identifier><segment><xbrldi:explicitMember dimension="us:Axis">us:M</xbrldi:explicitMember></segment></entity><period><startDate>2025-01-01</startDate><endDate>2025-03-31</endDate></period></context>
<unit id="u"><measure>iso4217:USD</measure></unit><us:NetIncomeLoss contextRef="c1" unitRef="u" decimals="-6">1,500</us:NetIncomeLoss><us:Note contextRef="c2">text</us:Note><us:Gone contextRef="c1" xsi:nil="true"/></x>"""
INLINE = """<h xmlns:ix="http://www.xbrl.org/2013/inlineXBRL" xmlns:dei="http://dei"><ix:nonFraction name="us:Assets" contextRef="c">$1,200</ix:nonFraction><ix:nonNumeric name="dei:Name" contextRef="c">A $ B</ix:nonNumeric><dei:Other contextRef="c">5</dei:Other></h>"""


def test_xbrl(spark):
    t = fl.xbrl_tables(spark.createDataFrame([("f", INSTANCE), ("g", INLINE), ("h", "<broken"), ("i", None)], "filingId string, xml string"), "filingId", "xml")
    facts = {(r.filingId, r.name): r for r in t["facts"].collect()}
    net = facts["f", "us:NetIncomeLoss"]
    assert (net.value_num, net.label, net.period.end, net.dimensions) == (1500.0, "Net Income Loss", "2025-03-31", {"Axis": "us:M"})
    assert facts["f", "us:Note"].value_str == "text" and facts["f", "us:Note"].period is None and facts["f", "us:Gone"].isNil
    assert facts["g", "us:Assets"].value_num == 1200.0 and facts["g", "dei:Name"].value_str == "A  B" and len(facts) == 5
    assert [r.type for r in t["units"].collect()] == ["monetary"]


def test_xbrl_facts_by_document(spark, tmp_path):
    """Two instances under one key keep their own periods and units; documents are read once, without a shuffle or a join."""
    duckdb.sql("SELECT * FROM (VALUES (1, 1.5::DOUBLE, TIMESTAMP '2025-01-01'), (1, 2.5, TIMESTAMP '2025-02-01'), (9007199254740993, 3.5, TIMESTAMP '2025-03-01')) AS t(o_orderkey, o_totalprice, o_orderdate)").write_parquet(str(tmp_path / "orders.parquet"))
    got = QUERIES["xbrl_explode"](spark, str(tmp_path))
    assert not differences(got, ORACLE["xbrl_explode"], str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1
    no_unit = INSTANCE.replace('<unit id="u">', '<unit id="w">')
    facts = fl.xbrl_tables(spark.createDataFrame([("f", INSTANCE), ("g", no_unit)], "filingId string, xml string"), "filingId", "xml")["facts"]
    assert {(r.filingId, r.unit_type) for r in facts.where("name = 'us:NetIncomeLoss'").collect()} == {("f", "monetary"), ("g", None)}


def test_upsert_and_checkpoint(spark):
    old = spark.createDataFrame([("a", 1, 1), ("b", 1, 1)], "k string, v int, t int")
    new = spark.createDataFrame([("b", 2, 0), ("b", 3, 5), ("c", 4, None)], "k string, v int, t int")
    assert {(r.k, r.v) for r in fl.upsert(old, new, ["k"], "t").collect()} == {("a", 1), ("b", 3), ("c", 4)}
    rows = spark.createDataFrame([("A", " 4 ", f"00{i}", f"2025-01-0{i}") for i in range(1, 9)] + [("A", "4/A", "009", "2025-02-01"), ("B", "4", "001", "2025-01-01")], "ticker string, form string, accession string, filing_date string")
    mark = spark.createDataFrame([("A", "002")], "ticker string, last_accession string")
    got = {(r.ticker, r.accession) for r in fl.new_filings(rows, mark).collect()}
    assert got == {("A", f"00{i}") for i in range(4, 9)} | {("B", "001")}


def test_first_object(spark):
    df = spark.createDataFrame([('```json\n{"a": {"b": "}"}} tail {"c":1}\n```',), ("none",), (None,), ("{broken",)], "t string")
    assert [r.x for r in df.select(fl.first_object(F.col("t")).alias("x")).collect()] == ['{"a": {"b": "}"}}', None, None, None]


def test_cik_map_shapes(spark):
    df = spark.createDataFrame([('{"fields":["cik","name","ticker"],"data":[[320193,"Apple","aapl"]]}',), ('[{"ticker":"msft","cik":"789019"},["nvda","1045810"]]',), ('{"0":{"cik_str":1018724,"ticker":"AMZN","title":"x"}}',), ("oops",), (None,)], "t string")
    assert {(r.ticker, r.cik) for r in cik_map(df, "t").collect()} == {("AAPL", "0000320193"), ("MSFT", "0000789019"), ("NVDA", "0001045810"), ("AMZN", "0001018724")}


def test_quarantine_and_quarter(spark):
    good, bad = json_lines(spark.createDataFrame([('{"a": 1}',), ("{",), (None,)], "t string"), "t", "a INT")
    assert [r.a for r in good.collect()] == [1] and bad.count() == 2
    day = spark.createDataFrame([("2025-02-10",)], "d string").select(previous_quarter(F.to_date("d")).alias("q")).first().q
    assert (day.year, day.quarter) == (2024, 4)


def test_splitter_and_merge():
    text = "One sentence here. Another one, a bit longer than fifty characters in all. " * 5
    pieces = tr.split_text(text)
    assert max(map(len, pieces)) <= 50 and "".join("".join(pieces).split()) == "".join(text.split())
    chunks = tr.merge_pieces(text)
    assert " ".join(chunks).split() == " ".join(pieces).split() and len(chunks) > 1
    assert tr.merge_pieces("short") == ["short"] and tr.split_text("x" * 120) == ["x" * 50, "x" * 50, "x" * 20]
    assert tr.merge_pieces(text, oracle=lambda p, a, b: [10_000]) and tr.merge_pieces(text, oracle=lambda p, a, b: [])


def test_chunks_null_and_long(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "  "), (4, "word " * 40_000)], "doc_id bigint, text string")
    out = tr.chunk_documents(df, "doc_id", "text").groupBy("doc_id").agg(F.count("chunk").alias("n"), F.max("chunk_index").alias("m")).collect()
    assert len(out) == 1 and out[0].doc_id == 4 and out[0].n == out[0].m


def test_split_ids(spark):
    df = spark.createDataFrame([("ok\nSplit_After: 3, 5 and 9\nsplit_after: 1",), ("none",), (None,)], "t string")
    assert [list(r.x) for r in df.select(tr.split_ids(F.col("t")).alias("x")).collect()] == [[3, 5, 9], [], []]


def test_nearest_vectors_in_small_blocks(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    v = rng.normal(size=(60, 8))
    v[7] = v[3]
    data = [(i, [float(x) for x in row]) for i, row in enumerate(v)] + [(100, None), (101, []), (102, [0.0] * 8), (103, [1.0, 2.0])]
    df = spark.createDataFrame(data, "vec_id bigint, embedding array<double>")
    q = df.where("vec_id % 3 = 0").selectExpr("vec_id AS query_id", "embedding")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in tr.nearest_vectors(df, q, 4, 16, 5).collect()}
    unit = v / np.linalg.norm(v, axis=1, keepdims=True)
    for i in range(0, 60, 3):
        s = unit @ unit[i]
        best = sorted((j for j in range(60) if j != i), key=lambda j: (-round(s[j], 12), j))[:4]
        assert [got[i, k + 1][0] for k in range(4)] == best
    assert all(k[0] < 60 for k in got)


def test_records_of_a_page(spark):
    html = """<table><tr><th><b>Table I - Non-Derivative Securities Acquired, Disposed of, or Beneficially Owned</b></th></tr>
<tr><th>1. Title of Security</th><th>2. Transaction Date (Month/Day/Year)</th><th>2A.</th><th>3.</th><th></th><th>4.</th><th></th><th></th><th>5.</th><th>6.</th><th>7.</th></tr>
<tr><td>Common Stock<sup>(3)</sup></td><td>10/01/2025</td><td></td><td>F</td><td></td><td>45,278</td><td>D</td><td>$255.45<sup>(5)</sup></td><td>226,283</td><td>D</td><td></td></tr>
<tr><td>Common Stock</td><td>10/01/2025</td><td></td><td>M</td><td></td><td>92,403</td><td>A</td><td><sup>(1)(2)</sup></td><td>271,561</td><td>D</td><td></td></tr></table>
<table><tr><th><b>Table II - Derivative Securities</b></th></tr>
<tr><td>Restricted Stock Unit</td><td>(1)(2)</td><td>10/01/2025</td><td></td><td>M</td><td></td><td></td><td>92,403</td><td>(9)</td><td>(9)</td><td>Common Stock</td><td>92,403</td><td></td><td>0</td><td>D</td><td></td></tr></table>
<table><tr><td><b>Explanation of Responses:</b></td></tr><tr><td>1. Each unit is one share.</td></tr><tr><td>4. Made pursuant to a Rule 10b5-1 plan.</td></tr></table>"""
    rows = {r.k: r for r in fl.form4_records(spark.createDataFrame([(1, html), (2, None), (3, ""), (4, "<p>no table")], "k int, html string"), "k", "html").collect()}
    r = rows[1]
    assert [(t.security_title, t.transaction_date, t.transaction_code, t.shares_traded, t.acquisition_or_disposition, t.price_per_share, t.shares_owned_after) for t in r.transactions] == [
        ("Common Stock", "10/01/2025", "F", 45278, "D", 255.45, 226283), ("Common Stock", "10/01/2025", "M", 92403, "A", None, 271561)]
    d = r.derivative_transactions[0]
    assert (d.title, d.conversion_price, d.acquired, d.disposed, d.date_exercisable, d.underlying_amount, d.beneficially_owned_after, d.ownership_form) == ("Restricted Stock Unit", None, None, 92403, None, 92403, 0, "D")
    assert r.footnotes == ["Each unit is one share.", "Made pursuant to a Rule 10b5-1 plan."]
    assert rows[2].transactions is None and rows[3].transactions is None and rows[4].transactions == []


def test_first_object(spark):
    texts = ["```json\n{\"a\": \"}{\\\"\", \"b\": {\"c\": 1}}\n``` and {\"d\": 2}", "no object", "{broken", "{bad}", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").orderBy("i").select(fl.first_object(F.col("t"))).collect()]
    assert got == ['{"a": "}{\\"", "b": {"c": 1}}', None, None, None, None]
