"""Queries over news, filings, facts and transcripts, and their SQL.

Facts in the driver's tables are line items: the part's type is the concept, the price the value, the ship date the period's end and
the supplier the ticker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideglass.functions import scalars as f
from tideglass.operators import filings as fl
from tideglass.operators import flatten
from tideglass.operators import transcripts as tr
from tideglass.operators.ticks import one_per_id
from tideglass.plans.registry import registry
from tideglass.plans.time_sql import BOTH
from tideglass.sources.market import previous_quarter as previous
from tideglass.sources.tables import table

c = F.col
QUERIES, ORACLE, query = registry()



NEWS = "WITH n AS (SELECT *, nullif(upper(trim(symbol)), '') AS sym FROM news QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY time) = 1)"


def _news(spark, folder) -> DataFrame:
    n = one_per_id(table(spark, folder, "news"), "news_id", c("time"))
    text = F.upper(F.trim("symbol"))
    return n.withColumn("sym", F.when(text != "", text))


@query(f"{NEWS} SELECT news_id, sym AS symbol, title, published_at FROM n WHERE regexp_full_match(published_at, '[0-9-]{{10}}T[0-9:.]{{15}}Z') ORDER BY published_at DESC, news_id LIMIT 50")
def news_latest(spark, folder):
    n = _news(spark, folder).where(c("published_at").rlike(r"^[0-9-]{10}T[0-9:.]{15}Z\z"))
    return n.orderBy(F.desc("published_at"), "news_id").limit(50).select("news_id", c("sym").alias("symbol"), "title", "published_at")


@query(f"{NEWS} SELECT news_id, sym AS symbol, title, published_at FROM n WHERE sym = 'WIFUQ' AND regexp_full_match(published_at, '[0-9-]{{10}}T[0-9:.]{{15}}Z') ORDER BY published_at DESC, news_id LIMIT 20")
def news_by_symbol(spark, folder):
    n = _news(spark, folder).where((c("sym") == F.upper(F.lit("wifuq"))) & c("published_at").rlike(r"^[0-9-]{10}T[0-9:.]{15}Z\z"))
    return n.orderBy(F.desc("published_at"), "news_id").limit(20).select("news_id", c("sym").alias("symbol"), "title", "published_at")


@query(f"{NEWS} SELECT sym AS symbol, count(*) AS count, max(published_at) AS latest FROM n WHERE sym IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def news_stats(spark, folder):
    n = _news(spark, folder).where(c("sym").isNotNull())
    return n.groupBy(c("sym").alias("symbol")).agg(F.count(F.lit(1)).alias("count"), F.max("published_at").alias("latest")).orderBy(F.desc("count"), "symbol").limit(20)


@query(f"{NEWS} SELECT source, count(*) AS count FROM n WHERE source IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def news_sources_top(spark, folder):
    n = _news(spark, folder).where(c("source").isNotNull())
    return n.groupBy("source").agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), "source").limit(10)


@query(f"{NEWS} SELECT news_id, title FROM n WHERE regexp_matches(coalesce(title, ''), '(?i)energy|regulator') OR regexp_matches(coalesce(description, ''), '(?i)energy|regulator') ORDER BY news_id DESC LIMIT 20")
def news_search(spark, folder):
    hit = lambda x: F.coalesce(c(x), F.lit("")).rlike("(?i)energy|regulator")
    return _news(spark, folder).where(hit("title") | hit("description")).orderBy(F.desc("news_id")).limit(20).select("news_id", "title")


@query(f"{NEWS} SELECT news_id, 'news-' || CASE WHEN lower(coalesce(category, '')) LIKE '%stock%' OR lower(category) = 'general' THEN 'stocks' WHEN lower(category) LIKE '%crypto%' THEN 'crypto' WHEN lower(category) LIKE '%commodit%' THEN 'commodities' WHEN lower(category) LIKE '%forex%' THEN 'forex' ELSE 'stocks' END AS topic, CAST(md5_number(sym) % 3 AS INTEGER) AS partition_id FROM n")
def route_topic(spark, folder):
    return _news(spark, folder).select("news_id", f.topic_of(c("category")).alias("topic"), f.md5_partition(c("sym"), 3).alias("partition_id"))


FORM4 = f"WITH {BOTH}"


def _form4(spark, folder) -> DataFrame:
    """Every filing that can be read, of both tables, once."""
    return flatten.filings(table(spark, folder, "form4"), table(spark, folder, "form4_raw")).select("source_file", "record.*")


_VALUE = "(SELECT round(coalesce(sum(t.shares_traded * t.price_per_share), 0), 2) FROM (SELECT unnest(transactions) AS t) WHERE t.transaction_code IN ('S', 'P'))"


@query(f"{FORM4} SELECT source_file, {_VALUE} AS total_value FROM f")
def form4_total_value(spark, folder):
    return _form4(spark, folder).select("source_file", F.coalesce(fl.market_value(c("transactions")), F.lit(0.0)).alias("total_value"))


@query(f"{FORM4} SELECT source_file, coalesce(len(list_filter(footnotes, lambda x: contains(lower(x), '10b5'))) > 0, false) AS mentions_plan FROM f")
def form4_10b5_flag(spark, folder):
    return _form4(spark, folder).select("source_file", fl.mentions_plan(c("footnotes")).alias("mentions_plan"))


@query(f"""{FORM4}, t AS (SELECT source_file, coalesce(len(list_filter(footnotes, lambda x: contains(lower(x), '10b5'))) > 0, false) AS plan, generate_subscripts(transactions, 1) - 1 AS position, unnest(transactions) AS t FROM f WHERE len(transactions) > 0)
SELECT source_file, CAST(position AS INTEGER) AS position, CASE WHEN regexp_full_match(t.transaction_date, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') AND try_strptime(t.transaction_date, '%m/%d/%Y') IS NOT NULL THEN strftime(try_strptime(t.transaction_date, '%m/%d/%Y'), '%Y-%m-%d') ELSE t.transaction_date END AS transaction_date,
  CASE WHEN plan THEN t.transaction_code IN ('S', 'P') ELSE t.rule_10b5_1_plan END AS rule_10b5_1_plan FROM t WHERE t IS NOT NULL""")
def form4_clean(spark, folder):
    rows = fl.clean_record(_form4(spark, folder)).select("source_file", F.posexplode("transactions").alias("position", "t")).where(c("t").isNotNull())
    return rows.select("source_file", "position", "t.transaction_date", "t.rule_10b5_1_plan")


@query(f"{FORM4} SELECT upper(ticker_symbol) AS ticker, lpad(cik, 10, '0') AS cik, '4' AS doc_type, regexp_replace(source_file, '\\.html$', '') AS doc_id, filing_metadata.earliest_transaction_date AS date, filing_metadata.filing_date AS filing_date, source_file, upper(person) AS reporting_person, coalesce(filing_metadata.is_amendment, false) AS is_amendment, {_VALUE} AS total_transaction_value, CAST(coalesce(len(transactions), 0) AS INTEGER) AS num_transactions FROM f")
def filing_metadata(spark, folder):
    return fl.metadata_rows(_form4(spark, folder))


_PAGES = """WITH p AS (SELECT doc_id, CASE WHEN source = 'form4_text' THEN 'FORM 4 Statement of Changes in Beneficial Ownership Table I - Non-Derivative Securities name and address of reporting person relationship of reporting person transaction code ' ELSE '' END || text AS page, lower(page) AS low FROM documents)"""
_PAGE = "FORM 4 Statement of Changes in Beneficial Ownership Table I - Non-Derivative Securities name and address of reporting person relationship of reporting person transaction code "


@query(
    _PAGES
    + f""" SELECT doc_id, CASE WHEN page IS NULL THEN 'missing' WHEN {" OR ".join(f"contains(low, '{w}')" for w in fl.EXCLUDED_WORDS)} THEN 'excluded' WHEN NOT ({" AND ".join(f"contains(low, '{w}')" for w in fl.REQUIRED_WORDS)}) THEN 'no title'
WHEN NOT ({" OR ".join(f"contains(low, '{w}')" for w in fl.TABLE_WORDS)}) THEN 'no table' WHEN {" + ".join(f"regexp_matches(low, '{p}')::INT" for p in fl.STRUCTURE)} < 3 THEN 'structure' END AS problem FROM p"""
)
def form4_validity(spark, folder):
    page = F.concat(F.when(c("source") == "form4_text", F.lit(_PAGE)).otherwise(F.lit("")), c("text"))
    return table(spark, folder, "documents").select("doc_id", fl.form4_problem(page).alias("problem"))


@query()
def form4_sections(spark, folder):
    """Pages made of the documents' texts as tables; rows only."""
    page = F.concat(F.lit("<table><tr><td>1. Name and Address of Reporting Person</td></tr></table><table><tr><td><b>Explanation of Responses:</b></td></tr><tr><td>"), F.coalesce("text", F.lit("")), F.lit("</td></tr></table>"))
    return fl.form4_sections(table(spark, folder, "documents").select("doc_id", page.alias("html")), "doc_id", "html")


@query(f"""{FORM4}, t AS (SELECT source_file, unnest(transactions) AS t FROM f WHERE len(transactions) > 0)
SELECT source_file, nullif(trim(t.security_title), '') AS security_title, nullif(trim(t.transaction_date), '') AS transaction_date, t.transaction_code AS transaction_code, t.shares_traded AS shares_traded, t.acquisition_or_disposition AS acquisition_or_disposition,
  t.price_per_share AS price_per_share, t.shares_owned_after AS shares_owned_after, t.ownership_type AS ownership_type FROM t WHERE t IS NOT NULL AND t.security_title IS NOT NULL""")
def form4_pages(spark, folder):
    """The transactions of each filing, written as a page's Table I with marks of footnotes, and read back from the page."""
    escaped = lambda x: F.replace(F.replace(F.coalesce(x, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
    cell = lambda x: F.concat(F.lit("<td>"), x, F.lit("</td>"))
    empty = F.lit("<td></td>")

    def row(t):
        count = lambda x: F.coalesce(F.format_number(x, 0), F.lit(""))
        price = F.coalesce(F.concat(F.lit("$"), t["price_per_share"].cast("string"), F.lit("<sup>(2)</sup>")), F.lit("<sup>(1)</sup>"))
        cells = (cell(escaped(t["security_title"])), cell(escaped(t["transaction_date"])), empty, cell(escaped(t["transaction_code"])), empty, cell(count(t["shares_traded"])), cell(escaped(t["acquisition_or_disposition"])), cell(price), cell(count(t["shares_owned_after"])), cell(escaped(t["ownership_type"])), empty)
        return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))

    head = "<table><thead><tr><th colspan=11><b>Table I - Non-Derivative Securities</b></th></tr><tr><th>1. Title of Security</th><th>2. Transaction Date (Month/Day/Year)</th></tr></thead><tbody>"
    rows = F.array_join(F.transform(F.filter("transactions", lambda t: t.isNotNull()), row), "")
    pages = _form4(spark, folder).select("source_file", F.concat(F.lit(head), F.coalesce(rows, F.lit("")), F.lit("</tbody></table>")).alias("html"))
    return fl.form4_records(pages, "source_file", "html").select("source_file", F.explode("transactions").alias("t")).select("source_file", "t.*")


@query(f"""{FORM4}, t AS (SELECT unnest(transactions) AS t FROM f WHERE len(transactions) > 0), d AS (SELECT DISTINCT t.transaction_date AS raw FROM t WHERE t.transaction_date IS NOT NULL)
SELECT raw, CASE WHEN regexp_full_match(raw, '[0-9]{{2}}/[0-9]{{2}}/[0-9]{{4}}') AND try_strptime(raw, '%m/%d/%Y') IS NOT NULL THEN strftime(try_strptime(raw, '%m/%d/%Y'), '%Y-%m-%d') ELSE raw END AS plain FROM d""")
def date_normalise(spark, folder):
    dates = _form4(spark, folder).select(F.explode("transactions").alias("t")).select(c("t.transaction_date").alias("raw")).where(c("raw").isNotNull()).distinct()
    return dates.select("raw", f.plain_date(c("raw")).alias("plain"))


@query("SELECT p_partkey, CAST(trunc(TRY_CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE)) AS BIGINT) AS whole FROM part")
def numeric_normalise(spark, folder):
    return table(spark, folder, "part").select("p_partkey", f.whole_number(c("p_retailprice").cast("string")).alias("whole"))


@query(f"""{FORM4}, s AS (SELECT upper(ticker_symbol) AS ticker, regexp_replace(source_file, '\\.html$', '') AS accession, max(filing_metadata.filing_date) AS filing_date FROM f GROUP BY 1, 2),
  k AS (SELECT ticker, quantile_disc(accession, 0.5) AS last_accession FROM s GROUP BY 1)
SELECT ticker, accession, filing_date FROM s LEFT JOIN k USING (ticker) WHERE accession > last_accession QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY filing_date DESC, accession DESC) <= 5""")
def new_filings_checkpoint(spark, folder):
    rows = _form4(spark, folder).select(F.upper("issuer.ticker_symbol").alias("ticker"), F.regexp_replace("source_file", r"\.html$", "").alias("accession"), c("filing_metadata.filing_date").alias("filing_date"))
    rows = rows.groupBy("ticker", "accession").agg(F.max("filing_date").alias("filing_date")).withColumn("form", F.lit(" 4 "))
    order = Window.partitionBy("ticker").orderBy("accession")
    place = rows.withColumn("r", F.row_number().over(order)).withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("ticker")))
    checkpoint = place.where(c("r") == F.ceil(c("n") / 2)).select("ticker", c("accession").alias("last_accession"))
    return fl.new_filings(rows, checkpoint).select("ticker", "accession", "filing_date")


@query("SELECT o_custkey AS cik, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS accession FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def first_filing_per_cik(spark, folder):
    rows = table(spark, folder, "orders").where(c("o_orderstatus") == "F")
    return rows.groupBy(c("o_custkey").alias("cik")).agg(F.min_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("accession"))


@query("SELECT l_orderkey, l_linenumber, l_extendedprice AS value, o_orderpriority AS period, o_custkey AS cik FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey")
def fact_context_join(spark, folder):
    facts = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", c("l_extendedprice").alias("value"), c("l_orderkey").alias("contextRef"), F.lit(1).alias("filingId"))
    contexts = table(spark, folder, "orders").select(F.lit(1).alias("filingId"), c("o_orderkey").alias("contextId"), c("o_orderpriority").alias("period"), c("o_custkey").alias("dimensions"))
    return fl.attach_contexts(facts, contexts, "filingId").select("l_orderkey", "l_linenumber", "value", "period", c("dimensions").alias("cik"))


FACTS = "WITH facts AS (SELECT l_orderkey * 10 + l_linenumber AS fact_id, p_type AS concept, l_suppkey AS ticker, round(l_extendedprice, 2) AS value_num, strftime(l_shipdate, '%Y-%m-%d') AS period_end FROM lineitem JOIN part ON p_partkey = l_partkey)"


def _facts(spark, folder) -> DataFrame:
    items = table(spark, folder, "lineitem").select("l_partkey", (c("l_orderkey") * 10 + c("l_linenumber")).alias("fact_id"), c("l_suppkey").alias("ticker"), F.round("l_extendedprice", 2).alias("value_num"), F.date_format("l_shipdate", "yyyy-MM-dd").alias("period_end"))
    parts = table(spark, folder, "part").select(c("p_partkey").alias("l_partkey"), c("p_type").alias("concept"))
    return items.join(parts, "l_partkey").drop("l_partkey")


@query(f"{FACTS} SELECT ticker, max(period_end) AS period_end FROM facts GROUP BY 1")
def period_end(spark, folder):
    period = F.struct(c("period_end").alias("end"), F.lit(None).cast("string").alias("instant"))
    return _facts(spark, folder).groupBy("ticker").agg(F.max(fl.period_end(period)).alias("period_end"))


@query(f"{FACTS} SELECT fact_id, concept, ticker, value_num FROM facts WHERE regexp_matches(concept, '(?i)promo') AND value_num <> 0 ORDER BY value_num DESC, fact_id LIMIT 10")
def query_revenue(spark, folder):
    return fl.concept_query(_facts(spark, folder), "promo").select("fact_id", "concept", "ticker", "value_num")


@query(f"{FACTS} SELECT fact_id, concept, ticker, value_num FROM facts WHERE regexp_matches(concept, '(?i)ECONOMY') AND ticker = 7 AND value_num <> 0 ORDER BY value_num DESC, fact_id LIMIT 10")
def concept_query(spark, folder):
    return fl.concept_query(_facts(spark, folder).where(c("ticker") == 7), "economy", strict=True).select("fact_id", "concept", "ticker", "value_num")


@query(f"{FACTS} SELECT fact_id, concept, ticker, value_num FROM facts WHERE regexp_matches(concept, '(?i)standard') AND ticker = 3 AND value_num <> 0 ORDER BY value_num DESC, fact_id LIMIT 10")
def query_assets(spark, folder):
    return fl.concept_query(_facts(spark, folder).where(c("ticker") == 3), "standard").select("fact_id", "concept", "ticker", "value_num")


@query(f"{FACTS} SELECT concept, CAST(count(*) AS BIGINT) AS facts, string_agg(DISTINCT ticker, ',' ORDER BY ticker) AS tickers, arg_min(value_num, fact_id) AS sample FROM facts GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15")
def common_concepts(spark, folder):
    return fl.common_concepts(_facts(spark, folder))


@query(f"{FACTS} SELECT ticker, fact_id, concept, value_num, period_end FROM facts WHERE regexp_matches(concept, '(?i)promo') AND ticker IN (1, 2, 3, 5, 8) QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY period_end DESC NULLS LAST, fact_id) = 1")
def compare_metrics(spark, folder):
    rows = _facts(spark, folder).where(c("concept").rlike("(?i)promo") & c("ticker").isin(1, 2, 3, 5, 8))
    return fl.latest_by_ticker(rows).select("ticker", "fact_id", "concept", "value_num", "period_end")


@query(f"{FACTS} SELECT fact_id, value_num, period_end FROM facts WHERE ticker = 3 AND concept = (SELECT min(concept) FROM facts) ORDER BY period_end DESC NULLS LAST, fact_id LIMIT 1")
def latest_fact(spark, folder):
    facts = _facts(spark, folder)
    first = facts.agg(F.min("concept").alias("concept"))
    return facts.where(c("ticker") == 3).join(F.broadcast(first), "concept").orderBy(F.desc_nulls_last("period_end"), "fact_id").limit(1).select("fact_id", "value_num", "period_end")


@query("SELECT p_partkey, p_name, CASE WHEN length(p_name) > 8 THEN substr(p_name, 1, 5) || '...' ELSE p_name END AS clipped, CASE WHEN abs(p_retailprice) >= 1000 THEN printf('$%.2fK', p_retailprice / 1000) ELSE printf('$%.2f', p_retailprice) END AS shown FROM part")
def display_formats(spark, folder):
    return table(spark, folder, "part").select("p_partkey", "p_name", f.clip(c("p_name"), 8).alias("clipped"), f.human_number(c("p_retailprice")).alias("shown"))


@query("""SELECT p_partkey, 'us-gaap:' || array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(w[1]) || lower(w[2:])), '') AS name,
  array_to_string(list_transform(string_split(p_type, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS label, regexp_replace(p_name, '^.* ', '') AS last FROM part""")
def concept_label(spark, folder):
    """Concepts made of the parts' types and read back as labels; the last segment of a path made of their names."""
    name = F.concat(F.lit("us-gaap:"), F.replace(F.initcap("p_type"), F.lit(" "), F.lit("")))
    rows = table(spark, folder, "part").select("p_partkey", name.alias("name"), F.replace("p_name", F.lit(" "), F.lit("/")).alias("path"))
    return rows.select("p_partkey", "name", f.concept_label(c("name")).alias("label"), F.element_at(F.split("path", "/"), -1).alias("last"))


@query("SELECT o_orderkey, CASE WHEN o_orderpriority[1:1] IN ('1', '2') THEN 'monetary' WHEN o_orderpriority[1:1] IN ('3', '4') THEN 'shares' ELSE 'other' END AS type FROM orders")
def unit_type(spark, folder):
    """Each order's priority stands for the measures of a unit."""
    first = F.substring("o_orderpriority", 1, 1)
    measures = F.when(first == "1", F.array(F.lit("iso4217:USD"))).when(first == "2", F.array(F.lit("iso4217:EUR"))).when(first == "3", F.array(F.lit("xbrli:shares"))).when(first == "4", F.array(F.lit("xbrli:shares"), F.lit("iso4217:EUR"))).otherwise(F.array(F.lit("xbrli:pure")))
    return table(spark, folder, "orders").select("o_orderkey", f.unit_type(measures).alias("type"))


@query("SELECT o_orderkey, 'ctx' || o_orderkey AS contextRef, 'co:OrderTotal' AS name, 'Order Total' AS label, o_totalprice AS value_num, strftime(o_orderdate, '%Y-%m-%d') AS period_end, 'monetary' AS unit_type FROM orders")
def xbrl_explode(spark, folder):
    """An instance document is written for each order and parsed again."""
    day, k = F.date_format("o_orderdate", "yyyy-MM-dd"), c("o_orderkey").cast("string")
    xml = F.concat(
        F.lit('<xbrl xmlns="http://www.xbrl.org/2003/instance" xmlns:co="http://example.org/co"><context id="ctx'), k, F.lit('"><entity><identifier scheme="s">1</identifier></entity><period><instant>'), day,
        F.lit('</instant></period></context><unit id="u"><measure>iso4217:USD</measure></unit><co:OrderTotal contextRef="ctx'), k, F.lit('" unitRef="u" decimals="2">'), c("o_totalprice").cast("string"), F.lit("</co:OrderTotal></xbrl>"),
    )
    facts = fl.xbrl_tables(table(spark, folder, "orders").select("o_orderkey", xml.alias("xml")), "o_orderkey", "xml")["facts"]
    return facts.where(c("unit_type").isNotNull()).select("o_orderkey", "contextRef", "name", "label", "value_num", fl.period_end(c("period")).alias("period_end"), "unit_type")


@query(f"{FORM4} SELECT source_file, m.ticker, m.cik FROM f JOIN cik_map AS m ON m.ticker = upper(ticker_symbol)")
def cik_map_join(spark, folder):
    rows = _form4(spark, folder).select("source_file", F.upper("issuer.ticker_symbol").alias("ticker"))
    return rows.join(table(spark, folder, "cik_map").select("ticker", f.pad_cik(c("cik")).alias("cik")), "ticker").select("source_file", "ticker", "cik")


@query("SELECT 'form4' AS part, count(*) AS rows FROM form4 UNION ALL SELECT 'form4_raw', count(*) FROM form4_raw UNION ALL SELECT 'documents', count(*) FROM documents")
def db_stats(spark, folder):
    parts = [table(spark, folder, t).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("part"), "rows") for t in ("form4", "form4_raw", "documents")]
    return parts[0].union(parts[1]).union(parts[2])


@query(f"{FORM4} SELECT DISTINCT upper(ticker_symbol) AS ticker FROM f WHERE ticker_symbol IS NOT NULL ORDER BY 1")
def tickers(spark, folder):
    return _form4(spark, folder).select(F.upper("issuer.ticker_symbol").alias("ticker")).where(c("ticker").isNotNull()).distinct().orderBy("ticker")


@query(f"{FORM4} SELECT upper(ticker_symbol) AS ticker, count(*) AS filings, max(filing_metadata.filing_date) AS latest FROM f GROUP BY 1")
def ticker_summary(spark, folder):
    """Each filing once, however often it was delivered."""
    return _form4(spark, folder).groupBy(F.upper("issuer.ticker_symbol").alias("ticker")).agg(F.count(F.lit(1)).alias("filings"), F.max("filing_metadata.filing_date").alias("latest"))


@query(f"{FORM4} SELECT source_file FROM f WHERE filing_metadata.is_amendment AND NOT coalesce(filing_metadata.filing_date < '2025-10-01', false)")
def insert_absent(spark, folder):
    rows = _form4(spark, folder).select("source_file", c("filing_metadata.is_amendment").alias("a"), c("filing_metadata.filing_date").alias("d"))
    return fl.insert_absent(rows.where("a").select("source_file"), rows.where(c("d") < "2025-10-01"), ["source_file"])


@query("SELECT c_custkey, place, name FROM (SELECT c_custkey, generate_subscripts(n, 1) - 1 AS place, unnest(n) AS name FROM (SELECT c_custkey, [c_name, c_mktsegment] AS n FROM customer))")
def submissions_rows(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", F.array("c_name", "c_mktsegment").alias("name"), F.array("c_mktsegment", "c_name").alias("other"))
    return fl.submissions(rows, ("name", "other")).select("c_custkey", c("place").cast("bigint").alias("place"), "name")


@query()
def chunk_documents(spark, folder):
    """Chunks of every transcript by the default split oracle."""
    docs = table(spark, folder, "documents").where(c("source") == "transcript")
    return tr.chunk_documents(docs, "doc_id", "text")


@query(r"""SELECT CAST(doc_id AS VARCHAR) AS doc_id, doc_date AS date, upper(d.ticker) AS ticker, CAST(year_no AS INTEGER) AS year, CAST(quarter_no AS INTEGER) AS quarter, 1 AS chunk_index, lpad(cik, 10, '0') AS cik, coalesce(doc_type, 'transcript') AS doc_type,
  d.ticker || '_' || year_no || '_Q' || quarter_no || '.json' AS source_file, regexp_replace(text, '^[\t-\r\x1c-\x20\x{85}\p{Z}]+|[\t-\r\x1c-\x20\x{85}\p{Z}]+$', '', 'g') AS chunk FROM documents AS d JOIN cik_map AS m ON m.ticker = d.ticker
WHERE regexp_full_match(doc_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(doc_date AS DATE) IS NOT NULL AND year_no IS NOT NULL AND quarter_no IS NOT NULL AND cik IS NOT NULL""")
def chunk_record_fields(spark, folder):
    """The records of whole texts as their own first chunk, with all their fields."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "cik_map").select("ticker", "cik"), "ticker")
    rows = docs.select(c("doc_date").alias("date"), "ticker", c("year_no").alias("year"), c("quarter_no").alias("quarter"), "cik", "doc_id", "doc_type", F.lit(1).alias("chunk_index"), c("text").alias("chunk"))
    return tr.chunk_records(rows).select("metadata.*", "chunk")


@query("SELECT len(embedding) AS dimension, count(*) AS vectors FROM embeddings GROUP BY 1")
def embedding_dimension(spark, folder):
    return table(spark, folder, "embeddings").groupBy(F.size("embedding").cast("bigint").alias("dimension")).agg(F.count(F.lit(1)).alias("vectors"))


@query("SELECT doc_id, 'date' AS field, doc_date AS value FROM documents WHERE ticker IS NOT NULL AND doc_date IS NOT NULL AND regexp_full_match(doc_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND year_no IS NOT NULL AND quarter_no IS NOT NULL AND ticker IN (SELECT ticker FROM cik_map)")
def chunk_records(spark, folder):
    """The records of whole texts as their own first chunk; their dates are compared."""
    docs = table(spark, folder, "documents").join(table(spark, folder, "cik_map").select("ticker", "cik"), "ticker")
    rows = docs.select(c("doc_date").alias("date"), "ticker", c("year_no").alias("year"), c("quarter_no").alias("quarter"), "cik", "doc_id", "doc_type", F.lit(1).alias("chunk_index"), c("text").alias("chunk"))
    return tr.chunk_records(rows).select(c("metadata.doc_id").cast("bigint").alias("doc_id"), F.lit("date").alias("field"), c("metadata.date").alias("value"))


@query("""SELECT doc_id, CASE WHEN ticker IS NULL OR year_no IS NULL OR quarter_no IS NULL THEN 'missing ' || array_to_string(list_filter([CASE WHEN ticker IS NULL THEN 'ticker' END, CASE WHEN year_no IS NULL THEN 'year' END, CASE WHEN quarter_no IS NULL THEN 'quarter' END], lambda x: x IS NOT NULL), ', ')
WHEN quarter_no NOT BETWEEN 1 AND 4 THEN 'invalid quarter ' || quarter_no WHEN text IS NULL OR NOT regexp_matches(text, '\\S') THEN 'empty chunk' END AS problem FROM documents""")
def chunk_validate(spark, folder):
    meta = F.struct("ticker", c("year_no").alias("year"), c("quarter_no").alias("quarter"), F.lit(1).alias("chunk_index"), c("doc_id").cast("string").alias("doc_id"))
    return table(spark, folder, "documents").select("doc_id", tr.chunk_problem(meta, c("text"), F.array(F.lit(0.5))).alias("problem"))


@query("""WITH n AS (SELECT doc_id, text AS content, CASE WHEN text IS NULL THEN 'empty' END AS problem FROM documents), o AS (SELECT doc_id, CASE WHEN source = 'news' THEN text ELSE lang END AS before FROM documents WHERE lang = 'en')
SELECT CASE WHEN problem IS NOT NULL THEN 'error' WHEN o.doc_id IS NULL THEN 'inserted' WHEN content IS NOT DISTINCT FROM before THEN 'skipped' ELSE 'updated' END AS status, count(*) AS n FROM n LEFT JOIN o USING (doc_id) GROUP BY 1""")
def chunk_upsert_stats(spark, folder):
    docs = table(spark, folder, "documents")
    new = docs.select("doc_id", c("text").alias("content"), F.when(c("text").isNull(), "empty").alias("problem"))
    old = docs.where(c("lang") == "en").select("doc_id", F.when(c("source") == "news", c("text")).otherwise(c("lang")).alias("content"))
    return tr.upsert_counts(new, old, ["doc_id"])


@query("SELECT doc_id FROM documents AS d WHERE source = 'transcript' AND NOT EXISTS (SELECT 1 FROM documents AS p WHERE p.source = 'tenq_note' AND p.ticker = d.ticker AND p.year_no = d.year_no AND p.quarter_no = d.quarter_no)")
def skip_processed(spark, folder):
    docs = table(spark, folder, "documents")
    key = ["ticker", "year_no", "quarter_no"]
    done = docs.where(c("source") == "tenq_note").select(*key).distinct()
    return docs.where(c("source") == "transcript").select("doc_id", *key).join(done, key, "left_anti").select("doc_id")


@query("SELECT source, count(*) AS documents, count(text) AS with_text, coalesce(CAST(sum(length(text)) AS BIGINT), 0) AS characters FROM documents GROUP BY 1")
def collection_stats(spark, folder):
    return table(spark, folder, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.count("text").alias("with_text"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("characters"))


@query("SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents")
def token_estimate(spark, folder):
    return table(spark, folder, "documents").select("doc_id", f.token_estimate(c("text")).alias("tokens"))


_COS = "list_cosine_similarity(CAST(v.embedding AS DOUBLE[]), CAST(q.embedding AS DOUBLE[]))"


@query(f"SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT q.vec_id AS query_id, v.vec_id AS vec_id, {_COS} AS score, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY {_COS} DESC, v.vec_id) AS INTEGER) AS rank FROM embeddings AS v, embeddings AS q WHERE q.vec_id % 50 = 0 AND v.vec_id <> q.vec_id) WHERE rank <= 5")
def knn_cosine_top5(spark, folder):
    v = table(spark, folder, "embeddings").select("vec_id", "embedding")
    q = v.where(c("vec_id") % 50 == 0).select(c("vec_id").alias("query_id"), "embedding")
    return tr.nearest_vectors(v, q).withColumn("score", F.round("score", 6))


@query("SELECT doc_type, count(*) AS documents FROM documents WHERE upper(trim(doc_type)) IN ('10-K', '10-Q', '8-K', '4', '13F', '13D', 'DEF 14A', 'S-1', '20-F', 'NT 10-K', 'DEFA14A') GROUP BY 1")
def form_types(spark, folder):
    kept = F.upper(F.trim("doc_type")).isin(*fl.FORM_TYPES)
    return table(spark, folder, "documents").where(kept).groupBy("doc_type").agg(F.count(F.lit(1)).alias("documents"))


@query("SELECT o_orderkey, year(d) AS year, CAST(quarter(d) AS INTEGER) AS quarter FROM (SELECT o_orderkey, date_trunc('quarter', o_orderdate) - INTERVAL 3 MONTH AS d FROM orders)")
def previous_quarter(spark, folder):
    q = previous(F.to_date("o_orderdate"))
    return table(spark, folder, "orders").select("o_orderkey", q["year"].cast("bigint").alias("year"), q["quarter"].alias("quarter"))
