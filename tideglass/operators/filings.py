"""Filings: validity, sections of Form 4, cleaning, metadata; XBRL instances to contexts, units and facts; fact queries."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from tideglass.functions.scalars import concept_label, pad_cik, plain_date, unit_type
from tideglass.functions.timeparse import let

c = F.col

# What a Form 4 page must not hold, must hold, and its structure; forms that are fetched.
EXCLUDED_WORDS = ("schedule 14a", "proxy statement", "defa14a", "def 14a", "voting instruction", "annual meeting", "shareholder meeting", "form 8-k", "current report", "inline xbrl", "xbrli:context")
REQUIRED_WORDS = ("form 4", "statement of changes in beneficial ownership")
TABLE_WORDS = ("table i - non-derivative securities", "table ii - derivative securities")
STRUCTURE = ("name and address of reporting person", "issuer name.*ticker.*trading symbol", "relationship of reporting person", "transaction code")
FORM_TYPES = ("10-K", "10-Q", "8-K", "4", "13F", "13D", "DEF 14A", "S-1", "20-F", "NT 10-K", "DEFA14A")


def form4_problem(text: Column) -> Column:
    """Null for a valid page, else which test it fails first. At least three of the structure's patterns must occur; the class of
    the title cell, which the page's own case spoils, isn't among them. A null page is `missing`."""
    low = F.lower(text)
    any_of = lambda ws: F.greatest(*(low.contains(w) for w in ws))
    all_of = lambda ws: F.least(*(low.contains(w) for w in ws))
    parts = sum((low.rlike(p).cast("int") for p in STRUCTURE), F.lit(0))
    return F.when(text.isNull(), "missing").when(any_of(EXCLUDED_WORDS), "excluded").when(~all_of(REQUIRED_WORDS), "no title").when(~any_of(TABLE_WORDS), "no table").when(parts < 3, "structure")


def market_value(transactions: Column) -> Column:
    """Shares times price over open-market codes S and P, rounded to cents; nulls don't count."""
    kept = F.filter(transactions, lambda t: t["transaction_code"].isin("S", "P") & t["shares_traded"].isNotNull() & t["price_per_share"].isNotNull())
    return F.round(F.aggregate(kept, F.lit(0.0), lambda s, t: s + t["shares_traded"] * t["price_per_share"]), 2)


def mentions_plan(footnotes: Column) -> Column:
    return F.coalesce(F.exists(footnotes, lambda f: F.lower(f).contains("10b5")), F.lit(False))


def clean_record(filings: DataFrame) -> DataFrame:
    """Filings with plain dates, acquired and disposed defaulting to 0, the plan flag set by code where a footnote mentions a plan,
    and the market value recomputed."""
    plan = mentions_plan(c("footnotes"))

    def clean(t: Column) -> Column:
        dated = t.withField("transaction_date", plain_date(t["transaction_date"]))
        return F.when(t.isNotNull(), dated.withField("rule_10b5_1_plan", F.when(plan, t["transaction_code"].isin("S", "P")).otherwise(t["rule_10b5_1_plan"])))

    def derived(t: Column) -> Column:
        zero = lambda x: F.coalesce(t[x], F.lit(0).cast("bigint"))
        return F.when(t.isNotNull(), t.withField("transaction_date", plain_date(t["transaction_date"])).withField("acquired", zero("acquired")).withField("disposed", zero("disposed")))

    out = filings.withColumn("transactions", F.transform("transactions", clean)).withColumn("derivative_transactions", F.transform("derivative_transactions", derived))
    return out.withColumn("total_transaction_value", F.coalesce(market_value(c("transactions")), F.lit(0.0)))


def metadata_rows(filings: DataFrame) -> DataFrame:
    """One flat row for each filing."""
    source = c("filing_metadata.source_file")
    return filings.select(
        F.upper("issuer.ticker_symbol").alias("ticker"), pad_cik(c("issuer.cik")).alias("cik"), F.lit("4").alias("doc_type"), F.regexp_replace(source, r"\.html$", "").alias("doc_id"),
        c("filing_metadata.earliest_transaction_date").alias("date"), c("filing_metadata.filing_date").alias("filing_date"), source.alias("source_file"), F.upper("reporting_person.name").alias("reporting_person"),
        F.coalesce("filing_metadata.is_amendment", F.lit(False)).alias("is_amendment"), F.coalesce(market_value(c("transactions")), F.lit(0.0)).alias("total_transaction_value"),
        F.greatest(F.coalesce(F.size("transactions"), F.lit(0)), F.lit(0)).alias("num_transactions"),
    )


def submissions(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Rows of parallel arrays as flat rows, with their place; shorter arrays give nulls."""
    rest = [x for x in rows.columns if x not in columns]
    return rows.select(*rest, F.posexplode(F.arrays_zip(*columns)).alias("place", "z")).select(*rest, "place", *(c(f"z.{x}").alias(x) for x in columns))


def new_filings(filings: DataFrame, checkpoint: DataFrame, per_ticker: int = 5) -> DataFrame:
    """filings (ticker, form, accession, filing_date) of form 4 beyond the last accession of checkpoint (ticker, last_accession),
    the latest per_ticker of each ticker."""
    form4 = filings.where(F.upper(F.trim("form")) == "4").join(checkpoint, "ticker", "left")
    fresh = form4.where(c("last_accession").isNull() | (c("accession") > c("last_accession"))).drop("last_accession")
    back = Window.partitionBy("ticker").orderBy(F.desc("filing_date"), F.desc("accession"))
    return fresh.withColumn("place", F.row_number().over(back)).where(c("place") <= per_ticker).drop("place")


def insert_absent(new: DataFrame, old: DataFrame, key: list[str]) -> DataFrame:
    """Rows of new whose key old doesn't have, one per key."""
    return new.dropDuplicates(key).join(old.select(*key).distinct(), key, "left_anti")


class _Sections(HTMLParser):
    """Text of each table, with the tables' nesting; entities are decoded."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[int] = []
        self.tables: list[list[str]] = []
        self.bold: list[str] | None = None
        self.marks: list[tuple[str, bool, int]] = []  # text, in bold, innermost table

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
            self.open.append(len(self.tables) - 1)
        elif tag == "b":
            self.bold = []
        elif tag in ("tr", "br", "p", "div"):
            self._put("\n")
        elif tag in ("td", "th"):
            self._put(" ")

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif tag == "b" and self.bold is not None:
            if self.open:
                self.marks.append(("".join(self.bold).strip(), True, self.open[-1]))
            self.bold = None

    def handle_data(self, data: str) -> None:
        self._put(data)
        if self.bold is not None:
            self.bold.append(data)
        if self.open and data.strip():
            self.marks.append((data.strip(), False, self.open[-1]))

    def _put(self, text: str) -> None:
        for t in self.open:
            self.tables[t].append(text)

    def text(self, at: int) -> str:
        lines = (" ".join(x.split()) for x in "".join(self.tables[at]).split("\n"))
        return "\n".join(x for x in lines if x)


#: Heading of a section, how its mark is recognised: in bold or not, and the test.
_WANTED = (
    ("--- FILING METADATA ---\n", False, lambda t: "Name and Address of Reporting Person" in t),
    ("", True, lambda t: t.startswith("Table I") and not t.startswith("Table II")),
    ("", True, lambda t: t.startswith("Table II")),
    ("", True, lambda t: t == "Explanation of Responses:"),
    ("--- SIGNATURES ---\n", False, lambda t: "** Signature of Reporting Person" in t),
)


def section_text(html: str | None) -> str | None:
    """The five sections of a Form 4 page as text, joined by blank lines; null if there are none."""
    if not html:
        return None
    page = _Sections()
    page.feed(html)
    page.close()
    found = []
    for heading, bold, test in _WANTED:
        at = next((t for text, b, t in page.marks if b == bold and test(text)), None)
        if at is not None and page.text(at):
            found.append(heading + page.text(at))
    return "\n\n".join(found) or None


def form4_sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, sections of each page."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            yield pd.DataFrame({key: part[key], "sections": [section_text(x) for x in part[html]]})

    return pages.select(key, html).mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, sections string")


# The columns of a Form 4's two tables, by the form's own order; None is a column that isn't kept.
TABLE_I = ("security_title", "transaction_date", None, "transaction_code", None, "shares_traded", "acquisition_or_disposition", "price_per_share", "shares_owned_after", "ownership_type", None)
TABLE_II = (
    "title", "conversion_price", "transaction_date", None, "transaction_code", None, "acquired", "disposed", "date_exercisable", "expiration_date", "underlying_title", "underlying_amount", "price",
    "beneficially_owned_after", "ownership_form", "nature_of_indirect",
)
_WHOLE = {"shares_traded", "shares_owned_after", "acquired", "disposed", "underlying_amount", "beneficially_owned_after"}
_DECIMAL = {"price_per_share", "conversion_price", "price"}
_kinds = lambda names: ", ".join(f"{x}:{'bigint' if x in _WHOLE else 'double' if x in _DECIMAL else 'string'}" for x in names if x)
FORM4_PAGE = f"transactions array<struct<{_kinds(TABLE_I)}>>, derivative_transactions array<struct<{_kinds(TABLE_II)}>>, footnotes array<string>"
_NOTE = re.compile(r"\(\d{1,3}\)")
_NUMBERED = re.compile(r"^\d{1,3}\s*[.\\]")


class _Rows(HTMLParser):
    """The rows of each innermost table as cells' texts; what is in bold within a table tells what the table is."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list[str]]]] = []
        self.headings: list[list[str]] = []
        self.open: list[int] = []
        self.bold = False

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag == "table":
            self.tables.append([])
            self.headings.append([])
            self.open.append(len(self.tables) - 1)
        elif tag == "tr" and self.open:
            self.tables[self.open[-1]].append([])
        elif tag in ("td", "th") and self.open:
            rows = self.tables[self.open[-1]]
            if not rows:
                rows.append([])
            rows[-1].append([])
        elif tag == "b":
            self.bold = True

    def handle_endtag(self, tag: str) -> None:
        if tag == "table" and self.open:
            self.open.pop()
        elif tag == "b":
            self.bold = False

    def handle_data(self, data: str) -> None:
        if not self.open:
            return
        at = self.open[-1]
        if self.bold:
            self.headings[at].append(data)
        if self.tables[at] and self.tables[at][-1]:
            self.tables[at][-1][-1].append(data)

    def heading(self, at: int) -> str:
        return " ".join("".join(self.headings[at]).split())

    def rows(self, at: int) -> list[list[str]]:
        return [[" ".join("".join(cell).split()) for cell in row] for row in self.tables[at]]


def _cell(name: str, text: str):
    """A cell's value without the marks of footnotes; null where nothing, or no number, is left."""
    bare = _NOTE.sub("", text).strip()
    if name in _WHOLE or name in _DECIMAL:
        number = _number(bare, ",$")
        return None if number is None else int(number) if name in _WHOLE else number
    return bare or None


def _table_rows(rows: list[list[str]], columns: tuple[str | None, ...]) -> list[dict]:
    """Rows of as many cells as the form has columns, but for those of the head: they have no date where the date stands."""
    date = columns.index("transaction_date")
    full = [r for r in rows if len(r) == len(columns) and r[0] and not r[date].startswith(("2.", "3.")) and "Transaction Date" not in r[date]]
    return [{c_: _cell(c_, x) for c_, x in zip(columns, r, strict=True) if c_} for r in full]


def page_record(html: str | None) -> dict | None:
    """The transactions, derivative transactions and footnotes of a Form 4 page; null for a null or empty page."""
    if not html:
        return None
    page = _Rows()
    page.feed(html)
    page.close()
    out: dict = {"transactions": [], "derivative_transactions": [], "footnotes": []}
    for at in range(len(page.tables)):
        heading = page.heading(at)
        if heading.startswith("Table II"):
            out["derivative_transactions"] += _table_rows(page.rows(at), TABLE_II)
        elif heading.startswith("Table I"):
            out["transactions"] += _table_rows(page.rows(at), TABLE_I)
        elif heading.startswith("Explanation of Responses"):
            out["footnotes"] += [_NUMBERED.sub("", x).strip() for r in page.rows(at) for x in r if _NUMBERED.match(x)]
    return out


def form4_records(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, transactions, derivative_transactions, footnotes of each page, read from its tables; null for null and empty pages."""
    names = ("transactions", "derivative_transactions", "footnotes")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            read = [page_record(x) or {} for x in part[html]]
            yield pd.DataFrame({key: part[key], **{n: pd.Series([r.get(n) for r in read], dtype=object, index=part.index) for n in names}})

    return pages.select(key, html).mapInPandas(run, f"`{key}` {pages.schema[key].dataType.simpleString()}, {FORM4_PAGE}")


_XBRLI = "{http://www.xbrl.org/2003/instance}"
_DIMENSION = "{http://xbrl.org/2006/xbrldi}explicitMember"
_LINK, _XLINK = "{http://www.xbrl.org/2003/linkbase}", "{http://www.w3.org/1999/xlink}"
_NIL = "{http://www.w3.org/2001/XMLSchema-instance}nil"
_PERIOD = "period:struct<instant:string,start:string,end:string>,dimensions:map<string,string>"
XBRL = {
    "contexts": f"array<struct<contextId:string,entityIdentifier:string,{_PERIOD}>>",
    "units": "array<struct<unitId:string,measures:array<string>>>",
    "facts": f"array<struct<contextRef:string,name:string,namespace:string,value_num:double,value_str:string,unitRef:string,decimals:string,isNil:boolean,{_PERIOD},measures:array<string>>>",
    "footnotes": "array<struct<id:string,text:string,role:string>>",
}


def _local(tag: str) -> tuple[str | None, str]:
    space, _, name = tag[1:].partition("}") if tag.startswith("{") else ("", "", tag)
    return (space or None), name


def _number(text: str, marks: str) -> float | None:
    for m in marks:
        text = text.replace(m, "")
    try:
        return float(text.strip())
    except ValueError:
        return None


class _Spaces(ElementTree.TreeBuilder):
    """Keeps the first URI of each prefix beside the tree."""

    def __init__(self) -> None:
        super().__init__()
        self.spaces: dict[str, str] = {}

    def start_ns(self, prefix: str | None, uri: str | None) -> None:
        self.spaces.setdefault(prefix or "", uri or "")


def parse_instance(text: str | None) -> dict:
    """Contexts, units, facts and footnotes of an instance; empty for null or broken XML. Facts are those written inline; only
    where there are none, every element that names a context. Each fact has the period and dimensions of its context and the
    measures of its unit, the first of that id; nulls where the instance has none."""
    out: dict = {"contexts": [], "units": [], "facts": [], "footnotes": []}
    try:
        builder = _Spaces()
        parser = ElementTree.XMLParser(target=builder)
        parser.feed(text or "")
        root, spaces = parser.close(), builder.spaces
    except ElementTree.ParseError:
        return out
    at = lambda e, tag: next((x.text for x in e.iter(tag)), None)
    for e in root.iter(f"{_XBRLI}context"):
        instant, start, end = (at(e, f"{_XBRLI}{n}") for n in ("instant", "startDate", "endDate"))
        period = {"instant": instant, "start": None, "end": None} if instant else {"instant": None, "start": start, "end": end} if start and end else None
        dims = {x.get("dimension", "").split(":")[-1]: x.text for x in e.iter(_DIMENSION) if x.get("dimension")}
        out["contexts"].append({"contextId": e.get("id"), "entityIdentifier": at(e, f"{_XBRLI}identifier"), "period": period, "dimensions": [*dims.items()] or None})
    for e in root.iter(f"{_XBRLI}unit"):
        out["units"].append({"unitId": e.get("id"), "measures": [x.text for x in e.iter(f"{_XBRLI}measure") if x.text]})
    prefixes = {uri: p for p, uri in spaces.items()}
    plain = []
    for e in root.iter():
        if not isinstance(e.tag, str) or not e.get("contextRef"):
            continue
        space, name = _local(e.tag)
        common = {"unitRef": e.get("unitRef"), "decimals": e.get("decimals"), "contextRef": e.get("contextRef")}
        if name in ("nonFraction", "nonNumeric"):
            if e.get("name"):
                value = e.text or None
                clean = value.replace(",", "").replace("$", "").strip() if value else None
                num = _number(clean, "") if clean and clean not in ("-", "—") else None
                out["facts"].append({"name": e.get("name"), "namespace": spaces.get(e.get("name").split(":")[0]) if ":" in e.get("name") else None, "value_num": num, "value_str": None if num is not None else clean, "isNil": value is None, **common})
        elif not (space or "").startswith("http://www.xbrl.org/"):
            nil = e.get(_NIL) == "true"
            value = None if nil else e.text
            clean = value.replace(",", "").strip() if value else None
            number = bool(clean) and (common["decimals"] not in (None, "", "INF") or clean.replace(".", "").replace("-", "").isdigit())
            num = _number(clean, "") if number else None
            plain.append({"name": f"{prefixes[space]}:{name}" if prefixes.get(space or "") else name, "namespace": space, "value_num": num, "value_str": None if num is not None else clean, "isNil": nil, **common})
    out["facts"] = out["facts"] or plain
    contexts, units = {x["contextId"]: x for x in reversed(out["contexts"])}, {x["unitId"]: x["measures"] for x in reversed(out["units"])}
    for x in out["facts"]:
        of = contexts.get(x["contextRef"], {})
        x |= {"period": of.get("period"), "dimensions": of.get("dimensions"), "measures": None if x["unitRef"] is None else units.get(x["unitRef"])}
    for link in root.iter(f"{_LINK}footnoteLink"):
        out["footnotes"] += [{"id": x.get(f"{_XLINK}label"), "text": "".join(x.itertext()).strip(), "role": x.get(f"{_XLINK}role")} for x in link.iter(f"{_LINK}footnote")]
    return out


def xbrl_tables(documents: DataFrame, key: str, xml: str) -> dict[str, DataFrame]:
    """contexts, units (with their type), facts (with label, context's period and unit's type) and footnotes of each instance, by key.

    A fact is joined to its context and unit while its instance is read, so that no table is shuffled; each table is one reading of
    the documents and returns only what it needs."""

    def read(name: str) -> DataFrame:
        kind = to_arrow_type(DataType.fromDDL(XBRL[name]))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 500):
                    part = batch.slice(at, 500)
                    found = pa.array([parse_instance(x)[name] for x in part.column(1).to_pylist()], kind)
                    yield pa.RecordBatch.from_arrays([part.column(0), found], [key, name])

        return documents.select(key, xml).mapInArrow(run, f"`{key}` {documents.schema[key].dataType.simpleString()}, {name} {XBRL[name]}").select(key, F.inline(name))

    units = read("units").withColumn("type", unit_type(c("measures")))
    facts = read("facts").withColumn("label", concept_label(c("name"))).withColumn("unit_type", F.when(c("measures").isNotNull(), unit_type(c("measures")))).drop("measures")
    return {"contexts": read("contexts"), "units": units, "facts": facts, "footnotes": read("footnotes")}


def attach_contexts(facts: DataFrame, contexts: DataFrame, key: str) -> DataFrame:
    """facts with the period and dimensions of their context; a fact whose context is missing keeps nulls."""
    look = contexts.select(key, c("contextId").alias("contextRef"), "period", "dimensions").dropDuplicates([key, "contextRef"])
    return facts.join(look, [key, "contextRef"], "left")


def period_end(period: Column) -> Column:
    return F.coalesce(period["end"], period["instant"])


def concept_query(facts: DataFrame, pattern: str, limit: int = 10, strict: bool = False) -> DataFrame:
    """Facts (concept, value_num, fact_id) whose concept matches pattern in any case and whose value isn't 0 (null passes, unless
    strict), the largest first."""
    keep = ~c("value_num").eqNullSafe(0.0)
    if strict:
        keep = keep & c("value_num").isNotNull()
    return facts.where(c("concept").rlike(f"(?i){pattern}") & keep).orderBy(F.desc_nulls_last("value_num"), "fact_id").limit(limit)


def common_concepts(facts: DataFrame, limit: int = 15) -> DataFrame:
    """concept, facts, tickers (the set, sorted, as text), sample (the value of the first fact by fact_id) of the most frequent concepts."""
    per = facts.groupBy("concept", "ticker").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("fact_id", "value_num")).alias("v"))
    ranked = per.groupBy("concept").agg(F.sum("n").alias("facts"), F.array_sort(F.collect_set("ticker")).alias("tickers"), F.min("v")["value_num"].alias("sample"))
    return ranked.withColumn("tickers", F.concat_ws(",", c("tickers").cast("array<string>"))).orderBy(F.desc("facts"), "concept").limit(limit)


def latest_by_ticker(facts: DataFrame, tie: str = "fact_id") -> DataFrame:
    """Of each ticker the fact with the latest period_end; facts without one come last."""
    back = Window.partitionBy("ticker").orderBy(F.desc_nulls_last("period_end"), tie)
    return facts.withColumn("place", F.row_number().over(back)).where(c("place") == 1).drop("place")


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: str) -> DataFrame:
    """The table after writing new over old: of each key the new row with the greatest `order`, else the old one."""
    back = Window.partitionBy(*key).orderBy(F.desc("__new"), F.desc_nulls_last(order))
    both = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    return both.withColumn("__r", F.row_number().over(back)).where(c("__r") == 1).drop("__r", "__new")


def first_object(text: Column) -> Column:
    """The first balanced JSON object of a text, code fences gone; null if there is none, or if what is balanced doesn't parse.

    One pass over the letters keeps the depth of braces; those in strings don't count."""
    bare = F.regexp_replace(text, "```(?:json)?", "")
    start = F.call_function("locate", F.lit("{"), bare)
    body = F.when(start > 0, F.substring(bare, start, F.length(bare)))
    first = F.struct(F.lit(0).alias("at"), F.lit(0).alias("depth"), F.lit(False).alias("quoted"), F.lit(False).alias("escaped"), F.lit(0).alias("end"))

    def step(s: Column, x: Column) -> Column:
        inside, done = s["quoted"], s["end"] > 0
        depth = F.when(inside, s["depth"]).when(x == "{", s["depth"] + 1).when(x == "}", s["depth"] - 1).otherwise(s["depth"])
        quoted = F.when((x == '"') & ~s["escaped"], ~inside).otherwise(inside)
        return F.struct((s["at"] + 1).alias("at"), depth.alias("depth"), quoted.alias("quoted"), (inside & (x == "\\") & ~s["escaped"]).alias("escaped"), F.when(done, s["end"]).when(~inside & (x == "}") & (s["depth"] == 1), s["at"] + 1).otherwise(0).alias("end"))

    end = F.aggregate(F.split(body, ""), first, step, lambda s: s["end"])
    found = F.when(end > 0, F.substring(body, F.lit(1), end))
    return F.when(F.try_parse_json(found).isNotNull(), found)

