"""SQL for the normalisation of times (problem 4), which that of problem 6 also uses. It takes declared zones as they are."""

from __future__ import annotations

from tideglass.functions.timeparse import LETTER_MINUTES, LETTER_ZONES
_OFFSETS = ", ".join(f"('{k}', {v})" for k, v in LETTER_MINUTES.items())
_PLACES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LETTER_ZONES.items())

NEWS_TIMES = rf"""
  offsets AS (SELECT * FROM (VALUES {_OFFSETS}) AS t(letters, minutes)),
  n1 AS (SELECT news_id, symbol, published_at, zone_name, date_order, upper(trim(regexp_replace(published_at, '\s+', ' ', 'g'))) AS s
    FROM (SELECT * FROM news QUALIFY row_number() OVER (PARTITION BY news_id ORDER BY time) = 1) LEFT JOIN news_sources USING (source)),
  n2 AS (SELECT *, CASE
      WHEN regexp_full_match(s, '\d{{4}}[-/]\d{{2}}[-/]\d{{2}}[T ]\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?( ?(Z|[+-]\d{{2}}:?\d{{2}}))?') THEN TRY_CAST(replace(s[1:10], '/', '-') || ' ' || regexp_extract(s, '\d{{2}}:\d{{2}}:\d{{2}}(\.\d+)?') AS TIMESTAMP)
      WHEN regexp_full_match(s, '\d{{8}}T\d{{6}}Z') THEN try_strptime(s, '%Y%m%dT%H%M%SZ')
      WHEN regexp_full_match(s, '\d{{2}}[/.]\d{{2}}[/.]\d{{4}} \d{{1,2}}:\d{{2}}') THEN CASE date_order WHEN 'DMY' THEN try_strptime(replace(s, '.', '/'), '%d/%m/%Y %-H:%M') ELSE try_strptime(replace(s, '.', '/'), '%m/%d/%Y %-H:%M') END
      WHEN regexp_full_match(s, '\d{{2}}[/.]\d{{2}}[/.]\d{{4}} \d{{1,2}}:\d{{2}} [AP]M') THEN CASE date_order WHEN 'DMY' THEN try_strptime(replace(s, '.', '/'), '%d/%m/%Y %-I:%M %p') ELSE try_strptime(replace(s, '.', '/'), '%m/%d/%Y %-I:%M %p') END
      WHEN regexp_full_match(s, '[A-Z]{{3}}, \d{{2}} [A-Z]{{3}} \d{{4}} \d{{2}}:\d{{2}}:\d{{2}} \S+') THEN try_strptime(s[6:25], '%d %b %Y %H:%M:%S')
      WHEN regexp_full_match(s, '[A-Z]{{3}} \d{{1,2}}, \d{{4}} \d{{1,2}}:\d{{2}} [AP]M( [A-Z]+)?') THEN try_strptime(regexp_extract(s, '^(.* [AP]M)', 1), '%b %-d, %Y %-I:%M %p')
      WHEN regexp_full_match(s, '\d{{1,2}} [A-Z]{{3}} \d{{4}}, \d{{2}}:\d{{2}}') THEN try_strptime(s, '%-d %b %Y, %H:%M') END AS local,
    CASE WHEN regexp_full_match(s, '\d{{10}}') THEN CAST(s AS BIGINT) * 1000 WHEN regexp_full_match(s, '\d{{13}}') THEN CAST(s AS BIGINT) END AS epoch,
    CASE WHEN regexp_matches(s, ' [AP]M$') THEN '' ELSE regexp_extract(s, '(Z|[+-]\d{{2}}:?\d{{2}}| [A-Z]{{1,5}})$', 1) END AS z FROM n1),
  n3 AS (SELECT n2.*, CASE WHEN regexp_matches(z, '^[+-]') THEN (CASE z[1] WHEN '-' THEN -1 ELSE 1 END) * (CAST(z[2:3] AS INT) * 60 + CAST(z[-2:] AS INT)) ELSE minutes END AS off,
      CASE WHEN z = '' THEN zone_name ELSE CASE trim(z) {_PLACES} END END AS place FROM n2 LEFT JOIN offsets ON letters = trim(z)),
  n4 AS (SELECT *, timezone(place, local) AS t FROM n3),
  news_times AS (SELECT news_id, nullif(upper(trim(symbol)), '') AS sym, published_at, coalesce(epoch,
      CASE WHEN place IS NULL THEN epoch_ms(local) - off * 60000 WHEN timezone(place, t - INTERVAL 1 HOUR) = local THEN epoch_ms(t) - 3600000 ELSE epoch_ms(t) END) AS ms FROM n4)"""


def _iso(ms: str) -> str:
    return f"strftime(make_timestamp({ms} * 1000), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST({ms} % 1000 AS VARCHAR), 3, '0') || 'Z'"


_DATE = r"""CASE WHEN regexp_matches(d, '^\d{4}-\d{2}-\d{2}(T.*|[+-]\d{2}:\d{2})?$') THEN TRY_CAST(d[1:10] AS TIMESTAMP) WHEN regexp_full_match(d, '\d{8}') THEN try_strptime(d, '%Y%m%d')
      WHEN regexp_full_match(d, '\d{1,2}[/-]\d{1,2}[/-]\d{4}') THEN try_strptime(replace(d, '-', '/'), '%-m/%-d/%Y') WHEN regexp_full_match(d, '\d{1,2}/\d{1,2}/\d{2}') THEN try_strptime(d, '%-m/%-d/%y')
      WHEN regexp_full_match(d, '\d{2}-[A-Z]{3}-\d{4}') THEN try_strptime(d, '%d-%b-%Y') WHEN regexp_full_match(d, '[A-Z]+ \d{1,2}, \d{4}') THEN try_strptime(regexp_replace(d, '^([A-Z]{3})[A-Z]*', '\1'), '%b %-d, %Y') END"""

FILINGS = """
  own AS (SELECT filing_metadata.source_file AS source_file, transactions FROM form4 QUALIFY row_number() OVER (PARTITION BY filing_metadata.source_file ORDER BY parsed_timestamp DESC) = 1),
  raw AS (SELECT *, json_extract_string(p, '$.filing_metadata.source_file') AS source_file FROM (SELECT TRY_CAST(payload AS JSON) AS p FROM form4_raw WHERE json_valid(payload) AND payload LIKE '{%') QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY CAST(p AS VARCHAR)) = 1),
  arrays AS (SELECT source_file, CASE json_type(p, '$.transactions') WHEN 'ARRAY' THEN CAST(json_extract(p, '$.transactions') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(p, '$.transactions')] ELSE [] END AS e FROM raw WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM own)),
  opened AS (SELECT source_file, generate_subscripts(e, 1) - 1 AS position, unnest(e) AS x FROM arrays),
  theirs AS (SELECT source_file, generate_subscripts(transactions, 1) - 1 AS position, unnest(transactions) AS t FROM own WHERE len(transactions) > 0)"""


def _number(name: str, kind: str) -> str:
    text = f"trim(regexp_replace(json_extract_string(x, '$.{name}'), '[,$]', '', 'g'))"
    return f"coalesce(TRY_CAST({text} AS {kind}), TRY_CAST(TRY_CAST({text} AS DOUBLE) AS {kind}))"


_FIELDS = {"security_title": "", "transaction_date": "", "transaction_code": "", "shares_traded": "BIGINT", "acquisition_or_disposition": "", "price_per_share": "DOUBLE", "shares_owned_after": "BIGINT", "ownership_type": "", "rule_10b5_1_plan": "BOOLEAN"}
_RAW_FIELDS = ", ".join(_number(k, v) if v in ("BIGINT", "DOUBLE") else f"TRY_CAST(json_extract_string(x, '$.{k}') AS BOOLEAN)" if v else f"json_extract_string(x, '$.{k}')" for k, v in _FIELDS.items())

_TEXT = "json_extract_string(p, '$.{}.{}')"
_META = "{'earliest_transaction_date': %s, 'filing_date': %s, 'is_amendment': TRY_CAST(%s AS BOOLEAN), 'source_file': source_file}" % tuple(_TEXT.format("filing_metadata", x) for x in ("earliest_transaction_date", "filing_date", "is_amendment"))
_RAW_STRUCT = "{" + ", ".join(f"'{k}': {v}" for k, v in zip(_FIELDS, [_number(k, v) if v in ("BIGINT", "DOUBLE") else f"TRY_CAST(json_extract_string(x, '$.{k}') AS BOOLEAN)" if v else f"json_extract_string(x, '$.{k}')" for k, v in _FIELDS.items()], strict=True)) + "}"
#: Every filing that either table can be read for, as f: source_file, filing_metadata, ticker, cik, person, transactions, footnotes.
BOTH = f"""
  mine AS (SELECT filing_metadata.source_file AS source_file, filing_metadata, issuer.ticker_symbol AS ticker_symbol, issuer.cik AS cik, reporting_person.name AS person, transactions, footnotes FROM form4 QUALIFY row_number() OVER (PARTITION BY filing_metadata.source_file ORDER BY parsed_timestamp DESC) = 1),
  texts AS (SELECT p, json_extract_string(p, '$.filing_metadata.source_file') AS source_file FROM (SELECT TRY_CAST(payload AS JSON) AS p FROM form4_raw WHERE json_valid(payload) AND payload LIKE '{{%') QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY CAST(p AS VARCHAR)) = 1),
  read AS (SELECT source_file, {_META} AS filing_metadata, json_extract_string(p, '$.issuer.ticker_symbol') AS ticker_symbol, json_extract_string(p, '$.issuer.cik') AS cik, json_extract_string(p, '$.reporting_person.name') AS person,
    list_transform(CASE json_type(p, '$.transactions') WHEN 'ARRAY' THEN CAST(json_extract(p, '$.transactions') AS JSON[]) WHEN 'OBJECT' THEN [json_extract(p, '$.transactions')] END, lambda x: CASE WHEN json_type(x) = 'OBJECT' THEN {_RAW_STRUCT} END) AS transactions,
    CASE json_type(p, '$.footnotes') WHEN 'ARRAY' THEN CAST(json_extract(p, '$.footnotes') AS VARCHAR[]) WHEN 'VARCHAR' THEN [json_extract_string(p, '$.footnotes')] END AS footnotes
    FROM texts WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM mine WHERE source_file IS NOT NULL)),
  f AS (SELECT * FROM mine WHERE source_file IS NOT NULL UNION ALL SELECT * FROM read)"""

#: The paths that shared inlining puts into the table of filings.
_INLINED = (
    "filing_metadata.earliest_transaction_date", "filing_metadata.filing_date", "filing_metadata.is_amendment", "filing_metadata.source_file", "issuer.company_name", "issuer.ticker_symbol", "issuer.cik", "reporting_person.name",
    "reporting_person.officer_title", "reporting_person.address.street", "reporting_person.address.city", "reporting_person.address.state", "reporting_person.address.zip", "total_transaction_value", "parsed_timestamp",
)


def _inlined(path: str) -> str:
    text = f"json_extract_string(p, '$.{path}')"
    return f"TRY_CAST({text} AS BOOLEAN)" if path.endswith("is_amendment") else f"TRY_CAST(trim(regexp_replace({text}, '[,$]', '', 'g')) AS DOUBLE)" if path.startswith("total") else text


ORACLE: dict[str, str] = {
    "p4_found": rf"""WITH {NEWS_TIMES}, {FILINGS},
  dates AS (SELECT source_file, position, t.transaction_date AS raw FROM theirs WHERE t IS NOT NULL UNION ALL SELECT source_file, position, json_extract_string(x, '$.transaction_date') FROM opened WHERE json_type(x) = 'OBJECT'),
  plain AS (SELECT *, strftime({_DATE}, '%Y-%m-%d') AS f FROM (SELECT *, upper(trim(raw)) AS d FROM dates)),
  units AS (SELECT tick_id, timestamp, CASE WHEN timestamp BETWEEN 1000000000 AND 9999999999 THEN timestamp * 1000 WHEN timestamp BETWEEN 1000000000000000 AND 9999999999999999 THEN timestamp // 1000 WHEN timestamp >= 1000000000000000000 THEN timestamp // 1000000 END AS ms
    FROM ticks QUALIFY row_number() OVER (PARTITION BY tick_id ORDER BY time) = 1)
SELECT 'news' AS src, CAST(news_id AS VARCHAR) AS row_key, {_iso("ms")} AS normal_form FROM news_times WHERE ms IS NOT NULL AND NOT regexp_full_match(published_at, '\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}\.\d{{6}}Z')
UNION ALL SELECT 'ticks', CAST(tick_id AS VARCHAR), {_iso("ms")} FROM units WHERE ms IS NOT NULL
UNION ALL SELECT 'form4', source_file || '#' || position, f FROM plain WHERE f IS NOT NULL AND f <> raw""",
    "p7_filings": f"""WITH mine AS (SELECT *, filing_metadata.source_file AS source_file FROM form4 QUALIFY row_number() OVER (PARTITION BY filing_metadata.source_file ORDER BY parsed_timestamp DESC) = 1),
  texts AS (SELECT p, json_extract_string(p, '$.filing_metadata.source_file') AS source_file FROM (SELECT TRY_CAST(payload AS JSON) AS p FROM form4_raw WHERE json_valid(payload) AND payload LIKE '{{%') QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY CAST(p AS VARCHAR)) = 1)
SELECT source_file, {", ".join(f"{x} AS {x.replace('.', '_')}" for x in _INLINED)} FROM mine WHERE source_file IS NOT NULL
UNION ALL SELECT source_file, {", ".join(_inlined(x) for x in _INLINED)} FROM texts WHERE source_file IS NOT NULL AND source_file NOT IN (SELECT source_file FROM mine WHERE source_file IS NOT NULL)""",
    "p7_transactions": f"""WITH {FILINGS}
SELECT source_file, CAST(position AS INTEGER) AS position, {", ".join(f"t.{k} AS {k}" for k in _FIELDS)} FROM theirs WHERE t IS NOT NULL
UNION ALL SELECT source_file, CAST(position AS INTEGER), {_RAW_FIELDS} FROM opened WHERE json_type(x) = 'OBJECT'""",
}
