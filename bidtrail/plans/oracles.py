"""The registered queries as ANSI SQL over the same tables, written on their own for checking."""

from __future__ import annotations

from ..functions.useragent import BROWSERS, SYSTEMS
from .logview import LOG_TYPES, RECENT_DAYS, USER_AGENTS
from ..operators.text import ENGLISH_STOP_WORDS
from ..schemas import FEATURE_OF_LOG_TYPE, RAW_LAYOUT, SERVED_BID_COLUMNS, SERVED_DICTIONARY_COLUMNS, UA_COLUMNS

_AGENT = "CASE event_id % 4 " + " ".join(f"WHEN {i} THEN '{text}'" for i, text in enumerate(USER_AGENTS)) + " END"
_TYPE_ID = "CASE event_type " + " ".join(f"WHEN '{e}' THEN {i}" for e, (i, _) in LOG_TYPES.items()) + " END"
_TYPE_NAME = "CASE event_type " + " ".join(f"WHEN '{e}' THEN '{n}'" for e, (_, n) in LOG_TYPES.items()) + " END"
_STAMP = "strftime(ts, '%Y%m%d%H%M%S') || lpad(CAST(CAST(floor(date_part('microsecond', ts) / 1000) AS BIGINT) % 1000 AS VARCHAR), 3, '0')"

# Events as log rows (without the 25-field specials of the raw lines).
_LOG = f"""
ev AS (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k FROM events),
log AS (
  SELECT event_id, user_id, k, event_type, ts, value,
    CAST(event_id AS VARCHAR) AS bid_id,
    {_STAMP} AS "timestamp",
    CAST(user_id AS VARCHAR) AS ipinyou_id,
    {_AGENT} AS user_agent,
    '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(k AS VARCHAR) AS ip,
    CAST(user_id % 35 AS INTEGER) AS region,
    CASE WHEN event_id % 5 = 0 THEN -1 - k ELSE k END AS ad_exchange_id,
    'site' || CAST(k % 10 AS VARCHAR) || '.example' AS domain,
    'http://site' || CAST(k % 10 AS VARCHAR) || '.example/' || CAST(k AS VARCHAR) AS url,
    CASE WHEN event_id % 2 = 1 THEN 'anon' || CAST(k AS VARCHAR) END AS anonymous_url_id,
    'slot' || CAST(k % 7 AS VARCHAR) AS ad_slot_id,
    CAST(CASE WHEN event_id % 11 <> 0 THEN 100 + (k % 5) * 50 END AS INTEGER) AS ad_slot_width,
    CAST(CASE WHEN event_id % 13 <> 0 THEN 50 + (k % 3) * 25 END AS INTEGER) AS ad_slot_height,
    CAST(event_id % 3 AS INTEGER) AS ad_slot_visibility,
    CAST(event_id % 2 AS INTEGER) AS ad_slot_format,
    CAST(k * 10 AS BIGINT) AS ad_slot_floor_price,
    'cr' || CAST(k AS VARCHAR) AS creative_id,
    CAST(value AS FLOAT) AS bidding_price,
    CAST(1000 + user_id % 50 AS BIGINT) AS advertiser_id,
    CASE WHEN event_id % 10 = 7 THEN NULL
         WHEN event_id % 4 = 0 THEN CAST(k AS VARCHAR)
         WHEN event_id % 4 = 1 THEN '0' || CAST(k AS VARCHAR)
         WHEN event_id % 4 = 2 THEN CAST(k AS VARCHAR) || ',' || CAST(k + 1 AS VARCHAR)
         ELSE '9' || lpad(CAST(k AS VARCHAR), 14, '0') END AS user_tags,
    CAST({_TYPE_ID} AS INTEGER) AS log_type_id,
    {_TYPE_NAME} AS log_type_name,
    CAST(CASE WHEN event_id % 6 <> 0 THEN value / 2 END AS FLOAT) AS paying_price,
    CASE WHEN event_id % 3 = 0 THEN 'http://key.example/' || CAST(k AS VARCHAR) END AS key_page_url,
    CASE WHEN event_id % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS predict
  FROM ev
)"""

_PLACES = """
city AS (
  SELECT n_nationkey AS city_id, n_name AS city_name, n_regionkey AS state_id,
    CAST((n_nationkey + 1) * 1000 AS BIGINT) AS population,
    CAST(n_nationkey * 1.5 AS FLOAT) AS area, CAST(n_nationkey * 0.25 AS FLOAT) AS density,
    CAST(CASE WHEN n_nationkey % 7 <> 3 THEN n_nationkey * 1.25 - 10 END AS FLOAT) AS latitude,
    CAST(n_regionkey * 10.5 - n_nationkey AS FLOAT) AS longitude
  FROM nation
),
state AS (
  SELECT r_regionkey AS state_id, r_name AS state_name,
    CAST((r_regionkey + 1) * 1000000 AS BIGINT) AS state_population,
    CAST((r_regionkey + 1) * 5000 AS BIGINT) AS state_gsp
  FROM region
),
exchange AS (
  SELECT CAST(s_suppkey AS INTEGER) AS ad_exchange_id, s_name AS ad_exchange_name,
    'nation ' || CAST(s_nationkey AS VARCHAR) AS ad_exchange_desc
  FROM supplier
),
keyword AS (
  SELECT p_partkey AS keyword_id, p_name AS keyword_name FROM part
  UNION ALL SELECT s_suppkey, s_name FROM supplier
),
placed AS (
  SELECT log.*, CAST(CASE WHEN event_id % 9 = 0 THEN -1 ELSE coalesce(c_nationkey, -1) END AS INTEGER) AS city_id
  FROM log LEFT JOIN customer ON c_custkey = user_id
)"""

_WITH = f"WITH {_LOG},{_PLACES}"

_RECENT = f"""
hist AS (SELECT bid_id, ipinyou_id, "timestamp", log_type_name, user_tags AS keyword_name FROM log),
since AS (SELECT max(ts) - INTERVAL {RECENT_DAYS} DAYS AS ts FROM events),
since_text AS (SELECT {_STAMP} AS start FROM since),
batch AS (SELECT * FROM hist WHERE "timestamp" >= (SELECT start FROM since_text)),
cutoffs AS (SELECT ipinyou_id, max("timestamp") AS cutoff FROM batch GROUP BY ipinyou_id)"""

_FEATURE_INPUT = {
    feature: f"CASE WHEN log_type_name = '{name}' THEN keyword_name ELSE '0' END"
    for name, feature in FEATURE_OF_LOG_TYPE.items()
}
_FEATURES = f"""
features AS (
  SELECT h.ipinyou_id, {", ".join(f"max({e}) AS {f}" for f, e in _FEATURE_INPUT.items())}
  FROM hist h JOIN cutoffs c ON h.ipinyou_id = c.ipinyou_id AND c.cutoff >= h."timestamp"
  GROUP BY h.ipinyou_id
)"""
_HISTORY = f"WITH {_LOG},{_RECENT}"
_FEATURED = f"{_HISTORY},{_FEATURES}"
_FEATURE_LIST = ", ".join(_FEATURE_INPUT)

_FLOATS = {"bidding_price", "paying_price", "area", "density", "latitude", "longitude"}


def _out(names: list[str], prefix: str = "", replace: dict[str, str] | None = None) -> str:
    """Select list with floats as doubles."""
    items = []
    for name in names:
        source = (replace or {}).get(name, f'{prefix}"{name}"')
        items.append(f'CAST({source} AS DOUBLE) AS "{name}"' if name in _FLOATS else f'{source} AS "{name}"')
    return ", ".join(items)


_POINT = """CAST(CASE WHEN latitude IS NULL OR longitude IS NULL THEN 0 ELSE longitude END AS DOUBLE) AS coordinates0,
CAST(CASE WHEN latitude IS NULL OR longitude IS NULL THEN 0 ELSE latitude END AS DOUBLE) AS coordinates1"""

_UA = {
    "ua_browser": ["CHROME21", "ANDROID_WEBKIT", "IE8", "CHROME21"],
    "ua_browser_group": ["CHROME", "ANDROID_WEBKIT", "IE", "CHROME"],
    "ua_browser_manufacturer": ["GOOGLE", "GOOGLE", "MICROSOFT", "GOOGLE"],
    "ua_browser_rendering_engine": ["WEBKIT", "WEBKIT", "TRIDENT", "WEBKIT"],
    "ua_browser_version": [None, 4.0, 8.0, None],
    "ua_browser_version_minor": [0, 0, 0, 0],
    "ua_browser_version_major": [21, 4, 8, 21],
    "ua_id": [130002105, 140000413, 90000808, 130002108],
    "ua_os": ["WINDOWS_7", "ANDROID4", "WINDOWS_XP", "WINDOWS_XP"],
    "ua_os_name": ["Windows 7", "Android 4.x", "Windows XP", "Windows XP"],
    "ua_os_device": ["COMPUTER", "MOBILE", "COMPUTER", "COMPUTER"],
    "ua_os_group": ["WINDOWS", "ANDROID", "WINDOWS", "WINDOWS"],
    "ua_os_manufacturer": ["MICROSOFT", "GOOGLE", "MICROSOFT", "MICROSOFT"],
    "ua_browser_type": ["WEB_BROWSER", "MOBILE_BROWSER", "WEB_BROWSER", "WEB_BROWSER"],
}


def _ua_case(name: str) -> str:
    def literal(value):
        if value is None:
            return "NULL"
        return f"'{value}'" if isinstance(value, str) else str(value)

    cells = " ".join(f"WHEN {i} THEN {literal(v)}" for i, v in enumerate(_UA[name]))
    kind = {"ua_browser_version": "DOUBLE"}.get(name, "INTEGER" if isinstance(_UA[name][0], int) else "VARCHAR")
    return f"CAST(CASE event_id % 4 {cells} END AS {kind})"


_UA_SERVED = ", ".join(f"{_ua_case(n)} AS {n}" for n in _UA if n != "ua_browser_type")

_DICTIONARY_OUT = f"""
  x.ad_exchange_name, x.ad_exchange_desc, p.log_type_name, c.city_name, c.population,
  CAST(c.area AS DOUBLE) AS area, CAST(c.density AS DOUBLE) AS density, {_POINT},
  s.state_name, s.state_population, s.state_gsp"""
_DICTIONARY_JOIN = """
FROM placed p
JOIN city c ON p.city_id = c.city_id
LEFT JOIN state s ON c.state_id = s.state_id
LEFT JOIN exchange x ON p.ad_exchange_id = x.ad_exchange_id
LEFT JOIN keyword w ON TRY_CAST(p.user_tags AS BIGINT) = w.keyword_id"""
_SIZE = "coalesce(CAST(ad_slot_width AS VARCHAR) || 'x' || CAST(ad_slot_height AS VARCHAR), 'Unknown') AS ad_slot_size"

# A raw line as text fields, and what is wrong with it.
_CUT = "event_id % 17 = 0"


def _raw_field(name: str, as_text: bool) -> str:
    late = RAW_LAYOUT.index(name) >= 20
    value = f'CAST("{name}" AS VARCHAR)' if as_text else f'"{name}"'
    if as_text or name in ("anonymous_url_id", "user_tags", "key_page_url"):
        value = f"coalesce({value}, '')"
    if not as_text and name in _FLOATS:
        value = f"CAST({value} AS DOUBLE)"
    return f'CASE WHEN {_CUT} THEN NULL ELSE {value} END AS "{name}"' if late else f'{value} AS "{name}"'


_REASON = f"CASE WHEN {_CUT} THEN 'too few fields' END AS reject_reason"

_LINE = "concat_ws(chr(9), bid_id, \"timestamp\", ipinyou_id, user_agent, ip, domain, url)"
_MILLIS = "CAST(floor(epoch_us(ts) / 1000) AS BIGINT)"
_UPSERT_ROWS = """
daily AS (SELECT ipinyou_id, substr("timestamp", 1, 8) AS log_date, "timestamp", event_id AS arrival, user_tags FROM log)"""
_STOP = ", ".join(f"'{w}'" for w in ENGLISH_STOP_WORDS)
_SERVED = f"""
SELECT b.bid_id, b.ipinyou_id, b."timestamp", {_FEATURE_LIST},
  CASE WHEN CAST(bid_id AS BIGINT) % 4 >= 2 THEN 'TRUE' ELSE 'FALSE' END AS predict,
  CASE WHEN CAST(bid_id AS BIGINT) % 4 <> 3 THEN (CAST(bid_id AS BIGINT) % 4) / 4.0 END AS true_prob,
  CASE WHEN CAST(bid_id AS BIGINT) % 4 <> 3 THEN 1 - (CAST(bid_id AS BIGINT) % 4) / 4.0 END AS false_prob
FROM hist b LEFT JOIN everything f ON b.ipinyou_id = f.ipinyou_id"""
_EVERYTHING = f"""
everything AS (SELECT ipinyou_id, {", ".join(f"max({e}) AS {f}" for f, e in _FEATURE_INPUT.items())} FROM hist GROUP BY ipinyou_id)"""


def _text(name: str) -> str:
    """A served column as text; fractions as the numbers that their texts mean."""
    if name == "coordinates":
        return "coordinates0, coordinates1"
    if name in _FLOATS or name == "ua_browser_version":
        return f'CAST("{name}" AS DOUBLE) AS "{name}"' if name == "ua_browser_version" else f'CAST(CAST(CAST("{name}" AS FLOAT) AS VARCHAR) AS DOUBLE) AS "{name}"'
    return f'CAST("{name}" AS VARCHAR) AS "{name}"'


ORACLES: dict[str, str] = {
    "scan_typed_tsv": "SELECT event_id, user_id, event_type, value, props FROM events",
    "tsv_roundtrip": "SELECT event_id, user_id, event_type, value, props FROM events",
    "scan_untyped_tsv": """SELECT CAST(event_id AS VARCHAR) AS _c0, CAST(user_id AS VARCHAR) AS _c1,
        event_type AS _c2, props AS _c3 FROM events""",
    "scan_log_dir": f"""{_WITH} SELECT bid_id, "timestamp", ipinyou_id, user_agent, ip, region, city_id, ad_exchange_id,
        domain, url, anonymous_url_id, ad_slot_id, ad_slot_width, ad_slot_height, ad_slot_visibility, ad_slot_format,
        ad_slot_floor_price, creative_id, CAST(bidding_price AS DOUBLE) AS bidding_price, advertiser_id, user_tags,
        log_type_id, CAST(paying_price AS DOUBLE) AS paying_price, predict, substr("timestamp", 1, 8) AS log_date
        FROM placed""",
    "publish_lines": f"WITH {_LOG} SELECT {_LINE} AS value FROM log",
    "parse_log_line": f"{_WITH} SELECT {', '.join(_raw_field(n, False) for n in RAW_LAYOUT)}, {_REASON} FROM placed",
    "parse_log_line_strings": f"{_WITH} SELECT {', '.join(_raw_field(n, True) for n in RAW_LAYOUT)}, {_REASON} FROM placed",
    "typed_casts": """WITH ev AS (SELECT *, regexp_extract(props, '[0-9]+') AS k FROM events)
        SELECT event_id,
          CASE WHEN event_id % 3 <> 0 THEN CAST(k AS INTEGER) END AS as_int,
          CASE WHEN event_id % 3 <> 0 THEN CAST(k AS BIGINT) * 100000000000 END AS as_long,
          CASE WHEN event_id % 3 <> 0 THEN CAST(k || '.5' AS DOUBLE) END AS as_float,
          CASE WHEN event_id % 3 <> 0 THEN CAST(k || '.25' AS DOUBLE) END AS as_double,
          event_id % 3 = 0 AS as_boolean,
          CASE WHEN event_id % 50000 <= 32767 THEN CAST(event_id % 50000 AS INTEGER) END AS as_short,
          CASE WHEN event_id % 300 <= 127 THEN CAST(event_id % 300 AS INTEGER) END AS as_byte,
          upper(hex(event_type)) AS as_binary,
          CASE WHEN event_id % 3 <> 0 THEN '2024010' || CAST(event_id % 9 + 1 AS VARCHAR) || '100000000' END AS as_time,
          k || '|b' AS as_texts,
          CAST(k || '.5' AS DOUBLE) + user_id % 8 AS as_floats
        FROM ev""",
    "filter_nonempty": "SELECT event_id, props AS value FROM events WHERE event_id % 10 <> 0 AND props <> ''",
    "stream_log_source": """SELECT CAST(user_id AS VARCHAR) AS key, props AS value, 'events' AS topic,
        CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events""",
    "stream_term_filter": "SELECT conv_id, turn, role, text FROM conversations WHERE contains(lower(text), 'the')",
    "raw_landing": "SELECT 36 AS key_length, props AS value FROM events",
    "bounded_offset_read": """SELECT CAST(user_id AS VARCHAR) AS key, props AS value, 'events' AS topic,
        CAST(user_id % 4 AS INTEGER) AS partition, event_id AS "offset" FROM events
        WHERE user_id % 4 = 1 AND event_id >= 100 ORDER BY event_id LIMIT 50""",
    "offset_ranges": """SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition,
        min(event_id) AS from_offset, max(event_id) + 1 AS until_offset FROM events GROUP BY user_id % 4""",
    "cell_layout": f"""SELECT 'ts' || CAST({_MILLIS} AS VARCHAR) || '-' || CAST(user_id % 4 AS VARCHAR) || '-' ||
        CAST(event_id AS VARCHAR) AS row_key, 'flume_data' AS col_family, 'col1' AS col_qual, props AS value FROM events""",
    "serving_read": f"""{_HISTORY},{_EVERYTHING}, served AS ({_SERVED}), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY ipinyou_id, "timestamp" ORDER BY bid_id DESC) AS rn FROM served)
        SELECT ipinyou_id, "timestamp", {_FEATURE_LIST}, false_prob, true_prob, predict FROM ranked WHERE rn = 1""",
    "serving_schema": f"""{_HISTORY},{_EVERYTHING}, served AS ({_SERVED})
        SELECT served.bid_id, {_MILLIS} AS event_millis, served.predict, coalesce(false_prob, 0.0) AS false_prob,
        coalesce(true_prob, 0.0) AS true_prob FROM served JOIN log ON served.bid_id = log.bid_id""",
    "serving_overwrite": f"""{_WITH} SELECT {_out(SERVED_BID_COLUMNS, "p.")}, {_DICTIONARY_OUT},
        coalesce(w.keyword_name, p.user_tags) AS keyword_name, p.predict {_DICTIONARY_JOIN}""",
    "serving_upsert": f"""WITH {_LOG},{_RECENT},{_UPSERT_ROWS}, arrivals AS (
        SELECT *, 0 AS b FROM daily UNION ALL
        SELECT ipinyou_id, log_date, "timestamp", arrival, 'new:' || coalesce(user_tags, 'none'), 1 FROM daily
        WHERE "timestamp" >= (SELECT start FROM since_text)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY ipinyou_id, log_date ORDER BY b DESC, arrival DESC) AS rn FROM arrivals)
        SELECT ipinyou_id, log_date, "timestamp", arrival, user_tags FROM ranked WHERE rn = 1""",
    "serving_delete": f"""WITH {_LOG},{_UPSERT_ROWS} SELECT * FROM daily WHERE ipinyou_id NOT IN (
        SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)""",
    "daily_routing": f"""WITH {_LOG} SELECT bid_id, 'log_' || substr("timestamp", 1, 8) || '/bid' AS index_name,
        substr("timestamp", 1, 8) AS log_date FROM log""",
    "json_documents": f"""{_WITH} SELECT p.bid_id, coalesce(w.keyword_name, p.user_tags) AS keyword_name, c.city_name,
        CAST(CASE WHEN latitude IS NULL OR longitude IS NULL THEN 0 ELSE longitude END AS DOUBLE) AS longitude,
        p.anonymous_url_id IS NOT NULL AS has_anonymous_url, x.ad_exchange_name IS NOT NULL AS has_exchange
        {_DICTIONARY_JOIN}""",
    "keyword_terms": f"""WITH {_LOG},{_PLACES}, terms AS (
        SELECT keyword_id, unnest(regexp_split_to_array(lower(keyword_name), '[^\\p{{L}}\\p{{N}}]+')) AS term FROM keyword)
        SELECT keyword_id, term FROM terms WHERE term <> '' AND term NOT IN ({_STOP})""",
    "enrich_bid_log": f"""{_WITH} SELECT {_out(SERVED_BID_COLUMNS, "p.")}, {_DICTIONARY_OUT},
        coalesce(w.keyword_name, p.user_tags) AS keyword_name, {_SIZE}, p.predict, {_UA_SERVED} {_DICTIONARY_JOIN}""",
    "enrich_index_doc": f"""{_WITH} SELECT
        {", ".join(f'{chr(34)}{n}{chr(34)}' if n in ("bid_id", "timestamp", "ipinyou_id", "user_agent", "ip", "domain", "url")
                   else f"coalesce(CAST(p.{n} AS VARCHAR), '') AS {n}"
                   for n in RAW_LAYOUT if n not in ("ad_exchange_id", "log_type_id", "city_id", "region"))},
        CASE WHEN p.user_tags LIKE '%,%' THEN replace(p.user_tags, ',', '|') ELSE coalesce(p.user_tags, '') END AS user_tags_array,
        c.state_id, c.city_id, c.city_name, c.population, CAST(c.area AS DOUBLE) AS area, CAST(c.density AS DOUBLE) AS density,
        CAST(c.latitude AS DOUBLE) AS latitude, CAST(c.longitude AS DOUBLE) AS longitude,
        s.state_name, s.state_population, s.state_gsp,
        x.ad_exchange_id, x.ad_exchange_name, x.ad_exchange_desc, p.log_type_id, p.log_type_name, {_POINT}, {_UA_SERVED}
        FROM placed p JOIN city c ON p.city_id = c.city_id LEFT JOIN state s ON c.state_id = s.state_id
        LEFT JOIN exchange x ON p.ad_exchange_id = x.ad_exchange_id WHERE NOT ({_CUT})""",
    "join_dim_left": f"""{_WITH} SELECT bid_id, log.ad_exchange_id, ad_exchange_name, ad_exchange_desc, log_type_name
        FROM log LEFT JOIN exchange ON log.ad_exchange_id = exchange.ad_exchange_id""",
    "join_city_inner": f"""{_WITH} SELECT bid_id, {_out(["city_id", "city_name", "state_id", "population", "area",
        "density", "latitude", "longitude"], "city.")} FROM placed JOIN city ON placed.city_id = city.city_id""",
    "join_snowflake": f"""{_WITH} SELECT bid_id, city_name, city.state_id, state_name, state_population, state_gsp
        FROM placed JOIN city ON placed.city_id = city.city_id LEFT JOIN state ON city.state_id = state.state_id""",
    "join_keyword": f"""{_WITH} SELECT bid_id, user_tags, keyword_id, keyword_name FROM log
        LEFT JOIN keyword ON TRY_CAST(user_tags AS BIGINT) = keyword_id""",
    "keyword_fallback": f"""{_WITH} SELECT bid_id, user_tags, coalesce(keyword_name, user_tags) AS keyword_name FROM log
        LEFT JOIN keyword ON TRY_CAST(user_tags AS BIGINT) = keyword_id""",
    "keyword_dictionary": """SELECT p_partkey AS keyword_id, p_name AS keyword_name FROM part
        UNION ALL SELECT s_suppkey, s_name FROM supplier""",
    "history_semi_join": f"{_HISTORY} SELECT * FROM hist WHERE ipinyou_id IN (SELECT ipinyou_id FROM batch)",
    "history_range_join": f"""{_HISTORY} SELECT h.ipinyou_id, h."timestamp" AS hist_timestamp,
        h.keyword_name AS hist_keyword_name, h.log_type_name AS hist_log_type_name
        FROM hist h JOIN cutoffs c ON h.ipinyou_id = c.ipinyou_id AND c.cutoff >= h."timestamp" """,
    "user_keyword_pivot": f"{_FEATURED} SELECT * FROM features",
    "attach_features": f"""{_FEATURED} SELECT b.ipinyou_id, b.bid_id, b."timestamp", b.log_type_name, b.keyword_name,
        {_FEATURE_LIST} FROM batch b LEFT JOIN features f ON b.ipinyou_id = f.ipinyou_id""",
    "user_keyword_asof": f"""{_HISTORY} SELECT bid_id, ipinyou_id, "timestamp", {", ".join(
        f'max({e}) OVER (PARTITION BY ipinyou_id ORDER BY "timestamp" RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {f}'
        for f, e in _FEATURE_INPUT.items())} FROM hist""",
    "word_count": """WITH w AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
        ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM documents) SELECT word, count(*) AS n FROM w GROUP BY word""",
    "stream_word_count": """WITH w AS (SELECT unnest(CASE WHEN text = '' THEN [''] WHEN rtrim(text, ' ') = '' THEN []
        ELSE string_split(rtrim(text, ' '), ' ') END) AS word FROM conversations) SELECT word, count(*) AS n FROM w GROUP BY word""",
    "row_count": "SELECT count(*) AS n FROM documents",
    "geo_point": f"WITH {_LOG},{_PLACES} SELECT city_id, {_POINT} FROM city",
    "ad_slot_size": """SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size AS VARCHAR) || 'x' ||
        CAST(p_size * 2 AS VARCHAR) ELSE 'Unknown' END AS ad_slot_size FROM part""",
    "user_tags_array": """WITH ev AS (SELECT *, regexp_extract(props, '[0-9]+') AS k FROM events)
        SELECT event_id, CASE event_id % 5 WHEN 0 THEN 2 WHEN 1 THEN 0 WHEN 2 THEN 1 WHEN 3 THEN 4 END AS n_tags,
        CASE event_id % 5 WHEN 0 THEN k || '|b' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN '|a||' || k END AS tags FROM ev""",
    "event_time": f"""SELECT event_id, CASE event_id % 7 WHEN 0 THEN 'null' WHEN 1 THEN '' ELSE {_STAMP} END AS text,
        CASE WHEN event_id % 7 > 1 THEN {_MILLIS} END AS millis FROM events""",
    "ua_enrich": f"WITH {_LOG} SELECT bid_id, user_agent, {', '.join(f'{_ua_case(n)} AS {n}' for n in _UA)} FROM log",
    "ua_enrich_tsv": f"""WITH {_LOG} SELECT bid_id AS _c0, "timestamp" AS _c1, ipinyou_id AS _c2, ip AS _c3,
        user_agent AS _c4, {_ua_case("ua_browser")} AS _c5,
        CASE event_id % 4 WHEN 1 THEN '4.0' WHEN 2 THEN '8.0' ELSE '21.0.1180.89' END AS _c6,
        CAST({_ua_case("ua_id")} AS VARCHAR) AS _c7, {_ua_case("ua_os")} AS _c8 FROM log""",
    "stream_enrich": f"""{_WITH} SELECT {_out(SERVED_BID_COLUMNS, "p.", {"anonymous_url_id": "coalesce(p.anonymous_url_id, '')"})},
        {_DICTIONARY_OUT}, coalesce(w.keyword_name, p.user_tags, '') AS keyword_name, {_SIZE}, {_UA_SERVED} {_DICTIONARY_JOIN}""",
    "stream_rejects": f"""{_WITH} SELECT bid_id, ipinyou_id, "timestamp",
        CASE WHEN event_id % 17 = 0 THEN ad_slot_width END AS ad_slot_width, ad_slot_height,
        CASE WHEN event_id % 17 = 0 THEN 'too few fields' ELSE 'bad value: ad_slot_width' END AS reject_reason
        FROM log WHERE event_id % 17 = 0 OR event_id % 23 = 0""",
    "keyword_stream_docs": f"""{_WITH} SELECT p.bid_id, p.ipinyou_id, coalesce(w.keyword_name, p.user_tags, '') AS keyword_name,
        c.city_name, s.state_name, p.log_type_name, p.ad_slot_width IS NOT NULL AS has_width {_DICTIONARY_JOIN}""",
    "log_folder_job": f"""{_WITH} SELECT {_out(SERVED_BID_COLUMNS, "p.", {"anonymous_url_id": "coalesce(p.anonymous_url_id, '')"})},
        {_DICTIONARY_OUT}, coalesce(w.keyword_name, p.user_tags, '') AS keyword_name, p.predict,
        substr(p."timestamp", 1, 8) AS log_date, {_UA_SERVED} {_DICTIONARY_JOIN}""",
    "serving_text_row": f"""{_WITH}, served AS (SELECT {_out(SERVED_BID_COLUMNS, "p.")}, {_DICTIONARY_OUT},
        coalesce(w.keyword_name, p.user_tags) AS keyword_name, {_UA_SERVED}, p.predict {_DICTIONARY_JOIN})
        SELECT {", ".join(_text(n) for n in [*SERVED_BID_COLUMNS, *SERVED_DICTIONARY_COLUMNS, *UA_COLUMNS])},
        predict, CAST(NULL AS VARCHAR) AS false_prob, CAST(NULL AS VARCHAR) AS true_prob,
        {", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in FEATURE_OF_LOG_TYPE.values())} FROM served""",
    "train_lead_model": f"""{_WITH},{_RECENT} SELECT count(*) AS n,
        CAST(count(*) FILTER (p.log_type_name = 'site-lead') AS BIGINT) AS leads, TRUE AS loss_fell
        {_DICTIONARY_JOIN} WHERE p."timestamp" >= (SELECT start FROM since_text)""",
    "score_leads": f"""{_WITH} SELECT p.bid_id, p.ipinyou_id, p."timestamp",
        CASE WHEN p.log_type_name = 'site-lead' THEN 1 ELSE 0 END AS label, TRUE AS adds_up, TRUE AS larger_wins {_DICTIONARY_JOIN}""",
    "mispredictions": f"""{_WITH}, rows AS (SELECT CASE WHEN p.log_type_name = 'site-lead' THEN 'TRUE' ELSE 'FALSE' END AS actual
        {_DICTIONARY_JOIN}) SELECT actual, count(*) AS n, TRUE AS errors_add_up,
        TRUE AS no_worse_than_one_class FROM rows GROUP BY actual""",
    "train_boosted_trees": """SELECT CAST(label AS INTEGER) AS actual, count(*) AS n, TRUE AS errors_add_up,
        TRUE AS beats_one_class FROM embeddings GROUP BY label""",
    "train_from_file": """SELECT CAST(label AS INTEGER) AS actual, count(*) AS n, TRUE AS errors_add_up,
        TRUE AS beats_one_class FROM embeddings GROUP BY label""",
    "classify_titles": """SELECT conv_id, turn, '"' || text AS quoted, TRUE AS adds_up, TRUE AS larger_wins
        FROM conversations WHERE text <> ''""",
    "stream_score": f"""{_WITH}, since AS (SELECT max(ts) - INTERVAL {RECENT_DAYS} DAYS AS ts FROM events),
        since_text AS (SELECT {_STAMP} AS start FROM since),
        served AS (SELECT p.event_id, p.ipinyou_id, p."timestamp", p.log_type_name,
          coalesce(w.keyword_name, p.user_tags, '') AS keyword_name,
          CASE WHEN p."timestamp" < (SELECT start FROM since_text) THEN -1 ELSE p.event_id % 3 END AS b {_DICTIONARY_JOIN}),
        {",".join(f"""
        cut{b} AS (SELECT ipinyou_id, max("timestamp") AS cutoff FROM served WHERE b = {b} GROUP BY ipinyou_id),
        past{b} AS (SELECT *, rank() OVER (PARTITION BY ipinyou_id, "timestamp" ORDER BY b DESC, event_id DESC) AS r FROM served WHERE b < {b}),
        known{b} AS (SELECT h.ipinyou_id, {", ".join(f"max({e}) AS {f}" for f, e in _FEATURE_INPUT.items())}
          FROM past{b} h JOIN cut{b} c ON h.ipinyou_id = c.ipinyou_id AND h."timestamp" <= c.cutoff WHERE r = 1 GROUP BY h.ipinyou_id)"""
        for b in range(3))},
        scored AS (
          SELECT event_id, ipinyou_id, "timestamp", b, {", ".join(f"CAST(NULL AS VARCHAR) AS {f}" for f in _FEATURE_INPUT)} FROM served WHERE b = -1
          {" ".join(f'UNION ALL SELECT event_id, s.ipinyou_id, "timestamp", b, {_FEATURE_LIST} FROM served s LEFT JOIN known{b} k ON s.ipinyou_id = k.ipinyou_id WHERE b = {b}' for b in range(3))}),
        final AS (SELECT *, rank() OVER (PARTITION BY ipinyou_id, "timestamp" ORDER BY b DESC, event_id DESC) AS r FROM scored)
        SELECT ipinyou_id, "timestamp", {_FEATURE_LIST}, TRUE AS adds_up, TRUE AS larger_wins FROM final WHERE r = 1""",
}


def _rule_query() -> str:
    """User-agent columns from the rule tables by one CASE a column, over texts put together in SQL."""
    def quoted(value) -> str:
        return "NULL" if value is None else f"'{value}'"

    def chain(rules: list[tuple], of) -> str:
        return "CASE " + " ".join("WHEN " + " AND ".join(f"contains(low, '{m.lower()}')" for m in r[1]) + f" THEN {of(i, r)}" for i, r in enumerate(rules)) + " END"

    starts = [" ".join([*[m for m in r[1] if m != r[2]], r[2]]) for r in BROWSERS] + ["Thing/"]
    ends = [" ".join(r[1]) for r in SYSTEMS] + ["Other"]
    start = f"CASE event_id % {len(starts)} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(starts)) + " END"
    end = f"CASE (event_id // {len(starts)}) % {len(ends)} " + " ".join(f"WHEN {i} THEN '{t}'" for i, t in enumerate(ends)) + " END"
    version = "CASE event_id % 3 WHEN 0 THEN k || '.1.2' WHEN 1 THEN k || '.7' ELSE k END"
    named = {"ua_browser_group": 3, "ua_browser_type": 5, "ua_browser_manufacturer": 6, "ua_browser_rendering_engine": 7}
    systems = {"ua_os": 0, "ua_os_name": 2, "ua_os_device": 3, "ua_os_group": 4, "ua_os_manufacturer": 5}
    return f"""WITH ev AS (SELECT event_id, regexp_extract(props, '[0-9]+') AS k FROM events),
        made AS (SELECT event_id, {start} || {version} || '; ' || {end} AS agent FROM ev),
        texts AS (SELECT CAST(event_id AS VARCHAR) AS bid_id, CASE WHEN event_id % 2 = 0 THEN upper(agent) ELSE agent END AS user_agent FROM made),
        low AS (SELECT *, lower(user_agent) AS low FROM texts),
        found AS (SELECT *, {chain(BROWSERS, lambda i, r: i)} AS b, {chain(SYSTEMS, lambda i, r: i)} AS s,
          {chain(BROWSERS, lambda i, r: quoted(r[2].lower()))} AS mark, {chain(BROWSERS, lambda i, r: str(r[4]).upper())} AS numbered FROM low),
        versions AS (SELECT *, CASE WHEN strpos(low, mark) > 0 THEN nullif(regexp_extract(substr(low, strpos(low, mark) + length(mark)), '^[0-9]+([.][0-9]+)*'), '') END AS v FROM found),
        split AS (SELECT *, split_part(v, '.', 1) AS major, split_part(v, '.', 2) AS minor, split_part(v, '.', 3) AS third FROM versions)
        SELECT bid_id, user_agent,
          {chain(BROWSERS, lambda i, r: quoted(r[0]))} || CASE WHEN numbered THEN coalesce(major, '') ELSE '' END AS ua_browser,
          {", ".join(f"{chain(BROWSERS, lambda i, r, p=p: quoted(r[p]))} AS {n}" for n, p in named.items())},
          {", ".join(f"{chain(SYSTEMS, lambda i, r, p=p: quoted(r[p]))} AS {n}" for n, p in systems.items())},
          CASE WHEN third = '' THEN CAST(v AS DOUBLE) END AS ua_browser_version,
          CAST(nullif(minor, '') AS INTEGER) AS ua_browser_version_minor, CAST(major AS INTEGER) AS ua_browser_version_major,
          CAST(CASE WHEN b IS NOT NULL OR s IS NOT NULL THEN (coalesce(b, -1) + 1) * 10000000 + coalesce(CAST(major AS INTEGER), 0) % 100000 * 100
            + coalesce(s, -1) + 1 END AS INTEGER) AS ua_id FROM split"""


ORACLES["ua_rules"] = _rule_query()
ORACLES["stream_index_doc"] = ORACLES["enrich_index_doc"]
ORACLES["stream_score_from_table"] = ORACLES["stream_score"]
ORACLES["stream_word_count_running"] = ORACLES["word_count"]

ORACLES["word_vectors"] = f"""
WITH texts AS (SELECT row_number() OVER () AS id, regexp_extract_all(lower(text), '([\\p{{L}}\\p{{N}}]+)') AS all_words FROM conversations),
cleaned AS (SELECT id, list_filter(all_words, lambda w: NOT list_contains({ENGLISH_STOP_WORDS}, w)) AS words FROM texts),
placed AS (SELECT id, unnest(words) AS word, unnest(range(len(words))) AS pos FROM cleaned),
hashed AS (SELECT *, CAST(('0x' || substr(md5(word), 1, 8)) AS BIGINT) % 4096 AS slot FROM placed),
counts AS (SELECT a.word, b.slot, count(*) AS n FROM hashed a JOIN hashed b ON a.id = b.id AND a.pos <> b.pos AND abs(a.pos - b.pos) <= 5 GROUP BY ALL),
sums AS (SELECT word, slot, n, sum(n) OVER (PARTITION BY word) AS n_word, sum(n) OVER (PARTITION BY slot) AS n_slot, sum(n) OVER () AS n_all FROM counts),
weights AS (SELECT word, slot, n_word, greatest(0, CAST(round(ln(greatest(CAST(n AS DOUBLE) * n_all / (CAST(n_word AS DOUBLE) * n_slot), 1)) * 1000) AS BIGINT)) AS weight FROM sums),
signs AS (SELECT slot, d, CASE WHEN substr(md5(slot || ':' || d), 1, 1) < '8' THEN -1 ELSE 1 END AS sign FROM range(4096) s(slot), range(64) t(d)),
projected AS (SELECT word, d, CAST(max(n_word) AS BIGINT) AS n, CAST(sum(weight * sign) AS BIGINT) AS v FROM weights JOIN signs USING (slot) GROUP BY word, d)
SELECT word, max(n) AS n, string_agg(CAST(v AS VARCHAR), '|' ORDER BY d) AS vector FROM projected GROUP BY word"""
ORACLES["title_vector_classes"] = """SELECT lang, count(*) AS n, TRUE AS mostly_right FROM documents
    WHERE doc_id % 4 = 0 AND lang IN ('en', 'fr', 'de', 'es') AND text <> '' GROUP BY lang"""
_CURVE = """counts AS (SELECT round(value, 1) AS threshold, count(*) FILTER (event_type = 'purchase') AS positives,
    count(*) FILTER (event_type <> 'purchase') AS negatives FROM events WHERE value IS NOT NULL AND event_type IS NOT NULL GROUP BY 1),
curve AS (SELECT threshold, positives, negatives, CAST(sum(positives) OVER w AS BIGINT) AS tp, CAST(sum(negatives) OVER w AS BIGINT) AS fp
    FROM counts WINDOW w AS (ORDER BY threshold DESC))"""
ORACLES["threshold_curve"] = f"WITH {_CURVE} SELECT * FROM curve"
ORACLES["ranking_report"] = f"""WITH {_CURVE},
totals AS (SELECT CAST(sum(positives) AS BIGINT) AS p, CAST(sum(negatives) AS BIGINT) AS n, sum(negatives * (2 * tp - positives)) AS twice FROM curve),
best AS (SELECT threshold, tp, fp, 2.0::DOUBLE * tp / (tp + fp + p) AS f1 FROM curve, totals ORDER BY f1 DESC, threshold DESC LIMIT 1)
SELECT p AS positives, n AS negatives, CAST(twice AS DOUBLE) / (2 * (CAST(p AS DOUBLE) * n)) AS auc, threshold, f1, tp, fp FROM totals, best"""
ORACLES["wrong_predictions"] = f"""WITH {_CURVE}, totals AS (SELECT CAST(sum(positives) AS BIGINT) AS p FROM curve),
best AS (SELECT threshold AS t FROM curve, totals ORDER BY 2.0::DOUBLE * tp / (tp + fp + p) DESC, threshold DESC LIMIT 1),
told AS (SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'TRUE' ELSE 'FALSE' END AS actual,
    CASE WHEN round(value, 1) >= t THEN 'TRUE' ELSE 'FALSE' END AS predicted FROM events, best WHERE value IS NOT NULL AND event_type IS NOT NULL)
SELECT event_id, actual || ' X ' || predicted AS wrong FROM told WHERE actual <> predicted"""
ORACLES["boost_softmax"] = """SELECT CAST(label AS INTEGER) AS actual, count(*) AS n, TRUE AS loss_fell, TRUE AS beats_one_class
    FROM embeddings GROUP BY label"""
ORACLES["lead_threshold"] = f"""{_WITH} SELECT count(*) FILTER (p.log_type_name = 'site-lead') AS positives,
    count(*) FILTER (p.log_type_name IS DISTINCT FROM 'site-lead') AS negatives, TRUE AS no_worse {_DICTIONARY_JOIN}"""
ORACLES["serving_lookup"] = f"""WITH {_LOG},{_UPSERT_ROWS} SELECT * FROM daily WHERE ipinyou_id IN (
    SELECT CAST(min(c_custkey) AS VARCHAR) FROM customer GROUP BY c_nationkey)"""
ORACLES["serving_delete_marks"] = ORACLES["serving_delete"]
ORACLES["keyword_positions"] = f"""WITH {_LOG},{_PLACES}, split AS (
    SELECT keyword_id, list_filter(string_split_regex(lower(keyword_name), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS words FROM keyword),
    tokens AS (SELECT keyword_id, unnest(words) AS term, CAST(unnest(range(1, len(words) + 1)) AS INTEGER) AS position FROM split)
    SELECT * FROM tokens WHERE NOT list_contains({ENGLISH_STOP_WORDS}, term)"""
ORACLES["cities_near_customers"] = f"""WITH {_LOG},{_PLACES}, pairs AS (
    SELECT c_custkey, city_id, c_custkey * 7919 % 18001 / 100 - 90 AS lat, c_custkey * 104729 % 36001 / 100 - 180 AS lon,
      CAST(latitude AS DOUBLE) AS city_lat, CAST(longitude AS DOUBLE) AS city_lon FROM customer, city WHERE latitude IS NOT NULL),
    measured AS (SELECT *, 2 * 6371.0088::DOUBLE * asin(sqrt(least(1.0, pow(sin(radians(city_lat - lat) / 2), 2)
      + cos(radians(lat)) * cos(radians(city_lat)) * pow(sin(radians(city_lon - lon) / 2), 2)))) AS km FROM pairs)
    SELECT c_custkey, city_id, round(km, 3) AS km FROM measured WHERE km <= 800"""
ORACLES["offset_ledger"] = """WITH m AS (SELECT CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS o FROM events),
    ranges AS (SELECT "partition", min(o) AS f, max(o) + 1 AS u FROM m WHERE o % 10000 < 6000 GROUP BY "partition", o // 1000
      UNION ALL SELECT "partition", min(o), max(o) + 1 FROM m WHERE o % 10000 < 9000 GROUP BY "partition", o // 1700),
    reached AS (SELECT *, max(u) OVER (PARTITION BY "partition" ORDER BY f, u ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ranges)
    SELECT 'events' AS topic, "partition", CASE WHEN r < f THEN 'gap' ELSE 'repeat' END AS kind, least(r, f) AS from_offset,
      CASE WHEN r < f THEN f ELSE least(r, u) END AS until_offset FROM reached WHERE r <> f"""
