"""DuckDB SQL computing the same results as :mod:`cartwheel.plans.queries`.

Used only as an independent check (the driver registers the test tables as views).
The adapters of :mod:`cartwheel.sources.fixtures` are restated here as CTEs; a Silver
run over one micro-batch equals "valid rows, one per id", and duplicates in the log
are exact copies, so ``SELECT DISTINCT`` over the compared columns is the dedup.

Numeric hygiene: Spark's ``round(double, 2)`` rounds the shortest decimal text of the
double half-up, so the oracle rounds ``CAST(CAST(x AS VARCHAR) AS DECIMAL)``; sums of
money are exact decimals in both engines; SUM over integers is cast to BIGINT.
"""

from __future__ import annotations


def pct(num: str, den: str) -> str:
    x = f"CAST({num} AS DOUBLE) / NULLIF({den}, 0) * 100"
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def count_type(t: str) -> str:
    return f"CAST(sum(CASE WHEN event_type = '{t}' THEN 1 ELSE 0 END) AS BIGINT)"


REVENUE = (
    "CAST(round(sum(CASE WHEN event_type = 'purchase' "
    "THEN CAST(unit_price AS DECIMAL(38,10)) * quantity ELSE 0 END), 2) AS DOUBLE)"
)

# ---- adapters (mirror of cartwheel.sources.fixtures) ---------------------------------
_BROWSING = """
events_twice AS (
  SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_id % 50 = 0
),
browsing AS (
  SELECT
    CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y%m%d') AS session_id_hash,
    CASE WHEN event_type = 'error' THEN 'pageview' ELSE 'event_product' END AS event_type,
    CASE event_type WHEN 'view' THEN 'detail' WHEN 'click' THEN 'add'
         WHEN 'signup' THEN 'remove' WHEN 'purchase' THEN 'purchase'
         ELSE CASE WHEN event_id % 17 = 0 THEN ' ' END END AS product_action,
    CASE WHEN event_type = 'error' OR event_id % 89 = 0 THEN NULL
         WHEN event_id % 91 = 0 THEN '  '
         ELSE json_extract_string(props, '$.k') END AS product_sku_hash,
    epoch_us(ts) // 1000 AS server_timestamp_epoch_ms,
    CASE WHEN event_id % 13 = 0 THEN NULL ELSE sha256(props) END AS hashed_url
  FROM events_twice
)"""

_CATALOG = """
catalog AS (
  SELECT CAST(p_partkey % 100 AS VARCHAR) AS product_sku_hash,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_brand END AS category_hash,
         CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 5 = 0 THEN 0.0 WHEN p_partkey % 8 = 0 THEN 11.0
              ELSE CAST(ceil(p_size / 5.0) AS DOUBLE) END AS price_bucket
  FROM part WHERE p_partkey % 100 < 90
),
catalog_dedup AS (
  SELECT product_sku_hash, category_hash, price_bucket FROM (
    SELECT product_sku_hash, category_hash, CAST(trunc(price_bucket) AS INTEGER) AS price_bucket,
           row_number() OVER (PARTITION BY product_sku_hash
                              ORDER BY category_hash ASC NULLS LAST, trunc(price_bucket) ASC NULLS LAST) AS rn
    FROM catalog) t
  WHERE rn = 1
)"""

_PREPARED = """
prepared AS (
  SELECT
    'coveo_sigir_2021' AS source,
    sha256(concat_ws('||', b.session_id_hash, b.event_type, b.product_action, b.product_sku_hash,
                     CAST(b.server_timestamp_epoch_ms AS VARCHAR), b.hashed_url)) AS source_event_id,
    b.session_id_hash AS session_id,
    CASE b.product_action WHEN 'detail' THEN 'product_view' WHEN 'add' THEN 'add_to_cart'
         WHEN 'remove' THEN 'remove_from_cart' WHEN 'purchase' THEN 'purchase' END AS event_type,
    make_timestamp(b.server_timestamp_epoch_ms * 1000) AS event_timestamp,
    b.product_sku_hash AS product_id,
    c.category_hash,
    c.price_bucket,
    b.hashed_url,
    b.product_action AS source_product_action,
    CAST(make_timestamp(b.server_timestamp_epoch_ms * 1000) AS DATE) AS event_date
  FROM browsing b LEFT JOIN catalog_dedup c ON b.product_sku_hash = c.product_sku_hash
  WHERE b.product_action IN ('detail', 'add', 'remove', 'purchase')
)"""

_RETAIL = """
retail_ids AS (
  SELECT
    e.event_id AS event_seq,
    e.user_id AS user_num,
    make_timestamp((epoch_us(e.ts) // 1000) * 1000) AS log_time,
    CASE WHEN e.event_id % 109 = 0 THEN NULL WHEN e.event_id % 53 = 0 THEN 'x' || e.event_id
         ELSE CAST(e.event_id AS VARCHAR) END AS event_id,
    CASE e.event_type WHEN 'view' THEN 'product_view' WHEN 'click' THEN 'add_to_cart'
         WHEN 'signup' THEN 'remove_from_cart' WHEN 'purchase' THEN 'purchase' WHEN 'error' THEN 'page_error' END AS event_type,
    CASE WHEN e.event_id % 47 = 0 THEN NULL ELSE make_timestamp((epoch_us(e.ts) // 1000) * 1000) END AS event_timestamp,
    CASE WHEN e.event_id % 67 = 0 THEN '' WHEN e.event_id % 31 = 0 THEN '0' ELSE CAST(e.user_id AS VARCHAR) END AS customer_id,
    CASE WHEN e.event_id % 113 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN ''
         ELSE CAST(e.user_id AS VARCHAR) || '-' || strftime(e.ts, '%Y%m%d') END AS session_id,
    CASE WHEN e.event_id % 127 = 0 THEN NULL WHEN e.event_id % 41 = 0 THEN '' ELSE CAST(e.k AS VARCHAR) END AS product_id,
    CASE WHEN e.event_id % 71 = 0 THEN '' ELSE p.p_name END AS product_name,
    CASE WHEN e.event_id % 59 = 0 THEN 'TOYS' ELSE p.p_type END AS category,
    CASE WHEN e.event_id % 83 = 0 THEN -e.value ELSE e.value END AS unit_price,
    CAST(CASE WHEN e.event_id % 79 = 0 THEN 0 ELSE 1 + e.k % 3 END AS INTEGER) AS quantity,
    CASE WHEN e.event_id % 73 = 0 THEN 'FRA' WHEN e.event_id % 29 = 0 THEN 'XX'
         ELSE (['PT', 'NL', 'SE', 'PL', 'GR', 'FI', 'IE'])[e.user_id % 7 + 1] END AS country,
    CASE WHEN e.event_id % 61 = 0 THEN 'tv' WHEN e.event_id % 23 = 0 THEN 'tablet'
         ELSE (['mobile', 'desktop', 'tablet'])[e.user_id % 3 + 1] END AS device
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e
  JOIN part p ON p.p_partkey = e.k
)"""

_RETAIL_FIELDS = [
    "event_id", "event_type", "event_timestamp", "customer_id", "session_id", "product_id",
    "product_name", "category", "unit_price", "quantity", "country", "device",
]
_CLICK_FIELDS = [
    "source", "source_event_id", "session_id", "event_type", "event_timestamp", "product_id",
    "category_hash", "price_bucket", "hashed_url", "source_product_action",
]


def _nulled(fields: list[str]) -> str:
    return ",\n    ".join(f"CASE WHEN malformed THEN NULL ELSE {f} END AS {f}" for f in fields)


_RETAIL_LOG = f"""
retail_copies AS (
  SELECT *, 0 AS copy FROM retail_ids
  UNION ALL
  SELECT *, 1 AS copy FROM retail_ids WHERE event_seq % 50 = 0
),
retail_log AS (
  SELECT *,
    CASE WHEN event_seq % 97 = 0 THEN 'wrong' ELSE session_id END AS kafka_key,
    (event_seq % 101 = 0) AS malformed,
    CAST(user_num % 6 AS INTEGER) AS kafka_partition,
    row_number() OVER (PARTITION BY user_num % 6 ORDER BY event_seq, copy) - 1 AS kafka_offset,
    log_time AS kafka_timestamp
  FROM retail_copies
),
retail_parsed AS (
  SELECT kafka_key, kafka_partition, kafka_offset, kafka_timestamp, malformed,
    {_nulled(_RETAIL_FIELDS)}
  FROM retail_log
)"""

_CLICK_LOG = f"""
click_sent AS (
  SELECT * REPLACE (CASE WHEN epoch_ms(event_timestamp) % 103 = 0 THEN 'elsewhere' ELSE source END AS source),
    CASE WHEN epoch_ms(event_timestamp) % 97 = 0 THEN 'wrong' ELSE session_id END AS kafka_key,
    (epoch_ms(event_timestamp) % 101 = 0) AS malformed,
    CAST(CAST(split_part(session_id, '-', 1) AS BIGINT) % 6 AS INTEGER) AS kafka_partition,
    row_number() OVER (PARTITION BY CAST(split_part(session_id, '-', 1) AS BIGINT) % 6
                       ORDER BY source_event_id) - 1 AS kafka_offset,
    'clickstream-events' AS kafka_topic,
    event_timestamp AS kafka_timestamp
  FROM prepared
),
click_log AS (
  SELECT * FROM click_sent WHERE kafka_offset % 211 <> 7
  UNION ALL
  SELECT * FROM click_sent WHERE kafka_offset % 211 <> 7 AND kafka_offset % 199 = 3
),
click_parsed AS (
  SELECT kafka_key, kafka_topic, kafka_partition, kafka_offset, kafka_timestamp, malformed,
    {_nulled(_CLICK_FIELDS)}
  FROM click_log
)"""

# Silver rules, in the order of cartwheel.operators.validation (name, condition).
_RETAIL_RULES = [
    ("missing_event_id", "event_id IS NOT NULL"),
    ("bad_event_type", "event_type IN ('product_view', 'add_to_cart', 'remove_from_cart', 'purchase')"),
    ("missing_event_timestamp", "event_timestamp IS NOT NULL"),
    ("missing_session_id", "session_id IS NOT NULL"),
    ("key_not_session", "kafka_key = session_id"),
    ("missing_product_id", "product_id IS NOT NULL"),
    ("bad_unit_price", "unit_price > 0"),
    ("bad_quantity", "quantity > 0"),
    ("bad_country", "length(country) = 2"),
]
_CLICK_RULES = [
    ("bad_source", "source = 'coveo_sigir_2021'"),
    ("missing_source_event_id", "source_event_id IS NOT NULL"),
    ("missing_session_id", "session_id IS NOT NULL"),
    ("key_not_session", "kafka_key = session_id"),
    ("bad_event_type", "event_type IN ('product_view', 'add_to_cart', 'remove_from_cart', 'purchase')"),
    ("missing_event_timestamp", "event_timestamp IS NOT NULL"),
    ("missing_product_id", "product_id IS NOT NULL"),
    ("bad_price_bucket", "(price_bucket IS NULL OR price_bucket BETWEEN 1 AND 10)"),
]


def _all(rules) -> str:
    return " AND ".join(f"coalesce({c}, false)" for _, c in rules)


def _reasons(rules, malformed: str | None = None) -> str:
    parts = ", ".join(f"CASE WHEN NOT coalesce({c}, false) THEN '{n}' END" for n, c in rules)
    if malformed:
        parts = f"CASE WHEN {malformed} THEN 'malformed_json' END, " + parts
    return f"concat_ws(',', {parts})"


_R_COMPARED = ["kafka_key", "kafka_partition", "kafka_timestamp", *_RETAIL_FIELDS]
_C_COMPARED = ["kafka_key", "kafka_topic", "kafka_partition", "kafka_timestamp", *_CLICK_FIELDS]

_SILVER_R = f"""
silver_r AS (
  SELECT DISTINCT {", ".join(_R_COMPARED)}, CAST(event_timestamp AS DATE) AS event_date
  FROM retail_parsed
  WHERE {_all(_RETAIL_RULES)}
)"""

_SILVER_C = f"""
silver_c AS (
  SELECT DISTINCT {", ".join(_C_COMPARED)}, CAST(event_timestamp AS DATE) AS event_date
  FROM click_parsed
  WHERE {_all(_CLICK_RULES)}
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


PREP = (_BROWSING, _CATALOG, _PREPARED)
RLOG = (_RETAIL, _RETAIL_LOG)
CLOG = (*PREP, _CLICK_LOG)
SILVER_R = (*RLOG, _SILVER_R)
SILVER_C = (*CLOG, _SILVER_C)


def _funnel_sql(src: str) -> str:
    return f"""
funnel_counts AS (
  SELECT
    count(*) AS total_events,
    count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT product_id) AS total_products,
    count(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN session_id END) AS cart_sessions,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN session_id END) AS purchase_sessions,
    {count_type('product_view')} AS product_views,
    {count_type('add_to_cart')} AS cart_additions,
    {count_type('remove_from_cart')} AS cart_removals,
    {count_type('purchase')} AS purchases
  FROM {src}
),
funnel AS (
  SELECT *,
    {pct('cart_sessions', 'total_sessions')} AS view_to_cart_rate,
    {pct('purchase_sessions', 'total_sessions')} AS purchase_conversion_rate,
    {pct('purchase_sessions', 'cart_sessions')} AS cart_to_purchase_rate
  FROM funnel_counts
)"""


_CATEGORIES = f"""
categories AS (
  SELECT category, sessions, products, product_views, cart_additions, purchases,
    {pct('purchases', 'product_views')} AS purchase_per_view_rate
  FROM (
    SELECT coalesce(category_hash, 'unknown') AS category,
      count(DISTINCT session_id) AS sessions,
      count(DISTINCT product_id) AS products,
      {count_type('product_view')} AS product_views,
      {count_type('add_to_cart')} AS cart_additions,
      {count_type('purchase')} AS purchases
    FROM silver_c GROUP BY 1) t
)"""

_PRICE_BUCKETS = f"""
price_buckets AS (
  SELECT coalesce(CAST(price_bucket AS VARCHAR), 'unknown') AS price_segment,
    count(*) AS events,
    count(DISTINCT session_id) AS sessions,
    {count_type('product_view')} AS product_views,
    {count_type('add_to_cart')} AS cart_additions,
    {count_type('purchase')} AS purchases
  FROM silver_c GROUP BY 1
)"""

_JSON_C = (
    "'{\"source\":\"' || source || '\",\"source_event_id\":\"' || source_event_id"
    " || '\",\"session_id\":\"' || session_id || '\",\"event_type\":\"' || event_type"
    " || '\",\"event_timestamp\":\"' || strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z\"'"
    " || CASE WHEN product_id IS NULL THEN '' ELSE ',\"product_id\":\"' || product_id || '\"' END"
    " || CASE WHEN category_hash IS NULL THEN '' ELSE ',\"category_hash\":\"' || category_hash || '\"' END"
    " || CASE WHEN price_bucket IS NULL THEN '' ELSE ',\"price_bucket\":' || CAST(price_bucket AS VARCHAR) END"
    " || CASE WHEN hashed_url IS NULL THEN '' ELSE ',\"hashed_url\":\"' || hashed_url || '\"' END"
    " || ',\"source_product_action\":\"' || source_product_action || '\"}'"
)

_CONTRACT_RULES = [
    ("bad_event_id", "event_id IS NOT NULL AND regexp_matches(event_id, '^[0-9]+$')"),
    ("bad_event_type", "event_type IN ('product_view', 'add_to_cart', 'remove_from_cart', 'purchase')"),
    ("missing_event_timestamp", "event_timestamp IS NOT NULL"),
    ("empty_customer_id", "customer_id IS NOT NULL AND length(customer_id) >= 1"),
    ("empty_session_id", "session_id IS NOT NULL AND length(session_id) >= 1"),
    ("empty_product_id", "product_id IS NOT NULL AND length(product_id) >= 1"),
    ("empty_product_name", "product_name IS NOT NULL AND length(product_name) >= 1"),
    ("bad_category", "category IN ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')"),
    ("bad_unit_price", "unit_price > 0 AND NOT isnan(unit_price)"),
    ("bad_quantity", "coalesce(quantity, 1) > 0"),
    ("bad_country", "length(country) = 2"),
    ("bad_device", "device IN ('mobile', 'desktop', 'tablet')"),
]

_POS = "{'t': event_timestamp, 'i': event_id}"


# ---- XXH64 (seed 42), for the session sample of the replay --------------------------
# DuckDB has no xxhash64, so the standard XXH64 is spelled out for short inputs (the
# adapter's session ids are under 32 bytes; longer input raises instead of mismatching).
# 64-bit wrap-around arithmetic goes through 128-bit UHUGEINT modulo 2^64.
# The five XXH64 primes.
M = "CAST(18446744073709551616 AS UHUGEINT)"
P1, P2, P3, P4, P5 = (11400714785074694791, 14029467366897019727, 1609587929392839161,
                      9650029242287828579, 2870177450012600261)


def u(x):
    return f"CAST({x} AS UHUGEINT)"


def mul(a, b):
    return f"CAST(({u(a)} * {u(b)}) % {M} AS UBIGINT)"


def add(a, b):
    return f"CAST(({u(a)} + {u(b)}) % {M} AS UBIGINT)"


def rotl(x, r):
    return f"({mul(x, 2 ** r)} | (CAST({x} AS UBIGINT) >> {64 - r}))"


def xor(a, b):
    return f"xor(CAST({a} AS UBIGINT), CAST({b} AS UBIGINT))"


def byte(s, pos_expr, j):
    return f"CAST(ord(substr({s}, {pos_expr} + {j + 1}, 1)) AS UBIGINT)"


def word(s, pos, nbytes):
    return " + ".join(f"{byte(s, pos, j)} * {2 ** (8 * j)}" for j in range(nbytes))


def xxh64_cte(source_sql: str, seed: int = 42) -> str:
    """CTEs xx_in(s) -> xx_hash(s, h): XXH64 of short ASCII strings (< 32 bytes)."""
    eight = add(mul(rotl(xor("h", mul(rotl(mul(f"({word('s', 'pos', 8)})", P2), 31), P1)), 27), P1), P4)
    four = add(mul(rotl(xor("h", mul(f"({word('s', 'pos', 4)})", P1)), 23), P2), P3)
    one = mul(rotl(xor("h", mul(byte("s", "pos", 0), P5)), 11), P1)
    h1 = xor("h", "h >> 33")
    h2 = mul(h1, P2)
    h3 = xor(h2, f"{h2} >> 29")
    h4 = mul(h3, P3)
    h5 = xor(h4, f"{h4} >> 32")
    return f"""
xx_in AS ({source_sql}),
xx_steps AS (
  SELECT s, 0 AS pos,
    CASE WHEN length(s) >= 32 THEN error('xxh64 oracle handles inputs under 32 bytes only')
         ELSE {add(seed + P5, 'length(s)')} END AS h
  FROM xx_in
  UNION ALL
  SELECT s,
    pos + CASE WHEN length(s) - pos >= 8 THEN 8 WHEN length(s) - pos >= 4 THEN 4 ELSE 1 END,
    CASE WHEN length(s) - pos >= 8 THEN {eight}
         WHEN length(s) - pos >= 4 THEN {four}
         ELSE {one} END
  FROM xx_steps WHERE pos < length(s)
),
xx_hash AS (
  SELECT s, CAST(CASE WHEN hu >= CAST(9223372036854775808 AS UBIGINT)
                      THEN CAST(hu AS HUGEINT) - CAST(18446744073709551616 AS HUGEINT)
                      ELSE CAST(hu AS HUGEINT) END AS BIGINT) AS h
  FROM (SELECT s, {h5} AS hu FROM xx_steps WHERE pos = length(s)) t
)"""


def _value_counts(src: str, col: str) -> str:
    return f"SELECT {col}, count(*) AS count FROM {src} GROUP BY {col}"


def _sampled(modulus: int, remainder: int) -> str:
    """CTEs up to ``sample``: prepared events whose session bucket
    pmod(xxhash64(session_id), modulus) equals ``remainder``."""
    return (
        "WITH RECURSIVE "
        + ",".join(PREP)
        + ","
        + xxh64_cte("SELECT DISTINCT session_id AS s FROM prepared")
        + f""",
sample AS (
  SELECT p.* FROM prepared p JOIN xx_hash x ON p.session_id = x.s
  WHERE ((x.h % {modulus}) + {modulus}) % {modulus} = {remainder}
)
"""
    )


ORACLE_SQL: dict[str, str] = {
    "gold_funnel": _with(*SILVER_C, _funnel_sql("silver_c")) + "SELECT * FROM funnel",
    "gold_category": _with(*SILVER_C, _CATEGORIES) + "SELECT * FROM categories",
    "gold_price_bucket": _with(*SILVER_C, _PRICE_BUCKETS) + "SELECT * FROM price_buckets",
    "gold_on_prepared": _with(*PREP, _funnel_sql("prepared")) + "SELECT * FROM funnel",
    "retail_funnel": _with(*SILVER_R)
    + f"""SELECT total_sessions, cart_sessions, purchase_sessions,
  {pct('cart_sessions', 'total_sessions')} AS view_to_cart_rate,
  {pct('purchase_sessions', 'total_sessions')} AS purchase_conversion_rate,
  total_revenue
FROM (
  SELECT count(DISTINCT session_id) AS total_sessions,
    count(DISTINCT CASE WHEN event_type = 'add_to_cart' THEN session_id END) AS cart_sessions,
    count(DISTINCT CASE WHEN event_type = 'purchase' THEN session_id END) AS purchase_sessions,
    {REVENUE} AS total_revenue
  FROM silver_r) t""",
    "retail_product": _with(*SILVER_R)
    + f"""SELECT product_id, product_name, category,
  {count_type('product_view')} AS product_views,
  {count_type('add_to_cart')} AS cart_additions,
  {count_type('purchase')} AS purchases,
  {REVENUE} AS revenue
FROM silver_r GROUP BY product_id, product_name, category""",
    "retail_country": _with(*SILVER_R)
    + f"""SELECT country, count(DISTINCT session_id) AS sessions,
  {count_type('purchase')} AS purchases, {REVENUE} AS revenue
FROM silver_r GROUP BY country""",
    "prepare_events": _with(*PREP) + "SELECT * FROM prepared",
    "catalog_dedup": _with(_CATALOG) + "SELECT * FROM catalog_dedup",
    "profile_raw": _with(_BROWSING)
    + """SELECT count(*) AS total_events,
  min(server_timestamp_epoch_ms) AS minimum_timestamp_ms,
  max(server_timestamp_epoch_ms) AS maximum_timestamp_ms,
  CAST(sum(CASE WHEN product_action IS NULL OR trim(product_action) = '' THEN 1 ELSE 0 END) AS BIGINT)
    AS events_without_product_action,
  CAST(sum(CASE WHEN product_sku_hash IS NULL OR trim(product_sku_hash) = '' THEN 1 ELSE 0 END) AS BIGINT)
    AS events_without_product,
  true AS sessions_estimate_ok,
  true AS products_estimate_ok
FROM browsing""",
    "profile_event_types": _with(_BROWSING) + _value_counts("browsing", "event_type"),
    "profile_actions": _with(_BROWSING) + _value_counts("browsing", "product_action"),
    "inspect_prepared": _with(*PREP)
    + """SELECT count(*) AS total_events, min(event_timestamp) AS first_event, max(event_timestamp) AS last_event,
  CAST(sum(CASE WHEN category_hash IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS events_without_category,
  CAST(sum(CASE WHEN price_bucket IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS events_without_price_bucket,
  true AS unique_events_estimate_ok, true AS sessions_estimate_ok
FROM prepared""",
    "inspect_prepared_types": _with(*PREP) + _value_counts("prepared", "event_type"),
    "inspect_prepared_sample": _with(*PREP)
    + """SELECT source_event_id, session_id, event_type, event_timestamp, product_id, category_hash, price_bucket
FROM prepared ORDER BY source_event_id, session_id, event_timestamp LIMIT 5""",
    "bronze_metrics": _with(*RLOG)
    + "SELECT count(*) AS total_events, count(DISTINCT kafka_key) AS unique_sessions FROM retail_log",
    "bronze_offsets": _with(*RLOG)
    + """SELECT kafka_partition, count(*) AS event_count, min(kafka_offset) AS first_offset,
  max(kafka_offset) AS last_offset
FROM retail_log GROUP BY kafka_partition""",
    "offset_gaps": _with(*CLOG)
    + """SELECT kafka_partition, count(*) AS event_count,
  max(kafka_offset) - min(kafka_offset) + 1 - count(DISTINCT kafka_offset) AS missing_offsets,
  count(*) - count(DISTINCT kafka_offset) AS duplicates
FROM click_log GROUP BY kafka_partition""",
    "bronze_projection": _with(*CLOG)
    + f"""SELECT kafka_key,
  CASE WHEN malformed THEN '{{bad' ELSE {_JSON_C} END AS raw_json,
  kafka_topic, kafka_partition, kafka_offset, kafka_timestamp
FROM click_log""",
    "stream_preview": _with(*RLOG)
    + """SELECT kafka_partition AS partition, kafka_offset AS offset, kafka_key,
  event_timestamp, event_type, session_id, product_id, category, unit_price, country
FROM retail_parsed""",
    "silver_retail": _with(*SILVER_R) + "SELECT * FROM silver_r",
    "silver_retail_exact": _with(*SILVER_R) + "SELECT * FROM silver_r",
    "silver_click": _with(*SILVER_C) + "SELECT * FROM silver_c",
    "silver_metrics": _with(*SILVER_R)
    + """SELECT count(*) AS total_events, count(DISTINCT event_id) AS unique_events,
  count(DISTINCT session_id) AS unique_sessions FROM silver_r""",
    "silver_types": _with(*SILVER_R) + _value_counts("silver_r", "event_type"),
    "silver_country": _with(*SILVER_R) + _value_counts("silver_r", "country"),
    "silver_click_metrics": _with(*SILVER_C)
    + """SELECT count(*) AS total_events, count(DISTINCT source_event_id) AS unique_events,
  count(DISTINCT session_id) AS unique_sessions,
  CAST(sum(CASE WHEN category_hash IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_categories,
  CAST(sum(CASE WHEN price_bucket IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS missing_price_buckets
FROM silver_c""",
    "silver_click_types": _with(*SILVER_C) + _value_counts("silver_c", "event_type"),
    "silver_click_partitions": _with(*SILVER_C)
    + "SELECT kafka_partition, count(*) AS event_count FROM silver_c GROUP BY kafka_partition",
    "layer_counts": _with(*SILVER_C)
    + f"""SELECT log_records, bronze_records, silver_records, quarantined_records,
  CAST(0 AS BIGINT) AS late_records, bronze_records - silver_records - quarantined_records AS duplicates_removed
FROM (SELECT
  (SELECT count(*) FROM click_log) AS log_records,
  (SELECT count(*) FROM click_log) AS bronze_records,
  (SELECT count(*) FROM silver_c) AS silver_records,
  (SELECT count(*) FROM click_parsed WHERE NOT ({_all(_CLICK_RULES)})) AS quarantined_records) t""",
    "layer_counts_retail": _with(*SILVER_R)
    + f"""SELECT log_records, bronze_records, silver_records, quarantined_records,
  CAST(0 AS BIGINT) AS late_records, bronze_records - silver_records - quarantined_records AS duplicates_removed
FROM (SELECT
  (SELECT count(*) FROM retail_log) AS log_records,
  (SELECT count(*) FROM retail_log) AS bronze_records,
  (SELECT count(*) FROM silver_r) AS silver_records,
  (SELECT count(*) FROM retail_parsed WHERE NOT ({_all(_RETAIL_RULES)})) AS quarantined_records) t""",
    "quarantine_retail": _with(*RLOG)
    + f"""SELECT kafka_partition, kafka_offset, kafka_key, event_id,
  {_reasons(_RETAIL_RULES, 'malformed')} AS reasons
FROM retail_parsed WHERE NOT ({_all(_RETAIL_RULES)})""",
    "quarantine_click": _with(*CLOG)
    + f"""SELECT kafka_partition, kafka_offset, kafka_key, source_event_id,
  {_reasons(_CLICK_RULES, 'malformed')} AS reasons
FROM click_parsed WHERE NOT ({_all(_CLICK_RULES)})""",
    "replay_all": _with(*PREP) + f"SELECT session_id AS key, {', '.join(_CLICK_FIELDS)} FROM prepared",
    "replay_sample": _sampled(200, 0) + f"SELECT session_id AS key, {', '.join(_CLICK_FIELDS)} FROM sample",
    "replay_summary": _sampled(200, 0) + _value_counts("sample", "event_type"),
    "replay_payload": _with(*PREP) + f"SELECT session_id AS key, {_JSON_C} AS value FROM prepared",
    "replay_all_summary": _with(*PREP)
    + "SELECT count(*) AS events, count(DISTINCT session_id) AS sessions FROM prepared",
    "contract_violations": _with(_RETAIL)
    + f"""SELECT event_id, session_id, violations FROM (
  SELECT event_id, session_id, {_reasons(_CONTRACT_RULES)} AS violations FROM retail_ids) t
WHERE violations <> ''""",
    "journey_consistency": _with(*SILVER_R)
    + f"""SELECT session_id, violations FROM (
  SELECT session_id, concat_ws(',',
    CASE WHEN coalesce(first_type <> 'product_view', true) THEN 'first_event_not_view' END,
    CASE WHEN c_lo <> c_hi THEN 'several_customers' END,
    CASE WHEN k_lo <> k_hi THEN 'several_countries' END,
    CASE WHEN d_lo <> d_hi THEN 'several_devices' END,
    CASE WHEN first_purchase IS NOT NULL AND (first_cart IS NULL OR first_cart > first_purchase)
         THEN 'purchase_without_prior_cart' END) AS violations
  FROM (
    SELECT session_id,
      arg_min(event_type, {_POS}) AS first_type,
      min(customer_id) AS c_lo, max(customer_id) AS c_hi,
      min(country) AS k_lo, max(country) AS k_hi,
      min(device) AS d_lo, max(device) AS d_hi,
      min(CASE WHEN event_type = 'add_to_cart' THEN {_POS} END) AS first_cart,
      min(CASE WHEN event_type = 'purchase' THEN {_POS} END) AS first_purchase
    FROM silver_r GROUP BY session_id) a) b
WHERE violations <> ''""",
    "report_top_categories": _with(*SILVER_C, _CATEGORIES)
    + """SELECT CASE WHEN category = 'unknown' THEN 'Unknown' ELSE substr(category, 1, 12) || '…' END
    AS category_display, purchases, purchase_per_view_rate
FROM categories ORDER BY purchases DESC, category ASC LIMIT 10""",
    "report_funnel_stages": _with(*SILVER_C, _funnel_sql("silver_c"))
    + """SELECT 'Sessions' AS "Stage", total_sessions AS "Count" FROM funnel
UNION ALL SELECT 'Added to cart', cart_sessions FROM funnel
UNION ALL SELECT 'Purchased', purchase_sessions FROM funnel""",
    "report_kpis": _with(*SILVER_C, _funnel_sql("silver_c"))
    + """SELECT format('{:,}', total_events) AS events, format('{:,}', total_sessions) AS sessions,
  format('{:,}', total_products) AS products, format('{:,}', purchases) AS purchases,
  printf('%.2f%%', view_to_cart_rate) AS view_to_cart,
  printf('%.2f%%', purchase_conversion_rate) AS purchase_conversion,
  printf('%.2f%%', cart_to_purchase_rate) AS cart_to_purchase
FROM funnel""",
    "report_price_segments": _with(*SILVER_C, _PRICE_BUCKETS) + "SELECT price_segment, purchases FROM price_buckets",
}


# ---- written and CSV paths, order as data, micro-batches ------------------------------
_BATCHES = """
batches AS (
  SELECT event_id, user_id, 1 + event_id % 4 AS batch,
         CASE WHEN event_id % 4 = 3 AND event_id % 11 = 0 THEN 1 ELSE 1 + event_id % 4 END AS hour, 0 AS again FROM events
  UNION ALL SELECT event_id, user_id, 2, 2, 1 FROM events WHERE event_id % 4 = 0 AND event_id % 7 = 0
  UNION ALL SELECT event_id, user_id, 4, 4, 2 FROM events WHERE event_id % 4 = 0 AND event_id % 10 = 0
)"""
#: Rows are late against the watermark of the batch before: in batch 4, that of batch 2 less 30 minutes.
_LATE_ROWS = "batch = 4 AND hour = 1"


def _batch_rows(keep: str) -> str:
    return _with(_BATCHES) + f"""SELECT CAST(event_id AS VARCHAR) AS source_event_id, CAST(user_id AS VARCHAR) AS session_id,
  make_timestamp((1704067200 + hour * 7200 + event_id % 600) * 1000000) AS event_timestamp,
  CAST(make_timestamp((1704067200 + hour * 7200 + event_id % 600) * 1000000) AS DATE) AS event_date
FROM batches WHERE {keep}"""


ORACLE_SQL |= {
    "prepared_written": ORACLE_SQL["prepare_events"],
    "prepare_csv": ORACLE_SQL["prepare_events"],
    "profile_csv": ORACLE_SQL["profile_raw"],
    "silver_batches_watermark": _batch_rows(f"again <> 1 AND NOT ({_LATE_ROWS})"),
    "silver_batches_exact": _batch_rows(f"again = 0 AND NOT ({_LATE_ROWS})"),
    "layer_counts_batches": _with(_BATCHES) + f"""SELECT count(*) AS log_records, count(*) AS bronze_records,
  count(*) FILTER (again <> 1 AND NOT ({_LATE_ROWS})) AS silver_records, CAST(0 AS BIGINT) AS quarantined_records,
  count(*) FILTER ({_LATE_ROWS}) AS late_records, count(*) FILTER (again = 1) AS duplicates_removed
FROM batches""",
    "ordered_categories": _with(*SILVER_C, _CATEGORIES)
    + "SELECT category, row_number() OVER (ORDER BY purchases DESC, category) - 1 AS place FROM categories",
    "ordered_price_segments": _with(*SILVER_C, _PRICE_BUCKETS)
    + """SELECT price_segment, row_number() OVER (
  ORDER BY price_segment = 'unknown', try_cast(price_segment AS INTEGER)) - 1 AS place FROM price_buckets""",
    "ordered_actions": _with(_BROWSING)
    + """SELECT product_action, row_number() OVER (ORDER BY count(*) DESC, product_action NULLS FIRST) - 1 AS place
FROM browsing GROUP BY product_action""",
    "ordered_offsets": _with(*RLOG)
    + """SELECT kafka_partition, row_number() OVER (ORDER BY kafka_partition) - 1 AS place
FROM retail_log GROUP BY kafka_partition""",
}

# ---- Silver, quarantine and late rows from one pass -----------------------------------
_BATCH_TIME = "make_timestamp((1704067200 + hour * 7200 + event_id % 600) * 1000000)"
ORACLE_SQL |= {
    "one_pass_silver_click": ORACLE_SQL["silver_click"],
    "one_pass_silver_retail": ORACLE_SQL["silver_retail"],
    "one_pass_quarantine_click": ORACLE_SQL["quarantine_click"],
    "one_pass_quarantine_retail": ORACLE_SQL["quarantine_retail"],
    "one_pass_batches_watermark": ORACLE_SQL["silver_batches_watermark"],
    "one_pass_batches_exact": ORACLE_SQL["silver_batches_exact"],
    "late_rows": _batch_rows(_LATE_ROWS),
    "compacted_silver": ORACLE_SQL["silver_batches_watermark"],
    "compacted_late_rows": _batch_rows(_LATE_ROWS),
    "batch_progress": _with(_BATCHES) + f"""SELECT batch - 1 AS batch_id, count(*) AS rows_in,
  count(*) FILTER (again <> 1 AND NOT ({_LATE_ROWS})) AS silver, CAST(0 AS BIGINT) AS quarantine,
  count(*) FILTER ({_LATE_ROWS}) AS late, count(*) FILTER (again = 1) AS duplicates,
  max(max({_BATCH_TIME})) OVER (ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 30 MINUTE AS watermark,
  max(max({_BATCH_TIME})) OVER (ORDER BY batch) AS last_event
FROM batches GROUP BY batch""",
}

# ---- Gold by day, sketches by day, journeys by part -----------------------------------
def _with_bounds(names) -> str:
    # sets of this size are held exactly, so the bounds are the numbers themselves
    return ", ".join(f"{n}, {n} AS {n}_low, {n} AS {n}_high" for n in names)


ORACLE_SQL |= {
    "daily_funnel": ORACLE_SQL["gold_funnel"],
    "daily_category": ORACLE_SQL["gold_category"],
    "daily_price_bucket": ORACLE_SQL["gold_price_bucket"],
    "daily_retail_funnel": ORACLE_SQL["retail_funnel"],
    "daily_retail_product": ORACLE_SQL["retail_product"],
    "daily_retail_country": ORACLE_SQL["retail_country"],
    "prepared_types_by_day": ORACLE_SQL["inspect_prepared_types"],
    "journeys_by_part": ORACLE_SQL["journey_consistency"],
    "session_estimates": _with(*PREP, """
of_sessions AS (
  SELECT session_id, bool_or(event_type = 'add_to_cart') AS cart, bool_or(event_type = 'purchase') AS bought
  FROM prepared GROUP BY session_id
),
numbers AS (
  SELECT count(*) AS sessions, count(*) FILTER (cart) AS cart_sessions, count(*) FILTER (bought) AS purchase_sessions,
    count(*) FILTER (cart AND NOT bought) AS abandoned_sessions, count(*) FILTER (cart OR bought) AS cart_or_purchase_sessions
  FROM of_sessions
)""") + "SELECT " + _with_bounds(
        ["sessions", "cart_sessions", "purchase_sessions", "abandoned_sessions", "cart_or_purchase_sessions"]) + " FROM numbers",
    "prepared_estimates": _with(*PREP, """
numbers AS (
  SELECT count(*) AS total_events, count(DISTINCT source_event_id) AS unique_events, count(DISTINCT session_id) AS sessions,
    min(event_timestamp) AS first_event, max(event_timestamp) AS last_event,
    count(*) FILTER (category_hash IS NULL) AS events_without_category,
    count(*) FILTER (price_bucket IS NULL) AS events_without_price_bucket
  FROM prepared
)""") + "SELECT total_events, first_event, last_event, events_without_category, events_without_price_bucket, "
    + _with_bounds(["unique_events", "sessions"]) + " FROM numbers",
}
