"""SQL for every catalogue query, runnable by DuckDB.

The fixture views are spelled out as CTEs over the driver tables. Rounded means are exact (quotient and
remainder of whole cents), and sums are decimals, so values equal the Spark side bit for bit.
"""

from __future__ import annotations

# --------------------------------------------------------------------------- fixtures

CLICKSTREAM = """
clickstream AS (
  SELECT 100000 + o_custkey * 8 + o_orderkey % 8 AS order_id,
         CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE o_custkey END AS customer_id,
         o_orderdate AS order_date,
         CAST(o_totalprice AS decimal(12,2)) AS subtotal,
         CAST(CAST(o_totalprice AS decimal(12,2)) * CAST(0.08 AS decimal(3,2)) AS decimal(12,2)) AS tax,
         concat('clk-', lpad(CAST(o_orderkey AS varchar), 7, '0')) AS click_id,
         CASE (o_orderkey * 7 + o_custkey) % 12
           WHEN 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 Edg/120.0.0.0'
           WHEN 1 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36'
           WHEN 2 THEN 'Mozilla/5.0 (Macintosh; Intel Mac OS X 10_15_7) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.3 Safari/605.1.15'
           WHEN 3 THEN 'Mozilla/5.0 (X11; Linux x86_64; rv:121.0) Gecko/20100101 Firefox/121.0'
           WHEN 4 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 17_2 like Mac OS X) AppleWebKit/605.1.15 (KHTML, like Gecko) Version/17.2 Mobile/15E148 Safari/604.1'
           WHEN 5 THEN 'Mozilla/5.0 (Linux; Android 14; Pixel 8) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Mobile Safari/537.36'
           WHEN 6 THEN 'Mozilla/5.0 (X11; Linux x86_64) AppleWebKit/537.36 (KHTML, like Gecko) Chromium/119.0 Chrome/119.0 Safari/537.36'
           WHEN 7 THEN 'Opera/9.80 (Windows NT 6.1; U; en) Presto/2.12.388 Version/12.18'
           WHEN 8 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/120.0.0.0 Safari/537.36 OPR/106.0.0.0'
           WHEN 9 THEN 'curl/8.4.0'
           WHEN 10 THEN 'mozilla/5.0 (ipad; cpu os 16_0) applewebkit/605.1.15 version/16.0 safari/604.1'
           ELSE NULL END AS user_agent,
         CAST(10 + (o_orderkey * 37) % 1791 AS int) AS session_duration_secs
  FROM orders
)"""

SALES = """
sales AS (
  SELECT o_custkey AS customerID, p_name AS product, o_orderdate AS dateTime,
         CAST(l_quantity AS int) AS quantity, CAST(p_retailprice AS decimal(10,2)) AS unitPrice
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
)"""

APPLICATIONS = """
applications AS (
  SELECT concat('APP-', lpad(CAST(c_custkey AS varchar), 6, '0')) AS application_id,
         CASE WHEN c_custkey % 50 = 7 THEN '' ELSE c_name END AS customer_name,
         CAST(CASE c_custkey WHEN 1 THEN 100000 WHEN 2 THEN 100001 WHEN 3 THEN 25000 WHEN 4 THEN 20000
              WHEN 5 THEN 3000000000 ELSE floor(abs(c_acctbal) * 20) END AS bigint) AS annual_income
  FROM customer
)"""

LANDING = """
landing AS (
  SELECT o_orderkey,
         CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 1 THEN 'not-a-date'
              WHEN 2 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS order_date,
         CASE WHEN o_orderkey % 10 IN (0, 1, 3) THEN strftime(o_orderdate + INTERVAL 3 DAYS, '%m/%d/%Y')
              ELSE strftime(o_orderdate + INTERVAL 3 DAYS, '%Y-%m-%d') END AS ship_date
  FROM orders
)"""

# Tokens, labels and their order.
BROWSER_A = """CASE WHEN user_agent ILIKE '%Edg/%' THEN 'Edge'
     WHEN user_agent ILIKE '%Chrome/%' AND user_agent NOT ILIKE '%Chromium%' THEN 'Chrome'
     WHEN user_agent ILIKE '%Firefox/%' THEN 'Firefox'
     WHEN user_agent ILIKE '%Safari/%' AND user_agent NOT ILIKE '%Chrome%' THEN 'Safari'
     WHEN user_agent ILIKE '%Opera%' OR user_agent ILIKE '%OPR/%' THEN 'Opera'
     ELSE 'Other' END"""
OS_A = """CASE WHEN user_agent ILIKE '%Windows NT%' THEN 'Windows'
     WHEN user_agent ILIKE '%Macintosh%' OR user_agent ILIKE '%Mac OS X%' THEN 'macOS'
     WHEN user_agent ILIKE '%Android%' THEN 'Android'
     WHEN user_agent ILIKE '%iPhone%' OR user_agent ILIKE '%iPad%' THEN 'iOS'
     WHEN user_agent ILIKE '%Linux%' THEN 'Linux'
     ELSE 'Other' END"""
BROWSER_B = """CASE WHEN user_agent ILIKE '%Edg/%' THEN 'Edge'
     WHEN user_agent ILIKE '%Chrome/%' THEN 'Chrome'
     WHEN user_agent ILIKE '%Firefox/%' THEN 'Firefox'
     WHEN user_agent ILIKE '%Safari/%' THEN 'Safari'
     WHEN user_agent ILIKE '%Opera%' OR user_agent ILIKE '%OPR/%' THEN 'Opera'
     ELSE 'Other' END"""
OS_B = """CASE WHEN user_agent ILIKE '%Windows NT%' THEN 'Windows'
     WHEN user_agent ILIKE '%Macintosh%' THEN 'macOS'
     WHEN user_agent ILIKE '%Android%' THEN 'Android'
     WHEN user_agent ILIKE '%iPhone%' OR user_agent ILIKE '%iPad%' THEN 'iOS'
     WHEN user_agent ILIKE '%Linux%' THEN 'Linux'
     ELSE 'Other' END"""

STAGED_A = f"""
staged AS (
  SELECT order_id, customer_id, order_date, subtotal, tax, click_id, session_duration_secs,
         {BROWSER_A} AS browser,
         {OS_A} AS os
  FROM clickstream
)"""

STAGED_B = f"""
staged_b AS (
  SELECT customer_id, order_id, subtotal + tax AS spend, session_duration_secs,
         {BROWSER_B} AS browser,
         {OS_B} AS os
  FROM clickstream
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


def mean2(expr: str, source_scale: int = 0) -> str:
    """HALF_UP(avg(expr), 2) as decimal(18,2): whole hundredths, and one more if the remainder is half or over."""
    cents = f"ABS(SUM(CAST(({expr}) * {10 ** source_scale} AS HUGEINT))) * {10 ** (2 - source_scale)}"
    n = f"COUNT({expr})"
    size = f"({cents} // NULLIF({n}, 0) + CASE WHEN 2 * ({cents} % NULLIF({n}, 0)) >= {n} THEN 1 ELSE 0 END)"
    return f"CAST(SIGN(SUM({expr})) * {size} * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))"


def money_sum(expr: str) -> str:
    return f"CAST(SUM({expr}) AS DECIMAL(38,2))"


# --------------------------------------------------------------------------- clickstream

STAGED_CLICKSTREAM = with_(CLICKSTREAM, STAGED_A) + "SELECT * FROM staged"
STAGED_CLICKSTREAM_B = with_(CLICKSTREAM, STAGED_B) + "SELECT * FROM staged_b"

# Label counts of both kinds in one table; a customer's label is the first by name of those used most.
FAVOURITES = """
uses_{n} AS (
  SELECT customer_id AS who, 'browser' AS kind, browser AS label, COUNT(*) AS uses FROM {src} GROUP BY ALL
  UNION ALL SELECT customer_id, 'os', os, COUNT(*) FROM {src} GROUP BY ALL
), favourites_{n} AS (
  SELECT who, MIN(label) FILTER (WHERE kind = 'browser') AS most_common_browser,
         MIN(label) FILTER (WHERE kind = 'os') AS most_common_os
  FROM uses_{n} u WHERE uses = (SELECT MAX(uses) FROM uses_{n} v WHERE v.kind = u.kind AND v.who IS NOT DISTINCT FROM u.who)
  GROUP BY who
)"""


def mart_cte(n: str, src: str) -> str:
    return FAVOURITES.format(n=n, src=src) + f""",
mart_{n} AS (
  SELECT t.*, f.most_common_browser, f.most_common_os
  FROM (SELECT customer_id, COUNT(DISTINCT order_id) AS total_orders, {money_sum('subtotal')} AS total_subtotal,
               {money_sum('tax')} AS total_tax, {money_sum('subtotal + tax')} AS total_spend,
               {mean2('session_duration_secs')} AS avg_session_duration_secs
        FROM {src} GROUP BY customer_id) t
  LEFT JOIN favourites_{n} f ON f.who = t.customer_id
)"""


CUSTOMER_METRICS = with_(CLICKSTREAM, STAGED_A, mart_cte("all", "staged")) + "SELECT * FROM mart_all"

CUSTOMER_METRICS_B = with_(CLICKSTREAM, STAGED_B, FAVOURITES.format(n="b", src="staged_b")) + f"""
SELECT customer_id, COUNT(order_id) AS total_orders, {money_sum('spend')} AS total_spend,
       {mean2('session_duration_secs')} AS avg_session_duration_secs,
       ANY_VALUE(most_common_browser) AS most_common_browser, ANY_VALUE(most_common_os) AS most_common_os
FROM staged_b JOIN favourites_b ON who = customer_id GROUP BY customer_id"""

ORDER_RECENCY_RANK = with_(CLICKSTREAM, STAGED_A) + """
SELECT *, RANK() OVER (PARTITION BY customer_id ORDER BY order_date DESC NULLS FIRST) AS order_rank
FROM staged"""


# --------------------------------------------------------------------------- approvals

AS_OF_SQL = "TIMESTAMP '2026-01-15 10:00:00'"


def approvals_cte(name: str, src: str, threshold: int, prate: str, srate: str, floor: int,
                  products: tuple[str, str] = ("Infinite Sapphire", "Classic Rewards")) -> str:
    return f"""
{name} AS (
  SELECT application_id, customer_name, annual_income,
         CASE WHEN annual_income > {threshold} THEN '{products[0]}' ELSE '{products[1]}' END AS card_product,
         CAST(CASE WHEN annual_income > {threshold} THEN ROUND(annual_income * CAST({prate} AS DECIMAL(10,4)), 2)
              ELSE ROUND(GREATEST(annual_income * CAST({srate} AS DECIMAL(10,4)), {floor}), 2) END AS DOUBLE) AS credit_limit,
         CASE WHEN annual_income > {threshold} THEN 'PREMIUM' ELSE 'STANDARD' END AS income_tier,
         (annual_income <= {threshold} AND annual_income * CAST({srate} AS DECIMAL(10,4)) < {floor}) AS floor_applied
  FROM {src}
)"""


PORTFOLIO = approvals_cte("portfolio", "applications", 100000, "0.15", "0.08", 2000)

APPROVE_APPLICATIONS = with_(APPLICATIONS, PORTFOLIO) + "SELECT * FROM portfolio"

APPROVE_WITH_CONFIG = with_(APPLICATIONS, approvals_cte("configured", "applications", 60000, "0.1", "0.05", 1000, ("Gold", "Basic"))) \
    + "SELECT * FROM configured"

APPROVAL_SUMMARY = with_(APPLICATIONS, PORTFOLIO) + f"""
SELECT COUNT(*) AS total_accounts,
       COALESCE(CAST(SUM(CAST(credit_limit AS DECIMAL(18,2))) AS DECIMAL(38,2)), 0) AS total_credit_volume,
       {mean2('CAST(credit_limit AS DECIMAL(18,2))', 2)} AS avg_credit_limit
FROM portfolio"""

TIER_VOLUMES = with_(APPLICATIONS, PORTFOLIO) + """
SELECT income_tier, card_product, COUNT(*) AS accounts,
       CAST(SUM(CAST(credit_limit AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS credit_volume
FROM portfolio GROUP BY income_tier, card_product"""

INGEST_STATS = with_(APPLICATIONS) + """
SELECT COUNT(*) AS applications, MIN(annual_income) AS min_income, MAX(annual_income) AS max_income
FROM applications"""

ROUTE_PREMIUM = with_(APPLICATIONS) + "SELECT * FROM applications WHERE annual_income > 100000"
ROUTE_STANDARD = with_(APPLICATIONS) + "SELECT * FROM applications WHERE annual_income <= 100000"

EARLIER_APPLICATIONS = """
earlier_applications AS (
  SELECT a.* FROM applications a JOIN customer c
    ON a.application_id = concat('APP-', lpad(CAST(c.c_custkey AS varchar), 6, '0'))
  WHERE c.c_mktsegment <> 'HOUSEHOLD'
)"""

UPSERT_ACCOUNTS = with_(APPLICATIONS, PORTFOLIO, EARLIER_APPLICATIONS,
                        approvals_cte("earlier", "earlier_applications", 120000, "0.12", "0.06", 1500)) + f"""
SELECT COALESCE(e.application_id, t.application_id) AS application_id,
       CASE WHEN e.application_id IS NULL THEN t.customer_name ELSE e.customer_name END AS customer_name,
       CASE WHEN e.application_id IS NULL THEN t.annual_income ELSE e.annual_income END AS annual_income,
       CASE WHEN e.application_id IS NULL THEN t.card_product ELSE e.card_product END AS card_product,
       CASE WHEN t.application_id IS NULL THEN e.credit_limit ELSE t.credit_limit END AS credit_limit,
       CASE WHEN e.application_id IS NULL THEN t.income_tier ELSE e.income_tier END AS income_tier,
       CASE WHEN e.application_id IS NOT NULL AND t.application_id IS NOT NULL THEN {AS_OF_SQL}
            ELSE CAST(NULL AS TIMESTAMP) END AS last_updated
FROM earlier e FULL OUTER JOIN portfolio t ON e.application_id = t.application_id"""

SKIP_EMPTY_LOAD = with_(APPLICATIONS, PORTFOLIO) + """
SELECT application_id, customer_name, annual_income, card_product, credit_limit, income_tier, CAST(NULL AS TIMESTAMP) AS last_updated, 1 AS version
FROM portfolio"""

# --------------------------------------------------------------------------- clickstream sinks

MART_COLS = ("total_orders", "total_subtotal", "total_tax", "total_spend", "avg_session_duration_secs",
             "most_common_browser", "most_common_os")

MERGE_CUSTOMER_METRICS = with_(CLICKSTREAM, STAGED_A, """
staged_earlier AS (SELECT * FROM staged WHERE order_date < TIMESTAMP '2000-01-01 00:00:00')""",
                               mart_cte("earlier", "staged_earlier"), mart_cte("full", "staged")) + f"""
SELECT COALESCE(e.customer_id, f.customer_id) AS customer_id,
       {", ".join(f"CASE WHEN f.customer_id IS NULL THEN e.{c} ELSE f.{c} END AS {c}" for c in MART_COLS)}
FROM (SELECT * FROM mart_earlier WHERE customer_id IS NOT NULL) e
FULL OUTER JOIN (SELECT * FROM mart_full WHERE customer_id IS NOT NULL) f ON e.customer_id = f.customer_id
UNION ALL SELECT * FROM mart_earlier WHERE customer_id IS NULL
UNION ALL SELECT * FROM mart_full WHERE customer_id IS NULL"""

INSERT_METRICS_TWICE = f"SELECT * FROM ({CUSTOMER_METRICS_B}) UNION ALL SELECT * FROM ({CUSTOMER_METRICS_B})"

# --------------------------------------------------------------------------- sales

TOP_CUSTOMERS = with_(SALES) + """
SELECT customerID, COUNT(*) AS transactions, CAST(SUM(quantity * unitPrice) AS DECIMAL(38,2)) AS revenue
FROM sales GROUP BY customerID ORDER BY revenue DESC, customerID ASC LIMIT 5"""

TOP_PRODUCTS = with_(SALES) + """
SELECT product, CAST(SUM(quantity) AS BIGINT) AS units_sold,
       CAST(SUM(quantity * unitPrice) AS DECIMAL(38,2)) AS revenue
FROM sales GROUP BY product ORDER BY units_sold DESC, product ASC LIMIT 5"""

SALES_BY_DAY = with_(SALES) + f"""
SELECT dayname(dateTime) AS day, COUNT(*) AS transactions, {mean2('quantity * unitPrice', 2)} AS avg_sale
FROM sales GROUP BY dayname(dateTime) ORDER BY transactions DESC, day ASC"""

REPORT_FAN_OUT = with_(SALES) + f"""
SELECT 'by_store' AS dimension, CAST(customerID AS VARCHAR) AS label, transactions AS n, revenue AS amount FROM ({TOP_CUSTOMERS.partition(SALES)[2]})
UNION ALL SELECT 'by_product', product, units_sold, revenue FROM ({TOP_PRODUCTS.partition(SALES)[2]})
UNION ALL SELECT 'by_day_of_week', day, transactions, CAST(avg_sale AS DECIMAL(38,2)) FROM ({SALES_BY_DAY.partition(SALES)[2]})"""

TABLE_ROW_COUNT = with_(SALES) + "SELECT COUNT(*) AS row_count FROM sales"

# --------------------------------------------------------------------------- feed

ISO_OK = "try_strptime({c}, '%Y-%m-%d') IS NOT NULL"
US_TO_ISO = "strftime(try_strptime({c}, '%m/%d/%Y'), '%Y-%m-%d')"
BAD_ROW = f"(NOT coalesce({ISO_OK.format(c='order_date')}, false) OR NOT coalesce({ISO_OK.format(c='ship_date')}, false))"

LANDING_WITH_LINEAGE = with_(LANDING) + f"""
SELECT o_orderkey, order_date, ship_date, 'daily_orders.csv' AS _source_file, {AS_OF_SQL} AS _ingested_at
FROM landing"""

FEED_INFERRED = """
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 3 = 2 THEN o_totalprice ELSE floor(o_totalprice) END AS total,
       CASE WHEN o_orderkey % 3 = 2 THEN 'C' ELSE '' END || CAST(o_orderkey AS VARCHAR) AS code, o_orderkey % 2 = 0 AS urgent,
       CAST(NULL AS DOUBLE) AS note, strftime(o_orderdate, '%Y-%m-%d') AS order_date
FROM orders"""

BAD_DATE_COUNT = with_(LANDING) + f"SELECT COUNT(*) FILTER (WHERE {BAD_ROW}) AS bad_dates FROM landing"

NORMALIZE_DATES = with_(LANDING) + f"""
SELECT o_orderkey,
       CASE WHEN {BAD_ROW} THEN {US_TO_ISO.format(c='order_date')} ELSE order_date END AS order_date,
       CASE WHEN {BAD_ROW} THEN {US_TO_ISO.format(c='ship_date')} ELSE ship_date END AS ship_date
FROM landing"""

REPAIR_LANDING = with_(LANDING) + f"""
SELECT o_orderkey, 'orders_' || CAST(o_orderkey % 3 AS VARCHAR) || '.csv' AS _source_file,
       CASE WHEN o_orderkey % 3 = 1 AND {BAD_ROW} THEN {US_TO_ISO.format(c='order_date')} ELSE order_date END AS order_date,
       CASE WHEN o_orderkey % 3 = 1 AND {BAD_ROW} THEN {US_TO_ISO.format(c='ship_date')} ELSE ship_date END AS ship_date
FROM landing"""

STREAMING_FEED_AUDIT = with_(LANDING) + f"""
SELECT 'orders_' || CAST(o_orderkey % 3 AS VARCHAR) || '.csv' AS source_file, COUNT(*) AS rows_loaded,
       COUNT(*) FILTER (WHERE {BAD_ROW}) AS date_fixes_applied, 'SUCCESS' AS status, {AS_OF_SQL} AS logged_at
FROM landing GROUP BY o_orderkey % 3"""

NORMALIZE_DATES_BY_COLUMN = with_(LANDING) + f"""
SELECT o_orderkey,
       CASE WHEN coalesce({ISO_OK.format(c='order_date')}, false) THEN order_date
            ELSE {US_TO_ISO.format(c='order_date')} END AS order_date,
       CASE WHEN coalesce({ISO_OK.format(c='ship_date')}, false) THEN ship_date
            ELSE {US_TO_ISO.format(c='ship_date')} END AS ship_date
FROM landing"""

INGEST_AUDIT = with_(LANDING) + f"""
SELECT 'feeds/daily_orders.csv.pgp' AS source_file, COUNT(*) AS rows_loaded,
       COUNT(*) FILTER (WHERE {BAD_ROW}) AS date_fixes_applied, 'SUCCESS' AS status, {AS_OF_SQL} AS logged_at
FROM landing"""

# --------------------------------------------------------------------------- data quality

BROWSERS = "('Chrome', 'Safari', 'Firefox', 'Edge', 'Opera', 'Other')"
OSES = "('Windows', 'macOS', 'Android', 'iOS', 'Linux', 'Other')"


def nn(table: str, src: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'not_null' AS test_name, "
            f"COUNT(*) FILTER (WHERE {col} IS NULL) AS violations FROM {src}")


def av(table: str, src: str, col: str, values: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'accepted_values' AS test_name, "
            f"COUNT(DISTINCT {col}) FILTER (WHERE {col} NOT IN {values}) AS violations FROM {src}")


def uq(table: str, src: str, col: str) -> str:
    return (f"SELECT '{table}' AS table_name, '{col}' AS column_name, 'unique' AS test_name, COUNT(*) AS violations "
            f"FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL GROUP BY {col} HAVING COUNT(*) > 1)")


DQ_NOT_NULL = with_(CLICKSTREAM, STAGED_A) + nn("stg_clickstream", "staged", "customer_id")
DQ_UNIQUE = with_(CLICKSTREAM, STAGED_A, mart_cte("m", "staged")) + uq("fct_customer_metrics", "mart_m", "customer_id")
DQ_UNIQUE_REPEATS = with_(CLICKSTREAM, STAGED_A) + uq("stg_clickstream", "staged", "order_id")
DQ_ACCEPTED_VALUES_VIOLATED = with_(CLICKSTREAM, STAGED_A) + av("stg_clickstream", "staged", "browser", "('Chrome', 'Safari')")
DQ_ACCEPTED_VALUES = with_(CLICKSTREAM, STAGED_A) + av("stg_clickstream", "staged", "browser", BROWSERS)

_STG_NN = ("order_id", "customer_id", "order_date", "subtotal", "tax", "click_id", "session_duration_secs",
           "browser", "os")
_MART_NN = ("customer_id", "total_orders", "total_subtotal", "total_tax", "total_spend",
            "avg_session_duration_secs", "most_common_browser", "most_common_os")
DQ_REPORT = with_(CLICKSTREAM, STAGED_A, mart_cte("m", "staged")) + "\nUNION ALL ".join(
    [nn("stg_clickstream", "staged", c) for c in _STG_NN]
    + [av("stg_clickstream", "staged", "browser", BROWSERS), av("stg_clickstream", "staged", "os", OSES)]
    + [nn("fct_customer_metrics", "mart_m", c) for c in _MART_NN]
    + [uq("fct_customer_metrics", "mart_m", "customer_id"),
       av("fct_customer_metrics", "mart_m", "most_common_browser", BROWSERS),
       av("fct_customer_metrics", "mart_m", "most_common_os", OSES)])


# --------------------------------------------------------------------------- streaming and ML

VENDOR_DROP_COUNTS = """
SELECT 'vendor_data_' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS file, COUNT(*) AS record_count,
       'v3' AS schema_version,
       's3://vendor-archive/2026/vendor_data_' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS cold_path
FROM events GROUP BY event_id % 3"""

ARCHIVE_PROCESSED = """
SELECT 'vendor_data_' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS file, COUNT(*) AS record_count,
       's3://vendor-archive/2026/vendor_data_' || CAST(event_id % 3 AS VARCHAR) || '.csv' AS cold_path
FROM events GROUP BY event_id % 3"""

PREPARE_FEATURES = r"""
SELECT d.doc_id, l.quality AS label, CAST(d.n_chars AS DOUBLE) AS n_chars,
       CAST(len(regexp_extract_all(d.text, '[^ \t\n\r\f\x0B]+')) AS DOUBLE) AS n_words,
       CAST(len(regexp_extract_all(d.text, '[0-9]')) AS DOUBLE) AS n_digits
FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""


FITTED_FEATURES = f"""
WITH known AS (
  SELECT doc_id, CAST(label AS BIGINT) AS label, ((doc_id % 4) + 4) % 4 < 3 AS training, n_chars, n_words, n_digits
  FROM ({PREPARE_FEATURES}) WHERE label IS NOT NULL AND doc_id IS NOT NULL),
means AS (SELECT avg(n_chars) AS c, avg(n_words) AS w, avg(n_digits) AS d FROM known WHERE training),
imputed AS (
  SELECT doc_id, label, training, coalesce(n_chars, c) AS chars, coalesce(n_words, w) AS words, coalesce(n_digits, d) AS digits FROM known, means),
scales AS (SELECT 1 / coalesce(nullif(max(chars), 0), 1) AS c, 1 / coalesce(nullif(max(words), 0), 1) AS w, 1 / coalesce(nullif(max(digits), 0), 1) AS d
           FROM imputed WHERE training)
SELECT doc_id, label, chars * c AS chars, words * w AS words, digits * d AS digits, 87 AS feature_count FROM imputed, scales"""

FEATURE_SET = f"SELECT COUNT(*) AS rows, 3 AS feature_count, 'features' AS path FROM ({PREPARE_FEATURES})"


def tuning(rounds: int = 8) -> str:
    """Full-batch logistic regression at the three rates, a CTE a round; ends with the CTE scores."""
    z = "(w0 + w1 * (x1 / 100000::DOUBLE) + w2 * (x2 / 100000::DOUBLE) + w3 * (x3 / 100000::DOUBLE))"
    x = lambda c: f"CAST(floor(ln({c} + 1::DOUBLE) / 10::DOUBLE * 100000::DOUBLE + 0.5::DOUBLE) AS BIGINT)"
    ctes = [f"""features AS ({PREPARE_FEATURES})""", f"""
points AS (SELECT ((doc_id % 4) + 4) % 4 AS fold, CAST(label AS BIGINT) AS y, CAST({x('n_chars')} AS DOUBLE) AS x1,
           CAST({x('n_words')} AS DOUBLE) AS x2, CAST({x('n_digits')} AS DOUBLE) AS x3
           FROM features WHERE doc_id IS NOT NULL AND label IS NOT NULL AND n_chars IS NOT NULL AND n_words IS NOT NULL)""", """
round0 AS (SELECT rate, place, 0::DOUBLE AS w0, 0::DOUBLE AS w1, 0::DOUBLE AS w2, 0::DOUBLE AS w3
           FROM (VALUES (0.01::DOUBLE, 0), (0.05::DOUBLE, 1), (0.1::DOUBLE, 2)) AS r(rate, place))"""]
    for k in range(rounds):
        moved = [f"floor((w{j} - rate * 50::DOUBLE * (CAST(SUM(e{' * CAST(x%d AS BIGINT)' % j if j else ''}) AS DOUBLE) / "
                 f"{'100000000000' if j else '1000000'}::DOUBLE / COUNT(*))) * 1000000::DOUBLE + 0.5::DOUBLE) / 1000000::DOUBLE AS w{j}" for j in range(4)]
        ctes.append(f"""
round{k + 1} AS (SELECT rate, place, {", ".join(moved)}
           FROM (SELECT *, CAST(floor(1000000::DOUBLE / (1::DOUBLE + exp(-{z})) + 0.5::DOUBLE) AS BIGINT) - y * 1000000 AS e
                 FROM points, round{k} WHERE fold < 3)
           GROUP BY rate, place, w0, w1, w2, w3)""")
    ctes.append(f"""
scores AS (SELECT rate AS learning_rate, place,
           floor(SUM(CASE WHEN ({z} >= 0) = (y = 1) THEN 1 ELSE 0 END) * 10000::DOUBLE / COUNT(*) + 0.5::DOUBLE) / 10000::DOUBLE AS accuracy
           FROM points, round{rounds} WHERE fold = 3 GROUP BY rate, place)""")
    return "WITH " + ",".join(ctes) + "\n"


CANDIDATE_SCORES = tuning() + "SELECT learning_rate, accuracy FROM scores"
BEST_CANDIDATE = tuning() + "SELECT learning_rate, accuracy FROM scores ORDER BY accuracy DESC, place LIMIT 1"
TUNE_LEARNING_RATE = tuning() + f"""
SELECT 'document_quality' AS model_name, 1 AS version, 'models/document_quality/v0001' AS model_path, learning_rate, accuracy,
       {AS_OF_SQL} AS registered_at
FROM (SELECT * FROM scores ORDER BY accuracy DESC, place LIMIT 1)"""


def oracle_sql() -> dict[str, str]:
    return {
        "approve_applications": APPROVE_APPLICATIONS,
        "approval_summary": APPROVAL_SUMMARY,
        "tier_volumes": TIER_VOLUMES,
        "ingest_stats": INGEST_STATS,
        "route_premium": ROUTE_PREMIUM,
        "route_standard": ROUTE_STANDARD,
        "approve_with_config": APPROVE_WITH_CONFIG,
        "combine_portfolios": APPROVE_APPLICATIONS,
        "upsert_accounts": UPSERT_ACCOUNTS,
        "skip_empty_load": SKIP_EMPTY_LOAD,
        "staged_clickstream": STAGED_CLICKSTREAM,
        "staged_clickstream_b": STAGED_CLICKSTREAM_B,
        "customer_metrics": CUSTOMER_METRICS,
        "customer_metrics_b": CUSTOMER_METRICS_B,
        "customer_metrics_windowed": CUSTOMER_METRICS,
        "customer_metrics_bucketed": CUSTOMER_METRICS,
        "customer_metrics_merged": CUSTOMER_METRICS,
        "order_recency_rank": ORDER_RECENCY_RANK,
        "merge_customer_metrics": MERGE_CUSTOMER_METRICS,
        "insert_metrics_twice": INSERT_METRICS_TWICE,
        "append_raw_clickstream": with_(CLICKSTREAM) + "SELECT * FROM clickstream",
        "top_customers_by_revenue": TOP_CUSTOMERS,
        "top_products_by_units": TOP_PRODUCTS,
        "sales_by_day_of_week": SALES_BY_DAY,
        "table_row_count": TABLE_ROW_COUNT,
        "report_fan_out": REPORT_FAN_OUT,
        "landing_with_lineage": LANDING_WITH_LINEAGE,
        "feed_inferred": FEED_INFERRED,
        "repair_landing": REPAIR_LANDING,
        "bad_date_count": BAD_DATE_COUNT,
        "normalize_dates": NORMALIZE_DATES,
        "normalize_dates_by_column": NORMALIZE_DATES_BY_COLUMN,
        "ingest_audit": INGEST_AUDIT,
        "dq_not_null": DQ_NOT_NULL,
        "dq_unique": DQ_UNIQUE,
        "dq_unique_repeats": DQ_UNIQUE_REPEATS,
        "dq_accepted_values": DQ_ACCEPTED_VALUES,
        "dq_accepted_values_violated": DQ_ACCEPTED_VALUES_VIOLATED,
        "dq_report": DQ_REPORT,
        "vendor_drop_counts": VENDOR_DROP_COUNTS,
        "archive_processed": ARCHIVE_PROCESSED,
        "streaming_feed_ingest": NORMALIZE_DATES,
        "streaming_feed_audit": STREAMING_FEED_AUDIT,
        "prepare_features": PREPARE_FEATURES,
        "feature_set": FEATURE_SET,
        "candidate_scores": CANDIDATE_SCORES,
        "best_candidate": BEST_CANDIDATE,
        "tune_learning_rate": TUNE_LEARNING_RATE,
        "fitted_features": FITTED_FEATURES,
    }
