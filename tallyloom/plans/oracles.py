"""The registered queries as SQL over the driver's tables, for an independent check.

``PRELUDE`` derives sources, dimensions and facts with plain SQL; every query is
the prelude and one SELECT. Sums are exact decimals and cast to DOUBLE last, and
quotients are rounded on integers, so that no engine's float rounding matters.
"""

from __future__ import annotations

from collections.abc import Iterable

_PHONE = """CASE WHEN c_custkey % 97 = 0 THEN '{p}' || substr(d8, 2, 7)
       WHEN c_custkey % 97 = 1 THEN '{p} ' || substr(d8, 1, 4) || ' ' || substr(d8, 5, 4)
       ELSE '{p}' || d8 END"""
_CATEGORY = """CASE WHEN p_partkey % 101 = 0 THEN '{3}' WHEN p_partkey % 3 = 0 THEN '{0}'
       WHEN p_partkey % 3 = 1 THEN '{1}' ELSE '{2}' END"""

PRELUDE = f"""
WITH people AS (
  SELECT *, lpad(CAST(c_custkey % 100000000 AS VARCHAR), 8, '0') AS d8,
         DATE '1994-01-01' + CAST(c_custkey % 365 AS INTEGER) AS signup
  FROM customer JOIN nation ON n_nationkey = c_nationkey
),
a_customers AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS full_name,
         {_PHONE.format(p="+9639")} AS phone, 'مدينة ' || n_nationkey AS city_ar, signup AS signup_date
  FROM people WHERE c_custkey % 2 = 0
),
b_clients AS (
  SELECT md5('client-' || c_custkey) AS client_id, c_name AS client_name,
         {_PHONE.format(p="09")} AS msisdn, n_name AS city_en, signup AS registered_at
  FROM people WHERE c_custkey % 2 = 1
),
a_products AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, 'منتج ' || p_partkey AS product_name,
         {_CATEGORY.format("Internet", "Voice", "Bundle", "internet")} AS category,
         CAST(floor(p_retailprice) AS INTEGER) AS unit_price
  FROM part
),
b_items AS (
  SELECT md5('item-' || p_partkey) AS item_id, p_name || ' ' || p_partkey AS item_name,
         {_CATEGORY.format("INTERNET", "VOICE", "BUNDLE", "OTHER")} AS item_type,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price_syp
  FROM part
),
order_lines AS (
  SELECT l_orderkey || '-' || l_linenumber AS line, l_orderkey, o_custkey, l_partkey,
         CASE WHEN l_orderkey % 89 = 3 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
         CAST(floor(p_retailprice) AS INTEGER) AS whole_price,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price, CAST(o_orderdate AS DATE) AS odate,
         strftime(CAST(o_orderdate AS TIMESTAMP), '%H:%M:%S') AS otime
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
),
a_orders AS (
  SELECT line AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id, CAST(l_partkey AS VARCHAR) AS product_id,
         quantity, whole_price AS unit_price_at_sale,
         CAST(quantity AS BIGINT) * whole_price + CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS total_price,
         odate AS order_date
  FROM order_lines WHERE o_custkey % 2 = 0
),
b_transactions AS (
  SELECT md5(line) AS tx_id, md5('client-' || o_custkey) AS client_id, md5('item-' || l_partkey) AS item_id,
         quantity AS qty, price AS price_at_tx, odate AS tx_date, otime AS tx_time
  FROM order_lines WHERE o_custkey % 2 = 1
),
cities AS (SELECT 'مدينة ' || n_nationkey AS ar, n_name AS en FROM nation WHERE n_nationkey < 23),
catalog AS (
  SELECT 'منتج ' || p_partkey AS local_name, p_name || ' ' || p_partkey AS english_name
  FROM part WHERE p_partkey % 11 <> 0
),
customers_judged AS (
  SELECT 'OPA' AS source_system, 'customers' AS source_table, customer_id AS source_customer_id, full_name,
         CASE WHEN regexp_matches(regexp_replace(phone, '\\s+', '', 'g'), '^\\+9639[0-9]{{8}}$')
              THEN regexp_replace(phone, '\\s+', '', 'g') END AS phone_e164,
         en AS city, signup_date, phone AS raw_phone, city_ar AS raw_city
  FROM a_customers LEFT JOIN cities ON ar = city_ar
  UNION ALL
  SELECT 'OPB', 'clients', client_id, client_name,
         CASE WHEN regexp_matches(regexp_replace(msisdn, '\\s+', '', 'g'), '^09[0-9]{{8}}$')
              THEN '+963' || substr(regexp_replace(msisdn, '\\s+', '', 'g'), 2) END,
         en, registered_at, msisdn, city_en
  FROM b_clients LEFT JOIN cities ON en = city_en
),
customers_reasoned AS (
  SELECT *, CASE WHEN city IS NULL THEN 'unknown_city' WHEN phone_e164 IS NULL THEN 'invalid_phone' END AS reason_code,
         CASE WHEN city IS NULL THEN 'unknown city: ''' || raw_city || ''''
              WHEN phone_e164 IS NULL THEN 'invalid phone for ' || source_system || ': ''' || raw_phone || '''' END AS reason
  FROM customers_judged
),
products_judged AS (
  SELECT 'OPA' AS source_system, 'products' AS source_table, product_id AS source_product_id,
         coalesce(english_name, product_name) AS product_name_en,
         CASE category WHEN 'Internet' THEN 'INTERNET' WHEN 'Voice' THEN 'VOICE' WHEN 'Bundle' THEN 'BUNDLE' END AS category,
         CAST(unit_price AS DECIMAL(14,2)) AS unit_price_syp, category AS raw_category
  FROM a_products LEFT JOIN catalog ON local_name = product_name
  UNION ALL
  SELECT 'OPB', 'items', item_id, coalesce(english_name, item_name),
         CASE WHEN item_type IN ('INTERNET', 'VOICE', 'BUNDLE') THEN item_type END,
         CAST(price_syp AS DECIMAL(14,2)), item_type
  FROM b_items LEFT JOIN catalog ON english_name = item_name
),
products_reasoned AS (
  SELECT *, CASE WHEN category IS NULL THEN 'unknown_category' END AS reason_code,
         CASE WHEN category IS NULL THEN 'unknown category for ' || source_system || ': ''' || raw_category || '''' END AS reason
  FROM products_judged
),
dim_customer AS (
  SELECT row_number() OVER (ORDER BY source_system, source_customer_id) AS customer_sk, *
  FROM customers_reasoned WHERE reason_code IS NULL
),
dim_product AS (
  SELECT row_number() OVER (ORDER BY source_system, source_product_id) AS product_sk, *
  FROM products_reasoned WHERE reason_code IS NULL
),
dim_company AS (
  SELECT * FROM (VALUES (1, 'OPA', 'المشغل أ', 'Operator A'), (2, 'OPB', 'المشغل ب', 'Operator B'))
    AS c(company_sk, company_code, company_name_ar, company_name_en)
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_sk, CAST(d AS DATE) AS full_date,
         year(d) AS year, quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
         day(d) AS day, dayofweek(d) AS day_of_week, dayofweek(d) IN (5, 6) AS is_weekend
  FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-06-30', INTERVAL 1 DAY)) AS d)
),
sales_keyed AS (
  SELECT 'OPA' AS source_system, 'orders' AS source_table, 1 AS company_sk, order_id AS source_order_id,
         customer_id AS natural_customer, product_id AS natural_product, order_date AS odate, quantity,
         CAST(unit_price_at_sale AS DECIMAL(14,2)) AS unit_price_syp, total_price AS stored,
         'customer_id' AS customer_column, 'product_id' AS product_column, NULL AS otime
  FROM a_orders
  UNION ALL
  SELECT 'OPB', 'transactions', 2, tx_id, client_id, item_id, tx_date, qty,
         CAST(price_at_tx AS DECIMAL(14,2)), NULL, 'client_id', 'item_id', tx_time
  FROM b_transactions
),
sales_resolved AS (
  SELECT s.*, customer_sk, product_sk, date_sk AS calendar_sk,
         CAST(strftime(odate, '%Y%m%d') AS INTEGER) AS date_sk,
         CAST(s.quantity * s.unit_price_syp AS DECIMAL(14,2)) AS total_amount_syp
  FROM sales_keyed s
  LEFT JOIN dim_customer c ON c.source_system = s.source_system AND c.source_customer_id = natural_customer
  LEFT JOIN dim_product p ON p.source_system = s.source_system AND p.source_product_id = natural_product
  LEFT JOIN dim_date d ON d.full_date = odate
),
sales_judged AS (
  SELECT *, customer_sk IS NULL OR product_sk IS NULL OR calendar_sk IS NULL OR quantity <= 0 AS rejected,
         CASE WHEN customer_sk IS NULL THEN 'no_customer' WHEN product_sk IS NULL THEN 'no_product'
              WHEN calendar_sk IS NULL THEN 'date_not_in_calendar' WHEN quantity <= 0 THEN 'invalid_quantity'
              WHEN stored <> total_amount_syp THEN 'inconsistent_stored_total' END AS reason_code,
         CASE WHEN customer_sk IS NULL THEN 'no customer_sk for ' || source_system || ' ' || customer_column || ': ''' || natural_customer || ''''
              WHEN product_sk IS NULL THEN 'no product_sk for ' || source_system || ' ' || product_column || ': ''' || natural_product || ''''
              WHEN calendar_sk IS NULL THEN 'date not in calendar: ''' || odate || ''''
              WHEN quantity <= 0 THEN 'quantity not positive: ''' || quantity || ''''
              WHEN stored <> total_amount_syp THEN 'inconsistent_stored_total: stored=' || stored || ', computed='
                   || CAST(total_amount_syp AS BIGINT) END AS reason
  FROM sales_resolved
),
fact_sales AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY company_sk, source_order_id
             ORDER BY date_sk, product_sk, quantity, unit_price_syp, total_amount_syp, customer_sk) AS place
    FROM sales_judged WHERE NOT rejected)
  WHERE place = 1
),
errors AS (
  SELECT source_system, source_table, reason_code, reason FROM customers_reasoned WHERE reason_code IS NOT NULL
  UNION ALL
  SELECT source_system, source_table, reason_code, reason FROM products_reasoned WHERE reason_code IS NOT NULL
  UNION ALL
  SELECT source_system, source_table, reason_code, reason FROM sales_judged WHERE reason_code IS NOT NULL
)
"""


def pct(part: str, whole: str) -> str:
    """100 * part / whole of two decimal(_, 2) amounts, half away from zero at 2 digits."""
    p, w = f"CAST(({part}) * 100 AS HUGEINT)", f"CAST(({whole}) * 100 AS HUGEINT)"
    return (f"CASE WHEN ({whole}) <> 0 THEN "
            f"sign({p}) * CAST((20000 * abs({p}) + {w}) // (2 * {w}) AS DOUBLE) / 100 END")


def avg(total: str, count: str, scale: int = 2) -> str:
    """total / count of a decimal(_, 2) amount, half away from zero."""
    unit = 10 ** (2 - scale)
    t, n = f"CAST(({total}) * 100 AS HUGEINT)", f"(({count}) * {unit})"
    return f"CAST((2 * {t} + {n}) // (2 * {n}) AS DOUBLE) / {10 ** scale}"


def money(col: str) -> str:
    return f"CAST({col} AS DOUBLE)"


_MONTHLY = """monthly AS (
  SELECT year, month, company_code, SUM(total_amount_syp) AS sales, COUNT(*) AS order_count
  FROM fact_sales f JOIN dim_date d ON d.date_sk = f.date_sk JOIN dim_company USING (company_sk)
  GROUP BY year, month, company_code)"""

_CITY = """city AS (
  SELECT c.city, SUM(CASE WHEN f.company_sk = 1 THEN total_amount_syp ELSE 0 END) AS opa,
         SUM(CASE WHEN f.company_sk = 2 THEN total_amount_syp ELSE 0 END) AS opb,
         SUM(total_amount_syp) AS total, COUNT(DISTINCT f.customer_sk) AS customers, COUNT(*) AS orders
  FROM fact_sales f JOIN dim_customer c ON c.customer_sk = f.customer_sk GROUP BY c.city)"""

_COMPANY = """company AS (
  SELECT company_code, company_name_en, SUM(total_amount_syp) AS total, COUNT(*) AS orders,
         COUNT(DISTINCT customer_sk) AS customers
  FROM fact_sales JOIN dim_company USING (company_sk) GROUP BY company_code, company_name_en),
national AS (SELECT SUM(total) AS everything FROM company)"""

_INDICATORS = """per_customer AS (
  SELECT customer_sk, SUM(total_amount_syp) AS customer_total FROM fact_sales GROUP BY customer_sk),
tenth AS (
  SELECT SUM(customer_total) AS top FROM (
    SELECT customer_total, ntile(10) OVER (ORDER BY customer_total DESC, customer_sk) AS decile FROM per_customer)
  WHERE decile = 1),
dated AS (
  SELECT full_date, total_amount_syp, MAX(full_date) OVER () AS as_of
  FROM fact_sales f JOIN dim_date d ON d.date_sk = f.date_sk),
trend AS (
  SELECT SUM(CASE WHEN full_date > as_of - INTERVAL 3 MONTH THEN total_amount_syp ELSE 0 END) AS last_3m,
         SUM(CASE WHEN full_date <= as_of - INTERVAL 3 MONTH AND full_date > as_of - INTERVAL 6 MONTH
                  THEN total_amount_syp ELSE 0 END) AS prior_3m, SUM(total_amount_syp) AS total
  FROM dated),
indicators AS (
  SELECT top, last_3m, prior_3m, total, (SELECT COUNT(DISTINCT city) FROM dim_customer) AS cities_served,
         (SELECT COUNT(*) FROM dim_customer) AS total_customers
  FROM tenth, trend)"""

_RFM_RAW = """as_of AS (SELECT MAX(full_date) AS as_of FROM fact_sales f JOIN dim_date d ON d.date_sk = f.date_sk),
rfm AS (
  SELECT f.customer_sk, c.full_name, c.city, c.source_system, company_name_en AS company, company_code,
         datediff('day', MAX(full_date), MAX(as_of)) AS recency_days, COUNT(*) AS frequency,
         SUM(total_amount_syp) AS monetary
  FROM fact_sales f JOIN dim_date d ON d.date_sk = f.date_sk JOIN dim_customer c ON c.customer_sk = f.customer_sk
  JOIN dim_company USING (company_sk), as_of
  GROUP BY f.customer_sk, c.full_name, c.city, c.source_system, company_name_en, company_code)"""

_RFM_SCORED = _RFM_RAW + """,
ranked AS (
  SELECT *, COUNT(*) OVER () AS n, row_number() OVER (ORDER BY recency_days, customer_sk) AS kr,
         row_number() OVER (ORDER BY frequency, customer_sk) AS kf,
         row_number() OVER (ORDER BY monetary, customer_sk) AS km
  FROM rfm),
scored AS (
  SELECT *, greatest(1, (5 * (n - kr) + n - 2) // (n - 1)) AS r_score,
         greatest(1, (5 * (kf - 1) + n - 2) // (n - 1)) AS f_score,
         greatest(1, (5 * (km - 1) + n - 2) // (n - 1)) AS m_score
  FROM ranked),
segmented AS (
  SELECT *, CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
                 WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
                 WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                 WHEN r_score >= 4 AND f_score = 1 THEN 'New'
                 WHEN r_score = 1 AND f_score <= 2 THEN 'Lost' ELSE 'Other' END AS segment
  FROM scored),
summary AS (
  SELECT segment, COUNT(*) AS count, CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS part
  FROM segmented GROUP BY segment)"""

_SUMMARY_SELECT = """SELECT segment, count, round(part * 100, 1) AS pct,
  CASE segment WHEN 'Champions' THEN 'أبطال' WHEN 'Loyal' THEN 'مخلصون' WHEN 'At Risk' THEN 'معرضون للخطر'
               WHEN 'New' THEN 'جدد' WHEN 'Lost' THEN 'مفقودون' ELSE 'أخرى' END AS segment_ar FROM summary"""

_SERIES = _MONTHLY + """,
series AS (
  SELECT company_code, make_date(year, month, 1) AS period, CAST(sales AS DOUBLE) AS y,
         row_number() OVER (PARTITION BY company_code ORDER BY year DESC, month DESC) AS from_end,
         COUNT(*) OVER (PARTITION BY company_code) AS points
  FROM monthly),
kept AS (
  SELECT company_code, period, y, row_number() OVER (PARTITION BY company_code ORDER BY period) AS x
  FROM series WHERE points >= 3 AND from_end > 1)"""

# Smoothing with fixed parameters as a recursion over the months.
_HOLT = _SERIES + """,
smoothed AS (
  SELECT company_code, x, period, y, y + 0.0 AS fitted, 0.3 * y + 0.7 * (y + 0.0) AS level,
         0.1 * ((0.3 * y + 0.7 * (y + 0.0)) - y) + 0.9 * CAST(0.0 AS DOUBLE) AS trend
  FROM kept WHERE x = 1
  UNION ALL
  SELECT k.company_code, k.x, k.period, k.y, s.level + s.trend,
         0.3 * k.y + 0.7 * (s.level + s.trend),
         0.1 * ((0.3 * k.y + 0.7 * (s.level + s.trend)) - s.level) + 0.9 * s.trend
  FROM smoothed s JOIN kept k ON k.company_code = s.company_code AND k.x = s.x + 1)"""



def _fold(n: int) -> str:
    """Normal equations of every cell of grid ``n``, as a recursion over the months, and
    the best cell: smallest error, then alpha, then beta."""
    return f"""fold{n} AS (
  SELECT company_code, alpha, beta, CAST(0 AS BIGINT) AS x, 0e0 AS lc, 1e0 AS ll, 0e0 AS lt,
         0e0 AS tc, 0e0 AS tl, 1e0 AS tt, 0e0 AS sll, 0e0 AS slt, 0e0 AS stt, 0e0 AS sly, 0e0 AS sty, 0e0 AS syy
  FROM grid{n}
  UNION ALL
  SELECT company_code, alpha, beta, x, nlc, nll, nlt, beta * (nlc - lc) + (1 - beta) * tc,
         beta * (nll - ll) + (1 - beta) * tl, beta * (nlt - lt) + (1 - beta) * tt, sll + pl * pl, slt + pl * pt,
         stt + pt * pt, sly + pl * e, sty + pt * e, syy + e * e
  FROM (SELECT *, (1 - alpha) * pc + alpha * ys AS nlc, (1 - alpha) * pl AS nll, (1 - alpha) * pt AS nlt, ys - pc AS e
        FROM (SELECT f.* EXCLUDE (x), k.x, k.y / k.scale AS ys, lc + tc AS pc, ll + tl AS pl, lt + tt AS pt
              FROM fold{n} f JOIN scaled k ON k.company_code = f.company_code AND k.x = f.x + 1))),
solved{n} AS (
  SELECT company_code, alpha, beta, level0, trend0,
         greatest(0, round(syy - level0 * sly - trend0 * sty, 12)) AS sse
  FROM (SELECT *, sll * stt - slt * slt AS det, (sly * stt - sty * slt) / (sll * stt - slt * slt) AS level0,
               (sty * sll - sly * slt) / (sll * stt - slt * slt) AS trend0
        FROM fold{n} JOIN lengths USING (company_code)
        WHERE x = n AND sll * stt - slt * slt > 1e-9 * greatest(sll * stt, 1e-300))),
best{n} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY company_code ORDER BY sse, alpha, beta) AS place FROM solved{n})
  WHERE place = 1)"""


_FIT = f"""{_SERIES},
scaled AS MATERIALIZED (
  SELECT company_code, x, period, y, greatest(MAX(abs(y)) OVER (PARTITION BY company_code), 1e-300) AS scale
  FROM kept),
lengths AS (SELECT company_code, MAX(x) AS n, MAX(period) AS last, MAX(scale) AS scale FROM scaled GROUP BY company_code),
grid1 AS (
  SELECT company_code, a / 20e0 AS alpha, b / 20e0 AS beta
  FROM lengths, (SELECT unnest(range(0, 21)) AS a), (SELECT unnest(range(0, 21)) AS b)),
{_fold(1)},
grid2 AS (
  SELECT DISTINCT company_code, least(1e0, greatest(0e0, alpha + a * 0.005e0)) AS alpha,
         least(1e0, greatest(0e0, beta + b * 0.005e0)) AS beta
  FROM best1, (SELECT unnest(range(-10, 11)) AS a), (SELECT unnest(range(-10, 11)) AS b)),
{_fold(2)},
fit AS (
  SELECT company_code, alpha, beta, level0 * scale AS level0, trend0 * scale AS trend0, n, last
  FROM best2 JOIN lengths USING (company_code)),
smooth AS (
  SELECT company_code, CAST(0 AS BIGINT) AS x, CAST(NULL AS DATE) AS period, 0e0 AS y, 0e0 AS fitted,
         level0 AS level, trend0 AS trend FROM fit
  UNION ALL
  SELECT company_code, x, period, y, expected, nl, beta * (nl - level) + (1 - beta) * trend
  FROM (SELECT *, alpha * y + (1 - alpha) * expected AS nl
        FROM (SELECT s.company_code, k.x, k.period, k.y, s.level, s.trend, s.level + s.trend AS expected, alpha, beta
              FROM smooth s JOIN scaled k ON k.company_code = s.company_code AND k.x = s.x + 1
              JOIN fit ON fit.company_code = s.company_code))),
past AS (SELECT company_code, period, y AS actual, fitted FROM smooth WHERE x > 0),
metrics AS (
  SELECT company_code, sqrt(avg((actual - fitted) * (actual - fitted))) AS rmse,
         avg(CASE WHEN actual <> 0 THEN abs((actual - fitted) / actual) END) * 100 AS mape
  FROM past GROUP BY company_code),
future AS (
  SELECT fit.company_code, step, CAST(last + step * INTERVAL 1 MONTH AS DATE) AS period,
         level + step * trend AS forecast, alpha, beta, level0, trend0, level, trend
  FROM fit JOIN smooth ON smooth.company_code = fit.company_code AND smooth.x = n, (SELECT unnest([1, 2, 3]) AS step))"""

_LINE = _SERIES + """,
line AS (
  SELECT company_code, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, MAX(x) AS n,
         MAX(period) AS last, MAX(y) AS highest
  FROM kept GROUP BY company_code),
ahead AS (
  SELECT company_code, step, CAST(last + step * INTERVAL 1 MONTH AS DATE) AS period,
         intercept + slope * (n + step) AS forecast, highest
  FROM line, (SELECT unnest([1, 2, 3]) AS step))"""


def _sql(ctes: str, select: str, recursive: bool = False) -> str:
    head = PRELUDE.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else PRELUDE
    return f"{head}{', ' + ctes if ctes else ''}\n{select}"


def _check(name: str, passed: str, measured: str, source: str) -> str:
    return f"SELECT '{name}' AS \"check\", {passed} AS passed, CAST({measured} AS DOUBLE) AS measured FROM {source}"


_RAW = "(SELECT SUM(total_amount_syp) FROM fact_sales)"
_CHECKS = {
    "I1_totals_by_company": _check(
        "totals_by_company", f"{_RAW} = s", f"{_RAW} - s",
        "(SELECT SUM(total_amount_syp) AS s FROM fact_sales JOIN dim_company USING (company_sk))"),
    "I2_totals_by_month": _check(
        "totals_by_month", f"{_RAW} = s", f"{_RAW} - s",
        "(SELECT SUM(total_amount_syp) AS s FROM fact_sales f JOIN dim_date d ON d.date_sk = f.date_sk"
        " JOIN dim_company USING (company_sk))"),
    "I3_dates_resolve": _check(
        "date_sk_resolves", "n = 0", "n",
        "(SELECT COUNT(*) AS n FROM fact_sales WHERE date_sk NOT IN (SELECT date_sk FROM dim_date))"),
    "I4_companies_resolve": _check(
        "company_sk_resolves", "n = 0", "n",
        "(SELECT COUNT(*) AS n FROM fact_sales WHERE company_sk NOT IN (SELECT company_sk FROM dim_company))"),
    "I5_total_consistent": _check(
        "total_is_quantity_times_price", "n = 0", "n",
        "(SELECT COUNT(*) AS n FROM fact_sales WHERE abs(total_amount_syp - quantity * unit_price_syp) > 0.01)"),
    "I6_company_rows": _check("dim_company_rows", "n = 2", "n", "(SELECT COUNT(*) AS n FROM dim_company)"),
    "I7_calendar_rows": _check("dim_date_rows", "n >= 1825", "n", "(SELECT COUNT(*) AS n FROM dim_date)"),
}

# Slowly changing dimension over two loads: the first holds the customers signed up
# until August, the second those from May on, renamed.
_TWO_LOADS = """good AS (SELECT * FROM customers_reasoned WHERE reason_code IS NULL),
stored AS (
  SELECT row_number() OVER (ORDER BY source_system, source_customer_id) AS customer_sk, *
  FROM good WHERE month(signup_date) <= 8),
incoming AS (SELECT * REPLACE (upper(full_name) AS full_name) FROM good WHERE month(signup_date) >= 5),
last_sk AS (SELECT MAX(customer_sk) AS last FROM stored),
added AS (
  SELECT last + row_number() OVER (ORDER BY source_system, source_customer_id) AS customer_sk, i.* FROM (
    SELECT * FROM incoming ANTI JOIN stored USING (source_system, source_customer_id)) i, last_sk)"""


# Columns that must not be null, by table and where its rows come from.
_REQUIRED = [
    ("fact_sales", "sales_judged",
     "date_sk customer_sk product_sk company_sk quantity unit_price_syp total_amount_syp source_order_id"),
    ("dim_customer", "customers_reasoned", "source_system source_customer_id full_name phone_e164 city signup_date"),
    ("dim_product", "products_reasoned", "source_system source_product_id product_name_en category unit_price_syp"),
]


def oracle_sql() -> dict[str, str]:
    sql = {
        # -- sources
        "A1_source_a_customers": _sql("", "SELECT * FROM a_customers"),
        "A1_source_a_products": _sql("", "SELECT product_id, product_name, category, CAST(unit_price AS BIGINT) AS unit_price FROM a_products"),
        "A2_source_b_clients": _sql("", "SELECT * FROM b_clients"),
        "A2_source_b_transactions": _sql("", f"SELECT tx_id, client_id, item_id, CAST(qty AS BIGINT) AS qty, {money('price_at_tx')} AS price_at_tx, tx_date, tx_time FROM b_transactions"),
        "A3_orders_since": _sql("", f"""SELECT 'OPA' AS source_system, order_id, customer_id, product_id, CAST(quantity AS BIGINT) AS quantity, {money('unit_price_at_sale')} AS unit_price,
              CAST(total_price AS BIGINT) AS stored_total, order_date, CAST(NULL AS VARCHAR) AS order_time FROM a_orders WHERE order_date >= DATE '1998-07-01'
            UNION ALL SELECT 'OPB', tx_id, client_id, item_id, qty, {money('price_at_tx')}, NULL, tx_date, tx_time FROM b_transactions WHERE tx_date >= DATE '1998-07-01'"""),
        "A4_resolve_since": """WITH r AS (SELECT MAX(CASE WHEN event_type <> 'error' THEN ts END) AS ok FROM events)
            SELECT 'full' AS mode, CAST(NULL AS DATE) AS since UNION ALL SELECT 'since', DATE '1998-07-01'
            UNION ALL SELECT 'incremental', CAST(ok AS DATE) FROM r
            UNION ALL SELECT 'weekly', CAST(ok - INTERVAL 2 HOUR AS DATE) - CAST(dayofweek(CAST(ok - INTERVAL 2 HOUR AS DATE)) AS INTEGER) FROM r""",
        "A5_previous_sunday": """SELECT event_id, CAST(d - CAST(dayofweek(d) AS INTEGER) AS TIMESTAMP) + INTERVAL 2 HOUR AS sunday
            FROM (SELECT event_id, CAST(ts - INTERVAL 2 HOUR AS DATE) AS d FROM events)""",
        "A6_catchup_due": """SELECT user_id, CAST(floor(epoch(now_ts)) - floor(epoch(last)) AS BIGINT) AS age_seconds,
              last IS NULL OR floor(epoch(now_ts)) - floor(epoch(last)) > 691200 AS due
            FROM (SELECT user_id, MAX(CASE WHEN event_type = 'purchase' THEN ts END) AS last FROM events GROUP BY user_id),
                 (SELECT MAX(ts) AS now_ts FROM events)""",
        "A6_catchup_per_feed": """SELECT company_code, moment, CASE WHEN company_code <> 'OPC' THEN age END AS age_seconds, company_code = 'OPC' OR age > 691200 AS due
            FROM (VALUES ('OPA'), ('OPB'), ('OPC')) c(company_code), (VALUES ('at_once', CAST(0 AS BIGINT)), ('in_nine_days', CAST(777600 AS BIGINT))) m(moment, age)""",
        "A7_city_map": """SELECT 'ar' AS form, 'مدينة ' || n_nationkey AS key, n_name AS value FROM nation WHERE n_nationkey < 23
            UNION ALL SELECT 'en', n_name, n_name FROM nation WHERE n_nationkey < 23""",
        "A8_catalog": """SELECT CAST(p_partkey AS VARCHAR) AS offering_id, category, 'منتج ' || p_partkey AS local_name,
              CAST(local_price AS VARCHAR) AS local_price, mapped_category, p_name || ' ' || p_partkey AS english_name, CAST(price AS VARCHAR) AS english_price,
              local_price = floor(price) AS prices_match, mapped_category = upper(category) AS case_differs
            FROM (SELECT *, CAST(floor(price) AS BIGINT) + CASE WHEN p_partkey % 17 = 0 THEN 1 ELSE 0 END AS local_price,
                CASE WHEN p_partkey % 19 = 0 THEN category ELSE upper(category) END AS mapped_category
              FROM (SELECT *, CAST(p_retailprice AS DECIMAL(12,2)) AS price,
                  CASE p_partkey % 3 WHEN 0 THEN 'Internet' WHEN 1 THEN 'Voice' ELSE 'Bundle' END AS category
                FROM part WHERE p_partkey % 11 <> 0))""",
        "A8_catalog_names": """SELECT 'local_name' AS form, 'منتج ' || p_partkey AS key, p_name || ' ' || p_partkey AS value
            FROM part WHERE p_partkey % 11 <> 0
            UNION ALL SELECT 'english_name', p_name || ' ' || p_partkey, p_name || ' ' || p_partkey FROM part WHERE p_partkey % 11 <> 0""",
        "A9_C5_company_keys": _sql("", """SELECT s.source_system AS company_code, company_sk, company_name_ar, company_name_en, COUNT(*) AS lines
            FROM (SELECT source_system FROM sales_keyed) s LEFT JOIN dim_company ON company_code = source_system GROUP BY ALL"""),
        "A10_dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_sk, CAST(d AS DATE) AS full_date, year(d) AS year, quarter(d) AS quarter,
              month(d) AS month, monthname(d) AS month_name, day(d) AS day, dayofweek(d) AS day_of_week, dayofweek(d) IN (5, 6) AS is_weekend
            FROM (SELECT unnest(generate_series(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY)) AS d FROM orders)""",
        "A11_A13_rfm_store": _sql(_RFM_SCORED, _SUMMARY_SELECT),
        "A15_stored_or_computed": _sql(_RFM_SCORED, f"SELECT * FROM ({_SUMMARY_SELECT}), (VALUES ('stored'), ('missing'), ('torn')) c(\"case\")"),
        # -- conformance
        "B1_phone_e164": _sql("", "SELECT source_customer_id, phone_e164 FROM customers_judged WHERE source_system = 'OPA'"),
        "B2_phone_national": _sql("", "SELECT source_customer_id, phone_e164 FROM customers_judged WHERE source_system = 'OPB'"),
        "B3_city_local": _sql("", "SELECT source_customer_id, city FROM customers_judged WHERE source_system = 'OPA'"),
        "B4_city_canonical": _sql("", "SELECT source_customer_id, city FROM customers_judged WHERE source_system = 'OPB'"),
        "B5_conform_customers": _sql("", "SELECT source_system, source_table, source_customer_id, full_name, phone_e164, city, signup_date, reason_code, reason, reason_code IS NOT NULL AS rejected FROM customers_reasoned"),
        "B6_category_title": _sql("", "SELECT source_product_id, category FROM products_judged WHERE source_system = 'OPA'"),
        "B7_category_domain": _sql("", "SELECT item_id, item_type IN ('INTERNET', 'VOICE', 'BUNDLE') AS in_domain FROM b_items"),
        "B8_canonical_name": _sql("", "SELECT source_system, source_product_id, product_name_en FROM products_judged"),
        "B9_to_money": "SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE p_retailprice END AS price FROM part",
        "B10_conform_products": _sql("", f"SELECT source_system, source_table, source_product_id, product_name_en, category, {money('unit_price_syp')} AS unit_price_syp, reason_code, reason, reason_code IS NOT NULL AS rejected FROM products_reasoned"),
        "B11_date_sk": "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS from_timestamp, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS from_date, CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS from_text FROM orders",
        "B12_line_total": _sql("", f"SELECT tx_id, {money('qty * price_at_tx')} AS total FROM b_transactions"),
        "B13_stored_total": _sql("", f"SELECT source_order_id, {money('total_amount_syp')} AS total_amount_syp, reason, rejected FROM sales_judged WHERE reason_code = 'inconsistent_stored_total'"),
        "B14_conform_sales": _sql("", f"SELECT source_system, source_order_id, date_sk, customer_sk, product_sk, company_sk, quantity, {money('unit_price_syp')} AS unit_price_syp, {money('total_amount_syp')} AS total_amount_syp, reason_code, reason, rejected FROM sales_judged"),
        "B15_split_quarantine": _sql("", """SELECT 'good' AS side, source_system, NULL AS reason_code, COUNT(*) AS n FROM sales_judged WHERE NOT rejected GROUP BY source_system
            UNION ALL SELECT 'bad', source_system, reason_code, COUNT(*) FROM sales_judged WHERE reason_code IS NOT NULL GROUP BY source_system, reason_code"""),
        "B16_row_payload": _sql("", """SELECT source_system, source_table, to_json(struct_pack(customer_id := a.customer_id, full_name := a.full_name, phone := a.phone,
              city_ar := a.city_ar, signup_date := CAST(a.signup_date AS VARCHAR)))::VARCHAR AS source_row
            FROM a_customers a JOIN customers_reasoned r ON r.source_system = 'OPA' AND r.source_customer_id = a.customer_id WHERE reason_code IS NOT NULL
            UNION ALL SELECT source_system, source_table, to_json(struct_pack(client_id := b.client_id, client_name := b.client_name, msisdn := b.msisdn,
              city_en := b.city_en, registered_at := CAST(b.registered_at AS VARCHAR)))::VARCHAR
            FROM b_clients b JOIN customers_reasoned r ON r.source_system = 'OPB' AND r.source_customer_id = b.client_id WHERE reason_code IS NOT NULL
            UNION ALL SELECT source_system, source_table, to_json(struct_pack(product_id := a.product_id, product_name := a.product_name, category := a.category,
              unit_price := a.unit_price))::VARCHAR
            FROM a_products a JOIN products_reasoned r ON r.source_system = 'OPA' AND r.source_product_id = a.product_id WHERE reason_code IS NOT NULL
            UNION ALL SELECT source_system, source_table, to_json(struct_pack(item_id := b.item_id, item_name := b.item_name, item_type := b.item_type,
              price_syp := CAST(b.price_syp AS VARCHAR)))::VARCHAR
            FROM b_items b JOIN products_reasoned r ON r.source_system = 'OPB' AND r.source_product_id = b.item_id WHERE reason_code IS NOT NULL
            UNION ALL SELECT source_system, source_table, to_json(struct_pack(order_id := source_order_id, customer_id := natural_customer, product_id := natural_product,
              quantity := quantity, unit_price_at_sale := CAST(unit_price_syp AS INTEGER), total_price := stored, order_date := CAST(odate AS VARCHAR)))::VARCHAR
            FROM sales_judged WHERE source_system = 'OPA' AND reason_code IS NOT NULL
            UNION ALL SELECT source_system, source_table, to_json(struct_pack(tx_id := source_order_id, client_id := natural_customer, item_id := natural_product,
              qty := quantity, price_at_tx := CAST(unit_price_syp AS VARCHAR), tx_date := CAST(odate AS VARCHAR), tx_time := otime))::VARCHAR
            FROM sales_judged WHERE source_system = 'OPB' AND reason_code IS NOT NULL"""),
        # -- load
        "C1_upsert_customers": _sql(_TWO_LOADS, """SELECT customer_sk, s.source_system, s.source_customer_id, coalesce(i.full_name, s.full_name) AS full_name, s.phone_e164, s.city, s.signup_date,
              CASE WHEN i.source_system IS NULL THEN 'one' ELSE 'two' END AS etl_batch_id
            FROM stored s LEFT JOIN incoming i ON i.source_system = s.source_system AND i.source_customer_id = s.source_customer_id
            UNION ALL SELECT customer_sk, source_system, source_customer_id, full_name, phone_e164, city, signup_date, 'two' FROM added"""),
        "C2_upsert_products": _sql("", f"""SELECT product_sk, source_system, source_product_id, product_name_en, category,
              {money("CASE WHEN category = 'VOICE' THEN CAST(unit_price_syp * 2 AS DECIMAL(14,2)) ELSE unit_price_syp END")} AS unit_price_syp,
              CASE WHEN category = 'VOICE' THEN 'two' ELSE 'one' END AS etl_batch_id FROM dim_product"""),
        "C3_assign_sk": _sql(_TWO_LOADS, "SELECT customer_sk, source_system, source_customer_id FROM added"),
        "C4_resolve_sk": _sql("", "SELECT source_system, source_order_id AS order_id, natural_customer AS customer, natural_product AS product, customer_sk, product_sk FROM sales_resolved"),
        "C6_insert_absent": _sql("", f"""SELECT date_sk, customer_sk, product_sk, company_sk, quantity, {money('unit_price_syp')} AS unit_price_syp, {money('total_amount_syp')} AS total_amount_syp,
              source_order_id FROM fact_sales WHERE date_sk >= 19980101"""),
        "C7_upsert_counts": _sql(_TWO_LOADS, "SELECT (SELECT COUNT(*) FROM added) AS inserted, (SELECT COUNT(*) FROM incoming) - (SELECT COUNT(*) FROM added) AS updated"),
        "C8_run_log": """SELECT batch_id, line.status AS status, line.ts AS logged_at FROM (
              SELECT user_id AS batch_id, arg_max({'status': status, 'ts': ts}, (status = 'succeeded', ts, status <> 'running')) AS line FROM (
                SELECT user_id, ts, CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'succeeded' END AS status FROM events)
              GROUP BY user_id)""",
        "C9_constraints": _sql("", " UNION ALL ".join([
            *[f"""SELECT '{name}' AS "table", '{c} is not null' AS "constraint", COUNT(*) FILTER ({c} IS NULL) AS violations FROM {source}"""
              for name, source, columns in _REQUIRED for c in columns.split()],
            """SELECT 'fact_sales', 'quantity > 0', COUNT(*) FILTER (quantity <= 0) FROM sales_judged""",
            """SELECT 'dim_product', 'category in domain', COUNT(*) FILTER (category IS NULL OR category NOT IN ('INTERNET', 'VOICE', 'BUNDLE')) FROM products_reasoned""",
            *[f"""SELECT 'fact_sales', '{key} has a dimension row', COUNT(*) FROM sales_judged s ANTI JOIN {dim} d ON d.{key} = s.{key}"""
              for key, dim in (("date_sk", "dim_date"), ("customer_sk", "dim_customer"), ("product_sk", "dim_product"), ("company_sk", "dim_company"))],
            *[f"""SELECT '{name}', '{keys} is unique', coalesce(SUM(n - 1), 0) FROM (SELECT COUNT(*) AS n FROM {source} GROUP BY {keys} HAVING COUNT(*) > 1)"""
              for name, source, keys in (("fact_sales", "sales_judged", "company_sk, source_order_id"),
                                         ("dim_customer", "customers_reasoned", "source_system, source_customer_id"),
                                         ("dim_product", "products_reasoned", "source_system, source_product_id"))],
        ])),
        "C10_quarantine": _sql("", "SELECT 'first' AS batch_id, source_system, source_table, reason_code, reason FROM errors"),
        "C10_unreadable_lines": _sql("", """SELECT 'orders' AS source_table, order_id || ',' || customer_id AS source_row, 'line cannot be read for OPA orders: ''' || order_id || '''' AS reason
            FROM a_orders WHERE CAST(split_part(order_id, '-', 1) AS BIGINT) % 97 = 5
            UNION ALL SELECT 'fact_sales', CAST(COUNT(DISTINCT source_order_id) AS VARCHAR), 'rows loaded' FROM sales_judged
            WHERE company_sk = 1 AND NOT rejected AND CAST(split_part(source_order_id, '-', 1) AS BIGINT) % 97 <> 5"""),
        "C11_batch_counts": _sql("", """SELECT (SELECT COUNT(*) FROM customer) + 2 * (SELECT COUNT(*) FROM part) + (SELECT COUNT(*) FROM sales_keyed) AS rows_extracted,
              (SELECT COUNT(*) FROM fact_sales) AS rows_loaded, (SELECT COUNT(*) FROM errors) AS rows_quarantined"""),
        "C12_two_batches": _sql("", """SELECT 'since' AS mode, (SELECT COUNT(*) FROM fact_sales WHERE date_sk >= 19990101) AS rows_loaded, 'succeeded' AS status
            UNION ALL SELECT 'full', (SELECT COUNT(*) FROM fact_sales WHERE date_sk < 19990101), 'succeeded'"""),
        "C12_load_life_cycle": _sql("", f"SELECT company_sk, source_order_id, date_sk, customer_sk, product_sk, quantity, {money('total_amount_syp')} AS total_amount_syp FROM fact_sales"),
        # -- reports
        "D1_company_totals": _sql(_COMPANY, f"SELECT company_code, company_name_en, {money('total')} AS total_sales_syp, orders AS order_count, {pct('total', 'everything')} AS share_pct FROM company, national"),
        "D2_company_totals_customers": _sql(_COMPANY, f"SELECT company_code, company_name_en, {money('total')} AS total_sales_syp, orders AS order_count, customers AS customer_count, {pct('total', 'everything')} AS share_pct, {avg('total', 'orders')} AS avg_order_syp FROM company, national"),
        "D3_top_customers": _sql("", f"""SELECT customer_sk, full_name, source_system, city, {money('total')} AS total_spent_syp, n AS order_count, {avg('total', 'n')} AS avg_order_syp, first_order_date, last_order_date FROM (
            SELECT c.customer_sk, c.full_name, c.source_system, c.city, SUM(total_amount_syp) AS total, COUNT(*) AS n, MIN(full_date) AS first_order_date, MAX(full_date) AS last_order_date
            FROM fact_sales f JOIN dim_customer c ON c.customer_sk = f.customer_sk JOIN dim_date d ON d.date_sk = f.date_sk
            GROUP BY c.customer_sk, c.full_name, c.source_system, c.city ORDER BY total DESC, c.customer_sk LIMIT 20)"""),
        "D4_city_sales": _sql(_CITY, f"SELECT city, {money('opa')} AS opa_syp, {money('opb')} AS opb_syp, {money('total')} AS total_syp, customers AS unique_customers FROM city"),
        "D5_city_sales_orders": _sql(_CITY, f"SELECT city, {money('opa')} AS opa_syp, {money('opb')} AS opb_syp, {money('total')} AS total_syp, customers AS unique_customers, orders AS order_count FROM city"),
        "D6_monthly_change": _sql(_MONTHLY, f"""SELECT year, month, company_code, {money('sales')} AS sales_syp, order_count, {money('prev')} AS prev_month_syp, {pct('sales - prev', 'prev')} AS mom_change_pct
            FROM (SELECT *, lag(sales) OVER (PARTITION BY company_code ORDER BY year, month) AS prev FROM monthly)"""),
        "D7_monthly_sales": _sql(_MONTHLY, f"SELECT year, month, company_code, {money('sales')} AS sales_syp, order_count FROM monthly"),
        "D8_company_comparison": _sql("", f"""SELECT company_code, company_name_en, {money('total')} AS total_revenue_syp, n AS order_count, customers AS customer_count, {avg('total', 'n')} AS avg_order_value_syp, cities_served, categories_sold, {avg('total', 'customers')} AS revenue_per_customer_syp FROM (
            SELECT company_code, company_name_en, SUM(total_amount_syp) AS total, COUNT(*) AS n, COUNT(DISTINCT f.customer_sk) AS customers, COUNT(DISTINCT c.city) AS cities_served, COUNT(DISTINCT p.category) AS categories_sold
            FROM fact_sales f JOIN dim_company USING (company_sk) JOIN dim_customer c ON c.customer_sk = f.customer_sk JOIN dim_product p ON p.product_sk = f.product_sk GROUP BY company_code, company_name_en)"""),
        "D9_decision_indicators": _sql(_INDICATORS, f"SELECT {pct('top', 'total')} AS top_10pct_customer_revenue_share_pct, cities_served, total_customers, {pct('last_3m - prior_3m', 'prior_3m')} AS qoq_growth_pct, {money('last_3m')} AS last_3m_revenue_syp, {money('prior_3m')} AS prior_3m_revenue_syp, {money('total')} AS total_revenue_syp FROM indicators"),
        "D9a_dashboard_indicators": _sql(_INDICATORS, f"SELECT {pct('top', 'total')} AS top_10pct_share, cities_served, total_customers, {pct('last_3m - prior_3m', 'prior_3m')} AS qoq_growth_pct, {money('last_3m')} AS last_3m_revenue_syp, {money('total')} AS total_revenue_syp FROM indicators"),
        "D10_products": _sql("", f"""SELECT product_name_en AS name, category, {avg('SUM(total_amount_syp)', 'COUNT(*)', 0)} AS avg_order_value_syp, COUNT(*) AS order_count
            FROM fact_sales f JOIN dim_product p ON p.product_sk = f.product_sk GROUP BY product_name_en, category"""),
        "D11_cheapest_products": _sql("", f"""SELECT product_name_en AS name, category, {avg('SUM(total_amount_syp)', 'COUNT(*)', 0)} AS avg_order_value_syp, COUNT(*) AS order_count
            FROM fact_sales f JOIN dim_product p ON p.product_sk = f.product_sk GROUP BY product_name_en, category
            ORDER BY avg_order_value_syp, name, category LIMIT 12"""),
        "D12_headline": _sql(_COMPANY + ", " + _RFM_SCORED, f"""SELECT {money('everything')} AS total_revenue_syp, orders AS total_orders, {avg('everything', 'orders')} AS avg_order_syp, at_risk AS at_risk_count, champ_loyal AS champ_loyal_count
            FROM national, (SELECT SUM(orders) AS orders FROM company), (SELECT COUNT(*) FILTER (segment = 'At Risk') AS at_risk, COUNT(*) FILTER (segment IN ('Champions', 'Loyal')) AS champ_loyal FROM segmented)"""),
        "D13_monthly_wide": _sql(_MONTHLY, """SELECT year, month, make_date(year, month, 1) AS period, strftime(make_date(year, month, 1), '%b %y') AS label,
              CAST(SUM(CASE WHEN company_code = 'OPA' THEN sales END) AS DOUBLE) / 1e6 AS opa, CAST(SUM(CASE WHEN company_code = 'OPB' THEN sales END) AS DOUBLE) / 1e6 AS opb
            FROM monthly GROUP BY year, month"""),
        "D14_city_millions": _sql(_CITY, f"""SELECT city, {money('opa')} AS opa_syp, {money('opb')} AS opb_syp, {money('total')} AS total_syp, customers AS unique_customers, orders AS order_count,
              {money('opa')} / 1e6 AS opa_m, {money('opb')} / 1e6 AS opb_m, {money('total')} / 1e6 AS total_m,
              CASE WHEN n_nationkey < 21 THEN 'مدينة ' || n_nationkey ELSE city END AS city_ar FROM city JOIN nation ON n_name = city"""),
        "D15_governorates": _sql(_CITY, f"""SELECT id, name, ar, coalesce({money('opa')} / 1e6, 0) AS opa_m, coalesce({money('opb')} / 1e6, 0) AS opb_m, coalesce({money('total')} / 1e6, 0) AS total_m,
              coalesce(customers, 0) AS customers, coalesce(orders, 0) AS orders, coalesce({avg('total', 'orders')}, 0) AS avg_order, coalesce({pct('total', '(SELECT SUM(total) FROM city)')}, 0) AS share_pct,
              row_number() OVER (ORDER BY coalesce(total, 0) DESC, id) AS rank
            FROM (SELECT lower(n_name) AS id, n_name AS name, 'مدينة ' || n_nationkey AS ar FROM nation WHERE n_nationkey < 21 UNION ALL SELECT 'nowhere', 'NOWHERE', 'مدينة ')
            LEFT JOIN city ON city = name"""),
        "D16_city_bars": _sql(_CITY, f"""SELECT city, {pct('total', '(SELECT MAX(total) FROM city)')} AS bar_pct, {pct('opa', 'total')} AS split_pct FROM city ORDER BY total DESC, city LIMIT 8"""),
        "D16_governorate_bars": _sql(_CITY, f"""SELECT id, name, row_number() OVER (ORDER BY coalesce(total, 0) DESC, id) AS rank,
              coalesce({pct('total', '(SELECT MAX(total) FROM city JOIN nation ON n_name = city WHERE n_nationkey < 21)')}, 0) AS bar_pct, coalesce({pct('opa', 'total')}, 50) AS split_pct
            FROM (SELECT lower(n_name) AS id, n_name AS name FROM nation WHERE n_nationkey < 21 UNION ALL SELECT 'nowhere', 'NOWHERE')
            LEFT JOIN city ON city = name"""),
        "D17_governorate_panel": _sql(_CITY, """SELECT round(CAST(SUM(total) AS DOUBLE) / 1e6, 6) AS total_m, SUM(customers) AS total_customers, arg_max(city, total) AS top_region
            FROM city JOIN nation ON n_name = city WHERE n_nationkey < 21"""),
        # -- customer segments
        "E1_rfm_raw": _sql(_RFM_RAW, f"SELECT * EXCLUDE (monetary), {money('monetary')} AS monetary_syp FROM rfm"),
        "E2_rfm_ntile": _sql(_RFM_RAW, """SELECT customer_sk, r_score, f_score, m_score, '' || r_score || f_score || m_score AS rfm_code FROM (
            SELECT customer_sk, ntile(5) OVER (ORDER BY recency_days DESC, customer_sk) AS r_score, ntile(5) OVER (ORDER BY frequency, customer_sk) AS f_score,
                   ntile(5) OVER (ORDER BY monetary, customer_sk) AS m_score FROM rfm)"""),
        "E3_rfm_quintiles": _sql(_RFM_SCORED, "SELECT customer_sk, r_score, f_score, m_score, '' || r_score || f_score || m_score AS rfm_code FROM scored"),
        "E4_segment": _sql(_RFM_SCORED, "SELECT customer_sk, segment FROM segmented"),
        "E5_segmented_customers": _sql(_RFM_SCORED, f"SELECT customer_sk, full_name, city, source_system, company, company_code, recency_days, frequency, {money('monetary')} AS monetary_syp, r_score, f_score, m_score, '' || r_score || f_score || m_score AS rfm_code, segment FROM segmented"),
        "E6_segment_summary": _sql(_RFM_SCORED, _SUMMARY_SELECT),
        "E7_dominance": _sql(_RFM_SCORED, "SELECT round(MAX(part * 100), 1) AS max_pct, MAX(part * 100) > 80 AS dominated FROM summary"),
        "E8_base_shares": _sql(_RFM_SCORED, """SELECT at_risk_count, champ_loyal_count, total_customers, round(at_risk_count / total_customers * 100, 2) AS at_risk_pct, round(champ_loyal_count / total_customers * 100, 2) AS champ_loyal_pct
            FROM (SELECT COUNT(*) FILTER (segment = 'At Risk') AS at_risk_count, COUNT(*) FILTER (segment IN ('Champions', 'Loyal')) AS champ_loyal_count FROM segmented), (SELECT COUNT(*) AS total_customers FROM dim_customer)"""),
        # -- forecast
        "F1_monthly_series": _sql(_SERIES, "SELECT company_code, period, y AS sales_syp FROM series"),
        "F2_drop_partial": _sql(_SERIES, "SELECT company_code, period, y AS sales_syp FROM kept"),
        "F3_holt": _sql(_HOLT, "SELECT company_code, period, y AS actual, round(fitted, 4) AS fitted FROM smoothed", recursive=True),
        "F6_trend_forecast": _sql(_LINE, "SELECT company_code, step, period, round(forecast, 2) AS forecast FROM ahead"),
        "F8_metrics": _sql(_HOLT, "SELECT company_code, round(sqrt(avg((y - fitted) * (y - fitted))), 4) AS rmse, round(avg(abs((y - fitted) / y)) * 100, 8) AS mape FROM smoothed GROUP BY company_code", recursive=True),
        "F9_forecast_check": _sql(_LINE, "SELECT company_code, period, CASE WHEN forecast < 0 THEN 'FAIL' WHEN forecast > 2 * highest THEN 'WARN' ELSE 'OK' END AS status FROM ahead"),
        "F4_holt_fit": _sql(_FIT, """SELECT company_code, round(alpha, 6) AS alpha, round(beta, 6) AS beta, round(level0, 2) AS level0, round(trend0, 2) AS trend0,
              round(level, 2) AS level, round(trend, 2) AS trend FROM future WHERE step = 1""", recursive=True),
        "F5_holt_forecast": _sql(_FIT, "SELECT company_code, step, period, round(forecast, 2) AS forecast FROM future", recursive=True),
        "F7_bands": _sql(_FIT, """SELECT company_code, step, period, round(forecast, 2) AS forecast, round(forecast - half, 2) AS lower, round(forecast + half, 2) AS upper FROM (
              SELECT f.*, 1.2815515655446004e0 * rmse * sqrt(1 + CASE step WHEN 1 THEN 0e0 WHEN 2 THEN pow(alpha + alpha * beta, 2)
                ELSE pow(alpha + alpha * beta, 2) + pow(alpha + alpha * beta * 2, 2) END) AS half
              FROM future f JOIN metrics m ON m.company_code = f.company_code)""", recursive=True),
        "F10_forecast_long": _sql(_FIT, """SELECT company_code, strftime(period, '%Y-%m') AS period, 'actual' AS type, round(actual, 2) AS sales_syp FROM past
            UNION ALL SELECT company_code, strftime(period, '%Y-%m'), 'fitted', round(fitted, 2) FROM past
            UNION ALL SELECT company_code, strftime(period, '%Y-%m'), 'forecast', round(forecast, 2) FROM future""", recursive=True),
        "F11_forecast_summary": _sql(_FIT, """SELECT company_code, string_agg(strftime(period, '%Y-%m'), ',' ORDER BY step) AS periods,
              round(MAX(CASE step WHEN 1 THEN forecast END), 2) AS forecast_1, round(MAX(CASE step WHEN 2 THEN forecast END), 2) AS forecast_2,
              round(MAX(CASE step WHEN 3 THEN forecast END), 2) AS forecast_3, round(MAX(rmse), 2) AS rmse, round(MAX(mape), 6) AS mape
            FROM future JOIN metrics USING (company_code) GROUP BY company_code""", recursive=True),
        "D18_combined_forecast": _sql(_FIT, """SELECT period, round(MAX(CASE company_code WHEN 'OPA' THEN forecast END), 2) AS opa,
              round(MAX(CASE company_code WHEN 'OPB' THEN forecast END), 2) AS opb, round(SUM(forecast), 2) AS combined FROM future GROUP BY period""", recursive=True),
        "A15_forecast_stored_or_computed": _sql(_FIT, """SELECT company_code, round(rmse, 2) AS rmse, round(mape, 6) AS mape, "case"
            FROM metrics, (VALUES ('stored'), ('missing'), ('torn')) c("case")""", recursive=True),
        "A12_A14_forecast_store": _sql(_FIT, "SELECT company_code, round(rmse, 2) AS rmse, round(mape, 6) AS mape FROM metrics", recursive=True),
        # -- ranks
        "G1_global_row_number": _sql("", """SELECT customer_sk, orders, row_number() OVER (ORDER BY orders, customer_sk) AS row_number
            FROM (SELECT customer_sk, COUNT(*) AS orders FROM fact_sales GROUP BY customer_sk)"""),
        "G2_top_fraction_sum": _sql("", f"""SELECT {money('SUM(customer_total)')} AS top_total FROM (
            SELECT customer_total, row_number() OVER (ORDER BY customer_total DESC, customer_sk) AS k, COUNT(*) OVER () AS n FROM (
              SELECT customer_sk, SUM(total_amount_syp) AS customer_total FROM fact_sales GROUP BY customer_sk)) WHERE k <= (n + 9) // 10"""),
        "G3_total_order": _sql("", f"SELECT company_sk, date_sk, source_order_id, {money('total_amount_syp')} AS total_amount_syp FROM fact_sales ORDER BY company_sk, date_sk, source_order_id"),
        "G4_top_k": _sql("", f"SELECT source_order_id, {money('total_amount_syp')} AS total_amount_syp FROM fact_sales ORDER BY fact_sales.total_amount_syp DESC, company_sk, source_order_id LIMIT 50"),
        "G5_rank_small": _sql(_CITY, "SELECT city, row_number() OVER (ORDER BY total DESC, city) AS rank FROM city"),
        # -- checks
        **{key: _sql("", select) for key, select in _CHECKS.items()},
        "I6_company_rows": _sql("", _check(
            "dim_company_rows", "n = 2", "n",
            "(SELECT COUNT(*) AS n FROM dim_company WHERE company_sk IN (SELECT company_sk FROM fact_sales))")),
        "I7_calendar_rows": _sql("", _check(
            "dim_date_rows", "n >= 1825", "n",
            "(SELECT date_diff('day', MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE))) + 1 AS n FROM orders)")),
        "I8_all_checks": _sql("", " UNION ALL ".join(_CHECKS.values())),
        "I9_contract_profile": _sql("", """SELECT 'OPA' AS company_code, d AS dimension, o AS observed, CAST(NULL AS DOUBLE) AS rate FROM (VALUES ('table_naming', 'customers,products,orders'), ('key_type', 'bigint'),
              ('city_column', 'cities.city_ar:string'), ('price_type', 'int'), ('total_column', 'bigint'), ('date_shape', 'timestamp')) v(d, o)
            UNION ALL SELECT 'OPB', d, o, NULL FROM (VALUES ('table_naming', 'clients,items,transactions'), ('key_type', 'string'),
              ('city_column', 'clients.city_en:string'), ('price_type', 'decimal(12,2)'), ('total_column', 'missing'), ('date_shape', 'date')) v(d, o)
            UNION ALL SELECT source_system, 'phone_format', NULL, round(avg(CASE WHEN phone_e164 IS NULL THEN 0.0 ELSE 1.0 END), 6) FROM customers_judged GROUP BY source_system
            UNION ALL SELECT source_system, 'category_case', NULL, round(avg(CASE WHEN category IS NULL THEN 0.0 ELSE 1.0 END), 6) FROM products_judged GROUP BY source_system
            UNION ALL SELECT c, d, NULL, r FROM (VALUES ('OPA', 'arabic_names', 1.0), ('OPA', 'ascii_names', 0.0), ('OPB', 'arabic_names', 0.0), ('OPB', 'ascii_names', 1.0)) v(c, d, r)"""),
        "I9_contract_verdict": _sql("", """SELECT c AS "check", TRUE AS passed, CAST(NULL AS DOUBLE) AS rate_a, CAST(NULL AS DOUBLE) AS rate_b
              FROM (VALUES ('table_naming'), ('key_type'), ('price_type'), ('total_column'), ('date_shape')) v(c)
            UNION ALL SELECT c, a >= 0.9 AND b >= 0.9 AND other = 0, a, b FROM (
              SELECT 'phone_format' AS c, round(avg(CASE WHEN source_system = 'OPA' THEN CASE WHEN phone_e164 IS NULL THEN 0.0 ELSE 1.0 END END), 6) AS a,
                round(avg(CASE WHEN source_system = 'OPB' THEN CASE WHEN phone_e164 IS NULL THEN 0.0 ELSE 1.0 END END), 6) AS b,
                COUNT(*) FILTER (regexp_matches(raw_phone, CASE source_system WHEN 'OPA' THEN '^09' ELSE '^[+]9639' END)) AS other FROM customers_judged
              UNION ALL SELECT 'category_case', round(avg(CASE WHEN source_system = 'OPA' THEN CASE WHEN category IS NULL THEN 0.0 ELSE 1.0 END END), 6),
                round(avg(CASE WHEN source_system = 'OPB' THEN CASE WHEN category IS NULL THEN 0.0 ELSE 1.0 END END), 6),
                COUNT(*) FILTER (source_system = 'OPA' AND raw_category = upper(raw_category) OR source_system = 'OPB' AND raw_category <> upper(raw_category)) FROM products_judged
              UNION ALL SELECT * FROM (VALUES ('city_language', 1.0, 1.0, 0), ('name_language', 1.0, 1.0, 0)))"""),
        # -- text
        "J1_transliterate": """SELECT p_partkey, list_aggregate(list_transform(string_split(p_name, ' '),
              lambda w: CASE w WHEN 'small' THEN 'صغير' WHEN 'red' THEN 'أحمر' WHEN 'ring' THEN 'خاتم' WHEN 'widget' THEN 'قطعة' ELSE w END), 'string_agg', ' ') AS name FROM part""",
        "J2_short_money": """SELECT o_orderkey, CASE WHEN v >= 1e6 THEN CAST(CAST(round_even(v / 1e6, 0) AS BIGINT) AS VARCHAR) || 'M'
              WHEN v >= 1e3 THEN CAST(CAST(round_even(v / 1e3, 0) AS BIGINT) AS VARCHAR) || 'K' ELSE CAST(CAST(trunc(v) AS BIGINT) AS VARCHAR) END AS amount
            FROM (SELECT o_orderkey, o_totalprice * (1 + o_orderkey % 3 * 10) / (1 + o_orderkey % 2 * 1000) AS v FROM orders)""",
        # -- stream
        "L1_stream_load": _sql("", f"SELECT company_sk, source_order_id, date_sk, customer_sk, product_sk, quantity, {money('total_amount_syp')} AS total_amount_syp FROM fact_sales"),
    }
    return {key: text.strip() for key, text in sql.items()}
