"""The same results as DuckDB SQL over the given tables, for checking.

Written from the definitions and not from the Spark code: where an operator is
more than a projection, the SQL takes another road to the same rows.
"""

from __future__ import annotations

from lodestone.plans import derived

NATION = "NATION_7"

STAR = """
dim_region AS (
  SELECT CAST(n_nationkey AS BIGINT) AS nation_key, n_name AS nation_name, r_name AS region_name
  FROM nation JOIN region ON n_regionkey = r_regionkey),
dim_customer AS (
  SELECT c_custkey AS customer_key, c_name AS customer_name, CAST(NULL AS VARCHAR) AS address,
         CAST(NULL AS VARCHAR) AS phone, CAST(c_acctbal AS DECIMAL(15,2)) AS account_balance,
         c_mktsegment AS market_segment, CAST(c_nationkey AS BIGINT) AS nation_key
  FROM customer),
dim_supplier AS (
  SELECT s_suppkey AS supplier_key, s_name AS supplier_name, CAST(NULL AS VARCHAR) AS address,
         CAST(NULL AS VARCHAR) AS phone, CAST(s_acctbal AS DECIMAL(15,2)) AS account_balance,
         CAST(s_nationkey AS BIGINT) AS nation_key
  FROM supplier),
dim_product AS (
  SELECT p_partkey AS product_key, p_name AS product_name, CAST(NULL AS VARCHAR) AS manufacturer,
         p_brand AS brand, p_type AS product_type, CAST(p_size AS INTEGER) AS size,
         CAST(NULL AS VARCHAR) AS container, CAST(p_retailprice AS DECIMAL(15,2)) AS retail_price
  FROM part),
spine AS (
  SELECT CAST(unnest(generate_series(
           LEAST((SELECT MIN(o_orderdate) FROM orders), (SELECT MIN(l_shipdate) FROM lineitem)),
           GREATEST((SELECT MAX(o_orderdate) FROM orders), (SELECT MAX(l_shipdate) FROM lineitem)),
           INTERVAL 1 DAY)) AS DATE) AS full_date),
dim_date AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_key, full_date,
         CAST(EXTRACT(YEAR FROM full_date) AS INTEGER) AS year,
         CAST(EXTRACT(QUARTER FROM full_date) AS INTEGER) AS quarter,
         CAST(EXTRACT(MONTH FROM full_date) AS INTEGER) AS month,
         strftime(full_date, '%B') AS month_name,
         CAST(EXTRACT(DAY FROM full_date) AS INTEGER) AS day,
         CAST(EXTRACT(DOW FROM full_date) AS INTEGER) AS day_of_week,
         strftime(full_date, '%A') AS day_name,
         EXTRACT(DOW FROM full_date) IN (0, 6) AS is_weekend
  FROM spine),
fact_orders AS (
  SELECT l_orderkey AS order_key, CAST(l_linenumber AS INTEGER) AS line_number,
         o_custkey AS customer_key, l_suppkey AS supplier_key, l_partkey AS product_key,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS order_date_key,
         CAST(strftime(l_shipdate, '%Y%m%d') AS INTEGER) AS ship_date_key,
         o_orderstatus AS order_status, o_orderpriority AS order_priority,
         CAST(NULL AS VARCHAR) AS ship_mode, l_returnflag AS return_flag, l_linestatus AS line_status,
         CAST(l_quantity AS DECIMAL(15,2)) AS quantity,
         CAST(l_extendedprice AS DECIMAL(15,2)) AS extended_price,
         CAST(l_discount AS DECIMAL(15,2)) AS discount, CAST(l_tax AS DECIMAL(15,2)) AS tax,
         CAST(ROUND(CAST(l_extendedprice AS DECIMAL(15,2))
                    * (1 - CAST(l_discount AS DECIMAL(15,2))), 2) AS DECIMAL(18,2)) AS net_revenue
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def star(sql: str, *more: str) -> str:
    """``sql`` over the star tables; ``more`` are further named subqueries."""
    return f"WITH {','.join((STAR, *more))}\n{sql}"


def money(expr: str, name: str) -> str:
    return f"CAST({expr} AS DOUBLE) AS {name}"


AOV = "CAST(SUM(net_revenue) AS DOUBLE) / COUNT(DISTINCT order_key) AS average_order_value"
REPEAT = (
    "SELECT COUNT(DISTINCT CASE WHEN orders >= 2 THEN customer_key END) * 1.0::DOUBLE "
    "/ COUNT(DISTINCT customer_key) AS repeat_customer_rate FROM "
    "(SELECT customer_key, COUNT(DISTINCT order_key) AS orders FROM fact_orders GROUP BY customer_key)"
)
CUSTOMER = "JOIN dim_customer USING (customer_key)"
SUPPLIER = "JOIN dim_supplier USING (supplier_key)"
PRODUCT = "JOIN dim_product USING (product_key)"
REGION = "JOIN dim_region USING (nation_key)"
ORDERED = "JOIN dim_date ON order_date_key = date_key"
SHIPPED = "JOIN dim_date ON ship_date_key = date_key"
REVENUE = money("SUM(net_revenue)", "revenue")


def _revenue_by(dim: str, *joins: str, tail: str = "") -> str:
    return star(f"SELECT {dim}, {REVENUE} FROM fact_orders {' '.join(joins)} GROUP BY {dim} {tail}")


def _average(column: str, name: str, source: str = "fact_orders") -> str:
    return star(f"SELECT CAST(SUM({column}) AS DOUBLE) / COUNT({column}) AS {name} FROM {source}")


def _fact(select: str, *tail: str) -> str:
    return star(f"SELECT {select} FROM fact_orders {' '.join(tail)}")


def warehouse_oracles() -> dict[str, str]:
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count FROM {t}"
        for t in ("fact_orders", "dim_customer", "dim_product", "dim_date", "dim_region", "dim_supplier")
    )
    keys = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, COUNT(*) AS row_count, COUNT(DISTINCT {k}) AS distinct_keys, "
        f"COUNT(*) = COUNT(DISTINCT {k}) AS is_unique FROM {t}"
        for t, k in (("dim_customer", "customer_key"), ("dim_product", "product_key"),
                     ("dim_supplier", "supplier_key"), ("dim_region", "nation_key"),
                     ("dim_date", "date_key"))
    )

    def orphan(child: str, column: str, parent: str, key: str) -> str:
        return (f"SELECT '{child}' AS table_name, '{column}' AS column_name, COUNT(*) AS orphan_rows "
                f"FROM {child} c LEFT JOIN {parent} p ON c.{column} = p.{key} WHERE p.{key} IS NULL")

    return {
        "W1_base": """
            SELECT l.*, o.* FROM (
              SELECT COUNT(*) AS line_rows, CAST(SUM(CAST(l_quantity AS DECIMAL(15,2))) AS DOUBLE) AS quantity,
                CAST(SUM(CAST(l_extendedprice AS DECIMAL(15,2))) AS DOUBLE) AS price,
                CAST(SUM(CAST(l_discount AS DECIMAL(15,2))) AS DOUBLE) AS discount,
                CAST(SUM(CAST(l_tax AS DECIMAL(15,2))) AS DOUBLE) AS tax,
                strftime(MIN(l_shipdate), '%Y-%m-%d') AS first_shipped FROM lineitem) l,
              (SELECT COUNT(*) AS order_rows,
                CAST(SUM(CAST(o_totalprice AS DECIMAL(15,2))) AS DOUBLE) AS order_total,
                strftime(MAX(o_orderdate), '%Y-%m-%d') AS last_ordered FROM orders) o""",
        "W2_dim_region": star("SELECT * FROM dim_region"),
        "W3_dim_customer": star(
            "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance) FROM dim_customer"),
        "W4_dim_supplier": star(
            "SELECT * REPLACE (CAST(account_balance AS DOUBLE) AS account_balance) FROM dim_supplier"),
        "W5_dim_product": star(
            "SELECT * REPLACE (CAST(retail_price AS DOUBLE) AS retail_price) FROM dim_product"),
        "W6a_date_bounds": """
            SELECT strftime(LEAST(MIN(o_min), MIN(s_min)), '%Y-%m-%d') AS min_date,
                   strftime(GREATEST(MAX(o_max), MAX(s_max)), '%Y-%m-%d') AS max_date
            FROM (SELECT MIN(o_orderdate) AS o_min, MAX(o_orderdate) AS o_max FROM orders),
                 (SELECT MIN(l_shipdate) AS s_min, MAX(l_shipdate) AS s_max FROM lineitem)""",
        "W6b_date_spine": star("SELECT strftime(full_date, '%Y-%m-%d') AS full_date FROM spine"),
        "W6c_dim_date": star(
            "SELECT * REPLACE (strftime(full_date, '%Y-%m-%d') AS full_date) FROM dim_date"),
        "W7_fact_orders": star(
            "SELECT * REPLACE (" + ", ".join(
                money(c, c) for c in ("quantity", "extended_price", "discount", "tax", "net_revenue")
            ) + ") FROM fact_orders"),
        "W9_written_fact": star(f"""
            SELECT COUNT(*) AS line_rows, {money('SUM(net_revenue)', 'net_revenue')},
              CAST(SUM(order_date_key) AS BIGINT) AS order_dates, CAST(SUM(ship_date_key) AS BIGINT) AS ship_dates
            FROM fact_orders"""),
        "W11_row_counts": star(counts),
        "W12_rebuild": star(counts),
        "W13_nightly_refresh": star(f"""{counts} UNION ALL SELECT 'index', COUNT(*) FROM documents
            UNION ALL SELECT 'vectors', COUNT(*) FROM documents WHERE doc_id IN (SELECT vec_id FROM embeddings)
            UNION ALL SELECT 'traces', COUNT(*) FROM events
            UNION ALL SELECT 'feedback', COUNT(DISTINCT event_id - event_id % 5) FROM events
              WHERE event_type IN ('click', 'purchase', 'signup')"""),
        "W14_non_empty": star(f"SELECT table_name, row_count > 0 AS non_empty FROM ({counts})"),
        "W15_key_uniqueness": star(keys),
        "W16_grain_uniqueness": star("""
            SELECT (SELECT COUNT(*) FROM fact_orders) AS row_count,
              (SELECT COUNT(*) FROM (SELECT DISTINCT order_key, line_number FROM fact_orders)) AS distinct_lines,
              (SELECT COUNT(*) FROM (SELECT 1 FROM fact_orders GROUP BY order_key, line_number
                                     HAVING COUNT(*) > 1)) AS repeated_lines"""),
        "W17_fact_orphans": star(" UNION ALL ".join((
            orphan("fact_orders", "customer_key", "dim_customer", "customer_key"),
            orphan("fact_orders", "supplier_key", "dim_supplier", "supplier_key"),
            orphan("fact_orders", "product_key", "dim_product", "product_key"),
            orphan("fact_orders", "order_date_key", "dim_date", "date_key"),
            orphan("fact_orders", "ship_date_key", "dim_date", "date_key")))),
        "W18_nation_orphans": star(" UNION ALL ".join((
            orphan("dim_customer", "nation_key", "dim_region", "nation_key"),
            orphan("dim_supplier", "nation_key", "dim_region", "nation_key")))),
        "W19_date_contiguity": star("""
            SELECT DATE_DIFF('day', MIN(full_date), MAX(full_date)) + 1 AS days_spanned,
              COUNT(*) AS row_count,
              DATE_DIFF('day', MIN(full_date), MAX(full_date)) + 1 = COUNT(*) AS contiguous FROM dim_date"""),
        "W20_negative_revenue": star("SELECT COUNT(*) AS negative_rows FROM fact_orders WHERE net_revenue < 0"),
    }


def metric_oracles() -> dict[str, str]:
    values = {
        "total_revenue": "SELECT CAST(SUM(net_revenue) AS DOUBLE) FROM fact_orders",
        "order_count": "SELECT CAST(COUNT(DISTINCT order_key) AS DOUBLE) FROM fact_orders",
        "average_order_value": f"SELECT {AOV} FROM fact_orders",
        "repeat_customer_rate": REPEAT,
        "average_discount_rate": "SELECT CAST(SUM(discount) AS DOUBLE) / COUNT(discount) FROM fact_orders",
    }
    health = " UNION ALL ".join(
        f"SELECT '{name}' AS metric, ({sql}) AS value" for name, sql in values.items())
    return {
        "S6_metric_health": star(f"SELECT metric, value, value IS NOT NULL AS healthy FROM ({health})"),
        "S9_total_revenue": _fact(money("SUM(net_revenue)", "total_revenue")),
        "S10_order_count": _fact("COUNT(DISTINCT order_key) AS order_count"),
        "S11_average_order_value": _fact(AOV),
        "S12_repeat_customer_rate": star(REPEAT),
        "S13_average_discount_rate": _average("discount", "average_discount_rate"),
        "S14_order_value_by_region": star(
            f"SELECT region_name, {AOV} FROM fact_orders {CUSTOMER} {REGION} GROUP BY region_name"),
        "S14_repeat_rate_by_segment": star(f"""
            SELECT market_segment, CAST(COUNT(CASE WHEN orders >= 2 THEN 1 END) AS DOUBLE) / COUNT(*)
              AS repeat_customer_rate
            FROM (SELECT market_segment, customer_key, COUNT(DISTINCT order_key) AS orders
                  FROM fact_orders {CUSTOMER} GROUP BY ALL) GROUP BY market_segment"""),
        "S14_revenue_by_brand_and_year": star(
            f"SELECT brand, year, {money('SUM(net_revenue)', 'total_revenue')} "
            f"FROM fact_orders {PRODUCT} {ORDERED} GROUP BY brand, year"),
    }


def golden_oracles() -> dict[str, str]:
    top = "ORDER BY SUM(net_revenue) DESC, 1 LIMIT 1"
    lines = "COUNT(*) AS line_count"
    orders = "COUNT(DISTINCT order_key) AS order_count"
    revenue = _fact(money("SUM(net_revenue)", "total_revenue"))
    value = _fact(AOV)
    discount = _average("discount", "average_discount_rate")
    repeat = star(REPEAT)
    return {
        "t1_01": _fact(orders),
        "t1_02": _fact(lines),
        "t1_03": revenue,
        "t1_04": value,
        "t1_05": discount,
        "t1_06": _average("tax", "average_tax_rate"),
        "t1_07": _fact("COUNT(DISTINCT customer_key) AS customer_count"),
        "t1_08": _fact("COUNT(DISTINCT product_key) AS product_count"),
        "t1_09": _fact("COUNT(DISTINCT supplier_key) AS supplier_count"),
        "t1_10": _fact(money("SUM(quantity)", "total_quantity")),
        "t1_11": _fact("COUNT(*) AS open_lines", "WHERE order_status = 'O'"),
        "t1_12": _fact("COUNT(*) AS air_shipped_lines", "WHERE ship_mode = 'AIR'"),
        "t1_13": _fact(money("MAX(discount)", "max_discount")),
        "t1_14": _fact(money("MIN(extended_price)", "min_extended_price")),
        "t1_15": star("SELECT COUNT(*) AS customer_count FROM dim_customer"),
        "t1_16": star("SELECT COUNT(*) AS product_count FROM dim_product"),
        "t1_17": star("SELECT COUNT(*) AS supplier_count FROM dim_supplier"),
        "t1_18": star("SELECT COUNT(*) AS nation_count FROM dim_region"),
        "t1_19": star("SELECT COUNT(DISTINCT market_segment) AS segment_count FROM dim_customer"),
        "t1_20": _average("retail_price", "average_retail_price", "dim_product"),
        "t2_01": _revenue_by("region_name", CUSTOMER, REGION),
        "t2_02": _revenue_by("nation_name", SUPPLIER, REGION),
        "t2_03": _fact(orders, ORDERED, "WHERE year = 1997"),
        "t2_04": _fact(REVENUE, ORDERED, "WHERE year = 1998 AND quarter = 1"),
        "t2_05": _fact("COUNT(*) AS weekend_shipped_lines", SHIPPED, "WHERE is_weekend"),
        "t2_06": star(f"SELECT market_segment, {AOV} FROM fact_orders {CUSTOMER} GROUP BY market_segment"),
        "t2_07": _revenue_by("market_segment", CUSTOMER, tail=top),
        "t2_08": _fact("COUNT(DISTINCT customer_key) AS customer_count", CUSTOMER,
                       "WHERE market_segment = 'AUTOMOBILE'"),
        "t2_09": _revenue_by("brand", PRODUCT),
        "t2_10": _revenue_by("product_type", PRODUCT),
        "t2_11": _fact(lines, SUPPLIER, REGION, "WHERE region_name = 'ASIA'"),
        "t2_12": _average("discount", "average_discount",
                          f"fact_orders {CUSTOMER} WHERE market_segment = 'BUILDING'"),
        "t2_13": _fact(orders, CUSTOMER, REGION, f"WHERE nation_name = '{NATION}'"),
        "t2_14": star(
            f"SELECT {REVENUE} FROM fact_orders {ORDERED} JOIN latest USING (year, quarter)",
            f"latest AS (SELECT year, quarter FROM fact_orders {ORDERED} "
            "ORDER BY year DESC, quarter DESC LIMIT 1)"),
        "t2_15": _fact(lines, SHIPPED, "WHERE month = 12"),
        "t2_16": _fact(REVENUE, ORDERED, "WHERE day_name = 'Monday'"),
        "t2_17": _revenue_by("product_type", PRODUCT, tail=top),
        "t2_18": _average("retail_price", "average_retail_price",
                          f"fact_orders {CUSTOMER} {PRODUCT} WHERE market_segment = 'MACHINERY'"),
        "t2_19": star("""
            SELECT COUNT(*) AS line_count FROM fact_orders
            JOIN dim_date o ON order_date_key = o.date_key JOIN dim_date s ON ship_date_key = s.date_key
            WHERE DATE_DIFF('day', o.full_date, s.full_date) > 30"""),
        "t2_20": _revenue_by("year", ORDERED),
        "t3_01": repeat, "t3_02": repeat, "t3_03": repeat,
        "t3_04": value, "t3_05": value, "t3_06": value,
        "t3_07": discount, "t3_08": discount,
        "t3_09": revenue, "t3_10": revenue,
        "Q51": _fact("COUNT(*) FILTER (order_status = 'O') AS open_by_order, "
                     "COUNT(*) FILTER (line_status = 'O') AS open_by_line"),
        "Q52": _fact(lines, """WHERE supplier_key IN (SELECT supplier_key FROM dim_supplier WHERE nation_key IN
                     (SELECT nation_key FROM dim_region WHERE region_name = 'ASIA'))"""),
        "Q53": _fact(orders, CUSTOMER, "WHERE nation_key = "
                     f"(SELECT nation_key FROM dim_region WHERE nation_name = '{NATION}')"),
        "Q54": _fact("CAST(SUM(net_revenue) AS DOUBLE) / COUNT(*) AS average_line_value, " + AOV),
        "Q55": _fact(lines, SUPPLIER, REGION, "WHERE region_name ILIKE 'Asia'"),
        "Q_lines_by_return_flag": star(
            "SELECT return_flag, COUNT(*) AS line_count FROM fact_orders GROUP BY return_flag"),
    }


STAMP = "regexp_replace(strftime({}, '%Y-%m-%dT%H:%M:%S.%f'), '[.]000000$', '')"

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def case_of(values: tuple[str, ...], number: str) -> str:
    quoted = [v.replace("'", "''") for v in values]
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(quoted))
    return f"CASE {number} % {len(values)} {arms} END"


TRACES = f"""
traces AS (
  SELECT concat('q', event_id) AS query_id, ts AS event_ts, event_type,
         concat('What about ', event_type, '?') AS question,
         CASE WHEN event_type <> 'error' THEN 'SELECT 1' END AS sql,
         event_type <> 'error' AS succeeded,
         CASE WHEN event_type = 'error' THEN {case_of(derived.ERRORS, 'event_id')} END AS error,
         CAST(CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS BIGINT) AS attempt_count,
         CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END AS row_count,
         value AS latency_seconds,
         CASE WHEN user_id % 3 = 0 THEN 'gpt-4o-mini' ELSE 'llama3' END AS model,
         {K} AS prompt, 2 * {K} AS completion
  FROM events),
votes AS (
  SELECT concat('q', event_id - event_id % 5) AS query_id, ts AS event_ts,
         CASE WHEN event_type = 'signup' THEN 'down' ELSE 'up' END AS vote
  FROM events WHERE event_type IN ('click', 'purchase', 'signup')),
last_votes AS (
  SELECT query_id, event_ts, vote FROM votes
  QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY event_ts DESC) = 1)"""

CATEGORY = """CASE
  WHEN error IS NULL THEN 'succeeded'
  WHEN regexp_matches(error, '^(Empty query\\.|Multiple statements are not allowed\\.)$|^Only SELECT|^Disallowed keyword in query:')
    THEN 'guardrail rejection'
  WHEN error LIKE '%exceeded%' AND error LIKE '%cancelled%' THEN 'query timeout'
  WHEN error IN ('Query returned no rows.', 'Query returned only NULL values.')
    OR error LIKE '%falls outside [0, 1]%' THEN 'implausible result'
  WHEN regexp_matches(error, '^(Binder|Catalog|Parser|Conversion|Constraint) Error:') THEN 'SQL execution error'
  WHEN regexp_matches(error, 'HTTP|unreachable|Unavailable|timed out|Connection') THEN 'LLM backend error'
  ELSE 'other' END"""

PRICED = f"""
priced AS (
  SELECT *, CAST(event_ts AS DATE) AS day, {CATEGORY} AS category,
         CASE WHEN model = 'gpt-4o-mini'
              THEN (prompt * 0.15::DOUBLE + completion * 0.60::DOUBLE) / 1000000 ELSE 0.0::DOUBLE END AS cost_usd
  FROM traces)"""

COST = "CAST(SUM(CAST(cost_usd AS DECIMAL(28,12))) AS DOUBLE)"

# Nearest rank from the sorted list: half to even, as index into 0 .. n - 1.
LATENCY = """
ranked AS (SELECT latency_seconds AS v, ROW_NUMBER() OVER (ORDER BY latency_seconds) - 1 AS i,
                  COUNT(*) OVER () AS n FROM traces),
latency AS (SELECT MAX(v) FILTER (i = round_even(CAST(0.5 AS DOUBLE) * (n - 1), 0)) AS p50,
                   MAX(v) FILTER (i = round_even(CAST(0.95 AS DOUBLE) * (n - 1), 0)) AS p95 FROM ranked)"""


def log(sql: str, *more: str) -> str:
    return f"WITH {','.join((TRACES, PRICED, LATENCY, *more))}\n{sql}"


def telemetry_oracles() -> dict[str, str]:
    stamp = STAMP.format("event_ts")
    both = f"""
        SELECT 'traces' AS table_name, query_id, {stamp} AS timestamp, model FROM traces UNION ALL
        SELECT 'feedback', query_id, {stamp}, vote FROM last_votes"""
    return {
        "T1_append_log": log(f"""
            SELECT event_type, COUNT(*) AS events, COUNT(DISTINCT query_id) AS queries,
                   {STAMP.format('MIN(event_ts)')} AS first, {STAMP.format('MAX(event_ts)')} AS last
            FROM (SELECT 'trace' AS event_type, query_id, event_ts FROM traces UNION ALL
                  SELECT 'feedback', query_id, event_ts FROM votes) GROUP BY event_type"""),
        "T2_vote_domain": """
            SELECT v IN ('up', 'down') AS accepted, v AS vote, COUNT(*) AS rows FROM (
              SELECT CASE event_type WHEN 'click' THEN 'up' WHEN 'signup' THEN 'down'
                                     WHEN 'view' THEN 'view' ELSE 'none' END AS v FROM events) GROUP BY v""",
        "T3_read_feedback": log(
            f"SELECT 'feedback' AS event_type, query_id, {stamp} AS timestamp, vote FROM votes"),
        "T4_flat_traces": log(f"""
            SELECT 'trace' AS event_type, query_id, {stamp} AS timestamp, question, sql, succeeded, error,
                   attempt_count, row_count, latency_seconds, model, prompt AS usage__prompt_tokens,
                   completion AS usage__completion_tokens, prompt + completion AS usage__total_tokens
            FROM traces"""),
        "T6_merge_traces": log(f"""
            SELECT query_id, {stamp} AS timestamp, question, sql, succeeded, error,
                   attempt_count + CAST(event_type IN ('purchase', 'error') AS BIGINT) AS attempt_count,
                   row_count, latency_seconds, model, prompt AS usage__prompt_tokens,
                   completion AS usage__completion_tokens, prompt + completion AS usage__total_tokens
            FROM traces"""),
        "T7_merge_feedback": log(f"SELECT query_id, {stamp} AS timestamp, vote FROM last_votes"),
        "T8_pipeline": log(both),
        "T9_incremental": log(both),
    }


def monitoring_oracles() -> dict[str, str]:
    day = "strftime(day, '%Y-%m-%d')"
    return {
        "M1_enriched": log(f"""
            SELECT query_id, {day} AS date, category, prompt AS usage__prompt_tokens,
                   completion AS usage__completion_tokens, cost_usd FROM priced"""),
        "M2_cost_by_model": log(f"SELECT model, {COST} AS cost_usd FROM priced GROUP BY model"),
        "M3_latency": log("SELECT p50, p95 FROM latency"),
        "M4_categories": log(
            "SELECT COALESCE(error, '') AS error, category, COUNT(*) AS n FROM priced GROUP BY 1, 2"),
        "M5_summary": log(f"""
            SELECT COUNT(*) AS total_queries, AVG(CAST(succeeded AS DOUBLE)) AS execution_accuracy,
              {COST} AS total_cost_usd,
              CAST((SELECT COUNT(*) FROM last_votes) AS DOUBLE) / COUNT(*) AS feedback_rate,
              (SELECT COUNT(*) FROM last_votes WHERE vote = 'up') AS helpful_count,
              (SELECT COUNT(*) FROM last_votes WHERE vote = 'down') AS not_helpful_count,
              (SELECT p50 FROM latency) AS latency_p50_seconds,
              (SELECT p95 FROM latency) AS latency_p95_seconds
            FROM priced"""),
        "M6_daily": log(f"""
            SELECT {day} AS date, COUNT(*) AS query_count, AVG(CAST(succeeded AS DOUBLE)) AS execution_accuracy,
                   {COST} / COUNT(*) AS avg_cost_usd FROM priced GROUP BY day"""),
        "M6_daily_stream": log(f"""
            SELECT {day} AS date, COUNT(*) AS query_count, AVG(CAST(succeeded AS DOUBLE)) AS execution_accuracy,
                   {COST} / COUNT(*) AS avg_cost_usd FROM priced GROUP BY day"""),
        "M7_failures": log(
            "SELECT category, COUNT(*) AS count FROM priced WHERE NOT succeeded GROUP BY category"),
        "M8_trace_page": log(f"""
            SELECT query_id, {STAMP.format('event_ts')} AS timestamp, question, model, succeeded, category,
                   attempt_count, latency_seconds, cost_usd
            FROM priced ORDER BY event_ts DESC, query_id LIMIT 100 OFFSET 50"""),
        "M8_trace_total": log("SELECT COUNT(*) AS total FROM priced"),
        "G11_over_quota": log(f"""
            SELECT query_id, {day} AS date FROM priced WHERE model = 'gpt-4o-mini'
            QUALIFY ROW_NUMBER() OVER (PARTITION BY day ORDER BY event_ts, query_id) > 50"""),
    }


ATTEMPTS = f"""
attempts AS (
  SELECT event_id // 2 AS question_id, CAST(event_id % 2 + 1 AS INTEGER) AS attempt_no,
         CAST((event_id // 2) % 3 + 1 AS INTEGER) AS tier, {case_of(derived.REPLIES, 'event_id')} AS reply,
         CASE WHEN event_type = 'error' THEN {case_of(derived.ERRORS, 'event_id')} END AS error,
         CASE WHEN event_type = 'error' AND event_id % 8 = 5 THEN 'backend unreachable' END AS api_error,
         event_type IN ('click', 'purchase', 'view') AS valid,
         CASE WHEN event_type = 'signup' THEN 'Query returned no rows.' ELSE 'Result looks plausible.' END AS reason,
         event_type IN ('click', 'purchase') AS correct, {K} AS total_tokens,
         {K} - {K} // 4 AS prompt_tokens, {K} // 4 AS completion_tokens,
         concat('What about ', event_type, '?') AS question, ts, value AS latency_seconds,
         CASE WHEN event_type <> 'error' THEN user_id ELSE 0 END AS row_count,
         CASE WHEN user_id % 2 = 0 THEN 'gpt-4o-mini' ELSE 'llama3' END AS model,
         CASE WHEN user_id % 4 < 2 THEN 'retrieval enabled' ELSE 'retrieval disabled' END AS condition
  FROM events),
cleaned AS (
  SELECT *, rtrim(trim(regexp_replace(regexp_replace(trim(reply, e' \n'), '^```(sql)?\\s*', '', 'i'),
                                '```\\s*$', ''), e' \n'), ';') AS sql FROM attempts),
kept AS (
  SELECT * FROM attempts a WHERE attempt_no = 1 OR NOT EXISTS (
    SELECT 1 FROM attempts b WHERE b.question_id = a.question_id AND b.attempt_no = 1
      AND (b.valid OR b.api_error IS NOT NULL))),
scored AS (
  SELECT question_id, attempt_no, tier, model, condition, total_tokens,
         CASE WHEN api_error IS NULL THEN sql ELSE '' END AS sql,
         api_error IS NULL AND error IS NULL AND correct AS correct,
         CASE WHEN api_error IS NOT NULL THEN 'API error: ' || api_error
              WHEN error IS NOT NULL THEN error WHEN NOT correct THEN 'result mismatch' ELSE '' END AS error
  FROM cleaned),
firsts AS (SELECT * FROM kept WHERE attempt_no = 1),
lasts AS (SELECT * FROM kept QUALIFY ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY attempt_no DESC) = 1),
retried AS (
  SELECT l.question_id, l.tier, f.correct AS single_shot_correct, l.correct AS retry_correct,
         l.attempt_no > 1 AS retried,
         l.attempt_no > 1 AND NOT f.correct AND l.correct AS rescued,
         l.attempt_no > 1 AND f.correct AND NOT l.correct AS regressed,
         CAST(l.attempt_no AS BIGINT) AS attempt_count, COALESCE(l.error, '') AS final_error
  FROM firsts f JOIN lasts l USING (question_id))"""

WORDS = ("INSERT|UPDATE|DELETE|DROP|ALTER|CREATE|TRUNCATE|ATTACH|DETACH|COPY|EXPORT|IMPORT|CALL|PRAGMA|"
         "SET|INSTALL|LOAD|VACUUM|GRANT|REVOKE")


def refusal(sql: str) -> str:
    body = f"rtrim(trim({sql}, e' \\n'), ';')"
    return f"""CASE
      WHEN {body} = '' THEN 'Empty query.'
      WHEN contains({body}, ';') THEN 'Multiple statements are not allowed.'
      WHEN NOT regexp_matches({body}, '^\\s*(WITH|SELECT)\\b', 'i')
        THEN 'Only SELECT (or WITH ... SELECT) statements are allowed.'
      WHEN regexp_matches({body}, '\\b({WORDS})\\b', 'i')
        THEN 'Disallowed keyword in query: ' || regexp_extract({body}, '\\b({WORDS})\\b', 1, 'i')
      ELSE '' END"""


def tries(sql: str, *more: str) -> str:
    return f"WITH {','.join((ATTEMPTS, *more))}\n{sql}"


def guard_oracles() -> dict[str, str]:
    outside = "Question asks for a rate/share, but the result falls outside [0, 1]."
    fine = "Result looks plausible."
    asked = (
        ("What rate does a typical order reach?", f"SELECT {AOV} FROM fact_orders"),
        ("What is the repeat customer rate?", REPEAT),
        ("Which fraction is discounted?", "SELECT CAST(AVG(discount) AS DOUBLE) FROM fact_orders"),
    )
    rates = " UNION ALL ".join(f"SELECT '{q}' AS question, ({sql}) AS value, true AS is_rate" for q, sql in asked)
    verdicts = star(f"""
        SELECT question, NOT (is_rate AND value NOT BETWEEN 0 AND 1) AS plausible,
               CASE WHEN is_rate AND value NOT BETWEEN 0 AND 1 THEN '{outside}' ELSE '{fine}' END AS reason
        FROM ({rates} UNION ALL
              SELECT 'How many orders are there?', COUNT(DISTINCT order_key), false FROM fact_orders UNION ALL
              -- asks for a share, but an exact decimal is not range-checked
              SELECT 'What share of revenue is the total?', SUM(net_revenue), false FROM fact_orders)""")
    return {
        "G1_classify": tries(f"""
            SELECT question_id, attempt_no, {refusal('reply')} AS rejection, {refusal('reply')} = '' AS allowed,
                   {refusal('sql')} AS clean_rejection FROM cleaned"""),
        "G2_row_cap": _fact("LEAST(COUNT(*), 1000) AS row_count, COUNT(*) > 1000 AS truncated"),
        "G5_guarded_query": star(f"""
            SELECT region_name, year, COUNT(DISTINCT order_key) AS orders
            FROM fact_orders {CUSTOMER} {REGION} {ORDERED} GROUP BY region_name, year"""),
        "G6_sql_of_reply": tries("SELECT question_id, attempt_no, sql FROM cleaned"),
        "G7_plausibility": verdicts,
        "G8_json_safe": """
            SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS DOUBLE) AS o_totalprice,
                   strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate FROM orders""",
        "G8_json_safe_nested": f"""
            SELECT event_id, {STAMP.format('ts')} AS ts, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS whole_second,
                   CAST({K} AS DOUBLE) AS amount, strftime(ts, '%Y-%m-%d') AS day, CAST({K} AS DOUBLE) AS named_amount
            FROM events""",
        "G12_usage_totals": tries("""
            SELECT question_id AS query_id,
              CASE WHEN bool_and(api_error IS NOT NULL) THEN -1
                   ELSE SUM(total_tokens) FILTER (api_error IS NULL) END::BIGINT AS prompt_tokens,
              CASE WHEN bool_and(api_error IS NOT NULL) THEN -1
                   ELSE SUM(CASE WHEN valid THEN total_tokens ELSE 0 END) FILTER (api_error IS NULL) END::BIGINT
                   AS completion_tokens,
              CASE WHEN bool_and(api_error IS NOT NULL) THEN -1
                   ELSE SUM(total_tokens) FILTER (api_error IS NULL) END::BIGINT AS total_tokens
            FROM attempts GROUP BY question_id"""),
        "G13_failure_text": tries("""
            SELECT question_id AS query_id, COALESCE(text, 'no attempts made') AS error
            FROM (SELECT DISTINCT question_id FROM attempts) LEFT JOIN (
              SELECT question_id, CASE WHEN valid THEN '' ELSE COALESCE(error, reason) END AS text
              FROM attempts WHERE api_error IS NULL
              QUALIFY ROW_NUMBER() OVER (PARTITION BY question_id ORDER BY attempt_no DESC) = 1)
            USING (question_id)"""),
    }


# Dense on purpose: every query meets every document, as the definition says.
TERMS = r"""
tok AS (
  SELECT doc_id, unnest(list_filter(string_split_regex(lower(replace(text, '_', ' ')), '\s+'),
                                    lambda x: x <> '')) AS term FROM documents),
post AS (SELECT doc_id, term, COUNT(*) AS tf FROM tok GROUP BY ALL),
lens AS (SELECT d.doc_id, COUNT(t.term) AS dl FROM documents d LEFT JOIN tok t USING (doc_id) GROUP BY d.doc_id),
tot AS (SELECT COUNT(*) AS n, AVG(dl) AS mean_length FROM lens),
freq AS (SELECT term, COUNT(*) AS df FROM post GROUP BY term),
rated AS (SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM freq, tot),
terms AS (SELECT term, df, CASE WHEN raw < 0 THEN 0.25::DOUBLE * (SELECT AVG(raw) FROM rated) ELSE raw END AS idf
          FROM rated)"""

RETRIEVAL = TERMS + r""",
asked AS (
  SELECT item_id AS query_id, unnest(list_filter(string_split_regex(lower(replace(text, '_', ' ')), '\s+'),
                                                 lambda x: x <> '')) AS term FROM benchmark),
sparse AS (
  SELECT query_id, doc_id,
    SUM(idf * (tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean_length)))) AS score
  FROM asked JOIN terms USING (term) JOIN post USING (term) JOIN lens USING (doc_id), tot
  GROUP BY query_id, doc_id),
vec AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
nrm AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS len FROM vec),
uni AS (SELECT vec_id, CASE WHEN len = 0 THEN e ELSE list_transform(e, lambda x: x / len) END AS u FROM nrm),
dense AS (
  SELECT item_id AS query_id, d.doc_id, b.text AS query_text,
    COALESCE(list_dot_product(q.u, v.u), 0.0::DOUBLE) AS near, COALESCE(s.score, 0.0::DOUBLE) AS worded
  FROM benchmark b CROSS JOIN documents d
  LEFT JOIN uni q ON q.vec_id = b.item_id LEFT JOIN uni v ON v.vec_id = d.doc_id
  LEFT JOIN sparse s ON s.query_id = b.item_id AND s.doc_id = d.doc_id),
ranges AS (
  SELECT query_id, MIN(near) AS v_low, MAX(near) AS v_high, MIN(worded) AS k_low, MAX(worded) AS k_high
  FROM dense GROUP BY query_id),
mixed AS (
  SELECT query_id, doc_id, near, worded,
    CASE WHEN v_high > v_low THEN (near - v_low) / (v_high - v_low) ELSE 0 END AS vn,
    CASE WHEN k_high > k_low THEN (worded - k_low) / (k_high - k_low) ELSE 0 END AS kn
  FROM dense JOIN ranges USING (query_id))"""


def best_of(score: str, k: int, source: str = "mixed") -> str:
    return f"""SELECT query_id, doc_id, round({score}, 6) AS score,
        CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY round({score}, 6) DESC, doc_id) AS INTEGER) AS rank
        FROM {source} QUALIFY rank <= {k}"""


def rerank_of(candidates: str, k: int) -> str:
    return f"""SELECT query_id, doc_id, round(near, 6) AS score,
        CAST(ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY round(near, 6) DESC, c.rank) AS INTEGER) AS rank
        FROM {candidates} c JOIN (SELECT query_id, doc_id, near FROM mixed) USING (query_id, doc_id)
        QUALIFY ROW_NUMBER() OVER (PARTITION BY query_id ORDER BY round(near, 6) DESC, c.rank) <= {k}"""


HYBRID = "0.5::DOUBLE * vn + 0.5::DOUBLE * kn"
SCHEMA = (f"wide AS ({best_of(HYBRID, 8)})", f"final AS ({rerank_of('wide', 4)})")


def counted(sql: str) -> str:
    """Over the words alone, whose steps are each computed once."""
    steps = TERMS.replace("tok AS (", "tok AS MATERIALIZED (").replace("freq AS (", "freq AS MATERIALIZED (")
    return f"WITH {steps}\n{sql}"


def found(sql: str, *more: str) -> str:
    return f"WITH {','.join((RETRIEVAL, *more))}\n{sql}"


def retrieval_oracles() -> dict[str, str]:
    return {
        "R1_tokenize": r"""
            SELECT doc_id, CAST(len(w) AS INTEGER) AS tokens, md5(array_to_string(w, ' ')) AS digest FROM (
              SELECT doc_id, list_filter(string_split_regex(lower(replace(text, '_', ' ')), '\s+'),
                                         lambda x: x <> '') AS w FROM documents)""",
        "R2_terms": r"""
            SELECT term, df, round(CASE WHEN raw < 0 THEN 0.25::DOUBLE * AVG(raw) OVER () ELSE raw END, 6) AS idf FROM (
              SELECT term, df, ln(n - df + 0.5::DOUBLE) - ln(df + 0.5::DOUBLE) AS raw FROM (
                SELECT term, COUNT(*) AS df FROM (
                  SELECT unnest(list_distinct(list_filter(
                    string_split_regex(lower(replace(text, '_', ' ')), '\s+'), lambda x: x <> ''))) AS term FROM documents)
                GROUP BY term), (SELECT COUNT(*) AS n FROM documents))""",
        "R2_corpus": counted("""
            SELECT n, round(mean_length, 6) AS mean_length,
                   (SELECT round(AVG(raw), 6) FROM rated) AS mean_idf FROM tot"""),
        "R3_stored_index": counted("""
            SELECT COUNT(*) AS postings, CAST(SUM(tf) AS BIGINT) AS tokens, COUNT(DISTINCT term) AS terms,
                   MAX(tf) AS most FROM post"""),
        "R4_bm25_scores": found("""
            SELECT query_id, COUNT(*) AS matched, round(SUM(score), 4) AS total, round(MAX(score), 6) AS best
            FROM sparse GROUP BY query_id"""),
        "R5_unit_vectors": found("""
            SELECT vec_id AS doc_id, round(list_dot_product(u, u), 6) AS length, round(list_sum(u), 6) AS total
            FROM uni"""),
        "R6_vector_scores": found("""
            SELECT query_id, COUNT(*) AS documents, round(SUM(near), 4) AS total, round(MIN(near), 6) AS lowest,
                   round(MAX(near), 6) AS highest FROM dense GROUP BY query_id"""),
        "R7_score_ranges": found("""
            SELECT query_id, round(v_low, 6) AS v_low, round(v_high, 6) AS v_high, round(k_low, 6) AS k_low,
                   round(k_high, 6) AS k_high FROM ranges"""),
        "R8_top_k": found(best_of("score", 5, "sparse")),
        "R9_keyword_search": found(best_of("worded", 5)),
        "R10_vector_search": found(best_of("near", 5)),
        "R11_hybrid_search": found(best_of(HYBRID, 5)),
        "R12_no_vectors": found(best_of("0.5::DOUBLE * kn", 5)),
        "R13_rerank": found(rerank_of("words", 4), f"words AS ({best_of('worded', 8)})"),
        "R14_reply_order": found("""
            SELECT query_id, doc_id, w.score, CAST(w.rank AS INTEGER) AS rank FROM words w
              WHERE query_id % 4 = 1 AND w.rank <= 5
            UNION ALL
            SELECT query_id, doc_id, p.score, CAST(place AS INTEGER) FROM words w JOIN (
              VALUES (0, 3, 1, 1.0::DOUBLE), (0, 1, 2, 0.99::DOUBLE), (0, 2, 3, 0.98::DOUBLE),
                     (2, 1, 1, 1.0::DOUBLE), (2, 2, 2, 0.99::DOUBLE),
                     (3, 8, 1, 1.0::DOUBLE), (3, 4, 2, 0.99::DOUBLE)) AS p(kind, number, place, score)
            ON query_id % 4 = kind AND w.rank = number""", f"words AS ({best_of('worded', 8)})"),
        "R15_search_schema": found("""
            SELECT query_id, doc_id, lang AS doc_type, source AS name, text, score, rank
            FROM final JOIN documents USING (doc_id)""", *SCHEMA),
        "R16_context": found(r"""
            SELECT query_id, CAST(length(context) AS INTEGER) AS characters, md5(context) AS digest FROM (
              SELECT query_id, string_agg(text, e'\n\n' ORDER BY rank) AS context
              FROM final JOIN documents USING (doc_id) GROUP BY query_id)""", *SCHEMA),
    }


METHODS = (
    f"wide AS ({best_of(HYBRID, 8)})",
    f"""ranked AS (
      SELECT 'Keyword only' AS method, query_id, doc_id, rank FROM ({best_of('worded', 5)}) UNION ALL
      SELECT 'Vector only', query_id, doc_id, rank FROM ({best_of('near', 5)}) UNION ALL
      SELECT 'Hybrid', query_id, doc_id, rank FROM wide WHERE rank <= 5 UNION ALL
      SELECT 'Hybrid + rerank', query_id, doc_id, rank FROM ({rerank_of('wide', 5)}))""",
    """truth AS (SELECT item_id AS query_id, doc_id FROM benchmark b, documents d
                 WHERE contains(d.text, b.text))""",
    """rates AS (
      SELECT method, query_id, query_id % 3 + 1 AS tier, COALESCE(1.0::DOUBLE / MIN(r.rank) FILTER (t.doc_id IS NOT NULL), 0) AS rr
      FROM ranked r LEFT JOIN truth t USING (query_id, doc_id) GROUP BY method, query_id)""",
)
MEANS = ("COUNT(*) AS questions, round(AVG(CASE WHEN rr > 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS hit_rate, "
         "round(AVG(rr), 9) AS mrr")


def evaluation_oracles() -> dict[str, str]:
    accuracy = "AVG(CAST({} AS DOUBLE))"
    by_tier = lambda flag, name: ", ".join(
        f"COALESCE(AVG(CAST({flag} AS DOUBLE)) FILTER (tier = {t}), 0) AS {name.format(t)}" for t in (1, 2, 3))
    return {
        "E2_hits": found("""
            SELECT query_id, CAST(query_id % 3 + 1 AS INTEGER) AS tier, CAST(rr > 0 AS INTEGER) AS hit,
                   rr AS reciprocal_rank FROM rates WHERE method = 'Keyword only'""", *METHODS),
        "E3_rates_by_tier": found(f"""
            SELECT method, CAST(tier AS VARCHAR) AS tier, {MEANS} FROM rates
              WHERE method = 'Vector only' GROUP BY method, tier UNION ALL
            SELECT method, 'all', {MEANS} FROM rates WHERE method = 'Vector only' GROUP BY method""", *METHODS),
        "E4_compare_methods": found(f"""
            SELECT method, CAST(tier AS VARCHAR) AS tier, {MEANS} FROM rates GROUP BY method, tier UNION ALL
            SELECT method, 'all', {MEANS} FROM rates GROUP BY method""", *METHODS),
        "E5_winner": found(f"""
            SELECT method, hit_rate, mrr FROM (SELECT method, {MEANS} FROM rates GROUP BY method)
            ORDER BY hit_rate DESC, mrr DESC,
              list_position(['Keyword only', 'Vector only', 'Hybrid', 'Hybrid + rerank'], method) LIMIT 1""",
            *METHODS),
        "E6_match_per_question": """
            SELECT o_custkey AS question_id,
              bool_and(CAST(o_totalprice AS DECIMAL(15,2)) >= 20000) AS correct FROM orders GROUP BY o_custkey""",
        "E8_outcomes": tries("SELECT question_id, attempt_no, sql, correct, error FROM scored"),
        "E8_executed": tries(f"""
            SELECT question_id, attempt_no,
              failure IS NULL AND CASE question_id % 3 WHEN 0 THEN sql LIKE 'SELECT COUNT%' WHEN 1 THEN sql LIKE 'WITH%'
                                                       ELSE sql LIKE 'select region%' END AS correct,
              CASE WHEN failure IS NOT NULL THEN 0 WHEN sql LIKE 'select region%' THEN nations ELSE 1 END AS n_rows,
              CASE WHEN failure IS NOT NULL OR sql LIKE 'select region%' THEN -1
                   WHEN sql LIKE 'WITH%' THEN 1 ELSE lines END::DOUBLE AS answer,
              COALESCE(failure, '') AS error
            FROM (SELECT *, NULLIF({refusal('sql')}, '') AS failure FROM cleaned),
                 (SELECT COUNT(*) AS lines FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
                 (SELECT COUNT(*) AS nations FROM nation JOIN region ON n_regionkey = r_regionkey)"""),
        "E9_summary": tries(f"""
            SELECT model, condition, COUNT(*) AS questions, {accuracy.format('correct')} AS accuracy,
              {by_tier('correct', 'tier_{}_accuracy')}, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens,
              COUNT(*) FILTER (error LIKE 'API error%') AS api_error_count
            FROM scored GROUP BY model, condition"""),
        "E10_waits": """
            SELECT event_id, CAST(CASE event_id % 4 WHEN 0 THEN 9 * 60 + 26.784::DOUBLE WHEN 1 THEN 5.2
                                                    WHEN 2 THEN 30 ELSE 1200 END AS DOUBLE) AS hint,
              CAST(CASE event_id % 4 WHEN 0 THEN 9 * 60 + 26.784::DOUBLE + 2 WHEN 1 THEN 5.2::DOUBLE + 2
                                     WHEN 2 THEN 32 ELSE 902 END AS DOUBLE) AS wait FROM events""",
        "E11_final_attempts": tries("""
            SELECT question_id, attempt_no, CAST(attempt_no AS BIGINT) AS attempt_count, valid AS succeeded
            FROM lasts"""),
        "E12_retry_outcomes": tries("SELECT * FROM retried"),
        "E13_retry_summary": tries(f"""
            SELECT {accuracy.format('single_shot_correct')} AS single_shot_accuracy,
              {accuracy.format('retry_correct')} AS retry_accuracy,
              {by_tier('single_shot_correct', 'tier_{}_single')}, {by_tier('retry_correct', 'tier_{}_retry')},
              COUNT(*) FILTER (retried) AS retried_count, COUNT(*) FILTER (rescued) AS rescued_count,
              COUNT(*) FILTER (regressed) AS regressed_count,
              round({accuracy.format('retry_correct')} - {accuracy.format('single_shot_correct')}, 9) AS lift
            FROM retried"""),
        "E14_ablation": tries(f"""
            SELECT model, condition, COUNT(*) FILTER (attempt_no = 2) AS questions,
              {accuracy.format('correct')} FILTER (attempt_no = 2) AS accuracy,
              {accuracy.format('correct')} FILTER (attempt_no = 1) AS earlier_accuracy,
              round({accuracy.format('correct')} FILTER (attempt_no = 2)
                    - {accuracy.format('correct')} FILTER (attempt_no = 1), 9) AS change
            FROM scored WHERE tier = 3 GROUP BY model, condition"""),
        "E15_tagged_outcomes": tries("""
            SELECT CASE attempt_no WHEN 1 THEN 'llama3' ELSE 'gpt-4o-mini' END AS model,
              CASE attempt_no WHEN 1 THEN 'retrieval disabled' ELSE 'retrieval enabled' END AS condition,
              correct, COUNT(*) AS n, CAST(SUM(total_tokens) AS BIGINT) AS total_tokens
            FROM scored GROUP BY 1, 2, 3"""),
        "E16_assembled_traces": tries("""
            SELECT question_id, tier, CAST(COUNT(*) AS INTEGER) AS attempts,
                   arg_max(question, attempt_no) AS question, arg_max(row_count, attempt_no) AS row_count,
                   arg_max(valid, attempt_no) AS succeeded, arg_max(sql, attempt_no) AS sql,
                   string_agg(reply, '|' ORDER BY attempt_no) AS replies FROM cleaned GROUP BY question_id, tier"""),
        "E17_failing_questions": tries("""
            SELECT question_id, attempt_no, tier FROM kept
            WHERE question_id IN (SELECT question_id FROM lasts WHERE NOT correct)"""),
        "A1_candidate_sql": tries(
            "SELECT question_id, c.sql FROM lasts JOIN cleaned c USING (question_id, attempt_no)"),
        "A2_verdicts": tries(f"""
            SELECT question_id, attempt_no, failure IS NULL AND valid AS valid,
              CASE WHEN failure IS NULL THEN reason ELSE 'execution failed' END AS reason,
              COALESCE(failure, '') AS error
            FROM (SELECT *, COALESCE(NULLIF({refusal('sql')}, ''), error) AS failure FROM cleaned)"""),
        "A3_feedback": tries("""
            SELECT question_id, attempt_no,
              COALESCE(LAG(COALESCE(error, reason)) OVER (PARTITION BY question_id ORDER BY attempt_no), '') AS feedback
            FROM attempts"""),
        "A4_kept_attempts": tries("SELECT question_id, attempt_no, valid FROM kept"),
        "A5_answer_log": tries(f"""
            SELECT CAST(question_id AS VARCHAR) AS query_id, {STAMP.format('l.ts')} AS timestamp, l.question, l.model,
              l.row_count, round(t.seconds, 6) AS latency_seconds, l.valid AS succeeded,
              CAST(t.prompt AS BIGINT) AS usage__prompt_tokens, CAST(t.completion AS BIGINT) AS usage__completion_tokens,
              CAST(l.attempt_no AS BIGINT) AS attempt_count,
              CASE WHEN l.valid THEN '' ELSE COALESCE(l.error, l.reason) END AS error, c.sql,
              CAST(t.total AS BIGINT) AS usage__total_tokens
            FROM lasts l JOIN cleaned c USING (question_id, attempt_no)
            JOIN (SELECT question_id, SUM(total_tokens) AS total, SUM(prompt_tokens) AS prompt,
                         SUM(completion_tokens) AS completion, SUM(latency_seconds) AS seconds FROM kept GROUP BY question_id) t USING (question_id)"""),
    }


def all_oracles() -> dict[str, str]:
    return {
        **warehouse_oracles(), **metric_oracles(), **golden_oracles(), **telemetry_oracles(),
        **monitoring_oracles(), **guard_oracles(), **retrieval_oracles(), **evaluation_oracles(),
    }
