"""One SQL text per oracle-checked query, over the given tables."""

from __future__ import annotations

from marginalia.operators.actions import CHANNEL, INVENTORY, MARKETING, PRICING
from marginalia.operators.clean import CLEAN_COLUMNS
from marginalia.operators.stats import NUMERIC
from marginalia.plans.catalog import EXACT

FIRST_LINES = """
first_lines AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
      PARTITION BY l_orderkey, l_partkey
      ORDER BY l_linenumber, l_suppkey, l_shipdate, l_extendedprice, l_quantity, l_discount) AS rn
    FROM lineitem) WHERE rn = 1)"""

LINES = f"""{FIRST_LINES},
base AS (
  SELECT l_orderkey || '-' || l_partkey AS row_id,
         l_orderkey AS order_id,
         CAST(o_orderdate AS DATE) AS order_date,
         CAST(l_shipdate AS DATE) AS ship_date,
         o_orderpriority AS ship_mode,
         o_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
         'CITY_' || (o_custkey % 10) AS city, n_name AS state, r_name AS region,
         CAST(o_custkey % 100 AS VARCHAR) AS postal_code,
         l_partkey AS product_id,
         CASE CAST(split_part(p_brand, '#', 2) AS INT) % 3
              WHEN 0 THEN 'Furniture' WHEN 1 THEN 'Office Supplies' ELSE 'Technology' END AS category,
         p_brand AS sub_category, p_name AS product_name,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS gross,
         CAST(CAST(l_discount AS DECIMAL(4,2)) * 5 AS DECIMAL(6,2)) AS discount,
         CAST(split_part(p_brand, '#', 2) AS INT) % 20 AS cost_step,
         CAST(l_quantity AS INT) AS quantity
  FROM first_lines
  JOIN part ON l_partkey = p_partkey
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  WHERE CAST(l_quantity AS INT) > 0),
priced AS (
  SELECT *, CAST(gross * (1 - discount) AS DECIMAL(18,4)) AS sales,
         CAST(gross * (CAST(0.45 AS DECIMAL(4,2)) + CAST(0.02 AS DECIMAL(4,2)) * cost_step)
              AS DECIMAL(18,4)) AS cost
  FROM base),
profited AS (
  SELECT *, CAST(sales - cost AS DECIMAL(18,4)) AS profit FROM priced),
lines AS (
  SELECT row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment,
         city, state, region, postal_code, product_id, category, sub_category, product_name,
         sales, quantity, discount, profit, sales AS revenue, cost,
         CAST(year(order_date) AS BIGINT) AS order_year,
         CAST(month(order_date) AS BIGINT) AS order_month,
         CAST(quarter(order_date) AS BIGINT) AS order_quarter,
         CAST(isodow(order_date) - 1 AS BIGINT) AS order_dayofweek,
         CAST(ship_date - order_date AS BIGINT) AS ship_days,
         CASE WHEN sales <> 0 THEN CAST(profit AS DOUBLE) / CAST(sales AS DOUBLE) ELSE 0 END
           AS profit_margin,
         CASE WHEN quantity <> 0 THEN CAST(profit AS DOUBLE) / quantity ELSE 0 END AS profit_per_unit,
         CAST(profit > 0 AS BIGINT) AS is_profitable,
         CASE WHEN (order_id * 31 + product_id * 17) % 100 < 45 THEN 'website'
              WHEN (order_id * 31 + product_id * 17) % 100 < 75 THEN 'mobile_app'
              ELSE 'store' END AS channel
  FROM profited)"""


def r(expression: str, name: str, places: int | None = None) -> str:
    """A double, rounded unless it is exact; adding 0.0 turns a negative zero into zero."""
    if places is None and name.strip('"') in EXACT:
        return f"CAST({expression} AS DOUBLE) + 0.0 AS {name}"
    return f"ROUND(CAST({expression} AS DOUBLE), {places or 6}) + 0.0 AS {name}"


def avg(column: str) -> str:
    return f"(CAST(SUM({column}) AS DOUBLE) / NULLIF(COUNT({column}), 0))"


def money(column: str) -> str:
    return f"CAST(ROUND(SUM({column}), 2) AS DOUBLE)"


def big(expression: str, name: str) -> str:
    return f"CAST({expression} AS BIGINT) AS {name}"


def over_lines(sql: str, *ctes: str) -> str:
    """SQL text behind the shared order-line prefix and any further CTEs."""
    return "WITH " + ",\n".join([LINES, *ctes]) + "\n" + sql


LINE_COLUMNS = (
    "row_id, order_id, order_date, ship_date, ship_mode, customer_id, customer_name, segment, city, "
    "state, region, postal_code, product_id, category, sub_category, product_name, channel, "
    "order_year, order_month, order_quarter, order_dayofweek, ship_days, is_profitable, "
    "CAST(quantity AS BIGINT) AS quantity, "
    + ", ".join(r(c, c) for c in ["sales", "discount", "profit", "revenue", "cost",
                                  "profit_margin", "profit_per_unit"])
)

FACT_MART_COLUMNS = (
    "order_id, order_date, order_year, order_month, order_quarter, customer_id, segment, product_id, "
    "category, sub_category, region, state, city, channel, ship_mode, ship_days, is_profitable, "
    "CAST(quantity AS BIGINT) AS quantity, "
    + ", ".join(r(c, c) for c in ["sales", "discount", "profit", "cost", "profit_margin",
                                  "profit_per_unit"])
)

GEO = """geography AS (
  SELECT row_number() OVER (ORDER BY city, state, region, postal_code) AS geo_key, *
  FROM (SELECT DISTINCT city, state, region, postal_code FROM lines))"""

FACT = """fact AS (
  SELECT row_id, order_id, order_date, ship_date, ship_mode, ship_days, customer_id, product_id,
         geo_key, channel, sales, quantity, discount, profit, profit_margin, cost, profit_per_unit,
         is_profitable
  FROM lines JOIN geography USING (city, state, region, postal_code))"""

CUSTOMERS = f"""customers AS (
  SELECT customer_id,
         CAST((SELECT MAX(order_date) FROM lines) - MAX(order_date) AS BIGINT) AS recency,
         COUNT(DISTINCT order_id) AS frequency,
         CAST(SUM(sales) AS DOUBLE) AS monetary,
         CAST(SUM(profit) AS DOUBLE) AS total_profit,
         {avg("discount")} AS avg_discount,
         {avg("profit_margin")} AS avg_margin,
         COUNT(DISTINCT category) AS num_categories,
         COUNT(DISTINCT channel) AS num_channels,
         CAST((SELECT MAX(order_date) FROM lines) - MAX(order_date) > 180 AS BIGINT) AS churned
  FROM lines GROUP BY customer_id)"""

# The deterministic score: half of it a keyed draw, so that curves have a real shape.
SCORED = """scored AS (
  SELECT customer_id, churned AS label,
         CAST(7 * ((customer_id * 7919) % 1000) + 3000 * churned AS DOUBLE) / 10000.0 AS score
  FROM customers)"""

PREDICTED = """predicted AS (
  SELECT *, CAST(score >= 0.5 AS BIGINT) AS prediction FROM scored)"""

THRESHOLDS = """counts AS (
  SELECT score AS threshold, SUM(label) AS pos, SUM(1 - label) AS neg FROM scored GROUP BY score),
running AS (
  SELECT *, SUM(pos) OVER w AS tp, SUM(neg) OVER w AS fp,
         SUM(pos) OVER () AS all_pos, SUM(neg) OVER () AS all_neg
  FROM counts WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""

MARKETING_BASE = f"""cust AS (
  SELECT customer_id, MIN(customer_name) AS customer_name, MIN(segment) AS segment,
         CAST((SELECT MAX(order_date) FROM lines) - MAX(order_date) AS BIGINT) AS recency,
         COUNT(DISTINCT order_id) AS frequency,
         CAST(SUM(profit) AS DOUBLE) AS monetary,
         {avg("discount")} AS avg_discount, {avg("profit_margin")} AS avg_margin,
         COUNT(DISTINCT channel) AS num_channels
  FROM lines GROUP BY customer_id),
limits AS (SELECT quantile_cont(monetary, 0.75) AS q75, quantile_cont(monetary, 0.5) AS q50 FROM cust),
labelled AS (
  SELECT cust.*, CASE WHEN recency > 180 THEN 0.8::DOUBLE ELSE 0.2::DOUBLE END AS churn_prob,
         CASE WHEN monetary > q75 THEN 'Champions' WHEN monetary > q50 THEN 'Loyal'
              WHEN recency > 180 THEN 'At Risk' ELSE 'Potential Loyalist' END AS segment_label
  FROM cust, limits),
marketing AS (
  SELECT *, CASE WHEN segment_label = 'Champions' THEN '{MARKETING["champions"]}'
                 WHEN segment_label = 'Loyal' THEN '{MARKETING["loyal"]}'
                 WHEN churn_prob > 0.7 THEN '{MARKETING["win_back"]}'
                 WHEN segment_label = 'At Risk' THEN '{MARKETING["at_risk"]}'
                 WHEN recency > 120 THEN '{MARKETING["dormant"]}'
                 ELSE '{MARKETING["standard"]}' END AS recommended_action,
         CASE WHEN churn_prob > 0.7 THEN 'HIGH' WHEN segment_label = 'Champions' THEN 'HIGH'
              WHEN churn_prob > 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS priority
  FROM labelled)"""

ELASTICITY = """months AS (
  SELECT sub_category, order_month, AVG(CAST(sales AS DOUBLE) / GREATEST(quantity, 1)) AS price,
         SUM(quantity) AS qty
  FROM lines GROUP BY ALL),
slopes AS (
  SELECT sub_category, regr_slope(ln(GREATEST(qty, 1)), ln(GREATEST(price, 0.01))) AS elasticity
  FROM months GROUP BY sub_category
  HAVING COUNT(*) >= 4 AND stddev_samp(ln(GREATEST(price, 0.01))) > 0.01)"""

PRICING_CTE = f"""products AS (
  SELECT sub_category, category, {avg("discount")} AS avg_discount,
         {avg("profit_margin")} AS avg_margin, CAST(SUM(profit) AS DOUBLE) AS total_profit,
         CAST(SUM(sales) AS DOUBLE) AS total_revenue, CAST(SUM(quantity) AS BIGINT) AS total_qty
  FROM lines GROUP BY sub_category, category),
pricing AS (
  SELECT p.*, s.elasticity,
         CASE WHEN avg_margin < 0 THEN '{PRICING["stop"]}'
              WHEN avg_discount > 0.25 AND avg_margin < 0.10 THEN '{PRICING["reduce"]}'
              WHEN elasticity < -1.5 AND avg_margin > 0.20 THEN '{PRICING["cut"]}'
              WHEN elasticity > -0.5 AND avg_margin > 0.15 THEN '{PRICING["raise"]}'
              ELSE '{PRICING["hold"]}' END AS pricing_action,
         CASE WHEN avg_margin < 0 THEN 'CRITICAL' WHEN avg_margin < 0.05 THEN 'HIGH'
              ELSE 'NORMAL' END AS urgency
  FROM products p LEFT JOIN slopes s USING (sub_category))"""

REORDER = f"""top_categories AS (
  SELECT sub_category FROM lines GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 8),
stocked AS (
  SELECT sub_category, {avg("quantity")} AS avg_monthly_demand,
         stddev_samp(quantity) AS std_demand,
         round_even(1.65 * stddev_samp(quantity), 0) AS safety_stock
  FROM lines WHERE sub_category IN (SELECT sub_category FROM top_categories) GROUP BY 1),
reorder AS (
  SELECT *, round_even(avg_monthly_demand + safety_stock, 0) AS reorder_point FROM stocked)"""

INVENTORY_CTE = f"""stock AS (
  SELECT sub_category, category, {avg("quantity")} AS monthly_avg_qty,
         stddev_samp(quantity) AS std_qty, CAST(SUM(quantity) AS BIGINT) AS total_qty,
         CAST(SUM(profit) AS DOUBLE) AS total_profit, {avg("profit_margin")} AS avg_margin
  FROM lines GROUP BY sub_category, category),
safe AS (SELECT *, round_even(1.65 * COALESCE(std_qty, 0), 0) AS safety_stock FROM stock),
inventory AS (
  SELECT safe.* , COALESCE(m.reorder_point, round_even(monthly_avg_qty + safe.safety_stock, 0))
           AS reorder_point,
         round_even(monthly_avg_qty * 12, 0) AS annual_demand,
         CASE WHEN avg_margin < 0 THEN '{INVENTORY["liquidate"]}'
              WHEN avg_margin > 0.25 THEN '{INVENTORY["increase"]}'
              WHEN total_qty < 50 THEN '{INVENTORY["low_volume"]}'
              ELSE '{INVENTORY["maintain"]}' END AS inventory_action
  FROM safe LEFT JOIN reorder m USING (sub_category))"""

MONTHLY = """monthly AS (
  SELECT order_year, order_month, order_year * 12 + order_month - 1 AS month_no,
         CAST(SUM(sales) AS DOUBLE) AS revenue, CAST(SUM(profit) AS DOUBLE) AS profit,
         SUM(quantity) AS quantity
  FROM lines GROUP BY order_year, order_month)"""

# Month ends: the calendar stops at the last order date.
MONTH_ENDS = """month_ends AS (
  SELECT DISTINCT CAST(year(d) AS BIGINT) AS order_year, CAST(month(d) AS BIGINT) AS order_month,
         LEAST(last_day(d), (SELECT MAX(order_date) FROM lines)) AS month_end
  FROM (SELECT unnest(generate_series((SELECT MIN(order_date) FROM lines)::TIMESTAMP,
               (SELECT MAX(order_date) FROM lines)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d)),
visits AS (SELECT DISTINCT customer_id, order_date FROM lines)"""

CLIPPED = """clipped AS (SELECT LEAST(GREATEST(profit_margin, -1), 1) AS margin FROM lines),
power_sums AS (
  SELECT COUNT(*) AS n, AVG(margin) AS mu FROM clipped),
centred AS (
  SELECT n, AVG((margin - mu) ** 2) AS m2, AVG((margin - mu) ** 3) AS m3, AVG((margin - mu) ** 4) AS m4
  FROM clipped, power_sums GROUP BY n),
moments AS (
  SELECT n, m3 / m2 ** 1.5 AS skewness, m4 / (m2 * m2) - 3 AS kurtosis FROM centred)"""


def anova_sql(group: str) -> str:
    """F with its tail probability in closed form, which exists for even degrees of freedom."""
    return over_lines(
        f"""SELECT groups, n, df_between, df_within, {r("ss_between", "ss_between")},
               {r("ss_within", "ss_within")}, {r("f", "f_statistic")}, {r("p", "p_value")},
               p < 0.05 AS significant
            FROM tail""",
        f"""grand AS (SELECT AVG(profit_margin) AS m FROM lines),
        grp AS (SELECT {group} AS g, COUNT(*) AS n, AVG(profit_margin) AS m,
                       var_pop(profit_margin) AS v FROM lines GROUP BY 1),
        parts AS (SELECT COUNT(*) AS groups, CAST(SUM(n) AS BIGINT) AS n,
                         SUM(n * (grp.m - grand.m) ** 2) AS ss_between, SUM(n * v) AS ss_within
                  FROM grp, grand),
        test AS (SELECT *, groups - 1 AS df_between, n - groups AS df_within,
                        (ss_between / (groups - 1)) / (ss_within / (n - groups)) AS f FROM parts),
        shares AS (SELECT *, df_between * f / (df_between * f + df_within) AS x FROM test),
        tail AS (SELECT *, (1 - x) ** (df_within / 2.0) *
                        CASE df_between WHEN 2 THEN 1 WHEN 4 THEN 1 + df_within / 2.0 * x END AS p
                 FROM shares)""",
    )


WELCH = """sides AS (
  SELECT COUNT(*) FILTER (discount = 0) AS n_1, COUNT(*) FILTER (discount > 0) AS n_2,
         AVG(profit_margin) FILTER (discount = 0) AS mean_1,
         AVG(profit_margin) FILTER (discount > 0) AS mean_2,
         var_samp(profit_margin) FILTER (discount = 0) AS v1,
         var_samp(profit_margin) FILTER (discount > 0) AS v2 FROM lines),
tested AS (
  SELECT n_1, n_2, mean_1, mean_2, (mean_1 - mean_2) / sqrt(a + b) AS t,
         (a + b) ** 2 / (a * a / (n_1 - 1) + b * b / (n_2 - 1)) AS df
  FROM (SELECT *, v1 / n_1 AS a, v2 / n_2 AS b FROM sides))"""


def quantile_bins(value: str, source: str, q: int = 10) -> str:
    """CTE text: quantile edges without repeats and the right-closed bin of every row."""
    levels = ", ".join(str(i / q) for i in range(q + 1))
    return f"""edges AS (SELECT DISTINCT unnest(quantile_cont({value}, [{levels}])) AS edge FROM {source}),
    binned AS (
      SELECT s.*, GREATEST((SELECT COUNT(*) FROM edges WHERE edge < s.{value}) - 1, 0) AS bin
      FROM {source} s)"""


def box_sql(group: str) -> str:
    return f"""SELECT '{group}' AS dim, l.{group} AS value, {r("q1", "q1")}, {r("med", "median")},
                      {r("q3", "q3")},
                      {r("MIN(CASE WHEN inside THEN profit_margin END)", "whisker_low")},
                      {r("MAX(CASE WHEN inside THEN profit_margin END)", "whisker_high")},
                      {big("COUNT(*) FILTER (NOT inside)", "outliers")}
               FROM (SELECT l.*, q1, med, q3, profit_margin BETWEEN q1 - 1.5 * (q3 - q1)
                            AND q3 + 1.5 * (q3 - q1) AS inside
                     FROM lines l JOIN (
                       SELECT {group}, quantile_cont(profit_margin, 0.25) AS q1,
                              quantile_cont(profit_margin, 0.5) AS med,
                              quantile_cont(profit_margin, 0.75) AS q3
                       FROM lines GROUP BY 1) q USING ({group})) l
               GROUP BY l.{group}, q1, med, q3"""


def draw(key: str) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


DIRTY = f"""{FIRST_LINES},
keyed AS (
  SELECT *, l_orderkey + l_partkey AS key FROM first_lines),
dirty AS (
  SELECT l_orderkey || '-' || l_partkey AS row_id,
         CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_partkey AS VARCHAR) AS product_id,
         CASE WHEN key % 5 <> 2 THEN CAST(l_shipdate AS DATE) END AS order_date,
         CASE key % 7 WHEN 0 THEN 1 WHEN 1 THEN 0.5 WHEN 2 THEN 3000000000 WHEN 3 THEN -4
              ELSE CAST(l_quantity AS INT) END AS quantity,
         CASE key % 11 WHEN 0 THEN 0.3001 WHEN 1 THEN 0.305 WHEN 2 THEN 1 WHEN 3 THEN 0
              ELSE CAST(l_discount AS DECIMAL(4,2)) END AS discount,
         CASE key % 13 WHEN 0 THEN 1e15::DOUBLE WHEN 1 THEN 0::DOUBLE
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) END AS sales,
         CASE key % 19 WHEN 0 THEN 0.00004 WHEN 1 THEN -5 ELSE 10 END AS profit,
         CAST(key % 19 <> 1 AS BIGINT) AS is_profitable,
         'C' || (key % 3) AS country
  FROM keyed WHERE key % 7 <> 3)"""

RETURNS = """returns AS (
  SELECT order_id, product_id, CAST(0.3::DOUBLE * CAST(discount > 0.3 AS INT)
         + 0.2::DOUBLE * CAST(profit_margin < -0.1::DOUBLE AS INT)
         + 0.1::DOUBLE * (((order_id * 7919 + product_id * 104729) % 1000) / 1000.0::DOUBLE)
         > 0.35::DOUBLE AS BIGINT) AS returned FROM lines)"""

SIMILAR = """bought AS (
  SELECT customer_id, sub_category, CAST(SUM(sales) AS DOUBLE) AS amount
  FROM lines GROUP BY 1, 2),
norms AS (SELECT customer_id, sqrt(SUM(amount * amount)) AS norm FROM bought GROUP BY 1),
unit AS (SELECT customer_id, sub_category, amount / norm AS x FROM bought JOIN norms USING (customer_id)),
pairs AS (
  SELECT a.customer_id AS customer_id, b.customer_id AS neighbour_id, ROUND(SUM(a.x * b.x), 9) AS similarity
  FROM unit a JOIN unit b USING (sub_category)
  WHERE a.customer_id <> b.customer_id GROUP BY 1, 2),
near AS (
  SELECT *, row_number() OVER (
    PARTITION BY customer_id ORDER BY similarity DESC, neighbour_id) AS rank
  FROM pairs QUALIFY rank <= 10)"""


ERRORS = """errors AS (
  SELECT revenue, revenue - lag1 AS e
  FROM (SELECT revenue, lag(revenue, 1) OVER w AS lag1, lag(revenue, 3) OVER w AS lag3
        FROM monthly WINDOW w AS (ORDER BY month_no)) WHERE lag3 IS NOT NULL)"""

INVENTORY_COLUMNS = "sub_category, category, total_qty, inventory_action, " + ", ".join(
    r(c, c)
    for c in ["monthly_avg_qty", "std_qty", "total_profit", "avg_margin", "safety_stock",
              "reorder_point", "annual_demand"]
)


def core_sql(keys: str) -> str:
    return over_lines(
        f"""SELECT {keys}, {r("rev", "total_revenue")}, {r("pro", "total_profit")},
                   orders AS total_orders,
                   {r("COALESCE(pro / NULLIF(rev, 0), 0) * 100", "margin_pct")},
                   {r("COALESCE(rev / NULLIF(orders, 0), 0)", "avg_order_value")},
                   {r("COALESCE(rev / NULLIF(customers, 0), 0)", "revenue_per_customer")}
            FROM (SELECT {keys}, CAST(SUM(sales) AS DOUBLE) AS rev, CAST(SUM(profit) AS DOUBLE) AS pro,
                         COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers
                  FROM lines GROUP BY {keys})"""
    )


ORACLES: dict[str, str] = {
    # Raw text may hold fractions, so quantities of raw lines are not integers.
    "csv_ingest": over_lines(
        "SELECT "
        + LINE_COLUMNS.replace("CAST(quantity AS BIGINT)", "CAST(quantity AS DOUBLE)").replace(
            "customer_name", "CASE WHEN order_id % 9 = 0 THEN customer_name || 'é' ELSE customer_name END AS customer_name"
        )
        + " FROM lines"
    ),
    "csv_roundtrip": over_lines(f"SELECT {FACT_MART_COLUMNS} FROM lines"),
    "clean_lines": over_lines(f"SELECT {LINE_COLUMNS} FROM lines"),
    "mart_fact": over_lines(f"SELECT {FACT_MART_COLUMNS} FROM lines"),
    "profile_nulls": over_lines(
        """SELECT name AS column_name, (SELECT COUNT(*) FROM lines) AS row_count,
                  CAST(0 AS BIGINT) AS null_count
           FROM (SELECT unnest([{names}]) AS name)
           WHERE (SELECT COUNT(*) FROM lines WHERE COLUMNS(*) IS NULL) = 0""".replace(
            "{names}",
            ", ".join(f"'{name}'" for name in CLEAN_COLUMNS),
        ).replace("COLUMNS(*) IS NULL", " OR ".join(f"{c} IS NULL" for c in CLEAN_COLUMNS))
    ),
    "coerce_numeric": f"""
        WITH {FIRST_LINES},
        dirty AS (
          SELECT l_orderkey AS order_id, l_partkey AS product_id,
                 CASE WHEN (l_orderkey + l_partkey) % 7 = 0 THEN 'n/a'
                      ELSE CAST(CAST(l_quantity AS INT) AS VARCHAR) END AS quantity,
                 CASE WHEN (l_orderkey + l_partkey) % 11 = 0 THEN ''
                      ELSE ' ' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS sales,
                 CASE WHEN (l_orderkey + l_partkey) % 13 = 0 THEN NULL
                      ELSE CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) END AS discount
          FROM first_lines)
        SELECT order_id, product_id,
               {r("COALESCE(TRY_CAST(trim(quantity) AS DECIMAL(18,4)), 1)", "quantity")},
               {r("COALESCE(TRY_CAST(trim(sales) AS DECIMAL(18,4)), 0)", "sales")},
               {r("COALESCE(TRY_CAST(trim(discount) AS DECIMAL(18,4)), 0)", "discount")}
        FROM dirty""",
    "assign_channel": over_lines("SELECT row_id, channel FROM lines"),
    "dedup_keep_first": f"""
        WITH {FIRST_LINES}
        SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey,
               {r("l_extendedprice", "l_extendedprice")}
        FROM first_lines""",
    "validate_rules": over_lines(
        """SELECT 'sales_not_negative' AS rule, COUNT(*) FILTER (sales < 0) AS violations FROM lines
           UNION ALL SELECT 'discount_in_range', COUNT(*) FILTER (discount IS NULL OR discount < 0 OR discount > 1) FROM lines
           UNION ALL SELECT 'quantity_positive', COUNT(*) FILTER (quantity <= 0) FROM lines
           UNION ALL SELECT 'order_date_present', COUNT(*) FILTER (order_date IS NULL) FROM lines
           UNION ALL SELECT 'row_id_unique', COUNT(*) FROM (SELECT 1 FROM lines GROUP BY row_id HAVING COUNT(*) > 1)
           UNION ALL SELECT 'fact_line_unique', COUNT(*) FROM (SELECT 1 FROM lines GROUP BY order_id, product_id HAVING COUNT(*) > 1)
           UNION ALL SELECT 'customer_id_unique', COUNT(*) FROM (SELECT c_custkey FROM customer GROUP BY 1 HAVING COUNT(*) > 1)
           UNION ALL SELECT 'product_id_unique', COUNT(*) FROM (SELECT p_partkey FROM part GROUP BY 1 HAVING COUNT(*) > 1)
           UNION ALL SELECT 'fact_customer_known', COUNT(*) FROM lines WHERE customer_id NOT IN (SELECT c_custkey FROM customer)
           UNION ALL SELECT 'fact_product_known', COUNT(*) FROM lines WHERE product_id NOT IN (SELECT p_partkey FROM part)"""
    ),
    "encode_ordinal": over_lines(
        """SELECT category, sub_category, channel, segment, c AS category_enc, s AS sub_category_enc,
                  h AS channel_enc, g AS segment_enc, COUNT(*) AS lines
           FROM lines
           JOIN (SELECT category, dense_rank() OVER (ORDER BY category) - 1 AS c FROM (SELECT DISTINCT category FROM lines)) USING (category)
           JOIN (SELECT sub_category, dense_rank() OVER (ORDER BY sub_category) - 1 AS s FROM (SELECT DISTINCT sub_category FROM lines)) USING (sub_category)
           JOIN (SELECT channel, dense_rank() OVER (ORDER BY channel) - 1 AS h FROM (SELECT DISTINCT channel FROM lines)) USING (channel)
           JOIN (SELECT segment, dense_rank() OVER (ORDER BY segment) - 1 AS g FROM (SELECT DISTINCT segment FROM lines)) USING (segment)
           GROUP BY ALL"""
    ),
    "join_semi_top_categories": over_lines(
        """SELECT row_id, sub_category FROM lines WHERE sub_category IN (
             SELECT sub_category FROM lines GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 8)"""
    ),
    "join_anti_unbought": over_lines(
        """SELECT customer_id, sub_category
           FROM (SELECT DISTINCT customer_id FROM lines), (SELECT DISTINCT sub_category FROM lines)
           EXCEPT SELECT customer_id, sub_category FROM lines"""
    ),
    "join_nullsafe_geo": over_lines(
        """SELECT state, CAST(COUNT(*) AS BIGINT) AS places, CAST(SUM(n) AS BIGINT) AS lines
           FROM (SELECT state, CASE WHEN customer_id % 3 <> 0 THEN postal_code END AS p,
                        CASE WHEN customer_id % 5 <> 0 THEN city END AS c, region, COUNT(*) AS n
                 FROM lines GROUP BY ALL) GROUP BY state"""
    ),
    "join_override": over_lines(
        f"SELECT sub_category, total_qty, {r('reorder_point', 'reorder_point')} FROM inventory",
        REORDER, INVENTORY_CTE,
    ),
    "star_dim_customer": over_lines("SELECT DISTINCT customer_id, customer_name, segment FROM lines"),
    "star_dim_product": over_lines(
        "SELECT DISTINCT product_id, product_name, category, sub_category FROM lines"
    ),
    "star_dim_geography": over_lines("SELECT geo_key, city, state, region, postal_code FROM geography", GEO),
    "star_dim_date": over_lines(
        """SELECT DISTINCT order_date AS date_key, order_year AS year, order_quarter AS quarter,
                  order_month AS month, CAST(day(order_date) AS BIGINT) AS day,
                  order_dayofweek AS dayofweek, CAST(order_dayofweek >= 5 AS BIGINT) AS is_weekend
           FROM lines"""
    ),
    "star_fact": over_lines(
        "SELECT row_id, order_id, order_date, ship_date, ship_mode, ship_days, customer_id, product_id, "
        "geo_key, channel, is_profitable, CAST(quantity AS BIGINT) AS quantity, "
        + ", ".join(r(c, c) for c in ["sales", "discount", "profit", "profit_margin", "cost",
                                      "profit_per_unit"])
        + " FROM fact",
        GEO, FACT,
    ),
    "star_sink": over_lines(
        f"""SELECT order_year, COUNT(*) AS "rows", {r("SUM(sales)", "sales")}
            FROM lines GROUP BY order_year"""
    ),
    "dim_calendar": over_lines(
        """SELECT d AS "Date", CAST(year(d) AS BIGINT) AS "Year", CAST(quarter(d) AS BIGINT) AS "Quarter",
                  CAST(month(d) AS BIGINT) AS "Month", strftime(d, '%b') AS "MonthName",
                  CAST(weekofyear(d) AS BIGINT) AS "WeekNum", CAST(isodow(d) - 1 AS BIGINT) AS "DayOfWeek",
                  strftime(d, '%A') AS "DayName", CAST(isodow(d) > 5 AS BIGINT) AS "IsWeekend",
                  year(d) || ' Q' || quarter(d) AS "QuarterLabel"
           FROM (SELECT unnest(generate_series((SELECT MIN(order_date) FROM lines)::TIMESTAMP,
                        (SELECT MAX(order_date) FROM lines)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d)"""
    ),
    "wh_profit_by_channel": over_lines(
        f"""SELECT channel, COUNT(*) AS orders, {money("sales")} AS total_revenue,
                   {money("profit")} AS total_profit,
                   {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)}
            FROM lines GROUP BY channel"""
    ),
    "wh_rfm_scores": over_lines(
        """SELECT * EXCLUDE (m), m AS monetary, r_score + f_score + m_score AS rfm_total,
                  CASE WHEN r_score >= 4 AND f_score >= 4 THEN 'Champions'
                       WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal'
                       WHEN r_score >= 3 AND f_score <= 2 THEN 'Potential Loyalist'
                       WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
                       ELSE 'Need Attention' END AS rfm_segment
           FROM tiles ORDER BY rfm_total DESC, customer_id LIMIT 20""",
        f"""rfm AS (
          SELECT customer_id, MIN(segment) AS segment,
                 CAST((SELECT MAX(order_date) FROM lines) - MAX(order_date) AS BIGINT) AS recency_days,
                 COUNT(DISTINCT order_id) AS frequency, {money("sales")} AS m
          FROM lines GROUP BY customer_id),
        tiles AS (
          SELECT *, ntile(5) OVER (ORDER BY recency_days DESC, customer_id) AS r_score,
                 ntile(5) OVER (ORDER BY frequency, customer_id) AS f_score,
                 ntile(5) OVER (ORDER BY m, customer_id) AS m_score FROM rfm)""",
    ),
    "wh_profit_by_category": over_lines(
        f"""SELECT category, sub_category, COUNT(*) AS line_items, {money("sales")} AS revenue,
                   {money("profit")} AS profit, {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)},
                   {r(avg("discount") + " * 100", "avg_discount_pct", 2)},
                   {big("SUM(is_profitable)", "profitable_orders")}
            FROM lines GROUP BY category, sub_category"""
    ),
    "wh_discount_impact": over_lines(
        f"""SELECT CASE WHEN discount = 0 THEN '0%  No discount' WHEN discount <= 0.10 THEN '1–10%'
                        WHEN discount <= 0.20 THEN '11–20%' WHEN discount <= 0.30 THEN '21–30%'
                        ELSE '> 30%' END AS discount_band, COUNT(*) AS orders,
                   {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)},
                   {money("profit")} AS total_profit, {money("sales")} AS total_revenue
            FROM lines GROUP BY 1"""
    ),
    "wh_monthly_trend": over_lines(
        f"""SELECT order_year AS year, order_month AS month, order_quarter AS quarter,
                   {money("sales")} AS revenue, {money("profit")} AS profit,
                   {r(avg("profit_margin") + " * 100", "margin_pct", 2)}
            FROM lines GROUP BY 1, 2, 3"""
    ),
    "wh_top_products": over_lines(
        f"""SELECT product_name, category, sub_category, {money("sales")} AS total_revenue,
                   {money("profit")} AS total_profit,
                   {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)}, COUNT(*) AS times_sold
            FROM lines GROUP BY product_id, product_name, category, sub_category
            ORDER BY total_profit DESC, product_id LIMIT 15"""
    ),
    "wh_loss_products": over_lines(
        f"""SELECT product_name, category, {money("profit")} AS total_profit,
                   {r(avg("discount") + " * 100", "avg_discount_pct", 2)}, COUNT(*) AS times_sold
            FROM lines GROUP BY product_id, product_name, category
            HAVING ROUND(SUM(profit), 2) < 0 ORDER BY total_profit, product_id LIMIT 15"""
    ),
    "wh_customer_clv": over_lines(
        f"""SELECT customer_id, customer_name, segment, COUNT(DISTINCT order_id) AS total_orders,
                   {money("sales")} AS total_revenue, {money("profit")} AS total_profit,
                   {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)},
                   MIN(order_date) AS first_order, MAX(order_date) AS last_order
            FROM lines GROUP BY customer_id, customer_name, segment
            ORDER BY total_profit DESC, customer_id LIMIT 20"""
    ),
    "wh_region_channel": over_lines(
        f"""SELECT region, channel, {money("sales")} AS revenue, {money("profit")} AS profit,
                   COUNT(DISTINCT order_id) AS orders FROM lines GROUP BY region, channel"""
    ),
    "wh_shipping": over_lines(
        f"""SELECT ship_mode, {r(avg("ship_days"), "avg_ship_days", 1)}, COUNT(*) AS orders,
                   {money("profit")} AS total_profit,
                   {r(avg("profit_margin") + " * 100", "avg_margin_pct", 2)}
            FROM lines GROUP BY ship_mode"""
    ),
    "summary_totals": over_lines(
        f"""SELECT {r("SUM(sales)", "total_revenue")}, {r("SUM(profit)", "total_profit")},
                   {r(avg("profit_margin"), "avg_margin")},
                   COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT product_id) AS products,
                   MIN(order_date) AS first_date, MAX(order_date) AS last_date FROM lines"""
    ),
    "summary_by_dim": over_lines(
        f"""SELECT 'channel' AS dim, channel AS value, {money("sales")} AS sales,
                   {money("profit")} AS profit, CAST(NULL AS DOUBLE) AS profit_margin
            FROM lines GROUP BY channel
            UNION ALL SELECT 'segment', segment, {money("sales")}, {money("profit")}, NULL
            FROM lines GROUP BY segment
            UNION ALL SELECT 'category', category, ROUND({avg("sales")}, 4), ROUND({avg("profit")}, 4),
                             ROUND({avg("profit_margin")}, 4)
            FROM lines GROUP BY category"""
    ),
    "monthly_series": over_lines(
        f"""SELECT order_year, order_month, month_no, {r("revenue", "revenue")}, {r("profit", "profit")},
                   {big("quantity", "quantity")}, make_date(order_year, order_month, 1) AS period
            FROM monthly""", MONTHLY,
    ),
    "customer_features": over_lines(
        f"""SELECT customer_id, recency, frequency, num_categories, num_channels, churned,
                   {r("monetary", "monetary")}, {r("total_profit", "total_profit")},
                   {r("avg_discount", "avg_discount")}, {r("avg_margin", "avg_margin")}
            FROM customers""", CUSTOMERS,
    ),
    "mart_customer": over_lines(
        f"""SELECT l.customer_id, MIN(l.customer_name) AS customer_name, MIN(l.segment) AS segment,
                   MIN(region) AS region, COUNT(DISTINCT order_id) AS total_orders,
                   {r("SUM(sales)", "total_revenue")}, {r("SUM(profit)", "total_profit")},
                   {r(avg("discount"), "avg_discount")}, {r(avg("profit_margin"), "avg_margin")},
                   MIN(order_date) AS first_order, MAX(order_date) AS last_order,
                   COUNT(DISTINCT category) AS num_categories, COUNT(DISTINCT channel) AS num_channels,
                   MIN(m.recency) AS recency, MIN(m.frequency) AS frequency,
                   {r("MIN(m.monetary)", "monetary")}, MIN(m.segment_label) AS segment_label
            FROM lines l JOIN marketing m ON l.customer_id = m.customer_id
            GROUP BY l.customer_id""", MARKETING_BASE,
    ),
    "mart_product": over_lines(
        f"""SELECT product_id, product_name, category, sub_category, {r("revenue", "total_revenue")},
                   {r("profit", "total_profit")}, total_qty, {r("margin", "avg_margin")},
                   {r("discount", "avg_discount")}, times_sold,
                   CAST(floor(rank() OVER (ORDER BY profit DESC)
                        + (COUNT(*) OVER (PARTITION BY profit) - 1) / 2.0) AS BIGINT) AS profit_rank,
                   {r("elasticity", "elasticity")}
            FROM prod LEFT JOIN slopes USING (sub_category)""",
        f"""prod AS (
          SELECT product_id, product_name, category, sub_category, SUM(sales) AS revenue,
                 SUM(profit) AS profit, CAST(SUM(quantity) AS BIGINT) AS total_qty,
                 {avg("profit_margin")} AS margin, {avg("discount")} AS discount, COUNT(*) AS times_sold
          FROM lines GROUP BY 1, 2, 3, 4)""",
        ELASTICITY,
    ),
    "mart_monthly_kpi": over_lines(
        f"""SELECT order_year, order_month, channel, category, {r("SUM(sales)", "revenue")},
                   {r("SUM(profit)", "profit")}, COUNT(DISTINCT order_id) AS orders,
                   {big("SUM(quantity)", "qty")}
            FROM lines GROUP BY 1, 2, 3, 4"""
    ),
    "exec_snapshot": over_lines(
        f"""SELECT COUNT(*) AS transactions, MIN(order_date) AS first_date, MAX(order_date) AS last_date,
                   {r("SUM(sales)", "total_revenue")}, {r("SUM(profit)", "total_profit")},
                   {r(avg("profit_margin"), "avg_margin")}, COUNT(DISTINCT order_id) AS total_orders,
                   COUNT(DISTINCT customer_id) AS total_customers,
                   {r("ABS(SUM(profit) FILTER (profit < 0))", "recoverable")},
                   {r("ABS(LEAST(SUM(profit) FILTER (discount > 0.30), 0))", "over_discount_drain")},
                   {r("ABS(SUM(profit) FILTER (profit < 0)) + ABS(LEAST(SUM(profit) FILTER (discount > 0.30), 0))", "combined_recovery")},
                   {r("ABS(LEAST(SUM(profit) FILTER (profit < 0 OR discount > 0.30), 0))", "distinct_recovery")}
            FROM lines"""
    ),
    "pivot_purchases": over_lines(
        "SELECT customer_id, "
        + ", ".join(
            r(f"COALESCE(SUM(sales) FILTER (sub_category = 'Brand#{k}'), 0)", f"brand_{k}")
            for k in range(1, 26)
        )
        + " FROM lines GROUP BY customer_id"
    ),
    "value_counts": over_lines(
        """SELECT 'channel' AS dim, channel AS value, COUNT(*) AS "count" FROM lines GROUP BY channel
           UNION ALL SELECT 'sub_category', sub_category, COUNT(*) FROM lines GROUP BY sub_category"""
    ),
    "lag_features_revenue": over_lines(
        f"""SELECT period, month_no, month_num, {r("revenue", "revenue", 4)}, {r("lag1", "lag1", 4)},
                   {r("lag3", "lag3", 4)}, {r("lag12", "lag12", 4)}
            FROM (SELECT make_date(order_year, order_month, 1) AS period, month_no,
                         order_month AS month_num, revenue, lag(revenue, 1) OVER w AS lag1,
                         lag(revenue, 3) OVER w AS lag3, lag(revenue, 12) OVER w AS lag12
                  FROM monthly WINDOW w AS (ORDER BY month_no))
            WHERE lag12 IS NOT NULL""", MONTHLY,
    ),
    "lag_features_demand": over_lines(
        f"""SELECT sub_category, month_no, month_num, quantity, lag1, lag2, lag3,
                   {r("rm", "rolling_mean3")}
            FROM (SELECT sub_category, order_year * 12 + order_month - 1 AS month_no,
                         order_month AS month_num, quantity, lag(quantity, 1) OVER w AS lag1,
                         lag(quantity, 2) OVER w AS lag2, lag(quantity, 3) OVER w AS lag3,
                         AVG(quantity) OVER (PARTITION BY sub_category ORDER BY order_year, order_month
                                             ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rm
                  FROM (SELECT sub_category, order_year, order_month,
                               CAST(SUM(quantity) AS BIGINT) AS quantity
                        FROM lines GROUP BY 1, 2, 3)
                  WINDOW w AS (PARTITION BY sub_category ORDER BY order_year, order_month))
            WHERE lag3 IS NOT NULL"""
    ),
    "lag_features_residual": over_lines(
        f"""SELECT period, month_no, month_num, {r("revenue", "revenue", 4)}, {r("lag1", "lag1", 4)},
                   {r("lag3", "lag3", 4)}
            FROM (SELECT make_date(order_year, order_month, 1) AS period, month_no,
                         order_month AS month_num, revenue, lag(revenue, 1) OVER w AS lag1,
                         lag(revenue, 3) OVER w AS lag3
                  FROM monthly WINDOW w AS (ORDER BY month_no))
            WHERE lag3 IS NOT NULL""", MONTHLY,
    ),
    "quantile_cut": over_lines(
        f"SELECT customer_id, label, {r('score', 'score')}, bin FROM binned",
        CUSTOMERS, SCORED, quantile_bins("score", "scored"),
    ),
    "segment_fallback": over_lines(
        f"SELECT customer_id, segment_label, {r('churn_prob', 'churn_prob')} FROM labelled",
        MARKETING_BASE,
    ),
    "top_volume": over_lines(
        f"SELECT {INVENTORY_COLUMNS} FROM inventory ORDER BY total_qty DESC, sub_category LIMIT 12",
        REORDER, INVENTORY_CTE,
    ),
    "alerts_top10": over_lines(
        """SELECT * FROM (SELECT 'marketing' AS report, CAST(customer_id AS VARCHAR) AS subject,
                  priority AS level, recommended_action AS action FROM marketing
                  WHERE priority = 'HIGH' ORDER BY monetary DESC, customer_id LIMIT 10)
           UNION ALL SELECT * FROM (SELECT 'pricing', sub_category, urgency, pricing_action FROM pricing
                  WHERE urgency IN ('CRITICAL', 'HIGH')
                  ORDER BY urgency, total_profit, sub_category LIMIT 10)
           UNION ALL SELECT * FROM (SELECT 'inventory', sub_category, NULL, inventory_action
                  FROM inventory ORDER BY total_profit, sub_category LIMIT 10)""",
        MARKETING_BASE, ELASTICITY, PRICING_CTE, REORDER, INVENTORY_CTE,
    ),
    "corr_matrix": over_lines(
        " UNION ALL ".join(
            f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
            f"{r(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 'corr')} FROM lines"
            for a in NUMERIC
            for b in NUMERIC
        )
    ),
    "profit_drivers": over_lines(
        " UNION ALL ".join(
            f"SELECT '{a}' AS driver, "
            f"{r(f'corr(CAST({a} AS DOUBLE), CAST(profit AS DOUBLE))', 'corr')} FROM lines"
            for a in NUMERIC
            if a != "profit"
        )
    ),
    "anova_channel": anova_sql("channel"),
    "anova_segment": anova_sql("segment"),
    "margin_by_segment": over_lines(
        f"SELECT segment, {r(avg('profit_margin'), 'avg_margin')} FROM lines GROUP BY segment"
    ),
    "welch_discount": over_lines(
        f"""SELECT n_1, n_2, {r("mean_1", "mean_1")}, {r("mean_2", "mean_2")}, {r("t", "t_statistic")},
                   {r("df", "df")} FROM tested""", WELCH,
    ),
    "welch_discount_test": over_lines(
        f"""SELECT n_1, n_2, {r("mean_1", "mean_1")}, {r("mean_2", "mean_2")}, {r("t", "t_statistic")},
                   {r("df", "df")}, {r("p", "p_value")}, p < 0.05 AS significant
            FROM tail""",
        WELCH,
        # Simpson's rule for the density between 0 and |t|; beyond 60 nothing is left.
        """steps AS (SELECT *, LEAST(abs(t), 60) / 20000 AS h FROM tested),
        areas AS (
          SELECT SUM(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
                     * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi())
                           - (df + 1) / 2 * ln(1 + (i * h) ** 2 / df)) * h / 3) AS inside
          FROM steps, range(0, 20001) AS points(i)),
        tail AS (SELECT steps.*, GREATEST(1 - 2 * inside, 0) AS p FROM steps, areas)""",
    ),
    "discount_bins": over_lines(
        f"""SELECT disc_band, band_order, {r(avg("profit_margin") + " * 100", "avg_margin_pct")}
            FROM (SELECT profit_margin,
                         CASE WHEN discount <= 0.001 THEN '0%' WHEN discount <= 0.1 THEN '1–10%'
                              WHEN discount <= 0.2 THEN '11–20%' WHEN discount <= 0.3 THEN '21–30%'
                              ELSE '>30%' END AS disc_band,
                         CAST(CASE WHEN discount <= 0.001 THEN 1 WHEN discount <= 0.1 THEN 2
                              WHEN discount <= 0.2 THEN 3 WHEN discount <= 0.3 THEN 4 ELSE 5 END AS BIGINT)
                           AS band_order
                  FROM lines WHERE discount > -0.001 AND discount <= 1)
            GROUP BY 1, 2"""
    ),
    "margin_moments": over_lines(
        f"SELECT n, {r('skewness', 'skewness')}, {r('kurtosis', 'kurtosis')} FROM moments", CLIPPED
    ),
    "margin_normality": over_lines(
        f"""SELECT n, {r("skewness", "skewness", 5)}, {r("kurtosis", "kurtosis", 5)},
                   {r("z1", "z_skewness", 5)}, {r("z2", "z_kurtosis", 5)},
                   {r("z1 * z1 + z2 * z2", "k2", 5)},
                   {r("exp(-(z1 * z1 + z2 * z2) / 2)", "p_value", 5)},
                   exp(-(z1 * z1 + z2 * z2) / 2) >= 0.05 AS normal
            FROM z""",
        CLIPPED,
        """terms AS (
          SELECT *, skewness / sqrt(6.0 * (n - 2) / ((n + 1.0) * (n + 3))) AS y,
                 3.0 * (n * n + 27 * n - 70) / ((n - 2.0) * (n + 5)) * (n + 1) / (n + 7) * (n + 3) / (n + 9) AS beta2,
                 (kurtosis + 3 - 3.0 * (n - 1) / (n + 1))
                   / sqrt(24.0 * n / (n + 1) * (n - 2) / (n + 1) * (n - 3) / (n + 3) / (n + 5)) AS x,
                 6.0 * (n * n - 5 * n + 2) / ((n + 7.0) * (n + 9))
                   * sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2.0) * (n - 3))) AS b1
          FROM moments),
        shape AS (
          SELECT *, sqrt(2 * (beta2 - 1)) - 1 AS w2,
                 6 + 8 / b1 * (2 / b1 + sqrt(1 + 4 / (b1 * b1))) AS a FROM terms),
        z AS (
          SELECT n, skewness, kurtosis,
                 asinh(y / sqrt(2 / (w2 - 1))) / sqrt(0.5 * ln(w2)) AS z1,
                 (1 - 2 / (9 * a) - cbrt((1 - 2 / a) / (1 + x * sqrt(2 / (a - 4))))) / sqrt(2 / (9 * a)) AS z2
          FROM shape)""",
    ),
    "margin_histogram": over_lines(
        f"""SELECT bin, {r("lo + bin * (hi - lo) / 60", "lower")},
                   {r("lo + (bin + 1) * (hi - lo) / 60", "upper")}, COUNT(*) AS "count",
                   {r("MIN(mu)", "mean_margin")}, {r("MIN(med)", "median_margin")}
            FROM (SELECT lo, hi, mu, med,
                         CAST(LEAST(floor((margin - lo) / (hi - lo) * 60), 59) AS BIGINT) AS bin
                  FROM clipped, (SELECT MIN(margin) AS lo, MAX(margin) AS hi, AVG(margin) AS mu,
                                        quantile_cont(margin, 0.5) AS med FROM clipped))
            GROUP BY bin, lo, hi""", CLIPPED,
    ),
    "margin_boxplot": over_lines(f"{box_sql('channel')} UNION ALL {box_sql('category')}"),
    "rfm_base": over_lines(
        f"""SELECT customer_id, recency, frequency, {r("total_profit", "monetary")} FROM customers""",
        CUSTOMERS,
    ),
    "revenue_forecast_12m": over_lines(
        f"""SELECT make_date(m // 12, m % 12 + 1, 1) AS period, {r("b + a * m", "trend", 2)},
                   {r("COALESCE(s, 1)", "season", 2)}, {r("(b + a * m) * COALESCE(s, 1)", "forecast", 2)}
            FROM (SELECT a, b, unnest(range(last + 1, last + 13)) AS m FROM fit) f
            LEFT JOIN season ON m % 12 + 1 = season.order_month""",
        MONTHLY,
        """fit AS (SELECT regr_slope(revenue, month_no) AS a, regr_intercept(revenue, month_no) AS b,
                          MAX(month_no) AS last FROM monthly),
        season AS (SELECT order_month, AVG(revenue / (b + a * month_no)) AS s FROM monthly, fit
                   GROUP BY order_month)""",
    ),
    "stratified_split": over_lines(
        """SELECT customer_id, churned,
                  CAST(row_number() OVER w <= ROUND(COUNT(*) OVER (PARTITION BY churned) * 0.2) AS BIGINT) AS is_test
           FROM customers WINDOW w AS (PARTITION BY churned ORDER BY """
        + draw("customer_id") + ", customer_id)",
        CUSTOMERS,
    ),
    "cv_folds": over_lines(
        """SELECT customer_id, churned,
                  (row_number() OVER (PARTITION BY churned ORDER BY """
        + draw("customer_id") + ", customer_id) - 1) % 5 AS fold FROM customers",
        CUSTOMERS,
    ),
    "return_label": over_lines(
        """SELECT row_id, CAST(0.3::DOUBLE * CAST(discount > 0.3 AS INT)
                  + 0.2::DOUBLE * CAST(profit_margin < -0.1::DOUBLE AS INT)
                  + 0.1::DOUBLE * (((order_id * 7919 + product_id * 104729) % 1000) / 1000.0::DOUBLE)
                  > 0.35::DOUBLE AS BIGINT) AS returned FROM lines"""
    ),
    "elasticity_overall": over_lines(
        f"""SELECT {r("regr_slope(ln(GREATEST(q, 1)), ln(GREATEST(p, 0.01)))", "elasticity")}
            FROM (SELECT AVG(CAST(sales AS DOUBLE) / GREATEST(quantity, 1)) AS p, SUM(quantity) AS q
                  FROM lines GROUP BY sub_category)"""
    ),
    "elasticity_by_subcategory": over_lines(
        f"SELECT sub_category, {r('elasticity', 'elasticity')} FROM slopes", ELASTICITY
    ),
    "hash_split": over_lines(
        """SELECT sub_category, month_no, quantity, CAST("""
        + draw("sub_category || '|' || month_no")
        + """ % 1000 < 200 AS BIGINT) AS is_test
           FROM (SELECT *, lag(quantity, 3) OVER (PARTITION BY sub_category ORDER BY month_no) AS l3
                 FROM (SELECT sub_category, order_year * 12 + order_month - 1 AS month_no,
                              CAST(SUM(quantity) AS BIGINT) AS quantity FROM lines GROUP BY 1, 2))
           WHERE l3 IS NOT NULL"""
    ),
    "reorder_points": over_lines(
        f"""SELECT sub_category, {r("avg_monthly_demand", "avg_monthly_demand")},
                   {r("std_demand", "std_demand")}, {r("safety_stock", "safety_stock")},
                   {r("reorder_point", "reorder_point")} FROM reorder""", REORDER,
    ),
    "monthly_demand": over_lines(
        f"""SELECT sub_category, {r("AVG(q)", "mean_month_qty")}, {r("stddev_samp(q)", "std_month_qty")}
            FROM (SELECT sub_category, SUM(quantity) AS q FROM lines
                  GROUP BY sub_category, order_year, order_month)
            GROUP BY sub_category"""
    ),
    "classification_report": over_lines(
        f"""SELECT class, {r("precision", "precision")}, {r("recall", "recall")}, {r("f1", "f1")}, support
            FROM (
              SELECT CAST(c AS VARCHAR) AS class, p AS precision, r AS recall, f AS f1, s AS support FROM per_class
              UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM
                (SELECT AVG(CAST(label = prediction AS INT)) AS acc, COUNT(*) AS n FROM predicted)
              UNION ALL SELECT 'macro avg', AVG(p), AVG(r), AVG(f), CAST(SUM(s) AS BIGINT) FROM per_class
              UNION ALL SELECT 'weighted avg', SUM(p * s) / SUM(s), SUM(r * s) / SUM(s), SUM(f * s) / SUM(s),
                               CAST(SUM(s) AS BIGINT) FROM per_class)""",
        CUSTOMERS, SCORED, PREDICTED,
        """hits AS (
          SELECT c, COUNT(*) FILTER (label = c AND prediction = c) AS h,
                 COUNT(*) FILTER (prediction = c) AS said, COUNT(*) FILTER (label = c) AS s
          FROM predicted, (SELECT unnest([0, 1]) AS c) GROUP BY c),
        per_class AS (SELECT c, h / said AS p, h / s AS r, 2 * h / (said + s) AS f, s FROM hits)""",
    ),
    "roc_curve": over_lines(
        f"""SELECT {r("threshold", "threshold")}, {r("fp / all_neg", "fpr")}, {r("tp / all_pos", "tpr")}
            FROM running UNION ALL SELECT NULL::DOUBLE, 0::DOUBLE, 0::DOUBLE""", CUSTOMERS, SCORED, THRESHOLDS,
    ),
    "roc_auc": over_lines(
        f"""SELECT {r("SUM(neg * (2 * tp - pos)) / (2 * MAX(all_pos) * MAX(all_neg))", "auc")}
            FROM running""", CUSTOMERS, SCORED, THRESHOLDS,
    ),
    "pr_curve": over_lines(
        f"""SELECT {r("threshold", "threshold")}, {r("tp / (tp + fp)", "precision")},
                   {r("tp / all_pos", "recall")} FROM running
            UNION ALL SELECT NULL::DOUBLE, 1::DOUBLE, 0::DOUBLE""", CUSTOMERS, SCORED, THRESHOLDS,
    ),
    "average_precision": over_lines(
        f"""SELECT {r("SUM(pos / all_pos * tp / (tp + fp))", "average_precision")} FROM running""",
        CUSTOMERS, SCORED, THRESHOLDS,
    ),
    "lift_table": over_lines(
        f"""SELECT bin AS decile, n, {big("churned", "churned")}, {r("p", "avg_churn_prob")},
                   {r("churned / n", "churn_rate")},
                   {big("SUM(churned) OVER (ORDER BY bin DESC)", "cum_churned")},
                   {r("churned / n / (SUM(churned) OVER () / SUM(n) OVER ())", "lift")}
            FROM (SELECT bin, COUNT(*) AS n, SUM(label) AS churned, AVG(score) AS p
                  FROM binned GROUP BY bin)""",
        CUSTOMERS, SCORED, quantile_bins("score", "scored"),
    ),
    "regression_metrics": over_lines(
        f"""SELECT COUNT(*) AS n, {r("AVG(abs(e))", "mae", 4)}, {r("sqrt(AVG(e * e))", "rmse", 4)},
                   {r("1 - SUM(e * e) / (COUNT(*) * var_pop(revenue))", "r2", 4)},
                   {r("AVG(abs(e / GREATEST(revenue, 1))) * 100", "mape", 4)}
            FROM errors""", MONTHLY, ERRORS,
    ),
    "residual_hist": over_lines(
        f"""SELECT bin, {r("lo + bin * (hi - lo) / 20", "lower", 3)},
                   {r("lo + (bin + 1) * (hi - lo) / 20", "upper", 3)}, COUNT(*) AS "count"
            FROM (SELECT lo, hi, CAST(LEAST(floor((e - lo) / (hi - lo) * 20), 19) AS BIGINT) AS bin
                  FROM errors, (SELECT MIN(e) AS lo, MAX(e) AS hi FROM errors))
            GROUP BY bin, lo, hi""", MONTHLY, ERRORS,
    ),
    "kpi_core": core_sql("order_year, order_month"),
    "kpi_core_year_region": core_sql("order_year, region"),
    "kpi_core_quarter_segment": core_sql("order_year, order_quarter, segment"),
    "kpi_growth": over_lines(
        f"""SELECT c.order_year, c.order_month,
                   {r("(c.profit - p.profit) / NULLIF(abs(p.profit), 0) * 100", "profit_growth_mom_pct")},
                   {r("(c.revenue - y.revenue) / NULLIF(y.revenue, 0) * 100", "revenue_growth_yoy_pct")}
            FROM monthly c LEFT JOIN monthly p ON p.month_no = c.month_no - 1
            LEFT JOIN monthly y ON y.month_no = c.month_no - 12""", MONTHLY,
    ),
    "kpi_growth_region": over_lines(
        f"""SELECT c.order_year, c.order_month, c.region,
                   {r("(c.profit - p.profit) / NULLIF(abs(p.profit), 0) * 100", "profit_growth_mom_pct")},
                   {r("(c.revenue - y.revenue) / NULLIF(y.revenue, 0) * 100", "revenue_growth_yoy_pct")}
            FROM regional c
            LEFT JOIN regional p ON p.month_no = c.month_no - 1 AND p.region = c.region
            LEFT JOIN regional y ON y.month_no = c.month_no - 12 AND y.region = c.region""",
        MONTHLY.replace("monthly AS", "regional AS")
        .replace("SELECT order_year", "SELECT region, order_year")
        .replace("GROUP BY order_year", "GROUP BY region, order_year"),
    ),
    "kpi_running_total": over_lines(
        f"""SELECT order_year, order_month, {r("SUM(s) OVER (ORDER BY order_year, order_month)", "running_revenue")}
            FROM (SELECT order_year, order_month, SUM(sales) AS s FROM lines GROUP BY 1, 2)"""
    ),
    "kpi_active_customers": over_lines(
        """SELECT order_year, order_month, COUNT(DISTINCT customer_id) AS active_customers
           FROM month_ends JOIN visits ON order_date BETWEEN month_end - 89 AND month_end
           GROUP BY 1, 2""", MONTH_ENDS,
    ),
    "kpi_new_customers": over_lines(
        """SELECT l.order_year, l.order_month, COUNT(DISTINCT l.customer_id) AS customers_in_period,
                  COUNT(DISTINCT CASE WHEN date_trunc('month', first_date) = date_trunc('month', order_date)
                                      THEN l.customer_id END) AS first_time_customers
           FROM lines l JOIN (SELECT customer_id, MIN(order_date) AS first_date FROM lines GROUP BY 1)
             USING (customer_id)
           GROUP BY 1, 2"""
    ),
    "kpi_retention": over_lines(
        f"""SELECT order_year, order_month, active_now, active_previous,
                   {r("COALESCE(active_now / NULLIF(active_now + active_previous, 0), 0) * 100", "retention_pct")}
            FROM (SELECT order_year, order_month,
                         COUNT(DISTINCT CASE WHEN order_date >= month_end - 89 THEN customer_id END) AS active_now,
                         COUNT(DISTINCT CASE WHEN order_date < month_end - 89 THEN customer_id END) AS active_previous
                  FROM month_ends JOIN visits ON order_date BETWEEN month_end - 179 AND month_end
                  GROUP BY 1, 2)""", MONTH_ENDS,
    ),
    "kpi_avg_clv": over_lines(
        f"""SELECT order_year, order_month, {r("CAST(SUM(p) AS DOUBLE) / COUNT(*)", "avg_clv")}
            FROM (SELECT order_year, order_month, customer_id, SUM(profit) AS p FROM lines GROUP BY 1, 2, 3)
            GROUP BY 1, 2"""
    ),
    "kpi_champion_share": over_lines(
        f"""SELECT order_year, order_month,
                   {r("COALESCE(CAST(SUM(sales) FILTER (segment_label = 'Champions') AS DOUBLE) / CAST(SUM(sales) AS DOUBLE), 0) * 100", "segment_share_pct")}
            FROM lines JOIN labelled USING (customer_id) GROUP BY 1, 2""", MARKETING_BASE,
    ),
    "kpi_churn": over_lines(
        f"""SELECT segment, COUNT(DISTINCT customer_id) FILTER (churn_prob >= 0.7) AS high_risk_customers,
                   {r("AVG(churn_prob)", "return_risk_score")} FROM labelled GROUP BY segment""",
        MARKETING_BASE,
    ),
    "kpi_segment_counts": over_lines(
        "SELECT segment_label, COUNT(*) AS customers FROM labelled GROUP BY 1", MARKETING_BASE
    ),
    "kpi_ops": over_lines(
        f"""SELECT order_year, order_month, {r(avg("ship_days"), "avg_ship_days")},
                   COUNT(*) FILTER (is_profitable = 0) AS loss_lines,
                   {r("COUNT(*) FILTER (is_profitable = 0) / COUNT(DISTINCT order_id) * 100", "loss_pct")},
                   {r("SUM(sales * discount)", "discount_given")},
                   {r("CAST(SUM(sales * discount) AS DOUBLE) / CAST(SUM(sales) AS DOUBLE) * 100", "discount_pct")}
            FROM lines GROUP BY 1, 2"""
    ),
    "kpi_category_share": over_lines(
        f"""SELECT order_year, order_month, category,
                   {r("COALESCE(CAST(p AS DOUBLE) / NULLIF(CAST(SUM(p) OVER (PARTITION BY order_year, order_month) AS DOUBLE), 0), 0) * 100", "profit_share_pct")}
            FROM (SELECT order_year, order_month, category, SUM(profit) AS p FROM lines GROUP BY 1, 2, 3)"""
    ),
    "kpi_turnover": over_lines(
        f"""SELECT c.order_year, c.order_month, {big("c.quantity", "quantity")},
                   {r("c.quantity / NULLIF(y.quantity, 0)", "turnover")}
            FROM monthly c LEFT JOIN monthly y ON y.month_no = c.month_no - 12""", MONTHLY,
    ),
    "kpi_flags": over_lines(
        """SELECT order_year, order_month,
                  CASE WHEN margin >= 15 THEN '#06D6A0' WHEN margin >= 5 THEN '#FFB703'
                       ELSE '#FF3A5C' END AS margin_colour,
                  CASE WHEN change > 0 THEN '▲ ' ELSE '▼ ' END
                    || CASE WHEN change IS NULL THEN '' ELSE printf('%.1f', change) END || '%' AS trend_arrow
           FROM (SELECT c.order_year, c.order_month, c.profit / NULLIF(c.revenue, 0) * 100 AS margin,
                        (c.profit - p.profit) / NULLIF(abs(p.profit), 0) * 100 AS change
                 FROM monthly c LEFT JOIN monthly p ON p.month_no = c.month_no - 1)""", MONTHLY,
    ),
    "rec_marketing": over_lines(
        f"""SELECT customer_id, customer_name, segment, recency, frequency, num_channels, segment_label,
                   recommended_action, priority, {r("monetary", "monetary")},
                   {r("avg_discount", "avg_discount")}, {r("avg_margin", "avg_margin")},
                   {r("churn_prob", "churn_prob")} FROM marketing""", MARKETING_BASE,
    ),
    "rec_pricing": over_lines(
        f"""SELECT sub_category, category, total_qty, pricing_action, urgency,
                   {r("avg_discount", "avg_discount")}, {r("avg_margin", "avg_margin")},
                   {r("total_profit", "total_profit")}, {r("total_revenue", "total_revenue")},
                   {r("elasticity", "elasticity")} FROM pricing""", ELASTICITY, PRICING_CTE,
    ),
    "rec_inventory": over_lines(
        f"SELECT {INVENTORY_COLUMNS} FROM inventory", REORDER, INVENTORY_CTE
    ),
    "rec_channel": over_lines(
        f"""SELECT channel, orders, customers, {r("revenue", "revenue")}, {r("profit", "profit")},
                   {r("avg_margin", "avg_margin")}, {r("avg_discount", "avg_discount")},
                   {r("profit / orders", "profit_per_order")}, {r("rs", '"revenue_share_%"')},
                   {r("ps", '"profit_share_%"')},
                   CASE WHEN ps > rs * 1.1 THEN '{CHANNEL["scale_up"]}'
                        WHEN avg_margin < 0.05 THEN '{CHANNEL["review"]}'
                        WHEN avg_discount > 0.20 THEN '{CHANNEL["reduce"]}'
                        ELSE '{CHANNEL["maintain"]}' END AS channel_action
            FROM (SELECT * REPLACE (CAST(revenue AS DOUBLE) AS revenue, CAST(profit AS DOUBLE) AS profit),
                         CAST(revenue AS DOUBLE) / CAST(SUM(revenue) OVER () AS DOUBLE) * 100 AS rs,
                         CAST(profit AS DOUBLE) / CAST(SUM(profit) OVER () AS DOUBLE) * 100 AS ps
                  FROM (SELECT channel, SUM(sales) AS revenue, SUM(profit) AS profit,
                               COUNT(DISTINCT order_id) AS orders, COUNT(DISTINCT customer_id) AS customers,
                               {avg("profit_margin")} AS avg_margin, {avg("discount")} AS avg_discount
                        FROM lines GROUP BY channel))"""
    ),
    "rec_priority_counts": over_lines(
        """SELECT 'marketing' AS report, priority AS level, COUNT(*) AS "count" FROM marketing GROUP BY 2
           UNION ALL SELECT 'pricing', urgency, COUNT(*) FROM pricing GROUP BY 2""",
        MARKETING_BASE, ELASTICITY, PRICING_CTE,
    ),
    "similar_customers": over_lines(
        f"SELECT customer_id, neighbour_id, {r('similarity', 'similarity', 9)}, rank FROM near", SIMILAR
    ),
    "recommendations": over_lines(
        f"""SELECT customer_id, sub_category, {r("s", "score", 4)}, rank FROM (
              SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY s DESC, sub_category) AS rank
              FROM (SELECT customer_id, sub_category, ROUND(COALESCE(t, 0), 4) AS s FROM (
                      SELECT customer_id, sub_category
                      FROM (SELECT DISTINCT customer_id FROM bought), (SELECT DISTINCT sub_category FROM bought)
                      EXCEPT SELECT customer_id, sub_category FROM bought WHERE amount > 0)
                    LEFT JOIN (SELECT n.customer_id, sub_category, SUM(similarity * amount) AS t
                               FROM near n JOIN bought b ON b.customer_id = n.neighbour_id GROUP BY 1, 2)
                    USING (customer_id, sub_category))) WHERE rank <= 5""", SIMILAR,
    ),
    "copurchase_corr": over_lines(
        f"""SELECT a.sub_category AS item_a, b.sub_category AS item_b, {r("corr(a.amount, b.amount)", "corr")}
            FROM full_bought a JOIN full_bought b USING (customer_id) GROUP BY 1, 2""",
        SIMILAR,
        """full_bought AS (
          SELECT customer_id, sub_category, COALESCE(amount, 0) AS amount
          FROM (SELECT DISTINCT customer_id FROM bought) CROSS JOIN (SELECT DISTINCT sub_category FROM bought)
          LEFT JOIN bought USING (customer_id, sub_category))""",
    ),
    "clean_dirty": "WITH " + DIRTY + f"""
        SELECT row_id, order_id, product_id, order_date, {r("quantity", "quantity")}, {r("discount", "discount")},
               {r("sales", "sales")}, {r("profit", "profit")}, is_profitable, country FROM dirty""",
    "profile_dirty": "WITH " + DIRTY + """, sums AS (
        SELECT COUNT(*) AS n, COUNT(*) FILTER (order_date IS NULL) AS undated FROM dirty)
        SELECT name AS column_name, n AS row_count,
               CASE WHEN name = 'order_date' THEN undated ELSE 0 END AS null_count
        FROM sums, (VALUES ('row_id'), ('order_id'), ('product_id'), ('order_date'), ('quantity'), ('discount'),
                    ('sales'), ('profit'), ('is_profitable'), ('country')) AS names(name)""",
    # Fitted values have no SQL form; what has to hold for each of them does.
    "churn_scores_check": over_lines(
        """SELECT customer_id, churned, is_test, is_test AS scored, CAST(1 AS BIGINT) AS agrees FROM (
             SELECT customer_id, churned,
                    CAST(row_number() OVER w <= ROUND(COUNT(*) OVER (PARTITION BY churned) * 0.2) AS BIGINT) AS is_test
             FROM customers WINDOW w AS (PARTITION BY churned ORDER BY """
        + draw("customer_id") + ", customer_id))",
        CUSTOMERS,
    ),
    "return_scores_check": over_lines(
        """SELECT order_id, product_id, returned, CAST(1 AS BIGINT) AS scored FROM (
             SELECT *, row_number() OVER w <= ROUND(COUNT(*) OVER (PARTITION BY returned) * 0.2) AS is_test
             FROM returns WINDOW w AS (PARTITION BY returned ORDER BY """
        + draw("order_id || '|' || product_id") + ", order_id, product_id)) WHERE is_test",
        RETURNS,
    ),
    "revenue_backtest_check": over_lines(
        f"""SELECT period, {r("revenue", "actual", 4)}, CAST(1 AS BIGINT) AS adds_up
            FROM (SELECT *, row_number() OVER (ORDER BY month_no) - 1 AS place, COUNT(*) OVER () AS n
                  FROM (SELECT make_date(order_year, order_month, 1) AS period, month_no, revenue,
                               lag(revenue, 12) OVER (ORDER BY month_no) AS lag12 FROM monthly)
                  WHERE lag12 IS NOT NULL)
            WHERE place >= floor(n * 0.8)""", MONTHLY,
    ),
    "residual_table_check": over_lines(
        f"""SELECT period, {r("revenue", "actual", 4)}, CAST(1 AS BIGINT) AS adds_up
            FROM (SELECT make_date(order_year, order_month, 1) AS period, month_no, revenue,
                         lag(revenue, 3) OVER (ORDER BY month_no) AS lag3 FROM monthly)
            WHERE lag3 IS NOT NULL AND """ + draw("month_no") + " % 1000 < 200", MONTHLY,
    ),
    "demand_backtest_check": over_lines(
        f"""SELECT sub_category, month_no, {r("quantity", "actual", 4)}, CAST(1 AS BIGINT) AS adds_up
            FROM (SELECT *, lag(quantity, 3) OVER (PARTITION BY sub_category ORDER BY month_no) AS l3
                  FROM (SELECT sub_category, order_year * 12 + order_month - 1 AS month_no,
                               CAST(SUM(quantity) AS BIGINT) AS quantity FROM lines GROUP BY 1, 2))
            WHERE l3 IS NOT NULL AND """ + draw("sub_category || '|' || month_no") + " % 1000 < 200",
    ),
    "importance_check": """SELECT model, CAST(1 AS BIGINT) AS adds_up
        FROM (VALUES ('churn'), ('returns'), ('demand')) AS names(model)""",
    "model_roundtrip_check": over_lines(
        "SELECT customer_id, CAST(1 AS BIGINT) AS equal FROM customers", CUSTOMERS
    ),
    "cv_check": """SELECT model, metric, CAST(1 AS BIGINT) AS inside
        FROM (VALUES ('churn', 'auc'), ('churn', 'f1'), ('churn', 'precision'), ('churn', 'recall'),
                     ('returns', 'auc'), ('returns', 'f1')) AS names(model, metric)""",
    "attribution_check": over_lines(
        """SELECT customer_id, CAST(1 AS BIGINT) AS adds_up, CAST(1 AS BIGINT) AS gives_score FROM (
             SELECT customer_id, row_number() OVER w <= ROUND(COUNT(*) OVER (PARTITION BY churned) * 0.2) AS is_test
             FROM customers WINDOW w AS (PARTITION BY churned ORDER BY """
        + draw("customer_id") + ", customer_id)) WHERE is_test",
        CUSTOMERS,
    ),
    "cluster_check": """SELECT segment_label, CAST(place AS BIGINT) AS place
        FROM (VALUES ('Champions', 1), ('Loyal', 2), ('At Risk', 3), ('Lost', 4)) AS names(segment_label, place)""",
}


def period_twins(period: str, by: list[str]) -> dict[str, str]:
    """Measures that look at earlier periods, for quarters or years and slicers."""
    many, keys = (4, ["order_year", "order_quarter"]) if period == "quarter" else (1, ["order_year"])
    number = "order_year * 4 + order_quarter - 1" if many == 4 else "order_year"
    part = ["CAST(year(d) AS BIGINT) AS order_year", "CAST(quarter(d) AS BIGINT) AS order_quarter"][: len(keys)]
    names, shown = ", ".join(keys + by), ", ".join(f"c.{name}" for name in keys + by)
    own = ", ".join(by)
    same = "".join(f" AND {{0}}.{name} = c.{name}" for name in by)
    sums = f"""sums AS (
        SELECT {names}, {number} AS no, CAST(SUM(sales) AS DOUBLE) AS revenue, CAST(SUM(profit) AS DOUBLE) AS profit,
               SUM(sales) AS exact, SUM(quantity) AS quantity
        FROM lines GROUP BY {names})"""
    before = f"LEFT JOIN sums p ON p.no = c.no - 1{same.format('p')}"
    last_year = f"LEFT JOIN sums y ON y.no = c.no - {many}{same.format('y')}"
    ends = f"""ends AS (
        SELECT {", ".join(part)}, MAX(d) AS last FROM (
            SELECT unnest(generate_series((SELECT MIN(order_date) FROM lines)::TIMESTAMP,
                   (SELECT MAX(order_date) FROM lines)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS d)
        GROUP BY {", ".join(str(place + 1) for place in range(len(keys)))}),
      visits AS (SELECT DISTINCT customer_id, order_date{", " + own if by else ""} FROM lines)"""
    change = "(c.profit - p.profit) / NULLIF(abs(p.profit), 0) * 100"
    return {
        "growth": over_lines(
            f"""SELECT {shown}, {r(change, "profit_growth_mom_pct")},
                       {r("(c.revenue - y.revenue) / NULLIF(y.revenue, 0) * 100", "revenue_growth_yoy_pct")}
                FROM sums c {before} {last_year}""", sums,
        ),
        "running_total": over_lines(
            f"""SELECT {names}, {r(f"SUM(exact) OVER ({'PARTITION BY ' + own if by else ''} ORDER BY no)", "running_revenue")}
                FROM sums""", sums,
        ),
        "active_customers": over_lines(
            f"""SELECT {names}, COUNT(DISTINCT customer_id) AS active_customers
                FROM ends JOIN visits ON order_date BETWEEN last - 89 AND last GROUP BY {names}""", ends,
        ),
        "new_customers": over_lines(
            f"""SELECT {names}, COUNT(DISTINCT customer_id) AS customers_in_period,
                       COUNT(DISTINCT CASE WHEN no = first_no THEN customer_id END) AS first_time_customers
                FROM (SELECT customer_id, {names}, {number} AS no,
                             MIN({number}) OVER (PARTITION BY customer_id{", " + own if by else ""}) AS first_no FROM lines)
                GROUP BY {names}"""
        ),
        "retention": over_lines(
            f"""SELECT {names}, active_now, active_previous,
                       {r("COALESCE(active_now / NULLIF(active_now + active_previous, 0), 0) * 100", "retention_pct")}
                FROM (SELECT {names},
                             COUNT(DISTINCT CASE WHEN order_date >= last - 89 THEN customer_id END) AS active_now,
                             COUNT(DISTINCT CASE WHEN order_date < last - 89 THEN customer_id END) AS active_previous
                      FROM ends JOIN visits ON order_date BETWEEN last - 179 AND last GROUP BY {names})""", ends,
        ),
        "turnover": over_lines(
            f"""SELECT {shown}, {big("c.quantity", "quantity")}, {r("c.quantity / NULLIF(y.quantity, 0)", "turnover")}
                FROM sums c {last_year}""", sums,
        ),
        "flags": over_lines(
            f"""SELECT {names},
                       CASE WHEN margin >= 15 THEN '#06D6A0' WHEN margin >= 5 THEN '#FFB703' ELSE '#FF3A5C' END AS margin_colour,
                       CASE WHEN change > 0 THEN '▲ ' ELSE '▼ ' END
                         || CASE WHEN change IS NULL THEN '' ELSE printf('%.1f', change) END || '%' AS trend_arrow
                FROM (SELECT {shown}, c.profit / NULLIF(c.revenue, 0) * 100 AS margin, {change} AS change
                      FROM sums c {before})""", sums,
        ),
    }


for _period, _by, _suffix in (("quarter", [], "quarter"), ("year", ["region"], "year_region")):
    ORACLES.update({f"kpi_{name}_{_suffix}": sql for name, sql in period_twins(_period, _by).items()})
