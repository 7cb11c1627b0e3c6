"""Shared SQL prefixes of the comparison queries: the bindings and the star, written in SQL."""

from __future__ import annotations

CTES = {
    "macro_w": (
        [],
        """
        SELECT week,
          cast(cast(round(open * 30000.0::double / n) AS bigint) AS double) / 100
            AS housing_starts_index,
          cast(cast(round(cast(cents AS double) / (n * 500.0::double)) AS bigint) AS double) / 100
            AS lumber_price_index,
          cast(cast(round(filled * 1000.0::double / n) AS bigint) AS double) / 1000
            AS mortgage_rate,
          CASE WHEN month(week) <> 7
            THEN cast(cast(round(month(week) * 1000.0::double / 6.5::double) AS bigint) AS double)
              / 1000 END AS season_factor
        FROM (
          SELECT cast(date_trunc('week', o_orderdate) AS date) AS week,
            cast(count(*) AS double) AS n,
            cast(count(*) FILTER (o_orderstatus = 'O') AS double) AS open,
            cast(count(*) FILTER (o_orderstatus = 'F') AS double) AS filled,
            cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS bigint) AS cents
          FROM orders GROUP BY 1)
        """,
    ),
    "sales": (
        [],
        """
        SELECT concat_ws('|', cast(l_orderkey AS varchar), cast(l_linenumber AS varchar),
            cast(l_partkey AS varchar), cast(l_suppkey AS varchar),
            strftime(l_shipdate, '%Y-%m-%d'),
            cast(cast(round(l_extendedprice * 100) AS bigint) AS varchar)) AS row_key,
          cast(date_trunc('week', l_shipdate) AS date) AS date,
          cast(year(date_trunc('week', l_shipdate)) AS integer) AS year,
          cast(month(date_trunc('week', l_shipdate)) AS integer) AS month,
          cast(week(date_trunc('week', l_shipdate)) AS integer) AS week_of_year,
          r_name AS region, p_type AS product_category,
          concat(upper(substr(p_type, 1, 3)), '-', cast(l_partkey AS varchar)) AS sku,
          CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'pro_dealer'
            ELSE 'big_box_diy' END AS channel,
          c_mktsegment AS customer_type,
          cast(l_quantity AS integer) AS units,
          cast(round(l_extendedprice * 100 / l_quantity) AS bigint) AS price_cents,
          cast(round(l_extendedprice * 100) AS bigint) AS revenue_cents,
          cast(cast(round(l_extendedprice * 100 / l_quantity) AS bigint) AS double) / 100
            AS unit_price,
          cast(cast(round(l_extendedprice * 100) AS bigint) AS double) / 100 AS revenue,
          l_discount AS discount, l_tax AS tax, p_brand AS brand,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        JOIN part ON l_partkey = p_partkey
        """,
    ),
    "sales_m": (
        ["sales", "macro_w"],
        """
        SELECT s.*, m.housing_starts_index, m.lumber_price_index, m.mortgage_rate
        FROM sales s LEFT JOIN macro_w m ON s.date = m.week
        """,
    ),
    "landing": (
        ["sales_m"],
        """
        SELECT row_key,
          CASE WHEN discount = 0.1::double AND tax = 0.08::double THEN strftime(date, '%Y/%m/%d')
            ELSE strftime(date, '%Y-%m-%d') END AS date,
          cast(year AS varchar) AS year, cast(month AS varchar) AS month,
          cast(week_of_year AS varchar) AS week_of_year,
          CASE WHEN discount = 0.01::double AND tax = 0.0::double THEN 'ATLANTIS' ELSE region END
            AS region,
          CASE WHEN discount = 0.02::double AND tax = 0.0::double THEN 'OTHER'
            ELSE product_category END AS product_category,
          CASE WHEN brand = 'Brand#13' THEN replace(sku, '-', '') ELSE sku END AS sku,
          channel, CASE WHEN discount = 0.03::double AND tax = 0.0::double THEN 'PIRATES'
            ELSE customer_type END AS customer_type,
          CASE WHEN discount = 0.0::double AND tax = 0.08::double THEN 'twelve'
            WHEN discount = 0.0::double AND tax = 0.0::double THEN NULL
            ELSE cast(units AS varchar) END AS units,
          CASE WHEN discount = 0.1::double AND tax = 0.0::double THEN 'free'
            ELSE concat(cast(price_cents // 100 AS varchar), '.',
              lpad(cast(price_cents % 100 AS varchar), 2, '0')) END AS unit_price,
          concat(cast(revenue_cents // 100 AS varchar), '.',
            lpad(cast(revenue_cents % 100 AS varchar), 2, '0')) AS revenue,
          cast(cast(housing_starts_index AS decimal(6,2)) AS varchar) AS housing_starts_index,
          cast(cast(lumber_price_index AS decimal(8,2)) AS varchar) AS lumber_price_index,
          cast(cast(mortgage_rate AS decimal(5,3)) AS varchar) AS mortgage_rate
        FROM sales_m
        """,
    ),
    # One row per broken rule. The rules are those of bindings.landing_rules.
    "errors": (
        ["landing"],
        """
        SELECT row_key, 'date' AS "column", date AS value, 'INVALID_DATE_FORMAT' AS error_type
        FROM landing WHERE date IS NOT NULL AND try_strptime(date, '%Y-%m-%d') IS NULL
        UNION ALL
        SELECT row_key, 'units', units, 'INVALID_TYPE'
        FROM landing WHERE units IS NOT NULL AND try_cast(units AS double) IS NULL
        UNION ALL
        SELECT row_key, 'units', units, 'OUT_OF_RANGE'
        FROM landing WHERE try_cast(units AS double) < 1 OR try_cast(units AS double) > 49
        UNION ALL
        SELECT row_key, 'unit_price', unit_price, 'INVALID_TYPE'
        FROM landing WHERE unit_price IS NOT NULL AND try_cast(unit_price AS double) IS NULL
        UNION ALL
        SELECT row_key, 'unit_price', unit_price, 'OUT_OF_RANGE'
        FROM landing WHERE try_cast(unit_price AS double) <= 0.01::double
          OR try_cast(unit_price AS double) > 100000
        UNION ALL
        SELECT row_key, 'region', region, 'INVALID_CATEGORY'
        FROM landing WHERE region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST')
        UNION ALL
        SELECT row_key, 'product_category', product_category, 'INVALID_CATEGORY'
        FROM landing
        WHERE product_category NOT IN
          ('ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD')
        UNION ALL
        SELECT row_key, 'channel', channel, 'INVALID_CATEGORY'
        FROM landing WHERE channel NOT IN ('big_box_diy', 'pro_dealer')
        UNION ALL
        SELECT row_key, 'customer_type', customer_type, 'INVALID_CATEGORY'
        FROM landing
        WHERE customer_type NOT IN
          ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')
        UNION ALL
        SELECT row_key, 'lumber_price_index', lumber_price_index, 'OUT_OF_RANGE'
        FROM landing WHERE try_cast(lumber_price_index AS double) < 400
          OR try_cast(lumber_price_index AS double) > 620
        UNION ALL
        SELECT row_key, 'sku', sku, 'INVALID_FORMAT'
        FROM landing WHERE sku IS NOT NULL AND strpos(sku, '-') = 0
        """,
    ),
    "valid": (
        ["landing", "errors"],
        "SELECT l.* FROM landing l WHERE row_key NOT IN (SELECT row_key FROM errors)",
    ),
    # Typed rows that may enter the fact: valid, with date, units and price present.
    "clean": (
        ["valid"],
        """
        SELECT row_key, cast(strptime(date, '%Y-%m-%d') AS date) AS transaction_date,
          region, product_category, sku, channel, customer_type,
          cast(trunc(cast(units AS double)) AS integer) AS units,
          cast(unit_price AS double) AS unit_price,
          cast(trunc(cast(units AS double)) AS integer) * cast(unit_price AS double) AS revenue,
          split_part(sku, '-', 1) AS sku_prefix,
          cast(housing_starts_index AS double) AS housing_starts_index,
          cast(lumber_price_index AS double) AS lumber_price_index,
          cast(mortgage_rate AS double) AS mortgage_rate
        FROM valid WHERE units IS NOT NULL AND unit_price IS NOT NULL AND date IS NOT NULL
        """,
    ),
    "dim_region": (
        ["sales"],
        """
        SELECT cast(row_number() OVER (ORDER BY name) AS integer) AS region_id,
          name AS region_name
        FROM (SELECT DISTINCT r_name AS name FROM region)
        """,
    ),
    "dim_channel": (
        ["sales"],
        """
        SELECT cast(row_number() OVER (ORDER BY name) AS integer) AS channel_id,
          name AS channel_name
        FROM (SELECT DISTINCT channel AS name FROM sales)
        """,
    ),
    "dim_customer": (
        [],
        """
        SELECT cast(row_number() OVER (ORDER BY name) AS integer) AS customer_id,
          name AS customer_type
        FROM (SELECT DISTINCT c_mktsegment AS name FROM customer)
        """,
    ),
    "dim_category": (
        [],
        """
        SELECT cast(row_number() OVER (ORDER BY name) AS integer) AS category_id,
          name AS category_name, upper(substr(name, 1, 3)) AS category_code,
          false AS is_lumber_sensitive
        FROM (SELECT DISTINCT p_type AS name FROM part)
        """,
    ),
    "dim_macro": (
        ["macro_w"],
        """
        SELECT cast(strftime(week, '%Y%m%d') AS integer) AS macro_id, week,
          cast(housing_starts_index AS decimal(6,2)) AS housing_starts_index,
          cast(lumber_price_index AS decimal(8,2)) AS lumber_price_index,
          cast(mortgage_rate AS decimal(5,3)) AS mortgage_rate,
          cast(coalesce(season_factor, 1.0) AS decimal(5,3)) AS season_factor
        FROM macro_w
        """,
    ),
    # The star over valid rows ("clean"); "base" is replaced by another row source below.
    "dim_date": (
        ["clean"],
        """
        SELECT cast(strftime(d, '%Y%m%d') AS integer) AS date_id, d AS date,
          cast(year(d) AS integer) AS year, cast(month(d) AS integer) AS month,
          cast(quarter(d) AS integer) AS quarter, cast(week(d) AS integer) AS week_of_year,
          cast(isodow(d) - 1 AS integer) AS day_of_week, dayname(d) AS day_name
        FROM (SELECT DISTINCT transaction_date AS d FROM clean)
        """,
    ),
    "dim_product": (
        ["clean", "dim_category"],
        """
        SELECT product_id, sku, split_part(sku, '-', 1) AS sku_prefix, category_id,
          concat('Product ', sku) AS product_name, true AS is_active
        FROM (SELECT sku, row_number() OVER (ORDER BY sku) AS product_id
              FROM (SELECT DISTINCT sku FROM clean)) p
        LEFT JOIN dim_category c ON split_part(sku, '-', 1) = c.category_code
        """,
    ),
    "resolved": (
        ["clean", "dim_region", "dim_channel", "dim_customer", "dim_product", "dim_macro"],
        """
        SELECT t.*, cast(strftime(transaction_date, '%Y%m%d') AS integer) AS date_id,
          coalesce(r.region_id, -1) AS region_id, coalesce(ch.channel_id, -1) AS channel_id,
          coalesce(cu.customer_id, -1) AS customer_id, m.macro_id,
          coalesce(p.product_id, -1) AS product_id
        FROM clean t
        LEFT JOIN dim_region r ON t.region = r.region_name
        LEFT JOIN dim_channel ch ON t.channel = ch.channel_name
        LEFT JOIN dim_customer cu ON t.customer_type = cu.customer_type
        LEFT JOIN dim_macro m ON t.transaction_date = m.week
        LEFT JOIN dim_product p ON t.sku = p.sku
        """,
    ),
    "fact": (
        ["resolved"],
        """
        SELECT date_id, region_id, product_id, channel_id, customer_id,
          cast(sum(units) AS bigint) AS units,
          sum(cast(revenue AS decimal(15,2))) AS revenue,
          arg_min(cast(unit_price AS decimal(12,4)), row_key) AS unit_price,
          arg_min(coalesce(macro_id, -1), row_key) AS macro_key
        FROM resolved GROUP BY ALL
        """,
    ),
    "panel": (
        [],
        """
        SELECT n_name AS team, y AS year, f AS wins, o AS losses,
          CASE WHEN y >= 1998 THEN p END AS ot_losses,
          cast(f AS double) / cast(n AS double) AS win_rate,
          buyers AS goals_for, low AS goals_against, buyers - low AS goal_diff
        FROM (
          SELECT c_nationkey, cast(year(o_orderdate) AS integer) AS y, count(*) AS n,
            count(*) FILTER (o_orderstatus = 'F') AS f,
            count(*) FILTER (o_orderstatus = 'O') AS o,
            count(*) FILTER (o_orderstatus = 'P') AS p,
            count(*) FILTER (o_orderpriority = '5-LOW') AS low,
            count(DISTINCT o_custkey) AS buyers
          FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2)
        JOIN nation ON c_nationkey = n_nationkey
        """,
    ),
    "panel_gap": (["panel"], "SELECT * FROM panel WHERE year <> 1998"),
    "pairs": (
        ["panel"],
        """
        SELECT a.team, a.year, a.wins, a.losses, coalesce(a.ot_losses, 0) AS ot_losses,
          a.win_rate, a.goals_for, a.goals_against, a.goal_diff,
          b.win_rate AS next_win_rate, b.year AS target_year, m.med AS median_next_win_rate,
          CASE WHEN b.win_rate > m.med THEN 1 ELSE 0 END AS target,
          CASE WHEN b.year <= 1997 THEN 'train' WHEN b.year <= 2000 THEN 'validation'
            ELSE 'test' END AS split
        FROM panel a JOIN panel b ON a.team = b.team AND b.year = a.year + 1
        JOIN (SELECT year, quantile_cont(win_rate, 0.5) AS med FROM panel GROUP BY 1) m
          ON m.year = b.year
        """,
    ),
}


def sql(body: str, *names: str) -> str:
    """``body`` preceded by the named parts and what they rest on."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][0]:
            visit(dep)
        order.append(name)

    for n in names:
        visit(n)
    parts = ",\n".join(f"{n} AS ({CTES[n][1]})" for n in order)
    own = body.strip()
    return f"WITH {parts},\n{own[5:]}" if own.startswith("WITH ") else f"WITH {parts}\n{own}"
