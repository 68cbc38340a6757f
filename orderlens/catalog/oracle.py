"""The registered queries as SQL, written from their definitions over the base tables.

Shared parts are CTEs: `line` and `ord` are the rows as they should come out of
cleaning, stated from the typed tables rather than parsed from text.
"""

from __future__ import annotations

_LINE = """
line AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
    CAST(l_quantity AS INTEGER) AS quantity,
    n_name,
    CASE WHEN l_suppkey % 97 = 0 THEN '' ELSE n_name END AS state,
    CASE WHEN l_quantity = 50 THEN ''
         ELSE ['XS','S','M','L','XL','XXL','3XL','4XL','5XL','6XL','FREE']
              [CAST(l_quantity AS INTEGER) % 11 + 1] END AS size,
    l_linestatus = 'F' AS is_shipped,
    CASE WHEN l_linenumber = 1 AND l_quantity IN (1, 2) THEN NULL
         WHEN l_linenumber = 1 AND l_quantity = 3 THEN 0
         ELSE CAST(l_quantity AS INTEGER) END AS qty,
    CASE WHEN l_linenumber = 6 AND l_quantity = 49 THEN NULL
         WHEN l_linenumber = 5 AND l_quantity >= 46
           THEN last_day(make_date(year(l_shipdate) + 20, 2, 1))
         ELSE CAST(l_shipdate + INTERVAL 20 YEAR AS DATE)
    END AS order_date,
    CASE WHEN l_linenumber = 7 THEN NULL
         ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN l_partkey % 211 = 0 THEN '' ELSE 'ST-' || (l_partkey % 12) END AS style,
    'SK' || l_partkey AS sku
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
),
bought AS (SELECT * FROM line WHERE is_shipped AND qty > 0 AND state <> ''),
counts AS (SELECT state, count(*) AS n FROM bought GROUP BY state),
lengths AS (SELECT state, n, CASE WHEN n > 1200 THEN 5 ELSE 10 END AS window_days FROM counts)
"""

_STATS = (
    _LINE
    + """,
bucket AS (
  SELECT b.state, CAST(b.order_date + CAST(i.k AS INTEGER) AS DATE) AS window_date, b.size,
         b.amount, l.window_days
  FROM bought b JOIN lengths l ON b.state = l.state
  JOIN range(1, 11) AS i(k) ON i.k <= l.window_days
  WHERE b.size <> '' AND b.order_date IS NOT NULL
),
stats AS (
  SELECT state, window_date, size, count(*) AS frequency,
    CASE WHEN count(amount) = 0 THEN CAST('Infinity' AS DOUBLE)
         ELSE CAST(count(amount) * sum(amount * amount) - sum(amount) * sum(amount) AS DOUBLE)
              / (CAST(count(amount) AS DOUBLE) * CAST(count(amount) AS DOUBLE))
    END AS variance,
    count(amount) AS amount_count, max(window_days) AS window_days
  FROM bucket GROUP BY state, window_date, size
)
"""
)

_STYLE = (
    _LINE
    + """,
styles AS (
  SELECT strftime(order_date, '%Y-%m') AS month, state, style, count(DISTINCT sku) AS variety
  FROM line
  WHERE state <> '' AND style <> '' AND order_date IS NOT NULL
  GROUP BY ALL
  HAVING bool_or(size IN ('XXL', '3XL', '4XL', '5XL', '6XL'))
)
"""
)

_CODE = """
ord AS (
  SELECT o_orderkey AS row_id, o_custkey,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL
         ELSE CAST(o_orderdate + INTERVAL 20 YEAR AS DATE) END AS order_date,
    CASE WHEN o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 THEN NULL
         ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount,
    CASE WHEN o_orderkey % 53 <> 0 THEN 'Sku-' || (o_custkey % 20) END AS sku,
    o_orderstatus, o_orderpriority
  FROM orders
),
code AS (
  SELECT row_id, order_date, k AS place, 'P' || (o_custkey + k * k) AS promo
  FROM ord JOIN range(1, 7) AS i(k) ON k <= row_id % 7
  UNION ALL
  SELECT row_id, order_date, 9, 'P' || (o_custkey + 1)
  FROM ord WHERE row_id % 7 <> 0 AND row_id % 11 = 0
),
code_counts AS (
  SELECT ord.row_id, CAST(count(promo) AS INTEGER) AS promotion_count
  FROM ord LEFT JOIN code ON ord.row_id = code.row_id GROUP BY ord.row_id
),
periods AS (
  SELECT promo, min(order_date) AS first_date, max(order_date) AS last_date,
         max(order_date) - min(order_date) AS active_days
  FROM code WHERE order_date IS NOT NULL GROUP BY promo
),
valid AS (SELECT * FROM periods WHERE active_days >= 2200),
valid_counts AS (
  SELECT ord.row_id, count(valid.promo) AS valid_promotion_count
  FROM ord
  LEFT JOIN code ON ord.row_id = code.row_id AND code.order_date IS NOT NULL
  LEFT JOIN valid ON code.promo = valid.promo
  GROUP BY ord.row_id
)
"""

_CANCEL = (
    _CODE
    + """,
placed AS (
  SELECT ord.*,
    CASE WHEN row_id % 23 <> 0 THEN n_name END AS state,
    CASE WHEN c_mktsegment = 'BUILDING' AND row_id % 5 = 0 THEN NULL
         WHEN row_id % 19 = 0 THEN ''
         ELSE n_name || ' ' || c_mktsegment END AS city
  FROM ord JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
averages AS (
  SELECT state, CAST(sum(amount) AS DOUBLE) / count(*) AS state_average_amount
  FROM placed
  WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus = 'O'
    AND state IS NOT NULL AND amount IS NOT NULL
  GROUP BY state
),
classified AS (
  SELECT placed.row_id, city, placed.state, valid_promotion_count, state_average_amount,
    coalesce(valid_promotion_count >= 3
             AND CAST(amount AS DOUBLE) < state_average_amount, false) AS is_qualified
  FROM placed JOIN valid_counts ON placed.row_id = valid_counts.row_id
  LEFT JOIN averages ON placed.state = averages.state
  WHERE o_orderstatus = 'F' AND o_orderpriority <> '5-LOW'
),
shares AS (
  SELECT city, count(*) AS cancelled_standard_count,
    count(*) FILTER (is_qualified) AS qualified_order_count,
    round(CAST(count(*) FILTER (is_qualified) AS DOUBLE) * 100.0
          / CAST(count(*) AS DOUBLE), 6) AS percentage
  FROM classified GROUP BY city
)
"""
)

# Doubles with more decimals than cents, summed exactly: in units of 2^-53 each of them is a whole number.
_ANY_CANCEL = _CANCEL.replace(
    "CAST(o_totalprice AS DECIMAL(18,2)) END AS amount",
    "CAST(o_totalprice AS DOUBLE) * CAST(1.0825 AS DOUBLE) END AS amount",
).replace(
    "CAST(sum(amount) AS DOUBLE) / count(*)",
    "CAST(CAST(sum(CAST(amount * pow(2, 53) AS HUGEINT)) AS VARCHAR) AS DOUBLE) / pow(2, 53) / count(*)",
)

_SPREAD = (
    _CODE
    + """,
prepared AS (
  SELECT ord.row_id, sku, strftime(order_date, '%Y-%m') AS month, amount, promotion_count
  FROM ord JOIN code_counts ON ord.row_id = code_counts.row_id
  WHERE order_date IS NOT NULL AND sku IS NOT NULL
),
ranked AS (
  SELECT sku, month, count(*) AS n, list_sort(list(CAST(promotion_count AS DOUBLE))) AS v,
    CAST(count(*) - 1 AS DOUBLE) * CAST(0.9 AS DOUBLE) AS at90,
    CAST(count(*) - 1 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS at80,
    quantile_disc(promotion_count, 0.9) AS d90, quantile_disc(promotion_count, 0.8) AS d80
  FROM prepared GROUP BY sku, month
),
thresholds AS (
  SELECT sku, month, n AS group_order_count,
    CAST(d90 AS DOUBLE) AS p90_approx_threshold, CAST(d80 AS DOUBLE) AS p80_approx_threshold,
    v[CAST(floor(at90) AS BIGINT) + 1] + (at90 - floor(at90))
      * (v[CAST(ceil(at90) AS BIGINT) + 1] - v[CAST(floor(at90) AS BIGINT) + 1])
      AS p90_exact_threshold,
    v[CAST(floor(at80) AS BIGINT) + 1] + (at80 - floor(at80))
      * (v[CAST(ceil(at80) AS BIGINT) + 1] - v[CAST(floor(at80) AS BIGINT) + 1])
      AS p80_exact_threshold
  FROM ranked
)
"""
)


def _tail(prefix: str) -> str:
    at = f"promotion_count >= {prefix}_threshold"
    n = f"count(amount) FILTER ({at})"
    total = f"sum(amount) FILTER ({at})"
    squares = f"sum(amount * amount) FILTER ({at})"
    return f"""
    any_value({prefix}_threshold) AS {prefix}_threshold,
    count(*) FILTER ({at}) AS {prefix}_qualifying_count,
    CASE WHEN count(*) FILTER ({at}) < 2 OR {n} = 0 THEN 0.0
         ELSE sqrt(CAST({n} * {squares} - {total} * {total} AS DOUBLE)
              / (CAST({n} AS DOUBLE) * CAST({n} AS DOUBLE))) END AS {prefix}_stddev"""


_COMPARED = (
    _SPREAD
    + f""",
tails AS (
  SELECT prepared.sku, prepared.month, count(*) AS group_order_count,
  {_tail("p90_approx")}, {_tail("p90_exact")}, {_tail("p80_approx")}, {_tail("p80_exact")}
  FROM prepared JOIN thresholds
    ON prepared.sku = thresholds.sku AND prepared.month = thresholds.month
  GROUP BY prepared.sku, prepared.month
),
compared AS (
  SELECT *,
    abs(p90_exact_threshold - p90_approx_threshold) AS p90_threshold_abs_diff,
    abs(p80_exact_threshold - p80_approx_threshold) AS p80_threshold_abs_diff,
    abs(p90_exact_qualifying_count - p90_approx_qualifying_count)
      AS p90_qualifying_set_diff_count,
    abs(p80_exact_qualifying_count - p80_approx_qualifying_count)
      AS p80_qualifying_set_diff_count,
    abs(p90_exact_stddev - p90_approx_stddev) AS p90_stddev_abs_diff,
    abs(p80_exact_stddev - p80_approx_stddev) AS p80_stddev_abs_diff
  FROM tails
)
"""
)

# A line whose order key ends in 11 is made faulty according to its quantity.
_FAULT = (
    _LINE
    + """,
faulty AS (
  SELECT *,
    CASE WHEN l_orderkey % 100 <> 11 THEN NULL
         WHEN quantity = 10 THEN 'header'
         WHEN quantity IN (11, 12, 13) THEN 'bad_csv'
         WHEN quantity IN (14, 15, 16) THEN 'wrong_column_count' END AS fault
  FROM line
),
usable_counts AS (
  SELECT state, count(*) AS n FROM faulty
  WHERE fault IS NULL AND is_shipped AND qty > 0 AND state <> '' GROUP BY state
),
lookup AS (
  SELECT state, CASE WHEN n > 1200 THEN 5 ELSE 10 END AS window_days
  FROM usable_counts WHERE n > 1200
)
"""
)


def _summary(method: str) -> str:
    columns = ", ".join(
        f"{name}_{method}_{measure}"
        for name in ("p90", "p80")
        for measure in ("threshold", "qualifying_count", "stddev")
    )
    return f"WITH {_COMPARED} SELECT sku, month, group_order_count, {columns} FROM compared"


def _report() -> str:
    measures = [
        f"{name}_{label}"
        for label in ("threshold_abs_diff", "qualifying_set_diff_count", "stddev_abs_diff")
        for name in ("p90", "p80")
    ]
    parts = [
        f"""SELECT '{m}' AS measure, count(*) FILTER ({m} > 1e-9) AS differing_groups,
            count(*) AS group_count,
            CASE WHEN count(*) = 0 THEN 0.0
                 ELSE CAST(count(*) FILTER ({m} > 1e-9) AS DOUBLE) * 100.0 / count(*)
            END AS share FROM compared"""
        for m in measures
    ]
    return f"WITH {_COMPARED} " + " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    prepared = f"""WITH {_SPREAD} SELECT row_id, sku, month, CAST(amount AS DOUBLE) AS amount,
                   promotion_count FROM prepared"""
    shares = f"""WITH {_CANCEL} SELECT city, cancelled_standard_count, qualified_order_count,
                 percentage FROM shares"""
    medians = f"""WITH {_STYLE} SELECT month, state, median(variety) AS median,
                  count(*) AS style_count FROM styles GROUP BY month, state"""
    winners = f"""
            WITH {_STATS} SELECT state, window_date, size, frequency, variance, amount_count,
              window_days FROM stats
            QUALIFY row_number() OVER (PARTITION BY state, window_date
                                       ORDER BY frequency DESC, variance, size) = 1"""
    return {
        "q01_bought_by_state": f"WITH {_LINE} SELECT state, n FROM counts",
        "q02_window_length_by_state": f"WITH {_LINE} SELECT state, n, window_days FROM lengths",
        "q03_trailing_size_stats": f"""
            WITH {_STATS} SELECT state, window_date, size, frequency, variance, amount_count,
              window_days FROM stats""",
        "q04_trailing_winners": winners,
        "q04_trailing_winners_default": winners.replace("n > 1200", "n > 10000"),
        "q05_tied_top_sizes": f"""
            WITH {_STATS}, top AS (
              SELECT state, window_date FROM stats
              QUALIFY frequency = max(frequency) OVER (PARTITION BY state, window_date)),
            ties AS (SELECT state, window_date, count(*) AS tied_sizes FROM top
                     GROUP BY state, window_date HAVING count(*) >= 2)
            SELECT tied_sizes, count(*) AS tie_groups FROM ties GROUP BY tied_sizes""",
        "q06_style_varieties": f"WITH {_STYLE} SELECT month, state, style, variety FROM styles",
        "q07_median_varieties": medians,
        "q08_promotion_periods": f"""
            WITH {_CODE} SELECT promo, first_date, last_date,
              CAST(active_days AS INTEGER) AS active_days FROM valid""",
        "q09_valid_promotions_per_order": f"""
            WITH {_CODE} SELECT row_id, valid_promotion_count FROM valid_counts""",
        "q10_average_by_state": f"""
            WITH {_CANCEL} SELECT state, state_average_amount FROM averages""",
        "q10_average_of_any_amounts": f"""
            WITH {_ANY_CANCEL} SELECT state, state_average_amount FROM averages""",
        "q11_cancellations_by_city": shares,
        "q11_cancellations_of_any_amounts": f"""WITH {_ANY_CANCEL} SELECT city, cancelled_standard_count,
                 qualified_order_count, percentage FROM shares""",
        "q11_classified_cancellations": f"""
            WITH {_CANCEL} SELECT row_id, city, state, valid_promotion_count,
              state_average_amount, is_qualified FROM classified""",
        "q11_first_cities": f"""{shares}
            ORDER BY coalesce(city, ''), city IS NULL LIMIT 30""",
        "q12_promotion_profile": f"""
            WITH {_CANCEL}
            SELECT 'promotion_codes' AS metric, count(*) AS value FROM periods
            UNION ALL SELECT 'valid_promotion_codes', count(*) FROM valid
            UNION ALL SELECT 'cancelled_with_promotions', count(*) FROM classified
              WHERE row_id % 7 <> 0 OR row_id % 49 = 7
            UNION ALL SELECT 'state_averages', count(*) FROM averages
            UNION ALL SELECT 'cancelled_cities', count(*) FROM (SELECT DISTINCT city FROM classified)
            UNION ALL SELECT 'cancelled_standard_rows', count(*) FROM classified
            UNION ALL SELECT 'qualified_rows', count(*) FROM classified WHERE is_qualified""",
        "q13_promotions_per_order": prepared,
        "q14_approx_thresholds": f"""
            WITH {_SPREAD} SELECT sku, month, p90_approx_threshold, p80_approx_threshold
            FROM thresholds""",
        "q14_sketched_thresholds": f"""
            WITH {_SPREAD} SELECT sku, month, p90_approx_threshold, p80_approx_threshold
            FROM thresholds""",
        "q15_exact_thresholds": f"""
            WITH {_SPREAD} SELECT sku, month, group_order_count, p90_exact_threshold,
              p80_exact_threshold FROM thresholds""",
        "q16_approx_spread": _summary("approx"),
        "q17_exact_spread": _summary("exact"),
        "q18_spread_comparison": f"WITH {_COMPARED} SELECT * FROM compared",
        "q18_first_comparisons": f"""
            WITH {_COMPARED} SELECT * FROM compared ORDER BY sku, month LIMIT 30""",
        "q18_one_comparison": f"""
            WITH {_COMPARED} SELECT * FROM compared WHERE sku = 'Sku-7' AND month = '2016-04'""",
        "q19_difference_report": _report(),
        "q20_group_profile": f"""
            WITH {_SPREAD}, sized AS (SELECT sku, month, count(*) AS n FROM prepared
                                      GROUP BY sku, month)
            SELECT (SELECT count(*) FROM prepared) AS order_rows, count(*) AS group_count,
              max(n) AS largest_group, count(*) FILTER (n > 1000) AS large_groups,
              (SELECT min(promotion_count) FROM prepared) AS min_promotion_count,
              (SELECT max(promotion_count) FROM prepared) AS max_promotion_count
            FROM sized""",
        "q21_id_report_lines": """
            WITH ids AS (SELECT CASE WHEN l_linenumber <> 7 OR l_quantity NOT IN (49, 50)
                                     THEN l_orderkey END AS id FROM lineitem)
            SELECT (SELECT count(*) FROM ids WHERE id IS NULL) AS null_ids,
              (SELECT count(*) FROM (SELECT id FROM ids WHERE id IS NOT NULL
                                     GROUP BY id HAVING count(*) > 1)) AS duplicate_ids""",
        "q21_id_report_orders": """
            SELECT count(*) FILTER (o_orderkey IS NULL) AS null_ids,
              count(o_orderkey) - count(DISTINCT o_orderkey) AS duplicate_ids FROM orders""",
        "q22_line_faults": f"""
            WITH {_FAULT} SELECT coalesce(fault, 'usable') AS reason, count(*) AS n
            FROM faulty GROUP BY 1""",
        "q22_count_ledger": f"""
            WITH {_FAULT} SELECT
              CASE WHEN fault IS NOT NULL THEN fault WHEN state = '' THEN 'missing_state'
                   WHEN qty IS NULL THEN 'invalid_qty'
                   WHEN is_shipped AND qty > 0 THEN 'bought' ELSE 'not_bought' END AS reason,
              count(*) AS n
            FROM faulty GROUP BY 1""",
        "q22_window_ledger": f"""
            WITH {_FAULT}, judged AS (
              SELECT CASE WHEN fault IS NOT NULL THEN fault
                          WHEN faulty.state = '' THEN 'missing_state'
                          WHEN window_days IS NULL THEN 'state_not_in_lookup'
                          WHEN qty IS NULL OR qty <= 0 OR NOT is_shipped THEN 'not_bought'
                          WHEN size = '' THEN 'missing_size'
                          WHEN order_date IS NULL THEN 'invalid_date'
                          ELSE 'source' END AS reason, window_days, amount
              FROM faulty LEFT JOIN lookup ON faulty.state = lookup.state)
            SELECT reason, count(*) AS n,
              CAST(coalesce(sum(window_days) FILTER (reason = 'source'), 0) AS BIGINT)
                AS emitted_rows,
              count(*) FILTER (reason = 'source' AND amount IS NULL) AS rows_without_amount
            FROM judged GROUP BY reason""",
        "q22_amount_ledger": """
            SELECT CASE WHEN l_linenumber = 7 THEN 'missing'
                        WHEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) <> l_extendedprice THEN 'rounded'
                        ELSE 'kept' END AS reason, count(*) AS n FROM lineitem GROUP BY 1""",
        "q22_variety_ledger": f"""
            WITH {_FAULT}, judged AS (
              SELECT *, CASE WHEN fault IS NOT NULL THEN fault
                             WHEN state = '' OR style = '' THEN 'missing_key'
                             WHEN order_date IS NULL THEN 'invalid_date'
                             ELSE 'valid' END AS reason FROM faulty),
            qualified AS (
              SELECT month(order_date) AS m, year(order_date) AS y, state, style FROM judged
              WHERE reason = 'valid' GROUP BY ALL
              HAVING bool_or(size IN ('XXL', '3XL', '4XL', '5XL', '6XL')))
            SELECT reason, count(*) AS n FROM judged GROUP BY reason
            UNION ALL SELECT 'qualified_styles', count(*) FROM qualified""",
        "q23_cleaned_lines": f"""
            WITH {_LINE} SELECT 'O-' || l_orderkey AS order_id,
              CASE WHEN l_linenumber <> 7 OR quantity NOT IN (49, 50) THEN l_orderkey END AS row_id,
              state AS state_key,
              CASE WHEN state <> '' AND l_linenumber % 2 = 0 THEN chr(9) || state
                   ELSE state END AS state_label,
              CASE WHEN l_linenumber % 2 = 1 THEN 'SK' ELSE 'sk' END || l_partkey AS sku,
              is_shipped, size,
              list_position(['XS','S','M','L','XL','XXL','3XL','4XL','5XL','6XL'], size) - 1
                AS size_rank,
              qty, CAST(amount AS DOUBLE) AS amount, order_date AS clamped_date,
              CASE WHEN l_linenumber <> 5 OR quantity < 46 THEN order_date END AS order_date,
              strftime(order_date, '%Y-%m') AS month
            FROM line""",
        "q23_promotion_codes": f"""
            WITH {_CODE}, listed AS (
              SELECT row_id, string_agg(promo, '|' ORDER BY place) AS codes
              FROM code GROUP BY row_id)
            SELECT code_counts.row_id, coalesce(codes, '') AS codes, promotion_count
            FROM code_counts LEFT JOIN listed ON code_counts.row_id = listed.row_id""",
        "q24_csv_round_trip": prepared,
        "q24_strict_round_trip": f"WITH {_FAULT} SELECT state, n FROM usable_counts",
        "q24_quarantined_lines": f"""
            WITH {_FAULT} SELECT fault AS reason, count(*) AS n FROM faulty
            WHERE fault IN ('bad_csv', 'wrong_column_count') GROUP BY fault""",
        "q24_text_sink": medians,
        "q24_winners_text_sink": winners,
        "q24_parquet_sink": shares,
        "q24_rewritten_month": f"""
            WITH {_SPREAD} SELECT month, count(*) AS orders,
              CAST(sum(CASE WHEN month = lowest THEN 2 ELSE 1 END * amount) AS DOUBLE) AS total, month <> lowest AS files_kept
            FROM prepared CROSS JOIN (SELECT min(month) AS lowest FROM prepared) GROUP BY month, lowest""",
    }
