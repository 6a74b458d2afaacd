"""The same panel in SQL, as common table expressions for the equality checks."""

from __future__ import annotations

from daytally.plans import panel as P

PANEL = f"""
daily AS (
  SELECT p_brand || '_' || (p_partkey // {P.PARTS_PER_ITEM}) AS item_id, r_name AS store_id, CAST(l_shipdate AS DATE) AS date,
         CAST(SUM(CAST(l_quantity AS BIGINT)) AS BIGINT) AS units,
         CAST(SUM(CAST(ROUND(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2, 3
),
ends AS (
  SELECT MIN(CAST(l_shipdate AS DATE)) AS first_day, MAX(CAST(l_shipdate AS DATE)) AS last_day
  FROM lineitem
),
days AS (
  SELECT CAST(d AS DATE) AS date, CAST(CAST(d AS DATE) - first_day AS INTEGER) + 1 AS n
  FROM (SELECT first_day, UNNEST(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS d FROM ends)
),
cal AS (
  SELECT 'd_' || n AS d, n, date, CAST({P.WEEK_BASE} + (n - 1) // 7 AS INTEGER) AS wm_yr_wk,
         CASE WHEN (n - 1) % {P.QUARTER_DAYS} = 0 THEN 'Quarter' END AS event_name_1,
         CASE WHEN (n - 1) % {P.QUARTER_DAYS} = 0 THEN 'Cycle' END AS event_type_1,
         CASE WHEN (n - 1) % {P.HALF_DAYS} = 0 THEN 'Half' END AS event_name_2,
         CASE WHEN (n - 1) % {P.HALF_DAYS} = 0 THEN 'Cycle' END AS event_type_2,
         CASE WHEN day(date) <= 10 THEN 1 ELSE 0 END AS snap_CA,
         CASE WHEN day(date) BETWEEN 11 AND 20 THEN 1 ELSE 0 END AS snap_TX,
         CASE WHEN day(date) > 20 THEN 1 ELSE 0 END AS snap_WI
  FROM days
),
series AS (SELECT DISTINCT item_id, store_id FROM daily),
prices AS (
  SELECT store_id, item_id, wm_yr_wk,
         CAST(CAST(SUM(cents) AS BIGINT) AS DOUBLE)
           / CAST(NULLIF(CAST(SUM(units) AS BIGINT), 0) AS DOUBLE) / 100.0 AS sell_price
  FROM daily JOIN cal USING (date)
  GROUP BY 1, 2, 3
),
sales_long AS (
  SELECT s.item_id, 'DEPT_' || s.item_id AS dept_id, 'CAT' AS cat_id, s.store_id,
         upper(s.store_id[1:2]) AS state_id, cal.d AS day, cal.date, cal.wm_yr_wk,
         CAST(COALESCE(daily.units, 0) AS SMALLINT) AS sales, prices.sell_price,
         event_name_1, event_type_1, event_name_2, event_type_2, snap_CA, snap_TX, snap_WI
  FROM series s CROSS JOIN cal
  LEFT JOIN daily ON daily.item_id = s.item_id AND daily.store_id = s.store_id
                 AND daily.date = cal.date
  LEFT JOIN prices ON prices.item_id = s.item_id AND prices.store_id = s.store_id
                  AND prices.wm_yr_wk = cal.wm_yr_wk
)"""

# The rolling frames in SQL text. The ratio is guarded the way the feature table defines it.
SERIES_WINDOW = "PARTITION BY item_id, store_id ORDER BY date"
FEATURE_COLUMNS = {
    "sales_lag_7": f"LAG(sales, 7) OVER ({SERIES_WINDOW})",
    "sales_lag_28": f"LAG(sales, 28) OVER ({SERIES_WINDOW})",
    "rolling_mean_7": f"ROUND(AVG(sales) OVER ({SERIES_WINDOW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6)",
    "rolling_mean_28": f"ROUND(AVG(sales) OVER ({SERIES_WINDOW} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6)",
    "rolling_std_28": f"ROUND(STDDEV_SAMP(sales) OVER ({SERIES_WINDOW} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 6)",
    "day_of_week": "EXTRACT(DOW FROM date)",
    "month": "EXTRACT(MONTH FROM date)",
    "year": "EXTRACT(YEAR FROM date)",
    "price_ratio_28": "ROUND(sell_price / NULLIF(AVG(sell_price) OVER "
    f"({SERIES_WINDOW} ROWS BETWEEN 28 PRECEDING AND 1 PRECEDING), 0), 6)",
    "has_event": "CASE WHEN COALESCE(event_name_1, event_name_2) IS NULL THEN 0 ELSE 1 END",
}


def select_features(names: list[str]) -> str:
    return ", ".join(f"{FEATURE_COLUMNS[n]} AS {n}" for n in names)


def dated(name: str) -> str:
    return f"DATE '{name}'"


def query(select: str, *tables: str) -> str:
    """One statement: the panel, then ``tables`` in order, then ``select``."""
    return "WITH " + ",\n".join([PANEL.strip(), *tables]) + "\n" + select


FEATURED = f"""featured AS (
  SELECT *, {select_features(list(FEATURE_COLUMNS))} FROM sales_long
)"""
STORE_ROWS = f"""store_rows AS (
  SELECT * FROM featured WHERE state_id = '{P.STATE}' AND store_id = '{P.STORE}'
)"""
TOP = f"""top AS (
  SELECT item_id, COUNT(*) AS cnt FROM store_rows
  GROUP BY item_id ORDER BY cnt DESC, item_id LIMIT {P.TOP_ITEMS}
)"""
SUBSET = "subset AS (SELECT * FROM store_rows WHERE item_id IN (SELECT item_id FROM top))"
SUBSET_TABLES = [FEATURED, STORE_ROWS, TOP, SUBSET]
NAIVE = f"""naive AS (
  SELECT * FROM (
    SELECT item_id, store_id, date, sales AS actual,
           CAST(LAG(sales, {P.HORIZON}) OVER ({SERIES_WINDOW}) AS DOUBLE) AS predicted
    FROM sales_long
  ) WHERE predicted IS NOT NULL
)"""
IN_VALIDATION = f"date BETWEEN {dated(P.VAL_START)} AND {dated(P.VAL_END)}"
IN_TRAINING = f"date <= {dated(P.TRAIN_END)}"

RESIDUALS = f"""residuals AS (
  SELECT *, AVG(residual) OVER w AS residual_rolling_mean,
         STDDEV_SAMP(residual) OVER w AS residual_rolling_std
  FROM (
    SELECT *, actual - predicted AS residual, ABS(actual - predicted) AS abs_residual,
           (actual - predicted) / CASE WHEN predicted < 0.1 THEN 0.1 ELSE predicted END AS residual_pct
    FROM naive
  )
  WINDOW w AS ({SERIES_WINDOW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)"""

SCORE_TABLES = [
    FEATURED,
    f"actual AS (SELECT item_id, store_id, date, sales, sell_price FROM featured WHERE {IN_VALIDATION})",
    f"""pred AS (
  SELECT item_id, store_id, date, CAST(sales_lag_28 AS DOUBLE) AS pred
  FROM featured WHERE {IN_VALIDATION}
)""",
    f"""train AS (
  SELECT item_id, store_id, date, sales FROM featured
  WHERE {IN_TRAINING} AND sales_lag_7 IS NOT NULL AND sales_lag_28 IS NOT NULL
)""",
    f"""scales AS (
  SELECT item_id, store_id, CASE WHEN s IS NULL OR s <= 0 THEN 1e-8 ELSE s END AS scale
  FROM (
    SELECT item_id, store_id, AVG(change * change) AS s
    FROM (
      SELECT item_id, store_id,
             CAST(sales AS DOUBLE) - LAG(CAST(sales AS DOUBLE)) OVER ({SERIES_WINDOW}) AS change
      FROM train
    ) GROUP BY item_id, store_id
  )
)""",
    """errors AS (
  SELECT item_id, store_id, AVG((sales - pred) * (sales - pred)) AS mse, COUNT(*) AS matched
  FROM actual JOIN pred USING (item_id, store_id, date)
  GROUP BY item_id, store_id
)""",
]


def weights(amount: str) -> str:
    return f"""weights AS (
  SELECT item_id, store_id, raw_weight, raw_weight / SUM(raw_weight) OVER () AS weight
  FROM (
    SELECT item_id, store_id, COALESCE(SUM({amount}), 0) AS raw_weight
    FROM actual GROUP BY item_id, store_id
  )
)"""


UNITS = weights("CAST(sales AS DOUBLE)")
REVENUE = weights("CAST(sales AS DOUBLE) * sell_price")
SCORE = """SELECT ROUND(SUM(weight * SQRT(mse / scale)), 6) AS wrmsse,
  CAST(SUM(matched) AS BIGINT) AS matched_rows
FROM errors JOIN scales USING (item_id, store_id) JOIN weights USING (item_id, store_id)"""

FRAME_COLUMNS = """CAST(date - (SELECT MIN(date) FROM {source}) AS BIGINT) AS time_idx,
    store_id || '_' || item_id AS series_id,
    CAST(has_event AS VARCHAR) AS has_event, '0' AS snap_flag,
    CAST(sales AS DOUBLE) AS sales,
    CASE WHEN sell_price IS NULL THEN '1' ELSE '0' END AS sell_price_missing,
    CAST(day_of_week AS VARCHAR) AS day_of_week, CAST(month AS VARCHAR) AS month,
    COALESCE(
      LAST_VALUE(sell_price IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY date
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      FIRST_VALUE(sell_price IGNORE NULLS) OVER (PARTITION BY item_id, store_id ORDER BY date
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ) AS sell_price"""


def frame(source: str) -> str:
    columns = FRAME_COLUMNS.format(source=source)
    replaced = "has_event, sales, day_of_week, month, sell_price"
    return f"frame AS (SELECT * EXCLUDE ({replaced}), {columns} FROM {source})"


CUT = f"(SELECT MAX(time_idx) - {P.HORIZON} FROM frame)"
SCALING = f"""scaling AS (
  SELECT series_id, AVG(LN(1 + sales)) AS target_center,
         STDDEV_SAMP(LN(1 + sales)) + 0.0009765625 AS target_scale
  FROM frame WHERE time_idx <= {CUT} GROUP BY series_id
)"""


def windows(condition: str, last: str) -> str:
    """Window ends with sizes and sums over 120 rows back and 28 rows ahead."""
    return f"""SELECT series_id, encoder_end_idx, encoder_length, decoder_length, first_idx, last_idx,
  encoder_sales, decoder_sales, ROUND(encoder_target, 3) AS encoder_target,
  ROUND(decoder_target, 3) AS decoder_target, ROUND(target_center, 6) AS target_center,
  ROUND(target_scale, 6) AS target_scale
FROM (
  SELECT series_id, time_idx AS encoder_end_idx, target_center, target_scale,
         COUNT(*) OVER (w ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS encoder_length,
         COUNT(*) OVER (w ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING) AS decoder_length,
         MIN(time_idx) OVER (w ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS first_idx,
         MAX(time_idx) OVER (w ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING) AS last_idx,
         SUM(sales) OVER (w ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS encoder_sales,
         SUM(sales) OVER (w ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING) AS decoder_sales,
         SUM(level) OVER (w ROWS BETWEEN 119 PRECEDING AND CURRENT ROW) AS encoder_target,
         SUM(level) OVER (w ROWS BETWEEN 1 FOLLOWING AND 28 FOLLOWING) AS decoder_target
  FROM (
    SELECT *, (LN(1 + sales) - target_center) / target_scale AS level
    FROM frame JOIN scaling USING (series_id)
  ) WHERE time_idx <= {last}
  WINDOW w AS (PARTITION BY series_id ORDER BY time_idx)
)
WHERE encoder_length = 120 AND decoder_length = 28 AND {condition}"""


CODED = ["store_id", "item_id", "dept_id", "cat_id", "state_id", "has_event", "day_of_week", "month", "sell_price_missing"]
CODES = f"""codes AS (
  SELECT name, value, ROW_NUMBER() OVER (PARTITION BY name ORDER BY value) AS code
  FROM (SELECT DISTINCT name, value FROM (
    SELECT UNNEST([{", ".join(f"'{c}'" for c in CODED)}]) AS name, UNNEST([{", ".join(CODED)}]) AS value
    FROM frame WHERE time_idx <= {CUT}
  ) WHERE value IS NOT NULL)
)"""
SCALES = "scales AS (" + " UNION ALL ".join(
    f"""
  SELECT '{c}' AS name, AVG({c}) AS center,
         CASE STDDEV_POP({c}) WHEN 0 THEN 1 ELSE STDDEV_POP({c}) END AS scale
  FROM frame WHERE time_idx <= {CUT}"""
    for c in ("time_idx", "sell_price")
) + ")"


def code_of(name: str) -> str:
    return f"COALESCE((SELECT code FROM codes WHERE name = '{name}' AND value = frame.{name}), 0) AS {name}_code"


def scaled_value(name: str) -> str:
    part = f"FROM scales WHERE name = '{name}'"
    return f"ROUND(({name} - (SELECT center {part})) / (SELECT scale {part}), 6) AS {name}_scaled"


KEYS = "item_id, store_id, date"


def feature_query(names: list[str]) -> str:
    return query(f"SELECT {KEYS}, {select_features(names)} FROM sales_long")


QUALITY = f"""SELECT UNNEST(['row_count >= 100000', 'required_columns_exist', 'item_id_no_nulls',
    'store_id_no_nulls', 'date_no_nulls', 'sales_between_0_and_1000', 'sell_price_non_negative',
    'lag_features_have_nulls_for_early_rows', 'date_range_reasonable']) AS name,
  UNNEST([c1, true, c3, c4, c5, c6, c7, c8, c9]) AS passed,
  UNNEST([if(c1, 'True', 'False'),
    '[''item_id'', ''store_id'', ''date'', ''sales'', ''sell_price'', ''sales_lag_7'', '
      || '''sales_lag_28'', ''rolling_mean_7'', ''day_of_week'']',
    if(c3, 'True', 'False'), if(c4, 'True', 'False'), if(c5, 'True', 'False'),
    if(c6, 'True', 'False'), if(c7, 'True', 'False'), if(c8, 'True', 'False'),
    if(c9, 'True', 'False')]) AS detail
FROM (
  SELECT COUNT(*) >= 100000 AS c1,
         COUNT(*) FILTER (item_id IS NULL) = 0 AS c3,
         COUNT(*) FILTER (store_id IS NULL) = 0 AS c4,
         COUNT(*) FILTER (date IS NULL) = 0 AS c5,
         MIN(sales) >= 0 AND MAX(sales) <= 1000 AS c6,
         COUNT(*) FILTER (sell_price < 0) = 0 AS c7,
         COUNT(*) FILTER (sales_lag_7 IS NULL) > 0 AS c8,
         MIN(date) >= {dated(P.GATE_FIRST)} AND MAX(date) <= {dated(P.GATE_LAST)} AS c9
  FROM featured
)"""

FEATURE_TABLE = query("SELECT * FROM featured", FEATURED)
COMPLETE = " AND ".join(
    f"{c} IS NOT NULL"
    for c in ["sell_price", "sales_lag_7", "sales_lag_28", "rolling_mean_7", "day_of_week", "sales"]
)

ORACLE: dict[str, str] = {
    "csv_roundtrip": query(
        """SELECT l.item_id, l.dept_id, l.cat_id, l.store_id, l.state_id, l.day,
  CAST(NULLIF(l.sales, 0) AS SMALLINT) AS sales, l.date, l.wm_yr_wk, l.event_name_1, l.event_type_1,
  l.event_name_2, l.event_type_2, l.snap_CA, l.snap_TX, l.snap_WI,
  l.sell_price
FROM sales_long l"""
    ),
    "unpivot_sales": query(
        """SELECT s.item_id, 'DEPT_' || s.item_id AS dept_id, 'CAT' AS cat_id, s.store_id,
  upper(s.store_id[1:2]) AS state_id, cal.d AS day, CAST(daily.units AS SMALLINT) AS sales
FROM series s CROSS JOIN cal
LEFT JOIN daily ON daily.item_id = s.item_id AND daily.store_id = s.store_id
               AND daily.date = cal.date"""
    ),
    "calendar_dates": query("SELECT * EXCLUDE (n) FROM cal"),
    "sales_calendar_price_join": query("SELECT * FROM sales_long"),
    "ingest_summary": query(
        """SELECT 'sales_long_rows' AS name, COUNT(*) AS rows FROM series, cal
UNION ALL SELECT 'joined_rows', COUNT(*) FROM sales_long
UNION ALL SELECT 'calendar_rows', COUNT(*) FROM cal
UNION ALL SELECT 'prices_rows', COUNT(*) FROM prices"""
    ),
    "duplicate_rows": f"""SELECT p_brand || '_' || (p_partkey // {P.PARTS_PER_ITEM}) AS item_id, r_name AS store_id,
  CAST(l_shipdate AS DATE) AS date, COUNT(*) AS count
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
GROUP BY 1, 2, 3 HAVING COUNT(*) > 1""",
    "lag_features": feature_query(["sales_lag_7", "sales_lag_28"]),
    "rolling_means": feature_query(["rolling_mean_7", "rolling_mean_28"]),
    "rolling_std": feature_query(["rolling_std_28"]),
    "price_ratio": feature_query(["price_ratio_28"]),
    "calendar_parts": feature_query(["day_of_week", "month", "year"]),
    "event_flag": query(
        f"SELECT {KEYS}, event_name_1, event_name_2, {select_features(['has_event'])} FROM sales_long"
    ),
    "feature_table": FEATURE_TABLE,
    "feature_table_hot_series": FEATURE_TABLE,
    "quality_report": query(QUALITY, FEATURED),
    "top_items": query("SELECT * FROM top", FEATURED, STORE_ROWS, TOP),
    "top_items_by_volume": query(
        f"""SELECT item_id, CAST(SUM(sales) AS BIGINT) AS cnt FROM store_rows
GROUP BY item_id ORDER BY cnt DESC, item_id LIMIT {P.TOP_ITEMS}""",
        FEATURED,
        STORE_ROWS,
    ),
    "subset_rows": query(f"SELECT {KEYS}, sales FROM subset", *SUBSET_TABLES),
    "time_split": query(
        f"""SELECT {KEYS}, sales, CASE WHEN {IN_TRAINING} THEN 'train' ELSE 'val' END AS part
FROM sales_long WHERE {IN_TRAINING} OR {IN_VALIDATION}"""
    ),
    "training_rows": query(
        f"""SELECT {KEYS}, sell_price, sales_lag_7, sales_lag_28,
  rolling_mean_7, day_of_week, sales
FROM subset WHERE {IN_TRAINING} AND {COMPLETE}""",
        *SUBSET_TABLES,
    ),
    "prediction_frame": query(
        f"""SELECT {KEYS}, sales AS actual, CAST(sales_lag_28 AS DOUBLE) AS predicted
FROM featured WHERE {IN_VALIDATION}""",
        FEATURED,
    ),
    "mae_naive": query(
        f"SELECT ROUND(AVG(ABS(actual - predicted)), 6) AS mae FROM naive WHERE {IN_VALIDATION}",
        NAIVE,
    ),
    "wrmsse_scales": query(
        "SELECT item_id, store_id, ROUND(scale, 6) AS scale FROM scales", *SCORE_TABLES
    ),
    "wrmsse_series": query(
        """SELECT item_id, store_id, ROUND(mse, 6) AS mse, ROUND(scale, 6) AS scale,
  ROUND(raw_weight, 6) AS raw_weight, ROUND(weight, 6) AS weight,
  ROUND(SQRT(mse / scale), 6) AS rmsse
FROM errors JOIN scales USING (item_id, store_id) JOIN weights USING (item_id, store_id)""",
        *SCORE_TABLES,
        UNITS,
    ),
    "wrmsse_units": query(SCORE, *SCORE_TABLES, UNITS),
    "wrmsse_revenue": query(SCORE, *SCORE_TABLES, REVENUE),
    "residual_features": query(
        """SELECT * REPLACE (ROUND(residual_pct, 6) AS residual_pct,
  ROUND(residual_rolling_mean, 6) AS residual_rolling_mean,
  ROUND(residual_rolling_std, 6) AS residual_rolling_std)
FROM residuals""",
        NAIVE,
        RESIDUALS,
    ),
    "zscore_anomalies": query(
        f"""SELECT {KEYS}, residual, ROUND(z, 6) AS z_score,
  CASE WHEN z > 3 THEN 1 ELSE 0 END AS anomaly_stat
FROM (
  SELECT *, abs_residual / CASE WHEN residual_rolling_std < 0.1 THEN 0.1
                                ELSE residual_rolling_std END AS z
  FROM residuals
)""",
        NAIVE,
        RESIDUALS,
    ),
    "contamination_cutoff": query(
        """SELECT ROUND(ANY_VALUE(q), 6) AS cutoff, COUNT(*) FILTER (abs_residual > q) AS beyond
FROM residuals, (SELECT QUANTILE_CONT(abs_residual, 0.99) AS q FROM residuals)""",
        NAIVE,
        RESIDUALS,
    ),
    "combined_flags": query(
        f"""SELECT *, CASE WHEN anomaly_stat = 1 OR anomaly_iso = 1 THEN 1 ELSE 0 END AS is_anomaly
FROM (
  SELECT {KEYS}, abs_residual,
         CASE WHEN abs_residual / CASE WHEN residual_rolling_std < 0.1 THEN 0.1
                                       ELSE residual_rolling_std END > 3 THEN 1 ELSE 0 END AS anomaly_stat,
         CASE WHEN abs_residual > (SELECT QUANTILE_CONT(abs_residual, 0.99) FROM residuals)
              THEN 1 ELSE 0 END AS anomaly_iso
  FROM residuals
)""",
        NAIVE,
        RESIDUALS,
    ),
    "predictions_csv": query(
        """SELECT * REPLACE (CAST(actual AS INTEGER) AS actual, ROUND(residual_pct, 6) AS residual_pct,
  ROUND(residual_rolling_mean, 6) AS residual_rolling_mean,
  ROUND(residual_rolling_std, 6) AS residual_rolling_std)
FROM residuals""",
        NAIVE,
        RESIDUALS,
    ),
    "best_of_naive": query(
        """SELECT model, ROUND(mae, 6) AS mae, ROUND(wrmsse, 6) AS wrmsse, mae = MIN(mae) OVER () AS best
FROM maes JOIN scored USING (model)""",
        *SCORE_TABLES,
        UNITS,
        f"""guesses AS (
  SELECT item_id, store_id, sales, unnest(['sales_lag_7', 'sales_lag_28']) AS model,
         unnest([CAST(sales_lag_7 AS DOUBLE), CAST(sales_lag_28 AS DOUBLE)]) AS pred
  FROM featured WHERE {IN_VALIDATION}
)""",
        "maes AS (SELECT model, AVG(ABS(sales - pred)) AS mae FROM guesses GROUP BY model)",
        """scored AS (
  SELECT model, SUM(weight * SQRT(mse / scale)) AS wrmsse
  FROM (
    SELECT model, item_id, store_id, AVG((sales - pred) * (sales - pred)) AS mse
    FROM guesses GROUP BY model, item_id, store_id
  ) JOIN scales USING (item_id, store_id) JOIN weights USING (item_id, store_id)
  GROUP BY model
)""",
    ),
    "stored_tables": query(
        f"""SELECT COUNT(*) AS rows, COUNT(DISTINCT store_id || '_' || item_id) AS series,
  CAST(SUM(sales) AS BIGINT) AS units, (SELECT BOOL_AND(passed) FROM ({QUALITY})) AS gate
FROM featured""",
        FEATURED,
    ),
    "horizon_recursion": query(
        f"""SELECT item_id, store_id, CAST(last_day + step AS DATE) AS date, ROUND(predicted, 6) AS predicted
FROM ahead, ends WHERE step > 0""",
        f"""ahead AS (
  SELECT item_id, store_id, 0 AS step, LIST(CAST(sales AS DOUBLE) ORDER BY date) AS history,
         CAST(NULL AS DOUBLE) AS predicted
  FROM sales_long, ends WHERE date > last_day - 28 GROUP BY item_id, store_id
  UNION ALL
  SELECT item_id, store_id, step + 1, LIST_APPEND(history[2:28], next), next
  FROM (
    SELECT *, GREATEST(0.5 * history[22] + 0.5 * (LIST_SUM(history[22:28]) / 7), 0) AS next
    FROM ahead WHERE step < {P.HORIZON}
  )
)""",
    ).replace("WITH", "WITH RECURSIVE", 1),
    "requested_forecasts": query(
        f"""SELECT item_id, store_id, CAST(last_day + step AS DATE) AS date, ROUND(predicted, 6) AS predicted
FROM ahead, ends WHERE step > 0""",
        f"""requests AS (
  SELECT item_id, store_id, (COUNT(*) % {P.REQUEST_WEEKS} + 1) * 7 AS horizon FROM daily GROUP BY item_id, store_id
)""",
        f"""ahead AS (
  SELECT item_id, store_id, horizon, 0 AS step, LIST(CAST(sales AS DOUBLE) ORDER BY date) AS history,
         CAST(NULL AS DOUBLE) AS predicted
  FROM sales_long JOIN requests USING (item_id, store_id), ends
  WHERE date > last_day - 28 GROUP BY item_id, store_id, horizon
  UNION ALL
  SELECT item_id, store_id, horizon, step + 1, LIST_APPEND(history[2:28], next), next
  FROM (
    SELECT *, GREATEST(0.5 * history[22] + 0.5 * (LIST_SUM(history[22:28]) / 7), 0) AS next
    FROM ahead WHERE step < horizon
  )
)""",
    ).replace("WITH", "WITH RECURSIVE", 1),
    "tweedie_step": query(
        f"""SELECT {KEYS}, sales,
  ROUND(EXP(0.9 * f) - sales * EXP(-0.1 * f), 6) AS slope,
  ROUND(0.9 * EXP(0.9 * f) + 0.1 * sales * EXP(-0.1 * f), 6) AS curvature
FROM (
  SELECT *, LN(AVG(sales) OVER ()) AS f FROM subset WHERE {IN_TRAINING} AND {COMPLETE}
)""",
        *SUBSET_TABLES,
    ),
    "sequence_frame": query("SELECT * FROM frame", FEATURED, frame("featured")),
    "price_fill": query(
        """SELECT series_id, time_idx, sell_price, sell_price_missing
FROM frame""",
        FEATURED,
        frame("featured"),
    ),
    "target_scaling": query(
        """SELECT series_id, ROUND(target_center, 6) AS target_center,
  ROUND(target_scale, 6) AS target_scale FROM scaling""",
        FEATURED,
        frame("featured"),
        SCALING,
    ),
    "category_codes": query("SELECT name, value, code FROM codes", FEATURED, frame("featured"), CODES),
    "real_scalers": query(
        "SELECT name, ROUND(center, 6) AS center, ROUND(scale, 6) AS scale FROM scales",
        FEATURED,
        frame("featured"),
        SCALES,
    ),
    "encoded_frame": query(
        f"""SELECT series_id, time_idx, {", ".join(code_of(c) for c in CODED)},
  {scaled_value("time_idx")}, {scaled_value("sell_price")} FROM frame""",
        FEATURED,
        frame("featured"),
        CODES,
        SCALES,
    ),
    "missing_steps": query(
        """SELECT series_id, item_id, store_id, date, time_idx, step
FROM (
  SELECT store_id || '_' || item_id AS series_id, item_id, store_id, daily.date,
         CAST(cal.n - 1 AS BIGINT) AS time_idx,
         CAST(cal.n - LAG(cal.n) OVER (PARTITION BY item_id, store_id ORDER BY daily.date) AS BIGINT)
           AS step
  FROM daily JOIN cal USING (date)
) WHERE step <> 1"""
    ),
    "encoder_decoder_windows": query(windows("true", CUT), FEATURED, frame("featured"), SCALING),
    "validation_windows": query(
        windows(f"encoder_end_idx = {CUT}", "(SELECT MAX(time_idx) FROM frame)"),
        FEATURED,
        frame("featured"),
        SCALING,
    ),
    "horizon_features": query(
        f"""SELECT item_id, store_id, CAST(date + 1 AS DATE) AS date, price AS sell_price,
  CAST(lag_6 AS DOUBLE) AS sales_lag_7, CAST(lag_27 AS DOUBLE) AS sales_lag_28,
  ROUND(mean_7, 6) AS rolling_mean_7, EXTRACT(DOW FROM date + 1) AS day_of_week
FROM (
  SELECT *, LAG(sales, 6) OVER w AS lag_6, LAG(sales, 27) OVER w AS lag_27,
         AVG(sales) OVER (w ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean_7,
         LAST_VALUE(sell_price IGNORE NULLS) OVER
           (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS price
  FROM sales_long WINDOW w AS ({SERIES_WINDOW})
) WHERE date = (SELECT last_day FROM ends)"""
    ),
}
