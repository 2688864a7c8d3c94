"""DuckDB twins of the queries, written from the meaning of the operators, not from the Spark code."""

from __future__ import annotations

LINE_COLUMNS = (
    "event_time, event_type, product_id, category_id, category_code, brand, price, "
    "user_id, user_session, user_name, user_surname"
)
BRONZE_COLUMNS = f"{LINE_COLUMNS}, _file_name, _ingested_at"
FACT_COLUMNS = (
    "event_id, event_timestamp, event_type, product_id, user_id, price, user_session, source_file, _loaded_at"
)

# -- the bronze view over the test tables


def _lines(dirty: bool) -> str:
    """CTE ``lines``: one row per delivered event with eid and batch."""
    time = "strftime(e.ts, '%Y-%m-%d %H:%M:%S') || ' UTC'"
    product = "CAST(e.k AS VARCHAR)"
    price = "CAST(CASE WHEN e.eid % 97 = 0 THEN 0.0 ELSE e.value END AS VARCHAR)"
    user = "CAST(e.user_id AS VARCHAR)"
    kind = "e.event_type"
    if dirty:
        time = (
            "CASE WHEN e.eid % 103 = 0 THEN 'not-a-time' "
            "WHEN e.eid % 127 = 0 THEN strftime(e.ts, '%Y-%m-%dT%H:%M:%S') "
            "WHEN e.eid % 137 = 0 THEN strftime(e.ts, '%Y/%m/%d %H:%M:%S') "
            f"WHEN e.eid % 139 = 0 THEN '+2019-10' ELSE {time} END"
        )
        product = f"CASE WHEN e.eid % 107 = 0 THEN 'abc' WHEN e.eid % 131 = 0 THEN {product} || '.5' ELSE {product} END"
        price = f"CASE WHEN e.eid % 89 = 0 THEN 'n/a' ELSE {price} END"
        user = f"CASE WHEN e.eid % 109 = 0 THEN '3000000000' ELSE {user} END"
        kind = "CASE WHEN e.eid % 113 <> 0 THEN e.event_type END"
    return f"""
source_events AS (
    SELECT event_id AS eid, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
    FROM events
),
single_lines AS (
    SELECT e.eid, e.k,
           {time} AS event_time,
           {kind} AS event_type,
           {product} AS product_id,
           CAST(p.p_size AS VARCHAR) AS category_id,
           CASE WHEN p.p_size % 11 <> 0
                THEN lower(p.p_type) || '.' || replace(p.p_name, ' ', '.') END AS category_code,
           CASE WHEN p.p_size % 7 = 0 THEN '  ' ELSE p.p_brand END AS brand,
           {price} AS price,
           {user} AS user_id,
           CASE WHEN e.eid % 101 <> 0 THEN 's-' || CAST(e.eid AS VARCHAR) END AS user_session,
           c.c_name AS user_name,
           c.c_mktsegment AS user_surname
    FROM source_events e
    LEFT JOIN part p ON p.p_partkey = e.k
    LEFT JOIN customer c ON c.c_custkey = e.user_id
),
lines AS (
    SELECT eid, 1 AS batch, {LINE_COLUMNS} FROM single_lines WHERE eid % 5 <> 4
    UNION ALL
    SELECT eid, 2 AS batch, event_time, event_type, product_id, category_id, category_code,
           CASE WHEN k % 5 = 0 THEN brand || '-v2' ELSE brand END AS brand,
           price, user_id, user_session, user_name, user_surname
    FROM single_lines WHERE eid % 5 = 4 OR eid % 10 = 0
)"""


def _bronze(dirty: bool = False) -> str:
    return f"""{_lines(dirty)},
bronze AS (
    SELECT {LINE_COLUMNS}, 'batch_' || CAST(batch AS VARCHAR) || '.csv' AS _file_name,
           CASE batch WHEN 1 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-03-02 00:00:00' END
               AS _ingested_at
    FROM lines
)"""


# -- silver

_TIME = r"regexp_replace(event_time, '\s+UTC\s*$', '')"


def _id_text(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, '\\s*[+-]?\\d+\\s*') "
        f"THEN CAST(CAST({column} AS BIGINT) AS VARCHAR) ELSE {column} END"
    )


EVENT_ID = (
    f"md5(COALESCE(CAST(TRY_CAST({_TIME} AS TIMESTAMP) AS VARCHAR), {_TIME}) || event_type || "
    f"{_id_text('user_id')} || {_id_text('product_id')} || user_session)"
)

_TYPED_COLUMNS = f"""{EVENT_ID} AS event_id, TRY_CAST({_TIME} AS TIMESTAMP) AS event_timestamp, event_type,
           TRY_CAST(product_id AS INTEGER) AS product_id, TRY_CAST(user_id AS INTEGER) AS user_id,
           TRY_CAST(price AS DOUBLE) AS price, user_session, _file_name AS source_file, _ingested_at"""


def _fact(source: str, loaded_at: str, name: str) -> str:
    """CTEs that end in ``name``: newest ingest per event id of ``source``."""
    return f"""
{name}_typed AS (SELECT {_TYPED_COLUMNS} FROM {source}),
{name}_ranked AS (
    SELECT *, row_number() OVER (
        PARTITION BY event_id
        ORDER BY _ingested_at DESC NULLS LAST, source_file DESC NULLS LAST, event_timestamp DESC NULLS LAST,
                 event_type DESC NULLS LAST, product_id DESC NULLS LAST, user_id DESC NULLS LAST,
                 price DESC NULLS LAST, user_session DESC NULLS LAST) AS place
    FROM {name}_typed
),
{name} AS (
    SELECT event_id, event_timestamp, event_type, product_id, user_id, price, user_session, source_file,
           TIMESTAMP '{loaded_at}' AS _loaded_at
    FROM {name}_ranked WHERE place = 1
)"""


_ATTRIBUTES = {"product_id": ("brand", "category_code"), "user_id": ("user_name", "user_surname")}


def _dimension(source: str, key: str, name: str) -> str:
    first, second = _ATTRIBUTES[key]
    levels = ""
    if key == "product_id":
        levels = "".join(f" split_part(category_code, '.', {n}) AS category_l{n}," for n in (1, 2, 3))
    return f"""
{name}_ranked AS (
    SELECT TRY_CAST({key} AS INTEGER) AS {key}, {first}, {second}, _ingested_at,
           row_number() OVER (
               PARTITION BY TRY_CAST({key} AS INTEGER)
               ORDER BY _ingested_at DESC, TRY_CAST({_TIME} AS TIMESTAMP) DESC NULLS LAST,
                        {first} DESC NULLS LAST, {second} DESC NULLS LAST) AS place
    FROM {source} WHERE TRY_CAST({key} AS INTEGER) IS NOT NULL
),
{name} AS (
    SELECT {key}, {first}, {second},{levels} _ingested_at AS _updated_at FROM {name}_ranked WHERE place = 1
)"""


RUN_1 = "2024-03-01 12:00:00"
RUN_2 = "2024-03-02 12:00:00"
MEASURED = "2024-03-02 18:30:00"


def _fact_two_runs() -> str:
    """CTEs ``fact_1`` (after run 1) and ``fact`` (after run 2)."""
    return f"""
bronze_1 AS (SELECT * FROM bronze WHERE _ingested_at <= TIMESTAMP '{RUN_1}'),{_fact("bronze_1", RUN_1, "fact_1")},
fact_delta AS (
    SELECT * FROM bronze
    WHERE _ingested_at > (SELECT COALESCE(max(_loaded_at), TIMESTAMP '1970-01-01') FROM fact_1)
),{_fact("fact_delta", RUN_2, "fact_2")},
fact AS (
    SELECT * FROM fact_1
    UNION ALL
    SELECT * FROM fact_2 WHERE NOT EXISTS (SELECT 1 FROM fact_1 WHERE fact_1.event_id = fact_2.event_id)
)"""


def _dimension_two_runs(key: str, name: str) -> str:
    return f"""
{name}_bronze_1 AS (SELECT * FROM bronze WHERE _ingested_at <= TIMESTAMP '{RUN_1}'),
{_dimension(f"{name}_bronze_1", key, f"{name}_1")},
{name}_delta AS (SELECT * FROM bronze WHERE _ingested_at > (SELECT max(_updated_at) FROM {name}_1)),
{_dimension(f"{name}_delta", key, f"{name}_2")},
{name} AS (
    SELECT * FROM {name}_2
    UNION ALL
    SELECT * FROM {name}_1 WHERE {key} NOT IN (SELECT {key} FROM {name}_2)
)"""


# -- gold


def _bucket(expression: str) -> str:
    return f"COALESCE(NULLIF(trim({expression}), ''), '__UNKNOWN__')"


_MEASURES = """count(*) FILTER (event_type = 'view') AS total_views,
           count(*) FILTER (event_type = 'purchase') AS total_purchases,
           round(COALESCE(sum(price) FILTER (event_type = 'purchase'), 0), 2) AS revenue,
           round(100.0 * count(*) FILTER (event_type = 'purchase')
                 / NULLIF(count(*) FILTER (event_type = 'view'), 0), 2) AS conversion_rate_pct"""


def _mart(fact: str, products: str, refreshed_at: str, name: str, dates: str | None = None) -> str:
    scope = f"IN (SELECT report_date FROM {dates})" if dates else "IS NOT NULL"
    return f"""
{name} AS (
    SELECT CAST(f.event_timestamp AS DATE) AS report_date, {_bucket("d.brand")} AS brand,
           {_bucket("d.category_l1")} AS category_l1, {_MEASURES}, TIMESTAMP '{refreshed_at}' AS _refreshed_at
    FROM {fact} f LEFT JOIN {products} d USING (product_id)
    WHERE CAST(f.event_timestamp AS DATE) {scope}
    GROUP BY ALL
)"""


def _full() -> str:
    """CTEs ``bronze``, ``fact``, ``products`` and ``mart`` of one full load."""
    return (
        f"{_bronze()},{_fact('bronze', RUN_2, 'fact')},{_dimension('bronze', 'product_id', 'products')},"
        f"{_mart('fact', 'products', RUN_2, 'mart')}"
    )


def _incremental() -> str:
    """CTEs of two runs: ``fact``, ``products``, ``mart_1``, ``dates`` and ``mart_2`` (recomputed dates)."""
    return f"""{_bronze()},{_fact_two_runs()},{_dimension_two_runs("product_id", "products")},
{_mart("fact_1", "products_1", RUN_1, "mart_1")},
dates AS (
    SELECT DISTINCT CAST(event_timestamp AS DATE) AS report_date FROM fact
    WHERE _loaded_at > (SELECT max(_refreshed_at) FROM mart_1)
),{_mart("fact", "products", RUN_2, "mart_2", "dates")}"""


# -- data quality

_COMPLETE = "event_timestamp IS NOT NULL AND event_type IS NOT NULL AND product_id IS NOT NULL AND user_id IS NOT NULL"
_BAD_PRICE = "event_type = 'purchase' AND (price IS NULL OR price <= 0)"

_METRIC_ROWS = {
    "dq_row_count": "SELECT 'silver_fact_events_row_count' AS metric_name, "
    "CAST(count(*) AS VARCHAR) AS metric_value, 'count' AS unit FROM fact",
    "dq_completeness": "SELECT 'silver_fact_events_completeness_key_cols_pct' AS metric_name, "
    f"CAST(round(100.0 * count(*) FILTER ({_COMPLETE}) / count(*), 4) AS VARCHAR) AS metric_value, "
    "'percent' AS unit FROM fact",
    "dq_uniqueness": "SELECT 'silver_fact_events_event_id_uniqueness_pct' AS metric_name, "
    "CAST(round(100.0 * count(DISTINCT event_id) / count(*), 4) AS VARCHAR) AS metric_value, "
    "'percent' AS unit FROM fact",
    "dq_freshness": "SELECT 'silver_fact_events_freshness_hours' AS metric_name, "
    f"CAST(round(date_diff('second', max(_loaded_at), TIMESTAMP '{MEASURED}') / 3600.0, 4) AS VARCHAR) "
    "AS metric_value, 'hours' AS unit FROM fact HAVING count(*) > 0",
    "dq_invalid_purchase_price": "SELECT 'silver_fact_events_invalid_purchase_price_row_count' AS metric_name, "
    f"CAST(count(*) FILTER ({_BAD_PRICE}) AS VARCHAR) AS metric_value, 'count' AS unit FROM fact",
}


def _metrics(*names: str) -> str:
    rows = " UNION ALL ".join(f"({_METRIC_ROWS[name]})" for name in names)
    return (
        f"WITH {_bronze(dirty=True)},{_fact_two_runs()} "
        f"SELECT *, TIMESTAMP '{MEASURED}' AS measured_at FROM ({rows})"
    )


def _json(columns: str) -> str:
    pairs = ", ".join(f"'{c}', COALESCE({c}, '')" for c in columns.split(", "))
    return f"CAST(json_object({pairs}) AS VARCHAR)"


_NO_CATEGORY_ID = LINE_COLUMNS.replace("category_id", "CASE WHEN batch = 1 THEN category_id END AS category_id")
_NO_BRAND = LINE_COLUMNS.replace("brand", "CASE WHEN eid % 61 <> 0 THEN brand END AS brand")

_WELL_FORMED = "eid % 53 <> 0 AND eid % 59 <> 0 AND eid % 71 <> 0 AND eid % 73 <> 0"
_CSV_LINE = " || ',' || ".join(
    "brand || ',more'" if c == "brand" else f"COALESCE({c}, '')" for c in LINE_COLUMNS.split(", ")
)

ORACLE: dict[str, str] = {
    "bronze_ingest": f"WITH {_bronze()} SELECT {BRONZE_COLUMNS} FROM bronze",
    "ingest_summary": f"""WITH {_bronze()}
        SELECT _file_name, count(*) AS rows_loaded, max(_ingested_at) AS ingested_at
        FROM bronze GROUP BY _file_name""",
    "skip_ingested_files": f"""WITH {_bronze()}
        SELECT {LINE_COLUMNS}, _file_name FROM bronze
        WHERE _file_name NOT IN (SELECT _file_name FROM bronze WHERE _ingested_at <= TIMESTAMP '{RUN_1}')""",
    "union_batches": f"WITH {_lines(False)} SELECT eid, {_NO_CATEGORY_ID} FROM lines",
    "encode_events": f"WITH {_lines(False)} SELECT {_json(LINE_COLUMNS)} AS value FROM lines",
    "decode_events": f"WITH {_lines(False)} SELECT {_NO_BRAND} FROM lines WHERE {_WELL_FORMED}",
    "malformed_messages": f"""WITH {_lines(False)}, messages AS (
            SELECT eid, {_json(LINE_COLUMNS)} AS whole FROM lines WHERE NOT ({_WELL_FORMED}))
        SELECT CASE WHEN eid % 53 = 0 THEN 'not json ' || whole
                    WHEN eid % 59 = 0 THEN '[' || whole || ']'
                    WHEN eid % 71 = 0 THEN whole || ' ' || whole
                    ELSE replace(whole, '"', '''') END AS value FROM messages""",
    "csv_scan": f"WITH {_lines(False)} SELECT {LINE_COLUMNS} FROM lines WHERE eid % 59 <> 0 OR brand IS NULL",
    "csv_rejects": f"""WITH {_lines(False)}
        SELECT {_CSV_LINE} AS value FROM lines WHERE eid % 59 = 0 AND brand IS NOT NULL""",
    "event_id_hash": f"WITH {_lines(True)} SELECT eid, batch, {EVENT_ID} AS event_id FROM lines",
    "typed_events": f"WITH {_bronze(dirty=True)} SELECT {_TYPED_COLUMNS} FROM bronze",
    "category_levels": f"""WITH {_lines(False)}
        SELECT eid, batch, category_code, split_part(category_code, '.', 1) AS category_l1,
               split_part(category_code, '.', 2) AS category_l2, split_part(category_code, '.', 3) AS category_l3
        FROM lines""",
    "normalize_unknown": f"""WITH {_lines(False)}
        SELECT eid, batch, {_bucket("brand")} AS brand,
               {_bucket("split_part(category_code, '.', 1)")} AS category_l1
        FROM lines""",
    "events_by_day": f"""WITH {_bronze(dirty=True)}
        SELECT CAST(TRY_CAST({_TIME} AS TIMESTAMP) AS DATE) AS report_date, event_type, count(*) AS events
        FROM bronze GROUP BY ALL""",
    "fact_events": f"WITH {_bronze()},{_fact('bronze', RUN_2, 'fact')} SELECT {FACT_COLUMNS} FROM fact",
    "null_id_quarantine": f"""WITH {_bronze()}, typed AS (SELECT {_TYPED_COLUMNS} FROM bronze)
        SELECT * FROM typed WHERE event_id IS NULL""",
    "dim_products": f"WITH {_bronze()},{_dimension('bronze', 'product_id', 'products')} SELECT * FROM products",
    "dim_users": f"WITH {_bronze()},{_dimension('bronze', 'user_id', 'users')} SELECT * FROM users",
    "incremental_delta": f"""WITH {_bronze()},{_fact_two_runs()} SELECT {BRONZE_COLUMNS} FROM fact_delta""",
    "fact_events_incremental": f"WITH {_bronze()},{_fact_two_runs()} SELECT {FACT_COLUMNS} FROM fact",
    "dim_products_merge": f"WITH {_bronze()},{_dimension_two_runs('product_id', 'products')} SELECT * FROM products",
    "dim_users_merge": f"WITH {_bronze()},{_dimension_two_runs('user_id', 'users')} SELECT * FROM users",
    "affected_dates": f"WITH {_incremental()} SELECT report_date FROM dates",
    "affected_dates_semi": f"""WITH {_incremental()} SELECT {FACT_COLUMNS} FROM fact
        WHERE CAST(event_timestamp AS DATE) IN (SELECT report_date FROM dates)""",
    "marketing_report": f"WITH {_full()} SELECT * FROM mart",
    "marketing_report_incremental": f"""WITH {_incremental()}
        SELECT * FROM mart_2
        UNION ALL
        SELECT * FROM mart_1 WHERE NOT EXISTS (
            SELECT 1 FROM mart_2
            WHERE mart_2.report_date = mart_1.report_date AND mart_2.brand = mart_1.brand
              AND mart_2.category_l1 = mart_1.category_l1)""",
    "marketing_report_replace_dates": f"""WITH {_incremental()}
        SELECT * FROM mart_2
        UNION ALL
        SELECT * FROM mart_1 WHERE report_date NOT IN (SELECT report_date FROM dates WHERE report_date IS NOT NULL)""",
    "revenue_by_day_brand": f"""WITH {_bronze()},{_fact("bronze", RUN_2, "fact")},
        {_dimension("bronze", "product_id", "products")}
        SELECT CAST(event_timestamp AS DATE) AS report_date, {_bucket("brand")} AS brand,
               round(COALESCE(sum(CASE WHEN event_type = 'purchase' THEN price END), 0), 2) AS revenue
        FROM fact LEFT JOIN products USING (product_id) GROUP BY ALL""",
    "conversion_rate": f"""WITH {_bronze()},{_fact("bronze", RUN_2, "fact")},
        {_dimension("bronze", "product_id", "products")},
        totals AS (
            SELECT {_bucket("brand")} AS brand, count(*) FILTER (event_type = 'view') AS total_views,
                   count(*) FILTER (event_type = 'purchase') AS total_purchases
            FROM fact LEFT JOIN products USING (product_id) GROUP BY ALL
        )
        SELECT *, round(100.0 * total_purchases / NULLIF(total_views, 0), 2) AS conversion_rate_pct FROM totals""",
    "latest_report_top20": f"""WITH {_full()}
        SELECT * FROM mart ORDER BY report_date DESC, brand, category_l1 LIMIT 20""",
    "fact_dim_join": f"""WITH {_full()}
        SELECT event_id, event_timestamp, event_type, product_id, brand, category_l1
        FROM fact LEFT JOIN products USING (product_id)""",
    "fact_dim_preview": f"""WITH {_full()}
        SELECT event_id, event_timestamp, event_type, product_id, brand, category_l1
        FROM fact LEFT JOIN products USING (product_id)
        ORDER BY event_id NULLS LAST, event_timestamp NULLS LAST, product_id NULLS LAST LIMIT 50""",
    "raw_marketing_mart": f"""WITH {_bronze(dirty=True)},
        events_in AS (
            SELECT CAST(try_strptime({_TIME}, '%Y-%m-%d %H:%M:%S') AS DATE) AS report_date,
                   {_bucket("brand")} AS brand, {_bucket("split_part(category_code, '.', 1)")} AS category_l1,
                   event_type, TRY_CAST(price AS DOUBLE) AS price
            FROM bronze
        )
        SELECT report_date, brand, category_l1, {_MEASURES}, TIMESTAMP '{RUN_2}' AS _refreshed_at
        FROM events_in GROUP BY ALL""",
    **{name: _metrics(name) for name in _METRIC_ROWS},
    "dq_pipeline_metrics": _metrics(*_METRIC_ROWS),
    "check_completeness": f"""WITH {_bronze()},{_fact("bronze", RUN_2, "whole")},
        fact AS (SELECT * REPLACE (CASE WHEN product_id % 10 <> 0 THEN product_id END AS product_id) FROM whole)
        SELECT 100.0 * count(*) FILTER ({_COMPLETE}) / count(*) AS completeness_pct FROM fact
        HAVING 100.0 * count(*) FILTER ({_COMPLETE}) / count(*) < 95.0""",
    "dup_event_ids": f"""WITH {_bronze()},{_fact_two_runs()},
        doubled AS (SELECT event_id FROM fact UNION ALL SELECT event_id FROM fact WHERE product_id % 10 = 0)
        SELECT event_id, count(*) AS cnt FROM doubled GROUP BY event_id HAVING count(*) > 1""",
    "bad_purchase_prices": f"""WITH {_bronze(dirty=True)},{_fact("bronze", RUN_2, "fact")}
        SELECT event_id, event_type, price FROM fact WHERE {_BAD_PRICE}""",
    "dup_mart_grain": f"""WITH {_full()},
        doubled AS (SELECT * FROM mart UNION ALL SELECT * FROM mart WHERE brand = '__UNKNOWN__')
        SELECT report_date, brand, category_l1, count(*) AS row_count
        FROM doubled GROUP BY ALL HAVING count(*) > 1""",
}

_NO_FILE = FACT_COLUMNS.replace(" source_file,", "")

# The same results by way of files, streams and the warehouse's own builds.
ORACLE |= {
    "warehouse_mart": ORACLE["marketing_report_incremental"],
    "warehouse_replace_dates": ORACLE["marketing_report_replace_dates"],
    "warehouse_full_refresh": ORACLE["marketing_report"],
    "warehouse_fact": f"WITH {_bronze()},{_fact_two_runs()} SELECT {_NO_FILE} FROM fact",
    "warehouse_metrics": f"WITH {_bronze()},{_fact_two_runs()} SELECT *, TIMESTAMP '{RUN_2}' AS measured_at FROM ("
    + " UNION ALL ".join(f"({row.replace(MEASURED, RUN_2)})" for row in _METRIC_ROWS.values())
    + ")",
    "late_load_build": f"""WITH {_bronze()},
        early AS (SELECT * FROM bronze WHERE _file_name = 'batch_1.csv'),{_fact("early", RUN_1, "fact_1")},
        late AS (SELECT * FROM bronze WHERE _file_name = 'batch_2.csv'),{_fact("late", RUN_2, "fact_2")}
        SELECT {FACT_COLUMNS} FROM fact_1
        UNION ALL
        SELECT {FACT_COLUMNS} FROM fact_2
        WHERE NOT EXISTS (SELECT 1 FROM fact_1 WHERE fact_1.event_id = fact_2.event_id)""",
    "raw_mart_job": ORACLE["raw_marketing_mart"],
    "stream_to_bronze": f"WITH {_lines(False)} SELECT {LINE_COLUMNS} FROM lines",
    "stream_rejects": ORACLE["csv_rejects"],
    "warehouse_refresh_same_time": ORACLE["marketing_report"],
    "upsert_violations": f"""WITH {_bronze(dirty=True)}, typed AS (SELECT {_TYPED_COLUMNS} FROM bronze)
        SELECT product_id, count(*) AS row_count FROM typed GROUP BY product_id
        HAVING count(*) > 1 OR product_id IS NULL""",
    "ingest_ledger": f"""WITH {_lines(False)}
        SELECT CASE batch WHEN 1 THEN TIMESTAMP '2024-03-01 00:00:00' ELSE TIMESTAMP '2024-03-02 00:00:00' END AS ingested_at,
               count(*) FILTER (WHERE eid % 59 <> 0 OR brand IS NULL) AS rows_loaded,
               count(*) FILTER (WHERE eid % 59 = 0 AND brand IS NOT NULL) AS rows_rejected
        FROM lines GROUP BY batch""",
    "stream_ingest_summary": f"""WITH {_lines(False)}
        SELECT count(*) FILTER (WHERE {_WELL_FORMED}) AS rows_loaded,
               count(*) FILTER (WHERE NOT ({_WELL_FORMED})) AS rows_rejected,
               count(*) FILTER (WHERE {_WELL_FORMED}) AS rows_in_bronze,
               count(*) FILTER (WHERE NOT ({_WELL_FORMED})) AS rows_in_quarantine FROM lines""",
    "contract_violations": f"""WITH {_bronze()},{_fact("bronze", RUN_2, "fact")}
        SELECT 'fact_events' AS table_name, column_name, declared, found, (SELECT count(*) FROM fact) AS row_count
        FROM (VALUES ('price', 'double', 'float'), ('user_session', 'string', NULL), ('campaign', NULL, 'string'))
             AS drift(column_name, declared, found)""",
}
