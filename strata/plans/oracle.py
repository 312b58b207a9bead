"""The SQL each query is checked against, in DuckDB's dialect, written independently of the queries.

Money is summed as decimals and divided after the sum, so both sides give the same double. Rounding
is done only where a report rounds.
"""

from __future__ import annotations

# The trip-shaped view over lineitem.
TRIPS = """
k AS (
  SELECT *,
    CASE WHEN l_linenumber = 2 THEN 0
         ELSE CAST((l_orderkey*37 + l_linenumber*101) % 1440 AS INT) END AS start_min,
    CASE WHEN l_partkey % 211 = 0 THEN 1500
         ELSE CAST((l_partkey*13 + l_linenumber) % 240 - 5 AS INT) END AS dur_min,
    CASE WHEN l_partkey % 97 = 0 THEN -CAST(l_extendedprice AS DECIMAL(12,2))
         ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS fare_d,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(16,4)) AS tip_d
  FROM lineitem),
trips AS (
  SELECT CAST(l_suppkey % 2 + 1 AS INT) AS VendorID,
    l_shipdate + to_minutes(start_min) AS tpep_pickup_datetime,
    l_shipdate + to_minutes(start_min + dur_min) AS tpep_dropoff_datetime,
    CAST(CAST(l_quantity AS BIGINT) % 7 AS BIGINT) AS passenger_count,
    CASE WHEN l_linenumber = 7 THEN 0.0E0 ELSE l_quantity * 0.25E0 END AS trip_distance,
    CAST(l_partkey % 7 + 1 AS BIGINT) AS RatecodeID,
    CAST(l_partkey % 265 + 1 AS INT) AS PULocationID,
    CAST(l_orderkey % 265 + 1 AS INT) AS DOLocationID,
    CAST(fare_d AS DOUBLE) AS fare_amount,
    CAST(tip_d AS DOUBLE) AS tip_amount,
    CASE WHEN l_suppkey = 17 THEN -1.0E0
         WHEN l_suppkey % 31 = 0 THEN CAST(fare_d - 10 AS DOUBLE)
         ELSE CAST(fare_d + tip_d AS DOUBLE) END AS total_amount,
    CASE l_linestatus WHEN 'O' THEN 2.5E0 ELSE 0.0E0 END AS congestion_surcharge,
    1.0E0 AS improvement_surcharge,
    CASE l_returnflag WHEN 'R' THEN 1.25E0 WHEN 'A' THEN 0.0E0 END AS airport_fee
  FROM k)
"""

TRIP_COLUMNS = (
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance", "RatecodeID",
    "PULocationID", "DOLocationID", "fare_amount", "tip_amount", "total_amount", "congestion_surcharge",
    "improvement_surcharge", "airport_fee",
)

# Gate predicates, by name and in order.
GATES = {
    "passenger": "passenger_count > 0",
    "fare": "fare_amount > 0",
    "total": "total_amount > 0",
    "total_covers_fare": "total_amount >= fare_amount",
    "distance": "trip_distance > 0",
    "rate_code": "RatecodeID BETWEEN 1 AND 6",
    "pickup_zone": "PULocationID BETWEEN 1 AND 263",
    "dropoff_zone": "DOLocationID BETWEEN 1 AND 263",
    "chronology": "tpep_pickup_datetime < tpep_dropoff_datetime",
    "duration": "tpep_dropoff_datetime <= CAST(CAST(tpep_pickup_datetime AS DATE) + 1 AS TIMESTAMP)",
    "pickup_window": (
        "tpep_pickup_datetime BETWEEN TIMESTAMP '1997-01-01 00:00:00' AND TIMESTAMP '1997-05-31 00:00:00'"
    ),
}
ALL_GATES = " AND ".join(f"({predicate})" for predicate in GATES.values())

SECONDS = "date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime)"

# The gates as worded.
WORDED_GATES = " AND ".join(
    f"({predicate})" for name, predicate in GATES.items() if name not in ("duration", "pickup_window")
) + (
    f" AND {SECONDS} <= 86400 AND tpep_pickup_datetime >= TIMESTAMP '1997-01-01'"
    " AND tpep_pickup_datetime < TIMESTAMP '1997-06-01'"
)

SILVER = f"{TRIPS}, silver AS (SELECT DISTINCT * FROM trips WHERE {ALL_GATES})"

def money(column: str, total: str) -> str:
    exact = f"CAST(SUM(CAST({column} AS DECIMAL(16,4))) AS DOUBLE)"
    return (
        f"{exact} AS {total}, {exact} / COUNT({column}) AS avg_{column}, "
        f"MAX({column}) AS max_{column}, MIN({column}) AS min_{column}"
    )


METRICS = f"""
  COUNT(*) AS total_trips,
  CAST(SUM(passenger_count) AS BIGINT) AS total_passenger_count,
  CAST(SUM(passenger_count) AS DOUBLE) / COUNT(passenger_count) AS avg_passenger_count,
  {money("total_amount", "total_amount")},
  {money("fare_amount", "total_fare_amount")},
  {money("tip_amount", "total_tip_amount")},
  {money("airport_fee", "total_airport_fee")},
  {money("congestion_surcharge", "total_congestion_surcharge")},
  {money("improvement_surcharge", "total_improvement_surcharge")},
  {money("trip_distance", "total_trip_distance")},
  CAST(SUM({SECONDS}) AS BIGINT) AS total_travel_time_seconds,
  CAST(SUM({SECONDS}) AS DOUBLE) / COUNT({SECONDS}) AS avg_travel_time_seconds,
  MAX({SECONDS}) AS max_travel_time_seconds,
  MIN({SECONDS}) AS min_travel_time_seconds
"""

MONTHLY = f"SELECT CAST(month(tpep_pickup_datetime) AS INT) AS TIME_SLICE, {METRICS} FROM silver GROUP BY 1"
DAILY = f"SELECT CAST(day(tpep_pickup_datetime) AS INT) AS TIME_SLICE, {METRICS} FROM silver GROUP BY 1"
HOURLY = f"SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS TIME_SLICE, {METRICS} FROM silver GROUP BY 1"
FOCUS = f"""
SELECT CAST(month(tpep_pickup_datetime) AS INT) AS MONTH_SLICE,
       CAST(day(tpep_pickup_datetime) AS INT) AS DAY_SLICE,
       CAST(hour(tpep_pickup_datetime) AS INT) AS HOUR_SLICE, {METRICS}
FROM silver WHERE month(tpep_pickup_datetime) = 5 GROUP BY 1, 2, 3
"""

REVENUE = """
SELECT label AS nome_mes, revenue AS faturamento_mes,
       ROUND(mean_revenue, 2) AS media_historica_mensal,
       ROUND(revenue - mean_revenue, 2) AS desvio_da_media,
       CASE WHEN ROUND(revenue - mean_revenue, 2) > 0 THEN '🟢 Acima da Média'
            WHEN ROUND(revenue - mean_revenue, 2) < 0 THEN '🔴 Abaixo da Média'
            ELSE '🟡 Na Média' END AS status_performance
FROM (SELECT CASE TIME_SLICE WHEN 1 THEN '1. Jan' WHEN 2 THEN '2. Fev' WHEN 3 THEN '3. Mar'
                             WHEN 4 THEN '4. Abr' WHEN 5 THEN '5. Mai' END AS label,
             ROUND(total_amount, 2) AS revenue,
             AVG(ROUND(total_amount, 2)) OVER () AS mean_revenue
      FROM monthly)
"""

DENSITY = """
SELECT HOUR_SLICE AS hora_do_dia, ROUND(m, 4) AS media_passageiros_hora,
       ROUND(overall, 4) AS media_global_maio_horas, ROUND(m - overall, 4) AS desvio_da_media,
       CASE WHEN ROUND(m - overall, 4) > 0 THEN '🟢 Densidade Superior à Média'
            WHEN ROUND(m - overall, 4) < 0 THEN '🔴 Densidade Inferior à Média'
            ELSE '🟡 Na Média Global' END AS status_comportamento_cliente
FROM (SELECT HOUR_SLICE, m, AVG(m) OVER () AS overall FROM hours)
"""
MEAN_OF_MEANS = "SELECT HOUR_SLICE, AVG(avg_passenger_count) AS m FROM focus GROUP BY 1"
WEIGHTED = (
    "SELECT HOUR_SLICE, CAST(SUM(total_passenger_count) AS DOUBLE) / SUM(total_trips) AS m "
    "FROM focus GROUP BY 1"
)

STACKED = """
stacked AS (
  SELECT *, 'a.parquet' AS FILE_NAME FROM trips
  UNION ALL SELECT *, 'a.parquet' FROM trips WHERE VendorID = 1
  UNION ALL SELECT *, 'b.parquet' FROM trips WHERE RatecodeID = 3)
"""

TWO_FILES = """
SELECT * REPLACE (CASE WHEN VendorID = 2 THEN airport_fee END AS airport_fee),
       'spark_medallion' AS AUD_ING_SYSTEM, 'catalog' AS AUD_ING_SCRIPT,
       'vendor_' || VendorID || '.parquet' AS FILE_NAME
FROM trips
"""

# Trips as the monthly files publish them: some a month late, and no airport fee in February's files.
PUBLISHED = """
dated AS (
  SELECT *, date_trunc('month', tpep_pickup_datetime)
            + to_months(CASE WHEN PULocationID % 13 = 0 THEN 1 ELSE 0 END) AS file_month
  FROM trips),
published AS (
  SELECT * EXCLUDE (file_month) REPLACE (CASE WHEN month(file_month) = 2 THEN NULL ELSE airport_fee END AS airport_fee),
         'yellow_tripdata_' || strftime(file_month, '%Y-%m') || '.parquet' AS FILE_NAME
  FROM dated)
"""

RUN = f"{TRIPS}, {PUBLISHED}, silver AS (SELECT DISTINCT * FROM published WHERE {ALL_GATES})"


def _ladder(rows: str, last_step: str = "") -> str:
    """Counts written as one filtered count per step over ``rows``."""
    steps, before = [], "TRUE"
    for step, (name, predicate) in enumerate(GATES.items(), 1):
        after = f"{before} AND ({predicate})"
        steps.append(
            f"SELECT CAST({step} AS INT) AS step, '{name}' AS gate, "
            f"COUNT(*) FILTER (WHERE {before}) AS rows_before, "
            f"COUNT(*) FILTER (WHERE {before}) - COUNT(*) FILTER (WHERE {after}) AS rows_removed, "
            f"COUNT(*) FILTER (WHERE {before} AND ({predicate}) IS NULL) AS rows_null, "
            f"COUNT(*) FILTER (WHERE {after}) AS rows_remaining FROM {rows}"
        )
        before = after
    return " UNION ALL ".join(steps) + last_step


def _field_types() -> str:
    """file, spelling and type of each field of each monthly file: the types of the view, but for the fields that
    January's files have as others, February's lack and later ones spell otherwise."""
    as_bigint, as_double = ("VendorID", "PULocationID", "DOLocationID"), ("passenger_count", "RatecodeID")
    rows = []
    for name in TRIP_COLUMNS:
        own = f"(SELECT typeof(any_value({name})) FROM trips)"
        january = "'BIGINT'" if name in as_bigint else "'DOUBLE'" if name in as_double else own
        spelling = f"'{name}'"
        if name == "airport_fee":
            spelling = "CASE WHEN month = '01' THEN 'airport_fee' WHEN month != '02' THEN 'Airport_fee' END"
        rows.append(f"SELECT FILE_NAME, {spelling} AS spelling, CASE WHEN month = '01' THEN {january} ELSE {own} END AS data_type FROM files")
    return (
        f"{TRIPS}, {PUBLISHED}, files AS (SELECT DISTINCT FILE_NAME, substr(FILE_NAME, -10, 2) AS month FROM published),"
        f" typed AS (SELECT FILE_NAME, spelling, data_type FROM ({' UNION ALL '.join(rows)}) WHERE spelling IS NOT NULL)"
    )


def _drift() -> str:
    return f"""
        WITH {_field_types()}, named AS (SELECT *, {TYPE_NAMES} AS type_name FROM typed)
        SELECT lower(spelling) AS field,
               string_agg(DISTINCT type_name, '|' ORDER BY type_name) AS types,
               string_agg(DISTINCT spelling, '|' ORDER BY spelling) AS spellings,
               COUNT(DISTINCT FILE_NAME) AS files
        FROM named GROUP BY 1
        HAVING COUNT(DISTINCT type_name) > 1 OR COUNT(DISTINCT spelling) > 1"""


def _common_types() -> str:
    """The widest of a field's types, all of them numbers that the later one of this order holds or comes nearest to."""
    return f"""
        WITH {_field_types()}, wide AS (
          SELECT lower(spelling) AS field, COUNT(DISTINCT data_type) > 1 OR COUNT(DISTINCT spelling) > 1 AS drifted,
                 MAX(list_position(['INTEGER', 'BIGINT', 'DOUBLE'], data_type)) AS place
          FROM typed GROUP BY 1)
        SELECT field, ['int', 'bigint', 'double'][place] AS common_type FROM wide WHERE drifted"""


def _stamped(table: str) -> str:
    return f"'{table}' AS FILE_NAME, 'spark_medallion' AS AUD_ING_SYSTEM, 'run_medallion' AS AUD_ING_SCRIPT"


TYPE_NAMES = """
CASE data_type WHEN 'BIGINT' THEN 'LongType()' WHEN 'INTEGER' THEN 'IntegerType()'
  WHEN 'DOUBLE' THEN 'DoubleType()' WHEN 'VARCHAR' THEN 'StringType()'
  WHEN 'TIMESTAMP' THEN 'TimestampNTZType()' WHEN 'FLOAT[]' THEN 'ArrayType(FloatType(), True)'
  ELSE data_type END
"""
TABLES = (
    "'region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem', 'events', "
    "'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations'"
)
FIELDS = f"""
fields AS (
  SELECT DISTINCT table_name || '.parquet' AS FILE_NAME, column_name AS FIELD_NAME, {TYPE_NAMES} AS VARIABLE_TYPE
  FROM information_schema.columns WHERE table_name IN ({TABLES}))
"""
FIELD_NAMES = """
c_acctbal c_custkey c_mktsegment c_name c_nationkey conv_id doc_id embedding event_id event_type html
item_id l_discount l_extendedprice l_linenumber l_linestatus l_orderkey l_partkey l_quantity l_returnflag
l_shipdate l_suppkey l_tax label lang n_chars n_name n_nationkey n_regionkey o_custkey o_orderdate
o_orderkey o_orderpriority o_orderstatus o_totalprice p_brand p_name p_partkey p_retailprice p_size p_type
page_id props quality r_name r_regionkey role s_acctbal s_name s_nationkey s_suppkey source text toxic ts
turn url user_id value vec_id
""".split()


def oracle_sql() -> dict[str, str]:
    matrix = ", ".join(
        f"MAX(CASE WHEN FIELD_NAME = '{name}' THEN VARIABLE_TYPE END) AS {name}" for name in FIELD_NAMES
    )
    return {
        **{
            f"gate_{name}": f"WITH {TRIPS} SELECT * FROM trips WHERE {predicate}"
            for name, predicate in GATES.items()
        },
        "quality_ladder": f"WITH {TRIPS} {_ladder('trips')}",
        "null_gate_rows": f"""
            WITH {TRIPS}, holes AS (
              SELECT * REPLACE (NULLIF(passenger_count, 3) AS passenger_count,
                                NULLIF(RatecodeID, 5) AS RatecodeID, NULLIF(PULocationID, 100) AS PULocationID)
              FROM trips)
            {_ladder('holes')}""",
        "focus_month_rows": f"WITH {TRIPS} SELECT * FROM trips WHERE month(tpep_pickup_datetime) = 5",
        "late_arrivals": f"""
            WITH {TRIPS}
            SELECT CAST(month(tpep_pickup_datetime) + CASE WHEN PULocationID % 13 = 0 THEN 1 ELSE 0 END AS INT)
                     AS file_month,
                   CAST(month(tpep_pickup_datetime) AS INT) AS pickup_month, COUNT(*) AS trips,
                   PULocationID % 13 = 0 AS is_late
            FROM trips WHERE {GATES['pickup_window']} GROUP BY ALL""",
        "dedup_exact": f"WITH {TRIPS}, {STACKED} SELECT DISTINCT * FROM stacked",
        "dedup_business_keys": f"""
            WITH {TRIPS}, {STACKED}
            SELECT * EXCLUDE (FILE_NAME), MIN(FILE_NAME) AS FILE_NAME FROM stacked GROUP BY ALL""",
        "dedup_counts": f"""
            WITH {TRIPS}, {STACKED}
            SELECT (SELECT COUNT(*) FROM stacked) AS rows_before,
                   (SELECT COUNT(*) FROM stacked) - COUNT(*) AS rows_removed, COUNT(*) AS rows_remaining
            FROM (SELECT DISTINCT * FROM stacked)""",
        "silver_trips": f"WITH {SILVER} SELECT * FROM silver",
        "silver_as_worded": f"""
            WITH {TRIPS}
            SELECT DISTINCT * FROM trips
            WHERE {WORDED_GATES}""",
        "silver_with_lineage": f"""
            WITH {TRIPS}, {PUBLISHED}, whole AS (
              SELECT trips.*, FILE_NAME FROM trips, (
                SELECT PULocationID % 13 = 0 AS is_late, date_trunc('month', tpep_pickup_datetime) AS month,
                       ANY_VALUE(FILE_NAME) AS FILE_NAME
                FROM published GROUP BY ALL) AS names
              WHERE names.is_late = (PULocationID % 13 = 0)
                AND names.month = date_trunc('month', tpep_pickup_datetime)),
            landed AS (
              SELECT * FROM whole UNION ALL BY NAME
              SELECT * REPLACE ('yellow_tripdata_again.parquet' AS FILE_NAME) FROM whole WHERE VendorID = 1)
            SELECT * EXCLUDE (FILE_NAME), MIN(FILE_NAME) AS FILE_NAME FROM landed WHERE {WORDED_GATES} GROUP BY ALL""",
        "gold_monthly_places": f"""
            WITH {SILVER} SELECT TIME_SLICE, total_trips, row_number() OVER (ORDER BY TIME_SLICE) AS place
            FROM ({MONTHLY})""",
        "gold_monthly": f"WITH {SILVER} {MONTHLY}",
        "gold_daily": f"WITH {SILVER} {DAILY}",
        "gold_hourly": f"WITH {SILVER} {HOURLY}",
        "gold_month_focus": f"WITH {SILVER} {FOCUS}",
        "gold_from_cells": f"""
            WITH {SILVER}
            SELECT *, 'month' AS grain FROM ({MONTHLY}) UNION ALL SELECT *, 'day' FROM ({DAILY})
            UNION ALL SELECT *, 'hour' FROM ({HOURLY})""",
        "gold_daily_buckets": f"""
            WITH {SILVER}
            SELECT CAST(date_trunc('day', tpep_pickup_datetime) AS TIMESTAMP) AS TIME_SLICE, {METRICS}
            FROM silver GROUP BY 1""",
        "gold_monthly_display": f'WITH {SILVER} SELECT TIME_SLICE AS "MONTH", * EXCLUDE (TIME_SLICE) FROM ({MONTHLY})',
        "gold_daily_display": f'WITH {SILVER} SELECT TIME_SLICE AS "DAY", * EXCLUDE (TIME_SLICE) FROM ({DAILY})',
        "gold_hourly_display": f'WITH {SILVER} SELECT TIME_SLICE AS "HOUR", * EXCLUDE (TIME_SLICE) FROM ({HOURLY})',
        "gold_monthly_all_trips": f"""
            WITH {TRIPS}
            SELECT CAST(month(tpep_pickup_datetime) AS INT) AS TIME_SLICE, {METRICS} FROM trips GROUP BY 1""",
        "hourly_trip_volume": f"""
            WITH {SILVER}
            SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS HOUR_SLICE, COUNT(*) AS total_trips
            FROM silver WHERE month(tpep_pickup_datetime) = 5 GROUP BY 1""",
        "travel_time_stats": f"""
            WITH {TRIPS}
            SELECT CAST(hour(tpep_pickup_datetime) AS INT) AS TIME_SLICE, COUNT(*) AS total_trips,
                   CAST(SUM({SECONDS}) AS BIGINT) AS total_travel_time_seconds,
                   CAST(SUM({SECONDS}) AS DOUBLE) / COUNT(*) AS avg_travel_time_seconds,
                   MAX({SECONDS}) AS max_travel_time_seconds, MIN({SECONDS}) AS min_travel_time_seconds
            FROM trips GROUP BY 1""",
        "events_hourly_rollup": f"""
            SELECT CAST(hour(ts) AS INT) AS TIME_SLICE, COUNT(*) AS total_events, {money("value", "total_value")}
            FROM events GROUP BY 1""",
        "orders_monthly_rollup": f"""
            SELECT CAST(month(o_orderdate) AS INT) AS TIME_SLICE, COUNT(*) AS total_orders,
                   {money("o_totalprice", "total_o_totalprice")}
            FROM orders GROUP BY 1""",
        "orders_monthly_buckets": f"""
            SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS TIME_SLICE, COUNT(*) AS total_orders,
                   {money("o_totalprice", "total_o_totalprice")}
            FROM orders GROUP BY 1""",
        "lineitem_tax_rollup": """
            WITH taxed AS (
              SELECT l_shipdate, CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))
                                   * CAST(l_tax AS DECIMAL(4,2)) AS tax
              FROM lineitem)
            SELECT CAST(month(l_shipdate) AS INT) AS TIME_SLICE, COUNT(*) AS total_lines,
                   CAST(SUM(tax) AS DOUBLE) AS total_tax, CAST(SUM(tax) AS DOUBLE) / COUNT(tax) AS avg_tax,
                   CAST(MAX(tax) AS DOUBLE) AS max_tax, CAST(MIN(tax) AS DOUBLE) AS min_tax
            FROM taxed GROUP BY 1""",
        "label_month": f"""
            WITH {TRIPS}
            SELECT CAST(month(tpep_pickup_datetime) AS INT) AS month, COUNT(*) AS trips,
                   CASE month(tpep_pickup_datetime) WHEN 1 THEN '1. Jan' WHEN 2 THEN '2. Fev'
                     WHEN 3 THEN '3. Mar' WHEN 4 THEN '4. Abr' WHEN 5 THEN '5. Mai' END AS label
            FROM trips GROUP BY ALL""",
        "deviation_status": """
            WITH months AS (
              SELECT CAST(month(o_orderdate) AS INT) AS TIME_SLICE, COUNT(*) AS total_orders,
                     CAST(SUM(CAST(o_totalprice AS DECIMAL(16,4))) AS DOUBLE) AS total_o_totalprice
              FROM orders GROUP BY 1),
            compared AS (
              SELECT *, ROUND(AVG(total_o_totalprice) OVER (), 2) AS mean_of_months,
                     ROUND(total_o_totalprice - AVG(total_o_totalprice) OVER (), 2) AS deviation
              FROM months)
            SELECT *, CASE WHEN deviation > 0 THEN 'above' WHEN deviation < 0 THEN 'below'
                           ELSE 'at mean' END AS status
            FROM compared""",
        "baseline_all_orders": """
            WITH overall AS (
              SELECT CAST(SUM(CAST(o_totalprice AS DECIMAL(16,4))) AS DOUBLE) / COUNT(*) AS mean_price FROM orders)
            SELECT o_orderkey, o_totalprice, mean_price, o_totalprice - mean_price AS deviation
            FROM orders, overall""",
        "report_monthly_revenue": f"WITH {SILVER}, monthly AS ({MONTHLY}) {REVENUE}",
        "report_hourly_density": f"WITH {SILVER}, focus AS ({FOCUS}), hours AS ({MEAN_OF_MEANS}) {DENSITY}",
        "report_hourly_density_weighted": f"WITH {SILVER}, focus AS ({FOCUS}), hours AS ({WEIGHTED}) {DENSITY}",
        "sql_monthly_revenue": f"WITH {SILVER}, monthly AS ({MONTHLY}) {REVENUE}",
        "sql_hourly_density": f"WITH {SILVER}, focus AS ({FOCUS}), hours AS ({MEAN_OF_MEANS}) {DENSITY}",
        "narrow_projection": f"""
            WITH {TRIPS}
            SELECT VendorID, passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime
            FROM trips""",
        "calendar_parts": f"""
            WITH {TRIPS}
            SELECT tpep_pickup_datetime, tpep_dropoff_datetime,
                   CAST(month(tpep_pickup_datetime) AS INT) AS MONTH_SLICE,
                   CAST(day(tpep_pickup_datetime) AS INT) AS DAY_SLICE,
                   CAST(hour(tpep_pickup_datetime) AS INT) AS HOUR_SLICE, {SECONDS} AS seconds
            FROM trips""",
        "audit_stamp": f"""
            WITH {TRIPS}
            SELECT *, 'spark_medallion' AS AUD_ING_SYSTEM, 'catalog' AS AUD_ING_SCRIPT,
                   'lineitem.parquet' AS FILE_NAME
            FROM trips""",
        "table_preview": f"""
            WITH {TRIPS}
            SELECT * FROM trips
            ORDER BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance,
              RatecodeID, PULocationID, DOLocationID, fare_amount, tip_amount, total_amount,
              congestion_surcharge, improvement_surcharge, airport_fee NULLS FIRST
            LIMIT 10""",
        "schema_fields": f"WITH {FIELDS} SELECT * FROM fields",
        "schema_matrix": f"WITH {FIELDS} SELECT FILE_NAME AS File_Name, {matrix} FROM fields GROUP BY 1",
        "harmonized_union": f"WITH {TRIPS}, {PUBLISHED} SELECT * FROM published",
        "schema_drift": _drift(),
        "schema_common_types": _common_types(),
        "landing_unreadable": f"""
            WITH {TRIPS}, {PUBLISHED}, named AS (
              SELECT *, 'trips [' || substr(FILE_NAME, -15, 7) || '] +copy.parquet' AS odd_name,
                     substr(FILE_NAME, -10, 2) IN ('05', '10') AS is_text
              FROM published)
            SELECT odd_name AS FILE_NAME, CASE WHEN is_text THEN 'unreadable' ELSE 'loaded' END AS state,
                   CASE WHEN NOT is_text THEN COUNT(*) END AS trips,
                   CASE WHEN NOT is_text THEN CAST(SUM(passenger_count) AS BIGINT) END AS passengers
            FROM named GROUP BY odd_name, is_text""",
        "cast_losses": f"""
            WITH {TRIPS}, named AS (
              SELECT *, 'yellow_tripdata_1997-' || lpad(CAST(month(tpep_pickup_datetime) AS VARCHAR), 2, '0')
                          || '.parquet' AS FILE_NAME FROM trips)
            SELECT FILE_NAME, 'VendorID' AS FIELD_NAME, CAST(0 AS BIGINT) AS values_lost,
                   CAST(0 AS BIGINT) AS fractions_cut FROM named GROUP BY 1
            UNION ALL SELECT FILE_NAME, 'passenger_count', COUNT(*) FILTER (WHERE passenger_count = 6), 0
                   FROM named GROUP BY 1
            UNION ALL SELECT FILE_NAME, 'DOLocationID', 0, 0 FROM named GROUP BY 1
            UNION ALL SELECT FILE_NAME, 'PULocationID', 0, 0 FROM named GROUP BY 1
            UNION ALL SELECT FILE_NAME, 'RatecodeID', 0, COUNT(*) FILTER (WHERE RatecodeID = 3)
                   FROM named GROUP BY 1""",
        "ingest_roundtrip": f"WITH {TRIPS} {TWO_FILES}",
        "append_roundtrip": f"WITH {TRIPS} {TWO_FILES}",
        "cluster_roundtrip": f"WITH {TRIPS} SELECT *, CAST(tpep_pickup_datetime AS DATE) AS PICKUP_DATE FROM trips",
        "cluster_range_scan": f"""
            WITH {TRIPS} SELECT *, CAST(tpep_pickup_datetime AS DATE) AS PICKUP_DATE FROM trips
            WHERE tpep_pickup_datetime >= TIMESTAMP '1997-01-01'
              AND tpep_pickup_datetime < TIMESTAMP '1997-06-01'""",
        "zorder_stored": f"WITH {TRIPS} SELECT * FROM trips",
        "zorder_roundtrip": f"""
            WITH {TRIPS}
            SELECT *, CAST(day(tpep_pickup_datetime) AS INT) AS DAY_SLICE,
                   CAST(hour(tpep_pickup_datetime) AS INT) AS HOUR_SLICE
            FROM trips""",
        "medallion_bronze": f"""
            WITH {TRIPS}, {PUBLISHED}
            SELECT *, 'spark_medallion' AS AUD_ING_SYSTEM, 'run_medallion' AS AUD_ING_SCRIPT FROM published""",
        "medallion_cast_losses": f"""
            WITH {TRIPS}, {PUBLISHED}
            SELECT DISTINCT FILE_NAME, FIELD_NAME, CAST(0 AS BIGINT) AS values_lost, CAST(0 AS BIGINT) AS fractions_cut
            FROM published, (VALUES ('VendorID'), ('passenger_count'), ('RatecodeID'), ('PULocationID'),
                                    ('DOLocationID')) AS repaired(FIELD_NAME)""",
        "medallion_silver": f"""
            WITH {RUN}
            SELECT *, CAST(tpep_pickup_datetime AS DATE) AS PICKUP_DATE,
                   'spark_medallion' AS AUD_ING_SYSTEM, 'run_medallion' AS AUD_ING_SCRIPT
            FROM silver""",
        "medallion_ladder": f"WITH {RUN} " + _ladder("published", """
            UNION ALL SELECT CAST(12 AS INT), 'duplicates', COUNT(*),
              COUNT(*) - (SELECT COUNT(*) FROM silver), 0, (SELECT COUNT(*) FROM silver)
            FROM published WHERE """ + ALL_GATES),
        "medallion_gold_monthly": f"WITH {RUN} SELECT *, {_stamped('gold_monthly')} FROM ({MONTHLY})",
        "medallion_gold_daily": f"WITH {RUN} SELECT *, {_stamped('gold_daily')} FROM ({DAILY})",
        "medallion_gold_hourly": f"WITH {RUN} SELECT *, {_stamped('gold_hourly')} FROM ({HOURLY})",
        "medallion_gold_focus": f"WITH {RUN} SELECT *, {_stamped('gold_focus')} FROM ({FOCUS})",
        "medallion_monthly_revenue": f"WITH {RUN}, monthly AS ({MONTHLY}) {REVENUE}",
        "stored_gold_report": f"WITH {RUN}, monthly AS ({MONTHLY}) {REVENUE}",
        "resumed_from_bronze": f"""
            WITH {TRIPS}, {PUBLISHED}, silver AS (SELECT DISTINCT * FROM published WHERE {WORDED_GATES})
            SELECT *, {_stamped('gold_monthly')} FROM ({MONTHLY})""",
        "medallion_hourly_density": f"WITH {RUN}, focus AS ({FOCUS}), hours AS ({MEAN_OF_MEANS}) {DENSITY}",
    }
