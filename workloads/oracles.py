"""The SQL each query must agree with, written for DuckDB over the given tables."""

from __future__ import annotations

from workloads.data import READINGS_SQL, load_moment

LOAD = [f"TIMESTAMP '{load_moment(n):%Y-%m-%d %H:%M:%S}'" for n in (1, 2, 3)]
READINGS = f"WITH readings AS ({READINGS_SQL})"
NULLS = "(wind_speed IS NULL OR wind_direction IS NULL OR power_output IS NULL)"
ALL_NULL = "(wind_speed IS NULL AND wind_direction IS NULL AND power_output IS NULL)"
VALID = """(coalesce(try_cast(wind_speed AS DOUBLE) BETWEEN 3 AND 25, false)
    AND coalesce(try_cast(wind_direction AS DOUBLE) BETWEEN 0 AND 360, false)
    AND coalesce(try_cast(power_output AS DOUBLE) > 0, false))"""
ARRIVAL = "timestamp, turbine_id, wind_speed, wind_direction, power_output"

REASON = """CASE WHEN wind_speed IS NULL OR wind_direction IS NULL OR power_output IS NULL
    THEN concat_ws('; ',
        CASE WHEN wind_speed IS NULL THEN 'wind_speed is null' END,
        CASE WHEN wind_direction IS NULL THEN 'wind_direction is null' END,
        CASE WHEN power_output IS NULL THEN 'power_output is null' END)
    ELSE concat_ws('; ',
        CASE WHEN try_cast(wind_speed AS DOUBLE) IS NULL THEN 'wind_speed is not a number' END,
        CASE WHEN try_cast(wind_direction AS DOUBLE) IS NULL THEN 'wind_direction is not a number' END,
        CASE WHEN try_cast(power_output AS DOUBLE) IS NULL THEN 'power_output is not a number' END,
        CASE WHEN NOT coalesce(try_cast(wind_speed AS DOUBLE) BETWEEN 3 AND 25, false)
             THEN 'wind_speed out of range' END,
        CASE WHEN NOT coalesce(try_cast(wind_direction AS DOUBLE) BETWEEN 0 AND 360, false)
             THEN 'wind_direction out of range' END,
        CASE WHEN NOT coalesce(try_cast(power_output AS DOUBLE) > 0, false)
             THEN 'power_output not above zero' END)
    END AS reject_reason"""

TYPED = """CAST(timestamp AS TIMESTAMP) AS timestamp,
    CAST(turbine_id AS INTEGER) AS turbine_id,
    try_cast(wind_speed AS DOUBLE) AS wind_speed,
    CAST(trunc(try_cast(wind_direction AS DOUBLE)) AS INTEGER) AS wind_direction,
    try_cast(power_output AS DOUBLE) AS power_output"""


def summary(rows: str, groups: str, value: str = "power_output") -> str:
    """Daily statistics of a relation; the average is rounded half up as a decimal."""
    return f"""SELECT {groups}, average AS avg_{value}, low AS min_{value}, high AS max_{value},
        coalesce(high > average + 2 * deviation OR low < average - 2 * deviation, false) AS is_anomaly
    FROM (SELECT {groups},
            CAST(round(CAST(avg({value}) AS DECIMAL(38, 8)), 2) AS DOUBLE) AS average,
            min({value}) AS low, max({value}) AS high, stddev_samp({value}) AS deviation
        FROM {rows} GROUP BY {groups})"""


def day_summary(unit: str, name: str) -> str:
    return summary(
        f"(SELECT {unit} AS {name}, CAST(ts AS DATE) AS date, value AS power_output FROM events)",
        f"{name}, date",
    )


def ingested(timestamp_load: str = LOAD[0]) -> str:
    return f"{READINGS} SELECT {timestamp_load} AS load_datetime, {ARRIVAL} FROM readings"


INTO_ORDERS = """SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 2 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
    o_totalprice, o_orderdate, o_orderpriority
    FROM orders"""


# Layers


def layers(deliveries: str, keep: str) -> str:
    """Bronze, errors and silver for a relation of numbered deliveries."""
    return f"""{READINGS}, delivered AS ({deliveries}),
    bronze AS ({keep}),
    judged AS (SELECT *, {REASON} FROM bronze),
    typed AS (SELECT load_datetime, {TYPED} FROM bronze WHERE NOT {NULLS} AND {VALID}),
    silver AS (SELECT * EXCLUDE (place) FROM (
        SELECT *, row_number() OVER (PARTITION BY turbine_id, timestamp
            ORDER BY load_datetime DESC, wind_speed DESC, wind_direction DESC, power_output DESC) AS place
        FROM typed) WHERE place = 1),
    daily AS (SELECT *, CAST(timestamp AS DATE) AS date FROM silver)"""


FIRST_WINS = """SELECT load_datetime, timestamp, turbine_id, wind_speed, wind_direction, power_output
    FROM (SELECT *, min(load_datetime) OVER (PARTITION BY turbine_id, timestamp) AS first_load FROM delivered)
    WHERE load_datetime = first_load"""
EVERY_DELIVERY = "SELECT * FROM delivered"

ONE_BATCH = layers(f"SELECT {LOAD[0]} AS load_datetime, {ARRIVAL} FROM readings", EVERY_DELIVERY)


def _marked(number: int, first: int, last: int) -> str:
    turn = "wind_direction" if number == 1 else f"CASE WHEN wind_direction IS NOT NULL THEN '{number * 45}' END"
    return f"""SELECT {LOAD[number - 1]} AS load_datetime, timestamp, turbine_id, wind_speed,
        {turn} AS wind_direction, power_output
    FROM readings WHERE day(reading_ts) BETWEEN {first} AND {last}"""


PARTS = " UNION ALL ".join([_marked(1, 1, 10), _marked(2, 6, 20), _marked(3, 16, 31)])
INCREMENTS = layers(PARTS, FIRST_WINS)
CORRECTIONS = layers(PARTS, EVERY_DELIVERY)

LATE = f"""SELECT CASE WHEN event_type IN ('view', 'click') THEN {LOAD[0]} ELSE {LOAD[1]} END
    AS load_datetime, {ARRIVAL} FROM readings"""
LATE_LAYERS = layers(LATE, FIRST_WINS)
GOLD_KEYS = "turbine_id, date"
BRONZE_COLUMNS = f"SELECT load_datetime, {ARRIVAL} FROM bronze"
SILVER_COLUMNS = f"SELECT load_datetime, {ARRIVAL} FROM silver"
ERROR_COLUMNS = f"SELECT load_datetime, {ARRIVAL}, reject_reason FROM judged WHERE reject_reason <> ''"

LINE_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount,
    l_tax, l_returnflag, l_linestatus, l_shipdate"""
LATEST_LINE = """row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
        l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC)"""
ORDERS = """WITH stored AS (SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')),
    arriving AS (SELECT o_orderkey, o_custkey, 'R' AS o_orderstatus, o_totalprice + 1 AS o_totalprice,
        o_orderdate, o_orderpriority FROM orders WHERE o_orderstatus IN ('P', 'O'))"""
INSERTED = "SELECT * FROM stored UNION ALL SELECT * FROM arriving WHERE o_orderkey NOT IN (SELECT o_orderkey FROM stored)"
MATCHED = """SELECT o_orderkey, o_totalprice, l_orderkey AS target_l_orderkey,
    l_linenumber AS target_l_linenumber, l_extendedprice AS target_l_extendedprice
    FROM orders {kind} JOIN lineitem ON o_orderkey = l_orderkey"""


def sql() -> dict[str, str]:
    readings = f"{READINGS} SELECT * FROM readings"
    return {
        "raw_readings": readings,
        **{
            name: ingested()
            for name in (
                "csv_ingest",
                "csv_ingest_undeclared",
                "csv_ingest_headerless",
                "json_ingest",
                "orc_ingest",
                "parquet_ingest",
            )
        },
        "split_complete_rows": f"{readings} WHERE NOT {NULLS}",
        "split_null_rows": f"{readings} WHERE {NULLS}",
        "split_partly_filled_rows": f"{readings} WHERE NOT {ALL_NULL}",
        "split_empty_rows": f"{readings} WHERE {ALL_NULL}",
        "split_valid": f"{readings} WHERE NOT {NULLS} AND {VALID}",
        "split_invalid": f"{readings} WHERE NOT {NULLS} AND NOT {VALID}",
        "reject_reasons": f"""{READINGS} SELECT * FROM (SELECT *, {REASON} FROM readings)
            WHERE reject_reason <> ''""",
        "reject_log": f"""{readings} WHERE {NULLS}
            UNION ALL SELECT * FROM readings WHERE NOT {NULLS} AND NOT {VALID}""",
        "cast_to_silver": f"{READINGS} SELECT event_id, reading_ts, event_type, {TYPED} FROM readings",
        "cast_lineitem": """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
            CAST(trunc(l_quantity) AS INTEGER) AS l_quantity,
            CAST(trunc(l_extendedprice) AS INTEGER) AS l_extendedprice,
            CAST(l_discount AS VARCHAR) AS l_discount, l_tax,
            try_cast(l_returnflag AS DOUBLE) AS l_returnflag, l_linestatus, l_shipdate
            FROM lineitem""",
        "not_null_counts": f"""{READINGS}, typed AS (SELECT {TYPED} FROM readings)
            SELECT column_name, CAST(violations AS BIGINT) AS violations FROM (
            SELECT 'timestamp' AS column_name, count(*) FILTER (timestamp IS NULL) AS violations FROM typed
            UNION ALL SELECT 'turbine_id', count(*) FILTER (turbine_id IS NULL) FROM typed
            UNION ALL SELECT 'wind_speed', count(*) FILTER (wind_speed IS NULL) FROM typed
            UNION ALL SELECT 'wind_direction', count(*) FILTER (wind_direction IS NULL) FROM typed
            UNION ALL SELECT 'power_output', count(*) FILTER (power_output IS NULL) FROM typed)""",
        "newer_than_mark": """SELECT * FROM lineitem WHERE l_shipdate >
            (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') FROM orders)""",
        "newer_than_default_mark": """SELECT * FROM events WHERE ts >
            (SELECT coalesce(max(ts), TIMESTAMP '1900-01-01') FROM events WHERE value < 0)""",
        "touched_groups": """SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS date FROM lineitem
            WHERE l_shipdate > TIMESTAMP '1998-03-01'""",
        "unseen_groups": """SELECT lineitem.* FROM lineitem ANTI JOIN orders
            ON l_suppkey = o_custkey AND l_shipdate = o_orderdate""",
        "seen_groups": """SELECT lineitem.* FROM lineitem SEMI JOIN orders
            ON l_suppkey = o_custkey AND l_shipdate = o_orderdate""",
        "unseen_orders": "SELECT orders.* FROM orders ANTI JOIN lineitem ON o_orderkey = l_orderkey",
        "seen_orders": "SELECT orders.* FROM orders SEMI JOIN lineitem ON o_orderkey = l_orderkey",
        "matched_inner": MATCHED.format(kind="INNER"),
        "matched_left": MATCHED.format(kind="LEFT"),
        "matched_right": MATCHED.format(kind="RIGHT"),
        "matched_full": MATCHED.format(kind="FULL"),
        "merge_insert_only": f"{ORDERS} {INSERTED}",
        "merge_insert_only_repeats": f"""WITH stored AS (SELECT * FROM lineitem WHERE l_linestatus = 'F'),
            arriving AS (SELECT * FROM lineitem WHERE l_linestatus = 'O')
            SELECT {LINE_COLUMNS} FROM stored UNION ALL
            SELECT {LINE_COLUMNS} FROM arriving a WHERE NOT EXISTS (SELECT 1 FROM stored s
                WHERE s.l_orderkey = a.l_orderkey AND s.l_linenumber = a.l_linenumber)""",
        "merge_upsert": f"""{ORDERS} SELECT
            coalesce(a.o_orderkey, s.o_orderkey) AS o_orderkey,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_custkey ELSE a.o_custkey END AS o_custkey,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_orderstatus ELSE a.o_orderstatus END AS o_orderstatus,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_totalprice ELSE a.o_totalprice END AS o_totalprice,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_orderdate ELSE a.o_orderdate END AS o_orderdate,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_orderpriority ELSE a.o_orderpriority END AS o_orderpriority
            FROM stored s FULL OUTER JOIN arriving a ON s.o_orderkey = a.o_orderkey""",
        "merge_upsert_repeats": f"""WITH stored AS (SELECT * FROM lineitem WHERE l_linestatus = 'F'),
            arriving AS (SELECT * FROM (SELECT *, {LATEST_LINE} AS place FROM lineitem
                WHERE l_linestatus = 'O') WHERE place = 1)
            SELECT {LINE_COLUMNS} FROM arriving UNION ALL
            SELECT {LINE_COLUMNS} FROM stored s WHERE NOT EXISTS (SELECT 1 FROM arriving a
                WHERE s.l_orderkey = a.l_orderkey AND s.l_linenumber = a.l_linenumber)""",
        "merge_keys_only": f"{ORDERS} {INSERTED}",
        "merge_one_column": f"""{ORDERS} SELECT
            coalesce(s.o_orderkey, a.o_orderkey) AS o_orderkey,
            CASE WHEN s.o_orderkey IS NULL THEN a.o_custkey ELSE s.o_custkey END AS o_custkey,
            CASE WHEN s.o_orderkey IS NULL THEN a.o_orderstatus ELSE s.o_orderstatus END AS o_orderstatus,
            CASE WHEN a.o_orderkey IS NULL THEN s.o_totalprice ELSE a.o_totalprice END AS o_totalprice,
            CASE WHEN s.o_orderkey IS NULL THEN a.o_orderdate ELSE s.o_orderdate END AS o_orderdate,
            CASE WHEN s.o_orderkey IS NULL THEN a.o_orderpriority ELSE s.o_orderpriority END AS o_orderpriority
            FROM stored s FULL OUTER JOIN arriving a ON s.o_orderkey = a.o_orderkey""",
        "latest_per_key": f"""SELECT {LINE_COLUMNS} FROM (SELECT *, {LATEST_LINE} AS place FROM lineitem)
            WHERE place = 1""",
        "daily_summary_turbines": day_summary("CAST(user_id % 15 AS INTEGER)", "turbine_id"),
        "daily_summary_by_user": day_summary("user_id", "user_id"),
        "daily_summary_by_type": day_summary("event_type", "event_type"),
        "daily_summary_shipping": summary(
            "(SELECT l_returnflag, l_linestatus, CAST(l_shipdate AS DATE) AS date, l_extendedprice FROM lineitem)",
            "l_returnflag, l_linestatus, date",
            "l_extendedprice",
        ),
        "daily_summary_valid": f"{ONE_BATCH} {summary('daily', GOLD_KEYS)}",
        "layered_bronze": f"{ONE_BATCH} {BRONZE_COLUMNS}",
        "layered_silver": f"{ONE_BATCH} {SILVER_COLUMNS}",
        "layered_errors": f"{ONE_BATCH} {ERROR_COLUMNS}",
        "layered_gold": f"{ONE_BATCH} {summary('daily', GOLD_KEYS)}",
        "increments_bronze": f"{INCREMENTS} {BRONZE_COLUMNS}",
        "increments_silver": f"{INCREMENTS} {SILVER_COLUMNS}",
        "increments_gold": f"{INCREMENTS} {summary('daily', GOLD_KEYS)}",
        "corrections_silver": f"{CORRECTIONS} {SILVER_COLUMNS}",
        "corrections_errors": f"{CORRECTIONS} {ERROR_COLUMNS}",
        "silver_run_counts": f"""{CORRECTIONS} SELECT strftime(load_datetime, '%Y%m%d_%H%M%S_%f') AS batch_id,
            count(*) AS n_rows, count(*) FILTER ({NULLS}) AS n_with_gaps,
            count(*) FILTER (reject_reason <> '') AS n_rejected,
            count(DISTINCT CAST(CAST(timestamp AS TIMESTAMP) AS DATE)) AS n_days
            FROM judged GROUP BY load_datetime""",
        "corrections_gold": f"{CORRECTIONS} {summary('daily', GOLD_KEYS)}",
        "late_unseen_gold": f"""{LATE_LAYERS},
            starts AS (SELECT turbine_id, date, min(load_datetime) AS first_load FROM daily GROUP BY ALL),
            counted AS (SELECT daily.* FROM daily JOIN starts USING (turbine_id, date)
                WHERE load_datetime = first_load)
            {summary('counted', GOLD_KEYS)}""",
        "late_touched_gold": f"{LATE_LAYERS} {summary('daily', GOLD_KEYS)}",
        "stream_bronze": f"{INCREMENTS} {BRONZE_COLUMNS}",
        "stream_old_file": f"{INCREMENTS} {BRONZE_COLUMNS}",
        "compacted_bronze": f"{INCREMENTS} {BRONZE_COLUMNS}",
        "stream_silver": f"{INCREMENTS} {SILVER_COLUMNS}",
        "stream_gold": f"{INCREMENTS} {summary('daily', GOLD_KEYS)}",
        "split_by_day": f"{READINGS} SELECT {ARRIVAL}, strftime(reading_ts, '%Y_%m_%d') AS day FROM readings",
        "reclustered": "SELECT * FROM lineitem",
        "reclustered_table": "SELECT * FROM orders",
        "compacted": "SELECT *, CAST(ts AS DATE) AS date FROM events",
        "archived_files": f"""{READINGS} SELECT {ARRIVAL}, CASE load_datetime WHEN {LOAD[0]} THEN 'first run'
            WHEN {LOAD[1]} THEN 'second run' ELSE 'landing' END AS place FROM ({PARTS})""",
        "redelivered_file": f"""{READINGS} SELECT load_datetime, {ARRIVAL} FROM ({PARTS})
            WHERE load_datetime <= {LOAD[1]}""",
        "landed_kinds": f"""{READINGS}, sent AS (SELECT load_datetime, count(*) AS n_rows FROM ({PARTS})
                WHERE load_datetime <= {LOAD[1]} GROUP BY load_datetime),
            kinds AS (SELECT load_datetime AS batch, 'new' AS kind, n_rows FROM sent
                UNION ALL SELECT {LOAD[1]}, 'redelivered', n_rows FROM sent WHERE load_datetime = {LOAD[0]}
                UNION ALL SELECT {LOAD[2]}, 'redelivered', sum(n_rows) FROM sent)
            SELECT strftime(batch, '%Y%m%d_%H%M%S_%f') AS batch_id, kind, CAST(n_rows AS BIGINT) AS n_rows
            FROM kinds""",
        "bronze_repeated_run": f"""{READINGS} SELECT {LOAD[0]} AS load_datetime,
            CASE WHEN right(timestamp, 1) <> '3' THEN timestamp END AS timestamp,
            turbine_id, wind_speed, wind_direction, power_output FROM readings""",
        "compacted_null_day": """SELECT *, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS date
            FROM events""",
        "merge_into_orders": INTO_ORDERS,
        "merge_into_orders_by_status": INTO_ORDERS,
        "merge_into_orders_by_name": INTO_ORDERS,
        "merge_into_silver_by_name": f"""{ONE_BATCH} SELECT * REPLACE (
            CASE WHEN turbine_id % 4 = 1 THEN power_output * 2 ELSE power_output END AS power_output)
            FROM ({SILVER_COLUMNS})""",
        "reclustered_silver": f"{INCREMENTS} {SILVER_COLUMNS}",
        "compacted_after_append": "SELECT *, CAST(ts AS DATE) AS date FROM events",
        "named_silver": f"{INCREMENTS} {SILVER_COLUMNS}",
        "named_gold": f"{INCREMENTS} {summary('daily', GOLD_KEYS)}",
        "catalog_tables": f"{ONE_BATCH} {summary('daily', GOLD_KEYS)}",
    }
