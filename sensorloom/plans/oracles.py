"""The registered queries in SQL, for a second engine to check the results against."""

from sensorloom.plans.registry import EARLY_END, HISTORY_ITEM, HISTORY_STATION, LATE_START


def rounded(expression: str, decimals: int) -> str:
    """Round half away from zero on the printed decimal value of a double."""
    exact = f"CAST(CAST({expression} AS VARCHAR) AS DECIMAL(38, 20))"
    return f"CAST(round({exact}, {decimals}) AS DOUBLE)"


SOURCES = """
measurement_raw AS (
  SELECT
    CASE WHEN l_quantity <> 3
      THEN l_shipdate + to_hours(CAST(round(l_discount * 100) AS INTEGER)) END
      AS Measurement_Date,
    CASE WHEN l_quantity = 23 THEN -l_suppkey WHEN l_quantity <> 7 THEN l_suppkey END
      AS Station_Code,
    CAST(CASE WHEN l_quantity = 29 THEN -l_linenumber
      WHEN l_quantity <> 11 THEN l_linenumber END AS BIGINT) AS Item_Code,
    CASE WHEN l_quantity = 17 THEN CAST('NaN' AS DOUBLE)
      WHEN l_quantity = 19 THEN -(floor(l_extendedprice / 250) - 3) / 4 - 0.25
      WHEN l_quantity <> 13 THEN (floor(l_extendedprice / 250) - 3) / 4 END AS Average_Value,
    CASE WHEN l_quantity <> 31 THEN CAST(round(l_tax * 100) AS INTEGER) END
      AS Instrument_Status
  FROM lineitem),
station_raw AS (
  SELECT s_suppkey AS Station_Code,
    CASE WHEN s_nationkey <> 24 THEN '  ' || s_name || ' ' END AS Station_Name,
    s_acctbal / 100 AS Latitude, s_acctbal / 50 AS Longitude,
    'nation ' || s_nationkey AS Address
  FROM supplier),
item_raw AS (
  SELECT p_partkey AS Item_Code, ' ' || p_name || ' ' AS Item_Name,
    CASE WHEN p_type <> 'SMALL' THEN p_type END AS Unit,
    CAST(p_size AS DOUBLE) AS good, CAST(p_size + 25 AS DOUBLE) AS normal,
    CAST(p_size + 50 AS DOUBLE) AS bad, CAST(p_size + 75 AS DOUBLE) AS very_bad
  FROM part)"""

CLEAN = """
station AS (
  SELECT Station_Code, trim(Station_Name) AS Station_Name, Latitude, Longitude, Address
  FROM station_raw
  WHERE Station_Code IS NOT NULL AND Station_Name IS NOT NULL
    AND Latitude BETWEEN -90 AND 90 AND Longitude BETWEEN -180 AND 180),
item AS (
  SELECT Item_Code, trim(Item_Name) AS Item_Name, Unit, good, normal, bad, very_bad
  FROM item_raw
  WHERE Item_Code IS NOT NULL AND Item_Name IS NOT NULL AND Unit IS NOT NULL),
measurement AS (
  SELECT DISTINCT ON (Measurement_Date, Station_Code, Item_Code) *
  FROM measurement_raw
  WHERE Measurement_Date IS NOT NULL AND Average_Value >= 0 AND NOT isnan(Average_Value)
    AND Station_Code > 0 AND Item_Code > 0 AND Instrument_Status NOT IN (2, 4, 8, 9)
  ORDER BY Measurement_Date, Station_Code, Item_Code, Average_Value, Instrument_Status)"""


def enriched(name: str, fact: str, station: str, item: str) -> str:
    return f"""
{name} AS (
  SELECT Item_Code, Station_Code, Measurement_Date, Average_Value, Instrument_Status,
    Station_Name, {rounded("Latitude", 3)} AS Latitude, {rounded("Longitude", 3)} AS Longitude,
    Address, Item_Name, Unit,
    CASE WHEN Average_Value <= good THEN 'Good' WHEN Average_Value <= normal THEN 'Normal'
      WHEN Average_Value <= bad THEN 'Bad' ELSE 'Very Bad' END AS Status
  FROM {fact} LEFT JOIN {station} USING (Station_Code) LEFT JOIN {item} USING (Item_Code))"""


TEXT = """
text_rows AS (
  SELECT
    CASE WHEN hour(Measurement_Date) = 0 THEN strftime(Measurement_Date, '%Y/%m/%d')
      ELSE strftime(Measurement_Date, '%Y-%m-%d %H:%M') END AS "Measurement date",
    CAST(Station_Code AS VARCHAR) || CASE WHEN Item_Code = 2 THEN '.0' ELSE '' END AS st,
    CAST(Station_Code AS VARCHAR) AS plain,
    CAST(Item_Code AS VARCHAR) AS "Item code",
    CASE WHEN isnan(Average_Value) THEN 'NaN' ELSE CAST(Average_Value AS VARCHAR) END
      AS "Average value",
    CAST(Instrument_Status AS VARCHAR) AS "Instrument status", Item_Code AS code
  FROM measurement_raw),
texts AS (
  SELECT "Measurement date", CASE WHEN code IS NULL THEN plain ELSE st END AS "Station code",
    "Item code", "Average value", "Instrument status" FROM text_rows)"""

GRAPH = """
v_measurement AS (
  SELECT Station_Code, Item_Code, Measurement_Date AS Raw_Datetime, Average_Value AS Value,
    Instrument_Status, Status, Measurement_Date AS Datetime FROM enriched),
v_station AS (
  SELECT DISTINCT Station_Code, Station_Name AS Name, Latitude, Longitude, Address
  FROM enriched),
v_item AS (SELECT DISTINCT Item_Code, Item_Name AS Name, Unit FROM enriched),
v_status AS (SELECT DISTINCT Status AS Level FROM enriched),
v_time AS (SELECT DISTINCT Measurement_Date AS Raw_Datetime FROM enriched)"""

ENRICHED = enriched("enriched", "measurement", "station", "item")
ENRICHED_RAW = enriched("enriched_raw", "measurement_raw", "station_raw", "item_raw")
STREAMED = enriched("streamed", "measurement_raw", "station", "item")

LATEST = """
latest AS (
  SELECT DISTINCT ON (Station_Code, Item_Code) * FROM enriched
  ORDER BY Station_Code, Item_Code, Measurement_Date DESC)"""

SNAPSHOT = """
SELECT strftime(Measurement_Date, '%Y-%m-%d %H:%M') AS "Datetime",
  Station_Code AS "Station Code", s.Station_Name AS "Station Name",
  Item_Code AS "Item Code", i.Item_Name AS "Item Name",
  Average_Value AS "Value", Status AS "Status"
FROM latest LEFT JOIN station_raw s USING (Station_Code) LEFT JOIN item_raw i USING (Item_Code)"""

HISTORY = f"""
FROM enriched LEFT JOIN station_raw s USING (Station_Code) LEFT JOIN item_raw i USING (Item_Code)
WHERE Item_Code = {HISTORY_ITEM} AND Station_Code = {HISTORY_STATION}"""

LOADS = """
SELECT 'measurements 1' AS "Load", count(*) AS Attempted, count(*) AS Inserted
FROM enriched WHERE Status = 'Bad'
UNION ALL SELECT 'measurements 2', 2 * count(*), count(*) FILTER (WHERE Status <> 'Bad')
FROM enriched
UNION ALL SELECT 'orders 1', count(*), count(DISTINCT o_custkey)
FROM orders WHERE o_orderpriority LIKE '1%'
UNION ALL SELECT 'orders 2', count(*), count(DISTINCT o_custkey)
  - (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderpriority LIKE '1%') FROM orders"""

UPSERTED = f"""
SELECT 'Measurement' AS "Label", * REPLACE (Value + CASE
    WHEN Raw_Datetime >= TIMESTAMP '{LATE_START}' THEN 1 ELSE 0 END AS Value) FROM v_measurement
UNION ALL BY NAME SELECT 'Station' AS "Label", Station_Code,
    CASE WHEN min(Measurement_Date) < TIMESTAMP '{EARLY_END}' THEN Station_Name
      ELSE Station_Name || '!' END AS Name, Latitude, Longitude, Address
  FROM enriched GROUP BY Station_Code, Station_Name, Latitude, Longitude, Address
UNION ALL BY NAME SELECT 'Item' AS "Label", * FROM v_item
UNION ALL BY NAME SELECT 'Status' AS "Label", * FROM v_status
UNION ALL BY NAME SELECT 'MeasurementTime' AS "Label", Raw_Datetime, Raw_Datetime AS Datetime
  FROM v_time"""

TREND = f"""
SELECT strftime(Measurement_Date, '%Y-%m-%d %H:%M') AS "Datetime",
  s.Station_Name AS "Station Name", i.Item_Name AS "Item Name", Average_Value AS "Value",
  Status AS "Status" {HISTORY} ORDER BY Measurement_Date"""

HOT_SPOTS = f"""
SELECT s.Name AS Station, i.Name AS Pollutant, Bad_Count, Total,
  {rounded("100.0::DOUBLE * Bad_Count / Total", 2)} AS Weightage, Avg_Value, Worst_Value
FROM (
  SELECT Station_Code, Item_Code, count(*) AS Total,
    CAST(sum(CASE WHEN contains(Status, 'Bad') THEN 1 ELSE 0 END) AS BIGINT) AS Bad_Count,
    {rounded("avg(Value)", 2)} AS Avg_Value, max(Value) AS Worst_Value
  FROM v_measurement GROUP BY ALL) p
JOIN v_station s USING (Station_Code) JOIN v_item i USING (Item_Code)"""

ITEM_STATUS = """
  SELECT Item_Name, Status, count(*) AS "Count", avg(Average_Value) AS avg_value,
    min(Average_Value) AS min_value, max(Average_Value) AS max_value"""

MEASUREMENT_DOCUMENTS = """
SELECT Measurement_Date AS ts, Average_Value AS avg, Instrument_Status AS instrument_status,
  Status AS status, Station_Code AS station_code, Item_Code AS item_code FROM enriched"""

DETAILS = {
    "validate_nulls": "Measurement_Date IS NULL OR Station_Code IS NULL OR Item_Code IS NULL"
    " OR Average_Value IS NULL",
    "validate_missing_station": "Station_Name IS NULL OR Latitude IS NULL OR Longitude IS NULL",
    "validate_missing_item": "Item_Name IS NULL OR Unit IS NULL",
    "validate_negative": "Average_Value < 0",
    "validate_bad_status": "Instrument_Status IN (2, 4, 8, 9)",
    "validate_bad_latlong": "Latitude NOT BETWEEN -90 AND 90"
    " OR Longitude NOT BETWEEN -180 AND 180",
}

ORPHAN = """
SELECT DISTINCT {key} FROM enriched_raw m
WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{key} = m.{key})"""

DUPLICATES = """
SELECT Measurement_Date, Station_Code, Item_Code, count(*) AS count
FROM enriched_raw GROUP BY ALL HAVING count(*) > 1"""

REASON = """
  CASE WHEN Measurement_Date IS NULL THEN 'Bad date'
    WHEN Station_Code IS NULL OR Item_Code IS NULL OR Average_Value IS NULL THEN 'Missing values'
    WHEN Average_Value < 0 THEN 'Negative average'
    WHEN Station_Code <= 0 OR Item_Code <= 0 THEN 'Invalid codes'
    WHEN Instrument_Status IN (2, 4, 8, 9) THEN 'Unreliable data' END"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _audit(label: str, table: str, *key: str) -> str:
    known = " AND ".join(f"{k} IS NOT NULL" for k in key)
    return f"""
SELECT '{label}' AS "Label", '{",".join(key)}' AS "Key", CAST(coalesce(sum(n), 0) AS BIGINT) AS "Rows",
  count(*) AS "Keys", count(*) FILTER (WHERE n > 1) AS Violations
FROM (SELECT count(*) AS n FROM {table} WHERE {known} GROUP BY {", ".join(key)})"""


def oracle_sql() -> dict[str, str]:
    raw = _with(SOURCES)
    clean = _with(SOURCES, CLEAN)
    full = _with(SOURCES, CLEAN, ENRICHED)
    uncleaned = _with(SOURCES, ENRICHED_RAW)
    text = _with(SOURCES, TEXT)
    graph = _with(SOURCES, CLEAN, ENRICHED, GRAPH)
    streamed = _with(SOURCES, CLEAN, STREAMED)

    def field(name: str) -> str:
        quoted = f"""'"' || "{name}" || '"'"""
        return f"""'"{name}":' || coalesce({quoted}, 'null')"""

    fields = " || ',' || ".join(
        field(n)
        for n in (
            "Measurement date",
            "Station code",
            "Item code",
            "Average value",
            "Instrument status",
        )
    )
    fresh = """
fresh AS (
  SELECT DISTINCT ON (o_custkey) o_custkey AS _id, o_orderkey AS order_no,
    o_orderpriority AS name
  FROM orders ORDER BY o_custkey, o_orderkey),
new_keys AS (SELECT * FROM fresh WHERE _id NOT IN (SELECT s_suppkey FROM supplier))"""
    summary = " UNION ALL ".join(
        [
            f"SELECT 'Duplicates' AS Rule_ID, count(*) AS Validations FROM ({DUPLICATES})",
            f"SELECT 'Orphan_Station', count(*) FROM ({ORPHAN.format(key='Station_Code', dim='station_raw')})",
            f"SELECT 'Orphan_Item', count(*) FROM ({ORPHAN.format(key='Item_Code', dim='item_raw')})",
            *[
                f"SELECT '{rule}', count(*) FROM enriched_raw WHERE {DETAILS[key]}"
                for key, rule in (
                    ("validate_nulls", "Nulls"),
                    ("validate_missing_station", "Missing_Station_Info"),
                    ("validate_missing_item", "Missing_Item_Info"),
                    ("validate_negative", "Negative_Values"),
                    ("validate_bad_status", "Bad_Status"),
                    ("validate_bad_latlong", "Bad_Latitude_Longitude"),
                )
            ],
        ]
    )
    return {
        "recast": text
        + """
SELECT try_strptime("Measurement date", '%Y-%m-%d %H:%M') AS Measurement_Date,
  CAST(CAST("Station code" AS DOUBLE) AS BIGINT) AS Station_Code,
  CAST("Item code" AS BIGINT) AS Item_Code, CAST("Average value" AS DOUBLE) AS Average_Value,
  CAST("Instrument status" AS INTEGER) AS Instrument_Status FROM texts""",
        "trim_strings": """
SELECT c_custkey, trim(' ' || chr(9) || c_name || '  ', ' ') AS c_name FROM customer""",
        "sanitize_columns": raw
        + """
SELECT Station_Code AS Station_code, Station_Name AS Station_name_district_, Address, Latitude, Longitude,
  Station_Code + 1 AS Station_code_2 FROM station_raw""",
        "json_encode": text + f" SELECT '{{' || {fields} || '}}' AS \"value\" FROM texts",
        "json_decode": text + " SELECT * FROM texts",
        "csv_malformed": text
        + """
SELECT CASE WHEN "Item code" IN ('5', '6') THEN 'malformed' ELSE 'row' END AS "Kind",
  coalesce("Measurement date", '') || ',' || coalesce("Station code", '') || ','
  || coalesce("Item code", '') || ',' || coalesce("Average value", '')
  || CASE WHEN "Item code" = '5' THEN '' ELSE ',' || coalesce("Instrument status", '') END
  || CASE WHEN "Item code" = '6' THEN ',more' ELSE '' END AS "Line"
FROM texts""",
        "clean_station": clean + " SELECT * FROM station",
        "clean_item": clean
        + """
SELECT Item_Code, Item_Name, Unit, good AS "Good(Blue)", normal AS "Normal(Green)",
  bad AS "Bad(Yellow)", very_bad AS "Very bad(Red)" FROM item""",
        "clean_measure": clean + " SELECT * FROM measurement",
        "clean_report": clean
        + f"""
, marked AS (
  SELECT coalesce({REASON}, CASE WHEN isnan(Average_Value) THEN 'NaN value'
    WHEN Instrument_Status IS NULL THEN 'NULL instrument status' END, 'valid') AS reason
  FROM measurement_raw)
SELECT 'measurement' AS "Table", reason AS "Outcome", count(*) AS "Rows"
FROM marked WHERE reason <> 'valid' GROUP BY ALL
UNION ALL SELECT 'measurement', 'Raw', count(*) FROM marked
UNION ALL SELECT 'measurement', 'Clean', count(*) FROM measurement
UNION ALL SELECT 'measurement', 'Duplicates', (SELECT count(*) FROM marked WHERE reason = 'valid')
  - (SELECT count(*) FROM measurement)
UNION ALL SELECT 'station', 'Raw', count(*) FROM station_raw
UNION ALL SELECT 'station', 'Clean', count(*) FROM station
UNION ALL SELECT 'item', 'Raw', count(*) FROM item_raw
UNION ALL SELECT 'item', 'Clean', count(*) FROM item""",
        "zero_values": clean + " SELECT * FROM measurement WHERE Average_Value = 0",
        "detect_errors": raw
        + f"""
SELECT * FROM (SELECT *, {REASON} AS Removal_Reason FROM measurement_raw)
WHERE Removal_Reason IS NOT NULL""",
        "error_counts": raw
        + f"""
SELECT * FROM (SELECT {REASON} AS Removal_Reason, count(*) AS count FROM measurement_raw
  GROUP BY ALL) WHERE Removal_Reason IS NOT NULL ORDER BY count DESC, Removal_Reason""",
        "enrich_measure": full + " SELECT * FROM enriched",
        "enrich_measure_shuffled": full + " SELECT * FROM enriched",
        "csv_roundtrip": full + " SELECT * FROM enriched",
        "validate_summary": uncleaned + f" SELECT * FROM ({summary})",
        "validate_duplicates": uncleaned + DUPLICATES,
        "validate_orphan_station": uncleaned
        + ORPHAN.format(key="Station_Code", dim="station_raw"),
        "validate_orphan_item": uncleaned + ORPHAN.format(key="Item_Code", dim="item_raw"),
        **{
            key: uncleaned + f" SELECT * FROM enriched_raw WHERE {condition}"
            for key, condition in DETAILS.items()
        },
        "doc_items": raw
        + """
SELECT Item_Code AS _id, Item_Name AS name, Unit AS unit, good, normal, bad, very_bad
FROM item_raw""",
        "doc_stations": raw
        + """
SELECT Station_Code AS _id, Station_Name AS name, Address AS address, 'Point' AS type,
  Longitude AS longitude, Latitude AS latitude FROM station_raw""",
        "doc_measurements": full + MEASUREMENT_DOCUMENTS,
        "doc_stored_measurements": full + MEASUREMENT_DOCUMENTS,
        "doc_insert_ignore": _with(fresh) + " SELECT * FROM new_keys",
        "doc_insert_counts": _with(fresh)
        + """
SELECT (SELECT count(*) FROM orders) AS Attempted, count(*) AS Inserted,
  (SELECT count(*) FROM orders) - count(*) AS Ignored FROM new_keys""",
        "latest_snapshot": full + "," + LATEST + SNAPSHOT,
        "latest_snapshot_report": full
        + ","
        + LATEST
        + f"""
SELECT * FROM ({SNAPSHOT}) WHERE "Item Name" IS NOT NULL
ORDER BY "Item Name", "Value" DESC, "Station Code", "Item Code" """,
        "historical_trend": full + TREND,
        "history_store": full + TREND,
        "history_head": full
        + f"""
SELECT Measurement_Date AS "Datetime", s.Station_Name AS "Station Name",
  i.Item_Name AS "Item Name", Average_Value AS "Value", Status AS "Status" {HISTORY}
ORDER BY Measurement_Date LIMIT 10""",
        "graph_vertices": graph
        + """
SELECT 'Measurement' AS "Label", * FROM v_measurement
UNION ALL BY NAME SELECT 'Station' AS "Label", * FROM v_station
UNION ALL BY NAME SELECT 'Item' AS "Label", * FROM v_item
UNION ALL BY NAME SELECT 'Status' AS "Label", * FROM v_status
UNION ALL BY NAME SELECT 'MeasurementTime' AS "Label", Raw_Datetime, Raw_Datetime AS Datetime
  FROM v_time""",
        "graph_upsert": graph + UPSERTED,
        "graph_edges": graph
        + """
SELECT "Type", "From", "To", Station_Code, Item_Code, Raw_Datetime,
  CASE WHEN "Type" = 'HAS_STATUS' THEN Status END AS Level
FROM v_measurement, (VALUES ('HAS_MEASUREMENT', 'Station', 'Measurement'),
  ('MEASURED_IN', 'Measurement', 'Item'), ('AT_TIME', 'Measurement', 'MeasurementTime'),
  ('HAS_STATUS', 'Measurement', 'Status')) kinds("Type", "From", "To")""",
        "graph_key_audit": graph
        + " UNION ALL ".join(
            [
                _audit("Station", "station_raw", "Station_Code"),
                _audit("Item", "item_raw", "Item_Code"),
                _audit(
                    "Measurement input",
                    "measurement_raw",
                    "Station_Code",
                    "Item_Code",
                    "Measurement_Date",
                ),
                _audit("Status", "v_status", "Level"),
                _audit("MeasurementTime", "v_time", "Raw_Datetime"),
                _audit(
                    "Measurement", "v_measurement", "Raw_Datetime", "Station_Code", "Item_Code"
                ),
                _audit(
                    "Measurement", "v_measurement", "Station_Code", "Item_Code", "Datetime"
                ),
            ]
        ),
        "graph_paths": graph
        + """
SELECT m.*, s.Name AS Station, i.Name AS Pollutant
FROM v_measurement m JOIN v_station s USING (Station_Code) JOIN v_item i USING (Item_Code)""",
        "hot_spots": graph + HOT_SPOTS,
        "hot_spots_top": graph
        + HOT_SPOTS
        + """
ORDER BY Weightage DESC NULLS FIRST, Avg_Value DESC NULLS FIRST, Worst_Value DESC NULLS FIRST,
  Station_Code, Item_Code LIMIT 30""",
        "daily_avg": graph
        + f"""
SELECT Day, Station, Pollutant, {rounded("avg(Value)", 2)} AS Daily_Avg_Value
FROM (SELECT CAST(Datetime AS DATE) AS Day, s.Name AS Station, i.Name AS Pollutant, Value
  FROM v_measurement JOIN v_station s USING (Station_Code) JOIN v_item i USING (Item_Code))
GROUP BY ALL""",
        "item_status_stats": full + ITEM_STATUS + " FROM enriched GROUP BY ALL",
        "item_status_store": full + ITEM_STATUS + " FROM enriched GROUP BY ALL",
        "latest_store": full
        + ","
        + LATEST
        + """
SELECT Measurement_Date, Station_Code, Item_Code, Average_Value, Instrument_Status, Status,
  Item_Name, Station_Name FROM latest""",
        "item_status_pretty": full
        + f"""
, stats AS ({ITEM_STATUS}, CASE Status WHEN 'Good' THEN 1 WHEN 'Normal' THEN 2
    WHEN 'Bad' THEN 3 WHEN 'Very Bad' THEN 4 ELSE 99 END AS grade_rank
  FROM enriched GROUP BY ALL)
SELECT CASE WHEN row_number() OVER (PARTITION BY Item_Name ORDER BY grade_rank) = 1
    THEN Item_Name ELSE '' END AS Item, Status, "Count",
  {rounded("avg_value", 3)} AS Average, min_value AS Min_Value, max_value AS Max_Value
FROM stats""",
        "processed_roundtrip": full + " SELECT * FROM enriched",
        "doc_load_twice": full + LOADS,
        "doc_store_loads": full + LOADS,
        "doc_edge_cases": raw
        + """
, source AS (
  SELECT CASE WHEN Address <> 'nation 3' THEN Station_Code END AS _id, Station_Name AS name,
    Address AS address, CASE WHEN Address <> 'nation 5' THEN Latitude END AS latitude,
    Longitude AS longitude FROM station_raw),
offered AS (SELECT * FROM source UNION ALL SELECT * REPLACE ('B' || name AS name) FROM source)
SELECT DISTINCT ON (_id) _id, name, address,
  CASE WHEN latitude IS NOT NULL AND longitude IS NOT NULL THEN 'Point' END AS type,
  CASE WHEN latitude IS NOT NULL THEN longitude END AS longitude,
  CASE WHEN longitude IS NOT NULL THEN latitude END AS latitude
FROM offered WHERE _id IS NOT NULL ORDER BY _id, name NULLS FIRST""",
        "graph_conflicts": uncleaned
        + """
, renamed AS (
  SELECT * REPLACE (coalesce(Station_Name, '?') || year(Measurement_Date) AS Station_Name)
  FROM enriched_raw WHERE Measurement_Date IS NOT NULL AND Station_Code IS NOT NULL
    AND Item_Code IS NOT NULL AND Status IS NOT NULL),
last AS (
  SELECT DISTINCT ON (Measurement_Date, Station_Code, Item_Code)
    'Measurement' AS "Label", Measurement_Date AS Raw_Datetime, Station_Code, Item_Code,
    Average_Value AS Value, Instrument_Status, Status
  FROM renamed ORDER BY Measurement_Date, Station_Code, Item_Code,
    Average_Value DESC NULLS LAST, Instrument_Status DESC NULLS LAST, Status DESC),
first AS (
  SELECT DISTINCT ON (Station_Code) 'Station' AS "Label", Station_Code, Station_Name AS Name
  FROM renamed ORDER BY Station_Code, Measurement_Date, Station_Name)
SELECT * FROM last UNION ALL BY NAME SELECT * FROM first""",
        "graph_rejected": uncleaned
        + """
SELECT * REPLACE (coalesce(Station_Name, '?') || year(Measurement_Date) AS Station_Name)
FROM enriched_raw WHERE Measurement_Date IS NULL OR Station_Code IS NULL OR Item_Code IS NULL
  OR Status IS NULL""",
        "stream_bad_records_by_time": streamed
        + """
SELECT Measurement_Date, Item_Code, Item_Name, Station_Name, Average_Value AS Value, Status
FROM streamed WHERE Status = 'Bad'
ORDER BY Measurement_Date, Station_Name, Item_Code, Value""",
        "bad_records": full
        + """
SELECT Measurement_Date, Item_Code, Item_Name, Station_Name, Average_Value AS Value, Status
FROM enriched WHERE Status = 'Bad'""",
        "bad_records_hourly": full
        + """
SELECT date_trunc('hour', Measurement_Date) AS "Hour", Item_Code, Item_Name, Station_Name,
  Average_Value AS Value FROM enriched WHERE Status = 'Bad'""",
        "stream_append": text + " SELECT * FROM texts",
        "stream_clean": clean
        + " SELECT * FROM measurement",
        "stream_clean_store": clean
        + " SELECT * FROM measurement",
        "stream_item_status": streamed
        + ITEM_STATUS
        + " FROM streamed WHERE Average_Value IS NOT NULL GROUP BY ALL",
        "stream_bad_records": streamed
        + """
SELECT Measurement_Date, Item_Code, Item_Name, Station_Name, Average_Value AS Value, Status
FROM streamed WHERE Status = 'Bad'""",
    }
