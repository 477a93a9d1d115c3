"""Reference SQL for every registered query, written for DuckDB.

The SQL rebuilds each result independently of Spark from the same parquet
tables: the derived raw export, the cleaning rules, the dimensions (keys by
``row_number`` over the natural key, nulls first), the fact and the reports.
Aggregates and computed columns carry the same names and types as the Spark
results.
"""

from __future__ import annotations

# Fixed values, written here by hand so that a wrong rule in the library shows:
# the documented defects with their handling, and the warehouse's rules as
# (table, kind, columns, parameter).
HANDLING = {
    "duplicate_rows": "removed",
    "comma_prices": "repaired",
    "missing_surface": "kept_null",
    "missing_city": "kept_null",
}
DEFECTS = list(HANDLING)
SMALLINT_MIN, SMALLINT_MAX = -32768, 32767
DIM_KEYS = {
    "dim_date": "date_id",
    "dim_property_type": "property_type_id",
    "dim_location": "location_id",
    "dim_registration_status": "registration_status_id",
}
RULES = [
    ("fact_transactions", "primary_key", "transaction_id", None),
    ("fact_transactions", "not_null", "transaction_id", None),
    ("fact_transactions", "not_null", "listing_id", None),
    ("fact_transactions", "not_null", "date_id", None),
    ("fact_transactions", "not_null", "property_type_id", None),
    ("fact_transactions", "not_null", "location_id", None),
    ("fact_transactions", "not_null", "registration_status_id", None),
    ("fact_transactions", "not_null", "source_office", None),
    ("fact_transactions", "not_null", "price_mad", None),
    ("fact_transactions", "foreign_key", "date_id", "dim_date"),
    ("fact_transactions", "foreign_key", "property_type_id", "dim_property_type"),
    ("fact_transactions", "foreign_key", "location_id", "dim_location"),
    ("fact_transactions", "foreign_key", "registration_status_id", "dim_registration_status"),
    ("fact_transactions", "max_length", "transaction_id", 20),
    ("fact_transactions", "max_length", "listing_id", 20),
    ("fact_transactions", "max_length", "source_office", 50),
    ("dim_date", "primary_key", "date_id", None),
    ("dim_date", "not_null", "date_id", None),
    ("dim_date", "not_null", "full_date", None),
    ("dim_date", "unique", "full_date", None),
    ("dim_date", "not_null", "year", None),
    ("dim_date", "not_null", "quarter", None),
    ("dim_date", "not_null", "month", None),
    ("dim_date", "not_null", "day_of_week", None),
    ("dim_date", "smallint", "year", None),
    ("dim_date", "smallint", "quarter", None),
    ("dim_date", "smallint", "month", None),
    ("dim_date", "smallint", "day_of_week", None),
    ("dim_property_type", "primary_key", "property_type_id", None),
    ("dim_property_type", "not_null", "property_type_id", None),
    ("dim_property_type", "not_null", "property_type_name", None),
    ("dim_property_type", "unique", "property_type_name", None),
    ("dim_property_type", "max_length", "property_type_name", 50),
    ("dim_location", "primary_key", "location_id", None),
    ("dim_location", "not_null", "location_id", None),
    ("dim_location", "not_null", "region", None),
    ("dim_location", "unique", "region+city", None),
    ("dim_location", "max_length", "region", 100),
    ("dim_location", "max_length", "city", 100),
    ("dim_registration_status", "primary_key", "registration_status_id", None),
    ("dim_registration_status", "not_null", "registration_status_id", None),
    ("dim_registration_status", "not_null", "status_name", None),
    ("dim_registration_status", "unique", "status_name", None),
    ("dim_registration_status", "max_length", "status_name", 30),
]

_RAW_COLS = (
    "transaction_id, listing_id, property_type, region, city, surface_m2, price_mad, "
    "registration_status, source_office, transaction_date"
)


def _property_type(k: str) -> str:
    return (
        f"CASE {k} % 4 WHEN 0 THEN 'apartment' WHEN 1 THEN 'villa' "
        f"WHEN 2 THEN 'land' ELSE 'commercial' END"
    )


def _status(k: str) -> str:
    return (
        f"CASE WHEN ({k} // 4) % 20 < 16 THEN 'registered' "
        f"WHEN ({k} // 4) % 20 < 19 THEN 'in_progress' ELSE 'disputed' END"
    )


def _tenths(k: str) -> str:
    return f"(400 + (37 * {k}) % 11601)"


RAW_CTE = f"""
raw_base AS (
  SELECT
    o.o_orderkey AS k,
    printf('TX%07d', o.o_orderkey) AS transaction_id,
    printf('LST%07d', o.o_orderkey) AS listing_id,
    {_property_type('o.o_orderkey')} AS property_type,
    r.r_name AS region,
    CASE WHEN o.o_orderkey % 53 = 0 THEN '' ELSE n.n_name END AS city,
    CASE WHEN o.o_orderkey % 4 = 2 AND o.o_orderkey % 31 = 0 THEN ''
         ELSE printf('%d.%d', {_tenths('o.o_orderkey')} // 10, {_tenths('o.o_orderkey')} % 10) END AS surface_m2,
    CASE WHEN o.o_orderkey % 11 = 0
         THEN format('{{:,}}', CAST(round(CAST(o.o_totalprice AS DECIMAL(12,2)), 0) AS BIGINT))
         ELSE CAST(CAST(o.o_totalprice AS DECIMAL(12,2)) AS VARCHAR) END AS price_mad,
    {_status('o.o_orderkey')} AS registration_status,
    o.o_orderpriority AS source_office,
    strftime(o.o_orderdate, '%Y-%m-%d') AS transaction_date
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
raw AS (
  SELECT {_RAW_COLS} FROM raw_base
  UNION ALL
  SELECT {_RAW_COLS} FROM raw_base WHERE k % 101 = 0
)"""

# A CSV round trip turns empty fields into nulls.
RAW_CSV_CTE = (
    RAW_CTE
    + """,
raw_csv AS (
  SELECT """
    + ", ".join(f"nullif({c}, '') AS {c}" for c in _RAW_COLS.split(", "))
    + """
  FROM raw
)"""
)

_CLEAN_ORDER = ", ".join(
    f"{c} NULLS LAST"
    for c in (
        "listing_id",
        "property_type",
        "region",
        "city",
        "surface_m2",
        "price_mad",
        "registration_status",
        "source_office",
        "transaction_date",
    )
)


def clean_cte(source: str) -> str:
    return f""",
cleaned AS (
  SELECT
    transaction_id, listing_id, property_type, region,
    nullif(city, '') AS city,
    TRY_CAST(nullif(surface_m2, '') AS DECIMAL(10,1)) AS surface_m2,
    TRY_CAST(replace(price_mad, ',', '') AS DECIMAL(12,2)) AS price_mad,
    registration_status, source_office,
    CAST(try_strptime(transaction_date, '%Y-%m-%d') AS DATE) AS transaction_date
  FROM {source}
),
clean AS (
  SELECT * FROM cleaned
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_CLEAN_ORDER}) = 1
)"""


CLEAN_CTE = RAW_CTE + clean_cte("raw")


def _dim_date_cte(dow: str) -> str:
    return f""",
dim_date AS (
  SELECT CAST(row_number() OVER (ORDER BY full_date) AS INTEGER) AS date_id,
         full_date,
         CAST(year(full_date) AS INTEGER) AS year,
         CAST(quarter(full_date) AS INTEGER) AS quarter,
         CAST(month(full_date) AS INTEGER) AS month,
         CAST({dow} AS INTEGER) AS day_of_week
  FROM (SELECT DISTINCT transaction_date AS full_date FROM clean WHERE transaction_date IS NOT NULL)
)"""


_STAR = (
    _dim_date_cte("isodow(full_date)")
    + """,
dim_property_type AS (
  SELECT CAST(row_number() OVER (ORDER BY property_type_name) AS INTEGER) AS property_type_id, property_type_name
  FROM (SELECT DISTINCT property_type AS property_type_name FROM clean WHERE property_type IS NOT NULL)
),
dim_location AS (
  SELECT CAST(row_number() OVER (ORDER BY region NULLS FIRST, city NULLS FIRST) AS INTEGER) AS location_id, region, city
  FROM (SELECT DISTINCT region, city FROM clean WHERE region IS NOT NULL)
),
dim_registration_status AS (
  SELECT CAST(row_number() OVER (ORDER BY status_name) AS INTEGER) AS registration_status_id, status_name
  FROM (SELECT DISTINCT registration_status AS status_name FROM clean WHERE registration_status IS NOT NULL)
),
fact AS (
  SELECT c.transaction_id, c.listing_id, d.date_id, t.property_type_id, l.location_id,
         s.registration_status_id, c.source_office, c.surface_m2, c.price_mad
  FROM clean c
  LEFT JOIN dim_date d ON c.transaction_date = d.full_date
  LEFT JOIN dim_property_type t ON c.property_type = t.property_type_name
  LEFT JOIN dim_location l ON c.region = l.region AND c.city IS NOT DISTINCT FROM l.city
  LEFT JOIN dim_registration_status s ON c.registration_status = s.status_name
)"""
)

STAR_CTE = CLEAN_CTE + _STAR

_K = "CAST(substr(listing_id, 4) AS BIGINT)"
DIRTY_CTE = (
    RAW_CTE
    + f""",
dirty AS (
  SELECT {_K} AS k,
    CASE WHEN {_K} % 37 = 13 THEN NULL WHEN {_K} % 41 = 17 THEN transaction_id || '-' || repeat('x', 20)
         ELSE transaction_id END AS transaction_id,
    listing_id, property_type,
    CASE WHEN {_K} % 29 = 11 THEN NULL ELSE region END AS region,
    city, surface_m2,
    CASE WHEN {_K} % 17 = 3 THEN 'n/a' WHEN {_K} % 19 = 5 THEN '12345678901.00' ELSE price_mad END AS price_mad,
    registration_status, source_office,
    CASE WHEN {_K} % 23 = 7 THEN '2024-02-31' ELSE transaction_date END AS transaction_date
  FROM raw
),
raw_dirty AS (
  SELECT {_RAW_COLS} FROM dirty
  UNION ALL
  SELECT transaction_id, listing_id, property_type, region, NULL, '1.0', price_mad, registration_status,
         source_office, transaction_date FROM dirty WHERE k % 43 = 19
)"""
)
DIRTY_CLEAN_CTE = DIRTY_CTE + clean_cte("raw_dirty")
DIRTY_STAR_CTE = DIRTY_CLEAN_CTE + _STAR

_NOT_NULL = [columns for table_name, kind, columns, _ in RULES if (table_name, kind) == ("fact_transactions", "not_null")]


def _reconciliation(source: str) -> str:
    missing = lambda c: f"({c} IS NULL OR {c} = '')"
    ids = lambda cond: f"CAST(count(DISTINCT CASE WHEN {cond} THEN coalesce(transaction_id, chr(1)) END) AS BIGINT)"
    rows = lambda cond: f"CAST(count_if({cond}) AS BIGINT)"
    comma = "contains(price_mad, ',')"
    parsed = f"({comma} AND TRY_CAST(replace(price_mad, ',', '') AS DECIMAL(12,2)) IS NOT NULL)"
    return f"""
SELECT 'duplicate_rows' AS defect, 'removed' AS handling, CAST(sum(n - 1) AS BIGINT) AS raw_rows,
       CAST(count_if(n > 1) AS BIGINT) AS n_ids, CAST(sum(n - 1) AS BIGINT) AS n_handled
FROM (SELECT count(*) AS n FROM {source} GROUP BY transaction_id)
UNION ALL SELECT 'comma_prices', 'repaired', {rows(comma)}, {ids(comma)}, {ids(parsed)} FROM {source}
UNION ALL SELECT 'missing_surface', 'kept_null', {rows(missing('surface_m2'))}, {ids(missing('surface_m2'))}, {ids(missing('surface_m2'))} FROM {source}
UNION ALL SELECT 'missing_city', 'kept_null', {rows(missing('city'))}, {ids(missing('city'))}, {ids(missing('city'))} FROM {source}"""


EVENTS_SQL = f"""
SELECT
  printf('STREAM%07d', e.event_id) AS transaction_id,
  printf('LSTS%07d', e.event_id) AS listing_id,
  {_property_type('e.event_id')} AS property_type,
  r.r_name AS region,
  n.n_name AS city,
  CAST({_tenths('e.event_id')} AS DOUBLE) / 10.0 AS surface_m2,
  e.value AS price_mad,
  {_status('e.event_id')} AS registration_status,
  printf('office_%d', e.event_id % 5) AS source_office,
  strftime(e.ts, '%Y-%m-%d') AS transaction_date,
  strftime(e.ts, '%Y-%m-%dT%H:%M:%S.%f') AS event_timestamp
FROM events e
JOIN nation n ON e.user_id % 25 = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey"""


def with_cte(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body.strip()}"


def _defect_profile_body(source: str) -> str:
    one = f"""
profile AS (
  SELECT
    CAST(count(*) AS BIGINT) AS total_rows,
    CAST(count(*) - (count(DISTINCT transaction_id)
         + coalesce(max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END), 0)) AS BIGINT) AS duplicate_rows,
    CAST(count_if(contains(price_mad, ',')) AS BIGINT) AS comma_prices,
    CAST(count_if(surface_m2 IS NULL OR surface_m2 = '') AS BIGINT) AS missing_surface,
    CAST(count_if(city IS NULL OR city = '') AS BIGINT) AS missing_city
  FROM {source}
),
defects AS (
  """ + "\n  UNION ALL\n  ".join(
        f"SELECT '{d}' AS defect, {d} AS n_rows, total_rows FROM profile" for d in DEFECTS
    ) + "\n)"
    return one


def _rule_sql(rule: tuple) -> str:
    table_name, kind, columns, param = rule
    table = "fact" if table_name == "fact_transactions" else table_name
    c = columns.split("+")
    head = f"SELECT '{table_name}.{columns}:{kind}' AS rule, '{table_name}' AS table_name, '{kind}' AS kind, "
    if kind == "primary_key" or (kind == "unique" and len(c) == 1):
        return f"{head}CAST(count({c[0]}) - count(DISTINCT {c[0]}) AS BIGINT) AS violations FROM {table}"
    if kind == "unique":
        cols = ", ".join(c)
        return (
            f"{head}CAST((SELECT count(*) FROM {table}) - "
            f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {table})) AS BIGINT) AS violations"
        )
    if kind == "foreign_key":
        key = DIM_KEYS[param]
        return (
            f"{head}CAST(count_if(f.{c[0]} IS NOT NULL AND d.{key} IS NULL) AS BIGINT) AS violations "
            f"FROM {table} f LEFT JOIN {param} d ON f.{c[0]} = d.{key}"
        )
    broken = {
        "not_null": f"{c[0]} IS NULL",
        "max_length": f"length({c[0]}) > {param}",
        "smallint": f"{c[0]} < {SMALLINT_MIN} OR {c[0]} > {SMALLINT_MAX}",
    }[kind]
    return f"{head}CAST(count_if({broken}) AS BIGINT) AS violations FROM {table}"


_FLAT = """
SELECT c.transaction_id, c.listing_id, c.property_type, c.region, c.city, c.surface_m2, c.price_mad,
       c.registration_status, c.source_office, c.transaction_date
FROM clean c"""

_AVG_PRICE = """
SELECT region, property_type,
       CAST(year(transaction_date) AS INTEGER) AS year,
       CAST(quarter(transaction_date) AS INTEGER) AS quarter,
       CAST(count(*) AS BIGINT) AS n_transactions,
       CAST(sum(price_mad) AS DECIMAL(38,2)) AS sum_price_mad,
       CAST(sum(price_mad) AS DOUBLE) / count(price_mad) AS avg_price_mad
FROM clean
GROUP BY region, property_type, year(transaction_date), quarter(transaction_date)"""


_PARSE_FAILURES = """
SELECT 'price_mad' AS field,
       CAST(count_if(price_mad IS NOT NULL AND price_mad <> ''
            AND TRY_CAST(replace(price_mad, ',', '') AS DECIMAL(12,2)) IS NULL) AS BIGINT) AS n_failed
FROM {source}
UNION ALL
SELECT 'surface_m2',
       CAST(count_if(surface_m2 IS NOT NULL AND surface_m2 <> ''
            AND TRY_CAST(surface_m2 AS DECIMAL(10,1)) IS NULL) AS BIGINT)
FROM {source}
UNION ALL
SELECT 'transaction_date',
       CAST(count_if(transaction_date IS NOT NULL AND transaction_date <> ''
            AND try_strptime(transaction_date, '%Y-%m-%d') IS NULL) AS BIGINT)
FROM {source}"""

_PROFILE = "SELECT defect, n_rows, total_rows, CAST(n_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) AS share FROM defects"


def oracle_sql() -> dict[str, str]:
    clean_cols = (
        "transaction_id, listing_id, property_type, region, city, surface_m2, price_mad, "
        "registration_status, source_office, transaction_date"
    )
    sql = {
        "csv_scan_raw": with_cte(RAW_CSV_CTE, f"SELECT {_RAW_COLS} FROM raw_csv"),
        "raw_zone_parquet": with_cte(RAW_CSV_CTE, f"SELECT {_RAW_COLS} FROM raw_csv"),
        "raw_replay": with_cte(RAW_CSV_CTE + clean_cte("raw_csv"), f"SELECT {clean_cols} FROM clean"),
        "dedup_by_key": with_cte(
            RAW_CTE,
            f"""SELECT {_RAW_COLS} FROM raw
QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY {_CLEAN_ORDER}) = 1""",
        ),
        "price_clean": with_cte(CLEAN_CTE, "SELECT transaction_id, price_mad FROM clean"),
        "surface_clean": with_cte(CLEAN_CTE, "SELECT transaction_id, surface_m2 FROM clean"),
        "city_clean": with_cte(CLEAN_CTE, "SELECT transaction_id, city FROM clean"),
        "date_parse": with_cte(CLEAN_CTE, "SELECT transaction_id, transaction_date FROM clean"),
        "clean_transactions": with_cte(CLEAN_CTE, f"SELECT {clean_cols} FROM clean"),
        "dim_date": with_cte(STAR_CTE, "SELECT * FROM dim_date"),
        "dim_date_sunday_start": with_cte(
            CLEAN_CTE + _dim_date_cte("dayofweek(full_date) + 1"), "SELECT * FROM dim_date"
        ),
        "dim_property_type": with_cte(STAR_CTE, "SELECT * FROM dim_property_type"),
        "dim_location": with_cte(STAR_CTE, "SELECT * FROM dim_location"),
        "dim_registration_status": with_cte(STAR_CTE, "SELECT * FROM dim_registration_status"),
        "fact_transactions": with_cte(STAR_CTE, "SELECT * FROM fact"),
        "star_flatten": with_cte(CLEAN_CTE, _FLAT),
        "avg_price_region_type_quarter": with_cte(CLEAN_CTE, _AVG_PRICE),
        "status_breakdown": with_cte(
            CLEAN_CTE,
            """
SELECT registration_status AS status_name,
       CAST(count(*) AS BIGINT) AS n_transactions,
       CAST(sum(price_mad) AS DECIMAL(38,2)) AS sum_price_mad,
       CAST(sum(price_mad) AS DOUBLE) / count(price_mad) AS avg_price_mad
FROM clean GROUP BY registration_status""",
        ),
        "null_aware_measures": with_cte(
            CLEAN_CTE,
            """
SELECT property_type,
       CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count(surface_m2) AS BIGINT) AS n_surface,
       CAST(count(*) - count(surface_m2) AS BIGINT) AS n_surface_missing,
       CAST(sum(surface_m2) AS DECIMAL(38,1)) AS sum_surface_m2,
       CAST(sum(surface_m2) AS DOUBLE) / count(surface_m2) AS avg_surface_m2
FROM clean GROUP BY property_type""",
        ),
        "stage_counts": with_cte(
            STAR_CTE,
            """
SELECT 'raw' AS stage, CAST(count(*) AS BIGINT) AS n_rows FROM raw
UNION ALL SELECT 'clean', CAST(count(*) AS BIGINT) FROM clean
UNION ALL SELECT 'fact', CAST(count(*) AS BIGINT) FROM fact""",
        ),
        "defect_profile": with_cte(
            RAW_CTE + "," + _defect_profile_body("raw"),
            "SELECT defect, n_rows, total_rows, CAST(n_rows AS DOUBLE) / CAST(total_rows AS DOUBLE) AS share FROM defects",
        ),
        "missing_surface_by_type": with_cte(
            RAW_CTE,
            """
SELECT property_type,
       CAST(count(*) AS BIGINT) AS n_rows,
       CAST(count_if(surface_m2 IS NULL OR surface_m2 = '') AS BIGINT) AS n_missing_surface,
       CAST(count_if(surface_m2 IS NULL OR surface_m2 = '') AS DOUBLE) / CAST(count(*) AS DOUBLE) AS share
FROM raw GROUP BY property_type""",
        ),
        "parse_failures": with_cte(RAW_CTE, _PARSE_FAILURES.format(source="raw")),
        "defect_reconciliation": with_cte(RAW_CTE, _reconciliation("raw")),
        "clean_dirty": with_cte(DIRTY_CLEAN_CTE, f"SELECT {clean_cols} FROM clean"),
        "fact_dirty": with_cte(
            DIRTY_STAR_CTE, "SELECT * FROM fact WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _NOT_NULL)
        ),
        "fact_rejects_dirty": with_cte(
            DIRTY_STAR_CTE,
            "SELECT *, concat_ws(',', "
            + ", ".join(f"CASE WHEN {c} IS NULL THEN '{c}' END" for c in _NOT_NULL)
            + ") AS broken_rules FROM fact WHERE "
            + " OR ".join(f"{c} IS NULL" for c in _NOT_NULL),
        ),
        "constraint_report_dirty": with_cte(DIRTY_STAR_CTE, "\nUNION ALL\n".join(_rule_sql(r) for r in RULES)),
        "parse_failures_dirty": with_cte(DIRTY_CTE, _PARSE_FAILURES.format(source="raw_dirty")),
        "defect_profile_dirty": with_cte(DIRTY_CTE + "," + _defect_profile_body("raw_dirty"), _PROFILE),
        "defect_reconciliation_dirty": with_cte(DIRTY_CTE, _reconciliation("raw_dirty")),
        "dedup_conflicts_dirty": with_cte(
            DIRTY_CTE,
            f"""
SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(count(*) AS BIGINT) AS n_keys,
       CAST(count_if(d > 1) AS BIGINT) AS n_conflicting_keys,
       CAST(coalesce(sum(n) FILTER (transaction_id IS NULL), 0) AS BIGINT) AS n_null_key_rows
FROM (SELECT transaction_id, count(*) AS n, count(DISTINCT ({_RAW_COLS})) AS d FROM raw_dirty GROUP BY transaction_id)""",
        ),
        "csv_malformed_rows": with_cte(
            RAW_CTE,
            f"SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(count_if({_K} % 97 = 0) AS BIGINT) AS n_malformed FROM raw",
        ),
        "avg_price_one_year": with_cte(
            CLEAN_CTE, _AVG_PRICE.replace("FROM clean", "FROM clean WHERE year(transaction_date) = 1997")
        ),
        "constraint_report": with_cte(STAR_CTE, "\nUNION ALL\n".join(_rule_sql(r) for r in RULES)),
        "stream_parse": EVENTS_SQL.strip(),
        "stream_to_lake": EVENTS_SQL.strip(),
        "stream_restart": EVENTS_SQL.strip(),
    }
    # scale-path variants compute the same tables as their base queries
    sql["dedup_by_key_split"] = sql["dedup_by_key"]
    sql["dim_date_distributed_keys"] = sql["dim_date"]
    sql["fact_transactions_shuffle_joins"] = sql["fact_transactions"]
    return sql
