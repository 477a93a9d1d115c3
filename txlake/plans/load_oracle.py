"""Reference SQL (DuckDB) of the queries in ``load_queries``, written by hand."""

from __future__ import annotations

from txlake.plans.oracle import CLEAN_CTE, DIM_KEYS, DIRTY_CTE, DIRTY_STAR_CTE, EVENTS_SQL, RULES, SMALLINT_MAX, SMALLINT_MIN
from txlake.plans.oracle import clean_cte as _clean_cte
from txlake.plans.oracle import with_cte

_FLAT = (
    "transaction_id, listing_id, property_type, region, city, surface_m2, price_mad, "
    "registration_status, source_office, transaction_date"
)
_K = "CAST(substr(listing_id, 4) AS BIGINT)"

RELOAD = with_cte(
    CLEAN_CTE
    + f""",
correction AS (
  SELECT transaction_id, listing_id, property_type, region, city, surface_m2,
         CASE WHEN {_K} % 7 = 0 THEN CAST(1000000 AS DECIMAL(12,2)) ELSE price_mad END AS price_mad,
         registration_status, source_office,
         CASE WHEN year(transaction_date) = 1996 THEN DATE '1997-12-31'
              WHEN {_K} % 13 = 0 THEN DATE '1998-01-15' ELSE transaction_date END AS transaction_date
  FROM clean
  WHERE (year(transaction_date) = 1997 AND {_K} % 19 <> 0) OR (year(transaction_date) = 1996 AND {_K} % 17 = 0)
)""",
    f"""
SELECT {_FLAT} FROM clean
WHERE year(transaction_date) <> 1997 AND transaction_id NOT IN (SELECT transaction_id FROM correction)
UNION ALL SELECT {_FLAT} FROM correction""",
)

SECOND_LOAD = with_cte(
    CLEAN_CTE
    + """,
first_load AS (
  SELECT CAST(row_number() OVER (ORDER BY region, city NULLS FIRST) AS INTEGER) AS location_id, region, city
  FROM (SELECT DISTINCT region, city FROM clean WHERE region IN ('AMERICA', 'EUROPE'))
)""",
    """
SELECT location_id, region, city FROM first_load
UNION ALL
SELECT CAST((SELECT max(location_id) FROM first_load) + row_number() OVER (ORDER BY region, city NULLS FIRST) AS INTEGER),
       region, city
FROM (SELECT DISTINCT region, city FROM clean WHERE region NOT IN ('AMERICA', 'EUROPE'))""",
)

AGAINST_LAKE = with_cte(CLEAN_CTE, f"SELECT {_FLAT} FROM clean WHERE {_K} % 2 = 0 AND {_K} % 3 = 0")

_CHANGES = """
changes AS (
  SELECT printf('LST%07d', l_orderkey) AS listing_id, CAST(l_shipdate AS DATE) AS changed_on,
         min(CASE l_returnflag WHEN 'A' THEN 'in_progress' WHEN 'N' THEN 'registered' ELSE 'disputed' END) AS status
  FROM lineitem GROUP BY 1, 2
)"""

INTERVALS = with_cte(
    _CHANGES
    + """,
runs AS (
  SELECT * FROM changes
  QUALIFY lag(status) OVER (PARTITION BY listing_id ORDER BY changed_on) IS DISTINCT FROM status
)""",
    """
SELECT listing_id, status, changed_on AS valid_from,
       lead(changed_on) OVER (PARTITION BY listing_id ORDER BY changed_on) AS valid_to
FROM runs""",
)

AS_OF = with_cte(
    _CHANGES
    + """,
probes AS (
  SELECT printf('LST%07d', o_orderkey) AS listing_id, CAST(CAST(o_orderdate AS DATE) + 60 AS DATE) AS as_of FROM orders
)""",
    """
SELECT p.listing_id, p.as_of, c.status
FROM probes p ASOF LEFT JOIN changes c ON p.listing_id = c.listing_id AND p.as_of >= c.changed_on""",
)

CUBE = with_cte(
    CLEAN_CTE
    + """,
named AS (
  SELECT region, property_type, CAST(year(transaction_date) AS INTEGER) AS year,
         CAST(quarter(transaction_date) AS INTEGER) AS quarter, price_mad FROM clean
)""",
    """
SELECT region, property_type, year, quarter,
       CAST(GROUPING(region, property_type, year, quarter) AS INTEGER) AS grouped,
       count(*) AS n_transactions, CAST(sum(price_mad) AS DECIMAL(38,2)) AS sum_price_mad,
       CAST(sum(price_mad) AS DOUBLE) / count(price_mad) AS avg_price_mad
FROM named
GROUP BY CUBE (region, property_type, (year, quarter))""",
)

_QUANTILES = [(1, 4), (1, 2), (3, 4), (99, 100)]
MEDIAN = with_cte(
    CLEAN_CTE
    + """,
ranked AS (
  SELECT property_type, CAST(price_mad * 100 AS BIGINT) AS price_cents,
         row_number() OVER (PARTITION BY property_type ORDER BY price_mad) AS place,
         count(*) OVER (PARTITION BY property_type) AS n
  FROM clean WHERE price_mad IS NOT NULL
)""",
    "\nUNION ALL\n".join(
        f"SELECT property_type, {a} AS numerator, {b} AS denominator, price_cents FROM ranked WHERE place = (n * {a} + {b} - 1) // {b}"
        for a, b in _QUANTILES
    ),
)

# Rules beyond the warehouse's own, with their SQL condition of breach.
_MORE_RULES = [
    ("fact_transactions", "check", "price_mad", "price_mad < 20000"),
    ("fact_transactions", "check", "surface_m2", "surface_m2 < 40 OR surface_m2 > 1200"),
    ("fact_transactions", "unique", "listing_id", None),
    ("dim_location", "one_of", "region", "region NOT IN ('AFRICA', 'AMERICA', 'ASIA', 'EUROPE')"),
]


def _verdict(rule: tuple) -> str:
    name, kind, columns, param = rule
    table = "fact" if name == "fact_transactions" else name
    key = "transaction_id" if table == "fact" else DIM_KEYS[name]
    c = columns.split("+")
    head = f"SELECT '{name}' AS table_name, "
    label = f"'{name}.{columns}:{kind}' AS rule"
    if kind in ("primary_key", "unique"):
        some = f"WHERE {c[0]} IS NOT NULL" if len(c) == 1 else ""
        return (
            f"{head}min(CAST({key} AS VARCHAR)) AS row_key, {label}, count(*) - 1 AS n_violations "
            f"FROM {table} {some} GROUP BY {', '.join(c)} HAVING count(*) > 1"
        )
    broken = {
        "not_null": f"{c[0]} IS NULL",
        "max_length": f"length({c[0]}) > {param}",
        "smallint": f"{c[0]} < {SMALLINT_MIN} OR {c[0]} > {SMALLINT_MAX}",
        "foreign_key": f"{c[0]} IS NOT NULL AND {c[0]} NOT IN (SELECT {DIM_KEYS.get(param)} FROM {param})",
        "check": param,
        "one_of": param,
    }[kind]
    return f"{head}CAST({key} AS VARCHAR) AS row_key, {label}, count(*) AS n_violations FROM {table} WHERE {broken} GROUP BY {key}"


VERDICTS = with_cte(DIRTY_STAR_CTE, "\nUNION ALL\n".join(_verdict(r) for r in RULES + _MORE_RULES))

_NUMBERS = {
    "price_mad": "CAST(price_mad * 100 AS BIGINT)",
    "surface_m2": "CAST(surface_m2 * 10 AS BIGINT)",
    "transaction_date": "CAST(transaction_date - DATE '1970-01-01' AS BIGINT)",
}
_TEXTS = ["property_type", "region", "city", "registration_status", "source_office"]


def _long(table: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS column_name, {e} AS v FROM {table}" for n, e in _NUMBERS.items())


def _profile(table: str) -> str:
    numbers = f"""
SELECT column_name, CASE WHEN v IS NULL THEN NULL ELSE 'b' || (SELECT count(*) FROM bounds b WHERE b.column_name = l.column_name AND b.v < l.v) END AS bin
FROM ({_long(table)}) l"""
    texts = " UNION ALL ".join(f"SELECT '{c}', {c} FROM {table}" for c in _TEXTS)
    return f"SELECT column_name, bin, count(*) AS n FROM ({numbers} UNION ALL {texts}) GROUP BY ALL"


# the dirty export is derived beside the clean one, under other names
_DIRTY = _clean_cte("raw_dirty").replace("cleaned", "cleaned_dirty").replace("clean AS (", "clean_dirty AS (")
DRIFT = with_cte(
    DIRTY_CTE
    + _clean_cte("raw")
    + _DIRTY
    + f""",
ranked AS (
  SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY v) AS place,
         count(*) OVER (PARTITION BY column_name) AS n
  FROM ({_long('clean')}) WHERE v IS NOT NULL
),
bounds AS (
  SELECT DISTINCT column_name, v FROM ranked, range(1, 10) AS t(i) WHERE place = (n * i + 9) // 10
),
one AS ({_profile('clean')}),
two AS ({_profile('clean_dirty')}),
joined AS (
  SELECT coalesce(one.column_name, two.column_name) AS column_name, coalesce(one.n, 0) AS a, coalesce(two.n, 0) AS b
  FROM one FULL JOIN two ON one.column_name = two.column_name AND one.bin IS NOT DISTINCT FROM two.bin
),
totals AS (SELECT column_name, sum(a)::BIGINT AS n_first, sum(b)::BIGINT AS n_second FROM joined GROUP BY ALL)""",
    """
SELECT column_name, n_first, n_second,
       CAST(sum(abs(a::HUGEINT * n_second - b::HUGEINT * n_first)) AS DOUBLE) / (n_first::DOUBLE * n_second::DOUBLE * 2) AS distance
FROM joined JOIN totals USING (column_name) GROUP BY column_name, n_first, n_second""",
)

_EVENTS = f"parsed AS (SELECT ev.*, src.event_id, src.ts FROM ({EVENTS_SQL.strip()}) ev JOIN events src ON ev.transaction_id = printf('STREAM%07d', src.event_id))"

STAR = with_cte(
    _EVENTS,
    """
SELECT transaction_id, listing_id, property_type, region, city,
       CAST(surface_m2 AS DECIMAL(10,1)) AS surface_m2, CAST(price_mad AS DECIMAL(12,2)) AS price_mad,
       registration_status, source_office, CAST(transaction_date AS DATE) AS transaction_date
FROM parsed""",
)

_ARRIVALS = (
    _EVENTS
    + """,
marked AS (
  SELECT *, event_id < (SELECT count(*) FROM events) * 3 // 5 AND event_id % 50 <> 7 AS early FROM parsed
),
mark AS (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 2 DAY AS watermark FROM marked WHERE early)"""
)

_PAYLOAD = _FLAT + ", event_timestamp"

DEDUP = with_cte(_ARRIVALS, f"SELECT {_PAYLOAD} FROM marked, mark WHERE early OR ts > watermark")

LATE = with_cte(
    _ARRIVALS,
    """
SELECT (SELECT count(*) FROM marked, mark WHERE early OR ts > watermark) AS n_landed,
       CAST((SELECT count(*) FROM marked, mark WHERE NOT early AND ts <= watermark)
          + (SELECT count(*) FROM marked, mark WHERE event_id % 3 = 0 AND ts <= watermark) AS BIGINT) AS n_late""",
)

HOURLY = with_cte(
    _EVENTS,
    """
SELECT date_trunc('hour', ts) AS window_start, region, count(*) AS n_events,
       CAST(sum(CAST(round(price_mad * 100) AS BIGINT)) AS BIGINT) AS sum_price_cents
FROM parsed
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM events)
GROUP BY ALL""",
)


def oracle_sql() -> dict[str, str]:
    return {
        "fact_reload_window": RELOAD,
        "dim_location_second_load": SECOND_LOAD,
        "dedup_against_lake": AGAINST_LAKE,
        "listing_status_intervals": INTERVALS,
        "listing_status_as_of": AS_OF,
        "price_cube_incremental": CUBE,
        "price_median_by_type": MEDIAN,
        "rule_verdicts_dirty": VERDICTS,
        "load_drift": DRIFT,
        "stream_to_star": STAR,
        "stream_dedup": DEDUP,
        "stream_late_rows": LATE,
        "stream_hourly_by_region": HOURLY,
    }
