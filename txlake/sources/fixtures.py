"""Raw inputs derived by Spark from the driver's TPC-H-style tables.

The reference ships no data (its CSV and event stream come from single-machine
simulators).  These builders derive the same *shapes* -- including the four
documented defects at known, deterministic rates -- from ``orders``,
``customer``, ``nation``, ``region`` and ``events`` with integer arithmetic
only, so the rows grow with the tables and a SQL engine can rebuild them
identically.

Join plan: nation and region are fixed-size reference tables (25 and 5 rows by
the TPC-H spec) and are broadcast into the customer scan.  Orders is always the
streamed side: the customer geography is broadcast only after its row count is
proven under a bound, and sort-merge joined on ``o_custkey`` otherwise, so
nothing unbounded is ever broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlake.operators.joins import checked_broadcast
from txlake.schemas import RAW_COLUMNS

# Defect moduli and label tables of the derived fixture.
CITY_MISSING_MOD = 53
SURFACE_MISSING_MOD = 31
COMMA_PRICE_MOD = 11
DUPLICATE_MOD = 101
PROPERTY_TYPES = ["apartment", "villa", "land", "commercial"]  # index = key mod 4
LAND = 2
# status by (key div 4) mod 20: 0..15 registered, 16..18 in_progress, 19 disputed
STATUS_REGISTERED_BELOW = 16
STATUS_IN_PROGRESS_BELOW = 19
SURFACE_BASE, SURFACE_STEP, SURFACE_MOD = 400, 37, 11601
OFFICE_COUNT = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Round-robin an under-partitioned scan over the cluster's cores.

    A scan is split by file and row group; one file with one row group is one
    task.  When the streamed side of a pipeline has fewer partitions than the
    default parallelism, the per-row work after it would run on a few cores, so
    the narrow scan output is repartitioned first.  A large input already has
    more partitions than cores, and this is a no-op.
    """
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
    except Exception:  # a client session without RDD access: leave the scan as is
        return df
    return df.repartition(target) if current < target else df


def _property_type(k: Column) -> Column:
    expr = F.lit(PROPERTY_TYPES[-1])
    for i in reversed(range(len(PROPERTY_TYPES) - 1)):
        expr = F.when(k % 4 == i, F.lit(PROPERTY_TYPES[i])).otherwise(expr)
    return expr


def _status(key: str) -> Column:
    bucket = F.expr(f"({key} div 4) % 20")  # integer division, exact for any long key
    return (
        F.when(bucket < STATUS_REGISTERED_BELOW, F.lit("registered"))
        .when(bucket < STATUS_IN_PROGRESS_BELOW, F.lit("in_progress"))
        .otherwise(F.lit("disputed"))
    )


def _surface_tenths(k: Column) -> Column:
    return F.lit(SURFACE_BASE) + (F.lit(SURFACE_STEP) * k) % SURFACE_MOD


def padded(prefix: str, k: Column, width: int = 7) -> Column:
    """``prefix`` + k zero-padded to ``width`` digits (like ``%07d`` for k >= 0;
    a wider key is kept whole, never truncated)."""
    digits = k.cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits).otherwise(F.lpad(digits, width, "0")))


def _tenths_text(tenths: Column) -> Column:
    """Tenths as a one-decimal number text: 4003 -> "400.3"."""
    return F.concat((tenths / 10).cast("long").cast("string"), F.lit("."), (tenths % 10).cast("string"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw transaction export: ten text columns, defects included.

    One row per order plus a second, identical copy of every order whose key is
    a multiple of ``DUPLICATE_MOD`` (emitted by ``explode``, so the orders scan
    and joins run once).
    """
    orders = spread(
        table(spark, sf_dir, "orders").select(
            "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"
        )
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")

    geo = (
        customer.join(F.broadcast(nation), customer.c_nationkey == nation.n_nationkey)
        .join(F.broadcast(region), nation.n_regionkey == region.r_regionkey)
        .select("c_custkey", "n_name", "r_name")
    )
    k = F.col("o_orderkey")
    price = F.col("o_totalprice").cast("decimal(12,2)")
    tenths = _surface_tenths(k)
    # every geo row is a customer row, so the customer count bounds the broadcast;
    # a row is a key and two names of 25 characters at most
    customers = customer.count()
    rows = orders.join(checked_broadcast(geo, rows=customers, size=100 * customers), orders.o_custkey == geo.c_custkey).select(
        padded("TX", k).alias("transaction_id"),
        padded("LST", k).alias("listing_id"),
        _property_type(k).alias("property_type"),
        F.col("r_name").alias("region"),
        F.when(k % CITY_MISSING_MOD == 0, F.lit("")).otherwise(F.col("n_name")).alias("city"),
        F.when((k % 4 == LAND) & (k % SURFACE_MISSING_MOD == 0), F.lit(""))
        .otherwise(_tenths_text(tenths))
        .alias("surface_m2"),
        # legacy export: whole units with thousands separators (rounded half up first)
        F.when(k % COMMA_PRICE_MOD == 0, F.format_number(F.round(price, 0), 0))
        .otherwise(price.cast("string"))
        .alias("price_mad"),
        _status("o_orderkey").alias("registration_status"),
        F.col("o_orderpriority").alias("source_office"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("transaction_date"),
        # duplicated exports: one extra, identical copy, generated in the same pass
        F.explode(F.sequence(F.lit(1), F.when(k % DUPLICATE_MOD == 0, 2).otherwise(1))).alias("_copy"),
    )
    return rows.select(*RAW_COLUMNS)


def event_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream event per ``events`` row, as typed columns (not yet JSON)."""
    events = spread(table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "value"))
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    geo = nation.join(F.broadcast(region), nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", "n_name", "r_name"
    )
    e = F.col("event_id")
    return events.join(F.broadcast(geo), (events.user_id % 25) == geo.n_nationkey).select(
        padded("STREAM", e).alias("transaction_id"),
        padded("LSTS", e).alias("listing_id"),
        _property_type(e).alias("property_type"),
        F.col("r_name").alias("region"),
        F.col("n_name").alias("city"),
        (_surface_tenths(e) / F.lit(10.0)).alias("surface_m2"),
        F.col("value").alias("price_mad"),
        _status("event_id").alias("registration_status"),
        F.concat(F.lit("office_"), (e % OFFICE_COUNT).cast("string")).alias("source_office"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("event_timestamp"),
    )


def event_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as broker-style messages: one JSON document per row in ``value``."""
    payload = event_payloads(spark, sf_dir)
    return payload.select(F.to_json(F.struct(*payload.columns)).alias("value"))


# Moduli and remainders of the dirty export's further defects.
DIRTY = {
    "bad_price": (17, 3),
    "overflow_price": (19, 5),
    "impossible_date": (23, 7),
    "null_region": (29, 11),
    "null_id": (37, 13),
    "long_id": (41, 17),
    "conflicting_copy": (43, 19),
}


def raw_transactions_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw export with values that no rule can repair, at fixed remainders of
    the order key: prices that are no number or overflow, impossible dates, null
    regions, null and over-long ids, and second copies that differ (no city,
    another surface)."""
    raw = raw_transactions(spark, sf_dir)
    k = F.substring("listing_id", 4, 20).cast("long")
    hit = {name: k % mod == rest for name, (mod, rest) in DIRTY.items()}
    ids = F.when(hit["null_id"], F.lit(None)).when(
        hit["long_id"], F.concat("transaction_id", F.lit("-"), F.repeat(F.lit("x"), F.lit(20)))
    )
    dirty = raw.select(
        ids.when(~hit["null_id"], F.col("transaction_id")).alias("transaction_id"),
        "listing_id",
        "property_type",
        F.when(~hit["null_region"], F.col("region")).alias("region"),
        "city",
        "surface_m2",
        F.when(hit["bad_price"], "n/a").when(hit["overflow_price"], "12345678901.00").otherwise(F.col("price_mad")).alias("price_mad"),
        "registration_status",
        "source_office",
        F.when(hit["impossible_date"], "2024-02-31").otherwise(F.col("transaction_date")).alias("transaction_date"),
    )
    copies = dirty.where(hit["conflicting_copy"]).withColumns({"city": F.lit(None).cast("string"), "surface_m2": F.lit("1.0")})
    return dirty.unionByName(copies)
