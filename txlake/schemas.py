"""Declared schemas: nothing is inferred.

The raw transaction export is read with every column as text so that no value
is reinterpreted before the cleaning rules see it.  Stream events carry typed
measures in JSON.  Clean, dimension and fact schemas use decimals for the
measures, matching the warehouse column definitions (NUMERIC(10,1) surface,
NUMERIC(12,2) price).
"""

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The ten raw export columns, in file order.
RAW_COLUMNS = [
    "transaction_id",
    "listing_id",
    "property_type",
    "region",
    "city",
    "surface_m2",
    "price_mad",
    "registration_status",
    "source_office",
    "transaction_date",
]

RAW_SCHEMA = StructType([StructField(c, StringType(), True) for c in RAW_COLUMNS])

SURFACE_TYPE = DecimalType(10, 1)
PRICE_TYPE = DecimalType(12, 2)

# The stream event payload (eleven fields, two typed measures).
EVENT_SCHEMA = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("listing_id", StringType(), True),
        StructField("property_type", StringType(), True),
        StructField("region", StringType(), True),
        StructField("city", StringType(), True),
        StructField("surface_m2", DoubleType(), True),
        StructField("price_mad", DoubleType(), True),
        StructField("registration_status", StringType(), True),
        StructField("source_office", StringType(), True),
        StructField("transaction_date", StringType(), True),
        StructField("event_timestamp", StringType(), True),
    ]
)
EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# The columns of the fact table, in order.
FACT_COLUMNS = [
    "transaction_id",
    "listing_id",
    "date_id",
    "property_type_id",
    "location_id",
    "registration_status_id",
    "source_office",
    "surface_m2",
    "price_mad",
]

# Fact columns that the warehouse declares NOT NULL.
FACT_NOT_NULL = [c for c in FACT_COLUMNS if c != "surface_m2"]

# Warehouse column limits that the database enforced on load
# (VARCHAR lengths and SMALLINT range), re-checked by the constraint report.
VARCHAR_LIMITS = {
    "fact_transactions.transaction_id": 20,
    "fact_transactions.listing_id": 20,
    "fact_transactions.source_office": 50,
    "dim_property_type.property_type_name": 50,
    "dim_location.region": 100,
    "dim_location.city": 100,
    "dim_registration_status.status_name": 30,
}
SMALLINT_MIN, SMALLINT_MAX = -32768, 32767
