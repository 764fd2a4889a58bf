"""Trip-shaped inputs built from the TPC-H-like test tables.

The operators are generic; this module maps the driver's tables onto the
trip model so the whole pipeline runs on them:

* trips = lineitem JOIN orders JOIN customer JOIN supplier, one trip per line
  item: vendor = line number, rate code = order priority digit, payment =
  return flag, pickup = order date, drop-off = ship date, pickup / drop-off
  location = customer / supplier nation;
* NULLs are injected in two columns (for the row hash), and the line items
  with line number 3 are repeated (exact duplicates for dedup);
* dimensions: vendor, rate code and payment from small seed rows with gaps
  in their ids (so some trips find no member); location from nation and
  region (borough = region name, zone = nation name).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.broadcast import bounded_broadcast
from strata.operators.dimensions import build_dimension
from strata.plans import model

# Test seed rows (id, description). Ids have gaps on purpose.
VENDOR_ROWS = [(1, "Vendor One"), (2, "Vendor Two"), (3, "Vendor Three"), (6, "Vendor Six")]
RATE_CODE_ROWS = [(1, "Standard rate"), (2, "Airport"), (4, "Suburban"), (99, "Unknown")]
PAYMENT_ROWS = [(1, "Card"), (2, "Cash"), (3, "No charge")]
# First valid pickup date for the test data (orders start in 1995).
FIRST_VALID = "1996-01-01"
DUPLICATED_LINE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped trips: the 20 trip columns with declared types."""
    li = table(spark, sf_dir, "lineitem")
    od = table(spark, sf_dir, "orders")
    cu = table(spark, sf_dir, "customer")
    su = table(spark, sf_dir, "supplier")
    # Orders grow with line items: always a shuffle join. Customer and
    # supplier are broadcast only while they are within the size bound;
    # customers join the orders, so that beyond it trips are not moved for them.
    od = od.join(bounded_broadcast(cu), od.o_custkey == cu.c_custkey)
    j = (li.join(od.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
           .join(bounded_broadcast(su), F.col("l_suppkey") == su.s_suppkey))
    pay = (F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2)
            .when(F.col("l_returnflag") == "R", 3))
    cols = {
        "VendorID": F.col("l_linenumber").cast("bigint"),
        "tpep_pickup_datetime": F.col("o_orderdate"),
        "tpep_dropoff_datetime": F.col("l_shipdate"),
        "passenger_count": F.col("l_quantity").cast("int"),
        "trip_distance": F.col("l_quantity"),
        "RatecodeID": F.substring("o_orderpriority", 1, 1).cast("bigint"),
        "store_and_fwd_flag": F.when(F.col("l_partkey") % 10 == 0, F.lit(None)).otherwise(F.col("l_returnflag")),
        "PULocationID": F.col("c_nationkey").cast("bigint"),
        "DOLocationID": F.col("s_nationkey").cast("bigint"),
        "payment_type": pay.cast("bigint"),
        "fare_amount": F.col("l_extendedprice"),
        "extra": F.when(F.col("l_partkey") % 7 == 0, F.lit(None)).otherwise(F.col("l_discount")),
        "mta_tax": F.col("l_tax"),
        "tip_amount": F.col("l_tax"),
        "tolls_amount": F.col("c_acctbal"),
        "improvement_surcharge": F.col("s_acctbal"),
        "total_amount": F.col("o_totalprice"),
        "congestion_surcharge": F.col("l_discount"),
        "airport_fee": F.lit(None).cast("double"),
        "cbd_congestion_fee": F.lit(None).cast("double"),
    }
    return j.select(*[e.cast(model.BRONZE_SCHEMA[n]).alias(n) for n, e in cols.items()])


def dirty_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips plus exact copies of every trip with line number 3."""
    # One scan: rows to repeat fan out to two copies (same result as a UNION ALL
    # of the table and its slice, without reading and joining the tables twice).
    t = trips(spark, sf_dir)
    copies = F.when(F.col("VendorID") == DUPLICATED_LINE, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.withColumn("__copy", F.explode(copies)).drop("__copy")


def seed_frames(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four seed inputs (natural key + attributes), before surrogate keys."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    location = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").cast("int").alias("location_id"),
        F.col("r_name").alias("borough"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("service_zone"),
    )
    def seed(rows, schema):
        # an inline table: Catalyst knows how small it is, so that facts may count on its broadcast
        values = ", ".join(f"({key}, '{text}')" for key, text in rows)
        return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(schema.names)})").to(schema)

    return {
        "dim_vendor": seed(VENDOR_ROWS, model.VENDOR_SEED),
        "dim_rate_code": seed(RATE_CODE_ROWS, model.RATE_CODE_SEED),
        "dim_payment_method": seed(PAYMENT_ROWS, model.PAYMENT_SEED),
        "dim_location": location,
    }


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four trip dimensions with dense surrogate keys."""
    out = {}
    for name, seed in seed_frames(spark, sf_dir).items():
        nk, sk = model.DIMENSION_KEYS[name]
        out[name] = build_dimension(seed, nk, sk, stage_input=False)  # a few rows, or a scan of two small tables
    return out
