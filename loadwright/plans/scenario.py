"""End-to-end governed load on the ``customer`` table (registered query).

Four deliveries are written as text into an input folder below the shared
checkpoint folder:

  UPDT 20191201-000000  customers of nations 20 and above, balance + 50 (older than the FULL: not applied)
  FULL 20200101-000000  customers outside segment BUILDING
  UPDT 20200201-000000  customers of nations below 10, balance + 100; the
                        MACHINERY lines carry 'xx' as nation key (rejected)
  PURG 20200301-000000  every customer (unknown mode: not applied)

The load runs with key ``c_custkey`` and returns the final target table.
The bucketed variant hash-partitions the target by the key (one merged
snapshot for the plan, rewriting only the touched buckets).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadwright.functions.keys import BUCKET_COLUMN
from loadwright.functions.render import delimited_line
from loadwright.plans.journal import Journal
from loadwright.plans.load import PrimaryKeyViolation, run_load
from loadwright.plans.spec import LoadSpec
from loadwright.plans.store import TableStore
from loadwright.plans.target import SEGMENT
from loadwright.session import scratch_path

CUSTOMER_DDL = "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
RUN_TS = "2020-03-10 16:01:00"
REJECT_SEGMENT = "MACHINERY"


def customer_deliveries(customer: DataFrame):
    """(file date, mode, rows, balance delta, damage nation key?) of the scenario."""
    return [
        ("20191201-000000", "UPDT", customer.where(F.col("c_nationkey") >= 20), 50.0, False),
        ("20200101-000000", "FULL", customer.where(F.col("c_mktsegment") != "BUILDING"), 0.0, False),
        ("20200201-000000", "UPDT", customer.where(F.col("c_nationkey") < 10), 100.0, True),
        ("20200301-000000", "PURG", customer, 0.0, False),
    ]


def append_deliveries(customer: DataFrame):
    """Deliveries of two runs without a key (each is applied as INST)."""
    return [
        ("20200101-000000", "UPDT", customer.where(F.col("c_nationkey") < 10), 0.0, False),
        ("20200201-000000", "UPDT", customer.where(F.col("c_nationkey") >= 15), 100.0, True),
    ]


def write_deliveries(deliveries, in_dir: str) -> None:
    for file_date, mode, rows, delta, damage in deliveries:
        nation = F.col("c_nationkey").cast("string")
        if damage:
            nation = F.when(F.col("c_mktsegment") == REJECT_SEGMENT, F.lit("xx")).otherwise(nation)
        balance = F.col("c_acctbal") + F.lit(delta) if delta else F.col("c_acctbal")
        line = delimited_line(["c_custkey", "c_name", nation, balance, "c_mktsegment"], "|")
        name = f"SRC.BASE.CUSTOMER.J.00.MFT.{mode}.ALL.000.{file_date}.{file_date}"
        rows.select(line.alias("value")).write.text(os.path.join(in_dir, name))


def _loaded(spark: SparkSession, sf_dir: str, buckets: int | None, bulk: bool, runs: int, **options):
    root = scratch_path(spark, "governed")
    suffix = os.path.basename(root).rsplit("-", 1)[-1]
    in_dir = f"{root}/IN"
    customer = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    write_deliveries(customer_deliveries(customer), in_dir)
    spec = LoadSpec("src.base.customer", CUSTOMER_DDL, delimiter="|", column_id="c_custkey",
                    table_key="c_custkey", custom_table_name=f"CUSTOMER_{suffix}", buckets=buckets, **options)
    store = TableStore(spark, f"{root}/warehouse")
    journal = Journal(store, prefix=f"J{suffix}_")
    for _ in range(runs):
        run_load(spark, spec, in_dir, store, journal, run_ts=RUN_TS, bulk=bulk, skip_applied=runs > 1)
    return store, spec, journal


def governed_customer_load(spark: SparkSession, sf_dir: str, buckets: int | None = None,
                           bulk: bool = False, runs: int = 1) -> DataFrame:
    """The target after ``runs`` loads of the folder (more than one: applied files are skipped)."""
    store, spec, _ = _loaded(spark, sf_dir, buckets, bulk, runs)
    out = store.read(spec.table_name)
    return out.drop(BUCKET_COLUMN) if buckets else out


def governed_customer_journal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event, value) of the load's journal."""
    _, _, journal = _loaded(spark, sf_dir, None, False, 1)
    return journal.events().where("SD_EVENT <> 'Table_Creation'").select(
        F.col("SD_EVENT").alias("event"), F.col("SD_EVENT_VALUE").alias("value"))


def governed_customer_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after two runs over one folder, a delivery arriving before each; ``segment`` is the load a row was written by."""
    root = scratch_path(spark, "appended")
    suffix = os.path.basename(root).rsplit("-", 1)[-1]
    customer = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    spec = LoadSpec("src.base.customer", CUSTOMER_DDL, delimiter="|", custom_table_name=f"APPENDED_{suffix}")
    store = TableStore(spark, f"{root}/warehouse")
    journal = Journal(store, prefix=f"J{suffix}_")
    for delivery in append_deliveries(customer):
        write_deliveries([delivery], f"{root}/IN")
        run_load(spark, spec, f"{root}/IN", store, journal, run_ts=RUN_TS, skip_applied=True)
    target = store.target(spec.table_name)
    return target.parts(target.snapshot().segments).withColumn(
        "segment", F.element_at(F.split(SEGMENT, "-"), 1).cast("int")).drop(SEGMENT)


def governed_customer_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column statistics of the bucketed customer load, merged from its segments."""
    store, spec, _ = _loaded(spark, sf_dir, 4, False, 1, column_stats=True)
    return store.target(spec.table_name).column_statistics().drop("n_distinct").where(~F.col("column_name").startswith("METADATA"))


def key_index_deliveries(customer: DataFrame):
    """Deliveries of three runs with delivery key ``c_custkey`` and primary key ``c_name``; the second repeats held names under new numbers."""
    nation = F.col("c_nationkey")
    return [
        ("20200101-000000", "FULL", customer.where(nation < 10), 0.0, False),
        ("20200201-000000", "UPDT", customer.where(nation.between(5, 14)).withColumn("c_custkey", -F.col("c_custkey")), 50.0, False),
        ("20200301-000000", "UPDT", customer.where((nation < 3) | (nation >= 15)), 100.0, False),
    ]


def governed_customer_key_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target after a FULL, a delivery that the primary key refuses, and one that replaces owners of names and adds others."""
    root = scratch_path(spark, "indexed")
    suffix = os.path.basename(root).rsplit("-", 1)[-1]
    customer = spark.read.parquet(f"{sf_dir.rstrip('/')}/customer.parquet")
    spec = LoadSpec("src.base.customer", CUSTOMER_DDL, delimiter="|", column_id="c_custkey", table_key="c_name",
                    custom_table_name=f"INDEXED_{suffix}", key_index=True)
    store = TableStore(spark, f"{root}/warehouse")
    journal = Journal(store, prefix=f"J{suffix}_")
    for i, delivery in enumerate(key_index_deliveries(customer)):
        write_deliveries([delivery], f"{root}/IN{i}")
        try:
            run_load(spark, spec, f"{root}/IN{i}", store, journal, run_ts=RUN_TS)
        except PrimaryKeyViolation:
            continue                     # refused as a whole, the target stays as it was
    return store.read(spec.table_name)
