"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loadwright.session import scratch_path

#: Rows per Arrow batch: texts may be long, so a batch stays small.
BATCH_ROWS = 1000
BATCH_BYTES = 32 << 20


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Keep Arrow batches of whole texts small (bounded Python memory)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= rows:
        spark.conf.set(key, str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_batches(df: DataFrame, columns: list[str | Column], schema: str,
                fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over the named columns only (the rest is pruned at the scan)."""
    small_batches(df.sparkSession)
    return df.select(*columns).mapInArrow(fn, schema)


def map_rows(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` over all columns, whatever their names, to rows of the same columns.

    ``fn`` finds the columns by place (their names may hold dots or backticks).
    """
    small_batches(df.sparkSession)
    plain = StructType([StructField(f"c{i}", f.dataType, f.nullable) for i, f in enumerate(df.schema.fields)])
    return df.toDF(*plain.names).mapInArrow(fn, plain).toDF(*df.columns)


#: Tasks that merge the states of all others before the last one does.
MERGERS = 32


def merge_states(states: DataFrame, merge: Callable[[Iterator[bytes]], bytes | None]) -> bytes | None:
    """One state from the binary states (column ``state``) that tasks returned; None without any.

    ``merge`` reads states one by one.  They meet in two rounds, so neither a
    task nor the driver gathers all of them: the driver gets the merged one.
    """
    def run(batches):
        out = merge(s for b in batches for s in b.column(0).to_pylist())
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out], pa.binary())], ["state"])

    some = states.select("state").repartition(MERGERS).mapInArrow(run, "state binary")
    last = some.repartition(1).mapInArrow(run, "state binary").collect()
    return bytes(last[0].state) if last else None


def state_batch(state: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([state], pa.binary())], ["state"])


def fresh(prefix: str, taken: list[str]) -> str:
    """A column name that clashes with none of ``taken`` (Spark ignores case)."""
    low = {t.lower() for t in taken}
    names = itertools.chain([prefix], (f"{prefix}_{i}" for i in itertools.count()))
    return next(n for n in names if n.lower() not in low)


HASH_MAX = (1 << 63) - 1


def key_hash(columns: tuple[str, ...], seed: int) -> Column:
    """63 bits of a hash of ``columns``."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *map(F.col, columns)), 1)


def keep_threshold(total: int, limit: int) -> int:
    """Cut on a 63-bit hash that leaves about ``limit`` of ``total`` keys at most, and never none."""
    return HASH_MAX if total <= limit else max(1, HASH_MAX * limit // total)


def key_counts(columns: tuple[str, ...], seed: int) -> list[Column]:
    """Aggregates ``n`` (rows, or about the distinct keys if these are fewer) and ``least`` (smallest hash) for ``sample_cut``."""
    key = key_hash(columns, seed)
    return [F.least(F.count(F.lit(1)), F.approx_count_distinct(key)).alias("n"), F.min(key).alias("least")]


def sample_cut(n: int, least: int | None, limit: int) -> int:
    """The cut for about ``limit`` of ``n`` distinct keys at most; the key with the smallest hash is always kept."""
    return max(keep_threshold(n, limit), least or 0)


def sampled(columns: tuple[str, ...], cut: int, seed: int) -> Column:
    """True for the rows of a repeatable sample chosen by a hash of ``columns``."""
    return key_hash(columns, seed) <= F.lit(cut)
