"""Key index of a target: which primary keys each segment holds, in hash buckets.

A load whose primary key is not its delivery key has to know whether a staged
key is held by a surviving row.  Without an index that is a scan of the key
columns of the whole target.  With one, every segment has a sibling folder

    <TABLE>__KEYS/<key columns>/_segment=<segment>/_n=<buckets>/_key_bucket=<b>

with the primary key, the delivery key (an UPDT must know which holders it
deletes) and the target's bucket of each row, and a guard reads only the
buckets that staged keys fall in.

The number of buckets of a segment is a power of two that grows with its rows
(``ROWS_PER_BUCKET``, ``MAX_BUCKETS``), so a bucket stays as small in a large
segment as in a small one and a key's bucket among n follows from that among
the largest n.  A segment never changes, so neither does its folder, and what is
live follows from the target's snapshot: the switch of a load needs no second
call here, and a lost driver leaves a folder that nothing reads.  Beyond
``MAX_BUCKETS * ROWS_PER_BUCKET`` rows in one segment its buckets grow.
Segments without a folder (written before the index was declared, or under
another key) are read from the target itself, so a guard is exact either way.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from loadwright.functions.keys import bucket_of

SEGMENT_COL, COUNT_COL, KEY_BUCKET = "_segment", "_n", "_key_bucket"
#: Keys that a bucket holds on average, and the most buckets of a segment.
ROWS_PER_BUCKET = 1 << 20
MAX_BUCKETS = 4096


def buckets_for(rows: int) -> int:
    """Power of two of buckets for a segment of so many rows."""
    need = max(1, -(-rows // ROWS_PER_BUCKET))
    return min(MAX_BUCKETS, 1 << (need - 1).bit_length())


@dataclass(frozen=True)
class KeyIndex:
    """Index over ``keys``; ``extra`` columns are stored beside them."""

    root: str
    keys: tuple[str, ...]
    extra: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return list(dict.fromkeys(self.keys + self.extra))

    @property
    def base(self) -> str:
        names = json.dumps([self.keys, self.columns])
        return f"{self.root}/{hashlib.sha256(names.encode()).hexdigest()[:12]}"

    def write(self, rows: DataFrame, segment: str, n_rows: int) -> None:
        """Write the keys of a segment's rows; a hot bucket may be split over several files."""
        if not n_rows:
            return
        n = buckets_for(n_rows)
        keyed = rows.select(*self.columns).withColumn(KEY_BUCKET, bucket_of(list(self.keys), n))
        (keyed.hint("rebalance", KEY_BUCKET).sortWithinPartitions(KEY_BUCKET, *self.keys)
         .write.mode("errorifexists").partitionBy(KEY_BUCKET).parquet(f"{self.base}/{SEGMENT_COL}={segment}/{COUNT_COL}={n}"))

    def counts(self, store, segments) -> dict[str, int]:
        """Buckets of each of the segments that is indexed (names of folders only)."""
        held = {f.split("=", 1)[1] for f in store.folders(self.base)}
        found = {}
        for s in segments:
            if s.name in held:
                found[s.name] = int(store.folders(f"{self.base}/{SEGMENT_COL}={s.name}")[0].split("=", 1)[1])
        return found

    def read(self, spark, schema: StructType, counts: dict[str, int], staged: DataFrame) -> DataFrame:
        """Index rows of the segments in ``counts`` whose bucket some staged key falls in, with their segment.

        At most ``MAX_BUCKETS`` small numbers reach the driver.  ``schema`` is the target's.
        """
        most = max(counts.values())
        hit = [r[0] for r in staged.select(bucket_of(list(self.keys), most)).distinct().collect()]
        by_count = {n: sorted({b % n for b in hit}) for n in sorted(set(counts.values()))}
        fields = [f for f in schema.fields if f.name in self.columns]
        fields += [StructField(SEGMENT_COL, StringType()), StructField(COUNT_COL, IntegerType()), StructField(KEY_BUCKET, IntegerType())]
        paths = [f"{self.base}/{SEGMENT_COL}={name}/{COUNT_COL}={n}" for name, n in counts.items()]
        rows = spark.read.schema(StructType(fields)).option("basePath", self.base).parquet(*paths)
        pick = F.lit(False)
        for n, buckets in by_count.items():
            pick = pick | ((F.col(COUNT_COL) == n) & F.col(KEY_BUCKET).isin(buckets))
        return rows.where(pick).select(*self.columns, SEGMENT_COL)
