"""Incremental delivery watcher on Structured Streaming.

The original tool processes whatever files sit in its input folder, once per
start, and moves them to a history folder.  Here a ``binaryFile`` stream over
the input folder (paths only; content is never read by the stream) records
which files were already seen in its checkpoint, and each micro-batch hands
the newly arrived deliveries to the governed load.  ``availableNow`` gives
the "process what is there, then stop" behaviour of a scheduled start.

Notes:
  * a delivery must appear atomically (write elsewhere, then rename), as for
    any file-stream source, or its part files may be split across batches
  * after a restart the last micro-batch may be replayed.  Each batch runs
    as process ``GOVERNED_LOAD_STREAM_<stream>_<batch id>`` (``<stream>``
    names the checkpoint), and a batch whose run already finished in the
    journal is skipped.  A run that died before finishing is run again, and
    leaves out the deliveries that the target's ledger shows as applied, so a
    replay appends nothing twice, INST included
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from loadwright.plans.journal import Journal
from loadwright.plans.load import GovernedLoad
from loadwright.plans.spec import LoadSpec
from loadwright.plans.store import TableStore
from loadwright.sources.deliveries import group_delivery_files

BINARY_FILE_SCHEMA = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def watch_deliveries(spark: SparkSession, spec: LoadSpec, in_folder: str, store: TableStore,
                     journal: Journal | None = None, checkpoint: str | None = None,
                     run_ts: str | None = None, once: bool = True):
    """Start (and with ``once``, finish) a stream that loads new deliveries.

    Returns the list of ``LoadReport`` objects of the micro-batches that ran.
    """
    reports = []
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true")
             .load(in_folder).select("path", "modificationTime", "length"))

    # the stream's checkpoint is what remembers the deliveries already applied:
    # by default one fixed folder per target table beside the target itself
    checkpoint = checkpoint or f"{store.root}/_watch/{spec.table_name}"
    stream = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:10]
    journal = journal or Journal(store)

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        process = f"GOVERNED_LOAD_STREAM_{stream}_{batch_id}"
        if journal.finished(process, spec.object_name):
            return                      # a replay of a batch that was applied
        listing = group_delivery_files(batch)
        if listing.isEmpty():
            return
        load = GovernedLoad(batch.sparkSession, spec, store, journal, run_ts, process=process, skip_applied=True)
        reports.append(load.run_listing(listing))

    writer = files.writeStream.foreachBatch(apply_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if once:
        query.awaitTermination()
        return reports
    return query
