"""Incremental landing: new snapshot files are staged as they arrive.

The reference runs its loader monthly over a file listing.  The Spark form
is a file-source stream over the landing folder: the ``binaryFile`` source
tracks which files were already seen in the checkpoint (exactly-once per
file, restartable after a failure), only file metadata is read by the
stream itself, and each micro-batch of new files runs the batch landing
job (reconcile -> stage -> log) through ``foreachBatch``.
``trigger(availableNow=True)`` processes what is there and stops, the
scheduled-run behaviour; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import landing, landing_index, staging

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def start_landing_stream(spark: SparkSession, landing_root: str, staging_root: str,
                         checkpoint: str, load_id_for: Callable[[int], str],
                         entities: str | Sequence[str] = "products,prices,contracts",
                         start: str = "000000", end: str = "999999",
                         rules_dir: str | None = None, drafts_dir: str | None = None,
                         log_dir: str | None = None, available_now: bool = True,
                         processing_time: str | None = None, index_dir: str | None = None) -> StreamingQuery:
    """Start the stream; ``load_id_for(batch_id)`` names each micro-batch's load.

    A batch stages the units of its files whole, with files that came earlier:
    those the landing index knows (``index_dir``, by default beside the
    checkpoint).  A batch reads its own files and the index of their months,
    neither the landing folder's listing nor its other files.  Given a log,
    units that failed are tried again under their own load when the stream
    starts and after every batch, until they are staged.
    """
    files = (spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
             .option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv")
             .load(landing_root).select("path", "length", "modificationTime"))
    index_dir = index_dir or f"{checkpoint.rstrip('/')}-files"
    options = dict(entities=entities, start=start, end=end, rules_dir=rules_dir, drafts_dir=drafts_dir,
                   index_dir=index_dir)

    def run_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        named = batch.withColumn("file_name", F.regexp_extract("path", landing._UNIT, 1)).where(
            (F.col("file_name") != "") & ~F.col("path").rlike(r"/(_|\.)[^/]*$"))
        listed = landing_index.with_earlier_files(named, index_dir)
        result = staging.run_landing(session, landing_root, staging_root, load_id_for(batch_id),
                                     log_dir=log_dir, files=listed, **options)
        result.release()  # a long-running stream must not accumulate cached batches
        if log_dir:
            staging.retry_failed(session, landing_root, staging_root, log_dir, **options)

    if log_dir:
        staging.retry_failed(spark, landing_root, staging_root, log_dir, **options)
    writer = files.writeStream.foreachBatch(run_batch).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
