"""Daily files picked up from a drop folder with Structured Streaming.

The original job is started by a scheduler each morning, reads the day's
three files and then renames them into an archive folder.  Here a file
stream source watches the drop folder for transactions files: only their
names pass through the stream, its checkpoint records which were processed
(exactly once, also across restarts).  For every batch label found, in
order, the three files of that label are read by the batch readers (columns by
header name, whatever their order in the file), ``run_day`` loads them, and
after the commit all three move to the archive folder.  One file, one day, per
micro-batch by default.  Run it with ``availableNow`` from any scheduler: it
processes what has arrived and stops.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.daily_run import inputs_from_drop, run_day
from ..plans.store import Store, day_of_label
from ..sources import files

LABEL_PATTERN = r"transactions_(\d{8})\.txt$"

# The columns of Spark's binaryFile source; a file stream must name them.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"

# (label) -> (clients, accounts, cards) source snapshots for that batch.
SnapshotFn = Callable[[str], tuple[DataFrame, DataFrame, DataFrame]]


def file_stream(spark: SparkSession, drop_dir: str, files_per_batch: int = 1) -> DataFrame:
    """Stream of the transactions files that arrive: (path, label); no content is read."""
    names = (spark.readStream.format("binaryFile").schema(BINARY_FILE).option("pathGlobFilter", "transactions_*.txt")
             .option("maxFilesPerTrigger", files_per_batch)
             .option("ignoreMissingFiles", True)  # already archived by a run that died before its checkpoint
             .load(drop_dir))
    return names.select("path", F.regexp_extract("path", LABEL_PATTERN, 1).alias("label"))


def archive(spark: SparkSession, paths: list[str], archive_dir: str) -> None:
    """Move files that are still there to ``archive_dir``."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    target = path(archive_dir)
    for p in map(path, paths):
        fs = p.getFileSystem(conf)
        fs.mkdirs(target)
        if fs.exists(p) and not fs.rename(p, path(target, p.getName())):
            raise OSError(f"{p} could not be moved to {archive_dir}")


def run_file_drop(spark: SparkSession, store: Store, drop_dir: str, checkpoint: str,
                  snapshots: SnapshotFn, archive_dir: str | None = None,
                  sheet_format: str = "csv", files_per_batch: int = 1, **run_kwargs) -> StreamingQuery:
    """Process every transactions file that has arrived, then stop.

    Each day must arrive as one transactions file, as the original's daily
    file does.  ``files_per_batch`` only sets how many days one micro-batch
    may hold.

    A micro-batch that died between a commit and the stream's checkpoint comes
    again with the same epoch.  Every commit marker names the stream and the
    epoch it was made in, so a replay skips the labels it had committed,
    goes on with the rest and finishes the archiving, with or without an
    archive folder.
    """

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        # One row per file of this micro-batch (a few days).
        labels = sorted({r["label"] for r in batch.collect()}, key=day_of_label)
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        committed = store.ledger(stream)
        for label in labels:
            if (epoch_id, label) not in committed:
                clients, accounts, cards = snapshots(label)
                inputs = inputs_from_drop(spark, drop_dir, label, clients, accounts, cards, sheet_format)
                run_day(store, label, inputs, stream=(stream, epoch_id), **run_kwargs)
            if archive_dir:
                archive(spark, list(files.daily_paths(drop_dir, label, sheet_format).values()), archive_dir)

    return (file_stream(spark, drop_dir, files_per_batch).writeStream.foreachBatch(each_batch)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())
