"""Session construction and the shared scratch location."""

from __future__ import annotations

import contextlib
import contextvars
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the jobs rely on.  Join strategy is left to Spark: a side is
# broadcast only when its measured size is under the broadcast thresholds
# (planner statistics before the run, real shuffle sizes under AQE); above
# them the join stays a shuffle join and AQE splits skewed partitions.
JOB_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def build_session(master: str | None = None, app: str = "nightledger",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Get or create a session with ``JOB_CONF`` applied.

    ``master`` and ``shuffle_partitions`` are meant for local runs and tests;
    on a cluster leave them unset and let the submit command decide.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
        b = b.config("spark.driver.memory", os.environ.get("NIGHTLEDGER_DRIVER_MEMORY", "8g"))
    for k, v in JOB_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Taken from ``spark.checkpoint.dir`` as the cluster configures it.  Only
    when nothing is configured and the session runs in local mode (tests) a
    fresh temporary folder is used; on a cluster that is an error.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d.rsplit("/", 1)[0] if _is_spark_subdir(d) else d
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not sc.master.startswith("local"):
            # a machine-local folder is not visible to the executors
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        conf = tempfile.mkdtemp(prefix="nightledger-ckpt-")
    sc.setCheckpointDir(conf)
    return conf


def _is_spark_subdir(d: str) -> bool:
    # setCheckpointDir appends a random UUID folder to the configured path.
    tail = d.rstrip("/").rsplit("/", 1)[-1]
    try:
        uuid.UUID(tail)
        return True
    except ValueError:
        return False


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/nightledger/{name}-{uuid.uuid4().hex}"
    for made in _scopes.get():
        made.append(path)
    return path


# the lists that note the scratch folders of the jobs now running in this thread, and in those it starts by ``together``
_scopes: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("scratch_scopes", default=())


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete the scratch folders made within it when it ends: for jobs whose results are all written elsewhere."""
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path
        for p in map(path, made):
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written under the scratch folder and read again: cuts the lineage, and Spark knows its size."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def together(*jobs: Callable[[], object], at_once: int = 8) -> list:
    """Run independent Spark jobs side by side: while one has few tasks left, the others use the
    executors.  All end before this returns; the first error is raised."""
    session = SparkSession.getActiveSession()
    carry = inheritable_thread_target(session) if session else inheritable_thread_target
    with ThreadPoolExecutor(at_once) as pool:
        futures = [pool.submit(contextvars.copy_context().run, carry(job)) for job in jobs]
    return [f.result() for f in futures]
