"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators are written for. A cluster's own values win: pass them to build_session.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state of open requests lives on disk and not on the heap
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


PARTITION_BYTES = 128 << 20


def shuffle_partitions(data_bytes: int) -> int:
    """Shuffle partitions of about 128 MB, so that one fits an executor's memory with room to sort."""
    return min(max(200, -(-data_bytes // PARTITION_BYTES)), 1_000_000)


def build_session(
    app: str = "lantern", master: str | None = None, data_bytes: int | None = None, **conf: str
) -> SparkSession:
    """A session with the defaults above; keyword names use ``__`` for dots. ``data_bytes``: how much
    data the widest shuffle moves; small partitions are put together again at run time."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    sized = {} if data_bytes is None else {"spark.sql.shuffle.partitions": str(shuffle_partitions(data_bytes))}
    settings = {**DEFAULTS, **sized, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Make this package importable in every worker, as ``--py-files`` does. Once per session is enough;
    where the package is installed on the cluster it is not needed."""
    context = spark.sparkContext
    if not getattr(context, "_lantern_shipped", False):
        here = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(tempfile.mkdtemp(prefix="lantern-"), "lantern")
        # the archive is read by the driver, which hands it to the executors
        context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(here), os.path.basename(here)))
        context._lantern_shipped = True
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Where it is unset, a local session (tests) gets a folder of its own; a cluster is refused, as a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    made = getattr(spark.sparkContext, "_lantern_dir", None)
    if made is None:
        made = tempfile.mkdtemp(prefix="lantern-")
        spark.sparkContext._lantern_dir = made
    return made


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in reliable storage: later plans start from the files, so a lost
    executor cannot change sampled partition bounds under them."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(f"{shared_dir(df.sparkSession)}/checkpoints")
    return df.checkpoint(eager=True)
