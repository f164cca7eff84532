"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.
#
# Broadcast size checks: at planning time a side is broadcast only when its
# estimate is under 16MB, and file-based estimates are inflated 4x so that
# well-compressed text columns cannot slip under the bound on their
# compressed size. At runtime AQE measures the actual shuffle output and
# broadcasts a side under 64MB; everything else stays a sort-merge join,
# whose skewed partitions AQE splits -- also when the split costs one more
# shuffle downstream (a key holding a third of the rows is worth it).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # coalesce shuffle partitions to the advisory size rather than keeping
    # many small tasks for parallelism (Spark's advice for busy clusters)
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.files.maxPartitionBytes": "128MB",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


TARGET_PARTITION_BYTES = 128 * 1024 * 1024


MAX_SHUFFLE_PARTITIONS = 100_000


def sizing_conf(shuffle_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES,
                max_partitions: int = MAX_SHUFFLE_PARTITIONS) -> dict[str, str]:
    """Partition sizing for an expected shuffle volume.

    AQE can merge small shuffle partitions but cannot split large ones
    (outside skewed joins), so the *initial* count must be sized for the
    largest shuffle: about ``shuffle_bytes / target_bytes``, coalesced at
    runtime to the same target. The count is capped (the driver tracks map
    outputs per map task and reduce partition); past the cap the target
    size grows instead. The range split of the numbering uses this count.
    """
    n = max(1, -(-int(shuffle_bytes) // int(target_bytes)))
    if n > max_partitions:
        n = max_partitions
        target_bytes = -(-int(shuffle_bytes) // n)
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
    }


def build_session(master: str = "local[*]", app: str = "callweave",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  shuffle_bytes: int | None = None) -> SparkSession:
    """Session with ``DEFAULT_CONF``; ``shuffle_bytes`` (expected size of the
    largest shuffle) sizes partitions via :func:`sizing_conf`, an explicit
    ``shuffle_partitions`` overrides the count."""
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    if shuffle_bytes is not None:
        conf.update(sizing_conf(shuffle_bytes))
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_PRIVATE_DIRS: dict[str, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names shared storage and is only read here; if
    it is unset there, this raises, because a folder of the driver's machine
    would leave executors reading files that other machines wrote. Only a
    ``local`` master gets a private folder, one per application; the setting
    itself is a startup option and is not changed.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not re.fullmatch(r"local(\[[^\]]*\])?", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on {master}")
        app = spark.sparkContext.applicationId
        if app not in _PRIVATE_DIRS:
            _PRIVATE_DIRS[app] = tempfile.mkdtemp(prefix="callweave-ckpt-")
        path = _PRIVATE_DIRS[app]
    # lets callers use DataFrame.checkpoint(); the library itself writes
    # parquet there (materialize)
    spark.sparkContext.setCheckpointDir(path)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the checkpoint folder.

    Used where a plan reads an intermediate result more than once and both
    readers must see the very same rows: they read the written table, and a
    lost executor re-reads it instead of recomputing from the sources.
    Each call writes a fresh folder, so concurrent runs never collide.
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/callweave/{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    # read back with the schema just written: no footer-inference job
    return spark.read.schema(df.schema).parquet(path)
