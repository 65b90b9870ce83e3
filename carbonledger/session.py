"""Session helpers.

The library never creates a cluster session on its own: callers pass a
``SparkSession``.  ``local_session`` exists for tests, the bench and the
examples; ``ensure_checkpoint_dir`` makes ``DataFrame.checkpoint`` usable
without overriding what a cluster already configured.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", app: str = "carbonledger", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if none is configured.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store); it is used as is.  Only when it is unset -- local tests -- a fresh
    scratch folder is created.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        try:
            configured = spark.conf.get(CHECKPOINT_CONF)
        except Exception:  # noqa: BLE001 - unset key raises in some versions
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            # A driver-local folder is not shared with executors: refuse rather than lose data.
            raise RuntimeError("spark.checkpoint.dir is not set: point it at a shared folder "
                               "(HDFS / object store) visible to every executor")
        configured = tempfile.mkdtemp(prefix="carbonledger-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


# The folders written by the build that runs now, until released.  Every thread starts with its own list, and
# ``table_scope`` opens one for a build inside another, so no build ever releases the tables of one beside it.
_FOLDERS: ContextVar[list[str] | None] = ContextVar("materialised folders", default=None)


def _folders() -> list[str]:
    own = _FOLDERS.get()
    if own is None:
        _FOLDERS.set(own := [])
    return own


def scratch_folder(spark: SparkSession, name: str = "table") -> str:
    """A new path in the shared checkpoint folder, released with the tables of the build that asked for it."""
    path = f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _folders().append(path)
    return path


def reliable_checkpoint(df):
    """Write ``df`` once as Parquet in the shared checkpoint folder and return the reread table.

    Computes the input once (an eager ``checkpoint()`` computes it twice unless
    it is persisted too), keeps no second copy on executor disks, and the files
    outlive any executor.  ``release_checkpoints`` and the end of a
    ``table_scope`` delete them.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_checkpoints(spark: SparkSession, since: int = 0, keep=None) -> None:
    """Delete the folders written by this build (those after the first ``since``) once their readers are done,
    except those that the frame ``keep`` still reads."""
    own = _folders()
    used = set(_names_in(keep.inputFiles())) if keep is not None else set()
    kept = [p for p in own[since:] if p.rpartition("/")[2] in used]
    for path in own[since:]:
        if path not in kept:
            delete_folder(spark, path)
    own[since:] = kept


def _names_in(files) -> set[str]:
    return {part for f in files for part in f.split("/")}


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder through Hadoop's FileSystem; a missing one is no error."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def checkpoints_written() -> int:
    """Number of folders of this build not yet released."""
    return len(_folders())


@contextmanager
def table_scope(spark: SparkSession):
    """Own list of materialised folders for one build: what it wrote is deleted at its end.

    The yielded function takes a frame that outlives the build and returns it;
    the folders it reads pass to the enclosing build.
    """
    outer, kept = _folders(), []
    token = _FOLDERS.set([])

    def keep(df):
        kept.append(df)
        return df

    try:
        yield keep
    finally:
        own = _folders()
        _FOLDERS.reset(token)
        used = set().union(*(_names_in(df.inputFiles()) for df in kept if own))
        for path in own:
            if path.rpartition("/")[2] in used:
                outer.append(path)
            else:
                delete_folder(spark, path)


def scoped(query):
    """``query(spark, ...)`` that leaves no folder behind but those its result reads."""
    @wraps(query)
    def run(spark: SparkSession, *args, **kw):
        with table_scope(spark) as keep:
            return keep(query(spark, *args, **kw))
    return run


def cluster_conf(input_tb: float = 100.0, executors: int = 1000, cores_per_executor: int = 8,
                 partition_mb: int = 256, shuffled_share: float = 0.05) -> dict[str, str]:
    """Spark settings sized for a large run; apply them when building the cluster session.

    * shuffle partitions start at the bytes that are shuffled / ``partition_mb``: after column pruning and
      compression ``shuffled_share`` of the input (a few narrow columns of the line items); AQE then coalesces
      small ones and splits skewed ones; never below the core count, never above 50,000 (map tasks x
      partitions is the number of shuffle blocks);
    * scans read ``partition_mb`` splits, so a task holds a bounded slice;
    * skewed sort-merge partitions (5x the median and above 1 GB) are split;
    * the runtime bloom filter lets a filtered dimension or order side prune
      the large fact scan of a shuffle join.
    """
    cores = executors * cores_per_executor
    shuffle = min(50_000, max(cores, int(shuffled_share * input_tb * 1024 * 1024 / partition_mb)))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": f"{partition_mb}m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": f"{partition_mb}m",
        "spark.sql.autoBroadcastJoinThreshold": "64m",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
    }
