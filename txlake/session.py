"""Session settings and the shared working folder.

The library never builds a session for production callers: a job passes its
own ``SparkSession`` (object-store, JDBC and Kafka settings belong to the
caller's cluster config, not to code).

Intermediate tables (raw zone copies, checkpoints, stream sinks used by the
registered queries) are written under the folder the cluster names in
``spark.checkpoint.dir`` -- a shared file system on a real cluster.  Only when
that setting is absent on a ``local`` master do we pick a folder of our own and
register it; on any other master executors would not share it, so it is an error.
"""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

# Settings a Spark user sets for this workload.  AQE coalesces the small
# post-shuffle partitions of dimension builds and splits skewed partitions if a
# join ever falls back to a shuffle; UTC keeps date/timestamp text stable.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def scale_conf(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of Parquet on
    ``total_cores`` executor cores.

    * scans: splits of ``partition_bytes`` (row groups permitting);
    * shuffles: enough initial partitions that each holds about
      ``partition_bytes`` of the largest shuffle (the keyed dedup moves about
      the whole clean table); AQE then coalesces small partitions to the advisory size and splits skewed
      ones in joins;
    * files of a rebalanced table: the advisory size is at most an eighth of a core's
      share of the input, so that a partition of the table (a year) is written and read
      by several tasks, and 16 MB at least.
    """
    wanted = -(-input_bytes // partition_bytes)
    shuffle_partitions = max(2 * total_cores, wanted)
    advisory = min(partition_bytes // 2, max(16 << 20, input_bytes // (8 * total_cores)))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(advisory),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes * 4),
    }


def object_store_conf(endpoint: str, path_style: bool = True, ssl: bool = True) -> dict[str, str]:
    """S3A settings for an S3-compatible object store (a self-hosted store
    typically needs path-style access and, inside a private network, no TLS).

    Credentials are deliberately not parameters: they come from the cluster's
    credential provider chain (environment, instance profile, secrets).
    Apply with ``SparkSession.builder.config(map=...)`` or ``spark-submit --conf``.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def _context_checkpoint_dir(spark: SparkSession) -> str | None:
    try:
        sc_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
    except Exception:  # no JVM context handle (client session)
        return None
    return sc_dir.get() if sc_dir.isDefined() else None


def _configured_checkpoint_dir(spark: SparkSession) -> str | None:
    d = _context_checkpoint_dir(spark)
    if d:
        return d
    try:
        conf_dir = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if conf_dir:
            return conf_dir
    except Exception:
        pass
    try:
        return spark.conf.get("spark.checkpoint.dir")
    except Exception:
        return None


def _is_local(spark: SparkSession) -> bool:
    """One machine: master ``local`` or ``local[...]`` (not ``local-cluster``)."""
    try:
        master = spark.sparkContext.master
    except Exception:  # client session: the executors are elsewhere
        return False
    return master == "local" or master.startswith("local[")


def size_session(spark: SparkSession, path: str) -> dict[str, str]:
    """Apply ``scale_conf`` for the files under ``path`` to the session; settings
    that need a number of cores take the default parallelism."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    conf = scale_conf(files.getContentSummary(hadoop).getLength(), spark.sparkContext.defaultParallelism)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint folder; set a local one only if unset."""
    d = _configured_checkpoint_dir(spark)
    if d is None:
        if not _is_local(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="txlake-ckpt-")
        try:
            spark.sparkContext.setCheckpointDir(d)
        except Exception:  # client session: the server owns the context
            return d
        d = _configured_checkpoint_dir(spark) or d
    elif _context_checkpoint_dir(spark) is None:
        try:
            spark.sparkContext.setCheckpointDir(d)  # so DataFrame.checkpoint() uses it
        except Exception:
            pass
    return d


_scratch: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder under the shared checkpoint location."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = "/".join([root, "txlake", *parts, uuid.uuid4().hex])
    if _scratch.get() is not None:
        _scratch.get().append(path)
    return path


@contextmanager
def scratch_tables(spark: SparkSession):
    """Folders made by ``shared_dir`` inside are deleted at the end: for jobs whose
    results lie elsewhere, so that no intermediate table outlives them."""
    made: list[str] = []
    token = _scratch.set(made)
    try:
        yield
    finally:
        _scratch.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(conf).delete(folder, True)
