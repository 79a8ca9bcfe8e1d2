"""Session construction and shared scratch locations.

Jobs never write to a machine-local folder on a cluster. Everything that must
outlive a task (checkpoints, intermediate tables, round-trip files) goes under
the shared folder named by ``spark.checkpoint.dir``. Only when that setting is
missing *and* the master is local (tests, laptops) does this module create a
folder of its own under the system temp directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on; everything else is left to the cluster.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "kestrel",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Return the active session, or build one with the library defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_runtime_filters(spark: SparkSession, scan_bytes: int = 0,
                         source_bytes: int = 64 << 20) -> SparkSession:
    """A session on the same context and with the same settings, whose joins make a
    Bloom filter of a filtered side's keys and apply it to the other side before its
    shuffle, wherever that side scans at least ``scan_bytes`` and the join is too large
    to broadcast. The filter comes from a side of at most ``source_bytes`` (estimated),
    and Spark bounds its bits. The session given keeps its settings."""
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            own.conf.set(key, value)
    prefix = "spark.sql.optimizer.runtime.bloomFilter"
    own.conf.set(f"{prefix}.enabled", "true")
    own.conf.set(f"{prefix}.applicationSideScanSizeThreshold", str(scan_bytes))
    own.conf.set(f"{prefix}.creationSideThreshold", str(source_bytes))
    return own


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). If neither is set, a local session gets a fresh temp
    folder; a cluster session raises, because a machine-local folder would
    not survive the loss of an executor.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; configure a shared folder "
                "(HDFS, object store) for checkpoints and intermediate tables")
        base = tempfile.mkdtemp(prefix="kestrel-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return base.rstrip("/")


_scratch: list[tuple[object, str]] = []  # (application, path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    What is written there stays until :func:`clear_scratch`, as lazy results
    may still read it.
    """
    path = f"{checkpoint_dir(spark)}/kestrel/{name}-{uuid.uuid4().hex}"
    _scratch.append((getattr(spark.sparkContext, "applicationId", None), path))
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this application wrote to paths from :func:`scratch_path`;
    call it once the results that read it are no longer needed. Returns the
    number of paths deleted."""
    app = spark.sparkContext.applicationId
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    own = [p for a, p in _scratch if a == app]
    _scratch[:] = [x for x in _scratch if x[0] != app]
    paths = [jvm.org.apache.hadoop.fs.Path(p) for p in own]
    return sum(bool(p.getFileSystem(conf).delete(p, True)) for p in paths)
