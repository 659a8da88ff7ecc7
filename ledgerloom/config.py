"""Session defaults and the shared staging area.

Everything that cuts lineage (the dense-key stage, published runs) is written
under the folder the cluster names in ``spark.checkpoint.dir``. The setting is
read from the session; a private folder is created only when it is unset and
Spark runs in local mode (tests).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

#: How staged and stored tables are written: every row of a load is written several times
#: (staged, positioned, keyed), so their size on disk counts.
STORED = {"compression": "zstd"}

# Session settings the library relies on. AQE stays on so that shuffle
# partitions are coalesced / skewed join partitions split at runtime. Tables of
# a load are built by concurrent jobs; FAIR scheduling shares the executors
# between them instead of running the first-submitted job's tasks first.
DEFAULT_CONF = {
    "spark.scheduler.mode": "FAIR",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", app_name: str = "ledgerloom",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's own."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts, taken from the session.

    Order: ``spark.checkpoint.dir`` conf, then a directory set through
    ``SparkContext.setCheckpointDir``; when neither exists a private folder is
    made, but only for a local master — a machine-local folder is useless to a
    cluster, so there it is an error.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="ledgerloom-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, root)
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _context(spark: SparkSession):
    """The SparkContext, or None for a Spark Connect session (which has none)."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def stage_path(spark: SparkSession, purpose: str) -> str:
    """A fresh, never reused folder under the checkpoint root."""
    return f"{checkpoint_root(spark)}/ledgerloom/{purpose}-{uuid.uuid4().hex}"


SHUFFLE_CLEANUP_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_freeing: dict[int, tuple[int, str | None]] = {}    # by session: steps at work, the setting before the first
_freeing_lock = threading.Lock()


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries started within give their shuffle files back when they end. By itself Spark
    keeps them until the driver's garbage collector meets the plan, so that the files of all
    steps of a load would stay on the executors' disks. Meant for steps that run once, such as
    a write; steps may overlap, and the setting is put back after the last."""
    with _freeing_lock:
        steps, before = _freeing.get(id(spark), (0, None))
        if not steps:
            before = spark.conf.get(SHUFFLE_CLEANUP_CONF, None)
            spark.conf.set(SHUFFLE_CLEANUP_CONF, "true")
        _freeing[id(spark)] = steps + 1, before
    try:
        yield
    finally:
        with _freeing_lock:
            steps, before = _freeing.pop(id(spark))
            if steps > 1:
                _freeing[id(spark)] = steps - 1, before
            elif before is None:
                spark.conf.unset(SHUFFLE_CLEANUP_CONF)
            else:
                spark.conf.set(SHUFFLE_CLEANUP_CONF, before)


def write_stored(df: DataFrame, path: str, *partition_by: str) -> None:
    """Write ``df`` as Parquet in place of what ``path`` holds; its shuffles are given back."""
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**STORED).partitionBy(*partition_by).parquet(path)


def spread(df):
    """Round-robin ``df`` over the cluster's cores when it has fewer partitions.

    A source made of a few large unsplittable units (one gzip CSV, one Parquet
    row group) arrives as a handful of partitions and would keep every
    following map-side step on that many tasks. Large inputs already have at
    least as many partitions as cores, so for them this is a no-op and adds no
    shuffle. Meant for file scans: asking a plan that contains a shuffle for its
    partition count would run that plan.
    """
    sc = _context(df.sparkSession)
    if sc is None:  # Spark Connect: no partition count to ask for
        return df
    cores = sc.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the file system it names."""
    hpath = _context(spark)._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hpath.getFileSystem(_context(spark)._jsc.hadoopConfiguration()).exists(hpath))


def remove_path(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` recursively on whatever file system it names (HDFS, S3,
    local), through Hadoop's ``FileSystem``, as Spark itself would. Returns
    whether something was deleted."""
    sc = _context(spark)
    if sc is None:  # Spark Connect: no file system handle; leave the folder
        return False
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath) and fs.delete(hpath, True))


def write_text(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small driver-side record (a journal entry, a manifest record). Without
    ``overwrite`` the file is created only if it is absent, in one step where the
    file system offers that (HDFS, local disks); False if it was there already."""
    sc = _context(spark)
    hadoop = sc._jvm.org.apache.hadoop.fs
    hpath = hadoop.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(hpath.getParent())
    try:
        out = fs.create(hpath, overwrite)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() in ("FileAlreadyExistsException", "FileAlreadyExists") or (
                not overwrite and fs.exists(hpath)):
            return False
        raise
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """Read a record that ``write_text`` wrote."""
    sc = _context(spark)
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = hpath.getFileSystem(sc._jsc.hadoopConfiguration()).open(hpath)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none if it doesn't exist), sorted."""
    sc = _context(spark)
    hpath = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(sc._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath)) if fs.exists(hpath) else []
