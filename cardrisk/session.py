"""Session settings the engine relies on.

Correctness depends on two runtime settings: UTC session time (calendar
flags, day buckets) and ANSI mode (the operators use ``try_*`` where pandas
would give NaN).  Both are runtime SQL confs, so ``ensure_conf`` can apply
them to a session someone else built.
"""

from __future__ import annotations

import os
import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Runtime SQL confs: safe to set on an existing session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

# Static confs: only honoured when the session is created here.  Python
# call-site capture for error messages costs about 1 ms per Column operation
# when a plan is built; jobs built here switch it off.  Sizes (shuffle
# partitions, memory) are the submit command's or the caller's, never set here.
STATIC_CONF = {
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "cardrisk", **conf: str) -> SparkSession:
    """Build (or reuse) a session with the engine's settings.

    ``conf`` overrides any default, e.g. ``spark_sql_shuffle_partitions="2000"``
    (underscores stand for dots).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {**STATIC_CONF, **RUNTIME_CONF}
    settings.update({(k if "." in k else k.replace("_", ".")): v for k, v in conf.items()})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 1024**2) -> dict[str, str]:
    """Sizing for a cluster run over ``input_bytes`` of input.

    File splits and shuffle partitions aim at ``target_partition_bytes`` per
    task, so a window partition or aggregation buffer fits in executor memory;
    AQE then merges small shuffle partitions and splits skewed join partitions
    from measured sizes.  Pass the result to ``get_session(**conf)`` (with
    dots) or ``spark-submit --conf``.
    """
    parts = max(200, int(input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024**2),
    }


def ensure_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need to any session."""
    for k, v in RUNTIME_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def checkpoint_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a folder every executor can reach).  Only a
    local-mode session without it gets a private folder, as in tests; it is
    registered with ``SparkContext.setCheckpointDir`` (a core conf cannot be
    changed at runtime).
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cardrisk-ckpt-"))
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()
_SHIPPING = threading.Lock()


def ship_package(spark: SparkSession) -> None:
    """Make ``cardrisk`` importable in Python workers (as ``--py-files`` would).

    Needed only where Python runs on executors (the streaming state
    function).  The package is zipped once per application on the driver and
    handed to ``SparkContext.addPyFile``, which serves it to every executor.
    """
    sc = spark.sparkContext
    with _SHIPPING:  # one archive, also for threads
        if sc.applicationId in _SHIPPED:
            return
        import shutil

        pkg = os.path.dirname(os.path.abspath(__file__))
        out = os.path.join(tempfile.mkdtemp(prefix="cardrisk-pkg-"), "cardrisk")
        archive = shutil.make_archive(out, "zip", root_dir=os.path.dirname(pkg), base_dir=os.path.basename(pkg))
        sc.addPyFile(archive)
        _SHIPPED.add(sc.applicationId)


_PASSING = threading.local()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh output folder under the shared checkpoint folder (under the thread's ``passing_scratch``, if any)."""
    base = getattr(_PASSING, "path", None) or f"{checkpoint_base(spark).rstrip('/')}/cardrisk"
    return f"{base}/{name}-{uuid.uuid4().hex}"


@contextmanager
def passing_scratch(spark: SparkSession):
    """Scratch folders that this thread names within are deleted at the end.

    For steps whose result is written whole: its folder is named before, what it was made from goes.
    """
    before = getattr(_PASSING, "path", None)
    _PASSING.path = path = scratch_path(spark, "passing")
    try:
        yield
    finally:
        _PASSING.path = before
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_DROPPING: dict[str, list] = {}
_DROPPING_LOCK = threading.Lock()


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Shuffle files of an execution within go when it ends, not when the driver happens to collect its garbage.

    For steps that write each result and execute no plan twice (a second execution makes its shuffles anew).
    The session's own setting stands again when the last of nested or simultaneous uses ends.
    """
    key = spark.sparkContext.applicationId
    with _DROPPING_LOCK:
        uses = _DROPPING.setdefault(key, [0, None])
        if not uses[0]:
            uses[1] = spark.conf.get(SHUFFLE_CLEANUP, None)
            spark.conf.set(SHUFFLE_CLEANUP, "true")
        uses[0] += 1
    try:
        yield
    finally:
        with _DROPPING_LOCK:
            uses[0] -= 1
            if not uses[0]:
                if uses[1] is None:
                    spark.conf.unset(SHUFFLE_CLEANUP)
                else:
                    spark.conf.set(SHUFFLE_CLEANUP, uses[1])


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint to the shared folder (survives executor loss)."""
    checkpoint_base(df.sparkSession)
    return df.checkpoint(eager=eager)


def written(df, name: str, path: str | None = None):
    """The rows written once to the shared folder, by column: a later plan reads the columns it needs and computes none again."""
    path = path or scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
