"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession

_own_roots: dict[str, tempfile.TemporaryDirectory] = {}
#: Intermediate tables that this process has written, each with what deletes it.
_written: dict[str, tuple] = {}
#: Those that the innermost `scratch` of a thread has seen.
_scope = threading.local()


def build_session(app: str = "gridlens", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Settings every operator relies on; all can be changed on a running session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    The cluster's ``spark.checkpoint.dir`` is used when set. Only a local master
    may fall back to a temporary folder: executors elsewhere could not see it.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    if sc.applicationId not in _own_roots:
        _own_roots[sc.applicationId] = tempfile.TemporaryDirectory(prefix="gridlens-")
    return _own_roots[sc.applicationId].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder for an intermediate table. It is deleted by `release`, at the latest when the driver ends."""
    path = f"{checkpoint_root(spark)}/gridlens/{label}-{uuid.uuid4().hex}"
    sc = spark.sparkContext
    _written[path] = (sc._jvm.org.apache.hadoop.fs.Path, sc._jsc.hadoopConfiguration())
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    return path


def release(paths=None) -> None:
    """Delete the given intermediate tables, or all of this process. Nothing may read them any more."""
    for path in list(_written) if paths is None else list(paths):
        make, conf = _written.pop(path, (None, None))
        if make is not None:
            at = make(path)
            at.getFileSystem(conf).delete(at, True)


@atexit.register
def _release_at_exit() -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone already
        release()


def path_exists(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(sc._jsc.hadoopConfiguration()).exists(at))


@contextlib.contextmanager
def scratch():
    """Delete, at the end, the intermediate tables that this thread wrote inside; what was made of them must be written."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        release(_scope.paths)
        _scope.paths = outer


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and return the written table.

    Used where a value must not change if a task is run again (row ids assigned
    after a sampled range partitioning) and to cut long lineage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
