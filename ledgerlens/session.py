"""Session helpers: a tuned SparkSession for local runs and the shared scratch folder.

The library never invents a machine-local folder on a cluster: durable intermediate
tables go under the folder the cluster names in ``spark.checkpoint.dir``.  Only a
``local[...]`` session without that setting (tests, bench) gets a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(
    master: str = "local[8]",
    app_name: str = "ledgerlens",
    shuffle_partitions: int = 8,
    driver_memory: str = "16g",
    extra: dict | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    conf = dict(extra or {})
    if "spark.checkpoint.dir" not in conf and master.startswith("local"):
        # Local runs only (tests, bench): a fresh folder per session. On a cluster the
        # shared folder must come from the cluster's spark.checkpoint.dir.
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no SparkContext
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or spark.conf.get("spark.app.name", "ledgerlens")


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for durable intermediate tables (``spark.checkpoint.dir``).

    Read from the session; only a local session without the setting gets a fresh
    temp folder (as in tests). On a cluster the setting is required."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder "
                "(HDFS/S3/ABFS) so intermediate tables survive executor loss"
            )
        path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


_RUN: ContextVar[str] = ContextVar("ledgerlens_run", default="")


def _own_folder(spark: SparkSession) -> str:
    return os.path.join(scratch_root(spark), "ledgerlens", app_id(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared scratch root for table ``name``: in the folder
    of the present ``scratch_run``, or of the application."""
    return os.path.join(_own_folder(spark), _RUN.get(), f"{name}-{uuid.uuid4().hex[:12]}")


def _delete(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


@contextmanager
def scratch_run(spark: SparkSession, keep: bool = False) -> Iterator[str]:
    """A folder for the intermediate tables of what runs inside; deleted at the end, also after
    an error, unless ``keep``. Results must be written or collected inside: a DataFrame that
    reads an intermediate table cannot be read any more."""
    run = f"run-{uuid.uuid4().hex[:12]}"
    token = _RUN.set(run)
    folder = os.path.join(_own_folder(spark), run)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        if not keep:
            _delete(spark, folder)


def drop_scratch(spark: SparkSession) -> bool:
    """Delete all intermediate tables of this application (portfolios that a session holds in
    memory go with them: ``plans.mart.refresh``). Whether there were any."""
    return _delete(spark, _own_folder(spark))


#: The JVM leaves methods above this size to its interpreter (HotSpot's huge method limit).
JIT_BYTES = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Wide projections run inside as methods that the JVM compiles: a generated stage beyond
    ``JIT_BYTES`` falls back to projections that Spark splits into small methods."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.set(name, str(min(JIT_BYTES, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared scratch folder and read it back (cuts
    lineage; survives executor loss)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
