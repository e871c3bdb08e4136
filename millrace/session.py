"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from millrace import folders

# Settings the operators rely on. All of them can be changed on a live session.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where that costs one more shuffle above the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session made elsewhere, where they differ, and return it."""
    for name, value in SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


@contextlib.contextmanager
def session_setting(spark: SparkSession, name: str, value: str):
    """Hold a setting of the session and put the old one back afterwards."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def local_session(cores: str | int = "*", name: str = "millrace") -> SparkSession:
    """Session for tests and local benchmarks; a cluster brings its own."""
    partitions = "8" if cores == "*" else str(max(int(cores), 1))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder path below the shared folder the cluster names.

    The folder comes from ``spark.checkpoint.dir``. Where that is unset, the warehouse folder takes its
    place, which must be shared too: on a cluster a folder of the driver's own disk is an error. The folder is
    removed when the process ends, or by ``discard``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir")
        if not spark.sparkContext.master.startswith("local[") and base.split(":", 1)[0] in ("file", base):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors share: {base} is a local one")
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    _SCRATCH.append((spark, path))
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder that nothing reads any more."""
    folders.remove(spark, path)
    _SCRATCH[:] = [(s, p) for s, p in _SCRATCH if p != path]


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the frame once below the scratch folder and read it back.

    This cuts the lineage: what follows can read the rows several times, and a
    lost executor costs no more than the tasks after the write.
    """
    return _read_back(df, scratch_dir(df.sparkSession, label))


@contextlib.contextmanager
def staged(df: DataFrame, label: str):
    """The same for a while: the folder is removed at the end."""
    path = scratch_dir(df.sparkSession, label)
    try:
        yield _read_back(df, path)
    finally:
        discard(df.sparkSession, path)


def _read_back(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SCRATCH: list[tuple[SparkSession, str]] = []


@atexit.register
def _remove_scratch() -> None:
    for spark, path in _SCRATCH:
        with contextlib.suppress(Exception):  # the session may be gone already
            folders.remove(spark, path)
