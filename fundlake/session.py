"""Session settings and the shared folder that jobs may write to."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Every operator assumes UTC sessions and ANSI casts. The rest is about safe joins: file sizes
# count five times when a broadcast is planned, since Parquet is compressed; other sides are
# broadcast only once their size has been measured; and skewed join partitions are split even
# where that costs one more exchange.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.fileCompressionFactor": "5.0",
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set the run-time options the operators rely on; cluster sizing is left alone."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("fundlake")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, or below the warehouse where that is unset.

    Both are storage that driver and executors share; a machine's own folder never is.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(rows: DataFrame, name: str, **options: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    For small results of an expensive scan that several branches of a plan need: the scan
    runs once, and a lost executor costs no more than reading the table again.
    """
    path = shared_folder(rows.sparkSession, name)
    rows.write.options(**options).parquet(path)
    table = rows.sparkSession.read.schema(rows.schema).parquet(path)
    table._stored_path = path
    for tables in _NOTED:
        tables.append(table)
    return table


#: Lists of the ``noted`` blocks that are open.
_NOTED: list[list[DataFrame]] = []


@contextmanager
def noted():
    """The tables that ``stored`` writes inside the block, for the caller to ``discard`` when their readers are done."""
    tables: list[DataFrame] = []
    _NOTED.append(tables)
    try:
        yield tables
    finally:
        _NOTED[:] = [t for t in _NOTED if t is not tables]


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``stored`` wrote, once nothing reads them any more; others are passed over."""
    for table in tables:
        if not hasattr(table, "_stored_path"):
            continue
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._stored_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
