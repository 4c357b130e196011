"""Live quotes as a stream: the same parser on newly landed responses.

No state is kept in the stream. What has been seen lies in the tables themselves, and a
micro-batch reads only the parts of them that it touches: the days of its quotes, the
buckets of its funds. A batch that runs again finds what was there before it ran first,
so it writes the same files again.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fundlake.functions.rows import keep_where
from fundlake.operators.quotes import latest_quotes, live_quotes
from fundlake.schemas import KEY, RESPONSES
from fundlake.sources import folders

QUOTE = "site_type string, url string, portfolio_id string, date timestamp_ntz, fetched_at timestamp, creation double, redemption double"
BUCKETS = 64
_VALUES = ["date", "fetched_at", "creation", "redemption"]


def read_landing_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    return (
        spark.readStream.schema(RESPONSES).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    )


def quote_stream(responses: DataFrame) -> DataFrame:
    """Parsed quotes that name their time; the stream is not reduced yet."""
    return keep_where(live_quotes(responses), F.col("date").isNotNull()).select(*KEY, *_VALUES)


def _same(left: str, right: str, columns: list[str]) -> Column:
    return reduce(and_, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def _read(spark: SparkSession, base: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], QUOTE)
    return spark.read.schema(QUOTE).option("basePath", base).parquet(*paths).select(*KEY, *_VALUES)


def _replacing(rows: DataFrame, path: str, *partitions: str) -> None:
    """Write whole partitions; those that get no rows stay as they are."""
    rows.write.partitionBy(*partitions).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_quotes(quotes: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append each quote (fund, time) once to ``path/day=…/batch=…``, however late it arrives again.

    A batch is reduced by quote first, the earliest capture staying, so that a quote that was
    captured very often weighs no more than others; then it is compared with the quotes that
    earlier batches wrote for the same days, of which only fund and time are read. A fund that
    is polled very often spreads over its times.
    """

    def add(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        earliest = F.min(F.struct("fetched_at", "creation", "redemption")).alias("q")
        once = batch.groupBy(*KEY, "date").agg(earliest).select(*KEY, "date", "q.*")
        once = once.withColumn("day", F.date_format("date", "yyyy-MM-dd")).persist()
        days = [r["day"] for r in once.select("day").distinct().collect()]
        seen = [
            f"{path}/day={day}/batch={b}" for day in days for b in folders.values(spark, f"{path}/day={day}", "batch") if int(b) < number
        ]
        rows = once
        if seen:
            known = _read(spark, path, seen).select(*KEY, "date")
            rows = once.alias("new").join(known.alias("old"), _same("new", "old", [*KEY, "date"]), "left_anti")
        dealt = rows.withColumn("batch", F.lit(number)).hint("rebalance", F.col("day"))  # few files, busy days in several
        _replacing(dealt, path, "day", "batch")
        once.unpersist()

    return (
        quotes.writeStream.foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    """The quotes that ``write_quotes`` has written so far."""
    written = [f"{path}/day={day}" for day in folders.values(spark, path, "day")]
    return _read(spark, path, written)


# --- newest quote per fund -------------------------------------------------------------------


def _versions(spark: SparkSession, root: str, buckets: list[str] | None = None) -> dict[str, list[int]]:
    """The versions of each bucket, ascending."""
    known = folders.values(spark, root, "bucket") if buckets is None else buckets
    return {b: sorted(map(int, folders.values(spark, f"{root}/bucket={b}", "v"))) for b in known}


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest version of every bucket below ``path``; only their files are read."""
    newest = []
    for count in folders.values(spark, path, "of"):
        for bucket, versions in _versions(spark, f"{path}/of={count}").items():
            newest += [f"{path}/of={count}/bucket={bucket}/v={v}" for v in versions[-1:]]
    return _read(spark, path, newest)


def keep_latest(quotes: DataFrame, path: str, checkpoint: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Maintain the newest quote per fund as a table of hash buckets, ``path/of=…/bucket=…/v=…``.

    A batch reads the buckets of its funds, leaves what is no news, and writes a new version of
    the buckets that change; all others keep their files. The number of buckets belongs to the
    table and cannot change. A version that two later ones follow is removed, so that readers
    that have just listed the table still find its files.
    """
    root = f"{path}/of={buckets}"

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if set(folders.values(spark, path, "of")) - {str(buckets)}:
            raise ValueError(f"{path} has another number of buckets than {buckets}")
        bucket = F.pmod(F.xxhash64(*KEY), F.lit(buckets)).cast("int").alias("bucket")
        fresh = latest_quotes(batch).select(bucket, *KEY, F.struct(*_VALUES).alias("q")).persist()
        near = _stored_buckets(spark, root, [str(r[0]) for r in fresh.select("bucket").distinct().collect()], number)
        news = fresh
        if near is not None:
            joined = fresh.alias("new").join(near.alias("old"), _same("new", "old", ["bucket", *KEY]), "left")
            news = joined.where("old.q IS NULL OR new.q > old.q").select("new.*")
        news = news.persist()
        touched = [str(r[0]) for r in news.select("bucket").distinct().collect()]
        if touched:
            before = _stored_buckets(spark, root, touched, number)
            rows = news if before is None else news.unionByName(before)
            newest = rows.repartition("bucket").groupBy("bucket", *KEY).agg(F.max("q").alias("q"))
            _replacing(newest.select("bucket", *KEY, "q.*").withColumn("v", F.lit(number)), root, "bucket", "v")
        news.unpersist()
        fresh.unpersist()
        for b, versions in _versions(spark, root, touched).items():
            for v in [v for v in versions if v < number][:-2]:
                folders.remove(spark, f"{root}/bucket={b}/v={v}")

    return (
        quotes.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _stored_buckets(spark: SparkSession, root: str, buckets: list[str], before: int) -> DataFrame | None:
    """The rows of these buckets as they were before version ``before``."""
    paths = []
    for bucket, versions in _versions(spark, root, buckets).items():
        paths += [f"{root}/bucket={bucket}/v={v}" for v in versions if v < before][-1:]
    if not paths:
        return None
    rows = spark.read.schema(f"{QUOTE}, bucket int, v int").option("basePath", root).parquet(*paths)
    return rows.select("bucket", *KEY, F.struct(*_VALUES).alias("q"))
