"""What several operators share: row numbers, UTF-8 columns, word lists, Arrow rows."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.session import configure, stored

#: Number of an input row. Ids may be null or repeat, so operators tell rows apart by this.
ROW = "_row"
#: Marks numbers given here; an input column that happens to have the name is no row number.
_MARK = {"numbered": uuid.uuid4().hex}


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the options of the library, and Arrow batches that hold few whole texts."""
    configure(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark


def ship(spark: SparkSession) -> None:
    """Give the workers this package, once per application; the driver serves the archive."""
    context = spark.sparkContext
    if getattr(context, "_fundlake_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="package-"), "fundlake_package.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)
    context._fundlake_shipped = True


def has_numbers(docs: DataFrame) -> bool:
    return any(f.name == ROW and f.metadata == _MARK for f in docs.schema)


def numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a row number in place of any other column of that name; a number given before stays.

    For one pass over the rows. A second scan may be split otherwise, as by the cores present, and
    then numbers anew: rows that are read more than once are numbered by ``fixed``.
    """
    ship(docs.sparkSession)
    if has_numbers(docs):
        return docs
    return docs.withColumn(ROW, F.monotonically_increasing_id()).withMetadata(ROW, _MARK)


def fixed(docs: DataFrame, *columns) -> DataFrame:
    """Row number and ``columns`` (default: all), written once, so that every use reads the same numbers.

    A table with row numbers was written with them and is not written again.
    """
    rows = numbered(docs)
    rows = rows.select(ROW, *columns) if columns else rows
    return rows if has_numbers(docs) else stored(rows, "rows", compression="zstd")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Row number, id and the text as UTF-8 bytes (null: empty); all other columns go."""
    return numbered(docs).select(
        ROW,
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"),
    )


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches one by one, so that no second copy of a batch is held."""
    for batch in batches:
        columns = [batch.column(i) for i in range(batch.num_columns)]
        for i in range(batch.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def batched(rows: Iterator[tuple], schema: pa.Schema, most: int = 4096, weight: Callable | None = None):
    """Arrow batches of ``rows``: ``most`` rows each, or fewer once their weights pass 8 MB."""
    kept, load = [], 0
    for row in rows:
        kept.append(row)
        load += weight(row) if weight else 0
        if len(kept) >= most or load > 8 << 20:
            yield to_batch(kept, schema)
            kept, load = [], 0
    if kept:
        yield to_batch(kept, schema)


def to_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrays = [pa.array(c, type=f.type) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)
