"""Exact de-duplication by deterministic block naming.

A text without white space is cut into blocks of fixed size. Sorting the distinct blocks gives
each an integer name. Adjacent names are paired, the distinct pairs are sorted and named again,
until each document has a single name: equal names at one level mean equal texts, with no
collisions. Every level costs rows of a few integers; the text itself is shuffled once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, batched, numbered, rows_of
from fundlake.session import discard, stored

BLANKS = b" \t\n\x0b\x0c\r"
BLOCK_BYTES = 4096
#: Distinct blocks of a sorted range, about; the number of ranges follows from that of the blocks.
RANGE_BLOCKS = 64
#: Blocks that a task remembers so as to send each distinct one once.
REMEMBERED_BYTES = 16 << 20

_BLOCKS = pa.schema(
    [
        (ROW, pa.int64()),
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("text_sha256", pa.string()),
        ("n", pa.int32()),
        ("pos", pa.int32()),
        ("lead", pa.int64()),
        ("block", pa.binary()),
    ]
)
_SQL_TYPE = (
    f"{ROW} long, doc_id long, n_chars long, text_sha256 string, n int, pos int, lead long, block binary"
)


def _cut(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 40
        leads: dict[bytes, int] = {}
        held = count = 0

        def rows():
            nonlocal held, count
            for row, doc, n_chars, data in rows_of(batches):
                data = data.translate(None, BLANKS)
                n = max(1, -(-len(data) // size))
                for pos in range(n):
                    block = data[pos * size : (pos + 1) * size]
                    lead = leads.get(block)
                    send = lead is None
                    if send:
                        if held > REMEMBERED_BYTES:
                            leads.clear()
                            held = 0
                        lead = leads[block] = base + count
                        held += len(block) + 100
                        count += 1
                    first = pos == 0
                    yield (
                        row,
                        doc if first else None,
                        n_chars if first else None,
                        hashlib.sha256(data).hexdigest() if first else None,
                        n,
                        pos,
                        lead,
                        block if send else None,
                    )

        yield from batched(rows(), _BLOCKS, weight=lambda r: len(r[7] or b""))

    return cut


def _ranked(distinct: DataFrame, ranges: int, *keys: str) -> DataFrame:
    """A name for each distinct key: its range (31 bits) and its place in the sorted range (32 bits)."""
    order = Window.partitionBy("range").orderBy(*keys)
    return distinct.withColumn("range", F.pmod(F.xxhash64(*keys), F.lit(ranges))).withColumn(
        "name", F.shiftleft(F.col("range"), 32) + F.dense_rank().over(order)
    )


def identities(blocks: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """``_row``, ``level`` and ``name`` of each document from its stored blocks, and tables to discard after use.

    A block reaches the sort once per task that saw it, never once per copy, so a text that a
    third of all rows repeat weighs no more than any other.
    """
    size = blocks.agg(F.count("block").alias("sent"), F.max("n").alias("longest")).first()
    ranges = size["sent"] // RANGE_BLOCKS + 1
    leads = _ranked(blocks.where("block is not null").select("lead", "block"), ranges, "block")
    current = stored(
        blocks.select(ROW, "n", "pos", "lead").join(leads.select("lead", "name"), "lead").drop("lead"),
        "block-names",
    )
    used = [current]
    levels = (size["longest"] or 1) - 1
    done = current.where("n = 1").select(ROW, F.lit(0).alias("level"), "name")
    for level in range(1, levels.bit_length() + 1):
        pairs = (
            current.where("n > 1")
            .groupBy(ROW, "n", (F.col("pos") / 2).cast("int").alias("half"))
            .agg(
                F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("left"),
                F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("right"),
            )
        )
        names = _ranked(pairs.select("left", "right").distinct(), ranges, "left", "right")
        current = stored(
            pairs.join(names.select("left", "right", "name"), ["left", "right"]).select(
                ROW, ((F.col("n") + 1) / 2).cast("int").alias("n"), F.col("half").alias("pos"), "name"
            ),
            "pair-names",
        )
        used.append(current)
        done = done.union(current.where("n = 1").select(ROW, F.lit(level).alias("level"), "name"))
    return done, used


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES):
    """Groups of documents whose texts are equal once white space is deleted.

    Returns ``_row, doc_id, keep_id, group_size, kept, text_sha256`` for every input row. Null
    texts count as empty, and all empty texts are one group. The row with the longest original
    text stays; of equally long ones the smallest id, nulls last; of repeated rows the first.
    """
    length = F.coalesce(F.length(text_col), F.lit(0)).cast("long").alias("n_chars")
    rows = numbered(docs).select(
        ROW,
        F.col(id_col).cast("long").alias("doc_id"),
        length,
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"),
    )
    blocks = stored(rows.mapInArrow(_cut(block_bytes), _SQL_TYPE), "blocks")
    found, used = identities(blocks)
    facts = blocks.where("pos = 0").select(ROW, "doc_id", "n_chars", "text_sha256")
    rows = stored(facts.join(found, ROW), "identities")
    discard(blocks, *used)
    best = rows.groupBy("level", "name").agg(
        F.count("*").alias("group_size"),
        F.max(F.struct("n_chars", F.bitwise_not("doc_id").alias("first"), F.bitwise_not(ROW).alias("row"), "doc_id")).alias("best"),
    )
    return rows.join(best, ["level", "name"]).select(
        ROW,
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        "group_size",
        (F.col(ROW) == F.bitwise_not("best.row")).alias("kept"),
        "text_sha256",
    )
