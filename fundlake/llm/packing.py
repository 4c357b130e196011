"""Packing of documents into sequences of fixed length, balanced by attention cost.

The cost of a piece is linear plus quadratic in its length. Pieces go, longest first, to the
cheapest sequence that has room. A piece that fits nowhere is cut to fill the cheapest one, so
all sequences but the last of a task are full. A task packs what it reads: no shuffle, no key.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from fundlake.llm.common import rows_of, texts, to_batch
from fundlake.llm.tokens import word_ids

LENGTH = 2048
END = 1
#: Tokens of document rests that are packed together; 4 bytes each.
WINDOW = 1 << 21
#: Length at which the quadratic part of the cost equals the linear one.
EVEN_COST = 6144

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_SQL_TYPE = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def cost(tokens):
    """Attention cost of a piece, in units of one token's linear work."""
    return tokens + tokens * tokens / EVEN_COST


def assign(lengths: list[int], sequences: int, size: int):
    """Pieces ``(item, start, length, sequence, offset)`` that fill ``sequences`` and the rest ``(item, start, length)``.

    Items go by descending length, each to the cheapest sequence with room for all of it; if
    there is none, as much as the cheapest unfilled one holds is cut off.
    """
    room = np.full(sequences, size, np.int64)
    price = np.zeros(sequences)
    left = sum(lengths)
    space = sequences * size
    heap = [(-n, i, 0) for i, n in enumerate(lengths)]
    heapq.heapify(heap)
    placed = []
    while heap and space:
        n, item, start = heapq.heappop(heap)
        n = -n
        fits = np.where(room >= n, price, np.inf)
        k = int(fits.argmin())
        take = n
        if fits[k] == np.inf:
            k = int(np.where(room > 0, price, np.inf).argmin())
            take = int(room[k])
            heapq.heappush(heap, (take - n, item, start + take))
        placed.append((item, start, take, k, size - int(room[k])))
        room[k] -= take
        price[k] += cost(take)
        space -= take
        left -= take
    return placed, [(item, start, -n) for n, item, start in heap]


def _pack(path: str, size: int, window: int, with_ids: bool):
    schema = _PIECES.append(pa.field("ids", pa.list_(pa.int32()))) if with_ids else _PIECES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = word_ids(path)
        base = TaskContext.get().partitionId() << 33
        count = 0
        out: list[tuple] = []
        pool: list[tuple] = []  # id, start of the rest in its document, its ids, tokens of the document
        held = 0

        def piece(doc, start, ids, tokens, sequence, offset):
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), tokens, base + sequence, offset)
            out.append(row + (np.frombuffer(ids, "<u4").astype(np.int32),) if with_ids else row)

        def fill(sequences: int):
            nonlocal pool, held, count
            placed, rest = assign([len(p[2]) // 4 for p in pool], sequences, size)
            for item, start, n, k, offset in placed:
                doc, first, ids, tokens = pool[item]
                piece(doc, first + start, ids[4 * start : 4 * (start + n)], tokens, count + k, offset)
            count += sequences
            kept = []
            for item, start, n in rest:
                doc, first, ids, tokens = pool[item]
                kept.append((doc, first + start, ids[4 * start : 4 * (start + n)], tokens))
            pool, held = kept, sum(len(p[2]) // 4 for p in kept)

        end = np.array([END], "<u4").tobytes()
        for _, doc, data in rows_of(batches):
            ids = encode.text(data) + end
            tokens = len(ids) // 4
            whole = tokens // size * size
            for start in range(0, whole, size):
                piece(doc, start, ids[4 * start : 4 * (start + size)], tokens, count, 0)
                count += 1
            if whole < tokens:
                pool.append((doc, whole, ids[4 * whole :], tokens))
                held += tokens - whole
            if held >= window:
                fill(held // size)
            if len(out) >= 4096:
                yield to_batch(out, schema)
                out.clear()
        fill(-(-held // size))
        if out:
            yield to_batch(out, schema)

    return pack


def packed(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    window: int = WINDOW,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: where its ids lie in the document and in a sequence.

    ``tokenizer`` is the vocabulary file of the word tokenizer. Each document ends with id 1, so
    an empty or null text is one token. Ids may be null or repeat; pieces refer to rows as they
    come. An empty table gives no pieces. Memory is bounded by ``window`` and one document.
    ``with_ids`` adds the token ids themselves.
    """
    kind = _SQL_TYPE + (", ids array<int>" if with_ids else "")
    return texts(docs, id_col, text_col).mapInArrow(_pack(tokenizer, length, window, with_ids), kind)
