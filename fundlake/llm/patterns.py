"""Packing of documents into few sequences of fixed length, by patterns of lengths.

Which documents go together depends on their lengths alone, so the plan is made from the
histogram of lengths, which has as many rows as a sequence has tokens, however many documents
there are. All patterns of up to four lengths that fill a sequence are listed, in steps of 16
tokens; non-negative least squares finds how often to repeat each so that the histogram is used
up; repeats are rounded, and each takes lengths near its steps that fill a sequence to the last
token. What remains is packed best-fit, longest first, all documents of one length at once.

The plan gives the n-th document of each length its sequence and offset. The documents are
numbered per length by counts of their parts, so no length is gathered, however common it is.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.byte_tokens import byte_ids
from fundlake.llm.common import rows_of, texts, to_batch
from fundlake.session import discard, stored

LENGTH = 2048
END = 0
#: Step of lengths in the patterns, and most lengths of one.
STEP = 16
MOST = 4


# --- plan ------------------------------------------------------------------------------------


def patterns(total: int, most: int, used: np.ndarray) -> np.ndarray:
    """All non-increasing rows of at most ``most`` of the ``used`` steps that add up to ``total``, zeros last."""
    rows = np.zeros((1, 0), np.int64)
    for k in range(most):
        left = total - rows.sum(1)
        top = np.minimum(left, rows[:, -1]) if k else left
        least = -(-left // (most - k))  # the largest of what is left takes its share at least
        width = np.maximum(top - least + 1, 0)
        done = left == 0
        width[done] = 1
        start = np.repeat(np.where(done, 0, least), width)
        step = np.arange(len(start)) - np.repeat(np.cumsum(width) - width, width)
        part = start + step
        fits = (part == 0) | used[part]
        rows = np.column_stack([np.repeat(rows, width, 0), part])[fits]
    return rows


def non_negative_least_squares(rows: np.ndarray, target: np.ndarray, weight: np.ndarray, rounds: int = 2000) -> np.ndarray:
    """``x >= 0`` that least misses ``target`` by patterns ``rows``, by active sets.

    Column j counts the steps of ``rows[j]``; a miss of a step counts by its weight. In each round
    the column that would lessen the misses most joins the set; columns that turn negative
    leave it. Few columns stay, no more than steps, each with a large repeat.
    """
    steps = len(target)
    x, active = np.zeros(len(rows)), []
    scaled = target * weight
    parts, counts = rows, rows > 0

    def column(j):
        c = np.bincount(rows[j][rows[j] > 0], minlength=steps).astype(float)
        return c * weight

    matrix: list[np.ndarray] = []
    missed = scaled.copy()
    norm = np.sqrt(sum(np.where(counts[:, k], weight[parts[:, k]], 0) ** 2 for k in range(rows.shape[1]))) if len(rows) else np.zeros(0)
    for _ in range(rounds):
        pull = missed * weight
        gain = np.where(counts, pull[parts], 0).sum(1) / np.maximum(norm, 1e-12)
        gain[active] = -np.inf
        if not len(gain) or gain.max() <= 1e-9 * max(1.0, np.abs(scaled).max()):
            break
        active.append(int(gain.argmax()))
        matrix.append(column(active[-1]))
        while True:
            a = np.array(matrix).T
            best = np.linalg.lstsq(a, scaled, rcond=None)[0]
            if best.min() > 0:
                x[active] = best
                break
            now = x[active]
            falling = best <= 0
            reach = np.min(now[falling] / np.maximum(now[falling] - best[falling], 1e-300))
            now = now + reach * (best - now)
            x[active] = now
            stay = now > 1e-12 * max(1.0, now.max())
            x[[j for j, s in zip(active, stay) if not s]] = 0
            active, matrix = [j for j, s in zip(active, stay) if s], [m for m, s in zip(matrix, stay) if s]
            if not active:
                break
        missed = scaled - (np.array(matrix).T @ x[active] if active else 0)
    return x


def by_patterns(histogram: np.ndarray, size: int, step: int, most: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Sequences as ``(lengths, repeats)`` that the fitted patterns fill to the last token, and the histogram that is left.

    A length counts for the nearest step (those below half a step for none), so that the lengths
    of a pattern's steps add up to a full sequence in many ways; each repeat takes one of them.
    """
    left = histogram.copy()
    bins = (np.arange(size + 1) + step // 2) // step
    target = np.bincount(bins, weights=histogram)
    target[0] = 0
    rows = patterns(size // step, most, target > 0)
    weight = np.arange(len(target)) * step / size  # a document that is left costs its tokens
    repeats = non_negative_least_squares(rows, target, weight)
    found: list[tuple[tuple[int, ...], int]] = []
    for j in np.argsort(-repeats, kind="stable"):
        wanted = int(repeats[j] + 0.5)
        if not wanted:
            break
        ranges = [[n for n in np.flatnonzero(bins == part).tolist() if left[n]] for part in rows[j][rows[j] > 0]]
        for lengths in product(*ranges[:-1]):
            last = size - sum(lengths)
            if last <= 0 or bins[last] != rows[j][len(ranges) - 1]:
                continue
            whole = (*lengths, last)
            n = min(wanted, *(int(left[x]) // whole.count(x) for x in whole))
            if n > 0:
                found.append((whole, n))
                wanted -= n
                for x in whole:
                    left[x] -= n
            if not wanted:
                break
    return found, left


def best_fit(open_: list[tuple[tuple[int, ...], int]], left: np.ndarray, size: int) -> list[tuple[tuple[int, ...], int]]:
    """Puts what is left, longest first, where it fits most tightly; like sequences are treated at once."""
    groups: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    rooms: list[int] = []

    def put(lengths, n):
        room = size - sum(lengths)
        if room not in groups or not groups[room]:
            insort(rooms, room)
        groups[room].append((lengths, n))

    for lengths, n in open_:
        put(lengths, n)
    for length in range(size, 0, -1):
        count = int(left[length])
        while count:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                each = size // length
                if count // each:
                    put((length,) * each, count // each)
                if count % each:
                    put((length,) * (count % each), 1)
                break
            room = rooms[at]
            lengths, n = groups[room].pop()
            if not groups[room]:
                rooms.pop(at)
            each = room // length
            full = min(n, count // each)
            rest = count % each if full < n else 0
            if full:
                put((*lengths, *(length,) * each), full)
            if rest:
                put((*lengths, *(length,) * rest), 1)
            if n - full - (rest > 0):
                put(lengths, n - full - (rest > 0))
            count -= full * each + rest
    return [g for room in sorted(groups) for g in groups[room]]


def plan(histogram: np.ndarray, size: int = LENGTH, step: int = STEP, most: int = MOST) -> list[tuple[tuple[int, ...], int]]:
    """Sequences as ``(lengths, repeats)`` that hold ``histogram[n]`` documents of each length n."""
    return best_fit(*by_patterns(histogram, size, step, most), size)


def lookup(sequences: list[tuple[tuple[int, ...], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length: from which document of it on, to which sequence (less that number), at which offset."""
    found: dict[int, list[tuple[int, int, int]]] = defaultdict(list)
    used: dict[int, int] = defaultdict(int)
    first = 0
    for lengths, n in sequences:
        offset = 0
        for length in lengths:
            found[length].append((used[length], first - used[length], offset))
            used[length] += n
            offset += length
        first += n
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in found.items()}


# --- documents -------------------------------------------------------------------------------

_CUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()),
        ("ids_crc32", pa.int64()), ("part", pa.int64()), ("place", pa.int64()), ("ids", pa.list_(pa.int32())),
    ]
)
_CUT_TYPE = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, place long, ids array<int>"


def _cut(path: str, size: int, with_ids: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = byte_ids(path)
        part = TaskContext.get().partitionId()
        end = np.array([END], "<u4").tobytes()
        seen = np.zeros(size + 1, np.int64)
        out, held = [], 0
        for _, doc, data in rows_of(batches):
            ids = encode.text(data) + end
            tokens = len(ids) // 4
            stops = range((tokens - 1) % size + 1, tokens + 1, size)
            for piece, stop in enumerate(stops):
                start = max(0, stop - size) if piece else 0
                own = ids[4 * start : 4 * stop]
                values = np.frombuffer(own, "<u4").astype(np.int32) if with_ids else None
                out.append((doc, piece, start, stop - start, zlib.crc32(own), part, int(seen[stop - start]), values))
                seen[stop - start] += 1
                held += len(own) if with_ids else 0
                if len(out) >= 4096 or held > 8 << 20:
                    yield to_batch(out, _CUT)
                    out, held = [], 0
        if out:
            yield to_batch(out, _CUT)

    return cut


def _seat(found: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]):
    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, number = (batch.column(n).to_numpy() for n in ("length", "number"))
            sequence, offset = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
            for length in np.unique(lengths).tolist():
                of = lengths == length
                begins, first, at = found[length]
                row = np.searchsorted(begins, number[of], "right") - 1
                sequence[of] = first[row] + number[of]
                offset[of] = at[row]
            kept = [batch.column(n) for n in batch.schema.names if n != "number"]
            names = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return seat


def pattern_packed(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    step: int = STEP,
    most: int = MOST,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document: its ids' place in the document, and in a sequence.

    ``tokenizer`` is the file of the byte-level vocabulary. A document ends with id 0, so a null or
    empty text is one token. Only documents longer than ``length`` are cut: all pieces but the
    first have that length. ``step`` must divide ``length``. ``with_ids`` adds the ids themselves.

    Ids may be null or repeat: pieces refer to rows as they come, so repeated rows are packed as
    often as they stand there. Equal lengths are ties, and any of their documents may take any of
    their places. A long text is encoded by itself, and its pieces are passed on one by one. Other
    columns are not read, whatever their names. An empty table gives no pieces.
    """
    rows = texts(docs, id_col, text_col).mapInArrow(_cut(tokenizer, length, with_ids), _CUT_TYPE)
    pieces = stored(rows if with_ids else rows.drop("ids"), "pieces", compression="zstd")
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    histogram = np.zeros(length + 1, np.int64)
    for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():
        histogram[r["length"]] = r["n"]
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    numbered = pieces.join(offsets, ["length", "part"]).withColumn("number", F.col("before") + F.col("place"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    kind = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = lookup(plan(histogram, length, step, most))
    return numbered.select(*names, "number").mapInArrow(_seat(found), kind + ", sequence_id long, offset long")
