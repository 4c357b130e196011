"""Near-duplicates by min-max hashing, confirmed on full shingle sets.

Every hash function gives two signature values, the least and the greatest hash of a document's
shingles, so half as many hashes are evaluated. Bands of values find candidates. Documents with
equal sets are one node. A node is compared with the first node of each of its buckets; the
verified links join nodes into components. Where a bucket still holds several components, the
sets of their nodes are multiplied in blocks, which counts all intersections without a row for
each pair; a block gives one link for each two components that it joins. So no bucket pair that
could join two components stays unchecked.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, fixed, rows_of, to_batch
from fundlake.llm.components import components
from fundlake.session import discard, stored

BAND_ROWS = 4
#: Chance that a pair right at the similarity shares no band.
MISS = 1e-8
REMEMBERED_WORDS = 200_000
#: Shingles hashed at a time.
BLOCK = 1 << 18

#: Shingles and nodes of a block, on average at most, and columns that are multiplied at a time.
BLOCK_SHINGLES = 400_000
BLOCK_NODES = 2048
COLUMNS = 4096

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def bands_for(similarity: float) -> int:
    """Even number of bands that leaves a chance of at most ``MISS`` at the similarity."""
    n = math.ceil(math.log(MISS) / math.log(1 - similarity**BAND_ROWS))
    return n + n % 2


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C2
    return h ^ (h >> np.uint64(29))


def shingles(data: bytes, size: int, known: dict) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; a shorter text is one shingle."""
    found = data.translate(_LOWER).split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(known.__getitem__, found), np.uint64, n)
    size = min(size, n)
    out = h[: n - size + 1] + np.uint64(size)
    for j in range(1, size):
        out = (out ^ (out >> np.uint64(29))) * _C1 + h[j : n - size + 1 + j]
    return np.unique(_mix(out))


def _factors(count: int) -> np.ndarray:
    rng = np.random.default_rng(20240613)
    return rng.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def signatures(sets: list[np.ndarray], bands: int) -> np.ndarray:
    """Band hashes of non-empty sets: half of the bands from minima, half from maxima."""
    flat = np.concatenate(sets)
    starts = np.cumsum([0] + [len(s) for s in sets[:-1]])
    half = bands // 2
    factors = _factors(half * BAND_ROWS)
    low = np.zeros((half, len(sets)), np.uint64)
    high = np.zeros((half, len(sets)), np.uint64)
    for k, factor in enumerate(factors):
        v = flat * factor
        v ^= v >> np.uint64(31)
        band = k // BAND_ROWS
        low[band] = _mix(low[band] * _C1 + np.minimum.reduceat(v, starts))
        high[band] = _mix(high[band] * _C1 + np.maximum.reduceat(v, starts))
    both = np.concatenate([low, high])
    return _mix(both + np.arange(1, bands + 1, dtype=np.uint64)[:, None] * _C1).T


_SKETCH = pa.schema(
    [
        (ROW, pa.int64()),
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("s1", pa.int64()),
        ("s2", pa.int64()),
        ("bands", pa.list_(pa.int64())),
    ]
)
_SKETCH_SQL = f"{ROW} long, doc_id long, n_shingles long, s1 long, s2 long, bands array<long>"


def _sketch(size: int, bands: int):
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        waiting, sets, held = [], [], 0

        def flush():
            signed = iter(signatures([s for s in sets if len(s)], bands).view(np.int64)) if held else iter(())
            rows = []
            for (row, doc), own in zip(waiting, sets):
                if len(own):
                    both = np.frombuffer(xxhash.xxh3_128_digest(own.tobytes()), np.int64)
                    rows.append((row, doc, len(own), int(both[0]), int(both[1]), next(signed)))
                else:
                    rows.append((row, doc, 0, None, None, None))
            return to_batch(rows, _SKETCH)

        for row, doc, data in rows_of(batches):
            own = shingles(data, size, known)
            waiting.append((row, doc))
            sets.append(own)
            held += len(own)
            if held > BLOCK or len(sets) >= 2000:
                yield flush()
                waiting, sets, held = [], [], 0
        if waiting:
            yield flush()

    return sketch


def _sets(size: int):
    schema = pa.schema([("node", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Words()
        rows, held = [], 0
        for node, data in rows_of(batches):
            own = shingles(data, size, known).view(np.int64)
            rows.append((node, own))
            held += len(own)
            if held > BLOCK:
                yield to_batch(rows, schema)
                rows, held = [], 0
        if rows:
            yield to_batch(rows, schema)

    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough; sizes rule out what they can first."""
    left = sets.select(F.col("node").alias("x"), F.col("shingles").alias("a"))
    right = sets.select(F.col("node").alias("y"), F.col("shingles").alias("b"))
    n, m = F.size("a"), F.size("b")
    both = F.size(F.array_intersect("a", "b"))
    return (
        pairs.join(left, "x").join(right, "y")
        .where((100 * n >= percent * m) & (100 * m >= percent * n))
        .where((100 + percent) * both >= percent * (n + m))
        .select("x", "y")
    )


def _joining(percent: int):
    schema = pa.schema([("x", pa.int64()), ("y", pa.int64())])

    def joining(rows: pa.Table) -> pa.Table:
        """Labels that some similar pair of nodes, one of each block, joins; each two labels once."""
        i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
        block, label = rows.column("block").to_numpy(), rows.column("label").to_numpy()
        lists = rows.column("shingles").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        _, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        often = np.bincount(column)
        own = often[column] > 1
        column, owner = (np.cumsum(often > 1) - 1)[column[own]], owner[own]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        place = np.full((2, len(sizes)), -1)
        place[0, left], place[1, right] = np.arange(len(left)), np.arange(len(right))
        both = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(column, kind="stable")
        column, owner = column[order], owner[order]
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
            part = slice(*np.searchsorted(column, [start, start + COLUMNS]))
            sides = []
            for side, count in enumerate((len(left), len(right))):
                matrix = np.zeros((count, COLUMNS), np.float32)
                at = place[side, owner[part]]
                matrix[at[at >= 0], column[part][at >= 0] - start] = 1
                sides.append(matrix)
            both += sides[0] @ sides[1].T
        either = sizes[left][:, None] + sizes[right][None, :] - both
        similar = (100 * both >= percent * either) & (label[left][:, None] != label[right][None, :])
        a, b = np.nonzero(similar)
        pairs = np.unique(np.sort(np.stack([label[left][a], label[right][b]], 1), 1), axis=0)
        return pa.table([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], schema=schema)

    return joining


def _merging(members: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Stored links ``x``, ``y`` between labels whose nodes share a bucket and are similar."""
    placed = members.join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least <> most")
    placed = stored(placed.join(mixed.select("key", "least"), "key"), "mixed")
    near = components(placed.select(F.col("label").alias("x"), F.col("least").alias("y")).distinct())
    near = near.select(F.col("node").alias("label"), F.col("label").alias("cluster"))
    nodes = placed.select("node", "label").distinct().join(near, "label")
    nodes = stored(nodes.join(sets, "node").select("node", "label", "cluster", "shingles"), "clusters")
    # Shingles bound the lists of a task, nodes its matrices of nodes by nodes.
    most = F.greatest(F.sum(F.size("shingles")) / BLOCK_SHINGLES, F.count("*") / BLOCK_NODES)
    blocks = nodes.groupBy("cluster").agg(F.ceil(most).cast("int").alias("blocks"))
    dealt = nodes.join(blocks, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "label", "shingles"
    )
    joined = stored(dealt.groupBy("cluster", "i", "j").applyInArrow(_joining(percent), "x long, y long"), "joined")
    discard(placed, nodes)
    return joined


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``_row, doc_id, n_shingles, component_id, kept`` of every row.

    Two rows are linked if ``100 * |both| >= percent * |either|`` for their sets of ``words``-word
    shingles. ``component_id`` is the smallest id reachable; nulls come last. Rows without words
    have empty sets and are alone. ``kept`` marks the row of the smallest id, of repeated ids the first.
    """
    bands = bands_for(percent / 100)
    rows = fixed(docs, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"))
    sketches = stored(rows.mapInArrow(_sketch(words, bands), _SKETCH_SQL), "sketches")
    # Equal sets are one node; a text that many rows repeat is banded once.
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", ROW)
    nodes = sketches.where("n_shingles > 0").groupBy("s1", "s2", "n_shingles").agg(F.min(order).alias("first"))
    nodes = stored(nodes.select("s1", "s2", "n_shingles", "first", F.col(f"first.{ROW}").alias("node")), "nodes")
    keys = sketches.select(F.col(ROW).alias("node"), "bands").join(nodes.select("node"), "node")
    keys = keys.select("node", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    members = stored(keys.join(buckets.select("key", "hub"), "key"), "members")

    inside = members.select("node").distinct()
    texts = rows.select(F.col(ROW).alias("node"), "data").join(inside, "node", "left_semi")
    sets = stored(texts.mapInArrow(_sets(words), "node long, shingles array<long>"), "sets")
    discard(rows)
    tried = stored(members.where("node <> hub").select(F.col("node").alias("x"), F.col("hub").alias("y")).distinct(), "tried")
    links = stored(_confirmed(tried, sets, percent), "links")
    labels = components(links)

    joined = _merging(members, labels, sets, percent)
    merged = components(joined)
    merged = merged.select(F.col("node").alias("label"), F.col("label").alias("top"))

    group = nodes.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    group = group.join(merged, "label", "left").withColumn("label", F.coalesce("top", "label"))
    group = stored(group.select("s1", "s2", "n_shingles", "label", "first"), "groups")
    discard(members, sets, tried, links, joined, nodes)
    heads = group.groupBy("label").agg(F.min("first").alias("head"))
    found = sketches.where("n_shingles > 0").join(group.drop("first"), ["s1", "s2", "n_shingles"]).join(heads, "label")
    alone = sketches.where("n_shingles = 0").select(
        ROW, "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")
    )
    return found.select(
        ROW, "doc_id", "n_shingles", F.col("head.doc_id").alias("component_id"), (F.col(f"head.{ROW}") == F.col(ROW)).alias("kept")
    ).unionByName(alone)
