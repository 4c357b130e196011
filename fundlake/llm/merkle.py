"""A Merkle tree over the rows of a dataset, with a proof for every row.

A row's leaf hangs in the tree of its group, at the place of its id among the group's ids. The
places come from an index of compressed bitmaps: for each group, one container for 4,096
neighbouring ids (16-bit offsets if there are few, else bits), merged over all tasks; running
totals over the containers are the directory. The rank of an id is the container's total plus
the bits below it, so the rows themselves are never sorted.

Leaves are put into arrays by place, 729 (3^6) at a time, and a task hashes six levels of such an
array at once. The tops are the next round's leaves; the rounds grow with the logarithm of the
rows. On the way down, each array learns the siblings above it, and at last each row gets its
proof. Only digests are shuffled, never texts; nothing larger than an array is gathered.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import batched, rows_of, ship
from fundlake.operators.positions import positioned
from fundlake.session import discard, stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
FANOUT = 3
#: Levels that a task hashes at once, and the nodes these take.
LEVELS = 6
ARRAY = FANOUT**LEVELS
#: Neighbouring ids of a container; with fewer ids than this share of it they are listed.
SPAN = 4096
LISTED = SPAN // 16
#: Ids that a task holds before it passes its containers on.
HELD = 1 << 18


def digest(columns: list[Column]) -> Column:
    """SHA-256 of the values: ``-`` for null, else UTF-8 byte count, colon, value as text."""
    parts = [c.cast("string") for c in columns]
    return F.unhex(F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts]), 256))


def hashed(digests: list[bytes]) -> bytes:
    """The parent of consecutive nodes."""
    return sha256("".join([d.hex() for d in digests]).encode()).digest()


# --- index -----------------------------------------------------------------------------------

_PARTS = pa.schema([("g", pa.string()), ("hi", pa.int64()), ("low", pa.binary()), ("times", pa.binary())])
_CHUNKS = pa.schema(
    [("g", pa.string()), ("hi", pa.int64()), ("n_ids", pa.int64()), ("n_rows", pa.int64()), ("ids", pa.binary()), ("repeats", pa.binary())]
)


def _collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Group and id -> containers of the ids seen in this task, with how often each was seen."""
    held: dict = {}
    count = 0

    def release():
        for (g, hi), lows in held.items():
            low, times = np.unique(np.array(lows, "<u2"), return_counts=True)
            yield g, hi, low.tobytes(), times.astype("<i8").tobytes() if len(low) < len(lows) else None

    def parts():
        nonlocal count
        for g, i in rows_of(batches):
            hi, low = (None, 0) if i is None else divmod(i, SPAN)
            held.setdefault((g, hi), []).append(low)
            count += 1
            if count >= HELD:
                yield from release()
                held.clear()
                count = 0
        yield from release()

    return batched(parts(), _PARTS)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts, equal keys side by side -> one container a key."""

    def container(key, times):
        present = times > 0
        where = np.flatnonzero(present)
        more = np.flatnonzero(times > 1)
        ids = where.astype("<u2").tobytes() if len(where) < LISTED else np.packbits(present, bitorder="little").tobytes()
        repeats = b"".join([more.astype("<i8").tobytes(), times[more].tobytes()]) if len(more) else None
        return *key, len(where), int(times.sum()), ids, repeats

    def chunks():
        key, times = None, None
        for g, hi, low, seen in rows_of(batches):
            if (g, hi) != key:
                if key is not None:
                    yield container(key, times)
                key, times = (g, hi), np.zeros(SPAN, "<i8")
            times[np.frombuffer(low, "<u2")] += 1 if seen is None else np.frombuffer(seen, "<i8")
        if key is not None:
            yield container(key, times)

    return batched(chunks(), _CHUNKS)


def below(ids: bytes, repeats: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """For each offset of a container: rows before it, and rows at it (the popcount directory)."""
    if len(ids) == SPAN // 8:
        times = np.unpackbits(np.frombuffer(ids, np.uint8), bitorder="little").astype(np.int64)
    else:
        times = np.zeros(SPAN, np.int64)
        times[np.frombuffer(ids, "<u2")] = 1
    if repeats:
        where, often = np.frombuffer(repeats, "<i8").reshape(2, -1)
        times[where] = often
    return np.cumsum(times) - times, times


def index(keys: DataFrame) -> DataFrame:
    """Containers of ``g`` and ``id``, with ``start`` (rows of the group before) and ``total`` (rows of the group)."""
    parts = keys.mapInArrow(_collect, "g string, hi long, low binary, times binary")
    near = parts.repartition("g", "hi").sortWithinPartitions("g", "hi")
    chunks = near.mapInArrow(_merge, "g string, hi long, n_ids long, n_rows long, ids binary, repeats binary")
    order = [F.col("g"), F.asc_nulls_first("hi")]
    placed = positioned(chunks, order, "before", weight="n_rows")
    groups = placed.groupBy("g").agg(F.min("before").alias("first"), F.sum("n_rows").alias("total"))
    return placed.join(groups, "g").select("g", "hi", (F.col("before") - F.col("first")).alias("start"), "total", "n_ids", "n_rows", "ids", "repeats")


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Containers -> ids of several rows, with the slot of the first."""
    schema = pa.schema([("g", pa.string()), ("id", pa.int64()), ("slot", pa.int64()), ("total", pa.int64())])

    def ids():
        for g, hi, start, total, data, repeats in rows_of(batches):
            before, times = below(data, repeats)
            for low in np.flatnonzero(times > 1).tolist():
                yield g, None if hi is None else hi * SPAN + low, start + int(before[low]), total

    return batched(ids(), schema)


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each container, then the rows that fall into it -> rows with their slots."""

    def placed():
        before = start = total = None
        for g, _, kind, low, first, size, ids, repeats, doc, leaf, altered in rows_of(batches):
            if kind == 0:
                before, start, total = below(ids, repeats)[0], first, size
            else:
                yield g, start + int(before[low]), total, doc, leaf, altered

    return batched(placed(), _NODES, weight=lambda r: 100)


_NODES = pa.schema(
    [("g", pa.string()), ("slot", pa.int64()), ("total", pa.int64()), ("id", pa.int64()), ("leaf", pa.binary()), ("altered", pa.binary())]
)
_NODE_TYPE = "g string, slot long, total long, id long, leaf binary, altered binary"


def slots(leaves: DataFrame, chunks: DataFrame) -> DataFrame:
    """Leaves (``g``, ``id``, ``leaf``, ``altered``) with their places in their groups.

    Rows that share a group and an id follow each other by leaf. They take the way of a sorted
    order, which spreads over tasks however many there are; all others are ranked.
    """
    single, shared = leaves, None
    if not chunks.where("repeats IS NOT NULL").isEmpty():
        given = chunks.where("repeats IS NOT NULL").select("g", "hi", "start", "total", "ids", "repeats")
        again = stored(given.mapInArrow(_repeated, "g string, id long, slot long, total long"), "repeated")
        leaves = stored(leaves.withColumn("tie", F.monotonically_increasing_id()), "leaves", compression="zstd")
        known = again.select(F.col("g").alias("g2"), F.col("id").alias("id2"), F.col("slot").alias("first"), "total")
        same = (F.col("g") == F.col("g2")) & F.col("id").eqNullSafe(F.col("id2"))
        single = leaves.join(known, same, "left_anti").drop("tie")
        order = [F.col("g"), F.asc_nulls_first("id"), F.col("leaf"), F.col("tie")]
        ranked = positioned(leaves.join(known, same).drop("g2", "id2"), order, "place")
        starts = ranked.groupBy(F.col("g").alias("g2"), F.col("id").alias("id2")).agg(F.min("place").alias("least"))
        shared = ranked.join(starts, same).select(
            "g", (F.col("first") + F.col("place") - F.col("least")).alias("slot"), "total", "id", "leaf", "altered"
        )
    none = [F.lit(None).cast(t).alias(n) for n, t in (("id", "long"), ("leaf", "binary"), ("altered", "binary"))]
    rulers = chunks.select("g", "hi", F.lit(0).alias("kind"), F.lit(0).alias("low"), "start", "total", "ids", "repeats", *none)
    none = [F.lit(None).cast(t).alias(n) for n, t in (("start", "long"), ("total", "long"), ("ids", "binary"), ("repeats", "binary"))]
    low = F.coalesce(F.col("id").bitwiseAND(SPAN - 1), F.lit(0)).cast("int").alias("low")
    hi = F.shiftright("id", SPAN.bit_length() - 1).alias("hi")
    rows = single.select("g", hi, F.lit(1).alias("kind"), low, *none, "id", "leaf", "altered")
    near = rulers.union(rows).repartition("g", "hi").sortWithinPartitions("g", "hi", "kind")
    found = near.mapInArrow(_rank, _NODE_TYPE)
    return found if shared is None else found.union(shared)


# --- tree ------------------------------------------------------------------------------------

_BLOCK_TYPE = "g string, slot long, total long, altered binary, n int, top binary, ids binary, leaves binary"


def levels(nodes: list[bytes], total: int) -> list[list[bytes]]:
    """The levels of an array, bottom first: down to one node if it is the whole group, else ``LEVELS`` steps."""
    found = [nodes]
    while len(nodes) > 1 if total <= ARRAY else len(found) <= LEVELS:
        nodes = [hashed(nodes[i : i + FANOUT]) for i in range(0, len(nodes), FANOUT)]
        found.append(nodes)
    return found


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes, those of an array side by side in any order -> arrays with their top node."""
    schema = pa.schema(
        [
            ("g", pa.string()), ("slot", pa.int64()), ("total", pa.int64()), ("altered", pa.binary()),
            ("n", pa.int32()), ("top", pa.binary()), ("ids", pa.binary()), ("leaves", pa.binary()),
        ]
    )

    def array(key, total, held):
        n = min(ARRAY, total - key[1] * ARRAY)
        leaves, ids, altered = [b""] * n, np.zeros((2, n), "<i8"), [b""] * n
        for slot, i, leaf, other in held:
            at = slot - key[1] * ARRAY
            leaves[at] = leaf
            ids[:, at] = (0, 0) if i is None else (1, i)
            altered[at] = b"\0" * 33 if other is None else b"\1" + other
        changed = b"".join(altered) if any(a[0] for a in altered) else None
        return *key, total, changed, n, levels(leaves, total)[-1][0], ids.tobytes(), b"".join(leaves)

    def arrays():
        key, size, held = None, 0, []
        for g, slot, total, i, leaf, other in rows_of(batches):
            if (g, slot // ARRAY) != key:
                if key is not None:
                    yield array(key, size, held)
                key, size, held = (g, slot // ARRAY), total, []
            held.append((slot, i, leaf, other))
        if key is not None:
            yield array(key, size, held)

    return batched(arrays(), schema, weight=lambda r: 50 * r[4])


def _rounds(nodes: DataFrame) -> list[DataFrame]:
    """Tables of arrays, round by round, until each group is down to one node."""
    found: list[DataFrame] = []
    while True:
        near = nodes.withColumn("array", F.expr(f"slot div {ARRAY}")).repartition("g", "array").sortWithinPartitions("g", "array")
        table = stored(near.drop("array").mapInArrow(_arrays, _BLOCK_TYPE), "arrays", compression="zstd")
        found.append(table)
        if table.where(F.col("total") > ARRAY).isEmpty():
            return found
        none = [F.lit(None).cast(t).alias(n) for n, t in (("id", "long"), ("altered", "binary"))]
        total = F.expr(f"(total + {ARRAY - 1}) div {ARRAY}").alias("total")
        nodes = table.select("g", "slot", total, none[0], F.col("top").alias("leaf"), none[1])


def _inner(nodes: bytes, total: int) -> tuple[list[list[bytes]], int]:
    leaves = [nodes[i : i + 32] for i in range(0, len(nodes), 32)]
    return levels(leaves, total), len(leaves)


def siblings(tree: list[list[bytes]], at: int) -> bytes:
    """Of one leaf, level by level: its place in its run, the number of siblings, the siblings."""
    out = []
    for nodes in tree[:-1]:
        first, place = at - at % FANOUT, at % FANOUT
        run = nodes[first : first + FANOUT]
        out += [bytes((place, len(run) - 1)), *run[:place], *run[place + 1 :]]
        at //= FANOUT
    return b"".join(out)


def steps(path: bytes) -> list[tuple[int, list[bytes]]]:
    """A path of ``siblings`` taken apart."""
    found, i = [], 0
    while i < len(path):
        place, n = path[i], path[i + 1]
        found.append((place, [path[i + 2 + 32 * k : i + 34 + 32 * k] for k in range(n)]))
        i += 2 + 32 * n
    return found


def folded(leaf: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    """The root that a leaf and its siblings give."""
    for place, others in path:
        leaf = hashed([*others[:place], leaf, *others[place:]])
    return leaf


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrays with the path above them -> the same for each of their nodes."""
    schema = pa.schema([("g", pa.string()), ("slot", pa.int64()), ("above", pa.binary()), ("subroot", pa.binary()), ("root", pa.binary())])

    def nodes():
        for g, slot, total, leaves, above, subroot, root in rows_of(batches):
            tree, n = _inner(leaves, total)
            for at in range(n):
                yield g, slot * ARRAY + at, siblings(tree, at) + above, subroot, root

    return batched(nodes(), schema, weight=lambda r: 200 + len(r[2]))


def _prove(with_proof: bool):
    fields = [("g", pa.string()), ("slot", pa.int64()), ("id", pa.int64())]
    fields += [(n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", pa.bool_())]
    schema = pa.schema(fields + [("proof", pa.list_(pa.string()))] * with_proof)

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for g, slot, total, altered, ids, leaves, above, subroot, root in rows_of(batches):
                tree, n = _inner(leaves, total)
                known, numbers = np.frombuffer(ids, "<i8").reshape(2, -1).tolist()
                upper = steps(above)
                for at in range(n):
                    leaf = tree[0][at]
                    start = altered[33 * at + 1 : 33 * at + 33] if altered and altered[33 * at] else leaf
                    path = steps(siblings(tree, at)) + upper
                    proof = [d.hex() for _, others in path for d in others]
                    end = folded(start, path)
                    row = (
                        g, slot * ARRAY + at, numbers[at] if known[at] else None, leaf.hex(), subroot.hex(), root.hex(),
                        sha256("".join(proof).encode()).hexdigest(), end.hex(), end == root,
                    )
                    yield (*row, proof) if with_proof else row

        return batched(rows(), schema, most=1024)

    return prove


_PROOF_TYPE = (
    "g string, slot long, id long, leaf string, subroot string, root string, "
    "proof_sha256 string, folded_root string, verified boolean"
)


def manifest(
    docs: DataFrame,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "source",
    altered: dict[str, Column] | None = None,
    where: Column | None = None,
    with_proof: bool = False,
) -> DataFrame:
    """One row per input row: ``id``, ``group``, ``slot``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``.

    A leaf hashes ``columns``; in its group, leaves ascend by id (null first); the roots of the
    groups ascend by their names' bytes (null first) below the root. ``proof_sha256`` hashes the
    leaf's siblings, bottom up and left to right; ``with_proof`` adds them as ``proof``.

    ``altered`` gives columns other values in the rows ``where`` holds, as a check of tampering:
    ``folded_root`` is what such a leaf, else the leaf itself, and the original siblings give, and
    ``verified`` says whether that is the root.

    Null values have a leaf of their own form, and a null group or id comes first. Rows that share
    group and id follow each other by leaf; equal rows take neighbouring slots in any order. An
    empty text is not null. Texts of any length are hashed where they are read. Columns that are
    not named are not read, whatever their names. An empty table gives no rows, and no root.
    """
    spark = docs.sparkSession
    ship(spark)
    group = F.when(F.col(group_col).isNull(), "").otherwise(F.concat(F.lit("="), F.col(group_col).cast("string"))).alias("g")
    chunks = stored(index(docs.select(group, F.col(id_col).cast("long").alias("id"))), "containers", compression="zstd")
    leaf = digest([F.col(c) for c in columns])
    other = F.lit(None).cast("binary")
    if altered:
        changed = digest([altered.get(c, F.col(c)) for c in columns])
        other = changed if where is None else F.when(where, changed)
    leaves = docs.select(group, F.col(id_col).cast("long").alias("id"), leaf.alias("leaf"), other.alias("altered"))
    rounds = _rounds(slots(leaves, chunks))
    discard(chunks)
    roots = rounds[-1].select("g", F.col("top").alias("subroot"))
    order = positioned(roots, [F.col("g")], "slot")
    total = order.count()
    none = [F.lit(None).cast(t).alias(n) for n, t in (("id", "long"), ("altered", "binary"))]
    above = _rounds(order.select(F.lit("").alias("g"), "slot", F.lit(total).cast("long").alias("total"), none[0], F.col("subroot").alias("leaf"), none[1]))
    down = above[-1].select("g", "slot", F.lit(b"").alias("above"), F.lit(b"").alias("subroot"), F.col("top").alias("root"))
    context = "g string, slot long, above binary, subroot binary, root binary"
    for table in reversed(above):
        inner = table.select("g", "slot", "total", "leaves").join(down, ["g", "slot"])
        down = inner.mapInArrow(_descend, context)
    named = order.join(down.select("slot", "above", "root"), "slot")
    down = named.select("g", F.lit(0).cast("long").alias("slot"), "above", "subroot", "root")
    for table in reversed(rounds[1:]):
        inner = table.select("g", "slot", "total", "leaves").join(down, ["g", "slot"])
        down = inner.mapInArrow(_descend, context)
    given = rounds[0].select("g", "slot", "total", "altered", "ids", "leaves").join(down, ["g", "slot"])
    found = given.mapInArrow(_prove(with_proof), _PROOF_TYPE + ", proof array<string>" * with_proof)
    return found.withColumn("group", F.when(F.col("g") != "", F.substring("g", 2, 1 << 30))).drop("g")
