"""Removal of repeated byte spans, by suffixes sorted one bucket at a time.

A byte goes if a 50-byte string that covers it also starts in a document with a smaller id. Of
the suffix order only the first 50 bytes matter, so suffixes are compared by them.

A difference cover makes this small. Of any two suffixes, some common shift below 21 brings both
to positions of the cover (5 of 21 residues). So if 50 bytes agree, the 30-byte strings at that
shift agree too. First the cover sample alone is sorted, bucket by bucket, which ranks each
sampled string as found in one document or in several. Only a suffix with a shared cover string
in reach may repeat; only these few are sorted, again one bucket at a time: first as runs of
suffixes between two positions that the text itself marks, then those suffixes one by one whose
run no smaller document has. Tasks exchange sorted, delta-coded fingerprints, each once per task,
and get one bit back for each.

Fingerprints of the 50 bytes have 64 bits; those of the sample need few, as they only rule out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fundlake.llm.common import ROW, numbered
from fundlake.session import stored

LENGTH = 50
PERIOD = 21
#: A perfect difference set modulo 21: every shift occurs between two of its members.
COVER = (3, 6, 7, 12, 14)
SEED = LENGTH - PERIOD + 1
#: Text that one task works on at a time, and suffixes that one bucket holds, on average.
CHUNK_BYTES = 4 << 20
BUCKET_SUFFIXES = 2 << 20
#: Bits of a sample's fingerprint beyond the logarithm of their number.
SPARE_BITS = 12

#: One suffix in so many begins a run.
RUN = 64

_BLOCK = 1 << 18
_U = np.uint64


def _random(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 63, count, dtype=_U) * _U(2) + _U(1)


_BYTES = _random(256, 5)
_BASE = 0x9E3779B97F4A7C15
_POWER = np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(_BLOCK + LENGTH, _BASE, _U)]))
_INVERSE = np.multiply.accumulate(
    np.concatenate([np.ones(1, _U), np.full(_BLOCK + LENGTH, pow(_BASE, -1, 1 << 64), _U)])
)


def fingerprints(data: np.ndarray, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Start and rolling fingerprints of the ``size``-byte strings, block by block."""
    last = len(data) - size + 1
    for start in range(0, max(0, last), _BLOCK):
        part = data[start : min(len(data), start + _BLOCK + size - 1)]
        sums = np.empty(len(part) + 1, _U)
        sums[0] = 0
        np.cumsum(_BYTES[part] * _POWER[: len(part)], out=sums[1:])
        h = (sums[size:] - sums[: len(sums) - size]) * _INVERSE[: len(sums) - size]
        h ^= h >> _U(32)
        h *= _U(0xD6E8FEB86659FD93)
        h ^= h >> _U(29)
        yield start, h


def planes(values: np.ndarray) -> bytes:
    """Eight-byte numbers as byte planes, so that empty and half-empty planes compress."""
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unplanes(raw: bytes, kind=np.int64) -> np.ndarray:
    flat = pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(flat, np.uint8).reshape(8, -1).T).view(kind).ravel()


def pack(values: np.ndarray) -> bytes:
    """Sorted numbers as their differences."""
    return planes(np.diff(values, prepend=_U(0)))


def unpack(raw: bytes) -> np.ndarray:
    return np.cumsum(unplanes(raw, _U), dtype=_U)


class Chunk:
    """The texts of one chunk, without those wholly copied from a smaller id.

    A row is known by its id and text: rows alike in both have the same fate.
    """

    def __init__(self, texts: pa.Table, copies: set[tuple[int | None, bytes]]):
        self.rows = list(zip(*(texts.column(c).to_pylist() for c in (ROW, "doc_id", "data"))))
        ids = {doc for doc, _ in copies}
        self.copied = [doc in ids and (doc, hashlib.sha256(data).digest()) in copies for _, doc, data in self.rows]
        at = [i for i, r in enumerate(self.rows) if not self.copied[i] and len(r[2]) >= LENGTH]
        own = [self.rows[i] for i in at]
        self.place = {i: k for k, i in enumerate(at)}
        lengths = np.array([len(r[2]) for r in own], np.int64)
        self.starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(r[2] for r in own), np.uint8)
        top = np.iinfo(np.int64).max
        self.ids = np.array([top if r[1] is None else r[1] for r in own], np.int64)
        self.of = np.repeat(np.arange(len(own), dtype=np.int32), lengths)
        self.inside = np.arange(len(self.data), dtype=np.int32)
        self.inside -= np.repeat(self.starts.astype(np.int32), lengths)
        self.left = np.repeat(lengths.astype(np.int32), lengths)
        self.left -= self.inside

    def sample(self, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the cover and their fingerprints."""
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        at, found = [np.empty(0, np.int64)], [np.empty(0, _U)]
        for start, h in fingerprints(self.data, SEED):
            own = slice(start, start + len(h))
            hit = np.flatnonzero(cover[self.inside[own] % PERIOD] & (self.left[own] >= SEED))
            at.append(hit + start)
            found.append(h[hit] >> _U(64 - bits))
        return np.concatenate(at), np.concatenate(found)

    def suffixes(self, at: np.ndarray, shared: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions with a shared cover string in reach, and fingerprints of their 50 bytes."""
        before = np.zeros(len(self.data) + 1, np.int32)
        before[at[shared] + 1] = 1
        np.cumsum(before, out=before)
        n = max(0, len(self.data) - PERIOD + 1)
        open_ = np.zeros(len(self.data), bool)
        open_[:n] = before[PERIOD : PERIOD + n] > before[:n]
        open_ &= self.left >= LENGTH
        where, found = [np.empty(0, np.int64)], [np.empty(0, _U)]
        for start, h in fingerprints(self.data, LENGTH):
            hit = np.flatnonzero(open_[start : start + len(h)])
            where.append(hit + start)
            found.append(h[hit])
        return np.concatenate(where), np.concatenate(found)


def runs(where: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and fingerprint of the unbroken runs from one marked suffix to the next.

    Marks and fingerprints depend on the suffixes alone, so equal texts have equal runs.
    """
    begins = np.flatnonzero(prints % _U(RUN) == 0)
    if len(begins) < 2:
        return begins[:0], begins[:0], prints[:0]
    inside = np.arange(begins[0], len(prints)) - np.repeat(begins, np.diff(np.append(begins, len(prints))))
    total = np.add.reduceat(prints[begins[0] :] * _POWER[np.minimum(inside, _BLOCK)], begins - begins[0])
    total = (total ^ (total >> _U(32))) * _U(0xD6E8FEB86659FD93)
    total ^= total >> _U(29)
    length = np.diff(begins)
    whole = np.flatnonzero((np.diff(where[begins]) == length) & (length < _BLOCK))
    return begins[whole], begins[whole + 1], total[whole]


def distinct(values: np.ndarray, ids: np.ndarray):
    """Sorted distinct values, each value's place among them, and its least and greatest id."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    first = np.ones(len(ordered), bool)
    first[1:] = ordered[1:] != ordered[:-1]
    heads = np.flatnonzero(first)
    place = np.empty(len(values), np.int64)
    place[order] = np.cumsum(first) - 1
    if not len(values):
        return ordered, place, ids, ids
    own = ids[order]
    return ordered[heads], place, np.minimum.reduceat(own, heads), np.maximum.reduceat(own, heads)


def _sent(chunk: int, values: np.ndarray, bits: int, bucket_bits: int, extra) -> list[tuple]:
    """Rows for the buckets that the sorted values fall into."""
    bucket = (values >> _U(bits - bucket_bits)).astype(np.int64)
    heads = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(heads[1:], len(values))
    return [(int(bucket[a]), chunk, pack(values[a:b]), extra(a, b)) for a, b in zip(heads, ends)]


_SENT = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("values", pa.binary()), ("extra", pa.binary())])
_SENT_SQL = "bucket long, chunk long, values binary, extra binary"
_BACK = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("flags", pa.binary())])
_BACK_SQL = "chunk long, kind int, bucket long, flags binary"


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _flags(back: pa.Table, kind: int) -> np.ndarray:
    """Bits of one kind in bucket order; each entry begins with its count."""
    rows = sorted((b, f) for k, b, f in zip(*(back.column(c).to_pylist() for c in ("kind", "bucket", "flags"))) if k == kind)
    parts = [
        np.unpackbits(np.frombuffer(f, np.uint8, offset=8), count=int.from_bytes(f[:8], "little")).astype(bool) for _, f in rows
    ]
    return np.concatenate(parts) if parts else np.empty(0, bool)


def _bits(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(8, "little") + np.packbits(flags).tobytes()


def _copies(back: pa.Table) -> set[tuple[int | None, bytes]]:
    return {(b, f) for k, b, f in zip(*(back.column(c).to_pylist() for c in ("kind", "bucket", "flags"))) if k == 0}


def _number(texts: pa.Table) -> int:
    return texts.column("chunk")[0].as_py()


def _send_sample(bits: int, bucket_bits: int):
    def send(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _SENT)
        chunk = Chunk(texts, _copies(back))
        at, found = chunk.sample(bits)
        values, _, least, most = distinct(found, chunk.ids[chunk.of[at]])
        several = least != most
        return _table(_sent(_number(texts), values, bits, bucket_bits, lambda a, b: _bits(several[a:b])), _SENT)

    return send


def _rank_sample(rows: pa.Table) -> pa.Table:
    """Sort one bucket of the sample: a string is shared if several tasks or documents have it."""
    chunks, sent, extra = (rows.column(c).to_pylist() for c in ("chunk", "values", "extra"))
    own = [unpack(v) for v in sent]
    everything = np.sort(np.concatenate(own))
    shared = np.unique(everything[1:][everything[1:] == everything[:-1]])
    out = []
    for chunk, values, several, bucket in zip(chunks, own, extra, rows.column("bucket").to_pylist()):
        place = np.searchsorted(shared, values)
        flags = shared[np.minimum(place, len(shared) - 1)] == values if len(shared) else np.zeros(len(values), bool)
        flags |= np.unpackbits(np.frombuffer(several, np.uint8, offset=8), count=len(values)).astype(bool)
        out.append((chunk, 1, bucket, _bits(flags)))
    return _table(out, _BACK)


class Suffixes:
    """The suffixes of a chunk that may repeat, their runs, and what is known of them so far."""

    def __init__(self, chunk: Chunk, back: pa.Table, bits: int):
        at, found = chunk.sample(bits)
        place = distinct(found, at)[1]
        self.where, self.prints = chunk.suffixes(at, _flags(back, 1)[place])
        self.ids = chunk.ids[chunk.of[self.where]]
        self.begins, self.ends, found = runs(self.where, self.prints)
        self.run_ids = self.ids[self.begins]
        self.runs, self.run_place, self.run_least, _ = distinct(found, self.run_ids)

    def settle(self, back: pa.Table) -> None:
        """Leave only the suffixes outside the runs that a smaller id has; ``gone`` are those inside."""
        known = _flags(back, 2)[self.run_place] | (self.run_ids > self.run_least[self.run_place])
        edge = np.zeros(len(self.where) + 1, np.int32)
        edge[self.begins[known]] += 1
        np.subtract.at(edge, self.ends[known], 1)
        known = np.cumsum(edge[:-1]) > 0
        self.gone = self.where[known]
        self.where, self.prints, self.ids = self.where[~known], self.prints[~known], self.ids[~known]
        self.values, self.place, self.least, _ = distinct(self.prints, self.ids)


def _send_runs(bits: int, bucket_bits: int):
    def send(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _SENT)
        own = Suffixes(Chunk(texts, _copies(back)), back, bits)
        return _table(_sent(_number(texts), own.runs, 64, bucket_bits, lambda a, b: planes(own.run_least[a:b])), _SENT)

    return send


def _send_suffixes(bits: int, bucket_bits: int):
    def send(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not texts.num_rows:
            return _table([], _SENT)
        own = Suffixes(Chunk(texts, _copies(back)), back, bits)
        own.settle(back)
        return _table(_sent(_number(texts), own.values, 64, bucket_bits, lambda a, b: planes(own.least[a:b])), _SENT)

    return send


def _sort(kind: int):
    def sort(rows: pa.Table) -> pa.Table:
        """Sort one bucket of runs or suffixes: does a smaller id than the task's own have it?"""
        chunks, sent, extra = (rows.column(c).to_pylist() for c in ("chunk", "values", "extra"))
        own = [unpack(v) for v in sent]
        ids = [unplanes(e) for e in extra]
        _, place, least, _ = distinct(np.concatenate(own), np.concatenate(ids))
        out, at = [], 0
        for chunk, mine, bucket in zip(chunks, ids, rows.column("bucket").to_pylist()):
            out.append((chunk, kind, bucket, _bits(least[place[at : at + len(mine)]] < mine)))
            at += len(mine)
        return _table(out, _BACK)

    return sort


_RESULT = pa.schema(
    [
        (ROW, pa.int64()),
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("span_starts", pa.list_(pa.int64())),
        ("span_ends", pa.list_(pa.int64())),
        ("kept_text", pa.string()),
    ]
)
_RESULT_SQL = (
    f"{ROW} long, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, "
    "span_starts array<long>, span_ends array<long>, kept_text string"
)


def _remove(bits: int, with_text: bool):
    def remove(texts: pa.Table, back: pa.Table) -> pa.Table:
        if not texts.num_rows:  # copies only of rows that are gone: cannot be, but the schema must hold
            empty = _table([], _RESULT)
            return empty.append_column("carried", texts.column("carried")) if "carried" in texts.column_names else empty
        chunk = Chunk(texts, _copies(back))
        own = Suffixes(chunk, back, bits)
        own.settle(back)
        again = own.where[_flags(back, 3)[own.place] | (own.ids > own.least[own.place])]
        again = np.concatenate([own.gone, again])
        edge = np.zeros(len(chunk.data) + 1, np.int32)
        edge[again] += 1  # positions are distinct
        np.subtract.at(edge, again + LENGTH, 1)
        gone = np.cumsum(edge[:-1]) > 0
        rows = []
        for i, (row, doc, data) in enumerate(chunk.rows):
            n = len(data)
            starts, ends = [], []
            if chunk.copied[i]:
                starts, ends = [0], [n]
            elif i in chunk.place:
                first = int(chunk.starts[chunk.place[i]])
                edges = np.flatnonzero(np.diff(gone[first : first + n].astype(np.int8), prepend=0, append=0))
                starts, ends = edges[::2].tolist(), edges[1::2].tolist()
            left, last = [], 0
            for a, b in zip(starts, ends):
                left.append(data[last:a])
                last = b
            kept = b"".join([*left, data[last:]])
            rows.append(
                (row, doc, n, n - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), starts, ends,
                 kept.decode("utf-8", "ignore") if with_text else None)
            )
        out = _table(rows, _RESULT)
        return out.append_column("carried", texts.column("carried")) if "carried" in texts.column_names else out

    return remove


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False, carried: tuple[str, ...] = ()
) -> DataFrame:
    """Spans removed from every row: ``_row, doc_id, n_bytes, n_removed, n_spans, kept_sha256``,
    ``span_starts``, ``span_ends`` and, if asked for, ``kept_text`` (cut characters dropped) and the
    struct ``carried`` of other columns, which spares a later join with the texts.

    Texts are UTF-8 bytes, null ones empty; texts below 50 bytes keep all. A null id counts as
    larger than any other. Rows of one id never remove from each other. A text that copies that of
    a smaller id goes whole and is not compared further. Very long texts are a chunk of their own
    size. Other columns are not read, whatever their names. An empty table gives no rows. Rows
    alike in both id and text, if of 50 bytes or more, are worked on in one chunk.
    """
    if carried:  # before a column of theirs gives way to the row number
        docs = docs.withColumn("carried", F.struct(*carried))
    rows = numbered(docs).select(
        ROW,
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("data"),
        *(["carried"] if carried else []),
    )
    kind = StructType.fromDDL(_RESULT_SQL)
    kind = kind.add(rows.schema["carried"]) if carried else kind
    spark = docs.sparkSession
    # No use of these texts depends on row numbers, which another scan may deal out anew.
    facts = ("doc_id", F.octet_length("data").cast("long").alias("size"), F.unhex(F.sha2("data", 256)).alias("text"))
    sizes = stored(rows.select(*facts), "sizes")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    chunks = max(1, -(-total // CHUNK_BYTES))
    samples = max(2, total * len(COVER) // PERIOD)
    bits = min(64, samples.bit_length() + SPARE_BITS)
    bucket_bits = max(4, (samples // BUCKET_SUFFIXES).bit_length())
    # Short rows are compared with none and lie anywhere, the others where their id and text say.
    short = F.octet_length("data") < LENGTH
    number = F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).alias("chunk")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id")
    firsts = sizes.where(F.col("size") >= LENGTH).groupBy("text").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    copies = sizes.join(firsts.where("n > 1"), "text").where(
        (F.col("first.unknown") != F.col("doc_id").isNull()) | (F.col("first.doc_id") < F.col("doc_id"))
    )
    # kind 0: rows to leave out, by id and text digest in place of bucket and flags.
    copies = copies.select(number, F.lit(0).alias("kind"), F.col("doc_id").alias("bucket"), F.col("text").alias("flags"))
    copies = stored(copies.distinct(), "copies")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.withColumn("text", F.unhex(F.sha2("data", 256))).withColumn("chunk", F.when(short, F.pmod(F.col(ROW), F.lit(chunks))).otherwise(number)).drop("text")
    texts = texts.repartition(tasks, "chunk").groupBy("chunk")
    sample = texts.cogroup(copies.groupBy("chunk")).applyInArrow(_send_sample(bits, bucket_bits), _SENT_SQL)
    shared = sample.groupBy("bucket").applyInArrow(_rank_sample, _BACK_SQL)
    told = copies.union(shared)
    sent = texts.cogroup(told.groupBy("chunk")).applyInArrow(_send_runs(bits, bucket_bits), _SENT_SQL)
    told = told.union(sent.groupBy("bucket").applyInArrow(_sort(2), _BACK_SQL))
    sent = texts.cogroup(told.groupBy("chunk")).applyInArrow(_send_suffixes(bits, bucket_bits), _SENT_SQL)
    told = told.union(sent.groupBy("bucket").applyInArrow(_sort(3), _BACK_SQL))
    return texts.cogroup(told.groupBy("chunk")).applyInArrow(_remove(bits, with_text), kind)
