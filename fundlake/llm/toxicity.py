"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives, all other text is unlabelled. The risk of the negative
class is estimated as the unlabelled risk less the class prior's share of the positive one; where
that estimate turns negative, its gradient is reversed. The model is a linear classifier of word
presence, fitted with numpy on bounded samples and applied to every text in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fundlake.llm.common import ROW, batched, numbered, rows_of, to_batch

#: Bounds of the training samples; rows with the smallest hashed ids are taken.
POSITIVES = 3000
UNLABELLED = 9000
#: A word counts if so many training texts have it.
LEAST_TEXTS = 3
#: ... and if its share among the positives is so many standard errors from that among the rest.
LEAST_ERRORS = 4.0
FOLDS = 5
REMEMBERED_WORDS = 100_000

#: ASCII letters to lower case, other ASCII but digits to blanks; further bytes stay.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words(data: bytes) -> set[bytes]:
    return set(data.translate(_FOLD).split())


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("positive", pa.bool_()), ("words", pa.list_(pa.int64()))])

    def rows():
        for positive, data in rows_of(batches):
            found = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words(data)), np.uint64)
            yield positive, np.sort(found).view(np.int64)

    yield from batched(rows(), schema, most=256)


class Model:
    """Weights of word hashes and an offset; picklable and bounded by the training sample."""

    def __init__(self, keys: np.ndarray, weights: np.ndarray, offset: float):
        self.keys, self.weights, self.offset = keys, weights, offset

    def weigher(self) -> dict:
        table = dict(zip(self.keys.tolist(), self.weights.tolist()))

        class Known(dict):
            def __missing__(self, word: bytes) -> float:
                if len(self) > REMEMBERED_WORDS:
                    self.clear()
                self[word] = weight = table.get(xxhash.xxh3_64_intdigest(word), 0.0)
                return weight

        return Known()

    def score(self, data: bytes, weigher: dict) -> float:
        total = self.offset + sum(map(weigher.__getitem__, words(data)))
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def fit(positives: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, rounds: int = 300, decay: float = 1e-4):
    """Non-negative PU risk with logistic loss, minimised by full-batch Adam."""
    if not positives or not unlabelled:
        return Model(np.empty(0, np.uint64), np.empty(0), -3.0)
    docs = positives + unlabelled
    keys, seen = np.unique(np.concatenate(docs), return_counts=True)
    keys = keys[seen >= LEAST_TEXTS]
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    flat = np.concatenate(docs)
    place = np.searchsorted(keys, flat)
    hit = (place < len(keys)) & (keys[np.minimum(place, len(keys) - 1)] == flat) if len(keys) else np.zeros(len(flat), bool)
    owner, place = owner[hit], place[hit]
    n_pos = len(positives)
    among = np.bincount(place[owner < n_pos], minlength=len(keys)) / n_pos
    rest = np.bincount(place[owner >= n_pos], minlength=len(keys)) / len(unlabelled)
    both = (among * n_pos + rest * len(unlabelled)) / len(docs)
    errors = np.sqrt(both * (1 - both) * (1 / n_pos + 1 / len(unlabelled))) + 1e-12
    chosen = np.abs(among - rest) >= LEAST_ERRORS * errors
    keys, renumber = keys[chosen], np.cumsum(chosen) - 1
    hit = chosen[place]
    owner, place = owner[hit], renumber[place[hit]]
    weights, offset = np.zeros(len(keys)), np.log(prior / (1 - prior))
    first, second = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)
    for step in range(1, rounds + 1):
        z = np.clip(offset + np.bincount(owner, weights[place], len(docs)), -30, 30)
        p = 1 / (1 + np.exp(-z))
        loss_if_negative = np.logaddexp(0, z)
        negative = loss_if_negative[n_pos:].mean() - prior * loss_if_negative[:n_pos].mean()
        slope = np.empty(len(docs))
        if negative >= 0:
            slope[:n_pos] = prior * ((p[:n_pos] - 1) - p[:n_pos]) / n_pos
            slope[n_pos:] = p[n_pos:] / len(unlabelled)
        else:
            slope[:n_pos] = prior * p[:n_pos] / n_pos
            slope[n_pos:] = -p[n_pos:] / len(unlabelled)
        grad = np.append(np.bincount(place, slope[owner], len(keys)) + decay * weights, slope.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad**2
        move = 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights -= move[:-1]
        offset -= move[-1]
    used = np.abs(weights) > 1e-3
    return Model(keys[used], weights[used], float(offset))


def fold(id_col: str = "doc_id"):
    """Remainder of the CRC of the id as text; remainder 0 is never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS, F.lit(0))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Fit on labels and texts of the learning folds only.

    ``positives`` and ``unlabelled`` bound the texts of the sample, whatever ids repeat: an id
    gives one text, the one with the smallest hash. The class prior counts all labels there.
    """
    known = labels.where("doc_id is not null and toxic is not null").where(fold() != 0)
    marks = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = marks.agg(F.sum("toxic").alias("toxic"), F.count("*").alias("all")).first()
    prior = min(0.5, max(0.001, (counts["toxic"] or 0) / counts["all"])) if counts["all"] else 0.05
    order = F.xxhash64("doc_id")
    positive = marks.where("toxic = 1").orderBy(order, "doc_id").limit(positives).select("doc_id", F.lit(True).alias("positive"))
    others = (
        docs.where("doc_id is not null").where(fold() != 0).select(F.col("doc_id").cast("long")).distinct()
        .orderBy(order, "doc_id").limit(unlabelled).select("doc_id", F.lit(False).alias("positive"))
    )
    wanted = positive.union(others)
    sample = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    ids = wanted.select("doc_id").distinct()
    sample = sample.join(F.broadcast(ids), "doc_id", "left_semi")  # positives + unlabelled ids at most
    sample = sample.groupBy("doc_id").agg(F.min_by("data", F.struct(F.xxhash64("data"), "data")).alias("data"))
    sample = sample.join(F.broadcast(wanted), "doc_id").select("positive", "data")
    found = sample.mapInArrow(_hashes, "positive boolean, words array<long>").toArrow()
    flags = found["positive"].to_numpy()
    texts = [np.asarray(w.values.to_numpy(zero_copy_only=False), np.int64).view(np.uint64) for w in found["words"]]
    return fit([w for w, f in zip(texts, flags) if f], [w for w, f in zip(texts, flags) if not f], prior)


def toxicity(docs: DataFrame, labels: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """``_row, doc_id, held_out, score, predicted`` for every document, and the struct ``carried`` of other columns.

    Null and empty texts get the score of a text without words. Ids may repeat or be null (never
    learnt from). Without labels every text is scored by the offset alone. Only the text is scored.
    """
    if carried:  # before a column of theirs gives way to the row number
        docs = docs.withColumn("carried", F.struct(*carried))
    docs = numbered(docs)
    model = train(docs, labels)
    rows = docs.select(
        ROW,
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold() == 0).alias("held_out"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"),
        *(["carried"] if carried else []),
    )
    schema = pa.schema(
        [(ROW, pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigher = model.weigher()

        for batch in batches:
            found = []
            for row, doc, held_out, data in rows_of(iter([batch.select([ROW, "doc_id", "held_out", "data"])])):
                value = model.score(data, weigher)
                found.append((row, doc, held_out, value, int(value >= 0.5)))
            scores = to_batch(found, schema)
            yield scores.append_column("carried", batch.column("carried")) if carried else scores

    kind = StructType.fromDDL(f"{ROW} long, doc_id long, held_out boolean, score double, predicted int")
    return rows.mapInArrow(score, kind.add(rows.schema["carried"]) if carried else kind)
