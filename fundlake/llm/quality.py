"""Quality rules judged by an isolation forest.

Statistics of whole texts are taken in one pass. Random splits over them isolate unusual
documents on short paths. The forest grows on the good rows of a bounded labelled sample, over the
ranges of all its rows, and splits on the statistics that tell good from bad; the threshold comes
from the scores of all labelled rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, batched, rows_of, texts
from fundlake.session import stored

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
TREES = 100
#: Rows a tree grows on; the sample is bounded by SAMPLE labelled rows.
TREE_ROWS = 256
SAMPLE = 8192
BINS = 1000
#: Share of the labelled good documents that the forest's verdict may reject.
MOST_GOOD_REJECTED = 0.01
#: A statistic is split on if it ranks a bad above a good row, or below, this much oftener than chance.
LEAST_SEPARATION = 0.2

_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b"!?.,;:\"'()[]{}-_/\\=+~^@`" + SYMBOLS
_BLANKS = b" \t\n\x0b\x0c\r"

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("length", "word_length", "symbols", "marks", "upper", "digits", "dup_lines", "repeats", "distinct", "lines")


def repeat_words(found: list[bytes], size: int = WINDOW) -> int:
    """Words in windows of ``size`` words that occur twice or more in ``found``."""
    n = len(found) - size + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in found), np.int64, len(found))
    name, count = ids, len(index)
    for step in range(1, size):  # exact names of ever longer windows
        longer = name[:-1] * np.int64(len(index)) + ids[step:]
        if count * len(index) < 1 << 62 and step < size - 1 and count * len(index) ** 2 < 1 << 62:
            name, count = longer, count * len(index)
            continue
        _, name = np.unique(longer, return_inverse=True)
        count = len(longer)
    seen = np.bincount(name, minlength=1)[name] > 1
    if not seen.any():
        return 0
    edge = np.zeros(len(found) + 1, np.int64)
    edge[:n] += seen
    edge[size : size + n] -= seen
    return int((np.cumsum(edge) > 0).sum())


def statistics(data: bytes) -> tuple:
    """Base counts, then shares that the forest splits on."""
    found = data.split()
    solid = data.translate(None, _BLANKS)
    size = len(solid)
    array = np.frombuffer(solid, np.uint8)
    chars = int(((array & 0xC0) != 0x80).sum())
    symbols = size - len(solid.translate(None, SYMBOLS))
    seen: set[bytes] = set()
    dup = lines = 0
    for line in data.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    repeats = repeat_words(found)
    n = len(found)


    def share(part: int, whole: int) -> float:
        return math.log1p(100 * part / max(1, whole))

    shares = (
        math.log1p(n),
        chars / max(1, n),
        share(symbols, chars),
        share(size - len(solid.translate(None, _MARKS)), chars),
        share(size - len(solid.translate(None, _UPPER)), chars),
        share(size - len(solid.translate(None, _DIGITS)), chars),
        share(dup, lines),
        share(repeats, n),
        len(set(found)) / max(1, n) ** 0.9,
        share(lines, n),
    )
    return (n, chars, symbols, dup, repeats), shares


_STATS = pa.schema(
    [(ROW, pa.int64()), ("doc_id", pa.int64()), *((c, pa.int64()) for c in BASE), ("shares", pa.list_(pa.float64()))]
)
_STATS_SQL = f"{ROW} long, doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", shares array<double>"


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for row, doc, data in rows_of(batches):
            base, shares = statistics(data)
            yield (row, doc, *base, list(shares))

    yield from batched(rows(), _STATS)


class Forest:
    """Isolation trees as arrays; a path that ends early is extended by the expected rest.

    Trees grow on ``rows``, while cuts are drawn from the ranges ``low`` to ``high``: where these
    are wider, what lies outside the rows is isolated by the first cuts.
    """

    def __init__(self, rows: np.ndarray, low=None, high=None, trees: int = TREES, per_tree: int = TREE_ROWS, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.per_tree = max(2, min(per_tree, len(rows)))
        depth = int(np.ceil(np.log2(self.per_tree)))
        nodes = 2 ** (depth + 1) - 1
        self.depth = depth
        self.feature = np.zeros((trees, nodes), np.int32)
        self.cut = np.full((trees, nodes), np.inf)
        self.path = np.zeros((trees, nodes))
        for t in range(trees):
            own = rows[rng.choice(len(rows), self.per_tree, replace=False)]
            self._grow(t, 0, own, rows.min(0) if low is None else low, rows.max(0) if high is None else high, 0, rng)

    def _grow(self, tree: int, node: int, rows: np.ndarray, low, high, level: int, rng) -> None:
        open_ = np.flatnonzero(high > low)
        if level == self.depth or len(rows) < 2 or not len(open_):
            self.path[tree, node] = level + expected(len(rows))
            return
        f = int(rng.choice(open_))
        cut = rng.uniform(low[f], high[f])
        self.feature[tree, node], self.cut[tree, node] = f, cut
        self.path[tree, node] = -1
        side = rows[:, f] < cut
        edge = np.arange(len(low)) == f
        self._grow(tree, 2 * node + 1, rows[side], low, np.where(edge, cut, high), level + 1, rng)
        self._grow(tree, 2 * node + 2, rows[~side], np.where(edge, cut, low), high, level + 1, rng)

    @classmethod
    def separating(cls, rows: np.ndarray, good: np.ndarray) -> Forest | None:
        """A forest of the good rows on the statistics that separate the labels; on all if none does."""
        if good.sum() < 2:
            return None
        apart = np.array([abs(rank_share(rows[good, f], rows[~good, f]) - 0.5) for f in range(rows.shape[1])])
        columns = np.flatnonzero(apart >= LEAST_SEPARATION)
        columns = columns if len(columns) else np.arange(rows.shape[1])
        rows = rows[:, columns]
        forest = cls(rows[good], rows.min(0), rows.max(0))
        forest.columns = columns
        return forest

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Anomaly from 0 to 1; short mean paths are near 1."""
        total = np.zeros(len(rows))
        for feature, cut, path in zip(self.feature, self.cut, self.path):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                inner = path[node] < 0
                right = rows[np.arange(len(rows)), feature[node]] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        return 2.0 ** (-total / len(self.path) / max(1e-9, expected(self.per_tree)))


def rank_share(low: np.ndarray, high: np.ndarray) -> float:
    """Share of pairs in which the second exceeds the first, ties half; 0.5 without pairs."""
    if not len(low) or not len(high):
        return 0.5
    order = np.sort(low)
    return float((np.searchsorted(order, high, "left") + np.searchsorted(order, high, "right")).mean() / 2 / len(low))


def expected(n: int) -> float:
    """Mean path of an unsuccessful search in a tree of ``n`` rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def _score(forest: Forest | None):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(batch.schema.get_field_index("shares")).flatten().to_numpy(zero_copy_only=False)
            values = flat.reshape(batch.num_rows, len(FEATURES))
            found = forest.score(values[:, forest.columns]) if forest is not None and len(values) else np.zeros(len(values))
            columns = [batch.column(i) for i in range(batch.num_columns - 1)] + [pa.array(found)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "anomaly"])

    return score


def threshold(bins: list[tuple[int, int, int]]) -> float:
    """Best split of good from bad by score bins ``(bin, good, bad)``.

    Of the thresholds that reject at most ``MOST_GOOD_REJECTED`` of the good rows, the one that
    rejects the largest surplus of bad over good, as shares. Without bad rows nothing is rejected.
    """
    good, bad = sum(b[1] for b in bins), sum(b[2] for b in bins)
    best, at, lost, caught = 0.0, 2.0, 0, 0
    for place, g, b in sorted(bins, reverse=True):
        lost, caught = lost + g, caught + b
        gain = caught / max(1, bad) - lost / max(1, good)
        if lost <= MOST_GOOD_REJECTED * good and gain > best:
            best, at = gain, place / BINS
    return at


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Base statistics, ``base_failed``, ``anomaly`` and ``kept`` of every document.

    Null texts have no words and fail the base rules. Rows with a null or repeated id are judged
    like others. Without labelled rows no threshold can be set and the base rules alone decide.
    """
    stats = stored(texts(docs).mapInArrow(_measure, _STATS_SQL), "statistics")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    stats = stats.withColumn("base_failed", failed)
    marks = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    labelled = stats.where(~F.col("base_failed")).join(marks.agg(F.min("quality").alias("good")), "doc_id")
    sample = labelled.select("shares", "good", F.xxhash64("doc_id").alias("h"), ROW).orderBy("h", ROW).limit(SAMPLE).collect()
    forest = Forest.separating(np.array([r["shares"] for r in sample]), np.array([r["good"] == 1 for r in sample], bool))
    names = [ROW, "doc_id", *BASE, "base_failed"]
    kinds = f"{ROW} long, doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean"
    judged = labelled.select("good", "shares").mapInArrow(_score(forest), "good int, anomaly double")
    bins = (
        judged.groupBy(F.floor(F.col("anomaly") * BINS).cast("int").alias("bin"))
        .agg(F.sum(F.when(F.col("good") == 1, 1).otherwise(0)), F.sum(F.when(F.col("good") != 1, 1).otherwise(0)))
        .collect()
    )
    limit = threshold([tuple(b) for b in bins])
    scored = stats.select(*names, "shares").mapInArrow(_score(forest), kinds + ", anomaly double")
    return scored.withColumn("kept", ~F.col("base_failed") & (F.floor(F.col("anomaly") * BINS) < F.lit(limit * BINS - 0.5)))
