"""Exact token counts for every context limit from a histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fundlake.llm.common import rows_of, texts
from fundlake.llm.tokens import word_ids


def _lengths(path: str):
    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = word_ids(path)
        for batch in batches:
            found = [len(ids.text(data)) // 4 for _, _, data in rows_of(iter([batch]))]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["n_tokens"])

    return lengths


def histogram(docs: DataFrame, tokenizer: str, text_col: str = "text") -> DataFrame:
    """``n_tokens``, ``n_docs``; null and empty texts have length 0."""
    docs = docs.select(F.lit(None).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return texts(docs).mapInArrow(_lengths(tokenizer), "n_tokens long").groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def context_limits(lengths: DataFrame) -> DataFrame:
    """What each length, taken as a context limit, keeps and cuts.

    The suffix sums ``docs_beyond`` and ``tokens_beyond`` give, for any limit up to the next
    length: all tokens kept, ``tokens_up_to + docs_beyond * limit``; the share of documents not
    cut. One task sums the histogram, which has a row per distinct length, never one per document.
    """
    up = Window.orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    beyond = Window.orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    tokens = F.col("n_tokens") * F.col("n_docs")
    rows = lengths.select(
        "n_tokens",
        "n_docs",
        F.sum("n_docs").over(up).alias("docs_up_to"),
        F.sum(tokens).over(up).alias("tokens_up_to"),
        F.coalesce(F.sum("n_docs").over(beyond), F.lit(0)).alias("docs_beyond"),
        F.coalesce(F.sum(tokens).over(beyond), F.lit(0)).alias("tokens_beyond"),
    )
    kept = F.col("docs_beyond") * F.col("n_tokens")
    return rows.withColumns(
        {
            "tokens_kept": F.col("tokens_up_to") + kept,
            "tokens_cut": F.col("tokens_beyond") - kept,
            "quantile": F.col("docs_up_to") / (F.col("docs_up_to") + F.col("docs_beyond")),
        }
    )
