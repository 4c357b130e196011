"""A corpus pipeline of five stages; each reads what its predecessor wrote.

Toxic documents go, of equal texts one stays, of near-duplicates one stays, spans repeated from
an earlier document are cut, and what is left is packed into sequences.

A stage's result reads tables that the stage has stored. Stages run one after the other, each
result written before the next stage begins, so a stage first removes the tables of the one before.
All stages keep repeated rows apart, take null ids, texts and other columns as they come, cut no
text to look at it, keep columns whatever their names, and give no rows for an empty table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import ROW, fixed, prepared
from fundlake.llm.exact import exact_groups
from fundlake.llm.minhash import near_duplicates
from fundlake.llm.packing import packed
from fundlake.llm.queries import vocabulary
from fundlake.llm.spans import repeated_spans
from fundlake.llm.toxicity import toxicity
from fundlake.session import discard, noted, stored

ORACLE_SQL = None

#: Tables that the last stage of a session has left.
_LEFT: dict[SparkSession, list[DataFrame]] = {}


def _stage(build: Callable[[SparkSession, DataFrame, str], DataFrame]):
    @wraps(build)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        discard(*_LEFT.pop(spark, []))
        prepared(spark)
        with noted() as tables:
            result = build(spark, docs, sf_dir)
        _LEFT[spark] = tables
        return result

    return run_stage


def _deciding(docs: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The documents that ``rule`` marks as ``kept``; columns are numbered meanwhile, so that no name clashes."""
    names = docs.columns
    table = fixed(docs.toDF(*[f"c{i}" for i in range(len(names))]))
    known = {name: F.col(f"c{names.index(name)}").alias(name) for name in ("doc_id", "text")}
    kept = rule(table.select(ROW, *known.values())).where("kept").select(ROW)
    return table.join(kept, ROW, "left_semi").drop(ROW).toDF(*names)


@_stage
def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below one half; a null or empty text has that of no words."""
    scores = toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), carried=tuple(docs.columns))
    return scores.where("predicted = 0").select("carried.*")


@_stage
def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each white-space-free text, the longest; all empty and null texts are one group."""
    return _deciding(docs, exact_groups)


@_stage
def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, of the smallest id, of each group of near-duplicates; texts without words are in none."""
    return _deciding(docs, lambda rows: near_duplicates(rows, words=5, percent=80))


@_stage
def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the spans; ``n_chars`` follows. A document that loses nothing is left as it is."""
    names = docs.columns
    others = [c for c in names if c != "text"]
    known = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col("text").isNull().alias("without"))
    given = docs.select("doc_id", "text", known.alias("known"))
    cut = repeated_spans(given, with_text=True, carried=("known",))
    kept = {c: F.col(f"carried.known.c{i}").alias(c) for i, c in enumerate(others)}
    kept["text"] = F.when(~F.col("carried.known.without"), F.col("kept_text")).alias("text")
    if "n_chars" in names:
        own = F.col(f"carried.known.c{others.index('n_chars')}")
        size = F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(own)
        kept["n_chars"] = size.cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return cut.select(*[kept[c] for c in names])


@_stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences; a null or empty text is one token."""
    return packed(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("exact_dedup", remove_copies),
    ("near_dedup", remove_near_copies),
    ("span_dedup", cut_repeated_spans),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
