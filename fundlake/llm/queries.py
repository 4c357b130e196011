"""The operators over the driver tables, by name, and SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import prepared
from fundlake.llm.divergence import audit
from fundlake.llm.exact import exact_groups
from fundlake.llm.merkle import manifest
from fundlake.llm.minhash import near_duplicates
from fundlake.llm.packing import packed
from fundlake.llm.patterns import pattern_packed
from fundlake.llm.quality import quality
from fundlake.llm.sentencepieces import decoded, encoded
from fundlake.llm.shards import sharded
from fundlake.llm.spans import repeated_spans
from fundlake.llm.token_counts import context_limits, histogram
from fundlake.llm.toxicity import toxicity
from fundlake.llm.warc import archive_report

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            prepared(spark)
            return build(lambda table: spark.read.parquet(f"{folder}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def vocabulary(name: str) -> str:
    """A public vocabulary file; the package that holds them knows its place on each machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query(
    "op1_near_duplicates",
    r"""
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s
      FROM words),
    grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
      SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (
      SELECT doc_id AS x, doc_id AS y FROM documents
      UNION SELECT reach.x, links.y FROM reach JOIN links ON links.x = reach.y),
    parts AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
    SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id, component_id = sets.doc_id AS kept
    FROM sets JOIN parts ON parts.x = sets.doc_id
    """,
)
def _near(table):
    found = near_duplicates(table("documents"), words=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_sentencepiece")
def _sentencepiece(table):
    model = vocabulary("piece_bpe_32k.model")
    found = decoded(encoded(table("documents"), model), model, with_text=False)
    return found.select("doc_id", "n_tokens", "ids_crc32", "text_sha256")


@query("op3_repeated_spans")
def _spans(table):
    return repeated_spans(table("documents")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query(
    "op4_exact_duplicates",
    r"""
    WITH n AS (
      SELECT doc_id, length(coalesce(text, '')) AS size,
        regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents)
    SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
      doc_id = first_value(doc_id) OVER w AS kept, sha256(t) AS text_sha256
    FROM n WINDOW w AS (PARTITION BY t ORDER BY size DESC, doc_id)
    """,
)
def _exact(table):
    found = exact_groups(table("documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query("op5_token_counts")
def _token_counts(table):
    return context_limits(histogram(table("documents"), vocabulary("word_bpe_49k.json")))


@query(
    "op6_warc_index",
    """
    WITH p AS (
      SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
      FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND first_id <> page_id THEN first_id END AS refers_to
    FROM f
    """,
)
def _warc(table):
    return archive_report(table("pages"))


@query("op7_quality_rules")
def _quality(table):
    found = quality(table("documents"), table("labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly"
    )


@query("op8_toxicity")
def _toxicity(table):
    found = toxicity(table("documents"), table("labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


@query("op9_packing")
def _packing(table):
    return packed(table("documents"), vocabulary("word_bpe_49k.json"))


@query("op10_sharding")
def _sharding(table):
    found = sharded(table("documents"), shards=8)
    return found.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query(
    "op11_merkle_manifest",
    """
    WITH RECURSIVE docs AS (
      SELECT doc_id, source, text, replace(text, chr(10), '') AS less, coalesce(octet_length(encode(doc_id::VARCHAR))::VARCHAR || ':' || doc_id::VARCHAR, '-')
        || coalesce(octet_length(encode(source))::VARCHAR || ':' || source, '-') || coalesce(octet_length(encode(lang))::VARCHAR || ':' || lang, '-')
        || coalesce(octet_length(encode(n_chars::VARCHAR))::VARCHAR || ':' || n_chars::VARCHAR, '-') AS head,
        list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(doc_id::VARCHAR) + 1),
          lambda i: [ascii((doc_id::VARCHAR)[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
          lambda c, e: xor(xor(c, e) >> 1, 3988292384 * (xor(c, e) & 1))) AS crc
      FROM documents),
    leaves AS (
      SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS slot,
        sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) AS leaf,
        CASE WHEN crc & 1 = 1 THEN sha256(head || coalesce(octet_length(encode(less))::VARCHAR || ':' || less, '-'))
          ELSE sha256(head || coalesce(octet_length(encode(text))::VARCHAR || ':' || text, '-')) END AS altered
      FROM docs),
    nodes AS (
      SELECT source, 0 AS level, slot, leaf AS h, count(*) OVER (PARTITION BY source) AS n FROM leaves
      UNION ALL
      SELECT source, level + 1, slot // 3, sha256(string_agg(h, '' ORDER BY slot)), (max(n) + 2) // 3
      FROM nodes WHERE n > 1 GROUP BY source, level, slot // 3),
    subroots AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY encode(source) NULLS FIRST) - 1 AS slot FROM nodes WHERE n = 1),
    upper_nodes AS (
      SELECT 0 AS level, slot, subroot AS h, count(*) OVER () AS n FROM subroots
      UNION ALL
      SELECT level + 1, slot // 3, sha256(string_agg(h, '' ORDER BY slot)), (max(n) + 2) // 3
      FROM upper_nodes WHERE n > 1 GROUP BY level, slot // 3),
    lower_fold AS (
      SELECT doc_id, source, leaf, 0 AS level, slot, altered AS h, '' AS proof FROM leaves
      UNION ALL
      SELECT f.doc_id, f.source, f.leaf, f.level + 1, f.slot // 3,
        sha256(string_agg(CASE WHEN t.slot = f.slot THEN f.h ELSE t.h END, '' ORDER BY t.slot)),
        f.proof || coalesce(string_agg(CASE WHEN t.slot <> f.slot THEN t.h END, '' ORDER BY t.slot), '')
      FROM lower_fold f JOIN nodes t ON t.source IS NOT DISTINCT FROM f.source AND t.level = f.level AND t.slot // 3 = f.slot // 3
      WHERE t.n > 1 GROUP BY f.doc_id, f.source, f.leaf, f.level, f.slot, f.h, f.proof),
    upper_fold AS (
      SELECT f.doc_id, f.source, f.leaf, s.subroot, 0 AS level, s.slot, f.h, f.proof
      FROM (SELECT *, max(level) OVER (PARTITION BY doc_id) AS last FROM lower_fold) f
      JOIN subroots s ON s.source IS NOT DISTINCT FROM f.source WHERE f.level = f.last
      UNION ALL
      SELECT f.doc_id, f.source, f.leaf, f.subroot, f.level + 1, f.slot // 3,
        sha256(string_agg(CASE WHEN t.slot = f.slot THEN f.h ELSE t.h END, '' ORDER BY t.slot)),
        f.proof || coalesce(string_agg(CASE WHEN t.slot <> f.slot THEN t.h END, '' ORDER BY t.slot), '')
      FROM upper_fold f JOIN upper_nodes t ON t.level = f.level AND t.slot // 3 = f.slot // 3
      WHERE t.n > 1 GROUP BY f.doc_id, f.source, f.leaf, f.subroot, f.level, f.slot, f.h, f.proof)
    SELECT f.doc_id, f.leaf, f.subroot, r.h AS root, sha256(f.proof) AS proof_sha256, f.h AS folded_root, f.h = r.h AS verified,
      f.source, l.slot
    FROM (SELECT *, max(level) OVER (PARTITION BY doc_id) AS last FROM upper_fold) f
    JOIN (SELECT h FROM upper_nodes WHERE n = 1) r ON true JOIN leaves l ON l.doc_id = f.doc_id WHERE f.level = f.last
    """,
)
def _manifest(table):
    docs = table("documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = manifest(docs, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=tampered)
    return found.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
        F.col("group").alias("source"), "slot",
    )


@query("op12_pattern_packing")
def _pattern_packing(table):
    return pattern_packed(table("documents"), vocabulary("byte_bpe_50k.json"))


_SHARE = "1 + (1000000000::HUGEINT * ({} + 2)) // ({} + 2 * v)"


@query(
    "op13_source_divergence",
    rf"""
    WITH d AS (
      SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
      FROM documents),
    groups AS (SELECT DISTINCT lang, source FROM d),
    t AS (SELECT k, lang, source, unnest(w) AS word FROM d),
    kept AS (SELECT lang, word, count(*) AS c FROM t GROUP BY lang, word HAVING count(DISTINCT k) >= 10),
    langs AS (SELECT lang, sum(c) AS n, count(*) AS v FROM kept GROUP BY lang),
    counts AS (SELECT lang, source, word, count(*) AS c FROM t JOIN kept USING (lang, word) GROUP BY lang, source, word),
    sizes AS (SELECT g.lang, g.source, coalesce(sum(c), 0) AS n FROM groups g LEFT JOIN counts USING (lang, source) GROUP BY g.lang, g.source),
    shares AS (
      SELECT g.lang, g.source, k.word, coalesce(x.c, 0) AS c,
        {_SHARE.format("coalesce(x.c, 0)", "g.n")} AS p, {_SHARE.format("k.c", "l.n")} AS q
      FROM sizes g JOIN kept k USING (lang) JOIN langs l USING (lang) LEFT JOIN counts x USING (lang, source, word)),
    found AS (
      SELECT lang, source, 'term' AS part, word AS item, (p - q) * (p - q) // (p + q) AS value FROM shares WHERE c > 0 AND p > q
      UNION ALL
      SELECT a.lang, a.source, 'pair', b.source, coalesce(x.value, 0) FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN (
        SELECT a.lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM shares a JOIN shares b ON a.lang = b.lang AND a.word = b.word AND a.source <> b.source
        GROUP BY a.lang, a.source, b.source) x ON x.lang = a.lang AND x.source = a.source AND x.other = b.source)
    SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank
    FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
    WHERE part = 'pair' OR rank <= 10
    """,
)
def _divergence(table):
    return audit(table("documents"))
