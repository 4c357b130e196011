"""Merkle manifest, pattern packing and source audit against brute-force versions."""

import random
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_contracts import SCHEMA, documents, empty, needs_data, odd  # noqa: F401

# --- manifest --------------------------------------------------------------------------------


def joined(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(values):
    return joined("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def levels_of(nodes):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [joined(nodes[i : i + 3]) for i in range(0, len(nodes), 3)]
        found.append(nodes)
    return found


def brute_manifest(rows, tampered):
    groups = defaultdict(list)
    for r in rows:
        text = r["text"].replace("\n", "") if r["text"] and tampered(r) else r["text"]
        head = [r["doc_id"], r["source"], r["lang"], r["n_chars"]]
        groups[r["source"]].append((r["doc_id"], leaf_of([*head, r["text"]]), leaf_of([*head, text])))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for s in order:
        groups[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {s: levels_of([x[1] for x in groups[s]]) for s in order}
    top = levels_of([trees[s][-1][0] for s in order])
    for k, s in enumerate(order):
        for i, (doc, leaf, now) in enumerate(groups[s]):
            proof = []
            for tree, at in ((trees[s], i), (top, k)):
                for nodes in tree[:-1]:
                    run, place = nodes[at - at % 3 : at - at % 3 + 3], at % 3
                    proof += run[:place] + run[place + 1 :]
                    now = joined([*run[:place], now, *run[place + 1 :]])
                    at //= 3
            yield doc, s, i, leaf, trees[s][-1][0], top[-1][0], joined(proof), now, now == top[-1][0]


def check_manifest(docs):
    from fundlake.llm.merkle import manifest

    where = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = manifest(docs, altered={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=where, with_proof=True).collect()
    names = ("id", "group", "slot", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    wanted = brute_manifest(docs.collect(), lambda r: r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0)
    assert sorted(map(str, ([r[n] for n in names] for r in found))) == sorted(map(str, map(list, wanted)))
    assert all(joined(r["proof"]) == r["proof_sha256"] for r in found)


def test_manifest_odd(odd):
    check_manifest(odd)


@needs_data
def test_manifest_documents(documents):
    check_manifest(documents)


def test_manifest_of_many_leaves_repeated_and_distant_ids(spark):
    """Several arrays a group, some with a single leaf in the last one; full, sparse and negative containers."""
    ids = [*range(2188), *range(-9000, -8000), *(i * 10**14 for i in range(50)), *[77] * 40, *[None] * 30]
    rows = [(i, None if k % 2 else f"t{k % 7}\n", "x", "hot" if k % 5 else None, k % 3, 1, "r", 2) for k, i in enumerate(ids)]
    check_manifest(spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("n", [1, 2, 3, 4, 729, 730, 2187, 2188])
def test_manifest_sizes(spark, n):
    docs = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("l").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars")
    )
    check_manifest(docs)


def test_manifest_empty(empty):
    from fundlake.llm.merkle import manifest

    assert manifest(empty).count() == 0


def test_containers_rank_like_sorting():
    from fundlake.llm.merkle import SPAN, below

    rng = random.Random(2)
    for n in (0, 1, 255, 256, 4000):
        ids = sorted(rng.sample(range(SPAN), n))
        bits = np.zeros(SPAN, bool)
        bits[ids] = True
        for data in (np.array(ids, "<u2").tobytes(), np.packbits(bits, bitorder="little").tobytes()):
            if len(data) == SPAN // 8 and n == 256:
                continue  # as many listed ids as a bit container has bytes: never written as a list
            before, times = below(data, None)
            assert before[ids].tolist() == list(range(n)) and times.sum() == n


# --- pattern packing -------------------------------------------------------------------------


def check_pattern_packing(docs, size=2048, step=16):
    from tokenizers import Tokenizer

    from fundlake.llm.patterns import pattern_packed
    from fundlake.llm.queries import vocabulary

    path = vocabulary("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    found = pattern_packed(docs, path, length=size, step=step, with_ids=True).collect()
    wanted, total = Counter(), 0
    for r in docs.collect():
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        total += len(ids)
        first = (len(ids) - 1) % size + 1
        cuts = [(0, first), *((s, size) for s in range(first, len(ids), size))]
        for piece, (start, n) in enumerate(cuts):
            wanted[r["doc_id"], piece, start, n, tuple(ids[start : start + n])] += 1
    assert wanted == Counter((r["doc_id"], r["piece"], r["start"], r["length"], tuple(r["ids"])) for r in found)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in found)
    sequences = defaultdict(list)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        end = 0
        for offset, n in sorted(pieces):
            assert offset == end
            end += n
        assert end <= size
    return len(sequences), -(-total // size)


def test_pattern_packing_odd(odd):
    check_pattern_packing(odd)
    check_pattern_packing(odd, size=64, step=4)


@needs_data
def test_pattern_packing_needs_few_sequences(documents):
    n, least = check_pattern_packing(documents)
    assert n <= 1.02 * least + 1


def test_pattern_packing_of_one_common_length(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text")).repartition(7)
    assert check_pattern_packing(docs) == (3, 3)


def test_pattern_packing_empty(empty):
    from fundlake.llm.patterns import pattern_packed
    from fundlake.llm.queries import vocabulary

    assert pattern_packed(empty, vocabulary("byte_bpe_50k.json")).count() == 0


def test_byte_ids_equal_the_tokenizers():
    from fundlake.llm.byte_tokens import ByteIds
    from fundlake.llm.queries import vocabulary

    encode = ByteIds(vocabulary("byte_bpe_50k.json"))
    rng = random.Random(8)
    units = ["a", "B", " ", "  ", "\n", "\t", "\r", "é", "日", " ", "　", "'s", "'", ".", "1", "²", "<|endoftext|>", "<|"]
    units += ["\x1c", "\x85", "​", "é", "😀", "\x00", "_", "\x0b", "﻿", " "]
    samples = ["".join(rng.choice(units) for _ in range(rng.randrange(12))) for _ in range(3000)]
    for text in [*samples, " " * 9000, "\n" * 9000 + "a", "x" * 9000, "a " * 9000]:
        assert np.frombuffer(encode.text(text.encode()), "<u4").tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_patterns_are_all_partitions():
    from fundlake.llm.patterns import patterns

    def parts(total, most, largest):
        if total == 0:
            yield ()
        elif most:
            for p in range(min(total, largest), 0, -1):
                yield from ((p, *rest) for rest in parts(total - p, most - 1, p))

    for total, most in ((1, 1), (12, 3), (20, 4)):
        rows = patterns(total, most, np.ones(total + 1, bool))
        assert sorted(tuple(p for p in r if p) for r in rows.tolist()) == sorted(parts(total, most, total))
    used = np.ones(13, bool)
    used[[1, 5]] = False
    assert not {1, 5} & set(patterns(12, 3, used).flatten().tolist())


def test_least_squares_meet_the_optimality_conditions():
    from fundlake.llm.patterns import non_negative_least_squares, patterns

    rng = np.random.default_rng(4)
    target = rng.integers(0, 90, 33).astype(float)
    target[0] = 0
    rows, weight = patterns(32, 4, target > 0), np.arange(33) / 32
    x = non_negative_least_squares(rows, target, weight)
    a = np.array([np.bincount(r[r > 0], minlength=33) for r in rows]).T * weight[:, None]
    slope = a.T @ (a @ x - target * weight)
    assert x.min() >= 0 and slope.min() > -1e-5 and abs(slope[x > 0]).max() < 1e-5


def test_plans_hold_every_length():
    from fundlake.llm.patterns import plan

    rng = np.random.default_rng(5)
    for size, step, n in ((64, 4, 500), (64, 4, 3), (256, 16, 3000)):
        histogram = np.bincount(rng.integers(1, size + 1, n), minlength=size + 1)
        held = Counter()
        for lengths, k in plan(histogram, size, step, 4):
            assert k > 0 and sum(lengths) <= size
            for length in lengths:
                held[length] += k
        assert held == Counter({i: int(k) for i, k in enumerate(histogram) if k})


# --- source audit ----------------------------------------------------------------------------


def brute_audit(rows, least, ranks=10):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, inside = defaultdict(Counter), defaultdict(Counter)
    for r in rows:
        lang, source = r["lang"] or "", r["source"] or ""
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (r["text"] or "").translate(lower))
        counts[lang, source].update(words)
        inside[lang].update(set(words))
    for lang in {g[0] for g in counts}:
        kept = {w for w, n in inside[lang].items() if n >= least}
        sources = [s for g, s in counts if g == lang]
        total = sum((counts[lang, s] for s in sources), Counter())

        def shares(c):
            n = sum(c[w] for w in kept)
            return {w: 1 + 10**9 * (c[w] + 2) // (n + 2 * len(kept)) for w in kept}

        own, all_ = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        far = lambda p, q: (p - q) ** 2 // (p + q)
        for s in sources:
            pairs = [(t, sum(far(own[s][w], own[t][w]) for w in kept)) for t in sources if t != s]
            terms = [(w, far(own[s][w], all_[w])) for w in kept if counts[lang, s][w] and own[s][w] > all_[w]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                for rank, (item, value) in enumerate(found, 1):
                    if part == "pair" or rank <= ranks:
                        yield lang, s, part, item, value, rank


def check_audit(docs, least=10):
    from fundlake.llm.divergence import audit

    found = audit(docs, least_docs=least).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(map(tuple, found.collect())) == sorted(brute_audit(docs.collect(), least))


@pytest.mark.parametrize("least", [1, 2, 10])
def test_audit_odd(odd, least):
    spread = odd.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.concat(F.lit("s"), F.col("doc_id") % 3)))
    check_audit(spread.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "x")), least)


@needs_data
def test_audit_documents(documents):
    check_audit(documents, 3)


def test_audit_of_copies_and_ties(spark):
    texts = ["Ab ab c", "c dÄ", "", None, "1 2 3", "ab c d"]
    rows = [(i, texts[i % 6], "en" if i % 4 else None, f"s{i % 7}" if i % 5 else "", 1, 1, "r", 1) for i in range(400)]
    rows += [(i, "ab c", "en", "s1", 1, 1, "r", 1) for i in range(3000)] + [(1, "", "alone", "s", 1, 1, "r", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(9)
    check_audit(docs)
    check_audit(docs, 10**6)


def test_audit_splits_hot_sums_into_blocks(spark, monkeypatch):
    from fundlake.llm import divergence

    monkeypatch.setattr(divergence, "BLOCK", 16)
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 4) for _ in range(12)), "en", f"s{rng.randrange(6)}", 1, 1, "r", 1) for i in range(200)]
    check_audit(spark.createDataFrame(rows, SCHEMA), 2)


def test_audit_is_exact_beyond_64_bits(spark):
    from fundlake.llm.divergence import _share

    big = 10**12
    row = spark.range(1).select(F.lit(big).alias("c"), F.lit(3 * big + 7).alias("n"), F.lit(11).alias("v"))
    assert row.select(_share("c", "n", "v")).first()[0] == 1 + 10**9 * (big + 2) // (3 * big + 7 + 22)


def test_audit_empty(empty):
    from fundlake.llm.divergence import audit

    assert audit(empty).count() == 0
