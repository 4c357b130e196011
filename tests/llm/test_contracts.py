"""Each operator against a brute-force version, on odd rows and on the smallest tables."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries

FOLDER = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")
BLANKS = b" \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, row string, node int"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, columns with names used inside."""
    rng = random.Random(3)
    words = ["alpha", "Beta", "gämma", "δelta", "e,", "f!", "77", "#x", "日本", "á"]
    base = [" ".join(rng.choice(words) + str(rng.randrange(400)) for _ in range(120)) for _ in range(12)]
    texts = [*base, None, "", " \t\n", "one", "one", "two words", "x" * 49, "y" * 50, "y" * 50, "y" * 51]
    texts += [base[0], base[0].replace(" ", "\n"), base[0] + "  ", base[1][:400] + base[2][:300], "z" + base[3], base[4][1:]]
    texts += [t.replace(t.split()[60], "changed") for t in base[5:9]]
    texts += [" ".join(rng.choice(words) for _ in range(9000)), "line a b\nline a b\n\nline c", "very " * 40]
    rows = [(i, t, None, None, None, 1, "r", 2) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base[0], "x", "y", 1, 1, "r", 2), (None, None, None, None, None, None, None, None)]
    rng.shuffle(rows)
    path = spark.conf.get("spark.sql.warehouse.dir") + f"/odd-{os.getpid()}"
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")


def numbered_rows(docs):
    from fundlake.llm.common import ROW, numbered

    return {r[ROW]: r for r in numbered(docs).collect()}


def by_row(df):
    return {r["_row"]: r for r in df.collect()}


def last(value):
    return (value is None, value or 0)


# --- exact -----------------------------------------------------------------------------------


def check_exact(docs, **options):
    from fundlake.llm.exact import exact_groups

    rows, got = numbered_rows(docs), by_row(exact_groups(docs, **options))
    assert set(rows) == set(got)
    groups = defaultdict(list)
    for k, r in rows.items():
        groups[(r["text"] or "").encode().translate(None, BLANKS)].append(k)
    for text, members in groups.items():
        best = min(members, key=lambda k: (-len(rows[k]["text"] or ""), last(rows[k]["doc_id"]), k))
        for k in members:
            g = got[k]
            assert g["keep_id"] == rows[best]["doc_id"] and g["group_size"] == len(members)
            assert g["kept"] == (k == best) and g["text_sha256"] == hashlib.sha256(text).hexdigest()


@pytest.mark.parametrize("block", [4096, 16])
def test_exact_odd(odd, block):
    check_exact(odd, block_bytes=block)


def test_exact_names_do_not_collide_in_halves(spark):
    texts = ["ab" * 8, "ba" * 8, "a" * 16, "b" * 16, "aabb" * 4, "bbaa" * 4, "ab" * 8 + "a", "ab" * 4]
    docs = spark.createDataFrame(list(enumerate(texts * 2)), "doc_id long, text string")
    check_exact(docs, block_bytes=2)


# --- near duplicates -------------------------------------------------------------------------


def shingle_set(text, k):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = lower.split()
    return {tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set()


def check_near(docs, k, percent):
    from fundlake.llm.minhash import near_duplicates

    rows, got = numbered_rows(docs), by_row(near_duplicates(docs, words=k, percent=percent))
    assert set(rows) == set(got)
    keys = list(rows)
    sets = {r: shingle_set(rows[r]["text"], k) for r in keys}
    parent = {r: r for r in keys}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    owners = defaultdict(list)
    for r in keys:
        for s in sets[r]:
            owners[s].append(r)
    shared = Counter()
    for own in owners.values():
        for i, a in enumerate(own):
            for b in own[i + 1 :]:
                shared[a, b] += 1
    for (a, b), n in shared.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            parent[root(a)] = root(b)
    groups = defaultdict(list)
    for r in keys:
        groups[root(r)].append(r)
    for members in groups.values():
        best = min(members, key=lambda r: (last(rows[r]["doc_id"]), r))
        for r in members:
            assert got[r]["n_shingles"] == len(sets[r])
            assert got[r]["component_id"] == rows[best]["doc_id"]
            assert got[r]["kept"] == (r == best)


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_near_odd(odd, k, percent):
    check_near(odd, k, percent)


@needs_data
def test_near_documents(documents):
    check_near(documents, 3, 85)


def test_near_chain_and_star(spark):
    """Neighbours are similar, ends are not: all of a chain is one component."""
    words = [f"w{i}" for i in range(400)]
    chain = [" ".join(words[i * 4 : i * 4 + 120]) for i in range(30)]
    docs = spark.createDataFrame(list(enumerate(chain)), "doc_id long, text string")
    check_near(docs, 3, 85)


def test_near_edits_of_one_text_in_many_blocks(spark, monkeypatch):
    """Edits are near the original or near each other only; the original itself is edited too."""
    from fundlake.llm import minhash

    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    rng = random.Random(8)
    source = [f"w{i}" for i in range(150)]
    texts = []
    for _ in range(120):
        words = list(rng.choice([source, texts[-1].split() if texts and rng.random() < 0.2 else source]))
        for _ in range(rng.randrange(1, 7)):
            words[rng.randrange(150)] = f"x{rng.randrange(900)}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check_near(docs, 3, 85)


def test_near_blocks_of_short_variants_are_bounded(spark, monkeypatch):
    """Thousands of texts share most of a template but are not similar; a few are."""
    from fundlake.llm import minhash

    real = minhash._joining

    def watched(percent):
        joining = real(percent)

        def watch(rows):
            block = rows.column("block").to_pylist()
            assert max(block.count(b) for b in set(block)) < 2500
            return joining(rows)

        return watch

    monkeypatch.setattr(minhash, "_joining", watched)
    words = [f"w{i}" for i in range(20)]
    texts = [" ".join([*words[:10], f"x{i}", *words[10:]]) for i in range(5000)]
    texts += [f"{t} end" for t in texts[::500]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(docs, words=3, percent=85).collect()}
    assert got == {i: i if i < 5000 else (i - 5000) * 500 for i in range(len(texts))}


def test_values_are_minima_and_maxima_of_the_same_hashes():
    from fundlake.llm.minhash import BAND_ROWS, bands_for, signatures

    rng = np.random.default_rng(0)
    a, b = (np.unique(rng.integers(0, 1 << 63, 2000, dtype=np.uint64)) for _ in range(2))
    both = signatures([a, np.unique(np.concatenate([a, b[:150]])), b], 64)
    assert (both[0] == both[1]).mean() > 0.5 and not (both[0] == both[2]).any()
    assert (1 - 0.85**BAND_ROWS) ** bands_for(0.85) <= 1e-8


# --- spans -----------------------------------------------------------------------------------


def check_spans(docs):
    from fundlake.llm.spans import repeated_spans

    rows, got = numbered_rows(docs), by_row(repeated_spans(docs, with_text=True))
    assert set(rows) == set(got)
    top = 1 << 63
    first = {}
    data = {r: (v["text"] or "").encode() for r, v in rows.items()}
    ids = {r: top if v["doc_id"] is None else v["doc_id"] for r, v in rows.items()}
    for r, d in data.items():
        for i in range(len(d) - 49):
            g = d[i : i + 50]
            first[g] = min(first.get(g, top), ids[r])
    for r, d in data.items():
        gone = np.zeros(len(d) + 1, bool)
        for i in range(len(d) - 49):
            if first[d[i : i + 50]] < ids[r]:
                gone[i : i + 50] = True
        spans = int((np.diff(gone.astype(int), prepend=0) > 0).sum())
        kept = bytes(b for b, g in zip(d, gone) if not g)
        g = got[r]
        assert (g["n_bytes"], g["n_removed"], g["n_spans"]) == (len(d), int(gone.sum()), spans), r
        assert g["kept_sha256"] == hashlib.sha256(kept).hexdigest()
        assert g["kept_text"] == kept.decode("utf-8", "ignore")


def test_spans_odd(odd):
    check_spans(odd)


def test_spans_small_chunks_and_periods(spark, monkeypatch):
    """Many tasks, texts of one repeated character, matches of just 49 and 50 bytes."""
    from fundlake.llm import spans

    monkeypatch.setattr(spans, "CHUNK_BYTES", 300)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choice("abcdefg") for _ in range(n))
    p49, p50, p80 = word(49), word(50), word(80)
    texts = [word(60) + p + word(rng.randrange(70)) for p in (p49, p50, p80) for _ in range(3)]
    texts += ["a" * n for n in (49, 50, 51, 200)] + ["ab" * 60, "b" + "ab" * 40, p80 + p80, word(31) + p80[3:60]]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    check_spans(docs)


@needs_data
def test_spans_documents(documents):
    check_spans(documents.where("doc_id < 100"))


def test_every_shift_brings_two_positions_to_the_cover():
    from fundlake.llm.spans import COVER, PERIOD

    for a in range(PERIOD):
        for b in range(PERIOD):
            assert any((a + s) % PERIOD in COVER and (b + s) % PERIOD in COVER for s in range(PERIOD))


# --- packing ---------------------------------------------------------------------------------


def check_packing(docs):
    from tokenizers import Tokenizer

    from fundlake.llm.packing import packed
    from fundlake.llm.queries import vocabulary

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    pieces = packed(docs, path, window=20_000, with_ids=True).collect()
    wanted = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [1]
        wanted[r["doc_id"], tuple(ids)] += 1
    sequences, of_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p["ids"]) == p["length"] and p["length"] > 0
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
        of_doc[p["doc_id"], p["doc_tokens"]].append((p["start"], tuple(p["ids"])))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    for (doc, tokens), own in of_doc.items():
        copies = sum(n for (d, ids), n in wanted.items() if d == doc and len(ids) == tokens)
        assert sum(len(i) for _, i in own) == tokens * copies
        if copies == 1:
            (ids,) = [ids for d, ids in wanted if d == doc and len(ids) == tokens]
            assert sum((i for _, i in sorted(own)), ()) == ids
    assert {(d, len(i)) for d, i in wanted} == set(of_doc)
    total = sum(p["length"] for p in pieces)
    return sum(2048 for _ in sequences) - total, docs.rdd.getNumPartitions()


def test_packing_odd(odd):
    padding, tasks = check_packing(odd)
    assert padding <= 2048 * tasks


@needs_data
def test_packing_documents(documents):
    padding, tasks = check_packing(documents)
    assert padding <= 2048 * tasks


def test_pieces_go_to_the_cheapest_sequence_with_room():
    from fundlake.llm.packing import assign

    placed, rest = assign([6, 5, 4, 3, 2], 2, 10)
    assert [(p[0], p[3]) for p in placed] == [(0, 0), (1, 1), (2, 1), (3, 0), (4, 1), (4, 0)]
    assert not rest and assign([7, 7], 1, 10)[1] == [(1, 3, 4)]


# --- shards ----------------------------------------------------------------------------------


def check_shards(docs, shards=8):
    from fundlake.llm.shards import sharded

    rows, got = numbered_rows(docs), by_row(sharded(docs, shards))
    assert set(rows) == set(got)
    slots, load, of_text = defaultdict(list), Counter(), defaultdict(set)
    for k, r in rows.items():
        data = (r["text"] or "").encode()
        g = got[k]
        assert g["size"] == len(data) + 1 and g["text_crc32"] == zlib.crc32(data)
        slots[g["shard"]].append(g["slot"])
        load[g["shard"]] += g["size"]
        of_text[data].add(g["shard"])
    for own in slots.values():
        assert sorted(own) == list(range(len(own)))
    assert set(slots) <= set(range(shards))
    return load, of_text


def test_shards_odd(odd):
    check_shards(odd)


@needs_data
def test_shards_documents(documents):
    load, of_text = check_shards(documents)
    assert all(len(s) == 1 for s in of_text.values())
    mean = sum(load.values()) / 8
    assert all(abs(load[s] - mean) < 0.03 * mean for s in range(8)), load


def test_a_group_larger_than_a_shard_is_dealt(spark):
    texts = ["h" * 99] * 4000 + [f"{i}" * 20 for i in range(2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    load, of_text = check_shards(docs)
    assert max(load.values()) < 1.05 * min(load.values()), load
    assert len(of_text[b"h" * 99]) > 1


def test_the_tree_finds_the_tightest_bin():
    from fundlake.llm.shards import Capacities

    rng = random.Random(1)
    tree, plain = Capacities(), []
    for step in range(3000):
        if plain and rng.random() < 0.45:
            key = plain.pop(rng.randrange(len(plain)))
            tree.remove(key)
        else:
            key = (rng.randrange(500), step)
            plain.append(key)
            tree.add(key)
        size = rng.randrange(520)
        assert tree.tightest(size) == min((k for k in plain if k[0] >= size), default=None)


# --- archives --------------------------------------------------------------------------------


def test_archives_odd(spark):
    from fundlake.llm.warc import archive_report

    long_ = "<p>ä</p>" * 40
    html = [long_, long_, None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "a\r\n\r\nb" * 30, "WARC/1.1\r\n" * 20, "z" * 300_000]
    rows = [(9 - i, f"http://a/{i}", h, 1) for i, h in enumerate(html)]
    rows += [rows[0], (None, None, long_, None), (None, "u\r\nX-Page: 5", None, None)]
    path = spark.conf.get("spark.sql.warehouse.dir") + f"/pages-{os.getpid()}"
    spark.createDataFrame(rows, "page_id long, url string, html string, record int").repartition(2).write.mode("overwrite").parquet(path)
    pages = spark.read.parquet(path)
    got = archive_report(pages).collect()
    assert len(got) == len(rows)
    first = {}
    for i, _, h, _ in rows:
        if len((h or "").encode()) >= 100:
            first[h] = min(first.get(h, (True, 0)), last(i))
    wanted = Counter()
    for i, _, h, _ in rows:
        data = (h or "").encode()
        wanted[i, len(data), hashlib.sha256(data).hexdigest()] += 1
    assert Counter((g["page_id"], g["payload_bytes"], g["payload_digest"]) for g in got) == wanted
    responses = Counter(g["payload_digest"] for g in got if g["record_type"] == "response")
    for h, (_, i) in first.items():
        assert responses[hashlib.sha256(h.encode()).hexdigest()] == 1
    for g in got:
        if g["record_type"] == "revisit":
            assert g["payload_bytes"] >= 100
            assert hashlib.sha256({h: h for h in first}[next(h for h in first if hashlib.sha256(h.encode()).hexdigest() == g["payload_digest"])].encode()).hexdigest()
            assert g["refers_to"] == first[next(h for h in first if hashlib.sha256(h.encode()).hexdigest() == g["payload_digest"])][1]
        else:
            assert g["refers_to"] is None


def test_selected_records_are_read_by_their_ranges(spark):
    from fundlake.llm.warc import coalesced, read_records, write_archives
    from fundlake.session import shared_folder

    pages = spark.createDataFrame([(i, f"http://a/{i}", f"<p>{i}</p>" * 50) for i in range(200)], "page_id long, url string, html string")
    folder = shared_folder(spark, "warc")
    folder = folder if folder.startswith("file:") else f"file://{folder}"
    index = write_archives(pages, folder)
    got = read_records(index.where("url like '%7'"), folder).collect()
    assert {g["page_id"]: g["payload"].decode() for g in got} == {i: f"<p>{i}</p>" * 50 for i in range(7, 200, 10)}
    reads = list(coalesced(iter([(0, 10), (10, 5), (1000, 5), (9_000_000, 5)])))
    assert [r[:2] for r in reads] == [(0, 1005), (9_000_000, 9_000_005)]


# --- quality ---------------------------------------------------------------------------------


def base(text):
    words = (text or "").encode().split()
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = set()
    for i in range(len(words) - 4):
        if windows[tuple(words[i : i + 5])] > 1:
            repeated.update(range(i, i + 5))
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if line.encode().split():
            dup += line in seen
            seen.add(line)
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum(c in "#*$%&|<>" for c in text or ""),
        dup,
        len(repeated),
    )


def check_quality(docs, labels):
    from fundlake.llm.quality import BASE, quality

    rows, got = numbered_rows(docs), by_row(quality(docs, labels))
    assert set(rows) == set(got)
    for k, r in rows.items():
        wanted = base(r["text"])
        assert tuple(got[k][c] for c in BASE) == wanted
        failed = wanted[0] < 10 or 100 * wanted[4] > 20 * wanted[0]
        assert got[k]["base_failed"] == failed
        assert not (failed and got[k]["kept"])
    return got


def test_quality_odd(odd, no_labels):
    got = check_quality(odd, no_labels)
    assert all(g["kept"] != g["base_failed"] for g in got.values())


@needs_data
def test_quality_documents(spark, documents):
    check_quality(documents, spark.read.parquet(f"{FOLDER}/labels.parquet"))


def test_the_forest_rejects_what_labels_call_bad(spark):
    rng = random.Random(2)
    text = lambda mark: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randrange(3, 9))) + mark for _ in range(rng.randrange(30, 90)))
    rows = [(i, text("|" if i % 8 == 0 else "")) for i in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 8 > 0), 0) for i in range(0, 1200) if i % 3], "doc_id long, quality int, toxic int")
    from fundlake.llm.quality import quality

    kept = {r["doc_id"]: r["kept"] for r in quality(docs, labels).collect()}
    assert sum(kept[i] for i in kept if i % 8 == 0) <= 5
    assert sum(not kept[i] for i in kept if i % 8) <= 20


# --- toxicity --------------------------------------------------------------------------------


def test_toxicity_learns_and_holds_out(spark):
    from fundlake.llm.toxicity import toxicity

    rng = random.Random(4)
    plain = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    rows, marks = [], []
    for i in range(1500):
        words = plain(60)
        bad = i % 10 == 0
        if bad:
            words[5:8] = [rng.choice(["foul", "Vile!", "nasty,"]) for _ in range(3)]
        rows.append((i, " ".join(words)))
        if i % 2 == 0:
            marks.append((i, 1, int(bad)))
    docs = spark.createDataFrame(rows + [(None, None), (5000, "")], "doc_id long, text string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    got = toxicity(docs, labels).collect()
    assert len(got) == len(rows) + 2
    for g in got:
        if g["doc_id"] is not None:
            assert g["held_out"] == (zlib.crc32(str(g["doc_id"]).encode()) % 5 == 0)
        assert 0 <= g["score"] <= 1 and g["predicted"] == (g["score"] >= 0.5)
    held = [g for g in got if g["held_out"] and g["doc_id"] is not None and g["doc_id"] < 1500]
    right = sum(g["predicted"] == (g["doc_id"] % 10 == 0) for g in held)
    assert right >= 0.97 * len(held)
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {g["doc_id"]: g["score"] for g in toxicity(docs, flipped).collect()}
    assert all(again[g["doc_id"]] == g["score"] for g in got if g["doc_id"] is not None)


def test_without_labels(odd, no_labels):
    from fundlake.llm.toxicity import toxicity

    assert all(g["predicted"] == 0 for g in toxicity(odd, no_labels).collect())


# --- sentence pieces -------------------------------------------------------------------------


def check_pieces(docs):
    from sentencepiece import SentencePieceProcessor

    from fundlake.llm.queries import vocabulary
    from fundlake.llm.sentencepieces import decoded, encoded

    path = vocabulary("piece_bpe_32k.model")
    model = SentencePieceProcessor(model_file=path)
    rows = numbered_rows(docs)
    ids = by_row(encoded(docs, path))
    back = by_row(decoded(encoded(docs, path), path))
    assert set(rows) == set(ids) == set(back)
    for k, r in rows.items():
        wanted = model.encode(r["text"] or "")
        assert np.frombuffer(ids[k]["ids"], "<u4").tolist() == wanted, r["text"]
        assert back[k]["n_tokens"] == len(wanted) and back[k]["text"] == model.decode(wanted) == (r["text"] or "")


def test_pieces_odd(odd, spark):
    check_pieces(odd)
    texts = ["  two  spaces ", "   ", "\n\n a\n b", "tab\tx", "e\u0301 \u3000 \x00", "  lead", "aaaaaaaaaaaaaaaaaaaa", "x" * 3000]
    check_pieces(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


@needs_data
def test_pieces_documents(documents):
    check_pieces(documents)


def test_scores_are_maximised_over_shared_prefixes():
    from fundlake.llm.sentencepieces import Pieces

    pieces = ["a", "b", "ab", "ba", "aba", "bb", "abb"]
    model = Pieces(pieces, [-rank for rank in range(1, len(pieces) + 1)], set(), {}, by_score=True)
    words = {"".join(c) for n in range(1, 7) for c in __import__("itertools").product("ab", repeat=n)}
    model.learn(words)

    def best(word):
        return max((best(word[: -n]) + model.score[word[-n:]] for n in (1, 2, 3) if word[-n:] in model.score and n <= len(word)), default=0.0) if word else 0.0

    names = list(model.ids)
    for word in words:
        parts = [names[i] for i in np.frombuffer(model.words[word], "<u4")]
        assert "".join(parts) == word and sum(model.score[p] for p in parts) == best(word)


def test_long_runs_of_blanks_take_linear_time():
    import time

    from sentencepiece import SentencePieceProcessor

    from fundlake.llm.queries import vocabulary
    from fundlake.llm.sentencepieces import Pieces

    path = vocabulary("piece_bpe_32k.model")
    model, reference = Pieces.read(path), SentencePieceProcessor(model_file=path)
    texts = [" " * n + rest for n in (*range(70), 1000) for rest in ("", "hello", "日本", "▁x", "é")] + ["a" + " " * 999 + "b  c   "]
    words = [Pieces.split(t) for t in texts]
    model.learn(set().union(*words))
    for text, own in zip(texts, words):
        assert np.frombuffer(model.encode(own), "<u4").tolist() == reference.encode(text), repr(text)
    started = time.process_time()
    own = Pieces.split(" " * (1 << 20) + "word")
    model.learn(set(own))
    assert len(model.encode(own)) // 4 >= (1 << 16) and time.process_time() - started < 5


# --- token counts ----------------------------------------------------------------------------


def test_every_context_limit(odd):
    from tokenizers import Tokenizer

    from fundlake.llm.queries import vocabulary
    from fundlake.llm.token_counts import context_limits, histogram

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    lengths = [len(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids) for r in odd.collect()]
    got = context_limits(histogram(odd, path)).collect()
    assert sorted(g["n_tokens"] for g in got) == sorted(set(lengths))
    for g in got:
        limit = g["n_tokens"]
        assert g["n_docs"] == lengths.count(limit) and g["docs_up_to"] == sum(n <= limit for n in lengths)
        assert g["docs_beyond"] == sum(n > limit for n in lengths)
        assert g["tokens_kept"] == sum(min(n, limit) for n in lengths)
        assert g["tokens_cut"] == sum(lengths) - g["tokens_kept"]
        assert g["quantile"] == pytest.approx(g["docs_up_to"] / len(lengths))


# --- all -------------------------------------------------------------------------------------


def test_empty_tables(spark, empty, no_labels):
    from fundlake.llm import exact, minhash, packing, quality, shards, spans, toxicity, warc
    from fundlake.llm.queries import vocabulary

    assert exact.exact_groups(empty).count() == 0
    assert minhash.near_duplicates(empty).count() == 0
    assert spans.repeated_spans(empty).count() == 0
    assert packing.packed(empty, vocabulary("word_bpe_49k.json")).count() == 0
    assert shards.sharded(empty).count() == 0
    from fundlake.llm import sentencepieces, token_counts

    assert sentencepieces.encoded(empty, vocabulary("piece_bpe_32k.model")).count() == 0
    assert token_counts.context_limits(token_counts.histogram(empty, vocabulary("word_bpe_49k.json"))).count() == 0
    assert quality.quality(empty, no_labels).count() == 0
    assert toxicity.toxicity(empty, no_labels).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.archive_report(pages).count() == 0


@needs_data
@pytest.mark.parametrize("name", [n for n in queries() if n.startswith("op")])
def test_queries_give_rows_for_all(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


# --- columns with names used inside ---------------------------------------------------------

INSIDE = ["_row", "_null", "carried", "chunk", "data", "node", "label", "known", "without", "g", "id", "leaf", "word", "part"]


@pytest.fixture(scope="module")
def clashing(odd):
    return odd.select("*", *[F.lit(5).alias(n) for n in INSIDE if n not in odd.columns])


def test_clashing_names_change_nothing(odd, clashing, no_labels):
    from fundlake.llm import divergence, exact, merkle, minhash, packing, patterns, quality, sentencepieces, shards, spans, token_counts, toxicity
    from fundlake.llm.queries import vocabulary

    word, byte = vocabulary("word_bpe_49k.json"), vocabulary("byte_bpe_50k.json")
    piece = vocabulary("piece_bpe_32k.model")
    for build in (
        exact.exact_groups,
        minhash.near_duplicates,
        spans.repeated_spans,
        lambda d: sentencepieces.decoded(sentencepieces.encoded(d, piece), piece),
        lambda d: token_counts.histogram(d, word),
        lambda d: quality.quality(d, no_labels),
        lambda d: toxicity.toxicity(d, no_labels),
        lambda d: packing.packed(d, word).select("doc_id", "start", "doc_tokens"),
        lambda d: shards.sharded(d).select("doc_id", "size", "text_crc32"),
        lambda d: patterns.pattern_packed(d, byte).select("doc_id", "piece", "start", "length", "ids_crc32"),
        merkle.manifest,
        divergence.audit,
    ):
        without = [sorted(str(tuple(v for k, v in r.asDict().items() if k != "_row")) for r in build(d).collect()) for d in (odd, clashing)]
        assert without[0] == without[1]


def test_stages_with_odd_rows_and_clashing_names(spark, clashing, empty):
    import corpus_pipeline
    from fundlake.session import stored

    docs = clashing
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, FOLDER).count() == 0
        out = stored(stage(spark, docs, FOLDER), name)
        assert out.dtypes == docs.dtypes and out.count() <= docs.count()
        assert {r["_row"] for r in out.select("_row").distinct().collect()} == {5}
        if name == "exact_dedup":
            assert out.count() == len({"".join((r["text"] or "").split()) for r in docs.collect()})
        docs = out
    pack = corpus_pipeline.STAGES[-1][1]
    assert pack(spark, empty, FOLDER).count() == 0
    assert pack(spark, docs, FOLDER).groupBy("doc_id").count().count() == docs.select("doc_id").distinct().count()


def test_toxicity_learns_one_text_an_id(spark, monkeypatch):
    from fundlake.llm import toxicity

    given = {}
    monkeypatch.setattr(toxicity, "fit", lambda pos, rest, prior: given.update(pos=len(pos), rest=len(rest)))
    ids = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5]
    docs = spark.createDataFrame([(ids[0], f"text {k}") for k in range(3000)] + [(i, "plain") for i in ids], "doc_id long, text string")
    labels = spark.createDataFrame([(ids[0], 0, 1)], "doc_id long, quality int, toxic int")
    toxicity.train(docs, labels, positives=10, unlabelled=20)
    assert given == {"pos": 1, "rest": 20}


def test_risk_gradients_equal_plain_loops(monkeypatch):
    """One round of descent from a known start, where the negative part of the risk is positive."""
    from fundlake.llm import toxicity

    monkeypatch.setattr(toxicity, "LEAST_TEXTS", 1)
    monkeypatch.setattr(toxicity, "LEAST_ERRORS", 0.0)
    positives = [np.array(x, np.uint64) for x in ([1, 2], [1, 3], [2, 9])]
    unlabelled = [np.array(x, np.uint64) for x in ([1], [4, 9], [5, 6], [4, 6])]
    signs = set()
    for prior in (0.05, 0.4, 0.9):
        offset = np.log(prior / (1 - prior))
        p, loss = 1 / (1 + np.exp(-offset)), np.logaddexp(0, offset)
        sign = 1 if loss - prior * loss >= 0 else -1
        model = toxicity.fit(positives, unlabelled, prior, rounds=1, decay=0.0)
        grads = {}
        for key in (1, 2, 3, 4, 5, 6, 9):
            g = 0.0
            for doc in positives:
                if key in doc:
                    g += (prior * (p - 1) - prior * p if sign > 0 else prior * p) / len(positives)
            for doc in unlabelled:
                if key in doc:
                    g += sign * p / len(unlabelled)
            grads[key] = g
        got = dict(zip(model.keys.tolist(), model.weights.tolist()))
        for key, g in grads.items():
            assert got.get(key, 0.0) == pytest.approx(-0.05 * g / (abs(g) + 1e-8), abs=2e-3)
        signs.add(sign)
    assert signs == {1}


# --- rows whose order and splits differ from scan to scan ------------------------------------


def restless(docs):
    """The rows in another order each time they are read."""

    def mix(batches):
        import os
        import random

        rng = random.Random(os.urandom(8))
        rows = [batch.slice(i, 1) for batch in batches for i in range(batch.num_rows)]
        rng.shuffle(rows)
        yield from rows

    return docs.repartition(4).mapInArrow(mix, docs.schema)


def plain(df):
    return sorted((tuple(str(v) for v in r) for r in df.drop("_row").collect()))


@pytest.fixture(scope="module")
def short_texts(spark):
    """Unique ids; near copies, shared passages, each text several rows apart from its copy."""
    rng = random.Random(12)
    texts = [" ".join(f"w{rng.randrange(5000)}" for _ in range(60)) for _ in range(60)]
    texts += [t + " more" for t in texts[:30]] + [texts[i][:150] + " " + texts[59 - i][:90] for i in range(30)] + texts[20:50]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_near_of_rows_read_in_another_order(short_texts):
    from fundlake.llm.minhash import near_duplicates

    wanted = plain(near_duplicates(short_texts, words=3, percent=85))
    assert plain(near_duplicates(restless(short_texts), words=3, percent=85)) == wanted


def test_spans_of_rows_read_in_another_order(short_texts):
    from fundlake.llm.spans import repeated_spans

    assert plain(repeated_spans(restless(short_texts))) == plain(repeated_spans(short_texts))


def test_archive_of_rows_read_in_another_order(short_texts):
    from fundlake.llm.warc import archive_report

    pages = short_texts.select(F.col("doc_id").alias("page_id"), F.lit("http://a/").alias("url"), F.col("text").alias("html"))
    assert plain(archive_report(restless(pages))) == plain(archive_report(pages))


@needs_data
@pytest.mark.parametrize("stage", ["toxicity", "exact_dedup", "near_dedup"])
def test_stages_of_rows_read_in_another_order(spark, documents, stage):
    import corpus_pipeline

    build = dict(corpus_pipeline.STAGES)[stage]
    wanted = plain(build(spark, documents, FOLDER))
    assert plain(build(spark, restless(documents), FOLDER)) == wanted


def test_components_make_rows_in_proportion_to_links(spark, monkeypatch):
    """Nodes of one cluster share many hubs, and hubs form a long chain: links are not joined again in every round."""
    from fundlake.llm.components import components

    rng = random.Random(12)
    names = rng.sample(range(10**9), 1100)
    pairs = [(n, names[rng.randrange(30)]) for n in names[30:1000] for _ in range(8)]
    pairs += [(names[i], names[i + 1]) for i in range(1000, 1099)]
    links = spark.createDataFrame(pairs, "x long, y long")
    made, real = [], type(links).join

    def counted(self, *args, **named):
        joined = real(self, *args, **named)
        made.append(joined.count())
        return joined

    parent = {n: n for p in pairs for n in p}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    with monkeypatch.context() as patched:
        patched.setattr(type(links), "join", counted)
        labels = components(links)
    assert sorted(map(tuple, labels.collect())) == sorted((n, root(n)) for n in parent)
    n_links = len({(min(p), max(p)) for p in pairs})
    assert sum(made) <= 4 * n_links, (made, n_links)
