"""Each operator against brute force on a table that holds every awkward case."""

from __future__ import annotations

import hashlib
import random
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from airshed.llm import chat, decontamination, jaccard, linking, packing, phrases, quality, secret_scan, sharding, tokens, warc
from airshed.llm.common import scratch
from tests.llm.fixtures import corpus, documents, space_words, words

ROWS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark, ROWS).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def counted(rows):
    return Counter(tuple(r) for r in rows)


# 1 sharding

def _sized(docs):
    return docs.select("doc_id", "text", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("size"),
                       F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), F.lit("x").alias("row"), F.lit("x").alias("shard"))


def test_shards_are_gapless_and_equal(docs):
    out = sharding.shard_by_splitters(_sized(docs), 7).collect()
    assert counted((r["doc_id"], r["text"]) for r in out) == counted(ROWS)
    filled = defaultdict(list)
    for r in out:
        filled[r["shard"]].append(r)
    total, largest = sum(r["size"] for r in out), max(r["size"] for r in out)
    for shard, rows in filled.items():
        assert 0 <= shard < 7 and sorted(r["slot"] for r in rows) == list(range(len(rows)))
        assert abs(sum(r["size"] for r in rows) - total / 7) <= largest


def test_overfull_ranges_of_one_key_are_subdivided(spark):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit(5).alias("key"), F.lit(10).alias("size"))
    out = sharding.shard_by_splitters(rows, 4, max_range_rows=50)
    assert sorted(r["count"] for r in out.groupBy("shard").count().collect()) == [750] * 4
    assert out.select("shard", "slot").distinct().count() == 3000


def test_shards_of_nothing_and_of_null_keys(spark, nothing):
    assert sharding.shard_by_splitters(_sized(nothing), 40).count() == 0
    rows = spark.createDataFrame([(None, None), (None, 0), (1, -5)], "key long, size long")
    assert sorted(r["slot"] for r in sharding.shard_by_splitters(rows, 1).collect()) == [0, 1, 2]


# 2 WARC

PAGES = [(1, "http://a", "<p>" + "same " * 50), (2, "http://b", "<p>" + "same " * 50), (0, "http://c", "<p>" + "same " * 50), (3, None, "short"),
         (4, "http://d\r\nX: y", "short"), (5, "http://e", None), (None, "http://f", "<p>" + "same " * 50), (None, "g", "é" * 80), (6, "h", "\r\n\r\nWARC/1.1\r\n" * 20),
         (7, "i", "é" * 80), (7, "i", "é" * 80), (8, "j", "z" * 3_000_000), (9, "k", "")]


def _pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit("x"), "payload": F.lit(1), "first": F.lit(2), "n": F.lit(3)})


def test_archives_round_trip(spark):
    archives = warc.archive_pages(_pages(spark, PAGES), scratch(spark, "warc"))
    out = warc.read_archives(archives).collect()
    first = {}
    for page, _, html in PAGES:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    expected = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        refers = first.get(html or "") if len(body) >= 100 and page != first.get(html or "", page) else None
        expected.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if refers is not None else "response", refers))
    assert counted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out) == Counter(expected)
    assert counted((r["page_id"], bytes(r["payload"])) for r in out if r["record_type"] == "response") == Counter(
        (p, (h or "").encode()) for (p, _, h), e in zip(PAGES, expected, strict=True) if e[3] == "response")


def test_archive_layout_and_trained_dictionary(spark):
    rng = random.Random(2)
    rows = [(i, f"http://x/{i}", "<html><body class='page'>" + " ".join(words(rng, 1500)) + "</body></html>") for i in range(200)]
    dictionary = warc.train_dictionary(_pages(spark, rows))
    assert dictionary[:4] == b"\x37\xa4\x30\xec"
    archives = warc.archive_pages(_pages(spark, rows), scratch(spark, "warc")).collect()
    assert sum(a["records"] for a in archives) == 200
    for a in archives:
        where, name = warc.open_path(a["path"])
        with where.open_input_stream(name) as f:
            held = f.read()
        assert held[:4] == warc.DICTIONARY_FRAME and held[8:8 + len(dictionary)] == dictionary and len(held) == a["bytes"]
        import zstandard
        unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
        for offset, content in warc.read_archive(a["path"]):  # each record by its offset alone
            assert unpack.decompressobj().decompress(held[offset:]) == content


def test_archive_of_nothing(spark):
    assert warc.read_archives(warc.archive_pages(_pages(spark, []), scratch(spark, "warc"))).count() == 0
    assert warc.read_archives(warc.archive_pages(_pages(spark, [(None, None, None)]), scratch(spark, "warc"))).count() == 1


# 3 packing and 7 token counts

def test_piece_lengths():
    assert packing.piece_lengths(1) == [1] and packing.piece_lengths(2048) == [2048]
    assert packing.piece_lengths(5000) == [2048, 2048, 512, 256, 128, 8]


def test_pieces_cover_every_id_once(docs, library):
    out = packing.pack(docs).collect()
    expected = Counter((i, tuple(library.encode(t or "", add_special_tokens=False).ids) + (1,)) for i, t in ROWS)
    pieces = Counter()
    for (i, ids), n in expected.items():
        at = 0
        for length in packing.piece_lengths(len(ids)):
            piece = np.array(ids[at:at + length], dtype="<u4")
            pieces[i, at, length, zlib.crc32(piece.tobytes()), len(ids), tuple(ids[at:at + length])] += n
            at += length
    assert pieces == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], tuple(r["ids"])) for r in out)
    assert sorted(r["sequence_id"] for r in out) == list(range(len(out))) and {r["offset"] for r in out} == {0}
    lengths = [r["length"] for r in sorted(out, key=lambda r: r["sequence_id"])]
    assert lengths == sorted(lengths) and all(1 << r["bucket"] == r["length"] for r in out)


def test_ids_are_not_shuffled(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = packing.pack(docs)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [x for x in plan.splitlines() if "Join [" in x and "task" in x]
    assert joins and all("BroadcastHashJoin" in x for x in joins)


def test_packing_nothing(nothing):
    assert packing.pack(nothing).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_equal_the_library(spark, docs, nothing, name):
    import sentencepiece
    path = public_tokenizers.path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t))
    else:
        model = Tokenizer.from_file(path)
        count = lambda t: len(model.encode(t, add_special_tokens=False).ids)
    cache = scratch(spark, "cache")
    expected = Counter((i, len((t or "").encode()), count(t or "")) for i, t in ROWS)
    assert counted(tokens.count_tokens(docs, cache, name).collect()) == expected
    n = spark.read.parquet(cache).count()
    assert n == len({t or "" for _, t in ROWS})
    assert counted(tokens.count_tokens(docs, cache, name).collect()) == expected
    assert spark.read.parquet(cache).count() == n  # all hits: nothing is encoded again
    assert tokens.count_tokens(nothing, cache, name).count() == 0


def test_token_query_reads_its_cache(spark, docs, library, tmp_path, monkeypatch):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    cache, stored = scratch(spark, "cache"), []
    whole = tokens.count_tokens

    def counting(*args):
        out = whole(*args)
        stored.append(spark.read.parquet(cache).count())
        return out
    monkeypatch.setattr(tokens, "count_tokens", counting)
    out = tokens.op7_digest_cache(spark, str(tmp_path), cache)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    n = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in ROWS]
    assert Counter(map(tuple, out.collect())) == Counter((*row, row[2] > 512) for row in n)
    assert stored == [len({t or "" for _, t in ROWS})] * 2  # the second pass stores nothing


def test_cache_is_kept_apart_by_tokenizer(spark, docs):
    cache = scratch(spark, "cache")
    a = tokens.count_tokens(docs, cache, "byte_bpe_50k.json").collect()
    b = tokens.count_tokens(docs, cache, "piece_bpe_32k.model").collect()
    assert counted(a) != counted(b) and counted(tokens.count_tokens(docs, cache, "byte_bpe_50k.json").collect()) == counted(a)


def test_fast_encoder_gives_the_library_ids(library):
    ids = tokens.encoder("byte_bpe_50k.json")
    for _, text in ROWS:
        assert ids(text or "").tolist() == library.encode(text or "", add_special_tokens=False).ids


# 4 decontamination

def _hits(text, windows):
    w = decontamination.words_of(text)
    hit, found = [False] * len(w), set()
    for i in range(len(w)):
        for n in (len(x) for x in {len(x): x for x in windows}.values()):
            for item in windows.get(tuple(w[i:i + n]), ()) if i + n <= len(w) else ():
                found.add(item)
                hit[i:i + n] = [True] * n
    return len(w), sum(hit), sorted(found)


def test_contamination_equals_brute_force(spark, docs, nothing):
    rng = random.Random(4)
    long = words(rng, 40)
    items = [(1, " ".join(long)), (2, " ".join(long[5:25])), (10, "word"), (11, "Two, WORDS!"), (12, ""), (13, None), (None, "in the"), (14, " ".join(ROWS[3][1].split()[:20])),
             (14, " ".join(ROWS[4][1].split()[:15])), (15, "x" * 200_000), (16, "日本語 text")]
    benchmark = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x"))
    windows = defaultdict(set)
    for item, text in items:
        w = decontamination.words_of(text)
        for i in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[i:i + 13])].add("null" if item is None else str(item))
    extra = [(200, " ".join(words(rng, 50) + long + words(rng, 700))), (201, " ".join(long[3:16])), (202, " ".join(long + long)), (203, " ".join(long[:12]))]
    mine = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string"))
    found = decontamination.find_contamination(mine, benchmark).collect()
    expected = Counter()
    for i, t in ROWS + extra:
        n, hit, which = _hits(t, windows)
        expected[i, n, hit, tuple(which), hit > 0 and 20 * hit >= n] += 1
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in found) == expected
    text = dict(extra)
    for r in found:
        if r["doc_id"] in text:  # spans cover exactly the hit words
            assert sum(len(decontamination.words_of(text[r["doc_id"]][s["start"]:s["end"]])) for s in r["spans"]) == r["n_hit"]
    clean = decontamination.clean_documents(docs, benchmark)
    assert clean.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in clean.collect()) == Counter((i, t) for i, t in ROWS if not _flag(t, windows))
    assert decontamination.find_contamination(nothing, benchmark).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.clean_documents(docs, empty).count() == len(ROWS)


def _flag(text, windows):
    n, hit, _ = _hits(text, windows)
    return hit > 0 and 20 * hit >= n


def test_benchmark_blocks_give_the_same(spark, docs, monkeypatch):
    items = [(i, " ".join((ROWS[i][1] or "").split()[:20])) for i in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = counted(map(str, decontamination.find_contamination(docs, benchmark).collect()))
    monkeypatch.setattr(decontamination, "BLOCK_WORDS", 200)
    assert len(decontamination.compile_benchmark(benchmark)) > 3
    assert counted(map(str, decontamination.find_contamination(docs, benchmark).collect())) == whole


# 5 substring dedup

def test_repeats_equal_brute_force(docs, nothing):
    seen = Counter()
    for _, t in ROWS:
        w = space_words(t)
        seen.update(tuple(w[i:i + 35]) for i in range(len(w) - 34))
    expected = Counter()
    for i, t in ROWS:
        w = space_words(t)
        gone = [False] * len(w)
        for j in range(len(w) - 34):
            if seen[tuple(w[j:j + 35])] > 1:
                gone[j:j + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        expected[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept if sum(gone) else None] += 1
    assert counted(phrases.remove_repeats(docs).collect()) == expected
    assert phrases.remove_repeats(nothing).count() == 0


def test_hot_anchors_are_dealt_out(docs, monkeypatch):
    whole = counted(phrases.remove_repeats(docs).collect())
    monkeypatch.setattr(phrases, "HOT_ANCHOR", 3)
    monkeypatch.setattr(phrases, "SHARD_SEGMENTS", 10)
    assert counted(phrases.remove_repeats(docs).collect()) == whole


# 6 chats

def test_snapshots_collapse_to_maximal_conversations(spark):
    turns = [(1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "assistant", "hello"), (3, 2, "user", "bye"),
             (4, 5, "user", "hi"), (4, 9, "assistant", "hello"), (4, 11, "user", "bye"), (5, 0, "user", "hi"), (5, 1, "assistant", "other"),
             (6, 0, "user", None), (7, 0, "user", ""), (None, 0, "user", "hi"), (None, None, None, None), (8, 0, "user", "x" * 100_000), (8, 0, "user", "x" * 100_000)]
    t = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").withColumns({"whole": F.lit(1), "turns": F.lit(2), "n_turns": F.lit(3)})
    out = {r["conv_id"]: r for r in chat.format_chats(t).collect()}
    assert set(out) == {3, 5, 6, None, 8}
    assert out[3]["n_equal"] == 2 and out[3]["n_turns"] == 3 and out[6]["n_equal"] == 2 and out[8]["n_turns"] == 1
    assert out[5]["rendered"] == "<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\nother<|im_end|>\n"
    assert out[None]["n_turns"] == 2 and out[None]["rendered"].startswith("<|im_start|>\n<|im_end|>\n")
    assert chat.format_chats(t.limit(0)).count() == 0


def test_one_conversation_is_spread_over_tasks(spark):
    long = [(c, i, "user", f"turn {i}") for c in (None, 4, 9) for i in range(600)] + [(9, 600, "user", "more")]
    t = spark.createDataFrame(long + [(20 + i, j, "user", f"turn {j}") for i in range(40) for j in range(i + 1)] + [(99, None, "x", f"{i}") for i in range(300)],
                              "conv_id long, turn long, role string, text string").repartition(8)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert chat.hashed_turns(t).filter("conv_id IS NULL").select("part").distinct().count() > 1
        out = {r["conv_id"]: r for r in chat.format_chats(t).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert set(out) == {9, 99} and out[9]["n_turns"] == 601 and out[9]["n_equal"] == 1 and out[99]["n_turns"] == 300
    turns = [x.split("\n")[1] for x in out[9]["rendered"].split("<|im_end|>\n")[:-1]]
    assert turns == [f"turn {i}" for i in range(600)] + ["more"]


# 8 Jaccard join

def _components(rows, rule):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + rule.words]) for i in range(max(1, len(w) - rule.words + 1))} if w else set())
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and rule.den * both >= rule.num * (len(sets[i]) + len(sets[j]) - both):
                a, b = group[i], group[j]
                group = [b if g == a else g for g in group]
    least = defaultdict(list)
    for (i, _), g in zip(rows, group, strict=True):
        least[g].append(i)
    return Counter((i, len(s), min((x for x in least[g] if x is not None), default=None)) for (i, _), s, g in zip(rows, sets, group, strict=True))


@pytest.mark.parametrize("rule", [jaccard.Rule(3, 90, 100), jaccard.Rule()])
def test_components_equal_brute_force(docs, nothing, rule):
    out = jaccard.near_duplicates(docs, rule).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == _components(ROWS, rule)
    assert jaccard.near_duplicates(nothing, rule).count() == 0
    kept = jaccard.first_documents(docs, rule)
    assert kept.columns == docs.columns
    worded = [r["doc_id"] for r in kept.collect() if r["text"] and r["text"].split()]
    assert Counter(worded) == Counter({c for i, n, c in _components(ROWS, rule) if n})


def test_a_large_group_at_all_distances(spark, monkeypatch):
    rng = random.Random(8)
    base, rows = words(rng, 150), []
    for i in range(150):
        copy = list(base)
        for _ in range(rng.randrange(0, 14)):
            copy[rng.randrange(150)] = f"w{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(copy[:rng.randrange(130, 151)])))
    for rule in (jaccard.Rule(3, 90, 100), jaccard.Rule()):
        expected = _components(rows, rule)
        d = documents(spark, rows)
        assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(d, rule).collect()) == expected
    monkeypatch.setattr(linking, "HELD_SHINGLES", 2000)  # the search goes over several blocks and parts
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.near_duplicates(d, rule).collect()) == expected


# 9 quality rules

def _unspaced(c):
    return any(a <= ord(c) <= b for a, b in ((0xE00, 0xEFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3000, 0x30FF), (0x3400, 0x4DBF),
                                             (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF00, 0xFFEF), (0x20000, 0x3FFFF)))


def _quality(text):
    w = space_words(text)
    five = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n = Counter(five)
    again = {p for i, x in enumerate(five) if n[x] > 1 for p in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    spaced = space_words("".join(" " if _unspaced(c) else c for c in text or ""))
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum((text or "").count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(again), "n_lines": len(lines),
            "spaced_chars": sum(map(len, spaced)), "n_spaced_words": len(spaced),
            "n_letters": sum(unicodedata.category(c)[0] in "LM" for c in text or ""),
            "n_ellipsis_lines": sum(x.rstrip(" \t\n\v\f\r").endswith(("...", "\u2026")) for x in lines),
            "n_bullet_lines": sum(x.lstrip(" \t\n\v\f\r")[0] in "-*\u2022\u2023\u25aa\u25cf" for x in lines),
            "n_top_pair": max(Counter(zip(w, w[1:], strict=False)).values(), default=0)}


def test_ledger_equals_brute_force(docs, nothing):
    expected = []
    for i, t in ROWS:
        m = _quality(t)
        bits = sum(1 << bit for bit, rule in quality.RULES.values() if eval(rule, {}, m))  # the conditions are plain arithmetic
        expected.append((i, *(m[x] for x in quality.MEASUREMENTS), bits))
    entries = quality.ledger(docs)
    assert counted(entries.collect()) == Counter(expected)
    kept = quality.kept_documents(docs, "base-1")
    assert kept.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in kept.collect()) == Counter(
        r for r, e in zip(ROWS, expected, strict=True) if not e[-1] & quality.policy_mask("base-1"))
    for policy in ("corpus-1", "corpus-2"):
        mask = quality.policy_mask(policy)
        for r in quality.ablation(entries, policy).collect():
            bit = 1 << quality.RULES[r["rule"]][0]
            assert (r["fails"], r["fails_alone"], r["rejected"]) == (
                sum(e[-1] & bit > 0 for e in expected), sum(e[-1] & mask == bit for e in expected), sum(e[-1] & mask > 0 for e in expected))
    assert quality.ledger(nothing).count() == 0


QUALITY = [
    (1, " ".join(["\u8fd9\u662f\u4e00\u4e2a\u5173\u4e8e\u5929\u6c14\u548c\u7a7a\u6c14\u8d28\u91cf\u7684\u8bf4\u660e\uff0c\u6211\u4eec\u6bcf\u5929\u90fd\u4f1a\u66f4\u65b0\u6570\u636e" + chr(0x4E00 + i) for i in range(12)])),
    (2, " ".join(["\u3053\u308c\u306f\u6bce\u65e5\u306e\u5929\u6c17\u3068\u7a7a\u6c17\u306e\u8cea\u306b\u3064\u3044\u3066\u306e\u9577\u3044\u8aac\u660e\u306e\u6587\u7ae0\u3067\u3059\u3002" + chr(0x3041 + i) for i in range(12)])),
    (3, " ".join(["\u0e19\u0e35\u0e48\u0e04\u0e37\u0e2d\u0e02\u0e49\u0e2d\u0e04\u0e27\u0e32\u0e21\u0e40\u0e01\u0e35\u0e48\u0e22\u0e27\u0e01\u0e31\u0e1a\u0e2a\u0e20\u0e32\u0e1e\u0e2d\u0e32\u0e01\u0e32\u0e28" + chr(0xE01 + i) for i in range(12)])),
    (4, " ".join(f"{'x' * 40}{i}" for i in range(12))),
    (5, " ".join(f"{i}.{i}7" for i in range(30))),
    (6, "\n".join(" ".join(x + chr(97 + i) for x in ("line", "goes", "upon", "after")) + "..." for i in range(6)) + "\nlast line here \u2026  \nand one whole line"),
    (7, "\n".join("  \u2022 " + " ".join(x + chr(97 + i) for x in ("point", "of", "the", "list")) for i in range(12))),
    (8, " ".join(f"buy now {chr(97 + i)}{chr(98 + i)} of{i}" for i in range(14))),
    (9, "An ordinary text of more than ten words, with nothing odd about it at all."),
]


def test_rules_of_the_second_corpus_policy(spark):
    """Clean texts in scripts without blanks stay; each new rule rejects its own case alone; corpus-1 keeps its meaning."""
    entries = quality.ledger(documents(spark, QUALITY))
    rows = {r["doc_id"]: r for r in entries.collect()}
    for i, t in QUALITY:
        assert {x: rows[i][x] for x in quality.MEASUREMENTS} == _quality(t), i
    failed = {i: {n for n in quality.POLICIES["corpus-2"] if rows[i]["fail_bits"] >> quality.RULES[n][0] & 1} for i in rows}
    assert failed == {1: set(), 2: set(), 3: set(), 4: {"long_spaced_words"}, 5: {"few_letters"}, 6: {"ellipsis_lines"}, 7: {"bullet_lines"},
                      8: {"frequent_pair"}, 9: set()}
    assert {r["doc_id"] for r in quality.apply_policy(entries, "corpus-1").filter("kept").collect()} == {5, 6, 7, 8, 9}
    assert quality.kept_documents(documents(spark, QUALITY), "corpus-2").count() == 4


# 10 secrets

SECRETS = [(1, 'password = "hunter22" and token: abc and SECRET:abcdef'), (2, "AKIA" + "A1B2C3D4E5F6G7H8" + " AKIA123"), (3, "0123456789abcdef0123456789 short abc123"),
           (4, None), (5, ""), (None, "api_key=zzzzzzzz\U0001F600 apikey:'yyyyyy'"), (6, "token=token:abcdefg"), (6, "token=token:abcdefg"), (7, "password=secret=abcdef é token= 123456"),
           (8, "passwd" * 3 + " = qwertyuiop")]


def _base(text):
    import re
    spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(spans + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_base_spans_equal_brute_force(spark, docs, nothing):
    d = documents(spark, SECRETS + ROWS)
    found = Counter((r["doc_id"], tuple((s["start"], s["rank"], s["end"]) for s in r["spans"] if s["rank"] < 3)) for r in secret_scan.scan(d).collect())
    assert found == Counter((i, tuple(_base(t or ""))) for i, t in SECRETS + ROWS)
    redacted = secret_scan.redact(documents(spark, SECRETS))
    assert redacted.columns == d.columns
    texts = defaultdict(list)
    for r in redacted.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[1] == ['[SECRET]" and token: abc and [SECRET]'] and texts[4] == [None] and texts[None].count("[SECRET]\U0001F600 [SECRET]'") == 1
    assert texts[6] == ["token=token:abcdefg"] * 2
    assert secret_scan.scan(nothing).count() == 0 and secret_scan.redact(nothing).count() == 0


def test_battery_finds_random_tokens_and_leaves_natural_ones(spark):
    import base64
    rng = random.Random(10)
    random_ = [base64.b64encode(rng.randbytes(30)).decode() for _ in range(40)]
    natural = ["-".join(words(rng, 5))[:40].replace("é", "e").replace("ß", "s") + f"-{rng.randrange(100)}" for _ in range(400)]
    repeated = ["xyz789" * 6 for _ in range(20)] + ["x1" * 20 for _ in range(20)]
    rows = [(i, f"see {t} there") for i, t in enumerate(random_ + natural + repeated)]
    found = {r["doc_id"] for r in secret_scan.scan(documents(spark, rows)).collect() if r["spans"]}
    assert len(found & set(range(40))) >= 36  # the battery itself rejects a few of a thousand random ones
    assert len(found - set(range(40))) <= 2


def test_colliding_bucket_keys_lose_and_add_nothing(docs, monkeypatch):
    rule = jaccard.Rule(3, 90, 100)
    monkeypatch.setattr(jaccard, "KEY_BITS", 6)  # every bucket holds blocks of many bands
    out = jaccard.near_duplicates(docs, rule).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == _components(ROWS, rule)
