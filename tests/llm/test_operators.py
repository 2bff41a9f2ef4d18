"""The training-data operators beside brute force, on small hand-made and generated tables."""

import hashlib
import random
import sys
import time
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from altigrid.llm import (
    anchors, induced_sort, jaccard_join, mixing, packing, page_differencing, preferences, quality, suffix_dedup, topk, toxicity, warc,
)
from altigrid.llm.common import scratch, stored_place
from altigrid.llm.html_blocks import blocks

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Null text, empty text, null doc_id, equal rows, one doc_id with two texts, only blanks, short texts.
ODD = [
    (1, None, "en", "a", None), (2, "", None, None, 0), (None, "some words without a number here", "en", "a", 3),
    (4, "the same row twice over and over again", "en", "b", 5), (4, "the same row twice over and over again", "en", "b", 5),
    (5, "one id", "en", "b", 5), (5, "one id, other text", "en", "b", 5), (6, " \n\t ", "xx", "b", 5), (7, "the", "fr", "c", 3),
]


def words(rng, n):
    return [f"w{rng.randrange(60)}" for _ in range(n)]


@pytest.fixture(scope="module")
def texts():
    """Documents with exact and near copies, shared passages, periodic and long texts."""
    rng = random.Random(5)
    passage = " ".join(words(rng, 40))
    out = [" ".join(words(rng, rng.randrange(1, 90))) for _ in range(60)]
    out += [out[3]] * 3 + [passage + " " + t for t in out[:10]] + [" ".join([*out[20].split(), "extra"])]
    for k in range(12):
        near = (out[5] + " " + passage).split()
        near[k] = "changed"
        out.append(" ".join(near))
    out += ["abc " * 80, "a" * 400, "é" * 150 + "abc" * 60, "x" + "abc" * 60, " ".join(words(rng, 3000))]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "en", f"s{min(k % 7, 3)}", len(t)) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, DOCS).withColumns({"score": F.lit(1), "rank": F.lit("x"), "part": F.lit(2)})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# --- n-gram Jaccard join ----------------------------------------------------

def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def linked(texts, similarity=0.8):
    sets = [shingles(t) for t in texts]
    root, links = list(range(len(sets))), Counter()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and len(a & sets[j]) >= similarity * len(a | sets[j]) - 1e-12:
                links[i] += 1
                links[j] += 1
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return {k: (root[k], links[k]) for k in range(len(sets))}


@pytest.mark.parametrize("limit", [512, 4])
def test_join_finds_every_link(docs, texts, limit):
    """A small limit makes buckets recurse and then fall into tiles."""
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs, bucket_limit=limit).collect()}
    assert found == linked(texts)


def test_join_of_near_copies_compares_families_once(spark):
    """200 near copies of one text beside 60 that share half of it, in buckets of at most 16."""
    rng = random.Random(8)
    base = [f"t{i}" for i in range(120)]
    texts = []
    for _ in range(200):
        own = list(base)
        own[rng.randrange(120)] = f"x{rng.randrange(10**6)}"
        texts.append(" ".join(own))
    texts += [" ".join(base[:60] + [f"y{rng.randrange(10**6)}" for _ in range(60)]) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.jaccard_join(docs, bucket_limit=16).collect()}
    assert found == linked(texts)


def test_tiles_hold_every_pair_not_met_before(spark):
    """Members of 3 families and some strays in a bucket of 40, blocks of 8."""
    first = [1] * 20 + [2] * 9 + [3] * 4 + [9] * 7  # 9 is the bucket itself
    rows = [(9, k, f, 40) for k, f in enumerate(first)] + [(5, 100, 1, 2), (5, 101, 5, 2)]
    members = spark.createDataFrame(rows, "bucket long, rep long, first long, size long")
    families = jaccard_join._families(members.where("size > 8"), 8)
    tiles = {}
    for r in jaccard_join._tiles(members, families, 8).collect():
        tiles.setdefault((r.bucket, r.part_a, r.part_b), []).append((r.block, r.rep))
    met = Counter()
    for (bucket, a, b), own in tiles.items():
        for i, (x, p) in enumerate(own):
            for y, q in own[:i]:
                if a == b or x != y:
                    met[bucket, min(p, q), max(p, q)] += 1
    wanted = {
        (9, p, q) for p in range(40) for q in range(p + 1, 40) if not (first[p] == first[q] and first[p] in (1, 2))
    } | {(5, 100, 101)}
    assert set(met) == wanted and set(met.values()) == {1}


def test_join_leaves_only_its_result_in_the_scratch_folder(spark, docs):
    folder = Path(scratch(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    jaccard_join.jaccard_join(docs, bucket_limit=4)
    assert len(set(folder.iterdir()) - before) == 1


def test_join_keeps_odd_rows(odd, empty):
    found = jaccard_join.jaccard_join(odd).collect()
    assert len(found) == len(ODD)
    by = {(r.doc_id, r.class_id, r.n_links) for r in found}
    assert {(1, 1, 0), (2, 2, 0), (None, None, 0), (4, 4, 1), (6, 6, 0), (7, 7, 0)} <= by
    assert jaccard_join.jaccard_join(empty).count() == 0


def test_one_document_of_each_group_stays(docs, texts, odd):
    expected = {k for k, (root, _) in linked(texts).items() if k == root}
    kept = jaccard_join.keep_one(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == expected
    assert Counter(r.doc_id for r in jaccard_join.keep_one(odd).collect()) == Counter([1, 2, None, 4, 5, 6, 7])


def test_runs_follow_the_target():
    assert jaccard_join.runs_needed(0.999, 1) == 7 and jaccard_join.runs_needed(0.999, 3) == 15


# --- suffix-array dedup -----------------------------------------------------

def removed(texts, span):
    """Per text: bytes gone, runs, what is left; texts in order of doc_id."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - span + 1):
            window = raw[i:i + span]
            if window in seen:
                gone[i:i + span] = b"\1" * span
            seen.add(window)
        runs = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        left = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize("span", [100, 40])
def test_repeats_by_brute_force(docs, texts, span):
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removals(docs, span).collect()}
    assert [found[k] for k in range(len(texts))] == removed(texts, span)


def test_long_text_is_cut_with_overlap(spark, monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("abcd ") for _ in range(3000))
    text = text + text[500:900] + "zz" * 120
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)
    df = spark.createDataFrame([(1, text), (2, text[100:400])], "doc_id long, text string")
    pieces = []
    for part in suffix_dedup._pieces(df.select(F.col("doc_id").alias("did"), F.lit(0).alias("tie"), "text").toArrow().to_batches(), 100):
        pieces += part
    whole = Counter(hash(text.encode()[i:i + 100]) for i in range(len(text) - 99))
    cut = Counter(hash(p[3][i:i + 100]) for p in pieces if p[0] == 1 for i in range(len(p[3]) - 99))
    assert cut == whole


def test_suffix_dedup_of_odd_rows(odd, empty):
    long = "0123456789" * 3 + "abcdefghij" * 9
    rows = [(None, long, "x"), (3, long, "y"), (3, long, "y"), (3, long + "!", "z"), (9, None, None)]
    df = odd.sparkSession.createDataFrame(rows, "doc_id long, text string, did string").withColumn("tie", F.lit("clash"))
    found = sorted(((r.doc_id or 0, r.n_bytes, r.n_removed) for r in suffix_dedup.removals(df).collect()))
    assert found[0] == (0, 120, 0) and found[1] == found[2] == (3, 120, 120) and found[-1] == (9, 0, 0) and found[3][2] >= 120
    assert suffix_dedup.removals(odd).count() == len(ODD)
    assert suffix_dedup.removals(empty).count() == 0
    assert suffix_dedup.without_repeats(odd).columns == odd.columns


def test_equal_rows_without_an_earlier_copy_stay(spark):
    rng = random.Random(11)
    one, other = (" ".join(f"t{rng.randrange(10**6)}" for _ in range(60)) for _ in range(2))
    rows = [(None, one), (None, one), (7, other), (7, other), (8, "before " + other)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        found = [(r.doc_id, r.n_removed) for r in suffix_dedup.removals(df.repartition(parts)).collect()]
        assert Counter(found) == Counter({(None, 0): 2, (7, 0): 2, (8, len(other)): 1})
        assert Counter(r.text for r in suffix_dedup.without_repeats(df.repartition(parts)).collect()) == Counter({one: 2, other: 2, "before ": 1})


def test_hot_anchor_is_dealt_by_windows(spark, monkeypatch):
    """A passage under the span in many surroundings, some of them shared."""
    rng = random.Random(12)
    hot = "licensed under the terms that are stated in the file named above "
    around = ["".join(rng.choice("abcdefgh ") for _ in range(90)) for _ in range(40)]
    texts = [around[rng.randrange(40)] + hot + around[rng.randrange(40)] for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    monkeypatch.setattr(suffix_dedup, "SHARD", 2000)
    sizes = []
    sort = suffix_dedup._sorted_repeats

    def seen(rows, span):
        sizes.extend(r["n"] for r in rows.groupBy("anchor").agg(F.sum(F.length("bytes")).alias("n")).collect())
        return sort(rows, span)

    monkeypatch.setattr(suffix_dedup, "_sorted_repeats", seen)
    found = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removals(df).collect()}
    assert [found[k] for k in range(len(texts))] == removed(texts, 100)
    assert max(sizes, default=0) <= 2000


def test_cut_texts_stay_text(docs, texts):
    out = {r.doc_id: r for r in suffix_dedup.without_repeats(docs).collect()}
    expected = removed(texts, 100)
    for k, (_, gone, _, _) in enumerate(expected):
        if not gone:
            assert out[k].text == texts[k] and out[k].n_chars == len(texts[k])
        elif k in out:
            assert out[k].n_chars == len(out[k].text) < len(texts[k])


def test_suffix_order_and_prefixes_with_queues_on_disk():
    rng = np.random.default_rng(2)
    for _ in range(60):
        cap = int(rng.integers(1, 12))
        s = np.append(rng.integers(1, 1 + rng.integers(1, 5), rng.integers(1, 150)), 0).astype(np.int32)
        got = [(int(p), int(c)) for ps, cs in induced_sort.sorted_suffixes(s, cap, limit=20) for p, c in zip(ps, cs)]
        listed = s.tolist()
        assert [p for p, _ in got] == sorted(range(len(listed)), key=lambda i: listed[i:], reverse=True)
        for (a, _), (b, c) in zip(got, got[1:]):
            same = 0
            while same < cap and max(a, b) + same < len(listed) and listed[a + same] == listed[b + same]:
                same += 1
            assert same == c


def test_names_and_order_of_long_and_wide_substrings():
    rng = np.random.default_rng(4)
    rise = np.repeat(np.arange(1, 300), 2)
    for _ in range(20):
        tails = [np.concatenate([rise[:rng.integers(30, len(rise))], rng.integers(1, 4, rng.integers(0, 5)), [1]]) for _ in range(8)]
        s = np.append(np.concatenate(tails), 0).astype(np.int32)
        listed = s.tolist()
        assert induced_sort._order(s).tolist() == sorted(range(len(s)), key=lambda i: listed[i:])
        small = induced_sort.classify(s)
        lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
        ends = np.append(lms[1:], len(s) - 1) + 1
        parts = [list(zip(listed[a:b], small[a:b].tolist())) for a, b in zip(lms.tolist(), ends.tolist())]
        ranks = induced_sort.names(s, small, lms).tolist()
        assert all((ranks[i] < ranks[j]) == (parts[i] < parts[j]) for i in range(len(parts)) for j in range(len(parts)))


def test_order_of_names_takes_no_loop_over_places():
    s = np.append(np.tile(np.random.default_rng(5).integers(1, 1000, 200_000), 2), 0)
    calls = []

    def trace(frame, event, arg):
        calls.append(event)

    sys.setprofile(trace)
    try:
        order = induced_sort._order(s)
    finally:
        sys.setprofile(None)
    assert len(calls) < 20_000 and np.array_equal(np.sort(order), np.arange(len(s)))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(3)
    shared = rng.integers(0, 256, 150).astype(np.uint8)
    data = np.concatenate([rng.integers(0, 256, 90).astype(np.uint8), shared, shared, rng.integers(0, 256, 70).astype(np.uint8)])
    text, start, starts, anchor, _, _ = anchors.segments(data, np.array([0, 240, len(data)]), 100)
    of = {(int(t), int(i)): a for t, s, n, a in zip(text, start, starts, anchor) for i in range(s, s + n)}
    assert len(of) == (240 - 99) + (220 - 99)
    assert all(of[0, 90 + i] == of[1, i] for i in range(51))


# --- toxicity ---------------------------------------------------------------

@pytest.fixture(scope="module")
def marked():
    rng = random.Random(9)
    bad = ["blorptan", "blorpish", "blorping", "zukkel"]
    rows = []
    for k in range(700):
        toxic = int(k % 4 == 0)
        w = words(rng, rng.randrange(30, 200))
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((k, " ".join(w), toxic))
    return rows


def test_held_out_accuracy_and_unseen_forms(spark, marked):
    docs = spark.createDataFrame([(k, t) for k, t, _ in marked], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in marked], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert all(found[k].held_out == (zlib.crc32(str(k).encode()) % 5 == 0) for k, _, _ in marked)
    held = [(found[k].predicted, y) for k, _, y in marked if found[k].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)
    model = toxicity.train(docs, labels)
    clean = " ".join(words(random.Random(2), 80))
    assert model.score(clean + " blorpful " + clean) > model.score(clean)


def test_runs_start_at_every_word():
    """Words put in front of a text do not change how a phrase in it scores."""
    weight = np.full(toxicity.ROWS, -1.0, np.float32)
    weight[toxicity.grams("zukkel") + toxicity.grams("blorpish")] = 4.0
    model = toxicity.Model(weight, -1.0, 4)
    scores = [model.score(" ".join(["plain"] * k + ["zukkel", "blorpish"] + ["plain"] * 9)) for k in range(8)]
    assert max(scores) - min(scores) < 1e-9 and scores[0] > 0.5
    assert model.score("zukkel") > scores[0]


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(None, 1, 1), (5, 1, None), (4, 0, 1), (7, None, 0)], "doc_id long, quality int, toxic int")
    found = toxicity.toxicity(odd, labels).collect()
    assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
    none = toxicity.toxicity(odd, labels.limit(0)).collect()
    assert {(r.score < 1e-6, r.predicted) for r in none} == {(True, 0)}
    assert toxicity.toxicity(empty, labels).count() == 0
    assert toxicity.drop_toxic(odd, labels.limit(0)).columns == odd.columns


# --- packing ----------------------------------------------------------------

def test_dominance_counts_all_items():
    assert not packing._dominated(((300, 13),), ((3000, 1), (850, 1)))
    assert packing._dominated(((300, 12),), ((3000, 1), (850, 1)))
    assert packing._dominated(((7, 1000), (3, 500)), ((10, 500), (7, 500)))
    assert not packing._dominated(((7, 1001),), ((10, 500), (7, 500))) and packing._dominated((), ((1, 1),))


def test_search_widens_until_small_instances_are_best():
    rng = random.Random(12)

    def fits(lengths, rooms, capacity):
        if not lengths:
            return True
        x, rest, seen = lengths[0], lengths[1:], set()
        for k, r in enumerate(rooms):
            if r >= x and r not in seen:
                seen.add(r)
                if fits(rest, [*rooms[:k], r - x, *rooms[k + 1:]], capacity):
                    return True
        return False

    for _ in range(80):
        capacity = rng.randrange(10, 40)
        lengths = sorted((rng.randrange(1, capacity // 2 + 2) for _ in range(rng.randrange(1, 11))), reverse=True)
        counts = np.bincount(lengths, minlength=capacity + 1)
        found = sum(n for _, n in packing.complete_bins(counts, capacity))
        assert fits(lengths, [capacity] * found, capacity) and not fits(lengths, [capacity] * (found - 1), capacity)


def test_search_is_complete_and_no_worse_than_best_fit():
    rng = np.random.default_rng(4)
    for _ in range(40):
        capacity = int(rng.integers(5, 60))
        counts = np.bincount(rng.integers(1, capacity + 1, rng.integers(1, 60)), minlength=capacity + 1)
        patterns = packing.complete_bins(counts, capacity, budget=500)
        used = Counter()
        for items, n in patterns:
            assert sum(x * m for x, m in items) <= capacity and n > 0
            for x, m in items:
                used[x] += m * n
        assert all(used[x] == counts[x] for x in range(1, capacity + 1))
        bins = sum(n for _, n in patterns)
        assert packing.lower_bound(counts, capacity) <= bins <= sum(n for _, n in packing.best_fit(counts, capacity))


def test_search_beats_best_fit():
    counts = np.bincount([6, 5, 5, 4, 4, 3, 3], minlength=11)  # 6+4, 5+5, 4+3+3
    assert sum(n for _, n in packing.complete_bins(counts, 10)) == 3


def test_chunks_give_the_tokenizer_s_ids():
    ids = packing.chunk_ids(packing.vocabulary())
    odd = ["don't I'll WE'RE 's", "ABC123 ñandú Ünï ß ªº ²³ x²", "a\x0bb \x1c \x85 \xa0q", "<|endoftext|> hi", "日本 É é ‍", "", None, "ΣΑΣ İ", "a\x00b \x00"]
    got = [np.frombuffer(b, "<u4").tolist() for b in ids.of(odd)]
    assert got == [ids.tokenizer.encode(t or "", add_special_tokens=False).ids for t in odd]


def test_parts_cut_in_small_blocks_with_a_full_cache(monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", 300)
    rng = random.Random(3)
    marks = "abst'mdrevl LLS''  \n\t0123²¼ÀßÿØ×÷ªµº\xad.,;-\"(<|>é"
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(80))) for _ in range(400)]
    texts += ["don't've'll'LL 'see ''s x'", "a" * 1000, "b" * 290 + " c" * 10 + " " * 700, "", None, "日本 's"]
    ids = packing.ChunkIds(packing.vocabulary(), most=60)
    got = [np.frombuffer(b, "<u4").tolist() for b in ids.of(texts)]
    assert got == [ids.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(ids.known) <= 60


def test_common_parts_stay_when_the_cache_is_full(monkeypatch):
    ids = packing.ChunkIds(packing.vocabulary(), most=50)
    for k in range(6):
        ids.of(["the rain, and the sea " + " ".join(chr(97 + k) + chr(97 + i) * 3 for i in range(26))])
    ids.of([" ".join(f"only{chr(97 + i)}{chr(97 + j)}" for i in range(8) for j in range(26)) + " the rain, and the sea"])
    monkeypatch.setattr(ids, "_learn", lambda parts: pytest.fail(f"encoded again: {parts}"))
    got = np.frombuffer(ids.of(["The sea, and the rain"])[0], "<u4").tolist()
    assert got == ids.tokenizer.encode("The sea, and the rain", add_special_tokens=False).ids


def test_pieces_fill_sequences_without_gaps(docs, odd, empty, texts):
    found = packing.pack(docs, capacity=64, with_ids=True).collect()
    tokenizer = packing.chunk_ids(packing.vocabulary()).tokenizer
    for k, text in enumerate(texts):
        own = sorted((r for r in found if r.doc_id == k), key=lambda r: r.piece)
        ids = np.concatenate([np.frombuffer(r.ids, "<u4") for r in own])
        assert ids.tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
        assert [r.start for r in own] == [64 * i for i in range(len(own))] and all(r.length == 64 for r in own[:-1])
        assert all(r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length for r in own)
    sequences = {}
    for r in found:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))] and sum(n for _, n in parts) <= 64
    counts = np.bincount([r.length for r in found], minlength=65)
    assert len(sequences) == packing.lower_bound(counts, 64)
    assert packing.pack(odd).count() == len(ODD) and packing.pack(empty).count() == 0


# --- mixing -----------------------------------------------------------------

def test_schedule_deviates_by_less_than_one_block():
    rng = random.Random(6)
    for _ in range(30):
        parts = [rng.randrange(1, 60) for _ in range(rng.randrange(1, 9))]
        order, done, total = list(mixing.slots(parts, parts)), Counter(), sum(parts)
        assert Counter(order) == Counter({s: p for s, p in enumerate(parts)})
        for t, s in enumerate(order, 1):
            done[s] += 1
            assert all(abs(done[k] - t * p / total) < 1 for k, p in enumerate(parts))


def test_any_stretch_of_slots_is_that_of_one_pass():
    rng = random.Random(8)
    for _ in range(300):
        n = rng.randrange(1, 12)
        blocks = [rng.randrange(rng.choice([2, 5, 40])) for _ in range(n)]
        weights = [rng.choice([rng.random() + 1e-3, float(rng.randrange(1, 4)), blocks[s] + 0.5]) for s in range(n)]
        whole = list(mixing.Ideal(blocks, weights).deal(0, sum(blocks)))
        ideal, chunk = mixing.Ideal(blocks, weights), rng.randrange(1, 20)
        starts = list(range(0, sum(blocks), chunk))
        rng.shuffle(starts)
        for first in starts:
            assert list(ideal.deal(first, first + chunk)) == whole[first:first + chunk]


def test_a_stretch_far_into_many_blocks_deviates_by_less_than_one():
    rng = random.Random(9)
    blocks, weights = [rng.randrange(10**9, 10**10) for _ in range(40)], [rng.random() for _ in range(40)]
    ideal, first = mixing.Ideal(blocks, weights), 30 * 10**9 + 7
    done = ideal.state(first)
    for t, (s, j) in enumerate(ideal.deal(first, first + 300), first + 1):
        assert j == done[s]
        done[s] += 1
        assert all(whole <= n <= whole + within for n, (whole, within) in zip(done, ideal.given(t)))


@pytest.mark.parametrize("weights", [None, {"s0": 0.5, "s1": 0.25, "s3": 0.25, "gone": 3.0}])
def test_mix_is_whole_and_in_step(docs, texts, weights):
    rows = mixing.mix(docs, weights, block_docs=2, period=20).collect()
    assert sorted(r.doc_id for r in rows) == list(range(len(texts)))
    slots = {}
    for r in rows:
        slots.setdefault(r._slot, []).append(r)
    assert sorted(slots) == list(range(len(slots)))
    for own in slots.values():
        assert len({r.source for r in own}) == 1 and sorted(r._place for r in own) == list(range(len(own)))
    again = mixing.mix(docs.repartition(5), weights, block_docs=2, period=20).collect()
    assert {r.doc_id: (r._slot, r._place) for r in again} == {r.doc_id: (r._slot, r._place) for r in rows}


def ideal_mix(blocks, weights):
    """Blocks of each source after each slot, when every slot is shared by weight among the sources that still have some."""
    got = np.zeros(len(blocks))
    yield got
    for _ in range(int(sum(blocks))):
        left = 1.0
        while left > 1e-9:
            live = got < blocks - 1e-9
            share = np.where(live, weights, 0.0)
            share = share / share.sum()
            step = min(left, ((blocks - got)[live] / share[live]).min())
            got = np.where(live, np.minimum(got + step * share, blocks), got)
            left -= step
        yield got


@pytest.mark.parametrize("n_sources", [20, 260])
def test_mix_stays_within_one_block_of_the_weights(spark, n_sources):
    rng = random.Random(13)
    sizes = [400, *(rng.randrange(1, 12) for _ in range(n_sources - 1))]
    wanted = [0.5, *(0.5 * rng.random() / n_sources for _ in range(n_sources - 1))]
    rows = [(k, f"s{s}") for k, s in enumerate(s for s, n in enumerate(sizes) for _ in range(n))]
    df = spark.createDataFrame(rows, "doc_id long, source string").repartition(3)
    found = mixing.mix(df, {f"s{s}": w for s, w in enumerate(wanted)}, block_docs=1, chunk=300).collect()
    assert sorted(r._slot for r in found) == list(range(len(rows))) and all(r._mixed_as == r.source for r in found)
    done = np.zeros(n_sources)
    states = ideal_mix(np.array(sizes, float), np.array(wanted))
    next(states)
    for r, goal in zip(sorted(found, key=lambda r: r._slot), states):
        done[int(r.source[1:])] += 1
        assert np.abs(done - goal).max() < 1 + 1e-6


def test_mix_of_odd_rows(odd, empty):
    assert mixing.mix(odd, block_docs=1).select("_slot").distinct().count() == len(ODD)
    assert mixing.mix(empty).count() == 0 and mixing.in_order(odd).columns == odd.columns


# --- exact top-k search -----------------------------------------------------

def nearest(rows, k):
    fine = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, a in fine:
        if q % 100 == 0:
            scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in fine if i != q and len(a) == len(b)))[:k]
            out += [(q, n, i, -s) for n, (s, i) in enumerate(scores, 1)]
    return sorted(out)


def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 8)
    rng = random.Random(8)
    rows = [(k, [round(rng.uniform(-1, 1), 2) for _ in range(4)]) for k in range(150)]
    rows += [(1000 + k, [0.5, 0.5, 0.5, 0.5]) for k in range(60)]
    rows += [(300, None), (400, []), (500, [1.0, None, 0.0, 0.0]), (501, [float("nan")] * 4), (502, [float("inf"), 0.0, 0.0, 0.0])]
    rows += [(None, [1.0] * 4), (700, [1.0, 2.0]), (701, [3.0, -1.0]), (800, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "id long, v array<float>").repartition(3)
    df32 = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    found = sorted(tuple(r) for r in topk.top_k(df, df.where("id % 100 = 0"), 7).select("query_id", "rank", "vec_id", "score").collect())
    assert found == nearest(df32, 7)
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_products_beyond_doubles_stay_exact():
    big = np.array([[2**31 - 1, 2**31 - 1]], np.int64)
    assert topk._products(big, big)[0, 0] == 2 * (2**31 - 1) ** 2


# --- page differencing ------------------------------------------------------

PAGE = """<body><header>Top</header><nav>menu</nav><div id="cookie-banner">We use <b>cookies</b></div><main><h1>T &amp; t</h1>
<div class="content">A<br>b<p>x<span>\n y</span></p><div class="share-bar"><div>z</div></div>after</div><form>f</form>
<section id="comments"><p>c1</p></section></main><aside>s</aside><script>var a="</p>";</script><footer>f</footer></body>"""


def test_markup_is_left_out():
    assert [b.text for b in page_differencing.main_blocks(blocks(PAGE))] == ["T & t", "A b", "x y", "after"]
    assert blocks(None) == [] and blocks("") == [] and blocks("a < b <p>c") != []


@pytest.mark.parametrize("page, kept", [
    ("<html><head><title>t</title><meta charset=x><body><p>all<p>text", ["all", "text"]),
    ("<title>t</title><noscript>off<p>one</p><svg><path d=x><p>two</p><select><option>o<p>three</p>", ["one", "two", "three"]),
    ("<noscript><p>off</p></noscript><template><div>x</div></template><p>on</p>", ["on"]),
    ("<article><p class=notice>n<p>one<p>two</article>", ["one", "two"]),
    ("<article><ul><li class=share>s<li>one</ul><p>two</article>", ["one", "two"]),
    ("<article><ul><li>one<li class=share>s</ul><p>two</article>", ["one", "two"]),
    ("<div class=ad>a<article><p>one</article>", ["one"]),
    ("<aside>a<article><div>one</div></article><footer>f</footer>", ["one"]),
    ("<main>m<aside><article>other</article></aside></main>", ["m"]),
    ("<aside><article>other</article></aside><p>one", ["one"]),
    ("<article>one<article class=comment>c</article>two</article>", ["one", "two"]),
])
def test_omitted_end_tags_lose_no_text(page, kept):
    assert [b.text for b in page_differencing.main_blocks(blocks(page))] == kept


@pytest.mark.parametrize("part", [
    "<a ", '<a "', "<a '\"", '<a "\'>', '<a x="<">', "<script ", "<svg ", "<svg><p>", "<title>", "<!-- ", "</ ", "<html ", '<a href="', "<div class=ad><article></article>",
    "&#123456789",
])
def test_long_malformed_pages_take_linear_time(part):
    for page in (part * (300_000 // len(part)), part * (300_000 // len(part)) + ">"):
        start = time.process_time()
        blocks(page)
        rows = warc.derivatives("r", "u", "d", b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page.encode())
        assert len(rows) == 2 and time.process_time() - start < 10


@pytest.mark.parametrize("page, text", [
    ('<p>a<b title="x>y">c</b><p class="a<b">d<!-- z', ["ac", "d"]),
    ("x<script>a>b", ["x"]), ("<p>k</p> tail <b", ["k", "tail <b"]), ('<p class="x>one<p>two', ["one", "two"]),
    ("&#" + "9" * 5000 + ";&#" + "0" * 5000 + "65;", ["\ufffdA"]),
])
def test_odd_tags_and_references(page, text):
    assert [b.text for b in blocks(page)] == text


def test_class_words_tell_only_where_they_name_a_place():
    stays = ['<p class="form">', '<p class="lead login">', '<div id="notice-of-death">', '<div data-class="ad">', '<h2 class="header">', '<div class="address">']
    goes = ['<p class="ad-slot-2">', '<div class="readercomments">', '<div class="cookieBanner">', '<div class="site-header">', '<ul id="share_buttons">', '<div role="search">']
    page = "".join(f"<article>{tag}{k}</{tag[1:].split()[0]}></article>" for k, tag in enumerate(stays + goes))
    assert [b.text for b in page_differencing.main_blocks(blocks(page))] == [str(k) for k in range(len(stays))]


def test_common_lines_of_long_pages_in_halves():
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(40))] for _ in range(2))
        whole, halves = page_differencing.common_lines(a, b), page_differencing.common_lines(a, b, most_bits=20)
        rest = iter(b)
        assert len(whole) == len(halves) and halves == sorted(set(halves)) and all(a[k] in rest for k in halves)


def test_shared_lines_of_neighbours_go(spark):
    def page(*lines):
        return "".join(f"<p>{x}</p>" for x in lines)

    rows = [
        (1, "http://a.org/x/1", page("Site name", "first story", "all rights")),
        (2, "http://a.org/x/2", page("Site name", "second story", "told at length", "all rights")),
        (3, "http://a.org/y/copy", page("one", "two", "three", "four", "five")),
        (4, "http://a.org/y/copy?b=1", page("one", "two", "three", "four", "five")),
        (5, "http://b.org/x/1", page("Site name", "alone")),
        (6, None, None), (6, None, None), (None, "odd url", "<article><p>Site name</p></article>"), (7, "http://a.org/x/2b", ""),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("key", F.lit("clash"))
    found = {(r.page_id, r.url): (r.text, r.n_chars) for r in page_differencing.main_text(df).collect()}
    assert found[1, "http://a.org/x/1"] == ("first story", 11)
    assert found[3, "http://a.org/y/copy"] == found[4, "http://a.org/y/copy?b=1"] == ("one\ntwo\nthree\nfour\nfive", 23)
    assert found[5, "http://b.org/x/1"][0] == "Site name\nalone" and found[6, None] == ("", 0) and found[None, "odd url"][0] == "Site name"
    assert page_differencing.main_text(df).count() == len(rows) and page_differencing.main_text(df.limit(0)).count() == 0


def test_every_page_is_paired_and_the_markup_checks_after(spark, monkeypatch):
    menu = "<nav>" + "".join(f"<p>menu {k}</p>" for k in range(40)) + "</nav>"
    furniture = "".join(f"<p>unmarked {k}</p>" for k in range(8))
    own = lambda name: "".join(f"<p>{name} {k}</p>" for k in range(3))
    article = lambda name: f"{menu}<article><p>refrain</p>{own(name)}</article>"
    rows = [
        (1, "http://a.org/x/1", menu + furniture + own("one")), (2, "http://a.org/x/2", menu + own("two") + furniture),
        (3, "http://b.org/x/1", article("three")), (4, "http://b.org/x/2", article("four")),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    judged = []
    shared = page_differencing._shared
    monkeypatch.setattr(page_differencing, "_shared", lambda ranked: judged.append(found := shared(ranked)) or found)
    found = {r.page_id: r.text for r in page_differencing.main_text(df).collect()}
    # Menus do not make a pair a copy; the pair judges articles too, whose lines the check keeps.
    assert found[1] == "one 0\none 1\none 2" and found[2] == "two 0\ntwo 1\ntwo 2"
    assert found[3] == "refrain\nthree 0\nthree 1\nthree 2"
    refrain = [page_differencing.line_hash("refrain")]
    assert sorted(len(r.gone) for r in judged[0].collect()) == [1, 1, 8, 8]
    assert sum(r.gone == refrain for r in judged[0].collect()) == 2


def test_common_lines_are_a_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found, rest = page_differencing.common_lines(a, b), iter(b)
        assert len(found) == best[-1][-1] and all(a[k] in rest for k in found)


# --- WARC -------------------------------------------------------------------

def test_derivatives_link_back(spark, tmp_path):
    rows = [(1, "http://a.org/1", PAGE), (2, None, None), (2, None, None), (None, "http://a.org/3", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("block", F.lit("clash"))
    responses = warc.page_responses(pages)
    records = warc.derive(responses)
    found = records.collect()
    assert Counter(r.warc_type for r in found) == {"metadata": 4, "conversion": 4}
    sources = {r.record_id: bytes(r.content) for r in responses.collect()}
    for r in found:
        content = sources[r.refers_to]
        assert r.source_block_digest == warc.digest(content) and r.source_payload_digest == warc.digest(content.partition(b"\r\n\r\n")[2])
        assert r.block_digest == warc.digest(bytes(r.block)) and bytes(r.record).endswith(bytes(r.block) + b"\r\n\r\n")
    first = {r.warc_type: r for r in found if r.target_uri == "http://a.org/1"}
    assert bytes(first["conversion"].block).decode().splitlines()[:2] == ["Top", "menu"]
    assert f"conversion-id: {first['conversion'].record_id}" in bytes(first["metadata"].block).decode()
    warc.write_records(records, str(tmp_path / "warc"))
    back = {r.headers["WARC-Record-ID"]: r for r in warc.read_records(spark, str(tmp_path / "warc")).collect()}
    for r in found:
        assert back[r.record_id].headers["WARC-Refers-To"] == r.refers_to and back[r.record_id].headers["WARC-Block-Digest"] == r.block_digest
        assert back[r.record_id].block.encode() == bytes(r.block)
    assert warc.derive(responses.limit(0)).count() == 0


def test_responses_without_html():
    rows = warc.derivatives("<urn:uuid:1>", "http://a.org", None, b"HTTP/1.1 404 Gone\r\nContent-Type: image/png\r\n\r\n\x89PNG")
    assert rows[1][10] == b"" and b"http-status: HTTP/1.1 404 Gone" in rows[0][10]
    assert [r[10] for r in warc.derivatives(None, None, None, None)][1] == b""


# --- preferences ------------------------------------------------------------

def rendered(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def test_prefix_prompt_and_masks(spark):
    turns = "pair_id long, side string, turn long, role string, text string"
    rows = [(1, s, 0, "system", "be kind") for s in ("chosen", "rejected")] + [(1, s, 1, "user", "hi") for s in ("chosen", "rejected")]
    rows += [(1, "chosen", 2, "assistant", "hé"), (1, "chosen", 3, "user", "more"), (1, "chosen", 4, "assistant", "ok"), (1, "rejected", 2, "assistant", "no")]
    rows += [(2, s, 0, "user", None) for s in ("chosen", "rejected")] + [(3, "chosen", 0, "assistant", "only")]
    found = {r.pair_id: r for r in preferences.format_pairs(preferences.pairs_of(spark.createDataFrame(rows, turns))).collect()}
    one = found[1]
    assert one.prefix_turns == 2 and one.prompt == rendered([("system", "be kind"), ("user", "hi")])
    assert one.chosen == rendered([("assistant", "hé"), ("user", "more"), ("assistant", "ok")])
    spans = [tuple(map(int, s.split("-"))) for s in one.chosen_mask.split(",")]
    assert [one.chosen[a:b] for a, b in spans] == ["hé<|end|>\n", "ok<|end|>\n"]
    assert one.rejected[slice(*map(int, one.rejected_mask.split("-")))] == "no<|end|>\n"
    assert (found[2].prefix_turns, found[2].chosen, found[2].rejected, found[2].chosen_mask) == (1, "", "", "")
    assert (found[3].prefix_turns, found[3].prompt, found[3].rejected) == (0, "", "")


def test_rows_without_conversation_and_empty_tables(spark):
    schema = "conv_id long, turn long, role string, text string"
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (1, None, None, None), (1, 0, "assistant", "x"), (1, 0, "assistant", "x"), (2, 1, "assistant", "y")]
    df = spark.createDataFrame(rows, schema).withColumns({"reply": F.lit(1), "turns": F.lit("clash")})
    found = preferences.format_pairs(preferences.swapped_replies(df)).collect()
    assert len(found) == 4 and preferences.format_pairs(preferences.swapped_replies(df.limit(0))).count() == 0
    one = next(r for r in found if r.pair_id == 1)
    assert one.prefix_turns == 2 and one.chosen == rendered([("assistant", "x")]) and one.rejected == rendered([("assistant", "y")])


def test_preferences_are_native(spark, plan):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    text = plan(preferences.format_pairs(preferences.swapped_replies(df)))
    assert "Python" not in text and "Arrow" not in text


# --- quality ----------------------------------------------------------------

def counts_of(text):
    import re

    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_base_counts_by_brute_force(spark, texts, odd, empty):
    rows = [t + "\n#x|y\n" + t[:40] + "\n\n#x|y  é" for t in texts] + ["a b c d e f " * 9, "\n\n", "x\x0by\x0cz\x1c"]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(rows)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality.judge(df).collect()}
    for k, text in enumerate(rows):
        r = found[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts_of(text)
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words) and not (r.base_failed and r.kept)
    assert quality.judge(odd).count() == len(ODD) and quality.judge(empty).count() == 0


def test_divergent_texts_are_told_apart(spark):
    rng = random.Random(4)
    prose = [" ".join(rng.choice(["the", "of", "and", *(f"word{chr(97 + k)}" for k in range(20))]) for _ in range(120)) for _ in range(60)]
    junk = "".join(f"{t.upper()}$!! " for t in prose[0].split())
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate([*prose, junk])], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in quality.judge(df).collect() if not r.base_failed}
    assert all(kept[k] for k in kept if k < 60) and not kept[60]


def test_distance_is_jensen_shannon(spark):
    p, q = [0.5, 0.5, 0.0], [0.25, 0.25, 0.5]
    m = [(a + b) / 2 for a, b in zip(p, q)]
    kl = lambda x: sum(a * np.log2(a / b) for a, b in zip(x, m) if a)
    row = spark.createDataFrame([(p, q)], "p array<double>, q array<double>").select(quality.divergence(F.col("p"), F.col("q")).alias("d")).first()
    assert row.d == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))


# --- names of other columns, and order through files -------------------------

def test_other_columns_may_have_any_name(spark):
    text = " ".join(f"word{i}" for i in range(40))
    names = ["doc_id", "text", "source", "did", "tie", "spans", "_removed", "_kept", "_new", "_group", "_nth", "_draw", "_slot", "_part", "rep", "at"]
    rows = [(k, f"{k} {text}", f"s{k % 2}", *(k * 100 + j for j in range(len(names) - 3))) for k in range(6)]
    docs = spark.createDataFrame(rows, names)
    expected = {r[0]: r[2:] for r in rows}
    for result in (suffix_dedup.without_repeats(docs), mixing.in_order(docs, block_docs=1), jaccard_join.keep_one(docs)):
        assert result.columns == names
        found = result.collect()
        assert found and all(tuple(r)[2:] == expected[r.doc_id] for r in found)
    mixed = mixing.mix(docs, block_docs=1)
    assert mixed.columns == [*(n for n in names if n != "_slot"), "_slot", "_place", "_mixed_as"]
    assert sorted(r._slot for r in mixed.collect()) == list(range(6))


def test_packing_follows_the_order_of_places(spark, docs, odd, empty, texts):
    """Equal lengths are taken by place, sequence ids rise with their first piece, the packing is as good."""
    rng = random.Random(21)
    places = list(range(len(texts)))
    rng.shuffle(places)
    given = spark.createDataFrame([(k, t, places[k]) for k, t in enumerate(texts)], "doc_id long, text string, at long").repartition(5)
    found = packing.pack(given, capacity=64, in_order=True).collect()
    plain = packing.pack(docs, capacity=64).collect()
    assert len({r.sequence_id for r in found}) == len({r.sequence_id for r in plain})
    assert Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in found) == Counter((r.doc_id, r.piece, r.length, r.ids_crc32) for r in plain)
    first = {}
    for r in found:
        at = places[r.doc_id], r.piece
        first[r.sequence_id] = min(first.get(r.sequence_id, at), at)
    assert [first[s] for s in sorted(first)] == sorted(first.values())
    numbered = [d.withColumn("at", F.monotonically_increasing_id()) for d in (odd, empty)]
    assert [packing.pack(d, in_order=True).count() for d in numbered] == [len(ODD), 0]


def test_place_in_files_is_the_order_written(spark, tmp_path):
    rows = spark.range(1000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text")).orderBy(F.col("doc_id").desc())
    rows.repartitionByRange(7, F.col("doc_id").desc()).sortWithinPartitions(F.col("doc_id").desc()).write.parquet(str(tmp_path / "t"))
    back = stored_place(spark.read.parquet(str(tmp_path / "t")), "doc_id", name="at")
    assert [r.doc_id for r in back.orderBy("at").collect()] == list(range(999, -1, -1))
    loose = stored_place(spark.createDataFrame([(1,), (2,)], "doc_id long"), "doc_id", name="at")
    assert len({r["at"] for r in loose.collect()}) == 2
