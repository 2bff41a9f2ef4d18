"""Token files, whitening and hard negatives beside brute force."""

import io
import math
import random
import zlib

import numpy as np
import pytest
import xxhash
import zstandard
from pyspark.sql import functions as F

from altigrid.llm import hard_negatives, packing, token_frames, whitening
from altigrid.llm.queries import op11_token_frames, op12_whitening
from altigrid.llm.spectrum import count_above, leading
from tests.conftest import SMALL

DOCS = "doc_id long, text string"
VECTORS = "vec_id long, label int, embedding array<float>"


# --- token files -------------------------------------------------------------

def ids_of(texts):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(packing.vocabulary())
    return [known.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


def random_docs(rng, n, longest):
    return [(k, np.array([rng.randrange(49_000) for _ in range(rng.randrange(longest))], "<u4").tobytes()) for k in range(n)]


@pytest.mark.parametrize("width", [2, 4])
@pytest.mark.parametrize("frame_ids", [1, 7, 1000])
def test_file_round_trip(width, frame_ids):
    docs = random_docs(random.Random(frame_ids), 60, 40) + [(None, b""), (-5, b"\x01\0\0\0")]
    out = io.BytesIO()
    writer = token_frames.FrameWriter(out, width, frame_ids)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    assert writer.n_bytes == len(out.getvalue())
    reader = token_frames.FrameReader(out, len(out.getvalue()))
    found = dict(reader.documents(np.arange(len(docs))))
    assert [found[k] for k in range(len(docs))] == [ids for _, ids in docs]
    assert [d if k else None for d, k in zip(reader.doc_ids, reader.known)] == [d for d, _ in docs]


def test_file_is_seekable_zstandard():
    docs = random_docs(random.Random(1), 20, 300)
    out = io.BytesIO()
    writer = token_frames.FrameWriter(out, 2, 500)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    raw = out.getvalue()
    plain = b"".join(np.frombuffer(ids, "<u4").astype("<u2").tobytes() for _, ids in docs)
    # A reader that knows nothing of the index or the seek table gets the ids.
    assert zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read() == plain
    n, flags, magic = int.from_bytes(raw[-9:-5], "little"), raw[-5], int.from_bytes(raw[-4:], "little")
    assert (flags, magic) == (0x80, 0x8F92EAB1)
    at, done = 0, 0
    for k in range(n):
        size, length, check = (int.from_bytes(raw[len(raw) - 9 - 12 * (n - k) + 4 * j:][:4], "little") for j in range(3))
        assert xxhash.xxh64_intdigest(plain[done:done + length]) & 0xFFFFFFFF == check
        if length:
            assert zstandard.ZstdDecompressor().decompress(raw[at:at + size]) == plain[done:done + length]
        at, done = at + size, done + length
    assert done == len(plain)


def test_only_the_frames_of_a_document_are_read_and_sums_are_checked():
    docs = [(k, np.full(50, k, "<u4").tobytes()) for k in range(100)]
    out = io.BytesIO()
    writer = token_frames.FrameWriter(out, 4, 100)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    writer.close()
    reader = token_frames.FrameReader(out, len(out.getvalue()))
    assert dict(reader.documents(np.array([41, 77]))) == {41: docs[41][1], 77: docs[77][1]}
    assert reader.frames_read == 2 and len(reader.table) == 51
    broken = bytearray(out.getvalue())
    broken[int(reader.offsets[20]) + int(reader.table["size"][20]) - 2] ^= 1
    reader = token_frames.FrameReader(io.BytesIO(bytes(broken)), len(broken))
    assert dict(reader.documents(np.array([77])))[77] == docs[77][1]
    with pytest.raises((ValueError, zstandard.ZstdError)):
        dict(reader.documents(np.array([41])))


def test_tables_of_tokens(spark, tmp_path):
    rng = random.Random(3)
    words = ["alpha", "Beta", "été", "don't", "42", "漢字", "<|endoftext|>", "x" * 30]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(30))) for _ in range(60)]
    rows = [(k * 3 - 40, t) for k, t in enumerate(texts)] + [(1000, None), (1001, ""), (1002, " \n "), (5, "again"), (5, "again"), (None, "no number"), (2000, "long text " * 9000)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, DOCS).repartition(3).withColumns({"start": F.lit(1), "part": F.lit(2), "file": F.lit("x"), "_row": F.lit(0)})
    path = str(tmp_path / "t")
    token_frames.write_tokens(docs, path, packing.vocabulary(), frame_ids=64, file_ids=500)
    assert token_frames.manifest(spark, path).count() > 5
    found = sorted(token_frames.read_tokens(spark, path).collect(), key=lambda r: r.start)
    wanted = sorted(zip(ids_of([t for _, t in rows]), [d for d, _ in rows]), key=lambda p: (p[1] is not None, p[1] or 0))
    assert [r.doc_id for r in found] == [d for _, d in wanted]
    start = 0
    by_id = {d: ids for ids, d in wanted if d != 5}
    for r in found:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert (r.start, r.n_tokens) == (start, len(ids))
        start += len(ids)
        assert r.doc_id == 5 or ids == by_id[r.doc_id]
    asked = spark.createDataFrame([(2000,), (-40,), (5,), (77_777,), (None,)], "doc_id long")
    some = token_frames.fetch_tokens(spark, path, asked).collect()
    assert sorted(r.doc_id for r in some) == sorted([2000, -40, 5, 5] + [r.doc_id for r in found if r.doc_id == 5][2:])
    assert all((r.start, bytes(r.ids)) in {(f.start, bytes(f.ids)) for f in found} for r in some)


def test_no_documents_no_tokens(spark, tmp_path):
    token_frames.write_tokens(spark.createDataFrame([], DOCS), str(tmp_path / "e"), packing.vocabulary())
    assert token_frames.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_token_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    found = {r.doc_id: r for r in op11_token_frames(spark, SMALL).collect()}
    start = 0
    for d, ids in zip(docs, ids_of([d.text for d in docs])):
        r = found.pop(d.doc_id)
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not found


# --- whitening ---------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 5, 24])
@pytest.mark.parametrize("kind", ["noise", "one direction", "equal", "graded", "few", "ties"])
def test_slices_of_the_spectrum(n, kind):
    rng = np.random.default_rng(n)
    a = rng.normal(size=(3 * n + 2, n))
    if kind == "one direction":
        a[:] = a[:, [0]]
    if kind == "equal":
        a = 3 * np.eye(n)
    if kind == "graded":
        a = a * np.logspace(0, -5, n)
    if kind == "few":
        a = rng.integers(-3, 3, size=(3, n)).astype(float)
    v = a.T @ a
    if kind == "ties":
        v = np.diag([5.0] * min(n, 3) + [1.0] * max(n - 3, 0))
    every = np.linalg.eigvalsh(v)[::-1]
    values, vectors = leading(v)
    assert len(values) == min(4, (every > 1e-12 * every[0] * n).sum())
    assert np.allclose(values, every[:len(values)], rtol=1e-12 * n, atol=1e-13 * every[0] * n)
    assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-10)
    assert np.abs(v @ vectors.T - vectors.T * values).max() <= 1e-12 * n * every[0]
    for s in [*((every[1:] + every[:-1]) / 2)[:3], every[0] * 1.1, -1.0]:
        assert count_above(v, s) == (every > s).sum() or np.abs(every - s).min() < 1e-9 * every[0]


def whitened_by_numpy(x, most=4):
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    v = centred.T @ centred / n
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    return n, ((n * x - sums) ** 2).sum(axis=1), (x - sums / n) @ axes / np.sqrt(values), values / np.trace(v)


def check_whitening(rows, found, dim):
    good = [(i, e) for i, e in rows if e is not None and len(e) == dim and all(c is not None and math.isfinite(c) for c in e)]
    x = np.array([[math.floor(256 * float(np.float32(c))) for c in e] for _, e in good])
    n, deviation, w, explained = whitened_by_numpy(x, min(4, dim))
    of = sorted((r for r in found), key=lambda r: (r.deviation, r.component, r.whitened))
    assert len(of) == len(good) * min(4, dim) and {r.n for r in of} == {n}
    assert all(r.identity_error <= 1e-9 for r in of)
    by_row = {}
    for r in found:
        by_row.setdefault(r.vec_id, []).append(r)
    signs = None
    for k, (vec_id, _) in enumerate(good):
        own = sorted(by_row[vec_id], key=lambda r: r.component)[::max(1, len(by_row[vec_id]) // min(4, dim))]
        assert [r.deviation for r in own] == [int(deviation[k])] * len(own)
        if signs is None and np.abs(w[k]).min() > 0.01:
            signs = np.sign([r.whitened for r in own]) * np.sign(w[k])
    for k, (vec_id, _) in enumerate(good):
        own = sorted(by_row[vec_id], key=lambda r: r.component)[::max(1, len(by_row[vec_id]) // min(4, dim))]
        assert np.allclose([r.whitened for r in own], signs * w[k], atol=1e-7)
        assert np.allclose([r.explained for r in own], explained, rtol=1e-9)


def test_whitening(spark):
    rng = np.random.default_rng(0)
    rows = [(k, (100 + rng.normal(size=6) * [5, 3, 2, 1, 0.5, 0.2]).astype(np.float32).tolist()) for k in range(300)]
    rows += [(300 + k, rows[7][1]) for k in range(100)]  # copies count once in the fit
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] + [0.0] * 5), (903, [float("-inf")] + [0.0] * 5), (904, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).withColumns({"x": F.lit(1), "dim": F.lit("a"), "n": F.lit(0)})
    check_whitening(rows, whitening.whiten(df).collect(), 6)


def test_whitening_of_lengths_apart_and_of_nothing(spark):
    rng = np.random.default_rng(1)
    rows = [(k, rng.normal(size=2 + k % 2).astype(np.float32).tolist()) for k in range(80)] + [(500, [1.0] * 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = whitening.whiten(df).collect()
    for dim in (2, 3):
        own = {i for i, e in rows if len(e) == dim}
        check_whitening(rows, [r for r in found if r.vec_id in own], dim)
    assert 500 not in {r.vec_id for r in found}  # a single vector has no spread
    assert whitening.whiten(df.where("false")).count() == 0
    numberless = spark.createDataFrame([(None, e) for _, e in rows if len(e) == 2], "vec_id long, embedding array<float>")
    assert whitening.whiten(numberless).count() == 80


def test_whitening_query(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    check_whitening(rows, op12_whitening(spark, SMALL).collect(), len(rows[0][1]))


# --- hard negatives ----------------------------------------------------------

def negatives_by_loops(rows, every, scale=256):
    good = [(i, lab, [math.floor(scale * float(np.float32(c))) for c in e]) for i, lab, e in rows
            if i is not None and lab is not None and e and all(c is not None and math.isfinite(c) for c in e)]
    out = []
    for at, (anchor, label, x) in enumerate(good):
        if anchor % every:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), i, lab) for k, (i, lab, y) in enumerate(good) if k != at and len(y) == len(x)))
        for score, positive, _ in [s for s in scored if s[2] == label][:5]:
            p = -score
            fit = [(i, -s) for s, i, lab in scored if lab != label and 30 * p <= -100 * s <= 90 * p][:10]
            out += [(anchor, positive, rank, i, p, s) for rank, (i, s) in enumerate(fit, 1)]
    return sorted(out)


def mined(df, every):
    rows = df.selectExpr("vec_id AS id", "label", "embedding AS v")
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(rows, F.expr(f"id % {every} = 0")).collect())


@pytest.fixture
def small_steps(monkeypatch):
    monkeypatch.setattr(hard_negatives, "MEMBERS", 7)
    monkeypatch.setattr(hard_negatives, "STEP", 5)
    monkeypatch.setattr(hard_negatives, "PER_CENTRE", 8)
    monkeypatch.setattr(hard_negatives, "_block_size", lambda dim: 16)


def test_hard_negatives(spark, small_steps):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(6, 4))
    rows = [(k, int(rng.integers(3)), (middles[k % 6] + 0.7 * rng.normal(size=4)).astype(np.float32).tolist()) for k in range(240)]
    rows += [(k, 1, rows[12][2]) for k in range(240, 300)]  # copies of one vector: ties by number
    rows += [(30, 2, rows[5][2]), (30, 2, rows[5][2]), (18, 0, [0.0] * 4), (306, 1, [3.0, 1.0]), (307, 1, [3.0, 1.5]), (308, 2, [1.0, 1.0]), (312, 5, [1.0] * 4)]
    rows += [(600, None, [1.0] * 4), (None, 1, [1.0] * 4), (606, 1, None), (612, 1, []), (618, 1, [1.0, None, 0.0, 0.0]), (624, 1, [float("nan")] * 4), (630, 1, [float("inf")] + [0.0] * 3)]
    df = spark.createDataFrame(rows, VECTORS).repartition(3).withColumns({"rid": F.lit(1), "dim": F.lit(2), "part": F.lit("x"), "cluster": F.lit(0)})
    assert mined(df, 6) == negatives_by_loops(rows, 6)


def test_hard_negatives_of_integers_without_noise(spark, small_steps):
    """Many equal scores, positives with score 0 or below."""
    rng = np.random.default_rng(4)
    rows = [(k, int(rng.integers(4)), (rng.integers(-1, 2, size=3)).astype(float).tolist()) for k in range(150)]
    assert mined(spark.createDataFrame(rows, VECTORS), 5) == negatives_by_loops(rows, 5)


def test_no_anchors_no_negatives(spark):
    df = spark.createDataFrame([(1, 1, [1.0]), (2, 2, [1.0])], VECTORS)
    assert mined(df, 10) == [] and mined(df.where("false"), 1) == []


def test_a_walk_ends_where_the_bound_certifies_it():
    """Members near their mean direction see only the head of a list."""
    rng = np.random.default_rng(5)
    near = np.array([1000, 0, 0]) + rng.integers(-20, 20, size=(5, 3))
    ones = np.zeros(5, np.int64)
    packed = {"rids": np.arange(5).tobytes(), "ids": np.arange(5).tobytes(), "labels": ones.tobytes(), "kind": "<i8", "data": near.astype(np.int64).tobytes(), "dim": 3}
    group = hard_negatives.Group(packed | {"cluster": 1, "part": 0, "bounds": None}, 3, True)
    many = np.concatenate([np.array([[900 - k, 5, 5] for k in range(300)]), rng.integers(-50, 50, size=(3000, 3))]).astype(np.int64)
    seen = []
    count = hard_negatives.products
    hard_negatives.products = lambda a, b: (seen.append(len(b)), count(a, b))[1]
    try:
        n = len(many)
        group.walk({"rids": np.arange(100, 100 + n).tobytes(), "ids": np.arange(100, 100 + n).tobytes(), "labels": np.zeros(n, np.int64).tobytes(), "kind": "<i8", "data": many.tobytes()})
    finally:
        hard_negatives.products = count
    assert sum(seen) <= 2 * hard_negatives.STEP and (group.found == [[100, 101, 102]] * 5).all()


def test_writers_keep_common_parts_when_their_cache_is_full(monkeypatch):
    ids = token_frames._chunk_ids(packing.vocabulary())
    ids.clear()
    monkeypatch.setattr(ids, "most", 50)
    for k in range(6):
        ids.of(["the rain, and the sea " + " ".join(f"x{chr(97 + k)}{chr(97 + i)}" for i in range(20))])
    monkeypatch.setattr(ids, "_learn", lambda parts: pytest.fail(f"encoded again: {parts}"))
    assert ids.of(["The sea, and the rain"]) == [np.array(ids.tokenizer.encode("The sea, and the rain").ids, "<u4").tobytes()]
