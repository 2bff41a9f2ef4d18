"""Removal of repeated passages by suffix sorting in shards.

A byte goes if a string of `span` bytes over it also starts earlier: at a
smaller doc_id, or in the same document before. Strings are judged on the input.

Windows of `span` bytes are dealt to shards by their anchor (the smallest gram
hash in the window), so equal windows meet whatever surrounds them. Runs of
windows with one anchor are segments. Segments of equal bytes are sorted once,
for their first occurrence; all later ones are covered by it. An anchor that
only one text of segment has is sorted only if it could repeat inside itself. An
anchor with more than SHARD bytes of distinct segments (a hot passage in many
surroundings) is dealt anew, window by window, by hashes of the whole window:
equal windows still meet, others part, so no shard grows with an anchor. What
remains is suffix-sorted, shard by shard, by induced sorting with common prefixes
(`induced_sort`), whose queues go to disk beyond a limit: windows with a common
prefix of `span` are equal, and all but the first are covered.

Documents are told apart by doc_id; rows that share one are ordered by a hash of
their text, and rows equal in both are one document and get the same result.
Null doc_id comes first. Null text is empty; texts under `span` bytes lose
nothing. Columns other than doc_id and text pass through `cut` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from altigrid.llm.anchors import segments, window_hashes
from altigrid.llm.common import hold, release, renamed, saved, small_batches, wider
from altigrid.llm.induced_sort import repeated_starts

SPAN = 100
KEYS = ["did", "tie"]
PIECE = 1_000_000  # bytes of text that are cut at once
SHARD = 1_500_000  # bytes that are sorted together, and most of one anchor
_SEGMENT = "did long, tie long, start long, starts long, anchor long, digest long, again boolean, covered boolean"


def keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """docs with did and tie, which name a document (tie is 0 unless rows share a doc_id), and each document's text once."""
    did = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63)))
    named = docs.withColumn("did", did)
    shared = named.groupBy("did").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("did", F.lit(True).alias("_shared"))
    if not shared.limit(1).count():
        single = named.withColumn("tie", F.lit(0).cast("long"))
        return single, single
    tie = F.when(F.col("_shared"), F.xxhash64(F.coalesce("text", F.lit("")))).otherwise(F.lit(0).cast("long"))
    known = named.join(shared, "did", "left").withColumn("tie", tie).drop("_shared")
    return known, known.select(*KEYS, "text").dropDuplicates(KEYS)


def _pieces(batches: Iterator[pa.RecordBatch], span: int):
    """Texts of a few MB together: keys, first byte, bytes. Longer texts in parts that overlap by span - 1."""
    for batch in small_batches(batches, "text", PIECE):
        out, size = [], 0
        for did, tie, text in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "text"))):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for at in range(0, max(1, len(raw) - span + 1), PIECE):
                out.append((did, tie, at, raw[at:at + PIECE + span - 1]))
                size += len(out[-1][3])
                if size > PIECE:
                    yield out
                    out, size = [], 0
        if out:
            yield out


def _cut_segments(docs: DataFrame, span: int) -> DataFrame:
    """All segments; those that repeat another of the same batch are marked covered."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("segments", lambda: None)
        for part in _pieces(batches, span):
            data = np.frombuffer(b"".join(p[3] for p in part), np.uint8)
            bounds = np.cumsum([0, *(len(p[3]) for p in part)])
            text, start, starts, anchor, digest, again = segments(data, bounds, span)
            if not len(text):
                continue
            did, tie, first = (np.array([p[k] for p in part], np.int64)[text] for k in range(3))
            start = start + first
            order = np.lexsort((start, tie, did, digest, anchor))
            a, d = anchor[order], digest[order]
            covered = np.zeros(len(order), bool)
            covered[order[1:]] = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (did, tie, start, starts, anchor.view(np.int64), digest.view(np.int64), again, covered)],
                names=["did", "tie", "start", "starts", "anchor", "digest", "again", "covered"],
            )

    return docs.select(*KEYS, "text").mapInArrow(cut, _SEGMENT)


def _resolve(cut: DataFrame) -> DataFrame:
    """(did, tie, start, starts, anchor, covered): covered segments, and those left to be sorted.

    Partitions are sorted by (anchor, digest, place); a segment is judged by the one
    before it and the next first one of its kind, so no anchor is gathered.
    """
    by = ["anchor", "digest", "did", "tie", "start"]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["did", "tie", "start", "starts", "anchor", "covered"]
        last_pair, held = None, None  # held: the last first-of-its-kind row, and whether its anchor has others

        def row(r) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*r[:5], False)], names=names)

        for batch in batches:
            known = batch.column("covered")
            did, tie, start, starts, anchor, digest = (np.asarray(batch.column(c)) for c in ("did", "tie", "start", "starts", "anchor", "digest"))
            repeat, again = (np.array(c.to_numpy(zero_copy_only=False)) for c in (known, batch.column("again")))
            fresh = np.flatnonzero(~repeat)
            if len(fresh):
                a, d = anchor[fresh], digest[fresh]
                same = np.zeros(len(fresh), bool)
                same[1:] = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
                same[0] = last_pair == (a[0], d[0])
                last_pair = (a[-1], d[-1])
                repeat[fresh[same]] = True
                firsts = fresh[~same]
                if len(firsts):
                    a = anchor[firsts]
                    before = np.append(held is not None and held[4] == a[0], a[1:] == a[:-1])
                    if held is not None and (held[6] or before[0]):
                        yield row(held)
                    sort = before.copy()
                    sort[:-1] |= before[1:]
                    sort |= again[firsts]
                    k = firsts[-1]
                    held = (did[k], tie[k], start[k], starts[k], anchor[k], digest[k], bool(sort[-1]))
                    chosen = firsts[:-1][sort[:-1]]
                else:
                    chosen = firsts
            else:
                chosen = fresh
            keep = np.concatenate([np.flatnonzero(repeat), chosen])
            if len(keep):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[keep]) for c in (did, tie, start, starts, anchor, repeat)], names=names
                )
        if held is not None and held[6]:
            yield row(held)

    # Segments that repeat another of their batch are decided: they go anywhere, so that a
    # passage of many documents does not send all its copies to the task of its anchor.
    dealt = cut.repartition(F.when(F.col("covered"), F.xxhash64("did", "start")).otherwise(F.col("anchor")))
    return dealt.sortWithinPartitions(*by).mapInArrow(
        judge, "did long, tie long, start long, starts long, anchor long, covered boolean"
    )


def _texts(docs: DataFrame, rest: DataFrame, span: int) -> DataFrame:
    """The bytes of the segments that are left to be sorted."""
    lists = rest.groupBy(*KEYS).agg(F.collect_list(F.struct("start", "starts", "anchor")).alias("parts"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            out: list[list] = [[], [], [], [], [], []]
            for did, tie, text, parts in zip(*(batch.column(c).to_pylist() for c in (*KEYS, "text", "parts"))):
                raw = (text or "").encode("utf-8", "surrogatepass")
                for p in parts:
                    row = (did, tie, p["start"], p["starts"], p["anchor"], raw[p["start"]:p["start"] + p["starts"] + span - 1])
                    for column, value in zip(out, row):
                        column.append(value)
            types = [*[pa.int64()] * 5, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=["did", "tie", "start", "starts", "anchor", "bytes"])

    return docs.select(*KEYS, "text").join(lists, KEYS).mapInArrow(
        read, "did long, tie long, start long, starts long, anchor long, bytes binary"
    )


def _windows(texts: DataFrame, span: int) -> DataFrame:
    """The windows of segments as segments of their own, with a hash of all their bytes as anchor."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "bytes", PIECE):
            data = np.frombuffer(b"".join(batch.column("bytes").to_pylist()), np.uint8)
            did, tie, start, starts = (np.asarray(batch.column(c)) for c in (*KEYS, "start", "starts"))
            own = np.repeat(np.arange(len(starts)), starts)
            nth = np.arange(len(own)) - (np.cumsum(starts) - starts)[own]
            length = starts + span - 1
            anchor, digest = window_hashes(data, (np.cumsum(length) - length)[own] + nth, span)
            did, tie, start = did[own], tie[own], start[own] + nth
            order = np.lexsort((start, tie, did, digest, anchor))
            a, d = anchor[order], digest[order]
            covered = np.zeros(len(order), bool)
            covered[order[1:]] = (a[1:] == a[:-1]) & (d[1:] == d[:-1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (did, tie, start, np.ones(len(own), np.int64), anchor.view(np.int64), digest.view(np.int64), np.zeros(len(own), bool), covered)],
                names=["did", "tie", "start", "starts", "anchor", "digest", "again", "covered"],
            )

    return texts.mapInArrow(split, _SEGMENT)


def _apart(docs: DataFrame, judged: DataFrame, span: int) -> DataFrame:
    """judged with the segments of anchors beyond SHARD bytes replaced by their windows, judged again."""
    rest = judged.where("NOT covered")
    size = F.sum(F.col("starts") + (span - 1))
    # Written, so that the planner knows how few they are and joins them without dealing all segments anew.
    hot = saved(rest.groupBy("anchor").agg(size.alias("_size")).where(F.col("_size") > SHARD).select("anchor", F.lit(True).alias("_hot")))
    if not hot.limit(1).count():
        return judged
    marked = rest.join(hot, "anchor", "left").select(*judged.columns, "_hot")
    split = saved(_resolve(_windows(_texts(docs, marked.where("_hot"), span), span)))
    return judged.where("covered").unionByName(marked.where("_hot IS NULL").drop("_hot")).unionByName(split)


def _sorted_repeats(texts: DataFrame, span: int) -> DataFrame:
    """Runs of covered window starts inside the sorted segments: (did, tie, start, starts)."""

    def shard(rows: list[tuple]) -> pa.RecordBatch:
        rows = sorted(rows)  # by document and place, so position is order of occurrence
        lengths = np.array([len(r[4]) for r in rows])
        begin = np.cumsum(lengths + 1) - lengths - 1
        symbols = np.ones(int(lengths.sum()) + len(rows) + 1, np.int32)
        symbols[-1] = 0
        for r, at in zip(rows, begin.tolist()):
            symbols[at:at + len(r[4])] = np.frombuffer(r[4], np.uint8).astype(np.int32) + 2
        gone = repeated_starts(symbols, span)
        starts = np.array([r[3] for r in rows])
        real = np.zeros(len(symbols) + 1, np.int32)
        np.add.at(real, begin, 1)
        np.add.at(real, begin + starts, -1)
        gone &= np.cumsum(real[:-1]) > 0
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        first, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        own = np.searchsorted(begin, first, side="right") - 1
        did, tie, place = (np.array([r[k] for r in rows], np.int64)[own] for k in range(3))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (did, tie, place + first - begin[own], stop - first)], names=["did", "tie", "start", "starts"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size, last = [], 0, None
        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("anchor", "did", "tie", "start", "starts", "bytes"))):
                if size > SHARD and r[0] != last:
                    yield shard(rows)
                    rows, size = [], 0
                rows.append(r[1:])
                size += len(r[5])
                last = r[0]
        if rows:
            yield shard(rows)
        rows = []
        release()

    return texts.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(sort, "did long, tie long, start long, starts long")


def repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """For documents with keys, each once: (did, tie, spans), spans a list of (start, starts) of covered windows."""
    judged = _apart(docs, saved(_resolve(_cut_segments(docs, span))), span)
    rest = judged.where("NOT covered")
    found = _sorted_repeats(_texts(docs, rest, span), span)
    every = judged.where("covered").select(*KEYS, "start", "starts").unionByName(found)
    return every.groupBy(*KEYS).agg(F.collect_list(F.struct("start", "starts")).alias("spans"))


def removed_runs(spans: list[dict], span: int) -> list[tuple[int, int]]:
    """Maximal runs (begin, end) of bytes covered by the windows."""
    out: list[list[int]] = []
    for begin, end in sorted((s["start"], s["start"] + s["starts"] - 1 + span) for s in spans or ()):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def cut(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """docs with the columns _kept (remaining bytes), _new (the same as text), _bytes, _removed and _spans.

    A cut may fall inside a character; its loose bytes are left out of _new.
    """
    known, once = keyed(docs)
    marked = known.join(repeats(once, span), KEYS, "left").drop(*KEYS)
    schema = wider(docs, {"_kept": "binary", "_new": "string", "_bytes": "long", "_removed": "long", "_spans": "long"})
    columns = docs.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            kept, sizes, gone, counts = [], [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = (text or "").encode("utf-8", "surrogatepass")
                runs = removed_runs(spans, span)
                stops = [0, *(x for run in runs for x in run), len(raw)]
                kept.append(b"".join(raw[a:b] for a, b in zip(stops[::2], stops[1::2])))
                sizes.append(len(raw))
                gone.append(sum(b - a for a, b in runs))
                counts.append(len(runs))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in columns), pa.array(kept, pa.binary()), pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), *(pa.array(c, pa.int64()) for c in (sizes, gone, counts))],
                names=[*columns, "_kept", "_new", "_bytes", "_removed", "_spans"],
            )

    return marked.mapInArrow(apply, schema)


def removals(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    return cut(docs.select("doc_id", "text"), span).select(
        "doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, span: int = SPAN) -> DataFrame:
    """docs with repeated passages cut out of their text, and n_chars set anew where there is such a column.

    Documents of which nothing but white space is left go as a whole,
    if they lost anything.
    """
    own = renamed(docs, "doc_id", "text", "n_chars")
    fresh = cut(own, span)
    left = fresh.where("_removed = 0 OR _new RLIKE '[^\\\\s]'")
    text = F.when(F.col("_removed") > 0, F.col("_new")).otherwise(F.col("text"))
    changed = {"text": text} | ({"n_chars": F.when(F.col("_removed") > 0, F.length("_new").cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {})
    return left.withColumns(changed).select(*own.columns).toDF(*docs.columns)
