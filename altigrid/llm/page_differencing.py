"""Main text of pages by differencing with the page of the nearest URL.

Pages of a host stand in the order of their URL path; each is paired with that
of its two neighbours that shares the longer start of the path. The lines (text
blocks) of a pair are aligned by longest common subsequence, and a page's lines
that the other has too are shared furniture. Every page is judged so, with an article or
without. A pair that shares nearly all lines that the markup leaves to it is a copy and proves
nothing; the other neighbour is asked then.

An exact check by what the markup names follows: lines in menus, headers, footers, sidebars,
forms, adverts, notices, comments, scripts and styles always go, lines of an <article> or
<main> stay though the pair shares them. Where a page has an article, only its lines stay;
elsewhere all that are left.

Neighbours are found by rank in a global order of (host, path), so a large host
is many tasks, and only line hashes travel; the HTML is read twice and never
shuffled. Null html is empty and gives an empty text, as does a page of which
nothing is left. Rows with equal or null page_id are pages each; null or odd
URLs are a host of their own. Columns other than page_id, url and html are not read.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from altigrid.llm.common import saved, small_batches
from altigrid.llm.html_blocks import Block, blocks

COPY = 0.8


def main_blocks(found: list[Block]) -> list[Block]:
    """Blocks that the markup does not rule out: those of the article, if there is one."""
    open_blocks = [b for b in found if not b.aside]
    return [b for b in open_blocks if b.article] or open_blocks


def line_hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) - (1 << 63)


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """Per line of a: bit j is clear where the common subsequence with b grows from its first j to its first j + 1 lines."""
    masks: dict[int, int] = {}
    for k, x in enumerate(b):
        masks[x] = masks.get(x, 0) | 1 << k
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & masks.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a with every start of b."""
    row = deque(_rows(a, b), maxlen=1)[0]
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int], most_bits: int = 1 << 28) -> list[int]:
    """Positions in a of a longest common subsequence with b.

    Bit-parallel, with rows kept for the way back; above most_bits of them a is halved, and b where
    the halves have most in common, so memory does not grow with the product of the lengths.
    """
    in_a, in_b = set(a), set(b)
    at = [k for k, x in enumerate(a) if x in in_b]
    kept, b = [a[k] for k in at], [x for x in b if x in in_a]
    return [at[k] for k in _common(kept, b, most_bits)]


def _common(a: list[int], b: list[int], most_bits: int) -> list[int]:
    if not a or not b:
        return []
    if len(a) > 1 and len(a) * len(b) > most_bits:
        half = len(a) // 2
        cut = int(np.argmax(_lengths(a[:half], b) + _lengths(a[half:][::-1], b[::-1])[::-1]))
        return _common(a[:half], b[:cut], most_bits) + [half + k for k in _common(a[half:], b[cut:], most_bits)]
    rows = list(_rows(a, b))
    i, j, out = len(a), len(b), []
    while i and j:
        if rows[i - 1] >> (j - 1) & 1:
            j -= 1
        else:
            i -= 1
            if i and not rows[i - 1] >> (j - 1) & 1:
                continue
            j -= 1
            out.append(i)
    return out[::-1]


def _lines(pages: DataFrame) -> DataFrame:
    """(key, host, path, lines, left): hashes of all lines, and whether the markup leaves a line to the pair."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            found = [blocks(h) for h in batch.column("html").to_pylist()]
            stay = [set(map(id, main_blocks(f))) for f in found]
            yield pa.RecordBatch.from_arrays([
                *(batch.column(c) for c in ("key", "host", "path")),
                pa.array([[line_hash(b.text) for b in f] for f in found], pa.list_(pa.int64())),
                pa.array([[id(b) in s for b in f] for f, s in zip(found, stay)], pa.list_(pa.bool_())),
            ], names=["key", "host", "path", "lines", "left"])

    return pages.select("key", "host", "path", "html").mapInArrow(read, "key long, host string, path string, lines array<long>, left array<boolean>")


def _ranked(lines: DataFrame) -> DataFrame:
    """Adds rank, the place in the order of (host, path, key)."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            count = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(count, part), pa.int32()), pa.array(np.arange(n, n + count))], names=[*batch.schema.names, "part", "nth"]
            )
            n += count

    order = ["host", "path", "key"]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = saved(dealt.mapInArrow(number, "key long, host string, path string, lines array<long>, left array<boolean>, part int, nth long"))
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row per task
    before = sizes.select("part", F.coalesce(F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    return numbered.join(before, "part").withColumn("rank", F.col("nth") + F.col("before")).drop("part", "nth", "before")


def _shared(ranked: DataFrame) -> DataFrame:
    """(key, gone): hashes of the lines of a page, of those left by the markup, that its nearest neighbour has too."""

    def beside(step: int, name: str) -> DataFrame:
        return ranked.select((F.col("rank") + step).alias("rank"), *(F.col(c).alias(f"{name}_{c}") for c in ("host", "path", "lines", "left")))

    paired = ranked.join(beside(1, "last"), "rank", "left").join(beside(-1, "next"), "rank", "left")

    def start(a: str, b: str) -> int:
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, gone = [], []
            for r in batch.to_pylist():
                near = [(start(r["path"] or "", r[f"{n}_path"] or ""), r[f"{n}_lines"], r[f"{n}_left"]) for n in ("last", "next")
                        if r[f"{n}_lines"] is not None and r[f"{n}_host"] == r["host"]]
                for _, other, left in sorted(near, key=lambda x: -x[0]):
                    out = [r["lines"][k] for k in common_lines(r["lines"], other) if r["left"][k]]
                    if out and len(out) >= COPY * max(sum(r["left"]), sum(left)):
                        continue
                    if out:
                        keys.append(r["key"])
                        gone.append(out)
                    break
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(gone, pa.list_(pa.int64()))], names=["key", "gone"])

    return paired.mapInArrow(compare, "key long, gone array<long>").dropDuplicates(["key"])


def main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every page."""
    url = F.coalesce("url", F.lit(""))
    known = pages.select("page_id", "url", "html").withColumns({
        "key": F.xxhash64("page_id", "url", "html"),
        "host": F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)),
        "path": F.regexp_extract(url, "^(?:[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)?([^?#]*)", 1),
    })
    gone = saved(_shared(_ranked(_lines(known))))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            texts = []
            for page, shared in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist()):
                left = main_blocks(blocks(page))
                drop = set(shared or ())
                texts.append("\n".join(b.text for b in left if b.article or not drop or line_hash(b.text) not in drop))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return known.join(gone, "key", "left").select("page_id", "url", "html", "gone").mapInArrow(read, "page_id long, url string, text string, n_chars long")
