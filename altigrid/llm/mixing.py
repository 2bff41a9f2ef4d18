"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in the order of a hash, are cut into blocks of
`block_docs`. The ideal mix gives every source its weight's share of each slot,
and when a source runs out the others' shares are scaled up. Block j (from 0) of a
source is released at the slot in which the ideal mix begins it and due before
the slot after that in which the ideal mix ends it: floor(j / w) and
ceil((j + 1) / w) while all sources run. Earliest deadline first over the released
blocks gives each slot one block and keeps every source less than one block from
the ideal at all times. Weights are taken as the exact fractions that they are;
nothing is rounded, no source is pooled, no document is left out or repeated.

Let V be the blocks that the ideal mix has given per unit of weight. Then a source of
b blocks and weight w has got min(V * w, b), so the slot at V is the sum of these,
and release and deadline follow by arithmetic. So does the state at any slot t: the blocks
due by t are done, and of those released before t but due later, those that earliest
deadline first takes are the best set by deadline of which, for every a, no more than the slots
from a to t are left over are released at a or later (the slots before t form a matroid). Tasks
therefore deal `chunk` slots each, from the state at their first one, and the result is that of one pass over
all slots. The driver holds one entry per source; no step over slots runs there. A task takes, beside its slots,
time up to the square of the number of sources (1,000: a second; meant for up to some thousands).

Null source is a source of its own. Rows with equal or null doc_id are documents
each. An empty table gives an empty result; weights of sources without documents
are ignored, sources without a weight (or with one of 0 or null) get the smallest
weight divided by `period`. Other columns pass through under any name; columns named
_slot, _place or _mixed_as are replaced by mix() and kept by in_order().
"""

from __future__ import annotations

import heapq
import math
from bisect import bisect_right
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F

from altigrid.llm.common import renamed, saved, wider


class Ideal:
    """The ideal mix of sources with given numbers of blocks and weights, by exact arithmetic."""

    def __init__(self, blocks: list[int], weights: list):
        exact = [Fraction(w) for w in weights]
        scale = math.lcm(*(w.denominator for w in exact)) if exact else 1
        self.blocks, self.parts = blocks, [int(w * scale) for w in exact]
        order = sorted((s for s in range(len(blocks)) if blocks[s]), key=lambda s: Fraction(blocks[s], self.parts[s]))
        self.ends = [(blocks[s], self.parts[s]) for s in order]  # the order in which sources run out
        self.done = [0, *accumulate(b for b, _ in self.ends)]
        self.live = [*accumulate((w for _, w in reversed(self.ends)), initial=0)][::-1]
        self.at = [0] * len(blocks)  # per source: how many had run out at its last block
        self.end_slots = [self.done[i] + Fraction(b * self.live[i], w) for i, (b, w) in enumerate(self.ends)]
        self.total = self.done[-1]

    def slot(self, s: int, j: int) -> tuple[int, int]:
        """Slot at which the mix begins block j of s, rounded down and up; per source, j must not fall."""
        w, i = self.parts[s], self.at[s]
        if i < len(self.ends) and self.ends[i][0] * w <= j * self.ends[i][1]:
            i = self.at[s] = bisect_right(self.ends, False, lo=i + 1, key=lambda e: e[0] * w > j * e[1])
            # the first end beyond j: keys are False, then True
        whole, rest = divmod(j * self.live[i], w)
        return self.done[i] + whole, self.done[i] + whole + (rest > 0)

    def given(self, t: int) -> list[tuple[int, bool]]:
        """Per source, the whole blocks that the mix has given at slot t, and whether it is within a block."""
        i = bisect_right(self.end_slots, t)
        if i == len(self.ends):
            return [(b, False) for b in self.blocks]
        out = []
        for b, w in zip(self.blocks, self.parts):
            whole, rest = divmod((t - self.done[i]) * w, self.live[i])
            out.append((b, False) if whole >= b else (whole, rest > 0))
        return out

    def state(self, t: int) -> list[int]:
        """Blocks of each source that earliest deadline first has placed in the slots before t."""
        given = self.given(t)
        placed = [whole for whole, _ in given]
        self.at = [0] * len(self.blocks)
        begun = []  # (deadline, source, release) of the blocks that t lies in
        for s, (whole, within) in enumerate(given):
            if within:
                release = self.slot(s, whole)[0]
                begun.append((self.slot(s, whole + 1)[1], s, release))
        open_slots = t - sum(placed)
        if not open_slots:
            return placed
        # Room for begun blocks that are released at a or later: slots from a on, less the blocks due by t that begin there.
        releases = sorted({r for _, _, r in begun})
        room = []
        for a in releases:
            before = self.given(a)
            room.append(t - a - sum(max(0, done - whole - within) for done, (whole, within) in zip(placed, before)))
        for _, s, r in sorted(begun):
            last = bisect_right(releases, r)
            if open_slots and min(room[:last]) > 0:
                room[:last] = [n - 1 for n in room[:last]]
                open_slots -= 1
                placed[s] += 1
        return placed

    def deal(self, first: int, stop: int) -> Iterator[tuple[int, int]]:
        """Source and block of the slots from first to stop, by earliest deadline among released blocks."""
        placed = self.state(first)
        self.at = [0] * len(self.blocks)
        waiting = [(self.slot(s, j)[0], s, j) for s, j in enumerate(placed) if j < self.blocks[s]]  # release, source, block
        heapq.heapify(waiting)
        ready: list[tuple[int, int, int]] = []
        for slot in range(first, min(stop, self.total)):
            while waiting and waiting[0][0] <= slot:
                _, s, j = heapq.heappop(waiting)
                heapq.heappush(ready, (self.slot(s, j + 1)[1], s, j))
            _, s, j = heapq.heappop(ready)
            yield s, j
            if j + 1 < self.blocks[s]:
                heapq.heappush(waiting, (self.slot(s, j + 1)[0], s, j + 1))


def slots(blocks: list[int], weights: list) -> Iterator[int]:
    """Source of each slot until all blocks are placed, in one pass."""
    return (s for s, _ in Ideal(blocks, weights).deal(0, sum(blocks)))


def _planned(spark: SparkSession, blocks: list[int], weights: list, chunk: int) -> DataFrame:
    """(_group, _block, _slot) of every block; a task deals a chunk of slots at a time."""
    n_chunks = -(-sum(blocks) // chunk)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ideal = Ideal(blocks, weights)
        for batch in batches:
            for k in batch.column("id").to_pylist():
                group, block = np.array(list(ideal.deal(k * chunk, (k + 1) * chunk)), np.int64).T
                yield pa.RecordBatch.from_arrays(
                    [pa.array(group.astype(np.int32)), pa.array(block), pa.array(np.arange(len(group)) + k * chunk)], names=["_group", "_block", "_slot"]
                )

    return spark.range(0, n_chunks, 1, n_chunks).mapInArrow(deal, "_group int, _block long, _slot long")


def _numbered(docs: DataFrame, seed: int) -> DataFrame:
    """Adds _group's running number _nth within the task; order by hash within the partition."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}
        part = TaskContext.get().partitionId()
        for batch in batches:
            group = np.asarray(batch.column("_group"))
            nth = np.zeros(len(group), np.int64)
            for g in np.unique(group):
                own = group == g
                nth[own] = np.arange(own.sum()) + seen.get(g, 0)
                seen[g] = int(nth[own][-1]) + 1 if own.any() else 0
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(group), part), pa.int32()), pa.array(nth)], names=[*batch.schema.names, "_part", "_nth"]
            )

    draw = F.xxhash64(F.lit(seed), "doc_id", "_group")
    dealt = docs.withColumn("_draw", draw).repartitionByRange("_draw").sortWithinPartitions("_draw").drop("_draw")
    return dealt.mapInArrow(number, wider(docs, {"_part": "int", "_nth": "long"}))


def tempered(counts: dict, power: float = 0.7) -> dict:
    """Weights in proportion to size ** power: small sources get more than their share."""
    return {s: n**power for s, n in counts.items()}


def mix(
    docs: DataFrame, weights: dict | None = None, key: str = "source", block_docs: int = 16,
    period: int = 1000, seed: int = 0, chunk: int = 200_000,
) -> DataFrame:
    """docs with _slot (block in the mix), _place (from 0, in the block) and _mixed_as (the source)."""
    docs = docs.drop("_slot", "_place", "_mixed_as")
    names, docs = docs.columns, renamed(docs, "doc_id", key)
    sizes = docs.groupBy(key).count().orderBy(F.col("count").desc(), key).collect()  # one row per source
    if not sizes:
        return docs.toDF(*names).withColumns({"_slot": F.lit(0).cast("long"), "_place": F.lit(0), "_mixed_as": F.col(key)})
    counts = {i: r["count"] for i, r in enumerate(sizes)}
    wanted = list(tempered(counts).values()) if weights is None else [weights.get(r[key]) for r in sizes]
    least = Fraction(min((w for w in wanted if w), default=1.0)) / period

    spark = docs.sparkSession
    plan = _planned(spark, [-(-n // block_docs) for n in counts.values()], [w if w else least for w in wanted], chunk)
    index = spark.createDataFrame([(r[key], i) for i, r in enumerate(sizes)], wider(docs.select(key), {"_group": "int"}))
    pairs = index.withColumnRenamed(key, "_name")
    grouped = docs.join(pairs, docs[key].eqNullSafe(F.col("_name")), "left").drop("_name")
    numbered = saved(_numbered(grouped, seed))
    before = numbered.groupBy("_group", "_part").agg((F.max("_nth") + 1).alias("_n")).select(
        "_group", "_part", F.coalesce(F.sum("_n").over(W.partitionBy("_group").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before")
    )
    rank = F.col("_nth") + F.col("_before")
    ranked = numbered.join(before, ["_group", "_part"]).withColumns({
        "_block": F.expr(f"(_nth + _before) div {block_docs}"), "_place": (rank % block_docs).cast("int"),
    })
    placed = ranked.join(plan, ["_group", "_block"])
    return placed.select(*docs.columns, "_slot", "_place", F.col(key).alias("_mixed_as")).toDF(*names, "_slot", "_place", "_mixed_as")


def in_order(docs: DataFrame, key: str = "source", **options) -> DataFrame:
    """The rows of docs in the order of the mix: range partitions, sorted inside."""
    own = renamed(docs, "doc_id", key)
    return mix(own, key=key, **options).orderBy("_slot", "_place").select(*own.columns).toDF(*docs.columns)
