"""Exact top-k search by distributed histogram selection.

Vectors become integers, floor(scale * x). Queries and candidates are packed in
blocks of one dimension, and each pair of blocks is scored by one matrix
product inside a task. Every round counts the scores of each query in bins of
its interval; the bin that holds the k-th highest score is the next interval,
until it is one value or few scores are left above it. A last pass keeps what
reaches the interval, in each task at most k for each query by (score, smaller
number), and ranks these. Scores are computed anew in each round: that is
cheaper than to store one for every pair.

Vectors that are null, empty or hold null or non-finite components take no
part, nor do rows with a null number; a query of another dimension meets only
candidates of its own. Rows with an equal number are candidates each, but none
for its own number. Scores beyond 64 bits wrap around. An empty table gives an
empty result; a query without candidates gives no row. Columns other than the
number and the vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from altigrid.llm.common import saved

QUERIES, CANDIDATES = 1024, 2048  # vectors in a block of either side
BINS = 1024


def whole_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """(id, dim, v): integer components of the vectors that take part."""
    fine = "id IS NOT NULL AND size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return vectors.where(fine).select("id", F.size("v").alias("dim"), F.transform("v", lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("v"))


def blocks(vectors: DataFrame, side: str, most: int) -> DataFrame:
    """Rows of (dim, <side>_block, <side>_ids, <side>_data): up to about `most` vectors as bytes."""
    dealt = vectors.withColumn("part", F.spark_partition_id())
    schema = f"dim int, {side}_block long, {side}_ids binary, {side}_data binary"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        made = 0

        def row(dim: int, parts: list) -> pa.RecordBatch:
            nonlocal made
            ids, data = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([dim], pa.int32()), pa.array([(part << 32) + made]), pa.array([ids.tobytes()], pa.binary()), pa.array([data.tobytes()], pa.binary()),
            ], names=["dim", f"{side}_block", f"{side}_ids", f"{side}_data"])

        part = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            dims = np.asarray(batch.column("dim"))
            for dim in np.unique(dims):
                own = batch.filter(pa.array(dims == dim))
                ids, data = np.asarray(own.column("id")), np.asarray(own.column("v").flatten()).reshape(-1, dim)
                for a in range(0, len(ids), most):
                    held.setdefault(int(dim), []).append((ids[a:a + most], data[a:a + most]))
                    if sum(len(p[0]) for p in held[int(dim)]) >= most:
                        yield row(int(dim), held.pop(int(dim)))
        for dim, parts in held.items():
            yield row(dim, parts)

    return dealt.mapInArrow(pack, schema)


def _products(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products; in floating point only where no sum can leave 53 bits."""
    top = int(np.abs(queries).max(initial=0)) * int(np.abs(candidates).max(initial=0)) * queries.shape[1]
    if top < 1 << 53:
        return (queries.astype(np.float64) @ candidates.astype(np.float64).T).astype(np.int64)
    return queries @ candidates.T


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Per pair of blocks: query numbers, intervals, candidate numbers, scores, and which pairs count."""
    for batch in batches:
        for r in batch.to_pylist():
            dim = r["dim"]
            q_ids, c_ids = np.frombuffer(r["q_ids"], np.int64), np.frombuffer(r["c_ids"], np.int64)
            q, c = (np.frombuffer(r[k], np.int64).reshape(-1, dim) for k in ("q_data", "c_data"))
            yield r, q_ids, c_ids, _products(q, c), q_ids[:, None] != c_ids[None, :]


def _by_pair(q_blocks: DataFrame, c_blocks: DataFrame, spread: int) -> DataFrame:
    """Every candidate block beside every query block of its dimension.

    Query blocks are repeated for `spread` parts of the candidates, so that one
    block of queries is not one task.
    """
    part = F.pmod(F.xxhash64("c_block"), F.lit(spread)).cast("int")
    sent = c_blocks.withColumn("part", part).join(q_blocks.select("dim", "q_block"), "dim")
    repeated = q_blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return sent.join(repeated, ["dim", "q_block", "part"]).drop("part")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, few: int = 4) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k highest integer inner products of each query.

    vectors and queries have columns id and v. The rounds stop for a query when
    its interval is one value wide or at most few * k scores reach it.
    """
    c_blocks = saved(blocks(whole_vectors(vectors, scale), "c", CANDIDATES))
    asked = whole_vectors(queries, scale)
    q_blocks = saved(blocks(asked.repartition(-(-asked.count() // QUERIES) or 1), "q", QUERIES))
    spread = -(-c_blocks.count() // 8) or 1

    def extent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, _, _, scores, other in _pairs(batches):
            low, high = np.where(other, scores, np.iinfo(np.int64).max).min(axis=1), np.where(other, scores, np.iinfo(np.int64).min).max(axis=1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(low), r["dim"]), pa.int32()), pa.array(np.full(len(low), r["q_block"])),
                pa.array(np.arange(len(low)), pa.int32()), pa.array(low), pa.array(high), pa.array(other.sum(axis=1)),
            ], names=["dim", "q_block", "at", "low", "high", "n"])

    pairs = _by_pair(q_blocks, c_blocks, spread)
    state = saved(
        pairs.mapInArrow(extent, "dim int, q_block long, at int, low long, high long, n long").where("n > 0")
        .groupBy("dim", "q_block", "at").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
        .select("dim", "q_block", "at", "low", "high", F.lit(0).cast("long").alias("above"), F.col("n").alias("inside"))
    )
    wide = f"high > low AND above + inside > {few * k}"
    while state.where(wide).limit(1).count():
        state = saved(_narrow(_by_pair(_with_state(q_blocks, state), c_blocks, spread), state, k, wide))
    return _select(_by_pair(_with_state(q_blocks, state), c_blocks, spread), k)


def _with_state(q_blocks: DataFrame, state: DataFrame) -> DataFrame:
    """Query blocks with their intervals: a list of (at, low, high) bounded by the block."""
    lists = state.groupBy("dim", "q_block").agg(F.collect_list(F.struct("at", "low", "high")).alias("bounds"))
    return q_blocks.join(lists, ["dim", "q_block"])


def _bounds(r: dict, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low, high, live = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, bool)
    for b in r["bounds"]:
        low[b["at"]], high[b["at"]], live[b["at"]] = b["low"], b["high"], True
    return low, high, live


def _narrow(pairs: DataFrame, state: DataFrame, k: int, wide: str) -> DataFrame:
    """One round: histograms of all scores inside the intervals, then the bin of the k-th."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, q_ids, _, scores, other in _pairs(batches):
            low, high, live = _bounds(r, len(q_ids))
            step = (high - low) // BINS + 1
            inside = other & live[:, None] & (scores >= low[:, None]) & (scores <= high[:, None])
            row, column = np.nonzero(inside)
            bins = np.bincount(row * BINS + (scores[row, column] - low[row]) // step[row], minlength=1)
            at = np.flatnonzero(bins)
            n = bins[at]
            if len(at):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(at), r["dim"]), pa.int32()), pa.array(np.full(len(at), r["q_block"])),
                    pa.array(at // BINS, pa.int32()), pa.array(at % BINS, pa.int32()), pa.array(n),
                ], names=["dim", "q_block", "at", "bin", "n"])

    key = ["dim", "q_block", "at"]
    sums = pairs.mapInArrow(count, "dim int, q_block long, at int, bin int, n long").groupBy(*key, "bin").agg(F.sum("n").alias("n"))
    higher = W.partitionBy(*key).orderBy(F.col("bin").desc()).rowsBetween(W.unboundedPreceding, -1)
    placed = sums.join(state.where(wide), key).withColumn("higher", F.col("above") + F.coalesce(F.sum("n").over(higher), F.lit(0)))
    found = placed.where(f"higher < {k} AND higher + n >= {k}").select(
        *key,
        F.expr(f"low + bin * ((high - low) div {BINS} + 1)").alias("low"),
        F.expr(f"least(high, low + (bin + 1) * ((high - low) div {BINS} + 1) - 1)").alias("high"),
        F.col("higher").alias("above"), F.col("n").alias("inside"),
    )
    return found.unionByName(state.where(f"NOT ({wide})"))


def _select(pairs: DataFrame, k: int) -> DataFrame:
    """The k best of what reaches the interval's lower end."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r, q_ids, c_ids, scores, other in _pairs(batches):
            low, _, live = _bounds(r, len(q_ids))
            row, column = np.nonzero(other & live[:, None] & (scores >= low[:, None]))
            value = scores[row, column]
            order = np.lexsort((c_ids[column], -value, row))
            row, column, value = row[order], column[order], value[order]
            first = np.searchsorted(row, row)
            best = np.arange(len(row)) - first < k
            row, column, value = row[best], column[best], value[best]
            if len(row):
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(row), r["q_block"])), pa.array(row, pa.int32()),
                    pa.array(q_ids[row]), pa.array(c_ids[column]), pa.array(value),
                ], names=["q_block", "at", "query_id", "vec_id", "score"])

    found = pairs.mapInArrow(keep, "q_block long, at int, query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("q_block", "at", "query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
