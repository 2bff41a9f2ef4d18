"""Hard-negative mining over lists that are shared by clusters of anchors.

Anchors are clustered by direction and cut into groups of at most MEMBERS. A group
keeps its mean direction and the widest angle of a member to it, so that
|x| * cos(angle(x, mean) - widest) bounds the inner product of x with any unit
member. Candidates are sorted by that bound once for a group; every member walks
the list until the bound times its length lies below its k-th best score, which
certifies that nothing further on can count. A list is held in blocks of a task,
and a member's thresholds are carried from block to block.

Two walks: over rows of the same label for the positives, then over rows of other
labels for the negatives, where each positive sets an interval of scores and its
ten best are kept. Walks run in tasks of (group, part of the candidates): the
group's row comes first and its blocks follow in a sorted stream, so a task holds
one group and one block. A task returns at most k rows for each anchor (and
positive), and a window picks the best of the PARTS. Results are exact; the
clustering (fitted on at most SAMPLE anchors) only decides how far a walk goes.

Rows with a null number, label or vector, an empty vector or a null or non-finite
component take no part. Rows with an equal number, or equal in all columns, are
rows each: each is an anchor if its number is, and a candidate for the others.
Vectors meet those of their own length only. A positive with a negative score has
an empty interval. Zero vectors have score 0. An empty table gives an empty
result. Scores beyond 64 bits wrap around. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from altigrid.llm.common import discard, saved
from altigrid.llm.vectors import by_dim, integer_rows, narrow, products

MEMBERS = 512        # anchors of a group
BLOCK = 2048         # candidates of a block
STEP = 256           # candidates of one step of a walk
PARTS = 8            # tasks that share the list of a group
SAMPLE, CENTRES = 4096, 64
PER_CENTRE = 256     # sampled anchors that a cluster stands for; each group gets a copy of all blocks
GROUPS = 1024        # labels are dealt to so many keys
SLACK = 1e-7         # added to angles and bounds against rounding
LOWEST, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max

_PACKED = "dim int, made long, rids binary, ids binary, labels binary, kind string, data binary"


def _units(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]


def centres(sample: dict[int, np.ndarray], most: int = CENTRES, rounds: int = 8) -> dict[int, np.ndarray]:
    """Directions of clusters for each vector length, by spherical k-means."""
    out = {}
    for dim, x in sample.items():
        units = _units(x)
        found = units[np.random.default_rng(dim).permutation(len(units))[:max(1, min(most, len(units) // PER_CENTRE))]]
        for _ in range(rounds):
            near = (units @ found.T).argmax(axis=1)
            sums = np.zeros_like(found)
            np.add.at(sums, near, units)
            lengths = np.linalg.norm(sums, axis=1)
            found = np.where(lengths[:, None] > 0, sums / np.maximum(lengths, 1e-300)[:, None], found)
        out[dim] = found
    return out


def _packed(rows: DataFrame, key: str, size) -> DataFrame:
    """Runs of equal (dim, key) as rows of bytes, size(dim) vectors at most; rows come sorted by them.

    `made` numbers the rows of all tasks; `key` stays.
    """
    dealt = rows.withColumn("part", F.spark_partition_id())

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        now, made = None, 0

        def row() -> pa.RecordBatch:
            nonlocal made
            rids, ids, labels, x = (np.concatenate([h[k] for h in held]) for k in range(4))
            x = narrow(x)
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([now[0]], pa.int32()), pa.array([(part << 32) + made]), pa.array([rids.tobytes()], pa.binary()), pa.array([ids.tobytes()], pa.binary()),
                pa.array([labels.tobytes()], pa.binary()), pa.array([x.dtype.str]), pa.array([x.tobytes()], pa.binary()), pa.array([now[1]], pa.int32()),
            ], names=["dim", "made", "rids", "ids", "labels", "kind", "data", key])

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column("part")[0].as_py()
            keys = np.asarray(batch.column(key))
            columns = [np.asarray(batch.column(c)) for c in ("rid", "id", "label")]
            for dim, own, x in by_dim(batch):
                cuts = np.flatnonzero(np.diff(keys[own])) + 1
                for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(own)]):
                    if held and now != (dim, int(keys[own[a]])):
                        yield row()
                        held = []
                    now = (dim, int(keys[own[a]]))
                    while a < b:
                        room = size(dim) - sum(len(h[0]) for h in held)
                        to = min(b, a + room)
                        held.append((*[c[own[a:to]] for c in columns], x[a:to]))
                        a = to
                        if sum(len(h[0]) for h in held) >= size(dim):
                            yield row()
                            held = []
        if held:
            yield row()

    return dealt.mapInArrow(pack, f"{_PACKED}, {key} int")


def _block_size(dim: int) -> int:
    return max(64, min(BLOCK, 500_000 // dim))


class Group:
    """Anchors of one group, their walks' intervals and the best found so far."""

    def __init__(self, row: dict, k: int, same_label: bool):
        self.key, self.k, self.same_label, self.dim = (row["cluster"], row["part"]), k, same_label, row["dim"]
        self.rids, self.ids, self.labels = (np.frombuffer(row[c], np.int64) for c in ("rids", "ids", "labels"))
        self.data = np.frombuffer(row["data"], row["kind"]).reshape(-1, self.dim)
        units = _units(self.data)
        self.lengths = np.linalg.norm(self.data.astype(np.float64), axis=1)
        mean = units.sum(axis=0)
        self.mean = mean / max(np.linalg.norm(mean), 1e-300)
        self.widest = float(np.arccos(np.clip(units @ self.mean, -1, 1)).max()) + SLACK
        n = len(self.rids)
        if row["bounds"] is None:
            self.member, self.tag = np.arange(n), np.zeros(n, np.int32)
            self.low, self.high = np.full(n, LOWEST), np.full(n, LAST)
        else:
            at = row["bounds"]
            self.member, self.tag = np.array([b["at"] for b in at], np.int64), np.array([b["nth"] for b in at], np.int32)
            self.low, self.high = (np.array([b[c] for b in at], np.int64) for c in ("low", "high"))
        self.scores = np.full((len(self.member), k), LOWEST)
        self.found = np.full((len(self.member), k), LAST)

    def least(self) -> np.ndarray:
        """What a score must reach to count, for each interval."""
        return np.maximum(self.low, self.scores[:, -1])

    def walk(self, row: dict) -> None:
        rids, ids, labels = (np.frombuffer(row[c], np.int64) for c in ("rids", "ids", "labels"))
        data = np.frombuffer(row["data"], row["kind"]).reshape(-1, self.dim)
        lengths = np.linalg.norm(data.astype(np.float64), axis=1)
        away = np.arccos(np.clip(_units(data) @ self.mean, -1, 1))
        bound = lengths * (np.cos(np.maximum(away - self.widest, 0)) + SLACK)
        order = np.argsort(-bound, kind="stable")
        for start in range(0, len(order), STEP):
            least = self.least()
            live = np.flatnonzero((self.high >= least) & (self.lengths[self.member] * bound[order[start]] >= least))
            if not len(live):
                return
            own = order[start:start + STEP]
            members, place = np.unique(self.member[live], return_inverse=True)
            scores = products(self.data[members], data[own])
            other = (self.labels[members, None] == labels[None, own]) == self.same_label
            if self.same_label:
                other &= self.rids[members, None] != rids[None, own]
            values = scores[place]
            w, c = np.nonzero(other[place] & (values >= least[live, None]) & (values <= self.high[live, None]))
            if len(w):
                self._keep(live[w], values[w, c], ids[own[c]])

    def _keep(self, w: np.ndarray, score: np.ndarray, found: np.ndarray) -> None:
        touched = np.unique(w)
        w = np.concatenate([np.repeat(touched, self.k), w])
        score = np.concatenate([self.scores[touched].ravel(), score])
        found = np.concatenate([self.found[touched].ravel(), found])
        order = np.lexsort((found, np.where(score == LOWEST, LAST, -score), w))
        w, score, found = w[order], score[order], found[order]
        nth = np.arange(len(w)) - np.searchsorted(w, w)
        best = nth < self.k
        self.scores[w[best], nth[best]], self.found[w[best], nth[best]] = score[best], found[best]

    def rows(self) -> pa.RecordBatch:
        w, c = np.nonzero(self.scores > LOWEST)
        at = self.member[w]
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(w), self.key[0])), pa.array(at.astype(np.int32)), pa.array(self.rids[at]), pa.array(self.ids[at]),
            pa.array(self.tag[w]), pa.array(self.found[w, c]), pa.array(self.scores[w, c]),
        ], names=["cluster", "at", "rid", "anchor_id", "nth", "found_id", "score"])


def _walks(groups: DataFrame, blocks: DataFrame, k: int, same_label: bool) -> DataFrame:
    """Each group's row, then its blocks, task by task: cluster, at, rid, anchor_id, nth, found_id, score."""
    payload = ["dim", "rids", "ids", "labels", "kind", "data"]
    heads = groups.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).select("cluster", "part", F.lit(0).alias("follows"), *payload, "bounds")
    tails = blocks.select("cluster", F.pmod(F.xxhash64("made"), F.lit(PARTS)).cast("int").alias("part"), F.lit(1).alias("follows"), *payload)
    stream = heads.unionByName(tails, allowMissingColumns=True)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = None
        for batch in batches:
            for at in range(batch.num_rows):
                r = batch.slice(at, 1).to_pylist()[0]
                if r["follows"] == 0:
                    if group is not None:
                        yield group.rows()
                    group = Group(r, k, same_label)
                elif group is not None and group.key == (r["cluster"], r["part"]):
                    # A group without intervals has no row, and its blocks pass by.
                    group.walk(r)
        if group is not None:
            yield group.rows()

    dealt = stream.repartition("cluster", "part").sortWithinPartitions("cluster", "part", "follows")
    return dealt.mapInArrow(walk, "cluster long, at int, rid long, anchor_id long, nth int, found_id long, score long")


def _best(found: DataFrame, key: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*key).orderBy(F.col("score").desc(), "found_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, scale: int = 256,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: id, label, v. is_anchor is a condition on id. A negative's score lies
    between low and high per cent of the positive's.
    """
    typed = rows.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), "v", is_anchor.alias("asks"))
    numbered = integer_rows(typed.where("id IS NOT NULL AND label IS NOT NULL"), "v", scale).withColumns(
        {"rid": F.monotonically_increasing_id(), "labels_key": F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int")})
    whole = saved(numbered)
    order = ["dim", "labels_key", "rid"]
    blocks = saved(_packed(whole.repartitionByRange(*order).sortWithinPartitions(*order), "labels_key", _block_size))

    anchors = whole.where("asks")
    sample: dict[int, list] = {}
    for r in anchors.orderBy(F.xxhash64("rid"), "rid").limit(SAMPLE).select("dim", "x").collect():
        sample.setdefault(r.dim, []).append(r.x)
    model = centres({dim: np.array(x, np.int64) for dim, x in sample.items()})

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, np.int32)
            for dim, own, x in by_dim(batch):
                if dim in model:
                    near[own] = (_units(x) @ model[dim].T).argmax(axis=1)
            yield batch.append_column("near", pa.array(near))

    columns = "rid long, id long, label long, dim int, x array<long>"
    placed = saved(anchors.select("rid", "id", "label", "dim", "x").mapInArrow(assign, columns + ", near int"))
    discard(whole)
    order = ["dim", "near", "rid"]
    n_groups = -(-placed.count() // MEMBERS) or 1
    packed = _packed(placed.repartitionByRange(n_groups, *order).sortWithinPartitions(*order), "near", lambda dim: min(MEMBERS, _block_size(dim)))
    # Groups of one vector length have numbers without gaps, so blocks find them by counting, not by a join with all.
    nth = F.row_number().over(W.partitionBy("dim").orderBy("made")).cast("long")
    packed = saved(packed)
    numbers = packed.select("dim", "made").withColumn("nth", nth)
    groups = saved(packed.join(numbers, ["dim", "made"]).withColumn("cluster", (F.col("dim").cast("long") * F.lit(1 << 36)) + F.col("nth")))
    discard(packed)

    # Positives: only blocks of the labels that a group has.
    keys = placed.select("rid", "dim", F.pmod(F.xxhash64("label"), F.lit(GROUPS)).cast("int").alias("labels_key"))
    members = _rids(groups).join(keys, "rid").select("cluster", "dim", "labels_key").distinct()
    near = blocks.join(members, ["dim", "labels_key"])
    found = _best(_walks(groups.withColumn("bounds", _no_bounds()), near, positives, True), ["rid"], positives)
    good = saved(found.select("cluster", "at", "rid", "anchor_id", F.col("rank").alias("nth"), F.col("found_id").alias("positive_id"), F.col("score").alias("positive_score")))
    discard(placed)

    # Negatives: all blocks, one list of intervals for each group.
    bound = F.struct(
        "at", "nth",
        # Rounded up, and down, to whole scores.
        F.expr(f"({low} * positive_score + pmod(-{low} * positive_score, 100)) div 100").alias("low"),
        F.expr(f"({high} * positive_score - pmod({high} * positive_score, 100)) div 100").alias("high"),
    )
    bounds = good.groupBy("cluster").agg(F.collect_list(bound).alias("bounds"))
    spans = groups.groupBy("dim").agg(F.min("cluster").alias("first"), F.max("cluster").alias("last"))
    every = blocks.join(spans, "dim").withColumn("cluster", F.explode(F.sequence("first", "last")))
    mined = _best(_walks(groups.join(bounds, "cluster"), every, negatives, False), ["rid", "nth"], negatives)
    pairs = mined.join(good.select("rid", "nth", "positive_id", "positive_score"), ["rid", "nth"])
    return pairs.select("anchor_id", "positive_id", "rank", F.col("found_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _no_bounds() -> Column:
    return F.lit(None).cast("array<struct<at:int,nth:int,low:long,high:long>>")


def _rids(groups: DataFrame) -> DataFrame:
    """(cluster, rid) of all members."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cluster, raw in zip(batch.column("cluster").to_pylist(), batch.column("rids").to_pylist()):
                rids = np.frombuffer(raw, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rids), cluster)), pa.array(rids)], names=["cluster", "rid"])

    return groups.select("cluster", "rids").mapInArrow(unpack, "cluster long, rid long")
