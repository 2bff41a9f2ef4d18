"""N-gram Jaccard join by chosen paths.

Documents are sets of five-word shingles. Equal sets are one class, stood for
by its smallest document id. Each run samples about 1 / similarity tokens of
every set by hash; sets that sampled the same token meet in a bucket. Buckets
over `bucket_limit` are split again by tokens sampled inside the bucket, down
to `max_depth`. What is then left is compared by brute force, in tiles of
`bucket_limit` rows, so that no bucket is ever cut or dropped and none is one
task. The number of runs follows from the target recall.

Near copies choose the same paths, so splitting does not part them, and they
would meet in every bucket they share. Members of a large bucket whose smallest
bucket is the same, and smaller than this one, are a family: they meet there
already, so blocks of one family are not compared with each other again.

In a bucket, sketches (one minimum per hash range) rule out pairs that are
five standard deviations under the similarity; the sets of the remaining
documents are then compared exactly. A pair that meets in several buckets
counts in the smallest of them only, so links are counted without listing
pairs: a bucket yields one row per member.

Null and empty texts have no shingles: class of their own, no links. Texts of
fewer than five words are one shingle. Rows with equal doc_id are one document
of as many rows; a null doc_id takes part in nothing and gets a null class.
Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from altigrid.llm.common import components, discard, hold, mix64, saved, small_batches
from altigrid.llm.shingles import forget_words, set_digest, shingle_set

BINS = 128
SIGMAS = 5.0


def runs_needed(recall: float, depth: int) -> int:
    """Runs after which a pair at the very threshold has met with this chance.

    At the threshold a common path goes on with Poisson(1) common children, so
    a run of depth d finds it with q(d) = 1 - exp(-q(d - 1)), q(0) = 1.
    """
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def chosen(tokens: np.ndarray, seeds: np.ndarray, similarity: float) -> np.ndarray:
    """Bucket numbers: for each seed, the tokens sampled at rate 1 / (similarity * size)."""
    if not len(tokens):
        return np.empty(0, np.int64)
    limit = np.uint64(min(2**64 - 1, int(2**64 / (similarity * len(tokens)))))
    drawn = mix64(tokens[None, :] ^ seeds[:, None])
    run, at = np.nonzero(drawn <= limit)
    return np.unique(mix64(tokens[at] + mix64(seeds[run]))).view(np.int64)


def sketch(tokens: np.ndarray) -> bytes:
    """Low bits of the smallest token hash in each of BINS ranges; 0 stands for an empty range."""
    out = np.zeros(BINS, np.uint8)
    drawn = np.sort(mix64(tokens ^ np.uint64(0x5BD1E995)))
    bins = (drawn >> np.uint64(57)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out[bins[first]] = (drawn[first] % np.uint64(255)).astype(np.uint8) + 1
    return out.tobytes()


def _sets(docs: DataFrame, similarity: float, runs: int) -> DataFrame:
    seeds = mix64(np.arange(1, runs + 1, dtype=np.uint64))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("words", forget_words)
        for batch in small_batches(batches, "text"):
            sets = [shingle_set(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([len(s) for s in sets], pa.int32()),
                pa.array([set_digest(s) for s in sets], pa.binary()),
                pa.array([sketch(s) for s in sets], pa.binary()),
                pa.array([chosen(s, seeds, similarity) for s in sets], pa.list_(pa.int64())),
            ], names=["doc_id", "n", "digest", "sketch", "buckets"])

    return docs.mapInArrow(read, "doc_id long, n int, digest binary, sketch binary, buckets array<long>")


def _split(docs: DataFrame, big: DataFrame, similarity: float) -> DataFrame:
    """Members (bucket, rep) of big buckets to the buckets that they choose inside them, as a written table.

    The list of chosen buckets is written first, so that its size is known when it meets the texts.
    """

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            reps, buckets = [], []
            for rep, text, own in zip(batch.column("rep").to_pylist(), batch.column("text").to_pylist(), batch.column("buckets").to_pylist()):
                inner = chosen(shingle_set(text), mix64(np.array(own, np.int64).view(np.uint64)), similarity)
                buckets.append(inner)
                reps.append(np.full(len(inner), rep, np.int64))
            yield pa.RecordBatch.from_arrays([np.concatenate(buckets), np.concatenate(reps)], names=["bucket", "rep"])

    own = saved(big.groupBy("rep").agg(F.collect_list("bucket").alias("buckets")))
    inner = saved(own.join(docs.withColumnRenamed("doc_id", "rep"), "rep").mapInArrow(choose, "bucket long, rep long").distinct())
    discard(own)
    return inner


def _shared(members: DataFrame) -> DataFrame:
    """Members of buckets with more than one, with the bucket's size."""
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    return members.join(sizes, "bucket")


def _families(members: DataFrame, limit: int) -> DataFrame:
    """Blocks of large buckets: (bucket, first, base, blocks, total, alone).

    Members of one `first` bucket below this one are a family of their own
    blocks if there are more than `limit` of them; the rest share blocks.
    """
    alone = (F.col("first") < F.col("bucket")) & (F.col("n_first") > limit)
    groups = members.groupBy("bucket", "first").agg(F.count(F.lit(1)).alias("n_first")).withColumn("alone", alone)
    groups = groups.withColumn("family", F.when(F.col("alone"), F.col("first")).otherwise(F.col("bucket")))
    blocks = groups.groupBy("bucket", "family").agg(F.ceil(F.sum("n_first") / F.lit(limit)).cast("int").alias("blocks"))
    bucket = Window.partitionBy("bucket")
    blocks = blocks.select(
        "bucket", "family", "blocks", F.sum("blocks").over(bucket).cast("int").alias("total"),
        (F.sum("blocks").over(bucket.orderBy("family").rowsBetween(Window.unboundedPreceding, 0)) - F.col("blocks")).cast("int").alias("base"),
    )
    return groups.join(blocks, ["bucket", "family"]).select("bucket", "first", "base", "blocks", "total", "alone")


def _tiles(members: DataFrame, families: DataFrame, limit: int) -> DataFrame:
    """Deal members to pairs of blocks: (bucket, part_a, part_b, own block); a small bucket is one block."""
    none = F.lit(0)
    small = members.where(F.col("size") <= limit).withColumns({"block": none, "part_a": none, "part_b": none})
    dealt = members.where(F.col("size") > limit).join(families, ["bucket", "first"]).withColumn(
        "block", (F.col("base") + F.pmod(F.xxhash64("rep", "bucket"), F.col("blocks"))).cast("int")
    )
    others = F.filter(
        F.sequence(none, F.col("total") - 1),
        lambda i: ~F.col("alone") | (i < F.col("base")) | (i >= F.col("base") + F.col("blocks")),
    )
    large = dealt.withColumn("other", F.explode(others)).withColumns(
        {"part_a": F.least("block", "other"), "part_b": F.greatest("block", "other")}
    )
    return small.unionByName(large.select(small.columns))


KEY = ("bucket", "part_a", "part_b")


def _by_bucket(members: DataFrame) -> DataFrame:
    return members.repartition(*KEY).sortWithinPartitions(*KEY, "rep")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each tile, from partitions sorted by KEY; at most two blocks each."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        now = pa.concat_tables([rest, now]).combine_chunks() if rest is not None else now
        keys = np.stack([np.asarray(now.column(k)) for k in KEY])
        cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
        starts = [0, *cuts]
        for a, b in zip(starts, cuts):
            yield now.slice(a, b - a)
        rest = now.slice(starts[-1])
    if rest is not None:
        yield rest


def _first_meeting(group: pa.Table) -> np.ndarray:
    """Pairs (matrix) that this bucket is to count: no smaller bucket holds both, and the tile is theirs."""
    bucket = group.column("bucket")[0].as_py()
    lists = group.column("leaves").combine_chunks()
    flat, owner = np.asarray(lists.flatten()), np.repeat(np.arange(len(lists)), np.diff(np.asarray(lists.offsets)))
    flat, owner = flat[flat < bucket], owner[flat < bucket]
    values, column, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[column] > 1 if len(values) else np.zeros(0, bool)
    met = np.zeros((len(lists), len(values)), np.float32)
    met[owner[keep], column[keep]] = 1
    met = met[:, count > 1]
    first = met @ met.T == 0
    block = np.asarray(group.column("block"))
    a, b = group.column("part_a")[0].as_py(), group.column("part_b")[0].as_py()
    if a != b:
        first &= block[:, None] != block[None, :]
    np.fill_diagonal(first, False)
    return first


def _alike(group: pa.Table, similarity: float) -> np.ndarray:
    """Pairs whose sizes and sketches do not rule out the similarity."""
    n = np.asarray(group.column("n")).astype(np.float64)
    marks = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(len(n), BINS)
    out = np.minimum(n[:, None], n[None, :]) >= similarity * np.maximum(n[:, None], n[None, :]) - 1e-9
    for i in range(len(n)):
        there = (marks[i] | marks) != 0
        same = ((marks[i] == marks) & there).sum(axis=1)
        m = there.sum(axis=1)
        out[i] &= same >= m * similarity - SIGMAS * np.sqrt(m * similarity * (1 - similarity)) - 1e-9
    return out


def _screen(members: DataFrame, similarity: float) -> DataFrame:
    """Members of tiles that have a partner to be compared exactly."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows < 2:
                continue
            alike = _alike(group, similarity)
            np.fill_diagonal(alike, False)
            if not alike.any():
                continue
            live = (alike & _first_meeting(group)).any(axis=1)
            if live.any():
                yield from group.filter(pa.array(live)).select([*KEY, "block", "rep", "n", "copies", "leaves"]).to_batches()

    return _by_bucket(members).mapInArrow(
        look, "bucket long, part_a int, part_b int, block int, rep long, n int, copies long, leaves array<long>"
    )


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections in a tile."""
    tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, count = np.unique(tokens, return_inverse=True, return_counts=True)
    keep = count[column] > 1
    owner, column = owner[keep], (np.cumsum(count > 1) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    out = np.zeros((len(sets), len(sets)))
    step = 8192
    for a in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        low, high = np.searchsorted(column, [a, a + step])
        part = np.zeros((len(sets), step), np.float32)
        part[owner[low:high], column[low:high] - a] = 1
        out += part @ part.T
    return out


def _links(members: DataFrame, similarity: float) -> DataFrame:
    """Per member of a tile: rows it is linked to there, and the smallest member it hangs together with."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            if group.num_rows < 2:
                continue
            sets = [np.frombuffer(s, np.uint64) for s in group.column("tokens").to_pylist()]
            n = np.array([len(s) for s in sets], np.float64)
            both = _overlaps(sets)
            linked = both * (1 + similarity) >= similarity * (n[:, None] + n[None, :]) - 1e-9
            linked &= _first_meeting(group)
            rep, copies = np.asarray(group.column("rep")), np.asarray(group.column("copies"))
            root = np.arange(len(n))
            while True:
                near = np.where(linked, root[None, :], len(n)).min(axis=1)
                lower = np.minimum(root, near)
                lower = np.minimum(lower, lower[lower])
                if (lower == root).all():
                    break
                root = lower
            live = linked.any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [rep[live], (linked @ copies)[live].astype(np.int64), rep[root[live]]], names=["rep", "links", "root"]
            )

    return _by_bucket(members).mapInArrow(count, "rep long, links long, root long")


def jaccard_join(
    docs: DataFrame, similarity: float = 0.8, recall: float = 0.999, bucket_limit: int = 512, max_depth: int = 3
) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links, copy_of.

    class_id is the smallest doc_id of the group that hangs together by links
    (Jaccard similarity of shingle sets >= similarity), copy_of the smallest
    doc_id with an equal set, n_links the number of other rows linked to this one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    known = docs.where("doc_id IS NOT NULL")
    sets = saved(_sets(known, similarity, runs_needed(recall, max_depth)))
    reps = saved(
        sets.where("n > 0").groupBy("digest").agg(
            F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"),
            F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("buckets").alias("buckets"),
        )
    )
    levels = [saved(_shared(reps.select("rep", F.explode("buckets").alias("bucket")).distinct()))]
    leaves = levels[0]
    for _ in range(1, max_depth):
        big = levels[-1].where(F.col("size") > bucket_limit)
        if not big.limit(1).count():
            break
        inner = _split(known, big.select("bucket", "rep"), similarity)
        levels.append(saved(_shared(inner)))
        discard(inner)
        leaves = leaves.where(F.col("size") <= bucket_limit).unionByName(levels[-1])
    lists = leaves.groupBy("rep").agg(F.sort_array(F.collect_list("bucket")).alias("leaves"))
    facts = saved(reps.dropDuplicates(["rep"]).select("rep", "n", "copies", "sketch").join(lists, "rep").withColumn("first", F.element_at("leaves", 1)))
    large = leaves.where(F.col("size") > bucket_limit).join(facts.select("rep", "first"), "rep")
    families = saved(_families(large, bucket_limit))
    live = saved(_screen(_tiles(leaves.join(facts, "rep"), families, bucket_limit), similarity))
    for done in (*levels, facts, families):
        discard(done)
    wanted = saved(live.select(F.col("rep").alias("doc_id")).distinct())
    tokens = _tokens(known.join(wanted, "doc_id", "left_semi").dropDuplicates(["doc_id"]))
    found = saved(_links(live.join(tokens, "rep"), similarity))
    for done in (live, wanted):
        discard(done)
    roots = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    classes = reps.select("digest", "rep", "copies").join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    placed = saved(sets.where("n > 0").select("doc_id", "digest").join(classes, "digest", "left").select(
        "doc_id", F.coalesce("root", "rep").alias("class_id"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.col("rep").alias("copy_of"),
    ).unionByName(sets.where("n = 0").select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("copy_of"),
    )))
    for done in (sets, reps, found, roots):
        discard(done)
    nameless = docs.where("doc_id IS NULL")
    return placed.unionByName(nameless.select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("copy_of"),
    ))


def _tokens(texts: DataFrame) -> DataFrame:
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "text"):
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"),
                pa.array([shingle_set(t).tobytes() for t in batch.column("text").to_pylist()], pa.binary()),
            ], names=["rep", "tokens"])

    return texts.mapInArrow(read, "rep long, tokens binary")


def keep_one(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """Rows of docs whose doc_id is the smallest of its group; of rows with equal doc_id one stays.

    Rows without a doc_id are kept as they are.
    """
    found = jaccard_join(docs, similarity)
    kept = found.where("doc_id = class_id").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).join(kept, "doc_id", "left_semi")
    return named.unionByName(docs.where("doc_id IS NULL"))
