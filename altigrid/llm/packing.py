"""Best-fit packing of tokenised documents into sequences, by bin completion.

Documents become token ids and are cut into pieces only where they exceed the
sequence. What decides the packing is the histogram of piece lengths: at most
`capacity` numbers at any corpus size. Bin completion works on it: take the
largest length left, enumerate the undominated fillings of the rest of its
sequence, drop those whose waste no longer allows fewer sequences than the best
known solution, and go on depth first; a best-fit solution is the first
incumbent and completes each dive that runs out of budget. A pattern (a filling
with its largest length) is used as often as the counts allow at once, so the
search does not grow with the number of documents.

Pieces then get a rank among those of their length (counts per task, then
offsets) and the rank leads to pattern, sequence and place by a search in the
pattern list, which is bounded as the histogram is.

Null text is empty: one piece with the end mark. Rows with equal or null doc_id
are documents each of its own. An empty table gives an empty result. Columns
other than doc_id and text are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from altigrid.llm.common import discard, hold, saved, small_batches, wider

CAPACITY = 4096
END = 1
# How the tokenizer's file cuts lower-cased text into words, for Latin-1.
_PLAIN = re.compile("[\n\t\r\x20-\x7e\xa1-\xff]*").fullmatch
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_LOWER = bytes(range(256)).decode("latin-1").lower().encode("latin-1").translate(bytes.maketrans(b"\n\t\r", b"   "))
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[32] = _SPACE
_KIND[[b for b in range(256) if re.match("[a-zªµºß-öø-ÿ]", chr(b))]] = _LETTER
_KIND[[b for b in range(256) if re.match("[0-9²³¹¼-¾]", chr(b))]] = _DIGIT
# Whether a part begins at a byte, by 4 * its kind + the kind before.
_BEGINS = np.array([k == _SPACE or before != _SPACE and (k != before or k == _DIGIT) for k in range(4) for before in range(4)])
# The printable character that stands for each byte in the tokenizer's vocabulary.
_SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_BYTE_LEVEL = {b: chr(b if b in _SHOWN else 256 + sum(other not in _SHOWN for other in range(b))) for b in range(256)} | {32: " "}
BLOCK = 3_000_000  # bytes that are cut into parts at once
_READY: dict[str, "ChunkIds"] = {}


def _begins(data: np.ndarray) -> np.ndarray:
    """Where parts of lower-cased Latin-1 begin; the first byte is a space.

    A part is what is one word to the tokenizer, with the space before it if there is one: letters, single
    digits, other marks, English contractions. A space that no word follows is a part of its own.
    """
    kind = _KIND[data]
    begin = np.append(True, _BEGINS[4 * kind[1:] + kind[:-1]])
    quote = np.flatnonzero(data == ord("'"))
    quote = quote[kind[quote - 1] != _OTHER]
    if len(quote):
        one, two = (np.append(data, [0, 0])[quote + k] for k in (1, 2))
        pairs = [(one == a) & (two == b) for a, b in (b"re", b"ve", b"ll")]
        width = np.where(np.isin(one, list(b"stmd")), 2, np.where(np.any(pairs, axis=0), 3, 0))
        quote, width = quote[width > 0], width[width > 0]
        begin[quote + 1] = False
        after = quote + width
        begin[after[after < len(data)]] = True
    return np.flatnonzero(begin)


class ChunkIds:
    """Token ids of texts by the tokenizer in `path`, with a bounded cache.

    The tokenizer lower-cases, drops white space and cuts texts into parts that it encodes one by one. Texts
    are cut so in blocks, whose distinct parts get their ids from the cache or, new ones together, from the tokenizer's
    model. That holds for texts of printable Latin-1; any other text is encoded whole. A cache of
    more than `most` parts keeps those met in most blocks, half as many at most.
    """

    def __init__(self, path: str, most: int = 500_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_file(path), most
        self.model = Tokenizer(self.tokenizer.model)  # without normalizer and cutting
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        """Part k has ids[bounds[k]:bounds[k + 1]] and was met in met[k] blocks."""
        self.known: dict[bytes, int] = {b" ": 0}
        self.ids, self.bounds, self.met = np.zeros(0, "<u4"), np.zeros(2, np.int64), np.zeros(1, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, parts: list[bytes]) -> None:
        """Ids of parts that are one word to the tokenizer each, told apart by its ends of words."""
        shown = b" ".join(p.lstrip(b" ") for p in parts).decode("latin-1")
        if not shown.isascii():
            shown = shown.encode().decode("latin-1").translate(_BYTE_LEVEL)
        ids = np.array(self.model.encode_batch_fast([shown.split(" ")], is_pretokenized=True, add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(parts):
            each = [self._whole(p.decode("latin-1")) for p in parts]
            ids, stops = np.concatenate(each), np.cumsum([len(e) for e in each])
        self.known.update(zip(parts, range(len(self.met), len(self.met) + len(parts))))
        self.bounds = np.append(self.bounds, len(self.ids) + stops)
        self.ids = np.append(self.ids, ids)
        self.met = np.append(self.met, np.zeros(len(parts), np.int64))

    def _shrink(self) -> None:
        """Keep the parts met in most blocks, those of long ago counting half; those met in one only go."""
        kept = np.argsort(-self.met[1:], kind="stable")[:self.most // 2] + 1
        kept = np.append(0, np.sort(kept[self.met[kept] > 1]))
        names = list(self.known)
        first, n = self.bounds[kept], np.diff(self.bounds)[kept]
        self.known = {names[k]: i for i, k in enumerate(kept.tolist())}
        self.ids, self.bounds, self.met = _runs(self.ids, first, n), np.append(0, np.cumsum(n)), (self.met[kept] + 1) // 2

    def _block(self, data: bytes, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a block, and how many of them stand before each of the places, at which parts begin."""
        begin = _begins(np.frombuffer(data, np.uint8))
        offsets = np.append(begin, len(data)).astype(np.int32)
        parts = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).dictionary_encode()
        own, text = np.asarray(parts.indices), parts.dictionary.buffers()[2].to_pybytes()
        stops = np.frombuffer(parts.dictionary.buffers()[1], np.int32, len(parts.dictionary) + 1).tolist()
        names = [text[a:b] for a, b in zip(stops, stops[1:])]  # to_pylist takes ten times as long
        at = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = len(self.known) + np.arange(len(new))
            self._learn([names[k] for k in new.tolist()])
        self.met[at] += 1
        first, n = self.bounds[at][own], np.diff(self.bounds)[at][own]
        before = np.append(0, np.cumsum(n))[np.searchsorted(begin, places)]
        ids = _runs(self.ids, first, n)
        if len(self.known) > self.most:
            self._shrink()
        return ids, before

    def of(self, texts: list[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        plain = [bool(_PLAIN(t)) and "<|" not in t for t in texts]
        raws = [t.encode("latin-1") for t, ok in zip(texts, plain) if ok]
        data = b"".join(b" " + r for r in raws).translate(_LOWER)
        starts = np.cumsum([0, *(len(r) + 1 for r in raws)])[:-1]
        blocks, bounds, at, n_ids = [], [], 0, 0
        while at < len(data):
            stop = len(data)
            if at + BLOCK < stop:  # at a space: the last in the block, or else the next one
                stop = data.rfind(b" ", at + 1, at + BLOCK)
                stop = stop if stop > 0 else data.find(b" ", at + BLOCK)
                stop = stop if stop > 0 else len(data)
            a, b = np.searchsorted(starts, (at, stop))
            ids, before = self._block(data[at:stop], starts[a:b] - at)
            blocks.append(ids.tobytes())
            bounds += (4 * (before + n_ids)).tolist()
            at, n_ids = stop, n_ids + len(ids)
        joined = b"".join(blocks)
        each = (joined[a:b] for a, b in zip(bounds, [*bounds[1:], len(joined)]))
        return [next(each) if ok else self._whole(t).tobytes() for t, ok in zip(texts, plain)]


def _runs(values: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """values[first:first + n] of each run, end to end."""
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(n) else 0
    return values[np.repeat(first - (ends - n), n) + np.arange(total)]


def chunk_ids(path: str) -> ChunkIds:
    """One cache for each Python worker and vocabulary."""
    if path not in _READY:
        _READY[path] = ChunkIds(path)
    return _READY[path]


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of at most `capacity` ids: doc_id, piece, start, length, ids_crc32 [, ids], part, nth.

    part and nth number the pieces of a length within the task that made them. A column
    `at` of docs comes along, 0 without it.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, at long, part int, nth long"
    schema += ", ids binary" if with_ids else ""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ready, part, seen = chunk_ids(path), TaskContext.get().partitionId(), Counter()
        hold("chunks", ready.clear)
        for batch in small_batches(batches, "text", BLOCK):
            out = [[] for _ in range(8 + with_ids)]
            for doc_id, at_doc, ids in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "at")), ready.of(batch.column("text").to_pylist())):
                ids += END.to_bytes(4, "little")
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at:at + 4 * capacity]
                    length = len(own) // 4
                    row = (doc_id, piece, at // 4, length, zlib.crc32(own), at_doc, part, seen[length], *([own] * with_ids))
                    seen[length] += 1
                    for column, value in zip(out, row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "at", "part", "nth", "ids"][:len(out)],
            )

    at = F.col("at") if "at" in docs.columns else F.lit(0).cast("long").alias("at")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", at).mapInArrow(read, schema)


def _by_place(pieces: DataFrame, capacity: int) -> DataFrame:
    """pieces numbered anew in the order of (at, doc_id, piece); at becomes a number of each piece in that order."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, rows = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64), 0
        for batch in batches:
            length = np.asarray(batch.column("length"))
            order = np.argsort(length, kind="stable")
            own, n = np.unique(length, return_counts=True)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) + np.repeat(seen[own] - (np.cumsum(n) - n), n)
            seen[own] += n
            at = (part << 40) + rows + np.arange(len(length))
            rows += len(length)
            fresh = {"at": pa.array(at, pa.int64()), "part": pa.array(np.full(len(length), part), pa.int32()), "nth": pa.array(nth)}
            names = batch.schema.names
            yield pa.RecordBatch.from_arrays([fresh.get(c, batch.column(c)) for c in names], names=names)

    by = ["at", "doc_id", "piece"]
    return pieces.repartitionByRange(*by).sortWithinPartitions(*by).mapInArrow(number, pieces.schema)


# A pattern is (lengths with their multiplicity, number of sequences filled so).
Pattern = tuple[tuple[tuple[int, int], ...], int]


def lower_bound(counts: np.ndarray, capacity: int) -> int:
    """Sequences that any packing needs: by total, and by lengths too large to share (L2 bound)."""
    size = np.arange(capacity + 1)
    total = int(counts @ size)
    n, mass = np.concatenate([[0], np.cumsum(counts)]), np.concatenate([[0], np.cumsum(counts * size)])
    best = -(-total // capacity)
    half = capacity // 2
    for a in range(0, half + 1):
        huge = int(n[-1] - n[capacity - a + 1])
        large = int(n[capacity - a + 1] - n[half + 1])
        rest = int(mass[half + 1] - mass[a]) - (large * capacity - int(mass[capacity - a + 1] - mass[half + 1]))
        best = max(best, huge + large + max(0, -(-rest // capacity)))
    return best


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best-fit decreasing on a histogram: sequences with equal content are one group."""
    open_groups: dict[int, list[list]] = {}
    residuals: list[int] = []
    closed: list[Pattern] = []

    def put(residual: int, content: tuple, n: int) -> None:
        if n:
            open_groups.setdefault(residual, []).append([content, n])

    for length in range(capacity, 0, -1):
        left = int(counts[length])
        while left:
            residuals = [r for r in open_groups if r >= length]
            if residuals:
                r = min(residuals)
                content, n = open_groups[r].pop()
                if not open_groups[r]:
                    del open_groups[r]
            else:
                r, content, n = capacity, (), -(-left // (capacity // length))
            fit = r // length
            full = min(n, left // fit)
            left -= full * fit
            put(r - fit * length, (*content, (length, fit)), full)
            n -= full
            if n and left:
                put(r - left * length, (*content, (length, left)), 1)
                left, n = 0, n - 1
            if n and content:
                put(r, content, n)
        for r in [r for r in open_groups if r < 1]:
            closed += [(c, n) for c, n in open_groups.pop(r)]
    return closed + [(c, n) for groups in open_groups.values() for c, n in groups]


def _dominated(small: tuple, large: tuple) -> bool:
    """Whether the items of `small` can be put into the items of `large` (best fit, decreasing, by counts)."""
    room = Counter(dict(large))
    for x, m in sorted(small, reverse=True):
        for r in sorted(r for r in room if r >= x and room[r]):
            fit = r // x
            full = min(room[r], m // fit)
            room[r] -= full
            room[r - fit * x] += full
            m -= full * fit
            if m and room[r]:
                room[r] -= 1
                room[r - m * x] += 1
                m = 0
            if not m:
                break
        if m:
            return False
    return True


def fillings(counts: np.ndarray, room: int, width: int, starts: int = 24, pairs_each: int = 2) -> list[tuple[int, tuple]]:
    """Undominated fillings of `room` from what counts has: (waste, lengths), least waste first.

    Each starts with one of the `starts` largest lengths that fit, alone or with one of the
    `pairs_each` lengths that leave least waste beside it, and takes the largest that fit from
    there on, so that nothing more could be added. At most `width` are returned.
    """
    there = np.flatnonzero(counts[:room + 1] > 0)
    there = there[there > 0]
    if not len(there):
        return [(room, ())]
    largest = np.zeros(room + 1, np.int64)
    largest[there] = there
    largest = np.maximum.accumulate(largest)

    def grow(taken: Counter, r: int) -> tuple[int, tuple]:
        x = int(largest[r])
        while x:
            m = min(r // x, int(counts[x]) - taken[x])
            if m > 0:
                taken[x] += m
                r -= m * x
            x = int(largest[min(r, x - 1)])
        return r, tuple(sorted(taken.items(), reverse=True))

    found = set()
    for a in there[::-1][:starts]:
        a = int(a)
        found.add(grow(Counter({a: 1}), room - a))
        pairs = there[there <= room - a]
        if len(pairs):
            third = largest[room - a - pairs]
            waste = room - a - pairs - third
            for k in np.argsort(waste, kind="stable")[:pairs_each]:
                taken = Counter((a, int(pairs[k])))
                if all(counts[x] >= m for x, m in taken.items()):
                    found.add(grow(taken, room - a - int(pairs[k])))
    kept: list[tuple[int, tuple]] = []
    for waste, items in sorted(found, key=lambda f: (f[0], sum(m for _, m in f[1]), f[1])):
        if not any(_dominated(items, other) for _, other in kept):
            kept.append((waste, items))
        if len(kept) == width:
            break
    return kept


def complete_bins(counts: np.ndarray, capacity: int = CAPACITY, budget: int = 12_000, width: int = 3) -> list[Pattern]:
    """Bin completion: patterns that use each length as often as counts says.

    The search ends at the lower bound, or after `budget` nodes with the best solution so far (a node of a wider search counts as often as it is wide). A
    search that ends before that is repeated with four times the starts, pairs and width,
    and with single as well as most repeats of a filling, until these take in all lengths. Only
    the lower bound proves a result best: fillings are greedy after their first two lengths.
    """
    counts = np.asarray(counts, np.int64)
    total = int(counts @ np.arange(capacity + 1))
    if not total:
        return []
    bound, best = lower_bound(counts, capacity), best_fit(counts, capacity)
    fewest = sum(n for _, n in best)
    spent, nodes, wide, n_lengths = 0, 0, 1, int(np.count_nonzero(counts))
    while fewest > bound and spent < budget:
        stack: list[tuple[np.ndarray, tuple | None, int, int]] = [(counts, None, 0, 0)]
        while stack and fewest > bound and spent < budget:
            left, chain, used, waste = stack.pop()
            nodes, spent = nodes + 1, spent + wide
            allowed = (fewest - 1) * capacity - total
            if waste > allowed:
                continue
            rest = np.flatnonzero(left)
            if not len(rest) or nodes % 500 == 0:
                tail = best_fit(left, capacity) if len(rest) else []
                if (n := used + sum(k for _, k in tail)) < fewest:
                    fewest, best, link = n, list(tail), chain
                    while link is not None:
                        best.append(link[0])
                        link = link[1]
                if not len(rest) or fewest == bound:
                    continue
            largest = int(rest[-1])
            left[largest] -= 1
            options = fillings(left, capacity - largest, width * wide, 24 * wide, 2 * wide)
            left[largest] += 1
            for spill, items in reversed(options):
                pattern = Counter({largest: 1})
                for x, m in items:
                    pattern[x] += m
                most = min(int(left[x]) // m for x, m in pattern.items())
                if spill:
                    most = min(most, max(1, (allowed - waste) // spill))
                for times in sorted({most, 1 if wide > 1 else most}):
                    if waste + spill * times > allowed:
                        continue
                    after = left.copy()
                    for x, m in pattern.items():
                        after[x] -= m * times
                    stack.append((after, ((tuple(sorted(pattern.items(), reverse=True)), times), chain), used + times, waste + spill * times))
        if wide >= n_lengths:
            break
        wide *= 4
    return best


def place(pieces: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """sequence_id and offset of numbered pieces (length, rank)."""
    lengths, ranks, first_sequence, each, first_offset = [], [], [], [], []
    used: Counter = Counter()
    sequence = 0
    for items, n in patterns:
        offset = 0
        for length, m in items:
            lengths.append(length)
            ranks.append(used[length])
            first_sequence.append(sequence)
            each.append(m)
            first_offset.append(offset)
            used[length] += m * n
            offset += m * length
        sequence += n
    order = np.lexsort((ranks, lengths))
    key = np.array(lengths, np.int64)[order] * (1 << 48) + np.array(ranks, np.int64)[order]
    rank0, seq0, m0, off0 = (np.array(c, np.int64)[order] for c in (ranks, first_sequence, each, first_offset))
    schema = wider(pieces.drop("rank"), {"sequence_id": "long", "offset": "long"})

    def seek(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = np.asarray(batch.column("length")), np.asarray(batch.column("rank"))
            at = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
            nth = rank - rank0[at]
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(seq0[at] + nth // m0[at]), pa.array(off0[at] + nth % m0[at] * length)],
                names=[*kept.schema.names, "sequence_id", "offset"],
            )

    return pieces.mapInArrow(seek, schema)


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, in_order: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset [, ids].

    With in_order, docs have a column `at` (long): pieces of equal length are taken in
    that order, and sequence ids rise with the first place that a sequence holds. They are
    then not consecutive. How many sequences there are does not change.
    """
    pieces = saved(token_pieces(docs, path or vocabulary(), capacity, with_ids))
    if in_order:
        read, pieces = pieces, saved(_by_place(pieces, capacity))
        discard(read)
    per_task = pieces.groupBy("length", "part").agg(F.max("nth").alias("last"))
    before = per_task.select(
        "length", "part",
        F.coalesce(F.sum(F.col("last") + 1).over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"),
    )
    counts = np.zeros(capacity + 1, np.int64)
    for row in pieces.groupBy("length").count().collect():  # at most `capacity` rows
        counts[row["length"]] = row["count"]
    ranked = pieces.join(before, ["length", "part"]).withColumn("rank", F.col("nth") + F.col("before"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] * with_ids)]
    placed = place(ranked.select(*columns, *(["at"] * in_order), "rank"), complete_bins(counts, capacity))
    if in_order:  # a sequence has at most `capacity` pieces
        first = F.min("at").over(W.partitionBy("sequence_id"))
        placed = placed.withColumn("sequence_id", first).drop("at")
    return placed
