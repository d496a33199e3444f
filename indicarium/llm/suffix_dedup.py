"""Suffix-array dedup by column-wise construction of collection Burrows-Wheeler transforms.

Every byte that a ``LENGTH``-byte string covers which also starts anywhere
else is removed. Equal strings have the same smallest gram hash at the same
place, so each document is cut into segments, runs of strings that share
their anchor (that smallest gram), and strings can only be equal within a
group: the segments of one anchor hash. Equal segments are one, with a
count; those are repeats as a whole. Distinct segments of a group are a
collection: their transform and common prefixes are built by inserting one
symbol of each segment a round, from the last to the first. A symbol is
``SYMBOL`` bytes, counted from the anchor, where equal strings are aligned;
the bytes that a string has beside whole symbols are compared after that.

A collection is a block of at most about ``BLOCK`` segments, of whole
groups, so its transform and prefixes stay in a task's memory in place of
external files. A group of more distinct segments (a passage that very
many documents share, in different surroundings) is split by narrower runs
of strings, keyed by the bytes that all strings of a run hold, down to
single strings if need be. The split is exact at each width.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import dropped, in_arrow, small_batches, staged, utf8

LENGTH = 400
GRAM, SYMBOL = 32, 8
#: Segments of a collection, and distinct segments of a group that is not split.
BLOCK = 1024
#: Strings in a run, at each split.
WIDTHS = (46, 6, 1)
#: Strings of a text that are looked at together.
CHUNK = 1 << 20

_PLACE = np.uint64(24)
_BASE = 0x9E3779B97F4A7C15
_BYTE = np.frombuffer(b"".join(hashlib.blake2b(bytes([b]), digest_size=8).digest() for b in range(256)), np.uint64)

RUNS = "array<struct<first:int,end:int>>"


def gram_hashes(text: np.ndarray, gram: int = GRAM) -> np.ndarray:
    """Mixed 64-bit hash of each ``gram``-byte string (a power of two) of a text of bytes."""
    h, width = _BYTE[text], 1
    while width < gram:
        h = h[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + h[width:]
        width *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def segments(text: bytes, length: int = LENGTH, gram: int = GRAM, chunk: int = CHUNK) -> Iterator[tuple[int, int, int, int]]:
    """(start, number of strings, anchor place, anchor hash) of the runs of ``length``-byte strings with one anchor."""
    data = np.frombuffer(text, np.uint8)
    for at in range(0, len(data) - length + 1, chunk):
        h = gram_hashes(data[at : at + chunk + length - 1], gram)
        n = len(h) - (length - gram)
        low = (h >> _PLACE << _PLACE) | np.arange(len(h), dtype=np.uint64)
        window, width = length - gram + 1, 1
        while 2 * width <= window:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if window > width:
            low = np.minimum(low[:n], low[window - width : window - width + n])
        place = (low[:n] & ((np.uint64(1) << _PLACE) - np.uint64(1))).astype(np.int64)
        first = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1])
        many = np.diff(np.append(first, n))
        for s, k, p, g in zip(first.tolist(), many.tolist(), place[first].tolist(), h[place[first]].view(np.int64).tolist()):
            yield at + s, k, at + p, g


def _long(data: bytes, seed: int = 0) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(data, seed), "big", signed=True)


class Collection:
    """Transform and common prefixes of a collection of symbol sequences, built column by column.

    ``symbol[k]`` precedes the k-th smallest suffix (-1 at a sequence's start),
    ``prefix[k]`` is the number of symbols it shares with the one before it.
    """

    def __init__(self, sequences: list[np.ndarray]) -> None:
        lengths = np.array([len(s) for s in sequences], np.int64)
        ends = np.cumsum(lengths)
        text = np.unique(np.concatenate([*sequences, np.empty(0, np.uint64)]), return_inverse=True)[1].astype(np.int32)
        every = np.arange(len(sequences))
        self.prefix = np.zeros(len(sequences), np.int32)
        self.owner, self.size = every.astype(np.int32), np.zeros(len(sequences), np.int32)
        place, live = every, every
        self.symbol = self._column(text, ends, lengths, every, 0)
        for j in range(1, int(lengths.max(initial=0)) + 1):
            keep = lengths[live] >= j
            live, place = live[keep], place[keep]
            place = self._insert(place, live, self._column(text, ends, lengths, live, j), j, len(sequences))

    @staticmethod
    def _column(text: np.ndarray, ends: np.ndarray, lengths: np.ndarray, live: np.ndarray, j: int) -> np.ndarray:
        """The symbol before each live sequence's suffix of j symbols."""
        at = ends[live] - j - 1
        return np.where(lengths[live] > j, text[np.maximum(at, 0)] if len(text) else -1, -1).astype(np.int32)

    def _insert(self, place: np.ndarray, live: np.ndarray, column: np.ndarray, j: int, n: int) -> np.ndarray:
        """Insert the suffixes of j symbols; returns their places."""
        order = np.argsort(self.symbol, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        mine, size = rank[place], len(order)
        least = _Least(self.prefix)
        before, after = order[np.maximum(mine - 1, 0)], order[np.minimum(mine + 1, size - 1)]
        same_before = (mine > 0) & (self.symbol[before] == self.symbol[place])
        same_after = (mine + 1 < size) & (self.symbol[after] == self.symbol[place])
        to_before = np.where(same_before, 1 + least(np.where(same_before, before, place - 1) + 1, place), 0)
        to_after = np.where(same_after, 1 + least(place + 1, np.where(same_after, after, place + 1)), 0)
        ended = int(np.count_nonzero(self.symbol < 0))
        new = mine - ended + n
        total = size - ended + n
        old = np.ones(total, bool)
        old[new] = False
        for name, value in (("symbol", column), ("prefix", to_before), ("owner", live), ("size", j)):
            now = np.empty(total, np.int32)
            now[old] = getattr(self, name)
            now[new] = value
            setattr(self, name, now)
        inside = new + 1 < total
        self.prefix[new[inside] + 1] = to_after[inside]
        return new


class _Least:
    """Smallest value between two places, both included, by doubling."""

    def __init__(self, values: np.ndarray) -> None:
        self.levels = [values]
        while 2 << len(self.levels) - 1 <= len(values):
            half = 1 << len(self.levels) - 1
            self.levels.append(np.minimum(self.levels[-1][:-half], self.levels[-1][half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        top = len(self.levels[0]) - 1
        first, last = np.minimum(first, top), np.minimum(last, top)
        last = np.maximum(first, last)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), np.int64)
        for k in np.unique(level):
            at = level == k
            out[at] = np.minimum(self.levels[k][first[at]], self.levels[k][last[at] - (1 << k) + 1])
        return out


def repeats(texts: list[bytes], anchors: list[int], length: int = LENGTH) -> list[list[tuple[int, int]]]:
    """Of each segment the runs (first, end) of its ``length``-byte strings that some other place of the collection holds as well.

    ``anchors``: places in the segments from which symbols are counted, both ways.
    """
    if not texts:
        return []
    phases = [a % SYMBOL for a in anchors]
    whole = (length - SYMBOL) // SYMBOL
    sequences = [np.frombuffer(t, np.uint64, (len(t) - p) // SYMBOL, p) if len(t) - p >= SYMBOL else np.empty(0, np.uint64) for t, p in zip(texts, phases)]
    made = Collection(sequences)
    shared = np.cumsum(made.prefix < whole)  # suffixes that share a string's whole symbols
    many = np.bincount(shared)[shared] > 1
    use = many & (made.size >= whole)
    owner, group = made.owner[use].astype(np.int64), shared[use]
    sizes = np.array([len(s) for s in sequences])
    symbol_at = np.array(phases)[owner] + SYMBOL * (sizes[owner] - made.size[use])
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    text = np.frombuffer(b"".join(texts), np.uint8)
    who, at, key, of = [], [], [], []
    for e in range(SYMBOL):  # bytes of the string before its first whole symbol
        x = symbol_at - e
        ok = (x >= 0) & (x + length <= lengths[owner])
        begin = starts[owner[ok]] + x[ok]
        beside = np.concatenate([np.arange(e), np.arange(e + whole * SYMBOL, length)])
        rest = np.ascontiguousarray(text[begin[:, None] + beside])
        who.append(owner[ok]), at.append(x[ok]), of.append(group[ok] * SYMBOL + e)
        key.append(np.ascontiguousarray(rest).view(f"V{rest.shape[1]}").ravel() if len(rest) else np.empty(0, f"V{len(beside)}"))
    who, at, of, key = np.concatenate(who), np.concatenate(at), np.concatenate(of), np.concatenate(key)
    out: list[list[tuple[int, int]]] = [[] for _ in texts]
    if not len(who):
        return out
    known: dict[tuple[int, bytes], int] = {}
    number = np.array([known.setdefault((g, k.tobytes()), len(known)) for g, k in zip(of.tolist(), key)], np.int64)
    again = np.bincount(number)[number] > 1
    who, at = who[again], at[again]
    order = np.lexsort((at, who))
    who, at = who[order], at[order]
    if len(who):
        breaks = np.flatnonzero((who[1:] != who[:-1]) | (at[1:] != at[:-1] + 1)) + 1
        for a, b in zip(np.concatenate([[0], breaks]), np.append(breaks, len(who))):
            out[who[a]].append((int(at[a]), int(at[b - 1]) + 1))
    return out


def _key(docs: DataFrame) -> DataFrame:
    """doc_id, text in bytes (null as empty) and its 128-bit content key."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    return docs.select("doc_id", text.alias("text")).withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(7), "text", F.length("text"))})


def cut_segments(rows: DataFrame, length: int) -> DataFrame:
    """k1, k2, start, n (strings), anchor (its place in the segment), g (anchor hash), d (digest) of all segments of all texts."""
    def run(batch: pa.RecordBatch) -> dict:
        row, made = [], []
        for i, text in enumerate(utf8(batch.column("text"))):
            for start, n, place, g in segments(text, length):
                row.append(i)
                made.append((start, n, place - start, g, _long(text[start : start + n + length - 1])))
        at, cols = pa.array(row, pa.int64()), list(zip(*made)) or [()] * 5
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        return {"k1": batch.column("k1").take(at), "k2": batch.column("k2").take(at)} | {k: pa.array(c, t) for k, c, t in zip(("start", "n", "anchor", "g", "d"), cols, kinds)}

    return in_arrow(rows.select("k1", "k2", "text"), run, "k1 long, k2 long, start int, n int, anchor int, g long, d long")


def _fetched(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """g, d, many, kinds, anchor, data: the bytes of the wanted segments (k1, k2, start, n, ...)."""
    lists = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "n", "anchor", "g", "d", "many", "kinds")).alias("wanted"))
    # copies of a text are combined before their shuffle, one row is joined
    found = rows.select("k1", "k2", "text").dropDuplicates(["k1", "k2"]).join(lists, ["k1", "k2"])

    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("g", "d", "many", "kinds", "anchor", "data")}
        for text, wanted in zip(utf8(batch.column("text")), batch.column("wanted").to_pylist()):
            for w in wanted:
                for k in ("g", "d", "many", "kinds", "anchor"):
                    out[k].append(w[k])
                out["data"].append(text[w["start"] : w["start"] + w["n"] + length - 1])
        return out

    return in_arrow(found, run, "g long, d long, many long, kinds long, anchor int, data binary")


def _by_collections(distinct: DataFrame, length: int, block: int) -> DataFrame:
    """g, d, runs of the repeated strings, for segments that are there once; groups of at most ``block`` segments."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = to_arrow_schema(_parse_datatype_string(f"g long, d long, runs {RUNS}"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes, int]] = []

        def solved(rows):
            runs = repeats([r[3] for r in rows], [r[2] for r in rows], length)
            made = [(r[0], r[1], [{"first": a, "end": b} for a, b in x]) for r, x in zip(rows, runs) if x and r[4] == 1]
            return pa.RecordBatch.from_arrays([pa.array([m[i] for m in made], f.type) for i, f in enumerate(schema)], schema=schema)

        for batch in batches:
            for r in zip(*(batch.column(c).to_pylist() for c in ("g", "d", "anchor", "data", "many"))):
                if len(held) >= block and r[0] != held[-1][0]:
                    yield solved(held)
                    held = []
                held.append(r)
        if held:
            yield solved(held)

    return distinct.select("g", "d", "anchor", "data", "many").repartition("g").sortWithinPartitions("g").mapInArrow(run, "g long, d long, runs " + RUNS)


def _split(distinct: DataFrame, width: int, length: int) -> DataFrame:
    """Narrower runs of each segment: g, d, first (place in it), g2 (hash of what all strings of the run hold), d2, n2, anchor, data, many."""
    def run(batch: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in ("g", "d", "first", "g2", "d2", "n2", "anchor", "data", "many")}
        for g, d, data, many, anchor in zip(*(batch.column(c).to_pylist() for c in ("g", "d", "data", "many", "anchor"))):
            n, at = len(data) - length + 1, 0
            while at < n:
                slot = (anchor - at) // width  # equal strings are at the same distance from the anchor
                end = min(n, anchor - slot * width + 1)
                core = data[anchor - slot * width : anchor - slot * width - width + 1 + length]
                piece = data[at : end + length - 1]
                for k, v in zip(out, (g, d, at, _long(core, slot & 0xFFFF ^ (g & 0xFFFFFFFF)), _long(piece), end - at, anchor - at, piece, many)):
                    out[k].append(v)
                at = end
        return out

    return in_arrow(distinct, run, "g long, d long, first int, g2 long, d2 long, n2 int, anchor int, data binary, many long")


def _solved(distinct: DataFrame, length: int, block: int, widths: tuple[int, ...]) -> DataFrame:
    """g, d, runs of repeated strings, for segments that are there once."""
    out = _by_collections(distinct.where(F.col("kinds") <= block), length, block)
    large = distinct.where(F.col("kinds") > block)
    if not widths or large.isEmpty():
        return out
    pieces = staged(_split(large, widths[0], length), "pieces")
    same = pieces.groupBy("g2", "d2").agg(F.sum("many").alias("many"), F.first("n2").alias("n2"), F.first("anchor").alias("anchor"), F.first("data").alias("data"))
    same = staged(same, "distinct-pieces")
    kinds = staged(same.groupBy("g2").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "kinds")
    rest = staged(same.join(kinds, "g2").select(F.col("g2").alias("g"), F.col("d2").alias("d"), "anchor", "data", "many", "kinds"), "open-pieces")
    runs = staged(_marks(same.select(F.col("g2").alias("g"), F.col("d2").alias("d"), "many", F.col("n2").alias("n")), _solved(rest, length, block, widths[1:])), "repeated-pieces")
    back = pieces.where("many = 1").select("g", "d", "first", "g2", "d2").join(runs.select(F.col("g").alias("g2"), F.col("d").alias("d2"), "runs"), ["g2", "d2"])
    shifted = F.transform("runs", lambda r: F.struct((r["first"] + F.col("first")).alias("first"), (r["end"] + F.col("first")).alias("end")))
    return out.union(back.groupBy("g", "d").agg(F.flatten(F.collect_list(shifted)).alias("runs")))


def _marks(distinct: DataFrame, runs: DataFrame) -> DataFrame:
    """g, d, runs: all of a segment that is there more than once, else what was found in it."""
    whole = distinct.where("many > 1").select("g", "d", F.array(F.struct(F.lit(0).alias("first"), F.col("n").alias("end"))).cast(RUNS).alias("runs"))
    return whole.union(runs.select("g", "d", F.col("runs").cast(RUNS)))


def repeated_runs(rows: DataFrame, length: int = LENGTH, block: int = BLOCK, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """k1, k2, runs: (first, end) starts of the repeated strings of each text that has any.

    A segment that very many texts hold is combined before each shuffle, and is
    a skewed key that AQE splits in the joins. The runs are written, so that
    their join to the rows can split a text of very many copies too.
    """
    every = staged(cut_segments(rows, length), "segments")
    again = staged(every.groupBy("g").count().where("count > 1").select("g"), "repeated-anchors")
    shared = staged(every.join(again, "g", "left_semi"), "shared-segments")
    dropped(every)
    place = F.min(F.struct("k1", "k2", "start", "n", "anchor")).alias("place")
    distinct = staged(shared.groupBy("g", "d").agg(F.count(F.lit(1)).alias("many"), place).select("g", "d", "many", "place.*"), "distinct-segments")
    kinds = staged(distinct.groupBy("g").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "kinds")
    texts = staged(_fetched(rows, distinct.join(kinds, "g"), length).dropDuplicates(["g", "d"]), "segment-texts")
    marks = staged(_marks(distinct, _solved(texts, length, block, widths)), "repeated-segments")
    found = shared.select("k1", "k2", "start", "g", "d").join(marks, ["g", "d"]).select("k1", "k2", "start", F.explode("runs").alias("r"))
    found = found.select("k1", "k2", F.struct((F.col("start") + F.col("r.first")).alias("first"), (F.col("start") + F.col("r.end")).alias("end")).alias("r"))
    return staged(found.groupBy("k1", "k2").agg(F.collect_set("r").alias("runs")), "repeated-runs")


def kept(text: bytes, runs: list[tuple[int, int]], length: int = LENGTH) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left without the bytes that the strings at the runs' places cover, and the maximal removed spans."""
    spans: list[list[int]] = []
    for first, end in sorted(runs):
        if spans and first <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end + length - 1)
        else:
            spans.append([first, end + length - 1])
    edges = [0, *(x for s in spans for x in s), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), [(a, b) for a, b in spans]


def suffix_dedup(spark: SparkSession, docs: DataFrame, length: int = LENGTH, block: int = BLOCK, widths: tuple[int, ...] = WIDTHS) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans (start, end in bytes), kept_sha256, kept (the remaining bytes).

    Null and empty texts have no bytes, and texts shorter than ``length`` lose
    none. Repeated rows repeat each other's strings, and lose them. Order and
    doc_id don't matter: all occurrences go.
    """
    small_batches(spark)
    rows = _key(docs)
    found = rows.join(repeated_runs(rows, length, block, widths), ["k1", "k2"], "left").select("doc_id", "text", "runs")

    def run(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        made = [kept(t, [(r["first"], r["end"]) for r in runs or ()], length) for t, runs in zip(texts, batch.column("runs").to_pylist())]
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t) for t in texts], "n_removed": [len(t) - len(x) for t, (x, _) in zip(texts, made)],
                "n_spans": [len(s) for _, s in made], "spans": [[{"start": a, "end": b} for a, b in s] for _, s in made],
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x, _ in made], "kept": [x for x, _ in made]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(found, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_sha256 string, kept binary")
