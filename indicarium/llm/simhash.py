"""SimHash near-dedup: exact comparison of all fingerprints, tile by tile.

A tile holds the fingerprints whose four 16-bit quarters have the same
population counts. Two fingerprints within ``radius`` bits differ by at
most ``radius`` in those counts, summed, so only tile pairs that near are
compared, each by numpy exclusive-or and bit counts. Equal fingerprints are
one row before that. A large tile is dealt out in blocks, and a task that
compares two blocks returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import content_key, in_arrow, small_batches, staged, utf8
from indicarium.llm.components import components

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

#: Quarters of a fingerprint whose population counts name its tile.
PARTS, PART_BITS = 4, 16
#: Fingerprints in one block of a tile, about.
BLOCK = 2048
_SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    """Unsigned 64-bit SimHash: a bit is set where over half of the shingles' hashes have it."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _SHINGLES_AT_ONCE):
        hashes = b"".join([xxhash.xxh64_digest(line[a:b], seed) for a, b in zip(starts[at : at + _SHINGLES_AT_ONCE], ends[at : at + _SHINGLES_AT_ONCE])])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, k1, k2 (the row's content key) and fp, the fingerprint as a signed long."""
    small_batches(docs.sparkSession)
    k1, k2 = content_key(F.col("doc_id"), F.col("text"))
    rows = docs.select("doc_id", "text", k1.alias("k1"), k2.alias("k2"))

    def run(batch: pa.RecordBatch) -> dict:
        fp = np.array([fingerprint(t, width, seed) for t in utf8(batch.column("text"))], np.uint64).view(np.int64)
        return {"doc_id": batch.column("doc_id"), "k1": batch.column("k1"), "k2": batch.column("k2"), "fp": fp}

    return in_arrow(rows, run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, k1 long, k2 long, fp long")


def _steps(radius: int) -> list[int]:
    """Differences of tile numbers within ``radius``, one of each opposite pair."""
    near = [d for d in itertools.product(range(-radius, radius + 1), repeat=PARTS) if sum(map(abs, d)) <= radius]
    return sorted({abs(sum(x * 64**i for i, x in enumerate(d))) for d in near})


def _tile() -> Column:
    quarter = [F.bit_count(F.shiftrightunsigned("fp", i * PART_BITS).bitwiseAND(F.lit((1 << PART_BITS) - 1))) for i in range(PARTS)]
    return sum((q * 64**i for i, q in enumerate(quarter[1:], 1)), quarter[0]).cast("int")


def near_links(fps: DataFrame, radius: int = 2, block: int = BLOCK) -> DataFrame:
    """Distinct fp -> links (a, b) that connect all fingerprints within ``radius`` bits of one another."""
    spark = fps.sparkSession
    tiles = fps.select("fp", _tile().alias("tile"))
    # a row for each tile, of which there are 17 ** 4 at most
    sizes = tiles.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("n_blocks"))
    blocks = staged(tiles.join(F.broadcast(sizes), "tile").withColumn("block", F.pmod(F.xxhash64("fp"), F.col("n_blocks")).cast("int"))
                    .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")), "tiles")
    left = blocks.select("tile", "block", F.col("fps").alias("left"), F.explode(F.lit(_steps(radius))).alias("step"))
    left = left.withColumn("other", F.col("tile") + F.col("step"))
    right = blocks.select(F.col("tile").alias("other"), F.col("block").alias("other_block"), F.col("fps").alias("right"))
    pairs = left.join(right, "other").where("step > 0 or block <= other_block").select("left", "right")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))

    def run(batch: pa.RecordBatch) -> dict:
        a, b = [], []
        for x, y in zip(batch.column("left"), batch.column("right")):
            p, q = forest(x.values.to_numpy().view(np.uint64), y.values.to_numpy().view(np.uint64), radius)
            a.append(p), b.append(q)
        return {"a": np.concatenate(a).view(np.int64), "b": np.concatenate(b).view(np.int64)}

    return in_arrow(pairs, run, "a long, b long")


def forest(x: np.ndarray, y: np.ndarray, radius: int, rows: int = 128) -> tuple[np.ndarray, np.ndarray]:
    """Links (node, root) that connect what the pairs of ``x`` and ``y`` within ``radius`` bits connect."""
    nodes = np.concatenate([x, y])
    root = np.arange(len(nodes))
    for at in range(0, len(x), rows):
        near = np.bitwise_count(x[at : at + rows, None] ^ y[None]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            root = united(root, i + at, j + len(x))
    links = np.flatnonzero(root != np.arange(len(nodes)))
    return nodes[links], nodes[root[links]]


def united(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots after linking i to j: the smaller root is hooked on until no link joins two roots."""
    while True:
        p, q = root[i], root[j]
        open_ = p != q
        if not open_.any():
            return root
        i, j, p, q = i[open_], j[open_], p[open_], q[open_]
        root = root.copy()
        np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
        while not np.array_equal(up := root[root], root):
            root = up


def classes(prints: DataFrame, radius: int = 2) -> DataFrame:
    """fp -> root, for fingerprints that are linked with another one."""
    return components(near_links(prints.select("fp").distinct(), radius)).withColumnsRenamed({"node": "fp"})


def simhash_components(spark: SparkSession, docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42) -> DataFrame:
    """Per document: doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable).

    Null and empty texts have fingerprint zero, which links like any other.
    A null doc_id is a member of its component but never its name, unless
    no member has one. Repeated rows are all returned.
    """
    prints = staged(fingerprints(docs, width, seed), "fingerprints").select("doc_id", "fp")
    roots = classes(prints, radius)
    names = prints.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots, "fp", "left")
    names = staged(names.select("fp", "least", F.coalesce("root", "fp").alias("root")), "classes")
    ids = names.join(staged(names.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids"), "root").select("fp", "component_id")
    return prints.join(ids, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one_each(spark: SparkSession, docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42) -> DataFrame:
    """One document of each component: that with the smallest doc_id (null last), then smallest content key."""
    prints = staged(fingerprints(docs, width, seed), "fingerprints")
    roots = classes(prints, radius)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k1", "k2")
    first = prints.groupBy("fp").agg(F.min(rank).alias("first")).join(roots, "fp", "left")
    kept = first.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first")).select("first.doc_id", "first.k1", "first.k2")
    kept = kept.select(F.col("doc_id").alias("__id"), F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    k1, k2 = content_key(F.col("doc_id"), F.col("text"))
    rows = docs.withColumns({"__a": k1, "__b": k2})
    same = (F.col("__a") == F.col("__k1")) & (F.col("__b") == F.col("__k2"))
    return rows.join(staged(kept, "kept"), same, "left_semi").dropDuplicates(["__a", "__b"]).select(*docs.columns)
