"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

The benchmark is bounded by ``block_bytes``: it is packed into as many
blocks as that asks for, each with an automaton of its own, and every
document passes all of them; a text longer than a block is cut into parts that
overlap by a window less a word. One block is the usual case. A document's
normalised text is scanned once per block; word numbers, and for texts
with hits byte offsets in the original, are mapped back from the match
positions.
"""

from __future__ import annotations

import re
import uuid

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import in_arrow, small_batches, staged, utf8

#: Words are runs of digits, lower-case a-z and bytes of other than ASCII characters.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

#: Bytes of benchmark text in one automaton, at most; its windows hold ``size`` times that, about a trie node a byte.
BLOCK_BYTES = 1 << 19

#: The automaton that a worker built last, by the name of its scan.
_AUTOMATA: dict[str, ahocorasick.Automaton] = {}


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORD_BYTES).split()


def windows(text: bytes, size: int) -> set[bytes]:
    """The text's windows: ``size`` words in a row, or all of its words where it has fewer."""
    w = words(text)
    return {b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def parts(text: bytes, size: int, limit: int) -> list[bytes]:
    """The text's words in parts of ``limit`` bytes at most, or one window, that have the text's windows between them."""
    w = words(text)
    out, first = [], 0
    while w:
        end = min(first + size, len(w))
        used = sum(map(len, w[first:end])) + end - first
        while end < len(w) and used + len(w[end]) + 1 <= limit:
            used += len(w[end]) + 1
            end += 1
        out.append(b" ".join(w[first:end]))
        if end == len(w):
            break
        first = end - size + 1
    return out


def automaton(items: list[tuple[str, bytes]], size: int) -> ahocorasick.Automaton:
    """Every window, between blanks, with its number of words and the items that hold it."""
    held: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(text, size):
            held.setdefault(w, set()).add(item)
    out = ahocorasick.Automaton()
    for w, ids in held.items():
        out.add_word(f" {w.decode('latin-1')} ", (w.count(b" ") + 1, tuple(sorted(ids))))
    out.make_automaton()
    return out


def scan(text: bytes, found: ahocorasick.Automaton) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, hit word runs (first, last) without overlap, items whose windows occur."""
    w = words(text)
    if not w or not len(found):
        return len(w), [], set()
    line = f" {b' '.join(w).decode('latin-1')} "
    matches = list(found.iter(line))
    if not matches:
        return len(w), [], set()
    blanks = np.flatnonzero(np.frombuffer(line.encode("latin-1"), np.uint8) == 32)
    last = np.searchsorted(blanks, [end for end, _ in matches]) - 1
    first = last + 1 - np.array([n for _, (n, _) in matches])
    return len(w), merged(sorted(zip(first.tolist(), last.tolist()))), {i for _, (_, ids) in matches for i in ids}


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in runs:
        if out and a <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def byte_spans(text: bytes, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word runs as byte offsets (start, end) in the original text."""
    at = [m.span() for m in _WORD.finditer(text)] if hits else []
    return [(at[a][0], at[b][1]) for a, b in hits]


def find_contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 13, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` (all columns, any names) with a struct column ``__found``: n_words, hits, items, spans.

    Null and empty texts have no words and no hits. Null items of the
    benchmark count under the name ``""``; null texts of it have no window.
    Repeated rows each get their own answer. An empty benchmark hits nothing.
    """
    small_batches(spark)
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = [items] if total <= block_bytes else _blocks(items, size, block_bytes)
    columns = docs.columns
    out = docs
    for b, part in enumerate(blocks):
        shared = spark.sparkContext.broadcast([(r.item, bytes(r.text)) for r in part.collect()])
        out = _scanned(out, shared, size, first=b == 0, last=b == len(blocks) - 1)
        if b < len(blocks) - 1:
            out = staged(out, "decontamination")
    return out.select(*columns, "__found")


def _blocks(items: DataFrame, size: int, block_bytes: int) -> list[DataFrame]:
    """The benchmark in blocks of ``block_bytes`` of text at most."""
    def cut(batch: pa.RecordBatch) -> dict:
        made = [(i, p) for i, t in enumerate(utf8(batch.column("text"))) for p in parts(t, size, block_bytes)]
        return {"item": batch.column("item").take(pa.array([i for i, _ in made], pa.int64())), "text": [p for _, p in made]}

    cuts = staged(in_arrow(items, cut, "item string, text binary").withColumn("at", F.monotonically_increasing_id()), "benchmark-parts")
    ends, used = [], 0
    for r in cuts.select("at", F.length("text").alias("n")).orderBy("at").toLocalIterator():
        if not ends or used + r.n > block_bytes:
            ends.append(r.at)
            used = 0
        used += r.n
    return [cuts.where((F.col("at") >= a) & (F.col("at") < b) if b is not None else F.col("at") >= a) for a, b in zip(ends, [*ends[1:], None])] or [items]


def _scanned(docs: DataFrame, shared, size: int, first: bool, last: bool) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    found = "struct<n_words:long,hits:array<struct<first:long,last:long>>,items:array<string>,spans:array<struct<start:long,end:long>>>"
    schema = StructType([f for f in docs.schema if f.name != "__found"]).add("__found", _parse_datatype_string(found))
    kind = to_arrow_schema(schema)

    key = uuid.uuid4().hex

    def run(batches):
        if key not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[key] = automaton(shared.value, size)
        for batch in batches:
            before = [None] * batch.num_rows if first else batch.column("__found").to_pylist()
            made = []
            for text, old in zip(utf8(batch.column("text")), before):
                n, hits, ids = scan(text, _AUTOMATA[key])
                if old:
                    hits = merged(sorted(hits + [(h["first"], h["last"]) for h in old["hits"]]))
                    ids |= set(old["items"])
                spans = byte_spans(text, hits) if last else []
                made.append({"n_words": n, "hits": [{"first": a, "last": b} for a, b in hits], "items": sorted(ids), "spans": [{"start": a, "end": b} for a, b in spans]})
            rest = [batch.column(f.name) for f in kind if f.name != "__found"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(made, kind.field("__found").type)], schema=kind)

    return docs.mapInArrow(run, schema)


def n_hit() -> Column:
    return F.aggregate("__found.hits", F.lit(0).cast("long"), lambda s, h: s + h["last"] - h["first"] + 1)


def contaminated(share: int = 20) -> Column:
    """At least one word in ``share`` is hit."""
    return (n_hit() > 0) & (n_hit() * share >= F.col("__found.n_words"))


def report(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans (bytes of the original)."""
    found = find_contamination(spark, docs.select("doc_id", "text"), benchmark, size)
    return found.select(
        "doc_id", F.col("__found.n_words").alias("n_words"), n_hit().alias("n_hit"), F.size("__found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "__found.items"), 256).alias("items_sha256"), contaminated().alias("contaminated"), F.col("__found.spans").alias("spans"))


def remove_contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, size: int = 13) -> DataFrame:
    """The documents that are not contaminated, with their columns as they came."""
    return find_contamination(spark, docs, benchmark, size).where(~contaminated()).select(*docs.columns)
