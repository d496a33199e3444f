"""Substring dedup by hashing of lines, their sentences, runs of short ones and paragraphs.

Units are lines and, where a line has several, its sentences, each of
``min_words`` words at least; so a passage that was pasted into a line is
found as well. A shorter line or sentence makes a unit with as many of those
behind it as it takes to reach the minimum, and one with as many before it;
so each line of a repeated passage of the minimum's length is found, however
the passage is broken into lines. A paragraph (lines up to a blank one) is a unit
too. In scripts without spaces some characters count as one word. A unit is
normalised (lower case, single blanks) and hashed
to 128 bits. Of each digest's occurrences that of lowest rank stays:
smallest doc_id (null last), then content key, then offset. The others'
byte spans in the original texts are removed, except those that overlap
the one that stays.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import content_key, dropped, in_arrow, small_batches, staged, utf8

MIN_WORDS = 8

#: A stop, closing quotes, brackets and the like, blanks; stops of other scripts need no blank behind them.
_SENTENCE_END = re.compile(rb"[.!?][^\s0-9A-Za-z\x80-\xff]*\s+|(?:%s)(?:%s|[\"')\]])*\s*" % tuple("|".join(marks).encode() for marks in ("。！？｡．।॥؟۔။។", "」』）】》〉”’")))

#: Characters of scripts without spaces, and how many of them count as one word.
_DENSE = [(re.compile("[\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]"), 2),
          (re.compile("[\u0e00-\u0eff\u0f00-\u0fff\u1000-\u109f\u1780-\u17ff\u1950-\u19df]"), 5)]


def normalised(text: bytes) -> tuple[bytes, int]:
    """The text in lower case with single blanks, and its length in words."""
    lower = text.decode("utf-8", "replace").lower()
    words = lower.encode().split()
    size = len(words)
    if not lower.isascii() and any(r.search(lower) for r, _ in _DENSE):
        size = sum(max(1, sum(len(r.findall(w.decode())) // n for r, n in _DENSE)) for w in words)
    return b" ".join(words), size


def units(text: bytes, min_words: int = MIN_WORDS) -> list[tuple[int, int, bytes]]:
    """(start, end, normalised text) of each unit; a line's end includes its newline, a sentence's the blanks after it."""
    out, pieces, paragraph, start = [], [], [], 0
    for line in text.splitlines(keepends=True):
        end = start + len(line)
        unit, size = normalised(line)
        if unit:
            paragraph.append((start, end, unit, size))
        else:
            out += _paragraph(paragraph, min_words)
            paragraph = []
        if size >= min_words:
            out.append((start, end, unit))
            ends = [m.end() for m in _SENTENCE_END.finditer(line)]
            if ends and ends[-1] != len(line):
                ends.append(len(line))
            if len(ends) > 1:
                at = 0
                for e in ends:
                    part, n = normalised(line[at:e])
                    if n >= min_words:
                        out.append((start + at, start + e, part))
                    if part:
                        pieces.append((start + at, start + e, part, n))
                    at = e
            else:
                pieces.append((start, end, unit, size))
        elif unit:
            pieces.append((start, end, unit, size))
        start = end
    out += _paragraph(paragraph, min_words)
    runs = {}
    for i, piece in enumerate(pieces):
        if piece[3] < min_words:
            for step in (1, -1):
                j, n = i, piece[3]
                while n < min_words and 0 <= j + step < len(pieces):
                    j += step
                    n += pieces[j][3]
                if n >= min_words:
                    runs[min(i, j), max(i, j)] = None
    return out + [(pieces[i][0], pieces[j][1], b" ".join(p[2] for p in pieces[i : j + 1])) for i, j in runs]


def _paragraph(lines: list[tuple[int, int, bytes, int]], min_words: int) -> list[tuple[int, int, bytes]]:
    """The unit of several lines without a blank one, where they have the length together."""
    if len(lines) < 2 or sum(n for *_, n in lines) < min_words:
        return []
    return [(lines[0][0], lines[-1][1], b" ".join(unit for _, _, unit, _ in lines))]


def _key(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", content_key(F.col("doc_id"), F.col("text"))[0].alias("k"))


def hashed_units(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, k (content key), start, end, h1, h2 of every unit."""
    small_batches(docs.sparkSession)

    def run(batch: pa.RecordBatch) -> dict:
        row, start, end, digests = [], [], [], []
        for i, text in enumerate(utf8(batch.column("text"))):
            for a, b, unit in units(text, min_words):
                row.append(i), start.append(a), end.append(b), digests.append(xxhash.xxh3_128_digest(unit))
        h = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
        at = pa.array(row, pa.int64())
        return {"doc_id": batch.column("doc_id").take(at), "k": batch.column("k").take(at), "start": pa.array(start, pa.int32()), "end": pa.array(end, pa.int32()),
                "h1": pa.array(h[:, 0].copy()), "h2": pa.array(h[:, 1].copy())}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(_key(docs), run, f"doc_id {kind}, k long, start int, end int, h1 long, h2 long")


def repeated_spans(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, k, spans: the byte spans to remove, for documents that have any.

    A digest that very many units share is combined before its shuffle, and is
    a skewed key that AQE splits in the joins; no task gathers its units.
    """
    every = staged(hashed_units(docs, min_words), "units")
    again = staged(every.groupBy("h1").count().where("count > 1").select("h1"), "repeated-hashes")
    shared = staged(every.join(again, "h1", "left_semi"), "shared-units")
    dropped(every)
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "k", "start", "end")
    first = shared.groupBy("h1", "h2").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    # of units that overlap the first one in its own document, that one stays whole
    same_doc = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("k") == F.col("first.k"))
    late = shared.join(staged(first, "first-units"), ["h1", "h2"]).where(~(same_doc & (F.col("start") < F.col("first.end"))))
    return late.groupBy("doc_id", "k").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def kept(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of the text, and the maximal removed spans."""
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    edges = [0, *(x for span in out for x in span), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), [(a, b) for a, b in out]


def substring_dedup(spark: SparkSession, docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, spans (start, end in bytes of the original), kept_sha256, text (what is left).

    Null and empty texts have no unit, and an empty text is left of them. Rows
    of the same doc_id and text count as one document: they lose the same spans,
    and a unit of theirs is no repeat of itself.
    """
    spans = repeated_spans(docs, min_words).select(F.col("doc_id").alias("id"), F.col("k").alias("key"), "spans")
    rows = _key(docs)
    rows = rows.join(spans, (F.col("k") == F.col("key")) & rows["doc_id"].eqNullSafe(F.col("id")), "left").select("doc_id", "text", "spans")
    kind = docs.schema["doc_id"].dataType.simpleString()
    small_batches(spark)

    def run(batch: pa.RecordBatch) -> dict:
        texts = utf8(batch.column("text"))
        made = [kept(t, [(s["start"], s["end"]) for s in sp or ()]) for t, sp in zip(texts, batch.column("spans").to_pylist())]
        return {"doc_id": batch.column("doc_id"), "n_bytes": [len(t) for t in texts], "n_removed": [len(t) - len(x) for t, (x, _) in zip(texts, made)],
                "n_spans": [len(s) for _, s in made], "spans": [[{"start": a, "end": b} for a, b in s] for _, s in made],
                "kept_sha256": [hashlib.sha256(x).hexdigest() for x, _ in made], "text": pa.array([x for x, _ in made], pa.binary()).cast(pa.string())}

    return in_arrow(rows, run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept_sha256 string, text string")
