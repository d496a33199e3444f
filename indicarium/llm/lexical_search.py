"""Ranked lexical search of many queries at once, sharing what they have in common.

The queries' (items') terms are looked up in every document once; a
document keeps its length and the terms that any item asks for. Term sets that
several items share are mined: an item's terms, most shared first, are a
sequence, and pairs of neighbours that two or more items hold are replaced by a
node of their own, round by round, until none is left. The nodes are a DAG over
the terms. For a run of documents a node's partial accumulator (a score for each
document) is computed once, from those of its two parts, and an item's scores
are the sum of the few nodes that it is made of. A task keeps each
item's best documents; a window ranks those of all tasks.

Items come in blocks of ``block_bytes`` of text, each with its own vocabulary
and DAG, so what a task holds does not grow with the items.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicarium.llm.common import dropped, in_arrow, small_batches, staged, utf8
from indicarium.llm.decontamination import _WORD_BYTES

#: Bytes of item text in one block, at most (one longer item goes alone).
BLOCK_BYTES = 1 << 20
#: Bytes of text that are words at a time, and of accumulators that a task holds.
PART_BYTES, HELD_BYTES = 1 << 20, 1 << 26


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The text's terms in lists, cut between terms."""
    line = text.translate(_WORD_BYTES)
    at = 0
    while at < len(line):
        end = line.find(b" ", at + PART_BYTES)
        end = len(line) if end < 0 else end
        yield line[at:end].split()
        at = end


def sharing_dag(items: list[list[int]], n_terms: int) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Nodes (two parts each, numbered after the terms) that items share, and each item as nodes and terms.

    A round takes the most shared pairs of neighbours that have no part in
    common, so none of their places overlap and each new node has the items that
    were counted for it.
    """
    held = Counter(t for item in items for t in item)
    now = [sorted(item, key=lambda t: (-held[t], t)) for item in items]
    nodes: list[tuple[int, int]] = []
    while True:
        pairs = Counter(p for item in now for p in zip(item, item[1:]))
        chosen: dict[tuple[int, int], int] = {}
        taken: set[int] = set()
        for (a, b), n in sorted(((p, n) for p, n in pairs.items() if n > 1), key=lambda x: (-x[1], x[0])):
            if a not in taken and b not in taken:
                taken |= {a, b}
                chosen[a, b] = n_terms + len(nodes)
                nodes.append((a, b))
        if not chosen:
            return nodes, now
        for i, item in enumerate(now):
            out, at = [], 0
            while at < len(item):
                node = chosen.get((item[at], item[at + 1])) if at + 1 < len(item) else None
                out.append(item[at] if node is None else node)
                at += 1 if node is None else 2
            now[i] = out


def _add(total: np.ndarray | None, part: tuple[np.ndarray, np.ndarray] | np.ndarray, rows: int) -> np.ndarray:
    """The total, a new array where there was none, with a term's (rows, scores) or a node's accumulator added."""
    if total is None:
        total = np.zeros(rows, np.int64)
    if isinstance(part, tuple):
        total[part[0]] += part[1]
    else:
        total += part
    return total


def item_scores(rows: int, at: np.ndarray, term: np.ndarray, score: np.ndarray, nodes: list[tuple[int, int]], items: list[list[int]], n_terms: int) -> Iterator[tuple[int, np.ndarray]]:
    """(item, scores of ``rows`` documents) of the items that any of them scores in; at, term, score: what terms add."""
    order = np.argsort(term, kind="stable")
    at, term, score = at[order], term[order], score[order]
    cuts = np.flatnonzero(np.diff(term, prepend=-1))
    made: dict[int, tuple[np.ndarray, np.ndarray] | np.ndarray] = {}
    for a, b in zip(cuts, [*cuts[1:], len(term)]):
        made[int(term[a])] = (at[a:b], score[a:b])
    for n, (a, b) in enumerate(nodes):
        parts = [made[x] for x in (a, b) if x in made]
        if parts:  # a node with one part there is that part
            made[n_terms + n] = parts[0] if len(parts) == 1 else _add(_add(None, parts[0], rows), parts[1], rows)
    for i, item in enumerate(items):
        total = None
        for x in item:
            if x in made:
                total = _add(total, made[x], rows)
        if total is not None:
            yield i, total


def _lookups(docs: DataFrame, vocabulary) -> DataFrame:
    """doc_id, n (terms), terms, tfs: which of the vocabulary a document holds, and how often."""
    def run(batch: pa.RecordBatch) -> dict:
        known = vocabulary.value
        lengths, found, often = [], [], []
        for text in utf8(batch.column("text")):
            n, held = 0, Counter()
            for part in terms(text):
                n += len(part)
                held.update(part)
            own = [t for t in held if t in known] if len(held) < len(known) else [t for t in known if t in held]
            lengths.append(n)
            found.append([known[t] for t in own])
            often.append([held[t] for t in own])
        return {"doc_id": batch.column("doc_id"), "n": lengths, "terms": found, "tfs": often}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", F.col("text").cast("binary").alias("text")), run, f"doc_id {kind}, n long, terms array<int>, tfs array<long>").where("n > 0")


def _best(found: DataFrame, plan, n_docs: int, n_all: int, top: int) -> DataFrame:
    """item, doc_id, score: each task's ``top`` documents of each item."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    schema = f"item int, doc_id {found.schema['doc_id'].dataType.simpleString()}, score long"
    kind = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, nodes, items = plan.value
        weights = np.array(weights, np.int64)
        step = max(64, min(4096, HELD_BYTES // 8 // (len(nodes) + 1)))
        kept: list[list[tuple]] = [[] for _ in items]
        for batch in batches:
            for first in range(0, batch.num_rows, step):
                part = batch.slice(first, step)
                rows, lists = part.num_rows, part.column("terms")
                ids = part.column("doc_id").to_pylist()
                m = np.array([10 + 90 * n * n_docs // n_all for n in part.column("n").to_pylist()], np.int64)
                at = np.repeat(np.arange(rows), np.diff(lists.offsets.to_numpy()))
                term = lists.flatten().to_numpy()
                tf = part.column("tfs").flatten().to_numpy()
                score = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[at]))
                for i, total in item_scores(rows, at, term, score, nodes, items, len(weights)):
                    least = max(1, -kept[i][-1][0] if len(kept[i]) == top else 1, np.partition(total, -top)[-top] if rows > top else 1)
                    new = [(-int(total[r]), ids[r] is None, ids[r]) for r in np.flatnonzero(total >= least)]
                    # ties of a null doc_id compare no further
                    kept[i] = heapq.nsmallest(top, kept[i] + new, key=lambda x: x if not x[1] else x[:2])
        out = [(i, doc, -less) for i, best in enumerate(kept) for less, _, doc in best]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kind)], schema=kind)

    return found.mapInArrow(run, schema)


def _blocks(items: DataFrame, block_bytes: int) -> list[tuple[int, int | None]]:
    """Ranges of ``at`` with ``block_bytes`` of text at most."""
    starts, used = [], 0
    for r in items.select("at", F.length("text").alias("n")).orderBy("at").toLocalIterator():
        if not starts or used + r.n > block_bytes:
            starts.append(r.at)
            used = 0
        used += r.n
    return list(zip(starts, [*starts[1:], None]))


def lexical_search(spark: SparkSession, docs: DataFrame, queries: DataFrame, top: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of each row of ``queries`` (item_id, text), best first.

    Scores are as in the ``op11`` contract: saturated term counts, weighted by
    rarity, in whole numbers. Equal scores rank by doc_id, null last. Each
    row of either table counts by itself, equal ones too; null and empty texts
    have no terms: such a document is no document of the statistics, such an item
    finds none. An empty table of either kind gives no rows.
    """
    small_batches(spark)
    items = staged(queries.select("item_id", F.col("text").cast("binary").alias("text")).where("length(text) > 0").withColumn("at", F.monotonically_increasing_id()), "items")
    results = []
    for a, b in _blocks(items, block_bytes):
        block = items.where((F.col("at") >= a) & (F.col("at") < b) if b is not None else F.col("at") >= a)
        rows = sorted((r.at, bytes(r.text)) for r in block.select("at", "text").collect())  # block_bytes, or one item
        asked = [sorted({t for part in terms(text) for t in part}) for _, text in rows]
        known = {t: i for i, t in enumerate(sorted({t for item in asked for t in item}))}
        found = staged(_lookups(docs.select("doc_id", "text"), spark.sparkContext.broadcast(known)), "lookups")
        n_docs, n_all = found.agg(F.count(F.lit(1)), F.sum("n")).first()
        if known and n_docs:
            df = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())  # the block's terms
            weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df.get(t, 0) + 1))) for t in range(len(known))]
            nodes, made = sharing_dag([[known[t] for t in item] for item in asked], len(known))
            best = _best(found, spark.sparkContext.broadcast((weights, nodes, made)), n_docs, n_all, top)
            ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))).where(F.col("rank") <= top)
            numbers = spark.createDataFrame([(i, at) for i, (at, _) in enumerate(rows)], "item int, at long")
            results.append(staged(ranked.join(numbers, "item").select("at", "rank", "doc_id", "score"), "ranked"))
        dropped(found)
    empty = spark.createDataFrame([], f"at long, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long")
    return reduce(DataFrame.unionByName, results, empty).join(items.select("at", "item_id"), "at").select("item_id", "rank", "doc_id", "score")
