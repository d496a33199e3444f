"""Embedding near-dedup by product quantisation.

Vectors of unit length lie in coarse inverted lists; what is left after
the list's centre is coded by subspace. A vector is looked up in every
list whose border lies within ``MARGIN`` times the link radius of it. Its
distance to each code there (asymmetric: only the listed side is coded) is
taken for a whole list in one product with the decoded codes, as a list is
shorter than the tables that look-ups would need. A code whose distance, less
the code's own error, is beyond the radius holds no link, and all others are
compared by exact cosine in double precision.

Centres and codebooks are fitted on a bounded sample (``SAMPLE`` vectors);
every vector is indexed and looked up. Equal vectors are one node with a
count. Lists lie together on shelves, and a vector is sent to a shelf once,
however many of its lists it looks into. Long lists are dealt out in blocks of ``BLOCK``, so that a list that holds
a third of all vectors is many tasks; a task returns a count for each vector
and a spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import in_arrow, small_batches, staged
from indicarium.llm.components import components
from indicarium.llm.simhash import united

THRESHOLD = 0.9
#: Vectors that centres and codebooks are fitted on, at most.
SAMPLE = 1 << 16
#: Vectors a list is meant to hold, and lists, at most (a list may hold any number). Links don't depend on it; shorter
#: lists leave less to compare, at the price of more centres.
PER_LIST, LISTS = 64, 1 << 12
#: Share of the link radius within which a list's border must lie to be looked into. A link that crosses a border has an
#: end within half its length of it, so from 0.5 on no link is lost; what is above that is for rounding.
MARGIN = 0.5 + 1e-3
SUBSPACES, CODES = 8, 256
BLOCK = 2048
#: What single precision may add to a squared distance of unit vectors.
SLACK = 1e-3
#: Numbers in a matrix that is made at once.
CELLS = 1 << 18
#: Lists lie together on shelves: so many at least, and of so many vectors at most (a longer list has one of its own).
SHELVES, PER_SHELF = 16, 8192


@dataclass
class Quantiser:
    centres: np.ndarray
    books: list[np.ndarray]
    bounds: list[int]

    def near(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared distance to each centre (less the vector's own length), and the nearest centre."""
        d = (self.centres**2).sum(1) - 2 * x @ self.centres.T
        return d, d.argmin(1)

    def codes(self, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Subspace codes of the residuals and the errors they leave."""
        r = x - self.centres[home]
        code, error = np.empty((len(x), len(self.books)), np.uint8), np.zeros(len(x))
        for j, book in enumerate(self.books):
            s = r[:, self.bounds[j] : self.bounds[j + 1]]
            code[:, j] = ((book**2).sum(1) - 2 * s @ book.T).argmin(1)
            error += ((s - book[code[:, j]]) ** 2).sum(1)
        return code, np.sqrt(error)

    def probes(self, d: np.ndarray, home: np.ndarray, reach: float) -> np.ndarray:
        """Whether to look into each list: the border between a centre and the nearest one lies within ``reach`` of the vector. ``d``, ``home``: of ``near``."""
        homes, at = np.unique(home, return_inverse=True)
        lengths = (self.centres**2).sum(1)
        apart = np.sqrt(np.maximum(lengths[homes, None] + lengths - 2 * self.centres[homes] @ self.centres.T, 0))
        # the last term is for rounding where centres (almost) coincide
        return d - np.take_along_axis(d, home[:, None], 1) <= (2 * reach * apart + 1e-7)[at]

    def decoded(self, home: np.ndarray, code: np.ndarray) -> np.ndarray:
        """The vectors that codes of lists stand for."""
        out = self.centres[home]
        for j, book in enumerate(self.books):
            out[:, self.bounds[j] : self.bounds[j + 1]] += book[code[:, j]]
        return out


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres by Lloyd's rounds from the first k rows; a centre without rows stays."""
    centres, step = x[:k].copy(), max(1, CELLS // k)
    for _ in range(rounds if k > 1 or len(x) else 0):
        home = np.concatenate([((centres**2).sum(1) - 2 * x[i : i + step] @ centres.T).argmin(1) for i in range(0, len(x), step)])
        n = np.bincount(home, minlength=len(centres))
        order = np.argsort(home, kind="stable")
        sums = np.add.reduceat(x[order], np.minimum(np.cumsum(n) - n, len(x) - 1), axis=0)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def fit(x: np.ndarray, n: int) -> Quantiser:
    """Centres and codebooks for ``n`` vectors from a sample of unit vectors."""
    centres = k_means(x, max(1, min(LISTS, n // PER_LIST, len(x))))
    dims = x.shape[1]
    bounds = [round(i * dims / min(SUBSPACES, dims)) for i in range(min(SUBSPACES, dims) + 1)]
    out, step = Quantiser(centres, [], bounds), max(1, CELLS // len(centres))
    r = x - centres[np.concatenate([out.near(x[i : i + step])[1] for i in range(0, len(x), step)])]
    out.books = [k_means(np.ascontiguousarray(r[:, a:b]), min(CODES, len(x))) for a, b in zip(bounds, bounds[1:])]
    return out


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The numbers that a column of bytes holds, one row after another, and how many each row has."""
    column = column.cast(pa.large_binary())
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    size = np.dtype(kind).itemsize
    data = (column.buffers()[2] or pa.py_buffer(b""))[ends[0] : ends[-1]]
    return np.frombuffer(data, kind) if data.size else np.empty(0, kind), np.diff(ends) // size


def _vectors(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of the stored kind in double precision."""
    return _flat(column, kind)[0].astype(np.float64).reshape(len(column), -1)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(1))


def linked(queries: pa.StructArray, index: pa.StructArray, model: Quantiser, threshold: float, kind: str = "f8") -> tuple[list, list, list]:
    """Links between looked-up vectors and those of the lists they look into, as columns a, b, n: counts by node, and a spanning forest.

    A link counts for the vector that looks. It also counts for the one that
    was found, if that one doesn't look into the other's list itself.
    """
    q_raw, x_raw = _vectors(queries.field("vec"), kind), _vectors(index.field("vec"), kind)
    q_len, x_len = _lengths(q_raw), _lengths(x_raw)
    q = (q_raw / q_len[:, None]).astype(np.float32)
    q_home, x_home = queries.field("home").to_numpy(), index.field("home").to_numpy()
    code = model.decoded(x_home, _flat(index.field("code"), "u1")[0].reshape(len(x_raw), -1))
    reach = np.sqrt(2 - 2 * threshold) + 1e-4
    # a unit vector is within reach of a code from this product on
    least = ((1 + (code * code).sum(1) - (reach + index.field("error").to_numpy()) ** 2 - SLACK) / 2).astype(np.float32)
    code = code.astype(np.float32)
    nodes = pa.concat_arrays([queries.field("node"), index.field("node")]).dictionary_encode()
    q_at, x_at = np.split(nodes.indices.to_numpy(), [len(q)])
    q_many, x_many = queries.field("many").to_numpy(), index.field("many").to_numpy()
    looks = _flat(index.field("looks"), "u1")[0].reshape(len(x_raw), -1)
    counts, root = np.zeros(len(nodes.dictionary), np.int64), np.arange(len(nodes.dictionary))
    step = max(1, CELLS // q_raw.shape[1])

    def count(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        near = (q_raw[a] * x_raw[b]).sum(1) / (q_len[a] * x_len[b]) >= threshold
        a, b = a[near], b[near]
        if not len(a):
            return
        np.add.at(counts, q_at[a], x_many[b])
        one_way = (looks[b, q_home[a] >> 3] >> (7 - (q_home[a] & 7)) & 1) == 0
        np.add.at(counts, x_at[b[one_way]], q_many[a[one_way]])
        root = united(root, q_at[a], x_at[b])

    held: tuple[list, list] = ([], [])
    for i, j in by_list(*_flat(queries.field("cells"), "i4"), x_home):
        codes, bound, wide = code[j].T, least[j], max(1, CELLS // len(j))
        for at in range(0, len(i), wide):
            a, b = np.nonzero(q[i[at : at + wide]] @ codes >= bound)
            a, b = i[at + a], j[b]
            apart = q_at[a] != x_at[b]
            a, b = a[apart], b[apart]
            if len(a):
                held[0].append(a), held[1].append(b)
            if sum(map(len, held[0])) >= step:
                a, b = map(np.concatenate, held)
                for k in range(0, len(a), step):
                    count(a[k : k + step], b[k : k + step])
                held = ([], [])
    if held[0]:
        count(*map(np.concatenate, held))
    some, tree = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(root)))
    names = [nodes.dictionary.take(pa.array(k)).to_pylist() for k in (some, tree, root[tree])]
    return names[0] + names[1], [None] * len(some) + names[2], counts[some].tolist() + [0] * len(tree)


def shelves(sizes: dict[int, int]) -> dict[int, tuple[int, int]]:
    """The shelf of each list, and the blocks that the shelf's vectors are dealt out in."""
    room = max(1, min(PER_SHELF, sum(sizes.values()) // SHELVES))
    out: dict[int, tuple[int, int]] = {}
    at, used = 0, 0
    for cell in sorted(sizes):
        if used and used + sizes[cell] > room:
            at, used = at + 1, 0
        used += sizes[cell]
        out[cell] = (at, -(-used // BLOCK) if used > room else 1)
    return out


def _rows_by(values: np.ndarray, rows: np.ndarray) -> dict[int, np.ndarray]:
    order = np.argsort(values, kind="stable")
    kinds, first = np.unique(values[order], return_index=True)
    return dict(zip(kinds.tolist(), np.split(rows[order], first[1:])))


def by_list(cells: np.ndarray, n_cells: np.ndarray, home: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each list that both sides name the looking rows, and the rows it holds."""
    look, held = _rows_by(cells, np.repeat(np.arange(len(n_cells)), n_cells)), _rows_by(home, np.arange(len(home)))
    for cell in sorted(look.keys() & held.keys()):
        yield look[cell], held[cell]


def embedding_components(spark: SparkSession, vectors: DataFrame, threshold: float = THRESHOLD, margin: float = MARGIN) -> DataFrame:
    """Per vector: vec_id, n_links, component_id (smallest vec_id reachable, itself included), kept.

    Vectors that are null, zero, or hold null or non-finite components link with
    nothing; vectors link with those of their own length, and an index is made
    for each length. Repeated rows link with each other. A null vec_id is a
    member of its component but never its name. An empty table gives no row.
    """
    small_batches(spark)
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    fit_for_use = F.coalesce(finite & F.exists("embedding", lambda e: e != 0), F.lit(False))
    node = F.concat(F.lower(F.hex(F.xxhash64("embedding"))), F.lit("-"), F.lower(F.hex(F.xxhash64(F.lit(7), F.reverse("embedding"), F.size("embedding")))))
    rows = rows.withColumn("dims", F.when(fit_for_use, F.size("embedding")))
    rows = rows.withColumn("node", F.when(F.col("dims").isNotNull(), F.concat(node, F.lit("-"), F.col("dims").cast("string"))))
    alone = rows.where("node is null").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("many"), F.min("embedding").alias("embedding"))
    nodes = staged(nodes.withColumn("dims", F.size("embedding")), "nodes")
    # a row for each length that vectors have
    lengths = {r.dims: r["count"] for r in nodes.groupBy("dims").count().orderBy("dims").collect()}
    if not lengths:
        return alone
    # single-precision vectors are carried as such; all arithmetic is in double precision
    kind = "f4" if vectors.schema["embedding"].dataType.elementType.simpleString() == "float" else "f8"
    # a node that is alone in its length has no other to link with
    found = [_links_of_length(spark, nodes.where(F.col("dims") == d).drop("dims"), d, n, threshold, margin, kind) for d, n in lengths.items() if n > 1]
    found = reduce(DataFrame.union, found or [spark.createDataFrame([], "a string, b string, n long")])
    degree = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("n"))
    roots = components(found.where("b is not null").select("a", "b"))
    named = nodes.select("node", "least", "many").join(degree, "node", "left").join(roots, "node", "left")
    named = staged(named.select("node", "least", (F.coalesce("n", F.lit(0)) + F.col("many") - 1).alias("n_links"), F.coalesce("root", "node").alias("root")), "named-nodes")
    names = named.join(staged(named.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids"), "root").select("node", "n_links", "component_id")
    members = rows.where("node is not null").select("vec_id", "node").join(names, "node")
    return members.select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")).union(alone)


def _stored(column: pa.Array, kind: str) -> np.ndarray:
    """Vectors of one length without nulls, in the stored kind."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _links_of_length(spark: SparkSession, nodes: DataFrame, dims: int, n: int, threshold: float, margin: float, kind: str) -> DataFrame:
    """``_links`` of the ``n`` nodes that have ``dims`` components, by an index of their own."""
    sample = nodes.orderBy(F.xxhash64("node"), "node").limit(max(1, min(SAMPLE, (32 << 20) // (8 * dims)))).select("embedding")
    raw = in_arrow(sample, lambda batch: {"vec": [v.tobytes() for v in _stored(batch.column("embedding"), kind)]}, "vec binary").collect()
    x = np.frombuffer(b"".join(bytes(r.vec) for r in raw), kind).astype(np.float64).reshape(len(raw), -1)
    model = fit(x / _lengths(x)[:, None], n)
    return _links(spark, nodes, model, threshold, margin, kind)


def _links(spark: SparkSession, nodes: DataFrame, model: Quantiser, threshold: float, margin: float, kind: str) -> DataFrame:
    """Rows (a, null, n): n links counted for node a; rows (a, b, 0): a link of a spanning forest."""
    shared = spark.sparkContext.broadcast(model)
    reach = margin * float(np.sqrt(2 - 2 * threshold))

    def coded(batch: pa.RecordBatch) -> dict:
        model, raw = shared.value, _stored(batch.column("embedding"), kind)
        out: dict[str, list] = {"home": [], "code": [], "error": [], "looks": []}
        step = max(1, CELLS // len(model.centres))
        for at in range(0, len(raw), step):
            x = raw[at : at + step].astype(np.float64)
            x /= _lengths(x)[:, None]
            d, home = model.near(x)
            code, error = model.codes(x, home)
            out["home"] += home.tolist()
            out["code"] += [c.tobytes() for c in code]
            out["error"] += error.tolist()
            out["looks"] += [p.tobytes() for p in np.packbits(model.probes(d, home, reach), axis=1)]
        return {"node": batch.column("node"), "many": batch.column("many"), "vec": [v.tobytes() for v in raw], **out}

    index = staged(in_arrow(nodes, coded, "node string, many long, vec binary, home int, code binary, error float, looks binary"), "index")
    # a row for each list, LISTS at most
    on = shelves({r.home: r["count"] for r in index.groupBy("home").count().collect()})
    shelf = F.broadcast(spark.createDataFrame([(cell, *at) for cell, at in on.items()], "cell int, shelf int, n_blocks int"))
    found = index.join(shelf, index["home"] == shelf["cell"]).withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    held = found.groupBy("shelf", "block").agg(F.collect_list(F.struct("home", "node", "many", "vec", "code", "error", "looks")).alias("index")).drop("block")
    place = np.full(len(model.centres), -1, np.int32)  # an empty list is on no shelf
    for cell, (at, _) in on.items():
        place[cell] = at
    places = spark.sparkContext.broadcast(place)

    def sent(batch: pa.RecordBatch) -> dict:
        looks = _flat(batch.column("looks"), "u1")[0].reshape(batch.num_rows, -1)
        rows, to, cells = [], [], []
        step = max(1, CELLS // len(places.value))
        for at in range(0, len(looks), step):
            row, cell = np.nonzero(np.unpackbits(looks[at : at + step], axis=1, count=len(places.value)))
            row, cell = (v[places.value[cell] >= 0] for v in (row, cell.astype(np.int32)))
            if len(row):
                shelf = places.value[cell]  # they ascend with the lists
                first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (shelf[1:] != shelf[:-1])))
                rows += (at + row[first]).tolist()
                to += shelf[first].tolist()
                cells += [c.tobytes() for c in np.split(cell, first[1:])]
        at = pa.array(rows, pa.int64())
        return {c: batch.column(c).take(at) for c in ("node", "many", "vec", "home")} | {"shelf": to, "cells": cells}

    look = in_arrow(index.select("node", "many", "vec", "home", "looks"), sent, "node string, many long, vec binary, home int, shelf int, cells binary")
    look = staged(look, "look-ups")
    looks = look.groupBy("shelf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("n_blocks"))
    look = look.join(F.broadcast(looks), "shelf").withColumn("block", F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    look = look.groupBy("shelf", "block").agg(F.collect_list(F.struct("node", "many", "vec", "home", "cells")).alias("queries")).drop("block")
    pairs = look.join(held, "shelf")

    def run(batch: pa.RecordBatch) -> dict:
        made = [linked(q.values, x.values, shared.value, threshold, kind) for q, x in zip(batch.column("queries"), batch.column("index"))]
        return {name: [v for m in made for v in m[k]] for k, name in enumerate("abn")}

    return staged(in_arrow(pairs, run, "a string, b string, n long"), "embedding-links")
