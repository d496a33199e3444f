"""Packing by minimum bin slack: a subset-sum choice of pieces for each window.

Each document becomes token ids and an end id, cut into whole windows and a
rest. Rests, with the windows, are a slim table of pieces. A task packs its
share of that table, block by block: from the multiset of remaining
lengths, a bitset subset-sum picks the multiset that fills a window closest
to its capacity, backtracking gives how often each length is used, and the
choice is repeated as long as the lengths last.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from indicarium.llm.common import in_arrow, small_batches, staged

WINDOW = 4096
END_ID = 2
#: Pieces that are packed together, at most; memory of a task, not a limit on the input.
BLOCK = 1 << 16
#: Distinct parts of strings whose ids a worker remembers.
MEMORY = 1 << 19
#: Parts of letters that are encoded as one text.
JOINED = 4096

#: utf8_split_whitespace() takes these for white space, the tokenizer does not.
_ODD = "[\x1c-\x1f]"
#: Marks that make a token run of their own behind letters (an apostrophe may belong to them).
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters that are composed and have one lower-case letter each.
_LETTERS = "".join(c for c in map(chr, range(0x250)) if c.isalpha() and c != "\u0130")

_ENCODERS: dict[str, "Encoder"] = {}


class Memory:
    """Ids of distinct strings as a column; ``how`` encodes a list of those that are new."""

    def __init__(self, how: Callable[[list[str]], list[bytes]]) -> None:
        self.how, self.known, self.ids = how, pa.array([], pa.string()), pa.array([], pa.large_binary())

    def look(self, column: pa.Array) -> pa.Array:
        """Ids of each string."""
        coded = column.dictionary_encode()
        at = pc.index_in(coded.dictionary, value_set=self.known)
        if at.null_count:
            if len(self.known) + at.null_count > MEMORY:  # only this column's strings stay
                used = at.drop_null()
                self.known, self.ids = self.known.take(used), self.ids.take(used)
                at = pc.replace_with_mask(at, at.is_valid(), pa.array(range(len(used)), pa.int32()))
            new, before = coded.dictionary.filter(at.is_null()), len(self.known)
            self.known = pa.concat_arrays([self.known, new])
            self.ids = pa.concat_arrays([self.ids, pa.array(self.how(new.to_pylist()), pa.large_binary())])
            at = pc.replace_with_mask(at, at.is_null(), pa.array(range(before, len(self.known)), pa.int32()))
        return self.ids.take(at.take(coded.indices))


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit numbers; each distinct string is encoded once.

    The tokenizer drops white space and no token spans it, so a text's ids are
    those of its white-space-free strings. One of Latin letters and marks behind
    them is further the ids of its lower-case letters, then of its marks.
    Letters are one token run, whose last id alone ends a word, so that
    many of them are encoded as one text; lower-case and composed as they are,
    they are normal already. Strings are split, told apart and put together
    again a column at a time; only new parts are seen one by one.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer, self.normal = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.normal.normalizer = None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.heads, self.tails, self.others = Memory(self.letters), Memory(self.plain), Memory(self.plain)

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def letters(self, parts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for at in range(0, len(parts), JOINED):
            some = parts[at : at + JOINED]
            ids = np.array(self.normal.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stops = np.flatnonzero(self.ends[ids]) + 1
            if len(stops) != len(some):
                raise ValueError("this tokenizer does not end each word with one id")
            data, starts = ids.tobytes(), np.concatenate([[0], stops[:-1]])
            out += [data[4 * a : 4 * b] for a, b in zip(starts.tolist(), stops.tolist())]
        return out

    def strings(self, column: pa.Array) -> pa.Array:
        """Ids of each white-space-free string."""
        core = pc.utf8_rtrim(column, _MARKS)
        split = pc.and_(pc.equal(pc.utf8_ltrim(core, _LETTERS), ""), pc.not_equal(core, ""))
        heads = self.heads.look(pc.utf8_lower(core.filter(split)))
        tails = self.tails.look(pc.utf8_ltrim(column.filter(split), _LETTERS))
        both = pc.binary_join_element_wise(heads, tails, pa.scalar(b"", pa.large_binary()))
        other = self.others.look(column.filter(pc.invert(split)))
        ids = pc.replace_with_mask(pa.nulls(len(column), pa.large_binary()), split, both)
        return pc.replace_with_mask(ids, pc.invert(split), other)

    def encode(self, texts: pa.Array) -> list[bytes]:
        odd = pc.match_substring_regex(texts, _ODD)
        split = pc.utf8_split_whitespace(pc.if_else(odd, "", texts))
        coded = split.flatten().dictionary_encode()
        ids = self.strings(coded.dictionary).take(coded.indices)
        stops = np.concatenate([[0], np.cumsum(pc.binary_length(ids).to_numpy(), dtype=np.int64)])[split.offsets.to_numpy()].tolist()
        data = memoryview(ids.buffers()[2] or b"")
        return [self.plain([t.as_py()])[0] if o else bytes(data[a:b]) for t, o, a, b in zip(texts, odd.to_pylist(), stops, stops[1:])]


def encode(texts: list[str] | pa.Array, path: str) -> list[bytes]:
    if path not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path].encode(pa.array(texts, pa.string()))


def cut(ids: bytes, window: int = WINDOW) -> list[tuple[int, int, int]]:
    """(start, length, CRC-32) of each piece: whole windows, then the rest."""
    n = len(ids) // 4
    return [(at, min(window, n - at), zlib.crc32(ids[4 * at : 4 * (at + window)])) for at in range(0, n, window)]


def pieces(docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of each document's pieces; a null text is an empty one."""
    small_batches(docs.sparkSession, 10000)
    end = np.array([end_id], "<u4").tobytes()

    def run(batch: pa.RecordBatch) -> dict:
        row, start, length, crc, total = [], [], [], [], []
        for i, ids in enumerate(encode(batch.column("text").cast(pa.string()).fill_null(""), path)):
            ids += end
            for a, n, c in cut(ids, window):
                row.append(i), start.append(a), length.append(n), crc.append(c), total.append(len(ids) // 4)
        return {"doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())), "start": start, "length": length, "ids_crc32": crc, "doc_tokens": total}

    kind = docs.schema["doc_id"].dataType.simpleString()
    return in_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def fullest(left: dict[int, int], room: int, order: list[int]) -> Counter:
    """The multiset of ``left`` (length -> count, lengths in ``order``) whose sum is closest to ``room``, not above it.

    ``reach`` has a bit for each sum. Counts are split into powers of two, so a
    length that is there n times takes log n steps; from the bits before each
    step the choice is read back.
    """
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for i in range(bisect_right(order, room) - 1, -1, -1):
        length = order[i]
        n, k = min(left[length], room // length), 1
        while n > 0:
            k = min(k, n)
            steps.append((length, k, reach))
            reach = (reach | reach << length * k) & mask
            n, k = n - k, 2 * k
        if reach >> room:
            break
    at, used = reach.bit_length() - 1, Counter()
    for length, k, before in reversed(steps):
        if not before >> at & 1:
            used[length] += k
            at -= length * k
    return used


def plan(lengths: dict[int, int], window: int = WINDOW) -> list[tuple[dict[int, int], int]]:
    """(lengths with counts in a window, number of such windows) until every length is used up.

    The longest remaining length is always taken, so that no rest of long ones piles up.
    """
    left, order, out = dict(lengths), sorted(lengths), []
    while order:
        longest = order[-1]
        left[longest] -= 1
        used = fullest(left, window - longest, order)
        left[longest] += 1
        used[longest] += 1
        times = min(left[n] // k for n, k in used.items())
        out.append((dict(used), times))
        for n, k in used.items():
            left[n] -= k * times
            if not left[n]:
                del order[bisect_left(order, n)]
    return out


def place(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, int]:
    """Window number and offset of each piece; number of windows."""
    order = np.argsort(lengths, kind="stable")
    first = dict(zip(*(x.tolist() for x in np.unique(lengths[order], return_index=True))))
    number, offset, n = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), 0
    for used, times in plan(Counter(lengths.tolist()), window):
        at = 0
        for length, k in used.items():
            took = order[first[length] : first[length] + k * times].reshape(times, k)
            first[length] += k * times
            number[took] = n + np.arange(times)[:, None]
            offset[took] = at + length * np.arange(k)
            at += length * k
        n += times
    return number, offset, n


def pack(spark: SparkSession, docs: DataFrame, path: str, window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null and empty texts are the end id alone. Repeated rows are packed each;
    an empty table has no piece. Pieces are packed where they lie, without a
    shuffle; only the last windows of a block can be left with padding.
    """
    cut_up = staged(pieces(docs, path, window, end_id), "pieces")
    schema = StructType(list(cut_up.schema)).add("sequence_id", "long").add("offset", "long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")

    def run(batches):
        made, block, size = 0, [], 0

        def packed():
            nonlocal made
            rows = pa.Table.from_batches(block).combine_chunks().to_batches()[0]
            number, offset, n = place(rows.column("length").to_numpy(), window)
            number += (TaskContext.get().partitionId() << 40) + made
            made += n
            return pa.RecordBatch.from_arrays([*rows.columns, pa.array(number), pa.array(offset)], names=schema.names)

        for batch in batches:
            block.append(batch)
            size += batch.num_rows
            if size >= BLOCK:
                yield packed()
                block, size = [], 0
        if size:
            yield packed()

    return cut_up.mapInArrow(run, schema)
