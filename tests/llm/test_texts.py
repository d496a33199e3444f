"""Operators over documents against brute force, odd rows included."""

import hashlib
import random
import re
import sys
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from indicarium.llm import decontamination, line_dedup, packing, simhash, substring_dedup, suffix_dedup, token_counts, toxicity

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: str(r))


# 1


def brute_units(text):
    out = []
    for m in re.finditer(rb"[^\r\n]*(\r\n|\r|\n|$)", text):
        if m.group():
            out.append((m.start(), m.end()))
            at = m.start()
            cuts = [m.start() + x.end() for x in re.finditer(rb"[.!?][^\s0-9A-Za-z\x80-\xff]*\s+", m.group())]
            for c in [*cuts, m.end()]:
                out.append((at, c))
                at = c
    norm = lambda a, b: b" ".join(text[a:b].decode("utf-8", "replace").lower().encode().split())
    return {(a, b, norm(a, b)) for a, b in out if len(norm(a, b).split()) >= 8}


def test_substring_dedup(spark, frame, odd_texts, prose):
    passage = ". " + prose(9, 60, 1) + ". "
    data = odd_texts + [(20 + i, prose(30 + i, 40, 2) + passage + prose(50 + i, 40, 2)) for i in range(5)] + [(40, prose(99, 50))]
    got = substring_dedup.substring_dedup(spark, frame(data, extra=True)).collect()
    assert len(got) == len(data)
    docs = sorted({(i, (t or "")) for i, t in data if t}, key=lambda d: (d[0] is None, d[0] or 0))
    first = {}
    for d in docs:
        for a, _, u in sorted(brute_units(d[1].encode())):
            first.setdefault(u, (d, a))
    for r in got:
        source = next(t for i, t in data if i == r.doc_id and len((t or "").encode()) == r.n_bytes)
        b, mark = (source or "").encode(), bytearray(r.n_bytes)
        for a, e, u in brute_units(b):
            if first[u] != ((r.doc_id, source), a):
                mark[a:e] = b"\1" * (e - a)
        left = bytes(x for x, m in zip(b, mark) if not m)
        assert (r.n_removed, r.kept_sha256, r.text.encode()) == (sum(mark), hashlib.sha256(left).hexdigest(), left)
        assert sum(s.end - s.start for s in r.spans) == r.n_removed and len(r.spans) == r.n_spans
    assert {r.doc_id for r in got if r.n_removed} >= {21, 22, 23, 24, 2, None}
    assert all(r.n_removed == 0 for r in got if r.doc_id in (1, 20, 40))


def test_substring_dedup_of_short_lines(spark, frame, prose):
    """Verse, wrapped text, scripts without spaces and short sentences of a repeated passage go from all but the first document."""
    words = prose(5, 60, 1).split(" ")
    verse = "".join(" ".join(words[i : i + 3]) + ("\n\n" if i % 12 == 9 else "\n") for i in range(0, 60, 3))
    wrap = lambda n: "".join(" ".join(words[i : i + n]) + "\n" for i in range(0, 60, n))
    chinese = "天地玄黄宇宙洪荒日月盈昃辰宿列张。寒来暑往秋收冬藏闰余成岁律吕调阳。云腾致雨露结为霜金生丽水玉出昆冈。\n"
    mixed = "Short one here. " + prose(6, 20, 1) + ". No more. " + prose(8, 20, 1) + ". The end.\n"
    rest = {name: (f"x{name}1 y z\n" * 2, f"{name}2 q r\n") for name in "abcdefg"}
    docs = [("a", verse), ("b", verse), ("c", chinese), ("d", chinese), ("e", mixed), ("f", mixed), ("g", "0\n" * 100)]
    data = [(i, rest[n][0] + "\n" + t + "\n" + rest[n][1]) for i, (n, t) in enumerate(docs)]
    data += [(10, wrap(5)), (11, "\n" + wrap(4)), (12, "木" * 9 + "石" * 9), (13, "木" * 9 + "石" * 9)]
    got = {r.doc_id: r.text for r in substring_dedup.substring_dedup(spark, frame(data)).collect()}
    assert all(got[i] == data[i][1] for i in (0, 2, 4)) and got[12] == data[9][1]
    assert [got[i].split() for i in (1, 3, 5)] == [(rest[n][0] + rest[n][1]).split() for n in "bdf"]
    assert got[6].count("0\n") == 8 and got[11].strip() == got[13] == ""


# 2


def brute_hits(text, items, size):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    hit, found = set(), set()
    for name, item in items:
        v = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (item or "").translate(LOW))
        n = min(size, len(v))
        wins = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)} if v else set()
        for i in range(len(w)):
            if tuple(w[i : i + n]) in wins and len(w) - i >= n:
                hit |= set(range(i, i + n))
                found.add(name)
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination(spark, frame, odd_texts, prose, block_bytes):
    items = [(1, prose(70, 40)), (2, "Short, item"), (3, None), (4, "  "), (12, prose(1, 120)[100:300]), (None, "ÜNÏ cödé")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    data = odd_texts + [(30, prose(71, 60) + " " + prose(70, 40)[:150]), (31, "a SHORT -- item here"), (32, "short items"), (33, "ÜNÏ cödé")]
    docs = frame(data, extra=True)
    found = decontamination.find_contamination(spark, docs, bench, 13, block_bytes)
    from pyspark.sql import functions as F

    got = found.select("doc_id", "text", "__found", decontamination.n_hit().alias("hit"), decontamination.contaminated().alias("bad")).collect()
    named = [("" if i is None else str(i), t) for i, t in items]
    assert len(got) == len(data)
    for r in got:
        f = r["__found"]
        assert (f.n_words, r.hit, len(f["items"]), hashlib.sha256(",".join(f["items"]).encode()).hexdigest(), r.bad) == brute_hits(r.text, named, 13), r
        raw = (r.text or "").encode()
        for s in f.spans:  # offsets are whole words of the original
            assert re.fullmatch(rb"[0-9A-Za-z\x80-\xff].*[0-9A-Za-z\x80-\xff]", raw[s.start : s.end], re.S)
    kept = decontamination.remove_contaminated(spark, docs, bench)
    assert kept.columns == docs.columns and kept.where(F.col("doc_id").isin(31, 33)).count() == 0 and kept.where("doc_id = 32").count() == 1
    empty = bench.limit(0)
    assert decontamination.report(spark, docs, empty).where("contaminated").count() == 0


def test_blocks_of_the_benchmark_bound_the_automata(spark, frame, prose):
    """No automaton gets more text than a block's, not even of one long item, and its parts have the item's windows."""
    long = prose(72, 400).encode()
    made = decontamination.parts(long, 13, 300)
    assert max(map(len, made)) <= 300 and set().union(*(decontamination.windows(p, 13) for p in made)) == decontamination.windows(long, 13)
    assert decontamination.parts(b"a b", 13, 1) == [b"a b"] and decontamination.parts(b" .", 13, 9) == []
    assert 13 * decontamination.BLOCK_BYTES <= 16 << 20
    bench = spark.createDataFrame([(1, long.decode()), (2, "Short, item"), (3, prose(73, 30))], "item_id long, text string")
    items = bench.selectExpr("cast(item_id as string) item", "cast(text as binary) text")
    blocks = [b.collect() for b in decontamination._blocks(items, 13, 600)]
    assert len(blocks) > 3 and max(sum(len(r.text) for r in b) for b in blocks) <= 600
    docs = frame([(1, prose(74, 30) + " " + long.decode()[700:1100]), (2, prose(75, 30)), (3, "a short item"), (4, prose(73, 30))])
    got = [sorted(map(tuple, decontamination.find_contamination(spark, docs, bench, 13, n).select("doc_id", "__found").collect())) for n in (600, 1 << 20)]
    assert got[0] == got[1]


# 4


def brute_unigram(word, pieces, unknown):
    best = [(0.0, 0)] + [None] * len(word)
    for i in range(len(word)):
        options = [(best[i][0] + unknown, best[i][1] + len(word[i].encode()))]
        options += [(best[j][0] + pieces[word[j : i + 1]], best[j][1] + 1) for j in range(i + 1) if word[j : i + 1] in pieces]
        best[i + 1] = max(options, key=lambda o: (o[0], -o[1]))
    return best[-1][1]


def test_token_counts(spark, frame, odd_texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    pieces, unknown = token_counts.unigram(path)
    data = [(i, t if t is None else t[:400]) for i, t in odd_texts]
    for r in token_counts.token_counts(spark, frame(data, extra=True), path).collect():
        assert r.n_tokens >= r.n_pretokens >= 0
    known = {}
    for i, t in data:
        for w in (t or "").split():
            known[w] = brute_unigram("▁" + w, pieces, unknown)
    trie = token_counts.Trie(pieces, unknown)
    for w, n in known.items():
        assert trie.total([w]) == n, w
    got = Counter((r.doc_id, r.n_pretokens, r.n_tokens) for r in token_counts.token_counts(spark, frame(data), path).collect())
    blank = re.compile(r"\s+")
    assert got == Counter((i, len(w), sum(brute_unigram("▁" + x, pieces, unknown) for x in w)) for i, t in data for w in [[x for x in blank.split(t or "") if x]])


# 5


def test_suffix_dedup(spark, frame, odd_texts, prose):
    hot = prose(80, 70, 1)
    data = odd_texts + [(100 + i, prose(200 + i, 20, 1) + hot + prose(300 + i, 20, 1)) for i in range(12)] + [(130, "ab" * 700), (131, "ba" * 300)]
    texts = [(t or "").encode() for _, t in data]
    for length, block in ((400, 1024), (100, 3)):
        seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
        want = []
        for (i, _), t in zip(data, texts):
            mark = bytearray(len(t))
            for k in range(len(t) - length + 1):
                if seen[t[k : k + length]] > 1:
                    mark[k : k + length] = b"\1" * length
            left = bytes(b for b, m in zip(t, mark) if not m)
            want.append((i, len(t), sum(mark), sum(1 for x in bytes(mark).split(b"\0") if x), hashlib.sha256(left).hexdigest(), left))
        got = suffix_dedup.suffix_dedup(spark, frame(data, extra=True), length, block, (20, 6, 1)).collect()
        assert Counter((g.doc_id, g.n_bytes, g.n_removed, g.n_spans, g.kept_sha256, bytes(g.kept)) for g in got) == Counter(want)


def test_suffix_dedup_of_many_copies(spark, frame, prose):
    """Copies of a text are one row before its segments are fetched, and the runs are written before they are joined to all copies."""
    same = prose(1, 120)
    docs = frame([(i, same) for i in range(300)] + [(300, same + " end")])
    rows = suffix_dedup._key(docs)
    wanted = rows.where("doc_id = 0").selectExpr("k1", "k2", "5 AS start", "2 AS n", "0 AS anchor", "1L AS g", "1L AS d", "300L AS many", "2L AS kinds")
    found, out = suffix_dedup._fetched(rows, wanted, 400), suffix_dedup.suffix_dedup(spark, docs)
    above_join = [df._jdf.queryExecution().executedPlan().toString().partition("Join")[0] for df in (found, out)]
    assert [r.data.decode() for r in found.collect()] == [same[5:406]]
    assert {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()} == {(i, len(same), len(same), 1, b"") for i in range(300)} | {(300, len(same) + 4, len(same), 1, b" end")}
    assert not any("Aggregate" in x for x in above_join)
    assert "Aggregate" not in out._jdf.queryExecution().executedPlan().toString()


def test_collection_transform():
    r = random.Random(5)
    seqs = [np.array([r.randrange(3) for _ in range(r.randrange(0, 12))], np.uint64) for _ in range(9)]
    made = suffix_dedup.Collection(seqs)
    every = sorted(((tuple(x + 1 for x in map(int, s[i:])) + (0, n)), n, len(s) - i) for n, s in enumerate(seqs) for i in range(len(s) + 1))
    assert [(n, k) for _, n, k in every] == list(zip(made.owner.tolist(), made.size.tolist()))

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) - 2 and a[n] == b[n] != 0:
            n += 1
        return n

    assert made.prefix.tolist()[1:] == [common(a[0], b[0]) for a, b in zip(every, every[1:])]


# 6


def test_packing(spark, frame, odd_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(path)
    data = odd_texts + [(50, "x" * 3 + " <|endoftext|> don't 12 ½ İ")]
    want = [(i, np.array(whole.encode(t or "", add_special_tokens=False).ids + [2], "<u4")) for i, t in data]
    got = packing.pack(spark, frame(data, extra=True), path, window=64).collect()
    pieces = Counter((i, a, len(x[a : a + 64]), zlib.crc32(x[a : a + 64].tobytes()), len(x)) for i, x in want for a in range(0, len(x), 64))
    assert Counter((g.doc_id, g.start, g.length, g.ids_crc32, g.doc_tokens) for g in got) == pieces
    by = {}
    for g in got:
        by.setdefault(g.sequence_id, []).append((g.offset, g.length))
    for s in by.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 64


def test_ids_of_odd_strings():
    """Strings taken apart give the ids of the whole text."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    whole = Tokenizer.from_file(path)
    r = random.Random(6)
    signs = list("abzABZéÉßŉıİΣσςǆǅ'’.,;:!?-_<|>()\"$%&*#@^`~=+[]{}\\/ \t\n") + ["\u0301", "\u00a0", "\x1c", "\x85", "½", "٣", "漢", "'s", "'ll", "<|endoftext|>", "ﬁ", "ÿ", "\u200b", "1", "É\u0301"]
    texts = ["".join(r.choices(signs, k=r.randrange(0, 30))) for _ in range(3000)]
    assert packing.encode(texts, path) == [np.array(e.ids, "<u4").tobytes() for e in whole.encode_batch(texts, add_special_tokens=False)]


def test_strings_are_told_apart_by_column():
    """Strings made of known parts are put together without a call for each of them."""
    cores = ["".join(random.Random(i).choices("abcdeéß", k=8)) for i in range(40)]
    words = [c.title() + "." * n + "!" * m for c in cores for n in range(10) for m in range(10)]
    path, calls = public_tokenizers.path("word_bpe_49k.json"), []
    packing.encode([" ".join(cores), " ".join(w[8:] for w in words)], path)
    sys.setprofile(lambda frame, event, arg: calls.append(event))
    try:
        got = packing.encode([" ".join(words)], path)
    finally:
        sys.setprofile(None)
    assert got == packing.Encoder(path).plain([" ".join(words)])
    assert len(calls) < len(words) // 4, len(calls)


def test_ids_when_memory_is_short(monkeypatch):
    """Parts that are forgotten are encoded again; batches may hold no word, or more parts than are remembered."""
    monkeypatch.setattr(packing, "MEMORY", 5)
    r = random.Random(8)
    encoder = packing.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for n in (0, 1, 3, 40, 2, 0, 9) * 4:
        texts = [" ".join(r.choices(["river", "Stone.", "lake", "hill,", "don't", "漢字", "12", "été!?", "--", "Moon"], k=n)) for _ in range(3)] + ["", " \t", "a\x1cb"]
        assert encoder.encode(pa.array(texts)) == encoder.plain(texts)
        assert max(len(m.known) for m in (encoder.heads, encoder.tails, encoder.others)) <= 10
    assert encoder.encode(pa.array([], pa.string())) == [] and encoder.encode(pa.array(["x", "", "b c"]).slice(1)) == encoder.plain(["", "b c"])


def test_fullest_is_closest():
    r = random.Random(1)
    for _ in range(200):
        left = Counter(r.choices(range(1, 15), k=r.randrange(1, 9)))
        room = r.randrange(0, 40)
        sums = {0}
        for n in left.elements():
            sums |= {s + n for s in sums if s + n <= room}
        used = packing.fullest(left, room, sorted(left))
        assert sum(n * k for n, k in used.items()) == max(sums) and not used - left


# 7


def brute_print(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(spark, frame, odd_texts, prose):
    base = prose(60, 400)
    data = odd_texts + [(60 + i, base.replace(base.split()[40 * i], "other", 1)) for i in range(9)]
    docs = frame(data, extra=True)
    prints = [(i, brute_print(t)) for i, t in data]
    root = list(range(len(data)))
    for a in range(len(data)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2 and root[a] != root[b]:
                old, new = max(root[a], root[b]), min(root[a], root[b])
                root = [new if x == old else x for x in root]
    name = {r: min((prints[k][0] for k in range(len(data)) if root[k] == r and prints[k][0] is not None), default=None) for r in root}
    got = simhash.simhash_components(spark, docs).collect()
    assert Counter((g.doc_id, g.fingerprint, g.component_id) for g in got) == Counter((i, f"{p:016x}", name[r]) for (i, p), r in zip(prints, root))
    kept = simhash.keep_one_each(spark, docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(name[r] for r in set(root))


def test_simhash_blocks(spark):
    """Tiles of many blocks and tile pairs lose no link."""
    r = random.Random(4)
    prints = {r.getrandbits(64) for _ in range(50)}
    for p in list(prints):
        prints |= {p ^ 1 << r.randrange(64) ^ 1 << r.randrange(64) for _ in range(4)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    from indicarium.llm.components import components

    got = {}
    for x in components(simhash.near_links(df, 2, block=3)).collect():
        got.setdefault(x.root, set()).update((x.root, x.node))
    root = {p: p for p in prints}
    for a in prints:
        for b in prints:
            if (a ^ b).bit_count() <= 2 and root[a] != root[b]:
                old = root[b]
                for k in root:
                    if root[k] == old:
                        root[k] = root[a]
    want = {}
    for p, x in root.items():
        want.setdefault(x, set()).add(p - (1 << 64) if p >> 63 else p)
    assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


# 9


def test_toxicity(spark, frame, odd_texts, prose):
    data, labels = [], []
    for i in range(600):
        bad = i % 8 == 0
        data.append((i, prose(i, 60) + (" you vileworm and grimtoad" if bad else "")))
        if i % 5 < 3:
            labels.append((i, int(bad)))
    labels += [(None, 1), (599, None), (10_000, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    docs = frame(data + odd_texts, extra=True)
    got = toxicity.toxicity(spark, docs, marks).collect()
    assert len(got) == len(data) + len(odd_texts)
    assert all(0 <= g.score <= 1 and g.predicted == int(g.score >= 0.7) for g in got)
    assert all(g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 3 == 1) for g in got)
    held = [g for g in got if g.held_out and g.doc_id is not None and 20 < g.doc_id]
    right = sum(g.predicted == int(g.doc_id % 8 == 0) for g in held)
    assert right >= 0.95 * len(held)
    kept = toxicity.remove_toxic(spark, docs, marks)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert toxicity.toxicity(spark, docs, marks.limit(0)).where("score <> 0").count() == 0


def test_toxicity_inside_words(spark, frame, prose):
    """Toxic parts behind the beginning of a joined word or of a sentence without spaces are seen."""
    r = random.Random(9)
    joined = lambda bad: "".join(r.choices("abcdefghij", k=9)) + ("vileworm" if bad else "mildbird") + "".join(r.choices("abcdefghij", k=4))
    signs = lambda bad: "".join(r.choices("天地玄黄宇宙洪荒日月盈昃", k=9)) + ("毒虫" if bad else "花鸟") + "".join(r.choices("天地玄黄宇宙洪荒日月盈昃", k=4))
    for part in (joined, signs):
        data = [(i, f"{prose(i, 20)} {part(i % 5 == 0)}") for i in range(400)]
        labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)], "doc_id long, toxic int")
        held = [g for g in toxicity.toxicity(spark, frame(data), labels).collect() if g.held_out]
        assert sum(g.predicted == int(g.doc_id % 5 == 0) for g in held) >= 0.95 * len(held)
    assert toxicity.grams("Élan".encode()) == {"Élan$", "Éla", "Élan"} and toxicity.grams("“x”".encode()) == {"“x”$", "“x”"}


def test_held_out_labels_do_not_matter(spark, frame, prose):
    data = [(i, prose(i, 40) + (" vileworm" if i % 5 == 0 else "")) for i in range(200)]
    labels = [(i, int(i % 5 == 0)) for i in range(200)]
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 3 == 1 else t) for i, t in labels]
    score = lambda x: rows(toxicity.toxicity(spark, frame(data), spark.createDataFrame(x, "doc_id long, toxic int")))
    assert score(labels) == score(turned)


@pytest.mark.parametrize("prior", [0.1, 0.6])
def test_nnpu_follows_the_risk(prior):
    """The fit against the non-negative risk written out row by row, its gradient taken by differences."""
    r = random.Random(5)
    toxic = [np.array(sorted(r.sample(range(6), 3)), np.int64) for _ in range(9)] + [np.array([], np.int64)]
    unlabelled = [np.array(sorted(r.sample(range(6), 2)), np.int64) for _ in range(14)] + toxic[:4]
    loss = lambda z: float(np.logaddexp(0, -z))
    mean = lambda rows, x, sign: sum(loss(sign * (sum(x[f] for f in row) + x[-1])) for row in rows) / len(rows)
    turned = []

    def risk(x):
        as_negative = mean(unlabelled, x, -1) - prior * mean(toxic, x, -1)
        turned.append(as_negative < 0)
        # where the part of the negatives falls below zero, it is climbed back instead
        return (prior * mean(toxic, x, 1) + as_negative if as_negative >= 0 else -as_negative) + 5e-5 * sum(v * v for v in x[:-1])

    x, m, v = np.zeros(7), np.zeros(7), np.zeros(7)
    for t in range(1, 61):
        g = np.array([(risk(x + d) - risk(x - d)) / 2e-6 for d in np.eye(7) * 1e-6])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x = x - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    w, b = toxicity.fit_nnpu(toxic, unlabelled, 6, prior, steps=60)
    assert np.allclose([*w, b], x, atol=2e-3)
    assert any(turned) == (prior == 0.6)


# 10


def brute_lines(data, depth=4, min_docs=10):
    docs = sorted({(i, t) for i, t in data if t is not None}, key=lambda d: (d[0] is None, d[0] or 0))
    lines = [(d, at, tuple("<*>" if re.search("[0-9]", w) else w for w in re.split("[ \t\r\f\x0b]+", line.strip(" \t\r\f\x0b")))) for d in docs for at, line in enumerate(d[1].split("\n"))]
    lines = [x for x in lines if len(x[2]) >= 4]
    leaves, alone, gone = {}, {}, set()
    for x in lines:
        leaves.setdefault((len(x[2]), *x[2][:depth]), []).append(x)
        if len(x[2]) >= 8 and sum(w != "<*>" for w in x[2]) >= 0.5 * len(x[2]):
            alone.setdefault(x[2], []).append(x)
    for same in alone.values():
        gone |= {(x[0], x[1]) for x in same if x[0] != same[0][0]}
    for leaf in leaves.values():
        votes = {(x[0], x[2]) for x in leaf}
        template = []
        for column in zip(*(w for _, w in votes)):
            word, n = Counter(column).most_common(1)[0]
            template.append(word if 2 * n > len(votes) else None)
        follow = [x for x in leaf if sum(a == b != "<*>" for a, b in zip(x[2], template)) >= 0.5 * len(x[2])
                  and sum(a == b for a, b in zip(x[2][depth:], template[depth:])) >= 0.5 * (len(x[2]) - depth)]
        if len({x[0] for x in follow}) >= min_docs:
            gone |= {(x[0], x[1]) for x in follow if x[0] != follow[0][0]}
    out = []
    for i, t in data:
        kept = None if t is None else "\n".join(x for at, x in enumerate(t.split("\n")) if ((i, t), at) not in gone)
        out.append((i, 0 if t is None else len(t.split("\n")), 0 if t is None else sum(((i, t), at) in gone for at in range(len(t.split("\n")))), kept))
    return out


@pytest.mark.parametrize("many", [6, 14])
def test_line_dedup(spark, frame, odd_texts, prose, many):
    """At the query's own limits: templates that vary from ten documents on, long lines from two."""
    data = [d for d in odd_texts if d[0] is not None or d[1] is None]
    data += [(60 + i, prose(400 + i, 30, 2) + f"\nuser {i} logged in from 10.0.0.{i} at {i}:0{i}\nAll rights reserved by the owner\nthe of and in {re.sub('[0-9]', '', prose(500 + i, 9, 1))}"
              + f"\nmail from river to {'stone cloud hill bird tree leaf root seed wind sun moon star sea ship'.split()[i]} was sent by the port\n" + re.sub('[0-9]', '', prose(77 if i < 2 else 700 + i, 60, 1))) for i in range(many)]
    # two families of lines under one head, and a document that repeats a third very often
    data += [(200 + i, f"we all went to {'river stone cloud field hill bird' if i % 2 else 'wind sun moon star sea ship'} and back") for i in range(6)] + [(300, "we all went to port road town tree leaf root and back\n" * 50)]
    docs = frame(data, extra=True)
    got = line_dedup.line_dedup(spark, docs).collect()
    assert Counter((g.doc_id, g.n_lines, g.n_dropped, g.text) for g in got) == Counter(brute_lines(data))
    dropped = {g.doc_id: g.n_dropped for g in got if g.doc_id and g.doc_id >= 60}
    assert [dropped[200 + i] for i in range(6)] == [0, 0, 1, 1, 1, 1] and dropped[300] == 0
    assert [dropped[60 + i] for i in range(many)] == [0, 2] + [1] * 4 if many < 10 else [dropped[60 + i] for i in range(1, many)] == [4] + [3] * (many - 2)
    out = line_dedup.drop_templates(spark, docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    assert out.where("n_chars <> length(text)").count() == 0


def test_lines_that_share_only_a_head_stay(spark, frame):
    """In the pipeline short lines of one opening with other words behind it are no template; lines equal behind it are."""
    ends = ["river", "stone", "cloud", "field", "hill", "bird", "tree", "leaf", "root", "seed", "wind", "sun"]
    data = [(i, f"We went to the {w} yesterday{w}\nAll rights reserved by the owner\nPage of the book 1{i} 2{i}") for i, w in enumerate(ends)]
    got = {r.doc_id: r.text for r in line_dedup.drop_templates(spark, frame(data)).collect()}
    assert all(got[i] == (t if i == 0 else t.split("\n")[0]) for i, t in data)


def test_empty_tables(spark, frame):
    docs = frame([], extra=True)
    bench = spark.createDataFrame([], "item_id long, text string")
    marks = spark.createDataFrame([], "doc_id long, toxic int")
    words = public_tokenizers.path("word_bpe_49k.json")
    for out in (substring_dedup.substring_dedup(spark, docs), decontamination.report(spark, docs, bench), suffix_dedup.suffix_dedup(spark, docs), simhash.simhash_components(spark, docs),
                token_counts.token_counts(spark, docs, public_tokenizers.path("piece_bpe_32k.model")), packing.pack(spark, docs, words), toxicity.toxicity(spark, docs, marks),
                line_dedup.line_dedup(spark, docs), simhash.keep_one_each(spark, docs), toxicity.remove_toxic(spark, docs, marks), line_dedup.drop_templates(spark, docs)):
        assert out.count() == 0
