"""Lexical search, spelling variants and quality rules against brute force over odd and planted texts."""

import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from indicarium.llm import lexical_search as L
from indicarium.llm import line_quality as Q
from indicarium.llm import spelling_variants as V

_TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# op11 -------------------------------------------------------------------------------------


def searched(docs, items, top=10):
    texts = [(d, [ascii_lower(t) for t in _TERM.findall(x or "")]) for d, x in docs]
    texts = [(d, w, Counter(w)) for d, w in texts if w]
    n_docs, n_all = len(texts), sum(len(w) for _, w, _ in texts)
    out = []
    for item, text in items:
        score = Counter()
        for t in {ascii_lower(t) for t in _TERM.findall(text or "")}:
            df = sum(t in c for _, _, c in texts)
            for r, (_, w, c) in enumerate(texts):
                if c[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
                    score[r] += weight * ((1000000000 * c[t]) // (1000 * c[t] + 8 * (10 + 90 * len(w) * n_docs // n_all)))
        best = sorted(((-s, texts[r][0] is None, texts[r][0] or 0) for r, s in score.items() if s > 0))[:top]
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(best)]
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def items(prose):
    return [(1, prose(1, 40)), (2, prose(1, 60)), (2, prose(2, 25)), (3, None), (4, ""), (5, "…  !"), (None, "Rain ÀÉ 漢字 rain"), (6, "zzz nowhere"), (7, "the of and in the OF"), (8, prose(1, 40))]


def test_search_equals_brute_force(spark, frame, odd_texts, items, prose):
    docs = odd_texts + [(100 + i, prose(50 + i, 20 + 7 * i)) for i in range(40)] + [(300 + i, prose(9, 50)) for i in range(30)]
    queries = spark.createDataFrame(items, "item_id long, text string").withColumn("at", F.lit("extra"))
    want = searched(docs, items)
    assert rows_of(L.lexical_search(spark, frame(docs, extra=True), queries)) == want
    # several blocks, several Arrow batches: the same
    assert rows_of(L.lexical_search(spark, frame(docs).repartition(5), queries, block_bytes=200)) == want
    assert rows_of(L.lexical_search(spark, frame(docs), queries, top=2)) == searched(docs, items, top=2)


def test_search_in_parts_of_long_texts(spark, frame, odd_texts, items, monkeypatch, prose):
    text = prose(3, 3000).encode()
    whole = [t for part in L.terms(text) for t in part]
    monkeypatch.setattr(L, "PART_BYTES", 50)
    assert [t for part in L.terms(text) for t in part] == whole == [t.lower().encode() for t in _TERM.findall(prose(3, 3000))]


def test_search_of_empty_tables(spark, frame, odd_texts, items):
    queries = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(L.lexical_search(spark, frame([]), queries)) == []
    assert rows_of(L.lexical_search(spark, frame(odd_texts), queries.limit(0))) == []


def test_dag_shares_and_loses_nothing():
    asked = [[0, 1, 2, 5], [2, 1, 0, 6], [0, 1, 2, 3], [7], [], [1, 0]]
    nodes, made = L.sharing_dag(asked, 8)

    def expanded(x):
        return [x] if x < 8 else [t for p in nodes[x - 8] for t in expanded(p)]

    assert [sorted(t for x in item for t in expanded(x)) for item in made] == [sorted(item) for item in asked]
    uses = Counter(x for item in made for x in item) + Counter(p for n in nodes for p in n)
    assert nodes and all(uses[8 + n] for n in range(len(nodes)))
    assert max(len(item) for item in made) < max(map(len, asked))


# op12 -------------------------------------------------------------------------------------


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    s, t = sorted((a, b), key=len)
    return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))


def variants(docs, slips=199, least=5, length=6):
    n = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = ascii_lower(run)
            if doc is not None and (h := zlib.crc32(f"{doc}:{run}".encode())) % slips == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            n[run] += 1
    n = {w: c for w, c in n.items() if len(w) >= length and c >= least}
    form, count = {}, {}
    for w in n:
        own = [x for x in n if near(w, x)]
        count[w] = len(own)
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted(((w, form[w], root(w), n[w], count[w], n[form[w]] if form[w] else None) for w in n), key=repr)


def variant_docs():
    words = {"letters": 900, "lettres": 150, "leters": 150, "letterz": 30, "lettterz": 6, "letttters": 5, "aaaaaa": 130, "aaaaaaa": 25, "aaaaaaaa": 5, "àaaaaa": 5, "naïvety": 60, "naivety": 9, "naïvétyÿ": 5, "bananas": 40,
             "bananaz": 8, "ananas": 40, "banana": 200, "short": 100, "rarely": 4, "Capital": 20, "cApital": 5, "ÉCLAIR": 30, "éclair": 5, "Éclair": 5}
    return [(i, " ".join([w] * n) + ". X1" + w + "x") for i, (w, n) in enumerate(words.items())] + [(None, "letters letterq " * 5), (None, None), (7, ""), (7, "letters letters"), (7, "letters letters")]


@pytest.mark.parametrize("slips", [199, 3])
def test_variants_equal_brute_force(spark, frame, odd_texts, slips):
    docs = variant_docs() + odd_texts
    got = rows_of(V.spelling_variants(spark, frame(docs, extra=True), slips=slips))
    assert got == variants(docs, slips)
    assert any(r[2] != r[1] and r[1] for r in got)


def test_variants_of_an_empty_table(spark, frame):
    assert rows_of(V.spelling_variants(spark, frame([]))) == []


def test_variants_of_the_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(V.spelling_variants(spark, docs)) == variants(texts)


# op13 -------------------------------------------------------------------------------------


def base(text):
    text = text or ""
    w = re.findall("[^\x20\x09-\x0d]+", text)
    starts = Counter(tuple(w[i : i + 8]) for i in range(len(w) - 7))
    repeated = {p for i in range(len(w) - 7) if starts[tuple(w[i : i + 8])] > 1 for p in range(i, i + 8)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if re.search("[^\x20\x09-\x0d]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), len(w) < 20 or 100 * len(repeated) > 30 * len(w)


def quality_docs(prose):
    line = "the rain and the river and the stone and the field, said one.\n"
    return [(20, line * 3 + prose(8, 200)), (21, line * 40), (22, "\n\n" + prose(9, 90, lines=6) + "\n \n"), (23, "Home | News | Sport | Mail | Shop | About\n" * 2 + prose(1, 120)), (24, "A!! B!! C!! D!! " * 12),
            (25, " ".join("word" + chr(97 + i % 26) + chr(97 + i // 26) for i in range(60))), (26, prose(5, 40) + "\nWe use cookies. All rights reserved.\n" + prose(6, 40) + "\n» a · b » c · d › e"), (27, prose(2, 9)), (28, prose(2, 40) + " " + prose(2, 40)),
            (29, "#*$ %& |<> " * 30), (30, prose(7, 6000, lines=400) * 2), (31, "x " * 50000), (32, "İİ ÀÉ 漢字 。\x0bq\x0cr\rs\x1ct " * 8)]


def test_base_counts_equal_brute_force(spark, frame, odd_texts, prose):
    docs = odd_texts + quality_docs(prose)
    got = Q.quality_report(spark, frame(docs, extra=True)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert rows_of(got) == sorted(((d, *base(t)) for d, t in docs), key=repr)


def test_lines_fail_by_rule(spark, frame, odd_texts, prose):
    found = {r.doc_id: r for r in Q.quality_report(spark, frame(quality_docs(prose))).collect()}
    assert found[20].n_boilerplate == 2 and found[20].kept and found[20].text.count("said one") == 1
    assert not found[21].kept and found[21].base_failed
    assert found[22].kept and found[22].lost_chars == 0 and found[22].text == dict(quality_docs(prose))[22]
    assert found[23].n_navigation == 2 and found[23].n_dup_lines == 1 and "Home" not in found[23].text
    assert not found[24].kept and found[24].n_punctuation == 1
    assert not found[25].kept and found[25].n_punctuation == 1 and not found[25].base_failed
    assert found[26].n_boilerplate == 1 and found[26].n_navigation == 1 and found[26].kept and "cookies" not in found[26].text
    assert not found[27].kept and found[27].base_failed
    assert not found[31].kept


def test_nulls_and_empty_texts_fail(spark, frame, odd_texts):
    rows = {r.doc_id: r for r in Q.quality_report(spark, frame([(1, None), (2, ""), (3, " \n\t ")])).collect()}
    assert all(r.base_failed and not r.kept and r.n_words == 0 and r.n_lines == 0 for r in rows.values())
    assert rows[1].text is None and rows[2].text == "" and rows[3].text == " \n\t "
    assert Q.quality_report(spark, frame([])).count() == 0


def test_kept_documents_keep_their_columns(spark, frame, odd_texts, prose):
    docs = frame(odd_texts + quality_docs(prose), extra=True)
    out = Q.keep_good(spark, docs)
    assert out.columns == docs.columns
    by_id = {r.doc_id: r for r in out.collect()}
    assert {20, 22, 23, 26} <= set(by_id) and not {21, 24, 25, 27, 31, 29} & set(by_id)
    assert by_id[20].n_chars == len(by_id[20].text) and by_id[20].leaf == "extra"
    assert "PythonUDF" not in out._jdf.queryExecution().toString() and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
