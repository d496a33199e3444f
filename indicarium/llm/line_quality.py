"""Quality rules, line first, in DataFrame functions alone.

Each line of a text passes three rules or goes:

- punctuation: marks make up at most ``MARKS`` percent of its characters, and a
  line of ``UNMARKED`` words or more has a sentence mark somewhere;
- navigation: it is no row of items between separators;
- boilerplate: it holds none of the phrases of page furniture, and it is no
  repetition of an earlier line of the text.

What is left is the cleaned text. A document that loses more than ``LOST``
percent of its characters, or that fails the base rules (too few words, too
many of them in repeated windows), is rejected.

Everything happens within a row: no shuffle, whatever the texts' lengths or
copies. Windows of words are compared by 64-bit digests (two different windows
of a text of a million words share one with a chance of 3 in 10**8).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Percent of a line's characters that may be marks; words from which on a line needs a sentence mark.
MARKS, UNMARKED = 15, 20
#: Separators that make a row of items, at least, and at most so many words to each of them.
SEPARATORS, ITEM_WORDS = 3, 4
#: Percent of a document's characters that the line rules may take.
LOST = 50
#: Base rules: least number of words, percent of words in repeated windows, words of a window.
MIN_WORDS, REPEATED, WINDOW = 20, 30, 8

_BLANKS = " \t\n\x0b\f\r"
_MARK = r"[!-/:-@\[-`{-~]"
_SYMBOL = "[#*$%&|<>]"
_SENTENCE_MARK = "[.,;:!?\u2026\u3002\uff0c\uff01\uff1f\u060c\u061f\u0964]"
_SEPARATOR = "(?:^|[ \\t\\x0b\\f\\r])[|>/*·•»›→-]{1,2}(?=[ \\t\\x0b\\f\\r]|\\z)"

#: Page furniture, lower case; a line of up to ``FURNITURE_WORDS`` words that holds one of them fails.
FURNITURE = ["cookie", "javascript", "privacy policy", "terms of use", "terms of service", "all rights reserved", "click here",
             "sign up", "log in", "subscribe to", "share on", "read more", "skip to content", "tous droits r\u00e9serv\u00e9s", "mentions l\u00e9gales",
             "alle rechte vorbehalten", "impressum", "datenschutz", "todos los derechos reservados", "aviso legal"]
FURNITURE_WORDS = 30


def let(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of the value, which is computed once for all places that it stands in."""
    return F.transform(F.array(value), lambda v: fn(v))[0]


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda s, x: s + x)


def words(text: Column) -> Column:
    return F.filter(F.split(text, f"[{_BLANKS}]+"), lambda w: w != "")


def repeated_words(w: Column, size: int = WINDOW) -> Column:
    """How many of the words lie in windows of ``size`` words that the list holds twice or more.

    Digests of windows, sorted with their places, have equal ones as
    neighbours; the runs that their places cover are added up from gap to gap.
    """
    def windows(d: Column) -> Column:
        starts = F.slice(d, 1, F.greatest(F.size(d) - (size - 1), F.lit(0)))
        return F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(d, i + k) for k in range(1, size)]))

    def covered(d: Column) -> Column:
        ranked = F.sort_array(F.transform(d, lambda x, i: F.struct(x.alias("d"), i.alias("at"))))
        pairs = let(ranked, lambda r: F.zip_with(r, F.slice(r, 2, F.size(r)), lambda a, b: F.when(a["d"] == b["d"], F.array(a["at"], b["at"]))))
        places = F.sort_array(F.array_distinct(F.flatten(F.filter(pairs, lambda p: p.isNotNull()))))
        return let(places, lambda p: _total(F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(size)), F.lit(size)))))

    digests = F.transform(w, lambda x: F.xxhash64(x))
    return let(let(digests, windows), lambda d: F.when(F.size(F.array_distinct(d)) < F.size(d), covered(d)).otherwise(F.lit(0).cast("long")))


def holds_furniture(line: Column) -> Column:
    return reduce(lambda a, b: a | b, [F.contains(line, F.lit(x)) for x in FURNITURE])


def line_flags(line: Column, w: Column) -> Column:
    """Struct of a line and its words: chars (code points in words), and which rules it fails: punctuation, navigation, boilerplate."""
    def judge(x: Column) -> Column:
        return F.struct(
            x["chars"].alias("chars"),
            ((F.regexp_count(line, F.lit(_MARK)) * 100 > x["chars"] * MARKS) | ((x["n"] >= UNMARKED) & ~line.rlike(_SENTENCE_MARK))).alias("punctuation"),
            ((x["seps"] >= SEPARATORS) & (x["n"] <= (ITEM_WORDS + 1) * x["seps"])).alias("navigation"),
            ((x["n"] <= FURNITURE_WORDS) & let(F.lower(line), holds_furniture)).alias("boilerplate"))

    return let(F.struct(F.size(w).alias("n"), F.length(F.array_join(w, "")).alias("chars"), F.regexp_count(line, F.lit(_SEPARATOR)).alias("seps")), judge)


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` (all columns, any names) with a struct column ``__quality``.

    Fields: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    n_lines (with a word), n_punctuation, n_navigation, n_boilerplate (lines that fail each rule), lost_chars,
    kept, text (the lines that pass, blank ones included). A null text has no
    words, fails the base rules and stays null; an empty or blank one has no words
    either. Repeated rows each get their own answer; doc_id is not looked at.
    """
    text = F.coalesce(F.col("text"), F.lit(""))

    # whether a line with a word equals an earlier one, by line; null where none does
    def repeats(ls: Column) -> Column:
        ranked = F.sort_array(F.transform(ls, lambda x, i: F.struct(x.alias("line"), i.alias("at"))))
        flags = let(ranked, lambda r: F.zip_with(r, F.slice(F.concat(F.array(F.lit(None)), r), 1, F.size(r)),
                                                 lambda a, b: F.struct(a["at"].alias("at"), F.coalesce(a["line"] == b["line"], F.lit(False)).alias("late"))))
        return F.when(F.size(F.array_distinct(ls)) < F.size(ls), F.transform(F.sort_array(flags), lambda x: x["late"]))

    def judged(rows: Column) -> Column:
        late = repeats(F.transform(rows, lambda r: r["line"]))
        return let(late, lambda again: F.transform(rows, lambda r, i: F.struct(
            r["line"].alias("line"), (F.size(r["words"]) > 0).alias("word"), F.coalesce(F.get(again, i), F.lit(False)).alias("late"), line_flags(r["line"], r["words"]).alias("f"))))

    count = lambda rows, test: F.size(F.filter(rows, test)).cast("long")
    fails = lambda r: r["word"] & (r["late"] | r["f"]["punctuation"] | r["f"]["navigation"] | r["f"]["boilerplate"])

    def by_line(rows: Column) -> Column:
        return F.struct(
            count(rows, lambda r: r["word"]).alias("n_lines"),
            count(rows, lambda r: r["word"] & r["late"]).alias("n_dup_lines"),
            count(rows, lambda r: r["word"] & r["f"]["punctuation"]).alias("n_punctuation"),
            count(rows, lambda r: r["word"] & r["f"]["navigation"]).alias("n_navigation"),
            count(rows, lambda r: r["word"] & (r["late"] | r["f"]["boilerplate"])).alias("n_boilerplate"),
            _total(F.transform(rows, lambda r: r["f"]["chars"])).alias("word_chars"),
            _total(F.transform(F.filter(rows, fails), lambda r: r["f"]["chars"])).alias("lost_chars"),
            F.array_join(F.transform(F.filter(rows, lambda r: ~fails(r)), lambda r: r["line"]), "\n").alias("text"))

    by_word = lambda w: F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))
    # words never cross lines, so one pass finds those of the lines and of the text
    rows = F.transform(F.split(text, "\n"), lambda line: F.struct(line.alias("line"), words(line).alias("words")))
    out = docs.withColumn("__quality", let(rows, lambda r: F.struct(
        let(F.flatten(F.transform(r, lambda x: x["words"])), by_word).alias("w"), let(judged(r), by_line).alias("l"),
        F.regexp_count(text, F.lit(_SYMBOL)).cast("long").alias("n_symbols"))))

    def verdict(q: Column) -> Column:
        n, rep = q["w"]["n_words"], q["w"]["n_repeat_words"]
        failed = (n < MIN_WORDS) | (rep * 100 > n * REPEATED)
        return F.struct(
            n.alias("n_words"), q["l"]["word_chars"].alias("word_chars"), q["n_symbols"].alias("n_symbols"), q["l"]["n_dup_lines"].alias("n_dup_lines"),
            rep.alias("n_repeat_words"), failed.alias("base_failed"), q["l"]["n_lines"].alias("n_lines"), q["l"]["n_punctuation"].alias("n_punctuation"),
            q["l"]["n_navigation"].alias("n_navigation"), q["l"]["n_boilerplate"].alias("n_boilerplate"), q["l"]["lost_chars"].alias("lost_chars"),
            (~failed & (q["l"]["lost_chars"] * 100 <= q["l"]["word_chars"] * LOST)).alias("kept"),
            F.when(F.col("text").isNotNull(), q["l"]["text"]).alias("text"))

    return out.withColumn("__quality", let(F.col("__quality"), verdict))


def quality_report(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id and the fields of ``cleaned``, the cleaned text included."""
    return cleaned(docs.select("doc_id", "text")).select("doc_id", "__quality.*")


def keep_good(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents that pass, with their columns, ``text`` cleaned and ``n_chars`` counted anew where lines went."""
    out = cleaned(docs).where("__quality.kept")
    new = {"text": F.col("__quality.text")}
    if "n_chars" in docs.columns:
        n = F.length("__quality.text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("__quality.lost_chars") > 0, n).otherwise(F.col("n_chars"))
    return out.withColumns(new).select(*docs.columns)
