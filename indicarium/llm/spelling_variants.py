"""Spelling variants by permuterm rotations, in DataFrame functions alone.

A word is marked by a terminator at its end, and all rotations of it are
sorted. A rotation that ends in a letter of the word stands, without that
letter, for the word with that letter open: words that differ in it alone have
rotations in one prefix range, skipping the edited letter. The full rotation of
a shorter word is such a prefix too, so an inserted or deleted letter lies in
the same range. A range holds one row for each letter of the alphabet and one
full rotation, at most, however many words there are: no key is hot, and each
row is told how many others stand in its range and which of them is
most frequent, so no pairs are written.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from indicarium.llm.common import dropped, staged

#: Letters of a word, code points and occurrences from which on it counts, and how many times as frequent its form is.
LETTERS, MIN_LENGTH, MIN_COUNT, TIMES = r"[A-Za-zÀ-ÿ]+", 6, 5, 5
#: One in so many occurrences (by a hash of its document and itself) loses a code point.
SLIPS = 199

_TERMINATOR = "$"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lowered(run: Column) -> Column:
    """A-Z lower-cased, other letters as they are; the slow way only for words with capitals and other letters."""
    lower = F.lower(run)
    return F.when(run == lower, run).when(F.octet_length(run) == F.length(run), lower).otherwise(F.translate(run, _UPPER, _UPPER.lower()))


def counted_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, slips: int = SLIPS) -> DataFrame:
    """word, n: the documents' words and how often each occurs."""
    runs = docs.select(F.col("doc_id").cast("string").alias("doc"), F.explode(F.regexp_extract_all("text", F.lit(LETTERS), F.lit(0))).alias("run"))
    # a slip shortens a word by one code point, so shorter runs can't count
    runs = runs.where(F.length("run") >= min_length).select("doc", lowered(F.col("run")).alias("run"))
    h = F.crc32(F.concat("doc", F.lit(":"), "run"))
    at = (h % F.length("run")).cast("int")
    slip = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    found = runs.select(F.when(h % slips == 0, slip).otherwise(F.col("run")).alias("word")).where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """key, word, n, whole, first: a row for each rotation (whole), and one for each without its last letter.

    Letters of a run of equal ones leave the same word when one of them goes:
    ``first`` marks the one that stands for them where words are counted.
    """
    w = F.col("word")
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length(w))).alias("at"))
    at, size = F.col("at"), F.length(w)
    before = F.concat(F.lit(_TERMINATOR), F.substring(w, F.lit(1), at))
    letter = lambda i: F.substring(w, i, F.lit(1))
    whole = F.struct(F.concat(F.substring(w, at + 1, size), before).alias("key"), F.lit(True).alias("whole"), F.lit(False).alias("first"))
    skip = F.struct(F.concat(F.substring(w, at + 2, size), before).alias("key"), F.lit(False).alias("whole"), ((at == 0) | (letter(at) != letter(at + 1))).alias("first"))
    rows = F.when(at < size, F.array(whole, skip)).otherwise(F.array(whole))
    return turned.select("word", "n", F.explode(rows).alias("r")).select("r.key", "word", "n", "r.whole", "r.first")


def neighbours(words: DataFrame) -> DataFrame:
    """word, n_near, best (struct of minus its n, word): of the words at one edit, how many and the most frequent."""
    same = Window.partitionBy("key")
    others = same.orderBy("whole", "word")
    one = lambda test: F.sum(F.when(test, 1).otherwise(0)).over(same)
    mine = F.struct((-F.col("n")).alias("less"), "word")
    scanned = rotations(words).select(
        "word",
        F.when(F.col("whole"), one(F.col("first"))).otherwise(one(~F.col("whole")) - 1 + F.when(F.col("first"), one(F.col("whole"))).otherwise(0)).alias("near"),
        F.least(F.min(mine).over(others.rowsBetween(Window.unboundedPreceding, -1)), F.min(mine).over(others.rowsBetween(1, Window.unboundedFollowing))).alias("best"))
    return scanned.where("best is not null").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, form -> word, root: forms followed to the last. A round halves the chains; each form is ``TIMES`` as frequent as its word, so a few do."""
    now = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if not now.join(further, "root", "left_semi").limit(1).count():
            return now
        after = staged(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
        dropped(now)
        now = after


def spelling_variants(spark: SparkSession, docs: DataFrame, times: int = TIMES, **limits) -> DataFrame:
    """word, form, root, n, n_near, form_n: frequent words, and the much more frequent spelling that each is a variant of.

    Null and empty texts have no words; words of a null doc_id lose no
    letter. Repeated rows count each time. Of near words of equal n the
    smallest in code-point order is the form; a word without one is its own root.
    An empty table gives no rows.
    """
    words = staged(counted_words(docs.select("doc_id", "text"), **limits), "words")
    found = words.join(neighbours(words), "word", "left")
    far = -F.col("best.less") >= times * F.col("n")
    found = staged(found.select("word", F.when(far, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(far, -F.col("best.less")).alias("form_n")), "variants")
    root = roots(found.where("form is not null"))
    return found.join(root, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
