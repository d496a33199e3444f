"""Line dedup by a log-template tree, in DataFrame functions alone.

A line descends a tree of fixed depth: its number of tokens, then its first
``depth`` tokens, tokens with a digit standing for any value. A leaf has
several templates: each of its lines that recurs as masked is one (lines of
``long_tokens`` tokens or more, from ``min_copies`` documents on), and one generalises
all lines: a position at which over half of the leaf's documents have the same
token is fixed, the others vary. A line follows it when at least
``similarity`` of its tokens are fixed ones without a digit, and as many of
those behind the head are the template's. A generalised template recurs when lines
of ``min_docs`` documents follow it. Lines of templates that recur are dropped
from all documents but the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import content_key, staged

DEPTH, SIMILARITY, MIN_TOKENS, MIN_DOCS = 4, 0.5, 4, 10
#: Lines of so many tokens are templates by themselves once so many documents hold them.
LONG_TOKENS, MIN_COPIES = 8, 2

#: Stands for any token with a digit.
VARIABLE = "<*>"

_BLANKS = " \t\r\f\x0b"


def tokens(line: Column) -> Column:
    return F.split(F.trim(line, F.lit(_BLANKS)), f"[{_BLANKS}]+")


def masked(words: Column) -> Column:
    return F.transform(words, lambda t: F.when(t.rlike("[0-9]"), VARIABLE).otherwise(t))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _keyed(docs: DataFrame) -> DataFrame:
    k1, k2 = content_key(F.col("doc_id"), F.col("text"))
    return docs.withColumns({"__k1": k1, "__k2": k2})


def _leaves(rows: DataFrame, depth: int, similarity: float, min_tokens: int, long_tokens: int) -> DataFrame:
    """__k1, __k2, doc_id, leaves: of each line its leaf, and where it is a template of its own (a, b) what stands for its masked tokens."""
    def of_line(text: Column, words: Column, masks: Column) -> Column:
        n = F.size(words)
        fixed = F.when(text.rlike("[0-9]") | text.contains(VARIABLE), F.size(F.filter(masks, lambda t: t != VARIABLE))).otherwise(n)
        alone = (n >= long_tokens) & (fixed >= similarity * n)
        return F.when(n >= min_tokens, F.struct(F.xxhash64(n, F.slice(masks, 1, depth)).alias("leaf"), F.when(alone, F.xxhash64(masks)).alias("a"), F.when(alone, F.xxhash64(F.reverse(masks), n)).alias("b")))

    # most lines have no digit and so nothing to mask
    mask = lambda x, w: F.when(x.rlike("[0-9]"), masked(w)).otherwise(w)
    line = lambda x: F.transform(F.array(tokens(x)), lambda w: F.transform(F.array(mask(x, w)), lambda m: of_line(x, w, m))[0])[0]
    return rows.select("__k1", "__k2", "doc_id", F.transform(_lines(F.col("text")), line).alias("leaves"))


def _rank() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "__k1", "__k2")


def _late(follow: DataFrame, keys: list[str], min_docs: int, name: str) -> DataFrame:
    """__k1, __k2, at: the lines of templates (``keys``) that ``min_docs`` documents hold, in all documents but the first."""
    first = follow.groupBy(*keys, "__k1", "__k2").agg(F.first("doc_id").alias("doc_id")).groupBy(*keys).agg(F.count(F.lit(1)).alias("docs"), F.min(_rank()).alias("first")).where(F.col("docs") >= min_docs)
    late = follow.join(staged(first.drop("docs"), name), keys).where((F.col("__k1") != F.col("first.__k1")) | (F.col("__k2") != F.col("first.__k2")))
    return late.select("__k1", "__k2", "at")


def _candidates(rows: DataFrame, leaves: DataFrame, depth: int, min_docs: int) -> DataFrame:
    """Lines of leaves that ``min_docs`` documents reach: k1, k2, doc_id, ats, n, head, words. A row for each different line of a document, with its places."""
    busy = leaves.select(F.explode(F.array_distinct("leaves.leaf")).alias("leaf")).where("leaf is not null").groupBy("leaf").count().where(F.col("count") >= min_docs)
    busy = staged(busy.select("leaf"), "busy-leaves")
    at = leaves.select("__k1", "__k2", F.posexplode("leaves.leaf").alias("at", "leaf")).where("leaf is not null").join(busy, "leaf", "left_semi")
    at = at.groupBy("__k1", "__k2").agg(F.collect_set("at").alias("at"))
    found = rows.join(at, ["__k1", "__k2"]).withColumn("lines", _lines(F.col("text"))).select("__k1", "__k2", "doc_id", "lines", F.explode("at").alias("at"))
    found = found.select("__k1", "__k2", "doc_id", "at", masked(tokens(F.col("lines")[F.col("at")])).alias("words"))
    found = found.groupBy("__k1", "__k2", "words").agg(F.first("doc_id").alias("doc_id"), F.collect_set("at").alias("ats"))
    return staged(found.select("*", F.size("words").alias("n"), F.concat_ws(" ", F.slice("words", 1, depth)).alias("head")), "candidate-lines")


def _templates(lines: DataFrame) -> DataFrame:
    """n, head, template: array of the fixed tokens, null where the position varies. A document has one vote for each of its different lines."""
    counted = lines.groupBy("n", "head", "words").count()
    token = counted.select("n", "head", "count", F.posexplode("words").alias("at", "token")).groupBy("n", "head", "at", "token").agg(F.sum("count").alias("c"))
    fixed = token.groupBy("n", "head", "at").agg(F.sum("c").alias("all"), F.max(F.struct("c", "token")).alias("most"))
    fixed = fixed.select("n", "head", F.struct("at", F.when(F.col("most.c") * 2 > F.col("all"), F.col("most.token")).alias("token")).alias("p"))
    return fixed.groupBy("n", "head").agg(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["token"]).alias("template"))


def dropped_lines(docs: DataFrame, depth: int = DEPTH, similarity: float = SIMILARITY, min_tokens: int = MIN_TOKENS, min_docs: int = MIN_DOCS,
                  long_tokens: int = LONG_TOKENS, min_copies: int = MIN_COPIES) -> DataFrame:
    """__k1, __k2 (a document's content key), drop: numbers of the lines to leave out."""
    rows = _keyed(docs.select("doc_id", "text"))
    leaves = staged(_leaves(rows, depth, similarity, min_tokens, long_tokens), "leaves")
    same = leaves.select("__k1", "__k2", "doc_id", F.posexplode("leaves").alias("at", "l")).where("l.a is not null").select("__k1", "__k2", "doc_id", "at", "l.a", "l.b")
    copies = _late(same, ["a", "b"], min_copies, "first-copies")
    lines = _candidates(rows, leaves, depth, min_docs)
    total = lambda flags: F.aggregate(flags, F.lit(0), lambda s, x: s + x)
    fixed = F.zip_with("words", "template", lambda a, b: F.coalesce(((a == b) & (b != VARIABLE)).cast("int"), F.lit(0)))
    # behind the head that all lines of a leaf share; equal there as masked: a digit on both sides is no difference
    rest = F.slice(F.zip_with("words", "template", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0))), depth + 1, F.greatest(F.col("n") - depth, F.lit(0)))
    alike = (total(fixed) >= similarity * F.col("n")) & (total(rest) >= similarity * (F.col("n") - depth))
    follow = staged(lines.join(staged(_templates(lines), "templates"), ["n", "head"]).where(alike).select("__k1", "__k2", "doc_id", F.explode("ats").alias("at"), "n", "head"), "template-lines")
    late = copies.union(_late(follow, ["n", "head"], min_docs, "first-lines"))
    return late.groupBy("__k1", "__k2").agg(F.collect_set("at").alias("drop"))


def without_templates(spark: SparkSession, docs: DataFrame, **limits) -> DataFrame:
    """``docs`` (all columns, any names) with __n_lines, __n_dropped, __kept (the text without the dropped lines).

    Null texts stay null, with no line; an empty text is one empty line. Rows of
    the same doc_id and text count as one document and lose the same lines. Of a
    recurring template the lines of the document of smallest doc_id (null last)
    stay. A template that very many lines follow is combined before each
    shuffle, and a skewed key that AQE splits in the joins.
    """
    out = _keyed(docs).join(dropped_lines(docs, **limits), ["__k1", "__k2"], "left")
    lines = _lines(F.col("text"))
    rest = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), "drop"))
    kept = F.when(F.col("drop").isNull(), F.col("text")).otherwise(F.array_join(F.transform(rest, lambda i: lines[i]), "\n"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(lines))
    return out.select(*docs.columns, n_lines.cast("long").alias("__n_lines"), F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("__n_dropped"), kept.alias("__kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, **limits) -> DataFrame:
    """Per document: doc_id, n_lines, n_dropped, text (what is left)."""
    out = without_templates(spark, docs.select("doc_id", "text"), **limits)
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), F.col("__kept").alias("text"))


def drop_templates(spark: SparkSession, docs: DataFrame, **limits) -> DataFrame:
    """The documents with their columns, ``text`` without the dropped lines and ``n_chars`` counted anew where lines went."""
    out = without_templates(spark, docs, **limits)
    new = {"text": F.col("__kept")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        new["n_chars"] = F.when(F.col("__n_dropped") > 0, F.length("__kept").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(new).select(*docs.columns)
