"""Toxicity by non-negative positive-unlabelled learning on words and their beginnings.

Confirmed toxic documents are the positives; documents as they come, toxic
or not, are the unlabelled. The risk of a logistic model is
``prior * E_P[l(+)] + max(0, E_U[l(-)] - prior * E_P[l(-)])``: the positives
hidden in the unlabelled part are subtracted by the class prior, and where
that turns negative the step goes the other way, as in the published
estimator. Features are a document's words and their first 3 to 6
characters, those that tell positives from unlabelled best. Of long words,
which may be joined ones, all strings of 3 to 6 characters count as such
beginnings, and of words in other than Latin letters, which may be whole
sentences, all of 2 to 6.

Both samples are bounded (``MAX_TOXIC``, ``MAX_UNLABELLED``: the documents
of lowest hashed doc_id); the prior is the rate over all labelled rows, and
scores cover all documents and whole texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from indicarium.llm.common import in_arrow, small_batches, staged, utf8

#: Documents that the classifier is fitted on, at most.
MAX_TOXIC, MAX_UNLABELLED = 8192, 16384
#: Tasks that the sample's texts are dealt out over.
SAMPLE_TASKS = 64
#: Features of the classifier, and the toxic documents that must hold one.
N_FEATURES, MIN_TOXIC = 512, 3
THRESHOLD = 0.7
#: Words whose features a worker remembers.
MEMORY = 1 << 18

#: Characters that a word has at most before it counts as long.
LONG = 12
#: Letters of other than Latin script (and not quotes, dashes and the like).
_OTHER_LETTERS = re.compile("[\u0370-\u1dff\u1f00-\u1fff\u2c00-\u2c5f\u2c80-\u2dff\u3005-\u3007\u3041-\ua71f\ua800-\uab2f\uab70-\ufaff\ufb13-\ufdff\ufe70-\ufefc\uff66-\uffdc\U00010000-\U0001cfff\U0001e000-\U0001efff\U00020000-\U0003ffff]")

_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, z: float) -> float:
        return float(sigmoid(np.float64(z + self.bias))) if self.weights else 0.0


def words(text: bytes) -> set[bytes]:
    return set(text.translate(_WORD_BYTES).split())


def grams(word: bytes) -> set[str]:
    w = word.decode("utf-8", "replace")
    other = not word.isascii() and _OTHER_LETTERS.search(w)
    if other or len(w) > LONG:
        return {w + "$", *(w[i : i + k] for k in range(2 if other else 3, 7) for i in range(len(w) - k + 1))}
    return {w + "$", *(w[:k] for k in (3, 4, 5, 6) if len(w) >= k)}


def held_out(fold: int = 1) -> Column:
    """Rows that the classifier never learns from: crc32 of the doc_id's text, modulo 3, is 1; a null doc_id is not held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == fold, F.lit(False))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_nnpu(toxic: list[np.ndarray], unlabelled: list[np.ndarray], n_features: int, prior: float, steps: int = 400, rate: float = 0.05, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam over the whole samples; rows are arrays of feature numbers."""
    def csr(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        return np.concatenate([*rows, np.empty(0, np.int64)]).astype(np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])

    (pf, pr), (uf, ur) = csr(toxic), csr(unlabelled)
    n_p, n_u = len(toxic), len(unlabelled)
    x, m, v = np.zeros(n_features + 1), np.zeros(n_features + 1), np.zeros(n_features + 1)
    for t in range(1, steps + 1):
        zp, zu = np.bincount(pr, x[pf], n_p) + x[-1], np.bincount(ur, x[uf], n_u) + x[-1]
        sp, su = sigmoid(zp), sigmoid(zu)
        if np.logaddexp(0, zu).mean() >= prior * np.logaddexp(0, zp).mean():
            gp, gu = -prior / n_p * np.ones(n_p), su / n_u
        else:
            gp, gu = prior * sp / n_p, -su / n_u
        g = np.append(np.bincount(pf, gp[pr], n_features) + np.bincount(uf, gu[ur], n_features) + l2 * x[:-1], gp.sum() + gu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return x[:-1], float(x[-1])


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, n_features: int = N_FEATURES) -> Model:
    """Learn from rows that are not held out. Without a confirmed toxic document every score is 0."""
    small_batches(spark)
    known = labels.where(~held_out()).where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = staged(known.select("doc_id", (F.col("toxic") == 1).alias("toxic")), "labels")
    prior = known.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    ids = docs.where(~held_out()).where("doc_id is not null").select("doc_id").distinct()
    lowest = [F.xxhash64("doc_id"), F.col("doc_id")]
    toxic = ids.join(known.where("toxic").select("doc_id"), "doc_id", "left_semi").orderBy(*lowest).limit(MAX_TOXIC).select("doc_id", F.lit(True).alias("p"), F.lit(False).alias("u"))
    unlabelled = ids.orderBy(*lowest).limit(MAX_UNLABELLED).select("doc_id", F.lit(False).alias("p"), F.lit(True).alias("u"))
    # MAX_TOXIC + MAX_UNLABELLED ids at most
    chosen = staged(toxic.union(unlabelled).groupBy("doc_id").agg(F.max("p").alias("p"), F.max("u").alias("u")), "toxicity-ids")
    sample = staged(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "p", "u").agg(F.min("text").alias("text")), "toxicity-sample")
    sample = sample.repartition(SAMPLE_TASKS, "doc_id")
    n_p, n_u = sample.agg(F.sum(F.col("p").cast("long")), F.sum(F.col("u").cast("long"))).first()
    if not n_p or not prior:
        return Model({}, -np.inf)

    def spelled(batch: pa.RecordBatch) -> dict:
        return {"p": batch.column("p"), "u": batch.column("u"), "grams": [sorted(set().union(*map(grams, words(t)))) for t in utf8(batch.column("text"))]}

    held = in_arrow(sample, spelled, "p boolean, u boolean, grams array<string>").select("p", "u", F.explode("grams").alias("gram"))
    held = held.groupBy("gram").agg(F.sum(F.col("p").cast("long")).alias("in_p"), F.sum(F.col("u").cast("long")).alias("in_u")).where(F.col("in_p") >= MIN_TOXIC)
    rate_p, rate_u = F.col("in_p") / n_p, (F.col("in_u") + 1) / (n_u + 1)
    lift = (rate_p - rate_u) / F.sqrt(rate_u * (1 - rate_u) / n_p + 1e-12)
    feature = {r.gram: i for i, r in enumerate(held.orderBy(lift.desc(), "gram").limit(n_features).select("gram").collect())}

    def numbered(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "p": batch.column("p"), "u": batch.column("u"),
                "features": [sorted({feature[g] for w in words(t) for g in grams(w) if g in feature}) for t in utf8(batch.column("text"))]}

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = in_arrow(sample, numbered, f"doc_id {kind}, p boolean, u boolean, features array<int>").collect()
    rows.sort(key=lambda r: str(r.doc_id))
    w, b = fit_nnpu([np.array(r.features, np.int64) for r in rows if r.p], [np.array(r.features, np.int64) for r in rows if r.u], len(feature), prior)
    return Model({g: float(w[i]) for g, i in feature.items()}, b)


def scored(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (all columns, any names) with ``__score``, 0 to 1, of each whole text; null and empty texts get the bias's score."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    small_batches(spark)
    schema = StructType(list(docs.schema)).add("__score", "double")
    kind, shared = to_arrow_schema(schema), spark.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        number = {g: i for i, g in enumerate(model.weights)}
        weight = list(model.weights.values())
        known: dict[bytes, tuple[int, ...]] = {}
        for batch in batches:
            out = []
            for text in utf8(batch.column("text")):
                found: set[int] = set()
                for w in words(text):
                    if (f := known.get(w)) is None:
                        f = known[w] = tuple(number[g] for g in grams(w) if g in number)
                    if f:
                        found.update(f)
                out.append(model.score(sum(weight[i] for i in sorted(found))))
                if len(known) > MEMORY:
                    known.clear()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], schema=kind)

    return docs.mapInArrow(run, schema)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (1 where the score reaches the threshold)."""
    docs = docs.select("doc_id", "text")
    out = scored(spark, docs, fit(spark, docs, labels))
    return out.select("doc_id", held_out().alias("held_out"), F.col("__score").alias("score"), (F.col("__score") >= threshold).cast("int").alias("predicted"))


def remove_toxic(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, with their columns as they came."""
    return scored(spark, docs, fit(spark, docs.select("doc_id", "text"), labels)).where(F.col("__score") < threshold).select(*docs.columns)
