"""Toxicity scores from two class-conditional Kneser-Ney models.

Each class has discounted counts of word pairs (in how many texts they occur), which back off to the class's continuation counts of single words (in
how many different contexts a word occurs), and these to continuation counts shared by both classes. Expressions that
are rare, whose class counts depart from the shared ones by no more than chance, or whose two estimates are close, take
the shared estimate alone and speak for neither class. A text's evidence is the difference of its log-likelihoods, normalised for length; a
logistic curve, fitted on labelled texts that the counts have not seen, turns it into a score.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import session
from marketlens.llm import words

MAX_TRAINING_DOCS = 20_000  # bound of the labelled sample, taken by the hash of the id
CALIBRATION_FOLDS = 3  # one of so many training texts fits the curve, the others the counts
DISCOUNT = 0.75
LEAST_COUNT = 5
LEAST_DEPARTURE = 4.0  # in standard deviations of a Poisson count
LEAST_FACTOR = 3.0  # between the two classes' probabilities


class Model(NamedTuple):
    """Log-ratios (toxic over ordinary) of words and of pairs by sorted hash, and the logistic curve."""

    words: np.ndarray
    word_ratios: np.ndarray
    pairs: np.ndarray
    pair_ratios: np.ndarray
    curve: np.ndarray


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; 0 for null ids."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n)), F.lit(0))


def _before(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The word before each word, 0 at the start of a row."""
    if not len(h):
        return h
    before = np.concatenate([np.zeros(1, np.uint64), h[:-1]])
    before[first[:-1][np.diff(first) > 0]] = 0
    return before


def _pair_keys(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return words.mix(words.mix(u) ^ v)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of neighbouring words per class, each counted once per text, added up within a block of texts."""
    for batch in batches:
        toxic = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
        for lo, hi, h, first in words.blocks(batch):
            if not len(h):
                continue
            rows = np.repeat(np.arange(hi - lo), np.diff(first))
            once = np.unique(np.rec.fromarrays([_before(h, first), h, rows]))
            table = np.rec.fromarrays([once.f0, once.f1, toxic[lo:hi][once.f2]])
            keys, n = np.unique(table, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.f0.view(np.int64)), pa.array(keys.f1.view(np.int64)), pa.array(keys.f2.astype(bool)),
                 pa.array(n.astype(np.int64))], names=["u", "v", "toxic", "n"])


def _sorted(hashes: list[int], ratios: list[float]) -> tuple[np.ndarray, np.ndarray]:
    keys, values = np.array(hashes, np.int64).view(np.uint64), np.array(ratios, float)
    order = np.argsort(keys)
    return keys[order], values[order]


def _departs(toxic: Column, every: Column, share: Column) -> Column:
    expected = every * share
    return (every >= LEAST_COUNT) & (F.abs(toxic - expected) >= LEAST_DEPARTURE * F.sqrt(expected))


def fit_counts(labelled: DataFrame) -> Model:
    """The two models from columns doc_id, text, toxic (boolean), without a curve.

    Gathered are the expressions that tell the classes apart: no more than the words of the bounded sample over
    ``LEAST_COUNT``. Without texts of both classes there are none.
    """
    spark = labelled.sparkSession
    path = session.scratch(spark, "toxicity")
    counted = (labelled.select("doc_id", "text", "toxic").mapInArrow(_count, "u long, v long, toxic boolean, n long")
               .groupBy("u", "v").agg(F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("t"),
                                      F.sum(F.when(F.col("toxic"), 0).otherwise(F.col("n"))).alias("o")))
    counted.write.parquet(os.path.join(path, "pairs"))
    pairs = spark.read.parquet(os.path.join(path, "pairs"))
    (pairs.groupBy("v").agg(F.count_if(F.col("t") > 0).alias("t"), F.count_if(F.col("o") > 0).alias("o"),
                            F.count("*").alias("n")).write.parquet(os.path.join(path, "words")))
    known = spark.read.parquet(os.path.join(path, "words"))
    total = known.agg(F.sum("t").alias("t"), F.sum("o").alias("o"), F.sum("n").alias("n"),
                      F.count_if(F.col("t") > 0).alias("t_kinds"), F.count_if(F.col("o") > 0).alias("o_kinds")).first()
    none = np.empty(0, np.uint64), np.empty(0)
    if not total["t"] or not total["o"]:
        return Model(*none, *none, np.zeros(2))

    def word(c: str) -> Column:
        """Continuation probability of a word in a class, backed off to the shared one."""
        shared = F.col("n") / total["n"]
        left = DISCOUNT * total[f"{c}_kinds"] / total[c]
        return F.greatest(F.col(c) - DISCOUNT, F.lit(0)) / total[c] + left * shared

    told = _departs(F.col("t"), F.col("t") + F.col("o"), F.lit(total["t"] / (total["t"] + total["o"])))
    apart = F.abs(F.col("r")) >= float(np.log(LEAST_FACTOR))
    lone = known.where(told).select("v", F.log(word("t") / word("o")).alias("r")).where(apart).toArrow().to_pandas()
    contexts = (pairs.groupBy("u").agg(F.sum("t").alias("h_t"), F.sum("o").alias("h_o"), F.count_if(F.col("t") > 0).alias("k_t"),
                                       F.count_if(F.col("o") > 0).alias("k_o")).where("h_t > 0 and h_o > 0"))
    often = pairs.where(F.col("t") + F.col("o") >= LEAST_COUNT).withColumnsRenamed({"t": "n_t", "o": "n_o"})
    often = often.join(contexts, "u").where(
        _departs(F.col("n_t"), F.col("n_t") + F.col("n_o"), F.col("h_t") / (F.col("h_t") + F.col("h_o")))).join(known, "v")

    def pair(c: str) -> Column:
        """Probability of a word after another in a class, backed off to the word's."""
        return (F.greatest(F.col(f"n_{c}") - DISCOUNT, F.lit(0)) / F.col(f"h_{c}")
                + DISCOUNT * F.col(f"k_{c}") / F.col(f"h_{c}") * word(c))

    two = often.select("u", "v", F.log(pair("t") / pair("o")).alias("r")).where(apart).toArrow().to_pandas()
    keys = _pair_keys(two["u"].to_numpy(np.int64).view(np.uint64), two["v"].to_numpy(np.int64).view(np.uint64))
    return Model(*_sorted(lone["v"].tolist(), lone["r"].tolist()),
                 *_sorted(keys.view(np.int64).tolist(), two["r"].tolist()), np.zeros(2))


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return keys[at] == wanted, values[at]


def evidence(docs: DataFrame, model: Model) -> DataFrame:
    """Per row of columns doc_id, text: doc_id, n_words, ratio (toxic minus ordinary log-likelihood).

    An expression (a pair that has a ratio of its own, else the word) counts once per text: repetition adds no evidence.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model[:4])  # bounded as said in fit_counts

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, wr, p, pr = shared.value
        for batch in batches:
            for lo, hi, h, first in words.blocks(batch):
                rows, keys = np.repeat(np.arange(hi - lo), np.diff(first)), _pair_keys(_before(h, first), h)
                known, value = _found(w, wr, h)
                paired, pair_value = _found(p, pr, keys)
                some = np.flatnonzero(known | paired)
                once = some[np.unique(np.rec.fromarrays([rows[some], np.where(paired, keys, h)[some]]), return_index=True)[1]]
                sums = np.bincount(rows[once], np.where(paired, pair_value, value)[once], hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(np.diff(first).astype(np.int64)),
                     pa.array(sums.astype(float))], names=["doc_id", "n_words", "ratio"])

    return docs.select("doc_id", "text").mapInArrow(score, "doc_id long, n_words long, ratio double")


def fit_curve(ratio: np.ndarray, n_words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression (Newton steps, ridged) of the class on the evidence per square root of the words."""
    x = ratio / np.sqrt(np.maximum(n_words, 1))
    scale = float(np.std(x)) or 1.0
    x = np.stack([np.ones(len(x)), x / scale], axis=1)
    y, b, ridge = toxic.astype(float), np.zeros(2), np.diag([1e-6, 1e-2])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ b)
        b = b + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return np.array([b[0], max(b[1], 0.0) / scale])


def fit(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic",
        max_docs: int = MAX_TRAINING_DOCS) -> Model:
    """Learn from the labelled documents, at most ``max_docs`` of them, chosen by the hash of the id.

    Null labels and ids are left out; of several labels of a document the largest counts. If one class is missing among
    the texts for the counts or for the curve, all texts get the share of toxic labels as their score.
    """
    session.ship(docs.sparkSession)
    marked = (labels.where(F.col(toxic).isNotNull() & F.col(doc_id).isNotNull())
              .groupBy(F.col(doc_id).cast("long").alias("doc_id")).agg((F.max(toxic) > 0).alias("toxic"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    path = session.scratch(docs.sparkSession, "toxicity")
    rows.join(F.broadcast(marked), "doc_id").write.parquet(path)  # at most max_docs labels
    sample = docs.sparkSession.read.parquet(path)
    later = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CALIBRATION_FOLDS)) == 0
    model = fit_counts(sample.where(~later))
    seen = evidence(sample.where(later), model).join(sample.select("doc_id", "toxic"), "doc_id").toArrow().to_pandas()
    share = sample.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0
    if not len(model.words) or seen["toxic"].nunique() < 2:
        share = min(max(share, 1e-6), 1 - 1e-6)
        return model._replace(words=model.words[:0], word_ratios=model.word_ratios[:0], pairs=model.pairs[:0],
                              pair_ratios=model.pair_ratios[:0], curve=np.array([np.log(share / (1 - share)), 0]))
    return model._replace(curve=fit_curve(seen["ratio"].to_numpy(), seen["n_words"].to_numpy(), seen["toxic"].to_numpy()))


def score(docs: DataFrame, model: Model, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, score (0 to 1), predicted (1 from 0.5 on), n_words, ratio.

    Whole texts are scored; null and empty texts have no evidence and get the curve's value at none. Null ids are kept,
    repeated rows are scored alike, other columns are left out; an empty table gives no rows.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    session.ship(docs.sparkSession)
    n = F.greatest("n_words", F.lit(1))
    a, b = (float(x) for x in model.curve)
    value = 1 / (1 + F.exp(-(a + b * F.col("ratio") / F.sqrt(n))))
    return (evidence(rows, model).withColumn("score", value)
            .select("doc_id", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "n_words", "ratio"))
