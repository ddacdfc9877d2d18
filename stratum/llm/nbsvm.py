"""Quality classifier: a linear support vector machine on naive-Bayes features.

Features are the indicators of a text's word 1-grams and 2-grams (lower case),
hashed to ``BUCKETS`` and scaled by the log ratio of their smoothed class
frequencies among the labelled rows.  The hinge-loss machine is fitted by dual
coordinate descent, and its margins are turned into probabilities by a logistic
fit on labelled rows that the machine has not seen.

Scale: class frequencies and machine are fitted on at most ``MAX_FIT`` labelled
rows: of the labels whose document exists (only ids are joined to find out), those
with the smallest id hash, which are broadcast to find their texts.  The machine
is fitted in one task on the first of them, in the order of the hash, that have at
most ``MAX_FIT_NGRAMS`` distinct n-grams together; a text has ``BUCKETS`` of them at
most and none is left out for its length, so long texts shorten the sample.  No
other text moves; scoring is one narrow pass with the ``BUCKETS`` weights
broadcast, in proportion to the text.

Inputs of a score are words only, never labels, language, source or id.

Defined cases: null and empty texts have no features and score the intercept;
labels of unknown documents, null labels and unlabelled documents are not used
for fitting; an id labelled 0 and 1 gives two training rows; with labels of one
class only every score is that class's smoothed share (1/2 without any label);
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbytes as wb
from .store import map_batches, stored

BUCKETS = 1 << 18
FOLDS = 5
LIMIT = 0.3
#: bounds of the sample that the machine is fitted on
MAX_FIT, MAX_FIT_NGRAMS = 8192, 4_000_000
C = 1.0
#: the descent ends when no coordinate's projected gradient is larger, or after PASSES
TOLERANCE, PASSES = 1e-3, 2000


def ngrams(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, document, bucket): the distinct hashed n-grams of documents lo..hi."""
    data, offsets = wb.text_buffer(column)
    for lo, hi in wb.chunks(offsets):
        w = wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.NOT_SPACE, wb.LOWER)
        h = w.hashes()
        pair = wb.windows(w.first, 2)
        codes = np.concatenate([wb.mix(h), wb.mix(h[pair] * np.uint64(3) + wb.mix(h[pair + 1]))]) if len(h) else h
        doc = np.concatenate([w.doc, w.doc[pair]]) if len(h) else w.doc
        key = np.unique(doc.astype(np.int64) * BUCKETS + (codes >> np.uint64(46)).astype(np.int64))
        yield lo, hi, key // BUCKETS, key % BUCKETS


def _indicators(rows: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``grams``, the sorted distinct buckets of ``text``."""
    schema = rows.select(*keep).schema.add("grams", T.ArrayType(T.IntegerType()))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, doc, bucket in ngrams(b.column(len(keep))):
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                    + [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(bucket.astype(np.int32)))],
                    names=schema.names)

    return map_batches(rows.select(*keep, "text"), apply, schema)


def dual_descent(indptr: np.ndarray, index: np.ndarray, value: np.ndarray, sign: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and intercept of the L2-regularised hinge loss.

    Row i has the features ``index[indptr[i]:indptr[i + 1]]``; the intercept is
    a further feature that is always 1.  Passes in a fixed random order.
    """
    w, bias = np.zeros(BUCKETS), 0.0
    alpha = np.zeros(len(sign))
    square = np.add.reduceat(np.append(value ** 2, 0.0), indptr[:-1]) if len(value) else np.zeros(len(sign))
    square = np.where(np.diff(indptr) > 0, square, 0.0) + 1.0
    # the rarer class gets as much weight in all as the other
    positive = (sign > 0).mean()
    bound = C * np.where(sign > 0, 0.5 / max(positive, 1e-9), 0.5 / max(1 - positive, 1e-9))
    order = np.random.default_rng(0)
    active, upper, lower = np.arange(len(sign)), np.inf, -np.inf
    for _ in range(PASSES):
        most, least = -np.inf, np.inf
        keep = np.ones(len(active), bool)
        for k in order.permutation(len(active)):
            i = active[k]
            lo, hi = indptr[i], indptr[i + 1]
            x, v = index[lo:hi], value[lo:hi]
            gradient = sign[i] * (w[x] @ v + bias) - 1
            if (alpha[i] == 0 and gradient > upper) or (alpha[i] == bound[i] and gradient < lower):
                keep[k] = False  # at its bound and far from leaving it: set aside
                continue
            projected = min(gradient, 0.0) if alpha[i] == 0 else max(gradient, 0.0) if alpha[i] == bound[i] else gradient
            most, least = max(most, projected), min(least, projected)
            new = min(max(alpha[i] - gradient / square[i], 0.0), bound[i])
            if new != alpha[i]:
                change = (new - alpha[i]) * sign[i]
                w[x] += change * v  # indices of one row are distinct
                bias += change
                alpha[i] = new
        active = active[keep]
        if max(most, -least) <= TOLERANCE:
            if len(active) == len(sign):
                break
            active, upper, lower = np.arange(len(sign)), np.inf, -np.inf  # once more with all rows
        else:
            upper, lower = (most if most > 0 else np.inf), (least if least < 0 else -np.inf)
    return w, bias


def logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(a, b) of the probability 1 / (1 + exp(-(a * margin + b))), by Newton
    steps on smoothed targets; a is never negative."""
    n1, n0 = label.sum(), (1 - label).sum()
    target = np.where(label > 0, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -40, 40)))
        g = np.array([((p - target) * margin).sum() + 1e-3 * a, (p - target).sum() + 1e-3 * b])
        s = np.maximum(p * (1 - p), 1e-9)
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-3]])
        da, db = np.linalg.solve(h, g)
        a, b = max(a - float(np.clip(da, -2, 2)), 0.0), b - float(np.clip(db, -2, 2))
    return a, b


def _fit_task(ratio: np.ndarray):
    """One call on the bounded sample: weights, intercept and logistic fit."""

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank", kind="stable")
        size = pdf["grams"].map(len).to_numpy()
        grams = np.concatenate([*pdf["grams"], np.zeros(0, np.int32)]).astype(np.int64)
        indptr = np.concatenate(([0], np.cumsum(size)))
        norm = np.repeat(np.maximum(np.sqrt(np.add.reduceat(
            np.append(ratio[grams] ** 2, 0.0), np.minimum(indptr[:-1], len(grams)))), 1e-9), size)
        value = ratio[grams] / norm
        label = pdf["label"].to_numpy()
        # every fourth row is kept for the logistic fit
        late = np.arange(len(pdf)) % 4 == 3
        row = np.repeat(np.arange(len(pdf)), size)
        fit_on = np.flatnonzero(~late)
        ptr = np.concatenate(([0], np.cumsum(size[fit_on])))
        taken = ~late[row]
        w, bias = dual_descent(ptr, grams[taken], value[taken], np.where(label[fit_on] > 0, 1.0, -1.0))
        margin = np.bincount(row, weights=w[grams] * value, minlength=len(pdf)) + bias
        a, b = logistic(margin[late], label[late].astype(float))
        return pd.DataFrame({"weights": [(w * ratio).astype("<f8").tobytes()], "bias": [bias], "a": [a], "b": [b]})

    return fit


def train(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> dict:
    """The fitted model: ``ratio``, ``weights``, ``bias``, ``a``, ``b``, or ``share`` for one class."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("id").cast("string"), F.lit("")).cast("binary")) % folds
    known = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & (fold != 0)).distinct()
             .join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
             .withColumn("rank", F.xxhash64("id", F.lit("fit"))))
    # the sample: the smallest ranks; MAX_FIT narrow rows may be broadcast
    known = F.broadcast(known.orderBy("rank", "label").limit(MAX_FIT))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(known, "id")
    rows = stored(_indicators(rows, ["rank", "label"]).withColumn("size", F.size("grams").cast("long")), "labelled")
    by_class = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(by_class) < 2:
        n = sum(by_class.values())
        return {"share": (by_class.get(1, 0) + 1) / (n + 2)}
    counts = (rows.select("label", F.explode("grams").alias("gram")).groupBy("gram")
              .agg(F.sum("label").alias("n1"), F.count("*").alias("n")).toArrow())  # at most BUCKETS rows
    gram, n1 = counts.column("gram").to_numpy(), counts.column("n1").to_numpy()
    p, q = np.ones(BUCKETS), np.ones(BUCKETS)
    p[gram] += n1
    q[gram] += counts.column("n").to_numpy() - n1
    ratio = np.log((p / (by_class[1] + 2)) / (q / (by_class[0] + 2)))
    # as far as the bound on the task goes
    cut = rows.select("rank", "size").orderBy("rank").limit(MAX_FIT).toArrow()
    fits = int(np.searchsorted(np.cumsum(cut.column("size").to_numpy()), MAX_FIT_NGRAMS, side="right"))
    last = int(cut.column("rank")[max(min(fits, len(cut)) - 1, 0)].as_py()) if len(cut) else 0
    sample = rows.filter(F.col("rank") <= last).limit(MAX_FIT)  # ranks of repeated ids may tie
    fitted = (sample.select("rank", "label", "grams").groupBy(F.lit(0).alias("all"))
              .applyInPandas(_fit_task(ratio), "weights binary, bias double, a double, b double").first())
    return {"ratio": ratio, "weights": np.frombuffer(fitted["weights"], "<f8"),
            "bias": fitted["bias"], "a": fitted["a"], "b": fitted["b"]}


def classify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id and score, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = rows.drop("text").schema.add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            if "share" in m:
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.full(b.num_rows, m["share"]))], names=schema.names)
                continue
            for lo, hi, doc, bucket in ngrams(b.column(1)):
                n = hi - lo
                norm = np.sqrt(np.bincount(doc, weights=m["ratio"][bucket] ** 2, minlength=n))
                margin = np.bincount(doc, weights=m["weights"][bucket], minlength=n) / np.maximum(norm, 1e-9) + m["bias"]
                score = 1 / (1 + np.exp(-np.clip(m["a"] * margin + m["b"], -40, 40)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, n), pa.array(score)], names=schema.names)

    return map_batches(rows, apply, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, limit: float = LIMIT,
                   id_col: str = "doc_id", **cols: str) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted."""
    scored = classify(docs, train(docs, labels, folds, id_col=id_col, **cols), id_col)
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return scored.select("doc_id", (F.crc32(key) % folds == 0).alias("held_out"), "score",
                         (F.col("score") >= limit).cast("int").alias("predicted"))
