"""Exact substring dedup by level-wise doubling.

A window of ``window`` words is a repeat if its word sequence also starts in
another document.  Levels go from windows of half the length upwards:

1. Seeds.  Of the half-length windows inside each full window, the one with the
   smallest hash is its seed, so equal windows have equal seeds and few
   positions are seeds of anything.  Seeds are counted over all documents; one
   that occurs in a single document cannot be part of a repeat.
2. Doubling.  Only windows at positions whose parts survived are hashed at the
   next length (twice the last, or the full one), counted over all documents,
   and so on until the full length is reached or no candidate survives.

A word is removed if it lies in a window that also starts in a document with a
smaller id.  Windows are judged on the input, not on what is left.

Scale: every level is a count by hash (map-side combined) and an equi-join;
hot hashes are split by the adaptive skew join and no group is collected but a
document's own positions.  Texts move once, to documents with a surviving seed.
All documents with the same text have the same windows, so only the one with
the smallest id takes part; the others lose all words that a window covers.

Defined cases: null and empty texts have no words; texts shorter than a window
lose nothing; among repeated ids nobody is smaller, so rows of one id do not
remove each other's words; a null id comes after all others; an empty table
gives an empty result; other columns are ignored.  Positions fit 31 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbytes as wb
from .store import map_batches, stored

WINDOW = 50
_KEY = ["id", "k0", "k1"]
_SPANS = T.ArrayType(T.StructType().add("first", "integer").add("last", "integer"))


def seeds(h: np.ndarray, first: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start of every window, start of its seed, hash of every seed-long run)."""
    starts = wb.windows(first, window)
    if not len(starts):
        return starts, starts, np.zeros(0, np.uint64)
    run = np.arange(len(h) - seed + 1)
    g = wb.range_hash(h, run, run + seed)
    width, have, best = window - seed + 1, 1, run
    while have < width:  # minima over twice as many runs each time
        step = min(have, width - have)
        a, b = best[:-step], best[step:]
        best = np.where(g[a] <= g[b], a, b)
        have += step
    return starts, best[starts], g


def _row_keys(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("k0"),
                       F.xxhash64(F.lit(1), text).alias("k1"), text.alias("text"))


def _same(a: DataFrame, b: DataFrame) -> F.Column:
    return (a["k0"] == b["k0"]) & (a["k1"] == b["k1"]) & a["id"].eqNullSafe(b["id"])


def _pieces(column: pa.Array) -> Iterator[tuple[int, int, wb.Words]]:
    data, offsets = wb.text_buffer(column)
    for lo, hi in wb.chunks(offsets):
        yield lo, hi, wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.NOT_SPACE)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _lists(values: np.ndarray, doc: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """List array: the values of each of n documents (``doc`` ascending)."""
    cut = np.searchsorted(doc, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values, kind))


def _first_pass(rows: DataFrame, window: int, seed: int) -> DataFrame:
    """By row: n_words, sha256 of all words, and the seeds (hash, position)."""
    schema = (rows.drop("text").schema.add("n_words", "long").add("sha256", "string")
              .add("hash", T.ArrayType(T.LongType())).add("at", T.ArrayType(T.IntegerType())))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, w in _pieces(b.column(3)):
                n = hi - lo
                _, at, g = seeds(w.hashes(), w.first, window, seed)
                at = np.unique(at)
                doc = w.doc[at] if len(at) else at
                raw = w.data.tobytes()
                sha = [_digest(raw[w.offsets[i]:w.offsets[i + 1]].split()) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).slice(lo, n) for i in range(3)]
                    + [pa.array(np.diff(w.first), pa.int64()), pa.array(sha),
                       _lists(wb.signed(g[at]), doc, n, pa.int64()),
                       _lists((at - w.first[doc]).astype(np.int32), doc, n, pa.int32())],
                    names=schema.names)

    return map_batches(rows, apply, schema)


def _hashed(hot: DataFrame, window: int, last: int, length: int, sampled: bool) -> DataFrame:
    """(id, k0, k1, at, h0, h1): windows of ``length`` words at candidate positions.

    ``hot``: (id, k0, k1, text, at); ``at`` holds the surviving positions of
    length ``last``: seeds of full windows if ``sampled``, else all windows.
    """
    schema = hot.select(*_KEY).schema.add("at", "integer").add("h0", "long").add("h1", "long")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            survivors = b.column(4).to_pylist()
            for lo, hi, w in _pieces(b.column(3)):
                h = w.hashes()
                alive = np.zeros(len(h) + 1, dtype=bool)
                for i in range(lo, hi):
                    alive[int(w.first[i - lo]) + np.array(survivors[i], np.int64)] = True
                if sampled:
                    starts, at, _ = seeds(h, w.first, window, last)
                    starts = starts[alive[at]]
                    if length < window:  # every run of this length inside such a window
                        starts = np.unique((starts[:, None] + np.arange(window - length + 1)).ravel())
                else:
                    starts = wb.windows(w.first, length)
                    starts = starts[alive[starts] & alive[starts + length - last]]
                doc = w.doc[starts] if len(starts) else starts
                index = pa.array(doc + lo)
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).take(index) for i in range(3)]
                    + [pa.array((starts - w.first[doc]).astype(np.int32)),
                       pa.array(wb.signed(wb.range_hash(h, starts, starts + length, 1))),
                       pa.array(wb.signed(wb.range_hash(wb.mix(h), starts, starts + length, 2)))],
                    names=schema.names)

    return map_batches(hot.select(*_KEY, "text", "at"), apply, schema)


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Hashes that occur in documents of different ids, with the smallest id."""
    counted = rows.groupBy(*by).agg(F.min("id").alias("least"), F.max("id").alias("most"),
                                    F.count(F.when(F.col("id").isNull(), 1)).alias("unnamed"))
    # stored, so that both sides of the join to come are plain shuffles, which
    # the adaptive skew join can split
    return stored(counted.filter("least < most OR (least IS NOT NULL AND unnamed > 0)").select(*by, "least"), "repeated")


def _levels(rows: DataFrame, part: DataFrame, window: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Texts with surviving seeds, and (key, starts) of the windows that also
    start in a document with a smaller id."""

    def with_text(texts: DataFrame, state: DataFrame, name: str) -> DataFrame:
        return stored(texts.join(state, _same(texts, state))
                      .select(*[texts[c] for c in _KEY], texts["text"], state["at"]), name)

    def positions(found: DataFrame) -> DataFrame:
        return stored(found.groupBy(*_KEY).agg(F.collect_set("at").alias("at")), "positions")

    state = positions(part.join(_repeated(part, ["hash"]).select("hash"), "hash"))
    hot, last, sampled = with_text(rows, state, "hot"), seed, True
    while True:
        length = min(2 * last, window)
        found = stored(_hashed(hot, window, last, length, sampled), "windows")
        shared = found.join(_repeated(found, ["h0", "h1"]), ["h0", "h1"])
        if length == window:
            return hot, positions(shared.filter("least < id OR id IS NULL"))
        state = positions(shared)
        if state.isEmpty():
            return hot, state
        hot, last, sampled = with_text(hot, state, "hot"), length, False


def _cut(marked: DataFrame, window: int) -> DataFrame:
    """(key, spans, n_removed, kept_sha256) of the texts that lose words."""
    schema = (marked.select(*_KEY).schema.add("spans", _SPANS)
              .add("n_removed", "long").add("kept_sha256", "string"))
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, n_removed, sha = [], [], []
            for text, at in zip(b.column(3), b.column(4).to_pylist()):
                words = text.as_py().encode().split()
                step = np.zeros(len(words) + 1, np.int64)
                np.add.at(step, at, 1)
                np.add.at(step, np.array(at) + window, -1)
                gone = np.cumsum(step[:-1]) > 0
                edge = np.flatnonzero(np.diff(np.concatenate(([0], gone, [0]))))
                spans.append([{"first": x, "last": y} for x, y in edge.reshape(-1, 2).tolist()])
                n_removed.append(int(gone.sum()))
                sha.append(_digest([w for w, g in zip(words, gone.tolist()) if not g]))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(spans, spans_type), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string())],
                names=schema.names)

    return map_batches(marked, apply, schema)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 and spans,
    the runs [first, last) of removed words."""
    seed = max(1, window // 2)
    rows = _row_keys(docs, id_col, text_col)
    seen = stored(_first_pass(rows, window, seed), "seeds")
    # copies of a text: only the smallest id takes part
    copies = seen.groupBy("k0", "k1").agg(F.min("id").alias("first_id"))
    leads = seen.join(copies, ["k0", "k1"]).filter(F.col("id").eqNullSafe(F.col("first_id")))
    part = stored(leads.select(*_KEY, F.explode(F.arrays_zip("hash", "at")).alias("s"))
                  .select(*_KEY, "s.hash", "s.at"), "seed-rows")
    hot, starts = _levels(rows, part, window, seed)
    marked = hot.join(starts, _same(hot, starts)).select(*[hot[c] for c in _KEY], "text", starts["at"])
    cut = stored(_cut(marked, window).distinct(), "cut")

    all_rows = seen.select(*_KEY, "n_words", "sha256").join(copies, ["k0", "k1"])
    out = all_rows.join(cut, _same(all_rows, cut), "left")
    copy = ~all_rows["id"].eqNullSafe(F.col("first_id")) & (F.col("n_words") >= window)
    whole = F.array(F.struct(F.lit(0).alias("first"), F.col("n_words").cast("int").alias("last")))
    return out.select(
        all_rows["id"].alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha256")).alias("kept_sha256"),
        F.when(copy, whole).otherwise(F.coalesce("spans", F.array().cast(_SPANS))).alias("spans"))
