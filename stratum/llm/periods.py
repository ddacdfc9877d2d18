"""Periodic runs: stretches of words that repeat with a period, found and collapsed.

A run is a maximal stretch with smallest period q and at least ``exponent``
periods (and ``least`` words).  Each of its words occurs ``exponent`` times in
it at least, which gives the method:

* Frequency splitting.  A word that occurs less than ``exponent`` times within
  its segment (a document at first) belongs to no run there; such words split
  the segment, pieces under ``least`` words go, and what is left is counted
  again within its piece, until nothing splits.  All segments of a batch are
  counted at once, by one sort per round; most prose has none left after a few.
* Lag scan.  A run of period q covers ``exponent`` successive multiples of q, so
  for every lag q only every q-th word of a surviving segment is looked at
  (``n log n`` words in all).  Where ``exponent`` of them agree, prefix sums of a
  64-bit hash say whether the words between them agree too and whether a
  divisor of q is a period already; then the words themselves are compared to
  find how far the run reaches.

Words are numbered by their bytes, so equal numbers are equal words.  A false
hash match cannot make a run, as its words are compared; it could only hide
one behind a shorter period (chance of 2**-64 per lag tested).

Defined cases: a null or empty text has no words and no runs; null ids and
repeated rows are judged row by row; other columns are ignored by
``periodic_runs`` and kept by ``collapsed``.  A document is one unit of work, as a
run may be as long as the document; memory is a small multiple of its words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import map_batches
from .wordbytes import NOT_SPACE, Words, chunks, mix, powers, text_buffer

EXPONENT, LEAST = 4, 6
WORD = r"[^\x20\x09-\x0D]+"

Run = tuple[int, int, int]  # start, length, period

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])


def word_numbers(words: Words) -> np.ndarray:
    """A number for every word; equal numbers mean equal bytes."""
    data = words.data[NOT_SPACE[words.data]]
    offsets = np.concatenate([[0], np.cumsum(words.end - words.start)]).astype(np.int64)
    arr = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(words), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))])
    return arr.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def split_by_frequency(numbers: np.ndarray, first: np.ndarray, exponent: int = EXPONENT,
                       least: int = LEAST) -> list[tuple[int, int]]:
    """Segments [lo, hi) that survive; ``first`` are the documents' first words (n + 1)."""
    done: list[tuple[int, int]] = []
    place = np.arange(len(numbers))
    lo, hi = first[:-1], first[1:]
    long = hi - lo >= least
    lo, hi = lo[long], hi[long]
    while len(lo):
        length = hi - lo
        segment = np.repeat(np.arange(len(lo)), length)
        place = np.repeat(lo - np.cumsum(length) + length, length) + np.arange(int(length.sum()))
        key = segment * (int(numbers.max()) + 1) + numbers[place]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        head = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        size = np.diff(np.append(head, len(ranked)))
        frequent = np.empty(len(key), bool)
        frequent[order] = np.repeat(size >= exponent, size)
        split = np.bincount(segment[~frequent], minlength=len(lo)) > 0
        done += zip(lo[~split].tolist(), hi[~split].tolist())
        # pieces of the split segments: stretches of frequent words
        use = frequent & split[segment]
        p, s = place[use], segment[use]
        if not len(p):
            break
        new = np.concatenate([[True], (p[1:] != p[:-1] + 1) | (s[1:] != s[:-1])])
        lo = p[new]
        hi = p[np.append(np.flatnonzero(new)[1:] - 1, len(p) - 1)] + 1
        long = hi - lo >= least
        lo, hi = lo[long], hi[long]
    return sorted(done)


def _prime_factors(q: int) -> list[int]:
    out, f = [], 2
    while f * f <= q:
        if q % f == 0:
            out.append(f)
            while q % f == 0:
                q //= f
        f += 1
    return out + [q] if q > 1 else out


def lag_scan(w: np.ndarray, exponent: int = EXPONENT, least: int = LEAST) -> list[Run]:
    """All runs of the words ``w`` of one segment."""
    n = len(w)
    fwd = powers(n + 1)[0]
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(w.astype(np.uint64) + np.uint64(1)) * fwd[:n], out=sums[1:])
    found: list[Run] = []

    def same(at: np.ndarray, size: int, lag: int) -> np.ndarray:
        """Do the ``size`` words from ``at`` equal those ``lag`` further on?"""
        return (sums[at + size] - sums[at]) * fwd[lag] == sums[at + size + lag] - sums[at + lag]

    for q in range(1, n // exponent + 1):
        anchors = w[::q]
        equal = anchors[1:] == anchors[:-1]
        m = len(equal) - exponent + 2
        agree = equal[:m].copy()
        for k in range(1, exponent - 1):
            agree &= equal[k:k + m]
        if not agree.any():
            continue
        at = np.flatnonzero(agree) * q
        span = (exponent - 2) * q + 1
        at = at[same(at, span, q)]
        for f in _prime_factors(q):
            if not len(at):
                break
            d = q // f
            at = at[~same(at, span + q - d, d)]
        if not len(at):
            continue
        at = at[np.concatenate([[True], at[1:] != at[:-1] + q])]  # one anchor per run
        differ = np.flatnonzero(w[:-q] != w[q:])
        after = np.searchsorted(differ, at)
        start = np.where(after > 0, differ[np.maximum(after - 1, 0)] + 1, 0) if len(differ) else np.zeros(len(at), int)
        end = np.append(differ, n - q)[after] + q
        long = end - start >= max(least, exponent * q)
        found += sorted({(int(s), int(e - s), q) for s, e in zip(start[long], end[long])})
    return sorted(found, key=lambda r: (r[0], r[2]))


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length/period; ties: smallest start, then period."""
    best = None
    for r in sorted(runs, key=lambda r: (r[0], r[2])):
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    return best


def kept_words(n: int, runs: list[Run]) -> np.ndarray:
    """Which words stay when each run is collapsed to its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:n]) == 0


def _run(batches: Iterator[pa.RecordBatch], exponent: int, least: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        for lo, hi in chunks(offsets):
            part = data[offsets[lo]:offsets[hi]]
            words = Words(part, offsets[lo:hi + 1] - offsets[lo], NOT_SPACE)
            runs: dict[int, list[Run]] = {}
            if len(words):
                numbers = word_numbers(words)
                for a, b in split_by_frequency(numbers, words.first, exponent, least):
                    doc = int(words.doc[a])
                    shift = a - int(words.first[doc])
                    found = [(s + shift, n, q) for s, n, q in lag_scan(numbers[a:b], exponent, least)]
                    if found:
                        runs.setdefault(doc, []).extend(found)
            counts = np.diff(words.first)
            texts = []
            for k in range(hi - lo):
                split = part[offsets[lo + k] - offsets[lo]:offsets[lo + k + 1] - offsets[lo]].tobytes().split()
                if k in runs:
                    split = [split[i] for i in np.flatnonzero(kept_words(len(split), runs[k])).tolist()]
                texts.append(b" ".join(split).decode("utf-8", "replace"))
            # segments are in order of place, but runs of one may start before those of another lag
            lists = [sorted(runs.get(k, []), key=lambda r: (r[0], r[2])) for k in range(hi - lo)]
            best = [strongest(r) for r in lists]
            as_row = lambda r: None if r is None else dict(zip(("start", "length", "period"), r))
            kind = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo), pa.array(counts.astype(np.int64)),
                 pa.array([[as_row(r) for r in x] for x in lists], pa.list_(kind)),
                 pa.array([as_row(r) for r in best], kind), pa.array(texts, pa.string())],
                ["id", "n_words", "runs", "strongest", "collapsed"])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """Per document: id, n_words, ``runs`` (start, length, period in words, by start,
    then period), the ``strongest`` run (null: no run) and ``collapsed``: the words
    left when every run keeps its first period only, joined by one space."""
    if exponent < 3 or least < 1:
        raise ValueError("a run has three periods at least")
    pairs = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    schema = T.StructType([pairs.schema["id"], T.StructField("n_words", T.LongType()),
                           T.StructField("runs", T.ArrayType(RUN)), T.StructField("strongest", RUN),
                           T.StructField("collapsed", T.StringType())])
    return map_batches(pairs, lambda batches: _run(batches, exponent, least), schema).withColumnRenamed("id", id_col)


def collapsed(docs: DataFrame, text_col: str = "text", exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """``docs`` with every run of a text collapsed to its first period; a text
    without runs is left as it is."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"), F.col(f"`{text_col}`").alias("t"))
    r = periodic_runs(whole, "d", "t", exponent, least)
    text = F.when(F.size("runs") > 0, F.col("collapsed")).otherwise(F.col("d").getField(text_col))
    return r.select(*[text.alias(c) if c == text_col else F.col("d").getField(c).alias(c) for c in docs.columns])
