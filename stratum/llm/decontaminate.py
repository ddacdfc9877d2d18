"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items form one generalised suffix automaton.  Each
document's words stream through it; the state and the length of the longest
match ending at a word tell which item windows end there.  A window is
``window`` consecutive item words, or all words of a shorter item (coverage of
the whole item); every document word inside an occurrence is hit, and maximal
runs of hit words are the spans to remove.

Scale: documents are never shuffled.  An automaton holds at most
``MAX_AUTOMATON_WORDS`` benchmark words, so what is sent to the executors is
bounded; a larger benchmark is cut into several automata that are applied one
after the other in the same narrow job.

Words that occur in no item end every match, so only runs of known words that
are at least as long as the shortest window walk the automaton.

Defined cases: null or empty texts have no words and no hits; items without
words (or null) have no windows; repeated items count once per item id; a null
item id reads as the empty string; empty tables give empty results; columns
other than the id and the text are ignored by ``scan`` and passed on unchanged,
by position, by ``remove``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbytes as wb
from .store import map_batches

WINDOW = 10
#: words of the items in one automaton (about 50 MB on an executor)
MAX_AUTOMATON_WORDS = 100_000


class SuffixAutomaton:
    """All substrings of several integer sequences."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.len = [0]

    def _state(self, length: int, nxt: dict[int, int], link: int) -> int:
        self.next.append(nxt)
        self.len.append(length)
        self.link.append(link)
        return len(self.len) - 1

    def _split(self, p: int, c: int) -> int:
        """The state for the longest string of p followed by c, made if needed."""
        q = self.next[p][c]
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            if c in self.next[last]:
                last = self._split(last, c)
                continue
            new = self._state(self.len[last] + 1, {}, 0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._split(p, c)
            last = new

    def locate(self, sequence: list[int]) -> int:
        v = 0
        for c in sequence:
            v = self.next[v][c]
        return v


class ItemMatcher:
    """Automaton of some items with the windows that end in its states."""

    def __init__(self, items: list[tuple[str, np.ndarray]], window: int) -> None:
        self.vocabulary = np.unique(np.concatenate([h for _, h in items] or [np.zeros(0, np.uint64)]))
        sequences = [(i, np.searchsorted(self.vocabulary, h).tolist()) for i, h in items]
        self.automaton = a = SuffixAutomaton()
        for s in {tuple(s) for _, s in sequences}:
            a.add(list(s))
        # windows by state: (length, item ids)
        own: dict[int, dict[int, set[str]]] = {}
        for item, s in sequences:
            k = min(window, len(s))
            for i in range(len(s) - k + 1):
                own.setdefault(a.locate(s[i:i + k]), {}).setdefault(k, set()).add(item)
        self.shortest = min((k for marks in own.values() for k in marks), default=0)
        # every state also ends the windows of its suffixes
        self.marks: list[list[tuple[int, frozenset[str]]]] = [[] for _ in a.len]
        for v in sorted(range(len(a.len)), key=a.len.__getitem__):
            self.marks[v] = sorted((k, frozenset(x)) for k, x in own.get(v, {}).items())
            if v:
                self.marks[v] = self.marks[v] + self.marks[a.link[v]]

    def find(self, hashes: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int, frozenset[str]]]:
        """(first word, word after the last, items) of each window occurrence."""
        if not self.shortest or not len(hashes):
            return
        at = np.searchsorted(self.vocabulary, hashes)
        at[at == len(self.vocabulary)] = 0
        known = self.vocabulary[at] == hashes
        cut = np.zeros(len(hashes) + 1, dtype=bool)
        cut[first] = True
        before = np.concatenate(([False], known[:-1]))
        after = np.concatenate((known[1:], [False]))
        begins = np.flatnonzero(known & (~before | cut[:-1]))
        ends = np.flatnonzero(known & (~after | cut[1:])) + 1
        long_enough = ends - begins >= self.shortest
        nxt, link, length, marks = (self.automaton.next, self.automaton.link, self.automaton.len, self.marks)
        for b, e in zip(begins[long_enough].tolist(), ends[long_enough].tolist()):
            v = matched = 0
            for i, c in enumerate(at[b:e].tolist(), b + 1):
                while v and c not in nxt[v]:
                    v = link[v]
                    matched = length[v]
                if c in nxt[v]:
                    v = nxt[v][c]
                    matched += 1
                for k, items in marks[v]:
                    if k <= matched:
                        yield i - k, i, items


def _item_parts(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[str, np.ndarray]]]:
    """Items in parts of at most MAX_AUTOMATON_WORDS words (one item at least)."""
    part: list[tuple[str, np.ndarray]] = []
    held = 0
    rows = benchmark.select(F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
                            F.coalesce(F.col(text_col), F.lit("")).alias("words")).distinct()
    for row in rows.toLocalIterator():
        data, offsets = wb.text_buffer(pa.array([row["words"]], pa.string()))
        h = wb.Words(data, offsets, wb.ALNUM, wb.LOWER).hashes()
        if not len(h):
            continue
        if part and held + len(h) > MAX_AUTOMATON_WORDS:
            yield part
            part, held = [], 0
        part.append((row["item"], h))
        held += len(h)
    if part:
        yield part


def matchers(benchmark: DataFrame, window: int = WINDOW, item_col: str = "item_id",
             text_col: str = "text") -> list[Broadcast]:
    """Broadcast matchers of the benchmark, each of bounded size."""
    sc = benchmark.sparkSession.sparkContext
    return [sc.broadcast(ItemMatcher(p, window)) for p in _item_parts(benchmark, item_col, text_col)]


_FOUND = "array<struct<first:int,last:int,items:array<string>>>"
_FOUND_ARROW = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("items", pa.list_(pa.string()))]))


def _scan_batch(column: pa.Array, matcher: ItemMatcher | None) -> tuple[np.ndarray, list[list[dict]]]:
    """Word counts and, by document, hit runs [first, last) with their items."""
    data, offsets = wb.text_buffer(column)
    n_words, found = [], []
    for lo, hi in wb.chunks(offsets):
        w = wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.ALNUM, wb.LOWER)
        n_words.append(np.diff(w.first))
        by_doc: list[list[dict]] = [[] for _ in range(lo, hi)]
        for b, e, items in matcher.find(w.hashes(), w.first) if matcher else ():
            d = int(w.doc[b])
            b, e = b - int(w.first[d]), e - int(w.first[d])
            spans = by_doc[d]
            while spans and spans[-1]["last"] >= b:  # overlapping or touching: one run
                old = spans.pop()
                b, e, items = min(b, old["first"]), max(e, old["last"]), items | old["items"]
            spans.append({"first": b, "last": e, "items": items})
        found += by_doc
    return np.concatenate(n_words) if n_words else np.zeros(0, np.int64), found


def scan(docs: DataFrame, parts: list[Broadcast], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, found): the runs of words hit, [first, last), by document.

    One row per input row, in one narrow pass per automaton.  Runs of different
    automata may overlap; ``hit_runs`` merges them.
    """
    out = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                      F.lit(0).cast("long").alias("n_words"), F.array().cast(_FOUND).alias("found"))
    schema = out.schema
    def one(part: Broadcast | None):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = part.value if part is not None else None
            for b in batches:
                n_words, found = _scan_batch(b.column(1), matcher)
                merged = [(old or []) + [{**s, "items": sorted(s["items"])} for s in new]
                          for old, new in zip(b.column(3).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(merged, _FOUND_ARROW)],
                    names=["doc_id", "text", "n_words", "found"])
        return apply

    for part in parts or [None]:
        out = map_batches(out, one(part), schema)
    return out.drop("text")


def hit_words(found: F.Column) -> F.Column:
    """Number of distinct words in runs that may overlap."""
    runs = F.array_sort(F.transform(found, lambda r: F.struct(r["first"].alias("b"), r["last"].alias("e"))))
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("upto"))
    return F.aggregate(runs, start, lambda a, r: F.struct(
        (a["n"] + F.greatest(F.lit(0), r["e"] - F.greatest(r["b"], a["upto"]))).cast("long").alias("n"),
        F.greatest(a["upto"], r["e"]).alias("upto")), lambda a: a["n"])


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, **cols: str) -> DataFrame:
    """Per document: n_words, n_hit, items (sorted ids), contaminated, found."""
    s = scan(docs, matchers(benchmark, window), **cols)
    return s.select("doc_id", "n_words", hit_words(F.col("found")).alias("n_hit"),
                    F.array_sort(F.array_distinct(F.flatten(F.col("found.items")))).alias("items"),
                    (F.size("found") > 0).alias("contaminated"), "found")


def remove(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents with every hit span cut out of the text.

    Same columns and rows as the input; a document without hits keeps its text
    byte for byte, a null text stays null.  Words on both sides of a cut stay
    apart: the white space around a span is not removed.
    """
    plain: T.StructType = docs.schema
    at, hits = docs.columns.index(text_col), "_hits"
    while hits in docs.columns:
        hits += "_"
    out = docs.withColumn(hits, F.array().cast(_FOUND))

    def one(part: Broadcast):
        def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                _, found = _scan_batch(b.column(at), part.value)
                merged = [old + [{**s, "items": []} for s in new]
                          for old, new in zip(b.column(len(plain)).to_pylist(), found)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(merged, _FOUND_ARROW)], names=b.schema.names)
        return apply

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, columns = b.column(len(plain)).to_pylist(), list(b.columns[:-1])
            if any(found):
                texts = columns[at].to_pylist()
                columns[at] = pa.array([_cut(t, sorted(r, key=lambda x: x["first"])) if r else t
                                        for t, r in zip(texts, found)], columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names[:-1])

    for part in matchers(benchmark, window, item_col, item_text_col):
        out = map_batches(out, one(part), out.schema)
    return map_batches(out, cut, plain)


def _cut(text: str, runs: list[dict]) -> str:
    raw = text.encode()
    data, offsets = wb.text_buffer(pa.array([text], pa.large_string()))
    w = wb.Words(data, offsets, wb.ALNUM, wb.LOWER)
    kept, at = [], 0
    for r in runs:
        kept.append(raw[at:int(w.start[r["first"]])])
        at = max(at, int(w.end[r["last"] - 1]))
    kept.append(raw[at:])
    return b"".join(kept).decode()
