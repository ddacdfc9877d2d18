"""Token counts of a unigram tokenizer without making the tokens.

An Aho-Corasick automaton over the vocabulary enumerates all pieces that end at
each character; dynamic programming carries the best score and its piece count.
Ties follow the tokenizer (``tokenizers.models.Unigram``) exactly: at equal
scores the longest last piece wins, and a character that is no piece itself
costs ``lowest score - 10`` and is worth its UTF-8 bytes (byte fallback) or,
without byte pieces, one unknown token for each run of such characters.

White space is ``replace``d by the metaspace and splits a text into segments
that are scored one by one, as the tokenizer's pre-tokenizer does; segments
repeat, so a bounded cache holds their counts.

Scale: one narrow pass; the vocabulary is broadcast and bounded by the
tokenizer.  A segment needs memory in proportion to its own length.

Defined cases: null and empty texts have no tokens and score 0; any id, repeated
rows and other columns are carried or ignored without effect.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import map_batches, once_per_worker

SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_SEGMENTS = 200_000


def read_vocabulary(model_path: str) -> list[tuple[str, float | None]]:
    """(piece, score) by id of a sentencepiece model file.  Control, unknown and
    byte pieces have no score: their names in a text are ordinary text."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
    special = lambda i: sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)
    return [(sp.id_to_piece(i), None if special(i) else sp.get_score(i)) for i in range(sp.get_piece_size())]


class Counter:
    """Best score and piece count of segments under a unigram vocabulary."""

    def __init__(self, vocabulary: list[tuple[str, float | None]]) -> None:
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            if piece and score is not None:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in vocabulary if s is not None), default=0.0) - UNKNOWN_PENALTY
        pieces = {p for p, _ in vocabulary}
        self.byte_fallback = all(f"<0x{b:02X}>" in pieces for b in range(256))
        self.cache: dict[str, tuple[int, float]] = {}

    def segment(self, s: str) -> tuple[int, float]:
        n = len(s)
        best, count, unknown_last = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        done = 0

        def reach(end: int, matches: list[tuple[int, float]]) -> None:
            top = None
            for length, score in matches:  # longest first
                x = best[end - length] + score
                if top is None or x > top:
                    top, pieces, unknown = x, count[end - length] + 1, False
            if not matches or matches[-1][0] != 1:
                x = best[end - 1] + self.unknown
                if top is None or x > top:
                    top, unknown = x, True
                    if self.byte_fallback:
                        pieces = count[end - 1] + len(s[end - 1].encode())
                    else:
                        pieces = count[end - 1] + (not unknown_last[end - 1])
            best[end], count[end], unknown_last[end] = top, pieces, unknown

        here: list[tuple[int, float]] = []
        for last, match in self.automaton.iter(s):
            while done < last:
                done += 1
                reach(done, here)
                here = []
            here.append(match)
        while done < n:
            done += 1
            reach(done, here)
            here = []
        return count[n], best[n]

    def text(self, text: str) -> tuple[int, float]:
        if not text:
            return 0, 0.0
        s = text.replace(" ", SPACE)
        segments = (s[1:] if s[0] == SPACE else s).split(SPACE)
        cache, tokens, total = self.cache, 0, 0.0
        for w in segments:
            hit = cache.get(w)
            if hit is None:
                if len(cache) >= CACHE_SEGMENTS:
                    cache.clear()
                hit = cache[w] = self.segment(SPACE + w)
            tokens += hit[0]
            total += hit[1]
        return tokens, total


def count_tokens(docs: DataFrame, vocabulary: list[tuple[str, float]], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, score (log score of the best path)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = rows.drop("text").schema.add("n_tokens", "long").add("score", "double")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once_per_worker("unigram", shared.value, Counter)
        for b in batches:
            found = [counter.text(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([n for n, _ in found], pa.int64()), pa.array([x for _, x in found], pa.float64())],
                names=schema.names)

    return map_batches(rows, apply, schema)
