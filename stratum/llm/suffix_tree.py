"""Language-model scores from a probabilistic suffix tree over words.

The symbols are the lower-cased words of a text and one end symbol; words that
make up less than ``HEAD_SHARE`` of the corpus share one symbol, within which a
word keeps its base probability.  A context is the empty one, the word before
(or the text's begin), or the two words before.  One-word contexts are
candidates from ``MIN_COUNT`` training positions on; two-word contexts if they
are hot as well (``HOT_SHARE`` of all positions).  A candidate is retained if its
smoothed next-symbol distribution diverges from that of its suffix by at least
``MIN_DIVERGENCE`` nats over its training positions (Kullback-Leibler), or if a
longer context that ends with it is retained.  Next symbols seen once in a
context give their mass to the suffix:  with ``once`` such positions,
``P(x | s) = c(s x) / (c(s) + w) + (w + once) / (c(s) + w) * P(x | suffix of s)``,
the first term only if ``c(s x) > 1``.  A position is scored in the longest
retained suffix of what stands before it.

``base`` scores are additively smoothed word frequencies; the tree's root is the
same distribution, so both are probabilities of the same tokens.

Scale: one pass counts words, one pairs, one the triples behind hot pairs, each
with partial sums in its tasks.  Every occurrence of a context is followed by one
token, so its total is known from the count of its words, and only edges seen more
than once are kept; ``once`` is what they leave.  The tree is a stored table of
edges that grows with the corpus.  As the logarithm of a position is a sum of what
its contexts and its edges give, a text needs no more than its keys: what contexts
and hot edges give (at most ``1 / HOT_SHARE`` of each length) and the symbols
(``1 / HEAD_SHARE``) are sent to the workers, all other edges and words, none of
which is hot, come by a join on the key alone.  A filter of fixed size keeps most
keys that are no edge out of it.  No text is shuffled, and the shuffle files of a
step are removed once it is stored.  Words are compared by one 64-bit hash.

Defined cases: null and empty texts are one end symbol; a null id counts as the
empty string when documents are held out; without any training document every
token has probability 1, as in the base formula; repeated rows count each time;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import wordbytes as wb
from .store import map_batches, shuffles_removed, stored

MIN_COUNT = 4
MIN_DIVERGENCE = 0.01
SMOOTHING = 1.0
HEAD_SHARE = HOT_SHARE = 5e-7
#: bits of the filter that spares keys of no edge the join; a full one spares none and changes no result
FILTER_BITS = 1 << 27
BASE_COUNT = 0.1
FOLDS = 10

#: symbols have 21 bits, so that three fit a long; 1 / HEAD_SHARE words and two more are fewer
_BITS = 21
_RARE, _END = 0, 1  # every other symbol is a head word's place + 2; _END is the text's begin, too
_OWN = (1 << _BITS) - 1
_PAIR = (1 << 2 * _BITS) - 1
_CHUNK = 1 << 18  # bytes of text worked on at once, few enough for the processor's cache
_COUNTED = 1 << 22  # keys counted before they leave a task
_ROW_KEYS = 1 << 16  # keys of a text in one row


class Index(NamedTuple):
    """Distinct keys, found by the first bits of their mixed value (``wb.mix`` is one to one)."""

    mixed: np.ndarray
    start: np.ndarray

    @staticmethod
    def of(keys: np.ndarray) -> tuple[Index, np.ndarray]:
        """(index, the order in which it holds the keys)."""
        mixed = wb.mix(keys.view(np.uint64))
        order = np.argsort(mixed)
        bits = max(len(keys), 2).bit_length()
        start = np.searchsorted(mixed[order] >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))
        return Index(mixed[order], start.astype(np.int32)), order

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, found) of each wanted key; the place of one not found is any."""
        if not len(self.mixed):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        mixed = wb.mix(wanted.view(np.uint64))
        bucket = (mixed >> np.uint64(65 - len(self.start).bit_length())).view(np.int64)
        at = np.minimum(self.start[bucket].astype(np.int64), len(self.mixed) - 1)
        end = self.start[bucket + 1]
        found = self.mixed[at] == mixed
        left = np.flatnonzero(~found & (at + 1 < end))
        while len(left):
            at[left] += 1
            found[left] = self.mixed[at[left]] == mixed[left]
            left = left[~found[left] & (at[left] + 1 < end[left])]
        return at, found


class Head(NamedTuple):
    """Frequent words by hash: their counts, and the root's logarithm of every symbol."""

    index: Index
    counts: np.ndarray
    root: np.ndarray

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbol of each word, whether it is a head word)."""
        at, hit = self.index.find(hashes)
        return np.where(hit, at + 2, _RARE), hit


def _words(column: pa.Array) -> Iterator[tuple[int, int, wb.Words]]:
    data, offsets = wb.text_buffer(column)
    for lo, hi in wb.chunks(offsets, _CHUNK):
        yield lo, hi, wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.NOT_SPACE, wb.LOWER)


def keys(w: wb.Words, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair key, context key) of every token of the documents' words.

    The pair key holds the symbol before and the token's own; the context key the
    two symbols before.  Keys are -1 where there is no such context: behind a rare
    word, and for the longer one at a text's first token."""
    n = len(w.offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(w.first) + 1)
    own = np.full(len(doc), _END, np.int64)
    own[np.arange(len(symbol)) + w.doc] = symbol
    begin = w.first[:-1] + np.arange(n)
    one = np.concatenate(([_END], own[:-1]))  # the end before is this text's begin
    two = np.concatenate(([_END], one[:-1]))
    two[begin] = _RARE
    pair = np.where(one == _RARE, -1, one << _BITS | own)
    context = np.where((one == _RARE) | (two == _RARE), -1, two << _BITS | one)
    return doc, pair, context


def _counted(train: DataFrame, of: Callable[[wb.Words], np.ndarray]) -> DataFrame:
    """(key, n) of the keys that ``of`` makes of the documents' words."""

    def counts(found: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(found), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64())], names=["key", "n"])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for b in batches:
            for _, _, w in _words(b.column(0)):
                found.append(of(w))
                size += len(found[-1])
                if size >= _COUNTED:
                    yield counts(found)
                    found, size = [], 0
        if found:
            yield counts(found)

    return map_batches(train.select("text"), apply, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))


class Level(NamedTuple):
    """Contexts of one length by place: how often each was seen, how often before a
    symbol seen once there, and the share of its suffix."""

    total: np.ndarray
    once: np.ndarray
    share: np.ndarray

    @staticmethod
    def of(total: np.ndarray, repeated: np.ndarray) -> Level:
        """``repeated``: positions of each context before a symbol seen more than once there."""
        once = total - repeated
        return Level(total, once, (once + SMOOTHING) / (total + SMOOTHING))

    def p(self, at: np.ndarray, n: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Probability of a symbol seen ``n`` times in its context, ``q`` being the suffix's."""
        return n / (self.total[at] + SMOOTHING) + self.share[at] * q

    def passed(self, gain: np.ndarray) -> np.ndarray:
        """The divergence test."""
        return (self.total >= MIN_COUNT) & (gain + self.once * np.log(self.share) >= MIN_DIVERGENCE * self.total)


def _by_context(edges: DataFrame, what: F.Column, places: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Sum of ``what`` over the edges of every context, by its place.  There are at
    most ``1 / HEAD_SHARE`` or ``1 / HOT_SHARE`` contexts."""
    sums = edges.select(F.expr(f"shiftright(key, {_BITS})").alias("context"), what.alias("x")).groupBy("context").agg(F.sum("x").alias("x"))
    found = sums.toArrow()
    x = found.column("x").to_numpy()
    out = np.zeros(size, x.dtype)
    out[places(found.column("context").to_numpy())] = x
    return out


def _mapped(df: DataFrame, fn: Callable[..., Iterable[np.ndarray]], schema: str) -> DataFrame:
    """``fn`` of the columns as arrays, a batch at a time."""
    names = [c.split()[0] for c in schema.split(", ")]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in fn(*[c.to_numpy() for c in b.columns])], names=names)

    return map_batches(df, apply, schema)


class Tree(NamedTuple):
    """``back``, ``kept``: of one-word contexts by symbol (the last is of none); ``longer``:
    retained two-word contexts, with ``backs``; ``edges``: (key, delta, n) of all retained contexts."""

    kept: np.ndarray
    back: np.ndarray
    longer: Index
    backs: np.ndarray
    edges: DataFrame


def grow(train: DataFrame, head, n_train: int, positions: int) -> Tree:
    """The tree of the training texts; ``head`` is the broadcast ``Head``."""
    spark = train.sparkSession
    sent = spark.sparkContext.broadcast
    gained = F.col("n") * F.col("ratio")

    def pairs(w: wb.Words) -> np.ndarray:
        pair = keys(w, head.value.find(wb.signed(w.hashes()))[0])[1]
        return pair[pair >= 0]

    one = stored(_counted(train, pairs).filter("n > 1"), "pairs")
    total = np.concatenate(([0, n_train], head.value.counts))  # of a symbol as context
    size = len(total)
    level1 = Level.of(total, _by_context(one, F.col("n"), lambda c: c, size))
    first = sent(level1)

    def short(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, the suffix's) of one-word contexts' edges."""
        q = np.exp(head.value.root[key & _OWN])
        return first.value.p(key >> _BITS, n, q), q

    def ratios1(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        p, q = short(key, n)
        return key, n, np.log(p / q)

    edge = "key long, n long, ratio double"
    edges1 = _mapped(one, ratios1, edge)
    passed1 = level1.passed(_by_context(edges1, gained, lambda c: c, size))

    hot = max(HOT_SHARE * positions, MIN_COUNT)
    found = one.filter((F.col("n") >= hot) & (F.expr(f"key & {_OWN}") > _END)).toArrow()
    hot_keys = found.column("key").to_numpy()
    index, order = Index.of(hot_keys)
    hot_keys, total = hot_keys[order], found.column("n").to_numpy()[order]
    hot_pairs = sent(index)

    def triples(w: wb.Words) -> np.ndarray:
        _, pair, context = keys(w, head.value.find(wb.signed(w.hashes()))[0])
        here = np.flatnonzero(context >= 0)
        here = here[hot_pairs.value.find(context[here])[1]]
        return context[here] << _BITS | pair[here] & _OWN

    two = stored(_counted(train, triples).filter("n > 1"), "triples")
    places = lambda c: index.find(c)[0]
    level2 = Level.of(total, _by_context(two, F.col("n"), places, len(total)))
    second = sent(level2)

    def ratios2(key: np.ndarray, n: np.ndarray, pair: np.ndarray, n_pair: np.ndarray) -> tuple[np.ndarray, ...]:
        q = short(pair, n_pair)[0]
        p = second.value.p(hot_pairs.value.find(key >> _BITS)[0], n, q)
        return key, n, np.log(p / q)

    suffix = one.select(F.col("key").alias("pair"), F.col("n").alias("n_pair"))
    suffixed = two.withColumn("pair", F.expr(f"key & {_PAIR}L")).join(suffix, "pair").select("key", "n", "pair", "n_pair")
    edges2 = stored(_mapped(suffixed, ratios2, edge), "edges")
    passed2 = level2.passed(_by_context(edges2, gained, places, len(total)))

    kept = np.append(passed1, False)
    kept[hot_keys[passed2] & _OWN] = True
    back = np.zeros(size + 1)
    back[kept] = np.log(level1.share[kept[:-1]])
    longer, order = Index.of(hot_keys[passed2])
    backs = np.log(level2.share[passed2])[order]
    of_tree = sent((kept, back, longer, backs))

    def deltas1(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
        kept, back, _, _ = of_tree.value
        inside = kept[key >> _BITS]
        key, n = key[inside], n[inside]
        return key, ratios1(key, n)[2] - back[key >> _BITS], n

    def deltas2(key: np.ndarray, n: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, ...]:
        _, _, longer, backs = of_tree.value
        at, inside = longer.find(key >> _BITS)
        return key[inside], ratio[inside] - backs[at[inside]], n[inside]

    schema = "key long, delta double, n long"
    return Tree(kept, back, longer, backs, stored(_mapped(one, deltas1, schema).unionByName(_mapped(edges2, deltas2, schema)), "tree"))


def _slots(keys: np.ndarray) -> np.ndarray:
    """Place of each key's bit in the filter."""
    return (wb.mix(keys.view(np.uint64)) & np.uint64(FILTER_BITS - 1)).view(np.int64)


def _bit(slot: np.ndarray) -> np.ndarray:
    return np.int64(1) << (slot & 63)


def edge_filter(edges: DataFrame) -> np.ndarray:
    """One bit for each edge's key, ``FILTER_BITS`` in all whatever the tree's size."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(FILTER_BITS >> 6, np.int64)
        for b in batches:
            slot = np.sort(_slots(b.column(0).to_numpy()))
            at = slot >> 6
            first = np.flatnonzero(np.diff(at, prepend=-1))
            if len(first):
                words[at[first]] |= np.bitwise_or.reduceat(_bit(slot), first)
        used = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(words[used])], names=["word", "bits"])

    parts = map_batches(edges.select("key"), bits, "word int, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    found = parts.toArrow()
    out = np.zeros(FILTER_BITS >> 6, np.int64)
    out[found.column("word").to_numpy()] = found.column("bits").to_numpy()
    return out


def _id_text(id_col: str) -> F.Column:
    return F.coalesce(F.col(id_col).cast("string"), F.lit(""))


def scores(docs: DataFrame, folds: int = FOLDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score.  Documents with ``crc32(id) % folds = 0`` are held out of
    training."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       (F.crc32(_id_text(id_col).cast("binary")) % folds == 0).alias("held_out"),
                       F.col(text_col).alias("text"))
    train = rows.filter("NOT held_out")
    with shuffles_removed(spark):
        words = stored(_counted(train, lambda w: wb.signed(w.hashes())), "words")
        n_words, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        n_train = train.count()
        total, vocabulary = n_words + n_train, distinct + (n_train > 0)
        mass = total + BASE_COUNT * (vocabulary + 1)
        unit = np.log10(mass)
        end = float(np.log10(n_train + BASE_COUNT))

        found = words.filter(F.col("n") >= max(HEAD_SHARE * total, 1)).toArrow()
        index, order = Index.of(found.column("key").to_numpy())
        n = found.column("n").to_numpy()[order]
        p = np.concatenate(([0, n_train + BASE_COUNT], n + BASE_COUNT)) / mass
        p[_RARE] = max((mass - (n + BASE_COUNT).sum() - n_train - BASE_COUNT) / mass, BASE_COUNT / mass)
        head = spark.sparkContext.broadcast(Head(index, n, np.log(p)))

        tree = grow(train, head, n_train, total)
        hot = tree.edges.filter(F.col("n") >= max(HOT_SHARE * total, 1)).select("key", "delta").toArrow()
        index, order = Index.of(hot.column("key").to_numpy())
        hot_edges = (index, hot.column("delta").to_numpy()[order])
        known_tree = spark.sparkContext.broadcast((tree._replace(edges=None), hot_edges, edge_filter(tree.edges)))

    summary = (rows.drop("text").schema.add("n_words", "long").add("head_known", "long").add("head_score", "double")
               .add("gain", "double"))
    schema = (T.StructType().add("row", "long").add("doc", summary).add("keys", T.ArrayType(T.LongType()))
              .add("tfs", T.ArrayType(T.IntegerType())))

    def bag(row: int, doc: np.ndarray, uniq: np.ndarray, rank: np.ndarray, sign: int, shape: pa.DataType) -> pa.RecordBatch:
        """The distinct keys ``uniq[rank]`` of each document, with ``sign`` times how often they occur."""
        bits = len(uniq).bit_length()
        each = np.sort(doc << bits | rank)
        first = np.flatnonzero(np.diff(each, prepend=-1))
        tf = sign * np.diff(np.append(first, len(each)))
        each = each[first]
        doc = each >> bits
        cut = np.union1d(np.flatnonzero(np.diff(doc, prepend=-1)), np.arange(0, len(doc), _ROW_KEYS))
        offsets = pa.array(np.append(cut, len(doc)), pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array(row + doc[cut]), pa.nulls(len(cut), shape),
             pa.ListArray.from_arrays(offsets, pa.array(uniq[each & ((1 << bits) - 1)])),
             pa.ListArray.from_arrays(offsets, pa.array(tf, pa.int32()))], names=schema.names)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (hot_index, deltas), edges = known_tree.value
        logs = np.log10(head.value.counts + BASE_COUNT)
        row = TaskContext.get().partitionId() << 33
        for b in batches:
            for lo, hi, w in _words(b.column(2)):
                n = hi - lo
                h = wb.signed(w.hashes())
                symbol, hit = head.value.find(h)
                base = np.bincount(w.doc[hit], weights=logs[symbol[hit] - 2], minlength=n) if hit.any() else np.zeros(n)
                doc, pair, context = keys(w, symbol)
                gain, bags = np.zeros(n), [(w.doc[~hit], *np.unique(h[~hit], return_inverse=True), -1)]
                state = np.where(pair < 0, -1, pair >> _BITS)
                short = np.flatnonzero(tree.kept[state])
                here = np.flatnonzero(context >= 0)
                at, inside = tree.longer.find(context[here])
                long = here[inside]
                for where, back, key in ((short, tree.back[state[short]], pair[short]),
                                         (long, tree.backs[at[inside]], context[long] << _BITS | pair[long] & _OWN)):
                    if not len(where):
                        continue
                    d = doc[where]
                    uniq, rank = np.unique(key, return_inverse=True)
                    at, is_hot = hot_index.find(uniq)
                    delta = np.where(is_hot, deltas[at], 0.0) if len(deltas) else np.zeros(len(uniq))
                    gain += np.bincount(d, weights=back + delta[rank], minlength=n)
                    slot = _slots(uniq)
                    ship = (~is_hot & (edges[slot >> 6] & _bit(slot) != 0))[rank]
                    bags.append((d[ship], uniq, rank[ship], 1))
                known = np.bincount(w.doc[hit], minlength=n)
                docs = pa.StructArray.from_arrays(
                    [b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(np.diff(w.first), pa.int64()),
                     pa.array(known, pa.int64()), pa.array(base, pa.float64()), pa.array(gain, pa.float64())], names=summary.names)
                at = pa.array(row + np.arange(n))
                one_each = pa.array(np.arange(n + 1), pa.int32())
                # a document's own row has its number as key, so that these rows spread
                yield pa.RecordBatch.from_arrays([at, docs, pa.ListArray.from_arrays(one_each, at),
                                                  pa.ListArray.from_arrays(one_each, pa.array(np.zeros(n, np.int32)))], names=schema.names)
                for d, uniq, rank, sign in bags:
                    if len(d):
                        yield bag(row, d, uniq, rank, sign, docs.type)
                row += n

    found = map_batches(rows.select("doc_id", "held_out", "text"), apply, schema)
    # tf is over 0 for edges, under 0 for words, 0 for a document itself
    found = found.select("row", "doc", "tfs", F.posexplode("keys").alias("at", "key")).select(
        "row", "doc", "key", F.get("tfs", F.col("at")).alias("tf"))
    values = (words.select(F.lit(-1).alias("sign"), "key", F.log10(F.col("n") + BASE_COUNT).alias("value"))
              .unionByName(tree.edges.select(F.lit(1).alias("sign"), "key", F.col("delta").alias("value"))))
    values = values.withColumnRenamed("key", "of")
    tf, value = F.col("tf"), F.col("value")
    # joined and sorted by one long; the sign tells a word's hash from an equal key of an edge
    joined = found.join(values, (F.col("key") == F.col("of")) & (tf * F.col("sign") > 0), "left")
    per_row = joined.groupBy("row").agg(
        *[F.max(f"doc.{c}").alias(c) for c in summary.names],
        F.sum(F.when((tf < 0) & value.isNotNull(), -tf).otherwise(0)).alias("tail_known"),
        F.sum(F.when(tf < 0, -tf * F.coalesce(value, F.lit(float(np.log10(BASE_COUNT))))).otherwise(0.0)).alias("tail_score"),
        F.sum(F.when(tf > 0, tf * F.coalesce(value, F.lit(0.0))).otherwise(0.0)).alias("more"))
    n_tokens = F.col("n_words") + 1
    end_known = 1 if n_train else 0
    base = F.col("head_score") + F.col("tail_score") + end - n_tokens * float(unit)
    return per_row.select(
        "doc_id", "held_out", n_tokens.alias("n_tokens"), (F.col("head_known") + F.col("tail_known") + end_known).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + (F.col("gain") + F.col("more")) / float(np.log(10))).alias("score"))
