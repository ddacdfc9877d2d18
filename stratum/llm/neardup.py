"""Near-duplicate documents with SetSketch registers.

A document is its set of distinct word shingles.  SetSketch gives every
element exponentially spaced values over the registers in a random order; a
register keeps the minimum, stored as a truncated logarithm.  Registers of a
union are the maxima of the parts' registers, so sketches merge, and equal
registers are about as likely as two sets are similar.

1. Sketch every document in one narrow pass; documents with equal sets (128-bit
   fingerprint of the set) become one node.
2. Band the registers.  In each bucket the most central node (most bucket
   mates) is the hub; each other node is paired with it.
3. Estimate the similarity of each pair jointly: the likelihood of the counts
   of larger, smaller and equal registers given both set sizes.  Pairs whose
   estimate is ``MARGIN`` below the threshold are dropped (six deviations).
4. Verify each node's best pair on the full sets, contract the components, and
   verify the hub pairs that still join two of them.
5. The bucket mates that are still apart are searched exactly.  Members of
   buckets whose largest part is the same component form a neighbourhood.  In it
   a shingle is rare (in fewer than ``RARE`` sets) or common.  Two sets that may
   be linked either share a rare shingle, or their common shingles alone suffice
   for the threshold.  Of the latter only counts are compared, by ``KINDS`` of
   shingles: two sets share no more of a kind than either has.  Mates that pass
   are estimated, bounded by their truncated hashes (which can only overcount
   what is shared) and verified.  So no banded pair is left undecided.

The chance that a pair at the threshold shares no band is
``(1 - 0.8**4)**32 < 5e-8``.

Scale: hub pairs are linear in a bucket; no bucket, neighbourhood or component
is collected anywhere.  In a neighbourhood the counts of the sets outside its
largest part, as far as their common shingles suffice, meet those of all others
that do; sets are fetched for the pairs that pass.  Texts move once, and
only to reach their sets; sets move only for pairs that are verified.

Defined cases: null and empty texts have the empty set and link with nothing;
fewer words than a shingle make one shingle of the whole sequence; repeated
rows are equal sets; null ids are allowed (a component's id is the smallest
non-null one); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import wordbytes as wb
from .components import components
from .store import counted, few_files, map_batches, stored

THRESHOLD = (4, 5)
BANDS, ROWS = 32, 4
REGISTERS = BANDS * ROWS
#: register base and rate of the sketch: 16 bits hold sets up to 1e18
SKETCH_BASE, SKETCH_RATE = 1.001, 20.0
#: pairs estimated this far below the threshold are not verified
MARGIN = 0.21
#: a shingle in fewer sets of a neighbourhood than this is rare
RARE = 16
#: kinds of shingles by which the common ones of two sets are bounded
KINDS = 32
#: rows with a text or set that are worth a task; a step that looks up sets reads
#: those of all nodes, however few its pairs are
SET_ROWS = 4096
#: sets below this size are bounded by 16 bits of each hash, others by 32
SHORT = 2048


def shingle_sets(w: wb.Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every distinct shingle, sorted."""
    h = w.hashes()
    counts = np.diff(w.first)
    start = wb.windows(w.first, size)
    end = start + size
    doc = w.doc[start] if len(start) else start
    short = np.flatnonzero((counts > 0) & (counts < size))
    start = np.concatenate([start, w.first[:-1][short]])
    end = np.concatenate([end, w.first[1:][short]])
    doc = np.concatenate([doc, short])
    g = wb.range_hash(h, start, end)
    order = np.lexsort((g, doc))
    doc, g = doc[order], g[order]
    new = np.ones(len(g), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (g[1:] != g[:-1])
    return doc[new], g[new]


def sketch(doc: np.ndarray, g: np.ndarray, n_docs: int) -> np.ndarray:
    """Registers (n_docs, REGISTERS) of the sets in ``shingle_sets`` form."""
    low = np.full(n_docs * REGISTERS, np.inf)
    seed = wb.mix(g ^ np.uint64(0x5851F42D4C957F2D))
    offset = (seed & np.uint64(REGISTERS - 1)).astype(np.int64)
    step = ((seed >> np.uint64(20)) & np.uint64(REGISTERS - 1)).astype(np.int64) | 1
    value, at = np.zeros(len(g)), doc * REGISTERS
    for j in range(REGISTERS):
        if not len(at):
            break
        bits = wb.mix(seed + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) >> np.uint64(11)
        value = value - np.log((bits.astype(np.float64) + 1) * 2.0 ** -53) / (SKETCH_RATE * (REGISTERS - j))
        np.minimum.at(low, at + ((offset + step * j) & (REGISTERS - 1)), value)
        worst = low.reshape(n_docs, REGISTERS).max(axis=1)
        on = value < worst[at // REGISTERS]
        seed, offset, step, value, at = seed[on], offset[on], step[on], value[on], at[on]
    with np.errstate(divide="ignore"):
        k = np.floor(1 - np.log(low) / np.log(SKETCH_BASE))
    return np.clip(k, 0, 65535).astype("<u2").reshape(n_docs, REGISTERS)


def similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity from registers (n, m) and set sizes."""
    more, less = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = a.shape[1] - more - less
    u = n_a / (n_a + n_b)
    v = 1 - u
    shrink = (SKETCH_BASE - 1) / SKETCH_BASE

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * shrink) / np.log(SKETCH_BASE)

    def likelihood(j: np.ndarray) -> np.ndarray:
        up, down = p(u - v * j), p(v - u * j)
        tiny = 1e-300
        return (more * np.log(np.maximum(up, tiny)) + less * np.log(np.maximum(down, tiny))
                + same * np.log(np.maximum(1 - up - down, tiny)))

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    for _ in range(40):  # the likelihood is concave: ternary search
        x, y = lo + (hi - lo) / 3, hi - (hi - lo) / 3
        right = likelihood(x) < likelihood(y)
        lo, hi = np.where(right, x, lo), np.where(right, hi, y)
    return (lo + hi) / 2


def sketched(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, n_shingles, f0, f1, registers) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_key"),
                       F.col(text_col).alias("text"))
    schema = (rows.drop("text").schema.add("n_shingles", "long").add("f0", "long").add("f1", "long")
              .add("registers", "binary"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = wb.text_buffer(b.column(2))
            for lo, hi in wb.chunks(offsets):
                n = hi - lo
                w = wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.NOT_SPACE, wb.LOWER)
                doc, g = shingle_sets(w, shingle)
                size = np.bincount(doc, minlength=n)
                prints = []
                for salt in (0x2545F4914F6CDD1D, 0x9FB21C651E98DF25):
                    sums = np.concatenate(([np.uint64(0)], np.cumsum(wb.mix(g ^ np.uint64(salt)), dtype=np.uint64)))
                    ends = np.cumsum(size)
                    prints.append(wb.signed(sums[ends] - sums[ends - size]))
                registers = sketch(doc, g, n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, n), b.column(1).slice(lo, n), pa.array(size, pa.int64()),
                     pa.array(prints[0]), pa.array(prints[1]), pa.array([r.tobytes() for r in registers], pa.binary())],
                    names=schema.names)

    return map_batches(rows, apply, schema)


def _sets(texts: DataFrame, shingle: int) -> DataFrame:
    """(node, items): sorted 64-bit shingle hashes of each (node, text) row."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, offsets = wb.text_buffer(b.column(1))
            for lo, hi in wb.chunks(offsets):
                w = wb.Words(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], wb.NOT_SPACE, wb.LOWER)
                doc, g = shingle_sets(w, shingle)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo),
                     pa.array([g[cut[i]:cut[i + 1]].tobytes() for i in range(hi - lo)], pa.binary())],
                    names=["node", "items"])

    return map_batches(texts.select("node", "text"), apply, "node long, items binary")


def _bounds(sets: DataFrame) -> DataFrame:
    """(node, items): the sets with 16 or 32 bits left of each hash."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cut = []
            for x in b.column(1):
                g = np.frombuffer(x.as_buffer(), np.uint64)
                cut.append(((g >> np.uint64(48)).astype("<u2") if len(g) < SHORT else (g >> np.uint64(32)).astype("<u4")).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cut, pa.binary())], names=["node", "items"])

    return map_batches(sets.select("node", "items"), apply, "node long, items binary")


def _incidences(sets: DataFrame) -> DataFrame:
    """(node, shingle) of every set element."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            items = [np.frombuffer(x.as_buffer(), np.int64) for x in b.column(1)]
            node = np.repeat(b.column(0).to_numpy(), [len(g) for g in items])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate([*items, np.zeros(0, np.int64)]))],
                                             names=["node", "shingle"])

    return map_batches(sets.select("node", "items"), apply, "node long, shingle long")


def _estimated(pairs: DataFrame, nodes: DataFrame, mates: bool = True) -> DataFrame:
    """Pairs (a, b, similarity) that may reach the threshold; without ``mates``
    it is not known that they share a bucket, and those that do not are left out."""
    num, den = THRESHOLD
    side = nodes.select("node", "n_shingles", "registers")
    rows = pairs
    for s in ("a", "b"):
        rows = rows.join(side.select(F.col("node").alias(s), F.col("n_shingles").alias(f"n_{s}"),
                                     F.col("registers").alias(f"r_{s}")), s)
        if s == "b":  # the smaller set alone bounds the similarity
            rows = rows.filter(den * F.least("n_a", "n_b") >= num * F.greatest("n_a", "n_b"))
    if not mates:
        rows = rows.filter(F.arrays_overlap(_keys("r_a"), _keys("r_b")))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                x = batch.slice(lo, 4096)
                regs = [np.frombuffer(b"".join(x.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS) for c in (4, 5)]
                j = similarity(*regs, x.column(2).to_numpy().astype(float), x.column(3).to_numpy().astype(float))
                yield pa.RecordBatch.from_arrays([x.column(0), x.column(1), pa.array(j)],
                                                 names=["a", "b", "similarity"]).filter(pa.array(j >= num / den - MARGIN))

    return map_batches(rows.select("a", "b", "n_a", "n_b", "r_a", "r_b"), apply, "a long, b long, similarity double")


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    """Elements that two sorted arrays share, counted with repetitions."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(n[i], m[j]).sum())


def _checked(rows: DataFrame, bounded: bool) -> DataFrame:
    """The pairs of ``rows`` (a, b, i_a, i_b, n_a, n_b) whose sets reach the
    threshold, or may reach it if the sets are only ``bounded`` (``_bounds``)."""
    num, den = THRESHOLD

    def count(raw_a: pa.Scalar, raw_b: pa.Scalar, n_a: int, n_b: int) -> int:
        if not bounded:
            return len(np.intersect1d(np.frombuffer(raw_a.as_buffer(), np.uint64), np.frombuffer(raw_b.as_buffer(), np.uint64),
                                      assume_unique=True))
        a, b = (np.frombuffer(x.as_buffer(), "<u2" if n < SHORT else "<u4") for x, n in ((raw_a, n_a), (raw_b, n_b)))
        if a.dtype != b.dtype:  # the leading 16 of 32 bits
            a, b = ((x >> 16).astype("<u2") if x.dtype == np.dtype("<u4") else x for x in (a, b))
        return _shared(a, b)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            linked = []
            for a, b, n_a, n_b in zip(x.column(2), x.column(3), x.column(4).to_pylist(), x.column(5).to_pylist()):
                common = count(a, b, n_a, n_b)
                linked.append(den * common >= num * (n_a + n_b - common))
            yield pa.RecordBatch.from_arrays([x.column(0), x.column(1)], names=["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return map_batches(rows.select("a", "b", "i_a", "i_b", "n_a", "n_b"), apply, "a long, b long")


def _reaching(pairs: DataFrame, sets: DataFrame, sizes: DataFrame, bounded: bool) -> DataFrame:
    """The pairs (a, b) that pass ``_checked`` with their nodes' ``sets``."""
    rows = pairs.select("a", "b")
    items = sets.join(sizes.select("node", "n_shingles"), "node")
    for s in ("a", "b"):
        rows = rows.join(items.select(F.col("node").alias(s), F.col("items").alias(f"i_{s}"),
                                      F.col("n_shingles").alias(f"n_{s}")), s)
    return _checked(rows, bounded)


def _ordered(a: F.Column, b: F.Column) -> list[F.Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _keys(registers: str = "registers") -> F.Column:
    """The bucket of each band."""
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(
        i, F.substring(registers, i * (2 * ROWS) + 1, F.lit(2 * ROWS))))


def _named(df: DataFrame, components_: DataFrame, c: str) -> DataFrame:
    """Adds ``c_<c>``, the component of node ``c`` (itself if it has no link)."""
    names = components_.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}"))
    return df.join(names, c, "left").withColumn(f"c_{c}", F.coalesce(f"c_{c}", c))


def _merge(joined: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """(node, component) after the further links ``found`` (a, b), at most ``rows``."""
    links_ = _named(_named(found, joined, "a"), joined, "b").select(F.col("c_a").alias("a"), F.col("c_b").alias("b"))
    roots = stored(components(links_, rows), "components")
    if roots.isEmpty():
        return joined
    named = joined.join(roots.select(F.col("node").alias("component"), F.col("component").alias("root")),
                        "component", "left").select("node", F.coalesce("root", "component").alias("component"))
    return stored(named.unionByName(roots.join(joined, "node", "left_anti")), "components")


def links(docs: DataFrame, nodes: DataFrame, n_nodes: int, n_rows: int, shingle: int, id_col: str,
          text_col: str) -> DataFrame:
    """(node, component) of the nodes that have a link."""
    n_bands = n_nodes * BANDS
    bands = nodes.filter("n_shingles > 0").select("node", F.explode(_keys()).alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("mates")).filter("mates > 1")
    bands = stored(few_files(bands.join(shared, "bucket"), n_bands), "bands")

    # a node's centrality is the number of its bucket mates
    central = bands.groupBy("node").agg(F.sum("mates").alias("weight"))
    bands = stored(few_files(bands.join(central, "node"), n_bands), "bands")
    hubs = bands.groupBy("bucket").agg(F.max(F.struct("weight", F.col("node").alias("hub"))).alias("h"))
    star = (bands.join(hubs.select("bucket", "h.hub"), "bucket").filter("node != hub")
            .select(*_ordered(F.col("node"), F.col("hub"))).distinct())
    star, n_star = counted(few_files(_estimated(star, nodes), n_bands), "pairs")

    # each node's best pair first, then the hub pairs that join two components
    sides = star.select("a", "b", "similarity", F.explode(F.array("a", "b")).alias("node"))
    best = sides.groupBy("node").agg(F.max(F.struct("similarity", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
    best, n_best = counted(few_files(best, n_star), "best")
    # whose sets may be asked for: members of pairs, and of buckets with more than a pair
    wanted = star.select(F.explode(F.array("a", "b")).alias("node")).unionByName(bands.filter("mates > 2").select("node"))
    sets = few_files(_sets_of(docs, nodes, wanted.distinct(), shingle, id_col, text_col), n_rows, SET_ROWS)
    sets = stored(sets, "sets")
    bounds = stored(_bounds(sets), "bounds")
    linked = few_files(_reaching(best, sets, nodes, False), n_nodes + n_best, SET_ROWS)
    joined = stored(components(linked, n_best), "components")
    rest = _named(_named(star.join(best, ["a", "b"], "left_anti"), joined, "a"), joined, "b").filter("c_a != c_b")
    rest, n_rest = counted(few_files(rest.select("a", "b"), n_star), "pairs")
    rest, n_rest = counted(few_files(_reaching(rest, bounds, nodes, True), n_nodes + n_rest, SET_ROWS), "pairs")
    joined = _merge(joined, few_files(_reaching(rest, sets, nodes, False), n_nodes + n_rest, SET_ROWS), n_rest)

    # bucket mates that are still apart, and not by a hub pair alone
    mates = _named(bands.filter("mates > 2").select("bucket", "node"), joined, "node")
    parts = mates.groupBy("bucket", "c_node").agg(F.count("*").alias("n")).groupBy("bucket").agg(
        F.max(F.struct("n", "c_node")).alias("largest"), F.count("*").alias("parts"))
    apart = mates.join(parts.filter("parts > 1").select("bucket", F.col("largest.c_node").alias("place")), "bucket")
    apart, n_apart = counted(few_files(apart.select("place", "node", "c_node").distinct(), n_bands), "apart")
    pairs, n_pairs = counted(_neighbours(apart, n_apart, sets, bounds, nodes, n_nodes), "pairs")
    return _merge(joined, few_files(_reaching(pairs, sets, nodes, False), n_nodes + n_pairs, SET_ROWS), n_pairs)


def _neighbours(apart: DataFrame, n_apart: int, sets: DataFrame, bounds: DataFrame, nodes: DataFrame,
                n_nodes: int) -> DataFrame:
    """Pairs (a, b) of bucket mates in different components that may be linked.

    ``apart``: (place, node, c_node); ``place`` is the neighbourhood and the
    component of its largest part.
    """
    num, den = THRESHOLD
    inside = sets.join(apart.select("node").distinct(), "node", "left_semi")
    seen = _incidences(inside).join(apart.select("place", "node"), "node")
    counts = seen.groupBy("place", "shingle").agg(F.count("*").alias("held")).filter("held > 1")
    crowds = apart.groupBy("place").agg(F.count("*").alias("crowd"))
    # kinds of shingles: those that most members hold and the others, each by hash
    usual = F.when(2 * F.col("held") >= F.col("crowd"), KINDS // 2).otherwise(0)
    counts = counts.join(crowds, "place").select(
        "place", "shingle", "held", (usual + F.pmod("shingle", F.lit(KINDS // 2))).cast("int").alias("kind"))
    seen = stored(seen.join(counts, ["place", "shingle"]), "held")
    wide = F.col("held") >= RARE
    common = seen.groupBy("place", "node").agg(
        F.count(F.when(wide, 1)).alias("common"),
        F.array([F.count(F.when(wide & (F.col("kind") == k), 1)) for k in range(KINDS)]).alias("kinds"))
    member = (apart.join(common, ["place", "node"], "left").withColumn("common", F.coalesce("common", F.lit(0)))
              .join(nodes.select("node", F.col("n_shingles").alias("n")), "node"))
    member = stored(few_files(member, n_nodes + n_apart, SET_ROWS), "members")

    def two_sides(x: DataFrame, y: DataFrame, on: list[str], condition: F.Column) -> DataFrame:
        x, y = (df.select([F.col(c).alias(f"{s}_{c}") for c in df.columns]) for df, s in ((x, "x"), (y, "y")))
        for c in on:
            condition = condition & (F.col(f"x_{c}") == F.col(f"y_{c}"))
        return x.join(y, condition).select(*_ordered(F.col("x_node"), F.col("y_node")))

    sizes = (F.col("x_c_node") != F.col("y_c_node")) & (den * F.least("x_n", "y_n") >= num * F.greatest("x_n", "y_n"))
    # all that two sets without a shared rare shingle can share is common, and of
    # each kind no more than either has
    need, may = num * (F.col("x_n") + F.col("y_n")), num + den
    shared = F.aggregate(F.zip_with("x_kinds", "y_kinds", lambda x, y: F.least(x, y)), F.lit(0).cast("long"), lambda n, k: n + k)
    enough = (may * F.least("x_common", "y_common") >= need) & (may * shared >= need)
    once = (F.col("y_c_node") == F.col("y_place")) | (F.col("y_node") < F.col("x_node"))
    # a set that is linked shares num/den of itself at least
    able = member.filter(den * F.col("common") >= num * F.col("n"))
    by_common = two_sides(able.filter("c_node != place"), able, ["place"], sizes & enough & once)
    held = (seen.filter(F.col("held") < RARE).select("place", "node", "shingle")
            .join(member.select("place", "node", "c_node", "n"), ["place", "node"]))
    held = stored(held, "rare")
    by_rare = two_sides(held, held, ["place", "shingle"], sizes & (F.col("y_node") < F.col("x_node")))
    pairs, n = counted(by_common.unionByName(by_rare).distinct(), "pairs")
    pairs, n = counted(few_files(_estimated(pairs, nodes, mates=False), n_nodes + n), "pairs")
    return few_files(_reaching(pairs, bounds, nodes, True), n_nodes + n, SET_ROWS)


def _sets_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    """Full sets of the nodes in ``wanted``, from the text of each node's first
    row (and of rows that repeat it: more rows of the same node do no harm)."""
    wanted = nodes.select("node", "first_id", "text_key").join(wanted, "node")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"), F.col(text_col).alias("text"))
    found = texts.join(wanted, (texts["key"] == wanted["text_key"]) & texts["id"].eqNullSafe(wanted["first_id"]))
    return _sets(found, shingle)


def grouped(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_key, row, n_shingles, component (a
    long naming the group), component_id (smallest doc_id in the group)."""
    rows, n_rows = counted(sketched(docs, shingle, id_col, text_col).withColumn("row", F.monotonically_increasing_id()), "sketches")
    nodes = rows.groupBy("f0", "f1", "n_shingles").agg(
        F.min(F.struct("row", "doc_id", "text_key", "registers")).alias("r"), F.min("doc_id").alias("min_id"))
    nodes, n_nodes = counted(nodes.select(F.col("r.row").alias("node"), "f0", "f1", "n_shingles", F.col("r.doc_id").alias("first_id"),
                                F.col("r.text_key").alias("text_key"), F.col("r.registers").alias("registers"), "min_id"),
                   "nodes")
    linked = stored(links(docs, nodes, n_nodes, n_rows, shingle, id_col, text_col), "linked")
    named = (nodes.select("node", "f0", "f1", "n_shingles", "min_id").join(linked, "node", "left")
             .withColumn("component", F.coalesce("component", "node")))
    ids = named.groupBy("component").agg(F.min("min_id").alias("component_id"))
    named = named.join(ids, "component").select("f0", "f1", "n_shingles", "component", "component_id")
    named = stored(few_files(named, n_nodes), "named")
    alone = F.col("n_shingles") == 0
    return (rows.select("doc_id", "text_key", "row", "n_shingles", "f0", "f1").join(named, ["f0", "f1", "n_shingles"])
            .select("doc_id", "text_key", "row", "n_shingles", F.when(alone, F.col("row")).otherwise(F.col("component")).alias("component"),
                    F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")))


def near_duplicates(docs: DataFrame, shingle: int = 5, **cols: str) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept."""
    g = grouped(docs, shingle, **cols)
    return g.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                                                       F.col("component_id").isNull()).alias("kept"))


def deduplicated(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, with all columns: the one with the smallest id.

    Rows that repeat a kept row (same id, same text) go too.
    """
    g = grouped(docs, shingle, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "text_key")).alias("f")
    kept = g.groupBy("component").agg(first).select(F.col("f.doc_id").alias("_id"), F.col("f.text_key").alias("_key"))
    kept = stored(kept.distinct(), "kept")
    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key"))
    rows = rows.join(kept, (rows["key"] == kept["_key"]) & rows["id"].eqNullSafe(kept["_id"]))
    # documents with an empty set may repeat their rows; other repeats are one group
    once = Window.partitionBy("key", "id").orderBy("id")
    return rows.withColumn("n", F.row_number().over(once)).filter("n = 1").select("doc.*")
