"""Mixture-controlled sequence packing by deficit round-robin.

Every source is a queue of documents, cut into packets of at most ``packet``
tokens.  Each round adds to a queue's deficit a quantum of
``sequence_tokens * target proportion`` tokens, and a queue sends its next
packet in the first round in which its deficit covers it; what is left is
carried to the next round.  For a queue with backlog that round has a closed
form, ``ceil(tokens up to the packet's end / quantum)``, so the schedule is
computed by distributed prefix sums and no partition has to wait for another:
deficits are carried across windows and partitions exactly.  A queue that runs
empty is skipped from then on.

The packets in round order form one stream that is cut every
``sequence_tokens`` tokens; only the last sequence has padding.

Scale: token ids are computed once and written to the shared folder.  Planning
moves narrow rows (one per packet).  Queue positions come from blocks of about
``BLOCK_ROWS`` documents per (source, block), so a hot source is spread over
many tasks; stream offsets come from blocks of ``BLOCK_ROUNDS`` rounds, which
hold about the same number of tokens each by construction.  Ids are shuffled
once, to their document's packets.

Tokenising keeps a bounded cache: the tokenizer drops white space and splits a
text before its model runs, so a text's ids are the ids of its pieces.

Defined cases: null and empty texts have the end id only; null sources are one
more queue; repeated rows and null ids are packed like any other row; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from itertools import islice
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import map_batches, once_per_worker, stored

SEQUENCE_TOKENS = 2048
PACKET_TOKENS = 512
END_ID = 1
BLOCK_ROWS = 16384
BLOCK_ROUNDS = 4096
#: entries of a worker's cache
CACHE_PIECES = 500_000

_WORD = re.compile(r"[^ \t\n\r]+")
#: the word tokenizer's split; any other tokenizer gets whole texts (fixed value)
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: the same, restricted to plain lower-case characters
_PIECE = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+")
#: the plain characters as Latin-1 bytes: printable ASCII, \t, \n, \r and letters
_PLAIN = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)])


class _Cache(dict):
    """Ids (as bytes) of pieces; forgets the older half when it is full."""

    def __init__(self, encode: Callable[[str], bytes]) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_PIECES:
            for k in list(islice(self, CACHE_PIECES // 2)):
                del self[k]
        ids = self[piece] = self.encode(piece)
        return ids


class CachedTokenizer:
    """Ids of texts through bounded caches.

    For the word tokenizer, the split of a text of plain characters is made
    here, so that only the model runs, once per piece; any other text goes
    through the whole tokenizer, white-space separated word by word.  Other
    tokenizers get whole texts.
    """

    def __init__(self, tokenizer_json: str, wide: bool = True) -> None:
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = True  # their strings are ordinary text
        model = self.tokenizer.model
        parts = json.loads(tokenizer_json)
        splits = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = (splits[0].get("pattern") == {"Regex": _SPLIT}
                        and [n["type"] for n in (parts.get("normalizer") or {}).get("normalizers", [])]
                        == ["NFC", "Replace", "Lowercase"])
        bytewise = Tokenizer(model)
        bytewise.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        kind = "I" if wide else "H"

        def piece(s: str) -> bytes:
            ids = [t.id for t in model.tokenize(s)] if s.isascii() else bytewise.encode(s, add_special_tokens=False).ids
            return pack(f"<{len(ids)}{kind}", *ids)

        def word(s: str) -> bytes:
            ids = self.tokenizer.encode(s, add_special_tokens=False).ids
            return pack(f"<{len(ids)}{kind}", *ids)

        self.word, self.pieces, self.words = word, _Cache(piece), _Cache(word)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned ids of the text, 32 bits ``wide`` or 16."""
        if not self.by_word:
            return self.word(text)
        try:
            plain = not text.encode("latin-1").translate(None, _PLAIN)
        except UnicodeEncodeError:
            plain = False
        if plain:
            return b"".join(map(self.pieces.__getitem__, _PIECE.findall(text.lower())))
        return b"".join(map(self.words.__getitem__, _WORD.findall(text)))


def _vocabulary_size(definition: str) -> int:
    """One more than the largest id in a tokenizer file; no tokenizer is made."""
    known = json.loads(definition)
    vocabulary = known["model"].get("vocab", {})
    ids = vocabulary.values() if isinstance(vocabulary, dict) else range(len(vocabulary))
    return max([-1, *ids, *(t["id"] for t in known.get("added_tokens") or [])]) + 1


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, id_col: str = "doc_id",
              text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(row, doc_id, source, n_tokens, ids) of every row, the end id included.

    The tokenizer file is read on the driver only; ``ids`` are little-endian,
    16 bits wide if the vocabulary allows it, else 32.
    """
    with open(tokenizer_path, encoding="utf-8") as f:
        definition = f.read()
    wide = max(_vocabulary_size(definition), end_id + 1) > 1 << 16
    definition = docs.sparkSession.sparkContext.broadcast(definition)
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    schema = rows.drop("text").schema.add("n_tokens", "long").add("ids", "binary")

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = once_per_worker("tokenizer", definition.value, lambda d: CachedTokenizer(d, wide))
        # a small cache of this task's own pieces is faster than a full one
        tokenizer.pieces.clear()
        tokenizer.words.clear()
        width = 4 if wide else 2
        end = end_id.to_bytes(width, "little")
        for batch in batches:
            ids = [tokenizer.ids(t.as_py() or "") + end for t in batch.column(3)]
            n = [len(x) // width for x in ids]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(n, pa.int64()), pa.array(ids, pa.binary())],
                                             names=schema.names)

    return map_batches(rows, apply, schema)


def schedule(lengths: DataFrame, mixture: dict[str, float] | None = None,
             sequence_tokens: int = SEQUENCE_TOKENS, packet: int = PACKET_TOKENS) -> DataFrame:
    """Pieces (row, start, length, sequence_id, offset) of ``lengths`` (row, source, n_tokens).

    ``mixture``: weights by source (sources left out: by their token counts, so
    that all queues run empty together; that is also the default for all).
    """
    if mixture and not all(0 < v < float("inf") for v in mixture.values()):
        raise ValueError("every weight of a mixture must be positive: a source that is not to be packed has to be left out of the documents")
    spark = lengths.sparkSession
    rows = lengths.select("row", F.coalesce("source", F.lit("\0")).alias("queue"), "n_tokens")
    n_rows, n_tokens = rows.agg(F.count("*"), F.sum("n_tokens")).first()
    quanta = rows.groupBy("queue").agg((F.sum("n_tokens") / F.lit(max(n_tokens or 0, 1))).alias("weight"))
    if mixture:
        total = float(sum(mixture.values()))
        given = spark.createDataFrame([(str(k), v / total) for k, v in mixture.items()], "queue string, given double")
        quanta = (quanta.join(given, "queue", "left")
                  .select("queue", F.coalesce("given", "weight").alias("weight")))
    quanta = quanta.select("queue", (F.col("weight") * sequence_tokens).alias("quantum"))

    # tokens ahead of each document in its queue
    blocks = max(1, -(-n_rows // BLOCK_ROWS))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    order = Window.partitionBy("queue", "block").orderBy("row")
    ahead = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens")
    per_block = rows.groupBy("queue", "block").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = per_block.select("queue", "block", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    rows = (rows.withColumn("ahead", ahead).join(base, ["queue", "block"])
            .withColumn("ahead", F.col("ahead") + F.col("base")).join(quanta, "queue"))

    # packets and the round that sends them
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(packet).cast("long"))
    packets = (rows.select("row", "queue", "n_tokens", "ahead", "quantum", F.explode(starts).alias("start"))
               .withColumn("length", F.least(F.lit(packet), F.col("n_tokens") - F.col("start")))
               .withColumn("upto", F.col("ahead") + F.col("start") + F.col("length"))
               .withColumn("round", F.ceil(F.col("upto") / F.col("quantum")))
               .withColumn("part", F.floor(F.col("round") / BLOCK_ROUNDS))
               .select("row", "queue", "start", "length", "upto", "round", "part"))
    packets = stored(packets, "packets")

    # stream offsets: inside a block of rounds, then the blocks before it
    order = Window.partitionBy("part").orderBy("round", "queue", "upto")
    at = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    per_part = packets.groupBy("part").agg(F.sum("length").alias("held"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = per_part.select("part", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"))
    size = F.lit(sequence_tokens).cast("long")
    stream = (packets.withColumn("at", at).join(base, "part").withColumn("at", F.col("at") + F.col("base"))
              .withColumn("sequence_id", F.explode(F.sequence(
                  F.floor(F.col("at") / size), F.floor((F.col("at") + F.col("length") - 1) / size)))))
    lo = F.greatest(F.col("at"), F.col("sequence_id") * size)
    hi = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * size)
    return stream.select("row", (F.col("start") + lo - F.col("at")).cast("long").alias("start"),
                         (hi - lo).cast("long").alias("length"), F.col("sequence_id").cast("long"),
                         (lo - F.col("sequence_id") * size).cast("long").alias("offset"))


def packed(docs: DataFrame, tokenizer_path: str, mixture: dict[str, float] | None = None,
         sequence_tokens: int = SEQUENCE_TOKENS, packet: int = PACKET_TOKENS, end_id: int = END_ID,
         **cols: str) -> DataFrame:
    """One row per piece: doc_id, source, start, length, sequence_id, offset,
    doc_tokens and the piece's ``ids`` (little-endian unsigned 32-bit)."""
    tokens = stored(tokenized(docs, tokenizer_path, end_id, **cols), "tokens", "snappy")
    plan = schedule(tokens.select("row", "source", "n_tokens"), mixture, sequence_tokens, packet)
    by_row = plan.groupBy("row").agg(F.collect_list(F.struct("start", "length", "sequence_id", "offset")).alias("pieces"))
    joined = tokens.join(by_row, "row").select("doc_id", "source", "n_tokens", "ids", "pieces")
    long = pa.int64()
    schema = (docs.select(F.col(cols.get("id_col", "doc_id")).alias("doc_id"), F.lit("").alias("source")).schema
              .add("start", "long").add("length", "long").add("sequence_id", "long").add("offset", "long")
              .add("doc_tokens", "long").add("ids", "binary"))
    schema["source"].nullable = True

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pieces, n = b.column(4), b.column(2).to_numpy()
            take = np.repeat(np.arange(b.num_rows), pieces.value_lengths().to_numpy())
            if not len(take):
                continue
            start, length, sequence, offset = (x.to_numpy() for x in pieces.flatten().flatten())
            ids, row = [], -1
            for i, lo, hi in zip(take.tolist(), start.tolist(), (start + length).tolist()):
                if i != row:
                    raw, row = b.column(3)[i].as_buffer(), i
                    raw = np.frombuffer(raw, "<u2" if len(raw) == 2 * n[i] else "<u4").astype("<u4", copy=False)
                ids.append(raw[lo:hi].tobytes())
            index = pa.array(take)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(index), b.column(1).take(index),
                 *(pa.array(v, long) for v in (start, length, sequence, offset, n[take])), pa.array(ids, pa.binary())],
                names=schema.names)

    return map_batches(joined, cut, schema)
