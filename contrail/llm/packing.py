"""Packing of documents into token sequences along a space-filling curve.

1. Each text's byte trigrams are hashed into a vector of root counts, which a fixed random
   matrix projects to DIMS dimensions; the rows are stored once with these numbers.
2. The numbers, scaled by their mean and spread over all documents, become a place on a Hilbert
   curve, so near keys mean like texts.
3. Ranges of the curve are cut so that each holds as many bytes of text, from byte counts by the whole key.
   The counts are summed up along the curve in Spark, within buckets of the key's top BUCKET_BITS bits; the driver gets
   the buckets' sums and the keys in which a range ends, at most one a range. Where a range ends within a
   key, as in one full of copies, the key's rows are dealt by a hash of their row number, so no range grows
   with a group of copies, and ranges follow one another along the curve whatever their number. Spark
   moves each row to its range and sorts the range by (key, id, text hash).
4. Each range is read in order; documents are tokenized (added tokens of the vocabulary, such as <|endoftext|>, are
   found in the text and get their own ids; the parts between are coded by themselves) and laid one after another into sequences of
   SEQUENCE_TOKENS, cut where a sequence is full. The last, partial sequence of a range is cut
   into powers of two, which need no padding. So there is no padding at all.

A task holds one Arrow batch, the current sequence and a bounded store of encoded words.

Null text is empty: such a document is its end token alone. Null ids stay null, repeated rows are packed
as often as they occur, a document longer than a sequence spans several. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.pretoken import added_tokens, batches, rank_coder
from contrail.llm.staging import staged
from contrail.llm.textvec import prepare, text_slices

SEQUENCE_TOKENS = 2_048
END_ID = 1
#: Rank file of the vocabulary. With the added tokens of the .json of the same name it gives the same ids as the
#: tokenizers library does by that file without adding special tokens (tests/llm compares them).
TOKENIZER = "byte_bpe_50k.tiktoken"
DIMS, KEY_BITS, HASH_BITS = 3, 10, 10
#: Leading bits of the key within which byte counts are summed up, and the most bytes that a range should hold.
BUCKET_BITS, RANGE_BYTES = 14, 64_000_000
#: Sequences of one range are numbered from the range's number times this.
RANGE_SEQUENCES = 1 << 40


def _matrix() -> np.ndarray:
    return np.random.default_rng(20).normal(size=(1 << HASH_BITS, DIMS))


def project(column) -> np.ndarray:
    """DIMS numbers for each text; texts of under three bytes are at the origin."""
    out, matrix = [], _matrix()
    for _, data, offsets in text_slices(column):
        b = data.astype(np.uint16)
        # Byte trigrams, hashed to HASH_BITS bits in 16-bit arithmetic.
        h = np.zeros(len(b), np.uint16)
        if len(b) > 2:
            h[:-2] = b[:-2] * np.uint16(40503) + b[1:-1] * np.uint16(30011) + b[2:] * np.uint16(50021)
        h >>= np.uint16(16 - HASH_BITS)
        for start, end in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
            counts = np.sqrt(np.bincount(h[start : max(start, end - 2)], minlength=1 << HASH_BITS))
            size = np.sqrt(counts @ counts)
            out.append((counts @ matrix) / max(size, 1.0))
    return np.array(out).reshape(-1, DIMS)


def hilbert_key(cells: np.ndarray, bits: int = KEY_BITS) -> np.ndarray:
    """Place on the Hilbert curve through the grid of 2**bits cells a side; cells: (n, dims) integers.

    Gray-code form: from the highest bit down, each set bit inverts the lower bits of the
    first axis and each unset one swaps them with that axis; then the bits are interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    bit = 1 << (bits - 1)
    while bit > 1:
        low = bit - 1
        for d in range(dims):
            is_set = (x[d] & bit) != 0
            swap = np.where(is_set, 0, (x[0] ^ x[d]) & low)
            x[0] = np.where(is_set, x[0] ^ low, x[0] ^ swap)
            x[d] ^= swap
        bit >>= 1
    for d in range(1, dims):
        x[d] ^= x[d - 1]
    flip, bit = np.zeros(x.shape[1], np.int64), 1 << (bits - 1)
    while bit > 1:
        flip ^= np.where(x[dims - 1] & bit, bit - 1, 0)
        bit >>= 1
    x ^= flip
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for d in range(dims):
            key = (key << 1) | ((x[d] >> b) & 1)
    return key


def split_added(column: pa.Array, added: dict[str, int]) -> tuple[pa.Array, list[int], list[int]]:
    """(parts of the texts between added tokens, the id behind each part, the row that ends with it or -1)."""
    rows = list(range(len(column)))
    found = np.zeros(len(column), bool)
    for token in added:
        found |= pc.match_substring(column, token).to_numpy(zero_copy_only=False)
    if not found.any():
        return column, [END_ID] * len(rows), rows
    # The longest of those that begin at a place, as the library has it.
    pattern = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
    parts, after, ends = [], [], []
    for row, text in enumerate(column.to_pylist()):
        pieces = pattern.split(text) if found[row] else [text]
        parts += pieces[::2]
        after += [*(added[token] for token in pieces[1::2]), END_ID]
        ends += [-1] * (len(pieces) // 2) + [row]
    return pa.array(parts, pa.large_string()), after, ends


class Packer:
    """Lays documents into sequences; ``rows`` holds the finished pieces' columns."""

    def __init__(self, first_sequence: int, size: int = SEQUENCE_TOKENS):
        self.sequence, self.size, self.used, self.open, self.rows = first_sequence, size, 0, [], []

    def add(self, doc, ids: np.ndarray) -> None:
        at, total = 0, len(ids)
        while at < total:
            take = min(self.size - self.used, total - at)
            self.open.append((doc, at, ids[at : at + take], total))
            at, self.used = at + take, self.used + take
            if self.used == self.size:
                self._close(self.open)
                self.open, self.used = [], 0

    def _close(self, pieces: list) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            self.rows.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset))
            offset += len(ids)
        self.sequence += 1

    def finish(self) -> None:
        """The open sequence, cut into powers of two."""
        while self.used:
            size, pieces = 1 << (self.used.bit_length() - 1), []
            room = size
            while room:
                doc, start, ids, total = self.open.pop(0)
                if len(ids) > room:
                    self.open.insert(0, (doc, start + room, ids[room:], total))
                    ids = ids[:room]
                pieces.append((doc, start, ids, total))
                room -= len(ids)
            self._close(pieces)
            self.used -= size


def along_curve(docs: DataFrame, id_col: str, text_col: str, range_bytes: int = RANGE_BYTES) -> tuple[DataFrame, int]:
    """(rows of id, text, size, row, tie, key and part, which is the range of the curve; the number of ranges)."""
    spark = docs.sparkSession
    axes = [f"p{d}" for d in range(DIMS)]

    def with_place(rows):
        for batch in rows:
            p = project(batch.column("text"))
            size = pc.add(pc.cast(pc.binary_length(batch.column("text")), pa.int64()), 1)
            places = [pa.array(p[:, d]) for d in range(DIMS)]
            yield pa.RecordBatch.from_arrays([*batch.columns, size, *places], ["id", "text", "row", "size", *axes])

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row"))
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("row", T.LongType()),
        T.StructField("size", T.LongType()), *(T.StructField(a, T.DoubleType()) for a in axes),
    ])
    placed = staged(rows.mapInArrow(with_place, schema), "placed")
    s = placed.agg(*(F.avg(a).alias(f"m{a}") for a in axes), *(F.stddev_pop(a).alias(f"s{a}") for a in axes)).first()
    mean = [s[f"m{a}"] or 0.0 for a in axes]
    spread = [s[f"s{a}"] or 1.0 for a in axes]

    def keys(*p) -> np.ndarray:
        z = np.stack([(np.asarray(x) - m) / w for x, m, w in zip(p, mean, spread, strict=True)], axis=1)
        cell = 1 / (1 + np.exp(-1.7 * np.clip(z, -30, 30)))  # about the normal distribution's share below z
        return hilbert_key(np.minimum((cell * (1 << KEY_BITS)).astype(np.int64), (1 << KEY_BITS) - 1))

    @F.pandas_udf("long")
    def key_of(*p: pd.Series) -> pd.Series:
        return pd.Series(keys(*p))

    bucket = F.shiftright("key", DIMS * KEY_BITS - BUCKET_BITS)
    sizes = placed.groupBy(key_of(*axes).alias("key")).agg(F.sum("size").alias("n"))
    sizes = staged(sizes.withColumn("bucket", bucket), "sizes")
    # At most 2**BUCKET_BITS sums, whatever the input; a bucket holds at most 2**(DIMS * KEY_BITS - BUCKET_BITS) keys.
    sums, total = [], 0
    for r in sorted(sizes.groupBy("bucket").agg(F.sum("n").alias("n")).collect(), key=lambda r: r["bucket"]):
        sums.append((r["bucket"], total))
        total += r["n"]
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // range_bytes))

    def part_of(place):  # the same double arithmetic in Spark and numpy
        return place * float(ranges) / float(max(total, 1))

    before = spark.createDataFrame(sums, "bucket long, base long")
    up_to = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = sizes.withColumn("up_to", F.sum("n").over(up_to)).join(F.broadcast(before), "bucket")
    end = F.col("base") + F.col("up_to")
    ends_here = F.floor(part_of((end - F.col("n")).cast("double"))) != F.floor(part_of(end.cast("double")))
    cut = summed.filter(ends_here).select("key", (end - F.col("n")).alias("begin"), end.alias("end")).collect()
    cut = np.array(sorted(map(tuple, cut)), np.int64).reshape(-1, 3)
    shared = spark.sparkContext.broadcast(cut)

    @F.pandas_udf("key long, part int")
    def place(spread_by: pd.Series, *p: pd.Series) -> pd.DataFrame:
        key, (ends, begin, end) = keys(*p), shared.value.T
        at = np.searchsorted(ends, key)
        # A key between two of them lies wholly in the range that begins in the one before.
        where = np.append(0, end)[at].astype(np.float64)
        within = np.append(ends, -1)[at] == key
        i = at[within]
        share = (spread_by.to_numpy().astype(np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
        where[within] = begin[i] + share[within] * (end[i] - begin[i])
        part = np.floor(part_of(where)).astype(np.int64)
        return pd.DataFrame({"key": key, "part": np.clip(part, 0, ranges - 1).astype(np.int32)})

    own = ["id", "text", "size", "row"]
    keyed = placed.select(*own, F.xxhash64("id", "text").alias("tie"), place(F.xxhash64("row"), *axes).alias("at"))
    return keyed.select(*own, "tie", "at.*"), ranges


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER,
    sequence_tokens: int = SEQUENCE_TOKENS,
) -> DataFrame:
    """The pieces: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``tokenizer`` is a rank file, or the name of a public one; added tokens are those of the .json beside it, if any.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    keyed, ranges = along_curve(docs, id_col, text_col)
    ranged = keyed.repartitionById(ranges, F.col("part")).sortWithinPartitions("key", "id", "tie").select("id", "text")
    out = T.StructType([
        T.StructField(id_col, id_type),
        *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")),
    ])

    def lay(rows):
        coder, added = rank_coder(tokenizer), added_tokens(tokenizer)
        packer = Packer(TaskContext.get().partitionId() * RANGE_SEQUENCES, sequence_tokens)
        id_arrow = None

        def done():
            cols = list(zip(*packer.rows, strict=True))
            packer.rows = []
            return pa.RecordBatch.from_arrays(
                [pa.array(cols[0], id_arrow), *(pa.array(c, pa.int64()) for c in cols[1:])], out.fieldNames())

        for batch in rows:
            ids, id_arrow = batch.column("id"), batch.column("id").type
            names = ids.to_pylist()
            parts, after, ends = split_added(batch.column("text"), added)
            open_parts = []
            for first, pre in batches(parts):
                tokens, bounds = coder.ids_of(pre)
                for k in range(len(bounds) - 1):
                    open_parts.append(np.append(tokens[bounds[k] : bounds[k + 1]], np.uint32(after[first + k])))
                    if ends[first + k] >= 0:
                        doc = open_parts[0] if len(open_parts) == 1 else np.concatenate(open_parts)
                        packer.add(names[ends[first + k]], doc)
                        open_parts = []
            if packer.rows:
                yield done()
        packer.finish()
        if packer.rows:
            yield done()

    return ranged.mapInArrow(lay, out)
