"""Cross-tokenizer alignment: which tokens of two tokenizers end at the same byte, and how often each pair does so.

A is a byte-level BPE (a rank file) over space + text, B a sentencepiece BPE over the text, which adds the space
itself. Offsets where tokens of both end cut a text into groups; a link is the pair of tokens, one of each side, that
end there. Every token has at least one byte, so a group has one link: its last tokens.

1. Encode. Each distinct piece of text is coded once per worker and kept (``pretoken.Coder``): A by pre-token, B by
   run of spaces with the signs behind it, which is exact since no piece of the vocabulary holds a space behind another
   sign (checked on loading). Both id lists are staged, with what needs no corpus counts.
2. Distinct link pairs of all documents, dealt into buckets by hash. Each bucket builds its own minimal perfect hash:
   levels of a sparse table; keys that share a slot go down a level. Slots number the keys 0..n-1 without gaps.
3. Counting pass over the staged ids: a task adds its links into one dense vector per bucket, indexed by the hash, and the
   vectors are summed as a tree, ``FAN`` at a time, so that no task holds more than that many vectors of a bucket.
4. Each B id's highest count: a vector as long as B's vocabulary.
5. Second pass: documents are aligned again, each link's count is looked up by hash and its key verified.

Pairs are bounded by the vocabularies, not by the input, yet their tables aren't sent out unchecked: buckets are grouped into parts
of at most ``PART_KEYS`` pairs, and passes 3 and 5 run once for each part, whose counts add up. One part is the rule.

Null and empty texts, and those whose joined bytes on either side differ from space + text, have no tokens: zero counts and an
empty digest. Null ids and repeated rows stay rows of their own; other columns, whatever their names, take no part. Texts of any
length are handled whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.pretoken import Coder, PreTokens, _gather, id_widths, public_file, rank_coder, ranks
from contrail.llm.staging import staged
from contrail.llm.textvec import mix, prepare, span_hashes, text_slices

RANK_FILE = "byte_bpe_50k.tiktoken"
PIECE_MODEL = "piece_bpe_32k.model"
#: Pairs in a bucket on average, and in the tables that a task holds at once.
BUCKET_KEYS, PART_KEYS = 1 << 15, 1 << 21
FAN = 16
#: Table slots per key and level, and levels before a bucket starts again with another seed.
GAMMA, LEVELS = 1.7, 40


# -- encoding -------------------------------------------------------------


@cache
def _processor(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_file(name))


def piece_bytes(piece: str) -> bytes:
    """The text bytes of a piece: U+2581 is a space, <0xHH> a byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


@cache
def _piece_table(name: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, width, all bytes) of B's ids."""
    sp = _processor(name)
    pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
    texts = [b"" if sp.is_control(i) else piece_bytes(p) if sp.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in enumerate(pieces)]
    for i, t in enumerate(texts):
        if " " in pieces[i].lstrip("▁").replace("▁", " ") or (not t and not sp.is_control(i)):
            raise ValueError(f"{name}: piece {pieces[i]!r} doesn't keep to one run of spaces and the signs behind it")
    width = np.array([len(t) for t in texts])
    return np.cumsum(width) - width, width, np.frombuffer(b"".join(texts), np.uint8)


@cache
def _piece_coder(name: str) -> Coder:
    sp = _processor(name)
    space = [sp.piece_to_id("▁")]

    def code(words: list[str]):
        ids = sp.encode([w[1:] for w in words], num_threads=1)  # the library puts the first space itself, but to nothing
        ids = [x if w != " " else space for w, x in zip(words, ids, strict=True)]
        return [(np.fromiter(map(len, ids), np.int64, len(ids)), np.array([i for x in ids for i in x], np.uint32))]

    return Coder(code)


def _spaced(pre: PreTokens) -> PreTokens:
    """The same texts, each beginning with a space, cut before every run of spaces instead."""
    out = PreTokens.__new__(PreTokens)
    out.text, out.chars, out.bounds = pre.text, pre.chars, pre.bounds
    space = pre.chars == 0x20
    before = np.zeros(len(space), bool)
    before[1:] = space[:-1]
    before[pre.bounds[:-1]] = False
    out.starts = np.flatnonzero(space & ~before)
    out.ends = np.append(out.starts[1:], len(pre.chars))
    out.first = np.searchsorted(out.starts, out.bounds)
    out.hash = span_hashes(out.chars, out.starts, out.ends)
    return out


def encode(texts: pa.Array, rank_file: str, model: str):
    """Yield (first row, A ids, A bounds, B ids, B bounds) over slices of non-empty texts; a text
    whose bytes don't come back has no ids."""
    large = pa.large_string()
    spaced = pc.binary_join_element_wise(pa.scalar("", large), pc.cast(texts, large), pa.scalar(" ", large))
    for row, data, offsets in text_slices(spaced):
        pre = PreTokens(data, offsets)
        a, a_bounds = rank_coder(rank_file).ids_of(pre)
        b, b_bounds = _piece_coder(model).ids_of(_spaced(pre))
        at, width, table = _piece_table(model)
        joined = _gather(table, at[b], width[b])
        ends = np.concatenate(([0], np.cumsum(width[b])))[b_bounds]
        a_size = np.concatenate(([0], np.cumsum(id_widths(public_file(rank_file))[a])))[a_bounds]
        size = np.diff(offsets)
        same = (np.diff(ends) == size) & (np.diff(a_size) == size)
        for k in np.flatnonzero(same).tolist():
            same[k] = np.array_equal(joined[ends[k] : ends[k + 1]], data[offsets[k] : offsets[k + 1]])
        if not same.all():
            keep_a, keep_b = np.repeat(same, np.diff(a_bounds)), np.repeat(same, np.diff(b_bounds))
            a, b = a[keep_a], b[keep_b]
            a_bounds = np.concatenate(([0], np.cumsum(np.where(same, np.diff(a_bounds), 0))))
            b_bounds = np.concatenate(([0], np.cumsum(np.where(same, np.diff(b_bounds), 0))))
        yield row, a, a_bounds, b, b_bounds


# -- alignment ------------------------------------------------------------


def common_ends(a: np.ndarray, a_width: np.ndarray, b: np.ndarray, b_width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the tokens that end together, over texts of equal bytes one after another."""
    a_end, b_end = np.cumsum(a_width[a]), np.cumsum(b_width[b])
    at = np.searchsorted(b_end, a_end)
    hit = np.flatnonzero(b_end[np.minimum(at, len(b_end) - 1)] == a_end) if len(b_end) else np.zeros(0, np.int64)
    return hit, at[hit]


@cache
def _decimals(n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, width, bytes) of each number below ``n`` with one byte left for a separator."""
    texts = [f"{i}," for i in range(n)]
    width = np.array([len(t) for t in texts])
    return np.cumsum(width) - width, width, np.frombuffer("".join(texts).encode(), np.uint8)


def group_texts(a: np.ndarray, b: np.ndarray, link_a: np.ndarray, link_b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of ``a1,a2|b1;a3|b2,b3;`` over all groups, and the end of each group's text."""
    n_a, n_b = np.diff(link_a, prepend=-1), np.diff(link_b, prepend=-1)
    groups = len(link_a)
    before_a = np.repeat(np.cumsum(n_b) - n_b, n_a)  # B tokens that stand before an A token
    before_b = np.repeat(np.cumsum(n_a), n_b)
    ids = np.empty(len(a) + len(b), np.int64)
    at_a, at_b = np.arange(len(a)) + before_a, np.arange(len(b)) + before_b
    ids[at_a], ids[at_b] = a, b
    at, width, table = _decimals(most)
    out = _gather(table, at[ids], width[ids])
    ends = np.cumsum(width[ids])
    out = out.copy()
    if groups:
        out[ends[at_a[link_a]] - 1] = ord("|")
        out[ends[at_b[link_b]] - 1] = ord(";")
    return out, ends[at_b[link_b]] if groups else np.zeros(0, np.int64)


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _encoded(docs: DataFrame, id_col: str, text_col: str, rank_file: str, model: str, keep_groups: bool) -> DataFrame:
    fields = [T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.LongType()),
              *(T.StructField(c, T.LongType()) for c in _COUNTS), T.StructField("groups_sha256", T.StringType()),
              T.StructField("a", T.BinaryType()), T.StructField("b", T.BinaryType())]
    if keep_groups:
        fields.append(T.StructField("groups", T.StringType()))
    schema = T.StructType(fields)

    def run(batches):
        a_width, b_width = id_widths(public_file(rank_file)), _piece_table(model)[1]
        most = max(len(a_width), len(b_width))
        for batch in batches:
            n = len(batch)
            empty = pc.equal(pc.fill_null(pc.binary_length(batch.column("text")), 0), 0).to_numpy(zero_copy_only=False)
            full = np.flatnonzero(~empty)
            counts, digest, groups = np.zeros((4, n), np.int64), [""] * n, [""] * n
            a_bytes, b_bytes = [b""] * n, [b""] * n
            texts = batch.column("text").take(pa.array(full)) if len(full) < n else batch.column("text")
            for first, a, a_bounds, b, b_bounds in encode(texts, rank_file, model) if len(full) else ():
                link_a, link_b = common_ends(a, a_width, b, b_width)
                text, ends = group_texts(a, b, link_a, link_b, most)
                links = np.searchsorted(link_a, a_bounds)
                stops = np.concatenate(([0], ends))[links].tolist()
                small_a, small_b = _pack(a, len(a_width)), _pack(b, len(b_width))
                rows = full[first : first + len(a_bounds) - 1]
                counts[:, rows] = [np.diff(a_bounds), np.diff(b_bounds), np.diff(links), np.diff(links)]
                for k, r in enumerate(rows.tolist()):
                    if links[k + 1] > links[k]:
                        own = text[stops[k] : stops[k + 1] - 1].tobytes()
                        digest[r] = hashlib.sha256(own).hexdigest()
                        a_bytes[r] = small_a[a_bounds[k] : a_bounds[k + 1]].tobytes()
                        b_bytes[r] = small_b[b_bounds[k] : b_bounds[k + 1]].tobytes()
                        groups[r] = own.decode() if keep_groups else ""
            cols = [batch.column("id"), batch.column("row"), *(pa.array(c) for c in counts), pa.array(digest, pa.string()),
                    pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols + ([pa.array(groups, pa.string())] if keep_groups else []), schema.fieldNames())

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema)


def _kind(size: int):
    return np.dtype("<u2") if size <= 1 << 16 else np.dtype("<u4")


def _pack(ids: np.ndarray, size: int) -> np.ndarray:
    return ids.astype(_kind(size))


def _unpacked(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a binary column, and the bounds of each row in them."""
    kind = _kind(size)
    column = (column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column).cast(pa.large_binary())
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return np.frombuffer(data.tobytes(), kind).astype(np.int64), (off - off[0]) // kind.itemsize


def _aligned(batch: pa.RecordBatch, rank_file: str, model: str) -> tuple[np.ndarray, np.ndarray]:
    """The link pairs of a batch of staged documents (A id << 32 | B id), and the bounds of each row in them."""
    a_width, b_width = id_widths(public_file(rank_file)), _piece_table(model)[1]
    (a, a_bounds), (b, _) = _unpacked(batch.column("a"), len(a_width)), _unpacked(batch.column("b"), len(b_width))
    link_a, link_b = common_ends(a, a_width, b, b_width)
    return a[link_a] << 32 | b[link_b], np.searchsorted(link_a, a_bounds)


# -- minimal perfect hash ---------------------------------------------------


def _hashed(keys: np.ndarray, salt: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((salt * 0xD1342543DE82EF95) % (1 << 64)))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (_hashed(keys, 0) % np.uint64(buckets)).astype(np.int64)


class PerfectHash:
    """Numbers n distinct keys 0..n-1; ``find`` gives -1 for any other key, since the keys are kept and compared.

    ``sizes`` are the slots of each level, ``slots`` the key's number in each slot of all levels (-1: none of its own)."""

    def __init__(self, keys: np.ndarray, sizes: np.ndarray, slots: np.ndarray, seed: int):
        self.keys, self.sizes, self.slots, self.seed = keys, sizes, slots, seed

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        for seed in range(1, 1000):
            left, number, sizes, slots, order = keys, 0, [], [], []
            for level in range(LEVELS):
                if not len(left):
                    break
                size = int(GAMMA * len(left)) + 1
                at = (_hashed(left, seed * LEVELS + level) % np.uint64(size)).astype(np.int64)
                alone = np.bincount(at, minlength=size)[at] == 1
                slot = np.full(size, -1, np.int32)
                slot[at[alone]] = np.arange(number, number + alone.sum())
                number += int(alone.sum())
                order.append(left[alone])
                sizes.append(size)
                slots.append(slot)
                left = left[~alone]
            if not len(left):
                return cls(np.concatenate([*order, keys[:0]]), np.array(sizes, np.int64),
                           np.concatenate([*slots, np.zeros(0, np.int32)]), seed)
        raise ValueError("keys aren't distinct")

    def find(self, keys: np.ndarray) -> np.ndarray:
        out, left, base = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes.tolist()):
            if not len(left):
                break
            at = (_hashed(keys[left], self.seed * LEVELS + level) % np.uint64(size)).astype(np.int64)
            number = self.slots[base + at]
            hit = number >= 0
            out[left[hit]] = number[hit]
            left, base = left[~hit], base + size
        wrong = (out < 0) | (self.keys[np.maximum(out, 0)] != keys) if len(self.keys) else np.ones(len(keys), bool)
        out[wrong] = -1
        return out


class Part:
    """The hashes of some buckets, one after another, as one hash over all their keys."""

    def __init__(self, buckets: int, hashes: dict[int, PerfectHash]):
        self.buckets, self.hashes = buckets, hashes
        self.first = {}
        at = 0
        for b in sorted(hashes):
            self.first[b], at = at, at + len(hashes[b].keys)
        self.size = at

    def find(self, keys: np.ndarray) -> np.ndarray:
        if self.buckets == 1:
            return self.hashes[0].find(keys) if 0 in self.hashes else np.full(len(keys), -1, np.int64)
        out, bucket = np.full(len(keys), -1, np.int64), bucket_of(keys, self.buckets)
        order = np.argsort(bucket, kind="stable")
        bounds = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        for b, h in self.hashes.items():
            own = order[bounds[b] : bounds[b + 1]]
            if len(own):
                got = h.find(keys[own])
                out[own] = np.where(got >= 0, got + self.first[b], -1)
        return out


# -- Spark jobs -------------------------------------------------------------

_HASH = "bucket long, n long, keys binary, sizes binary, slots binary, seed long"


def _distinct_pairs(tokens: DataFrame, rank_file: str, model: str) -> DataFrame:
    """All distinct link pairs; each task sends its own once for every few million links it reads."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(np.unique(_aligned(batch, rank_file, model)[0]))
            size += len(held[-1])
            if size > 4_000_000:
                held = [np.unique(np.concatenate(held))]
                size = len(held[0])
                if size > 2_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(held[0])], ["pair"])
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(held)))], ["pair"])

    return tokens.select("a", "b").mapInArrow(run, "pair long").distinct()


def _perfect_hashes(pairs: DataFrame, buckets: int) -> DataFrame:
    """One row a bucket: its hash, built in the task that holds the bucket."""

    @F.pandas_udf("long")
    def bucket(pair: pd.Series) -> pd.Series:
        return pd.Series(bucket_of(pair.to_numpy(), buckets))

    def build(key, table):
        h = PerfectHash.build(np.sort(table.column("pair").combine_chunks().to_numpy()))
        return pa.table({"bucket": [key[0].as_py()], "n": [len(h.keys)], "keys": [h.keys.astype("<i8").tobytes()],
                         "sizes": [h.sizes.astype("<i8").tobytes()], "slots": [h.slots.astype("<i4").tobytes()], "seed": [h.seed]})

    return pairs.select("pair", bucket("pair").alias("bucket")).groupBy("bucket").applyInArrow(build, _HASH)


def _load(hashes: DataFrame, buckets: int, chosen: tuple[int, int]) -> Part:
    """The hashes of the buckets from ``chosen[0]`` up to ``chosen[1]``: at most PART_KEYS keys, or one bucket's."""
    rows = hashes.filter(F.col("bucket").between(chosen[0], chosen[1] - 1)).collect()
    return Part(buckets, {r["bucket"]: PerfectHash(
        np.frombuffer(r["keys"], "<i8"), np.frombuffer(r["sizes"], "<i8"), np.frombuffer(r["slots"], "<i4"), r["seed"]) for r in rows})


def _counted(tokens: DataFrame, part, tasks: int, rank_file: str, model: str) -> DataFrame:
    """(bucket, counts): links of each key of the part, in the hash's order, summed over all tasks as a tree."""

    def run(batches):
        own = part.value
        total = np.zeros(own.size, np.int64)
        for batch in batches:
            at = own.find(_aligned(batch, rank_file, model)[0])
            total += np.bincount(at[at >= 0], minlength=own.size)
        for b, h in own.hashes.items():
            mine = total[own.first[b] : own.first[b] + len(h.keys)]
            if mine.any():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b]), pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([mine.astype("<i8").tobytes()])],
                    ["bucket", "task", "counts"])

    def add(key, table):
        total = None
        for x in table.column("counts"):
            v = np.frombuffer(x.as_buffer(), "<i8")
            total = v.copy() if total is None else total + v
        return pa.table({"bucket": [key[0].as_py()], "task": [key[1].as_py()], "counts": [total.tobytes()]})

    schema = "bucket long, task long, counts binary"
    vectors = tokens.select("a", "b").mapInArrow(run, schema)
    while True:
        vectors = vectors.withColumn("task", F.expr(f"task div {FAN}")).groupBy("bucket", "task").applyInArrow(add, schema)
        tasks = -(-tasks // FAN)
        if tasks <= 1:
            return vectors.drop("task")


def align(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_file: str = RANK_FILE, model: str = PIECE_MODEL,
    keep_groups: bool = False, bucket_keys: int = BUCKET_KEYS, part_keys: int = PART_KEYS,
) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256[, groups]) of every row.

    n_best are the links whose count is the highest of their B id's in all documents, ties included."""
    spark = docs.sparkSession
    prepare(spark)
    ranks(public_file(rank_file)), _piece_table(model)  # fail here, not in a task
    tokens = staged(_encoded(docs, id_col, text_col, rank_file, model, keep_groups), "aligned")
    pairs = staged(_distinct_pairs(tokens, rank_file, model), "pairs")
    n_pairs = pairs.count()
    buckets = max(1, -(-n_pairs // bucket_keys))
    hashes = staged(_perfect_hashes(pairs, buckets), "hashes")
    per_part = max(1, part_keys // max(1, 2 * bucket_keys)) if buckets > 1 else 1
    parts = [(lo, min(lo + per_part, buckets)) for lo in range(0, buckets, per_part)]
    tasks = tokens.rdd.getNumPartitions()

    counted = []
    for chosen in parts:
        own = spark.sparkContext.broadcast(_load(hashes, buckets, chosen))
        counted.append(staged(_counted(tokens, own, tasks, rank_file, model), "counts"))
        own.unpersist()

    # Each B id's highest count.
    n_b_ids = len(_piece_table(model)[1])

    def highest(batches):
        best: dict[int, int] = {}
        for batch in batches:
            for keys, counts in zip(batch.column("keys"), batch.column("counts"), strict=True):
                ids = np.frombuffer(keys.as_buffer(), "<i8") & 0xFFFFFFFF
                top = np.zeros(n_b_ids, np.int64)
                np.maximum.at(top, ids, np.frombuffer(counts.as_buffer(), "<i8"))
                for i in np.flatnonzero(top).tolist():
                    best[i] = max(best.get(i, 0), int(top[i]))
        yield pa.RecordBatch.from_arrays([pa.array(list(best), pa.int64()), pa.array(list(best.values()), pa.int64())], ["b", "top"])

    best = np.zeros(n_b_ids, np.int64)
    for c in counted:
        tops = c.join(hashes.select("bucket", "keys"), "bucket").select("keys", "counts").mapInArrow(highest, "b long, top long")
        for r in tops.groupBy("b").agg(F.max("top").alias("top")).collect():  # at most B's vocabulary
            best[r["b"]] = max(best[r["b"]], r["top"])

    fixed = ["id", "row", *_COUNTS, "groups_sha256", *(["groups"] if keep_groups else [])]
    schema = T.StructType([*(tokens.schema[c] for c in fixed), T.StructField("n_best", T.LongType()), T.StructField("count_sum", T.LongType())])

    def looked_up(chosen, c):
        part = _load(hashes, buckets, chosen)
        counts = np.zeros(part.size, np.int64)
        for r in c.collect():
            v = np.frombuffer(r["counts"], "<i8")
            counts[part.first[r["bucket"]] : part.first[r["bucket"]] + len(v)] = v
        tables = spark.sparkContext.broadcast((part, counts, best))

        def run(batches):
            own, count_of, top_of = tables.value
            for batch in batches:
                pair, bounds = _aligned(batch, rank_file, model)
                at = own.find(pair)
                count = np.where(at >= 0, count_of[at] if len(count_of) else 0, 0)
                is_best = (at >= 0) & (count == top_of[pair & 0xFFFFFFFF])
                sums = [np.diff(np.concatenate(([0], np.cumsum(x, dtype=np.int64)))[bounds]) for x in (is_best, count)]
                yield pa.RecordBatch.from_arrays([*(batch.column(f) for f in fixed), *map(pa.array, sums)], schema.fieldNames())

        return tokens.mapInArrow(run, schema)

    out = looked_up(parts[0], counted[0])
    if len(parts) > 1:
        found = [out, *(looked_up(p, c) for p, c in zip(parts[1:], counted[1:], strict=True))]
        out = staged(found[0], "looked_up")
        sums = out.select("row", "n_best", "count_sum")
        for more in found[1:]:
            sums = sums.unionByName(staged(more.select("row", "n_best", "count_sum"), "looked_up"))
        sums = sums.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        out = out.drop("n_best", "count_sum").join(sums, "row")
    return out.select(F.col("id").alias(id_col), *_COUNTS, "n_best", "count_sum", *fixed[6:])
