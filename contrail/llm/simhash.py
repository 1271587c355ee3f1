"""Near-duplicates by SimHash: a binary-trie self-join over the distinct fingerprints.

1. Each text gets a 64-bit fingerprint from its word shingles (``with_fingerprint``).
2. Copies fall together first: one row per distinct fingerprint. A fingerprint has at
   most sum(C(64, i), i <= d) others within d bits, so the join stays linear in rows.
3. Cut into d + 1 blocks of bits, two fingerprints within d bits agree in a whole block. So the trie is built d + 1
   times, with the bits turned to let each block lead, and cut into subtrees (``_cut``). A subtree that isn't deeper
   than a block is one unit of work, joined with itself alone: each fingerprint (8 bytes) is sent d + 1 times. Where
   a block holds too many, its deeper subtrees are also paired, if their prefixes differ in few enough bits.
4. In a pair, ``trie_links`` goes down both subtrees together, one bit at a time, adds up
   the differing bits and prunes a node pair as soon as they exceed the budget. A unit
   returns a spanning forest of its links, so no group is expanded into all pairs.
5. ``components`` joins the forests, and each text takes the smallest id reachable.

Null, empty and blank texts have no word: fingerprint zero, linked like any other.
Null ids keep their row and never become a component's id; a component without any id has
a null one. Repeated rows stay, with the same result. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.components import components
from contrail.llm.staging import staged
from contrail.llm.textvec import Words, prepare, text_slices

SHINGLE_WORDS = 3
MAX_BITS = 3
HASH_SEED = 42
#: Fingerprints in a subtree: at least, and as a share of all, four times the mean of a prefix of FIRST_CUT bits.
SUBTREE_LEAVES, MOST_SUBTREES = 32_768, 16_384
#: Bits of the first cut, and those by which it goes deeper where a prefix holds too many.
FIRST_CUT, CUT_STEP = 16, 4
_CHUNK = 200_000


# ---------------------------------------------------------------- fingerprints


def text_fingerprints(column: pa.Array | pa.ChunkedArray, shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned 64-bit fingerprints of a column of texts."""
    out = []
    for _, data, offsets in text_slices(column):
        w = Words(data, offsets)
        n = len(w.starts)
        size = w.ends - w.starts
        to = np.cumsum(size + 1) - (size + 1)  # the words again, with one space after each
        flat = np.full(int((size + 1).sum()), 0x20, np.uint8)
        word_byte = np.ones(len(flat), bool)
        word_byte[to + size] = False
        inside = np.zeros(len(data) + 1, np.int8)
        inside[w.starts] += 1
        inside[w.ends] -= 1
        flat[word_byte] = w.bytes[np.cumsum(inside[:-1]).astype(bool)]
        last = np.minimum(np.arange(n) + shingle, w.first_word[1:][w.doc]) - 1
        # A shingle begins at each word with enough words after it, or at a short text's first word.
        first = w.first_word[:-1][w.doc]
        is_start = (np.arange(n) + shingle <= w.first_word[1:][w.doc]) | (np.arange(n) == first)
        at = np.flatnonzero(is_start)
        buf, a, b = flat.tobytes(), to[at].tolist(), (to[last[at]] + size[last[at]]).tolist()
        digest = xxhash.xxh64_intdigest
        h = np.fromiter((digest(buf[i:j], HASH_SEED) for i, j in zip(a, b, strict=True)), np.uint64, len(a))
        bounds = np.searchsorted(at, w.first_word)
        fps = np.zeros(w.n_docs, np.uint64)
        for k in range(w.n_docs):
            some, total, place = int(bounds[k + 1] - bounds[k]), np.zeros(64, np.int64), int(bounds[k])
            for c in range(place, place + some, 65_536):
                part = h[c : min(c + 65_536, place + some)].view(np.uint8).reshape(-1, 8)
                total += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            if some:
                fps[k] = np.packbits(2 * total > some, bitorder="little").view(np.uint64)[0]
        out.append(fps)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def with_fingerprint(
    docs: DataFrame, text_col: str = "text", out_col: str = "fingerprint", shingle: int = SHINGLE_WORDS,
    drop_text: bool = False,
) -> DataFrame:
    """``docs`` with the fingerprint (as a signed long) in ``out_col``, which replaces one of that name."""
    prepare(docs.sparkSession)
    base = docs.drop(out_col)
    fields = [f for f in base.schema.fields if not (drop_text and f.name == text_col)]
    schema = T.StructType([*fields, T.StructField(out_col, T.LongType())])

    def run(batches):
        for batch in batches:
            fp = pa.array(text_fingerprints(batch.column(text_col), shingle).view(np.int64))
            cols = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, fp], [*(f.name for f in fields), out_col])

    return base.mapInArrow(run, schema)


# ---------------------------------------------------------------- trie join


class _Forest:
    """Union-find over places 0..n-1 that keeps the links which joined two trees."""

    def __init__(self, n: int):
        self.root, self.links = np.arange(n), []

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        ra, rb = self.root[a], self.root[b]
        apart = ra != rb
        if not apart.any():
            return
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        _, one = np.unique(np.minimum(ra, rb) * len(self.root) + np.maximum(ra, rb), return_index=True)
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = parent.get(up, up)
                x = up
            return x

        for i, x, y in zip(one.tolist(), ra[one].tolist(), rb[one].tolist(), strict=True):
            x, y = find(x), find(y)
            if x != y:
                parent[max(x, y)] = min(x, y)
                self.links.append((int(a[i]), int(b[i])))
        if parent:
            moved = np.arange(len(self.root))
            for x in parent:
                moved[x] = find(x)
            self.root = moved[self.root]


def trie_links(keys: np.ndarray, lo: int, hi: int, lo2: int, hi2: int, budget: int, sink: _Forest, equal: int = 0) -> None:
    """Links within ``budget`` bits between keys[lo:hi] and keys[lo2:hi2] (the same range: within it).

    Of links whose ``equal`` leading bits aren't the same, only some are found.

    ``keys`` are sorted unsigned 64-bit numbers in each range. A trie node at some depth
    is a range of equal leading bits; the frontier holds node pairs with the bits by which they differ.
    """
    few = 64
    steps: dict[int, np.ndarray] = {}

    def split(a, b, depth):
        """Place of the first key of each range whose bit at ``depth`` is set."""
        if depth not in steps:
            head = keys >> np.uint64(63 - depth)
            runs = np.append(np.flatnonzero(head[1:] != head[:-1]) + 1, len(keys))
            after = np.repeat(runs, np.diff(runs, prepend=0))
            steps[depth] = np.where(head & np.uint64(1), np.arange(len(keys)), after)
        return np.minimum(steps[depth][a], b)

    def leaves(a, b, c, d):
        """Compare all keys of small node pairs."""
        na, nb = b - a, d - c
        total = na * nb
        at = np.repeat(np.arange(len(a)), total)
        place = np.arange(int(total.sum())) - np.repeat(np.cumsum(total) - total, total)
        i, j = a[at] + place // nb[at], c[at] + place % nb[at]
        hit = (np.bitwise_count(keys[i] ^ keys[j]) <= budget) & ((a[at] != c[at]) | (i < j))
        if hit.any():
            sink.add(i[hit], j[hit])

    stack = [(0, *(np.array([x]) for x in (lo, hi, lo2, hi2, 0)))]
    while stack:
        depth, a, b, c, d, err = stack.pop()
        if len(a) > _CHUNK:
            half = len(a) // 2
            stack.append((depth, *(x[half:] for x in (a, b, c, d, err))))
            a, b, c, d, err = (x[:half] for x in (a, b, c, d, err))
            stack.append((depth, a, b, c, d, err))
            continue
        small = (b - a) * (d - c) <= few if depth < 64 else np.ones(len(a), bool)
        if small.any():
            leaves(*(x[small] for x in (a, b, c, d)))
            a, b, c, d, err = (x[~small] for x in (a, b, c, d, err))
        if not len(a):
            continue
        same = a == c
        m, k = split(a, b, depth), split(c, d, depth)
        nxt = [
            (a, m, c, k, err, np.ones(len(a), bool)),
            (m, b, k, d, err, np.ones(len(a), bool)),
            (a, m, k, d, err + 1, np.full(len(a), depth >= equal)),
            (m, b, c, k, err + 1, ~same & (depth >= equal)),  # the mirror of the pair above where both nodes are one
        ]
        kept = []
        for x in nxt:
            ok = (x[0] < x[1]) & (x[2] < x[3]) & (x[4] <= budget) & x[5]
            kept.append([y[ok] for y in x[:5]])
        stack.append((depth + 1, *(np.concatenate(y) for y in zip(*kept, strict=True))))


# ---------------------------------------------------------------- distribution


def _turned(turn: int) -> Column:
    """The fingerprint with its bits turned left."""
    if not turn:
        return F.col("fp")
    return F.shiftleft("fp", turn).bitwiseOR(F.shiftrightunsigned("fp", 64 - turn))


def _light(p: np.ndarray, n: np.ndarray, top: int, bits: int, leaves: int) -> tuple[list[tuple[int, int]], list[int]]:
    """From counts by prefixes of ``bits`` bits: the highest subtrees below level ``top`` that hold at most
    ``leaves``, as (prefix, bits), and the prefixes that hold more."""
    order = np.argsort(p)
    p, total = p[order], np.append(0, np.cumsum(n[order]))
    light, heavy = [], []
    stack = [(q, top) for q in np.unique(p >> (bits - top)).tolist()]
    while stack:
        q, level = stack.pop()
        lo, hi = np.searchsorted(p, [q << (bits - level), (q + 1) << (bits - level)])
        if lo == hi:
            continue
        if total[hi] - total[lo] <= leaves:
            light.append((q, level))
        elif level == bits:
            heavy.append(q)
        else:
            stack += [(2 * q, level + 1), (2 * q + 1, level + 1)]
    return light, heavy


def _cut(fps: DataFrame, turns: list[int], first: int, leaves: int) -> list[list[tuple[int, int]]]:
    """For each turn of the bits, (prefix, bits) of subtrees that cover all fingerprints, each with few enough of them.

    The counts are summed up in Spark. The driver sees those by prefix: at most 2**first a turn, then
    2**CUT_STEP for each prefix that holds too many, of which there are at most all / leaves a turn.
    """
    spark = fps.sparkSession
    each = F.explode(F.array(*(F.struct(F.lit(t).alias("turn"), _turned(t).alias("key")) for t in turns)))
    keys = fps.select(each.alias("x")).select("x.turn", "x.key")
    done: dict[int, list[tuple[int, int]]] = {t: [] for t in turns}
    heavy, top, bits = None, 0, first
    while True:
        counts = keys.select("turn", F.shiftrightunsigned("key", 64 - bits).alias("p"))
        if heavy is not None:
            above = spark.createDataFrame(heavy, "turn int, q long")
            counts = counts.withColumn("q", F.shiftright("p", bits - top)).join(F.broadcast(above), ["turn", "q"], "left_semi")
        got = counts.groupBy("turn", "p").agg(F.count(F.lit(1)).alias("n")).toArrow()
        turn, p, n = (got[c].to_numpy() for c in ("turn", "p", "n"))
        heavy = []
        for t in turns:
            light, more = _light(p[turn == t], n[turn == t], top, bits, leaves)
            done[t] += light
            heavy += [(t, q) for q in more]
        if not heavy or bits + CUT_STEP > 63:
            for t, q in heavy:
                done[t].append((q, bits))
            return [sorted(done[t], key=lambda c: c[0] << (64 - c[1])) for t in turns]
        top, bits = bits, bits + CUT_STEP


def _pairs(cut: list[tuple[int, int]], block: int, budget: int) -> np.ndarray:
    """Pairs (i <= j) of subtrees to join: each with itself, and those within one block of leading
    bits whose common leading bits differ in at most ``budget`` places."""
    p, bits = np.array([c[0] for c in cut], np.uint64), np.array([c[1] for c in cut], np.uint64)
    out = [np.repeat(np.arange(len(cut)), 2).reshape(-1, 2)]
    deep = np.flatnonzero(bits > block)
    head = p[deep] >> (bits[deep] - np.uint64(block))
    edges = np.flatnonzero(np.diff(head)) + 1
    for own in np.split(deep, edges):  # the subtrees are in order, so a block's are together
        for k, i in enumerate(own[:-1].tolist()):
            j = own[k + 1 :]
            low = np.minimum(bits[j], bits[i])
            x = (p[i] >> (bits[i] - low)) ^ (p[j] >> (bits[j] - low))
            j = j[np.bitwise_count(x) <= budget]
            out.append(np.stack((np.full(len(j), i), j), axis=1))
    return np.concatenate(out)


def units(fps: DataFrame, max_bits: int, subtree_leaves: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """For each turn: (bits to the left, the subtrees' first keys, the pairs of subtrees to join)."""
    total, block = fps.count(), 64 // (max_bits + 1)
    leaves = max(subtree_leaves, total // MOST_SUBTREES)
    if total <= leaves:
        return [(0, np.zeros(1, np.uint64), np.zeros((1, 2), np.int64))]
    turns = [k * block for k in range(max_bits + 1)]
    return [
        (turn, np.array([p << (64 - b) for p, b in cut], np.uint64), _pairs(cut, block, max_bits))
        for turn, cut in zip(turns, _cut(fps, turns, min(FIRST_CUT, block), leaves), strict=True)
    ]


def _turn(keys: np.ndarray, turn: int) -> np.ndarray:
    return (keys << np.uint64(turn)) | (keys >> np.uint64(64 - turn)) if turn else keys


def fingerprint_links(fps: DataFrame, max_bits: int = MAX_BITS, subtree_leaves: int = SUBTREE_LEAVES) -> DataFrame:
    """Links (u, v) that join the distinct fingerprints ``fps`` (long column fp) as all links within ``max_bits`` do.

    Each unit of work returns a spanning forest of its links, so the components are those
    of the full set of links, with at most one row per fingerprint and unit. Links that an
    earlier turn's block has too are left to that turn's forest, and those that differ in the leading block
    to the turn in which they don't.
    """
    plan, block = units(fps, max_bits, subtree_leaves), 64 // (max_bits + 1)
    shared, equal = fps.sparkSession.sparkContext.broadcast(plan), block if len(plan) > 1 else 0
    names = ["unit", "side", "keys", "own", "turn"]

    def deal(batches):
        plan, before = [], 0
        for turn, begins, pairs in shared.value:
            uses = [[] for _ in begins]
            for k, (i, j) in enumerate(pairs.tolist()):
                uses[i].append((before + k, 0, int(i == j), turn))
                if j != i:
                    uses[j].append((before + k, 1, 0, turn))
            plan.append((turn, begins, uses))
            before += len(pairs)

        def emit(got):
            rows, size = [], 0
            for turn, begins, uses in plan:
                keys = np.sort(_turn(np.concatenate(got), turn))
                cell = np.searchsorted(begins, keys, side="right") - 1
                edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-2))
                for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    data = keys[s:e].tobytes()
                    for unit, side, own, _ in uses[cell[s]]:
                        rows.append((unit, side, data, own, turn))
                        size += len(data)
                        if len(rows) >= 4096 or size >= 8_000_000:
                            yield batch_of(rows)
                            rows, size = [], 0
            if rows:
                yield batch_of(rows)

        def batch_of(rows):
            kinds = (pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        got, held = [], 0
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            got.append(keys)
            held += len(keys)
            if held >= 1_000_000:
                yield from emit(got)
                got, held = [], 0
        if held:
            yield from emit(got)

    def join(table: pa.Table) -> pa.Table:
        sides = [[], []]
        for side, data in zip(table["side"].to_pylist(), table["keys"].to_pylist(), strict=True):
            sides[side].append(np.frombuffer(data, np.uint64))
        a = np.sort(np.concatenate(sides[0])) if sides[0] else np.zeros(0, np.uint64)
        b = np.sort(np.concatenate(sides[1])) if sides[1] else np.zeros(0, np.uint64)
        forest, keys = _Forest(len(a) + len(b)), np.concatenate((a, b))
        if table["own"][0].as_py():
            trie_links(keys, 0, len(a), 0, len(a), max_bits, forest, equal)
        elif len(a) and len(b):
            trie_links(keys, 0, len(a), len(a), len(keys), max_bits, forest, equal)
        ends = np.array(forest.links, np.int64).reshape(-1, 2)
        turn = table["turn"][0].as_py()
        u, v = (_turn(keys[ends[:, k]], 64 - turn if turn else 0) for k in (0, 1))
        new = np.ones(len(u), bool)
        for earlier in range(0, turn, block):
            new &= _turn(u ^ v, earlier) >> np.uint64(64 - block) != 0
        return pa.table({"u": u[new].view(np.int64), "v": v[new].view(np.int64)})

    dealt = fps.select("fp").mapInArrow(deal, "unit long, side int, keys binary, own int, turn int")
    return dealt.groupBy("unit").applyInArrow(join, "u long, v long")


def fingerprint_groups(rows: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """For each distinct fingerprint of ``rows`` (fp long, id): root (its component's least fingerprint) and
    component_id (the component's smallest id). ``rows`` should be a stored table: it is read three times."""
    distinct = staged(rows.groupBy("fp").agg(F.min("id").alias("id")), "fps")
    roots = components(fingerprint_links(distinct, max_bits))
    roots = staged(roots.select(F.col("node").alias("fp"), "root"), "roots")
    named = distinct.join(roots, "fp", "left").select("fp", "id", F.coalesce("root", "fp").alias("root"))
    least = named.groupBy("root").agg(F.min("id").alias("component_id"))
    return named.join(least, "root").select("fp", "root", "component_id")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row of ``docs``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = staged(with_fingerprint(rows, "text", "fp", shingle, drop_text=True), "fingerprints")
    out = rows.join(fingerprint_groups(rows, max_bits), "fp")
    return out.select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """One row of each component: the one with the smallest id (of repeated rows, one). Same columns as ``docs``."""
    taken, fp, row = {c.lower() for c in docs.columns}, "__fp", "__row"
    while {fp, row} & taken:  # names that no column of the input has
        fp, row = f"_{fp}", f"_{row}"
    marked = with_fingerprint(docs, text_col, fp, shingle)
    rows = staged(marked.withColumn(row, F.monotonically_increasing_id()), "marked")
    keys = rows.select(F.col(fp).alias("fp"), F.col(id_col).alias("id"), F.col(row).alias("row"))
    groups = fingerprint_groups(keys.select("fp", "id"), max_bits)
    rank = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    first = keys.groupBy("fp").agg(F.min(rank).alias("first"))
    kept = first.join(groups, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = staged(kept.select(F.col("first.row").alias(row)), "kept")
    # A merge join at every size: one shuffle of the rows, whichever rows remain.
    return rows.join(kept.hint("merge"), row, "left_semi").select(*docs.columns)
