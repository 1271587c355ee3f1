"""Edit-aware token counts: a segment tree of pre-tokens for each document.

A leaf holds the sizes of about LEAF pre-tokens, in characters and in tokens; every inner node holds
the sums of its two children, the root those of the document. An edit finds its place by going
down the character sums, splits anew only the touched region with a few characters of context before it,
up to the first place where new and old pre-token bounds meet again, re-encodes that region and adds the changes
to the sums on the way to the root.

Why that suffices: a match of the pre-token pattern depends on its own characters and at most
CONTEXT more after it, and on nothing before it. So bounds that lie CONTEXT before the edit stay, and from the
first common bound behind the edit on, all later ones are the same.

Null text reads as empty: no tokens. Edits beyond the text are cut to its length, an edit with null
positions or null text counts as one with the text's end or an empty text. Null ids and repeated
rows stay, each on its own. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.pretoken import batches, encoding, public_file, rank_coder, split_points
from contrail.llm.textvec import prepare

RANK_FILE = "byte_bpe_50k.tiktoken"
LEAF, CONTEXT, REACH = 32, 3, 48
#: Words of edits whose sizes a task keeps.
EDIT_WORDS = 100_000
EDITS = "array<struct<start:int,stop:int,text:string>>"


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


class SegmentTree:
    """Pre-token sizes of one text; ``count`` gives the tokens of each pre-token of a list."""

    def __init__(self, text: str, chars: np.ndarray, tokens: np.ndarray, count):
        self.text, self.count, self.reencoded = text, count, 0
        self._build(chars, tokens)

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        cuts = np.arange(LEAF, max(len(chars), 1), LEAF)
        self.chars, self.tokens = np.split(chars, cuts), np.split(tokens, cuts)
        self.width = 1 << (len(self.chars) - 1).bit_length()
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        at = np.arange(0, len(chars), LEAF)
        if len(at):
            self.sums[self.width : self.width + len(at), 0] = np.add.reduceat(chars, at)
            self.sums[self.width : self.width + len(at), 1] = np.add.reduceat(tokens, at)
        low = self.width
        while low > 1:
            self.sums[low // 2 : low] = self.sums[low : 2 * low : 2] + self.sums[low + 1 : 2 * low : 2]
            low //= 2

    @property
    def total(self) -> int:
        return int(self.sums[1, 1])

    @property
    def n_pretokens(self) -> int:
        return sum(map(len, self.chars))

    def _leaf(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character ``place`` (the last one beyond the end), and its first character."""
        node, first = 1, 0
        while node < self.width:
            node *= 2
            left = int(self.sums[node, 0])
            if place >= first + left:
                first, node = first + left, node + 1
        leaf = min(node - self.width, len(self.chars) - 1)
        if leaf != node - self.width:  # beyond the last leaf
            first -= int(self.sums[self.width + leaf, 0])
        return leaf, first

    def _set(self, leaf: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.chars[leaf], self.tokens[leaf] = chars, tokens
        node = self.width + leaf
        change = np.array([chars.sum(), tokens.sum()], np.int64) - self.sums[node]
        while node:
            self.sums[node] += change
            node //= 2

    def edit(self, start: int | None, stop: int | None, text: str | None) -> None:
        """Replace the characters from ``start`` up to ``stop`` by ``text``."""
        n = len(self.text)
        start = n if start is None else min(max(start, 0), n)
        stop = n if stop is None else min(max(stop, start), n)
        text = text or ""
        new = self.text[:start] + text + self.text[stop:]
        shift = len(new) - n
        # The last bound at least CONTEXT characters before the edit.
        leaf, first = self._leaf(max(start - CONTEXT, 0))
        bounds = first + np.concatenate(([0], np.cumsum(self.chars[leaf])))
        k = max(int(np.searchsorted(bounds, start - CONTEXT, side="right")) - 1, 0)
        if start - CONTEXT < bounds[0]:
            k = 0
        begin = int(bounds[k]) if start >= CONTEXT else 0
        if begin == 0 and start < CONTEXT:
            leaf, first, k = 0, 0, 0
        # Old bounds from there, leaf by leaf, until the new split meets one of them behind the edit.
        reach = REACH
        while True:
            end = min(start + len(text) + reach, len(new))
            split = begin + split_points(_chars(new[begin:end]), np.array([0, end - begin]))
            split = split[split <= end - CONTEXT] if end < len(new) else np.append(split, len(new))
            found = split[split >= start + len(text)]
            last, place, old, held = leaf, first, [first], []
            while last < len(self.chars) and place <= end - shift:
                own = place + np.cumsum(self.chars[last])
                old.extend(own.tolist())
                place = int(own[-1]) if len(own) else place
                held.append(last)
                last += 1
            bounds = set(old)
            meet = next((x for x in (found - shift).tolist() if x >= stop and x in bounds), None)
            if meet is not None:
                break
            reach *= 4
        # What remains of the touched leaves: pre-tokens before ``begin`` and from ``meet`` on.
        chars = np.concatenate([self.chars[i] for i in held])
        tokens = np.concatenate([self.tokens[i] for i in held])
        ends = first + np.cumsum(chars)
        before = int(np.searchsorted(ends, begin, side="right"))
        after = int(np.searchsorted(ends, meet, side="right"))
        split = split[split <= meet + shift].tolist()
        words = [new[s:e] for s, e in zip(split[:-1], split[1:], strict=True)]
        self.reencoded += len(words)
        chars = np.concatenate((chars[:before], [len(w) for w in words], chars[after:])).astype(np.int64)
        tokens = np.concatenate((tokens[:before], self.count(words), tokens[after:])).astype(np.int64)
        self.text = new
        none = np.zeros(0, np.int64)
        for i in held[1:]:
            self._set(i, none, none)
        self._set(held[0], chars, tokens)
        if len(chars) > 8 * LEAF:  # sizes are kept, nothing is encoded again
            self._build(np.concatenate(self.chars), np.concatenate(self.tokens))


def count_with_edits(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", edits_col: str = "edits", rank_file: str = RANK_FILE,
    keep_text: bool = False,
) -> DataFrame:
    """(id, n_tokens, n_pretokens, n_edits, n_tokens_edited, n_reencoded[, edited_text]) of every row.

    ``edits_col`` holds an array of (start, stop, text), applied one after another to the text as it then is.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    names = ["n_tokens", "n_pretokens", "n_edits", "n_tokens_edited", "n_reencoded"]
    fields = [T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in names)]
    if keep_text:
        fields.append(T.StructField("edited_text", T.StringType()))
    schema = T.StructType(fields)

    def run(rows):
        # Whole texts go through the store of pre-tokens, an edit's few words straight to the library.
        coder, encode, sizes_of = rank_coder(rank_file), encoding(public_file(rank_file)).encode_ordinary, {}

        def count(words: list[str]) -> np.ndarray:
            new = list({w for w in words if w not in sizes_of})
            if new:
                if len(sizes_of) > EDIT_WORDS:
                    sizes_of.clear()
                    new = list(set(words))
                sizes_of.update((w, len(encode(w))) for w in new)
            return np.array([sizes_of[w] for w in words], np.int64)

        for batch in rows:
            ids, all_edits, out, texts = batch.column("id").to_pylist(), batch.column("edits").to_pylist(), [], []
            for row, pre in batches(batch.column("text")):
                sizes = coder.lookup(pre)[0][1] if len(pre.starts) else np.zeros(0, np.int64)
                chars = pre.ends - pre.starts
                for k in range(len(pre.bounds) - 1):
                    a, b = pre.first[k], pre.first[k + 1]
                    tree = SegmentTree(pre.text[pre.bounds[k] : pre.bounds[k + 1]], chars[a:b], sizes[a:b], count)
                    edits = all_edits[row + k] or []
                    before, words = tree.total, int(b - a)
                    for e in edits:
                        if e is not None:
                            tree.edit(e["start"], e["stop"], e["text"])
                    out.append((ids[row + k], before, words, len(edits), tree.total, tree.reencoded))
                    if keep_text:
                        texts.append(tree.text)
            cols = list(zip(*out, strict=True)) or [()] * 6
            arrays = [pa.array(cols[0], batch.column("id").type), *(pa.array(c, pa.int64()) for c in cols[1:])]
            if keep_text:
                arrays.append(pa.array(texts, pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    edits = F.col(edits_col).cast(EDITS).alias("edits")
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), edits).mapInArrow(run, schema)


def with_edits(docs: DataFrame, edits: DataFrame, id_col: str = "doc_id", order_col: str = "seq") -> DataFrame:
    """``docs`` with an array column ``edits`` from a table of edits (id, seq, start, stop, text), in order of seq."""
    each = edits.groupBy(F.col(id_col).alias("__id")).agg(
        F.sort_array(F.collect_list(F.struct(order_col, "start", "stop", "text"))).alias("e")
    )
    each = each.select("__id", F.transform("e", lambda x: F.struct(x["start"], x["stop"], x["text"])).cast(EDITS).alias("edits"))
    return docs.drop("edits").join(each, F.col(id_col) == F.col("__id"), "left").drop("__id")
