"""Vectorised splitting of texts into the pre-tokens of a byte-level BPE.

``split_points`` finds where the matches of ``public_tokenizers.PATTERN`` begin,
from character classes alone (the pattern has six kinds of match: contraction,
letters, digits, other signs, each with at most one space before, and two kinds of
white space). tests/llm checks it against the pattern itself.
"""

from __future__ import annotations

import base64
import json
import os
from functools import cache

import numpy as np
import pyarrow as pa

from contrail.llm.textvec import span_hashes, text_slices

_OTHER, _LETTER, _DIGIT, _WHITE = 0, 1, 2, 3
#: Words up to this many characters are known by a 64-bit hash, longer ones by their text.
HASHED_CHARS = 48


@cache
def _classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    table = np.zeros(0x110000, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_WHITE, r"\s+")):
        for m in regex.finditer(pattern, every):
            run = np.frombuffer(m.group().encode("utf-32-le"), np.uint32)
            table[run] = kind
    return table


@cache
def ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@cache
def encoding(path: str):
    """The library's encoder over a rank file, without special tokens."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={})


def split_points(chars: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Start places of all pre-tokens of texts held as code points, ``offsets`` bounding the texts."""
    n = len(chars)
    if not n:
        return np.zeros(0, np.int64)
    kind = _classes()[chars]
    begins = np.zeros(n + 1, bool)
    begins[offsets[:-1]] = True
    begins[n] = True
    before = np.empty(n, np.uint8)
    before[0], before[1:] = 255, kind[:-1]
    before[begins[:n]] = 255
    white = kind == _WHITE
    start = (kind != before) & ~white & (before != _WHITE)  # a change of class between signs that aren't white
    start |= white & (before != _WHITE)  # a run of white space begins
    last_white = white.copy()
    last_white[:-1] &= ~white[1:]
    last_white &= ~begins[1:]  # of a run with something after it
    start |= last_white
    after_white = np.flatnonzero(last_white) + 1
    start[after_white[chars[after_white - 1] != 0x20]] = True
    start |= begins[:n]
    quote = np.flatnonzero(start & (chars == 0x27))
    if len(quote):
        # The two characters after each quote, as far as the text goes.
        end = offsets[np.searchsorted(offsets, quote, side="right")]
        one = np.where(quote + 1 < end, chars[np.minimum(quote + 1, n - 1)], 0)
        two = np.where(quote + 2 < end, chars[np.minimum(quote + 2, n - 1)], 0)
        short = np.isin(one, [ord(c) for c in "stmd"])
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        hit = short | long
        quote, size = quote[hit], np.where(short, 2, 3)[hit]
        start[quote + 1] = False
        after = quote + size
        after = after[~begins[after]]
        # A lone space after it belongs to the next match, and white space has its own starts already.
        start[after[kind[after] != _WHITE]] = True
    return np.flatnonzero(start)


class PreTokens:
    """The pre-tokens of some texts: places, text of each, hash and distinct ones."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        text = data.tobytes().decode("utf-8", "replace")
        chars = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        # Character places of the texts' bounds: bytes that aren't continuations, counted.
        lead = np.zeros(len(data) + 1, np.int64)
        np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
        self.text, self.chars, self.bounds = text, chars, lead[offsets]
        self.starts = split_points(chars, self.bounds)
        self.ends = np.append(self.starts[1:], len(chars)) if len(self.starts) else self.starts
        self.first = np.searchsorted(self.starts, self.bounds)  # of each text, and the total
        self.hash = span_hashes(chars, self.starts, self.ends)

    @classmethod
    def of_words(cls, words: list[str]) -> PreTokens:
        """Given pre-tokens, not split again."""
        pre = cls.__new__(cls)
        pre.text = "".join(words)
        pre.chars = np.frombuffer(pre.text.encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))
        pre.starts, pre.ends = np.concatenate(([0], ends[:-1])), ends
        pre.bounds, pre.first = np.array([0, len(pre.chars)]), np.array([0, len(words)])
        pre.hash = span_hashes(pre.chars, pre.starts, pre.ends)
        return pre

    def __getitem__(self, i: int) -> str:
        return self.text[self.starts[i] : self.ends[i]]


class Coder:
    """What a codec makes of pre-tokens, each distinct one coded once and kept while there is room.

    ``code`` turns a list of pre-tokens into payloads, each (size for each pre-token, all values in
    order); the first payload is the ids. The store is an open-addressing table from hash to place
    in the payloads' arrays. When it holds ``most`` words, those that were looked up only once
    leave, so its memory doesn't grow with the input.
    """

    SLOT_BITS = 22

    def __init__(self, code, most: int = 1_200_000):
        self.code, self.most = code, most
        self.keys, self.uses, self.payloads = np.zeros(0, np.uint64), np.zeros(0, np.int64), None
        self.slot = np.full(1 << self.SLOT_BITS, -1, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.SLOT_BITS)).astype(np.int64)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key among those held, -1 for an unknown one."""
        found = np.full(len(keys), -1, np.int32)
        place, pending = self._place(keys), np.arange(len(keys))
        while len(pending):
            index = self.slot[place]
            hit = index >= 0
            hit[hit] = self.keys[index[hit]] == keys[pending[hit]]
            found[pending[hit]] = index[hit]
            go_on = (index >= 0) & ~hit
            pending, place = pending[go_on], (place[go_on] + 1) & (len(self.slot) - 1)
        return found

    def _enter(self, index: np.ndarray) -> None:
        """Fill the slots of the keys at ``index``."""
        place = self._place(self.keys[index])
        while len(index):
            free = self.slot[place] < 0
            self.slot[place[free]] = index[free]
            lost = self.slot[place] != index
            index, place = index[lost], (place[lost] + 1) & (len(self.slot) - 1)

    def _shrink(self) -> None:
        """Keep the words used most, half of ``most`` of them at the most."""
        often = np.flatnonzero(self.uses > 1)
        if len(often) > self.most // 2:
            often = np.sort(often[np.argsort(-self.uses[often], kind="stable")[: self.most // 2]])
        self.keys, self.uses = self.keys[often], np.ones(len(often), np.int64)
        for k, (at, size, data) in enumerate(self.payloads):
            at, size = at[often], size[often]
            ends = np.cumsum(size)
            self.payloads[k] = (ends - size, size, _gather(data, at, size))
        self.slot[:] = -1
        self._enter(np.arange(len(often), dtype=np.int32))

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Keep new, distinct keys."""
        got = self.code(words)
        if self.payloads is None:
            self.payloads = [(np.zeros(0, np.int64), np.zeros(0, np.int64), data[:0]) for _, data in got]
        for k, (size, data) in enumerate(got):
            at0, size0, data0 = self.payloads[k]
            at = len(data0) + np.cumsum(size) - size
            self.payloads[k] = (np.concatenate((at0, at)), np.concatenate((size0, size)), np.concatenate((data0, data)))
        index = np.arange(len(self.keys), len(self.keys) + len(keys), dtype=np.int32)
        self.keys = np.concatenate((self.keys, keys))
        self.uses = np.concatenate((self.uses, np.zeros(len(keys), np.int64)))
        self._enter(index)

    def lookup(self, pre: PreTokens) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each payload: place and size of each pre-token's values, and the values."""
        if not len(pre.starts):
            return [(np.zeros(0, np.int64), np.zeros(0, np.int64), x[2]) for x in self.payloads or []]
        long = pre.ends - pre.starts > HASHED_CHARS
        if len(self.keys) + len(pre.starts) > self.most and len(self.keys) > self.most // 2:
            self._shrink()
        found = self._find(pre.hash)
        unknown = np.flatnonzero((found < 0) & ~long)
        if len(unknown):
            keys, first = np.unique(pre.hash[unknown], return_index=True)
            self._learn(keys, [pre[i] for i in unknown[first].tolist()])
            found[unknown] = self._find(pre.hash[unknown])
        short, far = found[~long], np.flatnonzero(long)
        if 8 * len(short) < len(self.keys):  # an edit's few words shouldn't cost a pass over the store
            np.add.at(self.uses, short, 1)
        else:
            self.uses += np.bincount(short, minlength=len(self.keys))
        extra = None
        if len(far):
            texts = [pre[i] for i in far.tolist()]
            distinct = {t: k for k, t in enumerate(dict.fromkeys(texts))}
            extra = self.code(list(distinct))
            which = np.array([distinct[t] for t in texts])
        out = []
        for k in range(len(self.payloads or extra)):
            at, size, data = self.payloads[k] if self.payloads else (np.zeros(1, np.int64), np.zeros(1, np.int64), extra[k][1][:0])
            place, n = at[found], size[found]
            if extra:
                more, values = extra[k]
                place[far], n[far] = (len(data) + np.cumsum(more) - more)[which], more[which]
                data = np.concatenate((data, values))
            out.append((place, n, data))
        return out

    def ids_of(self, pre: PreTokens, payload: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in order, and the bounds of each text in them."""
        return self.spread(pre, self.lookup(pre))[payload]

    def spread(self, pre: PreTokens, found: list) -> list[tuple[np.ndarray, np.ndarray]]:
        """The payloads' values in text order, and the bounds of each text in them."""
        out = [(_gather(data, at, n), np.concatenate(([0], np.cumsum(n)))[pre.first]) for at, n, data in found]
        return out or [(np.zeros(0, np.uint32), np.zeros(len(pre.bounds), np.int64))] * 2


def _gather(data: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """data[at:at + size] of all pairs, one after another."""
    ends = np.cumsum(size)
    if not len(ends) or not ends[-1]:
        return data[:0]
    return data[np.repeat(at - (ends - size), size) + np.arange(ends[-1])]


def encode_words(words: list[str], encode, widths: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(number of ids of each pre-token, all ids)] with few calls of a library.

    ``encode`` gives a text's ids and ``widths`` each id's bytes. Pre-tokens of letters are
    encoded many at a time: with a space before them they stay apart in one text; without, a line
    feed, itself one id, parts them. All others are encoded one by one.
    """
    sizes, parts = np.zeros(len(words), np.int64), [None] * len(words)
    spaced, bare, rest = [], [], []
    for i, w in enumerate(words):
        (spaced if w[0] == " " and w[1:].isalpha() else bare if w.isalpha() else rest).append(i)
    for which, mark in ((spaced, ""), (bare, "\n")):
        for k in range(0, len(which), 20_000):
            some = which[k : k + 20_000]
            ids = np.asarray(encode(mark.join([*(words[i] for i in some), ""])), np.uint32)
            ends = np.cumsum(widths[ids])
            stop = np.cumsum([len(words[i].encode()) + len(mark) for i in some])
            bounds = np.searchsorted(ends, stop, side="left") + 1
            if not np.array_equal(ends[bounds - 1], stop):  # a sign that the library splits otherwise
                rest += some
                continue
            start = np.concatenate(([0], bounds[:-1]))
            for i, s, e in zip(some, start.tolist(), (bounds - len(mark)).tolist(), strict=True):
                parts[i] = ids[s:e]
    for i in rest:
        parts[i] = np.asarray(encode(words[i]), np.uint32)
    sizes[:] = [len(x) for x in parts]
    return [(sizes, np.concatenate(parts).astype(np.uint32))]


@cache
def id_widths(path: str) -> np.ndarray:
    """Bytes of each id of a rank file."""
    table = ranks(path)
    out = np.zeros(max(table.values()) + 1, np.int64)
    for token, rank in table.items():
        out[rank] = len(token)
    return out


def public_file(name: str) -> str:
    """A file by its path, or a public tokenizer's file by its bare name."""
    import public_tokenizers

    return name if os.path.sep in name else public_tokenizers.path(name)


@cache
def rank_coder(name: str) -> Coder:
    """A Coder over a rank file, kept by the worker from task to task."""
    path = public_file(name)
    encode = encoding(path).encode_ordinary
    return Coder(lambda words: encode_words(words, encode, id_widths(path)))


@cache
def added_tokens(name: str) -> dict[str, int]:
    """Text and id of the added tokens in the .json file beside a rank file; none without such a file."""
    path = os.path.splitext(public_file(name))[0] + ".json"
    if not os.path.exists(path):
        return {}
    with open(path, encoding="utf-8") as f:
        listed = json.load(f)["added_tokens"]
    for t in listed:
        if any(t.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"{path}: the added token {t['content']!r} isn't matched as plain text")
    return {t["content"]: t["id"] for t in listed}


def batches(column: pa.Array | pa.ChunkedArray):
    """(first row, PreTokens) over slices of a text column."""
    for row, data, offsets in text_slices(column):
        yield row, PreTokens(data, offsets)
