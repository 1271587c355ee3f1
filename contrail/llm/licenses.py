"""License scans: ordered signature rules behind a keyword prefilter.

1. Texts become lower-cased words (digits, letters and everything beyond ASCII); word hashes tell
   which texts hold a rule's keyword or the first word of a base phrase, and where. All others are done.
2. Around each keyword (REACH words to both sides) the rules of that keyword run over the words, joined
   by single spaces. Any match of a rule holds one of its keywords, and no rule spans more words than REACH, so the
   result is that of every rule on the whole text.
3. Overlapping detections are resolved: the longer interval suppresses those that it contains (of
   equal ones the earlier rule wins), and of two that overlap otherwise with different labels the
   earlier rule stays.

Base phrases are sought word by word, apart from the rules, and their labels always stay. The score is the
chance that at least one of the remaining labels is right, if the rules' weights were independent.

Null text reads as empty: no words, no labels (empty strings), null first and last word, score 0. Null ids
and repeated rows stay. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from contrail.llm.license_rules import gates, rules
from contrail.llm.textvec import SIGNS, Words, prepare, span_hashes, text_slices

#: (label, phrase); fixed values.
BASE = (("mit", "under the mit license"), ("apache-2", "apache license version 2"), ("cc-by-nc", "cc by nc"))
REACH = 40
SPAN = T.ArrayType(T.StructType([
    T.StructField("label", T.StringType()), T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
]))


@cache
def _compiled() -> tuple[dict[tuple[str, ...], list[tuple]], dict[str, list[tuple[str, ...]]]]:
    """(rules by their keywords, the sets of keywords that each word belongs to)."""
    by_keywords, sets = defaultdict(list), defaultdict(list)
    for order, (keywords, (_, label, weight, pattern)) in enumerate(zip(gates(), rules(), strict=True)):
        if keywords not in by_keywords:
            for word in keywords:
                sets[word].append(keywords)
        by_keywords[keywords].append((order, label, weight, re.compile(pattern)))
    return dict(by_keywords), dict(sets)


def _hash(words: list[str]) -> np.ndarray:
    data = [np.frombuffer(w.encode(), np.uint8) for w in words]
    return np.concatenate([span_hashes(d, np.array([0]), np.array([len(d)])) for d in data]) if data else np.zeros(0, np.uint64)


@cache
def _gate():
    """Sorted hashes of all keywords and first words of phrases."""
    names = sorted({*_compiled()[1], *(p.split()[0] for _, p in BASE)})
    h = _hash(names)
    order = np.argsort(h)
    return h[order], [names[i] for i in order]


def _resolve(found: list[tuple]) -> list[tuple]:
    """found: (first, last, rule order, label, weight) with last exclusive; what remains, in order of place."""
    kept: list[tuple] = []
    # By place, the longer first: one that contains another comes before it and ends no earlier.
    for d in sorted(set(found), key=lambda d: (d[0], -d[1], d[2])):
        if not kept or d[1] > kept[-1][1]:
            kept.append(d)
    # Both ends now rise along the list, so whatever overlaps a detection stands right beside it, and starts
    # being distinct, there are no more of those than a detection has words.
    stays = [False] * len(kept)

    def clash(i: int, step: int) -> bool:
        a, b, _, label, _ = kept[i]
        j = i + step
        while 0 <= j < len(kept) and a < kept[j][1] and kept[j][0] < b:
            if stays[j] and kept[j][3] != label:
                return True
            j += step
        return False

    for i in sorted(range(len(kept)), key=lambda i: (kept[i][2], kept[i][0])):
        stays[i] = not clash(i, -1) and not clash(i, 1)
    return [d for d, stay in zip(kept, stays, strict=True) if stay]


def scan_text(words: list[str], hits: list[tuple[int, str]]) -> tuple[list[tuple[int, str]], list[tuple]]:
    """Base places (first word, label) and detections of one text.

    ``hits`` are (place, keyword) of its words that are keywords, in order of place.
    """
    base = []
    for place, word in hits:
        for label, phrase in BASE:
            p = phrase.split()
            if word == p[0] and words[place : place + len(p)] == p:
                base.append((place, label))
    found, (table, sets) = [], _compiled()
    windows: dict[tuple[str, ...], list[tuple[int, int]]] = {}
    for place, word in hits:  # windows around the keywords of a set, joined where they meet
        for keywords in sets.get(word, ()):
            spans = windows.setdefault(keywords, [])
            a, b = max(0, place - REACH), min(len(words), place + REACH + 1)
            if spans and a <= spans[-1][1]:
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
    for keywords, spans in windows.items():
        for a, b in spans:
            text = " ".join(words[a:b])
            starts = np.cumsum([0, *(len(w) + 1 for w in words[a:b])])
            for order, label, weight, pattern in table[keywords]:
                for m in pattern.finditer(text):
                    first = a + int(np.searchsorted(starts, m.start(), side="right")) - 1
                    last = a + int(np.searchsorted(starts, m.end() - 1, side="right"))
                    found.append((first, last, order, label, weight))
    return base, _resolve(found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_spans: bool = False) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score[, detections]) of every row."""
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    longs = ("n_words", "n_base", "first_word", "last_word")
    fields = [T.StructField(id_col, id_type), *(T.StructField(c, T.LongType()) for c in longs),
              T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType())]
    if keep_spans:
        fields.append(T.StructField("detections", SPAN))
    schema = T.StructType(fields)

    def run(batches):
        gate, names = _gate()
        for batch in batches:
            rows: list[tuple] = []
            for _, data, offsets in text_slices(batch.column(text_col)):
                w = Words(data, offsets, separators=SIGNS)
                h = w.hashes()
                at = np.searchsorted(gate, h)
                at[at == len(gate)] = 0
                hit = np.flatnonzero(gate[at] == h)
                hit_bounds = np.searchsorted(hit, w.first_word).tolist()
                counts = w.counts.tolist()
                for d in range(len(counts)):
                    n = counts[d]
                    a, b = hit_bounds[d], hit_bounds[d + 1]
                    if a == b:
                        rows.append((n, 0, None, None, "", "", 0.0, []))
                        continue
                    first = int(w.first_word[d])
                    own = slice(first, first + n)
                    words = [w.bytes[s:e].tobytes().decode("utf-8", "replace") for s, e in
                             zip(w.starts[own].tolist(), w.ends[own].tolist(), strict=True)]
                    hits = [(int(i) - first, names[at[i]]) for i in hit[a:b]]
                    hits = [(i, k) for i, k in hits if words[i] == k]
                    base, found = scan_text(words, hits)
                    base_labels = {label for _, label in base}
                    labels = base_labels | {f[3] for f in found}
                    miss = 0.02 if base else 1.0
                    for f in found:
                        miss *= 1 - f[4]
                    places = [p for p, _ in base]
                    rows.append((n, len(base), min(places, default=None), max(places, default=None), ",".join(sorted(base_labels)),
                                 ",".join(sorted(labels)), 1 - miss if labels else 0.0,
                                 [{"label": f[3], "first_word": f[0], "last_word": f[1] - 1} for f in found]))
            cols = list(zip(*rows, strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            arrays = [batch.column(id_col), *(pa.array(c, t) for c, t in zip(cols, kinds, strict=False))]
            if keep_spans:
                span = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())]))
                arrays.append(pa.array(cols[7], span))
            yield pa.RecordBatch.from_arrays(arrays, schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)
