"""Secret scans: fixed patterns, and a battery of randomness tests over everything that looks encoded.

1. Base spans, per kind leftmost and not overlapping: ``assign`` (a name of a secret, a sign, a value), ``access``
   (key ids), ``hex`` (long runs of hex digits).
2. Candidates: maximal runs of 20 or more signs of an encoding (letters, digits, ``+ / _ -``), and the alphanumeric
   runs of that length inside them. Candidates that overlap a base span are reported there already and left out.
3. Battery. The signs that a candidate uses tell its encoding (decimal, hex, base32, letters, base36, base62,
   base64) and so each sign's value. Three tests look at the values:

   * chi-squared of the alphabet's uniformity,
   * runs above and below the alphabet's middle,
   * serial correlation of neighbours.

   A candidate must not be refused as random by any of them (two-sided, ``VETO_Z``). What remains is weighed against
   ordinary text, test by test: its alphabet is at least as uneven as that of words (coincidence ``WORD_COINCIDENCE``,
   a noncentral chi-squared whose weight grows with the length), or its runs or its correlation depart by ``EFFECT``
   or more of what is possible. The p-value is the largest of the three, so each kind of order is excluded by itself.
4. False discoveries. Short candidates are many and weak, long ones few and strong, so the Benjamini-Hochberg bound is found for
   each length class (powers of two) apart, over the candidates of all documents: counts by class and tenth of log10 p, a
   table of bounded size, are all that reaches the driver. The rate ``FALSE_RATE`` holds in each class.

A flagged run suppresses the flagged runs inside it. Copies of a text count as often as they occur.

Null text reads as empty: no span, zero counts, empty strings. Null ids and repeated rows stay as rows of their own;
other columns, whatever their names, take no part. A text of any length is scanned as a whole. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.staging import staged
from contrail.llm.textvec import prepare, text_slices

# The base kinds in order, their patterns and least lengths.
BASE_KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 6, 20, 24
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")

LEAST = 20
VETO_Z = 3.29
WORD_COINCIDENCE = 0.06
EFFECT = 0.8
FALSE_RATE = 0.05
MAX_BIN = 400


def _mask(text: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(text.encode())] = True
    return out


_DIGITS, _UP = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOW = _UP.lower()
#: Encodings in the order of inference: the first whose alphabet holds all signs of a candidate.
ENCODINGS = (
    ("random-decimal", _DIGITS), ("random-hex", _DIGITS + "abcdef"), ("random-hex", _DIGITS + "ABCDEF"), ("random-base32", _UP + "234567"),
    ("random-letters", _LOW), ("random-letters", _UP + _LOW), ("random-base36", _DIGITS + _LOW), ("random-base36", _DIGITS + _UP),
    ("random-base62", _UP + _LOW + _DIGITS), ("random-base64", _UP + _LOW + _DIGITS + "+/"), ("random-base64", _UP + _LOW + _DIGITS + "-_"),
    ("random-base64", _UP + _LOW + _DIGITS + "+/-_"),
)
KINDS = (*BASE_KINDS, *dict.fromkeys(name for name, _ in ENCODINGS))
_ALNUM, _SIGN = _mask(_DIGITS + _UP + _LOW), _mask(_DIGITS + _UP + _LOW + "+/_-")
_HEX, _CAPS = _mask(_DIGITS + "abcdef"), _mask(_DIGITS + _UP)
_VALUES = np.full((len(ENCODINGS), 256), -1, np.int64)
for _e, (_, _alphabet) in enumerate(ENCODINGS):
    _VALUES[_e, list(_alphabet.encode())] = np.arange(len(_alphabet))
_SIZES = np.array([len(a) for _, a in ENCODINGS])
_KIND_OF = np.array([KINDS.index(name) for name, _ in ENCODINGS])


def runs_of(inside: np.ndarray, offsets: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of at least ``least`` bytes, none across a text's bound."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edge = offsets[(offsets > 0) & (offsets < n)]
    before[edge], after[edge - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def base_spans(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows (start, kind, end) in bytes, by start and kind."""
    found = []
    signs = np.flatnonzero((data == ord(":")) | (data == ord("=")))
    for d in np.unique(np.searchsorted(offsets, signs, side="right") - 1).tolist():
        text = data[offsets[d] : offsets[d + 1]].tobytes()
        low = text.lower()
        if any(k in low for k in (b"passw", b"secret", b"token", b"api")):
            at = int(offsets[d])
            found += [(at + m.start(), 0, at + m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    for s, e in zip(*(x.tolist() for x in runs_of(_CAPS[data], offsets, ACCESS_LEAST)), strict=True):
        m = ACCESS.search(data[s:e].tobytes())
        if m and m.end() - m.start() >= ACCESS_LEAST:
            found.append((s + m.start(), 1, s + m.end()))
    found += [(s, 2, e) for s, e in zip(*(x.tolist() for x in runs_of(_HEX[data], offsets, HEX_LEAST)), strict=True)]
    return np.array(sorted(found), np.int64).reshape(-1, 3)


def infer(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The encoding of each run: index into ENCODINGS."""
    out = np.full(len(starts), len(ENCODINGS) - 1)
    for e in range(len(ENCODINGS) - 2, -1, -1):
        outside = np.concatenate(([0], np.cumsum(_VALUES[e][data] < 0)))
        out[outside[ends] == outside[starts]] = e
    return out


def _log10_phi(z: np.ndarray) -> np.ndarray:
    """log10 of the normal distribution function."""
    out = np.empty(len(z))
    for i, x in enumerate(z.tolist()):
        if x > -30:
            out[i] = math.log10(max(0.5 * math.erfc(-x / math.sqrt(2)), 1e-300))
        else:
            out[i] = -x * x / 2 / math.log(10)
    return out


def battery(values: np.ndarray, size: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """log10 of the p-value of each sequence; ``values`` holds them one after another, ``size`` their lengths (2 or more)."""
    c = len(size)
    if not c:
        return np.zeros(0)
    n, k = size.astype(float), alphabet.astype(float)
    which = np.repeat(np.arange(c), size)
    start = np.cumsum(size) - size
    # Uniformity.
    counts = np.bincount(which * 66 + values, minlength=c * 66).reshape(c, 66).astype(float)
    x = k / n * (counts**2).sum(1) - n
    r, lam = k - 1, n * np.maximum(0.5, k * WORD_COINCIDENCE - 1)
    z_uniform = ((x / r) ** (1 / 3) - (1 - 2 / (9 * r))) / np.sqrt(2 / (9 * r))
    h = 1 - 2 / 3 * (r + lam) * (r + 3 * lam) / (r + 2 * lam) ** 2
    p = (r + 2 * lam) / (r + lam) ** 2
    m = (h - 1) * (1 - 3 * h)
    z1 = ((x / (r + lam)) ** h - (1 + h * p * (h - 1 - 0.5 * (2 - h) * m * p))) / (h * np.sqrt(2 * p) * (1 + 0.5 * m * p))
    # Runs above and below the middle.
    high = 2 * values >= alphabet[which]
    same = which[1:] == which[:-1]
    changes = np.bincount(which[1:][same & (high[1:] != high[:-1])], minlength=c)
    up = np.bincount(which, weights=high, minlength=c)
    cross = 2 * up * (n - up)
    var = cross * (cross - n) / (n**2 * (n - 1))
    with np.errstate(divide="ignore", invalid="ignore"):
        z_runs = np.where(var > 0, (changes + 1 - (1 + cross / n)) / np.sqrt(var), np.inf)
        # Serial correlation.
        v = values - np.add.reduceat(values, start)[which] / n[which]
        total = np.bincount(which, weights=v * v, minlength=c)
        lagged = np.bincount(which[1:][same], weights=(v[1:] * v[:-1])[same], minlength=c)
        z_serial = np.where(total > 0, lagged / total * np.sqrt(n), np.inf)
    z = np.maximum(z1, np.maximum(np.abs(z_runs), np.abs(z_serial)) - EFFECT * np.sqrt(n))
    refused = np.maximum(np.maximum(np.abs(z_uniform), np.abs(z_runs)), np.abs(z_serial)) > VETO_Z
    return np.where(refused, 0.0, _log10_phi(np.where(np.isfinite(z), z, 0.0)))


def length_class(size: np.ndarray) -> np.ndarray:
    """Whole part of log2 of the length, 31 at most."""
    return np.minimum(np.frexp(size.astype(float))[1] - 1, 31)


def candidates(data: np.ndarray, offsets: np.ndarray, base: np.ndarray) -> dict[str, np.ndarray]:
    """Places, kind, length class and tested bin of all candidates, and class and bin of the run around each (bin -1: none)."""
    s1, e1 = runs_of(_SIGN[data], offsets, LEAST)
    s2, e2 = runs_of(_ALNUM[data], offsets, LEAST)
    around = np.searchsorted(s1, s2, side="right") - 1
    inner = (s1[around] != s2) | (e1[around] != e2) if len(s2) else np.zeros(0, bool)
    outer = np.concatenate((np.full(len(s1), -1), around[inner]))
    starts, ends = np.concatenate((s1, s2[inner])), np.concatenate((e1, e2[inner]))
    # Overlap with any base span: the furthest end among those that begin before the candidate's end.
    free = np.ones(len(starts), bool)
    if len(base) and len(starts):
        reach = np.maximum.accumulate(base[:, 2])
        last = np.searchsorted(base[:, 0], ends, side="left") - 1
        free = ~((last >= 0) & (reach[np.maximum(last, 0)] > starts))
    enc = infer(data, starts, ends)
    size = ends - starts
    bins = np.zeros(len(starts), np.int64)
    todo, at = np.flatnonzero(free), 0
    while at < len(todo):  # bounded numbers of sequences and signs at a time; a long one by itself
        stop = at + max(1, int(np.searchsorted(np.cumsum(size[todo[at : at + 20_000]]), 2_000_000)))
        some = todo[at:stop]
        n = size[some]
        place = np.repeat(starts[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        log_p = battery(_VALUES[np.repeat(enc[some], n), data[place]], n, _SIZES[enc[some]])
        bins[some] = np.minimum(np.floor(-10 * log_p), MAX_BIN)
        at = stop
    cls = length_class(size)
    covered = np.where(outer >= 0, free[outer] if len(outer) else False, False)
    out = {"start": starts, "kind": _KIND_OF[enc], "end": ends, "cls": cls, "bin": bins,
           "outer_cls": np.where(covered, cls[outer] if len(outer) else 0, 0), "outer_bin": np.where(covered, bins[outer] if len(outer) else 0, -1)}
    order = np.flatnonzero(free)
    order = order[np.lexsort((out["kind"][order], out["start"][order]))]
    return {k: v[order] for k, v in out.items()}


_SPAN = ("start", "kind", "end")
_CANDIDATE = (*_SPAN, "cls", "bin", "outer_cls", "outer_bin")


def _structs(fields) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(f, T.LongType()) for f in fields]))


def _lists(bounds: np.ndarray, fields, columns) -> pa.ListArray:
    items = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], fields)
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)


def _found(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("base_sha256", T.StringType()),
        T.StructField("base", _structs(_SPAN)), T.StructField("candidates", _structs(_CANDIDATE)),
    ])

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            for row, data, offsets in text_slices(batch.column("text")):
                base = base_spans(data, offsets)
                cand = candidates(data, offsets, base)
                lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))  # byte places to code points
                first = lead[offsets]

                def local(places, doc, lead=lead, first=first):
                    return lead[places] - first[doc]

                doc = np.searchsorted(offsets, base[:, 0], side="right") - 1
                cols = [local(base[:, 0], doc), base[:, 1], local(base[:, 2], doc)]
                bounds = np.searchsorted(base[:, 0], offsets)
                text = [f"{BASE_KINDS[k]}:{s}:{e}" for s, k, e in zip(*(c.tolist() for c in cols), strict=True)]
                digest = [hashlib.sha256(",".join(text[a:b]).encode()).hexdigest()
                          for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                doc = np.searchsorted(offsets, cand["start"], side="right") - 1
                cand_bounds = np.searchsorted(cand["start"], offsets)
                cand |= {"start": local(cand["start"], doc), "end": local(cand["end"], doc)}
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(row, len(offsets) - 1), pa.array(digest, pa.string()), _lists(bounds, _SPAN, cols),
                     _lists(cand_bounds, _CANDIDATE, [cand[c] for c in _CANDIDATE])], schema.fieldNames())

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def least_bins(counts: list[tuple[int, int, int]], rate: float = FALSE_RATE) -> list[int]:
    """From (class, bin, number): for each of the 32 classes the least bin whose members are discoveries."""
    out = []
    for c in range(32):
        own = np.zeros(MAX_BIN + 1)
        for cls, b, n in counts:
            if cls == c:
                own[b] += n
        at_least = np.cumsum(own[::-1])[::-1]
        good = (at_least > 0) & (10.0 ** (-np.arange(MAX_BIN + 1) / 10) * own.sum() <= rate * at_least)
        out.append(int(np.flatnonzero(good)[0]) if good.any() else MAX_BIN + 1)
    return out


def _span_text(s: Column) -> Column:
    kinds = F.array(*(F.lit(k) for k in KINDS))
    return F.concat_ws(":", F.get(kinds, s["kind"].cast("int")), s["start"].cast("string"), s["end"].cast("string"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", false_rate: float = FALSE_RATE, keep_tests: bool = False) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans, n_random[, tests]) of every row.

    ``spans`` lists kind:start:end (code points, end exclusive) by start and order of kinds; ``tests`` has all candidates
    with their length class and bin (tenths of -log10 p)."""
    prepare(docs.sparkSession)
    found = staged(_found(docs, id_col, text_col), "secrets")
    tested = found.select(F.explode("candidates").alias("c")).groupBy("c.cls", "c.bin").agg(F.count(F.lit(1)).alias("n"))
    bounds = least_bins([tuple(r) for r in tested.collect()], false_rate)  # 32 classes of 401 bins at the most
    least = F.array(*(F.lit(b) for b in bounds))

    def passes(cls: Column, b: Column) -> Column:
        return b >= F.get(least, cls.cast("int"))

    flagged = F.filter("candidates", lambda c: passes(c["cls"], c["bin"]) & ~((c["outer_bin"] >= 0) & passes(c["outer_cls"], c["outer_bin"])))
    flagged = F.transform(flagged, lambda c: F.struct(*(c[f].alias(f) for f in _SPAN)))

    def count_of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == BASE_KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    out = found.withColumn("flagged", flagged)
    return out.select(
        F.col("id").alias(id_col), *(count_of(k) for k in BASE_KINDS), "base_sha256",
        F.array_join(F.transform(F.array_sort(F.concat("base", "flagged")), _span_text), ",").alias("spans"),
        F.size("flagged").cast("long").alias("n_random"), *([F.col("candidates").alias("tests")] if keep_tests else []),
    )
