"""Quality classifier: ordinal cumulative-link regression on hashed text.

P(grade <= k) = sigmoid(cut_k - x.w) with one weight vector w over hashed features, shared by
all grades, and ordered cut points cut_0 < cut_1 < ... . It gives each document an expected grade
and the probability of the top grades, by which documents are selected.

Features are square roots of frequencies, so no word or trigram outweighs the rest and a text of any
length is scored whole in one pass: hashed byte
trigrams, hashed word shapes (case, digits, signs, length) and four signs of odd words. The model is fitted on the driver, on a bounded sample of labelled rows (``FIT_ROWS``).

Null text reads as empty, an empty text scores by the cut points alone. Repeated rows stay. With no
labelled row, grades and probabilities are null and all documents are kept; with a single grade that
grade is certain. An empty table gives no rows. Columns of the input that clash with the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.labelled import labelled_sample
from contrail.llm.textvec import Words, mix, prepare, text_slices

#: Most labelled rows that the model is fitted on.
FIT_ROWS = 4_096
#: A document is kept if P(grade is at least the selected one) reaches this.
KEEP_PROBABILITY = 0.4
TRIGRAM_BITS, SHAPE_BITS = 12, 9
#: Signs of a word: repeats the one before, has no letter or digit, is upper-case, ends in two signs.
FLAGS = 4
N_FEATURES = (1 << TRIGRAM_BITS) + (1 << SHAPE_BITS) + FLAGS
_ROWS = 256
_ROUNDS, _RATE, _RIDGE = 300, 0.01, 5e-2

_KIND = np.full(256, 4, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 sign, 4 beyond ASCII
_KIND[:128] = 3
_KIND[0x61:0x7B], _KIND[0x41:0x5B], _KIND[0x30:0x3A] = 0, 1, 2


def _features(data: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Groups of (feature of each occurrence, bounds of each text among them)."""
    n = len(data)
    b = data.astype(np.uint32)
    tri = np.zeros(n, np.uint32)
    if n > 2:
        tri[:-2] = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
    keep = np.ones(n, bool)
    for back in (1, 2):  # a trigram doesn't reach into the next text
        at = offsets[1:] - back
        keep[at[at >= 0]] = False
    short = np.diff(offsets) < 3
    for k in np.flatnonzero(short):
        keep[offsets[k] : offsets[k + 1]] = False
    tri = (tri * np.uint32(0x9E3779B1)) >> np.uint32(32 - TRIGRAM_BITS)
    places = np.concatenate(([0], np.cumsum(keep)))
    groups = [(tri[keep].astype(np.int64), places[offsets])]

    w = Words(data, offsets, lower=False)
    if len(w.starts):
        has = []
        for kind in range(5):
            total = np.concatenate(([0], np.cumsum(_KIND[data] == kind, dtype=np.int64)))
            has.append(total[w.ends] - total[w.starts])
        size = w.ends - w.starts
        h = w.hashes()
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (w.doc[1:] == w.doc[:-1])
        shape = np.zeros(len(h), np.uint64)
        for count in (*has, size):
            shape = shape * np.uint64(4) + np.minimum(count, 3).astype(np.uint64)
        shape = (mix(shape) >> np.uint64(64 - SHAPE_BITS)).astype(np.int64)
        sign = _KIND[data] == 3
        flags = [again, (has[0] + has[1] + has[2] + has[4]) == 0, (has[1] > 1) & (has[0] == 0),
                 (size > 2) & sign[w.ends - 1] & sign[np.maximum(w.ends - 2, 0)]]
    else:
        shape, flags = np.zeros(0, np.int64), [np.zeros(0, bool)] * FLAGS
    groups.append((shape + (1 << TRIGRAM_BITS), w.first_word))
    for k, flag in enumerate(flags):  # the words without the sign go to the last feature, which isn't used
        groups.append((np.where(flag, N_FEATURES - FLAGS + k, N_FEATURES), w.first_word))
    return groups


def vectors(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """Rows of root frequencies, _ROWS texts at a time: in each group of features the squares sum to 1."""
    groups = _features(data, offsets)
    for first in range(0, len(offsets) - 1, _ROWS):
        last = min(first + _ROWS, len(offsets) - 1)
        out = np.zeros((last - first, N_FEATURES), np.float32)
        for which, bounds in groups:
            for d in range(first, last):
                own = which[bounds[d] : bounds[d + 1]]
                if len(own):
                    out[d - first] += np.sqrt(np.bincount(own, minlength=N_FEATURES + 1)[:-1] / len(own))
        yield out


@dataclass
class OrdinalModel:
    """Weights by hashed feature, cut points and the grades in order."""

    weights: np.ndarray
    cuts: np.ndarray
    grades: np.ndarray

    def logits(self, column) -> np.ndarray:
        out = []
        for _, data, offsets in text_slices(column):
            out += [x @ self.weights for x in vectors(data, offsets)]
        return np.concatenate(out) if out else np.zeros(0)

    def at_least(self, logits: np.ndarray) -> np.ndarray:
        """P(grade >= grades[k]) for k = 1.. as columns."""
        return 1 / (1 + np.exp(np.clip(self.cuts[None, :] - logits[:, None], -500, 500)))

    def expected(self, logits: np.ndarray) -> np.ndarray:
        return self.grades[0] + self.at_least(logits) @ np.diff(self.grades).astype(float)


def fit_ordinal(x: np.ndarray, y: np.ndarray) -> OrdinalModel:
    """Maximum likelihood with a ridge, by Adam on the whole sample. x: feature rows (changed in place), y: grades."""
    grades = np.unique(y)
    k = np.searchsorted(grades, y)
    if len(grades) == 1:
        return OrdinalModel(np.zeros(x.shape[1]), np.zeros(0), grades)
    mean = x.mean(0)
    x -= mean
    scale = 1 / np.maximum(x.std(0), 1e-4)
    scale[x.std(0) == 0] = 0
    x *= scale
    n, m = x.shape
    share = np.cumsum(np.bincount(k, minlength=len(grades)))[:-1] / n
    start = np.log(share / (1 - share))
    gaps = np.log(np.maximum(np.diff(start), 1e-3))  # cut points are the first and exp(gaps) upwards
    p = np.concatenate((np.zeros(m), start[:1], gaps)).astype(np.float32)
    first, second = np.zeros_like(p), np.zeros_like(p)
    for t in range(1, _ROUNDS + 1):
        cuts = p[m] + np.concatenate(([0], np.cumsum(np.exp(p[m + 1 :]))))
        z = x @ p[:m]
        cdf = 1 / (1 + np.exp(np.clip(z[:, None] - cuts[None], -60, 60)))
        padded = np.hstack((np.zeros((n, 1)), cdf, np.ones((n, 1))))
        i = np.arange(n)
        prob = np.maximum(padded[i, k + 1] - padded[i, k], 1e-9)
        slope = padded * (1 - padded)
        dz = (slope[i, k + 1] - slope[i, k]) / prob / n
        dcut = np.zeros((n, len(cuts)))
        top, low = k < len(cuts), k > 0
        dcut[i[top], k[top]] -= slope[i[top], k[top] + 1] / prob[top]
        dcut[i[low], k[low] - 1] += slope[i[low], k[low]] / prob[low]
        dcut = dcut.sum(0) / n
        after = np.cumsum(dcut[::-1])[::-1]
        g = np.concatenate((x.T @ dz.astype(np.float32) + _RIDGE * p[:m], after[:1], after[1:] * np.exp(p[m + 1 :])))
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        p = (p - _RATE * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)).astype(np.float32)
    weights = p[:m] * scale
    cuts = p[m] + np.concatenate(([0], np.cumsum(np.exp(p[m + 1 :]))))
    return OrdinalModel(weights.astype(np.float64), cuts + mean @ weights, grades)


def train(
    docs: DataFrame, labels: DataFrame, grade_col: str = "quality", id_col: str = "doc_id", text_col: str = "text",
    rows: int = FIT_ROWS,
) -> OrdinalModel | None:
    """Fit on at most ``rows`` labelled documents that aren't held out; None without any."""
    prepare(docs.sparkSession)

    def count(batches):
        for batch in batches:
            at, value = [], []
            for _, data, offsets in text_slices(batch.column("text")):
                for x in (row for part in vectors(data, offsets) for row in part):
                    some = np.flatnonzero(x)
                    at.append(some.astype(np.uint16).tobytes())
                    value.append(x[some].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(at, pa.binary()), pa.array(value, pa.binary())], ["label", "at", "value"])

    sample = labelled_sample(docs, labels, grade_col, rows, id_col, text_col).select("text", "label")
    got = sample.mapInArrow(count, "label int, at binary, value binary").collect()
    if not got:
        return None
    got.sort(key=lambda r: (r["label"], bytes(r["at"]), bytes(r["value"])))  # the same model whatever the order of rows
    x = np.zeros((len(got), N_FEATURES), np.float32)
    for i, r in enumerate(got):
        x[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["value"], np.float32)
    return fit_ordinal(x, np.array([r["label"] for r in got]))


def score(
    docs: DataFrame, model: OrdinalModel | None, text_col: str = "text", at_least: int | None = None,
    keep: float = KEEP_PROBABILITY, drop_text: bool = False,
) -> DataFrame:
    """``docs`` with expected_grade, tail_probability (of grade ``at_least``, by default the top one) and kept."""
    prepare(docs.sparkSession)
    added = ["expected_grade", "tail_probability", "kept"]
    base = docs.drop(*added)
    fields = [f for f in base.schema.fields if not (drop_text and f.name == text_col)]
    if model is None:
        nulls = base.select(*(f.name for f in fields))
        return nulls.select("*", F.lit(None).cast("double").alias(added[0]), F.lit(None).cast("double").alias(added[1]),
                            F.lit(True).alias(added[2]))
    schema = T.StructType([*fields, T.StructField(added[0], T.DoubleType()), T.StructField(added[1], T.DoubleType()),
                           T.StructField(added[2], T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    top = int(model.grades[-1]) if at_least is None else at_least

    def run(batches):
        m = shared.value
        which = int(np.searchsorted(m.grades, top)) - 1  # the cut point below the selected grade
        for batch in batches:
            z = m.logits(batch.column(text_col))
            if which < 0:
                tail = np.ones(len(z))
            elif which >= len(m.cuts):
                tail = np.zeros(len(z))
            else:
                tail = m.at_least(z)[:, which]
            cols = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(m.expected(z)), pa.array(tail), pa.array(tail >= keep)], [f.name for f in schema.fields])

    return base.mapInArrow(run, schema)
