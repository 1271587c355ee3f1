"""Toxicity: a convolutional text classifier over hashed word embeddings.

Words (lower-cased, without ASCII signs) and their first PREFIX_BYTES bytes are hashed to WORD_BITS
bits each; a bucket that enough documents of the fitting sample hold has an embedding, all others share
one, and a word's embedding is the sum of its two buckets', so rare forms of a stem count too. Filters of several
widths run over the whole word sequence, max pooling takes each filter's largest answer and a
logistic unit makes the score. Everything is trained in numpy on the driver, on a bounded sample of
labelled rows (``FIT_ROWS`` rows of together ``FIT_WORDS`` words, whole texts); a part of it calibrates the score and sets one threshold per language.
The language is never an input of the score.

At scoring time the embeddings times the filters are one table per filter place, so a document
costs a few table rows per word, and a text of any length is scored whole.

Null text reads as empty; an empty text gets the score of no evidence. Repeated rows stay. With no
labelled row, or labels of one kind only, every score is the smoothed share of toxic labels.
An empty table gives no rows. Input columns that clash with the added ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.labelled import labelled_sample
from contrail.llm.staging import staged
from contrail.llm.textvec import SIGNS, Words, prepare, span_hashes, text_slices

#: Most labelled rows that the model is fitted on, and the most words that they hold together (8 bytes a word).
FIT_ROWS, FIT_WORDS = 6_000, 12_000_000
WORD_BITS, PREFIX_BYTES, MIN_DOCS, MOST_BUCKETS = 22, 6, 3, 60_000
DIM, WIDTHS, FILTERS = 16, (1, 2, 3), 12
EPOCHS, BATCH, RATE, RIDGE = 6, 32, 0.01, 1e-5
#: Every CALIBRATE-th row of the sample isn't trained on; it sets score scale and thresholds.
CALIBRATE = 5
#: Threshold where a language has too few labelled rows of its own.
THRESHOLD, LANGUAGE_ROWS = 0.3, 40
_PLACES = [(w, j) for w in WIDTHS for j in range(w)]


def word_buckets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(buckets of each word and of its prefix as two columns, bounds of each text among them)."""
    w = Words(data, offsets, separators=SIGNS)
    prefix = span_hashes(w.bytes, w.starts, np.minimum(w.ends, w.starts + PREFIX_BYTES))
    both = [(h >> np.uint64(64 - WORD_BITS)).astype(np.int32) for h in (w.hashes(), prefix)]
    return np.stack((both[0], both[1] + (1 << WORD_BITS)), axis=1), w.first_word


@dataclass
class ToxicityModel:
    """buckets: sorted known buckets; row 0 of each table stands for all others, the last for no word."""

    buckets: np.ndarray
    tables: list[np.ndarray]  # for each (width, place): known buckets + 2 by FILTERS
    bias: np.ndarray
    out: np.ndarray
    out_bias: float
    scale: tuple[float, float] = (1.0, 0.0)
    thresholds: dict[str, float] = field(default_factory=dict)
    constant: float | None = None

    def rows(self, buckets: np.ndarray) -> np.ndarray:
        if not len(self.buckets):
            return np.zeros(buckets.shape, int)
        at = np.searchsorted(self.buckets, buckets)
        at[at == len(self.buckets)] = 0
        return np.where(self.buckets[at] == buckets, at + 1, 0)

    def logits(self, rows: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Raw output of each text; ``rows`` are table rows of its words."""
        n_docs, pad = len(bounds) - 1, len(self.buckets) + 1
        pooled = np.zeros((n_docs, FILTERS * len(WIDTHS)), np.float32)
        size = np.diff(bounds)
        some = np.flatnonzero(size)
        if len(rows):
            doc_end = np.repeat(bounds[1:], size)
            for k, width in enumerate(WIDTHS):
                total = None
                for (w, j), table in zip(_PLACES, self.tables, strict=True):
                    if w != width:
                        continue
                    if j:
                        at = np.arange(len(rows)) + j
                        own = np.where((at < doc_end)[:, None], rows[np.minimum(at, len(rows) - 1)], pad)
                    else:
                        own = rows
                    total = table[own[:, 0]] if total is None else total + table[own[:, 0]]
                    total += table[own[:, 1]]
                total += self.bias[k]
                pooled[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum.reduceat(total, bounds[:-1][some], axis=0)
        return np.maximum(pooled, 0) @ self.out + self.out_bias

    def scores(self, column) -> np.ndarray:
        out = []
        for _, data, offsets in text_slices(column):
            buckets, bounds = word_buckets(data, offsets)
            if self.constant is not None:
                out.append(np.full(len(bounds) - 1, self.constant))
                continue
            z = np.empty(len(bounds) - 1)
            rows, start = self.rows(buckets), 0
            while start < len(z):  # about 200,000 words at a time
                end = int(np.searchsorted(bounds, bounds[start] + 200_000, side="right")) - 1
                end = min(max(end, start + 1), len(z))
                z[start:end] = self.logits(rows[bounds[start] : bounds[end]], bounds[start : end + 1] - bounds[start])
                start = end
            out.append(self.probability(z))
        return np.concatenate(out) if out else np.zeros(0)

    def probability(self, z: np.ndarray) -> np.ndarray:
        a, b = self.scale
        return 1 / (1 + np.exp(-np.clip(a * z + b, -500, 500)))


def _train(docs: list[np.ndarray], y: np.ndarray, seed: int = 7) -> ToxicityModel:
    """Adam on the logistic loss; the pooled places alone get a gradient."""
    rng = np.random.default_rng(seed)
    own = [np.unique(d) for d in docs]
    found, holds = np.unique(np.concatenate(own), return_counts=True)
    enough = holds >= MIN_DOCS
    found, holds = found[enough], holds[enough]
    if len(found) > MOST_BUCKETS:
        top = np.sort(np.argsort(-holds, kind="stable")[:MOST_BUCKETS])
        found, holds = found[top], holds[top]
    v, pad = len(found) + 2, len(found) + 1
    model = ToxicityModel(found, [], np.zeros((len(WIDTHS), FILTERS), np.float32), np.zeros(0), 0.0)
    rows = [model.rows(d) for d in docs]
    toxic = np.zeros(v)
    seen = np.zeros(v)
    for d, label in zip(rows, y, strict=True):
        u = np.unique(d)
        seen[u] += 1
        toxic[u] += label
    base = y.mean()
    lift = np.log((toxic + 4 * base) / (seen - toxic + 4 * (1 - base))) - np.log(base / (1 - base))
    lift[[0, pad]] = 0
    emb = rng.normal(0, 0.1, (v, DIM)).astype(np.float32)
    emb[:, 0] = lift / 4  # the first dimension starts from how often toxic texts hold the word
    emb[pad] = 0
    filt = rng.normal(0, 0.3, (len(_PLACES), DIM, FILTERS)).astype(np.float32)
    filt[:, 0, : FILTERS // 2] = np.abs(filt[:, 0, : FILTERS // 2]) + 0.3
    bias = np.zeros((len(WIDTHS), FILTERS), np.float32)
    out = rng.normal(0.2, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
    out_bias = np.array([np.log(base / (1 - base)) - 1], np.float32)
    params = [emb, filt, bias, out, out_bias]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    step = 0
    for epoch in range(EPOCHS):
        order = rng.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            grads = [np.zeros_like(p) for p in params[1:]]
            touched, d_emb = [], []
            mine = order[at : at + BATCH]
            for i in mine:
                ids = np.concatenate((rows[i], np.full((max(WIDTHS) - 1 + (not len(rows[i])), 2), pad)))
                n = len(ids) - max(WIDTHS) + 1
                x = emb[ids[:, 0]] + emb[ids[:, 1]]
                best = np.empty((len(WIDTHS), FILTERS), np.int64)
                pooled = np.empty((len(WIDTHS), FILTERS), np.float32)
                for k, width in enumerate(WIDTHS):
                    z = sum(x[j : j + n] @ filt[_PLACES.index((width, j))] for j in range(width)) + bias[k]
                    best[k] = z.argmax(0)
                    pooled[k] = z[best[k], np.arange(FILTERS)]
                active = pooled > 0
                h = np.where(active, pooled, 0).ravel()
                p = 1 / (1 + np.exp(-np.clip(h @ out + out_bias[0], -30, 30)))
                g = (p - y[i]) / len(mine)
                grads[2] += g * h
                grads[3] += g
                dz = (g * out.reshape(len(WIDTHS), FILTERS)) * active
                grads[1] += dz
                for k, width in enumerate(WIDTHS):
                    for j in range(width):
                        c = _PLACES.index((width, j))
                        place = best[k] + j
                        grads[0][c] += x[place].T * dz[k]
                        for column in (0, 1):
                            touched.append(ids[place, column])
                            d_emb.append(filt[c].T * dz[k][:, None])
            where, back = np.unique(np.concatenate(touched), return_inverse=True)
            total = np.zeros((len(where), DIM), np.float32)
            np.add.at(total, back, np.concatenate(d_emb))
            total[where == pad] = 0
            step += 1
            c1, c2 = 1 - 0.9**step, 1 - 0.999**step
            rate = RATE * (1 - epoch / EPOCHS)
            # Adam; embeddings that the batch didn't touch stand still.
            for q, (p, g) in enumerate(zip(params, [total, *grads], strict=True)):
                rowsel = where if q == 0 else slice(None)
                g = g + RIDGE * p[rowsel]
                first[q][rowsel] = 0.9 * first[q][rowsel] + 0.1 * g
                second[q][rowsel] = 0.999 * second[q][rowsel] + 0.001 * g * g
                p[rowsel] -= rate * (first[q][rowsel] / c1) / (np.sqrt(second[q][rowsel] / c2) + 1e-8)
    model.tables = [emb @ filt[c] for c in range(len(_PLACES))]
    model.bias, model.out, model.out_bias = bias, out, float(out_bias[0])
    return model


def _calibrate(model: ToxicityModel, z: np.ndarray, y: np.ndarray, group: list) -> None:
    """A logistic scale for the score, then the best threshold by F1 in each language with enough rows."""
    if 0 < y.sum() < len(y):
        a, b = 1.0, 0.0
        target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        for _ in range(50):  # Newton's method
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w = np.maximum(p * (1 - p), 1e-6)
            grad = np.array([((p - target) * z).sum() + 1e-3 * (a - 1), (p - target).sum()])
            hess = np.array([[(w * z * z).sum() + 1e-3, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-6]])
            move = np.linalg.solve(hess, grad)
            a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
        if a > 0:
            model.scale = (float(a), float(b))
    p = model.probability(z)
    group = np.array([g or "" for g in group])
    for g in np.unique(group):
        own = group == g
        if own.sum() < LANGUAGE_ROWS or not y[own].any():
            continue
        grid = np.linspace(0.1, 0.9, 33)
        hit = [2 * ((p[own] >= t) & (y[own] == 1)).sum() / max(1, (p[own] >= t).sum() + y[own].sum()) for t in grid]
        best = np.flatnonzero(np.isclose(hit, max(hit)))
        model.thresholds[str(g)] = float(grid[best[len(best) // 2]])


def within_words(sample: DataFrame, most: int) -> DataFrame:
    """The rows of a stored sample (label, grp, words) that hold at most ``most`` words together.

    By a hash of the row, each that still fits; a text of more words than that never does.
    The driver sees a hash and a count of each sample row."""
    own = F.xxhash64("words", "label", "grp").alias("h")
    sizes = sample.select(own, (F.length("words") / 8).cast("long").alias("n")).groupBy("h").agg(F.sum("n").alias("n")).collect()
    held, taken = 0, []
    for r in sorted(sizes, key=lambda r: r["h"]):
        if held + r["n"] <= most:
            held += r["n"]
            taken.append((r["h"],))
    if len(taken) == len(sizes):
        return sample
    chosen = sample.sparkSession.createDataFrame(taken, "h long")
    return sample.withColumn("h", own).join(F.broadcast(chosen), "h", "left_semi").drop("h")


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", rows: int = FIT_ROWS, most_words: int = FIT_WORDS,
) -> ToxicityModel:
    """Fit on at most ``rows`` labelled documents that aren't held out, of at most ``most_words`` words together."""
    prepare(docs.sparkSession)

    def words(batches):
        for batch in batches:
            got = []
            for _, data, offsets in text_slices(batch.column("text")):
                buckets, bounds = word_buckets(data, offsets)
                got += [buckets[s:e].tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("grp"), pa.array(got, pa.binary())], ["label", "grp", "words"])

    sample = labelled_sample(docs, labels, label_col, rows, id_col, text_col, lang_col).select("text", "label", "grp")
    sample = staged(sample.mapInArrow(words, "label int, grp string, words binary"), "toxicity_sample")
    got = within_words(sample, most_words).collect()
    got.sort(key=lambda r: (r["label"], r["grp"] or "", bytes(r["words"])))  # the same model whatever the order of rows
    y = np.array([int(r["label"] > 0) for r in got])
    if len(y) < 2 * CALIBRATE or not 0 < y.sum() < len(y):
        share = (y.sum() + 0.0) / (len(y) + 1)
        return ToxicityModel(np.zeros(0, np.int32), [], np.zeros(0), np.zeros(0), 0.0, constant=float(share))
    texts = [np.frombuffer(r["words"], np.int32).reshape(-1, 2) for r in got]
    check = np.arange(len(y)) % CALIBRATE == 0
    fit = np.flatnonzero(~check)
    if not 0 < y[fit].sum() < len(fit):
        fit = np.arange(len(y))
    model = _train([texts[i] for i in fit], y[fit])
    some = np.flatnonzero(check)
    z = np.concatenate([model.logits(model.rows(texts[i]), np.array([0, len(texts[i])])) for i in some])
    _calibrate(model, z, y[some], [got[i]["grp"] for i in some])
    return model


def score(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", lang_col: str = "lang", drop_text: bool = False
) -> DataFrame:
    """``docs`` with toxicity (0 to 1) and is_toxic (by the language's threshold)."""
    prepare(docs.sparkSession)
    base = docs.drop("toxicity", "is_toxic")
    fields = [f for f in base.schema.fields if not (drop_text and f.name == text_col)]
    schema = T.StructType([*fields, T.StructField("toxicity", T.DoubleType()), T.StructField("is_toxic", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    by_lang = lang_col in base.columns

    def run(batches):
        m = shared.value
        for batch in batches:
            p = m.scores(batch.column(text_col))
            limit = np.full(len(p), THRESHOLD)
            if by_lang:
                limit = np.array([m.thresholds.get(x or "", THRESHOLD) for x in batch.column(lang_col).to_pylist()])
            cols = [batch.column(f.name) for f in fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(p, pa.float64()), pa.array(p >= limit, pa.bool_())],
                                             [f.name for f in schema.fields])

    return base.mapInArrow(run, schema)
