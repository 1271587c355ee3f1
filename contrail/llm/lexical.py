"""Ranked lexical search over a length-stratified index.

A term's weight is w = floor(1000 ln((2N + 2) / (2 df + 1))), a document's normaliser m = 50 + (50 n N) div L, and its score
the sum of w * ((10^9 tf) div (1000 tf + 20 m)) over an item's terms, in integers. The impact, the second factor, depends on tf and m
alone, hence the index:

* Documents are dealt by ranges of m that hold equal numbers of postings, and sorted by it, so those of equal m lie
  together: a stratum. A frequent m is split over several ranges.
* Within a stratum a term's postings are sorted by tf, the highest first. Impacts are computed once for each tf of a stratum, and the first
  one is the term's bound there.
* An item's bound for a stratum is the sum of its terms' bounds, and at most the best of them for each place that a document of the
  stratum has. Strata are visited from the highest bound down, some hundreds of documents at first, then more, until the
  bounds fall below the last of the best ``k`` scores.
* Scores of a 64th of the documents, taken by hash, are searched first. Their k-th best is a score that the final k-th can't
  fall below, so tasks begin with it and send few rows: about 64 k an item in all, not k from each task.

Terms are known by 64-bit hashes. If the items have at most ``MOST_VOCABULARY`` distinct terms (8 MB), these are sent to the tasks and only their
postings are kept; beyond, all are. Items are searched in blocks of about ``BLOCK_TERMS`` terms, each against all documents. A task
holds the postings of ``SHARD_POSTINGS`` at a time, however many its range has.

Null text has no terms; a document without terms counts neither in N nor in L and is never found, an item without known terms finds
nothing. Repeated rows are documents, or items, of their own; of equal scores the lower id comes first, null ids last. Other columns, whatever
their names, take no part. Texts of any length are read whole. Empty tables give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from contrail.llm.staging import staged
from contrail.llm.textvec import SIGNS, Words, prepare, text_slices

MOST_VOCABULARY = 1 << 20
BLOCK_TERMS = 1 << 18
SHARD_POSTINGS = 3_000_000
#: Postings in a range of m on average.
TASK_POSTINGS = 1_000_000
SEED_SHARE = 64
#: Documents in an item's first visit; each next visit takes four times as many.
FIRST_VISIT = 256


def _terms(texts: pa.Array, vocabulary: np.ndarray | None):
    """Yield (first row, n of each text, bounds, terms, tfs): the distinct terms of each text, of the vocabulary if one is given."""
    for row, data, offsets in text_slices(texts):
        w = Words(data, offsets, separators=SIGNS)
        h, doc = w.hashes().view(np.int64), w.doc
        if vocabulary is not None:
            at = np.searchsorted(vocabulary, h)
            hit = vocabulary[np.minimum(at, len(vocabulary) - 1)] == h if len(vocabulary) else np.zeros(len(h), bool)
            h, doc = h[hit], doc[hit]
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        at = np.flatnonzero(first)
        tf = np.diff(np.append(at, len(h)))
        yield row, w.counts, np.searchsorted(doc[at], np.arange(len(offsets))), h[at], tf


def _tokenized(docs: DataFrame, id_col: str, text_col: str, vocabulary) -> DataFrame:
    schema = T.StructType([
        T.StructField("id", docs.schema[id_col].dataType), T.StructField("row", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("postings", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("tfs", T.BinaryType()),
    ])

    def run(batches):
        known = None if vocabulary is None else vocabulary.value
        for batch in batches:
            for row, n, bounds, terms, tf in _terms(batch.column("text"), known):
                cuts = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                t, f = terms.astype("<i8"), tf.astype("<u4")
                yield pa.RecordBatch.from_arrays([
                    batch.column("id").slice(row, len(n)), batch.column("row").slice(row, len(n)), pa.array(n, pa.int64()),
                    pa.array(np.diff(bounds), pa.int64()), pa.array([t[a:b].tobytes() for a, b in cuts], pa.binary()),
                    pa.array([f[a:b].tobytes() for a, b in cuts], pa.binary())], schema.fieldNames())

    rows = docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, schema).filter("n > 0")


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    column = column.cast(pa.large_binary())
    _, off, data = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset : column.offset + len(column) + 1]
    data = data.to_pybytes()[off[0] : off[-1]] if data is not None else b""
    return np.frombuffer(data, kind).astype(np.int64), (off - off[0]) // np.dtype(kind).itemsize


def _document_counts(index: DataFrame) -> DataFrame:
    """(term, df); each task adds its documents up before it sends anything."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(_flat(batch.column("terms"), "<i8")[0])
            size += len(held[-1])
            if size > 4_000_000:
                yield _sums(held)
                held, size = [], 0
        if held:
            yield _sums(held)

    def _sums(held):
        terms, n = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(terms), pa.array(n, pa.int64())], ["term", "df"])

    return index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def _wanted(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item, item_id, term): the distinct terms of each item."""
    tokens = _tokenized(items, id_col, text_col, None).select("id", "row", "terms")
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", items.schema[id_col].dataType), T.StructField("term", T.LongType())])

    def run(batches):
        for batch in batches:
            terms, bounds = _flat(batch.column("terms"), "<i8")
            which = pa.array(np.repeat(np.arange(len(batch)), np.diff(bounds)))
            yield pa.RecordBatch.from_arrays([batch.column("row").take(which), batch.column("id").take(which), pa.array(terms)], schema.fieldNames())

    return tokens.mapInArrow(run, schema)


def _ranged(by_m: DataFrame, tasks: int) -> DataFrame:
    """Deal documents by ranges of m that hold equal numbers of postings, each sorted by m; one m may fill several.

    The numbers are taken by m, beyond 8,192 by 64ths of its power of two: at most some 12,000 rows reach the driver."""
    far = F.lit(8192) + F.floor(F.log2(F.col("m") / 8192) * 64)
    placed = by_m.withColumn("at", F.when(F.col("m") <= 8192, F.col("m")).otherwise(far).cast("long"))
    rows, total = [], 0
    for r in placed.groupBy("at").agg(F.sum(F.col("postings") + 1).alias("size")).orderBy("at").collect():
        rows.append((r["at"], total, r["size"]))
        total += r["size"]
    bounds = by_m.sparkSession.createDataFrame(rows, "at long, before long, size long")
    share = F.pmod(F.xxhash64("row"), F.lit(1 << 30)) / (1 << 30)
    part = F.floor((F.col("before") + share * F.col("size")) * tasks / max(total, 1))
    dealt = placed.join(F.broadcast(bounds), "at").withColumn("part", F.least(part, F.lit(tasks - 1)).cast("int"))
    return dealt.repartitionById(tasks, F.col("part")).sortWithinPartitions("m", "row").drop("at", "before", "size", "part")


class Items:
    """A block of items: their terms' weights, and the items of each term's list."""

    def __init__(self, rows: list[tuple[int, int, int]]):
        """rows: (item, term, weight)."""
        item, term, weight = (np.array(c, np.int64) for c in zip(*rows, strict=True)) if rows else (np.zeros(0, np.int64),) * 3
        self.names, which = np.unique(item, return_inverse=True)
        self.vocabulary, first, at = np.unique(term, return_index=True, return_inverse=True)
        self.weight = weight[first]
        order = np.argsort(which, kind="stable")
        self.terms, self.bounds = at[order], np.searchsorted(which[order], np.arange(len(self.names) + 1))


class Strata:
    """Some documents as an index: postings by term, stratum and tf, the highest first."""

    def __init__(self, m: np.ndarray, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, items: Items):
        """m and n of each document; its postings are (doc, term as a place in the items' vocabulary, tf)."""
        self.n_docs = len(m)
        levels, of_doc = np.unique(m, return_inverse=True)
        self.docs_in = np.bincount(of_doc, minlength=len(levels))
        self.longest = np.zeros(len(levels), np.int64)
        np.maximum.at(self.longest, of_doc, n)
        stratum = of_doc[doc]
        order = np.lexsort((doc, -tf, stratum, term))
        self.doc, term, stratum, tf = doc[order], term[order], stratum[order], tf[order]
        new_cell = np.ones(len(term), bool)
        new_cell[1:] = (term[1:] != term[:-1]) | (stratum[1:] != stratum[:-1])
        new_run = new_cell.copy()
        new_run[1:] |= tf[1:] != tf[:-1]
        runs = np.flatnonzero(new_run)
        value = items.weight[term[runs]] * ((1_000_000_000 * tf[runs]) // (1000 * tf[runs] + 20 * levels[stratum[runs]]))
        self.value = np.repeat(value, np.diff(np.append(runs, len(term))))
        cells = np.flatnonzero(new_cell)
        self.cell_start, self.cell_end = cells, np.append(cells[1:], len(term))
        self.cell_stratum, self.cell_bound = stratum[cells], self.value[cells]
        self.term_cells = np.searchsorted(term[cells], np.arange(len(items.vocabulary) + 1))

    def best(self, terms: np.ndarray, k: int, least: int, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) of the k best with a score of at least ``least``; of equal ones the lower ``rank``."""
        cells = np.concatenate([np.arange(self.term_cells[t], self.term_cells[t + 1]) for t in terms]) if len(terms) else np.zeros(0, np.int64)
        stratum, bound = self.cell_stratum[cells], self.cell_bound[cells]
        limit, top = np.zeros(len(self.docs_in), np.int64), np.zeros(len(self.docs_in), np.int64)
        np.add.at(limit, stratum, bound)
        np.maximum.at(top, stratum, bound)
        limit = np.minimum(limit, top * self.longest)
        exact = float(limit.max(initial=0)) < 2**53
        order = np.argsort(-limit, kind="stable")
        order = order[limit[order] >= max(least, 1)]
        docs, scores, visit = np.zeros(0, np.int64), np.zeros(0, np.int64), FIRST_VISIT
        while len(order):
            stop = int(np.searchsorted(np.cumsum(self.docs_in[order]), visit)) + 1
            now = np.zeros(len(self.docs_in), bool)
            now[order[:stop]] = True
            some = cells[now[stratum]]
            size = self.cell_end[some] - self.cell_start[some]
            ends = np.cumsum(size)
            at = np.repeat(self.cell_start[some] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)
            if exact:  # sums of whole numbers that doubles hold
                total = np.bincount(self.doc[at], weights=self.value[at], minlength=self.n_docs).astype(np.int64)
            else:
                total = np.zeros(self.n_docs, np.int64)
                np.add.at(total, self.doc[at], self.value[at])
            good = np.flatnonzero(total >= max(least, 1))
            docs, scores = np.concatenate((docs, good)), np.concatenate((scores, total[good]))
            if len(docs) > k:
                keep = np.lexsort((rank[docs], -scores))[:k]
                docs, scores = docs[keep], scores[keep]
            if len(docs) == k:
                least = max(least, int(scores.min()))
            order = order[stop:]
            order = order[limit[order] >= max(least, 1)]
            visit *= 4
        return docs, scores


def _search(index: DataFrame, items, least, k: int) -> DataFrame:
    """(item, id, row, score): each task's best documents of every item of the block, from ``least`` of that item upwards."""
    schema = T.StructType([T.StructField("item", T.LongType()), index.schema["id"], T.StructField("row", T.LongType()), T.StructField("score", T.LongType())])

    def flush(held):
        block, floor = items.value, least.value
        table = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        (term, bounds), (tf, _) = _flat(table.column("terms"), "<i8"), _flat(table.column("tfs"), "<u4")
        doc = np.repeat(np.arange(len(table)), np.diff(bounds))
        at = np.searchsorted(block.vocabulary, term)
        hit = block.vocabulary[np.minimum(at, len(block.vocabulary) - 1)] == term if len(block.vocabulary) else np.zeros(len(term), bool)
        rows = table.column("row").to_numpy()
        by_id = pc.sort_indices(pa.table({"id": table.column("id"), "row": rows}), sort_keys=[("id", "ascending"), ("row", "ascending")])
        rank = np.empty(len(table), np.int64)
        rank[by_id.to_numpy()] = np.arange(len(table))
        strata = Strata(table.column("m").to_numpy(), table.column("n").to_numpy(), doc[hit], at[hit], tf[hit], block)
        out = [(np.zeros(0, np.int64),) * 3]
        for i, name in enumerate(block.names.tolist()):
            docs, scores = strata.best(block.terms[block.bounds[i] : block.bounds[i + 1]], k, floor.get(name, 1), rank)
            out.append((np.full(len(docs), name), docs, scores))
        item, docs, scores = (np.concatenate(c) for c in zip(*out, strict=True))
        which = pa.array(docs)
        return pa.RecordBatch.from_arrays([pa.array(item), table.column("id").take(which), pa.array(rows[docs]), pa.array(scores)], schema.fieldNames())

    def run(batches):
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += pc.sum(batch.column("postings")).as_py() or 0
            if size >= SHARD_POSTINGS:
                yield flush(held)
                held, size = [], 0
        if size:
            yield flush(held)

    return index.mapInArrow(run, schema)


def _first(hits: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last(), "row")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(
    docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text",
    most_vocabulary: int = MOST_VOCABULARY, block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item."""
    spark = docs.sparkSession
    sc = spark.sparkContext
    prepare(spark)
    wanted = staged(_wanted(items, item_id, text_col), "items")
    distinct = wanted.select("term").distinct()
    vocabulary = None
    if distinct.count() <= most_vocabulary:
        vocabulary = sc.broadcast(np.sort(np.array([r["term"] for r in distinct.collect()], np.int64)))

    raw = staged(_tokenized(docs, doc_id, text_col, vocabulary), "tokenized")
    total = raw.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L"), F.sum("postings").alias("P")).first()
    n_docs, n_terms, postings = total["N"], total["L"] or 1, total["P"] or 0
    by_m = raw.withColumn("m", F.expr(f"50 + (50L * n * {n_docs}L) div {n_terms}L"))
    tasks = max(sc.defaultParallelism, -(-postings // TASK_POSTINGS))
    index = staged(_ranged(by_m, tasks), "strata")

    weight = F.floor(F.lit(1000.0) * F.log(F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")))
    weighted = staged(wanted.join(_document_counts(index), "term").withColumn("w", weight), "weighted")
    blocks = max(1, -(-weighted.count() // block_terms))

    hits = None
    for b in range(blocks):
        own = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(blocks)) == b).select("item", "term", "w")
        block = sc.broadcast(Items([tuple(r) for r in own.collect()]))  # about block_terms rows
        sample = index.filter(F.pmod(F.xxhash64("row"), F.lit(SEED_SHARE)) == 0).repartition(max(1, tasks // SEED_SHARE), "row")
        seeds = _first(_search(sample, block, sc.broadcast({}), k), k).filter(F.col("rank") == k)
        least = sc.broadcast({r["item"]: r["score"] for r in seeds.select("item", "score").collect()})  # a row an item
        found = staged(_search(index, block, least, k), "hits")
        hits = found if hits is None else hits.unionByName(found)
    ids = wanted.select("item", "item_id").distinct()
    best = _first(hits, k).join(ids, "item")
    return best.select(F.col("item_id").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
