"""Bounded samples of labelled documents for fitting a classifier on the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows whose crc32(id as text) mod 4 is this are never learned from.
HELD_OUT = 2


def held_out(id_col: str | Column) -> Column:
    """Whether a row is kept out of all fitting; false for a null id."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string")) % 4 == HELD_OUT, F.lit(False))


def bounded_sample(rows: DataFrame, keys: list[str], most: int) -> DataFrame:
    """At most ``most`` rows, the first by a hash of ``keys`` (distinct values): the same on every run.

    A count and a hash threshold leave about half as many again as are wanted, so a top-k of
    a few rows from each task decides, whatever the number of tasks."""
    total = rows.count()
    if total > 2 * most:
        share = int(1.5 * most / total * (1 << 40))
        rows = rows.filter(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)) < share)
    return rows.orderBy(F.pmod(F.xxhash64(*keys), F.lit(1 << 40)), *keys).limit(most)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id", text_col: str = "text",
    group_col: str | None = None,
) -> DataFrame:
    """(id, text, label, grp) of at most ``most`` labelled ids, one row each, held-out ones excluded.

    The ids are the first by a hash of the id: a fixed sample, the same on every run. An id
    with several labels counts with its largest; null labels and null ids don't count. Of several
    rows of an id in ``docs`` the first by a hash of text and group counts, chosen within each task first.
    """
    one = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    one = one.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
    one = one.groupBy("id").agg(F.max("label").alias("label"))
    one = bounded_sample(one, ["id"], most)
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"),
        (F.col(group_col) if group_col else F.lit(None)).cast("string").alias("grp"),
    )
    # At most ``most`` rows of 12 bytes, so the broadcast has a fixed bound.
    found = texts.join(F.broadcast(one), "id").groupBy("id", "label")
    first = found.agg(F.min(F.struct(F.xxhash64("text", "grp").alias("h"), "text", "grp")).alias("first"))
    return first.select("id", "first.text", "label", "first.grp")
