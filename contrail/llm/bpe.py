"""Byte-level BPE in DuckDB, one in-memory database per Python worker and many words per query.

Encoding: a recursive query over token-position rows. Each round joins every pair of neighbours to the
merge table, takes each word's leftmost pair of least rank, and contracts it; a word leaves when
no pair is left. Decoding: the id rows join the vocabulary and an ordered aggregation puts
their bytes together. Texts are split into pre-tokens first (``pretoken``); each worker codes a
pre-token once and keeps it in a bounded store, so the queries see distinct words only.

A word longer than LONG_BYTES is cut first at every place that no occurrence of a vocabulary token spans: each
merge makes a token, so none crosses such a place and the parts are coded by themselves, distinct ones once. A part that is still
longer has all repeats of its least pair contracted at once, in runs of ROUNDS rounds: the same result (a
merged token's pairs always rank after the merge that made it), with memory in proportion to the part.

Null text reads as empty: no ids, the hash of nothing. Repeated rows stay, null ids stay null. An empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from contrail.llm.pretoken import Coder, batches, public_file, ranks
from contrail.llm.textvec import prepare

RANK_FILE = "byte_bpe_50k.tiktoken"
#: Bytes of words in one query, and the memory that DuckDB may use for it in a worker.
QUERY_BYTES, MEMORY = 300_000, "256MB"
LONG_BYTES, ROUNDS = 128, 32

_CONTRACT = """
CREATE TABLE coded AS
WITH RECURSIVE step(w, pos, tok, round) AS (
  SELECT w, pos, tok, 0 FROM place
  UNION ALL (
    WITH pairs AS (
      SELECT w, pos, tok, lead(tok) OVER by_pos AS nxt, lead(pos) OVER by_pos AS nxt_pos
      FROM step WINDOW by_pos AS (PARTITION BY w ORDER BY pos)
    ), best AS (
      -- least rank first, then leftmost, in one number
      SELECT p.w, min((m.id::BIGINT << 32) | p.pos) AS pick, arg_min(p.nxt_pos, (m.id::BIGINT << 32) | p.pos) AS gone
      FROM pairs p JOIN merges m ON m.l = p.tok AND m.r = p.nxt GROUP BY p.w
    )
    SELECT s.w, s.pos, CASE WHEN s.pos = (b.pick & 4294967295) THEN (b.pick >> 32)::INTEGER ELSE s.tok END, s.round + 1
    FROM step s JOIN best b ON s.w = b.w WHERE s.pos <> b.gone
  )
)
SELECT w, pos, tok FROM step QUALIFY round = max(round) OVER (PARTITION BY w)
"""

_CONTRACT_REPEATS = """
CREATE TABLE coded AS
WITH RECURSIVE step(w, pos, tok, round) AS (
  SELECT w, pos, tok, 0 FROM place
  UNION ALL (
    WITH pairs AS (
      SELECT w, pos, tok, round, lead(tok) OVER (PARTITION BY w ORDER BY pos) AS nxt FROM step
    ), ranked AS (
      SELECT p.*, m.id, min(m.id) OVER (PARTITION BY p.w) AS best
      FROM pairs p LEFT JOIN merges m ON m.l = p.tok AND m.r = p.nxt
    ), hits AS (
      SELECT w, pos, tok, round, best, coalesce(id = best, false) AS hit,
             coalesce(lag(id) OVER (PARTITION BY w ORDER BY pos) = best, false) AS after_hit
      FROM ranked WHERE best IS NOT NULL
    ), runs AS (  -- hits in a row overlap: every second one counts, from the left
      SELECT *, sum((hit AND NOT after_hit)::INTEGER) OVER (PARTITION BY w ORDER BY pos) AS run FROM hits
    ), taken AS (
      SELECT *, hit AND row_number() OVER (PARTITION BY w, run, hit ORDER BY pos) % 2 = 1 AS take FROM runs
    ), gone AS (
      SELECT *, coalesce(lag(take) OVER (PARTITION BY w ORDER BY pos), false) AS eaten FROM taken
    )
    SELECT w, pos, CASE WHEN take THEN best ELSE tok END, round + 1 FROM gone WHERE NOT eaten AND round < {rounds}
  )
)
SELECT w, pos, tok FROM step QUALIFY round = max(round) OVER (PARTITION BY w)
"""

_IDS = "SELECT w, count(*) AS n FROM coded GROUP BY w ORDER BY w"
_FLAT = "SELECT tok FROM coded ORDER BY w, pos"
_DECODE = """
SELECT string_agg(v.bytes_hex, '' ORDER BY c.pos) AS bytes_hex
FROM coded c JOIN vocabulary v ON v.id = c.tok GROUP BY c.w ORDER BY c.w
"""


@cache
def _database(name: str):
    """A connection with the tables merges (l, r, id) and vocabulary (id, bytes_hex) of a rank file."""
    import duckdb

    table = ranks(public_file(name))
    left, right, merged = [], [], []
    for token, rank in table.items():  # any two tokens whose bytes together are a token may merge, by its rank
        for cut in range(1, len(token)):
            a, b = table.get(token[:cut]), table.get(token[cut:])
            if a is not None and b is not None:
                left.append(a)
                right.append(b)
                merged.append(rank)
    # Without a folder for spilling: nothing is written to the worker's disk.
    con = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
    made = pa.table({"l": pa.array(left, pa.int32()), "r": pa.array(right, pa.int32()), "id": pa.array(merged, pa.int32())})
    words = pa.table({"id": pa.array(list(table.values()), pa.int32()), "bytes_hex": [t.hex() for t in table]})
    for view, rows, to in (("made", made, "merges"), ("words", words, "vocabulary")):
        con.register(view, rows)
        con.execute(f"CREATE TABLE {to} AS SELECT * FROM {view}")
        con.unregister(view)
    single = np.array([table[bytes([b])] for b in range(256)], np.int32)
    return con, single


def _query(con, sql: str) -> pa.Table:
    return con.sql(sql).to_arrow_table()


def _code_some(words: list[bytes], name: str, long: bool) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    con, single = _database(name)
    size = np.fromiter(map(len, words), np.int64, len(words))
    tok = single[np.frombuffer(b"".join(words), np.uint8)]
    w = np.repeat(np.arange(len(words)), size)
    pos = np.arange(len(tok)) - np.repeat(np.cumsum(size) - size, size)
    while True:
        place = pa.table({"w": pa.array(w, pa.int32()), "pos": pa.array(pos, pa.int32()), "tok": pa.array(tok, pa.int32())})
        con.register("place", place)
        con.execute("DROP TABLE IF EXISTS coded")
        con.execute(_CONTRACT_REPEATS.format(rounds=ROUNDS) if long else _CONTRACT)
        con.unregister("place")
        if not long:
            break
        got = _query(con, "SELECT w, pos, tok FROM coded ORDER BY w, pos")
        if len(got) == len(tok):  # nothing merged any more
            break
        w, pos, tok = (got[c].to_numpy() for c in ("w", "pos", "tok"))
    counts = _query(con, _IDS)["n"].to_numpy().astype(np.int64)
    flat = _query(con, _FLAT)["tok"].to_numpy().astype(np.uint32)
    back = [bytes.fromhex(x) for x in _query(con, _DECODE)["bytes_hex"].to_pylist()]
    return counts, flat, back


@cache
def _occurrences(name: str):
    """Finds every occurrence of the vocabulary's tokens of two and more bytes, as (last byte, length)."""
    import ahocorasick

    found = ahocorasick.Automaton()
    for token in ranks(public_file(name)):
        if len(token) > 1:
            found.add_word(token.decode("latin-1"), len(token))
    found.make_automaton()
    return found


def safe_parts(word: bytes, name: str = RANK_FILE) -> list[bytes]:
    """``word`` cut at all places that no occurrence of a token spans."""
    # Places are numbered by the byte behind them; a token from byte s to byte e spans the places s + 1 to e.
    spans = np.fromiter(
        (x for end, size in _occurrences(name).iter(word.decode("latin-1")) for x in (end - size + 2, end + 1)), np.int64)
    n = len(word)
    change = np.bincount(spans[::2], minlength=n + 1) - np.bincount(spans[1::2], minlength=n + 1)
    cuts = [0, *(np.flatnonzero(np.cumsum(change)[1:n] == 0) + 1).tolist(), n]
    return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def code_words(words: list[str], name: str = RANK_FILE) -> list[tuple[np.ndarray, np.ndarray]]:
    """[(number of ids, ids), (number of decoded bytes, bytes)] of pre-tokens, none of them empty."""
    coded = [w.encode() for w in words]
    parts = [[w] if len(w) <= LONG_BYTES else safe_parts(w, name) for w in coded]
    known = {p: i for i, p in enumerate(dict.fromkeys(p for own in parts for p in own))}
    ids, back = _code_parts(list(known), name)
    own_ids = [np.concatenate([ids[known[p]] for p in own]) for own in parts]
    own_back = [b"".join(back[known[p]] for p in own) for own in parts]
    return [
        (np.fromiter(map(len, own_ids), np.int64, len(words)), np.concatenate(own_ids) if own_ids else np.zeros(0, np.uint32)),
        (np.fromiter(map(len, own_back), np.int64, len(words)), np.frombuffer(b"".join(own_back), np.uint8)),
    ]


def _code_parts(coded: list[bytes], name: str) -> tuple[list[np.ndarray], list[bytes]]:
    """(ids, decoded bytes) of each part."""
    ids: list = [None] * len(coded)
    back = [b""] * len(coded)
    for long in (False, True):
        which = [i for i, w in enumerate(coded) if (len(w) > LONG_BYTES) == long]
        at = 0
        while at < len(which):
            end, held = at, 0
            while end < len(which) and (end == at or held + len(coded[which[end]]) <= QUERY_BYTES):
                held += len(coded[which[end]])
                end += 1
            n, flat, decoded = _code_some([coded[i] for i in which[at:end]], name, long)
            stop = np.cumsum(n)
            for i, s, e, b in zip(which[at:end], (stop - n).tolist(), stop.tolist(), decoded, strict=True):
                ids[i], back[i] = flat[s:e], b
            at = end
    return ids, back


@cache
def _coder(name: str) -> Coder:
    return Coder(lambda words: code_words(words, name))


def encode_decode(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rank_file: str = RANK_FILE, keep_ids: bool = False
) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256[, token_ids array, decoded binary]) of every row.

    The hashes are of the ids as little-endian unsigned 32-bit integers and of the decoded bytes.
    """
    prepare(docs.sparkSession)
    id_type = docs.schema[id_col].dataType
    fields = [T.StructField(id_col, id_type), T.StructField("n_tokens", T.LongType()),
              T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    if keep_ids:
        fields += [T.StructField("token_ids", T.ArrayType(T.LongType())), T.StructField("decoded", T.BinaryType())]
    schema = T.StructType(fields)

    def run(rows):
        coder = _coder(rank_file)
        for batch in rows:
            n, ids_hash, bytes_hash, all_ids, all_bytes = [], [], [], [], []
            for _, pre in batches(batch.column(text_col)):
                (ids, a), (data, b) = coder.spread(pre, coder.lookup(pre))
                ids, data = ids.astype("<u4"), data.astype(np.uint8)
                for k in range(len(a) - 1):
                    own, back = ids[a[k] : a[k + 1]], data[b[k] : b[k + 1]].tobytes()
                    n.append(len(own))
                    ids_hash.append(hashlib.sha256(own.tobytes()).hexdigest())
                    bytes_hash.append(hashlib.sha256(back).hexdigest())
                    if keep_ids:
                        all_ids.append(own.astype(np.int64))
                        all_bytes.append(back)
            cols = [batch.column(id_col), pa.array(n, pa.int64()), pa.array(ids_hash, pa.string()), pa.array(bytes_hash, pa.string())]
            if keep_ids:
                cols += [pa.array(all_ids, pa.list_(pa.int64())), pa.array(all_bytes, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, schema.fieldNames())

    return docs.select(id_col, text_col).mapInArrow(run, schema)
