"""Exact top-k inner-product search by distributed histogram selection.

Vectors are packed into blocks (``BLOCK`` candidates, ``QUERIES`` queries per
block); every query block meets every candidate block once per round, one
matrix product per meeting.  Rounds:

1. Each query's scores are counted in ``BINS`` equal bins over the range that
   the vectors' norms allow.  Counts are added up over all blocks; the bin in
   which the running count from the top reaches k holds the kth score.
2. That bin is divided again, until bins are one score wide and the kth score
   is known exactly, with the number of scores above it.
3. Scores above it pass, and of those equal to it each block passes the k
   smallest ids at most; ranks follow from score and id.

A block's kth score is never above the global one, so bins below it are not
sent: a meeting sends at most k bins per query, however many rows tie.  Query
blocks are replicated to shards of the candidate blocks and joined to them
there.  Shards follow the cores, and beyond that the candidates by
``SHARD_BYTES``, which a task buffers.  Nothing is collected, and every join is
a merge join: the driver gets nothing that grows with the queries.

Scores are integers (components floor(64 x)), computed in single or double
precision as long as the norms show that to be exact, else in 64-bit integers.

Defined cases: vectors that are null, empty or hold null or non-finite
components take no part; shorter vectors count as padded with zeros; a row is
never its own candidate but rows that repeat its id are; ties go to the smaller
id, then (for repeated ids) to the earlier row; null ids come last and are no
queries; fewer than k candidates are all returned; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import map_batches, write_scratch

BLOCK = 4096
QUERY_BITS = 8
QUERIES = 1 << QUERY_BITS
BINS = 256
SCALE = 64.0
SHARD_BYTES = 32 << 20  # of candidates in a shard, which a task buffers
SHARDS_PER_CORE = 8
SPREAD = 4  # partitions to a shard, so that few of them hold two
NO_ID = np.iinfo(np.int64).max


def _vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(rows that take part, their scaled components, zero-padded)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null components become NaN
    bad = np.zeros(len(flat) + 1, np.int64)
    np.cumsum(~np.isfinite(flat), out=bad[1:])
    begin = np.cumsum(size) - size
    rows = np.flatnonzero((size > 0) & (bad[begin + size] == bad[begin]))
    width = int(size[rows].max(initial=0))
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows.tolist()) if len(set(size[rows].tolist())) > 1 else ():
        out[i, :size[r]] = flat[begin[r]:begin[r] + size[r]]
    if len(rows) and (size[rows] == width).all():
        out = flat[(begin[rows][:, None] + np.arange(width))]
    return rows, np.floor(out * SCALE)


def _pack(bid: int, ids: np.ndarray, rows: np.ndarray, x: np.ndarray) -> dict:
    most = np.abs(x).max(initial=0)
    item = next((b for b in (1, 2, 4) if most < 2 ** (8 * b - 1)), 8)
    return {"bid": bid, "ids": ids.astype(np.int64).tobytes(), "rows": rows.astype(np.int64).tobytes(),
            "mat": x.astype(f"i{item}").tobytes(), "item": item, "n": len(ids), "dim": x.shape[1],
            "norm": float(np.sqrt((x * x).sum(1)).max(initial=0))}


_BLOCK = "bid bigint, ids binary, rows binary, mat binary, item int, n int, dim int, norm double"
_BATCH = pa.schema([("bid", pa.int64()), ("ids", pa.binary()), ("rows", pa.binary()), ("mat", pa.binary()),
                    ("item", pa.int32()), ("n", pa.int32()), ("dim", pa.int32()), ("norm", pa.float64())])


def _matrix(raw: bytes, item: int, n: int) -> np.ndarray:
    """``item`` bytes a component."""
    return np.frombuffer(raw, f"i{item}").reshape(n, -1)


def blocks(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            rows, x = _vectors(batch.column(1))
            ids = batch.column(0).cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)[rows]
            for k in range(0, len(rows), BLOCK):
                bid = (part << 24) | seq
                seq += 1
                own = x[k:k + BLOCK]
                packed = _pack(bid, ids[k:k + BLOCK], (bid << 12) + np.arange(len(own)), own)
                yield pa.RecordBatch.from_pylist([packed], _BATCH)

    return vectors.select(id_col, vector_col).mapInArrow(run, _BLOCK)


def query_blocks(candidates: DataFrame, every: int) -> DataFrame:
    """The rows whose id ``every`` divides, in blocks of their own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64)
                pick = np.flatnonzero((ids % every == 0) & (ids != NO_ID))
                x = _matrix(r["mat"], r["item"], r["n"])[pick].astype(float)
                for k in range(0, len(pick), QUERIES):
                    own = pick[k:k + QUERIES]
                    yield pa.RecordBatch.from_pylist([_pack((part << 24) | seq, ids[own], rows[own], x[k:k + QUERIES])], _BATCH)
                    seq += 1

    return map_batches(candidates, run, _BLOCK)


def _scores(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(scores with own rows masked out, mask, query rows, candidate rows, candidate ids) of a meeting."""
    q, c = _matrix(r["q_mat"], r["q_item"], r["q_n"]), _matrix(r["c_mat"], r["c_item"], r["c_n"])
    dim = min(q.shape[1], c.shape[1])
    q, c = q[:, :dim], c[:, :dim]
    bound = r["q_norm"] * r["c_norm"]
    kind = np.float32 if bound < 2**23 else np.float64 if bound < 2**52 else np.int64
    s = (q.astype(kind) @ c.astype(kind).T).astype(np.int32 if kind is np.float32 else np.int64)
    rows, other = np.frombuffer(r["q_rows"], np.int64), np.frombuffer(r["c_rows"], np.int64)
    return s, rows[:, None] == other[None, :], rows, other, np.frombuffer(r["c_ids"], np.int64)


def _per_query(values, like: np.ndarray) -> np.ndarray:
    """A column of the type of the scores ``like``; what is beyond that type
    is beyond all of them."""
    most = np.iinfo(like.dtype)
    return np.clip(values, most.min, most.max).astype(like.dtype)[:, None]


def _meetings(queries: DataFrame, candidates: DataFrame, state: DataFrame | None, shards: int) -> DataFrame:
    q = queries.select(*[F.col(c).alias(f"q_{c}") for c in queries.columns])
    if state is not None:
        per = state.groupBy(F.shiftright("q", QUERY_BITS).alias("__b")).agg(
            F.sort_array(F.collect_list(F.struct(F.col("q").bitwiseAND(QUERIES - 1).alias("i"), "lo", "width", "span", "above"))).alias("q_state"))
        q = q.join(per.hint("merge"), F.col("q_bid") == F.col("__b")).drop("__b")
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    c = candidates.select(*[F.col(x).alias(f"c_{x}") for x in candidates.columns],
                          F.pmod(F.xxhash64("bid"), F.lit(shards)).cast("int").alias("shard"))
    # Partitions of a given number: adaptive execution joins what is small in bytes, and these few bytes take long.
    # The right side is what a merge join buffers.
    q, c = (x.repartition(SPREAD * shards, "shard") for x in (q, c))
    return q.join(c.hint("merge"), "shard").drop("shard", "q_dim", "c_dim")


_COUNTS = "q bigint, bin bigint, n bigint"


def _count(meetings: DataFrame, k: int) -> DataFrame:
    """(query, bin, scores) summed over all meetings; bins of ``width`` scores
    from ``lo`` on, ``span`` scores in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                s, own, *_ = _scores(r)
                lo, width, span = (np.array([x[c] for x in r["q_state"]]) for c in ("lo", "width", "span"))
                ok = ~own & (s >= _per_query(lo, s)) & (s < _per_query(lo + span, s))
                many = np.flatnonzero(np.count_nonzero(ok, axis=1) > k)
                if len(many):
                    np.copyto(s, np.iinfo(s.dtype).min, where=~ok)
                    least = np.partition(s[many], -k, axis=1)[:, -k].astype(np.int64)
                    low = lo.copy()
                    low[many] += (least - lo[many]) // width[many] * width[many]
                    ok &= s >= _per_query(low, s)
                at = np.flatnonzero(ok)
                i = at // s.shape[1]
                bins = (s.ravel()[at] - lo[i]) // width[i]
                key, n = np.unique(i * BINS + bins, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((r["q_bid"] << QUERY_BITS) + key // BINS), pa.array(key % BINS), pa.array(n)], names=["q", "bin", "n"])

    return map_batches(meetings, run, _COUNTS).groupBy("q", "bin").agg(F.sum("n").alias("n"))


def _narrow(state: DataFrame, counts: DataFrame, k: int) -> DataFrame:
    """The bin that holds each query's kth score becomes its range."""
    run = Window.partitionBy("q").orderBy(F.col("bin").desc())
    edge = (counts.join(state.select("q", "above").hint("merge"), "q").withColumn("cum", F.sum("n").over(run) + F.col("above"))
            .filter(F.col("cum") >= k).groupBy("q")
            .agg(F.max_by(F.struct("bin", (F.col("cum") - F.col("n")).alias("above")), "bin").alias("e"))
            .select(F.col("q").alias("__q"), "e"))
    wide = F.col("width") > 1
    return state.join(edge.hint("merge"), F.col("q") == F.col("__q"), "left").select(
        "q", F.when(F.col("e").isNull(), F.col("lo")).otherwise(F.col("lo") + F.col("e.bin") * F.col("width")).alias("lo"),
        F.when(F.col("e").isNull(), F.lit(0)).when(wide, F.ceil(F.col("width") / BINS)).otherwise(F.lit(0)).cast("long").alias("width"),
        F.col("width").alias("span"), F.when(F.col("e").isNull(), F.col("above")).otherwise(F.col("e.above")).alias("above"),
        F.col("e").isNull().alias("all"))


def _pass(meetings: DataFrame, k: int) -> DataFrame:
    """Scores above each query's kth, and the smallest ids of those equal."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                s, own, rows, other, ids = _scores(r)
                kth = _per_query(np.array([x["lo"] for x in r["q_state"]]), s)
                room = k - np.array([x["above"] for x in r["q_state"]])
                above = ~own & (s > kth)
                tie = ~own & (s == kth)
                many = np.flatnonzero(np.count_nonzero(tie, axis=1) > room)
                if len(many):
                    order = np.lexsort((other, ids))
                    some = tie[np.ix_(many, order)]
                    tie[np.ix_(many, order)] = some & (np.cumsum(some, axis=1) <= room[many, None])
                i, j = np.nonzero(above | tie)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((r["q_bid"] << QUERY_BITS) + i), pa.array(np.frombuffer(r["q_ids"], np.int64)[i]), pa.array(ids[j]),
                     pa.array(other[j]), pa.array(s[i, j].astype(np.int64))], names=["q", "query_id", "vec_id", "row", "score"])

    return map_batches(meetings, run, "q bigint, query_id bigint, vec_id bigint, row bigint, score bigint")


def _shards(blocks: int, size: int, cores: int) -> int:
    """A query block goes to every shard, so more input on as many cores means
    longer shards and not, below ``SHARD_BYTES`` each, more copies."""
    return max(1, min(blocks, max(SHARDS_PER_CORE * cores, -(-size // SHARD_BYTES))))


def search(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best candidates."""
    spark = vectors.sparkSession
    candidates = write_scratch(blocks(vectors, id_col, vector_col), "topk-blocks")
    queries = write_scratch(query_blocks(candidates, every), "topk-queries")
    total, norm, size = candidates.agg(F.count(F.lit(1)), F.max("norm"),
                                       F.sum(F.col("n").cast("long") * (F.col("dim") * F.col("item") + 16))).first()
    shards = _shards(total, size or 0, spark.sparkContext.defaultParallelism)
    reach = F.ceil(F.col("norm") * F.lit(float(norm or 0))).cast("long") + 1
    state = write_scratch(queries.select(
        F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"), "bid", reach.alias("r"))
        .select((F.shiftleft("bid", QUERY_BITS) + F.col("i")).alias("q"), (-F.col("r")).alias("lo"),
                F.ceil((2 * F.col("r") + 1) / BINS).cast("long").alias("width"), (2 * F.col("r") + BINS).cast("long").alias("span"),
                F.lit(0).cast("long").alias("above"), F.lit(False).alias("all")), "topk-state")
    while not (open_ := state.filter("width > 0")).isEmpty():
        counts = _count(_meetings(queries, candidates, open_.drop("all"), shards), k)
        state = write_scratch(_narrow(open_, counts, k).unionByName(state.filter("width <= 0")), "topk-state")
    final = state.select("q", F.when(F.col("all"), F.lit(-2**62)).otherwise(F.col("lo")).alias("lo"), "width", "span",
                         F.when(F.col("all"), F.lit(0)).otherwise(F.col("above")).alias("above"))
    found = _pass(_meetings(queries, candidates, final, shards), k)
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id", "row"))
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", "rank", F.when(F.col("vec_id") < NO_ID, F.col("vec_id")).alias("vec_id"), "score"))


ORACLE = """
WITH v AS (SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
           FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, c.r,
             CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score, q.r AS qr
      FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id NULLS LAST, r) AS rank FROM p) WHERE rank <= 20
"""
