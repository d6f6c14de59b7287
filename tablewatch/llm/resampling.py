"""Target-distribution importance resampling: hashed word features weigh every
document towards a target set, and exact ranks come from parallel sorting by
regular sampling.

1. One pass over the documents and one over the target set count the features
   (runs of 1 to ``NGRAMS`` words) per bucket: crc32 of the feature's bytes
   modulo the number of buckets.  The counts are ``buckets`` rows at any size.
2. The gain of each bucket becomes an array.  A second pass adds up the gains
   of a document's features by array look-ups; the floored mean is its weight,
   and Gumbel noise drawn from its id is added to give its score.
3. Documents that may be drawn are sorted inside their partitions (runs).
   Every run gives its rows at regular steps; the sorted samples give regular
   splitters.  The segments between two splitters are exchanged and each is
   merged by one task; prefix sums of the segments' counts turn places inside
   a segment into exact ranks.  Segments that lie wholly beyond the last draw
   are never exchanged.

A sort key ends with the row's own number, so repeated rows and ties of any
number still fall into different segments.  At most ``SAMPLES`` samples a
segment reach the driver, for at most ``MAX_SEGMENTS`` segments.

Defined cases: null texts are empty; documents without words have no features
and weight 0; equal scores go to the smaller id, null ids first, repeated rows
in table order; the id of a null is the empty text in the noise; an empty
table gives an empty result, an empty target set counts 0 in every bucket;
other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.exprs import quote_ident
from tablewatch.llm.common import ALNUM, Texts, runs_of_bytes, text_runs, write_scratch

BUCKETS = 10_000
NGRAMS = 2
MIN_WORDS = 20
PER_CENT = 25
SEED = 7
SAMPLES = 64  # of a segment
MAX_SEGMENTS = 4096
LONG_WORD = 64  # bytes; longer ones are summed one by one

_POLYNOMIAL = 0xEDB88320  # of CRC-32


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(_POLYNOMIAL), t >> 1)
    return t


_TABLE = _crc_table()


def crc_over(state: np.ndarray, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of what gave ``state`` (0: nothing) followed by each byte run."""
    size = end - start
    order = np.argsort(-size, kind="stable")
    s, n = start[order], size[order]
    crc = state[order] ^ np.uint32(0xFFFFFFFF)
    n_long = int(np.searchsorted(-n, -LONG_WORD, "left"))
    for i in range(n_long):
        crc[i] = zlib.crc32(buf[s[i]:s[i] + n[i]].tobytes(), int(crc[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    for k in range(int(n[n_long]) if n_long < len(n) else 0):
        live = slice(n_long, int(np.searchsorted(-n, -k, "left")))  # longer than k
        c = crc[live]
        crc[live] = _TABLE[(c ^ buf[s[live] + k]) & np.uint32(255)] ^ (c >> np.uint32(8))
    out = np.empty_like(crc)
    out[order] = crc ^ np.uint32(0xFFFFFFFF)
    return out


def feature_buckets(texts: Texts, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every feature, its text, words of each text)."""
    buf, start, end, doc = runs_of_bytes(texts, ALNUM)
    n_words = np.bincount(doc, minlength=len(texts))
    space = np.full(1, 32, np.uint8)
    zero = np.zeros(len(start), np.uint32)
    crc, at = crc_over(zero, buf, start, end), np.arange(len(start))
    out, owner = [crc], [doc]
    for _ in range(1, ngrams):
        ok = at + 1 < len(start)
        ok[ok] = doc[at[ok]] == doc[at[ok] + 1]
        crc, at = crc[ok], at[ok] + 1
        crc = crc_over(crc, space, np.zeros(len(crc), np.int64), np.ones(len(crc), np.int64))
        crc = crc_over(crc, buf, start[at], end[at])
        out.append(crc)
        owner.append(doc[at])
    return (np.concatenate(out) % np.uint32(buckets)).astype(np.int64), np.concatenate(owner), n_words


def bucket_counts(rows: DataFrame, text_col: str, ngrams: int = NGRAMS, buckets: int = BUCKETS) -> np.ndarray:
    """Features of all texts per bucket: each task adds up its own counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, texts in text_runs(batch.column(0)):
                total += np.bincount(feature_buckets(texts, ngrams, buckets)[0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counts = rows.select(F.col(quote_ident(text_col)).alias("text")).mapInArrow(run, "bucket long, n long") \
        .groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in counts.collect():  # at most one row a bucket
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    s_all, t_all, m = float(source.sum()), float(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (s_all + m)) / ((s + 1.0) * (t_all + m))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str, ngrams: int, keep: tuple[str, ...]) -> DataFrame:
    """id, kept columns, n_words, n_features, weight and the row's own number."""
    source = docs.select(F.col(quote_ident(id_col)).alias("__id"),
                         *[F.col(quote_ident(c)).alias(f"__keep_{i}") for i, c in enumerate(keep)],
                         F.col(quote_ident(text_col)).alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [T.StructField(c, T.LongType())
                                                       for c in ("n_words", "n_features", "weight", "row")])
    buckets = len(gain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            rest = batch.drop_columns(["__text"])
            for lo, hi, texts in text_runs(batch.column("__text")):
                bucket, owner, n_words = feature_buckets(texts, ngrams, buckets)
                n = np.bincount(owner, minlength=hi - lo)
                total = np.zeros(hi - lo, np.int64)
                np.add.at(total, owner, gain[bucket])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                own = rest.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    own.columns + [pa.array(x) for x in (n_words, n, weight, row + np.arange(hi - lo))],
                    names=own.schema.names + ["n_words", "n_features", "weight", "row"])
                row += hi - lo

    return source.mapInArrow(run, schema)


def noise(id_text: Column, seed: int) -> Column:
    """Gumbel noise of the id in thousandths, floored."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_text, F.lit(""))), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def id_key(down: int, own, row: int) -> tuple:
    """The sort key: descending score, id (null first), row number."""
    return down, own is not None, 0 if own is None else own, row


def regular_samples(rows: DataFrame, step: int) -> list[tuple]:
    """Sort keys (descending score, id, row) of every ``step``-th row of each
    sorted run; a run begins at an offset of its own within the first step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        seen = (TaskContext.get().partitionId() * 0x9E3779B1) % step
        for batch in batches:
            take = np.arange((-seen - 1) % step, batch.num_rows, step)
            seen += batch.num_rows
            yield batch.take(pa.array(take))

    return [(r["down"], r["__id"], r["row"]) for r in rows.mapInArrow(run, rows.schema).collect()]


def with_segments(rows: DataFrame, splitters: list[tuple]) -> DataFrame:
    """Adds ``segment``, the number of splitters at or below the row's key.
    Scores are searched as an array; only rows whose score a splitter shares
    compare ids and row numbers."""
    schema = T.StructType([*rows.schema.fields, T.StructField("segment", T.LongType())])
    downs = np.array([x[0] for x in splitters], np.int64)
    keys = [id_key(*x) for x in splitters]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            down = np.asarray(batch.column("down"))
            segment, end = np.searchsorted(downs, down, "left"), np.searchsorted(downs, down, "right")
            tied = np.flatnonzero(segment < end)
            own = batch.select(["__id", "row"]).take(pa.array(tied))
            for i, x, row in zip(tied.tolist(), own.column(0).to_pylist(), own.column(1).to_pylist()):
                segment[i] = bisect_right(keys, id_key(int(down[i]), x, row), int(segment[i]), int(end[i]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(segment.astype(np.int64))], names=schema.names)

    return rows.mapInArrow(run, schema)


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text_col: str = "text", ngrams: int = NGRAMS, buckets: int = BUCKETS, min_words: int = MIN_WORDS,
             per_cent: int = PER_CENT, seed: int = SEED, segments: int | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every document with n_features, weight, score and its rank among the
    drawn (null: not drawn).  ``segments``: how many tasks merge the sorted
    runs, by default the session's shuffle partitions."""
    spark = docs.sparkSession
    gain = gains(bucket_counts(docs, text_col, ngrams, buckets), bucket_counts(target, target_text_col, ngrams, buckets))
    rows = weighed(docs, gain, id_col, text_col, ngrams, keep)
    score = F.col("weight") + noise(F.col("__id").cast("string"), seed)
    rows = write_scratch(rows.withColumn("down", -score), "resample-scored")
    may, out = F.col("n_words") >= min_words, [F.col("__id").alias(id_col),
                                               *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
                                               "n_features", "weight", (-F.col("down")).alias("score")]
    drawn = rows.filter(may)
    n = drawn.count()
    wanted = per_cent * n // 100
    if not wanted:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    order = [F.col("down").asc(), F.col("__id").asc_nulls_first(), F.col("row").asc()]
    p = max(1, min(segments or int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_SEGMENTS))
    runs = drawn.select("down", "__id", "row").sortWithinPartitions(*order)
    samples = sorted(regular_samples(runs, max(1, n // (p * SAMPLES))), key=lambda x: id_key(*x)) \
        if p > 1 else []
    splitters = [samples[len(samples) * k // p] for k in range(1, p)] if samples else []
    dealt = with_segments(drawn, splitters)
    count = {r["segment"]: r["n"] for r in dealt.groupBy("segment").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, {}
    for k in range(len(splitters) + 1):
        offsets[k] = before
        before += count.get(k, 0)
    last = max(k for k, at in offsets.items() if at < wanted)
    # Only segments with a draw are exchanged; the rest need no rank.
    first_rank = F.get(F.array(*[F.lit(offsets[k]).cast("long") for k in range(last + 1)]), F.col("segment"))
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*order))
    ranked = dealt.filter(F.col("segment") <= last).withColumn("rank", (first_rank + place).cast("long")) \
        .withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank")))
    beyond = dealt.filter(F.col("segment") > last).withColumn("rank", F.lit(None).cast("long"))
    rest = rows.filter(~may).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*out, "rank").unionAll(beyond.select(*out, "rank")).unionAll(rest.select(*out, "rank"))


# DuckDB has no crc32; its bit steps are a fold over each feature's bytes
# (a byte's first entry is mixed in, the eight that follow shift).
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"


def _features_sql(table: str, key: str) -> str:
    return f"""
      SELECT {key} AS id, unnest(list_concat(w, list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1]))) AS f
      FROM (SELECT {key}, {_WORDS} AS w FROM {table} WHERE text IS NOT NULL)"""


ORACLE = f"""
  WITH fd AS MATERIALIZED ({_features_sql('documents', 'doc_id')}), ft AS MATERIALIZED ({_features_sql('benchmark', 'item_id')}),
  crc AS MATERIALIZED (
    SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
             range(octet_length(encode(f))),
             lambda i: list_prepend(('0x' || substr(hex(encode(f)), 2 * i + 1, 2))::BIGINT, [-1, -1, -1, -1, -1, -1, -1, -1]::BIGINT[])))),
             lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, 3988292384 * (c & 1)) END)) % {BUCKETS} AS b
    FROM (SELECT f FROM fd UNION SELECT f FROM ft)),
  d AS MATERIALIZED (SELECT id, b FROM fd JOIN crc USING (f)), t AS MATERIALIZED (SELECT b FROM ft JOIN crc USING (f)),
  ns AS (SELECT b, count(*) AS s FROM d GROUP BY b), nt AS (SELECT b, count(*) AS t FROM t GROUP BY b),
  g AS MATERIALIZED (
    SELECT b, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM d)::DOUBLE + {BUCKETS})
                    / ((s + 1.0::DOUBLE) * ((SELECT count(*) FROM t)::DOUBLE + {BUCKETS}))))::BIGINT AS gain
    FROM ns LEFT JOIN nt USING (b)),
  w AS (SELECT id, count(*) AS n, floor(sum(gain) / count(*)::DOUBLE)::BIGINT AS weight FROM d JOIN g USING (b) GROUP BY id),
  s AS (
    SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                      / 4294967296.0::DOUBLE)))::BIGINT AS score,
           coalesce(n, 0) >= {2 * MIN_WORDS - 1} AS may
    FROM documents LEFT JOIN w ON id = doc_id)
  SELECT doc_id, n_features, weight, score,
         CASE WHEN may AND place <= {PER_CENT} * (SELECT count(*) FROM s WHERE may) // 100 THEN place END AS rank
  FROM (SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place FROM s)"""
