"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a share of the total budget by weight; a share stops at
``max_repeat`` times the source's size and the excess goes to the others.  A
target of t times the size takes every document floor(t) times and, for the
rest, those whose hash lies below a threshold.  The threshold is found from
histograms: words summed by source and leading hash bits; the bucket in which
the running sum passes the target is split by the next bits, and so on until
it holds a single hash.  Only that bucket's rows are read again, no row is
sorted, and the final choice is a filter.  As one hash orders a source for
every budget, smaller budgets are subsets of larger ones.

Defined cases: null or empty text has size 0 and null source is a source of
its own (last); a null id hashes as the empty text; rows that repeat an id
share its hash and are taken together; an empty table gives an empty result;
a source without words has target 0.  Other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.llm.common import WORD_PATTERN, col, write_scratch

WEIGHTS = (3, 1, 2)
KEY_BITS = 60
LEVEL_BITS = 12
# Per-source tables up to this many rows (under 10 MB) are broadcast.
BROADCAST_SOURCES = 50_000


def text_size(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def hash_key(doc_id: Column) -> Column:
    """60 bits of the id's MD5, as a long."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, KEY_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = 1.5,
                   max_repeat: float = 2.0) -> DataFrame:
    """Per source: size, weight and target.  Shares are levelled in closed
    form: sources ordered by size over weight are cut off from the smallest
    on, as long as their share at the level so far lies above the cut."""
    per = sizes.groupBy("__source").agg(F.sum("__size").alias("source_size"))
    by_name = Window.orderBy(F.col("__source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.lit(float(weights[-1]))
    for i in reversed(range(len(weights) - 1)):
        weight = F.when(place == i, F.lit(float(weights[i]))).otherwise(weight)
    per = per.withColumn("__w", weight).withColumn("__cap", F.col("source_size") * F.lit(float(max_repeat)))
    order = Window.orderBy((F.col("__cap") / F.col("__w")).asc(), F.col("__source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))
    left_w = F.sum("__w").over(everything) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))
    per = per.withColumn("__cut", F.col("__cap") * left_w < F.col("__w") * left)
    level = ((F.lit(float(share)) * F.sum("source_size").over(everything)
              - F.sum(F.when(F.col("__cut"), F.col("__cap")).otherwise(F.lit(0.0))).over(everything))
             / F.nullif(F.sum(F.when(F.col("__cut"), F.lit(0.0)).otherwise(F.col("__w"))).over(everything), F.lit(0.0)))
    return (per.withColumn("target", F.when(F.col("__cut"), F.col("__cap"))
                           .otherwise(F.least(F.col("__w") * level, F.col("__cap"))))
            .select("__source", "source_size", "target"))


def _with_sources(rows: DataFrame, per: DataFrame, few: bool) -> DataFrame:
    per = per.withColumnRenamed("__source", "__s")
    return rows.join(F.broadcast(per) if few else per,
                     F.col("__source").eqNullSafe(F.col("__s")), "left").drop("__s")


def thresholds(keyed: DataFrame, targets: DataFrame) -> tuple[DataFrame, bool]:
    """Per source: ``__full`` times every document, and once more those with
    a key below ``__below``, or up to ``__upto`` in the boundary bucket."""
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    state = write_scratch(
        targets.withColumn("__full", full)
        .withColumn("__rest", F.col("target") - F.col("__full") * F.col("source_size"))
        .withColumn("__acc", F.lit(0).cast("long")).withColumn("__path", F.lit(0).cast("long"))
        .withColumn("__below", F.when(F.col("__rest") > 0, F.lit(None).cast("long")).otherwise(F.lit(0).cast("long"))),
        "mix-state")
    few = state.count() <= BROADCAST_SOURCES
    for level in range(1, KEY_BITS // LEVEL_BITS + 1):
        shift, outer = KEY_BITS - LEVEL_BITS * level, KEY_BITS - LEVEL_BITS * (level - 1)
        open_ = state.filter(F.col("__below").isNull())
        rows = _with_sources(keyed, open_.select("__source", "__path", F.lit(True).alias("__open")), few)
        hist = (rows.filter(F.col("__open") & (F.shiftright("__key", outer) == F.col("__path")))
                .groupBy("__source", F.shiftright("__key", shift).alias("__bucket"))
                .agg(F.sum("__size").alias("__sum"), F.min("__key").alias("__lo"), F.max("__key").alias("__hi")))
        run = Window.partitionBy("__source").orderBy("__bucket")
        hist = hist.withColumn("__cum", F.sum("__sum").over(run))
        hist = _with_sources(hist, open_.select("__source", "__rest", "__acc"), few)
        edge = (hist.filter(F.col("__acc") + F.col("__cum") > F.col("__rest"))
                .groupBy("__source").agg(F.min_by(F.struct("__bucket", "__sum", "__cum", "__lo", "__hi"), "__bucket").alias("__e")))
        merged = _with_sources(state, edge, few)
        acc = F.col("__acc") + F.col("__e.__cum") - F.col("__e.__sum")
        single = F.col("__e.__lo") == F.col("__e.__hi")
        nearer = F.abs(acc + F.col("__e.__sum") - F.col("__rest")) < F.abs(acc - F.col("__rest"))
        edge_below = F.when(nearer, F.col("__e.__hi") + 1).otherwise(F.col("__e.__lo"))
        todo = F.col("__below").isNull()
        state = write_scratch(merged.select(
            "__source", "source_size", "target", "__full", "__rest",
            F.when(todo & F.col("__e").isNotNull(), acc).otherwise(F.col("__acc")).alias("__acc"),
            F.when(todo & F.col("__e").isNotNull(), F.col("__e.__bucket")).otherwise(F.col("__path")).alias("__path"),
            F.when(~todo, F.col("__below"))
            .when(F.col("__e").isNull(), F.lit(1 << KEY_BITS))  # the sum never passes the target
            .when(single, edge_below).alias("__below")), "mix-state")
        if state.filter(F.col("__below").isNull()).isEmpty():
            break
    return state, few


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = WEIGHTS, share: float = 1.5, max_repeat: float = 2.0) -> DataFrame:
    """One row per input row: id, size, source_size, target, copies, taken."""
    sized = write_scratch(docs.select(
        col(id_col).alias("__id"), col(source_col).alias("__source"),
        text_size(col(text_col)).alias("__size"), hash_key(col(id_col)).alias("__key")), "mix-sizes")
    plan, few = thresholds(sized, source_targets(sized, weights, share, max_repeat))
    copies = F.col("__full") + (F.col("__key") < F.col("__below")).cast("long")
    return (_with_sources(sized, plan, few)
            .select(F.col("__id").alias(id_col), F.col("__size").alias("size"), "source_size", "target",
                    copies.alias("copies"), (F.col("__size") * copies).alias("taken")))


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    source_col: str = "source", **options) -> DataFrame:
    """The mix itself: the input's rows and columns, each row as often as it
    is taken.  Texts are not shuffled; only the per-source plan meets them."""
    sized = write_scratch(docs.select(
        col(source_col).alias("__source"), text_size(col(text_col)).alias("__size"),
        hash_key(col(id_col)).alias("__key")), "mix-sizes")
    plan, few = thresholds(sized, source_targets(sized, **options))
    plan = plan.select("__source", "__full", "__below")
    keyed = docs.withColumns({"__source": col(source_col), "__key": hash_key(col(id_col))})
    copies = (F.col("__full") + (F.col("__key") < F.col("__below")).cast("long")).cast("int")
    return (_with_sources(keyed, plan, few).withColumn("__n", F.explode(F.array_repeat(F.lit(1), copies)))
            .select(*map(col, docs.columns)))


ORACLE = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS w,
              source_size * 2.0::DOUBLE AS cap, sum(source_size) OVER () AS total FROM s0),
s2 AS (SELECT *, cap * (sum(w) OVER () - coalesce(sum(w) OVER b, 0.0)) < w * (1.5::DOUBLE * total - coalesce(sum(cap) OVER b, 0.0)) AS cut
       FROM s1 WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
s3 AS (SELECT source, source_size, CASE WHEN cut THEN cap ELSE least(w * ((1.5::DOUBLE * total - sum(CASE WHEN cut THEN cap ELSE 0.0::DOUBLE END) OVER ())
              / nullif(sum(CASE WHEN cut THEN 0.0::DOUBLE ELSE w END) OVER (), 0.0)), cap) END AS target FROM s2),
s4 AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS fully FROM s3),
k AS (SELECT source, key, sum(size) AS ksum, sum(sum(size)) OVER (PARTITION BY source ORDER BY key) AS cum FROM d GROUP BY source, key),
t AS (SELECT k.source, k.key, coalesce(cum <= rest OR (cum - ksum <= rest AND abs(cum - rest) < abs(cum - ksum - rest)), false) AS more
      FROM k JOIN (SELECT *, target - fully * source_size AS rest FROM s4) q ON k.source IS NOT DISTINCT FROM q.source AND rest > 0)
SELECT d.doc_id, d.size, s4.source_size, s4.target,
       (fully + CASE WHEN coalesce(t.more, false) THEN 1 ELSE 0 END)::BIGINT AS copies,
       (d.size * (fully + CASE WHEN coalesce(t.more, false) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN s4 ON d.source IS NOT DISTINCT FROM s4.source
LEFT JOIN t ON d.source IS NOT DISTINCT FROM t.source AND d.key = t.key
"""
