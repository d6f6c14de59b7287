"""K3: one global k-means over the z-score; per-system percent rank of the
distance to the assigned centre.

With one feature a clustering is k numbers and Lloyd's iteration moves k-1
borders on a line, so it needs no rescans:

* standardisation (mean and unbiased standard deviation) is one aggregate;
* the distinct values with their counts are written once, in value order;
* counts and sums per bucket (leading bits of the values' sortable form, at
  most 65,536 buckets) come to the driver as prefix sums.  A step looks up the
  buckets below each border; only a bucket that holds a border is split
  further: its values, or where they are many the next bits' counts and sums,
  are read from the written table and kept;
* the starting centres are the (2i+1)/2k discrete quantiles, read off the same
  prefix sums; rows go to the nearest centre (the lower one on ties); centres
  are kept to ``CENTER_DIGITS`` decimals, so that the order in which partial
  sums meet does not reach the result.

Nothing is sampled, and the outcome depends on the rows alone, not on how they
are partitioned.  Assignment and distance are column arithmetic with the
centres as literals.
"""

from __future__ import annotations

import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident, rank_key
from tablewatch.operators.quantiles import DIGIT, order_bits
from tablewatch.operators.splits import percent_rank_at_least
from tablewatch.params import Cols, Scale
from tablewatch.session import scratch_path

CENTER_DIGITS = 9
# Values of one bucket that the driver reads at most; fuller buckets are split
# by their next bits.
BUCKET_VALUES = 200_000


def _bits(v: float) -> int:
    """``order_bits`` of a finite number."""
    raw = struct.unpack("q", struct.pack("d", abs(v) + 0.0))[0]
    return -raw if v < 0 else raw


class ValueIndex:
    """Prefix sums over a written table of distinct values (``f``, count ``c``)
    in value order, refined where they are asked for."""

    def __init__(self, table: DataFrame, limit: int = BUCKET_VALUES):
        self.table, self.limit = table, limit
        self.top = 64 - DIGIT
        self.hist: dict[tuple[int, int], tuple] = {}    # bucket -> digits, distinct, counts, sums one level below
        self.values: dict[tuple[int, int], tuple] = {}  # bucket -> values, counts
        self._hist((64, 0))
        digits, distinct, counts, _ = self.hist[64, 0]
        self.n = int(counts.sum())

    def _rows(self, bucket: tuple[int, int]) -> DataFrame:
        shift, digit = bucket
        if shift == 64:
            return self.table
        # A range of values: the table is stored in their order, so other row groups are not read.
        lo, hi = _value(digit << shift), _value(((digit + 1) << shift) - 1)
        return self.table.filter((F.col("f") >= F.lit(lo)) & (F.col("f") <= F.lit(hi)))

    def _hist(self, bucket: tuple[int, int]) -> None:
        shift = bucket[0] - DIGIT
        got = self._rows(bucket).groupBy(F.shiftright(order_bits(F.col("f")), shift).alias("d")).agg(
            F.count(F.lit(1)), F.sum("c"), F.sum(F.col("f") * F.col("c"))).collect()  # at most 2^16 rows
        got.sort(key=lambda r: r[0])
        self.hist[bucket] = tuple(np.array([r[i] for r in got], t) for i, t in enumerate((np.int64, np.int64, np.int64, float)))

    def read(self, digits: list[int]) -> None:
        """The values of several top buckets by one job, where they are few."""
        have, distinct, _, _ = self.hist[64, 0]
        todo = []
        for d in digits:
            at = int(np.searchsorted(have, d))
            if (self.top, d) not in self.values and at < len(have) and have[at] == d and distinct[at] <= self.limit:
                todo.append(d)
        if sum(int(distinct[np.searchsorted(have, d)]) for d in todo) > self.limit:
            todo = todo[:1]
        if not todo:
            return
        rows = self._rows((self.top, todo[0]))
        for d in todo[1:]:
            rows = rows.unionAll(self._rows((self.top, d)))
        got = rows.toPandas().sort_values("f")
        f, c = got["f"].to_numpy(float), got["c"].to_numpy(np.int64)
        own = np.array([_bits(v) >> self.top for v in f.tolist()], np.int64)
        for d in todo:
            self.values[self.top, d] = f[own == d], c[own == d]

    def _open(self, bucket: tuple[int, int], distinct: int) -> None:
        if bucket in self.values or bucket in self.hist:
            return
        if distinct <= self.limit:
            got = self._rows(bucket).toPandas().sort_values("f")
            self.values[bucket] = got["f"].to_numpy(float), got["c"].to_numpy(np.int64)
        else:
            self._hist(bucket)

    def at_rank(self, rank: int, bucket: tuple[int, int] = (64, 0)) -> float:
        """The rank-th value (from 1)."""
        if bucket in self.values:
            f, c = self.values[bucket]
            return float(f[np.searchsorted(np.cumsum(c), rank)])
        digits, distinct, counts, _ = self.hist[bucket]
        run = np.cumsum(counts)
        i = int(np.searchsorted(run, rank))
        inner = (bucket[0] - DIGIT, int(digits[i]))
        self._open(inner, int(distinct[i]))
        return self.at_rank(rank - int(run[i] - counts[i]), inner)

    def below(self, a: float, b: float, bucket: tuple[int, int] = (64, 0)) -> tuple[int, float]:
        """(count, sum) of the values that are nearer to ``a`` than to the
        larger ``b`` or as near."""
        if bucket in self.values:
            f, c = self.values[bucket]
            near = (f - a) * (f - a) <= (f - b) * (f - b)
            return int(c[near].sum()), float((f[near] * c[near]).sum())
        digits, distinct, counts, sums = self.hist[bucket]
        shift = bucket[0] - DIGIT
        border = _bits((a + b) / 2) >> shift
        i = int(np.searchsorted(digits, border))
        n, total = int(counts[:i].sum()), float(sums[:i].sum())
        if i < len(digits) and digits[i] == border:
            inner = (shift, border)
            self._open(inner, int(distinct[i]))
            more = self.below(a, b, inner)
            n, total = n + more[0], total + more[1]
        return n, total

    def estimate(self, a: float, b: float) -> tuple[int, float]:
        """``below`` without a look inside the border's bucket."""
        digits, _, counts, sums = self.hist[64, 0]
        i = int(np.searchsorted(digits, _bits((a + b) / 2) >> self.top))
        half = slice(i, i + 1)
        return int(counts[:i].sum() + counts[half].sum() // 2), float(sums[:i].sum() + sums[half].sum() / 2)

    def total(self) -> tuple[int, float]:
        return self.n, float(self.hist[64, 0][3].sum())


def _value(bits: int) -> float:
    """The number of an ``order_bits`` value (beyond infinity: infinity)."""
    size = min(abs(bits), 2047 << 52)
    v = struct.unpack("d", struct.pack("q", size))[0]
    return -v if bits < 0 else v


def _step(index: ValueIndex, centers: list[float], below) -> list[float]:
    """Means of the values nearest to each (ascending) centre; a centre that
    has none stays."""
    cuts = [(0, 0.0), *(below(a, b) for a, b in zip(centers, centers[1:])), index.total()]
    new = {round((s1 - s0) / (n1 - n0), CENTER_DIGITS) if n1 > n0 else c
           for (n0, s0), (n1, s1), c in zip(cuts, cuts[1:], centers)}
    return sorted(new)


def fit_centers(rows: DataFrame, feature: str, k: int, max_iter: int = 50,
                scale: Scale = Scale()) -> list[float]:
    """Centres of Lloyd's iteration from quantile starts, ascending; fewer
    than k if the feature has fewer distinct values (empty without rows)."""
    spark = rows.sparkSession
    path = scratch_path(spark, "kmeans-values")
    (rows.groupBy(F.col(quote_ident(feature)).alias("f")).agg(F.count(F.lit(1)).alias("c"))
     .repartitionByRange("f").sortWithinPartitions("f").write.parquet(path))
    index = ValueIndex(spark.read.schema("f double, c bigint").parquet(path))
    if not index.n:
        return []
    ranks = [max(1, -(-(2 * i + 1) * index.n // (2 * k))) for i in range(k)]
    centers = sorted({round(index.at_rank(r), CENTER_DIGITS) for r in ranks})
    # Where the borders will pass, by the counts alone: those buckets are read at once.
    guess, seen = centers, []
    for _ in range(max_iter):
        seen += [(_bits((a + b) / 2) >> index.top) for a, b in zip(guess, guess[1:])]
        moved = _step(index, guess, index.estimate)
        if moved == guess:
            break
        guess = moved
    index.read(list(dict.fromkeys(d + e for d in seen for e in (0, -1, 1))))
    for _ in range(max_iter):
        new = _step(index, centers, index.below)
        if new == centers:
            break
        centers = new
    return centers


def _nearest(f, centers: list[float]):
    """(index of the nearest centre, squared distance to it)."""
    sq = F.array(*[(f - F.lit(c)) * (f - F.lit(c)) for c in centers])
    best = F.array_min(sq)
    return (F.array_position(sq, best) - 1).cast("int"), best


def kmeans_scores(scored: DataFrame, cols: Cols, k: int = 2, max_iter: int = 50,
                  scale: Scale = Scale()) -> DataFrame:
    """Rows with a usable z + cluster (int, centres ascending) and km_dist.
    Rows whose z is NULL or NaN are skipped."""
    keep = [*cols.key, "z"]
    base = (scored.select(*[F.col(quote_ident(c)) for c in keep])
            .filter(F.col("z").isNotNull() & ~F.isnan(F.col("z"))))
    g = base.agg(F.avg("z").alias("m"), F.stddev_samp("z").alias("s")).first()
    mean, std = g["m"] or 0.0, g["s"]
    feat = (F.col("z") - F.lit(mean)) / F.lit(std) if std else F.lit(0.0)
    rows = base.withColumn("_tw_f", feat)
    centers = fit_centers(rows, "_tw_f", k, max_iter, scale) or [0.0]
    cluster, best = _nearest(F.col("_tw_f"), centers)
    return rows.select(*[F.col(quote_ident(c)) for c in keep], cluster.alias("cluster"),
                       F.sqrt(best).alias("km_dist"))


def kmeans_anomalies(scored: DataFrame, cols: Cols, k: int = 2, pr_cutoff: float = 0.99,
                     max_iter: int = 50, scale: Scale = Scale(),
                     rank_digits: int | None = None, sizes=None) -> DataFrame:
    """sys, ts, x, z, cluster, km_dist, km_pr for rows with km_pr >= cutoff."""
    s = kmeans_scores(scored, cols, k, max_iter, scale)
    return kmeans_cut(s, cols, pr_cutoff, scale, rank_digits, sizes)


def kmeans_cut(s: DataFrame, cols: Cols, pr_cutoff: float = 0.99, scale: Scale = Scale(),
               rank_digits: int | None = None, sizes=None) -> DataFrame:
    """Rows of ``kmeans_scores`` whose per-system percent rank of km_dist is
    >= ``pr_cutoff`` (see ``rank_key`` for ``rank_digits``).  ``sizes``: rows
    of ``s`` per system if already known."""
    ranked = percent_rank_at_least(s.withColumn("_tw_rk", rank_key(F.col("km_dist"), rank_digits)),
                                   [cols.sys], "_tw_rk", pr_cutoff, "km_pr", scale, sizes=sizes)
    return ranked.select(*[F.col(quote_ident(c)) for c in cols.key],
                         "z", "cluster", "km_dist", "km_pr")
