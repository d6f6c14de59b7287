"""K5 / M1 / M2 / M5 for several features: exact nearest neighbours per system.

Features are standardised within the system, equal points are counted once
with a weight, and the points are laid out in a tree of square cells: a cell
with more than ``leaf`` different points is halved in every feature,
one aggregate per level, until none is left.  A cell's box is that of its
points, so nothing depends on how coordinates round.

A leaf's points meet each other first: dealt by leaf, sorted and streamed, so
that a task holds the points of one leaf and nothing larger leaves it than a
distance per point.  A system of one leaf is done then.  Else the distance to
the kth neighbour in the own leaf bounds a point's reach (a leaf with too few
rows is bounded by its parent), and descending from the system's cell, level
by level, a leaf meets only the cells within that reach.  Only the points with
another leaf in reach are dealt once more, to those leaves (many points that
reach one leaf are dealt to several tasks, each with a copy of it); k rows per
point and leaf come back and a ranking window keeps the nearest k.  Pairs of
points are never rows.  Levels are joins of cell tables (broadcast if measured
small, else shuffled and split by AQE).

The rank cut is taken on points, weighted by their rows; the table's rows are
read again only for the few points that pass it.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from tablewatch.functions.exprs import quote_ident, rank_key, zscore_expr
from tablewatch.operators.joins import (attach_small, estimate_row_bytes, materialize, materialize_observed,
                                        should_broadcast)
from tablewatch.operators.splits import N as ROWS
from tablewatch.operators.splits import percent_rank_at_least, running_below
from tablewatch.params import Cols, Scale
from tablewatch.session import scratch_path

BITS = 48            # a cell coordinate at the deepest level; below the 52 bits of a double
STEP = 1             # bits a level: halves per feature
SLACK = 1 + 1e-9     # over the rounding of a distance

S, W, N, LEVEL = "_tw_s", "_tw_w", "_tw_n", "_tw_level"
CELL, PARENT, UNIT, REACH = "_tw_cell", "_tw_parent", "_tw_unit", "_tw_reach"
ID, CHUNK, COPY, KTH, D = "_tw_id", "_tw_chunk", "_tw_copy", "_tw_kth", "_tw_d"
RK = "_tw_rk"

LEAF = 1024          # different points of a leaf
PAIRS = 1 << 18      # distances that a task holds
ASKING = 1 << 14     # points that meet one copy of a leaf


def _q(name: str) -> Column:
    return F.col(quote_ident(name))


def _names(prefix: str, d: int) -> list[str]:
    return [f"_tw_{prefix}{j}" for j in range(d)]


def _norm(parts: list[Column]) -> Column:
    return F.sqrt(reduce(lambda a, b: a + b, [p * p for p in parts]))


def _gap(lo: list[str], hi: list[str], other_lo: list[str], other_hi: list[str]) -> Column:
    """Least distance of two boxes; a point is a box with equal corners."""
    return _norm([F.greatest(F.lit(0.0), F.col(ol) - F.col(h), F.col(l) - F.col(oh))
                  for l, h, ol, oh in zip(lo, hi, other_lo, other_hi)])


def _span(lo: list[str], hi: list[str], other_lo: list[str], other_hi: list[str]) -> Column:
    """Greatest distance of two boxes."""
    return _norm([F.greatest(F.col(oh) - F.col(l), F.col(h) - F.col(ol))
                  for l, h, ol, oh in zip(lo, hi, other_lo, other_hi)])


def standardise(df: DataFrame, cols: Cols, features: list[str], scale: Scale = Scale()) -> DataFrame:
    """Rows + ``z_<feature>`` for every feature, as ``zscore`` does for one."""
    made = [f"z_{f}" for f in features]
    if set(made) & set(df.columns):
        raise ValueError(f"the input already has some of the columns {made}")
    stats = [s for j, f in enumerate(features)
             for s in (F.avg(_q(f)).alias(f"_tw_mean{j}"), F.stddev_samp(_q(f)).alias(f"_tw_std{j}"))]
    table, m = materialize_observed(df.groupBy(_q(cols.sys)).agg(*stats), rows=F.count(F.lit(1)))
    joined = attach_small(df, table, [cols.sys], "left", scale=scale, n_rows=m["rows"])
    return joined.withColumns({z: zscore_expr(_q(f), F.col(f"_tw_mean{j}"), F.col(f"_tw_std{j}"))
                               for j, (f, z) in enumerate(zip(features, made))}) \
        .drop(*[c for j in range(len(features)) for c in (f"_tw_mean{j}", f"_tw_std{j}")])


def _small(side: DataFrame, rows: int, scale: Scale) -> DataFrame:
    return F.broadcast(side) if should_broadcast(rows, estimate_row_bytes(side), scale) else side


def _shared(scale: Scale, sides: int) -> Scale:
    """For plans that may broadcast several tables: all of them together stay
    below ``broadcast_bytes``."""
    return replace(scale, broadcast_bytes=scale.broadcast_bytes // sides)


def _stored(df: DataFrame, name: str) -> DataFrame:
    """A table with a row per point, kept as Parquet in the shared scratch
    folder: a fraction of a checkpoint's bytes."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _cell(level: int, keys: list[Column]) -> Column:
    return F.struct(F.col(S).alias("s"), F.lit(level).alias("level"),
                    *[k.alias(f"k{j}") for j, k in enumerate(keys)])


def _located(pts: DataFrame, d: int, scale: Scale) -> DataFrame:
    """Points with integer coordinates in the square box of their system."""
    ps, cs = _names("p", d), _names("c", d)
    box = pts.groupBy(S).agg(*[F.min(p).alias(f"{p}_min") for p in ps],
                             F.greatest(*[F.max(p) - F.min(p) for p in ps], F.lit(0.0)).alias("_tw_side"))
    top = F.lit(2 ** BITS - 1).cast("bigint")
    placed = attach_small(pts, materialize(box), [S], "inner", scale=scale, null_safe=False)
    return placed.select(S, W, *ps, *[
        F.when(F.col("_tw_side") > 0, F.least(top, F.floor((F.col(p) - F.col(f"{p}_min")) / F.col("_tw_side")
                                                           * F.lit(float(2 ** BITS))).cast("bigint")))
        .otherwise(F.lit(0).cast("bigint")).alias(c) for p, c in zip(ps, cs)])


def _tree(pts: DataFrame, d: int, leaf: int, scale: Scale) -> list[tuple[DataFrame, int]]:
    """Per level: its cells (CELL, PARENT, ID, N different points, W rows, box,
    whether it is a leaf) and their number."""
    ps, cs, lo, hi = _names("p", d), _names("c", d), _names("lo", d), _names("hi", d)
    levels: list[tuple[DataFrame, int]] = []
    active = pts
    for level in range(BITS // STEP + 1):
        keys = [F.shiftright(c, BITS - STEP * level) for c in cs]
        up = [F.shiftright(c, BITS - STEP * (level - 1)) for c in cs] if level else keys
        cells = active.groupBy(_cell(level, keys).alias(CELL), _cell(level - 1, up).alias(PARENT)).agg(
            F.count(F.lit(1)).alias(N), F.sum(W).alias(W), *[F.min(p).alias(x) for p, x in zip(ps, lo)],
            *[F.max(p).alias(x) for p, x in zip(ps, hi)])
        cells = cells.withColumn("_tw_leaf", (F.col(N) <= leaf) | F.lit(level == BITS // STEP)) \
            .withColumn(ID, F.shiftleft(F.monotonically_increasing_id(), 6).bitwiseOR(F.lit(level)))
        cells, m = materialize_observed(cells, rows=F.count(F.lit(1)), cut=F.count_if(~F.col("_tw_leaf")))
        levels.append((cells, m["rows"]))
        if not m["cut"]:
            break
        cut = _small(cells.filter(~F.col("_tw_leaf")).select(F.col(CELL).alias("_tw_cut")), m["cut"], scale)
        active = pts.join(cut, _cell(level, keys) == F.col("_tw_cut"), "left_semi")
    return levels


def _in_leaves(pts: DataFrame, levels, d: int, leaf: int, scale: Scale) -> DataFrame:
    """Points with the leaf that holds them (ID).  A leaf at the deepest level
    may have any number of points: CHUNK deals them by hash."""
    scale = _shared(scale, len(levels))
    ps, cs = _names("p", d), _names("c", d)
    parts = []
    for level, (cells, rows) in enumerate(levels):
        keys = [F.shiftright(c, BITS - STEP * level) for c in cs]
        leaves = _small(cells.filter("_tw_leaf").select(CELL, ID, N), rows, scale)
        chunk = F.pmod(F.xxhash64(*ps), F.ceil(F.col(N) / F.lit(leaf))) if level == BITS // STEP else F.lit(0)
        parts.append(pts.withColumn("_tw_at", _cell(level, keys)).join(leaves, F.col("_tw_at") == F.col(CELL))
                     .select(S, ID, chunk.cast("bigint").alias(CHUNK), W, *ps))
    return reduce(DataFrame.unionAll, parts)


def _units(levels, d: int, k: int) -> DataFrame:
    """Every leaf that is not its whole system as a searcher: UNIT, its
    system, box, REACH (NULL: its whole system)."""
    lo, hi = _names("lo", d), _names("hi", d)
    ulo, uhi, plo, phi = _names("ulo", d), _names("uhi", d), _names("plo", d), _names("phi", d)
    parts = []
    for (cells, _), (above, _) in zip(levels[1:], levels):
        mine = cells.filter("_tw_leaf").select(F.col(ID).alias(UNIT), F.col(f"{CELL}.s").alias("_tw_us"),
                                               F.col(PARENT).alias("_tw_up"), F.col(W),
                                               *[F.col(a).alias(b) for a, b in zip(lo + hi, ulo + uhi)])
        parent = above.select(F.col(CELL).alias("_tw_above"), *[F.col(a).alias(b) for a, b in zip(lo + hi, plo + phi)])
        own = F.coalesce(F.when(F.col(W) > k, _span(ulo, uhi, ulo, uhi)), _span(ulo, uhi, plo, phi))
        parts.append(mine.join(parent, F.col("_tw_up") == F.col("_tw_above"))
                     .select(UNIT, "_tw_us", *ulo, *uhi, (own * SLACK).alias(REACH)))
    return reduce(DataFrame.unionAll, parts)


def _met(levels, d: int, k: int, scale: Scale) -> DataFrame:
    """UNIT, REACH, ID of a leaf in the unit's reach and that leaf's box."""
    lo, hi, ulo, uhi = (_names(p, d) for p in ("lo", "hi", "ulo", "uhi"))
    scale = _shared(scale, len(levels))
    root, rows = levels[0]
    start = _small(root.select(CELL, ID, W, *lo, *hi), rows, scale)
    front = _units(levels, d, k).join(start, F.col("_tw_us") == F.col(f"{CELL}.s"))
    for cells, rows in levels[1:]:
        below = cells.select(F.col(PARENT).alias("_tw_from"), F.struct(CELL, ID, W, *lo, *hi).alias("_tw_below"))
        front = front.join(_small(below, rows, scale), F.col(CELL) == F.col("_tw_from"), "left")
        kept = {c: F.when(F.col("_tw_from").isNull(), F.col(c)).otherwise(F.col(f"_tw_below.{c}"))
                for c in [CELL, ID, W, *lo, *hi]}
        front = front.select(UNIT, REACH, *ulo, *uhi, *[e.alias(c) for c, e in kept.items()]) \
            .filter(F.col(REACH).isNull() | (_gap(ulo, uhi, lo, hi) <= F.col(REACH)))
    front = _stored(front.drop(CELL), "grid-met")
    best = front.filter(F.col(W) > k).groupBy(UNIT).agg(F.min(_span(ulo, uhi, lo, hi) * SLACK).alias("_tw_best"))
    near = front.join(best.withColumnRenamed(UNIT, "_tw_u"), F.col(UNIT) == F.col("_tw_u"), "left")
    return near.withColumn(REACH, F.least(REACH, "_tw_best")) \
        .filter(F.col(REACH).isNull() | (_gap(ulo, uhi, lo, hi) <= F.col(REACH))).select(UNIT, REACH, ID, *lo, *hi)


def nearest(asks: np.ndarray, points: np.ndarray, rows: np.ndarray, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For stretches (from, to) of ``asks``: distances of the k nearest
    ``points`` in ascending order, and for how many rows each stands.  A point
    is no neighbour of itself, but its other rows are; entries without rows
    come with an infinite distance."""
    m = min(k, len(points))
    step = max(1, PAIRS // max(1, len(points)))
    for a in range(0, len(asks), step):
        part = asks[a:a + step]
        dist = np.zeros((len(part), len(points)))
        for j in range(points.shape[1]):
            gap = part[:, j, None] - points[None, :, j]
            dist += gap * gap
        np.sqrt(dist, out=dist)
        mine, at = np.nonzero(dist == 0)
        same = (part[mine] == points[at]).all(axis=1)
        mine, at = mine[same], at[same]
        alone = rows[at] == 1
        dist[mine[alone], at[alone]] = np.inf
        near = np.argpartition(dist, m - 1, axis=1)[:, :m] if m < len(points) else np.tile(np.arange(m), (len(part), 1))
        d = np.take_along_axis(dist, near, 1)
        order = np.argsort(d, axis=1, kind="stable")
        near, d = np.take_along_axis(near, order, 1), np.take_along_axis(d, order, 1)
        stands = rows[near]
        own = np.full(len(part), -1)
        own[mine] = at
        stands = stands - (near == own[:, None])
        yield a, a + len(part), d, stands


def _arrays(batch, names: list[str]) -> np.ndarray:
    return np.column_stack([np.asarray(batch.column(c)) for c in names])


def _by_group(batches, keys: list[str]):
    """Sorted batches cut where a key changes: (is it a new group, slice)."""
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = _arrays(batch, keys)
        begin = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]).any(axis=1)]))
        for a, b in zip(begin.tolist(), [*begin[1:].tolist(), batch.num_rows]):
            yield last is None or bool((ids[a] != last).any()), batch.slice(a, b - a)
            last = ids[a]


def _at_home(held: DataFrame, d: int, k: int, thresh: float | None) -> DataFrame:
    """Points with knn_dist among the points of their own leaf (of their own
    chunk of it), and KTH, the distance there of the kth other row."""
    ps = _names("p", d)
    columns = [S, ID, W, *ps]
    schema = held.select(*columns).schema.add("knn_dist", DoubleType()).add(KTH, DoubleType())

    def answered(parts):
        import pyarrow as pa
        group = pa.Table.from_batches(parts).combine_chunks().to_batches()[0]
        points, rows = _arrays(group, ps), np.asarray(group.column(W))
        mean, kth = np.full(len(points), np.nan), np.full(len(points), np.nan)
        for a, b, dist, stands in nearest(points, points, rows, k):
            upto = np.cumsum(stands, axis=1)
            full = (upto >= k).any(axis=1)
            kth[a:b] = np.where(full, dist[np.arange(b - a), (upto >= k).argmax(axis=1)], np.nan)
            take = np.clip(k - (upto - stands), 0, stands)
            if thresh is not None:
                take = np.where(dist < thresh, take, 0)
            n = take.sum(axis=1)
            total = np.where(take > 0, dist * take, 0.0).sum(axis=1)
            mean[a:b] = np.where(n > 0, total / np.maximum(n, 1), np.nan)
        more = [pa.array(x, pa.float64(), mask=np.isnan(x)) for x in (mean, kth)]
        return pa.RecordBatch.from_arrays([group.column(c) for c in columns] + more, names=[*columns, "knn_dist", KTH])

    def run(batches):
        parts = []
        for new, piece in _by_group(batches, [ID, CHUNK]):
            if new and parts:
                yield answered(parts)
                parts = []
            parts.append(piece)
        if parts:
            yield answered(parts)

    return held.repartition(ID, CHUNK).sortWithinPartitions(ID, CHUNK).select(*columns, CHUNK).mapInArrow(run, schema)


def _elsewhere(asks: DataFrame, held: DataFrame, d: int, k: int, scale: Scale) -> DataFrame:
    """asks (S, coordinates, ID of a leaf to meet) -> S, coordinates, D, W: at
    most k neighbours a point and leaf (and chunk of it)."""
    ps = _names("p", d)
    chunks, m = materialize_observed(held.groupBy(ID, CHUNK).agg(F.count(F.lit(1)).alias(N)), rows=F.count(F.lit(1)))
    asked, n = materialize_observed(asks.groupBy(ID).agg(F.count(F.lit(1)).alias("_tw_asks")), rows=F.count(F.lit(1)))
    copies = F.ceil(F.col("_tw_asks") / F.lit(ASKING)).cast("int").alias("_tw_copies")
    table = attach_small(chunks.select(ID, CHUNK), asked.select(ID, copies), [ID], "inner", scale=scale, n_rows=n["rows"])
    dealt = attach_small(held, table, [ID, CHUNK], "inner", scale=scale, n_rows=m["rows"])
    dealt = dealt.select(S, ID, CHUNK, F.explode(F.sequence(F.lit(0), F.col("_tw_copies") - 1)).alias(COPY),
                         F.lit(False).alias("_tw_ask"), W, *ps)
    to = asks.select(S, ID, *ps).join(_small(table.withColumnRenamed(ID, "_tw_to"), m["rows"], scale), F.col(ID) == F.col("_tw_to"))
    to = to.select(S, ID, CHUNK, F.pmod(F.xxhash64(*ps), F.col("_tw_copies")).cast("int").alias(COPY),
                   F.lit(True).alias("_tw_ask"), F.lit(0).cast("bigint").alias(W), *ps)
    schema = StructType([held.schema[S], *[held.schema[p] for p in ps]]).add(D, DoubleType()).add(W, LongType())
    keys = [ID, CHUNK, COPY]

    def run(batches):
        import pyarrow as pa
        points, rows = [], []
        for new, piece in _by_group(batches, keys):
            if new:
                points, rows = [], []
            ask = np.asarray(piece.column("_tw_ask").to_numpy(zero_copy_only=False))
            coords = _arrays(piece, ps)
            points.append(coords[~ask])
            rows.append(np.asarray(piece.column(W))[~ask])
            if not ask.any():
                continue
            points, rows = [np.concatenate(points)], [np.concatenate(rows)]
            who = np.flatnonzero(ask)
            for a, b, dist, stands in nearest(coords[who], points[0], rows[0], k):
                i, j = np.nonzero(stands > 0)
                at = pa.array(who[a + i])
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c).take(at) for c in [S, *ps]] + [pa.array(dist[i, j]), pa.array(stands[i, j])],
                    names=[S, *ps, D, W])

    both = dealt.unionByName(to).repartition(*keys).sortWithinPartitions(*keys, "_tw_ask")
    return both.mapInArrow(run, schema)


# Tasks need not have the package installed (as in ``footers``).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _point_distances(pts: DataFrame, d: int, k: int, leaf: int, dist_thresh: float | None, scale: Scale) -> DataFrame:
    """Points: S, coordinates, W, knn_dist (NULL without a neighbour)."""
    ps, lo, hi = _names("p", d), _names("lo", d), _names("hi", d)
    leaf = max(leaf, k)
    located = _located(pts, d, scale)
    levels = _tree(located, d, leaf, scale)
    held = _in_leaves(located, levels, d, leaf, scale)
    home = _stored(_at_home(held, d, k, dist_thresh), "grid-home")
    if len(levels) == 1:
        return home.select(S, *ps, W, "knn_dist")
    held = _stored(held, "grid-held")
    deepest = F.col(ID).bitwiseAND(F.lit(63)) == BITS // STEP
    asks = home.select(S, F.col(ID).alias("_tw_home"), KTH, *ps).join(_met(levels, d, k, scale), F.col("_tw_home") == F.col(UNIT)) \
        .withColumn(REACH, F.least(REACH, F.col(KTH) * SLACK)) \
        .filter(F.col(REACH).isNull() | (_gap(ps, ps, lo, hi) <= F.col(REACH))) \
        .filter((F.col(ID) != F.col("_tw_home")) | deepest)
    asks = _stored(asks.select(S, "_tw_home", ID, *ps), "grid-asks")
    # A point that leaves its leaf meets that one again, for its k rows there.
    again = asks.select(S, "_tw_home", *ps).distinct().withColumn(ID, F.col("_tw_home"))
    every = asks.filter(F.col(ID) != F.col("_tw_home")).unionByName(again)
    pairs = _elsewhere(every, held, d, k, scale)
    if dist_thresh is not None:
        pairs = pairs.filter(F.col(D) < F.lit(float(dist_thresh)))
    point = Window.partitionBy(S, *ps).orderBy(D)
    near = pairs.withColumn("_tw_i", F.row_number().over(point)).filter(F.col("_tw_i") <= k)
    before = F.coalesce(F.sum(W).over(point.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    taken = F.greatest(F.lit(0), F.least(F.col(W), F.lit(k) - F.col("_tw_before")))
    better = near.withColumn("_tw_before", before).withColumn("_tw_take", taken).groupBy(S, *ps).agg(
        (F.sum(F.col(D) * F.col("_tw_take")) / F.sum("_tw_take")).alias("_tw_better"))
    better = better.select(*[F.col(c).alias(f"_tw_b{i}") for i, c in enumerate([S, *ps])], "_tw_better")
    meet = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_tw_b{i}") for i, c in enumerate([S, *ps])])
    return home.join(better, meet, "left").select(S, *ps, W, F.coalesce("_tw_better", "knn_dist").alias("knn_dist"))


def _scored_points(df: DataFrame, cols: Cols, features: list[str], k: int, dist_thresh: float | None, leaf: int,
                   scale: Scale) -> tuple[DataFrame, DataFrame, Column]:
    """The rows of non-NULL systems with z_<feature> and ``_tw_ok`` (takes
    part), the points they form with knn_dist, and how rows meet points."""
    d = len(features)
    if not d or len(set(features)) != d or k < 1:
        raise ValueError("name one or more different features and k >= 1")
    zs, ps = [f"z_{f}" for f in features], _names("p", d)
    keep = list(dict.fromkeys([cols.sys, cols.ts, *features, *cols.tie_break]))
    base = df.select(*[_q(c) for c in keep]).filter(_q(cols.sys).isNotNull())
    rows = standardise(base, cols, features, scale)
    finite = reduce(lambda a, b: a & b, [_q(z).isNotNull() & (F.abs(_q(z)) < F.lit(float("inf"))) for z in zs])
    rows = rows.withColumn("_tw_ok", F.coalesce(finite, F.lit(False)))
    pts = rows.filter("_tw_ok").groupBy(_q(cols.sys).alias(S), *[(_q(z) + F.lit(0.0)).alias(p) for z, p in zip(zs, ps)]) \
        .agg(F.count(F.lit(1)).alias(W))
    found = _point_distances(_stored(pts, "grid-points"), d, k, leaf, dist_thresh, scale)
    meet = reduce(lambda a, b: a & b, [F.col("_tw_ok"), _q(cols.sys) == F.col(S),
                                       *[_q(z) == F.col(p) for z, p in zip(zs, ps)]])
    return rows, found, meet


def knn_grid_scores(df: DataFrame, cols: Cols, features: list[str], k: int = 5,
                    dist_thresh: float | None = None, isolated: float | None = None,
                    leaf: int = LEAF, scale: Scale = Scale()) -> DataFrame:
    """Every row of a non-NULL system with knn_dist: mean Euclidean distance,
    over the standardised ``features``, to the k nearest other rows of its
    system (fewer if there are fewer), only those closer than ``dist_thresh`` if
    given.  Rows without a neighbour get ``isolated``; rows with a NULL or
    non-finite standardised feature take no part and get NULL.  Columns:
    system, time, features, tie-break, z_<feature>, knn_dist."""
    rows, found, meet = _scored_points(df, cols, features, k, dist_thresh, leaf, scale)
    keep = [c for c in rows.columns if c != "_tw_ok"]
    dist = F.col("knn_dist")
    if isolated is not None:
        dist = F.when(F.col("_tw_ok"), F.coalesce(dist, F.lit(float(isolated))))
    return rows.join(found, meet, "left").select(*[_q(c) for c in keep], dist.alias("knn_dist"))


def knn_grid(df: DataFrame, cols: Cols, features: list[str], k: int = 5, pr_cutoff: float = 0.99,
             dist_thresh: float | None = None, isolated: float | None = None, leaf: int = LEAF,
             scale: Scale = Scale(), rank_digits: int | None = None) -> DataFrame:
    """``knn_grid_scores`` + knn_pr, rows whose percent_rank of knn_dist within
    the system is at least ``pr_cutoff``."""
    if pr_cutoff <= 0:      # every row passes
        scores = knn_grid_scores(df, cols, features, k, dist_thresh, isolated, leaf, scale)
        ranked = percent_rank_at_least(scores.withColumn(RK, rank_key(F.col("knn_dist"), rank_digits)),
                                       [cols.sys], RK, pr_cutoff, "knn_pr", scale)
        return ranked.select(*[_q(c) for c in [*scores.columns, "knn_pr"]])
    rows, found, meet = _scored_points(df, cols, features, k, dist_thresh, leaf, scale)
    dist = F.col("knn_dist")
    if isolated is not None:
        dist = F.coalesce(dist, F.lit(float(isolated)))
    ps = _names("p", len(features))
    found = found.select(S, *ps, W, dist.alias("knn_dist"), rank_key(dist, rank_digits).alias(RK))
    # Rows without a distance rank first, with 0.
    sizes, m = materialize_observed(rows.groupBy(_q(cols.sys).alias(S)).agg(
        F.count(F.lit(1)).alias(ROWS), F.count_if(~F.col("_tw_ok")).alias("_tw_out")), rows=F.count(F.lit(1)))
    values = _stored(found.groupBy(S, RK).agg(F.sum(W).alias(W)), "grid-ranks")
    ranked = attach_small(running_below(values, [S], RK, W, "_tw_below", scale), sizes, [S], "inner", scale=scale,
                          n_rows=m["rows"])
    pr = F.when(F.col(ROWS) > 1, (F.col("_tw_below") + F.col("_tw_out")) / (F.col(ROWS) - 1)).otherwise(F.lit(0.0))
    best = ranked.filter(F.col(RK).isNotNull()).select(F.col(S).alias("_tw_bs"), F.col(RK).alias("_tw_brk"), pr.alias("knn_pr")) \
        .filter(F.col("knn_pr") >= F.lit(pr_cutoff))
    kept = found.join(best, (F.col(S) == F.col("_tw_bs")) & (F.col(RK) == F.col("_tw_brk"))).select(S, *ps, "knn_dist", "knn_pr")
    kept, m = materialize_observed(kept, rows=F.count(F.lit(1)))
    return rows.join(_small(kept, m["rows"], scale), meet) \
        .select(*[_q(c) for c in rows.columns if c != "_tw_ok"], "knn_dist", "knn_pr")
