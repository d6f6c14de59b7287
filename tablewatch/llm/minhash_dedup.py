"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass over the texts gives each document its number of distinct word
   shingles, a fingerprint of the set and a signature.  Documents with equal
   sets form one node, so copies never meet in pairs.
2. Signatures are cut into bands; nodes that agree in a whole band share a
   bucket.
3. In each bucket every node meets one hub.  Links found there make first
   components, and nodes of one component need no further pair.  Buckets that
   still hold several components are compared in blocks of at most ``BLOCK`` x
   ``BLOCK`` nodes, so neither a bucket nor its pairs ever sit in one task.
   Blocks of buckets beyond ``SMALL`` nodes carry the full sets and pass on one
   confirmed link per node and component, not their candidates.
4. A candidate pair's signatures are compared a batch of values at a time.
   With k of m equal, the similarity has a Beta(k+1, m-k+1) posterior; the pair
   is dropped as soon as the posterior puts less than ``miss`` on similarities
   of the threshold or more.  Survivors are confirmed on their full shingle
   sets.
5. Links become components by alternating large and small stars, all in
   DataFrames; the smallest id of a component stays.

With ``BANDS`` = 28 bands of 4 values a pair at similarity 0.75 shares no band
with probability 2.4e-5, one at 0.9 with 1e-13.

Defined cases: texts that are null or without words have an empty set and link
with nothing; fewer words than a shingle count as one shingle; rows that repeat
an id and text share a component and are all marked kept; a null id never is a
component's smallest id unless it has no other; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import (SLICE_BYTES, WORD_PATTERN, Tokens, col, map_batches, mix64, release, text_key, text_lists, token_hashes, without,
                                   write_scratch)

BANDS, BAND_ROWS = 28, 4
VALUES = BANDS * BAND_ROWS
STEP = 16  # signature values per posterior check
HUB_ORDERS = 4  # hubs differ between bands of different remainder
SMALL = 64
BLOCK = 1024
BLOCK_SHINGLES = 2_000_000
SHINGLE = 5
THRESHOLD = 75  # per cent
MISS = 1e-6
# Ids of documents whose sets are needed are broadcast up to this count (8 MB).
BROADCAST_IDS = 1_000_000

_rng = np.random.Generator(np.random.PCG64(77001))
_FACTORS = _rng.integers(0, 2**63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(t: Tokens, n_texts: int, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end, and where each
    text's begin (n_texts + 1)."""
    h, first = t.hash, t.first
    prime = np.uint64(0x100000001B3)
    n = np.diff(first)
    full = np.flatnonzero(t.doc[:len(h) - size + 1] == t.doc[size - 1:]) if len(h) >= size else np.zeros(0, np.int64)
    key = np.zeros(len(full), np.uint64)
    for k in range(size):
        key = key * prime + h[full + k]
    key, doc = mix64(key), t.doc[full]
    short = np.flatnonzero((n > 0) & (n < size))
    if len(short):
        part = np.full(len(short), 0x5A17, np.uint64)
        for k in range(size):
            has = n[short] > k
            part[has] = part[has] * prime + h[first[short[has]] + k]
        key, doc = np.concatenate([key, mix64(part)]), np.concatenate([doc, short])
    order = np.lexsort((key, doc))
    key, doc = key[order], doc[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
    key, doc = key[fresh], doc[fresh]
    return key, np.searchsorted(doc, np.arange(n_texts + 1))


def nodes_of(key: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with a set, their 16-byte fingerprints)."""
    some = np.flatnonzero(np.diff(begin))
    if not len(some):
        return some, np.zeros((0, 16), np.uint8)
    a = np.add.reduceat(mix64(key + np.uint64(0x1234567)), begin[some])
    b = np.add.reduceat(mix64(key ^ np.uint64(0xA5A5A5A5DEADBEEF)), begin[some])
    return some, np.stack([mix64(a), b], 1).astype("<u8").view(np.uint8).reshape(-1, 16)


def signatures(key: np.ndarray, begin: np.ndarray, some: np.ndarray) -> np.ndarray:
    out = np.zeros((len(some), VALUES), np.uint32)
    for k in range(VALUES if len(some) else 0):
        out[:, k] = np.minimum.reduceat(key * _FACTORS[k], begin[some]) >> np.uint64(32)
    return out


def _binary(rows: np.ndarray) -> list[bytes]:
    return [r.tobytes() for r in rows]


def signed(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """id, n_shingles, node and signature (null for empty sets) per row."""
    source = docs.select(col(id_col).alias("__id"), *[col(c).alias(f"__keep_{c}") for c in keep],
                         col(text_col).alias("__text"))
    schema = T.StructType(source.schema.fields[:-1] + [
        T.StructField("n", T.LongType()), T.StructField("node", T.BinaryType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            rest = batch.drop_columns(["__text"])
            for lo, hi, texts in text_lists(batch.column("__text"), SLICE_BYTES):
                key, begin = shingle_sets(token_hashes(texts), hi - lo)
                some, node = nodes_of(key, begin)
                nodes, sigs = [None] * (hi - lo), [None] * (hi - lo)
                for i, a, b in zip(some.tolist(), _binary(node), _binary(signatures(key, begin, some))):
                    nodes[i], sigs[i] = a, b
                own = rest.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    own.columns + [pa.array(np.diff(begin)), pa.array(nodes, pa.binary()), pa.array(sigs, pa.binary())],
                    names=own.schema.names + ["n", "node", "sig"])

    return map_batches(source, run, schema)


def full_sets(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, sorted shingle hashes) of the ``wanted`` nodes, from their
    smallest document's text."""
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    source = docs.select(col(id_col).alias("__id"), col(text_col).alias("__text")) \
        .join(wanted.select("rep", F.col("node").alias("want")), F.col("__id").eqNullSafe(F.col("rep"))) \
        .select("want", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            want = batch.column("want").to_pylist()
            for lo, hi, texts in text_lists(batch.column("__text"), SLICE_BYTES):
                key, begin = shingle_sets(token_hashes(texts), hi - lo)
                some, node = nodes_of(key, begin)
                rows = [(a, key[begin[i]:begin[i + 1]].tobytes()) for i, a in zip(some.tolist(), _binary(node))
                        if a == want[lo + i]]  # another row may bear the same id
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                                  pa.array([r[1] for r in rows], pa.binary())], names=["node", "set"])

    return map_batches(source, run, "node binary, set binary").dropDuplicates(["node"])


def least_matches(threshold: float, miss: float) -> list[int]:
    """After every STEP values: the fewest matches with which the posterior
    leaves at least ``miss`` to similarities of ``threshold`` or more."""
    out = []
    for m in range(STEP, VALUES + 1, STEP):
        tail, k = 0.0, -1
        while tail < miss:
            k += 1
            tail += comb(m + 1, k) * threshold**k * (1 - threshold) ** (m + 1 - k)
        out.append(k)
    return out


def plausible(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Which rows of two signature matrices stay in the race to the end."""
    alive, match = np.arange(len(a)), np.zeros(len(a), np.int64)
    for i, k in enumerate(least):
        cols = slice(i * STEP, (i + 1) * STEP)
        match = match + (a[alive, cols] == b[alive, cols]).sum(1)
        ok = match >= k
        alive, match = alive[ok], match[ok]
    return alive


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, VALUES)


def prune(pairs: DataFrame, nodes: DataFrame, least: list[int], threshold: int) -> DataFrame:
    """Candidate pairs (a, b) whose signatures leave a link plausible."""
    side = nodes.select("node", "n", "sig")
    both = (pairs.join(side.toDF("a", "na", "sa"), "a").join(side.toDF("b", "nb", "sb"), "b")
            .filter((100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = pa.array(plausible(_matrix(batch.column("sa")), _matrix(batch.column("sb")), least))
            yield batch.select(["a", "b"]).take(ok)

    return map_batches(both.select("a", "b", "sa", "sb"), run, "a binary, b binary")


def confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs linked on their full sets."""
    both = pairs.join(sets.toDF("a", "xa"), "a").join(sets.toDF("b", "xb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("xa"), batch.column("xb")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                common = int((y[place] == x).sum())
                keep.append(100 * common >= threshold * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "b", "xa", "xb"), run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every linked node; root is the smallest of its component."""
    edges = write_scratch(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "cc")
    while True:
        ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")) \
            .unionAll(edges.select("v", F.lit(0), F.lit(1)))
        ends = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        if ends.filter("up > 1 OR (up = 1 AND down = 1)").isEmpty():  # stars only
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")) \
                .unionAll(edges.select(F.col("v"), F.col("v")).distinct())
        ways = edges.unionAll(edges.select(F.col("v"), F.col("u")))
        low = ways.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = ways.join(low, "u").filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = write_scratch(small.unionAll(low).distinct(), "cc")


def labelled(rows: DataFrame, roots: DataFrame, column: str, to: str) -> DataFrame:
    """Adds each node's component (itself where it has no link)."""
    own = roots.select(F.col("node").alias("__n"), F.col("root").alias("__r"))
    return rows.join(own, F.col(column) == F.col("__n"), "left") \
        .withColumn(to, F.coalesce("__r", column)).drop("__n", "__r")


def block_pairs(members: DataFrame, payload: DataFrame, least: list[int], threshold: int, exact: bool) -> DataFrame:
    """Pairs across components of the same bucket, compared by blocks: the
    plausible ones or, if ``exact``, one confirmed link per node and component."""
    chunks = F.greatest(F.ceil(F.col("cnt") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    extra = ["set"] if exact else []
    parts = (members.withColumn("ch", F.pmod(F.xxhash64("node"), chunks).cast("int"))
             .withColumn("o", F.explode(F.sequence(F.lit(0), chunks - 1)))
             .select("bucket", "band", F.least("ch", "o").alias("i"), F.greatest("ch", "o").alias("j"), "ch", "node", "label")
             .join(payload.select("node", "sig", *extra), "node")
             .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"))

    def confirmed(a: np.ndarray, b: np.ndarray, sets: list[np.ndarray], label: np.ndarray) -> tuple[list[int], list[int]]:
        found_a, found_b = [], []
        order = np.argsort(a, kind="stable")
        a, b = a[order], b[order]
        edge = np.flatnonzero(np.append(np.append(True, a[1:] != a[:-1]), True)) if len(a) else np.zeros(1, np.int64)
        for lo, hi in zip(edge.tolist(), edge[1:].tolist()):
            own = sets[a[lo]]
            size = np.array([len(sets[y]) for y in b[lo:hi]])
            other = np.concatenate([sets[y] for y in b[lo:hi]])
            place = np.minimum(np.searchsorted(own, other), len(own) - 1)
            common = np.add.reduceat((own[place] == other).astype(np.int64), np.cumsum(size) - size)
            hits = b[lo:hi][100 * common >= threshold * (len(own) + size - common)]
            for y in hits[np.unique(label[hits], return_index=True)[1]].tolist():
                found_a.append(int(a[lo]))
                found_b.append(y)
        return found_a, found_b

    def compare(t: pa.Table) -> list[tuple[bytes, bytes]]:
        sig, ch = _matrix(t.column("sig").combine_chunks()), np.asarray(t.column("ch"))
        node, band = t.column("node").to_pylist(), t.column("band")[0].as_py()
        label = np.asarray(t.column("label").combine_chunks().dictionary_encode().indices)
        sets = [np.frombuffer(x, np.uint64) for x in t.column("set").to_pylist()] if exact else None
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        left, right = np.flatnonzero(ch == i), np.flatnonzero(ch == j)
        out = []
        rows_at_once = max(1, 65536 // max(1, len(right)))
        for k in range(0, len(left), rows_at_once):
            a = np.repeat(left[k:k + rows_at_once], len(right))
            b = np.tile(right, min(rows_at_once, len(left) - k))
            ok = (label[a] != label[b]) & ((a < b) if i == j else True)
            a, b = a[ok], b[ok]
            ok = plausible(sig[a], sig[b], least)
            a, b = a[ok], b[ok]
            same = (sig[a] == sig[b]).reshape(len(a), BANDS, BAND_ROWS).all(2)
            ok = np.argmax(same, 1) == band if len(a) else np.zeros(0, bool)  # each pair in its first common bucket only
            a, b = a[ok], b[ok]
            if exact:
                a, b = confirmed(a, b, sets, label)
            out += [(min(node[x], node[y]), max(node[x], node[y])) for x, y in zip(list(a), list(b))]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            rest = t if rest is None else pa.concat_tables([rest, t])
            yield from groups(rest, False)
            rest = rest.slice(last_group(rest)).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from groups(rest, True)

    def marks(t: pa.Table) -> np.ndarray:
        keys = [np.asarray(t.column(c)) for c in ("bucket", "i", "j")]
        new = np.ones(t.num_rows, bool)
        if t.num_rows:
            new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
        return np.flatnonzero(new)

    def last_group(t: pa.Table) -> int:
        return int(marks(t)[-1]) if t.num_rows else 0

    def groups(t: pa.Table, end: bool) -> Iterator[pa.RecordBatch]:
        edge = [*marks(t).tolist(), t.num_rows]
        found = []
        for lo, hi in list(zip(edge, edge[1:]))[:None if end else -1]:
            found += compare(t.slice(lo, hi - lo))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.binary()),
                                          pa.array([x[1] for x in found], pa.binary())], names=["a", "b"])

    return map_batches(parts, run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
                    miss: float = MISS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per row: id, n_shingles, component_id, kept."""
    least = least_matches(threshold / 100, miss)
    rows = write_scratch(signed(docs, id_col, text_col, keep), "mh-signed")
    nodes = write_scratch(rows.filter(F.col("node").isNotNull()).groupBy("node").agg(
        F.min("__id").alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("docs")),
        "mh-nodes")

    cut = F.substring(F.col("sig"), F.col("band") * (4 * BAND_ROWS) + 1, F.lit(4 * BAND_ROWS))
    spread = nodes.select("node", "sig", "n", F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")) \
        .select("node", "n", "band", F.xxhash64(cut, "band").alias("bucket"))
    rank = F.xxhash64("node", F.col("band") % HUB_ORDERS)
    shared = (spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("cnt"), F.sum("n").alias("total"),
                                           F.min(F.struct(rank.alias("h"), F.col("node"))).alias("hub"))
              .filter("cnt > 1").select("bucket", "cnt", "total", F.col("hub.node").alias("hub")))
    members = write_scratch(spread.join(write_scratch(shared, "mh-buckets"), "bucket"), "mh-members")
    met = members.select("node").distinct()
    sets = write_scratch(full_sets(docs, nodes.select("node", "rep").join(met, "node", "left_semi"), id_col, text_col)
                         .join(nodes.select("node", "sig"), "node"), "mh-sets")
    star = members.filter("node != hub").select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct()
    pairs = write_scratch(prune(star, nodes, least, threshold), "mh-pairs")
    links = write_scratch(confirm(pairs, sets.select("node", "set"), threshold), "mh-links")
    roots = write_scratch(components(links), "mh-roots")
    marked = write_scratch(labelled(members, roots, "node", "label"), "mh-marked")
    mixed = marked.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo != hi")
    open_ = write_scratch(marked.join(mixed.select("bucket"), "bucket", "left_semi"), "mh-open")
    pairs = write_scratch(block_pairs(open_.filter(F.col("cnt") <= SMALL), nodes, least, threshold, False).distinct(), "mh-pairs")
    more = write_scratch(confirm(pairs, sets.select("node", "set"), threshold)
                         .unionAll(block_pairs(open_.filter(F.col("cnt") > SMALL), sets, least, threshold, True)), "mh-links")
    if not more.isEmpty():
        # The first components stand for their links.
        joined = roots.filter("node != root").select(F.col("node").alias("a"), F.col("root").alias("b"))
        roots = write_scratch(components(joined.unionAll(more)), "mh-roots")
    heads = labelled(nodes.select("node", "rep", "docs"), roots, "node", "root")
    # Only nodes of several documents or with links change an id.
    heads = heads.join(roots.select(F.col("node").alias("__l")), F.col("node") == F.col("__l"), "left") \
        .filter(F.col("__l").isNotNull() | (F.col("docs") > 1))
    heads = write_scratch(heads.select("node", "root", "rep"), "mh-heads")
    top = heads.groupBy("root").agg(F.min("rep").alias("top"))
    heads = heads.join(top, "root").select(F.col("node").alias("__n"), "top")
    got = rows.drop("sig").join(heads, F.col("node") == F.col("__n"), "left")
    component = F.coalesce("top", "__id")
    return got.select(F.col("__id").alias(id_col), *[col(f"__keep_{c}").alias(c) for c in keep],
                      F.col("n").alias("n_shingles"), component.alias("component_id"),
                      F.col("__id").eqNullSafe(component).alias("kept"))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input's rows and columns, one document of each component."""
    keyed = docs.select("*", text_key(col(text_col)).alias("__text_key"))
    verdicts = write_scratch(near_duplicates(keyed, id_col, text_col, keep=("__text_key",), **options), "mh-verdicts")
    out = without(docs, verdicts.filter(~F.col("kept")), id_col, text_col)
    again = verdicts.filter("kept AND n_shingles > 0").groupBy(col(id_col), "component_id").count().filter("count > 1")
    if not again.isEmpty():  # rows that repeat a kept id: texts without words stay, of the others one
        text = col(text_col)
        bare = F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)) == 0
        twice = again.select(col(id_col).alias("__twice")).distinct()
        repeated = col(id_col).eqNullSafe(F.col("__twice"))
        first = out.filter(~bare).join(twice, repeated, "left_semi").dropDuplicates([id_col])
        out = out.filter(bare).unionAll(out.filter(~bare).join(twice, repeated, "left_anti")).unionAll(first)
    return out
