"""Phrase collocations from a weighted de Bruijn graph of word grams.

1. Every word occurrence begins one longest gram: the ``max_words`` words from
   it, or the fewer that are left of its piece.  A full gram is an edge from
   the node of its first words to the node of its last ones; a shorter gram is
   a correction for a piece that ends inside it.  Tasks count them per slice
   of text and pack them by hash bucket and language, so that a shuffled row
   holds thousands of grams; buckets are sized by the corpus and add up in
   arrays.  Nothing else is counted in the texts.
2. Shorter counts follow from the flow: a node's count is the sum of its
   outgoing edges and of the pieces that end in it, and so on down to words
   and to the language's total.  Each level is one such shuffle of packed
   partial sums, so a node with very many edges meets as one sum a bucket;
   grams below ``min_count`` only feed the level below and are
   then let go, so what is kept does not grow with the rare grams.
3. A node is unary if one incoming and one outgoing edge both carry its whole
   flow.  Paths of edges through unary nodes are compacted by pointer
   doubling.  Inside a path all edges and nodes have one count: its nodes need
   no look-up and are contained in their edges.
4. Candidates meet the counts of their parts, the weakest cut gives their
   score, and those that mostly occur inside a longer candidate are dropped.

Grams are told apart by 128-bit hashes of their bytes.  Scores use exact
decimals of 38 digits: counts up to 10^15 words fit.

Defined cases: null texts are empty, a null language is ``und``; empty texts
and pieces give no gram; ties of scores go to the smaller first part, ties of
ranks to the larger count and then the phrase in byte order; rows that repeat
count again; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.llm.common import Texts, hash_runs, mix64, runs_of_bytes, spans_array, text_runs, trimmed, write_scratch

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
CONTAINED = 50  # per cent of a phrase's occurrences inside one longer candidate
SLICE = 2 << 20
BUCKET = 8 << 20  # bytes of text whose grams share a bucket
MAX_BUCKETS = 1 << 24

# Bytes that end a piece (fixed): . , ; : ! ? and \x0A-\x0D.  Space and tab
# part words.
_BREAK = np.zeros(256, bool)
_BREAK[[46, 44, 59, 58, 33, 63, 10, 11, 12, 13]] = True
_WORD = ~_BREAK
_WORD[[32, 9]] = False


def byte_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, chunk: int = 1 << 15) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each byte span, a chunk of spans at a
    time (the index arrays are eight times the bytes)."""
    one, two = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64)
    for k in range(0, len(start), chunk):
        own = slice(k, k + chunk)
        one[own], two[own] = hash_runs(buf, start[own], end[own], both=True)
    return one, two


def same_before(order: np.ndarray, *keys: np.ndarray) -> np.ndarray:
    """Which of the ordered entries equals its predecessor in every key."""
    out = np.zeros(len(order), bool)
    out[1:] = np.logical_and.reduce([k[order[1:]] == k[order[:-1]] for k in keys])
    return out


def packed(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lang: np.ndarray, langs: list, count: np.ndarray,
           one: np.ndarray, two: np.ndarray, buckets: int, chunk: int = 1 << 15) -> pa.RecordBatch | None:
    """One row per bucket and language: its grams' bytes end to end, their
    sizes and their counts.  Equal grams that meet here are added up."""
    if not len(start):
        return None
    bucket = ((one >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    key = (bucket << np.uint64(40)) | (lang.astype(np.uint64) << np.uint64(26)) | (one & np.uint64((1 << 26) - 1))
    order = np.argsort(key)
    head = np.flatnonzero(~same_before(order, key, one, two))
    own, n = order[head], np.add.reduceat(count[order], head)
    size = (end - start)[own]
    at = np.zeros(len(own) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    data = np.empty(int(at[-1]), np.uint8)
    for k in range(0, len(own), chunk):
        part = own[k:k + chunk]
        move = start[part] - at[k:k + len(part)]
        data[at[k]:at[k + len(part)]] = buf[np.repeat(move, size[k:k + chunk]) + np.arange(at[k], at[k + len(part)])]
    group = key[own] >> np.uint64(26)
    edge = np.append(np.flatnonzero(np.append(True, group[1:] != group[:-1])), len(own))
    first = own[edge[:-1]]

    def blobs(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1,
                                     [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())

    return batch_of(len(first), bucket=pa.array(bucket[first].astype(np.int64)),
                    lang=pa.array([langs[i] for i in lang[first].tolist()], pa.string()),
                    grams=blobs(data, at[edge]), sizes=blobs(size.astype("<i4"), 4 * edge), counts=blobs(n.astype("<i8"), 8 * edge))


COLUMNS = {"bucket": pa.int64(), "lang": pa.string(), "grams": pa.binary(), "sizes": pa.binary(), "counts": pa.binary(),
           "gram": pa.string(), "words": pa.int32(), "f": pa.int64()}
SCHEMA = "bucket long, lang string, grams binary, sizes binary, counts binary, gram string, words int, f long"


def batch_of(rows: int, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([columns.get(c, pa.nulls(rows, t)) for c, t in COLUMNS.items()], names=list(COLUMNS))


def longest_grams(texts: Texts, lang: np.ndarray, langs: list, max_words: int, buckets: int) -> pa.RecordBatch | None:
    """What begins at every word of a slice, counted and packed."""
    buf, start, end, doc = runs_of_bytes(texts, _WORD)
    n = len(start)
    if not n:
        return None
    piece = np.cumsum(_BREAK[buf], dtype=np.int32)[start]
    last = np.append((piece[1:] != piece[:-1]) | (doc[1:] != doc[:-1]), True)
    piece_end = np.flatnonzero(last)[np.cumsum(last) - last]
    final = np.minimum(np.arange(n) + max_words - 1, piece_end)
    h = hash_runs(buf, start, end)
    # The words with one space after each; a gram is a stretch of that.
    size = end - start
    clean_at = np.cumsum(size + 1) - size - 1
    clean = np.full(int(size.sum()) + n, 32, np.uint8)
    before = np.cumsum(size) - size
    offset = np.arange(int(size.sum()), dtype=np.int64)
    clean[np.repeat(clean_at - before, size) + offset] = buf[np.repeat(start - before, size) + offset]
    one = mix64(lang[doc].astype(np.uint64))
    one, two = np.take(language_hashes(langs), lang[doc]), one
    for k in range(max_words):
        inside = np.arange(n) + k <= final
        part = np.where(inside, h[np.minimum(np.arange(n) + k, n - 1)], np.uint64(0))
        one = mix64(one * np.uint64(0x100000001B3) + part)
        two = two * np.uint64(0x9E3779B97F4A7C15) + mix64(part ^ np.uint64(k + 1))
    return packed(clean, clean_at, clean_at[final] + size[final], lang[doc], langs, np.ones(n, np.int64), one, two, buckets)


def language_hashes(langs: list) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in langs], np.uint64)


def counted(docs: DataFrame, text_col: str, lang_col: str, max_words: int, slice_bytes: int, buckets: int) -> DataFrame:
    """Longest grams and piece ends with their counts, packed by bucket."""
    source = docs.select(F.coalesce(F.col(quote_ident(lang_col)).cast("string"), F.lit("und")).alias("lang"),
                         F.col(quote_ident(text_col)).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            number, names = np.asarray(langs.indices), langs.dictionary.to_pylist()
            for lo, hi, texts in text_runs(batch.column(1), slice_bytes):
                got = longest_grams(texts, number[lo:hi].astype(np.int64), names, max_words, buckets)
                if got is not None:
                    yield got

    return source.mapInArrow(trimmed(run), SCHEMA)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, str, list[list[bytes]]] | pa.RecordBatch]:
    """Rows of finished grams as they come, and the packed rows of each bucket
    and language once they are together."""
    now, held = None, []
    for batch in batches:
        done = batch.column("gram").is_valid()
        finished = batch.filter(done)
        if finished.num_rows:
            yield finished
        bucket, lang = np.asarray(batch.column("bucket")), batch.column("lang")
        for i in np.flatnonzero(~np.asarray(done)).tolist():  # no copy of the packed rows but the one bucket's
            key = (int(bucket[i]), lang[i].as_py())
            if key != now:
                if held:
                    yield *now, held
                now, held = key, []
            held.append([batch.column(c)[i].as_py() for c in ("grams", "sizes", "counts")])
    if held:
        yield *now, held


def level(rows: DataFrame, words: int, min_count: int, buckets: int) -> DataFrame:
    """Adds up the grams of up to ``words`` words.  Full ones that are frequent
    are finished rows; what all of them carry to their first words, with the
    pieces that end earlier, is packed for the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for got in by_bucket(batches):
            if isinstance(got, pa.RecordBatch):
                yield got
                continue
            bucket, lang, held = got
            buf = np.frombuffer(b"".join(x[0] for x in held), np.uint8)
            size = np.frombuffer(b"".join(x[1] for x in held), "<i4").astype(np.int64)
            count = np.frombuffer(b"".join(x[2] for x in held), "<i8")
            held.clear()
            end = np.cumsum(size)
            start = end - size
            one, two = byte_hashes(buf, start, end)
            order = np.argsort(one)
            if (same_before(order, one) & ~same_before(order, two)).any():
                order = np.lexsort((two, one))
            head = np.flatnonzero(~same_before(order, one, two))
            own, f = order[head], np.add.reduceat(count[order], head)
            start, end = start[own], end[own]
            space = np.flatnonzero(buf == 32)
            upto = np.searchsorted(space, end)
            full = upto - np.searchsorted(space, start) + 1 == words
            keep = full & (f >= min_count)
            n = int(keep.sum())
            if n:
                yield batch_of(n, bucket=pa.array(np.full(n, bucket)), lang=pa.array([lang] * n, pa.string()),
                               gram=spans_array(buf, start[keep], end[keep]).cast(pa.string()),
                               words=pa.array(np.full(n, words, np.int32)), f=pa.array(f[keep]))
            if words == 1:
                yield batch_of(1, bucket=pa.array([bucket]), lang=pa.array([lang]), gram=pa.array([""]),
                               words=pa.array([0], pa.int32()), f=pa.array([int(f.sum())]))
                continue
            short = np.where(full, space[upto - 1] if len(space) else end, end)
            one, two = byte_hashes(buf, start, short)
            one = one ^ language_hashes([lang])[0]
            yield packed(buf, start, short, np.zeros(len(start), np.int64), [lang], f, mix64(one), two, buckets)

    return rows.repartition("bucket").sortWithinPartitions("bucket", "lang").mapInArrow(trimmed(run), SCHEMA)


def flows(grams: DataFrame, max_words: int, min_count: int, buckets: int) -> DataFrame:
    """(lang, gram, words, f) of all grams of up to ``max_words`` words that
    occur at least ``min_count`` times, and the total (0 words) per language."""
    for words in range(max_words, 0, -1):
        grams = level(grams, words, min_count, buckets)
    return grams.groupBy("lang", "words", "gram").agg(F.sum("f").alias("f"))


def prefix(gram: Column, k: int) -> Column:
    return F.substring_index(gram, " ", k)


def suffix(gram: Column) -> Column:
    """Without the first word."""
    return F.substring(gram, F.instr(gram, " ") + 1, F.length(gram))


def neighbours(heavy: DataFrame, words: int) -> DataFrame:
    """(lang, gram, f) of the grams of ``words`` words with their strongest
    longer gram before (``left``) and after (``right``): structs (f, gram)."""
    long = heavy.filter(F.col("words") == words + 1)
    edge = F.struct("f", "gram")
    none = F.lit(None).cast("struct<f:bigint,gram:string>")
    ends = long.select("lang", prefix(F.col("gram"), words).alias("node"), none.alias("left"), edge.alias("right")) \
        .unionAll(long.select("lang", suffix(F.col("gram")), edge, none)) \
        .withColumn("f", F.lit(None).cast("long"))
    own = heavy.filter(F.col("words") == words).select("lang", F.col("gram").alias("node"), none.alias("left"),
                                                       none.alias("right"), "f")
    return ends.unionAll(own).groupBy("lang", "node").agg(F.max("left").alias("left"), F.max("right").alias("right"),
                                                          F.max("f").alias("f")).withColumnRenamed("node", "gram")


def unary(node: DataFrame) -> DataFrame:
    """Nodes whose whole flow comes in by one edge and goes out by one."""
    return node.filter((F.col("left.f") == F.col("f")) & (F.col("right.f") == F.col("f")))


def compact_paths(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``edges`` (lang, gram, f) with the first edge of their unary path
    (``path``), their place in it (from 0) and whether the path goes on.
    Pointer doubling: after k rounds every edge points 2^k edges back, or to
    its path's first one."""
    links = write_scratch(unary(nodes).select("lang", F.col("left.gram").alias("a"), F.col("right.gram").alias("b")), "path-links")
    back = links.select("lang", F.col("b").alias("gram"), F.col("a").alias("path"), F.lit(1).alias("place"))
    while True:
        at = back.select(F.col("lang").alias("l2"), F.col("gram").alias("g2"), F.col("path").alias("p2"), F.col("place").alias("n2"))
        back = write_scratch(back.join(at, (F.col("lang") == F.col("l2")) & (F.col("path") == F.col("g2")), "left").select(
            "lang", "gram", F.coalesce("p2", "path").alias("path"), (F.col("place") + F.coalesce("n2", F.lit(0))).alias("place"),
            F.col("p2").isNotNull().alias("moved")), "path-back")
        if back.filter("moved").isEmpty():
            break
        back = back.drop("moved")
    goes = links.select("lang", F.col("a").alias("gram"), F.lit(True).alias("more"))
    return edges.join(back.drop("moved"), ["lang", "gram"], "left").join(goes, ["lang", "gram"], "left").select(
        "lang", "gram", "f", F.coalesce("path", "gram").alias("path"), F.coalesce("place", F.lit(0)).alias("place"),
        F.coalesce("more", F.lit(False)).alias("more"))


def graph(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
          min_count: int = MIN_COUNT, slice_bytes: int = SLICE) -> DataFrame:
    """All frequent grams with their counts (and each language's total)."""
    size = docs.select(F.sum(F.octet_length(F.col(quote_ident(text_col)))).alias("n")).first()["n"] or 0
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(MAX_BUCKETS, max(partitions, -(-size // BUCKET)))
    return write_scratch(flows(counted(docs, text_col, lang_col, max_words, slice_bytes, buckets), max_words, min_count, buckets),
                         "grams")


def scored(candidates: DataFrame, heavy: DataFrame) -> DataFrame:
    """``candidates`` (lang, gram, words, f, head, tail) with l, r and score of
    their weakest cut.  ``head`` and ``tail``: counts of the gram without its
    last and first word where a path gives them; other parts are looked up."""
    k = F.col("k")
    left = F.call_function("substring_index", F.col("gram"), F.lit(" "), k)
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))) \
        .withColumn("left", left).withColumn("right", F.substring(F.col("gram"), F.length(left) + 2, F.length("gram"))) \
        .withColumn("l", F.when(k == F.col("words") - 1, F.col("head"))).withColumn("r", F.when(k == 1, F.col("tail")))

    def known(rows: DataFrame, part: str, out: str) -> DataFrame:
        side = heavy.select(F.col("lang").alias("l2"), F.col("gram").alias("g2"), F.col("f").alias("f2"))
        found = rows.filter(F.col(out).isNull()).drop(out).join(side, (F.col("lang") == F.col("l2")) & (F.col(part) == F.col("g2"))) \
            .withColumn(out, F.col("f2")).drop("l2", "g2", "f2")
        return rows.filter(F.col(out).isNotNull()).unionByName(found)

    cuts = known(known(cuts, "left", "l"), "right", "r")
    a, l, r = (F.col(c).cast("decimal(16,0)") for c in ("f", "l", "r"))
    score = F.expr("(cast(f as decimal(16,0)) * cast(f as decimal(16,0)) * 1000000BD) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    worst = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "gram", "f").agg(worst).select("lang", "gram", "f", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_words: int = MAX_WORDS,
                 min_count: int = MIN_COUNT, top: int = TOP, contained: int = CONTAINED, slice_bytes: int = SLICE) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    heavy = graph(docs, text_col, lang_col, max_words, min_count, slice_bytes)
    levels = []
    unknown = F.lit(None).cast("long")
    for words in range(2, max_words):
        near = neighbours(heavy, words)
        if words == max_words - 1:
            near = write_scratch(near, "nodes")
            nodes = near
        inside = F.greatest(F.coalesce("left.f", F.lit(0)), F.coalesce("right.f", F.lit(0)))
        free = near.filter(F.col("f").isNotNull() & (100 * inside < contained * F.col("f")))
        levels.append(free.select("lang", "gram", F.lit(words).alias("words"), "f", unknown.alias("head"), unknown.alias("tail")))
    edges = heavy.filter(F.col("words") == max_words).select("lang", "gram", "f")
    if max_words > 2:
        edges = compact_paths(edges, nodes)
        levels.append(edges.select("lang", "gram", F.lit(max_words).alias("words"), "f",
                                   F.when(F.col("place") > 0, F.col("f")).alias("head"),
                                   F.when(F.col("more"), F.col("f")).alias("tail")))
    else:
        levels.append(edges.select("lang", "gram", F.lit(2).alias("words"), "f", unknown.alias("head"), unknown.alias("tail")))
    candidates = levels[0]
    for more in levels[1:]:
        candidates = candidates.unionAll(more)
    total = heavy.filter("words = 0").select("lang", F.col("f").alias("n"))
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), F.col("gram").asc())
    ranked = scored(candidates, heavy.filter("words > 0")).withColumn("rank", F.row_number().over(best).cast("long")) \
        .filter(F.col("rank") <= top)
    return ranked.join(F.broadcast(total), "lang").select("lang", "rank", F.col("gram").alias("phrase"), F.col("f").alias("a"),
                                                          "l", "r", "n", F.col("score").cast("long").alias("score"))


_TEXT = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = f"""
  WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_TEXT}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
  grams AS MATERIALIZED (
    SELECT lang, k, w[p:p + k - 1] AS g
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM pieces, (SELECT unnest(range(1, {MAX_WORDS + 1})) AS k)
          WHERE len(w) >= k)),
  f AS MATERIALIZED (SELECT lang, k, array_to_string(g, ' ') AS g, any_value(g) AS w, count(*) AS f FROM grams GROUP BY lang, k, array_to_string(g, ' ')),
  total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
  cand AS MATERIALIZED (SELECT * FROM f WHERE k > 1 AND f >= {MIN_COUNT}),
  cuts AS (
    SELECT c.lang, c.g, c.f AS a, j, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
    FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
    JOIN f x ON x.lang = c.lang AND x.k = j AND x.g = array_to_string(c.w[1:j], ' ')
    JOIN f y ON y.lang = c.lang AND y.k = c.k - j AND y.g = array_to_string(c.w[j + 1:c.k], ' ')),
  scored AS (SELECT lang, g, a, arg_min(l, score * 10 + j) AS l, arg_min(r, score * 10 + j) AS r, min(score) AS score FROM cuts GROUP BY lang, g, a),
  inner_ AS (
    SELECT lang, array_to_string(w[p:p + m - 1], ' ') AS g, max(f) AS longer
    FROM (SELECT lang, w, f, k, m, unnest(range(1, k - m + 2)) AS p
          FROM (SELECT *, unnest(range(2, k)) AS m FROM cand)) GROUP BY ALL),
  ranked AS (
    SELECT lang, g, a, l, r, score, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank
    FROM scored LEFT JOIN inner_ USING (lang, g) WHERE longer IS NULL OR 100 * longer < {CONTAINED} * a)
  SELECT lang, rank, g AS phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}"""
