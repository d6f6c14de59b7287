"""Benchmark decontamination by an FM-index per shard of training text.

Phrases: every run of ``window`` consecutive words of a benchmark item; an item
with fewer words is one phrase.  They are numbered and, with the words they
hold, broadcast in passes of at most ``PASS_WORDS`` words, so a benchmark of
any size takes bounded memory.

In each task the texts are read in shards of about ``SHARD`` bytes:

1. Words become symbols: a word of some phrase has a number, every other word
   is a gap no phrase can cross.  Stretches between gaps that are long enough
   for a phrase are laid end to end, each closed by an end mark of its own.
2. The suffixes are sorted by prefix doubling (only ties are sorted again).
   The symbols before the sorted suffixes (BWT) go into a wavelet matrix of
   packed bits with running counts, which answers "how often does symbol c
   occur before row i" in one step a bit of c.
3. All phrases are searched backwards at once; what stays non-empty are the
   rows of suffixes that begin with the phrase.
4. A row's text position is found by walking back through the text until a
   row with a kept position is met: one suffix in ``SAMPLE`` and the first of
   every stretch.
5. Occurrences are marked on the words and merge into removal spans.

Words are compared by 64-bit hashes.

Defined cases: null and empty texts have no words; items without words have no
phrase; an item repeated under one id counts once, a null item id is the text
``null``; the digest of no items is that of the empty text; an empty benchmark
leaves every document clean; an empty table gives an empty result; a repeated
row is answered on its own; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.functions.exprs import quote_ident
from tablewatch.llm.common import ALNUM, Texts, hash_runs, runs_of_bytes, text_runs, write_scratch

WINDOW = 10
SHARD = 4 << 20
SAMPLE = 8
PASS_WORDS = 2_000_000  # of phrases searched at a time, about 16 bytes each

SPANS = T.ArrayType(T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())]))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Sorted suffixes of symbols >= 0 in which 0 marks ends; every end mark
    is smaller than the ones after it and than all other symbols."""
    n = len(symbols)
    mark = symbols == 0
    key = np.where(mark, np.cumsum(mark) - 1, symbols + int(mark.sum()))
    sa = np.argsort(key, kind="stable")
    rank = np.empty(n, np.int64)

    def regroup(rows: np.ndarray, fresh: np.ndarray) -> np.ndarray:
        """Ranks of ``rows`` (places in sa) from where groups begin; the rows
        that still tie."""
        head = np.maximum.accumulate(np.where(fresh, rows, -1))
        rank[sa[rows]] = head
        last = np.append(fresh[1:], True)
        return rows[~(fresh & last)]

    order = key[sa]
    tied = regroup(np.arange(n), np.append(True, order[1:] != order[:-1])[:n])
    h = 1
    while len(tied):
        at = sa[tied]
        first, then = rank[at], rank[at + h]  # a tie of length h holds no mark, so at + h is inside
        again = np.lexsort((then, first))
        sa[tied] = at[again]
        first, then = first[again], then[again]
        tied = regroup(tied, np.append(True, (first[1:] != first[:-1]) | (then[1:] != then[:-1])))
        h *= 2
    return sa


class Bits:
    """A bit vector with counts of ones before every 64th bit."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-(len(bits) + 1) // 64) * 64, bool)
        padded[:len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])
        self.ones = int(self.before[-1])

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[i >> 6] + np.bitwise_count(self.words[i >> 6] & low)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) == 1


class WaveletMatrix:
    """Ranks of symbols: level by level, symbols with a zero bit come before
    those with a one bit, in their old order."""

    def __init__(self, symbols: np.ndarray, top: int):
        self.levels: list[tuple[Bits, int, int]] = []
        for bit in reversed(range(max(1, int(top).bit_length()))):
            one = (symbols >> bit) & 1 == 1
            self.levels.append((Bits(one), len(symbols) - int(one.sum()), bit))
            symbols = np.concatenate([symbols[~one], symbols[one]])

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often c[k] occurs before place i[k]."""
        base = np.zeros_like(i)
        for bits, zeros, bit in self.levels:
            one = (c >> bit) & 1 == 1
            up, low = bits.rank(i), bits.rank(base)
            i, base = np.where(one, zeros + up, i - up), np.where(one, zeros + low, base - low)
        return i - base

    def symbol(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at the places and how often each occurs before its own."""
        c, base = np.zeros_like(i), np.zeros_like(i)
        for bits, zeros, bit in self.levels:
            one = bits.get(i)
            up, low = bits.rank(i), bits.rank(base)
            i, base = np.where(one, zeros + up, i - up), np.where(one, zeros + low, base - low)
            c |= one.astype(np.int64) << bit
        return c, i - base


class FMIndex:
    """Backward search and location over symbols that 0 closes stretch by
    stretch (the last symbol is a 0)."""

    def __init__(self, symbols: np.ndarray, top: int, sample: int = SAMPLE):
        sa = suffix_array(symbols)
        self.bwt = WaveletMatrix(symbols[sa - 1], top)  # of place 0: the closing 0
        self.first = np.zeros(top + 2, np.int64)
        np.cumsum(np.bincount(symbols, minlength=top + 1), out=self.first[1:])
        kept = (sa % sample == 0) | (symbols[sa - 1] == 0)
        self.kept, self.place = Bits(kept), sa[kept]

    def search(self, phrases: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(phrase, first row, end row) of the phrases that occur."""
        alive = np.arange(len(size))
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), self.first[-1])
        step = 0
        found: list[tuple] = []
        while len(alive):
            done = size[alive] == step
            found.append((alive[done], lo[done], hi[done]))
            alive, lo, hi = alive[~done], lo[~done], hi[~done]
            c = phrases[begin[alive] + size[alive] - 1 - step]
            lo, hi = self.first[c] + self.bwt.rank(c, lo), self.first[c] + self.bwt.rank(c, hi)
            some = lo < hi
            alive, lo, hi = alive[some], lo[some], hi[some]
            step += 1
        return tuple(np.concatenate(x) for x in zip(*found)) if found else (alive, lo, hi)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the rows."""
        out, todo, steps = np.zeros(len(rows), np.int64), np.arange(len(rows)), 0
        while len(todo):
            here = self.kept.get(rows)
            out[todo[here]] = self.place[self.kept.rank(rows[here])] + steps
            todo, rows = todo[~here], rows[~here]
            c, before = self.bwt.symbol(rows)
            rows = self.first[c] + before
            steps += 1
        return out


class Phrases:
    """What a pass searches for: the vocabulary's sorted word hashes (a word's
    symbol is its place there plus 1), the phrases' symbols end to end, and
    the items of each phrase, end to end, as numbers of ``ids``."""

    def __init__(self, words: list[np.ndarray], items: list[list[int]], ids: list[str]):
        flat = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.vocabulary, symbols = np.unique(flat, return_inverse=True)
        self.symbols = symbols.astype(np.int64) + 1
        self.size = np.array([len(w) for w in words], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        count = np.array([len(x) for x in items], np.int64)
        self.item_end = np.cumsum(count)
        self.item_begin = self.item_end - count
        self.items = np.array([i for x in items for i in x], np.int64)
        self.ids = ids

    def symbols_of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.vocabulary):
            return np.zeros(len(hashes), np.int64)
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[place] == hashes, place + 1, 0)


def stretches(symbols: np.ndarray, doc: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols of the stretches of known words of one text, of ``least`` words
    or more, each followed by a 0; the word each came from)."""
    known = symbols > 0
    start = known.copy()
    start[1:] &= ~known[:-1] | (doc[1:] != doc[:-1])
    end = known.copy()
    end[:-1] &= ~known[1:] | (doc[1:] != doc[:-1])
    a, b = np.flatnonzero(start), np.flatnonzero(end) + 1
    long = b - a >= least
    a, b = a[long], b[long]
    size = b - a + 1
    at = np.cumsum(size) - size
    word = np.arange(int(size.sum())) + np.repeat(a - at, size)
    out = symbols[np.minimum(word, len(symbols) - 1)] if len(word) else np.zeros(0, np.int64)
    out[at + size - 1] = 0
    return out, word


def occurrences(symbols: np.ndarray, doc: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, first word) of every occurrence in a shard's words."""
    none = np.zeros(0, np.int64)
    if not len(phrases.size) or not len(symbols):
        return none, none
    text, word = stretches(symbols, doc, int(phrases.size.min()))
    if not len(text):
        return none, none
    index = FMIndex(text, len(phrases.vocabulary))
    phrase, lo, hi = index.search(phrases.symbols, phrases.begin, phrases.size)
    count = hi - lo
    rows = np.arange(int(count.sum())) + np.repeat(lo - (np.cumsum(count) - count), count)
    return np.repeat(phrase, count), word[index.locate(rows)]


def phrase_passes(benchmark: DataFrame, item_id: str, text_col: str, window: int, pass_words: int) -> Iterator[Phrases]:
    """The distinct phrases with their items, in passes of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, texts in text_runs(batch.column(1)):
                buf, start, end, doc = runs_of_bytes(texts, ALNUM)
                h = hash_runs(buf, start, end)
                n = np.bincount(doc, minlength=hi - lo)
                first = np.cumsum(n) - n
                size = np.minimum(n, window)
                per = np.where(n > 0, n - size + 1, 0)
                owner = np.repeat(np.arange(hi - lo), per)
                at = first[owner] + np.arange(int(per.sum())) - np.repeat(np.cumsum(per) - per, per)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(owner + lo)),
                     pa.array([h[a:a + k].astype("<u8").tobytes() for a, k in zip(at.tolist(), size[owner].tolist())], pa.binary())],
                    names=["item", "phrase"])

    rows = benchmark.select(F.coalesce(F.col(quote_ident(item_id)).cast("string"), F.lit("null")).alias("item"),
                            F.col(quote_ident(text_col)).alias("text"))
    # One row per phrase and item: an item list of any length is read in order.
    pairs = write_scratch(rows.mapInArrow(run, "item string, phrase binary").distinct(), "leak-phrases")
    words, items, ids, number, total = [], [], [], {}, 0
    previous = None
    for r in pairs.orderBy("phrase", "item").toLocalIterator():
        phrase = bytes(r["phrase"])
        if phrase != previous and total >= pass_words:
            yield Phrases(words, items, ids)
            words, items, ids, number, total = [], [], [], {}, 0
        if phrase != previous or total >= pass_words:  # the items of one phrase may fill several passes
            if phrase == previous:
                yield Phrases(words, items, ids)
                words, items, ids, number, total = [], [], [], {}, 0
            words.append(np.frombuffer(phrase, "<u8").astype(np.uint64))
            items.append([])
            total += len(words[-1])
            previous = phrase
        if r["item"] not in number:
            number[r["item"]] = len(ids)
            ids.append(r["item"])
        items[-1].append(number[r["item"]])
        total += 1
    yield Phrases(words, items, ids)


def words_of(docs: DataFrame, id_col: str, text_col: str, keep: tuple[str, ...]) -> DataFrame:
    return docs.select(F.col(quote_ident(id_col)).alias("__id"),
                       *[F.col(quote_ident(c)).alias(f"__keep_{i}") for i, c in enumerate(keep)],
                       F.lit(None).cast("binary").alias("__mask"),
                       F.array().cast("array<string>").alias("items"), F.col(quote_ident(text_col)).alias("__text"))


def searched(rows: DataFrame, phrases: Phrases, shard: int, last: bool) -> DataFrame:
    """Adds a pass's items and hit words (``__mask``, a bit a word) to those
    found before; the last pass gives n_words, n_hit and spans (merged byte
    ranges) for the mask and the text."""
    fields = [f for f in rows.schema.fields if f.name not in ("__mask", "__text", "items")]
    found = [T.StructField("items", T.ArrayType(T.StringType()))]
    ends = [T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", SPANS)]
    schema = T.StructType(fields + found + ends) if last else rows.schema
    sent = rows.sparkSession.sparkContext.broadcast(phrases)
    span_type = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def hits(texts: Texts, before: list, items: list[set]) -> tuple:
        """(word starts, ends, text, hit) of a shard; ``items`` grow."""
        p = sent.value
        buf, start, end, doc = runs_of_bytes(texts, ALNUM)
        n_words = np.bincount(doc, minlength=len(texts))
        phrase, word = occurrences(p.symbols_of(hash_runs(buf, start, end)), doc, p)
        change = np.zeros(len(start) + 1, np.int64)
        np.add.at(change, word, 1)
        np.add.at(change, word + p.size[phrase], -1)
        hit = np.cumsum(change[:-1]) > 0
        first = np.cumsum(n_words) - n_words
        for i, x in enumerate(before):
            if x is not None:
                old = np.unpackbits(np.frombuffer(x, np.uint8), count=int(n_words[i])).astype(bool)
                hit[first[i]:first[i] + n_words[i]] |= old
        if len(word):
            key = np.unique(doc[word] * len(p.size) + phrase)
            of, which = key // len(p.size), key % len(p.size)
            count = p.item_end[which] - p.item_begin[which]
            at = np.arange(int(count.sum())) + np.repeat(p.item_begin[which] - (np.cumsum(count) - count), count)
            for pair in np.unique(np.repeat(of, count) * len(p.ids) + p.items[at]).tolist():
                items[pair // len(p.ids)].add(p.ids[pair % len(p.ids)])
        return start, end, doc, hit, n_words

    def merged(texts: Texts, start, end, doc, hit) -> list[list[dict]]:
        spans: list[list[dict]] = [[] for _ in range(len(texts))]
        first, final = hit.copy(), hit.copy()
        first[1:] &= ~hit[:-1] | (doc[1:] != doc[:-1])
        final[:-1] &= ~hit[1:] | (doc[1:] != doc[:-1])
        for i, a, b in zip(doc[first].tolist(), start[first].tolist(), end[final].tolist()):
            base = int(texts.bounds[i])
            spans[i].append({"begin": a - base, "end": b - base})
        return spans

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rest = batch.select([f.name for f in fields])
            for lo, hi, texts in text_runs(batch.column("__text"), shard):
                part = batch.slice(lo, hi - lo)
                items = [set(x) for x in part.column("items").to_pylist()]
                start, end, doc, hit, n_words = hits(texts, part.column("__mask").to_pylist(), items)
                own = rest.slice(lo, hi - lo)
                got = pa.array([sorted(x) for x in items], pa.list_(pa.string()))
                if last:
                    extra = {"items": got, "n_words": pa.array(n_words),
                             "n_hit": pa.array(np.bincount(doc[hit], minlength=hi - lo)),
                             "spans": pa.array(merged(texts, start, end, doc, hit), span_type)}
                else:
                    at = np.cumsum(n_words)
                    masks = [np.packbits(hit[a - k:a]).tobytes() for a, k in zip(at.tolist(), n_words.tolist())]
                    extra = {"__mask": pa.array(masks, pa.binary()), "items": got, "__text": part.column("__text")}
                yield pa.RecordBatch.from_arrays([*own.columns, *extra.values()], names=[*own.schema.names, *extra])

    return rows.mapInArrow(run, schema)


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, shard: int = SHARD,
               pass_words: int = PASS_WORDS, keep: tuple[str, ...] = ()) -> DataFrame:
    """Per document: id, kept columns, items (sorted ids of the items with a
    phrase in it), n_words, n_hit and spans (byte ranges to remove)."""
    rows = words_of(docs, id_col, text_col, keep)
    passes = phrase_passes(benchmark, item_id, item_text, window, pass_words)
    now = next(passes)
    for coming in passes:
        rows = write_scratch(searched(rows, now, shard, False), "leak-pass")
        now = coming
    return searched(rows, now, shard, True).select(
        F.col("__id").alias(id_col), *[F.col(f"__keep_{i}").alias(c) for i, c in enumerate(keep)],
        "items", "n_words", "n_hit", "spans")


def report(leaks: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One line per document: its words, hit words and a digest of its items."""
    return leaks.select(F.col(quote_ident(id_col)), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def without_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text's bytes outside the spans."""
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
    return b"".join([*out, text[at:]])


def remove_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents' rows and columns with every removal span cut out of the
    text (null texts stay null)."""
    own = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    found = find_leaks(plain, benchmark, f"c{own}", f"c{own}", keep=tuple(plain.columns), **options)

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([t if t is None or not len(s) else
                          without_spans(t.encode(), [(x["begin"], x["end"]) for x in s]).decode()
                          for t, s in zip(text, spans)])

    kept = found.toDF("id", *plain.columns, "items", "n_words", "n_hit", "spans")
    return kept.withColumn(f"c{own}", cut(f"c{own}", "spans")).select(*plain.columns).toDF(*docs.columns)


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

ORACLE = f"""
  WITH d AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
  b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
  phrases AS MATERIALIZED (
    SELECT DISTINCT item, n, array_to_string(w[p:p + n - 1], ' ') AS phrase
    FROM (SELECT item, w, least({WINDOW}, len(w)) AS n, unnest(range(1, greatest(len(w) - {WINDOW}, 0) + 2)) AS p
          FROM b WHERE len(w) > 0)),
  places AS (
    SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS phrase
    FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p
          FROM d, (SELECT DISTINCT n FROM phrases) WHERE len(w) >= n)),
  found AS MATERIALIZED (SELECT rid, p, n, item FROM places JOIN phrases USING (n, phrase)),
  hit AS (SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM found) GROUP BY rid),
  of AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
         FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
         sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
  FROM d LEFT JOIN hit USING (rid) LEFT JOIN of USING (rid)"""
