"""Helpers the operators of this package share.

Words are maximal runs of bytes outside ``[\\x20\\x09-\\x0D]`` everywhere (on
UTF-8 that is the same as on code points).  ``token_hashes`` finds and hashes
all words of a batch with a few numpy passes over its bytes, without making a
Python object per word.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablewatch.functions.exprs import quote_ident
from tablewatch.session import scratch_path

BROADCAST_KEYS = 500_000  # of an id and a 64-bit hash each
ARROW_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
ARROW_BYTES = 4 << 20  # of the rows that go to a Python worker at once
SLICE_BYTES = 1 << 20  # of the texts whose words are arrays at once
WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_WS = np.zeros(256, bool)
_WS[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_POS = _rng.integers(0, 2**63, 1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POS_HIGH = _rng.integers(0, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POS_HIGH[0] = 1


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Tokens:
    """The words of a batch of texts.

    ``buf`` the texts' bytes end to end, ``start``/``end`` each word's bytes
    in it, ``doc`` the text each word is of, ``first`` (texts + 1) each text's
    first word, ``hash`` 64-bit hashes of the words.
    """

    __slots__ = ("buf", "bounds", "start", "end", "doc", "first", "hash", "_raw")

    def word(self, i: int) -> bytes:
        return self._raw[self.start[i]:self.end[i]]


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column; null texts become empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def token_bounds(texts: list[bytes], lower: bool = True) -> Tokens:
    """The words without their hashes."""
    t = Tokens()
    raw = b"".join(texts)
    buf = np.frombuffer(raw, np.uint8)
    if lower:
        buf = _LOWER[buf]
        raw = buf.tobytes()
    t._raw, t.buf = raw, buf
    t.bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(x) for x in texts], out=t.bounds[1:])
    inside = ~_WS[buf]
    head = np.zeros(len(buf) + 1, bool)  # a word cannot go on from one text into the next
    head[t.bounds] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | head[1:-1]
    t.start = np.flatnonzero(begins)
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | head[1:-1]
    t.end = np.flatnonzero(ends) + 1
    t.first = np.searchsorted(t.start, t.bounds)
    t.doc = np.repeat(np.arange(len(texts)), np.diff(t.first))
    return t


def token_hashes(texts: list[bytes], lower: bool = True) -> Tokens:
    t = token_bounds(texts, lower)
    buf = t.buf
    size = t.end - t.start
    if not len(size):
        t.hash = np.zeros(0, np.uint64)
        return t
    at = np.cumsum(size) - size
    offset = np.arange(int(size.sum())) - np.repeat(at, size)
    part = _BYTE[buf[np.repeat(t.start, size) + offset]] * _POS[offset & 1023]
    if size.max() > 1024:
        part *= _POS_HIGH[(offset >> 10) & 4095]
    t.hash = mix64(np.add.reduceat(part, at) + size.astype(np.uint64))
    return t


def per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    run = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=run[1:])
    return run[bounds[1:]] - run[bounds[:-1]]


def repeated_words(t: Tokens) -> np.ndarray:
    """Per text: words covered by three-word windows found twice or more in
    the text."""
    n = len(t.hash)
    covered = np.zeros(n, bool)
    if n >= 3:
        ok = np.flatnonzero(t.doc[:-2] == t.doc[2:])
        h = t.hash
        key = mix64(h[ok] * np.uint64(0x9E3779B97F4A7C15) + mix64(h[ok + 1] + np.uint64(1)) * np.uint64(3)
                    + mix64(h[ok + 2] ^ mix64(t.doc[ok].astype(np.uint64))))
        values, inverse, count = np.unique(key, return_inverse=True, return_counts=True)
        hit = ok[count[inverse] > 1]
        for k in range(3):
            covered[hit + k] = True
    return per_doc(covered, t.first)


def text_lists(column: pa.Array | pa.ChunkedArray, budget: int = 2 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end row, texts) of runs of about ``budget`` bytes; only one
    run's texts are Python objects at a time.  Null texts are empty."""
    for lo, hi, texts in text_runs(column, budget):
        yield lo, hi, [texts.text(i) for i in range(hi - lo)]


def col(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col(quote_ident(name))


def slices(texts: list[bytes], budget: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Runs of consecutive texts of about ``budget`` bytes; a longer text
    makes a run of its own."""
    begin = size = 0
    for i, x in enumerate(texts):
        if i > begin and size + len(x) > budget:
            yield begin, i
            begin, size = i, 0
        size += len(x)
    if begin < len(texts):
        yield begin, len(texts)


def write_scratch(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write to the shared checkpoint folder and read it back: cuts lineage
    with files that outlive a lost executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}-{uuid.uuid4().hex[:6]}")
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path) if not partition_by else spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null ids: of the empty text)."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit(""))) % F.lit(folds)


def text_key(text: Column) -> Column:
    """64 bits that stand for a text in joins; null differs from empty."""
    return F.xxhash64(text, text.isNull())


def without(docs: DataFrame, rejected: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of ``docs`` whose id and text are not among ``rejected`` (id and
    ``__text_key``); null ids compare as equal.  The rejected keys are written
    and counted first: up to ``BROADCAST_KEYS`` they are broadcast and no text
    is shuffled."""
    gone = write_scratch(rejected.select(col(id_col).alias("__gone_id"), F.col("__text_key").alias("__gone_key")).distinct(),
                         "rejected")
    if gone.count() <= BROADCAST_KEYS:
        gone = F.broadcast(gone)
    return docs.join(gone, col(id_col).eqNullSafe(F.col("__gone_id"))
                     & (text_key(col(text_col)) == F.col("__gone_key")), "left_anti")


_HELD: dict = {}


def held(key, make):
    """A worker's large tables, one at a time: those of an earlier stage are
    let go before ``make`` builds new ones."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Lets go of held tables and of unused memory."""
    _HELD.clear()
    give_back()


def give_back() -> None:
    """Returns memory that freed arrays left with the allocators to the
    system (where the C library can: glibc)."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for mapInArrow that gives memory back when a task ends."""

    def inner(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return inner


def one_by_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, with memory given back after each: what arrays of many
    sizes leave with the allocators adds up over a task otherwise."""
    for batch in batches:
        yield batch
        del batch
        give_back()


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` in batches of about ``ARROW_BYTES``, with
    memory given back after each and when a task ends.  An executor holds a
    batch several times over outside its heap (Arrow vectors and a socket
    buffer, both grown by doubling, and the worker's copy), which 10,000 rows
    of long texts make hundreds of MB per task.  A longer row makes a batch of its own; a size the
    session was given stays."""
    conf = df.sparkSession.conf
    if conf.get(ARROW_SETTING, None) is None:
        conf.set(ARROW_SETTING, str(ARROW_BYTES))
    return df.mapInArrow(trimmed(lambda batches: run(one_by_one(batches))), schema)


class HashCache:
    """A worker's memory of one number per word hash, emptied beyond
    ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)

    def get(self, hashes: np.ndarray, compute) -> np.ndarray:
        """Values of distinct, sorted ``hashes``; ``compute(indices)`` gives
        those not known yet."""
        if len(self.keys) > self.limit:
            self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0)
        place = np.searchsorted(self.keys, hashes)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == hashes[known]
        out = np.zeros(len(hashes))
        out[known] = self.values[place[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = compute(new)
            keys = np.concatenate([self.keys, hashes[new]])
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], np.concatenate([self.values, out[new]])[order]
        return out


def hash_spans(buf: np.ndarray, start: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans that tile ``buf`` from each start to the next."""
    size = np.diff(np.append(start, len(buf)))
    offset = np.arange(len(buf)) - np.repeat(start, size)
    part = _BYTE[buf] * _POS[offset & 1023]
    if len(size) and size.max() > 1024:
        part *= _POS_HIGH[(offset >> 10) & 4095]
    return mix64(np.add.reduceat(part, start) + size.astype(np.uint64))


class Texts:
    """A run of consecutive texts of a column: ``raw`` their bytes end to end
    (a view of the Arrow buffer), ``bounds`` where each begins (texts + 1)."""

    __slots__ = ("raw", "bounds")

    def __init__(self, raw: np.ndarray, bounds: np.ndarray):
        self.raw, self.bounds = raw, bounds

    def __len__(self) -> int:
        return len(self.bounds) - 1

    def text(self, i: int) -> bytes:
        return self.raw[self.bounds[i]:self.bounds[i + 1]].tobytes()


def text_runs(column: pa.Array | pa.ChunkedArray, budget: int = 2 << 20) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, texts) of runs of about ``budget`` bytes, read from
    the Arrow buffers without a Python object per text; a longer text makes a
    run of its own.  Null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = int(np.searchsorted(offsets, offsets[begin] + budget, "right")) - 1
        end = min(n, max(end, begin + 1))
        yield begin, end, Texts(raw[offsets[begin]:offsets[end]], offsets[begin:end + 1] - offsets[begin])
        begin = end


def runs_of_bytes(texts: Texts, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-cased bytes, start, end, text) of the maximal runs of bytes that
    ``allowed`` (256 booleans, asked after A-Z are lower-cased) lets in."""
    buf = _LOWER[texts.raw]
    inside = np.zeros(len(buf) + 2, bool)
    inside[1:-1] = allowed[buf]
    change = inside[1:] != inside[:-1]
    # a run cannot go on from one text into the next
    inner = texts.bounds[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(buf))])
    cut = inner[inside[inner] & inside[inner + 1]]
    edge = np.flatnonzero(change)
    start, end = np.sort(np.concatenate([edge[::2], cut])), np.sort(np.concatenate([edge[1::2], cut]))
    doc = np.searchsorted(texts.bounds, start, "right") - 1
    return buf, start, end, doc


def hash_runs(buf: np.ndarray, start: np.ndarray, end: np.ndarray, both: bool = False):
    """64-bit hashes of the given non-empty byte runs (as ``token_hashes``);
    with ``both`` a second, independent one too."""
    size = end - start
    if not len(size):
        none = np.zeros(0, np.uint64)
        return (none, none) if both else none
    at = np.cumsum(size) - size
    offset = np.arange(int(size.sum())) - np.repeat(at, size)
    part = _BYTE[buf[np.repeat(start, size) + offset]]
    place = _POS[offset & 1023]
    if size.max() > 1024:
        place *= _POS_HIGH[(offset >> 10) & 4095]
    one = mix64(np.add.reduceat(part * place, at) + size.astype(np.uint64))
    if not both:
        return one
    part = mix64(part) * (place ^ np.uint64(0xA5A5A5A5A5A5A5A4))
    return one, mix64(np.add.reduceat(part, at) ^ size.astype(np.uint64))


def spans_array(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte spans as a string array, gathered without Python objects."""
    size = end - start
    offsets = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=offsets[1:])
    data = buf[np.repeat(start - offsets[:-1], size) + np.arange(int(offsets[-1]))]
    return pa.Array.from_buffers(pa.large_string(), len(size),
                                 [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


# Bytes of words of letters, digits and non-ASCII characters (after A-Z are
# lower-cased): [^\x00-\x2F\x3A-\x60\x7B-\x7F].
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[128:] = True
