"""Toxicity: a subsequence string-kernel SVM with Nyström landmarks.

The kernel counts common subsequences of three to six characters (the space
before a word is one), each weighted by ``DECAY`` for every character skipped,
so that an insult with dropped, inserted or separated characters still shares
most of its subsequences with the plain one.  A sentence is compared through its best
matching span: a word, a run of single letters read together, or a 32-byte
window of something longer.  Letters only, lower case, common digit-for-letter
swaps undone.  Spans also cross word borders: two and three consecutive words
with letters are read together without the space between them, so that a split
insult equals the whole one and a phrase of ordinary words is a span of its own.

Training sees labelled documents only, so sentences are labelled by witness:
spans that labelled toxic documents hold far more often than clean ones stand
for the toxic sentences, spans of clean documents for the others.  A span of
several words is a witness only if no single word in it is.  A second
round adds the clean spans that score highest.  Landmarks are picked
farthest-first among both.  A linear SVM (squared hinge, Newton steps) on the
Nyström features follows.  Its decision is linear in the kernel values, so all
landmarks collapse into one table over hashed subsequences and a span's score
is a sum of lookups.  A document's score is a logistic function of its three
worst places (of the spans that begin at a word, the worst) and its length (longer texts have a worse worst span by
chance), fitted on a quarter of the sample that the SVM does not see.

Bounds: at most ``sample`` toxic and three times as many clean labelled
documents train (smallest hashes of the ids), near copies among them left out, and at most ``spans``
words and as many spans across borders of each kind reach the driver (witnesses by
their evidence, clean words by hash, clean spans across borders by hash from one
in ``PART``).

Defined cases: null or empty text, or text without letters, has the score of
a document without any span (low); repeated rows are scored one by one; null
labels do not train; without labels of both classes every score is the
smoothed share of label 1; an empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import (_BYTE, SLICE_BYTES, col, fold, map_batches, mix64, release, text_key, text_lists, token_bounds, token_hashes,
                                   without, write_scratch)
from tablewatch.llm.minhash_dedup import shingle_sets

SAMPLE = 3000
SPANS = 12_000
LEAST_TOXIC = 200  # toxic texts that are no copies, below which copies train too (if they are the larger half)
SPAN_ROWS = 1000  # spans scored at a time
KERNEL_ROWS = 100  # words whose kernel values are computed at a time
LANDMARKS = 256
DECAY = 0.6
SPAN = 32
TABLE_BITS = 20
GRAM = 3  # words read together at most
PART = 16  # one in so many spans across word borders stands for the clean ones
BLOCK = 2000  # words whose spans are scored at a time
RUNS = 1 << 14  # runs of letters whose subsequences are weighed at a time

# Characters commonly written for letters.
_SWAPS = {ord(a): ord(b) for a, b in zip("013457@$!", "oieastasi")}
_MAP = bytes(_SWAPS.get(i, i + 32 if 65 <= i <= 90 else i) for i in range(256))
_DROP = bytes(i for i in range(128) if not (97 <= _MAP[i] <= 122))
# Offsets of the subsequences: length -> longest stretch of text.
_SHAPES = [(0, *inner, last) for length, reach in ((3, 5), (4, 6), (5, 6), (6, 7))
           for last in range(length - 1, reach) for inner in itertools.combinations(range(1, last), length - 2)]
_REACH = 7
_DECAYED = {shape: DECAY ** (shape[-1] + 1 - len(shape)) for shape in _SHAPES}
# Length of a span of so many bytes in the kernel's space.
_NORM = np.sqrt(np.maximum(1e-9, sum(np.maximum(0, np.arange(SPAN + 1) - shape[-1]) * w * w for shape, w in _DECAYED.items())))
# Subsequences are hashed by adding one random number per place and byte.
_rng = np.random.Generator(np.random.PCG64(90417))
_PLACE = _rng.integers(0, 2**32, (6, 256), dtype=np.uint32)
_LENGTH = _rng.integers(0, 2**32, 7, dtype=np.uint32)
_BASE = _rng.integers(0, 2**63, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))


def normal(word: bytes) -> bytes:
    word = word.translate(_MAP, _DROP)
    return b" " + (word if word.isascii() else word.decode("utf-8", "ignore").lower().encode())


def windows(word: bytes) -> list[bytes]:
    return [word] if len(word) <= SPAN else [word[k:k + SPAN] for k in range(0, len(word) - SPAN // 2, SPAN // 2)]


def hashed(place) -> Iterator[tuple[tuple[int, ...], np.ndarray]]:
    """Each shape and the hashed subsequences it picks; ``place(j, k)`` gives
    the numbers of the bytes at offset k as a subsequence's j-th."""
    # A loop, not a function that calls itself: that would be a cycle, which
    # keeps these arrays until Python next looks for cycles.
    start: dict[tuple[int, ...], np.ndarray] = {}
    for shape in _SHAPES:
        for k in range(1, len(shape)):
            if shape[:k] not in start:
                own = place(k - 1, shape[k - 1])
                start[shape[:k]] = start[shape[:k - 1]] + own if k > 1 else own
        yield shape, (start[shape[:-1]] + place(len(shape) - 1, shape[-1]) + _LENGTH[len(shape)]) >> np.uint32(32 - TABLE_BITS)


def placed(codes: np.ndarray):
    """``place`` of every byte of ``codes``."""
    rows = [p[np.concatenate([codes, np.zeros(_REACH, np.uint8)])] for p in _PLACE]
    return lambda j, k: rows[j][k:k + len(codes)]


def subsequences(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, hashed subsequence, weight) of all words; weights scaled so that
    each word's squares sum to one."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    at = np.arange(int(size.sum()))
    of = np.repeat(np.arange(len(words)), size)
    end = np.repeat(np.cumsum(size), size)
    who, what, weight = [], [], []
    for shape, key in hashed(placed(np.frombuffer(b"".join(words), np.uint8))):
        i = at[at + shape[-1] < end]
        who.append(of[i])
        what.append(key[i].astype(np.int64))
        weight.append(np.full(len(i), _DECAYED[shape]))
    who, what, weight = np.concatenate(who), np.concatenate(what), np.concatenate(weight)
    norm = np.sqrt(np.maximum(np.bincount(who, weight * weight, len(words)), 1e-9))
    return who, what, weight / norm[who]


class Letters:
    """The words with letters of a batch of texts, normalised and end to end.

    ``codes`` the letters, ``start`` (words + 1) each word's first, ``doc``
    the text each word is of, ``tokens`` the texts' words.
    """

    __slots__ = ("codes", "start", "doc", "tokens")

    def __init__(self, texts: list[bytes]):
        lowered = [x if x.isascii() else x.decode("utf-8", "ignore").lower().encode() for x in texts]
        self.tokens = t = token_bounds(lowered)
        codes = _AS_LETTER[t.buf]
        keep = codes != 0
        before = np.zeros(len(codes) + 1, np.int64)
        np.cumsum(keep, out=before[1:])
        some = np.flatnonzero(before[t.end] > before[t.start]) if len(t.start) else np.zeros(0, np.int64)
        self.codes, self.doc = codes[keep], t.doc[some]
        self.start = np.append(before[t.start[some]], before[-1])

    def spans(self, n: int, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Spans of ``n`` words of one text that begin at the words lo to hi:
        (word, first letter, end, whether it begins the word); long ones in
        windows."""
        word = np.arange(lo, min(hi, len(self.doc) - n + 1))
        word = word[self.doc[word] == self.doc[word + n - 1]]
        a, b = self.start[word], self.start[word + n]
        step = SPAN // 2
        times = np.where(b - a < SPAN, 1, -(-(b - a + 1 - step) // step))
        k = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
        word, a, b = np.repeat(word, times), np.repeat(a, times), np.repeat(b, times)
        return word, a + step * k - (k > 0), np.minimum(b, a + step * k + SPAN - 1), k == 0

    def text(self, a: int, b: int, head: bool) -> bytes:
        return b" " * head + self.codes[a:b].tobytes()


_AS_LETTER = np.frombuffer(bytes(0 if i in _DROP else c for i, c in enumerate(_MAP)), np.uint8)


NOTHING = -2.0  # stands for a span where a text has fewer
EVIDENCE = 4  # the three worst places and the length


@dataclass
class Model:
    table: np.ndarray  # weight of every hashed subsequence
    bias: float
    weights: tuple[float, ...] = (1.0, 0.0, 0.0, 0.0, 0.0)  # of the evidence and a constant, in log-odds
    prior: float | None = None  # the answer where nothing could be learnt

    def spans(self, words: list[bytes]) -> np.ndarray:
        """Decision value per word: its worst window."""
        parts = [windows(normal(w)) for w in words]
        flat = [p for ps in parts for p in ps]
        value = np.full(len(flat), self.bias)
        for k in range(0, len(flat), SPAN_ROWS):
            who, what, weight = subsequences(flat[k:k + SPAN_ROWS])
            value[k:k + SPAN_ROWS] += np.bincount(who, weight * self.table[what], len(flat[k:k + SPAN_ROWS]))
        if len(flat) == len(parts):
            return value
        begin = np.cumsum([0] + [len(ps) for ps in parts[:-1]])
        return np.maximum.reduceat(value, begin)

    def starts(self, letters: Letters) -> tuple[np.ndarray, ...]:
        """Weights of the subsequences that begin at a letter, and of those
        that begin with the space before a word, by reach.  Both depend on the
        next few letters alone, so each run of letters is worked out once:
        (weights per run, run of every letter, the same of every word)."""
        codes = np.concatenate([letters.codes, np.zeros(_REACH, np.uint8)]).astype(np.uint64)
        size, begin = len(letters.codes), letters.start[:-1]
        ahead = np.zeros(size, np.uint64)
        for k in range(_REACH):
            ahead |= codes[k:k + size] << np.uint64(8 * k)
        out = []
        for run, space in ((ahead, False), (ahead[begin], True)):
            some, which = np.unique(run, return_inverse=True)
            weight = np.zeros((_REACH, len(some)))
            for at in range(0, len(some), RUNS):
                part = some[at:at + RUNS]
                byte = [((part >> np.uint64(8 * k)) & np.uint64(255)).astype(np.int64) for k in range(_REACH)]
                byte = [np.full(len(part), 32), *byte] if space else byte
                for shape, key in hashed(functools.cache(lambda j, k: _PLACE[j].take(byte[k]))):
                    weight[shape[-1], at:at + RUNS] += self.table[key] * np.float32(_DECAYED[shape])
            out += [weight, which]
        return tuple(out)

    def worst(self, letters: Letters, lo: int, hi: int, starts: tuple[np.ndarray, ...] | None = None) -> np.ndarray:
        """For the words lo to hi: decision value of the worst span, of one
        word or across word borders, that begins there."""
        weight, which, head_weight, head = starts or self.starts(letters)
        last = min(hi + GRAM - 1, len(letters.doc))
        base, end = int(letters.start[lo]), int(letters.start[last])
        total = np.zeros((_REACH, end - base + 1))
        for reach in range(2, _REACH):
            np.cumsum(weight[reach].take(which[base:end]), out=total[reach, 1:])
        head = head[lo:hi]
        out = np.full(hi - lo, -np.inf)
        for n in range(1, GRAM + 1):
            word, a, b, first = letters.spans(n, lo, hi)
            if not len(word):
                continue
            a, b = a - base, b - base
            begin, size = head.take(word - lo), b - a
            value = np.zeros(len(word))
            for reach in range(2, _REACH):
                value += total[reach].take(np.maximum(b - reach, a)) - total[reach].take(a)
                value += head_weight[reach].take(begin) * (first & (size >= reach))
            value = value / _NORM[size + first] + self.bias
            new = np.flatnonzero(np.diff(word, prepend=-1))
            out[word[new] - lo] = np.maximum(out[word[new] - lo], np.maximum.reduceat(value, new))
        return out


def spelled(t) -> tuple[list[int], list[bytes]]:
    """Runs of three or more single letters, read together: (text, letters)."""
    single = np.concatenate([[False], (t.end - t.start) == 1, [False]])
    edge = np.flatnonzero(single[1:] != single[:-1])
    docs, runs = [], []
    for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
        if b - a >= 3:
            for d in range(int(t.doc[a]), int(t.doc[b - 1]) + 1):
                lo, hi = max(a, int(t.first[d])), min(b, int(t.first[d + 1]))
                if hi - lo >= 3:
                    docs.append(d)
                    runs.append(t.buf[t.start[lo:hi]].tobytes())
    return docs, runs


def largest(doc: np.ndarray, value: np.ndarray, count: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """The largest values of every text; ``doc`` ascends."""
    docs, values = [], []
    value = value.copy()
    for _ in range(count if len(doc) else 0):
        begin = np.flatnonzero(np.diff(doc, prepend=-1))
        most = np.repeat(np.maximum.reduceat(value, begin), np.diff(np.append(begin, len(doc))))
        hit = np.flatnonzero(value == most)
        hit = hit[np.diff(doc[hit], prepend=-1) != 0]
        docs.append(doc[hit])
        values.append(value[hit])
        value[hit] = -np.inf
    return np.concatenate([np.zeros(0, np.int64), *docs]), np.concatenate([np.zeros(0), *values])


def evidence(texts: list[bytes], model: Model) -> np.ndarray:
    """Per text the three largest decision values of its places, and the log
    of its word count."""
    letters = Letters(texts)
    out = np.full((len(texts), EVIDENCE), NOTHING)
    out[:, 3] = np.log1p(np.diff(letters.tokens.first))
    docs, runs = spelled(letters.tokens)
    found = [(np.array(docs, np.int64), model.spans(runs))] if docs else []
    starts = model.starts(letters)
    for lo in range(0, len(letters.doc), BLOCK):
        hi = min(lo + BLOCK, len(letters.doc))
        found.append(largest(letters.doc[lo:hi], model.worst(letters, lo, hi, starts)))
    if found:
        doc, value = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((-value, doc))
        value, doc = value[order], doc[order]
        place = np.arange(len(doc)) - np.searchsorted(doc, doc)
        for k in range(3):
            out[doc[place == k], k] = value[place == k]
    return np.maximum(out, NOTHING)


def gram_keys(letters: Letters) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Spans across word borders, by number of words: (number of words, word,
    first letter, end, whether it begins the word, 64-bit hash)."""
    size = len(letters.codes)
    power, back = np.ones(size + 1, np.uint64), np.ones(size + 1, np.uint64)
    power[1:], back[1:] = _BASE, _UNBASE
    power, back = np.cumprod(power), np.cumprod(back)
    total = np.zeros(size + 1, np.uint64)
    np.cumsum(_BYTE[letters.codes] * power[:size], out=total[1:])
    for n in range(2, GRAM + 1):
        word, a, b, first = letters.spans(n, 0, len(letters.doc))
        key = mix64((total[b] - total[a]) * back[a] + (b - a).astype(np.uint64) * np.uint64(2) + first.astype(np.uint64))
        yield n, word, a, b, first, key.view(np.int64)


def gram_counts(sample: DataFrame, sure: list[bytes], known: np.ndarray | None) -> DataFrame:
    """(key, toxic documents, clean documents) of the spans across word
    borders without a ``sure`` word.  ``known`` (sorted keys) are counted, and
    one in ``PART`` of all others; without ``known``, all in toxic documents."""
    shared = sample.sparkSession.sparkContext.broadcast((frozenset(sure), known))  # at most the keys of the bounded sample

    def merged(parts: list[np.ndarray]) -> np.ndarray:
        rows = np.concatenate(parts)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        begin = np.flatnonzero(np.concatenate([[True], rows[1:, 0] != rows[:-1, 0]]))
        return np.column_stack([rows[begin, 0], np.add.reduceat(rows[:, 1:], begin, axis=0)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bad, wanted = shared.value
        parts, size = [], 0
        for batch in batches:
            labels = np.asarray(batch.column("__y")).astype(np.int64)
            for lo, hi, texts in text_lists(batch.column("__text"), 1 << 18):
                letters = Letters(texts)
                if not len(letters.doc):
                    continue
                flags = np.concatenate([[0], np.cumsum(marked(letters, bad))])
                for n, word, _, _, _, key in gram_keys(letters):
                    ok = flags[word + n] == flags[word]
                    label = labels[lo:hi][letters.doc[word]]
                    if wanted is None:
                        ok &= label == 1
                    else:
                        at = np.minimum(np.searchsorted(wanted, key), max(0, len(wanted) - 1))
                        ok &= (key % PART == 0) | ((wanted[at] == key) if len(wanted) else False)
                    key, label, doc = key[ok], label[ok], letters.doc[word[ok]]
                    if len(key):
                        order = np.lexsort((doc, key))
                        key, label, doc = key[order], label[order], doc[order]
                        new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])
                        parts.append(merged([np.column_stack([key[new], label[new], 1 - label[new]])]))
                        size += len(parts[-1])
                if size > 300_000:
                    parts = [merged(parts)]
                    if len(parts[0]) > 200_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in parts.pop().T], names=["key", "toxic", "clean"])
                    size = sum(map(len, parts))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in merged(parts).T], names=["key", "toxic", "clean"])

    return (map_batches(sample.select("__text", "__y"), run, "key bigint, toxic bigint, clean bigint")
            .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def marked(letters: Letters, bad: frozenset[bytes]) -> np.ndarray:
    """Which words hold a span in ``bad``."""
    out = np.zeros(len(letters.doc), bool)
    if bad:
        raw, bounds = letters.codes.tobytes(), letters.start.tolist()
        seen: dict[bytes, bool] = {}
        for i, (a, b) in enumerate(zip(bounds, bounds[1:])):
            word = b" " + raw[a:b]
            if word not in seen:
                seen[word] = not bad.isdisjoint(windows(word))
            out[i] = seen[word]
    return out


def gram_spans(sample: DataFrame, keys: np.ndarray) -> DataFrame:
    """(key, span) of the spans across word borders with the sorted ``keys``."""
    shared = sample.sparkSession.sparkContext.broadcast(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, done = shared.value, np.zeros(len(shared.value), bool)
        for batch in batches:
            for lo, hi, texts in text_lists(batch.column("__text"), 1 << 18):
                letters = Letters(texts)
                for _, _, a, b, first, key in gram_keys(letters) if len(letters.doc) else ():
                    at = np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)
                    hit = np.flatnonzero((wanted[at] == key) & ~done[at])
                    place, new = np.unique(at[hit], return_index=True)
                    done[place] = True
                    hit = hit[new]
                    spans = [letters.text(*x) for x in zip(a[hit].tolist(), b[hit].tolist(), first[hit].tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(key[hit]), pa.array(spans, pa.binary())], names=["key", "span"])

    return map_batches(sample.select("__text"), run, "key bigint, span binary").groupBy("key").agg(F.min("span").alias("span"))


def span_counts(sample: DataFrame) -> DataFrame:
    """(span, toxic documents, clean documents) over a labelled sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column("__y").to_pylist()
            for lo, hi, texts in text_lists(batch.column("__text"), 1 << 18):
                t = token_hashes(texts)
                seen: dict[bytes, list[int]] = {}
                found = [set() for _ in range(hi - lo)]
                for i, d in enumerate(t.doc.tolist()):
                    found[d].add(t.word(i))
                for d, run_ in zip(*spelled(t)):
                    found[d].add(run_)
                for words, label in zip(found, labels[lo:hi]):
                    for span in {x for w in words for x in windows(normal(w)) if len(x) >= 3}:
                        seen.setdefault(span, [0, 0])[0 if label else 1] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seen.keys(), pa.binary()), pa.array([v[0] for v in seen.values()], pa.int64()),
                     pa.array([v[1] for v in seen.values()], pa.int64())], names=["span", "toxic", "clean"])

    return (map_batches(sample.select("__text", "__y"), run, "span binary, toxic bigint, clean bigint")
            .groupBy("span").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def kernel(words: list[bytes], marks: list[bytes]) -> np.ndarray:
    """Kernel values of words against landmarks."""
    who, what, weight = subsequences(marks)
    index = np.full(1 << TABLE_BITS, -1)
    ids = np.unique(what)
    index[ids] = np.arange(len(ids))
    side = np.zeros((len(ids), len(marks)), np.float32)
    np.add.at(side, (index[what], who), weight)
    out = np.zeros((len(words), len(marks)), np.float32)
    for k in range(0, len(words), KERNEL_ROWS):
        who, what, weight = subsequences(words[k:k + KERNEL_ROWS])
        hit = np.flatnonzero(index[what] >= 0)
        hit = hit[np.argsort(who[hit], kind="stable")]
        if len(hit):
            part = side[index[what[hit]]] * weight[hit, None].astype(np.float32)
            some, begin = np.unique(who[hit], return_index=True)
            out[k + some] = np.add.reduceat(part, begin, axis=0)
    return out


def farthest(words: list[bytes], count: int) -> list[bytes]:
    """Farthest-first traversal in the kernel's distance, over the first
    600 words."""
    words = words[:600]
    if len(words) <= count:
        return words
    who, what, weight = subsequences(words)
    near, chosen = np.full(len(words), -1.0), [0]
    while True:
        own = who == chosen[-1]
        table = np.bincount(what[own], weight[own], 1 << TABLE_BITS)
        near = np.maximum(near, np.bincount(who, weight * table[what], len(words)))
        if len(chosen) == count:
            return [words[i] for i in chosen]
        chosen.append(int(np.argmin(near)))


def svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of an L2 SVM with squared hinge loss (last column: bias)."""
    w = np.zeros(z.shape[1] + 1)
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-3
    for _ in range(25):
        active = np.flatnonzero(y * (z @ w[:-1] + w[-1]) < 1)
        gram, goal = ridge.copy(), np.zeros(len(w))
        for k in range(0, len(active), 2000):
            rows = active[k:k + 2000]
            part = np.concatenate([z[rows], np.ones((len(rows), 1), z.dtype)], 1).astype(np.float64)
            weighed = part * cost[rows][:, None]
            gram += weighed.T @ part
            goal += weighed.T @ y[rows]
        new = np.linalg.solve(gram, goal)
        done = np.allclose(new, w, atol=1e-6)
        w = new
        if done:
            break
    return w


def train(positive: list[bytes], negative: list[bytes], marks: int = LANDMARKS, cost: float = 20.0) -> Model:
    words = positive + negative
    land = list(dict.fromkeys(farthest(positive, marks // 2) + farthest(negative, marks // 2)))
    values, vectors = np.linalg.eigh(kernel(land, land).astype(np.float64))
    ok = values > 1e-4 * values.max()
    root = vectors[:, ok] / np.sqrt(values[ok])
    z = kernel(words, land) @ root.astype(np.float32)
    y = np.concatenate([np.ones(len(positive)), -np.ones(len(negative))])
    w = svm(z, y, np.where(y > 0, cost * len(y) / (2 * len(positive)), cost * len(y) / (2 * len(negative))))
    beta = root @ w[:-1]
    who, what, weight = subsequences(land)
    return Model(np.bincount(what, weight * beta[who], 1 << TABLE_BITS).astype(np.float32), float(w[-1]))


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, ...]:
    """Ridge logistic regression of the labels on the evidence."""
    x = np.concatenate([x, np.ones((len(x), 1))], 1)
    ridge = np.diag([0.5, 0.5, 0.5, 0.5, 1e-6])
    w = np.zeros(EVIDENCE + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str, text_col: str, folds: int,
                    held: int, sample: int) -> DataFrame:
    """Texts and labels of at most ``sample`` toxic and three times as many
    clean labelled documents, copies aside."""
    marked = labels.filter(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold(F.col(id_col), folds) != held)) \
        .select(F.col(id_col).alias("__label_id"), F.col(label).cast("int").alias("__y"))
    order = (F.xxhash64("__label_id"), "__label_id")
    ids = write_scratch(marked.filter("__y = 1").orderBy(*order).limit(sample)
                        .unionAll(marked.filter("__y = 0").orderBy(*order).limit(3 * sample)), "tox-ids")
    rows = write_scratch(docs.join(F.broadcast(ids), col(id_col) == F.col("__label_id"))
                         .select(col(text_col).alias("__text"), "__y", F.xxhash64("__label_id", col(text_col)).alias("__row"),
                                 (F.pmod(F.xxhash64("__label_id"), F.lit(4)) == 0).alias("__aside")), "tox-sample")
    return without_copies(rows)


def without_copies(rows: DataFrame) -> DataFrame:
    """Drops sampled texts that share a MinHash value with another: many
    copies of one toxic text would make all of its words look like insults."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("__row")
            for lo, hi, texts in text_lists(batch.column("__text"), SLICE_BYTES):
                key, begin = shingle_sets(token_hashes(texts), hi - lo)
                some = np.flatnonzero(np.diff(begin))
                least = [np.minimum.reduceat(mix64(key + np.uint64(k)), begin[some]).view(np.int64) for k in range(4)] \
                    if len(some) else [np.zeros(0, np.int64)] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([ids.slice(lo, hi - lo).take(pa.array(some))] * 4), pa.array(np.concatenate(least)),
                     pa.array(np.repeat(np.arange(4), len(some)), pa.int32())], names=["id", "m", "k"])

    marks = map_batches(rows.select("__text", "__row"), run, "id bigint, m bigint, k int")
    first = marks.groupBy("m", "k").agg(F.min("id").alias("first"))
    copies = marks.join(first, ["m", "k"]).filter("id != first").select("id").distinct()
    single = write_scratch(rows.join(copies, F.col("__row") == F.col("id"), "left_anti"), "tox-single")
    # Where most of the sample is copies (boilerplate corpora), copies are all there is to learn from.
    toxic, left = (x.filter("__y = 1").count() for x in (rows, single))
    return single if left >= min(LEAST_TOXIC, toxic / 2) else rows


def evidence_of(docs: DataFrame, model: Model, text_col: str) -> DataFrame:
    """``__evidence`` per row beside all other columns but the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a table of 4 MB
    rest = [c for c in docs.columns if c != text_col]
    schema = docs.select(*map(col, rest)).schema.add("__evidence", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            keep = batch.drop_columns([text_col])
            for lo, hi, texts in text_lists(batch.column(text_col), 1 << 17):
                own = keep.slice(lo, hi - lo)
                values = pa.array(evidence(texts, shared.value).ravel())
                values = pa.FixedSizeListArray.from_arrays(values, EVIDENCE).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays(own.columns + [values], names=own.schema.names + ["__evidence"])

    return map_batches(docs.select(col(text_col), *map(col, rest)), run, schema)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
        folds: int = 3, held: int = 1, sample: int = SAMPLE, spans: int = SPANS) -> Model:
    rows = labelled_sample(docs, labels, label, id_col, text_col, folds, held, sample)
    n = {r["__y"]: r["n"] for r in rows.groupBy("__y").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    empty = Model(np.zeros(1 << TABLE_BITS, np.float32), 0.0)
    if not toxic or not clean:
        empty.prior = (toxic + 0.5) / (toxic + clean + 1)
        return empty
    seen = rows.filter("NOT __aside")
    counts = write_scratch(span_counts(seen), "tox-spans")
    # How much more often toxic documents hold the span, and the G statistic
    # of that difference (25: one in a million by chance).
    share = (F.col("toxic") + 0.5) / (toxic + 1.0) / ((F.col("clean") + 0.5) / (clean + 1.0))
    both = F.col("toxic") + F.col("clean")

    def term(seen: str, of: int):
        return F.when(F.col(seen) > 0, F.col(seen) * F.log(F.col(seen) * (toxic + clean) / (both * of))).otherwise(0.0)

    def witnesses(found: DataFrame, name: str):
        return (found.withColumn("g", 2 * (term("toxic", toxic) + term("clean", clean)))
                .filter((F.col("toxic") >= 2) & (share >= 8.0)).orderBy(F.col("g").desc(), name).limit(spans).toArrow())

    hits = witnesses(counts, "span")
    single = list(zip(hits.column("g").to_pylist(), hits.column("span").to_pylist()))
    sure = [bytes(s) for g, s in single if g >= 25.0]
    known = gram_counts(seen, sure, None).filter("toxic >= 2").select("key").toArrow().column("key")
    grams = write_scratch(gram_counts(seen, sure, np.sort(np.asarray(known).astype(np.int64))), "tox-grams")
    hits = witnesses(grams, "key")
    usual_grams = grams.filter((F.col("clean") >= 1) & (share < 2.0) & (F.col("key") % PART == 0)).select("key")
    pool = usual_grams.orderBy(F.xxhash64("key"), "key").limit(2 * spans).toArrow().column("key").to_pylist()
    wanted = np.array(sorted({*hits.column("key").to_pylist(), *pool}), np.int64)
    texts = write_scratch(gram_spans(seen, wanted), "tox-gram-spans") if len(wanted) else None
    span_of = {r["key"]: bytes(r["span"]) for r in texts.collect()} if texts is not None else {}
    across = [(g, span_of[k]) for g, k in zip(hits.column("g").to_pylist(), hits.column("key").to_pylist())]
    # Many more spans cross borders than there are words: those that chance explains are left out.
    positive = [bytes(s) for i, (g, s) in enumerate(single) if g >= 25.0 or i < 20] + [s for g, s in across if g >= 25.0]
    positive = list(dict.fromkeys(positive or [s for _, s in across[:20]]))
    usual = counts.filter((F.col("clean") >= 1) & (share < 2.0)).select("span")
    negative = [bytes(s) for s in usual.orderBy(F.xxhash64("span"), "span").limit(spans).toArrow().column("span").to_pylist()]
    negative = list(dict.fromkeys(negative + [span_of[k] for k in pool[:spans]]))
    if pool:
        usual = usual.unionAll(texts.filter(F.col("key") % PART == 0)
                               .join(usual_grams, "key", "left_semi").select("span"))
    if not positive or not negative:
        empty.prior = (toxic + 0.5) / (toxic + clean + 1)
        return empty
    for _ in range(2):
        model = train(positive, negative)
        hard = evidence_of(usual.select(F.col("span").cast("string").alias("__span"), "span"), model, "__span") \
            .orderBy(F.col("__evidence")[0].desc(), "span").limit(spans // 3).toArrow()
        negative = list(dict.fromkeys(negative + [bytes(s) for s in hard.column("span").to_pylist()]))
    model = train(positive, negative)
    got = evidence_of(rows.filter("__aside").select("__text", "__y"), model, "__text").toArrow()
    x = np.array(got.column("__evidence").to_pylist(), float).reshape(-1, EVIDENCE)
    model.weights = calibrate(x, np.asarray(got.column("__y")).astype(float))
    return model


def classify(docs: DataFrame, labels: DataFrame, label: str = "toxic", id_col: str = "doc_id", text_col: str = "text",
             folds: int = 3, held: int = 1, cut: float = 0.7, keep: tuple[str, ...] = (), **bounds) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    model = fit(docs, labels, label, id_col, text_col, folds, held, **bounds)
    got = evidence_of(docs.select(col(id_col).alias("__id"), col(text_col).alias("__text"),
                                  *[col(c).alias(f"__keep_{c}") for c in keep]), model, "__text")
    if model.prior is not None:
        score = F.lit(float(model.prior))
    else:
        odds = F.lit(model.weights[-1])
        for k, w in enumerate(model.weights[:-1]):
            odds = odds + F.col("__evidence")[k] * w
        score = 1 / (1 + F.exp(-odds))
    return got.select(F.col("__id").alias(id_col), *[col(f"__keep_{c}").alias(c) for c in keep],
                      (fold(F.col("__id"), folds) == held).alias("held_out"), score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= cut).cast("int"))


def filter_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     **options) -> DataFrame:
    """The input's rows and columns, without those predicted toxic."""
    keyed = docs.select("*", text_key(col(text_col)).alias("__text_key"))
    verdicts = classify(keyed, labels, "toxic", id_col, text_col, keep=("__text_key",), **options)
    return without(docs, verdicts.filter("predicted = 1"), id_col, text_col)
