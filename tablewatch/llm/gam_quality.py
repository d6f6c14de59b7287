"""Quality classifier: a generalised additive model with pairwise terms.

Every document becomes a few numbers in one pass over its text.  Each number
is cut into bins at quantiles of the labelled sample; cyclic boosting goes
round the features, each time fitting a tree of at most four leaves to one
feature's bins and adding a small step to that feature's lookup table.  Pairs
of features that explain most of what is left get tables of their own in the
same way.  A score is then a sum of table entries, looked up for a whole batch
at once.

The labelled sample is at most ``sample`` rows (the smallest hashes of the
ids), the only thing that is collected; features and scores cover all rows.

Defined cases: null text counts as empty and gets a score like any other;
repeated rows are scored one by one; rows with a null label do not train;
without labels of both classes every score is the smoothed share of label 1
(0.5 without any); an empty table gives an empty result; other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import fold, per_doc, repeated_words, slices, texts_of, token_hashes, write_scratch

SAMPLE = 30_000
FEATURES = ("log_words", "word_length", "symbol_share", "upper_share", "digit_share", "punct_share", "bang_share",
            "pipe_share", "dup_lines", "repeated", "distinct", "line_words", "long_words", "closed_lines",
            "high_share", "capital_words")


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


_SYMBOL, _PUNCT, _DIGIT = _class(b"#*$%&<>|@^~=+_\\{}[]"), _class(b".,;:!?'\"()-"), _class(b"0123456789")
_UPPER, _LETTER = _class(bytes(range(65, 91))), _class(bytes([*range(65, 91), *range(97, 123)]))
_STOP = _class(b".!?:;\"')")


def features(texts: list[bytes]) -> np.ndarray:
    """(texts x FEATURES) numbers; an empty text has zeros."""
    t = token_hashes(texts, lower=False)
    n = np.diff(t.first)
    words, size = np.maximum(n, 1), np.maximum(np.diff(t.bounds), 1)
    letters = np.maximum(per_doc(_LETTER[t.buf], t.bounds), 1)
    out = np.zeros((len(texts), len(FEATURES)))
    out[:, 0] = np.log1p(n)
    length = t.end - t.start
    out[:, 1] = per_doc(length, t.first) / words
    for k, (table, base) in enumerate(((_SYMBOL, size), (_UPPER, letters), (_DIGIT, size), (_PUNCT, size)), 2):
        out[:, k] = per_doc(table[t.buf], t.bounds) / base
    out[:, 6] = per_doc(t.buf == 33, t.bounds) / size
    out[:, 7] = per_doc(t.buf == 124, t.bounds) / size
    out[:, 9] = repeated_words(t) / words
    order = np.lexsort((t.hash, t.doc))
    h, d = t.hash[order], t.doc[order]
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (d[1:] != d[:-1])
    out[:, 10] = np.bincount(d[fresh], minlength=len(texts)) / words
    for i, text in enumerate(texts):
        lines = [x for x in text.split(b"\n") if x.strip()]
        if lines:
            out[i, 8] = 1 - len(set(lines)) / len(lines)
            out[i, 11] = np.log1p(n[i] / len(lines))
            out[i, 13] = sum(_STOP[x.rstrip()[-1]] for x in lines) / len(lines)
    out[:, 12] = per_doc(length >= 14, t.first) / words
    out[:, 14] = per_doc(t.buf >= 128, t.bounds) / size
    out[:, 15] = per_doc(_UPPER[t.buf[t.start]], t.first) / words
    return out


@dataclass
class Model:
    """Bin edges and additive tables in log-odds."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)  # fine bin -> coarse bin, per feature
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)], 1) \
            if self.edges else np.zeros((len(x), 0), np.int64)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            z += table[b[:, f]]
        for (p, q), table in zip(self.pairs, self.pair_tables):
            z += table[self.coarse[p][b[:, p]], self.coarse[q][b[:, q]]]
        return 1 / (1 + np.exp(-z))


def _cut(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """Best single cut of ordered bins: (gain, bins on the left)."""
    cg, ch = np.cumsum(g), np.cumsum(h)
    left = cg[:-1] ** 2 / (ch[:-1] + ridge)
    right = (cg[-1] - cg[:-1]) ** 2 / (ch[-1] - ch[:-1] + ridge)
    gain = left + right - cg[-1] ** 2 / (ch[-1] + ridge)
    if not len(gain):
        return 0.0, 0
    k = int(np.argmax(gain))
    return float(gain[k]), k + 1


def _tree(g: np.ndarray, h: np.ndarray, ridge: float) -> np.ndarray:
    """Leaf values per bin of a depth-two tree."""
    out = np.zeros(len(g))
    gain, k = _cut(g, h, ridge)
    for lo, hi in ((0, k), (k, len(g))) if gain > 1e-9 else ((0, len(g)),):
        inner, j = _cut(g[lo:hi], h[lo:hi], ridge)
        for a, b in ((lo, lo + j), (lo + j, hi)) if inner > 1e-9 else ((lo, hi),):
            out[a:b] = g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Best cut along one side, then one cut in each half along the other."""
    best = (-1.0, np.zeros_like(g))
    for turn in (False, True):
        a, b = (g.T, h.T) if turn else (g, h)
        gain, k = _cut(a.sum(1), b.sum(1), ridge)
        out = np.zeros_like(a)
        for lo, hi in ((0, k), (k, len(a))) if gain > 1e-9 else ((0, len(a)),):
            inner, j = _cut(a[lo:hi].sum(0), b[lo:hi].sum(0), ridge)
            gain += inner
            for c, d in ((0, j), (j, a.shape[1])) if inner > 1e-9 else ((0, a.shape[1]),):
                out[lo:hi, c:d] = a[lo:hi, c:d].sum() / (b[lo:hi, c:d].sum() + ridge)
        if gain > best[0]:
            best = (gain, out.T if turn else out)
    return best


def fit(x: np.ndarray, y: np.ndarray, n_bins: int = 32, rounds: int = 120, rate: float = 0.15, n_pairs: int = 6,
        pair_rounds: int = 40, coarse: int = 8, ridge: float = 5.0) -> Model:
    model = Model(intercept=float(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))) if len(y) else 0.0)
    if not len(y) or y.min() == y.max():
        return model
    for f in range(x.shape[1]):
        edges = np.unique(np.quantile(x[:, f], np.linspace(0, 1, n_bins + 1)[1:-1]))
        model.edges.append(edges)
        model.tables.append(np.zeros(len(edges) + 1))
        model.coarse.append(np.minimum(np.arange(len(edges) + 1) * coarse // (len(edges) + 1), coarse - 1))
    b = model.bins(x)
    z = np.full(len(y), model.intercept)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-z))
        return y - p, p * (1 - p)

    for _ in range(rounds):
        for f, table in enumerate(model.tables):
            g, h = slopes()
            step = rate * _tree(np.bincount(b[:, f], g, len(table)), np.bincount(b[:, f], h, len(table)), ridge)
            table += step
            z += step[b[:, f]]
    small = np.stack([model.coarse[f][b[:, f]] for f in range(x.shape[1])], 1)

    def grid(values: np.ndarray, p: int, q: int) -> np.ndarray:
        return np.bincount(small[:, p] * coarse + small[:, q], values, coarse * coarse).reshape(coarse, coarse)

    g, h = slopes()
    gains = sorted(((_quadrants(grid(g, p, q), grid(h, p, q), ridge)[0], p, q)
                    for p in range(x.shape[1]) for q in range(p)), reverse=True)
    model.pairs = [(p, q) for _, p, q in gains[:n_pairs]]
    model.pair_tables = [np.zeros((coarse, coarse)) for _ in model.pairs]
    for _ in range(pair_rounds):
        for (p, q), table in zip(model.pairs, model.pair_tables):
            g, h = slopes()
            step = rate * _quadrants(grid(g, p, q), grid(h, p, q), ridge)[1]
            table += step
            z += step[small[:, p], small[:, q]]
    return model


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    source = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    id_type = source.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = texts_of(batch.column("__text"))
            for lo, hi in slices(texts):
                x = features(texts[lo:hi])
                values = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([batch.column("__id").slice(lo, hi - lo), values], names=["__id", "__x"])

    return source.mapInArrow(run, f"__id {id_type}, __x array<double>")


def training_rows(x: DataFrame, labels: DataFrame, label: str, id_col: str, folds: int, held: int,
                  sample: int) -> DataFrame:
    """Labelled rows outside the held-out fold, at most ``sample``."""
    marked = labels.filter(F.col(label).isNotNull() & (fold(F.col(id_col), folds) != held)) \
        .select(F.col(id_col).alias("__label_id"), F.col(label).cast("double").alias("__y"))
    return (x.join(marked, F.col("__id") == F.col("__label_id"))
            .orderBy(F.xxhash64("__label_id"), "__label_id", "__y").limit(sample).select("__x", "__y"))


def classify(docs: DataFrame, labels: DataFrame, label: str = "quality", id_col: str = "doc_id", text_col: str = "text",
             folds: int = 3, held: int = 1, cut: float = 0.5, sample: int = SAMPLE) -> DataFrame:
    """Per row: id, held_out, score, predicted."""
    x = write_scratch(measured(docs, id_col, text_col), "gam-features")
    rows = training_rows(x, labels, label, id_col, folds, held, sample).toArrow()
    y = np.asarray(rows.column("__y"))
    values = rows.column("__x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(y), -1) \
        if len(y) else np.zeros((0, len(FEATURES)))
    model = fit(values, y)
    id_type = x.schema["__id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = batch.column("__x").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            score = pa.array(model.score(got)) if batch.num_rows else pa.array([], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("__id"), score], names=["__id", "score"])

    return x.mapInArrow(run, f"__id {id_type}, score double").select(
        F.col("__id").alias(id_col), (fold(F.col("__id"), folds) == held).alias("held_out"), "score",
        (F.col("score") >= cut).cast("int").alias("predicted"))
