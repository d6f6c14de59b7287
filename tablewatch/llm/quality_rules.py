"""Quality rules from tokeniser fertility.

Every word of a text is encoded (with a leading space) by two public
vocabularies: a byte-level one and a piece vocabulary with byte fallback.
Per document this gives characters per token under both, the shares of tokens
without a letter or digit and of those that fall back to bytes, and the entropy
of the token distribution (over the log of the token count).  Text that
a vocabulary handles far worse, or far more monotonously, than other text of
its language is rejected: the bands are quantile fences over all documents,
per language (or script, where the language is not a known code) and length
class.

Words repeat, so each worker encodes a word once and keeps the result in a
bounded cache; documents are then numpy sums over their words.

Defined cases: null text counts as empty (no words, base_failed); rows are
judged one by one, so repeated ids or texts get a row each; words of any length
are encoded whole; groups with fewer than ``min_group``
documents use the fences of their language, then of the whole table; a language
column is optional.
"""

from __future__ import annotations

import base64
import itertools
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import (SLICE_BYTES, Tokens, col, held, map_batches, per_doc, repeated_words, text_key, text_lists, token_hashes,
                                   without, write_scratch)
from tablewatch.operators.quantiles import radix_quantiles

TOKENIZERS = "/opt/tokenizers"
# The split pattern that belongs to the byte-level vocabulary.
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
LANGUAGES = ("de", "en", "es", "fr", "it", "nl", "pl", "pt", "ru", "tr", "uk", "zh", "ja", "ko", "ar", "hi")
SYMBOLS = b"#*$%&|<>"
CACHE_WORDS = 300_000

METRICS = ("chars_per_token", "chars_per_piece", "symbol_share", "fallback_share", "entropy")
# Accepted distance from the quartiles, in interquartile ranges, below and
# above; None leaves that side open.
FENCES = {"chars_per_token": (7.0, None), "chars_per_piece": (7.0, None),
          "symbol_share": (None, 4.0), "fallback_share": (None, 5.0), "entropy": (4.0, None)}
# Smallest interquartile range taken for a metric: groups that hardly vary
# would otherwise reject on noise.
LEAST_IQR = {"chars_per_token": 0.06, "chars_per_piece": 0.06, "symbol_share": 0.02, "fallback_share": 0.01, "entropy": 0.02}


class Vocabularies:
    """Both vocabularies, built in a worker from the files' bytes, and what
    recent words encode to: arrays sorted by word hash."""

    def __init__(self, ranks: bytes, model: bytes):
        import sentencepiece
        import tiktoken
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.bytes_ = tiktoken.Encoding("words", pat_str=BYTE_PATTERN, mergeable_ranks=table, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.length = np.zeros(max(table.values()) + 1, np.int64)
        self.plain = np.zeros(max(table.values()) + 1, bool)
        for token, i in table.items():
            self.length[i] = len(token)
            self.plain[i] = not (token.decode("utf-8", "replace").strip(" \ufffd").isalnum() or max(token) > 127)
        self.clear()

    @classmethod
    def get(cls, ranks: bytes, model: bytes) -> Vocabularies:
        return held((cls.__name__, hash((ranks, model))), lambda: cls(ranks, model))

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.begin, self.tokens, self.n_pieces, self.n_fallback = (np.zeros(0, np.int64) for _ in range(4))
        self.ids = np.zeros(0, np.int32)

    def rows(self, hashes: np.ndarray, at: np.ndarray, t: Tokens) -> np.ndarray:
        """Cache rows of the distinct words ``hashes`` (sorted); ``at``: where
        each stands in ``t``."""
        if len(self.keys) > CACHE_WORDS:
            self.clear()
        place = np.searchsorted(self.keys, hashes)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            self._add(hashes[new], [t.word(i) for i in at[new].tolist()])
            place = np.searchsorted(self.keys, hashes)
        return place

    def _add(self, hashes: np.ndarray, words: list[bytes]) -> None:
        flat = [w.decode("utf-8", "replace") for w in words]
        # One text with a space before each word encodes as the words do one by
        # one; a token's word follows from the tokens' byte lengths.
        ids = np.array(self.bytes_.encode_ordinary(" " + " ".join(flat)), np.int64)
        end = np.cumsum([len(p.encode()) + 1 for p in flat])
        of = np.searchsorted(end, np.cumsum(self.length[ids]) - self.length[ids], side="right")
        tokens = np.bincount(of, minlength=len(flat))
        pieces = self.pieces.encode(flat)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        low = self.is_byte[np.fromiter(itertools.chain.from_iterable(pieces), np.int64, int(size.sum()))]
        own = np.repeat(np.arange(len(flat)), size)
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.begin = np.concatenate([self.begin, len(self.ids) + np.cumsum(tokens) - tokens])[order]
        self.tokens = np.concatenate([self.tokens, tokens])[order]
        self.n_pieces = np.concatenate([self.n_pieces, np.bincount(own, minlength=len(flat))])[order]
        self.n_fallback = np.concatenate([self.n_fallback, np.bincount(own[low], minlength=len(flat))])[order]
        self.ids = np.concatenate([self.ids, ids.astype(np.int32)])


def measure(texts: list[bytes], vocab: Vocabularies) -> dict[str, np.ndarray]:
    """Base counts and fertility metrics of a batch of texts."""
    t = token_hashes(texts, lower=False)
    n = np.diff(t.first)
    inside = np.zeros(len(t.buf) + 1, np.int8)
    np.add.at(inside, t.start, 1)
    np.add.at(inside, t.end, -1)
    inside = np.cumsum(inside[:-1], dtype=np.int8) > 0
    points = (t.buf & 0xC0) != 0x80
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out = {"n_words": n, "word_chars": per_doc(inside & points, t.bounds), "n_symbols": per_doc(symbol[t.buf], t.bounds),
           "n_repeat_words": repeated_words(t)}
    lines = [[x for x in text.split(b"\n") if x.strip()] if b"\n" in text else [] for text in texts]
    out["n_dup_lines"] = np.array([len(x) - len(set(x)) for x in lines], np.int64)
    hashes, at, inverse = np.unique(t.hash, return_index=True, return_inverse=True)
    rows = vocab.rows(hashes, at, t)[inverse]
    size = vocab.tokens[rows]
    each = np.arange(int(size.sum())) + np.repeat(vocab.begin[rows] - (np.cumsum(size) - size), size)
    ids = vocab.ids[each].astype(np.int64)
    tokens = per_doc(size, t.first)
    of = np.repeat(np.arange(len(texts)), tokens)
    values, count = np.unique(of * (1 << 20) + ids, return_counts=True)
    clogc = np.bincount(values >> 20, weights=count * np.log2(count), minlength=len(texts))
    plain = np.bincount(of[vocab.plain[ids]], minlength=len(texts))
    pieces = per_doc(vocab.n_pieces[rows], t.first)
    fallback = per_doc(vocab.n_fallback[rows], t.first)
    some = np.maximum(tokens, 1)
    out["n_tokens"] = tokens
    out["chars_per_token"] = out["word_chars"] / some
    out["chars_per_piece"] = out["word_chars"] / np.maximum(pieces, 1)
    out["symbol_share"] = plain / some
    out["fallback_share"] = fallback / np.maximum(pieces, 1)
    out["entropy"] = np.maximum(np.log2(some) - clogc / some, 0) / np.log2(np.maximum(tokens, 2))
    return out


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens")


def script_of(text):
    """Coarse script of a text, for documents without a known language."""
    letters = F.regexp_replace(F.coalesce(text, F.lit("")), r"[^\p{L}]", "")
    name = F.lit("other")
    for script, cls in (("latin", r"\p{IsLatin}"), ("cyrillic", r"\p{IsCyrillic}"), ("greek", r"\p{IsGreek}"),
                        ("han", r"\p{IsHan}"), ("arabic", r"\p{IsArabic}")):
        some = F.length(F.regexp_replace(letters, cls, "")) * 2 < F.length(letters)
        name = F.when(some, F.lit(script)).otherwise(name)
    return name


def fertility(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
              tokenizers: str = TOKENIZERS, keep: Sequence[str] = ()) -> DataFrame:
    """Base counts and metrics per row; ``keep`` names further columns to carry."""
    with open(f"{tokenizers}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = f.read()
    with open(f"{tokenizers}/piece_bpe_32k.model", "rb") as f:
        model = f.read()
    shared = docs.sparkSession.sparkContext.broadcast((ranks, model))  # two files, 1.3 MB
    text = col(text_col)
    group = script_of(text)
    if lang_col and lang_col in docs.columns:
        group = F.when(col(lang_col).isin(*LANGUAGES), col(lang_col)).otherwise(group)
    source = docs.select(col(id_col).alias("__id"), text.alias("__text"), group.alias("__group"),
                         *[col(c).alias(f"__keep_{c}") for c in keep])
    carried = [f for f in source.schema.fields if f.name != "__text"]
    schema = T.StructType(carried + [T.StructField(c, T.LongType()) for c in _LONGS]
                          + [T.StructField(c, T.DoubleType()) for c in METRICS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = Vocabularies.get(*shared.value)
        for batch in batches:
            rest = batch.drop_columns(["__text"])
            for lo, hi, texts in text_lists(batch.column("__text"), SLICE_BYTES):
                m = measure(texts, vocab)
                own = rest.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    own.columns + [pa.array(m[c], pa.int64()) for c in _LONGS] + [pa.array(m[c], pa.float64()) for c in METRICS],
                    names=own.schema.names + list(_LONGS) + list(METRICS))
        vocab.clear()

    return map_batches(source, run, schema)


def bands(measured: DataFrame, min_group: int = 40) -> DataFrame:
    """Fences per language (or script) and length class, over all documents
    that pass the base rules; null group or class: the wider fallbacks.  The
    quartiles are exact, so the fences are a function of the rows alone."""
    ok = measured.filter(~F.col("base_failed")).select("__group", length_class().alias("__len"), *METRICS)
    levels = F.array(*[F.struct(F.lit(level).alias("__level"), group.alias("__g"), size.alias("__l")) for level, group, size in (
        (0, F.col("__group"), F.col("__len")), (1, F.col("__group"), F.lit(None).cast("int")),
        (3, F.lit(None).cast("string"), F.lit(None).cast("int")))])
    metrics = F.array(*[F.struct(F.lit(c).alias("__metric"), F.col(c).alias("__value")) for c in METRICS])
    part = ["__level", "__g", "__l"]
    long = ok.withColumn("__in", F.explode(levels)).withColumn("__m", F.explode(metrics)).select("__in.*", "__m.*")
    quart = radix_quantiles(long, [*part, "__metric"], "__value", [0.25, 0.75], ["__q1", "__q3"])
    sizes = ok.withColumn("__in", F.explode(levels)).select("__in.*").groupBy(*part).agg(F.count(F.lit(1)).alias("__n"))
    per = quart.groupBy(*part).agg(*[F.max(F.when(F.col("__metric") == c, F.struct("__q1", "__q3"))).alias(f"__q_{c}")
                                     for c in METRICS])
    same = reduce(lambda a, b: a & b, [per[c].eqNullSafe(sizes[c]) for c in part])
    per = per.join(sizes, same).select(per["*"], sizes["__n"])
    out = []
    for c in METRICS:
        q = F.col(f"__q_{c}")
        iqr = F.greatest(q["__q3"] - q["__q1"], F.lit(LEAST_IQR[c]))
        low, high = FENCES[c]
        out.append((q["__q1"] - iqr * low if low is not None else F.lit(float("-inf"))).alias(f"__lo_{c}"))
        out.append((q["__q3"] + iqr * high if high is not None else F.lit(float("inf"))).alias(f"__hi_{c}"))
    return write_scratch(per.filter((F.col("__n") >= min_group) | (F.col("__level") == 3)).select(
        F.col("__g").alias("__group"), F.col("__l").alias("__len"), "__level", *out), "fences")


def length_class():
    return F.least(F.floor(F.log2(F.greatest(F.col("n_words"), F.lit(1)).cast("double")) / 2), F.lit(15)).cast("int")


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang",
          min_words: int = 50, tokenizers: str = TOKENIZERS, keep: Sequence[str] = ()) -> DataFrame:
    """Counts, metrics, ``base_failed`` and ``kept`` per row.

    The metrics (a few numbers per document) are written once; the fences are
    a table of at most (languages + scripts) x 16 rows and are broadcast.
    """
    measured = write_scratch(
        fertility(docs, id_col, text_col, lang_col, tokenizers, keep)
        .withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))),
        "fertility")
    fence = bands(measured)
    edges = [c for c in fence.columns if c.startswith(("__lo_", "__hi_"))]
    rows = measured.withColumn("__len", length_class())
    for level, keys in ((0, ("__group", "__len")), (1, ("__group",))):
        part = fence.filter(F.col("__level") == level).select(
            *[F.col(k).alias(f"__{level}{k}") for k in keys], F.struct(*edges).alias(f"__e{level}"))
        on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__{level}{k}") for k in keys])
        rows = rows.join(F.broadcast(part), on, "left")
    widest = fence.filter(F.col("__level") == 3).first()  # one row, none without documents
    e3 = F.struct(*[F.lit(widest[c] if widest else None).cast("double").alias(c) for c in edges])
    e = F.coalesce(F.col("__e0"), F.col("__e1"), e3)
    inside = F.lit(True)
    for c in METRICS:
        inside = inside & F.coalesce((F.col(c) >= e[f"__lo_{c}"]) & (F.col(c) <= e[f"__hi_{c}"]), F.lit(True))
    return rows.select(F.col("__id").alias(id_col), *[col(f"__keep_{c}").alias(c) for c in keep], *_LONGS, *METRICS,
                       F.col("__group").alias("band"), "base_failed", (~F.col("base_failed") & inside).alias("kept"))


def filter_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The input's rows and columns, without those not kept."""
    keyed = docs.select("*", text_key(col(text_col)).alias("__text_key"))
    verdicts = judge(keyed, id_col, text_col, keep=("__text_key",), **options)
    return without(docs, verdicts.filter(~F.col("kept")), id_col, text_col)
