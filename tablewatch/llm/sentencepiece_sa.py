"""SentencePiece encoding and decoding by suffix-array matching.

A BPE piece vocabulary (identity normalisation, dummy prefix, byte fallback) is
applied to whole batches:

1. No piece has a space mark after another character, so texts can be cut
   before every run of spaces (and around characters no piece holds, such as
   line breaks) without changing the result.  Each distinct segment of a batch
   is encoded once; a worker remembers recent ones.
2. The segments are put end to end and their suffixes sorted (to the longest
   piece's length, with several characters packed into one integer key).
3. Every piece is binary-searched in the sorted suffixes; the range found holds
   all its occurrences, each an edge from its first position to its last.
4. Edges are sorted by position and relaxed left to right.  The encoding of a
   prefix is unique under BPE, so a node keeps only its last piece; an edge
   relaxes its end if its piece can follow that last piece.  Two pieces can
   stand side by side if no merge across their border would have come first,
   which is read off both pieces' merge trees.
5. The pieces are collected backwards from the segments' ends.

Decoding gathers the pieces' bytes, turns space marks into spaces and drops the
dummy prefix.

Defined cases: null text counts as empty and has no pieces; a literal space
mark (U+2581) encodes like a space and so does not survive the round trip
(``round_trip`` is false); repeated rows are encoded one by one; an empty table
gives an empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablewatch.llm.common import col, hash_spans, held, map_batches, text_lists

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
CACHE_SEGMENTS = 250_000
BATCH_BYTES = 1 << 19
SEGMENTS = 20_000  # segments indexed at a time


class Pieces:
    """A vocabulary: pieces, merge trees and the pair table."""

    def __init__(self, pieces: list[str], scores: list[float], byte_ids: dict[int, int], n_special: int):
        self.byte_id = np.array([byte_ids[b] for b in range(256)], np.int64)
        special = set(range(n_special)) | set(byte_ids.values())
        own = {p: i for i, p in enumerate(pieces) if i not in special}
        alphabet = sorted(p for p in own if len(p) == 1)
        self.n = len(pieces)
        self.unknown = self.n  # stands for a character without a piece
        self.symbol = np.zeros(0x110000, np.uint16)
        self.symbol[[ord(c) for c in alphabet]] = np.arange(2, len(alphabet) + 2)
        self.alphabet = [0, 1, *[ord(c) for c in alphabet]]
        self.rank = np.full(self.n + 1, -np.inf)
        self.left, self.right = np.full(self.n + 1, -1), np.full(self.n + 1, -1)
        self.usable: list[tuple[str, int]] = []
        merges = {}
        for p, i in own.items():
            if len(p) == 1:
                self.usable.append((p, i))
                continue
            tree = self._derive(p, own, scores)
            if tree is None:  # no sequence of merges makes this piece
                continue
            self.rank[i] = -scores[i]
            self.left[i], self.right[i] = tree
            self.usable.append((p, i))
        reachable = {p for p, _ in self.usable}
        for p, i in own.items():
            for k in range(1, len(p)):
                if p[:k] in reachable and p[k:] in reachable:
                    merges[own[p[:k]] * (self.n + 1) + own[p[k:]]] = -scores[i]
        self._fill(merges)
        raw = [bytes([b]) for b in range(256)]
        table = [p.replace(MARK, " ").encode() for p in pieces]
        for b, i in byte_ids.items():
            table[i] = raw[b]
        for i in range(n_special):
            table[i] = b""
        self.size = np.array([len(x) for x in table], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes_ = np.frombuffer(b"".join(table), np.uint8)
        self.solo = bytes(b for b in (9, 10, 13) if not self.symbol[b])
        self.clear()

    @classmethod
    def load(cls, model: bytes) -> tuple:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        pieces = [sp.id_to_piece(i) for i in range(n)]
        if sp.encode(" a  b", out_type=str) != sp.encode(" a  b".replace(" ", MARK), out_type=str) or \
                any(MARK in p.lstrip(MARK) for p in pieces):
            raise ValueError("only vocabularies with identity normalisation and leading space marks are supported")
        special = [i for i in range(n) if sp.is_unknown(i) or sp.is_control(i) or sp.is_unused(i)]
        return (pieces, [sp.get_score(i) for i in range(n)],
                {int(p[3:5], 16): i for i, p in enumerate(pieces) if sp.is_byte(i)}, max(special) + 1)

    @classmethod
    def get(cls, spec: tuple) -> Pieces:
        return held((cls.__name__, hash((tuple(spec[0]), tuple(spec[1])))), lambda: cls(*spec))

    @staticmethod
    def _derive(piece: str, own: dict[str, int], scores: list[float]) -> tuple[int, int] | None:
        """The last merge when the piece's own text is encoded."""
        parts, last = list(piece), None
        while len(parts) > 1:
            best = max(((scores[own[a + b]], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in own),
                       default=None)
            if best is None:
                return None
            k = -best[1]
            last = (own.get(parts[k], -1), own.get(parts[k + 1], -1))
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
        return last if last and min(last) >= 0 else None

    def _fill(self, merges: dict[int, float]) -> None:
        """Open-addressing table of pairs, for vectorised lookups."""
        self.bits = max(4, (len(merges) * 4).bit_length())
        keys, ranks = np.fromiter(merges, np.int64, len(merges)), np.fromiter(merges.values(), float, len(merges))
        self.pair_key, self.pair_rank = np.full(1 << self.bits, -1), np.full(1 << self.bits, np.inf)
        slot, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = self.pair_key[slot[todo]] < 0
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.pair_key[at], self.pair_rank[at] = keys[won], ranks[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of two pieces, infinite if there is none."""
        key = a * (self.n + 1) + b
        slot = self._slot(key)
        found = self.pair_key[slot]
        out = np.where(found == key, self.pair_rank[slot], np.inf)
        todo = np.flatnonzero((found != key) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & ((1 << self.bits) - 1)
            found = self.pair_key[slot[todo]]
            hit = found == key[todo]
            out[todo[hit]] = self.pair_rank[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out

    def can_follow(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether BPE leaves a and b side by side.  Back in time, the piece
        made last is undone; each neighbouring pair must not have merged
        before that."""
        ok = np.ones(len(a), bool)
        todo = np.flatnonzero((a != self.unknown) & (b != self.unknown))
        a, b = a[todo].copy(), b[todo].copy()
        limit = np.full(len(todo), np.inf)
        closed = np.zeros(len(todo), bool)  # a border merge of equal rank would have come first
        while len(todo):
            rank = self.merge_rank(a, b)
            crossed = (rank < limit) | (closed & (rank == limit) & np.isfinite(rank))
            ok[todo[crossed]] = False
            ra, rb = self.rank[a], self.rank[b]
            stay = ~crossed & (np.maximum(ra, rb) > -np.inf)
            todo, a, b, ra, rb = todo[stay], a[stay], b[stay], ra[stay], rb[stay]
            # Of equal ranks the left merge came first, so the right one is undone first.
            undo_b = rb >= ra
            limit, closed = np.where(undo_b, rb, ra), undo_b
            b = np.where(undo_b, self.left[b], b)
            a = np.where(undo_b, a, self.right[a])
        return ok

    # Recent segments, sorted by hash: where their ids begin and how many.

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.seg_begin = self.seg_size = np.zeros(0, np.int64)
        self.seg_ids = np.zeros(0, np.int32)

    def lookup(self, hashes: np.ndarray, text_of) -> np.ndarray:
        """Cache rows of distinct sorted segment hashes."""
        if len(self.keys) > CACHE_SEGMENTS:
            self.clear()
        place = np.searchsorted(self.keys, hashes)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == hashes[known]
        new = np.flatnonzero(~known)
        if len(new):
            made = [self.encode_segments([text_of(i) for i in new[k:k + SEGMENTS].tolist()])
                    for k in range(0, len(new), SEGMENTS)]
            ids, size = (np.concatenate([m[j] for m in made]) for j in (0, 1))
            keys = np.concatenate([self.keys, hashes[new]])
            order = np.argsort(keys, kind="stable")
            self.keys = keys[order]
            self.seg_begin = np.concatenate([self.seg_begin, len(self.seg_ids) + np.cumsum(size) - size])[order]
            self.seg_size = np.concatenate([self.seg_size, size])[order]
            self.seg_ids = np.concatenate([self.seg_ids, ids.astype(np.int32)])
            place = np.searchsorted(self.keys, hashes)
        return place

    def edges(self, sym: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, piece, length) of all occurrences of pieces in a symbol
        text, from its sorted suffixes."""
        present = np.unique(sym)
        code = np.zeros(len(self.alphabet), np.int64)
        code[present] = np.arange(len(present)) + 1
        bits = int(len(present) + 1).bit_length()
        per = 64 // bits
        char_code = {self.alphabet[s]: int(code[s]) for s in present.tolist() if s > 1}
        coded = np.concatenate([code[sym], np.zeros(64, np.int64)]).astype(np.uint64)
        longest = max((len(p) for p, _ in self.usable), default=1)
        keys = []
        for base in range(0, longest, per):
            key = np.zeros(len(sym), np.uint64)
            for k in range(per):
                key = (key << np.uint64(bits)) | coded[base + k:base + k + len(sym)]
            keys.append(key)
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        lows, highs, ids, sizes = [], [], [], []
        deep = []
        for p, i in self.usable:
            try:
                c = [char_code[ord(x)] for x in p]
            except KeyError:
                continue
            if len(c) > per:
                deep.append((c, i))
                continue
            low = 0
            for x in c:
                low = (low << bits) | x
            rest = bits * (per - len(c))
            lows.append(low << rest)
            highs.append((low << rest) | ((1 << rest) - 1))
            ids.append(i)
            sizes.append(len(c))
        lo = np.searchsorted(keys[0], np.array(lows, np.uint64), "left")
        hi = np.searchsorted(keys[0], np.array(highs, np.uint64), "right")
        for c, i in deep:
            a, b = 0, len(sym)
            for depth in range((len(c) + per - 1) // per):
                part = c[depth * per:(depth + 1) * per]
                low = 0
                for x in part:
                    low = (low << bits) | x
                rest = bits * (per - len(part))
                part_key = keys[depth][a:b]
                a, b = a + int(np.searchsorted(part_key, np.uint64(low << rest), "left")), \
                    a + int(np.searchsorted(part_key, np.uint64((low << rest) | ((1 << rest) - 1)), "right"))
                if a >= b:
                    break
            if a < b:
                lo, hi = np.append(lo, a), np.append(hi, b)
                ids.append(i)
                sizes.append(len(c))
        count = hi - lo
        at = np.arange(int(count.sum())) + np.repeat(lo - (np.cumsum(count) - count), count)
        return order[at], np.repeat(np.array(ids, np.int64), count), np.repeat(np.array(sizes, np.int64), count)

    def encode_segments(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, ids per segment) of non-empty segments."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        begin = np.cumsum(size + 1) - (size + 1)
        code = np.frombuffer(("\0".join(segments) + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
        sym = self.symbol[code]
        border = begin + size
        stranger = sym == 0
        stranger[border] = False
        sym[stranger] = 1
        sym[border] = 0
        start, piece, length = self.edges(sym)
        odd = np.flatnonzero(stranger)
        start, piece = np.concatenate([start, odd]), np.concatenate([piece, np.full(len(odd), self.unknown)])
        length = np.concatenate([length, np.ones(len(odd), np.int64)])
        inside = np.repeat(np.arange(len(segments)), size + 1)
        offset = start - begin[inside[start]]
        order = np.argsort(offset.astype(np.uint16) if offset.max(initial=0) < 65536 else offset, kind="stable")
        start, piece, length, offset = start[order], piece[order], length[order], offset[order]
        last, back = np.full(len(code), -1), np.zeros(len(code), np.int64)
        step = np.searchsorted(offset, np.arange(int(offset.max(initial=-1)) + 2))
        for k in range(len(step) - 1):
            e = slice(step[k], step[k + 1])
            s, p, n = start[e], piece[e], length[e]
            if k:
                ok = last[s] >= 0
                s, p, n = s[ok], p[ok], n[ok]
                ok = self.can_follow(last[s], p)
                s, p, n = s[ok], p[ok], n[ok]
            last[s + n] = p
            back[s + n] = s
        at, seg, found = border.copy(), np.arange(len(segments)), []
        while len(at):
            found.append((seg, last[at], at))
            at = back[at]
            more = at > begin[seg]
            at, seg = at[more], seg[more]
        tokens = np.zeros(len(segments), np.int64)
        for s, _, _ in found:
            tokens[s] += 1
        first = np.cumsum(tokens) - tokens
        out, end = np.zeros(int(tokens.sum()), np.int64), np.zeros(int(tokens.sum()), np.int64)
        for k, (s, p, a) in enumerate(found):
            place = first[s] + tokens[s] - 1 - k
            out[place], end[place] = p, a
        strange = np.flatnonzero(out == self.unknown)
        if len(strange):
            raw = [self.byte_id[list(chr(int(c)).encode())] for c in code[end[strange] - 1]]
            many = np.ones(len(out), np.int64)
            many[strange] = [len(x) for x in raw]
            tokens = np.add.reduceat(many, first)
            begins = np.cumsum(many) - many
            out = np.repeat(out, many)
            for i, x in zip(begins[strange].tolist(), raw):
                out[i:i + len(x)] = x
        return out, tokens

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, where each text's begin) of a batch of texts."""
        mark = MARK.encode()
        texts = [b" " + x.replace(mark, b" ") if x else x for x in texts]
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(x) for x in texts], out=bounds[1:])
        raw = b"".join(texts)
        buf = np.frombuffer(raw, np.uint8)
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        space = buf == 32
        cut = np.zeros(len(buf) + 1, bool)
        cut[bounds] = True
        cut[1:-1] |= space[1:] & ~space[:-1]
        for c in self.solo:
            own = np.flatnonzero(buf == c)
            cut[own] = True
            cut[own + 1] = True
        start = np.flatnonzero(cut[:-1])
        hashes, at, inverse = np.unique(hash_spans(buf, start), return_index=True, return_inverse=True)
        end = np.append(start[1:], len(buf))
        rows = self.lookup(hashes, lambda i: raw[start[at[i]]:end[at[i]]].decode("utf-8", "replace").replace(" ", MARK))[inverse]
        size = self.seg_size[rows]
        ids = self.seg_ids[np.arange(int(size.sum())) + np.repeat(self.seg_begin[rows] - (np.cumsum(size) - size), size)]
        run = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=run[1:])
        return ids.astype(np.int64), run[np.searchsorted(start, bounds)]

    def decode(self, ids: np.ndarray, begin: np.ndarray) -> list[bytes]:
        """Texts of id sequences laid end to end."""
        size = self.size[ids]
        at = np.arange(int(size.sum())) + np.repeat(self.begin[ids] - (np.cumsum(size) - size), size)
        raw = self.bytes_[at].tobytes()
        run = np.zeros(len(ids) + 1, np.int64)
        np.cumsum(size, out=run[1:])
        edge = run[begin]
        return [raw[a + (raw[a:a + 1] == b" "):b] for a, b in zip(edge.tolist(), edge[1:].tolist())]


def _shared(df: DataFrame, model: str):
    with open(model, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(Pieces.load(f.read()))  # a vocabulary, under 2 MB


def encode(docs: DataFrame, text_col: str = "text", out_col: str = "piece_ids", model: str = MODEL,
           check: str | None = None) -> DataFrame:
    """All columns but the text, with the text's piece ids as ``out_col``;
    ``check`` names a column that says whether decoding gives the text back."""
    shared = _shared(docs, model)
    rest = [c for c in docs.columns if c not in (text_col, out_col, check)]
    schema = T.StructType([docs.schema[c] for c in rest] + [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
                          + ([T.StructField(check, T.BooleanType())] if check else []))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.get(shared.value)
        for batch in batches:
            keep = batch.select(rest)
            for lo, hi, own in text_lists(batch.column(text_col), BATCH_BYTES):
                ids, begin = pieces.encode(own)
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(ids, pa.int32()))
                columns = [*keep.slice(lo, hi - lo).columns, lists]
                if check:
                    columns.append(pa.array([a == b for a, b in zip(pieces.decode(ids, begin), own)]))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
        pieces.clear()

    return map_batches(docs.select(*map(col, rest), col(text_col)), run, schema)


def decode(encoded: DataFrame, ids_col: str = "piece_ids", out_col: str = "text", model: str = MODEL) -> DataFrame:
    """All columns but the ids, with the decoded text as ``out_col``; null ids
    decode to the empty text, bytes that are no UTF-8 to replacement marks."""
    shared = _shared(encoded, model)
    rest = [c for c in encoded.columns if c not in (ids_col, out_col)]
    schema = T.StructType([encoded.schema[c] for c in rest] + [T.StructField(out_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.get(shared.value)
        for batch in batches:
            lists = [x.values.to_numpy(zero_copy_only=False) if x.is_valid else np.zeros(0, np.int64)
                     for x in batch.column(ids_col)]
            begin = np.zeros(len(lists) + 1, np.int64)
            np.cumsum([len(x) for x in lists], out=begin[1:])
            ids = np.concatenate(lists).astype(np.int64) if lists else np.zeros(0, np.int64)
            texts = [x.decode("utf-8", "replace") for x in pieces.decode(ids, begin)]
            yield pa.RecordBatch.from_arrays([*batch.select(rest).columns, pa.array(texts, pa.string())], names=schema.names)

    return map_batches(encoded.select(*map(col, rest), col(ids_col)), run, schema)


def encode_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """Per row: id, n_pieces, piece_ids and whether decoding gives the text back."""
    got = encode(docs.select(col(id_col), col(text_col)), text_col, "piece_ids", model, check="round_trip")
    return got.select(col(id_col), F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "round_trip")
