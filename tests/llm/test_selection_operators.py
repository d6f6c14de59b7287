"""Decontamination, collocations and resampling on awkward rows and against
plain computations."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tablewatch.llm import collocations, common, decontamination, resampling
from tests.llm.fixtures import awkward_rows, frame, text

ALNUM = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def alnum(value):
    return [w.decode() for w in ALNUM.findall(re.sub(rb"[A-Z]", lambda m: m[0].lower(), (value or "").encode()))]


def with_dots(df):
    """Extra columns whose names need quoting."""
    return df.selectExpr("*", "'x' AS `a.b`", "1 AS `rank`", "2 AS `row`", "3 AS `segment`", "4 AS `items`", "5 AS `lang.x`")


# Reading texts from Arrow buffers

@pytest.mark.parametrize("budget", [1, 40, 1 << 20])
def test_text_runs_and_words(budget):
    values = ["Ab c", None, "", "d e\tf", "x" * 90, "ünï cödé", "end", " ", "tail"]
    column = pa.array(["drop", *values])[1:]  # an offset into the buffers
    got = []
    for lo, hi, texts in common.text_runs(column, budget):
        buf, start, end, doc = common.runs_of_bytes(texts, common.ALNUM)
        words = common.spans_array(buf, start, end).to_pylist()
        assert [texts.text(i).decode() for i in range(len(texts))] == [x or "" for x in values[lo:hi]]
        got += [(lo + d, w) for d, w in zip(doc.tolist(), words)]
        assert len(set(common.hash_runs(buf, start, end).tolist())) == len(set(words))
    assert got == [(i, w) for i, v in enumerate(values) for w in alnum(v)]
    assert list(common.text_runs(pa.array([], pa.string()))) == []


# FM-index

@pytest.mark.parametrize("seed", range(4))
def test_fm_index_finds_every_place(seed):
    rng = np.random.default_rng(seed)
    parts = [rng.integers(1, 4, rng.integers(1, 60)).tolist() for _ in range(12)]
    parts += [parts[0]] * 5 + [[2] * 40] * 3  # copies and one long repeat
    symbols = np.array([x for p in parts for x in [*p, 0]], np.int64)
    marks = iter(range(-len(parts), 0))
    plain = [next(marks) if x == 0 else x for x in symbols.tolist()]
    sa = decontamination.suffix_array(symbols)
    assert sa.tolist() == sorted(range(len(plain)), key=lambda i: plain[i:])
    phrases = [rng.integers(1, 5, rng.integers(1, 9)).tolist() for _ in range(60)] + [[2] * 10, parts[0]]
    size = np.array([len(p) for p in phrases])
    index = decontamination.FMIndex(symbols, 4, sample=3)
    which, lo, hi = index.search(np.array(sum(phrases, [])), np.cumsum(size) - size, size)
    got = defaultdict(set)
    for k, a, b in zip(which.tolist(), lo.tolist(), hi.tolist()):
        got[k] = set(index.locate(np.arange(a, b)).tolist())
        assert len(got[k]) == b - a
    for k, p in enumerate(phrases):
        assert got[k] == {i for i in range(len(plain)) if plain[i:i + len(p)] == p}


# Decontamination

def brute_leaks(docs, items, window=10):
    phrases = defaultdict(set)
    for item, t in items:
        w = alnum(t)
        n = min(window, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            phrases[tuple(w[p:p + n])].add("null" if item is None else str(item))
    out = []
    for r in docs:
        w = alnum(r[1])
        hit, found = set(), set()
        for n in {len(p) for p in phrases}:
            for p in range(len(w) - n + 1):
                if tuple(w[p:p + n]) in phrases:
                    hit |= set(range(p, p + n))
                    found |= phrases[tuple(w[p:p + n])]
        out.append((r[0], len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return Counter(out)


ITEMS = [(1, text(3, 2)), (2, text(5, 3)), (10, "one"), (11, "jumps over the lazy dog"), (12, None), (13, " . "),
         (14, text(5, 3)), (None, "quick brown fox number 70"), (2, "another text under a repeated id that is long enough to count"),
         (15, "日本語 текст"), (16, " ".join(["w5", "w6", "w7"]))]


@pytest.mark.parametrize("options", [{}, {"shard": 300}, {"pass_words": 25}])
def test_leaks_awkward(spark, options):
    rows = awkward_rows() + [(90 + k, "intro " + text(5, 3) + " outro", "en", "s0") for k in range(30)]
    docs = with_dots(frame(spark, rows))
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS `x.y`").repartition(3)
    got = decontamination.report(decontamination.find_leaks(docs, items, **options))
    assert Counter(map(tuple, got.collect())) == brute_leaks(rows, ITEMS)


def test_leaks_edges(spark):
    docs, items = frame(spark, awkward_rows()), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontamination.find_leaks(docs.limit(0), items).count() == 0
    clean = decontamination.report(decontamination.find_leaks(docs, items.limit(0)))
    assert clean.filter("n_hit > 0 OR n_items > 0 OR contaminated").count() == 0
    assert {r["items_sha256"] for r in clean.collect()} == {hashlib.sha256(b"").hexdigest()}


def test_removal_leaves_the_rest(spark):
    rows = [(1, "Keep this. " + text(9, 2) + " and THIS too", "en", "s"), (2, None, "en", "s"), (3, "clean text", "en", "s")]
    docs = with_dots(frame(spark, rows))
    items = spark.createDataFrame([(1, text(9, 2))], "item_id long, text string")
    got = decontamination.remove_leaks(docs, items)
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in got.collect()} == {1: "Keep this.  . and THIS too", 2: None, 3: "clean text"}


# Collocations

def brute_grams(rows, max_words):
    f = Counter()
    for r in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                for p in range(len(w) - k + 1):
                    f["und" if r[2] is None else r[2], tuple(w[p:p + k])] += 1
    return f


def brute_phrases(rows, max_words=3, min_count=10, top=2000):
    f = brute_grams(rows, max_words)
    cand = {g: a for g, a in f.items() if len(g[1]) > 1 and a >= min_count}
    inside = defaultdict(int)
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for p in range(len(w) - k + 1):
                inside[lang, w[p:p + k]] = max(inside[lang, w[p:p + k]], a)
    ranked = defaultdict(list)
    for (lang, w), a in cand.items():
        if 100 * inside[lang, w] < 50 * a:
            score, k = min((1000000 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            ranked[lang].append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]]))
    total = Counter()
    for (lang, w), a in f.items():
        total[lang] += a * (len(w) == 1)
    return {(lang, i, p.decode(), -a, l, r, total[lang], -s)
            for lang, xs in ranked.items() for i, (s, a, p, l, r) in enumerate(sorted(xs)[:top], 1)}


def phrase_rows():
    rng = np.random.default_rng(5)
    rows = awkward_rows() + awkward_rows()[:20]
    rows += [(200 + i, ". ".join(" ".join(rng.choice(["ab", "c", "Dé", "f", "gh"], 7)) for _ in range(12)), "en", "s") for i in range(12)]
    rows += [(300 + i, "mi\tsu  hi ko yo wa na ri te no ki; a b. Zum Beispiel", None if i % 2 else "und", "s") for i in range(25)]
    return rows + [(400, "ha " * 500, "xx", "s")]


@pytest.mark.parametrize("options", [{}, {"slice_bytes": 500}, {"max_words": 2}, {"max_words": 5, "min_count": 6}, {"top": 7}])
def test_collocations_awkward(spark, options):
    rows = phrase_rows()
    docs = with_dots(frame(spark, rows).repartition(3))
    got = {tuple(r) for r in collocations.collocations(docs, **options).collect()}
    want = brute_phrases(rows, **{k: v for k, v in options.items() if k != "slice_bytes"})
    assert got == want and want


def test_collocations_empty(spark):
    docs = frame(spark, awkward_rows())
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.filter("doc_id IN (30, 31, 32)")).count() == 0


def test_flow_gives_shorter_counts(spark):
    rows = phrase_rows()
    got = {(r["lang"], tuple(r["gram"].split(" "))): r["f"] for r in
           collocations.graph(frame(spark, rows), min_count=1).filter("words > 0").collect()}
    assert got == dict(brute_grams(rows, 3))


def test_paths_are_compacted(spark):
    rows = [(i, "mi su hi ko yo wa na", "en", "s") for i in range(10)]
    heavy = collocations.graph(frame(spark, rows))
    edges = heavy.filter("words = 3").select("lang", "gram", "f")
    got = collocations.compact_paths(edges, collocations.neighbours(heavy, 2)).orderBy("place").collect()
    assert [(r["gram"], r["path"], r["place"], r["more"]) for r in got] == [
        (g, "mi su hi", k, k < 4) for k, g in enumerate(["mi su hi", "su hi ko", "hi ko yo", "ko yo wa", "yo wa na"])]


# Importance resampling

def brute_resample(rows, items):
    def features(t):
        w = alnum(t)
        return w + [f"{a} {b}" for a, b in zip(w, w[1:])]

    def bucket(f):
        return zlib.crc32(f.encode()) % 10000

    s = Counter(bucket(f) for r in rows for f in features(r[1]))
    t = Counter(bucket(f) for _, x in items for f in features(x))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in s}
    out, may = [], []
    for i, r in enumerate(rows):
        f = features(r[1])
        weight = sum(gain[bucket(x)] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if r[0] is None else r[0]}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(f), weight, score, None])
        if len(alnum(r[1])) >= 20:
            may.append((-score, r[0] is not None, r[0] or 0, i))
    for rank, x in enumerate(sorted(may)[:25 * len(may) // 100], 1):
        out[x[3]][4] = rank
    return Counter(map(tuple, out))


def resampled(docs, items, **options):
    return Counter(tuple(r) for r in resampling.resample(docs, items, **options)
                   .select("doc_id", "n_features", "weight", "score", "rank").collect())


@pytest.mark.parametrize("segments", [1, 5, 64])
def test_resampling_awkward(spark, segments):
    rows = awkward_rows() + [(500, text(2), "en", "s")] * 40 + [(None, text(4), "en", "s")] * 30  # repeated rows fill segments
    rows += [(600 + k, text(k % 7, 4), "en", "s") for k in range(60)] + [(700, "z" * 200 + " " + "y" * 70 + " " + text(1), "en", "s")]
    docs = with_dots(frame(spark, rows).repartition(4))
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert resampled(docs, items, segments=segments) == brute_resample(rows, ITEMS)


def test_resampling_edges(spark):
    docs, items = frame(spark, awkward_rows()), spark.createDataFrame(ITEMS, "item_id long, text string")
    assert resampling.resample(docs.limit(0), items).count() == 0
    assert resampled(docs, items.limit(0)) == brute_resample(awkward_rows(), [])
    few = docs.filter("doc_id IN (30, 31, 33)")  # nothing may be drawn
    assert resampling.resample(few, items).filter("rank IS NOT NULL").count() == 0


def test_resampling_string_ids_and_kept_columns(spark):
    rows = [(f"d{k}", text(k), k) for k in range(30)]
    docs = spark.createDataFrame(rows, "id string, body string, `a.b` long")
    items = spark.createDataFrame([(1, text(3))], "item_id long, text string")
    got = resampling.resample(docs, items, "id", "body", segments=4, keep=("a.b",), per_cent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 16))
    assert {(r["id"], r["a.b"]) for r in got} == {(f"d{k}", k) for k in range(30)}
    best = sorted(got, key=lambda r: (-r["score"], r["id"]))
    assert [r["rank"] for r in best[:15]] == list(range(1, 16))
