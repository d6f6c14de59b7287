"""Quality rules, classifiers, pieces and the language model on awkward rows
and against plain computations."""

import gc
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import sentencepiece

from tablewatch.llm import bloom_lm, gam_quality, quality_rules, sentencepiece_sa, toxicity
from tests.llm.fixtures import awkward_rows, frame, lower, text, words

SF = "/root/testdata/sf0.01"


def base_columns(value):
    w = words(value)
    raw = value or ""
    grams = Counter(zip(w, w[1:], w[2:]))
    covered = {k + d for k, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for d in range(3)}
    lines = [x for x in raw.split("\n") if words(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return (len(w), sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", raw)), len(lines) - len(set(lines)),
            len(covered), failed)


@pytest.mark.parametrize("source", ["awkward", "given"])
def test_quality_base_columns(spark, source):
    docs = frame(spark, awkward_rows()) if source == "awkward" else spark.read.parquet(f"{SF}/documents.parquet")
    want = Counter((r["doc_id"], *base_columns(r["text"])) for r in docs.collect())
    got = quality_rules.judge(docs).collect()
    assert want == Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
                            r["base_failed"]) for r in got)
    assert all(not r["kept"] for r in got if r["base_failed"])


def test_quality_fertility_matches_library(spark):
    """Characters per token as the vocabularies themselves encode the words."""
    import base64
    import tiktoken
    with open(f"{quality_rules.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("x", pat_str=quality_rules.BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{quality_rules.TOKENIZERS}/piece_bpe_32k.model")
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in quality_rules.judge(docs).collect():
        w = [x.decode() for x in words(texts[r["doc_id"]])]
        ids = [i for x in w for i in enc.encode_ordinary(" " + x)]
        pieces = [i for x in w for i in sp.encode(x)]
        n = Counter(ids)
        assert r["n_tokens"] == len(ids)
        assert r["chars_per_piece"] == pytest.approx(sum(map(len, w)) / max(1, len(pieces)))
        assert r["fallback_share"] == pytest.approx(sum(map(sp.is_byte, pieces)) / max(1, len(pieces)))
        h = -sum(c / len(ids) * math.log2(c / len(ids)) for c in n.values())
        assert r["entropy"] == pytest.approx(h / math.log2(max(2, len(ids))), abs=1e-9)


def test_quality_rejects_junk_and_keeps_clean(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality_rules.judge(docs).join(labels, "doc_id").filter("NOT base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.99
    assert got[got.quality == 0].kept.mean() < 0.1


def test_quality_filter_keeps_columns_and_empty_table(spark):
    docs = frame(spark, awkward_rows())
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns
    good = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in kept.collect()} == good and good
    assert quality_rules.judge(docs.limit(0)).count() == 0
    assert quality_rules.filter_documents(docs.limit(0)).count() == 0


def test_fences_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(8)
    rows = [(f"{'en' if k % 3 else 'de'}", int(60 + k % 900), *[float(x) for x in rng.normal(size=5)], k % 17 == 0) for k in range(4000)]
    df = spark.createDataFrame(rows, ["__group", "n_words", *quality_rules.METRICS, "base_failed"])
    got = [sorted(map(str, quality_rules.bands(df.repartition(n)).collect())) for n in (2, 9, 40)]
    assert got[0] == got[1] == got[2] and len(got[0]) > 4
    plain = np.sort([r[2] for r in rows if not r[7]])
    q1, q3 = (plain[max(1, math.ceil(p * len(plain))) - 1] for p in (0.25, 0.75))
    whole = quality_rules.bands(df).filter("__level = 3").first()
    assert whole["__lo_chars_per_token"] == q1 - (q3 - q1) * 7.0


def test_long_words_are_encoded_whole():
    import base64

    import tiktoken
    with open(f"{quality_rules.TOKENIZERS}/byte_bpe_50k.tiktoken", "rb") as f:
        ranks = f.read()
    with open(f"{quality_rules.TOKENIZERS}/piece_bpe_32k.model", "rb") as f:
        model = f.read()
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
    plain = tiktoken.Encoding("own", pat_str=quality_rules.BYTE_PATTERN, mergeable_ranks=table, special_tokens={})
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    vocab = quality_rules.Vocabularies(ranks, model)
    for word in ("漢字かなカナ" * 90, "abcdefgh" * 70, "ünïcödé" * 60):
        got = quality_rules.measure([word.encode()], vocab)
        ids = pieces.encode(word)
        assert got["n_tokens"][0] == len(plain.encode_ordinary(" " + word))
        assert got["chars_per_piece"][0] == pytest.approx(len(word) / len(ids))
        assert got["fallback_share"][0] == pytest.approx(sum(pieces.is_byte(i) for i in ids) / len(ids))



def test_gam_tables_add_up():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0.3) ^ (x[:, 1] > 0)).astype(float)  # needs the pair
    model = gam_quality.fit(x[:2000], y[:2000], n_pairs=2)
    score = model.score(x[2000:])
    assert ((score > 0.5) == y[2000:]).mean() > 0.9
    assert (0, 1) in [tuple(sorted(p)) for p in model.pairs]
    b = model.bins(x[2000:2010])
    for i, z in enumerate(b):  # row by row
        total = model.intercept + sum(t[z[f]] for f, t in enumerate(model.tables))
        total += sum(t[model.coarse[p][z[p]], model.coarse[q][z[q]]] for (p, q), t in zip(model.pairs, model.pair_tables))
        assert 1 / (1 + math.exp(-total)) == pytest.approx(score[i])


def held_out_accuracy(got, labels, label):
    m = got.join(labels, "doc_id").filter("held_out").toPandas()
    rank, n1 = m.score.rank(), m[label].sum()
    auc = (rank[m[label] == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * (len(m) - n1))
    return auc, m


def test_gam_held_out(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = gam_quality.classify(docs, labels)
    auc, m = held_out_accuracy(got, labels, "quality")
    assert auc > 0.95
    assert {r["doc_id"] for r in got.filter("held_out").collect()} == \
        {r["doc_id"] for r in docs.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1}


@pytest.mark.parametrize("module,label", [(gam_quality, "quality"), (toxicity, "toxic")])
def test_classifiers_on_awkward_rows(spark, module, label):
    docs = frame(spark, awkward_rows())
    for marks in ([(1, 1), (2, 0), (3, None), (4, 1), (6, 0), (7, 1), (8, 0)], [(1, 1)], []):
        labels = spark.createDataFrame([(i, v) for i, v in marks], f"doc_id long, {label} int")
        got = module.classify(docs, labels, label).collect()
        assert len(got) == docs.count()
        assert all(0 <= r["score"] <= 1 for r in got)
    assert module.classify(docs.limit(0), labels, label).count() == 0


def test_classifiers_ignore_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    flipped = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - quality, quality) AS quality", "toxic")
    a = {r["doc_id"]: r["score"] for r in gam_quality.classify(docs, labels).collect()}
    b = {r["doc_id"]: r["score"] for r in gam_quality.classify(docs, flipped).collect()}
    assert a == b


def test_toxicity_finds_planted_and_disguised_insults(spark):
    rows = []
    for i in range(240):
        base = text(i, 6)
        bad = i % 4 == 0
        insult = ["zorgblat", "zorgblatting", "mufflewit"][i % 3]
        rows.append((i, base.replace("lazy", insult) if bad else base, "en", "s"))
    labels = spark.createDataFrame([(r[0], int(r[0] % 4 == 0)) for r in rows], "doc_id long, toxic int")
    extra = [(900, text(901, 6).replace("lazy", "zorg-blat"), "en", "s"), (901, text(902, 6).replace("lazy", "z o r g b l a t"), "en", "s"),
             (902, text(903, 6).replace("lazy", "ZORGBL4T"), "en", "s"), (903, text(904, 6), "en", "s"), (904, None, None, None)]
    got = {r["doc_id"]: r["predicted"] for r in toxicity.classify(frame(spark, rows + extra), labels).collect()}
    assert all(got[r[0]] == (r[0] % 4 == 0) for r in rows)
    assert (got[900], got[901], got[902], got[903], got[904]) == (1, 1, 1, 0, 0)


def test_toxicity_finds_insults_across_word_borders(spark):
    """Phrases of words that clean texts hold as often, and insults cut in pieces."""
    rng = np.random.default_rng(11)
    usual = ("the of a to go back under your stone table river quickly seven yellow house morning garden letter music paper summer "
             "bridge window market silver doctor number people little great nothing between carry follow market winter open").split()

    def table(put):
        rows, marks = [], []
        for i in range(600):
            w = [str(x) for x in rng.choice(usual, 60)]
            k = int(rng.integers(0, 55))
            w[k:k] = put(i) if i % 4 == 0 else []
            rows.append((i, " ".join(w), "en", "s"))
            marks.append((i, int(i % 4 == 0)))
        return rows, marks

    for put in (lambda i: "go back under your stone".split(), lambda i: ["worthless"]):
        rows, marks = table(put)
        labels = spark.createDataFrame(marks, "doc_id long, toxic int")
        split = [(900 + k, f"the morning garden {cut} of music paper seven", "en", "s")
                 for k, cut in enumerate(["wor th less", "w orthless", "worth less", "winter table"])]
        got = {r["doc_id"]: r["predicted"] for r in toxicity.classify(frame(spark, rows + split), labels).collect()}
        assert sum(got[i] == y for i, y in marks) >= 590
    assert [got[900 + k] for k in range(4)] == [1, 1, 1, 0]


def test_toxicity_spans_are_scored_as_defined():
    """Sums over the letters equal the spans scored one by one."""
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.normal(size=1 << toxicity.TABLE_BITS).astype(np.float32), 0.25)
    texts = [b"Wor-th less 1diot, a b " + b"longword" * 9 + b" end", b"", b"... !", "Ünd Ärger x".encode(), b"one"]
    out = toxicity.evidence(texts, model)
    for row, raw in zip(out, texts):
        ws = [w for w in (toxicity.normal(x)[1:] for x in raw.lower().split()) if w]
        best = [max(model.spans([b"".join(ws[i:i + n])])[0] for n in (1, 2, 3) if i + n <= len(ws)) for i in range(len(ws))]
        best = sorted(best + [toxicity.NOTHING] * 3, reverse=True)[:3]
        assert row[:3] == pytest.approx(np.maximum(best, toxicity.NOTHING), abs=1e-4)


def test_toxicity_kernel_against_definition():
    """Hashed, vectorised kernel values against subsequences counted one by one."""
    def features(w):
        out = Counter()
        for shape in toxicity._SHAPES:
            for i in range(len(w) - shape[-1]):
                out[(len(shape), bytes(w[i + k] for k in shape))] += toxicity.DECAY ** (shape[-1] + 1 - len(shape))
        return out

    def norm(w):
        return math.sqrt(sum(toxicity.DECAY ** (2 * (s[-1] + 1 - len(s))) for s in toxicity._SHAPES for _ in range(max(0, len(w) - s[-1]))))

    ws = [b" idiot", b" idiiot", b" scum", b" lazy", b" quickly"]
    k = toxicity.kernel(ws, ws)
    for i, a in enumerate(ws):
        for j, b in enumerate(ws):
            fa, fb = features(a), features(b)
            assert k[i, j] == pytest.approx(sum(v * fb[x] for x, v in fa.items()) / norm(a) / norm(b), abs=1e-5)


def test_toxicity_filter_keeps_clean_rows(spark):
    docs = frame(spark, awkward_rows())
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.filter_documents(docs, labels).count() == docs.count()


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=sentencepiece_sa.MODEL)


def test_pieces_equal_the_library(spark, library):
    for docs in (frame(spark, awkward_rows()), spark.read.parquet(f"{SF}/documents.parquet")):
        texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
        got = sentencepiece_sa.encode(docs.select("doc_id", "text"), check="same").collect()
        want = Counter((i, tuple(library.encode(t or ""))) for i, t in texts)
        assert want == Counter((r["doc_id"], tuple(r["piece_ids"])) for r in got)
        assert all(r["same"] for r in got if r["doc_id"] != 38)  # 38 holds a literal space mark


def test_pieces_decode_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    back = sentencepiece_sa.decode(sentencepiece_sa.encode(docs)).select("doc_id", "text")
    assert {tuple(r) for r in back.collect()} == {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert sentencepiece_sa.encode_documents(docs.limit(0)).count() == 0


def test_pieces_follow_exactly_when_bpe_keeps_them_apart(library):
    pieces = sentencepiece_sa.Pieces.get(sentencepiece_sa.Pieces.load(open(sentencepiece_sa.MODEL, "rb").read()))
    rng = np.random.default_rng(5)
    ids = np.array([i for _, i in pieces.usable if 300 < i < 6000])
    a, b = rng.choice(ids, 3000), rng.choice(ids, 3000)
    got = pieces.can_follow(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), got.tolist()):
        joined = library.id_to_piece(x) + library.id_to_piece(y)
        if joined.startswith("▁") and "▁" not in joined[1:]:
            assert ok == (library.encode(joined[1:]) == [x, y]), joined


def test_language_model_base_and_totals(spark):
    docs = frame(spark, awkward_rows())
    for part in (64 << 20, 20_000):  # one part; many parts
        check_language_model(docs, bloom_lm.score_documents(docs, part_bytes=part).collect())
    assert bloom_lm.score_documents(docs.limit(0)).count() == 0


def test_language_model_rare_words_by_join(spark, monkeypatch):
    monkeypatch.setattr(bloom_lm, "HEAD_WORDS", 50)
    docs = frame(spark, awkward_rows())
    check_language_model(docs, bloom_lm.score_documents(docs).collect())


def check_language_model(docs, got):
    counts, rows = Counter(), []
    for r in docs.collect():
        tokens = lower(r["text"]) + [b"\n"]
        key = "" if r["doc_id"] is None else str(r["doc_id"])
        rows.append((r["doc_id"], tokens))
        if zlib.crc32(key.encode()) % 7 != 2:
            counts.update(tokens)
    total, distinct = sum(counts.values()), len(counts)
    want = Counter()
    for i, tokens in rows:
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        want[(i, len(tokens), sum(counts[t] > 0 for t in tokens), total, round(base, 4))] += 1
    assert want == Counter((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in got)
    assert all(r["score"] <= 0 and math.isfinite(r["score"]) for r in got)


def pair_model(docs):
    """Exact pair counts, kinds and quantised masses of the training rows."""
    words, pairs = Counter(), Counter()
    for r in docs:
        if zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 7 != 2:
            tokens = lower(r["text"]) + [b"\n"]
            words.update(tokens)
            pairs.update(zip([None] + tokens[:-1], tokens))
    kinds, mass = Counter(), Counter()
    for (v, _), c in pairs.items():
        kinds[v] += 1
        mass[v] += rounded(c, bloom_lm.LEVELS, bloom_lm.MIDDLE)
    return words, pairs, kinds, mass


def rounded(c, levels, middle):
    return middle[np.searchsorted(levels, c, side="right") - 1] if c else 0.0


def fine(c):
    return rounded(math.floor(c + 0.5), bloom_lm.FINE, bloom_lm.FINE_MIDDLE)


def test_language_model_score_against_plain_counts(spark):
    docs = frame(spark, awkward_rows()).unionByName(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), allowMissingColumns=True)
    rows = docs.collect()
    words, pairs, kinds, mass = pair_model(rows)
    total = sum(words.values()) + len(words) + 1
    want = []
    for r in rows:
        tokens, s = lower(r["text"]) + [b"\n"], 0.0
        for v, w in zip([None] + tokens[:-1], tokens):
            uni = (words[w] + 1) / total
            if v not in kinds:
                s += math.log10(uni)
                continue
            m = fine(2 * mass[v]) / 2
            k = min(fine(kinds[v]), m)
            seen = max(min(rounded(pairs[v, w], bloom_lm.LEVELS, bloom_lm.MIDDLE), m - k + 1) - bloom_lm.DISCOUNT, 0)
            s += math.log10((seen + bloom_lm.DISCOUNT * k * uni) / m)
        want.append((str(r["doc_id"]), len(tokens), s))
    # At 100 bits an element the filter hardly errs; two parts at least.
    got = [(str(r["doc_id"]), r["n_tokens"], r["score"]) for r in
           bloom_lm.score_documents(docs.select("doc_id", "text"), part_bytes=200_000, bits_per_element=100).collect()]
    off = [(a, b) for a, b in zip(sorted(want), sorted(got)) if a[:2] != b[:2] or abs(a[2] - b[2]) > 1e-6 * abs(a[2]) + 1e-9]
    assert len(want) == len(got) and len(off) <= 0.02 * len(want), off[:5]
    assert all(a[:2] == b[:2] and abs(a[2] - b[2]) < 0.01 * abs(a[2]) + 1 for a, b in off)


def test_language_model_probabilities_add_up(spark):
    words, _, kinds, mass = pair_model(spark.read.parquet(f"{SF}/documents.parquet").collect())
    unseen = sum(c + 1 for c in words.values()) / (sum(words.values()) + len(words) + 1)
    sums = []
    for v in kinds:
        m = fine(2 * mass[v]) / 2
        sums.append((mass[v] - bloom_lm.DISCOUNT * kinds[v] + bloom_lm.DISCOUNT * min(fine(kinds[v]), m) * unseen) / m)
    assert 0.93 < min(sums) and max(sums) < 1.07
    assert abs(np.mean(sums) - 1) < 0.01


def test_language_model_predicts_held_out_better_than_words(spark):
    got = bloom_lm.score_documents(spark.read.parquet(f"{SF}/documents.parquet")).toPandas()
    held = got[got.held_out]
    assert held.score.sum() > held.base_score.sum()


def test_bloom_counts_come_back():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
    counts = np.minimum(rng.zipf(1.5, 50_000), 10**9)
    n = 4
    raw, sizes = [], []
    for b in range(n):
        own = keys % np.uint64(n) == b
        raw.append(bloom_lm.make_piece(keys[own], counts[own])[1])
        sizes.append(len(raw[-1]))
    out = np.zeros(len(keys))
    bloom_lm.Part(0, n, np.array(sizes), b"".join(raw)).counts(keys, out)
    level = np.searchsorted(bloom_lm.LEVELS, counts, side="right")
    exact = np.isclose(out, bloom_lm.MIDDLE[level - 1])
    assert (out >= bloom_lm.MIDDLE[level - 1] * 0.999).all()  # never too low
    assert exact.mean() > 0.95
    other = rng.integers(0, 2**63, 50_000, dtype=np.uint64)
    out = np.zeros(len(other))
    bloom_lm.Part(0, n, np.array(sizes), b"".join(raw)).counts(other, out)
    assert (out > 0).mean() < 0.04


def test_toxicity_weighs_each_run_of_letters_once():
    r = np.random.default_rng(2)
    model = toxicity.Model(r.normal(0, 1, 1 << toxicity.TABLE_BITS).astype(np.float32), -0.5)
    letters = toxicity.Letters([b"some plain words here " * 40, b"words of a text", b"", "straße".encode()])
    weight, which, head, words = model.starts(letters)
    assert len(which) == len(letters.codes) and len(words) == len(letters.doc)
    assert weight.shape[1] < 60 and head.shape[1] < 20
    whole = model.worst(letters, 0, len(letters.doc))
    assert np.array_equal(whole[40:90], model.worst(letters, 40, 90, model.starts(letters)))
    alone = toxicity.Letters([b"words of a text"])
    assert np.allclose(model.worst(alone, 0, 4), whole[160:164])


def test_toxicity_scoring_leaves_no_cycles():
    """Arrays in a cycle stay until Python looks for cycles, which it seldom
    does for few large objects: workers grew by hundreds of MB."""
    model = toxicity.Model(np.ones(1 << toxicity.TABLE_BITS, np.float32), 0.25)
    gc.collect()
    gc.disable()
    try:
        toxicity.evidence([b"plain words of a text " * 20, b"s p e l l e d"], model)
        assert gc.collect() == 0
        toxicity.kernel([b" one", b" other"], [b" one"])
        assert gc.collect() == 0
    finally:
        gc.enable()
