"""Search, extraction, mixing, chat windows, near-duplicates and the pipeline
on awkward rows and against plain computations."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tablewatch.llm import (chat_format, common, html_extract, minhash_dedup, mixing, quality_rules, queries,
                            sentencepiece_sa, topk_search)
from tests.llm.fixtures import awkward_rows, frame, lower, text, words

SF = "/root/testdata/sf0.01"


# Exact top-k search

def brute_topk(rows, k, every):
    ok = [(r, i, np.floor(64 * np.array(v, float)).astype(np.int64)) for r, (i, v) in enumerate(rows)
          if v and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for r, i, q in ok:
        if i is None or i % every:
            continue
        scored = []
        for r2, j, c in ok:
            if r2 != r:
                n = min(len(q), len(c))
                scored.append((-int(q[:n] @ c[:n]), (j is None, j or 0), r2, j))
        for rank, (s, _, _, j) in enumerate(sorted(scored, key=lambda x: x[:3])[:k], 1):
            out[(i, rank, j, -s)] += 1
    return out


def as_rows(df):
    return Counter((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def test_topk_awkward(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(60)]
    rows += [(100 + i, [0.5] * 6) for i in range(40)]  # ties
    rows += [(40, rows[40][1]), (40, rows[40][1])]  # repeated rows
    rows += [(200, None), (201, []), (220, [float("nan")] * 6), (240, [1.0, None, 1.0]), (260, [float("inf")]), (None, [3.0] * 6),
             (280, [1.0, 2.0]), (300, [0.0] * 6), (320, [1e4] * 6)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS score", "'x' AS rank").coalesce(1)
    assert as_rows(topk_search.search(df)) == brute_topk(rows, 20, 20)
    assert as_rows(topk_search.search(df.limit(7))) == brute_topk(rows[:7], 20, 20)  # fewer than k
    assert topk_search.search(df.limit(0)).count() == 0


def test_topk_many_blocks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(700)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(5)
    got = topk_search.search(df, k=7, every=9)
    want = brute_topk([(i, [float(np.float32(x)) for x in v]) for i, v in rows], 7, 9)
    assert as_rows(got) == want


def test_topk_sends_nothing_through_the_driver(spark, monkeypatch):
    """No join broadcasts a side, however small, in any round."""
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    seen, write = [], topk_search.write_scratch
    monkeypatch.setattr(topk_search, "write_scratch", lambda df, name: seen.append(plan(df)) or write(df, name))
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)]
    got = topk_search.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3), k=5, every=10)
    seen.append(plan(got))
    assert as_rows(got) == brute_topk(rows, 5, 10)
    assert len(seen) > 4 and sum("SortMergeJoin" in x for x in seen) >= 2
    assert not [x for x in seen if "Broadcast" in x]


def test_topk_copies_of_queries_follow_the_cores():
    """Ten times the input does not mean ten times the copies of each query block."""
    mb = 1 << 20
    assert topk_search._shards(400, 100 * mb, 6) == topk_search._shards(4000, 1000 * mb, 6) == 48
    assert topk_search._shards(5, 3 * mb, 6) == 5 and topk_search._shards(0, 0, 6) == 1
    assert topk_search._shards(100_000, 3200 * mb, 6) == 100  # what a task buffers stays bounded


def test_topk_components_of_all_sizes(spark):
    """Blocks of 1, 2, 4 and 8 bytes a component meet one another."""
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=4) * scale).tolist()) for part, scale in enumerate((0.2, 50.0, 1e4)) for i in range(part * 40, part * 40 + 40)]
    rows += [(5 * i + 1, (rng.normal(size=4) * 5e7).tolist()) for i in range(30, 70)]  # candidates only
    df = spark.createDataFrame(spark.sparkContext.parallelize(rows, 4), "vec_id long, embedding array<double>")
    assert {r["item"] for r in topk_search.blocks(df, "vec_id", "embedding").select("item").collect()} == {1, 2, 4, 8}
    assert as_rows(topk_search.search(df, k=6, every=5)) == brute_topk(rows, 6, 5)


def test_topk_many_ties_in_a_block(spark):
    """More equal scores than places, by repeated ids too, above and below others."""
    rows = [(i % 90, [1.0, 0.0]) for i in range(120)] + [(i, [2.0, 0.5]) for i in range(200, 203)] + [(i, [0.5, 1.0]) for i in range(300, 310)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    assert as_rows(topk_search.search(df, k=8, every=10)) == brute_topk(rows, 8, 10)


# Tag-path extraction

PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>Home</a></nav>
<div id="cookie-banner">We use cookies.</div><main><article><header><h1>Title &amp; more</h1><p class=byline>By A</p></header>
<p>Short.</p><p>Long text, with punctuation; and more. It goes on&nbsp;and   on.</p><ul><li>one<li>two</ul><aside>Aside</aside>
<div class="advert">Buy!</div><form>Sign <input></form><script>if(a<b){"</p>"}</script><blockquote>Quote <i>it</i>alic</blockquote>
</article><section id="comments"><p>Nice article, I liked it. Really, very much; thanks.</p></section></main><footer>(c)</footer>"""


def test_extract_page_parts():
    assert html_extract.extract(PAGE).split("\n") == [
        "Title & more", "Short.", "Long text, with punctuation; and more. It goes on and on.", "one", "two", "Quote italic"]


def test_extract_without_semantics():
    page = ("<div><a href=1>Home</a> <a href=2>News</a></div><div><h2>Head</h2><p>Text is here, and it goes on. And on.</p>"
            "<p>Ok.</p></div><div><a href=3>imprint</a></div>")
    assert html_extract.extract(page) == "Head\nText is here, and it goes on. And on.\nOk."


STORY = "<p>Long text, with punctuation; and more. It goes on and on.</p><p>More of it, as said. And so on.</p>"
READ = ["Long text, with punctuation; and more. It goes on and on.", "More of it, as said. And so on."]


@pytest.mark.parametrize("name", ["site has-sidebar", "no-sidebar", "comments-open", "social-impact"])
@pytest.mark.parametrize("box", ["<article>%s</article>", "<main>%s</main>", "<div id=story>%s</div>"])
def test_extract_wrapper_with_class_word(name, box):
    page = (f"<body><p>Skip to the content.</p><div class='{name}'>{box % STORY}<div class=sidebar><p>Read this, too.</p></div>"
            "<div id=comments><p>Nice, really.</p></div></div><p>Copyright by us.</p></body>")
    assert [x for x in html_extract.extract(page).split("\n") if x in READ] == READ
    assert "too" not in html_extract.extract(page) and "Nice" not in html_extract.extract(page)


def test_extract_story_beside_teaser_articles():
    for card in ("<article><p>A card, short.</p></article>", "<article><h2>One more</h2><p>A card, with a text; so it is long.</p></article>"):
        for page in (f"<div id=story>{STORY * 3}</div>{card}", f"<div>{card}{card}<div id=story>{STORY * 3}</div></div>"):
            assert [x for x in html_extract.extract(page).split("\n") if x in READ] == READ * 3


def test_extract_comments_longer_than_the_article():
    said = "<article><p>I say this, and this, and this; and that, too.</p></article>" * 9
    page = f"<article>{STORY}</article><div id=comments>{said}</div>"
    assert html_extract.extract(page).split("\n") == READ


@pytest.mark.parametrize("page,want", [
    ("", ""), ("plain", "plain"), ("a < b <b>x</b> <", "a < b x <"), ("<p>open <!-- c", "open"), ("<script>x", ""),
    ("<p>a&ltb &am; &#233;&#x41;", "a<b &am; éA"), ("</p></div>x", "x"), ("<p>" * 300 + "deep", "deep"),
    ("<div class=comments><p>only this</p></div>", "only this"), ("<article><h1>T</h1><p><b>T<br></article>", "T\nT")])
def test_extract_odd_html(page, want):
    assert html_extract.extract(page) == want


@pytest.mark.parametrize("page, size", [("<div>" * 100_000 + "deep text" + "</div>" * 100_000, 9),
                                        ("<div class=ad>some text. " * 50_000, 25_000 * 11 - 1),
                                        ("<ul><li>a" * 30_000, 59_999), ("<div>" * 30_000 + "</span>" * 30_000, 0),
                                        ("<div>" * 30_000 + "<option>a" * 20_000, 39_999)])
def test_extract_deep_nesting(page, size):
    # of nested marked elements, those that hold most of the text are wrappers
    assert len(html_extract.extract(page)) == size


ARTICLE = "<h1>Title</h1><p>A long paragraph, with text. And more of it, so.</p><p>A second paragraph, as well.</p>"
ARTICLE_TEXT = "Title\nA long paragraph, with text. And more of it, so.\nA second paragraph, as well."


@pytest.mark.parametrize("wrap", ["<form id=aspnetForm>%s</form>", "<div role=dialog><div>%s</div></div>",
                                  "<form><article>%s<form><label>Mail</label></form></article></form>",
                                  "<article>%s<form><p>Join us.</p><input></form></article>"])
def test_extract_form_round_the_page(wrap):
    page = "<body><nav><a href=x>Home</a></nav>" + wrap % ARTICLE + "<footer>All rights</footer></body>"
    assert html_extract.extract(page) == ARTICLE_TEXT


def test_extract_form_alone_is_no_text():
    assert html_extract.extract("<body><form><label>Name</label><input><label>Mail</label></form></body>") == ""


def test_extract_given_pages(spark):
    """The pages of the test tables hold one article each; reading it plainly
    gives the same text."""
    import html
    import re
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in queries.op4_tag_path_text(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>|<br>", " ", inner))
        want = "\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert got[r["page_id"]] == (want, len(want))


def test_extract_table(spark):
    pages = spark.createDataFrame([(1, None, "a"), (2, "", None), (2, PAGE, "b"), (2, PAGE, "b"), (3, "<p>x " * 20_000, "c")],
                                  "page_id long, html string, text string")
    got = html_extract.extract_pages(pages).collect()
    assert sorted(r["n_chars"] for r in got)[:2] == [0, 0] and len(got) == 5
    assert html_extract.extract_pages(pages.limit(0)).count() == 0


# Mixing

def test_mix_against_sql(spark):
    docs = frame(spark, awkward_rows())
    con = duckdb.connect()
    pdf = docs.select("doc_id", "text", "source").toPandas()
    pdf["doc_id"] = pdf["doc_id"].astype("Int64")
    con.register("documents", pdf)
    want = Counter(con.sql(mixing.ORACLE).fetchall())
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "copies", "taken").collect()
    assert Counter(tuple(r) for r in got) == want
    assert mixing.mix(docs.limit(0)).count() == 0


def test_mix_targets_and_rows(spark):
    rows = [(i, "w " * (1 + i % 50), "en", ["a", "b", "c", None][(i % 8) // 2 if i % 3 else 0]) for i in range(3000)]
    docs = frame(spark, rows)
    got = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").toPandas()
    assert (got.taken <= 2 * got["size"]).all()
    for _, g in got.groupby(got.source.fillna("-")):
        assert g["size"].sum() == g.source_size.iloc[0]
        assert abs(g.taken.sum() - g.target.iloc[0]) <= g["size"].max()
    assert got.groupby(got.source.fillna("-")).target.first().sum() == pytest.approx(1.5 * got["size"].sum())
    repeated = mixing.mixed_documents(docs)
    assert repeated.columns == docs.columns
    assert Counter(r["doc_id"] for r in repeated.collect()) == Counter({r.doc_id: r.copies for r in got.itertuples() if r.copies})


def test_smaller_budgets_are_subsets(spark):
    docs = frame(spark, [(i, "w " * 10, "en", f"s{i % 2}") for i in range(400)])
    small, large = ({r["doc_id"] for r in mixing.mix(docs, share=s).filter("copies > 0").collect()} for s in (0.3, 0.6))
    assert small < large


# Chat windows

def plain_digests(rows):
    turns, loss = defaultdict(list), defaultdict(list)
    for conv, turn, role, said in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        turns[conv].append(f"{role or ''}\n{said or ''}\n")
        if role == "assistant":
            loss[conv].append(said or "")
    return {c: (len(t), hashlib.sha256("".join(t).encode()).hexdigest(), len("".join(loss[c])),
                hashlib.sha256("".join(loss[c]).encode()).hexdigest()) for c, t in turns.items()}


CHAT = [(1, 0, "system", "Be kind."), (1, 1, "user", "hi " * 40), (1, 2, "assistant", "hello " * 30), (1, 3, "user", "<|im_end|>"),
        (1, 4, "assistant", "<\\|im_start|>a\\\\|"), (2, 0, "system", "alone"), (3, 0, "user", None), (3, 1, None, "x"),
        (3, 1, None, "x"), (None, 0, "assistant", "no id"), (4, None, "assistant", "no turn"), (5, 0, "we\nird<|%0A", "x\n\ny"),
        (6, 3, "system", "first by turn"), (6, 9, "assistant", "日本 😀"), (7, 0, "user", "long " * 20_000)] + \
       [(8, k, ["user", "assistant"][k % 2], f"turn {k} " * (k % 9)) for k in range(300)]


@pytest.mark.parametrize("budget,history", [(1024, 256), (120, 40), (20, 0), (1, 5)])
def test_chat_reads_back(spark, budget, history):
    turns = spark.createDataFrame([(*r, "z") for r in CHAT], "conv_id long, turn long, role string, text string, w string")
    made = chat_format.windows(turns, budget=budget, history=history)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat_format.digests(made).collect()}
    assert got == plain_digests(CHAT)
    for r in made.collect():
        assert r["tokens"] <= budget or r["over_budget"]
        turns_ = chat_format.read_back(r["formatted"])
        assert len(turns_) == r["n_repeated"] + r["n_own"] and r["n_own"] > 0
        if r["conv_id"] == 1 and r["n_repeated"]:
            assert turns_[0] == ("system", "Be kind.")


def test_chat_windows_fit_when_turns_do(spark):
    rows = [(c, k, ["user", "assistant"][k % 2], "word " * (5 + (k * 7 + c) % 20)) for c in range(20) for k in range(60)]
    made = chat_format.windows(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), budget=200, history=60).collect()
    assert not any(r["over_budget"] for r in made)
    assert max(r["n_repeated"] for r in made) >= 1


def test_chat_empty(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat_format.digests(chat_format.windows(turns)).count() == 0


# Near-duplicates

def brute_components(rows):
    sets = []
    for i, t in rows:
        w = lower(t)
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return Counter((i, len(sets[a]), least.get(find(a)), i == least.get(find(a))) for a, (i, _) in enumerate(rows))


def near_rows():
    rows = [(r[0], r[1]) for r in awkward_rows()]
    rng = np.random.default_rng(4)
    base = [f"t{k}" for k in range(120)]
    for c in range(60):  # near copies at various distances, so some are linked through others only
        w = list(base)
        for k in rng.choice(120, rng.integers(0, 9), replace=False):
            w[k] = f"x{c}_{k}"
        rows.append((100 + c, " ".join(w)))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(200 + c, passage + " " + " ".join(f"q{c}_{k}" for k in range(40 + c))) for c in range(40)]
    rows += [(300, "a b c"), (301, "A B C"), (302, "a b"), (303, "same same same same same same"), (304, "same same same same same")]
    return rows


@pytest.mark.parametrize("block,small", [(1024, 64), (4, 64), (7, 1)])
def test_near_duplicates_brute_force(spark, monkeypatch, block, small):
    monkeypatch.setattr(minhash_dedup, "BLOCK", block)
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    rows = near_rows()
    docs = frame(spark, [(*r, "en", "s") for r in rows])
    got = Counter((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash_dedup.near_duplicates(docs).collect())
    want = brute_components(rows)
    assert {(r[0], r[1], r[2]) for r in got} == {(r[0], r[1], r[2]) for r in want}
    assert minhash_dedup.near_duplicates(docs.limit(0)).count() == 0


@pytest.mark.parametrize("small", [64, 1])
def test_near_duplicates_blocks_alone_find_links(spark, monkeypatch, small):
    """Without hubs, the block comparison has to find every link."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 8)
    monkeypatch.setattr(minhash_dedup, "SMALL", small)
    rows = near_rows()
    docs = frame(spark, [(*r, "en", "s") for r in rows])
    monkeypatch.setattr(minhash_dedup, "prune", lambda pairs, *rest: pairs.limit(0))
    got = {(r["doc_id"], r["component_id"]) for r in minhash_dedup.near_duplicates(docs).collect()}
    assert got == {(r[0], r[2]) for r in brute_components(rows)}


def test_posterior_bounds():
    least = minhash_dedup.least_matches(0.75, 1e-6)
    assert len(least) == minhash_dedup.VALUES // minhash_dedup.STEP and least == sorted(least)
    rng = np.random.default_rng(0)
    same = rng.random((20_000, minhash_dedup.VALUES)) < 0.75  # pairs at the threshold stay
    kept = minhash_dedup.plausible(same.astype(np.uint32), np.ones_like(same, np.uint32), least)
    assert len(kept) > 19_990
    far = rng.random((20_000, minhash_dedup.VALUES)) < 0.2
    assert len(minhash_dedup.plausible(far.astype(np.uint32), np.ones_like(far, np.uint32), least)) == 0


def test_near_duplicate_filter(spark):
    docs = frame(spark, [(*r, "en", "s") for r in near_rows()])
    kept = minhash_dedup.filter_documents(docs)
    assert kept.columns == docs.columns
    rows = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    want = {(r[0]) for r in brute_components(near_rows()) if r[3]}
    assert {i for i, _ in rows} == want
    assert max(rows.values()) == 1  # repeated rows stay once


# Pipeline

def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "toxicity", "near-duplicates", "mixing sources to target weights", "sentencepiece"]
    good = corpus_pipeline.keep_good_quality(spark, docs, SF)
    verdict = {r["doc_id"] for r in quality_rules.judge(docs).filter("kept").collect()}
    assert {r["doc_id"] for r in good.collect()} == verdict
    clean = corpus_pipeline.drop_toxic(spark, good, SF)
    assert clean.columns == docs.columns and clean.count() <= good.count()
    rows = [(r["doc_id"], r["text"]) for r in clean.collect()]
    single = corpus_pipeline.drop_near_duplicates(spark, clean, SF)
    want = {r[0] for r in brute_components(rows) if r[3]}
    assert {r["doc_id"] for r in single.collect()} == want
    mixed = corpus_pipeline.mix_sources(spark, single, SF)
    sizes = {r["doc_id"]: len(words(r["text"])) for r in single.collect()}
    total = sum(sizes[r["doc_id"]] for r in mixed.collect())
    assert abs(total - 1.5 * sum(sizes.values())) <= 20 * max(sizes.values())
    out = corpus_pipeline.encode_pieces(spark, mixed, SF)
    assert Counter(r["doc_id"] for r in out.collect()) == Counter(r["doc_id"] for r in mixed.collect())
    assert out.filter("NOT round_trip").isEmpty()


@pytest.fixture()
def unset_batches(spark):
    spark.conf.unset(common.ARROW_SETTING)
    yield
    spark.conf.unset(common.ARROW_SETTING)


def test_workers_get_small_batches(spark, unset_batches):
    def batch_bytes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["rows", "size"])

    long = spark.range(150, numPartitions=1).selectExpr("id AS doc_id", "repeat('word ', 20000) AS text", "'en' AS lang")  # 15 MB
    for operator in (sentencepiece_sa.encode_documents, quality_rules.fertility, minhash_dedup.near_duplicates):
        spark.conf.unset(common.ARROW_SETTING)
        operator(long)  # says how its texts reach the workers
        got = long.mapInArrow(batch_bytes, "rows long, size long").collect()
        assert sum(r["rows"] for r in got) == 150
        assert max(r["size"] for r in got) <= common.ARROW_BYTES + 110_000
    spark.conf.unset(common.ARROW_SETTING)
    got = common.map_batches(long, batch_bytes, "rows long, size long").collect()
    assert sum(r["rows"] for r in got) == 150 and max(r["size"] for r in got) <= common.ARROW_BYTES + 110_000
    spark.conf.set(common.ARROW_SETTING, "1m")  # a user's own size stays
    assert max(r["size"] for r in common.map_batches(long, batch_bytes, "rows long, size long").collect()) < 1_300_000


def test_pipeline_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").filter("n_pieces = 0").isEmpty()


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_take_awkward_rows(spark, tmp_path, stage):
    spark.createDataFrame([(1, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = frame(spark, awkward_rows())
    _, f = corpus_pipeline.STAGES[stage]
    assert f(spark, docs, str(tmp_path)).count() > 0
    assert f(spark, docs.limit(0), str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", list(queries.ORACLE))
def test_query_against_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(queries.ORACLE[name])
    got = queries.QUERIES[name](spark, SF).select(*want.columns)
    assert Counter(tuple(r) for r in got.collect()) == Counter(want.fetchall())


def test_memory_goes_back_after_every_batch(monkeypatch):
    given = []
    monkeypatch.setattr(common, "give_back", lambda: given.append(len(given)))
    seen = []
    for batch in common.one_by_one(iter("abc")):
        seen.append((batch, len(given)))
    assert seen == [("a", 0), ("b", 1), ("c", 2)] and len(given) == 3


def test_slices_do_not_change_results(spark, monkeypatch):
    docs = frame(spark, awkward_rows())
    texts = [(r["text"] or "").encode() for r in docs.collect()]
    pieces = sentencepiece_sa.Pieces(*sentencepiece_sa.Pieces.load(open(sentencepiece_sa.MODEL, "rb").read()))
    ids, begin = pieces.encode(texts)
    pieces.clear()
    monkeypatch.setattr(sentencepiece_sa, "SEGMENTS", 7)
    again, first = pieces.encode(texts)
    assert (ids == again).all() and (begin == first).all()
