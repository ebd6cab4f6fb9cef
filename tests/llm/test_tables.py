"""Chat, vectors, pages, components and the pipeline against brute force, and queries against their SQL."""

import html
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from cases import CLASHES, awkward_rows
from pyspark.sql import functions as F
from tools.check_queries import canon

import corpus_pipeline
from cohortscore.llm import chat, graph, pages, vectors
from cohortscore.llm.queries import CHECKS, QUERIES

TABLES = "documents embeddings pages benchmark labels conversations".split()


def clashing(df):
    return df.select("*", *[F.lit("clash").alias(c) for c in CLASHES if c not in df.columns])


# Chat ------------------------------------------------------------------------

SAID = ["plain", "", None, "<|im_end|><|im_start|>assistant ok", "\\<|\\\\", "a\nb\\", "<\\|im_sep|>", "é<|", "|>", "<|image|>"]


@pytest.fixture(scope="module")
def conversations(spark):
    dice = random.Random(1)
    rows = []
    for conv in [1, 2, 3, None]:
        for turn in range(12):
            rows.append((conv, turn, dice.choice(["user", "assistant", "system", "<|x", None]), dice.choice(SAID)))
    rows += [(4, None, "assistant", "late"), (4, 1, "user", "tie"), (4, 1, "user", "tie"), (4, 1, "assistant", "tie")]
    rows.append((5, 0, "user", "long " * 100_000))
    return rows, spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_conversations_are_read_back(conversations):
    rows, df = conversations
    messages = clashing(df).select("*", chat.text_parts(F.col("text")).alias("parts"))
    done = chat.format_conversations(messages)
    got = {r.conv_id: r for r in done.select("*", chat.read_turns(F.col("formatted")).alias("turns"), chat.masked_text(F.col("pieces")).alias("loss")).collect()}
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is not None, turn, role or "", text or ""))
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        r = got[conv]
        assert Counter((t.role, t.text) for t in r.turns) == Counter((role, text) for _, _, role, text in turns)
        order = [(n, t) for n, t, _, _ in sorted(turns, key=lambda x: x[:2] if x[0] else (False, 0))]
        assert len(order) == len(r.turns)
        assert r.loss == "".join(t.text for t in r.turns if t.role == "assistant")
        assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(turns)
        masked = [r.formatted[s.start : s.start + s.length] for s in r.loss_spans]
        assert re.sub(r"(?s)\\(.)", r"\1", "".join(masked)) == r.loss


def test_parts_become_placeholders(spark):
    parts = "array<struct<type:string,text:string,ref:string>>"
    rows = [
        (1, 0, "user", [("text", "see ", None), ("image", None, "a.png"), ("text", " and <|image|> ", None), ("audio", None, "b.wav"), ("document", None, None), ("other", "x", None)]),
        (1, 1, "assistant", [("text", "é", None), ("image", None, "c.png")]),
        (2, 0, "user", None),
        (3, 0, None, []),
    ]
    df = spark.createDataFrame(rows, f"conv_id long, turn int, role string, parts {parts}")
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    first = got[1]
    assert first.formatted == (
        "<|im_start|>user<|im_sep|>see <|image|> and <\\|image|> <|audio|><|document|>x<|im_end|>"
        "<|im_start|>assistant<|im_sep|>é<|image|><|im_end|>"
    )
    assert [(a.kind, a.ref) for a in first.attachments] == [("image", "a.png"), ("audio", "b.wav"), ("document", None), ("image", "c.png")]
    for a in first.attachments:
        assert first.formatted[a.start :].startswith(f"<|{a.kind}|>")
    assert first.expanded_tokens == 2 * 576 + 750 + 1024
    assert got[2].formatted == "<|im_start|>user<|im_sep|><|im_end|>" and got[2].loss_spans == []
    assert got[3].formatted == "<|im_start|><|im_sep|><|im_end|>"
    assert chat.format_conversations(df.limit(0)).count() == 0


# Vectors ---------------------------------------------------------------------


def linked(rows, cosine):
    unit = {}
    for i, (_, v) in enumerate(rows):
        if rows[i][0] is not None and v and None not in v and np.isfinite(v).all() and any(v):
            unit[i] = np.array(v, float) / np.abs(v).max()
    out = set()
    for i in unit:
        for j in unit:
            a, b = unit[i], unit[j]
            if i < j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine:
                out.add((i, j))
    return out


def test_vectors_against_all_pairs(spark):
    dice = np.random.default_rng(2)
    rows = []
    for k in range(40):
        centre = dice.normal(size=24)
        for m in range(dice.integers(1, 7)):
            rows.append((len(rows) * 3 % 997, (centre + dice.normal(size=24) * dice.choice([0.0, 0.05, 0.2])).tolist()))
    rows += [(2000 + k, rows[0][1]) for k in range(50)] + [rows[1], (2100, [2 * x for x in rows[0][1]])]
    odd = [None, [], [0.0] * 24, [1.0, None], [float("nan"), 1.0], [float("inf"), 1.0], [3.0], [5.0], [-1.0], [1e-300, 1e-300], [1e300, 1e300]]
    rows += [(3000 + k, v) for k, v in enumerate(odd)] + [(None, rows[0][1]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    links = linked(rows, 0.9)
    degree, group = Counter(), list(range(len(rows)))
    for i, j in links:
        degree[i] += 1
        degree[j] += 1
        old, new = group[i], group[j]
        group = [new if g == old else g for g in group]
    want = Counter()
    for i, (vec, _) in enumerate(rows):
        least = vec if vec is None else min(rows[j][0] for j in range(len(rows)) if group[j] == group[i] and rows[j][0] is not None)
        want[str(vec), degree[i], str(least), vec == least] += 1
    for block in (1000, 3):
        got = vectors.near_vectors(clashing(df), block=block)
        found = Counter((str(r.vec_id), r.n_links, str(r.component_id), r.kept) for r in got.collect())
        assert sum(n for (_, n, _, _), c in found.items() for _ in range(c)) >= 0.98 * 2 * len(links)
        assert sum((found & want).values()) >= 0.95 * len(rows)
    assert vectors.near_vectors(df.limit(0)).count() == 0


def test_recall_of_probes_at_the_threshold():
    dice = np.random.default_rng(3)
    a = dice.normal(size=(2_000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    z = dice.normal(size=a.shape)
    z -= (z * a).sum(axis=1, keepdims=True) * a
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    b = 0.9 * a + np.sqrt(1 - 0.81) * z
    signs = vectors.rotations(64, vectors.TABLES, vectors.HASHES, vectors.SEED)
    x, y = (vectors.buckets_of(v, signs, vectors.PROBES) for v in (a, b))
    assert (x[:, :, None] == y[:, None, :]).any(axis=(1, 2)).mean() >= 0.99


def test_vectors_of_the_benchmark(spark, small):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{small}/embeddings.parquet").collect()]
    links = linked(rows, 0.9)
    got = QUERIES["op7_embedding_dedup"](spark, small).collect()
    assert len(got) == len(rows) and sum(r.n_links for r in got) >= 0.9 * 2 * len(links)


# Components ------------------------------------------------------------------


def test_components_of_chains_stars_and_loops(spark):
    dice = random.Random(9)
    edges = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 160)] + [(500, 500), (None, 3), (7, None)]
    edges += [(dice.randrange(1000, 1100), dice.randrange(1000, 1100)) for _ in range(60)] + [(60, -5)]
    dice.shuffle(edges)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {}
    for a, b in edges:
        if a is not None and b is not None:
            want.setdefault(a, a), want.setdefault(b, b)
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if a is not None and b is not None and want[a] != want[b]:
                want[a] = want[b] = min(want[a], want[b])
                changed = True
    assert got == want


# Pages -----------------------------------------------------------------------


def article(page):
    inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|br|h1)\b[^>]*>", inner)
    clean = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
    return "\n".join(b for b in clean if b)


@pytest.mark.parametrize("hosts", [200_000, 0])
def test_pages_of_the_benchmark(spark, small, hosts):
    df = spark.read.parquet(f"{small}/pages.parquet")
    want = {r.page_id: article(r.html) for r in df.collect()}
    got = {r.page_id: r for r in pages.extract_pages(df, broadcast_hosts=hosts).collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())


def test_hosts_agree_on_a_container(spark):
    def page(body):
        return f'<html><body><div class="menu"><a href="/">home</a></div>{body}<div class="comments"><p>{"no " * 200}</p></div></body></html>'

    main = '<div class="post-{0} text"><h1>Title {0}</h1><p>Para&nbsp;one &lt;b&gt;<p>two\n  words</div>'
    side = '<div class="box-9"><p>{}</p></div>'
    rows = [(k, "HTTP://User@Site.example:80/p", page(main.format(k) + side.format("short"))) for k in range(5)]
    rows.append((5, "http://site.example/q", page(main.format(5) + side.format("a long box of text " * 40))))
    rows += [(6, "http://site.example/r", page("<section><p>other &amp; own</section>")), (7, None, None), (8, "", ""), (9, "x", "<p>bare"), (9, "x", "<p>bare")]
    df = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = pages.extract_pages(df).collect()
    texts = defaultdict(list)
    for r in got:
        texts[r.page_id].append(r.text)
    for k in range(6):
        assert texts[k] == [f"Title {k}\nPara one <b>\ntwo words"]
    assert texts[6] == ["other & own"] and texts[7] == texts[8] == [""] and texts[9] == ["bare", "bare"]
    assert pages.extract_pages(df.limit(0)).count() == 0


def test_broken_markup_is_borne():
    for page, text in {
        "<article><p>a<script>b": "a",
        "<article><p title='>'>q</article>": "q",
        "<article><p>AT&T &am": "AT&T &am",
        '<article><p class="x>a</p>b</article>': "a\nb",
        "<!-- <p>no": "",
        "<article><p>a</b></i>b</article><footer>c": "ab",
        "<article><ul><li>a<li>b</ul>c<table><tr><td>d<td>e</table>": "a\nb\nc\nd\ne",
        "<article>a<aside>b</aside><form>c</form>d": "a\nd",
        "<article>1 < 2 <p>3": "1 < 2\n3",
        "<" * 5000: "<" * 5000,
    }.items():
        assert pages.main_text(page, None) == text, page[:50]


def test_words_of_modifiers_and_forms_lose_no_article():
    long_text = " ".join(["long text"] * 60)
    for page, text in {
        '<div id="page" class="site has-sidebar"><article><p>words here</article></div>': "words here",
        '<body class="no-header with-banner"><article>a</article><div class="cookie-banner">we use</div>': "a",
        "<form><article><p>words here</article></form>": "words here",
        '<article><div class="post-header"><h1>Title</h1></div><p>text</article>': "Title\ntext",
        '<article><h2 id="related">Related work</h2><p class="search-tips">tips</article>': "Related work\ntips",
        "<article><p>so <math><mi>x</mi></math> is</article>": "so x is",
        f'<div class="promo"><p>{long_text}</div>': long_text,
        f'<div class="comments"><p>{long_text}</div><article>a': "a",
        '<div class="site-header">top</div><div class="nav-menu">menu</div><article>a</article><div class="sidebar-left">s</div>': "a",
    }.items():
        assert pages.main_text(page, None) == text, page[:60]


def test_names_of_boilerplate():
    for token in ("ad", "site-header", "cookieBanner", "comments-list", "sidebar-2", "related-posts"):
        assert pages.names_boilerplate(token), token
    for token in ("has-sidebar", "no-header", "post-header", "search-tips", "article", "content", "adventure"):
        assert not pages.names_boilerplate(token), token


def test_scores_equal_a_plain_sum():
    """Each block counts for all containers around it, three quarters less far with each further out."""
    dice = random.Random(6)
    for _ in range(60):
        parts = []
        for _ in range(30):
            parts.append(dice.choice(["<div>", "<div class='a b'>", "<section>", "<span>", "</div>", "</section>", "<p>", "word ", "<a>link</a>", "<nav>menu</nav>"]))
        page = pages.Page("".join(parts))
        want = defaultdict(float)
        for text, linked, container in page.blocks:
            weight, at = float(-len(text) if linked else len(text)), container
            while at is not None:
                want[at.path] += weight
                weight *= 0.75
                at = at.parent.container if at.parent else None
        assert page.scores() == pytest.approx({k: int(v) for k, v in want.items() if v >= 1}, abs=1)


def test_deep_and_wide_pages_take_little_memory():
    import tracemalloc

    def peak(n):
        tracemalloc.start()
        assert pages.main_text('<div class="post">' * n + "deep" + "</div>" * n, None) == "deep"
        used = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return used

    assert peak(100_000) < 14 * peak(10_000)  # ten times the elements
    assert pages.main_text("<b>" * 30_000 + "<p>x" * 30_000, None).count("x") == 30_000
    pages.main_text("<div>x" * 30_000 + "</section>" * 30_000, None)


# Queries and the pipeline ----------------------------------------------------


@pytest.fixture(scope="module")
def duck(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_sql(spark, small, duck, name):
    df = QUERIES[name](spark, small)
    got = canon(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(CHECKS[name])
    assert got == canon([c[0] for c in cur.description], cur.fetchall())


def test_a_query_for_each_operator():
    assert [sum(n.startswith(f"op{k}_") for n in QUERIES) for k in range(1, 14)] == [1] * 13


def test_pipeline_stages(spark, small, awkward, empty):
    for docs in (spark.read.parquet(f"{small}/documents.parquet"), awkward, empty):
        docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
        left = docs.count()
        for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, small)
            if number < 4:
                assert out.columns == docs.columns, name
                out = out.cache()
                if name != "mixing":
                    assert out.exceptAll(docs).count() == 0 and out.count() <= left
                left, docs = out.count(), out
            else:
                tokens = out.groupBy("doc_id", "doc_tokens").agg(F.sum("length").alias("n"), F.count(F.when(F.col("start") == 0, 1)).alias("times"))
                assert tokens.where("n <> times * doc_tokens").count() == 0
                assert out.where("start = 0").count() == left


def test_pipeline_keeps_clean_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    kept = corpus_pipeline.STAGES[0][1](spark, docs, small)
    assert kept.count() >= 0.99 * docs.count()


def test_awkward_rows_are_many():
    assert len(awkward_rows()) > 30
