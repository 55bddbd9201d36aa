"""Classifiers, language profiles, page text and transcripts."""

import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from nextbest.llm import chat_hmm, html_ttr, langid_rank, model_queries, quality_gam, toxicity_cnn
from nextbest.llm.chat_query import op10_chat_format
from nextbest.llm.common import fold
from tests.conftest import SF_MID, SF_SMALL

ODD = [(1, None, None), (2, "", "en"), (None, "some words", "en"), (3, "w " * 60000, "en"),
       (4, "12 !!", None), (4, "12 !!", None)]
DOCS = "doc_id long, text string, lang string"


def _held_out_accuracy(spark, got, label):
    labels = spark.read.parquet(f"{SF_MID}/labels.parquet")
    rows = got.where("held_out").join(labels, "doc_id").collect()
    return rows, sum(r.predicted == r[label] for r in rows) / len(rows)


# ---------------------------------------------------------------------- quality

def test_quality_on_the_held_out_fold(spark):
    got = model_queries.op1_quality_classifier(spark, SF_MID)
    rows, accuracy = _held_out_accuracy(spark, got, "quality")
    assert accuracy >= 0.95 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
    assert got.count() == spark.read.parquet(f"{SF_MID}/documents.parquet").count()


def test_additive_model_learns_an_interaction_and_scores_by_lookup():
    rng = np.random.default_rng(0)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    alone = quality_gam.AdditiveModel(pairs=0).fit(x, y)
    paired = quality_gam.AdditiveModel().fit(x, y)
    right = lambda m: ((m.score(x) > 0.5) == y).mean()
    assert right(alone) < 0.7 < 0.9 < right(paired)
    row = paired.base + sum(t[np.searchsorted(e, v, side="left")] for t, e, v in
                            zip(paired.tables, paired.edges, x[0]))
    row += sum(t[np.searchsorted(paired.coarse[a], x[0, a]), np.searchsorted(paired.coarse[b], x[0, b])]
               for a, b, t in paired.pair_tables)
    assert paired.score(x[:1])[0] == pytest.approx(1 / (1 + np.exp(-row)))


@pytest.mark.parametrize("label_rows", [[], [(1, 1, 1), (2, None, None), (3, 1, 0), (4, 0, 1)]])
def test_classifiers_on_odd_rows(spark, label_rows):
    docs = spark.createDataFrame(ODD, DOCS)
    labels = spark.createDataFrame(label_rows, "doc_id long, quality int, toxic int")
    for score in (quality_gam.score_quality, toxicity_cnn.score_toxicity):
        got = score(docs, labels).collect()
        assert sorted(str(r.doc_id) for r in got) == ["1", "2", "3", "4", "4", "None"]
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
        assert score(docs.limit(0), labels).collect() == []


def test_label_text_and_id_are_no_inputs(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    held = labels.where(fold(F.col("doc_id"), 5) == 0).select(
        "doc_id", (1 - F.col("quality")).alias("quality"), "toxic")
    other = labels.where(fold(F.col("doc_id"), 5) != 0).unionByName(held)
    scores = lambda y: {r.doc_id: r.score for r in
                        quality_gam.score_quality(docs, y).collect()}
    assert scores(labels) == scores(other)


# --------------------------------------------------------------------- toxicity

def test_toxicity_learns_words_of_each_language():
    rng = random.Random(4)
    base = {"xx": [f"a{i}" for i in range(300)], "yy": [f"b{i}" for i in range(300)]}
    bad = {"xx": ["vile", "nasty"], "yy": ["schlimm", "boese"]}
    memory, rows = toxicity_cnn._Hashes(), []
    for n in range(600):
        lang = rng.choice(["xx", "yy"])
        w, toxic = rng.choices(base[lang], k=80), rng.random() < 0.3
        for _ in range(3 if toxic else 0):
            w[rng.randrange(80)] = rng.choice(bad[lang])
        rows.append((toxicity_cnn.word_hashes(" ".join(w), memory), toxic, lang))
    model = toxicity_cnn.TextCNN(bits=14).fit(
        [r[0] for r in rows[:450]], np.array([r[1] for r in rows[:450]]),
        [r[2] for r in rows[:450]], np.arange(450) % 4 == 0)
    right = sum((model.score(h) >= 0.5) == t for h, t, _ in rows[450:])
    assert right >= 140
    assert [model.languages[model._language(model.buckets(h))] for h, _, _ in rows[:20]] == [
        r[2] for r in rows[:20]]


def test_pooling_in_pieces_equals_pooling_at_once(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, 2 ** 63, n).astype(np.uint64) for n in (0, 1, 2, 40, 500)]
    labels = np.array([0, 1, 0, 1, 0])
    model = toxicity_cnn.TextCNN(bits=10, min_docs=1, epochs=1).fit(
        texts, labels, ["a"] * 5, np.zeros(5, dtype=bool))
    whole = [model.score(t) for t in texts]
    monkeypatch.setattr(toxicity_cnn, "_CHUNK", 3)
    assert [model.score(t) for t in texts] == pytest.approx(whole, rel=1e-5)


def test_toxicity_on_the_held_out_fold(spark):
    rows, accuracy = _held_out_accuracy(spark, model_queries.op2_toxicity(spark, SF_MID), "toxic")
    assert accuracy >= 0.9


# ---------------------------------------------------------------------- language

def plain_grams(text):
    out = Counter()
    word = ""
    for ch in text.lower() + " ":
        if ch.isalpha():
            word += ch
        elif word:
            padded = f"\0{word}\0"
            out.update(c for c in word)
            out.update(padded[i:i + 2] for i in range(len(padded) - 1))
            out.update(padded[i:i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def _code(gram):
    n = 0
    for ch in gram:
        n = n << 21 | (1 if ch == "\0" else ord(ch) + 1)
    return n


@pytest.mark.parametrize("text", ["a", "Hello, wörld! hello", "ab12cd  é中文 x" * 9, "word " * 30])
def test_grams_equal_a_plain_count(text, monkeypatch):
    want = sorted((_code(g), n) for g, n in plain_grams(text).items())
    assert list(zip(*(x.tolist() for x in langid_rank.gram_counts(text)))) == want
    monkeypatch.setattr(langid_rank, "_PIECE", 7)
    assert list(zip(*(x.tolist() for x in langid_rank.gram_counts(text)))) == want


def test_distance_is_out_of_place():
    top = lambda t: langid_rank.top_grams(*langid_rank.gram_counts(t), 300).tolist()
    profiles = {"x": top("the cat and the dog"), "y": top("der hund und die katze")}
    doc = top("the hund")
    want = {}
    for name, profile in profiles.items():
        away = sum(abs(i - profile.index(g)) if g in profile else 300 for i, g in enumerate(doc))
        want[name] = 1 - away / (300 * len(doc))
    name, score = langid_rank.Profiles(profiles).predict("the hund")
    assert name == max(want, key=want.get)
    assert score == pytest.approx(max(want.values()) / sum(want.values()))


def test_language_of_odd_rows_and_of_the_held_out_fold(spark):
    got = langid_rank.language_id(spark.createDataFrame(ODD, DOCS)).collect()
    by = {str(r.doc_id): (r.lang_pred, r.score) for r in got}
    assert len(got) == 6 and by["1"] == by["2"] == by["4"] == ("und", 0.0)
    assert langid_rank.language_id(spark.createDataFrame([], DOCS)).collect() == []
    nothing = spark.createDataFrame([(1, "words", None)], DOCS)
    assert [r.lang_pred for r in langid_rank.language_id(nothing).collect()] == ["und"]
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    rows = model_queries.op5_language_id(spark, SF_MID).join(docs, "doc_id").collect()
    for held in (True, False):
        some = [r for r in rows if r.held_out == held]
        assert sum(r.lang == r.lang_pred for r in some) / len(some) >= 0.98


# ------------------------------------------------------------------------- pages

FURNITURE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>x</p>";
</script></head><body><header class="site-header"><h1>Site</h1></header><nav><ul><li><a href=/>Home</a>
</ul></nav><div id="cookie-notice"><p>We use cookies</p></div><div class="wrap">"""
ARTICLE = """<article class="post"><header><h1>T&eacute;st &amp; more</h1></header>
<p>One  <b>two</b>three<br>four &lt;x&gt; &#8364;</p><p>Ok.<ul><li>a<li>b</ul>
<aside>Buy</aside><div class="advert-box">ad ad</div><p>end <form><input><label>q</label></form>
<!-- no --><blockquote>quote</blockquote><table><tr><td>1<td>2</table></article>"""
REST = f"""</div><div class="sideBar"><p>{'side text ' * 200}</p></div><section id="comments">
<article class="comment"><p>{'nice one ' * 300}</p></article></section><footer><p>f</p></footer>
</body></html>"""


def test_main_text_leaves_furniture_out():
    want = "Tést & more\nOne twothree four <x> €\nOk.\na\nb\nend\nquote\n1\n2"
    assert html_ttr.main_text(FURNITURE + ARTICLE + REST) == want
    assert html_ttr.main_text(FURNITURE + ARTICLE + REST.replace("</footer>", "")) == want


@pytest.mark.parametrize("html,want", [
    (None, ""), ("", ""), ("<p></p>", ""), ("plain  text", "plain text"),
    ("<p>a</p><p>b", "a\nb"), ("</div></p>x", "x"), ("<div><div><p>deep</div>tail", "deep\ntail"),
    ("<script>if (a<b) x()</script>after", "after"), ("<p>a<span>b</span>c</p>", "abc"),
    ("<nav>menu</nav>", ""), ("&lt;p&gt; &am &amp", "<p> &am &"),
    ("<p>" + "long " * 50000 + "</p>", ("long " * 50000).strip())])
def test_odd_pages(html, want):
    assert html_ttr.main_text(html) == want


def test_clusters_and_smoothing():
    ratios = np.array([1.0, 2, 1, 80, 90, 3, 85, 1, 2])
    smoothed = html_ttr.smooth(ratios)
    assert len(smoothed) == len(ratios) and smoothed[5] > 20
    assert html_ttr.dense(ratios).tolist() == [False] * 3 + [True] * 2 + [False, True] + [False] * 2


def test_pages_query_returns_articles(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    got = model_queries.op6_html_extraction(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        inside = pages[r.page_id].split("<article>")[1].split("</article>")[0]
        from html import unescape
        import re
        blocks = (re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]*>", "", b))).strip()
                  for b in re.split(r"</?(?:p|h1)>", inside))
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


# ------------------------------------------------------------------- transcripts

def plain_viterbi(model, emits):
    score, backs = model.start + emits[0], []
    for e in emits[1:]:
        ways = score[:, None] + model.step
        backs.append(ways.argmax(axis=0))
        score = ways.max(axis=0) + e
    path = [int(score.argmax())]
    for b in reversed(backs):
        path.append(int(b[path[-1]]))
    return path[::-1]


def test_blocks_give_the_path_of_one_pass():
    rng = np.random.default_rng(3)
    counts = {("step", a, b): int(rng.integers(0, 50)) for a in chat_hmm.ROLES for b in chat_hmm.ROLES}
    model = chat_hmm.RoleModel(counts)
    for n in (1, 2, 7, 40):
        emits = np.log(rng.random((n, 3)))
        parts = [emits[i:i + 3] for i in range(0, n, 3)]
        ends = chat_hmm.borders([chat_hmm.block_matrix(model, p, i == 0)
                                 for i, p in enumerate(parts)])
        got = [r for i, (p, (a, b)) in enumerate(zip(parts, ends))
               for r in chat_hmm.trace(model, p, a, b, i == 0)]
        assert got == plain_viterbi(model, emits)


def test_markers():
    assert chat_hmm.split_marker("User: hi") == ("user", "hi")
    assert chat_hmm.split_marker("### Response:\nOk") == ("assistant", "Ok")
    assert chat_hmm.split_marker("<|system|>\nBe kind") == ("system", "Be kind")
    assert chat_hmm.split_marker("**Assistant:** yes") == ("assistant", "yes")
    assert chat_hmm.split_marker("A plain line: no") == ("none", "A plain line: no")
    assert chat_hmm.split_marker("Note: no") == ("none", "Note: no")


def test_odd_transcripts(spark):
    schema = "conv_id long, turn long, role string, text string, block string"
    rows = [(1, 0, "user", "User: hi", "b"), (1, 1, "assistant", None, "b"), (1, 0, "user", "User: hi", "b"),
            (None, None, None, "", None), (2, 5, "robot", "AI: " + "x " * 30000, "b"), (2, 5, None, "Q: y?", "b")]
    docs = spark.createDataFrame(rows, schema)
    got = chat_hmm.format_chats(docs).collect()
    assert len(got) == 5
    roles = {(r.conv_id, r.turn, r.marker): r.role_pred for r in got}
    assert roles[1, 0, "user"] == "user" and roles[2, 5, "assistant"] == "assistant"
    assert next(r.rendered for r in got if r.conv_id == 1 and r.turn == 0) == "<|user|>\nhi\n<|end|>\n"
    assert chat_hmm.format_chats(docs.limit(0)).collect() == []


def test_a_long_conversation_is_decoded_in_blocks(spark, monkeypatch):
    rows = [(1, i, ["user", "assistant"][i % 2], ("User: q" if i == 0 else f"line {i}"))
            for i in range(700)]
    train = [(c, i, ["user", "assistant"][i % 2], "User: q" if i == 0 else f"line {i}")
             for c in range(2, 6) for i in range(8)]
    df = spark.createDataFrame(rows + train, "conv_id long, turn long, role string, text string")
    got = chat_hmm.format_chats(df, train=F.col("conv") > 1).where("conv_id = 1").collect()
    assert len(got) == 700 and all(r.role == r.role_pred for r in got)


def test_roles_of_the_held_out_fold(spark):
    rows = op10_chat_format(spark, SF_MID).collect()
    held = [r for r in rows if r.held_out]
    assert sum(r.role == r.role_pred for r in held) / len(held) >= 0.95
    silent = [r for r in held if r.marker == "none"]
    assert sum(r.role == r.role_pred for r in silent) / len(silent) >= 0.85


def test_a_transcript_in_one_text_is_cut_into_turns(spark, monkeypatch):
    text = "User: a\nmore a\nAssistant: b\n\n### Instruction:\nc\nUser: d\nNote: e\n**AI:** f"
    want = [("user", "a\nmore a"), ("assistant", "b"), ("user", "c\nd\nNote: e"), ("assistant", "f")]
    schema = "conv_id long, turn long, role string, text string"
    whole = [(1, 0, None, text)]
    for block in (256, 2):
        monkeypatch.setattr(chat_hmm, "BLOCK", block)
        got = chat_hmm.format_chats(spark.createDataFrame(whole, schema)).orderBy("seq").collect()
        assert [r.seq for r in got] == [1, 2, 3, 4]
        assert [r.rendered for r in got] == [f"<|{r}|>\n{b}\n<|end|>\n" for r, b in want]
    marked = [(3, 0, None, "User: a"), (3, 1, None, "Human: b"), (3, 2, None, "AI: c")]
    got = chat_hmm.format_chats(spark.createDataFrame(marked, schema)).orderBy("seq").collect()
    assert [r.rendered for r in got] == ["<|user|>\na\nb\n<|end|>\n", "<|assistant|>\nc\n<|end|>\n"]


def test_turns_of_whole_transcripts_are_those_of_the_table(spark):
    got = {(r.conv_id, r.seq): (r.role_pred, r.rendered)
           for r in op10_chat_format(spark, SF_SMALL).where("marker != 'none'").collect()}
    rows = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").orderBy("conv_id", "turn").collect()
    seq, want = Counter(), {}
    for r in rows:
        seq[r.conv_id] += 1
        want[r.conv_id, seq[r.conv_id]] = (r.role, f"<|{r.role}|>\n{r.text.strip()}\n<|end|>\n")
    assert got and sum(want[k] == v for k, v in got.items()) >= 0.98 * len(got)


def test_rows_without_conversation_or_turn_fill_no_block(spark, monkeypatch):
    monkeypatch.setattr(chat_hmm, "BLOCK", 8)
    rows = [(None, i % 3, None, f"User: n{i}") for i in range(60)] + [
        (7, None, None, f"{'User' if i % 2 else 'AI'}: {i:03}") for i in range(100)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = chat_hmm.lines(df, "conv_id", "turn", "text", "role")
    assert max(r[0] for r in found.groupBy("key", "block").count().select("count").collect()) <= 8
    got = chat_hmm.format_chats(df).collect()
    lost = [r.rendered for r in got if r.conv_id is None]
    assert sorted(lost) == sorted(f"<|user|>\nn{i}\n<|end|>\n" for i in range(60))
    kept = "".join(r.rendered for r in got if r.conv_id == 7)
    assert all(f"{i:03}" in kept for i in range(100))


def test_repeats_without_a_place_are_kept(spark):
    rows = [(1, 0, None, "User: hi")] * 2 + [(2, None, None, "User: ok")] * 3 + [
        (None, 0, None, "User: hi")] * 4
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_hmm.format_chats(df).collect()
    body = {c: [r.rendered for r in got if r.conv_id == c] for c in (1, 2, None)}
    assert body[1] == ["<|user|>\nhi\n<|end|>\n"] and body[2] == ["<|user|>\nok\nok\nok\n<|end|>\n"]
    assert body[None] == ["<|user|>\nhi\n<|end|>\n"] * 4


@pytest.mark.parametrize("html,want", [
    ('<article><h2 id="related-work">Related</h2><p>text one</p><section id="discussion"><p>we discuss'
     '</p></section><p class="notice">note</p></article>', "Related\ntext one\nwe discuss\nnote"),
    ('<div class="content-sidebar-wrap"><article><p>text</p></article></div>', "text"),
    ('<div class="has-sidebar"><p>text</p></div>', "text"),
    ('<div class="post social-science"><article><p>text</p></article></div>', "text"),
    ('<div class="sidebar"><main><p>text</p></main></div>', "text"),
    ('<div class="overlay"><p>' + "long text " * 50 + '</p></div><div class="menu">m</div>',
     ("long text " * 50).strip()),
    ('<article><p>some code <span class="comment">kept</span> here</p><div class="ad-box">buy</div>'
     '<div class="related"><a href="/x">one more</a> <a href="/y">two</a></div></article>',
     "some code kept here")])
def test_names_of_furniture_inside_articles(html, want):
    assert html_ttr.main_text(html) == want


MENU = "".join(f'<a href="/{i}">page number {i}</a><br>' for i in range(9))


@pytest.mark.parametrize("html,want", [
    ("<div><p>" + "x" * 900 + "</p></div><div><p>" + "y" * 100 + "</p></div>",
     "x" * 900 + "\n" + "y" * 100),
    ("<div><p>" + "x" * 900 + "</p></div><div>" + "<p>yes</p><li>no" * 200 + "</div>",
     "x" * 900 + "\nyes\nno" * 200),
    ("<article><p>" + "x" * 900 + "</p></article><article><p>small</p></article>",
     "x" * 900 + "\nsmall"),
    (f"<body><div>{MENU}</div><div><div><h1>T</h1><p>{'text ' * 20}</p></div><div>more</div></div>"
     "</body>", "T\n" + ("text " * 20).strip() + "\nmore"),
    ('<ul><li><a href="/a">one</a><li><a href="/b">two</a></ul><div>text</div><div>end</div>',
     "text\nend"),
    (f'<h1>T</h1><p>text with <a href="/">a link</a> and many more words</p><div>{MENU}</div>', None)])
def test_regions_keep_what_is_no_link_list(html, want):
    got = html_ttr.main_text(html)
    assert got == want if want else got.startswith("T\ntext with a link and many")


PROSE = "This is a long paragraph of prose that goes on for a while and says a good deal. " * 3
STORY = f"<article><h1>T</h1><p>{PROSE}</p><p>One</p></article>"
SAID = f"T\n{PROSE.strip()}\nOne"


@pytest.mark.parametrize("html,want", [
    (f"<body><form>{STORY}</form></body>", SAID),
    (f"<body><nav><a href=x>Home</a><a href=y>News</a>{STORY}</body>", SAID),
    (f"<body><div role=form>{STORY}</div><form>Your name <input></form></body>", SAID),
    (f"<body><form><h2>T</h2><p>{PROSE}</p><p>One</p><input></form></body>", SAID),
    (f"{STORY}<!-- <p>never ends</p>", SAID), (f"{STORY}<div class='x", SAID),
    (f"<script>let a = '<!--';</script>{STORY}", SAID), (f"<!-->{STORY}", SAID),
    ("<article><p>Let <math><mi>x</mi><annotation>x</annotation></math> be.</p></article>", "Let x be."),
])
def test_nothing_swallows_an_article(html, want):
    assert html_ttr.main_text(html) == want


@pytest.mark.parametrize("given", ['class="user-comments"', 'class="reader-comments"', 'id="commentlist"',
                                   'class="post-comments"', 'id="respond"', 'class="gdpr"',
                                   'class="cookie-policy-popup"'])
def test_compound_names_need_evidence(given):
    body = f"<div class=content><p>{PROSE}</p><p>{PROSE}</p></div>"
    notes = "".join(f'<div class=c><span class="author">A{i}</span><p>I liked it a lot.</p></div>'
                    for i in range(2)) if "comment" in given else "<p>We use them.</p><button>OK</button>"
    plain = f"{PROSE.strip()}\n{PROSE.strip()}"
    assert html_ttr.main_text(f"<body>{body}<div {given}>{notes}</div></body>") == plain
    kept = html_ttr.main_text(f"<body>{body}<div class=comment-culture><p>{PROSE}</p></div></body>")
    assert kept == f"{plain}\n{PROSE.strip()}"


PLAIN_MENU = "".join(f"<p>{w}</p>" for w in "News Sport Weather Culture Money Travel".split())
NO_ARTICLE = f"<body><div>{PLAIN_MENU}</div><div>{f'<p>{PROSE}</p>' * 5}</div></body>"


def test_ratios_choose_the_region_of_a_page_without_article(monkeypatch):
    want = "\n".join([PROSE.strip()] * 5)
    assert html_ttr.main_text(NO_ARTICLE) == want
    # a line beside the dense ones is lifted by its neighbours, and stays
    ended_so = NO_ARTICLE.replace("</body>", "<div><p>The end of it.</p></div></body>")
    assert html_ttr.main_text(ended_so) == f"{want}\nThe end of it."
    with monkeypatch.context() as m:
        m.setattr(html_ttr, "smooth", lambda ratios, sigma=1.0: ratios)
        assert html_ttr.main_text(ended_so) == want
    with monkeypatch.context() as m:
        m.setattr(html_ttr, "threshold", lambda ratios: -1.0)
        assert html_ttr.main_text(NO_ARTICLE).startswith("News\nSport")


@pytest.mark.parametrize("html", [
    "<span class=x>" * 50_000 + "t", "<div class=x>" * 50_000 + "t", "<p>t</p>" + "<!-- a <!" * 20_000,
    "<b>" * 50_000 + "<div>t" + "</b>" * 50_000 + "<ul>" * 50_000,
    "<div class=menu><article>" * 20_000 + "t", "<ul><li>" * 50_000 + "t" + "</i></li>" * 30_000])
def test_work_grows_with_the_length(html):
    started = time.process_time()
    assert html_ttr.main_text(html).strip("\n") in ("t", "")
    assert time.process_time() - started < 20


def test_a_training_id_with_several_texts_is_no_matter_of_order(spark):
    """Operators 1 and 2 pick the same row whatever the partitions."""
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source")
    twice = docs.unionByName(docs.withColumn("text", F.reverse("text")))
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    for score in (quality_gam.score_quality, toxicity_cnn.score_toxicity):
        a, b = (sorted(map(str, score(df, labels).collect()))
                for df in (twice, twice.repartition(7, "text")))
        assert a == b


def test_training_words_are_bounded(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    few = toxicity_cnn.score_toxicity(docs, labels, max_total_words=5000)
    assert few.count() == docs.count()


def test_a_label_inside_a_message_is_text(spark):
    rows = [(1, 0, None, "User: Count.\nAssistant: Steps:\nAnswer: 42\nUser: q\nHuman: more")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_hmm.format_chats(df).orderBy("seq").collect()
    assert [r.rendered for r in got] == [f"<|{r}|>\n{b}\n<|end|>\n" for r, b in (
        ("user", "Count."), ("assistant", "Steps:\nAnswer: 42"), ("user", "q\nmore"))]


def test_spans_give_the_path_of_one_pass():
    rng = np.random.default_rng(4)
    model = chat_hmm.RoleModel({("step", a, b): int(rng.integers(0, 50))
                                for a in chat_hmm.ROLES for b in chat_hmm.ROLES})
    for n in (1, 5, 13, 60):
        emits = np.log(rng.random((n, 3)))
        parts = [emits[i:i + 2] for i in range(0, n, 2)]
        blocks = [chat_hmm.block_matrix(model, p, i == 0) for i, p in enumerate(parts)]
        spans = [blocks[i:i + 3] for i in range(0, len(blocks), 3)]
        fixed = chat_hmm.borders([chat_hmm.product(s) for s in spans])
        ends = [e for s, (a, b) in zip(spans, fixed) for e in chat_hmm.borders(s, a, b)]
        got = [r for i, (p, (a, b)) in enumerate(zip(parts, ends))
               for r in chat_hmm.trace(model, p, a, b, i == 0)]
        assert got == plain_viterbi(model, emits)


def test_small_spans_give_the_same_turns(spark, monkeypatch):
    rows = [(c, i, None, f"{'User: ' if i % 5 == 0 else 'AI: ' if i % 5 == 2 else ''}line {i} of {c}")
            for c in (1, None, 3) for i in range(60)]
    df = spark.createDataFrame(rows, "conv_id int, turn long, role string, text string")

    def done():
        return sorted(map(str, chat_hmm.format_chats(df).collect()))

    want = done()
    monkeypatch.setattr(chat_hmm, "BLOCK", 4)
    monkeypatch.setattr(chat_hmm, "SPAN", 3)
    assert done() == want
