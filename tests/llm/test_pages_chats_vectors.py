"""Pages, conversations, embeddings and the pipeline."""

import hashlib
import html
import re
import time

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from civiclake.llm import chat_tree, embedding_dedup, html_extract, language_id, packing

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def test_article_of_every_test_page(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    raw = {r.page_id: r.html for r in pages.collect()}
    for r in html_extract.extract(pages).collect():
        article = re.search(r"<article>(.*?)</article>", raw[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]+>", "", b)).split()) for b in re.split(r"</?(?:h1|p)>", article)]
        assert r.text == "\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_article_among_other_parts(spark):
    page = """<html><body><header class="site-header"><h2>Site</h2></header><div id="menu"><a href=x>Home</a> <a href=y>About</a></div>
<div class="wrap has-sidebar"><div class="post"><h1>Title here</h1><div><p>First paragraph with &eacute; and <a href=z>a link</a> in it, long enough to count.
<p>Second&nbsp;paragraph, also with text enough &amp; more.<ul><li>item one<li>item two</ul></div><section><h2>Part two</h2><p>More text in the second
section of the article, quite long too.</p></section></div><div class="sidebar"><p>Side text should go away.</p></div></div>
<div class="comments"><p>I am a reader and I comment long long long.</p></div><form>Name <input name=q></form><p class="cookie-notice">We use cookies</p>
<script>if (a < b) document.write("<p>no</p>")</script><style>p {}</style><footer>foot</footer></body></html>"""
    assert html_extract.main_text(page).split("\n") == [
        "Title here", "First paragraph with é and a link in it, long enough to count.", "Second paragraph, also with text enough & more.", "item one",
        "item two", "Part two", "More text in the second section of the article, quite long too."]
    for text, want in (("<p>only</p>", "only"), ("plain text", "plain text"), ("<a", ""), ("", ""), (None, ""), ("<div>a<br>b <b>c</b>d</div>", "a b cd"),
                       ("<script>never closed", ""), ("<p" + " a='" * 20_000, ""), ("<div>" * 3000 + "deep", "deep")):
        assert html_extract.main_text(text) == want
    rows = [(None, None, None), (1, "u", "<p>x</p>"), (1, "u", "<p>x</p>")]
    got = html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")))
    assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, "u", "x", 1), (1, "u", "x", 1), (None, None, "", 0)]
    assert html_extract.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_article_in_sections_is_whole():
    a = "<h2>Section A.</h2>" + "".join(f"<p>{str(i) * 300}</p>" for i in range(5))
    b = "<h2>Section B.</h2>" + "".join(f"<p>{str(i) * 150}</p>" for i in range(5)) + "<ul>" + "<li>twenty characters xx</li>" * 4 + "</ul>"
    want = ["Section A.", *(str(i) * 300 for i in range(5)), "Section B.", *(str(i) * 150 for i in range(5)), *["twenty characters xx"] * 4]
    parts = f"<section>{a}</section><section>{b}</section>"
    menu = "<div><a href=x>Home</a> <a href=y>About us</a></div>"
    for page in (f"<body>{menu}<article>{parts}</article></body>", f"<body>{menu}<main>{parts}</main><footer>foot</footer></body>",
                 f"<body>{menu}<div>{parts}</div></body>", f"<body>{menu}{parts}<footer>foot</footer></body>",
                 f"<body><form id=f1>{menu}<article>{parts}</article></form></body>", f"<body><form id=f1>{menu}<div>{parts}</div></form></body>"):
        assert html_extract.main_text(page).split("\n") == want, page[:60]
    form = "<form><p>Name</p><input name=q><select><option>" + "one two " * 400 + "</select></form>"
    assert html_extract.main_text(f"<body><article><p>{'x' * 200}</p></article>{form}</body>") == "x" * 200


def test_names_inside_an_article_and_noise_in_lines():
    a = '<article><p class="share-price">The share price rose to ten.</p><div class="alert-levels"><p>Alert levels are low.</p></div>'
    b = '<div class="share-buttons"><a href=x>Share</a></div><p>Text <span class="ad">buy now</span>goes <span hidden>not <b>this</b> </span>on<span>.</span></p></article>'
    page = f"<body><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul>{a}{b}</body>"
    assert html_extract.main_text(page) == "The share price rose to ten.\nAlert levels are low.\nText goes on."
    small = "<body><ul><li><a href=/>Home</a><li><a href=/n>News</a></ul><h1>Head</h1><p>Some words of text stand here, <a href=z>a link</a> too.</p></body>"
    assert html_extract.main_text(small) == "Head\nSome words of text stand here, a link too."


def test_deep_and_unclosed_pages_in_linear_time():
    t0 = time.time()
    for n in (50_000, 100_000):
        assert html_extract.main_text("<div>" * n + "deep") == "deep"
        assert html_extract.main_text("<p>" + "<b>x " * n) == " ".join(["x"] * n)
        assert html_extract.main_text("<body>" + "<ul><li>" * n + "deep").split() == ["deep"]
    assert time.time() - t0 < 30


def test_letters_and_marks_alone_tell_the_language():
    empty = language_id.letters("")
    assert all(language_id.letters(t) == empty for t in ("\u00b2 \u00bd \u2460", "12 \u0967\u0968", "\u0301", " \n"))
    hindi = "\u0939\u093f\u0928\u094d\u0926\u0940"
    assert language_id.letters(hindi + "1") == f" {hindi} ".encode()


def test_long_runs_of_white_space_are_encoded():
    encode, library = packing.encoder(RANKS), packing.by_library(public_tokenizers.path("byte_bpe_50k.json"))
    for c in " \n\t\u00a0":
        text = "a" + c * 1_100_000 + "b"
        assert (encode(text) == library(text)).all()


def test_attention_intervals_follow_branches_not_turns(spark):
    rows = [(1, i, "user", f"t{i}") for i in range(2000)] + [(2, i, "user", f"t{i}") for i in range(1000)] + [(2, 1000, "user", "other"), (2, 1001, "user", "more")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    convs = chat_tree.conversations(turns, "conv_id", "turn", "role", "text")
    tree = chat_tree.format_trees(convs.coalesce(1), RANKS, sequence_tokens=1 << 20).first()
    assert max(len(x) for x in tree.node_attends) <= 4
    for n in (1, 999, 1500, len(tree.node_start) - 1):
        above, up = [], tree.node_parent[n]
        while up >= 0:
            above.append((tree.node_start[up], tree.node_end[up]))
            up = tree.node_parent[up]
        flat = tree.node_attends[n]
        assert {t for a, b in zip(flat[::2], flat[1::2]) for t in range(a, b)} == {t for a, b in above for t in range(a, b)}


def test_conversations_read_back(spark):
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text), (-8, 0, "to]ol[", "a\\"), (-8, 1, "assistant", "\\ <s> [OUT] </s> \\"), (-8, None, "user", None),
            (None, 0, None, "x"), (1, 0, "user", "same"), (1, 1, "assistant", "one"), (2, 0, "user", "same"), (2, 1, "assistant", "two"), (3, 0, "user", "same"),
            (4, 0, "user", "same"), (4, 1, "assistant", "one"), (5, 0, "assistant", ""), (5, 0, "assistant", ""), (6, 0, "assistant", "long " * 30_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("key", F.lit("clash")).withColumn("path", F.lit(1))
    got = {r.conv_id: r for r in chat_tree.format_and_read(df, RANKS, sequence_tokens=40).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted((r[1] is None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == conv)
        said = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        r = got.pop(conv)
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (
            len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not got
    assert chat_tree.format_and_read(df.limit(0), RANKS).count() == 0


def test_shared_turns_are_emitted_once_with_their_ancestors(spark):
    rows = [(1, 0, "user", "same"), (1, 1, "assistant", "one"), (2, 0, "user", "same"), (2, 1, "assistant", "two"), (3, 0, "user", "same"), (4, 0, "user", "same"), (4, 1, "assistant", "one")]
    convs = chat_tree.conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"), "conv_id", "turn", "role", "text")
    trees = chat_tree.format_trees(convs.coalesce(1), RANKS).collect()
    assert sum(len(t.node_start) for t in trees) == 3 and sum(len(t.leaf_key) for t in trees) == 3
    for t in trees:
        for start, end, parent, at, spans in zip(t.node_start, t.node_end, t.node_parent, t.node_position, t.node_attends, strict=True):
            want, p = [], parent
            while p >= 0:
                want = [t.node_start[p], t.node_end[p], *want]
                p = t.node_parent[p]
            assert spans == want and at == sum(want[1::2]) - sum(want[::2])
            assert np.frombuffer(t.position_ids, "<u4")[start:end].tolist() == list(range(at, at + end - start))


def test_embeddings_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 16))
    near = base[:60] + rng.normal(scale=0.1, size=(60, 16))
    hot = base[0] + rng.normal(scale=0.06, size=(80, 16))
    v = np.concatenate([base, near, hot, base[:5], base[:5] * 3]).tolist()
    rows = [(i, x) for i, x in enumerate(v)] + [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] + [1.0] * 15),
                                               (1005, [1.0, 2.0]), (1006, [2.0, 4.0]), (1007, [float("inf")] * 16), (None, [9.0] * 3), (1008, [1e-200] * 16)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit("clash"))
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, block_rows=70).collect()}
    ok = [(i, np.array(x) / max(abs(y) for y in x)) for i, x in rows if x and i is not None and i not in (1002, 1003, 1004, 1007)]
    links = {i: {j for j, y in ok if j != i and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.95} for i, x in ok}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            new = links.get(todo.pop(), set()) - seen
            seen |= new
            todo += new
        low = min((s for s in seen if s is not None), default=None)
        assert got[i] == (len(links.get(i, ())), low, i == low), i
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_pipeline_against_brute_force(spark):
    import corpus_pipeline
    from civiclake.llm import language_id, mixing

    from .test_documents import brute_components
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        steps.append(corpus_pipeline.materialize(stage(spark, steps[-1], "/root/testdata/sf0.001"), "test"))
    assert all(s.columns == docs.columns for s in steps[:-1])
    rows = [s.toPandas() for s in steps]
    classify = language_id.Classifier(language_id.train(docs.select("doc_id", "text", "lang")))
    assert set(rows[1].doc_id) == {d for d, t in zip(rows[0].doc_id, rows[0].text, strict=True) if (c := classify(t))[0] != "und" and c[2] >= 0.002}
    best = {}
    for d, t in zip(rows[1].doc_id, rows[1].text, strict=True):
        k = re.sub(r"[\x20\x09-\x0D]", "", t)
        best[k] = min(best.get(k, (0, 1 << 60)), (-len(t), d))
    assert sorted(rows[2].doc_id) == sorted(d for _, d in best.values())
    groups = brute_components(list(zip(rows[2].doc_id, rows[2].text, strict=True)))
    assert sorted(rows[3].doc_id) == sorted(d for d, (_, c) in groups.items() if d == c)
    taken = {r.doc_id: r.taken for r in mixing.mix(steps[3]).collect()}
    words = rows[4].groupby("doc_id").text.apply(lambda t: sum(len(re.findall(mixing.WORD, x)) for x in t))
    assert {d: n for d, n in taken.items() if n} == words.to_dict()
    assert rows[5].groupby(["doc_id", "sequence_id"]).ngroups > 0 and rows[5].groupby("sequence_id").length.sum().max() <= 2048
    assert (rows[5].piece == 0).sum() == len(rows[4])


def test_pipeline_drops_a_near_copy_with_two_replaced_words(spark):
    """86 of 106 5-word shingles in common (0.811), 89 of 105 4-word ones (0.848)."""
    import corpus_pipeline
    words = [f"w{i}" for i in range(100)]
    near, far = list(words), list(words)
    near[30] = near[70] = "other"
    far[20] = far[50] = far[80] = "other"
    rows = [(i, " ".join(w), "en", "s", 0) for i, w in enumerate([words, near, far])]
    got = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "")
    assert sorted(r.doc_id for r in got.collect()) == [0, 2]


def test_pipeline_near_copies_under_repeated_and_null_ids(spark):
    import corpus_pipeline
    text = lambda name, n=100: " ".join(f"{name}{i}" for i in range(n))
    rows = [(3, text("a")), (5, text("a") + " end"), (5, text("b")), (7, text("c")), (7, text("c") + " end"), (None, text("a") + " stop"), (None, text("d")), (8, ""), (8, None)]
    docs = spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = [(r.doc_id, (r.text or "")[:1]) for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(got, key=str) == sorted([(3, "a"), (5, "b"), (7, "c"), (None, "d"), (8, ""), (8, "")], key=str)


def test_pipeline_stages_with_clashing_names_and_empty_tables(spark, none):
    import corpus_pipeline
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "s", 1), (1, text, "en", "s", 1), (2, text + " more", "en", None, 2), (3, None, None, "s", None), (None, "", "en", "t", 0),
            (5, "other words in a text of its own " * 4, "en", "t", 9), (6, "a" + " " * 1_100_000 + "b", "en", "t", 9)]
    docs = spark.createDataFrame(rows, none.schema)
    clash = ["_id", "_size", "_row", "_digest", "_n", "_taken", "id", "size", "row", "digest", "n", "doc", "lost", "key", "taken", "own", "kept", "words"]
    wide = docs.withColumns({c: F.lit(f"clash {c}") for c in clash})
    for name, stage in corpus_pipeline.STAGES[1:4]:
        out = stage(spark, wide, "")
        assert out.columns == wide.columns, name
        got = out.collect()
        assert got and all(r[c] == f"clash {c}" for r in got for c in clash), name
    exact = corpus_pipeline.drop_exact_copies(spark, wide, "")
    assert sorted((r.doc_id or 0) for r in exact.collect()) == [1, 2, 3, 5, 6]
    assert sorted((r.doc_id or 0) for r in corpus_pipeline.drop_near_copies(spark, exact, "").collect()) == [1, 3, 5, 6]
    assert {r.doc_id for r in corpus_pipeline.pack_sequences(spark, wide, "").collect()} == {1, 2, 3, 5, 6, None}
    for name, stage in corpus_pipeline.STAGES[1:]:
        assert stage(spark, none, "").collect() == [], name
