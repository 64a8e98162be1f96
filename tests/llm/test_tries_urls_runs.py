"""The conversation trie, URL rules and periodic runs, against brute force."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from civiclake.llm import conversation_trie, periodic_runs, queries, url_rules

TURNS = "conv_id long, turn long, role string, text string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute_trie(seqs):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved, ends)} of (id, turns) pairs."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in seqs:
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        own = (len(members[p]) - 1) * len(words(p[-1][1])) if p else 0
        below = [out[k] for k in kids[p]]
        out[p] = (min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), sum(b[3] for b in below) if below else 1,
                  own + sum(b[4] for b in below), hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
    return sorted(((min(members[p]), len(p), *v) for p, v in out.items()), key=str)


def trie_rows(df):
    return sorted(((r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in df.collect()), key=str)


@pytest.mark.parametrize("cells, partitions", [(1 << 20, 1), (1, 1), (7, 3), (40, 7), (3, 16)])
def test_trie_of_random_conversations(spark, cells, partitions):
    rng = random.Random(cells * 31 + partitions)
    seqs, rows = [], []
    for conv in rng.sample(range(-50, 10_000), 120):
        turns = [(rng.choice(["user", "", "x"]), rng.choice(["a b", "a", "", "c  d\ne"])) for _ in range(rng.choice([0, 1, 1, 2, 3, 5]))]
        if rng.random() < 0.3 and seqs:
            turns = list(seqs[-1][1])
        if rng.random() < 0.1:
            turns = turns + turns
        seqs.append((conv, turns))
        rows += [(conv, i, r, t) for i, (r, t) in enumerate(turns)]
    found = conversation_trie.sequences(spark.createDataFrame(rows, TURNS).withColumn("path", F.lit("clash")).withColumn("words", F.lit("clash")))
    none = spark.createDataFrame([(c,) for c, t in seqs if not t], "conv_id long").select("conv_id", F.expr("cast('' as binary)").alias("path"), F.expr("cast(array() as array<int>)").alias("words"))
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = trie_rows(conversation_trie.prefix_trie(found.unionByName(none), batch_cells=cells))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == brute_trie(seqs)


def test_trie_edge_cases(spark):
    rows = [(1, None, "user", None), (1, 0, None, "b"), (1, 0, None, "a"), (None, 0, "user", "x"), (3, 5, "user", "long " * 100_000), (4, 5, "user", "long " * 100_000),
            (5, 1, "u", "w"), (5, 1, "u", "w"), *[(6, i, "u", f"t{i}") for i in range(1500)], *[(7, i, "u", f"t{i}") for i in range(1400)]]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("clash") for c in ("path", "words", "key", "kind", "id")})
    got = trie_rows(conversation_trie.prefix_trie(conversation_trie.sequences(df)))
    seqs = [(1, [("user", ""), ("", "a"), ("", "b")]), (3, [("user", "long " * 100_000)]), (4, [("user", "long " * 100_000)]), (5, [("u", "w")] * 2),
            (6, [("u", f"t{i}") for i in range(1500)]), (7, [("u", f"t{i}") for i in range(1400)])]
    assert got == brute_trie(seqs)
    assert conversation_trie.prefix_trie(conversation_trie.sequences(df.limit(0))).collect() == []


def test_trie_query_rebuilds_conversations(spark, tmp_path):
    rng = random.Random(5)
    rows = [(c, t if t else None, rng.choice(["user", None]), rng.choice(["a b c", "a", "", None])) for c in rng.sample(range(200), 70) for t in range(rng.choice([1, 2, 4]))]
    spark.createDataFrame(rows, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    own = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] or -1, r[2] or "", r[3] or "")):
        own[c].append((r or "", x or ""))
    seqs = []
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seqs.append((c, own.get(c - c % 20, [])[:h] + turns[h:]))
    assert trie_rows(queries.op11_conversation_trie(spark, str(tmp_path))) == brute_trie(seqs)


def brute_runs(w, least):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # a smaller period came first
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_text(rng):
    n = rng.randint(0, 70)
    w = [rng.choice("abcdefgh"[:rng.choice([1, 2, 3, 8])]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a = rng.randrange(n)
        p = rng.randint(1, n - a)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return rng.choice([" ", "\n", " \t"]).join(w)


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def test_runs_against_all_periods(spark):
    rng = random.Random(11)
    rows = [(i % 300, periodic_text(rng)) for i in range(600)]
    got = periodic_runs.detect(spark.createDataFrame(rows, "doc_id long, text string").withColumn("runs", F.lit("clash")), batch_words=64)
    for r, (doc, text) in zip(got.collect(), rows, strict=True):
        runs = brute_runs(words(text), 12)
        assert (r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) == (doc, len(words(text)), sorted(runs, key=lambda x: (x[0], x[2])), collapsed(words(text), runs))


def test_runs_of_edge_cases(spark, edge, none):
    got = {(r.doc_id, r.n_words): r for r in periodic_runs.detect(edge).collect()}
    assert [tuple(x) for x in got[6, 100_000].runs] == [(0, 100_000, 5)] and got[6, 100_000].collapsed == "lorem ipsum dolor sit amet"
    assert got[3, 0].runs == [] and got[3, 0].collapsed == "" and got[5, 0].collapsed == "" and (None, 3) in got
    assert periodic_runs.detect(none).collect() == []
    same = periodic_runs.detect(spark.createDataFrame([(1, "a " * 200_000), (2, "a\u00a0b " * 30 + "\u00e9")], "doc_id long, text string")).collect()
    assert [[tuple(x) for x in r.runs] for r in same] == [[(0, 200_000, 1)], [(0, 30, 1)]]


def test_runs_query_on_a_table(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, rng.choice([None, "", " ", *[periodic_text(rng) for _ in range(8)]])) for i in [*range(400), 7, 7, None]]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for doc, text in rows:
        w = words(text)
        h = zlib.crc32(str(doc).encode()) if doc is not None else 1
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
        runs = sorted(brute_runs(w, 12), key=lambda x: (x[0], x[2]))
        best = min(runs, key=lambda x: (-x[1], x[0], x[2]), default=(None,) * 3)
        said = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        want.append((doc, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(said.encode()).hexdigest(),
                     hashlib.sha256(collapsed(w, runs).encode()).hexdigest()))
    got = [tuple(r) for r in queries.op13_periodic_runs(spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and sum(r[1] for r in want) > 50


def test_url_rules_and_hosts(spark):
    rules = queries.URL_RULES
    none = spark.createDataFrame([], "tokens array<string>, anchor string, confidence double")
    urls = {"http://A.Example.COM/en/x?q#f": ("a.example.com", "/en/x", "example.com/en/", "block"), "https://www.example.com/en/1": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
            "https://x.com": ("x.com", "", None, "allow"), "https://x.com/": ("x.com", "/", "com/", "allow"), "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
            "ftp://net/es/a://b/c": ("net", "/es/a://b/c", "net/es/", "block"), "http://a.net/fr": ("a.net", "/fr", None, "allow"), "no scheme.com/en/": ("", "", None, "allow"),
            "http://É.com\n.net/es/": ("É.com\n.net", "/es/", "net/es/", "block"), "http://x.net?u=/es/": ("x.net", "", None, "allow"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
            "http://" + "a." * 50_000 + "com/" + "b/" * 50_000: ("a." * 50_000 + "com", "/" + "b/" * 50_000, "com/", "allow")}
    rows = [(i, u) for i, u in enumerate(urls)] + [(None, "https://x.com/"), (3, "https://x.com/")]
    df = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit("clash") for c in ("host", "path", "rule", "verdict", "tokens", "has")})
    got = url_rules.judge(df, rules, none).collect()
    assert sorted((r.page_id if r.page_id is not None else -1, r.host, r.path, str(r.rule), r.verdict) for r in got) == sorted(
        (i if i is not None else -1, urls[u][0], urls[u][1], str(urls[u][2]), urls[u][3]) for i, u in rows)
    assert url_rules.judge(df.limit(0), rules, none).collect() == []


def test_mined_rules_block_what_the_labels_show(spark):
    rng = random.Random(2)
    rows, bad_of = [], lambda h, lang: h == "cheap-pills" or (h == "shop" and lang == "xx")
    for i in range(3000):
        h, lang = rng.choice(["cheap-pills", "blog", "shop", "news", "wiki"]), rng.choice(["en", "fr", "xx"])
        rows.append((f"https://{h}.example{rng.randrange(40)}.org/{lang}/{i}.html?page=1", bad_of(h, lang) or rng.random() < 0.05))
    rows += [(None, True), ("http://x.org/", None), ("", True)]
    mined = url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"))
    found = {tuple(r.tokens): r for r in mined.collect()}
    assert ("host=cheap-pills",) in found and ("host=shop", "path=xx") in found
    assert all(not set(a) < set(b) for a in found for b in found) and all(r.anchor in r.tokens for r in found.values())
    urls = [("https://cheap-pills.example5.org/en/9", "block"), ("http://cheap-pills.new.net/", "block"), ("https://shop.example1.org/xx/1", "block"),
            ("https://shop.example1.org/en/1", "allow"), ("https://blog.example1.org/xx/1", "allow"), (None, "allow")]
    got = url_rules.judge(spark.createDataFrame([(i, u) for i, (u, _) in enumerate(urls)], "page_id long, url string"), (), mined).orderBy("page_id").collect()
    assert [r.verdict for r in got] == [v for _, v in urls]
    assert url_rules.mine(spark.createDataFrame([], "url string, bad boolean")).collect() == []
    many = spark.createDataFrame([("http://a.org/" + "/".join(f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)), True)] * 60, "url string, bad boolean")
    assert url_rules.mine(many).count() == 12


def test_mined_rules_use_every_token_of_long_urls(spark):
    rng = random.Random(5)
    rows = []
    for i in range(400):
        # 16 tokens that every URL has, and eight that come by chance; two of these together are bad, and three others
        own = [w for w in ("qa", "qb", "qc", "qd", "qe", "qf", "qg", "qh") if rng.random() < 0.5]
        bad = {"qa", "qb"} <= set(own) or {"qc", "qd", "qe"} <= set(own)
        rows.append(("http://z.org/" + "/".join([f"p{chr(97 + k)}" for k in range(11)] + own), bad))
    df = spark.createDataFrame(rows, "url string, bad boolean")
    sets = [({"scheme=http", "host=z", "host=org", "word=z", "word=org"} | {"path=" + s for s in u.split("/")[3:]}, b) for u, b in rows]

    def confidence(hits, n):
        p, z = hits / n, url_rules.Z
        return (p + z * z / (2 * n) - z * (p * (1 - p) / n + z * z / (4 * n * n)) ** 0.5) / (1 + z * z / n)

    want = {}
    for k in range(1, 5):
        for t in itertools.combinations(sorted(set().union(*(s for s, _ in sets))), k):
            if any(set(w) <= set(t) for w in want):
                continue
            of = [b for s, b in sets if s.issuperset(t)]
            if sum(of) >= 10 and confidence(sum(of), len(of)) >= 0.8:
                want[t] = (len(of), sum(of))
    assert ("path=qa", "path=qb") in want and ("path=qc", "path=qd", "path=qe") in want
    got = url_rules.mine(df, min_confidence=0.8, max_items=None).collect()
    assert {tuple(r.tokens): (r.n, r.hits) for r in got} == want
    many = spark.createDataFrame([("http://a.org/" + "/".join(f"p{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40)), True)] * 60, "url string, bad boolean")
    assert url_rules.mine(many, max_items=None).count() == 45


def test_levels_keep_numbers_and_one_row_per_beginning(spark, monkeypatch):
    """What a level leaves open is a row for each URL and beginning, without texts."""
    seen, write = [], url_rules.materialize

    def watched(df, name):
        table = write(df, name)
        if name == "url-open":
            seen.append((table.count(), table.schema.simpleString()))
        return table

    monkeypatch.setattr(url_rules, "materialize", watched)
    rows = [("http://a.org/" + "/".join(f"p{chr(97 + k)}" for k in range(14)), i % 3 == 0) for i in range(60)]
    assert url_rules.mine(spark.createDataFrame(rows, "url string, bad boolean"), max_items=None, min_confidence=0.9, max_tokens=3).count() == 0
    assert seen[0][0] == 60 and seen[1][0] == 60 * 17 and not any("string" in schema for _, schema in seen)    # 19 tokens


def test_both_ways_of_mining_agree(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(f"https://{rng.choice('abc')}.org/{rng.choice('def')}/{rng.choice('ghi')}?{rng.choice('jk')}=1", rng.random() < 0.6) for _ in range(600)]
    df = spark.createDataFrame([(u, b and "a.org" in u or "/d/g" in u) for u, b in rows], "url string, bad boolean")
    grown = {(tuple(r.tokens), r.anchor, r.n, r.hits, r.confidence) for r in url_rules.mine(df, max_items=None).collect()}
    monkeypatch.setattr(url_rules, "FIT_ITEMS", 1)
    assert grown and grown == {(tuple(r.tokens), r.anchor, r.n, r.hits, r.confidence) for r in url_rules.mine(df, max_items=None).collect()}
