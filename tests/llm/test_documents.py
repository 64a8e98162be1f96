"""Document operators: edge cases, ties, empty tables, and brute-force versions."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from civiclake.llm import exact_dedup, jaccard_join, language_id, licenses, mixing, packing, shingles, suffix_dedup
from civiclake.llm.components import components, extended

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")


def test_ranks_give_the_ids_of_the_tokenizers_library():
    fast, slow = packing.encoder(RANKS), packing.encoder(JSON)
    random.seed(1)
    pool = [chr(c) for c in [*range(1, 0x250), 0x2028, 0x3000, 0x85, 0xA0, 0x200B, 0x1680, 0xFEFF, 0x1F600, 0x4E00, 0x301, 0x660, 0x0E33]]
    for _ in range(3000):
        t = "".join(random.choices(pool, k=random.randint(0, 30)))
        assert fast(t).tolist() == slow(t).tolist(), repr(t)
    assert fast("a<|endoftext|>b").tolist() == slow("a<|endoftext|>b").tolist()


def test_sum_of_squares_places_by_the_stated_rule():
    random.seed(2)
    cap, bins = 12, packing.SumOfSquares(12)
    gaps: dict[int, int] = {}
    for _ in range(300):
        size = random.randint(1, 12)
        square = lambda g: sum(v * v for v in collections.Counter(x for x in g.values() if x).values())
        options = {}
        for b, gap in list(gaps.items()) + [(len(gaps), cap)]:
            if gap >= size:
                options[b] = square(gaps | {b: gap - size})
        b, at = bins.place(size)
        assert options[b] == min(options.values()) and at == cap - gaps.get(b, cap)
        gaps[b] = gaps.get(b, cap) - size


def test_packing(spark, edge, none):
    rows = packing.pack(edge, RANKS, capacity=64, shard_pieces=50).collect()
    enc = packing.encoder(JSON)
    texts = edge.select("doc_id", "text").collect()
    want = collections.Counter()
    for t in texts:
        ids = np.concatenate([enc(t.text or ""), np.array([0], "<u4")])
        want.update((t.doc_id, k, s, n, ids[s:s + n].tobytes()) for k, (s, n) in enumerate(packing.cut(len(ids), 64)))
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, bytes(r.ids)) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= 64
    assert packing.pack(none, RANKS).count() == 0


def shingle_set(text):
    w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(text or "")]
    return {tuple(w[i:i + 4]) for i in range(len(w) - 3)} if len(w) >= 4 else ({tuple(w)} if w else set())


def brute_components(rows, num=85, den=100):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and den * both >= num * (len(a) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return {d: (len(sets[i]), least[find(i)]) for i, (d, _) in enumerate(rows)}


def family_rows():
    random.seed(5)
    vocabulary = [f"w{i}" for i in range(300)]
    some = lambda n: [random.choice(vocabulary) for _ in range(n)]
    passage, base, out = some(60), some(120), []
    for _ in range(15):
        words = some(random.choice([1, 2, 3, 5, 8, 12, 30, 60, 100, 200]))
        for _ in range(random.choice([1, 2, 4])):
            w = list(words)
            for _ in range(random.randint(0, max(1, len(w) // 25))):
                w[random.randrange(len(w))] = random.choice(vocabulary)
            out.append(" ".join(w))
    out += [" ".join(some(random.randint(3, 12)) + passage + some(random.randint(3, 12))) for _ in range(40)]
    for i in range(60):
        w = list(base)
        for _ in range(random.randint(0, 8)):
            w[random.randrange(len(w))] = random.choice(vocabulary)
        out.append(" ".join(w).upper() if i % 2 else " ".join(w))
    out += ["", None, "  ", "a", "A", "a b", "a  b\n", "a b c d", "a b c d a b c d"]
    random.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("pivots", [512, 3])
def test_jaccard_join_against_all_pairs(spark, monkeypatch, pivots):
    monkeypatch.setattr(jaccard_join, "PIVOTS", pivots)
    rows = family_rows() if pivots > 3 else [r for r in family_rows() if r[0] % 3]
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)


def test_jaccard_regions_never_part_linked_sets():
    rng = np.random.default_rng(3)
    regions = jaccard_join.Regions(85, 100)
    for n in [1, 2, 3, 5, 6, 7, 9, 13, 20, 40, 63, 64, 90, 141, 300, 1000]:
        for _ in range(40):
            s = np.sort(rng.integers(0, 1 << 63, n, dtype=np.uint64))
            both = n - int(rng.integers(0, max(1, n * 15 // 100) + 1))
            t = np.sort(np.concatenate([rng.choice(s, both, replace=False), rng.integers(0, 1 << 63, int(rng.integers(0, max(1, n // 10) + 1)), dtype=np.uint64)]))
            if len(t) and jaccard_join.linked(s, t, 85, 100)[0]:
                (ks, need_s), (kt, need_t) = regions.keys(s), regions.keys(t)
                assert len(set(ks) & set(kt)) >= max(1, need_s, need_t), n


def test_unrelated_sets_share_no_region():
    """The smallest sets of a class have the most empty buckets, which are no regions of theirs."""
    rng = np.random.default_rng(4)
    for num in (80, 85):
        regions = jaccard_join.Regions(num, 100)
        regions.classes(10_000)
        for n in [low for low in regions.low if 60 <= low <= 6000]:
            keys = [regions.keys(rng.integers(0, 1 << 63, n, dtype=np.uint64))[0] for _ in range(40)]
            shared = sum(len(np.intersect1d(a, b)) > 0 for a, b in itertools.combinations(keys, 2))
            assert shared <= 8, (num, n, shared)    # of 780 pairs


def test_sketches_never_part_linked_sets():
    rng = np.random.default_rng(6)
    few = 0
    for n in [1, 2, 5, 20, 63, 64, 65, 129, 500, 1030]:
        for _ in range(60):
            s = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            both = n - int(rng.integers(0, n * 25 // 100 + 1))
            t = np.concatenate([s[:both], rng.integers(0, 1 << 63, int(rng.integers(0, n // 5 + 1)), dtype=np.uint64)])
            near = jaccard_join.may_meet(jaccard_join.sketch(s), jaccard_join.sketch(t), 85, 100)
            assert near or not jaccard_join.linked(np.sort(s), np.sort(t), 85, 100)[0]
            other = rng.integers(0, 1 << 63, n + n // 9, dtype=np.uint64)
            few += n > 20 and jaccard_join.may_meet(jaccard_join.sketch(s), jaccard_join.sketch(other), 85, 100)
    assert few == 0


def test_jaccard_join_in_many_rounds(spark, monkeypatch):
    """Rounds that send next to nothing each; the pairs whose sketches part them send no sets."""
    sent, split = [], jaccard_join.in_rounds

    def rounds(some, sizes, unit, most):
        parts = split(some, sizes, unit, 4000 if unit == 8 else 500)
        sent.append((unit, len(parts), some.count()))
        return parts

    monkeypatch.setattr(jaccard_join, "in_rounds", rounds)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 4)
    rows = [r for r in family_rows() if r[0] % 3]
    got = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)
    assert max(n for _, n, _ in sent) > 1


def test_copies_of_one_text_just_below_the_threshold(spark):
    """2,000 copies with one to eight replaced words: most pairs are near the threshold, some copies are linked with nothing."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(400)}" for _ in range(150)]
    rows = []
    for i in range(2000):
        words = list(base)
        for at in rng.sample(range(150), rng.randint(1, 8)):
            words[at] = f"x{rng.randrange(100_000)}" if rng.random() < 0.8 else f"y{rng.randrange(3)}"
        rows.append((i, " ".join(words)))
    got = {r.doc_id: r.component_id for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    sets = [{tuple(t.split()[k:k + 4]) for k in range(147)} for _, t in rows]
    number = {}
    flat = [np.array([number.setdefault(g, len(number)) for g in s]) for s in sets]
    hits = np.zeros((2000, len(number)), dtype=np.float32)
    for i, f in enumerate(flat):
        hits[i, f] = 1
    both = hits @ hits.T
    sizes = hits.sum(axis=1)
    link = 100 * both >= 85 * (sizes[:, None] + sizes[None, :] - both)
    low = np.arange(2000)
    while True:
        new = np.where(link, low[None, :], 2000).min(axis=1)
        if (new == low).all():
            break
        low = new
    assert [got[i] for i in range(2000)] == low.tolist() and 1 < len(set(low)) < 1900


def test_jaccard_edges(spark, edge, none):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.join(edge).collect())
    assert got == collections.Counter({(1, 2, 1): 2, (2, 2, 1): 1, (3, 0, 3): 1, (4, 0, 4): 1, (5, 0, 5): 1, (None, 1, None): 2, (6, 5, 6): 1, (7, 5, 6): 1})
    assert jaccard_join.join(none).count() == 0


def test_mixing(spark, edge, none):
    rows = [(i, "w " * (i % 7), f"s{i % 5}") for i in range(400)] + [(900, "w " * 9000, "big"), (901, None, None), (902, "x", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, shard_docs=20, block_words=8).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(df, shard_docs=20, block_words=8).collect()), key=str)
    size, target, taken = collections.Counter(), {}, collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    # the stated sharing, step by step
    names = sorted((s for s in size if s is not None)) + [None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    total, given, free = 1.5 * sum(size.values()), dict.fromkeys(names, 0.0), set(names)
    while True:
        level = (total - sum(given[s] for s in names if s not in free)) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        for s in free:
            given[s] = 2.0 * size[s] if s in over else level * weight[s]
        if not over:
            break
        free -= over
    for s in names:
        assert target[s] == pytest.approx(given[s])
        assert abs(taken[s] - target[s]) <= 16
    assert mixing.mix(edge).count() == edge.count() and mixing.mix(none).count() == 0


def test_sainte_lague_gives_the_highest_quotients(spark):
    random.seed(4)
    for seats in (0, 1, 7, 50):
        votes = {p: random.choice([0, 1, 5, 5, 60, 1000]) for p in range(12)} | {12: 7}
        df = spark.createDataFrame([("g", p, v, seats) for p, v in votes.items()], "g string, p long, v long, n long")
        got = {r.p: r.quota for r in mixing.sainte_lague(df, ["g"], ["p"], "v", "n").collect()}
        q = sorted(((-v / (2 * k + 1), p) for p, v in votes.items() if v for k in range(seats)))[:seats]
        want = collections.Counter(p for _, p in q)
        assert got == {p: want.get(p, 0) for p in votes}


def test_exact_dedup(spark, edge, none):
    rows = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.dedup(edge).collect()}
    assert rows == {(1, 1, 2), (2, 2, 1), (3, 5, 3), (4, 5, 3), (5, 5, 3), (None, None, 2), (6, 6, 2), (7, 6, 2)}
    got = exact_dedup.dedup(edge)
    assert got.filter("kept").count() == got.select("digest").distinct().count() == 5
    assert {bytes(r.digest).hex() for r in got.filter("doc_id = 1").collect()} == {hashlib.sha256(b"abcde").hexdigest()}
    assert exact_dedup.dedup(none).count() == 0


def test_exact_dedup_takes_colliding_digests_apart(spark, monkeypatch):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a ")], "doc_id long, text string")
    monkeypatch.setattr(exact_dedup.F, "sha2", lambda c, n: F.lit("00"))
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.dedup(df).collect()}
    assert got == {(1, 3, 2, False), (3, 3, 2, True), (2, 2, 1, True)}


def test_language_id(spark, edge, none):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = language_id.train(docs.filter(~held))
    got = language_id.predict(docs, model, keep={"lang": F.col("lang"), "held": held}).filter("held").collect()
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.97
    for r in language_id.predict(edge, model).collect():
        assert 0 <= r.score <= 1 and (r.lang_pred == "und") == (r.doc_id in (3, 4, 5))
    assert language_id.predict(none, model).count() == 0
    unlearned = language_id.predict(edge, language_id.train(none)).collect()
    assert {r.lang_pred for r in unlearned} == {"und"}


def test_language_of_a_long_text_is_as_clear_as_of_a_short_one(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").filter("text is not null")
    classify = language_id.Classifier(language_id.train(docs))
    for lang in ("en", "de"):
        page = " ".join(r.text for r in docs.filter(F.col("lang") == lang).orderBy("doc_id").collect())
        got = [classify((page * (n // len(page) + 1))[:n]) for n in (4_000, 20_000, 4_000_000)]
        assert [g[0] for g in got] == [lang] * 3
        assert min(g[2] for g in got) > 0.05 and got[2][1] > 0.5


def test_license_scan(spark, none):
    text = "Intro.\nReleased under the MIT license!\nlicensed under cc by-nc 4.0"
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "Licensed under the Apache License, Version 2.0."), (4, "licence"), (5, "x " * 50_000 + "license")]
    got = {(r.doc_id, r.line, r.license_id, r.dice) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("line", F.lit("x"))).collect()}
    assert got == {(1, 2, "MIT", 1.0), (1, 3, "CC-BY-NC-4.0", 1.0), (None, 1, "Apache-2.0", 1.0)}
    assert licenses.scan(none).count() == 0
    low = 0.8 / 1.2
    needed = licenses.needed_words([t for _, t in licenses.TEMPLATES], low)
    for _, t in licenses.TEMPLATES:
        grams = licenses.bigrams_of(t)
        assert sum(not any(w in x for x in g.split() for w in needed) for g in grams) < low * len(grams)


def test_license_notices_wrapped_and_embedded(spark):
    import textwrap
    by = [t for _, t in licenses.TEMPLATES]
    mit, gpl = next(t for t in by if t.startswith("Permission")), next(t for t in by if t.startswith("This program"))
    prose = "some words of the document that stand before and after it " * 20
    wrapped = "\n".join(["def f():", prose, *["# " + x for x in textwrap.wrap(mit, 76)], prose, *[" * " + x for x in textwrap.wrap(gpl, 60)], prose])
    inside = prose + "Released under the MIT License. " + prose
    rows = [(1, wrapped), (2, inside), (4, prose), (5, "a\n" + gpl)]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    n = 3 + len(textwrap.wrap(mit, 76)) + 1
    assert {(r.doc_id, r.line, r.license_id) for r in got if r.dice == 1} == {(1, 3, "MIT"), (1, n, "GPL-3.0"), (2, 1, "MIT"), (5, 2, "GPL-3.0")}
    assert {(r.doc_id, r.license_id) for r in got if r.doc_id in (2, 4)} == {(2, "MIT")}
    assert len({(r.doc_id, r.line, r.license_id) for r in got}) == len(got)


def test_suffix_passages_against_all_runs(spark, edge, none):
    random.seed(2)
    rows = [" ".join(random.choice("abcdef") for _ in range(random.randint(0, 60))) for _ in range(150)]
    rows = list(enumerate(rows + rows[:10] + [None, "", "a " * 40, "a " * 40]))
    least, words = 8, [WORD.findall(t or "") for _, t in rows]
    count = collections.Counter(tuple(w[s:s + least]) for w in words for s in range(len(w) - least + 1))
    want = []
    for (d, _), w in zip(rows, words, strict=True):
        spans = []
        for s in range(len(w) - least + 1):
            if count[tuple(w[s:s + least])] > 1:
                if spans and s <= spans[-1][1]:
                    spans[-1][1] = s + least
                else:
                    spans.append([s, s + least])
        want += [(d, a, b, b - a, (a, b) == (0, len(w))) for a, b in spans]
    got = suffix_dedup.passages(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), least=least, gram=4).collect()
    assert sorted(map(tuple, got)) == sorted(want)
    assert {(r.doc_id, r.n_words, r.whole) for r in suffix_dedup.passages(edge).collect()} == {(6, 100_000, True), (7, 100_000, True)}
    assert suffix_dedup.passages(none).count() == 0


def test_word_hashes_follow_the_word_pattern():
    import pyarrow as pa

    from civiclake.llm.arrow_rows import utf8_parts
    random.seed(3)
    texts = ["".join(random.choices("aAb \n\té 　Z", k=random.randint(0, 30))) for _ in range(500)] + ["", "   ", "x" * 9000 + " " + "x" * 9001, None]
    h, _, _, at = shingles.words(*utf8_parts(pa.array(texts)), lower=True)
    seen = {}
    for i, t in enumerate(texts):
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in WORD.findall(t or "")]
        assert len(w) == at[i + 1] - at[i]
        for x, g in zip(w, h[at[i]:at[i + 1]], strict=True):
            assert seen.setdefault(x, g) == g
    assert len(set(seen.values())) == len(seen)


def test_word_hashes_do_not_depend_on_long_neighbours():
    import pyarrow as pa

    from civiclake.llm.arrow_rows import utf8_parts
    short = ["a few short words", "x" * 4096 + " y", "z" * 5000 + "a"]
    alone = [shingles.words(*utf8_parts(pa.array([t])), lower=True)[0].tolist() for t in short]
    for long in ("q" * 4097, "\u6f22" * 1400, " " * 9000):
        h, _, _, at = shingles.words(*utf8_parts(pa.array([long, *short])), lower=True)
        assert [h[at[i]:at[i + 1]].tolist() for i in range(1, 4)] == alone
    assert len({x for w in alone for x in w}) == 7


def test_near_copies_are_found_beside_long_words(spark):
    """Each document once in a slice with a long word and once in one without."""
    rows = [(0, "b" * 5000)] + [(i, " ".join(f"w{i}x{k}" for k in range(300))) for i in range(1, 6)]
    rows += [(10 + i, t + " end") for i, t in rows[1:]]
    df = spark.createDataFrame(rows[:6], "doc_id long, text string").coalesce(1).union(spark.createDataFrame(rows[6:], "doc_id long, text string").coalesce(1))
    got = {r.doc_id: r.component_id for r in jaccard_join.join(df).collect()}
    assert got == {0: 0} | {i: i for i in range(1, 6)} | {10 + i: i for i in range(1, 6)}
    found = {(r.doc_id, r.n_words) for r in suffix_dedup.passages(df).collect()}
    assert found == {(i, 300) for i in [*range(1, 6), *range(11, 16)]}


def test_components_grow_by_further_edges(spark):
    """A long path, a hub, loops and repeats, the second half of the edges later."""
    edges = [(i, i + 1) for i in range(40)] + [(100, -i) for i in range(200, 220)] + [(7, 7), (3, 4), (4, 3), (-205, 20)]

    def least(some):
        root = {n: n for e in some for n in e}
        for _ in root:
            for a, b in some:
                root[a] = root[b] = min(root[a], root[b])
        return {n: r for n, r in root.items() if n != r}

    def frame(some):
        return spark.createDataFrame(some, "a long, b long")

    first = components(frame(edges[::2]))
    assert {r.node: r.root for r in first.collect()} == least(edges[::2])
    both = extended(first, frame(edges[1::2])).collect()
    assert {r.node: r.root for r in both} == least(edges)
    assert len(both) == len(least(edges))
    assert components(frame([])).isEmpty()
    assert [tuple(r) for r in extended(components(frame([])), frame([(2, 1)])).collect()] == [(2, 1)]
