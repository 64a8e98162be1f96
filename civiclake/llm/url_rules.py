"""URL filtering by given rules and by association rules mined from labels.

A URL is a set of tokens (scheme, host labels and their parts, path segments with
numbers as ``#``, extension, names of query keys). Spark's FP-growth mines the
token combinations of labelled URLs, or a level-wise search if a URL has too many
tokens for all their combinations; a combination becomes a blocking rule if it
has enough support among bad URLs and the lower end of the Wilson interval of its
confidence reaches a threshold, so that a few bad URLs by chance make no rule. Rules
that contain a smaller rule are redundant and go. The rest are an inverted index:
each rule is filed under its rarest token, a URL looks up its tokens and tests
only the rules filed there.

DataFrame operations and ``pyspark.ml.fpm`` only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civiclake.session import dropped, materialize

BAD = "label=block"
#: Wilson interval: normal quantile
Z = 3.0
#: frequent tokens of a URL all whose combinations FP-growth goes through
FIT_ITEMS = 12


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a URL, sorted; none for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    scheme = F.lower(F.regexp_extract(text, r"(?s)^(.*?)://", 1))
    labels = F.filter(F.split(host_of(url), r"\."), lambda x: x != "")
    parts = F.filter(F.split(host_of(url), r"[.\-]"), lambda x: x != "")
    segments = F.filter(F.split(F.regexp_replace(path_of(url), r"\.[A-Za-z0-9]{1,5}$", ""), "/"), lambda x: x != "")
    extension = F.lower(F.regexp_extract(path_of(url), r"\.([A-Za-z0-9]{1,5})$", 1))
    keys = F.filter(F.split(F.regexp_extract(text, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), "&"), lambda x: x != "")
    one = F.array(F.concat(F.lit("scheme="), scheme), F.concat(F.lit("ext="), extension))
    named = F.concat(
        F.filter(one, lambda x: ~x.endswith("=")),
        F.transform(labels, lambda x: F.concat(F.lit("host="), x)),
        F.transform(parts, lambda x: F.concat(F.lit("word="), x)),
        F.transform(segments, lambda x: F.concat(F.lit("path="), F.regexp_replace(F.lower(x), "[0-9]+", "#"))),
        F.transform(keys, lambda x: F.concat(F.lit("key="), F.lower(F.substring_index(x, "=", 1)))))
    return F.sort_array(F.array_distinct(named))


def wilson(hits: Column, n: Column) -> Column:
    """Lower end of the Wilson interval of hits / n."""
    p = hits / n
    return (p + Z * Z / (2 * n) - Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def mine(labelled: DataFrame, *, min_support: float = 0.0005, min_count: int = 10, min_confidence: float = 0.5, max_items: int | None = FIT_ITEMS,
         max_tokens: int = 4) -> DataFrame:
    """(tokens, anchor, n, hits, confidence) of the rules found in (url, bad).

    A rule has at most ``max_tokens`` tokens, which occur together in at least
    ``min_support`` of the labelled URLs and ``min_count`` of them as bad ones; its
    confidence is the lower Wilson bound. Tokens under that support are in no such
    rule and go before. With ``max_items`` None all frequent tokens of every URL are
    mined: by FP-growth if no URL has more than ``FIT_ITEMS`` of them, else level by
    level (``by_level``), with the same rules. A given ``max_items`` asks for a
    quicker, partial fit on the tokens of each URL with the highest confidence
    (matching uses all tokens).

    Null labels and null URLs are not learned from; without labelled bad URLs there is
    no rule; repeated URLs count as often as they are labelled.
    """
    rows = labelled.filter("url is not null and bad is not null").select(tokens_of(F.col("url")).alias("tokens"), F.col("bad").cast("int").alias("bad"))
    rows = materialize(rows.select(F.monotonically_increasing_id().alias("row"), "tokens", "bad"), "url-labelled")
    total = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    nothing = rows.filter("false").selectExpr("tokens", "string(null) as anchor", "bigint(0) as n", "bigint(0) as hits", "double(0) as confidence")
    least = max(min_count, min_support * total["n"])
    if total["bad"] < least:
        return nothing
    exploded = rows.select("row", "bad", F.explode("tokens").alias("token"))
    # at most (tokens of a URL) / min_support tokens are left
    frequent = exploded.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.sum("bad").alias("hits")).filter(F.col("hits") >= least)
    frequent = materialize(frequent.select("token", "n", wilson(F.col("hits"), F.col("n")).alias("bound"), F.monotonically_increasing_id().alias("id")), "url-tokens")
    best = F.sort_array(F.collect_list(F.struct((-F.col("bound")).alias("bound"), "token", "id")))
    if max_items is not None:
        best = F.slice(best, 1, max_items)
    items = exploded.join(frequent, "token").groupBy("row").agg(F.max("bad").alias("bad"), best.alias("best"))
    items = items.select("row", "bad", F.when(F.col("bad") == 1, F.array_append("best.token", BAD)).otherwise(F.col("best.token")).alias("items"), F.col("best.id").alias("ids"))
    items = materialize(items, "url-items")
    # rows without a frequent token are no longer there, but count for the support
    present, widest = items.agg(F.count(F.lit(1)), F.max(F.size(F.array_remove("items", BAD)))).first()
    if not present:
        return nothing
    if max_items is None and widest > FIT_ITEMS:
        sets = by_level(items, frequent, least, min_confidence, max_tokens)
    else:
        sets = by_growth(items, (least - 0.5) / present, max_tokens)
    found = sets.withColumn("confidence", wilson(F.col("hits"), F.col("n"))).filter((F.col("hits") >= least) & (F.col("confidence") >= min_confidence))
    found = materialize(found, "url-rules")
    smaller = found.select(F.col("tokens").alias("part"))
    redundant = found.select("tokens", F.explode(_parts("tokens", max_tokens)).alias("part")).join(smaller, "part", "left_semi").select("tokens").distinct()
    rules = found.join(redundant, "tokens", "left_anti")
    rare = (rules.select("tokens", F.explode("tokens").alias("token")).join(frequent.select("token", F.col("n").alias("in_all")), "token")
            .groupBy("tokens").agg(F.min_by("token", F.struct("in_all", "token")).alias("anchor")))
    return materialize(rules.join(rare, "tokens").select("tokens", "anchor", "n", "hits", "confidence"), "url-mined")


def by_growth(items: DataFrame, support: float, max_tokens: int) -> DataFrame:
    """(tokens, hits, n) of the combinations with that support, by FP-growth, which
    goes through all combinations of a URL's items."""
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, support)).fit(items.select("items"))
    sets = materialize(model.freqItemsets.filter(F.size("items") <= max_tokens + 1), "url-itemsets")
    with_bad = sets.filter(F.array_contains("items", BAD) & (F.size("items") > 1))
    hits = with_bad.select(F.sort_array(F.array_remove("items", BAD)).alias("tokens"), F.col("freq").alias("hits"))
    alone = sets.filter(~F.array_contains("items", BAD)).select(F.sort_array("items").alias("tokens"), F.col("freq").alias("n"))
    return hits.join(alone, "tokens")


def by_level(items: DataFrame, frequent: DataFrame, least: float, min_confidence: float, max_tokens: int) -> DataFrame:
    """(tokens, hits, n) of the combinations with ``least`` hits of which no rule is
    a smaller part, however many items a URL has.

    A combination of k tokens joins two of k - 1 in the same URL that differ in the
    last token. Those with too few hits have no frequent extension, and those that are
    rules themselves none that is not redundant: neither is extended. In the URLs, tokens
    and combinations are numbers; only their counts and, once a level, the combinations
    still open in each URL are shuffled."""
    at = items.select("row", "bad", F.lit(None).cast("long").alias("head"), F.explode("ids").alias("last"))
    names = frequent.select(F.col("id").alias("last"), "token")
    before, levels, open_ = None, [], None
    for k in range(1, max_tokens + 1):
        sets = at.groupBy("head", "last").agg(F.sum("bad").alias("hits"), F.count(F.lit(1)).alias("n")).filter(F.col("hits") >= least).join(names, "last")
        if before is None:
            sets = sets.withColumn("tokens", F.array("token"))
        else:
            sets = sets.join(before.select(F.col("set").alias("head"), "tokens"), "head").withColumn("tokens", F.array_append("tokens", F.col("token")))
        sets = materialize(sets.select(F.monotonically_increasing_id().alias("set"), "head", "last", "tokens", "hits", "n"), "url-itemsets")
        levels.append(sets.select(F.sort_array("tokens").alias("tokens"), "hits", "n"))
        before = sets.filter(wilson(F.col("hits"), F.col("n")) < min_confidence)
        if k == max_tokens or before.isEmpty():
            break
        found = before.select(F.col("head").alias("h"), F.col("last").alias("l"), "set")
        left = at.join(found, F.col("head").eqNullSafe(F.col("h")) & (F.col("last") == F.col("l")))
        left = left.groupBy("row", "head").agg(F.max("bad").alias("bad"), F.sort_array(F.collect_list(F.struct("last", "set"))).alias("some")).filter(F.size("some") > 1)
        left = materialize(left.select("row", "bad", "some"), "url-open")
        if open_ is not None:
            dropped(open_)
        open_ = left
        first = left.select("row", "bad", "some", F.posexplode("some").alias("i", "one"))
        at = first.select("row", "bad", F.col("one.set").alias("head"), F.explode(F.expr("slice(some.last, i + 2, size(some))")).alias("last"))
    if open_ is not None:
        dropped(open_)
    return reduce(DataFrame.union, levels)


def _parts(tokens: str, most: int) -> Column:
    """All proper, non-empty subsets of a sorted array of at most ``most`` tokens."""
    t = F.col(tokens)
    masks = F.filter(F.sequence(F.lit(1), F.lit((1 << most) - 2)), lambda m: m < F.pow(F.lit(2), F.size(t)) - 1)
    return F.transform(masks, lambda m: F.filter(t, lambda x, i: F.floor(m / F.pow(F.lit(2), i)) % 2 == 1))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], mined: DataFrame, *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, mined), one row per row of ``pages``.

    ``rules`` are (verdict, host, path); a rule fits its host and all subdomains if
    the path starts with the rule's, the longest fitting rule (host and path) wins.
    URLs that no rule fits are blocked if they hold all tokens of a mined rule
    (``mined``: the one of the highest confidence), else allowed.

    Null URLs and URLs without ``://`` have an empty host and path, no tokens, and
    are allowed. Ids may repeat or be null; repeated URLs are looked up once; an
    empty table gives an empty result; other columns are ignored.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    rows = rows.select("page_id", "url", host_of(url).alias("host"), path_of(url).alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1] + r[2])):  # later ones are asked first
        fits = ((F.col("host") == h) | F.col("host").endswith("." + h)) & F.col("path").startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    rows = rows.withColumns({"rule": rule, "given": verdict})
    asked = rows.filter("rule is null").select("url").distinct()
    tokens = asked.select("url", tokens_of(url).alias("has")).select("url", "has", F.explode("has").alias("token"))
    index = mined.select(F.col("anchor").alias("token"), "tokens", "confidence")
    hit = tokens.join(index, "token").filter(F.size(F.array_except("tokens", "has")) == 0)
    named = F.array_join("tokens", " ")
    blocked = hit.groupBy("url").agg(F.max_by(named, F.struct("confidence", named)).alias("mined"))
    out = rows.join(blocked, "url", "left")
    said = F.coalesce("given", F.when(F.col("mined").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", "rule", said.alias("verdict"), "mined")
