"""URL filters: fixed rules by host and path, and token combinations mined from labelled URLs.

Tokens that stand in the very same labelled URLs are one item, so many URLs of one shape have few sets in common; any of
its tokens stands for an item. Frequent item sets come from Spark's FP-growth over URLs with their label as one more item. Rules that lead
to a label are kept by support and confidence, up to a length, and only if no rule on fewer of the same items is as
sure. An inverted index from the tokens of a rule's rarest item finds the rules a URL may hold, and the URL's tokens decide. All in DataFrame operations.

Edge cases: a null URL, or one without ``://``, has an empty host and path, no tokens, no rule and
the default verdict. Without labels or mined rules the fixed rules and the default decide. Rules are mined for
verdicts other than the default, and for the default as exceptions: on all items of such a rule and more. Of those that match, the surest
decides, ties go to larger support, then to ``block``. Equal URLs are judged once. Columns of any name stay as they are.
"""

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "\tlabel="  # no token has a tab in front


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest (verdict, ``host/path``) that fits, else null.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    fits = []
    for verdict, rule in rules:
        rule_host, slash, rest = rule.partition("/")
        on_host = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        fits.append(
            F.when(
                on_host & F.startswith(path, F.lit(slash + rest)),
                F.struct(F.lit(len(rule)).alias("n"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict")),
            )
        )
    return F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<n:int,rule:string,verdict:string>")


def tokens(url: Column) -> Column:
    """What a URL is made of: its domain (the last two labels), the other host labels, the words of all labels,
    path segments and query names. Digits become one ``0``, so that numbered pages share a token.
    """
    h, p = host(url), path(url)
    marked = lambda parts, mark: F.transform(parts, lambda x: F.concat(F.lit(mark), F.regexp_replace(x, "[0-9]+", "0")))
    domain = F.substring_index(h, ".", -2)
    above = F.when(h != domain, F.substr(h, F.lit(1), F.length(h) - F.length(domain) - 1)).otherwise("")
    labels = F.filter(F.split(above, r"\."), lambda x: x != "")
    words = F.filter(F.split(h, "[^a-z0-9]+"), lambda x: x != "")
    segments = F.filter(F.split(F.translate(p, UPPER, LOWER), "/"), lambda x: x != "")
    names = F.regexp_extract_all(_rest(url), F.lit(r"[?&]([^=&#]+)"), 1)
    scheme = F.concat(F.lit("scheme:"), F.translate(F.substring_index(url, "://", 1), UPPER, LOWER))
    sets = [marked(labels, "label:"), marked(words, "word:"), marked(segments, "path:"), marked(names, "query:")]
    return F.when((F.instr(url, "://") > 0) & (h != ""), F.array_distinct(F.concat(F.array(F.concat(F.lit("domain:"), domain), scheme), *sets)))


def _items(baskets: DataFrame) -> DataFrame:
    """(token, item, uses): tokens of the same URLs share an item, the first of them; ``uses`` is the number of URLs. Baskets are
    numbered at random, so that sums of two hashes of the numbers tell sets of URLs apart."""
    held = baskets.select(F.explode("tokens").alias("token"), "number")
    whole = lambda seed: F.sum(F.xxhash64("number", F.lit(seed)).cast("decimal(38,0)"))
    sets = held.groupBy("token").agg(F.count("*").alias("uses"), whole(1).alias("one"), whole(2).alias("two"))
    firsts = sets.groupBy("uses", "one", "two").agg(F.min("token").alias("item"))
    return sets.join(firsts, ["uses", "one", "two"]).select("token", "item", "uses")


def mine(
    labelled: DataFrame, min_support: float = 0.0, min_count: int = 20, min_confidence: float = 0.8, default: str = "allow", max_items: int = 4
) -> DataFrame:
    """(rule_id, tokens, alike, verdict, confidence, support) from rows of (url, verdict): rules for verdicts other than the
    default, and exceptions to them for the default. ``tokens`` are a rule's items, ``alike`` has the tokens of each, the rarest item first.

    A combination counts if ``min_count`` of the labelled URLs hold it with its verdict, however many URLs there are, and
    ``min_support`` of them if that is given. A rule has at most ``max_items`` items, with an exception's further ones.
    """
    empty = "rule_id long, tokens array<string>, alike array<array<string>>, verdict string, confidence double, support double"
    spark = labelled.sparkSession
    baskets = labelled.select(tokens(F.col("url")).alias("tokens"), "verdict").filter("tokens IS NOT NULL AND verdict IS NOT NULL")
    baskets = settle(baskets.withColumn("number", F.monotonically_increasing_id()))
    n = baskets.count()
    if n < min_count:
        return spark.createDataFrame([], empty)
    # Items below the count are in no rule. An item that all URLs hold tells nothing and would double every set.
    least = max(min_count, math.ceil(min_support * n))
    items = settle(_items(baskets).filter((F.col("uses") >= least) & (F.col("uses") < n)))
    reduced = baskets.select("number", F.explode("tokens").alias("token")).join(items, "token").groupBy("number").agg(F.collect_set("item").alias("items"))
    marked = baskets.select("number", "verdict").join(reduced, "number")
    marked = settle(marked.select(F.array_append("items", F.concat(F.lit(LABEL), "verdict")).alias("items"), "verdict"))
    # First the sets that URLs against the default have in common, then how often all URLs hold these.
    against = marked.filter(F.col("verdict") != default)
    rules = _rules(against, marked, least, n, min_confidence, max_items)
    kept = settle(_shortest(rules))
    # Exceptions: among the URLs that such a rule catches, sets for the default that hold all its items and more.
    caught = kept.select(F.col("tokens").alias("of_rule"), F.explode("tokens").alias("item"), F.size("tokens").alias("needs"))
    inside = marked.filter(F.col("verdict") == default).withColumn("row", F.monotonically_increasing_id())
    inside = settle(inside)
    index = settle(caught.join(items.groupBy("item").agg(F.first("uses").alias("uses")), "item"))
    rarest = index.groupBy("of_rule").agg(F.min_by("item", F.struct("uses", "item")).alias("item"))
    met = inside.select("row", "items", F.explode("items").alias("item")).join(rarest, "item").filter(F.size(F.array_except("of_rule", "items")) == 0)
    excepted = settle(met.select("row", "items").dropDuplicates(["row"]).withColumn("verdict", F.lit(default)).drop("row"))
    others = _rules(excepted, marked, least, n, min_confidence, 2 * max_items)
    beyond = others.select("tokens", F.explode("tokens").alias("item")).join(rarest, "item").filter(F.size(F.array_except("of_rule", "tokens")) == 0)
    exceptions = _shortest(settle(others.join(beyond.select("tokens").distinct(), "tokens", "left_semi")))

    found = settle(kept.unionByName(exceptions).withColumn("rule_id", F.xxhash64("tokens", "verdict")))
    members = items.groupBy("item").agg(F.collect_list("token").alias("same"), F.first("uses").alias("uses"))
    each = found.select("rule_id", F.explode("tokens").alias("item")).join(members, "item")
    alike = each.groupBy("rule_id").agg(F.array_sort(F.collect_list(F.struct("uses", "item", "same"))).alias("alike"))
    return settle(found.join(alike, "rule_id").select("rule_id", "tokens", F.col("alike.same").alias("alike"), "verdict", "confidence", "support"))


def _rules(chosen: DataFrame, all_baskets: DataFrame, least: int, n: int, min_confidence: float, max_items: int) -> DataFrame:
    """(tokens, verdict, confidence, support): item sets that ``least`` of the chosen baskets hold with their label, as sure as wanted
    among all baskets."""
    empty = chosen.sparkSession.createDataFrame([], "tokens array<string>, verdict string, confidence double, support double")
    size = chosen.count()
    if size < least:
        return empty
    # Half an URL less, so that least / size as a fraction never rounds up to one more.
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / size).fit(chosen)
    own = F.filter("items", lambda x: F.startswith(x, F.lit(LABEL)))
    labelled_sets = model.freqItemsets.filter((F.size(own) == 1) & (F.size("items") > 1) & (F.size("items") <= max_items + 1)).select(
        F.array_sort(F.array_except("items", own)).alias("tokens"), F.substring(own[0], len(LABEL) + 1, 1 << 20).alias("verdict"), F.col("freq").alias("held")
    )
    sets = settle(labelled_sets)
    # How many of all baskets hold a set: each set meets the baskets that hold its rarest item.
    uses = all_baskets.select(F.explode("items").alias("item")).groupBy("item").agg(F.count("*").alias("uses"))
    rarest = sets.select("tokens").distinct().select("tokens", F.explode("tokens").alias("item")).join(uses, "item")
    rarest = rarest.groupBy("tokens").agg(F.min_by("item", F.struct("uses", "item")).alias("item"))
    kinds = all_baskets.groupBy("items").agg(F.count("*").alias("times"))  # equal baskets are looked at once
    met = kinds.select("items", "times", F.explode("items").alias("item")).join(rarest, "item").filter(F.size(F.array_except("tokens", "items")) == 0)
    all_held = met.groupBy("tokens").agg(F.sum("times").alias("freq"))
    rules = sets.join(all_held, "tokens").select(
        "tokens", "verdict", (F.col("held") / F.col("freq")).alias("confidence"), (F.col("held") / F.lit(float(n))).alias("support")
    )
    return settle(rules.filter(F.col("confidence") >= min_confidence))


def _shortest(rules: DataFrame) -> DataFrame:
    """A rule goes if one on a part of its tokens is as sure: drop one token at a time and look for that."""
    shorter = (
        rules.filter(F.size("tokens") > 1)
        .select("tokens", "verdict", "confidence", F.explode("tokens").alias("token"))
        .select(F.col("tokens").alias("whole"), "verdict", F.col("confidence").alias("own"), F.array_remove("tokens", F.col("token")).alias("tokens"))
    )
    spare = shorter.join(rules.select("tokens", "verdict", "confidence"), ["tokens", "verdict"]).filter("confidence >= own")
    return rules.join(spare.select(F.col("whole").alias("tokens"), "verdict").distinct(), ["tokens", "verdict"], "left_anti")


def matches(urls: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, verdict, confidence) for each distinct URL that holds a token of every item of a rule: the surest rule."""
    index = rules.select(F.explode(F.col("alike")[0]).alias("token"), "alike", "verdict", "confidence", "support")
    held = urls.select(F.col(f"`{url}`").alias("url")).distinct().withColumn("own", tokens(F.col("url")))
    met = held.select("url", "own", F.explode("own").alias("token")).join(index, "token")
    whole = met.filter(F.forall("alike", lambda same: F.arrays_overlap(same, F.col("own"))))
    best = F.max(F.struct("confidence", "support", F.when(F.col("verdict") == "block", 1).otherwise(0).alias("blocks"), "verdict"))
    return whole.groupBy("url").agg(best.alias("best")).select("url", "best.verdict", "best.confidence")


def judge(urls: DataFrame, fixed: Sequence[tuple[str, str]], mined: DataFrame, default: str = "allow", into: str = "judged") -> DataFrame:
    """All rows and columns of ``urls`` with a struct, named by ``into``: host, path, rule, verdict, confidence.

    The fixed rule's verdict if one fits, else that of the mined rules, else ``default``. A column
    of that name is replaced; other columns stay.
    """
    found = matches(urls, mined)
    # The row's own columns travel in a struct, so that none has a name of the join's.
    rows = urls.select(F.struct(*[F.col(f"`{c}`") for c in urls.columns]).alias("row"), F.col("url").alias("own_url"))
    joined = rows.join(found, rows["own_url"] == found["url"], "left")
    h, p = host(F.col("own_url")), path(F.col("own_url"))
    rule = fitting_rule(h, p, fixed)
    judged = F.struct(
        h.alias("host"),
        p.alias("path"),
        rule["rule"].alias("rule"),
        F.coalesce(rule["verdict"], F.col("verdict"), F.lit(default)).alias("verdict"),
        F.when(rule.isNull(), F.col("confidence")).alias("confidence"),
    )
    kept = [F.col("row")[c].alias(c) for c in urls.columns if c != into]
    return joined.select(*kept, judged.alias(into))
