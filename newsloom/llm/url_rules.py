"""URL filters: fixed host and path rules, and rules mined from labelled pages.

A fixed rule names a host and the beginning of a path; it fits that host and all of
its subdomains, and the longest fitting rule decides.  Other pages get the mined
rules' verdict.  FP-growth finds the combinations of URL tokens that ``MIN_BAD``
bad pages share, a number that does not grow with the table; they are then counted
over all labelled pages.  A combination becomes a rule when its confidence reaches
its limit and is above the share of bad pages by ``MIN_SIGMAS`` deviations of a
sample of its size, which any share of bad pages leaves within reach, and no rule
with fewer of the same tokens is as confident.  Rules are
matched by an inverted index: each is filed under its rarest token, the pages'
tokens are joined to that index, and what is found is checked for the other tokens.
A page that fits a mined rule is blocked, every other page is allowed.

Tokens are the labels of the host and the segments of the path, marked by kind;
a segment's digits count as one sign.  A label names a page by the same id.

Cases: a null url or one without ``://`` has the empty host and path, no tokens and
the verdict allow; labels that name a page twice count it once, as bad if any says
so; without labels no rule is mined; rows that share a page_id, or have none, are
each judged by their own url; a url may be of any length and have any number of
segments; of equally confident rules the last by name is reported; an empty table gives
an empty one; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.shared import cut, settle

#: (verdict, host, path): fixed rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: Bad pages that hold a combination, share of the pages with the combination that
#: are bad, and its distance from the share of bad pages at large, in standard
#: deviations of as many pages drawn at random.
MIN_BAD = 20
MIN_CONFIDENCE = 0.8
MIN_SIGMAS = 5.0

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def fixed_rule(rules=RULES) -> tuple[Column, Column]:
    """The longest fixed rule that fits the columns host and path, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, name, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        own = F.col("host") == name
        fits = (own | F.endswith("host", F.lit("." + name))) & F.startswith("path", F.lit(start))
        rule = F.when(fits, name + start).otherwise(rule)
        verdict = F.when(fits, word).otherwise(verdict)
    return rule, verdict


def tokens(host: str = "host", path: str = "path") -> Column:
    """The distinct tokens of an address."""
    labels = F.transform(F.filter(F.split(host, r"\."), lambda x: x != ""), lambda x: F.concat(F.lit("host="), x))
    segments = F.transform(
        F.filter(F.split(path, "/"), lambda x: x != ""),
        lambda x: F.concat(F.lit("path="), F.regexp_replace(F.translate(x, _UPPER, _LOWER), "[0-9]+", "0")),
    )
    return F.array_distinct(F.concat(labels, segments))


def mined_rules(
    pages: DataFrame, min_bad: int = MIN_BAD, min_confidence: float = MIN_CONFIDENCE, min_sigmas: float = MIN_SIGMAS
) -> DataFrame:
    """(rule_id, tokens, index_token, support, confidence, lift) from (tokens, bad).

    Rules are as short as can be, which keeps their number down: a token that is a
    rule by itself is in no other, and of tokens that always come together one stands
    for all.  So a path that many bad pages share is a token or two to FP-growth,
    however many segments it has.
    """
    pages = cut(pages.select(F.array_sort("tokens").alias("tokens"), "bad"), "url-labelled")
    total = pages.agg(F.count("*").alias("n"), F.count_if("bad").alias("bad")).first()
    base = total["bad"] / total["n"] if total["n"] else 0.0

    def is_rule(bad: Column, n: Column) -> Column:
        above = (bad / n - base) * F.sqrt(n) >= min_sigmas * (base * (1 - base)) ** 0.5
        return (bad >= min_bad) & (bad / n >= min_confidence) & above

    # Equal pages are counted at once.  Tokens on the same pages have the same sums of their pages' hashes.
    equal = pages.where(F.size("tokens") > 0).groupBy("tokens").agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    marks = [F.sum(F.xxhash64(F.lit(seed), "tokens").cast("decimal(38,0)")).alias(f"mark{seed}") for seed in (1, 2)]
    single = cut(
        equal.select("*", F.explode("tokens").alias("token")).groupBy("token").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), *marks),
        "url-tokens",
    )
    alone = single.where(is_rule(F.col("bad"), F.col("n"))).select(
        F.array("token").alias("tokens"), F.col("token").alias("index_token"), "bad", "n"
    )
    others = single.where(F.col("bad") >= min_bad).where(~is_rule(F.col("bad"), F.col("n")))
    standing = cut(others.groupBy("mark1", "mark2", "n").agg(F.min("token").alias("token")).select("token", F.col("n").alias("spread")), "url-standing")
    names = [F.xxhash64("tokens").alias("h1"), F.xxhash64(F.lit(3), "tokens").alias("h2")]
    reduced = cut(
        equal.select(*names, "n", "bad", F.explode("tokens").alias("token")).join(standing, "token")
        .groupBy("h1", "h2", "n", "bad").agg(F.array_sort(F.collect_list("token")).alias("tokens")),
        "url-reduced",
    )
    baskets = reduced.groupBy("tokens").agg(F.sum("n").alias("n"))
    # One row for each bad page, on the side of the join that can be split where a basket is hot.
    bad = pages.where("bad").select(*names).join(reduced.select("h1", "h2", "tokens"), ["h1", "h2"]).select("tokens")
    # Support is a share of the bad pages; half a page less keeps rounding from asking for one more.
    support = (min_bad - 0.5) / max(bad.count(), min_bad)
    frequent = FPGrowth(itemsCol="tokens", minSupport=support).fit(bad).freqItemsets
    frequent = frequent.where(F.size("items") > 1).select(F.array_sort("items").alias("tokens"), F.col("freq").alias("bad"))

    # Each combination is filed under its rarest token and counted over equal baskets at once.
    filed = cut(
        frequent.select("*", F.explode("tokens").alias("token")).join(standing, "token")
        .groupBy("tokens", "bad").agg(F.min_by("token", F.struct("spread", "token")).alias("index_token")),
        "url-candidates",
    )
    held = (
        baskets.select(F.col("tokens").alias("basket"), "n", F.explode("tokens").alias("index_token"))
        .join(filed, "index_token")
        .where(F.size(F.array_except("tokens", "basket")) == 0)
        .groupBy("tokens", "index_token", "bad").agg(F.sum("n").alias("n"))
    )
    rules = held.where(is_rule(F.col("bad"), F.col("n"))).select("tokens", "index_token", "bad", "n").union(
        alone.select("tokens", "index_token", "bad", "n")
    )
    found = cut(
        rules.select(
            "tokens", "index_token", (F.col("bad") / max(total["n"], 1)).alias("support"), (F.col("bad") / F.col("n")).alias("confidence"),
            (F.col("bad") / F.col("n") / (base or 1.0)).alias("lift"),
        ),
        "url-rules",
    )
    shorter = found.select(F.col("tokens").alias("fewer"), F.col("confidence").alias("held"), F.col("index_token").alias("shared"))
    longer = found.select("tokens", "confidence", F.explode("tokens").alias("shared"))
    implied = (
        longer.join(shorter, "shared")
        .where((F.size("fewer") < F.size("tokens")) & (F.col("held") >= F.col("confidence")))
        .where(F.size(F.array_except("fewer", "tokens")) == 0)
        .select("tokens").distinct()
    )
    rules = found.join(implied, "tokens", "left_anti")
    return cut(rules.withColumn("rule_id", F.array_join("tokens", " & ")), "url-rules")


def matched(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(row, mined_rule, confidence): the most confident rule of each row that fits one."""
    filed = rules.select(F.col("index_token").alias("token"), F.col("tokens").alias("needed"), "rule_id", "confidence")
    hits = (
        pages.select("row", "tokens", F.explode("tokens").alias("token"))
        .join(filed, "token")
        .where(F.size(F.array_except("needed", "tokens")) == 0)
    )
    best = F.max(F.struct("confidence", F.col("rule_id").alias("mined_rule"))).alias("best")
    return hits.groupBy("row").agg(best).select("row", "best.mined_rule", "best.confidence")


def labelled_pages(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(tokens, bad) of the pages that a label names; bad is low quality or toxic."""
    bad = (F.coalesce(F.col("quality") == 0, F.lit(False))) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("page_id")).agg(F.max(bad).alias("bad"))
    return pages.join(marks, "page_id").select("tokens", "bad")


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """(page_id, host, path, rule, verdict, mined_rule, confidence), one row per row of ``pages``."""
    settle(pages.sparkSession)
    read = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
    read = read.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rule, verdict = fixed_rule(rules)
    # Equal addresses are judged once; "row" stands for all of them.
    rows = cut(read.select("*", rule.alias("rule"), verdict.alias("fixed"), F.struct("host", "path").alias("row"), tokens().alias("tokens")), "url-rows")
    mined = mined_rules(labelled_pages(rows, labels))
    found = matched(rows.where("rule IS NULL").dropDuplicates(["row"]), mined)
    by_method = F.when(F.col("mined_rule").isNotNull(), "block").otherwise("allow")
    return rows.join(found, "row", "left").select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", by_method).alias("verdict"), "mined_rule", "confidence"
    )
