"""URL filter: fixed host and path rules first, mined association rules for the rest.

Urls become sets of tokens: labels of the host, segments of the path, names of query
parameters. Tokens that always stand together in the labelled urls become one item, since
n of them would make 2**n combinations of one support. Spark's FP-growth mines the item
combinations of labelled urls; rules that lead to a label are pruned by support and
confidence. Each rule is filed in an inverted index under the rarest of its items, so that
common items lead nowhere, and a url is matched with the rules filed under its items.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.lookup import POSITION, with_position
from tallyloom.runtime import materialize

#: Share of the labelled urls that a token combination must have, with its label.
MIN_SUPPORT = 0.002
MIN_CONFIDENCE = 0.8
#: And as many of them at least.
MIN_COUNT = 1
#: A url of more items leaves out of its combinations items that decide alone.
MAX_ITEMS = 12
VERDICTS = ["allow", "block"]
_LABEL = "label="
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``verdict`` for a host with its subdomains and the paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def split_url(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, query) of a url; all empty for null and where ``://`` is absent."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    tail = F.substring(rest, F.char_length(host) + 1, F.char_length(rest))
    path = F.regexp_extract(tail, r"^[^?#]*", 0)
    query = F.regexp_extract(tail, r"^[^?#]*\?([^#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path, query


def best_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as (rule, verdict); null if none does. Of rules of
    the same length the first in the order of their names."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        value = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value).otherwise(found)
    return found


def tokens(host: Column, path: Column, query: Column) -> Column:
    """Distinct tokens of a url. Numbers are one token: they differ on every page."""
    def named(prefix: str, parts: Column) -> Column:
        filled = F.filter(parts, lambda p: p != "")
        return F.transform(filled, lambda p: F.concat(F.lit(prefix), F.regexp_replace(p, "[0-9]+", "0")))

    names = F.transform(F.split(query, "&"), lambda p: F.substring_index(p, "=", 1))
    return F.array_distinct(F.concat(named("host:", F.split(host, r"\.")), named("path:", F.split(path, "/")),
                                     named("query:", names)))


def merged_tokens(labelled: DataFrame) -> DataFrame:
    """(token, item, n): tokens that stand in exactly the same labelled urls are one item,
    named after the first of them. Their urls are compared by two sums of hashes of ``_row``."""
    seen = labelled.where(F.col("label").isNotNull()).select("_row", F.explode("tokens").alias("token"))
    marks = [F.sum(F.xxhash64("_row", F.lit(seed)).cast("decimal(38,0)")).alias(f"_mark{seed}") for seed in (1, 2)]
    signed = seen.groupBy("token").agg(F.count(F.lit(1)).alias("_n"), *marks)
    same = signed.groupBy("_n", "_mark1", "_mark2").agg(F.min("token").alias("item"))
    return signed.join(same, ["_n", "_mark1", "_mark2"]).select("token", "item", F.col("_n").alias("n"))


def as_items(urls: DataFrame, items: DataFrame, *keep: str) -> DataFrame:
    """``urls`` with (n, item, token) of their tokens, the rarest item first, in place of
    tokens; a token without an item is left out. ``_row`` tells urls apart."""
    split = urls.select("_row", F.explode("tokens").alias("token")).join(items, "token")
    per_row = split.groupBy("_row").agg(F.array_sort(F.collect_list(F.struct("n", "item", "token"))).alias("_found"))
    joined = urls.select("_row", *keep).join(per_row, "_row", "left")
    none = F.array().cast("array<struct<n:bigint,item:string,token:string>>")
    return joined.select("_row", *keep, F.coalesce("_found", none).alias("found")).withColumn(
        "items", F.array_distinct(F.transform("found", lambda x: x["item"])))


def baskets_of(known: DataFrame, alone: DataFrame, max_items: int) -> DataFrame:
    """(items, label) to combine. n items have 2**n combinations, so a url of more than
    ``max_items`` items takes part with all items that have urls of both labels, and only
    fills up to that number with the rarest that decide alone.

    This changes no rule's confidence: every url with such an item has the same label, and
    so has every combination with it, which is as sure as the item alone, and no more.
    """
    decides = alone.where(F.greatest(*VERDICTS) == F.col("_all")).select("item", F.lit(True).alias("_decides"))
    long = with_position(known.select("items", "label")).where(F.size("items") > max_items)
    marked = long.select(POSITION, "label", F.posexplode("items").alias("_at", "item")).join(decides, "item", "left")
    mixed_first = F.array_sort(F.collect_list(F.struct(F.coalesce("_decides", F.lit(False)).alias("decides"), "_at", "item")))
    cut = marked.groupBy(POSITION, "label").agg(mixed_first.alias("_found")).select(
        F.slice(F.transform("_found", lambda x: x["item"]), F.lit(1),
                F.greatest(F.lit(max_items), F.size(F.filter("_found", lambda x: ~x["decides"])))).alias("items"), "label")
    return known.where(F.size("items") <= max_items).select("items", "label").unionByName(cut)


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
         min_count: int = MIN_COUNT, max_items: int = MAX_ITEMS) -> DataFrame:
    """(rule_id, antecedent, verdict, confidence, support) from (items, label), items from
    the rarest to the commonest.

    A combination counts with ``min_support`` of the labelled urls and ``min_count`` of
    them. A url takes part with all its items alone and in combinations; beyond
    ``max_items``, see ``baskets_of``, no combination is left out that is surer than its items.
    """
    known = labelled.where(F.col("label").isNotNull() & (F.size("items") > 0))
    total = known.count()
    least = max(min_support * total, min_count)
    name = F.concat(F.lit(_LABEL), "label")
    alone = known.select("label", F.explode("items").alias("item")).groupBy("item").agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(F.col("label") == v).alias(v) for v in VERDICTS])
    singles = alone.select(
        F.array("item").alias("antecedent"), "_all",
        F.explode(F.array(*[F.struct(F.lit(v).alias("verdict"), F.col(v).alias("n")) for v in VERDICTS])).alias("e"))
    singles = singles.where(F.col("e.n") >= least).select(
        "antecedent", "e.verdict", (F.col("e.n") / F.col("_all")).alias("confidence"),
        (F.col("e.n") / F.lit(max(total, 1))).alias("support")).where(F.col("confidence") >= min_confidence)
    baskets = baskets_of(known, alone, max_items).select(F.concat("items", F.array(name)).alias("items"))
    # the fit rounds a share up to whole urls
    support = min_support if min_support * total >= min_count else min(1.0, (min_count - 0.5) / max(total, 1))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence).fit(baskets)
    verdict = F.get("consequent", F.lit(0))
    rules = model.associationRules.where(
        verdict.startswith(_LABEL) & ~F.exists("antecedent", lambda t: t.startswith(_LABEL)) & (F.size("antecedent") > 1))
    # a longer rule that is no surer than a shorter one still names the same verdict; both stay
    longer = rules.select(F.array_sort("antecedent").alias("antecedent"),
                          F.substring(verdict, len(_LABEL) + 1, 1000).alias("verdict"), "confidence", "support")
    return singles.unionByName(longer).withColumn("rule_id", F.concat_ws(" ", "antecedent"))


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(_row, verdict, confidence, rule_id): the best mined rule of every url of
    ``as_items`` that has one: the surest, then the longest, then the best supported."""
    seen = urls.select(F.explode("items").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    filed = rules.withColumn("item", F.explode("antecedent")).join(seen, "item").groupBy("rule_id", "verdict").agg(
        F.min(F.struct("n", "item")).alias("key"), F.first("antecedent").alias("antecedent"),
        F.first("confidence").alias("confidence"), F.first("support").alias("support"))
    index = materialize(filed.select(F.col("key.item").alias("item"), "rule_id", "antecedent", "verdict",
                                     "confidence", "support"), "url-index")
    hits = urls.select("_row", "items", "found", F.explode("items").alias("item")).join(index, "item").where(
        F.size(F.array_except("antecedent", "items")) == 0)
    # a rule is named by the tokens of the url that its items stand for
    named = F.array_sort(F.transform(F.filter("found", lambda x: F.array_contains("antecedent", x["item"])), lambda x: x["token"]))
    hits = hits.withColumn("named", named)
    best = F.max(F.struct("confidence", F.size("named").alias("words"), "support",
                          F.concat_ws(" ", "named").alias("rule_id"), "verdict"))
    return hits.groupBy("_row").agg(best.alias("best")).select(
        "_row", "best.verdict", "best.confidence", "best.rule_id")


def judge(pages: DataFrame, rules: Sequence[Rule], min_support: float = MIN_SUPPORT,
          min_confidence: float = MIN_CONFIDENCE, default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, confidence and
    mined_rule. The urls that a fixed rule decides are the labels to mine from; a url
    that neither a fixed nor a mined rule decides gets ``default``.

    A null url, or one without ``://``, has empty host and path and no tokens. Repeated
    pages are judged alike and count as often as they occur. Other columns are not
    looked at.
    """
    host, path, query = split_url(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"), query.alias("query"))
    parsed = parsed.select(
        "page_id", "host", "path", best_rule(F.col("host"), F.col("path"), rules).alias("fixed"),
        tokens(F.col("host"), F.col("path"), F.col("query")).alias("tokens"))
    parsed = materialize(parsed.withColumn("_row", F.monotonically_increasing_id()), "url-pages")
    labelled = parsed.where(F.col("fixed").isNotNull()).select("_row", "tokens", F.col("fixed.verdict").alias("label"))
    items = materialize(merged_tokens(labelled), "url-items")
    mined = materialize(mine(materialize(as_items(labelled, items, "label"), "url-baskets"), min_support, min_confidence),
                        "url-rules")
    found = match(as_items(parsed.where(F.col("fixed").isNull()), items), mined)
    joined = parsed.join(found, "_row", "left")
    return joined.select(
        "page_id", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce("fixed.verdict", "verdict", F.lit(default)).alias("verdict"), "confidence",
        F.col("rule_id").alias("mined_rule"))
