"""Judging URLs by given rules, and the rest by association rules mined from labelled URLs.

A URL becomes a set of tokens: top-level domain, registered domain, further host labels, path
segments (runs of digits count as one token), file ending, query keys and scheme. FP-growth mines
the combinations that are frequent together with a label. A mined rule "combination means label"
stays if its support and confidence reach the least ones, it is more confident than the label's
share, it names something of the host, and no rule on fewer of its tokens is as confident.

Rules match by an inverted index: each is filed under its rarest token, the tokens of a URL look
their rules up, and the whole combination is compared. Each distinct URL is judged once, by the
most confident rule that fits it (then the best supported, then block before allow). Support and
confidence are shares of the labelled URLs; those without label say nothing about rules, they are
what the rules are for. What no rule fits is allowed.

Given rules come first. They are a short list of (verdict, host, path): a rule fits its host and
all subdomains if the URL's path starts with the rule's, and the longest wins.

Defined cases: a null URL, or one without ``://``, has empty host and path and no tokens. Repeated
rows are judged alike. With no labels nothing is mined. An empty table gives none. Only the URL
column is read by name; rows travel as a struct, so other columns may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from botiquin.llm.tables import stored

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LABELS = ("=allow", "=block")


@dataclass(frozen=True)
class Mining:
    """Least share of labelled URLs with a combination and its label, the least number of them, and
    the least confidence of a rule.

    The number holds where there are few labels: a share of a few URLs would make every combination of
    their tokens a rule.
    """

    support: float = 0.005
    confidence: float = 0.95
    least: int = 5


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end; A-Z in lower case."""
    host = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_extract(url, "(?s)^.*?://(.*)$", 1)).otherwise("")


def given_rule(
    host: Column, path: Column, rules: list[tuple[str, str, str]]
) -> tuple[Column, Column]:
    """The longest fitting rule as text, and its verdict; null where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a URL, sorted."""
    host, path = host_of(url), path_of(url)
    labels = F.filter(F.split(host, "\\."), lambda x: x != "")
    count = F.size(labels)
    domain = F.array_join(F.slice(labels, F.greatest(count - 1, F.lit(1)), 2), ".")
    further = F.slice(labels, 1, F.greatest(count - 2, F.lit(0)))
    segments = F.filter(F.split(F.regexp_replace(path, "\\.[A-Za-z0-9]+$", ""), "/"), lambda x: x != "")
    query = F.regexp_extract(_rest(url), "\\?([^#]*)", 1)
    keys = F.filter(
        F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]), lambda x: x != ""
    )

    def named(kind: str, values: Column) -> Column:
        return F.transform(values, lambda x: F.concat(F.lit(kind), x))

    single = F.array(
        F.when(count > 0, F.concat(F.lit("tld:"), F.get(labels, count - 1))),
        F.when(count > 1, F.concat(F.lit("domain:"), domain)),
        F.when(path != "", F.concat(F.lit("ending:"), F.regexp_extract(path, "(\\.[A-Za-z0-9]+|/)?$", 1))),
        F.when(host != "", F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(url, "^[^:]*", 0)))),
    )
    digits = F.transform(segments, lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    every = F.concat(single, named("label:", further), named("path:", digits), named("key:", keys))
    return F.array_sort(F.array_distinct(F.filter(every, lambda x: x.isNotNull())))


def mine(labelled: DataFrame, mining: Mining) -> DataFrame:
    """Rules from ``tokens`` and ``label`` (block or allow): rule tokens, label, figures.

    Rows without label are passed over.
    """
    items = F.concat("tokens", F.array(F.concat(F.lit("="), "label")))
    transactions = labelled.where(F.col("label").isNotNull()).select(items.alias("items"))
    support = min(1.0, max(mining.support, mining.least / max(transactions.count(), 1)))
    growth = FPGrowth(itemsCol="items", minSupport=support, minConfidence=mining.confidence)
    found = growth.fit(transactions).associationRules
    of_host = F.exists("antecedent", lambda x: F.substring_index(x, ":", 1).isin("tld", "domain", "label"))
    rules = stored(
        found.where(
            F.col("consequent")[0].isin(*_LABELS)
            & ~F.arrays_overlap("antecedent", F.array(*[F.lit(x) for x in _LABELS]))
            & of_host & (F.col("lift") > 1)
        ).select(
            F.array_sort("antecedent").alias("needed"),
            F.substring(F.col("consequent")[0], 2, 10).alias("says"),
            "confidence", "support",
        ).withColumn("rule_id", F.xxhash64("needed", "says")),
        "url-rules",
    )
    # A rule is redundant where one on fewer tokens with the same label is as confident. The fewer ones
    # are filed under the token that the fewest rules have, which the longer ones have too.
    each = rules.select("rule_id", "needed", "says", "confidence", F.explode("needed").alias("token"))
    uses = each.groupBy("token").count()
    heads = each.join(uses, "token").groupBy("rule_id").agg(
        F.min(F.struct("count", "token")).alias("head")
    )
    general = rules.join(heads, "rule_id").select(
        F.col("needed").alias("fewer"), F.col("says").alias("same"), F.col("confidence").alias("sure"),
        F.col("head.token").alias("token"),
    )
    redundant = each.join(general, "token").where(
        (F.col("same") == F.col("says")) & (F.size("fewer") < F.size("needed"))
        & (F.col("sure") >= F.col("confidence")) & (F.size(F.array_except("fewer", "needed")) == 0)
    ).select("rule_id").distinct()
    return rules.join(redundant, "rule_id", "left_anti")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The best rule for each of the distinct ``url``, ``tokens``: url, says, confidence."""
    heads = rules.select("rule_id", "needed", F.explode("needed").alias("token"))
    uses = urls.select(F.explode("tokens").alias("token")).groupBy("token").count()
    rarest = heads.join(uses, "token", "left").groupBy("rule_id").agg(
        F.min(F.struct(F.coalesce("count", F.lit(0)).alias("uses"), "token")).alias("rarest")
    )
    index = rules.join(rarest, "rule_id").select(
        F.col("rarest.token").alias("token"), "needed", "says", "confidence", "support"
    )
    hits = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token").where(
        F.size(F.array_except("needed", "tokens")) == 0
    )
    best = F.max(F.struct("confidence", "support", "says")).alias("best")
    return hits.groupBy("url").agg(best).select(
        "url", F.col("best.says").alias("says"), F.col("best.confidence").alias("confidence")
    )


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    labelled: DataFrame | None = None,
    mining: Mining = Mining(),
    url_col: str = "url",
) -> DataFrame:
    """``row`` (a struct of all columns), host, path, rule, verdict, and the mined confidence.

    ``labelled`` has ``url`` and ``label``; without it, the URLs that the given rules fit are the
    labelled ones, and mining carries their verdicts on to URLs that no given rule fits.
    """
    rows = pages.select(F.struct("*").alias("row"), F.col(url_col).alias("url"))
    rows = rows.select("row", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = given_rule(F.col("host"), F.col("path"), rules)
    ruled = stored(rows.select("row", "url", "host", "path", rule.alias("rule"), verdict.alias("given")), "url-rows")
    if labelled is None:
        labelled = ruled.select("url", F.col("given").alias("label"))
    mined = stored(
        mine(labelled.where("url is not null").select(tokens_of(F.col("url")).alias("tokens"), "label"), mining),
        "url-mined",
    )
    open_urls = ruled.where("rule is null and host <> ''").select("url").distinct()
    found = match(open_urls.select("url", tokens_of(F.col("url")).alias("tokens")), mined)
    return ruled.join(found.withColumnRenamed("url", "found_url"), F.col("url") == F.col("found_url"), "left").select(
        "row", "host", "path", "rule",
        F.coalesce("given", "says", F.lit("allow")).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("confidence")).alias("mined_confidence"),
    )
