"""URL filters: host and path rules, and rules mined from labels by FP-growth, in DataFrame functions."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the contract: host and path of a rule, and what it says.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BAD = "label:bad"


@dataclass(frozen=True)
class Mining:
    """Support is a share of the labelled urls, confidence that of bad ones among a rule's urls.

    Lift is the confidence over the share of bad ones among all; 1 only asks that
    a rule's urls are no better than all, which some rule can meet at any share.
    """

    support: float = 0.005
    confidence: float = 0.6
    lift: float = 1.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path; both empty for a null or without ``://``."""
    after = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3))
    host = F.regexp_extract(after, "^([^/?#]*)", 1)
    path = F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)
    return (
        F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit("")),
        F.coalesce(path, F.lit("")),
    )


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls. The list of rules is a short parameter."""
    fits, says = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = rule.partition("/")
        fit = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        fits, says = F.when(fit, F.lit(rule)).otherwise(fits), F.when(fit, F.lit(verdict)).otherwise(says)
    return fits, says


def url_tokens(url: Column) -> Column:
    """The different tokens of a url: scheme, host labels, path words and query keys.

    A number in a path counts as ``#``, so that page numbers make no tokens of
    their own.
    """
    host, path = split_url(url)
    scheme = F.array(F.concat(F.lit("scheme:"), F.lower(F.substring_index(url, "://", 1))))
    labels = F.transform(F.split(host, "\\."), lambda x: F.concat(F.lit("host:"), x))
    words = F.transform(
        F.split(F.regexp_replace(path, "[0-9]+", "#"), "[/.]"), lambda x: F.concat(F.lit("path:"), x)
    )
    query = F.regexp_extract(url, "\\?([^#]*)", 1)
    keys = F.transform(
        F.split(query, "&"), lambda x: F.concat(F.lit("query:"), F.substring_index(x, "=", 1))
    )
    found = F.array_distinct(F.concat(scheme, labels, words, keys))
    found = F.filter(found, lambda x: ~x.endswith(":"))
    return F.when(F.instr(url, "://") > 0, found).otherwise(F.array().cast("array<string>"))


def mine_rules(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """``rule_id, tokens, confidence, lift`` of token sets that mark bad urls.

    ``labelled`` has ``tokens`` and ``bad``. FP-growth finds the frequent sets
    of tokens with the label; their number is bounded by the support. Rules
    below the confidence or the lift go, and so do rules that hold another
    rule's tokens, which mark the same urls already.
    """
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(_BAD)))).otherwise(F.col("tokens"))
    baskets = labelled.select(F.array_distinct(items).alias("items")).where("size(items) > 0")
    model = FPGrowth(itemsCol="items", minSupport=mining.support, minConfidence=mining.confidence).fit(baskets)
    rules = model.associationRules.where(
        (F.size("consequent") == 1) & (F.get("consequent", F.lit(0)) == _BAD) & (F.col("lift") >= mining.lift)
    )
    rules = rules.select(
        F.sort_array("antecedent").alias("tokens"), "confidence", "lift"
    ).withColumn("rule_id", F.xxhash64(F.array_join("tokens", "\n")))
    # Inverted index: a rule is looked up under its first token.
    short = rules.select(F.col("rule_id").alias("other"), F.col("tokens").alias("inner"), F.get("tokens", F.lit(0)).alias("t"))
    long = rules.select("rule_id", "tokens", F.explode("tokens").alias("t"))
    held = (F.col("rule_id") != F.col("other")) & (F.size(F.array_except("inner", "tokens")) == 0)
    wider = long.join(short, "t").where(held).select("rule_id").distinct()
    return rules.join(wider, "rule_id", "left_anti")


def judge(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    mining: Mining = Mining(),
) -> DataFrame:
    """Every page with ``host``, ``path``, ``rule``, ``verdict`` and ``mined_rules`` (their number).

    The longest given rule decides: one of ``host/path`` fits its host and all
    subdomains if the url's path starts with its path. Without one, the url is
    blocked if a mined rule's tokens are all among its own.

    ``labelled`` has ``url`` and ``bad``; rows with a null take no part in
    mining. A null url, or one without ``://``, has an empty host and path, no
    tokens and is allowed. Equal urls get equal verdicts. Columns of the five
    names are replaced. An empty table gives an empty one; without labels
    nothing is mined.

    Urls are matched once each: their tokens meet the rules, held under their
    rarest token, in a join that Spark broadcasts if the rules turn out small.
    """
    known = labelled.where("url IS NOT NULL AND bad IS NOT NULL").select(url_tokens(F.col("url")).alias("tokens"), "bad")
    mined = mine_rules(known, mining)
    weight = known.select(F.explode("tokens").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    each = mined.select("rule_id", "tokens", F.explode("tokens").alias("t")).join(weight, "t")
    index = each.groupBy("rule_id").agg(F.min(F.struct("df", "t")).alias("least"), F.first("tokens").alias("needs"))
    index = index.select("needs", F.col("least.t").alias("t"))

    made = ("host", "path", "rule", "verdict", "mined_rules")
    kept = [name for name in pages.columns if name not in made]
    urls = pages.select("url").where("url IS NOT NULL").distinct()
    found = urls.select("url", url_tokens(F.col("url")).alias("tokens"))
    found = found.select("url", "tokens", F.explode("tokens").alias("t")).join(index, "t")
    found = found.where(F.size(F.array_except("needs", "tokens")) == 0)
    found = found.groupBy(F.col("url").alias("_url")).agg(F.count(F.lit(1)).alias("_mined"))

    host, path = split_url(F.col("url"))
    fits, says = rule_of(host, path, rules)
    number = F.coalesce("_mined", F.lit(0))
    verdict = F.coalesce(says, F.when(number > 0, F.lit("block")).otherwise(F.lit("allow")))
    joined = pages.select(*kept).join(found, F.col("url") == F.col("_url"), "left")
    return joined.select(
        *kept,
        host.alias("host"),
        path.alias("path"),
        fits.alias("rule"),
        verdict.alias("verdict"),
        number.alias("mined_rules"),
    )
