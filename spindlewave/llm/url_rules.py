"""URL filters: fixed rules by host and path, and association rules mined from labelled pages.

Everything runs as DataFrame operations. FP-growth finds combinations of URL tokens that
go with the label ``block``; rules are pruned by confidence, support and by more general
rules that are as sure. A rule is filed under its rarest token, and a URL looks up the
rules of its tokens.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spindlewave.llm.common import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=block"
#: What a mined rule needs: share of its URLs that are labelled bad, and labelled URLs that
#: hold all its tokens (a share of all labelled, and a number).
CONFIDENCE, SUPPORT, FEWEST = 0.6, 0.002, 20


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str  # allow or block


def host(url: str | Column = "url") -> Column:
    """From behind the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    return F.translate(part(url, 1), UPPER, LOWER)


def path(url: str | Column = "url") -> Column:
    """From behind the host up to ?, # or the end; else empty."""
    return part(url, 2)


def part(url: str | Column, group: int) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, "^([^/?#]*)([^?#]*)", group), F.lit(""))


def fixed_rule(rules: list[Rule], host: str | Column = "host", path: str | Column = "path") -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    A rule fits its host and all subdomains, if the path starts with the rule's.
    """
    host, path = (F.col(c) if isinstance(c, str) else c for c in (host, path))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.host + r.path), len(r.host), r.host, r.path)):
        fits = (host == rule.host) | host.endswith("." + rule.host)
        value = F.struct(F.lit(rule.host + rule.path).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits & path.startswith(rule.path), value).otherwise(found)
    return found


def tokens(url: str = "url", host: str = "host", path: str = "path") -> Column:
    """The distinct tokens of a URL.

    Scheme; every label of the host, its last two and the whole; the folders and the
    ending of the path, digits as #; the names of query fields; whether there is a
    fragment. Letters as they are, but for the host.
    """
    labels = F.filter(F.split(host, r"\."), lambda x: x != "")
    folders = F.filter(F.split(F.regexp_replace(path, r"\d+", "#"), "/"), lambda x: x != "")
    query = F.regexp_extract(F.col(url), r"^[^?#]*\?([^#]*)", 1)
    fields = F.filter(F.split(query, "&"), lambda x: x != "")
    ending = F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1)
    one = F.array(
        F.concat(F.lit("scheme="), F.lower(F.regexp_extract(F.col(url), "^([^:/?#]*)://", 1))),
        F.when(F.size(labels) > 1, F.concat(F.lit("site="), F.array_join(F.slice(labels, -2, 2), "."))),
        F.when(F.col(host) != "", F.concat(F.lit("host="), F.col(host))),
        F.when(ending != "", F.concat(F.lit("ending="), ending)),
        F.when(F.instr(F.col(url), "#") > 0, F.lit("fragment")),
    )
    many = [
        F.transform(labels, lambda x: F.concat(F.lit("label="), x)),
        F.transform(folders, lambda x: F.concat(F.lit("folder="), x)),
        F.transform(fields, lambda x: F.concat(F.lit("field="), F.element_at(F.split(x, "="), 1))),
    ]
    return F.array_distinct(F.filter(F.concat(one, *many), lambda x: x.isNotNull()))


def document_id(path: str = "path") -> Column:
    """The number of the document that a page shows: the last part of its path; null without one."""
    return F.try_to_number(F.nullif(F.regexp_extract(path, r"/([0-9]{1,18})(?:\.html)?/?$", 1), F.lit("")), F.lit("9" * 18)).cast("long")


def mine(
    labelled: DataFrame, confidence: float = CONFIDENCE, support: float = SUPPORT,
    fewest: int = FEWEST, most: int | None = None,
) -> DataFrame:
    """Rules from rows (tokens, bad): rule tokens (sorted), confidence, n (URLs with all of them).

    Rules have any number of tokens, or at most ``most``. A rule is dropped if a rule of some of its tokens is as sure. Rows with null tokens
    or null labels teach nothing; without enough rows there are no rules.
    """
    rows = labelled.where("tokens is not null and bad is not null")
    items = F.when(F.col("bad"), F.concat("tokens", F.array(F.lit(BAD)))).otherwise(F.col("tokens"))
    rows = stored(rows.select(items.alias("items"), "bad"), "baskets")
    total = rows.count()
    empty = rows.sparkSession.createDataFrame([], "rule array<string>, confidence double, n long")
    # A rule counts its URLs whatever their label; of those the share ``confidence`` is bad.
    least = max(support * total, fewest)
    if total < least:
        return empty
    model = FPGrowth(itemsCol="items", minSupport=(least * confidence - 1e-6) / total, minConfidence=confidence).fit(rows)
    sets = stored(model.freqItemsets, "itemsets")
    bad = sets.where(F.array_contains("items", BAD) & (F.size("items") > 1))
    if most is not None:
        bad = bad.where(F.size("items") <= most + 1)
    bad = bad.select(F.array_sort(F.array_remove("items", BAD)).alias("rule"), F.col("freq").alias("bad"))
    every = sets.where(~F.array_contains("items", BAD)).select(F.array_sort("items").alias("set"), F.col("freq").alias("n"))
    rules = bad.join(every, F.col("rule") == F.col("set")).drop("set")
    rules = rules.where((F.col("n") >= least) & (F.col("bad") >= confidence * F.col("n")))
    rules = stored(rules.select("rule", (F.col("bad") / F.col("n")).alias("confidence"), "n"), "rules")
    # Rules with a token in common, the shorter one within the longer.
    short = rules.select(F.col("rule").alias("part"), F.col("confidence").alias("sure"), F.explode("rule").alias("token"))
    long = rules.select("rule", "confidence", F.explode("rule").alias("of"))
    pairs = long.join(short, F.col("of") == F.col("token"))
    pairs = pairs.where((F.size("part") < F.size("rule")) & (F.size(F.array_except("part", "rule")) == 0))
    weak = pairs.where("sure >= confidence").select(F.col("rule").alias("weak")).distinct()
    return rules.join(weak, F.col("rule") == F.col("weak"), "left_anti")


def matching(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """The distinct ``url`` of rows (url, tokens) that hold all tokens of a rule: by inverted index."""
    seen = rules.select("rule", F.explode("rule").alias("token"), "n")
    rarity = seen.groupBy("token").agg(F.max("n").alias("often"))
    key = seen.join(rarity.withColumnRenamed("token", "of"), F.col("token") == F.col("of"))
    index = key.groupBy("rule").agg(F.min_by("token", F.struct("often", "token")).alias("key"))
    held = urls.select("url", "tokens", F.explode("tokens").alias("token"))
    held = held.join(index, F.col("token") == F.col("key"))
    return held.where(F.size(F.array_except("rule", "tokens")) == 0).select("url").distinct()


def judged(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], confidence: float = CONFIDENCE,
    support: float = SUPPORT, fewest: int = FEWEST,
) -> DataFrame:
    """page_id, host, path, rule and verdict for every row of ``pages``.

    The verdict is that of the longest fixed rule that fits; else block if a mined rule
    matches, else allow. Rules are mined from the pages whose document is labelled: bad
    is a quality of 0 or a toxicity of 1 in any of its labels. Null URLs and URLs
    without :// have empty host and path and are allowed; repeated rows are judged
    alike; other columns are not read.
    """
    rows = pages.select("page_id", "url", host().alias("host"), path().alias("path"))
    bad = (F.coalesce(F.col("quality"), F.lit(1)) == 0) | (F.coalesce(F.col("toxic"), F.lit(0)) == 1)
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.groupBy(F.col("doc_id").alias("of")).agg(F.max(bad).alias("bad"))
    shown = rows.select(tokens().alias("tokens"), document_id().alias("doc")).where("doc is not null")
    mined = mine(shown.join(known, F.col("doc") == F.col("of")).select("tokens", "bad"), confidence, support, fewest)
    urls = rows.where("host <> ''").select("url", tokens().alias("tokens"))
    hits = matching(urls, mined).select(F.col("url").alias("hit"))
    found = rows.join(hits, F.col("url") == F.col("hit"), "left").withColumn("fixed", fixed_rule(rules))
    verdict = F.coalesce(F.col("fixed.verdict"), F.when(F.col("hit").isNotNull(), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", F.col("fixed.rule").alias("rule"), verdict.alias("verdict"))
