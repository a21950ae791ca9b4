"""URL filter: block and allow rules, and gradient-boosted trees on lexical features for the URLs that no rule fits.

The trees are trained on labelled URLs, by default those that a rule decides. Everything is DataFrame functions and the
tree ensemble of Spark's machine-learning library; no Python runs in a task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import written

#: At most about this many labelled URLs train the trees (chosen by a hash of the URL).
LABELLED_SAMPLE = 20_000
TREES = 20
DEPTH = 4
#: A suffix's share of blocked URLs starts from the overall share with this weight.
SMOOTHING = 5.0

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

FEATURES = [
    "length", "host_length", "path_length", "query_length", "depth", "labels", "host_hyphens", "digit_ratio", "entropy",
    "parameters", "suffix_rows", "suffix_blocked", "suffix_length",
]


@dataclass(frozen=True)
class Rule:
    """``host/path`` with the verdict it gives, such as ``Rule("block", "example.com/de/")``."""

    verdict: str
    text: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.text.partition("/")[2]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z in lower case; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end to the next ``?``, ``#`` or end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as ``struct<rule, verdict>``, or null. A rule fits its host and all subdomains if the
    path starts with the rule's; of equally long ones the first of the list wins."""
    chosen = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def parsed(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(page_id, url, host, path, rule, ruled)``; a null url counts as empty."""
    rows = pages.select("page_id", F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("chosen", rule_for(F.col("host"), F.col("path"), rules))
    return rows.select("page_id", "url", "host", "path", F.col("chosen.rule").alias("rule"), F.col("chosen.verdict").alias("ruled"))


def _count(text: Column, what: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _entropy(text: Column) -> Column:
    """Bits per character; zero for an empty text."""
    n = F.length(text).cast("double")
    shares = F.transform(F.array_distinct(F.split(text, "")), lambda c: (n - F.length(F.replace(text, c, F.lit("")))) / n)
    return F.when(n > 0, F.aggregate(shares, F.lit(0.0), lambda acc, p: F.when(p > 0, acc - p * F.log2(p)).otherwise(acc))).otherwise(F.lit(0.0))


def suffix_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def lexical(rows: DataFrame) -> DataFrame:
    """``rows`` with the features that a URL has by itself."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    made = {
        "length": F.length(url), "host_length": F.length(host), "path_length": F.length(path), "query_length": F.length(query),
        "depth": _count(path, "/"), "labels": _count(host, "."), "host_hyphens": _count(host, "-"),
        "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", "")) / F.greatest(F.length(url), F.lit(1)),
        "entropy": _entropy(url), "parameters": F.when(query != "", _count(query, "&") + 1).otherwise(0),
        "suffix": suffix_of(host), "suffix_length": F.length(suffix_of(host)),
    }
    return rows.withColumns({k: v if k == "suffix" else v.cast("double") for k, v in made.items()})


def suffix_table(rows: DataFrame, label: Column) -> DataFrame:
    """``(suffix, n, known, blocked)`` over all rows: how often it occurs, with a label, and with label 1."""
    return rows.groupBy(suffix_of(F.col("host")).alias("suffix")).agg(F.count(F.lit(1)).alias("n"), F.count(label).alias("known"), F.sum(F.coalesce(label, F.lit(0))).alias("blocked"))


def with_features(rows: DataFrame, suffixes: DataFrame, share: float, label: Column | None = None) -> DataFrame:
    """All features. A labelled row's own label does not count in its suffix's share."""
    one, own = (F.lit(0), F.lit(0)) if label is None else (label.isNotNull().cast("int"), F.coalesce(label, F.lit(0)))
    joined = lexical(rows).join(suffixes, "suffix", "left")
    return joined.withColumns({
        "suffix_rows": F.log1p(F.coalesce("n", F.lit(0))),
        "suffix_blocked": (F.coalesce("blocked", F.lit(0)) - own + SMOOTHING * share) / (F.coalesce("known", F.lit(0)) - one + SMOOTHING),
    })


def train(labelled: DataFrame) -> GBTClassificationModel:
    """Trees from rows with the ``FEATURES`` and ``label`` 0 or 1, both of which must occur."""
    ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(labelled).select("features", F.col("label").cast("double").alias("label"))
    return GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, maxBins=32, seed=5, cacheNodeIds=False).fit(ready)


def judge(pages: DataFrame, rules: list[Rule], bound: int = LABELLED_SAMPLE) -> DataFrame:
    """``(page_id, host, path, rule, verdict, score)`` of every row of ``pages (page_id, url)``.

    The verdict is the longest fitting rule's, else the trees': block from score 0.5 on. The URLs that rules decide are
    the labelled ones; a bounded sample of them trains the trees, and suffix statistics are counted over all rows.
    Null and malformed URLs have empty host and path and are judged by the trees like any other. If the rules decide
    no URL, or all alike, there is nothing to learn: the score is then that one share. Repeated rows are each judged;
    an empty table gives no rows; further columns are ignored.
    """
    rows = parsed(pages, rules)
    label = F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0)
    suffixes = written(suffix_table(rows, label), "suffixes")
    known, blocked = suffixes.agg(F.sum("known"), F.sum("blocked")).first()
    known, blocked = known or 0, blocked or 0
    share = blocked / known if known else 0.0
    if 0 < blocked < known:
        chosen = F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, bound / known))
        sample = with_features(rows.where(F.col("ruled").isNotNull() & chosen), suffixes, share, label).withColumn("label", label)
        sample = written(sample.select(*FEATURES, "label"), "labelled-urls")
        if sample.select("label").distinct().count() == 2:
            model = train(sample)
            ready = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(with_features(rows, suffixes, share, label))
            rows = model.transform(ready).withColumn("score", vector_to_array("probability")[1])
    if "score" not in rows.columns:
        rows = rows.withColumn("score", F.lit(share))
    verdict = F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "score")
