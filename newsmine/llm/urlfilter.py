"""URL filters: rules by host and path, and logistic regression on hashed character n-grams."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with all its subdomains, where the path begins so."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to / ? # or the end, with A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """``name`` or ``verdict`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):  # the longest is asked first
        inside = (host == rule.host) | host.endswith("." + rule.host)
        found = F.when(inside & path.startswith(rule.path), getattr(rule, field)).otherwise(found)
    return found


def labelled_urls(spark: SparkSession) -> DataFrame:
    """A small labelled table (host, path, label): 1 is to be blocked. Grown from word lists by a rule."""
    bad = ["casino", "bets", "poker", "slots", "jackpot", "adult", "xxx", "escort", "porn", "spam", "pills", "viagra", "warez", "cracked", "malware", "phish", "clickbait", "lottery", "ads", "tracking", "cheap", "loans"]
    good = ["news", "library", "school", "museum", "garden", "weather", "travel", "recipes", "science", "health", "history", "music", "forum", "archive", "journal", "theatre", "station", "gazette", "bakery", "bridge", "river", "orchard"]
    # Words that blocked and allowed hosts share, so that they decide nothing.
    plain = ["win", "free", "farm", "x", "online", "my", "best", "live"]
    sounds = ["th", "er", "on", "re", "la", "mi", "sta", "ble", "tion", "ing", "ou", "es", "an", "ly", "ha", "nd"]
    tails = ["example.com", "example.org", "example.net", "com", "de"]
    paths = ["/", "/en/12", "/de/345/", "/fr/6.html", "/es/78", "/en/9.html"]
    fronts = ["", "www.", "m.", "blog."]
    rows = []
    for label, own in ((1.0, bad), (0.0, good)):
        for i, word in enumerate(own):
            names = [word, *(f"{word}-{p}" for p in plain), *(f"{p}-{word}" for p in plain), word + own[i - 1]]
            for k, name in enumerate(names):
                rows.append((f"{fronts[(i + k) % 4]}{name}.{tails[(i + 2 * k) % 5]}", paths[(i + 5 * k) % 6], label))
            rows.append((f"site{i}.{tails[i % 5]}", f"/{word}/{i}", label))
    # Plain names are allowed, so that the parts of ordinary words block nothing.
    for i, a in enumerate(sounds):
        for k, b in enumerate(sounds):
            c = sounds[(i * 7 + k * 3) % len(sounds)]
            rows.append((f"{fronts[(i + k) % 4]}{a}{b}{c}.{tails[(i + 3 * k) % 5]}", paths[(2 * i + k) % 6], 0.0))
    return spark.createDataFrame(rows, "host string, path string, label double")


def grams(text: Column, mark: str, sizes: Sequence[int]) -> Column:
    """Character n-grams of ``^text$``, each with ``mark`` in front."""
    whole = F.concat(F.lit("^"), text, F.lit("$"))
    parts = [
        F.transform(
            F.sequence(F.lit(1), F.greatest(F.length(whole) - (n - 1), F.lit(1))),
            lambda i, n=n: F.concat(F.lit(mark), F.substring(whole, i, F.lit(n))),
        )
        for n in sizes
    ]
    return F.concat(*parts)


def featured(urls: DataFrame, sizes: Sequence[int] = (3, 4, 5)) -> DataFrame:
    return urls.withColumn("_grams", F.concat(grams(F.col("host"), "h", sizes), grams(F.col("path"), "p", sizes)))


def fitted(labelled: DataFrame, features: int = 1 << 18) -> PipelineModel:
    """The classifier; ``labelled`` is a small table by design (host, path, label)."""
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=features, binary=True)
    machine = LogisticRegression(
        featuresCol="_features", labelCol="label", predictionCol="_class", probabilityCol="_share",
        rawPredictionCol="_raw", regParam=0.001, maxIter=100,
    )
    return Pipeline(stages=[hashing, machine]).fit(featured(labelled).coalesce(1))


def url_verdicts(pages: DataFrame, labelled: DataFrame, rules: Sequence[Rule] = RULES, cut: float = 0.5) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages``.

    A null url, or one without ``://``, has an empty host and path, no rule, and
    the verdict allow with a null score: there is nothing to judge. Repeated rows
    and null page_ids are judged like others; other columns are not read. A score
    of exactly ``cut`` blocks. An empty table gives an empty result.
    """
    url = F.col("url").cast("string")
    base = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"))
    scored = fitted(labelled).transform(featured(base))
    share = F.when((F.col("host") != "") | (F.col("path") != ""), vector_to_array("_share")[1])
    host, path = F.col("host"), F.col("path")
    own = F.when(F.col("score") >= cut, "block").otherwise("allow")
    return scored.withColumn("score", share).select(
        "page_id", "host", "path",
        rule_of(host, path, rules, "name").alias("rule"),
        F.coalesce(rule_of(host, path, rules, "verdict"), own).alias("verdict"),
        "score",
    )
