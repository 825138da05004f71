"""URL filter: host/path rules, then logistic regression on hashed character
n-grams of host and path.  DataFrame functions and MLlib only.

Defined cases: a null url, or one without ``://``, has an empty host and path;
it fits no rule and the model judges it as an empty string.  Rows keep all
their columns; columns named like the results are replaced.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_RULES = 10_000  # rules are part of the plan; a longer list is refused
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """``struct(rule, action)`` of the longest rule that fits, else null.  A rule
    ``host/path`` fits its host and every subdomain when the path starts with
    its path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    by_host: dict[str, list] = {}
    for rule, action in rules:
        name, slash, rest = rule.partition("/")
        by_host.setdefault(name, []).append(F.struct(
            F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(action).alias("action"),
            F.lit(slash + rest).alias("path")))
    if not by_host:
        return F.lit(None).cast("struct<size:int,rule:string,action:string,path:string>")
    book = F.create_map(*[x for name, own in by_host.items() for x in (F.lit(name), F.array(*own))])
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.flatten(F.transform(suffixes, lambda s: F.coalesce(F.try_element_at(book, s), F.array().cast(
        "array<struct<size:int,rule:string,action:string,path:string>>")))), lambda r: F.startswith(path, r["path"]))
    return F.array_max(fits)


def grams(text: Column, n: int, mark: str) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))),
                       lambda i: F.concat(F.lit(mark), F.substring(padded, i, F.lit(n))))


def with_grams(urls: DataFrame) -> DataFrame:
    """Adds the character 3- and 4-grams of host and path as ``__grams``."""
    h, p = host(F.col("url")), F.translate(path(F.col("url")), UPPER, LOWER)
    return urls.withColumn("__grams", F.concat(grams(h, 3, "h:"), grams(h, 4, "h:"), grams(p, 3, "p:"), grams(p, 4, "p:")))


def fit(labelled: DataFrame, features: int = 1 << 15) -> PipelineModel:
    """Fits ``labelled(url, label)`` with label 1 for urls to block."""
    return Pipeline(stages=[
        HashingTF(inputCol="__grams", outputCol="__features", numFeatures=features, binary=True),
        LogisticRegression(featuresCol="__features", labelCol="label", regParam=0.01, rawPredictionCol="__raw",
                           probabilityCol="__probability", predictionCol="__prediction"),
    ]).fit(with_grams(labelled))


def judge(urls: DataFrame, model: PipelineModel, rules: Sequence[tuple[str, str]], cutoff: float = 0.5) -> DataFrame:
    """Every row with ``host, path, rule, verdict`` and the model's ``risk``."""
    names = [c for c in urls.columns if c not in ("host", "path", "rule", "verdict", "risk")]
    scored = model.transform(with_grams(urls.select(*names)))
    scored = scored.withColumn("risk", vector_to_array("__probability")[1])
    scored = scored.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    scored = scored.withColumn("__rule", longest_rule(F.col("host"), F.col("path"), rules))
    verdict = F.coalesce(F.col("__rule.action"), F.when(F.col("risk") > cutoff, "block").otherwise("allow"))
    return scored.select(*names, "host", "path", F.col("__rule.rule").alias("rule"), verdict.alias("verdict"), "risk")


# A small labelled URL table of everyday and unwanted site names.
WANTED_SITES = ("www.citylibrary.org", "news.dailypost.com", "docs.openmanual.net", "blog.gardennotes.com", "www.riverschool.edu",
                "museum.history.org", "recipes.homekitchen.net", "www.trainguide.de", "forum.woodwork.com", "wiki.plants.org",
                "www.weatherstation.net", "science.journal.org", "www.lemondeverte.fr", "travel.hikingtrails.com", "www.bookreview.net",
                "en.encyclopedia.org", "support.printerhelp.com", "www.stadtarchiv.de", "blog.thoughtson.net", "m.theatretimes.com",
                "www.nationalpark.gov", "code.tutorials.dev", "www.musicteacher.org", "noticias.elpueblo.es", "www.healthservice.net",
                "blog.therapist.com", "www.shoretown.net", "m.thermal.org", "www.tionary.net", "blog.thenorth.example.com")
UNWANTED_SITES = ("www.casino-bonus.com", "casino-royal.net", "win-lottery.org", "free-bets.com", "www.sports-bets.net", "spam-mail.com",
                  "link-farm.org", "www.spam-links.net", "cheap-pills.com", "online-pills.net", "cheap-watches.org", "adult-chat.com",
                  "www.adult-video.net", "xxx-adult-x.org", "ads-server.com", "track-clicks.net", "www.ads-track.org", "free-money.com",
                  "poker-win.net", "hot-singles.org")
# Ends of example urls.
TAILS = ("/", "/en/12", "/fr/345.html", "/de/678/", "/es/90?page=2", "/en/article-7#top")


def labelled_urls(spark) -> DataFrame:
    """``(url, label)``: the small labelled table the query trains on."""
    rows = [(f"https://{site}{tail}", float(label)) for label, sites in ((0, WANTED_SITES), (1, UNWANTED_SITES))
            for site in sites for tail in TAILS]
    return spark.createDataFrame(rows, "url string, label double")
