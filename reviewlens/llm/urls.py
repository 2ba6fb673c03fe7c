"""URL filters: host rules first, and a path-template tree per host for what they leave open.

The tree grows level by level. Under each node, path segments of few URLs are variable and become the
wildcard ``*``; branches whose share of bad labelled pages does not differ from the node's own by more than
chance allows merge into the wildcard too. The tree goes as deep as any node of enough URLs has further
segments. A leaf is a template; it is rejected when its share of bad
labelled pages, smoothed towards its host's and that towards all pages', exceeds ``most_bad``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from .common import join_hot, stored, table
from .lines import UPPER
from .registry import QUERIES

DEPTH = 6  # levels that are written out even where a node has few URLs; no bound of the tree
SUPPORT = 20
Z = 2.58
STRENGTH = 5.0
MOST_BAD = 0.5
# Fixed values of the contract.
RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, action) of the longest rule that fits the host or a parent domain and the beginning of the path."""
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit(slash + start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        action = F.when(fits, F.lit(verdict)).otherwise(action)
    return rule, action


def with_template(urls: DataFrame, depth: int = DEPTH, support: int = SUPPORT, z: float = Z) -> DataFrame:
    """``urls`` (id, host, path, bad) with the leaf ``template`` of each path.

    Beyond ``depth`` levels the tree goes on under nodes of which at least ``support`` urls have a further
    segment, however deep; under the others no branch could stand, and what is left of a path is one ``**``.
    """
    spark = urls.sparkSession
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    rows = urls.select("*", segments.alias("segments"), F.lit("").alias("template"), (F.size(segments) > 0).alias("more"))
    schema, paths, level = rows.schema, [], 0
    while True:
        paths.append(scratch_dir(spark, "level"))
        rows.write.parquet(paths[-1])
        # finished rows stay in the files of their level
        growing = spark.read.schema(schema).parquet(paths[-1]).where("more").withColumn("segment", F.get("segments", F.lit(level)))
        counts = growing.groupBy("host", "template", "segment").agg(
            F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad")
        )
        counts = stored(counts, "segments")
        if counts.isEmpty():
            return spark.read.schema(schema).parquet(*paths).where("not more").select(*urls.columns, "template")
        nodes = counts.groupBy("host", "template").agg(
            F.try_divide(F.sum("n_bad"), F.sum("labelled")).alias("share"), F.sum("n").alias("size")
        )
        noise = z * F.sqrt(F.try_divide(F.col("share") * (1 - F.col("share")), F.col("labelled")))
        differs = F.abs(F.try_divide(F.col("n_bad"), F.col("labelled")) - F.col("share")) > noise
        own = F.coalesce((F.col("n") >= support) & (F.col("labelled") > 0) & differs, F.lit(False))
        branches = counts.join(nodes, ["host", "template"]).where(own if level < depth else F.col("size") >= support)
        branches = branches.select("host", "template", "segment", "n", F.when(own, F.col("segment")).otherwise("*").alias("name"))
        joined = join_hot(growing, stored(branches, "branches"), ["host", "template", "segment"], "n", "id", "left")
        # from ``depth`` on, only segments of nodes with few urls have no branch
        name = F.coalesce("name", F.lit("*" if level < depth else "**"))
        more = (F.size("segments") > level + 1) & (F.lit(level < depth) | F.col("name").isNotNull())
        rows = joined.select(*urls.columns, "segments", F.concat("template", F.lit("/"), name).alias("template"), more.alias("more"))
        level += 1


def judge_urls(pages: DataFrame, page_id: str = "page_id", url: str = "url", bad: str = "bad",
               rules: list[tuple[str, str]] = RULES, depth: int = DEPTH, support: int = SUPPORT, z: float = Z,
               strength: float = STRENGTH, most_bad: float = MOST_BAD) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, bad_share), one row per row of ``pages``.

    ``bad`` is 1 or 0 for labelled pages and NULL for others. NULL urls and urls without ``://`` have '' as
    host and path, fit no rule, and share one template. ``rule`` is NULL where none fits; then the template
    decides. Repeated rows count as often as they occur and get equal verdicts. Without labels nothing is
    rejected. Other columns are not returned. An empty table gives no rows.
    """
    urls = pages.select(
        F.col(page_id).alias("id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"),
        F.col(bad).cast("long").alias("bad"),
    )
    rows = stored(with_template(urls, depth, support, z), "templates")
    leaves = stored(
        rows.groupBy("host", "template").agg(
            F.count(F.lit(1)).alias("n"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("n_bad")
        ),
        "leaves",
    )
    hosts = leaves.groupBy("host").agg(F.sum("labelled").alias("host_labelled"), F.sum("n_bad").alias("host_bad"))
    everywhere = leaves.agg(F.coalesce(F.try_divide(F.sum("n_bad"), F.sum("labelled")), F.lit(0.0))).first()[0]
    of_host = (F.col("host_bad") + strength * everywhere) / (F.col("host_labelled") + strength)
    share = (F.col("n_bad") + strength * of_host) / (F.col("labelled") + strength)
    judged = stored(leaves.join(hosts, "host").select("host", "template", "n", share.alias("bad_share")), "judged")
    rule, action = fitting_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_share") > most_bad, "block").otherwise("allow")
    return join_hot(rows, judged, ["host", "template"], "n", "id").select(
        F.col("id").alias("page_id"), "host", "path", rule.alias("rule"), F.coalesce(action, by_method).alias("verdict"),
        "template", "bad_share",
    )


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are labelled through the number in their path, which is the id of the document they show."""
    number = F.regexp_extract(url_path(F.col("url")), r"/(\d{1,18})(?:[/.]|$)", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", number.try_cast("long").alias("doc"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    labels = table(spark, sf_dir, "labels").groupBy(F.col("doc_id").alias("doc")).agg(F.max(bad).alias("bad"))
    return judge_urls(pages.join(labels, "doc", "left"))


QUERIES["op6_url_filter"] = op6_url_filter
