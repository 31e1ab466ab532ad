"""URL filters: explicit rules, and a path-template tree per host.

All of it is DataFrame functions.  Paths are first made into templates by their
form (digit runs and long hexadecimal runs become wildcards) and counted per
host, so that later steps work on templates, not on URLs.  Level by level, a
node with more than ``FANOUT`` children generalises its rare segments (each less than a
share of 1 / ``FANOUT`` of the node) into one wildcard; frequent ones stay branches.  The labels of a
wildcard count as far as they come from different segments: those of one segment say
nothing about another.  Labelled branches below one parent whose rates of bad labels do not differ
from the parent's pooled rate by more than chance are merged.  A template is
rejected if its smoothed share of bad labels reaches ``PURITY``; templates
without labelled evidence are allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from eventide.llm.common import cut

#: Children from which a node is generalised; levels of the tree (the rest of a path is one segment).
FANOUT, LEVELS = 24, 4
#: Pseudo-counts towards an even prior, share of bad labels that rejects, z of the merge test.
SMOOTHING, PURITY, MERGE_Z = 2.0, 0.9, 1.96


def split_url(url: Column) -> tuple[Column, Column]:
    """(host, path): host from after the first ``://`` up to / ? # or the end, A-Z in
    lower case; path from there up to ? # or the end.  Null or no ``://``: empty."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """struct<rule, verdict> of the longest fitting rule (verdict, host, path), else null.
    A rule fits its host and all subdomains if the path starts with the rule's."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[0]))
    pick = None
    for verdict, h, p in longest:
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))
        pick = F.when(fits, out) if pick is None else pick.when(fits, out)
    return pick if pick is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def form(path: Column) -> Column:
    """Segments of a path with variable parts as wildcards."""
    shaped = F.regexp_replace(F.regexp_replace(path, r"(?i)(?<![0-9a-z])(?=[a-f]*[0-9])[0-9a-f-]{16,}(?![0-9a-z])", "<h>"),
                              r"[0-9]+", "<n>")
    return F.split(F.regexp_replace(shaped, r"^/", ""), "/", LEVELS)


def _varied(labelled: DataFrame, path: str) -> DataFrame:
    """(host, path, k): the different labelled segments that a wildcard of the path stands for,
    the fewest of its wildcards; paths without a wildcard have no row."""
    parts = F.split(F.col(path), "/")
    kinds = [F.countDistinct(F.when(F.get(parts, F.lit(i + 1)) == "*", F.get("segments", F.lit(i)))).alias(f"k{i}") for i in range(LEVELS)]
    return labelled.where(F.array_contains(parts, "*")).groupBy("host", path).agg(*kinds).select(
        "host", path, F.least(*[F.nullif(F.col(f"k{i}"), F.lit(0)) for i in range(LEVELS)]).alias("k"))


def template_tree(urls: DataFrame) -> DataFrame:
    """(host, segments, template, bad, good, merged_bad, merged_good) from rows (host, segments,
    bad, good, urls): one row per host and form."""
    # a row per host and form, read by every level: cut here, so that the URLs are read once
    tree = cut(urls.groupBy("host", "segments").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"),
                                                       F.sum("urls").alias("urls")))
    tree = tree.withColumn("prefix", F.lit(""))
    for level in range(LEVELS):
        seg = F.get("segments", F.lit(level))
        tree = tree.withColumn("seg", seg)
        child = tree.where(F.col("seg").isNotNull()).groupBy("host", "prefix", "seg").agg(F.sum("urls").alias("urls"))
        wide = child.groupBy("host", "prefix").agg(F.count("*").alias("n"), F.sum("urls").alias("all")).where(F.col("n") > FANOUT)
        wide = child.join(wide, ["host", "prefix"]).where(F.col("urls") * FANOUT < F.col("all")).select(
            "host", "prefix", "seg", F.lit(True).alias("wide"))
        tree = tree.join(wide, ["host", "prefix", "seg"], "left").withColumn(
            "prefix", F.when(F.col("seg").isNull(), F.col("prefix")).otherwise(
                F.concat("prefix", F.lit("/"), F.when(F.col("wide"), F.lit("*")).otherwise(F.col("seg"))))).drop("wide")
    tree = cut(tree.withColumnRenamed("prefix", "template").drop("seg").withColumn(
        "parent", F.regexp_replace("template", r"/[^/]*$", "")))
    branch = tree.groupBy("host", "parent", "template").agg(F.sum("bad").alias("b"), F.sum("good").alias("g"))
    labelled = tree.where(F.col("bad") + F.col("good") > 0)
    weight = F.coalesce(F.least(F.lit(1.0), F.try_divide(F.col("k"), F.col("b") + F.col("g"))), F.lit(1.0))
    branch = branch.join(_varied(labelled, "template"), ["host", "template"], "left").withColumn("w", weight).select(
        "host", "parent", "template", (F.col("b") * F.col("w")).alias("b"), (F.col("g") * F.col("w")).alias("g"))
    pooled = branch.groupBy("host", "parent").agg(F.sum("b").alias("pb"), F.sum("g").alias("pg"))
    n, rate = F.col("b") + F.col("g"), F.try_divide(F.col("pb"), F.col("pb") + F.col("pg"))
    # A branch is like its siblings if its bad labels are within chance of the pooled rate.
    like = (n > 0) & (F.abs(F.col("b") - n * rate) <= MERGE_Z * F.sqrt(n * rate * (1 - rate)) + 0.5)
    branch = branch.join(pooled, ["host", "parent"]).withColumn("like", F.coalesce(like, F.lit(False)))
    merged = (branch.where("like").groupBy("host", "parent")
              .agg(F.sum("b").alias("b"), F.sum("g").alias("g")))
    # Merged branches may owe their labels to one segment above them.
    alike = labelled.join(branch.where("like").select("host", "template"), ["host", "template"], "left_semi")
    merged = merged.join(_varied(alike, "parent"), ["host", "parent"], "left").withColumn("w", weight).select(
        "host", "parent", (F.col("b") * F.col("w")).alias("merged_bad"), (F.col("g") * F.col("w")).alias("merged_good"))
    branch = branch.join(merged.withColumn("like", F.lit(True)), ["host", "parent", "like"], "left").select(
        "host", "template", F.coalesce("merged_bad", "b").alias("merged_bad"), F.coalesce("merged_good", "g").alias("merged_good"))
    return tree.select("host", "segments", "template", "bad", "good").join(branch, ["host", "template"])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], labels: DataFrame | None = None,
          url_col: str = "url", id_col: str = "page_id") -> DataFrame:
    """(id, host, path, rule, verdict, template, purity), one row per row of ``pages``.

    The verdict is the longest fitting rule's, else the template's: block if its
    smoothed share of bad labels is ``PURITY`` or more.  URLs that a rule decides
    are labelled samples; ``labels`` (id, bad 0/1) adds more.  A null url, or one without
    ``://``, has empty host and path and is judged like any other.  Repeated rows each
    give a row; other columns are not read.  ``rules`` is a short list on the driver."""
    host, path = split_url(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    urls = urls.withColumn("hit", match_rule(F.col("host"), F.col("path"), rules)).withColumn("segments", form(F.col("path")))
    seen = urls.select("host", "segments", (F.col("hit.verdict") == "block").cast("long").alias("bad"),
                       (F.col("hit.verdict") == "allow").cast("long").alias("good"), F.lit(1).cast("long").alias("urls"))
    seen = seen.na.fill(0, ["bad", "good"])
    if labels is not None:
        more = (labels.where(F.col("bad").isNotNull()).groupBy("id").agg(F.max("bad").alias("bad")))
        seen = seen.unionByName(urls.join(more, "id").select(
            "host", "segments", F.col("bad").cast("long").alias("bad"), (1 - F.col("bad")).cast("long").alias("good"),
            F.lit(0).cast("long").alias("urls")))
    tree = template_tree(seen)
    purity = (F.col("merged_bad") + SMOOTHING / 2) / (F.col("merged_bad") + F.col("merged_good") + SMOOTHING)
    verdicts = tree.select("host", "segments", "template", purity.alias("purity"))
    return urls.join(verdicts, ["host", "segments"]).select(
        F.col("id").alias(id_col), "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.verdict"), F.when(F.col("purity") >= PURITY, "block").otherwise("allow")).alias("verdict"),
        "template", "purity")
