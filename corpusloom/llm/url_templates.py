"""URL filter by a tree of path templates per host.

Main path: DataFrame functions only. URLs that an explicit rule decides are the labelled ones; their
verdicts teach the templates that judge all others.

1. Variable parts of a path segment (numbers, long hexadecimal names) become wildcards.
2. Level by level, sibling branches of a host's tree that cannot be told apart, by the share of
   blocked URLs and by how deep the paths below them go, are merged into one wildcard branch.
3. A branch's purity is its share of blocked labels, smoothed towards its parent's: whole table,
   domain, host, then each level of the template. URLs of a template over the threshold are rejected.

All steps after parsing work on one row per (host, generalised path) with its counts, so a host with a third of
all pages is summed up map-side first.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialize

# Levels of a template that are told apart; deeper segments are the last level's one wildcard.
LEVELS = 6
# Siblings within so many standard errors of all siblings together are merged.
ALIKE = 2.0
# Labels that the parent's purity counts for.
SMOOTHING = 4.0
REJECT = 0.5
DEEPER = "**"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path): what follows the first ``://`` up to / ? # or end, A-Z lower-cased; then up to ? # or end.

    Both are empty for NULL and for a URL without ``://``.
    """
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule ``host/path`` that fits, else NULL. A rule fits its host and all subdomains."""
    rule = verdict = F.lit(None).cast("string")
    for text, decided in sorted(rules, key=lambda r: len(r[0])):  # the longest comes last and wins
        own, _, start = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + start)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, decided).otherwise(verdict)
    return rule, verdict


def generalised(path: Column) -> Column:
    """Segments of a path with variable parts as wildcards, at most ``LEVELS`` and one for all deeper ones."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    segments = F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(s, r"\b(?=\w*\d)[0-9a-fA-F]{8,}\b", "{x}"), r"\d+", "{n}"))
    return F.when(F.size(segments) > LEVELS, F.concat(F.slice(segments, 1, LEVELS), F.array(F.lit(DEEPER)))).otherwise(segments)


def _merge_level(paths: DataFrame, level: int) -> DataFrame:
    """``paths`` with the segment at ``level`` of the template replaced where its branch is like its siblings."""
    here = F.size("template") > level
    below = (F.size("template") - F.lit(level + 1)).cast("double")
    rows = paths.withColumn("_parent", F.concat_ws("/", "host", F.slice("template", 1, level))).withColumn(
        "_segment", F.when(here, F.col("template")[level]))
    child = rows.filter(here).groupBy("_parent", "_segment").agg(
        F.sum("pages").alias("pages"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"),
        F.sum(below * F.col("pages")).alias("depth"), F.sum(below * below * F.col("pages")).alias("depth2"),
    )
    child = materialize(child, "branches")
    total = child.groupBy("_parent").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_{c}") for c in ("pages", "labelled", "blocked", "depth", "depth2")],
    )
    share = (F.col("_blocked") + 1) / (F.col("_labelled") + 2)
    label_gap = F.when(F.col("labelled") > 0, F.abs(F.col("blocked") / F.col("labelled") - share) / F.sqrt(share * (1 - share) / F.col("labelled"))).otherwise(0.0)
    mean = F.col("_depth") / F.col("_pages")
    spread = F.sqrt(F.greatest(F.col("_depth2") / F.col("_pages") - mean * mean, F.lit(0.0)) + 0.05)
    depth_gap = F.abs(F.col("depth") / F.col("pages") - mean) / (spread / F.sqrt("pages"))
    alike = child.join(total, "_parent").filter((F.col("_n") > 1) & (label_gap <= ALIKE) & (depth_gap <= ALIKE)).select("_parent", "_segment", F.lit(True).alias("_alike"))
    merged = rows.join(alike, ["_parent", "_segment"], "left").withColumn(
        "template",
        F.when(F.col("_alike"), F.concat(F.slice("template", 1, level), F.array(F.lit("*")), F.slice("template", level + 2, LEVELS + 1))).otherwise(F.col("template")),
    )
    return materialize(merged.drop("_parent", "_segment", "_alike"), "level")


def path_templates(parsed: DataFrame) -> DataFrame:
    """(host, segments, template, blocked_share) of a table (host, segments, label), label 1 blocked, 0 allowed or NULL."""
    paths = materialize(
        parsed.groupBy("host", "segments").agg(
            F.count("*").alias("pages"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked"),
        ).withColumn("template", F.col("segments")), "paths",
    )
    for level in range(LEVELS):
        paths = _merge_level(paths, level)

    whole = paths.agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b")).first()
    prior = ((whole["b"] or 0) + 1) / ((whole["n"] or 0) + 2)
    # Node names of the way down: domain, host, host/first, host/first/second ...
    labels = F.split("host", r"\.")
    domain = F.concat(F.lit("."), F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)))
    way = F.concat(F.array(domain), F.transform(
        F.sequence(F.lit(0), F.size("template")), lambda k: F.concat_ws("/", F.col("host"), F.slice("template", 1, k)),
    ))
    templates = materialize(
        paths.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked"))
        .withColumn("way", way), "templates",
    )
    steps = templates.select("host", "template", "labelled", "blocked", F.posexplode("way").alias("step", "node"))
    nodes = materialize(
        steps.groupBy("step", "node").agg(F.sum("labelled").alias("n"), F.sum("blocked").alias("b")), "nodes",
    )
    # At most LEVELS + 3 steps per template.
    folded = steps.select("host", "template", "step", "node").join(nodes, ["step", "node"]).groupBy("host", "template").agg(
        F.array_sort(F.collect_list(F.struct("step", "n", "b"))).alias("_steps"),
    )
    share = F.aggregate("_steps", F.lit(prior), lambda acc, s: (s["b"] + SMOOTHING * acc) / (s["n"] + SMOOTHING))
    purity = folded.select("host", "template", share.alias("blocked_share"))
    return paths.select("host", "segments", "template").join(purity, ["host", "template"])


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, blocked_share) of every row of ``pages``.

    ``rules`` are (``host/path``, ``allow`` or ``block``). Where none fits, rule is NULL and the verdict is
    the template's.

    - A NULL URL or one without ``://`` has an empty host and path; all of these are one template.
    - Without any labelled URL every share is 1/2, which is not over the threshold: allow.
    - NULL and repeated ids and repeated URLs are kept row by row. An empty table gives no rows.
    - Very long paths keep ``LEVELS`` segments in the template. Other columns, whatever their names, are not read.
    """
    host, path = url_parts(F.col("_url"))
    slim = pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(url_col).alias("_url"))
    parsed = slim.select("page_id", host.alias("host"), path.alias("path"))
    rule, decided = match_rules(F.col("host"), F.col("path"), rules)
    parsed = parsed.select("page_id", "host", "path", rule.alias("rule"), decided.alias("_decided"), generalised(F.col("path")).alias("segments"))
    templates = materialize(
        path_templates(parsed.select("host", "segments", (F.col("_decided") == "block").cast("int").alias("label"))), "judged")
    own = F.when(F.col("blocked_share") > REJECT, "block").otherwise("allow")
    return parsed.join(templates, ["host", "segments"]).select(
        "page_id", "host", "path", "rule", F.coalesce("_decided", own).alias("verdict"),
        F.concat_ws("/", F.lit(""), "template").alias("template"), "blocked_share",
    )
