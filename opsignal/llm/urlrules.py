"""URL judgement: fixed rules by host and path, then a tree of path templates per host.

The tree turns path segments that vary into wildcards, from the root on: a segment stays literal
under its parent only if enough of the parent's pages have it. Sibling branches whose share of bad
pages does not differ more than chance allows are merged, and a template is rejected where the
smoothed share of bad among its labelled pages is high.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from opsignal.llm.common import materialise

#: A literal segment has this many pages and this share of its parent's.
LEAST_PAGES, LEAST_SHARE = 5, 0.05
#: Segments after these are one.
DEPTH = 8
#: Weight, in labelled pages, of the host's rate on a template, and of the overall rate on a host.
PRIOR = 10
REJECT = 0.5
#: Deviation, in standard errors, up to which a branch is merged with its siblings.
ALIKE = 2.0
WILD = "*"


def host_of(url: Column) -> Column:
    rest = F.substring_index(F.substring_index(F.substring_index(_after(url), "/", 1), "?", 1), "#", 1)
    return F.translate(F.when(_has_host(url), rest).otherwise(F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    rest = F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)
    return F.when(_has_host(url), rest).otherwise(F.lit(""))


def _has_host(url: Column) -> Column:
    return F.coalesce(F.instr(url, "://") > 0, F.lit(False))


def _after(url: Column) -> Column:
    return F.substring(url, F.instr(url, "://") + 3, F.length(url))


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest fitting rule (host and path, such as ``example.net/en/``), else null.

    ``rules`` maps rules to verdicts; they are part of the expression and meant to be few.
    """
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def templates(pages: DataFrame) -> DataFrame:
    """``host, segments, template`` of distinct paths of ``pages`` (``host, segments``)."""
    leaves = materialise(pages.groupBy("host", "segments").agg(F.count("*").alias("n")).withColumn("template", F.lit("")), "paths")
    depth = leaves.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(depth, DEPTH + 1)):
        rows = leaves.withColumn("part", F.get("segments", F.lit(level)))
        parts = rows.filter("part IS NOT NULL").groupBy("host", "template", "part").agg(F.sum("n").alias("n"))
        parts = materialise(parts, "parts")
        parents = parts.groupBy("host", "template").agg(F.sum("n").alias("total"))
        literal = parts.filter(F.col("n") >= LEAST_PAGES).join(parents, ["host", "template"])
        literal = literal.filter(F.col("n") >= LEAST_SHARE * F.col("total")).select("host", "template", "part", F.lit(True).alias("literal"))
        named = rows.join(literal, ["host", "template", "part"], "left")
        step = F.concat("template", F.lit("/"), F.when(F.col("literal"), F.col("part")).otherwise(F.lit(WILD)))
        leaves = materialise(
            named.select("host", "segments", "n", F.when(F.col("part").isNull(), F.col("template")).otherwise(step).alias("template")),
            "templates",
        )
    return leaves.select("host", "segments", "template")


def purity(labelled: DataFrame) -> DataFrame:
    """``host, template, bad_share`` from ``host, template, bad`` (boolean or null)."""
    counts = labelled.groupBy("host", "template").agg(
        F.count_if("bad").alias("bad"), F.count_if(F.col("bad").isNotNull()).alias("known")
    ).withColumn("parent", F.regexp_replace("template", r"/[^/]*$", ""))
    counts = materialise(counts, "purity")
    whole = counts.agg(F.sum("bad").alias("all_bad"), F.sum("known").alias("all_known"))
    hosts = counts.groupBy("host").agg(F.sum("bad").alias("host_bad"), F.sum("known").alias("host_known"))
    base = F.expr("coalesce(all_bad / nullif(all_known, 0), 0)")
    hosts = hosts.crossJoin(F.broadcast(whole)).select(  # a single row
        "host", ((F.col("host_bad") + PRIOR * base) / (F.col("host_known") + PRIOR)).alias("host_rate")
    )
    family = counts.groupBy("host", "parent").agg(F.sum("bad").alias("f_bad"), F.sum("known").alias("f_known"))
    rated = counts.join(family, ["host", "parent"]).withColumn("rate", F.expr("coalesce(f_bad / nullif(f_known, 0), 0)"))
    spread = ALIKE * F.sqrt(F.expr("known * rate * (1 - rate)")) + 1
    rated = rated.withColumn("alike", F.abs(F.col("bad") - F.expr("known * rate")) <= spread)
    merged = rated.filter("alike").groupBy("host", "parent").agg(F.sum("bad").alias("m_bad"), F.sum("known").alias("m_known"))
    both = rated.join(merged, ["host", "parent"], "left").join(hosts, "host")
    bad = F.expr("IF(alike, m_bad, bad)")
    known = F.expr("IF(alike, m_known, known)")
    return both.select("host", "template", ((bad + PRIOR * F.col("host_rate")) / (known + PRIOR)).alias("bad_share"))


def judge(pages: DataFrame, labels: DataFrame, rules: dict[str, str]) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, bad_share``, one row per page.

    ``labels`` is ``page_id, bad``. The host is what stands between the first ``://`` and the next ``/``,
    ``?``, ``#`` or the end, A-Z lower-cased; the path goes on to ``?``, ``#`` or the end. Null urls and
    urls without ``://`` have an empty host and path, and so one template. A page's verdict is that of its
    rule, else block where its template's share of bad pages is at least ``REJECT``. Repeated rows are
    judged each; repeated labels of a page: bad if any is. A null ``page_id`` is kept, unlabelled.
    Further columns are not read. Empty table: no rows.
    """
    url = F.col("url")
    segments = F.filter(F.split("path", "/"), lambda s: s != "")
    tail = F.array(F.array_join(F.slice("segments", F.lit(DEPTH + 1), F.greatest(F.size("segments"), F.lit(1))), "/"))
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path")).withColumn("segments", segments)
    rows = rows.withColumn(
        "segments", F.when(F.size("segments") > DEPTH, F.concat(F.slice("segments", 1, DEPTH), tail)).otherwise(F.col("segments"))
    )
    rows = materialise(rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)), "urls")
    marks = labels.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.max("bad").alias("bad"))
    named = rows.join(templates(rows), ["host", "segments"])
    named = materialise(named.join(marks, "page_id", "left"), "pages")
    shares = purity(named)
    verdict = F.lit(None).cast("string")
    for rule, what in rules.items():
        verdict = F.when(F.col("rule") == rule, F.lit(what)).otherwise(verdict)
    own = F.when(F.col("bad_share") >= REJECT, F.lit("block")).otherwise(F.lit("allow"))
    return named.join(shares, ["host", "template"]).select(
        "page_id", "host", "path", "rule", F.coalesce(verdict, own).alias("verdict"), "template", "bad_share"
    )
