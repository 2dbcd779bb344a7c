"""URL verdicts from rules and, beyond them, from a tree of path templates per host.

Rules come first: a rule (host, path) fits its host and all subdomains when the path starts
with the rule's; the longest one wins. The pages they decide are the labelled ones.

The tree is grown level by level over distinct (host, path) pairs with their counts:

* A segment becomes the wildcard ``*`` when it is variable: it holds a digit, is long, or its
  node has so many children that most occur only a few times.
* Of the constant segments, one stays a branch of its own only if its share of labelled
  blocks differs from its node's by a two-proportion test; the others, being statistically
  alike, merge into the wildcard.

A template is rejected if its smoothed share of labelled blocks reaches one half. The share is
smoothed towards that of the same template path over all hosts, and this one towards the
share over everything, so an unlabelled host takes what is known of its paths elsewhere.

Below a node whose labelled pages are all blocked, all allowed or none at all, no branch can
differ, so the paths there end at once, every further segment a wildcard. Only mixed nodes grow on,
so rounds are as many as mixed nodes are deep, however long a path is.
The SQL joins what lies below ``DEPTH`` levels into one segment, so it compares only where no
path is longer. Every level is two grouped counts that combine before the shuffle, so a hot host
arrives as its distinct paths only. Main path: DataFrame expressions.

Special cases: a null url, or one without ``://``, has an empty host and path, which are a
template of their own; repeated rows count as often as they occur; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rawstrata.llm.common import Workspace, table


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
DEPTH = 4  # of the SQL
LONG_SEGMENT = 24  # characters above which a segment is variable
MANY_CHILDREN = 16  # children of a node that may be mostly rare ...
RARE_SHARE = 4  # ... when there are fewer than so many urls per child
CRITICAL = 9.0  # square of the z value at which two shares differ
HOST_WEIGHT = 4.0  # pseudo-counts of the smoothing
PATH_WEIGHT = 2.0
REJECT = 0.5


def with_parts(pages: DataFrame, id_col: str, url_col: str) -> DataFrame:
    url = F.coalesce(F.col(url_col), F.lit(""))
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring(`{url_col}`, instr(`{url_col}`, '://') + 3)")).otherwise("")
    return (
        pages.select(F.col(id_col).alias("page_id"), rest.alias("rest"))
        .withColumn("raw_host", F.regexp_extract("rest", r"^[^/?#]*", 0))
        .select(
            "page_id",
            F.translate("raw_host", string.ascii_uppercase, string.ascii_lowercase).alias("host"),
            F.regexp_extract(F.expr("substring(rest, length(raw_host) + 1)"), r"^[^?#]*", 0).alias("path"),
        )
    )


def with_rules(parts: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """The longest fitting rule and its verdict. Rules are a short list of parameters."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((F.col("host") == r.host) | F.col("host").endswith(f".{r.host}")) & F.col(
            "path"
        ).startswith(r.path)
        rule = F.when(fits, r.text).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    return parts.select("*", rule.alias("rule"), verdict.alias("ruled"))


def segments(path: Column) -> Column:
    """The path's non-empty segments."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def is_variable(segment: Column) -> Column:
    return segment.rlike("[0-9]") | (F.length(segment) > LONG_SEGMENT)


def grow(paths: DataFrame, level: int) -> DataFrame:
    """Extend every path's template by its segment at this level, or to its end below a node that
    is not mixed. ``grows`` tells which paths go on.

    Node and branch counts are windows' worth of work, but as grouped counts joined back:
    a node with very many children is then never one task's.
    """
    here = paths.withColumn("segment", F.get("segments", F.lit(level)))
    inner = here.filter(F.col("segment").isNotNull())
    branches = inner.groupBy("host", "template", "segment").agg(
        F.sum("n").alias("n"), F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    nodes = branches.groupBy("host", "template").agg(
        F.count("*").alias("children"),
        F.sum("n").alias("all_n"),
        F.sum("labelled").alias("all_labelled"),
        F.sum("blocked").alias("all_blocked"),
    )
    crowded = (F.col("children") >= MANY_CHILDREN) & (
        F.col("all_n") < RARE_SHARE * F.col("children")
    )
    # (k N - n K)^2 against z^2 n K (N - K): no division, so no special case for empty counts
    n, k = F.col("labelled").cast("double"), F.col("blocked").cast("double")
    all_n, all_k = F.col("all_labelled").cast("double"), F.col("all_blocked").cast("double")
    apart = (k * all_n - n * all_k) * (k * all_n - n * all_k)
    differs = apart > F.lit(CRITICAL) * n * all_k * (all_n - all_k)
    mixed = nodes.filter("all_blocked > 0 AND all_blocked < all_labelled")
    own = ~is_variable(F.col("segment")) & ~crowded & differs
    known = branches.join(mixed, ["host", "template"]).select(
        "host", "template", "segment", own.alias("own")
    )
    grown = here.join(known, ["host", "template", "segment"], "left")
    step = F.concat(F.lit("/"), F.when(F.col("own"), F.col("segment")).otherwise("*"))
    rest = F.repeat(F.lit("/*"), F.size("segments") - level)
    return grown.select(
        "host", "path", "segments", "n", "labelled", "blocked",
        F.concat("template", F.when(F.col("own").isNotNull(), step).otherwise(rest)).alias("template"),
        (F.col("own").isNotNull() & (F.size("segments") > level + 1)).alias("grows"),
    )


def purity(paths: DataFrame) -> DataFrame:
    """(host, template, share): smoothed share of labelled blocks of every template."""
    shares = paths.groupBy("host", "template").agg(
        F.sum("labelled").cast("double").alias("labelled"),
        F.sum("blocked").cast("double").alias("blocked"),
    )
    everywhere = shares.groupBy("template").agg(
        F.sum("labelled").alias("t_labelled"), F.sum("blocked").alias("t_blocked")
    )
    overall = everywhere.agg(
        ((F.coalesce(F.sum("t_blocked"), F.lit(0.0)) + F.lit(1.0)) / (F.coalesce(F.sum("t_labelled"), F.lit(0.0)) + F.lit(2.0))).alias("prior")
    )
    by_path = everywhere.crossJoin(F.broadcast(overall)).select(  # one row
        "template",
        (
            (F.col("t_blocked") + F.lit(PATH_WEIGHT) * F.col("prior"))
            / (F.col("t_labelled") + F.lit(PATH_WEIGHT))
        ).alias("path_share"),
    )
    return shares.join(by_path, "template").select(
        "host",
        "template",
        (
            (F.col("blocked") + F.lit(HOST_WEIGHT) * F.col("path_share"))
            / (F.col("labelled") + F.lit(HOST_WEIGHT))
        ).alias("share"),
    )


def url_filter(
    pages: DataFrame,
    *,
    rules: tuple[Rule, ...] = RULES,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """page_id, host, path, rule, verdict, template and the template's smoothed block share."""
    work = Workspace(pages.sparkSession, "url_filter")
    ruled = work.write(with_rules(with_parts(pages, id_col, url_col), rules), "ruled")
    paths = (
        ruled.groupBy("host", "path")
        .agg(
            F.count("*").alias("n"),
            F.count("ruled").alias("labelled"),
            F.count(F.when(F.col("ruled") == "block", 1)).alias("blocked"),
        )
        .select("*", segments(F.col("path")).alias("segments"), F.lit("").alias("template"))
    )
    whole = work.write(paths.withColumn("grows", F.size("segments") > 0), "paths")
    levels, paths = [whole], whole.filter("NOT grows")
    while not levels[-1].filter("grows").isEmpty():
        level = len(levels) - 1
        levels.append(work.write(grow(levels[-1].filter("grows").drop("grows"), level), f"level{level}"))
        paths = paths.unionByName(levels[-1].filter("NOT grows"))
    paths = paths.drop("grows")
    judged = work.write(
        paths.select("host", "path", "template").join(purity(paths), ["host", "template"]),
        "judged",
    )
    work.drop(*levels)
    rejected = F.when(F.col("share") >= REJECT, "block").otherwise("allow")
    return ruled.join(judged, ["host", "path"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", rejected).alias("verdict"),
        "template", F.col("share").alias("block_share"),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter(table(spark, sf_dir, "pages")).drop("block_share")


def _sql() -> str:
    fits = [
        (f"(host = '{r.host}' OR host LIKE '%.{r.host}') AND starts_with(path, '{r.path}')", r)
        for r in sorted(RULES, key=lambda r: -len(r.text))
    ]
    rule = " ".join(f"WHEN {c} THEN '{r.text}'" for c, r in fits)
    verdict = " ".join(f"WHEN {c} THEN '{r.verdict}'" for c, r in fits)
    levels = ""
    for i in range(DEPTH):
        levels += f"""
here{i} AS (SELECT *, segments[{i + 1}] AS segment FROM paths{i}),
branches{i} AS (SELECT host, template, segment, sum(n) AS n, sum(labelled) AS labelled, sum(blocked) AS blocked
  FROM here{i} WHERE segment IS NOT NULL GROUP BY ALL),
nodes{i} AS (SELECT host, template, count(*) AS children, sum(n) AS a_n, sum(labelled) AS a_l, sum(blocked) AS a_b
  FROM branches{i} GROUP BY ALL),
kept{i} AS (SELECT b.host, b.template, b.segment FROM branches{i} b JOIN nodes{i} USING (host, template)
  WHERE NOT regexp_matches(segment, '[0-9]') AND length(segment) <= {LONG_SEGMENT}
    AND NOT (children >= {MANY_CHILDREN} AND a_n < {RARE_SHARE} * children)
    AND pow(blocked::DOUBLE * a_l::DOUBLE - labelled::DOUBLE * a_b::DOUBLE, 2)
      > {CRITICAL}::DOUBLE * labelled::DOUBLE * a_b::DOUBLE * (a_l::DOUBLE - a_b::DOUBLE)),
paths{i + 1} AS (SELECT h.* EXCLUDE (template, segment), h.template || CASE WHEN h.segment IS NULL THEN ''
    WHEN k.segment IS NOT NULL THEN '/' || h.segment ELSE '/*' END AS template
  FROM here{i} h LEFT JOIN kept{i} k ON h.host = k.host AND h.template = k.template AND h.segment = k.segment),"""
    return rf"""
WITH rests AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
hosts AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rests),
parts AS (SELECT page_id, translate(raw_host, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
  regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path FROM hosts),
ruled AS (SELECT *, CASE {rule} END AS rule, CASE {verdict} END AS ruled FROM parts),
distincts AS (SELECT host, path, count(*) AS n, count(ruled) AS labelled, count(*) FILTER (ruled = 'block') AS blocked,
  list_filter(string_split(path, '/'), lambda s: s <> '') AS s FROM ruled GROUP BY host, path),
paths0 AS (SELECT host, path, n, labelled, blocked, '' AS template, CASE WHEN len(s) <= {DEPTH} THEN s
  ELSE list_append(s[1:{DEPTH - 1}], array_to_string(s[{DEPTH}:], '/')) END AS segments FROM distincts),{levels}
shares AS (SELECT host, template, sum(labelled)::DOUBLE AS l, sum(blocked)::DOUBLE AS b FROM paths{DEPTH} GROUP BY ALL),
everywhere AS (SELECT template, sum(l) AS tl, sum(b) AS tb FROM shares GROUP BY ALL),
overall AS (SELECT (coalesce(sum(tb), 0) + 1.0) / (coalesce(sum(tl), 0) + 2.0) AS prior FROM everywhere),
by_path AS (SELECT template, (tb + {PATH_WEIGHT} * prior) / (tl + {PATH_WEIGHT}) AS path_share FROM everywhere, overall),
purity AS (SELECT host, template, (b + {HOST_WEIGHT} * path_share) / (l + {HOST_WEIGHT}) AS share
  FROM shares JOIN by_path USING (template))
SELECT page_id, r.host, r.path, rule, coalesce(ruled, CASE WHEN share >= {REJECT} THEN 'block' ELSE 'allow' END) AS verdict, p.template
FROM ruled r JOIN paths{DEPTH} p ON r.host = p.host AND r.path = p.path
JOIN purity u ON p.host = u.host AND p.template = u.template
"""


SQL = _sql()
