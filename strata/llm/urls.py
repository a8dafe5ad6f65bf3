"""Judge URLs: given rules first, then the path templates of each host.

A rule names a host and the start of a path, and fits its host and all subdomains; the
longest fitting rule wins. Its verdict also labels the URL for the second step.

The paths of a host form a tree of segments. It is grown from the top, one level a round:
a child that few pages share (less than ``LEAST`` pages, or less than ``SHARE`` of its
parent's) is a variable segment and becomes the wildcard; the other children, at most
1 / ``SHARE`` of a parent, stay literal. Siblings that are statistically alike become one branch:
ordered by their share of bad labels, a sibling joins the branch before it unless the
Hoeffding bound at ``ALPHA`` tells their bad shares, or their shares of pages that end there,
apart. A branch without labels is alike only to others without. Merged branches share their
subtree in the next rounds. Segments below ``DEPTH`` are one tail.

Each leaf of the tree is a template. Its purity is the share of bad among its labelled
pages, smoothed by ``STRENGTH`` pages of the overall share; a template of at least
``LEAST_PURITY`` is rejected, so that templates with few or no labels never are.

URLs are counted by host and path before anything else, and the rows of a (host, path) join
the tree by keys whose skew Spark divides, so a host may hold any share of the pages. Only
the tree's nodes are collected, at most 1 / ``SHARE`` entries a node. The driver learns two numbers:
the overall share and the greatest depth.

Rows: a null URL and one without ``://`` have an empty host and path; they fit no rule and
are allowed. Empty segments do not count. Repeated URLs count as often as they stand. An
empty table gives an empty table. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.support import settle
from strata.session import scratch_dir

LEAST = 20
SHARE = 0.01
ALPHA = 0.05
DEPTH = 6
STRENGTH = 20.0
LEAST_PURITY = 0.8
WILDCARD, TAIL = "*", "**"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What follows the first ``://``, up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case; else empty."""
    found = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """``struct(rule, verdict)`` of the longest of the (verdict, host, path) rules that fit, or null."""
    found = None
    for verdict, name, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        value = F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<rule: string, verdict: string>") if found is None else found


def _alike(a: Column, b: Column) -> Column:
    """True when no test tells two branches apart."""
    margin = math.sqrt(0.5 * math.log(2 / ALPHA))

    def near(part, whole) -> Column:
        p, q, m, n = a[part].cast("double"), b[part].cast("double"), whole(a).cast("double"), whole(b).cast("double")
        return F.abs(p / m - q / n) <= margin * (F.lit(1.0) / F.sqrt(m) + F.lit(1.0) / F.sqrt(n))

    labelled = lambda x: x["bad"] + x["good"]
    none = (labelled(a) == 0) & (labelled(b) == 0)
    both = (labelled(a) > 0) & (labelled(b) > 0)
    same_labels = none | F.when(both, near("bad", labelled)).otherwise(False)
    return same_labels & near("ends", lambda x: x["n"])


def _branches(children: Column) -> Column:
    """Map from segment to the name of its branch, from an array of literal children in order."""
    one = lambda x: F.struct(
        F.array(x["segment"]).alias("segments"), x["n"].alias("n"), x["good"].alias("good"), x["bad"].alias("bad"), x["ends"].alias("ends")
    )

    def add(found: Column, x: Column) -> Column:
        last = F.element_at(found, -1)
        both = F.struct(
            F.concat(last["segments"], F.array(x["segment"])).alias("segments"),
            *[(last[c] + x[c]).alias(c) for c in ("n", "good", "bad", "ends")],
        )
        joined = F.concat(F.slice(found, 1, F.size(found) - 1), F.array(both))
        return F.when((F.size(found) > 0) & _alike(F.get(found, F.size(found) - 1), x), joined).otherwise(
            F.concat(found, F.array(one(x)))
        )

    kind = "array<struct<segments: array<string>, n: bigint, good: bigint, bad: bigint, ends: bigint>>"
    merged = F.aggregate(children, F.expr(f"cast(array() AS {kind})"), add)
    name = lambda s: F.when(F.size(s) == 1, F.get(s, F.lit(0))).otherwise(
        F.concat(F.lit("{"), F.array_join(F.array_sort(s), "|"), F.lit("}"))
    )
    pairs = F.transform(merged, lambda b: F.transform(b["segments"], lambda s: F.struct(s, name(b["segments"]))))
    return F.map_from_entries(F.flatten(pairs))


def templates(urls: DataFrame) -> DataFrame:
    """Add ``template`` to rows of ``host, path, n, good, bad``, one for each host and path.

    ``n`` counts pages; ``good`` and ``bad`` count those with a label. Literal segments have
    ``*{|}`` percent-encoded.
    """
    clean = F.col("path")
    for mark in "*{|}":
        clean = F.replace(clean, F.lit(mark), F.lit(f"%{ord(mark):02X}"))
    segments = F.filter(F.split(clean, "/"), lambda s: s != "")
    rows = settle(urls.select("host", "path", "n", "good", "bad", segments.alias("segments"), F.lit("").alias("template")))
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(DEPTH, deepest)):
        rows = settle(_next_level(rows, level))
    return rows.select(
        "host", "path", "n", "good", "bad",
        F.when(F.size("segments") > DEPTH, F.concat("template", F.lit(f"/{TAIL}"))).otherwise(F.col("template")).alias("template"),
    )


def _stored(df: DataFrame) -> DataFrame:
    """A small table, written and read again: Spark sees its size, and can divide what joins it."""
    path = scratch_dir(df.sparkSession, "urls")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _next_level(rows: DataFrame, level: int) -> DataFrame:
    below = rows.filter(F.size("segments") > level)
    children = below.groupBy("host", "template", F.get("segments", F.lit(level)).alias("segment")).agg(
        *[F.sum(c).alias(c) for c in ("n", "good", "bad")],
        F.sum(F.when(F.size("segments") == level + 1, F.col("n")).otherwise(0)).alias("ends"),
    )
    parents = children.groupBy("host", "template").agg(F.sum("n").alias("total"))
    literal = children.filter(F.col("n") >= LEAST).join(parents, ["host", "template"]).filter(F.col("n") >= SHARE * F.col("total"))
    labelled = F.col("bad") + F.col("good")
    share = F.when(labelled > 0, F.col("bad") / labelled).otherwise(-1.0)
    entry = F.struct(share.alias("share"), (F.col("ends") / F.col("n")).alias("stop"), "segment", "n", "good", "bad", "ends")
    nodes = literal.groupBy("host", "template").agg(F.sort_array(F.collect_list(entry)).alias("children"))
    nodes = _stored(nodes.select("host", "template", _branches(F.col("children")).alias("branches")))
    joined = rows.join(nodes, ["host", "template"], "left")
    branch = F.coalesce(F.try_element_at("branches", F.get("segments", F.lit(level))), F.lit(WILDCARD))
    grown = F.when(F.size("segments") > level, F.concat("template", F.lit("/"), branch)).otherwise(F.col("template"))
    return joined.select("host", "path", "n", "good", "bad", "segments", grown.alias("template"))


def purities(rows: DataFrame) -> DataFrame:
    """One row a template: ``host, template, n, good, bad, purity``."""
    sums = rows.groupBy("host", "template").agg(*[F.sum(c).alias(c) for c in ("n", "good", "bad")])
    good, bad = rows.agg(F.sum("good"), F.sum("bad")).first()
    labelled = (good or 0) + (bad or 0)
    overall = (bad or 0) / labelled if labelled else 0.0
    purity = (F.col("bad") + STRENGTH * overall) / (F.col("bad") + F.col("good") + STRENGTH)
    return sums.withColumn("purity", purity)


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """``page_id, host, path, rule, verdict, template, purity`` for every page."""
    link = F.col(f"`{url}`")
    base = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(link).alias("host"), path_of(link).alias("path"))
    counted = base.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("found", longest_rule(rules, F.col("host"), F.col("path")))
    label = lambda verdict: F.when(F.col("found.verdict") == verdict, F.col("n")).otherwise(F.lit(0).cast("long"))
    rows = templates(counted.select("host", "path", "n", label("allow").alias("good"), label("block").alias("bad")))
    scored = rows.select("host", "path", "template").join(_stored(purities(rows).select("host", "template", "purity")), ["host", "template"])
    found = longest_rule(rules, F.col("host"), F.col("path"))
    own = F.when(F.col("purity") >= LEAST_PURITY, "block").otherwise("allow")
    both = base.join(scored, ["host", "path"]).withColumn("found", found)
    return both.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", own).alias("verdict"),
        "template", "purity",
    )
