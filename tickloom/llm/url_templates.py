"""URL filters: explicit rules, and a tree of path templates per host judged by the labels that the rules give.

Only DataFrame functions. Each path becomes segments with runs of digits as wildcards. Level by level under every host,
a branch becomes a wildcard if it is one of many small ones, or if what follows it is shaped as under its siblings
together. Templates that are equal after that are one. A template's purity is the share of blocked pages among its
pages that a rule judged, smoothed towards the share over all; templates of high purity are blocked.

A null url, or one without "://", has an empty host and path, no rule, and is allowed. Null page ids and repeated rows
are judged like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ABSENT = ""
# A branch is variable if it has less than this share of its parent's pages among at least MANY siblings.
RARE, MANY = 0.05, 20
# Greatest difference (0 to 2) of two branches' shapes that still counts as similar, beside chance for small ones.
SIMILAR = 0.3
# Weight of the overall share in a template's purity, and the purity from which a template is blocked.
SMOOTHING, BLOCK_FROM = 10.0, 0.8


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith(f".{self.host}")
        return own & path.startswith(self.path)


# The rules of the registered query.
RULES = [
    UrlRule("allow", "com", "/"),
    UrlRule("block", "example.com", "/en/"),
    UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"),
    UrlRule("block", "net", "/fr/"),
]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without "://"."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(rules: list[UrlRule], host: Column, path: Column) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits, or nulls."""
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text))
    none = F.lit(None).cast("string")
    text = F.coalesce(*[F.when(r.fits(host, path), F.lit(r.text)) for r in ordered], none)
    verdict = F.coalesce(*[F.when(r.fits(host, path), F.lit(r.verdict)) for r in ordered], none)
    return text, verdict


def raw_segments(path: Column) -> Column:
    """The segments with digits as wildcards."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(parts, lambda s: F.regexp_replace(s, "[0-9]+", "*"))


def _shape(segment: Column) -> Column:
    """Words as "a": what a segment looks like, whatever it says."""
    return F.regexp_replace(segment, r"\p{L}+", "a")


def _below(rest: str, count: Column | int) -> Column:
    return F.slice(rest, F.lit(1) + count, F.size(rest))


def _descended(tree: DataFrame) -> DataFrame:
    """The tree with segments that all rows of a template share moved into it, and `_open`: is there a branch below?"""
    parent = ["_host", "_t"]
    groups = tree.groupBy(*parent).agg(
        F.min("_rest").alias("_low"), F.max("_rest").alias("_high"), F.min("_left").alias("_least"),
        F.max("_left").alias("_most"),
    )
    # What the first and the last in order begin with, all begin with.
    ends = [F.slice(c, F.lit(1), F.col("_least")) for c in ("_low", "_high")]
    differ = F.array_position(F.zip_with(*ends, lambda a, b: a == b), False).cast("int")
    shared = F.when(differ > 0, differ - 1).otherwise(F.col("_least"))
    groups = groups.withColumn("_shared", shared).select(*parent, "_shared", (F.col("_most") > F.col("_shared")).alias("_open"))
    moved = F.array_join(F.slice("_rest", F.lit(1), F.col("_shared")), "/")
    return tree.join(groups, parent).select(
        "_host",
        "_raw",
        "_n",
        "_bad",
        "_known",
        F.when(F.col("_shared") > 0, F.concat("_t", F.lit("/"), moved)).otherwise(F.col("_t")).alias("_t"),
        _below("_rest", F.col("_shared")).alias("_rest"),
        (F.col("_left") - F.col("_shared")).alias("_left"),
        "_open",
    )


def _merged(tree: DataFrame) -> DataFrame:
    """The tree with variable and similar branches of the next level turned into wildcards.

    `tree` has a row per host and raw template with its pages `_n`, `_t`, the template above this level, `_rest`, the
    segments from this level on, and `_left`, how many of those are still judged.
    """
    parent = ["_host", "_t"]
    more = F.col("_left") > 0
    tree = tree.withColumn("_own", F.when(more, F.get("_rest", F.lit(0))).otherwise(ABSENT))
    after = F.when(more, F.coalesce(F.get("_rest", F.lit(1)), F.lit(ABSENT))).otherwise(ABSENT)
    tree = tree.withColumn("_after", _shape(after))
    cells = tree.groupBy(*parent, "_own", "_after").agg(F.sum("_n").alias("_n"))
    shapes = cells.groupBy(*parent, "_after").agg(F.sum("_n").alias("_shape_n"))
    branches = cells.groupBy(*parent, "_own").agg(F.sum("_n").alias("_own_n"))
    totals = branches.groupBy(*parent).agg(F.sum("_own_n").alias("_all_n"), F.count(F.lit(1)).alias("_siblings"))
    here = F.col("_n") / F.col("_own_n")
    there = F.col("_shape_n") / F.col("_all_n")
    compared = (
        cells.join(shapes, [*parent, "_after"])
        .join(branches, [*parent, "_own"])
        .join(totals, parent)
        .groupBy(*parent, "_own", "_own_n", "_all_n", "_siblings")
        .agg((F.sum(F.abs(here - there) - there) + 1).alias("_distance"))
    )
    rare = (F.col("_siblings") >= MANY) & (F.col("_own_n") < RARE * F.col("_all_n"))
    alike = (F.col("_siblings") > 1) & (F.col("_distance") <= SIMILAR + 1 / F.sqrt("_own_n"))
    wild = (F.col("_own") != ABSENT) & (rare | alike)
    named = compared.select(*parent, "_own", F.when(wild, "*").otherwise(F.col("_own")).alias("_new"))
    step = F.when(F.col("_new") == ABSENT, F.col("_t")).otherwise(F.concat("_t", F.lit("/"), "_new"))
    rest = F.when(F.col("_left") > 0, _below("_rest", 1)).otherwise(F.col("_rest"))
    joined = tree.join(named, [*parent, "_own"]).withColumn("_t", step).withColumn("_rest", rest)
    return joined.withColumn("_left", F.greatest(F.col("_left") - 1, F.lit(0))).drop("_own", "_after", "_new", "_open")


def template_tree(judged: DataFrame) -> DataFrame:
    """Host and raw template to the merged `template` and its `purity`.

    `judged` has `_host`, the raw segments `_raw` and `_bad` (1 blocked, 0 allowed, null without a rule) per page. There are
    as many rounds as branches above one another, not as segments.
    """
    tree = judged.groupBy("_host", "_raw").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_bad").alias("_bad"), F.count("_bad").alias("_known")
    )
    tree = materialize(tree.select("*", F.lit("").alias("_t"), F.col("_raw").alias("_rest"), F.size("_raw").alias("_left")))
    bad, known = tree.agg(F.sum("_bad"), F.sum("_known")).first()
    overall = (bad or 0) / known if known else 0.0
    rows = materialize(_descended(tree))
    done = rows.where(~F.col("_open")).drop("_open")
    while not (live := rows.where("_open")).isEmpty():
        rows = materialize(_descended(_merged(live)))
        done = done.unionByName(rows.where(~F.col("_open")).drop("_open"))
    purity = (F.coalesce(F.sum("_bad"), F.lit(0)) + SMOOTHING * overall) / (F.sum("_known") + SMOOTHING)
    merged = done.groupBy("_host", "_t").agg(purity.alias("_purity"))
    return done.select("_host", "_raw", "_t").join(merged, ["_host", "_t"])


def judge_urls(
    pages: DataFrame, rules: list[UrlRule] | None = None, url: str = "url", keep: list[str] | None = None
) -> DataFrame:
    """Kept columns, `host`, `path`, `rule`, `verdict`, `template` and `purity`."""
    rules = RULES if rules is None else rules
    names = list(keep or ["page_id"])
    clash = {"host", "path", "rule", "verdict", "template", "purity"} & set(names)
    if clash:
        raise ValueError(f"columns would clash: {sorted(clash)}")
    host, path = split_url(F.col(url).cast("string"))
    split = pages.select(*[F.col(c) for c in names], host.alias("_host"), path.alias("_path"))
    rule, verdict = rule_of(rules, F.col("_host"), F.col("_path"))
    judged = split.select(
        "*",
        rule.alias("_rule"),
        verdict.alias("_verdict"),
        raw_segments(F.col("_path")).alias("_raw"),
    ).withColumn("_bad", F.when(F.col("_verdict").isNotNull(), (F.col("_verdict") == "block").cast("int")))
    tree = template_tree(judged.select("_host", "_raw", "_bad"))
    own = F.when(F.col("_purity") >= BLOCK_FROM, "block").otherwise("allow")
    return judged.join(tree, ["_host", "_raw"]).select(
        *names,
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_verdict", own).alias("verdict"),
        F.when(F.col("_t") == "", "/").otherwise(F.col("_t")).alias("template"),
        F.col("_purity").alias("purity"),
    )
