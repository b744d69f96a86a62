"""URL filtering with a tree of path templates per host.

Paths are cut into segments; runs of digits are generalised first. From the host down, a branch keeps its segment as
a literal only if its labelled pages differ significantly from its siblings' (two-proportion z test); all other
branches are statistically alike and merge under a wildcard. A template, host and segments, is rejected if the share
of bad pages among its labelled ones is high, smoothed towards the share of the same template over all hosts, which in
turn is smoothed towards that of all labelled pages. Rules with a host and a path prefix come before templates.

Pages are labelled from two sources: the rules that fit them, and words of the host name that junk sites call themselves
by. Such a word makes a page suspect, not blocked: its template must gather enough of them against the smoothing, and a
template of mostly good pages stays allowed whatever one host in it is called.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tapeglass.llm.common import staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MAX_DEPTH = 4
SIGNIFICANT = 1.96
SMOOTHING = 5.0
REJECT_FROM = 0.5
#: Words of a host name, between its dots and hyphens, that label a page as bad.
JUNK_WORDS = (
    "ads", "adult", "bet", "bets", "casino", "cheap", "escort", "lottery", "pills", "poker", "porn", "spam", "viagra", "xxx",
)


@dataclass(frozen=True)
class Rule:
    """`host` and its subdomains, paths that start with `path`."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _rest(url: Column) -> Column:
    """What follows the first ://, NULL without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    """Up to the first of / ? #, A-Z lower-cased; empty for NULL and for URLs without ://."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ? or #; empty for NULL and for URLs without ://."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (name, verdict) of the longest rule that fits, the first in the alphabet of equally long ones."""
    chosen = F.lit(None).cast("struct<name:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (-len(r.name), r.name), reverse=True):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _segment(depth: int, max_depth: int) -> Column:
    """The generalised segment at a depth; what lies deeper than the tree counts as one segment; NULL: the path ended."""
    segments = F.filter(F.split(F.regexp_replace("path", "[0-9]+", "<n>"), "/"), lambda s: s != "")
    if depth < max_depth:
        return F.get(segments, F.lit(depth - 1))
    below = F.slice(segments, max_depth, F.greatest(F.size(segments), F.lit(1)))
    return F.when(F.size(below) > 0, F.array_join(below, "/"))


def path_templates(pages: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """(host, s1 .. , template, labelled, bad) of every distinct generalised path of (host, path, bad) pages.

    bad is 1, 0 or NULL for pages without a label. The tree is built on counts by host and generalised path, so a
    host of very many pages is added up before it is shuffled. Every level is staged: the next one reads it thrice.
    """
    names = [f"s{d}" for d in range(1, max_depth + 1)]
    cut = pages.select("host", "bad", *[_segment(d, max_depth).alias(n) for d, n in enumerate(names, 1)])
    level = cut.groupBy("host", *names).agg(F.count("bad").alias("labelled"), F.sum("bad").alias("bad"))
    level = level.withColumns({"bad": F.coalesce("bad", F.lit(0)), "template": F.col("host")})
    level = staged(level, "url-paths")
    for name in names:
        branch = level.groupBy("host", "template", name).agg(F.sum("labelled").alias("_l"), F.sum("bad").alias("_b"))
        parent = branch.groupBy("host", "template").agg(F.sum("_l").alias("_pl"), F.sum("_b").alias("_pb"))
        # NULL where the branch or its siblings have no label: not literal.
        own, others = (F.nullif(n, F.lit(0)) for n in (F.col("_l"), F.col("_pl") - F.col("_l")))
        pooled = F.col("_pb") / F.nullif(F.col("_pl"), F.lit(0))
        spread = F.sqrt(pooled * (1 - pooled) * (F.lit(1.0) / own + F.lit(1.0) / others))
        apart = F.abs(F.col("_b") / own - (F.col("_pb") - F.col("_b")) / others)
        literal = (spread > 0) & (apart >= SIGNIFICANT * spread)
        grown = F.concat("template", F.lit("/"), F.when(literal, F.col(name)).otherwise(F.lit("*")))
        named = (
            branch.where(F.col(name).isNotNull())
            .join(parent, ["host", "template"])
            .select("host", "template", name, grown.alias("_grown"))
        )
        # A path that has ended keeps its template: NULL joins nothing.
        grown_level = level.join(named, ["host", "template", name], "left").withColumn(
            "template", F.coalesce("_grown", "template")
        )
        level = staged(grown_level.drop("_grown"), "url-level")
    return level.select("host", *names, "template", "labelled", "bad")


def judged_templates(templates: DataFrame, smoothing: float = SMOOTHING) -> DataFrame:
    """(template, labelled_pages, bad_share) with the smoothed share of bad pages of every template."""
    shape = F.expr("substring(template, length(host) + 1)")
    own = templates.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("bad").alias("b"))
    own = own.withColumn("shape", shape)
    shapes = own.groupBy("shape").agg(F.sum("l").alias("sl"), F.sum("b").alias("sb"))
    overall = shapes.agg(F.sum("sl").alias("tl"), F.sum("sb").alias("tb"))
    everywhere = (F.col("tb") + 1.0) / (F.col("tl") + 2.0)
    alike = (F.col("sb") + smoothing * everywhere) / (F.col("sl") + smoothing)
    shares = shapes.join(F.broadcast(overall)).select("shape", alike.alias("prior"))
    share = (F.col("b") + smoothing * F.col("prior")) / (F.col("l") + smoothing)
    return own.join(shares, "shape").select("template", F.col("l").alias("labelled_pages"), F.round(share, 9).alias("bad_share"))


def judge_urls(
    pages: DataFrame, rules: list[Rule], max_depth: int = MAX_DEPTH, smoothing: float = SMOOTHING,
    reject_from: float = REJECT_FROM, key: str = "page_id", url: str = "url", junk_words: tuple[str, ...] = JUNK_WORDS,
    held_out: Column | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, template, labelled_pages, bad_share) of every page.

    Pages that a rule fits get its verdict and label the templates, and so do pages whose host name holds one of
    `junk_words`; pages without a rule get their template's verdict: block if its smoothed share of bad pages reaches
    `reject_from`, else allow. Pages that `held_out` holds for label nothing, so that verdicts can be measured on them. NULL and malformed URLs have empty host and path
    and share a template; without any label nothing differs and every share is one half. Repeated rows are
    judged alike and kept, an empty table gives no rows, other columns are not read.
    """
    aside = F.lit(False) if held_out is None else F.coalesce(held_out, F.lit(False))
    read = pages.select(F.col(key), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), aside.alias("aside"))
    ruled = read.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    suspect = F.arrays_overlap(F.split("host", "[.-]"), F.array(*map(F.lit, junk_words))) if junk_words else F.lit(False)
    blocked = F.when(F.col("fit").isNotNull(), (F.col("fit.verdict") == "block").cast("long")).when(suspect, 1)
    names = [f"s{d}" for d in range(1, max_depth + 1)]
    label = F.when(~F.col("aside"), blocked)
    templates = path_templates(ruled.select("host", "path", label.alias("bad")), max_depth)
    judged = templates.drop("labelled", "bad").join(judged_templates(templates, smoothing), "template")
    cut = ruled.withColumns({n: _segment(d, max_depth) for d, n in enumerate(names, 1)}).alias("p")
    same = F.col("p.host") == F.col("t.host")
    for n in names:
        same = same & F.col(f"p.{n}").eqNullSafe(F.col(f"t.{n}"))
    by_template = F.when(F.col("bad_share") >= reject_from, "block").otherwise("allow")
    return cut.join(judged.alias("t"), same, "left").select(
        F.col(f"p.{key}").alias(key), "p.host", "p.path",
        F.col("p.fit.name").alias("rule"),
        F.coalesce("p.fit.verdict", by_template).alias("verdict"),
        "t.template", "t.labelled_pages", "t.bad_share",
    )
