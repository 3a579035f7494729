"""URL filters: rules for hosts and paths, and trust and distrust spread over the host graph."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import Scratch
from quayside.operators.joins import skew_join

# Attributes that hold an address, one that holds several, and where relative addresses begin.
LINK = r"(?i)(?:href|src|action|formaction|poster|cite|data-src)\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"
SRCSET = r"(?i)srcset\s*=\s*[\"']([^\"'>]+)"
BASE = r"(?i)<base\s[^>]*href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\"'\s>]+)"
RELATIVE = r"(?i)(?:href|src|action|formaction|poster|cite|data-src)\s*=\s*[\"']\s*(?:[^\"'/#:\s][^\"':]*|/|/[^\"'/][^\"']*)[\"']"
# Up to as many rules are tried one after another, more are looked up by host.
CHAINED_RULES = 500


def host_of(url: Column) -> Column:
    """Between the first `://` and `/`, `?`, `#` or the end, A-Z lower-cased; empty without `://`."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), r"(?s)^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def path_of(url: Column) -> Column:
    """From the end of the host up to `?`, `#` or the end; empty without `://`."""
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


@dataclass(frozen=True)
class Rule:
    """`text` is a host and a path; it fits the host and its subdomains where the path starts with its path."""

    text: str
    allow: bool

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        host, slash, path = self.text.partition("/")
        return slash + path

    def fits(self) -> Column:
        host = F.col("host")
        return ((host == self.host) | host.endswith("." + self.host)) & F.col("path").startswith(self.path)


def with_rule(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add rule (the longest that fits host and path, else null) and ruled (allow, block or null)."""
    if len(rules) > CHAINED_RULES:
        return _looked_up(urls, rules)
    rule = ruled = None
    for r in sorted(rules, key=lambda r: (-len(r.text), r.text)):
        rule = F.when(r.fits(), r.text) if rule is None else rule.when(r.fits(), r.text)
        says = "allow" if r.allow else "block"
        ruled = F.when(r.fits(), says) if ruled is None else ruled.when(r.fits(), says)
    none = F.lit(None).cast("string")
    return urls.withColumn("rule", none if rule is None else rule).withColumn("ruled", none if ruled is None else ruled)


def _looked_up(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """As `with_rule`, for any number of rules: those of a host's suffixes are joined to it, once per host."""
    table = urls.sparkSession.createDataFrame(
        [(r.host, r.path, r.text, "allow" if r.allow else "block") for r in rules], "suffix string, rule_path string, rule string, says string"
    )
    hosts = urls.select("host").where("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    own = hosts.select("host", F.explode(suffixes).alias("suffix")).join(table, "suffix")
    own = own.groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), "rule", "rule_path", "says")).alias("_rules"))
    found = skew_join(urls, own, "host", "left")
    fitting = F.filter(F.coalesce("_rules", F.array().cast(own.schema["_rules"].dataType)), lambda r: F.col("path").startswith(r["rule_path"]))
    best = F.element_at(F.array_sort(fitting, lambda a, b: F.when(a["n"] != b["n"], (b["n"] - a["n"]).cast("int")).when(a["rule"] < b["rule"], -1).otherwise(1)), 1)
    found = found.withColumn("_best", F.when(F.size(fitting) > 0, best))
    return found.withColumns({"rule": F.col("_best.rule"), "ruled": F.col("_best.says")}).drop("_rules", "_best")


def host_edges(pages: DataFrame) -> DataFrame:
    """(kind, src, dst, weight): links between hosts in the pages' html, and from a host to its parent domain.

    Links (`link`) are addresses with a host of their own in an attribute or a srcset, and where a page's
    base lies on another host also its relative addresses. They are counted per pair of hosts before the shuffle.
    A host with more than two labels also has an edge to the host without the first label (`parent`), if pages of that
    exist or not: subdomains share the standing of their domain. Links within a host say nothing and are left out.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = F.regexp_extract(html, BASE, 1)
    several = F.flatten(F.transform(F.regexp_extract_all(html, F.lit(SRCSET), 1), lambda s: F.split(s, ",")))
    several = F.filter(F.transform(several, lambda s: F.regexp_extract(s, r"^\s*((?:[A-Za-z][A-Za-z0-9+.-]*:)?//\S+)", 1)), lambda s: s != "")
    own = F.concat(F.regexp_extract_all(html, F.lit(LINK), 1), several)
    by_base = F.when(base != "", F.array_repeat(base, F.regexp_count(html, F.lit(RELATIVE)))).otherwise(F.array().cast("array<string>"))
    found = pages.select("host", F.explode(F.concat(own, by_base)).alias("link"))
    full = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(F.col("link"))
    links = found.select(F.col("host").alias("src"), host_of(full).alias("dst"))
    links = links.where("src <> dst AND src <> '' AND dst <> ''").groupBy("src", "dst").agg(F.count("dst").alias("weight"))
    up = pages.select("host").distinct().where(F.size(F.split("host", r"\.")) > 2)
    up = up.select(F.col("host").alias("src"), F.regexp_replace("host", r"^[^.]*\.", "").alias("dst"), F.lit(1).cast("bigint").alias("weight"))
    return links.withColumn("kind", F.lit("link")).unionByName(up.withColumn("kind", F.lit("parent")))


def propagated(
    edges: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int = 8, damping: float = 0.85, every: int = 4,
    parent_share: float = 0.2,
) -> DataFrame:
    """(host, trust, distrust) after `rounds` rounds of personalised PageRank.

    `seeds` (host, trust, distrust) hold the start of either walk, each adding up to 1 or 0. Trust
    follows the edges, distrust follows them backwards, from a host to those that link to it. A
    host's score is damping times what its neighbours pass on by weight, plus the rest at the seeds. Of what a host
    passes on, `parent_share` goes along parent edges, the rest along links, whether it has the other kind or not: so
    a domain never outweighs the links.
    Both walks are one: their edges are told apart by `walk`, and each round is one join and one
    sum. The table of scores is written every few rounds, which cuts the plan.
    """
    forward = edges.select(F.lit("trust").alias("walk"), "kind", "src", "dst", "weight")
    backward = edges.select(F.lit("distrust").alias("walk"), "kind", F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    # A hub has many edges: `src` and what it is joined by are one key, of which Spark may split the edges.
    both = forward.unionByName(backward).withColumn("by", F.concat_ws(" ", "walk", "kind", "src"))
    out = both.groupBy("by").agg(F.sum("weight").alias("total"))
    part = F.when(F.col("kind") == "parent", parent_share).otherwise(1 - parent_share) * F.col("weight") / F.col("total")
    both = skew_join(both, out, "by").where(part > 0).select("walk", F.concat_ws(" ", "walk", "src").alias("at"), "dst", part.alias("share"))
    both = scratch.keep(both)
    start = seeds.select("host", F.expr("stack(2, 'trust', trust, 'distrust', distrust) AS (walk, seed)"))
    start = scratch.keep(start.where("seed > 0"))
    scores = start.select("walk", "host", F.col("seed").alias("score"))
    for number in range(1, rounds + 1):
        held = scores.select(F.concat_ws(" ", "walk", "host").alias("at"), "score")
        passed = skew_join(both, held, "at").select(
            "walk", F.col("dst").alias("host"), (damping * F.col("share") * F.col("score")).alias("part")
        )
        again = start.select("walk", "host", ((1 - damping) * F.col("seed")).alias("part"))
        scores = passed.unionByName(again).groupBy("walk", "host").agg(F.sum("part").alias("score"))
        if number % every == 0 and number < rounds:
            scores = scratch.keep(scores)
    pick = lambda walk: F.sum(F.when(F.col("walk") == walk, F.col("score")).otherwise(0.0))
    return scores.groupBy("host").agg(pick("trust").alias("trust"), pick("distrust").alias("distrust"))


def judged(
    pages: DataFrame,
    rules: list[Rule],
    scratch: Scratch,
    rounds: int = 8,
    damping: float = 0.85,
    ratio: float = 1.0,
    parent_share: float = 0.2,
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every row of `pages` (page_id, url, html).

    A page that a rule fits has the rule's verdict. Any other has its host's: block where distrust
    exceeds `ratio` times trust. Seeds are the ruled pages: a host is trusted by its share of all
    allowed pages and distrusted by its share of all blocked ones, so a host may be both. A host
    that neither walk reaches is allowed.

    Null url, or one without `://`: empty host and path, which fit no rule and have no scores. Null
    html: no links. Repeated rows come out each. An empty table gives no rows. Other columns are
    ignored. DataFrame functions only; html is read once.
    """
    urls = pages.select("page_id", F.col("url").cast("string").alias("u"), F.col("html").cast("string").alias("html"))
    parted = urls.select("page_id", host_of(F.col("u")).alias("host"), path_of(F.col("u")).alias("path"), "html")
    edges = scratch.keep(host_edges(parted))
    ruled = with_rule(parted.select("page_id", "host", "path"), rules)
    tally = ruled.where("host <> '' AND ruled IS NOT NULL").groupBy("host").agg(
        F.count_if(F.col("ruled") == "allow").alias("allowed"), F.count_if(F.col("ruled") == "block").alias("blocked")
    )
    tally = scratch.keep(tally)
    sums = tally.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).first()
    seeds = tally.select(
        "host",
        (F.col("allowed") / F.lit(float(sums.a or 1))).alias("trust"),
        (F.col("blocked") / F.lit(float(sums.b or 1))).alias("distrust"),
    )
    hosts = scratch.keep(propagated(edges, seeds, scratch, rounds, damping, parent_share=parent_share))
    out = ruled.join(hosts, "host", "left")
    method = F.when(F.coalesce("distrust", F.lit(0.0)) > ratio * F.coalesce("trust", F.lit(0.0)), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "trust", "distrust")
