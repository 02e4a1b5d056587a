"""URL filter: rules first, then trust and distrust propagated over the graph of hosts.

Rules judge the pages they fit. The hosts of pages that a rule allows are trusted seeds, those of
pages that a rule blocks are blocked seeds, each by its number of such pages. Hosts are linked by
their pages' absolute links, and a host and the domain above it (down to two labels) vouch for each
other. Trust is the personalised PageRank from the trusted seeds along the links; distrust is the
same from the blocked seeds against them. A host whose share of distrust is above a threshold
blocks its pages that no rule fits.

All of it is joins and aggregates over rows of hosts and links; each step of the walks is written
below the shared folder. A host with very many links is split by Spark, its sums are combined on
the map side. Walks have no greatest length: they go on until no verdict can change (see
``propagate``), so as many steps as the longest way from a seed and then some. Scores are lower
bounds; the verdicts are those of the limit.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule and
is allowed; a null or empty html has no links; a host that neither trust nor distrust reaches, and
one where they tie, is allowed; what a walk of some 2000 links still carries is too small for a
double and reaches nothing; repeated rows are judged alike and count each; an empty table gives an
empty one.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from riskloom.session import stage

# Verdict, host and path of each rule.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
MOST_RULES = 1000
DAMPING = 0.7
THRESHOLD = 0.5
# Shares of trust and distrust that differ by less than this are ties.
TIE = 1e-6
CHECK_EVERY = 4
_LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]*)"""


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    name = F.regexp_extract(_after_scheme(url), "^[^/?#]*", 0)
    lowered = F.translate(name, string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """``struct(verdict, rule)`` of the longest rule that fits, or null; rules of equal length in
    their given order."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    found = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(rule_host + rule_path).alias("rule"))).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, weight`` from absolute links and from domains."""
    links = F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_LINK), 1)
    target = F.transform(links, lambda x: host_of(F.concat(F.lit("x:"), F.regexp_replace(x, "^[^/]*", ""))))
    linked = (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(F.array_distinct(target)).alias("dst"))
        .filter("src <> '' and dst <> '' and src <> dst")
        .groupBy("src", "dst").agg(F.count("*").cast("double").alias("weight"))
    )
    hosts = pages.select(host_of(F.col("url")).alias("h")).filter("h <> ''").distinct()
    hosts = hosts.unionByName(linked.select(F.col("dst").alias("h"))).distinct()
    labels = F.split("h", r"\.")
    above = F.transform(
        F.sequence(F.lit(0), F.size(labels) - 2), lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    pairs = hosts.filter(F.size(labels) > 2).select(above.alias("up")).select(
        F.explode(F.transform(F.sequence(F.lit(0), F.size("up") - 2), lambda i: F.struct(
            F.get("up", i).alias("src"), F.get("up", i + 1).alias("dst")))).alias("e")).select("e.*").distinct()
    back = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return linked.unionByName(pairs.unionByName(back).withColumn("weight", F.lit(1.0))).groupBy("src", "dst").agg(
        F.sum("weight").alias("weight"))


def doubtful(trust: Column, distrust: Column, threshold: float = THRESHOLD) -> Column:
    """Whether distrust has more than its share; shares that differ by less than ``TIE`` do not."""
    return (1 - threshold) * distrust - threshold * trust > TIE * (trust + distrust)


def _flows(edges: DataFrame) -> DataFrame:
    """``src, dst, t, d, own``: what goes along a link, trust as a share of the source's links out,
    distrust backwards as a share of the target's links in. A row of its own keeps each host."""
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    forth = edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    back = edges.join(into, "dst").select(
        F.col("dst").alias("src"), F.col("src").alias("dst"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("total")).alias("d"))
    both = forth.unionByName(back).groupBy("src", "dst").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
    return both.withColumn("own", F.lit(0))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, threshold: float = THRESHOLD) -> DataFrame:
    """From links and seeds ``host, good, bad, open`` (counts) to ``host, trust, distrust``.

    After k links a walk still carries at most damping to the power k of its start; what it carries
    is kept beside what it has left, and no score can grow by more than damping times the sum of
    what is carried. The walks end when the last link reached no host for the first time, so that
    none ever will, and no host with open pages can change its verdict within that bound.
    """
    flows = _flows(edges)
    hosts = flows.select(F.col("src").alias("host")).unionByName(seeds.select("host")).distinct()
    flows = stage(flows.unionByName(hosts.select(
        F.col("host").alias("src"), F.col("host").alias("dst"), F.lit(0.0).alias("t"), F.lit(0.0).alias("d"), F.lit(1).alias("own"))))
    good, bad = seeds.agg(F.sum("good"), F.sum("bad")).first()
    share = lambda name, total: (F.coalesce(F.col(name), F.lit(0)) / (total or 1)).cast("double")
    now = stage(
        hosts.join(seeds, "host", "left")
        .select("host", (F.coalesce("open", F.lit(0)) > 0).alias("open"), share("good", good).alias("c_trust"), share("bad", bad).alias("c_distrust"))
        .withColumns({x: (1 - damping) * F.col(f"c_{x}") for x in ("trust", "distrust")}))
    settled = False
    while not settled:
        for _ in range(CHECK_EVERY):
            now = stage(_step(now, flows, damping))
        settled = _settled(now, damping, threshold)
    return now.select("host", "trust", "distrust")


def _step(now: DataFrame, flows: DataFrame, damping: float) -> DataFrame:
    """All walks one link on: ``c_`` is what they carry, the rest what they have left at hosts."""
    own = F.col("own") == 1
    went = now.withColumnRenamed("host", "src").join(flows, "src").groupBy(F.col("dst").alias("host")).agg(
        F.bool_or(own & F.col("open")).alias("open"),
        *[F.sum(F.when(own, F.col(x)).otherwise(0.0)).alias(f"b_{x}") for x in ("trust", "distrust")],
        (damping * F.sum(F.col("c_trust") * F.col("t"))).alias("c_trust"),
        (damping * F.sum(F.col("c_distrust") * F.col("d"))).alias("c_distrust"))
    first = [(F.col(f"b_{x}") == 0) & (F.col(f"c_{x}") > 0) for x in ("trust", "distrust")]
    return went.select(
        "host", "open", "c_trust", "c_distrust", (first[0] | first[1]).alias("first"),
        *[(F.col(f"b_{x}") + (1 - damping) * F.col(f"c_{x}")).alias(x) for x in ("trust", "distrust")])


def _settled(now: DataFrame, damping: float, threshold: float) -> bool:
    """Whether no host was just reached for the first time and no verdict can change any more."""
    trust, distrust, first = now.agg(F.sum("c_trust"), F.sum("c_distrust"), F.bool_or("first")).first()
    if first:
        return False
    # A host that nothing has reached by now is never reached.
    most = lambda x, left: F.when(F.col(x) > 0, F.col(x) + damping * (left or 0.0)).otherwise(0.0)
    worst = doubtful(F.col("trust"), most("distrust", distrust), threshold)
    best = doubtful(most("trust", trust), F.col("distrust"), threshold)
    return now.filter(F.col("open") & (worst != best)).isEmpty()


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD,
          damping: float = DAMPING) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` for every page."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    seen = pages.select("page_id", host.alias("host"), path.alias("path")).withColumn(
        "_found", rule_for(F.col("host"), F.col("path"), rules))
    verdict = F.col("_found.verdict")
    seeds = stage(seen.filter("host <> ''").groupBy("host").agg(
        F.count_if(verdict == "allow").alias("good"), F.count_if(verdict == "block").alias("bad"),
        F.count_if(verdict.isNull()).alias("open")))
    scores = propagate(stage(host_edges(pages)), seeds, damping, threshold)
    scored = seen.join(scores, "host", "left")
    suspect = doubtful(F.col("trust"), F.col("distrust"), threshold)
    by_host = F.when(F.coalesce(suspect, F.lit(False)), "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("_found.rule").alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
