"""URL filter: rules first, then a tree of path templates per host.

Rules name a host with its subdomains and a path prefix. URLs that no rule fits are judged by their template:

1. Digits in a segment become ``{n}``, long hexadecimal segments ``{id}``; empty segments are left out.
2. Level by level, the segments below a node (host and template so far) become ``*`` where there are more
   than ``max_children`` different ones. From ``depth`` on only nodes that hold good and bad labels are cut any
   further; what lies below the others is put together as ``**``.
3. The other branches of a node are put in order of their good share among labelled URLs, and each is merged into the
   group before it while a test of both shares finds no difference (``z``; one good and one bad URL are added to either
   side, so that shares of 0 and 1 from few labels are not taken as certain). Branches without any label are
   merged among themselves.
4. A template is rejected when its purity, (good + strength * prior) / (labelled + strength) with the share of
   good URLs among all labelled ones as prior, is below ``least_purity``. With ``inherit`` such trees are also
   built for each parent domain, from the hosts at and below it, and for all hosts together, and the prior of
   a node is the purity of the one before it: from short templates to long ones, and of one length from all hosts by way of
   the domains to the host. A template without labels of its own is thus judged by the same path elsewhere. A host has the
   ``PARENTS`` widest of its parent domains.

The tree is built on the distinct (host, segments) with their counts, combined on the map side, so a host
with a third of all URLs is as large there as its number of different paths. The verdicts are joined back
with the fullest keys spread.

Defined cases: a null URL or one without ``://`` has an empty host and path, and is judged like any other. With no
labelled URL at all the prior is 1 and nothing is rejected. Repeated rows each get their row; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import hot_limit, lower_ascii
from curbline.session import settle

DEPTH, MAX_CHILDREN, Z, STRENGTH, LEAST_PURITY = 6, 50, 1.96, 2.0, 0.5
PARENTS = 8


@dataclass(frozen=True)
class Rule:
    text: str  # host and path prefix, like example.com/de/
    verdict: str

    @property
    def host(self) -> str:
        return self.text.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.text.split("/", 1)[1]


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(rules: list[Rule]) -> Column:
    """The longest rule that fits columns host and path, as (text, verdict); null when none does."""
    chosen = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: len(r.text)):  # a longer one replaces a shorter one
        fits = ((F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)) & F.col("path").startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def lexical_segments(path: Column) -> Column:
    parts = F.filter(F.split(path, "/", -1), lambda s: s != "")
    return F.transform(parts, lambda s: F.when(
        s.rlike("^[0-9a-f-]{16,}$"), F.lit("{id}")).otherwise(F.regexp_replace(s, "[0-9]+", "{n}")))


def template_purity(
    leaves: DataFrame,
    *,
    depth: int = DEPTH,
    max_children: int = MAX_CHILDREN,
    z: float = Z,
    strength: float = STRENGTH,
    inherit: bool = False,
) -> DataFrame:
    """``leaves``: distinct (host, segments) with labelled and good counts. Adds template and purity."""
    sums = leaves.agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good")).first()
    prior = sums.good / sums.labelled if sums.labelled else 1.0
    if inherit:
        return _inherited(leaves, _templates(_by_scope(leaves), depth, max_children, z), prior, strength)
    rows = _templates(leaves, depth, max_children, z)
    by_template = rows.groupBy("host", "template").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g"))
    purity = (F.col("g") + F.lit(strength * prior)) / (F.col("l") + F.lit(strength))
    return rows.join(by_template.select("host", "template", purity.alias("purity")), ["host", "template"])


def _templates(leaves: DataFrame, depth: int, max_children: int, z: float) -> DataFrame:
    """The leaves with their template."""
    rows = leaves.select("host", "segments", "labelled", "good", F.array().cast("array<string>").alias("template"), F.lit(True).alias("open"))
    level = 0
    while True:
        rows = settle(_grow(rows, level, max_children, z, mixed_only=level >= depth), "level")
        level += 1
        if rows.where(F.col("open") & (F.size("segments") > level)).isEmpty():
            return rows.drop("open")


def _scopes(host: Column) -> Column:
    """All hosts (the empty text), the widest parent domains, and last the host, marked by a slash, as none has one."""
    parts = F.split(host, r"\.")
    count = F.least(F.lit(PARENTS), F.size(parts) - 1)
    parents = F.when(count > 0, F.transform(
        F.sequence(F.lit(1), count), lambda i: F.array_join(F.slice(parts, -i, i), "."))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.array(F.lit("")), parents, F.array(F.concat(F.lit("/"), host)))


def _by_scope(leaves: DataFrame) -> DataFrame:
    """The leaves of every scope; a domain holds the hosts at and below it."""
    own = F.array_union(_scopes(F.col("host")), F.array(F.col("host")))  # the host's leaves count for the domain of its name, too
    listed = leaves.select("segments", "labelled", "good", F.explode(own).alias("host"))
    return listed.groupBy("host", "segments").agg(F.sum("labelled").alias("labelled"), F.sum("good").alias("good"))


def _inherited(leaves: DataFrame, rows: DataFrame, prior: float, strength: float) -> DataFrame:
    """The leaves with template and purity, smoothed along the nodes of all their scopes that hold labels."""
    prefixes = F.transform(F.sequence(F.lit(0), F.size("template")), lambda i: F.slice("template", F.lit(1), i))
    listed = settle(rows.select("host", "segments", "labelled", "good", F.posexplode(prefixes).alias("level", "prefix")), "prefixes")
    nodes = listed.groupBy("host", "prefix").agg(F.sum("labelled").alias("l"), F.sum("good").alias("g")).where("l > 0")
    paths = listed.select("host", "segments", "level", "prefix").join(nodes, ["host", "prefix"]).groupBy("host", "segments").agg(
        F.collect_list(F.struct("level", "l", "g")).alias("path"))
    asked = leaves.select("host", "segments", F.posexplode(_scopes(F.col("host"))).alias("rank", "scope"))
    found = asked.join(paths.withColumnRenamed("host", "scope"), ["scope", "segments"]).select("host", "segments", F.transform(
        "path", lambda n: F.struct(n["level"].alias("level"), F.col("rank").alias("rank"), n["l"].alias("l"), n["g"].alias("g"))).alias("path"))
    steps = found.groupBy("host", "segments").agg(F.array_sort(F.flatten(F.collect_list("path"))).alias("steps"))
    down = F.aggregate("steps", F.lit(float(prior)), lambda above, n: (n["g"] + F.lit(strength) * above) / (n["l"] + F.lit(strength)))
    own = rows.where(F.startswith("host", F.lit("/"))).select(F.substring("host", 2, 1 << 30).alias("host"), "segments", "template")
    return leaves.join(own, ["host", "segments"]).join(steps, ["host", "segments"], "left").select(
        *leaves.columns, "template", F.coalesce(down, F.lit(float(prior))).alias("purity"))


def _differs(a: Column, b: Column, z: float) -> Column:
    """Whether the good shares of two groups of labelled URLs differ, with one good and one bad URL added to each."""
    share = lambda x: (x["g"] + 1) / (x["l"] + 2)
    noise = lambda x: share(x) * (1 - share(x)) / (x["l"] + 2)
    return F.abs(share(a) - share(b)) > z * F.sqrt(noise(a) + noise(b))


def _merged(branches: Column, z: float) -> Column:
    """Groups of branches. ``branches``: sorted (has labels, share, segment, l, g), at most ``max_children``."""
    kind = "array<struct<l:bigint,g:bigint,names:array<string>>>"

    def step(groups: Column, one: Column) -> Column:
        last = F.element_at(groups, -1)
        alike = (last["l"] > 0) == (one["l"] > 0)
        joins = (F.size(groups) > 0) & alike & ~((one["l"] > 0) & _differs(last, one, z))
        alone = F.struct(one["l"].alias("l"), one["g"].alias("g"), F.array(one["segment"]).alias("names"))
        wider = F.struct(
            (last["l"] + one["l"]).alias("l"), (last["g"] + one["g"]).alias("g"),
            F.concat(last["names"], F.array(one["segment"])).alias("names"))
        return F.when(joins, F.concat(F.slice(groups, 1, F.size(groups) - 1), F.array(wider))).otherwise(
            F.concat(groups, F.array(alone)))

    return F.aggregate(branches, F.array().cast(kind), step)


def _grow(rows: DataFrame, level: int, max_children: int, z: float, mixed_only: bool) -> DataFrame:
    """Append to each open template the generalised segment of this level; with ``mixed_only`` nodes without both kinds
    of labels are closed instead."""
    node = ["host", "template"]
    rows = rows.withColumn("segment", F.when(F.col("open"), F.get("segments", F.lit(level))))
    branches = rows.where(F.col("segment").isNotNull()).groupBy(*node, "segment").agg(
        F.sum("labelled").alias("l"), F.sum("good").alias("g"))
    sums = branches.groupBy(*node).agg(F.count(F.lit(1)).alias("children"), F.sum("l").alias("all"), F.sum("g").alias("fine"))
    mixed = (F.col("fine") > 0) & (F.col("fine") < F.col("all"))
    cut = sums.where(mixed) if mixed_only else sums
    few = branches.join(cut.where(F.col("children") <= max_children).select(*node), node, "left_semi")
    # at most max_children rows a node from here on
    kids = few.groupBy(*node).agg(F.array_sort(F.collect_list(F.struct(
        (F.col("l") > 0).alias("labelled"), F.coalesce(F.try_divide("g", "l"), F.lit(0.0)).alias("share"), "segment", "l", "g",
    ))).alias("kids"))
    groups = kids.select(*node, F.explode(_merged(F.col("kids"), z)).alias("group"))
    names = groups.select(*node, F.explode("group.names").alias("segment"), F.concat_ws("|", F.array_sort("group.names")).alias("name"))
    rows = rows.join(names, [*node, "segment"], "left")
    if mixed_only:
        rows = rows.join(cut.select(*node, F.lit(True).alias("goes_on")), node, "left")
    going = F.coalesce("goes_on", F.lit(False)) if mixed_only else F.lit(True)
    added = F.when(going, F.coalesce("name", F.lit("*"))).otherwise(F.lit("**"))
    return rows.select(
        "host", "segments", "labelled", "good",
        F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.array(added))).alias("template"),
        (F.col("open") & (F.col("segment").isNull() | going)).alias("open"),
    )


def judge_urls(
    pages: DataFrame,
    rules: list[Rule],
    labels: DataFrame | None = None,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
    least_purity: float = LEAST_PURITY,
    **tree: float,
) -> DataFrame:
    """One row per row of ``pages``: identifier, host, path, rule, verdict, template (null where a rule fits).

    ``labels`` has a url and whether it is good; without it the URLs that
    a rule fits are the labelled ones, and the templates extend the rules to the URLs next to them.
    """
    spark = pages.sparkSession
    url = F.col(url_column).cast("string")
    parsed = pages.select(
        F.col(id_column).alias("id"), url_host(url).alias("host"), url_path(url).alias("path")
    ).withColumn("rule", fitting_rule(rules)).withColumn("segments", lexical_segments(F.col("path")))
    parsed = settle(parsed, "urls")
    if labels is None:
        known = parsed.select("host", "segments", F.col("rule.verdict").alias("v")).select(
            "host", "segments", F.col("v").isNotNull().cast("long").alias("labelled"),
            (F.coalesce("v", F.lit("")) == "allow").cast("long").alias("good"))
    else:
        known = labels.select(
            url_host(F.col("url")).alias("host"), lexical_segments(url_path(F.col("url"))).alias("segments"),
            F.lit(1).cast("long").alias("labelled"), F.col("good").cast("long").alias("good"),
        ).unionAll(parsed.select("host", "segments", F.lit(0).cast("long"), F.lit(0).cast("long")))
    leaves = settle(
        known.groupBy("host", "segments").agg(
            F.sum("labelled").alias("labelled"), F.sum("good").alias("good"), F.count(F.lit(1)).alias("n")),
        "leaves",
    )
    purity = settle(template_purity(leaves.drop("n"), **tree), "templates")
    verdicts = purity.select(
        "host", "segments", F.concat_ws("/", "template").alias("template"),
        F.when(F.col("purity") < least_purity, F.lit("block")).otherwise(F.lit("allow")).alias("judged"),
    )
    # keys above half a partition's share get several copies of their verdict; bound: see hot_limit
    limit = hot_limit(leaves.agg(F.sum("n")).first()[0] or 0, spark)
    hot = leaves.where(F.col("n") > limit).select(
        "host", "segments", F.ceil(F.col("n") / F.lit(limit)).cast("long").alias("copies"))
    salts = F.coalesce("copies", F.lit(1).cast("long"))
    open_urls = parsed.where("rule IS NULL").join(F.broadcast(hot), ["host", "segments"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("id"), salts))
    copied = verdicts.join(F.broadcast(hot), ["host", "segments"], "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    judged = open_urls.join(copied.drop("copies"), ["host", "segments", "salt"]).select(
        F.col("id").alias(id_column), "host", "path", F.lit(None).cast("string").alias("rule"),
        F.col("judged").alias("verdict"), "template")
    ruled = parsed.where("rule IS NOT NULL").select(
        F.col("id").alias(id_column), "host", "path", F.col("rule.text").alias("rule"),
        F.col("rule.verdict").alias("verdict"), F.lit(None).cast("string").alias("template"))
    return ruled.unionAll(judged)
