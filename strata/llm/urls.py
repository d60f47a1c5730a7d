"""URL filter: explicit rules, and a tree of path templates per host that learns from the urls the rules decide.

1. Paths are cut into segments; segments that vary by form (numbers, hex, dates, words with digits) become ``*``.
2. Level by level, per host and parent template, siblings are looked at together: many children of low support are
   variables and become ``*``; of the labelled children, those whose share of blocked urls does not differ from the
   others' by a two-proportion test are merged into ``*``. An unlabelled child joins them if it resembles the labelled
   ones (segments below it, urls); the other unlabelled ones are merged among themselves (as ``+``).
3. A template is rejected if its share of blocked urls is high, smoothed towards its parent's, and so on up to the host's
   and a neutral prior. So a branch without labels is judged by the nearest branches that have some, and a host without
   any is allowed, however many urls elsewhere are blocked.

Urls are aggregated to forms before anything is compared, so hosts of any size cost one row per form. All steps are
DataFrame aggregates and joins.

Edge cases: a null url or one without ``://`` has an empty host and path; segments beyond ``DEPTH`` are taken together
as one; repeated urls count as often as they stand; other columns pass through; an empty table stays empty.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.components import stored
from strata.llm.frames import col

DEPTH = 8
VARIABLE = r"^(?:[0-9a-fA-F-]{8,}|.*[0-9].*)$"
MANY = 20        # children of one parent, from which low support tells a variable
SUPPORT = 3.0    # mean urls per child below which they are variables
Z = 1.96
STRENGTH = 4.0   # weight of the prior, in urls
REJECT = 0.8
PRIOR = 0.5      # what a host starts from: other hosts are no evidence against it
NEAR_DEPTH = 0.5   # mean segments by which an unlabelled child may differ from its labelled siblings
NEAR_SUPPORT = 4.0  # times the mean urls of a labelled sibling, or this part of it


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"), Rule("allow", "www.example.com", "/en/"),
         Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``."""
    at = F.instr(col(url), "://")
    rest = F.when(at > 0, F.substr(col(url), at + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), string.ascii_uppercase, string.ascii_lowercase)
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)})


def ruled(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Add ``rule`` (name of the longest rule that fits, or null) and ``by_rule`` (its verdict)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = rule.fits(F.col("host"), F.col("path"))
        name = F.when(fits, F.lit(rule.name)).otherwise(name)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return pages.withColumns({"rule": name, "by_rule": verdict})


def form(path: Column) -> Column:
    """Segments of a path, those that vary by form as ``*``; what lies beyond DEPTH is one segment."""
    parts = F.transform(F.filter(F.split(path, "/", -1), lambda s: s != ""),
                        lambda s: F.when(s.rlike(VARIABLE), F.lit("*")).otherwise(s))
    deep = F.concat(F.slice(parts, 1, DEPTH - 1), F.array(F.array_join(F.slice(parts, DEPTH, 1 << 30), "/")))
    return F.when(F.size(parts) > DEPTH, deep).otherwise(parts)


def templates(pages: DataFrame) -> DataFrame:
    """``host, form, template, urls, purity`` from rows with ``host``, ``path`` and ``by_rule``."""
    urls = pages.select("host", form(F.col("path")).alias("form"), (F.col("by_rule") == "block").alias("blocked"))
    forms = stored(urls.groupBy("host", "form").agg(
        F.count("*").alias("n"), F.count("blocked").alias("m"), F.count(F.when(F.col("blocked"), 1)).alias("b")), "forms")
    depth = forms.agg(F.coalesce(F.max(F.size("form")), F.lit(0)).alias("d")).first().d
    tree = forms.withColumn("template", F.lit(""))
    for level in range(depth):
        tree = _level(tree, level)
    sums = stored(tree.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "m", "b"))), "sums")
    # All beginnings of a template, the host's own (no segment) first; what lies beyond DEPTH is one segment.
    parts = F.split("template", "/", -1)
    steps = F.transform(F.sequence(F.lit(1), F.least(F.size(parts), F.lit(DEPTH + 1))), lambda k: F.when(
        k == DEPTH + 1, F.col("template")).otherwise(F.array_join(F.slice(parts, F.lit(1), k), "/")))
    chain = sums.select("host", "template", "m", "b", F.posexplode(steps).alias("step", "start"))
    above = chain.groupBy("host", "step", "start").agg(F.sum("m").alias("all_m"), F.sum("b").alias("all_b"))
    ladder = chain.select("host", "template", "step", "start").join(above, ["host", "step", "start"]).groupBy(
        "host", "template").agg(F.sort_array(F.collect_list(F.struct("step", "all_m", "all_b"))).alias("ladder"))
    purity = F.aggregate("ladder", F.lit(PRIOR), lambda p, x: (x.all_b + STRENGTH * p) / (x.all_m + STRENGTH))
    judged = ladder.select("host", "template", purity.alias("purity")).join(
        sums.select("host", "template", F.col("n").alias("urls")), ["host", "template"])
    return tree.select("host", "form", "template").join(judged, ["host", "template"])


def _level(tree: DataFrame, level: int) -> DataFrame:
    """Extend every template by its next segment, or by what that segment is merged into."""
    tree = tree.withColumn("child", F.when(F.size("form") > level, F.get("form", F.lit(level))))
    child = tree.filter("child IS NOT NULL").groupBy("host", "template", "child").agg(
        *(F.sum(c).alias(c) for c in ("n", "m", "b")), F.sum(F.col("n") * F.size("form")).alias("depth"))
    labelled = F.col("m") > 0
    parent = child.groupBy("host", "template").agg(
        F.count("*").alias("children"), *(F.sum(c).alias(f"all_{c}") for c in ("n", "m", "b")),
        *(F.sum(F.when(labelled, F.col(c))).alias(f"known_{c}") for c in ("n", "depth")),
        F.count(F.when(labelled, 1)).alias("known"))
    both = child.join(parent, ["host", "template"])
    rest_m, rest_b = F.col("all_m") - F.col("m"), F.col("all_b") - F.col("b")
    share = F.try_divide
    pooled = share(F.col("all_b"), F.col("all_m"))
    spread = F.sqrt(pooled * (1 - pooled) * (share(F.lit(1), F.col("m")) + share(F.lit(1), rest_m)))
    apart = F.abs(share(F.col("b"), F.col("m")) - share(rest_b, rest_m))
    similar = (F.col("m") > 0) & (rest_m > 0) & (apart <= Z * spread)
    variable = (F.col("children") >= MANY) & (F.col("all_n") / F.col("children") < SUPPORT)
    # An unlabelled child among labelled ones goes with them if as much lies below it, and as deep.
    each = share(F.col("known_n"), F.col("known"))
    alike = ((F.col("m") == 0) & (F.col("known") > 0)
             & (F.abs(F.col("depth") / F.col("n") - share(F.col("known_depth"), F.col("known_n"))) <= NEAR_DEPTH)
             & F.col("n").between(each / NEAR_SUPPORT, each * NEAR_SUPPORT))
    merged = F.when(variable | similar | alike | (F.col("child") == "*"), F.lit("*")).when(
        (F.col("m") == 0) & (F.col("all_m") > 0), F.lit("+")).otherwise(F.col("child"))
    names = both.select("host", "template", "child", merged.alias("merged"))
    found = tree.join(names, ["host", "template", "child"], "left")
    return stored(found.select("host", "form", "n", "m", "b", F.concat(
        "template", F.coalesce(F.concat(F.lit("/"), F.col("merged")), F.lit(""))).alias("template")), "level")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", reject: float = REJECT) -> DataFrame:
    """Add ``host, path, rule, verdict, template, purity``; verdict: the rule's, else the template's."""
    added = ("host", "path", "rule", "by_rule", "verdict", "template", "purity", "form", "urls")
    own = pages.drop(*(c for c in pages.columns if c.lower() in added))
    rows = ruled(parsed(own, url), rules).withColumn("form", form(F.col("path")))
    learned = templates(rows).drop("urls")
    by_tree = F.when(F.col("purity") >= reject, F.lit("block")).otherwise(F.lit("allow"))
    return rows.join(learned, ["host", "form"], "left").select(
        *(col(c) for c in own.columns), "host", "path", "rule", F.coalesce("by_rule", by_tree).alias("verdict"),
        F.concat(F.col("host"), F.col("template")).alias("template"), "purity")
