"""URL filter: host reputation by empirical Bayes, under fixed rules.

Rules decide the urls they fit. Those decisions are the labelled page outcomes of their
hosts. For all other urls the share of bad outcomes of the host decides: it has a beta
prior centred on its registered domain's share, which is shrunk towards its suffix's,
which is shrunk towards that of all outcomes. The strength of each prior is estimated
from how much the shares of a level vary beyond chance (method of moments). A host is
blocked when even the lower bound of its posterior lies above the limit.

The suffix of a host is its last label, or the longest that fits of a list of suffixes of
several labels (`suffixes`, such as co.uk); the registered domain has one label more.

Only DataFrame functions are used. Outcomes are counted per host first, so a host or
domain that holds a third of all rows is a single row before anything is joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from histlake.llm.common import work_table

Rule = tuple[str, str, str]  # verdict, host, path

LIMIT = 0.5
Z = 1.6448536269514722  # one-sided 95 %
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits (host and subdomains, start of the path) and its verdict.

    Rules of equal length are taken in the order of their text. Null where none fits.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, at, start in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2], r[0]), reverse=True):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(start)
        rule = F.when(fits, F.lit(at + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def strength(counts: DataFrame, level: str) -> float:
    """Equivalent outcomes of the prior of a level, from its units' counts (n, bad)."""
    units = counts.groupBy(level).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where("n > 0")
    total = units.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("k"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("q")).first()
    n, k = total.n or 0, total.k
    if k < 2:
        return MAX_STRENGTH
    mean = total.bad / n
    within = mean * (1 - mean)
    # Weighted squares between units have mean (k - 1) within + (n - n2 / n) between.
    squares = units.agg(F.sum(F.col("n").cast("double") * F.col("n"))).first()[0]
    between = (total.q - n * mean * mean - (k - 1) * within) / (n - squares / n)
    if between <= 0 or within == 0:
        return MAX_STRENGTH
    return min(MAX_STRENGTH, max(MIN_STRENGTH, within / between - 1))


def levels_of(host: Column, suffixes: Sequence[str] = ()) -> tuple[Column, Column]:
    """Suffix and registered domain; a host that is a suffix is a domain of its own."""
    labels = F.split(host, r"\.")
    suffix, n = F.element_at(labels, -1), F.lit(1)
    if suffixes:
        ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.concat_ws(".", F.slice(labels, k, F.size(labels))))
        suffix = F.coalesce(F.get(F.filter(ends, lambda end: end.isin(*suffixes)), F.lit(0)), suffix)
        n = F.size(F.split(suffix, r"\."))
    return suffix, F.concat_ws(".", F.slice(F.concat(F.array(F.lit("")), labels), -(n + 1), n + 1))


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = ()) -> DataFrame:
    """(host, bad_share, bad_bound) from `outcomes` (host, n, bad), one row per host."""
    suffix, domain = levels_of(F.col("host"), suffixes)
    counts = work_table(outcomes.withColumn("suffix", suffix).withColumn("domain", domain))
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    start = ((total.bad or 0) + 1) / ((total.n or 0) + 2)
    mean = None
    for level in LEVELS:
        units = counts.groupBy(level, *LEVELS[max(0, LEVELS.index(level) - 1) : LEVELS.index(level)]).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
        s = strength(counts, level)
        if mean is None:
            units = units.withColumn("parent", F.lit(start))
        else:
            units = units.join(mean, LEVELS[LEVELS.index(level) - 1])
        a, b = s * F.col("parent") + F.col("bad"), s * (1 - F.col("parent")) + F.col("n") - F.col("bad")
        units = units.withColumn("a", a).withColumn("b", b)
        mean = units.select(level, (F.col("a") / (F.col("a") + F.col("b"))).alias("parent"))
    share = F.col("a") / (F.col("a") + F.col("b"))
    deviation = F.sqrt(share * (1 - share) / (F.col("a") + F.col("b") + 1))
    return units.select("host", share.alias("bad_share"), (share - Z * deviation).alias("bad_bound"))


def judge(df: DataFrame, rules: Sequence[Rule], *, url_col: str = "url", id_col: str = "page_id", suffixes: Sequence[str] = ()) -> DataFrame:
    """(id, host, path, rule, verdict, bad_bound) of every row.

    Null urls and urls without `://` have an empty host and path, which no rule fits;
    the empty host is judged like any other. Repeated rows each count and stay. Without
    outcomes every host has the same share, 0.5, and is allowed.
    """
    said = "__said"
    rows = df.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn(said, verdict)
    outcomes = rows.groupBy("host").agg(F.count(said).alias("n"), F.count(F.when(F.col(said) == "block", 1)).alias("bad"))
    known = work_table(reputations(outcomes, suffixes))
    by_host = F.when(F.col("bad_bound") > LIMIT, "block").otherwise("allow")
    out = rows.join(known, "host", "left").withColumn("verdict", F.coalesce(said, by_host))
    return out.select(F.col("id").alias(id_col), "host", "path", "rule", "verdict", "bad_bound")
