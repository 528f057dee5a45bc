"""URL filter by host reputation: empirical-Bayes shrinkage, in DataFrame functions only.

Labelled page outcomes (good or not) are counted by host, and hosts are nested in their
registered domain, domains in their suffix.  Level by level the good rate of a unit is
shrunk towards that of the level above by a beta-binomial prior, whose strength is
estimated from how much the units of that level differ (method of moments).  A host's
posterior is a beta distribution; a page is blocked where even the upper bound of its
host's good rate lies below ``min_good``.  Hosts without labels inherit their domain's
rate with the prior's uncertainty, so little is blocked on hearsay.

Rules come first: a rule fits its host and all subdomains if the path begins with the
rule's path; the longest fitting rule decides.

Scale.  Outcomes are partially aggregated to one row per host before anything is
shuffled, so a host with a third of all pages is one row per task.  The join back to the
pages is a plain equi-join that the planner broadcasts or splits by size.

Defined results: a NULL url, or one without ``://``, has an empty host and path and is
judged like a host without labels; a label of an unknown page is ignored; several labels
of a page all count; equal rows have equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Suffixes of two labels under which names are registered; others have one label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path(url: Column) -> Column:
    """Behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix(host_: Column, two_label: tuple[str, ...] = TWO_LABEL_SUFFIXES) -> Column:
    two = F.substring_index(host_, ".", -2)
    return F.when(two.isin(*two_label), two).otherwise(F.substring_index(host_, ".", -1))


def domain(host_: Column, suffix_: Column) -> Column:
    """The suffix and one label before it."""
    labels = F.size(F.split(suffix_, r"\.")) + 1
    return F.array_join(F.reverse(F.slice(F.reverse(F.split(host_, r"\.")), F.lit(1), labels)), ".")


def rule_of(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, NULL if none fits; the rules are a short list in the plan."""
    name = verdict = None
    for action, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        of, _, prefix = rule.partition("/")
        fits = ((host_ == of) | host_.endswith("." + of)) & path_.startswith("/" + prefix)
        name = F.when(fits, F.lit(rule)) if name is None else name.when(fits, F.lit(rule))
        verdict = F.when(fits, F.lit(action)) if verdict is None else verdict.when(fits, F.lit(action))
    null = F.lit(None).cast("string")
    return (null, null) if name is None else (name, verdict)


def _strength(units: DataFrame) -> DataFrame:
    """One row: prior strength a + b from units (n, k) around their expected rate ``mu``, by moments."""
    rate, spread = F.col("k") / F.col("n"), F.col("mu") * (1 - F.col("mu"))
    got = units.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(rate - F.col("mu"), F.lit(2)) - spread).alias("over"),
        F.sum(spread * (F.col("n") - 1)).alias("most"),
    )
    rho = F.least(F.lit(0.5), F.greatest(F.lit(0.001), F.coalesce(F.expr("try_divide(over, most)"), F.lit(0.5))))
    return got.select((1 / rho - 1).alias("strength"))


def reputation(hosts: DataFrame) -> DataFrame:
    """``hosts`` (host, n, k: labelled pages and good ones) with suffix, domain and the posterior (alpha, beta).

    One row per distinct host, with or without labels.
    """
    named = hosts.withColumn("suffix", suffix(F.col("host"))).withColumn("domain", domain(F.col("host"), F.col("suffix")))
    n, k = F.sum("n").alias("n"), F.sum("k").alias("k")
    domains = named.groupBy("suffix", "domain").agg(n, k)
    suffixes = domains.groupBy("suffix").agg(n, k)
    overall = suffixes.agg(F.expr("(coalesce(sum(k), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0)").alias("mu"))

    def shrunk(units: DataFrame) -> DataFrame:
        strength = _strength(units).scalar()
        return units.withColumn("strength", F.coalesce(strength, F.lit(1.0)))

    mean = (F.col("k") + F.col("strength") * F.col("mu")) / (F.col("n") + F.col("strength"))
    top = shrunk(suffixes.withColumn("mu", overall.scalar())).select("suffix", mean.alias("mu"))
    mid = shrunk(domains.join(top, "suffix")).select("domain", mean.alias("mu"))
    low = shrunk(named.join(mid, "domain"))
    return low.select(
        "host", "domain", "suffix", "n", "k", (F.col("k") + F.col("strength") * F.col("mu")).alias("alpha"),
        (F.col("n") - F.col("k") + F.col("strength") * (1 - F.col("mu"))).alias("beta"),
    )


def upper_bound(alpha: Column, beta: Column, z: float) -> Column:
    """Mean plus z standard deviations of the beta distribution, at most 1."""
    total = alpha + beta
    mean = alpha / total
    return F.least(F.lit(1.0), mean + z * F.sqrt(mean * (1 - mean) / (total + 1)))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], page_col: str = "page_id", url_col: str = "url",
    outcome_page_col: str = "page_id", good_col: str = "good", min_good: float = 0.5, z: float = 2.0,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, good_rate, good_rate_upper) of every page.

    ``outcomes`` has boolean or 0/1 ``good_col`` for some pages.
    """
    seen = pages.select(F.col(page_col).alias("page_id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    label = F.col(good_col).cast("int")
    labels = outcomes.filter(F.col(outcome_page_col).isNotNull() & label.isNotNull()).groupBy(F.col(outcome_page_col).alias("labelled")).agg(
        F.count("*").alias("ln"), F.sum(label).alias("lk"))
    hosts = seen.join(labels, seen.page_id == labels.labelled, "left").groupBy("host").agg(
        F.coalesce(F.sum("ln"), F.lit(0)).alias("n"), F.coalesce(F.sum("lk"), F.lit(0)).alias("k"))
    posts = reputation(hosts).select(
        F.col("host").alias("of"), (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("good_rate"),
        upper_bound(F.col("alpha"), F.col("beta"), z).alias("good_rate_upper"),
    )
    rule, ruled = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("good_rate_upper") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return seen.join(posts, seen.host == posts.of).select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, own).alias("verdict"), "good_rate", "good_rate_upper",
    )
