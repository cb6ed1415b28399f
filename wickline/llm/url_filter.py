"""URL verdicts: explicit rules first, else empirical-Bayes host reputation. DataFrame functions only.

Labelled page outcomes are counted per host. Each level's rate is shrunk to its
parent's through a beta prior whose strength is estimated from the spread
between the groups of that level: all pages, then suffix, registered domain and
host. A page passes when the lower bound of its host's posterior reaches
``least``; a host never seen takes the posterior of its domain, suffix or all.

Defined cases: a null url, or one without ``://``, has an empty host and path,
fits no rule, and is judged by the overall rate; outcomes that are null are not
counted, several outcomes of a page count one by one; without any outcome the
prior is ``FIRST``; an empty table gives an empty result; further columns are
not touched.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wickline.llm.common import stored

Rule = tuple[str, str, str]  # host, path, verdict

#: Pseudo-counts (good, bad) behind the overall rate.
FIRST = (1.0, 1.0)
#: Bounds of the intraclass correlation, from which a prior of 1 / rho - 1 pages follows.
LEAST_RHO, MOST_RHO = 0.001, 0.5
#: A page passes from this posterior rate on, at Z standard deviations below the mean.
LEAST_RATE, Z = 0.5, 1.645
#: Suffixes of two labels under which names are registered; others have one label.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.in")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url, parts = F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)"
    return F.translate(F.regexp_extract(url, parts, 1), _UPPER, _LOWER), F.regexp_extract(url, parts, 2)


def _levels(host: Column, long_suffixes: Sequence[str]) -> tuple[Column, Column]:
    """The registered domain and the suffix of a host."""
    wide = F.substring_index(host, ".", -2).isin(*long_suffixes) if long_suffixes else F.lit(False)
    suffix = F.when(wide, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))
    domain = F.when(wide, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return domain, suffix


def _spread(groups: DataFrame) -> float:
    """Prior strength, in pages, from (n, good, prior): the spread of the rates around their priors.

    It is the analysis-of-variance estimate of the intraclass correlation.
    """
    rate, n = F.col("good") / F.col("n"), F.col("n")
    row = groups.agg(
        F.count("*").alias("k"),
        F.sum(n).alias("n"),
        F.sum(n * n).alias("nn"),
        F.sum(n * F.pow(rate - F.col("prior"), 2)).alias("between"),
        F.sum(n * rate * (1 - rate)).alias("within"),
    ).first()
    k, total = row["k"], float(row["n"] or 0)
    rho = LEAST_RHO
    if k > 1 and total > k:
        between, within = row["between"] / (k - 1), row["within"] / (total - k)
        size = (total - row["nn"] / total) / (k - 1)
        spread = between + (size - 1) * within
        rho = (between - within) / spread if spread > 0 else LEAST_RHO
    rho = min(MOST_RHO, max(LEAST_RHO, rho))
    return 1 / rho - 1


def _posterior(groups: DataFrame, strength: float) -> DataFrame:
    return groups.withColumn("alpha", F.col("prior") * strength + F.col("good")).withColumn(
        "beta", (1 - F.col("prior")) * strength + F.col("n") - F.col("good")
    )


def reputations(outcomes: DataFrame, long_suffixes: Sequence[str] = LONG_SUFFIXES) -> dict[str, DataFrame]:
    """Posteriors (key, alpha, beta) of level "all", "suffix", "domain" and "host".

    ``outcomes``: host, good (0 or 1, null where unknown).
    """
    domain, suffix = _levels(F.col("host"), long_suffixes)
    # One row a host after a map-side combine; all else is derived from this table.
    hosts = stored(
        outcomes.where("good is not null")
        .groupBy("host")
        .agg(F.count("*").cast("double").alias("n"), F.sum(F.col("good").cast("double")).alias("good"))
        .select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "good"),
        "hosts",
    )
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    alpha = FIRST[0] + float(total["good"] or 0)
    beta = FIRST[1] + float(total["n"] or 0) - float(total["good"] or 0)
    everything = hosts.sparkSession.createDataFrame([("", alpha, beta)], "key string, alpha double, beta double")
    found = {"all": everything}
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(alpha / (alpha + beta)))
    suffixes = _posterior(suffixes, _spread(suffixes))
    found["suffix"] = suffixes.select(F.col("suffix").alias("key"), "alpha", "beta")
    above = suffixes.select("suffix", (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("prior"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(above, "suffix")
    domains = _posterior(domains, _spread(domains))
    found["domain"] = domains.select(F.col("domain").alias("key"), "alpha", "beta")
    above = domains.select("domain", (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("prior"))
    known = hosts.join(above, "domain")
    known = _posterior(known, _spread(known))
    found["host"] = known.select(F.col("host").alias("key"), "alpha", "beta")
    return {level: stored(df, level) for level, df in found.items()}


def _rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; both null where none does."""
    text = verdict = F.lit(None).cast("string")
    for name, start, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        text, verdict = F.when(fits, F.lit(name + start)).otherwise(text), F.when(fits, F.lit(says)).otherwise(verdict)
    return text, verdict


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    least: float = LEAST_RATE,
    z: float = Z,
    long_suffixes: Sequence[str] = LONG_SUFFIXES,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict, and the posterior ``rate`` and ``bound`` of its host.

    ``outcomes``: page_id, good. Rules are configuration, compiled into one expression.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    labelled = parsed.select("page_id", "host").join(
        outcomes.select("page_id", "good").where("good is not null"), "page_id"
    )
    known = reputations(labelled.select("host", "good"), long_suffixes)
    domain, suffix = _levels(F.col("host"), long_suffixes)
    overall = known["all"].first()
    judged = parsed.withColumns({"domain": domain, "suffix": suffix, "all_alpha": F.lit(overall["alpha"]), "all_beta": F.lit(overall["beta"])})
    for level in ("host", "domain", "suffix"):
        # Rows of a hot host are split by the adaptive skew join; nothing is broadcast by hint.
        side = known[level].select(
            F.col("key").alias(level), F.col("alpha").alias(f"{level}_alpha"), F.col("beta").alias(f"{level}_beta")
        )
        judged = judged.join(side, level, "left")
    alpha, beta = (
        F.coalesce(*(F.col(f"{level}_{side}") for level in ("host", "domain", "suffix", "all")))
        for side in ("alpha", "beta")
    )
    total = alpha + beta
    rate, deviation = alpha / total, F.sqrt(alpha * beta / (total * total * (total + 1)))
    rule, says = _rule(F.col("host"), F.col("path"), rules)
    bound = rate - z * deviation
    return judged.select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(says, F.when(bound >= least, "allow").otherwise("block")).alias("verdict"),
        rate.alias("rate"),
        bound.alias("bound"),
    )
