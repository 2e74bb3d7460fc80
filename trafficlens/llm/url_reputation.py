"""URL filter by rules and empirical-Bayes host reputation (operator 3).

Labelled page outcomes (bad or not) are counted per host, registered domain
and suffix. Each level's bad rate is a beta-binomial posterior whose prior is
centred on its parent's posterior mean, so a host with few labelled pages
leans on its domain, a domain on its suffix, a suffix on the whole table. The
prior's strength is estimated per level from the spread of the observed rates
(method of moments). A host is blocked when the lower bound of its posterior
lies above ``max_bad``. Only SQL functions are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .exact_dedup import UPPER


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end; A-Z lower-cased.
    Empty when the url is null or has no ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """What follows the host, up to ``? #`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_match(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """``rules`` is a list written by hand: (verdict, ``host/path``). The
    longest rule that fits wins; equally long ones in text order."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, text in sorted(rules, key=lambda r: (len(r[1]), r[1]), reverse=False):
        rhost, _, rpath = text.partition("/")
        fits = ((host == rhost) | F.endswith(host, F.lit("." + rhost))) & F.startswith(path, F.lit("/" + rpath))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return rule, verdict


def registered_domain(host: Column, second_level: Sequence[str] = ()) -> Column:
    """The last two labels of a host, or three under a suffix of
    ``second_level`` (such as ``co.uk``). A host of fewer labels is its own."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(list(second_level)), F.substring_index(host, ".", -3)).otherwise(two) if second_level else two


def host_reputation(outcomes: DataFrame, hosts: DataFrame, max_strength: float = 1000.0, second_level: Sequence[str] = ()) -> DataFrame:
    """Posterior of the bad rate for every host of ``hosts``.

    ``outcomes``: ``host, bad`` (0 or 1; rows with a null are left out).
    Returns ``host, labelled, bad_pages, rate, deviation``. Without any
    labelled page every host has rate 0.5 with the widest deviation.
    """
    seen = outcomes.where("host is not null and bad is not null").groupBy("host").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("bad").cast("double").alias("b")
    )
    levels = materialize(hosts.select("host").distinct().join(seen, "host", "left").select(
        "host",
        registered_domain(F.col("host"), second_level).alias("domain"),
        F.substring_index("host", ".", -1).alias("suffix"),
        F.coalesce("n", F.lit(0.0)).alias("n"),
        F.coalesce("b", F.lit(0.0)).alias("b"),
    ), name="host-outcomes")
    domains = levels.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("b").alias("b"))
    root = suffixes.agg(((F.sum("b") + 1.0) / (F.sum("n") + 2.0)).alias("mean"))

    suf = _shrink(suffixes, root, [], max_strength)
    dom = _shrink(domains, suf.select("suffix", "mean"), ["suffix"], max_strength)
    top = _shrink(levels, dom.select("suffix", "domain", "mean"), ["suffix", "domain"], max_strength)
    total = F.col("alpha") + F.col("beta")
    return top.select(
        "host",
        F.col("n").cast("long").alias("labelled"),
        F.col("b").cast("long").alias("bad_pages"),
        F.col("mean").alias("rate"),
        F.sqrt(F.col("alpha") * F.col("beta") / (total * total * (total + 1.0))).alias("deviation"),
    )


def _shrink(level: DataFrame, parent: DataFrame, on: list[str], max_strength: float) -> DataFrame:
    """Posterior of each row of a level around its parent's mean."""
    parent = parent.withColumnRenamed("mean", "prior")
    joined = level.join(parent, on) if on else level.join(F.broadcast(parent))  # the root is one row
    # spread of the rates around the prior beyond binomial noise -> strength s = (1 - rho) / rho
    q = F.col("prior") * (1.0 - F.col("prior"))
    strength = joined.where("n > 1").agg(
        F.sum((F.col("b") - F.col("n") * F.col("prior")) * (F.col("b") - F.col("n") * F.col("prior")) / q).alias("chi"),
        F.sum("n").alias("n1"),
        F.sum(F.col("n") * (F.col("n") - 1.0)).alias("n2"),
    ).select(
        F.coalesce(
            F.when(F.col("chi") > F.col("n1"), F.least(F.lit(max_strength), F.greatest(F.lit(1.0), F.col("n2") / (F.col("chi") - F.col("n1")) - 1.0))),
            F.lit(max_strength),
        ).alias("strength")
    )
    joined = joined.join(F.broadcast(strength))  # one row
    alpha = F.col("strength") * F.col("prior") + F.col("b")
    beta = F.col("strength") * (1.0 - F.col("prior")) + F.col("n") - F.col("b")
    return joined.withColumn("alpha", alpha).withColumn("beta", beta).withColumn("mean", F.col("alpha") / (F.col("alpha") + F.col("beta")))


def filter_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    max_bad: float = 0.5,
    z: float = 1.645,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """One row per page: ``<id_col>, host, path, rule, verdict, method_verdict,
    rate, bound``.

    ``outcomes``: ``<id_col>, bad``; null and unknown ids are left out, an id
    that occurs twice counts twice. ``bound`` is the lower posterior bound
    ``rate - z * deviation``; the method blocks above ``max_bad`` and allows
    otherwise. A url that is null or lacks ``://`` has empty host and path and
    is judged as the host ``''``. The host join is by value, so a host with a
    third of all pages is split by adaptive execution.
    """
    url = F.col(url_col).cast("string")
    base = pages.select(F.col(id_col), url_host(url).alias("host"), url_path(url).alias("path"))
    labelled = outcomes.select(F.col(id_col), F.col("bad").cast("double").alias("bad")).join(base.select(id_col, "host"), id_col).select("host", "bad")
    rep = host_reputation(labelled, base).withColumn("bound", F.col("rate") - F.lit(z) * F.col("deviation"))
    rule, says = rule_match(F.col("host"), F.col("path"), rules)
    method = F.when(F.col("bound") > max_bad, "block").otherwise("allow")
    return base.join(rep, "host").select(
        id_col,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(says, method).alias("verdict"),
        method.alias("method_verdict"),
        "rate",
        "bound",
    )
