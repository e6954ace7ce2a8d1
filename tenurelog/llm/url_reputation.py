"""URL filter by rules and by the empirical-Bayes reputation of hosts.

Each labelled page is a trial of its host, good or bad. Hosts have few trials,
so their rate of good pages is shrunk: the suffix towards all pages, the
registered domain towards its suffix, the host towards its domain. Each level is
beta-binomial; the strength of its prior comes from the spread of the units
around their parents by the method of moments, so units that differ a lot are
trusted early and units that differ no more than chance allows are pooled. A
host is blocked when the upper bound of its posterior rate, mean plus ``Z``
standard deviations, is below ``floor``: bad beyond doubt. Rules go first.

DataFrame functions only. Pages are grouped to hosts with partial counts before
the shuffle, and the verdicts go back to the pages by one join, in which adaptive
execution splits a frequent host.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .workspace import Workspace

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z = 1.645
FLOOR = 0.5
# Labels under which countries register domains (``co.uk``, ``com.mx``, ``go.jp``), and
# suffixes under which hosts of separate owners stand; more of these can be passed in.
REGISTRY_LABELS = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "gv", "id", "info", "mil", "ne", "net", "nom", "or", "org", "sch")
TWO_LABEL_SUFFIXES = ("blogspot.com", "github.io", "gitlab.io", "herokuapp.com", "netlify.app", "pages.dev", "vercel.app", "wordpress.com")

Rules = Sequence[tuple[str, str]]


def url_host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_name(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")


def suffix_and_domain(name: Column, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> tuple[Column, Column]:
    """The suffix under which a host's domain is registered, and that domain.

    The suffix is the last label, or the last two if they are a registry label under
    a country (two letters) or one of ``two_label``.
    """
    two, last = F.substring_index(name, ".", -2), F.substring_index(name, ".", -1)
    country = (F.length(last) == 2) & F.substring_index(two, ".", 1).isin(list(REGISTRY_LABELS))
    long = country | two.isin(list(two_label))
    suffix = F.when(long, two).otherwise(last)
    return suffix, F.when(long, F.substring_index(name, ".", -3)).otherwise(two)


def rule_of(host: Column, path: Column, rules: Rules) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; NULL if none does."""
    which, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # Built from the last resort up; of equally long ones the smaller text and block win.
    for said, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1], r[0] != "block"), reverse=True):
        at, slash, below = rule.partition("/")
        fits = ((host == at) | host.endswith(f".{at}")) & path.startswith(slash + below)
        which = F.when(fits, F.lit(rule)).otherwise(which)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return which, verdict


def _strength(units: DataFrame, mean: str) -> float:
    """Prior strength of a level from (n, k) of its units and the mean of their parents."""
    m = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col(mean)))
    spread = F.col("n") * F.pow(F.col("k") / F.col("n") - m, 2) / (m * (1 - m))
    q, units_, trials = units.agg(F.sum(spread), F.count(F.lit(1)), F.sum("n")).first()
    if not units_ or trials <= units_:
        return 1.0
    share = min(0.99, max(0.001, (q - units_) / (trials - units_)))
    return 1 / share - 1


def _shrunk(prior: str, strength: float) -> Column:
    return (F.lit(strength) * F.col(prior) + F.col("k")) / (F.lit(strength) + F.col("n"))


def host_reputation(hosts: DataFrame, labelled: DataFrame, work: Workspace, two_label: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(name, n_labelled, posterior_mean, posterior_upper) of every ``hosts.name``.

    ``labelled`` has a row (name, good) per outcome. A host without outcomes gets
    the prior of its domain, a domain without any that of its suffix.
    """
    suffix, domain = suffix_and_domain(F.col("name"), two_label)
    # One row per host from here on.
    counted = (
        hosts.select("name", F.lit(0).alias("n"), F.lit(0).alias("k"))
        .union(labelled.select("name", F.lit(1).alias("n"), F.col("good").alias("k")))
        .groupBy("name")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )
    every = work.write(counted.withColumns({"suffix": suffix, "domain": domain}), "hosts")

    def level(key: str, *also: str) -> DataFrame:
        return every.groupBy(key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"), *[F.first(c).alias(c) for c in also])

    n, k = every.agg(F.sum("n"), F.sum("k")).first()
    suffixes = level("suffix").withColumn("m0", F.lit((k + 1) / (n + 2) if n else 0.5))
    suffixes = suffixes.withColumn("m1", _shrunk("m0", _strength(suffixes.where("n > 0"), "m0"))).select("suffix", "m1")
    domains = work.write(level("domain", "suffix").join(suffixes, "suffix"), "domains")
    domains = domains.withColumn("m2", _shrunk("m1", _strength(domains.where("n > 0"), "m1"))).select("domain", "m2")
    judged = every.join(domains, "domain")
    strength = _strength(judged.where("n > 0"), "m2")
    n, k = F.col("n"), F.col("k")
    a, b = strength * F.col("m2") + k, strength * (1 - F.col("m2")) + n - k
    mean = a / (a + b)
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return judged.select("name", n.alias("n_labelled"), mean.alias("posterior_mean"), (mean + Z * deviation).alias("posterior_upper"))


def judge_urls(
    pages: DataFrame,
    labelled: DataFrame,
    rules: Rules,
    id_col: str = "page_id",
    url_col: str = "url",
    floor: float = FLOOR,
    two_label: Sequence[str] = TWO_LABEL_SUFFIXES,
) -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule``, ``verdict``, ``n_labelled`` and the posterior.

    ``labelled`` has the columns ``url`` and ``good`` (1 or 0), one row per
    outcome; rows with a NULL are left out. ``rules`` are pairs of ``allow`` or
    ``block`` and host, slash and beginning of the path; the longest that fits
    decides, otherwise the posterior bound does. The posterior is rounded to six
    places.

    A NULL url, or one without ``://``, has an empty host and path; the empty
    host is judged like any other. Without any outcome every rate is 1/2 and
    nothing is blocked. Repeated pages each get a row. Other columns are ignored;
    an empty table gives an empty result.
    """
    url = F.col(f"`{url_col}`").cast("string")
    parts = pages.select(F.col(f"`{id_col}`").alias("_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    parts = parts.withColumn("name", host_name(F.col("host")))
    trials = labelled.where("url IS NOT NULL AND good IS NOT NULL").select(
        host_name(url_host(F.col("url"))).alias("name"), F.col("good").cast("int").alias("good")
    )
    reputation = host_reputation(parts, trials, Workspace(pages.sparkSession, "hosts"), two_label)
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    upper = F.round("posterior_upper", 6)
    return parts.join(reputation, "name", "left").select(
        F.col("_id").alias(id_col),
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(said, F.when(upper < floor, "block").otherwise("allow")).alias("verdict"),
        F.col("n_labelled").cast("long").alias("n_labelled"),
        F.round("posterior_mean", 6).alias("posterior_mean"),
        upper.alias("posterior_upper"),
    )
