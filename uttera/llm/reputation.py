"""URL filter: explicit rules, else empirical-Bayes host reputation.

Outcomes of labelled pages are counted per host and shrunk level by level: the corpus' rate is the prior of a suffix, the
suffix' posterior mean the prior of a registered domain, the domain's the prior of a host. How many outcomes a prior is
worth is estimated from the counts at each level, by the method of moments: the more the groups' rates scatter about their
priors beyond what chance makes of their sizes, the less. A page is blocked if the lower bound of its host's posterior share
of bad pages, ``Z`` standard deviations below the mean, is above ``BLOCK_ABOVE``.

Defined results. A null URL or one without ``://`` has an empty host and path. Ports do not count for domains. A host without
a dot is its own domain and suffix, a numeric address its own domain, of a suffix of such addresses. Below country codes with
a second level for kinds of owners the domain has three labels. Hosts without outcomes have their domain's posterior. Without any outcome nothing is blocked but by a rule.
Null outcomes do not count. Repeated rows each count and give a row. Columns of the input stay; results replace columns
of their names.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from uttera.llm.common import ascii_lower, spare
from uttera.session import materialize

#: Bounds of what a prior is worth, in outcomes; the upper one where nothing can be estimated.
LEAST, MOST = 1.0, 200.0
Z = 1.645
BLOCK_ABOVE = 0.25
# Second levels under which country codes register domains.
SECOND_LEVELS = ("ac", "co", "com", "edu", "gov", "net", "org")
ADDRESS = "ip"


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, "://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule (verdict, ``host/path``) that fits a host or one above it and the path's beginning, and its verdict."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, pattern in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = pattern.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(pattern)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def with_levels(pages: DataFrame) -> DataFrame:
    """Registered domain and suffix of ``host``."""
    name = F.regexp_replace("host", ":[0-9]*$", "")
    address = name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    deep = name.rlike(rf"\.({'|'.join(SECOND_LEVELS)})\.[a-z][a-z]$")
    return pages.withColumns({
        "domain": F.when(address, name).when(deep, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2)),
        "suffix": F.when(address, ADDRESS).when(deep, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1)),
    })


def strength(groups: DataFrame) -> float:
    """The outcomes that a prior is worth, from groups (bad, n, prior): one sum over them.

    A group of n outcomes at rate m scatters by n m (1 - m) (1 + (n - 1) r) if its prior is worth 1 / r - 1 outcomes.
    """
    chance = F.col("n") * F.col("prior") * (1 - F.col("prior"))
    excess = F.sum(F.pow(F.col("bad") - F.col("n") * F.col("prior"), F.lit(2.0)) - chance)
    found = groups.agg(F.try_divide(excess, F.sum(chance * (F.col("n") - 1)))).first()[0]
    return min(MOST, max(LEAST, 1 / found - 1)) if found is not None and found > 0 else MOST


def reputations(outcomes: DataFrame) -> DataFrame:
    """Per host (host, mean, bound) from outcomes (host, domain, suffix, bad), a null outcome for a page without one.

    Counts are summed up before anything is shuffled by host, so a host with a third of all pages is one row like others.
    """
    bad, n = F.coalesce(F.sum(F.col("bad").cast("double")), F.lit(0.0)), F.count("bad").cast("double")
    hosts = materialize(outcomes.groupBy("suffix", "domain", "host").agg(bad.alias("bad"), n.alias("n")), "hosts")
    sums = F.sum("bad").alias("bad"), F.sum("n").alias("n")
    rate = hosts.agg(F.try_divide(F.sum("bad"), F.sum("n"))).first()[0] or 0.0
    suffixes = materialize(hosts.groupBy("suffix").agg(*sums).withColumn("prior", F.lit(rate)), "suffixes")
    above = suffixes.select("suffix", shrunk(strength(suffixes)).alias("prior"))
    domains = materialize(hosts.groupBy("suffix", "domain").agg(*sums).join(above, "suffix"), "domains")
    above = domains.select("suffix", "domain", shrunk(strength(domains)).alias("prior"))
    rated = materialize(hosts.join(above, ["suffix", "domain"]), "rated")
    return rated.select("host", *posterior(strength(rated)))


def shrunk(worth: float) -> Column:
    """Posterior mean of a beta prior with ``worth`` outcomes at the rate ``prior``."""
    return (F.col("bad") + worth * F.col("prior")) / (F.col("n") + worth)


def posterior(worth: float) -> tuple[Column, Column]:
    mean = shrunk(worth)
    spread = F.sqrt(mean * (1 - mean) / (F.col("n") + worth + 1))
    return mean.alias("mean"), (mean - Z * spread).alias("bound")


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], url: str = "url") -> DataFrame:
    """Adds host, path, rule, ``bad_mean``, ``bad_bound`` and verdict. ``outcomes``: url and bad (1, 0 or null)."""
    placed = pages.withColumns({"host": host_of(F.col(url)), "path": path_of(F.col(url))})
    unknown = placed.select("host", F.lit(None).cast("int").alias("bad"))
    known = outcomes.select(host_of(F.col("url")).alias("host"), F.col("bad").cast("int").alias("bad"))
    known = with_levels(known.unionByName(unknown))
    own_host = spare(pages, "_host")
    rated = reputations(known).select(F.col("host").alias(own_host), F.col("mean").alias("bad_mean"), F.col("bound").alias("bad_bound"))
    rated = materialize(rated, "reputations")
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    seen = placed.drop("bad_mean", "bad_bound").join(rated, F.col("host") == F.col(own_host), "left").drop(own_host)
    own = F.when(F.col("bad_bound") > BLOCK_ABOVE, "block").otherwise("allow")
    return seen.withColumns({"rule": rule, "verdict": F.coalesce(said, own)})
