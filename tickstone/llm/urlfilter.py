"""URL filter: fixed rules first, then an empirical-Bayes reputation of the host.

Each labelled page is a good or bad outcome of its host.  A level's bad rate has a
beta prior whose mean is the posterior mean one level up (all pages, suffix,
registered domain, host) and whose strength is estimated from how much the rates of
that level differ beyond chance (method of moments).  A host is blocked when even
the lower posterior bound of its bad rate is above the limit, so that thin evidence
never blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scratch import materialise
from .common import lower_ascii, salted_lookup

#: Two-label suffixes under which domains are registered; all others have one label.  A
#: table of public suffixes can be given instead.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "net.au", "co.nz", "co.jp", "com.br", "co.in", "com.cn")
#: The suffix of hosts that are addresses.
ADDRESS = "address"
#: Bad rate that a host's lower bound must exceed to be blocked.
LIMIT = 0.5
#: Standard deviations from the posterior mean to its bound.
BOUND = 1.645
#: Range of a prior's strength, in pages.
WEAKEST, STRONGEST = 1.0, 1000.0

#: (verdict, rule); a rule is a host and the start of a path.
RULES = (
    ("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
    ("block", "net/es/"), ("block", "net/fr/"),
)


def host_of(url: Column) -> Column:
    """What stands between ``://`` and the path, A-Z in lower case; else empty."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, "://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """The path without query and fragment; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, as a struct of ``verdict`` and ``rule``; else null.

    A rule fits its host and every host below it, if the path starts with its own.
    """
    out = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, _, rest = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + rest)
        made = F.struct(F.lit(verdict).alias("verdict"), F.lit(rule).alias("rule"))
        out = F.when(fits, made).otherwise(out)
    return out


def site_of(host: Column) -> Column:
    """The host whose reputation counts: without user and port; null when empty."""
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    return F.when(bare != "", bare)


def is_address(site: Column) -> Column:
    """Whether a site is an address and not a name: four numbers, or in brackets."""
    return site.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$") | site.startswith("[")


def with_domains(sites: DataFrame, suffixes: Sequence[str] | DataFrame = SUFFIXES) -> DataFrame:
    """``sites`` (one row per ``host``) with ``suffix`` and ``domain``.

    ``suffixes`` are two-label ones, or a DataFrame whose first column lists public
    suffixes of any number of labels; the longest a site ends with is its own, else the
    last label.  Addresses share the suffix ``ADDRESS``, and each is its own domain.
    """
    site = F.col("host")
    if not isinstance(suffixes, DataFrame):
        suffix, domain = suffix_of(site, suffixes), domain_of(site, suffixes)
    else:
        listed = suffixes.select(lower_ascii(F.col(suffixes.columns[0])).alias("tail")).distinct()
        labels = F.split(site, "\\.")

        def last(k: Column) -> Column:
            k = F.least(k, F.size(labels))
            return F.array_join(F.slice(labels, F.size(labels) - k + 1, k), ".")

        tails = F.transform(F.sequence(F.lit(1), F.size(labels)), last)
        # A tail such as ``com`` is that of very many hosts.
        tried = salted_lookup(
            sites.select("host", F.explode(tails).alias("tail")), listed.withColumn("is", F.lit(True)),
            ["tail"], F.xxhash64("host"),
        ).filter("is")
        longest = tried.groupBy("host").agg(
            F.max(F.size(F.split("tail", "\\."))).alias("long")
        ).withColumnRenamed("host", "_host")
        sites = sites.join(longest, F.col("host") == F.col("_host"), "left").drop("_host")
        n = F.coalesce("long", F.lit(1))
        suffix, domain = last(n), last(n + 1)
    return sites.withColumns({
        "suffix": F.when(is_address(site), ADDRESS).otherwise(suffix),
        "domain": F.when(is_address(site), site).otherwise(domain),
    })


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The public suffix: the last two labels if listed, else the last."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The registered domain: one label more than the suffix."""
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(two)


def _strength(level: DataFrame) -> float:
    """Strength of the beta prior of one level, by the method of moments.

    From rows with ``n``, ``bad`` and prior mean ``m``: the spread of the rates
    around their prior beyond what sampling explains.  One aggregated row.
    """
    got = level.agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"),
        F.count(F.lit(1)).alias("k"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("m"), 2)).alias("between"),
        F.sum(F.col("m") * (1 - F.col("m"))).alias("within"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("mass"),
    ).first()
    if not got["k"] or not got["mass"]:
        return STRONGEST
    # E[between] = within + rho * (mass - within) with rho = 1 / (strength + 1).
    spare = got["mass"] - got["within"]
    rho = (got["between"] - got["within"]) / spare if spare > 0 else 0.0
    return STRONGEST if rho <= 0 else min(STRONGEST, max(WEAKEST, 1 / rho - 1))


def reputations(
    outcomes: DataFrame, suffixes: Sequence[str] | DataFrame = SUFFIXES
) -> DataFrame:
    """``host, n, bad, mean, bound`` from labelled pages with ``host`` and ``is_bad``.

    Pages without a host teach nothing; hosts that differ in user or port are one.
    """
    hosts = outcomes.withColumn("host", site_of(F.col("host"))).filter("host is not null").groupBy(
        "host"
    ).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("is_bad").cast("long")).alias("bad"))
    # Stored: a host with its counts is looked at once for each level.
    hosts = materialise(with_domains(hosts, suffixes))
    whole = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (whole["bad"] + 0.5) / (whole["n"] + 1) if whole["n"] else 0.5

    def rates(*by):
        return hosts.groupBy(*by).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def posterior(strength):
        return (F.lit(strength) * F.col("m") + F.col("bad")) / (F.lit(strength) + F.col("n"))

    suffixes = rates("suffix").withColumn("m", F.lit(overall))
    suffixes = suffixes.select("suffix", posterior(_strength(suffixes)).alias("m"))
    domains = rates("suffix", "domain").join(suffixes, "suffix")
    domains = domains.select("domain", posterior(_strength(domains)).alias("m"))
    salt = F.xxhash64("host")  # one domain may hold very many hosts
    each = salted_lookup(hosts, domains, ["domain"], salt)
    s = F.lit(_strength(each))
    a, b = s * F.col("m") + F.col("bad"), s * (1 - F.col("m")) + F.col("n") - F.col("bad")
    mean = a / (a + b)
    sd = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return each.select("host", "n", "bad", mean.alias("mean"), (mean - F.lit(BOUND) * sd).alias("bound"))


def filter_urls(
    pages: DataFrame, labels: DataFrame, page_id: str = "page_id", url: str = "url",
    label_id: str = "doc_id", rules: Sequence[tuple[str, str]] = RULES,
    suffixes: Sequence[str] | DataFrame = SUFFIXES,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, bound``, one row per page.

    A page is a bad outcome if a label calls it low quality or toxic.  A rule
    decides where one fits; else the host's bound does, whatever the user or port it is
    named with, and a host without labelled pages is allowed, as is a null or malformed
    url (empty host and path).
    Repeated labels of a page count once, bad if any is.
    """
    cut = pages.select(
        F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    bad = F.coalesce(F.col("quality") == 0, F.lit(False)) | F.coalesce(F.col("toxic") == 1, F.lit(False))
    judged = labels.filter("quality is not null or toxic is not null").groupBy(
        F.col(label_id).alias("page_id")
    ).agg(F.max(bad).alias("is_bad"))
    known = reputations(cut.select("page_id", "host").join(judged, "page_id"), suffixes)
    known = known.select(F.col("host").alias("site"), "bound")
    sited = cut.withColumn("site", site_of(F.col("host")))
    rows = salted_lookup(sited, known, ["site"], F.xxhash64("page_id"))
    rule = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return rows.withColumn("_r", rule).select(
        "page_id", "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce("_r.verdict", own).alias("verdict"), "bound",
    )
