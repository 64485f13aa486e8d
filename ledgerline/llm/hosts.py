"""Host reputation: labelled outcomes shrunk by beta-binomial priors, host to registered domain to suffix."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.base import cut

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# fixed values: second labels that with a two-letter country form a suffix under which names are registered
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Strengths tried for the prior of a level, in labelled pages.
STRENGTHS = tuple(2.0 ** (j / 2) for j in range(-2, 25))
#: A host is blocked where its share of bad pages is above LIMIT with at least this probability.
LIMIT, SURE = 0.5, 0.95
#: Simpson's rule over the posterior: intervals on each side, reach in scaled units.
NODES, REACH = 256, 8.0


class Level(NamedTuple):
    """What shrinks the children of a level: their parent's key and the strength of the prior."""
    key: str
    strength: float


class Reputation(NamedTuple):
    """``mean``: share of bad labelled pages; ``levels``: suffix, domain, host; ``counts``: labelled hosts."""
    mean: float
    levels: tuple[Level, ...]
    counts: DataFrame


def with_host(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (lower-cased A-Z) and path of a url; both empty for a null url or one without ``://``."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    found = "(?s)^.*?://([^/?#]*)([^?#]*)"
    return pages.withColumns({"host": F.translate(F.regexp_extract(url, found, 1), UPPER, LOWER),
                              "path": F.regexp_extract(url, found, 2)})


def with_domain(hosts: DataFrame) -> DataFrame:
    """Adds the registered domain and the suffix of ``host``. User, port and a last dot don't count; an
    address of digits is its own domain, without a suffix."""
    bare = F.regexp_replace("host", r"^.*@|:[^:\]]*$", "")
    bare = F.rtrim(bare, F.lit("."))
    part = F.split(bare, r"\.")
    n = F.size(part)
    two = (n > 2) & (F.length(F.element_at(part, -1)) == 2) & F.element_at(part, F.greatest(-n, F.lit(-2))).isin(*SECOND_LEVEL)
    last = F.when(two, 2).otherwise(1)
    tail = lambda k: F.array_join(F.slice(part, F.greatest(n - k + 1, F.lit(1)), k), ".")
    digits = bare.rlike(r"^[0-9.]+$")
    return hosts.withColumns({"domain": F.when(digits, bare).otherwise(tail(last + 1)),
                              "suffix": F.when(digits, F.lit("")).otherwise(tail(last))})


def ln_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0: Stirling's series beyond seven recurrence steps."""
    y = x + 7
    product = x
    for k in range(1, 7):
        product = product * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * F.pow(y, 5)) - 1 / (1680 * F.pow(y, 7))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def ln_beta(a: Column, b: Column) -> Column:
    return ln_gamma(a) + ln_gamma(b) - ln_gamma(a + b)


def strength_of(children: DataFrame) -> float:
    """The strength under which the children's outcomes (n, bad, parent's mean m) are likeliest, for
    beta-binomial outcomes with prior mean m; the smallest of equals."""
    s = F.col("s")
    a, b = s * F.col("m"), s * (1 - F.col("m"))
    fit = ln_beta(F.col("bad") + a, F.col("n") - F.col("bad") + b) - ln_beta(a, b)
    tried = children.withColumn("s", F.explode(F.array(*map(F.lit, STRENGTHS)))) \
        .groupBy("s").agg(F.round(F.sum(fit), 6).alias("fit"))
    best = tried.where("fit IS NOT NULL").orderBy(F.col("fit").desc(), "s").first()
    return best.s if best else STRENGTHS[0]


def shrunk(strength: float) -> Column:
    """Posterior mean of a child under its parent's mean ``m``."""
    return (F.col("bad") + strength * F.col("m")) / (F.col("n") + strength)


def fit_reputation(pages: DataFrame, outcomes: DataFrame, id_col: str = "page_id") -> Reputation:
    """``pages`` (id, host) and ``outcomes`` (id, bad boolean) -> the priors of all three levels.

    Of several outcomes of an id, one that says bad counts; a page counts once for a host. Counts are
    aggregated before they are shuffled; the driver gets the overall mean and a strength for each level.
    """
    known = outcomes.select(F.col(id_col).alias("_id"), "bad").where("_id IS NOT NULL AND bad IS NOT NULL") \
        .groupBy("_id").agg(F.max("bad").alias("bad"))
    hit = pages.select(F.col(id_col).alias("_id"), "host").join(known, "_id").distinct()
    counts = cut(with_domain(hit.groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))))
    every = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((every.bad or 0) + 1) / ((every.n or 0) + 2)
    levels: list[Level] = []
    for key in ("suffix", "domain", "host"):
        levels.append(Level(key, strength_of(level_counts(counts, mean, levels, key))))
    return Reputation(mean, tuple(levels), counts)


def level_counts(counts: DataFrame, mean: float, above: list[Level], key: str) -> DataFrame:
    """The children of a level: key, n, bad and ``m``, the mean of their parent."""
    keys = [*(x.key for x in above), key]
    rows = counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    return with_parent(rows, counts, mean, above)


def with_parent(rows: DataFrame, counts: DataFrame, mean: float, above: list[Level]) -> DataFrame:
    """Adds ``m`` to rows that hold the keys of the levels above: the posterior mean of their parent. A
    parent without labelled pages passes on its own parent's mean."""
    if not above:
        return rows.withColumn("m", F.lit(mean))
    parents = level_counts(counts, mean, above[:-1], above[-1].key)
    keys = [x.key for x in above]
    parents = parents.select(*keys, shrunk(above[-1].strength).alias("_own"))
    return with_parent(rows, counts, mean, above[:-1]).join(parents, keys, "left") \
        .withColumn("m", F.coalesce("_own", "m")).drop("_own")


def share_above(limit: float, a: Column, b: Column) -> Column:
    """Probability that a Beta(a, b) share is above ``limit``: Simpson's rule over its log odds, whose
    density has one peak and falls on both sides; nodes are spread by a sinh, so that any size of a and b
    needs the same few."""
    u0, sd = F.log(a / b), F.sqrt(1 / a + 1 / b)
    softplus = lambda u: F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u)))
    peak = a * u0 - (a + b) * softplus(u0)
    edge = (math.log(limit / (1 - limit)) - u0) / sd
    # asinh without cancellation for a negative argument
    at = F.signum(edge) * F.log(F.abs(edge) + F.sqrt(edge * edge + 1))
    at = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), at))

    def area(low, high):
        step = (high - low) / NODES

        def add(total, i):
            v = low + step * i
            u = u0 + sd * F.sinh(v)
            weight = F.when((i == 0) | (i == NODES), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0)
            return total + weight * F.exp(a * u - (a + b) * softplus(u) - peak) * F.cosh(v)
        return F.aggregate(F.sequence(F.lit(0), F.lit(NODES)), F.lit(0.0), add) * step

    above = area(at, F.lit(REACH))
    return above / (above + area(F.lit(-REACH), at))


def blocked_hosts(hosts: DataFrame, fitted: Reputation, limit: float = LIMIT, sure: float = SURE) -> DataFrame:
    """host, labelled, bad, blocked for distinct ``hosts`` (host)."""
    rows = with_domain(hosts.select("host")).join(fitted.counts.select("host", "n", "bad"), "host", "left") \
        .withColumns({"n": F.coalesce("n", F.lit(0)), "bad": F.coalesce("bad", F.lit(0))})
    rows = with_parent(rows, fitted.counts, fitted.mean, list(fitted.levels[:-1]))
    s = fitted.levels[-1].strength
    prior = rows.withColumns({"a": F.col("bad") + s * F.col("m"), "b": F.col("n") - F.col("bad") + s * (1 - F.col("m"))})
    return prior.select("host", F.col("n").alias("labelled"), "bad",
                        (share_above(limit, F.col("a"), F.col("b")) >= sure).alias("blocked"))


def fitting_rules(places: DataFrame, rules: DataFrame) -> DataFrame:
    """``places`` (host, head) and ``rules`` (rule, verdict) -> host, head, rule, verdict of the longest
    rule that fits, for places that one fits.

    A rule is a host, then a path. Every place is joined by key with the ends of its host, each with the
    first characters of the head in every length that a rule's path has, so many rules on one host cost
    no more than few. Ties: the longer host, then block before allow.
    """
    r = rules.where("rule IS NOT NULL").select(
        "rule", "verdict", F.translate(F.regexp_extract("rule", "(?s)^([^/]*)", 1), UPPER, LOWER).alias("rh"),
        F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1).alias("rp"))
    lengths = sorted(x.n for x in r.select(F.length("rp").alias("n")).distinct().collect())
    ends = F.expr("transform(sequence(1, size(split(host, '[.]'))), "
                  "i -> array_join(slice(split(host, '[.]'), i, size(split(host, '[.]'))), '.'))")
    tried = places.select("host", "head", F.explode(ends).alias("rh")) \
        .withColumn("n", F.explode(F.array(*map(F.lit, lengths or [0])))).where("length(head) >= n") \
        .withColumn("rp", F.expr("substring(head, 1, n)")).drop("n")
    best = F.struct(-F.length("rule"), -F.length("rh"), F.when(F.col("verdict") == "block", 0).otherwise(1), "rule")
    return tried.join(r, ["rh", "rp"]).groupBy("host", "head").agg(
        F.min_by(F.struct("rule", "verdict"), best).alias("r")).select("host", "head", "r.rule", "r.verdict")


def judge(pages: DataFrame, outcomes: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url",
          limit: float = LIMIT, sure: float = SURE) -> DataFrame:
    """id, host, path, rule, verdict, labelled, bad for every row of ``pages``.

    ``outcomes`` has (id, bad) of labelled pages, ``rules`` (rule, verdict). The longest rule that fits
    decides; else the host's reputation: its share of bad pages has a beta posterior, whose prior has the
    mean of the host's registered domain, shrunk likewise to its suffix and that to all pages, and each
    level's strength is the one under which its outcomes are likeliest. A host is blocked where the share
    is above ``limit`` with probability ``sure`` (its lower posterior bound is above the limit); a host
    without labelled pages has its domain's prior.

    A null url, or one without ``://``, has an empty host and path, and the reputation of the empty host.
    A null id has no outcome; null outcomes don't count, nor do repeated rows of one page. Without outcomes nothing is
    blocked but by rules. Every row of ``pages`` gives one row, repeated rows too; an empty table none.
    Urls of any length are read whole. Other columns aren't read.
    """
    found = with_host(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url").drop("_url")
    fitted = fit_reputation(found.withColumnRenamed("_id", id_col), outcomes, id_col)
    longest = rules.agg(F.max(F.length(F.regexp_extract("rule", "(?s)^[^/]*(.*)$", 1)))).first()[0] or 0
    placed = found.withColumn("head", F.substring("path", 1, longest))
    places = placed.select("host", "head").distinct()
    hosts = blocked_hosts(places.select("host").distinct(), fitted, limit, sure)
    told = places.join(fitting_rules(places, rules), ["host", "head"], "left").join(hosts, "host") \
        .select("host", "head", "rule", F.coalesce("verdict", F.when(F.col("blocked"), "block").otherwise("allow"))
                .alias("verdict"), "labelled", "bad")
    return placed.join(told, ["host", "head"]) \
        .select(F.col("_id").alias(id_col), "host", "path", "rule", "verdict", "labelled", "bad")
