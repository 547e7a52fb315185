"""URL filter: explicit rules, and empirical-Bayes host reputation for what no rule decides.

Outcomes are labelled pages; without labels of their own, pages are labelled by what their html
shows (``junk``). Rules never label: a rule on a path says nothing about a host's other pages. Bad
shares are shrunk step by step: a suffix towards all pages, a registered domain towards its suffix,
a host towards its domain. Each step is beta-binomial: its prior has the parent's posterior mean,
and a strength fitted by moments over all groups of the level. Where nearly all hosts are alike that
strength is high; so that a host unlike them still shows, its prior is a mixture with a flat part of
weight ``ODD``. A host is blocked when even a low bound of its posterior share is above ``LIMIT``.

Only DataFrame functions are used. Groups are counted with partial aggregation, so a host with a
third of all pages is one row per task, and html is read once; the page table joins the reputations
by host.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowferry.llm.common import pick, stored
from rowferry.session import tune

#: (host, path, verdict). A rule fits its host and all subdomains and paths that start like its own.
Rule = tuple[str, str, str]
# The rules of the contract.
RULES: tuple[Rule, ...] = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: A host is bad when mean - Z * deviation of its posterior is above LIMIT.
LIMIT, Z = 0.5, 1.645
#: Bounds of a prior's strength, in pages, and the strength where the data cannot tell.
WEAKEST, STRONGEST, UNSURE = 1.0, 1000.0, 10.0
#: Share of hosts that may be like no other.
ODD = 0.01
#: A page is junk when one of these is exceeded: signs per sign other than space, upper case per letter,
#: exclamation marks, words of signs only and words that repeat the one before per word, repeated lines per line.
SIGNS, UPPER, SHOUTS, BARE, ECHOES, REPEATS = 0.3, 0.3, 0.1, 0.1, 0.2, 0.3


def host_of(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _name(host: Column) -> Column:
    """A host without user and port."""
    return F.regexp_replace(host, r"^.*@|:[0-9]*$", "")


_ADDRESS = r"^[0-9]+(\.[0-9]+){3}$|^\["
#: Suffixes of two labels, as in co.uk and com.br.
_SECOND = r"(^|\.)(ac|co|com|edu|go|gob|gouv|gov|mil|ne|net|nom|or|org|sch)\.[a-z]{2}$"


def domain_of(host: Column) -> Column:
    """The suffix and the label before it; an address is a domain of its own."""
    name = _name(host)
    return F.when(name.rlike(_ADDRESS), name).when(name.rlike(_SECOND), F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def suffix_of(host: Column) -> Column:
    """The last label, or the last two where both together are a suffix; all addresses share an empty one."""
    name = _name(host)
    return F.when(name.rlike(_ADDRESS), "").when(name.rlike(_SECOND), F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))


def junk(html: Column) -> Column:
    """1 if the text of a page is junk, else 0; null for a page without words.

    The text is what stands outside tags, scripts, styles, comments, title and first-level headings
    (which repeat a line of the text on sound pages too). A tag ends a line. Time grows with a page's
    length, also where a page of any length opens tags and never closes one, or is all blanks.
    """
    left = lambda t, pattern: F.length(F.regexp_replace(t, pattern, ""))
    number = lambda t, pattern: F.regexp_count(t, F.lit(pattern))

    def closed(h: Column) -> Column:
        """The page, and it up to the end of the last block in it: nothing after that can end a block."""
        return F.struct(h.alias("page"), F.regexp_extract(h, r"(?is)^.*(?:</(?:script|style|title|h1)\s*>|-->)", 0).alias("head"))

    def outside(c: Column) -> Column:
        blocks = F.regexp_replace(c["head"], r"(?is)<(script|style|title|h1)\b.*?</\1\s*>|<!--.*?-->", "\n")
        return F.concat(blocks, F.substring(c["page"], F.length(c["head"]) + 1, F.length(c["page"])))

    def plain(t: Column) -> Column:
        """Without tags and entities. What follows the last > is not searched for tags."""
        tail = F.substring_index(t, ">", -1)
        tagless = lambda text: F.regexp_replace(text, r"<[^>]*>", "\n")
        cut = F.concat(tagless(F.substring(t, F.lit(1), F.length(t) - F.length(tail))), tail)
        return F.regexp_replace(F.when(tail.contains("<"), cut).otherwise(tagless(t)), r"&[A-Za-z]+;|&#[0-9A-Za-z]+;", " ")

    def both(t: Column) -> Column:
        """The text, and the text with one letter for each run of letters and digits: blanks, signs and words are as many there."""
        return F.struct(t.alias("full"), F.regexp_replace(t, r"[\p{L}\p{N}]+", "a").alias("short"))

    def counts(c: Column) -> Column:
        t, short = c["full"], c["short"]
        lines = F.filter(F.split(t, r"(?<!\s)\s*\n\s*"), lambda line: line != "")
        return F.struct(
            (F.length(t) - F.length(short) + left(short, r"\s+")).alias("shown"), left(short, r"[\sa\p{L}\p{M}]+").alias("signs"), left(t, r"\P{L}+").alias("letters"), left(t, r"\P{Lu}+").alias("upper"),
            left(short, r"\s+|(?<=\S)\S+").alias("words"), left(short, r"[^!]+").alias("shouts"), number(short, r"(?<!\S)[^\s\p{L}]+(?!\S)").alias("bare"),
            number(t, r"(?<!\S)(\S+)\s+(?=\1(?!\S))").alias("echoes"), F.size(lines).alias("lines"), F.size(F.array_distinct(lines)).alias("kinds"),
        )

    def verdict(c: Column) -> Column:
        over = lambda part, whole, limit: c[part] > c[whole] * limit
        bad = over("signs", "shown", SIGNS) | over("upper", "letters", UPPER) | over("shouts", "words", SHOUTS) | over("bare", "words", BARE) | over("echoes", "words", ECHOES)
        return F.when(c["words"] > 0, (bad | (c["lines"] - c["kinds"] > c["lines"] * REPEATS)).cast("int"))

    # as elements of arrays, what each step gives is worked out once, however often the next one names it
    return F.get(functools.reduce(F.transform, (closed, outside, plain, both, counts, verdict), F.array(html)), F.lit(0))


def _rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; of equally long ones the first by name."""
    name = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def parse(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule and the rule's verdict."""
    tune(pages.sparkSession)
    chosen = pick(pages, page_id=id_col, url=url_col)
    split = chosen.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, verdict = _rule(F.col("host"), F.col("path"), rules)
    return split.select("page_id", "host", "path", name.alias("rule"), verdict.alias("ruled"))


def _strength(groups: DataFrame, mean: Column) -> float:
    """Strength of the beta prior by moments: how much the groups' shares differ beyond chance.

    ``groups`` has good numbers ``n`` and ``bad``; ``mean`` is the parent's share. One number.
    """
    spread = (F.col("bad") - F.col("n") * mean) ** 2
    chance = F.col("n") * mean * (1 - mean)
    more = F.col("n") * (F.col("n") - 1) * mean * (1 - mean)
    row = groups.agg(F.sum(spread - chance).alias("extra"), F.sum(more).alias("scale")).first()
    extra, scale = row["extra"] or 0.0, row["scale"] or 0.0
    if scale <= 0:
        return UNSURE
    rho = extra / scale
    if rho <= 0:
        return STRONGEST
    return min(max(1 / rho - 1, WEAKEST), STRONGEST)


def _log_gamma(x: Column) -> Column:
    """Stirling's series from x + 8 on; for x > 0, to some 1e-10."""
    y = x + 8
    down = sum((F.log(x + i) for i in range(1, 8)), F.log(x))
    return (y - 0.5) * F.log(y) - y + 0.9189385332046727 + 1 / (12 * y) - 1 / (360 * y * y * y) - down


def _log_beta(a: Column, b: Column) -> Column:
    return _log_gamma(a) + _log_gamma(b) - _log_gamma(a + b)


def reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of the bad share of every host.

    ``outcomes`` has host and bad (1, 0, or null for a page without a label). Returns host, alpha and
    beta of the fitted part, weight of the flat part, bound. Sums are taken per host first and stored,
    so all later steps see one row per host at most.
    """
    hosts = stored(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")), "hosts")
    # as doubles, since products of three counts pass what a bigint holds from some 300,000 pages of a host on
    hosts = hosts.withColumns({"n": F.col("n").cast("double"), "bad": F.col("bad").cast("double"), "domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)

    def shrink(df: DataFrame, mean: Column, strength: float, name: str) -> DataFrame:
        return df.withColumn(name, (F.col("bad") + mean * strength) / (F.col("n") + strength))

    s = _strength(suffixes, F.lit(overall))
    suffixes = shrink(suffixes, F.lit(overall), s, "suffix_mean").select("suffix", "suffix_mean")
    domains = domains.join(suffixes, "suffix")
    d = _strength(domains, F.col("suffix_mean"))
    domains = shrink(domains, F.col("suffix_mean"), d, "domain_mean").select("domain", "domain_mean")
    hosts = hosts.join(domains, "domain")
    k = _strength(hosts, F.col("domain_mean"))
    first, second = F.col("domain_mean") * k, (1 - F.col("domain_mean")) * k
    alpha, beta = F.col("bad") + first, F.col("n") - F.col("bad") + second
    # how much likelier the counts are under the flat part; both parts leave out the same binomial factor
    gain = _log_beta(F.col("bad") + 1, F.col("n") - F.col("bad") + 1) - (_log_beta(alpha, beta) - _log_beta(first, second))
    weight = 1 / (1 + (1 - ODD) / ODD * F.exp(F.least(-gain, F.lit(700.0))))

    def moments(a: Column, b: Column) -> tuple[Column, Column]:
        return a / (a + b), a * b / ((a + b) * (a + b) * (a + b + 1))

    found = hosts.select("host", "n", "bad", alpha.alias("alpha"), beta.alias("beta"), weight.alias("weight"))
    (m, v), (m1, v1) = moments(F.col("alpha"), F.col("beta")), moments(F.col("bad") + 1, F.col("n") - F.col("bad") + 1)
    w = F.col("weight")
    mean = w * m1 + (1 - w) * m
    variance = w * v1 + (1 - w) * v + w * (1 - w) * (m1 - m) * (m1 - m)
    return found.select("host", "alpha", "beta", "weight", (mean - Z * F.sqrt(variance)).alias("bound"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Verdict on every page: page_id, host, path, rule, verdict.

    The rule's verdict where one fits; else block if the host's posterior bound is above ``LIMIT``,
    else allow. ``labels`` (page_id, bad 0 or 1; one row per page) replaces the outcomes that html
    gives; with neither, nothing is known of any host and what no rule decides is allowed. A null url, or one without ``://``, has an empty host and path, fits no rule, and is
    judged by the reputation of the empty host. Repeated rows count and are judged each; null ids
    stay null. An empty table gives no rows.
    """
    parsed = parse(pages, rules, id_col, url_col)
    if labels is None:
        html = pages[f"`{html_col}`"] if html_col in pages.columns else F.lit(None).cast("string")
        outcomes = pages.select(host_of(pages[f"`{url_col}`"]).alias("host"), junk(html).alias("bad"))
    else:
        known = labels.groupBy("page_id").agg(F.max("bad").alias("bad"))
        outcomes = parsed.select("page_id", "host").join(known, "page_id", "left").select("host", "bad")
    hosts = reputation(outcomes).select(F.col("host").alias("_host"), "bound")
    joined = parsed.join(hosts, F.col("host") == F.col("_host"), "left")
    own = F.when(F.col("bound") > LIMIT, "block").otherwise("allow")
    return joined.select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"))
