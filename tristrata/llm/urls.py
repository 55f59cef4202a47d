"""URL filters: listed rules first, else the reputation of the host.

Reputation is empirical Bayes over labelled pages. The rate of bad pages of a host has a beta prior
around that of its registered domain, the domain one around its suffix, the suffix one around the
whole. What a level takes from its parent leaves its own pages out, so no page speaks twice. How
strongly a level holds to its parent is estimated from how far the children's rates scatter beyond
chance (method of moments for the beta-binomial). A host is blocked if the lower
posterior bound of its rate is above a limit, so little evidence does not block.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tristrata.llm.rows import Shelf

# (verdict, host and path)
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
# Endings of two labels under which domains are registered; elsewhere it is the last label.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "co.za", "co.in",
    "co.kr", "com.br", "com.cn", "com.mx", "com.tr",
)
LIMIT = 0.3  # lower bound of the rate of bad pages beyond which a host is blocked
DEVIATIONS = 1.645  # below the posterior mean: one chance in twenty
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str | Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest.substr(F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the url's or a parent of it and whose path starts the url's."""
    out = F.lit(None).cast("string")
    for _, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, rule).otherwise(out)
    return out


def _posterior(child: DataFrame) -> DataFrame:
    """Adds ``mean`` and ``weight`` of every row; ``child`` has n, bad, ``centre``, ``prior`` and ``over``.

    ``centre`` is the parent's rate, around which its children scatter; ``prior`` is what its other pages
    say, worth ``over`` pages. ``weight`` is the number of pages that what is known of the rate is worth.
    What is uncertain about the parent adds to the spread among its children.
    """
    chance = F.col("centre") * (1 - F.col("centre"))
    scatter = F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("centre"), F.lit(2.0)))
    ratio = (scatter - F.sum(chance)) / F.sum(chance * (F.col("n") - 1))
    spread = child.where("n > 0").agg(
        F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.coalesce(F.when(F.sum(chance * (F.col("n") - 1)) > 0, ratio), F.lit(0.001)))).alias("_rho")
    )
    strength = F.greatest(F.lit(0.01), 1 / (F.col("_rho") + 1 / (F.col("over") + 1)) - 1)
    return child.join(F.broadcast(spread)).select(  # one row
        *child.columns, strength.alias("strength"), (F.col("n") + strength).alias("weight"),
        ((F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)).alias("mean"),
    )


def _under(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """``child`` with its parent's ``centre``, and the ``prior`` from the parent's other pages with the pages ``over`` it is worth."""
    side = parent.select(F.col(key).alias("_key"), F.col("mean").alias("centre"), *(F.col(c).alias(f"_{c}") for c in ("n", "bad", "prior", "strength")))
    over = F.col("_n") - F.col("n") + F.col("_strength")
    prior = (F.col("_bad") - F.col("bad") + F.col("_strength") * F.col("_prior")) / over
    return child.join(side, F.col(key) == F.col("_key")).select(*child.columns, "centre", prior.alias("prior"), over.alias("over"))


def registered(host: Column, suffixes=SUFFIXES) -> tuple[Column, Column]:
    """Suffix and registered domain of a host: the suffix and one more label, or the host if there is none."""
    two = F.substring_index(host, ".", -2)
    listed = two.isin(list(suffixes))
    return F.when(listed, two).otherwise(F.substring_index(host, ".", -1)), F.when(listed, F.substring_index(host, ".", -3)).otherwise(two)


def reputations(pages: DataFrame, outcomes: DataFrame, suffixes=SUFFIXES) -> DataFrame:
    """``host`` with ``n``, ``bad``, ``mean`` and ``bound`` for every host of ``pages`` (host, page).

    ``outcomes`` has (page, bad): bad is 0, 1 or null for no label; of several labels of a page the
    worst counts. ``suffixes`` are endings of two labels that count as one; elsewhere the suffix is the
    last label. Tables without a page give no rows.
    """
    shelf = Shelf(pages)
    known = outcomes.groupBy("page").agg(F.max("bad").alias("bad")).where("bad is not null and page is not null")
    hosts = shelf.put(
        pages.join(known, "page", "left").groupBy("host").agg(
            F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")
        ).withColumns(dict(zip(("suffix", "domain"), registered(F.col("host"), suffixes)))),
        "hosts",
    )
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    n, bad = (F.coalesce(F.sum(c), F.lit(0)) for c in ("n", "bad"))
    whole = hosts.agg(n.alias("_n"), bad.alias("_bad"))
    over = F.col("_n") - F.col("n") + 1.0
    top = hosts.groupBy("suffix").agg(*sums).join(F.broadcast(whole)).select(  # one row
        "suffix", "n", "bad", ((F.col("_bad") + 0.5) / (F.col("_n") + 1.0)).alias("centre"),
        ((F.col("_bad") - F.col("bad") + 0.5) / over).alias("prior"), over.alias("over"),
    )
    by_suffix = shelf.put(_posterior(top), "suffixes")
    by_domain = shelf.put(_posterior(_under(hosts.groupBy("suffix", "domain").agg(*sums), by_suffix, "suffix")), "domains")
    scored = _posterior(_under(hosts, by_domain, "domain"))
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return scored.select("host", "n", "bad", "mean", (F.col("mean") - DEVIATIONS * deviation).alias("bound"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules=RULES, limit: float = LIMIT,
    page_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """``page``, ``host``, ``path``, ``rule``, ``verdict`` and the host's ``n``, ``bad``, ``mean`` and ``bound`` of every row.

    The verdict is the rule's if one fits, else that of the host's reputation. Null urls have an
    empty host, which has a reputation like any other. Rows that repeat a page count each; long urls are
    read whole; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    host, path = parts(url_col)
    split = pages.select(F.col(page_col).alias("page"), host.alias("host"), path.alias("path"))
    known = Shelf(pages).put(reputations(split.select("page", "host"), outcomes), "reputations")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    listed = F.lit(None).cast("string")
    for verdict, text in rules:
        listed = F.when(F.col("rule") == text, verdict).otherwise(listed)
    return split.join(known.select("host", "n", "bad", "mean", "bound"), "host").withColumn("rule", rule).select(
        "page", "host", "path", "rule",
        F.coalesce(listed, F.when(F.col("bound") > limit, "block").otherwise("allow")).alias("verdict"),
        "n", "bad", "mean", "bound",
    )
