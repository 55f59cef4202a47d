import duckdb
from pyspark.sql import functions as F

from tests.test_registry import rows as compared
from tristrata.llm import queries, urls

EMPTY = "page long, bad int"


def judged(spark, given, outcomes=(), limit=urls.LIMIT):
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(given)], "page_id long, url string, host string")
    return urls.judge(pages, spark.createDataFrame(list(outcomes), EMPTY), limit=limit)


def test_hosts_paths_and_rules(spark):
    cases = {
        None: ("", "", None), "": ("", "", None), "no scheme/com/": ("", "", None), "http://": ("", "", None),
        "HTTP://A.Example.COM/en/x?y#z": ("a.example.com", "/en/x", "example.com/en/"),
        "http://www.example.com/en/": ("www.example.com", "/en/", "www.example.com/en/"),
        "http://x.www.example.com/en/a": ("x.www.example.com", "/en/a", "www.example.com/en/"),
        "http://example.com/EN/": ("example.com", "/EN/", "com/"), "http://com": ("com", "", None),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/"), "http://a.net/es/://b.com/": ("a.net", "/es/://b.com/", "net/es/"),
        "x://a.net/fr/?q=/": ("a.net", "/fr/", "net/fr/"), "x://a.net#/es/": ("a.net", "", None), "x://ÀÉ.Net/es/": ("ÀÉ.net", "/es/", "net/es/"),
        "a\nb://q.org/\nz?": ("q.org", "/\nz", None), "http://" + "a" * 20000 + ".com/": ("a" * 20000 + ".com", "/", "com/"),
    }
    got = {r.page: (r.host, r.path, r.rule, r.verdict) for r in judged(spark, list(cases)).collect()}
    verdicts = dict((rule, verdict) for verdict, rule in urls.RULES)
    for i, (host, path, rule) in enumerate(cases.values()):
        assert got[i] == (host, path, rule, verdicts.get(rule, "allow")), i


def test_reputation_shrinks_with_little_evidence(spark):
    hosts = ["http://bad.evil.org/"] * 60 + ["http://new.evil.org/"] + ["http://good.fine.org/"] * 60 + ["http://one.else.org/"]
    outcomes = [(i, 1) for i in range(57)] + [(i, 0) for i in range(57, 60)] + [(i, 0) for i in range(61, 121)] + [(121, 1), (121, None)]
    got = {r.host: r for r in judged(spark, hosts, outcomes + outcomes).collect()}
    assert got["bad.evil.org"].verdict == "block" and got["good.fine.org"].verdict == "allow"
    # One bad page out of one is worth less than 57 out of 60, though its rate is higher.
    assert got["one.else.org"].bound < got["bad.evil.org"].bound and got["new.evil.org"].bound < got["bad.evil.org"].bound
    assert got["good.fine.org"].mean < got["new.evil.org"].mean < got["bad.evil.org"].mean


def plain_means(counts):
    """The means by the model's own words, level by level; ``counts`` has (n, bad) by host."""
    def domain(h):
        labels = h.split(".")
        size = 2 if ".".join(labels[-2:]) in ("co.uk", "com.au") else 1
        return ".".join(labels[-size:]), ".".join(labels[-size - 1 :])

    def posterior(rows):  # name -> (n, bad, prior, over, centre)
        held = [(n, b, c) for n, b, _, _, c in rows.values() if n > 0]
        below = sum(p * (1 - p) * (n - 1) for n, b, p in held)
        ratio = (sum(n * (b / n - p) ** 2 for n, b, p in held) - sum(p * (1 - p) for n, b, p in held)) / below if below > 0 else 0.001
        rho = min(0.999, max(0.001, ratio))
        return {k: (n, b, p, max(0.01, 1 / (rho + 1 / (over + 1)) - 1)) for k, (n, b, p, over, _) in rows.items()}

    def summed(key):
        out = {}
        for h, (n, b) in counts.items():
            x = out.setdefault(key(h), [0, 0])
            x[0] += n
            x[1] += b
        return out

    def under(children, parents, up):
        rows = {}
        for k, (n, b) in children.items():
            pn, pb, pp, ps = parents[up(k)]
            rows[k] = (n, b, (pb - b + ps * pp) / (pn - n + ps), pn - n + ps, (pb + ps * pp) / (pn + ps))
        return posterior(rows)

    total, bad = (sum(x[i] for x in counts.values()) for i in (0, 1))
    tops = posterior({k: (n, b, (bad - b + 0.5) / (total - n + 1), total - n + 1, (bad + 0.5) / (total + 1)) for k, (n, b) in summed(lambda h: domain(h)[0]).items()})
    domains = under(summed(lambda h: domain(h)[1]), tops, lambda d: domain(d)[0])
    hosts = under(counts, domains, lambda h: domain(h)[1])
    return {h: (b + s * p) / (n + s) for h, (n, b, p, s) in hosts.items()}


def test_reputations_equal_a_plain_version(spark):
    import random

    rng = random.Random(2)
    names = ["a.x.co.uk", "b.x.co.uk", "c.y.co.uk", "z.co.uk", "co.uk", "p.q.com", "r.q.com", "s.com", "t.u.net", "", "lone.org", "k.com.au"]
    counts = {h: (n, rng.randrange(n + 1)) for h in names for n in [rng.choice([0, 1, 5, 40])]}
    pages, outcomes = [], []
    for h, (n, b) in counts.items():
        for i in range(n + 1):  # one more page without a label
            if i < n:
                outcomes.append((len(pages), int(i < b)))
            pages.append((len(pages), h))
    given = spark.createDataFrame(pages, "page long, host string")
    got = {r.host: r.mean for r in urls.reputations(given, spark.createDataFrame(outcomes, EMPTY)).collect()}
    want = plain_means(counts)
    assert got.keys() == want.keys() and all(abs(got[h] - want[h]) < 1e-9 for h in want)


def test_a_host_does_not_speak_twice(spark):
    """What a domain with one host takes from its suffix does not contain the host's own pages."""
    counts = {"a.only.net": (4, 4), "b.many.org": (30, 3), "c.many.org": (30, 6), "d.rest.org": (30, 3), "e.rest.org": (30, 6)}
    pages = [(i, h) for i, h in enumerate(h for h, (n, _) in counts.items() for _ in range(n))]
    start, outcomes = 0, []
    for n, b in counts.values():
        outcomes += [(start + i, int(i < b)) for i in range(n)]
        start += n
    given = spark.createDataFrame(pages, "page long, host string")
    got = {r.host: r.mean for r in urls.reputations(given, spark.createDataFrame(outcomes, EMPTY)).collect()}
    others = (18 + 0.5) / (120 + 1)  # the rate of all other pages, from which everything above the host derives
    strength = (4 - 4 * got["a.only.net"]) / (got["a.only.net"] - others)
    assert strength > 0 and abs(got["a.only.net"] - plain_means(counts)["a.only.net"]) < 1e-9
    assert abs((4 + strength * others) / (4 + strength) - got["a.only.net"]) < 1e-9


def test_rows_are_kept_as_they_are(spark):
    pages = spark.createDataFrame([(1, "x://a.b/"), (1, "x://a.b/"), (None, None)], "page_id long, url string")
    found = urls.judge(pages, spark.createDataFrame([(1, 1), (None, 1)], EMPTY))
    assert found.count() == 3 and found.where("verdict is null").count() == 0
    assert urls.judge(pages.limit(0), spark.createDataFrame([], EMPTY)).collect() == []


def test_query_equals_sql_and_blocks_what_the_limit_says(spark, small, monkeypatch):
    db = duckdb.connect()
    for t in ("pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    pages, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("pages", "labels"))
    middle = urls.judge(pages, labels.select(F.col("doc_id").alias("page"), F.col("toxic").alias("bad"))).agg(F.median("bound")).first()[0]
    for limit in (urls.LIMIT, middle):
        monkeypatch.setattr(urls.judge, "__defaults__", (urls.RULES, limit, "page_id", "url"))
        monkeypatch.setattr(urls, "LIMIT", limit)
        df = queries.op7_urls(spark, small)
        cursor = db.execute(queries._url_sql())
        columns = [c[0] for c in cursor.description]
        assert compared(df.columns, [tuple(r) for r in df.collect()]) == compared(columns, cursor.fetchall())
    assert df.where((F.col("verdict") == "block") & F.col("rule").isNull()).count()
