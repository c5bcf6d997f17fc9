import random
import re

from genesieve.llm.url_templates import RULES, TreeSettings, UrlRule, filter_urls

PAGES = "page_id long, url string, html string"


def brute(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, rule.text if rule else None, rule.verdict if rule else None


def test_rules_equal_brute_force(spark):
    rng = random.Random(1)
    parts = ["http://", "HTTPS://", "a.", "example", ".com", ".net", ".org", "/en/", "/de/8", "/es/", "7", "?q=/en/", "#x", "://", "É", "/", "WWW."]
    urls = ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(800)] + [None, "", "http://example.com/en/7", "http://com/en/", "x://net/de/", "https://A.EXAMPLE.NET/de/8?x"]
    rows = {r["page_id"]: r for r in filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)).collect()}
    assert len(rows) == len(urls)
    for i, u in enumerate(urls):
        host, path, rule, verdict = brute(u)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == verdict if verdict else rows[i]["verdict"] in ("allow", "block")


def test_templates_are_rejected_by_labelled_purity(spark):
    urls = [f"http://shop.example/{d}/item-{i}/view" for d in ("buy", "sale") for i in range(200)] + [f"http://shop.example/about/team{i}" for i in range(40)] + [f"http://news.example/{i}/story" for i in range(100)]
    pages = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)
    labels = spark.createDataFrame([(i, int("/item-" in u)) for i, u in enumerate(urls) if i % 2], "page_id long, bad int")
    out = filter_urls(pages, rules=(), labels=labels, settings=TreeSettings(reject_at=0.85)).collect()
    assert all((r["verdict"] == "block") == ("/item-" in r["path"]) for r in out)
    assert len({r["template"] for r in out if "/item-" in r["path"]}) == 1


def test_many_values_become_a_wildcard(spark):
    urls = [f"http://h.example/tag/{chr(97 + i % 26)}{chr(97 + i // 26)}/page" for i in range(60)]
    out = filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES), rules=(UrlRule("block", "example", "/tag/aa"),)).collect()
    assert len({r["template"] for r in out}) == 1


def words(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n)]


def test_a_variable_place_below_a_variable_place(spark):
    urls = [f"http://h.example/user/{a}/{b}/profile" for a, b in zip(words(90, 1), words(90, 2), strict=True)]
    out = filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)).collect()
    assert {r["template"] for r in out} == {"/user/{*}/{*}/profile"}


def test_deep_paths_that_differ_late(spark):
    deep = "/".join(f"p{chr(97 + i % 26)}" for i in range(50))
    urls = [f"http://h.example/{deep}/{'good' if i % 2 else 'evil'}/{i}" for i in range(100)]
    labels = [(i, 1 - i % 2) for i in range(0, 100, 3)]
    frames = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES), spark.createDataFrame(labels, "page_id long, bad int")
    out = filter_urls(frames[0], rules=(), labels=frames[1], settings=TreeSettings(reject_at=0.8)).collect()
    assert all((r["verdict"] == "block") == ("/evil/" in r["path"]) for r in out) and len({r["template"] for r in out}) == 2


def test_similar_branches_share_evidence_and_others_do_not(spark):
    urls = [f"http://h.example/{lang}/{kind}/{i}" for lang in ("en", "de", "fr") for kind in ("view", "edit") for i in range(60)]
    urls += [f"http://h.example/shop/{i}/buy/now" for i in range(150)] + [f"http://h.example/{page}" for page in ("about", "team") for _ in range(60)]
    labels = [(i, 1) for i, u in enumerate(urls) if "/en/" in u]
    frames = spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES), spark.createDataFrame(labels + [(10**6, 0)], "page_id long, bad int")
    out = filter_urls(frames[0], rules=(), labels=frames[1]).collect()
    assert {r["path"].split("/")[1] for r in out if r["verdict"] == "block"} == {"en", "de", "fr"}
    assert {r["template"] for r in out if r["path"] in ("/about", "/team")} == {"/about", "/team"}


def test_templates_do_not_depend_on_the_size_of_the_table(spark):
    rng = random.Random(3)
    urls = [f"http://h{rng.randrange(3)}.example/{rng.choice(['en', 'de', 'x'])}/{rng.choice(words(30, 4))}/{rng.choice(['a', 'b'])}" for _ in range(1500)]
    once = {r["path"]: r["template"] for r in filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES)).collect()}
    twice = {r["path"]: r["template"] for r in filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls * 2)], PAGES)).collect()}
    assert once == twice and any("{*}" in t for t in once.values())


def test_small_hosts_are_treated_like_large_ones(spark):
    """Listing urls again changes nothing; a host of twelve urls merges its branches as one of hundreds does."""
    small = [f"http://s{h}.example/{lang}/{kind}/{i}" for h in range(3) for lang in ("en", "de", "fr") for kind in ("view", "edit") for i in range(2)]
    large = [f"http://l.example/{lang}/{kind}/{i}" for lang in ("en", "de", "fr") for kind in ("view", "edit") for i in range(80)]
    urls = small + large
    judge = lambda rows: {(r["host"], r["path"]): (r["template"], r["verdict"], r["purity"]) for r in filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(rows)], PAGES)).collect()}
    once = judge(urls)
    assert once == judge(urls * 2 + small * 7)
    of = lambda host: {t for (h, _), (t, _, _) in once.items() if h == host}
    assert of("s0.example") == of("s1.example") == of("l.example") and len(of("l.example")) < 6


def test_nesting_without_end_takes_a_bounded_number_of_rounds(spark):
    deep = ["".join(chr(97 + int(c)) for c in str(i)) for i in range(300)]
    urls = ["http://trap.example/" + "/".join(deep[: i + 1]) for i in range(300)] + [f"http://h.example/{x}/{i}" for x in ("a", "b") for i in range(30)]
    out = filter_urls(spark.createDataFrame([(i, u, None) for i, u in enumerate(urls)], PAGES), settings=TreeSettings(rounds=3)).collect()
    assert sorted(r["page_id"] for r in out) == list(range(len(urls))) and all(r["template"] is not None for r in out)
    assert {r["template"] for r in out if r["host"] == "h.example"} == {"/{a~}/{n}"}


def test_purity_predicts_labels_that_were_held_back(spark):
    rng = random.Random(5)
    share = {"buy": 0.95, "read": 0.1, "mix": 0.5}
    rows = [(i, f"http://h{i // 2 % 4}.example/{rng.choice(list(share))}/{i}/{rng.choice(['a', 'b'])}", None) for i in range(2000)]
    bad = {i: int(rng.random() < share[u.split("/")[3]]) for i, u, _ in rows}
    labels = spark.createDataFrame([(i, b) for i, b in bad.items() if i % 2], "page_id long, bad int")
    out = filter_urls(spark.createDataFrame(rows, PAGES), rules=(), labels=labels).where("page_id % 2 = 0").collect()
    base = sum(bad[i] for i in bad if i % 2) / 1000
    error = lambda guess: sum((guess(r) - bad[r["page_id"]]) ** 2 for r in out) / len(out)
    assert error(lambda r: r["purity"]) < 0.75 * error(lambda r: base)


def test_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "http://a.b/c", None), (2, "http://a.b" + "/x" * 5000, "h"), (3, "no scheme", None)]
    df = spark.createDataFrame(rows, PAGES).selectExpr("*", "'x' as host", "'y' as path", "'z' as n", "'t' as template", "1 as _bad")
    out = filter_urls(df).collect()
    assert len(out) == 5 and sorted((r["host"], len(r["path"])) for r in out) == [("", 0), ("", 0), ("", 0), ("a.b", 2), ("a.b", 10_000)]
    assert filter_urls(spark.createDataFrame([], PAGES)).count() == 0
