import re

from samples import staging  # noqa: F401

from tripledger.llm import bloom, urlfilter
from tripledger.llm.queries import RULES

URLS = ["http://a.b/", "HTTP://A.B:80#x", "https://a.b:443?x=1&utm_source=q&a=2", "https://a.b/?a=2&x=1", "no scheme", None, "",
        "://", "x://Y", "http://net/", "http://net", "http://x.net/de/", "http://example.net/en/x", "http://m.EXAMPLE.net/en/",
        "http://badexample.net/en/", "http://example.com/de/1", "http://a.org/fr/", "http://a.org/fr", "http://xorg/fr/",
        "http://h/a://b/c", "http://h\n/p\nq?r", "http://a.b/"]


def expected(url, listed):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host = re.sub("[A-Z]", lambda x: x[0].lower(), m[1]) if m else ""
    path = m[2] if m else ""
    fits = [(len(h + p), v, h + p) for h, p, v in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, verdict, rule = max(fits)
        return host, path, rule, verdict
    return host, path, None, "block" if listed else "allow"


def test_every_url_is_judged(spark, staging):
    pages = spark.createDataFrame([(k, u, "x") for k, u in enumerate(URLS)], "page_id long, url string, key string")
    lists = spark.createDataFrame([("http://a.b",), ("http://a.b",), (None,), ("https://a.b/?x=1&a=2#frag",), ("nothing",)], "url string")
    listed = {0, 1, 2, 3, 21}
    for blocks in (1, 64, None):  # one block is full of bits: the join decides
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, lists, RULES, staging, blocks).collect()}
        assert got == {k: expected(u, k in listed) for k, u in enumerate(URLS)}
    assert urlfilter.judge(pages.limit(0), lists, RULES, staging).count() == 0
    assert urlfilter.judge(pages, lists.limit(0), RULES, staging).where("verdict = 'block' AND rule IS NULL").count() == 0


def test_a_filter_holds_all_its_keys_and_few_others(spark):
    keys = spark.range(5000).selectExpr("concat('u', id) AS key")
    filters = bloom.bloom(keys, 256)
    assert filters.count() <= 256
    inside = bloom.maybe_listed(keys, filters, blocks=256)
    assert inside.where("NOT maybe").count() == 0
    others = bloom.maybe_listed(spark.range(5000).selectExpr("concat('v', id) AS key"), filters, blocks=256)
    assert others.where("maybe").count() < 250


def test_the_filter_grows_with_its_list_up_to_a_bound():
    sizes = [bloom.blocks_for(n) for n in (0, 1, 2048, 2049, 100_000, 10**7, 10**12)]
    assert sizes == [64, 64, 64, 128, 4096, bloom.MOST_BLOCKS, bloom.MOST_BLOCKS]


def test_list_beyond_the_bound_is_joined_by_merging(spark, staging, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_BLOCKS", 0)
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(URLS)], "page_id long, url string")
    lists = spark.createDataFrame([("http://a.b",)], "url string")
    found = urlfilter.judge(pages, lists, RULES, staging)
    assert "ShuffledHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    assert {r.page_id for r in found.where("rule IS NULL AND verdict = 'block'").collect()} == {0, 1, 21}
