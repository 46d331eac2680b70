import random
import re

import pytest

from rinkframe.llm import urls

RULES = [urls.Rule("allow", "org", "/"), urls.Rule("block", "example.org", "/es/"),
         urls.Rule("block", "example.org", "/en/1"), urls.Rule("allow", "com", "/fr/"),
         urls.Rule("block", "com", "/de/"), *urls.PATTERNS]


def by_hand(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    best = None
    for r in RULES:
        if r.host and (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path):
            if best is None or (len(r.name), r.name) > (len(best.name), best.name):
                best = r
    if best:
        return host, path, best.name, best.verdict
    blocked = any(r.host is None and re.search(r.regex, host + path) for r in RULES)
    return host, path, None, "block" if blocked else "allow"


def test_verdicts_equal_brute_force(text_spark):
    rng = random.Random(6)
    hosts = ["example.org", "a.EXAMPLE.org", "myexample.org", "x.com", "com", "spam-farm.net", "my-spam-farm.net",
             "casino.io", "casinos.io", "", "org", ".org", "x.org:80", "cheap-pills.com"]
    paths = ["", "/", "/es/", "/ES/", "/en/1", "/en/12?x=/es/", "/fr/9#top", "/de/", "?/de/", "/a/wp-login.php", "/\n://b.com/de/"]
    rows = [f"{rng.choice(['http', 'HTTPS', ''])}://{rng.choice(hosts)}{rng.choice(paths)}" for _ in range(600)]
    rows += [None, "", "no scheme", "http:/", "://", rows[0], rows[0], "https://x.com/" + "a/" * 20000]
    df = text_spark.createDataFrame([(u, "x", "y") for u in rows], "url string, place string, hit string")
    out = urls.judge(df, RULES).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == by_hand(r["url"]), r["url"]


def test_rules_need_a_token_and_tables_can_be_empty(text_spark):
    assert urls.Rule("block", "example.org", "/en/1").tokens == ["example", "org", "en"]
    with pytest.raises(ValueError):
        urls.Rule("block", pattern="spam*").tokens
    empty = text_spark.createDataFrame([], "url string")
    assert urls.judge(empty, RULES).count() == 0
    one = text_spark.createDataFrame([("http://a.com/de/",)], "url string")
    assert urls.judge(one, []).first()["verdict"] == "allow"


def test_rows_without_a_place_stay_out_of_the_join(text_spark):
    rows = [None, "", "no scheme", "http://"] * 50 + ["https://a.com/de/", "https://b.net/"]
    out = urls.judge(text_spark.createDataFrame([(u,) for u in rows], "url string"), RULES)
    assert out.columns == ["url", "host", "path", "rule", "verdict"]
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(rows) and got.count((None, "", "", None, "allow")) == 50
    assert ("https://a.com/de/", "a.com", "/de/", "com/de/", "block") in got
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lstrip().startswith("Union") and plan.count("Join LeftOuter, (place") == 1
