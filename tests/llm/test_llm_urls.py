"""Rules by brute force, the models by their definition, and odd urls."""

import math

import pytest

from tallyroom.llm import urls
from tallyroom.llm.catalog import URL_RULES

URLS = [
    "http://a.net/en/x", "HTTPS://A.Example.NET/en/1?q=/fr/", "http://example.com/de/", "http://x.example.com/de",
    "https://foo.org/fr/1#t", "https://org/fr/", "https://borg/fr/", "http://net", "http://net/", "http://x.net?a/b",
    "no scheme", "", None, "://", "a://b://c/d", "http://notexample.net/en/", "x\n://h.org/fr/\u00e9", "http://example.net/EN/",
    "http://z.com/" + "y" * 5000,
]


def brute(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
        tail = rest[end:]
        path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = []
    for action, rule in URL_RULES:
        at, slash, under = rule.partition("/")
        if (host == at or host.endswith("." + at)) and path.startswith(slash + under):
            fits.append((len(rule), rule, action))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def pages(spark, found):
    return spark.createDataFrame(
        [(i, u, "h", "v", 1.0) for i, u in enumerate(found)],
        "page_id long, url string, host string, verdict string, score double",
    )


def test_rules(spark):
    rows = {r["page_id"]: r for r in urls.judge(pages(spark, URLS), URL_RULES).collect()}
    assert len(rows) == len(URLS)
    for i, url in enumerate(URLS):
        host, path, rule, verdict = brute(url)
        r = rows[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule), url
        assert r["verdict"] in ("allow", "block")
        if verdict:
            assert r["verdict"] == verdict and r["score"] is None
        else:
            assert r["score"] is not None


def test_the_models_carry_over_to_undecided_urls(spark):
    found = [f"http://s{i}.net/spam/{i}" for i in range(300)] + [f"http://s{i}.org/fr/{i}" for i in range(300)]
    found += ["http://q.com/spam/7", "http://q.com/fr/7"]
    rows = {r["url"]: r for r in urls.judge(pages(spark, found), URL_RULES).collect()}
    assert rows["http://q.com/spam/7"]["score"] < rows["http://q.com/fr/7"]["score"]
    assert rows["http://q.com/spam/7"]["verdict"] == "block"
    assert rows["http://q.com/fr/7"]["verdict"] == "allow"


def test_without_examples_all_are_allowed(spark):
    rows = urls.judge(pages(spark, ["http://q.com/a", None]), URL_RULES).collect()
    assert {r["verdict"] for r in rows} == {"allow"}


def test_models_are_distributions():
    model = urls.Model([(b"", 97, 5, 1), (b"", 98, 1, 5), (b"", 256, 2, 2), (b"a", 98, 3, 0), (b"a", 256, 0, 2)])
    for context in (b"", b"a", b"xa", b"b"):
        # With p the accepted and q the rejected model, sum of q * p / q is the sum of p.
        swapped = urls.Model([(c, n, r, a) for (c, n), (a, r) in model.pairs.items()])
        ratios = [model.log_ratio(context, n) for n in range(257)]
        assert all(math.isclose(x, -swapped.log_ratio(context, n), abs_tol=1e-9) for n, x in enumerate(ratios))


def test_too_many_rules(spark):
    with pytest.raises(ValueError):
        urls.judge(pages(spark, []), [("allow", f"h{i}/") for i in range(urls.MAX_RULES + 1)])


def test_all_counts_score_also_as_a_table(spark, monkeypatch):
    found = [f"http://s{i}.net/spam/{i}" for i in range(300)] + [f"http://s{i % 7}.org/fr/{i}" for i in range(3000)]
    found += [f"http://q{i % 9}.com/{'spam' if i % 2 else 'fr'}/{i}" for i in range(200)] + [*URLS, *URLS]
    frame = pages(spark, found).repartition(3)
    key = lambda r: r["page_id"]
    whole = sorted(urls.judge(frame, URL_RULES).collect(), key=key)
    monkeypatch.setattr(urls, "MAX_PAIRS", 64)
    table = sorted(urls.judge(frame, URL_RULES).collect(), key=key)
    assert [(r["page_id"], r["rule"], r["verdict"]) for r in table] == [(r["page_id"], r["rule"], r["verdict"]) for r in whole]
    for a, b in zip(table, whole):
        assert (a["score"] is None) == (b["score"] is None)
        assert a["score"] is None or math.isclose(a["score"], b["score"], abs_tol=1e-8)
