"""URL rules and the character models against plain Python."""

import math
import re
from collections import Counter, defaultdict

import pytest

from wardbook.llm import url_filter
from wardbook.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1], re.S).groups()
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = []
    for r in URL_RULES:
        h, p = r.site.split("/", 1)
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(r.site), r.site, r.verdict))
    return max(fits)[1:] if fits else (None, None)


def grams(url, k=url_filter.CONTEXT):
    host, _ = parts(url)
    text = host + re.sub("^[^/?#]*", "", url.split("://", 1)[1]) if host else (url or "")
    text = "\2" * k + text + "\3"
    return [text[i : i + k + 1] for i in range(len(text) - k)]


class Model:
    def __init__(self, urls, characters):
        self.characters, self.next = characters, defaultdict(Counter)
        for u in urls:
            for g in grams(u):
                for k in range(len(g)):
                    self.next[g[len(g) - 1 - k : -1]][g[-1]] += 1

    def p(self, g):
        p = 1 / self.characters
        for k in range(len(g)):
            seen = self.next.get(g[len(g) - 1 - k : -1])
            if seen and (k == 0 or sum(seen.values()) >= url_filter.SEEN):
                p = (seen[g[-1]] + len(seen) * p) / (sum(seen.values()) + len(seen))
        return p


def expected(rows):
    decided = [(u, rule(*parts(u))[1]) for _, u in rows]
    characters = len({g[-1] for _, u in rows for g in grams(u)})
    a, b = (Model([u for u, v in decided if v == x], characters) for x in ("allow", "block"))
    score = {u: sum(math.log(a.p(g)) - math.log(b.p(g)) for g in grams(u)) / len(grams(u)) for _, u in rows}
    groups = [[score[u] for u, v in decided if v == x] for x in ("allow", "block")]
    t = None
    if all(groups):
        m = [sum(g) / len(g) for g in groups]
        s = [math.sqrt(sum((x - y) ** 2 for x in g) / len(g)) + 1e-9 for g, y in zip(groups, m)]
        t = (m[0] * s[1] + m[1] * s[0]) / sum(s)
    for i, u in rows:
        h, p = parts(u)
        r, v = rule(h, p)
        yield i, h, p, r, v or ("block" if t is not None and score[u] < t else "allow"), score[u]


URLS = [
    "http://a.net", "http://a.net/", "HTTP://A.NET/x?q#f", "http://example.net/en/1", "https://www.Example.net/en/", "http://notexample.net/en/1",
    "http://example.net/enx", "http://example.com/de/3", "http://b.example.com/de/", "http://example.com/fr/3", "http://x.org/fr/1", "http://org/fr/", "http://x.org/fr",
    "http://x.org/en/cheap-pills", "ftp://h#frag", "no scheme", "", None, "://", "a://b://c/d", "http://ünï.org/fr/é", "http://x.com/a\nb?c", "http://" + "a" * 5000 + ".com/",
    "http://x.org/en/1?id=%C3%A9&b=2", "http://x.org/en/1?id=%C3%A8&b=2", "http://x.com/\U0001f600\U0001f601/\U0001f600", "http://x.com/a^b$c~d", "http://例え.org/パス",
]


@pytest.fixture(scope="module")
def rows():
    more = [f"https://{h}.example.{t}/{p}/{n}" for n in range(12) for h in ("spam-farm", "good", "ththth") for t in ("net", "com", "org") for p in ("en", "de", "fr")]
    return [(i, u) for i, u in enumerate(URLS + more)] + [(3, URLS[3]), (3, URLS[3]), (None, URLS[7]), (9, "http://other.com/")]


def test_judged(spark, rows):
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in rows], "page_id long, url string, rule string, t int").repartition(3)
    got = sorted((tuple(r) for r in url_filter.judged(pages, URL_RULES).collect()), key=str)
    want = sorted(expected(rows), key=str)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(x[5] == pytest.approx(y[5], abs=1e-9) for x, y in zip(got, want))
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}


def test_other_characters_and_queries_count(spark):
    """URLs that differ only in digits, escapes or the query string have scores of their own."""
    ends = ["?a=1", "?a=2", "%41", "%42", "é", "è"]
    rows = [(10 * i + j, f"http://{h}/p{e}") for i, e in enumerate(ends) for j, h in enumerate(("x.net", "x.org/fr", "x.com"))]
    rows += [(1000 + i, f"http://x.{'net' if i % 2 else 'org/fr'}/p{ends[i % 2 + 2 * (i % 3)]}") for i in range(60)]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    assert len({r.score for r in got if r.page_id < 1000 and r.page_id % 10 == 2}) == len(ends)


def test_a_very_long_url(spark):
    rows = [(1, "http://a.net/"), (2, "http://a.org/fr/"), (3, "http://b.com/" + "é\U0001f600x" * 300_000)]
    got = url_filter.judged(spark.createDataFrame(rows, "page_id long, url string"), URL_RULES).collect()
    assert len(got) == 3 and all(r.score is not None for r in got)


def test_without_groups(spark):
    schema = "page_id long, url string"
    assert url_filter.judged(spark.createDataFrame([], schema), URL_RULES).count() == 0
    got = url_filter.judged(spark.createDataFrame([(1, "http://q.com/"), (2, None)], schema), URL_RULES).collect()
    assert {r.verdict for r in got} == {"allow"} and {r.rule for r in got} == {None}
    assert {r.verdict for r in url_filter.judged(spark.createDataFrame([(1, "http://q.com/")], schema), []).collect()} == {"allow"}
