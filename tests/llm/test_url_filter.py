import itertools
import math
import re

import xxhash

from burnup.llm import url_filter as U

URLS = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/12?x=/es/", "http://example.org/en/2", "http://notexample.org/es/1", "http://org", "http://org/", "http://x.com/fr/a#b",
        "http://com/de/", "ftp://theringdom.com/de/the-ring", "http://thering.net/de/ring", "http://ringthe.net/fr/The", "http://the.net?q=://y/de/", "no scheme", None, "", "://", "x://h",
        "http://x.com/FR/a", "http://the.example.org:80/en/1", "http://u@the.com/de/x", "http://ring.biz/zz/%20-é", "a://b://c/d", "http://x.com/fr", "http://the.net/\nx"]
TEXT = "<html><script>ring ring</script><p>The ring the kingdom</p> <b>the ring</b> Dom <!-- no -->zz</html>"


def brute(urls, htmls):
    def parse(u):
        if u is None or "://" not in u:
            return "", ""
        rest = u.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest).group()
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):]).group()

    words = {}
    for h in htmls:
        for w in re.findall(r"[^\W\d_]+", re.sub(r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->|<[^>]*>", " ", h or "").lower()):
            words[w] = words.get(w, 0) + 1
    total = sum(words.values())

    def split(name):
        def p(w):
            return math.log(words[w] / total) if w in words else -math.log(total) - (len(w) - 1) * math.log(10)

        return max(([name[a:b] for a, b in itertools.pairwise([0, *cut, len(name)])] for k in range(len(name)) for cut in itertools.combinations(range(1, len(name)), k)), key=lambda s: round(sum(map(p, s)), 9))

    seen, rows = {"allow": [], "block": []}, []
    for u in urls:
        host, path = parse(u)
        fits = [(len(h + p), h + p, v) for v, h, p in U.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1:] if fits else (None, None)
        tokens = ["h:" + w for n in re.findall(r"[^\W\d_]+", host) for w in split(n)] + ["p:" + w for w in re.findall(r"[^\W\d_]+", path.lower())]
        tokens = [xxhash.xxh64_intdigest(t.encode(), 42) % U.BUCKETS for t in tokens]
        rows.append((host, path, *rule, tokens))
        if rule[1]:
            seen[rule[1]].append(tokens)
    flat = {v: [t for x in seen[v] for t in x] for v in seen}
    used = len(set(flat["allow"]) | set(flat["block"])) or 1
    lp = lambda v, t: math.log((flat[v].count(t) + 1) / (len(flat[v]) + used))
    out = []
    for host, path, rule, verdict, tokens in rows:
        odds = math.log((len(seen["block"]) + 1) / (len(seen["allow"]) + 1)) + sum(lp("block", t) - lp("allow", t) for t in tokens)
        out.append((host, path, rule, verdict or ("block" if odds > 0 else "allow")))
    return out


def test_against_brute_force(spark):
    urls = URLS + ["http://thekingdom.com/de/ring"] * 5
    html = [TEXT if i % 3 else None for i in range(len(urls))]
    df = spark.createDataFrame([(i, u, h, "x") for i, (u, h) in enumerate(zip(urls, html))], "page_id long, url string, html string, verdict string").repartition(4)
    got = {x.page_id: (x.host, x.path, x.rule, x.verdict) for x in U.judge(df).collect()}
    want = brute(urls, html)
    assert [got[i] for i in range(len(urls))] == want


def test_segmentation():
    known = {"the": 50, "ring": 20, "king": 5, "dom": 1, "kingdom": 3}
    assert U.viterbi("theringkingdom", known, 1000.0) == ["the", "ring", "kingdom"]
    assert "".join(U.viterbi("zzqthe" * 9, known, 1000.0)) == "zzqthe" * 9
    assert U.viterbi("", known, 1.0) == []


def test_words_of_any_length(spark):
    """A page word of 26 letters is found in a host; one that only begins like it is not."""
    long = "abcdefghijklmnopqrstuvwxyz"
    names = spark.createDataFrame([(f"the{long}ring",), (f"the{long[:24]}ring",), ("the",), (long * 2,)], "name string")
    counts = spark.createDataFrame([(long, 40), ("the", 50), ("ring", 20)], "word string, n long")
    got = {x.name: x.words for x in U.segmented(names, counts, 110.0).collect()}
    assert got[f"the{long}ring"] == ["the", long, "ring"] and got[long * 2] == [long, long] and got["the"] == ["the"]
    assert "".join(got[f"the{long[:24]}ring"]) == f"the{long[:24]}ring" and long not in got[f"the{long[:24]}ring"]
    known = {long: 40, "the": 50, "ring": 20}
    assert all(got[n] == U.viterbi(n, known, 110.0) for n in got)


def test_very_long_host_path_and_html(spark):
    """A host of 100,000 letters is a task of seconds, not one of quadratic rows."""
    host, path = "thering" * 14_286, "/de/ring" * 20_000
    df = spark.createDataFrame([(1, f"http://{host}.net{path}", f"<p>{'the ring ' * 50_000}</p>"), (2, "http://com/de/ring", TEXT), (3, "http://com/fr/x", "y" * 300_000)], "page_id long, url string, html string")
    got = {x.page_id: (x.host, x.path, x.verdict) for x in U.judge(df).collect()}
    assert got[1] == (host + ".net", path, "block") and got[2][2] == "block" and got[3][2] == "allow"


def test_rules_of_equal_length(spark):
    df = spark.createDataFrame([(1, "http://a.b/cd", None), (2, "http://x.a.b/cd", None)], "page_id long, url string, html string")
    one, two = ("allow", "a.b", "/c"), ("block", "a.b", "/c")
    assert {x.verdict for x in U.judge(df, (one, two)).collect()} == {"block"}
    assert {x.verdict for x in U.judge(df, (two, one)).collect()} == {"allow"}


def test_nulls_and_empty(spark):
    schema = "page_id long, url string, html string"
    df = spark.createDataFrame([(None, None, None), (1, "http://a.net/x", None), (1, "http://a.net/x", None)], schema)
    assert sorted((x.page_id or 0, x.host, x.verdict) for x in U.judge(df).collect()) == [(0, "", "allow"), (1, "a.net", "allow"), (1, "a.net", "allow")]
    assert U.judge(df.limit(0)).count() == 0
