"""URL rules and templates against a plain version, and on odd rows."""

import math
import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from strata.llm import queries, urls

PAGES = "page_id long, url string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    for c in "?#":
        path = path.split(c, 1)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), path


def plain_rule(host, path, rules):
    fit = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
    return max(fit, key=lambda r: len(r[1] + r[2]), default=None)


def plain_judge(pages, rules):
    rows = [(i, *plain_parts(u)) for i, u in pages]
    state = {}  # (host, path) -> [segments, template, n, good, bad]
    for _, host, path in rows:
        rule = plain_rule(host, path, rules)
        clean = path
        for c in "*{|}":
            clean = clean.replace(c, f"%{ord(c):02X}")
        x = state.setdefault((host, path), [[s for s in clean.split("/") if s], "", 0, 0, 0])
        x[2] += 1
        x[3] += rule is not None and rule[0] == "allow"
        x[4] += rule is not None and rule[0] == "block"
    near = lambda p, m, q, n: abs(p / m - q / n) <= math.sqrt(0.5 * math.log(2 / urls.ALPHA)) * (1 / math.sqrt(m) + 1 / math.sqrt(n))
    for level in range(urls.DEPTH):
        children = defaultdict(lambda: [0, 0, 0, 0])
        for (host, _), (segments, template, n, good, bad) in state.items():
            if len(segments) > level:
                c = children[host, template, segments[level]]
                for k, v in enumerate((n, good, bad, n * (len(segments) == level + 1))):
                    c[k] += v
        totals, names = Counter(), {}
        for (host, template, _), c in children.items():
            totals[host, template] += c[0]
        by_parent = defaultdict(list)
        for (host, template, segment), (n, good, bad, ends) in children.items():
            if n >= urls.LEAST and n >= urls.SHARE * totals[host, template]:
                by_parent[host, template].append((bad / (good + bad) if good + bad else -1.0, ends / n, segment, n, good, bad, ends))
        for parent, found in by_parent.items():
            groups = []
            for _, _, segment, n, good, bad, ends in sorted(found):
                if groups:
                    last = groups[-1]
                    both, none = last[2] + last[3] and good + bad, not last[2] + last[3] and not good + bad
                    if (none or (both and near(last[3], last[2] + last[3], bad, good + bad))) and near(last[4], last[1], ends, n):
                        groups[-1] = [[*last[0], segment], last[1] + n, last[2] + good, last[3] + bad, last[4] + ends]
                        continue
                groups.append([[segment], n, good, bad, ends])
            for segments, *_ in groups:
                for s in segments:
                    names[(*parent, s)] = s if len(segments) == 1 else "{" + "|".join(sorted(segments)) + "}"
        for (host, _), x in state.items():
            if len(x[0]) > level:
                x[1] += "/" + names.get((host, x[1], x[0][level]), "*")
    sums = defaultdict(lambda: [0, 0])
    for (host, _), x in state.items():
        x[1] += "/**" if len(x[0]) > urls.DEPTH else ""
        sums[host, x[1]][0] += x[3]
        sums[host, x[1]][1] += x[4]
    good, bad = sum(x[0] for x in sums.values()), sum(x[1] for x in sums.values())
    overall = bad / (good + bad) if good + bad else 0.0
    out = []
    for i, host, path in rows:
        rule, template = plain_rule(host, path, rules), state[host, path][1]
        g, b = sums[host, template]
        own = "block" if (b + urls.STRENGTH * overall) / (g + b + urls.STRENGTH) >= urls.LEAST_PURITY else "allow"
        out.append((i, host, path, rule and rule[1] + rule[2], rule[0] if rule else own, template))
    return sorted(out, key=repr)


def judged(df, rules):
    return sorted(((r.page_id, r.host, r.path, r.rule, r.verdict, r.template) for r in urls.judge(df, rules).collect()), key=repr)


def test_given_pages(spark):
    pages = queries.read(spark, "/root/testdata/sf0.1", "pages")
    assert judged(pages, queries.URL_RULES) == plain_judge([(r.page_id, r.url) for r in pages.collect()], queries.URL_RULES)


def test_templates(spark):
    """Ids become wildcards, like branches merge, a bad template is rejected beyond its rules, a clean one stays."""
    rng = random.Random(2)
    rules = [("block", "a.org", "/shop/b"), ("block", "a.org", "/store/b"), ("allow", "a.org", "/news/n"), ("allow", "a.org", "/shop/bx")]
    links = [f"http://a.org/{rng.choice(['shop', 'store'])}/{rng.choice('bbbbbbbbbz')}{i}" for i in range(600)]
    links += [f"http://a.org/news/{rng.choice('nz')}{i}/x" for i in range(300)] + [f"http://b.org/{i}/{i}" for i in range(50)]
    links += ["http://a.org/rare/path", "http://a.org/1/2/3/4/5/6/7/8", "http://a.org/s*p/{x}"]
    df = spark.createDataFrame(list(enumerate(links)), PAGES)
    got = judged(df, rules)
    assert got == plain_judge(list(enumerate(links)), rules)
    own = {(t, v) for _, _, _, rule, v, t in got if rule is None}
    assert ("/{shop|store}/*", "block") in own and ("/news/*/x", "allow") in own and ("/*/*", "allow") in own
    assert any(t == "/*/*/*/*/*/*/**" for *_, t in got)


def test_odd_rows(spark):
    links = [None, "", "no link", "HTTP://EXAMPLE.com", "x://É.Com/é?a#b", "a://b://c/d", "http://h?x=/en/", "http://net/es/1", "http://x.net/es/", "http://xnet/es/"]
    links += ["http://long.com/" + "a/" * 20_000, "http://example.com/en/1", "http://example.com/en/1", "http://www.example.com/en/1", "http://w.www.example.com/en/"]
    df = spark.createDataFrame([(i if i % 3 else None, u) for i, u in enumerate(links)], PAGES)
    df = df.withColumns({c: F.lit("clash") for c in ("host", "path", "n", "template", "found")})
    got = judged(df, queries.URL_RULES)
    assert got == plain_judge([(r.page_id, r.url) for r in df.collect()], queries.URL_RULES)
    rules = {(h, p): (r, v) for _, h, p, r, v, _ in got}
    assert rules["", ""] == (None, "allow") and rules["b:", "//c/d"] == (None, "allow")
    assert rules["x.net", "/es/"] == ("net/es/", "block") and rules["xnet", "/es/"] == (None, "allow")
    assert rules["www.example.com", "/en/1"] == ("www.example.com/en/", "allow")
    assert rules["example.com", ""] == (None, "allow")
    assert urls.judge(df.limit(0), queries.URL_RULES).count() == 0
    assert urls.judge(df, []).filter("verdict = 'block'").count() == 0
