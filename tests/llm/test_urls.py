from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
from edge import SF_CHECK

from vigil.llm import urls
from vigil.llm.common import read_table

CASES = [
    None, "", "no scheme/org/", "http://", "http://ORG/", "http://a.ORG/x", "http://notorg/", "http://aorg/",
    "http://example.org/es/1", "https://Blog.Example.Org/es/", "http://example.org/ES/", "http://example.org/en/1x",
    "http://example.org?x=/es/", "http://example.org#f/es/", "http://example.org", "x://y://example.org/es/",
    "http://shop.com/fr/?q#h", "http://shop.com/de/", "http://shop.com/en/", "http://wwwexample.org/es/a",
    "ftp://user@example.org:80/es/", "http://é.com/de/ü", "http://a\nb.com/de/\nx", "http://x.net/" + "p" * 50_000,
    "://com/de/", "http://É.ORG/",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    path = rest[cut:]
    end = min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    return host, path[:end]


def rule_of(host, path):
    fit = [(h + p, kind) for kind, h, p in urls.RULES
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit, key=lambda x: len(x[0])) if fit else (None, None)


def frame(spark, rows):
    return spark.createDataFrame([(i, u, "s", "h", None) for i, u in rows],
                                 "page_id long, url string, score string, host string, rule string").repartition(3)


def test_parts_rules_and_scores_match_brute_force(spark):
    rows = list(enumerate(CASES)) + [(3, CASES[8]), (None, CASES[9])]
    learnt = [(u, i % 3 == 0) for i, u in enumerate(CASES) if u]
    labelled = spark.createDataFrame(learnt, "url string, blocked boolean")
    got = urls.judge_urls(frame(spark, rows), labelled).collect()
    cut = [parts(u) for u, _ in learnt]
    weights, bias = urls.train([h for h, _ in cut], [p for _, p in cut], np.array([b for _, b in learnt], float))
    want = Counter()
    for i, u in rows:
        host, path = parts(u)
        data = [(side, b"\x02" + t.encode() + b"\x03") for side, t in enumerate((host, path))]
        feats = []
        for side, raw in data:
            for n in urls.GRAM_SIZES:
                for k in range(len(raw) - n + 1):
                    g = 0
                    for c in raw[k:k + n]:
                        g = (g * urls.BASE + c + 1 + 256 * side) % (1 << 64)
                    feats.append(int(urls.mix(np.array([g + n - 1 & (1 << 64) - 1], np.uint64))[0]) % urls.FEATURES)
        z = bias + sum(weights[f] for f in feats) / math.sqrt(max(1, len(feats)))
        p = 1 / (1 + math.exp(-max(-40, min(40, z))))
        rule, kind = rule_of(host, path)
        want[(i, host, path, rule, kind or ("block" if p >= 0.5 else "allow"), round(p, 6))] += 1
    assert Counter((r.page_id, r.host, r.path, r.rule, r.verdict, round(r.score, 6)) for r in got) == want
    assert urls.judge_urls(frame(spark, []), labelled).count() == 0


def test_model_learns_from_labels(spark):
    rng = random.Random(1)

    def url(bad):
        word = rng.choice(["pills", "casino", "win-now"] if bad else ["garden", "museum", "school"])
        return f"http://{word}{rng.randrange(999)}.net/{rng.choice(['en', 'fr'])}/{rng.randrange(99999)}"

    table = [(url(i % 2), bool(i % 2)) for i in range(400)]
    fresh = [(i, url(i % 2)) for i in range(200)]
    got = urls.judge_urls(frame(spark, fresh), spark.createDataFrame(table, "url string, blocked boolean")).collect()
    assert sum((r.verdict == "block") == bool(r.page_id % 2) for r in got) >= 196


def test_without_labels_everything_is_allowed(spark):
    empty = spark.createDataFrame([], "url string, blocked boolean")
    got = urls.judge_urls(frame(spark, [(1, "http://a.net/x")]), empty).collect()
    assert [r.verdict for r in got] == ["allow"]


def test_query_judges_every_page(spark):
    got = urls.op8_urls(spark, SF_CHECK).collect()
    pages = {r.page_id: r.url for r in read_table(spark, SF_CHECK, "pages").select("page_id", "url").collect()}
    assert sorted(r.page_id for r in got) == sorted(pages)
    for r in got:
        rule, kind = rule_of(*parts(pages[r.page_id]))
        assert (r.host, r.path) == parts(pages[r.page_id]) and r.rule == rule
        assert r.verdict == (kind or ("block" if r.score >= 0.5 else "allow"))
    ruled = [r for r in got if r.rule]
    assert sum((r.score >= 0.5) == (r.verdict == "block") for r in ruled) >= 0.95 * len(ruled)


def test_repeated_urls_do_not_crowd_out_a_verdict(spark):
    """Whichever url hashes low, its copies count once and both verdicts are learnt from."""
    allow = [f"https://a.org/{i}" for i in range(6)]
    block = [f"https://b.com/de/{i}" for i in range(6)]
    for hot in (allow, block):
        pages = spark.createDataFrame([(u,) for u in [*allow, *block, *hot * 50]], "url string")
        got = [tuple(x) for x in urls.rule_labels(pages, bound=4).collect()]
        assert len(set(got)) == len(got) == 8
        assert sum(b for _, b in got) == 4
        assert all(u in (block if b else allow) for u, b in got)
