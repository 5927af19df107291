"""Rules by plain Python; the trees by held-out agreement with the rules."""

import random
import re

import pytest

from weekloom.llm import urls

LINES = ["allow com/", "block example.com/en/", "allow www.example.com/en/", "block net/es/"]


def brute(url):
    _, found, rest = (url or "").partition("://")
    rest = rest if found else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = []
    for line in LINES:
        verdict, place = line.split()
        h, _, p = place.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            fits.append((len(place), place, verdict))
    best = max(fits, default=(0, None, None))
    return host, path, best[1], best[2]


def pages():
    rng = random.Random(2)
    hosts = ["example.com", "www.example.com", "a.EXAMPLE.com", "x.net", "net", "com", "b.xcom", "é.org"]
    paths = ["/en/1", "/en", "/es/", "", "/EN/2", "/es/é?x=1", "?q=/en/", "#/es/", "/en/\n/z"]
    out = [(i, rng.choice(["http", "https", ""]) + "://" + rng.choice(hosts) + rng.choice(paths))
           for i in range(200)]
    out += [(300, None), (301, ""), (302, "no scheme"), (303, "a://b://c.com/en/"), (304, "http://")]
    return [*out, (305, "http://q.com/" + "a" * 100_000), out[0], out[0], (None, out[1][1])]


def test_rules_equal_plain_python(spark):
    rows = [(*p, 1, "r") for p in pages()]
    df = spark.createDataFrame(rows, "page_id long, url string, label int, rule string")
    got = urls.judge(df, urls.parse_rules(LINES)).collect()
    have = sorted((str(r.page_id), repr((r.url, r.host, r.path, r.rule))) for r in got)
    want = sorted((str(i), repr((u, *brute(u)[:3]))) for i, u in pages())
    assert have == want
    ruled = {u: brute(u)[3] for _, u in pages()}
    assert all(r.verdict == (ruled[r.url] or r.verdict) in ("allow", "block") for r in got)


def test_trees_agree_with_held_out_labels(spark):
    rng = random.Random(6)
    rows = []
    for i in range(600):
        bad = i % 3 == 0
        host = "".join(rng.choice("0123456789-x" if bad else "aeioulmn") for _ in range(12))
        zone = rng.choice(["net", "com"]) if i % 2 else "org"
        # Marks of one length: the length of a host says nothing about its verdict.
        rows.append((i, f"http://{host}.{'evil' if bad and i % 2 else 'good'}.{zone}/p/{i}"))
    rules = urls.parse_rules(
        ["block evil.com/", "block evil.net/", "allow good.com/", "allow good.net/"]
    )
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = [r for r in urls.judge(df, rules).collect() if r.rule is None]
    right = sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in got)
    assert len(got) == 300 and right > 0.9 * len(got)


def test_trees_do_without_suffixes(spark):
    """Every suffix has urls of both verdicts, or is met once: only the path tells."""
    rng = random.Random(9)
    rows = []
    for i in range(900):
        bad = i % 3 == 0
        name = "".join(rng.choice("abcdefghij") for _ in range(9))
        path = "-".join(str(rng.randrange(10**6)) for _ in range(3)) if bad else "about-us-page"
        ruled = ("block/" if bad else "allow/") if i % 2 else "other/"
        rows.append((i, f"http://{name}.site{i % 5}.org/{ruled}{path}"))
    lines = [f"{v} site{k}.org/{v}/" for k in range(5) for v in ("block", "allow")]
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = [r for r in urls.judge(df, urls.parse_rules(lines)).collect() if r.rule is None]
    right = sum((r.verdict == "block") == (r.page_id % 3 == 0) for r in got)
    assert len(got) == 450 and right > 0.9 * len(got)


def test_no_own_verdict_in_training_rates(spark):
    """A suffix met once says nothing about its url in training."""
    rows = [(f"u{i}", f"s{i}", f"w{i}", float(i % 2), i % 5) for i in range(40)]
    train = spark.createDataFrame(rows, "url string, suffix string, wide_suffix string, label double, fold int")
    got = urls.with_rates(train, train, folded=True).collect()
    assert {(r.suffix_rate, r.wide_suffix_rate) for r in got} == {(0.5, 0.5)}
    full = urls.with_rates(train.drop("fold"), train).collect()
    assert all((r.suffix_rate > 0.5) == (r.label == 1) for r in full)


@pytest.mark.parametrize(
    ("rows", "want"),
    [([], []), ([(1, "http://a.org/")], ["allow"]), ([(1, "http://x.net/es/"), (2, None)], ["block"] * 2)],
)
def test_few_labels(spark, rows, want):
    df = spark.createDataFrame(rows, "page_id long, url string")
    got = urls.judge(df, urls.parse_rules(LINES)).orderBy("page_id").collect()
    assert [r.verdict for r in got] == want


def test_bad_rules_are_refused():
    for line in ("deny com/", "allow com", "allow /x"):
        with pytest.raises(ValueError):
            urls.parse_rules([line])
