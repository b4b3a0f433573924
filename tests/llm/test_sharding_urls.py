import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tamarack.llm import sharding
from tamarack.llm.sharding import kd_shards
from tamarack.llm.urls import PATTERN_RULES, candidate_rules, compile_rule, judge_urls, read_rules, split_url
from tests.llm.conftest import ODD


def check_shards(rows, texts, shards):
    per = defaultdict(list)
    for r in rows:
        per[r["shard"]].append(r)
    assert set(per) <= set(range(shards))
    for held in per.values():
        assert sorted(r["slot"] for r in held) == list(range(len(held)))
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in texts)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    return {k: sum(r["size"] for r in v) for k, v in per.items()}


def test_shards_are_balanced_and_keep_equal_texts(spark, docs_of):
    texts = [(i, f"text {i % 700} " + "x" * (i * 37 % 400)) for i in range(3000)] + [(3000 + i, "twin " * 20) for i in range(30)]
    rows = kd_shards(docs_of(texts), shards=24).collect()
    sizes = check_shards(rows, texts, 24)
    mean = sum(sizes.values()) / 24
    assert len(sizes) == 24 and max(sizes.values()) < 1.1 * mean and min(sizes.values()) > 0.9 * mean


def test_a_text_that_a_third_of_the_rows_hold_is_dealt_out(spark, docs_of):
    texts = [(i, "hot text " * 9) for i in range(1500)] + [(i, f"cold {i} " * 9) for i in range(1500, 4500)]
    sizes = check_shards(kd_shards(docs_of(texts), shards=24).collect(), texts, 24)
    assert max(sizes.values()) < 1.15 * sum(sizes.values()) / 24


def test_target_bytes_odd_rows_and_empty_tables(spark, docs_of):
    check_shards(kd_shards(docs_of(ODD), target_bytes=50_000).collect(), ODD, 6)
    assert kd_shards(docs_of([]), shards=24).count() == 0
    assert kd_shards(docs_of([(1, "only")]), shards=24).collect()[0]["shard"] in range(24)


def test_slots_of_null_and_repeated_ids(spark, docs_of, monkeypatch):
    """A third without an id, a third under one id, most of them equal rows: gapless slots, the same in a second run."""
    monkeypatch.setattr(sharding, "COPIES", 50)
    monkeypatch.setattr(sharding, "CHUNK", 10)
    texts = [(None, f"none {n % 40} " * 5) for n in range(1200)] + [(7, "seven " * 9)] * 1200 + [(n, f"own {n} " * 6) for n in range(1200)]
    runs = [kd_shards(docs_of(texts), shards=6).collect() for _ in range(2)]
    check_shards(runs[0], texts, 6)
    of = [Counter((r["doc_id"], r["text_crc32"], r["shard"], r["slot"]) for r in run) for run in runs]
    assert of[0] == of[1]


URLS = [
    None, "", "no scheme", "http://", "HTTP://WWW.Example.COM/en/x?y#z", "http://a.example.com/en/1", "https://x.net/es/1", "https://x.net/fr",
    "ftp://casino-win.example.org/a", "http://notspam-farm.org/", "http://spam-farm.org", "http://docs.ads.org/api/x", "http://ads.docs.org/api/",
    "a://b://c/d", "http://h.org?x/y", "http://h.org#x/y", "http://a\nb/c\nd", "http://é.org/ü", "http://x.org/p?affid=3", "http://net/es/", "http://h.org/CASINO/",
]


def test_urls_against_plain_python(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def judge(url):
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host):])[0]
            host = host.translate(upper)
        fits = [(s + p, v) for s, p, v in rules if (host == s or host.endswith("." + s)) and path.startswith(p)]
        rule, verdict = max(fits, key=lambda f: len(f[0]), default=(None, None))
        hits = [(v == "block", r, v) for r in PATTERN_RULES for x, v, _ in [compile_rule(r)] if url is not None and re.search(x, url.translate(upper))]
        pattern = min(hits, default=(None, None, None))
        return host, path, rule, pattern[1], verdict or pattern[2] or "allow"

    pages = spark.createDataFrame([(k, u, "old") for k, u in enumerate(URLS * 2)], "page_id long, url string, verdict string")
    got = {r["page_id"]: r for r in judge_urls(pages).collect()}
    assert len(got) == 2 * len(URLS)
    for k, u in enumerate(URLS * 2):
        assert tuple(got[k][c] for c in ("host", "path", "rule", "pattern", "verdict")) == judge(u), u
    assert {r["verdict"] for r in got.values()} == {"allow", "block"}
    assert judge_urls(pages.limit(0)).count() == 0


@pytest.mark.parametrize("rule,tokens", [("||spam-farm.", ["spam", "farm"]), ("/casino/", ["casino"]), ("casino", []), ("*ads*", []), ("^affid=", ["affid"]), ("||ads", [])])
def test_only_delimited_literals_are_tokens(rule, tokens):
    assert compile_rule(rule)[2] == tokens


def test_host_of_a_url(spark):
    row = spark.createDataFrame([("x://A.B/c/d?e",)], "url string").select(*[c.alias(n) for c, n in zip(split_url("url"), "hp")]).first()
    assert tuple(row) == ("a.b", "/c/d")


def test_ten_thousand_rules_from_files(spark, tmp_path):
    rng = random.Random(8)
    hosts = [f"h{rng.randrange(3000)}.{rng.choice(['ads', 'shop', 'news'])}{rng.randrange(40)}.org" for _ in range(3000)]
    rules = {f"||{rng.choice(hosts)}^" for _ in range(3000)} | {f"/path{rng.randrange(10**5)}/*" for _ in range(4000)}
    rules |= {f"@@||{h}/ok{rng.randrange(9)}^" for h in hosts[:1500]} | {f"|http://s{k}.net/*/x{k}^" for k in range(2500)} | {"*-promo-*", "||shop7."}
    lines = ["[Adblock Plus 2.0]", "! a comment", "", "site.org##.banner", "a.org#@#div", "/ad[0-9]+/", "||h1.org^$third-party,image", *sorted(rules)]
    (tmp_path / "list.txt").write_text("\n".join(lines))
    table = read_rules(spark, str(tmp_path))
    assert {r["rule"] for r in table.collect()} == rules and len(rules) > 9_000
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['', f'ok{rng.randrange(9)}', f'path{rng.randrange(10**5)}/y', 'a-promo-b'])}" for _ in range(150)]
    urls += ["http://s7.net/q/x7", "http://s7.net/q/x77", None, ""]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    compiled = [(v == "block", r, v, re.compile(x)) for r in rules for x, v, _ in [compile_rule(r)]]
    got = {r["page_id"]: (r["pattern"], r["verdict"]) for r in judge_urls(pages, (), table).collect()}
    for k, u in enumerate(urls):
        late, rule, verdict, _ = min((c[:3] + (0,) for c in compiled if u is not None and c[3].search(u)), default=(0, None, "allow", 0))
        assert got[k] == (rule, verdict), u
    assert len({v for _, v in got.values()}) == 2
    known = pages.where("url is not null").select("url").distinct()
    run = candidate_rules(known, table).count()
    assert run < 8 * known.count()  # expressions run, of about ten thousand per URL
    assert judge_urls(pages, (), table.limit(0)).where("verdict <> 'allow'").count() == 0
