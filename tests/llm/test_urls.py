from collections import Counter, defaultdict

import duckdb
import pytest

from tickloom.llm import url_templates as ut
from tickloom.llm.oracles import llm_oracles
from tickloom.llm.queries import op7_url_templates

from .conftest import DATA


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    host, rest = rest[:cut], rest[cut:]
    end = min((rest.find(c) for c in "?#" if c in rest), default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def rule(host, path):
    fitting = [r for r in ut.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fitting, key=lambda r: len(r.text), default=None)


def shape(segment):
    made = ""
    for c in segment:
        made += "" if c.isalpha() and made.endswith("a") else "a" if c.isalpha() else c
    return made


def brute(urls):
    """Verdicts by dictionaries, host by host and level by level."""
    import re

    pages = []
    for url in urls:
        host, path = parts(url)
        own = [re.sub("[0-9]+", "*", s) for s in path.split("/") if s]
        raw = tuple(own)
        found = rule(host, path)
        pages.append((host, path, raw, found))
    tree = defaultdict(lambda: [0, 0, 0, ""])
    for host, _, raw, found in pages:
        cell = tree[host, raw]
        cell[0] += 1
        if found:
            cell[1] += found.verdict == "block"
            cell[2] += 1
    known = sum(c[2] for c in tree.values())
    overall = sum(c[1] for c in tree.values()) / known if known else 0.0

    def at(raw, level):
        return raw[level] if level < len(raw) else ""

    for level in range(max((len(raw) for _, raw in tree), default=0)):
        shapes, branches = defaultdict(Counter), defaultdict(lambda: defaultdict(Counter))
        for (host, raw), cell in tree.items():
            shapes[host, cell[3]][shape(at(raw, level + 1))] += cell[0]
            branches[host, cell[3]][at(raw, level)][shape(at(raw, level + 1))] += cell[0]
        for (host, raw), cell in tree.items():
            parent = host, cell[3]
            own, everything = branches[parent][at(raw, level)], shapes[parent]
            n, total = sum(own.values()), sum(everything.values())
            distance = sum(abs(own[s] / n - everything[s] / total) for s in everything)
            rare = len(branches[parent]) >= ut.MANY and n < ut.RARE * total
            alike = len(branches[parent]) > 1 and distance <= ut.SIMILAR + n**-0.5 + 1e-12
            cell.append("*" if at(raw, level) and (rare or alike) else at(raw, level))
        for cell in tree.values():
            new = cell.pop()
            cell[3] = f"{cell[3]}/{new}" if new else cell[3]
    merged = defaultdict(lambda: [0, 0])
    for (host, raw), cell in tree.items():
        merged[host, cell[3]][0] += cell[1]
        merged[host, cell[3]][1] += cell[2]
    result = []
    for host, path, raw, found in pages:
        template = tree[host, raw][3]
        bad, seen = merged[host, template]
        purity = (bad + ut.SMOOTHING * overall) / (seen + ut.SMOOTHING)
        verdict = found.verdict if found else "block" if purity >= ut.BLOCK_FROM else "allow"
        result.append((host, path, found and found.text, verdict, template or "/", pytest.approx(purity)))
    return result


URLS = [
    None, "", "no scheme", "http://", "HTTP://Www.Example.COM/en/1?x", "a://example.com", "a://example.com/en", "a://xcom/en/",
    "a://b://c/d", "a://ÀB.net/es/9#f", "a://u:p@h.net:80/fr/", "a://net/es/", "a://x.net/fr/?q=/es/", "a://x.org//a//b", "a://x.com?/en/",
    "a://h.org/1/2/3/4/5/6", "a://h.org/" + "s/" * 5000,
]


def test_urls_against_dictionaries(spark):
    urls = URLS + [f"http://shop{i % 3}.net/{lang}/item-{i}.html" for i in range(200) for lang in ("es", "fr", "de")]
    urls += [f"http://blog.org/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}{'xyz'[i % 3]}/p{i}" for i in range(90)] + URLS[:6]
    rows = [(i, u, "c") for i, u in enumerate(urls)]
    frame = spark.createDataFrame(rows, "page_id long, url string, _n string")
    found = {r.page_id: r for r in ut.judge_urls(frame).collect()}
    assert len(found) == len(urls)
    for i, want in enumerate(brute(urls)):
        r = found[i]
        assert (r.host, r.path, r.rule, r.verdict, r.template, r.purity) == want, urls[i]
    assert any(r.rule is None and r.verdict == "block" for r in found.values())


def test_whole_paths_against_dictionaries_and_sql(spark, tmp_path):
    urls = [f"http://a.net/{lang}/x/y/{kind}/z/{i % 3}/p{'abcdefghij'[i % 10]}" for i in range(30) for lang, kind in (("es", "c"), ("de", "d"))]
    urls += [f"http://b.org/k/l/m/{'abcdefghijklmnopqrstuvwxyz'[i % 26]}q/{'n' if i % 2 else 'o/n-1'}" for i in range(60)]
    urls += ["http://b.org/k/l", "http://b.org/k/l/m", "http://c.org/1/2/3/4/5/6", "http://c.org/1/2/3/x.html"]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    found = {r.page_id: r for r in op7_url_templates(spark, str(tmp_path)).collect()}
    for i, want in enumerate(brute(urls)):
        r = found[i]
        assert (r.host, r.path, r.rule, r.verdict, r.template, r.purity) == want, urls[i]
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    told = duck.sql(llm_oracles()["op7_url_templates"]).fetchall()
    assert len(told) == len(urls)
    for i, host, path, named, verdict, template, purity in told:
        assert (host, path, named, verdict, template, pytest.approx(purity)) == tuple(found[i])[1:], urls[i]


def test_long_paths_take_few_rounds(spark):
    urls = ["a://h.org/" + "s/" * 3000 + last for last in ("x-1/y", "z.html")]
    frame = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = ut.judge_urls(frame).collect()
    assert all(r.template.startswith("/s" * 3000 + "/") for r in found)


def test_null_ids_repeats_and_empty_tables(spark):
    frame = spark.createDataFrame([(None, "a://x.com/"), (None, "a://x.com/"), (1, None)], "page_id long, url string")
    assert sorted(r.verdict for r in ut.judge_urls(frame).collect()) == ["allow"] * 3
    assert ut.judge_urls(frame.limit(0)).count() == 0
    with pytest.raises(ValueError, match="clash"):
        ut.judge_urls(frame.withColumnRenamed("page_id", "host"), keep=["host"])


def test_query_against_dictionaries(spark):
    rows = spark.read.parquet(f"{DATA}/pages.parquet").select("page_id", "url").collect()
    found = {r.page_id: r for r in op7_url_templates(spark, DATA).collect()}
    for row, want in zip(rows, brute([r.url for r in rows]), strict=True):
        r = found[row.page_id]
        assert (r.host, r.path, r.rule, r.verdict, r.template, r.purity) == want


def test_no_python_in_the_plan(spark):
    plan = op7_url_templates(spark, DATA)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
