"""HTML extraction, url rules, sharding, quality rules, the language model, personal data and
nearest neighbours against brute force on small inputs."""

import hashlib
import itertools
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from check import connect, sorted_rows
from ledgertalk.llm import (
    ann,
    common,
    html_extract,
    pii,
    quality_lm,
    quality_rules,
    sharding,
    url_rules,
)

SF = "/root/testdata/sf0.001"


# HTML extraction.

PARAGRAPH = "Some sentence of an article, with commas, and enough words to be prose. " * 3


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("plain  text\n here", "plain text here"),
        ("<div><script>var a='<p>no</p>'</script><style>p{}</style></div>", ""),
        (
            "<html><head><title>T</title></head><body><header><h1>Site</h1></header><nav><ul><li>"
            "<a href=x>menu</a></ul></nav><article><h1>Title &amp; more</h1><p>First&nbsp;one,"
            f"\n two.<p><b>{PARAGRAPH}<br>tail</b></p><div class='share-buttons'>Share</div>"
            "<ul><li>item one<li>item two</ul></article><aside>side</aside><div id=comments><p>"
            f"{PARAGRAPH}</p></div><footer>&copy; foot</footer></body></html>",
            f"Title & more\n\nFirst one, two.\n\n{PARAGRAPH.strip()} tail\n\nitem one\n\nitem two",
        ),
        (
            f"<body><div class=cookie-notice>We use cookies</div><div class=wrap><div class=content>"
            f"<h2>Head</h2><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p><form>name <input></form>"
            f"<p>short</p></div><div class=sidebar><p>{PARAGRAPH}</p></div></div>"
            "<!-- ad --><div class='ad'>Buy, now, this, thing</div>",
            f"Head\n\n{PARAGRAPH.strip()}\n\n{PARAGRAPH.strip()}\n\nshort",
        ),
        (f"<p>{PARAGRAPH}<p title='a>b'>x &lt;y&gt; &#233;", f"{PARAGRAPH.strip()}\n\nx <y> é"),
    ],
)
def test_main_text(page, text):
    assert html_extract.main_text(page) == text


def test_extract_keeps_every_row(spark):
    rows = [(1, "u", "<p>one"), (1, "u", "<p>one"), (None, None, None), (2, "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extract.extract(pages.selectExpr("*", "1 as text", "2 as n_chars")).collect()
    assert Counter(tuple(r) for r in found) == Counter(
        [(1, "u", "one", 3), (1, "u", "one", 3), (None, None, "", 0), (2, "", "", 0)]
    )
    assert html_extract.extract(pages.limit(0)).count() == 0


def test_very_long_and_broken_pages():
    assert len(html_extract.main_text("<div>" * 20_000 + "deep")) == 4
    assert html_extract.main_text("<p>a</p>" * 50_000).count("a") == 50_000
    assert html_extract.main_text("<a href=\"" * 2_000 + "x") is not None


@pytest.mark.parametrize(
    "wrap",
    [
        '<div class="content has-sidebar">%s</div>',
        '<div id="page" class="site no-comments">%s</div>',
        '<section class="post share-enabled">%s</section>',
        '<div class="page-header-fixed">%s</div>',
        '<form action="/x"><input type=hidden>%s</form>',
        '<div class="layout-no-footer"><div>%s</div></div>',
    ],
)
def test_a_state_or_a_form_round_the_page_keeps_the_article(wrap):
    inner = f"<h1>Title</h1><p>{PARAGRAPH}</p><p class=related-work>{PARAGRAPH}</p><p>The end.</p>"
    text = f"Title\n\n{PARAGRAPH.strip()}\n\n{PARAGRAPH.strip()}\n\nThe end."
    noise = "<nav><a href=x>menu</a></nav><div class=sidebar>side</div>"
    assert html_extract.main_text(wrap % (noise + inner)) == text


def test_title_and_last_line_beside_the_best_container():
    page = f"<body><h2>Title</h2><div><p>{PARAGRAPH}</p><p>{PARAGRAPH}</p></div><p>Done.</p><p><a href=x>More.</a></p></body>"
    assert html_extract.main_text(page) == f"Title\n\n{PARAGRAPH.strip()}\n\n{PARAGRAPH.strip()}\n\nDone."


def test_small_forms_and_names_still_go():
    page = f"<body><form><p>Sign up</p></form><article><p>{PARAGRAPH}</p><p class=ad>{PARAGRAPH}</p></article><div class=post-comments><p>{PARAGRAPH}</p></div></body>"
    assert html_extract.main_text(page) == PARAGRAPH.strip()


@pytest.mark.parametrize(
    "page",
    [
        "<b>x</i>" * 600_000,
        "<a <a <a " * 600_000,
        "<a <a <a " * 600_000 + ">",
        "<!-" * 1_700_000,
        "<title>" * 700_000,
        "<article>" + "<header>" * 200_000 + "<h2>x",
        "<div><p><b>" * 400_000 + "x",
        "</div></p>" * 500_000 + "x",
        "<li><td>" * 500_000 + "x",
    ],
    ids=["inline", "starts", "one end", "comments", "titles", "headers", "deep", "ends", "cells"],
)
def test_broken_markup_of_five_megabytes_is_read_in_linear_time(page):
    began = time.process_time()
    html_extract.main_text(page)
    assert time.process_time() - began < 40


# Url rules.


def plain_verdict(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest, maxsplit=1)[0]
        path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    best = None
    for rule in url_rules.GIVEN:
        fits = host == rule.host or host.endswith("." + rule.host)
        if fits and path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
            best = rule
    return host, path, best and best.text, best and best.verdict


URLS = [
    None, "", "no scheme", "http://", "http://Example.COM/en/1", "https://www.example.com/en/2?x#y",
    "https://a.www.example.com/en/", "http://example.com", "http://notexample.com/en/3",
    "http://x.net/es/1", "http://x.net/fr", "ftp://net/es/", "a://b://c/d", "http://ÄB.org/ä\n/x?q=1",
    "http://spam.org/en/buy/1?ref=x", "http://good.org/en/1?ref=x",
]


def test_given_rules_and_mined_rules(spark):
    pages = spark.createDataFrame(
        [(i, u, "c") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string"
    )
    labels = [(f"http://spam.org/en/buy/{i}?ref=x", True) for i in range(30)]
    labels += [(f"http://good.org/en/{i}?ref=x", False) for i in range(30)] + [("http://q.org/", None)]
    labelled = spark.createDataFrame(labels, "url string, bad boolean")
    found = {r.page_id: r for r in url_rules.judged(pages, labelled).collect()}
    assert len(found) == 2 * len(URLS)
    for i, url in enumerate([*URLS, *URLS]):
        host, path, rule, verdict = plain_verdict(url)
        row = found[i]
        mined = "block" if url and "spam.org" in url else "allow"
        assert (row.host, row.path, row.rule, row.verdict) == (host, path, rule, verdict or mined)


def test_a_rule_of_five_tokens_blocks(spark):
    words = ["ab", "cd", "ef", "gh", "ij"]
    path = {0: "/".join(words)} | {i: "/".join(words[: i - 1] + words[i:]) for i in range(1, 6)}
    # All five together are bad; any four are as often good.
    rows = [(f"http://a.org/{path[i]}", i == 0) for i in range(6) for _ in range(20)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    pages = spark.createDataFrame([(i, f"http://a.org/{p}") for i, p in path.items()], "page_id long, url string")
    found = {r.page_id: r.verdict for r in url_rules.judged(pages, labelled).collect()}
    assert found == {0: "block"} | dict.fromkeys(range(1, 6), "allow")


def test_mined_rules_are_pruned_and_can_be_none(spark):
    labels = [(f"http://spam.org/buy/{i}", True) for i in range(20)]
    labels += [(f"http://good.org/read/{i}", False) for i in range(20)]
    labelled = spark.createDataFrame(labels, "url string, bad boolean")
    rules = url_rules.mined_rules(labelled).collect()
    assert rules and all(len(r.needs) == 1 for r in rules)
    assert url_rules.mined_rules(labelled.limit(0)).count() == 0
    pages = spark.createDataFrame([(1, "http://a.org/x")], "page_id long, url string")
    assert url_rules.judged(pages, labelled.limit(0)).first().verdict == "allow"
    assert url_rules.judged(pages.limit(0), labelled).count() == 0


def test_mined_rules_equal_all_token_sets(spark):
    """A url is blocked if any set of its tokens is bad often and surely enough."""
    dice = random.Random(4)
    parts = ["ab", "cd", "ef", "gh", "ij", "kl", "mn"]
    urls = ["http://a.org/" + "/".join(dice.sample(parts, dice.randint(0, 5))) for _ in range(25)]
    urls += ["http://b.org/twin/same/pair/ab", "http://b.org/twin/same/pair"]
    labels = [(u, dice.random() < (0.9 if "cd" in u or "twin" in u else 0.4)) for u in urls * 8]
    labelled = spark.createDataFrame(labels, "url string, bad boolean")
    wanted = urls + ["http://c.org/same", "http://c.org/cd/ij", "http://a.org/zz", "http://x.y/pair/cd"]
    pages = spark.createDataFrame(list(enumerate(wanted)), "page_id long, url string")
    has = {
        r.url: frozenset(r.has)
        for r in pages.select("url", url_rules.tokens(pages.url).alias("has")).collect()
    }
    seen = {}
    for url, bad in labels:
        for n in range(1, len(has[url]) + 1):
            for some in itertools.combinations(sorted(has[url]), n):
                good_bad = seen.setdefault(some, [0, 0])
                good_bad[bad] += 1
    least = math.ceil(url_rules.LEAST_URLS / len(labels) * len(labels))
    sure = [set(k) for k, (g, b) in seen.items() if b >= least and b / (g + b) >= 0.8]
    expected = {u: any(rule <= has[u] for rule in sure) for u in wanted}
    found = url_rules.matched(pages, url_rules.mined_rules(labelled))
    assert {r.url for r in found.collect()} == {u for u, hit in expected.items() if hit}
    assert 0 < sum(expected.values()) < len(expected)


def test_one_repeated_long_url_is_one_need(spark):
    long = "http://a.org/" + "/".join(f"w{i}{chr(97 + i % 26)}x" for i in range(40))
    rows = [(f"http://b.org/{chr(97 + i % 26)}", False) for i in range(100)] + [(long, True)] * 100
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    (rule,) = url_rules.mined_rules(labelled).collect()
    assert len(rule.needs) == 1 and len(rule.members[0]) > 20
    pages = [(1, long), (2, "http://c.org/w0ax"), (3, "http://b.org/a"), (4, long)]
    found = url_rules.judged(spark.createDataFrame(pages, "page_id long, url string"), labelled)
    verdicts = {r.page_id: r.verdict for r in found.collect()}
    assert verdicts == {1: "block", 2: "block", 3: "allow", 4: "block"}


def test_one_long_url_among_few_makes_no_rules(spark):
    long = "http://a.org/" + "/".join(f"w{i}{chr(97 + i % 26)}x" for i in range(40))
    rows = [(f"http://b.org/{chr(97 + i % 26)}", i % 2 == 0) for i in range(99)] + [(long, True)]
    labelled = spark.createDataFrame(rows, "url string, bad boolean")
    assert url_rules.mined_rules(labelled).filter("array_contains(needs, 'p:w0ax')").count() == 0


# Sharding.


def test_shards_are_even_and_keep_equal_texts_together(spark):
    dice = random.Random(1)
    rows = [(i, "x" * dice.randint(0, 400) + " y" * dice.randint(0, 40)) for i in range(1500)]
    rows += [(5000 + i, "hot text " * 20) for i in range(700)]
    rows += [(6000 + i, "warm text") for i in range(40)] + [(7000, None), (None, "no id"), (8000, "t"), (8000, "t")]
    docs = spark.createDataFrame([(a, b, 0) for a, b in rows], "doc_id long, text string, shard int")
    found = sharding.shard_rows(docs.repartition(5)).collect()
    size = {i: len((t or "").encode()) + 8 for i, t in rows}
    crc = {i: zlib.crc32((t or "").encode()) for i, t in rows}
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in rows)
    assert all(r["size"] == size[r.doc_id] and r.text_crc32 == crc[r.doc_id] for r in found)
    total = defaultdict(int)
    slots = defaultdict(list)
    for r in found:
        total[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(total) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(total.values()) / 24
    assert max(total.values()) < 1.05 * mean and min(total.values()) > 0.95 * mean
    assert len({r.shard for r in found if 6000 <= (r.doc_id or 0) < 7000}) == 1


def plain_place(items, shards):
    """Shard of each item, by comparing all shards for each, in exact numbers."""
    from fractions import Fraction

    whole = [sum(x[k] for x in items) or 1 for k in range(3)]
    scaled = [[Fraction(int(x[k]) * shards, int(whole[k])) for k in range(3)] for x in items]
    root = [Fraction(math.isqrt(int(w))) for w in sharding.WEIGHTS]
    left = [list(root) for _ in range(shards)]
    found = [0] * len(items)
    for i in sorted(range(len(items)), key=lambda i: (-max(s * r for s, r in zip(scaled[i], root, strict=True)), -scaled[i][0], i)):
        item = [s * r for s, r in zip(scaled[i], root, strict=True)]
        best = max(range(shards), key=lambda s: (sum(a * b for a, b in zip(left[s], item, strict=True)), -s))
        left[best] = [a - b for a, b in zip(left[best], item, strict=True)]
        found[i] = best
    return found


@pytest.mark.parametrize("seed", range(5))
def test_placing_equals_a_plain_version(seed):
    dice = random.Random(seed)
    # Sums of shards that are powers of two, so that floats are exact too.
    items = [[2 ** dice.randint(3, 9), dice.randint(0, 40), 1] for _ in range(255)]
    for k in range(3):
        items_sum = sum(x[k] for x in items)
        if k == 0:
            last = [2 ** math.ceil(math.log2(items_sum + 1)) - items_sum]
        else:
            last.append(2 ** math.ceil(math.log2(items_sum + 1)) - items_sum)
    items.append(last)
    got = sharding.place(np.array(items, dtype=float), 8)
    assert got.tolist() == plain_place(items, 8)


def test_shards_of_few_rows_and_none(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert sorted(r.doc_id for r in sharding.shard_rows(docs).collect()) == [1, 2]
    assert sharding.shard_rows(docs.limit(0)).count() == 0


# Quality rules.


def rule_numbers(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            inside |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    base = n < 50 or 100 * len(inside) > 50 * n
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside), base,
    )


def test_quality_rules_equal_brute_force(spark):
    dice = random.Random(2)
    texts = [None, "", " \n\t", "a", "a b c a b c", "x\n\nx\n x\nx", "é" * 10, "\x0b\x0c a\u00a0b"]
    for k in (2, 5, 40, 4000):
        texts += [" ".join(str(dice.randrange(k)) for _ in range(dice.randint(40, 300))) for _ in range(6)]
    texts += ["WORD!! " * 100, " ".join(f"w{i} |" for i in range(80)), "long words here " * 5000]
    texts += [" ".join(f"plain{i} prose" for i in range(60))]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "again"), (None, "null id")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_words int")
    found = quality_rules.judged(docs).collect()
    assert Counter((r.doc_id, *r[1:7]) for r in found) == Counter((i, *rule_numbers(t)) for i, t in rows)
    kept = {r.doc_id: r.kept for r in found}
    assert kept[len(texts) - 1] and not kept[len(texts) - 3] and not kept[len(texts) - 4]
    # The cascade drops what the judgement rejects, and changes no column.
    good = quality_rules.keep_good(docs)
    assert good.columns == docs.columns
    assert sorted(str(r.doc_id) for r in good.collect()) == sorted(str(r.doc_id) for r in found if r.kept)


def test_rules_run_by_rejection_per_cost(spark):
    docs = spark.createDataFrame([(i, "WORD " * 60) for i in range(50)], "doc_id long, text string")
    m = quality_rules.inputs()
    rules = [quality_rules.Rule("never", m["n_symbols"] < 0), quality_rules.Rule("always", m["n_upper"] > 0)]
    assert [r.name for r in quality_rules.ordered_rules(docs, rules)] == ["always", "never"]
    assert len(quality_rules.ordered_rules(docs.limit(0), rules)) == 2


def test_windows_that_share_a_hash_are_compared_by_words(spark, monkeypatch):
    """With one hash for all windows the result comes from the words themselves."""
    monkeypatch.setattr(quality_rules, "ordered_rules", lambda docs, rules, *_: list(rules))
    monkeypatch.setattr(quality_rules, "_windows", _one_hash)
    docs = spark.createDataFrame([(1, "a b c d a b c e"), (2, "a b c d e f")], "doc_id long, text string")
    found = {r.doc_id: r.n_repeat_words for r in quality_rules.judged(docs).collect()}
    assert found == {1: 6, 2: 0}


def _one_hash(words):
    from pyspark.sql import functions as F

    return F.transform(F.slice(words, F.lit(1), F.greatest(F.size(words) - 2, F.lit(0))), lambda w, i: i.cast("long"))


def test_quality_rules_equal_sql(spark, monkeypatch):
    monkeypatch.setattr(quality_rules, "ordered_rules", lambda docs, rules, *_: list(rules))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ours = quality_rules.judged(docs)
    result = connect(SF).execute(quality_rules.SQL)
    theirs = sorted_rows([d[0] for d in result.description], result.fetchall())
    assert sorted_rows(ours.columns, [tuple(r) for r in ours.collect()]) == theirs


# Quality classifier.


def codes(text):
    points = [ord(c) for c in f" {' '.join((text or '').split())} "] if text else []
    return [p if p < 2048 else 2048 + p % 2048 for p in points]


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney probabilities in dictionaries."""
    counts = {order: Counter()}
    for text in texts:
        c = codes(text)
        counts[order].update(tuple(c[i : i + order]) for i in range(len(c) - order + 1))
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    d, sums, taken = {}, {}, {}
    for k, table in counts.items():
        n = [sum(v == i for v in table.values()) for i in range(5)]
        if min(n[1:4]) == 0:
            d[k] = (0.5, 0.75, 1.0)
        else:
            y = n[1] / (n[1] + 2 * n[2])
            d[k] = tuple(
                min(max(x, 0.05), i)
                for i, x in enumerate((1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]), 1)
            )
        sums[k], taken[k] = Counter(), Counter()
        for g, v in table.items():
            sums[k][g[:-1]] += v
            taken[k][g[:-1]] += d[k][min(v, 3) - 1]

    def p(g):
        if not g:
            return 1 / 4096
        k, h = len(g), g[:-1]
        if h not in sums[k]:
            return p(g[1:])
        c = counts[k].get(g, 0)
        own = max(c - d[k][min(c, 3) - 1], 0) if c else 0
        return own / sums[k][h] + taken[k][h] / sums[k][h] * p(g[1:])

    return p


def test_perplexity_equals_a_plain_model(spark):
    dice = random.Random(3)
    prose = [" ".join(dice.choice(["the", "cat", "sat", "on", "mats", "été"]) for _ in range(30)) for _ in range(12)]
    texts = [*prose, None, "", "a", "THE CAT!! SAT!!", "漢字 the", "x" * 3000, " ".join(prose)]
    rows = [(i * 20000, t, "en" if i % 2 else None) for i, t in enumerate(texts)] + [(None, "cat", "en"), (0, "the cat", "en")]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, perplexity double")
    labels = spark.createDataFrame(
        [(i * 20000, 1, 0) for i in range(10)] + [(200000, 1, 1), (220000, 0, 0), (999, 1, 0)], "doc_id long, quality int, toxic int"
    )
    # The repeated id 0 makes both of its texts trusted.
    p = plain_model([*prose[:10], "the cat"], quality_lm.ORDER)
    found = quality_lm.judged(docs, labels).collect()
    assert len(found) == len(rows)
    want = defaultdict(list)
    for i, t, _ in rows:
        c = codes(t)
        grams = [tuple(c[j : j + quality_lm.ORDER]) for j in range(len(c) - quality_lm.ORDER + 1)]
        want[i].append(math.exp(-sum(math.log(p(g)) for g in grams) / len(grams)) if grams else None)
    for r in found:
        assert any(
            r.perplexity is None if w is None else r.perplexity is not None and math.isclose(w, r.perplexity, rel_tol=1e-9)
            for w in want[r.doc_id]
        )
        assert r.kept == (r.perplexity is None or r.perplexity <= r.threshold)
    good = quality_lm.keep_good(docs, labels)
    assert good.columns == docs.columns
    assert Counter(str(r.doc_id) for r in good.collect()) == Counter(str(r.doc_id) for r in found if r.kept)


def test_blocks_are_cut_by_bytes(spark):
    """Null and repeated ids, and a range of long texts, are spread; others stay ranges."""
    from pyspark.sql import functions as F

    rows = [(i, "x" * 10) for i in range(200)] + [(1000 + i, f"{i}" + "y" * 2000) for i in range(50)]
    rows += [(None, f"none {i} " + "z" * 500) for i in range(200)] + [(7777, f"same {i} " + "z" * 500) for i in range(200)]
    rows += [(None, None), (5, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for most in (1000, -1):
        found = common.in_blocks(docs, 100, 10_000, most)
        assert found.columns == ["block", *docs.columns]
        assert Counter(map(tuple, found.drop("block").collect())) == Counter(rows)
        size = Counter()
        for r in found.collect():
            size[r.block] += len(r.text or "")
        assert max(size.values()) < 30_000 and size[0] == 1000 and size[1] == 1000
    # Text ids, and numbers with a fraction, are dealt by hash.
    for kind in ("string", "double", "decimal(20,2)"):
        other = docs.withColumn("doc_id", F.col("doc_id").cast(kind))
        found = common.in_blocks(other, 100, 10_000, 1000)
        assert Counter(str(r.text) for r in found.collect()) == Counter(str(t) for _, t in rows)
        assert found.groupBy("block").agg(F.sum(F.length("text")).alias("n")).agg(F.max("n")).first()[0] < 60_000
    assert common.in_blocks(docs.limit(0), 100, 10_000, 1000).count() == 0


def test_cut_blocks_give_the_same_scores(spark, monkeypatch):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")

    def rows():
        return {r.doc_id: (r.perplexity, r.threshold, r.kept) for r in quality_lm.judged(docs, labels).collect()}

    whole = rows()
    monkeypatch.setattr(quality_lm, "BLOCK_BYTES", 50_000)
    cut = rows()
    assert whole.keys() == cut.keys()
    for i, (p, t, kept) in whole.items():
        assert math.isclose(p, cut[i][0], rel_tol=1e-9) and math.isclose(t, cut[i][1], rel_tol=1e-9)
        assert kept == cut[i][2]


def test_share_of_poor_documents_rejected(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = quality_lm.judged(spark.read.parquet(f"{sf}/documents.parquet"), labels).join(labels, "doc_id")
    rows = Counter((r.quality, r.toxic, r.kept) for r in found.select("quality", "toxic", "kept").collect())
    poor = {k: rows[0, 0, k] + rows[0, 1, k] for k in (True, False)}
    # Four characters and 1.4 times the quantile reject 459 of 571.
    assert poor[False] >= 0.85 * sum(poor.values())
    assert rows[1, 0, False] <= 0.005 * (rows[1, 0, True] + rows[1, 0, False])


def test_a_language_with_few_trusted_documents_keeps_its_clean_ones(spark):
    dice = random.Random(5)

    def prose(letters, n):
        words = ["".join(dice.choices(letters, k=dice.randint(2, 7))) for _ in range(40)]
        return [" ".join(dice.choices(words, k=80)) for _ in range(n)]

    texts = [("en", t) for t in prose("abcdefgh", 60)] + [("xx", t) for t in prose("mnopqrst", 40)]
    schema = "doc_id long, lang string, text string"
    docs = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], schema)
    for trusted in ([60], [60, 61], [60, 61, 62, 63, 64]):
        labels = spark.createDataFrame(
            [(i, 1, 0) for i in [*range(50), *trusted]], "doc_id long, quality int, toxic int"
        )
        kept = Counter(r.lang for r in quality_lm.judged(docs, labels).filter("kept").collect())
        assert kept["xx"] >= 38 and kept["en"] >= 58, (trusted, kept)


def plain_thresholds(rows, good):
    """The threshold of each language of ``rows`` (doc_id, lang, text, fold): quantiles of what
    the trusted ones get from a plain model of the other fold."""

    def perplexity(p, text):
        c = codes(text)
        seen = Counter(tuple(c[j : j + quality_lm.ORDER]) for j in range(len(c) - quality_lm.ORDER + 1))
        return math.exp(-sum(n * math.log(p(g)) for g, n in seen.items()) / sum(seen.values()))

    held = defaultdict(list)
    for fold in range(quality_lm.FOLDS):
        p = plain_model([r.text for r in rows if r.doc_id in good and r.fold != fold], quality_lm.ORDER)
        for r in rows:
            if r.doc_id in good and r.fold == fold:
                held[r.lang].append(perplexity(p, r.text))
                held[all].append(held[r.lang][-1])

    def quantile(values):
        return sorted(values)[math.ceil(quality_lm.QUANTILE * len(values)) - 1]

    top = quantile(held.pop(all))
    found = {}
    for lang, values in held.items():
        n, own, prior = len(values), quantile(values), quality_lm.PRIOR_DOCS
        want = max(own, math.exp((n * math.log(own) + prior * math.log(top)) / (n + prior)))
        found[lang] = quality_lm.MARGIN * want
    return found


def test_thresholds_equal_plain_models_of_the_other_folds(spark):
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    good = {r.doc_id for r in quality_lm.trusted_ids(labels).collect()}
    rows = docs.withColumn("fold", quality_lm.fold_of(docs["text"])).collect()
    want = plain_thresholds(rows, good)
    for r in quality_lm.judged(docs, labels).collect():
        assert math.isclose(r.threshold, want[r.lang], rel_tol=1e-5)
        assert r.kept == (r.perplexity <= r.threshold)


def test_a_language_without_trusted_text_is_not_judged(spark):
    """There is no evidence against its documents."""
    sf = "/root/testdata/sf0.001"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    spanish = docs.filter("lang = 'es'").select("doc_id")
    found = quality_lm.judged(docs, labels.join(spanish, "doc_id", "left_anti")).collect()
    here = [r for r in found if r.lang == "es"]
    assert here and all(r.kept and r.threshold is None and r.perplexity for r in here)
    assert any(not r.kept for r in found)


def test_without_trusted_text_all_stay(spark):
    docs = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_lm.keep_good(docs, labels).count() == 1
    assert quality_lm.keep_good(docs.limit(0), labels).count() == 0


# Personal data.

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain_spans(text):
    found = []
    for n, (kind, pattern) in enumerate(zip(pii.KINDS, (EMAIL, IP, CARD, PHONE), strict=True)):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                "card": lambda: 14 <= len(digits) <= 19 and sum(x - 9 * (x > 9) for x in double) % 10 == 0,
                "phone": lambda: 10 <= len(digits) <= 15,
            }[kind]
            if fine():
                found.append((m.start(), n, m.end(), kind))
    return [(a, b, k) for a, _, b, k in sorted(found)]


def test_base_spans_equal_the_patterns():
    dice = random.Random(4)
    texts = [None, "", "a@b.c@d.e", "a@b.c%x@d.e", "1.2.3.4.5.6.7.8", "001.2.3.255", "+1 (887) 555-1668.", "4" * 40]
    texts += ["".join(dice.choice("a1.@+- 4()%") for _ in range(dice.randint(5, 60))) for _ in range(4000)]
    texts += ["".join(dice.choice("0123456789 -") for _ in range(30)) for _ in range(2000)]
    assert [pii.base_spans(t) for t in texts] == [plain_spans(t) for t in texts]


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000, "a" * 200_000 + "@"):
        pii.base_spans(text)


def sentence(dice, what):
    words = ["the", "call", "of", "at", "and", "there"]
    return " ".join([dice.choice(words) for _ in range(4)] + [what] + [dice.choice(words) for _ in range(4)])


def phone(dice):
    return f"({dice.randint(200, 999)}) 555-{dice.randint(1000, 9999)}"


@pytest.fixture(scope="module")
def field(spark):
    dice = random.Random(6)
    texts = [sentence(dice, f"+1 {phone(dice)}") for _ in range(80)]
    texts += [sentence(dice, f"user{dice.randint(1, 99)}@mail{dice.randint(1, 9)}.example.com") for _ in range(60)]
    texts += [sentence(dice, str(dice.randint(1, 9999))) for _ in range(120)]
    texts += [sentence(dice, f"key{dice.getrandbits(60):x}") for _ in range(60)] + [None, ""]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return pii.fit(docs)


def test_the_field_adds_what_the_patterns_miss(field):
    dice = random.Random(7)
    found = wrong = 0
    for _ in range(60):
        number = phone(dice)
        text = sentence(dice, number)
        (spans,) = pii.added_spans([text], [pii.base_spans(text)], field)
        found += [text[a:b] for a, b, _ in spans] == [number]
    for _ in range(60):
        text = sentence(dice, str(dice.randint(1, 9999)))
        wrong += bool(pii.added_spans([text], [pii.base_spans(text)], field)[0])
    assert found >= 54 and wrong == 0


def test_viterbi_and_gradient_are_those_of_all_paths(field):

    row = pii.features(["call", "(555)", "555-1234", "now"])
    scores, lengths = field.scores([row, row[:2]])
    k = len(pii.LABELS)

    def value(path, r):
        total = field.start[path[0]] + sum(scores[r, t, x] for t, x in enumerate(path))
        return total + sum(field.move[a, b] for a, b in itertools.pairwise(path))

    labels = field.viterbi(scores, lengths)
    _, _, whole = field.marginals(scores, lengths)
    for r, n in enumerate((4, 2)):
        paths = {p: value(p, r) for p in itertools.product(range(k), repeat=n)}
        assert tuple(labels[r][:n]) == max(paths, key=paths.get)
        assert math.isclose(whole[r], math.log(sum(math.exp(v) for v in paths.values())), rel_tol=1e-9)


def test_spans_and_redaction(spark, field):
    text = "mail a.b@c.example.org or +1 (887) 555-1668, ip 1.2.3.4 é"
    rows = [(1, text, "a"), (1, text, "b"), (2, None, "c"), (None, "", "d")]
    docs = spark.createDataFrame([(*r, 3) for r in rows], "doc_id long, text string, base string, n_chars int")
    spans = pii.spans(docs, field).collect()
    assert len(spans) == 4
    for r in spans:
        want = plain_spans(text) if r.doc_id == 1 else []
        assert [(s.start, s.end, s.kind) for s in r.base] == want
    new = pii.redact(docs, field)
    assert new.schema == docs.schema
    clean = "mail [EMAIL] or [PHONE], ip [IP] é"
    assert Counter(tuple(r) for r in new.collect()) == Counter(
        [(1, clean, "a", len(clean)), (1, clean, "b", len(clean)), (2, None, "c", None), (None, "", "d", 0)]
    )
    assert pii.redact(docs.limit(0), field).count() == 0
    assert pii.train([]).index == {}


# Nearest neighbours.


def near(rows, k):
    use = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v]
    use = [(i, v) for i, v in use if np.isfinite(v).all() and v.any() and len(v) == 8]
    found = {}
    for q, v in use:
        if q % 20 == 0:
            scores = sorted((-float((v * w).sum()), i) for i, w in use if i != q)[:k]
            found[q] = [(i, -s) for s, i in scores]
    return found


def vectors(n, seed):
    dice = np.random.default_rng(seed)
    means = dice.normal(size=(12, 8))
    data = (means[dice.integers(0, 12, n)] + 0.5 * dice.normal(size=(n, 8))).astype(np.float32)
    return [(i, [float(x) for x in data[i]]) for i in range(n)]


def test_neighbours_of_a_small_table_are_exact(spark):
    rows = vectors(60, 1) + [(100 + i, [1.0] * 8) for i in range(50)]
    rows += [(200, None), (220, [0.0] * 8), (240, [None] * 8), (260, [float("nan")] * 8), (280, [1.0]), (None, [1.0] * 8)]
    frame = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, key int")
    found = defaultdict(list)
    from pyspark.sql import functions as F

    for r in ann.neighbours(frame, F.col("id") % 20 == 0).orderBy("query_id", "rank").collect():
        assert r["rank"] == len(found[r.query_id]) + 1
        found[r.query_id].append((r.vec_id, r.score))
    want = near(rows, 20)
    assert {q: [i for i, _ in v] for q, v in found.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(np.allclose([s for _, s in found[q]], [s for _, s in want[q]], rtol=1e-13) for q in want)
    assert ann.neighbours(frame.limit(0), F.col("id") % 20 == 0).count() == 0


def test_recall_with_many_lists(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(ann, "LIST", 16)
    monkeypatch.setattr(ann, "BEAM", 32)
    rows = vectors(3000, 2)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = defaultdict(set)
    for r in ann.neighbours(frame, F.col("id") % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    want = near(rows, 20)
    hits = sum(len(found[q] & {i for i, _ in v}) for q, v in want.items())
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_base_hash_is_of_the_written_spans():
    spans = [(5, 9, "phone"), (0, 4, "ip"), (0, 4, "email")]
    assert pii.written(spans) == "email:0:4,ip:0:4,phone:5:9"
    assert len(hashlib.sha256(pii.written([]).encode()).hexdigest()) == 64


def test_long_runs_of_numbers_pad_no_others():
    """A text of very many numbers beside short ones: bounded memory, and the same spans."""
    import tracemalloc

    dice = random.Random(8)
    examples = []
    for _ in range(60):
        number = f"{dice.randrange(200, 999)}-{dice.randrange(100, 999)}-{dice.randrange(1000, 9999)}"
        tokens = ["call", number, "or", str(dice.randrange(99))]
        examples.append((pii.features(tokens), [0, pii.LABELS.index("B-phone"), 0, 0]))
    field = pii.train(examples)
    short = [f"call {dice.randrange(200, 999)}-555-{dice.randrange(1000, 9999)} or {i}" for i in range(300)]
    long = " ".join(str(dice.randrange(10**6)) for _ in range(200_000))
    bases = [pii.base_spans(t) for t in short]
    alone = pii.added_spans(short, bases, field)
    assert sum(map(bool, alone)) > 250
    tracemalloc.start()
    mixed = pii.added_spans([long, *short], [pii.base_spans(long), *bases], field)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert mixed[1:] == alone
    assert peak < 400e6
    # Parts of a run are scored with their neighbours.
    run = pii.sequences(long[:60_000])
    whole = field.scores([pii.features([long[a:b] for a, b in run[0]])])[0]
    parts, _ = pii._emissions([long[:60_000]], [(0, run[0])], field)
    assert np.array_equal(whole, parts)
