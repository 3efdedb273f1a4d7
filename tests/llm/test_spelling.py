import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgertalk.llm import spelling

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, word string"


def plain(rows):
    """All words by their definition: every pair of the vocabulary is compared."""
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            name = "" if doc_id is None else doc_id
            h = zlib.crc32(f"{name}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 6:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 5}
    shorter = defaultdict(set)
    holes = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            shorter[w[:i] + w[i + 1 :]].add(w)
            holes[w[:i], w[i + 1 :]].add(w)
    near = defaultdict(set)
    for w in n:
        near[w] |= shorter.get(w, set())
        for v in shorter.get(w, ()):
            near[v].add(w)
        for i in range(len(w)):
            near[w] |= holes[w[:i], w[i + 1 :]] - {w}
    found = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v.encode()), default=None)
        found[w] = best if best is not None and n[best] >= 5 * n[w] else None

    def root(w):
        while found[w] is not None:
            w = found[w]
        return w

    return sorted(
        (w, found[w], root(w), n[w], len(near[w]), n[found[w]] if found[w] else None) for w in n
    )


def run(spark, rows):
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA)
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(df).collect())


def key(rows):
    return [tuple("" if x is None else x for x in r) for r in rows]


def test_equals_plain_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = sorted(
        (r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs).collect()
    )
    wanted = plain(rows)
    assert key(found) == key(wanted)
    assert sum(r[1] is not None for r in wanted) > 50


def test_equals_plain_on_crowded_words(spark):
    """Few letters: many words share a reduced word, and chains of forms are long."""
    rnd = random.Random(3)
    words = ["".join(rnd.choice("aiqyà") for _ in range(rnd.randint(6, 8))) for _ in range(400)]
    texts = []
    for i in range(300):
        some = [words[int(len(words) * rnd.random() ** 4)] for _ in range(60)]
        texts.append((i, " ".join(w.upper() if rnd.random() < 0.2 else w for w in some)))
    chain = ["zzzzzzz", "zzzzzzy", "zzzzzyy", "zzzzyyy", "zzzyyyy"]
    for depth, w in enumerate(chain):
        texts.append((1000 + depth, f"{w} " * 6 * 6**depth))
    found = run(spark, texts)
    assert key(found) == key(plain(texts))
    assert {r[0]: r[2] for r in found}["zzzzzzz"] == "zzzyyyy"


def test_defined_results(spark):
    long = "x" * 30_000
    rows = [(1, None), (2, ""), (None, "Wintern " * 7), (None, "Wintern " * 3), (3, "winters,winterÑ " * 5)]
    rows += [(4, f"{long} ") for _ in range(6)] + [(5, f"{long}y {long}z" * 1)] * 5
    found = run(spark, rows)
    assert key(found) == key(plain(rows))
    assert run(spark, []) == []


@pytest.mark.parametrize("length", [1, 2, 7])
def test_neighbourhoods_are_full_and_distinct(length, monkeypatch):
    monkeypatch.setattr(spelling, "AT_ONCE", 16)
    rnd = random.Random(length)
    letters = "abcdefgh"
    words = ["".join(rnd.choice(letters) for _ in range(length)) for _ in range(9)]
    found = defaultdict(list)
    for rows, hashes in spelling.neighbourhoods(spelling._symbols(words)):
        for i, h in zip(rows.tolist(), hashes.view(np.int64).tolist(), strict=True):
            found[i].append(h)
    for i, w in enumerate(words):
        around = {w}
        for a in range(length + 1):
            around |= {w[:a] + c + w[a:] for c in letters}
            if a < length:
                around |= {w[:a] + c + w[a + 1 :] for c in letters} | {w[:a] + w[a + 1 :]}
        hashes = {h for x in around if x for h in spelling._hashes([x]).values()} | ({0} if "" in around else set())
        assert len(found[i]) == len(set(found[i])) == len(around)
        assert set(found[i]) == hashes
