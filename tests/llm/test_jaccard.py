"""The n-gram Jaccard join against all pairs."""

import random

import pytest
from ledgertalk.llm import jaccard
from ledgertalk.llm.components import components

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, words):
    split = [w for w in "".join(" " if c in "\t\n\v\f\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    if len(split) < words:
        return frozenset([tuple(split)]) if split else frozenset()
    return frozenset(tuple(split[i : i + words]) for i in range(len(split) - words + 1))


def all_pairs(rows, linking):
    """Smallest id of each row's component by comparing all sets."""
    sets = [shingles(text, linking.words) for _, text in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= linking.percent * len(sets[i] | sets[j]):
                top[find(i)] = find(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted(
        (str(doc_id), len(sets[i]), str(least.get(find(i)))) for i, (doc_id, _) in enumerate(rows)
    )


def changed(dice, words, share):
    return [f"w{dice.randrange(10**6)}" if dice.random() < share else w for w in words]


def corpus(seed):
    """Copies, near copies at all distances, chains, and passages that many texts hold."""
    dice = random.Random(seed)
    texts = [None, "", "  \n", "One", "one", "one two", "ONE  two", "a\x0bb c", "x y z w", "é É"]
    passage = [f"p{i}" for i in range(30)]
    for _ in range(12):
        base = [f"w{dice.randrange(10**6)}" for _ in range(dice.randint(5, 120))]
        texts.append(" ".join(base))
        for _ in range(dice.randint(0, 6)):
            base = changed(dice, base, dice.choice([0, 0.005, 0.01, 0.02, 0.05]))
            texts.append(dice.choice([" ", "\n"]).join(base))
    for _ in range(50):
        own = [f"w{dice.randrange(10**6)}" for _ in range(dice.randint(1, 25))]
        texts.append(" ".join(dice.sample([passage, own], 2)[0] + own))
        texts.append(" ".join(changed(dice, passage, 0.05) + own[:3]))
    rows = list(enumerate(texts))
    return [(i * 7 - 50, t) for i, t in rows] + [(None, texts[12]), (3, texts[12]), (3, texts[12])]


@pytest.mark.parametrize(
    ("seed", "linking", "common", "block"),
    [
        (2, jaccard.Linking(), 2, 7),
        (3, jaccard.Linking(5, 80), 32, 512),
    ],
)
def test_components_equal_all_pairs(spark, monkeypatch, seed, linking, common, block):
    monkeypatch.setattr(jaccard, "COMMON", common)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", block)
    rows = corpus(seed)
    docs = spark.createDataFrame(
        [(i, t, "clash", 0) for i, t in rows], "doc_id long, text string, star string, n long"
    ).repartition(3)
    found = jaccard.linked(docs, linking).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == all_pairs(
        rows, linking
    )


@pytest.mark.parametrize("common", [3, 32])
def test_long_lists_pair_by_component(spark, monkeypatch, common):
    monkeypatch.setattr(jaccard, "LONG_LIST", 1)
    monkeypatch.setattr(jaccard, "COMMON", common)
    rows = corpus(7)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard.linked(docs, jaccard.Linking(4, 80)).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == all_pairs(
        rows, jaccard.Linking(4, 80)
    )


@pytest.mark.parametrize("long_list", [0, 1000])
def test_turns_bring_each_two_components_together_once(spark, monkeypatch, long_list):
    monkeypatch.setattr(jaccard, "LONG_LIST", long_list)
    rows = [(t, part * 10, part * 100 + s) for t in (1, 2) for part in range(7 * t) for s in range(3)]
    entries = spark.createDataFrame(rows, "token long, part long, star long")
    turns = jaccard._with_turns(entries).collect()
    sides = [[(r, x) for r in turns for x in r[side]] for side in ("first", "second")]
    pairs = [
        (a.token, a.star, b.star)
        for a, x in sides[0] for b, y in sides[1] if a.token == b.token and x == y
    ]
    across = [p for p in pairs if p[1] // 100 < p[2] // 100]
    want = [(t, a, b) for t, p, a in rows for u, q, b in rows if t == u and p < q]
    assert sorted(across) == sorted(want)
    # In a long list nothing else is put together.
    assert (pairs == across or sorted(pairs) == sorted(across)) == (long_list == 0)


def test_no_broadcast_gives_the_same(spark, monkeypatch):
    rows = corpus(5)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(jaccard, "MOST_BROADCAST_IDS", -1)
    found = jaccard.linked(docs).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == all_pairs(
        rows, jaccard.Linking()
    )


def test_a_crowd_makes_no_pairs(spark, monkeypatch):
    """Sets of common shingles only: components are right and no pair of them is a row."""
    monkeypatch.setattr(jaccard, "COMMON", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 16)
    dice = random.Random(9)
    base = [f"b{i}" for i in range(60)]
    rows = [(i, " ".join(changed(dice, base, 0.06))) for i in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = jaccard.Join(docs, jaccard.Linking())
    stars = join.stars()
    met = join.meetings(join.index(stars)).count()
    assert met < 120 * 16
    found = join.result().collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == all_pairs(
        rows, jaccard.Linking()
    )


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.linked(none).count() == 0
    assert jaccard.one_of_each(none, jaccard.Linking()).count() == 0


def test_one_of_each_keeps_one_row_of_a_group(spark):
    long = " ".join(f"w{i}" for i in range(80))
    rows = [
        (5, long, "a"),
        (2, long + " end", "b"),
        (2, long + " end", "b"),
        (9, "another text of some words", "c"),
        (4, None, "d"),
        (6, "", "e"),
        (None, "no id here at all", "f"),
        (None, "no id here at all", "f"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    kept = jaccard.one_of_each(docs, jaccard.Linking(5, 80))
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "6", "9", "None"]


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(8, 40)] + [(1, 1), (3, 2)]
    found = components(spark.createDataFrame(edges, "a long, b long"))
    expected = {i: 100 for i in range(100, 161)} | {i: 7 for i in range(7, 40)} | {2: 2, 3: 2}
    assert {r.node: r.label for r in found.collect()} == expected
