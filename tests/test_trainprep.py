import hashlib
import random

import pytest
from pyspark.sql import functions as F

from ledgertalk.operators import trainprep


@pytest.fixture
def chats(spark):
    return spark.createDataFrame(
        [([("system", "be kind"), ("user", "hi"), ("assistant", "hello")],),
         ([("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "d")],)],
        "messages array<struct<role:string,content:string>>",
    )


def turn(role, content):
    return f"<|start_header_id|>{role}<|end_header_id|>\n\n{content}<|eot_id|>"


def test_text_and_prompt_layout(chats):
    texts = [r.text for r in trainprep.model_text(chats).collect()]
    assert texts[0] == turn("system", "be kind") + turn("user", "hi") + turn("assistant", "hello")
    assert texts[1].count("<|eot_id|>") == 4
    prompt = trainprep.model_prompt(chats).first().prompt
    assert prompt == (
        turn("system", "be kind") + turn("user", "hi")
        + "<|start_header_id|>assistant<|end_header_id|>\n\n"
    )


def test_subset_takes_at_most_n_of_each_split(spark):
    df = spark.range(100).select(
        F.col("id").cast("string").alias("k"),
        F.when(F.col("id") < 10, "eval").otherwise("train").alias("split"),
    )
    rows = trainprep.subset(df, ["k"], {"train": 30, "eval": 50}, 42).collect()
    assert [sum(r.split == s for r in rows) for s in ("train", "eval")] == [30, 10]
    again = trainprep.subset(df.repartition(9), ["k"], {"train": 30, "eval": 50}, 42).collect()
    assert sorted(rows) == sorted(again)


def test_overflow_flag(spark):
    df = spark.createDataFrame([(1024,), (1025,)], "approx_tokens int")
    assert [r.overflows for r in trainprep.flag_overflow(df, 1024).collect()] == [False, True]


@pytest.mark.parametrize("shards", [1, 3])
def test_packing_equals_laying_rows_end_to_end(spark, shards):
    rng = random.Random(shards)
    sizes = {f"k{i}": rng.choice([0, 1, 5, 40, 250]) for i in range(400)}
    df = spark.createDataFrame(list(sizes.items()), "k string, approx_tokens int")
    found = {r.k: r for r in trainprep.pack(df, "k", 100, shards, seed=7).collect()}

    digests = {k: hashlib.md5(f"{k}#7".encode()).hexdigest() for k in sizes}
    at = dict.fromkeys(range(shards), 0)
    for k in sorted(sizes, key=lambda k: digests[k]):
        shard = int(digests[k][:8], 16) % shards
        start, end = at[shard], at[shard] + sizes[k]
        at[shard] = end
        row = found[k]
        assert (row.shard, row.start, row.pack_id) == (shard, start, start // 100)
        assert row.spills == ((end - 1) // 100 > start // 100)


def test_response_comparison(spark):
    base = spark.createDataFrame([("p", "x"), ("q", "y"), ("r", "z")], "prompt string, base_response string")
    tuned = spark.createDataFrame([("p", "x"), ("q", "yy")], "prompt string, fine_tuned_response string")
    rows = sorted(tuple(r) for r in trainprep.compare_responses(base, tuned).collect())
    assert rows == [("p", "x", "x", 1, 1, True), ("q", "y", "yy", 1, 2, False)]


def test_repeated_prompts_meet_in_order_of_reply_hashes(spark, monkeypatch):
    monkeypatch.setattr(trainprep, "REPEATS", 4)
    rng = random.Random(2)
    left = [(rng.choice(["p", "p", "p", "q", None]), rng.choice(["x", "y", "z", "", None, "long"])) for _ in range(120)]
    right = [(rng.choice(["p", "p", "q", "r"]), rng.choice(["x", "u", "v", None])) for _ in range(90)]
    left += [("hot", "same")] * 50
    right += [("hot", "same")] * 30 + [("hot", "other")] * 30
    base = spark.createDataFrame(left, "prompt string, base_response string")
    tuned = spark.createDataFrame(right, "prompt string, fine_tuned_response string")

    def order(reply):
        return (hashlib.md5((reply or "").encode()).hexdigest(), reply is not None, reply or "")

    wanted = []
    for prompt in ("p", "q", "hot"):
        a = sorted((y for x, y in left if x == prompt), key=order)
        b = sorted((y for x, y in right if x == prompt), key=order)
        wanted += [(prompt, x, y) for x, y in zip(a, b)]
    found = [tuple(r)[:3] for r in trainprep.compare_responses(base, tuned).collect()]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)


@pytest.mark.parametrize("size", [1, 90, 400, 10**6])
def test_conversations_are_cut_between_turns(spark, monkeypatch, size):
    monkeypatch.setattr(trainprep, "TURN_BLOCK", 4)
    rng = random.Random(size)
    rows, whole = [], {}
    for conv in [1, 2, 3, None]:
        turns = [None] * (conv == 2) + list(range(-3, rng.choice([1, 6, 40])))
        said = [(t, rng.choice(["user", "assistant", None]), rng.choice(["", None, "a", "é" * 30])) for t in turns]
        said += said[-1:] * 2
        rows += [(conv, *turn) for turn in said]
        whole[conv] = [turn(r or "", c or "") for _, r, c in sorted(said, key=lambda s: (s[0] is not None, s[0] or 0, turn(s[1] or "", s[2] or "")))]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {}
    for r in trainprep.conversation_text(df, size).collect():
        found.setdefault(r.conv_id, []).append((r.part, r.start, r.text))
    for conv, pieces in whole.items():
        parts, at = {}, 0
        for piece in pieces:
            parts.setdefault(at // size, [at, ""])[1] += piece
            at += len(piece)
        assert sorted(found[conv]) == [(k, start, text) for k, (start, text) in sorted(parts.items())]
        assert "".join(text for *_, text in sorted(found[conv])) == "".join(pieces)
