import json
import random

import pytest

from ledgertalk.__main__ import arguments, recipe_from
from ledgertalk.config import Recipe
from ledgertalk.plans import job

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


@pytest.fixture(scope="module")
def feed(tmp_path_factory):
    rng = random.Random(3)
    rows = []
    for invoice in range(120):
        country = rng.choice(["United Kingdom", "France"])
        for code in rng.sample(range(30), rng.randrange(1, 8)):
            cancelled = invoice % 11 == 0
            rows.append(
                f'{"C" if cancelled else ""}{1000 + invoice},P{code},"ITEM ""{code}"", BIG",'
                f"{-1 if cancelled else rng.randrange(1, 9)},2011-01-0{1 + invoice % 9} 10:00:00,"
                f"{code + 0.25},17850,{country}"
            )
    rows.append("9999,P1,,3,2011-01-01 10:00:00,0,,France")
    path = tmp_path_factory.mktemp("feed") / "raw.csv"
    path.write_text(HEAD + "\n".join(rows + rows[:10]) + "\n")
    return str(path)


def read_lines(folder):
    return [json.loads(line) for part in folder.glob("part-*") for line in part.open()]


def metrics(folder):
    (part,) = folder.glob("part-*")
    return dict(line.split(",") for line in part.read_text().split("\n")[1:] if line)


def test_profile_n_run(spark, feed, tmp_path):
    out = tmp_path / "out"
    recipe = Recipe(max_orders=60, max_products=20, max_recs=15, max_cancellations=5)
    rows = job.build(spark, feed, str(out), recipe)
    train, held = read_lines(out / "train_jsonl"), read_lines(out / "eval_jsonl")
    assert len(train) + len(held) == rows.count() == 100
    assert {tuple(m["role"] for m in r["messages"]) for r in train} == {("system", "user", "assistant")}
    texts = {json.dumps(r) for r in train}
    assert not texts & {json.dumps(r) for r in held}
    summary = {k: int(v) for k, v in metrics(out / "stats/summary_csv").items()}
    assert summary["total_sft_examples"] == 100
    assert summary["train_examples"] + summary["eval_examples"] == 100
    assert summary["raw_rows"] > summary["clean_purchase_rows"] > 0
    for name in ("split_counts_csv", "token_lengths_csv", "country_counts_csv", "product_stats_csv"):
        assert list((out / "stats" / name).glob("part-*"))
    assert spark.read.parquet(str(out / "clean_purchases_parquet")).count() == summary["clean_purchase_rows"]
    assert spark.read.parquet(str(out / "examples_with_type_parquet")).columns == ["example_type", "json"]

    for split in ("train_jsonl", "eval_jsonl"):
        results = job.validate(spark, str(out / split)).collect()
        assert [r.result for r in results] == ["ok"]

    job.prepare(spark, str(out / "train_jsonl"), str(out / "eval_jsonl"), str(tmp_path / "p"), 64, 42)
    text = spark.read.parquet(str(tmp_path / "p/model_text_parquet"))
    assert text.count() == 100 and text.filter("text LIKE '<|start_header_id|>system%'").count() == 100
    prompts = spark.read.parquet(str(tmp_path / "p/model_prompt_parquet"))
    assert prompts.count() == 100
    assert prompts.filter("prompt LIKE '%<|start_header_id|>assistant<|end_header_id|>\n\n'").count() == 100
    plan = spark.read.parquet(str(tmp_path / "p/packing_parquet"))
    assert plan.count() == len(train)

    job.figures(spark, str(out / "stats"), str(tmp_path / "f"))
    assert {p.name for p in (tmp_path / "f").iterdir()} == {
        "split_pivot", "token_describe", "token_hist50", "top_countries", "top15_products"
    }


def test_profile_s_run(spark, feed, tmp_path):
    out = tmp_path / "out"
    job.build(spark, feed, str(out), Recipe.for_profile("s", max_orders=30))
    summary = {k: int(v) for k, v in metrics(out / "eda/cleaning_summary").items()}
    assert set(summary) == {"raw_rows", "clean_purchase_rows", "cancellation_or_invalid_rows"}
    assert len(read_lines(out / "samples/sample_jsonl")) == 20
    job.figures_s(spark, str(out / "eda"), str(tmp_path / "f"))
    assert {p.name for p in (tmp_path / "f").iterdir()} == {"split_pivot", "token_buckets", "top15_products"}
    for name in ("example_type_by_split", "token_length_summary", "token_length_histogram", "top_products"):
        assert list((out / "eda" / name).glob("part-*"))


def test_a_feed_without_usable_rows_is_an_error(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(HEAD + "1,A,TIN,x,2011,1,,UK\n")
    with pytest.raises(RuntimeError, match="made no example"):
        job.build(spark, str(path), str(tmp_path / "out"), Recipe())


def test_both_basket_flags_and_profile_defaults():
    line = ["build", "--input", "i", "--output", "o"]
    assert recipe_from(arguments(line)) == Recipe()
    assert recipe_from(arguments(line + ["--max_items_per_basket", "9"])).basket_cap == 9
    s = recipe_from(arguments(line + ["--profile", "s", "--max_basket_size_for_pairs", "7"]))
    assert (s.basket_cap, s.rec_seed, s.cancel_seed) == (7, 7, 99)
    assert recipe_from(arguments(line + ["--profile", "s"])).basket_cap == 30
    assert recipe_from(arguments(line + ["--seed", "5"])).cancel_seed == 7


def test_faulty_lines_are_reported_by_file_and_number(spark, tmp_path, capsys):
    from ledgertalk.__main__ import validate

    sound = json.dumps({"messages": [{"role": r, "content": "x"} for r in ("system", "user", "assistant")]})
    (tmp_path / "some.jsonl").write_text("\n".join([sound, "", "broken", sound, '{"x":1}']) + "\n")
    assert validate(spark, [str(tmp_path / "some.jsonl")], None, str(tmp_path / "report")) == 1
    printed = capsys.readouterr().out
    assert "some.jsonl:3\tnot_json" in printed and "some.jsonl:5\tno_message_list" in printed
    text = "".join(p.read_text() for p in (tmp_path / "report" / "0").glob("part-*"))
    assert text.count("some.jsonl,") == 2 and ",3,broken,not_json" in text
    assert validate(spark, [str(tmp_path / "some.jsonl")], 1) == 0


def test_comparison_and_losses_from_csv(spark, tmp_path):
    (tmp_path / "base.csv").write_text('prompt,base_response\np,"one, ""two""\nlines"\nq,x\n')
    (tmp_path / "tuned.csv").write_text("prompt,fine_tuned_response,prompt_id\nq,x,1\nz,y,2\n")
    job.compare(spark, str(tmp_path / "base.csv"), str(tmp_path / "tuned.csv"), str(tmp_path / "both"))
    text = "".join(p.read_text() for p in (tmp_path / "both").glob("part-*"))
    assert "q,x,x,1,1,true" in text and "one" not in text
    (tmp_path / "log.csv").write_text("loss,step,rate\n0.5,20,1\n,30,1\n0.75,10,1\n")
    job.losses(spark, str(tmp_path / "log.csv"), str(tmp_path / "curve"))
    (part,) = (tmp_path / "curve").glob("part-*")
    assert part.read_text() == "step,loss\n10,0.75\n20,0.5\n"
    (tmp_path / "bare.csv").write_text("step\n1\n")
    job.losses(spark, str(tmp_path / "bare.csv"), str(tmp_path / "none"))
    with pytest.raises(ValueError, match="base_response"):
        job.compare(spark, str(tmp_path / "log.csv"), str(tmp_path / "tuned.csv"), str(tmp_path / "x"))
