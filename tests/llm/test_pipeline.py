"""The whole pipeline against a brute-force version of each stage, and the package's edges."""

import math
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import corpus_pipeline
import numpy as np
import pyarrow.parquet as pq
from ledgertalk.llm import packing, pii, quality_lm, queries
from test_bpe_and_packing import library_ids, plain_best_fit
from test_jaccard import all_pairs
from test_others import codes, plain_model, plain_spans, plain_thresholds, rule_numbers

SF = "/root/testdata/sf0.001"


def rules_pass(text):
    n, chars, symbols, dup_lines, _, base = rule_numbers(text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    letters = [c for c in text or "" if c.isalpha()]
    upper = sum(c.isupper() for c in letters)
    with_letter = sum(any(c.isalpha() for c in w) for w in words)
    return not (
        base
        or 100 * symbols > 10 * n
        or 100 * upper > 50 * len(letters)
        or not 2 * n <= chars <= 15 * n
        or 100 * with_letter < 60 * n
        or 100 * dup_lines > 50 * len(lines)
    )


def test_run_equals_brute_force(spark):
    docs = pq.read_table(f"{SF}/documents.parquet").to_pylist()
    marks = defaultdict(list)
    for r in pq.read_table(f"{SF}/labels.parquet").to_pylist():
        marks[r["doc_id"]].append((r["quality"], r["toxic"]))
    good = {i for i, m in marks.items() if all(q == 1 and not t for q, t in m)}

    p = plain_model([d["text"] for d in docs if d["doc_id"] in good], quality_lm.ORDER)
    known = {}

    def perplexity(text):
        c = codes(text)
        grams = [tuple(c[j : j + quality_lm.ORDER]) for j in range(len(c) - quality_lm.ORDER + 1)]
        for g in grams:
            if g not in known:
                known[g] = math.log(p(g))
        return math.exp(-sum(known[g] for g in grams) / len(grams)) if grams else None

    scores = [perplexity(d["text"]) for d in docs]
    table = spark.read.parquet(f"{SF}/documents.parquet")
    limits = plain_thresholds(
        table.withColumn("fold", quality_lm.fold_of(table["text"])).collect(), good
    )
    kept = [
        d
        for d, s in zip(docs, scores, strict=True)
        if s is None or s <= limits.get(d["lang"], math.inf)
    ]
    kept = [d for d in kept if rules_pass(d["text"])]
    near = all_pairs([(d["doc_id"], d["text"]) for d in kept], corpus_pipeline.NEAR)
    first = {i for i, _, least in near if i == least}
    kept = [d for d in kept if str(d["doc_id"]) in first]
    texts = {d["doc_id"]: pii.masked(d["text"], plain_spans(d["text"])) for d in kept}

    pieces, lengths = Counter(), []
    for i, text in texts.items():
        ids = [*library_ids(text), 0]
        for k, start in enumerate(range(0, len(ids), packing.LENGTH)):
            part = ids[start : start + packing.LENGTH]
            pieces[i, k, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
            lengths.append(len(part))

    found = corpus_pipeline.run(spark, SF).collect()
    assert 0 < len(texts) < len(docs)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == pieces
    assert len({r.sequence_id for r in found}) == plain_best_fit(lengths, packing.LENGTH)


def test_stages_keep_the_columns_of_documents(spark):
    rows = [(1, "plain prose of one row", "en", "s", 22, "x"), (None, None, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_every_operator_has_one_query():
    names = list(queries.llm_queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(queries.llm_sql()) <= set(names)
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_nothing_else_imports_the_package():
    root = Path(__file__).resolve().parents[2]
    for path in (root / "ledgertalk").rglob("*.py"):
        if "llm" not in path.parts:
            assert "ledgertalk.llm" not in path.read_text()
    code = (
        "import sys, importlib.util as u; f = u.find_spec\n"
        "u.find_spec = lambda n, *a: None if n.startswith('ledgertalk.llm') else f(n, *a)\n"
        "import __spark_entry__ as e; assert e.queries() and not any(n.startswith('op1_') for n in e.queries())\n"
        "assert not any(n.startswith('ledgertalk.llm') for n in sys.modules)"
    )
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)
