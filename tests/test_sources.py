import os
import subprocess
import sys
from pathlib import Path

import pytest

from ledgertalk.sources import sinks, tables
from ledgertalk.sources.scratch import scratch_folder, stored

HEAD = "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"


def test_quoted_fields_and_codes_stay_text(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(
        HEAD
        + '536365,85123A," WHITE ""X"" HOLDER, BIG ",6,2010-12-01 08:26:00,2.55,17850.0,United Kingdom\n'
        + "00012,22,TIN,1,bad,x,,France\n"
    )
    first, second = tables.read_transactions(spark, str(path)).collect()
    assert first.Description == ' WHITE "X" HOLDER, BIG ' and first.CustomerID == "17850.0"
    assert (second.InvoiceNo, second.CustomerID, second.Country) == ("00012", None, "France")


def test_columns_are_bound_by_name(spark, tmp_path):
    path = tmp_path / "raw.csv"
    names = HEAD.strip().split(",")
    path.write_text(",".join(reversed(names)) + ",Extra\n" + ",".join(reversed(list("ABCDEFGH"))) + ",z\n")
    row = tables.read_transactions(spark, str(path)).first()
    assert (row.InvoiceNo, row.Country) == ("A", "H")


def test_missing_column_is_reported(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text("InvoiceNo,StockCode\n1,2\n")
    with pytest.raises(ValueError, match="lack.*Description"):
        tables.read_transactions(spark, str(path))


def test_csv_parts_round_trip_and_empty_folder(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, n bigint")
    target = str(tmp_path / "out")
    sinks.write_csv(df.repartition(3), target, files=None)
    back = tables.read_csv_parts(spark, target, "k string, n bigint")
    assert sorted(map(tuple, back.collect())) == [("a", 1), ("b", 2), ("c", 3)]
    empty = tmp_path / "empty"
    empty.mkdir()
    for folder in (empty, tmp_path / "absent"):
        with pytest.raises(FileNotFoundError):
            tables.read_csv_parts(spark, str(folder), "k string")


def test_single_csv_is_sorted_and_text_is_one_file(spark, tmp_path):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, n bigint").repartition(3)
    sinks.write_csv(df, str(tmp_path / "csv"), order=["k"])
    (part,) = (tmp_path / "csv").glob("part-*")
    assert part.read_text() == "k,n\na,1\nb,2\nc,3\n"
    sinks.write_lines(df, str(tmp_path / "text"), "k")
    (part,) = (tmp_path / "text").glob("part-*")
    assert sorted(part.read_text().split()) == ["a", "b", "c"]


def test_jsonl_splits(spark, tmp_path):
    for name in ("t", "v"):
        (tmp_path / name).write_text('{"messages":[{"role":"user","content":"%s é"}]}\n' % name)
    df = tables.read_chat_jsonl(
        spark, {"train": str(tmp_path / "t"), "validation": str(tmp_path / "v")}
    )
    found = {r.split: r.messages[0].content for r in df.collect()}
    assert found == {"train": "t é", "validation": "v é"}


def test_lines_fill_as_many_files_as_their_bytes_need(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_BYTES", 1000)
    df = spark.range(100).selectExpr("concat('é', lpad(id, 97, 'x')) AS json").repartition(7)
    sinks.write_lines(df, str(tmp_path / "sized"))
    parts = list((tmp_path / "sized").glob("part-*"))
    assert len(parts) == 10
    assert sorted(line for p in parts for line in p.read_text().split()) == sorted(r.json for r in df.collect())
    sinks.write_lines(df.limit(0), str(tmp_path / "none"))
    assert sum(len(p.read_text()) for p in (tmp_path / "none").glob("part-*")) == 0


def test_lines_know_their_place_in_a_file_of_many_blocks(spark, tmp_path):
    from ledgertalk.operators import quality

    rows = {}
    for name, n in (("a", 700), ("b", 3), ("c", 250)):
        text = [("" if i % 5 == 3 else f"{name}{i} " + "x" * (i % 40)) for i in range(n)]
        (tmp_path / f"{name}.jsonl").write_text("\n".join(text) + "\n")
        rows[name] = [(i + 1, line) for i, line in enumerate(text) if line]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        lines = tables.read_numbered_lines(spark, str(tmp_path))
        assert lines.select("file", "block").distinct().count() > 6
        for most in (None, 1, 100, 137, 10_000):
            found = {}
            for r in quality.checked_files(lines, most).collect():
                found.setdefault(r.file[-7], []).append((r.line_no, r.line))
                assert r.fault == "not_json"
            assert {name: sorted(x) for name, x in found.items()} == {
                name: x[:most] for name, x in rows.items()
            }
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stored_tables_live_in_the_shared_folder(spark):
    df = stored(spark.range(5), "numbers")
    assert df.count() == 5
    assert all(scratch_folder(spark) in name for name in df.inputFiles())


def test_command_line_run_removes_only_its_own_tables(tmp_path):
    shared = tmp_path / "shared"
    other = shared / "ledgertalk" / "another-application"
    other.mkdir(parents=True)
    rows = "".join(
        f"{i // 3},P{i % 5},ITEM {i % 5},1,2011-01-01 00:00:00,1.5,7,UK\n" for i in range(60)
    )
    (tmp_path / "raw.csv").write_text(HEAD + rows)
    command = [sys.executable, "-m", "ledgertalk", "build", "--files", "2"]
    command += ["--input", str(tmp_path / "raw.csv"), "--output", str(tmp_path / "out")]
    options = {
        "spark.master": "local[2]",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(shared),
    }
    flags = " ".join(f"--conf {name}={value}" for name, value in options.items())
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": f"{flags} pyspark-shell"}
    root = Path(__file__).resolve().parent.parent
    subprocess.run(command, check=True, cwd=root, env=env, timeout=300, capture_output=True)
    assert len(list((tmp_path / "out" / "train_jsonl").glob("part-*"))) == 2
    assert [p.name for p in (shared / "ledgertalk").iterdir()] == ["another-application"]
