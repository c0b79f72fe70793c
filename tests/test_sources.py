import json

import pytest
from pyspark.sql import functions as F

from labeltext.operators.manifest import label_by_source, source_manifest
from labeltext.plans.preparation import prepare
from labeltext.sources import files


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_raw_csv_quotes_and_missing(spark, tmp_path):
    path = write(tmp_path / "raw.csv",
                 'text_combined,label\n"line one\nline ""two"", end",1\nNA,0\nplain,null\n')
    rows = [tuple(r) for r in files.read_raw_csv(spark, path).collect()]
    assert rows == [('line one\nline "two", end', "1"), (None, "0"), ("plain", None)]


def test_row_index_follows_file_order(spark, tmp_path):
    paths = [
        write(tmp_path / f"{n}.csv", "text_combined,label\n" + "".join(f'"{n} {i}",0\n' for i in range(k)))
        for n, k in (("a", 5), ("b", 3))
    ]
    out = files.with_row_index(spark, paths).collect()
    assert all(r["text_combined"].split()[1] == str(r["raw_index"]) for r in out)
    assert len(out) == 8


def test_rows_are_numbered_over_files_and_part_files(spark, tmp_path):
    (tmp_path / "parts").mkdir()
    sizes = {"z first.csv": 4, "parts/part-0.csv": 3, "parts/part-1.csv": 0, "parts/part-2.csv": 5, "a.csv": 2}
    want = []
    for pos, name in enumerate(sizes):
        lines = [f'"{name}\nrow {k}",{k % 2}' for k in range(sizes[name])]
        write(tmp_path / name, "text_combined,label\n" + "".join(f"{x}\n" for x in lines))
        want += [(f"{name}\nrow {k}", {0: 0, 4: 2}.get(pos, 1)) for k in range(sizes[name])]
    paths = [str(tmp_path / n) for n in ("z first.csv", "parts", "a.csv")]
    rows = files.numbered_rows(spark, paths)
    for _ in range(2):
        got = rows.orderBy("row").collect()
        assert [r.row for r in got] == list(range(14))
        assert [(r.text_combined, r.path_pos) for r in got] == want
        assert [r.path_row for r in got] == [*range(4), *range(8), *range(2)]
    across = files.with_row_index(spark, paths, across=True).collect()
    assert sorted(r.raw_index for r in across) == list(range(14))
    with pytest.raises(ValueError, match="more than once"):
        files.numbered_rows(spark, [paths[0], paths[0]])


def _jobs(spark, group, work):
    spark.sparkContext.setJobGroup(group, group)
    work()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_sources_with_other_headers_load_in_one_pass(spark, tmp_path):
    heads = ["label", "subject,label,body", "body,label", "\ufefflabel,body"]
    listed = []
    for k in range(9):
        head = heads[k % 4]
        at = head.removeprefix("\ufeff").split(",").index("label")
        lines = [",".join(str((i + k) % 2) if c == at else f'"b, {i}"' for c in range(len(head.split(",")))) for i in range(k + 1)]
        listed.append((f"s{k}", write(tmp_path / f"s{k}.csv", "\n".join([head, *lines]) + "\n")))
    got = {(r.source, r.source_pos, r.source_row_index): r.label for r in files.read_sources(spark, listed).collect()}
    assert got == {(f"s{k}", k, i): (i + k) % 2 for k in range(9) for i in range(k + 1)}
    few = _jobs(spark, "few", lambda: files.read_sources(spark, listed[:4]).count())
    many = _jobs(spark, "many", lambda: files.read_sources(spark, listed[:8]).count())
    assert few == many
    (tmp_path / "bad.csv").write_text("body\nx\n")
    with pytest.raises(ValueError, match="label"):
        files.read_sources(spark, [*listed, ("bad", str(tmp_path / "bad.csv"))])


def sources(spark, tmp_path, a, b):
    paths = [
        write(tmp_path / f"{n}.csv", "text_combined,label\n" + "".join(f"t,{v}\n" for v in labels))
        for n, labels in (("source_a", a), ("source_b", b))
    ]
    return files.read_sources(spark, [("source_a", paths[0]), ("source_b", paths[1])])


def combined(spark, labels):
    return spark.createDataFrame(list(enumerate(labels)), "raw_index bigint, label bigint")


def test_manifest_blocks(spark, tmp_path):
    table = source_manifest(sources(spark, tmp_path, [1, 0], [1]), combined(spark, [0, 1, 1]))
    rows = sorted(tuple(r) for r in table.collect())
    assert rows == [(0, "source_a", 0, 0), (1, "source_a", 1, 1), (2, "source_b", 0, 1)]
    counts = {(r["source"], r["label"]): r["n"] for r in label_by_source(table).collect()}
    assert counts == {("source_a", 0): 1, ("source_a", 1): 1, ("source_b", 1): 1}


def test_manifest_errors(spark, tmp_path):
    with pytest.raises(ValueError, match="source_a"):
        source_manifest(sources(spark, tmp_path, [1, 1], [1]), combined(spark, [0, 1, 1]))
    with pytest.raises(ValueError, match="no source"):
        source_manifest(sources(spark, tmp_path, [1, 0], [1]), combined(spark, [0, 1, 1, 1]))
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        sources(spark, tmp_path, [3], [1])
    with pytest.raises(ValueError, match="not numbers"):
        sources(spark, tmp_path, ["x"], [1])


def test_jsonl_export(spark, tmp_path):
    rows = [(f"{s} email", 1, s) for s in ("train", "val", "test")] + [("été", 0, "test")]
    df = spark.createDataFrame(rows, "text_combined string, label bigint, split string")
    info = files.export_jsonl(df, str(tmp_path / "out"))
    assert {(r["split"], r["label"]): r["n"] for r in info.collect()} == {
        ("train", 1): 1, ("val", 1): 1, ("test", 1): 1, ("test", 0): 1,
    }
    lines = [line for f in (tmp_path / "out" / "split=train").glob("*.json")
             for line in f.read_text(encoding="utf-8").splitlines()]
    assert lines == ['{"text":"train email","label":1}']
    text = "".join(f.read_text(encoding="utf-8") for f in (tmp_path / "out" / "split=test").glob("*.json"))
    assert "été" in text


def test_summary_and_metric_tables(spark, tmp_path):
    df = spark.createDataFrame([("svc", 0.5)], "model string, f2 double")
    files.write_summary(df, str(tmp_path / "s"))
    (file,) = (tmp_path / "s").glob("*.json")
    assert json.loads(file.read_text()) == {"model": "svc", "f2": 0.5}
    files.write_csv(df, str(tmp_path / "m.csv"))
    assert files.read_metrics(spark, str(tmp_path / "m.csv"), df.schema).collect() == df.collect()
    for _ in range(2):
        files.append_rows(df, str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_prepare_end_to_end(spark, tmp_path):
    rows = [(i, f"mail number {i} about {'money' if i % 3 else 'work'}", str(i % 2))
            for i in range(100)]
    raw = spark.createDataFrame(rows, "raw_index bigint, text_combined string, label string")
    phases, splits = prepare(raw.withColumn("label", F.col("label").cast("bigint")), str(tmp_path))
    assert phases.count() == 100 and splits.count() == 80
    assert {r["split"]: r["count"] for r in splits.groupBy("split").count().collect()} == {
        "train": 56, "val": 12, "test": 12,
    }
    with pytest.raises(RuntimeError):
        prepare(raw.withColumn("label", F.lit(1).cast("bigint")), str(tmp_path / "bad"))
