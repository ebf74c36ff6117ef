"""Readers, writers and streams on files."""

import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import got
from packetry.operators.rejects import FIELDS
from packetry.sources import readers, writers
from packetry.streaming import packets

ROW = {f: f"{f}!" for f in FIELDS} | {"case_id": "MIB-000001"}


def test_pdf_folder(spark, tmp_path):
    for n in ("MIB-000001.pdf", "b_MIB-0000022.PDF", "plain.Pdf", "x.txt"):
        (tmp_path / n).write_bytes(b"%PDF")
    assert [r[0] for r in got(readers.packets(spark, str(tmp_path)), "packet_id")] == ["MIB-000001", "MIB-0000022", "plain"]
    assert [r[0] for r in got(readers.packets(spark, str(tmp_path), strict=True), "packet_id")] == ["MIB-000001"]


@pytest.mark.parametrize("name,text", [
    ("a.json", json.dumps([ROW])), ("b.json", json.dumps({"predictions": [ROW]})), ("c.json", json.dumps({"cases": [ROW]})), ("d.json", json.dumps(ROW)), ("e.json", json.dumps({"MIB-000001": {k: v for k, v in ROW.items() if k != "case_id"}})),
    ("f.jsonl", json.dumps(ROW) + "\n\n"), ("g.csv", ",".join(FIELDS) + "\n" + ",".join(ROW[f] for f in FIELDS) + "\n"), ("h", "\n [" + json.dumps(ROW) + "]"), ("i", ",".join(FIELDS) + "\n" + ",".join(ROW[f] for f in FIELDS) + "\n"),
])
def test_submission_formats(spark, tmp_path, name, text):
    (tmp_path / name).write_text(text)
    out = readers.submission(spark, str(tmp_path / name)).select(*FIELDS).collect()
    assert [r.asDict() for r in out] == [ROW]


def test_csv_readers(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text('case_id,v\n A ,1\n,2\nA,3\nB,"x\n""y"""\n')
    df = readers.csv_strings(spark, str(p))
    assert got(readers.keyed_last(df, "case_id"), "case_id", "v") == [("A", "3"), ("B", 'x\n"y"')]
    assert got(readers.manifest_ids(spark, str(p)), "case_id") == [("A",), ("A",), ("B",), (None,)]
    with pytest.raises(ValueError):
        readers.strict_csv(spark, str(p))


def test_checkpoint_rows(spark, tmp_path):
    p = tmp_path / "c.jsonl"
    p.write_text('{"case_id": "A", "v": "1", "odd": 3}\n{broken\n{"case_id": "A", "v": "2", "note": {"finding": "x"}}\n')
    out = readers.checkpoint_rows(spark, str(p), "case_id string, v string, note struct<finding:string,reason:string>")
    assert got(out, "case_id", "v") == [("A", "2")]
    with pytest.raises(Exception):
        readers.json_lines(spark, str(p), "case_id string").collect()


def test_artifacts(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.onnx").write_bytes(b"x" * 10)
    (tmp_path / "b.pt").write_bytes(b"x" * 30)
    (tmp_path / "c.txt").write_bytes(b"x")
    assert got(readers.artifacts(spark, str(tmp_path), 20, 100), "length", "file_ok", "total_ok") == [(10, True, True), (30, False, True)]


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("B", None, 2.0), ("A", "x", 1.0)], "case_id string, b string, a double")
    writers.write_json_lines(df, str(tmp_path / "l"), one_file=True)
    assert spark.read.text(str(tmp_path / "l")).collect()[0][0] == '{"a":1.0,"b":"x","case_id":"A"}'
    writers.write_csv(df, str(tmp_path / "c"))
    assert readers.csv_strings(spark, str(tmp_path / "c")).count() == 2
    writers.write_predictions_object(df, str(tmp_path / "o"))
    text = spark.read.text(str(tmp_path / "o")).first()[0]
    assert [r["case_id"] for r in json.loads(text)["predictions"]] == ["A", "B"]
    writers.write_pretty(df.where("case_id = 'A'"), str(tmp_path / "p"))
    assert json.loads("\n".join(r[0] for r in spark.read.text(str(tmp_path / "p")).collect()))["a"] == 1.0
    writers.write_sidecar(df, str(tmp_path / "s"), "case_id", "b", ["a", "b"])
    assert spark.read.json(str(tmp_path / "s")).where("case_id = 'B'").first().feat.n_blank == 1
    assert got(writers.constant_rows(df, {"fee_status": "unknown", "confidence": 0.5}, "case_id"), "case_id", "fee_status") == [("A", "unknown"), ("B", "unknown")]
    assert "case_id: A" in writers.summary(df.where("case_id = 'A'"))


def test_stream_resumes_and_rewrites(spark, tmp_path):
    src, state, out, mark = (str(tmp_path / x) for x in ("src", "state", "out", "mark"))
    schema = "id bigint, v string"
    write = lambda a, b: spark.range(a, b).select("id", F.when(F.col("id") % 5 > 0, F.lit("x")).alias("v")).repartition(3).write.mode("append").parquet(src)
    write(0, 30)
    view = lambda df: df.groupBy("v").agg(F.count("*").alias("n"))
    run = lambda: packets.run_batches(packets.file_batches(spark, src, schema, 2), state, out, mark, view, "v").awaitTermination()
    run()
    assert got(spark.read.parquet(out), "v", "n") == [("x", 24)]
    write(30, 40)
    run()
    assert got(spark.read.parquet(out), "v", "n") == [("x", 32)]
    run()
    assert spark.read.parquet(state).count() == 32
    assert packets.unfinished(spark.range(40), spark.read.parquet(state).select("id"), "id").count() == 8


def test_guarded_work(spark):
    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"id": pdf["id"], "half": [10 // int(pdf["v"].iloc[0])]})

    df = spark.createDataFrame([(1, 5), (2, 0), (3, None)], "id bigint, v bigint")
    rows = {r.id: (r.half, r.error is None) for r in packets.guarded(df, work, "id bigint, half bigint", "id").collect()}
    assert rows[1] == (2, True) and rows[2] == (None, False) and rows[3] == (None, False)


def test_governor():
    g = packets.Governor(6, 100)
    g.after(60, 10)
    assert g.deep and g.costly
    g.after(120, 20)
    assert not g.deep and not g.costly
    h = packets.Governor(6, 100)
    for elapsed, done in ((54, 10), (60, 20), (170, 30), (215, 40)):
        h.after(elapsed, done)
    assert not h.deep and h.costly


def test_last_rows_follow_the_files_and_not_the_tasks(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"case_id": "A", "v": "first"}\n')
    (tmp_path / "b.jsonl").write_text("".join(f'{{"case_id": "B{i}", "v": "{"x" * 500}"}}\n' for i in range(400)) + '{"case_id": "A", "v": "last"}\n')
    out = readers.checkpoint_rows(spark, str(tmp_path), "case_id string, v string")
    assert out.where("case_id = 'A'").first()["v"] == "last" and out.count() == 401
    (tmp_path / "t.csv").write_text("case_id,v\nA,1\nA,2\n")
    assert got(readers.truth(spark, str(tmp_path / "t.csv")), "case_id", "v") == [("A", "2")]


def test_artifact_suffixes_in_any_case(spark, tmp_path):
    for n in ("a.ONNX", "b.tflite", "c.mar", "d.MLModel", "e.npz", "f.keras", "g.txt"):
        (tmp_path / n).write_bytes(b"xx")
    assert got(readers.artifacts(spark, str(tmp_path), 20, 3), "length", "total_ok") == [(2, False)] * 4


def test_parse_cache_keeps_nested_fields(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"A": {"v": "1", "note": {"finding": "x"}, "odd": 1}, "B": {"v": None}}))
    out = readers.parse_cache(spark, str(tmp_path / "c.json"), "v string, note struct<finding:string>")
    assert [(r.case_id, r.v, r.note.finding if r.note else None) for r in out.orderBy("case_id").collect()] == [("A", "1", "x"), ("B", None, None)]


def test_stream_with_a_governor(spark, tmp_path):
    src, state, out, mark = (str(tmp_path / x) for x in ("src", "state", "out", "mark"))
    spark.range(40).repartition(8).write.parquet(src)
    seen = []

    def work(batch, costly, deep):
        seen.append((costly, deep))
        return batch.withColumn("deep", F.lit(deep))

    slow = packets.Governor(1e-9, 40)
    packets.run_batches(packets.file_batches(spark, src, "id bigint", 2), state, out, mark, lambda df: df.agg(F.count("*").alias("n")), work=work, governor=slow).awaitTermination()
    assert seen[0] == (True, True) and seen[-1] == (False, False) and spark.read.parquet(out).first()["n"] == 40
