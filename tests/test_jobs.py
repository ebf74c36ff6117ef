"""Evaluation and validation commands on files: totals, errors, exit codes."""

import json

import pytest

from packetry import jobs
from packetry.operators import scoring
from packetry.operators.rejects import FIELDS
from packetry.sources import readers

GOOD = dict(zip(FIELDS, ("MIB-000001", "Ann Lee", "TARN_WEAVER", "Velm-12c", "KX-1", "SPN-0001", "2026-01-02", "ore assay", "none", "paid", "APPROVED"))) | {"confidence": 1.0}


def row(**changes):
    return GOOD | changes


@pytest.fixture
def files(tmp_path):
    truth = [row(), row(case_id="MIB-000002", adjudication="DENIED"), row(case_id="MIB-000003", adjudication="NEEDS_REVIEW")]
    (tmp_path / "truth.csv").write_text("\n".join([",".join(FIELDS[:-1])] + [",".join(r[f] for f in FIELDS[:-1]) for r in truth]) + "\n")
    (tmp_path / "manifest.csv").write_text("case_id\nMIB-000001\nMIB-000002\nMIB-000003\n")

    def put(name, rows):
        path = tmp_path / name
        path.write_text("\n".join(map(json.dumps, rows)) if name.endswith("l") else json.dumps(rows))
        return str(path)

    return str(tmp_path / "truth.csv"), str(tmp_path / "manifest.csv"), put, truth, tmp_path


def test_perfect_predictions_score_everything(spark, files, capsys):
    truth, _, put, rows, folder = files
    assert jobs.evaluate(spark, truth, put("p.json", rows), str(folder / "out"), str(folder / "cases")) == 0
    assert "total_score: 150.0" in capsys.readouterr().out
    assert json.loads("\n".join(r[0] for r in spark.read.text(str(folder / "out")).collect()))["total_score"] == 150.0 and spark.read.text(str(folder / "cases")).count() == 3


def test_wrong_labels_duplicates_extras_and_missing(spark, files):
    truth, _, put, rows, _ = files
    sent = [row(), row(case_id="MIB-000002", adjudication="APPROVED"), row(case_id="MIB-000002"), row(case_id="MIB-000009"), row(case_id="")]
    path = put("p.jsonl", sent)
    assert jobs.evaluate(spark, truth, path) == 2
    result, scored = scoring.evaluated(readers.truth(spark, truth), readers.submission(spark, path))
    r = result.first()
    assert (r.submitted_rows, r.blank_rows, r.duplicate_rows, r.extra_cases, r.missing_cases, r.false_approvals) == (5, 1, 1, 1, 1, 1)
    assert r.class_raw == 4 and abs(r.classification_score - 80 * 4 / 24) < 1e-9 and abs(r.missing_penalty - 10 / 3) < 1e-9
    assert sorted((x.case_id, round(x.missing_penalty_score, 4)) for x in scored.collect()) == [("MIB-000001", 0.0), ("MIB-000002", 0.0), ("MIB-000003", 3.3333)]


@pytest.mark.parametrize("changes", [{"case_id": "MIB-1"}, {"sponsor_id": "SPN-12"}, {"arrival_date": "2026-99-99"}, {"adjudication": "approved"}, {"applicant_name": 123}, {"confidence": True}, {"confidence": "0.9"}, {"confidence": 1.5}, {"odd": 1}])
def test_broken_rows_are_refused(spark, files, changes):
    _, manifest, put, rows, _ = files
    assert jobs.validate(spark, put("p.json", [row(**changes)]), manifest) == 2


def test_validation(spark, files, capsys):
    _, manifest, put, rows, folder = files
    assert jobs.validate(spark, put("a.json", {"predictions": rows}), manifest) == 0 and jobs.validate(spark, put("b.jsonl", rows[:2]), manifest) == 0
    assert jobs.validate(spark, put("b.jsonl", rows[:2]), manifest, require_complete=True) == 2 and jobs.validate(spark, put("c.json", rows + rows[:1]), manifest) == 2
    assert jobs.validate(spark, put("d.json", [{k: v for k, v in GOOD.items() if k != "fee_status"}]), manifest) == 2 and "missing fields fee_status" in capsys.readouterr().err
    (folder / "s.csv").write_text(",".join(FIELDS) + "\n" + ",".join(str(GOOD[f]) for f in FIELDS) + "\n")
    assert jobs.validate(spark, str(folder / "s.csv"), manifest) == 0
    (folder / "pdfs").mkdir()
    (folder / "pdfs" / "MIB-000001.pdf").write_bytes(b"%PDF")
    assert jobs.validate(spark, str(folder / "s.csv"), pdf_dir=str(folder / "pdfs")) == 0 and jobs.validate(spark, put("e.json", rows), pdf_dir=str(folder / "pdfs")) == 2
    with pytest.raises(ValueError):
        jobs.validate(spark, str(folder / "s.csv"))


def test_no_truth(spark, files):
    truth, _, put, rows, folder = files
    (folder / "t.csv").write_text(",".join(FIELDS[:-1]) + "\n")
    assert jobs.evaluate(spark, str(folder / "t.csv"), put("p.json", rows)) == 1
