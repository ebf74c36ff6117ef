"""Commands: evaluate a submission against truth, validate a submission. ``python -m packetry.jobs evaluate|validate ...``

Exit codes are 0 for sound input, 2 where rows are invalid, duplicate or unexpected, 1 where there is no truth. Results are aggregates; of
errors and of examples only the first few reach the driver.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from packetry.operators import scoring
from packetry.runtime import session
from packetry.sources import readers, writers

SHOWN_ERRORS, SHOWN_IDS = 50, 10


def _few(df: DataFrame, column: str, n: int) -> list[str]:
    return [r[0] for r in df.select(column).orderBy(column).limit(n).collect()]


def evaluate(spark: SparkSession, truth: str, submission: str, output_json: str | None = None, case_scores: str | None = None) -> int:
    """Score a submission; print the summary, write the results and the scores by case where asked."""
    rows = readers.truth(spark, truth)
    if rows.isEmpty():
        print("No truth rows found.", file=sys.stderr)
        return 1
    predictions = readers.submission(spark, submission)
    result, scored = scoring.evaluated(rows, predictions)
    row = result.first()
    print(writers.summary(result))
    if output_json:
        writers.write_pretty(result, output_json)
    if case_scores:
        writers.write_json_lines(scored, case_scores)
    return 2 if row["duplicate_rows"] + row["extra_cases"] + row["invalid_adjudication"] + row["invalid_confidence"] + row["invalid_fee_status"] else 0


def validate(spark: SparkSession, submission: str, manifest: str | None = None, pdf_dir: str | None = None, require_complete: bool = False) -> int:
    """Check the rows of a submission and its cases against those of a manifest or of a folder."""
    if bool(manifest) == bool(pdf_dir):
        raise ValueError("give exactly one of manifest and pdf_dir")
    expected = readers.manifest_ids(spark, manifest) if manifest else readers.packets(spark, pdf_dir, strict=True).select(F.regexp_extract("path", r"([^/]+)\.pdf$", 1).alias("case_id"))
    expected = expected.where("case_id is not null").distinct()
    raw, kind = readers.raw_submission(spark, submission)
    errors = scoring.raw_row_errors(raw, kind)
    ids = raw.select(F.trim(F.try_element_at("row", F.lit("case_id"))).alias("case_id")).where("case_id <> ''")
    seen = ids.distinct()
    again = ids.groupBy("case_id").agg(F.count("*").alias("n")).where("n > 1").select(F.concat(F.lit("duplicate case_id "), "case_id").alias("error"))
    errors = errors.select("error").unionByName(again)
    missing, extra = expected.join(seen, "case_id", "left_anti"), seen.join(expected, "case_id", "left_anti")
    n_missing, n_extra, n_errors = missing.count(), extra.count(), errors.count()
    lines = _few(errors, "error", SHOWN_ERRORS)
    if n_missing and require_complete:
        lines.append(f"missing {n_missing} expected case ids; first {SHOWN_IDS}: {_few(missing, 'case_id', SHOWN_IDS)}")
    if n_extra:
        lines.append(f"contains {n_extra} unexpected case ids; first {SHOWN_IDS}: {_few(extra, 'case_id', SHOWN_IDS)}")
    if lines:
        print("\n".join(lines), file=sys.stderr)
        if n_errors > SHOWN_ERRORS:
            print(f"... and {n_errors - SHOWN_ERRORS} more errors", file=sys.stderr)
        return 2
    print(f"Valid submission records: {raw.count()}\nMissing expected case ids: {n_missing}")
    return 0


def main(args: list[str]) -> int:
    parser = argparse.ArgumentParser(prog="packetry.jobs")
    commands = parser.add_subparsers(dest="command", required=True)
    e = commands.add_parser("evaluate")
    for a in ("--truth", "--submission"):
        e.add_argument(a, required=True)
    for a in ("--output-json", "--case-scores-jsonl"):
        e.add_argument(a)
    c = commands.add_parser("validate")
    c.add_argument("--submission", required=True)
    for a in ("--manifest", "--pdf-dir"):
        c.add_argument(a)
    c.add_argument("--require-complete", action="store_true")
    given = parser.parse_args(args)
    spark = SparkSession.getActiveSession() or (SparkSession.builder.getOrCreate() if os.environ.get("SPARK_ENV_LOADED") else session())
    if given.command == "evaluate":
        return evaluate(spark, given.truth, given.submission, given.output_json, given.case_scores_jsonl)
    return validate(spark, given.submission, given.manifest, given.pdf_dir, given.require_complete)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
