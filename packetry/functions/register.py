"""The scalar functions under SQL names, and a table function that splits texts into lines."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

# SQL bodies; they inline into the plan and stay in the JVM.
SQL_FUNCTIONS = {
    "canon(s STRING)": ("STRING", "regexp_replace(lower(s), '[^a-z0-9]', '')"),
    "ocr_fold(s STRING)": ("STRING", "translate(replace(s, 'rn', 'm'), '0158q', 'olsbo')"),
    "normalize_text(s STRING)": ("STRING", "lower(trim(regexp_replace(coalesce(s, ''), '\\\\s+', ' ')))"),
    "visa_normalize(s STRING)": ("STRING", "replace(regexp_replace(upper(s), '(?<=[A-Z])[.,_ ](?=[0-9])', '-'), ' ', '')"),
    "capped_distance(a STRING, b STRING, cap INT)": ("INT", "CASE WHEN levenshtein(a, b, cap) < 0 THEN cap + 1 ELSE levenshtein(a, b, cap) END"),
    "is_sponsor_id(s STRING)": ("BOOLEAN", "coalesce(s RLIKE '^SPN-[0-9]{4}\\\\z', false)"),
    "is_iso_date(s STRING)": ("BOOLEAN", "coalesce(s RLIKE '^[0-9]{4}-[0-9]{2}-[0-9]{2}\\\\z' AND try_to_timestamp(s, 'yyyy-MM-dd') IS NOT NULL, false)"),
}


@udtf(returnType="line_no int, text string")
class SplitLines:
    """Lines of a text, numbered from 1; nothing for a null text."""

    def eval(self, text: str) -> Iterator[tuple[int, str]]:
        if text is not None:
            yield from enumerate(text.split("\n"), 1)


def register(spark: SparkSession) -> None:
    """Create the temporary functions of the session."""
    for head, (kind, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURNS {kind} RETURN {body}")
    spark.udtf.register("split_lines", SplitLines)
