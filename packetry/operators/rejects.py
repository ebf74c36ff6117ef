"""Rows that fail to parse: structural checks per line, and a dictionary of invalid values joined back.

Each line is checked for sound quoting and its number of fields by possessive regular expressions in the JVM (one pass,
no recursion, so line length is no limit). Each distinct value of a checked column is cast once; the failing ones form a
dictionary with reasons, which is far smaller than the data and is joined back to the lines.

Defined results: a null line has unsound structure (reason column_count, it has no field at all); an empty line is one empty
field; repeated lines each get their own reasons; header lines (line_no 1) are never data; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.text import valid_iso_date, well_formed_sponsor
from packetry.runtime import lookup_join, small_side

# The columns of a submission line, in order.
FIELDS = ("case_id", "applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "adjudication", "confidence")
FEE_WORDS = ("paid", "waived", "unpaid", "unknown")

_FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
_SOUND = rf"^(?:,{_FIELD})++\z"


def plain_share(c: Column) -> Column:
    """True for a plain decimal number from 0 to 1 (digits, at most one point, no sign or exponent)."""
    shaped = c.rlike(r"^[0-9]+(\.[0-9]+)?\z")
    return F.coalesce(shaped & F.when(shaped, c.cast("double") <= 1), F.lit(False))


#: Checked column to the expression that is true for its valid values.
CHECKS = {
    "sponsor_id": well_formed_sponsor,
    "arrival_date": valid_iso_date,
    "fee_status": lambda c: F.coalesce(c.isin(*FEE_WORDS), F.lit(False)),
    "confidence": plain_share,
}


def parse(lines: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Lines with structure (null, quoting or column_count) and f, the unquoted fields of a sound line."""
    marked = F.concat(F.lit(","), F.col("raw_text"))
    raw = F.regexp_extract_all(marked, F.lit(rf",({_FIELD})"), F.lit(1))
    bare = F.transform(raw, lambda x: F.when(x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x))
    rows = lines.select("line_id", "raw_text", "line_no").where(F.coalesce(F.col("line_no"), F.lit(0)) != 1)
    rows = rows.withColumn("sound", F.coalesce(marked.rlike(_SOUND), F.col("raw_text").isNull()))
    rows = rows.withColumn("f", F.when(F.col("sound") & F.col("raw_text").isNotNull(), bare))
    structure = F.when(~F.col("sound"), "quoting").when(F.coalesce(F.size("f"), F.lit(-1)) != len(fields), "column_count")
    return rows.select("line_id", structure.alias("structure"), "f")


def invalid_values(cells: DataFrame) -> DataFrame:
    """(field, value, reason) of every distinct invalid value in cells(field, value); each is cast once."""
    distinct = cells.select("field", "value").distinct()
    valid = F.lit(False)
    for name, check in CHECKS.items():
        valid = F.when(F.col("field") == name, check(F.col("value"))).otherwise(valid)
    return distinct.where(~valid).withColumn("reason", F.col("field"))


def checked_cells(parsed: DataFrame) -> DataFrame:
    """One row (line_id, field, value) per checked field of each line of sound structure."""
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.get("f", F.lit(FIELDS.index(n))).alias("value")) for n in CHECKS])
    return parsed.where("structure is null").select("line_id", F.inline(pairs))


def rejects(lines: DataFrame) -> DataFrame:
    """One row (line_id, reason) per rejected line and reason."""
    parsed = parse(lines)
    cells = checked_cells(parsed)
    bad = lookup_join(cells, invalid_values(cells), ["field", "value"])
    return parsed.where("structure is not null").select("line_id", F.col("structure").alias("reason")).unionByName(bad.select("line_id", "reason"))


def accepted(lines: DataFrame) -> DataFrame:
    """All lines that are rejected for no reason, as typed rows: those none of whose values is in the dictionary of invalid ones."""
    rows = parse(lines).where(F.col("structure").isNull())
    wrong, small = small_side(invalid_values(checked_cells(rows)).select("field", "value"))
    for name in CHECKS:
        one = wrong.where(F.col("field") == name).select(F.col("value").alias("_bad"))
        rows = rows.withColumn("_v", F.get("f", F.lit(FIELDS.index(name)))).join(F.broadcast(one) if small else one, F.col("_v").eqNullSafe(F.col("_bad")), "left_anti")
    typed = {"arrival_date": "date", "confidence": "double"}
    return rows.select("line_id", *[F.get("f", F.lit(i)).cast(typed.get(n, "string")).alias(n) for i, n in enumerate(FIELDS)])
