"""Typed extraction and repair of scanned values as Catalyst expressions. Null in gives null out unless stated."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from packetry.functions.text import bind, valid_iso_date

# Letter shapes that scans give for digits, and the digits they stand for.
DIGIT_SHAPES, DIGITS = "OoQDIl|!SsBZzG", "00001111558226"
_SHAPED = r"[0-9OoQDIl|!SsBZzG]"
SPONSOR = r"\bSPN-[0-9]{3,}\b"
SPONSOR_LOOSE = rf"\bSPN[\s\-–—._]*({_SHAPED}{{4}})\b"
DATE = r"\b([0-9]{4}-[0-9]{2}-[0-9]{2})\b"
DATE_LOOSE = rf"\b({_SHAPED}{{4}})[-–—.]({_SHAPED}{{2}})[-–—.]({_SHAPED}{{2}})\b"
AMOUNT = r"\$\s*([0-9][0-9,]*\.[0-9]{2})"
CORRECTION = r"(?i)Manual correction:\s*(sponsor|visa class|applicant|fee status)\s+is\s+([^\n.]+)"


def _some(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def repair_digits(c: Column) -> Column:
    """Letters shaped like digits read as digits."""
    return F.translate(c, DIGIT_SHAPES, DIGITS)


def find_sponsor(c: Column) -> Column:
    """First sponsor id in a text: strict, else repaired from letter-shaped digits."""
    loose = repair_digits(_some(F.regexp_extract(c, SPONSOR_LOOSE, 1)))
    return F.coalesce(_some(F.regexp_extract(c, SPONSOR, 0)), F.when(loose.rlike("^[0-9]{4}$"), F.concat(F.lit("SPN-"), loose)))


def find_date(c: Column) -> Column:
    """First date in a text: strict (unchecked), else repaired if that is a calendar date."""
    parts = [repair_digits(_some(F.regexp_extract(c, DATE_LOOSE, i))) for i in (1, 2, 3)]
    loose = F.concat_ws("-", *parts)
    return F.coalesce(_some(F.regexp_extract(c, DATE, 1)), F.when(valid_iso_date(loose), loose))


def parse_date(c: Column) -> Column:
    """First ISO date anywhere as a date; null if it is no calendar date."""
    return F.to_date(F.try_to_timestamp(_some(F.regexp_extract(c, DATE, 1)), F.lit("yyyy-MM-dd")))


def clean_sponsor(c: Column) -> Column:
    """Emission form: the first well-formed id, else the repaired one, else SPN-0000."""
    strict = _some(F.regexp_extract(c, "SPN-[0-9]{4}", 0))
    return F.coalesce(strict, find_sponsor(c), F.lit("SPN-0000"))


def clean_date(c: Column) -> Column:
    """Emission form: a calendar-valid date, else the repaired one, else 1900-01-01."""
    strict = _some(F.regexp_extract(c, DATE, 1))
    found = find_date(c)
    return F.coalesce(F.when(valid_iso_date(strict), strict), F.when(valid_iso_date(found), found), F.lit("1900-01-01"))


def clean_text(c: Column) -> Column:
    """White space collapsed; unknown where nothing is left."""
    return F.coalesce(_some(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit("unknown"))


def normalize(c: Column) -> Column:
    """Trimmed, white space collapsed, lower case; null counts as empty."""
    return F.lower(F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " ")))


def _parts(c: Column, pattern: str) -> Column:
    return F.filter(F.transform(F.split(c, pattern), lambda x: F.trim(x)), lambda x: x != "")


def normalize_flags(c: Column) -> Column:
    """Sorted pipe list, not made distinct; writings of no flag give none."""
    n = normalize(c)
    return F.when(n.isin("", "none", "null", "unknown"), "none").otherwise(F.array_join(F.array_sort(_parts(n, "[|]")), "|"))


def split_pipe(c: Column) -> Column:
    """Distinct members of a pipe list; unknown is kept as a member."""
    n = normalize(c)
    return F.when(n.isin("", "none", "null"), F.array().cast("array<string>")).otherwise(F.array_sort(F.array_distinct(_parts(n, "[|]"))))


def flag_list(c: Column) -> Column:
    """Sorted distinct members of a pipe or comma list without none; none where nothing is left."""
    kept = lambda n: F.array_sort(F.array_distinct(F.filter(_parts(n, "[|,]"), lambda x: x != "none")))
    joined = lambda k: F.when(F.size(k) == 0, "none").otherwise(F.array_join(k, "|"))
    return bind(normalize(c), lambda n: F.when(n.isin("", "none", "null", "unknown", "n/a"), "none").otherwise(bind(kept(n), joined)))


def visa_normalize(c: Column) -> Column:
    """Upper case; a separator between a letter and a digit becomes a hyphen; blanks go."""
    return F.replace(F.regexp_replace(F.upper(c), r"(?<=[A-Z])[.,_ ](?=[0-9])", "-"), F.lit(" "), F.lit(""))


def capped_distance(a: Column, b: Column, cap: int = 4) -> Column:
    """Levenshtein distance, cap + 1 where it is larger."""
    d = F.levenshtein(a, b, cap)
    return F.when(d < 0, cap + 1).otherwise(d)


def amount(c: Column) -> Column:
    """First dollar amount without thousands separators."""
    return _some(F.replace(F.regexp_extract(c, AMOUNT, 1), F.lit(","), F.lit(""))).cast("decimal(14,2)")


def first_two_words(c: Column) -> Column:
    """Names of more than two words cut to two, unless they start with unknown."""
    words = F.split(F.trim(F.regexp_replace(c, r"\s+", " ")), " ")
    return F.when((F.size(words) > 2) & (F.lower(F.get(words, F.lit(0))) != "unknown"), F.array_join(F.slice(words, 1, 2), " ")).otherwise(c)


def prefix_truncate(c: Column, vocabulary: list[str]) -> Column:
    """The entry that is a proper prefix of the value followed by no letter or digit, else the value."""
    hit = lambda v: (F.length(c) > len(v)) & F.lower(c).startswith(v.lower()) & ~F.substring(c, len(v) + 1, 1).rlike("[A-Za-z0-9]")
    return F.coalesce(*[F.when(hit(v), F.lit(v)) for v in vocabulary], c)


def strip_trailing_junk(c: Column) -> Column:
    """Characters after the last letter or closing bracket dropped."""
    return F.regexp_replace(c, r"[^A-Za-z)\]]+$", "")


def same_person(a: Column, b: Column) -> Column:
    """Names that scans may have made different: one holds the other, or within a third of their length (two at least)."""
    x, y = (F.regexp_replace(F.lower(v), "[^a-z0-9]", "") for v in (a, b))
    room = F.greatest(F.lit(2), F.floor(F.greatest(F.length(x), F.length(y)) * F.lit(0.34)).cast("int"))
    return x.contains(y) | y.contains(x) | (F.levenshtein(x, y) <= room)


def era_repair(c: Column, now: Column) -> Column:
    """Date whose year is off by more than one gets the year of now, if that is a calendar date."""
    other = F.to_date(F.try_to_timestamp(F.concat(F.date_format(now, "yyyy"), F.date_format(c, "-MM-dd")), F.lit("yyyy-MM-dd")))
    return F.when(F.abs(F.year(c) - F.year(now)) > 1, F.coalesce(other, c)).otherwise(c)


def corrections(c: Column) -> Column:
    """Manual corrections in a text, as an array of (field, value) in order."""
    names, values = (F.regexp_extract_all(c, F.lit(CORRECTION), F.lit(i)) for i in (1, 2))
    return F.zip_with(names, values, lambda f, v: F.struct(F.lower(f).alias("field"), F.trim(v).alias("value")))


def channels(c: Column) -> tuple[Column, Column, Column]:
    """Red, green and blue of a packed colour."""
    return tuple(F.shiftright(c, s).bitwiseAND(F.lit(255)) for s in (16, 8, 0))


def pale(c: Column) -> Column:
    """Ink too pale to be seen: every channel above 200."""
    return F.least(*channels(c)) > 200
