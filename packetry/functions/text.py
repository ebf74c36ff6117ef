"""Scalar text predicates shared by the operators, as Catalyst expressions and as Python twins for Arrow code."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Writings that mean "no value here".
ABSENT_WORDS = ("n/a", "na", "n.a.", "null", "nil", "nan", "(blank)", "blank", "not legible", "tbd", "t.b.d.", "tba", "tbc", "unknown", "pending entry", "pending", "as before?", "as before", "see photo", "see above", "see below", "see file", "see scan", "empty", "left blank", "withheld", "omitted")
#: What may stand before or after the word that tells of a lost value, so that a name like "Hidden Harbor" is none.
_NOUN = r"(?:the|this|name|applicant|species|home|world|purpose|visa|class|status|fee|receipt|sponsor|letter|date|arrival|entry|field|value|cell|panel|page|text|line|print|writing|is|was|has|been|are|were|here|now|too|fully|partly|badly|by|water|fire|ink)"
_LOST = r"(?:(?:not |un|il|in)?(?:legible|readable|decipherable)|blotted|smeared|smudged|burnt|burned|erased|torn|hidden|covered|obscured|faded|stained|washed out|cut out|whited out|blacked out|redacted|destroyed|damaged|lost|missing|illegible|unreadable)"
_NEVER = r"(?:(?:not|never|none|nothing|no) (?:yet )?(?:given|stated|provided|supplied|recorded|entered|declared|specified|disclosed|available|known|found|filled in|filled|shown|present|entry|value|data|answer|record|information)|to be (?:advised|announced|confirmed|determined|decided|given|supplied)|pending entry|see photo|awaiting (?:entry|papers|data))"
#: A whole cell that tells that its value was destroyed or never given, with nothing else in it but words for the cell itself.
DAMAGE = rf"^[^a-z0-9]*(?:{_NOUN}[ :._-]+)*(?:{_LOST}|{_NEVER})(?:[ ,._-]+{_NOUN})*[^a-z0-9]*$"
#: Nothing but marks, or the opening or closing bracket of a damage note.
_MARKS = r"^[\s?\-–—.*_#]*$"
#: Words that say a flag cell holds no flag.
NO_FLAG = ("none", "no flags", "no flag", "nil", "n/a", "na", "null", "-", "--", "", "?", "???", "(blank)", "not given", "unknown")


def bind(c: Column, f: Callable[[Column], Column]) -> Column:
    """f(c) with c as a bound variable: it is worked out once and stands once in the plan, however often f reads it."""
    return F.get(F.transform(F.array(c), f), F.lit(0))


def strip(c: Column) -> Column:
    """Blanks, tabs, breaks and no-break spaces off both ends."""
    return F.regexp_replace(c, r"^[\s\u00a0]+|[\s\u00a0]+$", "")


def blank(c: Column) -> Column:
    """True where the cell holds nothing, marks only, or a word for "no value": what can never be an entry of a vocabulary."""
    t = F.lower(strip(c))
    return F.coalesce(t.rlike(_MARKS) | t.isin(*ABSENT_WORDS), F.lit(True))


def absent(c: Column) -> Column:
    """True where the cell carries no value of its field, in whatever writing (null included)."""
    t = F.lower(strip(c))
    return F.coalesce(t.rlike(_MARKS) | t.isin(*ABSENT_WORDS) | t.rlike(r"^\[") | t.rlike(r"\]$") | t.rlike(DAMAGE), F.lit(True))


def is_absent(v: str | None) -> bool:
    """Python twin of absent()."""
    if v is None:
        return True
    t = v.strip().lower()
    return bool(re.match(_MARKS, t)) or t in ABSENT_WORDS or t.startswith("[") or t.endswith("]") or bool(re.search(DAMAGE, t))


def fold(s: str) -> str:
    """Lower case without accents, one blank between words."""
    s = "".join(ch for ch in unicodedata.normalize("NFKD", s) if not unicodedata.combining(ch))
    return " ".join(s.casefold().split())


def canon(c: Column) -> Column:
    """Lower-case letters and digits only."""
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def ocr_fold(c: Column) -> Column:
    """Characters that scans confuse, mapped to one of them."""
    return F.translate(F.replace(c, F.lit("rn"), F.lit("m")), "0158q", "olsbo")


def valid_iso_date(c: Column) -> Column:
    """True for a calendar date written exactly yyyy-MM-dd; null gives False."""
    shaped = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z")
    return F.coalesce(shaped & F.when(shaped, F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull()), F.lit(False))


def well_formed_sponsor(c: Column) -> Column:
    """True for SPN- and exactly four ASCII digits; null gives False."""
    return F.coalesce(c.rlike(r"^SPN-[0-9]{4}\z"), F.lit(False))
