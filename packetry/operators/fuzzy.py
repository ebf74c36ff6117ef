"""Closed-vocabulary correction and fuzzy line predicates, row-local over literal vocabularies (no join, no shuffle)."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.text import bind, canon, ocr_fold
from packetry.runtime import lookup_join

# Damage phrases and words.
DAMAGE_PHRASES = ("name cut out", "species whiteout", "risk panel missing", "date washed out", "visa class torn", "registry lost", "purpose illegible", "sponsor id blank", "unreadable")
DAMAGE_WORDS = r"(?i)\b(unreadable|illegible|washed\s*out|whiteout|cut\s*out|torn|redacted|corrupt|registry\s*lost|missing)\b"
PLACEHOLDERS = ("passport image", "registry image", "scan image", "primary intake record", "mib eyes only", "sample denial", "n/a")
NOTE_LABELS = ("adjudicator", "finding")
ANCHOR_WORDS = ("observed", "flags", "biometric")
#: Entries of a vocabulary that a plan may hold; larger ones are refused.
MAX_VOCABULARY = 5000
#: Up to so many entries a value is first searched for their pieces.
FEW = 64


def _c(s: str) -> str:
    return "".join(ch for ch in s.lower() if ch in "abcdefghijklmnopqrstuvwxyz0123456789")


def _f(s: str) -> str:
    return s.replace("rn", "m").translate(str.maketrans("0158q", "olsbo"))


def _pieces(token: str, cap: int) -> list[str]:
    """cap + 1 pieces of a token; what is within cap edits of it holds one of them unharmed."""
    at = [len(token) * i // (cap + 1) for i in range(cap + 2)]
    return [token[a:b] for a, b in zip(at, at[1:])]


def _literal(value, kind: str) -> Column:
    """A list or map as one text that is folded to a literal, so that a plan is as small for many entries as for few."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _entries(rows: list[tuple], names: str) -> Column:
    """A closed list as one literal array of structs, so that a plan grows with what is asked of an entry and not with their number."""
    kinds = ", ".join(f"{n}: {'int' if isinstance(x, int) else 'string'}" for n, x in zip(names.split(), rows[0]))
    return _literal([dict(zip(names.split(), r)) for r in rows], f"array<struct<{kinds}>>")


def _exact(pairs: list[tuple[str, str]]) -> Column:
    return _literal(dict(pairs), "map<string,string>")


def one_of(c: Column, values: list[str]) -> Column:
    """isin() over a closed list of any size."""
    return F.array_contains(_literal(list(values), "array<string>"), c)


def vocabulary_correct(c: Column, vocabulary: list[str], max_ratio: float = 0.34) -> Column:
    """The one entry nearest to a value over plain or scan-folded letters, within max_ratio of its length; null if none or tied."""
    if not vocabulary:
        return F.lit(None).cast("string")
    rows = [(p := _c(v), f := _f(p), cap := max(1, int(len(p) * max_ratio)), min(len(p), len(f)) - cap, max(len(p), len(f)) + cap, v) for v in vocabulary]
    entries = _entries(rows, "plain folded cap lo hi v")
    whole = all(len(x) > r[2] for r in rows for x in r[:2])
    pieces = {name: "|".join(sorted({x for r in rows for x in _pieces(r[i], r[2])})) for i, name in ((0, "plain"), (1, "folded"))} if whole and len(rows) <= FEW else None

    def nearest(plain: Column, folded: Column) -> Column:
        def cost(e: Column) -> Column:
            ds = [F.call_function("levenshtein", k, e[name], e["cap"]) for k, name in ((plain, "plain"), (folded, "folded"))]
            return F.struct(F.least(*[F.when(x >= 0, x).otherwise(99) for x in ds]).alias("d"), e["v"].alias("v"))

        # Entries with more letters too many or too few than edits are allowed need no comparison.
        near = bind(F.struct(F.length(plain).alias("most"), F.length(folded).alias("least")), lambda n: F.filter(entries, lambda e: (n["most"] >= e["lo"]) & (n["least"] <= e["hi"])))
        ranked = F.sort_array(F.filter(F.transform(near, cost), lambda s: s["d"] < 99))
        best = bind(ranked, lambda r: F.when(F.get(r, F.lit(1)).isNull() | (F.get(r, F.lit(1))["d"] > F.get(r, F.lit(0))["d"]), F.get(r, F.lit(0))["v"]))
        return F.when(plain.rlike(pieces["plain"]) | folded.rlike(pieces["folded"]), best) if pieces else best

    return bind(canon(c), lambda k: F.when(k != "", bind(ocr_fold(k), lambda folded: nearest(k, folded))))


def correct_field(c: Column, vocabulary: list[str], strict: bool = False, max_ratio: float = 0.34, guarded: list[str] = ()) -> Column:
    """Exact entry by letters and digits, else (unless strict) the corrected one, else the value itself.

    A guarded entry is taken only within one edit of the scan-folded letters.
    """
    exact = _exact([(_c(v), v) for v in sorted(vocabulary, reverse=True)])  # of entries with the same letters the first by name

    def fixed(x: Column) -> Column:
        near = vocabulary_correct(x, vocabulary, max_ratio)
        if not guarded:
            return near
        letters = _exact([(g, _f(_c(g))) for g in dict.fromkeys(guarded)])
        return bind(near, lambda y: F.when(F.levenshtein(ocr_fold(canon(x)), F.try_element_at(letters, y), 1) < 0, F.lit(None)).otherwise(y))

    return bind(c, lambda x: F.coalesce(F.try_element_at(exact, canon(x)), *([] if strict else [fixed(x)]), x))


def corrected(df: DataFrame, column: str, vocabulary: list[str], out: str = "value", strict: bool = False, max_ratio: float = 0.34) -> DataFrame:
    """df with the corrected field in a new column. Each distinct value is compared with the vocabulary once and joined back."""
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY} entries is not a closed list")
    key = df.select(F.col(f"`{column}`").alias("_v")).where("_v is not null").distinct()
    fixed = key.select("_v", correct_field(F.col("_v"), vocabulary, strict, max_ratio).alias(out))
    return lookup_join(df.withColumn("_v", F.col(f"`{column}`")), fixed, ["_v"], "left").drop("_v")


def token_nearest(c: Column, vocabulary: list[str], reach: int = 2) -> Column:
    """The strictly nearest entry within reach edits of a token (case ignored), else the token."""
    if len(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"a vocabulary of more than {MAX_VOCABULARY} entries is not a closed list")
    low = F.lower(c)
    costs = F.array(*[F.struct(F.levenshtein(low, F.lit(v.lower()), reach).alias("d"), F.lit(v).alias("v")) for v in vocabulary])
    ranked = F.array_sort(F.filter(costs, lambda s: s["d"] >= 0))
    first, second = F.get(ranked, F.lit(0)), F.get(ranked, F.lit(1))
    return F.coalesce(F.when(second.isNull() | (second["d"] > first["d"]), first["v"]), c)


def damaged(c: Column) -> Column:
    """A value that tells of its own destruction: brackets, damage words, or a damage phrase within two edits."""
    phrases = _literal([_c(p) for p in DAMAGE_PHRASES], "array<string>")
    least, most = (f(len(_c(p)) for p in DAMAGE_PHRASES) for f in (min, max))
    pieces = "|".join(sorted({x for p in DAMAGE_PHRASES for x in _pieces(_c(p), 2)}))
    phrase = lambda k: F.length(k).between(least - 2, most + 2) & k.rlike(pieces) & F.exists(phrases, lambda p: F.levenshtein(k, p, 2) >= 0)
    told = lambda t: t.startswith("[") | t.endswith("]") | t.rlike(DAMAGE_WORDS) | ((F.length(t) >= least - 2) & F.exists(F.array(canon(t)), phrase))
    return F.coalesce(F.exists(F.array(F.trim(c)), told), F.lit(False))


def placeholder(c: Column) -> Column:
    """Printed matter that is never a value."""
    t = F.lower(F.trim(c))
    return F.coalesce(t.isin(*PLACEHOLDERS) | t.startswith("packet ") | t.startswith("synthetic hiring") | t.contains("sample denial"), F.lit(False))


def _within(token: str, cap: int):
    """Test of a string against token within cap edits; one of cap + 1 pieces must be in it unharmed, which is checked first."""
    pieces = "|".join(_pieces(token, cap))
    return lambda w: w.rlike(pieces) & (F.levenshtein(w, F.lit(token), cap) >= 0)


def note_like(c: Column) -> Column:
    """A text that carries a note's label, or a window of its length within 30 percent of edits."""

    def judge(k: Column) -> Column:
        out = F.lit(False)
        for token in NOTE_LABELS:
            n, cap = len(token), max(1, int(0.3 * len(token)))
            windows = F.transform(F.sequence(F.lit(1), F.greatest(F.length(k) - n + 1, F.lit(1))), lambda i: F.substr(k, i, F.lit(n)))
            out = out | k.contains(token) | ((F.length(k) >= n) & F.exists(windows, _within(token, cap)))
        return out

    # A bound variable, so that the letters are taken out once per text and not once per window.
    return F.coalesce(F.exists(F.array(canon(c)), judge), F.lit(False))


def slip_anchor(c: Column) -> Column:
    """A word of four letters or more within two edits of an anchor word."""
    words = F.filter(F.transform(F.split(c, r"\s+"), canon), lambda w: F.length(w) >= 4)
    near = lambda w: F.least(*[F.when(F.levenshtein(w, F.lit(a), 2) >= 0, 0).otherwise(1) for a in ANCHOR_WORDS]) == 0
    return F.coalesce(F.exists(words, near), F.lit(False))


def label_line_value(c: Column, first: str = "observed", second: str = "flags") -> Column:
    """Rest of a line whose first two words are within three and two edits of the label; null otherwise."""
    words = F.split(F.trim(c), r"\s+")
    w1, w2 = canon(F.get(words, F.lit(0))), canon(F.get(words, F.lit(1)))
    hit = (w1 != "") & (w2 != "") & (F.levenshtein(w1, F.lit(first), 3) >= 0) & (F.levenshtein(w2, F.lit(second), 2) >= 0)
    return F.when(hit, F.array_join(F.slice(words, 3, 10_000), " "))


def contained_flags(c: Column, flags: list[str]) -> Column:
    """Known flags that stand anywhere in a text, blanks and underscores alike, sorted."""
    found = lambda t: F.filter(_literal(sorted(flags), "array<string>"), lambda f: t.contains(f))
    joined = lambda k: F.when(F.size(k) == 0, "none").otherwise(F.array_join(k, "|"))
    return bind(F.regexp_replace(F.lower(c), r"[\s_]+", "_"), lambda t: F.when(t.isNull(), "none").otherwise(bind(found(t), joined)))


def correct_flag_tokens(c: Column, flags: list[str], strict: bool = False) -> Column:
    """Each token exact or corrected at half its length; other tokens stay only if strict and written with underscores."""
    tokens = F.filter(F.split(F.lower(c), r"\s*[|,]\s*"), lambda t: (F.trim(t) != "") & (F.trim(t) != "none"))

    def one(t: Column) -> Column:
        t = F.trim(t)
        kept = F.when(t.rlike("^[a-z]+(_[a-z]+)+$"), t) if strict else F.lit(None).cast("string")
        return F.coalesce(F.when(one_of(t, flags), t), vocabulary_correct(t, flags, 0.5), kept)

    kept = F.array_sort(F.array_distinct(F.filter(F.transform(tokens, one), lambda x: x.isNotNull())))
    return bind(kept, lambda k: F.when(k.isNull() | (F.size(k) == 0), "none").otherwise(F.array_join(k, "|")))


def flag_votes(texts: DataFrame, key: str, text: str, flags: list[str], tight: list[str]) -> DataFrame:
    """Votes (key, flag, votes): parts of a text go to the flag with the lowest share of edits, if low or clearly ahead.

    tight flags need a share of at most 0.55, others 0.60, and 0.08 ahead of the next; 0.5 always counts.
    """
    parts = texts.select(F.col(key), F.explode(F.split(F.col(text), "[|,;/]")).alias("part"))
    k = canon(F.col("part"))
    costs = F.array_sort(F.array(*[F.struct((F.levenshtein(k, F.lit(_c(f))) / F.lit(float(len(_c(f))))).alias("d"), F.lit(f).alias("f")) for f in flags]))
    first, second = F.get(costs, F.lit(0)), F.get(costs, F.lit(1))
    cap = F.when(first["f"].isin(*tight), 0.55).otherwise(0.60)
    ok = (first["d"] <= 0.5) | ((first["d"] <= cap) & (second["d"] - first["d"] >= 0.08))
    rows = parts.where((k != "") & ~k.isin("none", "nome", "norne")).select(key, first["f"].alias("flag"), ok.alias("ok")).where("ok")
    return rows.groupBy(key, "flag").agg(F.count("*").alias("votes"))


def accepted_flags(votes: DataFrame, key: str, tight: list[str]) -> DataFrame:
    """(key, flags): flags with two votes, or one if they are not tight, as a sorted pipe list."""
    ok = votes.where((F.col("votes") >= 2) | ~F.col("flag").isin(*tight))
    return ok.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("flag")), "|").alias("flags"))


def word_family(c: Column, families: list[tuple[list[str], str]], noise: float = 0.35) -> Column:
    """The one outcome whose families of words a text holds: two words of a family within noise, or one long word that is a family alone."""
    words = F.transform(F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit(r"([A-Za-z]{4,})"), F.lit(1)), lambda w: F.lower(w))
    hits = []
    for keys, outcome in families:
        found = [_holds(words, k, noise) for k in keys]
        n = sum((x.cast("int") for x in found[1:]), found[0].cast("int"))
        ok = (n >= 2) | ((n == 1) & F.lit(len(keys) == 1 and len(keys[0]) >= 10))
        hits.append(F.when(ok, F.lit(outcome)))
    distinct = F.array_distinct(F.array_compact(F.array(*hits)))
    return F.when(F.size(distinct) == 1, F.get(distinct, F.lit(0)))


def _holds(words: Column, key: str, noise: float) -> Column:
    cap = max(1, int(noise * len(key)))
    return F.exists(words, lambda w: F.levenshtein(w, F.lit(key), cap) >= 0)
