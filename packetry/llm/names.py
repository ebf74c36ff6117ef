"""Variant spellings of names typed by people: pigeonhole segment join, banded verification, connected components.

A written name is taken apart into a given name and a family name (titles, nicknames, commas, capitals, initials and order are
undone; known short forms and slips lead to the given name they stand for). Equal readings of equal applicants collapse into one
representative, so copies are never paired. A family name of a representative is cut into k + 1 segments; two names within k edits
share a segment, at most k places apart. Segments go into an inverted index keyed by block (species and home world), given name,
length and segment; every representative looks up its position-shifted substrings, and candidates are verified by banded edit
distance, over the letters as written and over letters that scans confuse made one. Two edits in a short name count only if neither
writing is a family name that several given names bear: a damaged writing is a rare one. Cases are linked through the components of
the representatives they show.

Index, probes and candidates are narrow rows spread by one hash of the key; a key that many representatives share is split by AQE's
skew join. What the driver holds are closed lists: short forms, nicknames, and given names in use (refused beyond MAX_LISTED).

The name of a letter counts only if it can be the applicant's: it must agree with the case's most frequent applicant name, or stand
alone in a case without conflict. A case with only an initial, or without species or home world, joins the one applicant that fits
best; such cases never connect two applicants. Those that fit none are joined among themselves.

Defined results: cells without a name, and names without a given or a family name, link nothing; rows without case are ignored;
repeated rows change nothing; names of any length are cut into the same number of segments; a case with neither species nor home
world links nothing; an empty table gives no links; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.lexicon import distance, key_of
from packetry.functions.text import absent, fold, is_absent
from packetry.llm.canonical import match_udf
from packetry.runtime import cut

#: Edits allowed in a family name, and segments it is cut into.
K = 2
#: A token is taken for a given name by usage if it opens names of so many cases, at any size of the corpus.
LEAST_OPENINGS = 5
#: A token so many times rarer than a given name within a slip of it is that name.
RARER = 5
#: Most short forms, nicknames or given names in use that are held on the driver; more are refused.
MAX_LISTED = 500_000

# Titles and endings that are no part of a name.
TITLES = {"rev", "dr", "mx", "mr", "mrs", "ms", "hon", "envoy", "esq", "jr", "sr", "ii", "iii", "iv", "prof", "sir", "capt"}

# Letters that scans run together or confuse, and what they become.
SCAN_PAIRS = (("rn", "m"), ("ri", "n"), ("cl", "d"), ("vv", "w"))
SCAN_LETTERS = ("0158ciq", "olsbelg")

#: A given name with a nickname after it; possessive and anchored at word starts, so that long words take linear time.
_NICK = r'(?<!\p{L})(\p{L}++)\s+["(](\p{L}++)[")]'

STRONG, RAW, WEAK = 0, 1, 2
FORM = "given string, family string, kind int, parts array<string>"


def _letters(s: str) -> str:
    return "".join(ch for ch in s if ch.isalnum())


def _deletions(s: str, n: int) -> set[str]:
    out = {s}
    for _ in range(n):
        out |= {x[:i] + x[i + 1 :] for x in out for i in range(len(x))}
    return out


def scan_fold(s: str) -> str:
    """Letters with those that scans confuse made one."""
    for a, b in SCAN_PAIRS:
        s = s.replace(a, b)
    return s.translate(str.maketrans(*SCAN_LETTERS))


def _scan_fold(c: Column) -> Column:
    for a, b in SCAN_PAIRS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.translate(c, *SCAN_LETTERS)


def _edits(token: str) -> int:
    return 2 if len(token) >= 7 else 1


class Givens:
    """Given names by usage and by the list of short forms; finds the given names a token stands for."""

    def __init__(self, listed: list[tuple[str, str]], usage: list[tuple[str, int]], nicknames: list[tuple[str, str]]):
        self.short: dict[str, set[str]] = {}
        self.names: dict[str, int] = {}
        self.index: dict[str, set[str]] = {}
        self.scans: dict[str, set[str]] = {}
        plain = lambda pairs: [(g, s) for g, s in ((_letters(fold(a or "")), _letters(fold(b or ""))) for a, b in pairs) if g]
        used: Counter[str] = Counter()
        for token, n in usage:
            used[token] += n
        for g, s in plain(listed):
            self.names.setdefault(g, used[g])
            if s and g != s:
                self.short.setdefault(s, set()).add(g)
        for g in self.names:
            self._add(g)
        shown = {s for _, s in plain(nicknames) if s} | set(self.short)
        near_shown: dict[str, set[str]] = {}
        for s in shown:
            for key in (*_deletions(s, 1), scan_fold(s)):
                near_shown.setdefault(key, set()).add(s)
        for token, n in sorted(used.items(), key=lambda x: (-x[1], x[0])):
            if token in self.names or token in shown or len(token) < 3:
                continue
            like = self._near(token).union(*(near_shown.get(d, ()) for d in _deletions(token, 1)))
            like = {g for g in like if distance(token, g, 1) <= 1} | self.scans.get(scan_fold(token), set()) | near_shown.get(scan_fold(token), set())
            if any(used[g] >= RARER * n for g in like):
                continue  # a slip that occurs often
            self.names[token] = n
            self._add(token)
        self.longest = max(map(len, self.names), default=0)
        for g, s in plain(nicknames):  # a slip of a given name shows the nickname of that name
            owner = [g] if g in self.names else self.meant(g)
            if s and len(owner) == 1 and owner[0] != s:
                self.short.setdefault(s, set()).add(owner[0])
        for s, of in self.short.items():
            if len(s) >= 4 and len(of) == 1 and s not in self.names:
                self.scans.setdefault(scan_fold(s), set()).add(s)
                for d in _deletions(s, 1):
                    self.index.setdefault(d, set()).add(s)
        self.ordered = sorted(self.names)
        self.longest = max(map(len, [*self.names, *self.short]), default=0)

    def _add(self, g: str) -> None:
        self.scans.setdefault(scan_fold(g), set()).add(g)
        for d in _deletions(g, _edits(g)):
            self.index.setdefault(d, set()).add(g)

    def _near(self, token: str) -> set[str]:
        return set().union(*(self.index.get(d, ()) for d in _deletions(token, _edits(token))))

    def starting(self, prefix: str) -> list[str]:
        i = bisect_left(self.ordered, prefix)
        out = []
        while i < len(self.ordered) and self.ordered[i].startswith(prefix):
            out.append(self.ordered[i])
            i += 1
        return out

    def meant(self, token: str) -> list[str]:
        """Given names a whole token stands for: itself, those it is short for, or the nearest ones within a slip or two."""
        if token in self.names:
            return [token]
        if token in self.short:
            return sorted(self.short[token])
        if len(token) < 3 or len(token) > self.longest + 2:  # longer ones are near none
            return []
        near: dict[int, set[str]] = {}
        if scans := self.scans.get(scan_fold(token)):
            near[1] = set(scans)
        for g in self._near(token):
            d = distance(token, g, _edits(g))
            if d <= _edits(g):
                near.setdefault(d, set()).add(g)
        return sorted({x for g in near[min(near)] for x in ([g] if g in self.names else self.short[g])}) if near else []


def _tokens(name: str) -> tuple[list[str], list[str], list[str]]:
    """(tokens before a comma, tokens after it, nicknames), without titles, as written apart from accents."""
    nick = [m.group(1) or m.group(2) for m in re.finditer(r'"([^"]*)"|\(([^)]*)\)', name)]
    bare = re.sub(r'"[^"]*"|\([^)]*\)', " ", name)
    sides = [[t for t in side.split() if _letters(fold(t)) and _letters(fold(t)) not in TITLES] for side in bare.split(",", 1)]
    before, after = sides[0], sides[1] if len(sides) > 1 else []
    return before, after, nick


class Reader:
    """Takes names apart."""

    def __init__(self, givens: Givens):
        self.givens = givens
        self.memo: dict[str, list[tuple]] = {}

    def _weight(self, token: str) -> int:
        """How much a token looks like a given name."""
        t = _letters(fold(token))
        if "-" in token:
            return -1
        if t in self.givens.names or t in self.givens.short:
            return 3
        if len(t) == 1 or token.endswith("."):
            return 2
        return 1 if self.givens.meant(t) else 0

    def _sides(self, tokens: list[str]) -> tuple[str, list[str]]:
        """Given name and family name of tokens without a comma, in either order, with or without middle names."""
        capitals = [t for t in tokens if t.isupper() and len(_letters(t)) > 2]
        plain = [t for t in tokens if not t.isupper()]
        if capitals and plain:
            return plain[0], capitals
        first = self._weight(tokens[0])
        if len(tokens) == 2 and first == 3:  # nothing comes before a known given name in front
            return tokens[0], tokens[1:]
        weight = [first, *(self._weight(t) for t in tokens[1:])]
        like = [w > 0 for w in weight]
        if all(like) and weight[-1] > weight[0]:  # a family name that is near a given name
            at = weight.index(max(weight))
            return tokens[at], tokens[:at]
        if like[0] and "-" in tokens[-1].strip("-"):  # a hyphenated family name is whole
            return tokens[0], tokens[-1:]
        if like[0]:  # Given Middle Family
            at = len(tokens)
            while at > 1 and not like[at - 1]:
                at -= 1
            return tokens[0], tokens[at:] or tokens[-1:]
        if any(like):  # Family Given Middle
            at = like.index(True)
            return tokens[at], tokens[:at]
        return tokens[0], tokens[-1:]

    def forms(self, name: str | None) -> list[tuple[str, str, int, list[str]]]:
        """(given, family, kind, parts of a double family name) of every reading of a name."""
        if name is None or is_absent(name):
            return []
        if name in self.memo:
            return self.memo[name]
        before, after, nick = _tokens(name)
        if before and after:
            family, given = before, after[0]
        elif len(tokens := before or after) < 2:
            return []
        else:
            given, family = self._sides(tokens)
        words = [w for t in family for w in re.split(r"[-–]", fold(t)) if _letters(w)]
        words = [_letters(w) for w in words]
        fam, g = "".join(words), _letters(fold(given))
        if not fam or not g:
            return []
        # A hyphenated name is shortened to its first part; of loose words any may be the family name.
        parts = [] if len(words) < 2 else words[:1] if len(family) == 1 else words
        if len(g) == 1:
            out = [(g, fam, WEAK, parts)]
        elif given.rstrip(",").endswith(".") and g not in self.givens.names:
            full = self.givens.starting(g) or self.givens.meant(g)
            out = [(full[0], fam, STRONG, parts)] if len(full) == 1 else [(g, fam, WEAK, parts)]
        else:
            full = self.givens.meant(g)
            out = [(x, fam, STRONG, parts) for x in full] or [(g, fam, RAW, parts)]
        if out[0][2] == WEAK:  # a nickname beside an initial still tells the given name
            told = [x for n in nick for x in self.givens.meant(_letters(fold(n))) if x[0] == g[0]]
            out = [(x, fam, STRONG, parts) for x in dict.fromkeys(told)] or out
        if len(self.memo) < 100_000:
            self.memo[name] = out
        return out


def _listed(df: DataFrame) -> list[tuple]:
    """Rows of a closed list; one beyond MAX_LISTED is refused."""
    rows = [tuple(r) for r in df.limit(MAX_LISTED + 1).collect()]
    if len(rows) > MAX_LISTED:
        raise ValueError(f"a list of more than {MAX_LISTED} names is not held on the driver")
    return rows


def learn(names: DataFrame, aliases: DataFrame) -> tuple:
    """What Givens needs: the listed short forms, opening tokens by usage, and nicknames that names show beside the given name.

    Counts are over all distinct (case, name).
    """
    listed = _listed(aliases.select("given_name", "short_name").where("given_name is not null").distinct())
    plain = names.where(~F.col("name").contains(","))
    bare = F.regexp_replace(F.lower("name"), r'"[^"]*"|\([^)]*\)', " ")
    bare = F.regexp_replace(bare, r"(^|\s)(" + "|".join(sorted(TITLES)) + r")[.]?(?=\s|$)", " ")
    words = F.filter(F.split(F.trim(bare), r"\s+"), lambda w: (F.length(w) > 0) & ~w.endswith("."))
    ends = plain.select("case_id", words.alias("w")).where(F.size("w") >= 2)
    place = lambda at, opens: F.struct(at.alias("token"), F.lit(opens).alias("opens"), F.lit(1 - opens).alias("closes"))
    tokens = ends.select("case_id", F.inline(F.array(place(F.get("w", F.lit(0)), 1), place(F.element_at("w", -1), 0))))
    tokens = tokens.groupBy("token", "case_id").agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"))
    used = tokens.groupBy("token").agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"), F.count_if(F.col("opens") > 0).alias("cases"))
    used = used.where((F.col("cases") >= LEAST_OPENINGS) & (F.col("opens") > 2 * F.col("closes")))
    usage = [(_letters(fold(t)), n) for t, n in _listed(used.select("token", "opens"))]
    nick = names.select(F.regexp_extract("name", _NICK, 1).alias("g"), F.regexp_extract("name", _NICK, 2).alias("s"))
    nick = nick.where("length(g) > 2 and length(s) > 1 and lower(s) <> 'applicant'").groupBy(F.lower("g").alias("g"), F.lower("s").alias("s")).agg(F.count("*").alias("n")).where("n >= 2")
    known = {t for t, _ in usage} | {_letters(fold(g)) for g, _ in listed}
    return listed, usage, sorted((g, s) for g, s in _listed(nick.select("g", "s")) if _letters(fold(g)) in known)


def forms_udf(learned: tuple):
    """Arrow UDF from a written name to its forms; distinct names of a batch are read once."""
    box: list[Reader] = []

    @F.pandas_udf(f"array<struct<{FORM.replace(' ', ':').replace(',:', ',')}>>")
    def forms(names: pd.Series) -> pd.Series:
        if not box:
            box.append(Reader(Givens(*learned)))
        codes, distinct = pd.factorize(names)
        done = [[dict(zip(("given", "family", "kind", "parts"), f)) for f in box[0].forms(n)] for n in distinct]
        return pd.Series([done[c] if c >= 0 else [] for c in codes])

    return forms


def key_udf():
    """Arrow UDF: letters and digits of a value that no entry covers."""

    @F.pandas_udf("string")
    def key(values: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(values)
        done = [key_of(v) for v in distinct]
        return pd.Series([done[c] if c >= 0 else None for c in codes], dtype="object")

    return key


def case_attributes(records: DataFrame, lexicon_rows: list[tuple]) -> DataFrame:
    """(case_id, species, world): the most frequent entry ("e:" and its id) or unlisted value ("r:" and its letters), null if none."""
    cells = []
    for f in ("species_code", "home_world"):
        c = F.col(f)
        names = [x for e, field, canonical, *_ in lexicon_rows if field == f for x in (F.lit(canonical), F.lit(int(e)))]
        known = F.try_element_at(F.create_map(*names), c).cast("int") if names else F.lit(None).cast("int")
        entry = F.nullif(F.coalesce(known, match_udf(lexicon_rows, f)(F.when(known.isNull() & ~absent(c), c))), F.lit(0))
        cells.append(F.struct(F.lit(f).alias("field"), entry.alias("entry"), F.when(entry.isNull() & ~absent(c), c).alias("odd")))
    rows = records.where("case_id is not null").select("case_id", F.inline(F.array(*cells))).where("entry is not null or odd is not null")
    value = F.when(F.col("entry").isNotNull(), F.concat(F.lit("e:"), F.col("entry").cast("string"))).otherwise(F.concat(F.lit("r:"), key_udf()("odd")))
    counts = rows.groupBy("case_id", "field", value.alias("v")).agg(F.count("*").alias("n")).where("v is not null")
    top = counts.groupBy("case_id", "field").agg(F.max_by("v", F.struct("n", "v")).alias("v"))
    return top.groupBy("case_id").agg(F.max(F.when(F.col("field") == "species_code", F.col("v"))).alias("species"), F.max(F.when(F.col("field") == "home_world", F.col("v"))).alias("world"))


def near(a: Column, b: Column, long: int = 10) -> Column:
    """Names within the edits their length allows (banded Levenshtein): two from long letters on, one below or a swap of two letters."""
    shortest = F.least(F.length(a), F.length(b))
    edits = F.levenshtein(a, b, K)
    swapped = F.array_sort(F.split(a, "")) == F.array_sort(F.split(b, ""))
    return F.when(shortest >= long, edits >= 0).when(shortest >= 4, edits.isin(0, 1) | ((edits == 2) & swapped)).otherwise(a == b)


def alike(a: Column, b: Column, rare: Column) -> Column:
    """Family names that can be one: near as written or as scans read them, or, if rare, within k edits from five letters on."""
    short = rare & (F.least(F.length(a), F.length(b)) >= 5) & (F.levenshtein(a, b, K) >= 0)
    return near(a, b) | short | near(_scan_fold(a), _scan_fold(b))


def _agree(a: Column, b: Column) -> Column:
    """Attributes that can be the same: equal, unlisted ones within two edits, or one of them unknown."""
    odd = a.startswith("r:") & b.startswith("r:") & (F.levenshtein(a, b, 2) >= 0)
    return a.isNull() | b.isNull() | (a == b) | odd


def _bound(size: Column, i: Column) -> Column:
    return F.floor(size * i / (K + 1)).cast("int")


def index_rows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep and a key for each address and each of the k + 1 segments of the family name."""
    segments = F.array(*[F.struct(F.lit(i).alias("i")) for i in range(K + 1)])
    size, i = F.length("family"), F.col("i")
    out = rows.select("*", F.explode("index").alias("address")).select("*", F.inline(segments))
    segment = F.substr(F.col("family"), _bound(size, i) + 1, _bound(size, i + 1) - _bound(size, i))
    return out.select(*keep, F.xxhash64("address", size, "i", segment).alias("key"))


def probe_rows(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The columns keep and a key for each address and each position-shifted substring that a family name within k edits would share.

    Names that are indexed at the same address themselves look only for names that are not longer; the column both_ways tells the others.
    """
    ways = [(gap, i, shift) for gap in range(-K, K + 1) for i in range(K + 1) for shift in range(-K, K + 1) if abs(shift) + abs(gap - shift) <= K]
    places = F.array(*[F.struct(F.lit(g).alias("gap"), F.lit(i).alias("i"), F.lit(x).alias("shift")) for g, i, x in ways])
    out = rows.select("*", F.explode("probe").alias("address")).select("*", F.inline(places)).where("gap >= 0 or both_ways")
    size, i = F.length("family"), F.col("i")
    other = size - F.col("gap")
    at, n = _bound(other, i) + F.col("shift"), _bound(other, i + 1) - _bound(other, i)
    out = out.withColumns({"other": other, "at": at, "n": n}).where("other > 0 and at >= 0 and at + n <= length(family)")
    return out.select(*keep, F.xxhash64("address", "other", "i", F.substr(F.col("family"), F.col("at") + 1, F.col("n"))).alias("key"))


def _address(*parts: Column) -> Column:
    return F.xxhash64(*parts)


def _blocks(species: Column, world: Column) -> tuple[Column, Column, Column]:
    """Block keys of a representative: of both attributes, of the species and of the world; unlisted values share one key."""
    s = F.when(species.startswith("r:"), F.lit("r")).otherwise(species)
    w = F.when(world.startswith("r:"), F.lit("r")).otherwise(world)
    return F.concat(s, F.lit("|"), w), F.concat(s, F.lit("|*")), F.concat(F.lit("*|"), w)


def _firm() -> Column:
    """Representatives that link by themselves: a given name, species and home world are all known."""
    return (F.col("kind") != WEAK) & F.col("species").isNotNull() & F.col("world").isNotNull()


def _some(cond: Column, key: Column) -> Column:
    return F.when(cond, key)


def addressed(reps: DataFrame, among_loose: bool = False) -> DataFrame:
    """Representatives, and parts of their double names, with the addresses where they are indexed and where they look.

    A full given name is an address of its block; an unread or short one looks at the address of its initial. A representative that
    lacks an attribute looks in the block of the other, where all are indexed. Firm ones look for firm ones, loose ones for firm ones
    (for each other if among_loose, where full names without species also meet those without home world).
    """
    full, by_species, by_world = _blocks(F.col("species"), F.col("world"))
    has_s, has_w = F.col("species").isNotNull(), F.col("world").isNotNull()
    both, firm, weak, raw = has_s & has_w, _firm(), F.col("kind") == WEAK, F.col("kind") == RAW
    initial = F.concat(F.lit("~"), F.substring("given", 1, 1))
    own = F.when(raw, initial).otherwise(F.col("given"))
    single = F.coalesce(F.when(~has_w, by_species), by_world)
    named = lambda block, cond, g: _some(cond, _address(block, g))
    indexed = [named(full, both & ~weak, own), named(full, both, initial)]
    indexed += [named(b, has & (~weak if g is own else F.lit(True)), g) for b, has in ((by_species, has_s), (by_world, has_w)) for g in (own, initial)]
    look = [named(full, both & ~weak, own), named(full, both & weak, initial), named(single, ~both & ~weak, own), named(single, ~both & weak, initial)]
    if among_loose:  # no block has both attributes unknown
        indexed.append(named(F.lit("anywhere"), ~weak & has_s, own))
        look += [named(F.lit("anywhere"), ~weak & ~has_s, own), named(single, ~both, initial)]
    is_index = F.lit(True) if among_loose else firm
    odd = lambda c: F.when(F.col(c).startswith("r:"), F.col(c))
    rows = reps.select(
        "rep", "given", "family", "kind", "parts", "usual", odd("species").alias("species"), odd("world").alias("world"), firm.alias("firm"),
        F.when(is_index, F.array_distinct(F.array_compact(F.array(*indexed)))).alias("index"), F.array_distinct(F.array_compact(F.array(*look))).alias("probe"),
        # Firm readings with a full given name look where they are indexed; all others must look both ways.
        (~firm | raw | F.lit(among_loose)).alias("both_ways"),
    )
    parts = rows.withColumn("family", F.explode("parts")).where(F.length("family") >= 4).withColumn("part", F.lit(True))
    return rows.withColumn("part", F.lit(False)).unionByName(parts).drop("parts")


def _joined(probe: DataFrame, index: DataFrame, cols: list[str]) -> DataFrame:
    """Pairs (a_..., b_...) of rows that share a segment key and are not both parts: a looks, b is indexed."""
    named = lambda df, p: df.select(*[F.col(c).alias(f"{p}_{c}") for c in cols], "key")
    pairs = named(probe_rows(probe, cols), "a").join(named(index_rows(index, cols), "b"), "key")
    pairs = pairs.where((F.col("a_rep") != F.col("b_rep")) & ~(F.col("a_part") & F.col("b_part")))
    return pairs.where(_agree(F.col("a_species"), F.col("b_species")) & _agree(F.col("a_world"), F.col("b_world")))


def candidates(left: DataFrame, right: DataFrame, both: bool) -> DataFrame:
    """Pairs (a_..., b_...) of rows (rep, species, world, given, family, part, g) with near family names: left looks, right is indexed.

    g is the key a given name must share; both tells that every row of left is indexed too. A row with both attributes looks in its
    block, one that lacks an attribute in the block of the other, where all are indexed.
    """
    full, by_species, by_world = _blocks(F.col("species"), F.col("world"))
    complete, g = F.col("species").isNotNull() & F.col("world").isNotNull(), F.col("g")
    single = F.coalesce(F.when(F.col("world").isNull(), by_species), by_world)
    look = F.array_compact(F.array(F.when(full.isNotNull(), _address(full, g)), F.when(~complete & single.isNotNull(), _address(single, g))))
    held = F.array_compact(F.array(*[F.when(b.isNotNull(), _address(b, g)) for b in (full, by_species, by_world)]))
    cols = ["rep", "species", "world", "given", "family", "part"]
    one_part = F.col("a_part") | F.col("b_part")
    close = F.when(one_part, F.levenshtein("a_family", "b_family", 1) >= 0).otherwise(near(F.col("a_family"), F.col("b_family")))
    return _joined(left.withColumn("probe", look).withColumn("both_ways", ~complete | F.lit(not both)), right.withColumn("index", held), cols).where(close)


def met(rows: DataFrame) -> DataFrame:
    """Verified pairs of representatives as addressed() gives them, with the edits d of the family names, one more for a part.

    Pairs of given names are left to the caller, who finds both with their kinds.
    """
    pairs = _joined(rows, rows.where("index is not null"), ["rep", "given", "family", "kind", "usual", "species", "world", "firm", "part"])
    a, b = F.col("a_family"), F.col("b_family")
    part = F.when(F.least(F.length(a), F.length(b)) >= 6, F.levenshtein(a, b, 1) >= 0).otherwise(a == b)
    pairs = pairs.where(F.when(F.col("a_part") | F.col("b_part"), part).otherwise(alike(a, b, ~F.col("a_usual") & ~F.col("b_usual"))))
    d = F.levenshtein(a, b) + (F.col("a_part") | F.col("b_part")).cast("int")
    keep = [F.col(f"{x}_{c}") for x in "ab" for c in ("rep", "given", "kind", "firm")]
    return pairs.select(*keep, F.least(d, F.lit(9)).alias("d"))


def one_given(d: Column) -> Column:
    """Whether the full given names of a pair can be one: near, or an unread one within two edits of the other beside equal family names."""
    a, b = F.col("a_given"), F.col("b_given")
    unread = (F.col("a_kind") == RAW) | (F.col("b_kind") == RAW)
    first = F.substring(a, 1, 1) == F.substring(b, 1, 1)
    return near(a, b) | (unread & first & ((F.levenshtein(_scan_fold(a), _scan_fold(b), 1) >= 0) | ((d == 0) & (F.levenshtein(a, b, 2) >= 0))))


def representatives(records: DataFrame, aliases: DataFrame, lexicon_rows: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """(members(case_id, rep, firm), reps(rep, species, world, given, family, kind, parts, usual)).

    usual tells a family name that full given names of more than one kind bear.
    """
    rows = records.where("case_id is not null")
    calm = ~F.coalesce("identity_conflict", F.lit(False))
    written = F.array(F.struct(F.col("applicant_name").alias("name"), F.lit(False).alias("letter"), F.lit(True).alias("calm")), F.struct(F.col("sponsor_letter_name").alias("name"), F.lit(True).alias("letter"), calm.alias("calm")))
    names = rows.select("case_id", F.inline(written)).where(~absent(F.col("name")))
    names = cut(names.groupBy("case_id", "name", "letter").agg(F.count("*").alias("n"), F.bool_and("calm").alias("calm")))
    learned = learn(names.where("not letter"), aliases)
    read = names.withColumn("f", F.explode(forms_udf(learned)("name"))).select("case_id", "n", "letter", "calm", "f.*")
    forms = cut(read.groupBy("case_id", "letter", "given", "family", "kind").agg(F.sum("n").alias("n"), F.bool_and("calm").alias("calm"), F.max("parts").alias("parts")))
    main = forms.where("not letter").groupBy("case_id").agg(F.max_by(F.struct("given", "family", "kind", "parts"), F.struct(-F.col("kind"), F.col("n"), F.col("family"))).alias("m"))
    judged = forms.join(main, "case_id", "left")
    given_fits = F.when((F.col("kind") == WEAK) | (F.col("m.kind") == WEAK), F.substring("given", 1, 1) == F.substring("m.given", 1, 1)).otherwise((F.levenshtein("given", "m.given", 2) >= 0) | (((F.col("kind") == RAW) | (F.col("m.kind") == RAW)) & (F.substring("given", 1, 1) == F.substring("m.given", 1, 1))))
    none = F.array().cast("array<string>")
    contained = F.exists(F.coalesce("parts", none), lambda p: near(p, F.col("m.family"), 7)) | F.exists(F.coalesce("m.parts", none), lambda p: near(p, F.col("family"), 7))
    fits = F.when(F.col("m").isNull(), F.col("calm")).otherwise(given_fits & (near(F.col("family"), F.col("m.family"), 7) | contained))
    kept = judged.where(~F.col("letter") | fits).groupBy("case_id", "given", "family", "kind").agg(F.max("parts").alias("parts"))
    who = kept.join(case_attributes(records, lexicon_rows), "case_id").where("species is not null or world is not null")
    who = cut(who.withColumn("rep", F.xxhash64("species", "world", "given", "family", "kind")))
    reps = who.groupBy("rep").agg(*[F.max(c).alias(c) for c in ("species", "world", "given", "family", "kind", "parts")])
    usual = reps.where(F.col("kind") == STRONG).groupBy("family").agg((F.min("given") != F.max("given")).alias("usual"))
    reps = reps.join(usual, "family", "left").withColumn("usual", F.coalesce("usual", F.lit(False)))
    return who.select("case_id", "rep", _firm().alias("firm")), reps


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, comp) of the connected components of edges(a, b), by rounds of least neighbours and pointer jumping."""
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    both = cut(both)
    labels = cut(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("comp")).withColumnRenamed("a", "node"))
    for _ in range(rounds):
        seen = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("other"))
        step = labels.join(seen, "node").select("node", "comp", F.least("comp", "other").alias("next"))
        parent = labels.select(F.col("node").alias("next"), F.col("comp").alias("up"))
        jumped = cut(step.join(parent, "next", "left").select("node", "comp", F.least("next", F.coalesce("up", "next")).alias("next")))
        moved = jumped.where("comp <> next").limit(1).count()
        labels = jumped.select("node", F.col("next").alias("comp"))
        if not moved:
            return labels
    raise RuntimeError("components did not settle")


def _ends() -> list[Column]:
    return [F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b")]


def _star(members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(hub(case_id, hub), edges(a, b)) that tie the representatives of a case together."""
    hub = members.groupBy("case_id").agg(F.min("rep").alias("hub"))
    return hub, members.join(hub, "case_id").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()


def linked(records: DataFrame, aliases: DataFrame, lexicon_rows: list[tuple]) -> DataFrame:
    """(case_id, applicant): the cases of one applicant share the number."""
    members, reps = representatives(records, aliases, lexicon_rows)
    reps = cut(reps)
    found = cut(met(addressed(reps)))
    weak_pair = F.col("a_kind") == WEAK
    links = found.where(F.col("a_firm") & F.col("b_firm") & one_given(F.col("d")))
    hub, star = _star(members.where("firm"))
    comps = components(links.select(*_ends()).distinct().union(star))
    certain = cut(hub.join(comps, hub["hub"] == comps["node"]).select("case_id", "comp"))
    weak = cut(members.join(certain, "case_id", "left_anti").select("case_id", "rep"))
    # Cases without a firm representative join the one applicant that fits best; they never bridge two applicants.
    fit = found.where(~F.col("a_firm") & F.when(weak_pair, _opens("a_given", "b_given")).otherwise(one_given(F.col("d")))).select(F.col("a_rep").alias("rep"), F.col("b_rep").alias("node"), "d")
    fit = fit.join(comps, "node").groupBy("rep", "comp").agg(F.min("d").alias("d"))
    fit = cut(weak.join(fit, "rep").groupBy("case_id", "comp").agg(F.min("d").alias("d")))
    best = fit.groupBy("case_id").agg(F.min("d").alias("d"))
    chosen = fit.join(best, ["case_id", "d"]).groupBy("case_id").agg(F.min("comp").alias("comp"), F.max("comp").alias("last")).where("comp = last").select("case_id", "comp")
    chosen = cut(chosen)
    rest = cut(weak.join(chosen, "case_id", "left_anti").select("case_id", "rep"))
    alone = among_loose(rest, cut(reps.join(rest.select("rep").distinct(), "rep", "left_semi")))
    return certain.unionByName(chosen).unionByName(alone).select("case_id", F.col("comp").alias("applicant"))


def _opens(short: str, given: str) -> Column:
    """Whether a shortened given name opens a given name, within one slip from three letters on."""
    size = F.length(short)
    start = lambda n: F.levenshtein(F.col(short), F.substr(F.col(given), F.lit(1), n), 1) >= 0
    return F.col(given).startswith(F.col(short)) | ((size >= 3) & (start(size) | start(size - 1)))


def among_loose(rest: DataFrame, loose: DataFrame) -> DataFrame:
    """(case_id, comp) of the cases that fit no applicant with a firm representative, linked among themselves.

    Representatives that lack the same are joined for certain. Links between others count only if all that they connect agrees in
    species, home world and given name; else the certain parts stay apart.
    """
    weak = lambda p: F.col(f"{p}_kind") == WEAK
    opens = (weak("a") & _opens("a_given", "b_given")) | (weak("b") & _opens("b_given", "a_given"))
    found = met(addressed(loose, among_loose=True)).where(F.when(weak("a") | weak("b"), opens).otherwise(one_given(F.col("d")))).select(*_ends()).distinct()
    lacks = lambda p: loose.select(F.col("rep").alias(p), F.struct(F.col("kind") == WEAK, (F.col("kind") == WEAK) & (F.length("given") == 1), F.col("species").isNull(), F.col("world").isNull()).alias(f"{p}_lacks"))
    edges = cut(found.join(lacks("a"), "a").join(lacks("b"), "b").select("a", "b", (F.col("a_lacks") == F.col("b_lacks")).alias("sure")))
    hub, star = _star(rest)
    star = cut(star)
    parts = components(edges.where("sure").select("a", "b").union(star)).withColumnRenamed("comp", "part")
    wide = components(edges.select("a", "b").union(star))
    key = F.when(F.col("kind") == STRONG, F.col("given")).when(F.col("kind") == RAW, F.concat(F.lit("~"), F.substring("given", 1, 1)))
    nodes = cut(wide.join(parts, "node").join(loose.withColumnRenamed("rep", "node"), "node").select("node", "comp", "part", "species", "world", "given", "kind", key.alias("key")))
    keys = nodes.where("key is not null")
    shared = keys.groupBy("comp", "key").agg(F.countDistinct("part").alias("n")).groupBy("comp").agg(F.max("n").alias("shared"))
    named = keys.groupBy("comp").agg(F.countDistinct("part").alias("named"))
    raw, opening = F.when(F.col("kind") == RAW, F.col("given")), F.when(F.length("given") > 1, F.substring("given", 1, 2))
    same = F.coalesce(near(F.min(raw), F.max(raw)), F.lit(True)) & (~F.bool_or((F.col("kind") == WEAK) & (F.length("given") > 1)) | (F.min(opening) == F.max(opening)))
    agree = nodes.groupBy("comp").agg((_agree(F.min("species"), F.max("species")) & _agree(F.min("world"), F.max("world")) & same).alias("agree"))
    ok = agree.join(shared, "comp", "left").join(named, "comp", "left").select("comp", (F.col("agree") & F.coalesce(F.col("shared") == F.col("named"), F.lit(True))).alias("ok"))
    final = nodes.join(ok, "comp").select(F.col("node").alias("hub"), F.when(F.col("ok"), F.col("comp")).otherwise(F.col("part")).alias("comp"))
    return hub.join(final, "hub").select("case_id", "comp")


def pairs(links: DataFrame) -> DataFrame:
    """Every pair of different cases of one applicant, case_a the smaller: (case_a, case_b)."""
    a = links.select("applicant", F.col("case_id").alias("case_a"))
    b = links.select("applicant", F.col("case_id").alias("case_b"))
    return a.join(b, "applicant").where("case_a < case_b").select("case_a", "case_b")
