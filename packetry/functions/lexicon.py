"""Closed vocabularies: aliases of every entry and a distance that knows scans, slips and catalogue numbers."""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import permutations

from packetry.functions.text import fold, is_absent

# Characters that scans confuse with each other.
CONFUSED = {frozenset(p) for p in ("0o", "1l", "1i", "li", "5s", "8b", "6g", "2z")}
INF = 99
#: A vocabulary is a bounded list kept on the driver; a larger one is refused rather than collected.
MAX_ENTRIES = 5000

_LEAD = re.compile(r"^(?:~+|(?:poss|prob|maybe|approx)(?:\.\s*|\s+)|class\s+)\s*")
_TAIL = re.compile(r"(?:\s*\((?:confirmed|renewal|again|est|sic|noted)\)|,?\s+noted|\s+visa|[\s?*.]+)$")


def key_of(value: str) -> str:
    """Letters and digits of a value without accents, case, doubts and remarks around it."""
    s = fold(value)
    while True:
        t = _TAIL.sub("", _LEAD.sub("", s))
        if t == s or not t:
            break
        s = t
    return "".join(ch for ch in s if ch.isalnum())


def reach(alias: str) -> int:
    """Edits allowed for an alias, by its length. A number, which must be right, makes up for a short word."""
    n = len(alias)
    return 0 if n <= 3 else 2 if n == 5 and any(map(str.isdigit, alias)) else 1 if n <= 5 else 2 if n <= 9 else 3 if n <= 17 else 4


def step_cost(a: str, b: str) -> int:
    """Cost of reading a for b: digits only stand for themselves or a letter that scans confuse with them."""
    if a == b:
        return 0
    if frozenset((a, b)) in CONFUSED:
        return 0
    return INF if a.isdigit() or b.isdigit() else 1


def gap_cost(a: str) -> int:
    """Cost of a character too many or too few; a number is never lengthened or cut."""
    return INF if a.isdigit() else 1


def distance(a: str, b: str, limit: int) -> int:
    """Optimal string alignment distance with the costs above; limit + 1 when beyond limit."""
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    before: list[int] = []
    row = [0]
    for ch in b:
        row.append(row[-1] + gap_cost(ch))
    for i, x in enumerate(a):
        cur = [row[0] + gap_cost(x)]
        for j, y in enumerate(b):
            best = min(row[j] + step_cost(x, y), row[j + 1] + gap_cost(x), cur[j] + gap_cost(y))
            if i and j and x == b[j - 1] and a[i - 1] == y and x != y and not x.isdigit() and not y.isdigit():
                best = min(best, before[j - 1] + 1)
            cur.append(best)
        if min(cur) > limit:
            return limit + 1
        before, row = row, cur
    return min(row[-1], limit + 1)


#: Entries of at most so many words are searched in every order of their words, longer ones in every turn of it.
ALL_ORDERS = 4


def _bare(token: str) -> str:
    """A word without the vowels after its first letter."""
    return token[0] + re.sub("[aeiou]", "", token[1:])


def _short_ends(token: str, key: str, at: int) -> list[int]:
    """Ends in key of the short forms of a word that begin at a place: the word, its openings from three letters on, or its consonants."""
    n = 0
    while n < len(token) and at + n < len(key) and key[at + n] == token[n]:
        n += 1
    if not token.isalpha():
        return [at + n] if n == len(token) else []
    ends = list(range(at + 3, at + n + 1)) if len(token) > 2 else [at + n] if n == len(token) else []
    bare = _bare(token)
    return [*ends, at + len(bare)] if len(bare) > 2 and key.startswith(bare, at) else ends


def shortened(tokens: list[str], key: str) -> bool:
    """Whether key is the words of an entry in order, each in one of its short forms. The forms are walked, never listed."""
    at = {0}
    for token in tokens:
        at = {e for a in at for e in _short_ends(token, key, a)}
        if not at:
            return False
    return len(key) in at


def aliases(canonical: str, wording: str | None) -> set[str]:
    """Forms of an entry that are searched within a distance, as key_of() writes them."""
    near = {key_of(canonical)}
    tokens = re.findall(r"[^\W_]+", fold(canonical))
    if 1 < len(tokens) <= ALL_ORDERS:
        near |= {"".join(p) for p in permutations(tokens)}
    elif tokens:
        near |= {"".join(tokens[i:] + tokens[:i]) for i in range(len(tokens))}
    if wording:
        near.add(key_of(wording))
    return near


class Lexicon:
    """Entries of code_list by field. Small by contract (MAX_ENTRIES), so it travels inside task closures."""

    def __init__(self, rows: Iterable[tuple[int, str, str, str | None, str | None]]):
        self.near: dict[str, list[tuple[str, int]]] = {}
        self.canonical: dict[str, dict[str, int]] = {}
        self._whole: dict[str, dict[str, set[int]]] = {}
        self._codes: dict[str, dict[str, set[int]]] = {}
        self._words: dict[str, dict[str, list[tuple[list[str], int]]]] = {}
        rows = sorted(rows)
        if len(rows) > MAX_ENTRIES:
            raise ValueError(f"a vocabulary of more than {MAX_ENTRIES} entries is not a closed list")
        for entry_id, field, canonical, wording, short_code in rows:
            self.canonical.setdefault(field, {})[canonical] = entry_id
            near = aliases(canonical, wording)
            self.near.setdefault(field, []).extend((k, entry_id) for k in sorted(near))
            for k in near:
                self._whole.setdefault(field, {}).setdefault(k, set()).add(entry_id)
            if short_code:
                self._codes.setdefault(field, {}).setdefault(key_of(short_code), set()).add(entry_id)
            if tokens := re.findall(r"[^\W_]+", fold(canonical)):
                self._words.setdefault(field, {}).setdefault(tokens[0][0], []).append((tokens, entry_id))
        self.memo: dict[tuple[str, str], int] = {}
        self.raw: dict[tuple[str, str], int | None] = {}

    def exact(self, field: str, key: str) -> int | None:
        """The one entry a key writes in full, by its code or shortened; a whole writing comes before a shortened one, two owners mean none."""
        owners = self._whole.get(field, {}).get(key, set())
        if not owners and key:
            owners = set(self._codes.get(field, {}).get(key, ()))
            owners |= {e for tokens, e in self._words.get(field, {}).get(key[0], ()) if shortened(tokens, key)}
        return next(iter(owners)) if len(owners) == 1 else None

    def search(self, field: str, key: str) -> list[tuple[int, int]]:
        """(distance, entry) of every entry within reach of key, nearest first."""
        best: dict[int, int] = {}
        for alias, entry_id in self.near.get(field, ()):
            limit = reach(alias)
            d = distance(key, alias, limit)
            if d <= limit and d < best.get(entry_id, INF):
                best[entry_id] = d
        return sorted((d, e) for e, d in best.items())

    def resolve(self, field: str, value: str | None) -> int | None:
        """Entry meant by a value, 0 if none is, None for a cell without value. Two entries equally near mean none.

        A writing of absence that is an entry in full ("Hidden Harbor" of a list that holds it) is that entry.
        """
        if value is None:
            return None
        if (hit := self.canonical.get(field, {}).get(value)) is not None:
            return hit
        if (field, value) in self.raw:
            return self.raw[field, value]
        hit = self._resolve(field, value)
        if len(self.raw) < 200_000 and len(value) <= 200:
            self.raw[field, value] = hit
        return hit

    def _resolve(self, field: str, value: str) -> int | None:
        key = key_of(value)
        hit = self.exact(field, key)
        if hit is not None or is_absent(value):
            return hit
        if (field, key) in self.memo:
            return self.memo[field, key]
        found = self.search(field, key)
        hit = found[0][1] if found and (len(found) == 1 or found[0][0] < found[1][0]) else 0
        if len(self.memo) < 200_000:
            self.memo[field, key] = hit
        return hit


def load(code_list) -> list[tuple]:
    """Rows of a code_list table for Lexicon; reads one row more than allowed so that a large list fails loudly."""
    cols = ["entry_id", "field_name", "canonical", "wording", "short_code"]
    return [tuple(r) for r in code_list.select(*cols).where("field_name is not null and canonical is not null").limit(MAX_ENTRIES + 1).collect()]
