"""Several values packed in one field: dictionary-guided segmentation into one row per value.

A cell is cut into atoms: quoted stretches, runs of text, and the delimiters and list marks between them. A multi-pattern
automaton over the known whole values proposes arcs that may span delimiters ("summons, open") or cut a run at blanks;
dynamic programming then picks the cover with the highest score, so that a delimiter inside a legitimate value is kept.

Defined results: a null cell, a cell without value, and an empty list give no rows; empty items are not counted; text of any
length is one pass of the automaton plus one dynamic program over its atoms; repeated items are all kept.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.text import NO_FLAG, fold

#: Characters that end an item wherever they stand outside quotes and known values.
DELIMITERS = "|;,/&+\t\n\r"
_PIECE = re.compile(
    r"""(?P<quote>"(?:[^"]|"")*"|(?<![^\s()\[\]{}|;,/&+])'[^']*'(?![^\s()\[\]{}|;,/&+]))"""
    r"""|(?P<mark>(?:(?<=\s)|^)\(?\d{1,3}[.)](?=\s)|(?:(?<=\n)|^)\s*[-*•](?=\s))"""
    r"""|(?P<cut>[|;,/&+\t\n\r\[\]{}]|(?<=\s)and(?=\s))"""
    r"""|(?P<text>.)""",
    re.S | re.I,
)
_SPACES = re.compile(r"\s*")
#: Cells that hold none of these are one item at most and never leave the JVM.
MAYBE_SEVERAL = r"[|;,/&+\t\n\r\s]"


def _lower(s: str) -> str:
    """Lower case with every character at its place; one whose lower case is longer stays."""
    low = s.lower()
    return low if len(low) == len(s) else "".join(x if len(x := ch.lower()) == 1 else ch for ch in s)


def _known(values: Iterable[str]) -> ahocorasick.Automaton | None:
    automaton = ahocorasick.Automaton()
    for v in {fold(v) for v in values if v and v.strip()}:
        automaton.add_word(v, len(v))
    if not len(automaton):
        return None
    automaton.make_automaton()
    return automaton


def known_values(rows: Iterable[tuple]) -> list[str]:
    """Whole values of a vocabulary, with the turned-round writings whose own delimiter must not cut them."""
    out: list[str] = ["n/a"]
    for _, _, canonical, wording, short_code in rows:
        out += [v for v in (canonical, wording, short_code) if v]
        tokens = re.findall(r"[^\W_]+", canonical)
        if len(tokens) == 2:
            a, b = tokens
            out += [f"{a} {b}", *(f"{b}{d}{a}" for d in (", ", "; ", " / ", ",", ";", "/")), *(f"{a}{d}{b}" for d in (" / ", "/"))]
    return out


class Segmenter:
    """Splits cells with a dictionary of known whole values."""

    def __init__(self, values: Iterable[str]):
        self.values = list(values)
        self.automaton = _known(self.values)

    def __getstate__(self):
        return self.values

    def __setstate__(self, values):
        self.__init__(values)

    def split(self, cell: str | None) -> list[str]:
        """Items in order, as written, without the blanks, quotes and list marks around them."""
        if cell is None or fold(cell) in NO_FLAG:
            return []
        atoms: list[tuple[int, int, str]] = []  # start, end, kind
        for m in _PIECE.finditer(cell):
            kind = m.lastgroup or "text"
            if kind == "text" and atoms and atoms[-1][2] == "text":
                atoms[-1] = (atoms[-1][0], m.end(), "text")
            else:
                atoms.append((m.start(), m.end(), kind))
        atoms = [self._tight(cell, a) for a in atoms]
        atoms = [a for a in atoms if a[0] < a[1]]
        arcs = self._arcs(cell, atoms)
        steps: list[tuple[int, int, str | None]] = [(0, -1, None)]
        for j in range(1, len(atoms) + 1):
            start, end, kind = atoms[j - 1]
            options = [(steps[j - 1][0] + (0 if kind in ("cut", "mark") else 1), j - 1, None if kind in ("cut", "mark") else cell[start:end])]
            options += [(steps[i][0] + 3 * (j - i), i, cell[atoms[i][0] : end]) for i in arcs.get(j, ())]
            steps.append(max(options, key=lambda o: o[0]))
        items: list[str] = []
        j = len(atoms)
        while j > 0:
            _, i, item = steps[j]
            if item is not None:
                items += reversed(self._blanks(item, atoms[j - 1][2]))
            j = i
        return [x for x in map(self._bare, reversed(items)) if x]

    @staticmethod
    def _tight(cell: str, atom: tuple[int, int, str]) -> tuple[int, int, str]:
        start, end, kind = atom
        if kind == "text":
            while start < end and cell[start].isspace():
                start += 1
            while start < end and cell[end - 1].isspace():
                end -= 1
        return start, end, kind

    def _arcs(self, cell: str, atoms: list[tuple[int, int, str]]) -> dict[int, list[int]]:
        """Arcs over several atoms whose text is one known value: end atom (exclusive) to start atoms."""
        out: dict[int, list[int]] = {}
        if self.automaton is None:
            return out
        low = _lower(cell)
        starts = {a[0]: i for i, a in enumerate(atoms)}
        ends = {a[1]: i + 1 for i, a in enumerate(atoms)}
        for last, n in self.automaton.iter(low):
            i, j = starts.get(last + 1 - n), ends.get(last + 1)
            if i is not None and j is not None and j - i > 1 and all(a[2] != "quote" for a in atoms[i:j]):
                out.setdefault(j, []).append(i)
        return out

    def _blanks(self, item: str, kind: str) -> list[str]:
        """A run made up of several known values with only blanks between them is cut there."""
        if kind == "quote" or self.automaton is None or " " not in item:
            return [item]
        ends: dict[int, tuple[int, int, int]] = {0: (0, 0, 0)}  # place reached: number of values, start and end of the last one
        spans = [(last + 1 - n, last + 1) for last, n in self.automaton.iter(_lower(item))]
        for s, e in sorted(spans, key=lambda x: x[1]):
            if s in ends and (e == len(item) or item[e].isspace()):
                after = _SPACES.match(item, e).end()
                if after not in ends or ends[s][0] + 1 < ends[after][0]:
                    ends[after] = (ends[s][0] + 1, s, e)
        cover, at = [], len(item)
        while at in ends and at > 0:
            _, at, e = ends[at]
            cover.append(item[at:e])
        return cover[::-1] or [item]

    @staticmethod
    def _bare(item: str) -> str:
        s = item.strip()
        while len(s) > 1 and (s[0], s[-1]) in (('"', '"'), ("'", "'"), ("[", "]"), ("{", "}"), ("(", ")")):
            inner = s[1:-1]
            s = (inner.replace('""', '"') if s[0] == '"' else inner).strip()
        return "" if s in ('"', "'", "(", ")") else s


def items_udf(values: Iterable[str]):
    """Arrow UDF from cell to items; each distinct cell of a batch is cut once."""
    cutter = Segmenter(values)

    @F.pandas_udf("array<string>")
    def items(cells: pd.Series) -> pd.Series:
        codes, distinct = pd.factorize(cells)
        done = [cutter.split(v) for v in distinct]
        return pd.Series([done[c] if c >= 0 else [] for c in codes])

    return items


def split_cells(df: DataFrame, cell: str, values: Iterable[str], out: str = "items") -> DataFrame:
    """Add the array of items of every cell. Cells that cannot hold several values skip Python."""
    c = F.col(f"`{cell}`")
    return df.withColumn(out, items_udf(values)(c))


def several(df: DataFrame, cell: str, row_id: str, in_table: str | Column, values: Iterable[str]) -> DataFrame:
    """One row (in_table, row_id, pos, item) per item of each cell with at least two items; pos counts from 1."""
    label = F.lit(in_table) if isinstance(in_table, str) else in_table
    rows = df.select(label.alias("in_table"), F.col(f"`{row_id}`").cast("bigint").alias("row_id"), F.col(f"`{cell}`").alias("_cell"))
    rows = rows.where(F.col("_cell").rlike(MAYBE_SEVERAL))
    rows = split_cells(rows, "_cell", values, "_items").where(F.size("_items") > 1)
    return rows.select("in_table", "row_id", F.posexplode("_items").alias("p", "item")).select("in_table", "row_id", (F.col("p") + 1).cast("int").alias("pos"), "item")
