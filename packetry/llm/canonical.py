"""Free-entered values mapped to a canonical list: a trie of the entries' alias paths searched with a Levenshtein automaton.

The automaton's state for a query is one row of edit costs per trie depth (with transpositions, scan confusions at no cost, and
digits that only match themselves); a branch is left as soon as no state of its row is within reach. All entries within the
distance their alias length allows come back; the nearest is meant, and two equally near mean none.

Defined results: cells without value are no cases; a value that matches nothing gives entry 0; values of any length are one
walk of the trie, whose depth ends the search; repeated rows each give their row; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from packetry.functions.lexicon import INF, Lexicon, gap_cost, reach, step_cost
from packetry.functions.text import NO_FLAG, absent, fold
from packetry.operators.packed import Segmenter, known_values

SCALARS = ("species_code", "home_world", "visa_class")
FLAGS = "risk_flags"


class Trie:
    """Alias paths of one field. A node is [children, entries, longest reach below it, longest alias below it]."""

    def __init__(self, near: list[tuple[str, int]]):
        self.root: list = [{}, [], 0]
        for alias, entry in near:
            allowed = reach(alias)
            node = self.root
            node[2] = max(node[2], allowed)
            for ch in alias:
                node = node[0].setdefault(ch, [{}, [], 0])
                node[2] = max(node[2], allowed)
            node[1].append((entry, allowed))

    def search(self, key: str) -> list[tuple[int, int]]:
        """(distance, entry) of every entry within its own reach of key, nearest first."""
        row = [0]
        for ch in key:
            row.append(min(INF, row[-1] + gap_cost(ch)))
        best: dict[int, int] = {}
        stack = [(self.root, "", row, None)]
        while stack:
            node, last, row, before = stack.pop()
            for entry, allowed in node[1]:
                if row[-1] <= allowed and row[-1] < best.get(entry, INF):
                    best[entry] = row[-1]
            for ch, child in node[0].items():
                cur = [min(INF, row[0] + gap_cost(ch))]
                for j, q in enumerate(key):
                    cost = min(row[j] + step_cost(ch, q), row[j + 1] + gap_cost(ch), cur[j] + gap_cost(q))
                    if before is not None and j and ch == key[j - 1] and last == q and ch != q and not ch.isdigit() and not q.isdigit():
                        cost = min(cost, before[j - 1] + 1)
                    cur.append(min(cost, INF))
                if min(cur) <= child[2] or (len(cur) > 1 and min(row) + 1 <= child[2]):
                    stack.append((child, ch, cur, row))
        return sorted((d, e) for e, d in best.items())


class Matcher(Lexicon):
    """A lexicon whose search walks tries."""

    def __init__(self, rows):
        super().__init__(rows)
        self.tries = {field: Trie(near) for field, near in self.near.items()}

    def search(self, field: str, key: str) -> list[tuple[int, int]]:
        return self.tries[field].search(key) if field in self.tries else []


def match_udf(lexicon_rows: list[tuple], field: str):
    """Arrow UDF from a written value to its entry (0: none is meant, null: no value)."""
    box: list[Matcher] = []

    @F.pandas_udf("int")
    def entry(values: pd.Series) -> pd.Series:
        if not box:
            box.append(Matcher(lexicon_rows))
        codes, distinct = pd.factorize(values)
        found = [box[0].resolve(field, v) for v in distinct]
        return pd.Series([found[c] if c >= 0 else None for c in codes], dtype="Int32")

    return entry


def _odd_items(matcher: Matcher, cutter: Segmenter, cell: str) -> list[tuple[str, int]]:
    """(item, entry) of the items of a flag cell that are not written canonically and hold a value."""
    names = matcher.canonical.get(FLAGS, {})
    items = [i for i in cutter.split(cell) if i not in names and fold(i) not in NO_FLAG]
    return [(i, e) for i in items if (e := matcher.resolve(FLAGS, i)) is not None]


def _flags_box(lexicon_rows: list[tuple]) -> tuple[Matcher, Segmenter]:
    return Matcher(lexicon_rows), Segmenter(known_values([r for r in lexicon_rows if r[1] == FLAGS]))


def flags_udf(lexicon_rows: list[tuple]):
    """Arrow UDF from a flag cell to the entries of those items that are not written canonically."""
    box: list = []

    @F.pandas_udf("array<int>")
    def entries(cells: pd.Series) -> pd.Series:
        if not box:
            box.append(_flags_box(lexicon_rows))

        def of(cell: str) -> list[int]:
            return sorted({e for _, e in _odd_items(*box[0], cell)})

        codes, distinct = pd.factorize(cells)
        found = [of(v) for v in distinct]
        return pd.Series([found[c] if c >= 0 else [] for c in codes])

    return entries


def lost_items_udf(lexicon_rows: list[tuple]):
    """Arrow UDF from a flag cell to its distinct items that mean no entry, as written."""
    box: list = []

    @F.pandas_udf("array<string>")
    def lost(cells: pd.Series) -> pd.Series:
        if not box:
            box.append(_flags_box(lexicon_rows))
        codes, distinct = pd.factorize(cells)
        found = [sorted({i for i, e in _odd_items(*box[0], v) if e == 0}) for v in distinct]
        return pd.Series([found[c] if c >= 0 else [] for c in codes])

    return lost


def _canonical(c: Column, lexicon_rows: list[tuple], field: str) -> Column:
    names = [canonical for _, f, canonical, *_ in lexicon_rows if f == field]
    return F.coalesce(c.isin(*names), F.lit(False)) if names else F.lit(False)


def _flag_cell(lexicon_rows: list[tuple]) -> Column:
    """A flag cell that is not one canonical flag and names some flag, else null."""
    c = F.col(FLAGS)
    return F.when(~_canonical(c, lexicon_rows, FLAGS) & ~F.lower(F.trim(c)).isin(*NO_FLAG), c)


def mapped(records: DataFrame, lexicon_rows: list[tuple]) -> DataFrame:
    """Distinct (record_id, field_name, entry_id) of the values that are not written exactly as canonical; 0 means no entry.

    One pass without a shuffle: a record's own values are made distinct inside its row.
    """
    arrays = []
    for f in SCALARS:
        c = F.col(f"`{f}`")
        e = match_udf(lexicon_rows, f)(F.when(~_canonical(c, lexicon_rows, f) & ~absent(c), c))
        arrays.append(F.when(e.isNotNull(), F.array(F.struct(F.lit(f).alias("field_name"), e.cast("bigint").alias("entry_id")))))
    e = flags_udf(lexicon_rows)(_flag_cell(lexicon_rows))
    arrays.append(F.transform(e, lambda x: F.struct(F.lit(FLAGS).alias("field_name"), x.cast("bigint").alias("entry_id"))))
    none = F.array().cast("array<struct<field_name:string,entry_id:bigint>>")
    return records.select("record_id", F.inline(F.concat(*[F.coalesce(a, none) for a in arrays])))


def unmatched(records: DataFrame, lexicon_rows: list[tuple], top: int | None = None) -> DataFrame:
    """Report of the scalar fields' values that mean no entry: (field_name, value, n_records)."""
    parts = []
    for f in SCALARS:
        c = F.col(f"`{f}`")
        odd = records.select(F.when(~_canonical(c, lexicon_rows, f) & ~absent(c), c).alias("value")).where("value is not null").groupBy("value").agg(F.count("*").alias("n_records"))
        parts.append(odd.withColumn("e", match_udf(lexicon_rows, f)("value")).where("e = 0").select(F.lit(f).alias("field_name"), "value", "n_records"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("n_records"), "field_name", "value").limit(top) if top else out


def unmatched_items(records: DataFrame, lexicon_rows: list[tuple]) -> DataFrame:
    """Report of flag items that mean no entry, as unmatched() has it; an item counts once a record."""
    items = records.select(F.explode(lost_items_udf(lexicon_rows)(_flag_cell(lexicon_rows))).alias("value"))
    return items.groupBy("value").agg(F.count("*").alias("n_records")).select(F.lit(FLAGS).alias("field_name"), "value", "n_records")
