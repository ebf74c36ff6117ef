"""Filling missing values from similar records by K-prototypes, on three levels.

Records form groups (the readings of a case). The lowest level clusters the records of a group: the prototypes of a field that may
change over time are its runs of equal values; the numeric part of a prototype is the stretch of time its run holds (it starts with
the run and ends where the next begins), its categorical part the value. Records with a value lie inside their own run, so the
clustering starts at its fixed point; a record without one is assigned to the prototype at the least distance, the gap between its
time and the stretch. Fields that are stable in a group have one prototype, the group itself, with the mode of each field.
The upper level clusters the groups by Lloyd iterations of K-prototypes on their median time and their modes; its clusters fill
what a group cannot (parent fallback).

Every filled cell carries the method that filled it, ``interval`` (prototype along time), ``group_mode`` or ``parent_mode``, and the
distance of the record to its prototype: seconds for ``interval``, 0 for ``group_mode``, the mixed distance for ``parent_mode``.

No step gathers a group in one task. Modes are partial aggregates whose state is bounded by the vocabulary. The prototype at a time is
found over distinct moments with two levels of windows (stretches of ten minutes of a group, then the moments of one), so the windows
of a group with a third of all rows hold its moments only, however many rows share them.

Defined results: rows without group key or without row id are not filled; a null time is nearest to the earliest prototype;
of values of one group and time the one with the highest row id holds; ties of modes go to the smallest entry; repeated rows
are all filled; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetry.functions.lexicon import Lexicon
from packetry.functions.text import absent, blank
from packetry.runtime import cut

#: Stretch of the numeric feature whose moments one inner window holds (ten minutes, in microseconds).
BUCKET = 600_000_000
#: Stands for a null time: before every other.
NEVER = -(1 << 60)


def resolve_udf(lexicon_rows: list[tuple], field: str):
    """Arrow UDF from a written value to its entry; distinct values of a batch are resolved once. No shuffle, so no skew."""
    box: list[Lexicon] = []

    @F.pandas_udf("int")
    def entry(values: pd.Series) -> pd.Series:
        if not box:
            box.append(Lexicon(lexicon_rows))
        codes, distinct = pd.factorize(values)
        found = [box[0].resolve(field, v) or None for v in distinct]
        return pd.Series([found[c] if c >= 0 else None for c in codes], dtype="Int32")

    return entry


def entry_of(c: Column, lexicon_rows: list[tuple], field: str) -> Column:
    """Entry of a written value: canonical writings by a literal map in the JVM, only the others through Python."""
    exact = [x for e, f, canonical, *_ in lexicon_rows if f == field for x in (F.lit(canonical), F.lit(int(e)))]
    if not exact:
        return F.lit(None).cast("int")
    known = F.try_element_at(F.create_map(*exact), c).cast("int")
    return F.coalesce(known, resolve_udf(lexicon_rows, field)(F.when(known.isNull() & ~blank(c), c)))


def interval_fill(cells: DataFrame) -> DataFrame:
    """Nearest prototype along time of the cells (row_id, grp, field, t, entry, missing) that lack a value: (row_id, field, entry, distance)."""
    cells = cells.withColumn("t", F.coalesce("t", F.lit(NEVER)))
    seen = cells.where("entry is not null or missing").groupBy("grp", "field", "t").agg(F.max_by("entry", F.when(F.col("entry").isNotNull(), F.col("row_id"))).alias("entry"), F.max("missing").alias("asked"))
    seen = seen.withColumn("bucket", F.floor(F.col("t") / BUCKET)).withColumn("own", F.when(F.col("entry").isNotNull(), F.struct("entry", "t")))
    ends = seen.groupBy("grp", "field", "bucket").agg(F.max_by("own", F.when(F.col("own").isNotNull(), F.col("t"))).alias("last"), F.min_by("own", F.when(F.col("own").isNotNull(), F.col("t"))).alias("first"))
    w = Window.partitionBy("grp", "field").orderBy("bucket")
    ends = ends.withColumn("before", F.last("last", True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    ends = ends.withColumn("after", F.first("first", True).over(w.rowsBetween(0, Window.unboundedFollowing)))
    inside = Window.partitionBy("grp", "field", "bucket").orderBy("t").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = seen.withColumn("now", F.last("own", True).over(inside)).where("asked")
    at = at.join(ends.select("grp", "field", "bucket", "before", "after"), ["grp", "field", "bucket"])
    # A stretch holds up to the next one, so its gap to a later time is none; before the first the gap counts.
    held = F.coalesce("now", "before", "after")
    gap = F.when(F.coalesce("now", "before").isNull(), (F.col("after.t") - F.col("t")) / 1e6).otherwise(0.0)
    at = at.select("grp", "field", "t", held["entry"].alias("entry"), gap.alias("distance")).where("entry is not null")
    return cells.where("missing").select("row_id", "grp", "field", "t").join(at, ["grp", "field", "t"]).select("row_id", "field", "entry", "distance")


def parent_prototypes(modes: DataFrame, k: int = 8, rounds: int = 4, gamma: float = 1.0) -> tuple[DataFrame, dict[int, dict[str, int]]]:
    """K-prototypes of the groups on their modes: (grp, cluster, distance), and the modes of each cluster.

    modes has a row per group with t (median time in years) and one column per field. Seeds are the most frequent combinations of
    values that differ in two fields at least, then the next frequent ones; k prototypes of one number and a few categories each, and
    8 k combinations, are all that ever reaches the driver.
    """
    fields = [c for c in modes.columns if c not in ("grp", "t")]
    middle = F.percentile_approx("t", 0.5, 200).alias("t")
    combos = modes.groupBy(*fields).agg(F.count("*").alias("n"), middle).orderBy(F.desc("n"), *fields).limit(8 * k).collect()
    chosen: list = []
    for apart in (min(2, len(fields)), 0):
        for r in combos:
            if len(chosen) < k and r not in chosen and all(sum(r[f] != c[f] for f in fields) >= apart for c in chosen):
                chosen.append(r)
    protos = [{"t": r["t"] or 0.0, **{f: r[f] for f in fields}} for r in chosen]
    if not protos:
        return modes.select("grp", F.lit(0).alias("cluster"), F.lit(0.0).alias("distance")), {}

    def nearest() -> Column:
        costs = []
        for i, p in enumerate(protos):
            d = F.abs(F.coalesce(F.col("t"), F.lit(p["t"])) - F.lit(float(p["t"])))
            for f in fields:
                if p[f] is not None:
                    d = d + F.when(F.col(f).isNotNull() & (F.col(f) != p[f]), F.lit(gamma)).otherwise(F.lit(0.0))
            costs.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
        return F.least(*costs) if len(costs) > 1 else costs[0]

    for _ in range(rounds):
        at = modes.withColumn("cluster", nearest()["i"])
        found = at.groupBy("cluster").agg(middle, *[F.mode(f, True).alias(f) for f in fields]).collect()
        fresh = [dict(p) for p in protos]
        for r in found:
            fresh[r["cluster"]] = {"t": fresh[r["cluster"]]["t"] if r["t"] is None else r["t"], **{f: r[f] for f in fields}}
        if fresh == protos:
            break
        protos = fresh
    best = nearest()
    return modes.select("grp", best["i"].alias("cluster"), best["d"].alias("distance")), {i: {f: p[f] for f in fields if p[f] is not None} for i, p in enumerate(protos)}


def fill(rows: DataFrame, varying: tuple[str, ...], parents: bool = False, k: int = 8) -> DataFrame:
    """Fill the missing cells of rows(row_id, grp, t, e_<field>, m_<field> ...): (row_id, field, entry, method, distance).

    e_<field> is the entry of a field, m_<field> whether its cell is missing; varying names the fields that change over time.
    """
    rows = rows.where("grp is not null and row_id is not null")
    fields = [c[2:] for c in rows.columns if c.startswith("e_")]
    stable, moving = [f for f in fields if f not in varying], [f for f in fields if f in varying]
    out = ["row_id", "field", "entry", "method", "distance"]
    cell = lambda f, entry: F.struct(F.lit(f).alias("field"), entry.alias("entry"), F.col(f"m_{f}").alias("missing"))
    modes = rows.groupBy("grp").agg(*[F.mode(f"e_{f}", True).alias(f) for f in fields], F.percentile_approx("t", 0.5, 200).alias("t"))
    modes = cut(modes) if parents else modes
    parts = []
    if stable:
        lacking = rows.where(" or ".join(f"m_{f}" for f in stable)).select("row_id", "grp", *[f"m_{f}" for f in stable])
        cells = lacking.join(modes.select("grp", *stable), "grp").select("row_id", F.inline(F.array(*[cell(f, F.col(f)) for f in stable])))
        parts.append(cells.where("missing and entry is not null").select("row_id", "field", "entry", F.lit("group_mode").alias("method"), F.lit(0.0).alias("distance")))
    for f in moving:
        cells = rows.select("row_id", "grp", F.lit(f).alias("field"), "t", F.col(f"e_{f}").alias("entry"), F.col(f"m_{f}").alias("missing"))
        parts.append(interval_fill(cells).select("row_id", "field", "entry", F.lit("interval").alias("method"), "distance"))
    if parents and fields:
        clusters, protos = parent_prototypes(modes.withColumn("t", F.col("t") / F.lit(1e6 * 86_400 * 365)), k)
        top = [(i, f, e) for i, p in protos.items() for f, e in p.items()]
        if top:
            # A cell has no value in its own group exactly where the group has no mode of the field.
            open_cells = lambda f: F.when(F.col(f"m_{f}") & F.col(f).isNull(), F.lit(f))
            rest = rows.where(" or ".join(f"m_{f}" for f in fields)).select("row_id", "grp", *[f"m_{f}" for f in fields]).join(modes.select("grp", *fields), "grp")
            rest = rest.select("row_id", "grp", F.explode(F.array_compact(F.array(*map(open_cells, fields)))).alias("field"))
            table = F.broadcast(rows.sparkSession.createDataFrame(top, "cluster int, field string, entry int"))  # k x fields rows
            upper = rest.join(clusters, "grp").join(table, ["cluster", "field"])
            parts.append(upper.select("row_id", "field", "entry", F.lit("parent_mode").alias("method"), "distance"))
    done = parts[0].select(*out)
    for p in parts[1:]:
        done = done.unionByName(p.select(*out))
    return done


def record_cells(records: DataFrame, lexicon_rows: list[tuple], fields: tuple[str, ...] = ("species_code", "home_world", "declared_purpose")) -> DataFrame:
    """Rows of records for fill(): entries of the stable fields and of fee_status, which counts as unknown only if observed."""
    fee = {canonical: int(e) for e, f, canonical, *_ in lexicon_rows if f == "fee_status"}
    status = F.col("fee_status")
    no_fee = absent(status) & ~F.coalesce(status.isin("unknown"), F.lit(False)) | F.coalesce((status == "unknown") & ~F.coalesce("fee_observed", F.lit(False)), F.lit(False))
    fee_entry = F.when(~no_fee, entry_of(status, lexicon_rows, "fee_status")) if "unknown" not in fee else F.when(no_fee, None).when(status == "unknown", F.lit(fee["unknown"])).otherwise(entry_of(status, lexicon_rows, "fee_status"))
    wide = records.select(
        F.col("record_id").alias("row_id"),
        F.col("case_id").alias("grp"),
        F.unix_micros(F.col("read_at").cast("timestamp")).alias("t"),
        *[entry_of(F.col(f), lexicon_rows, f).alias(f"e_{f}") for f in fields],
        fee_entry.cast("int").alias("e_fee_status"),
        *[absent(F.col(f)).alias(f"a_{f}") for f in fields],
        no_fee.alias("m_fee_status"),
    )
    wide = cut(wide)  # read by every step of the fill; values are resolved once
    missing = [(F.col(f"a_{f}") & F.col(f"e_{f}").isNull()).alias(f"m_{f}") for f in fields]  # a writing of absence that is an entry is a value
    return wide.select("row_id", "grp", "t", *[f"e_{f}" for f in fields], "e_fee_status", *missing, "m_fee_status")
