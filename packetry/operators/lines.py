"""Operators over a table of lines (packet, page, line_no, text): visibility, footers, boilerplate, titles, fields.

Windows are over one page or packet; a page is bounded by its document. Null texts are dropped where a text is needed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from packetry.functions.extract import pale
from packetry.functions.text import bind, strip

# Patterns of printed matter and of embedded instructions.
FOOTER = r"(?i)^packet\s+\S+\s*/\s*page\s*[0-9]"
INJECTION = r"(?i)system\s*:|answer\s*key|ignore\s+(all|visible|previous)|force\s+adjudication|output\s+this|barcode\s+payload"
ARCHIVED = r"(?i)archived\s+adjacent|not\s+active"
SMALLEST_SIZE = 6.5


def from_documents(documents: DataFrame, packet: str = "case_id", page: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines (packet, page, line_no, text) of whole texts; line_no counts from 1."""
    rows = documents.where(F.col(text).isNotNull()).select(F.col(packet).alias("packet"), F.col(page).alias("page"), F.posexplode(F.split(F.col(text), "\n")).alias("p", "text"))
    return rows.select("packet", "page", (F.col("p") + 1).alias("line_no"), "text")


def assemble(spans: DataFrame) -> DataFrame:
    """Lines of spans (packet, page, block, line, span, text, size, color, x0, y0, x1, y1, page_w, page_h).

    Blank spans go; texts are joined in order; size is the largest, color that of the first largest span; the box is the union; a
    line is hidden iff no span is visible; lines are numbered in reading order (top rounded to a tenth, then left).
    """
    inside = (F.col("x1") > 0) & (F.col("y1") > 0) & (F.col("x0") < F.col("page_w")) & (F.col("y0") < F.col("page_h"))
    rows = spans.where(F.trim("text") != "").withColumn("unseen", pale(F.col("color")) | (F.col("size") < SMALLEST_SIZE) | ~inside)
    lines = rows.groupBy("packet", "page", "block", "line").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("span", "text"))), lambda s: s["text"]), "").alias("text"),
        F.max("size").alias("size"), F.max_by("color", F.struct(F.col("size"), -F.col("span"))).alias("color"),
        F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"), F.bool_and("unseen").alias("hidden"),
    )
    order = Window.partitionBy("packet", "page").orderBy(F.round("y0", 1), "x0", "block", "line")
    return lines.withColumn("line_no", F.row_number().over(order)).drop("block", "line")


def footer(c: Column) -> Column:
    return F.coalesce(c.rlike(FOOTER), F.lit(False))


def injected(c: Column) -> Column:
    """Lines that bear embedded instructions; they are untrusted wherever they stand."""
    return F.coalesce(c.rlike(INJECTION), F.lit(False))


def boilerplate(lines: DataFrame, least_pages: int = 3, share: float = 0.8) -> DataFrame:
    """(packet, text) of the texts on at least max(2, share of pages) distinct pages of packets with enough pages."""
    pages = lines.groupBy("packet").agg(F.countDistinct("page").alias("pages")).where(F.col("pages") >= least_pages)
    on = lines.groupBy("packet", "text").agg(F.countDistinct("page").alias("n"))
    return on.join(pages, "packet").where(F.col("n") >= F.greatest(F.lit(2), F.floor(F.col("pages") * share))).select("packet", "text")


def without_boilerplate(lines: DataFrame) -> DataFrame:
    return lines.join(boilerplate(lines), ["packet", "text"], "left_anti").select(*lines.columns)


def titles(lines: DataFrame) -> DataFrame:
    """(packet, page, title): the first line that is neither blank nor a footer nor boilerplate; empty if there is none."""
    usable = without_boilerplate(lines).where((F.trim("text") != "") & ~footer(F.col("text")))
    first = usable.groupBy("packet", "page").agg(F.min_by("text", "line_no").alias("title"))
    pages = lines.select("packet", "page").distinct()
    return pages.join(first, ["packet", "page"], "left").select("packet", "page", F.coalesce("title", F.lit("")).alias("title"))


def unarchived(lines: DataFrame, skip: int = 3) -> DataFrame:
    """Lines without archived blocks: a marker drops itself and the next skip lines, and markers among these do not count.

    A marker more than skip lines after the marker before it counts for certain, so that runs of closer markers are judged by
    themselves: only the places of the markers of a run are folded, and lines look back to the last marker that counts.
    """
    page = ["packet", "page"]
    rows = lines.withColumn("_at", F.row_number().over(Window.partitionBy(*page).orderBy("line_no")))
    rows = rows.withColumn("_mark", F.coalesce(F.col("text").rlike(ARCHIVED), F.lit(False)))
    order = Window.partitionBy(*page).orderBy("_at")
    marks = rows.where("_mark").select(*page, "_at")
    far = F.coalesce(F.col("_at") - F.lag("_at").over(order) > skip, F.lit(True))
    runs = marks.withColumn("_run", F.sum(far.cast("int")).over(order)).groupBy(*page, "_run").agg(F.array_sort(F.collect_list("_at")).alias("_ats"))
    first = F.struct(F.lit(-(1 << 30)).alias("last"), F.array().cast("array<int>").alias("kept"))
    pick = lambda acc, x: F.when(x - acc["last"] > skip, F.struct(x.alias("last"), F.array_append(acc["kept"], x).alias("kept"))).otherwise(acc)
    counted = runs.select(*page, F.explode(F.aggregate("_ats", first, pick, lambda acc: acc["kept"])).alias("_at")).withColumn("_counts", F.lit(True))
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"m.{c}")) for c in page] + [F.col("l._at") == F.col("m._at")]
    joined = rows.alias("l").join(counted.alias("m"), same, "left").select("l.*", "m._counts")
    last = F.last(F.when(F.col("_counts"), F.col("_at")), True).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return joined.withColumn("_last", last).where("_last is null or _at - _last > " + str(skip)).select("packet", "page", "line_no", "text")


def unarchived_texts(texts: Column, skip: int = 3) -> Column:
    """The texts of one page in order, an array, without archived blocks; the rule of unarchived() folded over the places of the markers."""
    archived = lambda t: F.coalesce(t.rlike(ARCHIVED), F.lit(False))

    def rest(ts: Column) -> Column:
        places = F.filter(F.transform(ts, lambda t, i: F.when(archived(t), i)), lambda i: i.isNotNull())
        pick = lambda kept, i: F.when(F.coalesce(i - F.get(kept, F.size(kept) - 1) > skip, F.lit(True)), F.array_append(kept, i)).otherwise(kept)
        counted = F.aggregate(places, F.array().cast("array<int>"), pick)
        return bind(counted, lambda marks: F.filter(ts, lambda _, i: ~F.exists(marks, lambda m: (i - m).between(0, skip))))

    return bind(texts, lambda ts: F.when(F.exists(ts, archived), rest(ts)).otherwise(ts))


def active_pages(lines: DataFrame, id_pattern: str = r"MIB-[0-9]{4,}") -> DataFrame:
    """Pages whose first id is the packet's or absent; all pages of a packet where none is."""
    found = F.nullif(F.regexp_extract("text", id_pattern, 0), F.lit(""))
    first = lines.groupBy("packet", "page").agg(F.min_by(found, F.when(found.isNotNull(), F.col("line_no"))).alias("id"))
    first = first.withColumn("match", F.coalesce(F.col("id").isNull() | (F.col("id") == F.col("packet")), F.lit(False)))
    some = first.groupBy(F.col("packet").alias("of")).agg(F.max("match").alias("some"))
    return first.join(some, F.col("packet").eqNullSafe(F.col("of"))).where(F.col("match") | ~F.col("some")).select("packet", "page", "id")


def scan_gate(pages: DataFrame, lines: DataFrame, least_chars: int = 40) -> DataFrame:
    """Pages (packet, page, n_images) that need reading again: images, but fewer than least_chars meaningful characters."""
    chars = without_boilerplate(lines).where(~footer(F.col("text"))).groupBy("packet", "page").agg(F.sum(F.length(F.trim("text"))).alias("chars"))
    rows = pages.join(chars, ["packet", "page"], "left")
    return rows.where((F.coalesce("chars", F.lit(0)) < least_chars) & (F.col("n_images") > 0)).select("packet", "page")


def inline_fields(lines: DataFrame) -> DataFrame:
    """(packet, page, label, value) of "label: value" lines; the last of equal labels on a page holds."""
    at = F.locate(":", "text")
    rows = lines.where(at > 1).select("packet", "page", "line_no", strip(F.substr("text", F.lit(1), at - 1)).alias("label"), strip(F.substr("text", at + 1)).alias("value"))
    return rows.where("value <> ''").groupBy("packet", "page", "label").agg(F.max_by("value", "line_no").alias("value"))


def vertical_fields(lines: DataFrame, labels: dict[str, str], typed: dict[str, str], placeholders: tuple[str, ...] = (), trap: Callable[[Column], Column] | None = None) -> DataFrame:
    """(packet, page, field, value) of labels with their value on the next or the previous line.

    Both readings are made; the page keeps the one with more values of the right type (typed: field to pattern) less placeholders;
    ties go to the line below. The first of equal fields holds. What trap finds is never a value, like a placeholder.
    """
    w = Window.partitionBy("packet", "page").orderBy("line_no")
    names = F.create_map(*[x for label, field in labels.items() for x in (F.lit(label), F.lit(field))])
    rows = lines.withColumn("below", F.lead("text").over(w)).withColumn("above", F.lag("text").over(w))
    rows = rows.withColumn("field", F.try_element_at(names, F.regexp_replace(F.trim("text"), ":+$", ""))).where("field is not null")
    long = rows.select("packet", "page", "line_no", "field", F.inline(F.array(F.struct(F.lit(1).alias("way"), F.trim("below").alias("value")), F.struct(F.lit(0).alias("way"), F.trim("above").alias("value")))))
    is_label = F.try_element_at(names, F.regexp_replace("value", ":+$", "")).isNotNull()
    long = long.where(F.col("value").isNotNull() & (F.col("value") != "") & ~is_label & ~F.lower("value").isin(*(placeholders or ("",))))
    long = long.where(~trap(F.col("value"))) if trap else long
    long = long.groupBy("packet", "page", "way", "field").agg(F.min_by("value", "line_no").alias("value"))
    fits = F.lit(False)
    for field, pattern in typed.items():
        fits = fits | ((F.col("field") == field) & F.col("value").rlike(pattern))
    score = long.groupBy("packet", "page", "way").agg(F.sum(fits.cast("int")).alias("score"))
    best = score.groupBy("packet", "page").agg(F.max_by("way", F.struct("score", "way")).alias("way"))
    return long.join(best, ["packet", "page", "way"]).select("packet", "page", "field", "value")


def stacked_cells(texts: Column, labels: dict[str, str], typed: dict[str, str], trap: Callable[[Column], Column]) -> Column:
    """Array of struct(field, value) of the texts of one page in order, an array, by the rule of vertical_fields()."""
    names = F.create_map(*[x for label, field in labels.items() for x in (F.lit(label), F.lit(field))])
    name = lambda t: F.try_element_at(names, F.when(t.endswith(":"), F.regexp_replace(t, ":+$", "")).otherwise(t))
    none = F.array().cast("array<struct<field:string,value:string>>")

    def fits(c: Column) -> Column:
        out = F.lit(False)
        for field, pattern in typed.items():
            out = out | ((c["field"] == field) & c["value"].rlike(pattern))
        return out

    def read(ts: Column, fields: Column) -> Column:
        def way(step: int) -> Column:
            cells = F.transform(fields, lambda f, i: F.struct(f.alias("field"), F.trim(F.get(ts, i + step)).alias("value")))
            return first_cells(F.filter(cells, lambda c: c["field"].isNotNull() & c["value"].isNotNull() & (c["value"] != "") & name(c["value"]).isNull() & ~trap(c["value"])))

        best = lambda r: F.when((F.size(r["above"]) == 0) | ((F.size(r["below"]) > 0) & (F.size(F.filter(r["below"], fits)) >= F.size(F.filter(r["above"], fits)))), r["below"]).otherwise(r["above"])
        return bind(F.struct(way(1).alias("below"), way(-1).alias("above")), best)

    return bind(texts, lambda ts: bind(F.transform(ts, lambda t: name(F.trim(t))), lambda fields: F.when(F.exists(fields, lambda f: f.isNotNull()), read(ts, fields)).otherwise(none)))


def first_cells(cells: Column, key: str = "field") -> Column:
    """An array of structs without those whose key came before."""
    return bind(cells, lambda cs: bind(F.transform(cs, lambda c: c[key]), lambda ks: F.filter(cs, lambda c, i: F.array_position(ks, c[key]) == i + 1)))


def page_types(titled: DataFrame, rules: list[tuple[str, str]], text: str = "title", rest: str = "untyped") -> DataFrame:
    """Add page_type: the first rule (pattern, type) that matches."""
    kind = F.lit(rest)
    for pattern, name in reversed(rules):
        kind = F.when(F.col(text).rlike(pattern), name).otherwise(kind)
    return titled.withColumn("page_type", kind)


def legible(lines: DataFrame, pattern: str) -> DataFrame:
    """(packet, page, legibility): number of lines that match a typed pattern."""
    return lines.groupBy("packet", "page").agg(F.count_if(F.coalesce(F.col("text").rlike(pattern), F.lit(False))).alias("legibility"))


def split_visible(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(visible, hidden) lines; a line without the mark is visible."""
    gone = F.coalesce("hidden", F.lit(False))
    return lines.where(~gone), lines.where(gone)


def page_texts(lines: DataFrame) -> DataFrame:
    """(packet, page, text) of the visible lines of each page, joined by line feeds in order."""
    seen, _ = split_visible(lines)
    rows = seen.where("text is not null").groupBy("packet", "page").agg(F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("l"))
    return rows.select("packet", "page", F.array_join("l.text", "\n").alias("text"))


def scanned(lines: DataFrame, printed: tuple[str, ...] = (), starts: tuple[str, ...] = ("Packet ",)) -> DataFrame:
    """(packet, scanned): whether a packet has no visible line besides printed matter (whole lines, or openings of lines)."""
    c = F.col("text")
    plain = c.isNotNull() & ~c.isin(*(printed or ("",)))
    for s in starts:
        plain = plain & ~c.startswith(s)
    plain = plain & ~F.coalesce("hidden", F.lit(False)) if "hidden" in lines.columns else plain
    return lines.groupBy("packet").agg((~F.coalesce(F.bool_or(plain), F.lit(False))).alias("scanned"))


def united(first: DataFrame, more: DataFrame) -> DataFrame:
    """Lines of a page with those of another reading behind them that it does not hold yet, in order, each text once."""
    rows = first.select("packet", "page", F.lit(0).alias("_pass"), "line_no", "text").unionByName(more.select("packet", "page", F.lit(1).alias("_pass"), "line_no", "text"))
    once = rows.groupBy("packet", "page", "text").agg(F.min(F.struct("_pass", "line_no")).alias("_o"))
    order = Window.partitionBy("packet", "page").orderBy("_o", "text")
    return once.select("packet", "page", F.row_number().over(order).alias("line_no"), "text")


def stamp(lines: DataFrame, words: list[str], override: str, colors: list[int], smallest: float = 15.0, largest: float = 25.0) -> DataFrame:
    """(packet, verdict) of visible coloured stamps: the override word if stamped, else the only word, else null."""
    rows = lines.where(~F.col("hidden") & F.col("size").between(smallest, largest) & F.trim("text").isin(*words) & F.col("color").isin(*colors))
    seen = rows.groupBy("packet").agg(F.collect_set(F.trim("text")).alias("v"))
    return seen.select("packet", F.when(F.array_contains("v", override), override).when(F.size("v") == 1, F.get("v", F.lit(0))).alias("verdict"))


def frequent_id(lines: DataFrame, pattern: str) -> DataFrame:
    """(packet, id): the most frequent id in its lines that bear no instructions; ties go to the first seen."""
    ids = lines.where(~injected(F.col("text"))).select("packet", "page", "line_no", F.posexplode(F.regexp_extract_all("text", F.lit(pattern), F.lit(0))).alias("at", "id"))
    counts = ids.groupBy("packet", "id").agg(F.count("*").alias("n"), F.min(F.struct("page", "line_no", "at")).alias("first"))
    return counts.groupBy("packet").agg(F.min_by("id", F.struct(-F.col("n"), F.col("first"))).alias("id"))
