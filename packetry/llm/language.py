"""Missing or wrong document language labels: nearest centroid over normalised TF-IDF vectors of character n-grams.

A classifier is fitted on at most ``sample`` labelled documents per language (the bound is a parameter). Wrong labels among them are
cast out first: documents whose nearest single centroid is another language's leave the fit. The rest of each language is split by
spherical k-means into several centroids. A line gets the language of the centroid with the highest cosine; a line too far from all
centroids, or of few words, is not accepted by itself: such lines in a row are read together, among the languages of the accepted
lines, and those without any word follow the line before. A text whose accepted lines clearly
agree is of one language; otherwise each line that is not blank is a segment of its own.

Rejection: a text, or a line of a text in several languages, with enough words in small letters that lies too far from every centroid
is in none of the languages; its language is null and its confidence 0. Too far means a cosine below FAR times what all but
one in a hundred of the training lines reach.

Classification is one map over all documents and whole texts; the fitted table (bounded by its number of features and centroids)
travels with the tasks.

Defined results: null, empty, blank and wordless texts have no language (no segments); documents without id are kept with a null
id; repeated texts are all classified; very long texts are cut into blocks of lines; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Writings of the languages (codes of two and three letters, English name).
LANGUAGES = {
    "en": ("en", "eng", "english"), "de": ("de", "deu", "ger", "german"), "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish"), "pt": ("pt", "por", "portuguese"), "it": ("it", "ita", "italian"),
    "nl": ("nl", "nld", "dut", "dutch"), "sv": ("sv", "swe", "swedish"), "ru": ("ru", "rus", "russian"),
}
NAMES = sorted(LANGUAGES)
#: Features are n-grams of these lengths hashed into so many slots.
GRAMS, SLOTS = (1, 2, 3), 1 << 14
#: Share of the cosine of nearly all training lines below which a line is in none of the languages.
FAR = 0.4
#: Largest block of characters worked on at once.
BLOCK = 400_000

_IDS = regex.compile(r"\b\p{Lu}{2,4}-\d\w*")
_WORD = regex.compile(r"(?<![\w])\p{L}{2,}(?![\w])")
_NOT_LETTER = regex.compile(r"[^\p{L}]+")
#: Words in capitals within a line, most of them names, which are of no language.
_NAMES = regex.compile(r"(?<=\S\s+)\p{Lu}[\p{L}\p{M}'’-]*+")


def label_language(c: Column) -> Column:
    """Language a label names in any writing; null where it names none of them."""
    key = F.regexp_replace(F.lower(F.trim(F.regexp_replace(c, r"[\s ]+", " "))), "[-_].*$", "")
    names = [x for lang, writings in LANGUAGES.items() for w in writings for x in (F.lit(w), F.lit(lang))]
    return F.try_element_at(F.create_map(*names), key)


def _small_words(line: str) -> int:
    return sum(w[0].islower() for w in _WORD.findall(_IDS.sub(" ", line)))


def _clean(line: str, least_words: int = 3) -> str:
    """Small letters with single blanks between words. Names within a line that has words enough besides them are left out."""
    if _small_words(line) >= least_words:
        line = _NAMES.sub(" ", line)
    return " " + _NOT_LETTER.sub(" ", _IDS.sub(" ", line).lower()).strip() + " "


def vectors(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(line, slot, weight) of the n-gram counts of cleaned lines; weight is 1 + log(count)."""
    text = "".join(lines)
    chars = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64)
    sizes = np.fromiter(map(len, lines), dtype=np.int64, count=len(lines))
    owner = np.repeat(np.arange(len(lines)), sizes)
    keys = []
    for n in GRAMS:
        if len(chars) < n:
            continue
        h = np.full(len(chars) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h ^ chars[i : len(chars) - n + 1 + i]) * np.uint64(0x100000001B3)
            h ^= h >> np.uint64(29)
        inside = owner[: len(h)] == owner[n - 1 :]
        keys.append((owner[: len(h)][inside] * SLOTS) + (h[inside] % np.uint64(SLOTS)).astype(np.int64))
    if not keys:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none.astype(np.float32)
    key, count = np.unique(np.concatenate(keys), return_counts=True)
    return key // SLOTS, key % SLOTS, (1 + np.log(count)).astype(np.float32)


class Centroids:
    """Fitted classifier: idf by slot, and unit centroids with the language of each."""

    def __init__(self, idf: np.ndarray, table: np.ndarray, langs: list[str], far: float):
        self.idf, self.table, self.langs, self.far = idf, table, langs, far
        self.names = sorted(set(langs))
        self.groups = [np.array([i for i, x in enumerate(langs) if x == n]) for n in self.names]

    def cosines(self, lines: list[str]) -> np.ndarray:
        """Highest cosine to each language's centroids, one row per cleaned line."""
        out = np.zeros((len(lines), len(self.names)), dtype=np.float32)
        row, slot, w = vectors(lines)
        if not len(row):
            return out
        w = w * self.idf[slot]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        norm = np.sqrt(np.add.reduceat(w * w, starts))
        dots = np.add.reduceat(self.table[slot] * w[:, None], starts, axis=0) / np.maximum(norm, 1e-9)[:, None]
        for g, members in enumerate(self.groups):
            out[row[starts], g] = dots[:, members].max(axis=1)
        return out

    def segments(self, text: str | None) -> list[tuple[int, str, float]]:
        """(segment number, language, confidence): one segment 0, or one per line that is not blank, or none."""
        return self.many([text])[0]

    def many(self, texts: list[str | None]) -> list[list[tuple[int, str, float]]]:
        lines: list[str] = []
        spans: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]] = []
        for text in texts:
            own = [x for x in (text or "").split("\n") if x.strip()]
            found = [_WORD.findall(_IDS.sub(" ", x)) for x in own]
            words = np.array([len(f) for f in found], dtype=np.int64)
            small = np.array([sum(w[0].islower() for w in f) for f in found], dtype=np.int64)
            plain = np.where([x.isupper() for x in own], words, small) if own else small
            spans.append((len(lines), len(lines) + len(own), words, plain, small))
            lines += map(_clean, own)
        scores = np.zeros((len(lines), len(self.names)), dtype=np.float32)
        at = 0
        while at < len(lines):  # blocks of whole lines
            to, chars = at, 0
            while to < len(lines) and (to == at or chars + len(lines[to]) <= BLOCK):
                chars += len(lines[to])
                to += 1
            scores[at:to] = self.cosines(lines[at:to])
            at = to
        return [self._judge(scores[a:b], words, plain, small) for a, b, words, plain, small in spans]

    def _judge(self, s: np.ndarray, words: np.ndarray, plain: np.ndarray, small: np.ndarray, least_words: int = 3, margin: float = 0.04) -> list[tuple[int, str | None, float]]:
        """plain counts the words of each line that are not names (all words of a line in capitals), small those in small letters."""
        if not words.sum():
            return []
        order = np.argsort(-s, axis=1)
        every = np.arange(len(s))
        top, second = s[every, order[:, 0]], s[every, order[:, 1]] if s.shape[1] > 1 else np.zeros(len(s))
        # A line in capitals may be a label with a name, which says little: it needs five words and half as much again.
        firm = (small >= least_words) & (top >= self.far) | (plain >= 5) & (top >= 1.5 * self.far)
        foreign = (small >= least_words) & (top < self.far)
        whole = (s * words[:, None]).sum(axis=0) / words.sum()
        main = int(whole.argmax())
        other = firm & (order[:, 0] != main) & (top - s[:, main] >= np.minimum(margin, top / 10))
        share = lambda a, b: round(float(a / max(a + b, 1e-9)), 4)
        if not other.any():
            rest = np.delete(whole, main)
            if whole[main] < self.far and small.sum() >= least_words:
                return [(0, None, 0.0)]
            return [(0, self.names[main], share(whole[main], rest.max() if len(rest) else 0.0))]
        here = sorted({int(x) for x in order[firm, 0]} | {main})  # the languages of the text, which its short lines choose from
        picks = np.where(firm, order[:, 0], -1)
        i = 0
        while i < len(s):
            if firm[i]:
                i += 1
                continue
            j = i
            while j < len(s) and not firm[j]:
                j += 1
            pool = (s[i:j] * np.minimum(words[i:j], 1)[:, None]).sum(axis=0)  # short lines in a row are read as one
            if pool.any():
                picks[i:j] = here[int(pool[here].argmax())]
            else:
                picks[i:j] = picks[i - 1] if i else order[j, 0] if j < len(s) else main
            i = j
        out = []
        for i, p in enumerate(picks):
            rest = max((float(s[i, h]) for h in here if h != p), default=0.0)
            out.append((i + 1, None, 0.0) if foreign[i] else (i + 1, self.names[p], share(s[i, p], rest) if words[i] else 0.0))
        return out


def fit(rows: list[tuple[str, str]], centroids: int = 3, rounds: int = 6, seed: int = 7) -> Centroids:
    """Fit on (language, text) pairs; without any pair every text with words is taken for the first of NAMES."""
    if not rows:
        return Centroids(np.ones(SLOTS, np.float32), np.zeros((SLOTS, 1), np.float32), NAMES[:1], 0.0)
    rows = sorted(rows)
    texts, langs = [" ".join(map(_clean, t.split("\n"))) for _, t in rows], np.array([x for x, _ in rows])
    n_texts = len(texts)
    parts = [(i, *vectors(texts[i : i + 100])) for i in range(0, n_texts, 100)]
    row, slot = np.concatenate([i + r for i, r, *_ in parts]), np.concatenate([x.astype(np.int32) for *_, x, _ in parts])
    w = np.concatenate([x for *_, x in parts])
    seen = np.bincount(slot, minlength=SLOTS)
    idf = np.log((1 + n_texts) / (1 + seen)).astype(np.float32) + 0.1
    w = w * idf[slot]
    w /= np.maximum(np.sqrt(np.bincount(row, w * w, n_texts)), 1e-9).astype(np.float32)[row]
    starts = np.searchsorted(row, np.arange(n_texts + 1))
    names = sorted(set(langs.tolist()))
    unit = lambda m: m / np.maximum(np.linalg.norm(m, axis=-1, keepdims=True), 1e-9)

    def dots(table: np.ndarray) -> np.ndarray:
        """Cosines of all texts to the columns of a table; some texts at a time, so that memory stays small."""
        out = np.zeros((n_texts, table.shape[1]), dtype=np.float32)
        for a in range(0, n_texts, 200):
            lo, hi = starts[a], starts[min(a + 200, n_texts)]
            if lo < hi:
                cuts = np.flatnonzero(np.r_[True, row[lo + 1 : hi] != row[lo : hi - 1]])
                out[row[lo:hi][cuts]] = np.add.reduceat(table[slot[lo:hi]] * w[lo:hi, None], cuts, axis=0)
        return out

    def mean(mask: np.ndarray) -> np.ndarray:
        held = mask[row]
        return (np.bincount(slot[held], w[held], SLOTS) / max(1, mask.sum())).astype(np.float32)

    keep = np.ones(n_texts, dtype=bool)
    for _ in range(3):  # cast out wrong labels
        single = unit(np.stack([mean(keep & (langs == n)) for n in names]))
        keep = np.array(names)[dots(np.ascontiguousarray(single.T)).argmax(axis=1)] == langs
    table, owner = [], []
    rng = np.random.default_rng(seed)
    for n in names:
        ids = np.flatnonzero(keep & (langs == n))
        if not len(ids):
            continue
        mine = np.zeros((len(ids), SLOTS), dtype=np.float32)
        for j, i in enumerate(ids):
            mine[j, slot[starts[i] : starts[i + 1]]] = w[starts[i] : starts[i + 1]]
        k = min(centroids, len(mine))
        c = mine[rng.choice(len(mine), k, replace=False)]
        for _ in range(rounds):
            near = (mine @ c.T).argmax(axis=1)
            c = unit(np.stack([mine[near == i].mean(axis=0) if (near == i).any() else c[i] for i in range(k)]))
        table.append(c)
        owner += [n] * k
    full = np.concatenate(table) if table else np.zeros((1, SLOTS), dtype=np.float32)
    model = Centroids(idf, np.ascontiguousarray(full.T.astype(np.float32)), owner or ["en"], 0.0)
    own = [x for (_, t), k in zip(rows, keep) if k for x in t.split("\n") if _small_words(x) >= 3]
    if own:
        model.far = FAR * float(np.quantile(np.concatenate([model.cosines([_clean(x) for x in own[i : i + 2000]]).max(axis=1) for i in range(0, len(own), 2000)]), 0.01))
    return model


def training_rows(documents: DataFrame, sample: int = 400, seed: int = 42, least_chars: int = 41) -> list[tuple[str, str]]:
    """About sample labelled documents per language of at least least_chars characters, twice as many at most over all languages, picked by
    the hash of their id; texts are whole. Counts come from the column n_chars where there is one, so that texts are read for the draw only.
    """
    size = F.col("n_chars") if "n_chars" in documents.columns else F.length("text")
    labelled = documents.select("doc_id", "text", size.alias("size"), label_language(F.col("lang")).alias("l")).where("l is not null").where(F.col("size") >= least_chars)
    counts = {r["l"]: r["n"] for r in labelled.groupBy("l").agg(F.count("*").alias("n")).collect()}
    labelled = labelled.where("text is not null")
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1_000_000))
    pick = F.lit(False)
    for lang, n in sorted(counts.items()):
        pick = pick | ((F.col("l") == lang) & (draw < int(min(1_000_000, 1_000_000 * sample / n))))
    return [(r["l"], r["text"]) for r in labelled.where(pick).select("l", "text").limit(2 * sample * len(LANGUAGES)).collect()]


def segments(documents: DataFrame, sample: int = 400) -> DataFrame:
    """(doc_id, label, segment_no, lang, confidence): segment 0 for a text in one language, else one row per line that is not blank."""
    model = fit(training_rows(documents, sample))
    shared = documents.sparkSession.sparkContext.broadcast(model)  # SLOTS x (languages x centroids) numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        judge = shared.value
        for pdf in batches:
            for a in range(0, len(pdf), 256):
                part = pdf.iloc[a : a + 256]
                found = judge.many([t if isinstance(t, str) else None for t in part["text"]])
                rows = [(d, x, *seg) for d, x, segs in zip(part["doc_id"], part["label"], found) for seg in segs]
                yield pd.DataFrame(rows, columns=["doc_id", "label", "segment_no", "lang", "confidence"])

    return documents.select("doc_id", label_language(F.col("lang")).alias("label"), "text").mapInPandas(run, "doc_id bigint, label string, segment_no int, lang string, confidence double")


def found(documents: DataFrame, sample: int = 400) -> DataFrame:
    """(doc_id, segment_no, lang) of texts whose label is absent or wrong, and of every line of texts in several languages; what is in none
    of the languages has no row."""
    return segments(documents, sample).where("lang is not null and (segment_no > 0 or label is null or label <> lang)").select("doc_id", "segment_no", "lang")
