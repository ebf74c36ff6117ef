"""Names, canonical mapping, survivors, tokens, mixing and languages: brute force, round trips, held-out accuracy, edge cases."""

import base64
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import CODE_LIST, DATA, at, got, records
from packetry.functions.lexicon import Lexicon
from packetry.llm import canonical, language, mixing, names, queries, survivor, tokens
from packetry.runtime import table

# Encoding

@pytest.fixture(scope="module")
def both():
    tiktoken = pytest.importorskip("tiktoken")
    machine = tokens.transducer()
    return machine, tiktoken.Encoding("own", pat_str=tokens.PATTERN, mergeable_ranks=machine.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=200))
def test_encoding_is_the_published_one(both, text):
    machine, brute = both
    assert machine.encode(text) == brute.encode_ordinary(text)


def test_encoding_of_one_endless_word_and_of_full_tables(both, monkeypatch):
    machine, brute = both
    rng = random.Random(1)
    word = "".join(rng.choice("abcdefghij") for _ in range(3000))
    assert machine.encode(word) == brute.encode_ordinary(word)
    monkeypatch.setattr(tokens, "MAX_STATES", 40)
    small = tokens.Transducer(machine.ranks)
    assert small.encode(word) == brute.encode_ordinary(word) and len(small.states) <= 41
    assert len(machine.encode("a" * 300_000)) == 300_000 // 4


def test_encoding_of_many_short_words_with_full_tables(both, monkeypatch):
    machine, brute = both
    monkeypatch.setattr(tokens, "MAX_STATES", 40)
    small, rng = tokens.Transducer(machine.ranks), random.Random(3)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6))) for _ in range(4000)]
    assert [w for w in words if small.encode(w) != brute.encode_ordinary(w)] == []


def test_stream_decoding(both):
    machine, _ = both
    text = "naïve — Дело 🛸 日本 <|endoftext|>"
    back = {v: k for k, v in machine.ranks.items()}
    assert "".join(tokens.decode_stream(machine.encode(text), back)) == text
    for data in (b"\xff a\xc3", b"\xe0\x80\x80", b"\xed\xa0\x80", b"\xf4\x90\x80\x80x", b"\xf0\x9f\x9b\xb8"):
        d = tokens.Utf8Decoder()
        assert "".join(d.feed(bytes([b])) for b in data) + d.end() == data.decode("utf-8", "replace")


def test_encoded_rows(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "a b", "x"), (3, "a b", "x"), (None, "é", "x")], "doc_id bigint, text string, ids string")
    out = tokens.encoded(df)
    assert out.dtypes == [("doc_id", "bigint"), ("ids", "array<int>")]
    rows = sorted(((r.doc_id or 0), list(r.ids)) for r in out.collect())
    assert rows[1:3] == [(1, []), (2, [])] and rows[3] == rows[4] and len(rows) == 5
    assert tokens.encoded(df.limit(0)).count() == 0
    assert base64.b64encode(b"a")  # rank files are base64


# Mixing

def sizes(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint")


def test_mixture_meets_shares_and_caps(spark):
    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), rng.randint(0, 400)) for i in range(6000)]
    df = sizes(spark, rows)
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.35, 5), ("c", 0.25, 1), ("d", 0.1, 3)], "source string, target_share double, max_repeats int")
    plan = {r.source: r for r in mixing.rates(df, targets).collect()}
    total = sum(r[2] for r in rows)
    out = mixing.sampled(df, mixing.rates(df, targets)).collect()
    per = {s: sum(r.copies * r.n_tokens for r in out if r.source == s) for s in "abcd"}
    assert abs(per["a"] / total - 0.3) < 0.005 and abs(per["b"] / total - 0.35) < 0.005
    have_c = sum(r[2] for r in rows if r[1] == "c")
    assert per["c"] == have_c and have_c < 0.25 * total and per["d"] == 0  # the cap binds exactly
    assert all(r.copies <= plan[r.source].max_repeats and r.n_tokens > 0 for r in out)
    # exactly the whole numbers crossed by the running sum
    assert all(r.copies in (int(plan[r.source].expected), int(plan[r.source].expected) + 1) for r in out)


def test_mixture_edges(spark):
    targets = spark.createDataFrame([("a", None, 2), (None, 0.5, 2), ("b", 1.0, None)], "source string, target_share double, max_repeats int")
    df = sizes(spark, [(1, "a", 5), (2, "b", 5), (3, None, 5), (4, "b", 0)])
    out = {r.doc_id: r.copies for r in mixing.sampled(df, mixing.rates(df, targets)).collect()}
    assert out == {2: 3}  # 15 tokens wanted of 5
    assert mixing.sampled(df.limit(0), mixing.rates(df.limit(0), targets)).count() == 0


def test_shares_report(spark):
    out = queries.p8_shares(spark, DATA).collect()
    assert abs(sum(r.actual_share for r in out) - 1) < 1e-9 and all(r.most_copies <= r.max_repeats for r in out)


# Canonical list

def test_trie_search_is_the_scan(spark):
    scan, trie = Lexicon(CODE_LIST), canonical.Matcher(CODE_LIST)
    rng = random.Random(2)
    letters = "abcdefghijklmnopqrstuvwxyz015 -_"
    for _ in range(1500):
        _, field, value, *_ = rng.choice(CODE_LIST)
        s = list(value)
        for _ in range(rng.randint(0, 4)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice(letters) * rng.randint(0, 1)
        s = "".join(s)
        assert scan.resolve(field, s) == trie.resolve(field, s), s


def test_mapped(spark):
    rows = [{"species_code": "TARN_WEAVER", "home_world": "velm 12C", "visa_class": "KX-7", "risk_flags": '"orbit_ban"; summons open, nonsense here; nonsense too'},
            {"species_code": None, "home_world": "", "visa_class": "?", "risk_flags": "none"}, {"visa_class": "K" * 100_000, "risk_flags": None}]
    assert got(canonical.mapped(records(spark, rows), CODE_LIST), "record_id", "field_name", "entry_id") == sorted([(1, "home_world", 201), (1, "visa_class", 0), (1, "risk_flags", 503), (1, "risk_flags", 0), (3, "visa_class", 0)], key=repr)
    assert canonical.mapped(records(spark, rows[:0]), CODE_LIST).count() == 0
    assert got(canonical.unmatched(records(spark, rows[:2]), CODE_LIST), "field_name", "value", "n_records") == [("visa_class", "KX-7", 1)]


def test_unmatched_items(spark):
    rows = [{"risk_flags": '"orbit_ban"; summons open, nonsense here; nonsense too; nonsense here'}, {"risk_flags": "nonsense here"}, {"risk_flags": "none"}, {"risk_flags": "memory_edit"}, {"risk_flags": None}]
    assert got(canonical.unmatched_items(records(spark, rows), CODE_LIST), "field_name", "value", "n_records") == [("risk_flags", "nonsense here", 2), ("risk_flags", "nonsense too", 1)]
    assert canonical.unmatched_items(records(spark, rows[:0]), CODE_LIST).count() == 0


def test_unmatched_covers_the_fields_of_found(spark):
    lost = queries.p4_found(spark, DATA).where("entry_id = 0").select("field_name").distinct()
    fields = {r[0] for r in lost.collect()}
    assert canonical.FLAGS in fields and {r[0] for r in queries.p4_unmatched(spark, DATA).select("field_name").distinct().collect()} == fields


# Survivors

TRUST = [("correction", 1), ("intake", 2), ("registry", 5), ("damaged", None)]


def trust(spark):
    return spark.createDataFrame(TRUST, "source_name string, trust_rank int")


def test_survivors(spark):
    src = lambda s: {"sponsor_id": s, "arrival_date": s}
    rows = [
        {"case_id": "A", "sponsor_id": "SPN-0001", "field_sources": src("registry"), "read_at": at(3)}, {"case_id": "A", "sponsor_id": "SPN-0002", "field_sources": src("intake"), "read_at": at(1)},
        {"case_id": "A", "sponsor_id": "SPN-0003", "field_sources": src("intake"), "read_at": at(2), "corrections": {"arrival_date": "now 2026-02-30 or 2026-02-03, desk 1"}}, {"case_id": "A", "sponsor_id": "SPN-0004", "field_sources": src("damaged"), "read_at": at(9)},
        {"case_id": "B", "sponsor_id": "SPN-0005"}, {"case_id": None, "sponsor_id": "SPN-0006"}, {"case_id": None, "sponsor_id": "SPN-0006"},
        {"case_id": "C", "sponsor_id": "SPN-0008", "read_at": at(1)}, {"case_id": "C", "sponsor_id": "SPN-0007", "read_at": at(1)}, {"case_id": "C", "sponsor_id": "SPN-77", "field_sources": src("intake")}, {"case_id": "C", "corrections": None, "field_sources": None},
    ]
    df = records(spark, rows)
    out = got(survivor.survivors(df, trust(spark)), "case_id", "field_name", "kept_value")
    assert [x for x in out if x[0] == "A"] == [("A", "arrival_date", "2026-02-03"), ("A", "sponsor_id", "SPN-0003")]
    assert [x[0:2] for x in out if x[0] != "A"] == [("C", "sponsor_id")]
    assert survivor.survivors(df.limit(0), trust(spark)).count() == 0


def test_quality_is_recovered_by_em():
    rng = random.Random(4)
    true = [(0.95, 0.9), (0.6, 0.9), (0.9, 0.5)]
    counts = {}
    for _ in range(20_000):
        z = rng.random() < 0.5
        said = sum((rng.random() < (s if z else 1 - p)) << i for i, (s, p) in enumerate(true))
        counts[said, 7] = counts.get((said, 7), 0) + 1
    post, quality = survivor.infer([(s, c, n) for (s, c), n in sorted(counts.items())], 3, 500)
    assert all(abs(a - b) < 0.06 for q, t in zip(quality, true) for a, b in zip(q, t)) and post[7, 7] > 0.9 > 0.3 > post[0, 7]


# Languages

def test_languages_on_held_out_labels(spark):
    d = table(spark, DATA.replace("0.001", "0.01"), "documents")
    fitted = language.fit(language.training_rows(d.where("doc_id % 2 = 0"), 100))
    rest = d.where("doc_id % 2 = 1 and length(text) > 40").select(language.label_language(F.col("lang")).alias("l"), "text").where("l is not null").collect()
    single = [(r.l, s[0][1]) for r, s in zip(rest, fitted.many([r.text for r in rest])) if len(s) == 1 and s[0][0] == 0]
    assert sum(a == b for a, b in single) / len(single) > 0.85  # about a tenth of the delivered labels are wrong


def test_language_segments(spark):
    d = table(spark, DATA.replace("0.001", "0.01"), "documents")
    f = language.fit(language.training_rows(d, 100))
    en, de, ru = "The night inspector copied the list of cargo without asking the applicant.", "Das Meldeamt verlor den Brief ohne den Antragsteller zu fragen.", "Наш переводчик отметил указанную цель, не спросив заявителя."
    assert [x[:2] for x in f.segments(en)] == [(0, "en")] and [x[:2] for x in f.segments(f"Case: MIB-000001\n{en}\n\n{en}")] == [(0, "en")]
    assert [x[:2] for x in f.segments(f"{en}\n\n{de}\nSPN-0001\n{ru}")] == [(1, "en"), (2, "de"), (3, "de"), (4, "ru")]
    assert f.segments(None) == f.segments("") == f.segments(" \t\n") == f.segments("### 2026-02-17\n0.00 MIB-000001") == []
    long = f.segments("\n".join([de] * 8000 + [en]))
    assert len(long) == 8001 and long[0][1] == "de" and long[-1][1] == "en"
    assert all(0 <= c <= 1 for _, _, c in long)


def test_label_writings(spark):
    df = spark.createDataFrame([(x,) for x in ("en-GB", " ENG ", "fr_CA", "German", "por", "und", "", None, "bg", "?")], "lang string")
    assert [r[0] for r in df.select(language.label_language(F.col("lang"))).collect()] == ["en", "en", "fr", "de", "pt", None, None, None, None, None]


def test_found_languages_on_empty_table(spark):
    d = table(spark, DATA, "documents")
    assert language.found(d.where("doc_id < 0")).count() == 0


# Names

@pytest.mark.parametrize("name,forms", [
    ("Pele Virfoash", [("pele", "virfoash", 0)]), ("Virfoash, Pele", [("pele", "virfoash", 0)]), ("VIRFOASH Pele", [("pele", "virfoash", 0)]), ("Virfoash Pele", [("pele", "virfoash", 0)]), ("Rev. P. Virfoash, Esq.", [("p", "virfoash", 2)]),
    ("Pelo Virfoash", [("pele", "virfoash", 0)]), ("Wofosie Zum-Skul jr", [("wofosie", "zumskul", 0)]), ("Wofo. Zumskul", [("wofosie", "zumskul", 0)]), ("Muth Zumskul", [("wofosie", "zumskul", 0)]), ("P. (Pelkin) Zumskul", [("pele", "zumskul", 0)]),
    ("Gurux Zumskul", [("gurux", "zumskul", 1)]), ("Pele Wofosie Zumskul", [("pele", "zumskul", 0)]), ("Zumskul Pele Wofosie", [("pele", "zumskul", 0)]), ("Zumskul", []), (None, []), ("", []), ("[NAME HIDDEN]", []), ("Rev. Dr.", []), (",", []),
])
def test_forms(name, forms):
    reader = names.Reader(names.Givens([("Wofosie", "Muth"), ("Pele", "Pelkin")], [("pele", 50), ("wofosie", 40)], []))
    assert [f[:3] for f in reader.forms(name)] == forms


def test_a_slip_near_many_given_names_keeps_them_all():
    near = ["balan", "belan", "bilan", "bolan"]
    reader = names.Reader(names.Givens([(g, None) for g in near], [], []))
    assert [f[:3] for f in reader.forms("Bulan Virfoash")] == [(g, "virfoash", 0) for g in near]


def link(spark, rows):
    aliases = spark.createDataFrame([("Pele", "Pelkin"), ("Wofosie", "Muth"), ("Sidrom", "Sid")], "given_name string, short_name string")
    base = {"species_code": "TARN_WEAVER", "home_world": "Velm-12c"}
    links = names.linked(records(spark, [base | r for r in rows]), aliases, CODE_LIST)
    return [tuple(r) for r in sorted(names.pairs(links).collect())]


def test_links(spark):
    rows = [
        {"case_id": "A", "applicant_name": "Pele Virfoash"}, {"case_id": "B", "applicant_name": "VIRFAOSH, Pelkin"}, {"case_id": "C", "applicant_name": "Pele Virfoash", "species_code": "VELTHARI", "home_world": "Velm-14b"},
        {"case_id": "D", "applicant_name": "Wofosie Virfoash"}, {"case_id": "E", "applicant_name": "P. Virfoash"}, {"case_id": "F", "applicant_name": None, "sponsor_letter_name": "Pele Virfoash", "home_world": "???"},
        {"case_id": "G", "applicant_name": "Sidrom Zumskul", "sponsor_letter_name": "Pele Virfoash"}, {"case_id": "H", "applicant_name": "Pele Virfoash", "species_code": None, "home_world": None},
        {"case_id": None, "applicant_name": "Pele Virfoash"}, {"case_id": "A", "applicant_name": "Pele Virfoash"}, {"case_id": "I", "applicant_name": "Sidrom Zumskul-Gesraem"}, {"case_id": "J", "applicant_name": "?" * 3}, {"case_id": "K", "applicant_name": "X" * 50_000 + " Pele"},
    ]
    group = ["A", "B", "E", "F"]
    want = [(a, b) for a in group for b in group if a < b] + [("G", "I")]
    assert link(spark, rows) == sorted(want)
    assert link(spark, rows[:0]) == []


def test_links_of_incomplete_cases_among_themselves(spark):
    no_world, no_species = {"home_world": None}, {"species_code": None}
    rows = [
        {"case_id": "A", "applicant_name": "B. Virfoash"}, {"case_id": "B", "applicant_name": "B. Virfoosh"},
        {"case_id": "C", "applicant_name": "Pele Gafinthel"} | no_world, {"case_id": "D", "applicant_name": "Pele Gafinthel"} | no_species,
        {"case_id": "E", "applicant_name": "R. Nadroanquar"}, {"case_id": "F", "applicant_name": "R. Nadroanquar"}, {"case_id": "F", "applicant_name": "R. Besholm"}, {"case_id": "F", "applicant_name": "R. Tarquil"},
        {"case_id": "G", "applicant_name": "W. Hembrigal Tosk"}, {"case_id": "H", "applicant_name": "Wofosie Hembrigal"},
        {"case_id": "I", "applicant_name": "S. Dunmorrel-Askewin"}, {"case_id": "J", "applicant_name": "S. Dunmorel"},
        # an initial does not connect two given names
        {"case_id": "K", "applicant_name": "Pele Ostrander"} | no_world, {"case_id": "L", "applicant_name": "Pudgrim Ostrander"} | no_world, {"case_id": "M", "applicant_name": "P. Ostrander"},
        # nor a case without home world two applicants of unlike worlds
        {"case_id": "N", "applicant_name": "S. Quellbarth"}, {"case_id": "O", "applicant_name": "S. Quellbarth", "home_world": "Velm-14b"}, {"case_id": "P", "applicant_name": "Sidrom Quellbarth"} | no_world,
    ]
    assert link(spark, rows) == [("A", "B"), ("C", "D"), ("E", "F"), ("G", "H"), ("I", "J")]


def test_pigeonhole_join_finds_all_pairs_within_k(spark):
    rng = random.Random(6)
    base = ["virfoashtun", "zumskulbesh", "gafinthel", "nadroanquar"]
    fams = set(base)
    for _ in range(150):
        s = list(rng.choice(base))
        for _ in range(rng.randint(1, 3)):
            i = rng.randrange(len(s) + 1)
            s[i : i + rng.randint(0, 1)] = rng.choice("aeou") * rng.randint(0, 1)
        fams.add("".join(s))
    fams = sorted(fams)
    rows = [(i, "e:1", "e:2", "pele", f, False, "pele") for i, f in enumerate(fams)]
    df = spark.createDataFrame(rows, "rep bigint, species string, world string, given string, family string, part boolean, g string")
    out = {tuple(sorted((r.a_rep, r.b_rep))) for r in names.candidates(df, df, True).collect()}
    one = df.select(F.array([F.lit(f) for f in fams]).alias("f")).limit(1).select(F.posexplode("f").alias("i", "a"), "f").select("i", "a", F.posexplode("f").alias("j", "b")).where("i < j")
    want = {(r.i, r.j) for r in one.where(names.near(F.col("a"), F.col("b"))).select("i", "j").collect()}
    assert out == want and len(want) > 100


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    out = {r.node: r.comp for r in names.components(edges).collect()}
    assert {out[i] for i in range(41)} == {0} and out[101] == out[100] == 100


def test_queries_have_the_stated_columns(spark):
    assert queries.p3_found(spark, DATA).dtypes == [("case_a", "string"), ("case_b", "string")]
    assert queries.p4_found(spark, DATA).dtypes == [("record_id", "bigint"), ("field_name", "string"), ("entry_id", "bigint")]
    assert queries.p6_found(spark, DATA).dtypes == [("case_id", "string"), ("field_name", "string"), ("kept_value", "string")]
    assert queries.p9_found(spark, DATA).dtypes == [("doc_id", "bigint"), ("segment_no", "int"), ("lang", "string")]


def test_given_names_in_use_do_not_depend_on_the_size_of_the_corpus(spark):
    rng = random.Random(8)
    few = [("rarity", f"Rarity Family{i}") for i in range(6)]
    rows = [(f"C{i}", name) for i, (_, name) in enumerate(few)]
    many = rows + [(f"D{i}", f"{rng.choice(['Anselm', 'Bertil', 'Cosima'])} Other{i}") for i in range(30_000)]
    aliases = spark.createDataFrame([("Anselm", "Ans")], "given_name string, short_name string")
    for part in (rows, many):
        learned = names.learn(spark.createDataFrame(part, "case_id string, name string"), aliases)
        assert "rarity" in names.Givens(*learned).names


def test_a_slip_that_occurs_often_is_no_given_name():
    usage = [("rabond", 400), ("raborid", 40), ("rabodn", 20), ("sabond", 300)]
    g = names.Givens([("Rabond", "Rab")], usage, [("rabodn", "Rabkin")])
    assert sorted(g.names) == ["rabond", "sabond"] and g.meant("raborid") == g.meant("rabodn") == g.meant("rabkin") == g.meant("rabkn") == ["rabond"]


def test_long_tokens_and_names_of_many_words_are_read():
    long = "x" * 30 + "abcdefghijklmn"
    reader = names.Reader(names.Givens([(long, None)], [], []))
    assert reader.forms(f"{long[:-1]} Virfoash")[0][:3] == (long, "virfoash", 0)
    assert reader.forms(f"{long} a b c d e f Virfoash")[0][0] == long


def test_closed_lists_are_refused_beyond_their_bound(spark, monkeypatch):
    monkeypatch.setattr(names, "MAX_LISTED", 2)
    aliases = spark.createDataFrame([("A", "a"), ("B", "b"), ("C", "c")], "given_name string, short_name string")
    with pytest.raises(ValueError):
        names.learn(spark.createDataFrame([("X", "A B")], "case_id string, name string"), aliases)


def test_two_slips_link_rare_family_names_only(spark):
    kin = [{"case_id": f"K{i}", "applicant_name": f"{g} {f}"} for i, (g, f) in enumerate((g, f) for g in ("Wofosie", "Sidrom") for f in ("Mavox", "Bevox"))]
    rows = [{"case_id": "A", "applicant_name": "Pele Yaefoah"}, {"case_id": "B", "applicant_name": "Pele Yaaefoath"}, {"case_id": "C", "applicant_name": "Pele Zomskind"}, {"case_id": "D", "applicant_name": "Pele Zornskind"}, *kin]
    assert link(spark, rows) == [("A", "B"), ("C", "D")]


# Caps and models

def test_all_targets_of_a_long_list_are_used(spark):
    n = 1500
    df = sizes(spark, [(i, f"s{i}", 10) for i in range(n)])
    targets = spark.createDataFrame([(f"s{i}", 1 / n, 1) for i in range(n)], "source string, target_share double, max_repeats int")
    assert mixing.rates(df, targets).count() == n and mixing.sampled(df, mixing.rates(df, targets)).count() == n


def test_mixture_does_not_depend_on_the_bucket_size(spark, monkeypatch):
    rng = random.Random(9)
    df = sizes(spark, [(i, rng.choice("ab"), rng.randint(1, 300)) for i in range(5000)])
    targets = spark.createDataFrame([("a", 0.3, 2), ("b", 0.4, 2)], "source string, target_share double, max_repeats int")
    total = lambda: {s: n for s, n in mixing.sampled(df, mixing.rates(df, targets)).groupBy("source").agg(F.sum("copies")).collect()}
    one = total()
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 50)
    assert total() == one


def test_sources_without_rank_stay_out_whatever_their_number(spark):
    table = spark.createDataFrame([(f"bad{i}", None) for i in range(40)] + [("good", 1)], "source_name string, trust_rank int")
    rows = [{"case_id": "A", "sponsor_id": f"SPN-00{i:02d}", "field_sources": {"sponsor_id": f"bad{i}"}, "read_at": at(1)} for i in range(40)]
    assert survivor.survivors(records(spark, rows), table).count() == 0
    kept = survivor.survivors(records(spark, [*rows, {"case_id": "A", "sponsor_id": "SPN-9999", "field_sources": {"sponsor_id": "good"}}]), table)
    assert got(kept, "kept_value") == [("SPN-9999",)]


def test_the_model_decides_the_truths(spark, monkeypatch):
    args = table(spark, DATA, "records"), table(spark, DATA, "source_trust")
    with_model = set(got(survivor.truths(*args), "case_id", "field_name", "value"))
    monkeypatch.setattr(survivor, "improved", lambda sums, n: survivor.start(n))
    flat = set(got(survivor.truths(*args), "case_id", "field_name", "value"))
    assert with_model != flat and with_model


def test_rounds_on_the_cluster_are_those_on_the_driver(spark):
    rng = random.Random(10)
    rows = [(rng.choice(survivor.FIELDS), said := rng.randint(0, 15), said | rng.randint(0, 15), rng.randint(1, 50)) for _ in range(200)]
    patterns = spark.createDataFrame(rows, "field string, said bigint, cover bigint, n bigint").groupBy("field", "said", "cover").agg(F.sum("n").alias("n"))
    near, spread = survivor.fitted(patterns, 4, 5), survivor.fitted(patterns, 4, 5, most=10)
    assert all(abs(a - b) < 1e-9 for f in survivor.FIELDS for x, y in zip(near[f][1:], spread[f][1:]) for a, b in zip(x, y))


def test_foreign_texts_have_no_language(spark):
    d = table(spark, DATA.replace("0.001", "0.01"), "documents")
    f = language.fit(language.training_rows(d, 100))
    foreign = ["Wczoraj wieczorem inspektor sprawdził dokumenty przyjezdnych na stacji kosmicznej.", "Dün akşam müfettiş istasyondaki yolcuların belgelerini dikkatle inceledi.", "Ο επιθεωρητής έλεγξε χθες τα έγγραφα των επισκεπτών στον σταθμό.", "Az ellenőr tegnap este átnézte az állomásra érkezett utasok iratait."]
    assert [f.segments(t) for t in foreign] == [[(0, None, 0.0)]] * len(foreign)
    en, de = "The night inspector copied the list of cargo without asking the applicant.", "Das Meldeamt verlor den Brief ohne den Antragsteller zu fragen."
    assert [x[:2] for x in f.segments(f"{en}\n{foreign[0]}\n{de}")] == [(1, "en"), (2, None), (3, "de")]
    df = spark.createDataFrame([(1, foreign[0], "en"), (2, de, "en")], "doc_id bigint, text string, lang string")
    both = d.select("doc_id", "text", "lang").where("doc_id % 3 = 0").unionByName(df.withColumn("doc_id", -F.col("doc_id")))
    assert got(language.found(both).where("doc_id < 0"), "doc_id", "lang") == [(-2, "de")]
