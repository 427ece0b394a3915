"""Operators 1, 3, 7, 9 and 10."""

import math
import random

import pytest
from brute import contamination, id_remainder, language, luhn, pii, quality, quality_score, sha
from pyspark.sql import functions as F

from tidemark.llm import decontaminate as D
from tidemark.llm import language_id as L
from tidemark.llm import pii as P
from tidemark.llm import quality_classifier as C
from tidemark.llm import quality_rules as Q
from tidemark.llm.boosting import calibrate, fit
from tidemark.llm.sampling import id_remainder as id_remainder_column, sample_per_class
from tidemark.tables import load

SF = "/root/testdata/sf0.01"


# -- quality rules -------------------------------------------------------------

def tail(k, n, p):
    return sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p)
                        + (n - i) * math.log1p(-p)) for i in range(k + 1))


def test_binomial_tail(spark):
    cases = [(0, 10), (0, 1000), (3, 2000), (100, 20_000), (15_000, 2_000_000), (19_800, 2_000_000), (19_850, 2_000_000), (50, 100)]
    df = spark.createDataFrame([(float(k), float(n)) for k, n in cases], "k double, n double")
    for r in df.select("k", "n", Q.binomial_tail(F.col("k"), F.col("n"), 0.01).alias("t")).collect():
        want = tail(int(r.k), int(r.n), 0.01) if r.k < r.n * 0.01 else 1.0
        assert r.t == pytest.approx(want, rel=1e-8)


def test_a_truncated_tail_is_bounded_from_above(spark, monkeypatch):
    monkeypatch.setattr(Q, "TAIL_TERMS", 3)
    monkeypatch.setattr(Q, "TAIL_PER_ROOT", 0)
    df = spark.createDataFrame([(80.0, 10_000.0)], "k double, n double")
    t = df.select(Q.binomial_tail(F.col("k"), F.col("n"), 0.01)).first()[0]
    assert tail(80, 10_000, 0.01) <= t <= 4 * tail(80, 10_000, 0.01)


def test_features_and_base_rules(spark, edge_docs, edge_rows):
    none = spark.createDataFrame([], "doc_id long, quality int")
    out = Q.apply_rules(spark, edge_docs, none)
    got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) for r in out.collect()]
    want = [(r[0], *(q := quality(r[1])), not q[-1]) for r in edge_rows]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert Q.apply_rules(spark, edge_docs.limit(0), none).count() == 0


def test_cutoffs_are_proven_per_stratum(spark):
    """A rule that rejects too many good texts in one stratum is used in the
    other alone; cutoffs behind a failing one are never reached."""
    rows = []
    for s, share in (("x", 0.0), ("y", 0.3)):
        for i in range(3000):
            rows.append((s, 100, 500, 10 if i >= share * 3000 else 90, True))
        rows += [(s, 100, 500, 90, False)] * 500
    df = spark.createDataFrame(rows, "stratum string, n_words long, word_chars long, n_symbols long, good boolean")
    df = df.select("*", *[F.lit(v).cast("long").alias(c) for c, v in (("n_dup_lines", 0), ("n_lines", 5), ("n_repeat_words", 0),
                                                                    ("n_upper", 0), ("n_marks", 0))], F.lit(False).alias("base_failed"))
    got = {(r.stratum, r.rule): r.cutoff for r in Q.select_cutoffs(df).collect()}
    assert got == {("x", "symbols_per_word"): 0.8}


def _labelled_texts():
    """Three languages: rules are proven in `x`; in `y` too many good texts
    look bad; in `z` one good text has a thousand rows."""
    r = random.Random(3)
    plain = lambda: " ".join(f"w{r.randrange(10**9)}" for _ in range(30))
    bad = lambda: " ".join(f"##{r.randrange(10**9)}%%" for _ in range(30))
    rows = [("x", plain(), 1) for _ in range(1500)] + [("x", bad(), 0) for _ in range(200)]
    rows += [("y", plain() if i % 3 else bad(), 1) for i in range(1500)] + [("y", bad(), 0) for _ in range(200)]
    rows += [("z", "the same text again " * 2 + " ".join(map(str, range(25))), 1)] * 1500 + [("z", bad(), 0) for _ in range(200)]
    docs = [(i, t, s) for i, (s, t, _) in enumerate(rows)]
    labels = [(i, q) for i, (_, _, q) in enumerate(rows)] + [(0, 0), (1, None)]
    # Ids without a label.
    return docs + [(9_999_999, bad(), "x"), (9_999_998, None, "x")], labels


def test_rules_equal_their_sql_where_cutoffs_are_active(spark):
    import duckdb
    import pandas as pd

    from tidemark.llm.oracle import ORACLE
    docs, labels = _labelled_texts()
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    out = Q.apply_rules(spark, d, spark.createDataFrame(labels, "doc_id long, quality int"))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"}))
    con.register("labels", pd.DataFrame(labels, columns=["doc_id", "quality"]).astype({"quality": "Int64"}))
    cols = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op1_quality_rules']}) WHERE doc_id IS NOT NULL").fetchall()
    got = [tuple(r) for r in out.where("doc_id is not null").select(*cols).collect()]
    assert sorted(got) == sorted(want)
    kept = {s: out.where(F.col("stratum") == s).agg(F.count_if(~F.col("kept") & ~F.col("base_failed"))).first()[0] for s in "xyz"}
    assert kept["x"] >= 200 and kept["y"] == kept["z"] == 0


def test_copies_of_a_labelled_text_are_one_trial(spark):
    """A thousand rows of one good text prove no cutoff, whether they have ids
    of their own or share one."""
    docs, labels = _labelled_texts()
    z = [t for _, t, s in docs if s == "z"]
    docs += [(8_000_000, z[0], "z")] * 1000 + [docs[0], (None, z[0], None)]
    labels += [(8_000_000, 1)]
    d = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    out = Q.apply_rules(spark, d, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r.stratum for r in out.where("size(rejected_by) > 0").select("stratum").distinct().collect()} == {"x"}


# -- decontamination -----------------------------------------------------------

def _benchmark(spark, texts):
    return spark.createDataFrame(texts, "item_id long, text string")


def _compare(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string").select("*", F.lit(1).alias("h"), F.lit(2).alias("fp"))
    got = [tuple(r) for r in D.find_contamination(d, _benchmark(spark, items), **kw).drop("version").collect()]
    assert sorted(got, key=str) == sorted(contamination(docs, items), key=str)


def test_winnowing_finds_every_shared_window(spark):
    r = random.Random(5)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "ß", "x1"]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.randint(8, 30)))) for i in range(25)]
    items += [(90, "one two three"), (91, "Solo"), (92, ""), (93, None), (94, "a a a a a a a a a a a a"), (3, "other text of a known item id here and now ok yes")]
    docs = []
    for i in range(120):
        w = [r.choice(vocabulary + ["zz", "Y"]) for _ in range(r.randint(0, 60))]
        if i % 2:
            t = (items[r.randrange(25)][1]).split()
            at = r.randrange(len(t))
            w[len(w) // 2:len(w) // 2] = t[at:at + r.randint(5, 25)]
        docs.append((i, (" " if i % 3 else ", ").join(w)))
    docs += [(200, None), (201, ""), (202, "ONE  two\nthree four solo"), (203, "a " * 500), (None, items[0][1]), (204, "É É"),
             (205, items[1][1].upper()), (205, "same id, other text")]
    _compare(spark, docs, items)


def test_short_items_of_every_length_are_found_in_one_pass(spark):
    r = random.Random(8)
    items = [(n, " ".join(f"s{r.randint(0, 3)}" for _ in range(n))) for n in range(1, 12)] + [(50, "s1 s2 s3"), (51, "s1 s2 s3"), (None, "s1 s1")]
    docs = [(i, " ".join(f"s{r.randint(0, 3)}" for _ in range(r.randint(0, 40)))) for i in range(80)]
    docs += [(300, items[9][1]), (301, items[10][1] + " s9"), (302, items[8][1])]
    _compare(spark, docs, items)
    d = spark.createDataFrame(docs, "doc_id long, text string").select("doc_id", D.word_hashes(F.col("text")).alias("h"))
    i = spark.createDataFrame(items, "item_id long, text string").select("item_id", D.word_hashes(F.col("text")).alias("h"))
    plan = D.shared_runs(d, i, ["doc_id"], lengths=[1, 2, 3])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1 and plan.count("Generate ") == 2


def test_repetitive_texts_meet_in_rows_linear_in_their_length(spark):
    texts = [(1, "same " * 2000), (2, "one two three " * 700), (3, ("same " * 400 + "end ") * 3)]
    items = [(7, "same " * 2000), (8, "two three one " * 500), (9, "same " * 2000)]
    _compare(spark, texts, items)
    hashed = lambda rows, name: spark.createDataFrame(rows, f"{name} long, text string").select(
        name, D.word_hashes(F.col("text")).alias("h"))
    joined = D.shared_runs(hashed(texts, "doc_id"), hashed(items, "item_id"), ["doc_id"]).groupBy("doc_id", "item_id").count().collect()
    assert joined and all(j["count"] <= 20 * 2100 for j in joined)


def test_no_benchmark_and_no_documents(spark, edge_docs):
    none = _benchmark(spark, [])
    out = D.find_contamination(edge_docs, none)
    assert out.where("contaminated or n_items > 0").count() == 0 and out.count() == edge_docs.count()
    assert {r.items_sha256 for r in out.collect()} == {sha("")}
    assert D.find_contamination(edge_docs.limit(0), none).count() == 0


def test_contaminated_rows_are_dropped_with_their_columns(spark, edge_docs, edge_rows):
    kept = D.drop_contaminated(edge_docs, _benchmark(spark, [(1, edge_rows[0][1])]))
    assert kept.columns == edge_docs.columns
    shares = {t for _, t, *_ in edge_rows if t and "past the old mill and the children of the village" in t}
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted(
        (str(d), t or "") for d, t, *_ in edge_rows if t not in shares and not contamination([(d, t)], [(1, edge_rows[0][1])])[0][-1])


# -- language ------------------------------------------------------------------

def test_language_is_found_on_held_out_documents(spark):
    docs = load(spark, SF, "documents")
    got = L.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (id_remainder(r.doc_id, 4) == 2) for r in got) and len(held) > 150
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_predictions_do_not_look_at_lang_or_id(spark):
    docs = load(spark, SF, "documents")
    model = L.fit_languages(docs)
    x = [L.describe(t) for t in ("the and of with from that", "und der die das mit nicht")]
    assert model.predict(__import__("numpy").stack(x))[0] == ["en", "de"]
    assert model.families == ["germanic", "romance"] and ("", "germanic", "romance") in model.pairs


def test_language_edge_cases(spark, edge_docs, edge_rows, no_docs):
    got = L.identify_languages(edge_docs).collect()
    assert len(got) == len(edge_rows)
    assert {r.doc_id for r in got if r.lang_pred == "und"} == {2, 3, 4, 9, None} and all(r.score == 0 for r in got if r.lang_pred == "und")
    kept = L.keep_identified(edge_docs)
    assert kept.columns == edge_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, t, *_ in edge_rows if L.has_letter(t))
    unknown = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.identify_languages(unknown).collect()} == {"und"}
    assert L.keep_identified(unknown).count() == kept.count()
    assert L.identify_languages(no_docs).count() == 0 and L.keep_identified(no_docs).count() == 0
    one = {(r.lang_pred, r.score) for r in L.identify_languages(edge_docs.where("lang = 'en'")).collect()}
    assert one == {("en", 1.0), ("und", 0.0)}


ODD = [None, "", " \n", "12 34 !!", "the", "É", "ÀÉ ñ  ü\tö", "漢字 かな", "İstanbul İ", "a\x0bb\x1cc \x85 d", "THE THE the the 99,9 %%%",
       "x" * 3000, "it's \r\n fine -- fine fine", "der Hund und die Katze sind im Haus", "le chat est dans la maison"]


def test_languages_equal_a_plain_prediction(spark):
    docs = load(spark, SF, "documents").select("doc_id", "text", "lang")
    extra = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(ODD)], "doc_id long, text string, lang string")
    model = L.fit_languages(docs)
    got = L.identify_languages(docs.union(extra)).join(docs.union(extra).select("doc_id", "text"), "doc_id")
    rows = got.where((F.col("doc_id") >= 10**9) | (F.col("doc_id") % 20 == 0)).collect()
    assert len(rows) >= len(ODD) + 40
    for r in rows:
        name, score = language(r.text, model, L.BITS)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-4)


def test_a_language_sample_is_bounded(spark):
    seen = [i for i in range(100, 200) if id_remainder(i, 4) != 2][:41]
    rows = [(seen[0], f"repeated id, text number {i % 3}", "en") for i in range(3000)] + [(i, f"der Satz {i} ist kurz", "de") for i in seen[1:]]
    rows += [(1000 + i, f"mot {i}", f"l{i}") for i in range(30)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.fit_languages(d, max_languages=2)
    assert sorted(x for v in model.languages.values() for x in v) == ["de", "en"]
    picked = sample_per_class(d, "lang", ["doc_id", "text"], {"en": 3000, "de": 40}, 3000, "s")
    assert {r.lang: r["count"] for r in picked.groupBy("lang").count().collect()} == {"en": 3, "de": 40}


# -- personal data -------------------------------------------------------------

PARTS = ["a", "B", "9", "1", "12", "255", "256", "0", "00", "4111111111111111", "+1 (555) 555-1234", "+", " ", "-", ".", "(", ")", "@",
         "x.y", "\n", "é", "😀", "%", "_", "1.2.3.4", "call ", "ann (at) mail [dot] com", "(212) 555-0000", "token="]


def _pii_rows():
    r = random.Random(5)
    rows = [(i, "".join(r.choice(PARTS) for _ in range(r.randint(0, 25)))) for i in range(1500)]
    return rows + [(9000, None), (9001, ""), (9002, "1.2.3.4 " * 300), (9003, "9" * 30_000), (9004, "a" * 100_000), (9005, "+1" + " " * 30_000),
                   (9006, "1 " * 10_000), (9007, "a." * 10_000 + "@b.c"), (None, "x@y.zz"), (9008, "x@y.zz"), (9008, "x@y.zz")]


def test_base_spans_and_added_spans(spark):
    rows = _pii_rows()
    d = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit("z").alias("cands"), F.lit("y").alias("kept"))
    got = sorted(((r.doc_id, r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in P.pii_report(d).collect()), key=str)
    base = [(i, pii(t)) for i, t in rows]
    counts = lambda s: [sum(x.startswith(k + ":") for x in s.split(",")) for k in P.KINDS]
    assert got == sorted(((i, *counts(s), sha(s)) for i, s in base), key=str)
    spans = {r.doc_id: r.spans for r in P.pii_report(d).collect()}
    for i, s in base:
        listed = [x.split(":") for x in spans[i].split(",") if x]
        assert set(filter(None, s.split(","))) <= {":".join(x) for x in listed}
        added = [(int(a), int(b)) for k, a, b in listed if f"{k}:{a}:{b}" not in s.split(",")]
        kept = [tuple(map(int, x.split(":")[1:])) for x in s.split(",") if x]
        assert all(b <= c or e <= a for a, b in added for c, e in kept)


def test_numbers_that_run_together_are_recovered(spark):
    docs = load(spark, SF, "documents").select("doc_id", "text")
    both, one = "see 4485275742308327 4550997810720808 there", "see 2353820953013749 4550997810720808 there"
    assert [luhn(x) for x in ("4485275742308327", "4550997810720808", "2353820953013749")] == [True, True, False]
    extra = spark.createDataFrame([(10**9, both), (10**9 + 1, one)], "doc_id long, text string")
    got = {r.doc_id: r.spans for r in P.pii_report(docs.union(extra)).collect()}
    assert pii(both) == pii(one) == ""
    assert got[10**9] == "card:4:20,card:21:37" and got[10**9 + 1] == "card:21:37"


def test_redaction_replaces_spans_only(spark, edge_docs, edge_rows):
    out = P.redact(edge_docs)
    assert out.columns == edge_docs.columns
    texts = {(r.doc_id, r.text) for r in out.collect()}
    want = {(d, t) for d, t, *_ in edge_rows if d != 14}
    assert want <= texts and out.count() == len(edge_rows)
    assert dict((d, t) for d, t in texts)[14] == "Write to [EMAIL] or [PHONE], card [CARD], host [IP]."
    assert P.redact(edge_docs.limit(0)).count() == 0 and P.pii_report(edge_docs.limit(0)).count() == 0


def test_boosting_learns_and_calibrates():
    cells = [((a, b), 90 if a > 2 and b < 2 else 1, 1 if a > 2 and b < 2 else 90) for a in range(5) for b in range(4)]
    m = fit(cells)
    assert all((m.margin(x) > 0) == (p > n) for x, p, n in cells)
    limit = calibrate([(m.margin(x), p, n) for x, p, n in cells], 0.95)
    assert {x for x, *_ in cells if m.margin(x) >= limit - 1e-6} == {x for x, p, n in cells if p > n}
    assert calibrate([], 0.9) == math.inf and calibrate([(1.0, 1, 9)], 0.9) == math.inf
    assert fit([]).margin((1,)) == 0.0


# -- quality classifier --------------------------------------------------------

def test_quality_on_held_out_documents(spark):
    docs, labels = load(spark, SF, "documents"), load(spark, SF, "labels")
    rows = C.score_quality(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (id_remainder(r.doc_id, 3) == 1) and (r.predicted == 1) == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.95 * len(held)
    assert sum(r.predicted == 0 for r in held if r.quality == 0) >= 0.9 * sum(r.quality == 0 for r in held)


def test_quality_equals_a_plain_forward_pass(spark):
    docs, labels = load(spark, SF, "documents").select("doc_id", "text"), load(spark, SF, "labels")
    model = C.fit_quality(docs, labels)
    extra = docs.union(spark.createDataFrame([(10**9 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string"))
    rows = C.score_quality(extra, labels).join(extra, "doc_id").where((F.col("doc_id") >= 10**9) | (F.col("doc_id") % 40 == 0)).collect()
    assert len(rows) >= len(ODD) + 20
    for r in rows:
        assert r.score == pytest.approx(quality_score(r.text, model, C.BITS), abs=1e-4)


def test_a_repeated_labelled_id_is_one_example(spark):
    docs, labels = load(spark, SF, "documents").select("doc_id", "text"), load(spark, SF, "labels")
    one = docs.join(labels.where(F.col("quality").isNotNull() & (id_remainder_column("doc_id", 3) != 1)).select("doc_id").limit(1), "doc_id")
    many = docs.unionByName(one.crossJoin(spark.range(2000).select("id")).select("doc_id", F.concat("text", F.lit(" "), "id").alias("text")))
    a, b = C.fit_quality(docs, labels), C.fit_quality(many, labels)
    assert (a.embeddings == b.embeddings).all() and (a.layer == b.layer).all()


def test_quality_edge_cases(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame([(d, i % 2, 0) for i, (d, *_) in enumerate(edge_rows)] + [(5, None, None), (None, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    rows = C.score_quality(edge_docs, labels).collect()
    assert len(rows) == len(edge_rows) and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3)}) == 1
    assert {r.score for r in C.score_quality(edge_docs, labels.limit(0)).collect()} == {0.5}
    assert C.score_quality(no_docs, labels).count() == 0
