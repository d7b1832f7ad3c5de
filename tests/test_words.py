"""Spelling, lemmas, token maps and language identification against brute force."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from postsift.operators import ingest, language, lemmas, paradigms, spelling, tokenmap
from postsift.plans import triage
from postsift.settings import Settings, TextSettings
from postsift.sources import tables


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def one_edit(a, b):
    swaps = {a[:i] + a[i + 1] + a[i] + a[i + 2 :] for i in range(len(a) - 1)}
    return distance(a, b) == 1 or b in swaps


KNOWN = {"hello": 9, "help": 7, "held": 7, "order": 20, "orders": 5, "the": 99, "señal": 6, "tho": 8}
UNKNOWN = ["helo", "hlep", "ordr", "rodesr", "teh", "zzzzzz", "senal", "heldx", "oredrs", "ab", "ABC", "x1z", "thee"]


def brute(max_distance):
    out = {}
    for w in UNKNOWN:
        if len(w) < 3 or not w.isalpha() or w.isupper():
            continue
        rank = lambda c: (-KNOWN[c], c)
        first = sorted((c for c in KNOWN if one_edit(w, c)), key=rank)
        second = sorted((c for c in KNOWN if distance(w, c) <= 2), key=rank) if max_distance > 1 else []
        if first or second:
            out[w] = (first or second)[0]
    return out


@pytest.mark.parametrize("max_distance", [1, 2])
def test_corrections_match_brute_force(spark, max_distance):
    vocab = spark.createDataFrame([("en", w, 1) for w in UNKNOWN], "lang string, token string, n long")
    known = spark.createDataFrame([("en", w, n) for w, n in KNOWN.items()], "lang string, word string, n long")
    got = {r.word: r.correction for r in spelling.corrections(vocab, known, max_distance).collect()}
    assert got == brute(max_distance)


def test_languages_do_not_mix(spark):
    vocab = spark.createDataFrame([("es", "helo", 1)], "lang string, token string, n long")
    known = spark.createDataFrame([("en", "hello", 9)], "lang string, word string, n long")
    assert spelling.corrections(vocab, known).isEmpty()


def test_correct_spelling_keeps_case_and_everything_else(spark):
    known = spark.createDataFrame([("en", w, n) for w, n in KNOWN.items()], "lang string, word string, n long")
    docs = spark.createDataFrame(
        [(1, "Helo the ordr NASA x1z", "en"), (2, "teh", "de"), (3, "", "en"), (4, "the", None)],
        "id long, text string, lang string",
    )
    out = spelling.correct_spelling(docs, "id", "text", "lang", "fixed", known)
    assert {r.id: r.fixed for r in out.collect()} == {1: "Hello the order NASA x1z", 2: "teh", 3: "", 4: "the"}


@pytest.mark.parametrize("salts", [1, 16])
def test_token_map_is_the_same_with_any_salt(spark, salts):
    words = ["a", "b", "c", "d"]
    docs = spark.createDataFrame(
        [(i, " ".join(c), "en" if i % 3 else "es") for i, c in enumerate(itertools.product(words, repeat=3))],
        "id long, text string, lang string",
    )
    mapping = spark.createDataFrame([("en", "a", "A"), ("en", "b", "b"), ("es", "c", "C")], "lang string, token string, value string")
    out = tokenmap.apply_token_map(docs, mapping, "id", "text", "lang", "out", salts=salts)
    change = {"en": {"a": "A"}, "es": {"c": "C"}}
    for r in out.collect():
        assert r.out == " ".join(change[r.lang].get(w, w) for w in r.text.split())
    assert out.count() == 64


def test_hot_words_do_not_multiply_rows(spark):
    docs = spark.range(3000).select(F.col("id"), F.lit("hot cold").alias("text"), F.lit("en").alias("lang"))
    mapping = spark.createDataFrame([("en", "hot", "warm")], "lang string, token string, value string")
    out = tokenmap.apply_token_map(docs, mapping, "id", "text", "lang", "out")
    assert out.count() == 3000 and out.select("out").distinct().collect()[0][0] == "warm cold"


def test_learned_lemmas(spark):
    vocab = spark.createDataFrame(
        [("en", w, 1) for w in ["Mice", "walked", "boxes", "parties", "running", "xyzzing", "orders"]] + [("es", "boxes", 1)],
        "lang string, token string, n long",
    )
    lexicon = spark.createDataFrame([("en", "mice", "mouse")], "lang string, form string, lemma string")
    known = spark.createDataFrame([("en", w, 9) for w in ["walk", "box", "party", "order", "orders"]], "lang string, word string, n long")
    got = {(r.lang, r.token): r.value for r in lemmas.learn_lemmas(vocab, lexicon, known).collect()}
    assert got == {("en", "Mice"): "mouse", ("en", "walked"): "walk", ("en", "boxes"): "box", ("en", "parties"): "party"}


def test_lemmatise_job(spark):
    docs = spark.createDataFrame([(1, "boxes walk walk", "en"), (2, "walk", "en")], "id long, text string, lang string")
    lexicon = spark.createDataFrame([("en", "boxes", "box")], "lang string, form string, lemma string")
    known = spark.createDataFrame([("en", "walk", 3)], "lang string, word string, n long")
    out = lemmas.lemmatise(docs, lexicon, known, "id", "text", "lang", "out")
    assert {r.id: r.out for r in out.collect()} == {1: "box walk walk", 2: "walk"}


def test_language_identification_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    docs = ingest.assign_split(docs, "doc_id")
    train = docs.where("split = 'discovery'")
    # Copies of training texts are taken out.
    held = docs.where("split <> 'discovery'").join(train.select("text"), "text", "left_anti")
    model = language.fit_language_model(train)
    scored = language.detect_language(held, model, "text")
    assert scored.agg(F.avg((F.col("lang") == F.col("detected_language")).cast("double"))).first()[0] >= 0.95


def test_language_of_texts_without_letters(spark, tmp_path):
    rows = [("the cat and the hat", "en"), ("el gato y el sombrero", "es")]
    model = language.fit_language_model(spark.createDataFrame(rows, "text string, lang string"))
    model.write().overwrite().save(str(tmp_path / "lang"))
    model = type(model).load(str(tmp_path / "lang"))
    texts = spark.createDataFrame([("",), (None,), ("123 :)",), ("   ",), ("the",), ("el",)], "t string")
    got = [r.detected_language for r in language.detect_language(texts, model, "t").collect()]
    assert got == ["unknown"] * 4 + ["en", "es"]


def test_language_scoring_does_not_shuffle(spark):
    rows = spark.createDataFrame([("the cat", "en"), ("el gato", "es")], "text string, lang string")
    model = language.fit_language_model(rows)
    plan = language.detect_language(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), model, "text")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_spelling_inside_the_chain(spark):
    known = spark.createDataFrame([("en", w, n) for w, n in KNOWN.items()], "lang string, word string, n long")
    df = spark.createDataFrame([(1, "Helo! the ordrs", "en")], "tweet_id long, text string, detected_language string")
    s = Settings(text=TextSettings(correct_spelling=True))
    out = triage.preprocessed(df, None, s, dictionary=known).first()
    assert out.text_preprocessed == "hello the order"
    assert tables  # imported for its checkpoint folder


def test_spelling_survives_junk_and_common_forms(spark, monkeypatch):
    monkeypatch.setattr(spelling, "WORDS_PER_SALT", 3)
    words = [("en", "house", 9), ("en", "horse", 8), ("en", "x" * 20_000, 1), ("en", "housee", 1), ("en", "huose", 1), ("en", "hxrsx", 1)]
    words += [("en", f"ho{a}", 1) for a in "bcdfghjklm"] + [("en", "hot", 50)]
    vocab = spark.createDataFrame(words, "lang string, token string, n long")
    known = spelling.known_words(vocab)
    got = {r.word: (r.correction, r.distance) for r in spelling.corrections(vocab, known).collect()}
    assert got == {"housee": ("house", 1), "huose": ("house", 1), "hxrsx": ("horse", 2)} | {f"ho{a}": ("hot", 1) for a in "bcdfghjklm"}


def test_corrections_by_parts_match_brute_force(spark):
    """Random words of few letters, so that very many pairs are close; short and long known words; hot parts in blocks."""
    rng = random.Random(11)
    word = lambda a, b: "".join(rng.choice("abcé") for _ in range(rng.randint(a, b)))
    known = {("l" + str(i % 2), word(1, 9)): rng.randint(1, 5) for i in range(300)}
    unknown = sorted({("l" + str(i % 2), word(3, 11)) for i in range(300)} - known.keys())
    want = {}
    for lang, w in unknown:
        close = [(-n, k) for (g, k), n in known.items() if g == lang and distance(w, k) <= 2]
        if close:
            want[lang, w] = min(close)[1]
    left = spark.createDataFrame(unknown, "lang string, word string")
    right = spark.createDataFrame([(g, k, n) for (g, k), n in known.items()], "lang string, word string, n long")
    for salt in (1024, 4):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(spelling, "WORDS_PER_SALT", salt)
            got = {(r.lang, r.word): (r.correction, r.distance) for r in spelling._best_by_parts(left, right).collect()}
        assert got == {k: (v, 2) for k, v in want.items()}


def test_parts_of_a_pair_in_reach_meet(spark):
    """Every word within two edits shares a part with the known word."""
    rng = random.Random(3)
    pairs = []
    for _ in range(2000):
        k = "".join(rng.choice("abcdefgh") for _ in range(rng.randint(3, 12)))
        w = k
        for _ in range(2):
            i, c = rng.randint(0, len(w)), rng.choice("abcdefgh")
            w = rng.choice([w[:i] + c + w[i:], w[:i] + w[i + 1 :], w[:i] + c + w[i + 1 :]])
        pairs.append((w, k))
    df = spark.createDataFrame(pairs, "w string, k string")
    met, own = spelling._met_parts(F.col("w"), 2), spelling._own_parts(F.col("k"))
    assert df.where(~F.arrays_overlap(met, own)).count() == 0
    assert df.select(F.max(F.size(met))).first()[0] <= 19


# Golden rows: forms and their lemmas, and words on the same endings that must stay.
FORMS = {
    "es": ("libro gato perro carro vaso plato zapato pueblo mundo queso brazo cuerpo", "s", {"primos": "primo"}, ["primo", "crisis"]),
    "pt": ("livro carro pato prato sapato mundo braço corpo campo banco banho sonho", "s", {"primos": "primo"}, ["primo", "lápis"]),
    "fr": ("table porte chaise route plage image page place glace lampe carte tasse", "s", {"pommes": "pomme"}, ["pomme", "souris"]),
    "it": ("libr gatt ragazz tavol pont banc camp cappell fratell amic nemic mond", ("o", "i"), {"vasi": "vaso"}, ["vaso", "oggi"]),
    "de": ("blume straße schule lampe katze tasche küche brücke woche sonne kirche seite", "n", {"rosen": "rose"}, ["rose", "garten"]),
}


def golden_words():
    """Words with counts: every base, three of four with their form, and bases alone, as in a corpus."""
    out = []
    for lang, (stems, ending, forms, others) in FORMS.items():
        base, form = ("", ending) if isinstance(ending, str) else ending
        for i, stem in enumerate(stems.split()):
            out.append((lang, stem + base, 9))
            if i != 3:
                out.append((lang, stem + form, 4))
        out += [(lang, f, 2) for f in forms] + [(lang, w, 5) for w in others]
    return out


def test_paradigms_of_five_languages(spark):
    words = spark.createDataFrame(golden_words(), "lang string, word string, n long")
    s = paradigms.ParadigmSettings(min_stems=8, min_share=0.7)
    rules = paradigms.paradigm_rules(words, s)
    kept = {(r.lang, r.old, r.new) for r in rules.collect()}
    for lang, (_, ending, _, _) in FORMS.items():
        base, form = ("", ending) if isinstance(ending, str) else ending
        assert (lang, form, base) in kept and (lang, base, form) not in kept
    vocab = words.select("lang", F.initcap("word").alias("token"), "n").union(spark.createDataFrame([("xx", "libros", 1), ("en", "orders", 1)], "lang string, token string, n long"))
    lexicon = spark.createDataFrame([("es", "gatos", "GATO")], "lang string, form string, lemma string")
    known = words.union(spark.createDataFrame([("en", "order", 5)], words.schema))
    got = {(r.lang, r.token): r.value for r in paradigms.learn_lemmas(vocab, lexicon, known, rules, s).collect()}
    assert got.pop(("en", "orders")) == "order" and got.pop(("es", "Gatos")) == "GATO"
    for lang, (_, _, forms, others) in FORMS.items():
        assert all(got[lang, f.title()] == base for f, base in forms.items())
        assert not any((lang, w.title()) in got for w in others)
    assert not any(g == "xx" for g, _ in got)
    assert paradigms.paradigm_rules(words.where("false"), s).isEmpty()


def test_paradigms_in_texts(spark):
    words = spark.createDataFrame(golden_words(), "lang string, word string, n long")
    rules = paradigms.paradigm_rules(words, paradigms.ParadigmSettings(min_stems=8, min_share=0.7))
    docs = spark.createDataFrame([(1, "dos primos y una crisis", "es"), (2, "zwei rosen im garten", "de"), (3, None, "it")], "id long, text string, lang string")
    empty = spark.createDataFrame([], "lang string, form string, lemma string")
    out = paradigms.lemmatise(docs, empty, words, rules, "id", "text", "lang", "out")
    assert {r.id: r.out for r in out.collect()} == {1: "dos primo y una crisis", 2: "zwei rose im garten", 3: None}


def test_many_changes_are_not_broadcast(spark):
    """A small file can hold many words: its size must not make Spark send them, and their salts, to every task by way of the driver."""
    rows = [(1, "w3 w7 other", "en"), (2, "w149999", "en"), (2, "w5", "de"), (3, None, "en")]
    df = spark.createDataFrame(rows, "id long, text string, lang string")
    word = F.concat(F.lit("w"), F.col("id").cast("string")).alias("token")
    changes = spark.range(150_000).select(F.lit("en").alias("lang"), word, F.lit("x").alias("value"))
    few = changes.where("token in ('w3', 'w149999')")
    for mapping, sent, want in ((changes, False, "x x other"), (few, True, "x w7 other")):
        out = tokenmap.apply_token_map(df, mapping, "id", "text", "lang", "out")
        joins = out._jdf.queryExecution().sparkPlan().toString()
        assert ("BroadcastHashJoin [lang" in joins) == sent and ("SortMergeJoin [lang" in joins) != sent
        got = sorted(((r.id, r.lang, r.out) for r in out.collect()))
        assert got == [(1, "en", want), (2, "de", "w5"), (2, "en", "x"), (3, "en", None)]


def test_words_meet_their_results_by_stem(spark, monkeypatch):
    """An ending has many rules: the words changed by all of them must not be shuffled. Rules may come with longer results than words are cut to."""
    words = [("xx", s + e) for s in ("kanto", "belu", "abc", "ab") for e in ("", "s", "ling", "erlings")] + [(None, "belus"), ("xx", None), ("yy", "belus")]
    known = [("xx", "kanto"), ("xx", "kantoerlings"), ("xx", "beluling"), ("xx", "beluling"), ("xx", "belu"), ("xx", "abcling"), ("xx", "abling"), (None, "belu")]
    rules = [("xx", "s", "", 20, 0.7), ("xx", "s", "ling", 30, 0.7), ("xx", "s", "erlings", 10, 0.9), ("xx", "ling", "", 10, 0.6), ("xx", "", "ling", 10, 0.5), ("xx", "s", "ling", 30, 0.7)]
    w, k = (spark.createDataFrame(rows, "lang string, word string") for rows in (words, known))
    r = spark.createDataFrame(rules, "lang string, old string, new string, stems long, share double")
    want = {}
    for lang, word in {x for x in words if x[0] and x[1]}:
        tried = [(-share, -stems, -len(old), word[: len(word) - len(old)] + new) for g, old, new, stems, share in rules if g == lang and word.endswith(old) and len(word) - len(old) >= 3]
        if hits := [x for x in tried if (lang, x[3]) in known]:
            want[lang, word] = min(hits)[3]
    assert want["xx", "kantos"] == "kantoerlings" and want["xx", "belus"] == "beluling" and ("xx", "abs") not in want
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if the known words were many
    try:
        for most in (paradigms.BROADCAST_RULES, 2):
            monkeypatch.setattr(paradigms, "BROADCAST_RULES", most)
            found = paradigms.lemmas_by_rule(w, r, k)
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning(lang" in plan and not [x for x in plan.splitlines() if "hashpartitioning" in x and "lemma#" in x]
            assert ("BroadcastHashJoin [lang" in plan) == (most > 2)
            rows = found.collect()
            assert {(x.lang, x.word): x.lemma for x in rows} == want and len(rows) == len(want)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pairs_of_endings_in_both_directions(spark):
    words = spark.createDataFrame(golden_words() + golden_words()[:7], "lang string, word string, n long")
    s = paradigms.ParadigmSettings(min_stems=3)
    got = {(r.lang, r.old, r.new): (r.stems, r.old_stems, r.new_stems) for r in paradigms.ending_pairs(words, s).collect()}
    assert got and all(got[g, new, old] == (n, b, a) for (g, old, new), (n, a, b) in got.items())
    cuts = {}
    for g, w, _ in golden_words() + golden_words()[:7]:
        for e in range(5):
            if len(w) - e >= 3:
                cuts.setdefault((g, w[len(w) - e :]), []).append(w[: len(w) - e])
    often = {x: v for x, v in cuts.items() if len(v) >= 3}
    want = {(g, a, b): sum(v.count(x) for x in u) for (g, a), u in often.items() for (h, b), v in often.items() if g == h and a[:1] != b[:1]}
    assert {x: n for x, n in want.items() if n >= 3} == {x: n for x, (n, _, _) in got.items()}
