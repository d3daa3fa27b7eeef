import random
import zlib

import numpy as np
import pytest
from conftest_llm import CLASHES
from pyspark.sql import functions as F

from logweir.llm import folds, language, license_scan, toxicity
from logweir.llm.license_templates import TEXTS


def is_held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 4 == 2


def test_held_out_fold(spark):
    ids = [None, *range(200)]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("h", folds.held_out())
    assert {r.doc_id: r.h for r in df.collect()} == {i: is_held_out(i) for i in ids}


# -- licenses ----------------------------------------------------------------------------------------------------------

def licenses(text):
    return [(r["license"], r["exact"], text[r["first_char"]:r["last_char"]]) for r in license_scan.Scanner().text(text)]


def test_notices_among_other_words():
    filler = "Some words that stand before and say nothing of it. "
    for notice, name in (("Licensed under the Apache License, Version 2.0", "Apache-2.0"), ("Released under the MIT License", "MIT"),
                         ("Licensed under CC BY-NC 4.0", "CC-BY-NC-4.0"), ("All rights reserved", "Proprietary"),
                         ("This work is licensed under the GNU General Public License, version 3", "GPL-3.0")):
        assert licenses(f"{filler}{notice}. {filler}") == [(name, True, notice)]
    assert [x[0] for x in licenses(f"{filler}Released under the MIT License. All rights reserved. {filler}")] == ["MIT", "Proprietary"]


def test_full_texts_and_wording_differences():
    for name in ("MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "GPL-2.0-or-later", "GPL-3.0-or-later"):
        text = "Copyright (c) 2020 Somebody\n\n" + TEXTS[name].replace("\n", "\n * ")
        assert [(a, b) for a, b, _ in licenses(text)] == [(name, True)], name
    changed = license_scan.Scanner().text(TEXTS["MIT"].replace("free of charge", "for a fee"))
    assert [(r["license"], r["exact"], r["missing"], r["extra"]) for r in changed] == [("MIT", False, "free of charge", "for a fee")]


def test_what_is_no_license():
    for text in (None, "", "I have no license to drive, and no warranty.", "Licensed under the Apache License, Version 1.1.", "permission"):
        assert license_scan.Scanner().text(text) == []


def test_license_scan_over_a_table(frame):
    notice = "Licensed under CC BY-NC 4.0."
    df = frame([(1, None), (2, ""), (None, notice), (3, notice), (3, notice), (4, "word " * 30_000 + notice + " other" * 30_000)], CLASHES)
    got = sorted((str(r.doc_id), r.license, r.exact, r.first_char) for r in license_scan.scan(df).collect())
    assert got == [("3", "CC-BY-NC-4.0", True, 0)] * 2 + [("4", "CC-BY-NC-4.0", True, 150_000), ("None", "CC-BY-NC-4.0", True, 0)]
    assert license_scan.scan(frame([])).count() == 0


# -- toxicity ----------------------------------------------------------------------------------------------------------

def kinds(text):
    return dict(toxicity.Grammar(frozenset()).emitted(text)[0])


def test_the_clause_decides():
    assert kinds("that was stupid") == {toxicity.PLAIN: 1}
    assert kinds("you are an idiot!") == {toxicity.AIMED: 1}
    assert kinds("he is not stupid") == {toxicity.NEGATED: 1}
    assert kinds('she said "idiot" to them') == {toxicity.REPORTED: 1}
    assert kinds("I will kill you") == {4 + toxicity.PLAIN: 1} and kinds("you I kill") == {4 + toxicity.AIMED: 1}
    assert kinds("not here. Stupid") == {toxicity.PLAIN: 1}  # a new clause forgets
    assert kinds("no a b c d stupid") == {toxicity.PLAIN: 1}  # so does distance
    assert kinds("1d1ot stuuuupid ***scum###") == {toxicity.PLAIN: 3}
    assert kinds(None) == kinds("") == kinds("a stupidity of mine") == {}


def test_composed_table_has_every_state_and_input():
    following, emits = toxicity.compose()
    assert following.shape == emits.shape and following.max() < len(following)
    assert (emits[:, :toxicity.INSULT] == -1).all() and (emits[:, toxicity.INSULT:] >= 0).all()


@pytest.fixture(scope="module")
def labelled_docs():
    """Toxic texts hold words on a stem nobody listed, one in four documents is held out."""
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(60), "zqorv" + rng.choice(["an", "eth", "ing", "u", "iss"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_stems_are_learned_without_the_held_out(spark, frame, labelled_docs):
    rows, labels = labelled_docs
    flipped = [(i, q, 1 - t if is_held_out(i) else t) for i, q, t in labels]  # must make no difference
    scores = []
    for given in (labels, flipped):
        marks = spark.createDataFrame(given, "doc_id long, quality int, toxic int")
        grammar = toxicity.learn(frame(rows), marks)
        scores.append({r.doc_id: r for r in toxicity.score(frame(rows), grammar).collect()})
    assert {i: r.score for i, r in scores[0].items()} == {i: r.score for i, r in scores[1].items()}
    held = [(scores[0][i].predicted, t) for i, _, t in labels if is_held_out(i)]
    assert len(held) > 100 and np.mean([p == t for p, t in held]) > 0.95
    assert all(r.held_out == is_held_out(i) and 0 <= r.score <= 1 for i, r in scores[0].items())


def test_toxicity_edge_cases(spark, frame):
    rows = [(None, "you idiot"), (1, None), (2, ""), (3, "fine"), (4, "you idiot"), (4, "you idiot"), (5, "word " * 30_000 + "you scum")]
    df = frame(rows, CLASHES)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    odd = spark.createDataFrame([(None, 1, 1), (4, 1, None), (3, 0, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    for marks in (none, odd):
        got = [(r.doc_id, round(r.score, 6), r.predicted) for r in toxicity.score(df, toxicity.learn(df, marks)).collect()]
        by_id = {i: s for i, s, _ in got}
        assert len(got) == 7 and by_id[1] == by_id[2] == by_id[3] < by_id[4] == by_id[None] and by_id[5] > by_id[3]
        assert all(p == int(s >= 0.3) for _, s, p in got)
    assert toxicity.score(frame([]), toxicity.learn(frame([]), none)).count() == 0


# -- language ----------------------------------------------------------------------------------------------------------

def test_gradients_match_differences():
    network = language.Network.fresh(["a", "b", "c"], hidden=4)
    network.weights = {k: v.astype(np.float64) for k, v in network.weights.items()}
    data, labels = np.frombuffer(b"abcabcbbacca", np.uint8).reshape(3, 4), np.array([0, 2, 1])
    _, grads = network.gradients(data, labels)
    rng = np.random.default_rng(1)
    for name, w in network.weights.items():
        for _ in range(6):
            at = tuple(int(rng.integers(n)) for n in w.shape) if name[0] != "x" else (int(rng.integers(97, 100)), int(rng.integers(w.shape[1])))
            kept, losses = w[at], []
            for step in (1e-3, -1e-3):
                w[at] = kept + step
                losses.append(network.gradients(data, labels)[0])
            w[at] = kept
            assert grads[name][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, rel=0.02, abs=2e-5)


def test_a_run_counts_the_same_wherever_it_stands():
    pool = language.Pool(language.Network.fresh(["a", "b"]))
    one = list(pool.predict(["abc def"]))[0]
    twice = list(pool.predict(["abc def abc def"]))[0]
    assert twice[0] == one[0] and twice[1] == pytest.approx(one[1], abs=1e-6)
    assert language.runs("x" * 200) == [b"x" * 64, b"x" * 64, b"x" * 64, b"x" * 8]


def test_languages_are_told_apart(frame):
    syllables = {"en": ["th", "ing", "er", "on", "and"], "de": ["sch", "ung", "ch", "ei", "ü"], "el": ["κα", "ος", "τη", "ου"]}
    rng = random.Random(2)
    rows = [(i, " ".join("".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(40)), "s", lang)
            for i, lang in enumerate(["en", "de", "el"] * 60)]
    odd = [(1000, None, None, None), (1001, "", None, "en"), (1002, "123 !?", None, "de"), (None, "thing on and", None, None),
           (1003, "schung " * 20_000, "x", "en"), (1003, "schung " * 20_000, "x", "en")]
    df = frame(rows + odd, [c for c in CLASHES if c not in ("score", "held_out")] + ["score", "held_out", "lang_pred"])
    got = language.predict(df, language.learn(frame(rows))).collect()
    assert len(got) == len(rows) + len(odd)
    by_id = {r.doc_id: r for r in got}
    assert np.mean([by_id[i].lang_pred == lang for i, _, _, lang in rows if is_held_out(i)]) > 0.95
    assert [(by_id[i].lang_pred, by_id[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert by_id[None].lang_pred == "en" and by_id[1003].lang_pred == "de"
    assert all(0 <= r.score <= 1 and r.held_out == is_held_out(r.doc_id) for r in got)


def test_held_out_languages_are_not_learned(frame):
    rows = [(i, "abc def", None, "xx" if is_held_out(i) else "yy") for i in range(40)]
    network = language.learn(frame(rows))
    assert network.languages == ["yy"]
    assert {r.lang_pred for r in language.predict(frame(rows), network).collect()} == {"yy"}


def test_nothing_to_learn_from(frame):
    assert language.learn(frame([])) is None
    rows = [(1, "abc"), (2, None)]
    assert {(r.lang_pred, r.score) for r in language.predict(frame(rows), language.learn(frame(rows))).collect()} == {("und", 0.0)}
    assert language.predict(frame([]), None).filter(F.col("doc_id") > 0).count() == 0


def test_signs_are_no_letters():
    """Superscripts, fractions and circled digits count as numbers: they divide runs and make no text a language's."""
    assert language.runs("² ½ ② _1") == [] and language.runs("x²y Ab") == [b"x", b"y", b"ab"]
    assert language.runs("ªº ǅ ヂ") == ["ªº".encode(), "ǆ".encode(), "ヂ".encode()]
