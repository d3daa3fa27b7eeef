import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from logweir.llm import collocations
from conftest_llm import CLASHES


def pieces_of(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return [re.findall("[^ \t]+", p) for p in re.split("[.,;:!?\n-\r]", lower)]


def plain_counts(rows):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        for w in pieces_of(text or ""):
            n[lang or "und"] += len(w)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    return f, n


def plain(rows, least, top=2000):
    counts, n = plain_counts(rows)
    out = []
    for lang, f in counts.items():
        candidates = [p for p in f if len(p) > 1 and f[p] >= least]
        kept = []
        for p in candidates:
            score, k = min((2_000_000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * f[q] >= 80 * f[p] for q in candidates):
                kept.append((-score, -f[p], " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def made_texts(seed, n):
    rng = random.Random(seed)
    words = ["New", "york", "city", "state", "of", "THE", "art", "machine", "learning", "é", "Éa", "x\x1cy", "nb\xa0sp", "日本", "o'clock"]
    fixed = ["in new york city today", "state of the art", "Machine  learning\tof the art", "a b a b a b a b"]
    out = []
    for _ in range(n):
        parts = [rng.choice(fixed) if rng.random() < 0.4 else " ".join(rng.choices(words, k=rng.randint(1, 6))) for _ in range(rng.randint(1, 12))]
        out.append("".join(p + rng.choice([". ", ", ", "\n", "!?", " ", "\x0b", ";\r\n"]) for p in parts))
    return out


@pytest.mark.parametrize("every", [1, 3, 32])
def test_equal_to_brute_force(spark, frame, monkeypatch, every):
    monkeypatch.setattr(collocations, "EVERY", every)
    texts = made_texts(every, 150)
    langs = [None, "en", "de", "und"]
    rows = [(i % 50, t, None, langs[i % 4]) for i, t in enumerate(texts)] + [(1, None, None, "en"), (2, "", None, "en"), (3, " .\n", None, "fr")]
    rows += [(900 + i, texts[0], None, "en") for i in range(60)]  # copies
    rows.append((999, "the art of " * 30_000, None, "en"))  # a very long text without many triggers
    got = collocations.collocations(frame(rows, [c for c in CLASHES if c != "lang"]), least=20)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain([(r[1], r[3]) for r in rows], 20)


def test_top_and_ties(spark, frame):
    rows = [(i, "aa bb. cc dd. ee ff. éé gg", None, "en") for i in range(40)]
    got = collocations.collocations(frame(rows), top=3).orderBy("rank").collect()
    assert [(r.rank, r.phrase, r.score) for r in got] == [(1, "aa bb", 1_000_000), (2, "cc dd", 1_000_000), (3, "ee ff", 1_000_000)]


def test_counts_beyond_64_bits(spark, frame, monkeypatch):
    big = 1 << 60
    counts = [("en", "a", big + 7, 1), ("en", "b", big, 1), ("en", "a b", big - 1, 2), ("en", "", 2 * big, 1)]
    monkeypatch.setattr(collocations, "frequent_phrases", lambda docs, least: spark.createDataFrame(counts, "lang string, phrase string, a long, words int"))
    row = collocations.collocations(frame([])).collect()[0]
    assert row.score == 2_000_000 * (big - 1) // (2 * big + 7)


def test_empty_table(spark, frame):
    assert collocations.collocations(frame([])).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab A.\n\t,é"), max_size=60), max_size=6), st.integers(1, 4))
def test_parse_counts_every_gram_once(texts, every):
    collocations.EVERY, before = every, collocations.EVERY
    try:
        parse = collocations.chunks(texts, ["x"] * len(texts))
    finally:
        collocations.EVERY = before
    keys = list(parse)
    grams = collocations.Grams(pa.array([k[0] for k in keys], pa.string()), pa.array([k[1].decode() for k in keys], pa.string()), np.array([k[2] for k in keys], bool),
                               np.array([parse[k] for k in keys], np.int64))
    all_known = np.full(collocations.BITS // 8, 255, np.uint8)
    want = plain_counts([(t, "x") for t in texts])[0]["x"]
    for n in range(1, 5):
        got = {tuple(r["phrase"].split(" ")): r["a"] for r in grams.totals().to_pylist() if r["phrase"]}
        assert got == {p: c for p, c in want.items() if len(p) == n}
        grams.longer(all_known, min(n, 2))
