import hashlib
from collections import Counter

import numpy as np
import pytest
import public_tokenizers
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from logweir.llm import token_align
from conftest_llm import CLASHES

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def plain_groups(libraries, text):
    """Groups and links by walking both lists of ends."""
    a_lib, b_lib = libraries
    if not text:
        return [], []
    raw = b" " + text.encode()
    symbols = {s: i for i, s in enumerate(token_align.byte_symbols())}
    a = [(i, bytes(symbols[c] for c in a_lib.id_to_token(i))) for i in a_lib.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(b_lib.id_to_piece(i)[3:5], 16)]) if b_lib.is_byte(i) else b_lib.id_to_piece(i).replace("▁", " ").encode())
         for i in b_lib.encode(text)]
    if b"".join(t for _, t in a) != raw or b"".join(t for _, t in b) != raw:
        return [], []

    def spans(tokens):
        at, out = 0, []
        for i, t in tokens:
            out.append((i, at, at + len(t)))
            at += len(t)
        return out

    sa, sb = spans(a), spans(b)
    shared = sorted({e for *_, e in sa} & {e for *_, e in sb})
    groups, start = [], 0
    for end in shared:
        groups.append(([i for i, s, e in sa if start <= s and e <= end], [i for i, s, e in sb if start <= s and e <= end]))
        start = end
    links = [(i, j) for i, s, e in sa for j, s2, e2 in sb if s < e2 and s2 < e]
    return groups, links


def expected(libraries, texts):
    found = [plain_groups(libraries, t) for t in texts]
    counts = Counter(p for _, links in found for p in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    rows = []
    for groups, links in found:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        rows.append((sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                     sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links),
                     hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return rows


TEXTS = [None, "", " ", "x", "the cat sat on the mat", "the cat sat on the mat", "a▁b", "café naïve 日本語 \U0001f600\U0001f3fd",
         "<|endoftext|> <s> </s> <unk>", "  lead\n\n\ttabs  and   runs ", "\x00\x01﻿", "pneumonoultramicroscopic 0xDEADBEEF 3.14159",
         "Eraned ofthstthor " * 40, "é́́ ﬁ", "'s 't don't"]


def test_digests_match_brute_force(spark, frame, libraries):
    got = token_align.digests(frame(list(enumerate(TEXTS)), CLASHES), A, B).collect()
    want = expected(libraries, TEXTS)
    assert {r[0]: tuple(r)[1:] for r in got} == dict(enumerate(want))
    assert got[0].__fields__ == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_counts_run_over_all_blocks(spark, frame, libraries, monkeypatch):
    monkeypatch.setattr(token_align, "BLOCK_ROWS", 2)
    texts = TEXTS * 2
    got = token_align.digests(frame([(None if i % 7 == 3 else i % 9, t) for i, t in enumerate(texts)]), A, B).collect()
    want = [(None if i % 7 == 3 else i % 9, *w) for i, w in enumerate(expected(libraries, texts))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_groups_and_vocabulary_links(spark, frame, libraries):
    docs = frame(list(enumerate(TEXTS)))
    got = {r.doc_id: [(g.a, g.b) for g in r.groups] for r in token_align.align(docs, A, B).collect()}
    assert got == {i: plain_groups(libraries, t)[0] for i, t in enumerate(TEXTS)}
    links = token_align.vocabulary_links(token_align.aligned_blocks(docs, A, B), libraries[1].get_piece_size()).collect()
    counts = Counter(p for t in TEXTS for p in plain_groups(libraries, t)[1])
    assert {(r.a_id, r.b_id): r.n for r in links} == counts
    assert all(r.best == (r.n == max(n for (_, b), n in counts.items() if b == r.b_id)) for r in links)


def test_empty_table(spark, frame):
    assert token_align.digests(frame([]), A, B).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" aeionrst\n.'0")), max_size=40), max_size=4))
def test_any_texts(libraries, texts):
    block = token_align.Block(token_align.pair_of(A, B), texts)
    assert [[(g["a"], g["b"]) for g in gs] for gs in block.groups()] == [plain_groups(libraries, t)[0] for t in texts]
    doc, pairs = block.links()
    got = Counter(zip(doc.tolist(), *(x.tolist() for x in np.divmod(pairs, block.pair.size_b))))
    assert got == Counter((i, *p) for i, t in enumerate(texts) for p in plain_groups(libraries, t)[1])


def test_cuts_of_any_ends():
    rng = np.random.default_rng(3)
    for dense in (0.02, 0.3, 0.9):
        for n in (1, 2, 7, 500):
            ends_a = np.flatnonzero(np.r_[rng.random(n) < dense, True])
            ends_b = np.flatnonzero(np.r_[rng.random(n) < dense, True])
            cuts = token_align.shared_cuts(ends_a, ends_b, np.array([0]), np.array([ends_a.size - 1]))
            assert ends_a[cuts].tolist() == np.intersect1d(ends_a, ends_b).tolist()


def test_long_texts_are_cut_without_a_trace(libraries, monkeypatch):
    text = "Don't stop, 12 cafés of the night. x y  z\n" * 60
    whole = token_align.pair_of(A, B).encode(text)
    monkeypatch.setattr(token_align, "PIECE", 20)
    assert len(token_align.pair_of(A, B).pieces(text)) > 20
    assert token_align.pair_of(A, B).encode(text) == whole
    assert whole == (libraries[0].encode(" " + text, add_special_tokens=False).ids, libraries[1].encode(text))
    long = "naïve words, here and " * 40_000
    assert len(token_align.pair_of(A, B).encode(long)[0]) > 200_000


def test_a_middle_that_is_a_cut_costs_one_search(monkeypatch):
    asked, search = [], np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda ends, at: (asked.append(np.size(at)), search(ends, at))[1])
    ends = np.arange(1, 1001)
    assert token_align.shared_cuts(ends, ends, np.array([0]), np.array([999])).tolist() == list(range(1000))
    assert sum(asked) == 999
