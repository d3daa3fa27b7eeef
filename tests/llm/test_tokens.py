import hashlib
import random

import pytest
import tokenizers
from conftest_llm import CLASHES
from hypothesis import given, settings, strategies as st

from logweir.llm import bpe
from logweir.llm.common import tokenizer_path

ODD = ["", "  \n\t", "don't we'll I'M they're", "<|endoftext|>", "a<|startoftext|>b <|endoftext|>c", "<|endoftext", "ΑΣ ΟΔΟΣ", "İstanbul",
       "a\x1cb\x85c\xa0d e", "Ångström", "中文 字", "x" * 5_000, "a" * 37, "hahahahahaha", "1234 5６7", "$$$ ### !!", "\x00\x01", "🙂🙂 ok"]


@pytest.fixture(scope="module")
def reference():
    return tokenizers.Tokenizer.from_file(tokenizer_path())


def expected(reference, text):
    ids = reference.encode(text or "", add_special_tokens=False).ids
    return len(ids), " ".join(map(str, ids)), reference.decode(ids, skip_special_tokens=False)


def test_odd_texts(reference):
    coder = bpe.tokenizer(tokenizer_path())
    assert list(coder.texts(ODD)) == [expected(reference, t) for t in ODD]
    assert list(coder.texts([None])) == [(0, "", "")]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs", "Cn"]), st.sampled_from("abcdeinorst '<|>")), max_size=40))
def test_any_text(text):
    coder = bpe.tokenizer(tokenizer_path())
    reference = _reference()
    assert list(coder.texts([text])) == [expected(reference, text)]


def _reference(kept=[]):
    if not kept:
        kept.append(tokenizers.Tokenizer.from_file(tokenizer_path()))
    return kept[0]


def merged(word, merges, end):
    """Textbook BPE: merge the leftmost pair of lowest rank until there is none."""
    ranks = {m: i for i, m in enumerate(merges)}
    parts = [*word[:-1], word[-1] + end]
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in ranks]
        if not pairs:
            return parts
        _, i = min(pairs)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


@pytest.mark.parametrize("seed", range(25))
def test_automaton_accepts_what_merging_gives(seed):
    """Random merge lists over two letters, with overlapping and self-overlapping pairs."""
    rng = random.Random(seed)
    vocab = ["a", "b", "a</w>", "b</w>"]
    merges = []
    for _ in range(rng.randint(1, 14)):
        left, right = rng.choice([t for t in vocab if not t.endswith("</w>")]), rng.choice(vocab)
        if left + right not in vocab:
            merges.append((left, right))
            vocab.append(left + right)
    automaton = bpe.Automaton({t: i for i, t in enumerate(vocab)}, merges)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randint(1, 14))) for _ in range(150)})
    for word, ids in zip(words, automaton.encode_sorted(words)):
        assert [vocab[i] for i in ids] == merged(word, merges, "</w>"), (word, merges)


def test_digests_and_edge_cases(frame, reference):
    rows = [(i, t) for i, t in enumerate(ODD) if "\x00" not in t] + [(None, "x"), (1, "twice"), (1, "twice"), (99, None)]
    got = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(frame(rows, CLASHES), tokenizer_path()).collect())

    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    want = [expected(reference, t) for _, t in rows]
    assert got == sorted((str(i), n, sha(ids), sha(back)) for (i, _), (n, ids, back) in zip(rows, want))
    assert bpe.encode(frame([]), tokenizer_path()).count() == 0
    one = bpe.encode(frame([(4, "Hello there", "s", "en")]), tokenizer_path(), ("lang", "source")).first()
    assert (one.doc_id, one.lang, one.source, one.n_tokens) == (4, "en", "s", 2)
    assert (one.ids, one.decoded) == expected(reference, "Hello there")[1:]


def test_wrong_merge_lists_are_refused():
    with pytest.raises(ValueError):
        bpe.Automaton({"a": 0, "b": 1, "ab": 2, "abb": 3, "a</w>": 4}, [("ab", "b"), ("a", "b")])
