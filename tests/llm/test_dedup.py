import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from compare import difference, oracle
from conftest_llm import CLASHES
from pyspark.sql import functions as F

from logweir.llm import components, near_dup, suffix_dedup
from logweir.llm.queries import ORACLES, QUERIES


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def brute_components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    group = {i: i for i, _ in rows}

    def root(x):
        while group[x] != x:
            x = group[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            common = len(a & b)
            if common and 100 * common >= 75 * (len(a) + len(b) - common):
                lo, hi = sorted((root(i), root(j)))
                group[hi] = lo
    return {i: (len(s), root(i)) for i, s in sets}


def near_copies(seed=1):
    """Chains and stars of edited copies, short texts, and texts that share half."""
    rng = random.Random(seed)
    rows = []
    for _ in range(8):
        words = [f"w{rng.randrange(10_000)}" for _ in range(rng.choice([3, 12, 60, 200]))]
        for _ in range(rng.choice([2, 6, 12])):
            rows.append(" ".join(words).title() if rng.random() < 0.2 else "  ".join(words))
            if rng.random() < 0.8:
                at = rng.randrange(len(words))
                words = [*words[:at], f"e{rng.randrange(10_000)}", *words[at + rng.choice([0, 1]):]]
    rows += [None, "", " \n", "one", "One", "one two", "a b c d e f g h", "a b c d e f g x"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_match_brute_force(frame):
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.classify(frame(rows, CLASHES))[0].collect()}
    assert got == brute_components(rows)


def test_sql_gives_the_same(spark, sf_dir):
    assert difference(oracle(sf_dir), QUERIES["op4_near_dup"](spark, sf_dir), ORACLES["op4_near_dup"]) is None


def test_links_are_confirmed_and_cover_the_components(frame):
    rows = near_copies(2)
    texts = dict(rows)
    out, links = near_dup.classify(frame(rows))
    for r in links.collect():
        a, b = shingles(texts[r.a]), shingles(texts[r.b])
        assert 100 * len(a & b) >= 75 * len(a | b)
    assert out.filter("kept <> (doc_id = component_id)").count() == 0


def test_near_dup_edge_cases(frame):
    same = " ".join(f"x{i}" for i in range(40))
    df = frame([(None, same), (None, "alone here in the world today"), (3, same), (3, same), (2, None), (2, ""), (9, "y " * 30_000)], CLASHES)
    got = sorted(((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in near_dup.classify(df)[0].collect()))
    assert got == sorted([("None", 36, "3", False), ("None", 2, "None", True), ("3", 36, "3", True), ("3", 36, "3", True),
                          ("2", 0, "2", True), ("2", 0, "2", True), ("9", 1, "9", True)])
    kept = near_dup.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "2", "3", "9", "None"]
    assert near_dup.deduplicated(frame([])).count() == 0


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(4)
    for n in (1, 2, 7, 100, 3000):
        assert not (near_dup.sketches([rng.integers(0, 1 << 63, n, dtype=np.uint64)]) == near_dup._EMPTY).any()
    estimates = []
    for _ in range(60):
        base = rng.integers(0, 1 << 63, 700, dtype=np.uint64)
        a, b = near_dup.sketches([np.unique(base[:600]), np.unique(base[100:])])
        estimates.append((a == b).mean())
    assert abs(np.mean(estimates) - 500 / 700) < 0.03


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(30)]
    star = [(100, i) for i in range(101, 160)]
    late = [(200, 205), (205, 203), (203, 201), (202, 201), (300, 300)]
    df = spark.createDataFrame(chain + star + late, "a long, b long")
    got = {r.node: r.component for r in components.components(df).collect()}
    assert got == {**{i: 0 for i in range(31)}, **{i: 100 for i in range(100, 160)}, **{i: 200 for i in (200, 201, 202, 203, 205)}}
    assert components.components(df.limit(0)).count() == 0


# -- repeated bytes ----------------------------------------------------------------------------------------------------

def brute_removals(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        mask = np.zeros(len(data), bool)
        for q in range(len(data) - 99):
            gram = data[q:q + 100]
            if gram in seen:
                mask[q:q + 100] = True
            seen.add(gram)
        runs = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        left = np.frombuffer(data, np.uint8)[~mask].tobytes()
        out[doc_id] = (len(data), int(mask.sum()), runs, hashlib.sha256(left).hexdigest())
    return out


def shared_passages(seed=3, n=150):
    """Texts that share passages around the limit of 100 bytes, with runs, periods and characters of two bytes."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab ") for _ in range(rng.randint(1, 700))) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            r = rng.random()
            if r < 0.4:
                x = rng.choice(base)
                a = rng.randint(0, len(x))
                parts.append(x[a:a + rng.randint(0, 300)])
            elif r < 0.5:
                parts.append("xy" * rng.randint(1, 200))
            elif r < 0.6:
                parts.append("é" * rng.randint(1, 150))
            else:
                parts.append("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 200))))
        rows.append((i, "".join(parts)))
    return rows


def removed(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.removals(df).collect()}


def test_removed_bytes_match_brute_force(frame):
    rows = shared_passages()
    want = brute_removals(rows)
    assert sum(w[1] for w in want.values()) > 10_000
    assert removed(frame(rows, CLASHES)) == want


def batch(**columns):
    return pa.RecordBatch.from_pydict(columns)


@pytest.mark.parametrize("hot, buckets", [(4096, 1), (4096, 7), (2, 5)])
def test_hot_anchors_and_bucket_edges_change_nothing(monkeypatch, hot, buckets):
    """The same steps without Spark, with hot anchors split and splitters in the middle of groups."""
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    rows = shared_passages(5)
    tokens = []
    for _, text in rows:
        if len(text.encode()) >= 100:
            _, own, around = suffix_dedup.suffixes(text.encode())
            one = np.empty(len(own), [("own", np.uint64), ("around", np.uint64)])
            one["own"], one["around"] = own, around
            tokens.append(one)
    tokens = np.sort(np.concatenate(tokens), order=["own", "around"])
    splitters = np.unique(tokens[np.linspace(0, len(tokens), buckets + 1).astype(int)[1:-1]])

    def dealt(batches):
        parts = {}
        for b in batches:
            for part, kind, blob in zip(*[b.column(c).to_pylist() for c in ("part", "kind", "blob")]):
                parts.setdefault(part, []).append((kind, blob))
        return [batch(part=[p] * len(r), kind=[k for k, _ in r], blob=[x for _, x in r]) for p, r in parts.items()]

    fresh = []
    for half in (rows[::2], rows[1::2]):
        fresh += suffix_dedup._fingerprints(splitters, buckets)(iter([batch(doc=[i for i, _ in half], tk=[0] * len(half), text=[t for _, t in half])]))
    sure, open_, spans = {}, {}, {}
    for part in dealt(fresh):
        for b in suffix_dedup._compared(iter([part])):
            for doc, s, o in zip(*[b.column(c).to_pylist() for c in ("doc", "sure", "open")]):
                sure.setdefault(doc, []).extend([s] if s else [])
                open_.setdefault(doc, []).extend([o] if o else [])
    texts = dict(rows)
    asked = [d for d in open_ if open_[d]]
    opened = suffix_dedup._opened(buckets)(iter([batch(doc=asked, tk=[0] * len(asked), text=[texts[d] for d in asked], open=[open_[d] for d in asked])]))
    for part in dealt(opened):
        for b in suffix_dedup._settled(iter([part])):
            for doc, start, end in zip(*[b.column(c).to_pylist() for c in ("doc", "start", "end")]):
                spans.setdefault(doc, []).append({"start": start, "end": end})
    got = {}
    for doc, text in rows:
        data, kept, runs = suffix_dedup._cut_text(text, sure.get(doc), spans.get(doc))
        got[doc] = (len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest())
    assert got == brute_removals(rows)


def test_suffix_edge_cases(frame):
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefghij ") for _ in range(60_000))
    passage = "".join(rng.choice("éèàü") for _ in range(60))
    rows = [(1, None), (2, ""), (3, "short"), (4, long), (5, long), (5, long), (6, "x" + passage), (7, passage + "y"), (None, long), (8, "a" * 99)]
    df = frame(rows, CLASHES)
    got = {(r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.removals(df).collect()}
    assert got == {(1, 0, 0, 0), (2, 0, 0, 0), (3, 5, 0, 0), (4, 60_000, 0, 0), (5, 60_000, 60_000, 1), (6, 121, 0, 0), (7, 121, 120, 1),
                   (None, 60_000, 60_000, 1), (8, 99, 0, 0)}
    kept = suffix_dedup.deduplicated(df)
    assert kept.columns == df.columns and kept.count() == len(rows)
    assert {r.text for r in kept.filter("doc_id = 7").collect()} == {"y"}
    assert kept.filter("text IS NULL").count() == 1 and kept.first()["row"] == "clash row"
    assert suffix_dedup.removals(frame([])).count() == 0


def test_equal_rows_are_one_document(frame):
    """Rows equal in id and text, with no other document before them, lose nothing; what they share with others is cut from each."""
    rng = random.Random(11)

    def text(n):
        return "".join(rng.choice("abcdefghij ") for _ in range(n))

    shared = text(300)
    rows = [(5, text(3_000) + shared), (6, text(500) + shared + text(500)), (7, text(150)), (None, text(4_000))]
    want = brute_removals([(9 if i is None else i, t) for i, t in rows])
    want[None] = want.pop(9)
    assert [want[i][1] for i in (5, 6, 7, None)] == [0, 300, 0, 0]
    out = suffix_dedup.removals(frame(rows * 4)).collect()
    assert len(out) == 16 and all((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id] for r in out)


def test_null_ids_are_told_apart_by_more_than_31_bits(spark, frame):
    """Texts without an id whose 31-bit keys agree are different documents; ids there are come before them."""
    many = spark.range(400_000).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("text number "), "id").alias("text"))
    keyed = many.select("text", *suffix_dedup._identity())
    counts = keyed.agg(F.countDistinct("tk"), F.countDistinct("doc"), F.min("doc")).first()
    assert counts[0] < 400_000 == counts[1] and counts[2] >= 1 << 62
    pair = keyed.groupBy("tk").agg(F.array_sort(F.collect_list("text")).alias("t")).filter("size(t) = 2").first().t
    keys = frame([(None, pair[0]), (1 << 61, pair[0]), (None, pair[1])]).select("doc_id", *suffix_dedup._identity()).collect()
    first, second, third = sorted(keys, key=lambda r: r.doc)
    assert first.doc_id == first.doc == 1 << 61 and second.tk == third.tk and second.doc < third.doc


def test_multikey_order_sorts_like_tuples():
    rng = np.random.default_rng(2)
    columns = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(5)]
    order = suffix_dedup.multikey_order(columns)
    rows = list(zip(*columns))
    assert [rows[i] for i in order] == sorted(rows)


@pytest.mark.parametrize("often, block", [(48, 1024), (2, 1024), (48, 3)])
def test_dense_groups_lose_no_link(frame, monkeypatch, often, block):
    """Many copies of one text, each with its own edits, around the threshold; units of a few classes too."""
    monkeypatch.setattr(near_dup, "OFTEN", often)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    rng = random.Random(9)
    words = [f"w{k}" for k in range(90)]
    rows = []
    for i in range(60):
        edited = list(words)
        for at in rng.sample(range(90), rng.choice([0, 1, 2, 3, 4])):
            edited[at] = f"e{i}x{at}"
        rows.append((i, " ".join(edited)))
    want = brute_components(rows)
    assert 3 < len({c for _, c in want.values()}) < 50
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.classify(frame(rows))[0].collect()}
    assert got == want


def test_common_counts():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50)).astype(np.uint64)) for _ in range(30)]
    counts = near_dup.common_counts(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or counts[i, j] == len(np.intersect1d(a, b))
