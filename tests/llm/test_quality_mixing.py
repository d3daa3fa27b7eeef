import re

import pytest
from compare import difference, oracle

from logweir.llm import line_quality, mixing
from logweir.llm.queries import ORACLES, QUERIES
from conftest_llm import CLASHES

WORDS = re.compile("[^\x20\x09-\x0d]+")


def base_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def prose(seed, n=60):
    """Words without digits, which line normalisation would make equal."""
    def letters(k):
        return "".join(chr(97 + int(d)) for d in str(k))

    return " ".join(f"w{letters(seed)}x{letters(i * 7919 % 1000)}" for i in range(n))


def test_base_counts_match_brute_force(frame):
    repeat = "a b c d e f g h " * 5
    texts = [None, "", " \t\n ", "one", prose(1), repeat + prose(2), "x\ny\nx\n\n\nx\n", "é#ü$ \x0b| <a>", "a " * 3000,
             "a b c d e f g h i a b c d e f g h j " + prose(3)]
    rows = line_quality.base(frame(list(enumerate(texts)))).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows}
    assert got == {i: base_counts(t) for i, t in enumerate(texts)}
    failed = {r.doc_id: r.base_failed for r in rows}
    assert failed[0] and failed[8] and not failed[4]


def test_boilerplate_lines_deplete_documents_but_copies_do_not(frame):
    notice = "subscribe to our daily letter and never miss a story again from this lovely site of ours today"
    rows = [(i, f"{prose(i, 30)}\n{notice}", "a") for i in range(20)]
    rows += [(100 + i, f"{notice}\n{notice}\n{notice}\nshort body of words {prose(i, 2)} here", "a") for i in range(3)]
    rows += [(200 + i, prose(500), "a") for i in range(40)]  # copies of one text are no boilerplate
    rows += [(300, f"{prose(7, 30)}\n{notice}", "b")]  # not often on this host
    got = {r.doc_id: r for r in line_quality.judge(frame(rows)).collect()}
    assert all(got[i].kept and got[i].n_boilerplate_words == len(notice.split()) for i in range(20))
    assert not any(got[100 + i].kept for i in range(3))
    assert all(got[200 + i].kept and got[200 + i].n_boilerplate_words == 0 for i in range(40))
    assert got[300].kept and got[300].n_boilerplate_words == 0


@pytest.mark.parametrize("shared", [1, 4, 8, 12])
def test_templates_of_any_number_of_lines_go(frame, shared):
    template = [f"{prose(9_000 + i, 6)}" for i in range(shared)]
    own = {i: [prose(100 * i + k, 8) for k in range(4)] for i in range(40)}
    rows = [(i, "\n".join([*template[:shared // 2], *own[i], *template[shared // 2:]]), "a") for i in range(40)]
    rows += [(500, "\n".join([*template, prose(77, 3)]), "a")]  # little but template
    rows += [(600 + i, "\n".join([*own[3], prose(4, 20)]), "b") for i in range(40)]  # copies alone
    near = [prose(7_000 + k, 12) for k in range(10)]
    rows += [(700 + i, "\n".join([*near, prose(8_000 + i, 5)]), "c") for i in range(40)]  # near copies alone
    got = {r.doc_id: r.n_boilerplate_words for r in line_quality.judge(frame(rows)).collect()}
    assert {got[i] for i in range(40)} == {6 * shared} == {got[500]}
    assert {got[600 + i] for i in range(40)} == {got[700 + i] for i in range(40)} == {0}
    kept = {r.doc_id: r.text for r in line_quality.kept_documents(frame(rows)).collect()}
    assert kept.get(3) == ("\n".join(own[3]) if shared < 8 else None)  # with 8 lines most of the words are template


def test_share_of_a_host_counts(frame):
    line = "a line that is on some pages of a large host only and so stays where it is"
    rows = [(i, f"{prose(i, 25)}\n{line}" if i < 15 else prose(i, 25), "a") for i in range(1_600)]
    assert {r.n_boilerplate_words for r in line_quality.judge(frame(rows)).collect()} == {0}
    assert sum(r.n_boilerplate_words > 0 for r in line_quality.judge(frame(rows[:1_500])).collect()) == 15


def test_quality_edge_cases(frame):
    rows = [(None, prose(1)), (None, prose(2)), (5, prose(3), None), (5, prose(3), None), (5, "other"), (6, None), (7, ""),
            (8, prose(8, 20_000)), (9, prose(9, 900))]
    df = frame(rows, CLASHES)
    assert sorted((str(r.doc_id), r.kept) for r in line_quality.judge(df).collect()) == [
        ("5", False), ("5", True), ("5", True), ("6", False), ("7", False), ("8", False), ("9", True), ("None", True), ("None", True)]
    kept = line_quality.kept_documents(df)
    assert kept.columns == df.columns and kept.count() == 5
    assert kept.first()["row"] == "clash row"
    assert line_quality.judge(frame([])).count() == 0


def test_repeated_rows_do_not_count_lines_twice(frame):
    notice = "this very same line stands in all the pages of the host and in no others at all"
    rows = [(i, f"{prose(i, 30)}\n{notice}", "a") for i in range(15)] + [(0, f"{prose(0, 30)}\n{notice}", "a")] * 3
    got = line_quality.judge(frame(rows)).collect()
    assert {r.n_boilerplate_words for r in got} == {len(notice.split())}


def test_kept_documents_lose_their_boilerplate_lines(frame):
    notice = "Subscribe to our daily letter\tand never miss a story again, volume {}"
    bodies = {i: prose(i, 70) for i in range(20)}
    rows = [(i, f"\n{notice.format(i % 10)}\n\n{bodies[i]}\n  {notice.format(7)} \r\nend {bodies[i][:30]}\n", "a") for i in range(20)]
    rows += rows[:2] + [(50, f"{prose(50, 30)}\n{notice.format(1)}", "b")]  # rows that come again; not often on this host
    df = frame(rows, CLASHES)
    kept = line_quality.kept_documents(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.text, r.n_chars) for r in kept.collect())
    want = [(i, f"\n\n{bodies[i]}\nend {bodies[i][:30]}\n") for i in [*range(20), 0, 1]] + [(50, rows[-1][1])]
    assert got == sorted((i, text, len(text)) for i, text in want)


@pytest.mark.parametrize("name", ["op5_line_quality", "op8_mixing"])
def test_sql_gives_the_same(spark, sf_dir, name):
    assert difference(oracle(sf_dir), QUERIES[name](spark, sf_dir), ORACLES[name]) is None


def mixed(df, **settings):
    return sorted(((r.source, r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.mix(df, **settings).collect()), key=str)


def test_budgets_are_exact_and_follow_the_weights(frame):
    rows = [(i, "w " * (1 + i % 13), "abc"[i % 3]) for i in range(300)] + [(1000 + i, "w " * 50, None) for i in range(40)]
    got = mixed(frame(rows), rows_per_range=16)
    assert got == mixed(frame(rows[::-1]), rows_per_range=16) == mixed(frame(rows), rows_per_range=100_000)
    total = sum(r[2] for r in got)
    by_source = {}
    for source, _, size, source_size, target, taken in got:
        assert 0 <= taken <= 2 * size
        entry = by_source.setdefault(source, [source_size, target, 0, 0])
        entry[2] += taken
        entry[3] += size
    assert all(abs(e[2] - e[1]) <= 0.5 and e[0] == e[3] and e[1] <= 2 * e[0] for e in by_source.values())
    assert sum(e[1] for e in by_source.values()) == pytest.approx(1.5 * total)
    open_ = {s: e[1] / w for (s, e), w in zip(sorted(by_source.items(), key=lambda x: (x[0] is None, x[0])), (5, 2, 1, 5)) if e[1] < 2 * e[0]}
    assert len({round(v, 6) for v in open_.values()}) <= 1  # sources that are not full share by weight


def test_mixing_edge_cases(frame):
    assert mixed(frame([])) == []
    assert [r[2:] for r in mixed(frame([(1, None, "a"), (2, "", "a"), (3, " \n", None)]))] == [(0, 0, 0.0, 0)] * 3
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (None, "d e", None), (None, "d e", None), (2, "x " * 5000, "s")]
    got = mixed(frame(rows, ("row", "size", "taken", "key", "part", "twin")))
    assert len(got) == 5 and sum(r[5] for r in got) == pytest.approx(1.5 * sum(r[2] for r in got), abs=1)


def test_mixed_documents_hold_the_words_taken(frame):
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(1 + i % 9)) + "  \n", "abc"[i % 3]) for i in range(90)] + [(7, "p q r", "b")] * 2
    df = frame(rows, CLASHES)
    taken = {}
    for r in mixing.mix(df).collect():
        taken[r.doc_id] = taken.get(r.doc_id, 0) + r.taken
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert r.n_chars == len(r.text) and r.size == "clash size"
    assert words == {k: v for k, v in taken.items() if v}
