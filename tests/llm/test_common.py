import pyarrow as pa

from logweir.llm import common


def test_slices_bound_rows_and_bytes():
    texts = ["a" * 10, None, "b" * 100, "c" * 1000, "", "d" * 10] * 20
    batch = pa.RecordBatch.from_pydict({"text": texts, "n": list(range(len(texts)))})
    parts = list(common.slices(batch, rows=7, size=300))
    assert [x for p in parts for x in p.column("n").to_pylist()] == list(range(len(texts)))
    for p in parts:
        assert p.num_rows <= 7 and (p.num_rows == 1 or sum(len(t or "") for t in p.column("text").to_pylist()) <= 300)
    assert list(common.slices(batch.slice(0, 0))) == []


def test_words_are_cut_at_the_six_white_space_bytes():
    assert common.words_of(" a\x0bb\x0cc\td\re\nf\x1cg\xa0h ") == ["a".encode(), b"b", b"c", b"d", b"e", "f\x1cg\xa0h".encode()]
    assert common.words_of(None) == common.words_of("") == []
