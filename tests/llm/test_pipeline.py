import json
import random
import subprocess
import sys
from pathlib import Path

import corpus_pipeline
from conftest_llm import CLASHES

from logweir.llm import bpe, line_quality, near_dup, suffix_dedup
from logweir.llm.common import tokenizer_path
from logweir.llm.queries import ORACLES, QUERIES

ROOT = Path(__file__).resolve().parents[2]


def corpus(seed=1):
    rng = random.Random(seed)

    def prose(n):
        return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n))

    passage = prose(40)
    rows = [(i, prose(rng.randint(30, 80)), "abc"[i % 3], "en") for i in range(40)]
    rows += [(100 + i, rows[i][1], "a", "en") for i in range(5)]  # copies
    rows += [(200 + i, rows[10 + i][1] + " tail", "b", "en") for i in range(5)]  # near copies
    rows += [(300 + i, f"{prose(40)} {passage} {prose(30)}", None, "en") for i in range(4)]  # a shared passage
    rows += [(400, "too short", "a", "en"), (401, None, "a", None), (402, "", None, None), (None, prose(50), "c", "fr")]
    return rows


def test_stages_one_after_another(spark, frame, tmp_path):
    """Each stage's rows are those that brute force or the operator's own table gives on the stage's input."""
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    docs = frame(corpus(), CLASHES)
    columns = docs.columns
    inputs = {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = docs
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != names[-1]:
            assert docs.columns == columns

    def ids(df):
        return sorted(str(r.doc_id) for r in df.select("doc_id").collect())

    kept = {r.doc_id for r in line_quality.judge(inputs[names[0]]).filter("kept").collect()}
    assert ids(inputs[names[1]]) == sorted(map(str, kept)) and 400 not in kept and 401 not in kept and None in kept
    reps = [r.doc_id for r in near_dup.classify(inputs[names[1]])[0].filter("kept").collect()]
    assert ids(inputs[names[2]]) == sorted(map(str, reps)) and not {100, 104, 200, 204} & set(reps) and {0, 10, 303} <= set(reps)
    left = {r.doc_id: r.n_bytes - r.n_removed for r in suffix_dedup.removals(inputs[names[2]]).collect()}
    assert {r.doc_id: len(r.text.encode()) for r in inputs[names[3]].collect()} == left
    assert left[301] < 40 * 9 + 30 * 9 + 60
    mixed = inputs[names[4]].collect()
    per_source = {}
    for r in mixed:
        per_source[r.source] = per_source.get(r.source, 0) + len(r.text.split())
    total = sum(len(r.text.split()) for r in inputs[names[3]].collect())
    assert abs(sum(per_source.values()) - 1.5 * total) < 4
    coder = bpe.tokenizer(tokenizer_path())
    want = sorted((str(r.doc_id), *x) for r, x in zip(mixed, coder.texts([r.text for r in mixed])))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids, r.decoded) for r in docs.collect()) == want


def test_run_over_the_tables(spark, sf_dir):
    assert QUERIES["pipeline"] is corpus_pipeline.run and "pipeline" not in ORACLES
    rows = corpus_pipeline.run(spark, sf_dir)
    assert rows.columns == ["doc_id", "lang", "source", "n_tokens", "ids", "decoded"]
    assert rows.filter("n_tokens <> size(split(ids, ' '))").count() == 0 and rows.count() > 100


def test_every_operator_is_registered_once():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name != "pipeline")
    assert numbers == list(range(1, 14))


def test_nothing_else_imports_the_subpackage():
    code = ("import json, sys\nimport logweir.plans, logweir.streaming.ingest, logweir.operators.reports\n"
            "print(json.dumps([m for m in sys.modules if m.startswith('logweir.llm') or m == 'corpus_pipeline']))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, check=True)
    assert json.loads(out.stdout.strip().splitlines()[-1]) == []
