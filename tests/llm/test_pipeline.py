"""The pipeline's stages on the small table: each keeps what it must, and all but the last return documents."""

import collections
import re

import pytest
from helpers import documents, odd_rows
from test_operators import base_spans, slow_keep

import corpus_pipeline

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    out["documents"] = docs
    for n, (name, f) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(n))
        f(spark, docs, sf_dir).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
    return out


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "pii", "mixing", "packing"]
    for name in names[:-1]:
        assert stages[name].dtypes == stages["documents"].dtypes


def test_language_keeps_what_has_letters(stages):
    """All documents of the table are in languages that it labels; the distance is looked at in test_operators."""
    want = {r.doc_id for r in stages["documents"].collect() if any(ch.isalpha() for ch in r.text or "")}
    assert {r.doc_id for r in stages["language"].collect()} == want


def test_one_of_each_group(stages):
    rows = sorted(stages["language"].collect(), key=lambda r: r.doc_id)
    assert collections.Counter(r.doc_id for r in stages["near_dedup"].collect()) == slow_keep([(r.doc_id, r.text) for r in rows])


def test_redacted(stages):
    before, after = ({r.doc_id: r for r in stages[n].collect()} for n in ("near_dedup", "pii"))
    assert set(before) == set(after)
    for i, r in before.items():
        spans = base_spans(r.text)
        assert all(r.text[a:b] not in after[i].text for _, a, b in spans) and not base_spans(after[i].text)
        assert spans or after[i].text == r.text


def test_mixed(stages):
    size = lambda rows: collections.Counter({s: sum(len(WORD.findall(r.text)) for r in rows if r.source == s) for s in {r.source for r in rows}})
    from test_operators import water_fill

    before, after = size(stages["pii"].collect()), size(stages["mixing"].collect())
    assert all(abs(after[s] - t) <= 1 for s, t in water_fill(before).items())


def test_packed(spark, sf_dir, stages):
    from test_operators import check_pieces
    from tokenizers import Tokenizer

    from quarrymill.llm.packing import tokenizer_paths

    t = Tokenizer.from_file(tokenizer_paths()[0])
    check_pieces(stages["packing"].collect(), collections.Counter((r.doc_id, (*t.encode(r.text, add_special_tokens=False).ids, 0)) for r in stages["mixing"].collect()))
    assert corpus_pipeline.run(spark, sf_dir).agg({"length": "sum"}).first()[0] == stages["packing"].agg({"length": "sum"}).first()[0]


def test_odd_rows_go_through(spark, tmp_path):
    docs = documents(spark, odd_rows())
    for n, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs, "").write.parquet(str(tmp_path / str(n)))
        docs = spark.read.parquet(str(tmp_path / str(n)))
    assert docs.count() > 0
    empty = documents(spark, odd_rows()).where("false")
    for n, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, empty, "").write.parquet(str(tmp_path / f"e{n}"))
        empty = spark.read.parquet(str(tmp_path / f"e{n}"))
    assert empty.count() == 0
