"""The five stages on a small folder of tables, each against brute force on its own input."""

import public_tokenizers
import pytest

import corpus_pipeline
from quantloom.llm import language_id, toxicity
from quantloom.llm.tokenizers import load

from . import cases

ROWS = [(i, cases.prose(i, 90)) for i in range(60)]
ROWS += [(100 + i, cases.prose(i, 90).replace(" ", "\n", 3)) for i in range(5)]  # equal but for white space
ROWS += [(200 + i, cases.prose(i, 90) + " tail") for i in range(5)]  # near copies
ROWS += [(300, None), (301, ""), (302, "12 !!"), (303, "ЖЩ " * 40)]
ROWS += [(400 + i, cases.prose(500 + i, 80) + " grubnok" + "abcd"[i % 4] + " and grubnok" + "efgh"[i % 3]) for i in range(80)]
ROWS += [(7, cases.prose(7, 90)), (None, cases.prose(900, 70)), (None, cases.prose(900, 70))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), "clash") for i, t in ROWS],
                                 "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs.write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, int(400 <= i < 500)) for i, _ in ROWS if i is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def pairs(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=lambda x: (x[0] is not None, x))


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        found = stage(spark, docs, folder)
        if i < 4:
            assert found.columns == corpus_pipeline.COLUMNS
            found.write.parquet(str(tmp_path / str(i)))
            docs = spark.read.parquet(str(tmp_path / str(i)))
            kept.append(pairs(docs))
        else:
            packed = found.collect()
    key = lambda x: (x[0] is not None, x)
    # language: exactly the texts without letters and the foreign one go
    assert kept[0] == sorted([(i, t) for i, t in ROWS if i not in (300, 301, 302, 303)], key=key)
    # toxicity: clean documents stay, toxic ones go
    assert [x for x in kept[1] if x[0] is None or x[0] < 400] == [x for x in kept[0] if x[0] is None or x[0] < 400]
    assert sum(x[0] is not None and x[0] >= 400 for x in kept[1]) <= 4
    # exact: one row of each group of equal texts
    decided = cases.exact(kept[1])
    want = {(i, t) for (i, t), d in zip(kept[1], decided) if d[3]}
    assert sorted(want, key=key) == kept[2]
    # near: the smallest id of each component
    near = cases.near(kept[2], 5, 80)
    assert kept[3] == sorted([(i, t) for (i, t), n in zip(kept[2], near) if n[3]], key=key)
    assert len(kept[3]) < len(kept[2]) < len(kept[1])
    # packing: the ids of what is left, once each
    tokenizer = load(public_tokenizers.path("word_bpe_49k.json"))
    ids: dict = {}
    for r in sorted(packed, key=lambda r: (r.doc_id is not None, r.doc_id, r.start)):
        ids[r.doc_id] = ids.get(r.doc_id, []) + r.input_ids
    assert ids == {i: tokenizer.encode(t, add_special_tokens=False).ids + [1] for i, t in kept[3]}


def test_run_gives_what_the_stages_give(spark, folder):
    found = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in found.select("doc_id").distinct().collect()} >= {0, 1, 2, 59, None}


def test_models_never_see_held_out_rows(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert docs.where(language_id.held_out()).count() + docs.where(~language_id.held_out()).count() == docs.where("doc_id is not null").count()
    assert toxicity.CHAIN == 64


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
