"""The pipeline's stages by hand on a small table, and the registry."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from llm_reading import rows_of

import __spark_entry__ as driver
import corpus_pipeline
from compare import connect, oracle_rows, spark_rows
from pacefold.llm import near_dedup

ORACLE_SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", ["op1_decontamination", "op4_chat", "op8_mixing"])
def test_matches_sql(spark, name):
    columns, rows = spark_rows(driver.queries()[name](spark, ORACLE_SF))
    expected_columns, expected = oracle_rows(connect(ORACLE_SF), driver.oracle_sql()[name])
    assert columns == expected_columns and rows == expected


@pytest.fixture
def corpus(spark, docs, tmp_path):
    """A table of planted cases among plain documents, and what each stage must do."""
    pick = random.Random(21)
    vocabulary = [f"word{i}" for i in range(3000)]
    text = lambda n: " ".join(pick.choice(vocabulary) for _ in range(n))
    item, shared = text(30), text(60)
    rows = [(i, text(80), "en", f"src{i % 4}") for i in range(60)]
    rows += [(100, None, None, None), (101, "", "en", "src1"), (102, "12 !! 34", "en", "src1")]
    rows += [(110, rows[5][1], "en", "src2"), (111, rows[5][1] + " more", "en", "src2")]
    rows += [(120 + i, f"{text(40)} {shared} {text(40)}", "en", "src3") for i in range(5)]
    rows += [(130, f"{text(50)} {item.upper()} {text(50)}", "en", "src0")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet"
    )
    return str(tmp_path), {r[0]: r for r in rows}, shared


def test_every_stage(spark, corpus, tmp_path):
    sf_dir, rows, shared = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids, texts = [], []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        stage(spark, docs, sf_dir).write.parquet(f"{tmp_path}/stage{number}")
        after = spark.read.parquet(f"{tmp_path}/stage{number}")
        assert after.schema.fieldNames() == docs.schema.fieldNames()
        docs = after
        found = {r.doc_id: r for r in docs.collect()}
        ids.append(set(found))
        texts.append({i: r.text for i, r in found.items()})
        assert all(r.n_chars == len(r.text) for r in found.values())
    assert ids[0] == set(rows) - {100, 101, 102}
    assert ids[1] == ids[0] - {110, 111}
    assert ids[2] == ids[1]
    assert texts[2][120] == rows[120][1]
    for i in range(121, 125):
        assert shared not in texts[2][i] and len(texts[2][i]) <= len(rows[i][1]) - len(shared)
    assert all(texts[2][i] == rows[i][1] for i in range(60))
    assert ids[3] == ids[2] - {130}
    final = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert {r.doc_id for r in final} <= ids[3]
    assert sorted(rows_of(corpus_pipeline.run(spark, sf_dir))) == sorted(map(tuple, final))


def test_empty_table(spark, docs, tmp_path):
    docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert rows_of(corpus_pipeline.run(spark, str(tmp_path))) == []


def test_near_copies_from_a_similarity_of_80_go(spark, docs):
    words = [f"word{i}" for i in range(200)]
    copies = {0: words}
    for i, changed in enumerate((1, 4, 5, 6, 14)):  # each changed word is in five shingles
        copies[i + 1] = [f"new{i}" if k % 14 == 5 and k < 14 * changed else w for k, w in enumerate(words)]

    def alike(one, other):
        a, b = ({tuple(c[k : k + 5]) for k in range(196)} for c in (copies[one], copies[other]))
        return len(a & b) / len(a | b)

    pairs = [i for i in copies if i and 0.8 <= alike(0, i) < 0.85]
    apart = [i for i in copies if i and alike(0, i) < 0.8]
    assert pairs and apart
    stage = corpus_pipeline.drop_near_duplicates
    for other in (*pairs, *apart):
        frame = docs([(i, " ".join(copies[i])) for i in (0, other)])
        assert stage(spark, frame, "").count() == (1 if other in pairs else 2)
        assert sum(r[3] for r in rows_of(near_dedup.op5(frame))) == 2


CLASHING = [
    "_lettered", "lang_pred", "score", "held_out", "kept_text", "n_bytes", "n_removed", "found", "row", "copy",
    "key", "slot", "differ", "kept", "component_id", "todo", "part", "size", "a b", "x.y",
]


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_clashing_columns_and_rows(spark, docs, tmp_path, stage):
    """Names of the operators' own columns, ids that repeat or are missing, a long text."""
    pick = random.Random(3)
    text = lambda n: " ".join(pick.choice("abcdefghij") * 3 + str(pick.randrange(900)) for _ in range(n))
    rows = [(i, text(40)) for i in range(8)] + [(9, text(30_000)), (10, text(25)), (10, text(26)), (None, text(20)), (None, text(21))]
    frame = docs(rows).repartition(3)
    for name in CLASHING:
        frame = frame.selectExpr("*", f"concat('{name}', coalesce(cast(doc_id AS string), 'none')) AS `{name}`")
    spark.createDataFrame([(1, text(30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.STAGES[stage][1](spark, frame, str(tmp_path))
    assert out.schema.fieldNames() == frame.schema.fieldNames()
    assert sorted(rows_of(out), key=str) == sorted(rows_of(frame), key=str)
    empty = corpus_pipeline.STAGES[stage][1](spark, frame.limit(0), str(tmp_path))
    assert rows_of(empty) == []


def test_near_duplicates_of_texts_under_one_id(spark, docs):
    pick = random.Random(4)
    text = lambda n: " ".join(str(pick.randrange(10**6)) for _ in range(n))
    first, second = text(60), text(70)
    rows = [(1, first), (1, second), (1, second), (2, second + " more"), (3, text(50)), (4, first)]
    out = rows_of(corpus_pipeline.drop_near_duplicates(spark, docs(rows), "").select("doc_id", "text"))
    assert len(out) == 3 and {t.removesuffix(" more") for _, t in out} == {first, second, rows[4][1]}


def test_a_run_leaves_no_texts_behind(spark, corpus):
    sf_dir, _, _ = corpus
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "pacefold"
    result = corpus_pipeline.run(spark, sf_dir)
    assert not list(shared.glob("pipeline-*/*"))
    assert result.count() > 50
