"""The pipeline against plain Python, and the queries against their SQL and the entry."""

import hashlib

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

import __spark_entry__ as contract
import corpus_pipeline
from sensorloom.llm import queries, quality
from sensorloom.llm.common import table
from tests.llm import test_decontaminate as D
from tests.llm import test_jaccard as J
from tests.llm import test_secrets as S

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage is given and gives."""
    docs, seen = table(spark, FOLDER, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER).cache()
        seen.append((name, {r["doc_id"]: r for r in docs.collect()}, {r["doc_id"]: r for r in out.collect()}))
        docs = out
    return seen


def test_stages_keep_the_columns(spark, stages):
    for _, _, after in stages[:-1]:
        assert list(next(iter(after.values())).asDict()) == COLUMNS
    assert len(stages) == 5


def test_quality_stage(spark, stages):
    _, before, after = stages[0]
    docs = table(spark, FOLDER, "documents")
    model = quality.fit(docs, table(spark, FOLDER, "labels"))
    kept = {r["doc_id"] for r in quality.score(docs, model).filter("predicted = 1").collect()}
    assert after.keys() == kept and 0 < len(after) < len(before)
    assert all(after[i] == before[i] for i in after)


def test_near_duplicate_stage(stages):
    _, before, after = stages[1]
    expected = J.brute([(i, r["text"]) for i, r in before.items()])
    assert after.keys() == {i for i, _, component in expected if i == component}
    assert len(after) < len(before) and all(after[i] == before[i] for i in after)


def test_benchmark_stage(spark, stages):
    _, before, after = stages[2]
    items = [tuple(r) for r in table(spark, FOLDER, "benchmark").select("item_id", "text").collect()]
    windows = set()
    for _, text in items:
        own = D.words(text)
        windows |= {tuple(own[i : i + 13]) for i in range(max(1, len(own) - 12)) if own}
    kept = set()
    for doc_id, row in before.items():
        own, hit = D.words(row["text"]), set()
        for at in range(len(own)):
            if tuple(own[at : at + 13]) in windows:
                hit.update(range(at, at + 13))
        if not hit or 20 * len(hit) < len(own):
            kept.add(doc_id)
    assert after.keys() == kept and len(kept) < len(before)


def test_secret_stage(stages):
    _, before, after = stages[3]
    assert before.keys() == after.keys()
    for doc_id, row in after.items():
        old = before[doc_id]
        if S.base_spans(old["text"]):
            assert not S.base_spans(row["text"]) and "[SECRET]" in row["text"]
            assert row["n_chars"] == len(row["text"])
        elif "[SECRET]" not in row["text"]:
            assert row == old


def test_secret_stage_replaces_secrets(spark):
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in S.TEXTS] + [(99, "clean", "en", "s", 77)],
        table(spark, FOLDER, "documents").schema,
    )
    for row in corpus_pipeline.secret_stage(spark, docs, FOLDER).collect():
        if row["doc_id"] == 99:
            assert (row["text"], row["n_chars"]) == ("clean", 77)
        else:
            assert S.base_spans(dict(S.TEXTS)[row["doc_id"]]) or row["doc_id"] == 5
            assert row["n_chars"] == len(row["text"]) and "[SECRET]" in row["text"]


def test_token_stage(stages):
    _, before, after = stages[4]
    model = SentencePieceProcessor(model_file=public_tokenizers.path(queries.PIECE_MODEL))
    assert before.keys() == after.keys()
    for doc_id, row in after.items():
        ids = model.encode(before[doc_id]["text"], add_eos=True)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, stages):
    rows = {r["doc_id"]: r for r in corpus_pipeline.run(spark, FOLDER).collect()}
    assert rows == stages[-1][2]


def test_awkward_rows_pass_all_stages(spark):
    docs = table(spark, FOLDER, "documents")
    odd = spark.createDataFrame(
        [(None, "text", None, None, None), (10**6, None, None, None, None), (10**6 + 1, "", "xx", "", 0)],
        docs.schema,
    )
    rows = docs.unionByName(odd).unionByName(odd).withColumn("secrets", F.lit("x")).withColumn("row", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, FOLDER)
        assert out.columns == rows.columns
        rows = out.cache()
    assert rows.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_rows_without_or_with_the_same_id(spark):
    """Stages drop rows, not ids."""
    item = table(spark, FOLDER, "benchmark").filter("length(text) > 200").first()["text"]
    clean, other = "a clean text of its own " * 9, "another text that stands by itself " * 9
    rows = [(None, item), (1, item), (1, item), (1, clean), (2, other), (None, other), (None, other), (2, clean)]
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t), "x") for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, Row_ID string",
    )

    def left(stage):
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns
        return sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=repr)

    assert left(corpus_pipeline.benchmark_stage) == sorted([r for r in rows if r[1] != item], key=repr)
    assert left(corpus_pipeline.near_duplicate_stage) == sorted([(1, item), (1, clean), (2, other)], key=repr)


def test_entry_has_all_queries():
    assert [f"op{n}_" for n in range(1, 11)] == [
        f"op{n}_" for n in range(1, 11) if any(k.startswith(f"op{n}_") for k in contract.queries())
    ]
    assert "pipeline" in contract.queries()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_their_sql(spark, name):
    connection = duckdb.connect()
    for each in ("documents", "conversations", "benchmark", "labels", "embeddings"):
        connection.execute(f"CREATE VIEW {each} AS SELECT * FROM '{FOLDER}/{each}.parquet'")
    result = contract.queries()[name](spark, FOLDER)
    expected = connection.execute(contract.oracle_sql()[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in result.collect())
    assert got == sorted(map(repr, expected.fetchall()))
