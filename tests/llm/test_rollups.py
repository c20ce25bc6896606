import public_tokenizers
import pytest

from sensorloom.llm import rollups as R
from sensorloom.llm.common import shared_folder
from tests.llm.helpers import awkward, documents

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def counted(docs):
    return R.token_counts(docs, PATH, public_tokenizers.PATTERN, "v1")


def totals(rollup):
    return {
        (r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in rollup.totals().collect() if r["n_docs"]
    }


def recounted(counts):
    out = {}
    for r in counts:
        docs, tokens = out.get((r["source"], r["lang"]), (0, 0))
        out[r["source"], r["lang"]] = (docs + 1, tokens + r["n_tokens"])
    return out


@pytest.fixture
def rollup(spark):
    return R.Rollup(spark, shared_folder(spark, "rollup"))


def test_counts_match_the_tokenizer(spark):
    own = R.encoder(PATH, public_tokenizers.PATTERN)
    texts = awkward()
    rows = counted(documents(spark, texts)).collect()
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in rows) == sorted(
        (str(i), len(own.encode_ordinary(t or ""))) for i, t in texts
    )


def test_totals_follow_the_documents(spark, rollup):
    docs = documents(spark, awkward()).selectExpr(
        "doc_id", "text", "nullif(lang, 'en') AS lang", "IF(doc_id > 20, 'a', 'b') AS source"
    )
    counts = counted(docs).cache()
    assert rollup.totals().count() == 0
    assert rollup.commit(1, R.inserts(counts))
    assert totals(rollup) == recounted(counts.collect())
    gone = R.copies(counts)
    assert rollup.commit(2, R.deletes(gone))
    left = counts.collect()
    for row in gone.select(counts.columns).collect():
        left.remove(row)
    assert len(left) < counts.count()
    assert totals(rollup) == recounted(left)
    # The same batches again change nothing, whatever they hold.
    assert not rollup.commit(1, R.inserts(counts)) and not rollup.commit(2, R.inserts(counts))
    assert totals(rollup) == recounted(left)


def test_revision_moves_between_keys(spark, rollup):
    types = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint"
    old = spark.createDataFrame([(1, "a", "en", "v1", 10), (2, "a", "en", "v1", 5)], types)
    new = spark.createDataFrame([(1, "a", "de", "v1", 12), (3, "a", "de", "v1", 99)], types)
    rollup.commit(1, R.inserts(old))
    rollup.commit(2, R.revisions(old, new))
    assert totals(rollup) == {("a", "en"): (1, 5), ("a", "de"): (1, 12)}


def test_revision_of_repeated_and_null_ids(spark, rollup):
    types = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint"
    old = [(1, "a", "en", "v1", 10)] * 3 + [(None, "a", "en", "v1", 7), (2, "a", "en", "v1", 5)]
    new = [(1, "a", "en", "v1", 12)] * 3 + [(None, "a", "en", "v1", 8)]
    old, new = (spark.createDataFrame(rows, types) for rows in (old, new))
    rollup.commit(1, R.inserts(old))
    assert R.revisions(old, new).count() == 8
    rollup.commit(2, R.revisions(old, new))
    assert totals(rollup) == {("a", "en"): (5, 3 * 12 + 8 + 5)}


def test_query_with_repeated_and_null_ids(spark, tmp_path):
    """Exact copies go whatever their ids, and what is left is counted with white space squeezed."""
    from sensorloom.llm import queries

    rows = [(1, "a  b c", "x"), (1, "a  b c", "x"), (1, "other text", "x"), (1, "more   text", "y")]
    rows += [(None, "a  b c", "y"), (None, "only  here", "y"), (None, "only  here", "y"), (None, "plain", "x")]
    docs = spark.createDataFrame([(i, t, s, "en") for i, t, s in rows], "doc_id bigint, text string, source string, lang string")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    own = R.encoder(PATH, public_tokenizers.PATTERN)

    def tokens(*texts):
        return len(texts), sum(len(own.encode_ordinary(text)) for text in texts)

    got = {r["source"]: (r["n_docs"], r["n_tokens"]) for r in queries.op5_token_rollup(spark, str(tmp_path)).collect()}
    assert got == {"x": tokens("a b c", "other text", "plain"), "y": tokens("more text", "only here")}


def test_broken_attempt_is_replaced(spark, rollup):
    types = "doc_id bigint, source string, lang string, tokenizer string, n_tokens bigint"
    rows = spark.createDataFrame([(1, "a", "en", "v1", 10)], types)
    R.inserts(rows).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false"
    ).parquet(f"{rollup.folder}/batch=1")
    assert not rollup.committed(1) and rollup.totals().count() == 0
    assert rollup.commit(1, R.inserts(rows))
    assert totals(rollup) == {("a", "en"): (1, 10)}


def test_empty_batch(spark, rollup):
    assert rollup.commit(1, R.inserts(counted(documents(spark, []))))
    assert rollup.totals().count() == 0


def test_query_matches_a_recount(spark):
    """The totals after all batches are those of the documents that are left."""
    import re

    from sensorloom.llm import queries
    from sensorloom.llm.common import table

    folder = "/root/testdata/sf0.001"
    own = R.encoder(PATH, public_tokenizers.PATTERN)
    first, expected = {}, {}
    for row in table(spark, folder, "documents").orderBy("doc_id").collect():
        text = row["text"] or ""
        if first.setdefault(text, row["doc_id"]) != row["doc_id"]:
            continue
        text = re.sub(r"[ \t\r\n]+", " ", text).strip(" ")
        docs, tokens = expected.get((row["source"], row["lang"]), (0, 0))
        expected[row["source"], row["lang"]] = (docs + 1, tokens + len(own.encode_ordinary(text)))
    rows = queries.op5_token_rollup(spark, folder).collect()
    got = {(r["source"], r["lang"]): (r["n_docs"], r["n_tokens"]) for r in rows}
    assert {k: v for k, v in got.items() if v[0]} == expected
    assert all(r["n_docs"] == r["n_inserted"] - r["n_deleted"] for r in rows)


def test_normalisation_keeps_columns_of_any_name(spark):
    given = spark.createDataFrame([(1, "a  b", "x"), (2, "a b", "y"), (3, None, "z")], "doc_id bigint, text string, new string")
    assert [tuple(r) for r in R.squeezed(given).collect()] == [(1, "a b", "x")]
