"""The registered queries and the pipeline, on the smallest test tables."""

from pathlib import Path

import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from headway.llm import bpe
from headway.llm.queries import registered
from headway.llm.query_sql import ORACLES

SF = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in SF.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(table):
    names = sorted(table.column_names)
    return names, sorted(map(repr, zip(*[table.column(n).to_pylist() for n in names])))


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = driver.queries()[name](spark, str(SF)).toArrow()
    want = duck.sql(driver.oracle_sql()[name]).to_arrow_table()
    assert canonical(got) == canonical(want)


def test_each_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in registered())
    assert numbers == list(range(1, 14))
    assert driver.queries().keys() > registered().keys() | {"pipeline"}


@pytest.mark.parametrize("name", sorted(registered().keys() - ORACLES.keys()))
def test_query_gives_every_row(spark, name):
    rows = driver.queries()[name](spark, str(SF))
    ids = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id")
    assert sorted(rows.select("doc_id").collect()) == sorted(ids.collect())


def test_pipeline_by_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(SF)).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append(docs)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    good = labels.where("quality = 1 AND toxic = 0").select("doc_id")
    raw = spark.read.parquet(f"{SF}/documents.parquet")
    clean = raw.join(good, "doc_id").count()
    assert seen[0].join(good, "doc_id").count() >= 0.95 * clean
    assert seen[1].count() == seen[1].select("doc_id").distinct().count()
    assert seen[2].count() == seen[1].count()
    assert seen[3].join(good, "doc_id").count() >= 0.95 * seen[2].join(good, "doc_id").count()
    assert seen[4].count() == seen[3].count()
    assert seen[4].where("NOT round_trip").count() == 0
    coder = tiktoken.Encoding(
        "own",
        pat_str=bpe.public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(),
        special_tokens={},
    )
    texts = seen[3].select("doc_id", "text").distinct()
    for row in seen[4].join(texts, "doc_id").limit(30).collect():
        assert row.token_ids == coder.encode_ordinary(row.text)


def test_pipeline_on_awkward_rows(spark, tmp_path):
    """Null fields, empty texts, repeated rows, and a table without labels."""
    rows = [
        (1, None, None, None, None),
        (1, None, None, None, None),
        (2, "", "en", "s", 0),
        (3, "the red house", None, "s", 13),
        (3, "the red house", None, "s", 13),
        (None, "no id here", "en", None, 10),
    ]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long"
    )
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {None, 1, 2, 3}
    docs.where(F.lit(False)).write.mode("overwrite").parquet(
        f"{tmp_path}/documents.parquet"
    )
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
