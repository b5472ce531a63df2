"""Row-by-row operators run on a streaming DataFrame."""

from pyspark.sql import functions as F

from polyspark.operators import prompts as P
from polyspark.operators import scoring as S
from polyspark.queries.common import LANGID


def test_requests_of_a_stream(spark, tmp_path):
    folder = "/root/testdata/sf0.001"
    batch = spark.read.parquet(f"{folder}/documents.parquet")
    stream = spark.readStream.schema(batch.schema).option("pathGlobFilter", "documents.parquet").parquet(folder)

    def scored(df):
        docs = df.select(F.lit("langid").alias("task"), "doc_id", "lang", "text")
        return S.score_dummy(P.choice_requests(P.fewshot_context(P.render(docs, [LANGID]), None, 0))).select("doc_id", "req_idx", "ll")

    query = (
        scored(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start()
    )
    assert query.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, scored(batch).collect()))
