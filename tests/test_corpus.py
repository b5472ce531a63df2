import math
import random

import pytest
from pyspark.sql import functions as F

from polyspark.operators import corpus as C
from polyspark.sources.corpus import read_corpus, read_lang_list
from polyspark.sources.sinks import (
    flatten_struct,
    lang_of_path,
    materialize,
    publish_run,
    published_runs,
    read_run,
    run_key,
    stage_key,
    write_results,
)
from polyspark.sources.tasks import eval_docs, fewshot_docs, read_task


def naive_blocks(rows, size, batch):
    out = []
    for b in range(0, len(rows), batch):
        flat = [t for r in rows[b : b + batch] for t in r]
        end = len(flat) // size * size if len(flat) >= size else len(flat)
        out += [(b // batch, i // size, flat[i : i + size]) for i in range(0, end, size)]
    return out


@pytest.mark.parametrize("size,batch", [(5, 4), (7, 3), (1, 10), (1000, 6), (16, 1000)])
def test_packing_equals_plain_packing(spark, size, batch):
    rng = random.Random(size)
    rows = [[rng.randint(0, 99) for _ in range(rng.choice([0, 1, 3, 20, 60]))] for _ in range(23)]
    df = spark.createDataFrame([(i * 10, r, [1] * len(r)) for i, r in enumerate(rows)], "id bigint, input_ids array<int>, mask array<int>")
    got = C.pack_blocks(df, "id", size, ("input_ids", "mask"), rows_per_batch=batch).collect()
    assert sorted((r["batch"], r["block"], r["input_ids"]) for r in got) == naive_blocks(rows, size, batch)
    assert all(r["labels"] == r["input_ids"] and len(r["mask"]) == len(r["labels"]) for r in got)


def test_packing_by_group(spark):
    df = spark.range(40).select("id", (F.col("id") % 2).alias("g"), F.array(F.col("id").cast("int")).alias("input_ids"))
    got = C.pack_blocks(df, "id", 5, by=["g"], rows_per_batch=10).collect()
    assert len(got) == 8 and all(len({i % 2 for i in r["input_ids"]}) == 1 for r in got)


def test_block_size():
    assert [C.block_size_for(None, 4096), C.block_size_for(None, 512), C.block_size_for(4096, 2048), C.block_size_for(64, 2048)] == [1024, 512, 2048, 64]


def test_holdout_and_caps(spark):
    split = C.holdout_split(spark.range(4000), "id", 10, 3)
    held = split.where("split = 'validation'").count()
    assert 300 < held < 500 and split.count() == 4000
    capped = C.limit_samples(split, "id", {"train": 7, "validation": None}, 3)
    assert {r["split"]: r["count"] for r in capped.groupBy("split").count().collect()} == {"train": 7, "validation": held}


def test_perplexity_overflows_to_infinity(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "loss double")
    assert df.agg(C.corpus_perplexity(F.col("loss"))).first()[0] == pytest.approx(math.exp(2))
    assert df.agg(C.corpus_perplexity(F.col("loss") * 1000)).first()[0] == math.inf


def test_formats(spark, tmp_path):
    base = spark.createDataFrame([(1, "a, b\n\"c\""), (2, "d")], "n int, text string")
    base.write.json(str(tmp_path / "in.json"))
    base.write.option("header", True).option("escape", '"').csv(str(tmp_path / "in.csv"))
    base.write.parquet(str(tmp_path / "in.parquet"))
    for fmt in ("json", "csv", "parquet"):
        got = read_corpus(spark, str(tmp_path / f"in.{fmt}"))
        assert got.columns == ["text"] and {r[0] for r in got.collect()} == {"a, b\n\"c\"", "d"}
    # no column of that name: the first one
    assert {str(r[0]) for r in read_corpus(spark, str(tmp_path / "in.parquet"), text_col="body").collect()} == {"1", "2"}
    (tmp_path / "eng_Latn").mkdir()
    (tmp_path / "eng_Latn" / "part.txt").write_text("one\ntwo\n")
    got = read_corpus(spark, str(tmp_path / "eng_Latn" / "part.txt"), lang_pattern="([a-z]{3}_[A-Z][a-z]{3})/")
    assert {tuple(r) for r in got.select("lang", "text").collect()} == {("eng_Latn", "one\n"), ("eng_Latn", "two\n")}
    bare = read_corpus(spark, str(tmp_path / "eng_Latn" / "part.txt"), keep_linebreaks=False)
    assert {r[0] for r in bare.collect()} == {"one", "two"}
    with pytest.raises(ValueError):
        read_corpus(spark, "x.docx")


def test_language_list(spark, tmp_path):
    (tmp_path / "langs.txt").write_text("eng_Latn\t1\nbak_Cyrl\t0\n")
    rows = {tuple(r) for r in read_lang_list(spark, str(tmp_path / "langs.txt")).collect()}
    assert rows == {("eng_Latn", 1, "eng", "Latn"), ("bak_Cyrl", 0, "bak", "Cyrl")}


def test_task_splits(spark, tmp_path):
    rows = [("en", "train", 1), ("en", "test", 2), ("en", "validation", 3), ("de", "validation", 4), ("fr", "test", 5)]
    spark.createDataFrame(rows, "lang string, split string, id int").write.partitionBy("lang", "split").parquet(str(tmp_path / "task"))
    df = read_task(spark, str(tmp_path / "task"))
    assert {r["id"] for r in eval_docs(df, ["lang"]).collect()} == {2, 4, 5}
    assert {r["id"] for r in fewshot_docs(df, ["lang"]).collect()} == {1, 4, 5}


def test_saved_stage_is_reused(spark, tmp_path):
    path = str(tmp_path / stage_key("org/model", "data", 100, 64))
    assert path.endswith("org-model_blocks_64_data_100vocab")
    assert materialize(spark.range(3), path).count() == 3
    assert materialize(spark.range(5), path).count() == 3
    assert materialize(spark.range(5), path, overwrite=True).count() == 5
    # an interrupted write has no marker and is written anew
    import os

    os.rename(f"{path}/_SUCCESS", f"{path}/_stopped")
    assert materialize(spark.range(7), path).count() == 7


def test_run_key_and_flatten(spark):
    df = spark.createDataFrame([("a/b", None, 3)], "m string, t string, k int")
    key = run_key({"model": F.col("m"), "task": F.col("t"), "lang": lang_of_path(F.lit("x/y/deu_Latn"))}, F.col("k"))
    assert df.select(key).first()[0] == "limited=3.model=a-b.lang=deu_Latn"
    nested = df.select(F.struct("m", F.struct("k").alias("in")).alias("out"), "t")
    assert flatten_struct(nested).columns == ["out_m", "out_in_k", "t"]


def test_a_run_is_seen_once_its_manifest_is_there(spark, tmp_path):
    out = str(tmp_path)
    assert published_runs(spark, out).count() == 0
    results = spark.createDataFrame(
        [("t", "de", "acc", 0.5, "{{x}}"), ("t", None, "acc", float("nan"), None)],
        "task string, lang string, metric string, value double, prompt_jinja string",
    )
    examples = spark.createDataFrame([("t", "de", 1), ("t", "de", 2), ("t", None, 3)], "task string, lang string, doc_id int")
    write_results(results, examples, f"{out}/a")  # cut off before its manifest
    assert published_runs(spark, out).count() == 0
    with pytest.raises(FileNotFoundError):
        read_run(spark, out, "a")
    publish_run(results.limit(1), examples, out, "a", {"model": "m", "limit": None, "shots": [0, 3]}, {"t": 2})
    run = published_runs(spark, out).first()
    assert (run["run"], run["result_rows"], run["example_rows"]) == ("a", 1, 3)
    assert run["config"] == {"model": "m", "limit": "null", "shots": "[0, 3]"} and run["versions"] == {"t": "2"}
    with pytest.raises(FileExistsError):
        publish_run(results, examples, out, "a", {}, {})
    publish_run(results, examples.limit(0), out, "b", {}, {})
    back = {r["lang"]: r for r in read_run(spark, out, "b").collect()}
    assert back["de"]["value"] == 0.5 and back["de"]["prompt_jinja"] == "{{x}}" and back[None]["value"] != back[None]["value"]
    assert read_run(spark, out, "b", "slim").columns == ["task", "lang", "metric", "value"]
    assert read_run(spark, out, "a", "examples").dtypes == examples.dtypes
    assert read_run(spark, out, "b", "examples").count() == 0
