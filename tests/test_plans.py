import pytest
from pyspark.sql import functions as F

from polyspark.functions.joins import null_safe_join, skew_safe_join
from polyspark.functions.ranks import position_by, running_total
from polyspark.operators import reports as R
from polyspark.operators.vocab import learn_vocabulary
from polyspark.plans.evaluation import evaluate, perplexity
from polyspark.plans.pretraining import prepare_corpus
from polyspark.plans.vocabulary import extend_from_corpus
from polyspark.sources.templates import Template
from polyspark.session import saved

TOPIC = Template(task="topic", name="t", jinja="{{sent}} is ||| {{label}}", answer_choices="x ||| y ||| z", metrics=("Accuracy",))


def topic_docs(spark, n=60):
    rows = [("topic", "ab"[i % 2], ["train", "train", "validation", "test"][i % 4], i, f"s{i}", "xyz"[i % 3]) for i in range(n)]
    return spark.createDataFrame(rows, "task string, lang string, split string, doc_id bigint, sent string, label string")


def test_evaluation_from_splits_to_results(spark, tmp_path):
    docs = topic_docs(spark)
    oracle = lambda requests: requests.withColumn("ll", F.when(F.col("choice") == F.col("target"), -1.0).otherwise(-9.0))
    out = evaluate(docs, [TOPIC], oracle, k=2, scores_path=str(tmp_path / "scores"))
    results = out["results"].collect()
    assert {(r["lang"], r["metric"]): (r["value"], r["stderr"], r["n"]) for r in results} == {
        (l, m): (1.0, 0.0, 15) for l in "ab" for m in ("acc", "acc_norm")
    }
    # language a has no test split (ids 0, 2 mod 4 are train and validation)
    assert {r["doc_id"] % 4 for r in out["examples"].where("lang = 'a'").collect()} == {2}
    assert {r["doc_id"] % 4 for r in out["examples"].where("lang = 'b'").collect()} == {3}
    limited = evaluate(docs, [TOPIC], k=0, limit=4)["examples"]
    assert limited.count() == 8


def test_perplexity_report(spark):
    df = spark.createDataFrame([("en", "a b", -2.0), ("en", "c", -1.0)], "lang string, text string, ll double")
    got = {r["metric"]: (r["value"], r["higher_is_better"]) for r in perplexity(df, ["lang"]).collect()}
    import math

    assert got["word_perplexity"] == (pytest.approx(math.e), False)
    assert got["bits_per_byte"][0] == pytest.approx(3 / 4 / math.log(2))


def test_corpus_to_blocks(spark, tmp_path):
    docs = spark.createDataFrame([(i, "ab ac ab " * (i + 1)) for i in range(12)], "doc_id bigint, text string")
    vocab = saved(learn_vocabulary(docs, 9))
    out = prepare_corpus(docs, vocab, str(tmp_path), "m", "d", 16, 2048)
    tokens = out["tokens"].agg(F.sum(F.size("input_ids"))).first()[0]
    blocks = out["blocks"].collect()
    assert len(blocks) == tokens // 16 and all(len(b["input_ids"]) == 16 for b in blocks)
    again = prepare_corpus(docs.limit(0), vocab, str(tmp_path), "m", "d", 16, 2048)
    assert again["blocks"].count() == len(blocks)


def test_vocabulary_extension(spark):
    docs = spark.createDataFrame([("x", "ab ab ac"), ("y", "qr qr")], "lang string, text string")
    old = saved(learn_vocabulary(docs.where("lang = 'x'"), 9))
    out = extend_from_corpus(docs, old, 13, ["lang"])
    report = out["report"].first()
    assert report["final_size"] == report["old_size"] + report["added"] and report["new_size"] == 13
    assert out["merged"].join(old, ["id", "piece", "score", "type"]).count() == 9
    rows = {(r["vocabulary"], r["lang"]): r["tokens"] for r in out["comparison"].collect()}
    assert rows["merged", "y"] <= rows["old", "y"]


def test_join_of_a_hot_key(spark):
    facts = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"))
    dim = facts.groupBy("k").agg(F.count("*").alias("n")).withColumn("v", F.col("k") * 2)
    for how in ("inner", "left"):
        got = skew_safe_join(facts, dim.where("k <> 6"), ["k"], "n", [F.col("id")], how, partitions=8)
        assert got.count() == (4999 if how == "inner" else 5000)
        assert got.where("v <> k * 2").count() == 0 and got.where("k = 0").count() == 3334


def test_null_keys_meet(spark):
    a = spark.createDataFrame([(None, 1), ("x", 2)], "k string, a int")
    b = spark.createDataFrame([(None, 3), ("x", 4)], "k string, b int")
    assert {tuple(r) for r in null_safe_join(a, b, ["k"]).collect()} == {(None, 1, 3), ("x", 2, 4)}


def test_running_totals(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1000).alias("k"), (F.col("id") % 2).alias("g"), F.col("id").alias("v"))
    got = running_total(df.withColumn("b", F.floor(F.col("k") / 100)), ["g"], ["b"], [F.col("k")], F.col("v"), "before").collect()
    for g in (0, 1):
        total = 0
        for r in sorted((r for r in got if r["g"] == g), key=lambda r: r["k"]):
            assert r["before"] == total
            total += r["v"]
    assert position_by(df.limit(0), [], "k", "p").count() == 0
    assert position_by(df.limit(1), [], "k", "p").first()["p"] == 0


def test_five_digits(spark):
    values = [0.25, 1 / 3, 123456.0, 0.00001234, 0.0, 1.0, 99999.6, 12.0, 0.00012345678, -2.5]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(R._five_digits(F.col("v"))).collect()] == [f"{v:.5g}" for v in values]
