"""Evaluation of generation and choice templates together, and the bootstrap by partial sums."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from polyspark.functions.resample import STEPS, resampled_sums, weights
from polyspark.operators import aggregates as G
from polyspark.operators import corpus_metrics as CM
from polyspark.operators import scoring as S
from polyspark.operators.metric_tags import metric_rows
from polyspark.plans.evaluation import evaluate
from polyspark.sources.templates import Template

TOPIC = Template(task="topic", name="t", id="topic-t", jinja="{{sent}} is ||| {{label}}", answer_choices="x ||| y ||| z", metrics=("Accuracy", "BLEU"))
TELL = Template(task="tell", name="t", id="tell-t", jinja="Tell {{sent}} ||| {{label}}", metrics=("BLEU", "ROUGE", "SARI", "Accuracy"))


def docs(spark, n=40):
    rows = [("topic", "ab"[i % 2], ["train", "test"][i // 2 % 2], i, f"s{i}", "xyz"[i % 3]) for i in range(n)]
    rows += [("tell", "ab"[i % 2], ["train", "test"][i // 2 % 2], i, f"the cat number {i} sat on a mat", f"the cat {i} sat there on a mat") for i in range(n)]
    return spark.createDataFrame(rows, "task string, lang string, split string, doc_id bigint, sent string, label string")


def model(requests):
    """Right choices; generations that repeat the last word of the prompt after a true start, then a stop."""
    if "choice" in requests.columns:
        return requests.withColumn("ll", F.when(F.col("choice") == F.col("target"), -1.0).otherwise(-9.0))
    return requests.withColumn("generated", F.concat(F.lit(" the cat sat on a "), F.element_at(F.split("ctx", " "), -1), F.lit(" STOP more")))


def by_hash(requests):
    """Answers from the request alone."""
    start = F.element_at(F.split("ctx", " "), -1)
    cont = F.col("cont") if "cont" in requests.columns else F.lit("")
    return requests.withColumns({
        "ll": F.when(F.col("req_type") != S.GENERATION, -F.length(F.concat("ctx", cont)).cast("double")),
        "is_greedy": F.lit(None).cast("boolean"),
        "generated": F.when(F.col("req_type") == S.GENERATION, F.concat(F.lit("the cat "), start)),
    })


def test_choice_and_generation_templates_together(spark, tmp_path):
    table = docs(spark)
    out = evaluate(table, [TOPIC, TELL], model, k=1, source="sent", stops=["STOP"], scores_path=str(tmp_path / "s"))
    results = {(r["task"], r["lang"], r["metric"]): r for r in out["results"].collect()}
    figures = {"bleu", "sari", *G.ROUGE_FIGURES}
    assert {m for t, _, m in results if t == "tell"} == figures and {m for t, _, m in results if t == "topic"} == {"acc", "acc_norm"}
    assert all(r["n"] == 10 for r in results.values())
    assert all((r["stderr"] is None) == (r["metric"] == "bleu") for r in results.values())
    assert results["topic", "a", "acc"]["value"] == 1.0 and 0 < results["tell", "a", "bleu"]["value"] < 100
    assert results["tell", "a", "bleu"]["prompt_id"] == "tell-t"
    examples = out["examples"].collect()
    assert len(examples) == 40 and {r["split"] if "split" in r else None for r in examples} == {None}
    assert all("STOP" not in r["pred"] and r["pred"] == r["pred"].strip() for r in examples)
    pairs = spark.createDataFrame([(r["doc_id"], r["pred"], [r["target"]]) for r in examples if r["task"] == "tell" and r["lang"] == "a"], "doc_id long, prediction string, references array<string>")
    alone = CM.bleu(CM.bleu_stats(pairs.withColumn("one", F.lit(1)), ["one", "doc_id"]), ["one"]).first()["bleu"]
    assert results["tell", "a", "bleu"]["value"] == pytest.approx(alone)


def test_equal_requests_are_scored_once_and_cached(spark, tmp_path):
    table = docs(spark).unionByName(docs(spark).withColumn("doc_id", F.col("doc_id") + 1000))
    value = lambda out: sorted((r["task"], r["lang"], r["metric"], r["value"], r["n"]) for r in out["results"].collect())
    plain = value(evaluate(table, [TOPIC, TELL], by_hash, k=0, source="sent"))
    assert value(evaluate(table, [TOPIC, TELL], by_hash, k=0, source="sent", once=True)) == plain
    cache = str(tmp_path / "cache")
    assert value(evaluate(table, [TOPIC, TELL], by_hash, k=0, source="sent", cache_path=cache)) == plain
    fail = lambda requests: by_hash(requests).withColumn("ll", F.raise_error(F.col("ctx")).cast("double"))
    assert value(evaluate(table, [TOPIC, TELL], fail, k=0, source="sent", cache_path=cache)) == plain


def test_invalid_documents_do_not_count(spark):
    out = evaluate(docs(spark), [TOPIC], model, k=0, valid=F.col("label") != "x")
    kept = {r["doc_id"] for r in out["examples"].collect()}
    assert kept == {i for i in range(40) if i // 2 % 2 and i % 3}
    limited = evaluate(docs(spark), [TOPIC], model, k=0, valid=F.col("label") != "x", limit=3)["examples"]
    assert limited.count() == 6


def test_tags_without_rows(spark):
    table = docs(spark)
    with pytest.raises(ValueError, match="raw text"):
        evaluate(table, [TELL], model, k=0)
    only = Template(task="tell", name="t", jinja=TELL.jinja, metrics=("Accuracy", "Other"))
    with pytest.raises(ValueError, match="no template"):
        evaluate(table, [only], model, k=0)
    assert metric_rows(table, ["doc_id"], ["Other"], choice=False) is None


def test_bleu_without_sums_is_an_error(spark):
    with pytest.raises(Exception, match="bleu needs its sums"):
        G.aggregate_results(spark.createDataFrame([("a", "bleu", 1.0)], "g string, metric string, value double"), ["g"]).collect()


def test_perplexity_gets_a_bootstrap_error(spark):
    rows = [("a", "ppl", i, -0.1 * (i % 7)) for i in range(200)]
    long = spark.createDataFrame(rows, "g string, metric string, doc_id long, value double")
    got = G.aggregate_results(long, ["g"], {"ppl": "perplexity"}, rounds=500).first()
    values = np.exp(-np.array([r[3] for r in rows]).mean()) * np.std([r[3] for r in rows]) / np.sqrt(200)  # first-order error
    assert got["stderr"] == pytest.approx(values, rel=0.15) and got["n"] == 200


# bootstrap


def test_weights_follow_poisson():
    w = weights(np.arange(1, 2001, dtype=np.uint64) * np.uint64(7919), 0, 500)
    share = np.bincount(w.reshape(-1), minlength=6)[:6] / w.size
    assert np.allclose(share, [0.3679, 0.3679, 0.1839, 0.0613, 0.0153, 0.0031], atol=0.002)
    assert abs(np.corrcoef(w[0], w[1])[0, 1]) < 0.07 and abs(np.corrcoef(w[:, 0], w[:, 1])[0, 1]) < 0.15
    assert int(STEPS[-1]) <= 2**53


def test_sums_of_all_rounds_without_rows_times_rounds(spark):
    df = spark.range(3000).select("id", (F.col("id") % 3).alias("g"), F.when(F.col("id") % 5 > 0, F.col("id").cast("double")).alias("v")).repartition(4)
    out = resampled_sums(df, ["g"], {"v": F.col("v"), "one": F.lit(1)}, "id", 1000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "Join" not in plan
    partial = out._jdf.queryExecution().optimizedPlan().children().head()
    assert partial.getClass().getSimpleName() == "MapInArrow"
    rows = out.toPandas()
    assert len(rows) == 3 * 1000 and rows["one"].mean() == pytest.approx(1000, rel=0.01)
    again = resampled_sums(df.repartition(7), ["g"], {"v": F.col("v"), "one": F.lit(1)}, "id", 1000).toPandas()
    assert np.allclose(rows.sort_values(["g", "round"])["v"], again.sort_values(["g", "round"])["v"])


def test_a_hundred_thousand_rounds(spark):
    df = spark.range(2000).select("id", F.lit("g").alias("g"), (F.col("id") % 2).cast("int").alias("gold"), (F.col("id") % 3 % 2).cast("int").alias("pred"))
    began = time.time()
    got = G.stderr_for("f1_score", df, ["g"], "id", {"gold": "gold", "pred": "pred"}).first()["stderr"]
    few = G.stderr_for("f1_score", df, ["g"], "id", {"gold": "gold", "pred": "pred"}, 400, method="index").first()["stderr"]
    assert time.time() - began < 90 and got == pytest.approx(few, rel=0.15)


def test_tiny_and_null_groups(spark):
    df = spark.createDataFrame([(1, None, 1.0), (2, None, 3.0), (3, "a", 2.0), (4, "b", None)], "id long, g string, v double")
    got = {r["g"]: r["stderr"] for r in G.bootstrap_stderr(df, ["g"], G.mean_of("v"), "id", 200).collect()}
    assert set(got) == {None, "a", "b"} and got["a"] == 0.0 and got[None] > 0
