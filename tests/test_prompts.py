import pytest
from pyspark.sql import functions as F

from polyspark.functions import expressions as X
from polyspark.functions.hashing import content_key
from polyspark.functions.text import strip, truncate
from polyspark.operators import prompts as P
from polyspark.sources.templates import BUILT_IN, NEWS_TOPIC, Template, select_templates, templates_table

T = Template(task="t", name="one", jinja="Say {{text}} is ||| {{label}}", answer_choices="a ||| b", metrics=("Accuracy",))


def test_separator_in_data_is_kept(spark):
    docs = spark.createDataFrame([("x ||| y", "a")], "text string, label string")
    row = P.render(docs, [T]).first()
    assert (row["text_prompt"], row["target"], row["choices"]) == ("Say x ||| y is", "a", ["a", "b"])


def test_template_needs_one_separator(spark):
    docs = spark.createDataFrame([("x", "a")], "text string, label string")
    for jinja in ("{{text}}", "{{text}} ||| a ||| b"):
        with pytest.raises(ValueError):
            P.render(docs, [Template(task="t", name="bad", jinja=jinja)])
    with pytest.raises(ValueError):
        P.render(docs, [Template(task="t", name="bad", jinja="{{nothing}} ||| b")])
    with pytest.raises(ValueError):
        P.render(docs.withColumn("answer_choices", F.lit(1)), [T])


def test_values_print_as_text(spark):
    docs = spark.createDataFrame([(True, 3, None)], "flag boolean, number int, nothing string")
    t = Template(task="t", name="v", jinja="{{flag}} {{number}} {{nothing}} ||| {{ flag | highlight }}")
    row = P.render(docs, [t]).first()
    assert row["text_prompt"] == "True 3 None"
    assert row["target"].startswith("<span") and row["choices"] is None


@pytest.mark.parametrize(
    "text", ["w " * 1024, "w " * 1026 + "w", "w " * 1027, "x" * 2053, "x" * 2054, "", "a" * 2000 + " " + "b" * 100, "ß " * 1100]
)
def test_truncation(spark, text):
    want = text if len(text) <= 2053 else text[:2045].rsplit(" ", 1)[0] + "..."
    assert spark.createDataFrame([(text,)], "t string").select(truncate(F.col("t"))).first()[0] == want


def test_strip_takes_unicode_space(spark):
    text = " \x1c　 a b  \n"
    assert spark.createDataFrame([(text,)], "t string").select(strip(F.col("t"))).first()[0] == text.strip()


def test_built_in_templates(spark):
    docs = spark.createDataFrame([("news_topic", "s", "travel")], "task string, sent string, label string")
    row = P.render(docs, [NEWS_TOPIC]).first()
    assert row["text_prompt"] == 'The topic of the news "s" is' and row["target"] == "travel" and len(row["choices"]) == 7
    assert templates_table(spark, BUILT_IN).count() == 2


def test_template_choice():
    many = [T, Template(task="t", name="b", jinja="a ||| b", original_task=True), Template(task="u", name="c", jinja="a ||| b")]
    assert [t.name for t in select_templates(many, "t")] == ["b", "one"]
    assert [t.name for t in select_templates(many, "t", "original_templates")] == ["b"]
    assert [t.name for t in select_templates(many, "t", "one,b,one")] == ["b", "one"]
    assert [t.name for t in select_templates(many, "t", "one,b", 0)] == ["one"]
    with pytest.raises(ValueError):
        select_templates(many, "u", "original_templates")
    with pytest.raises(KeyError):
        select_templates(many, "t", "zzz")


def pool_of(spark, texts):
    rows = [("t", "one", "en", i, x) for i, x in enumerate(texts)]
    df = spark.createDataFrame(rows, "task string, template string, lang string, doc_id bigint, text string")
    return df.withColumn("content", content_key(F.col("text")))


def test_fewshot_rows_differ_from_each_other_and_from_the_document(spark):
    texts = [f"t{i}" for i in range(30)] + ["copy"] * 15
    docs = pool_of(spark, texts)
    pool = docs.select(*P.BY, F.col("doc_id").alias("row_id"), "content", F.col("text").alias("example"))
    rows = P.fewshot_sample(pool, docs, 4, 1).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert len(by_doc) == len(texts)
    for doc_id, shots in by_doc.items():
        assert sorted(s["slot"] for s in shots) == [0, 1, 2, 3]
        assert len({s["row_id"] for s in shots}) == 4
        assert all(s["example"] != texts[doc_id] for s in shots)
    # every row of the pool is drawn by someone, copies included
    assert len({r["row_id"] for r in rows}) > 35
    again = P.fewshot_sample(pool, docs, 4, 1).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_fewshot_needs_enough_rows(spark):
    docs = pool_of(spark, ["a", "a", "a", "b"])
    pool = docs.select(*P.BY, F.col("doc_id").alias("row_id"), "content")
    assert P.fewshot_sample(pool, docs, 1, 1).count() == 4
    with pytest.raises(Exception, match="few-shot rows"):
        P.fewshot_sample(pool, docs, 2, 1).collect()


def test_context_layout(spark):
    docs = pool_of(spark, ["a", "b", "c"]).withColumn("text_prompt", F.concat(F.lit("Q"), "text"))
    pool = docs.select(*P.BY, F.col("doc_id").alias("row_id"), "content", P.format_example(F.col("text_prompt"), F.lit("y")).alias("example"))
    rows = P.fewshot_context(docs, P.fewshot_sample(pool, docs, 2, 3), 2, source="train").collect()
    for r in rows:
        *shots, last = r["ctx"].split("\n")
        assert last == r["text_prompt"] and sorted(shots) == sorted(f"Q{x} y" for x in "abc" if x != r["text"])
        assert len(r["fewshot_idx"]) == 2 and r["fewshot_source"] == "train"
    zero = P.fewshot_context(docs, None, 0).first()
    assert zero["ctx"] == zero["text_prompt"] and zero["fewshot_idx"] == [] and zero["fewshot_source"] is None
    with pytest.raises(ValueError):
        P.format_example(F.lit("a"), F.lit("b"), "###")


def test_requests(spark):
    docs = spark.createDataFrame([("x", "b")], "text string, label string")
    rows = P.choice_requests(P.fewshot_context(P.render(docs, [T]), None, 0)).orderBy("req_idx").collect()
    assert [(r["req_idx"], r["cont"]) for r in rows] == [(0, " a"), (1, " b")]
    with pytest.raises(ValueError):
        P.perplexity_requests(docs, k=1)
    args = P.generation_requests(docs.withColumn("ctx", F.lit("c")), ["\n"], None, 2).first()["args"]
    assert args["stop_sequences"] == ["\n"] and args["max_generation_length"] is None and args["num_fewshot"] == 2


def test_modes_in_order_of_appearance(spark):
    df = spark.createDataFrame([(1, ["b", "a", "b", "a", "c"]), (2, [])], "id int, items array<string>")
    assert df.where("id = 1").select(P.modes(F.col("items"))).first()[0] == ["b", "a"]
    assert df.where("id = 2").select(P.modes(F.col("items"))).first()[0] is None
    assert P.most_frequent(df, ["id"], "items").collect()[0]["modes"] == ["b", "a"]


def test_shuffle_limits_agree(spark):
    docs = spark.range(500).withColumn("g", (F.col("id") % 3 == 0).cast("string"))
    whole = P.shuffle_limit(docs, ["g"], "id", 9)
    assert whole.groupBy("g").agg(F.max("position") + 1 == F.count("*")).distinct().collect()[0][1] is True
    top = P.shuffle_limit(docs, ["g"], "id", 9, 10)
    assert sorted(map(tuple, top.collect())) == sorted(map(tuple, whole.where("position < 10").select(*top.columns).collect()))


def test_positions_follow_the_order(spark):
    docs = spark.range(3000).select((F.col("id") * 37 % 3000 * 5).alias("k"), (F.col("id") % 2).alias("g"))
    rows = P.assign_doc_ids(docs, ["g"], "k", "position").collect()
    for g in (0, 1):
        keys = [r["k"] for r in sorted((r for r in rows if r["g"] == g), key=lambda r: r["position"])]
        assert keys == sorted(keys) and len(keys) == 1500


def test_expressions_over_choices_and_members(spark):
    docs = spark.sql(
        "select 1 as doc_id, 2 as label, named_struct('a', array(1.5D, null)) as s, map('k', true) as m union all "
        "select 2, null, null, null union all select 3, -3, named_struct('a', array()), map()"
    )
    t = Template(
        task="t",
        name="e",
        jinja='{{answer_choices | join(" or ")}}: {{answer_choices[0]}} {{answer_choices | length}} ||| '
        '<{{answer_choices[label]}}|{{s.a | join(";")}}|{{s["a"][0]}}|{{m.k}}|{{answer_choices | last | upper}}>',
        answer_choices="x ||| y{{label}} ||| z",
    )
    text, target = P.prompt_columns(docs, t)
    got = docs.select("doc_id", text.alias("p"), target.alias("t")).orderBy("doc_id").collect()
    assert [r["p"] for r in got] == ["x or y2 or z: x 3", "x or yNone or z: x 3", "x or y-3 or z: x 3"]
    assert [r["t"] for r in got] == ["<z|1.5;None|1.5|True|Z>", "<||||Z>", "<x||||Z>"]


@pytest.mark.parametrize("place", ["answer_choices[s]", "nope", "label | nope", "label +", "label + 1", "s.nope", "label.a", "label[0]", "f(label)"])
def test_expressions_that_cannot_be_used(spark, place):
    docs = spark.sql("select 1 as label, named_struct('a', 1) as s")
    with pytest.raises(ValueError):
        P.prompt_columns(docs, Template(task="t", name="e", jinja="{{%s}} ||| a" % place, answer_choices="x ||| y"))


def test_choices_need_a_template_that_has_them(spark):
    with pytest.raises(ValueError):
        P.prompt_columns(spark.range(1), Template(task="t", name="e", jinja="{{answer_choices[0]}} ||| a"))


def test_doubles_print_as_in_python(spark):
    values = [0.0, -0.0, 1.0, -2.5, 1e7, 123456789.125, 1e15, 1.5e16, -1e16, 1e22, 1e100, 1.25e-4, 0.00099, -1e-4, 1e-5, -3.25e-7, 1e-300, 12345678.0, 1e-3]
    values += [float("inf"), float("-inf"), float("nan")]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(X.double_text(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in got] == [str(v) for v in values]


def test_most_frequent_shuffles_rows_and_not_items(spark):
    from pyspark.sql import functions as F

    rows = [(1, ["b", "a", "b", "a", "c"]), (None, ["x", None, None]), (2, []), (3, None), (4, ["y"]), (4, ["z", "z"])]
    df = spark.createDataFrame(rows, "id int, items array<string>")
    modes = P.most_frequent(df, ["id"], "items")
    assert {r["id"]: r["modes"] for r in modes.collect()} == {1: ["b", "a"], None: [None], 4: ["z"]}
    floats = df.where("id = 1").select("id", F.expr("array(0.5d, double('nan'), double('nan'))").alias("items"))
    assert str(P.most_frequent(floats, ["id"], "items").collect()[0]["modes"]) == "[nan]"
    plan = modes._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan and "LeftSemi" in plan  # a row alone with its keys, and rows that share them
