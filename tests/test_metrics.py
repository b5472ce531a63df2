import math
import random
import time
import tracemalloc
from collections import Counter

import pytest
from pyspark.sql import functions as F

from polyspark.functions.stem import stem
from polyspark.operators import aggregates as G
from polyspark.operators import corpus_metrics as CM
from polyspark.operators import doc_metrics as M


def test_stems():
    known = {
        "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
        "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
        "troubled": "troubl", "sized": "size", "hopping": "hop", "falling": "fall", "hissing": "hiss", "filing": "file",
        "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit", "valenci": "valenc",
        "digitizer": "digit", "operator": "oper", "feudalism": "feudal", "hopefulness": "hope", "formaliti": "formal",
        "triplicate": "triplic", "formative": "form", "electrical": "electr", "goodness": "good", "revival": "reviv",
        "allowance": "allow", "airliner": "airlin", "adoption": "adopt", "probate": "probat", "rate": "rate",
        "controll": "control", "roll": "roll", "dying": "die", "enjoy": "enjoy", "generalizations": "gener",
    }
    assert {w: stem(w) for w in known} == known


def pair_df(spark, rows):
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, reference string, prediction string")


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_rouge_l_against_a_plain_table(spark):
    rng = random.Random(1)
    text = lambda: " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 12)))
    rows = [(text(), text()) for _ in range(25)]
    got = {r["id"]: r["rougeL"] for r in M.rouge_l(pair_df(spark, rows), ["id"]).collect()}
    for i, (ref, pred) in enumerate(rows):
        r, p = ref.split(), pred.split()
        assert got[i]["recall"] == pytest.approx(lcs(r, p) / len(r) if r and p else 0)
        assert got[i]["precision"] == pytest.approx(lcs(r, p) / len(p) if r and p else 0)


def lcs_positions(a, b):
    """Positions of ``a`` found by walking back through the whole table."""
    t = [[lcs(a[:i], b[:j]) for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    i, j, found = len(a), len(b), set()
    while i and j:
        if a[i - 1] == b[j - 1]:
            found.add(i - 1)
            i, j = i - 1, j - 1
        elif t[i][j - 1] > t[i - 1][j]:
            j -= 1
        else:
            i -= 1
    return found


def test_rows_of_bits_walk_back_like_the_whole_table():
    rng = random.Random(3)
    for _ in range(300):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(0, 11))] for _ in range(2))
        assert M.lcs_length(a, b) == lcs(a, b)
        assert M.lcs_positions(a, b) == lcs_positions(a, b)


def test_common_subsequence_of_very_long_texts_in_little_memory():
    rng = random.Random(4)
    a = [rng.randrange(50) for _ in range(20_000)]
    b = [t for t in a if rng.random() < 0.9]
    tracemalloc.start()
    found = M.lcs_positions(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == len(b) == M.lcs_length(a, b)
    assert peak < 16 << 20  # a table of numbers would take 1.4 GB


def test_rouge_lsum_joins_sentences(spark):
    rows = [("w1 w2 w3 w4 w5", "w1 w2 w6 w7 w8. w1 w3 w8 w9 w5"), ("a b. c d", "c d. a b"), ("", "a")]
    got = {r["id"]: r for r in M.rouge_l(pair_df(spark, rows), ["id"]).collect()}
    assert got[0]["rougeLsum"]["recall"] == pytest.approx(4 / 5)
    assert got[0]["rougeLsum"]["precision"] == pytest.approx(4 / 10)
    assert got[1]["rougeLsum"]["fmeasure"] == 1.0 and got[1]["rougeL"]["recall"] == 0.5
    assert got[2]["rougeLsum"]["fmeasure"] == 0.0


def test_rouge_stems_long_words_only(spark):
    row = M.rouge_n(pair_df(spark, [("the cats were running", "the cat was runs")]), ["id"], [1]).first()
    assert row["precision"] == pytest.approx(3 / 4)


def test_rouge_figures_for_one_and_two_references(spark):
    rows = [(0, "a b", ["a b"]), (1, "a b", ["x y", "a c", "a b"])]
    df = spark.createDataFrame(rows, "id int, prediction string, references array<string>")
    got = {r["id"]: r for r in M.rouge(df, ["id"]).collect()}
    assert got[0]["rouge1_fmeasure"] == 1.0 and got[0]["rougeLsum_recall"] == 1.0
    # left out in turn: x y -> best 1, a c -> best 1, a b -> best 1/2
    assert got[1]["rouge1_fmeasure"] == pytest.approx((1 + 1 + 0.5) / 3)


def test_sari_of_known_sentences(spark):
    source = "About 95 species are currently accepted ."
    refs = ["About 95 species are currently known .", "About 95 species are now accepted .", "95 species are now accepted ."]
    rows = [
        (0, source, "About 95 you now get in .", refs), (1, source, "About 95 species are now agreed .", refs),
        (2, source, "About 95 species are currently agreed .", refs),
    ]
    df = spark.createDataFrame(rows, "id int, source string, prediction string, references array<string>")
    got = {r["id"]: r["sari"] for r in M.sari(df, ["id"]).collect()}
    # the figures published with the metric
    assert [got[i] for i in range(3)] == pytest.approx([0.2683, 0.5889, 0.5072], abs=1e-4)


def scored_df(spark, rows):
    return spark.createDataFrame(rows, "id int, req_idx int, choice string, target string, ll double")


def test_first_of_equal_choices_wins(spark):
    rows = [(1, 0, "aa", "b", -2.0), (1, 1, "b", "b", -1.5), (2, 0, "a", "a", -1.0), (2, 1, "b", "a", -1.0), (3, 0, "a", "b", -1.0), (3, 1, "b", "b", float("nan"))]
    got = {r["id"]: r for r in M.pick_choice(scored_df(spark, rows), ["id"]).collect()}
    assert got[1]["pred"] == "b" and got[1]["acc"] == 1.0 and got[1]["acc_norm"] == 0.0
    assert got[2]["pred"] == "a" and got[3]["pred"] == "b"
    with pytest.raises(Exception, match="not among"):
        M.pick_choice(scored_df(spark, [(1, 0, "a", "zz", -1.0)]), ["id"]).collect()


def test_mean_of_one_value_has_no_error(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 0.0), ("b", 1.0)], "g string, v double")
    got = {r["g"]: r for r in G.mean_summary(df, ["g"], "v").collect()}
    assert got["a"]["mean_stderr"] == 0.0 and got["b"]["mean_stderr"] == pytest.approx(math.sqrt(0.5) / math.sqrt(2))


def test_median_is_the_upper_middle(spark):
    df = spark.createDataFrame([("a", v) for v in (5, 1, 9, 7)] + [("b", 3)] * 6 + [("b", 1)], "g string, v int")
    assert {r["g"]: r["median"] for r in G.median(df, ["g"], "v").collect()} == {"a": 7.0, "b": 3.0}


def test_matthews_and_f1(spark):
    rows = [("x", g, p) for g, p in [(1, 1), (1, 1), (0, 0), (0, 1), (1, 0)]] + [("y", 1, 1), ("y", 1, 1)]
    df = spark.createDataFrame(rows, "g string, gold int, pred int")
    mcc = {r["g"]: r["matthews_corrcoef"] for r in G.matthews_corrcoef(df, ["g"], "gold", "pred").collect()}
    assert mcc["x"] == pytest.approx((2 * 1 - 1 * 1) / math.sqrt(3 * 3 * 2 * 2)) and mcc["y"] == 0.0
    f1 = {r["g"]: r["f1"] for r in G.f1_score(df, ["g"], "gold", "pred").collect()}
    assert f1["x"] == pytest.approx(2 / 3) and f1["y"] == 1.0


def test_answer_groups(spark):
    rows = [("a", 0, 0, 1, True), ("a", 0, 0, 0, True), ("a", 0, 1, 1, True), ("a", 1, 1, 0, True)]
    df = spark.createDataFrame(rows, "g string, paragraph int, question int, label int, pred boolean")
    assert G.acc_all(df, ["g"]).first()["acc_all"] == pytest.approx(1 / 3)
    # by question alone both groups hold a wrong answer
    assert G.acc_all_stderr(df, ["g"]).first()["acc_all_stderr"] == 0.0


def test_parity(spark):
    df = spark.createDataFrame([("a", 0, "x"), ("a", 1, "x"), ("a", 2, "x"), ("a", 3, "y"), ("a", 5, "x"), ("b", 1, "x"), ("b", 2, "x")], "g string, idx int, prediction string")
    got = {r["g"]: r for r in G.parity(df, ["g"]).collect()}
    assert got["a"]["parity"] == 0.5 and got["a"]["pairs"] == 2 and got["a"]["parity_stderr"] == pytest.approx(0.5)
    assert got["b"]["parity"] == 0.0 and got["b"]["parity_stderr"] == 0.0


def gen_df(spark, rows):
    return spark.createDataFrame([("g", i, p, r) for i, (p, r) in enumerate(rows)], "g string, id int, prediction string, references array<string>")


def naive_bleu(rows):
    correct, total, sys_len, ref_len = [0] * 4, [0] * 4, 0, 0
    for pred, refs in rows:
        p, rs = pred.split(), [r.split() for r in refs]
        sys_len += len(p)
        ref_len += min((abs(len(r) - len(p)), len(r)) for r in rs)[1]
        for n in range(1, 5):
            count = lambda t: Counter(tuple(t[i : i + n]) for i in range(len(t) - n + 1))
            best = Counter()
            for r in rs:
                best |= count(r)
            correct[n - 1] += sum((count(p) & best).values())
            total[n - 1] += max(0, len(p) - n + 1)
    if not sum(correct):
        return 0.0
    logs, smooth = 0.0, 1.0
    for c, t in zip(correct, total):
        if t == 0:
            return 0.0
        if c == 0:
            smooth *= 2
        logs += math.log(100 * c / t if c else 100 / (smooth * t))
    return (math.exp(1 - ref_len / sys_len) if sys_len < ref_len else 1.0) * math.exp(logs / 4)


@pytest.mark.parametrize("n_words", [2, 4, 30])
def test_bleu_with_and_without_smoothing(spark, n_words):
    rng = random.Random(n_words)
    text = lambda n: " ".join(rng.choice("abcdefgh") for _ in range(n))
    rows = [(text(n_words), [text(n_words + 1), text(n_words - 1)]) for _ in range(6)]
    got = CM.bleu(CM.bleu_stats(gen_df(spark, rows), ["g", "id"]), ["g"]).first()["bleu"]
    assert got == pytest.approx(naive_bleu(rows))


def test_bleu_ends(spark):
    same = gen_df(spark, [("the cat sat on the mat", ["the cat sat on the mat"])])
    assert CM.bleu(CM.bleu_stats(same, ["g", "id"]), ["g"]).first()["bleu"] == pytest.approx(100.0)
    none = gen_df(spark, [("", ["a b c d e"]), ("zz", ["a"])])
    assert CM.bleu(CM.bleu_stats(none, ["g", "id"]), ["g"]).first()["bleu"] == 0.0


def test_tokens_13a(spark):
    from polyspark.functions.text import tokens_13a

    text = "It's &quot;1,000.5&quot; (about) 50-60%, no?\nEnd."
    got = spark.createDataFrame([(text,)], "t string").select(tokens_13a(F.col("t"))).first()[0]
    assert got == ["It's", '"', "1,000.5", '"', "(", "about", ")", "50", "-", "60", "%", ",", "no", "?", "End", "."]


def naive_chrf(pred, ref):
    p, r = "".join(pred.split()), "".join(ref.split())
    precisions, recalls = [], []
    for n in range(1, 7):
        count = lambda t: Counter(t[i : i + n] for i in range(len(t) - n + 1))
        a, b = count(p), count(r)
        if a and b:
            hits = sum((a & b).values())
            precisions.append(hits / sum(a.values()))
            recalls.append(hits / sum(b.values()))
    if not precisions:
        return 0.0
    p, r = sum(precisions) / len(precisions), sum(recalls) / len(recalls)
    return 100 * 5 * p * r / (4 * p + r) if p + r else 0.0


def test_chrf_takes_the_best_reference(spark):
    rows = [("ein kleiner Test", ["völlig anders", "ein kleines Fest"]), ("ab", ["abc"]), ("", ["x"])]
    got = CM.chrf_stats(gen_df(spark, rows), ["g", "id"])
    scores = {r["id"]: r["c"] for r in got.select("id", CM.chrf_score().alias("c")).collect()}
    assert scores == {i: pytest.approx(max(naive_chrf(p, r) for r in refs)) for i, (p, refs) in enumerate(rows)}


def plain_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def plain_path(a, b):
    """Edits walked back from the end: same or swap first, then drop, then insert."""
    cost = lambda i, j: plain_edits(a[:i], b[:j])
    i, j, path = len(a), len(b), ""
    while i or j:
        if i and j and cost(i - 1, j - 1) + (a[i - 1] != b[j - 1]) == cost(i, j):
            i, j, path = i - 1, j - 1, ("=" if a[i - 1] == b[j - 1] else "s") + path
        elif i and cost(i - 1, j) + 1 == cost(i, j):
            i, path = i - 1, "d" + path
        else:
            j, path = j - 1, "i" + path
    return path


def test_edit_rows_of_bits_equal_the_table():
    rng = random.Random(2)
    for _ in range(150):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 9))] for _ in range(2))
        rows = CM.EditRows(a, b)
        assert rows.edits == plain_edits(a, b)
        assert rows.path() == plain_path(a, b)
        if a:
            low, high = sorted((rng.randrange(len(a) + 1), rng.randrange(len(a) + 1)))
            moved = a[:low] + rng.sample(a[low:high], high - low) + a[high:]
            assert rows.edits_of(moved, low, high) == plain_edits(moved, b)


def test_ter_of_a_long_pair_is_quick():
    rng = random.Random(1)
    ref = [f"w{rng.randrange(3000)}" for _ in range(1500)]
    hyp = [w for w in ref if rng.random() < 0.9]
    hyp[30:30] = hyp[40:46]
    del hyp[46:52]
    tracemalloc.start()
    assert CM.ter_edits(hyp, ref) < CM.EditRows(hyp, ref).edits
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20  # a table of Python pairs would take over 100 MB
    began = time.perf_counter()
    CM.ter_edits(hyp, ref)
    assert time.perf_counter() - began < 5


def test_ter_counts_a_moved_block_once(spark):
    moved = ("this week the saudis denied information published in the new york times".split(), "the saudis denied this week information published in the american new york times".split())
    assert plain_edits(*moved) == 5 and CM.ter_edits(*moved) == 2
    rng = random.Random(4)
    for _ in range(60):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 8))] for _ in range(2))
        assert CM.ter_edits(a, b) <= (plain_edits(a, b) if b else len(a))
        assert CM.ter_edits(b, b) == 0
    rows = [("A b c", ["a b c d", "x y"]), ("q", ["r"])]
    assert CM.ter(CM.ter_stats(gen_df(spark, rows), ["g", "id"]), ["g"]).first()["ter"] == pytest.approx(100 * 2 / 4)


def test_bootstrap_methods_are_near_the_closed_form(spark):
    df = spark.range(300).select(F.lit("g").alias("g"), "id", (F.col("id") % 3 == 0).cast("int").alias("v"), F.lit(1).alias("gold"))
    closed = df.groupBy("g").agg(G.mean_stderr(F.col("v").cast("double")).alias("s")).first()["s"]
    for method in ("index", "poisson"):
        got = G.bootstrap_stderr(df, ["g"], G.mean_of("v"), "id", 400, method=method).first()["stderr"]
        assert got == pytest.approx(closed, rel=0.15)
    draws = G.index_draws(df, ["g"], "id", 20, 0).groupBy("round").agg(F.sum("times").alias("n")).collect()
    assert len(draws) == 20 and all(r["n"] == 300 for r in draws)


def test_which_standard_error(spark):
    assert G.rounds_used(2500) == 2000 and G.rounds_used(300) == 300
    assert G.bootstrap_rounds("chrf") == 1000 and G.bootstrap_rounds("median") == 100_000
    df = spark.createDataFrame([("g", 1, 1.0)], "g string, id int, v double")
    assert G.stderr_for("bleu", df, ["g"], "id", {}) is None and G.stderr_for("weighted_perplexity", df, ["g"], "id", {}) is None
    assert G.stderr_for("mean", df, ["g"], "id", {"value": "v"}).first()["stderr"] == 0.0


def test_unknown_metric_is_an_error(spark):
    df = spark.createDataFrame([("g", "strange", 1.0)], "g string, metric string, value double")
    with pytest.raises(Exception, match="strange"):
        G.aggregate_results(df, ["g"]).collect()
    assert G.aggregate_results(df, ["g"], {"strange": "mean"}).first()["value"] == 1.0


def test_gram_counts_are_few_rows_a_pair(spark):
    text = [f"w{i}" for i in range(500)]
    pairs = spark.createDataFrame([(1, text + ["w0"], text), (2, [], [])], "id int, p array<string>, r array<string>")
    rows = M.gram_counts(pairs, ["id"], {"p": F.array("p"), "r": F.array("r")}, [1, 2]).collect()
    assert len(rows) < 20
    long = {(r["id"], r["n"], r["p"], r["r"]): r["grams"] for r in rows}
    assert (long[1, 1, 1, 1], long[1, 1, 2, 1], long[1, 2, 1, 1], long[1, 2, 1, 0]) == (499, 1, 499, 1)
    assert {r["n"] for r in rows if r["id"] == 2} == {1, 2} and not any(r["p"] or r["r"] for r in rows if r["id"] == 2)


def test_gram_counts_of_rows_with_equal_keys_add_up(spark):
    rows = [(1, ["a", "b", ""], [["a"], ["a", "a"]]), (1, ["a"], [["a"], ["b"]]), (None, ["é"], [[]]), (None, ["é"], [[]]), (3, ["a"], [["a", "a"], ["a"]])]
    pairs = spark.createDataFrame(rows, "id int, p array<string>, r array<array<string>>")
    for best, most in (((), {1: 4, None: 0, 3: 3}), (("r",), {1: 2, None: 0, 3: 2})):
        counts = M.gram_counts(pairs, ["id"], {"p": F.array("p"), "r": F.col("r")}, [1], best=best)
        total = counts.groupBy("id").agg(F.sum(F.col("p") * F.col("grams")).alias("p"), F.max("r").alias("r"), F.max("p").alias("most")).collect()
        assert {r["id"]: r["r"] for r in total} == most
        assert {r["id"]: (r["p"], r["most"]) for r in total} == {1: (4, 2), None: (2, 2), 3: (1, 1)}


def test_subsequence_scores_hand_over_texts(spark):
    rows = [("The cats. sat\n\n on mats", "cat sat. Mats, the cats."), ("", "..."), (". .", "a")]
    scored = M.rouge_l(pair_df(spark, rows), ["id"])
    got = {r["id"]: r for r in scored.collect()}
    assert got[0]["rougeL"]["recall"] == pytest.approx(3 / 5) and got[0]["rougeLsum"]["recall"] == pytest.approx(4 / 5)
    assert got[1]["rougeLsum"]["fmeasure"] == got[2]["rougeL"]["fmeasure"] == 0.0
    assert scored._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython [") == 1


def test_perplexity_of_an_empty_text(spark):
    df = spark.createDataFrame([(1, "a b", -2.0), (2, "", -1.0)], "id int, text string, ll double")
    for parts in (M.perplexity_parts(df), M.perplexity_parts(M.text_sizes(df).drop("text"), text=None)):
        got = {r["id"]: r for r in parts.collect()}
        assert got[1]["byte_perplexity_instance"] == pytest.approx(math.exp(2 / 3))
        assert (got[2]["words"], got[2]["bytes"], got[2]["word_perplexity_instance"]) == (1, 0, pytest.approx(math.e))
        assert got[2]["byte_perplexity_instance"] is None and got[2]["bits_per_byte_instance"] is None


def test_perplexity_queries_over_texts_without_words(spark, tmp_path):
    import duckdb

    from compare import rows_of
    from polyspark.queries import QUERIES
    from polyspark.queries.doc_metrics import _rolling

    texts = ["a b a", "", " \t\n", "b a c", None, "a", "", "c c\x1fa"]
    rows = [(i, t, "en" if i < 5 else "de") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    for name in ("perplexity_parts", "weighted_perplexity"):
        fn, sql = QUERIES[name]
        got, cursor = fn(spark, str(tmp_path)), con.execute(sql)
        assert rows_of(got.columns, [tuple(r) for r in got.collect()]) == rows_of([d[0] for d in cursor.description], cursor.fetchall())
    # a score meets the sizes of a text, not the text
    assert sorted(_rolling(spark, str(tmp_path)).columns) == ["bytes", "doc_id", "lang", "ll", "task", "words"]
