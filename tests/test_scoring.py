import pandas as pd
import pytest
from pyspark.sql import functions as F

from polyspark.operators import scoring as S


def windows_of(spark, tokens, max_len, ctx_len):
    df = spark.createDataFrame([(1, tokens)], "id int, tokens array<int>")
    rows = S.rolling_windows(df, "tokens", max_len, ctx_len, F.lit(-100), ["id"]).orderBy("window_idx").collect()
    return [(r["ctx"], r["cont"]) for r in rows]


def naive_windows(tokens, max_len, ctx_len):
    at = min(max_len, len(tokens))
    out = [([-100] + tokens[: at - 1], tokens[:at])]
    while at < len(tokens):
        n = min(len(tokens) - at, max_len - ctx_len + 1)
        out.append((tokens[at + n - max_len - 1 : at + n - 1], tokens[at : at + n]))
        at += n
    return out


@pytest.mark.parametrize("n,max_len,ctx_len", [(10, 4, 1), (10, 4, 4), (34, 10, 1), (34, 10, 5), (34, 10, 10), (3, 10, 2), (10, 10, 1), (1, 1, 1)])
def test_rolling_windows(spark, n, max_len, ctx_len):
    tokens = list(range(n))
    got = windows_of(spark, tokens, max_len, ctx_len)
    assert got == naive_windows(tokens, max_len, ctx_len)
    assert [t for _, cont in got for t in cont] == tokens


def test_no_tokens_no_window(spark):
    assert windows_of(spark, [], 4, 1) == []
    with pytest.raises(ValueError):
        windows_of(spark, [1], 4, 5)


def windows_df(spark, windows):
    rows = [(1, i, c, t) for i, (c, t) in enumerate(windows)]
    return spark.createDataFrame(rows, "id int, window_idx int, ctx array<int>, cont array<int>")


def test_disjoint_windows_keep_the_context_of_a_single_token(spark):
    df = windows_df(spark, [([1, 2, 3], [2, 3, 4]), ([5, 6, 7], [8]), ([7], [7, 8, 9])])
    assert [r["ctx"] for r in S.disjoint_windows(df).orderBy("window_idx").collect()] == [[1], [5, 6, 7], []]


def test_padding_example(spark):
    padded = S.pad_windows(windows_df(spark, [([1], [23, 19, 3]), ([43], [2, 4])]), F.lit(1), 3, ["id"])
    rows = padded.orderBy("window_idx").collect()
    assert [r["ctx"] for r in rows] == [[1], [43]] and [r["cont"] for r in rows] == [[23, 19, 3], [2, 4, 1]]
    empty = S.pad_windows(windows_df(spark, [([], [2])]), F.lit(0), 3, ["id"]).first()
    assert empty["ctx"] == [0] and empty["cont"] == [2]
    longer = S.pad_windows(windows_df(spark, [([1], [2, 3, 4]), ([5, 6, 7], [8])]), F.lit(0), 3, ["id"]).orderBy("window_idx")
    assert [r["ctx"] for r in longer.collect()] == [[1, 0, 0], [5, 6, 7]]


@pytest.mark.parametrize("n_ctx,n_cont", [(1, 8), (5, 4), (5, 5), (6, 4), (30, 3)])
def test_left_truncation(spark, n_ctx, n_cont):
    ctx, cont, max_len = list(range(n_ctx)), list(range(100, 100 + n_cont)), 8
    df = spark.createDataFrame([(ctx, cont)], "a array<int>, b array<int>")
    cols = S.truncate_left(F.col("a"), F.col("b"), max_len)
    row = df.select(*[c.alias(k) for k, c in cols.items()], S.truncate_for_generation(F.col("a"), 8, 3).alias("g")).first()
    assert row["input"] == (ctx + cont)[-(max_len + 1) :][:-1]
    assert row["api_input"] == (ctx + cont)[-(max_len + 1) :]
    assert row["ctx_len"] == n_ctx - max(0, n_ctx + n_cont - (max_len + 1))
    assert row["g"] == ctx[-5:]


def test_batches_are_longest_first(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).cast("int").alias("n"), F.md5(F.col("id").cast("string")).alias("h"))
    rows = S.length_batches(df, "n", "h", 8).collect()
    lengths = {}
    for r in rows:
        lengths.setdefault(r["batch"], []).append((r["n"], r["padded_length"]))
    flat = [n for b in sorted(lengths) for n, _ in sorted(lengths[b], reverse=True)]
    assert flat == sorted(flat, reverse=True)
    assert all(len(v) == 8 for b, v in lengths.items() if b < 12) and all(p == max(n for n, _ in v) for v in lengths.values() for _, p in v)


def requests_df(spark, n=60, distinct=3):
    rows = [(i, "loglikelihood", f"c{i % distinct}" if i % 2 else "hot", f" {i % distinct}") for i in range(n)]
    return spark.createDataFrame(rows, "id int, req_type string, ctx string, cont string")


def test_dedup_and_scatter_change_nothing(spark):
    requests = requests_df(spark)
    direct = {r["id"]: r["ll"] for r in S.score_dummy(requests).collect()}
    unique = S.dedup_requests(requests)
    assert unique.count() == 6 and unique.agg(F.sum("origins")).first()[0] == 60
    back = S.scatter_back(requests, S.score_dummy(unique).select("request_key", "origins", "ll"), ["id"])
    assert {r["id"]: r["ll"] for r in back.collect()} == direct


def test_cut_of_one_text_in_two_ways_stays_two_requests(spark):
    df = spark.createDataFrame([("loglikelihood", "a b", " c"), ("loglikelihood", "a", " b c")], "req_type string, ctx string, cont string")
    assert S.dedup_requests(df).count() == 2


def test_cache_scores_only_what_is_new(spark, tmp_path):
    seen = []

    def score(df):
        seen.append(df.count())
        return S.score_dummy(df)

    path = str(tmp_path / "cache")
    requests = requests_df(spark)
    S.cached_scores(requests.where("id % 3 = 0"), path, score, ["id"])
    again = S.cached_scores(requests, path, score, ["id"])
    assert seen == [2, 4] and again.count() == 60
    S.cached_scores(requests, path, score, ["id"])
    assert seen[-1] == 0 and spark.read.parquet(path).count() == 6


def test_user_model(spark):
    unique = S.dedup_requests(requests_df(spark))
    model = lambda b: pd.DataFrame({"ll": -b["cont"].str.len().astype(float), "is_greedy": False, "generated": None})
    assert {r["ll"] for r in S.score_with(unique, model).collect()} == {-2.0}


def test_dummy_generation(spark):
    df = spark.createDataFrame([("greedy_until", "x")], "req_type string, ctx string")
    row = S.score_dummy(df).first()
    assert row["generated"] == "null" and row["ll"] is None
    with pytest.raises(Exception, match="context"):
        S.score_dummy(df.withColumn("ctx", F.lit(" "))).collect()


def test_reduce_logprobs(spark):
    row = (["a", "b", "c"], [-1.0, -2.0, -3.0], [{"z": -0.1}, {"b": -2.0, "x": -2.5}, {"c": -3.0, "y": -4.0}])
    df = spark.createDataFrame([row], "t array<string>, p array<double>, top array<map<string,double>>")
    for ctx, ll, greedy in ((1, -5.0, True), (0, -6.0, False), (3, 0.0, True)):
        cols = S.reduce_logprobs(F.col("p"), F.col("t"), F.col("top"), F.lit(ctx))
        got = df.select(cols["ll"].alias("ll"), cols["is_greedy"].alias("g")).first()
        assert (got["ll"], got["g"]) == (ll, greedy)


def test_stops(spark):
    df = spark.createDataFrame([("one\ntwo<eos>three", 1), ("one\ntwo<eos>three", 0)], "t string, k int")
    cut = S.cut_generation(F.col("t"), F.array(F.lit("\n")), F.col("k"), "<eos>")
    assert [r[0] for r in df.select(cut).collect()] == ["one", "one\ntwo"]
    none = S.cut_generation(F.col("t"), F.lit(None).cast("array<string>"), F.col("k"), "<eos>")
    assert df.select(none).first()[0] == "one\ntwo"


def test_ngram_model_sums_to_one(spark):
    import math

    docs = spark.createDataFrame([("en", 1, ["a", "b", "a"]), ("en", 2, ["a"])], "lang string, id int, w array<string>")
    lm = S.train_ngram_lm(docs, ["lang"], "w")
    test = spark.createDataFrame([("en", i, [w]) for i, w in enumerate(["a", "b", "new"])], "lang string, id int, w array<string>")
    for order in (1, 2):
        lls = {r["id"]: r["ll"] for r in S.score_ngram(lm, test, ["lang"], ["id"], "w", order=order).collect()}
        assert sum(math.exp(v) for v in lls.values()) == pytest.approx(1.0)


def _ngram_by_hand(known, docs, order, alpha=0.5):
    """{(lang, id): (ll, tokens)} of rows (lang, id, words); a null word or language is never found, no words are one null."""
    import math
    from collections import Counter, defaultdict

    pairs = lambda w: [] if w is None else list(zip(["<s>", *w[:-1]], w or [None]))
    bigrams, contexts, words, out = Counter(), Counter(), defaultdict(Counter), defaultdict(lambda: [0.0, 0])
    for lang, _, w in known:
        for a, b in pairs(w):
            bigrams[lang, a, b] += 1
            contexts[lang, a] += 1
            words[lang][b] += 1
    for lang, i, w in docs:
        for a, b in pairs(w):
            total = words[lang].total() if lang else 0
            vocab = len(words[lang]) if lang else 0
            if order == 1:
                over, under = words[lang][b], total
            else:
                over, under = bigrams[lang, a, b] if a else 0, contexts[lang, a] if a else 0
            over, under = over if b and lang else 0, under if lang else 0
            row = out[lang, i]
            row[0] += math.log((over + alpha) / (under + alpha * (vocab + 1)))
            row[1] += 1
    return {k: (pytest.approx(v[0]), v[1]) for k, v in out.items()}


NGRAM_KNOWN = [
    ("en", 1, ["a", "b", "a", "b", None, "a"]), ("en", 1, ["b"]), ("en", None, ["a", "<s>", "a"]), ("en", 2, []), ("en", 3, None),
    ("de", 1, ["a", "b", "c", "a"]), ("de", 2, [None]), (None, 1, ["a", "b"]), ("en", 4, ["a", "b", "a", "b", None, "a"]),
]
NGRAM_NEW = [("en", 7, ["a", "b", "new", None]), ("fr", 7, ["a", "b"]), ("de", 8, ["c", "a", "b"]), (None, 8, ["a"]), ("de", 9, ["x"] * 5)]


@pytest.mark.parametrize("words_a_block", [1, 1 << 21])
def test_ngram_scores_of_known_and_new_documents(spark, monkeypatch, words_a_block):
    monkeypatch.setattr(S, "BLOCK_WORDS", words_a_block)
    frame = lambda rows: spark.createDataFrame(rows, "lang string, id int, w array<string>")
    known, new = frame(NGRAM_KNOWN), frame(NGRAM_NEW)
    lm = S.train_ngram_lm(known, ["lang"], "w")
    for order in (1, 2):
        for docs, rows in ((known, NGRAM_KNOWN), (new, NGRAM_NEW)):
            got = S.score_ngram(lm, docs, ["lang"], ["id"], "w", order=order).collect()
            assert {(r["lang"], r["id"]): (r["ll"], r["n_tokens"]) for r in got} == _ngram_by_hand(NGRAM_KNOWN, rows, order)


def test_ngram_scoring_shuffles_no_row_a_pair(spark):
    docs = spark.createDataFrame([("en", i, ["a", "b", "c", "a"]) for i in range(50)], "lang string, id int, w array<string>")
    for order in (1, 2):
        lm = S.train_ngram_lm(docs, ["lang"], "w")
        scored = S.score_ngram(lm, docs, ["lang"], ["id"], "w", order=order)
        plan = scored._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_b" in plan and "hashpartitioning(lang" in plan
        dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
        assert not [line for line in dealt if "w1#" in line or "w2#" in line]
    # a pair and a word are asked for once a block, though 50 documents hold them
    block = S._blocks(docs, ["lang"], [], "w", 0, []).withColumn("_block", F.lit(0))
    asked = block.groupBy("_block").applyInArrow(S._asks(1, 2), S.ASKED_SCHEMA).collect()
    assert {r["_bucket"]: sorted(r["n"]) for r in asked} == {0: [50, 50, 50, 50], -1: [50, 50, 50, 50]}


@pytest.mark.parametrize("words_a_block", [1, 1 << 21])
def test_ngram_table_is_bigrams_with_their_contexts(spark, monkeypatch, words_a_block):
    monkeypatch.setattr(S, "BLOCK_WORDS", words_a_block)
    many = [("en", 10 + i, ["a", f"x{i % 7}", "a", f"y{i}", "a", "b"]) for i in range(60)]  # "a" is spread over partitions
    docs = spark.createDataFrame(NGRAM_KNOWN + many, "lang string, id int, w array<string>").repartition(3)
    lm = S.train_ngram_lm(docs, ["lang"], "w")
    table = S.ngram_table(lm, ["lang"])
    plain = lm["bigrams"].join(lm["contexts"], ["lang", "w1"])
    assert table.columns == plain.columns
    key = lambda r: tuple("" if v is None else str(v) for v in r)
    assert sorted(map(key, table.collect())) == sorted(map(key, plain.collect()))
    # one shuffle serves both counts: none deals rows out by the second word
    plan = table._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning(" in line]
    assert dealt and not [line for line in dealt if "w2#" in line.split("hashpartitioning(")[1]]


def test_ngram_table_of_two_groupings(spark):
    rows = [("en", 1, ["a", "b"]), ("en", 2, ["a", "b", "a"]), ("de", 1, ["a"]), ("de", None, ["a"]), (None, 2, ["a"])]
    docs = spark.createDataFrame(rows, "lang string, part bigint, w array<string>")
    got = S.ngram_table(S.train_ngram_lm(docs, ["lang", "part"], "w"), ["lang", "part"]).collect()
    assert sorted(tuple(r) for r in got) == [
        ("de", 1, "<s>", "a", 1, 1), ("en", 1, "<s>", "a", 1, 1), ("en", 1, "a", "b", 1, 1),
        ("en", 2, "<s>", "a", 1, 1), ("en", 2, "a", "b", 1, 1), ("en", 2, "b", "a", 1, 1),
    ]
