import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from polyspark.operators import vocab as V
from polyspark.operators.tokens import merge_word, tokenize
from polyspark.session import saved


def naive_merges(counts, n):
    words = {w: list(w) for w in counts}
    out = []
    for _ in range(n):
        pairs = Counter()
        for w, symbols in words.items():
            for a, b in zip(symbols, symbols[1:]):
                if len(a) + len(b) <= 16:
                    pairs[a, b] += counts[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        out.append((*best, pairs[best]))
        for w, symbols in words.items():
            merged, i = [], 0
            while i < len(symbols):
                if tuple(symbols[i : i + 2]) == best:
                    merged.append("".join(best))
                    i += 2
                else:
                    merged.append(symbols[i])
                    i += 1
            words[w] = merged
    return out


def naive_split(word, scores):
    symbols = list(word)
    while True:
        found = [(scores[a + b], -i) for i, (a, b) in enumerate(zip(symbols, symbols[1:])) if a + b in scores]
        if not found:
            return symbols
        i = -max(found)[1]
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    out = Counter()
    for _ in range(150):
        out["".join(rng.choice("aabbcde") for _ in range(rng.randint(1, 9)))] += rng.randint(1, 6)
    out["aaaaaaa"] = 9
    out["abababab"] = 9
    return out


@pytest.mark.parametrize("horizon", [7, 512])
def test_rounds_give_the_merges_of_one_at_a_time(spark, words, horizon):
    counts = spark.createDataFrame([("▁" + w, n) for w, n in words.items()], "word string, n bigint")
    got = V.learn_bpe(counts, 25, horizon=horizon).orderBy("rank").collect()
    want = naive_merges({"▁" + w: n for w, n in words.items()}, 25)
    assert [(r["left"], r["right"], r["n"]) for r in got] == want
    assert [r["score"] for r in got] == [-float(i) for i in range(25)]


def test_safe_prefix_stops_where_the_order_could_change():
    assert V.safe_prefix([("a", "b", 9), ("c", "d", 8), ("b", "c", 7), ("e", "f", 6)], True) == [("a", "b"), ("c", "d")]
    # (aq, y) could tie with (c, d) and sorts before it; (x, aq) sorts after it
    assert V.safe_prefix([("a", "q", 9), ("c", "d", 5), ("q", "y", 5)], True) == [("a", "q")]
    assert V.safe_prefix([("a", "q", 9), ("c", "d", 5), ("x", "a", 5)], True) == [("a", "q"), ("c", "d")]
    assert V.safe_prefix([("a", "a", 9), ("c", "d", 8)], True) == [("a", "a")]
    assert V.safe_prefix([("ab", "c", 9), ("d", "e", 8)], True, {"abc"}) == [("ab", "c")]
    assert V.safe_prefix([("a", "b", 9), ("c", "d", 8)], False) == [("a", "b")]


def test_split_equals_naive_split():
    rng = random.Random(3)
    scores = {"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))): -float(i) for i in range(40)}
    for _ in range(300):
        word = "".join(rng.choice("abcd") for _ in range(rng.randint(1, 20)))
        assert merge_word(word, scores.get) == naive_split(word, scores)


def test_both_ways_to_tokenize_agree(spark, words):
    texts = [(i, " ".join(list(words)[i * 7 : i * 7 + 7])) for i in range(20)] + [(20, ""), (21, "a " * 500)]
    vocab = saved(V.learn_vocabulary(spark.createDataFrame(texts, "id bigint, text string"), 40))
    texts[0] = (0, texts[0][1] + " zé")
    docs = spark.createDataFrame(texts, "id bigint, text string")
    assert vocab.count() == 40
    # é and z are left to byte pieces or to the unknown piece
    bytes_too = vocab.unionByName(
        spark.createDataFrame([(100, "<0xC3>", 0.0, 6), (101, "<0xA9>", 0.0, 6)], vocab.schema)
    )
    for v in (vocab, bytes_too):
        sent = {r["id"]: r["input_ids"] for r in tokenize(docs, v, ["id"], special=(1, 2)).collect()}
        joined = {r["id"]: r["input_ids"] for r in tokenize(docs, v, ["id"], special=(1, 2), broadcast_pieces=0).collect()}
        assert sent == joined
        assert sent[20] == [1, 2]
        table = {r["piece"]: (r["id"], r["score"]) for r in v.collect()}
        scores = {p: s for p, (_, s) in table.items()}
        plain = [table[p][0] if p in table else 0 for w in texts[0][1].split()[:-1] for p in naive_split("▁" + w, scores)]
        assert sent[0][1 : len(plain) + 1] == plain
    assert sent[0][-4:-1] == [0, 100, 101]


@pytest.mark.parametrize("block_bytes", [1, 16 << 20])
def test_whole_words_are_looked_up_a_block_at_a_time(spark, monkeypatch, block_bytes):
    from polyspark.operators import tokens as T

    texts = ["b a new a", "", None, "é a", " \t", "a\x1fb\u2003c", "b a new a"]
    rows = [(k, t) for k in (1, 1, None, 2) for t in texts]  # copies of a key and a text stay as many
    docs = spark.createDataFrame(rows, "id int, text string")
    pieces = [(1, "▁a"), (2, "▁b"), (3, "▁c"), (4, "a"), (5, "▁é"), (6, "▁unused")]
    vocab = spark.createDataFrame([(i, p, -float(i), 1) for i, p in pieces], "id bigint, piece string, score double, type int")
    as_bytes = [(10 + b, f"<0x{b:02X}>", 0.0, 6) for b in range(256)]
    key = lambda r: (str(r["id"]), str(r["input_ids"]))
    for v in (vocab, vocab.unionByName(spark.createDataFrame(as_bytes, vocab.schema))):
        sent = sorted(map(key, tokenize(docs, v, ["id"], mode="word", special=(9, None)).collect()))
        monkeypatch.setattr(T, "BLOCK_BYTES", block_bytes)
        monkeypatch.setattr(T, "BUCKET_PIECES", 2)
        joined = tokenize(docs, v, ["id"], mode="word", special=(9, None), broadcast_pieces=0)
        assert sorted(map(key, joined.collect())) == sent and len(sent) == 28
    assert ("2", "None") in sent and ("2", "[9]") in sent and ("2", "[9, 5, 1]") in sent
    # texts are dealt out once, by block; no shuffle has a row for each word of a text
    plan = joined._jdf.queryExecution().executedPlan().toString()
    dealt = [line.split("hashpartitioning(")[1] for line in plan.splitlines() if "hashpartitioning(" in line]
    assert dealt and all(d.startswith(("_block#", "_bucket#")) for d in dealt)


def test_words_of_the_join_way_are_those_of_the_other(spark):
    from polyspark.functions.text import words as words_of
    from pyspark.sql import functions as F

    text = "".join(f"a{chr(c)}b" for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000)
    assert spark.createDataFrame([(text,)], "t string").select(words_of(F.col("t"))).first()[0] == text.split()


def test_vocabulary_layout(spark):
    docs = spark.createDataFrame([("ab ab ac",)], "text string")
    vocab = V.learn_vocabulary(docs, 9).orderBy("id").collect()
    assert [r["piece"] for r in vocab] == ["<unk>", "<s>", "</s>", "▁a", "▁ab", "a", "▁", "b", "c"]
    assert [r["type"] for r in vocab] == [2, 3, 3] + [1] * 6
    with pytest.raises(ValueError):
        V.learn_vocabulary(docs, 5)


def test_extend_keeps_old_ids_and_new_order(spark):
    schema = "id bigint, piece string, score double, type int"
    old = spark.createDataFrame([(0, "<unk>", 0.0, 2), (1, "a", -1.0, 1)], schema)
    new = spark.createDataFrame([(0, "<unk>", 0.0, 2), (1, "z", -1.0, 3), (2, "a", -2.0, 1), (3, "c", -3.0, 1)], schema)
    got = V.extend_vocab(old, new).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, "<unk>", 0.0, 2), (1, "a", -1.0, 1), (2, "z", -1.0, 1), (3, "c", -3.0, 1)]
    assert tuple(V.vocab_report(old, new, V.extend_vocab(old, new)).first()) == (2, 4, 4, 2)


def test_coverage_keeps_the_character_that_reaches_it(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 9), ("c", 1)], "word string, n bigint")
    assert [r["char"] for r in V.char_inventory(counts, 0.95).orderBy("rank").collect()] == ["a", "b"]
    assert V.char_inventory(counts, 1.0).count() == 3


def test_new_vectors_are_the_mean(spark):
    emb = spark.createDataFrame([(0, [0.0, 2.0]), (1, [1.0, 4.0])], "id bigint, embedding array<float>")
    got = {r["id"]: r["embedding"] for r in V.extend_embeddings(emb, 5, chunk=2).collect()}
    assert sorted(got) == list(range(7))
    assert all(got[i] == [0.5, 3.0] for i in range(2, 7))
    assert V.extend_embeddings(emb, 0).count() == 2


def test_compare_counts_tokens_per_word(spark):
    docs = spark.createDataFrame([("x", "ab ab"), ("y", "zz")], "lang string, text string")
    vocab = V.learn_vocabulary(docs, 9)
    rows = V.tokenizer_compare(docs, {"v": vocab}, ["lang"]).where("lang = 'x'").collect()
    assert rows[0]["tokens_per_word"] >= 1 and rows[0]["vocabulary"] == "v"
