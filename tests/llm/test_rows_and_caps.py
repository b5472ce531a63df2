"""Rows of one id, null ids, many languages, deep pages, and every stage of the pipeline on awkward tables."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from polyspark.llm import automaton, html, langid, minhash, mixing, queries, suffixes, windows
from polyspark.llm.text import texts_of
from test_llm import brute_bytes, brute_words, frame, tuples

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, _doc string, _th string, _text string, name string, row string"


def murmur_clash(spark):
    """Two texts of some words that share the 32-bit hash Spark's ``hash`` gives."""
    words = F.concat_ws(" ", *[F.concat(F.lit(f"w{i}"), F.hex(F.xxhash64("id", F.lit(i)))) for i in range(60)])
    texts = spark.range(200_000).select(words.alias("text")).withColumn("h", F.hash("text"))
    twice = texts.groupBy("h").agg(F.collect_list("text").alias("t")).where(F.size("t") > 1).orderBy("h").first()
    return twice["t"][:2]


def test_texts_of_one_id_and_one_short_hash(spark):
    a, b = murmur_clash(spark)
    for rows in ([(1, a), (2, a), (2, b)], [(1, a), (None, a), (None, b)]):
        got = suffixes.removed_bytes(frame(spark, rows))
        assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows)
        got = automaton.removed_words(frame(spark, rows))
        assert tuples(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows)
        docs = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        kept = corpus_pipeline.near_dedup(spark, docs, SF)
        assert sorted((r["doc_id"] is None, r["text"]) for r in kept.collect()) == sorted([(False, a), (rows[2][0] is None, b)])


def test_copies_under_null_ids(spark):
    """A thousand rows without id: their spans are kept once, and their texts are shingled once a task."""
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(10_000)}" for _ in range(120))
    rows = [(1, text)] + [(None, text)] * 1000 + [(None, f"{text} tail{i}") for i in range(5)]
    got = suffixes.removed_bytes(frame(spark, rows))
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows)
    near = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(near) == len(rows) and {r["component_id"] for r in near} == {1}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    keys = docs.select(F.md5(F.col("text").cast("binary")).alias("m")).distinct().count()
    assert keys == 6 and sum(r["kept"] for r in near) == 1


def test_many_languages(spark):
    """As many languages as the corpus this library is for has; every one is learned."""
    rng = random.Random(4)
    languages = {f"l{i:03}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for i in range(534)}
    rows = [(n, " ".join(rng.choice(words) for _ in range(15)), lang) for n, (lang, words) in enumerate((x for x in languages.items() for _ in range(8)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(docs)
    assert sorted(model.languages) == sorted(languages)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert (got["lang_pred"] == got["lang"]).mean() >= 0.95


def test_held_out_languages(spark):
    got = queries.op6_langid(spark, SF).where("held_out").join(spark.read.parquet(f"{SF}/documents.parquet").where("lang is not null").select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) > 100 and (got["lang_pred"] == got["lang"]).mean() >= 0.95


def test_both_forms_of_a_language_model_agree():
    texts = pa.array(["ab cd", "xy zw", ""])
    rng = np.random.default_rng(1)
    rows, matrix, bias = rng.normal(size=(langid.BUCKETS, 16)), rng.normal(size=(16, 3)), rng.normal(size=3)
    from polyspark.llm.text import texts_of

    long = langid.Model(["a", "b", "c"], rows, matrix, bias, 1.0, 0.0).probabilities(texts_of(texts))
    short = langid.Model(["a", "b", "c"], rows @ matrix, np.eye(3), bias, 1.0, 0.0).probabilities(texts_of(texts))
    assert np.allclose(long, short)


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<div>" * 205 + "<div hidden>secret</div>seen", "seen"),
        ("<div>" * 205 + "<ul><li>a<li>b</ul>", "- a\n- b"),
        ("<div>" * 30_000 + "<p>deep", "deep"),
        ("<style>@media print{.x{display:none}}</style><p class=x>kept", "kept"),
        ("<style>@media screen{.x{display:none}}</style><p class=x>gone</p>kept", "kept"),
        ("<style>@media (max-width:9px){.x{display:none}} .y{display:none}</style><p class=x>kept<p class=y>gone", "kept"),
        ("<style>@import url(a.css); .x{display:none}</style><p class=x>gone</p>kept", "kept"),
        ("<style>.a .b{display:none}</style><div class=a><p><i class=b>gone</i>kept</p></div><i class=b> too</i>", "kept\n\ntoo"),
        ("<style>.a > .b{display:none}</style><div class=a><p><i class=b>kept</i></p><i class=b>gone</i></div>", "kept"),
        ("<style>.a > div .b{display:none}</style><div class=a><div><div><i class=b>gone</i>kept</div></div></div>", "kept"),
        ("<p style='visibility:hidden'>gone <b style='visibility:visible'>kept</b> gone</p>", "kept"),
        ("<div style='visibility:hidden'><table><tr><td>gone<td style='visibility:visible'>kept</table></div>", "kept"),
        ("<style>.z{display:none} .z.on{display:block}</style><p class=z>gone<p class='z on'>kept", "kept"),
        ("<style>.z{display:none!important} #i{display:block}</style><p class=z id=i>gone</p>kept", "kept"),
        ("<style>p:hover{display:none} p{color:red}</style><p>kept", "kept"),
        ("<style>p{display:none</style><p>gone</p>kept", "kept"),
    ],
)
def test_visibility(source, want):
    assert html.render(source) == want


def test_wide_spans():
    cells = "<td>c</td>" * 61
    lines = html.render(f"<table><tr><td colspan=60>a</td><td>b</td></tr><tr>{cells}</tr></table>").split("\n")
    assert lines[0].split("|")[-1].strip() == "b" and lines[0].count("|") == 60 == lines[1].count("|")
    assert html._span(html.Element("td", {"colspan": "12345"}), "colspan", html.MOST_COLUMNS) == html.MOST_COLUMNS
    assert html._span(html.Element("td", {"rowspan": "0"}), "rowspan", html.MOST_ROWS) == html.MOST_ROWS


def test_mix_orders_texts_of_one_id(spark):
    """Rows of one id and size are told apart by their text, whatever order they come in."""
    rows = [(None, f"word{i}", "a") for i in range(50)] + [(1, "one two three", "b")]
    schema = "doc_id long, text string, source string"
    one = mixing.mix_sources(spark.createDataFrame(rows, schema), carry=["text"]).collect()
    two = mixing.mix_sources(spark.createDataFrame(rows[::-1], schema).repartition(7), carry=["text"]).collect()
    assert sorted(one, key=repr) == sorted(two, key=repr)


def awkward_stage_rows():
    rng = random.Random(9)
    english = "the quick brown fox jumps over the lazy dog and runs into the dark forest"
    base = [f"{rng.choice(english.split())}" for _ in range(200)]
    texts = [None, "", " ", "12 34 !!", " ".join(base), " ".join(base), " ".join(base[:199] + ["end"]), english, "x " * 100_000, "é" * 100]
    rows = [(i if i % 3 else None, t, "en" if i % 2 else None, "s" if i % 4 else None, None, *["clash"] * 6) for i, t in enumerate(texts)]
    return rows + rows[4:6]


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stage_on_awkward_and_empty_tables(spark, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    rows = awkward_stage_rows()
    docs = spark.createDataFrame(rows, SCHEMA)
    added = ["size", "source_size", "target", "taken"] if name == "mix" else []
    out = stage(spark, docs, SF)
    assert out.columns == docs.columns + added
    got = out.collect()
    assert len(got) <= len(rows) and all(r["name"] == "clash" and r["_key"] == "clash" for r in got)
    texts = {r["text"] for r in got}
    if name == "language_id":
        assert not texts & {None, "", " ", "12 34 !!"}
    if name == "near_dedup":
        full = [r["text"] for r in got if r["text"] and len(r["text"]) > 600 and " " in r["text"]]
        assert len(full) == 2 and {None, "", " "} <= texts  # one of the copies, and the repeated word
    if name in ("substring_dedup", "decontaminate"):
        assert len(got) == len(rows)
    empty = stage(spark, docs.where("false"), SF)
    assert empty.columns == docs.columns + added and empty.count() == 0


@pytest.mark.parametrize("kind", [windows.BYTES, windows.WORDS], ids=["bytes", "words"])
@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_segments_of_equal_windows_share_a_string(kind, letters):
    rng = random.Random(len(letters))
    draw = lambda n: "".join(rng.choice(letters) for _ in range(n))
    shared = [draw(rng.randint(15, 90)) for _ in range(6)]
    texts = [draw(rng.randint(0, 40)) + rng.choice(shared) + draw(rng.randint(0, 40)) + rng.choice(shared) for _ in range(30)]
    if kind.words:
        texts = [" ".join(t) for t in texts]
    units, offs, cut = windows._units(kind, texts_of(pa.array(texts)))
    runs = windows.runs_of(kind, units, offs)
    seg, sides = windows._sides(kind, units, runs)
    values, times = np.unique(sides, return_counts=True)
    passed = set(seg[np.isin(sides, values[times > 1])].tolist())
    seen, repeated = {}, set()
    for i, (data, b, n) in enumerate(zip([cut(runs)[0]] * len(runs.start), *cut(runs)[1:], strict=True)):
        held = data[b : b + n].tobytes()
        held = held.split(b" ") if kind.words else held
        for w in range(len(held) - kind.width + 1):
            window = tuple(held[w : w + kind.width])
            if window in seen:
                repeated |= {i, seen[window]}
            seen.setdefault(window, i)
    assert repeated and repeated <= passed


@pytest.mark.parametrize("letters", ["a", "ab", "abcdefgh"])
def test_suffix_array_of_some_suffixes(letters):
    rng = random.Random(len(letters))
    for n in (1, 2, 60, 500):
        text = "".join(rng.choice(letters) for _ in range(n)).encode()
        data = np.frombuffer(text, np.uint8)
        wanted = np.array([rng.random() < 0.3 for _ in range(n)])
        got = [i for i in suffixes.suffix_array(data, wanted=wanted).tolist() if wanted[i]]
        heads = [text[i : i + suffixes.DEPTH] for i in got]
        assert heads == sorted(heads) and sorted(got) == np.flatnonzero(wanted).tolist()
