"""Training-data operators against brute force, exact round trips and held-out labels, with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from polyspark.llm import automaton, covertree, decontam, html, langid, minhash, mixing, quality, queries, suffixes, warc

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EXTRA = ["key", "name", "size", "th", "doc", "body", "spans", "seg", "route"]


def awkward_texts():
    rng = random.Random(5)
    line = " ".join(f"w{i}" for i in range(60))
    base = [f"t{rng.randrange(400)}" for _ in range(300)]
    near = base.copy()
    near[150] = "changed"
    far = [w if i % 7 else f"x{i}" for i, w in enumerate(base)]
    return [
        (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base)), (4, " ".join(base)), (4, line),
        (5, None), (6, ""), (7, " \t\n"), (8, "one two"), (9, "One\ttwo"), (10, f"start {line} end"), (11, f"other {line}  tail"),
        (None, " ".join(base)), (None, "alone here " + line), (12, "ab " * 200), (13, "é" * 300), (14, "x" + "é" * 300), (15, "  a b"),
        (16, " ".join(f"v{rng.randrange(50)}" for _ in range(20_000))), (17, "he the " * 90), (18, " ".join(base[:40]) + " mid " + " ".join(base[:40])),
    ]


def frame(spark, rows, schema="doc_id long, text string", extra=True):
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({c: F.lit("clash") for c in EXTRA}) if extra else df


def ordered(doc_id):
    return (1 << 63) - 1 if doc_id is None else doc_id


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# op 4


def brute_bytes(rows):
    first = {}
    data = [(d, (t or "").encode()) for d, t in rows]
    for d, b in data:
        for i in range(len(b) - 49):
            s = b[i : i + 50]
            first[s] = min(first.get(s, 1 << 64), ordered(d))
    out = []
    for d, b in data:
        gone = [False] * len(b)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < ordered(d):
                gone[i : i + 50] = [True] * 50
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_suffix_array_dedup(spark):
    rows = awkward_texts()
    got = suffixes.removed_bytes(frame(spark, rows))
    assert tuples(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute_bytes(rows)


def test_suffix_array_orders_suffixes():
    rng = random.Random(1)
    for _ in range(150):
        n = rng.randint(1, 300)
        s = bytes(rng.randrange(rng.choice([1, 2, 3, 26])) + 97 for _ in range(n))
        s += s[: rng.randint(0, n)]
        got = suffixes.suffix_array(np.frombuffer(s, np.uint8)).tolist()
        assert sorted(got) == list(range(len(s)))
        assert [s[i : i + 50] for i in got] == sorted(s[i : i + 50] for i in range(len(s)))


# op 5


def brute_words(rows):
    first = {}
    data = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, w in data:
        for i in range(len(w) - 19):
            s = tuple(w[i : i + 20])
            first[s] = min(first.get(s, (1 << 64, 0)), (ordered(d), i))
    out = []
    for d, w in data:
        gone = [False] * len(w)
        for i in range(len(w) - 19):
            if first[tuple(w[i : i + 20])] < (ordered(d), i):
                gone[i : i + 20] = [True] * 20
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_automaton_dedup(spark):
    rows = awkward_texts()
    got = automaton.removed_words(frame(spark, rows), carry=["size"])
    assert tuples(got, "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows)
    assert {r["size"] for r in got.collect()} == {"clash"}


def test_automaton_names_windows():
    rng = random.Random(2)
    for _ in range(60):
        shard, names = automaton.Automaton(), {}
        parts = [[rng.randrange(3) for _ in range(rng.randint(1, 60))] for _ in range(4)]
        for p in parts:
            shard.add(p)
        for p in parts:
            for e, state in enumerate(shard.states(p, 5)):
                if e < 4:
                    assert state == -1
                else:
                    assert names.setdefault(tuple(p[e - 4 : e + 1]), state) == state
        assert len(set(names.values())) == len(names)
        assert shard.states([7, 8, 9, 9, 9, 9], 5) == [-1] * 6


# op 10


def brute_near(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall("".join(c.lower() if c.isascii() else c for c in t or ""))
        sets.append(frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [x for x in members[find(i)] if x is not None]
        component = min(ids) if ids and sets[i] else d
        out.append((d, len(sets[i]), component, d == component))
    return sorted(out, key=repr)


def test_minhash(spark, monkeypatch):
    rows = awkward_texts()
    want = brute_near(rows)
    assert tuples(minhash.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept") == want
    # lists and components cut into blocks give the same
    monkeypatch.setattr(minhash, "LIST_BLOCK", 2)
    monkeypatch.setattr(minhash, "SET_BLOCK", 2)
    assert tuples(minhash.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept") == want


def test_minhash_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(400)]
    rows = []
    for d in range(250):
        w = base.copy()
        for _ in range(rng.choice([0, 1, 3, 6, 9, 14])):
            w[rng.randrange(400)] = f"z{rng.randrange(10**6)}"
        rows.append((d, " ".join(w)))
    assert tuples(minhash.near_duplicates(frame(spark, rows)), "doc_id", "n_shingles", "component_id", "kept") == brute_near(rows)


# op 1


def brute_vectors(rows):
    def unit(e):
        if e is None or not e or any(x is None or not np.isfinite(x) for x in e) or not any(e):
            return None
        v = np.array(e, np.float32).astype(float)
        return v / np.linalg.norm(v)

    units = [unit(e) if label is not None else None for _, e, label in rows]
    n = len(rows)
    links = [[j for j in range(n) if j != i and units[i] is not None and units[j] is not None and rows[i][2] == rows[j][2]
              and len(units[i]) == len(units[j]) and units[i] @ units[j] >= 0.93] for i in range(n)]
    seen, out = {}, []
    for i in range(n):
        if i not in seen:
            stack, group = [i], set()
            while stack:
                x = stack.pop()
                if x not in group:
                    group.add(x)
                    stack += links[x]
            seen |= dict.fromkeys(group, group)
        ids = [rows[j][0] for j in seen[i] if rows[j][0] is not None]
        component = min(ids) if ids and units[i] is not None else rows[i][0]
        out.append((rows[i][0], len(links[i]), component, rows[i][0] == component))
    return sorted(out, key=repr)


def test_cover_tree(spark, monkeypatch):
    rng = np.random.default_rng(4)
    rows = [(None, [1.0, 0.0], 1), (1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [float("nan"), 1.0], 1), (5, [1.0, None], 1),
            (6, [1.0, 0.0], None), (7, [2.0, -0.0], 1), (8, [1.0, 0.0], 1), (8, [1.0, 0.0], 1), (9, [1.0, 0.0, 0.0], 1), (10, [-1.0, 0.0], 1),
            (11, [float("inf"), 1.0], 1), (12, [1e-30, 0.0], 1)]
    centres = rng.normal(size=(12, 8))
    for i in range(300):
        v = centres[i % 12] + rng.normal(size=8) * 0.28
        rows.append((100 + i, v.astype(np.float32).tolist(), int(i % 2)))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").withColumns({c: F.lit("clash") for c in EXTRA})
    want = brute_vectors(rows)
    assert tuples(covertree.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == want
    for name, value in (("BLOCK", 20), ("ASSIGNED", 40), ("LEAF", 4), ("SAMPLE", 60)):
        monkeypatch.setattr(covertree, name, value)
    assert tuples(covertree.near_vectors(df), "vec_id", "n_links", "component_id", "kept") == want


# op 7


def test_mixing(spark):
    rows = [(1, "a b c", "s"), (2, "d e", "s"), (2, "d e", "s"), (3, None, "s"), (4, "", "t"), (5, "x " * 50, None), (None, "q r", "u"), (6, "y " * 30, "u")]
    got = mixing.mix_sources(frame(spark, rows, "doc_id long, text string, source string"), carry=["th"]).collect()
    total = sum(len(WORD.findall(t or "")) for _, t, _ in rows)
    by = defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 3 * r["size"]
    assert abs(sum(r[0]["target"] for r in by.values()) - total) < 1e-6
    for part in by.values():
        assert sum(r["taken"] for r in part) == int(part[0]["target"])
    # weights 5, 2, 1, 5 for s, t, u, null; s is capped at 3 * 7, t at 0
    assert by["s"][0]["target"] == 21 and by["t"][0]["target"] == 0
    assert by["u"][0]["target"] == pytest.approx((total - 21) / 6) and by[None][0]["target"] == pytest.approx((total - 21) * 5 / 6)


# op 9


def test_archive(spark, tmp_path):
    big = "<p>" + "é" * 80
    rows = [(3, "http://a", big), (1, None, big), (1, "http://b\r\nX: y", big), (2, "http://c%20", "short"), (4, "u", "short"), (5, "u", None), (None, "u", big), (6, "u", "")]
    path = f"file://{tmp_path}/archive"
    warc.write_archive(frame(spark, rows, "page_id long, url string, html string"), path)
    got = tuples(warc.read_archive(spark, path), "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    digest = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    size = lambda t: len((t or "").encode())
    want = [(p, size(h), digest(h), "revisit" if h == big and p != 1 else "response", 1 if h == big and p != 1 else None) for p, _, h in rows]
    assert got == sorted(want, key=repr)
    assert spark.read.parquet(f"{path}/payloads").count() == 3
    for r in warc.record_bytes(spark, path).collect():
        head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
        lines = head.split(b"\r\n")
        assert lines[0] == b"WARC/1.1" and all(b": " in x for x in lines[1:])
        assert body == (b"" if r["record_type"] == "revisit" else r["html"].encode()) + b"\r\n\r\n"
    damaged = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.concat("payload", F.lit(b"x")))
    damaged.write.parquet(f"{path}2/payloads")
    spark.read.parquet(f"{path}/headers").write.parquet(f"{path}2/headers")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, f"{path}2").collect()


# op 2


def test_decontamination(spark):
    rng = random.Random(6)
    words = [f"k{i}" for i in range(3000)] + ["the", "of", "and"] * 300
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(25, 60)) + ".") for i in range(30)] + [(30, None), (31, ""), (32, items_copy := "some copy " + text(30)), (33, items_copy)]
    rows = [(d, text(rng.randint(1, 400))) for d in range(300)]
    want = set()
    for d in range(0, 60, 2):  # whole, and with words dropped and changed
        item = items[d // 2][1].split()
        item = item if d % 4 else [w if i % 9 != 4 else "swapped" for i, w in enumerate(item) if i % 11 != 7]
        own = rows[d][1].split()
        at = rng.randrange(len(own) + 1)
        rows[d] = (d, " ".join(own[:at] + ["-"] + [w.upper() for w in item] + own[at:]))
        want.add((d, d // 2))
    rows += [(500, None), (501, ""), (502, "..."), (503, items_copy), (503, items_copy), (None, items_copy)]
    got = decontam.contaminated(frame(spark, rows), spark.createDataFrame(items, "item_id long, text string").withColumn("th", F.lit(1)))
    found = [tuple(r) for r in got.select("doc_id", "item_id").collect()]
    assert {x for x in found if x[0] is not None and x[0] < 500} == want
    assert sorted((x for x in found if x[0] is None or x[0] >= 500), key=repr) == sorted([(503, 32), (503, 33)] * 2 + [(None, 32), (None, 33)], key=repr)
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(frame(spark, rows), empty).count() == 0


def test_common_subsequence():
    rng = random.Random(7)
    for _ in range(100):
        a, b = ([rng.randrange(5) for _ in range(rng.randint(1, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_subsequence(decontam._masks(np.array(a)), len(a), b) == table[-1][-1]


def test_singular_vectors():
    rng = np.random.default_rng(8)
    a = rng.normal(size=(200, 5)) @ rng.normal(size=(5, 40))
    random_ = rng.normal(size=(40, 12))
    v, s = decontam.singular_vectors(a.T @ (a @ random_), random_)
    _, want, basis = np.linalg.svd(a, full_matrices=False)
    assert np.allclose(s[:5], want[:5], rtol=1e-3)
    assert np.allclose(np.abs(v[:, :5].T @ basis[:5].T), np.eye(5), atol=1e-2)


# ops 3 and 6


def is_held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_quality_on_held_out_labels(spark):
    got = queries.op3_quality(spark, "/root/testdata/sf0.01").toPandas().set_index("doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id")
    assert len(got) == 1000 and got["score"].between(0, 1).all()
    assert all(got.loc[d, "held_out"] == is_held_out(d) for d in got.index)
    both = got.join(labels, how="inner")
    test = both[both["held_out"]]
    assert (test["predicted"] == test["quality"]).mean() > 0.9


def test_quality_of_awkward_rows(spark):
    rows = awkward_texts()
    forest = quality.fit(frame(spark, rows), spark.createDataFrame([(1, 1, 0), (1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int"))
    got = quality.score(frame(spark, rows), forest)
    assert got.count() == len(rows) and got.where("score < 0 or score > 1 or score is null").isEmpty()


def test_trees_walk_as_they_were_grown():
    rng = np.random.default_rng(9)
    rows = rng.normal(size=(600, 4))
    target = ((rows[:, 0] > 0) ^ (rows[:, 2] > 0.3)).astype(float)
    forest = quality.grow(rows, target)
    assert ((forest.scores(rows) > 0.5) == target).mean() > 0.95
    assert len(quality.grow(rows[:3], target[:3]).roots) == 0


def test_languages(spark):
    rows = [(i, {"en": "the thing with an", "de": "der schöne und gute", "fr": "le très beau été"}[lang] + f" {i} " * 3, lang)
            for i, lang in enumerate(["en", "de", "fr"] * 60)]
    rows += [(1000, None, "en"), (1001, "", "en"), (1002, "12 34 !", "en"), (1003, "the thing", None), (1003, "the thing", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumns({c: F.lit("clash") for c in ("score", "lettered", "rejected")})
    model = langid.fit(docs)
    assert model.languages == ["de", "en", "fr"]
    got = langid.identify(docs, model).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert all(by[d]["lang_pred"] == "und" and by[d]["rejected"] for d in (1000, 1001, 1002))
    assert np.mean([by[d]["lang_pred"] == lang for d, _, lang in rows[:180]]) > 0.98
    nothing = langid.fit(docs.where("lang is null"))
    assert {r["lang_pred"] for r in langid.identify(docs, nothing).collect()} == {"und"}


# op 8


@pytest.mark.parametrize(
    ("source", "want"),
    [
        (None, ""),
        ("", ""),
        ("plain  text\n here &amp; now", "plain text here & now"),
        ("<p>a<p>b <b>c</b><br>d", "a\n\nb c\nd"),
        ("<ul><li>one<li>two<ol start=3><li>x<li>y</ol></ul>", "- one\n- two\n  3. x\n  4. y"),
        ("<table><tr><th>A<th>Longer<tr><td>1<td>2</table>", "A | Longer\n1 | 2"),
        ("<table><tr><td rowspan=2>r<td>s<tr><td>t</table>", "r | s\n  | t"),
        ("<style>.x, #y{display:none}</style><div class='a x'>no</div><i id=y>no</i><b hidden>no</b><u style='visibility: hidden'>no</u>yes", "yes"),
        ("<script>var a='</p>';</script><title>t</title><!-- c -->ok<template>no</template>", "ok"),
        ("<pre>\n  k  l\n m</pre>", "  k  l\n m"),
        ("<details><summary>S</summary>closed</details><details open><summary>T</summary>open</details>", "S\nT\nopen"),
        ("<h1>x<h2>y</h2>z", "x\n\ny\n\nz"),
        ("a < b <3 &lt;i>", "a < b <3 <i>"),
    ],
)
def test_render(source, want):
    assert html.render(source) == want


def test_render_survives_hostile_markup():
    assert html.render("<div>" * 5000 + "x") == "x"
    assert html.render("<p " * 3000) == ""
    assert html.render("<li>" * 3000 + "y").endswith("y")
    assert "z" in html.render("<table><td>" * 150 + "z")


def test_extract(spark):
    rows = [(1, "<p>a", "u"), (1, "<p>a", "u"), (None, None, "v"), (2, "x" * 300_000, "w")]
    got = html.extract(spark.createDataFrame(rows, "page_id long, html string, text string"))
    assert tuples(got, "page_id", "text", "n_lines") == sorted([(1, "a", 1), (1, "a", 1), (None, "", 0), (2, "x" * 300_000, 1)], key=repr)


# all


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([], "item_id long, text string")
    made = [suffixes.removed_bytes(docs), automaton.removed_words(docs), minhash.near_duplicates(docs), covertree.near_vectors(vectors),
            mixing.mix_sources(docs), html.extract(pages), warc.records(pages), decontam.contaminated(docs, items),
            quality.score(docs, quality.fit(docs, labels)), langid.identify(docs, langid.fit(docs))]
    assert [df.count() for df in made] == [0] * len(made)


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, SF).cache()
        assert after.columns == docs.columns, name
        if name == "near_dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            assert {r["doc_id"] for r in after.collect()} == {d for d, _, _, kept in brute_near(rows) if kept}
        if name == "substring_dedup":
            rows = [(r["doc_id"], r["text"]) for r in before.collect()]
            digests = {r["doc_id"]: hashlib.sha256(" ".join(WORD.findall(r["text"])).encode()).hexdigest() for r in after.collect()}
            assert digests == {d: sha for d, _, _, sha in brute_words(rows)}
        before = after
    mixed = corpus_pipeline.mix(spark, before, SF)
    part = mixing.mix_sources(before).where("taken > 0")
    assert tuples(mixed, "doc_id", "taken") == tuples(part, "doc_id", "taken")


def test_near_dedup_stage_with_repeated_and_null_ids(spark):
    rows = [(d, t, "en", "s", 0) for d, t in awkward_texts()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.near_dedup(spark, docs, SF).collect()
    ids = sorted((r["doc_id"] for r in kept if r["text"] and r["text"].strip()), key=ordered)
    texts = [r["text"] for r in kept if r["text"] and r["text"].strip()]
    assert len(texts) == len(set(texts)) and 1 in ids and 2 not in ids
    assert sum(1 for r in kept if not (r["text"] or "").strip()) == 3


def test_bits_of_the_filter_only_let_more_through(spark, monkeypatch):
    from polyspark.llm import windows

    monkeypatch.setattr(windows, "FILTER_BITS", 64 * 8)
    rows = awkward_texts()
    assert tuples(automaton.removed_words(frame(spark, rows)), "doc_id", "n_words", "n_removed", "kept_sha256") == brute_words(rows)
    assert pa.__version__
