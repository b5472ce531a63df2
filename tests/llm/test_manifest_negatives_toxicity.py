"""Merkle manifest and hard negatives against brute force; toxicity on held-out labels and by its grammar."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connection
from pyspark.sql import functions as F

from polyspark.llm import merkle, negatives, queries, toxicity

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, source string, lang string, n_chars long, text string"
LAST = (1 << 63) - 1


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", ["op12_merkle", "op13_negatives"])
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, SF, *queries.QUERIES[name]) is None


def clashing(df, names):
    return df.withColumns({c: F.lit("clash") for c in names if c not in df.columns})


# op 12


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([digest("".join(levels[-1][i : i + 16])) for i in range(0, len(levels[-1]), 16)])
    return levels


def proof(levels, i):
    out = []
    for level in levels[:-1]:
        a = i // 16 * 16
        out.append(("".join(level[a:i]), "".join(level[i + 1 : a + 16])))
        i //= 16
    return out


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_manifest(rows):
    groups = defaultdict(list)
    for doc_id, source, lang, n_chars, text in rows:
        head = "".join(map(field, (doc_id, source, lang, n_chars)))
        tampered = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
        now = text.translate(LOWER) if tampered and text is not None else text
        groups[source].append((doc_id is None, doc_id or 0, digest(head + field(text)), doc_id, digest(head + field(now))))
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(groups[s])]) for s in sources}
    top = tree([trees[s][-1][0] for s in sources])
    out = []
    for j, s in enumerate(sources):
        for i, x in enumerate(sorted(groups[s])):
            path, folded = proof(trees[s], i) + proof(top, j), x[4]
            for left, right in path:
                folded = digest(left + folded + right)
            out.append((x[3], s, x[2], trees[s][-1][0], top[-1][0], digest("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def manifest(spark, rows):
    df = clashing(spark.createDataFrame(rows, DOCS), ["_tree", "pos", "digest", "left", "n", "now", "path"])
    divides = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return sorted((tuple(r) for r in merkle.manifest(df, divides).collect()), key=repr)


def made_documents(n, seed, sources):
    rng = random.Random(seed)
    return [(i, rng.choice(sources), rng.choice(["en", None]), rng.choice([5, None]), f"Text {rng.random()} É") for i in range(n)]


@pytest.mark.parametrize(
    "rows",
    [
        made_documents(700, 1, ["hot"] * 8 + ["b", "", None, "é", "Z"]),  # three levels and a short last run
        made_documents(16, 2, ["one"]),
        made_documents(17, 3, ["one"]),
        [(1, "one", "en", 3, "Abc")],
        [(i, f"s{i}", "en", 3, "Abc") for i in range(300)],  # trees of one leaf, two levels of sources
        [(None, None, None, None, None)] * 3 + [(None, "a", None, None, "")] * 20 + [(5, "a", "x", 1, "Same")] * 40 + [(5, "a", "x", 1, "Other")],
        [(1, "long", "en", 1, "Word " * 400_000), (2, "long", "en", 1, "")],
    ],
    ids=["levels", "full run", "one over", "single", "many sources", "nulls and repeats", "very long"],
)
def test_manifest(spark, rows):
    assert manifest(spark, rows) == brute_manifest(rows)


def test_manifest_of_nothing(spark):
    assert manifest(spark, []) == []


def test_manifest_finds_a_changed_row(spark):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(40)]
    got = {r[0]: r[-1] for r in manifest(spark, rows)}
    assert got == {i: zlib.crc32(str(i).encode()) % 5 != 0 for i in range(40)}


# op 13


def brute_negatives(rows):
    use = []
    for at, (vec_id, vector, label) in enumerate(rows):
        if label is None or not vector or any(x is None or not np.isfinite(x) for x in vector):
            continue
        moved = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        use.append((at, vec_id, moved, np.floor(256 * np.array(vector, np.float64)).astype(np.int64)))
    order = lambda x: (-x[0], LAST if x[1] is None else x[1])
    out = []
    for at, vec_id, label, q in use:
        if vec_id is None or vec_id % 50:
            continue
        scores = [(int(q @ p), v, m) for a, v, m, p in use if a != at and len(p) == len(q)]
        for score, positive, _ in sorted((s for s in scores if s[2] == label), key=order)[:5]:
            fit = sorted((s for s in scores if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score), key=order)[:3]
            out += [(vec_id, positive, rank, v, score, s) for rank, (s, v, _) in enumerate(fit, 1)]
    return sorted(out, key=repr)


def mined(spark, rows):
    df = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), ["row", "pack", "block", "dims", "q", "rank", "n"])
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted((tuple(r) for r in negatives.mine(df, moved, F.col("vec_id") % 50 == 0).collect()), key=repr)


def made_vectors(n, dims, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.3, (labels, dims))
    kind = rng.integers(0, labels, n)
    return [(i, (centres[kind[i]] + rng.normal(0.2, 0.2, dims)).tolist(), int(kind[i])) for i in range(n)]


def test_negatives_of_spread_vectors(spark):
    rows = made_vectors(1500, 8, 4)
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_awkward_rows(spark):
    rows = made_vectors(400, 5, 5, labels=3)
    rows += [(None, [0.3] * 5, 1), (None, None, 1), (401, [0.1] * 4 + [None], 1), (402, [float("nan")] * 5, 1), (403, [float("inf")] + [0.0] * 4, 2)]
    rows += [(404, [], 1), (405, None, None), (406, [0.2] * 5, None), (450, [0.2] * 5, None), (350, [0.0] * 5, 0), (500, [-1.0] * 5, 1)]
    rows += [(550, [0.1, 0.2], 1), (551, [0.2, 0.3], 1), (552, [0.1, 0.3], 2)]  # vectors of another length meet only each other
    rows += [(600, [1.0] * 5, 9), (600, [1.0] * 5, 9), (601, [1.0] * 5, 9)]  # an anchor twice: its copy is a positive
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_equal_vectors(spark):
    """Ties by id, in groups that one pack cannot hold; ids are shuffled so that row order does not help."""
    ids = list(range(9000))
    random.Random(6).shuffle(ids)
    rows = [(i, [0.5, 0.5] if i % 3 else [0.4, 0.4], 0 if i % 3 else 1) for i in ids if i % 50 or i < 100]
    got = mined(spark, rows)
    assert {r[0] for r in got} == {50} and got == brute_negatives(rows)


@pytest.mark.parametrize("rows", [[], [(1, [0.5], 1)], [(50, [0.5], 1)], [(50, None, 1)]])
def test_negatives_of_little(spark, rows):
    assert mined(spark, rows) == []


def test_boxes_bound_products():
    rng = np.random.default_rng(7)
    q = rng.integers(-200, 200, (2000, 6)).astype(np.int32)
    pack = negatives.Tree(q, np.arange(2000), rng.integers(0, 3, 2000), np.arange(2000))
    anchors = rng.integers(-200, 200, (20, 6)).astype(np.int64)
    low, high = pack.bounds(anchors)
    products = anchors @ pack.q.T
    for leaf in range(-(-2000 // negatives.LEAF)):
        own = products[:, leaf * negatives.LEAF : (leaf + 1) * negatives.LEAF]
        assert (low[:, leaf] <= own.min(1)).all() and (own.max(1) <= high[:, leaf]).all()
    assert (low[:, -1] <= products.min(1)).all() and (products.max(1) <= high[:, -1]).all()


def test_tree_skips_boxes():
    """Around a far cluster the queue opens only the boxes that can hold the best rows."""
    rng = np.random.default_rng(8)
    q = np.concatenate([rng.integers(0, 10, (3840, 2)), rng.integers(900, 910, (256, 2))]).astype(np.int32)
    pack = negatives.Tree(q, np.arange(4096), np.ones(4096, np.int64), np.arange(4096))
    opened = []

    class Counted(np.ndarray):
        def __matmul__(self, other):
            opened.append(len(self))
            return np.asarray(self) @ other

    pack.q = pack.q.view(Counted)
    low, high = (np.asarray(x) for x in negatives.Tree.bounds(pack, np.array([[1, 1]])))
    best = pack.best(np.array([1, 1]), [False] * len(pack.children), (low[0].tolist(), high[0].tolist()), [(-LAST, LAST)], 3, -1, 1, True)
    assert len(best[0]) == 3 and sum(opened) <= 2 * negatives.LEAF


# op 11


def kinds(text, stems=None):
    """Weight of each clause of a text."""
    t = toxicity.tokens_of(pa.array([text]))
    return toxicity.clause_weights(t, toxicity.lexicon(stems or {}))[1].tolist()


def test_grammar_weighs_clauses():
    base = toxicity.SEED_STRENGTH
    assert kinds("a fine day") == []
    assert kinds("the idiot was there") == [base]
    assert kinds("you idiot") == [1.5 * base]
    assert kinds("he is not an idiot") == [0.4 * base]
    assert kinds("reports claims the mayor is an idiot") == [0.6 * base]
    assert kinds("they kill time") == [1.5 * base]
    assert kinds("kill the process") == []
    assert kinds("i will kill you") == [1.5 * base]
    assert kinds("i will not kill you") == []
    assert kinds("You. Idiot! Moron") == [base, base]
    assert kinds("you one two three four five six idiot") == [base]  # the target is too far away
    assert kinds("IDIOT!! SCUM!!") == [base, base]
    assert kinds("blorfing it", {"blorf": 3.0}) == [3.0]


def test_composition_feeds_outputs():
    both = toxicity.compose(toxicity.negation(), toxicity.reported())
    for symbols in ([1, 4, 1], [5, 4, 1, 6, 1], [4, 6, 1, 5, 2]):
        a = b = c = 0
        for x in symbols:
            first, second = toxicity.negation(), toxicity.reported()
            middle, a = first.out[a, x], first.step[a, x]
            want, b = second.out[b, middle], second.step[b, middle]
            got, c = both.out[c, x], both.step[c, x]
            assert got == want


def test_held_out_toxicity(spark):
    """Accuracy and ranking on labels that taught nothing."""
    sf = "/root/testdata/sf0.1"
    got = queries.op11_toxicity(spark, sf).where("held_out").join(spark.read.parquet(f"{sf}/labels.parquet").where("toxic is not null"), "doc_id").toPandas()
    right = (got["predicted"] == got["toxic"]).mean()
    found = got.loc[got["toxic"] == 1, "predicted"].mean()
    rank = got["score"].rank()
    pos, neg = (got["toxic"] == 1).sum(), (got["toxic"] == 0).sum()
    area = (rank[got["toxic"] == 1].sum() - pos * (pos + 1) / 2) / (pos * neg)
    assert len(got) > 500 and right >= 0.95 and found >= 0.9 and area >= 0.95


def test_toxicity_of_awkward_rows(spark):
    texts = [None, "", "  ", "123 !!", "you idiot", "you idiot", "word " * 300_000 + "you idiot", "“you idiot” ", "É" * 5]
    rows = [(i if i != 3 else None, t, "x", "y") for i, t in enumerate(texts)]
    docs = clashing(spark.createDataFrame(rows, "doc_id long, text string, score string, fold string"), ["toxic", "_toxic", "stem"])
    labels = spark.createDataFrame([(None, 1), (1, None), (4, 1), (4, 0), (0, 0)], "doc_id long, toxic int")
    grammar = toxicity.fit(docs, labels)
    got = {}
    for r in toxicity.score(docs, grammar).collect():
        got[r["doc_id"]] = r["score"]
    assert len(got) == len(rows) and all(0 <= s <= 1 for s in got.values())
    assert got[4] == got[5] and got[0] == got[1] == got[2]
    none = toxicity.fit(docs.where("false"), labels.where("false"))
    assert toxicity.score(docs.where("false"), none).count() == 0
    assert {r["score"] for r in toxicity.score(docs.where("doc_id < 3"), none).collect()} == {0.5}


def test_stems_of_toxic_texts_are_learned():
    import pandas as pd

    rows = [("blorf", 30, 0), ("blo", 30, 9), ("blorfi", 12, 0), ("the", 90, 800), ("rare", 2, 0), ("mixed", 10, 9)]
    got = toxicity.stem_strengths(pd.DataFrame(rows, columns=["stem", "toxic", "clean"]), 100, 900)
    assert set(got) == {"blorf"} and got["blorf"] > 4
