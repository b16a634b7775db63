"""Nearest vectors, spelling variants and importance resampling against brute
force, with the odd cases every operator must survive."""
import math
import random
import zlib

import brute
import numpy as np
import pytest

SF = "/root/testdata/sf0.001"
DOCS = ("doc_id long, text string, id long, word string, key string, n long, row long, score double, rank string, "
        "rest string, form string, weight int")


def docs_df(spark, docs):
    """Documents with extra columns whose names operators use themselves."""
    return spark.createDataFrame([(i, t, 7, "w", "k", 1, 2, 0.5, "r", "x", "f", 3) for i, t in docs], DOCS)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# ------------------------------------------------------------------ 11 nearest vectors
VECTORS = "vec_id long, embedding array<float>, id long, row long, v string, shard int, score double, bound double"


def vectors_df(spark, vectors):
    return spark.createDataFrame([(i, v, 1, 2, "v", 0, 0.5, 1.0) for i, v in vectors], VECTORS)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    base = rng.normal(size=(600, 6)).astype(np.float32)
    base[100:220] = base[100]                                     # one vector many times
    base[300:330] = base[300] + rng.normal(size=(30, 6)).astype(np.float32) * np.float32(1e-3)
    out = [(i, v) for i, v in enumerate(base.tolist())]
    out += [(100, base[7].tolist()), (100, base[100].tolist()), (0, base[0].tolist()), (7, base[3].tolist())]   # shared ids
    out += [(1000, None), (1100, [0.0] * 6), (1200, []), (1300, [1.0, None]), (1400, [math.nan] * 6),
            (1500, [math.inf] + [0.0] * 5), (None, base[0].tolist()), (1600, [1.0, 2.0]), (1700, [1.0] * 9)]
    return out


def near(a, b):
    a, b = (sorted(x, key=lambda r: (r[0], r[1], r[2])) for x in (a, b))
    return len(a) == len(b) and all(x[:3] == y[:3] and x[3] == pytest.approx(y[3], rel=1e-12, abs=1e-12) for x, y in zip(a, b))


def test_factor_one_is_exact(spark, vectors, monkeypatch):
    from pyspark.sql import functions as F

    from lakeloom.llm import vptree
    monkeypatch.setattr(vptree, "SHARD", 150)
    monkeypatch.setattr(vptree, "QUERIES", 3)
    found = vptree.nearest(vptree.usable_vectors(vectors_df(spark, vectors), "vec_id", "embedding"), F.col("id") % 100 == 0, 10, 1.0)
    f32 = [(i, v if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, v in vectors]
    assert near([tuple(r) for r in found.collect()], brute.nearest(f32))
    assert found.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "double")]


def test_search_few_candidates_and_empty(spark):
    from pyspark.sql import functions as F

    from lakeloom.llm.vptree import nearest, usable_vectors
    two = usable_vectors(vectors_df(spark, [(0, [1.0, 0.0]), (5, [0.0, 1.0])]), "vec_id", "embedding")
    assert [tuple(r) for r in nearest(two, F.col("id") % 100 == 0).collect()] == [(0, 1, 5, pytest.approx(math.sqrt(2)))]
    for rows in ([], [(0, None)], [(1, [1.0])]):
        assert nearest(usable_vectors(vectors_df(spark, rows), "vec_id", "embedding"), F.col("id") % 100 == 0).count() == 0


def test_tree_skips_and_relaxation():
    from lakeloom.llm.vptree import Search, Tree
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.normal(size=(500, 3)) for c in rng.normal(size=(8, 3)) * 30])    # pruning can work here
    t = Tree(x)
    ids, seen = t.order.copy(), {}
    want = np.argsort(((x[:50, None] - x[None]) ** 2).sum(2), axis=1, kind="stable")[:, :6]
    for factor in (1.0, 3.0, 1e9):
        s = Search(x[:50], np.arange(50), np.full(50, np.inf), 5, factor)
        s.tree(t, x[t.order], ids, ids)
        seen[factor] = s.seen
        if factor == 1.0:
            assert all(set(s.id[i]) == set(want[i]) - {i} for i in range(50))
    assert seen[1e9] < seen[3.0] < seen[1.0] < 50 * len(x) / 3


def test_query_recall(spark):
    from lakeloom.llm.queries import REGISTRY
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
        x = np.array([r.embedding for r in rows], np.float64)
        ids = np.array([r.vec_id for r in rows])
        found, true, hit = {}, 0, 0
        for q, rank, v, score in REGISTRY["op11_vptree"](spark, sf).collect():
            found.setdefault(q, {})[v] = score
        for i in np.flatnonzero(ids % 100 == 0):
            d = np.sqrt(((x - x[i]) ** 2).sum(1))
            d[i] = np.inf
            best = ids[np.lexsort((ids, d))[:10]]
            assert len(found[ids[i]]) == 10
            assert all(s == pytest.approx(d[np.flatnonzero(ids == v)].min(), rel=1e-12) for v, s in found[ids[i]].items())
            true, hit = true + 10, hit + len(set(best) & set(found[ids[i]]))
        assert hit / true >= 0.95


# ------------------------------------------------------------------ 12 spelling variants
def spelled(rng, n):
    """Words and edits of them, many with one ending."""
    out = []
    for _ in range(n):
        w = "".join(rng.choice("abcdeé") for _ in range(rng.randint(3, 6))) + rng.choice(("tion", "tions", "", "xx"))
        out += [w] * rng.randint(1, 9)
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(w))
            out += [rng.choice((w[:i] + w[i + 1:], w[:i] + "z" + w[i:], w[:i] + "y" + w[i + 1:]))] * rng.randint(1, 4)
    rng.shuffle(out)
    return out


def test_spelling_of_documents(spark):
    from lakeloom.llm.spelling import spelling_variants
    rng = random.Random(8)
    words = spelled(rng, 500)
    docs = [(i, rng.choice((" ", "-", "1 ", "\n")).join(words[a:a + 40])) for i, a in enumerate(range(0, len(words), 40))]
    docs += [(900, None), (901, ""), (902, "×÷×÷× ×÷×÷× ×÷×÷× ×÷×÷×"), (None, docs[0][1]), (3, docs[3][1]), (3, docs[3][1]),
             (903, "ÉTUDES Études éTUDES études ÉTUDES ÉTUDES"), (904, ("a" * 3000 + " ") * 3 + ("a" * 2999 + " ") * 9),
             (905, "漢字abcde漢字abcde abcdeİabcde")]
    want = brute.spelling(brute.spelling_words(docs))
    assert got(spelling_variants(docs_df(spark, docs))) == sorted(want, key=str)
    assert any(zlib.crc32(f"{i}:{w}".encode()) % 97 == 0 for i, t in docs if t for w in t.lower().split())
    assert any(r[1] for r in want) and any(r[1] != r[2] and r[1] for r in want)


def test_spelling_hot_chunks_lose_nothing(spark):
    """Every level of refinement gives the same pairs as the plain join."""
    from lakeloom.llm.spelling import spelling_groups
    rng = random.Random(9)
    words = {w: rng.randint(1, 50) for w in spelled(rng, 400)} | {"a": 3, "b": 9, "ab": 40, "": 1, "a<b": 4, "a>b": 9, "a<<b": 20}
    df = spark.createDataFrame([(w, n) for w, n in words.items()], "word string, n long")
    want = sorted(brute.spelling(words), key=str)
    for most in (0, 3, 1 << 40):
        assert got(spelling_groups(df, most=most)) == want


def test_spelling_chain_ties_and_empty(spark):
    from lakeloom.llm.spelling import spelling_groups, spelling_variants
    df = spark.createDataFrame([("aaaaa", 1), ("aaaab", 2), ("aaabb", 4), ("aabbb", 8), ("abbbb", 16), ("bbbbb", 32),
                                ("aaaac", 2)], "word string, n long")
    by = {r.word: r for r in spelling_groups(df).collect()}
    assert by["aaaaa"].form == "aaaab" and by["aaaaa"].root == "bbbbb" and by["bbbbb"].root == "bbbbb"
    assert by["aaaac"].form is None and by["aaaac"].n_near == 2
    assert spelling_variants(docs_df(spark, [])).count() == 0
    assert spelling_variants(docs_df(spark, [(1, None)])).count() == 0


# ------------------------------------------------------------------ 13 importance resampling
@pytest.fixture(scope="module")
def prose():
    rng = random.Random(4)
    words = ["The", "of", "AND", "ça", "x1", "lorem", "ipsum", "né", "w" * 70, "é" * 200, "p4ss"]
    docs = [(i, " ".join(rng.choice(words) + rng.choice(("", ".", "_", "!")) for _ in range(rng.choice((1, 2, 19, 20, 40))))) for i in range(300)]
    docs += [(400, None), (401, ""), (402, " .,!"), (403, "one"), (404, "one two"), (405, "a b c " * 5000), (None, "a b c d " * 9),
             (406, "w" * 9000 + " x " + "y" * 5000 + " z"), (7, docs[7][1]), (7, docs[7][1]), (8, docs[9][1])]
    return docs


def test_resampling(spark, prose):
    from lakeloom.llm.resample import resample
    target = ["Lorem ipsum of the " * 20, None, "", "ça né"]
    items = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    for percent in (5, 50, 100):
        found = resample(docs_df(spark, prose), items, percent=percent)
        want = brute.resample(prose, target, percent)
        assert got(found) == sorted(want, key=str)
    assert found.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]


def test_resampling_ties_empty_and_no_target(spark):
    from lakeloom.llm.resample import resample
    none = spark.createDataFrame([], "item_id long, text string")
    same = [(1, "a b c d e " * 6)] * 50 + [(2, "a b c d e " * 6)]
    found = resample(docs_df(spark, same), none, percent=50)
    assert got(found) == sorted(brute.resample(same, [], 50), key=str)
    assert sorted(r[4] for r in found.collect() if r[4]) == list(range(1, 26))
    assert resample(docs_df(spark, []), none).count() == 0
    assert resample(docs_df(spark, [(1, "few words")]), none).first()["rank"] is None


def test_bracket_widens_until_it_holds_the_cutoff(spark):
    from lakeloom.llm.resample import bracket
    df = spark.range(10_000).selectExpr("CASE WHEN id % 3 = 0 THEN 5L ELSE id END AS score")
    scores = sorted((r.score for r in df.collect()), reverse=True)
    for n in (1, 500, 3000, 6700, 9999, 10_000):
        low, high, above = bracket(df, n, 10_000, margin=1e-6)
        assert low <= scores[n - 1] <= high and above == sum(s > high for s in scores) < n


def test_joined_crcs():
    from lakeloom.llm.resample import features
    rng = random.Random(2)
    texts = [" ".join("".join(rng.choice("abé9") for _ in range(rng.choice((1, 3, 63, 64, 65, 700)))) for _ in range(rng.randint(0, 9))) for _ in range(50)]
    per, of, bucket = features([t.encode() for t in texts] + [None])
    want = []
    for i, t in enumerate(texts):
        w = t.split()
        assert per[i] == len(w)
        want += [(i, zlib.crc32(" ".join(w[a:a + n]).encode()) % 10_000) for n in (1, 2, 3) for a in range(len(w) - n + 1)]
    assert sorted(zip(of.tolist(), bucket.tolist())) == sorted(want)


def test_queries_match_brute_force(spark):
    from lakeloom.llm.queries import REGISTRY
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert got(REGISTRY["op13_resampling"](spark, SF)) == sorted(brute.resample(docs, items), key=str)
    words = brute.spelling_words(docs)
    found = got(REGISTRY["op12_spelling"](spark, SF))
    assert [r[0] for r in found] == sorted(words, key=lambda w: str((w,))) and all(r[3] == words[r[0]] for r in found)
    some = {r[0]: r for r in found}
    for w in sorted(words)[::40]:
        near = [v for v in words if abs(len(v) - len(w)) < 2 and brute.one_edit(w, v)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        assert some[w][4] == len(near)
        assert some[w][1] == (best if best and words[best] >= 2 * words[w] else None)
