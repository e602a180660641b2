import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tidemark.llm import neardup as N  # noqa: E402

SF = "/root/testdata/sf0.001"


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def classes(spark, docs, **how):
    return {r.doc_id: r.class_id for r in N.near_duplicates(frame(spark, docs), **how).collect()}


def test_signatures_agree_as_often_as_sets_overlap():
    far = []
    for seed in range(12):
        rng = np.random.default_rng(seed)
        hashes = rng.integers(0, 2**63, 200, dtype=np.uint64)
        a = rng.random(200) * 4 + 0.01
        b = a * (rng.random(200) < 0.8) + 0.2 * rng.random(200)
        signed = N.dart_minhash(np.tile(hashes, 2), np.concatenate([a, b]), np.repeat([0, 1], 200), 2, 1024)
        similar = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        far.append(((signed[0] == signed[1]).mean() - similar) / np.sqrt(similar * (1 - similar) / 1024))
    assert abs(np.mean(far)) < 1 and np.max(np.abs(far)) < 4


def test_signature_of_a_set_does_not_depend_on_its_company():
    hashes = np.arange(1, 60, dtype=np.uint64) * np.uint64(977)
    alone = N.dart_minhash(hashes, np.ones(59), np.zeros(59, int), 1)
    small = N.dart_minhash(np.append(hashes, hashes[:1]), np.append(np.ones(59), 0.01), np.append(np.zeros(59, int), 1), 3)
    assert (alone[0] == small[0]).all() and (small[2] == small[2].max()).all()


def test_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert classes(spark, docs) == brute.near_duplicates(docs)


def chain(seed, many, edits):
    """Texts of which each differs from the one before by some words, so the ends of the row are unlike."""
    rnd = random.Random(seed)
    words, out = [f"w{rnd.randrange(10**6)}" for _ in range(120)], []
    for _ in range(many):
        out.append(" ".join(words))
        for _ in range(edits):
            words[rnd.randrange(len(words))] = f"v{rnd.randrange(10**6)}"
    rnd.shuffle(out)
    return out


def test_chains_groups_and_lone_texts(spark):
    texts = chain(1, 30, 1) + chain(2, 30, 2) + chain(3, 30, 4) + ["one two"] * 5 + ["One, two!", "one two three", "five words make one shingle"]
    docs = list(enumerate(texts, 5))
    assert classes(spark, docs) == brute.near_duplicates(docs)


def test_odd_rows(spark):
    long = " ".join(f"x{i}" for i in range(50_000))
    docs = [(1, None), (2, ""), (3, "!?"), (4, "!?"), (None, "a b"), (None, "a b"), (6, "a b"), (7, "A, b"), (7, "A, b"), (8, long), (9, long + " y")]
    got = sorted((tuple(r) for r in N.near_duplicates(frame(spark, docs).selectExpr("*", "1 as class_id", "2 as h")).collect()), key=repr)
    assert got == sorted([(1, 1, 1), (2, 2, 2), (3, 3, 3), (4, 4, 4), (None,) * 3, (None,) * 3, (6, 6, 6), (7, 6, 6), (7, 6, 6), (8, 8, 8), (9, 8, 9)], key=repr)
    assert N.near_duplicates(frame(spark, [])).collect() == []
    left = N.one_of_each(frame(spark, docs).selectExpr("*", "1 as _gone", "2 as class_id"))
    assert left.columns == ["doc_id", "text", "_gone", "class_id"]
    assert sorted((r.doc_id for r in left.collect()), key=repr) == sorted([1, 2, 3, 4, None, None, 6, 8], key=repr)


def test_texts_that_share_an_id_are_judged_one_by_one(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    docs = [(3, a), (5, a + " y"), (5, b), (5, b), (6, b + " z"), (7, c), (7, a + " w"), (None, a), (None, "u v w"), (8, c + " c"), (2, c + " d")]
    got = [tuple(r) for r in N.near_duplicates(frame(spark, docs)).collect()]
    wanted = [(3, 3, 3), (5, 3, 5), (5, 5, 5), (5, 5, 5), (6, 5, 6), (7, 2, 7), (7, 3, 7), (None,) * 3, (None,) * 3, (8, 2, 8), (2, 2, 2)]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    left = sorted((tuple(r) for r in N.one_of_each(frame(spark, docs)).collect()), key=repr)
    assert left == sorted([(3, a), (5, b), (5, b), (None, a), (None, "u v w"), (2, c + " d")], key=repr)


def test_weights_count_repeats(spark):
    a, b = "u v w x y " * 3, "u v w x y " * 30
    assert classes(spark, [(1, a), (2, b)]) == {1: 1, 2: 1}
    assert classes(spark, [(1, a), (2, b)], counts=True) == {1: 1, 2: 2}


def test_components_of_a_long_path(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 90), (90, 95), (7, 7)]
    random.Random(1).shuffle(path)
    got = {r.node: r.least for r in N.components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 90: 90, 95: 90, 100: 90}


def edited(words, many, rnd):
    words = list(words)
    for at in rnd.sample(range(len(words)), many):
        words[at] = f"e{rnd.randrange(10**9)}"
    return " ".join(words)


def test_edited_copies_of_one_text(spark):
    """Most copies are like the original, which has neither the smallest id nor the largest, but not like each other; some are like none."""
    rnd = random.Random(9)
    original = [f"w{i}" for i in range(150)]
    texts = [edited(original, n, rnd) for n in (1, 2, 3, 3, 4, 5, 6, 8) for _ in range(12)]
    docs = list(enumerate([*texts[:50], " ".join(original), *texts[50:]], 1))
    wanted = brute.near_duplicates(docs)
    assert len(set(wanted.values())) > 5
    assert classes(spark, docs) == wanted


def test_pairs_that_cannot_be_similar_are_not_made(spark):
    """Copies with too many edits of their own meet nobody but the pivot; those that share their edits do."""
    rnd = random.Random(4)
    original = [f"w{i}" for i in range(200)]
    twins = [edited(original, 8, rnd) for _ in range(3)]
    texts = [" ".join(original), *(edited(original, 8, rnd) for _ in range(40)), *twins, *(t.replace("w5 ", "x5 ") for t in twins)]
    docs = list(enumerate(texts))
    assert classes(spark, docs) == brute.near_duplicates(docs)
