import random
import re

import numpy as np
import pytest
from conftest import rows

from tidemark.llm import jaccard
from tidemark.llm.jaccard import jaccard_components, ngram_set

SCHEMA = "doc_id long, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))) if words else frozenset()


def plain(documents):
    """All pairs of different sets; rows without doc_id have no component."""
    sets = [(d, shingles(t)) for d, t in documents]
    least = {}
    for d, s in sets:
        if d is not None and s:
            least[s] = min(d, least.get(s, d))
    part = {s: {s} for s in least}
    own = sorted(least, key=len)
    for i, a in enumerate(own):
        for b in own[i + 1 :]:
            if 10 * len(a) < 9 * len(b):
                break
            common = len(a & b)
            if 100 * common >= 90 * (len(a) + len(b) - common) and part[a] is not part[b]:
                part[a] |= part[b]
                for s in part[b]:
                    part[s] = part[a]
    smallest = {s: min(least[x] for x in p) for s, p in part.items()}
    return sorted(((d, len(s), smallest.get(s, d) if d is not None else None) for d, s in sets), key=repr)


def found(spark, documents):
    return rows(jaccard_components(spark.createDataFrame(documents, SCHEMA)))


def text(some, n, vocabulary=5000):
    return " ".join(f"w{some.randrange(vocabulary)}" for _ in range(n))


def edited(some, words, edits):
    words = list(words)
    for _ in range(edits):
        words[some.randrange(len(words))] = f"e{some.randrange(30)}"
    return " ".join(words)


def test_families_of_edited_copies(spark):
    some = random.Random(3)
    documents, d = [], 0
    for _ in range(12):
        base = text(some, some.choice([10, 29, 31, 60, 150, 400])).split()
        for _ in range(60):
            words = base if some.random() < 0.7 else base[: some.randrange(1, len(base) + 1)]
            documents.append((d := d + 1, edited(some, words, some.choice([0, 0, 1, 1, 2, 3, 5]))))
    some.shuffle(documents)
    expected = plain(documents)
    assert found(spark, documents) == expected
    assert len({c for _, _, c in expected}) > 50


def test_chains_are_followed_from_part_to_part(spark):
    # each text differs a little from the one before, so the ends have nothing to do with each other
    words = [f"c{i}" for i in range(100)]
    documents = []
    for d in range(80):
        documents.append((1000 - d, " ".join(words)))
        words[d : d + 1] = [f"x{d}"]
    expected = plain(documents)
    assert found(spark, documents) == expected
    assert {c for _, _, c in expected} == {921}


def test_the_limit_itself_links(spark):
    a = [f"a{i}" for i in range(192)]  # 190 n-grams; without the last ten words 180, and 180 / 190 is enough, 171 / 190 just is
    cut = {k: " ".join(a[: 2 + k]) for k in (190, 171, 170)}
    documents = [(1, cut[190]), (2, cut[171]), (3, " ".join(f"b{i}" for i in range(50)))]
    assert found(spark, documents) == plain(documents) == [(1, 190, 1), (2, 171, 1), (3, 48, 3)]
    documents = [(1, cut[190]), (2, cut[170])]
    assert found(spark, documents) == plain(documents) == [(1, 190, 1), (2, 170, 2)]


def test_odd_rows(spark):
    some = random.Random(4)
    documents = [(1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (7, "ONE\x0btwo "), (8, "É é"), (9, "é é")]
    documents += [(None, "lost words here and there"), (10, "lost words here and there"), (None, None), (11, "a b c"), (11, "d e f"), (12, "A B C"), (9, "d e f")]
    long = text(some, 30_000)
    documents += [(20, long), (21, long + " end"), (22, "y" * 50_000 + " z " * 3), (23, "Y" * 50_000 + " z " * 3), (24, "y" * 50_001 + " z z z")]
    documents += [(30 + i, "same text for all of them") for i in range(200)]
    assert found(spark, documents) == plain(documents)


def test_cutting_a_text_changes_nothing(monkeypatch):
    some = random.Random(5)
    raw = "".join(some.choices("ab \né Z", k=5000)).encode()
    whole = ngram_set(np.frombuffer(raw, np.uint8))
    for size in (1, 7, 100):
        monkeypatch.setattr(jaccard, "PIECE", size)
        assert (ngram_set(np.frombuffer(raw, np.uint8)) == whole).all()
    assert len(whole) == len(shingles(raw.decode()))


def test_empty_table_and_other_columns(spark):
    assert found(spark, []) == []
    extra = spark.createDataFrame([(1, "a b c", 5, 6), (2, "A b c", 5, 6)], SCHEMA + ", n long, k1 long")
    assert rows(jaccard_components(extra)) == [(1, 1, 1), (2, 1, 1)]


@pytest.mark.parametrize("sf", ["sf0.01"])
def test_given_documents(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    assert rows(jaccard_components(df)) == plain([tuple(r) for r in df.collect()])
