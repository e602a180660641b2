import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tidemark.llm import decontamination as D  # noqa: E402

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def check(spark, docs, items):
    got = rows(D.digest(D.contamination(*frames(spark, docs, items))))
    assert got == sorted(brute.decontaminate(docs, items), key=repr)


def test_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    check(spark, docs, items)


@pytest.mark.parametrize("seed", range(3))
def test_random_words(spark, seed):
    rnd = random.Random(seed)
    text = lambda n: " ".join(rnd.choice(["a", "B", "c", "É-x", "10"]) for _ in range(rnd.randrange(n)))
    items = [(i, text(25)) for i in range(8)] + [(8, None), (None, text(14)), (9, "x, y"), (10, "")]
    docs = [(i, text(300)) for i in range(40)] + [(None, "a b"), (7, text(50)), (90, None), (91, ""), (92, "X Y x")]
    check(spark, docs, items)


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    rnd = random.Random(5)
    text = lambda n: " ".join(rnd.choice("abc") for _ in range(rnd.randrange(n)))
    docs, items = [(i, text(200)) for i in range(30)], [(i, text(20)) for i in range(12)]
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    check(spark, docs, items)


def test_empty_tables_and_clashing_columns(spark):
    check(spark, [], [])
    check(spark, [(1, "a b c")], [])
    docs, items = frames(spark, [(1, "a b c")], [(1, "B c")])
    wide = docs.selectExpr("doc_id", "text", "1 as spans", "2 as items", "3 as _bad")
    assert rows(D.digest(D.contamination(wide, items)))[0][2] == 2
    assert D.without_contaminated(wide, items).columns == wide.columns


def test_long_texts_are_cut_without_losing_windows(spark, monkeypatch):
    monkeypatch.setattr(D, "MOST_WORDS", 50)
    rnd = random.Random(6)
    docs = [(1, " ".join(rnd.choice("abcde") for _ in range(3000)))]
    check(spark, docs, [(1, " ".join(docs[0][1].split()[a : a + 14])) for a in (40, 300, 2900)] and [(1, docs[0][1][80:120])])


def test_clean_documents_stay(spark):
    docs, items = frames(spark, [(1, "one two three"), (2, "four five six"), (None, None)], [(1, "two three")])
    assert rows(D.without_contaminated(docs, items).select("doc_id")) == [(2,), (None,)]


@pytest.mark.parametrize("block", [16 << 20, 12])
def test_rows_are_judged_one_by_one(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    docs = [(None, "one two three"), (None, "clean text"), (None, "clean text"), (4, "x one two"), (4, "also clean"), (4, "six five x"), (5, "five six"), (5, "five six")]
    items = [(1, "two three"), (2, "five six"), (3, "one two")]
    documents, benchmark = frames(spark, docs, items)
    wide = documents.selectExpr("*", "named_struct('a', array(doc_id)) as _row", "timestamp'2020-01-01' as _text", "1 as spans")
    clean = D.without_contaminated(wide, benchmark)
    assert clean.dtypes == wide.dtypes
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == [(4, "also clean"), (4, "six five x"), (None, "clean text"), (None, "clean text")]
    assert rows(clean) == rows(wide.where("text like '%clean%' or text = 'six five x'"))
    check(spark, docs, items)
