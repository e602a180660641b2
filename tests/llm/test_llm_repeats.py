import random
import sys
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

sys.path.insert(0, str(Path(__file__).parent))

import brute  # noqa: E402

from tidemark.llm import bytededup, repeats, worddedup  # noqa: E402
from tidemark.llm.fmindex import FMIndex  # noqa: E402
from tidemark.llm.suffixes import suffix_ranks  # noqa: E402

SF = "/root/testdata/sf0.001"


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def both(spark, docs):
    assert rows(bytededup.digest(frame(spark, docs))) == sorted(brute.remove_bytes(docs), key=repr)
    assert rows(worddedup.digest(frame(spark, docs))) == sorted(brute.remove_words(docs), key=repr)


def mixture(seed, many=60):
    """Texts of few words with shared passages, periodic parts, copies, missing values and repeated rows."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "bc", "def", "éß", "x" * rnd.randrange(1, 9)])
    passages = [" ".join(word() for _ in range(rnd.randrange(5, 90))) for _ in range(6)]
    docs = []
    for i in range(many):
        parts = [rnd.choice([word(), rnd.choice(passages), " ".join([word()] * rnd.randrange(60))]) for _ in range(rnd.randrange(8))]
        docs.append((i, rnd.choice([" ", "\n", "  "]).join(parts)))
    docs += [(many, docs[3][1]), (many + 1, docs[4][1] + " end"), (7, docs[7][1]), (None, docs[5][1]), (None, passages[0]), (many + 2, None)]
    return docs + [(many + 3, ""), (many + 4, "q" * 5000), (many + 5, "q" * 49), (many + 6, "w " * 40)]


@given(st.lists(st.integers(1, 3), min_size=1, max_size=40), st.integers(2, 12))
@settings(max_examples=150, deadline=None)
def test_suffix_ranks_and_index(symbols, depth):
    text = np.array(symbols)
    tails = [tuple(symbols[i:]) for i in range(len(symbols))]
    assert suffix_ranks(text).tolist() == [1 + sum(t < x for t in tails) for x in tails]
    short = suffix_ranks(text, depth)
    for x, a in zip(tails, short):
        assert all((b < a) for y, b in zip(tails, short) if y[:depth] < x[:depth])
    index = FMIndex(text)
    pattern = symbols[-depth:]
    low, high = np.array([0]), np.array([index.size])
    for c in pattern[::-1]:
        low, high = index.search(np.array([c]), low, high)
    assert high[0] - low[0] == sum(t[: len(pattern)] == tuple(pattern) for t in tails)


def test_whole_table(spark):
    both(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()])


@pytest.mark.parametrize("seed", range(2))
def test_mixtures(spark, seed):
    both(spark, mixture(seed))


@pytest.mark.parametrize("hot", [0, 3])
def test_hot_anchors_and_small_parts(spark, monkeypatch, hot):
    """Functions that run in the tasks read these at call time from this process's pickled copies."""
    monkeypatch.setattr(repeats, "HOT", hot)
    docs = mixture(5, 30)
    blocks = {}
    for kind, judge, plain in (
        (bytededup.BYTES, bytededup.smallest_ids, brute.remove_bytes),
        (worddedup.WORDS, worddedup.repeated, brute.remove_words),
    ):
        monkeypatch.setattr(repeats, "SHARD_SYMBOLS", 400)
        monkeypatch.setattr(repeats, "SEGMENT", 300)
        got = []
        for _, texts, cover, table in local(docs, kind, judge):
            finish = bytededup._digest if kind.across else worddedup._digest
            got += [tuple(r.values()) for r in finish(table, texts, cover).to_pylist()]
        assert sorted(got, key=repr) == sorted(plain(docs), key=repr)
    assert not blocks


def local(docs, kind, judge, shards=3):
    """The three steps without Spark, so that limits can be set."""
    import pyarrow as pa

    tables = []
    for b in range(shards):
        own = [d for i, d in enumerate(docs) if i % shards == b]
        hashes = [hash(d[1] or "") for d in own]
        columns = [pa.array([b] * len(own), pa.int32()), pa.array([d[0] for d in own], pa.int64()), pa.array([d[1] for d in own])]
        tables.append(pa.table([*columns, pa.array(hashes), pa.array(hashes)], names=["_block", "_id", "_text", "_h1", "_h2"]))

    def by(parts, key, step):
        whole = pa.concat_tables(parts)
        return [step(whole.filter(pa.compute.equal(whole.column(key), k))) for k in range(shards) if k in whole.column(key).to_pylist()]

    of = lambda whole, b: whole.filter(pa.compute.equal(whole.column("_block"), b))
    none = repeats._rows(repeats._HEARD_ARROW, [])
    alive = pa.concat_tables(by([repeats._send_anchors(kind, shards)(t, none) for t in tables], "_shard", repeats._answer_anchors))
    sent = [repeats._send_passages(kind, shards)(t, of(alive, b)) for b, t in enumerate(tables)]
    judged = pa.concat_tables(by(sent, "_shard", repeats._answer_passages(kind, judge)))
    for b, t in enumerate(tables):
        yield b, *repeats.covered(kind, t, of(pa.concat_tables([alive, judged]), b), shards), t


def test_empty_table_and_clashing_columns(spark):
    assert rows(bytededup.digest(frame(spark, []))) == [] == rows(worddedup.digest(frame(spark, [])))
    text = " ".join(f"w{i}" for i in range(60))
    docs = frame(spark, [(1, text), (2, text), (3, None), (4, "é" * 10 + text)])
    wide = docs.selectExpr("doc_id", "text", "7 as _block", "'x' as _k0", "length(text) as n_chars", "array(1) as _spans")
    kept = {r["doc_id"]: r for r in bytededup.without_repeats(wide, "gone").collect()}
    assert [kept[i]["text"] for i in (1, 2, 3, 4)] == [text, "", None, "é" * 10]
    assert [kept[i]["n_chars"] for i in (1, 2, 3, 4)] == [len(text), 0, None, 10]
    assert kept[2]["_block"] == 7 and kept[2]["_k0"] == "x" and len(kept[4]["gone"]) == 1
    words = {r["doc_id"]: r for r in worddedup.without_repeats(wide).collect()}
    assert words[1]["text"] == "" and words[3]["text"] == "" and words[1]["intervals"][0]["last"] == 60


@pytest.mark.parametrize("kind", [bytededup.BYTES, worddedup.WORDS])
def test_passages_do_not_depend_on_the_order_of_a_block(kind, monkeypatch):
    """A block is read again for the last step, and its texts may arrive in another order; numbers of passages must be the same."""
    import pyarrow as pa

    monkeypatch.setattr(repeats, "SEGMENT", 400)
    docs = [(i, t or "") for i, (_, t) in enumerate(mixture(3) + [(0, "long text " * 400 + str(i)) for i in range(3)])]
    heard = repeats._rows(repeats._HEARD_ARROW, [])

    def block(rows_):
        columns = {"_block": pa.array([0] * len(rows_), pa.int32()), "_id": pa.array([i for i, _ in rows_], pa.int64()), "_text": pa.array([t for _, t in rows_])}
        return repeats.Block(pa.table(columns), heard, kind)

    found = []
    for seed in range(4):
        random.Random(seed).shuffle(docs)
        texts = block(docs)
        alive = np.unique(texts.anchors()[0])
        passages = texts.passages(alive, np.arange(len(alive)) % 3 == 0, 5)
        number, _ = passages.numbered()
        found.append(sorted(zip(passages.shard.tolist(), number.tolist(), passages.one.tolist(), passages.windows.tolist(), texts.ids[passages.row].tolist(), strict=True)))
    assert found[0] == found[1] == found[2] == found[3] and len(found[0]) > 100


def test_passages_of_many_shards_are_cut_from_one_array(monkeypatch):
    """A block's work must not grow with the number of shards: symbols of all its passages are read once."""
    docs = mixture(11, 40)
    calls = []
    once = repeats.Block.symbols
    monkeypatch.setattr(repeats.Block, "symbols", lambda self, *a: (calls.append(len(a[0])), once(self, *a))[1])
    for kind, judge, plain in ((bytededup.BYTES, bytededup.smallest_ids, brute.remove_bytes), (worddedup.WORDS, worddedup.repeated, brute.remove_words)):
        calls.clear()
        finish = bytededup._digest if kind.across else worddedup._digest
        got = [tuple(r.values()) for _, texts, cover, table in local(docs, kind, judge, 13) for r in finish(table, texts, cover).to_pylist()]
        assert sorted(got, key=repr) == sorted(plain(docs), key=repr)
        assert 1 < len(calls) <= 13 and sum(calls) > 13


def _letters(rnd, many):
    return "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(many))


def test_what_is_equal_by_chance_is_not_sent():
    """Texts that share stretches of 20 to 30 bytes only: no window of 50 can be repeated, and no shard hears of any, however common the stretches are."""
    rnd = random.Random(4)
    common = [_letters(rnd, n) for n in range(20, 31)]
    docs = [(i, "".join(_letters(rnd, 40) + c for c in rnd.sample(common, 9))) for i in range(40)]
    docs += [(90, docs[3][1][5:75]), (91, docs[7][1][:49]), (92, "x" + docs[7][1][:50])]
    import pyarrow as pa

    columns = {"_block": pa.array([0] * len(docs), pa.int32()), "_id": pa.array([i for i, _ in docs], pa.int64()), "_text": pa.array([t for _, t in docs])}
    none, kind = repeats._rows(repeats._HEARD_ARROW, []), bytededup.BYTES
    of = lambda lo, hi: pa.table({c: x[lo:hi] for c, x in columns.items()})
    heard = lambda t: repeats._answer_anchors(repeats._send_anchors(kind, 1)(t, none))
    assert heard(of(0, 40)).num_rows == 0
    sent = repeats._send_passages(kind, 1)(of(0, 43), heard(of(0, 43)))
    assert sum(np.frombuffer(x, "<u4").sum() for x in sent.column("a").to_pylist()) < 60  # windows of the last three texts and about them
    got = [tuple(r.values()) for _, texts, cover, table in local(docs, kind, bytededup.smallest_ids) for r in bytededup._digest(table, texts, cover).to_pylist()]
    assert sorted(got) == sorted(brute.remove_bytes(docs)) and sum(r[2] for r in got) == 70 + 50


def test_only_passages_that_share_a_key_are_indexed():
    """Copies of one passage are one; a passage whose keys no other has needs no order."""
    rnd = random.Random(5)
    whole = _letters(rnd, 400)
    same = [(i, _letters(rnd, 60) + whole + _letters(rnd, 60)) for i in range(6)]
    indexed = []

    def judge(text, begin, windows, many, ids):
        indexed.append(int(windows.sum()))
        return bytededup.smallest_ids(text, begin, windows, many, ids)

    got = [tuple(r.values()) for _, texts, cover, table in local(same, bytededup.BYTES, judge) for r in bytededup._digest(table, texts, cover).to_pylist()]
    assert sorted(got) == sorted(brute.remove_bytes(same))
    assert 0 < sum(indexed) < 351  # the passages at the ends of the copies, where texts go on in other ways
