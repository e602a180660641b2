import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import idfiles, packing
from tidemark.llm.arrays import as_binary, buffers
from tidemark.llm.tokens import BYTE_BPE, WORD_BPE, Encoder, vocabulary_path

SF = "/root/testdata/sf0.001"


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def library_ids(name, texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path(name))
    return [e.ids for e in t.encode_batch([x or "" for x in texts], add_special_tokens=False)]


ODD = list("ab é\n\t'12!|ßΣς日 İ.,-_$&<>") + ["  ", "　", "\u0085", "<|endoftext|>", "<|ENDOFTEXT|>", " don't", "'ll", "́x", "The end"]


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_ids_are_the_librarys(name):
    rnd, encoder = random.Random(1), Encoder(vocabulary_path(name))
    for _ in range(40):
        texts = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(70))) for _ in range(40)] + [None, "", " ", "x" * 3000]
        ids, at = encoder.encode(*buffers(as_binary(pa.array(texts))))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library_ids(name, texts)


def test_forgotten_pieces_are_encoded_again(monkeypatch):
    from tidemark.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_PIECES", 3)
    encoder = Encoder(vocabulary_path(BYTE_BPE))
    for texts in (["a b c d", "e f"], ["g a", "b c d e f"]):
        ids, at = encoder.encode(*buffers(as_binary(pa.array(texts))))
        assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library_ids(BYTE_BPE, texts)


@pytest.mark.parametrize("seed", range(4))
def test_packing_plan_is_whole_and_tight(seed):
    random_ = np.random.default_rng(seed)
    capacity = 64
    histogram = {int(n): int(c) for n, c in zip(random_.permutation(np.arange(1, capacity))[: 5 + 15 * seed], random_.integers(1, 400, 60))}
    plan = packing.plan_packing(histogram, capacity, rounds=40)
    length = np.repeat(list(histogram), list(histogram.values())).astype(np.int64)
    rank = np.concatenate([np.arange(c) for c in histogram.values()])
    sequence, offset = plan.place(length, rank)
    order = np.lexsort((offset, sequence))
    s, o, n = sequence[order], offset[order], length[order]
    first = np.append(True, s[1:] != s[:-1])
    assert (o[first] == 0).all() and (o[1:][~first[1:]] == (o + n)[:-1][~first[1:]]).all()
    assert (o + n <= capacity).all() and len(np.unique(s)) == plan.sequences
    assert plan.sequences <= len(_first_fit_decreasing(length, capacity))


def _first_fit_decreasing(lengths, capacity):
    free = []
    for n in sorted(lengths.tolist(), reverse=True):
        for i, f in enumerate(free):
            if f >= n:
                free[i] -= n
                break
        else:
            free.append(capacity - n)
    return free


@pytest.mark.parametrize("times", [1, 10, 1000])
def test_the_program_finds_what_best_fit_misses(times):
    """Best fit puts the longest together and needs 11 sequences where 9 do."""
    histogram = {51: 6 * times, 27: 6 * times, 26: 6 * times, 23: 12 * times}
    lengths, counts = np.array(sorted(histogram)), np.array([histogram[n] for n in sorted(histogram)])
    nothing = np.zeros((0, 4), np.int64), np.zeros(0)
    assert packing._place_all(lengths, counts, 100, np.arange(4), *nothing)[1] == 11 * times
    assert packing.plan_packing(histogram, 100).sequences == 9 * times


@pytest.mark.parametrize("seed", range(3))
def test_solutions_cover_every_length_and_lie_between_the_bounds(seed):
    random_ = np.random.default_rng(seed)
    lengths = np.unique(random_.integers(1, 128, 10 + 40 * seed))
    counts = random_.integers(1, 300, len(lengths)).astype(float)
    solved = packing.fractional_patterns(lengths, counts, 128)
    assert (solved.patterns @ lengths <= 128).all() and (solved.uses >= 0).all()
    assert (solved.uses @ solved.patterns >= counts * (1 - 1e-9)).all()
    assert lengths @ counts / 128 <= solved.least * (1 + 1e-9) <= solved.value * (1 + 1e-9)
    plan = packing.plan_packing({int(n): int(c) for n, c in zip(lengths, counts, strict=True)}, 128)
    assert abs(solved.value - solved.uses.sum()) < 1e-6 * solved.value and solved.least <= plan.sequences + 1e-6
    assert solved.value <= 1.2 * solved.least


def test_linear_program_reaches_the_bound():
    """Lengths that only fill sequences in pairs: the fractional solution finds the pairs."""
    histogram = {40: 90, 24: 90, 33: 50, 31: 50}
    assert packing.plan_packing(histogram, 64).sequences == 140


def check_packing(spark, docs, capacity):
    got = packing.pack(frame(spark, docs), capacity).collect()
    wanted = []
    for (d, _), ids in zip(docs, library_ids(WORD_BPE, [t for _, t in docs])):
        ids = [*ids, 0]
        for k, a in enumerate(range(0, len(ids), capacity)):
            piece = ids[a : a + capacity]
            wanted.append((d, k, a, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes()), piece))
    assert sorted([tuple(r)[:6] for r in got], key=repr) == sorted(wanted, key=repr)
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_packing(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(80).collect()]
    check_packing(spark, docs + [(None, "a"), (1, None), (1, ""), (1, "")], 128)
    assert packing.pack(frame(spark, [])).collect() == []
    wide = frame(spark, [(1, "a b")]).selectExpr("*", "1 as piece", "2 as _rank", "3 as length")
    assert packing.pack(wide, keep_ids=False).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def test_full_pieces_stand_alone(spark):
    check_packing(spark, [(i, "word " * 300) for i in range(6)], 50)


@pytest.mark.parametrize("values", [[], [7], [3] * 2000, list(range(5000)), [1, 2**32 - 1] * 700, [5] * 1023 + [2**31]])
def test_file_round_trip(values):
    ids = np.array(values, np.uint32)
    counts = np.array([len(ids) // 3, len(ids) - len(ids) // 3])
    file = idfiles.IdFile(idfiles.encode_file(ids, counts))
    assert file.read(0, len(ids)).tolist() == values and file.counts.tolist() == counts.tolist()
    assert file.read(len(ids) // 2, len(ids)).tolist() == values[len(ids) // 2 :]


def test_outliers_are_exceptions():
    ids = np.random.default_rng(1).integers(0, 200, 100_000).astype(np.uint32)
    ids[::300] = 49_000
    assert len(idfiles.encode_file(ids, np.array([len(ids)]))) < 1.15 * len(ids)


def test_id_files(spark, monkeypatch):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    docs += [(None, "no id"), (3, None), (3, ""), (10**12, "last")]
    got = sorted(idfiles.ids_of(frame(spark, docs)).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in docs), key=lambda d: (d is not None, d))
    total, wanted = 0, {}
    for (d, _), ids in zip(docs, library_ids(BYTE_BPE, [t for _, t in docs])):
        whole = np.array([*ids, 0], "<u4")
        wanted.setdefault(d, []).append((len(whole), zlib.crc32(whole.tobytes())))
    for r in got:
        assert r.start == total
        total += r.n_tokens
        wanted[r.doc_id].remove((r.n_tokens, r.ids_crc32))
    assert idfiles.ids_of(frame(spark, [])).collect() == []


def test_several_files_and_a_leftover(spark, tmp_path):
    """Files that no listing names, as a lost task leaves them, are not read."""
    docs = [(i, "some words " * (i % 7)) for i in range(200)]
    listing = idfiles.write_ids(frame(spark, docs), str(tmp_path / "ids"), file_ids=100)
    assert listing.count() >= 4
    (tmp_path / "ids" / "left.ids").write_bytes(b"broken")
    assert idfiles.read_back(spark, str(tmp_path / "ids"), listing).count() == 200


class Counted:
    """A tokenizer that notes how many texts it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **options)


@pytest.mark.parametrize("name", [WORD_BPE, BYTE_BPE])
def test_new_words_go_to_the_library_together(name, monkeypatch):
    """Words of a vocabulary that marks their ends are encoded many at once; odd ones give the same ids, in whatever company they come."""
    import random

    import numpy as np

    from tidemark.llm import tokens

    monkeypatch.setattr(tokens, "TOGETHER", 50)
    rnd = random.Random(8)
    odd = ["İstanbul", "a×b", "é", "ÉÈ", "Ÿ", "ﬁn", "naïve", "ét", "ß", "Ǆ", "ŉ", "a÷", "ſt", "x y", "ĳs", "Ω", "ʰa", "ɥ", "don't", "a1b", "1", "<|endoftext|>"]
    words = ["".join(rnd.choice("abcdefghijéèçlmnoÉst") for _ in range(rnd.randrange(1, 12))) for _ in range(1500)]
    texts = [" ".join(rnd.sample(words, 200) + rnd.sample(odd, 12)) for _ in range(8)] + [" " + w for w in odd] + ["", " ", "a  b", " a\n b"]
    raw = [t.encode() for t in texts]
    ours = tokens.Encoder(tokens.vocabulary_path(name))
    plain = ours.tokenizer
    ours.tokenizer = Counted(plain)
    for _ in range(2):  # once new, once known
        ids, edges = ours.encode(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
        for i, t in enumerate(texts):
            assert ids[edges[i] : edges[i + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t
    if name == WORD_BPE:
        assert ours.tokenizer.texts < 400


def test_pieces_with_ids_are_neither_sorted_nor_sent_to_python(spark):
    """Only lengths and ranks are needed to place a piece."""
    docs = spark.createDataFrame([(i, "word " * (i * 40)) for i in range(40)], "doc_id long, text string")
    packed = packing.pack(docs)
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "MapInArrow" not in plan
    assert sum(r.length for r in packed.collect()) == sum(len(r.ids) for r in packed.collect())
