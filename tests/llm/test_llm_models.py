import zlib

import numpy as np

from tidemark.llm import language, quality
from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.01"


def frame(spark, docs):
    return spark.createDataFrame(docs, "doc_id long, text string")


def test_codewords_differ_in_many_bits():
    for n in (2, 3, 4, 6, 9, 30):
        code = language.codewords(n)
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2)[~np.eye(n, dtype=bool)]
        assert len(code) == n and apart.min() >= (1 if n < 3 else code.shape[1] // 4)


def test_a_wrong_bit_is_corrected():
    """One classifier that is always wrong doesn't change the nearest of four codewords of seven bits."""
    code = language.codewords(4)
    for row, word in enumerate(code):
        for bit in range(code.shape[1]):
            margins = 3 * word
            margins[bit] *= -1
            model = language.Model(list("abcd"), code, np.eye(code.shape[1]), np.zeros(code.shape[1]), np.ones(code.shape[1]))
            best, score, unsure = model.decode(margins[None, :])
            assert best[0] == row and not unsure[0] and 0 < score[0] <= 1


def test_language_on_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.op3_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        assert got[d.doc_id].held_out == (zlib.crc32(str(d.doc_id).encode()) % 3 == 1)
    held = [d for d in docs if got[d.doc_id].held_out and d.lang]
    assert sum(got[d.doc_id].lang_pred == d.lang for d in held) >= 0.98 * len(held)


def test_texts_without_letters_are_unknown(spark):
    train = spark.createDataFrame([("x", "abc abd"), ("y", "mno mnp"), (None, "abc"), ("x", None)], "lang string, text string")
    docs = frame(spark, [(1, None), (2, ""), (3, "12 !?"), (4, "abc"), (None, "mno"), (4, "日"), (5, "ab" * 100_000)])
    got = [tuple(r) for r in language.predict(docs, language.fit(train)).orderBy("doc_id", "lang_pred").collect()]
    assert [r[:2] for r in got] == [(None, "y"), (1, "und"), (2, "und"), (3, "und"), (4, "x"), (4, got[5][1]), (5, "x")]
    assert all(0 <= r[2] <= 1 for r in got) and [r[3] for r in got[1:4]] == [True] * 3 and got[5][1] in "xy"
    wide = docs.selectExpr("*", "array(1, 2) as lang_pred", "named_struct('a', 1) as score", "7 as _c0")
    kept = language.recognised(wide, language.fit(train))
    assert kept.columns == wide.columns and {r.doc_id for r in kept.collect()} >= {4, 5, None}
    assert kept.where("doc_id = 5").first()["lang_pred"] == [1, 2]


def test_no_examples_no_model(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert language.fit(empty) is None
    assert [tuple(r) for r in language.predict(frame(spark, [(1, "abc")]), None).collect()] == [(1, "und", 0.0, True)]
    assert language.predict(frame(spark, []), None).collect() == []
    docs, labels = frame(spark, [(1, "abc"), (2, None)]), spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    assert quality.fit(docs, labels) is None
    assert [r.score for r in quality.scores(docs, None).collect()] == [0.5, 0.5]


def test_samples_are_bounded(spark):
    rows = spark.createDataFrame([("x" if i % 2 else "y", f"abc {i}") for i in range(3000)], "lang string, text string")
    seen = []
    train = language.train
    language.train = lambda r, names: seen.append(len(r)) or train(r[:50], names[:50])
    try:
        language.fit(rows, sample=200)
    finally:
        language.train = train
    assert 120 < seen[0] < 280


def test_statistics_by_hand():
    texts = ["Ab cd!! cd!!\nx1", "", "ab"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    got = dict(zip(quality.NAMES, quality.statistics(data, offsets).T))
    assert np.allclose(got["bytes"], np.log1p([15, 0, 2])) and np.allclose(got["words"], np.log1p([4, 0, 1]))
    assert np.allclose(got["upper"], [1 / 7, 0, 0]) and np.allclose(got["bangs"], [4 / 15, 0, 0]) and np.allclose(got["digits"], [1 / 15, 0, 0])
    assert np.allclose(got["distinct"], [3 / 4, 0, 1]) and np.allclose(got["repeated_next"], [1 / 4, 0, 0])
    assert np.allclose(got["marked_words"], [2 / 4, 0, 0]) and np.allclose(got["line_words"], [2, 0, 1])


def test_flat_trees_score_as_walked_ones():
    random = np.random.default_rng(3)
    rows = random.normal(size=(400, 5)).astype(np.float32)
    labels = (rows[:, 0] + rows[:, 1] ** 2 > 0.5).astype(float)
    model = quality.train(rows, labels)

    def walk(row):
        total = model.base
        for f, c, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            for _ in range(quality.DEPTH):
                node = 2 * node + 1 + int(row[f[node]] > c[node])
            total += leaf[node - len(f)]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.score(rows[:50]), [walk(r) for r in rows[:50]])
    assert ((model.score(rows) > 0.5) == labels).mean() > 0.97


def test_quality_on_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.op5_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    held = [x for x in labels if got[x.doc_id].held_out]
    assert held and all(got[x.doc_id].held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in labels)
    assert sum(got[x.doc_id].predicted == x.quality for x in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())


def test_odd_texts_have_scores(spark):
    docs = frame(spark, [(1, None), (1, ""), (None, "a"), (2, "x" * 3_000_000), (3, "\n\n"), (4, "é" * 10)])
    labels = spark.createDataFrame([(1, 0), (2, 1), (2, 1), (9, 1), (3, None)], "doc_id long, quality int")
    scored = quality.scores(docs.selectExpr("*", "1 as score", "2 as label"), quality.fit(docs, labels)).collect()
    assert len(scored) == 6 and all(0 <= r.score <= 1 for r in scored)
    assert quality.scores(frame(spark, []), None).collect() == []


def test_copies_neither_fill_nor_empty_the_sample(spark):
    """Whatever the hash of a text with many copies, it is at most one example, and its language still gets its part."""
    sizes = {}
    train = language.train
    for copied in ("abc", "abd", "xyz xyz", "hello"):
        rows = [("x", copied)] * 3000 + [("x", f"{copied} {i}") for i in range(30)] + [("y", f"mno {i}") for i in range(300)]
        seen = []
        language.train = lambda r, names: seen.append(names) or train(r[:50], names[:50])  # noqa: B023
        try:
            language.fit(spark.createDataFrame(rows, "lang string, text string"), sample=100)
        finally:
            language.train = train
        sizes[copied] = seen[0].count("x"), seen[0].count("y")
    assert all(20 < x <= 31 and 20 < y <= 80 and x + y <= 100 for x, y in sizes.values()), sizes


def test_copies_of_labelled_rows_do_not_fill_the_quality_sample(spark, monkeypatch):
    """A third of all rows has one id, one label and one text; a label may be repeated too."""
    rows = [(1, "again and again")] * 3000 + [(i, f"text {i} " * (i % 7 + 1)) for i in range(2, 400)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400) for _ in range(3)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda rows, labels: seen.append((len(rows), labels.mean())))
    quality.fit(documents, labels, sample=100)
    quality.fit(documents, labels)
    assert 50 < seen[0][0] <= 100 and seen[1][0] == 399 and abs(seen[1][1] - 0.5) < 0.01
