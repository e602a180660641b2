import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).resolve().parents[2])]

import brute  # noqa: E402

import corpus_pipeline as P  # noqa: E402
from tidemark.llm import language  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage of the pipeline gets and gives, as written tables."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in P.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def ids(df):
    return sorted(r.doc_id for r in df.collect())


def test_order_and_columns(stages):
    assert [n for n, _ in P.STAGES] == [
        "language_id",
        "minhash_near_dedup",
        "suffix_array_dedup",
        "benchmark_decontamination",
        "best_fit_packing",
    ]
    assert all(after.columns == before.columns for before, after in stages[:-1])


def test_language_stage_rejects_only_unclear_texts(stages):
    before, after = stages[0]
    judged = language.predict(before, language.fit(before)).collect()
    assert ids(after) == sorted(r.doc_id for r in judged if not r.ambiguous)
    assert after.count() >= 0.98 * before.where("text rlike '[a-z]'").count()


def test_one_of_each_near_duplicate_class_stays(stages):
    before, after = stages[1]
    classes = brute.near_duplicates([(r.doc_id, r.text) for r in before.collect()])
    assert ids(after) == sorted(d for d, c in classes.items() if d == c) and after.count() < before.count()


def test_repeated_bytes_go(stages):
    before, after = stages[2]
    removed = {r[0]: r for r in brute.remove_bytes([(r.doc_id, r.text) for r in before.collect()])}
    old = {r.doc_id: r for r in before.collect()}
    assert ids(before) == ids(after)
    for r in after.collect():
        if removed[r.doc_id][2]:
            assert len(r.text.encode()) <= removed[r.doc_id][1] - removed[r.doc_id][2] and r.n_chars == len(r.text)
        else:
            assert r == old[r.doc_id]


def test_contaminated_documents_go(spark, stages):
    before, after = stages[3]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = brute.decontaminate([(r.doc_id, r.text) for r in before.collect()], items)
    assert ids(after) == sorted(r[0] for r in found if not r[5])


def test_everything_left_is_packed(stages):
    before, after = stages[4]
    rows = after.collect()
    assert {r.doc_id for r in rows} == set(ids(before)) and all(len(r.ids) == r.length for r in rows)
    assert all(r.ids[-1] == 0 for r in {r.doc_id: r for r in sorted(rows, key=lambda r: r.piece)}.values())


def test_run_gives_the_last_stage(spark, stages):
    key = lambda r: (r.doc_id, r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, P.run(spark, SF).collect())) == sorted(map(key, stages[4][1].collect()))


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _block int, class_id string, node long"
PASSAGE = "a passage of many words that several of these documents share with one another, as it has been copied again and again, "


@pytest.fixture(scope="module")
def odd(spark):
    """Missing ids, texts and languages, empty and repeated rows, one id for two texts, and columns of names that the operators use."""
    real = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    rows = [(*r, i, "x", -i) for i, r in enumerate(real)]
    some = [r for r in rows if r[1] and len(r[1]) > 400][:6]
    rows += some[:2] + [(None, *r[1:]) for r in some[2:4]] + [(some[4][0], *some[5][1:])]  # repeated, nameless, and a namesake
    rows += [(9000, None, None, None, None, None, None, None), (9001, "", "en", "s", 0, 1, "", 1), (None, None, None, None, None, 1, "", 1)]
    rows += [(9002 + i, PASSAGE * 2 + some[i][1], None, "s", 1, 1, "", 1) for i in range(3)] + [(9010, "1234 5678 !!", "en", "s", 12, 1, "", 1)]
    return spark.createDataFrame(rows, SCHEMA)


def lines(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("name", [n for n, _ in P.STAGES])
def test_stages_take_empty_tables(spark, name):
    nothing = spark.createDataFrame([], SCHEMA)
    found = dict(P.STAGES)[name](spark, nothing, SF)
    assert found.collect() == [] and (name == "best_fit_packing" or found.columns == nothing.columns)


def test_odd_rows_in_the_language_stage(spark, odd):
    found = lines(P.language_id(spark, odd, SF))
    assert set(found) <= set(lines(odd)) and not [r for r in found if not r[1] or r[0] == 9010]
    assert len([r for r in found if r[0] is None]) == 2  # no id is no reason to go
    assert len(found) >= 0.95 * odd.where("text rlike '[a-z]'").count()


def test_odd_rows_in_the_near_duplicate_stage(spark, odd):
    rows, found = lines(odd), lines(P.minhash_near_dedup(spark, odd, SF))
    classes = brute.near_duplicates([(i, r[1]) for i, r in enumerate(rows) if r[0] is not None])
    least = {}
    for i, c in classes.items():
        least[c] = min(least.get(c, rows[i][0]), rows[i][0])
    expected = [r for i, r in enumerate(rows) if r[0] is None or r[0] == least[classes[i]] or not r[1]]
    assert found == sorted(expected, key=repr)


def test_odd_rows_in_the_suffix_array_stage(spark, odd):
    found = lines(P.suffix_array_dedup(spark, odd, SF))
    rows = lines(odd)
    assert len(found) == len(rows)  # all rows stay, repeated ones too
    removed = brute.remove_bytes([(r[0], r[1]) for r in rows])
    assert sum(r[2] for r in removed) > 1000
    whole = sorted((r[0], len((r[1] or "").encode())) for r in rows if r[0] is not None)
    left = sorted((r[0], len((r[1] or "").encode())) for r in found if r[0] is not None)
    gone = sum(n for _, n in whole) - sum(n for _, n in left)
    assert gone >= sum(r[2] for r in removed if r[0] is not None)
    assert [r for r in found if r[1] is None] == [r for r in rows if r[1] is None]


def test_odd_rows_in_the_decontamination_stage(spark, odd):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    rows, found = lines(odd), lines(P.benchmark_decontamination(spark, odd, SF))
    judged = brute.decontaminate([(i, r[1]) for i, r in enumerate(rows)], items)
    assert found == sorted((rows[j[0]] for j in judged if not j[5]), key=repr)


def test_odd_rows_in_the_packing_stage(spark, odd):
    found = P.best_fit_packing(spark, odd, SF).collect()
    assert sum(r.piece == 0 for r in found) == odd.count()
    places = sorted((r.sequence_id, r.offset, r.length) for r in found)
    for (s, o, n), (s2, o2, _) in zip(places, places[1:], strict=False):
        assert (s == s2 and o + n == o2) or (s != s2 and o2 == 0)
    assert max(r.offset + r.length for r in found) <= 2048
