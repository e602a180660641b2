import io
import random

import pandas as pd
import pytest
from conftest import rows

from tidemark.sources.delimited import read_text_table, text_table_of_files
from tidemark.sources.files import read_files

CELLS = ["x", '5" pipe', "", '"q"', '"two\nlines"', '"a ""b""\n\nc\td"', "plain text", '"\n"', '""', '"tab\there"', '"""\n"""']


@pytest.fixture
def small_splits(spark):
    """Files are cut into many splits."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def written(tmp_path, *texts):
    for i, text in enumerate(texts):
        (tmp_path / f"f{i}.tsv").write_bytes(text.encode())
    return str(tmp_path)


def by_pandas(text):
    table = pd.read_csv(io.StringIO(text, newline=""), sep="\t", dtype=str, keep_default_na=False)
    return [tuple(x or None for x in r) for r in table.itertuples(index=False)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_cells_with_line_feeds_in_many_splits(spark, tmp_path, small_splits, end):
    some, texts = random.Random(1), []
    for _ in range(2):
        lines = ["a\tb\tc", *("\t".join([f"k{i}", some.choice(CELLS), some.choice(CELLS)]) for i in range(150))]
        texts.append(end.join(lines) + end * some.randrange(2))
    path, expected = written(tmp_path, *texts), sorted((r for t in texts for r in by_pandas(t)), key=repr)
    assert rows(read_text_table(spark, path)) == expected
    assert rows(read_text_table(spark, path, quoted_breaks=True)) == expected
    assert rows(text_table_of_files(read_files(spark, path))) == expected


def test_one_cell_over_many_splits_and_a_quoted_header(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(300))
    text = f'a\t"b ""c"""\n1\t"{long}"\n2\ty\n3\t"z\n"\n'
    path = written(tmp_path, text)
    for table in (read_text_table(spark, path), text_table_of_files(read_files(spark, path))):
        assert table.columns == ["a", 'b "c"']
        assert rows(table) == [("1", long), ("2", "y"), ("3", "z\n")]


@pytest.mark.parametrize("text", ['a\tb\n1\t"x\n2\ty\n', 'a\tb\n1\tx\n2\t"y', 'a\tb\n1\t"x\n' + "2\ty\n" * 200])
def test_a_quote_that_is_never_closed_fails(spark, tmp_path, small_splits, text):
    path = written(tmp_path, text)
    for read in (lambda: read_text_table(spark, path), lambda: text_table_of_files(read_files(spark, path))):
        with pytest.raises(Exception, match="a quote is never closed"):
            read().collect()


def test_too_many_cells_and_other_headers_fail(spark, tmp_path, failing):
    path = written(tmp_path, 'a\tb\n1\t"x\ny"\t3\n')
    assert "too many cells" in failing(read_text_table(spark, path))
    assert "too many cells" in failing(text_table_of_files(read_files(spark, path)))
    path = written(tmp_path, 'a\tb\n1\t"x\ny"\n', "a\tc\n1\t2\n")
    assert "another header" in failing(read_text_table(spark, path))


def test_a_text_without_such_cells_splits_as_before(spark, tmp_path):
    path = written(tmp_path, 'a\tb\n1\t"x"\n2\t5" pipe\n')
    table = read_text_table(spark, path)
    assert rows(table) == [("1", "x"), ("2", '5" pipe')]
    assert "FileScan csv" in table._jdf.queryExecution().executedPlan().toString()
