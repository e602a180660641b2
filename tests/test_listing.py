import datetime

import pytest
from conftest import rows

from tidemark.sources.pages import DATED_GROUPS, LINK_END, LINK_ENTRY, entries, extract_listing, page_parts
from workload.derive import PAGES, listing_page_files, part_pages

PAGE = """<html><body><pre><A HREF="/pub/">[To Parent Directory]</A><br><br>
 3/6/2025  8:30 AM         1234 <A HREF="/pub/x/pr.class">pr.class</A><br>
11/16/2024 12:05 PM    &lt;dir&gt; <A HREF="/pub/x/old/">old</A><br>
12/1/2024 12:00 AM       99 <A HREF="/pub/x/pr.data.0.Current">pr.data.0.Current</A><br></pre></body></html>"""
BASE = "https://example.org"


def pages(spark, *texts):
    return spark.createDataFrame([("R1", "u", t) for t in texts], "run_ts string, url string, html string")


def test_listing_page(spark):
    got = extract_listing(pages(spark, PAGE), BASE)
    assert got.columns == ["run_ts", "file_name", "file_timestamp", "full_url", "file_ts", "file_size"]
    assert rows(got.drop("run_ts")) == [
        ("pr.class", "03/06/2025 08:30 AM", BASE + "/pub/x/pr.class", datetime.datetime(2025, 3, 6, 8, 30), 1234),
        (
            "pr.data.0.Current",
            "12/01/2024 12:00 AM",
            BASE + "/pub/x/pr.data.0.Current",
            datetime.datetime(2024, 12, 1),
            99,
        ),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_no_time_zone_shifts_the_text(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        page = '<pre>3/10/2024 2:30 AM 1 <a href="/f">f</a></pre>'
        assert extract_listing(pages(spark, page), BASE).first().file_timestamp == "03/10/2024 02:30 AM"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize(
    "page",
    [
        "",
        '1/1/2024 1:00 AM 5 <a href="/f">f</a>',
        "<pre></pre>",
        '<pre>x</pre><pre>1/1/2024 1:00 AM 5 <a href="/f">f</a></pre>',
    ],
)
def test_pages_without_entries_in_the_first_block(spark, page):
    assert extract_listing(pages(spark, page), BASE).isEmpty()


@pytest.mark.parametrize(
    "line",
    [
        "1/1/2024 1:00 AM 5 <a href='/f'>f</a>",
        '1/1/2024 1:00 AM\t5 <A  HREF = "/f" >f</A >',
        '01/01/2024 01:00 AM 5\n<a href="/f">f</a>',
        '<b>new</b> 1/1/2024 1:00 AM 5 <a href="/f">f</a> 2/2/2024 1:00 AM 5 <a href="/g">g</a>',
    ],
)
def test_spelling_of_an_entry(spark, line):
    got = extract_listing(pages(spark, f"<PRE class=x>top<BR/>{line}<br />"), BASE).collect()
    assert [(r.file_name, r.file_timestamp, r.full_url) for r in got] == [("f", "01/01/2024 01:00 AM", BASE + "/f")]


@pytest.mark.parametrize("time", ["13/45/2025 8:30 AM", "2/30/2024 1:00 PM", "1/1/2024 13:00 PM", "1/1/2024 1:00 PP"])
def test_impossible_times_fail(spark, failing, time):
    page = f'<pre>{time} 1 <a href="/f">f</a></pre>'
    failing(extract_listing(pages(spark, page), BASE))


def test_other_patterns_without_a_block(spark):
    page = '<p><a href="/a">A</a> <a href="/b">B</a><br>none<br/><a href="/c">C\n</a></p>'
    first = entries(pages(spark, page), r'<a href="(.*?)">', ["href"], block=None)
    assert rows(first) == [("R1", "u", "/a"), ("R1", "u", "/c")]
    every = entries(pages(spark, page), LINK_ENTRY, ["href", "label"], block=None, cut=LINK_END)
    assert rows(every) == [("R1", "u", "/a", "A"), ("R1", "u", "/b", "B"), ("R1", "u", "/c", "C\n")]


@pytest.mark.parametrize(
    ("line", "name", "url"),
    [
        ("1/1/2024&nbsp;1:00&#160;AM &#xa0;5&nbsp;<A HREF=/f>f</A>", "f", "/f"),
        ("1/1/2024 1:00 AM 5 <a class='x y' href='/a>b' title=t>f</a>", "f", "/a>b"),
        ('1/1/2024 1:00 AM 5 <a href="/a&amp;b?c=1&d=2">caf&eacute; &lt;1&gt; &#x1F600;&#233;</a>', "caf\u00e9 <1> \U0001F600\u00e9", "/a&b?c=1&d=2"),
        ('1/1/2024 1:00 AM 5 <a href="/f">&unknown; &#0; &#xD800; & &amp;lt;</a>', "&unknown; &#0; &#xD800; & &lt;", "/f"),
    ],
)
def test_other_spellings(spark, line, name, url):
    got = extract_listing(pages(spark, f"<pre>{line}<br></pre>"), BASE).collect()
    assert [(r.file_name, r.full_url) for r in got] == [(name, BASE + url)]


@pytest.mark.parametrize("line", ['1/1/2024 1:00 am 5 <a href="/f">f</a>', "1/1/2024 1:00 5 <a href=/f>f</a>", "x 1/1/2024&nbsp;25:00x AM 7<A HREF=/f>f</A>"])
def test_a_line_like_an_entry_must_be_one(spark, failing, line):
    assert "not read as an entry" in failing(extract_listing(pages(spark, f"<pre>{line}</pre>"), BASE))


def test_lines_without_a_size_drop_out(spark):
    page = "<pre>1/1/2024 1:00 AM &lt;dir&gt; <a href=/d/>d</a><br>1/1/2024 1:00 AM <a href=/e/>e</a> 5</pre>"
    assert extract_listing(pages(spark, page), BASE).isEmpty()


def test_a_pattern_of_five_groups(spark):
    pattern = r'(\d+/\d+/\d+)\s+(\d+:\d+\s[AP]M)\s+(\d+)\s<A HREF="(.*?)">(.*?)</A>'
    page = '<pre>3/6/2025  8:30 PM 1234 <A HREF="/x">x</A><br>13/45/2025 8:30 AM <A HREF="/d">d</A></pre>'
    got = extract_listing(pages(spark, page), BASE, pattern, groups=DATED_GROUPS).collect()
    assert [(r.file_name, r.file_timestamp, r.full_url, r.file_size) for r in got] == [("x", "03/06/2025 08:30 PM", BASE + "/x", 1234)]
    bad = page.replace("3/6/2025", "2/30/2025")
    with pytest.raises(Exception, match="no such time"):
        extract_listing(pages(spark, bad), BASE, pattern, groups=DATED_GROUPS).collect()


ENTRY = '1/{d}/2024 08:30 AM {d} <A HREF="/x/{n}">{n}</A>'
BLOCKS = [
    "<html><pre>{e}</pre></html>",
    "<html><PRE class='x'>{e}</PRE><br>1/1/2024 08:30 AM 5 <a href=/no>no</a><br><pre>1/1/2024 08:30 AM 5 <a href=/no>no</a></pre>",
    "1/1/2024 08:30 AM 5 <a href=/no>no</a><br><br><pre>{e}",
    "<p>{e}</p></pre>",
    "<pre></pre><br><pre>{e}</pre>",
    "<pre>{e}\n</pre ><br></pre><br>1/1/2024 08:30 AM 5 <a href=/no>no</a>",
]


@pytest.mark.parametrize("size", [150, 10**6])
def test_a_page_read_by_many_tasks(spark, tmp_path, size):
    """Each page in a file of its own, cut into splits of any size, gives the entries that it gives as one row."""
    texts = []
    for i, block in enumerate(BLOCKS):
        for j, (cut, many) in enumerate([("<br>", 60), ("<BR>", 7), ("<br/>\n", 7), ("<br>\n", 0), ("<br>", 1)]):
            lines = cut.join(ENTRY.format(d=k % 28 + 1, n=f"f{i}-{j}-{k}") for k in range(many)) + cut
            texts.append(block.format(e=lines))
            (tmp_path / f"p{i}-{j}.html").write_text(texts[-1])
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        parts = page_parts(spark, str(tmp_path))
        assert size == 10**6 or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > len(texts)
        found = rows(extract_listing(parts, BASE, block=None).drop("page_file"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert found == rows(extract_listing(pages(spark, *texts), BASE).drop("run_ts"))
    assert len(found) > 250 and not [r for r in found if r[0] == "no" and r[4] != 5]


@pytest.mark.parametrize("groups", [None, DATED_GROUPS])
def test_patterns_run_once_a_piece(spark, groups):
    """However many cells a check or a result reads, the plan holds the pattern's cells once."""
    pattern = {"pattern": r'(\d+/\d+/\d+)\s+(\d+:\d+\s[AP]M)\s+(\d+)\s<A HREF="(.*?)">(.*?)</A>', "groups": groups} if groups else {}
    plan = extract_listing(pages(spark, PAGE), BASE, **pattern).where("file_size > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(") == 1


def test_pages_of_few_bytes_are_read_by_many_tasks(spark):
    found = extract_listing(part_pages(spark, "/root/testdata/sf0.001"), BASE)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_parts_of_a_page_are_not_gathered(spark, tmp_path):
    """Wherever broadcasts are not chosen by size, the parts still stay with the tasks that read them."""
    (tmp_path / "p.html").write_text(PAGE)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = page_parts(spark, str(tmp_path))._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.split("\n")[1].lstrip("+- ").startswith("BroadcastHashJoin")


def test_page_files_hold_the_pages(spark):
    """Each page is one file, also one without entries, and gives what the page as a row gives."""
    for many in (3000, 5):
        listing = spark.range(many).selectExpr("concat('f', id) as file_name", "'01/02/2024 08:30 AM' as file_timestamp", f"concat('{BASE}/x/f', id) as full_url")
        path = listing_page_files(listing, "pages")
        assert spark.read.format("binaryFile").load(f"{path}/*/*.txt").count() == PAGES
        found = extract_listing(page_parts(spark, path), BASE, block=None).select("file_name", "file_timestamp", "full_url")
        assert rows(found) == rows(listing)
