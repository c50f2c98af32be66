import html as python_html
import random

import pytest
from pyspark.sql import functions as F

from pages import block_texts
from voxloom.schema import (BLIND_SHEET_SCHEMA, EXPORT_SCHEMA, REVIEW_SCHEMA, TIER_EVAL_SCHEMA,
                            require_columns, with_declared_schema)
from voxloom.sources import adapters, html, readers, sinks


def reviews(spark, rows):
    return spark.createDataFrame(rows, "id string, text string, rating double, source string")


TRICKY = [("1", 'line one\nline "two", more', 5.0, "a"), ("2", "plain", None, "b"),
          ("3", "  padded \\ back", 1.0, "a")]


def test_csv_round_trip(spark, tmp_path):
    df = with_declared_schema(reviews(spark, TRICKY), REVIEW_SCHEMA)
    sinks.write_csv(df, str(tmp_path / "x"))
    back = readers.read_reviews(spark, str(tmp_path / "x" / "*.csv"))
    got = {r.id: (r.text, r.rating, r.source) for r in back.collect()}
    assert got["1"] == (TRICKY[0][1], 5.0, "a") and got["2"] == ("plain", None, "b")
    assert got["3"][0].strip() == TRICKY[2][1].strip()


def test_no_input_is_an_error(spark, tmp_path):
    with pytest.raises(readers.NoInputError):
        readers.read_reviews(spark, str(tmp_path / "none" / "*.csv"))
    with pytest.raises(readers.NoInputError):
        readers.read_optional(spark, [str(tmp_path / "a"), str(tmp_path / "b")], REVIEW_SCHEMA)
    with pytest.raises(readers.NoInputError):
        readers.read_tiers(spark, {"t": str(tmp_path / "a")}, EXPORT_SCHEMA)


def test_optional_inputs_and_tiers(spark, tmp_path):
    rows = spark.createDataFrame([("1", "s", "en", "text", "neutral")], EXPORT_SCHEMA)
    there = sinks.write_csv(rows, str(tmp_path / "t"))
    assert readers.read_optional(spark, [str(tmp_path / "no"), there], EXPORT_SCHEMA).count() == 1
    tiers = readers.read_tiers(spark, {"gone": str(tmp_path / "no"), "here": there}, EXPORT_SCHEMA)
    assert [(r.tier, r.tier_ord) for r in tiers.collect()] == [("here", 1)]


def test_read_labelled_needs_its_column(spark, tmp_path):
    reviews(spark, TRICKY).write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="sentiment_label"):
        readers.read_labelled(spark, str(tmp_path / "p"))
    with pytest.raises(ValueError):
        require_columns(reviews(spark, TRICKY), ["nope"])


def test_keep_existing_sink(spark, tmp_path):
    path = str(tmp_path / "sheet")
    first = spark.createDataFrame([("1", "t", "positive", "")], BLIND_SHEET_SCHEMA)
    sinks.write_new(first, path)
    sinks.write_new(first.withColumn("label_1", F.lit("")), path)
    assert readers.read_csv(spark, path, BLIND_SHEET_SCHEMA).first().label_1 == "positive"


def test_partitioned_sink_prunes(spark, tmp_path):
    path = sinks.write_table(reviews(spark, TRICKY), str(tmp_path / "c"), ["source"])
    plan = (spark.read.parquet(path).filter("source = 'b'")._jdf.queryExecution()
            .executedPlan().toString())
    assert "PartitionFilters: [isnotnull(source" in plan


def test_empty_result(spark):
    out = sinks.results_or_empty(spark, [], TIER_EVAL_SCHEMA)
    assert out.count() == 0 and out.columns == ["tier", "model", "accuracy", "macro_f1"]


def test_flat_source(spark):
    raw = spark.createDataFrame([("r", "text", 4, "x")], "reviewId string, content string, score int, extra string")
    raw = raw.withColumn("at", F.timestamp_seconds(F.lit(7)))
    got = adapters.adapt_flat_source(raw, "play_store", "App").first()
    assert (got.id, got.text, got.rating, got.source, got.app) == ("r", "text", 4, "play_store", "App")


def feed(spark, pages):
    import json

    rows = [(b, p, json.dumps({"props": {"pageProps": {"reviews": rv}}}) if rv is not None
             else json.dumps({"props": {"pageProps": {}}})) for b, p, rv in pages]
    return spark.createDataFrame(rows, "brand string, page int, json string")


def rv(i, text="t", date="2024-01-01T00:00:00.000Z"):
    return {"id": i, "text": text, "rating": 5, "dates": {"publishedDate": date} if date else None}


def test_feed(spark):
    f = feed(spark, [
        ("A", 1, [rv("x"), rv("y", "  padded "), rv(None, None, None)]),
        ("A", 2, [rv("x"), rv(""), rv(None), rv("z")]),
        ("A", 3, [rv("x"), rv("z")]),            # nothing new: the brand ends here
        ("A", 4, [rv("late")]),
        ("B", 1, [rv("x")]), ("B", 2, None)])
    rows = adapters.feed_reviews(f, "trustpilot")
    assert rows.filter("id = 'y'").first().text == "padded"
    assert rows.filter("app = 'A' and page = 1 and id is null").first().text == ""
    got = {(r.app, r.id) for r in adapters.dedup_feed(rows.filter("page < 4")).collect()}
    assert got == {("A", "x"), ("A", "y"), ("A", "A_1_2"), ("A", "A_2_3"), ("A", "z"), ("B", "x")}
    pages = sorted((r.app, r.page, r.new_ids) for r in adapters.readable_pages(f, rows).collect())
    assert pages == [("A", 1, 3), ("A", 2, 2), ("B", 1, 1)]
    assert {(r.app, r.id) for r in adapters.feed_corpus(f, "trustpilot").collect()} == got
    gaps = feed(spark, [("A", 1, [rv("x")]), ("A", 2, []), ("A", 3, [rv("y")]), ("B", 1, [rv("x")]), ("B", 3, [rv("y")]),
                        ("C", 2, [rv("x")])])
    rows = adapters.feed_reviews(gaps, "trustpilot")
    run = sorted((r.app, r.page) for r in adapters.readable_pages(gaps, rows, first_page=1).collect())
    assert run == [("A", 1), ("B", 1)]


def test_threads(spark):
    roots = spark.createDataFrame([("r1", "Title", None, 10, "r/a")],
                                  "id string, title string, body string, created long, app string")
    replies = spark.createDataFrame(
        [(f"c{i:02d}", "r1", i, f"reply {i}", 10 + i, "r/a") for i in range(30)],
        "id string, thread_id string, ord int, body string, created long, app string")
    got = adapters.flatten_threads(roots, replies, "reddit").collect()
    assert len(got) == 21
    assert [r.text for r in got if r.id == "r1"] == ["Title"]
    assert {r.id for r in got} == {"r1"} | {f"c{i:02d}" for i in range(20)}


def test_search_threads(spark):
    df = spark.createDataFrame([("1", "fibre 5g"), ("1", "fibre 5g"), ("2", "5g")], "id string, text string")
    got = {(r.id, r.term) for r in adapters.search_threads(df, "text", ["fibre", "5g"]).collect()}
    assert got == {("1", "fibre"), ("2", "5g")}


PAGE = """<html><head><style>div{}</style><script>var d = "<div class='postcolor'>";</script></head>
<body><div class="nav"><a href="/topic/11">Eleven</a><a href='/topic/12'><img src="x"></a>
<a href="/topic/11?st=20"><b> again </b></a><a href="/other">no</a></div>
<span>Jan 2 2024, 3:04 PM</span><span>Jan 3 2024, 3:04 AM</span><span>Feb 1 2024, 12:00 PM</span>
<div class="post postcolor">One &amp; <b>two</b><div class="quotemain">old <div>nested</div> words</div>
 three <div class="box">in a box</div> end<!-- hidden --></div>
<div class='postcolor'><div class="quotetop">only a quote</div></div>
<DIV CLASS=postcolor>last &lt;one&gt;</DIV>
</body></html>"""


def test_html_posts(spark):
    pages = spark.createDataFrame([("77", 1, "F", PAGE)], "thread_id string, page int, forum string, html string")
    got = html.posts_from_pages(pages, "lowyat").orderBy("id").collect()
    assert [(r.id, r.text) for r in got] == [
        ("lowyat_77_20", "One & two three in a box end"), ("lowyat_77_22", "last <one>")]
    assert [str(r.date) for r in got] == ["2024-01-02 15:04:00", "2024-02-01 12:00:00"]
    assert got[0].app == "lowyat/F" and got[0].rating is None
    assert html.page_sizes(pages).first().n_posts == 3
    fewer = pages.withColumn("html", F.replace("html", F.lit("Jan 3 2024"), F.lit("yesterday")))
    assert {r.date for r in html.posts_from_pages(fewer, "lowyat").collect()} == {None}


def test_links(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id int, html string")
    got = html.link_ids(pages, "page_id", "html").orderBy("pos").collect()
    assert [r.topic_id for r in got] == ["11", "11"]


def test_block_texts_edge_cases():
    scan = block_texts
    assert scan("", "div", "p", frozenset()) == []
    assert scan("</div></div><div class=p>x", "div", "p", frozenset()) == ["x"]
    nested = '<div class="p">a<div class="p">b</div>c</div>'
    assert scan(nested, "div", "p", frozenset()) == ["a b c", "b"]
    quoted = '<div class="q"><div class="p">kept</div></div>'
    assert scan(quoted, "div", "p", frozenset({"q"})) == ["kept"]
    inside = '<div class="p">a<div class="q"><div class="p">gone</div></div>b</div>'
    assert scan(inside, "div", "p", frozenset({"q"})) == ["a b", ""]
    assert scan('<div title="a > b" class="p">x < y</div>', "div", "p", frozenset()) == ["x < y"]


def test_csv_files_are_united_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('app,id,text,rating,source,date\nMaxis,7,"two\nlines",4,forum,"Jan 3 2024, 4:05 PM"\n')
    (tmp_path / "b.csv").write_text("id,text,likes,rating,date\n8,plain,3,bad,1704297900\n9,x,1,5,2024-01-03T16:05:00.000Z\n")
    (tmp_path / "c.csv").write_text("")
    rows = {r.id: r for r in readers.read_reviews(spark, str(tmp_path / "*.csv")).collect()}
    assert set(rows) == {"7", "8", "9"} and {str(r.date) for r in rows.values()} == {"2024-01-03 16:05:00"}
    assert (rows["7"].app, rows["7"].text, rows["7"].rating, rows["7"].source) == ("Maxis", "two\nlines", 4.0, "forum")
    assert (rows["8"].rating, rows["8"].app, rows["9"].rating) == (None, None, 5.0)
    report = {r.file.rsplit("/", 1)[1]: (r.rows, r.bad_fields)
              for r in readers.csv_report(spark, str(tmp_path / "*.csv"), REVIEW_SCHEMA).collect()}
    assert report == {"a.csv": (1, 0), "b.csv": (2, 1)}


PARTS = ["<div class=postcolor>", '<div class="a postcolor b">', "<DIV CLASS='postcolor'>", "</div>", "</div>", "</DIV >", "<div>", "<div/>",
         "<div class=quotetop>", '<div class="quotemain x">', "<span class=postcolor>", "</span>", "text", " two words ", "&amp;", "&lt;b&gt;",
         "&eacute;", "&#233;&#x1F600;", "&#150;", "&nope; &#0;", "AT&T", "a < b", "<br>", "\n", "<!-- <div> -->", "<!DOCTYPE x>",
         "<script>'<div class=postcolor>'</script>", "<p title='a>b'>", "<div class=\"broken>"]


def test_post_blocks_match_a_plain_scan(spark):
    rng = random.Random(11)
    pages = ["".join(rng.choices(PARTS, k=rng.randrange(40))) for _ in range(300)] + [None, "", "<div class=postcolor>" * 30 + "deep" + "</div>" * 40]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "id int, html string")
    for wanted, dropped in ((html.POST_CLASS, html.QUOTE_CLASSES), ("", ()), ("b", ("x",))):
        got = df.select("id", html.visible_markup("html").alias("visible"), html.post_blocks("html", "div", wanted, dropped).alias("posts")).collect()
        for r in got:
            assert r.posts == block_texts(r.visible or "", "div", wanted, frozenset(dropped)), pages[r.id]
    plan = df.select(html.post_blocks("html"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("EvalPython", "InArrow", "InPandas", "Exchange"))


def test_character_references(spark):
    texts = ["&amp;&lt;&gt;&quot;&#39;&apos;&nbsp;|", "&copy &copy; &eacute;t&eacute;", "&#x4e2d;&#20013 &#128512;", "&#128;&#150;&#55296;&#0;&#9999999;",
             "a&b & &; &unknownname; &#; &#x;", "&CounterClockwiseContourIntegral;&acE;", "plain"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(html.unescaped(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == [python_html.unescape(t) for t in texts]


def test_csv_of_any_name_and_malformed_records(spark, tmp_path):
    folder = tmp_path / "raw data [1]"
    folder.mkdir()
    (folder / "x y%20+ü.csv").write_text('id,text,rating\n1,"a\nb, c, d",2\n2,short\n3,x,4,extra\n4,"broken,5\n5,fine,1\n6,"quo""ted",2\n7,ok,bad\n')
    (folder / "z{a}.csv").write_text('text,"id"\ngood,8\n"""so"" she said\nand left",9\n"open,10\nlost,11\n')
    (folder / "_ignored.csv").write_text("id\n99\n")
    path = str(folder).replace("[", "\\[").replace("]", "\\]")
    for glob in (path, path + "/*.csv"):
        strict = {r.id: r.text for r in readers.read_reviews(spark, glob).collect()}
        assert set(strict) == {"1", "2", "3", "4", "7", "8", "9", None}
        kept = {r.id: r.text for r in readers.read_reviews(spark, glob, tolerant=True).collect()}
        assert kept == {"1": "a\nb, c, d", "7": "ok", "8": "good", "9": '"so" she said\nand left'}
    bad = {(r.file.rsplit("/", 1)[1][0], r.reason): r.record for r in readers.malformed_records(spark, path).collect()}
    assert set(bad) == {("x", "missing fields"), ("x", "extra fields"), ("x", "broken quote"), ("z", "broken quote")}
    assert bad["x", "extra fields"] == "3,x,4,extra" and "lost,11" in bad["z", "broken quote"]
    report = {r.file.rsplit("/", 1)[1]: (r.rows, r.bad_fields, r.bad_records) for r in readers.csv_report(spark, path, REVIEW_SCHEMA).collect()}
    assert report == {"x y%20+ü.csv": (2, 1, 3), "z{a}.csv": (2, 0, 1)}
    for name in ("first", "second"):
        sinks.write_quarantine(readers.malformed_records(spark, path), str(tmp_path / "quarantine"))
    assert spark.read.parquet(str(tmp_path / "quarantine")).groupBy("reason").count().filter("reason = 'broken quote'").first()["count"] == 4
    with pytest.raises(readers.NoInputError, match="no files match"):
        readers.read_csv(spark, str(tmp_path / "absent*.csv"), REVIEW_SCHEMA)


def test_headers_are_read_without_the_rows(spark, tmp_path):
    import gzip

    (tmp_path / "a.csv").write_text('"id\nof row",text\n1,x\n')
    with gzip.open(tmp_path / "b.csv.gz", "wt") as f:
        f.write("id,text\n2,y\n")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    headers = readers.csv_headers(spark, str(tmp_path / "*.csv*"))
    assert set(headers) == {("id\nof row", "text"), ("id", "text")}
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup()) == before
    assert readers.read_reviews(spark, str(tmp_path / "b.csv.gz")).first().text == "y"
