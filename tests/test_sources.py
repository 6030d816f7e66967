from pyspark.sql import functions as F

from quernstone.sources import files, html
from quernstone.streaming import streams

PAGE = """<!DOCTYPE html><html lang="es"><head><title>Museo &amp; más</title><script>var t="</p>";</script><script type="application/ld+json">{"geo": 1}</script></head>
<body><nav><a href="/menu/x">Menu entry here</a></nav><article class="main"><h1>Museo del Prado</h1><p id="p1">Un <b>gran museo<br>de Madrid.<p>Otro <a href="/b/c#z">enlace interior</a> aquí</p>
<img src="a.jpg" alt="Sala"><div onclick="go('/d/e')" data-href="/f/g">Texto del bloque final</div><p>Un gran museo de Madrid.</p></article></body>"""


def test_parser():
    page = html.parse(PAGE, "https://x.es/a/")
    assert (page["title"], page["h1"], page["lang"]) == ("Museo & más", "Museo del Prado", "es")
    texts = {b["text"]: b for b in page["blocks"]}
    assert "Texto del bloque final" in texts and "Menu entry here" not in texts and len(texts) == len(page["blocks"])
    assert texts["Texto del bloque final"]["heading"] == "Museo del Prado"
    assert {"https://x.es/menu/x", "https://x.es/b/c#z", "https://x.es/d/e", "https://x.es/f/g"} <= set(page["links"])
    assert page["images"] == [{"src": "a.jpg", "alt": "Sala", "title": ""}] and page["json_ld"] == ['{"geo": 1}']
    for odd in (None, "", "<", "<p", "</p></p>", "<a><a><a>text without any end at all", "<script>never closed"):
        html.parse(odd, None)


def test_pages(spark):
    pages = spark.createDataFrame([(1, "https://x.es/a/", PAGE), (2, None, None)], "page_id long, url string, html string")
    parsed = html.parse_pages(pages.withColumn("title", F.lit("old")))
    assert parsed.columns == ["page_id", "url", "title", "h1", "lang", "blocks", "links", "images", "json_ld"]
    assert {r.page_id: r.title for r in parsed.collect()} == {1: "Museo & más", 2: ""}
    assert html.page_text(html.blocks(parsed, ["page_id"]), ["page_id"]).filter("page_id = 1").count() == 1
    assert html.parse_pages(pages.limit(0)).count() == 0


def test_sitemaps_and_robots(spark):
    docs = [("i", "<sitemapindex><loc> m1 </loc><loc>i</loc><loc>m2</loc></sitemapindex>"), ("m1", "<urlset><url><loc>https://x/?a=1&amp;b</loc></url></urlset>"), ("m2", "<urlset><loc><![CDATA[https://y]]></loc></urlset>")]
    got = files.expand_sitemaps(spark.createDataFrame(docs, "url string, xml string"), spark.createDataFrame([("i",)], "url string"))
    assert {r.url for r in got.collect()} == {"https://x/?a=1&b", "https://y"}
    robots = spark.createDataFrame([("x", "User-agent: *\nCrawl-delay: 2 # slow\nSitemap: https://x/s.xml\n\nUser-agent: bot\nCrawl-delay: 9"), ("y", "User-agent: *\nDisallow:")], "host string, text string")
    rules = files.robots_rules(robots)
    assert {(r.agent, r.value) for r in rules.filter("field = 'crawl-delay'").collect()} == {("*", "2"), ("bot", "9")}
    assert files.crawl_delay(rules).collect()[0].delay == 2.0


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("﻿url;Entity\nx;y\n", encoding="utf-8")
    assert files.delimited(spark, str(tmp_path / "a.csv")).collect()[0].asDict() == {"url": "x", "Entity": "y"}
    (tmp_path / "e.json").write_text('[{"name": "A", "class": "Museum", "coordinates": {"lat": 1.0, "lng": 2.0}}, {"name": 3}]')
    assert [r.name for r in files.entities(spark, str(tmp_path / "e.json")).collect()] == ["A", "3"]
    (tmp_path / "bad.json").write_text('{"name": "A", ')
    assert files.entities(spark, str(tmp_path / "bad.json")).count() <= 1
    rows = spark.createDataFrame([("| a | b |",), ("|---|:-:|",), ("text",)], "l string").select(files.markdown_cells(F.col("l")).alias("c")).collect()
    assert [r.c for r in rows] == [["a", "b"], None, None]


def test_streams(spark, tmp_path):
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("A ", "2024-01-01 00:05:00"), ("b", "2024-01-01 02:00:00")], "name string, t string").withColumn("t", F.to_timestamp("t")).write.parquet(f"{tmp_path}/in")
    schema = spark.read.parquet(f"{tmp_path}/in").schema
    read = lambda: streams.pages_stream(spark, f"{tmp_path}/in", schema)
    streams.run_once(streams.mention_counts(read(), "name"), f"{tmp_path}/counts", "complete", f"{tmp_path}/c1")
    assert {r.name: r.n for r in spark.read.parquet(f"{tmp_path}/counts").collect()} == {"a": 2, "b": 1}
    streams.run_once(streams.windowed_counts(read(), "t", "name"), f"{tmp_path}/windows", "complete", f"{tmp_path}/c2")
    assert spark.read.parquet(f"{tmp_path}/windows").count() == 3
    streams.run_once(streams.sessions(read(), "t", "name"), f"{tmp_path}/sessions", "append", f"{tmp_path}/c3")
    assert spark.read.parquet(f"{tmp_path}/sessions").columns == ["start", "end", "name", "n"]
