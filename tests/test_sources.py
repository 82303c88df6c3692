"""Feeds, extractors, data sets, streams and technical validation."""

import io
import json
import zipfile

from pyspark.sql import functions as F

from corpusloom.functions import technical
from corpusloom.sources import extractors, feeds
from corpusloom.streaming import events


def test_feeds(spark, tmp_path):
    (tmp_path / "rss.xml").write_text("<rss><channel><item><title>Go news</title><link>https://x.org/a?b=1#c</link><description>d</description><pubDate>now</pubDate></item><item><title>Other</title><link>https://x.org/b</link><description>e</description></item></channel></rss>")
    got = feeds.rss(spark, str(tmp_path / "rss.xml"), "n", "u", ["GO"], {"source": "own"}).collect()
    assert len(got) == 1 and got[0].metadata["source"] == "own" and got[0].url.endswith("#c")
    (tmp_path / "atom.xml").write_text('<feed><entry><id>http://a/1</id><title>T</title><author><name>A</name></author><author><name>B</name></author><link href="h" type="text/html"/><link href="p" type="application/pdf"/></entry><entry><id>2</id><title>U</title><link href="h" type="text/html"/></entry></feed>')
    got = feeds.atom(spark, str(tmp_path / "atom.xml"), "arXiv").collect()
    assert [(r.id, r.url, r.metadata["authors"]) for r in got] == [("http://a/1", "p", "A, B")]
    (tmp_path / "j.json").write_text('{"link": "https://x.org/b", "n": 3}\n{"n": 1}\nnot json\n')
    items = feeds.json_records(spark, str(tmp_path / "j.json"), "api")
    assert [r.metadata["n"] for r in items.collect()] == ["3"]
    assert feeds.unseen(items.union(items), items.limit(0)).count() == 1 and feeds.unseen(items, items).count() == 0


def test_datasets(spark, tmp_path):
    (tmp_path / "d.json").write_text(json.dumps({"dataset": [{"id": "1", "conversation": [{"role": "user", "content": "q"}], "metadata": {"type": "x"}}], "generated_at": "now"}, indent=1))
    (tmp_path / "n.json").write_text('{"dataset": null}')
    rows = feeds.read_dataset(spark, str(tmp_path / "d.json"))
    assert rows.first().conversation[0].content == "q" and feeds.read_dataset(spark, str(tmp_path / "n.json")).count() == 0
    feeds.write_dataset(rows, str(tmp_path / "out"))
    assert spark.read.json(str(tmp_path / "out/metadata")).first().total == 1
    docs = spark.createDataFrame([("a", "T", "s", "one two")], "category string, title string, source string, text string")
    feeds.write_training_texts(docs, str(tmp_path / "t"), "category")
    assert spark.read.option("wholetext", "true").text(str(tmp_path / "t/category=a"), wholetext=True).first().value.startswith("Title: T\nSource: s\nWords: 2")


def test_extractors(spark):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("word/document.xml", '<w:document xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"><w:p><w:t>Hello</w:t><w:t> there</w:t></w:p><w:p><w:t>End</w:t></w:p></w:document>')
    rows = [(1, bytearray(buf.getvalue()), "DOCX"), (2, bytearray(b"junk"), "docx"), (3, bytearray(b"a\nb"), "unknown"), (4, None, "text"), (5, bytearray(b"x"), "png"), (6, bytearray(b"<title>T</title><p>P</p>"), "html"), (7, bytearray(b"x"), "pdf")]
    got = {r.id: r for r in extractors.extracted(spark.createDataFrame(rows, "id int, raw binary, kind string"), "raw", F.col("kind"), ["id"]).collect()}
    assert got[1].text == "Hello there\nEnd" and got[2].error and got[3].metadata["lines"] == "2" and got[4].text == "" and got[5].error == "OCR is not available" and got[6].text == "P" and got[7].error


def test_streams(spark, tmp_path):
    rows = [(i, f"2024-01-0{1 + i % 3} 00:00:00", i % 2, "click" if i % 2 else "view", float(i)) for i in range(20)]
    spark.createDataFrame(rows, "event_id long, ts string, user_id int, event_type string, value double").withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(str(tmp_path / "e.parquet"))
    stream = events.source(spark, str(tmp_path / "e.parquet"))
    assert events.to_table(events.subscribe(stream, "click").groupBy("event_type").agg(F.count("*").alias("n")), "t_counts", "complete").first().n == 10
    delays = events.adaptive_delays(events.timed(stream).select(F.lit("k").alias("key"), "ts", F.col("event_id").alias("order"), F.lit(True).alias("ok"), (F.col("event_id") < 2).alias("limited")))
    out = events.to_table(delays, "t_delays", "update").first()
    assert out.seen == 20 and 0.1 <= out.delay <= 4.0
    docs = spark.createDataFrame([("1", "a  <b>b</b>")], "id string, text string")
    docs.write.parquet(str(tmp_path / "d.parquet"))
    cleaned = []
    events.clean_on_arrival(events.source(spark, str(tmp_path / "d.parquet")), str(tmp_path / "out"), str(tmp_path / "progress")).awaitTermination()
    cleaned.extend(spark.read.parquet(str(tmp_path / "out")).collect())
    assert [r.cleaned for r in cleaned] == ["a b"]


def test_code_and_formulas(spark):
    text = "x ```python\ndef f():\n  return 1\n``` y ```go\nfunc (\n``` and $a + b$ and $$c = 1$$"
    df = spark.createDataFrame([(text,), ("plain",), ("```python\nimport os\n```",)], "t string")
    got = [r[0] for r in df.select(technical.technical_accuracy(F.col("t"))).collect()]
    assert got[1] == 1.0 and got[2] == 0.0 and 0 < got[0] < 1
    assert df.select(technical.balanced(F.lit("{a}}{"), "{", "}"), technical.balanced(F.lit("((x))"), "(", ")")).first()[:] == (False, True)
