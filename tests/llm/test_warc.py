import gzip
import hashlib
import random
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from marquee.llm import warc

PAGE = ("<!DOCTYPE html><html><head><title>A &amp; B\n C</title><style>p{}</style></head><body><script>var t='</p>';</script>"
        "<!-- <p>no</p> --><h1>One</h1><p class='x'>two&nbsp;&#233;&#x1F600; <b>th</b>ree</p><a href=\"/x?a=1&amp;b=2\">go</a>"
        "<A  target=_x HREF='http://y'>there</A><br>5 &lt; 6 &unknown; &#xD800;<script>open")


@pytest.mark.parametrize("html, text", [
    (PAGE, "One\ntwo é😀 three\ngothere\n5 < 6 &unknown; �"), ("", ""), ("plain", "plain"),
    ("<p>a</p>\n\n <p> b  c </p>", "a\nb c"), ("&amp;lt;", "&lt;"), ("&#38;lt; &lt;", "&lt; <"), ("&#x41;&#x61; &#0;", "Aa �"), ("a<b> c < d", "a c < d"), ("<head>only", "")])
def test_plain_text(spark, html, text):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(warc.plain_text(F.col("h"))).first()[0] == text


@pytest.mark.parametrize("html, text", [
    ("<html><head><title>T</title><meta charset=x><body>text <p>more</html>", "text\nmore"),
    ("<head><title>T</title><script>'<div>'</script><style>p{}</style><P>text", "text"),
    ("<head><title>T</title></head><title>kept</title>text", "kepttext"), ("<head><title>T</title>", ""),
    ("caf&eacute; &uuml;ber &frac12; &CounterClockwiseContourIntegral; &nosuch; &amp;eacute;",
     "café über ½ ∳ &nosuch; &eacute;")])
def test_open_heads_and_all_names(spark, html, text):
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(warc.plain_text(F.col("h"))).first()[0] == text


def test_links_in_their_own_quotes_or_none(spark):
    html = """<a href="/it's">a</a><a class=x href='say "x"'>b</a><a href=/bare?q=1 rel=y>c</a><a href=/end>d</a><a href="">"""
    df = spark.createDataFrame([(html,)], "h string")
    assert df.select(warc.links(F.col("h"))).first()[0] == ["/it's", 'say "x"', "/bare?q=1", "/end", ""]


def derived(frame, rows):
    pages = frame(rows, "page_id long, url string, html string, head string, text string")
    responses = warc.responses(pages)
    return responses.collect(), warc.derive(responses.withColumn("made", F.lit(1))).collect()


def test_records_are_linked_and_digested(frame):
    responses, out = derived(frame, [(1, "http://a", PAGE, "", ""), (2, "http://b", None, "", ""), (3, None, "", "", "")])
    by_type = {(r["warc_type"], r["refers_to"]): r for r in out}
    assert len(out) == 6 and len({r["record_id"] for r in out}) == 6
    for r in responses:
        data, text = by_type["metadata", r["record_id"]], by_type["conversion", r["record_id"]]
        assert data["concurrent_to"] == text["record_id"] and text["concurrent_to"] == data["record_id"]
        for own in (data, text):
            assert own["target_uri"] == r["target_uri"] and own["source_payload_digest"] == r["payload_digest"]
            assert own["source_status"] == "HTTP/1.1 200 OK"
            assert own["source_headers"] == r["block"].partition("\r\n\r\n")[0].partition("\r\n")[2]
            block = own["block"].encode()
            assert own["content_length"] == len(block)
            assert own["block_digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        lines = data["block"].split("\r\n")
        assert f"source-payload-digest: {r['payload_digest']}" in lines
        assert "source-header: Content-Type: text/html; charset=utf-8" in lines
    page = next(r for r in responses if r["target_uri"] == "http://a")
    lines = by_type["metadata", page["record_id"]]["block"].split("\r\n")
    assert "title: A & B C" in lines
    assert [x for x in lines if x.startswith("outlink")] == ["outlink: /x?a=1&b=2", "outlink: http://y"]
    assert page["payload_digest"] == "sha256:" + hashlib.sha256(PAGE.encode()).hexdigest()


def test_odd_blocks_and_nulls(spark):
    rows = [(None, None, None, None, None), ("<r>", "u", "d", "HTTP/1.1 204 No Content", "x"),
            ("<s>", "u", "d", "HTTP/1.1 200 OK\r\nA: b\r\nC: d\r\n\r\n" + "<p>long</p>" * 20_000, "x")]
    records = spark.createDataFrame(rows, "record_id string, target_uri string, warc_date string, block string, payload_digest string")
    out = {(r["warc_type"], r["refers_to"]): r for r in warc.derive(records).collect()}
    assert out["conversion", ""]["block"] == "" and out["metadata", ""]["source_headers"] == ""
    assert out["conversion", "<r>"]["source_status"] == "HTTP/1.1 204 No Content"
    assert out["conversion", "<s>"]["block"] == "\n".join(["long"] * 20_000)
    assert out["metadata", "<s>"]["source_headers"] == "A: b\r\nC: d"
    assert warc.derive(records.union(records)).count() == 12 and warc.derive(records.limit(0)).count() == 0


def test_files_hold_the_records(frame, tmp_path):
    pages = frame([(k, f"http://{k}", f"<p>page {k}\n\nend") for k in range(9)], "page_id long, url string, html string")
    records = warc.derive(warc.responses(pages))
    warc.write_warc(records, f"{tmp_path}/warc")
    data = b"".join(gzip.decompress(p.read_bytes()) for p in Path(f"{tmp_path}/warc").glob("part-*"))
    seen = 0
    while data:
        head, _, data = data.partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        block, data = data[:size], data[size + 4:]
        assert fields["WARC-Block-Digest"] == "sha256:" + hashlib.sha256(block).hexdigest()
        seen += 1
    assert seen == 18


def test_quoted_signs_do_not_end_a_tag(spark):
    """Nor does a quote that has no partner swallow what follows."""
    cases = {
        '<a title="x > y" href="/q">t</a> <img alt="1>2">z': ("t z", ["/q"]),
        "<p class='a>b' data-x=\"it's\">one</p><br title='>'>two": ("one\ntwo", []),
        "<p title=don't>one</p>two's": ("one\ntwo's", []),
        '<script data-x="</p>">no</script><title lang="a>b">T</title>yes': ("Tyes", []),
        "<a data-a='>' data-b=\">\" href=/r?x=1>r</a>": ("r", ["/r?x=1"]),
        '<p ' + 'a=">" ' * 3_000 + '>long</p>': ("long", []),
    }
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(cases)], "k long, html string")
    got = rows.select("k", warc.plain_text(F.col("html")).alias("text"), warc.links(F.col("html")).alias("links")).orderBy("k")
    assert [(r["text"], r["links"]) for r in got.collect()] == list(cases.values())


def test_nothing_but_dataframes(frame):
    pages = frame([(1, "u", "h")], "page_id long, url string, html string")
    plan = warc.derive(warc.responses(pages))._jdf.queryExecution().toString()
    assert not re.search(r"MapIn(Arrow|Pandas)|EvalPython|GroupsIn|PythonUDF", plan)


def test_blanks_and_characters_as_their_patterns_have_them(spark):
    """On odd runs of blanks, lines and ampersands, as one search of the whole text would find them."""
    some = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "\r", "\f", "\x0b", "\xa0", "\x85", "\u2003", "é", "😀", "a", "lt", "&", ";", "&lt;", "&amp;",
             "&#38;", "&amp", "&#32;", "&#x0a;", "&nosuch;", "&#97;", "#", "mp;", "&" + "x" * 40 + ";", "&semi;", "&#99999999;"]
    texts = ["", " ", "\n", "&", ";", "&#38;amp; &amp", "a \n \nb", *("".join(some.choices(parts, k=some.randint(1, 14))) for _ in range(1_500))]
    rows = spark.createDataFrame([*enumerate(texts)], "k long, t string")
    got = rows.select("k", warc._blanks(F.col("t")).alias("b"), warc._characters(F.col("t")).alias("c")).orderBy("k").collect()
    known = warc.ALL_NAMED | {"&#38;": "&", "&#32;": " ", "&#x0a;": "\n", "&#97;": "a"}
    for text, row in zip(texts, got, strict=True):
        single = re.sub(r"[\x20\t\r\f\x0B\xA0]{2,}|[\t\r\f\x0B\xA0]", " ", text)
        assert row["b"] == re.sub(r" ?\n[ \n]*", "\n", single).strip(" \n"), repr(text)
        for entity in sorted({e for e in re.findall(warc.ENTITY, text) if e in known}, key=lambda e: (known[e] == "&", e)):
            text = text.replace(entity, known[entity])
        assert row["c"] == text


def test_what_is_dropped_is_as_before_and_begins_with_one_sign(spark):
    """A page is not searched six times for what is left out, nor by pattern for names and lines (F1: 402 CPU seconds a GB)."""
    some = random.Random(2)
    parts = ["<!--", "-->", "<script>", "</script >", "<STYLE a='>'>", "</style>", "<head>", "<head a=b>", "</HEAD>", "</head\n>", "<header>",
             "<title>", "</title>", "<p>", "<template x", ">", "'", '"', "\n", "text", "<", "<meta>", "<noscript>", "</noscript>"]
    texts = ["".join(some.choices(parts, k=some.randint(1, 12))) for _ in range(1_500)]
    rows = spark.createDataFrame([*enumerate(texts)], "k long, t string")
    one_by_one = r"(?is)<!--.*?(?:-->|\z)|" + "|".join(
        rf"<{tag}\b{warc.REST}.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "noscript", "template")
    ) + rf"|<head\b{warc.REST}(?:.*?</head\s*>|(?!.*{warc.IN_BODY}).*)"
    same = (F.regexp_replace("t", warc.DROPPED_HERE, " ") == F.regexp_replace("t", one_by_one, " ")) & (
        F.col("t").rlike(warc.OPEN_HEAD) == F.col("t").rlike(r"(?is)<head\b(?!.*</head\s*>)"))
    assert rows.where(~same).count() == 0
    assert "|<" not in warc.DROPPED_HERE
    plan = rows.select(warc.plain_text(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract_all" not in plan and "[ \\n]*" not in plan
