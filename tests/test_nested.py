"""Page elements that nest their own kind, and message fields that the schema does not know."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweir.functions import element_text
from logweir.operators.parse import other_fields, parse_messages
from logweir.plans import run_usage_bronze, run_usage_bronze_split
from logweir.schemas import USAGE_EVENT
from logweir.sources import stream_messages

PAGES = {
    '<p><span id="x">a<span>b</span>c<span class=q>d<span>e</span></span>f</span>g</p>': "abcdef",
    '<span id="x">a<span>b</span></span>c</span>': "ab",
    "<div id='x'><DIV>1</Div >2<div\n>3</div></div>4": "123",
    '<span id="x">a<span>b</span>c': "ab",
    '<span id="x">a<span>b<span>c</span>d</span>e': "abc",
    '<span id="x">a': None,
    '<span id="x">a<span/>b</span>c</span>': "ab",
    '<span id="x"></span>': "",
    '<span id="x"><span></span></span>z': "",
    '<b id="x">a<body>b</b>c</b>': "ab",
    '<div id="y"><div id="x">in<div>ner</div></div>out</div>': "inner",
    '<b id="x">1<i>2</i>3</b><b>4</b>': "123",
    '<span id="y">x</span>': None,
    "": None,
    None: None,
}


def test_an_element_ends_at_the_tag_that_closes_it(spark):
    df = spark.createDataFrame([(h, str(w)) for h, w in PAGES.items()], "h string, w string").repartition(2)
    got = {r.h: r.t for r in df.select("h", element_text("h", "x").alias("t")).collect()}
    assert got == PAGES


def brute_text(html):
    """The text of the first span: its tags counted one by one."""
    import re

    depth, out, at = 0, [], 0
    for m in re.finditer(r"<(/?)span[^>]*>", html):
        if depth:
            out.append(html[at : m.start()])
        depth += -1 if m.group(1) else 1
        at = m.end()
        if depth == 0:
            return re.sub("<[^>]*>", "", "".join(out))
    return "open"


def test_depth_equals_a_loop(spark):
    import random

    rnd = random.Random(1)
    pages = set()
    while len(pages) < 300:
        body = "".join(rnd.choice(["<span>", "</span>", "t", "<b>", "</b>", "u"]) for _ in range(rnd.randint(0, 14)))
        pages.add('<span id="x">' + body + "</span>")
    want = {p: brute_text(p) for p in pages}
    df = spark.createDataFrame([(p,) for p in pages], "h string")
    got = {r.h: r.t for r in df.select("h", element_text("h", "x").alias("t")).collect()}
    closed = [p for p in pages if want[p] != "open"]
    assert len(closed) > 100 and all(got[p] == want[p] for p in closed)
    assert all(got[p] is not None for p in pages)


MESSAGES = {
    '{"id":"a","extra":{"n":[1,2,{"x":null}]},"z":1.5}': {"extra": {"n": [1, 2, {"x": None}]}, "z": 1.5},
    '{"id":"a","activity":null}': None,
    "{}": None,
    '{"id":{"deep":1},"activity":["q"],"ontology":5,"start_date":true}': {
        "id": {"deep": 1}, "activity": ["q"], "ontology": 5, "start_date": True
    },
    '{"e":1,"e":{"f":2},"id":"x"}': {"e": [1, {"f": 2}]},
    '{"id":"a","id":"b"}': {"id": ["a", "b"]},
    '{"id":"a","id":null,"n":null}': {"id": ["a", None], "n": None},
    '{"ID":"a","é x":"\\u0041"}': {"ID": "a", "é x": "A"},
    "nonsense": None,
    "[1]": None,
    '{"id":"a","x":': None,
    None: None,
}


def test_other_fields(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "m string")
    rows = df.select("m", F.to_json(other_fields(F.col("m"), USAGE_EVENT)).alias("o")).collect()
    assert {r.m: r.o and json.loads(r.o) for r in rows} == MESSAGES


def test_other_fields_of_other_types(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("s", T.StringType())])
    df = spark.createDataFrame([(b'{"n":1,"s":"x","m":2}',), (b'{"n":"one","s":"x","m":2}',)], "body binary")
    rows = parse_messages(df, schema, rest="more").select("n", "s", F.to_json("more").alias("more"), "malformed").collect()
    assert [tuple(r) for r in rows] == [(1, "x", '{"m":2}', False), (None, "x", None, True)]


@pytest.mark.parametrize("split", [False, True])
def test_bronze_keeps_the_rest_of_a_message(spark, folder, split):
    bodies = [m for m in MESSAGES if m is not None]
    spark.createDataFrame([(m,) for m in bodies], "value string").write.text(f"{folder}/in")
    stream = stream_messages(spark, "text", f"{folder}/in")
    if split:
        run_usage_bronze_split(stream, f"{folder}/b", f"{folder}/bad", "bus", rest="rest").awaitTermination()
    else:
        for query in run_usage_bronze(stream, f"{folder}/b", "bus", rest="rest"):
            query.awaitTermination()
    rows = spark.read.schema("id string, rest variant").parquet(f"{folder}/b").select("id", F.to_json("rest").alias("o")).collect()
    got = sorted(json.dumps(json.loads(r.o), sort_keys=True) for r in rows if r.o)
    assert got == sorted(json.dumps(o, sort_keys=True) for o in MESSAGES.values() if o)
    assert len(rows) == 8
