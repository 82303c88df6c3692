"""The template engine: slots, conditions, repeats, blocks by domain, tables of templates, errors."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators import templates as tp
from corpusloom.operators.templates import Turn


def docs(spark, *rows):
    return spark.createDataFrame([(i, t, x, d, f) for i, (t, x, d, f) in enumerate(rows)], "doc_id int, title string, text string, domain string, formats array<string>").withColumn("format_", F.lit("clash"))


def talk(df):
    return {(r.doc_id, r.format): [(x.role, x.content) for x in r.conversation] for r in df.collect()}


def test_slots_conditions_and_repeats(spark):
    turns = (
        Turn("a", "user", "{title}|{lower}|{missing_is_empty}"), Turn("a", "assistant", "{n}:{item}", each="parts", most=2), Turn("a", "assistant", "no code", when="!code"),
        Turn("a", "assistant", "many", when="parts>=3&!pro"), Turn("b", "user", "only with code", when="code"),
    )
    got = talk(tp.rendered(docs(spark, ("T {x}", "p1\n\n p2 \n\n\n\np3", "D", ["a", "b", "a", "zz"]), (None, None, None, ["a", "b"]), ("U", "package x // and more", "D", ["b"]), ("V", "v", "D", None)), "formats", "domain", turns=turns, extra={"missing_is_empty": F.lit(None).cast("string")}))
    assert got == {
        (0, "a"): [("user", "T {x}|t {x}|"), ("assistant", "1:p1"), ("assistant", "2:p2"), ("assistant", "no code"), ("assistant", "many")],
        (1, "a"): [("user", "||"), ("assistant", "no code")],
    }


def test_blocks_by_domain_come_before_general_ones(spark):
    blocks = spark.createDataFrame([("*", "x", "all x"), ("*", "y", "all y"), ("D", "x", "D's x")], "domain string, name string, text string")
    turns = (Turn("a", "user", "{domain:x} {domain:y} {domain:z}."),)
    got = talk(tp.rendered(docs(spark, ("T", "t", "D", ["a"]), ("T", "t", "E", ["a"]), ("T", "t", None, ["a"])), "formats", "domain", turns=turns, blocks=blocks))
    assert [got[i, "a"][0][1] for i in range(3)] == ["D's x all y .", "all x all y .", "all x all y ."]
    none = talk(tp.rendered(docs(spark, ("T", "t", "D", ["a"])), "formats", "domain", turns=turns, blocks=blocks.limit(0)))
    assert none[0, "a"] == [("user", "  .")]


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([(2, "a", "assistant", "{item}", None, "parts", 1), (1, "a", "user", "{title}?", None, None, None)], "nth int, format string, role string, text string, when string, each string, most int")
    assert tp.load(table) == (Turn("a", "user", "{title}?"), Turn("a", "assistant", "{item}", each="parts", most=1))


@pytest.mark.parametrize("turn", [Turn("a", "user", "{nowhere}"), Turn("a", "user", "{parts}"), Turn("a", "user", "{item}"), Turn("a", "user", "x", each="title", most=1), Turn("a", "user", "x", each="parts"), Turn("a", "user", "x", when="nowhere"), Turn("a", "user", "x", when="title>=2"), Turn("a", "user", "x", when="title or lower")])
def test_errors(spark, turn):
    with pytest.raises(ValueError, match="a: "):
        tp.rendered(docs(spark, ("T", "t", "D", ["a"])), "formats", "domain", turns=(turn,))


def test_all_formats_speak_and_keep_columns(spark):
    names = sorted({x.format for x in tp.TURNS})
    text = "An overview that is long enough to be taken as the overview here.\n\nIts advantage is speed.\n\nA drawback is cost.\n\nFirst: one should always begin with the plan.\n\npackage main"
    df = tp.rendered(docs(spark, ("T", text, "Web", names)), "formats", "domain")
    assert df.columns == ["doc_id", "title", "text", "domain", "formats", "format_", "format", "conversation"]
    got = talk(df)
    assert len(got) == len(names) == 12 and all(x[0][0] == "user" and any(r == "assistant" for r, _ in x) for x in got.values())
    assert tp.rendered(docs(spark, ("T", text, "Web", names)).limit(0), "formats", "domain").count() == 0
