import random
import re
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from tessera import config
from tessera import functions as fn


def apply(spark, values, column, schema="v string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [r[0] for r in rows.orderBy("i").select(column).collect()]


def test_clean_strips_what_python_strips(spark):
    values = [f"{c}a b{c}{c}" for c in config.WHITESPACE] + ["", "  ", "x", " x", "x ", "é ", "a\u3000", "​x"]
    assert apply(spark, values, fn.clean("v")) == [v.strip() for v in values]
    assert {chr(i) for i in range(0x11000) if chr(i).isspace()} == set(config.WHITESPACE)


def test_blank_to_null(spark):
    assert apply(spark, [" \t", "", None, " a "], fn.blank_to_null("v")) == [None, None, None, "a"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Nautical chart", "NauticalChart"),
        (" nautical  CHART ", "NauticalChart"),
        ("nautical \t\n chart", "NauticalChart"),
        ("NauticalChart", None),
        ("Nauticall chart", None),
        ("Naut ical chart", None),
        ("map", "Map"),
        ("MODEL", "Model"),
        ("Person", None),
        ("Acquisition", None),
        ("", None),
        (None, None),
    ],
)
def test_canonical_class(spark, text, expected):
    assert apply(spark, [text], fn.canonical_class(fn.clean("v"))) == [expected]


def test_canonical_class_equals_capitalised_words(spark):
    rng = random.Random(3)
    pieces = ["nautical", "Chart", "MAP", "printed", "volume", "mo", "del", " ", "  ", "\t", " "]
    texts = ["".join(rng.choices(pieces, k=rng.randint(1, 5))) for _ in range(400)]

    def canonical(text):
        name = "".join(word.capitalize() for word in text.split())
        return name if name in config.OBJECT_CLASSES else None

    assert apply(spark, texts, fn.canonical_class(fn.clean("v"))) == [canonical(t) for t in texts]


def test_parse_authors_equals_the_pattern(spark):
    rng = random.Random(5)
    alphabet = ["A", "b", "(", ")", " ", "\t", "\n", " ", ";", "é", "V:1"]
    cells = ["".join(rng.choices(alphabet, k=rng.randint(0, 9))) for _ in range(4000)]
    cells += ["Name (ID)", "(ID)", "A (b) (c)", "A ()", "A ( )", "A (b) c", "()", "(()", "A (b))"]

    def expected(cell):
        match = re.search(config.AUTHOR_PATTERN, cell)
        name, identifier = (part.strip() or None for part in match.groups()) if match else (None, None)
        return (identifier, name) if identifier else (None, None)

    rows = spark.createDataFrame(list(enumerate(cells)), "i int, cell string")
    parsed = fn.parse_authors(rows, "cell").orderBy("i").collect()
    assert [(r.p_identifier, r.p_name) for r in parsed] == [expected(c) for c in cells]


@pytest.mark.parametrize(
    "text, partial, expected",
    [
        ("Council", "COUN", True),
        ("École", "école", False),
        ("École", "ÉCOLE", True),
        ("a_c", "A_C", True),
        ("abc", "a_c", True),
        ("axxc", "a%c", True),
        ("a\\b", "A\\B", True),
        ("a%b", "a\\%b", False),
        ("O'Brien", "o'b", True),
        ("", "", True),
        (None, "", None),
    ],
)
def test_ascii_like(spark, text, partial, expected):
    assert apply(spark, [text], fn.ascii_like("v", partial)) == [expected]


def test_natural_order(spark):
    long = "9" * 45
    values = ["b", "10", "9", "a10", "1", long, "8" * 45, "0", "alo", "Z"]
    rows = spark.createDataFrame([(v,) for v in values] + [(None,)], "v string")
    got = [r.v for r in rows.orderBy(*fn.natural_order("v")).collect()]
    assert got == ["0", "1", "9", "10", "8" * 45, long, "Z", "a10", "alo", "b", None]


def test_class_rank(spark):
    values = ["Exporting", "Acquisition", "Other", None]
    assert apply(spark, values, fn.class_rank("v")) == [5, 1, None, None]


def test_iri_encodes_like_python(spark):
    values = ["35", "a b", "VIAF:1", "é~*-_.!'()", "50%", "a/b?c&d=e+f"]
    assert apply(spark, values, fn.iri("CHO", "v")) == [f"loc:CHO-{quote_plus(v)}" for v in values]


def test_strip_namespace_is_literal(spark):
    assert apply(spark, ["http://a.b/Map", "http://axb/Map"], fn.strip_namespace("v", "http://a.b/")) == [
        "Map",
        "http://axb/Map",
    ]


def test_tools(spark):
    texts = ['["a ", "b,c"]', "Blender", "[]", '["a", null]', None, "[not json"]
    assert apply(spark, texts, fn.tools_from_json("v")) == [
        ["a ", "b,c"], ["Blender"], [], ["a", None], None, ["[not json"],
    ]
    lists = [["a ", "b"], [], ["a", None], None, ["b", "a", "b"]]
    assert apply(spark, lists, fn.normalise_tools("v"), "v array<string>") == [
        ["a", "b"], None, None, None, ["b", "a", "b"],
    ]
    assert apply(spark, lists, fn.tool_set("v"), "v array<string>")[-1] == ["a", "b"]
    assert apply(spark, lists, fn.tools_like("v", "A"), "v array<string>")[0] == ["a "]


def test_computed_once_keeps_filters_above(spark):
    rows = spark.range(3).select(F.col("id").cast("string").alias("a"), F.lit("x").alias("b"))
    kept = fn.computed_once(rows, "a").filter(F.col("a") != "1")
    assert sorted(r.a for r in kept.collect()) == ["0", "2"]
