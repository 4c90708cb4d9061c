import pytest

from silvermill.operators.normalize import normalize_json_array
from silvermill.operators.project import (
    drop_columns,
    fill_sentinels,
    flatten_struct,
    rename_columns,
    typed_projection,
)
from silvermill.plans import catalog, star
from silvermill.spec import ArraySpec, ColumnSpec, TableSpec
from tests.conftest import rows

NAMED = {"id": "int", "name": "string"}
EDGES = [
    ('[{"id":1,"name":"a"},{"id":2,"name":"b"}]', [(1, "a"), (2, "b")]),
    ("[]", [(-9999, None)]),
    (None, [(-9999, None)]),
    ("", [(-9999, None)]),
    ("not json", [(-9999, None)]),
    ('[{"id":1,"name":"trunc"', [(-9999, None)]),
    ('{"id":9,"name":"obj"}', [(9, "obj")]),
    ('[{"id":"x","name":"c"},{"id":3,"name":"d"}]', [(-9999, "c"), (3, "d")]),
    ('[{"name":"noid"}]', [(-9999, "noid")]),
    ('[{"id":4,"name":"extra","zz":1}]', [(4, "extra")]),
    ('[null,{"id":5,"name":"e"}]', [(-9999, None), (5, "e")]),
    ('[{"id":1.5,"name":"f"}]', [(-9999, "f")]),
    ('[{"id":99999999999,"name":"g"}]', [(-9999, "g")]),
]


def test_json_edges(spark):
    df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(EDGES)], "n int, j string")
    out = normalize_json_array(
        df, [ColumnSpec("n", "int")], "j", NAMED, ["id", "name"], {"id": -9999}
    )
    expected = [(n, *item) for n, (_, items) in enumerate(EDGES) for item in items]
    assert rows(out) == rows(spark.createDataFrame(expected, "n int, id int, name string"))


def test_every_parent_stays(spark, star_credits):
    for spec in catalog.CREDITS_TABLES:
        parents = star_credits.select("movie_id").distinct().count()
        assert spec.transform(star_credits).select("movie_id").distinct().count() == parents


@pytest.fixture
def star_credits(spark):
    return star.credits(spark, "/root/testdata/sf0.001").cache()


CREDITS = [(
    19995, "Avatar",
    '[{"cast_id":242,"character":"Jake Sully","credit_id":"5602a8a7c3a3685532001c9a","gender":2,'
    '"id":65731,"name":"Sam Worthington","order":0},'
    '{"cast_id":3,"character":"Neytiri","credit_id":"52fe48009251416c750ac9cb","gender":1,'
    '"id":8691,"name":"Zoe Saldana","order":1},'
    '{"cast_id":25,"character":"Dr. Grace Augustine","credit_id":"52fe48009251416c750aca39","gender":1,'
    '"id":10205,"name":"Sigourney Weaver","order":2},'
    '{"cast_id":4,"character":"Col. Quaritch","credit_id":"52fe48009251416c750ac9cf","gender":2,'
    '"id":32747,"name":"Stephen Lang","order":3}]',
    '[{"credit_id":"52fe48009251416c750aca23","department":"Editing","gender":0,"id":1721,'
    '"job":"Editor","name":"Stephen E. Rivkin"},'
    '{"credit_id":"539c47ecc3a36810e3001f87","department":"Art","gender":2,"id":496,'
    '"job":"Production Design","name":"Rick Carter"},'
    '{"credit_id":"54491c89c3a3680fb4001cf7","department":"Sound","gender":0,"id":900,'
    '"job":"Sound Designer","name":"Christopher Boyes"},'
    '{"credit_id":"54491cb70e0a267480001bd0","department":"Sound","gender":0,"id":900,'
    '"job":"Supervising Sound Editor","name":"Christopher Boyes"}]',
)]


def test_golden_credits(spark):
    bronze = spark.createDataFrame(CREDITS, 'movie_id bigint, title string, `cast` string, crew string')
    cast = catalog.CAST.transform(bronze)
    assert cast.columns == ["movie_id", "title", "cast_id", "character", "credit_id", "gender", "id", "name"]
    assert [tuple(r) for r in cast.collect()] == [
        ("19995", "Avatar", 242, "Jake Sully", "5602a8a7c3a3685532001c9a", 2, 65731, "Sam Worthington"),
        ("19995", "Avatar", 3, "Neytiri", "52fe48009251416c750ac9cb", 1, 8691, "Zoe Saldana"),
        ("19995", "Avatar", 25, "Dr. Grace Augustine", "52fe48009251416c750aca39", 1, 10205, "Sigourney Weaver"),
        ("19995", "Avatar", 4, "Col. Quaritch", "52fe48009251416c750ac9cf", 2, 32747, "Stephen Lang"),
    ]
    crew = catalog.CREW.transform(bronze)
    assert crew.columns == ["movie_id", "title", "credit_id", "department", "gender", "id", "job", "name"]
    assert [tuple(r) for r in crew.collect()] == [
        ("19995", "Avatar", "52fe48009251416c750aca23", "Editing", 0, 1721, "Editor", "Stephen E. Rivkin"),
        ("19995", "Avatar", "539c47ecc3a36810e3001f87", "Art", 2, 496, "Production Design", "Rick Carter"),
        ("19995", "Avatar", "54491c89c3a3680fb4001cf7", "Sound", 0, 900, "Sound Designer", "Christopher Boyes"),
        ("19995", "Avatar", "54491cb70e0a267480001bd0", "Sound", 0, 900, "Supervising Sound Editor", "Christopher Boyes"),
    ]


def test_silver_contracts():
    shapes = {spec.name: (spec.column_names, spec.keys, dict(spec.sentinels)) for spec in catalog.ALL_TABLES}
    assert shapes["genres"] == (["movie_id", "id", "name"], ("movie_id", "id"), {"id": -9999})
    assert shapes["spoken_languages"][2] == {"iso_639_1": "XX"}
    assert shapes["production_countries"][1] == ("movie_id", "iso_3166_1")
    assert shapes["crew"][2] == {"credit_id": "0000000000"}
    assert shapes["movies"][1] == ("movie_id", "original_title")
    assert len(shapes["movies"][0]) == 15


def test_lenient_casts(spark):
    df = spark.createDataFrame(
        [(float("nan"), "2009-12-10", "1.7"), (162.0, "2009-1-5", "-1.7"), (1.7, "", " 12 "),
         (-1.7, "bad", "abc"), (None, None, "99999999999")],
        "x double, d string, t string",
    )
    out = typed_projection(df, [ColumnSpec("x", "int"), ColumnSpec("d", "date"), ColumnSpec("t", "int")])
    assert [(r.x, str(r.d), r.t) for r in out.collect()] == [
        (None, "2009-12-10", 1), (162, "2009-01-05", -1), (1, "None", 12), (-1, "None", None),
        (None, "None", None),
    ]


def test_rename_flatten_drop(spark):
    df = spark.createDataFrame([(1, (2, "b"))], "id int, s struct<x:int,y:string>")
    renamed = rename_columns(df, {"id": "movie_id", "absent": "other"})
    assert renamed.columns == ["movie_id", "s"]
    flat = flatten_struct(renamed, "s")
    assert rows(flat) == [(1, 2, "b")]
    assert drop_columns(flat, ["x", "absent"]).columns == ["movie_id", "y"]


def test_a_column_already_renamed(spark):
    df = spark.createDataFrame([(1,)], "movie_id int")
    assert rows(typed_projection(df, [ColumnSpec("movie_id", "string", source="id")])) == [("1",)]


def test_sentinel_of_the_wrong_type_is_refused(spark):
    def spec(kind, sentinel):
        return TableSpec("t", "s", (ColumnSpec("k", kind),), ("k",), sentinels={"k": sentinel})

    spec("string", "0000000000")
    spec("int", -9999)
    for kind, sentinel in (("string", 0), ("int", "-9999"), ("int", True), ("double", 1)):
        with pytest.raises(TypeError):
            spec(kind, sentinel)
    with pytest.raises(TypeError):
        fill_sentinels(spark.createDataFrame([("a",)], "k string"), {"k": 0})


@pytest.mark.parametrize("change, message", [
    ({"keys": ("absent",)}, "is not a column"),
    ({"keys": ()}, "needs a key"),
    ({"slice_by": ("id",)}, "among the keys"),
    ({"sentinels": {"absent": 1}}, "unknown"),
    ({"array": ArraySpec("a", {"id": "int"}, ("id", "name"))}, "not in the element"),
    ({"array": ArraySpec("a", {"k": "int"}, ("k",))}, "occurs twice"),
])
def test_spec_validation(change, message):
    base = {
        "name": "t", "source": "s", "columns": (ColumnSpec("k", "string"),),
        "keys": ("k",), "array": ArraySpec("a", {"id": "int"}, ("id",)),
    }
    with pytest.raises(ValueError, match=message):
        TableSpec(**{**base, **change})
