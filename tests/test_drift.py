from silvermill.operators.drift import element_drift

SCHEMA = "n int, j string"
ITEM = {"id": "int", "name": "string", "score": "double", "ok": "boolean", "gone": "int"}


def found(spark, texts, element=ITEM):
    frame = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    return {r.field: tuple(r)[1:] for r in element_drift(frame, "j", element).collect()}


def test_fields_types_and_unknown_names(spark):
    out = found(spark, [
        '[{"id": 1, "name": "a", "score": 1, "ok": true}, {"id": "1", "name": 2, "score": "x", "ok": 0}]',
        '{"id": null, "extra": [1], "score": 1.5}', ' {"id": 99999999999}', "[5, null, [1]]",
        "not json", "", None, "[]", "7", '"text"',
    ])
    assert out == {
        "id": (True, 4, 1, 2), "name": (True, 2, 0, 1), "score": (True, 3, 0, 1), "ok": (True, 2, 0, 1),
        "gone": (True, 0, 0, 0), "extra": (False, 1, 0, 0), None: (False, 3, 1, 3),
    }


def test_no_rows(spark):
    assert found(spark, [], {"id": "int"}) == {"id": (True, 0, 0, 0)}


def test_text_is_parsed_once(spark):
    from tests.test_plans import plan

    text = plan(element_drift(spark.createDataFrame([(1, "[]")], SCHEMA), "j", ITEM))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
