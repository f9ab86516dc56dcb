from keelson.functions.render import render, render_header, render_text


def test_rows(spark):
    df = spark.createDataFrame([("ASIA", "2"), ("EUROPE", "3")], "a string, b string")
    assert render_text(df).split("\n", 1)[1] == "ASIA|2\nEUROPE|3\n"


def test_header(spark):
    df = spark.createDataFrame([(1, "Alice")], "id int, name string")
    assert render_header(df) == "id|name"
    assert render_text(df) == "id|name\n1|Alice\n"


def test_single_column(spark):
    df = spark.createDataFrame([("abc",)], "x string")
    assert [r[0] for r in render(df).collect()] == ["abc"]


def test_null_keeps_position(spark):
    df = spark.createDataFrame([(1, None, "z")], "a int, b string, c string")
    assert [r[0] for r in render(df).collect()] == ["1||z"]
