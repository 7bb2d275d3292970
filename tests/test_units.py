import pytest

from vitrine.operators.units import automaton, measured, quantities


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("H. 183.6cm, W. 64.3cm (72 1/4 X 25 3/8 in.)", [("mm", 1836), ("mm", 643)]),
        ("101.9 x 122.5 x 37.9 cm.", [("mm", 1019), ("mm", 1225), ("mm", 379)]),
        ("1 ft. 3 7/8 in. × 6 ft. × 4 ft. 6 1/2 in.", [("mm", 403), ("mm", 1829), ("mm", 1384)]),
        ("6' 2.125\" x 3' 1/4\"", [("mm", 1883), ("mm", 921)]),
        ("weight 12 lb. 5 oz.", [("g", 5585)]),
        ("Overall (with mount 2): 2078 mm by 1.045 m by 22.0 cm; Weight: 2 lb 4 oz", [("mm", 2078), ("mm", 1045), ("mm", 220), ("g", 1021)]),
        ("169,3 cm; 1,234 mm", [("mm", 1693), ("mm", 1234)]),
        ("h: 1½ by w: 33 in", [("mm", 38), ("mm", 838)]),
        ("縱1592毫米；橫1875毫米; 重632克", [("mm", 1592), ("mm", 1875), ("g", 632)]),
        ("12 x 8 x 4", []),
        ("dimensions variable", []),
        ("7.5 in", [("mm", 191)]),
    ],
)
def test_amounts(spark, text, expected):
    df = spark.createDataFrame([(1, text)], "seq long, dimensions string")
    rows = sorted(measured(df).collect(), key=lambda r: r.pos)
    assert [(r.unit, r.amount) for r in rows] == expected
    assert [r.pos for r in rows] == list(range(1, len(expected) + 1))


def test_longest_alias_wins():
    a = automaton()
    assert [q[0] for q in quantities("5 mm 5 m 5 in 5 inches", a)] == ["mm", "m", "in", "in"]
    assert quantities("5 miles, 3 goats, 7 inks", a) == []


def test_nulls_repeats_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, None, 1, "x"), (2, "", 1, "x"), (3, "5 cm", 2, "y"), (3, "5 cm", 2, "y")], "seq long, dimensions string, pos int, unit string")
    assert [(r.seq, r.pos, r.unit, r.amount) for r in measured(df).collect()] == [(3, 1, "mm", 50)] * 2
    assert measured(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "5 cm; " * 5000)], "seq long, dimensions string")
    assert measured(long).count() == 5000


@pytest.mark.parametrize("text", ["1234567890123 mm", "9" * 400 + " cm", "1/" + "9" * 400 + " m", "9" * 30 + " in"])
def test_oversized_numbers_stop_nothing(spark, text):
    df = spark.createDataFrame([(1, text), (2, "5 cm")], "seq long, dimensions string")
    rows = {r.seq: r.amount for r in measured(df).collect() if r.pos == 1}
    assert rows[2] == 50
    assert text != "1234567890123 mm" or rows[1] == 1234567890123
