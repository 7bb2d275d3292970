import pytest
from hypothesis import given
from hypothesis import strategies as st

from vitrine.operators.packed import KINDS, infer_delimiters, split_packed, values_of


@pytest.mark.parametrize(
    ("text", "kind", "values"),
    [
        ("Ming; Qing", "label", ["Ming", "Qing"]),
        ("Chinese (Han, northern), Yi", "label", ["Chinese (Han, northern)", "Yi"]),
        ("Chinese; Yi | Bai", "label", ["Chinese", "Yi", "Bai"]),
        ('["a/b, view 0.jpg", "a/b, view 1.jpg"]', "path", ["a/b, view 0.jpg", "a/b, view 1.jpg"]),
        ("a/b, view 0.jpg || a/b, view 1.jpg", "path", ["a/b, view 0.jpg", "a/b, view 1.jpg"]),
        ("http://x.example/a,b http://x.example/c;d", "url", ["http://x.example/a,b", "http://x.example/c;d"]),
        ("http://x.example/0,0/a.jpg,http://x.example/1,1/b.jpg", "url", ["http://x.example/0,0/a.jpg", "http://x.example/1,1/b.jpg"]),
        ("Li, Fengxue", "name", ["Li, Fengxue"]),
        ("Ann B. Field, Carl D. Stone", "name", ["Ann B. Field", "Carl D. Stone"]),
        ("Field & Stone Company", "name", ["Field & Stone Company"]),
        ("Field, Stone & Co.", "name", ["Field, Stone & Co."]),
        ("Ann B. Field & Field & Stone Company", "name", ["Ann B. Field", "Field & Stone Company"]),
        ('"Nat ""N"" Field";"Wu Bo"', "name", ['Nat "N" Field', "Wu Bo"]),
        ("Wu Bo; ; Xu An;", "name", ["Wu Bo", "Xu An"]),
        ("  ", "name", []),
    ],
)
def test_values(text, kind, values):
    assert values_of(text, kind) == values


@given(st.lists(st.from_regex(r"[A-Z][a-z]{2,8} [A-Z][a-z]{2,8}", fullmatch=True), min_size=2, max_size=6), st.sampled_from(["; ", ";", " | ", "|", "、", "\n", " / ", ", "]))
def test_round_trip_of_names(names, glue):
    assert values_of(glue.join(names)) == names


def test_rows_positions_nulls_and_clashing_columns(spark):
    rows = [(1, 1, "a b; c d", None, "x", 9), (2, None, "e f|g h", "Yi; Bai", "y", 9), (3, 1, "one name", "", None, 9), (3, 1, "p q; p q", None, None, 9)]
    df = spark.createDataFrame(rows, "seq long, museum_id int, artist string, culture string, item string, pos int").selectExpr("*", "null AS image_urls", "null AS image_paths", "'z' AS source", "1 AS value")
    got = sorted((r.seq, r.field_name, r.pos, r.item) for r in split_packed(df).collect())
    assert got == [(1, "artist", 1, "a b"), (1, "artist", 2, "c d"), (2, "artist", 1, "e f"), (2, "artist", 2, "g h"), (2, "culture", 1, "Yi"), (2, "culture", 2, "Bai"), (3, "artist", 1, "p q"), (3, "artist", 2, "p q")]


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], "seq long, museum_id int, artist string, culture string, image_urls string, image_paths string")
    assert split_packed(empty).count() == 0 and infer_delimiters(empty).count() == 0
    long = empty.unionByName(spark.createDataFrame([(1, 1, "; ".join(f"Ab C{'d' * (i % 7 + 1)}" for i in range(20000)), None, None, None)], empty.schema))
    assert split_packed(long).count() == 20000
    assert set(KINDS) == {"image_urls", "image_paths", "artist", "culture"}
