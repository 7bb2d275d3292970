"""Names too short for segments meet by an edit too, where their year is known."""

from itertools import combinations

import pytest

from vitrine.llm import variants
from vitrine.llm.canonical import osa


@pytest.mark.parametrize(("a", "b"), [("li po", "li bo"), ("mayu", "maju"), ("abc", "acb"), ("abcde", "abcdef"), ("abcde", "abcd"), ("abcdef", "abcde"), ("wxyz", "wxyz")])
def test_short_forms_meet(a, b):
    assert osa(a, b, 1) <= 1
    assert set(variants.index_keys(a, "s")) & variants.probe_keys(b, "s", True) or set(variants.index_keys(b, "s")) & variants.probe_keys(a, "s", True)


def test_every_pair_of_short_forms_within_one_edit_meets():
    words = ["".join(x) for n in (3, 4) for x in combinations("abcde", n)] + ["abced", "bacde", "abxde", "abcdexf", "abcdef"]
    for a, b in combinations(words, 2):
        if osa(a, b, 1) <= 1:
            assert set(variants.index_keys(a, "s")) & variants.probe_keys(b, "s", True) or set(variants.index_keys(b, "s")) & variants.probe_keys(a, "s", True), (a, b)


def test_short_names_link_within_their_year_only(spark):
    rows = [(1, "Mo Ku", 1700, None), (2, "Mo Kru", 1700, None), (3, "Mo Kuu", 1811, None), (4, "Mo Xa", None, None), (5, "Mo Xe", None, None)]
    df = spark.createDataFrame(rows, "alias_id long, alias string, birth_year int, death_year int")
    pairs = {tuple(r) for r in variants.variant_pairs(df).collect()}
    assert (1, 2) in pairs and not {(1, 3), (2, 3), (4, 5)} & pairs
