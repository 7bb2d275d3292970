"""Items in several parts leak as items in one."""

from vitrine.llm import leakage


def test_parts_give_the_rows_of_one_automaton(spark):
    base = "the mount of the old bronze vase was replaced by a careful curator in the north gallery after a long survey of the rim number"
    tests = spark.createDataFrame([(i, f"{base} {i} {i * 7} ends") for i in range(40)] + [(99, None), (100, "")], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"Some words first. {base.title()} {i} {i * 7} ends! And more & more.") for i in range(0, 40, 3)] + [(500, None), (501, "")], "doc_id long, text string")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    one, many = leakage.leaks(docs, tests), leakage.leaks(docs, tests, part_chars=700)
    assert key(one) == key(many) and one.count() >= 14
    assert leakage.leaks(docs, tests.limit(0)).count() == leakage.leaks(docs.limit(0), tests).count() == 0


def test_squash_is_normalise():
    for text in ("Ab & c-d_e 12.5", "é̀ Ünï 真品。ｆｕｌｌ", "аbс สวัสดี हिन्दी \U0001f600"):
        assert leakage.squash(text) == leakage.normalise(text)[0]
