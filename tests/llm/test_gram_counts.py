"""Counts that order the grams come from all skeletons."""

from collections import Counter

from vitrine.llm import residue


def test_grams_are_counted_over_every_skeleton(spark, monkeypatch):
    texts = [f"the lid of jar {n} is chipped" for n in range(64)]
    df = spark.createDataFrame([(i, t, i == 0) for i, t in enumerate(texts)], "h long, skeleton string, label boolean")
    seen, prepared = [], residue._prepared
    monkeypatch.setattr(residue, "_prepared", lambda skeletons, counts: seen.append(counts) or prepared(skeletons, counts))
    residue.label_skeletons(df, rounds=0)
    assert seen == [Counter(residue._bucket(g) for t in texts for g in residue._grams(t))]
