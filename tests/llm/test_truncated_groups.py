"""Languages of groups and their learned thresholds."""

import numpy as np
import pytest

from vitrine.llm import truncated


@pytest.mark.parametrize(
    ("text", "number"),
    [("The bowl was made in Qing.", 0), ("Ink on paper", 0), ("Der Rand wurde im Jahr 1880 ergänzt und das Blatt ist neu", 10), ("Le vernis a été retiré par le musée dans les années 1950", 11), ("此件青釉盒绘牡丹。", 2), ("蓋だけが残っている", 2), ("Кто подписал крышку?", 4), ("यह किसका है", 5), ("กล่องไม้เดิมสูญหายไป", 6), ("", 0)],
)
def test_language(text, number):
    assert truncated.language(text) == number


def bins(*values):
    at, n = np.unique(np.concatenate(values).round(1), return_counts=True)
    return list(zip(at.tolist(), n.tolist()))


@pytest.mark.parametrize("size", [1, 30])
def test_threshold_parts_two_heaps_at_every_size(size):
    rng = np.random.default_rng(1)
    lost, whole, sure = rng.normal(-7, 0.7, 300 * size), rng.normal(-2, 0.4, 3000 * size), rng.normal(4, 1, 400 * size)
    at = truncated.valley(bins(lost, whole, sure), -5.5)
    assert -5.5 < at < -3
    assert (lost < at).mean() > 0.95 and (whole < at).mean() < 0.005


def test_threshold_without_a_valley_is_that_of_a_random_place():
    rng = np.random.default_rng(2)
    assert truncated.valley([(0.0, 50)], -5.0) == -5.0 + truncated.MARGIN
    assert truncated.valley(bins(rng.normal(-2, 1, 3000)), -3.0) == -3.0 + truncated.MARGIN
