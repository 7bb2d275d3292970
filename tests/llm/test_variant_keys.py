"""Names that share a surname only aren't held against each other; those within one edit all are."""

import random

from vitrine.llm import variants
from vitrine.llm.canonical import osa


def meet(a, b):
    return bool(set(variants.index_keys(a, "w")) & variants.probe_keys(b, "w", True))


def test_candidates_of_one_surname_are_few():
    rnd = random.Random(1)
    given = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(60)]
    names = [f"osterfield {g}" for g in given] + [f"{g[:5]} matilda" for g in given]
    pairs = [(a, b) for a in names for b in names if a != b]
    assert sum(meet(a, b) for a, b in pairs) <= sum(osa(a, b, 1) <= 1 for a, b in pairs) + 0.01 * len(pairs)


def test_every_form_within_one_edit_meets_in_both_directions():
    rnd = random.Random(2)
    for n in range(7, 40):
        for at in range(n):
            a = "".join(rnd.choices("abcd ", k=n))
            for b in (a[:at] + "x" + a[at + 1 :], a[:at] + "x" + a[at:], a[:at] + a[at + 1 :], a[:at] + a[at + 1 : at + 2] + a[at : at + 1] + a[at + 2 :]):
                assert meet(a, b) and meet(b, a), (a, b)
