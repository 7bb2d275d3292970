"""The sentence programme: time, quotations, and what each part of the score is worth."""

import time

import pytest

from vitrine.llm.sentences import Weights, sentences

#: Texts with their sentences parted by a bar.
LABELLED = (
    'He said: "The pot is old. It was broken. We must keep it."|Then he left.',
    "„Das ist alt. Es war kaputt. Wir behalten es.“|Dann ging er.",
    "“他说。你好。再见。”|然后离开了。|下一句。",
    "After a long talk they agreed on Plan B.|The vase was moved to the vault in spring.",
    "Ph.D. Wang read it in the spring.|Nobody else did.",
    "Mr. K. He lent the vase to them.|It came back.",
    "It was bought from Luo and Sons, Inc.|Under raking light the foot shows a crack.",
    "See the note (it was long. It was also wrong. Nobody cared.) and go.|Next one here.",
    "Who would gild a dish twice?!|pH readings of 3.4 were taken from the well.",
    "Im 18. Jahrhundert kam es nach Kelin.|Am 3. Mai 1891 wurde es verkauft.",
    '"Sold!" cried the auctioneer, and the box went away.|Nobody spoke.',
    "«Это подделка?» — спросил хранитель.|Кто подписал крышку?",
    'This pot is 5" high.|It is old.',
    "1. First item here|2. Second item|3. Third",
)


def _parts(text: str, weights: Weights = Weights()) -> list[str]:
    return [text[a:b] for a, b in sentences(text, weights)]


def _right(weights: Weights) -> int:
    texts = [(x.replace("|", "\n" if x[0] == "1" else "" if "。" in x else " "), x.split("|")) for x in LABELLED]
    return sum(_parts(t, weights) == want for t, want in texts)


@pytest.mark.parametrize("marked", LABELLED)
def test_labelled(marked):
    text = marked.replace("|", "\n" if marked[0] == "1" else "" if "。" in marked else " ")
    assert _parts(text) == marked.split("|")


@pytest.mark.parametrize("left_out", ["length", "opening", "closing", "balance"])
def test_every_part_counts(left_out):
    """Without any one part of the score fewer of the labelled texts come out right."""
    assert _right(Weights()) == len(LABELLED)
    assert _right(Weights(**{left_out: 0.0})) < len(LABELLED)


PROSE = 'Dr. Wan saw the piece in Shankai before 2012. "Keep it dry," wrote He, "and never clean the neck." See fig. 22 for it. '


@pytest.mark.parametrize("unit", [PROSE, "Dr. A. ", "foo... bar ", '"Abc def. ', "! ", "ab\n", "天。", "กข ", '("Abc. Def." he said) '])
def test_time_grows_as_the_length(unit):
    def seconds(n: int) -> float:
        text = (unit * (n // len(unit) + 1))[:n]
        best = 1e9
        for _ in range(3):
            began = time.process_time()
            sentences(text)
            best = min(best, time.process_time() - began)
        return best

    assert seconds(200_000) < 3.2 * seconds(100_000) + 0.02


def test_megabyte_is_quick():
    text = (PROSE * 10_000)[:1_000_000]
    began = time.process_time()
    assert len(sentences(text)) > 20_000
    assert time.process_time() - began < 5


def test_matches_unbounded_search():
    """The bounds on the search leave the best spans as they are."""
    import random

    from vitrine.llm import sentences as s

    rng = random.Random(5)
    for _ in range(60):
        n = rng.randint(1, 60)
        begins, ends, at = [0], [], 0
        for _ in range(n):
            at += rng.choice((1, 3, 20, 80, 700))
            ends.append(at)
            at += 1
            begins.append(at)
        scores = [rng.uniform(-9, 5) for _ in ends]
        got = s._best(begins, ends, scores, "letters", 0.35)
        best = [0.0]
        for j, end in enumerate(ends):
            best.append(max(best[i] - 0.35 * (s.math.log(max(1, end - begins[i])) - s.MEAN["letters"]) ** 2 for i in range(j + 1)) + scores[j])
        total = sum(scores[ends.index(b)] - 0.35 * (s.math.log(max(1, b - a)) - s.MEAN["letters"]) ** 2 for a, b in got)
        assert total == pytest.approx(best[-1])
