"""Folding and matching of the toxicity lexicon against plain loops."""

import math
import random

from hypothesis import given, settings, strategies as st

from pricewright.llm import toxicity

WEIGHTS = {"bad": 1.5, "badly": 0.25, "bad*": 0.5, "awf*": 2.0, "no": -0.75, "go": 0.125, "worse*": 1.0}
EXCEPTIONS = ("not bad", "go no more", "badly done")


def plain(folded):
    """Weights of whole words and word starts, those inside an exception phrase left out."""
    words = folded.split()
    covered = set()
    for phrase in EXCEPTIONS:
        parts = phrase.split()
        for i in range(len(words) - len(parts) + 1):
            if words[i : i + len(parts)] == parts:
                covered |= set(range(i, i + len(parts)))
    found = []
    for i, word in enumerate(words):
        for term, weight in WEIGHTS.items():
            if i not in covered and (word.startswith(term[:-1]) if term.endswith("*") else word == term):
                found.append(weight)
    return math.fsum(found), len(found)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(["bad", "badly", "baddest", "not", "go", "no", "more", "done", "awful", "awf", "worse", "worsen", "fine", "ba"]), max_size=25))
def test_matches_equal_plain_loops(words):
    machine = toxicity.automaton(WEIGHTS, EXCEPTIONS)
    folded = f" {' '.join(words)} "
    assert toxicity.matched(folded, machine) == plain(folded)


def test_disguises_fold_to_the_word():
    for text in ("B4D", "bаd", "b​ad", "BAD!", "(bad)", "ｂａｄ", "b@d"):
        assert toxicity.fold(f"so {text} it is") == " so bad it is ", text
    assert toxicity.fold("") == "  " and toxicity.fold("12 34").split() == []


def test_folding_is_stable():
    rng = random.Random(2)
    for _ in range(300):
        text = "".join(rng.choice("abAB019@$!. \t\nаеоé​-_") for _ in range(rng.randint(0, 40)))
        once = toxicity.fold(text)
        assert toxicity.fold(once) == once
        assert toxicity.terms_of(once) >= set(once.split())
