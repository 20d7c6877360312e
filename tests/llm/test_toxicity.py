"""The toxicity grammar: its tables, their composition, and a plain reading of the same rules."""

import random
import sys
from functools import reduce
from pathlib import Path

import numpy as np
import pytest

sys.path.insert(0, str(Path(__file__).parent.parent.parent))

from keeprule.llm import toxicity
from keeprule.llm.toxicity import ALPHABET, MACHINE, Symbol, Transducer, cascade, composed

GRAMMAR = toxicity.Grammar({"idio": 4.0, "scum$": 2.0}, np.zeros(len(toxicity.FEATURES) + 1))


def weights(clause):
    return GRAMMAR.phrases(clause)


def plain_weight(kinds):
    """The rules as loops over the words of one clause, each insult of weight 1."""
    total = 0.0
    denied = lambda i: any(k == "negation" for k in kinds[max(0, i - 3) : i])
    said = lambda i: "report" in kinds[:i]
    left = lambda i: (0.0 if denied(i) else 1.0) * (0.5 if said(i) else 1.0)
    for i, kind in enumerate(kinds):
        if kind == "insult":
            total += left(i) * (1.5 if "target" in kinds[max(0, i - 3) : i] else 1.0)
        if kind == "target":
            waiting = [j for j in range(max(0, i - 2), i) if kinds[j] == "threat"]
            if waiting and "target" not in kinds[waiting[-1] + 1 : i]:
                total += toxicity.THREAT_WEIGHT * left(waiting[-1])
    return total


def test_the_machine_gives_what_the_rules_give():
    rng = random.Random(4)
    for _ in range(3_000):
        kinds = [rng.choice(toxicity.KINDS) for _ in range(rng.randint(0, 9))]
        state, total = 0, 0.0
        for kind in kinds:
            state, factor, weight = MACHINE[kind][state]
            total += factor + weight
        assert total == plain_weight(kinds), kinds


def test_the_composed_machine_is_the_cascade():
    machines = cascade()
    whole = reduce(composed, machines)
    rng = random.Random(5)
    for _ in range(500):
        state, states = whole.start, [m.start for m in machines]
        for _ in range(8):
            symbol = Symbol(rng.choice(toxicity.KINDS))
            state, written, factor, weight = whole.arcs[state, symbol]
            between, factors, sums = symbol, 0.0, 0.0
            for n, machine in enumerate(machines):
                states[n], between, f, w = machine.arcs[states[n], between]
                factors, sums = factors + f, sums + w
            assert (written, factor, weight) == (between, factors, sums)


def test_composition_feeds_what_is_written():
    first = Transducer(0, {(0, s): (0, s._replace(negated=True), 0.0, 1.0) for s in ALPHABET})
    second = Transducer("a", {("a", s): ("a", s, 0.0, 10.0 if s.negated else 0.0) for s in ALPHABET})
    both = composed(first, second)
    assert both.arcs[both.start, Symbol("other")] == ((0, "a"), Symbol("other", negated=True), 0.0, 11.0)


@pytest.mark.parametrize(
    "clause, weight",
    [
        ("an idiot", 4.0), ("idiots", 4.0), ("scum", 2.0), ("scummy", 0.0), ("you idiot", 6.0), ("you are an idiot", 6.0),
        ("you and the man are an idiot", 4.0), ("he said you idiot", 3.0), ("not a big idiot", 0.0), ("not at all here an idiot", 4.0),
        ("never you idiot scum", 0.0), ("i will kill you", 2.0), ("i will kill all you", 2.0), ("i will kill the plants you like", 0.0),
        ("not kill you", 0.0), ("kill time", 0.0), ("he wrote kill you", 1.0), ("you kill", 0.0), ("", 0.0),
    ],
)
def test_weights_of_clauses(clause, weight):
    assert sum(w for _, w in weights(clause)) == weight


def test_scopes_end_with_the_clause():
    assert GRAMMAR.features("not. idiot")[1] == GRAMMAR.features("idiot")[1] > 0
    assert GRAMMAR.features("kill\nyou") == GRAMMAR.features("") == [0.0, 0.0, 0.0]


def test_a_stem_of_one_word_gives_way_to_the_word():
    counts = {
        "stem": ["path", "pathet", "pathetic$", "vequ", "vequa$", "vequb$", "lose", "loser$"],
        "toxic": np.array([100, 100, 98, 90, 40, 45, 110, 100]),
        "clean": np.array([0, 0, 0, 0, 0, 0, 5, 0]),
    }
    chosen = toxicity.choose_stems(counts, 1000, 9000)
    assert {"pathetic$", "vequ", "loser$"} <= set(chosen) and not {"path", "pathet", "lose"} & set(chosen)
