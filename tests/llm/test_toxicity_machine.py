"""The factorisation machine against sums over pairs, its fit against a plain loop, and what its pair part adds."""

import itertools

import numpy as np

from millrace.llm import toxicity as T


def plain_score(machine, inputs):
    z = machine.bias + sum(machine.weights[i] for i in inputs)
    z += sum(float(machine.vectors[i] @ machine.vectors[j]) for i, j in itertools.combinations(inputs, 2))
    return 1 / (1 + np.exp(-z))


def test_score_is_a_sum_over_pairs():
    rng = np.random.default_rng(1)
    machine = T.Machine({}, -0.7, rng.normal(size=30), rng.normal(size=(30, 4)))
    for n in (0, 1, 2, 7):
        inputs = rng.choice(30, n, replace=False).tolist()
        assert np.isclose(machine.score(inputs), plain_score(machine, inputs))


def plain_fit(rows, labels, size, settings):
    """The same passes with one row, one term and one pair at a time."""
    rng = np.random.default_rng(5)
    share = labels.mean()
    machine = T.Machine({}, float(np.log(share / (1 - share))), np.zeros(size), rng.normal(0, 0.05, (size, settings.rank)))
    s1, s2 = np.full(size, 1e-6), np.full((size, settings.rank), 1e-6)
    for _ in range(settings.epochs):
        for block in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // 256)):
            g1, g2 = settings.penalty * machine.weights, settings.penalty * machine.vectors
            for r in block:
                error = (plain_score(machine, rows[r]) - labels[r]) / len(block)
                for i in rows[r]:
                    g1[i] += error
                    for j in rows[r]:
                        if j != i:
                            g2[i] = g2[i] + error * machine.vectors[j]
            s1, s2 = s1 + g1 * g1, s2 + g2 * g2
            machine.weights = machine.weights - 0.5 * g1 / np.sqrt(s1)
            machine.vectors = machine.vectors - 0.05 * g2 / np.sqrt(s2)
    return machine


def test_fit_equals_a_plain_loop():
    rng = np.random.default_rng(2)
    rows = [sorted(rng.choice(8, rng.integers(0, 5), replace=False).tolist()) for _ in range(300)]
    labels = np.array([float({1, 2} <= set(r) or 5 in r) for r in rows])
    settings = T.Settings(epochs=4, rank=3)
    fast, slow = T.fit(rows, labels, {i: i for i in range(8)}, settings), plain_fit(rows, labels, 8, settings)
    assert np.allclose(fast.weights, slow.weights) and np.allclose(fast.vectors, slow.vectors)


def test_the_pair_part_tells_what_the_linear_part_cannot():
    """Toxic is exactly one of two words with a third: no sum of single weights can say so."""
    rows, labels = [], []
    for a, b in itertools.product((0, 1), (0, 1)):
        rows += [[0] * a + [1] * b] * 100
        labels += [float(a == b)] * 100
    rows = [sorted({*r}) for r in rows]
    whole = T.fit(rows, np.array(labels), {0: 0, 1: 1}, T.Settings())
    linear = T.Machine(whole.index, whole.bias, whole.weights, np.zeros_like(whole.vectors))
    alone = T.fit(rows, np.array(labels), {0: 0, 1: 1}, T.Settings(rank=1, epochs=0))
    right = lambda m: np.mean([(m.score(r) >= 0.5) == bool(y) for r, y in zip(rows, labels) if r])
    assert right(whole) == 1 and right(linear) < 1 and alone.weights.tolist() == [0, 0]
