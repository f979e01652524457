"""The random field of pages against enumeration of all labellings, and its gradient."""

from __future__ import annotations

from itertools import product

import numpy as np
import pytest

import seasonlab.llm.pages as p


def all_scores(unary: np.ndarray, links: np.ndarray) -> dict[tuple, float]:
    out = {}
    for labels in product((0, 1), repeat=len(unary)):
        score = links[0][labels[0]] + sum(unary[k][y] for k, y in enumerate(labels))
        out[labels] = score + sum(links[1 + a][b] for a, b in zip(labels, labels[1:]))
    return out


@pytest.mark.parametrize("sizes", [[1], [4, 1, 3], [7, 2]])
def test_sums_equal_enumeration(sizes):
    rng = np.random.default_rng(len(sizes))
    links, longest = rng.normal(size=(3, 2)), max(sizes)
    live = np.arange(longest) < np.array(sizes)[:, None]
    unary = rng.normal(size=(len(sizes), longest, 2)) * live[..., None]
    whole, share, pairs = p.forward_backward(unary, links, live)
    want = np.zeros((2, 2))
    for i, n in enumerate(sizes):
        scores = all_scores(unary[i, :n], links)
        total = np.logaddexp.reduce(list(scores.values()))
        assert whole[i] == pytest.approx(total)
        for k in range(n):
            assert share[i, k, 1] == pytest.approx(sum(np.exp(s - total) for y, s in scores.items() if y[k]))
        assert not share[i, n:].any()
        for y, s in scores.items():
            for a, b in zip(y, y[1:]):
                want[a, b] += np.exp(s - total)
    assert pairs == pytest.approx(want)


def sequences(rng, sizes):
    names = ["a", "b", "c", "d"]
    return [([[names[j] for j in range(4) if rng.random() < 0.5] for _ in range(n)], [int(rng.random() < 0.5) for _ in range(n)]) for n in sizes]


def loss(field: p.Field, data, decay: float) -> float:
    total = 0.0
    for x, y in data:
        unary = np.array([field.weights[[field.index[f] for f in b]].sum(axis=0) + field.weights[-1] for b in x])
        scores = all_scores(unary, field.links)
        total += np.logaddexp.reduce(list(scores.values())) - scores[tuple(y)]
    return total / len(data) + decay / 2 * ((field.weights**2).sum() + (field.links**2).sum())


def test_learning_ends_where_the_likelihood_is_flat():
    data = sequences(np.random.default_rng(3), [5, 1, 3, 6, 2, 4])
    field = p.fit(data, steps=4_000, rate=0.02, decay=0.05)
    best = loss(field, data, 0.05)
    for table in (field.weights, field.links):
        for at in np.ndindex(table.shape):
            for change in (0.01, -0.01):
                table[at] += change
                assert loss(field, data, 0.05) > best - 1e-7
                table[at] -= change


def test_decoding_equals_enumeration():
    rng = np.random.default_rng(4)
    field = p.Field({}, rng.normal(size=(1, 2)), rng.normal(size=(3, 2)))
    for n in (1, 2, 5, 8):
        blocks = [p.Block(("p",), frozenset(), f"text {k}", 0) for k in range(n)]
        scores = all_scores(np.repeat(field.weights[-1:], n, axis=0), field.links)
        assert tuple(field.decode(blocks)) == max(scores, key=scores.get)
    assert field.decode([]) == []


def test_a_very_long_page_widens_no_other():
    """900 short pages beside one of 20,000 blocks: places held are fewer than twice the blocks."""
    sizes = [3] * 900 + [20_000, 0]
    groups = p._by_length(sizes)
    assert sum(live.size for _, live in groups) < 2 * sum(sizes) and sum(int(live.sum()) for _, live in groups) == sum(sizes)
    assert sorted(np.concatenate([at[live] for at, live in groups]).tolist()) == list(range(sum(sizes)))


def test_pages_without_blocks_are_no_sequences():
    rng = np.random.default_rng(5)
    data = sequences(rng, [3, 2])
    one, two = p.fit(data, steps=30), p.fit([*data, ([], [])], steps=30)
    assert one.weights.shape == two.weights.shape and p.fit([([], [])]).weights[-1, 1] == 1
