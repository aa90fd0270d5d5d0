"""A linear-chain conditional random field of two labels, in numpy.

A place's features add up to the score of label 1 against label 0. Neighbouring places share a score for their pair of
labels, of which there are several kinds; the caller says which kind lies between two places.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np


class Chain(NamedTuple):
    """Training data of one sequence: feature numbers per place, kind of each place's link with the one before, labels."""

    features: list[list[int]]
    kinds: list[int]
    labels: list[int]


class Model(NamedTuple):
    weights: np.ndarray  # per feature
    links: np.ndarray  # kind, label before, label
    ends: np.ndarray  # first or last place, label


def _log_add(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit(chains: list[Chain], n_features: int, kinds: int, steps: int = 200, rate: float = 0.2, decay: float = 0.05) -> Model:
    """Maximum of the labels' conditional log-probability less ``decay`` times half the squared weights, by Adam."""
    chains = [c for c in chains if c.labels]
    n, longest = len(chains), max((len(c.labels) for c in chains), default=1)
    place = [i * longest + t for i, c in enumerate(chains) for t, own in enumerate(c.features) for _ in own]
    place, feature = np.array(place, np.int64), np.array([f for c in chains for own in c.features for f in own], np.int64)
    length = np.array([len(c.labels) for c in chains], np.int64)
    there = np.arange(longest) < length[:, None]
    label, kind = np.zeros((n, longest), np.int64), np.zeros((n, longest), np.int64)
    for i, c in enumerate(chains):
        label[i, : len(c.labels)], kind[i, : len(c.kinds)] = c.labels, c.kinds
    rows = np.arange(n)
    seen = np.bincount(feature, label.ravel()[place], n_features)
    seen_links = np.zeros((kinds, 2, 2))
    np.add.at(seen_links, (kind[:, 1:][there[:, 1:]], label[:, :-1][there[:, 1:]], label[:, 1:][there[:, 1:]]), 1)
    seen_ends = np.array([np.bincount(label[:, 0], minlength=2), np.bincount(label[rows, length - 1], minlength=2)], float) if n else np.zeros((2, 2))

    sizes = (n_features, kinds * 4, 4)
    w = np.zeros(sum(sizes))
    m, v = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):
        weights, links, ends = w[: sizes[0]], w[sizes[0] : -4].reshape(kinds, 2, 2), w[-4:].reshape(2, 2)
        score = np.zeros((n, longest, 2))
        score[:, :, 1] = np.bincount(place, weights[feature], n * longest).reshape(n, longest)
        score[:, 0] += ends[0]
        score[rows, length - 1] += ends[1]
        ahead, back = np.zeros_like(score), np.zeros_like(score)
        ahead[:, 0] = score[:, 0]
        for t in range(1, longest):
            new = _log_add(ahead[:, t - 1, :, None] + links[kind[:, t]], 1) + score[:, t]
            ahead[:, t] = np.where(there[:, t, None], new, ahead[:, t - 1])
        whole = _log_add(ahead[:, -1], 1)
        for t in range(longest - 1, 0, -1):
            new = _log_add(links[kind[:, t]] + (score[:, t] + back[:, t])[:, None, :], 2)
            back[:, t - 1] = np.where(there[:, t, None], new, 0)
        share = np.exp(ahead + back - whole[:, None, None]) * there[:, :, None]
        both = ahead[:, :-1, :, None] + links[kind[:, 1:]] + (score[:, 1:] + back[:, 1:])[:, :, None, :] - whole[:, None, None, None]
        both = np.exp(np.minimum(both, 0)) * there[:, 1:, None, None]
        mean_links = np.array([both[kind[:, 1:] == k].sum(0) for k in range(kinds)])
        mean_ends = np.array([share[:, 0].sum(0), share[rows, length - 1].sum(0)])
        mean = np.bincount(feature, share[:, :, 1].ravel()[place], n_features)
        grad = np.concatenate([seen - mean, (seen_links - mean_links).ravel(), (seen_ends - mean_ends).ravel()]) - decay * w
        grad /= max(n, 1)
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        w = w + rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(w[: sizes[0]], w[sizes[0] : -4].reshape(kinds, 2, 2), w[-4:].reshape(2, 2))


def viterbi(scores: list[float], kinds: list[int], links: list, ends: list) -> list[int]:
    """The likeliest labels; of equal ones, those with label 1 last. ``links`` and ``ends`` as in ``Model``, as lists."""
    if not scores:
        return []
    off, on = ends[0][0], ends[0][1] + scores[0]
    from_on: list[tuple[bool, bool]] = []  # whether the best way to label 0, to label 1 comes from label 1
    for score, kind in zip(scores[1:], kinds[1:], strict=True):
        (stay_off, turn_on), (turn_off, stay_on) = links[kind]
        a, b, c, d = off + stay_off, on + turn_off, off + turn_on, on + stay_on
        from_on.append((b >= a, d >= c))
        off, on = max(a, b), max(c, d) + score
    label = int(on + ends[1][1] >= off + ends[1][0])
    out = [label]
    for way in reversed(from_on):
        label = int(way[label])
        out.append(label)
    return out[::-1]
