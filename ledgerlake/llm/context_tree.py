"""Context-tree weighting over bytes, as array functions of sorted context grams.

A byte is coded as eight binary decisions, each with the bits already known and up to ``depth``
preceding bytes as its context.  A gram is a number whose bytes are the context, latest byte first,
and the coded byte last; sorted grams thus list the tree's subtrees one after another.  Every node
holds the Krichevsky-Trofimov estimate of its zeros and ones, and weighs it by one half against the
product of its children; the prediction mixes the estimates of all depths by what these weights have
become.  A node that training never reached predicts one half.
"""

from __future__ import annotations

import numpy as np

EDGE = 0xFF  # before and after every text; no UTF-8 byte
_SMALL = 64
_HALVES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(_SMALL) + 0.5))])  # log of (n - 1/2)! / (-1/2)!
_WHOLES = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, _SMALL + 1)))])


def _log_rising(n: np.ndarray, table: np.ndarray, shift: float) -> np.ndarray:
    """log Gamma(n + shift) - log Gamma(shift) for whole n, by table or Stirling's series."""
    out = table[np.minimum(n, _SMALL)]
    big = n > _SMALL
    if big.any():
        x = n[big] + shift
        series = (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3)
        out[big] = series - (0.5 * np.log(np.pi) if shift == 0.5 else 0.0)
    return out


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    return _log_rising(zeros, _HALVES, 0.5) + _log_rising(ones, _HALVES, 0.5) - _log_rising(zeros + ones, _WHOLES, 1.0)


def grams(data: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """The gram of every byte; ``starts`` begin texts, whose earlier context is ``EDGE``."""
    out = data.astype(np.uint64)
    for back in range(1, depth + 1):
        before = np.full(len(data), EDGE, np.uint8)
        before[back:] = data[:-back]
        for gap in range(back):  # the context does not reach into the text before
            at = starts[starts + gap < len(data)] + gap
            before[at] = EDGE
        out |= before.astype(np.uint64) << np.uint64(8 * (depth + 1 - back))
    return out


class Layer:
    """The nodes of one depth: distinct (context, byte) keys in order, their counts, and their parents' places."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.keys, self.counts = keys, counts
        self.parent: np.ndarray | None = None

    def above(self, context_bytes: int) -> Layer:
        """The layer of contexts that are one byte shorter than ``context_bytes``."""
        short = ((self.keys >> np.uint64(16)) << np.uint64(8)) | (self.keys & np.uint64(255))
        keys, self.parent = np.unique(short, return_inverse=True)
        return Layer(keys, np.bincount(self.parent, self.counts, len(keys)).astype(np.int64))

    def decisions(self, bit: int) -> None:
        """Groups the keys by the context and the bits before ``bit``, and estimates each group."""
        node = self.keys >> np.uint64(8 - bit)
        first = np.ones(len(node), bool)
        first[1:] = node[1:] != node[:-1]
        self.first = np.flatnonzero(first)
        self.group = np.cumsum(first) - 1
        self.bit = ((self.keys >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)
        self.total = np.add.reduceat(self.counts, self.first)
        self.ones = np.add.reduceat(self.counts * self.bit, self.first)
        self.estimate = log_estimate(self.total - self.ones, self.ones)

    def chance(self) -> np.ndarray:
        """The estimate of each key's own bit."""
        ones, total = self.ones[self.group], self.total[self.group]
        return (np.where(self.bit == 1, ones, total - ones) + 0.5) / (total + 1.0)


def layers(keys: np.ndarray, counts: np.ndarray, depth: int, least: int) -> list[Layer]:
    """The layers of contexts of ``least`` to ``depth`` bytes."""
    out = [Layer(keys, counts)]
    for d in range(depth, least, -1):
        out.append(out[-1].above(d))
    return out[::-1]


def weigh(tree: list[Layer], bit: int) -> list[np.ndarray]:
    """Log weighted probabilities of the nodes of all layers for one decision."""
    for layer in tree:
        layer.decisions(bit)
    out = [tree[-1].estimate]
    for upper, lower in zip(tree[-2::-1], tree[:0:-1], strict=True):
        holder = upper.group[lower.parent[lower.first]]
        below = np.bincount(holder, out[-1], len(upper.first))
        out.append(np.logaddexp(upper.estimate, below) + np.log(0.5))
    return out[::-1]


def top_sums(keys: np.ndarray, counts: np.ndarray, depth: int, top: int) -> tuple[np.ndarray, ...]:
    """What the tree above needs of the subtrees at ``top`` bytes: by (shorter context, decision) the sum
    of their log weighted probabilities, and the zeros and ones.  A decision is a one and the bits before it."""
    tree = layers(keys, counts, depth, top)
    parts = []
    for bit in range(8):
        weighted, layer = weigh(tree, bit)[0], tree[0]
        key = layer.keys[layer.first]
        context = (key >> np.uint64(16)).astype(np.int64)
        decision = (1 << bit) | ((key & np.uint64(255)).astype(np.int64) >> (8 - bit))
        node, where = np.unique(context << 8 | decision, return_inverse=True)
        sums = [np.bincount(where, x, len(node)) for x in (weighted, layer.total - layer.ones, layer.ones)]
        parts.append((node >> 8, node & 255, *sums))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def top_mixture(context, decision, below, zeros, ones, top: int) -> tuple[np.ndarray, np.ndarray]:
    """For contexts of ``top - 1`` bytes: the mixed probability so far and the weight left for longer ones.

    Both have the shape (contexts, bytes, bits).  Contexts of fewer bytes come first in the mixture.
    """
    n = 256 ** (top - 1)
    kept, chances = [], []
    below_at = np.zeros((n, 256))
    count = np.zeros((2, n, 256))
    below_at[context, decision], count[0, context, decision], count[1, context, decision] = below, zeros, ones
    for d in range(top - 1, -1, -1):
        estimate = log_estimate(count[0].astype(np.int64), count[1].astype(np.int64))
        weighted = np.logaddexp(estimate, below_at) + np.log(0.5)
        kept.append(np.exp(np.minimum(estimate - weighted + np.log(0.5), 0.0)))
        total = count.sum(axis=0) + 1.0
        chances.append((count + 0.5) / total)
        if d:  # drop the context's last, least significant byte
            below_at = weighted.reshape(-1, 256, 256).sum(axis=1)
            count = count.reshape(2, -1, 256, 256).sum(axis=2)
    byte = np.arange(256)
    mixed, left = np.zeros((n, 256, 8)), np.ones((n, 256, 8))
    contexts = np.arange(n)
    for keep, chance, d in zip(kept[::-1], chances[::-1], range(top), strict=True):
        at = contexts >> (8 * (top - 1 - d))
        for bit in range(8):
            decision = (1 << bit) | (byte >> (8 - bit))
            own = (byte >> (7 - bit)) & 1
            k = keep[at][:, decision]
            mixed[:, :, bit] += left[:, :, bit] * k * chance[own[None, :], at[:, None], decision[None, :]]
            left[:, :, bit] *= 1 - k
    return mixed, left


def weighted_nodes(below: np.ndarray, zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log weighted probabilities of nodes, given the sums over their children."""
    return np.logaddexp(log_estimate(zeros.astype(np.int64), ones.astype(np.int64)), below) + np.log(0.5)


def deeper_mixture(mixed, left, contexts, context, decision, below, zeros, ones) -> tuple[np.ndarray, np.ndarray]:
    """The mixture of ``top_mixture`` one byte deeper, for some sorted ``contexts`` only.

    ``context`` to ``ones`` are those contexts' nodes; ``mixed`` and ``left`` belong to contexts one byte shorter.
    """
    below_at, count = np.zeros((len(contexts), 256)), np.zeros((2, len(contexts), 256))
    at = np.searchsorted(contexts, context)
    below_at[at, decision], count[0, at, decision], count[1, at, decision] = below, zeros, ones
    estimate = log_estimate(count[0].astype(np.int64), count[1].astype(np.int64))
    keep = np.exp(np.minimum(estimate - weighted_nodes(below_at, *count) + np.log(0.5), 0.0))
    chance = (count + 0.5) / (count.sum(axis=0) + 1.0)
    byte, rows = np.arange(256), np.arange(len(contexts))[:, None]
    mixed, left = mixed[contexts >> 8], left[contexts >> 8]
    for bit in range(8):
        node = (1 << bit) | (byte >> (8 - bit))
        own = (byte >> (7 - bit)) & 1
        mixed[:, :, bit] += left[:, :, bit] * keep[:, node] * chance[own[None, :], rows, node[None, :]]
        left[:, :, bit] *= 1 - keep[:, node]
    return mixed, left


def log10_probabilities(
    keys: np.ndarray, counts: np.ndarray, depth: int, top: int, mixed: np.ndarray, left: np.ndarray, contexts: np.ndarray | None = None
) -> np.ndarray:
    """log10 of the probability that the tree gives each gram's byte in its context.

    ``mixed`` and ``left`` hold a row for every context of ``top - 1`` bytes, or for the sorted ``contexts``.
    """
    tree = layers(keys, counts, depth, top)
    context = (tree[0].keys >> np.uint64(16)).astype(np.int64)
    if contexts is not None:
        context = np.searchsorted(contexts, context)
    byte = (tree[0].keys & np.uint64(255)).astype(np.int64)
    out = np.zeros(len(keys))
    for bit in range(8):
        weighted = weigh(tree, bit)
        p, rest = mixed[context, byte, bit], left[context, byte, bit]
        for d, (layer, total) in enumerate(zip(tree, weighted, strict=True)):
            if d:
                p, rest = p[layer.parent], rest[layer.parent]
            if d == len(tree) - 1:
                keep = 1.0
            else:
                keep = np.exp(np.minimum(layer.estimate - total + np.log(0.5), 0.0))[layer.group]
            p = p + rest * keep * layer.chance()
            rest = rest * (1 - keep)
        out += np.log10(p)
    return out
