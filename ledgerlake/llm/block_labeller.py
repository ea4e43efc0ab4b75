"""A bidirectional LSTM in numpy that reads a page's leaf blocks in order and says which are main text.

A block is the sum of its path names' vectors, the mean of its words' vectors (names and words hashed to
buckets), and four numbers: its length, the share within links, whether it ends like a sentence, its place.
Both directions read the whole page, so a block is judged by what surrounds it as well.  Vectors of names and
words that training never saw are zero: they say nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .html_blocks import PATH_NAMES, Leaf
from .packed import whole_block

PATH_DIMS, WORD_DIMS, NUMBERS, HIDDEN, WORD_BUCKETS = 16, 8, 4, 16, 4096
INPUT = PATH_DIMS + WORD_DIMS + NUMBERS
BATCH_BLOCKS = 1 << 14


@dataclass
class Features:
    """Blocks of several pages, page after page; ``pages_at`` has one entry more than pages."""

    pages_at: np.ndarray
    names: np.ndarray
    names_at: np.ndarray
    words: np.ndarray
    words_at: np.ndarray
    numbers: np.ndarray


def features(pages: Sequence[Sequence[Leaf]]) -> Features:
    leaves = [leaf for page in pages for leaf in page]
    if not leaves:
        none, at = np.empty(0, np.int64), np.zeros(1, np.int64)
        return Features(np.zeros(len(pages) + 1, np.int64), none, at, none, at, np.empty((0, NUMBERS)))
    block = whole_block(pa.array([leaf.text for leaf in leaves], pa.large_string())).lowered()
    names = [(*leaf.path, leaf.own) for leaf in leaves]
    counts = np.array([len(page) for page in pages], np.int64)
    pages_at = np.concatenate([[0], np.cumsum(counts)])
    length = np.array([len(leaf.text) for leaf in leaves], float)
    linked = np.array([leaf.linked for leaf in leaves], float)
    sentence = np.array([leaf.text[-1] in ".!?。！？…" for leaf in leaves], float)
    place = (np.arange(len(leaves)) - np.repeat(pages_at[:-1], counts)) / np.maximum(np.repeat(counts, counts), 1)
    return Features(
        pages_at,
        np.array([i for ids in names for i in ids], np.int64), np.concatenate([[0], np.cumsum([len(ids) for ids in names], dtype=np.int64)]),
        (block.word_hash % np.uint64(WORD_BUCKETS)).astype(np.int64), block.words_at,
        np.column_stack([np.log1p(length) / 6, linked / np.maximum(length, 1), sentence, place]).reshape(len(leaves), NUMBERS),
    )


def _bag_sums(table: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    out = np.zeros((len(at) - 1, table.shape[1]))
    some = np.flatnonzero(np.diff(at) > 0)
    if len(some):
        out[some] = np.add.reduceat(table[ids], at[some], axis=0)
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    def __init__(self, seed: int = 0) -> None:
        draw = np.random.default_rng(seed)
        near = lambda *shape: draw.normal(scale=shape[0] ** -0.5, size=shape)
        self.p = {"names": np.zeros((PATH_NAMES, PATH_DIMS)), "words": np.zeros((WORD_BUCKETS, WORD_DIMS)),
                  "out": near(2 * HIDDEN, 1), "bias": np.zeros(1)}
        for way in "fb":
            self.p |= {f"x{way}": near(INPUT, 4 * HIDDEN), f"h{way}": near(HIDDEN, 4 * HIDDEN), f"c{way}": np.zeros(4 * HIDDEN)}
            self.p[f"c{way}"][HIDDEN : 2 * HIDDEN] = 1  # remember at first

    def inputs(self, f: Features) -> np.ndarray:
        words = _bag_sums(self.p["words"], f.words, f.words_at) / np.maximum(np.diff(f.words_at), 1)[:, None]
        return np.hstack([_bag_sums(self.p["names"], f.names, f.names_at), words, f.numbers])

    def _direction(self, way: str, x: np.ndarray, mask: np.ndarray, keep: bool):
        """States (time x page x unit) of one direction; with ``keep`` also what the way back needs."""
        steps, n, _ = x.shape
        gates = x @ self.p[f"x{way}"] + self.p[f"c{way}"]
        h, c = np.zeros((n, HIDDEN)), np.zeros((n, HIDDEN))
        states, trace = np.zeros((steps, n, HIDDEN)), []
        for t in range(steps) if way == "f" else range(steps - 1, -1, -1):
            z = gates[t] + h @ self.p[f"h{way}"]
            s = _sigmoid(z[:, : 3 * HIDDEN])
            i, g, o = s[:, :HIDDEN], s[:, HIDDEN : 2 * HIDDEN], s[:, 2 * HIDDEN :]
            a = np.tanh(z[:, 3 * HIDDEN :])
            m = mask[t][:, None]
            new_c = g * c + i * a
            tc = np.tanh(new_c)
            if keep:
                trace.append((t, i, g, o, a, c, h, tc, m))
            c, h = m * new_c + (1 - m) * c, m * (o * tc) + (1 - m) * h
            states[t] = h
        return states, trace

    def _scores(self, x: np.ndarray, mask: np.ndarray, keep: bool = False):
        forth, trace_f = self._direction("f", x, mask, keep)
        back, trace_b = self._direction("b", x, mask, keep)
        both = np.concatenate([forth, back], axis=2)
        return (both @ self.p["out"])[:, :, 0] + self.p["bias"], both, {"f": trace_f, "b": trace_b}

    def score(self, f: Features) -> np.ndarray:
        """The log odds of each block to be main text; pages of like length go through together."""
        x, counts = self.inputs(f), np.diff(f.pages_at)
        out = np.zeros(len(x))
        for rows, mask in _batches(f.pages_at, np.argsort(counts, kind="stable"), BATCH_BLOCKS):
            scores, _, _ = self._scores(x[rows], mask)
            out[rows[mask > 0]] = scores[mask > 0]
        return out

    def gradients(self, f: Features, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean log loss of all blocks, by going back through time in both directions."""
        flat = self.inputs(f)
        (rows, mask), = _batches(f.pages_at, np.arange(len(f.pages_at) - 1), 1 << 40)
        x = flat[rows]
        scores, both, traces = self._scores(x, mask, keep=True)
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        wrong = (_sigmoid(scores) - labels[rows]) * mask / max(mask.sum(), 1)
        g["out"][:, 0] = np.einsum("tnh,tn->h", both, wrong)
        g["bias"][0] = wrong.sum()
        d_both = wrong[:, :, None] * self.p["out"][:, 0]
        dx = np.zeros_like(x)
        for way, part in (("f", d_both[:, :, :HIDDEN]), ("b", d_both[:, :, HIDDEN:])):
            dh, dc = np.zeros(part.shape[1:]), np.zeros(part.shape[1:])
            dz_all = np.zeros((*x.shape[:2], 4 * HIDDEN))
            for t, i, fg, o, a, c, h, tc, m in reversed(traces[way]):
                dh = dh + part[t]
                d_new = m * (dc + dh * o * (1 - tc**2))
                dz = np.hstack([d_new * a * i * (1 - i), d_new * c * fg * (1 - fg), m * dh * tc * o * (1 - o), d_new * i * (1 - a**2)])
                g[f"h{way}"] += h.T @ dz
                dz_all[t] = dz
                dc = d_new * fg + (1 - m) * dc
                dh = dz @ self.p[f"h{way}"].T + (1 - m) * dh
            g[f"x{way}"] = np.einsum("tni,tnj->ij", x, dz_all)
            g[f"c{way}"] = dz_all.sum(axis=(0, 1))
            dx += dz_all @ self.p[f"x{way}"].T
        by_row = np.zeros_like(flat)
        by_row[rows[mask > 0]] = dx[mask > 0]
        np.add.at(g["names"], f.names, np.repeat(by_row[:, :PATH_DIMS], np.diff(f.names_at), axis=0))
        n = np.diff(f.words_at)
        np.add.at(g["words"], f.words, np.repeat(by_row[:, PATH_DIMS : PATH_DIMS + WORD_DIMS] / np.maximum(n, 1)[:, None], n, axis=0))
        return g

    def fit(self, pages: Sequence[Sequence[Leaf]], labels: Sequence[np.ndarray], epochs: int = 8, batch: int = 32, rate: float = 0.01, seed: int = 0) -> BlockLabeller:
        """Adam over shuffled batches of pages, with falling steps; the same pages give the same model."""
        draw = np.random.default_rng(seed)
        mean, square = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        step, last = 0, max(1, epochs * -(-len(pages) // batch))
        for _ in range(epochs):
            order = draw.permutation(len(pages))
            for at in range(0, len(order), batch):
                chosen, step = order[at : at + batch], step + 1
                g = self.gradients(features([pages[k] for k in chosen]), np.concatenate([labels[k] for k in chosen]))
                for k, v in self.p.items():
                    mean[k] += 0.1 * (g[k] - mean[k])
                    square[k] += 0.01 * (g[k] ** 2 - square[k])
                    v -= rate * (1 - (step - 1) / last) * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-8)
        return self


def _batches(pages_at: np.ndarray, order: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(block numbers, mask), both time x page, of pages in order, as many as give ``limit`` places (one at least)."""
    counts = np.diff(pages_at)
    order = order[counts[order] > 0]
    first = 0
    while first < len(order):
        last, longest = first, 0
        while last < len(order) and (last == first or max(longest, counts[order[last]]) * (last + 1 - first) <= limit):
            longest = max(longest, int(counts[order[last]]))
            last += 1
        pages = order[first:last]
        step = np.arange(longest)[:, None]
        mask = step < counts[pages]
        yield pages_at[pages] + np.where(mask, step, 0), mask.astype(float)
        first = last
