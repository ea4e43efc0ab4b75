"""Token ids of whole texts, word by word.

The tokenizer drops white space and never merges across it, so a text's ids are those of its words in
order.  Every word is encoded once for each worker process and then looked up by its hash.
"""

from __future__ import annotations

import os

import numpy as np

from .text import Block

CACHED_WORDS = 3_000_000
END = 1


class WordIds:
    """Ids by word hash, in flat arrays: about 30 bytes a word, started afresh beyond ``CACHED_WORDS``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.hashes, self.begin, self.size = np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat, self.used = np.empty(1 << 16, np.uint32), 0

    def _add(self, hashes: np.ndarray, words: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        size = np.fromiter(map(len, ids), np.int64, len(ids))
        total = int(size.sum())
        if self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty(max(len(self.flat), total), np.uint32)])
        self.flat[self.used : self.used + total] = np.fromiter((x for e in ids for x in e), np.uint32, total)
        begin = self.used + np.cumsum(size) - size
        self.used += total
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.begin, self.size = (
            np.insert(old, at, new) for old, new in ((self.hashes, hashes), (self.begin, begin), (self.size, size))
        )

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the block, each text followed by ``END``, and where each text's ids begin (one entry more)."""
        hashes, sample, which = np.unique(block.word_hash, return_index=True, return_inverse=True)
        if len(self.hashes) > CACHED_WORDS:
            self.clear()
        at = np.searchsorted(self.hashes, hashes)
        known = self.hashes[np.minimum(at, max(len(self.hashes) - 1, 0))] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        if not known.all():
            new = np.flatnonzero(~known)
            begin, end = block.word_from[sample[new]].tolist(), block.word_to[sample[new]].tolist()
            data = block.data.tobytes()
            self._add(hashes[new], [data[a:b].decode("utf-8") for a, b in zip(begin, end, strict=True)])
            at = np.searchsorted(self.hashes, hashes)
        begin, size = self.begin[at][which], self.size[at][which]
        owner = np.repeat(np.arange(len(block)), block.n_words)
        place = np.cumsum(size) - size + owner  # every earlier text has its end id
        total = int(size.sum()) + len(block)
        ids = np.full(total, END, np.uint32)
        step = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids[np.repeat(place, size) + step] = self.flat[np.repeat(begin, size) + step]
        counts = np.bincount(owner, size, len(block)).astype(np.int64) + 1
        return ids, np.concatenate([[0], np.cumsum(counts)])


_open: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The worker's table for a tokenizer file."""
    if path not in _open:
        _open[path] = WordIds(path)
    return _open[path]
