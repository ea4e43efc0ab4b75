import random

import numpy as np
import pyarrow as pa

from ledgerlake.llm.text import Block, blocks, covered, later, repeated

from corpora import WORD

TEXTS = ["a b  c\n\nd", None, "", " x ", "ü é\t世界", "a b  c", "\n", "b\x0bc\rd"]


def one(texts, limit=1 << 62) -> Block:
    (_, _, block), = blocks(pa.array(texts, pa.string()), limit)
    return block


def test_words_and_lines():
    block = one(TEXTS)
    for t, text in enumerate(TEXTS):
        raw = (text or "").encode()
        mine = range(block.words_at[t], block.words_at[t + 1])
        got = [block.data[block.word_from[w] : block.word_to[w]].tobytes().decode() for w in mine]
        assert got == WORD.findall(text or "") and block.n_bytes[t] == len(raw)
        lines = [block.data[a:b].tobytes() for a, b, o in zip(block.line_from, block.line_to, block.text_of(block.line_from)) if o == t]
        assert lines == raw.split(b"\n")


def test_equal_spans_have_equal_hashes():
    draw = random.Random(1)
    block = one(["".join(draw.choice("ab ") for _ in range(200)) for _ in range(5)])
    begin = np.arange(len(block.data) - 6)
    hashes = block.span_hash(begin, begin + 6)
    texts = [block.data[i : i + 6].tobytes() for i in begin]
    assert len(set(texts)) == len(set(hashes.tolist())) == len(set(zip(texts, hashes.tolist(), strict=True)))


def test_windows_stay_in_their_text():
    block = one(["a b c d", "b c d", "c d", ""])
    first, hashes = block.windows(3)
    assert first.tolist() == [0, 1, 4] and hashes[1] == hashes[2] != hashes[0]
    assert block.run_hash(np.array([1]), np.array([4])) == block.run_hash(np.array([4]), np.array([7]))


def test_blocks_cover_everything_once():
    texts = ["x" * n for n in (0, 5, 100, 1, 1, 50, 7)]
    parts = list(blocks(pa.array(texts), 20))
    assert [t for a, b, block in parts for t in range(a, b)] == list(range(7))
    assert sum(len(block) for *_, block in parts) == 7 and list(blocks(pa.array([], pa.string()))) == []


def test_marks():
    keys = np.array([3, 1, 3, 2, 1, 3], np.uint64)
    assert repeated(keys).tolist() == [True, True, True, False, True, True]
    assert later(keys).tolist() == [False, False, True, False, True, True]
    assert covered(np.array([0, 1, 5]), 3, 7).tolist() == [True] * 4 + [False] + [True] * 2


def alternating(n: int, flip: bool, a="ka", b="ro") -> list[str]:
    """Two words in the order of the bits of numbers' digit sums, which makes sums of powers of one base agree."""
    return [(a, b)[(bin(k).count("1") + flip) % 2] for k in range(n)]


def test_patterns_do_not_make_different_spans_alike():
    for n in (8, 64, 1024, 4096):
        one_text, other = (" ".join(alternating(n, flip)) for flip in (False, True))
        block = one([one_text, other, one_text])
        runs = [block.run_hash(block.words_at[:-1], block.words_at[1:], seed) for seed in range(4)]
        assert all(h[0] == h[2] != h[1] for h in runs) and len({int(h[0]) for h in runs}) == 4
        letters = one(["".join(alternating(n, flip, "a", "b")) for flip in (False, True, False)])
        for seed in (0, 1):
            h = letters.span_hash(letters.word_from, letters.word_to, seed)
            assert h[0] == h[2] != h[1]


def test_spans_of_every_length_anywhere():
    raw = random.Random(4).randbytes(64).replace(b"\n", b"x")
    block = Block(np.frombuffer(b"\n".join([raw, raw[1:], b""]), np.uint8), np.array([0, 65, 129]))
    at = {}
    for a in range(64):
        for b in range(a, 65):
            at.setdefault(raw[a:b], set()).add(int(block.span_hash(np.array([a]), np.array([b]))[0]))
            if a:
                at[raw[a:b]].add(int(block.span_hash(np.array([64 + a]), np.array([64 + b]))[0]))
    assert all(len(h) == 1 for h in at.values()) and len(set().union(*at.values())) == len(at)
