import random

import numpy as np
import pytest

from ragtide.llm import packed, wordhash


def test_spans_hash_by_content(monkeypatch):
    monkeypatch.setattr(wordhash, "CHUNK", 1000)
    monkeypatch.setattr(wordhash, "_powers", [])
    rng = random.Random(1)
    words = [bytes(rng.choice(b"abc") for _ in range(rng.choice([1, 2, 3, 5, 63, 64, 65, 200, 1500]))) for _ in range(3000)]
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = ends - [len(w) for w in words]
    h = wordhash.hash_spans(np.frombuffer(b" ".join(words), np.uint8), starts, ends)
    seen = {}
    for w, x in zip(words, h.tolist()):
        assert seen.setdefault(w, x) == x
    assert len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 35])
def test_windows_hash_by_content(n):
    values = [random.Random(2).randrange(3) for _ in range(10)] + [random.randrange(3) for _ in range(3000)]
    h = wordhash.hash_windows(wordhash.mix(np.array(values, np.uint64)), n, 1)
    assert len(h) == len(values) - n + 1
    seen = {}
    for i, x in enumerate(h.tolist()):
        assert seen.setdefault(tuple(values[i:i + n]), x) == x
    assert len(set(seen.values())) == len(seen)
    assert len(wordhash.hash_windows(np.zeros(n - 1, np.uint64), n, 0)) == 0


def test_packed_integers_round_trip():
    for values in ([], [0], [5, 1 << 63, (1 << 64) - 1, 7]):
        a = np.array(values, np.uint64)
        assert packed.unpack(packed.pack(a), len(a)).tolist() == values
