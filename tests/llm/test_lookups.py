"""Lookups in the n-gram trie (op10): right whatever the gaps and buckets, in a few numpy steps however many shards and words."""

from __future__ import annotations

import numpy as np

from siftwell.llm import elias_fano, lm_scoring


def test_rounds_of_a_lookup(monkeypatch):
    """A context with 300,000 words makes a gap of thousands of bits; 200 words that are neighbours share a bucket."""
    bits, rng = 22, np.random.default_rng(7)
    sets = {0: [5], 2: range(200), 3: rng.choice(1 << bits, 300_000, replace=False), 4: [0, (1 << bits) - 1], 5: rng.choice(1 << bits, 900, replace=False), 9: [17]}
    pairs = np.array([(c, w) for c, ws in sets.items() for w in sorted(ws)], np.int64)
    found = elias_fano.Children(elias_fano.encode_children(pairs[:, 0], pairs[:, 1], 12, bits))
    rounds, window = [], elias_fano._window
    monkeypatch.setattr(elias_fano, "_window", lambda words, at: rounds.append(len(at)) or window(words, at))
    at, hit = found.find(pairs[:, 0], pairs[:, 1])
    assert hit.all() and (at == np.arange(len(pairs))).all()
    c, w = rng.integers(0, 12, 50_000), rng.integers(0, 1 << bits, 50_000)
    _, hit = found.find(c, w)
    known = set(map(tuple, pairs.tolist()))
    assert hit.tolist() == [x in known for x in zip(c.tolist(), w.tolist())]
    assert len(rounds) < 20  # it was a round for every 64 bits of a gap and for every word of a bucket


def test_batches_of_counts():
    """Counts for 300 shards travel in a few batches, not in one for each shard; none is lost."""
    keys = lm_scoring.mix(np.arange(1, 20_001, dtype=np.uint64) % np.uint64(7000))
    batches = list(lm_scoring.dealt(iter([(keys, None)]), 300))
    assert len(batches) == 1 and batches[0].num_rows == 300
    got = [lm_scoring.gathered(lm_scoring.pa.Table.from_batches(batches).slice(i, 1)) for i in range(300)]
    want, counts = np.unique(keys, return_counts=True)
    assert (np.concatenate([k for k, _ in got]) == want).all() and (np.concatenate([c for _, c in got]) == counts).all()
