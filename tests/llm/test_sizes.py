"""What an operator holds or shuffles for a given input."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa

from kiln.llm import jaccard, tokens, toxicity
from kiln.llm.common import worker_state
from kiln.llm.words import WHITE, Words


def texts_of(n, size, seed):
    rng = random.Random(seed)
    return [" ".join(f"{rng.getrandbits(40):x}" for _ in range(size)) for _ in range(n)]


def grams_of(texts):
    found = {}
    for at, n, text, pair_word, word, bucket in toxicity.Grams().slices(pa.array(texts)):
        buckets = [np.sort(bucket[word == w]).tolist() for w in range(int(word.max(initial=-1)) + 1)]
        for i, w in zip(text.tolist(), pair_word.tolist()):
            found.setdefault(at + i, []).append(buckets[w])
    return {i: sorted(x) for i, x in found.items()}


def test_grams_take_memory_by_the_slice(monkeypatch):
    texts = pa.array(texts_of(600, 200, 3))
    assert texts.nbytes > 1 << 20
    tracemalloc.start()
    for x in toxicity.Grams().slices(texts):
        pass
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 100 << 20
    some = [None, "", " a", *texts_of(6, 30, 4), "a b a"]
    whole = grams_of(some)
    monkeypatch.setattr(toxicity, "SLICE", 1)
    assert grams_of(some) == whole and len(whole) == 8


def test_digests_give_up_the_encoder():
    worker_state()["encoder"] = object()
    assert list(tokens.digests("none")(iter([]))) == []
    assert not worker_state()


def test_prefix_rows_are_small_and_whole():
    fresh, base = texts_of(60, 300, 1), texts_of(3, 300, 2)
    texts = [*fresh, *base, *(b + " more" for b in base), *fresh[:30], "a b", None, ""]     # 30 copies
    none, buckets = np.empty(0, np.uint64), 51
    want, entries = {}, 0
    for part in Words(WHITE).slices(pa.array(texts)):
        text, token = jaccard.sets(Words(WHITE), part, 5)
        n, v = jaccard.set_sizes_and_ids(len(part), text, token)
        for i in range(len(part)):
            mine = token[text == i][: int(n[i] - jaccard.needed(n[i], 75) + jaccard.spare(n[i]))]
            if n[i] and int(v[i]) not in want:
                want[int(v[i])] = set((mine >> np.uint64(64 - jaccard.TOKEN_BITS)).tolist())
                entries += len(mine)
    rows = list(jaccard.prefixes(5, 75, none, buckets)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    assert sum(len(x) for r in rows for c in r.columns[1:] for x in c.to_pylist()) < 9 * entries
    got = pa.Table.from_batches(jaccard.shared_tokens(iter(rows))).to_pylist()
    uses = {}
    for tokens_of in want.values():
        for x in tokens_of:
            uses[x] = uses.get(x, 0) + 1
    low = (1 << jaccard.TOKEN_BITS) - 1
    assert {(r["token"] & low, r["v"], r["uses"]) for r in got} == {(x, v, uses[x]) for v, held in want.items() for x in held if uses[x] > 1}
    assert len(got) == len({(r["token"], r["v"]) for r in got}) > 300


def test_a_vertex_of_many_tokens_in_a_bucket():
    texts = [" ".join(f"w{i}" for i in range(3000)), " ".join(f"w{i}" for i in range(3001))]
    rows = list(jaccard.prefixes(5, 75, np.empty(0, np.uint64), 1)(iter([pa.RecordBatch.from_pydict({"text": texts})])))
    got = pa.Table.from_batches(jaccard.shared_tokens(iter(rows))).to_pylist()
    assert len(rows) == 1 and len({r["v"] for r in got}) == 2 and len(got) > 2900 and {r["uses"] for r in got} == {2}
