"""Vector codes against a plain product quantisation over every entry."""

import hashlib
import math
import random

import numpy as np
import pytest

from kiln.llm import codes


def plain(rows, entries=256, rounds=4):
    """(vec_id, embedding, label) -> bag of result rows, and nothing but loops over all entries."""
    kept = [(i, [math.floor(1024 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    m = -(-len(kept[0][1]) // 4)
    x = np.array([r[1] + [0] * (4 * m - len(r[1])) for r in kept])
    error, number, books = [0] * len(kept), [], []
    for p in range(4):
        part = x[:, p * m:(p + 1) * m]
        book = part[:entries].copy()
        for turn in range(rounds + 1):
            far = ((part[:, None] - book[None]) ** 2).sum(axis=2).tolist()
            near = [f.index(min(f)) for f in far]
            if turn < rounds:
                for e in set(near):
                    rows_ = part[[i for i, k in enumerate(near) if k == e]]
                    book[e] = [sum(c) // len(rows_) for c in zip(*rows_.tolist())]
        error = [a + min(f) for a, f in zip(error, far)]
        number.append(near)
        books.append(book)
    text = ",".join(str(v) for b in books for e in b for v in e)
    of_label = {}
    for (_, _, label), e in zip(kept, error):
        of_label[label] = of_label.get(label, 0) + e
    return [(r[0], "".join(f"{n[i]:02x}" for n in number), error[i], of_label[r[2]], hashlib.sha256(text.encode()).hexdigest()) for i, r in enumerate(kept)]


def run(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id bigint, embedding array<{kind}>, label int").selectExpr("*", "'clash' AS code", "1 AS v", "2 AS error", "3 AS l").repartition(3)
    return [tuple(r) for r in codes.compress(df).collect()]


def order(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("d", [8, 6, 16])
def test_codes(spark, d):
    rng = random.Random(d)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(12)]
    rows = [(rng.choice([k, k, k, 5, None]) if k > 300 else k, [float(np.float32(c + rng.gauss(0, 0.2))) for c in rng.choice(centres)], rng.choice([1, 2, None])) for k in range(420)]
    rows += [(900, None, 1), (901, [0.0] * (d - 1) + [math.nan], 1), (902, [math.inf] * d, 2), (903, [0.5] * (d - 1) + [None], 2), (904, [], 3), (905, [0.0] * (d + 4), 3)]
    rows += [(-7, [0.25] * d, None)] * 9 + [(1000 + k, [0.25] * d, 7) for k in range(40)]       # copies and ties
    assert order(run(spark, rows)) == order(plain(rows))


def test_few_none_and_huge(spark):
    few = [(3, [1.0, -2.0, 0.5, 9.0], None), (1, [1e30, 0.0, 0.0, -1e30], 4), (2, [1e-9, -1e-9, 0.0, 0.0], 4)]
    got = {r[0]: r for r in run(spark, few)}
    assert {k: r[1] for k, r in got.items()} == {1: "00000000", 2: "01010001", 3: "02020202"} and all(r[2] == 0 for r in got.values())
    assert run(spark, [(1, None, 1)]) == [] == run(spark, [])


def test_boxes_hold_exactly_the_entries_within():
    rng = np.random.default_rng(1)
    entries, x = rng.integers(-50, 50, (200, 5)), rng.integers(-60, 60, (300, 5))
    book, radius = codes.Codebook(entries), rng.integers(0, 40, 300)
    held = np.unpackbits(book.box(x, radius).view(np.uint8).reshape(300, -1), axis=1, bitorder="little")[:, :200].astype(bool)
    assert (held == (np.abs(x[:, None] - entries[None]).max(axis=2) <= radius[:, None])).all()
    which, far = book.nearest(x)
    every = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (which == every.argmin(axis=1)).all() and (far == every.min(axis=1)).all()


def test_query_whole_table(spark):
    from test_models import SF
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    got = codes.op12(spark, SF)
    assert order(tuple(r) for r in got.collect()) == order(plain(rows))
