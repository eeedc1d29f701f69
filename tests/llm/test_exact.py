"""Operators with exact contracts against plain versions, on awkward rows and driver tables."""

from collections import Counter

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kiln.llm.catalog import all_queries
from kiln.llm.common import bit_table, has_bit
from kiln.llm.decontaminate import decontaminate
from kiln.llm.fmindex import FMIndex, repeated_windows, suffix_array
from kiln.llm.graph import components
from kiln.llm.jaccard import jaccard_components
from kiln.llm.licenses import TEMPLATES, bigrams, license_scan
from kiln.llm.substrings import remove_repeats
from kiln.llm.words import NOT_ALNUM, Words, leftmost_minimum

SF = "/root/testdata/sf0.001"


def bag(rows):
    return Counter(map(tuple, rows))


def test_words_of_awkward_texts(rows):
    texts = [t for _, t in rows]
    for separators, pattern in ((None, brute.WORD), (NOT_ALNUM, brute.ALNUM)):
        words = Words(lower=True) if separators is None else Words(separators)
        for limit in (1, 1000, 1 << 20):
            found, hashes = [], {}
            for part in words.slices(pa.array(texts), limit):
                for i in range(len(part)):
                    mine = range(part.first[i], part.first[i + 1])
                    found.append([brute.fold(part.data[part.starts[j]: part.ends[j]].tobytes().decode()) for j in mine])
                    for w, j in zip(found[-1], mine):
                        assert hashes.setdefault(w, part.hashes[j]) == part.hashes[j]
            assert found == [pattern.findall(brute.fold(t)) for t in texts]
            assert len(set(hashes.values())) == len(hashes)


def test_leftmost_minimum():
    values = np.random.default_rng(1).integers(0, 5, 200)
    for width in (1, 2, 7, 26):
        assert leftmost_minimum(values, width).tolist() == [i + int(values[i: i + width].argmin()) for i in range(len(values) - width + 1)]


def test_fm_index_counts_and_windows():
    rng = np.random.default_rng(2)
    for sigma in (2, 3, 9, 40):
        text = np.append(rng.integers(1, sigma, 300), 0)
        order = suffix_array(text, len(text))
        assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
        index = FMIndex(text, sigma, len(text))
        for _ in range(50):
            at, n = rng.integers(0, 290), rng.integers(1, 6)
            low, high = np.zeros(1, np.int64), np.array([len(text)])
            for c in text[at: at + n][::-1]:
                low, high = index.extend(np.array([c]), low, high)
            assert high[0] - low[0] >= sum((text[i: i + n] == text[at: at + n]).all() for i in range(len(text) - n + 1)) >= 1
    sizes = [3, 12, 40, 9, 30, 30]
    parts = [rng.integers(1, 4, n) for n in sizes]
    parts[5][:20] = parts[4][5:25]
    text = np.concatenate([np.append(p, 0) for p in parts])
    ends = np.cumsum(np.array(sizes) + 1) - 1
    starts = ends - sizes
    uses = Counter(tuple(p[i: i + 6]) for p in parts for i in range(len(p) - 5))
    want = {(k, i) for k, p in enumerate(parts) for i in range(len(p) - 5) if uses[tuple(p[i: i + 6])] > 1}
    lane, start, n = repeated_windows(text, 4, starts, ends, 6)
    assert {(k, s - starts[k] + j) for k, s, m in zip(lane.tolist(), start.tolist(), n.tolist()) for j in range(m)} == want


def test_bit_table(spark):
    values = np.random.default_rng(3).integers(-2 ** 63, 2 ** 63 - 1, 500)
    table = bit_table(spark.createDataFrame([(int(v),) for v in values], "h bigint"), 20)
    assert has_bit(table, 20)(values.view(np.uint64)).all()
    assert has_bit(table, 20)(np.random.default_rng(4).integers(0, 2 ** 63, 5000).astype(np.uint64)).mean() < 0.01
    assert not any(bit_table(spark.createDataFrame([], "h bigint"), 20))


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 201), (201, 200), (202, 201)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("width,size", [(35, 10), (5, 2)])
def test_substrings(docs, rows, width, size):
    got = remove_repeats(docs, width, size).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert bag(got) == bag((k, *r) for (k, _), r in zip(rows, brute.repeats([t for _, t in rows], width)))


def test_substrings_of_hot_anchors_and_nothing(docs, no_docs, rows, monkeypatch):
    from kiln.llm import substrings

    monkeypatch.setattr(substrings, "MOST_SEGMENTS", 1)        # every anchor of several segments goes window by window
    monkeypatch.setattr(substrings, "SHARD_WORDS", 50)
    got = remove_repeats(docs, 5, 2).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect()
    assert bag(got) == bag((k, *r) for (k, _), r in zip(rows, brute.repeats([t for _, t in rows], 5)))
    assert remove_repeats(no_docs).count() == 0


def test_jaccard(docs, rows, monkeypatch):
    from kiln.llm import jaccard

    monkeypatch.setattr(jaccard, "CHUNK", 2)
    monkeypatch.setattr(jaccard, "LOCAL_USES", 2)
    got = jaccard_components(docs).collect()
    assert bag((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == bag((k, *r) for (k, _), r in zip(rows, brute.near(rows)))
    groups = Counter(r["component_id"] for r in got if r["doc_id"] is not None and r["n_shingles"])
    firsts = {(r["component_id"], r["doc_id"], r["text_hash"]) for r in got if r["first"] and r["doc_id"] is not None and r["n_shingles"]}
    assert len(firsts) == len(groups)


def test_jaccard_of_nothing(no_docs):
    assert jaccard_components(no_docs).count() == 0


def test_decontaminate(spark, docs, no_docs, rows):
    by = dict((k, t) for k, t in rows if t)
    items = [(1, by[9][100:400]), (2, "one"), (3, "A B, c d"), (4, ""), (5, None), (None, by[9][500:700]), (7, by[12]), (7, by[12]), (8, "日本語")]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string").withColumn("fp", F.lit(0)).withColumn("windows", F.lit(1))
    got = decontaminate(docs, benchmark).collect()
    want = [(k, *brute.contaminated(t, items)) for k, t in rows]
    assert bag((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == bag((*r[:3], tuple(r[3]), r[4]) for r in want)
    assert sum(r[4] for r in want) > 5
    assert decontaminate(no_docs, benchmark).count() == 0
    assert not decontaminate(docs, benchmark.limit(0)).filter("contaminated or n_hit > 0 or size(items) > 0").count()


def test_licenses(spark, docs, no_docs):
    by = {}
    for name, text in TEMPLATES:
        by.setdefault(name, []).append(text)
    gpl, mit, mpl = by["GPL-3.0"][1], by["MIT"][-1], by["MPL-2.0"][-1]
    texts = [(None, []), ("", []), ("MIT", []), ("Words.\nReleased under the MIT  License\nmore", ["MIT"]),
             ("RELEASED UNDER THE MIT LICENSE! released under the mit license", ["MIT"]), ("a\n\n" + gpl.replace("it and/or", "it\nand/or").replace("version.", "versions.") + "\n\nb", ["GPL-3.0"]),
             ("This work is licensed under the GNU General Public License, version 3.", ["GPL-3.0"]), ("Copyright 2020 A Person. Released under the MIT License.", ["MIT"]),
             ("Copyright 2020 A Person Released under the MIT License.", ["MIT"]), ("The text above ends here. Licensed under CC BY-NC 4.0. More of it.", ["CC-BY-NC-4.0"]),
             ("Licensed under the Apache License, Version 2.0. See LICENSE for details.", ["Apache-2.0"]), ("Licensed under the MIT License.", ["MIT"]), ("/*\n * " + mpl.replace(". ", ".\n * ") + "\n */", ["MPL-2.0"]),
             ("MIT License\n\nCopyright (c) 2020 A Person\n\n" + mit + "\n\nint main() {}", ["MIT"]), ("Mixed: released under the MIT License, docs licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0", "MIT"]),
             ("We write of the license and of the software under the sun, the mit and the public.", []), ("// " + by["ISC"][0].replace(", ", ",\n// "), ["ISC"]), (by["BSD-3-Clause"][1], ["BSD-3-Clause"]), (by["BSD-2-Clause"][0], ["BSD-2-Clause"])]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(texts)], "doc_id bigint, text string").withColumn("hits", F.lit(1))
    got = {r["doc_id"]: r for r in license_scan(df).collect()}
    assert [got[i]["licenses"] for i in range(len(texts))] == [want for _, want in texts]
    assert [(h["start"], h["end"], h["dice"]) for h in got[3]["hits"]] == [(1, 6, 1.0)] and [h["start"] for h in got[4]["hits"]] == [0, 5]
    n = len(bigrams(gpl))
    assert [h["dice"] for h in got[5]["hits"]] == [round(2 * (n - 1) / (2 * n - 1), 6)]
    assert license_scan(docs).count() == docs.count() and license_scan(no_docs).count() == 0


def test_licenses_against_all_runs(spark):
    """Every run of words compared with every template; edited notices among words of their own."""
    rng, templates = np.random.default_rng(3), [*TEMPLATES[:12], ("X", "a b a b a c a b")]
    vocabulary = sorted({w for _, t in templates for g in bigrams(t) for w in g.split()})
    texts = ["a b a b a b a c a b a b a c a b a b"]
    for _ in range(60):
        words = []
        for _ in range(3):
            words += list(rng.choice(vocabulary, rng.integers(0, 6)))
            notice = " ".join(bigrams(templates[rng.integers(len(templates))][1])).split()[::2]
            for _ in range(rng.integers(0, 4)):
                at = rng.integers(len(notice))
                notice[at:at + rng.integers(0, 2)] = list(rng.choice(vocabulary, rng.integers(0, 2)))
            words += notice
        texts.append(" ".join(words))

    def plain(text):
        grams, per = bigrams(text), {}
        for name, t in templates:
            want = Counter(bigrams(t))
            for i in range(len(grams)):
                have = Counter()
                for j in range(i, min(len(grams), i + 2 * want.total())):
                    have[grams[j]] += 1
                    if grams[i] in want and grams[j] in want:
                        dice = round(2 * (have & want).total() / (j + 1 - i + want.total()), 6)
                        if dice >= 0.8:
                            per[i] = min(per.get(i, (0,)), (-dice, name, j + 1))
        return [(i, e + 1, name, -d) for i, (d, name, e) in sorted(per.items())
                if not any(o < e and i < x[2] and (x[0], o) < (d, i) for o, x in per.items())]

    got = license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"), templates).collect()
    assert {r["doc_id"]: [tuple(h) for h in r["hits"]] for r in got} == {i: plain(t) for i, t in enumerate(texts)}


@pytest.mark.parametrize("name", ["op3_license_scan", "op8_substring_dedup", "op10_decontaminate"])
def test_oracles(spark, name):
    import duckdb

    from kiln.llm.catalog import all_oracle_sql

    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = all_queries()[name](spark, SF)
    want = con.execute(all_oracle_sql()[name])
    names = [x[0] for x in want.description]
    assert sorted(names) == sorted(got.columns)
    assert bag(got.select(names).collect()) == bag(want.fetchall())
