"""Token files, chats, decision lists, language model, mixing, toxicity and the pipeline on awkward rows and driver tables."""

import itertools
import math
import random
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from pathlib import Path

import brute
from conftest import CLASHING
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kiln.llm import chat, ctw, mixing, quality, tokens, toxicity
from kiln.llm.common import shared_folder

SF = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


def bag(rows):
    return Counter(map(tuple, rows))


def test_pieces_encode_as_whole_texts(tokenizer, rows):
    encoder = tokens.Encoder(Path(TOKENIZER).read_text(encoding="utf-8"), 2)
    rng = random.Random(1)
    alphabet = " \n\t\r.,!?'aéZs1-*日 \x1c\x85\xa0" + chr(0x2003) + chr(0x3000)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 15))) for _ in range(4000)]
    texts += [t for _, t in rows] + ["a <|endoftext|> b<|endoftext|>.c", "don't I'll  we've\n\n 's", "x\r\n y \n"]
    assert encoder.packed(texts) == [packed(ids_of(tokenizer, t)) for t in texts]
    assert b"".join(encoder.long(texts[-1] * 50)) == packed(ids_of(tokenizer, texts[-1] * 50))


def test_token_files(spark, docs, no_docs, rows, tokenizer, monkeypatch):
    monkeypatch.setattr(tokens, "LONG_TEXT", 5000)
    folder = shared_folder(spark, "test")
    manifest = tokens.write_tokens(docs, folder, Path(TOKENIZER).read_text(encoding="utf-8"))
    got = tokens.read_digests(folder, manifest).orderBy("start").collect()
    want = [(k, (ids := ids_of(tokenizer, t)), zlib.crc32(packed(ids))) for k, t in rows]
    assert bag((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == bag((k, len(i), c) for k, i, c in want)
    assert [r["start"] for r in got] == list(itertools.accumulate([0] + [r["n_tokens"] for r in got]))[:-1]
    assert [r["doc_id"] for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k))
    shard = tokens.Shard(f"{folder}/{manifest.first()['name']}")
    by = dict((k, i) for k, i, _ in want if k not in (None, 3, 11))
    for i in reversed(range(len(shard.ids))):                         # one document at a time, in any order
        if shard.ids[i] in by:
            assert shard.read(i) == packed(by[shard.ids[i]])
    assert tokens.read_digests(folder, tokens.write_tokens(no_docs, shared_folder(spark, "none"), Path(TOKENIZER).read_text(encoding="utf-8"))).count() == 0


def test_shards_are_plain_zstandard_and_damage_shows(spark, docs):
    import io

    import zstandard

    folder = shared_folder(spark, "test")
    name = tokens.write_tokens(docs, folder, Path(TOKENIZER).read_text(encoding="utf-8")).first()["name"]
    files, base = tokens.filesystem(folder)
    raw = files.open_input_file(f"{base}/{name}").readall()
    shard = tokens.Shard(f"{folder}/{name}")
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True).read()
    assert whole == b"".join(ids for _, ids in shard.documents())
    at = int(shard.starts[1]) - 1
    with files.open_output_stream(f"{base}/bad") as out:
        out.write(raw[:at] + bytes([raw[at] ^ 255]) + raw[at + 1:])
    with pytest.raises(Exception):
        tokens.Shard(f"{folder}/bad").read(0)


def cheapest(roles):
    """Least cost over all action sequences, by trying them."""
    best = math.inf

    def go(i, state, cost):
        nonlocal best
        if cost >= best:
            return
        if i == len(roles):
            best = min(best, cost + chat.INSERT * len(chat.ENDS[state]))
            return
        for action in chat.ACTIONS:
            if action[0] == state:
                go(i + 1, action[1], cost + chat.price(roles[i], action))
    go(0, chat.START, 0.0)
    return best


def chats(turns, **sizes):
    got = defaultdict(list)
    for r in chat.format_chats(turns, **sizes).collect():
        got[r["conv_id"]].append(r)
    return got


def test_chat_repair_is_cheapest_and_legal(spark):
    rng = random.Random(3)
    names = ["system", "user", "assistant", "tool", None]
    talks = {i: [rng.choice(names) for _ in range(rng.randrange(1, 7))] for i in range(40)} | {None: ["user", "user"]}
    turns = spark.createDataFrame([(c, k, r, f"t{k} <|im_end|>" if k else None) for c, rs in talks.items() for k, r in enumerate(rs)], "conv_id bigint, turn bigint, role string, text string")
    for sizes in ({}, {"stretch": 1, "fan": 2}):
        got = chats(turns.withColumn("cost", F.lit("x")), **sizes)
        assert got.keys() == talks.keys()
        for c, rs in talks.items():
            parts = sorted(got[c], key=lambda r: r["turn"])
            assert len(parts) == len(rs) and sum(p["cost"] for p in parts) == pytest.approx(cheapest(rs))
            text = "".join(p["rendered"] for p in parts)
            said = [x.split("<|im_start|>")[1].split("\n")[0] for x in text.split("<|im_end|>\n")[:-1]]
            said = said[1:] if said[0] == "system" else said
            assert text.endswith("<|im_end|>\n") and text.count("<|im_start|>") == text.count("<|im_end|>")
            assert said == ["user", "assistant"] * (len(said) // 2)
            assert all(f"t{k} < |im_end|>" in text for k in range(1, len(rs)))


def test_chat_of_long_talk_ties_and_nothing(spark):
    rng = random.Random(4)
    roles = [rng.choice(["user", "assistant"]) for _ in range(500)]
    rows = [(1, k, r, str(k)) for k, r in enumerate(roles)] + [(2, 5, "user", "a"), (2, 5, "user", "a"), (2, None, "assistant", "b")]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    one, many = chats(turns, stretch=1000), chats(turns, stretch=7, fan=3)
    assert [sum(r["cost"] for r in x[1]) for x in (one, many)] == pytest.approx([sum(r["cost"] for r in one[1])] * 2)
    assert len(many[2]) == 3 and sum(r["cost"] for r in many[2]) == pytest.approx(cheapest(["assistant", "user", "user"]))
    assert chat.format_chats(turns.limit(0)).count() == 0


def test_quality_counts(docs, no_docs, rows, spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    got = quality.quality(docs, labels).collect()
    want = [(k, *brute.base_counts(t)) for k, t in rows]
    want = [(*w, bad := w[1] < 50 or 100 * w[5] > 50 * w[1], not bad) for w in want]
    assert bag(got) == bag(want)
    assert quality.quality(no_docs, labels).count() == 0


def test_quality_learns_a_conjunction(spark):
    rng = random.Random(6)
    clean = [" ".join(f"w{rng.randrange(9999)}" for _ in range(80)) for _ in range(200)]
    noisy = [t.replace(" ", " # ") for t in clean[:60]]
    shout = [t.upper() for t in clean[60:120]]
    rows = list(enumerate(clean + noisy + shout))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i < 200), 0) for i, _ in rows] + [(0, None, 0), (None, 0, 0)], "doc_id bigint, quality int, toxic int").withColumn("n_words", F.lit(1))
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(docs, labels).collect()}
    assert all(kept[i] == (i < 200) for i, _ in rows)


def plain_ctw(train, text, depth):
    """Log10 probability of a text with the nodes in dictionaries."""
    counts, kids, memo = defaultdict(lambda: [0, 0]), defaultdict(set), {}

    def symbols(t):
        b = [255] * depth + list(t.encode()) + [255]
        return [(tuple(b[j - depth: j][::-1]), b[j]) for j in range(depth, len(b))]

    def decisions(x):
        return [(1 << k | x >> (8 - k), x >> (7 - k) & 1) for k in range(8)]
    for t in train:
        for context, x in symbols(t):
            for place, bit in decisions(x):
                for d in range(depth + 1):
                    counts[place, context[:d]][bit] += 1
                    if d:
                        kids[place, context[: d - 1]].add(context[d - 1])

    def kt(z, o):
        return math.lgamma(z + 0.5) + math.lgamma(o + 0.5) - math.lgamma(z + o + 1) - math.log(math.pi)

    def weighted(place, context):
        key = place, context
        if key not in memo:
            own = kt(*counts[key])
            below = sum(weighted(place, (*context, c)) for c in kids[key])
            memo[key] = own if len(context) == depth else np.logaddexp(own, below) + math.log(0.5)
        return memo[key]

    def one(place, context, d=0):
        z, o = counts.get((place, context[:d]), (0, 0))
        if d == depth:
            return (o + 0.5) / (z + o + 1)
        w = math.exp(kt(z, o) + math.log(0.5) - weighted(place, context[:d])) if z + o else 0.5
        return w * (o + 0.5) / (z + o + 1) + (1 - w) * one(place, context, d + 1)
    return sum(math.log10(p if bit else 1 - p) for context, x in symbols(text) for place, bit in decisions(x) for p in [one(place, context)])


@pytest.mark.parametrize("depth,block", [(2, 1 << 30), (5, 3000)])
def test_context_trees(spark, depth, block, rows):
    rows = [(k, t if t is None else t[:400]) for k, t in rows]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("block", F.lit("x"))
    got = ctw.score(docs, F.coalesce(F.col("doc_id") % 4 == 1, F.lit(False)), depth, block).collect()
    train = [brute.fold(t) for k, t in rows if k is None or math.fmod(k, 4) != 1]
    uses = Counter(w for t in train for w in (*brute.WORD.findall(t), None))
    n, v, seen = sum(uses.values()), len(uses), {}
    for k, t in rows:
        words = [*brute.WORD.findall(brute.fold(t)), None]
        base = sum(math.log10((uses[w] + 0.5) / (n + 0.5 * (v + 1))) for w in words)
        seen.setdefault((k, len(words), sum(uses[w] > 0 for w in words), n), []).append((base, plain_ctw(train, brute.fold(t), depth)))
    for r in got:
        want = seen[r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"]]
        assert any((r["base_score"], r["score"]) == pytest.approx(w, rel=1e-9) for w in want)
    assert len(got) == len(rows)


def test_context_trees_of_nothing(docs, no_docs):
    assert ctw.score(no_docs, F.lit(True)).count() == 0
    got = ctw.score(docs, F.lit(True)).collect()                      # nothing to learn from
    assert len(got) == docs.count() and all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] < 0 for r in got)


def test_context_trees_learn(spark):
    got = ctw.score(spark.read.parquet(f"{SF}/documents.parquet"), F.crc32(F.col("doc_id").cast("string")) % 5 == 1)
    assert got.filter("held_out").agg(F.avg("bits_per_byte")).first()[0] < 3.5


def test_schedule_deviates_by_less_than_a_block():
    rng = random.Random(7)
    for _ in range(30):
        share = mixing.shares({f"s{i}": rng.random() + 0.01 for i in range(rng.randrange(1, 12))}, 200)
        slots = mixing.period(share)
        q = sum(share.values())
        order = {t: s for s, at in slots.items() for t in at}
        assert sorted(order) == list(range(q)) and all(len(slots[s]) == share[s] for s in share)
        run = Counter()
        for t in range(q):
            run[order[t]] += 1
            assert all(abs(run[s] * q - share[s] * (t + 1)) < q for s in share)


def test_mixing(spark, docs, no_docs):
    rng = random.Random(8)
    sources = ["a"] * 400 + ["b"] * 90 + [None] * 60 + [""] * 7
    rng.shuffle(sources)
    big = spark.createDataFrame(list(enumerate(sources)), "doc_id bigint, source string").withColumn("slot", F.lit("x"))
    weights = {"a": 5, "b": 3, None: 2}
    got = mixing.mix(big, weights, block=4, resolution=100).orderBy("position").collect()
    assert sorted(r["doc_id"] for r in got) == list(range(len(sources))) and len({r["position"] for r in got}) == len(got)
    share, plan = mixing.shares({s: weights.get(s, 2) for s in set(sources)}, 100), []
    left, done = {s: -(-n // 4) for s, n in Counter(sources).items()}, Counter()
    while left:                                                       # slot by slot, the plain way
        slots = mixing.period({s: share[s] for s in left})
        order = {t: s for s, at in slots.items() for t in at}
        for t in itertools.count():
            s = order[t % len(order)]
            plan.append(s)
            done[s] += 1
            if done[s] == -(-sources.count(s) // 4):
                left.pop(s)
                break
    assert [next(rs)["source"] for _, rs in itertools.groupby(got, key=lambda r: r["slot"])] == plan
    assert [r["slot"] for r in got] == sorted(r["slot"] for r in got)
    assert mixing.mix(no_docs).count() == 0 and mixing.mix(docs).count() == docs.count()


def fluid_by(weights, blocks, slot):
    """What each source has of the slots before ``slot`` in the fluid schedule, exactly; weights by Fraction."""
    low, left = Fraction(0), dict(blocks)
    while left:
        rate = sum(weights[s] for s in left)
        used = sum(blocks[s] for s in blocks if s not in left)
        v = (slot - used) / rate
        gone = [s for s in left if blocks[s] <= v * weights[s]]
        if not gone:
            return {s: min(Fraction(n), v * weights[s]) for s, n in blocks.items()}
        for s in gone:
            left.pop(s)
    return {s: Fraction(n) for s, n in blocks.items()}


@pytest.mark.parametrize("run", [1, 50, 10_000])
def test_slots_keep_the_weights_at_every_prefix(spark, run):
    third = {f"s{i:02}": (math.sqrt(17_000), 700) for i in range(19)} | {"big": (math.sqrt(17_000 * 9.5), 6_000)}
    tiny = {"a": (1.0, 900), "b": (0.7, 2_000), None: (0.0004, 3), "": (0.31, 1)}
    rng = random.Random(9)
    mixed = {f"s{i}": (rng.random() ** 3 + 0.01, rng.randrange(1, 300)) for i in range(12)}
    for case in (third, tiny, mixed):
        rows = [(s, w, n) for s, (w, n) in case.items()]
        got = mixing.schedule(spark.createDataFrame(rows, "source string, weight double, blocks bigint"), run).orderBy("slot").collect()
        blocks, weights = {s: n for s, _, n in rows}, {s: Fraction(w) for s, w, _ in rows}
        assert [r["slot"] for r in got] == list(range(sum(blocks.values())))
        assert bag((r["of"], r["k"]) for r in got) == bag((s, k) for s, n in blocks.items() for k in range(n))
        done = Counter()
        for r in got:
            assert r["k"] == done[r["of"]]
            done[r["of"]] += 1
            if r["slot"] % 7 == 0 or len(got) < 2_500:
                target = fluid_by(weights, blocks, r["slot"] + 1)
                assert all(abs(done[s] - target[s]) < 1 + 1e-6 for s in blocks)


def test_mixing_keeps_the_weights(spark):
    sources = [f"s{i:02}" for i in range(19) for _ in range(420)] + ["big"] * 3_990 + [None] * 3
    rows = spark.createDataFrame(list(enumerate(sources)), "doc_id bigint, source string")
    got = mixing.mix(rows, block=1).orderBy("position").collect()
    blocks, done = Counter(sources), Counter()
    weights = {s: Fraction(n ** 0.5) for s, n in blocks.items()}
    assert sorted(r["doc_id"] for r in got) == list(range(len(sources)))
    for i, r in enumerate(got):
        done[r["source"]] += 1
        if i % 7 == 0:
            target = fluid_by(weights, blocks, i + 1)
            assert all(abs(done[s] - target[s]) < 1 + 1e-6 for s in blocks)


def test_mixing_of_many_sources(spark):
    rows = spark.range(14_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("host"), F.when(F.col("id") < 4_000, 0).otherwise(F.col("id") % 5_000)).alias("source"))
    got = mixing.mix(rows, block=1).orderBy("position").collect()
    assert [r["slot"] for r in got] == list(range(14_000)) and sorted(r["doc_id"] for r in got) == list(range(14_000))
    with pytest.raises(ValueError):
        mixing.mix(rows, block=1, resolution=1000)
    blocks, done = Counter(r["source"] for r in got), Counter()
    weights = {s: Fraction(n ** 0.5) for s, n in blocks.items()}
    for i, r in enumerate(got):
        done[r["source"]] += 1
        if i % 700 == 0:
            target = fluid_by(weights, blocks, i + 1)
            assert all(abs(done[s] - target[s]) < 1 + 1e-6 for s in blocks)


def test_toxicity(spark, docs, no_docs):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = toxicity.toxicity(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), labels)
    both = scored.join(labels, "doc_id").select(toxicity.held_out(F.col("doc_id")).alias("held"), "toxic", (F.col("score") >= 0.5).cast("int").alias("said")).collect()
    for held in (True, False):
        part = [r for r in both if r["held"] == held]
        assert sum(r["toxic"] == r["said"] for r in part) >= 0.9 * len(part)
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r["score"] for r in toxicity.toxicity(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(i, i % 2) for i in range(12)] * 2 + [(5, None), (None, 1), (99, 1)], "doc_id bigint, toxic int").withColumn("text", F.lit("x"))
    got = toxicity.toxicity(docs, odd)
    assert got.columns == [c for c in docs.columns if c != "score"] + ["score"]
    assert got.filter("score is null or score < 0 or score > 1").count() == 0 and got.count() == docs.count()
    assert toxicity.toxicity(no_docs, odd).count() == 0


def staged(spark, docs, sf_dir):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = shared_folder(spark, name)
        stage(spark, out[-1], sf_dir).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_pipeline_stages(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    _, clean, single, apart, mixed, files = staged(spark, docs, SF)
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    ids = [sorted(r["doc_id"] for r in x.collect()) for x in (clean, single, apart, mixed, files)]
    assert ids[0] == sorted(r["doc_id"] for r in scored.filter("score < 0.5").collect())
    rows = [(k, text[k]) for k in ids[0]]
    assert ids[1] == sorted({c for _, c in brute.near(rows)})
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert ids[2] == [k for k in ids[1] if not brute.contaminated(text[k], items)[3]]
    assert ids[2] == ids[3] == ids[4] and len(ids[2]) < len(text)
    assert all(x.columns == docs.columns for x in (clean, single, apart, mixed))
    order = [r["doc_id"] for r in mixing.mix(apart.select("doc_id", "source", F.struct(*apart.columns).alias("row"))).orderBy("position").collect()]
    got = files.orderBy("start").collect()
    assert [r["doc_id"] for r in got] == order
    assert [r["ids_crc32"] for r in got] == [zlib.crc32(packed(ids_of(tokenizer, text[k]))) for k in order]


def test_pipeline_of_awkward_rows(spark, docs, rows):
    names = ("_toxicity", "toxicity", "_text_hash", "of", "_k", "_slot", "_source", "_b", "_before", "_rank", "_bucket", "_row", "row", "n", "weight")
    wide = docs.withColumns({c: F.concat_ws("|", F.lit(c), F.col("doc_id").cast("string")) for c in names})
    _, clean, single, apart, mixed, files = staged(spark, wide, SF)
    left = [(r["doc_id"], r["text"]) for r in single.collect()]
    assert all(x.columns == wide.columns for x in (clean, single, apart, mixed))
    for stage in (clean, single, apart, mixed):                                          # values, not names alone
        for r in stage.collect():
            assert all(r[c] == c + ("" if r["doc_id"] is None else f"|{r['doc_id']}") for c in names)
            assert all(r[c] == "clash" for c in CLASHING if c not in names)
    # a row without an id is known by its text: groups of linked documents, and equal rows once
    kept = [(2 ** 62 + abs(hash(t)) // 4 if k is None else k, t) for k, t in ((r["doc_id"], r["text"]) for r in clean.collect())]
    judged = brute.near(kept)
    groups, alone = {c for n, c in judged if n}, [1 for n, _ in judged if not n]
    assert len(left) == len(groups) + len(alone)
    assert files.count() == mixed.count() == apart.count()


def test_copies_without_an_id(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text), (None, text + " more"), (7, text), (None, "other " + text[::-1]), (None, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    left = corpus_pipeline.near_copies_out(spark, docs, SF).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in left), key=str) == sorted([(7, text), (None, "other " + text[::-1]), (None, None), (None, None)], key=str)


def test_pipeline_of_nothing(spark, no_docs):
    assert corpus_pipeline.token_files(spark, corpus_pipeline.mixed(spark, corpus_pipeline.benchmark_out(
        spark, corpus_pipeline.near_copies_out(spark, corpus_pipeline.toxic_out(spark, no_docs, SF), SF), SF), SF), SF).count() == 0
