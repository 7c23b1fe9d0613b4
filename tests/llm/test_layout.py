"""Packing, sharding, token counts and the pipeline."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import xxhash

from spanloom.llm import token_counts as tc
from spanloom.llm.packing import best_fit_decreasing, bin_completion, pack_documents
from spanloom.llm.sharding import Shard, assign_shard, shard_documents, shard_tree
from spanloom.llm.tokens import JsonEncoder, load_encoder, tokenizer_path
from pyspark.sql import functions as F

WORDS = tokenizer_path("word_bpe_49k.json")


def test_word_encoder_equals_the_tokenizer():
    rnd = random.Random(1)
    letters = "aBcé'.,!≠́ «–ß×÷12ÉÀ \n\x0b\x1c\x85中İΣς#"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30))) for _ in range(3000)] + ["<|endoftext|> a", None, "", "don't we'll x's"]
    got, want = load_encoder(WORDS).encode(pa.array(texts)), JsonEncoder(WORDS).encode(pa.array(texts))
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_word_encoder_tells_crafted_words_apart():
    morse = lambda n, a, b: "".join(b if bin(k).count("1") % 2 else a for k in range(n))
    words = [morse(n, *x) for n in (1024, 2048, 8192) for x in ("ab", "ba")] + ["a" * 5000, "a" * 4999 + "b", "a" * 4999]
    texts = pa.array([" ".join(words), " ".join(reversed(words)), *words])
    got, want = load_encoder(WORDS).encode(texts), JsonEncoder(WORDS).encode(texts)
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_word_encoder_keeps_its_first_parts_when_a_batch_has_more(monkeypatch):
    from spanloom.llm.tokens import WordEncoder

    class Counted:
        def __init__(self, model):
            self.model, self.asked = model, []

        def tokenize(self, part):
            self.asked.append(part)
            return self.model.tokenize(part)

    monkeypatch.setattr(WordEncoder, "KEPT", 50)
    encoder = WordEncoder(WORDS)
    encoder.model = Counted(encoder.model)
    texts = pa.array([" ".join("x" + chr(97 + i // 26) + chr(97 + i % 26) for i in range(n)) for n in (100, 70)])
    first = encoder.encode(texts)
    assert len(encoder.model.asked) == 100
    again = encoder.encode(texts)
    assert len(encoder.model.asked) == 150 and (first[0] == again[0]).all() and (first[1] == again[1]).all()


def test_word_encoder_with_full_memory_and_equal_hashes(monkeypatch):
    from spanloom.llm import tokens

    rnd = random.Random(3)
    words = ["alpha", "Über", "a,b", "don't", "x" * 40, "12.5", "été!", "中文", "wörter-bücher", "ab", "abc", "…", "q" * 33 + "."]
    batches = [[" ".join(rnd.choice(words) + rnd.choice(["", ".", "ed", "é"]) for _ in range(rnd.randint(0, 9))) for _ in range(20)] + [None, "", " "] for _ in range(12)]
    whole = JsonEncoder(WORDS)
    for kept, hashes in ((0, None), (7, None), (400, None), (400, lambda data, b, e: (e - b).astype(np.uint64) % np.uint64(5)), (400, lambda data, b, e: np.zeros(len(b), np.uint64))):
        monkeypatch.setattr(tokens.WordEncoder, "KEPT", kept)
        if hashes:
            monkeypatch.setattr(tokens, "word_hashes", hashes)
        encoder = tokens.WordEncoder(WORDS)
        for texts in batches:
            got, want = encoder.encode(pa.array(texts)), whole.encode(pa.array(texts))
            assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()
        assert len(encoder.hashes) <= kept


def test_equal_hashes_do_not_join_words(monkeypatch):
    from spanloom.llm import tokens

    monkeypatch.setattr(tokens, "word_hashes", lambda data, b, e: (e - b).astype(np.uint64) % np.uint64(3))
    data = np.frombuffer(b"abcdefghijk abd abc abcdefghijl a", np.uint8)
    begin, end, _ = tokens.word_spans(data, np.array([0, len(data)]))
    first, back = tokens.distinct_words(data, begin, end)
    words = [data[b:e].tobytes() for b, e in zip(begin, end)]
    assert [words[first[k]] if k < len(first) else None for k in back] == words


def fewest(items, capacity):
    best = [len(items)]

    def go(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(items):
            best[0] = len(rooms)
            return
        for room in set(rooms):
            if room >= items[i]:
                j = rooms.index(room)
                go(i + 1, rooms[:j] + [room - items[i]] + rooms[j + 1 :])
        go(i + 1, rooms + [capacity - items[i]])

    go(0, [])
    return best[0]


def test_bin_completion_reaches_the_optimum():
    rnd, fit, search, best = random.Random(0), 0, 0, 0
    for _ in range(120):
        items = sorted((rnd.randint(15, 70) for _ in range(rnd.randint(4, 10))), reverse=True)
        counts = {x: items.count(x) for x in items}
        for plan in (best_fit_decreasing(counts, 100), bin_completion(counts, 100)):
            used: dict = {}
            for filling, n in plan.fillings:
                assert sum(x * k for x, k in filling) <= 100
                for x, k in filling:
                    used[x] = used.get(x, 0) + k * n
            assert used == counts
        fit += best_fit_decreasing(counts, 100).sequences
        search += bin_completion(counts, 100).sequences
        best += fewest(items, 100)
    assert best == search <= fit


def test_bin_completion_with_repeated_lengths():
    assert bin_completion({4: 4, 3: 4}, 14).sequences == 2
    rnd = random.Random(1)
    for _ in range(150):
        capacity = rnd.randint(10, 30)
        lengths = rnd.sample(range(2, capacity), rnd.randint(2, 4))
        items = sorted((rnd.choice(lengths) for _ in range(rnd.randint(6, 11))), reverse=True)
        plan = bin_completion({x: items.count(x) for x in items}, capacity)
        assert plan.sequences == fewest(items, capacity), (items, capacity)


def test_packing(spark, documents, odd):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["Alpha", "beta,", "gamma-ray", "12"]) for _ in range(rnd.randint(0, 120)))) for i in range(80)] + odd
    texts, capacity = dict(rows), 64
    want = {}
    for i, t in rows:
        ids = np.append(JsonEncoder(WORDS).encode(pa.array([t or ""]))[0], np.uint32(1)).astype("<u4")
        for k, s in enumerate(range(0, len(ids), capacity)):
            want[i, k] = (s, len(ids[s : s + capacity]), zlib.crc32(ids[s : s + capacity].tobytes()))
    got = pack_documents(spark, documents(rows), WORDS, capacity).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    sequences: dict = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    sizes = [x[1] for x in want.values()]
    assert len(sequences) <= best_fit_decreasing({x: sizes.count(x) for x in sizes}, capacity).sequences
    assert pack_documents(spark, documents([]), WORDS).count() == 0
    twice = pack_documents(spark, documents([(1, "one two"), (1, "one two"), (1, "three"), (None, None)]), WORDS, capacity).collect()
    assert len(twice) == 4 and len({(r.sequence_id, r.offset) for r in twice}) == 4


def test_sharding(spark, documents, odd):
    rows = [(10_000 + i, f"text {i}") for i in range(3000)] + odd + [(None, "x"), (None, "y")]
    texts = dict(rows)
    got = shard_documents(documents(rows)).collect()
    assert len(got) == len(rows)
    slots: dict = {}
    for r in got:
        text = texts.get(r.doc_id) or ""
        if r.doc_id is not None:
            assert (r.size, r.text_crc32) == (len(text.encode()) + 16, zlib.crc32(text.encode()))
        assert r.grown_shard in (r.shard, 40) and 0 <= r.shard < 40
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(slots) == 40
    moved = sum(r.grown_shard == 40 for r in got)
    assert 0.5 < moved / len(got) * 41 < 1.7


def test_growth_takes_rows_only_into_the_new_shard(spark, documents):
    docs = documents([(i, None) for i in range(2000)])
    for n in (1, 12, 39, 40, 57):
        rows = shard_documents(docs, n).collect()
        assert {r.shard for r in rows} <= set(range(n)) and all(r.grown_shard in (r.shard, n) for r in rows)
    own = [Shard(s, "r", "k", 1.0 + s) for s in range(3)]
    assert {r.grown_shard for r in shard_documents(docs, 3, own).collect()} == {None}
    more = [*own, Shard(3, "x", "k", 1.0)]
    assert all(r.grown_shard in (r.shard, 3) for r in shard_documents(docs, 3, own, more).filter("grown_shard >= 0").collect())


def test_sharding_descends_by_hash_draws(spark):
    def draw(key, name, weight):
        u = ((xxhash.xxh64_intdigest(name.encode(), xxhash.xxh64_intdigest(key.to_bytes(8, "little", signed=True), 42)) >> 11) + 0.5) / 2**53
        return -np.log(u) / weight

    tree = shard_tree(41)
    for r in spark.range(300).select("id", assign_shard(F.col("id"), tree).alias("s")).collect():
        regions = list(dict.fromkeys(x.region for x in tree))
        region = min(regions, key=lambda g: draw(r.id, f"region/{g}", sum(x.weight for x in tree if x.region == g)))
        racks = list(dict.fromkeys(x.rack for x in tree if x.region == region))
        rack = min(racks, key=lambda k: draw(r.id, f"rack/{region}/{k}", sum(x.weight for x in tree if (x.region, x.rack) == (region, k))))
        leaf = min((x for x in tree if (x.region, x.rack) == (region, rack)), key=lambda x: draw(r.id, f"shard/{region}/{rack}/{x.shard}", x.weight))
        assert leaf.shard == r.s


def test_weights_move_rows_only_within_changed_subtrees(spark):
    tree = shard_tree(40)
    heavier = [Shard(x.shard, x.region, x.rack, 3.0 if x.shard == 7 else x.weight) for x in tree]
    place = {x.shard: (x.region, x.rack) for x in tree}
    rows = spark.range(4000).select(assign_shard(F.col("id"), tree).alias("a"), assign_shard(F.col("id"), heavier).alias("b")).filter("a <> b").collect()
    assert rows and all(place[r.b][0] == place[7][0] for r in rows)
    assert all(r.b == 7 for r in rows if place[r.a] == place[7])


def test_token_counts(spark, documents, odd):
    rows = [(i, "word " * (i % 37)) for i in range(300)] + odd
    path = tokenizer_path("byte_bpe_50k.tiktoken")
    lengths = np.diff(load_encoder(path).encode(pa.array([t for _, t in rows]))[1])
    sums = tc.token_counts(spark, documents(rows), path)
    for r in sums.collect():
        assert r.n_docs == (lengths == r.n_tokens).sum() and r.docs_over == (lengths > r.n_tokens).sum()
        assert r.truncated_total == np.minimum(lengths, r.n_tokens).sum() and r.tokens_over == lengths[lengths > r.n_tokens].sum()
    for r in tc.truncated_total(sums, [0, 5, 17, 10**6]).collect():
        assert (r.truncated_total, r.docs_over) == (np.minimum(lengths, r.limit).sum(), (lengths > r.limit).sum())
    for r in tc.quantiles(sums, [0.1, 0.5, 1.0]).collect():
        assert r.n_tokens == np.sort(lengths)[int(np.ceil(r.q * len(lengths))) - 1]
    assert tc.token_counts(spark, documents([]), path).count() == 0
    assert [r.truncated_total for r in tc.truncated_total(sums, [-3, -1]).collect()] == [0]
    assert tc.truncated_total(sums, []).count() == tc.quantiles(sums, []).count() == 0
    assert {r.q: r.n_tokens for r in tc.quantiles(sums, [2.0, -1.0]).collect()} == {2.0: None, -1.0: lengths.min()}
