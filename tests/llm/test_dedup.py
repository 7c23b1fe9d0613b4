"""Suffix-array, exact and near dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from spanloom.llm import near_dedup as nd
from spanloom.llm import suffix_dedup as sd
from spanloom.llm.exact_dedup import PerfectHash, drop_copies, exact_dedup
from spanloom.llm.graph import components


def removed(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if b[p : p + length] in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(b[p : p + length])
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def repeating(n, seed):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("abcd é") for _ in range(150)) for _ in range(6)]
    return [(i, "".join(rnd.choice(base)[rnd.randint(0, 60) : rnd.randint(80, 150)] for _ in range(rnd.randint(0, 6)))) for i in range(n)]


@pytest.mark.parametrize("group, far", [(1000, 0), (3, 0), (1000, 1 << 40)])
def test_suffix_dedup(spark, documents, odd, monkeypatch, group, far):
    monkeypatch.setattr(sd, "GROUP", group)
    rows = [(i + far, t) for i, t in repeating(120, 7)] + [(far + i, t) for i, t in odd if i != 904]
    got = sd.remove_repeats(spark, documents(rows)).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == removed(rows)
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_suffix_dedup_of_long_texts_and_odd_ids(spark, documents, monkeypatch):
    """Texts longer than a part, rows that repeat an id, rows without one."""
    monkeypatch.setattr(sd, "PART", 1000)
    rnd = random.Random(5)
    block = "".join(rnd.choice("abcdefgh é") for _ in range(2500))
    rows = [(1, block + "xyz" + block), (2, "q" + block[200:1900]), (3, "ab" * 1500), (4, block[:99]), (5, "z" * 2100)]
    odd = [(None, block), (None, block), (9, block[:400]), (9, block[:400]), (11, block[:300]), (11, block[5:300])]
    got: dict = {}
    for r in sd.remove_repeats(spark, documents(rows + odd)).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    want = removed(rows + [(9, block[:400])])
    assert all(got[i] == [want[i]] for i in range(1, 6)) and got[9] == [want[9]] * 2 and want[9][1] > 0
    assert [x[1] for x in got[None]] == [0, 0] and [x[1] for x in got[11]] == [0, 0]


def test_suffix_dedup_keeps_crafted_texts(spark, documents):
    """Texts that polynomial hashes confuse are no repeats of each other."""
    x, y = (thue_morse(2048, *p) for p in ("ab", "ba"))
    rows = [(1, "-" * 60 + x), (2, "+" * 60 + y), (3, x[:90] + "c" + y[:90])]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in sd.remove_repeats(spark, documents(rows)).collect()}
    assert got == removed(rows)


def test_suffix_dedup_of_nothing(spark, documents):
    assert sd.remove_repeats(spark, documents([])).count() == 0


def test_two_stage_suffix_array():
    rnd = random.Random(0)
    for trial in range(200):
        depth = rnd.choice([8, 16, 24])
        n = rnd.randint(1, 60) + depth
        t = bytes(rnd.choice(b"\0ab" if trial % 2 else b"aabz") for _ in range(n))
        wanted = np.array(sorted(rnd.sample(range(n - depth), rnd.randint(1, n - depth))))
        order = sd.two_stage_suffix_array(np.frombuffer(t, np.uint8), wanted, depth)
        keys = [t[i : i + depth] for i in order]
        assert sorted(order) == wanted.tolist() and keys == sorted(keys)
        same = sd.shared_with_next(np.frombuffer(t, np.uint8), order, depth)
        assert same.tolist() == [a == b for a, b in zip(keys, keys[1:])]


def test_perfect_hash_is_minimal_and_tells_strangers():
    digests = np.frombuffer(np.random.default_rng(0).bytes(32 * 3000), np.uint8).reshape(-1, 32)
    mph = PerfectHash.build(digests[:2000])
    assert sorted(mph.slot(digests[:2000])) == list(range(2000))
    slots = np.empty((2000, 32), np.uint8)
    slots[mph.slot(digests[:2000])] = digests[:2000]
    other = mph.slot(digests[2000:])
    assert not any((slots[s] == d).all() for s, d in zip(other, digests[2000:]) if s >= 0)


def test_exact_dedup(spark, documents, odd):
    rows = [(i, random.Random(i).choice(["a b", "a\t\nb", "a  b", "a b ", "é", "", "b"])) for i in range(60)] + odd
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    got = exact_dedup(spark, documents(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = next(k for k, v in groups.items() if r.doc_id in v)
        assert (r.keep_id, r.group_size, r.kept) == (min(groups[text]), len(groups[text]), r.doc_id == min(groups[text]))
        assert r.text_sha256 == hashlib.sha256(text.encode()).hexdigest()
    kept = drop_copies(spark, documents(rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(min(v) for v in groups.values())
    assert kept.columns == documents(rows).columns
    assert exact_dedup(spark, documents([])).count() == 0


def test_exact_dedup_of_odd_ids(spark, documents):
    """Null ids beside ids that no floating-point number holds, repeated rows and ids."""
    big = (1 << 62) + 1
    rows = [(None, "no id"), (None, "no  id"), (None, "t3"), (big + 800, "t7"), ((1 << 63) - 1, "last"), (None, "last"), (-5, "t7")]
    rows += [(big + 2 * i, f"t{i}") for i in range(40)] + [(big, "t0"), (big, "other")]
    groups: dict = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t), []).append(i)
    want = []
    for i, t in rows:
        own = groups[re.sub(r"[\x20\x09-\x0D]+", " ", t)]
        keep = min((x for x in own if x is not None), default=None)
        want.append((i, keep, len(own), i == keep))
    got = [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup(spark, documents(rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    kept = [(r.doc_id, r.text) for r in drop_copies(spark, documents(rows)).collect()]
    assert sorted(kept, key=repr) == sorted([r for r, w in zip(rows, want) if w[3]], key=repr)


def test_superminhash_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        x = rng.integers(0, 2**63, 400).astype(np.uint64)
        y = np.concatenate((x[:300], rng.integers(0, 2**63, 100).astype(np.uint64)))
        s = nd.superminhash(np.concatenate((x, y)), np.array([0, 400, 800]))
        errors.append((s[0] == s[1]).mean() - 300 / 500)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 99), (99, 98), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(spark, edges).collect()}
    assert got == {**{i: 1 for i in range(1, 41)}, 98: 98, 99: 98, 100: 98}


def shingles(text, words):
    w = (text or "").encode().lower().split()
    return {tuple(w[k : k + words]) for k in range(len(w) - words + 1)} or ({tuple(w)} if w else set())


def grouped(sets):
    """The smallest reachable id of every document, by comparing all pairs."""
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


def near_rows(rnd, groups=12, copies=6):
    rows = []
    for g in range(groups):
        base = [rnd.choice("alpha beta gamma delta eps zeta eta Theta IOTA kappa".split()) + str(rnd.randint(0, 40)) for _ in range(rnd.randint(3, 90))]
        for _ in range(rnd.randint(1, copies)):
            text = list(base)
            for _ in range(rnd.randint(0, 6)):
                text[rnd.randrange(len(text))] = f"w{rnd.randint(0, 999)}"
            rows.append((len(rows) * 3 + g, " ".join(text)))
    return rows


@pytest.mark.parametrize("words", [2, 5])
def test_near_dedup(spark, documents, odd, words):
    rows = list(dict(near_rows(random.Random(words)) + odd).items())
    sets = {i: shingles(t, words) for i, t in rows}
    got = nd.near_dedup(spark, documents(rows), words=words).collect()
    assert {r.doc_id: r.component_id for r in got} == grouped(sets)
    assert all(r.n_shingles == len(sets[r.doc_id]) and r.kept == (r.doc_id == r.component_id) for r in got)


@pytest.mark.parametrize("block", [1024, 7])
def test_near_dedup_of_a_group_around_the_threshold(spark, documents, monkeypatch, block):
    """Most pairs of one large group lie just below 0.8, some above; blocks split it."""
    monkeypatch.setattr(nd, "BLOCK", block)
    rnd = random.Random(1)
    base, rows = [f"b{k}" for k in range(400)], []
    for i in range(150):
        text = list(base)
        for k in rnd.sample(range(0, 400, 3), rnd.choice([13, 14, 14, 15])):
            text[k] = f"x{i}-{k}" if rnd.random() < 0.7 else f"y{k}"
        rows.append((i, " ".join(text)))
    sets = {i: shingles(t, 2) for i, t in rows}
    want = grouped(sets)
    assert 1 < len(set(want.values())) < 150
    got = nd.near_dedup(spark, documents(rows), words=2).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_near_dedup_recall_near_the_threshold(spark, documents):
    rnd = random.Random(4)
    rows, pairs = [], 0
    for i in range(400):
        words = [f"w{rnd.randint(0, 10**9)}" for _ in range(rnd.randint(60, 200))]
        other, n = list(words), 0
        shared = set(zip(words, words[1:]))
        for k in rnd.sample(range(1, len(words) - 1, 2), len(words) // 2 - 2):
            trial = [*other[:k], f"v{i}-{k}", *other[k + 1 :]]
            both = len(shared & set(zip(trial, trial[1:])))
            if both / (2 * len(shared) - both) < 0.8:
                break
            other, n = trial, n + 1
        both = len(shared & set(zip(other, other[1:])))
        assert 0.8 <= both / (2 * len(shared) - both) < 0.85
        pairs += 1
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    got = {r.doc_id: r.component_id for r in nd.near_dedup(spark, documents(rows), words=2).collect()}
    assert all(got[2 * i] == 2 * i for i in range(400))
    assert sum(got[2 * i + 1] == 2 * i for i in range(400)) >= 0.99 * pairs


def test_near_dedup_of_odd_ids(spark, documents):
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text), (1, text), (2, text.upper()), (None, text), (None, "alone here"), (3, "other words"), (3, "quite another text"), (4, "other words"), ((1 << 60) + 1, "a b"), ((1 << 60) + 3, "a b")]
    got = sorted(((r.doc_id, r.component_id) for r in nd.near_dedup(spark, documents(rows), words=2).collect()), key=repr)
    big = 1 << 60
    assert got == sorted([(1, 1), (1, 1), (2, 1), (None, 1), (None, None), (3, 3), (3, 3), (4, 3), (big + 1, big + 1), (big + 3, big + 1)], key=repr)


def test_texts_under_one_id_are_placed_each_by_itself(spark, documents):
    base = [f"w{k}" for k in range(20)]
    first, second = " ".join(base), " ".join(f"v{k}" for k in range(20))
    rows = [(4, first), (4, second), (2, second + " end"), (3, first + " end"), (None, first + " end x"), (7, "quite alone here")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in nd.near_dedup(spark, documents(rows), words=2).collect()), key=repr)
    want = [(4, 3, False), (4, 2, False), (2, 2, True), (3, 3, True), (None, 3, False), (7, 7, True)]
    assert got == sorted(want, key=repr)


def thue_morse(n, first, second):
    return "".join(second if bin(k).count("1") % 2 else first for k in range(n))


def test_crafted_words_are_told_apart(spark, documents):
    x, y = thue_morse(1024, "a", "b"), thue_morse(1024, "b", "a")
    rows = [(0, x), (1, y), (2, x + x + x + x + x), (3, y + x + x + x + x), (4, x)]
    got = {r.doc_id: r.component_id for r in nd.near_dedup(spark, documents(rows), words=2).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_shared_tokens():
    rng = np.random.default_rng(2)
    for dense in (0, 3, 64):
        lists = [[np.unique(rng.integers(0, 40, rng.integers(0, 20))).astype(np.uint64) for _ in range(n)] for n in (9, 13)]
        sides = [(np.concatenate(x), np.concatenate(([0], np.cumsum([len(v) for v in x])))) for x in lists]
        want = [[len(np.intersect1d(a, b)) for b in lists[1]] for a in lists[0]]
        assert nd.shared_tokens(*sides, dense).tolist() == want
