"""Tokenizer alignment, online packing and source divergence against brute force."""

from __future__ import annotations

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import alignment, queries, tokens
from spanloom.llm.alignment import aligned, align_tokenizers, pair_counts
from spanloom.llm.divergence import source_divergence
from spanloom.llm.online_packing import Windows, binary_windows, pack_online, power_of_two
from spanloom.llm.tokens import ByteLevelEncoder, JsonEncoder, PieceEncoder, load_encoder, tokenizer_path

BYTES, PIECES = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
LETTERS = [*"abA é'.,!≠«ß÷ÉxX12<>| \n\t", "\u0085", "中", "😀", "　", "▁", "  ", "ing", " the", "İ", "\x00"]


def random_texts(n, seed=3, length=25):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(LETTERS) for _ in range(rnd.randint(1, length))) for _ in range(n)]


def lists(found):
    return [found[0][x:y].tolist() for x, y in zip(found[1], found[1][1:])]


def test_encoders_equal_the_tokenizers(monkeypatch):
    a, b = load_encoder(BYTES), load_encoder(PIECES)
    assert isinstance(a, ByteLevelEncoder) and isinstance(b, PieceEncoder)
    settled = [chr(c) for r in ((0, 0x250), (0x2010, 0x2028), (0x2030, 0x205F)) for c in range(*r)]
    texts = [f"a{c}b {c}{c} 1{c}2 {c}a  {c} .{c}'s{c}\n" for c in settled] + random_texts(3000) + ["<|endoftext|> a", "<s> </s>", "<0x41>", "", " "]
    whole = JsonEncoder(BYTES)
    assert lists(a.encode(pa.array(texts), " ")) == whole.ids([" " + t for t in texts])
    assert lists(b.encode(pa.array(texts))) == b.model.encode(texts)
    rnd = random.Random(2)
    long = [" ".join(rnd.choice(["Alpha", "beta,", "gamma", "x", "12", "\n\n", "  y"]) for _ in range(400)) for _ in range(30)]
    monkeypatch.setattr(tokens, "LONG_TEXT", 100)
    assert lists(a.encode(pa.array(long))) == whole.ids(long) and lists(b.encode(pa.array(long))) == b.model.encode(long)


def brute_alignment(rows):
    """The contract, token by token."""
    a, b = load_encoder(BYTES), load_encoder(PIECES)
    bytes_a, bytes_b = a.token_bytes(), b.token_bytes()
    out, documents = [], Counter()
    for doc, text in rows:
        ia, ib = (a.ids([" " + text])[0], b.model.encode(text)) if text else ([], [])
        ta, tb = [bytes_a[i] for i in ia], [bytes_b[i] or b"?" for i in ib]
        want = (" " + (text or "")).encode()
        groups = []
        if text and b"".join(ta) == want == b"".join(tb):
            ends = set(np.cumsum([len(t) for t in ta]).tolist()) & set(np.cumsum([len(t) for t in tb]).tolist())
            for ids, parts, side in ((ia, ta, 0), (ib, tb, 1)):
                at = k = 0
                for i, t in zip(ids, parts):
                    if len(groups) <= k:
                        groups.append(([], []))
                    groups[k][side].append(i)
                    at += len(t)
                    k += at in ends
        else:
            ia = ib = []
        links = [(x, y) for ga, gb in groups for x in ga for y in gb]
        documents.update(set(links))
        out.append((doc, len(ia), len(ib), groups, links))
    most = defaultdict(int)
    for (x, _), n in documents.items():
        most[x] = max(most[x], n)
    for doc, na, nb, groups, links in out:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        yield (
            doc, na, nb, len(groups), len(links), sum(documents[p] == most[p[0]] for p in links), sum(documents[p] for p in links),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


def plain(rows):
    return sorted(map(tuple, rows), key=repr)


def test_alignment(spark, documents, odd):
    rnd = random.Random(5)
    words = ["reading", "Über", "naïve", "the", "12345", "don't", "uń", "data-set", "中文", "\n", "x" * 40]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 30)))) for i in range(120)] + [(1000 + i, t) for i, t in enumerate(random_texts(150))]
    rows += odd + [(1, "again"), (1, "again"), (None, "no id"), (5000, "▁ mark"), (5001, " "), (5002, "  two")]
    want = plain(brute_alignment(rows))
    assert sum(not r[1] for r in want) >= 5
    for common in (0, 20, 1 << 20):
        assert plain(align_tokenizers(spark, documents(rows), BYTES, PIECES, common).collect()) == want
    assert align_tokenizers(spark, documents([]), BYTES, PIECES).count() == 0


def test_large_groups_are_expanded_from_distinct_ids(monkeypatch):
    rnd = np.random.default_rng(0)
    for links in (5, 60, 1 << 22):
        monkeypatch.setattr(alignment, "LINKS", links)
        for _ in range(30):
            n = int(rnd.integers(2, 60))
            sides, borders = [], np.sort(rnd.choice(n - 1, int(rnd.integers(0, min(4, n - 1) + 1)), replace=False)) + 1
            for _ in range(2):
                ends = np.unique(np.append(np.flatnonzero(rnd.random(n - 1) < 0.5) + 1, [*borders, n]))
                sides += [rnd.integers(0, 4, len(ends)), ends]
            found = aligned(*sides)
            text_of = np.searchsorted(np.append(borders, n), found.closes)
            want = Counter()
            for i, g in enumerate(found.a_group):
                for j in np.flatnonzero(found.b_group == g):
                    want[int(text_of[g]), int(found.a[i]) * 9 + int(found.b[j])] += 1
            got = [tuple(map(int, r)) for part in pair_counts(found, text_of, 9) for r in zip(*part)]
            assert {(k, c): m for k, c, m in got} == want and len(got) == len(want) and [g[0] for g in got] == sorted(g[0] for g in got)
            # Every interval lies in its owners.
            starts = np.append(0, found.ends[:-1])
            for owner, ends in ((found.a_owner, sides[1]), (found.b_owner, sides[3])):
                assert (ends[owner] >= found.ends).all() and (np.append(0, ends)[owner] <= starts).all()


def test_levels_minimise_the_sum_of_squares():
    rnd = random.Random(1)
    for _ in range(60):
        capacity = rnd.randint(4, 24)
        windows, given, done = Windows(capacity), {}, []
        for doc in range(rnd.randint(0, 50)):
            size = rnd.randint(1, capacity - 1)
            counts = [len(windows.open.get(h, [])) for h in range(capacity + 1)]

            def squares(h):
                after = list(counts)
                after[h] -= h > 0
                after[h + size] += 1
                return sum(n * n for n in after[1:capacity])

            allowed = [h for h in range(capacity - size + 1) if h == 0 or counts[h]]
            assert windows.choose(size) == min(allowed, key=lambda h: (squares(h), -h))
            given[doc] = size
            full = windows.put((doc, 0, np.arange(size, dtype="<u4"), size))
            done += [full] if full else []
        done += list(windows.settle())
        assert not windows.open and windows.held == 0
        seen = defaultdict(list)
        for window in done:
            fill = sum(len(p[2]) for p in window)
            assert fill == capacity or power_of_two(fill)
            for doc, start, ids, n in window:
                assert ids.tolist() == list(range(start, start + len(ids))) and n == given[doc]
                seen[doc] += ids.tolist()
        assert {d: sorted(x) for d, x in seen.items()} == {d: list(range(n)) for d, n in given.items()}
    assert [sum(len(p[2]) for p in w) for w in binary_windows([(1, 0, np.arange(13), 13)])] == [8, 4, 1]


@pytest.mark.parametrize("held", [1 << 22, 200])
def test_online_packing(spark, documents, odd, held):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["Alpha", "beta,", "gamma-ray", "12"]) for _ in range(rnd.randint(0, 120)))) for i in range(150)] + odd
    texts, capacity = dict(rows), 64
    docs = documents(rows + [(None, "no id")]).repartition(3)
    got = pack_online(docs, BYTES, capacity, held=held).collect()
    whole = {i: np.append(np.array(JsonEncoder(BYTES).ids([t or ""])[0], "<u4"), np.uint32(0)).astype("<u4") for i, t in [*texts.items(), (None, "no id")]}
    places, covered = defaultdict(list), defaultdict(int)
    for r in got:
        ids = whole[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes()) and r.doc_tokens == len(ids)
        places[r.sequence_id].append((r.offset, r.length))
        covered[r.doc_id] += r.length
    assert covered == {i: len(x) for i, x in whole.items()}
    for place in places.values():
        end = 0
        for offset, length in sorted(place):
            assert offset == end
            end += length
        assert end == capacity or (power_of_two(end) and end <= capacity)
    assert pack_online(documents([]), BYTES).count() == 0
    assert pack_online(documents([(1, "a"), (1, "a")]), BYTES).count() == 2


def test_one_very_long_text(spark, documents):
    text = "word and another " * 200_000
    docs = documents([(1, text), (2, "short")])
    got = pack_online(docs, BYTES).collect()
    n = sum(r.length for r in got if r.doc_id == 1)
    assert {r.doc_tokens for r in got if r.doc_id == 1} == {n} and n > 600_000
    row = {r.doc_id: r for r in align_tokenizers(spark, docs, BYTES, PIECES).collect()}[1]
    assert row.n_a == n - 1 and row.n_groups > 0
    assert source_divergence(spark, spark.createDataFrame([(i, text, "l", "ab"[i % 2]) for i in range(4)], "doc_id long, text string, lang string, source string"), 3).count() == 2


def brute_divergence(rows, least, best):
    import re

    found, out = defaultdict(lambda: defaultdict(Counter)), []
    docs = defaultdict(Counter)
    for _, text, lang, source in rows:
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        found[lang or ""][source or ""].update(words)
        docs[lang or ""].update(set(words))
    for lang, sources in found.items():
        kept = [t for t, n in docs[lang].items() if n >= least]
        shares = {}
        for s, counts in [*sources.items(), (None, sum(sources.values(), Counter()))]:
            total = sum(counts[t] for t in kept)
            shares[s] = {t: 1 + 10**9 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}
        for s, counts in sources.items():
            pairs = [(sum(abs(shares[s][t] - shares[o][t]) for t in kept), o) for o in sources if o != s]
            own = [(shares[s][t] - shares[None][t], t) for t in kept if counts[t] and shares[s][t] > shares[None][t]]
            for part, values in (("pair", pairs), ("term", own)):
                values = sorted(values, key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, v, k) for k, (v, item) in enumerate(values[: best if part == "term" else None], 1)]
    return out


def test_divergence(spark, documents, odd):
    rnd = random.Random(4)
    words = ["alpha", "Beta", "gamma", "Änder", "änder", "é", "x1y", "don't", "中文", "😀", "ﬀ", "z" * 300]
    rows = []
    for i in range(300):
        lang, source = rnd.choice(["en", "de", None, ""]), rnd.choice(["a", "b", "c", "é", "", None, "A"])
        rows.append((i, " ".join(rnd.choice(words[: 3 + i % 10]) for _ in range(rnd.randint(0, 30))), lang, source))
    rows += [(i, t, "en", "odd") for i, t in odd] + [(1, "alpha alpha", "en", "a")] * 2 + [(None, "beta", "en", "a"), (7, "alone", "xx", "only"), (8, None, "yy", "p"), (9, "", "yy", "q")]
    docs = spark.createDataFrame([(*r, "x", "x", "x") for r in rows], "doc_id long, text string, lang string, source string, n string, term string, i string")
    for least, best in ((5, 3), (30, 50), (1, 1000)):
        assert plain(source_divergence(spark, docs, least, best).collect()) == plain(brute_divergence(rows, least, best))
    assert source_divergence(spark, docs.limit(0)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_queries_on_the_smallest_tables(spark):
    rows = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert plain(queries.op11_tokenizer_alignment(spark, SF).collect()) == plain(brute_alignment([r[:2] for r in rows]))
    got = queries.op13_source_divergence(spark, SF)
    assert plain(got.collect()) == plain(brute_divergence(rows, 30, 50))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op13_source_divergence"]).df()[got.columns]
    assert plain(want.itertuples(index=False, name=None)) == plain(got.collect()) and len(want)
    placed = queries.op12_online_packing(spark, SF).collect()
    assert {r.doc_id for r in placed} == {r[0] for r in rows}
