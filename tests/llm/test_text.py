"""PII, decontamination, quality and web archive operators."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from spanloom.llm import queries as q
from spanloom.llm.decontaminate import Search, best_edit, leaks
from spanloom.llm.pii import find_pii
from spanloom.llm.quality import score_documents
from spanloom.llm.warc import derivatives, parse_records, read_warc, record_text, responses, write_warc

RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(x if i % 2 == 0 else (x * 2 - 9 if x > 4 else x * 2) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def base(text):
    out = []
    for kind, rule in RULES.items():
        for m in re.finditer(rule, text):
            d = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}
            if good[kind]:
                out.append((kind, m.start(), m.end()))
    return out


def test_pii(spark, documents, odd):
    rnd = random.Random(5)
    bits = ["a", "b@", "c.", "@", "d-e.f", "1", "22", ".", "300", "-", " ", "+", "(", ")", "4111 1111 1111 1111", "é", "𝒳", "\n", "a@b.c_d@e.f", "12.1.1.1.1.2.3.4", "+1 (578) 555-6437 4918187128635271", "%"]
    rows = [(i, "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))) for i in range(600)] + odd
    texts = dict(rows)
    for r in find_pii(spark, documents(rows)).collect():
        want = base(texts[r.doc_id] or "")
        joined = ",".join(f"{k}:{a}:{e}" for k, a, e in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[0] == k for x in want) for k in RULES)
        assert set(joined.split(",")) - {""} <= set(r.spans.split(","))


def test_pii_discovers_by_context(spark, documents):
    rows = [(i, f"please contact: user{i}@site{i}.org now") for i in range(10)] + [(20, "please contact: bob@localhost now"), (21, "lunch bob2@localhost now")]
    got = {r.doc_id: r.spans for r in find_pii(spark, documents(rows)).collect()}
    assert got[20] == "email:16:29" and got[21] == ""


def test_pii_discovery_is_bounded_by_no_length(spark, documents):
    long_word, long_value = "w" * 40 + ":", "bob." * 30 + "x"
    rows = [(i, f"see {long_word}\t \n   user{i}@site{i}.org now") for i in range(10)]
    rows += [(20, f"see {long_word} {long_value}@localhost now"), (20, f"see {long_word} {long_value}@localhost now"), (None, f"{long_word} k@hh now"), (21, None)]
    got = [(r.doc_id, r.spans) for r in find_pii(spark, documents(rows)).collect() if r.doc_id is None or r.doc_id >= 20]
    begin = 4 + len(long_word) + 1
    assert sorted(got, key=str) == sorted([(20, f"email:{begin}:{begin + len(long_value) + 10}")] * 2 + [(None, f"email:{len(long_word) + 1}:{len(long_word) + 5}"), (21, "")], key=str)


def test_pii_discovery_on_planted_rows(spark, documents):
    """Values that no base rule finds, after words that mostly stand before known data; others are decoys."""
    rnd = random.Random(8)
    rows, planted, decoys = [], set(), set()
    for i in range(600):
        kind = rnd.choice(["seed", "seed", "plant", "decoy", "plain"])
        who = f"u{rnd.randint(0, 10**6)}"
        if kind == "seed":
            rows.append((i, f"text mailto: {who}@d{i}.com more"))
        elif kind == "plant":
            planted.add(i)
            rows.append((i, f"text mailto: {who}[at]host{i} more"))
        elif kind == "decoy":
            decoys.add(i)
            rows.append((i, f"text {rnd.choice(['score', 'twas', 'route'])} {who}@place{i} more"))
        else:
            rows.append((i, f"text score {i} route twas 7 more"))
    found = {r.doc_id for r in find_pii(spark, documents(rows)).collect() if r.n_discovered}
    assert len(found & planted) >= 0.95 * len(planted) and len(found & decoys) <= 0.05 * len(found)


def test_pii_of_many_matches(spark, documents):
    text = " ".join(f"a{i}@b.cd 10.0.{i % 256}.1" for i in range(1500))
    row = find_pii(spark, documents([(1, text)])).first()
    want = base(text)
    assert row.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{e}" for k, a, e in want).encode()).hexdigest()


def edited(text, n, rnd):
    t = list(text)
    for _ in range(n):
        i, o = rnd.randrange(len(t)), rnd.random()
        t[i : i + 1] = [rnd.choice("etaoin")] if o < 0.4 else [] if o < 0.7 else [t[i], "x"]
    return "".join(t)


def distance(a, b):
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_edit_distance_is_exact():
    rnd = random.Random(1)
    for _ in range(200):
        a = "".join(rnd.choice("abc") for _ in range(rnd.randint(1, 12)))
        b = "".join(rnd.choice("abc") for _ in range(rnd.randint(0, 20)))
        assert best_edit(a, b)[0] == distance(a, b)


def test_leaks(spark, documents, odd):
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["th", "an", "er", "ing", "ou", "st", "re"]) for _ in range(rnd.randint(1, 5)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(15, 50)))) for i in range(30)] + [(90, ""), (91, None)]
    rows = [(i, " ".join(word() for _ in range(200))) for i in range(40)]
    want = set()
    for i in range(30):
        text = items[i][1]
        rows.append((100 + i, f"{word()} {edited(text, int(0.06 * len(text)), rnd).upper()}\n{word()}"))
        want.add((100 + i, i))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks(spark, documents(rows + odd), table).collect()}
    assert set(got) == want
    assert all(r.edit_distance <= 0.1 * r.item_length for r in got.values())
    assert leaks(spark, documents(rows), table.limit(0)).count() == 0
    assert Search().tables >= 100


def test_what_the_sampled_tables_find_alone(spark, documents):
    """Recall of the LSH without the pieces, over leaks of up to the tolerated share of edits."""
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 10)))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(20)]
    rows = []
    for i in range(200):
        text = items[i % 20][1]
        leak = edited(text, int(len(text) * (0.02, 0.05, 0.08, 0.1)[i % 4]), rnd)
        rows.append((i, " ".join([*(word() for _ in range(40)), leak, *(word() for _ in range(40))])))
    table, docs = spark.createDataFrame(items, "item_id long, text string"), documents(rows)
    alone = {(r.doc_id, r.item_id) for r in leaks(spark, docs, table, Search(supplement=False)).collect()}
    both = {(r.doc_id, r.item_id) for r in leaks(spark, docs, table).collect()}
    want = {(i, i % 20) for i in range(200)}
    assert both == want and alone <= want and len(alone) >= 0.9 * len(want)


def test_leaks_of_very_long_and_very_many_items(spark, documents, monkeypatch):
    from spanloom.llm import decontaminate as dc

    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(3, 9)))
    long = " ".join(word() for _ in range(3000))
    items = [(-1, long)] + [(i, f"{word()} {word()} {word()} {word()} {i}") for i in range(20_001)]
    rows = [(1, "before " + edited(long, 300, rnd) + " after"), (2, "x " + items[1][1] + " y"), (3, "x " + items[-1][1] + " y"), (4, "nothing of that kind")]
    docs, table = documents(rows), spark.createDataFrame(items, "item_id long, text string")
    assert len(long) > 19_000
    got = {(r.doc_id, r.item_id) for r in leaks(spark, docs, table).collect()}
    assert got >= {(1, -1), (2, 0), (3, 20_000)} and all(d != 4 for d, _ in got)
    monkeypatch.setattr(dc, "RUN_BYTES", 1 << 14)
    assert all(len(r) == 1 or len(r) * w[r].max() <= 1 << 14 for w in [np.array([5, 9000, 40_000, 1, 0, 700])] for r in dc.by_width(w))
    assert sorted(i for r in dc.by_width(np.array([5, 9000, 40_000, 1, 0, 700])) for i in r) == list(range(6))


def test_leaks_at_borders(spark, documents):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(40))) for i in range(20)]
    rows = []
    for trial in range(240):
        item, text = items[trial % 20]
        gone = set(rnd.sample(range(len(text)), len(text) // 10 - 2))
        edited = "".join(c for i, c in enumerate(text) if i not in gone)
        around = " ".join(word() for _ in range(60))
        rows.append((trial, item, (edited, f"{around} {edited}", f"{edited} {around}")[trial // 80]))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(spark, documents([(d, t) for d, _, t in rows]), table).collect()}
    assert got <= {(d, i) for d, i, _ in rows}
    for place in range(3):  # the whole text, its end, its start
        assert sum((d, i) in got for d, i, _ in rows[80 * place : 80 * place + 80]) >= 78


def test_leaks_without_intact_words(spark, documents):
    rnd = random.Random(12)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))
    clause = lambda n: "".join(chr(rnd.randint(0x4E00, 0x9FFF)) for _ in range(n))
    items = [(i, " ".join(word() for _ in range(20))) for i in range(10)] + [(i, clause(40)) for i in range(10, 20)] + [(20, "ab cd ef gh")]
    rows = []
    for i, text in items[:10]:  # one letter of nearly every word, and no run of three is whole
        words = [w[:4] + "0" + w[5:] if k % 20 != 7 else w[:8] + "0" for k, w in enumerate(text.split(" "))]
        rows.append((i, " ".join([*(word() for _ in range(30)), *words[:19], text.split(" ")[19], word()])))
    for i, text in items[10:20]:  # inside running text, with three characters changed
        rows.append((i, clause(30) + text[:9] + "x" + text[10:21] + "y" + text[22:33] + "z" + text[34:] + clause(30)))
    rows.append((20, "zz xb cd ef gh zz"))
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(spark, documents(rows), table).collect()}
    assert got == {(i, i) for i in range(21)}


def test_leaks_against_all_pairs(spark, documents):
    """Evenly spread and clustered edits on both sides of the limit, null and repeated ids, equal items."""
    rnd = random.Random(21)
    word = lambda: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(4, 30)))) for i in range(25)]
    items += [(100, items[0][1]), (101, items[1][1].upper())]
    rows = []
    for i in range(100):
        text = items[i % 25][1]
        n = rnd.choice([len(text) // 12, len(text) // 10, len(text) // 10 + 1, len(text) // 8])
        if i % 2:  # evenly spread
            chars = list(text)
            for k in range(n):
                chars[int((k + 0.5) * len(text) / n)] = "#"
            changed = "".join(chars)
        else:
            changed = edited(text, n, rnd)
        rows.append((i, f"{' '.join(word() for _ in range(rnd.randint(0, 15)))} {changed} {' '.join(word() for _ in range(rnd.randint(0, 15)))}"))
    rows += [(None, items[2][1]), (7, "x " * 200_000 + items[3][1])]
    plain = {i: " ".join(t.lower().split()) for i, t in items}
    want = {(d, i) for d, t in rows for i, p in plain.items() if p and best_edit(p, " ".join(t.lower().split()))[0] <= int(0.1 * len(p))}
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(spark, documents(rows), table).collect()}
    assert got == want and (None, 2) in got and (7, 3) in got


def test_statistics_equal_plain_python():
    """Each statistic of 60 texts from its definition, one text at a time."""
    import math
    from collections import Counter

    from spanloom.llm import quality

    rnd = random.Random(7)
    letters = [*"abcXYZ019.,;!?-'\"()[]{}<>@#/\\_=+ \n\t", "é", "中", "  ", "word ", "word "]
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 400))) for _ in range(56)] + ["", None, " \n ", "one"]
    got = quality.statistics(pa.array(texts))
    kinds = quality._KIND
    for row, text in zip(got, texts):
        data = (text or "").encode()
        words = re.split(rb"[\x20\x09-\x0D]+", data)
        words = [w for w in words if w]
        n, some, many = len(words), max(1, len(data)), max(1, len(words))
        sizes = [len(w) for w in words]
        mean = sum(sizes) / many
        spread = math.sqrt(max(0.0, sum(x * x for x in sizes) / many - mean * mean))
        chars = Counter(int(kinds[b]) for b in data)
        pairs = list(zip(words, words[1:]))
        want = [
            math.log1p(n), math.log1p(mean), math.log1p(spread), math.sqrt(chars[1] / max(1, chars[1] + chars[2])),
            *(math.sqrt(chars[k] / some) for k in (3, 5, 6, 7, 8, 9)),
            math.log1p(len(set(words))) / math.log1p(many), math.sqrt(sum(a == b for a, b in pairs) / many), math.sqrt(max(Counter(words).values(), default=0) / many),
            math.sqrt(data.count(b"\n") / some), math.sqrt(sum(x <= 3 for x in sizes) / many), math.log1p(len(set(pairs))) / math.log1p(many),
        ]
        assert np.allclose(row, want, atol=1e-9), (text, row, want)
    # The kinds of bytes: each byte is one kind, and the ones that the statistics name are what they say.
    assert all(kinds[b] == 1 for b in b"ABCXYZ") and all(kinds[b] == 2 for b in b"abcxyz") and all(kinds[b] == 3 for b in b"0189")


def test_quality_equals_the_textbook_formula():
    import numpy as np

    from spanloom.llm.quality import Discriminant

    rng = np.random.default_rng(3)
    x = [rng.normal(size=(n, 4)) @ rng.normal(size=(4, 4)) + k for k, n in enumerate((60, 90))]
    sums = np.stack([np.column_stack((np.ones(len(v)), v)).T @ np.column_stack((np.ones(len(v)), v)) for v in x])
    every = np.vstack(x)
    cov = [np.cov(v.T, bias=True) for v in x]
    pooled = (60 * cov[0] + 90 * cov[1]) / 150
    logs = []
    for v, c, share in zip(x, cov, (0.4, 0.6)):
        s = 0.9 * c + 0.1 * pooled + 0.01 * np.diag(np.diag(np.cov(every.T, bias=True)))
        d = every - v.mean(axis=0)
        logs.append(np.log(share) - 0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ij,jk,ik->i", d, np.linalg.inv(s), d)))
    want = 1 / (1 + np.exp(-(logs[1] - logs[0]) / 2))
    assert np.allclose(Discriminant.fit(sums, 0.1, 0.01).score(every), want)


def test_learning_rows_are_bounded(spark):
    from spanloom.llm.quality import learning_rows

    labels = spark.range(3000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    every = {r.doc_id for r in learning_rows(labels).collect()}
    some = {r.doc_id for r in learning_rows(labels, most=300).collect()}
    assert 1800 < len(every) < 2200 and some < every and 200 < len(some) < 400


def test_quality_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = score_documents(spark, docs, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() > 0.97


def test_quality_odd_rows(spark, documents, odd):
    labels = spark.createDataFrame([(900, 1, 0), (904, 0, 0), (1, None, 0)], "doc_id long, quality int, toxic int")
    got = score_documents(spark, documents(odd + odd), labels).collect()
    assert len(got) == 2 * len(odd) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in score_documents(spark, documents(odd), labels.limit(0)).collect()} == {0.5}


def test_quality_of_odd_ids_in_the_pipeline(spark, documents):
    from spanloom.llm.quality import keep_good

    good, bad = "a calm and plain text of several words", "!!! $$$ 111 !!! $$$ 222"
    docs = documents([(i, good if i % 2 else bad) for i in range(200)] + [(None, good), (None, bad), (None, None), (5, bad)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(200) if i != 5], "doc_id long, quality int")
    kept = keep_good(spark, docs, labels)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    assert all(t != bad for _, t in texts) and (None, good) in texts and len(texts) >= 101


PAGES = [
    (1, "http://a.example/", "<html><head><title>T</title></head><!-- c --><script>x</script><p>a &amp;lt; b</p>\n<p>c  d<br>e</p></html>"),
    (2, None, None),
    (3, "u", ""),
    (3, "u", ""),
    (4, "u", "no tags < here & there &nbsp; é"),
    (5, "u", "before<script>never closed <p>x</p>" + "<script>" * 2000),
    (6, "u", "<!-- open"),
]


def test_warc(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'k' AS kind", "'x' AS block", "'2020' AS date", "1 AS record_id")
    rows = derivatives(responses(pages))
    got = rows.collect()
    assert {r.date for r in got} == {"2024-01-01T00:00:00Z"} and {r.date for r in derivatives(responses(pages, date=pages["date"])).collect()} == {"2020"}
    texts = {r.page_id: r.block for r in got if r.record_type == "conversion"}
    assert texts[1] == "T\na &lt; b\nc d\ne" and texts[2] == "" and texts[4] == "no tags < here & there é"
    assert texts[5] == "before" and texts[6] == ""
    assert len(got) == 14 and all(r.content_length == len(r.block.encode()) for r in got)
    ids = {r.record_id: r for r in got}
    assert all(ids[r.concurrent_to].refers_to == r.refers_to and ids[r.concurrent_to].record_type != r.record_type for r in got)
    write_warc(rows, str(tmp_path / "out"))
    back = read_warc(spark, str(tmp_path / "out" / "*.gz")).collect()
    assert sorted((r.record_id, bytes(r.block)) for r in back) == sorted((r.record_id, r.block.encode()) for r in got)
    one = record_text(rows.limit(1)).first().value.encode()
    assert len(list(parse_records(one))) == 1


@pytest.mark.parametrize("name", sorted(q.ORACLE_SQL))
def test_oracles(spark, name):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got, want = q.queries()[name](spark, sf).toPandas(), con.execute(q.ORACLE_SQL[name]).df()
    rows = lambda df: sorted(map(str, df[sorted(df.columns)].astype(str).values.tolist()))
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)
