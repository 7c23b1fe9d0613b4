"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit checks.

Texts and items are compared with A-Z lower-cased and white space as single spaces. A
document's item-sized windows are laid wherever a seed of an item (a long word, or a run
of words) occurs, at the place that the item would then start. A CGK walk maps windows and
items so that a small edit distance becomes a small Hamming distance; tables of sampled
positions then pair windows with items, and each pair is confirmed by its exact edit distance.

Edits can spare no long word or run of words, so each item is also cut into one piece more than
the edits it tolerates: one of them survives in every leak. Pieces are looked up at every byte,
and what has enough of the item's runs of GRAM bytes around a piece is confirmed in the same way. By
that supplement every leak is found, whether or not the LSH finds it too; ``Search.supplement`` switches it
off, and a test measures what the LSH finds alone.

Windows and items are taken in runs of about RUN_BYTES bytes, whatever the length of the items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import LOWER, mixed, slices, stored, text_bytes, word_hashes, word_spans

#: Items sent to the tasks at once; more are taken in further blocks.
ITEMS_PER_BLOCK = 20_000
#: Bytes in the runs that are counted before an edit distance is taken.
GRAM = 6
#: Bytes of padded windows or items that are embedded at once, and the most windows.
RUN_BYTES = 4 << 20
RUN_ROWS = 8192


def normalised_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space after each, and where each begins."""
    size = ends - starts
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(begin[-1], 32, np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.concatenate(([0], np.cumsum(size)[:-1])), size)
    out[np.repeat(begin[:-1], size) + inside] = data[np.repeat(starts, size) + inside]
    return out, begin[:-1]


def cgk(strings: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """CGK embeddings: rows of ``strings`` are padded bytes; the walk doubles each string's length.

    At step j the symbol under the pointer is written, and a random bit of (step, symbol)
    says whether the pointer moves on. Beyond the end a fixed symbol is written.
    """
    n, width = strings.shape
    padded = np.zeros((n, width + 1), np.uint8)
    padded[:, :width] = strings
    padded[np.arange(width + 1)[None, :] >= lengths[:, None]] = 0
    steps = 2 * width
    bits = np.random.default_rng(walk).integers(0, 2, (steps, 256)).astype(np.int64)
    out = np.zeros((steps, n), np.uint8)
    flat, base = padded.ravel(), np.arange(n) * (width + 1)
    at, last = base.copy(), base + width
    for j in range(steps):
        symbol = flat[at]
        out[j] = symbol
        at = np.minimum(at + bits[j][symbol], last)
    return out.T


@dataclass
class Pieces:
    """Pieces of items whose first bytes are taken as a number, sorted by it."""

    head: np.ndarray
    tail: np.ndarray
    size: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bloom: np.ndarray


@dataclass
class Items:
    """A block of items, its seeds and its hash tables."""

    ids: list[int]
    texts: list[str]
    width: np.ndarray
    seeds: np.ndarray
    seed_item: np.ndarray
    seed_offset: np.ndarray
    keys: np.ndarray
    key_item: np.ndarray
    codes: list[np.ndarray]
    char_bytes: list[int]
    pieces: dict[int, Pieces]


@dataclass(frozen=True)
class Search:
    """Parameters: tolerated edits per character, walks, tables and sampled positions.

    ``tables`` follows from the recall asked for: a pair within the tolerated edits agrees
    at a share ``agreement`` of embedded positions (measured, see the tests), so a table
    of ``sample`` positions finds it with agreement ** sample.
    """

    edit_rate: float = 0.1
    walks: int = 4
    sample: int = 3
    agreement: float = 0.3
    recall: float = 0.99
    supplement: bool = True
    long_word: int = 8
    long_pair: int = 11

    @property
    def tables(self) -> int:
        each = np.log(1 - self.recall) / np.log(1 - self.agreement**self.sample)
        return int(np.ceil(each / self.walks)) * self.walks


def _seeds(hashes: np.ndarray, size: np.ndarray, owner: np.ndarray, search: Search) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes and the word each begins at: long words, long pairs and all runs of three."""
    n = len(hashes)
    one = np.flatnonzero(size >= search.long_word)
    two = np.flatnonzero((owner[1:] == owner[:-1]) & (size[1:] + size[:-1] >= search.long_pair))
    three = np.flatnonzero(owner[2:] == owner[:-2]) if n > 2 else np.zeros(0, np.int64)
    times = np.uint64(0x9E3779B97F4A7C15)
    pair = mixed(hashes[two] * times + hashes[two + 1])
    run = mixed(mixed(hashes[three] * times + hashes[three + 1]) * times + hashes[three + 2] + np.uint64(1))
    return np.concatenate((hashes[one], pair, run)), np.concatenate((one, two, three))


def _tables(strings: np.ndarray, lengths: np.ndarray, search: Search) -> np.ndarray:
    """Keys (strings x tables): hashes of sampled embedding positions, the length and the table."""
    per_walk = search.tables // search.walks
    out = np.zeros((len(strings), search.tables), np.uint64)
    for walk in range(search.walks):
        embedded = cgk(strings, lengths, walk)
        share = np.random.default_rng(1000 + walk).random((per_walk, search.sample))
        place = (share[None] * (2 * lengths[:, None, None])).astype(np.int64)
        symbols = embedded[np.arange(len(strings))[:, None, None], place].astype(np.uint64)
        key = lengths[:, None].astype(np.uint64) * np.uint64(4096) + np.arange(per_walk, dtype=np.uint64) + np.uint64(walk * per_walk)
        for k in range(search.sample):
            key = mixed(key * np.uint64(257) + symbols[:, :, k])
        out[:, walk * per_walk : (walk + 1) * per_walk] = key
    return out


def by_width(width: np.ndarray) -> Iterator[np.ndarray]:
    """Indices in order of width, in runs of at most RUN_ROWS rows and, padded, about RUN_BYTES bytes."""
    order, begin = np.argsort(width, kind="stable"), 0
    while begin < len(order):
        end = min(len(order), begin + RUN_ROWS)
        # Widths rise, so a run's padding is that of its last row.
        rows = np.arange(1, end - begin + 1)
        fit = np.flatnonzero(rows * np.maximum(width[order[begin:end]], 1) <= RUN_BYTES)
        end = begin + max(1, int(fit[-1]) + 1 if len(fit) else 1)
        yield order[begin:end]
        begin = end


def _octets(text: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on as a number; beyond the end are zeros."""
    out = np.zeros(len(text), np.uint64)
    for k in range(min(8, len(text))):
        out[: len(text) - k] |= text[k:].astype(np.uint64) << np.uint64(8 * k)
    return out


def _low(octets: np.ndarray, size: int) -> np.ndarray:
    return octets & np.uint64((1 << 8 * size) - 1)


def _place(octets: np.ndarray) -> np.ndarray:
    return mixed(octets) >> np.uint64(42)


def cut_items(texts: list[str], search: Search) -> dict[int, Pieces]:
    """Pieces of each item by the number of bytes (8 at most) that they are looked up by.

    With one piece more than the tolerated edits, one is intact in every leak.
    """
    rows: dict[int, list[tuple[int, int, int, int, int]]] = {}
    for item, text in enumerate(texts):
        n = int(search.edit_rate * len(text)) + 1
        at = 0
        for k in range(n if text else 0):
            piece = text[k * len(text) // n : (k + 1) * len(text) // n].encode()
            size = min(8, len(piece))
            ends = (int.from_bytes(piece[:size], "little"), int.from_bytes(piece[-size:], "little"))
            rows.setdefault(size, []).append((*ends, len(piece), item, at))
            at += len(piece)
    out = {}
    for size, found in rows.items():
        found.sort()
        head, tail, *rest = zip(*found)
        bloom = np.zeros(1 << 22, bool)
        bloom[_place(np.array(head, np.uint64))] = True
        out[size] = Pieces(np.array(head, np.uint64), np.array(tail, np.uint64), *(np.array(c, np.int64) for c in rest), bloom)
    return out


def piece_windows(text: np.ndarray, begins: np.ndarray, ends: np.ndarray, items: Items, search: Search) -> np.ndarray:
    """Rows (item, document, start, start) where a piece lies in a text and enough of its item around it.

    ``begins`` and ``ends`` are the documents' borders in ``text``. A leak's intact piece puts its
    item's start at most the tolerated edits away, so the runs of GRAM bytes that the edits
    spare all lie in the window that is counted.
    """
    octets, parts = _octets(text), [np.zeros((0, 3), np.int64)]
    for size, pieces in items.pieces.items():
        for k in range(0, len(text), 1 << 20):
            own = _low(octets[k : k + (1 << 20)], size)
            at = np.flatnonzero(pieces.bloom[_place(own)])
            which, entry = _matches(pieces.head, own[at])
            at = at[which] + k
            last = at + pieces.size[entry]
            doc = np.searchsorted(begins, at, "right") - 1
            whole = last <= ends[doc]
            whole[whole] = _low(octets[last[whole] - size], size) == pieces.tail[entry[whole]]
            at, entry, doc = at[whole], entry[whole], doc[whole]
            parts.append(np.unique(np.column_stack((pieces.item[entry], doc, at - pieces.offset[entry])), axis=0))
    spans = np.unique(np.concatenate(parts), axis=0)
    if not len(spans):
        return np.zeros((0, 4), np.int64)
    codes, kept = grams(text), []
    member = np.zeros(1 << 16, bool)
    borders = np.append(np.flatnonzero(np.append(True, spans[1:, 0] != spans[:-1, 0])), len(spans))
    for low, high in zip(borders[:-1], borders[1:]):
        item = spans[low, 0]
        slack = int(search.edit_rate * len(items.texts[item]))
        own = spans[low:high]
        if not slack:  # the first occurrence in each document
            own = own[np.append(True, own[1:, 1] != own[:-1, 1])]
        need = len(items.codes[item]) - slack * (GRAM - 1 + items.char_bytes[item])
        if slack and need > 0:
            member[items.codes[item]] = True
            good = []
            step = max(1, RUN_BYTES // 8 // int(items.width[item] + 8 * slack))
            for k in range(0, len(own), step):
                _, doc, start = own[k : k + step].T
                a = np.maximum(begins[doc], start - 4 * slack)
                b = np.minimum(ends[doc], start + items.width[item] + 4 * slack)
                at = a[:, None] + np.arange(items.width[item] + 8 * slack)[None, :]
                there = member[codes[np.minimum(at, len(codes) - 1)]] & (at <= (b - GRAM)[:, None])
                good.append(there.sum(1) >= need)
            own = own[np.concatenate(good)]
            member[items.codes[item]] = False
        if len(own):  # windows of one document that overlap are taken as one
            new = np.append(True, (own[1:, 1] != own[:-1, 1]) | (own[1:, 2] - own[:-1, 2] > 4 * slack))
            kept.append(np.column_stack((own[new], own[np.append(new[1:], True), 2])))
    return np.concatenate(kept) if kept else np.zeros((0, 4), np.int64)


def _words_of(column: pa.Array) -> tuple[np.ndarray, ...]:
    data, offsets = text_bytes(column)
    data = LOWER[data]
    starts, ends, owner = word_spans(data, offsets)
    return data, starts, ends, owner, word_hashes(data, starts, ends)


def prepare(rows: list[tuple[int, str]], search: Search) -> Items | None:
    """Seeds and tables of a block of items; items without words are left out."""
    data, starts, ends, owner, hashes = _words_of(pa.array([t for _, t in rows], pa.string()))
    if not len(starts):
        return None
    text, begin = normalised_words(data, starts, ends)
    seeds, word = _seeds(hashes, ends - starts, owner, search)
    first = np.searchsorted(owner, np.arange(len(rows)))
    item_begin = np.append(begin, len(text))[first]
    item_end = np.append(item_begin[1:], len(text))
    width = np.maximum(item_end - item_begin - 1, 0)
    # Items too short for any seed are found by their first word.
    bare = np.setdiff1d(np.flatnonzero(width), owner[word])
    seeds, word = np.concatenate((seeds, hashes[first[bare]])), np.concatenate((word, first[bare]))
    order = np.argsort(seeds, kind="stable")
    plain = [text[b : b + w] for b, w in zip(item_begin, width)]
    used = np.flatnonzero(width)
    keys = np.zeros((len(used), search.tables), np.uint64)
    for run in by_width(width[used]):
        strings = np.zeros((len(run), int(width[used[run]].max())), np.uint8)
        for k, i in enumerate(used[run]):
            strings[k, : width[i]] = plain[i]
        keys[run] = _tables(strings, width[used[run]], search)
    by_key = np.argsort(keys.ravel(), kind="stable")
    texts = [t.tobytes().decode() for t in plain]
    return Items(
        [i for i, _ in rows],
        texts,
        width,
        seeds[order],
        owner[word][order],
        (begin[word] - item_begin[owner[word]])[order],
        keys.ravel()[by_key],
        np.repeat(used, search.tables)[by_key],
        [grams(t) for t in plain],
        [max((len(c.encode()) for c in set(t)), default=1) for t in texts],
        cut_items(texts, search),
    )


def _matches(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (index into wanted, index into the sorted table) with equal values."""
    low, high = np.searchsorted(table, wanted, "left"), np.searchsorted(table, wanted, "right")
    n = high - low
    ends = np.cumsum(n)
    inside = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
    return np.repeat(np.arange(len(wanted)), n), np.repeat(low, n) + inside


def best_edit(pattern: str, text: str) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to any substring of ``text``, and that one's end.

    Bit-parallel columns (Myers), free to begin and end anywhere in the text.
    """
    m = len(pattern)
    if (same := text.find(pattern)) >= 0:
        return 0, same + m
    peq: dict[str, int] = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, end = m, 0
    for j, c in enumerate(text, 1):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph, mh = mv | ~(xh | pv) & full, pv & xh
        score += bool(ph & high) - bool(mh & high)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv, mv = mh | ~(xv | ph) & full, ph & xv
        if score < best:
            best, end = score, j
    return best, end


def grams(text: np.ndarray) -> np.ndarray:
    """16-bit codes of the runs of GRAM bytes of a text; equal codes may stand for different runs."""
    code = np.zeros(max(0, len(text) - GRAM + 1), np.uint32)
    for k in range(GRAM):
        code = code * np.uint32(0x01000193) + text[k : k + len(code)]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(16)


FOUND = "item_id long, edit_distance int, item_length int, position long"


def find_leaks(docs: DataFrame, items: Items, search: Search) -> DataFrame:
    """Confirmed pairs of the documents (key, text) and items, once for each window that confirms one."""
    found_rows = f"key {docs.schema['key'].dataType.simpleString()}, {FOUND}"
    bloom = np.zeros(1 << 22, bool)
    bloom[items.seeds & np.uint64((1 << 22) - 1)] = True

    def windows(column: pa.Array):
        data, starts, ends, owner, hashes = _words_of(column)
        seeds, word = _seeds(hashes, ends - starts, owner, search)
        if len(items.seeds) and (items.width < 40).any():  # short items may have single short words as seeds
            seeds, word = np.concatenate((seeds, hashes)), np.concatenate((word, np.arange(len(hashes))))
        hit = bloom[seeds & np.uint64((1 << 22) - 1)]
        which, entry = _matches(items.seeds, seeds[hit])
        if not len(starts):
            return None
        word = word[hit][which]
        text, begin = normalised_words(data, starts, ends)
        used = np.unique(owner)
        begins = begin[np.searchsorted(owner, used)]
        borders = np.append(begins[1:], len(text)) - 1
        doc = np.searchsorted(used, owner[word])
        width = items.width[items.seed_item[entry]]
        start = begin[word] - items.seed_offset[entry]
        spans = np.unique(np.column_stack((doc, start, width)), axis=0)
        return text, spans, used, begins, borders

    def search_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(1 << 16, bool)

        def confirmed(text: np.ndarray, item: int, a: int, b: int, first: int) -> tuple[int, int, int] | None:
            """Edit distance, item length and position if bytes a to b hold the item."""
            pattern = items.texts[item]
            slack = int(search.edit_rate * len(pattern))
            # An edit destroys at most (GRAM - 1 + bytes of a character) runs of the item.
            codes = grams(text[a:b])
            seen[codes] = True
            missing = np.count_nonzero(~seen[items.codes[item]])
            seen[codes] = False
            if missing > slack * (GRAM - 1 + items.char_bytes[item]):
                return None
            near = text[a:b].tobytes().decode("utf-8", "ignore")
            distance, end = best_edit(pattern, near)
            if distance > slack:
                return None
            return distance, len(pattern), int(a - first) + len(near[:end].encode()) - len(pattern.encode())

        for batch in batches:
            for part in slices(batch, "text"):
                found = windows(part.column("text"))
                if found is None:
                    continue
                text, spans, used, begins, borders = found
                ids, rows = part.column("key"), {}
                tried = [piece_windows(text, begins, borders, items, search) if search.supplement else np.zeros((0, 4), np.int64)]
                for run in by_width(spans[:, 2]):
                    doc, start, width = spans[run].T
                    at = start[:, None] + np.arange(width.max())[None, :]
                    # A window is never moved at its document's borders: what lies beyond them is padding.
                    taken = text[np.clip(at, 0, len(text) - 1)]
                    taken[(at < begins[doc][:, None]) | (at >= borders[doc][:, None])] = 0
                    which, entry = _matches(items.keys, _tables(taken, width, search).ravel())
                    pairs = np.unique(np.column_stack((which // search.tables, items.key_item[entry])), axis=0)
                    w, item = pairs.T
                    tried.append(np.column_stack((item, doc[w], start[w], start[w] + width[w] - items.width[item])))
                for item, d, low, high in np.unique(np.concatenate(tried), axis=0).tolist():
                    reach = 4 * int(search.edit_rate * len(items.texts[item]))
                    a = max(int(begins[d]), low - reach)
                    b = min(int(borders[d]), high + int(items.width[item]) + reach)
                    if (row := confirmed(text, item, a, b, int(begins[d]))) is not None:
                        rows[d, item] = min(rows.get((d, item), row), row)
                if rows:
                    out = [(items.ids[i], *r) for (_, i), r in rows.items()]
                    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64())
                    own = ids.take(pa.array([int(used[d]) for d, _ in rows]))
                    yield pa.RecordBatch.from_arrays(
                        [own, *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], [x.split()[0] for x in found_rows.split(", ")]
                    )

    return docs.select("key", "text").mapInArrow(search_batch, found_rows)


def leaks_by(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, search: Search) -> DataFrame:
    """Each leaking (key, item_id) of the documents (key, text) with its best match; see :func:`leaks`."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found, block = None, []
    for row in [*items.orderBy("item_id").toLocalIterator(), None]:
        if row is not None:
            block.append((row["item_id"], row["text"]))
        if block and (row is None or len(block) == ITEMS_PER_BLOCK):
            prepared = prepare(block, search)
            if prepared is not None:
                part = find_leaks(docs, prepared, search)
                found = part if found is None else found.unionByName(part)
            block = []
    if found is None:
        return spark.createDataFrame([], f"key {docs.schema['key'].dataType.simpleString()}, {FOUND}")
    best = F.min(F.struct("edit_distance", "item_length", "position")).alias("best")
    return found.groupBy("key", "item_id").agg(best).select("key", "item_id", "best.*")


def leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, search: Search = Search()) -> DataFrame:
    """One row per leaked (doc_id, item_id): edit_distance, item_length, position.

    A document leaks an item when one of its substrings is within ``edit_rate`` times the
    item's length in edits (characters); position is the byte in the normalised text where the best match
    begins. Items are taken in blocks of ITEMS_PER_BLOCK in order of item_id. Null or
    empty texts and items never match; repeated rows give one row; other columns are ignored.
    """
    keyed = docs.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string").alias("text"))
    return leaks_by(spark, keyed, benchmark, search).withColumnRenamed("key", "doc_id")


def drop_leaks(spark: SparkSession, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that leak no item, with all their columns.

    Rows go by their text, whether they have an id or not, and another text under the same id stays.
    """
    digest = F.unhex(F.sha2(docs["text"].cast("string").cast("binary"), 256))
    keyed = docs.select(digest.alias("key"), docs["text"].cast("string").alias("text"))
    gone = stored(spark, leaks_by(spark, keyed, benchmark, Search()).select(F.col("key").alias("_leak")).distinct(), "leaks")
    return docs.join(gone, digest == gone["_leak"], "left_anti")
