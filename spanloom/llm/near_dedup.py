"""Near-dedup on word shingles: SuperMinHash signatures, banding, exact checks, union-find groups.

Documents with equal shingle sets become one class first. Classes meet in band buckets, and each
member is compared with its buckets' smallest member, the centre, on full shingle sets: that
gives links, and for every member its difference from the centre. Around a centre whose members are
then still in different groups, members are compared with each other through these differences
alone, |x & y| = |c| - |c - x| - |c - y| + |the tokens that both differences hold|, in bounded
blocks; a block gives only the links that join groups. So the rows are members times centres, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import IdFilter, dropped, mixed, shingle_hashes, slices, stored
from spanloom.llm.graph import components

#: Members of a centre that one task compares, and bytes of their differences.
BLOCK = 1024
BLOCK_BYTES = 8 << 20


def superminhash(hashes: np.ndarray, offsets: np.ndarray, size: int = 128) -> np.ndarray:
    """Signatures (texts x size) of the element sets ``hashes[offsets[i]:offsets[i + 1]]``.

    Every element walks one random permutation of the slots: in round j it offers
    ``j + r`` with a fresh uniform r to the j-th slot of its permutation. A text is done
    as soon as all its slots hold values of finished rounds, as later offers are larger.
    The value is kept as ``j << 32 | r``. Rounds run over all unfinished texts at once.
    """
    texts = len(offsets) - 1
    out = np.full(texts * size, np.iinfo(np.uint64).max, np.uint64)
    owner = np.repeat(np.arange(texts), np.diff(offsets))
    slots = np.tile(np.arange(size, dtype=np.uint8 if size <= 256 else np.uint16), (len(hashes), 1))
    for j in range(size):
        if not len(owner):
            break
        draw = mixed(hashes + np.uint64((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        k = j + (draw & np.uint64(0xFFFFFFFF)).astype(np.int64) % (size - j)
        row = np.arange(len(owner))
        slot = slots[row, k].astype(np.int64)
        slots[row, k] = slots[:, j]
        np.minimum.at(out, owner * size + slot, (np.uint64(j) << np.uint64(32)) | (draw >> np.uint64(32)))
        open_ = np.unique(owner)
        full = out.reshape(texts, size)[open_].max(axis=1) < np.uint64((j + 1) << 32)
        done = np.zeros(texts, bool)
        done[open_[full]] = True
        on = ~done[owner]
        if not on.all():
            owner, hashes, slots = owner[on], hashes[on], slots[on]
    return out.reshape(texts, size)


def band_keys(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` slots; the band's number is part of the key."""
    texts, size = signatures.shape
    bands = signatures[:, : size // rows * rows].reshape(texts, size // rows, rows)
    key = np.broadcast_to(np.arange(size // rows, dtype=np.uint64) + np.uint64(1), bands.shape[:2]).copy()
    for r in range(rows):
        key = mixed(key * np.uint64(0x100000001B3) + bands[:, :, r])
    return key


def set_keys(hashes: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums over each set; sets with equal sums and sizes are taken as equal."""
    out = []
    for salt in (0x51ED270B, 0xB5297A4D):
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(salt)))))
        out.append((total[offsets[1:]] - total[offsets[:-1]]).view(np.int64))
    return out


SKETCH = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>"


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


def sketches(docs: DataFrame, words: int, size: int, rows: int, digest: bool = False) -> DataFrame:
    """Shingle count, a 128-bit key of the shingle set and the band keys of every document, on demand its text's SHA-256."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1 << 19):
                hashes, offsets = shingle_hashes(part.column("text"), words)
                n, sums = np.diff(offsets), set_keys(hashes, offsets)
                keys = band_keys(superminhash(hashes, offsets, size), rows)
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1) * keys.shape[1], pa.int32()), pa.array(keys.view(np.int64).ravel())
                )
                more = [part.column("digest")] if digest else []
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(n), *map(pa.array, sums), bands, *more],
                    [x.split()[0] for x in kind.split(", ")],
                )

    kind = f"{SKETCH}, digest binary" if digest else SKETCH
    rows_in = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows_in.withColumn("digest", _digest(F.col("text"))) if digest else rows_in).mapInArrow(sketch, kind)


SETS = "doc_id long, set_a long, set_b long, tokens array<long>"


def shingle_sets(docs: DataFrame, words: int, wanted: IdFilter | None = None) -> DataFrame:
    """The shingle hashes of every document, sorted, beside the key of the set; with ``wanted`` only of ids that may be in it."""
    maybe = wanted.test() if wanted else None

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if maybe:
                batch = batch.filter(pa.array(maybe(batch.column("doc_id").to_numpy())))
            for part in slices(batch, "text", 1 << 19):
                hashes, offsets = shingle_hashes(part.column("text"), words)
                tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *map(pa.array, set_keys(hashes, offsets)), tokens], [x.split()[0] for x in SETS.split(", ")]
                )

    return docs.mapInArrow(sets, SETS)


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a column of 64-bit lists."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64), offsets - offsets[0]


def difference(centre: np.ndarray, tokens: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each list of tokens: those of the centre that it lacks, how many, and its own beyond the centre's.

    ``centre`` and the lists are sorted and without repeats. Returns (row, token, lacking) with
    the rows in order, the tokens that a row lacks before its own ones.
    """
    n, row = len(offsets) - 1, np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.minimum(np.searchsorted(centre, tokens), max(0, len(centre) - 1))
    known = centre[at] == tokens if len(centre) else np.zeros(len(tokens), bool)
    lacks = np.ones((n, len(centre)), bool)
    lacks[row[known], at[known]] = False
    lack_row, lack_at = np.nonzero(lacks)
    rows = np.concatenate((lack_row, row[~known]))
    values = np.concatenate((centre[lack_at], tokens[~known]))
    order = np.argsort(rows, kind="stable")
    return rows[order], values[order], np.bincount(lack_row, minlength=n)


STARS = "a long, b long, linked boolean, n_a int, lacking int, apart array<long>"


def compared(rows: DataFrame, percent: int) -> DataFrame:
    """Members against their centres, from rows (a, part, b, centre, several, tokens).

    Gives (a, b, linked, n_a, lacking, apart): whether the sets have ``percent`` % in common, the
    centre's size and, where the centre has ``several`` members, the member's difference from it.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.uint64)
        for batch in batches:
            a, part, b = (batch.column(c).to_numpy() for c in ("a", "part", "b"))
            centre, several = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("centre", "several"))
            tokens, offsets = _lists(batch.column("tokens"))
            cuts = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (part[1:] != part[:-1])))
            for begin, end in zip(cuts, np.append(cuts[1:], batch.num_rows)):
                while begin < end and centre[begin]:
                    held = tokens[offsets[begin] : offsets[begin + 1]].copy()
                    begin += 1
                step = max(1, (4 << 20) // max(1, len(held)))
                for k in range(begin, end, step):
                    stop = min(end, k + step)
                    own = offsets[k : stop + 1]
                    row, value, lacking = difference(held, tokens[own[0] : own[-1]], own - own[0])
                    both = len(held) - lacking
                    linked = 100 * both >= percent * (np.diff(own) + lacking)
                    if not several[k]:
                        row, value = row[:0], value[:0]
                    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=stop - k))))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(a[k:stop]), pa.array(b[k:stop]), pa.array(linked), pa.array(np.full(stop - k, len(held), np.int32)),
                            pa.array(lacking.astype(np.int32)),
                            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(value.view(np.int64))),
                        ],
                        [x.split()[0] for x in STARS.split(", ")],
                    )

    given = rows.select("a", "part", "b", "centre", "several", "tokens")
    return given.repartition("a", "part").sortWithinPartitions("a", "part", F.col("centre").desc(), "b").mapInArrow(compare, STARS)


def shared_tokens(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray], dense: int = 64) -> np.ndarray:
    """How many tokens each list of ``x`` has in common with each list of ``y`` (a matrix).

    Tokens that meet at most ``dense`` times are counted one by one, all others as a matrix product.
    """
    k, m = len(x[1]) - 1, len(y[1]) - 1
    out = np.zeros((k, m), np.float32)
    row, col = (np.repeat(np.arange(n), np.diff(z[1])) for n, z in ((k, x), (m, y)))
    known, first = np.unique(x[0], return_inverse=True)
    if not len(known):
        return out
    second = np.minimum(np.searchsorted(known, y[0]), len(known) - 1)
    hit = known[second] == y[0]
    second, col = second[hit], col[hit]
    often = np.bincount(first, minlength=len(known)), np.bincount(second, minlength=len(known))
    meets = often[0] * often[1]
    rare = (meets > 0) & (meets <= dense)
    by_token = np.argsort(second, kind="stable")
    ends = np.cumsum(often[1])
    own = np.flatnonzero(rare[first])
    times = often[1][first[own]]
    step = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    partner = col[by_token[np.repeat((ends - often[1])[first[own]], times) + step]]
    np.add.at(out, (np.repeat(row[own], times), partner), 1)
    common = np.flatnonzero(meets > dense)
    for begin in range(0, len(common), 1024):
        chosen = common[begin : begin + 1024]
        place = np.full(len(known), -1)
        place[chosen] = np.arange(len(chosen))
        sides = []
        for n, owner, token in ((k, row, first), (m, col, second)):
            at = place[token]
            side = np.zeros((n, len(chosen)), np.float32)
            side[owner[at >= 0], at[at >= 0]] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    return out


def joining(links: np.ndarray, row: np.ndarray, col: np.ndarray, label: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of a matrix of links between nodes ``row`` and ``col`` those that join groups, group labels given.

    Every node takes the smallest label that it is linked to until nothing changes; each step is a
    link that is given, so nodes with a link end in one group and at most a few links a node are given.
    """
    label, big = label.copy(), np.iinfo(np.int64).max
    while True:
        moved = False
        for matrix, x, y in ((links, row, col), (links.T, col, row)):
            found = np.where(matrix, label[y][None, :], big)
            best = found.argmin(axis=1)
            value = found[np.arange(len(x)), best]
            better = np.flatnonzero(value < label[x])
            if len(better):
                moved = True
                yield x[better], y[best[better]]
                np.minimum.at(label, x[better], value[better])
        if not moved:
            return


def linked_in_blocks(stars: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between members of one centre that are in different groups so far.

    Members outside a centre's largest group are compared with all its members. Both sides are dealt
    to blocks of about BLOCK members or BLOCK_BYTES bytes, and each pair of blocks is one task's work.
    """
    rows = stars.join(labels.withColumnRenamed("node", "b"), "b", "left")
    rows = rows.withColumn("component", F.coalesce("component", "b"))
    sizes = rows.groupBy("a", "component").agg(F.count(F.lit(1)).alias("_n"), F.sum(F.size("apart")).alias("_bytes"))
    sizes = sizes.groupBy("a").agg(
        F.max_by("component", F.struct("_n", "component")).alias("_main"),
        F.count(F.lit(1)).alias("_groups"),
        F.sum("_n").alias("_all"),
        (F.sum("_n") - F.max("_n")).alias("_few"),
        (F.sum("_bytes") * 8).alias("_bytes"),
    )
    sizes = sizes.filter("_groups > 1")
    many = F.ceil(F.greatest(F.col("_all") / BLOCK, F.col("_bytes") / BLOCK_BYTES)).cast("int")
    few = F.ceil(F.greatest(F.col("_few") / BLOCK, F.col("_bytes") * F.col("_few") / F.col("_all") / BLOCK_BYTES)).cast("int")
    rows = rows.join(sizes.select("a", "_main", F.greatest(many, F.lit(1)).alias("_many"), F.greatest(few, F.lit(1)).alias("_few")), "a")
    # A member of the smaller groups goes as a row to all blocks of columns, every member as a column to all blocks of rows.
    own = F.xxhash64("b")
    place = lambda side, i, j: F.struct(F.lit(side).alias("side"), i.cast("int").alias("i"), j.cast("int").alias("j"))
    columns = F.transform(F.sequence(F.lit(0), F.col("_few") - 1), lambda i: place(1, i, F.pmod(own, F.col("_many"))))
    across = F.transform(F.sequence(F.lit(0), F.col("_many") - 1), lambda j: place(0, F.pmod(own, F.col("_few")), j))
    across = F.when(F.col("component") != F.col("_main"), across).otherwise(F.slice(across, 1, 0))
    dealt = rows.withColumn("at", F.explode(F.concat(columns, across)))
    dealt = dealt.select("a", F.col("at.i").alias("i"), F.col("at.j").alias("j"), F.col("at.side").alias("side"), "b", "component", "n_a", "lacking", "apart")

    def block(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = pa.Table.from_batches(parts).combine_chunks()
        side, b, component, n_a, lacking = (whole.column(c).to_numpy() for c in ("side", "b", "component", "n_a", "lacking"))
        tokens, offsets = _lists(whole.column("apart"))
        split = int(np.searchsorted(side, 1))
        if not 0 < split < len(side):
            return
        size = n_a - 2 * lacking + np.diff(offsets)  # |x| = |c| - lacking + own, and a difference has lacking + own tokens
        sides = (tokens[: offsets[split]], offsets[: split + 1]), (tokens[offsets[split] :], offsets[split:] - offsets[split])
        both = shared_tokens(*sides).astype(np.int64)
        both += (n_a[:split] - lacking[:split])[:, None] - lacking[None, split:]
        links = 100 * both >= percent * (size[:split][:, None] + size[None, split:] - both)
        nodes, at = np.unique(b, return_inverse=True)
        label = np.zeros(len(nodes), np.int64)
        label[at] = component
        for x, y in joining(links, at[:split], at[split:], label):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[x]), pa.array(nodes[y])], ["a", "b"])

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, last = [], None
        for batch in batches:
            key = np.column_stack([batch.column(c).to_numpy() for c in ("a", "i", "j")])
            cuts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
            for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(key)]):
                if last is not None and (key[begin] != last).any():
                    yield from block(parts)
                    parts = []
                parts.append(batch.slice(begin, end - begin))
                last = key[begin]
        if parts:
            yield from block(parts)

    return dealt.repartition("a", "i", "j").sortWithinPartitions("a", "i", "j", "side").mapInArrow(blocks, "a long, b long")


def near_groups(
    spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, size: int = 128, rows: int = 5, digest: bool = False
) -> DataFrame:
    """(doc_id, n_shingles, component_id, lead) of every document; see :func:`near_dedup`.

    ``lead`` marks the rows that stand for their component: those of its smallest id (of several texts
    under that id one is taken by the key of its set). With ``digest`` the rows also carry their text's SHA-256.
    """
    extra = ["digest"] if digest else []
    sketch = stored(spark, sketches(docs, words, size, rows, digest), "sketches")
    key = ["set_a", "set_b", "n_shingles"]
    # Each distinct set is a node of its own, whatever ids its rows have; the numbers are fixed by storing them.
    groups = sketch.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    groups = stored(spark, groups.withColumn("node", F.monotonically_increasing_id()), "classes")
    # Plain scans on both sides, so that adaptive execution splits a class of very many copies.
    own = F.col("node").isNotNull() & F.col("doc_id").eqNullSafe(F.col("rep"))
    members = sketch.join(groups, key, "left").select("doc_id", *extra, *key, "rep", "node", F.when(own, F.col("bands")).alias("bands"))
    members = stored(spark, members, "members")
    dropped(spark, sketch)
    spots = members.filter("bands IS NOT NULL").select(F.col("node").alias("b"), F.explode("bands").alias("key"))
    buckets = spots.groupBy("key").agg(F.min("b").alias("a"), F.max("b").alias("_last")).filter("a < _last").select("key", "a")
    buckets = stored(spark, buckets, "buckets")
    stars = stored(spark, spots.join(buckets, "key").filter("a <> b").select("a", "b").distinct(), "stars")
    centres = stars.groupBy("a").agg(F.count(F.lit(1)).alias("_n"))
    centres = centres.select("a", (F.col("_n") > 1).alias("several"), F.ceil(F.col("_n") / (4 * BLOCK)).cast("int").alias("_parts"))
    dealt = stars.join(centres, "a").select("a", F.pmod(F.xxhash64("b"), F.col("_parts")).cast("int").alias("part"), "b", F.lit(False).alias("centre"), "several")
    heads = centres.select("a", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("part"), F.col("a").alias("b"), F.lit(True).alias("centre"), "several")
    dealt = stored(spark, dealt.unionByName(heads), "dealt")
    needed = groups.join(dealt.select(F.col("b").alias("node")).distinct(), "node", "left_semi").select("rep", "set_a", "set_b", "node")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows without an id can't be told apart: of each of their texts one is read.
    nameless = texts.filter("doc_id IS NULL AND text IS NOT NULL").withColumn("_t", F.sha2(F.col("text").cast("binary"), 256)).dropDuplicates(["_t"])
    # Most other rows are passed by before anything is shuffled; the join below is exact.
    texts = shingle_sets(texts.filter("doc_id IS NOT NULL"), words, IdFilter(needed.select("rep"))).unionByName(shingle_sets(nameless.drop("_t"), words))
    same = texts["doc_id"].eqNullSafe(needed["rep"]) & (texts["set_a"] == needed["set_a"]) & (texts["set_b"] == needed["set_b"])
    sets = texts.join(needed, same).select(F.col("node").alias("b"), "tokens")
    found = stored(spark, compared(dealt.join(sets, "b"), percent), "compared")
    for done in (buckets, stars, dealt):
        dropped(spark, done)
    stars = found

    links = stars.filter("linked").select("a", "b")
    labels = components(spark, links)
    more = stored(spark, linked_in_blocks(stars, labels, percent), "links")
    if more.limit(1).count():
        labels = components(spark, links.union(more))
    # Of each component the smallest id, and the node that stands for it.
    placed = groups.join(labels, "node")
    first = F.min(F.struct(F.col("rep").isNull().alias("_nameless"), F.col("rep").alias("rep"), F.col("set_a"), F.col("set_b"), F.col("node")))
    heads = placed.groupBy("component").agg(first.alias("_f")).select("component", F.col("_f.rep").alias("component_id"), F.col("_f.node").alias("_head"))
    found = stored(spark, placed.select("node", "component").join(heads, "component").select("node", "component_id", "_head"), "groups")
    own = F.col("doc_id").eqNullSafe(F.col("rep")) & F.coalesce(F.col("_head") == F.col("node"), F.lit(True))
    return members.join(found, "node", "left").select(
        "doc_id",
        *extra,
        "n_shingles",
        F.when(F.col("_head").isNotNull(), F.col("component_id")).when(F.col("node").isNotNull(), F.col("rep")).otherwise(F.col("doc_id")).alias("component_id"),
        F.when(F.col("node").isNotNull(), own).otherwise(True).alias("lead"),
    )


def near_dedup(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80, size: int = 128, rows: int = 5) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Words are runs of non-blank characters with A-Z lower-cased; a document's set is its
    distinct ``words``-word shingles, or its whole sequence where it is shorter. Documents
    link when 100 * intersection >= percent * union of the full sets; component_id is the
    smallest doc_id reachable. Null, empty and blank texts have no set and link with
    nothing; repeated rows share their class; rows that repeat an id with different texts are placed by
    their own text each; a row without an id joins its group but never represents it, and a group of null ids
    alone has component_id null. Other columns are ignored. A pair at 0.8 shares none of the 25 bands of 5 slots
    with a probability of 5e-5; whatever shares a band is decided on full sets.
    """
    found = near_groups(spark, docs, words, percent, size, rows).drop("lead")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Documents without near copies: of each group the row of smallest doc_id stays; columns stay too.

    Rows go by id and text together, so a text stays whatever happens to another one under its id. Rows that
    repeat an id and its text stay together. Of a group without ids those rows stay whose set has the smallest key.
    """
    found = near_groups(spark, docs, words, percent, digest=True)
    gone = stored(spark, found.filter("NOT lead").select(F.col("doc_id").alias("_id"), "digest"), "gone")
    # Rows whose id isn't among those to go stay without being shuffled.
    maybe = IdFilter(gone.select("_id")).column(docs["doc_id"])
    same = docs["doc_id"].cast("long").eqNullSafe(gone["_id"]) & (_digest(docs["text"]) == gone["digest"])
    return docs.filter(~maybe).unionByName(docs.filter(maybe).join(gone, same, "left_anti"))
