"""N-gram Jaccard join by token-combination prefixes.

A document is the set of hashes of its distinct word 5-grams ("tokens" below). Tokens are ordered by how often they
occur in the corpus, rare ones first. Documents of Jaccard similarity of 4/5 or more miss at most n // 5 of each other's
tokens, so a prefix that n // 5 misses can't empty must share a signature:

* a token of the rare class is a signature by itself and stands for one unit;
* tokens of the frequent class are dealt by hash into groups; a signature is a pair of tokens of one group, and a
  group of m tokens stands for m - 1 units, as m - 1 misses are needed to leave no pair.

The prefix is extended until it has n // 5 + 1 units. The number of groups follows the set size; it must be equal for
both documents, so signatures of the frequent class are made for the document's size band and the next one.

Candidates that their odd sketches (parities of hashed tokens, which bound a difference from below) don't rule out are
verified on the whole sets. Copies with equal sets collapse into one representative first. In a bucket
(documents that share a signature) members are verified against a pivot, not against each other. Where verified links
leave a bucket in several classes, its members' differences from a common pivot are joined by the same kind of prefix (see
edit_signatures), which tells near copies apart by their edits. So a group of near copies costs its size, not its
square, and no link between classes is lost.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm import textvec as tv
from loomwell.llm.common import bitmap, checkpoint, in_bitmap, release_workers_state
from loomwell.llm.components import components

#: log2 of the counters of the frequency sketch: it fixes the sketch's size (32 MB), not which tokens are counted.
SKETCH_BITS = 25
#: A token is frequent from this count on, or from eight times the sketch's mean load.
FREQUENT = 512
FILTER_BITS = 24
_BLOCK = 1 << 19
#: Sets and tokens of a part of a class; links are counted between two parts at a time.
PART_SETS, PART_TOKENS = 2048, 1 << 21
#: Differences from a pivot are banded by their sizes, in steps of this part of the bucket's largest set.
EDIT_BANDS = 12
#: Tokens that the sketch's tasks hold before they are counted, and rows of a batch that leaves a task: both bound its memory.
HELD_TOKENS, ROWS = 1 << 20, 512
#: Words of 64 bits of a difference's odd sketch, which travels with its keys.
EDIT_WORDS = 8


def bands() -> np.ndarray:
    """Least set size of each band; sizes within 4/5 of each other are at most one band apart."""
    least = [1]
    while least[-1] < 1 << 40:
        least.append(max(least[-1] + 1, -(-5 * least[-1] // 4)))
    return np.array(least, dtype=np.int64)


_BANDS = bands()


def groups_of(band: int) -> int:
    return max(1, int(_BANDS[band]) // 10)


def sets_of(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes) of each text's k-word shingles; of fewer words, their whole sequence; of none, nothing."""
    for a, b in tv.slices(texts):
        w = tv.words(texts.slice(a, b - a), tv.SPACE)
        hashes = w.hashes()
        grams = tv.windows(hashes, k)
        for i in range(b - a):
            first, last = int(w.first[i]), int(w.first[i + 1])
            if last - first >= k:
                yield a + i, np.unique(grams[first : last - k + 1])
            elif last > first:
                yield a + i, tv.windows(hashes[first:last], last - first)
            else:
                yield a + i, hashes[:0]


def _slots(tokens: np.ndarray, bits: int) -> np.ndarray:
    return (tokens & np.uint64((1 << bits) - 1)).astype(np.int64)


def rank_of(counts: np.ndarray) -> np.ndarray:
    """Counts on a logarithmic scale of one byte: small counts keep apart, and 255 stands for 2**31.9 and more."""
    return np.minimum(255, 8 * np.log2(1.0 + counts)).astype(np.uint8)


def frequency_sketch(docs: DataFrame, k: int, bits: int) -> tuple[np.ndarray, float]:
    """(ranks, mean count): how many documents hold a token of each slot, counted over all documents, as ranks of one byte;
    2**bits of them whatever the input.

    Tasks count locally (to 65,535 for a slot, far within the frequent class) and send compressed blocks of counters;
    blocks are added up in two steps, in about as many lanes as a lane has blocks, so no group grows with more than the
    root of the number of tasks.
    """
    size = min(_BLOCK, 1 << bits)
    widths = {1: np.uint8, 2: np.uint16, 8: np.int64}
    schema = "block int, counts binary, width int"

    def packed(block: int, counts: np.ndarray) -> pa.RecordBatch:
        small = counts.astype(np.uint8) if counts.max() < 256 else counts
        body = pa.compress(small.tobytes(), codec="zstd", asbytes=True)
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([body], pa.binary()), pa.array([small.itemsize], pa.int32())], ["block", "counts", "width"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_workers_state()
        own = np.zeros(1 << bits, dtype=np.uint16)

        def add_up(held: list[np.ndarray]) -> None:
            slots, times = np.unique(np.concatenate(held), return_counts=True)
            own[slots] = np.minimum(own[slots] + times, 65535)

        for batch in batches:
            held, n = [], 0
            for _, s in sets_of(batch.column(0), k):
                held.append(_slots(s, bits).astype(np.uint32))
                n += len(s)
                if n >= HELD_TOKENS:
                    add_up(held)
                    held, n = [], 0
            if held:
                add_up(held)
        for i, part in enumerate(own.reshape(-1, size)):
            yield packed(i, part)

    def total(table: pa.Table) -> np.ndarray:
        out = np.zeros(size, dtype=np.int64)
        for body, width in zip(table["counts"], table["width"].to_pylist(), strict=True):
            out += np.frombuffer(pa.decompress(body.as_buffer(), decompressed_size=size * width, codec="zstd"), dtype=widths[width])
        return out

    def add(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([packed(table["block"][0].as_py(), total(table))])

    def finish(table: pa.Table) -> pa.Table:
        counts = total(table)
        ranks = pa.compress(rank_of(counts).tobytes(), codec="zstd", asbytes=True)
        return pa.table({"block": table["block"].slice(0, 1), "ranks": pa.array([ranks], pa.binary()), "total": pa.array([int(counts.sum())], pa.int64())})

    lanes = max(1, int(docs.rdd.getNumPartitions() ** 0.5))
    blocks = docs.mapInArrow(count, schema).withColumn("lane", F.spark_partition_id() % lanes)
    summed = blocks.groupBy("block", "lane").applyInArrow(lambda t: add(t), schema).groupBy("block").applyInArrow(lambda t: finish(t), "block int, ranks binary, total long").toArrow()
    out = np.zeros(1 << bits, dtype=np.uint8)
    for block, ranks in zip(summed["block"].to_pylist(), summed["ranks"], strict=True):
        out[block * size : (block + 1) * size] = np.frombuffer(pa.decompress(ranks.as_buffer(), decompressed_size=size, codec="zstd"), dtype=np.uint8)
    return out, sum(summed["total"].to_pylist()) / (1 << bits)


def prefix_units(tokens: np.ndarray, rank: np.ndarray, frequent: int, need: int, groups: int, tag: int) -> tuple[np.ndarray, bool]:
    """Signatures of the shortest prefix with ``need`` units, and whether there is one; else those of all tokens.

    Tokens are ordered by (rank, token); from rank ``frequent`` on they are of the frequent class. ``groups`` and
    ``tag`` (mixed into pairs) must be equal for both sets that are to be compared.
    """
    order = np.lexsort((tokens, rank))
    tokens, rank = tokens[order], rank[order]
    rare = int(np.searchsorted(rank, frequent))
    if rare >= need:
        return tokens[:need], True
    common = tokens[rare:]
    group = (tv.mix(common + np.uint64(tag)) % np.uint64(groups)).astype(np.int64)
    first = np.zeros(len(common), dtype=bool)
    first[np.unique(group, return_index=True)[1]] = True
    units = rare + np.cumsum(~first)  # each frequent token is a unit, but for the first of its group
    m = int(np.searchsorted(units, need)) + 1
    reached, m = m <= len(common), min(m, len(common))
    by = np.argsort(group[:m], kind="stable")
    own, label, out = common[:m][by], group[:m][by], [tokens[:rare]]
    for gap in range(1, m):
        same = np.flatnonzero(label[gap:] == label[:-gap])
        if not len(same):
            break
        out.append(tv.mix(own[same] * tv.ODD[1] + own[same + gap] * tv.ODD[2] + np.uint64(tag)))
    return np.concatenate(out), reached


def signatures(tokens: np.ndarray, ranks: np.ndarray, frequent: int) -> np.ndarray:
    """Signatures of a set of distinct tokens; ``ranks`` are the sketch's ranks of them, ``frequent`` is the first of the frequent class."""
    n = len(tokens)
    if n < 2:  # links to equal sets only, which collapse before
        return tokens
    band = int(np.searchsorted(_BANDS, n, side="right")) - 1
    return np.unique(np.concatenate([prefix_units(tokens, ranks, frequent, n // 5 + 1, groups_of(at), at)[0] for at in (band, band + 1)]))


def edit_signatures(tokens: np.ndarray, pivot: np.ndarray, largest: int, ranks: np.ndarray) -> tuple[int, bytes, np.ndarray, np.ndarray]:
    """(size, odd sketch, signatures, place of each) of a set's difference from its bucket's pivot.

    Two sets of sizes n and m link just if their symmetric difference is at most h = (n + m) / 9, and it equals that of
    their differences x and y from any third set. So x misses at most (h + |x| - |y|) / 2 of y's tokens, and signatures
    are made for each band of |y| within reach, with a prefix that so many misses can't empty; a key names both bands.
    For differences of equal sizes that is a prefix of half of h, which the tokens that two unlinked members don't share
    fill, if those come first: tokens added are the rare class, those rare in the corpus first; the pivot's tokens that
    are missing are the frequent class. ``largest`` is the size of the bucket's largest set. The place of a token of the
    rare class is how many tokens come before it; where it is the first that x and y share, x misses as many of y's at
    least, so pairs are held against their places (see FITS) and few go on. Other signatures have place 0.

    A difference too small for such a prefix gives the signatures of all its tokens and each token by itself. That
    is enough: two of them that share no token differ by |x| + |y| <= (n + m) / 9, and as n <= p + |x|, p being the
    pivot's size, |y| <= (m + p) / 9; so both link to the pivot and are of one class already.
    """
    n = len(tokens)
    reach = (n + min(5 * n // 4, largest)) // 9
    added, missing = np.setdiff1d(tokens, pivot, assume_unique=True), np.setdiff1d(pivot, tokens, assume_unique=True)
    diff = np.concatenate([added, tv.mix(missing + np.uint64(1))])
    rank = np.append(ranks[_slots(added, len(ranks).bit_length() - 1)].astype(np.int16), np.full(len(missing), 256, dtype=np.int16))
    order = np.lexsort((diff, rank))
    diff, rank = diff[order], rank[order]
    width, groups, size, rare = max(1, largest // EDIT_BANDS), max(1, len(pivot) // 30), len(diff), len(added)
    out, places = [], []
    for other in range(max(0, size - reach) // width, (size + reach) // width + 1):
        need = min(size, (reach + size - other * width) // 2) + 1
        own, place = diff[:need], np.arange(need, dtype=np.int32)
        if need > rare:
            own, reached = prefix_units(diff, rank, 256, need, groups, 0)
            if not reached:
                own = np.concatenate([own, tv.mix(diff[rare:] + np.uint64(2))])
            place = np.zeros(len(own), dtype=np.int32)
            place[:rare] = np.arange(rare)
        bands_of_both = np.array(sorted((size // width, other)), dtype=np.uint64) * tv.ODD[5:7]
        out.append(tv.mix(own + bands_of_both.sum(dtype=np.uint64)))
        places.append(place)
    return size, odd_sketch(diff, 64 * EDIT_WORDS), np.concatenate(out), np.concatenate(places)


#: Whether two rows of a key may link: sizes fit, neither set misses more of the other's tokens than its place allows, and
#: their odd sketches don't differ too much.
FITS = (
    "rep_x < rep_y AND label_x <> label_y AND 5 * n_x >= 4 * n_y AND 5 * n_y >= 4 * n_x AND 9 * abs(e_x - e_y) <= n_x + n_y"
    " AND 18 * place_x <= n_x + n_y + 9 * (e_x - e_y) AND 18 * place_y <= n_x + n_y + 9 * (e_y - e_x) AND 9 * ("
    + " + ".join(f"bit_count(o{i}_x ^ o{i}_y)" for i in range(EDIT_WORDS))
    + ") <= n_x + n_y"
)


def odd_sketch(tokens: np.ndarray, slots: int | None = None) -> bytes:
    """A bit for each slot of a table, by default of at least one slot per token: whether an odd number of tokens fall there."""
    slots = slots or (max(64, 1 << (len(tokens) - 1).bit_length()) if len(tokens) else 64)
    odd = np.bincount((tokens & np.uint64(slots - 1)).astype(np.int64), minlength=slots) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets from their odd sketches: tokens of both sets cancel out, and
    each slot that is left needs one token of the difference. The larger sketch is folded to the smaller one's slots."""
    a, b = np.frombuffer(x, dtype=np.uint8), np.frombuffer(y, dtype=np.uint8)
    size = min(len(a), len(b))
    a, b = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (a, b))
    return int(np.bitwise_count(a ^ b).sum())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ROWS rows, so that what a task makes of one is bounded."""
    for batch in batches:
        for a in range(0, batch.num_rows, ROWS):
            yield batch.slice(a, ROWS)


def _sketched(docs: DataFrame, k: int, sent: Broadcast, frequent: int) -> DataFrame:
    """(id, n, d1, d2, odd, sigs): set size, 128-bit digest, odd sketch and signatures of each document's set."""
    import hashlib

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release_workers_state()
        sketch = sent.value
        bits = len(sketch).bit_length() - 1
        for batch in _parts(batches):
            n, d1, d2, odd, sigs = [], [], [], [], []
            for _, s in sets_of(batch.column(1), k):
                digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
                n.append(len(s))
                d1.append(int.from_bytes(digest[:8], "little", signed=True))
                d2.append(int.from_bytes(digest[8:], "little", signed=True))
                odd.append(odd_sketch(s))
                sigs.append(signatures(s, sketch[_slots(s, bits)], frequent).view(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(odd, pa.binary()), pa.array(sigs, pa.binary())], ["id", "n", "d1", "d2", "odd", "sigs"])

    return docs.select("id", "text").mapInArrow(run, "id long, n long, d1 long, d2 long, odd binary, sigs binary")


def _stored(df: DataFrame) -> DataFrame:
    """A checkpoint, after which shuffle files and checkpoints that nothing refers to are let go: a driver with a large
    heap would keep them, and executors' disks would hold every step's shuffle."""
    out = checkpoint(df)
    gc.collect()
    pa.default_memory_pool().release_unused()
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def _postings(reps: DataFrame) -> DataFrame:
    """(sig, rep) rows of representatives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(s, dtype=np.int64) for s in batch.column(1).to_pylist()]
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), [len(s) for s in own])
            sigs = np.concatenate(own) if own else np.zeros(0, dtype=np.int64)
            for a in range(0, len(sigs), 1 << 18):
                yield pa.RecordBatch.from_arrays([pa.array(sigs[a : a + (1 << 18)], pa.int64()), pa.array(ids[a : a + (1 << 18)], pa.int64())], ["sig", "rep"])

    return reps.select("rep", "sigs").mapInArrow(run, "sig long, rep long")


def _members(reps: DataFrame, many: DataFrame) -> DataFrame:
    """(bucket, rep) rows for the signatures in ``many``: a bucket is a signature and a size band, so that it holds sets of
    fitting sizes; each set is in the buckets of its own band and of the next. A bitmap spares the other rows the shuffle."""
    sent = reps.sparkSession.sparkContext.broadcast(bitmap(many, "sig", FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(s, dtype=np.int64) for s in batch.column(1).to_pylist()]
            count = [len(s) for s in own]
            band = np.repeat(np.searchsorted(_BANDS, batch.column(2).to_numpy(zero_copy_only=False), side="right") - 1, count)
            ids = np.repeat(batch.column(0).to_numpy(zero_copy_only=False), count)
            sigs = np.concatenate(own) if own else np.zeros(0, dtype=np.int64)
            at = in_bitmap(sent.value, sigs & ((1 << FILTER_BITS) - 1))
            sigs, ids, band = sigs[at], ids[at], band[at]
            for tag in (band, band + 1):
                bucket = tv.mix(sigs.view(np.uint64) + tag.astype(np.uint64) * tv.ODD[3]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(sigs, pa.int64()), pa.array(bucket, pa.int64()), pa.array(ids, pa.int64())], ["sig", "bucket", "rep"])

    rows = reps.select("rep", "sigs", "n").mapInArrow(run, "sig long, bucket long, rep long")
    return rows.join(many.select("sig"), "sig", "left_semi").select("bucket", "rep").distinct()


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, text) of the documents in ``wanted`` (id) and the few that a bitmap lets pass; joins on the id drop those.

    Texts travel, not sets: a text is smaller than the hashes of its shingles, and it can be compressed."""
    sent = docs.sparkSession.sparkContext.broadcast(bitmap(wanted, "id", FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            yield batch.filter(pa.array(in_bitmap(sent.value, ids & ((1 << FILTER_BITS) - 1))))

    return docs.select("id", "text").mapInArrow(run, "id long, text string")


def _sets_along(texts: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The set of each text; equal texts in a row are made into sets once."""
    if len(texts):
        texts = texts.fill_null("")
        same = pa.compute.equal(texts.slice(1), texts.slice(0, len(texts) - 1)).to_numpy(zero_copy_only=False)
        first = np.flatnonzero(np.append(True, ~same.astype(bool)))
        for (_, s), times in zip(sets_of(texts.take(pa.array(first)), k), np.diff(np.append(first, len(texts))), strict=True):
            yield from repeat(s, int(times))


def _verified(pairs: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= 80 * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(_sets_along(batch.column(2), k), _sets_along(batch.column(3), k), strict=True):
                both = len(np.intersect1d(p, q, assume_unique=True))
                good.append(100 * both >= 80 * (len(p) + len(q) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    left = texts.select(F.col("id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("id").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _fitting(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """The pairs whose sizes and odd sketches don't rule a link out, before their texts are fetched: sets of sizes n and m
    link just if their symmetric difference is at most (n + m) / 9. Ids with several sets have no sketch and pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, most, x, y = batch.columns
            near = [p is None or q is None or 9 * least_difference(p, q) <= m for m, p, q in zip(most.to_pylist(), x.to_pylist(), y.to_pylist(), strict=True)]
            mask = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([a.filter(mask), b.filter(mask)], ["a", "b"])

    x, y = (sizes.select(F.col("rep").alias(c), F.col("n0").alias(f"{c}0"), F.col("n1").alias(f"{c}1"), F.col("odd").alias(f"{c}_odd")) for c in "ab")
    fit = pairs.join(x, "a").join(y, "b").where("5 * a1 >= 4 * b0 AND 5 * b1 >= 4 * a0")
    return fit.select("a", "b", F.expr("a1 + b1").alias("most"), "a_odd", "b_odd").mapInArrow(run, "a long, b long")


def _edits(group: DataFrame, texts: DataFrame, sizes: DataFrame, k: int, sent: Broadcast) -> DataFrame:
    """(pivot, rep, linked, n, e, odd, sigs, places) of each member: the size, odd sketch and signatures of its difference from its pivot. The
    difference's size decides whether the two link (it is at most a ninth of both sizes together)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            linked, n, e, odd, sigs, places = [], [], [], [], [], []
            for largest, tokens, pivot in zip(batch.column(2).to_pylist(), _sets_along(batch.column(3), k), _sets_along(batch.column(4), k), strict=True):
                differ, sketch, own, place = edit_signatures(tokens, pivot, largest, sent.value)
                linked.append(9 * differ <= len(tokens) + len(pivot))
                n.append(len(tokens))
                e.append(differ)
                odd.append(sketch)
                sigs.append(own.tobytes())
                places.append(place.tobytes())
            out = [batch.column(0), batch.column(1), pa.array(linked, pa.bool_()), pa.array(n, pa.int64()), pa.array(e, pa.int64()), pa.array(odd, pa.binary()), pa.array(sigs, pa.binary()), pa.array(places, pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["pivot", "rep", "linked", "n", "e", "odd", "sigs", "places"])

    largest = group.join(sizes.select("rep", "n1"), "rep").groupBy("pivot").agg(F.max("n1").alias("largest"))
    own = group.join(largest, "pivot").join(texts.select(F.col("id").alias("rep"), "text"), "rep")
    both = own.join(texts.select(F.col("id").alias("pivot"), F.col("text").alias("centre")), "pivot")
    return both.select("pivot", "rep", "largest", "text", "centre").mapInArrow(run, "pivot long, rep long, linked boolean, n long, e long, odd binary, sigs binary, places binary")


def _edit_keys(edits: DataFrame, many: DataFrame | None = None) -> DataFrame:
    """(key, label) rows of differences, a key for each pivot and signature; with ``many``, (key, rep, label, n, e, place, o0 to
    o7) rows of those keys, the last being the words of the odd sketch."""
    sent = None if many is None else edits.sparkSession.sparkContext.broadcast(bitmap(many, "key", FILTER_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 128):
                part = batch.slice(a, 128)
                own = [np.frombuffer(s, dtype=np.uint64) for s in part.column(1).to_pylist()]
                row = np.repeat(np.arange(len(own)), [len(s) for s in own])
                pivots = part.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                keys = tv.mix(np.concatenate(own) + tv.mix(pivots)[row] * tv.ODD[4]).view(np.int64)
                if sent is None:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), part.column(2).take(pa.array(row))], ["key", "label"])
                    continue
                at = in_bitmap(sent.value, keys & ((1 << FILTER_BITS) - 1))
                place = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in part.column(2).to_pylist()])[at]
                odd = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in part.column(3).to_pylist()]).reshape(-1, EDIT_WORDS)[row[at]]
                same = [c.take(pa.array(row[at])) for c in part.columns[4:]]
                arrays = [pa.array(keys[at], pa.int64()), *same, pa.array(place, pa.int32()), *[pa.array(odd[:, i], pa.int64()) for i in range(EDIT_WORDS)]]
                yield pa.RecordBatch.from_arrays(arrays, ["key", *part.schema.names[4:], "place", *[f"o{i}" for i in range(EDIT_WORDS)]])

    if many is None:
        return edits.select("pivot", "sigs", "label").mapInArrow(run, "key long, label long")
    words = "".join(f", o{i} long" for i in range(EDIT_WORDS))
    keyed = edits.select("pivot", "sigs", "places", "odd", "rep", "label", "n", "e").mapInArrow(run, f"key long, rep long, label long, n long, e long, place int{words}")
    return keyed.join(many, "key", "left_semi")


def linked_weights(sets: list[np.ndarray], part: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """For each set, the weights of the other sets that it links to, added up. Sets of two parts are compared across the
    parts only, as each part is compared with itself elsewhere.

    Tokens that most sets hold are taken as missing from the others, which leaves symmetric differences as they are and
    makes the sets of near copies small; intersections are then counted along postings.
    """
    n = np.array([len(s) for s in sets])
    _, ids = np.unique(np.concatenate(sets), return_inverse=True)
    common = 2 * np.bincount(ids) > len(sets)
    flipped = []
    for own in np.split(ids, np.cumsum(n)[:-1]):
        missing = common.copy()
        missing[own] = False
        flipped.append(np.append(own[~common[own]], np.flatnonzero(missing)))
    size = np.array([len(f) for f in flipped])
    flat, owner = np.concatenate(flipped), np.repeat(np.arange(len(sets)), size)
    posting = owner[np.argsort(flat, kind="stable")]
    count = np.bincount(flat, minlength=len(common))
    start = np.cumsum(count) - count
    out, across = np.zeros(len(sets), dtype=np.int64), len(np.unique(part)) > 1
    for i, f in enumerate(flipped):
        f = f[count[f] > 1]
        at = np.repeat(start[f] - (np.cumsum(count[f]) - count[f]), count[f]) + np.arange(count[f].sum())
        both = np.bincount(posting[at], minlength=len(sets))
        linked = 9 * (size[i] + size - 2 * both) <= n[i] + n
        linked[i] = False
        if across:
            linked &= part != part[i]
        out[i] = weight[linked].sum()
    return out


def _link_counts(classes: DataFrame, links: DataFrame, labels: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(d1, d2, links) of sets that link to other sets: how many documents hold those. Links don't leave a class, so all pairs
    of sets of a class are decided, a pair of its parts at a time; what a task holds doesn't grow with the class."""
    import hashlib

    sets = classes.groupBy("rep").agg(F.collect_list(F.struct("d1", "d2", "copies")).alias("sets"), F.sum("n").alias("tokens"), F.count("*").alias("m"))
    nodes = links.select(F.explode(F.array("a", "b")).alias("rep")).union(sets.where("m > 1").select("rep")).distinct()
    known = nodes.join(sets, "rep").join(labels.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    parts = known.groupBy("label").agg(F.greatest(F.ceil(F.sum("m") / PART_SETS), F.ceil(F.sum("tokens") / PART_TOKENS)).cast("int").alias("parts"))
    dealt = known.join(parts, "label").withColumn("part", F.expr("cast(pmod(xxhash64(rep), parts) AS INT)"))
    dealt = _stored(dealt.select("rep", "sets", "label", "part", F.explode(F.expr("sequence(0, parts - 1)")).alias("other")))
    texts = _texts(docs, dealt.select(F.col("rep").alias("id"))).withColumnRenamed("id", "rep").distinct()
    rows = dealt.join(texts, "rep").select("label", F.least("part", "other").alias("p"), F.greatest("part", "other").alias("q"), "part", "sets", "text")

    def count(table: pa.Table) -> pa.Table:
        own: dict[tuple, tuple] = {}
        for (_, s), part, known in zip(sets_of(table["text"].combine_chunks(), k), table["part"].to_pylist(), table["sets"].to_pylist(), strict=True):
            digest = hashlib.blake2b(s.tobytes(), digest_size=16).digest()
            d = (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True))
            copies = next((x["copies"] for x in known if (x["d1"], x["d2"]) == d), None)
            if copies is not None:
                own[d] = (s, part, copies)
        p, q = table["p"][0].as_py(), table["q"][0].as_py()
        found = np.zeros(0, dtype=np.int64)
        if own and (p == q or len({x[1] for x in own.values()}) > 1):
            found = linked_weights([x[0] for x in own.values()], np.array([x[1] for x in own.values()]), np.array([x[2] for x in own.values()], dtype=np.int64))
        keys = list(own) if len(found) else []
        return pa.table({"d1": pa.array([x[0] for x in keys], pa.int64()), "d2": pa.array([x[1] for x in keys], pa.int64()), "links": pa.array(found, pa.int64())})

    counted = rows.groupBy("label", "p", "q").applyInArrow(lambda t: count(t), "d1 long, d2 long, links long")
    return counted.groupBy("d1", "d2").agg(F.sum("links").alias("links"))


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, sketch_bits: int = SKETCH_BITS, frequent: int = FREQUENT) -> DataFrame:
    """Classes of documents linked by a Jaccard similarity of 4/5 or more of their k-word shingle sets.

    Returns per input row: id, n_shingles (set size), component_id (smallest id that links reach, itself included) and
    n_links (all other documents whose set links to the row's; equal sets link too). Words are [^\\x20\\x09-\\x0D]+ after A-Z is
    lower-cased. Texts of fewer than k words are one shingle; null, empty and blank texts have none and link with nothing.
    Ids must be integers; a row with a null id gets a null class and links with nothing. Rows that repeat an id are one
    document if their sets are equal, otherwise several, which share a class in any case. Extra columns are ignored. An empty
    table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    ranks, mean = frequency_sketch(rows.select("text"), k, sketch_bits)
    sent = docs.sparkSession.sparkContext.broadcast(ranks)
    del ranks
    own = _stored(_sketched(rows, k, sent, int(rank_of(np.array([max(frequent, 8 * mean)]))[0])))
    full = own.where("n > 0 AND id IS NOT NULL")

    # Equal sets collapse into their smallest id.
    classes = _stored(full.groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.count_distinct("id").alias("copies")))
    copies = full.select("id", "d1", "d2").join(classes.drop("n"), ["d1", "d2"]).where("id <> rep").select(F.col("id").alias("a"), F.col("rep").alias("b")).distinct()
    copies = _stored(copies)
    # One row per set; an id that holds several sets (a repeated id) is a representative of each.
    # The id is part of the join's key, so that a large class's rows don't meet in one task.
    first = classes.select(F.col("rep").alias("id"), "d1", "d2")
    reps = full.join(first, ["id", "d1", "d2"]).groupBy("id", "d1", "d2").agg(F.first("n").alias("n"), F.first("odd").alias("odd"), F.first("sigs").alias("sigs"))
    reps = _stored(reps.select(F.col("id").alias("rep"), "n", "odd", "sigs"))

    # Signatures of exactly two sets are pairs by themselves; only the others need their postings again.
    shared = _stored(_postings(reps).groupBy("sig").agg(F.min("rep").alias("low"), F.max("rep").alias("high"), F.count("*").alias("m")).where("m > 1 AND low < high"))
    members = _members(reps, shared.where("m > 2").select("sig"))
    sizes = reps.groupBy("rep").agg(F.min("n").alias("n0"), F.max("n").alias("n1"), F.when(F.count("*") == 1, F.min("odd")).alias("odd"))
    members = _stored(members)
    pivots = members.groupBy("bucket").agg(F.min("rep").alias("pivot"), F.count("*").alias("m")).where("m > 1").select("bucket", "pivot")
    # Of these each member tries the pivot that it shares most buckets with.
    best = members.join(pivots, "bucket").where("rep <> pivot").groupBy(F.col("rep").alias("b"), F.col("pivot").alias("a")).agg(F.count("*").alias("shared"))
    best = best.groupBy("b").agg(F.max_by("a", F.struct("shared", -F.col("a"))).alias("a")).select("a", "b")
    tried = _stored(_fitting(shared.where("m = 2").select(F.col("low").alias("a"), F.col("high").alias("b")).union(best).distinct(), sizes))
    some = rows.where("id IS NOT NULL")
    links = _stored(_verified(tried, _texts(some, tried.select(F.explode(F.array("a", "b")).alias("id"))), k).distinct())

    # A bucket whose members are all in one class is done. The others get a common pivot, the smallest label of a bucket
    # (differences may be taken from any set, also from one outside), so that buckets of one class of near copies mostly
    # share it. A pair that shares an open bucket shares its pivot; members are compared within their pivot's group.
    labels = components(links)
    known = members.join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("bucket", "rep", F.coalesce("label", "rep").alias("label"))
    spread = known.groupBy("bucket").agg(F.min("label").alias("pivot"), F.max("label").alias("h")).where("pivot < h").select("bucket", "pivot")
    group = _stored(known.join(spread, "bucket").select("pivot", "rep").distinct())
    texts = _texts(some, group.select(F.explode(F.array("pivot", "rep")).alias("id")))
    edits = _stored(_edits(group, texts, sizes, k, sent))
    sent.destroy()  # the last that needs it is stored
    direct = edits.where("linked AND pivot <> rep").select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    links = _stored(links.union(direct).distinct())

    # Links to pivots join classes; groups that are one class now are done as well.
    labels = components(links)
    known = edits.select("pivot", "rep").distinct().join(labels.withColumnRenamed("node", "rep"), "rep", "left").select("pivot", "rep", F.coalesce("label", "rep").alias("label"))
    spread = known.groupBy("pivot").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("pivot")
    edits = _stored(edits.join(known.join(spread, "pivot"), ["pivot", "rep"]))
    # Most signatures of differences belong to one class; only keys of several are dealt again.
    mixed = _stored(_edit_keys(edits).groupBy("key").agg(F.min("label").alias("l"), F.max("label").alias("h")).where("l < h").select("key"))
    keyed = _edit_keys(edits, mixed)
    x, y = (keyed.select("key", *[F.col(c).alias(f"{c}_{at}") for c in keyed.columns[1:]]) for at in "xy")
    near = x.join(y, "key").where(FITS)
    left = near.select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    left = _stored(_fitting(left, sizes))
    links = links.union(_verified(left, _texts(some, left.select(F.explode(F.array("a", "b")).alias("id"))), k))
    links = _stored(links.distinct())

    labels = components(links.union(copies))
    others = _stored(_link_counts(classes, links, labels, some, k))
    n_links = classes.join(others, ["d1", "d2"], "left").select("d1", "d2", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links")).where("links > 0")
    return (
        own.select("id", F.col("n").alias("n_shingles"), "d1", "d2")
        .join(labels, F.col("id") == F.col("node"), "left")
        .join(n_links, ["d1", "d2"], "left")
        .select("id", "n_shingles", F.coalesce("label", "id").alias("component_id"), F.expr("CASE WHEN id IS NULL OR n_shingles = 0 THEN 0L ELSE coalesce(links, 0L) END").alias("n_links"))
    )
