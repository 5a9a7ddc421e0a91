"""Benchmark decontamination: hash set of normalised test n-grams, scan of training windows, verified hits."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm import textvec as tv
from loomwell.llm.common import bitmap

#: Benchmark windows up to which their set is broadcast (some 150 MB of Python objects); beyond it windows are joined by a shuffle.
BROADCAST_WINDOWS = 1 << 18
#: Slots of the bitmap that the shuffled form filters windows by.
FILTER_BITS = 26
#: A word, of lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RANGES = "array<struct<start: bigint, end: bigint, size: bigint>>"


def item_windows(texts: pa.Array, k: int) -> Iterator[tuple[int, int, bytes, int]]:
    """(row, number of words, text, hash) of each window of an item: k words, or the whole of a shorter item."""
    for a, b in tv.slices(texts):
        w = tv.words(texts.slice(a, b - a), tv.NOT_ALNUM)
        hashes = w.hashes()
        for i in range(b - a):
            first, last = int(w.first[i]), int(w.first[i + 1])
            size = min(k, last - first)
            if size:
                own = tv.windows(hashes[first:last], size)
                for j in range(last - first - size + 1):
                    yield a + i, size, b" ".join(w.text(x) for x in range(first + j, first + j + size)), int(own[j])


def _matches(w: tv.Words, known: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, hash of each position, positions whose hash is known) for each window size; windows stay in their row."""
    hashes = w.hashes()
    row = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    for size, keys in sorted(known.items()):
        h = tv.windows(hashes, size)
        if len(h) and len(keys):
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            yield size, h, np.flatnonzero((keys[at] == h) & (row[: len(h)] == row[size - 1 :]))


def _by_broadcast(docs: DataFrame, text_col: str, rows: pa.Table, k: int, schema: str) -> DataFrame:
    items = rows.column(0).to_pylist()
    owners: dict[tuple[int, int], dict[bytes, set]] = defaultdict(lambda: defaultdict(set))
    for i, size, window, h in item_windows(rows.column(1).combine_chunks().cast(pa.string()), k):
        owners[size, h][window].add("" if items[i] is None else str(items[i]))
    table = {at: {w: sorted(own) for w, own in x.items()} for at, x in owners.items()}
    known = {size: np.array(sorted(h for s, h in table if s == size), dtype=np.uint64) for size in {s for s, _ in table}}
    sent = docs.sparkSession.sparkContext.broadcast((table, known))
    at_text = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = sent.value
        for batch in batches:
            for a, b in tv.slices(batch.column(at_text)):
                part = batch.slice(a, b - a)
                w = tv.words(part.column(at_text), tv.NOT_ALNUM)
                hit = np.zeros(len(w.start) + 1, dtype=np.int64)
                found: list[set] = [set() for _ in range(b - a)]
                for size, h, at in _matches(w, known):
                    row = np.searchsorted(w.first, at, side="right") - 1
                    for p, r in zip(at.tolist(), row.tolist(), strict=True):
                        # The words themselves are compared, not only their hashes.
                        if own := table[size, int(h[p])].get(b" ".join(w.text(j) for j in range(p, p + size))):
                            hit[p] += 1
                            hit[p + size] -= 1
                            found[r].update(own)
                covered = np.cumsum(hit)[:-1] > 0
                total = np.concatenate([[0], np.cumsum(covered)])
                n_hit = total[w.first[1:]] - total[w.first[:-1]]
                ranges: list[list] = [[] for _ in range(b - a)]
                for r in np.flatnonzero(n_hit).tolist():
                    f, last = int(w.first[r]), int(w.first[r + 1])
                    step = np.diff(np.concatenate([[0], covered[f:last].astype(np.int8), [0]]))
                    ranges[r] = [{"start": int(w.start[f + s] - w.base[r]), "end": int(w.end[f + e - 1] - w.base[r]), "size": int(e - s)} for s, e in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("size", pa.int64())]))
                more = [pa.array(np.diff(w.first), pa.int64()), pa.array(n_hit, pa.int64()), pa.array([sorted(x) for x in found], pa.list_(pa.string())), pa.array(ranges, kind)]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, "dc_n_words", "dc_n_hit", "dc_items", "dc_ranges"])

    return docs.mapInArrow(scan, f"{schema}, dc_n_words bigint, dc_n_hit bigint, dc_items array<string>, dc_ranges {_RANGES}")


def _by_shuffle(docs: DataFrame, text_col: str, bench: DataFrame, k: int, schema: str) -> DataFrame:
    """The same without a broadcast that grows: windows that pass a bitmap of fixed size are joined on their words."""

    def of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = ["" if x is None else str(x) for x in batch.column(0).to_pylist()]
            own = [(ids[i], size, w.decode(), h) for i, size, w, h in item_windows(batch.column(1), k)]
            names, sizes, texts, hashes = zip(*own, strict=True) if own else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(sizes, pa.int32()), pa.array(texts, pa.string()), pa.array(np.array(hashes, dtype=np.uint64).view(np.int64))], ["item", "size", "window", "h"])

    owned = bench.mapInArrow(of_items, "item string, size int, window string, h long")
    sizes = [x["size"] for x in owned.select("size").distinct().collect()]  # 1 to k
    bits = docs.sparkSession.sparkContext.broadcast(bitmap(owned, "h", FILTER_BITS))
    at_text, mask = docs.columns.index(text_col), np.uint64((1 << FILTER_BITS) - 1)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in tv.slices(batch.column(at_text)):
                part = batch.slice(a, b - a)
                w = tv.words(part.column(at_text), tv.NOT_ALNUM)
                row, hashes = np.repeat(np.arange(b - a), np.diff(w.first)), w.hashes()
                own: list[list] = [[] for _ in range(b - a)]
                for size in sizes:
                    h = tv.windows(hashes, size)
                    slot = (h & mask).astype(np.int64)
                    near = ((bits.value[slot >> 6] >> (slot & 63)) & 1 != 0) & (row[: len(h)] == row[size - 1 :]) if len(h) else np.zeros(0, bool)
                    for p in np.flatnonzero(near).tolist():
                        r = int(row[p])
                        span = [(int(w.start[x] - w.base[r]), int(w.end[x] - w.base[r])) for x in range(p, p + size)]
                        own[r].append({"p": p - int(w.first[r]), "size": size, "window": b" ".join(w.text(x) for x in range(p, p + size)).decode(), "at": [{"s": s, "e": e} for s, e in span]})
                kind = pa.list_(pa.struct([("p", pa.int32()), ("size", pa.int32()), ("window", pa.string()), ("at", pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(np.diff(w.first), pa.int64()), pa.array(own, kind)], [*part.schema.names, "dc_n_words", "__dc_near"])

    near = docs.mapInArrow(scan, f"{schema}, dc_n_words bigint, __dc_near array<struct<p: int, size: int, window: string, at: array<struct<s: bigint, e: bigint>>>>")
    # Equal rows hit equally, so the text's hash is the key of the way back.
    near = near.withColumn("__dc_key", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    hits = (
        near.select("__dc_key", F.explode("__dc_near").alias("n"))
        .select("__dc_key", "n.*")
        .dropDuplicates(["__dc_key", "p", "size"])
        .join(owned.groupBy("size", "window").agg(F.collect_set("item").alias("own")), ["size", "window"])
        .groupBy("__dc_key")
        .agg(
            F.sort_array(F.array_distinct(F.flatten(F.collect_list("own")))).alias("__items"),
            F.sort_array(F.array_distinct(F.flatten(F.collect_list(F.expr("transform(at, (x, i) -> struct(p + i AS w, x.s AS s, x.e AS e))"))))).alias("__words"),
        )
    )
    joined = near.join(hits, "__dc_key", "left")
    ranges = F.expr(
        "transform(arrays_zip(filter(__words, (x, i) -> i = 0 OR __words[i - 1].w <> x.w - 1),"
        " filter(__words, (x, i) -> i = size(__words) - 1 OR __words[i + 1].w <> x.w + 1)),"
        " z -> struct(z['0'].s AS start, z['1'].e AS end, cast(z['1'].w - z['0'].w + 1 AS BIGINT) AS size))"
    )
    return joined.withColumns({"dc_n_hit": F.expr("cast(coalesce(size(__words), 0) AS BIGINT)"), "dc_items": F.coalesce("__items", F.expr("cast(array() AS array<string>)")), "dc_ranges": F.coalesce(ranges, F.expr(f"cast(array() AS {_RANGES})"))}).drop("__dc_key", "__dc_near", "__items", "__words")


def decontaminate(docs: DataFrame, bench: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", k: int = 10, broadcast_windows: int = BROADCAST_WINDOWS, clean: bool = False) -> DataFrame:
    """Find windows of ``k`` benchmark words in whole texts.

    Returns every input column (columns named dc_* are replaced) and dc_n_words, dc_n_hit (words inside any occurrence
    of a window), dc_items (ids, as sorted strings, of items with an occurring window) and dc_ranges (byte ranges of
    the UTF-8 text, merged over adjacent hit words); with ``clean`` also dc_text, the text without its ranges.

    Words are runs outside [\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] after A-Z is lower-cased. An item of fewer than ``k`` words, but
    not none, is one window. Null and empty texts have no words; items without words never match; an item with a
    null id is listed as an empty string. Repeated rows hit alike. Empty tables on either side give no hits.

    Benchmark windows are broadcast only where they, counted first, are at most ``broadcast_windows`` (and their texts, which the
    driver reads for it, of 256 bytes a window on average); otherwise windows that pass a bitmap of fixed size are joined by a shuffle on their words. Hits are verified on the words.
    """
    docs = docs.drop("dc_n_words", "dc_n_hit", "dc_items", "dc_ranges", "dc_text")
    docs = docs.withColumn(text_col, F.col(text_col).cast("string"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    items = bench.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text")).where(F.col("text").isNotNull())
    n_words = F.regexp_count(F.lower("text"), F.lit(WORD))
    size, n_bytes = items.agg(F.coalesce(F.sum(F.greatest(F.least(n_words, F.lit(1)), n_words - (k - 1))), F.lit(0)), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    small = size <= broadcast_windows and n_bytes <= 256 * broadcast_windows
    out = _by_broadcast(docs, text_col, items.toArrow(), k, schema) if small else _by_shuffle(docs, text_col, items, k, schema)
    if clean:
        raw, prev = f"encode(`{text_col}`, 'UTF-8')", "CASE WHEN i = 0 THEN 0L ELSE dc_ranges[i - 1].end END"
        parts = f"transform(dc_ranges, (r, i) -> substring({raw}, cast({prev} AS INT) + 1, cast(r.start - ({prev}) AS INT)))"
        tail = f"substring({raw}, cast(element_at(dc_ranges, -1).end AS INT) + 1)"
        out = out.withColumn("dc_text", F.expr(f"CASE WHEN size(dc_ranges) = 0 THEN `{text_col}` ELSE concat(array_join(transform({parts}, b -> decode(b, 'UTF-8')), ''), decode({tail}, 'UTF-8')) END"))
    return out
