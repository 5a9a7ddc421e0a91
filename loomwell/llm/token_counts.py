"""Token counts: prefix dynamic programming over the pieces that may end at each place."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.pieces import Cache, Pieces, in_process

_LAST = itemgetter(-1)


def chunk_counts(model: Pieces, chunk: str) -> list[int]:
    """Token count of each prefix of a chunk, the empty one first.

    The last piece of a prefix is the one that ends there and is stable behind the last piece of what precedes it; its
    count is one more than that of what precedes it (or a byte-fallback piece's number of bytes more).
    """
    n, ending, get, memo = len(chunk), model.ending.get, model.ids.get, model.neighbours
    last, counts = [-1] * (n + 1), [0] * (n + 1)
    for i in range(1, n + 1):
        for size in ending(chunk[i - 3 : i], (2, 1)) if i > 2 else (2, 1)[2 - i :]:
            j = i - size
            if j < 0:
                continue
            piece = get(chunk[j:i])
            if piece is None:
                continue
            before = last[j]
            if before >= 0:
                key = before << 20 | piece
                good = memo.get(key)
                if good is None:
                    good = memo[key] = model.stable(before, piece)
                if not good:
                    continue
            last[i], counts[i] = piece, counts[j] + 1
            break
        else:  # a character without a piece merges with nothing
            counts[i] = counts[i - 1] + len(model.fallback(chunk[i - 1]))
    return counts


def prefix_counts(model: Pieces, text: str) -> list[int]:
    """Token count of each prefix of a text, by code points: entry p is the count of text[:p]. BPE models only."""
    if not model.bpe or model.trim:
        raise ValueError("prefix counts need a BPE model that keeps white space")
    out, tables = [0], _tables(model)
    for chunk in model.chunks(model.normalise(text)):
        base = out[-1]
        out += [base + c for c in tables[chunk][1:]]
    if model.dummy_prefix and len(out) > 1:
        out = [0, *out[2:]]  # the space in front belongs to the first character
    return out


def longest_within(counts: list[int], budget: int) -> int:
    """Length of the longest prefix of at most ``budget`` tokens (counts may fall where pieces merge)."""
    return max(p for p, c in enumerate(counts) if c <= budget)


def _table(model: Pieces, chunk: str) -> bytes | list[int]:
    counts = chunk_counts(model, chunk)
    return bytes(counts) if max(counts) < 256 else counts


def _tables(model: Pieces) -> Cache:
    """Count tables of chunks, by chunk."""
    return model._once("counts", lambda: Cache(partial(_table, model)))


def count(model: Pieces, text: str) -> int:
    return sum(map(_LAST, map(_tables(model).__getitem__, model.chunks(model.normalise(text)))))


def token_counts(docs: DataFrame, model_path: str, text_col: str = "text", limit: int = 4096, prefixes: bool = False) -> DataFrame:
    """Exact token counts of whole texts under a SentencePiece BPE model, without begin, end or added tokens.

    Returns every input column (columns named tc_* are replaced) and tc_n_bytes (UTF-8), tc_n_tokens, tc_over_limit (more
    than ``limit`` tokens), tc_within (length in code points of the longest prefix of at most ``limit`` tokens) and, with
    ``prefixes``, tc_prefix: the count at every prefix, from which any truncation or budget is answered without encoding
    again. A null text counts as empty (0 tokens; tc_within 0). Repeated rows count alike, empty tables stay empty. The
    model file is read by the driver and broadcast (its size is fixed).
    """
    docs = docs.drop("tc_n_bytes", "tc_n_tokens", "tc_over_limit", "tc_within", "tc_prefix").withColumn(text_col, F.col(text_col).cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_path))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = in_process(sent.value)
        for batch in batches:
            for a in range(0, batch.num_rows, 512):
                part = batch.slice(a, 512)
                n_bytes, n_tokens, within, tables = [], [], [], []
                for x in part.column(at):
                    text = x.as_py() or ""
                    total = count(model, text)
                    # A text under the limit may have longer prefixes of more tokens; only those over it need the table.
                    table = prefix_counts(model, text) if prefixes or total > limit else None
                    n_bytes.append(len(text.encode()))
                    n_tokens.append(total)
                    within.append(len(text) if total <= limit else longest_within(table, limit))
                    tables.append(table)
                more = [pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([t > limit for t in n_tokens], pa.bool_()), pa.array(within, pa.int64())]
                names = ["tc_n_bytes", "tc_n_tokens", "tc_over_limit", "tc_within"]
                if prefixes:
                    more, names = [*more, pa.array(tables, pa.list_(pa.int32()))], [*names, "tc_prefix"]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, tc_n_bytes bigint, tc_n_tokens bigint, tc_over_limit boolean, tc_within bigint" + ", tc_prefix array<int>" * prefixes)

