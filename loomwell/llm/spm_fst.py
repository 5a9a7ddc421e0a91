"""SentencePiece encoding and decoding by weighted finite-state transducers in the tropical semiring.

What is compiled from a model:

* the normaliser: the model's character map, a transducer over bytes whose states are the nodes of a double array, and
  the machine of one state that writes spaces as U+2581;
* the piece acceptor: states are the nodes of a trie, arcs read a character each, and a state at which a piece ends
  goes back to the start, puts out the piece and weighs its negated score (one for BPE);
* the byte fallback: from the start an arc for any character that no piece has, which puts out its bytes' pieces;
* for BPE the border constraint: its states are pieces, with a transition from one to another just if the two are stable
  neighbours (see pieces.py). Weights alone don't give BPE's result, so this machine decides there.

They are composed with an input lazily: states of the composition are made where a path reaches them. The encoding is the
tropical shortest path of the lattice, found by relaxing its arcs in the order of their places.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm.common import trim_worker
from loomwell.llm.pieces import BYTE, SPACE, Cache, Pieces, in_process

#: Added to the lowest score for characters without a piece, as unigram models do.
UNKNOWN_PENALTY = 10.0
_FAR = float("inf")


class Transducer:
    def __init__(self, model: Pieces):
        self.model = model
        self.low = min((s for s, k in zip(model.scores, model.types, strict=True) if k == 1), default=0.0)
        self.table = self._decoder()
        self.arcs, self.final = self._acceptor()

    def _acceptor(self) -> tuple[dict[int, int], list[int]]:
        """(arcs, final): the next state for state << 21 | character, and the piece that ends at each state, or -1. State 0 is the start."""
        arcs: dict[int, int] = {}
        final = [-1]
        for text, piece in self.model.ids.items():
            state = 0
            for c in text:
                key = state << 21 | ord(c)
                state = arcs.get(key, -1)
                if state < 0:
                    state = arcs[key] = len(final)
                    final.append(-1)
            final[state] = piece
        return arcs, final

    def _decoder(self) -> list[bytes]:
        """Output of each id: the byte of a byte piece, nothing for control pieces, else the text with spaces."""
        m = self.model
        out = []
        for text, kind in zip(m.texts, m.types, strict=True):
            out.append(bytes([int(text[3:5], 16)]) if kind == BYTE else b"" if kind == 3 else " ⁇ ".encode() if kind == 2 else text.replace(SPACE, " ").encode())
        return out

    def shortest_path(self, chunk: str) -> list[int]:
        """Ids along the least-weight path of the composition; of equal weights the one found first, longer pieces later.

        The lattice is composed and relaxed in one sweep: arcs leave a position only if a path reaches it. A BPE
        constraint state is (position, last piece); all but one state of a position are dead (pieces.py says why), so
        one is kept, as for unigram models, whose states are the positions.
        """
        m, n = self.model, len(chunk)
        arc, final, memo, bpe, scores = self.arcs.get, self.final, m.neighbours, m.bpe, m.scores
        codes = list(map(ord, chunk))
        cost, piece_to, came = [_FAR] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        cost[0] = 0.0
        for i in range(n):
            here = cost[i]
            if here == _FAR:
                continue
            before = piece_to[i]
            state, j = arc(codes[i]), i
            if state is None or final[state] < 0:  # no piece is this character: the byte-fallback arc
                weight = here + (1.0 if bpe else UNKNOWN_PENALTY - self.low)
                if weight < cost[i + 1]:
                    cost[i + 1], piece_to[i + 1], came[i + 1] = weight, -1, i
            while state is not None:
                j += 1
                piece = final[state]
                state = arc(state << 21 | codes[j]) if j < n else None
                if piece < 0:
                    continue
                if bpe and before >= 0:
                    key = before << 20 | piece
                    good = memo.get(key)
                    if good is None:
                        good = memo[key] = m.stable(before, piece)
                    if not good:
                        continue
                weight = here + (1.0 if bpe else -scores[piece])
                if weight < cost[j]:
                    cost[j], piece_to[j], came[j] = weight, piece, i
        out: list[int] = []
        at = n
        while at > 0:
            out.extend((piece_to[at],) if piece_to[at] >= 0 else m.fallback(chunk[at - 1])[::-1])
            at = came[at]
        return out[::-1]

    def _path(self, chunk: str) -> tuple[int, ...]:
        return tuple(self.shortest_path(chunk))

    def encode(self, text: str) -> list[int]:
        paths, m = self.model._once("paths", lambda: Cache(self._path)), self.model
        return list(chain.from_iterable(map(paths.__getitem__, m.chunks(m.normalise(text)))))

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space in front, if the normaliser puts one there, goes; invalid bytes become U+FFFD."""
        out = b"".join(map(self.table.__getitem__, ids)).decode("utf-8", "replace")
        return out[1:] if self.model.dummy_prefix and out.startswith(" ") else out


def encode(docs: DataFrame, model_path: str, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """Encode whole texts with a SentencePiece model, without begin, end or added tokens.

    Returns every input column (columns named sp_* are replaced) and sp_ids (array of ids), sp_n_tokens and sp_round_trip
    (decoding gives the text back, U+2581 read as a space); with ``decoded`` also sp_text. Null texts count as empty: no
    ids, and they round-trip to an empty text. Repeated rows encode alike, empty tables stay empty. Strings of special
    pieces inside a text are ordinary text.
    """
    docs = docs.drop("sp_ids", "sp_n_tokens", "sp_round_trip", "sp_text").withColumn(text_col, F.col(text_col).cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(Pieces.load(model_path))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trim_worker()
        model = in_process(sent.value)
        machine = model._once("machine", lambda: Transducer(model))
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                texts = [x.as_py() or "" for x in part.column(at)]
                ids = [machine.encode(t) for t in texts]
                back = [machine.decode(x) for x in ids]
                same = [b == t.replace(SPACE, " ") for b, t in zip(back, texts, strict=True)]
                more, names = [pa.array(ids, pa.list_(pa.int32())), pa.array(map(len, ids), pa.int64()), pa.array(same, pa.bool_())], ["sp_ids", "sp_n_tokens", "sp_round_trip"]
                if decoded:
                    more, names = [*more, pa.array(back, pa.string())], [*names, "sp_text"]
                yield pa.RecordBatch.from_arrays([*part.columns, *more], [*part.schema.names, *names])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(run, f"{schema}, sp_ids array<int>, sp_n_tokens bigint, sp_round_trip boolean" + ", sp_text string" * decoded)


def decode(encoded: DataFrame, model_path: str, ids_col: str = "sp_ids") -> DataFrame:
    """Texts of arrays of ids, as column sp_text beside the input's columns; null arrays decode to an empty text."""
    encoded = encoded.drop("sp_text").withColumn(ids_col, F.col(ids_col).cast("array<int>"))
    sent = encoded.sparkSession.sparkContext.broadcast(Pieces.load(model_path))
    at = encoded.columns.index(ids_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = in_process(sent.value)
        machine = model._once("machine", lambda: Transducer(model))
        for batch in batches:
            texts = [machine.decode(x.as_py() or []) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, "sp_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{schema}, sp_text string")
