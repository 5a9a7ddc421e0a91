"""Toxicity: a counterfactual-regularised linear classifier over hashed words and word beginnings."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwell.llm import textvec as tv
from loomwell.llm.common import checkpoint

BITS = 18
#: Labelled rows of each class that training takes at most: those of the smallest hash of their id.
SAMPLE = 4000
#: Identity terms (fixed values): a term is swapped for each other one of its group.
IDENTITY = (
    ("women", "men"), ("woman", "man"), ("girls", "boys"), ("female", "male"), ("she", "he"), ("muslim", "christian", "jewish", "hindu"),
    ("muslims", "christians", "jews", "hindus"), ("black", "white", "asian", "latino"), ("gay", "straight", "lesbian"), ("immigrant", "citizen"),
    ("frauen", "männer"), ("muslime", "christen", "juden"), ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
_PREFIXES = (4, 5, 6)


def features(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, distinct features) of each text: its words and their first 4, 5 and 6 bytes, hashed to BITS bits."""
    mask = np.uint64((1 << BITS) - 1)
    for a, b in tv.slices(texts):
        w = tv.words(texts.slice(a, b - a), tv.NOT_ALNUM)
        kinds = [w.hashes()]
        for n in _PREFIXES:
            cut = tv.Words(w.data, w.start, np.minimum(w.end, w.start + n), w.first, w.base)
            kinds.append(tv.mix(cut.hashes() + np.uint64(n)))
        kinds = [(k & mask).astype(np.int32) for k in kinds]
        for i in range(b - a):
            f, last = int(w.first[i]), int(w.first[i + 1])
            yield a + i, np.unique(np.concatenate([k[f:last] for k in kinds]))


_WORD = re.compile("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+")
_GROUP = {t: (g, i) for g in IDENTITY for i, t in enumerate(g)}


def counterfactuals(text: str) -> list[str]:
    """The text in lower case with its identity terms (whole words) replaced, once by each of the others of their groups: the first by
    the next of its group, and so on. None for a text without such terms."""
    low = text.lower()
    most = max((len(_GROUP[w][0]) for w in set(_WORD.findall(low)) & _GROUP.keys()), default=1)

    def turned(step: int) -> str:
        def other(m: re.Match) -> str:
            group, i = _GROUP.get(m[0], ((m[0],), 0))
            return group[(i + min(step, len(group) - 1)) % len(group)]

        return _WORD.sub(other, low)

    return [turned(step) for step in range(1, most)]


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        z = np.array([self.bias + float(self.weights[f].sum()) for _, f in features(texts)])
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def identity_features() -> np.ndarray:
    """The features of whole identity terms; their beginnings are shared with other words."""
    hashes = tv.words(pa.array(sorted(_GROUP)), tv.NOT_ALNUM).hashes()
    return np.unique((hashes & np.uint64((1 << BITS) - 1)).astype(np.int32))


def feature_counts(texts: pa.Array, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each feature, how many texts have it and how many of them have label 1."""
    n, pos = np.zeros(1 << BITS, dtype=np.int64), np.zeros(1 << BITS, dtype=np.int64)
    for i, f in features(texts):
        n[f] += 1
        pos[f] += int(labels[i])
    return n, pos


def chosen_features(n: np.ndarray, pos: np.ndarray, total: int, positive: int) -> np.ndarray:
    """Features that get a weight: those in five texts or more that differ between the classes beyond chance (chi-squared over
    40) and are mostly in texts of label 1, so that long texts don't add up slight evidence; and those of identity terms
    in five texts or more, which swaps touch."""
    share = positive / total
    chi = (pos - n * share) ** 2 / np.maximum(n * share * (1 - share) * (1 - n / total), 1e-9)
    use = (n >= 5) & (chi > 40) & (pos > np.maximum(0.5, share) * n)
    named = identity_features()
    use[named] = n[named] >= 5
    return np.flatnonzero(use)


def sparse_rows(texts: list[str], use: np.ndarray) -> list[bytes]:
    """The places in ``use`` of each text's features, as bytes of int32."""
    out = []
    for _, f in features(pa.array(texts, pa.string())):
        at = np.searchsorted(use, f)
        at[at == len(use)] = 0
        out.append(at[use[at] == f].astype(np.int32).tobytes() if len(use) else b"")
    return out


def fit(rows: list[bytes], labels: np.ndarray, pairs: list[tuple[bytes, bytes]], use: np.ndarray, fairness: float = 1.0, ridge: float = 1e-3, steps: int = 300) -> Model:
    """Logistic loss, classes weighted equally, plus ``fairness`` times the mean squared change of the logit under swapped terms
    (``pairs`` of a text's row and a counterfactual's). A class that is absent gives a constant score of its side of 0.5."""
    weights = np.zeros(1 << BITS, dtype=np.float32)
    labels = labels.astype(np.float64)
    if not len(rows) or labels.min() == labels.max():
        return Model(weights, 1.0 if len(rows) and labels.min() == 1 else -1.0)

    def flat(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(own)), [len(x) // 4 for x in own]), np.frombuffer(b"".join(own), dtype=np.int32)

    (row, col), share = flat(rows), labels.mean()
    sides = [flat([p[i] for p in pairs]) for i in (0, 1)] if pairs else []
    w, b, cost = np.zeros(len(use)), 0.0, np.where(labels == 1, 0.5 / share, 0.5 / (1 - share)) / len(rows)
    m, v = np.zeros(len(use) + 1), np.zeros(len(use) + 1)
    for step in range(1, steps + 1):
        z = b + np.bincount(row, weights=w[col], minlength=len(rows))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * cost
        grad = np.bincount(col, weights=g[row], minlength=len(use)) + ridge * w
        if sides:
            change = sum(s * np.bincount(r, weights=w[c], minlength=len(pairs)) for s, (r, c) in zip((1, -1), sides, strict=True)) * 2 * fairness / len(pairs)
            grad += sum(s * np.bincount(c, weights=change[r], minlength=len(use)) for s, (r, c) in zip((1, -1), sides, strict=True))
        full = np.append(grad, g.sum())
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    weights[use] = w
    return Model(weights, float(b))


def train(texts: list[str], labels: np.ndarray, fairness: float = 1.0) -> Model:
    """The same on texts at hand."""
    n, pos = feature_counts(pa.array(texts, pa.string()), labels)
    use = chosen_features(n, pos, max(1, len(texts)), int(labels.sum()))
    pairs = [(x, y) for t in texts if (other := counterfactuals(t)) for x in sparse_rows([t], use) for y in sparse_rows(other, use)]
    return fit(sparse_rows(texts, use), labels, pairs, use, fairness)


def identity_gap(model: Model, templates: tuple[str, ...] = ("the {} said so", "many {} live here")) -> float:
    """The mean absolute difference of scores of two terms of a group in the same template."""
    gaps = []
    for template in templates:
        for group in IDENTITY:
            own = model.scores(pa.array([template.format(t) for t in group]))
            gaps += np.abs(own[:, None] - own)[np.triu_indices(len(group), 1)].tolist()
    return float(np.mean(gaps))


def learn(rows: DataFrame, fairness: float = 1.0) -> Model:
    """A model of labelled rows (id, text, y). What reaches the driver is bounded: counts of 2**BITS features, then
    for each row and counterfactual the few features that are chosen."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, pos = feature_counts(batch.column(0), batch.column(1).to_numpy(zero_copy_only=False))
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(n[at]), pa.array(pos[at])], ["f", "n", "pos"])

    found = rows.select("text", "y").mapInArrow(count, "f int, n long, pos long").groupBy("f").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos")).toArrow()
    total, positive = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
    n, pos = np.zeros(1 << BITS, dtype=np.int64), np.zeros(1 << BITS, dtype=np.int64)
    n[found["f"].to_numpy()], pos[found["f"].to_numpy()] = found["n"].to_numpy(), found["pos"].to_numpy()
    use = chosen_features(n, pos, max(1, total), positive)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).to_pylist()
            others = [sparse_rows(counterfactuals(t), use) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sparse_rows(texts, use), pa.binary()), pa.array(others, pa.list_(pa.binary()))], ["id", "y", "own", "others"])

    kind = rows.schema["id"].dataType.simpleString()
    own = rows.select("id", "y", "text").mapInArrow(encode, f"id {kind}, y int, own binary, others array<binary>").toArrow().to_pylist()
    own.sort(key=lambda r: (r["id"], r["own"]))  # sums then don't depend on the order of tasks
    return fit([r["own"] for r in own], np.array([r["y"] for r in own]), [(r["own"], x) for r in own for x in r["others"]], use, fairness)


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", folds: int = 5, sample: int = SAMPLE, fairness: float = 1.0) -> DataFrame:
    """Score every whole text; labels are learned from rows outside fold 0 alone.

    Returns per input row: id, held_out (crc32 of the id as text mod ``folds`` is 0), score (0 to 1) and predicted. Training takes at most
    ``sample`` labelled rows of each class; rows with a null id or label aren't learned from. Null and empty texts score
    what the bias says; a null id is not held out. Of several labels of one id the largest counts. Repeated rows score alike; without labels all scores are equal and
    under 0.5. Extra columns are ignored. Inputs of a score are the text's words alone.
    """
    held = F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == 0, F.lit(False))
    known = labels.select(F.col(id_col).alias("__t_id"), F.col(label_col).cast("int").alias("__t_y")).where("__t_y IS NOT NULL").groupBy("__t_id").agg(F.max("__t_y").alias("__t_y"))
    own = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), held.alias("held_out"))
    # The ids of the sample are chosen first, so that texts meet only the few thousand that are taken.
    pool = known.where(~(F.crc32(F.col("__t_id").cast("string")) % folds == 0))
    chosen = [pool.where(F.col("__t_y") == y).orderBy(F.xxhash64("__t_id"), "__t_id").limit(sample) for y in (0, 1)]
    # Twice ``sample`` ids at most: broadcasting them is bounded by construction.
    rows = checkpoint(own.join(F.broadcast(chosen[0].union(chosen[1])), F.col("id") == F.col("__t_id")).select("id", "text", F.col("__t_y").alias("y")))
    model = learn(rows, fairness)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = sent.value.scores(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64()), pa.array((scores >= 0.5).astype(np.int32))], ["id", "held_out", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return own.mapInArrow(run, f"id {kind}, held_out boolean, score double, predicted int")
