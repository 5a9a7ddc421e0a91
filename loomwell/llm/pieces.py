"""SentencePiece model files, and the merge rule of their BPE models as a constraint on neighbouring pieces.

BPE applies the best-scored merge again and again. Of a segmentation it is enough to know that every two neighbours
a, b are "stable": merging the characters of a + b gives just a, b. (The first merge across a border of the whole text
would also be made within that pair alone; and within a piece, merges don't depend on what lies outside.) So the BPE
result is the one path through the lattice of pieces all of whose neighbours are stable, and so is that of each prefix.
"""

from __future__ import annotations

import hashlib
import re
import struct
from dataclasses import dataclass, field

from loomwell.llm.common import releases

SPACE = "▁"
#: Types of pieces in model files.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_NEVER = 1 << 40
NEIGHBOURS = 2_000_000
#: Entries of a per-process cache generation; two generations are kept.
CACHE = 200_000


def _varint(buf: bytes, at: int) -> tuple[int, int]:
    out = shift = 0
    while True:
        byte = buf[at]
        at += 1
        out |= (byte & 127) << shift
        if byte < 128:
            return out, at
        shift += 7


def _fields(buf: bytes):
    """(number, value) pairs of a protocol buffer message; submessages stay bytes."""
    at = 0
    while at < len(buf):
        key, at = _varint(buf, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(buf, at)
        elif kind == 2:
            n, at = _varint(buf, at)
            value, at = buf[at : at + n], at + n
        else:
            n = 8 if kind == 1 else 4
            value, at = buf[at : at + n], at + n
        yield key >> 3, value


class Cache(dict):
    """A bounded memo of ``make``, read by item: a full young generation becomes the old one, whose own entries go.
    Keys of more than 64 characters aren't kept."""

    def __init__(self, make, most: int = CACHE):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, key: str):
        found = self.old.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= 64:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class CharMap:
    """A model's character map as a transducer over UTF-8 bytes: its states are the nodes of the double array that the file holds,
    its arcs the array's transitions, and an accepting node puts out the string at its offset."""

    def __init__(self, blob: bytes):
        (size,) = struct.unpack_from("<I", blob)
        self.units = struct.unpack_from(f"<{size // 4}I", blob, 4)
        self.strings = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes | None]:
        """(bytes read, output) of the longest accepted input from a place on; (0, None) if none is."""
        units, best, out = self.units, 0, None
        node = units[0] >> 10 << ((units[0] & 512) >> 6)
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units):
                break
            unit = units[node]
            if unit & 0x800000FF != raw[i]:
                break
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                start = units[node] & 0x7FFFFFFF
                best, out = i + 1 - at, self.strings[start : self.strings.index(b"\0", start)]
        return best, out

    def apply(self, text: str) -> str:
        """Leftmost longest replacements; other characters stay."""
        raw, out, at = text.encode("utf-8", "surrogatepass"), bytearray(), 0
        while at < len(raw):
            size, own = self.longest(raw, at)
            if not size:
                size = 1 if raw[at] < 0x80 else 2 if raw[at] < 0xE0 else 3 if raw[at] < 0xF0 else 4
                own = raw[at : at + size]
            out += own
            at += size
        return out.decode("utf-8", "surrogatepass")


@dataclass
class Pieces:
    """A model's pieces and normaliser settings. Pickles small; caches are made where it is used."""

    texts: list[str]
    scores: list[float]
    types: list[int]
    bpe: bool
    byte_fallback: bool
    dummy_prefix: bool
    trim: bool
    #: The character map's transducer, if the model has one, and a digest of the model's file or fields.
    chars: CharMap | None = None
    digest: str = ""
    _made: dict = field(default_factory=dict, repr=False)

    @classmethod
    def load(cls, path: str) -> Pieces:
        """Read a model file. Models with user-defined pieces are refused (ValueError)."""
        with open(path, "rb") as f:
            buf = f.read()
        texts, scores, types = [], [], []
        kind, fallback, prefix, trim, chars = 1, False, True, True, None
        for number, value in _fields(buf):
            if number == 1:
                own = dict(_fields(value))
                texts.append(own.get(1, b"").decode())
                scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
                types.append(own.get(3, NORMAL))
            elif number == 2:
                own = dict(_fields(value))
                kind, fallback = own.get(3, 1), bool(own.get(35, 0))
                if own.get(24):
                    raise ValueError("models with white space as suffix aren't supported")
            elif number == 3:
                own = dict(_fields(value))
                prefix, trim = bool(own.get(3, 1)), bool(own.get(4, 1))
                chars = CharMap(own[2]) if own.get(2) else None
        if kind not in (1, 2) or USER_DEFINED in types:
            raise ValueError("only unigram and BPE models without user-defined pieces are supported")
        return cls(texts, scores, types, kind == 2, fallback, prefix, trim, chars, hashlib.sha256(buf).hexdigest())

    def __getstate__(self):
        return self.__dict__ | {"_made": {}}

    def _once(self, name: str, make):
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    @property
    def ids(self) -> dict[str, int]:
        """Normal pieces that can come out of a text: for BPE, those that their own characters merge to."""

        def make():
            known = {t: i for i, (t, k) in enumerate(zip(self.texts, self.types, strict=True)) if k in (NORMAL, UNUSED)}
            self._made["mergeable"] = known
            return {t: i for t, i in known.items() if not self.bpe or len(t) == 1 or self.merged(t) == [t]}

        return self._once("ids", make)

    @property
    def ending(self) -> dict[str, tuple[int, ...]]:
        """Lengths of the pieces of each three last characters, longest first, and 2 and 1 behind them."""

        def make():
            out: dict[str, set[int]] = {}
            for t in self.ids:
                if len(t) > 2:
                    out.setdefault(t[-3:], {2, 1}).add(len(t))
            return {k: tuple(sorted(v, reverse=True)) for k, v in out.items()}

        return self._once("ending", make)

    @property
    def bytes_at(self) -> list[int]:
        """The id that stands for each byte."""
        return self._once("bytes", lambda: [self.texts.index(f"<0x{b:02X}>") for b in range(256)])

    @property
    def unknown(self) -> int:
        return self.types.index(UNKNOWN)

    @property
    def chunkable(self) -> bool:
        """Whether no piece has a space behind another character, so that texts fall apart before spaces."""
        return self._once("chunkable", lambda: not any(SPACE in t.lstrip(SPACE) for t in self.ids))

    def normalise(self, text: str) -> str:
        """The normaliser: the character map, then spaces become U+2581, runs are trimmed if the model says so, and one goes in front."""
        if self.chars is not None:
            text = self.chars.apply(text)
        if self.trim:
            text = re.sub(" +", " ", text.replace(SPACE, " ")).strip(" ")
        if not text:
            return ""
        return ((" " if self.dummy_prefix else "") + text).replace(" ", SPACE)

    @property
    def openers(self) -> set[str]:
        """The largest set of characters, letters not among them, none of which any piece has behind a character outside the set, U+2581 aside:
        segmentations fall apart before a run of them. In most models that is punctuation."""

        def make():
            longer = [t for t in self.ids if len(t) > 1]
            pairs = {t[i : i + 2] for t in longer for i in range(len(t) - 1)}
            out = {c for t in longer for c in t if not c.isalpha() and c != SPACE}
            while late := {b for a, b in pairs if b in out and a not in out and a != SPACE}:
                out -= late
            return out

        return self._once("openers", make)

    @property
    def _chunk(self) -> re.Pattern:
        """Runs of spaces, or of openers, with what follows them; an ASCII character that no longer piece holds stands alone."""

        def make():
            within = {c for t in self.ids if len(t) > 1 for c in t}
            alone = re.escape("".join(c for c in map(chr, range(128)) if c not in within))
            first = re.escape("".join(sorted(self.openers)))
            rest = f"[^{SPACE}{first}{alone}]"
            run = f"[{first}]" if first else ""
            return re.compile(f"{SPACE}+{run and run + '*'}{rest}*|" + (f"{run}+{rest}*|" if run else "") + f"{rest}+" + f"|[{alone}]" * bool(alone))

        return self._once("chunk", make)

    def chunks(self, text: str) -> list[str]:
        """Parts of a normalised text that are segmented independently."""
        return self._chunk.findall(text) if self.chunkable else [text]

    def merged(self, text: str) -> list[str]:
        """The BPE merges of a short text, as the rule says: best score first, leftmost of equals."""
        known = self._made.get("mergeable") or (self.ids and self._made["mergeable"])
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                j = known.get(parts[i] + parts[i + 1])
                if j is not None and (best is None or self.scores[j] > best):
                    best, at = self.scores[j], i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _merges(self, at: int) -> tuple[list[tuple[int, str, str]], str, str]:
        """Merges of a piece in their order, as (rank, first part, last part after it), and the parts before any."""
        parts, known = list(self.texts[at]), self.ranks
        first, last, out = parts[0], parts[-1], []
        while len(parts) > 1:
            rank, i = min((known.get(parts[i] + parts[i + 1], _NEVER), i) for i in range(len(parts) - 1))
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            out.append((rank, parts[0], parts[-1]))
        return out, first, last

    @property
    def ranks(self) -> dict[str, int]:
        """Merge priority of each piece, best first; equal scores are equal ranks."""

        def make():
            place = {s: i for i, s in enumerate(sorted(set(self.scores), reverse=True))}
            return {t: place[self.scores[i]] for t, i in self.ids.items()}

        return self._once("ranks", make)

    def stable(self, a: int, b: int) -> bool:
        """Whether BPE leaves the border between the pieces a and b when they stand side by side.

        The merges inside either piece run in the order of their ranks; the border falls if, at some point, joining
        the parts that then touch it has a better rank than what comes next on both sides (left of equals first).
        """
        made = self._once("merges", dict)
        for x in (a, b):
            if x not in made:
                made[x] = self._merges(x)
        (left, _, x), (right, y, _) = made[a], made[b]
        known, i, j = self.ranks, 0, 0
        while True:
            rank = known.get(x + y, _NEVER)
            on_left, on_right = left[i][0] if i < len(left) else _NEVER, right[j][0] if j < len(right) else _NEVER
            if rank < on_left and rank <= on_right and rank < _NEVER:
                return False
            if on_left == on_right == _NEVER:
                return True
            if on_left <= on_right:
                x = left[i][2]
                i += 1
            else:
                y = right[j][1]
                j += 1

    def fallback(self, char: str) -> tuple[int, ...]:
        """Ids of a character that no piece has: those of its bytes, or the unknown id."""
        return tuple(self.bytes_at[b] for b in char.encode("utf-8", "surrogatepass")) if self.byte_fallback else (self.unknown,)

    @property
    def neighbours(self) -> dict[int, bool]:
        """Memo of stable(), keyed by a << 20 | b; as large as the pairs of pieces that texts bring up, bounded by NEIGHBOURS."""
        memo = self._once("neighbours", dict)
        if len(memo) > NEIGHBOURS:
            memo.clear()
        return memo


_HERE: dict[str, Pieces] = {}


def in_process(model: Pieces) -> Pieces:
    """The copy of a broadcast model that holds this worker process's caches."""
    key = model.digest or hashlib.sha256(repr((model.texts, model.scores, model.types, model.bpe, model.byte_fallback, model.dummy_prefix, model.trim)).encode()).hexdigest()
    return _HERE.setdefault(key, model)


@releases
def _forget() -> None:
    """Drops the caches of this worker process; the models themselves live as long as their broadcasts."""
    for model in _HERE.values():
        model._made.clear()
    _HERE.clear()
