"""Text preparation: each line of a text becomes a symbol, blocks of lines are cut out by one pattern over the symbols, and
each block is trimmed to whole sentences by patterns over its characters.

Symbols: E and K are lines of prose, E where a sentence ends with the line; e is another line with which a sentence ends;
m is another line with words; x is the rest. A block is one E, or K and what follows it (see BLOCK).
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Abbreviations that keep their full stop inside a text, and the treebank's names of brackets (fixed values).
ABBREVIATIONS = "Mr. Mrs. Ms. Dr. Prof. Rev. Ret. Hon. Gov. Sen. Rep. Gen. Col. Capt. Lt. Sgt. St. Jr. Sr. Inc. Corp. Co. Ltd. vs. etc. e.g. i.e. Jan. Feb. Mar. Apr. Jun. Jul. Aug. Sep. Sept. Oct. Nov. Dec. No. Vol. U.S. U.K. U.N. D.C. a.m. p.m. Ph.D. Mt. Ft. Ave. Blvd.".split()
BRACKETS = {"(": "-LRB-", ")": "-RRB-", "[": "-LSB-", "]": "-RSB-", "{": "-LCB-", "}": "-RCB-"}
#: A line of prose has more than so many tokens, more than the first share of them with a letter, digit or mark, and less than the second with a digit.
LEAST_TOKENS, WORDY, NUMERIC = 5, 0.65, 0.3
#: A block's first end of a sentence is among so many tokens; a prepared block has more than so many words.
END_WITHIN, LEAST_WORDS = 70, 4

_W = "[A-Za-z0-9À-ɏ]"
_CLITICS = f"(?i:s|re|ve|ll|d|m)(?!{_W})"
#: The first alternative takes a whole run of letters and digits that no mark follows which another alternative could need; it finds nothing else than they would.
TOKEN = re.compile(
    rf"{_W}++(?![.'’,@&/_-])|\.\.\.|--+|``|''|(?<!{_W})(?:{'|'.join(map(re.escape, ABBREVIATIONS))})|(?<!{_W})(?:[A-Z]\.|[A-Za-z]\.(?:[A-Za-z]\.)+)(?!{_W})"
    rf"|{_W}+?(?=(?i:n['’]t)(?!{_W}))|(?i:n['’]t)(?!{_W})|(?<={_W})['’]{_CLITICS}|{_W}+(?:[.,@&/_-]{_W}+|['’](?!{_CLITICS}){_W}+)*|\S"
)
_MARKED = re.compile(r"[A-Za-z0-9'`\"“”‘’()\[\]{}]")
_DIGIT = re.compile("[0-9]")
_ENDS_LINE = re.compile("[.?!]['\"”]?\\Z")
BLOCK = re.compile("E|K(?:m?K)*(?:m?[Ee])?")
#: Words between white space that are kept with their counts in a worker, and the longest of them. No token holds or looks beyond white space.
CACHED, CACHED_LENGTH, _FIELD = 1 << 16, 64, 30
#: The first capital letter that begins a word, and a quotation mark and a bracket before it.
_CAPITAL = re.compile(f"(?<!{_W})(?<!{_W}[.,'’@&/_-])[A-Z]")
_OPENING = re.compile("(?:(?:''|``|[\"'“”‘’`]) ?)?(?:[(\\[{] ?)?\\Z")
#: An end of a sentence and the marks that close it; a stop beside another one is none.
_END = re.compile("(?:[?!]|(?<!\\.)\\.(?!\\.))(?:(?: *[”’\"')\\]])+|(?= )|\\Z)")


def tokenize(line: str) -> list[str]:
    """Penn-Treebank-like tokens: punctuation by itself, clitics split, brackets and quotation marks as the treebank writes them."""
    out = []
    for m in TOKEN.finditer(line):
        t = m[0]
        if t in '"“”':
            opens = t == "“" or (t == '"' and (m.start() == 0 or line[m.start() - 1].isspace()))
            t = "``" if opens else "''"
        out.append(BRACKETS.get(t) or {"‘": "`", "’": "'"}.get(t, t))
    return out


_RUN, _ABBREVIATIONS = re.compile(f"{_W}+"), frozenset(ABBREVIATIONS)


class _Counts(dict):
    """Of each word the number of its tokens, of those with a mark and of those with a digit, in three fields of one number."""

    def __missing__(self, word: str) -> int:
        core, marks = (word[:-1], 1) if word[-1] in ",;:.?!" else (word, 0)
        # Whether that mark is a token by itself.
        apart = word[-1] != "." or (len(core) > 1 and word not in _ABBREVIATIONS)
        if apart and core.isascii() and core.isalpha():
            n = 1 + marks + (1 << _FIELD)
        else:
            tokens = [core, *word[len(core) :]] if apart and _RUN.fullmatch(core) else TOKEN.findall(word)
            n = len(tokens) + sum(((_MARKED.search(t) is not None) << _FIELD) + ((_DIGIT.search(t) is not None) << 2 * _FIELD) for t in tokens)
        if len(word) <= CACHED_LENGTH:
            if len(self) >= CACHED:
                self.clear()
            self[word] = n
        return n


_counts = _Counts()


def symbol(line: str) -> str:
    """E, K, e, m or x (see the head of the module)."""
    total, ends = sum(map(_counts.__getitem__, line.split())), _ENDS_LINE.search(line, max(0, len(line) - 2)) is not None
    least = (1 << _FIELD) - 1
    n, wordy, digits = total & least, total >> _FIELD & least, total >> 2 * _FIELD
    if n > LEAST_TOKENS and wordy > WORDY * n and digits < NUMERIC * n:
        return "E" if ends else "K"
    return "e" if ends else "m" if n > 1 and wordy else "x"


def blocks(lines: list[str]) -> list[str]:
    """Blocks of lines. A block that begins in small letters takes the line before it where that was left out and begins with a
    capital, unless the text breaks off within the block."""
    symbols, before, out = "".join(map(symbol, lines)), 0, []
    for m in BLOCK.finditer(symbols):
        a, b = m.span()
        broken = symbols[b - 1] == "K" and symbols[b : b + 2] in ("", "m")
        if a > before and not broken and re.match("[A-Z]", lines[a - 1]) and not re.match("[A-Z]", lines[a]):
            a -= 1
        out.append("\n".join(lines[a:b]))
        before = b
    return out


def _ends_early(block: str) -> bool:
    """Whether a full stop, question or exclamation mark is among the first tokens."""
    seen = 0
    for word in block.split(None, END_WITHIN)[:END_WITHIN]:
        if "." in word or "!" in word or "?" in word:
            tokens = TOKEN.findall(word)[: END_WITHIN - seen]
            if any(t in (".", "!", "?") for t in tokens):
                return True
            seen += len(tokens)
        else:
            seen += _counts[word] & (1 << _FIELD) - 1
        if seen >= END_WITHIN:
            break
    return False


def clean_block(block: str) -> str | None:
    """The block from the start of its first sentence to the end of its last one; None if it has none or the first is too long."""
    first = _CAPITAL.search(block)
    if first is None or not _ends_early(block):
        return None
    opening = _OPENING.search(block[: first.start()])[0]
    # A bracket alone at the very beginning opens nothing.
    start = first.start() - (0 if len(opening) == first.start() and opening[:1] in BRACKETS else len(opening))
    dotted = tuple({*ABBREVIATIONS, *(t for w in block.split() if "." in w for t in TOKEN.findall(w) if len(t) > 1 and t[-1] == ".")})
    ends = (m for m in reversed(list(_END.finditer(block))) if m.start() and not (block[m.start()] == "." and block.endswith(dotted, 0, m.start() + 1)))
    last = next(ends, None)
    return block[start : last.end()] if last and last.end() > start else None


def prepare_text(text: str | None) -> str:
    """The prepared text: cleaned blocks of more than four words, joined by \\n; empty if nothing is left."""
    cleaned = map(clean_block, blocks(re.split("\r?\n", text or "")))
    return "\n".join(c for c in cleaned if c is not None and len(c.split(None, LEAST_WORDS)) > LEAST_WORDS)


def sentences(text: Column) -> Column:
    """The text cut at white space after a full stop, question or exclamation mark; empty parts go, null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?<=[.?!])[ \t\n\r\f]+"), lambda x: x != "")


def line_hashes(text: Column) -> Column:
    """md5 of each line as a hexadecimal number, so without leading zeros; of a prepared text these are the kept lines."""
    return F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: F.ltrim(F.md5(x), F.lit("0")))


@F.pandas_udf(T.StringType())
def _prepared(texts: pd.Series) -> pd.Series:
    return texts.map(prepare_text)


#: Nondeterministic to the optimiser, so that a filter on the result isn't pushed below it and texts aren't prepared twice.
prepared = _prepared.asNondeterministic()


def prepare_documents(docs: DataFrame, text_col: str = "text", band: tuple[int, int] | None = None) -> DataFrame:
    """Documents with prepared texts; those left empty go, and those outside ``band`` (lengths) if it is given."""
    out = docs.withColumn(text_col, prepared(F.col(text_col)))
    out = out.where(F.length(text_col) > 0)
    return out if band is None else out.where(F.length(text_col).between(*band))
