"""Exact byte-level BPE token counts at every prefix, by dynamic programming.

Method. A text falls into pieces (the tokenizer's split pattern) that are encoded independently. Within a piece, the token that
ends at byte i of the encoding of its prefix of i bytes is the only token t = piece[j:i] such that the encoding of piece[:j] ends in
a token after which t stays a token of its own; so last[i] = t and count[i] = count[j] + 1 fill a table over all prefixes
from left to right (linear in the piece). Whether two tokens stay apart is found once a pair by merging
their bytes. Tables of pieces are kept, so a text costs a split and a lookup a piece; sums of the pieces' counts give the
count at every piece end, and the piece's table those in between: truncation and budget questions need no further encoding.

The vocabulary is a parameter (a tokenizers .json of kind BPE with a ByteLevel split); it is read by the workers and never stored.
Special tokens of the file count as one token where their text occurs, as in the library's default.

Results of token_counts: doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit), cut_byte (where the text must be cut to keep the
first `limit` tokens: the end of that token, or n_bytes). Null and empty texts have 0 bytes and tokens. Rows are kept as they are,
repeated doc_ids included; other columns are ignored; an empty table gives an empty result. prefix_table also returns
the table at piece ends as arrays.
"""

from __future__ import annotations

import json
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firelark.llm import shared

LONE = re.compile(r"(?<=[^\s\x85]) (?=[^\s\x85])")
PLAIN = re.compile(r"^ | $| [\s\x85]|[\s\x85] ").search  # what keeps a text from being split at every space
KEPT = 500_000  # piece counts, and pairs of tokens, that a Python worker keeps


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in such vocabularies: itself, or the next free code point from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    free = iter(range(256, 512))
    return {chr(b if b in plain else next(free)): b for b in [*plain, *(b for b in range(256) if b not in plain)]}


def split_pattern() -> str:
    """The vocabulary's split pattern with letters, numbers and white space spelled out as code point ranges, for re."""
    import sys
    import unicodedata

    kinds = {"L": [], "N": []}
    for c in range(sys.maxunicode + 1):
        k = unicodedata.category(chr(c))[0]
        if k in kinds:
            r = kinds[k]
            if r and r[-1][1] == c - 1:
                r[-1][1] = c
            else:
                r.append([c, c])
    letters, numbers = ("".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in kinds[k]) for k in "LN")
    # Fixed value: code points with the property White_Space.
    space = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letters}]+| ?[{numbers}]+| ?[^{space}{letters}{numbers}]+|[{space}]+(?![^{space}])|[{space}]+"


class PrefixCounter:
    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        model, split = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True) or spec.get("normalizer"):
            raise ValueError("not a plain byte-level BPE vocabulary")
        chars = _byte_chars()
        raw = lambda t: bytes(chars[c] for c in t)
        # tokens by number: the bytes, then what each merge makes, so a lower number merges earlier
        self.number = {bytes([b]): b for b in range(256)}
        self.parts: list[tuple[int, int]] = [(b, b) for b in range(256)]
        self.pair: dict[tuple[int, int], int] = {}
        for m in model["merges"]:
            a, b = (raw(x) for x in (m if isinstance(m, list) else m.split(" ")))
            key = (self.number[a], self.number[b])
            if a + b not in self.number:
                self.number[a + b] = len(self.parts)
                self.parts.append(key)
            self.pair.setdefault(key, self.number[a + b])
        self.apart: dict[int, bool] = {}
        self.reached: list[bool] = []  # whether the encoding of a token's bytes is that token
        for i, (l, r) in enumerate(self.parts):
            self.reached.append(i < 256 or self.reached[l] and self.reached[r] and self.stays(l, r, top=i))
        # tokens by their bytes from the last to the first: node << 8 | byte -> node; ends: node -> token or -1
        self.back: dict[int, int] = {}
        self.ends = [-1]
        for raw_token, t in self.number.items():
            if self.reached[t]:
                node = 0
                for byte in reversed(raw_token):
                    key = node << 8 | byte
                    if key not in self.back:
                        self.back[key] = len(self.ends)
                        self.ends.append(-1)
                    node = self.back[key]
                self.ends[node] = t
        self.findall = re.compile(split_pattern()).findall
        special = [t["content"] for t in spec.get("added_tokens", [])]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec.get("added_tokens", [])):
            raise ValueError("special tokens with white space rules are not supported")
        self.special = special
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")").split if special else None
        self.counts = _Counts(self)
        self.words = _WordCounts(self)

    def stays(self, a: int, b: int, top: int = 1 << 60) -> bool:
        """Whether tokens a and b next to each other stay apart (top: for merges numbered under it). A merge across the
        border would join a right part of a with a left part of b, before the merges that make those parts whole."""
        limit = top
        while True:
            made = self.pair.get((a, b))
            if made is not None and made < limit:
                return False
            # undo the later of the two merges at the border; bytes have none
            if a > b and a > 255:
                limit, a = a, self.parts[a][1]
            elif b > 255:
                limit, b = b + 1, self.parts[b][0]  # of equal merges the left one comes first
            elif a > 255:
                limit, a = a, self.parts[a][1]
            else:
                return True

    def table(self, piece: bytes) -> tuple[list[int], list[int]]:
        """(count, start of the last token) for the prefixes of 0 to len(piece) bytes."""
        size = len(piece)
        count, start, last = [0] * (size + 1), [0] * (size + 1), [0] * (size + 1)
        back, ends, apart = self.back.get, self.ends, self.apart
        if len(apart) > KEPT:
            apart.clear()
        for i in range(1, size + 1):
            node = 0
            for j in range(i - 1, -1, -1):
                node = back(node << 8 | piece[j])
                if node is None:
                    raise AssertionError("no encoding of a prefix")
                t = ends[node]
                if t < 0:
                    continue
                if j:
                    key = last[j] << 20 | t
                    ok = apart.get(key)
                    if ok is None:
                        ok = apart[key] = self.stays(last[j], t)
                    if not ok:
                        continue
                count[i], start[i], last[i] = count[j] + 1, j, t
                break
        return count, start

    def pieces(self, text: str) -> list[str]:
        if self.cut is None or not any(s in text for s in self.special):
            return self.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.cut(text)):
            out.extend([part] if i % 2 else self.findall(part))
        return out

    def prefix(self, text: str) -> tuple[list[str], np.ndarray]:
        """Pieces, and the number of tokens up to the end of each."""
        p = self.pieces(text)
        return p, np.cumsum(np.fromiter(map(self.counts.__getitem__, p), np.int64, len(p)))

    def total(self, text: str) -> int:
        """Tokens of a text. A lone space between two other characters always begins a piece, so the words between
        such spaces are counted, and remembered, on their own."""
        if not text:
            return 0
        if self.cut is not None and any(s in text for s in self.special):
            return int(self.prefix(text)[1][-1])
        words = text.split(" ") if PLAIN(text) is None else LONE.split(text)
        return sum(map(self.words.__getitem__, words)) - self.words[words[0]] + self._sum(words[0])

    def _sum(self, text: str) -> int:
        return sum(map(self.counts.__getitem__, self.findall(text)))

    def cut_at(self, text: str, limit: int) -> int:
        """Byte at which the first `limit` tokens end."""
        p, ends = self.prefix(text)
        i = int(np.searchsorted(ends, limit, "right"))  # the first piece that ends beyond the limit
        done = sum(len(x.encode()) for x in p[:i])
        left = limit - (int(ends[i - 1]) if i else 0)
        if i == len(p) or left <= 0:
            return done
        piece = p[i].encode()
        count, start = self.table(piece)
        at = len(piece)
        while count[at] > left:
            at = start[at]
        return done + at


class _Counts(dict):
    def __init__(self, of: PrefixCounter):
        self.of = of
        self.update({s: 1 for s in of.special})

    def __missing__(self, piece: str) -> int:
        if len(self) > KEPT:
            self.clear()
            self.update({s: 1 for s in self.of.special})
        raw = piece.encode()
        t = self.of.number.get(raw)
        n = 1 if t is not None and self.of.reached[t] else self.of.table(raw)[0][-1]
        if len(piece) < 200:
            self[piece] = n
        return n


class _WordCounts(dict):
    """Tokens of a space and the word."""

    def __init__(self, of: PrefixCounter):
        self.of = of

    def __missing__(self, word: str) -> int:
        if len(self) > KEPT:
            self.clear()
        n = self.of._sum(" " + word)
        if len(word) < 200:
            self[word] = n
        return n


_LOADED: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _LOADED:
        _LOADED[path] = PrefixCounter(path)
    return _LOADED[path]


def token_counts(docs: DataFrame, vocabulary: str, limit: int = 1024) -> DataFrame:
    """vocabulary: its path as the workers see it."""
    shared.small_batches(docs.sparkSession)

    def run(batches):
        import pyarrow as pa

        c = counter(vocabulary)
        for batch in batches:
            size, n, cut = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                size.append(len(text.encode()))
                n.append(c.total(text))
                cut.append(c.cut_at(text, limit) if n[-1] > limit else size[-1])
            cols = [pa.array(x, pa.int64()) for x in (size, n)] + [pa.array([x > limit for x in n], pa.bool_()), pa.array(cut, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=["doc_id", "n_bytes", "n_tokens", "over_limit", "cut_byte"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, cut_byte long")


def prefix_table(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, ends (byte at which each piece ends), tokens (tokens up to there)."""

    def run(batches):
        import pyarrow as pa

        c = counter(vocabulary)
        kind = pa.list_(pa.int64())
        for batch in batches:
            got = [c.prefix(text or "") for text in batch.column(1).to_pylist()]
            ends = [np.cumsum([len(x.encode()) for x in p], dtype=np.int64) for p, _ in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ends, kind), pa.array([t for _, t in got], kind)], names=["doc_id", "ends", "tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ends array<long>, tokens array<long>")
