"""Token ids of whole texts by the ``tokenizers`` library, with a cache of pretokens.

The library spends microseconds a pretoken on merges; natural text repeats its
pretokens, so each worker keeps the ids of those it has seen.  A pretoken is
encoded by the library's own model; only the splitting is done here, by the
splitter's published pattern, and tests hold the ids against the library's.
A text that holds the string of an added token, such as a special one, is
encoded by the library as a whole.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from collections.abc import Iterable

import numpy as np

from .common import SLICE_BYTES, span_marks

#: ASCII white space, and the last three bytes of wider white-space characters.
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
WIDE_BLANKS = np.array([0xE19A80, *range(0xE28080, 0xE2808B), 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080])


def tokenizer_path(name: str) -> str:
    """``name`` itself if it is a path, else the place of a public tokenizer's file on this machine."""
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for themselves, the others follow from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, extra = {}, 256
    for b in range(256):
        if b in own:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class CachedEncoder:
    """Ids of texts as little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, name: str, limit: int = 500_000):
        """``limit``: entries that the cache keeps at most; a full cache keeps the earliest, hence the most frequent."""
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import regex
        from tokenizers import Tokenizer

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec["pre_tokenizer"]
        self.model, self.limit = self.tokenizer.model, limit
        size = max(spec["model"]["vocab"].values()) + 1
        self.width = 2 if size <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self.letters = _byte_letters()
        self.tokenize, self.blank, self.plain = self.model.tokenize, self.letters[32], frozenset(".,;:!?")
        self.pack = [struct.Struct(f"<{n}{'H' if self.width == 2 else 'I'}").pack for n in range(64)]
        self.spans: dict[str, bytes] = {}
        self.table = _Table(limit, self.dtype)
        self.normal = spec["normalizer"] is not None
        self.spaced = pre["type"] == "ByteLevel"
        if self.spaced:  # white space belongs to the pretokens
            if spec["normalizer"] or pre["add_prefix_space"] or not pre["use_regex"]:
                raise ValueError(f"{path}: a byte-level tokenizer without normaliser and prefix space is asked for")
            pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        else:  # a pattern's matches, white space dropped
            split = pre["pretokenizers"][0]
            if split["type"] != "Split" or not split["invert"]:
                raise ValueError(f"{path}: an inverted split is asked for")
            pattern = split["pattern"]["Regex"]
        self.find = regex.compile(pattern).findall
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = regex.compile("|".join(map(regex.escape, added)), regex.IGNORECASE if self.normal else 0).search if added else lambda text: None

    def piece(self, p: str) -> bytes:
        """Ids of one pretoken, by the library's model."""
        mapped = p.replace(" ", self.blank) if p.isascii() and p.isprintable() else p.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = [t.id for t in self.tokenize(mapped)]
        n = len(ids)
        return self.pack[n](*ids) if n < 64 else np.array(ids, self.dtype).tobytes()

    def span(self, s: str) -> bytes:
        """Ids of a run of pretokens; those of its single pretokens are kept.

        Beyond Latin letters the library itself splits: its tables of letters
        needn't be those of the pattern module.
        """
        if not s.isascii() and max(s) > "\u024f":
            return np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, self.dtype).tobytes()
        spans, body = self.spans, s[1:] if self.spaced and s[:1] == " " else s
        if body.isalpha():
            parts = [s]
        elif body[:-1].isalpha() and body[-1] in self.plain:  # a word and one mark
            parts = [s[:-1], s[-1]]
        else:
            parts = self.find(s)
        out = []
        for p in parts:
            got = spans.get(p)
            if got is None:
                got = self.piece(p)
                if len(spans) < self.limit // 2:
                    spans[p] = got
            out.append(got)
        return b"".join(out)

    def _normal(self, text: str) -> str:
        if text.isascii() or unicodedata.is_normalized("NFC", text) and "Σ" not in text:
            return text.lower()
        return self.tokenizer.normalizer.normalize_str(text)

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of each text; null as empty."""
        out: list[np.ndarray] = []
        part, size = [], 0
        for text in texts:
            if text and self.added(text):
                out += (self._encode(part) if part else []) + [np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype)]
                part, size = [], 0
                continue
            data = (text or "").encode("utf-8", "surrogatepass") if not self.normal else self._normal(text or "").encode("utf-8", "surrogatepass")
            part.append(data)
            size += len(data)
            if size > SLICE_BYTES:
                out += self._encode(part)
                part, size = [], 0
        return out + (self._encode(part) if part else [])

    def _encode(self, part: list[bytes]) -> list[np.ndarray]:
        buf = np.frombuffer(b"".join(part), np.uint8)
        offs = np.zeros(len(part) + 1, np.int64)
        np.cumsum([len(x) for x in part], out=offs[1:])
        starts, ends = self._spans(buf, offs)
        if not len(starts):
            return [np.zeros(0, self.dtype)] * len(part)
        at = self.table.find(buf, starts, ends, self.span)
        first, count = self.table.first[at], self.table.count[at]
        stop = np.cumsum(count)
        ids = self.table.pool[np.repeat(first - (stop - count), count) + np.arange(stop[-1])]
        edge = np.concatenate([[0], stop])[np.searchsorted(starts, offs)]
        return [ids[edge[i] : edge[i + 1]] for i in range(len(part))]

    def _spans(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches that no pretoken crosses: a run of white space with the words after it, or words alone where white space is dropped."""
        blank = BLANK[buf]
        begin = np.zeros(len(buf), bool)
        if self.spaced:
            begin[1:] = blank[1:] & ~blank[:-1]
            at = np.flatnonzero(begin)
            at = at[buf[at - 1] >= 128]
            if len(at):  # after a character that is white space itself the run began earlier
                a, b, c = buf[at - 1].astype(np.int32), buf[at - 2].astype(np.int32), buf[np.maximum(at - 3, 0)].astype(np.int32)
                two, three = b << 8 | a, c << 16 | b << 8 | a
                begin[at[(two == 0xC285) | (two == 0xC2A0) | np.isin(three, WIDE_BLANKS)]] = False
            edge = offs[:-1]
            begin[edge[edge < len(buf)]] = True
            starts = np.flatnonzero(begin)
            return starts, np.append(starts[1:], len(buf))
        inside = ~blank
        stop = inside.copy()
        begin[:] = inside
        begin[1:] &= blank[:-1]
        stop[:-1] &= blank[1:]
        edge = offs[1:-1]
        cut = edge[(edge > 0) & (edge < len(buf))]
        begin[cut] |= inside[cut]
        stop[cut - 1] |= inside[cut - 1]
        return np.flatnonzero(begin), np.flatnonzero(stop) + 1


class _Table:
    """Spans seen so far: an open-addressing table of their hashes, first and last eight bytes and lengths, and their ids in a pool.

    First and last bytes and the length tell spans of up to 16 bytes; longer ones are compared byte by byte as well.
    """

    def __init__(self, limit: int, dtype: np.dtype):
        self.limit, self.dtype = limit, dtype
        self.bits = max(10, (2 * limit - 1).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        self.size = self.used = 0
        n = 1 << 12
        self.hash, self.head, self.tail = (np.zeros(n, np.uint64) for _ in range(3))
        self.long, self.count, self.first = (np.zeros(n, np.int64) for _ in range(3))
        self.pool = np.zeros(1 << 14, dtype)
        self.wide: dict[int, bytes] = {}

    def _grow(self, n: int, ids: int) -> None:
        if n > len(self.hash):
            for k in ("hash", "head", "tail", "long", "count", "first"):
                old = getattr(self, k)
                setattr(self, k, np.concatenate([old, np.zeros(max(n, 2 * len(old)) - len(old), old.dtype)]))
        if ids > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(ids, 2 * len(self.pool)) - len(self.pool), self.dtype)])

    def find(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, span) -> np.ndarray:
        """The entry of each range of ``buf``; new ones are added, ``span`` giving their ids' bytes.

        Beyond ``limit`` entries, new ones hold only until the next call, so
        that the earliest and hence the most frequent stay.
        """
        head, tail, h = span_marks(buf, starts, ends)
        long = ends - starts
        if self.size > self.limit:
            self.size, self.used = self.limit, self.kept
        mask = np.uint64((1 << self.bits) - 1)
        out, data = np.full(len(h), -1, np.int64), buf.tobytes()
        bytes_of = lambda i: data[starts[i] : ends[i]]
        todo, slot = np.arange(len(h)), (h & mask).astype(np.int64)
        while len(todo):
            e = self.slot[slot]
            same = (e >= 0) & (self.hash[e] == h[todo])
            same[same] = (self.head[e[same]] == head[todo[same]]) & (self.tail[e[same]] == tail[todo[same]]) & (self.long[e[same]] == long[todo[same]])
            for k in np.flatnonzero(same & (long[todo] > 16)).tolist():
                same[k] = self.wide[int(e[k])] == bytes_of(todo[k])
            out[todo[same]] = e[same]
            on = (e >= 0) & ~same
            todo, slot = todo[on], (slot[on] + 1) & int(mask)
        miss = np.flatnonzero(out < 0)
        if not len(miss):
            return out
        order = np.lexsort((long[miss], tail[miss], head[miss], h[miss]))
        m = miss[order]
        new = np.ones(len(m), bool)
        new[1:] = (h[m[1:]] != h[m[:-1]]) | (head[m[1:]] != head[m[:-1]]) | (tail[m[1:]] != tail[m[:-1]]) | (long[m[1:]] != long[m[:-1]])
        first = 0
        for k in np.flatnonzero(long[m] > 16).tolist():  # spans of equal marks stand together: each against the last new one
            if new[k]:
                first = k
            else:
                new[k] = bytes_of(m[k]) != bytes_of(m[first])
                first = k if new[k] else first
        lead = m[new]
        out[m] = self.size + np.cumsum(new) - 1
        got = [span(data[a:b].decode("utf-8", "surrogatepass")) for a, b in zip(starts[lead].tolist(), ends[lead].tolist())]
        ids = np.frombuffer(b"".join(got), self.dtype)
        count = np.array([len(x) for x in got]) // self.dtype.itemsize
        n, keep = len(lead), max(0, min(len(lead), self.limit - self.size))
        self._grow(self.size + n, self.used + len(ids))
        at = slice(self.size, self.size + n)
        self.hash[at], self.head[at], self.tail[at], self.long[at], self.count[at] = h[lead], head[lead], tail[lead], long[lead], count
        self.wide.update((self.size + int(k), bytes_of(lead[k])) for k in np.flatnonzero(long[lead] > 16))
        self.first[at] = self.used + np.cumsum(count) - count
        self.pool[self.used : self.used + len(ids)] = ids
        if self.size < self.limit:
            self.kept = self.used + int(count[:keep].sum())
        todo, slot = np.arange(self.size, self.size + keep), (h[lead[:keep]] & mask).astype(np.int64)
        while len(todo):  # each free slot takes one of those that want it; the others go on
            free = self.slot[slot] < 0
            self.slot[slot[free]] = todo[free]
            on = self.slot[slot] != todo
            todo, slot = todo[on], (slot[on] + 1) & int(mask)
        self.size += n
        self.used += len(ids)
        return out


_ENCODERS: dict[str, CachedEncoder] = {}


def encoder(name: str) -> CachedEncoder:
    """This worker's encoder for a tokenizer file."""
    if name not in _ENCODERS:
        _ENCODERS[name] = CachedEncoder(name)
    return _ENCODERS[name]
