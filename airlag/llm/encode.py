"""Token ids of whole texts, with the ids of repeated words kept in a table.

A text is cut where a space follows a character that is no white space. The
tokenizers named below split such a place into separate words before they merge
anything, so the ids of the parts, joined, are the ids of the text. Parts recur
far more often than texts do: each task looks most of them up and hands only
new ones to the tokenizers library, in batches. A tokenizer whose splits are
not known here gets whole texts.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable
from functools import cache
from itertools import compress, repeat

import numpy as np
import pyarrow as pa

from airlag.llm.common import balanced, strings, text_bytes

#: Bytes of text that are split at once, and that go to the library at once.
SPLIT_BYTES = 4 << 20
CALL_BYTES = 1 << 18
#: Parts whose ids a Python worker keeps.
KEEP_PARTS = 400_000

# How the two kinds of tokenizers that may be cut split a text,
# as their files state it.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORD_NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"},
]
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"


def cuts_are_safe(spec: dict) -> bool:
    """Whether a tokenizer file splits texts in one of the two known ways."""
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] or re.search(r"\s", t["content"])
           or len(split_safely(t["content"])) > 1 for t in spec.get("added_tokens") or []):
        return False
    split, normalizer = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if split == _BYTE_LEVEL:
        return normalizer is None
    steps = split.get("pretokenizers") or [{}]
    same = steps[0].get("type") == "Split" and steps[0].get("pattern") == {"Regex": _WORD_SPLIT}
    return same and (normalizer or {}).get("normalizers") == _WORD_NORMALIZERS


# Where a text is cut, by the byte after the cut and the one before it: bit 1, a
# plain space, tab or line break after a character that is no white space
# (Python's, which includes that of both tokenizers); bit 2, one of some marks
# after a letter, where both also split. What lies in a character of several
# bytes is looked at more closely.
_AFTER, _BEFORE = np.zeros(256, np.uint8), np.ones(256, np.uint8)
_AFTER[list(b" \t\r\n")] = 1
_AFTER[list(b".,!?;:$*&#@%^~+=")] = 2
_BEFORE[[i for i in range(128) if chr(i).isspace()]] = 0
_BEFORE[[i for i in range(128) if chr(i).isalpha()]] = 3
_BEFORE[128:] = 3
_WIDE_BLANKS = np.array(
    [int.from_bytes(chr(i).encode()) for i in range(0x80, 0x3001) if chr(i).isspace() or i == 0x180E], np.int32
)
# One word to both, of letters that every lower-casing maps alike, one by one.
_LETTERS = r"[A-Za-z\xC0-\xD6\xD8-\xF6\xF8-\xFF]+"
_WORD = re.compile(_LETTERS)
_LED_WORD, _ANY_WORD = re.compile(" " + _LETTERS), re.compile(" ?" + _LETTERS)
#: Words that go to the library as one text, where their ids tell them apart.
JOINED = 512


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Positions in UTF-8 bytes where both kinds of tokenizers split anyway."""
    which = _AFTER[data[1:]] & _BEFORE[data[:-1]]
    at = np.flatnonzero(which) + 1
    wide = np.flatnonzero(data[at - 1] >= 0x80)
    if len(wide):
        here = at[wide]
        # A character of two or three bytes begins in the same text.
        one, two, three = (data[np.maximum(here - k, 0)].astype(np.int32) for k in (1, 2, 3))
        blank = np.isin(two << 8 | one, _WIDE_BLANKS) | np.isin(three << 16 | two << 8 | one, _WIDE_BLANKS)
        letter = (two == 0xC3) & (one != 0x97) & (one != 0xB7)
        kept = np.ones(len(at), bool)
        kept[wide] = np.where(which[here - 1] & 1, ~blank, letter)
        at = at[kept]
    return at


def word_ends(spec: dict) -> np.ndarray | None:
    """Per id, whether it ends a word, where a tokenizer file marks that in its
    entries and lower-cases all text; None for others. An added token that is
    itself a word would be found inside texts, so there may be none."""
    steps, suffix = (spec.get("normalizer") or {}).get("normalizers") or [], spec["model"].get("end_of_word_suffix")
    if {"type": "Lowercase"} not in steps or not suffix:
        return None
    return _marked(spec, lambda entry: entry.endswith(suffix))


def word_starts(spec: dict) -> np.ndarray | None:
    """Per id, whether it begins with a space, for byte-level entries: there only
    the first id of a word after a space does. None for others."""
    if spec.get("pre_tokenizer") != _BYTE_LEVEL:
        return None
    return _marked(spec, lambda entry: entry.startswith("\u0120"))


def _marked(spec: dict, has_mark: Callable[[str], bool]) -> np.ndarray | None:
    vocab, added = spec["model"]["vocab"], spec.get("added_tokens") or []
    if any(_WORD.fullmatch(t["content"]) for t in added):
        return None
    marked = np.zeros(max([*vocab.values(), *(t["id"] for t in added)]) + 1, bool)
    marked[[i for entry, i in vocab.items() if has_mark(entry)]] = True
    return marked


def split_safely(text: str) -> list[str]:
    """The parts of a text; joined, they are the text."""
    spelled = text.encode()
    cuts = [0, *safe_cuts(np.frombuffer(spelled, np.uint8)).tolist(), len(spelled)]
    return [spelled[a:b].decode() for a, b in zip(cuts, cuts[1:], strict=False)]


class Encoder:
    """Encodes columns of texts by one tokenizer file, one per Python worker.

    ``plain`` reads the strings of special tokens in a text as ordinary text.
    """

    #: Which ids end a word or, of words after a space, begin one, where words
    #: may share a text (see ``word_ends`` and ``word_starts``).
    ends: np.ndarray | None = None
    starts: np.ndarray | None = None

    def __init__(self, path: str, plain: bool = False, keep: int | None = None):
        # One task is one core; the library would start a thread for each.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = plain
        spec = json.loads(self.library.to_str())
        self.whole = not cuts_are_safe(spec)
        if not self.whole:
            self.ends, self.starts = word_ends(spec), word_starts(spec)
        self.keep = keep
        self._forget()

    def _forget(self) -> None:
        self.row: dict[str, int] = {}
        self.folded: dict[str, int] = {}
        self.rows = 0
        self.bounds = np.zeros(1024, np.int64)
        self.ids = np.empty(4096, np.uint32)
        self.used = 0

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per word): many words a call, as one text.
        They stand without spaces where ids end words, else each after its own."""
        between = "" if self.ends is None else " "
        texts = [between.join(words[i : i + JOINED]) for i in range(0, len(words), JOINED)]
        ids = np.concatenate(self._library(texts))
        if self.ends is None:
            sizes = np.diff(np.flatnonzero(self.starts[ids]), prepend=0, append=len(ids))
            # Nothing stands before the first word.
            first, sizes = sizes[0], sizes[1:]
        else:
            sizes = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)
            first = len(ids) - sizes.sum()
        if len(sizes) == len(words) and not first:
            return ids, sizes
        # Some entry does not say where its word ends: each word by itself.
        encoded = self._library(words)
        return np.concatenate(encoded), np.array([len(x) for x in encoded])

    def _library(self, parts: list[str]) -> list[np.ndarray]:
        """Ids of each part: batches balanced by size."""
        found: list[np.ndarray] = []
        begin, size = 0, 0
        for i, part in enumerate(parts):
            size += len(part)
            if size >= CALL_BYTES or i + 1 == len(parts):
                found += self._call(parts[begin : i + 1])
                begin, size = i + 1, 0
        return found

    def _call(self, texts: list[str]) -> list[np.ndarray]:
        encoded = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in encoded]

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Positions in UTF-8 bytes where a text may be cut."""
        return safe_cuts(data)

    def most(self) -> int:
        """The largest id."""
        return max(self.library.get_vocab(with_added_tokens=True).values())

    def _append(self, ids: np.ndarray, rows: int) -> None:
        while rows + 1 >= len(self.bounds):
            self.bounds = np.concatenate([self.bounds, np.zeros_like(self.bounds)])
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids

    def _store(self, ids: np.ndarray, sizes) -> int:
        """Rows for more ids; the number of the first of them."""
        base, self.rows = self.rows, self.rows + len(sizes)
        self._append(ids, self.rows)
        self.bounds[base + 1 : self.rows + 1] = self.used + np.cumsum(sizes)
        self.used += len(ids)
        return base

    def _learn(self, parts: list[str]) -> None:
        """Rows for distinct parts that have none."""
        rest = parts
        if self.ends is not None or self.starts is not None:
            shape = _LED_WORD if self.ends is None else _ANY_WORD
            known = [shape.fullmatch(p) is not None for p in parts]
            words, rest = list(compress(parts, known)), [p for p, w in zip(parts, known, strict=True) if not w]
            if words and self.ends is None:
                base = self._store(*self._words(words))
                self.row.update(zip(words, range(base, self.rows), strict=True))
            elif words:
                # A word has the ids of its lower-case form, with or without a space.
                folded = [word.lstrip(" ").lower() for word in words]
                fresh = [word for word in dict.fromkeys(folded) if word not in self.folded]
                if fresh:
                    base = self._store(*self._words(fresh))
                    self.folded.update(zip(fresh, range(base, self.rows), strict=True))
                self.row.update(zip(words, map(self.folded.__getitem__, folded), strict=True))
        if rest:
            encoded = self._library(rest)
            base = self._store(np.concatenate(encoded), list(map(len, encoded)))
            self.row.update(zip(rest, range(base, self.rows), strict=True))

    def _gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids per row) of rows of the table."""
        begin, size = self.bounds[rows], self.bounds[rows + 1] - self.bounds[rows]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
        return self.ids[at], size

    def _rows(self, parts: list[str]) -> np.ndarray:
        """Row of each of some distinct parts; new ones are encoded and added."""
        rows = np.fromiter(map(self.row.get, parts, repeat(-1)), np.int64, len(parts))
        new = np.flatnonzero(rows < 0)
        if len(new):
            added = [parts[i] for i in new.tolist()]
            self._learn(added)
            rows[new] = np.fromiter(map(self.row.__getitem__, added), np.int64, len(added))
        return rows

    def _parts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(row of each part, number of parts per text) of a column."""
        bounds, data = text_bytes(texts)
        begin = np.zeros(len(data), bool)
        begin[self.cuts(data)] = True
        begin[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
        begins = np.flatnonzero(begin)
        counts = np.diff(np.searchsorted(begins, bounds))
        if not len(begins):
            return begins, counts
        ends = np.append(begins, len(data)).astype(np.int64)
        buffers = [None, pa.py_buffer(ends), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_string(), len(begins), buffers).dictionary_encode()
        rows = self._rows(coded.dictionary.to_numpy(zero_copy_only=False).tolist())
        return rows[coded.indices.to_numpy()], counts

    def _trim(self) -> None:
        keep = self.keep or KEEP_PARTS
        if len(self.row) + len(self.folded) > keep or self.used > 16 * keep:
            self._forget()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, number of ids per text)."""
        found, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        for ids, size in self._wholes(texts) if self.whole else map(self._joined, self._each(texts)):
            found.append(ids)
            sizes.append(size)
        return np.concatenate(found), np.concatenate(sizes)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Number of ids per text."""
        if self.whole:
            return self.encode(texts)[1]
        sizes = [np.empty(0, np.int64)]
        for rows, counts in self._each(texts):
            sizes.append(_sums(self.bounds[rows + 1] - self.bounds[rows], counts))
        return np.concatenate(sizes)

    def _joined(self, found: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        rows, counts = found
        ids, size = self._gather(rows)
        return ids, _sums(size, counts)

    def _each(self, texts: pa.Array):
        texts = strings(texts)
        for part in balanced(texts, SPLIT_BYTES):
            yield self._parts(texts[part])
            self._trim()

    def _wholes(self, texts: pa.Array):
        texts = strings(texts)
        for part in balanced(texts, CALL_BYTES):
            ids = self._call(texts[part].to_pylist())
            yield np.concatenate(ids), np.array([len(x) for x in ids], np.int64)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)
