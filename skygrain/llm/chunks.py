"""Cutting text where a byte-level tokenizer is sure to cut, to encode repeated words once.

The tokenizer's pattern starts a new piece at every single space or line feed that has no white space beside it:
what stands between two of them is encoded the same wherever it stands. Its ids are kept in a bounded
dictionary; text with runs of white space goes the slow way, through the pattern itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Entries a dictionary holds before it starts anew (about 20 MB; workers keep it between tasks).
CACHE_ENTRIES = 100_000
#: The pattern of the vocabulary's pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

# Begins a part that has no space before it; all others have one, but for those that begin with a line feed.
BARE, LINE = "\0", "\n"
_RUN = re.compile(r"\s\s|\0")
# the same for Arrow, whose \s is that of ASCII only
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_RUN_IN_ARROW = rf"{_SPACE}{_SPACE}|\x00"


def byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in the vocabulary file: printable ones stand for themselves."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Ids, merges and added tokens of a byte-level vocabulary file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        letters = byte_letters()
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {token: i for token, i in spec["model"]["vocab"].items() if token not in self.added}
        self.bytes = [b""] * (max([*self.ids.values(), *self.added.values()]) + 1)
        for token, i in self.ids.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.added.items():
            self.bytes[i] = token.encode()
        self.merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        self.splitter = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True)))) if self.added else None

    def sections(self, text: str) -> Iterator[tuple[int | None, str]]:
        """Ordinary sections, each with the id of the added token before it."""
        if self.splitter is None:
            yield None, text
            return
        at, before = 0, None
        for found in self.splitter.finditer(text):
            yield before, text[at:found.start()]
            at, before = found.end(), self.added[found[0]]
        yield before, text[at:]


def parts(text: str) -> list[str] | None:
    """Parts between safe cuts, or None if white space stands beside white space."""
    return None if _RUN.search(text) else (BARE + text).replace(LINE, " " + LINE).split(" ")


def written(part: str) -> str:
    """A part as it stands in the text."""
    return part[1:] if part.startswith(BARE) else part if part.startswith(LINE) else " " + part


def encode_column(
    texts: pa.Array, added: Iterable[str], learn: Callable[[set[str]], None], word: Callable[[str], bytes], slow: Callable[[list[str]], list[np.ndarray]],
) -> list[np.ndarray]:
    """Ids of every text of a string column without nulls.

    All texts are cut at once, every distinct part is looked up once (``learn`` sees them all first, ``word`` gives packed ids), and
    the ids are gathered by number. Texts with runs of white space or added tokens go to ``slow``.
    """
    apart = pc.match_substring_regex(texts, _RUN_IN_ARROW)
    for token in added:
        apart = pc.or_(apart, pc.match_substring(texts, token))
    mask = apart.to_numpy(zero_copy_only=False)
    out: list[np.ndarray] = [np.empty(0, "<i4")] * len(texts)
    others = np.flatnonzero(mask).tolist()
    for i, ids in zip(others, slow([texts[i].as_py() for i in others]) if others else ()):
        out[i] = ids
    plain = np.flatnonzero(~mask)
    if len(plain):
        marked = pc.binary_join_element_wise(pa.scalar(BARE), pc.replace_substring(texts.filter(pc.invert(apart)), LINE, " " + LINE), "")
        cut = pc.split_pattern(marked, " ")
        coded = cut.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        learn(set(distinct))
        found = [word(p) for p in distinct]
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat, at = np.frombuffer(b"".join(found), "<i4"), coded.indices.to_numpy()
        each = lengths[at]
        ends = np.cumsum(each)
        ids = flat[np.arange(ends[-1]) + np.repeat((np.cumsum(lengths) - lengths)[at] - (ends - each), each)]
        last = ends[np.cumsum(cut.value_lengths().to_numpy()) - 1].tolist()  # a text has one part at least
        for i, a, b in zip(plain.tolist(), [0, *last], last):
            out[i] = ids[a:b]
    return out


def packed(ids: Iterable[int]) -> bytes:
    return np.fromiter(ids, "<i4").tobytes()


class Words(dict):
    """Packed ids of parts. A full dictionary becomes the old one, from which parts that are met again come back."""

    def __init__(self, encode: Callable[[str], bytes], entries: int = CACHE_ENTRIES):
        super().__init__()
        self.encode, self.entries = encode, entries
        self.old: dict[str, bytes] = {}

    def make_room(self) -> None:
        if len(self) >= self.entries:
            self.old = dict(self)
            self.clear()

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self.encode(written(part))
        self.make_room()
        self[part] = ids
        return ids

    def ids(self, cut: list[str]) -> np.ndarray:
        """Ids of a whole section."""
        return np.frombuffer(b"".join(map(self.__getitem__, cut)), "<i4")
