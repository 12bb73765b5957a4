"""Token ids of whole texts by the tokenizers library, with a memory of words already seen.

Both vocabularies split a text into pieces before any merge, and no piece crosses the borders
used here, so the ids of a text are the ids of its parts in order. Each part is encoded by the
library once and then looked up; a text that the border rule doesn't cover is encoded whole, and
so is one that holds an added token's string, which the library's plain call makes one id.

Texts are cut, compared and put together as arrays, many texts at a time, and the library gets
the unseen parts joined by a byte that keeps them apart; plain letters of the vocabulary whose
words have an end mark can't be joined, so each is merged by a call of its own.
"""

from __future__ import annotations

import re
import string
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Characters encoded at once, in whole texts.
PART = 8 << 20
#: Bytes kept in the table of parts, with what an entry takes besides its content; a full table
#: starts anew with the parts of the texts at hand, which bounds memory.
MAX_BYTES = 160 << 20
#: Bytes that a waiting worker keeps there for its next task.
IDLE_BYTES = 48 << 20
_ENTRY = 160
#: Longest part kept there, in bytes, and new parts given to the library in one call.
MAX_KEPT = 200
TOGETHER = 200

#: Letters for which lower case and normal form are plain, as UTF-8.
_PLAIN = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others, in
    order, as the characters from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_LETTERS = _byte_letters()
#: Bytes of the white space that parts words in the byte-level vocabulary.
_GAP = np.isin(np.arange(256), list(b" \t\n\r"))
#: Bytes of the white space that the other vocabulary drops.
_DROPPED = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: ASCII letters, and the marks that end a word behind one.
_LETTER = np.isin(np.arange(256), list(string.ascii_letters.encode()))
_MARK = np.isin(np.arange(256), list(string.punctuation.encode()))
#: White space other than blank, tab and line ends: such texts are encoded whole.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")


class TextIds:
    """Little-endian unsigned 32-bit ids of texts for one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # in any case of letters, should a token be looked for behind the normalizer
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        # this vocabulary drops white space and lower-cases; the byte-level one keeps both
        self.drops_space = self.tokenizer.normalizer is not None
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.held = 0
        if self.drops_space:
            # between blanks, this control byte is a piece of its own
            self.bar = b"\x01"
            (self.apart_id,), self.apart = self._ids(self.bar.decode()), b" " + self.bar + b" "
        else:
            vocab = self.tokenizer.get_vocab()
            merged = set().union(*(k for k in vocab if len(k) > 1))
            # a control byte that no merge takes: words beside it are merged as if each stood alone
            bar = next(b for b in range(32) if _LETTERS[b] in vocab and _LETTERS[b] not in merged)
            self.bar, self.bar_id = bytes([bar]), vocab[_LETTERS[bar]]
            # between other words it is a piece of its own
            self.apart, self.apart_id = b"\n", vocab[_LETTERS[10]]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _encode(self, text: str) -> bytes:
        return self._ids(text).tobytes()

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0].tobytes()

    def _together(self, parts: list[bytes], bar: bytes, bar_id: int, ids_of: Callable[[bytes], np.ndarray]) -> Iterator[bytes]:
        """Ids of each part, many by one call of the library, which keeps the bars between them apart."""
        for at in range(0, len(parts), TOGETHER):
            some = parts[at:at + TOGETHER]
            ids = ids_of(bar.join(some))
            data, ends = ids.tobytes(), 4 * np.flatnonzero(ids == bar_id)
            for a, b in zip([0, *(ends + 4).tolist()], [*ends.tolist(), len(data)], strict=True):
                yield data[a:b]

    def _letters(self, words: list[bytes]) -> Iterator[bytes]:
        """Ids of words of plain letters: one piece each, so the library's merges are asked directly."""
        merge, written = self.model.tokenize, b"\n".join(words).decode().lower().encode().decode("latin-1").translate(_LETTERS)
        for word in written.split(_LETTERS[10]) if words else ():
            yield array("I", [t.id for t in merge(word)]).tobytes()

    def _merged(self, letters: bytes) -> np.ndarray:
        """Ids by the library's merges alone, for plain letters."""
        return np.array([t.id for t in self.model.tokenize(letters.decode("latin-1").translate(_LETTERS))], "<u4")

    def _learn(self, parts: list[bytes], whole: set[bytes]) -> dict[bytes, bytes]:
        """Ids of parts that the table lacks. A full table starts anew."""
        plain, other, single = [], [], []
        for x in parts:
            if _PLAIN.fullmatch(x):
                plain.append(x)
            elif x in whole or x.isspace() or self.drops_space and self.bar in x:
                single.append(x)
            else:
                other.append(x)
        new = dict(zip(plain, self._letters(plain) if self.drops_space
                       else self._together(plain, self.bar, self.bar_id, self._merged)))
        new.update(zip(other, self._together(other, self.apart, self.apart_id, lambda x: self._ids(x.decode()))))
        new.update((x, self._encode(x.decode())) for x in single)
        kept = {x: ids for x, ids in new.items() if len(x) <= MAX_KEPT and x not in whole}
        size = sum(map(len, kept)) + sum(map(len, kept.values())) + _ENTRY * len(kept)
        if self.held + size > MAX_BYTES:
            self.words.clear()
            self.held = 0
        self.words.update(kept)
        self.held += size
        return new

    def release(self) -> None:
        """At the end of a task: a large table goes, so that workers that wait are small."""
        if self.held > IDLE_BYTES:
            self.words = {}
            self.held = 0

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, and the number of ids of each.

        The texts are cut at the borders all at once, equal parts are found by Arrow's hash table,
        and only different ones are looked up or given to the library."""
        data = [x.encode() for x in texts]
        edges = np.concatenate(([0], np.cumsum([len(x) for x in data], dtype=np.int64)))
        flat = np.frombuffer(b"".join(data), np.uint8)
        cut = (_words if self.drops_space else _borders)(flat, edges)
        whole, ranges = set(), []
        for k, x in enumerate(texts):
            if self.added and self.added.search(x) or not self.drops_space and _ODD_SPACE.search(x):
                cut[edges[k]], cut[edges[k] + 1:edges[k + 1]] = True, False
                whole.add(data[k])
                ranges.append((edges[k], edges[k + 1]))
        at = np.flatnonzero(cut)
        first = np.searchsorted(at, edges)      # the number of each text's first part
        if self.drops_space:
            flat, cut = _without_space(flat, cut, ranges)
            at = np.flatnonzero(cut)
        units = pa.Array.from_buffers(pa.binary(), len(at), [
            None, pa.py_buffer(np.append(at, len(flat)).astype(np.int32)), pa.py_buffer(flat)]).dictionary_encode()
        ends, content = units.dictionary.buffers()[1:]
        ends = np.frombuffer(ends, np.int32)[:len(units.dictionary) + 1].tolist()
        content = content.to_pybytes() if content else b""
        keys = [content[a:b] for a, b in zip(ends, ends[1:])]
        got = list(map(self.words.get, keys))
        lacking = [k for k, ids in zip(keys, got) if ids is None]
        if lacking:
            new = self._learn(lacking, whole)
            got = [new[k] if ids is None else ids for k, ids in zip(keys, got)]
        size = np.fromiter(map(len, got), np.int64, len(got)) >> 2
        which = units.indices.to_numpy()
        n = size[which]
        upto = np.concatenate(([0], np.cumsum(n)))
        source = np.repeat((np.cumsum(size) - size)[which] - upto[:-1], n)
        source += np.arange(len(source))
        return np.frombuffer(b"".join(got), "<u4")[source], np.diff(upto[first])


def _borders(flat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where parts begin in the bytes of texts that begin at `edges`: a word with its single leading
    blank, cut where a mark follows an ASCII letter; white space but for the last one before a word,
    which is a part of its own unless a blank."""
    first = np.zeros(len(flat) + 1, bool)
    first[edges] = True
    cut, gap = first[:-1].copy(), _GAP[flat]
    before, here = gap[:-1], gap[1:]
    cut[1:] |= np.where(here, ~before, before & (flat[:-1] != 32))
    cut[:-1] |= before & ~here & ~first[1:-1]       # the last white space before a word of the same text
    cut[1:] |= _LETTER[flat[:-1]] & _MARK[flat[1:]]
    return cut


def _words(flat: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where words begin, cut where a mark follows an ASCII letter; white space is in no part."""
    word = ~_DROPPED[flat]
    start = np.ones(len(flat) + 1, bool)
    start[1:-1] = ~word[:-1]
    start[edges] = True
    cut = word & start[:-1]
    cut[1:] |= _LETTER[flat[:-1]] & _MARK[flat[1:]]
    return cut


def _without_space(flat: np.ndarray, cut: np.ndarray, whole: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and borders without white space, A to Z in lower case unless a character beyond ASCII
    follows, which might make one with it first; the ranges of whole texts as they are."""
    keep, upper = ~_DROPPED[flat], flat - np.uint8(65) < 26
    upper[:-1] &= flat[1:] < 128
    for a, b in whole:
        keep[a:b], upper[a:b] = True, False
    return np.where(upper, flat | np.uint8(32), flat)[keep], cut[keep]


@lru_cache(2)
def text_ids(path: str) -> TextIds:
    """One per Python worker and file."""
    return TextIds(path)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
