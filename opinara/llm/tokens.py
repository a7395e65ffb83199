"""Token ids of whole texts, inside tasks.

A byte-level vocabulary splits a text into pieces before it merges bytes, and no piece reaches over
the place between a visible ASCII character and the space or line feed after it. So a text is cut
there, every chunk is encoded once and remembered, and the ids of a text are its chunks' ids one
after another: the same ids as of the whole text, at a fraction of the work. A chunk that is one
word, with or without a closing mark, is two pieces at most and goes to the library's merges
directly; all others go through the whole tokenizer.

Most distinct chunks of a corpus come once. A worker remembers a chunk when a second batch brings
it, so what it holds is small and pays.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import numpy as np

#: Chunks, and characters of chunks, that a worker remembers, about 200 bytes each.
REMEMBERED = 600_000
REMEMBERED_CHARS = 12_000_000
#: Characters of the texts that are cut at once.
BATCH_CHARS = 4_000_000
#: Marks of chunks that an earlier batch has brought; a chunk that shares one is remembered early.
SEEN = 1 << 23

#: After a visible ASCII character, before a space or line feed.
_CUT = re.compile(r"(?<=[!-~])(?=[ \n])")
#: A word (or a number) and what closes it: two pieces at most, after a line feed.
_WORD = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ɏ]+|[0-9]+)([!-/:-@\[-`{-~]*)")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The letter that stands for a byte that isn't printable: the next from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = iter(range(0x100, 0x200))
    return {b: chr(next(hidden)) for b in range(256) if b not in shown}


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder_for(path: str, end_id: int | None) -> Encoder:
    """The encoder of this worker, with what it has met in earlier tasks."""
    if (path, end_id) not in _ENCODERS:
        _ENCODERS[path, end_id] = Encoder(path, end_id)
    return _ENCODERS[path, end_id]


class Encoder(dict):
    """Ids of texts, an end id after each. ``path`` names a ``tokenizers`` file of byte-level BPE.

    As a mapping: a chunk's name (see ``names_of``) to its place in ``starts``.
    """

    def __init__(self, path: str, end_id: int | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.letters = byte_letters()
        self.marks: dict[str, list[int]] = {"": []}
        self.seen = bytearray(SEEN)
        self.pool, self.starts = array("I"), array("q", [0])
        self.added: list[str] = []
        self.chars = 0
        # The end id goes by a name that no chunk has.
        self.end = [] if end_id is None else [0]
        self._add(" ", [] if end_id is None else [end_id])
        self.kept = 1

    def _add(self, name: str, ids: list[int] | array) -> int:
        at = self[name] = len(self.starts) - 1
        self.pool.extend(ids)
        self.starts.append(len(self.pool))
        self.added.append(name)
        return at

    def _ids(self, name: str) -> array:
        at = self[name]
        return self.pool[self.starts[at] : self.starts[at + 1]]

    def __missing__(self, name: str) -> int:
        found = _WORD.fullmatch(name)
        if found and not found[1] and not found[3]:
            ids = self._merged(" " + name)
        elif found and not found[1]:
            ids = self._ids(found[2])
            ids.extend(self._mark(found[3]))
        elif found:
            ids = self._mark(found[1]) + self._merged(found[2]) + self._mark(found[3])
        else:
            chunk = name[1:] if name[0] == " " else name if name[0] == "\n" else " " + name
            ids = self.tokenizer.encode(chunk, add_special_tokens=False).ids
        return self._add(name, ids)

    def _merged(self, piece: str) -> list[int]:
        written = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(written)]

    def _mark(self, mark: str) -> list[int]:
        ids = self.marks.get(mark)
        if ids is None:
            if len(self.marks) > 10_000:
                self.marks = {"": []}
            ids = self.marks[mark] = self._merged(mark)
        return ids

    def _forget(self, n_starts: int, n_pool: int) -> None:
        """Of the chunks added since, keep those that an earlier batch has brought too."""
        again, seen = [], self.seen
        for name in self.added:
            mark = hash(name) % SEEN
            if seen[mark]:
                again.append((name, self._ids(name)))
            seen[mark] = 1
            del self[name]
        del self.starts[n_starts:], self.pool[n_pool:]
        for name, ids in again:
            if self.kept >= REMEMBERED or self.chars >= REMEMBERED_CHARS:
                break
            self._add(name, ids)
            self.kept += 1
            self.chars += len(name)

    def encode(self, texts: list[str | None]) -> Iterator[np.ndarray]:
        """An array of unsigned 32-bit ids for each text; a null text is an empty one."""
        part, size = [], 0
        for text in texts:
            part.append(text)
            size += len(text or "")
            if size >= BATCH_CHARS:
                yield from self._encode(part)
                part, size = [], 0
        if part:
            yield from self._encode(part)

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        self.added.clear()
        before = len(self.starts), len(self.pool)
        at: list[int] = []
        ends = []
        for text in texts:
            if text:
                at.extend(map(self.__getitem__, names_of(text)))
            at.extend(self.end)
            ends.append(len(at))
        chunks = np.array(at, np.int64)
        del at
        pool, starts = np.frombuffer(self.pool, np.uint32), np.frombuffer(self.starts, np.int64)
        sizes = starts[chunks + 1] - starts[chunks]
        closed = np.concatenate([[0], np.cumsum(sizes)])
        ids = pool[np.repeat(starts[chunks] - closed[:-1], sizes) + np.arange(closed[-1])]
        del pool, starts  # views, which would keep the arrays from growing
        self._forget(*before)
        return np.split(ids, closed[ends][:-1]) if texts else []


def names_of(text: str) -> list[str]:
    """Names of the chunks that a byte-level tokenizer encodes independently of each other.

    A chunk with a space in front goes by the word behind it, one with a line feed by itself, and
    any other by a space and itself.
    """
    words = text.split()
    gaps = len(words) - 1
    if len("".join(words)) + gaps == len(text) and text.count(" ") + text.count("\n") == gaps >= 0:
        # Every white space is a single space or line feed between two words.
        names = text.replace("\n", " \n").split(" ")
        names[0] = " " + names[0]
        return names
    return [" " + chunk for chunk in _CUT.split(text) if chunk]
