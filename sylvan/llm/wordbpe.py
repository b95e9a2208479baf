"""Word-wise use of the ``tokenizers`` library, equal to encoding whole texts.

Both BPE files pre-tokenize so that no token crosses the chunk borders chosen here, hence the
tokens of a text are those of its chunks. Chunks recur, so their encodings are memoised, in a
table of bounded size that a Python worker keeps from task to task. A missed chunk made of Latin
letters and closing punctuation goes straight to the library's BPE model (its pre-tokens are
known: the letters, then the punctuation, each looked up on its own); any other chunk, and any
text whose chunk borders could matter, goes through the library's whole pipeline.
"""

from __future__ import annotations

import re
from array import array
from functools import cache

#: Memoised chunks of each of two generations (about 200 bytes each).
MEMO_LIMIT = 200_000
#: The same where the ids of one file are all that a worker remembers.
IDS_LIMIT = 500_000

_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-;=?@\[-`{}~]*)", re.ASCII)


def _byte_alphabet() -> dict[int, str]:
    """The visible character that byte-level BPE files use for each byte: printable Latin-1
    bytes stand for themselves, the others follow from U+0100 on in ascending order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


_VISIBLE = _byte_alphabet()


def visible(s: str) -> str:
    return "".join(map(_VISIBLE.__getitem__, s.encode()))


def load(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Memo(dict):
    """A bounded memo: when the young generation is full it becomes the old one, and the old one
    goes. What is asked for again moves back into the young one, so frequent keys stay."""

    limit = MEMO_LIMIT

    def __init__(self):
        self.old: dict = {}

    def solve(self, key):
        raise NotImplementedError

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.solve(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


class WordCounts(Memo):
    """Token count of a chunk without ASCII white space, for a BPE file that drops white space,
    lower-cases, and splits letters from punctuation (``word_bpe_49k.json``)."""

    def __init__(self, path: str):
        super().__init__()
        self.tok = load(path)

    def solve(self, chunk: bytes) -> int:
        s = chunk.decode("utf-8", "replace")
        m = _SIMPLE.fullmatch(s)
        if not m:
            return len(self.tok.encode(s, add_special_tokens=False))
        letters, marks = m[1].lower(), m[2]
        if marks or letters != s:
            return self[letters.encode()] + (len(self.tok.model.tokenize(marks)) if marks else 0)
        return len(self.tok.model.tokenize(s if s.isascii() else visible(s)))

    def count(self, text: bytes) -> int:
        return sum(map(self.__getitem__, text.split()))


class WordIds(Memo):
    """Ids (as unsigned 16 or 32 bit, by vocabulary size) of ``' ' + chunk`` for a byte-level BPE
    file without prefix space (``byte_bpe_50k.json``)."""

    def __init__(self, path: str):
        super().__init__()
        self.tok = load(path)
        self.marks: dict[str, bytes] = {"": b""}  # runs of punctuation of a few characters
        self.openings: dict[str, bytes] = {}  # first words of lines
        self.code = "H" if self.tok.get_vocab_size() <= 1 << 16 else "I"

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tok.encode(text, add_special_tokens=False).ids).tobytes()

    def pretoken(self, s: str) -> bytes:
        return array(self.code, [t.id for t in self.tok.model.tokenize(s)]).tobytes()

    def solve(self, chunk: str) -> bytes:
        m = _SIMPLE.fullmatch(chunk)
        if not m:
            return self.lines(chunk)
        letters, marks = m[1], m[2]
        if not marks:
            return self.pretoken("Ġ" + letters if letters.isascii() else visible(" " + letters))
        if marks not in self.marks:
            if len(marks) > 4 or len(self.marks) > 10_000:
                return self[letters] + self.pretoken(marks)
            self.marks[marks] = self.pretoken(marks)
        return self[letters] + self.marks[marks]

    def lines(self, chunk: str) -> bytes:
        """A chunk with single line ends between other characters: a line end is a pre-token of
        its own there, so what stands before it and each plain word after it are solved alone."""
        head, *rest = chunk.split("\n")
        plain = [_SIMPLE.fullmatch(r) for r in rest]
        if not (head and rest and all(plain)) or head[-1].isspace():
            return self.whole(" " + chunk)
        return self[head] + b"".join(self.opening(m[1], m[2]) for m in plain)

    def opening(self, letters: str, marks: str) -> bytes:
        """Ids of a line end and the first word of its line."""
        ids = self.openings.get(letters)
        if ids is None:
            ids = self.pretoken(visible("\n")) + self.pretoken(visible(letters))
            if len(self.openings) < self.limit // 4:
                self.openings[letters] = ids
        return ids + (self.pretoken(marks) if marks else b"")

    def encode(self, text: str) -> bytes:
        """Ids of a whole text. A chunk begins at each single space; two white-space characters
        in a row across a border, or a special string, could change the split: such a text is
        encoded as one."""
        if not text:
            return b""
        chunks = text.split(" ")
        if "" in chunks or "<|" in text or any(map(str.isspace, chunks)):
            return self.whole(text)
        m = _SIMPLE.fullmatch(chunks[0])
        first = self.pretoken(visible(m[1])) + (self.pretoken(m[2]) if m[2] else b"") if m else self.whole(chunks[0])
        return first + b"".join(map(self.__getitem__, chunks[1:]))


@cache
def word_counts(path: str) -> WordCounts:
    """The worker's own instance; it outlives a task."""
    return WordCounts(path)


@cache
def word_ids(path: str) -> WordIds:
    """The worker's own instance; it outlives a task."""
    ids = WordIds(path)
    ids.limit = IDS_LIMIT
    return ids
