"""Token ids of whole texts by the ``tokenizers`` library.

A text is cut where no token of a word-splitting tokenizer can span: before
white space that follows something else, and between a letter and a comma or
full stop at the end of a word (if the tokenizer's pre-tokenizer cuts there).
Each piece goes through the library's own normalizer, pre-tokenizer and model,
and its ids are kept, so a word seen before costs one dictionary lookup. Ids
travel as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import re
from itertools import islice

from tokenizers import Tokenizer

from .common import only, worker_cache

# Kept pieces per worker (about 230 bytes each). Beyond this the later three quarters go: what was
# met first is what is met most.
KEEP = 500_000
# Longer pieces are encoded but not kept.
KEEP_CHARS = 48
_CUT = re.compile(r"(?<!\s) ")
_LATIN = re.compile(r"[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
# A word of Latin letters and ASCII marks behind it, no apostrophe among them.
MARKED = re.compile(rf"({_LATIN.pattern})([!-&(-/:-@\[-`{{-~]{{1,8}})")
# Runs of marks whose ids are kept.
_RUNS = 10_000


class _Kept(dict):
    def __init__(self, make, keep: int):
        super().__init__()
        self.make, self.keep = make, keep

    def __missing__(self, key):
        value = self.make(key)
        if len(key) <= KEEP_CHARS:
            if len(self) >= self.keep:
                self.make_room()
            self[key] = value
        return value

    def make_room(self) -> None:
        for old in list(islice(self, self.keep // 4, None)):
            del self[old]


class _After(_Kept):
    """Ids of a white-space character and the piece after it. ``unsafe`` is
    set by a piece that is empty or ends in white space: the cut after such a
    piece was not a safe one."""
    unsafe = False
    lines: _After | None = None
    stops: dict[str, bytes] = {}
    marks = staticmethod(lambda letter, run: None)

    def ends(self, piece: str) -> tuple[str, bytes | None]:
        """A piece without the marks it ends in, and their ids, if these do
        not depend on what stands before."""
        if piece[-1] in self.stops and piece[-2:-1].isalpha():
            # a normalizer can make a letter end in a mark
            return piece[:-1], self.stops[piece[-1]] if piece[-2] <= "\xff" \
                else self.marks(piece[-2], piece[-1])
        m = MARKED.fullmatch(piece)
        return (m[1], self.marks("a", m[2])) if m else (piece, None)

    def __missing__(self, piece):
        if not piece or piece[-1].isspace():
            self.unsafe = True
            return b""
        if self.lines is not None and "\n" in piece:
            parts = piece.split("\n")
            if not any(not p or p[-1].isspace() for p in parts):
                return self[parts[0]] + b"".join(
                    [self.lines[p] for p in parts[1:]])
        elif not piece[-1].isalnum():
            stem, end = self.ends(piece)
            if end is not None:
                known = self.get(stem)
                if known is None:
                    return self[stem] + end
                # kept from the second time on
                if len(self) >= self.keep:
                    self.make_room()
                self[piece] = value = known + end
                return value
        return super().__missing__(piece)


class Encoder:
    """``encode(text)`` → the same ids as ``Tokenizer.encode(text,
    add_special_tokens=False)``, as bytes. Strings of special tokens are
    ordinary text."""

    def __init__(self, path: str, keep: int = KEEP):
        tok = Tokenizer.from_file(path)
        self._norm, self._pre = tok.normalizer, tok.pre_tokenizer
        self._model = tok.model
        self._four = [k.to_bytes(4, "little") for k in range(
            max(tok.get_vocab().values()) + 1)]
        self._learn_letters()
        self._after = _After(self._word(" ", self._letters), keep)
        self._after.lines = _After(self._word("\n", self._by_line), keep)
        self._first = self._word("", self._bare)
        self._runs: dict[str, bytes | None] = {}
        self._after.marks = self._after.lines.marks = self.marks
        self._after.stops = self._after.lines.stops = {
            c: self._chunk(c) for c in ",."
            if len(self._pre.pre_tokenize_str("ab" + c)) == 2}
        self.stops = self._after.stops

    def _split(self, chunk: str) -> list[str]:
        if self._norm is not None:
            chunk = self._norm.normalize_str(chunk)
        return [p for p, _ in self._pre.pre_tokenize_str(chunk)]

    def _learn_letters(self) -> None:
        """What normalizer and pre-tokenizer make of each Latin letter, if a
        word of such letters is one pre-token made of them one by one: behind
        a space, at the beginning of a text, and behind a line break."""
        letters = [chr(c) for c in range(0x41, 0x100) if _LATIN.match(chr(c))]
        made = {c: self._split(c) for c in letters}
        lead = self._split(" a")[0].removesuffix("".join(made["a"]))
        word, every = "".join("".join(made[c]) for c in letters), "".join(
            letters)
        known = {ord(c): "".join(p) for c, p in made.items()}
        self._lead = lead
        self._letters = known if self._split(" " + every) == [
            lead + word] else None
        self._bare = known if self._split(every) == [word] else None
        self._by_line = known if self._bare and self._split(
            "\n" + every) == [*self._split("\n"), word] else None
        # letters that stay as they are
        self._same = all(known[ord(c)] == c for c in letters if c.isascii())

    def _word(self, mark: str, letters: dict[int, str] | None):
        """Ids of ``mark`` and a piece; words of Latin letters go to the model
        at once, as ``letters`` has them."""
        if letters is None:
            return lambda piece: self._chunk(mark + piece)
        lead = self._lead if mark == " " else ""
        before = b"" if mark == " " else self._chunk(mark)
        tokenize, four, same = self._model.tokenize, self._four, self._same
        latin = _LATIN.fullmatch

        def word(piece: str) -> bytes:
            if same and piece.isascii() and piece.isalpha():
                return before + b"".join([
                    four[t.id] for t in tokenize(lead + piece)])
            if latin(piece):
                return before + b"".join([four[t.id] for t in tokenize(
                    lead + piece.translate(letters))])
            return self._chunk(mark + piece)
        return word

    def marks(self, letter: str, run: str) -> bytes | None:
        """Ids of marks behind a letter, if the pre-tokenizer cuts there."""
        if letter + run not in self._runs:
            if len(self._runs) >= _RUNS:
                self._runs.clear()
            self._runs[letter + run] = self._chunk(run) if self._split(
                letter + run) == self._split(letter) + self._split(run) \
                else None
        return self._runs[letter + run]

    def _chunk(self, chunk: str) -> bytes:
        tokenize = self._model.tokenize
        four = self._four
        return b"".join([four[t.id] for p in self._split(chunk)
                         for t in tokenize(p)])

    def _joined(self, pieces: list[str]) -> bytes | None:
        first, last = pieces[0], pieces[-1]
        if len(pieces) == 1:
            return self._chunk(first)
        if first and first[-1].isspace():
            return None
        after = self._after
        after.unsafe = False
        body = b"".join(map(after.__getitem__, pieces[1:-1]))
        if after.unsafe:
            return None
        # white space at the end of a text is cut in its own way
        body += self._chunk(" " + last) if not last or last[-1].isspace() \
            else after[last]
        return self._first(first) + body if first else body

    def word(self, word: str) -> bytes:
        """As :meth:`encode`, for one word and a space or line break before
        it."""
        if word[-1].isspace() or word[1] in " \n" or word[0] not in " \n":
            return self.encode(word)
        return (self._after if word[0] == " " else self._after.lines)[word[1:]]

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        out = self._joined(text.split(" "))
        return self._joined(_CUT.split(text)) if out is None else out


_ENCODERS: dict[tuple[str, int], Encoder] = worker_cache()


def encoder(path: str, keep: int = KEEP) -> Encoder:
    """One encoder per worker process and vocabulary file."""
    only(_ENCODERS)
    if (path, keep) not in _ENCODERS:
        _ENCODERS[path, keep] = Encoder(path, keep)
    return _ENCODERS[path, keep]
