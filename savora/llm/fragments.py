"""Token ids of text fragments, remembered in each Python worker."""

from __future__ import annotations

import os
import re
from itertools import chain, islice

import numpy as np

from savora.llm.text import remembered

# Letters of Latin-1 (they have no other composed form), digits, and visible ASCII characters but apostrophes.
LETTERS, DIGITS, MARKS = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9", r"!-&(-/:-@\[-`{-~"
AT_ONCE = 10_000  # fragments handed to the library in one call, as its results are large


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write bytes as characters: printable ones as they are, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = sorted(set(range(256)) - set(plain))
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class FragmentIds:
    """Ids of fragments as the tokenizers library gives them, packed as numbers of ``kind``.

    Fragments that were seen before are looked up. A new one that is nothing but ``pieces``, between which the
    tokenizer cuts in any case, is put together from theirs; what is new then is encoded, many at once.
    Everything is forgotten once ``limit`` fragments are held; long ones are never held.
    """

    def __init__(
        self, path: str, kind: str, pieces: str, fold: bool, plain: str = "", limit: int = 400_000, longest: int = 48
    ):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added) or "(?!)")
        self.char = {b: c for c, b in byte_of_char().items()}
        self.pieces, self.fold = re.compile(pieces), fold
        self.odd = re.compile(f"[^{plain}]") if plain else re.compile("")
        self.kind, self.limit, self.longest = kind, limit, longest
        self.known: dict[bytes, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}

    def __call__(self, fragments: list[bytes]) -> list[bytes]:
        distinct = set(fragments)
        fresh = distinct.difference(self.known)
        if fresh:
            made = self._composed(fresh)
            if len(self.known) + len(made) > self.limit:
                self.known = {f: self.known[f] for f in distinct.difference(fresh)}
            self.known.update(made)
        found = list(map(self.known.__getitem__, fragments))
        for f in fresh:
            if len(f) > self.longest:
                del self.known[f]
        return found

    def of_texts(self, texts: list[str]) -> list[bytes]:
        """Ids of texts whose white space the tokenizer drops.

        A text of ``plain`` characters alone is cut into pieces as a whole, any other into runs between white
        space first, of which no token spans two.
        """
        plain = [not self.odd.search(t) and not self.added.search(t) for t in texts]
        cuts = [self.pieces.findall(t.lower() if self.fold else t) for t, p in zip(texts, plain, strict=True) if p]
        made = iter(self._joined(cuts))
        runs = [[] if p else t.encode().split() for t, p in zip(texts, plain, strict=True)]
        ids = iter(self(list(chain.from_iterable(runs))))
        return [next(made) if p else b"".join(islice(ids, len(r))) for p, r in zip(plain, runs, strict=True)]

    def _joined(self, cuts: list[list[str]]) -> list[bytes]:
        """Ids of texts that are cut into pieces."""
        distinct = set().union(*cuts)
        new = distinct.difference(self.known_pieces)
        if len(self.known_pieces) + len(new) > self.limit:
            self.known_pieces = {p: self.known_pieces[p] for p in distinct.difference(new)}
        self.known_pieces.update(self._merged(new))
        of = self.known_pieces.__getitem__
        made = [b"".join(map(of, cut)) for cut in cuts]
        for p in new:
            if len(p) > self.longest:
                del self.known_pieces[p]
        return made

    def _composed(self, fragments: set[bytes]) -> dict[bytes, bytes]:
        parts: dict[bytes, list[str]] = {}
        whole: list[bytes] = []
        findall, has_added, fold = self.pieces.findall, self.added.search, self.fold
        for f in fragments:
            text = f.decode()
            cut = findall(text)
            if "".join(cut) != text or has_added(text):
                whole.append(f)
            else:
                parts[f] = [p.lower() for p in cut] if fold else cut
        made = dict(zip(parts, self._joined(list(parts.values())), strict=True))
        made.update(self._encoded(whole))
        return made

    def _merged(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids from the library's merges alone; pieces need no normalising and are cut no further."""
        char, tokenize = self.char, self.tokenizer.model.tokenize
        ids = [[t.id for t in tokenize("".join([char[b] for b in p.encode()]))] for p in pieces]
        return dict(zip(pieces, self._packed(ids), strict=True))

    def _encoded(self, fragments: list[bytes]) -> dict[bytes, bytes]:
        out: dict[bytes, bytes] = {}
        for at in range(0, len(fragments), AT_ONCE):
            part = fragments[at : at + AT_ONCE]
            made = self.tokenizer.encode_batch_fast([f.decode() for f in part], add_special_tokens=False)
            out.update(zip(part, self._packed([e.ids for e in made]), strict=True))
        return out

    def _packed(self, ids: list[list[int]]) -> list[bytes]:
        size = np.dtype(self.kind).itemsize
        ends = (np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids))) * size).tolist()
        packed = np.fromiter(chain.from_iterable(ids), self.kind).tobytes()
        return [packed[a:b] for a, b in zip([0, *ends], ends)]


# Pieces, whether case is dropped, and the characters of plain texts.
WORD_PIECES = (f"[{LETTERS}]+|[{DIGITS}]|[{MARKS}]+", True, f"{LETTERS}{DIGITS}{MARKS} \\t-\\r")


@remembered("records", 2)
def word_ids(path: str, kind: str) -> FragmentIds:
    """For tokenizers that drop white space and case and split into letters, single digits and the rest."""
    return FragmentIds(path, kind, *WORD_PIECES)
