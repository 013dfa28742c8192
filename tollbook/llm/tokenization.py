"""Ids and token counts of whole texts by public tokenizers, each distinct word merged once.

A text is cut at spaces that stand between two characters that are no white space. Such a space
always starts a new pre-token, so the parts' ids, joined, are the ids of the whole text. Texts that
hold other spaces or a special token are given to the library whole.
"""

from __future__ import annotations

import codecs
import os
from array import array
from operator import attrgetter

import numpy as np

from tollbook.llm.parts import Memory, put_together

#: Words that a counter remembers; beyond, the memory starts anew.
WORDS = 600_000

#: Marks that may end a word and are a pre-token of their own there.
MARKS = ",.;:!?#$%&*|"

#: The characters that byte-level vocabularies write for bytes: most stand for themselves; the others stand at 256 and on, in order.
_PLAIN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHIFTED = {b: 256 + i for i, b in enumerate(x for x in range(256) if x not in _PLAIN)}
_SYMBOLS = "".join(chr(_SHIFTED.get(b, b)) for b in range(256))

_id = attrgetter("id")

_loaded: dict[str, object] = {}


class ByteEncoder:
    """Texts to ids, as little-endian unsigned 32-bit integers, as `tokenizers` gives them without added tokens."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.merge = self.library.model.tokenize
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.line_end = self.merged("\n")
        #: Ids of words that follow a space, by the word; of those that do not, and of marks, by a space and the word.
        self.known = Memory()

    def merged(self, pretoken: str) -> bytes:
        """A single pre-token, merged by the library's model without cutting it first."""
        symbols = codecs.charmap_decode(pretoken.encode(), "strict", _SYMBOLS)[0]
        return array("I", map(_id, self.merge(symbols))).tobytes()

    def one(self, key: str) -> bytes:
        """A single pre-token, remembered."""
        ids = self.known.get(key)
        if ids is None:
            ids = self.known.new[key] = self.merged(key[1:] if key[0] == " " else " " + key)
        return ids

    def word(self, part: str) -> bytes | None:
        """Letters, then marks other than apostrophes, are two pre-tokens; a line end between letters or marks and
        letters is one. None if the part is anything else."""
        if "\n" in part:
            left, _, right = part.partition("\n")
            first, last = self.word(left), self.word(" " + right)
            return None if first is None or last is None else first + self.line_end + last
        letters = part.rstrip(MARKS)
        if not letters.removeprefix(" ").isalpha():
            return None
        return self.one(letters) + self.one(" " + part[len(letters) :]) if len(letters) < len(part) else self.one(letters)

    def whole(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 2000):
            found = self.library.encode_batch_fast(texts[i : i + 2000], add_special_tokens=False)
            out += [np.array(x.ids, "<u4").tobytes() for x in found]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        apart = [not any(x in text for x in self.special) for text in texts]
        found = iter(put_together([text for text, own in zip(texts, apart) if own], self.ids, mark_first=True))
        out = [next(found) if own else None for own in apart]
        rest = iter(self.whole([text for text, own in zip(texts, out) if own is None]))
        return [next(rest) if own is None else own for own in out]

    def ids(self, words: list[str]) -> list[bytes | None]:
        """The ids of words as `put_together` gives them; None for those that do not stand for themselves."""
        return self.known.values(words, self.learn)

    def learn(self, words: list[str]) -> list[bytes | None]:
        """The ids of words that are not known; None for those that do not stand for themselves."""
        out, hard = [], []
        for w in words:
            letters = w.rstrip(MARKS)
            if letters.isalpha():  # the usual word, with a space before it
                out.append(self.merged(" " + w) if len(letters) == len(w) else self.one(letters) + self.one(" " + w[len(letters) :]))
            elif not w.strip() or w[-1].isspace() or w.removeprefix(" ")[0].isspace():
                out.append(None)
            else:
                ids = self.word(w)
                if ids is None:
                    hard.append(len(out))
                out.append(ids)
        for i, ids in zip(hard, self.whole([w[1:] if (w := words[i])[0] == " " else " " + w for i in hard])):
            out[i] = ids
        return out


def byte_encoder(path: str) -> ByteEncoder:
    """One encoder per worker and file."""
    if path not in _loaded:
        _loaded[path] = ByteEncoder(path)
    return _loaded[path]


class PieceCounter:
    """Token counts as `sentencepiece` gives them; words proven to be one token are not merged at all."""

    def __init__(self, path: str, single: frozenset[str]):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.single = dict.fromkeys(single, 1)
        self.apart = words_stand_apart(self.library)
        self.known = dict(self.single)

    def whole(self, texts: list[str]) -> list[int]:
        return [len(x) for x in self.library.encode(texts, num_threads=1)] if texts else []

    def count(self, texts: list[str]) -> list[int]:
        parts: list[list[str] | None] = []
        met: set[str] = set()
        for text in texts:
            words = text.split(" ") if self.apart and text and "▁" not in text else None
            if words is not None:
                met.update(words)
            parts.append(words)
        if len(self.known) > WORDS + len(self.single):
            self.known = dict(self.single)
        new = [w for w in met.difference(self.known) if w]
        self.known.update(zip(new, self.whole(new)))
        if "" in met:  # spaces in a row, or at an end
            parts = [None if words is None or "" in words else words for words in parts]
        rest = iter(self.whole([t for t, words in zip(texts, parts) if words is None]))
        of = self.known.__getitem__
        return [next(rest) if words is None else sum(map(of, words)) for words in parts]


def words_stand_apart(library) -> bool:
    """Whether no piece goes on past a word's start and the text is only given a space in front.

    Then no merge joins two words, and a word's count does not depend on its neighbours.
    """
    pieces = (library.id_to_piece(i) for i in range(library.get_piece_size()))
    inside = any("▁" in p.lstrip("▁") for p in pieces)
    plain = library.encode("a  ﬁ", out_type=str)
    return not inside and plain[0].startswith("▁a") and plain[1:] == library.encode(" ﬁ", out_type=str)


def single_words(path: str) -> frozenset[str]:
    """Vocabulary strings that, alone as a word, encode as exactly one token (bounded by the vocabulary)."""
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [library.id_to_piece(i) for i in range(library.get_piece_size())]
    words = [p[1:] for p in pieces if p.startswith("▁") and len(p) > 1 and "▁" not in p[1:]]
    return frozenset(w for w, ids in zip(words, library.encode(words, num_threads=1)) if len(ids) == 1)


def piece_counter(path: str, single: frozenset[str]) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(path, single)
    return _loaded[path]
