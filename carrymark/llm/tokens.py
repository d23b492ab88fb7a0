"""Token ids of whole texts, each distinct chunk encoded once per worker.

Tokenizers split text into words before they merge, and no word reaches over a
single space or line end between two other characters. So texts are cut there, the
chunks are encoded by the tokenizers library and remembered, and a text's ids are
its chunks' ids joined. Results are those of encoding the whole text.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator

import public_tokenizers
from tokenizers import Tokenizer

from carrymark.llm.common import held

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

#: Chunks that a worker remembers before it starts anew; bounds its memory.
REMEMBERED = 1_000_000

TWO_SPACES = re.compile(r"\s\s")
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")
#: ASCII marks that form one word of their own after a word of letters.
MARKS = ".,;:!?&%$*#|)(\"=+-"


def chunks(text: str) -> tuple[str, list[str]]:
    """The first chunk as it is, and the keys of those that follow.

    A key stands for a space and itself, or for itself if it begins with a line end.
    """
    if TWO_SPACES.search(text):
        first, *rest = SAFE_CUT.split(text)
        return first, [c if c[0] == "\n" else c[1:] for c in rest]
    first, *rest = text.replace("\n", " \n").split(" ")
    return first, rest


def chunk_text(key: str) -> str:
    return key if key[:1] == "\n" else " " + key


def letters_and_marks(key: str) -> str | None:
    """The leading letters of a chunk that is Latin letters and then marks, else None."""
    word = key.rstrip(MARKS)
    if word and len(word) < len(key) and word.isalpha() and max(word) < "ɐ":
        return word
    return None


def lowered(text: str) -> str:
    """A Latin-1 text in lower case, which the word tokenizer makes of it anyway; others
    as they are, since there normalisation and neighbours play a part."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return text
    return text.lower()


class Encoder:
    """Ids as little-endian unsigned 32-bit integers in bytes.

    ``spaces_matter``: whether the tokenizer keeps white space (byte-level) or drops
    it (words). Strings of special tokens in a text are ordinary text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.spaces_matter = bool(self._plain([" a"])[0] != self._plain(["a"])[0])
        self.after_space: dict[str, bytes] = {}
        self.alone: dict[str, bytes] = {"": b""}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _learn(self, known: dict[str, bytes], keys: Iterable[str], text_of) -> None:
        missing = set(keys).difference(known)
        if not missing:
            return
        split = {k: word for k in missing if k[-1:] in MARKS and (word := letters_and_marks(k))}
        plain = missing.difference(split)
        plain.update(w for w in split.values() if w not in known)
        known.update(zip(plain, self._plain(list(map(text_of, plain))), strict=True))
        marks = [m for m in {k[len(word):] for k, word in split.items()} if m not in self.alone]
        self.alone.update(zip(marks, self._plain(marks), strict=True))
        for key, word in split.items():
            known[key] = known[word] + self.alone[key[len(word):]]

    def _parts(self, text: str) -> tuple[str, list[str]]:
        if self.spaces_matter:
            return chunks(text)
        return "", lowered(text).replace("\n", " ").split(" ")

    def _prepare(self, parts: Iterable[tuple[str, list[str]]]) -> None:
        """Learn the chunks of several texts in one call of the library."""
        if len(self.after_space) + len(self.alone) > REMEMBERED:
            self.after_space, self.alone = {}, {"": b""}
        firsts, keys = set(), set()
        for first, rest in parts:
            firsts.add(first)
            keys.update(rest)
        self._learn(self.alone, firsts if self.spaces_matter else keys, str)
        if self.spaces_matter:
            self._learn(self.after_space, keys, chunk_text)

    def _joined(self, first: str, keys: list[str]) -> bytes:
        known = self.after_space if self.spaces_matter else self.alone
        return self.alone[first] + b"".join(map(known.__getitem__, keys))

    def encode(self, text: str | None) -> bytes:
        """The ids of a whole text; none for null and empty texts."""
        return next(self.encode_all([text]))

    def encode_all(self, texts: Iterable[str | None], size: int = 1 << 12) -> Iterator[bytes]:
        """The ids of each text, in blocks of texts of about ``size`` characters.

        A block's texts are cut into chunks once, which are then learned and looked up.
        Blocks are small, so that its chunks are still in the processor's cache by then.
        """
        nothing = ("", [])
        block, held = [], 0
        for text in texts:
            block.append(self._parts(text) if text else nothing)
            held += len(text or "")
            if held > size:
                self._prepare(block)
                yield from (self._joined(*parts) for parts in block)
                block, held = [], 0
        self._prepare(block)
        yield from (self._joined(*parts) for parts in block)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file; kept for the worker's later tasks."""
    return held("encoders", path, lambda: Encoder(path))
