"""Ids of whole texts as the tokenizers library gives them, memoised by pre-token."""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Callable

import numpy as np

from contractlens.llm.bpe import TextIds
from contractlens.llm.common import per_worker


#: Entries kept per generation of a worker's memo.
WORDS = 800_000
#: Texts of these characters split alike by every version of the Unicode tables.
SETTLED = re.compile(r"[\x00-\u024f]*").fullmatch


def byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it is
    printable in Latin-1, else the next free one from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class LibraryIds(TextIds):
    """Ids of texts by a byte-level vocabulary in the library's JSON form.

    The ids of a text are those of its pre-tokens, and a pre-token goes through the
    library's model once while it is remembered. A piece of text with characters that the
    library's tables and ours might see differently goes through the whole library, and
    so do texts that hold the string of an added token, such as <|endoftext|>, which the
    library gives that token's id, and all texts if the vocabulary is not plainly
    byte-level.
    """

    def __init__(self, vocabulary: str, words: int = WORDS):
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        super().__init__(self._word, regex.compile(public_tokenizers.PATTERN).findall, words)
        self.tokenizer = Tokenizer.from_str(vocabulary)
        # ids of two bytes where the vocabulary allows
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.model, self.alphabet = self.tokenizer.model, byte_alphabet()
        described = json.loads(vocabulary)
        self.added = [token["content"] for token in described.get("added_tokens") or [] if token["content"]]
        split = described.get("pre_tokenizer") or {}
        self.plain = described.get("normalizer") is None and (
            split.get("type"), split.get("add_prefix_space"), split.get("use_regex")
        ) == ("ByteLevel", False, True)

    def _whole(self, piece: str) -> bytes:
        return array(self.kind, self.tokenizer.encode(piece, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.alphabet)
        return array(self.kind, [token.id for token in self.model.tokenize(letters)]).tobytes()

    def split(self, text: str) -> bytes:
        return super().split(text) if text.isascii() or SETTLED(text) else self._whole(text)

    def _after_space(self, piece: str) -> bytes:
        settled = piece.isascii() or SETTLED(piece)
        return super()._after_space(piece) if settled else self._whole(" " + piece)

    def encode(self, text: str) -> bytes:
        by_piece = self.plain and not any(map(text.__contains__, self.added))
        return super().encode(text) if by_piece else self._whole(text)


def text_encoder(name: str, vocabulary: str, words: int = WORDS) -> Callable[[str], np.ndarray]:
    """Ids of a text, of two or four bytes each, by a vocabulary that is loaded once per
    worker; `name` tells vocabularies apart, `words` bounds the worker's memo."""
    found = per_worker("library_ids", (name, words), lambda: LibraryIds(vocabulary, words))
    kind = "<u2" if found.kind == "H" else "<u4"
    return lambda text: np.frombuffer(found.encode(text), kind)
