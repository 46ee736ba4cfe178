"""Token ids of whole texts with a public tokenizer file, word by word where that is exact."""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tidemark.llm.words import text_bytes

#: Words that a Python worker remembers; later ones are encoded each time they occur.
CACHED_WORDS = 500_000
#: Fixed value: the splitting rule of the word-level vocabulary, under which no token crosses
#: white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([-.,;:!?#$%&*()\"/]*)")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _splits_at_white_space(config: dict) -> bool:
    """True if the normaliser and the splitter are those for which words can go alone."""
    steps = (config.get("normalizer") or {}).get("normalizers", [])
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and (steps[1]["pattern"], steps[1]["content"]) == ({"Regex": r"\s+"}, " ")
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and (splits[0]["pattern"], splits[0]["invert"]) == ({"Regex": WORD_PATTERN}, True)
        and not splits[1]["add_prefix_space"]
    )


def _byte_symbols() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return [chr(b) if b in set(visible) else chr(256 + hidden.index(b)) for b in range(256)]


class Encoder(dict):
    """Maps a word's bytes to its ids, packed; unknown words are encoded on first sight."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.by_word = _splits_at_white_space(json.loads(self.tokenizer.to_str()))
        self.type = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.symbols = _byte_symbols()
        self.model = self.tokenizer.model

    def _piece(self, text: str) -> list[int]:
        """Ids of one run of letters or of signs, by the vocabulary's own merges."""
        return [t.id for t in self.model.tokenize("".join(self.symbols[b] for b in text.encode()))]

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if plain:
            letters, signs = plain.groups()
            ids = (self._piece(letters.lower()) if letters else []) + (
                self._piece(signs) if signs else []
            )
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        packed = np.array(ids, self.type).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = packed
        return packed

    def encode(self, text: bytes) -> np.ndarray:
        """Ids of a whole text, without special tokens added."""
        if self.by_word:
            return np.frombuffer(b"".join(map(self.__getitem__, text.split())), self.type)
        return np.array(self.tokenizer.encode(text.decode(), add_special_tokens=False).ids, self.type)


@functools.cache
def encoder(path: str) -> Encoder:
    """The encoder of a Python worker; it lives as long as the worker."""
    return Encoder(path)


def encoded(texts: pa.Array, path: str) -> Iterator[np.ndarray]:
    """Ids of each text of a column; null is empty."""
    encode = encoder(path).encode
    offsets, data = text_bytes(texts)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield encode(data[a:b].tobytes())
