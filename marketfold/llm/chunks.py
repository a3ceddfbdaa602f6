"""Pieces of text that a tokenizer treats independently, and a bounded memory of their ids."""

from __future__ import annotations

import functools
import re
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import regex
from tokenizers import Tokenizer

# The characters with the White_Space property, as inside a character class.
WHITE = "\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# Entries a worker remembers before it starts anew, some 200 bytes each.
REMEMBERED = 800_000

# What the word tokenizer keeps of a normalized text.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\p{White_Space}\p{L}\p{N}]+", regex.V1
)

# A run without white space, with the one blank before it; a blank run leaves its last character to
# what follows. No match of the byte-level pre-tokenizer reaches over such a boundary, and none looks
# behind it.
SPACED = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
UNSPACED = re.compile(f"[^{WHITE}]+")
# Python's split() also cuts at these, which are no white space to the tokenizers.
CONTROL = re.compile("[\x1c-\x1f]")


@functools.cache
def tokenizer(path: str) -> Tokenizer:
    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class Remembered(dict):
    """A dict that computes what it lacks and forgets what it has not needed for long.

    Once half of ``limit`` is reached, its entries become the older half; those that are asked for
    again come back, the others go with the next change.
    """

    def __init__(self, compute: Callable, limit: int = REMEMBERED):
        super().__init__()
        self.compute, self.half, self.older = compute, limit // 2, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
            if len(key) > 64:
                return value
        if len(self) >= self.half:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


@functools.cache
def chunk_ids(path: str) -> Remembered:
    """Little-endian unsigned 32-bit ids of a chunk, as the library gives them."""
    encode = tokenizer(path).encode
    return Remembered(
        lambda chunk: np.array(encode(chunk, add_special_tokens=False).ids, "<u4").tobytes()
    )


def normalize(chunk: str) -> str:
    """Composed and in lower case, letter by letter: no final form for a sigma at the end."""
    return unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()


# A stop right after another sign is one word with it.
SIGNS_BEFORE_STOP = re.compile(r"[.,](?<=[^\w\s].)|[.,](?<=_.)")


def pieces(text: str, specials: re.Pattern | None) -> list[str]:
    """Runs without white space, those of most texts in lower case and without their stops.

    Taken apart by :func:`pre_tokens`, they give the words of the text. That a stop stands apart and
    capitals are gone only means that fewer of them are new.
    """
    if CONTROL.search(text):
        return UNSPACED.findall(text)
    if specials is not None and "<|" in text:
        return text.split()
    normal = normalize(text)
    if SIGNS_BEFORE_STOP.search(normal):
        return text.split()
    return normal.replace(". ", " . ").replace(", ", " , ").replace(".\n", " . ").split()


def pre_tokens(chunk: str) -> list[str]:
    """The words of a run without white space, as the word tokenizer splits it.

    Letters alone, or letters and one stop, are most of a text and need no pattern.
    """
    chunk = normalize(chunk)
    if chunk.isalpha():
        return [chunk]
    if chunk[-1] in ".,;:!?" and chunk[:-1].isalpha():
        return [chunk[:-1], chunk[-1]]
    return WORD.findall(chunk)


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


@functools.cache
def special_strings(path: str) -> re.Pattern | None:
    """The special strings, longest first; splitting by the pattern keeps them at odd places.

    All of them begin with ``<|``.
    """
    added = [t.content for t in tokenizer(path).get_added_tokens_decoder().values()]
    longest = sorted(added, key=len, reverse=True)
    if not all(each.startswith("<|") for each in longest):
        raise ValueError("special strings are expected to begin with '<|'")
    return re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None


@functools.cache
def word_chunk_ids(path: str) -> Remembered:
    """As :func:`chunk_ids` for the word tokenizer, which gives each new word to its BPE once."""
    model = tokenizer(path).model
    letters = str.maketrans({chr(b): letter for b, letter in byte_letters().items()})
    specials = special_strings(path)

    def of_word(word: str) -> bytes:
        mapped = word if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(letters)
        return array("I", [token.id for token in model.tokenize(mapped)]).tobytes()

    known = Remembered(of_word)

    def of_chunk(chunk: str) -> bytes:
        if specials is None or "<|" not in chunk:
            found = pre_tokens(chunk)
            return of_word(found[0]) if len(found) == 1 else b"".join(map(known.__getitem__, found))
        return b"".join(
            array("I", [tokenizer(path).token_to_id(part)]).tobytes()
            if i % 2
            else b"".join(map(known.__getitem__, pre_tokens(part) if part else []))
            for i, part in enumerate(specials.split(chunk))
        )

    return Remembered(of_chunk)
