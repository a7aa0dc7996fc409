"""Normalisation and word splitting of a tokenizers-library file of the word-BPE kind.

Reads from the file what it needs (special tokens, vocabulary, merges, end-of-word mark) and
does the rest here. The library's tables of letters and digits are of
another Unicode version; up to U+04FF they agree (tested), and a text with any character
beyond is split by the library's own steps. Only this kind of file is accepted: NFC, white space
squeezed, lower case; letters, single digits and other runs split; no template.
"""

from __future__ import annotations

import json
import re
import unicodedata
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc

# The file's split pattern.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BEYOND = re.compile("[\u0500-\U0010FFFF]")


def _split_below_u0500() -> re.Pattern:
    """The split pattern with its classes spelled out for the characters before U+0500.

    Plain character sets are what the standard module matches fastest. No two branches
    start alike, apart from the apostrophe ones before the last, so words come first.
    """

    def ranges(wanted) -> str:
        hits = [c for c in range(0x500) if wanted(chr(c))]
        runs = [(x, y) for x, y in zip([c for c in hits if c - 1 not in hits], [c for c in hits if c + 1 not in hits])]
        return "".join(f"\\u{x:04x}-\\u{y:04x}" for x, y in runs)

    letters = ranges(lambda c: unicodedata.category(c)[0] == "L")
    numbers = ranges(lambda c: unicodedata.category(c)[0] == "N")
    blanks = r"\t-\r\x20\x85\xa0"
    return re.compile(f"[{letters}]+|[{numbers}]|'s|'t|'re|'ve|'m|'ll|'d|[^{letters}{numbers}{blanks}]+")


@dataclass(frozen=True)
class Tokens:
    vocabulary: dict[str, int]
    merges: list[tuple[str, str]]
    specials: dict[str, int]
    suffix: str


@lru_cache(maxsize=4)
def load(path: str) -> Tokens:
    with open(path, encoding="utf-8") as source:
        whole = json.load(source)
    model = whole["model"]
    kinds = [x["type"] for x in whole["normalizer"]["normalizers"]]
    split = whole["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    if split != SPLIT or kinds != ["NFC", "Replace", "Lowercase"] or model["type"] != "BPE" or whole["decoder"] or whole["post_processor"]:
        raise ValueError(f"{path} is not a word-BPE file of the known kind")
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    specials = {x["content"]: x["id"] for x in whole["added_tokens"]}
    if any(x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"] for x in whole["added_tokens"]):
        raise ValueError(f"{path} has special tokens with options")
    return Tokens(model["vocab"], merges, specials, model["end_of_word_suffix"] or "")


@lru_cache(maxsize=1)
def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Printable Latin-1 bytes stand for themselves, the others for code points from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in plain}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(plain)))
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def word_tokenizer(path: str, in_letters: bool = False):
    """The library's tokenizer for words as ``Splitter`` cuts them, normalised and set apart by blanks.

    Vocabulary, merges, bytes and special tokens are the file's; what the words have been through already,
    normalisation and the split pattern, is left out, and with ``in_letters`` the step from bytes to letters too.
    """
    from tokenizers import Tokenizer

    load(path)  # refuses files of another kind
    with open(path, encoding="utf-8") as source:
        whole = json.load(source)
    whole |= {"normalizer": None, "truncation": None, "padding": None}
    steps = whole["pre_tokenizer"]["pretokenizers"]
    steps[0] = {"type": "WhitespaceSplit"}
    if in_letters:
        del steps[1:]
    return Tokenizer.from_str(json.dumps(whole))


class Splitter:
    """Cuts texts into the words that merges work on; special tokens stay whole."""

    def __init__(self, path: str):
        tokens = load(path)
        self.path = path
        self.specials = tokens.specials
        split = _split_below_u0500()
        self.find = split.findall
        self.find_in_lines = re.compile(f"{split.pattern}|\n").findall
        marks = sorted(map(re.escape, tokens.specials), key=len, reverse=True)
        self.mark = re.compile("(" + "|".join(marks) + ")") if marks else None

    def normalise(self, text: str) -> str:
        if not text.isascii():
            # Letter by letter: no rule of lower case looks at neighbours, as str.lower does for sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def cut(self, text: str) -> list[str]:
        lowered = self.normalise(text)
        if lowered.isascii() or not BEYOND.search(lowered):
            return self.find(lowered)
        library, letters = _library(self.path), {x: b for b, x in enumerate(byte_letters())}
        pieces = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(letters[x] for x in piece).decode() for piece, _ in pieces]

    def words(self, text: str) -> list[str]:
        if self.mark is None or not any(s in text for s in self.specials):
            return self.cut(text)
        found: list[str] = []
        for piece in self.mark.split(text):
            if piece in self.specials:
                found.append(piece)
            elif piece:
                found += self.cut(piece)
        return found

    def spaced(self, text: str) -> str:
        """The normalised text, or its words set apart by blanks: ``pieces`` goes on from either, cut at ASCII blanks."""
        lowered = self.normalise(text)
        if self.odd(lowered) or any(s in text for s in self.specials):
            return " ".join(self.words(text))
        return lowered

    def odd(self, text: str) -> bool:
        return not text.isascii() and bool(BEYOND.search(text)) or any(s in text for s in self.specials)

    def pieces(self, joined: str) -> tuple[list[str], dict[int, str]]:
        """Words of the pieces of ``spaced`` texts, joined by line breaks, and the breaks; by piece, those that are words as they are.

        No word spans a blank. Pieces that are words already have "0" in the list.
        """
        whole: dict[int, str] = {}
        if self.odd(joined):
            every = joined.split("\n")
            whole = {i: p for i, p in enumerate(every) if self.odd(p)}
            joined = "\n".join(["0" if i in whole else p for i, p in enumerate(every)])
        return self.find_in_lines(joined), whole


class WordCache(dict):
    """Word number by word, with the ids of each word in one flat array.

    Texts are cut at blanks and the distinct pieces found by Arrow; only these are split into words.
    Unknown words are numbered on first sight and encoded together by ``encode``, which
    takes a list of words and returns flat ids and lengths. Past ``bound`` words the cache
    starts anew, so a worker's memory stays bounded.
    """

    def __init__(self, splitter: Splitter, encode, bound: int = 200_000):
        import numpy as np

        super().__init__()
        self.np, self.splitter, self.encode, self.bound = np, splitter, encode, bound
        self._reset()

    def _reset(self) -> None:
        self.clear()
        self["\n"] = 0  # sets pieces apart and has no ids
        self.pending: list[str] = []
        self.flat = self.np.empty(0, self.np.int32)
        self.starts = self.np.zeros(2, self.np.int64)

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        self.pending.append(word)
        return number

    def ids(self, texts: list[str]):
        """Flat ids of all texts and the number of ids of each."""
        np = self.np
        if len(self) > self.bound:
            self._reset()
        spaced = pa.array(list(map(self.splitter.spaced, texts)), pa.large_string())
        cut = pc.ascii_split_whitespace(spaced)
        coded = cut.values.dictionary_encode()
        pieces = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
        found, whole = self.splitter.pieces(pc.binary_join(pieces, pa.scalar("\n", pa.large_string()))[0].as_py())
        words = np.fromiter(map(self.__getitem__, found), np.int64, len(found))
        borders = np.r_[0, np.flatnonzero(words == 0), len(words)]
        for i, word in whole.items():
            words[borders[i + 1] - 1] = self[word]
        if self.pending:
            flat, lengths = self.encode(self.pending)
            self.pending = []
            self.flat = np.concatenate([self.flat, np.asarray(flat, np.int32)])
            ends = self.starts[-1] + np.cumsum(np.asarray(lengths, np.int64))
            self.starts = np.concatenate([self.starts, ends])
        flat, starts = self._gather(self.flat, self.starts, words)
        flat, starts = self._gather(flat, starts[borders], coded.indices.to_numpy())
        return flat, np.diff(starts[cut.offsets.to_numpy()])

    def _gather(self, flat, starts, chosen):
        """The chosen runs of ``flat`` end to end, and where each starts (and the last ends)."""
        np = self.np
        lengths = np.diff(starts)[chosen]
        ends = np.cumsum(lengths)
        places = np.repeat(starts[chosen] - (ends - lengths), lengths) + np.arange(int(ends[-1]) if len(ends) else 0)
        return flat[places], np.r_[0, ends]


def text_batches(batch, column: str = "text", most: int = 1 << 20):
    """Runs of rows of an Arrow batch with about ``most`` bytes of text: first row, texts (null: empty).

    A text over the bound is a run of its own; texts are never cut.
    """
    texts = batch.column(column)
    run: list[str] = []
    size = first = 0
    for i in range(len(texts)):
        text = texts[i].as_py() or ""
        if run and size + len(text) > most:
            yield first, run
            run, size, first = [], 0, i
        run.append(text)
        size += len(text)
    if run:
        yield first, run
