"""Byte-level BPE in numpy: many words at once, one merge per word and round.

The words that a batch of texts holds and the task has not met yet form one flat array of symbols. Each round finds for
every word the pair of neighbours with the lowest rank, by binary search over the sorted keys of all mergeable pairs, and merges all
its occurrences from left to right; only pairs next to a merge are looked up anew. Words without mergeable pairs leave
the array. A word's ids are kept for the task, up to a bounded number of words.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from mailtax.llm.common import Batches, texts

# Fixed value: the published split of byte-level BPE, with white space as Unicode defines it.
SPLIT = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+"
    r"|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
)
NO_RANK = np.iinfo(np.int64).max
CACHED_WORDS = 200_000
CHARACTERS = 2_000_000


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, the rest from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def _latin_split() -> re.Pattern:
    """The same split for texts of Latin-1 characters alone, with their classes spelt out."""
    latin = [chr(i) for i in range(256)]
    letter = "".join(c for c in latin if unicodedata.category(c)[0] == "L")
    number = "".join(c for c in latin if unicodedata.category(c)[0] == "N")
    space = "\\t-\\r \x85\xa0"
    return re.compile(
        f" ?[{letter}]+|'(?:[stdm]|re|ve|ll)| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"
    )


class ByteBpe:
    """A byte-level BPE vocabulary, read from a tokenizer's JSON file on the machine that uses it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError("not a plain byte-level BPE tokenizer")
        if spec["pre_tokenizer"]["add_prefix_space"] or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip")):
            raise ValueError("prefix spaces and stripping special tokens are not supported")
        letters = _byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = {i: bytes(byte_of[c] for c in t) for t, i in vocab.items()}
        pieces |= {i: t.encode() for t, i in self.special.items()}
        ordered = [pieces.get(i, b"") for i in range(max(pieces) + 1)]
        self.length = np.array([len(p) for p in ordered], np.int64)
        self.begin = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(ordered), np.uint8)
        self.of_byte = np.array([vocab[c] for c in letters], np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in merges], np.int64)
        made = np.array([vocab[a + b] for a, b in merges], np.int64)
        born = np.full(len(ordered), -1)
        born[made] = np.arange(len(made))
        rank = np.arange(len(key))
        if (born[key >> 32] >= rank).any() or (born[key & 0xFFFFFFFF] >= rank).any():
            raise ValueError("a merge uses a symbol that is made later")  # merging all occurrences at once needs this
        order = np.argsort(key, kind="stable")
        self.key, self.rank, self.made = key[order], order, made
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.any_split, self.latin_split = regex.compile(SPLIT), _latin_split()
        alternatives = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({alternatives})") if self.special else None

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, pair), len(self.key) - 1)
        return np.where(self.key[at] == pair, self.rank[at], NO_RANK)

    def merge_words(self, words: list[bytes]) -> list[bytes]:
        """Ids of each (non-empty) word, as little-endian unsigned 32-bit integers."""
        if not words:
            return []
        done: list[tuple[np.ndarray, np.ndarray]] = []
        size = np.array([len(w) for w in words])
        word = np.repeat(np.arange(len(words)), size)
        symbol = self.of_byte[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full(len(symbol), NO_RANK)
        inner = word[1:] == word[:-1]
        rank[:-1][inner] = self._ranks(symbol[:-1][inner], symbol[1:][inner])
        while len(symbol):
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            lowest = np.minimum.reduceat(rank, first)
            size = np.diff(np.concatenate((first, [len(word)])))
            ended = lowest == NO_RANK
            if ended.any():
                live = np.repeat(~ended, size)
                done.append((word[~live], symbol[~live]))
                word, symbol, rank = word[live], symbol[live], rank[live]
                lowest, size = lowest[~ended], size[~ended]
                if not len(word):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, size))
            run = np.concatenate(([True], hit[1:] != hit[:-1] + 1))  # of overlapping occurrences every other one
            hit = hit[(hit - hit[run][np.cumsum(run) - 1]) % 2 == 0]
            symbol[hit] = self.made[rank[hit]]
            keep = np.ones(len(word), bool)
            keep[hit + 1] = False
            new = np.zeros(len(word), bool)
            new[hit] = True
            word, symbol, rank, new = word[keep], symbol[keep], rank[keep], new[keep]
            new[:-1] |= new[1:]
            at = np.flatnonzero(new)
            last = at + 1 >= len(word)
            rank[at[last]] = NO_RANK
            at = at[~last]
            joined = word[at] == word[at + 1]
            rank[at[~joined]] = NO_RANK
            at = at[joined]
            rank[at] = self._ranks(symbol[at], symbol[at + 1])
        word, symbol = (np.concatenate(x) for x in zip(*done))
        ids = symbol[np.argsort(word, kind="stable")].astype("<u4").tobytes()
        end = (4 * np.cumsum(np.bincount(word))).tolist()
        return [ids[b:e] for b, e in zip([0, *end], end)]

    def _parts(self, text: str) -> Iterator[tuple[bool, str]]:
        if self.cut is None or not any(t in text for t in self.special):
            yield False, text
            return
        for i, part in enumerate(self.cut.split(text)):
            if part:
                yield bool(i % 2), part

    def split(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any_split.findall(text)
        return self.latin_split.findall(text)

    def encode(self, many: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers."""
        split = [[(s, [p] if s else self.split(p)) for s, p in self._parts(t)] for t in many]
        if len(self.young) > CACHED_WORDS:  # words not met again since then are forgotten
            self.old, self.young = self.young, {}
        known, old = self.young, self.old
        met = set(chain.from_iterable(words for parts in split for s, words in parts if not s)).difference(known)
        again = met.intersection(old)
        known.update((w, old[w]) for w in again)
        unknown = list(met - again)
        known.update(zip(unknown, self.merge_words([w.encode() for w in unknown])))
        return [
            b"".join(
                np.array([self.special[words[0]]], "<u4").tobytes() if s else b"".join(map(known.__getitem__, words))
                for s, words in parts
            )
            for parts in split
        ]

    def decode(self, ids: bytes) -> bytes:
        """The bytes the ids stand for."""
        n = np.frombuffer(ids, "<u4")
        length = self.length[n]
        shift = np.repeat(self.begin[n] - (np.cumsum(length) - length), length)
        return self.bytes[shift + np.arange(len(shift))].tobytes()


def _slices(values: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that hold about CHARACTERS together, at least one text each."""
    at = held = 0
    for i, v in enumerate(values):
        held += len(v)
        if held >= CHARACTERS:
            yield at, i + 1
            at, held = i + 1, 0
    if at < len(values):
        yield at, len(values)


def encode(
    df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, n_tokens, ids`` (binary, little-endian unsigned 32-bit) and, if asked for,
    ``text``, which the ids decode to (invalid UTF-8 replaced).

    Special tokens in a text become their ids, as the tokenizer's own library does it. Null and empty texts have no ids.
    ``path`` names the tokenizer's file on every executor. Empty in, empty out.
    """
    rows = texts(df, id_col, text_col, key=False)

    def work(batches: Batches) -> Batches:
        bpe = ByteBpe(path)
        for batch in batches:
            many = batch.column("text").to_pylist()
            for begin, end in _slices(many):
                ids = bpe.encode(many[begin:end])
                columns = [batch.column("doc_id").slice(begin, end - begin), pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())]
                names = ["doc_id", "n_tokens", "ids"]
                if decoded:
                    columns.append(pa.array([bpe.decode(i).decode(errors="replace") for i in ids], pa.string()))
                    names.append("text")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, n_tokens bigint, ids binary" + ", text string" * decoded)


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` from ids as ``encode`` makes them; null ids give an empty text, unknown ids raise an error."""
    rows = df.select(df[id_col].alias("doc_id"), df[ids_col].alias("ids"))

    def work(batches: Batches) -> Batches:
        bpe = ByteBpe(path)
        for batch in batches:
            text = [bpe.decode(i or b"").decode(errors="replace") for i in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(work, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
