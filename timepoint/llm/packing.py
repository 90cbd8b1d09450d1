"""Packing tokenised documents into sequences: bounded-space online best fit.

Every task packs the pieces of its own partition as they come. It keeps a fixed number of
sequences open, in a bitset keyed by free space: bit f is set while some open sequence has f
places left, so the tightest one that takes a piece is the lowest set bit from its length
on. When a new sequence has to be opened beyond the bound, the fullest closes first. No rows
meet, so a packing needs no shuffle, and its memory is the open sequences.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import arrow_map

SEQUENCE, OPEN, END = 2048, 1024, 0
#: Parts in each of the two halves of a task's memory, and texts encoded together.
_REMEMBERED, _TOGETHER = 250_000, 100


class BestFit:
    """Open sequences by free space; ``place`` returns (sequence number, offset)."""

    def __init__(self, size: int, most_open: int) -> None:
        if most_open < 1:
            raise ValueError("at least one sequence must be open")
        self._size, self._most = size, most_open
        self._bits, self._open, self._next = 0, 0, 0
        self._free: list[list[int]] = [[] for _ in range(size + 1)]

    def _take(self, free: int) -> int:
        sequence = self._free[free].pop()
        if not self._free[free]:
            self._bits ^= 1 << free
        self._open -= 1
        return sequence

    def place(self, length: int) -> tuple[int, int]:
        fitting = self._bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            sequence = self._take(free)
        else:
            if self._open >= self._most:  # the fullest closes
                self._take((self._bits & -self._bits).bit_length() - 1)
            sequence, free = self._next, self._size
            self._next += 1
        if left := free - length:
            self._free[left].append(sequence)
            self._bits |= 1 << left
            self._open += 1
        return sequence, self._size - free


class WordIds:
    """Ids of a whole text from a ``tokenizers`` file, as little-endian unsigned 32 bits.

    The text is cut at spaces and newlines; where white space is dropped by the tokenizer
    and separates pre-tokens, the parts encode independently, so frequent parts are encoded
    once. So are letters and the punctuation behind them, which are pre-tokens of their own,
    in lower case. That is checked on the file's own settings; others encode whole texts.
    """

    def __init__(self, path: str) -> None:
        import json

        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._model = self._tokenizer.model
        settings = json.loads(self._tokenizer.to_str())
        splits = (settings["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        first = splits[0]
        self._cut = (
            first.get("type") == "Split"
            and first.get("behavior") == "Removed"
            and bool(first.get("invert"))
            and self._encode(" ") == b""
            and self._encode("a b\nc") == self._encode("a") + self._encode("b") + self._encode("c")
            and self._encode("Ab") == self._encode("ab")
            and all(self._encode(x) == self._merged(x) for x in ("letters", "éñß", "日本語", "ωმ"))
            and self._encode("ab#,.") == self._encode("ab") + self._encode("#,.")
            and not any(
                x["single_word"] or x["lstrip"] or x["rstrip"] or " " in x["content"]
                for x in settings["added_tokens"]
            )
        )
        self._known: dict[str, bytes] = {"": b""}
        self._older: dict[str, bytes] = {}

    def _merged(self, letters: str) -> bytes:
        # ASCII letters stand for themselves
        units = letters if letters.isascii() else letters.encode().decode("latin-1").translate(_BYTE_UNITS)
        return array("I", [token.id for token in self._model.tokenize(units)]).tobytes()

    def _encode(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def of(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; parts not met before are encoded together."""
        if not self._cut:
            return list(map(self._encode, texts))
        if len(self._known) >= _REMEMBERED:  # parts that go on being met move to the next half
            self._older, self._known = self._known, {"": b""}
        known, older = self._known, self._older
        parts = [_lowered(text).replace("\n", " ").split(" ") for text in texts]
        new = set().union(*parts).difference(known)
        again = [part for part in new if part in older]  # not by way of all that is older
        known.update((part, older[part]) for part in again)
        new.difference_update(again)
        tails = {
            part: m.groups()
            for part in new
            if not part.isalpha() and (m := _TAIL.fullmatch(part)) and m[1].lower().isalpha()
        }
        plain = list(
            new.difference(tails).union(x for pair in tails.values() for x in pair).difference(known)
        )
        rest = []
        for part in plain:
            # lower-case letters are one pre-token, as they are: straight to the merges
            if part.isalpha() and part == part.lower() and (
                part.isascii() or unicodedata.is_normalized("NFC", part)
            ):
                known[part] = self._merged(part)
            else:
                rest.append(part)
        for at in range(0, len(rest), 1000):
            some = rest[at : at + 1000]
            found = self._tokenizer.encode_batch_fast(some, add_special_tokens=False)
            known.update(
                zip(some, (np.array(x.ids, "<u4").tobytes() for x in found), strict=True)
            )
        known.update((part, known[a] + known[b]) for part, (a, b) in tails.items())
        return [b"".join(map(known.__getitem__, own)) for own in parts]


def _lowered(text: str) -> str:
    """Lower case where that commutes with the tokenizer's own normalisation."""
    plain = text.isascii() or (
        not _ODD.search(text) and unicodedata.is_normalized("NFC", text)
    )
    return text.lower() if plain and "<|" not in text else text


#: Fixed by byte-level tokenizers: printable Latin-1 bytes stand for themselves, the others are
#: numbered from 256 on.
_BYTE_UNITS = {
    byte: 256 + number
    for number, byte in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])
}
#: Characters whose lower case depends on their place or is more than one.
_ODD = re.compile("[\u03a3\u0130]")
#: Letters and then ASCII punctuation other than apostrophes and the start of special strings.
_TAIL = re.compile(r"([^!-/:-@\[-`{-~]+)([!-&(-/:;=-@\[-`{-~]+)")


def pack(
    docs: DataFrame, path: str, size: int = SEQUENCE, most_open: int = OPEN, end: int = END
) -> DataFrame:
    """Pieces of every row of ``docs`` and their places in sequences of ``size`` tokens.

    A document is its ids and then ``end``; only documents longer than ``size`` are cut. NULL
    and empty texts are the end token alone; a repeated row is packed again. Other columns
    are ignored. Sequence numbers carry the task's partition, so they never meet; a task
    that runs again reads the same rows in the same order and gives the same places.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        tokens = WordIds(path)  # of the task: what it remembers goes with it
        base = TaskContext.get().partitionId() << 40
        bins = BestFit(size, most_open)
        last = end.to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            texts = [text or "" for text in batch["text"]]
            ids_of = (
                x
                for at in range(0, len(texts), _TOGETHER)
                for x in tokens.of(texts[at : at + _TOGETHER])
            )
            for doc, ids in zip(batch["doc_id"], ids_of, strict=True):
                ids += last
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    length = len(part) // 4
                    sequence, offset = bins.place(length)
                    crc = zlib.crc32(part)
                    rows.append((doc, piece, at // 4, length, crc, base + sequence, offset))
            columns = list(zip(*rows, strict=True)) or [[]] * len(_COLUMNS)
            yield dict(zip(_COLUMNS, columns, strict=True))

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, " + ", ".join(f"`{c}` bigint" for c in _COLUMNS[2:])
    return arrow_map(slim, schema, work)


_COLUMNS = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
