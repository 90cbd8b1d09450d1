"""Token counts with a whole-token shortcut.

Offline, once per process, every string of the vocabulary is encoded alone; those that come
back as the single token they are, are whole tokens. A text is cut into pre-tokens across
which no merge can reach, pre-tokens that are whole tokens count one without any merging,
and only the rest goes through the library (once per distinct pre-token while remembered).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from timepoint.llm.common import arrow_map

LIMIT = 4096
_REMEMBERED = 200_000
_MARK = "▁"


class PieceCounter:
    """Counts the tokens of a sentencepiece model whose pieces are cut at spaces.

    Cut rule: before every run of spaces and before every newline; the mark that stands for a
    space is the same to the model. A merge across a cut would need a piece with a mark after another
    character, or with a newline in it; ``__init__`` proves that the vocabulary has none, or
    else every text goes through the library whole.
    """

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=path)
        model = self._model
        pieces = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        ordinary = {
            p: i
            for i, p in enumerate(pieces)
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i))
        }
        self._cut = (
            not any(_MARK in p.lstrip(_MARK) or "\n" in p for p in ordinary)
            # the normaliser adds one mark in front, keeps runs of spaces and maps nothing
            and model.encode("a  a", out_type=str)[:1] == [_MARK + "a"]
            and "".join(model.encode(" a  a ", out_type=str)) == f"{_MARK * 2}a{_MARK * 2}a{_MARK}"
            and len(model.encode("\n")) == len(model.encode("")) + 2
        )
        self._pre = re.compile("[ ]+[^ \n]*|\n[^ \n]*")
        self.whole: dict[str, int] = {}
        for piece, i in ordinary.items():
            if piece.startswith(_MARK):
                text = piece.replace(_MARK, " ")
                if model.encode(text[1:]) == [i]:
                    self.whole[text] = 1
        if _MARK in ordinary:  # a space with nothing after it
            self.whole[" "] = 1
        self._known = dict(self.whole)

    def _merged(self, token: str) -> int:
        if token[0] == "\n":  # the mark put in front stays a token of its own
            n = len(self._model.encode(token)) - 1
        else:  # the mark put in front is the first space
            n = len(self._model.encode(token[1:]))
        if len(self._known) >= _REMEMBERED:
            self._known = dict(self.whole)
        if len(token) < 200:
            self._known[token] = n
        return n

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self._cut:
            return len(self._model.encode(text))
        total, known = 0, self._known
        for token in self._pre.findall(" " + text.replace(_MARK, " ")):
            n = known.get(token)
            if n is None:
                n = self._merged(token)
                known = self._known
            total += n
        return total


_COUNTERS: dict[str, PieceCounter] = {}


def counter(path: str) -> PieceCounter:
    """The counter for a vocabulary file, made once per process."""
    if path not in _COUNTERS:
        _COUNTERS[path] = PieceCounter(path)
    return _COUNTERS[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_tokens and whether they exceed ``limit``.

    NULL and empty texts have no bytes and no tokens. Rows are independent: repeated rows
    are counted each, other columns are ignored, nothing is shuffled.
    """

    def work(batches: Iterator[dict[str, list]]) -> Iterator[dict[str, list]]:
        count = counter(path).count
        for batch in batches:
            texts = [text or "" for text in batch["text"]]
            yield {
                "doc_id": batch["doc_id"],
                "n_bytes": [len(text.encode()) for text in texts],
                "n_tokens": [count(text) for text in texts],
            }

    slim = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    counted = arrow_map(slim, f"doc_id {kind}, n_bytes bigint, n_tokens bigint", work)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
