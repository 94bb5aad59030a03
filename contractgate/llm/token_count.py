"""Token counts: pieces are counted once per distinct pre-token, multiplied by
the document's pre-token frequencies and summed; ids are never made.

A pre-token is a run of spaces (or of the model's sign for one) with the other characters after it. No
piece of the vocabulary holds a space after another character (checked when
the model is loaded), so pieces never cross pre-tokens and counts add up.

Each Python worker joins the frequencies of its own documents with the counts
it has made so far: a shuffle of all (document, pre-token) pairs would move
more bytes than the documents hold.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows
are counted each; a null doc_id stays null; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_of

# How the model writes a space; in a text it stands for one.
SPACE_SIGN = "\u2581"
_PRE_TOKEN = re.compile(r" [ ]*[^ ]*")
# Distinct pre-tokens whose counts one Python worker remembers; rarer ones are counted again.
_REMEMBERED = 1_000_000
_COUNTERS: dict[str, PieceCounter] = {}


class PieceCounter(dict):
    """Pre-token without its first space -> number of pieces."""

    def __init__(self, model: str):
        import sentencepiece

        super().__init__()
        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        names = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        # a space is written as U+2581 in pieces
        self.additive = not any(re.search("[^▁]▁", name) for name in names)

    def count(self, text: str) -> int:
        return len(self.model.encode(text))

    def __missing__(self, word: str) -> int:
        # a space that ends the text stands alone, and an empty text would have no space set before it
        n = self.count(word) if word else self.count("a ") - self.count("a")
        if len(self) < _REMEMBERED:
            self[word] = n
        return n

    def total(self, text: str) -> int:
        if not text:
            return 0
        if not self.additive:
            return self.count(text)
        text = text.replace(SPACE_SIGN, " ")  # the model cannot tell them apart
        if "  " in text or text[0] == " " or text[-1] == " ":  # the model sets one space before the text
            words = [w[1:] for w in _PRE_TOKEN.findall(" " + text)]
        else:
            words = text.split(" ")
        return sum(self[word] * n for word, n in Counter(words).items())


def _counter(model: str) -> PieceCounter:
    if model not in _COUNTERS:
        _COUNTERS[model] = PieceCounter(model)
    return _COUNTERS[model]


def token_counts(docs: DataFrame, model: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model)
        for batch in batches:
            n = pa.array([counter.total(x.as_py()) for x in batch.column(2)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), n], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.octet_length(text_of()).cast("bigint").alias("n_bytes"), text_of().alias("text"))
    counted = rows.mapInArrow(run, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
