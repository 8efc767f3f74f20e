"""SentencePiece encoding and decoding through a table of distinct chunks.

No piece of the vocabulary has a white-space marker after another character, so no merge
crosses from a character to a marker: a text falls into chunks, each a run of markers and the
characters up to the next run, which the library segments independently.  A task keeps a
table of the distinct chunks it has met, gives each new one to the library once, and joins ids
and decoded text back by position.

The table is one task's, not the corpus's: joining a global table back by position would move
every word of the corpus through a shuffle, several times the size of the texts, where most
words of a task repeat within it anyway.  It is emptied when it reaches ``TABLE_CHUNKS``
entries, which bounds its memory and changes no result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

MARKER = "▁"
#: Entries of a task's table; some 60 MB.
TABLE_CHUNKS = 150_000
#: Rows handed on at once: a text's ids take several times its own memory.
ROWS_OUT = 256
_CHUNK = re.compile(f"{MARKER}+[^{MARKER}]*")


@cache
def _processor(model_file: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def check_model(model_file: str) -> None:
    """Refuse a model for which chunks are not independent, or which changes texts first."""
    sp = _processor(model_file)
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_byte(i) or sp.is_unknown(i)))
    if any(MARKER in p.lstrip(MARKER) for p in pieces):
        raise ValueError("a piece crosses a white-space marker; this model cannot be encoded chunk by chunk")
    probe = " a  ﬁ  b\n"
    if sp.decode(sp.encode(probe)) != probe or len(sp.encode(f"a{MARKER}")) != len(sp.encode("a ")):
        raise ValueError("the model normalises texts or drops blanks; this operator needs one that does neither")


class ChunkTable(dict):
    """Chunk to (ids as decimal text, number of ids, decoded text); segments what it lacks."""

    def __init__(self, model_file: str) -> None:
        self._sp = _processor(model_file)
        self._marker_id = self._sp.piece_to_id(MARKER)

    def __missing__(self, chunk: str) -> tuple[str, int, str]:
        # The library puts a marker before what it is given, which stands for the chunk's first.
        ids = self._sp.encode(chunk[1:]) if len(chunk) > 1 else [self._marker_id]
        entry = self[chunk] = (",".join(map(str, ids)), len(ids), " " + self._sp.decode(ids))
        return entry

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids as comma-joined decimals, and the decoded text."""
        if not text:
            return 0, "", ""
        if len(self) > TABLE_CHUNKS:
            self.clear()
        ids, counts, decoded = zip(*map(self.__getitem__, _CHUNK.findall(MARKER + text.replace(" ", MARKER))), strict=True)
        return sum(counts), ",".join(ids), "".join(decoded)[1:]


def encode_documents(docs: DataFrame, model_file: str, doc_id: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """Encode and decode every text of ``docs``: doc_id, n_tokens, ids (array of int), decoded.

    As the library does without begin and end ids and without sampling.  A null text is empty;
    an empty text has no ids.  With ``digest``, ids_sha256 (of the decimal ids, comma-joined) and
    decoded_sha256 replace ids and decoded, and are all that leaves the task.  Repeated rows are
    rows like any other; other columns are not looked at.  The model file must be readable under
    the same path on every executor, as an installed package is.
    """
    check_model(model_file)
    kind = docs.schema[doc_id].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = ChunkTable(model_file)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_OUT):
                some = batch.slice(at, ROWS_OUT)
                n, ids, decoded = [], [], []
                for value in some.column(1):
                    count, numbers, back = chunks.encode(value.as_py() or "")
                    n.append(count)
                    if digest:
                        ids.append(hashlib.sha256(numbers.encode()).hexdigest())
                        decoded.append(hashlib.sha256(back.encode()).hexdigest())
                    else:
                        ids.append(np.array(numbers.split(",") if numbers else [], np.int32))
                        decoded.append(back)
                arrays = [some.column(0), pa.array(n, pa.int64()), pa.array(ids, pa.string() if digest else pa.list_(pa.int32())), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "n_tokens", *out])

    out = ["ids_sha256", "decoded_sha256"] if digest else ["ids", "decoded"]
    schema = f"doc_id {kind}, n_tokens long, {out[0]} {'string' if digest else 'array<int>'}, {out[1]} string"
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(work, schema)
