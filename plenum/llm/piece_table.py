"""SentencePiece encoding and decoding through a table of distinct marked words.

When no piece of the vocabulary holds a whitespace marker after another
character, no merge can cross from a word into the marker that follows it.
Then a text is its marked words in a row (a run of markers and the characters
up to the next marker), and each word's ids do not depend on its neighbours.
Each task keeps a table of the distinct marked words of its slice of the
corpus, asks the library once for each of them, and joins the ids back by
position. The table is cleared when it outgrows a fixed size, which changes no
result. A vocabulary or normaliser without that property is encoded text by
text. No shuffle takes place.

Null texts count as empty (no ids, empty decoding).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, map_in_place, slices

MARK = "▁"
#: The table of a task holds at most so many words and characters.
TABLE_WORDS, TABLE_CHARS = 150_000, 8_000_000
#: A model larger than this is not sent to the workers.
MODEL_BYTES = 64 << 20

_WORDS = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


@lru_cache(maxsize=4)
def _processor(model: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=model)


def words_stand_alone(sp) -> bool:
    """True when no piece crosses into a marker and the normaliser only adds the
    first marker and turns blanks into markers."""
    pieces = (sp.id_to_piece(i) for i in range(sp.get_piece_size()))
    if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
        return False
    probe = " a  ﬁ　Ａ é\t\n "
    return sp.decode(sp.encode(probe)) == probe and sp.encode("a")[:1] == sp.encode("a b")[:1]


def marked_words(text: str) -> list[str]:
    """Marked words of a text, each without its first marker; [] for ''."""
    if not text:
        return []
    if " " in text:
        text = text.replace(" ", MARK)
    if MARK * 2 not in text and text[0] != MARK and text[-1] != MARK:
        return text.split(MARK)  # the usual case: one marker before each word
    return [w[1:] for w in _WORDS.findall(MARK + text)]


class WordTable:
    """ids of distinct marked words, asked of the library once each."""

    def __init__(self, sp):
        self.sp, self.ids, self.said, self.chars = sp, {"": [sp.piece_to_id(MARK)]}, {}, 0
        self.said[""] = b"%d" % self.ids[""][0]

    def add(self, words: set[str]) -> None:
        new = [w for w in words if w not in self.ids]
        if len(self.ids) + len(new) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self.__init__(self.sp)
            new = [w for w in words if w not in self.ids]
        for w, ids in zip(new, self.sp.encode(new, num_threads=1), strict=True):
            self.ids[w] = ids
            self.said[w] = b",".join(b"%d" % i for i in ids)
        self.chars += sum(map(len, new))

    def encode(self, words: list[str]) -> list[int]:
        return list(chain.from_iterable(map(self.ids.__getitem__, words)))

    def listed(self, words: list[str]) -> bytes:
        return b",".join(map(self.said.__getitem__, words))


def encoder(sp):
    """texts -> (ids, b'id,id,...') for each text."""
    if not words_stand_alone(sp):
        def plain(texts: list[str]):
            for ids in sp.encode(texts, num_threads=1):
                yield ids, ",".join(map(str, ids)).encode()
        return plain
    table = WordTable(sp)

    def by_words(texts: list[str]):
        split = [marked_words(t) for t in texts]
        table.add(set(chain.from_iterable(split)))
        for words in split:
            yield table.encode(words), table.listed(words)

    return by_words


def read_model(path: str) -> bytes:
    """The model file, read on the driver; its size is checked before it is sent out."""
    with open(path, "rb") as f:
        model = f.read(MODEL_BYTES + 1)
    if len(model) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return model


def encode_documents(docs: DataFrame, model: bytes, keep_ids: bool = True) -> DataFrame:
    """Per document ``doc_id, n_tokens, ids_sha256, decoded_sha256`` and, with
    ``keep_ids``, ``ids`` (array of int) and ``decoded`` (text)."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # size-checked by read_model
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if keep_ids:
        schema += ", ids array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(shared.value)
        encode = encoder(sp)
        for batch in batches:
            for part in slices(batch, 1):
                out = []
                for ids, listed in encode(part.column(1).to_pylist()):
                    text = sp.decode(ids) if ids else ""
                    row = [len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(text.encode()).hexdigest()]
                    out.append(row + [ids, text] if keep_ids else row)
                cols = list(zip(*out, strict=True))
                arrays = [part.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2])]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if keep_ids:
                    arrays += [pa.array(cols[3], pa.list_(pa.int32())), pa.array(cols[4], pa.string())]
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return id_and_text(docs).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, model: bytes, ids_col: str = "ids", out_col: str = "decoded") -> DataFrame:
    """Append the library's decoding of a column of id lists (null: null)."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("string")
    def decode(ids):
        import pandas as pd

        sp = _processor(shared.value)
        return pd.Series([None if x is None else (sp.decode([int(i) for i in x]) if len(x) else "") for x in ids])

    return rows.withColumn(out_col, decode(F.col(ids_col)))


def keep_round_trips(docs: DataFrame, model: bytes, text_col: str = "text") -> DataFrame:
    """Append ``n_tokens`` and ``round_trip`` (the decoding equals the text) to
    every row in place, without a shuffle. A null text has 0 tokens."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    added = {"n_tokens": "long", "round_trip": "boolean"}
    at = [c for c in docs.columns if c not in added].index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(shared.value)
        encode = encoder(sp)
        for batch in batches:
            for part in slices(batch, at):
                texts = [t or "" for t in part.column(at).to_pylist()]
                n, same = [], []
                for text, (ids, _) in zip(texts, encode(texts), strict=True):
                    n.append(len(ids))
                    same.append((sp.decode(ids) if ids else "") == text)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int64()), pa.array(same, pa.bool_())],
                                                 [*part.schema.names, "a0", "a1"])

    return map_in_place(docs, run, added)
