"""Encoding and decoding of whole documents with a public word vocabulary."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from shelfmark.llm.batches import append_columns
from shelfmark.llm.merges import WordCodec

DIGESTS = "n_tokens long, ids_sha256 string, decoded_sha256 string"
_codecs: dict[str, WordCodec] = {}


def codec(vocabulary: str) -> WordCodec:
    """The codec of a vocabulary file, read once per Python worker; the file is installed on every machine."""
    if vocabulary not in _codecs:
        _codecs[vocabulary] = WordCodec(vocabulary)
    return _codecs[vocabulary]


def encode(docs: DataFrame, vocabulary: str, text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `token_ids array<int>`; a null text is encoded as an empty one and has no ids."""

    def make(piece):
        own = codec(vocabulary)
        return [pa.array([own.encode(t or "") for t in piece.column("__text").to_pylist()], pa.list_(pa.int32()))]

    return append_columns(docs, text_col, "token_ids array<int>", make, keep)


def decode(tokens: DataFrame, vocabulary: str, ids_col: str = "token_ids") -> DataFrame:
    """`tokens` with `decoded string`, the text that the ids spell; null ids spell an empty text."""

    def make(piece):
        own = codec(vocabulary)
        return [pa.array([own.decode(ids or []) for ids in piece.column("__text").to_pylist()], pa.string())]

    return append_columns(tokens, ids_col, "decoded string", make, tokens.columns, sized=False)


def digests(docs: DataFrame, vocabulary: str, text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `DIGESTS`: number of ids, digest of the ids as text, digest of the decoded text.

    Every row is kept as a row; a null or empty text has no ids and the digests
    of an empty text.
    """

    def make(piece):
        own = codec(vocabulary)
        rows = []
        for text in piece.column("__text").to_pylist():
            entries = own.entries(text or "")
            rows.append(
                (
                    sum(e[0] for e in entries),
                    hashlib.sha256(" ".join([e[1] for e in entries]).encode()).hexdigest(),
                    hashlib.sha256(" ".join([e[2] for e in entries]).encode("utf-8")).hexdigest(),
                )
            )
        counts, ids, decoded = zip(*rows) if rows else ((), (), ())
        return [pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]

    return append_columns(docs, text_col, DIGESTS, make, keep)


def encode_and_decode(docs: DataFrame, vocabulary: str, text_col: str = "text", keep=None) -> DataFrame:
    """`docs` with `token_ids array<int>` and the columns of `digests`, in one pass over the texts."""

    def make(piece):
        own = codec(vocabulary)
        rows = []
        for text in piece.column("__text").to_pylist():
            entries = own.entries(text or "")
            spelled = " ".join([e[1] for e in entries])
            decoded = " ".join([e[2] for e in entries])
            rows.append(
                (
                    np.fromstring(spelled, np.int32, sep=" "),
                    sum(e[0] for e in entries),
                    hashlib.sha256(spelled.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8")).hexdigest(),
                )
            )
        columns = zip(*rows) if rows else ((), (), (), ())
        kinds = (pa.list_(pa.int32()), pa.int64(), pa.string(), pa.string())
        return [pa.array(c, kind) for c, kind in zip(columns, kinds)]

    return append_columns(docs, text_col, "token_ids array<int>, " + DIGESTS, make, keep)
