"""Encoding and decoding of texts with a published BPE vocabulary, as an automaton over tokens.

Nulls and empty texts have no ids and decode to the empty text; texts are taken
whole, whatever their length; repeated rows give repeated rows.  All other
columns of the input are left out of the result, so their names cannot clash.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from quadloom.llm.automaton import automaton
from quadloom.llm.common import by_batch, column, prepare


def encode(docs: DataFrame, vocabulary: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column`` and ``ids``: the little-endian unsigned 32-bit ids of the text as binary.

    ``vocabulary`` is the path of the tokenizer file on every machine.
    """
    prepare(docs.sparkSession)

    def work(batch):
        texts = column(batch, "text").to_pylist()
        return {id_column: column(batch, "id"), "ids": pa.array(automaton(vocabulary).encode_all(texts), pa.binary())}

    given = docs.selectExpr(f"`{id_column}` as id", f"cast(`{text_column}` as string) as text")
    return given.mapInArrow(by_batch(work), f"`{id_column}` {given.schema['id'].dataType.simpleString()}, ids binary")


def decode(encoded: DataFrame, vocabulary: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``id_column``, ``ids_column`` and ``decoded``: the labels of the ids, as UTF-8 in binary; null ids count as none."""
    prepare(encoded.sparkSession)

    def work(batch):
        ids = column(batch, "ids")
        out = [automaton(vocabulary).decode(x or b"") for x in ids.to_pylist()]
        return {id_column: column(batch, "id"), ids_column: ids, "decoded": pa.array(out, pa.binary())}

    given = encoded.selectExpr(f"`{id_column}` as id", f"`{ids_column}` as ids")
    kind = given.schema["id"].dataType.simpleString()
    return given.mapInArrow(by_batch(work), f"`{id_column}` {kind}, `{ids_column}` binary, decoded binary")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Digests of the ids and of what they decode to, without moving either between processes."""
    prepare(docs.sparkSession)

    def work(batch):
        codec = automaton(vocabulary)
        encoded = codec.encode_all(column(batch, "text").to_pylist())
        return {
            "doc_id": column(batch, "doc_id"),
            "n_tokens": pa.array([len(x) // 4 for x in encoded], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in encoded]),
            "decoded_sha256": pa.array([hashlib.sha256(codec.decode(x)).hexdigest() for x in encoded]),
        }

    given = docs.selectExpr("doc_id", "cast(text as string) as text")
    return given.mapInArrow(by_batch(work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
