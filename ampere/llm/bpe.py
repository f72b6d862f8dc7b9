"""BPE encoding and decoding by a distinct-word table (operator 10).

Texts are split into words inside Spark tasks (Arrow kernels over the batches
Spark hands out), each distinct word of a block is encoded once by the
tokenizers library, and the ids are joined back to the words by position.
Decoding joins ids to their pieces through the id-to-piece table.  No shuffle:
a block is at most ``wordbpe.BLOCK_BYTES`` of text (or one text), so memory does
not depend on the corpus or on how often a word occurs.

Defined results: null text = empty text = no ids, decoded ''; repeated rows are
encoded each; white space is dropped by the tokenizer; special strings inside a
text become their special ids, as the library does; an empty table gives an
empty result; other columns of the input are kept, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ampere.llm.common import read_table, schema_plus
from ampere.llm.registry import query
from ampere.llm.wordbpe import blocks, default_path, encoder


def with_ids(docs: DataFrame, out: str = "ids", text: str = "text", path: str | None = None) -> DataFrame:
    """``docs`` plus ``out``: the ids of the whole text."""
    path = path or default_path()
    fields = [f.name for f in docs.schema]

    def run(batches):
        enc = encoder(path)
        for b in batches:
            done = 0
            for part in blocks(b.column(fields.index(text))):
                ids, at = enc.encode(part)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                rows = b.slice(done, len(part))
                done += len(part)
                yield pa.RecordBatch.from_arrays([*rows.columns, lists], names=[*fields, out])

    return docs.mapInArrow(run, schema_plus(docs, out, "array<int>"))


def pieces_of(ids: pa.ListArray, pieces: pa.Array) -> pa.Array:
    """Decoded texts: the pieces of the ids, joined as the library joins them (one space)."""
    joined = pa.ListArray.from_arrays(ids.offsets, pieces.take(ids.values))
    return pc.binary_join(joined, " ")


def with_decoded(docs: DataFrame, out: str = "decoded", ids: str = "ids", path: str | None = None) -> DataFrame:
    """``docs`` plus ``out``: the text its ids decode to, special pieces kept."""
    path = path or default_path()
    fields = [f.name for f in docs.schema]

    def run(batches):
        table = pa.array(encoder(path).pieces, pa.string())
        for b in batches:
            col = b.column(fields.index(ids))
            col = pc.fill_null(col, pa.scalar([], col.type)) if col.null_count else col
            col = pa.ListArray.from_arrays(
                pa.array((col.offsets.to_numpy() - col.offsets[0].as_py()).astype(np.int32)), col.flatten())
            yield pa.RecordBatch.from_arrays([*b.columns, pieces_of(col, table)], names=[*fields, out])

    return docs.mapInArrow(run, schema_plus(docs, out, "string"))


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row of (doc_id, text).

    Encodes and decodes block by block, so that neither ids nor decoded texts leave the task."""
    path = path or default_path()

    def run(batches):
        enc = encoder(path)
        numbers, table = pa.array([str(i) for i in range(enc.size)]), pa.array(enc.pieces, pa.string())
        for b in batches:
            done = 0
            for part in blocks(b.column(1)):
                ids, at = enc.encode(part)
                lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
                shas = []
                for names in (numbers, table):
                    shas.append([hashlib.sha256(x.as_buffer()).hexdigest() for x in pieces_of(lists, names)])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(done, len(part)), pa.array(np.diff(at)), *map(pa.array, shas)],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
                done += len(part)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


@query("op10_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the decoded text of every document."""
    return digests(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
