"""Packing: best-fit decreasing into windows of at most ``window`` tokens (operator 5).

Every document (its ids and the end id) is first cut into full windows and one
rest.  The pieces, which are a few numbers each and not the ids themselves, are
dealt by a hash into bundles of about ``BUNDLE`` pieces; a bundle is packed in
one group: pieces in decreasing length, each into the open window with the
least room that still holds it, found by a segment tree indexed by the
remaining capacity.  The bundle count follows the number of pieces and
equal pieces are numbered before they are dealt, so a group stays bounded at any
size, and no source or text is a key.

Defined results: null text = empty = the end id alone; ties in length go by
document id, start and checksum, so packing does not depend on the order of
rows; repeated rows are packed each; a null id is dealt and kept as any other;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import read_table
from ampere.llm.registry import query
from ampere.llm.wordbpe import blocks, default_path, encoder
from ampere.session import materialize

WINDOW = 4096
END_ID = 2
BUNDLE = 10_000        # pieces packed together, on average


def pieces(docs: DataFrame, window: int = WINDOW, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """Per piece of (doc_id, text): doc_id, start, length, ids_crc32, doc_tokens."""
    path = path or default_path()

    def run(batches):
        enc = encoder(path)
        for b in batches:
            done = 0
            for part in blocks(b.column(1)):
                ids, at = enc.encode(part)
                tail = np.array([end_id], "<u4").tobytes()
                owner, start, length, crc, total = [], [], [], [], []
                words = ids.astype("<u4")
                for k in range(len(part)):
                    raw = words[at[k]:at[k + 1]].tobytes() + tail
                    n = len(raw) // 4
                    for s in range(0, n, window):
                        cut = raw[4 * s:4 * (s + window)]
                        owner.append(done + k)
                        start.append(s)
                        length.append(len(cut) // 4)
                        crc.append(zlib.crc32(cut))
                        total.append(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(owner, pa.int64())),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc, total))],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
                done += len(part)

    kind = docs.schema[0].dataType.simpleString()
    return docs.mapInArrow(
        run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint")


class Tightest:
    """Open windows by remaining capacity: a segment tree of counts over 0..size."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(size + 1)]

    def add(self, room: int, window: int) -> None:
        self.open[room].append(window)
        k = room + self.leaves
        while k:
            self.count[k] += 1
            k >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, and that room."""
        k, count = need + self.leaves, self.count
        while not count[k]:
            while k & 1:            # a right child: nothing to its right under this parent
                k >>= 1
            if not k:
                return None
            k += 1
        while k < self.leaves:
            k = 2 * k if count[2 * k] else 2 * k + 1
        room = k - self.leaves
        while k:
            count[k] -= 1
            k >>= 1
        return self.open[room].pop(), room


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """Window number and offset of every length (given in decreasing order)."""
    tree, where, offset, used = Tightest(window), [], [], 0
    for n in lengths:
        found = tree.take(n) if n < window else None
        if found is None:
            found, used = (used, window), used + 1
        w, room = found
        where.append(w)
        offset.append(window - room)
        if room > n:
            tree.add(room - n, w)
    return where, offset


def pack(cut: DataFrame, window: int = WINDOW, bundle: int = BUNDLE) -> DataFrame:
    """Pieces plus sequence_id and offset.  ``cut`` is read twice: give a written table.

    Equal pieces are counted and numbered, so that copies are dealt like other pieces."""
    names = ["start", "length", "ids_crc32", "doc_tokens"]
    bundles = max(1, -(-cut.count() // bundle))
    numbered = cut.groupBy("doc_id", *names).agg(F.count(F.lit(1)).alias("copies")).withColumn(
        "copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    dealt = numbered.select("doc_id", *names, F.pmod(
        F.xxhash64("doc_id", "start", "ids_crc32", "copy"), F.lit(bundles)).alias("bundle"))
    order = [("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")]

    def run(t: pa.Table) -> pa.Table:
        t = t.take(pc.sort_indices(t, sort_keys=order, null_placement="at_end"))
        where, offset = best_fit(t.column("length").to_pylist(), window)
        number = (t.column("bundle").to_numpy() << 32) + np.array(where, np.int64)
        return (t.drop_columns("bundle").append_column("sequence_id", pa.array(number))
                .append_column("offset", pa.array(offset, pa.int64())))

    kind = cut.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("bundle").applyInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in [*names, "sequence_id", "offset"]))


def pack_documents(docs: DataFrame) -> DataFrame:
    """All documents (doc_id, text) in windows of 4096 tokens."""
    return pack(materialize(pieces(docs.select("doc_id", "text")), "packing-pieces"))


@query("op5_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces with the sequence and offset they are packed at."""
    return pack_documents(read_table(spark, sf_dir, "documents"))
