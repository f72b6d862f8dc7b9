"""Token counts by overlap resynchronisation (operator 7).

Short texts are encoded whole.  A huge text is encoded in overlapping chunks
with character offsets; neighbouring chunks are spliced at a boundary inside
their overlap that both encodings have and that no piece of the vocabulary can
cross (a space after a non-space: checked against the whole vocabulary when the
model is loaded).  Where an overlap has no such boundary it is doubled, up to
the whole of both chunks, which are then taken as one and the next chunk is as
long as that, so the count is exact for any text.

A text is never shuffled; a row's text is encoded about twice at most, also one
without any boundary (whose chunks double), plus its overlaps; memory is bounded
by the chunk unless a text has no boundary.

Defined results: null text = empty = 0 tokens, 0 bytes; repeated rows are
counted each; special strings are ordinary text, as the library's default; an
empty table gives an empty result; other columns are kept, whatever their names.
"""

from __future__ import annotations

import functools
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampere.llm.common import read_table, schema_plus
from ampere.llm.registry import query

CHUNK = 16_384       # characters of a chunk; longer texts are cut
OVERLAP = 256        # characters two chunks share at first
LIMIT = 4096         # tokens above which a document is over the limit
_SPACES = " ▁"
_BOUNDARY = re.compile("(?<=[^ ▁])[ ▁]")


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


@functools.lru_cache(maxsize=4)
def counter(path: str) -> PieceCounter:
    """One counter a worker process and file."""
    return PieceCounter(path)


class PieceCounter:
    def __init__(self, path: str):
        import sentencepiece
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = (self.lib.id_to_piece(i) for i in range(self.lib.get_piece_size()))
        #: no piece holds a space after another character, so no merge crosses such a boundary
        self.proven = not any("▁" in p.lstrip("▁") for p in pieces)

    def begins(self, text: str) -> list[int]:
        """Where the pieces of a text begin, in characters."""
        return [at for at, _ in self.lib.encode_as_offset_mapping(text)["offsets"]]

    def count(self, texts: list[str], chunk: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
        out = [0] * len(texts)
        short = [i for i, t in enumerate(texts) if len(t) <= chunk or not self.proven]
        for k in range(0, len(short), 64):
            part = short[k:k + 64]
            for i, ids in zip(part, self.lib.encode([texts[i] for i in part], num_threads=1)):
                out[i] = len(ids)
        for i in set(range(len(texts))).difference(short):
            out[i] = self.count_huge(texts[i], chunk, overlap)
        return out

    def count_huge(self, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
        total, taken = 0, 0                      # pieces counted, and up to which character
        lo, hi = 0, min(chunk, len(text))
        left = [lo + b for b in self.begins(text[lo:hi])]
        while hi < len(text):
            wide = overlap
            while True:
                nlo = max(lo, hi - wide)
                if nlo > lo and not _BOUNDARY.search(text, max(nlo, taken) + 1, hi):
                    wide *= 2                    # nothing to splice at: widen before anything is encoded
                    continue
                nhi = min(len(text), max(hi + chunk, nlo + chunk))
                if nlo == lo:                    # taken as one: twice as long, so that all text is encoded
                    chunk = max(chunk, hi - lo)  # about twice, whatever its length
                    nhi = min(len(text), hi + chunk)
                right = [nlo + b for b in self.begins(text[nlo:nhi])]
                cut = self._common(text, left, right, max(nlo, taken), hi)
                if cut is not None:
                    total += sum(taken <= b < cut for b in left)
                    taken, lo, hi, left = cut, nlo, nhi, right
                    break
                if nlo == lo:                    # the chunks have no boundary in common
                    hi, left = nhi, right
                    break
                wide *= 2
        return total + sum(b >= taken for b in left)

    @staticmethod
    def _common(text: str, left: list[int], right: list[int], lo: int, hi: int) -> int | None:
        """The middle one of the boundaries in (lo, hi) that both have and that nothing can cross."""
        both = sorted(set(left).intersection(right))
        safe = [b for b in both if lo < b < hi and text[b] in _SPACES and text[b - 1] not in _SPACES]
        return safe[len(safe) // 2] if safe else None


def with_token_count(docs: DataFrame, out: str = "n_tokens", text: str = "text",
                     path: str | None = None) -> DataFrame:
    """``docs`` plus ``out``: the number of tokens of the whole text."""
    path = path or default_path()
    fields = [f.name for f in docs.schema]

    def run(batches):
        lib = counter(path)
        for b in batches:
            texts = pc.fill_null(b.column(fields.index(text)), "").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(lib.count(texts), pa.int64())], names=[*fields, out])

    return docs.mapInArrow(run, schema_plus(docs, out, "bigint"))


@query("op7_token_counts")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_token_count(docs).select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
        "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
