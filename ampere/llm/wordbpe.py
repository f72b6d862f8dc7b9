"""Distinct-word encoding for tokenizers that drop white space (helper of operators 3, 5, 10).

White space never joins two words here: the normaliser and the splitter of such
a tokenizer work inside a word, so a text's ids are the ids of its words in
order.  A block of texts is split into words by Arrow kernels, each distinct
word is encoded once by the library, and the ids return by position (an Arrow
``take``).  Words made of Latin letters plus closing punctuation share the
encoding of their lower-case letters; every other word goes to the library as
it stands, special strings included.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Letters (all lower-casing to one letter), then ASCII punctuation without the apostrophe.
_LETTERS_POINTS = "^(?P<a>[A-Za-zÀ-ÖØ-öø-ÿ]*)(?P<b>[!-&(-/:-@\\[-`{-~]*)$"
BLOCK_BYTES = 4 << 20      # text handled at once
CACHE_WORDS = 200_000      # letter runs remembered by a worker between blocks
_END = "</w>"


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> WordEncoder:
    """One encoder a worker process and file."""
    return WordEncoder(path)


class WordEncoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        self.lib.no_padding()
        self.lib.no_truncation()
        vocab = self.lib.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.pieces = [""] * self.size
        for piece, i in vocab.items():
            self.pieces[i] = piece
        self.ends = np.array([p.endswith(_END) for p in self.pieces])
        self.cache: dict[str, bytes] = {}

    def _whole(self, words: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<i4").tobytes()
                for e in self.lib.encode_batch(words, add_special_tokens=False)]

    def _letter_runs(self, runs: list[str]) -> list[bytes]:
        """Runs of letters, joined by spaces: each ends with exactly one word-end piece."""
        out: list[bytes] = []
        for k in range(0, len(runs), 2000):
            part = runs[k:k + 2000]
            ids = np.asarray(self.lib.encode(" ".join(part), add_special_tokens=False).ids, "<i4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(part) and cut[-1] == len(ids):
                raw, lo = ids.tobytes(), 0
                for hi in (cut * 4).tolist():
                    out.append(raw[lo:hi])
                    lo = hi
            else:
                out += self._whole(part)
        return out

    def _look_up(self, runs: list[str]) -> list[bytes]:
        new = [r for r in runs if r not in self.cache]
        if len(self.cache) + len(new) > CACHE_WORDS:
            self.cache.clear()
            new = runs
        new = [r for r in new if r]
        self.cache.update(zip(new, self._letter_runs(new)))
        self.cache[""] = b""
        return [self.cache[r] for r in runs]

    def _distinct(self, words: pa.Array) -> pa.ListArray:
        """The ids of each of the distinct words."""
        m = pc.extract_regex(words, pattern=_LETTERS_POINTS)
        odd = np.flatnonzero(pc.is_null(m).to_numpy(zero_copy_only=False))
        a = pc.fill_null(pc.utf8_lower(pc.struct_field(m, "a")), "").dictionary_encode()
        b = pc.fill_null(pc.struct_field(m, "b"), "").dictionary_encode()
        runs, points = a.dictionary.to_pylist(), b.dictionary.to_pylist()
        store = (self._look_up(runs) + self._whole(points)
                 + self._whole(words.take(pa.array(odd)).to_pylist()))
        two = np.empty((len(words), 2), np.int64)
        two[:, 0] = a.indices.to_numpy(zero_copy_only=False)
        two[:, 1] = len(runs) + b.indices.to_numpy(zero_copy_only=False)
        two[odd, 0] = len(runs) + len(points) + np.arange(len(odd))   # their point run is ''
        lists = _lists(store).take(pa.array(two.ravel()))
        return pa.LargeListArray.from_arrays(pa.array(lists.offsets.to_numpy()[::2]), lists.flatten())

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """ids (int32) of all texts, one after the other, and where each text starts (n + 1 offsets)."""
        flat, counts = [np.empty(0, np.int32)], [np.zeros(1, np.int64)]
        for part in blocks(texts):
            words = pc.ascii_split_whitespace(part)
            at = words.offsets.to_numpy().astype(np.int64)
            at -= at[0]
            coded = words.flatten().dictionary_encode()
            if not len(coded):
                counts.append(np.zeros(len(part), np.int64))
                continue
            ids = self._distinct(coded.dictionary).take(coded.indices)
            start = ids.offsets.to_numpy()
            counts.append(np.diff((start - start[0])[at]))
            flat.append(ids.flatten().to_numpy())
        return np.concatenate(flat), np.cumsum(np.concatenate(counts))


def _lists(store: list[bytes]) -> pa.LargeListArray:
    size = np.zeros(len(store) + 1, np.int64)
    size[1:] = np.fromiter(map(len, store), np.int64, len(store)) // 4
    return pa.LargeListArray.from_arrays(
        pa.array(np.cumsum(size)), pa.array(np.frombuffer(b"".join(store), "<i4")))


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES):
    """The texts, null as empty, in runs of about ``limit`` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    group = (ends - 1).clip(0) // limit
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
    for lo, hi in zip(cuts, cuts[1:]):
        yield texts.slice(lo, hi - lo)
