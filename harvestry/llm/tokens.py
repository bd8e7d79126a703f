"""Problem 8: encoding of a corpus with a public byte-level tokenizer.

A text is cut into words by the tokenizer's own pattern. Every distinct word is first cut greedily into the longest
tokens; a sequence of tokens is the right one exactly if each adjacent pair is what the merges make of that pair alone,
which is looked up for all pairs of a batch at once. Only words with a pair that fails are merged exactly.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from ..session import table

#: Where the public vocabulary files are, and the pattern that cuts a text into words (fixed values of the tokenizer).
VOCABULARIES = "/opt/tokenizers"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words whose tokens a worker keeps at hand, and the longest word worth keeping; others are encoded each time.
KEPT_WORDS, KEPT_LENGTH = 200_000, 64


class BytePairs:
    """A byte-level vocabulary: bytes of each token to its rank, which is its id."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.longest = max(map(len, ranks))
        self.base = max(ranks.values()) + 1
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.fits: dict[int, bool] = {}
        self.words: dict[str, list[int]] = {}
        self.pattern = regex.compile(PATTERN)
        # Tokens that no merge order makes can't be proposed by the greedy step.
        self.proposed = {b: i for b, i in ranks.items() if len(b) < 2 or self.merge(b) == [i]}

    def merge(self, word: bytes) -> list[int]:
        """The exact ids of a word: the adjacent pair of lowest rank is merged until none can be.

        Pairs wait in a heap over a linked list, so a word of n bytes takes n log n steps however long it is.
        """
        import heapq

        n = len(word)
        if n == 1:
            return [self.ranks[word]]
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        end = list(range(1, n + 1))
        alive = bytearray(b"\x01") * n
        ranks = self.ranks
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or end[j] != stop:
                continue
            end[i] = stop
            alive[j] = 0
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if end[k] - i <= self.longest and (r := ranks.get(word[i : end[k]])) is not None:
                    heapq.heappush(heap, (r, i, end[k]))
            h = left[i]
            if h >= 0 and stop - h <= self.longest and (r := ranks.get(word[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]

    def propose(self, word: bytes) -> list[int]:
        """Greedy: the longest token from each place on."""
        whole = self.proposed.get(word)
        if whole is not None:
            return [whole]
        ids, at, n, known = [], 0, len(word), self.proposed
        while at < n:
            stop = min(n, at + self.longest)
            while (i := known.get(word[at:stop])) is None:
                stop -= 1
            ids.append(i)
            at = stop
        return ids

    def verified(self, proposals: list[list[int]]) -> np.ndarray:
        """Which proposals hold: every adjacent pair is what the merges make of its two tokens."""
        sizes = np.fromiter(map(len, proposals), np.int64, len(proposals))
        flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(sizes.sum()))
        owner = np.repeat(np.arange(len(proposals)), sizes)
        inside = owner[1:] == owner[:-1]
        pairs, at = np.unique((flat[:-1] * self.base + flat[1:])[inside], return_inverse=True)
        good = np.fromiter(map(self._fits, pairs.tolist()), bool, len(pairs))
        held = np.ones(len(proposals), bool)
        held[owner[1:][inside][~good[at]]] = False
        return held

    def _fits(self, pair: int) -> bool:
        known = self.fits.get(pair)
        if known is None:
            a, b = divmod(pair, self.base)
            known = self.fits[pair] = self.merge(self.bytes_of[a] + self.bytes_of[b]) == [a, b]
            if len(self.fits) > 2_000_000:
                self.fits.clear()
        return known

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """The ids of distinct words; those of common words stay at hand."""
        new = [w for w in words if w not in self.words]
        raw = [w.encode() for w in new]
        proposals = list(map(self.propose, raw))
        held = self.verified(proposals) if proposals else []
        fresh = {w: p if ok else self.merge(b) for w, b, p, ok in zip(new, raw, proposals, held, strict=True)}
        known = {w: self.words[w] for w in words if w in self.words}
        if len(self.words) + len(fresh) > KEPT_WORDS:
            self.words.clear()
        self.words.update((w, i) for w, i in fresh.items() if len(w) <= KEPT_LENGTH)
        return known | fresh

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, offsets of the texts in them); none for null and empty texts."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        ids = self.encode_words(list(set(chain.from_iterable(cut)) if len(cut) > 1 else dict.fromkeys(cut[0]) if cut else []))
        offsets = np.zeros(len(texts) + 1, np.int64)
        out: list[int] = []
        for k, words in enumerate(cut):
            out.extend(chain.from_iterable(map(ids.__getitem__, words)))
            offsets[k + 1] = len(out)
        return np.array(out, np.int32), offsets


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a .tiktoken file, or of the vocabulary of a byte-level .json file."""
    with open(path, "rb") as f:
        if path.endswith(".tiktoken"):
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        vocabulary = json.load(f)["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in shown)}
    return {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if all(c in byte for c in t)}


@cache
def byte_pairs(path: str) -> BytePairs:
    return BytePairs(read_ranks(path))


@cache
def piece_model(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def vocabulary_path(tokenizer: str, folder: str = VOCABULARIES) -> str:
    return f"{folder}/{tokenizer}{'.model' if tokenizer.startswith('piece') else '.tiktoken'}"


def encode_texts(df: DataFrame, key: str, text: str, tokenizer: str = "byte_bpe_50k", folder: str = VOCABULARIES) -> DataFrame:
    """(`key`, ids) of every row of `df`: the ids of its text by a byte-level tokenizer, without special tokens.

    A null or empty text has no ids; a blank one has those of its white space; what looks like a special token is
    ordinary text. Repeated rows come out as often as they come in; an empty table gives an empty one. The files in
    `folder` must be readable on every executor.
    """
    path = vocabulary_path(tokenizer, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _encoded(batch, byte_pairs(path))

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def _encoded(batch: pa.RecordBatch, pairs: BytePairs, slice_chars: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in parts of bounded text, so that long texts don't pile up in memory."""
    texts = batch.column(1).to_pylist()
    start, chars = 0, 0
    for k, text in enumerate(texts):
        chars += len(text or "")
        if chars > slice_chars or k + 1 == len(texts):
            ids, offsets = pairs.encode_batch(texts[start : k + 1])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, k + 1 - start), lists], [batch.schema.names[0], "ids"])
            start, chars = k + 1, 0


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document by byte_bpe_50k."""
    return encode_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


def count_tokens(texts: list[str | None], tokenizer: str, folder: str = VOCABULARIES) -> list[int]:
    """The number of tokens of each text; 0 for null and empty ones."""
    path = vocabulary_path(tokenizer, folder)
    if path.endswith(".model"):
        return list(map(len, piece_model(path).encode([t or "" for t in texts], num_threads=1)))
    return np.diff(byte_pairs(path).encode_batch(texts)[1]).tolist()


SQL: dict[str, str] = {}
QUERIES = {"p8_ids": p8_ids}
