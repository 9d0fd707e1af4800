"""Byte-level BPE by a hierarchical-bitmap rank queue, and back.

The ranks of a vocabulary are fixed, so the queue of pending merges needs no comparisons
between ranks: every rank has a bucket of positions in the linked list of parts, and a
bitmap of two levels tells which buckets are filled. Find-first-set on the upper, then
the lower level gives the next rank. Entries whose pair has changed are skipped when
they come up. A pre-token of n bytes costs about n log n steps, however long it is.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame

from contractlens.llm.common import id_and_text, per_worker, slices

#: Ranks per word of the lower bitmap.
WORD = 256
#: Entries kept per generation of a worker's memo, and the longest kept.
MEMO, MEMO_CHARS = 200_000, 48
#: Entries for pieces that follow a space, and for other pre-tokens.
WORDS, OTHERS = 600_000, 50_000
#: Signs that often end a word; alone they are one pre-token.
STOPS = frozenset(",.!?;:")
#: A space that starts the next pre-token; the patterns of these vocabularies never join
#: what is before it with what follows.
CUT = re.compile(r" (?=\S)")
UNUSUAL = re.compile(r" (?:\s|\Z)")


def ranks_of(data: bytes) -> dict[bytes, int]:
    """Vocabulary lines: token in base64, rank."""
    pairs = (line.split() for line in data.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class Encoder:
    """Ids of a pre-token's bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.single = [ranks[bytes([b])] for b in range(256)]
        # the lower bitmap; all zero between calls, as the queue runs empty
        self.lower = [0] * (len(self.tokens) // WORD + 1)

    def encode(self, piece: bytes) -> list[int]:
        """The queue's steps stand where they are needed, as calls would take longer than
        the steps; `upper` and `lower` are the bitmap, `buckets` the positions by rank, each
        a heap, so that positions of a rank come from the left."""
        rank_of, tokens, lower = self.ranks.get, self.tokens, self.lower
        whole = rank_of(piece)
        if whole is not None:
            return [whole]
        n, upper, buckets = len(piece), 0, {}
        single = self.single
        ids = [single[b] for b in piece]
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        # the rank of the pair that starts here; -1 if it merges no more
        pair = [-1] * n
        for at in range(n - 1):
            rank = rank_of(piece[at : at + 2])
            if rank is not None:
                pair[at] = rank
                if rank in buckets:
                    buckets[rank].append(at)  # ascending, so still a heap
                else:
                    buckets[rank] = [at]
                    word = rank // WORD
                    lower[word] |= 1 << rank % WORD
                    upper |= 1 << word
        while upper:
            word = (upper & -upper).bit_length() - 1
            bits = lower[word]
            rank = word * WORD + (bits & -bits).bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                at = heappop(bucket)
            else:
                at = bucket[0]
                del buckets[rank]
                bits &= bits - 1
                lower[word] = bits
                if not bits:
                    upper &= upper - 1
            if pair[at] != rank:
                continue  # stale
            gone = right[at]
            after = right[gone]
            ids[at], right[at], pair[gone], ids[gone] = rank, after, -1, -1
            token = tokens[rank]
            pair[at] = -1
            if after < n:
                left[after] = at
                new = rank_of(token + tokens[ids[after]])
                if new is not None:
                    pair[at] = new
                    if new in buckets:
                        heappush(buckets[new], at)
                    else:
                        buckets[new] = [at]
                        word = new // WORD
                        lower[word] |= 1 << new % WORD
                        upper |= 1 << word
            before = left[at]
            if before >= 0:
                new = rank_of(tokens[ids[before]] + token)
                if new is None:
                    pair[before] = -1
                else:
                    pair[before] = new
                    if new in buckets:
                        heappush(buckets[new], before)
                    else:
                        buckets[new] = [before]
                        word = new // WORD
                        lower[word] |= 1 << new % WORD
                        upper |= 1 << word
        return [i for i in ids if i >= 0]


class Memo(dict):
    """Results by piece of text, in two generations.

    A generation is bounded by its entries and, as pieces are at most `longest` characters
    and results grow with them, in bytes.
    """

    def __init__(self, make, limit: int = MEMO, longest: int = MEMO_CHARS):
        super().__init__()
        self.make, self.limit, self.longest, self.old = make, limit, longest, {}

    def __missing__(self, piece):
        found = self.old.get(piece)
        if found is None:
            found = self.make(piece)
            if len(piece) > self.longest:
                return found
        if len(self) >= self.limit:
            self.old.clear()  # before the copy, so that there are never three generations
            self.old.update(self)
            self.clear()
        self[piece] = found
        return found


def pieces(text: str) -> list[str]:
    """The text cut at spaces that start a pre-token; all but the first lack that space."""
    return CUT.split(text) if UNUSUAL.search(text) else text.split(" ")


class TextIds:
    """Ids of texts, as bytes, put together from remembered pieces.

    `word` gives the ids of one pre-token, `match` cuts a text into pre-tokens. Letters
    after a space are one pre-token and are kept under the letters alone; any other piece
    is cut, and its words are kept the same way.
    """

    def __init__(
        self, word: Callable[[str], bytes], match: Callable[[str], list[str]], limit: int = WORDS
    ):
        self.word, self.match = word, match
        self.after_space = Memo(self._after_space, limit)
        self.others = Memo(word, OTHERS)

    def split(self, text: str) -> bytes:
        spaced, others = self.after_space, self.others
        return b"".join(
            [
                spaced[word[1:]] if word[0] == " " and word[1:].isalpha() else others[word]
                for word in self.match(text)
            ]
        )

    def _after_space(self, piece: str) -> bytes:
        if piece.isalpha():
            return self.word(" " + piece)
        letters, last = piece[:-1], piece[-1:]
        if last in STOPS and letters.isalpha():
            return self.after_space[letters] + self.others[last]
        return self.split(" " + piece)

    def encode(self, text: str) -> bytes:
        head, *tail = pieces(text)
        return self.split(head) + b"".join(map(self.after_space.__getitem__, tail))


def text_ids(ranks: dict[bytes, int], pattern: str) -> TextIds:
    """Ids of whole texts as little-endian unsigned 32-bit integers."""
    import regex

    encode = Encoder(ranks).encode
    return TextIds(lambda word: array("I", encode(word.encode())).tobytes(), regex.compile(pattern).findall)


def encode_texts(
    docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian unsigned 32-bit integers) of every text.

    `vocabulary` is the path of a rank file, read on the driver; its size is the bound
    of what travels to the executors. Ids equal those of the tiktoken library without
    special tokens. No shuffle; each worker keeps a memo of bounded size.

    Defined cases: null and empty texts have no ids; repeated rows are encoded each;
    the id is passed on as it is; further columns are left out; an empty table gives
    no rows.
    """
    with open(vocabulary, "rb") as file:
        data = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = per_worker(
            "bpe", ("encode", vocabulary, pattern), lambda: text_ids(ranks_of(data.value), pattern)
        )
        for batch in slices(batches):
            ids = [encoder.encode(text) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch["doc_id"],
                    pa.array([len(i) // 4 for i in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "n_tokens", "ids"],
            )

    plain = id_and_text(docs, id_col, text_col)
    return plain.mapInArrow(run, f"doc_id {dict(plain.dtypes)['doc_id']}, n_tokens long, ids binary")


def decode_ids(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """The encoded rows with `decoded`: the bytes that the ids stand for. Null ids: none."""
    with open(vocabulary, "rb") as file:
        data = encoded.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = per_worker("bpe", ("decode", vocabulary), lambda: Encoder(ranks_of(data.value)).tokens)
        find = tokens.__getitem__
        for batch in slices(batches):
            texts = [b"".join(map(find, array("I", ids or b""))) for ids in batch["ids"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(texts, pa.binary())], [*batch.schema.names, "decoded"]
            )

    names = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(run, f"{names}, decoded binary")
