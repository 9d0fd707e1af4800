"""Language by unigrams over pieces, with all segmentations of a word summed.

The pieces are those of a fixed public vocabulary. A language has a probability for each
piece, and a word's probability in it is the sum over all ways to cut the word into
pieces, which a forward algorithm finds for all languages at once. The probabilities
are learned by expectation maximisation: the expected use of each piece over all
segmentations of the words of documents whose language is known. The score of a text is
the posterior probability of the best language, from the words' sum of logarithms and
the languages' shares.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from contractlens.llm.common import id_and_text, per_worker, quoted, slices
from contractlens.session import cut_lineage

#: Training documents of each language at most, chosen by a hash of the id.
PER_LANGUAGE = 1_000
#: Rounds of expectation maximisation.
ROUNDS = 3
#: Letters of a piece at most, its word's start included.
LONGEST_PIECE = 10
#: Languages that are learned at most, the most frequent ones.
LANGUAGES = 256
#: Letters of a word that is learned from, or scored beside others of its length.
USUAL_LETTERS = 40
#: Words that a worker keeps in mind.
KEPT_WORDS = 300_000
#: Letters of words kept in mind.
KEPT_IN_ALL = 4 << 20
#: Places of a word, and letters of a text, that are looked at together, so that those of
#: any length need bounded memory.
STRETCH, PART = 4096, 1 << 20
#: Weight of all languages' pieces in each language's, in pieces.
SMOOTHING = 50.0
#: What a word starts with in the vocabulary.
MARK = "▁"
UNKNOWN = "und"
WORD, BETWEEN = re.compile(r"[^\W\d_]+"), re.compile(r"[\W\d_]")


class Pieces:
    """The vocabulary's pieces of letters; number 0 stands for any letter without one.

    They are kept as a trie in sorted arrays, so that all places of many words walk down it
    side by side: `steps` holds node * letters + letter, `nodes` the node it leads to.
    """

    def __init__(self, tokens: list[str]):
        lower = {t.lower() for t in tokens if t.strip(MARK).isalpha() and MARK not in t[1:]} | {MARK}
        kept = sorted(t for t in lower if len(t) <= LONGEST_PIECE)
        self.numbers = {t: i for i, t in enumerate(kept, 1)}
        self.letters = np.array(sorted({ord(c) for t in kept for c in t}), np.int64)
        prefixes = sorted({t[:n] for t in kept for n in range(len(t) + 1)}, key=lambda t: (len(t), t))
        node = {t: i for i, t in enumerate(prefixes)}
        steps = sorted(
            (node[t[:-1]] * len(self.letters) + int(np.searchsorted(self.letters, ord(t[-1]))), i)
            for t, i in node.items() if t
        )
        self.steps, self.nodes = (np.array(column, np.int64) for column in zip(*steps, strict=True))
        self.piece = np.array([self.numbers.get(t, -1) for t in prefixes], np.int32)

    def __len__(self) -> int:
        return len(self.numbers) + 1

    def grid(self, words: list[str]) -> np.ndarray:
        """Of words of one length, by word, place and length - 1: the number of the piece
        that starts there; -1 if none does. A single letter without a piece is number 0."""
        count, n = len(words), len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
        letter = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        letter[self.letters[letter] != codes] = -1
        out = np.full((count * n, LONGEST_PIECE), -1, np.int32)
        places, node = np.arange(count * n), np.zeros(count * n, np.int64)
        for size in range(min(LONGEST_PIECE, n)):
            inside = places % n + size < n
            places, node = places[inside], node[inside]
            step = node * len(self.letters) + letter[places + size]
            found = np.minimum(np.searchsorted(self.steps, step), len(self.steps) - 1)
            there = (self.steps[found] == step) & (letter[places + size] >= 0)
            places, node = places[there], self.nodes[found[there]]
            out[places, size] = self.piece[node]
        out[out[:, 0] < 0, 0] = 0
        return out.reshape(count, n, LONGEST_PIECE)


def vocabulary_pieces(path: str) -> list[str]:
    """The tokens of a sentencepiece model."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())]


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case."""
    found = WORD.findall(text.lower())
    if all(map(str.isalpha, found)):
        return found
    # numerals that are neither digits nor letters
    return "".join(c if c.isalpha() else " " for c in " ".join(found)).split()


def parts_of(text: str) -> Iterator[str]:
    """The text, cut between words where it is long."""
    at = 0
    while at < len(text):
        cut = BETWEEN.search(text, at + PART)
        stop = cut.start() if cut else len(text)
        yield text[at:stop]
        at = stop


def _grid(pieces: Pieces, words: list[str]) -> np.ndarray:
    """The pieces of words of one length, with the sign of a word's start before them."""
    return pieces.grid([MARK + word for word in words])


def _logsum(parts: list[np.ndarray]) -> np.ndarray:
    """Logarithm of the sum of numbers given by their logarithms."""
    stack = np.stack(parts)
    top = stack.max(axis=0)
    return top + np.log(np.exp(stack - top).sum(axis=0))


def forward(grid: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """By place (0 to n), word and language: logarithm of the sum over all segmentations of
    the letters before. logs: piece, language; the last row, for no piece, is -inf."""
    count, n, longest = grid.shape
    out = np.full((n + 1, count, logs.shape[1]), -np.inf)
    out[0] = 0.0
    for stop in range(1, n + 1):
        sizes = range(1, min(longest, stop) + 1)
        out[stop] = _logsum([out[stop - size] + logs[grid[:, stop - size, size - 1]] for size in sizes])
    return out


def backward(grid: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """The same for the letters after each place."""
    count, n, longest = grid.shape
    out = np.full((n + 1, count, logs.shape[1]), -np.inf)
    out[n] = 0.0
    for start in range(n - 1, -1, -1):
        sizes = range(1, min(longest, n - start) + 1)
        out[start] = _logsum([out[start + size] + logs[grid[:, start, size - 1]] for size in sizes])
    return out


def long_word(pieces: Pieces, word: str, logs: np.ndarray) -> np.ndarray:
    """The forward algorithm over a word of any length, a stretch of places at a time."""
    marked = MARK + word
    held = [np.zeros(logs.shape[1])]  # of the last places, the latest last
    for at in range(0, len(marked), STRETCH):
        head = max(0, at - LONGEST_PIECE + 1)
        table = pieces.grid([marked[head : at + STRETCH]])[0]
        for stop in range(at + 1, min(at + STRETCH, len(marked)) + 1):
            sizes = range(1, min(LONGEST_PIECE, stop) + 1)
            held.append(_logsum([held[-size] + logs[table[stop - size - head, size - 1]] for size in sizes]))
            held = held[-LONGEST_PIECE:]
    return held[-1]


def by_length(words: list[str]) -> Iterator[list[int]]:
    """Places of the words of each length, a few thousand letters at a time."""
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    held: list[int] = []
    for i in order:
        if held and (len(words[held[0]]) != len(words[i]) or len(held) * (len(words[i]) + 1) >= 1 << 15):
            yield held
            held = []
        held.append(i)
    if held:
        yield held


@dataclass
class Model:
    """Piece probabilities by language, as logarithms, and the languages' shares."""

    tokens: list[str]
    languages: list[str]
    logs: np.ndarray
    shares: np.ndarray


class Scorer:
    """Word scores of a model, kept in mind in a table of bounded size."""

    def __init__(self, model: Model):
        self.model, self.pieces = model, Pieces(model.tokens)
        self._forget()

    def _forget(self) -> None:
        self.places: dict[str, int] = {}
        self.letters, self.scores = 0, np.zeros((0, len(self.model.languages)))

    def word_scores(self, words: list[str]) -> np.ndarray:
        logs = self.model.logs
        out = np.zeros((len(words), logs.shape[1]))
        for some in by_length(words):
            if len(words[some[0]]) > USUAL_LETTERS:
                for i in some:
                    out[i] = long_word(self.pieces, words[i], logs)
            else:
                out[some] = forward(_grid(self.pieces, [words[i] for i in some]), logs)[-1]
        return out

    def _learn(self, words: set[str]) -> None:
        if len(self.places) > KEPT_WORDS or self.letters > KEPT_IN_ALL:
            self._forget()
        new = sorted(words.difference(self.places))
        self.places.update(zip(new, range(len(self.places), len(self.places) + len(new)), strict=True))
        self.scores = np.concatenate([self.scores, self.word_scores(new)]) if new else self.scores
        self.letters += sum(map(len, new))

    def text_scores(self, texts: list[str]) -> tuple[list[bool], np.ndarray]:
        """By text: whether it has a letter, and the languages' sums of logarithms."""
        parts = [(i, part) for i, text in enumerate(texts) for part in parts_of(text)]
        worded, out = [False] * len(texts), np.zeros((len(texts), len(self.model.languages)))
        held: list[tuple[int, list[str]]] = []
        size = 0
        for at, (i, part) in enumerate(parts):
            held.append((i, words_of(part)))
            size += len(part)
            if size >= PART or at == len(parts) - 1:
                self._learn({word for _, words in held for word in words})
                for i, words in held:
                    if words:
                        places = np.fromiter(map(self.places.__getitem__, words), np.int64, len(words))
                        out[i] += self.scores[places].sum(axis=0)
                        worded[i] = True
                held, size = [], 0
        return worded, out


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from. Rows without an id are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_documents(docs: DataFrame, per_language: int, languages: int = LANGUAGES) -> DataFrame:
    """lang and text of at most `per_language` documents of each of the most frequent
    languages, spread evenly; docs: doc_id, text, lang.

    Rows are told apart by a hash of id and text, so repeated rows are one. A share that is
    a little too large cuts the hashes down before they are ranked.
    """
    rows = docs.filter("lang IS NOT NULL AND text IS NOT NULL").filter(~held_out(F.col("doc_id")))
    rows = rows.withColumn("mark", F.xxhash64("doc_id", "text"))
    marks = cut_lineage(rows.select("lang", "mark").distinct())
    counts = marks.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
    share = F.least(F.lit(1.0), (2.0 * per_language + 20.0) / F.col("n"))
    few = marks.join(F.broadcast(counts), "lang").filter(
        F.pmod(F.col("mark"), F.lit(1 << 30)) < share * (1 << 30)
    )
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod(F.col("mark"), F.lit(1 << 30)), "mark"))
    # at most `per_language` times `languages` rows
    chosen = cut_lineage(few.withColumn("rank", rank).filter(F.col("rank") <= per_language).select("lang", "mark"))
    found = rows.join(F.broadcast(chosen), ["lang", "mark"], "left_semi")
    return found.groupBy("lang", "mark").agg(F.min("text").alias("text")).select("lang", "text")


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word and n of lang and text, for words of the usual lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found: Counter[tuple[str, str]] = Counter()
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                found.update((lang, word) for word in words_of(text) if len(word) <= USUAL_LETTERS)
            names = [pa.array([key[i] for key in found], pa.string()) for i in range(2)]
            yield pa.RecordBatch.from_arrays(
                [*names, pa.array(list(found.values()), pa.int64())], ["lang", "word", "n"]
            )

    counts = texts.mapInArrow(run, "lang string, word string, n long")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected_uses(pieces: Pieces, words: list[str], counts: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """How often each piece is used by these words of one language, over all their
    segmentations. logs has one column."""
    uses = np.zeros(len(logs))
    for some in by_length(words):
        grid = _grid(pieces, [words[i] for i in some])
        before, after = forward(grid, logs)[:, :, 0], backward(grid, logs)[:, :, 0]
        word, start, size = np.nonzero(grid >= 0)
        numbers = grid[word, start, size]
        weight = np.exp(before[start, word] + logs[numbers, 0] + after[start + size + 1, word] - before[-1, word])
        uses += np.bincount(numbers, weight * counts[some][word], minlength=len(logs))
    return uses


def probabilities(uses: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Logarithms by piece and language, with a last row for no piece. uses: piece,
    language. What all languages use is mixed in, and no piece is impossible."""
    every = uses.sum(axis=1, keepdims=True) + 0.01
    mixed = uses + smoothing * every / every.sum()
    logs = np.log(mixed / mixed.sum(axis=0, keepdims=True))
    return np.concatenate([logs, np.full((1, logs.shape[1]), -np.inf)])


def _round(counts: DataFrame, model: Model) -> np.ndarray:
    """Expected uses by piece and language under the model, summed over all tasks."""
    shared = counts.sparkSession.sparkContext.broadcast(model)
    size = len(model.logs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        pieces, total = Pieces(held.tokens), np.zeros((size, len(held.languages)))
        for batch in slices(batches, rows=4096):
            langs = np.array(batch["lang"].to_pylist(), object)
            words, n = np.array(batch["word"].to_pylist(), object), batch["n"].to_numpy()
            for number, lang in enumerate(held.languages):
                own = langs == lang
                if own.any():
                    total[:, number] += expected_uses(pieces, words[own].tolist(), n[own], held.logs[:, [number]])
        piece, lang = np.nonzero(total)
        columns = [pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang], pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["piece", "lang", "uses"])

    sums = counts.mapInArrow(run, "piece int, lang int, uses double").groupBy("piece", "lang").agg(F.sum("uses").alias("uses"))
    found = sums.toArrow()  # at most pieces times languages
    uses = np.zeros((size, len(model.languages)))
    uses[found["piece"].to_numpy(), found["lang"].to_numpy()] = found["uses"].to_numpy()
    return uses[:-1]


def fit(
    docs: DataFrame, vocabulary: str, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> Model | None:
    """Piece probabilities of each language by expectation maximisation; None if no
    document tells a language.

    Learned from documents that are not held out: `per_language` texts of each language at
    most, whose words are counted before the rounds. The shares of the languages come
    from all documents that may be learned from. What the driver sees is bounded by the
    vocabulary and the languages.
    """
    rows = docs.select(
        F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"),
        F.col(quoted(lang_col)).cast("string").alias("lang"),
    )
    counts = cut_lineage(word_counts(training_documents(rows, per_language)))
    usable = rows.filter("lang IS NOT NULL").filter(~held_out(F.col("doc_id")))
    known = counts.select("lang").distinct()
    shares = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).join(known, "lang", "left_semi").collect()
    if not shares:
        return None
    tokens = vocabulary_pieces(vocabulary)
    shares.sort(key=lambda r: r.lang)
    n = np.array([r.n for r in shares], float)
    start = probabilities(np.ones((len(Pieces(tokens)), len(shares))))
    model = Model(tokens, [r.lang for r in shares], start, np.log(n / n.sum()))
    for _ in range(rounds):
        model.logs = probabilities(_round(counts, model))
    return model


def identify_languages(
    docs: DataFrame, vocabulary: str, per_language: int = PER_LANGUAGE, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document.

    lang_pred is the language with the greatest posterior probability (of equal ones the
    first by name), score that probability. Only texts enter a prediction. `vocabulary` is
    the path of a sentencepiece model, read on the driver.

    Defined cases: a text that is null or has no letter is `und` with score 0, and so is
    every text if no document tells a language; letters that the vocabulary lacks count
    as one unknown letter; rows without an id are not held out; repeated rows are
    predicted each and learned from once; languages that are learned have a document with
    a word of at most 40 letters; further columns are left out; an empty table gives no
    rows.
    """
    spark = docs.sparkSession
    model = fit(docs, vocabulary, per_language, id_col=id_col, text_col=text_col, lang_col=lang_col)
    shared = spark.sparkContext.broadcast(model)
    name = "" if model is None else hashlib.sha256(model.logs.tobytes() + repr(model.languages).encode()).hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        for batch in slices(batches, rows=1024):
            found, scores = [UNKNOWN] * batch.num_rows, [0.0] * batch.num_rows
            if held is not None:
                scorer = per_worker("langid", (name,), lambda: Scorer(held))
                worded, sums = scorer.text_scores(batch["text"].to_pylist())
                sums += held.shares
                best = sums.argmax(axis=1)
                odds = np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
                for i in np.flatnonzero(worded):
                    found[i], scores[i] = held.languages[best[i]], float(1.0 / odds[i])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["held_out"], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"],
            )

    plain = id_and_text(docs, quoted(id_col), quoted(text_col))
    rows = plain.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(
        run, f"doc_id {dict(plain.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double"
    )
