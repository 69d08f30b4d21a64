"""Language identification by unigram pieces, summed over all segmentations.

Each language gives every piece of a fixed public vocabulary a probability. A word's probability is the sum over
all ways to cut it into pieces, by the forward algorithm; a text's is the product over its words (runs of
letters, lower-case, marked at their beginning as the vocabulary marks them). The language that makes the whole
text likeliest is its prediction.

The probabilities are fitted by expectation-maximisation, whose expected counts also sum over all
segmentations, on word counts of a bounded sample: about ``PER_LANGUAGE`` documents of each language, drawn by a
hash of the id at a rate from that language's count, and the most frequent words of each language, an equal share
of ``WORDS`` for every one. Words, not documents, come to the driver. Scoring covers every document and every letter
of it, with all pieces of the vocabulary that consist of lower-case letters, of whatever length. A worker scores a
word once and remembers it; the forward pass runs in numpy over all new words of a batch at once, and in logarithms
over a word of more than ``LONGEST`` letters, which is summed over whole, too.

Defined cases: null texts and texts without a letter give ``und`` and score 0; so does every text if no document
can be learnt from; equal rows get equal results; an empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sheafwork.llm.common import held, held_out, map_arrow

PER_LANGUAGE, WORDS = 400, 150_000
#: Letters of a word, with its mark, up to which probabilities can't underflow; beyond, logarithms are summed.
LONGEST = 30
#: Probability of a letter that the vocabulary lacks, in every language.
UNKNOWN = 1e-7
#: Expected counts that every piece has beforehand.
PRIOR = 0.02
ROUNDS = 3
#: Words whose scores a worker remembers; beyond that, it starts afresh.
REMEMBERED = 200_000
LETTERS = re.compile(r"[^\W\d_]+")
MARK = "▁"
_BASE, _SPREAD = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xD6E8FEB86659FD93)
_BITS = 18


class Pieces:
    """The vocabulary's pieces of lower-case letters, found by a hash of code points in a numpy table."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = (model.id_to_piece(k) for k in range(model.get_piece_size()))
        self.pieces = [p for p in every if p == p.lower() and LETTERS.fullmatch(p.removeprefix(MARK) or "a")]
        self.longest = max(map(len, self.pieces), default=1)
        self.powers = np.cumprod(np.full(max(LONGEST, self.longest) + 3, _BASE, dtype=np.uint64))
        hashes = np.zeros(len(self.pieces), dtype=np.uint64)
        for length in range(1, self.longest + 1):
            own = [k for k, p in enumerate(self.pieces) if len(p) == length]
            if own:
                hashes[own] = self.prefixes([self.pieces[k] for k in own], length)[length]
        self.keys, self.values = np.zeros(1 << _BITS, dtype=np.uint64), np.full(1 << _BITS, -1, dtype=np.int32)
        self.reach = 1
        for k, (slot, h) in enumerate(zip(self.slots(hashes).tolist(), hashes, strict=True)):
            steps = 1
            while self.values[slot] >= 0:
                slot, steps = (slot + 1) % (1 << _BITS), steps + 1
            self.keys[slot], self.values[slot] = h, k
            self.reach = max(self.reach, steps)

    @staticmethod
    def slots(hashes: np.ndarray) -> np.ndarray:
        return ((hashes * _SPREAD) >> np.uint64(64 - _BITS)).astype(np.int64)

    def prefixes(self, words: list[str], length: int) -> list[np.ndarray]:
        """Hashes of the first 0, 1, ... letters of words of one length."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4").reshape(len(words), length).astype(np.uint64)
        out = [np.zeros(len(words), dtype=np.uint64)]
        for k in range(length):
            out.append(out[-1] * _BASE + letters[:, k] + np.uint64(1))
        return out

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Index of each piece, -1 where there is none."""
        slot = self.slots(hashes)
        out = np.where(self.keys[slot] == hashes, self.values[slot], -1)
        for _ in range(self.reach - 1):
            slot = (slot + 1) & ((1 << _BITS) - 1)
            out = np.where(self.keys[slot] == hashes, self.values[slot], out)
        return out

    def spans(self, words: list[str], length: int) -> list[list[tuple[int, np.ndarray]]]:
        """For each end, the (start, piece of each word) that end there."""
        prefix = self.prefixes(words, length)
        return [[(i, self.find(prefix[j] - prefix[i] * self.powers[j - i - 1])) for i in range(max(0, j - self.longest), j)] for j in range(1, length + 1)]

    def ends(self, word: str) -> list[list[tuple[int, int]]]:
        """For each end in a long word, the (start, piece) that end there; -1 for a letter that is no piece."""
        letters = np.frombuffer(word.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        n, out = len(letters), [[] for _ in letters]
        power, inverse = (np.cumprod(np.full(n, x, dtype=np.uint64)) for x in (_BASE, np.uint64(pow(int(_BASE), -1, 1 << 64))))
        summed = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * inverse)])
        for size in range(1, min(self.longest, n) + 1):
            piece = self.find((summed[size:] - summed[:-size]) * power[size - 1 :])
            for i in (np.arange(n) if size == 1 else np.flatnonzero(piece >= 0)).tolist():
                out[i + size - 1].append((i, int(piece[i])))
        return out


def _by_length(words: list[str]) -> dict[int, list[int]]:
    out: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        out.setdefault(len(w), []).append(k)
    return out


def forward(spans: list[list[tuple[int, np.ndarray]]], chances: np.ndarray) -> list[np.ndarray]:
    """Summed probability of the first 0, 1, ... letters, by language. The last row of chances is for unknown letters."""
    n, languages = len(spans[0][0][1]), chances.shape[1]
    alpha = [np.ones((n, languages))]
    for ends in spans:
        total = np.zeros((n, languages))
        for i, piece in ends:
            if i == len(alpha) - 1:
                total += alpha[i] * chances[piece]  # -1 is the last row
            else:
                own = np.flatnonzero(piece >= 0)
                total[own] += alpha[i][own] * chances[piece[own]]
        alpha.append(total)
    return alpha


def long_forward(ends: list[list[tuple[int, int]]], chances: np.ndarray) -> np.ndarray:
    """Logarithm of the summed probability of the first 0, 1, ... letters of a long word, by language."""
    logs = np.log(chances)
    alpha = np.zeros((len(ends) + 1, chances.shape[1]))
    for j, found in enumerate(ends, 1):
        each = [alpha[i] + logs[piece] for i, piece in found]
        alpha[j] = each[0] if len(each) == 1 else np.logaddexp.reduce(each)
    return alpha


def log_chances(pieces: Pieces, words: list[str], chances: np.ndarray) -> np.ndarray:
    """Log probability of every word in every language."""
    out = np.zeros((len(words), chances.shape[1]))
    for length, own in _by_length(words).items():
        if length <= LONGEST:
            out[own] = np.log(forward(pieces.spans([words[k] for k in own], length), chances)[-1])
        else:
            out[own] = [long_forward(pieces.ends(words[k]), chances)[-1] for k in own]
    return out


def _long_counts(ends: list[list[tuple[int, int]]], chances: np.ndarray, weight: np.ndarray, expected: np.ndarray) -> None:
    """Adds a long word's expected pieces, as often as it stands in each language."""
    logs, alpha = np.log(chances), long_forward(ends, chances)
    beta = np.full_like(alpha, -np.inf)
    beta[-1] = 0
    for j in range(len(ends), 0, -1):
        for i, piece in ends[j - 1]:
            through = logs[piece] + beta[j]
            beta[i] = np.logaddexp(beta[i], through)
            expected[piece] += weight * np.exp(alpha[i] + through - alpha[-1])


def fit(pieces: Pieces, counts: dict[str, dict[str, float]], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and, by piece and language, probabilities, from word counts by language."""
    languages = sorted(counts)
    words = sorted(set().union(*(counts[x] for x in languages)))
    weight = np.array([[counts[x].get(w, 0.0) for x in languages] for w in words]).reshape(len(words), len(languages))
    n = len(pieces.pieces)
    chances = np.vstack([np.full((n, len(languages)), 1 / n), np.full((1, len(languages)), UNKNOWN)])
    groups = [(np.array(own), pieces.spans([words[k] for k in own], length)) for length, own in _by_length(words).items() if length <= LONGEST]
    long = [(k, pieces.ends(w)) for k, w in enumerate(words) if len(w) > LONGEST]
    for _ in range(rounds):
        expected = np.full((n + 1, len(languages)), PRIOR)
        for own, spans in groups:
            alpha = forward(spans, chances)
            beta = [np.zeros_like(alpha[0]) for _ in alpha]
            beta[-1] = weight[own] / alpha[-1]
            for j in range(len(spans), 0, -1):
                for i, piece in spans[j - 1]:
                    found = np.flatnonzero((piece >= 0) | (i == j - 1))
                    through = chances[piece[found]] * beta[j][found]
                    beta[i][found] += through
                    through *= alpha[i][found]
                    for k in range(len(languages)):
                        expected[:, k] += np.bincount(piece[found] % (n + 1), through[:, k], n + 1)
        for k, ends in long:
            _long_counts(ends, chances, weight[k], expected)
        chances[:n] = expected[:n] / expected[:n].sum(axis=0)
    return languages, chances


def word_counts(docs: DataFrame, per_language: int = PER_LANGUAGE, words: int = WORDS) -> dict[str, dict[str, float]]:
    """Word counts by language of a bounded sample of labelled documents."""
    learn = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where(F.col("lang").isNotNull() & ~held_out("doc_id", 4, 2))
    sizes = {r[0]: r[1] for r in learn.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return {}
    rate = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))])
    chosen = learn.where((F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("languages")) / float(1 << 64) + 0.5) < rate[F.col("lang")])
    spelt = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), F.lit(1)))
    counted = chosen.select("lang", spelt.alias("word")).groupBy("lang", "word").count()
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("count"), "word"))  # words of the sample, which is bounded
    most = counted.withColumn("place", place).where(F.col("place") <= max(1, words // len(sizes)))
    out: dict[str, dict[str, float]] = {k: {} for k in sizes}
    for r in most.collect():  # at most ``words`` rows, or one a language
        out[r["lang"]][MARK + r["word"]] = float(r["count"])
    return {k: v for k, v in out.items() if v}


class Scorer:
    """Scores whole texts; remembers words. Lives in one worker."""

    def __init__(self, path: str, languages: list[str], chances: np.ndarray):
        self.pieces, self.languages, self.chances = Pieces(path), languages, chances
        self.known: dict[str, int] = {}
        self.rows = np.zeros((1024, len(languages)))

    def learn(self, words: list[str]) -> None:
        scores = log_chances(self.pieces, [MARK + w for w in words], self.chances)
        n = len(self.known)
        if n + len(words) > len(self.rows):
            self.rows = np.vstack([self.rows[:n], np.zeros((max(len(words), REMEMBERED // 4), len(self.languages)))])
        self.rows[n : n + len(words)] = scores
        self.known.update(zip(words, range(n, n + len(words)), strict=True))

    def score(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.known) > REMEMBERED:
            self.known, self.rows = {}, np.zeros((1024, len(self.languages)))
        spelt = [LETTERS.findall(t.lower()) if t else [] for t in texts]
        new = set().union(*spelt) - self.known.keys()
        if new and self.languages:
            self.learn(sorted(new))
        out = []
        for words in spelt:
            if not any(c.isalpha() for w in words for c in w) or not self.languages:  # the first word decides but for odd numerals
                out.append(("und", 0.0))
                continue
            total = self.rows[np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))].sum(axis=0)
            best = int(total.argmax())
            out.append((self.languages[best], float(1 / np.exp((total - total[best]) / len(words) ** 0.5).sum())))
        return out


class Judge:
    """Predicts batches of texts in a worker that keeps its scorer from task to task."""

    def __init__(self, docs: DataFrame, path: str, per_language: int = PER_LANGUAGE):
        counts = word_counts(docs, per_language)
        fitted = fit(Pieces(path), counts) if counts else ([], np.zeros((0, 0)))
        self.path, self.shared = path, docs.sparkSession.sparkContext.broadcast(fitted)  # pieces x languages: bounded by the vocabulary

    def __call__(self, texts: pa.Array) -> list[tuple[str, float]]:
        fitted = self.shared.value
        scorer = held("languages", fitted, lambda: Scorer(self.path, *fitted))
        return [x for k in range(0, len(texts), 500) for x in scorer.score(texts[k : k + 500].to_pylist())]


def identify(docs: DataFrame, path: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score: the chance of the predicted language, evened by the root of the words."""
    judge = Judge(docs, path, per_language)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = judge(batch.column(2))
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([n for n, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    own = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out("doc_id", 4, 2).alias("held_out"), F.col("text").cast("string").alias("text"))
    return map_arrow(own, run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def accepted(docs: DataFrame, path: str, per_language: int = PER_LANGUAGE) -> DataFrame:
    """The rows whose language can be told (not ``und``), all columns as they are."""
    judge, place = Judge(docs, path, per_language), docs.columns.index("text")
    return map_arrow(docs, lambda batch: batch.filter(pa.array([n != "und" for n, _ in judge(batch.column(place))], pa.bool_())), docs.schema)
