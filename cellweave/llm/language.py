"""Language identification with segmentation-marginalised unigrams.

Every language has a probability for each piece of a fixed public vocabulary. The probability of a word is the sum over
all its segmentations into pieces, found by a forward pass over the word; a text is the product of its words. The
language with the highest probability wins, and the score is its posterior under equal priors.

Piece probabilities are fitted by expectation maximisation on a sample of labelled documents of bounded size
(``fit_documents`` per language, chosen by a hash of the id); one Spark task fits one language from its word counts.
Prediction reads every whole text in place: distinct words of a batch are scored together, and words already seen by
the task are looked up. Nothing is shuffled.

Words are runs of letters, in lower case, of any length: a word longer than ``_LONG`` is walked in stretches, and the sums
that pieces across the border need are carried over, so its probability is that of the whole. A letter outside the vocabulary
is one unknown piece. Only where pieces are learned are longer words counted in parts of ``_LONG``.

Defined cases: a null text or one without a letter is ``und`` with score 0; with no labelled row at all, every text is
``und``; ties between languages go to the smaller name; rows with a null language are never learned from; repeated rows
are judged each.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

UNKNOWN_LANGUAGE = "und"
WORD = regex.compile(r"\p{L}+")
_PLAIN = re.compile("[a-z]+")
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
_START = "▁"
# Words scored in one pass, the letters up to which words are scored together, the letters of a stretch of a longer one,
# words remembered by a task, and characters read at once.
_CHUNK, _LONG, _STRETCH, _REMEMBERED, _PORTION = 20_000, 64, 2048, 400_000, 1 << 20


@dataclass(frozen=True)
class Fit:
    """``vocabulary`` is the path of a sentencepiece model on the driver; at most ``fit_documents`` per language are learned from."""

    vocabulary: str = VOCABULARY
    fit_documents: int = 1500
    rounds: int = 4
    smoothing: float = 0.1


def read_pieces(path: str) -> list[str]:
    """The pieces that are plain text, in the order of the vocabulary."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]


class Lattice:
    """The pieces of words, and sums over all segmentations.

    Pieces are a tree over letters, walked for all places of many words at once: a step looks up (node, letter) in a
    sorted array and keeps the places that go on.
    """

    def __init__(self, pieces: list[str]):
        letters = [p for p in pieces if WORD.fullmatch(p.removeprefix(_START)) or p == _START]
        self.ids = {p: i for i, p in enumerate(dict.fromkeys(letters))}
        self.unknown = len(self.ids)
        self.size = self.unknown + 1
        self.longest = max(map(len, self.ids), default=1)
        alphabet = sorted({c for p in self.ids for c in p})
        self.letter = np.zeros(0x110000, dtype=np.int32)
        self.letter[[ord(c) for c in alphabet]] = np.arange(1, len(alphabet) + 1)
        self.letters = len(alphabet) + 1
        nodes = {"": 0} | {p: n for n, p in enumerate(sorted({p[:k] for p in self.ids for k in range(1, len(p) + 1)}), start=1)}
        edges = sorted((nodes[p[:-1]] * self.letters + int(self.letter[ord(p[-1])]), n, self.ids.get(p, -1)) for p, n in nodes.items() if p)
        self.keys, self.next, self.piece = (np.array([e[k] for e in edges] + [[2 ** 62, 0, -1][k]], dtype=np.int64) for k in range(3))

    def arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word, first place, last place and piece of every arc, in the order of the last and the first place."""
        return self._arcs([_START + w for w in words])

    def _arcs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        texts = np.array(words)
        places = texts.dtype.itemsize // 4
        marks = np.zeros((len(words), places + 1), dtype=np.int64)
        codes = texts.view(np.uint32).reshape(len(words), places)
        marks[:, :places] = self.letter[codes]
        w, i = np.nonzero(codes)
        single = np.zeros((len(words), places), dtype=bool)
        node, j = np.zeros(len(w), dtype=np.int64), i
        found = []
        while len(w):
            letter = marks[w, j]
            key = node * self.letters + letter
            at = np.searchsorted(self.keys, key)
            on = (self.keys[at] == key) & (letter > 0)
            w, i, j, at = w[on], i[on], j[on] + 1, at[on]
            node, piece = self.next[at], self.piece[at]
            whole = piece >= 0
            found.append((j[whole] << 51) | (i[whole] << 39) | (w[whole] << 17) | piece[whole])
            if len(found) == 1:
                single[w[whole], i[whole]] = True
            more = j < places
            w, i, j, node = w[more], i[more], j[more], node[more]
        w, i = np.nonzero(~single & (codes != 0))
        found.append(((i + 1) << 51) | (i << 39) | (w << 17) | self.unknown)
        table = np.sort(np.concatenate(found))
        return (table >> 17) & 0x3FFFFF, (table >> 39) & 0xFFF, table >> 51, table & 0x1FFFF

    @staticmethod
    def _steps(*keys: np.ndarray) -> Iterator[slice]:
        """Runs of equal keys: arcs between the same two places, of which a word has at most one."""
        change = np.zeros(max(0, len(keys[0]) - 1), dtype=bool)
        for k in keys:
            change |= k[1:] != k[:-1]
        cuts = np.flatnonzero(np.r_[True, change])
        yield from (slice(a, b) for a, b in zip(cuts, np.r_[cuts[1:], len(keys[0])], strict=True))

    def forward(self, words: list[str], prob: np.ndarray) -> tuple:
        """Sums up to each place. Every eighth place, the places still in reach are scaled; the log of the whole comes first."""
        n = np.array([len(w) + 1 for w in words])
        w, i, j, piece = arcs = self.arcs(words)
        alpha = np.zeros((n.max() + 1, len(words), prob.shape[1]))
        alpha[0] = 1
        scale = np.zeros((n.max() + 1, len(words)))
        now = np.zeros(len(words))
        last = 0
        for s in self._steps(j, i):
            a, b = i[s.start], j[s.start]
            if b != last:
                if last % 8 == 0 and last:
                    peak = alpha[last].max(axis=1)
                    peak[peak == 0] = 1
                    reach = slice(max(0, last - self.longest), last + 1)
                    alpha[reach] /= peak[:, None]
                    now = now + np.log(peak)
                    scale[reach] = now
                scale[b], last = now, b
            ww = w[s]
            alpha[b, ww] += alpha[a, ww] * prob[piece[s]]
        rows = np.arange(len(words))
        with np.errstate(divide="ignore"):
            return np.log(alpha[n, rows]) + scale[n, rows][:, None], alpha, scale, arcs, n

    def scores(self, words: list[str], prob: np.ndarray) -> np.ndarray:
        """Log probability of each word in each language; words of like length together, so that memory stays bounded."""
        out = np.zeros((len(words), prob.shape[1]))
        order = sorted((k for k in range(len(words)) if len(words[k]) <= _LONG), key=lambda k: len(words[k]))
        for k, word in enumerate(words):
            if len(word) > _LONG:
                out[k] = self.whole(word, prob)
        at = 0
        while at < len(order):
            some = order[at:at + _CHUNK]
            while len(some) > 1 and (len(words[some[-1]]) + 2) * len(some) > 32 * _CHUNK:
                some = some[:len(some) // 2]
            out[some] = self.forward([words[k] for k in some], prob)[0]
            at += len(some)
        return out

    def whole(self, word: str, prob: np.ndarray, stretch: int = _STRETCH) -> np.ndarray:
        """Log probability of one long word in each language, stretch by stretch.

        A stretch handles the pieces that begin in it. Those that reach beyond leave their sums at the next places, which
        are carried over. Each language is scaled by itself, since their sums drift apart.
        """
        text, reach = _START + word, self.longest
        carried = np.zeros((reach + 1, prob.shape[1]))
        carried[0] = 1
        logs = np.zeros(prob.shape[1])
        for start in range(0, len(text), stretch):
            peak = carried.max(axis=0)
            logs += np.log(peak)
            carried = carried / peak
            part = text[start:start + stretch + reach]
            own = min(stretch, len(text) - start)
            _, i, j, piece = self._arcs([part])
            i, j, piece = (x[i < own] for x in (i, j, piece))
            sums = np.zeros((own + reach + 1, prob.shape[1]))
            sums[:reach + 1] = carried
            for s in self._steps(j):
                b = int(j[s.start])
                sums[b] += (sums[i[s]] * prob[piece[s]]).sum(axis=0)
                if b % 8 == 0:
                    near = slice(max(0, b - reach), max(b, reach) + 1)
                    peak = sums[near].max(axis=0)
                    sums[near] /= peak
                    logs += np.log(peak)
            carried = sums[own:]
        return np.log(carried[0]) + logs

    def fit(self, counts: Counter, rounds: int, smoothing: float) -> np.ndarray:
        """Expectation maximisation of piece probabilities from word counts."""
        prob = np.full(self.size, 1.0 / self.size)
        words = sorted(counts, key=lambda w: (len(w), w))
        weight = np.array([counts[w] for w in words], dtype=float)
        for _ in range(rounds):
            expected = np.zeros(self.size)
            for start in range(0, len(words), _CHUNK):
                expected += self._expected(words[start:start + _CHUNK], weight[start:start + _CHUNK], prob)
            prob = expected + smoothing
            prob /= prob.sum()
        return prob

    def _expected(self, words: list[str], weight: np.ndarray, prob: np.ndarray) -> np.ndarray:
        """How often each piece is used, over all segmentations."""
        total, alpha, scale, (w, i, j, piece), n = self.forward(words, prob[:, None])
        with np.errstate(divide="ignore"):
            before = np.log(alpha[:, :, 0]) + scale
        after = np.full(before.shape, -np.inf)
        after[n, np.arange(len(words))] = 0
        order = np.lexsort((j, -i))
        w, i, j, piece = w[order], i[order], j[order], piece[order]
        log_prob = np.log(prob)
        for s in self._steps(i, j):
            ww, a, b = w[s], i[s.start], j[s.start]
            after[a, ww] = np.logaddexp(after[a, ww], after[b, ww] + log_prob[piece[s]])
        share = np.exp(before[i, w] + log_prob[piece] + after[j, w] - total[w, 0]) * weight[w]
        return np.bincount(piece, weights=share, minlength=self.size)


def letters_of(text: str | None) -> list[str]:
    """Words of a text."""
    lower = (text or "").lower()
    return _PLAIN.findall(lower) if lower.isascii() else WORD.findall(lower)


def parts_of(word: str) -> list[str]:
    """A word in parts of bounded length, as it is learned from."""
    return [word[s:s + _LONG] for s in range(0, len(word), _LONG)]


def portions(texts: list[str | None]) -> Iterator[list[str | None]]:
    """Texts in runs of a bounded number of characters, whose words are held at once; a longer text is a run of its own."""
    run, size = [], 0
    for text in texts:
        if run and size + len(text or "") > _PORTION:
            yield run
            run, size = [], 0
        run.append(text)
        size += len(text or "")
    if run:
        yield run


def sample(labelled: DataFrame, fit: Fit) -> DataFrame:
    """``lang, text`` of at most ``fit_documents`` documents of each language, those with the smallest hash of the id.

    Counts set a threshold for the hash first, so that only about the wanted rows are ranked.
    """
    rows = labelled.select("doc_id", "lang", "text").where("lang is not null and text is not null")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    near = rows.withColumn("place", place).join(F.broadcast(sizes) if sizes.limit(10_001).count() <= 10_000 else sizes, "lang").where(
        F.col("place") * F.col("n") < fit.fit_documents + 6 * fit.fit_documents ** 0.5 + 20)
    best = Window.partitionBy("lang").orderBy("place", "doc_id", "text")
    return near.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= fit.fit_documents).select("lang", "text")


def train(labelled: DataFrame, fit: Fit = Fit()) -> tuple[list[str], np.ndarray, list[str]]:
    """Languages, piece probabilities (pieces x languages) and the pieces they belong to."""
    spark = labelled.sparkSession
    pieces = read_pieces(fit.vocabulary)
    shared = spark.sparkContext.broadcast(pieces)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                seen: Counter = Counter()
                for text in texts:
                    seen.update(part for word in letters_of(text) for part in parts_of(word))
                if seen:
                    yield pd.DataFrame({"lang": lang, "word": list(seen), "n": list(seen.values())})

    def fitted(rows: pd.DataFrame) -> pd.DataFrame:
        lattice = Lattice(shared.value)
        prob = lattice.fit(Counter(dict(zip(rows["word"], rows["n"], strict=True))), fit.rounds, fit.smoothing)
        return pd.DataFrame({"lang": [rows["lang"].iloc[0]], "prob": [prob.tolist()]})

    words = (sample(labelled, fit).repartition(24).mapInPandas(counted, "lang string, word string, n bigint")
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    models = words.groupBy("lang").applyInPandas(fitted, "lang string, prob array<double>").collect()
    models = sorted((r["lang"], r["prob"]) for r in models)
    prob = np.array([p for _, p in models]).T if models else np.zeros((Lattice(pieces).size, 0))
    return [lang for lang, _ in models], prob, pieces


def predicted(docs: DataFrame, labelled: DataFrame, text: str = "text", fit: Fit = Fit()) -> DataFrame:
    """All columns of ``docs`` packed as ``doc``, with ``lang_pred`` and ``score``.

    ``labelled`` has ``doc_id, lang, text``; nothing but the text is an input of a prediction.
    """
    languages, prob, pieces = train(labelled, fit)
    shared = docs.sparkSession.sparkContext.broadcast((languages, prob, pieces))

    @F.pandas_udf("lang_pred string, score double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        languages, prob, pieces = shared.value
        lattice = Lattice(pieces)
        known: dict[str, int] = {}
        table = np.zeros((0, len(languages)))
        for texts in batches:
            picks, best = [], []
            for some in portions(list(texts)):
                counts = [Counter(letters_of(t)) for t in some]
                if len(known) > _REMEMBERED:
                    known, table = {}, table[:0]
                new = list(dict.fromkeys(w for c in counts for w in c if w not in known)) if languages else []
                if new:
                    known.update(zip(new, range(len(table), len(table) + len(new)), strict=True))
                    table = np.concatenate([table, lattice.scores(new, prob)])
                for c in counts:
                    if not c or not languages:
                        picks.append(UNKNOWN_LANGUAGE)
                        best.append(0.0)
                        continue
                    rows = np.fromiter(map(known.__getitem__, c), dtype=np.int64, count=len(c))
                    total = np.fromiter(c.values(), dtype=float, count=len(c)) @ table[rows]
                    share = np.exp(total - total.max())
                    at = int(share.argmax())
                    picks.append(languages[at])
                    best.append(float(share[at] / share.sum()))
            yield pd.DataFrame({"lang_pred": picks, "score": best})

    row: Column = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.select(row.alias("doc"), judge(F.col(f"`{text}`")).alias("judged")).select("doc", "judged.*")


def held_out(doc_id: Column) -> Column:
    """A third of the documents, by a checksum of the id, that is never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def in_a_language(docs: DataFrame, labelled: DataFrame, least: float = 0.5, fit: Fit = Fit()) -> DataFrame:
    """The documents in which a language is found with a score of at least ``least``, with all their columns."""
    return predicted(docs, labelled, fit=fit).where((F.col("lang_pred") != UNKNOWN_LANGUAGE) & (F.col("score") >= least)).select("doc.*")
