"""Reading level of each document (problem 9): regularised ordinal regression, calibrated to graded texts."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import kernels as K
from tidewright.llm.language import FUNCTION_WORDS, detect_block
from tidewright.operators.quality import order_statistics
from tidewright.runtime import materialize

#: Graded documents used for fitting, at most; chosen by hash, so the choice does not depend on their order.
MOST_GRADED = 20_000
#: Words of running text below which a document has no level.
LEAST_WORDS = 25
#: Weight of the ridge penalty, and steps of the fit.
RIDGE, STEPS = 1e-3, 600
#: Words whose corpus-wide counts are kept one by one, the most frequent ones; all rarer words share their mean count.
MOST_WORDS = 1 << 18
#: Shares of the graded texts' sentences below the cut points that features count by: of words in a sentence, of their mean
#: length, and of the share of long words.
CUT_SHARES = (0.25, 0.5, 0.75)

#: Words that open or join clauses. Fixed values.
CONNECTIVES = (
    "although because unless whenever while which that since whereas until before after provided if when so than despite instead however therefore thus "
    "obwohl weil während wenn damit sobald nachdem bevor solange dass sodass indem obgleich falls danach daher deshalb trotzdem dennoch "
    "bien parce tandis lorsque quand lorsqu puisque afin malgré quoique dès après avant dont cependant toutefois "
    "aunque porque mientras cuando puesto hasta después antes luego además embargo desde cual cuyo "
)
#: Languages that are standardised by themselves; all others count as undecided.
_LANGUAGES = ("en", "de", "fr", "es", "zh", None)
_ENDS = ".!?…。！？"
_COMMAS = ",;:，；：、–—("

FEATURES = (
    "word_length", "word_length_spread", "long_8", "long_10", "long_12", "short_3", "sentence_words", "sentence_words_spread", "log_sentence_words", "sentences_short", "sentences_medium", "sentences_long",
    "commas", "connectives", "function_words", "diversity", "rarity", "sentence_word_length_low", "sentence_word_length_mid", "sentence_word_length_high", "sentence_long_words", "nested",
)


def running_text(text: Column) -> Column:
    """Text without code, log lines, headings, speaker names and markup; list items and paragraphs end a sentence."""
    plain = F.coalesce(text, F.lit(""))
    plain = F.when(plain.contains("```"), F.regexp_replace(plain, r"(?s)```.*?(?:```|\z)", "\n\n")).otherwise(plain)
    plain = F.regexp_replace(plain, r"(?m)^[ \t]*(?:#{1,6}[ \t].*|(?:TRACE|DEBUG|INFO|WARN|WARNING|ERROR|FATAL)\b.*|\[?\d{4}-\d\d-\d\d[T ].*|\d\d:\d\d:\d\d.*|(?:at |File \").*|[>$] ?\w+[_.]\w.*)$", "\n")
    plain = F.regexp_replace(plain, r"(?m)^[ \t]*(?:user|assistant|system|tool|tool_calls)[ \t]*:", "\n\n")
    return F.regexp_replace(plain, r"\n[ \t]*\n|\n[ \t]*(?:[-*•]|\d+[.)])[ \t]+", " . ")


@lru_cache(maxsize=1)
def _lists() -> tuple[np.ndarray, np.ndarray]:
    return K.hash_set(CONNECTIVES.split()), K.hash_set(" ".join(FUNCTION_WORDS[c] for c in _LANGUAGES[:4]).split())


@dataclass
class Rarity:
    """Logarithm of the corpus' words over the count of a word: by hash for the frequent ones, one value for all others."""

    word: np.ndarray
    value: np.ndarray
    other: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.word):
            return np.full(len(hashes), self.other)
        at = np.minimum(np.searchsorted(self.word, hashes), len(self.word) - 1)
        return np.where(self.word[at] == hashes, self.value[at], self.other)


@dataclass
class Cuts:
    """Cut points of sentences: words, mean length of a word, share of long words."""

    words: tuple[float, ...] = (7.0, 12.0, 18.0)
    length: tuple[float, ...] = (4.5, 5.5, 6.5)
    long: tuple[float, ...] = (0.1, 0.2, 0.3)


def _mean(values: np.ndarray, group: np.ndarray, groups: int, count: np.ndarray) -> np.ndarray:
    return np.bincount(group, weights=values, minlength=groups) / np.maximum(count, 1)


@dataclass
class Sentences:
    """Words of a block with their sentences."""

    w: K.Words
    size: np.ndarray
    begin: np.ndarray
    last: np.ndarray
    of: np.ndarray
    words: np.ndarray
    length: np.ndarray
    long: np.ndarray

    @classmethod
    def find(cls, text: K.Chars) -> Sentences:
        w = K.words(text, K.LETTER | K.MARK, split_han=True)
        size = (w.end - w.start).astype(np.float64)
        alnum = (text.kind & (K.LETTER | K.NUMBER)) > 0
        stop = K.marks(text, _ENDS) & ~np.append(alnum[1:], False)[: len(alnum)]
        sentence_of = np.cumsum(stop)[w.start]
        new = np.ones(len(w.doc), bool)
        new[1:] = (sentence_of[1:] != sentence_of[:-1]) | (w.doc[1:] != w.doc[:-1])
        of, begin = np.cumsum(new) - 1, np.flatnonzero(new)
        count = len(begin)
        last = np.append(begin[1:], len(new)) - 1
        words_in = np.bincount(of, minlength=count).astype(np.float64)
        total = np.maximum(words_in, 1)
        return cls(w, size, begin, last, of, words_in, np.bincount(of, weights=size, minlength=count) / total, np.bincount(of, weights=size >= 9, minlength=count) / total)


def features(text: K.Chars, rarity: Rarity, cuts: Cuts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, place of the language, feature matrix) of a block of running texts."""
    s = Sentences.find(text)
    w, size, begin, words_in, length_in = s.w, s.size, s.begin, s.words, s.length
    docs = text.docs
    n = K.per_doc(w.doc, docs)
    code = detect_block(text, w)[0]
    language = np.array([_LANGUAGES.index(c) if c in _LANGUAGES else len(_LANGUAGES) - 1 for c in code], np.int64)
    out = np.zeros((docs, len(FEATURES)))
    if not len(w.hash):
        return n, language, out
    count = len(begin)
    comma = np.cumsum(K.marks(text, _COMMAS))
    commas_in = (comma[w.start[s.last]] - comma[w.start[begin]]).astype(np.float64)
    connective, function = _lists()
    word, which = np.unique(w.hash, return_inverse=True)  # every distinct word is looked up once
    joins = K.member(word, connective).astype(np.float64)[which]
    joins_in = np.bincount(s.of, weights=joins, minlength=count)
    owner = w.doc[begin]
    sentences = np.bincount(owner, minlength=docs)
    by_word = lambda v: _mean(v, w.doc, docs, n)
    by_sentence = lambda v: np.bincount(owner, weights=v, minlength=docs) / np.maximum(sentences, 1)
    kept, kept_doc = K.distinct(w.hash, w.doc)
    mean_length = by_word(size)
    mean_words = by_sentence(words_in)
    columns = {
        "word_length": mean_length,
        "word_length_spread": np.sqrt(np.maximum(0, by_word(size * size) - mean_length**2)),
        "long_8": by_word(size >= 8), "long_10": by_word(size >= 10), "long_12": by_word(size >= 12), "short_3": by_word(size <= 3),
        "sentence_words": mean_words,
        "sentence_words_spread": np.sqrt(np.maximum(0, by_sentence(words_in**2) - mean_words**2)),
        "log_sentence_words": by_sentence(np.log(words_in)),
        "sentences_short": by_sentence(words_in <= cuts.words[0]), "sentences_medium": by_sentence((words_in > cuts.words[0]) & (words_in <= cuts.words[1])), "sentences_long": by_sentence(words_in > cuts.words[2]),
        "commas": by_sentence(commas_in), "connectives": by_sentence(joins_in), "function_words": by_word(K.member(word, function)[which]),
        "diversity": K.per_doc(kept_doc, docs) / np.sqrt(np.maximum(n, 1)),
        "rarity": by_word(rarity.of(word)[which]),
        "sentence_word_length_low": by_sentence(length_in < cuts.length[0]), "sentence_word_length_mid": by_sentence((length_in >= cuts.length[0]) & (length_in < cuts.length[1])), "sentence_word_length_high": by_sentence(length_in >= cuts.length[2]),
        "sentence_long_words": by_sentence(s.long >= cuts.long[2]), "nested": by_sentence((commas_in + joins_in >= 2) & (words_in > cuts.words[1])),
    }
    for k, name in enumerate(FEATURES):
        out[:, k] = columns[name]
    return n, language, out


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): the hash of every word of the corpus and how often it stands there, exactly, written once.

    Words are counted within a block and by a partial aggregate before the counts are shuffled; sums do not depend on how
    the texts are dealt out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, text in K.blocks(batch.column(0)):
                word, n = np.unique(K.words(text, K.LETTER | K.MARK).hash, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    return materialize(texts.mapInArrow(run, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n")), "words")


def rarities(counts: DataFrame, most: int = MOST_WORDS) -> Rarity:
    """Rarity of the at most ``most`` words that are more frequent than all others, and of the others by their mean count."""
    distinct, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not distinct:
        return Rarity(np.zeros(0, np.uint64), np.zeros(0), 0.0)
    bar = order_statistics(counts, F.col("n"), lambda n: [n - most - 1])[1][0] if distinct > most else 0.0
    kept = counts.where(F.col("n") > F.lit(bar)).toPandas()  # at most MOST_WORDS rows of two numbers
    word, n = kept["word"].to_numpy(np.int64).view(np.uint64), kept["n"].to_numpy(np.float64)
    order = np.argsort(word)
    others, rest = distinct - len(kept), total - int(n.sum())
    return Rarity(word[order], np.log(total / n[order]), math.log(total / (rest / others)) if others else math.log(total))


def sentence_cuts(graded: DataFrame) -> Cuts:
    """Cut points of sentences at :data:`CUT_SHARES` of the sentences of the graded texts, from histograms."""
    scale = {"words": 1.0, "length": 0.1, "long": 0.05}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, text in K.blocks(batch.column(0)):
                s = Sentences.find(text)
                for kind, values in (("words", s.words), ("length", s.length), ("long", s.long)):
                    place, n = np.unique(np.minimum(values / scale[kind] + 1e-9, 1000).astype(np.int64), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([kind] * len(place), pa.string()), pa.array(place), pa.array(n.astype(np.int64))], ["kind", "place", "n"])

    rows = graded.mapInArrow(run, "kind string, place bigint, n bigint").groupBy("kind", "place").agg(F.sum("n").alias("n")).toPandas()  # at most 1001 rows of each kind
    found = Cuts()
    for kind, part in rows.groupby("kind"):
        part = part.sort_values("place")
        reached = part["n"].cumsum().to_numpy() / part["n"].sum()
        setattr(found, kind, tuple(float(part["place"].to_numpy()[np.searchsorted(reached, share)]) * scale[kind] for share in CUT_SHARES))
    return found


@dataclass
class OrdinalModel:
    """Cumulative logits: P(level > k) = sigmoid(x w - cut[k]), with features standardised by language."""

    center: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    cut: np.ndarray

    def inputs(self, x: np.ndarray, language: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.center[language]) / self.scale[language], -6, 6)
        return np.concatenate([z, z * z / 4, np.eye(len(_LANGUAGES))[language]], axis=1)

    def level(self, x: np.ndarray, language: np.ndarray) -> np.ndarray:
        """1 for the easiest: one more than the number of cuts that the score passes."""
        return 1 + (self.inputs(x, language) @ self.weight[:, None] > self.cut[None, :]).sum(axis=1)


def fit(x: np.ndarray, language: np.ndarray, level: np.ndarray, levels: int = 4, ridge: float = RIDGE, steps: int = STEPS) -> OrdinalModel:
    """Fit by Adam on the ordinal log loss with a ridge penalty, every level weighing by the root of its count.

    A language with fewer than 20 graded texts is standardised like the whole.
    """
    center, scale = np.tile(x.mean(axis=0), (len(_LANGUAGES), 1)), np.tile(x.std(axis=0) + 1e-6, (len(_LANGUAGES), 1))
    for k in range(len(_LANGUAGES)):
        mine = x[language == k]
        if len(mine) >= 20:
            center[k], scale[k] = mine.mean(axis=0), mine.std(axis=0) + 0.05 * scale[k] + 1e-6
    model = OrdinalModel(center, scale, np.zeros(0), np.arange(levels - 1) - (levels - 2) / 2)
    z = model.inputs(x, language)
    target = (level[:, None] > np.arange(1, levels)[None, :]).astype(float)
    times = np.bincount(level, minlength=levels + 1)[level]
    importance = 1 / np.sqrt(times)
    importance = (importance / importance.sum())[:, None]
    theta = np.concatenate([np.zeros(z.shape[1]), model.cut])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    width = z.shape[1]
    for step in range(1, steps + 1):
        score = np.clip((z @ theta[:width])[:, None] - theta[None, width:], -30, 30)
        error = (1 / (1 + np.exp(-score)) - target) * importance
        gradient = np.concatenate([z.T @ error.sum(axis=1) + ridge * theta[:width], -error.sum(axis=0)])
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        theta = theta - 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return OrdinalModel(center, scale, theta[:width], np.sort(theta[width:]))


def feature_table(texts: DataFrame, rarity: Rarity, cuts: Cuts) -> DataFrame:
    """(doc_id, words, language, features) of every document, written once."""
    shared = texts.sparkSession.sparkContext.broadcast((rarity, cuts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, text in K.blocks(batch.column(1)):
                n, language, x = features(text, *shared.value)
                flat = pa.FixedSizeListArray.from_arrays(pa.array(x.astype(np.float32).ravel()), len(FEATURES)).cast(pa.list_(pa.float32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(n.astype(np.int32)), pa.array(language.astype(np.int32)), flat], ["doc_id", "words", "language", "features"])

    return materialize(texts.mapInArrow(run, "doc_id bigint, words int, language int, features array<float>"), "features")


def graded_documents(labels: DataFrame, most: int = MOST_GRADED) -> DataFrame:
    """(doc_id, level) of at most ``most`` graded documents, the same ones for the same labels."""
    graded = labels.where("doc_id is not null and reader_band between 1 and 4").groupBy("doc_id").agg(F.max("reader_band").alias("level"))
    return materialize(graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most), "graded")


def graded_sample(table: DataFrame, graded: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, language, level) of the graded documents with enough words."""
    rows = table.where(F.col("words") >= LEAST_WORDS).join(F.broadcast(graded), "doc_id").select("features", "language", "level", "doc_id").toPandas().sort_values("doc_id")
    if not len(rows):
        return np.zeros((0, len(FEATURES))), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.stack(rows["features"].to_numpy()).astype(float), rows["language"].to_numpy(np.int64), rows["level"].to_numpy(np.int64)


def reading_levels(documents: DataFrame, labels: DataFrame, most_graded: int = MOST_GRADED, least_words: int = LEAST_WORDS) -> DataFrame:
    """(doc_id, words, band): the reading level, 1 to 4, of each document with at least ``least_words`` of running text.

    Code, logs, headings, markup and capitals play no part. The model is fitted on at most ``most_graded`` graded
    documents, which also give the cut points of sentences; word rarity counts every word of the corpus exactly. Without
    any graded document there is no level to give and the result is empty. Null ids, and null, empty or shorter texts,
    have no row.
    """
    texts = documents.where("doc_id is not null").select(F.col("doc_id").cast("bigint").alias("doc_id"), running_text(F.col("text")).alias("_text"))
    graded = graded_documents(labels, most_graded)
    cuts = sentence_cuts(texts.join(F.broadcast(graded.select("doc_id")), "doc_id").select("_text"))  # at most MOST_GRADED rows
    table = feature_table(texts, rarities(word_counts(texts.select("_text"))), cuts)
    x, language, level = graded_sample(table, graded)
    if not len(level):
        return table.select("doc_id", "words", F.lit(None).cast("int").alias("band")).where(F.lit(False))
    model = fit(x, language, level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                values = batch.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)
                found = model.level(values, batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found.astype(np.int32))], ["doc_id", "words", "band"])

    return table.where(F.col("words") >= F.lit(least_words)).mapInArrow(run, "doc_id bigint, words int, band int")
