"""Repetition inside a single document, with verdicts by host (problem 3)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.llm import kernels as K
from tidewright.llm.common import arrow_map, label
from tidewright.runtime import broadcast_if_small, latest_by, materialize

WORD_RUN, HAN_RUN = 4, 8
#: A document fails a rule when this share of its words is repeated.
LIMITS = {"phrase": 0.30, "sentence": 0.30, "paragraph": 0.30}
#: A host is judged repetitive when its shrunken failure rate reaches this.
HOST_LIMIT = 0.5

_SENTENCE_END = np.array([ord(c) for c in ".!?。！？\n"], np.uint32)


def _cover(repeated_at: np.ndarray, size: int, count: int) -> np.ndarray:
    """True for the items that lie in one of the runs of ``size`` items starting at ``repeated_at``."""
    edge = np.zeros(count + size + 1, np.int32)
    np.add.at(edge, repeated_at, 1)
    np.add.at(edge, repeated_at + size, -1)
    return np.cumsum(edge)[:count] > 0


def _phrases(w: K.Words, chinese: np.ndarray) -> np.ndarray:
    """True for words inside a run that already occurred earlier in the same document."""
    covered = np.zeros(len(w.hash), bool)
    for size, chosen in ((WORD_RUN, ~chinese), (HAN_RUN, chinese)):
        at = np.flatnonzero(chosen[w.doc])
        found, first = K.runs(w.hash[at], w.doc[at], size)
        again = first[K.repeated(found, w.doc[at][first])]
        covered[at] = _cover(again, size, len(at))
    return covered


def _units(w: K.Words, cut: np.ndarray) -> np.ndarray:
    """True for words inside a unit (sentence or paragraph) whose words stood in the same order earlier in the document.

    ``cut`` counts the unit breaks up to each character.
    """
    part = cut[w.start]
    new = np.ones(len(part), bool)
    new[1:] = (part[1:] != part[:-1]) | (w.doc[1:] != w.doc[:-1])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(part)))
    place = (np.arange(len(part)) - np.repeat(begin, size)).astype(np.uint64)
    total = np.add.reduceat(K.mix(w.hash + place * np.uint64(0x9E3779B97F4A7C15)), begin)
    return np.repeat(K.repeated(K.mix(total + size.astype(np.uint64)), w.doc[begin]), size)


def shares(texts: pa.Array | pa.ChunkedArray) -> dict[str, np.ndarray]:
    """Words and the shares of repeated words by phrase, sentence and paragraph, for each text."""
    out: dict[str, list[np.ndarray]] = {"words": [], "phrase": [], "sentence": [], "paragraph": []}
    for _, _, text in K.blocks(texts):
        w = K.words(text, K.LETTER | K.MARK)
        n = K.per_doc(w.doc, text.docs)
        out["words"].append(n)
        if not len(w.hash):
            for rule in LIMITS:
                out[rule].append(np.zeros(text.docs))
            continue
        han = K.per_doc(w.doc, text.docs, (text.kind[w.start] & K.HAN) > 0)
        line = text.low == 10
        blank = np.zeros(len(line), bool)
        blank[1:] = line[1:] & line[:-1]
        flags = {
            "phrase": _phrases(w, han * 2 > n),
            "sentence": _units(w, np.cumsum(np.isin(text.low, _SENTENCE_END))),
            "paragraph": _units(w, np.cumsum(blank)),
        }
        for rule, flag in flags.items():
            out[rule].append(K.per_doc(w.doc, text.docs, flag) / np.maximum(n, 1))
    return {k: np.concatenate(v) if v else np.zeros(0) for k, v in out.items()}


def measure(df: DataFrame, text: Column, keep: dict[str, Column]) -> DataFrame:
    """``keep`` plus words and repeated shares of ``text``; null and empty texts have no words and share 0."""
    fields = df.select(*[c.alias(n) for n, c in keep.items()], text.alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields.schema.fields[:-1])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = shares(batch.column(batch.num_columns - 1))
        arrays = [batch.column(i) for i in range(batch.num_columns - 1)]
        arrays += [pa.array(got["words"].astype(np.int64)), *[pa.array(got[r].astype(np.float64)) for r in LIMITS]]
        return pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:-1], "words", *LIMITS])

    return arrow_map(fields, run, f"{schema}, words bigint, phrase double, sentence double, paragraph double")


def repetition(samples: DataFrame, limits: dict[str, float] | None = None, host_limit: float = HOST_LIMIT) -> DataFrame:
    """Repeated shares of each sample's generated answer, rule failures, and the verdict on its host.

    Columns: sample_id, host, words, phrase, sentence, paragraph (shares of repeated words), failed (rules failed),
    repetitive (the phrase rule failed), host_documents, host_rate (failure rate of the host shrunk by an empirical
    beta prior), host_repetitive.

    The host is ``metadata.domain`` in lower case; null and blank domains form the host ``unknown``. Of each
    sample_id the latest delivery counts; null ids are dropped. Null and empty answers have share 0 and fail nothing,
    and do not count for their host.
    """
    limits = {**LIMITS, **(limits or {})}
    keep = {"sample_id": F.col("sample_id"), "ingested_at": F.col("ingested_at"), "host": label(F.col("metadata.domain"))}
    measured = measure(samples, F.col("augmentation.generated_answer"), keep)
    columns = {c: F.col(c) for c in ("host", "words", *LIMITS)}
    rows = materialize(latest_by(measured, "sample_id", "ingested_at", columns), "repetition")
    failed = F.array_compact(F.array(*[F.when(F.col(r) >= F.lit(v), F.lit(r)) for r, v in limits.items()]))
    rows = rows.withColumn("failed", failed)
    return rows.join(broadcast_if_small(host_verdicts(rows, host_limit)), "host", "left").select(
        "sample_id", "host", "words", *LIMITS, "failed", (F.col("phrase") >= F.lit(limits["phrase"])).alias("repetitive"),
        F.coalesce("host_documents", F.lit(0)).alias("host_documents"), "host_rate", F.coalesce("host_repetitive", F.lit(False)).alias("host_repetitive"),
    )


def host_verdicts(rows: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """(host, host_documents, host_failures, host_rate, host_repetitive) from documents with ``failed`` rules.

    The beta prior is fitted to the hosts' raw rates by moments (each host weighs its documents); with fewer than two
    hosts, or rates without spread beyond chance, it has the mean rate and the strength of one document.
    """
    hosts = rows.where("words > 0").groupBy("host").agg(
        F.count(F.lit(1)).alias("host_documents"), F.sum(F.when(F.size("failed") > 0, 1).otherwise(0)).alias("host_failures")
    )
    rate = F.col("host_failures") / F.col("host_documents")
    prior = hosts.agg(
        F.sum("host_documents").alias("_n"),
        F.count(F.lit(1)).alias("_hosts"),
        (F.sum("host_failures") / F.sum("host_documents")).alias("_mean"),
        (F.sum(F.col("host_documents") * rate * rate) / F.sum("host_documents")).alias("_square"),
    ).select(
        "_mean",
        # between-host variance: the observed one less the binomial part
        (F.col("_square") - F.col("_mean") * F.col("_mean") - F.col("_mean") * (1 - F.col("_mean")) * (F.col("_hosts") - 1) / F.col("_n")).alias("_var"),
    )
    spread = F.col("_mean") * (1 - F.col("_mean"))
    strength = F.when((F.col("_var") > 0) & (F.col("_var") < spread), spread / F.col("_var") - 1).otherwise(F.lit(1.0))
    mean, weight = prior.select("_mean", strength.alias("_strength")).first()  # one row: a global aggregate
    shrunk = (F.col("host_failures") + F.lit((mean or 0.0) * weight)) / (F.col("host_documents") + F.lit(weight))
    return hosts.select("host", "host_documents", "host_failures", shrunk.alias("host_rate"), (shrunk >= F.lit(host_limit)).alias("host_repetitive"))
