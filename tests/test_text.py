import re

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.functions import text as X

SAMPLES = ["", "Plan a safe roll-out, now!", "a b c\u000bd", "हिन्दी ½ x_y", "日本語 テスト。", "  lead  and\ttrail \n", "it's 3.5%", "éte"]


def _df(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string")


def test_squash_and_tokens_follow_python(spark):
    rows = _df(spark, [*SAMPLES, None]).select("t", X.squash(F.col("t")).alias("s"), X.token_count(F.col("t")).alias("n")).collect()
    for r in rows:
        text = r["t"] or ""
        assert r["s"] == re.sub(r"\s+", " ", text).strip()
        assert r["n"] == len(re.findall(r"\w+|[^\w\s]", text))


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="aB9_ .,-\n\téß中", max_size=30), min_size=1, max_size=20))
def test_ngrams_count_distinct_runs(spark, texts):
    found = _df(spark, texts).select("id", F.size(X.ngram_hashes(X.words(F.col("t")), 3)).alias("n")).collect()
    for r in found:
        w = re.findall(r"\w+", texts[r["id"]].lower())
        assert r["n"] == len(set(zip(w, w[1:], w[2:])))


def test_long_text_is_linear(spark):
    text = " ".join(f"w{i % 977}" for i in range(60_000))
    n = _df(spark, [text]).select(F.size(X.ngram_hashes(X.words(F.col("t")), 8)).alias("n")).first()["n"]
    assert n == 977


def test_sorted_json(spark):
    rows = _df(spark, ['{"b": 1, "a": {"d": "é", "c": [2]}}', "no json", None]).select(X.sorted_json(F.col("t")).alias("j")).collect()
    assert [r["j"] for r in rows] == ['{"a": {"c": [2], "d": "é"}, "b": 1}', "no json", None]


def test_stable_id_and_ratio(spark):
    r = _df(spark, ["hello"]).select(X.stable_id(F.lit("s"), F.lit(7), F.col("t")).alias("i"), X.alphanumeric_ratio(F.lit("a-b-")).alias("r"), X.alphanumeric_ratio(F.lit("")).alias("e")).first()
    assert r["i"] == "s-00000007-aaf4c61ddcc5" and r["r"] == 0.5 and r["e"] == 0.0


def test_first_filled(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [" ", None], "b": ["x  y", " "]}))
    assert [r[0] for r in df.select(X.first_filled([F.col("a"), F.col("b")])).collect()] == ["x y", None]


def test_runs_of_tokens():
    import random

    import numpy as np

    rng = random.Random(6)
    rows = [[rng.randint(1, 4) for _ in range(rng.choice([0, 1, 2, 3, 5, 40]))] for _ in range(60)]
    flat, length = np.array([t for r in rows for t in r], np.uint64), np.array([len(r) for r in rows])
    for size in (1, 2, 3, 5):
        for short in (False, True):
            found, count = X.distinct_runs(flat, length, size, short)
            sets = [{tuple(r[i : i + size]) for i in range(len(r) - size + 1)} or ({tuple(r)} if short and r else set()) for r in rows]
            assert count.tolist() == [len(s) for s in sets] and len(found) == count.sum()
            ends = np.concatenate([[0], np.cumsum(count)])
            named = {}
            for k, s in enumerate(sets):  # equal rows have equal hashes, a run has the same hash in every row
                assert named.setdefault(frozenset(s), frozenset(found[ends[k] : ends[k + 1]].tolist())) == frozenset(found[ends[k] : ends[k + 1]].tolist())
            assert len(set(found.tolist())) == len(set().union(*sets))
    assert [len(x) for x in X.distinct_runs(np.zeros(0, np.uint64), np.zeros(2, np.int64), 3)] == [0, 2]
