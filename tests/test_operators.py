import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tidewright.operators import blocks, decontam, minhash, quality
from tidewright.operators.adapt import Mapping, adapt
from tidewright.operators.components import connected_components
from tidewright.operators.hooks import AlphanumericFilter, Injection, resolve


def records(spark, texts):
    return adapt(spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string"), Mapping(id_key="id", text_key="text"))


def test_decontamination(spark):
    rules = decontam.Rules(ngram_size=3, max_contamination_ratio=0.3)
    df = records(spark, ["the cat sat on the mat today", "nothing alike in this one here", None, "too short"])
    kept, gone = decontam.split_contaminated(decontam.annotate(df, spark.createDataFrame([("The cat, sat on the mat!",)], "text string"), rules), rules)
    assert sorted(r["sample_id"] for r in kept.collect()) == ["1", "2", "3"]
    found = gone.first()["quality_signals"]
    assert (found["contamination_matched_ngrams"], found["contamination_total_ngrams"]) == (4, 5) and math.isclose(found["contamination_ratio"], 0.8)


def test_empty_reference_changes_nothing(spark):
    df = records(spark, ["a b c d"])
    out = decontam.annotate(df, spark.createDataFrame([], "text string"), decontam.Rules(ngram_size=3))
    assert out.first()["quality_signals"]["contamination_ratio"] is None


def test_scores_with_null_and_repeated_rows(spark):
    rules = decontam.Rules(ngram_size=2)
    df = spark.createDataFrame([(1, "a b c"), (2, None), (None, "a b")], "k int, text string")
    index = decontam.reference_index(spark.createDataFrame([("a b",)], "text string"), rules)
    got = {r["k"]: (r["matched"], r["total"]) for r in decontam.scores(df, index, rules, "k").collect()}
    assert got == {1: (1, 2), 2: (0, 0), None: (1, 1)}


def test_large_index_by_filter_and_shuffle(spark, monkeypatch):
    rules = decontam.Rules(ngram_size=2)
    df = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 17}" for j in range(i))) for i in range(40)] + [(99, None)], "k int, text string")
    index = decontam.reference_index(df.where("k % 3 = 1"), rules)
    found = lambda: sorted(map(tuple, decontam.scores(df, index, rules, "k").collect()))
    small = found()
    monkeypatch.setattr(decontam, "BROADCAST_NGRAMS", 3)
    assert found() == small and any(0 < r[1] < r[2] for r in small)
    bits, size = decontam._filter_bits(index, index.count())
    assert size == 1 << 15 and 0 < sum(map(int.bit_count, bits)) <= 2 * index.count()


def test_bands_for_the_default_threshold():
    assert minhash.optimal_bands(0.8, 256) == (17, 15)


def test_signatures_agree_and_duplicates_go(spark):
    base = " ".join(f"word{i}" for i in range(80))
    texts = [base, base.upper(), base + " tail", "something else entirely with other words", "", None, "short"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    settings = minhash.Settings(num_permutations=64)
    jvm = {r["id"]: r["_signature"] for r in minhash.signatures(df, settings).collect()}
    arrow = {r["id"]: r["_signature"] for r in minhash.signatures_in_batches(df, settings, ["id"]).collect()}
    assert jvm == arrow and jvm[0] == jvm[1] and jvm[4] is None
    kept = sorted(r["id"] for r in minhash.remove_near_duplicates(df, settings, ["id"]).collect())
    assert kept == [0, 3, 4, 5, 6]
    verified = minhash.Settings(num_permutations=64, verify=True)
    assert sorted(r["id"] for r in minhash.remove_near_duplicates(df, verified, ["id"]).collect()) == kept


@pytest.mark.parametrize("tokenization", ["space", "punctuation", "character"])
def test_tokenizations(spark, tokenization):
    df = spark.createDataFrame([("a, b",)], "text string")
    found = df.select(minhash.tokens(F.col("text"), minhash.Settings(tokenization=tokenization))).first()[0]
    assert found == {"space": ["a,", "b"], "punctuation": ["a", ",", "b"], "character": ["a", ",", " ", "b"]}[tokenization]


def test_components_against_union_find(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 101), (103, 101), (7, 7), (None, 3), (200, 150)] + [(300, k) for k in range(301, 330)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert {got[i] for i in range(1, 41)} == {1} and got[103] == 100 and got[200] == 150 and {got[k] for k in range(300, 330)} == {300} and 7 in got
    assert connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_quality_bounds_and_summary(spark):
    df = quality.enrich(records(spark, ["one two", "one two three", "a b c d", ""]))
    kept = df.where(quality.passes(quality.Limits(min_tokens=3, max_tokens=3, min_assistant_turns=0)))
    assert [r["sample_id"] for r in kept.collect()] == ["1"]
    assert kept.first()["stats"]["num_token"] == 3
    s = quality.summary(df, [0.0, 0.5, 1.0]).first()
    assert s["sample_count"] == 4 and s["min"] == 0 and s["max"] == 4 and s["percentiles"] == {"0.0": 0.0, "0.5": 2.5, "1.0": 4.0}
    empty = quality.summary(df.limit(0), [0.5]).first()
    assert empty["sample_count"] == 0 and empty["percentiles"] == {"0.5": 0.0}


def test_numeric_filter(spark):
    df = spark.createDataFrame([(1, ("5",)), (2, (None,)), (3, ("nan",)), (4, ("7.5",))], "id int, m struct<v:string>")
    ids = lambda d: sorted(r["id"] for r in d.collect())
    assert ids(blocks.numeric_filter(df, "m.v", ">=", 6)[0]) == [4]
    assert ids(blocks.numeric_filter(df, ["m", "v"], "<", 6, keep_missing=True)[0]) == [1, 2]
    assert ids(blocks.numeric_filter(df, "m.v", "!=", 5)[1]) == [1, 2]
    assert ids(blocks.numeric_filter(df, "m.v", ">", percentile=0)[0]) == [4]
    with pytest.raises(ValueError):
        blocks.numeric_filter(df, "m.v", "~", 1)
    with pytest.raises(Exception):
        blocks.numeric_filter(df, "m.v", ">", 1, skip_missing=False)[0].collect()
    with pytest.raises(Exception):
        blocks.numeric_filter(spark.createDataFrame([("x",)], "v string"), "v", ">", 1)[0].collect()


def test_sample_and_stats_and_counter(spark):
    df = spark.range(50).withColumn("m", F.struct(F.col("id").alias("v")))
    a, b = ([r["id"] for r in blocks.sample_num(df, 5, "id", 3).collect()] for _ in range(2))
    assert a == b and len(a) == 5
    s = blocks.metadata_stats(df, "m.v").first()
    assert s["total"] == 50 and s["p50"] == 24.5 and s["max"] == 49
    chat = spark.createDataFrame([([("user", "a b", None), ("assistant", "c", None)], "c"), (None, None)], "messages array<struct<role:string,content:string,tool_calls:string>>, answer string")
    assert [(r["prompt_tokens"], r["response_tokens"], r["total_tokens"]) for r in blocks.token_counter(chat, end_token=True).collect()] == [(4, 2, 6), (0, 0, 0)]


def test_percentiles_equal_sorting(spark, monkeypatch):
    rng = random.Random(4)
    values = [rng.choice([1.0, 2.0, 2.0, 7.0]) for _ in range(300)] + [rng.gauss(0, 50) for _ in range(2000)] + [-1e300, 1e300]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(3)
    ordered = sorted(values)
    shares = [0.0, 0.01, 0.25, 0.5, 0.501, 0.9, 1.0]

    def at(s):
        place = s * (len(ordered) - 1)
        low = ordered[math.floor(place)]
        return low + (place - math.floor(place)) * (ordered[math.ceil(place)] - low)

    want = [at(s) for s in shares]
    assert quality.percentiles(df, F.col("v"), shares) == pytest.approx(want, rel=1e-12)
    monkeypatch.setattr(quality, "MOST_VALUES", 20)  # ranges are narrowed again and again
    assert quality.percentiles(df, F.col("v"), shares) == pytest.approx(want, rel=1e-12)
    assert quality.percentiles(df.limit(0), F.col("v"), [0.5]) == [None]
    monkeypatch.setattr(quality, "MOST_VALUES", 100_000)
    monkeypatch.setattr(blocks, "MOST_LISTED", 2)
    ids = spark.range(500)
    large = sorted(r["id"] for r in blocks.sample_num(ids, 40, "id", 3).collect())
    monkeypatch.setattr(blocks, "MOST_LISTED", 10_000)
    assert large == sorted(r["id"] for r in blocks.sample_num(ids, 40, "id", 3).collect()) and len(large) == 40
    assert blocks.sample_num(ids.limit(0), 3, "id").count() == 0


def test_sft_export_and_chain(spark):
    df = spark.createDataFrame([("q", "a", "s", [("r1",), ("r2",)]), ("q2", None, "s", [])], "text string, answer string, source string, res array<struct<text:string>>")
    rows = blocks.sft_export(df, system_prompt="sys").collect()
    assert len(rows) == 1 and [m["role"] for m in rows[0]["messages"]] == ["system", "user", "assistant"] and rows[0]["data_source"] == "s"
    assert blocks.sft_export(df, results="res").count() == 2
    chain = blocks.Chain({"docs": spark.range(10)})
    chain.run([{"id": "f", "block": blocks.numeric_filter, "inputs": ["${docs}"], "options": {"path": "id", "comparison": ">=", "threshold": "$t"}}], {"t": 7})
    assert chain.tables["f_output"].count() == 3 and chain.tables["f_excluded"].count() == 7
    grid = blocks.experiment_grid(spark.range(10), [1.0], lambda d, p: d.count(), model=["a", "b"])
    assert [g["model"] for g in grid] == ["a", "b"] and grid[0]["result"] == 10


def test_hooks(spark):
    found = resolve([Injection(class_path="tidewright.operators.hooks.AlphanumericFilter", init_kwargs={"min_ratio": 0.6}), Injection(enabled=False, hook="nowhere")])
    df = spark.createDataFrame([("abc",), ("!!!",)], "text string")
    assert found[0].apply(df).count() == 1 and AlphanumericFilter(min_ratio=0.0).run(df).count() == 2
    for bad in (Injection(hook="x", class_path="a.b"), Injection(class_path=""), Injection(class_path="math.nothing")):
        with pytest.raises(ValueError):
            resolve([bad])
    with pytest.raises(ImportError):
        resolve([Injection(class_path="no_such_module.Thing")])


def test_brute_force_near_duplicates_share_a_group(spark):
    words = [f"w{i}" for i in range(60)]
    texts = {0: words, 1: [*words, "x"], 2: words[::-1], 3: ["y", *words]}
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "id int, text string")
    groups = {r["node"]: r["root"] for r in minhash.near_duplicate_groups(df, minhash.Settings(), "id").collect()}
    shingle = {k: {tuple(v[i : i + 5]) for i in range(len(v) - 4)} for k, v in texts.items()}
    for a, b in itertools.combinations(texts, 2):
        if len(shingle[a] & shingle[b]) / len(shingle[a] | shingle[b]) > 0.95:
            assert groups[a] == groups[b]
    assert 2 not in groups


def _jaccard(a, b):
    return len(a & b) / len(a | b)


def test_default_bands_miss_no_pair_at_the_threshold():
    bands, rows = minhash.bands(minhash.Settings())
    assert (bands, rows) == (51, 5) and (1 - 0.8**rows) ** bands < 1e-8
    assert minhash.bands(minhash.Settings(verify=False)) == (17, 15)


def test_default_groups_equal_brute_force_around_the_threshold(spark):
    words = [f"w{i}" for i in range(120)]
    texts = {0: words}
    for k in range(1, 24):  # chains and stars of similarities from 0.6 to 1
        texts[k] = words[: 60 + k * 2] + [f"x{k // 3}_{i}" for i in range(k % 4 * 6)] + words[60 + k * 2 + k % 5 * 3 :]
    texts |= {24: words, 25: [], 26: ["few", "words"], 27: ["few", "words"]}
    shingle = {k: {" ".join(v[i : i + 5]) for i in range(max(1, len(v) - 4))} for k, v in texts.items() if v}
    root = {k: k for k in texts}
    for a, b in itertools.combinations(sorted(shingle), 2):
        if _jaccard(shingle[a], shingle[b]) >= 0.8 and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {k: low if r == high else r for k, r in root.items()}
    similar = [_jaccard(shingle[a], shingle[b]) for a, b in itertools.combinations(sorted(shingle), 2)]
    assert sum(0.75 < s < 0.8 for s in similar) and sum(0.8 <= s < 0.85 for s in similar)
    df = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "id int, text string")
    kept = sorted(r["id"] for r in minhash.remove_near_duplicates(df, minhash.Settings(), ["id"]).collect())
    assert kept == sorted(k for k, r in root.items() if r == k)


def test_hot_buckets_are_spread(spark, monkeypatch):
    words = [f"w{i}" for i in range(100)]
    df = spark.createDataFrame([(i, " ".join([*words, f"x{i}"])) for i in range(60)] + [(100 + i, f"only {i} " * 8) for i in range(5)], "id int, text string")
    found = lambda: sorted(map(tuple, minhash.near_duplicate_groups(df, minhash.Settings(), "id").collect()))
    small = found()
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(minhash, "HOT_BUCKET", 10)
    assert found() == small and len(small) == 60 and {r for _, r in small} == {0}


@pytest.mark.parametrize("hash_fc,precision,language", [("sha1", 32, "english"), ("sha1", 64, "english"), ("xxhash", 32, "chinese")])
def test_block_with_its_options(spark, hash_fc, precision, language):
    words = [f"w{i}" for i in range(80)]
    texts = [" ".join(words), " ".join([*words, "x"]), " ".join(words[::-1]), "先检查样本清单然后拒绝队列里所有的任务并且写下原因", "先检查样本清单然后拒绝队列里所有的任务并且写下原因。", "", None]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "id int, text string, more int")
    made = minhash.minhash_block(df, "id", hash_fc=hash_fc, precision=precision, language=language)
    want = [1, 4] if language == "chinese" else [1]
    assert sorted(r["id"] for r in made["remove_ids"].collect()) == want and made["output"].columns == df.columns
    assert sorted(r["id"] for r in made["output"].collect()) == [i for i in range(7) if i not in want] and made["buckets"].count() == 5
    with pytest.raises(ValueError):
        minhash.minhash_block(df, "id", hash_fc="crc")


def test_a_chance_collision_as_smallest_member_loses_no_link(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:55][::-1]), " ".join(words), " ".join([*words, "x"])]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    made = minhash.set_keys
    # all three share their only bucket; 0 is unlike the others, which are alike
    monkeypatch.setattr(minhash, "set_keys", lambda *a: made(*a).withColumn("keys", F.array(F.lit(7).cast("bigint"))))
    groups = {r["node"]: r["root"] for r in minhash.near_duplicate_groups(df, minhash.Settings(verify=True), "id").collect()}
    assert groups == {1: 1, 2: 1}


def test_a_long_conversation_stays_one(spark, tmp_path):
    from tidewright.plans import catalog

    rows = [(7, t, "assistant" if t % 2 else "user", f"turn {t}", "2024-01-01") for t in range(451)]
    spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string, logged_at string").write.parquet(str(tmp_path / "conversations.parquet"))
    made = {n: [tuple(r) for r in catalog.queries()[n](spark, str(tmp_path)).collect()] for n in ("turn_signals", "last_assistant_answer", "quality_filter", "token_counter")}
    chars = len("\n\n".join(f"{r}: {x}" for _, _, r, x, _ in rows))
    assert made["turn_signals"] == [(7, chars, 451, 225, 226)] and made["last_assistant_answer"] == [(7, "turn 449")]
    assert made["quality_filter"] == [(7, 451 * 4, 451, 225, chars)] and made["token_counter"] == [(7, 451 * 4, 3, 451 * 4 + 3)]
