import itertools
import random
import re
from datetime import datetime, timedelta

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewright.llm import cutoff, formatting, language, leakage, mixing, neardup, pairs, reading, repetition, tokens

T0 = datetime(2025, 1, 1)
MSG = "array<struct<role:string,content:string,tool_calls:string>>"


# --- 1 ---------------------------------------------------------------------------------------------------------------


def scores_table(spark, rows):
    return spark.createDataFrame(rows, "sample_id string, ingested_at timestamp, source string, judge struct<score:double>, extra int")


def test_cutoffs_against_sorting(spark):
    rng = random.Random(1)
    rows, latest = [], {}
    for i in range(4000):
        source = rng.choice(["hot"] * 5 + ["a", "b", None])
        score = rng.choice([None, float("nan"), -1.0, 11.0] + [round(rng.uniform(0, 10), rng.choice([0, 1, 5]))] * 16)
        rows.append((f"s{i}", T0, source, (score,), 1))
        latest[f"s{i}"] = (source, score)
    for i in range(0, 4000, 7):
        rows.append((f"s{i}", T0 + timedelta(days=1), latest[f"s{i}"][0], (5.0,), 1))
        latest[f"s{i}"] = (latest[f"s{i}"][0], 5.0)
    targets = [("hot", 0.15), ("a", 0.55), ("b", 1.0), ("absent", 0.5), (None, 0.5), ("zero", 0.0), ("a", 0.2)]
    report, kept = cutoff.keep_target_fraction(scores_table(spark, rows), spark.createDataFrame(targets, "source string, keep_fraction double"))
    by = {r["source"]: r for r in report.collect()}
    expected = set()
    for source, fraction in (("hot", 0.15), ("a", 0.55), ("b", 1.0)):
        valid = sorted((s for o, s in latest.values() if o == source and s is not None and 0 <= s <= 10), reverse=True)
        bar = next(v for v in sorted(set(valid), reverse=True) if sum(x >= v for x in valid) / len(valid) >= fraction)
        mine = {k for k, (o, s) in latest.items() if o == source and s is not None and bar <= s <= 10}
        expected |= mine
        assert (by[source]["cutoff"], by[source]["kept"], by[source]["scored"], by[source]["ties"]) == (bar, len(mine), len(valid), valid.count(bar))
    assert {r["sample_id"] for r in kept.collect()} == expected
    assert by["absent"]["cutoff"] is None and by["zero"]["kept"] == 0 and None not in by


def test_missed_sketch_is_recounted(spark):
    scored = spark.createDataFrame([("a", float(i)) for i in range(100)], "source string, score double")
    wrong = spark.createDataFrame([("a", 0.5, 90.0, 95.0)], "source string, keep_fraction double, _low double, _high double")
    assert cutoff._exact(scored, wrong).first()["cutoff"] is None
    wrong = spark.createDataFrame([("a", 0.5, 1.0, 5.0)], "source string, keep_fraction double, _low double, _high double")
    assert cutoff._exact(scored, wrong).first()["cutoff"] is None


def test_cutoffs_of_nothing(spark):
    empty = scores_table(spark, [])
    report, kept = cutoff.keep_target_fraction(empty, spark.createDataFrame([("a", 0.5)], "source string, keep_fraction double"))
    assert report.first()["scored"] == 0 and kept.count() == 0


# --- 2 and 8 ---------------------------------------------------------------------------------------------------------

SAMPLE = "sample_id string, ingested_at timestamp, source string, text string, metadata struct<lang:string,domain:string>, quality_signals struct<token_count:int>"


def test_token_budget(spark):
    import tiktoken

    from tidewright.llm import bpe

    text = "The worker of the queue has stopped, and it's 12 o'clock.  Done!\n"
    rows = [
        ("a", T0, "S ", text, ("en-US", "Ops"), (3,)), ("a", T0 + timedelta(1), "s", text, (None, "ops "), (None,)), ("b", T0, "s", None, ("eng", "OPS"), (0,)), ("c", T0, None, "", (None, None), None),
        (None, T0, "s", text, ("en", "ops"), (1,)), ("d", T0, "s", "这是一个测试文本", ("en", "ops"), (5,)),
    ]
    got = {(r["source"], r["lang"], r["domain"]): r for r in tokens.token_budget(spark.createDataFrame(rows, SAMPLE)).collect()}
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.ranks(bpe.vocabulary_path()).rank, special_tokens={})
    en = got[("s", "en", "ops")]
    assert (en["documents"], en["tokens"], en["declared_tokens"], en["undeclared"]) == (2, len(library.encode_ordinary(text)), 0, 2)
    assert got[("s", "zh", "ops")]["tokens"] == len(library.encode_ordinary(rows[-1][3])) and got[("s", "zh", "ops")]["declared_tokens"] == 5
    assert got[("unknown", "unknown", "unknown")]["tokens"] == 0
    assert tokens.token_budget(spark.createDataFrame([], SAMPLE)).count() == 0


def test_document_tokens_equal_the_library(spark):
    import tiktoken

    from tidewright.llm import bpe

    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.ranks(bpe.vocabulary_path()).rank, special_tokens={})
    texts = ["It's 12 o'clock.  Done!\n\n  x", "这是一个测试文本，谢谢", "", None, "a\u00a0b\u2003c\x1cd\x85e  ", "Ünïcödé e\u0301 ½ ² 𝔘𝔫 🙂🙂", "x" * 5000 + " " * 300, "we'll they've I'd 'S 's"]
    got = {r["i"]: r["tokens"] for r in tokens.document_tokens(spark.createDataFrame(list(enumerate(texts)), "i int, text string"), ["i"]).collect()}
    assert [got[i] for i in range(len(texts))] == [len(library.encode_ordinary(t or "")) for t in texts]
    assert tokens.document_tokens(spark.createDataFrame([], "i int, text string"), ["i"]).count() == 0


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice(["big"] * 6 + ["mid", "mid", "tiny", None, "other"]), "word " * rng.randint(5, 60)) for i in range(1500)] + [(9001, "big", None), (9002, "big", ""), (None, "big", "x")]
    targets = [("big", 0.5, 1), ("mid", 0.3, 3), ("tiny", 0.15, 4), ("absent", 0.05, 2), (None, 0.1, 1)]
    draws, report = mixing.mixture(spark.createDataFrame(docs, "doc_id bigint, source string, text string"), spark.createDataFrame(targets, "source string, target_share double, max_repeats int"))
    rows = draws.collect()
    by = {r["source"]: r for r in report.collect()}
    total = sum(r["tokens"] for r in rows)
    for source, share, most in targets[:3]:
        assert abs(by[source]["actual_share"] - share / 0.95) < 0.01 and by[source]["most_uses"] <= most
        assert by[source]["drawn_tokens"] == sum(r["tokens"] for r in rows if r["source"] == source)
    assert by["absent"]["actual_share"] == 0 and total > 0 and {r["source"] for r in rows} == {"big", "mid", "tiny"}
    uses = {}
    for r in rows:
        assert r["use"] not in uses.setdefault((r["source"], r["doc_id"]), set())
        uses[(r["source"], r["doc_id"])].add(r["use"])
    # every prefix of the schedule is close to the targets: low discrepancy
    half = [r for r in rows if r["slot"] < max(x["slot"] for x in rows) / 2]
    for source, share, _ in targets[:3]:
        assert abs(sum(r["tokens"] for r in half if r["source"] == source) / sum(r["tokens"] for r in half) - share / 0.95) < 0.05


def test_mixture_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id bigint, source string, text string")
    draws, report = mixing.mixture(docs, spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int"))
    assert draws.count() == 0 and report.first()["actual_share"] is None


# --- 3 ---------------------------------------------------------------------------------------------------------------


def brute_share(text):
    words = re.findall(r"[一-鿿]|[^\W\d_一-鿿]+", text.lower())
    size = 8 if sum(bool(re.match("[一-鿿]", w)) for w in words) * 2 > len(words) else 4
    seen, hit = set(), set()
    for i in range(len(words) - size + 1):
        run = tuple(words[i : i + size])
        if run in seen:
            hit.update(range(i, i + size))
        seen.add(run)
    return len(hit) / len(words) if words else 0.0


def test_repetition_against_brute_force():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("alpha beta gamma delta 12 eps, zeta.".split()) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    texts += ["先检查样本清单然后拒绝" * 3, "a b c d a b c d a b c d", "A b, c d! a B 7 c d", "", None, "x" * 30_000, "one two three four " * 4000]
    got = repetition.shares(pa.array(texts, pa.string()))["phrase"]
    for text, share in zip(texts, got):
        assert abs(share - brute_share(text or "")) < 1e-12, text


def test_sentences_paragraphs_and_hosts(spark):
    schema = "sample_id string, ingested_at timestamp, metadata struct<domain:string>, augmentation struct<generated_answer:string>"
    loop = "We close the queue now. We close the queue now. We close the queue now."
    plain = "Every word here differs from all others in this sentence."
    rows = [(f"g{i}", T0, ("Good ",), (plain,)) for i in range(30)] + [(f"b{i}", T0, ("bad",), (loop,)) for i in range(30)]
    rows += [("n", T0, (None,), None), ("e", T0, ("good",), ("",)), ("g0", T0 - timedelta(1), ("bad",), (loop,)), ("few", T0, ("rare",), (loop,)), (None, T0, ("bad",), (loop,))]
    got = {r["sample_id"]: r for r in repetition.repetition(spark.createDataFrame(rows, schema)).collect()}
    assert len(got) == 63 and got["b1"]["repetitive"] and got["b1"]["sentence"] == pytest.approx(2 / 3) and not got["g0"]["repetitive"]
    assert got["b1"]["host_repetitive"] and not got["g1"]["host_repetitive"] and got["g1"]["host_documents"] == 30
    assert 0.3 < got["few"]["host_rate"] < 1 and got["n"]["words"] == 0 and not got["n"]["failed"]
    assert repetition.repetition(spark.createDataFrame([], schema)).count() == 0


# --- 4 ---------------------------------------------------------------------------------------------------------------

LONG = "The queue of the worker has to be closed before it can be opened again, and that is what we do with it."
CASES = [
    ("How do I close the queue of the worker?", "Close it with the tool.", []), ("How much?", "520", []), ("Is it so?", "Yes", []), ("How?", None, ["empty"]), ("How?", " ​", ["empty"]), ("How?", "N/A", ["empty"]), ("How?", "```\n```", ["empty"]), ("How?", "<br>", ["empty"]),
    ("How do I close it?", LONG[:-20], ["truncated"]), ("Show code", "Here it is.\n```sh\nrun --x", ["truncated"]), ("Show list", "These are the names of it.\n- one (a)\n- two (b)", []), ("What next?", "We have to do the following:", ["truncated"]),
    ("How do I rename it?", "I'm sorry, but I can't help with that.", ["refusal"]), ("Why does it fail?", "I can't reproduce it on a clean copy, so the cause is local.", []), ("Wie geht das mit der Liste?", "Diese Anfrage kann ich leider nicht beantworten.", ["refusal"]),
    ("Comment faire avec la liste ?", "Je préfère ne pas traiter ce sujet.", ["refusal"]), ("¿Cómo lo hago con la lista?", "Lo siento, no puedo ayudarte con eso.", ["refusal"]), ("这个怎么做？", "很抱歉，我无法提供帮助。", ["refusal"]),
    ("How should I merge the reply buffer of Korozt today?", "how should i merge the REPLY buffer of Korozt, today", ["copied", "truncated"]), ("How should I merge the reply buffer of Korozt today?", "How should I merge the reply buffer of Korozt today? " + LONG, []),
    ("How should the worker be closed with the tool?", "Der Arbeiter wird mit dem Werkzeug geschlossen, und das ist nicht schwer.", ["other_language"]), ("Please answer in German: how should the worker be closed?", "Der Arbeiter wird mit dem Werkzeug geschlossen, und das ist nicht schwer.", []),
    (None, "Fine, that is done.", []), ("", None, ["empty"]),
]


def test_pair_rules(spark):
    df = spark.createDataFrame([(i, q, a) for i, (q, a, _) in enumerate(CASES)], "i int, q string, a string")
    got = {r["i"]: r["defects"] for r in pairs.defects(df, F.col("q"), F.col("a"), keep={"i": F.col("i")}).collect()}
    assert {i: got[i] for i in got if got[i] != CASES[i][2]} == {}


def test_chinese_answers_that_break_off(spark):
    rows = [("如何关闭工作进程？", "先保存所有的数据，然后关闭工作", ["truncated"]), ("如何关闭工作进程？", "先保存所有的数据，然后关闭工作进程。", []), ("好吗？", "好的", []), ("Was it good?", "Yes, it was", [])]
    df = spark.createDataFrame([(i, q, a) for i, (q, a, _) in enumerate(rows)], "i int, q string, a string")
    got = {r["i"]: r["defects"] for r in pairs.defects(df, F.col("q"), F.col("a"), keep={"i": F.col("i")}).collect()}
    assert [got[i] for i in range(len(rows))] == [r[2] for r in rows]


def test_pairs_need_a_user_message(spark):
    schema = f"sample_id string, ingested_at timestamp, messages {MSG}, answer string, system_prompt string"
    said = [("user", "first?", None), ("assistant", "x", None), ("User ", "second?", None)]
    rows = [("a", T0, said, None, None), ("b", T0, [("assistant", "x", None)], None, None), ("c", T0, None, None, None), ("d", T0, [], None, None), ("a", T0 + timedelta(1), said, "Done.", None), (None, T0, said, None, None), ("e", T0, said, "", None)]
    assert [tuple(r) for r in pairs.broken_pairs(spark.createDataFrame(rows, schema)).collect()] == [("e", ["empty"], "empty")]
    assert pairs.broken_pairs(spark.createDataFrame([], schema)).count() == 0


def test_languages():
    texts = [LONG, "Der Plan ist nicht mit dem Werkzeug und der Liste", "Le plan est dans la liste avec les mots pour nous", "El plan está en la lista con los datos para el día", "这是一个测试", "", None, "520"]
    assert language.detect(pa.array(texts)).to_pylist() == ["en", "de", "fr", "es", "zh", None, None, None]


# --- 5 ---------------------------------------------------------------------------------------------------------------


def test_formatting_duplicates(spark):
    schema = f"sample_id string, ingested_at timestamp, messages {MSG}, text string, clash int"
    one = [("user", "Close the queue, now!", None), ("assistant", "Done: 12 rows.", '[{"name": "x", "arguments": {"a": 1, "b": 2}}]')]
    two = [("User", "close  THE queue now", None), ("assistant", "done 12 rows", '[{"arguments":{"b":2,"a":1},"name":"X"}]')]
    other = [("user", "Close the queue, now!", None), ("assistant", "Done: 13 rows.", None)]
    args = [one[0], (one[1][0], one[1][1], '[{"name": "x", "arguments": {"a": 1, "b": 3}}]')]
    rows = [("b", T0, one, "t", 1), ("a", T0, two, "u", 1), ("c", T0, other, "t", 1), ("d", T0, args, "t", 1), ("e", T0, None, '{"p": "Q a", "r": [1, {"y": 1, "x": 2}]}', 1), ("f", T0, None, '{"r":[1,{"x":2,"y":1}],"p":"q  A"}', 1)]
    rows += [("g", T0, [], "plain text", 1), ("h", T0, None, "Plain, text.", 1), ("i", T0, None, None, 1), ("j", T0, None, None, 1), ("k", T0, None, "", 1), ("l", T0, None, " ", 1), (None, T0, one, "t", 1)]
    rows += [("m", T0, None, "plain text", 1), ("m", T0 + timedelta(1), None, "changed later", 1), ("b", T0 + timedelta(1), one, "t", 1), ("n", T0, None, "先检查 清单", 1), ("o", T0, None, "先检查，清单。", 1), ("p", T0, None, "STRASSE", 1), ("q", T0, None, "straße", 1)]
    records, copies = formatting.duplicate_records(spark.createDataFrame(rows, schema))
    assert sorted(map(tuple, copies.collect())) == [("a", "b"), ("e", "f"), ("g", "h"), ("k", "l"), ("n", "o"), ("p", "q")]
    got = {r["record_id"]: r["copies"] for r in records.collect()}
    assert got == {"a": 2, "c": 1, "d": 1, "e": 2, "g": 2, "i": 1, "j": 1, "k": 2, "m": 1, "n": 2, "p": 2}
    records, copies = formatting.duplicate_records(spark.createDataFrame([], schema))
    assert records.count() == 0 and copies.count() == 0


def test_hot_group_of_copies(spark, monkeypatch):
    monkeypatch.setattr(formatting, "HOT_COPIES", 50)
    df = spark.range(400).select(F.format_string("s%04d", "id").alias("sample_id"), F.lit(T0).alias("ingested_at"), F.lit(None).cast(MSG).alias("messages"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"))
    records, copies = formatting.duplicate_records(df)
    assert copies.count() == 133 and copies.select("first_id").distinct().collect()[0][0] == "s0000" and records.count() == 267


# --- 6 ---------------------------------------------------------------------------------------------------------------


def near_table(spark, texts):
    return spark.createDataFrame([(f"s{i:05d}", T0, t) for i, t in enumerate(texts)], "sample_id string, ingested_at timestamp, text string")


def brute_classes(texts, size, threshold):
    sets = {}
    for i, t in enumerate(texts):
        w = re.findall(r"[一-鿿]|[^\W_一-鿿]+", (t or "").lower())
        if w:
            sets[f"s{i:05d}"] = frozenset(zip(*[w[k:] for k in range(size)])) if len(w) >= size else frozenset([tuple(w)])
    root = {k: k for k in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold - 1e-12:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def edited(rng, words, rate):
    out = [w if rng.random() > rate else rng.choice(words) for w in words]
    k = rng.randint(0, len(out))
    return out[k:] + out[:k] if rng.random() < 0.3 else out


@pytest.mark.parametrize("size,threshold,cost", [(3, 0.6, 32), (5, 0.8, 32), (3, 0.6, 0), (2, 0.5, 0.01)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, size, threshold, cost):
    monkeypatch.setattr(neardup, "SUBSET_COST", cost)
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(150)]
    texts = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 6, 9, 14, 30, 80]))]
        texts += [" ".join(edited(rng, base, r)) for r in (0, 0, 0.03, 0.08)]
    texts += ["", None, "...", "先检查样本清单然后拒绝队列", "先检查样本清单然后拒绝队列！", "same same same same"] + ["one text that is there many times over"] * 40
    classes, links = neardup.near_duplicates(near_table(spark, texts), size=size, threshold=threshold, sketch_cells=1 << 16)
    got = {r["sample_id"]: r["class_id"] for r in classes.collect()}
    assert got == brute_classes(texts, size, threshold)
    assert links.where("a >= b").count() == 0


def test_largest_sets_keep_weaker_bounds(spark, monkeypatch):
    monkeypatch.setattr(neardup, "MOST_SIZE", 25)
    monkeypatch.setattr(neardup, "MOST_PLACE", 3)
    rng = random.Random(13)
    texts = []
    for _ in range(25):
        base = [f"v{rng.randint(0, 200)}" for _ in range(rng.choice([8, 20, 28, 60, 90]))]
        texts += [" ".join(edited(rng, base, r)) for r in (0, 0.03, 0.08)] + [" ".join(base[: int(len(base) * 0.7)])]
    classes, _ = neardup.near_duplicates(near_table(spark, texts), size=3, threshold=0.6, sketch_cells=1 << 16)
    assert {r["sample_id"]: r["class_id"] for r in classes.collect()} == brute_classes(texts, 3, 0.6)


def test_long_lists_are_split_and_every_pair_meets_once():
    import numpy as np

    from tidewright.llm import sketches

    rng = np.random.default_rng(5)
    sets, width = 40, 6
    token = np.concatenate([rng.choice(9, width, replace=False) for _ in range(sets)]).astype(np.uint64)
    count = np.array([1, 3, 5000, 20_000, 90_000, 2, 10**6, 4097, 7])[token.astype(int)]
    full = lambda v: np.full(sets, v)
    block = neardup.Block(rng.integers(1, 1 << 62, sets), full(30), full(20), full(3), token, sketches.encode(count.astype(float)), full(width), np.arange(sets) * width, np.zeros(sets, bool))
    entries = [(int(k), int(r), int(s) >> 2 & 3) for key, row, spot in neardup._list_entries(block) for k, r, s in zip(key, row, spot)]
    met = [(a, b) for k, a, x in entries if x & 1 for l, b, y in entries if y & 2 and k == l]
    rows = token.reshape(sets, width)
    want = [(a, b) for a in range(sets) for b in range(sets) for p in range(3) if rows[a, p] in rows[b]]
    assert sorted(met) == sorted(want) and len({k for k, _, _ in entries}) > 9 + 2 * 4


def test_near_duplicates_edges(spark):
    schema = "sample_id string, ingested_at timestamp, text string"
    classes, links = neardup.near_duplicates(spark.createDataFrame([], schema), sketch_cells=1 << 16)
    assert classes.count() == 0 and links.count() == 0
    rows = [("a", T0, "x y z"), ("a", T0 + timedelta(1), "p q r s"), ("b", T0, "x y z"), (None, T0, "x y z"), ("c", T0, "P q, r s")]
    classes, _ = neardup.near_duplicates(spark.createDataFrame(rows, schema), sketch_cells=1 << 16)
    assert {r["sample_id"]: r["class_id"] for r in classes.collect()} == {"a": "a", "b": "b", "c": "a"}
    assert [tuple(r) for r in neardup.class_pairs(classes).collect()] == [("a", "c")]


# --- 7 ---------------------------------------------------------------------------------------------------------------


def test_leaks(spark):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(900)]
    opening = "Read the case below and choose the best reply."
    own = [" ".join(rng.choice(vocabulary) for _ in range(50)).capitalize() + "." for _ in range(12)]
    items = [(i, f"{opening} {w}") for i, w in enumerate(own)] + [(50, None), (51, "Too short."), (None, own[0])]
    filler = lambda n=80: " ".join(rng.choice(vocabulary[:450]) for _ in range(n))
    w = [o.split() for o in own]
    altered = [x for k, x in enumerate(w[3]) if k % 11] + []
    inserted = [y for k, x in enumerate(w[4]) for y in ([x, "just"] if k % 8 == 3 else [x])]
    docs = {
        0: filler() + " " + own[0] + " " + filler(), 1: filler() + "\n> " + own[1].upper().replace(" ", "\n> ", 9), 2: " ".join(w[2][:35]) + " " + filler(), 3: filler() + " " + " ".join(altered), 4: " ".join(inserted) + filler(),
        5: " ".join(w[5][:20]) + " " + filler(40) + " " + " ".join(w[5][20:40]), 6: " ".join(w[6][:12]) + " " + filler(), 7: f"{opening} " + filler(), 8: own[7] + filler() + own[8], 9: " ".join(w[9][25:] + w[9][:0]), 10: None, 11: "", 12: " ".join(rng.sample(w[10], len(w[10]))),
        13: filler(30_000) + " " + own[11],
    }
    got = leakage.leaked_items(spark.createDataFrame([*docs.items(), (None, own[0])], "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    found = {(r["doc_id"], r["item_id"]) for r in got.collect()}
    must = {(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (8, 7), (8, 8), (13, 11)}
    assert must <= found and found - must <= {(9, 9)}


def test_leaks_of_nothing_and_in_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa"), (2, "quite another wording that nobody has ever written down")], "item_id bigint, text string")
    assert leakage.leaked_items(docs, items.limit(0)).count() == 0 and leakage.leaked_items(docs.limit(0), items).count() == 0
    monkeypatch.setattr(leakage, "BLOCK_ITEM_CHARS", 60)
    assert [(r["doc_id"], r["item_id"]) for r in leakage.leaked_items(docs, items).collect()] == [(1, 1)]


def test_groups_of_documents_keep_every_text():
    rng = random.Random(2)
    sizes = [rng.choice([0, 1, 5, 30, 200]) for _ in range(300)]
    batches = [pa.RecordBatch.from_arrays([pa.array(range(k, k + 50)), pa.array(["x" * s for s in sizes[k : k + 50]])], ["i", "t"]) for k in range(0, 300, 50)]
    for limit in (1, 64, 1000, 10**6):
        groups = list(leakage._grouped(iter(batches), limit))
        assert [i for ids, _ in groups for i in ids.to_pylist()] == list(range(300)) and [len(t) for _, texts in groups for t in texts.to_pylist()] == sizes
        assert all(len(texts) == 1 or sum(map(len, texts.to_pylist())) <= limit for _, texts in groups)


def test_rows_are_grouped_whatever_their_range():
    import numpy as np

    rng = np.random.default_rng(3)
    for top in (3, 1000, 10**7, 1 << 40):
        parts = [rng.choice(rng.integers(-top, top, 9), 500) for _ in range(3)]
        group, size = leakage._unique_counts(*parts)
        rows = list(zip(*[p.tolist() for p in parts]))
        assert all((group[i] == group[j]) == (rows[i] == rows[j]) for i in range(0, 500, 7) for j in range(500))
        assert [size[g] for g in group] == [rows.count(r) for r in rows]
    assert [len(x) for x in leakage._unique_counts(np.zeros(0, np.int64))] == [0, 0]


def test_leaks_do_not_depend_on_neighbours():
    from tidewright.llm import kernels

    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    own = " ".join(rng.choice(words) for _ in range(60))
    altered = " ".join(w if rng.random() > 0.16 else rng.choice(words) for w in own.split())
    known = leakage.Items([1], [own])
    found = {tuple(s for d, _, s in leakage.search(leakage.flatten(kernels.chars(pa.array(["y " * pad, altered]))), known, 0.2) if d == 1) for pad in range(30)}
    assert len(found) == 1


def test_leaks_of_short_items(spark):
    items = [(1, "Quick jade foxes sip"), (2, "Seven grey owls watch a frozen lake"), (3, "The harbour clock stopped at nine while gulls circled above us")]
    docs = [(1, "Note: quick jade foxes sip, it says."), (2, "so seven grey owls wxtch a frozen lake today"), (3, "and the harbour clock stopped at nine while all was quiet"), (4, "Seven people watch the harbour and sip tea")]
    got = leakage.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"))
    assert sorted((r["doc_id"], r["item_id"]) for r in got.collect()) == [(1, 1), (2, 2), (3, 3)]


def test_items_of_ten_to_sixty_characters(spark):
    rng = random.Random(17)
    word = lambda: "".join(rng.choice("bcdfghjklmnprstvwz") + rng.choice("aeiou") for _ in range(rng.randint(1, 3)))
    items, docs, must = [], [], set()
    for k, size in enumerate(range(10, 62, 4)):
        text = ""
        while len(text) < size:
            text += (" " if text else "") + word()
        items.append((k, text))
        docs.append((2 * k, f"It says: {text.upper()}! and goes on with other matters."))
        must.add((2 * k, k))
        if len(text) >= 20:  # half of it is longer than a q-gram
            docs.append((2 * k + 1, f"Only {text[: len(text) // 2 + 2]} is quoted here."))
            must.add((2 * k + 1, k))
    docs.append((999, "Nothing of the kind stands in this sentence about the weather."))
    got = leakage.leaked_items(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([*items, (500, "Why?")], "item_id bigint, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in got.collect()} == must


def test_shared_openings_do_not_depend_on_size(spark, monkeypatch):
    opening = " ".join(f"Rule number {w} of the task ist nötig." for w in ("one", "two", "three", "four", "five", "six"))
    own = ["alpha beta gamma delta epsilon zeta eta theta iota kappa", "wholly other words stand in this second item of ours", "a third wording that shares nothing with the former two"]
    items = spark.createDataFrame([(i, f"{opening} <b>{w}</b>") for i, w in enumerate(own)] + [(i, "The same last sentence in each of them.") for i in (7, 8, 9)], "item_id bigint, text string")
    docs = spark.createDataFrame([(i, f"See: {w}.") for i, w in enumerate(own)] + [(5, opening), (6, "The same last sentence in each of them.")], "doc_id bigint, text string")
    found = lambda: sorted((r["doc_id"], r["item_id"], r["share"]) for r in leakage.leaked_items(docs, items).collect())
    small = found()
    monkeypatch.setattr(leakage, "BLOCK_ITEM_CHARS", 300)
    assert found() == small and [r[:2] for r in small] == [(0, 0), (1, 1), (2, 2), (6, 7), (6, 8), (6, 9)]


# --- 9 ---------------------------------------------------------------------------------------------------------------


def test_reading_level_on_held_out_labels(spark, small_dir):
    big = small_dir.replace("sf0.001", "sf0.1")
    docs, labels = spark.read.parquet(f"{big}/documents.parquet"), spark.read.parquet(f"{big}/labels.parquet").where("reader_band is not null")
    train, held = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) > 0), labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0)
    got = reading.reading_levels(docs, train).join(held, "doc_id").select((F.col("band") == F.col("reader_band")).cast("double").alias("hit"), (F.abs(F.col("band") - F.col("reader_band")) <= 1).cast("double").alias("near"))
    hit, near = got.agg(F.avg("hit"), F.avg("near")).first()
    assert hit > 0.9 and near > 0.99  # some of the labels themselves are wrong


def test_reading_level_edges(spark):
    text = "We stop the job now and look at the log with care because it is red. " * 3
    docs = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "Too short."), (5, "```\n" + text + "\n```"), (None, text), (6, text.upper())], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 2), (4, 1), (99, 3), (6, None)], "doc_id bigint, reader_band int")
    got = {r["doc_id"]: r["band"] for r in reading.reading_levels(docs, labels).collect()}
    assert set(got) == {1, 6} and all(1 <= b <= 4 for b in got.values())
    assert reading.reading_levels(docs, labels.limit(0)).count() == 0
    assert reading.reading_levels(docs.limit(0), labels).count() == 0


# --- languages and scripts ------------------------------------------------------------------------------------------

Q = "How should the worker be closed with the tool?"
OTHER = {
    "ru": "Очередь рабочего процесса нужно закрыть, прежде чем её открыть.", "ko": "작업자의 대기열을 먼저 닫아야 합니다.", "ar": "يجب إغلاق قائمة الانتظار قبل فتحها.", "pt": "A fila deve ser fechada antes que você possa abri-la, e isso não é difícil.",
    "ja": "ワーカーのキューを閉じる必要があります。", "zh": "先关闭工作进程的队列。", "uk": "Черга має бути закрита, перш ніж її відкриють.", "hi": "पहले कतार बंद करें।", "it": "La coda deve essere chiusa prima di aprire il processo, perché questo non è difficile.",
}


def test_languages_by_script_and_words():
    assert language.detect(pa.array(list(OTHER.values()))).to_pylist() == list(OTHER)
    assert language.detect(pa.array(["OK ок"])).to_pylist() == [None]


def test_answers_in_any_script_and_long_answers(spark):
    tail = " The reasons are many, and I would like to set them out in some detail here." * 8
    cases = [(Q, a, ["other_language"]) for a in OTHER.values()]
    cases += [(q, a, []) for q, a in (("Как закрыть рабочий процесс?", OTHER["ru"]), ("ワーカーはどう閉じますか？", OTHER["ja"]), ("Please answer in Russian: " + Q, OTHER["ru"]), ("Как закрыть рабочий процесс?", "kubectl delete pod worker-3"))]
    cases += [(Q, "<div><span></span></div><p></p>" * 12, ["empty"]), (Q, "I'm sorry, but I can't help with that." + tail, ["refusal"]), (Q, 'The bot answered "I cannot help with that" in 21 chats, so we closed the queue and looked at the log.' + tail, []), (Q, "The bot said 'I can't help with that' in 21 chats, so we closed the queue and looked at the log.", [])]
    cases += [("Как закрыть рабочий процесс?", "К сожалению, я не могу вам помочь с этим.", ["refusal"]), ("Como devo fechar a fila do processo, e quando?", "Desculpe, mas não posso ajudar com isso.", ["refusal"]), (Q, '"I\'m sorry, I can\'t help with that."', ["refusal"])]
    df = spark.createDataFrame([(i, q, a) for i, (q, a, _) in enumerate(cases)], "i int, q string, a string")
    got = {r["i"]: r["defects"] for r in pairs.defects(df, F.col("q"), F.col("a"), keep={"i": F.col("i")}).collect()}
    assert {i: (got[i], cases[i][1][:40]) for i in got if got[i] != cases[i][2]} == {}


def test_declared_languages_are_kept(spark):
    from tidewright.llm.common import language_code

    rows = [("en-US", "en"), ("English", "en"), ("Italiano", "it"), ("por", "pt"), ("русский", "ru"), ("ga", "ga"), ("ZH_tw", "zh"), ("und", None), ("klingon", None), ("", None), (None, None), ("1", None)]
    df = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(rows)], "i int, a string")
    got = {r["i"]: r["c"] for r in df.select("i", language_code(F.col("a")).alias("c")).collect()}
    assert [got[i] for i in range(len(rows))] == [c for _, c in rows]


def test_filters_by_ranges_of_the_hash(spark):
    """As many hashes for each cell as 10^9 records bring: one filter of 2^12 cells would be full, ranges are not."""
    from tidewright.llm import sketches
    from tidewright.runtime import materialize

    count, most = 20_000, 1 << 12
    df = spark.range(count).select("id", F.when(F.col("id") % 10 == 0, F.xxhash64((F.col("id") / 20).cast("bigint"))).when(F.col("id") != 7, F.xxhash64("id", F.lit("x"))).alias("h")).repartition(8)
    df = materialize(df, "hashes")
    assert sketches.filter_ranges(count, most) == 64 and sketches.filter_ranges(10**9) == 64 and sketches.filter_ranges(1000) == 1
    marked = sketches.mark_repeats(df, "h", count, most).select("id", "h", "_maybe")
    again = df.groupBy("h").count().where("count > 1 and h is not null").select("h")
    assert marked.count() == count and marked.join(again, "h", "left_semi").where("not _maybe").count() == 0
    assert marked.where("h is null").select("_maybe").first()[0] is False
    lone = marked.where("h is not null").join(again, "h", "left_anti")
    assert lone.where("_maybe").count() < 0.05 * lone.count()


def test_repeats_in_ranges_give_the_same_records(spark, monkeypatch):
    from tidewright.llm import sketches

    rows = [(f"s{i % 90:03d}", T0 + timedelta(i // 90), None, f"text {i % 37}" if i % 5 else None) for i in range(100)]
    df = spark.createDataFrame(rows, f"sample_id string, ingested_at timestamp, messages {MSG}, text string")
    found = lambda: [sorted(map(tuple, t.collect())) for t in formatting.duplicate_records(df)]
    one = found()
    monkeypatch.setattr(sketches, "mark_repeats", lambda d, c, n, most=0, f=sketches.mark_repeats: f(d, c, n, 256))
    assert found() == one and one[1]


def test_word_counts_are_exact_however_texts_are_dealt_out(spark):
    import math

    from tidewright.llm import kernels

    rng = random.Random(8)
    texts = [" ".join(rng.choice(["the"] * 30 + ["of"] * 10 + [f"w{chr(97 + k)}x" for k in range(20)]) for _ in range(rng.randint(0, 400))) for _ in range(80)] + ["the " * 70_000, "", None]
    want = {}
    for text in texts:
        for word in re.findall(r"[^\W\d_]+", text or ""):
            want[kernels.word_hash(word)] = want.get(kernels.word_hash(word), 0) + 1
    df = spark.createDataFrame([(t,) for t in texts], "_text string")
    for dealt in (df.repartition(1), df.repartition(7)):
        got = {r["word"] % (1 << 64): r["n"] for r in reading.word_counts(dealt).collect()}
        assert got == want
    counts = reading.word_counts(df)
    few = reading.rarities(counts, 3)
    total, top = sum(want.values()), sorted(want.values(), reverse=True)
    kept = [n for n in top if n > top[3]]
    assert sorted(few.value.tolist()) == pytest.approx(sorted(math.log(total / n) for n in kept))
    assert few.other == pytest.approx(math.log(total / ((total - sum(kept)) / (len(want) - len(kept)))))
    every = reading.rarities(counts)
    assert len(every.word) == len(want) and reading.rarities(reading.word_counts(df.limit(0))).other == 0.0
