import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewright.llm import bpe, sketches
from tidewright.llm import kernels as K

TEXT = st.text(alphabet="aAbß é\n.,-1中文你🙂​", max_size=40)


def spelt(text, w):
    return ["".join(map(chr, text.low[a:b])) for a, b in zip(w.start, w.end)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8))
def test_words_follow_a_regex(texts):
    text = K.chars(pa.array(texts, pa.string()))
    w = K.words(text)
    expected = [(i, m) for i, t in enumerate(texts) for m in re.findall(r"[一-鿿]|[^\W_一-鿿]+", (t or "").lower())]
    assert list(zip(w.doc.tolist(), spelt(text, w))) == expected
    by_word = {}
    for h, m in zip(w.hash.tolist(), spelt(text, w)):
        assert by_word.setdefault(m, h) == h
    assert len(set(by_word.values())) == len(by_word)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 5), max_size=12), max_size=6))
def test_runs_distinct_repeated(docs):
    values = K.mix(np.array([v + 1 for d in docs for v in d], np.uint64))
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    found, first = K.runs(values, doc, 3)
    assert len(found) == sum(max(0, len(d) - 2) for d in docs)
    kept, _ = K.distinct(found, doc[first])
    assert len(kept) == sum(len({tuple(d[i : i + 3]) for i in range(len(d) - 2)}) for d in docs)
    seen, expected = set(), []
    for d, v in zip(doc.tolist(), values.tolist()):
        expected.append((d, v) in seen)
        seen.add((d, v))
    assert K.repeated(values, doc).tolist() == expected


def test_blocks_keep_long_texts_whole():
    texts = pa.array(["a b"] * 5 + ["x " * 3000] + [None, ""])
    got = [(s, e, len(c.code)) for s, e, c in K.blocks(texts, limit=100)]
    assert got[0][0] == 0 and got[-1][1] == 8 and sum(n for *_, n in got) == 5 * 3 + 6000


def test_repeat_merge_never_misses():
    size = sketches.filter_cells(1000)
    parts = [np.arange(0, 300), np.arange(290, 600), np.arange(598, 900)]
    cells = []
    for part in parts:
        c = np.zeros(size, np.uint8)
        c[sketches.places(part.astype(np.uint64), size)] |= 1
        cells.append(c)
    merged = sketches.merge_seen(sketches.merge_seen(cells[0], cells[1]), cells[2])
    held = sketches.holds(np.arange(0, 900).astype(np.uint64), np.packbits(merged > 1), size)
    assert held[290:300].all() and held[598:600].all() and held.sum() < 200


def test_coded_counts():
    counts = np.array([0, 1, 2, 15, 16, 17, 100, 10_000, 60_000])
    back = sketches.decode(sketches.encode(counts.astype(float)))
    assert (back[:5] == counts[:5]).all() and (np.abs(back - counts) <= 0.07 * counts).all()
    assert (sketches.encode_counts(counts.astype(np.uint16)) == sketches.encode(counts.astype(float))).all()
    assert sketches.decode(sketches.merge_counts(np.uint8([1]), np.uint8([1])))[0] == 2


def test_merges_equal_the_library():
    import regex
    import tiktoken

    path = bpe.vocabulary_path()
    ranks = bpe.ranks(path)
    library = tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=ranks.rank, special_tokens={})
    texts = ["Hello world, it's 12345 =======", "aaaaaaaaaaaaaaaaaaaaaa", "先检查样本清单，然后拒绝", "ééé ñandú Straße", "x" * 5000, " \n\n\t  mixed   space ", "🙂🙂 emoji", "ab" * 200, ""]
    pieces = [p.encode() for t in texts for p in regex.findall(bpe.PATTERN, t)]
    assert ranks.count(pieces).tolist() == [len(library.encode_ordinary(p.decode())) for p in pieces]
    long = ["先检查样本清单然后拒绝队列里所有的任务" * 500, "แรกตรวจสอบรายการแล้วปฏิเสธ" * 400, "ab" * 9000, "ключ" * 3000]
    assert ranks.count([t.encode() for t in long]).tolist() == [len(library.encode_ordinary(t)) for t in long]
    counter = bpe.Counter(path)
    for text in texts:
        assert counter(regex.findall(bpe.PATTERN, text)).sum() == len(library.encode_ordinary(text))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="abetinos =-é中", min_size=1, max_size=60), max_size=6))
def test_merges_equal_one_at_a_time(texts):
    ranks = bpe.ranks(bpe.vocabulary_path())
    assert ranks.count([t.encode() for t in texts]).tolist() == [ranks.count_one(t.encode()) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 0, 0, 0, 0, 1, 2, 255]), max_size=60), st.integers(0, 1500))
def test_packed_segments(values, zeros):
    piece = np.array([0] * zeros + values + [0] * (3 * zeros), np.uint8)
    assert (sketches.unpack(sketches.pack(piece)) == piece).all()
