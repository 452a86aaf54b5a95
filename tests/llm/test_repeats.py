"""Repeated byte strings and word passages against brute force."""

import hashlib
from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from annolake.llm import phrases, suffix_dedup, util
from annolake.llm.anchors import Chunk
from annolake.llm.suffix_dedup import SIZE, blind_trie, common, multikey_quicksort


def in_order(docs):
    h = F.xxhash64(F.coalesce(F.col("text").cast("binary"), F.lit(b"")))
    rows = docs.select("doc_id", "text", h.alias("h")).collect()
    return sorted(rows, key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.h, r.text or ""))


def removed_bytes(docs):
    first, out = {}, Counter()
    rows = in_order(docs)
    for k, r in enumerate(rows):
        b = (r.text or "").encode()
        for s in range(len(b) - SIZE + 1):
            first.setdefault(b[s : s + SIZE], (k, s))
    for k, r in enumerate(rows):
        b = (r.text or "").encode()
        gone = bytearray(len(b))
        for s in range(len(b) - SIZE + 1):
            if first[b[s : s + SIZE]] != (k, s):
                gone[s : s + SIZE] = b"\1" * SIZE
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for j, g in enumerate(gone) if g and (j == 0 or not gone[j - 1]))
        out[r.doc_id, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


def removed_words(docs):
    rows = docs.collect()
    words = [(r.text or "").encode().split() for r in rows]
    times = Counter(tuple(w[s : s + 35]) for w in words for s in range(len(w) - 34))
    out = Counter()
    for r, w in zip(rows, words, strict=True):
        gone = bytearray(len(w))
        for s in range(len(w) - 34):
            if times[tuple(w[s : s + 35])] > 1:
                gone[s : s + 35] = b"\1" * 35
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[r.doc_id, len(w), sum(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def rows_of(df, *cols):
    return Counter(tuple(r) for r in df.select(*cols).collect())


def test_bytes_against_brute_force(spark, sf):
    docs = util.table(spark, sf, "documents")
    got = suffix_dedup.removed_spans(docs)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removed_bytes(docs)


def test_words_against_brute_force(spark, sf):
    docs = util.table(spark, sf, "documents")
    assert rows_of(phrases.removed_words(docs), "doc_id", "n_words", "n_removed", "kept_sha256") == removed_words(docs)


def test_frequent_anchors_are_split(spark, sf):
    """With every anchor that occurs more than twice dealt by whole windows, and small chunks and buckets, nothing changes."""
    docs = util.table(spark, sf, "documents")
    got = suffix_dedup.removed_spans(docs, chunk_bytes=20_000, bucket_bytes=50_000, hot=2)
    assert rows_of(got, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removed_bytes(docs)
    got = phrases.removed_words(docs, chunk_bytes=20_000, bucket_bytes=50_000)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == removed_words(docs)


def test_phrases_come_from_the_dictionary_alone(spark, sf):
    """With an empty dictionary nothing is removed; frequent anchors send single windows, and the result stays the same."""
    from annolake.llm import anchors as an

    docs = util.table(spark, sf, "documents")
    table = an.keyed(docs, 40, ["doc_id"])
    sent = phrases.dictionary(table, 9)
    assert phrases.located(table, sent.where(F.col("kind") != phrases.PASSAGES)).agg(F.sum("n_removed")).first()[0] == 0
    want = removed_words(docs)
    for hot in (1, 3, 10**9):
        got = phrases.located(table, phrases.dictionary(table, 9, hot))
        assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == want


def test_a_passage_is_sent_to_the_dictionary_once(spark):
    """A passage of 80 words in 60 documents of as many chunks: its windows have one own chunk, which sends its words."""
    import zlib

    from annolake.llm import anchors as an

    shared = " ".join(f"w{k}" for k in range(80))
    docs = spark.createDataFrame([(i, f"a{i} b{i} {shared} c{i} d{i}") for i in range(60)], "doc_id long, text string")
    table = an.keyed(docs, 60, ["doc_id"])
    rows = phrases.dictionary(table, 5).where(F.col("kind") == phrases.PASSAGES).collect()
    assert len({r.chunk for r in rows}) == 1
    texts = [t for r in rows for t in zlib.decompress(an.unpack(r.payload, "<u8", None)[1]).split(b"\n")]
    words = [t.decode().split()[1:] for t in texts]  # after the place of the phrase
    windows = [" ".join(w[k : k + 35]) for w in words for k in range(len(w) - 34)]
    assert len(windows) == len(set(windows)) == 46 and max(map(len, words)) <= 70


def test_parts_of_a_passage_are_found(spark):
    """Documents share windows with passages that are longer on one side, in other documents and chunks."""
    import random

    rng = random.Random(2)
    line = [f"w{k}" for k in range(400)]
    rows = []
    for i in range(80):
        a, n = rng.randrange(300), rng.randrange(30, 100)
        rows.append((i, " ".join([f"a{i}", *line[a : a + n], f"b{i}", *line[a + 5 : a + 5 + n // 2]])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (1, 4, 256):
        got = phrases.removed_words(docs, chunk_bytes=2000, bucket_bytes=9000, hot=hot)
        assert rows_of(got, "doc_id", "n_words", "n_removed", "kept_sha256") == removed_words(docs)


def test_counts_of_frequent_keys_are_whole():
    """Times that a chunk holds a key are sent whole: 2,000 in each of five chunks are 10,000."""
    import numpy as np

    from annolake.llm import anchors as an

    asked = [an.Keys([np.full(2000, 5, np.uint64)], np.ones(2000, np.int64)).ask(c, 1, 0) for c in range(5)]
    assert sum(int(an.unpack(t.column("payload")[0].as_py(), "<u4", "<u8")[0][0]) for t in asked) == 10_000


def test_keys_that_are_equal_in_their_first_half_only():
    """Keys of two columns are one only if both are equal, in whatever order they come."""
    import numpy as np

    from annolake.llm import anchors as an

    for columns in ([7, 5, 7, 5, 7, 9], [1, 2, 3, 2, 1, 9]), ([7, 5, 7, 5, 7, 9], [1, 2, 1, 2, 1, 9]):
        keys = an.Keys([np.array(c, np.uint64) for c in columns], np.arange(1, 7))
        pairs = list(zip(*(c.tolist() for c in keys.columns), strict=True))
        rows = list(zip(*columns, strict=True))
        assert pairs == sorted(set(rows)) and [pairs[k] for k in keys.of] == rows
        assert keys.times.tolist() == [sum(n for n, r in enumerate(rows, 1) if r == p) for p in pairs]


def test_rows_of_one_key_are_one_only_if_their_texts_are(monkeypatch):
    """Null ids, an id at the edge of its type, and texts whose hashes collide."""
    rows = pa.table({"__k0": [0, 0, 0, 1, 1], "__k1": [0, 0, 0, 0, -(2**63)], "__h": [7, 7, 7, 7, 7], "__text": [b"b", b"a", b"b", b"b", b"a"]})
    chunk = Chunk(rows)
    assert chunk.raw == [b"a", b"b", b"a", b"b"] and chunk.copies.tolist() == [1, 2, 1, 1]
    assert [rows.column("__text")[int(i)].as_py() for i in chunk.order] == [chunk.raw[k] for k in chunk.of]


def test_automata_shards_find_what_one_finds(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(3)
    passages = [[b"w%d" % k for k in rng.integers(0, 12, 35 + i % 30)] for i in range(40)]
    text = [w for p in passages[::3] for w in [*p, b"gap", *p[:20]]]
    whole = [sorted(h for a in phrases.compiled(passages) for h in a.hits(text))]
    monkeypatch.setattr(phrases, "SHARD", 100)
    assert len(list(phrases.compiled(passages))) > 10
    assert sorted(h for a in phrases.compiled(passages) for h in a.hits(text)) == whole[0]


def passages_of(texts, most=58):
    """A passage for each place that is divisible by 20, its phrase where every window of it has it."""
    out = set()
    for text in texts:
        w = text.split()
        for at in range(0, len(w) - 34, 20):
            n = min(len(w) - at, 35 + at % (most - 34))
            out.add(b"%d %s" % ((n - 35 + 23) // 2, b" ".join(w[at : at + n])))
    return sorted(out)


def chunk_of(texts):
    n = list(range(len(texts)))
    return Chunk(pa.table({"__k0": [1] * len(n), "__k1": n, "__h": n, "__text": texts}))


def some_texts(seed, words=40, rows=30):
    """Texts that share parts of a line in which parts come again, with many kinds of white space, and some of a few words."""
    import random

    rng = random.Random(seed)
    line = [b"w%d" % rng.randrange(words) for _ in range(150)] * 2
    texts = [b"", b" ", b"w1 w2"]
    for _ in range(rows):
        own = []
        for _ in range(3):
            a = rng.randrange(200)
            own += [b"x%d" % rng.randrange(5), *line[a : a + rng.randrange(10, 90)]]
        texts.append(b"".join(rng.choice([b" ", b"\n", b" \t ", b"\x0b"]) + w for w in own) + rng.choice([b"", b"\r\n"]))
    return texts


def located_plainly(texts, passages):
    """Words in a run of 35 or more that a text and a passage share where they have the phrase in common."""
    out = []
    for text in texts:
        w, gone = text.split(), set()
        for p in passages:
            off, *q = p.split()
            off = int(off)
            for x in range(len(w) - 11):
                if w[x : x + 12] == q[off : off + 12]:
                    lo, hi = 0, 12
                    while x + lo > 0 and off + lo > 0 and w[x + lo - 1] == q[off + lo - 1]:
                        lo -= 1
                    while x + hi < len(w) and off + hi < len(q) and w[x + hi] == q[off + hi]:
                        hi += 1
                    if hi - lo >= 35:
                        gone |= set(range(x + lo, x + hi))
        out.append((len(w), len(gone), hashlib.sha256(b" ".join(v for k, v in enumerate(w) if k not in gone)).hexdigest()))
    return out


def test_located_against_plain_comparison(monkeypatch):
    """Also when an automaton holds a few phrases only, and when most words share a hash: hashes find places, words confirm them."""
    from annolake.llm import words

    def check():
        for seed in range(4):
            texts = some_texts(seed)
            passages = passages_of(texts[::4])
            got = phrases._located(chunk_of(texts), passages)
            want = located_plainly(texts, passages)
            assert list(zip(*(got.column(c).to_pylist() for c in ("n_words", "n_removed", "kept_sha256")), strict=True)) == want
            assert sum(n for _, n, _ in want) > 500

    check()
    monkeypatch.setattr(phrases, "SHARD", 50)
    check()
    plain = words.word_hashes
    monkeypatch.setattr(words, "word_hashes", lambda *a: plain(*a) & words.np.uint64(3 << 62))
    check()


def test_no_step_in_python_for_each_word():
    """What is called while passages are located follows the hits, not the words: it was at least a call for each word."""
    import sys

    texts = [b" ".join(b"w%d" % (k * k % (997 + i)) for k in range(2000)) for i in range(40)]
    shared = b" ".join(b"s%d" % k for k in range(50))
    chunk, calls = chunk_of([*texts, texts[0] + b" " + shared]), 0

    def count(frame, event, arg):
        nonlocal calls
        calls += event in ("call", "c_call")

    sys.setprofile(count)
    try:
        got = phrases._located(chunk, [b"12 " + shared])
    finally:
        sys.setprofile(None)
    assert got.column("n_removed").to_pylist() == [0] * 40 + [50]
    assert calls < 82_000 / 10


def test_hashes_of_words_and_windows():
    """Sums over blocks give each word, and each window of words, its polynomial; a word may be longer than a block."""
    import numpy as np

    from annolake.llm import words

    texts = [b" a  bb\tccc", b"x" * (words.BLOCK + 9) + b" y", b"", b" ".join(b"%d" % (k % 700) for k in range(20_000))]
    line = words.Line(texts)
    own = [w for t in texts for w in t.split()]
    assert line.text == b"".join(w + b" " for w in own) and line.first.tolist() == [0, 3, 5, 5, 20_005]
    base, top = int(words._BASE), 2**64
    some = own[:60]
    plain = [(sum(int(words._BYTE[b]) * pow(base, i, top) for i, b in enumerate(w)) + len(w)) % top for w in some if len(w) < 99]
    assert [int(h) for w, h in zip(some, line.hashes, strict=False) if len(w) < 99] == words.mix64(np.array(plain, np.uint64)).tolist()
    assert len(set(line.hashes.tolist())) == len(set(own))
    start = np.array([0, 1, 8_190, 8_191, 8_192, 8_300, len(own) - 35])
    mixed, step = words.mix64(line.hashes ^ np.uint64(1)), phrases._STEPS[0]
    plain = [sum(int(mixed[s + j]) * pow(step, j, top) for j in range(35)) % top for s in start.tolist()]
    assert words.window_hashes(line.hashes, 35, 1, step, start).tolist() == words.mix64(np.array(plain, np.uint64)).tolist()
    known = np.unique(line.hashes[:300])
    want = {h: k for k, h in enumerate(known.tolist())}
    assert words.places_of(line.hashes, known).tolist() == [want.get(h, len(known)) for h in line.hashes.tolist()]


def test_odd_rows(odd_docs, no_docs):
    short = odd_docs
    assert rows_of(suffix_dedup.removed_spans(short), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == removed_bytes(short)
    assert rows_of(phrases.removed_words(odd_docs), "doc_id", "n_words", "n_removed", "kept_sha256") == removed_words(odd_docs)
    long = suffix_dedup.removed_spans(odd_docs).where("doc_id = 14").first()
    assert (long.n_bytes, long.n_removed, long.n_spans) == (420000, 420000 - 21, 1)
    assert suffix_dedup.removed_spans(no_docs).count() == 0 and phrases.removed_words(no_docs).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab", min_size=8, max_size=30).map(str.encode), min_size=1, max_size=40))
def test_blind_trie_sorts(suffixes):
    shared = min(map(len, suffixes))
    while len({s[:shared] for s in suffixes}) > 1:
        shared -= 1
    root = blind_trie(suffixes, list(range(len(suffixes))), shared)
    out = []

    def walk(node):
        out.extend(suffixes[i] for i in node.ids)
        for b in sorted(node.kids):
            assert common(node.kids[b].sample, node.sample) >= node.depth
            walk(node.kids[b])

    walk(root)
    assert out == sorted(suffixes)


def test_multikey_quicksort_groups():
    import numpy as np

    rows = np.random.default_rng(1).integers(0, 3, (500, 3)).astype(np.uint64)
    groups = multikey_quicksort(rows)
    keys = [tuple(rows[g[0]].tolist()) for g in groups]
    assert keys == sorted(set(map(tuple, rows.tolist()))) and sum(map(len, groups)) == 500
    assert all((rows[g] == rows[g[0]]).all() for g in groups)
