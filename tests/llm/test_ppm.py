import math
import zlib
from collections import Counter, defaultdict

import pytest

from annolake.llm import ppm, util

K = ppm.ORDER


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


class Plain:
    """The same model, one symbol at a time over dictionaries."""

    def __init__(self, rows):
        self.words, self.after = Counter(), [defaultdict(Counter) for _ in range(K + 1)]
        for r in rows:
            if not held(r.doc_id):
                self.words.update((r.text or "").encode().lower().split() + [b""])
                b = b"\xff" * K + (r.text or "").encode() + b"\xff"
                for i in range(K, len(b)):
                    for k in range(K + 1):
                        self.after[k][b[i - k : i]][b[i]] += 1

    def log10(self, context, symbol):
        out, excluded = 0.0, set()
        for k in range(K, -1, -1):
            seen = self.after[k].get(context[K - k :])
            if not seen:
                continue
            live = {s: n for s, n in seen.items() if s not in excluded}
            if symbol in live:
                return out + math.log10((live[symbol] - 0.5) / sum(live.values()))
            if live:
                out += math.log10(0.5 * len(live) / sum(live.values()))
            excluded |= set(seen)
        return out - math.log10(max(1, 256 - len(excluded)))

    def text(self, text):
        b = b"\xff" * K + (text or "").encode() + b"\xff"
        return sum(self.log10(b[i - K : i], b[i]) for i in range(K, len(b)))

    def base(self, text):
        n, v = sum(self.words.values()), len(self.words)
        tokens = (text or "").encode().lower().split() + [b""]
        return len(tokens), sum(self.words[t] > 0 for t in tokens), sum(math.log10((self.words[t] + 1) / (n + v + 1)) for t in tokens)


def check(docs):
    rows = docs.collect()
    plain = Plain(rows)
    expected = sorted((str(r.doc_id), *plain.base(r.text), plain.text(r.text)) for r in rows)
    got = sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in ppm.language_scores(docs).collect())
    for e, g in zip(expected, got, strict=True):
        assert e[:3] == g[:3] and e[3] == pytest.approx(g[3], rel=1e-9)
        assert e[4] == pytest.approx(g[4], rel=1e-6, abs=1e-9)


def test_against_dictionaries(spark, sf):
    check(util.table(spark, sf, "documents").select("doc_id", "text"))


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert ppm.language_scores(no_docs).count() == 0


def test_small_chunks_and_buckets_give_the_same(spark, sf):
    docs = util.table(spark, sf, "documents").limit(60)
    key = lambda df: sorted((r.doc_id, r.n_known, round(r.base_score, 6), round(r.score, 6)) for r in df.collect())
    assert key(ppm.language_scores(docs)) == key(ppm.language_scores(docs, chunk_bytes=10_000, bucket_bytes=5_000))


def test_probabilities_add_up(spark):
    docs = spark.createDataFrame([(1, "abracadabra"), (3, "cadabra abra")], "doc_id long, text string")
    plain = Plain(docs.collect())
    for context in (b"\xff" * K, b"cadab"[:K], b"zzzzz"[:K], b"racad"[:K]):
        assert sum(10 ** plain.log10(context, s) for s in range(256)) == pytest.approx(1)
