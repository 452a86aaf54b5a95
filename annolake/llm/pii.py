"""Personal data in text: fixed patterns, and a character BiLSTM-CRF that adds spans to theirs.

The tagger is trained in numpy on windows of the corpus: a bounded, hash-chosen sample (`max_windows`), labelled by the
patterns' own spans, with generated entries written into some windows (also in spellings that the patterns do not
know, such as "name (at) host dot tld" or a national telephone number). Every whole text is then read in
overlapping windows; where two windows overlap each decides the half that is nearer to its middle, so a
text gets one tag per character, and its runs of tags are spans over the whole text. A tagged span is added if it is
sure (mean margin over "no entry"), plausible for its kind (a run of card numbers is split into those that pass Luhn), and touches
no pattern span; pattern spans always stay.

Defined cases: null and empty texts have no spans; positions are code points, end exclusive; repeated rows are tagged alike;
other columns are not read; without any text the tagger trains on generated windows alone.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import util
from .bilstm import PAD, TAGS, Tagger, symbols

KINDS = TAGS[1:]
WINDOW, OVERLAP = 512, 64
BATCH = 512
SURE = 1.0
SHORTEST = 7
TRAIN_STEPS = 96

_AT = re.compile(r"@|\bat\b", re.I)
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# possessive and bounded by a look-behind: a failing run of digits is not tried again from its middle
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = 2 * d - 9 if d > 4 else 2 * d
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= sum(map(str.isdigit, m[0])) <= 15:
            yield m.span()


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind, start, end) by the patterns, kinds in order, each kind left to right without overlaps."""
    if not text:
        return []
    return [(k, a, b) for k, find in enumerate((_emails, _ips, _cards, _phones)) for a, b in find(text)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


# -- training ---------------------------------------------------------------------------------------------------------


def _sample(rate_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            out: tuple[list, list, list] = ([], [], [])
            for h, text in zip(whole.column("h").to_pylist(), whole.column("text").to_pylist(), strict=True):
                if not text:
                    continue
                spans = base_spans(text)
                rng = random.Random(h)
                starts = [max(0, min(len(text) - TRAIN_STEPS, a - rng.randrange(10, 60))) for _, a, _ in spans[:2]]
                starts += [rng.randrange(max(1, len(text) - TRAIN_STEPS)) for _ in range(rate_rows)]
                for j, s in enumerate(starts):
                    piece = text[s : s + TRAIN_STEPS]
                    tags = bytearray(len(piece))
                    for k, a, b in spans:
                        lo, hi = max(a - s, 0), min(b - s, len(piece))
                        if lo < hi:
                            tags[lo:hi] = bytes([k + 1]) * (hi - lo)
                    out[0].append(hash((h, j)) & (2**62 - 1))
                    out[1].append(piece)
                    out[2].append(bytes(tags))
            yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.string()), pa.array(out[2], pa.binary())], ["h", "piece", "tags"])

    return run


def _generated(rng: random.Random) -> tuple[int, str]:
    """A made-up entry: (tag, text)."""
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9)))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    kind = rng.randrange(4)
    if kind == 0:
        host = ".".join([word(), *([word()] if rng.random() < 0.4 else []), rng.choice(["com", "org", "net", "io", "de", "fr", "co.uk"])])
        name = rng.choice([".", "_", "-", ""]).join([word(), word()]) + (digits(2) if rng.random() < 0.4 else "")
        at = rng.choice(["@"] * 6 + [" (at) ", " [at] ", "(at)", "[at]", " @ "])
        if "at" in at and rng.random() < 0.6:
            host = host.replace(".", rng.choice([" dot ", " (dot) ", "[dot]"]))
        return 1, name + at + host
    if kind == 1:
        return 2, ".".join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == 2:
        d = digits(15)
        d += next(str(x) for x in range(10) if luhn(d + str(x)))
        gap = rng.choice(["", " ", "-"])
        return 3, gap.join(d[i : i + 4] for i in range(0, 16, 4))
    area, a, b = digits(3), digits(3), digits(4)
    return 4, rng.choice([f"+{rng.randint(1, 99)} ({area}) {a}-{b}", f"+{rng.randint(1, 99)} {area} {a} {b}", f"+{rng.randint(1, 99)}-{area}-{a}-{b}", f"({area}) {a}-{b}", f"{area}-{a}-{b}"])


def _decoy(rng: random.Random) -> str:
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    return rng.choice(
        [digits(rng.randint(1, 9)), f"{digits(1)}.{digits(2)}", f"20{digits(2)}-{digits(2)}-{digits(2)}", f"{digits(2)}:{digits(2)}", f"v{digits(1)}.{digits(1)}.{digits(1)}",
         "".join(rng.choice("0123456789abcdef") for _ in range(rng.randint(12, 40))), f"{digits(1)},{digits(3)},{digits(3)}", "@", "at", "dot", "+", f"{digits(2)}%", f"({digits(2)})"]
    )


def training_windows(pieces: list[tuple[str, bytes]], seed: int = 11, least: int = 1200) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags (TRAIN_STEPS, N): the sampled windows, and copies with generated entries and decoys."""
    rng = random.Random(seed)
    ids, tags = [], []

    def add(text: str, marks: bytes) -> None:
        row, mark = np.full(TRAIN_STEPS, PAD, np.uint8), np.zeros(TRAIN_STEPS, np.int64)
        s = symbols(text)[:TRAIN_STEPS]
        row[: len(s)], mark[: len(s)] = s, np.frombuffer(marks, np.uint8)[: len(s)]
        ids.append(row)
        tags.append(mark)

    plain = [p for p in pieces if not any(p[1])] or [("", b"")]
    for text, marks in pieces:
        add(text, marks)
    for _ in range(max(least, len(pieces))):
        text, _ = plain[rng.randrange(len(plain))]
        at = rng.randrange(min(50, len(text)) + 1)
        at = text.find(" ", at) + 1 if rng.random() < 0.9 else at
        tag, entry = _generated(rng) if rng.random() < 0.75 else (0, _decoy(rng))
        gap = rng.choice([" ", " ", " ", ", ", ".\n", ": "])
        before = text[:at]
        add(before + entry + gap + text[at:], bytes(len(before)) + bytes([tag]) * len(entry) + bytes(len(gap) + len(text) - at))
    return np.array(ids).T.copy(), np.array(tags).T.copy()


def train(docs: DataFrame, max_windows: int = 1500, epochs: int = 8, seed: int = 5) -> Tagger:
    """A tagger from at most `max_windows` windows of the corpus, taken in the order of a hash."""
    util.small_batches(docs.sparkSession)
    rows = docs.select(F.xxhash64("doc_id", "text", F.lit(seed)).alias("h"), "text").where("text is not null")
    chosen = util.hash_sample(rows, max_windows)  # about as many documents as windows
    found = chosen.mapInArrow(_sample(1), "h long, piece string, tags binary").orderBy("h", "piece").limit(max_windows).collect()
    tagger = Tagger()
    tagger.train(*training_windows([(r.piece, bytes(r.tags)) for r in found]), epochs=epochs)
    return tagger


# -- application --------------------------------------------------------------------------------------------------------


def tag_texts(texts: list[str], tagger: Tagger) -> list[tuple[np.ndarray, np.ndarray]]:
    """Tag and margin of every character of every text."""
    coded = [symbols(t) for t in texts]
    jobs = []  # (text, window start, first and last position that the window decides)
    step = WINDOW - OVERLAP
    for d, c in enumerate(coded):
        n, s = len(c), 0
        while n:
            last = s + WINDOW >= n
            jobs.append((d, s, s if s == 0 else s + OVERLAP // 2, n if last else s + WINDOW - OVERLAP // 2))
            if last:
                break
            s += step
    tags = [np.zeros(len(c), np.int8) for c in coded]
    margins = [np.zeros(len(c), np.float32) for c in coded]
    jobs.sort(key=lambda j: min(WINDOW, len(coded[j[0]]) - j[1]))
    for at in range(0, len(jobs), BATCH):
        some = jobs[at : at + BATCH]
        sizes = np.array([min(WINDOW, len(coded[d]) - s) for d, s, _, _ in some])
        ids = np.full((int(sizes.max()), len(some)), PAD, np.uint8)
        for k, (d, s, _, _) in enumerate(some):
            ids[: sizes[k], k] = coded[d][s : s + sizes[k]]
        best, margin = tagger.decode(ids, sizes)
        hit = best.any(axis=0)
        for k in np.flatnonzero(hit).tolist():
            d, s, a, b = some[k]
            tags[d][a:b] = best[a - s : b - s, k]
            margins[d][a:b] = margin[a - s : b - s, k]
    return list(zip(tags, margins, strict=True))


def plausible(kind: int, entry: str) -> bool:
    """Whether a tagged run has what every entry of its kind has: an at sign or word, or enough digits."""
    if kind == 0:
        return bool(_AT.search(entry))
    return sum(map(str.isdigit, entry)) >= (4 if kind == 1 else 7)


def card_numbers(text: str, a: int, b: int) -> list[tuple[int, int]]:
    """The card numbers within a tagged run, which may hold several in a row: 13 to 19 digits that pass Luhn, begin where a group
    of digits or the number before ends, and end where a group ends or another number can begin."""
    at = [i for i in range(a, b) if text[i] in "0123456789"]
    digits = "".join(text[i] for i in at)
    opens = [k == 0 or at[k] != at[k - 1] + 1 for k in range(len(at))] + [True]
    out, k, fresh = [], 0, True
    while k + 13 <= len(at):
        if opens[k] or not fresh:
            for n in (16, 15, 19, 18, 17, 14, 13):
                if k + n <= len(at) and luhn(digits[k : k + n]) and (opens[k + n] or len(at) - k - n >= 13):
                    out.append((at[k], at[k + n - 1] + 1))
                    k, fresh = k + n, False
                    break
            else:
                k, fresh = k + 1, True
        else:
            k += 1
    return out


def model_spans(text: str, tags: np.ndarray, margins: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Sure runs of one tag that touch no base span."""
    if not tags.any():
        return []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], tags, [0]])))
    out = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        k = int(tags[a]) - 1
        if k < 0:
            continue
        while a < b and text[a] in " \t\r\n,;:":
            a += 1
        while b > a and text[b - 1] in " \t\r\n,;:.(":
            b -= 1
        sure = float(margins[a:b].mean()) if b > a else 0.0
        if b - a >= SHORTEST and sure >= SURE and plausible(k, text[a:b]):
            for x, y in card_numbers(text, a, b) if k == 2 else [(a, b)]:
                if not any(p < y and x < q for _, p, q in base):
                    out.append((k, x, y))
    return out


def find_texts(texts: list[str | None], tagger: Tagger) -> list[tuple[list, list]]:
    """(base spans, all spans by kind and start) of each text."""
    filled = [t or "" for t in texts]
    out = []
    for text, (tags, margins) in zip(filled, tag_texts(filled, tagger), strict=True):
        base = base_spans(text)
        out.append((base, sorted(base + model_spans(text, tags, margins, base))))
    return out


def _parts(whole: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    return util.slices(whole, column, 1 << 20)


def find(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans of every row; the counts are of base spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in _parts(whole, "text"):
                got = find_texts(part.column("text").to_pylist(), tagger)
                counts = [pa.array([sum(s[0] == k for s in base) for base, _ in got], pa.int64()) for k in range(4)]
                digests = [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in got]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *counts, pa.array(digests, pa.string()), pa.array([written(s) for _, s in got], pa.string())],
                    ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first and longest names it."""
    out, at = [], 0
    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2], s[0])):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """`docs` with masked texts; all other columns, and null texts, as they are."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in _parts(whole, whole.schema.names[at]):
                texts = part.column(at).to_pylist()
                new = [t if t is None else masked(t, s) for t, (_, s) in zip(texts, find_texts(texts, tagger), strict=True)]
                cols = list(part.columns)
                cols[at] = pa.array(new, part.schema.field(at).type)
                yield pa.RecordBatch.from_arrays(cols, schema=part.schema)

    return docs.mapInArrow(run, docs.schema)


def personal_data(docs: DataFrame, **options) -> DataFrame:
    """Train on a bounded sample of `docs`, then search every row."""
    return find(docs, train(docs, **options))
