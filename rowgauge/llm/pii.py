"""Personal data: patterns, and a skip-chain conditional random field over a document's tokens.

The patterns give the base spans. The field labels the tokens that hold a digit
or an ``@``: each has a potential from its shape, shares one with the token
next to it, and, however far away, one with the earlier token of the same digits or
letters, so that a number written in another way takes the label it has
elsewhere in the document. Tokens of base spans keep their labels. Loopy
message passing gives every token's belief; tokens believed to be an entity
beyond ``BELIEF`` add spans. A repeated token is linked to its last and its
first occurrence, so that edges stay in proportion to tokens.

Weights are fitted by pseudo-likelihood to the base labels of a bounded sample:
about ``TRAIN_DOCS`` documents by a hash of their id, a run of at most
``TRAIN_TOKENS`` tokens of each.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_batches, text_slices

KINDS = ("email", "ip", "card", "phone")
LABELS = ("", *KINDS)
#: Neighbouring tokens of such a kind are one span up to so many digits; of the others, each is its own.
LONGEST = {"card": 19, "phone": 15}
TRAIN_DOCS = 8_000
TRAIN_TOKENS = 200
BELIEF = 0.95
ROUNDS = 10

AT_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
# a run of digits is taken whole, so none is tried from its middle
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
TOKEN = re.compile(r"\S+")
HINT = re.compile(r"[0-9@]")
DIGIT = re.compile(r"[0-9]")
ANY_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = ord(c) - 48
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        total += n
    return total % 10 == 0


def small_number(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or "0") <= 255


def emails(text: str) -> list[Span]:
    """Every ``@`` with a domain after it and the run of local characters before, in one pass."""
    out: list[Span] = []
    taken = 0
    at = text.find("@")
    while at >= 0:
        domain = AT_DOMAIN.match(text, at)
        start = at
        if domain:
            while start > taken and LOCAL.match(text[start - 1]):
                start -= 1
        if start < at:
            out.append(("email", start, domain.end()))
            taken = domain.end()
        at = text.find("@", max(at + 1, taken))
    return out


def base_spans(text: str) -> list[Span]:
    """The patterns' spans, by kind, then start."""
    out = emails(text)
    if HINT.search(text):
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small_number, m[0].split(".")))]
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start() <= 37 and 13 <= len(digits := ANY_DIGITS.sub("", m[0])) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return out


def joined(spans: list[Span]) -> str:
    order = sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))
    return ",".join(f"{k}:{a}:{b}" for k, a, b in order)


# ---- tokens and their features ----

FEATURES = 20


def _features(token: str, digits: str) -> list[int]:
    """The shape of a token, as the features that hold."""
    n = len(digits)
    dots = token.count(".")
    letters = any(c.isalpha() for c in token)
    sizes = (0, 3, 6, 9, 12, 19)
    out = [0, 1 + sum(n > s for s in sizes)]  # 1 to 7
    out += [8] if "@" in token else []
    out += [9] if dots == 3 else [10] if dots else []
    out += [11] if letters else []
    out += [12] if token[0] == "+" else [13] if token[0] == "(" else []
    out += [14] if "-" in token[1:] else []
    out += [15] if '"' in token or "=" in token else []
    out += [16] if 13 <= n <= 19 and luhn(digits) and not letters else []
    if dots >= 3 and not letters:
        parts = [p for p in ANY_DIGITS.split(token) if p]
        out += [17] if len(parts) == 4 and all(map(small_number, parts)) else []
    out += [18] if n and n == len(token) else []
    out += [19] if "@" in token and AT_DOMAIN.search(token) else []
    return out


@dataclass
class Tokens:
    """The tokens of one document that may be entities."""

    spans: list[tuple[int, int]]
    features: list[list[int]]
    labels: list[int]  # 0 where no base span lies
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    digits: list[int] = field(default_factory=list)


PUNCTUATION = ".,;:!?\"'`|<>[]{}$%&*#="


def tokens_of(text: str, base: list[Span]) -> Tokens:
    found = Tokens([], [], [], [], [])
    marks = sorted((a, b, LABELS.index(k)) for k, a, b in base)
    last_end, next_mark = -2, 0
    first: dict[str, int] = {}
    last: dict[str, int] = {}
    for m in TOKEN.finditer(text):
        if not HINT.search(text, m.start(), m.end()):
            continue
        core = m[0].rstrip(PUNCTUATION)
        shift = len(core) - len(core := core.lstrip(PUNCTUATION))
        if not core:
            continue
        start = m.start() + shift
        end = start + len(core)
        while next_mark < len(marks) and marks[next_mark][1] <= start:
            next_mark += 1
        over = [k for a, b, k in marks[next_mark : next_mark + 8] if a < end and b > start]
        digits = ANY_DIGITS.sub("", core)
        i = len(found.spans)
        found.spans.append((start, end))
        found.features.append(_features(core, digits))
        found.digits.append(len(digits))
        found.labels.append(min(over) if over else 0)
        if m.start() - last_end <= 1 and i:
            found.chain.append((i - 1, i))
        last_end = m.end()
        key = "".join(c for c in core.lower() if c.isalnum()) if "@" in core else digits
        if len(key) >= 7:
            if key in last:
                found.skip.append((last[key], i))
                if first[key] != last[key]:
                    found.skip.append((first[key], i))
            first.setdefault(key, i)
            last[key] = i
    return found


# ---- the field ----


@dataclass
class Field:
    shape: np.ndarray  # features by labels
    chain: np.ndarray  # labels by labels
    skip: np.ndarray


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def beliefs(own: np.ndarray, edges: np.ndarray, between: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Marginals by loopy message passing. own: log potentials; edges: pairs; between: a matrix for each edge."""
    if len(edges):
        a, b = edges.T
        to_b, to_a = np.zeros((2, len(edges), own.shape[1]))
        for _ in range(rounds):
            total = own.copy()
            np.add.at(total, b, to_b)
            np.add.at(total, a, to_a)
            new_b = _log_sum((total[a] - to_a)[:, :, None] + between, 1)
            new_a = _log_sum((total[b] - to_b)[:, None, :] + between, 2)
            to_b = 0.5 * to_b + 0.5 * (new_b - _log_sum(new_b, 1)[:, None])
            to_a = 0.5 * to_a + 0.5 * (new_a - _log_sum(new_a, 1)[:, None])
        own = own.copy()
        np.add.at(own, b, to_b)
        np.add.at(own, a, to_a)
    return np.exp(own - _log_sum(own, 1)[:, None])


def _own(field: Field, features: list[list[int]]) -> np.ndarray:
    sizes = [len(f) for f in features]
    flat = np.fromiter((x for f in features for x in f), np.int64)
    return np.add.reduceat(field.shape[flat], np.cumsum(sizes) - sizes, axis=0)


def added_spans(field: Field, docs: list[tuple[list[Span], Tokens]]) -> list[list[Span]]:
    """What the field adds to each document; all of them are one graph without edges between documents."""
    features = [f for _, t in docs for f in t.features]
    if not features:
        return [[] for _ in docs]
    own = _own(field, features)
    labels = np.array([x for _, t in docs for x in t.labels])
    known = np.flatnonzero(labels)
    own[known] = -30.0
    own[known, labels[known]] = 0.0
    pairs, between, offset = [], [], 0
    for _, t in docs:
        for edges, matrix in ((t.chain, field.chain), (t.skip, field.skip)):
            pairs += [(a + offset, b + offset) for a, b in edges]
            between += [matrix] * len(edges)
        offset += len(t.spans)
    belief = beliefs(own, np.array(pairs, np.int64).reshape(-1, 2), np.array(between).reshape(-1, len(LABELS), len(LABELS)))
    best = belief.argmax(axis=1)
    sure = (belief.max(axis=1) >= BELIEF) & (best > 0) & (labels == 0)
    out, offset = [], 0
    for _, t in docs:
        spans: list[Span] = []
        before, linked, digits, counts = -2, set(t.chain), 0, t.digits
        for i, (start, end) in enumerate(t.spans):
            if sure[offset + i]:
                kind = LABELS[best[offset + i]]
                digits += counts[i]
                if before == i - 1 and spans[-1][0] == kind and (before, i) in linked and digits <= LONGEST.get(kind, 0):
                    spans[-1] = (kind, spans[-1][1], end)
                else:
                    spans.append((kind, start, end))
                    digits = counts[i]
                before = i
        out.append(spans)
        offset += len(t.spans)
    return out


def _symmetric(m: np.ndarray) -> np.ndarray:
    return (m + m.T) / 2


def fit(docs: list[Tokens], steps: int = 300, rate: float = 1.0, keep: float = 1e-4) -> Field | None:
    """Maximum pseudo-likelihood: each label given its token's shape and its neighbours' labels."""
    n = len(LABELS)
    y = np.array([x for t in docs for x in t.labels])
    if not len(y):
        return None
    shape = np.zeros((len(y), FEATURES))
    near = np.zeros((2, len(y), n))
    offset = 0
    for t in docs:
        for i, f in enumerate(t.features):
            shape[offset + i, f] = 1.0
        for side, edges in zip(near, (t.chain, t.skip)):
            for a, b in edges:
                side[offset + a, t.labels[b]] += 1
                side[offset + b, t.labels[a]] += 1
        offset += len(t.labels)
    true = np.eye(n)[y]
    weights = [np.zeros((FEATURES, n)), np.zeros((n, n)), np.zeros((n, n))]
    pace = [np.zeros_like(w) for w in weights]
    inputs = [shape, near[0], near[1]]
    for _ in range(steps):
        score = sum(x @ w for x, w in zip(inputs, weights))
        off = true - np.exp(score - _log_sum(score, 1)[:, None])
        for i, x in enumerate(inputs):
            slope = x.T @ off / len(y) - keep * weights[i]
            pace[i] = 0.9 * pace[i] + (_symmetric(slope) if i else slope)
            weights[i] = weights[i] + rate * 0.3 * pace[i]
    return Field(*weights)


def _window(t: Tokens, seed: int) -> Tokens:
    """A run of at most ``TRAIN_TOKENS`` tokens, placed by a hash."""
    extra = len(t.spans) - TRAIN_TOKENS
    if extra <= 0:
        return t
    first = seed % (extra + 1)
    last = first + TRAIN_TOKENS
    inside = lambda edges: [(a - first, b - first) for a, b in edges if first <= a and b < last]
    return Tokens(t.spans[first:last], t.features[first:last], t.labels[first:last], inside(t.chain), inside(t.skip))


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> Field | None:
    """Fit the field on the sample; none if it has no tokens, and then only patterns are found."""
    total = docs.agg(F.approx_count_distinct(F.xxhash64(docs[text]))).first()[0]
    spread = F.pmod(F.xxhash64(docs[text], F.lit("field sample")), F.lit(1 << 40))
    # by text: ids may be missing or repeated, and a text that many rows have is met once
    sample = docs.where(spread < min(1 << 40, (1 << 40) * TRAIN_DOCS // max(1, total))).select(docs[text].alias("_text")).distinct()
    schema = "labels array<int>, features array<array<int>>, chain array<array<int>>, skip array<array<int>>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts in text_slices(batches, 0):
            found = []
            for t in texts:
                tokens = tokens_of(t or "", base_spans(t or ""))
                if tokens.spans:
                    found.append(_window(tokens, zlib.crc32(t.encode())))
            pairs = pa.list_(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([t.labels for t in found], pa.list_(pa.int32())),
                    pa.array([t.features for t in found], pairs),
                    pa.array([[list(e) for e in t.chain] for t in found], pairs),
                    pa.array([[list(e) for e in t.skip] for t in found], pairs),
                ],
                names=["labels", "features", "chain", "skip"],
            )

    rows = map_batches(sample, read, schema).collect()
    rows = sorted(rows, key=lambda r: (r["labels"], r["features"], r["chain"], r["skip"]))  # sums in one order
    return fit([Tokens([], r["features"], r["labels"], r["chain"], r["skip"]) for r in rows])


def find_pii(docs: DataFrame, field: Field | None, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, and ``base`` and ``added``: arrays of kind, start and end in code points.

    Base spans are the patterns' own; added ones lie on tokens without any. A
    null or empty text has none. Other columns are left behind.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)  # a few hundred weights
    span = T.StructType.fromDDL("kind string, start int, end int")
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.ArrayType(span)) for c in ("base", "added")])
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def rows(spans: list[list[Span]]) -> pa.Array:
        order = [sorted(s, key=lambda x: (KINDS.index(x[0]), x[1])) for s in spans]
        return pa.array([[{"kind": k, "start": a, "end": b} for k, a, b in s] for s in order], arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, len(keep)):
            base = [base_spans(t) if t else [] for t in texts]
            added: list[list[Span]] = [[] for _ in texts]
            if shared.value is not None:
                hinted = [i for i, t in enumerate(texts) if t and HINT.search(t)]
                graph = [(base[i], tokens_of(texts[i], base[i])) for i in hinted]
                for i, spans in zip(hinted, added_spans(shared.value, graph)):
                    added[i] = spans
            yield pa.RecordBatch.from_arrays(
                [*(part.column(i) for i in range(len(keep))), rows(base), rows(added)], names=schema.names
            )

    return map_batches(docs.select(*keep, docs[text].alias("_text")), run, schema)
