"""Language identification with interpolated Kneser-Ney character models.

Texts are read as lower-case letters, all else as single blanks. Each language
has a character model of order ``ORDER``. The models share tables, one per
order: sorted hashes of the n-grams any language has, beside them the log
probability that each language gives to the n-gram's last character, and what
it backs off with. A text goes to the language whose cross-entropy per
character is the least, and is rejected where that lies too far above what the
language's own texts have.

The models are fitted on a bounded sample of the labelled rows: about
``TRAIN_DOCS`` documents of each language, chosen by a hash of their id, and of
each at most ``TRAIN_PASSAGES`` passages of ``PASSAGE`` characters, evenly
spread over the whole text. Scoring reads every text whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .batches import map_batches, text_slices

ORDER = 4
TRAIN_DOCS = 2_000
TRAIN_PASSAGES = 8
PASSAGE = 1_024
#: A text is rejected when its cross-entropy lies this part of the way from its language's own texts to
#: other languages' texts, and so many deviations of a text of its length above that.
REJECT_WAY, REJECT_DEVIATIONS = 1.0, 4.0
UNKNOWN = "und"
DIGIT = re.compile("[0-9]")

_BASE = pow(0x9E3779B97F4A7C15, 1, 1 << 64)
_POWERS = [np.uint64(pow(_BASE, n, 1 << 64)) for n in range(16)]
_LETTER: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def _coded(chars: np.ndarray) -> np.ndarray:
    """Which characters are in a run of a to z and 0 to 9 that holds a digit."""
    digit = (chars >= 48) & (chars <= 57)
    inside = digit | ((chars >= 97) & (chars <= 122))
    run = np.cumsum(inside & ~np.concatenate([[False], inside[:-1]]))
    held = np.zeros(int(run[-1]) + 1, bool)
    held[run[digit]] = True
    return inside & held[run]


def normal(text: str) -> np.ndarray:
    """Code points of the lower-case letters, words parted by one blank, a blank at either end; empty without letters.

    A to Z beside a digit, as in keys and codes, are no words: such a run of letters and digits is a blank,
    unless that takes more than half of a text's letters. All other letters are read, whatever stands beside them.
    """
    chars = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    letter = _letters()[chars]
    if DIGIT.search(text):
        plain = letter & ~_coded(chars)
        if 2 * np.count_nonzero(plain) >= np.count_nonzero(letter):
            letter = plain
    if not letter.any():
        return chars[:0]
    chars = np.where(letter, chars, np.uint32(32))
    chars = np.concatenate([[np.uint32(32)], chars, [np.uint32(32)]])
    blank = chars == 32
    return chars[~(blank & np.concatenate([[False], blank[:-1]]))]


def _keys(chars: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the 1-grams up to ``order``-grams that end at each character; by order, aligned at the end."""
    with np.errstate(over="ignore"):
        keys = [chars.astype(np.uint64) + np.uint64(1)]
        for n in range(1, order):
            keys.append(keys[-1][1:] + (chars[: len(chars) - n].astype(np.uint64) + np.uint64(1)) * _POWERS[n])
    return keys


def _key(gram: str) -> int:
    chars = np.array([ord(c) for c in gram], np.uint32)
    return int(_keys(chars, len(gram))[-1][-1])


@dataclass
class Model:
    """Tables by order (first: 1-grams), a column for each language."""

    langs: list[str]
    hashes: list[np.ndarray]
    log_p: list[np.ndarray]  # of an n-gram's last character after the others
    back_off: list[np.ndarray]  # of an n-gram as a context
    unseen: np.ndarray  # of a character that no language has
    limit: np.ndarray  # the cross-entropy beyond which a long text is rejected
    within: np.ndarray  # variance of a character
    sharpness: float = 1.0

    def _find(self, n: int, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        table = self.hashes[n]
        at = np.searchsorted(table, keys)
        at[at == len(table)] = 0
        return at, table[at] == keys

    def scored(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropies by text and language, in nats per character, and the characters."""
        order = len(self.hashes)
        chars = [np.concatenate([np.full(order - 2, 32, np.uint32), t]) for t in texts]
        sizes = np.array([max(1, len(c) - order + 1) for c in chars])
        joined = np.concatenate(chars)
        keys = _keys(joined, order)
        # the last character of each event; none spans two texts
        ends = np.cumsum([len(c) for c in chars])
        last = np.concatenate([np.arange(e - s, e) for e, s in zip(ends, sizes)])
        log_p = self._events(keys, last, order - 1)
        starts = np.cumsum(sizes) - sizes
        return -np.add.reduceat(log_p, starts, axis=0) / sizes[:, None], sizes

    def _events(self, keys: list[np.ndarray], last: np.ndarray, n: int) -> np.ndarray:
        """Log probabilities of the characters at ``last`` after the n before each."""
        at, found = self._find(n, keys[n][last - n])
        out = self.log_p[n][at]
        if not found.all():
            rest = last[~found]
            if n:
                context, known = self._find(n - 1, keys[n - 1][rest - n])
                lower = self._events(keys, rest, n - 1) + np.where(known[:, None], self.back_off[n - 1][context], 0.0)
            else:
                lower = np.broadcast_to(self.unseen, (len(rest), len(self.langs)))
            out[~found] = lower
        return out

    def judged(self, entropy: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The best language's column, its share of belief (0 to 1), and whether the text is rejected."""
        best = entropy.argmin(axis=1)
        weight = np.exp(-(entropy - entropy.min(axis=1, keepdims=True)) * self.sharpness * np.sqrt(sizes)[:, None])
        score = 1.0 / weight.sum(axis=1)
        allowed = self.limit[best] + REJECT_DEVIATIONS * np.sqrt(self.within[best] / sizes)
        return best, score, entropy.min(axis=1) > allowed


def _discount(counts: Counter) -> float:
    once, twice = (sum(1 for c in counts.values() if c == k) for k in (1, 2))
    return once / (once + 2 * twice) if once and twice else 0.5


def _smoothed(counts: Counter, order: int, highest: float | None = None) -> tuple[list[dict], list[dict], float]:
    """Interpolated Kneser-Ney of one language: by order, n-gram to log probability and context to back-off.

    ``highest``: the discount of the highest order, if not to be taken from these counts."""
    levels: list[Counter] = [Counter() for _ in range(order)]
    levels[order - 1] = counts
    for n in range(order - 2, -1, -1):  # lower orders count the distinct characters before
        for gram in levels[n + 1]:
            levels[n][gram[1:]] += 1
    prob: list[dict] = [{} for _ in range(order)]
    back: list[dict] = [{} for _ in range(order)]
    alphabet = len(levels[0]) + 1
    lower: dict[str, float] = {}
    for n in range(order):
        discount = _discount(levels[n]) if n < order - 1 or highest is None else highest
        total, kinds = Counter(), Counter()
        for gram, c in levels[n].items():
            total[gram[:-1]] += c
            kinds[gram[:-1]] += 1
        share = {u: discount * kinds[u] / total[u] for u in total}
        for gram, c in levels[n].items():
            u = gram[:-1]
            base = lower[gram[1:]] if n else 1 / alphabet
            prob[n][gram] = (c - discount) / total[u] + share[u] * base
        if n:
            back[n - 1] = {u: math.log(s) for u, s in share.items()}
        else:
            rest = share[""] / alphabet if share else 1 / alphabet
        lower = prob[n]
    return [{g: math.log(p) for g, p in level.items()} for level in prob], back, math.log(rest)


def _assemble(counts: dict[str, Counter], order: int, highest: dict[str, float] | None = None) -> Model:
    langs = sorted(counts)
    fitted = {lang: _smoothed(counts[lang], order, (highest or {}).get(lang)) for lang in langs}
    none = np.zeros(len(langs))
    model = Model(langs, [], [], [], np.array([fitted[x][2] for x in langs]), none, none)
    values: list[dict[str, np.ndarray]] = []
    for n in range(order):
        grams = sorted({g for x in langs for g in fitted[x][0][n]} | {u for x in langs for u in fitted[x][1][n]})
        table: dict[str, np.ndarray] = {}
        for g in grams:
            row = np.empty(len(langs))
            for i, x in enumerate(langs):
                p = fitted[x][0][n].get(g)
                if p is None:  # not in this language: back off
                    if n:
                        low = values[n - 1].get(g[1:])
                        p = fitted[x][1][n - 1].get(g[:-1], 0.0) + (low[i] if low is not None else fitted[x][2])
                    else:
                        p = fitted[x][2]
                row[i] = p
            table[g] = row
        values.append(table)
        keys = np.array([_key(g) for g in grams], np.uint64)
        sorting = np.argsort(keys)
        model.hashes.append(keys[sorting])
        model.log_p.append(np.array([table[g] for g in grams])[sorting])
        model.back_off.append(np.array([[fitted[x][1][n].get(g, 0.0) for x in langs] for g in grams])[sorting])
    return model


def _passages(chars: np.ndarray) -> list[np.ndarray]:
    if len(chars) <= PASSAGE * TRAIN_PASSAGES:
        return [chars]
    step = (len(chars) - PASSAGE) / (TRAIN_PASSAGES - 1)
    return [chars[int(i * step) : int(i * step) + PASSAGE] for i in range(TRAIN_PASSAGES)]


def sample_labelled(docs: DataFrame, lang: str, text: str, per_lang: int = TRAIN_DOCS) -> DataFrame:
    """``lang, text, fold`` of about ``per_lang`` different texts of each language, by a hash of the text; all texts of a rare one.

    Ids are not read: they may be missing or repeated. A text that many rows have is met once.
    """
    spark = docs.sparkSession
    named = docs.where(docs[lang].isNotNull() & docs[text].isNotNull())
    different = F.approx_count_distinct(F.xxhash64(named[text])).alias("n")
    counts = named.groupBy(named[lang].cast("string").alias("lang")).agg(different).collect()  # a row per language
    spread = F.pmod(F.xxhash64(named[text], F.lit("language sample")), F.lit(1 << 40))
    limits = spark.createDataFrame([(r["lang"], min(1 << 40, (1 << 40) * per_lang // max(1, r["n"]))) for r in counts], "lang string, below long")
    fold = F.pmod(F.xxhash64(named[text], F.lit("language fold")), F.lit(4))
    rows = named.select(named[lang].cast("string").alias("lang"), named[text].alias("text"), spread.alias("at"), fold.alias("fold"))
    return rows.join(F.broadcast(limits), "lang").where("at < below").select("lang", "text", "fold").distinct()


def train(docs: DataFrame, lang: str = "lang", text: str = "text", order: int = ORDER) -> Model:
    """Fit and calibrate the models on labelled rows: three parts of the sample to count, one to calibrate.

    What reaches the driver is bounded by the sample. A language is learned if
    a sampled text of it has a letter; without any, the model knows none. An
    n-gram that one sampled text alone has teaches nothing, unless a language has
    no others: a text under the wrong label can't vouch for itself.
    """
    sample = sample_labelled(docs, lang, text)
    schema = "lang string, fold int, gram string, n long, docs long"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_slices(batches, 1):
            grams, holders = Counter(), Counter()
            for label, fold, t in zip(part.column(0).to_pylist(), part.column(2).to_pylist(), texts):
                own: Counter = Counter()
                for chars in _passages(normal(t)):
                    line = " " * (order - 2) + chars.tobytes().decode("utf-32-le") if len(chars) else ""
                    own.update((label, int(fold == 0), line[i : i + order]) for i in range(len(line) - order + 1))
                grams.update(own)
                holders.update(own.keys())
            if grams:
                rows = list(grams)
                columns = [pa.array([r[i] for r in rows]) for i in range(3)]
                columns[1] = columns[1].cast(pa.int32())
                columns += [pa.array([c[r] for r in rows], pa.int64()) for c in (grams, holders)]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "fold", "gram", "n", "docs"])

    counted = map_batches(sample, count, schema).groupBy("lang", "fold", "gram").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    parts: dict[str, list[Counter]] = defaultdict(lambda: [Counter(), Counter()])
    shared: dict[str, list[Counter]] = defaultdict(lambda: [Counter(), Counter()])
    for r in counted.collect():
        parts[r["lang"]][r["fold"]][r["gram"]] = r["n"]
        if r["docs"] > 1:
            shared[r["lang"]][r["fold"]][r["gram"]] = r["n"]
    every = {x: a or b for x, (a, b) in parts.items()}
    counts = {x: shared[x][0] or shared[x][1] or c for x, c in every.items()}
    if not counts:
        none = np.zeros(0)
        return Model([], [], [], [], none, none, none)
    return _calibrated(_assemble(counts, order, {x: _discount(c) for x, c in every.items()}), sample)


def _calibrated(model: Model, sample: DataFrame) -> Model:
    """Where each language rejects, how far its texts stray, and how sharply belief falls with cross-entropy."""
    shared = sample.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for part, texts in text_slices(batches, 1):
            pairs = [(x, c) for x, t in zip(part.column(0).to_pylist(), texts) if len(c := normal(t))]
            if pairs:
                entropy, sizes = fitted.scored([c for _, c in pairs])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x for x, _ in pairs]), pa.array(entropy.tolist(), pa.list_(pa.float64())), pa.array(sizes, pa.int64())],
                    names=["lang", "entropy", "size"],
                )

    rows = map_batches(sample.where("fold = 0"), score, "lang string, entropy array<double>, size long").collect()
    index = {x: i for i, x in enumerate(model.langs)}
    rows = [r for r in rows if r["lang"] in index]
    model.limit, model.within = np.full(len(index), math.inf), np.ones(len(index))
    for lang, i in index.items():
        own = np.array([r["entropy"][i] for r in rows if r["lang"] == lang])
        size = np.array([r["size"] for r in rows if r["lang"] == lang], float)
        if len(own) < 20:  # too few to tell: reject nothing
            continue
        usual = np.median(own)
        other = [r["entropy"][i] for r in rows if r["lang"] != lang]
        far = np.median(other) if other else -model.unseen[i]
        model.limit[i] = usual + REJECT_WAY * max(far - usual, 0.0)
        model.within[i] = max(float(np.median((own - usual) ** 2 * size)), 1.0)
    if rows:
        entropy = np.array([r["entropy"] for r in rows])
        size = np.sqrt(np.array([r["size"] for r in rows], float))[:, None]
        own = np.array([index[r["lang"]] for r in rows])
        gain = -(entropy - entropy.min(axis=1, keepdims=True)) * size

        def loss(sharp: float) -> float:
            return float(np.mean(np.log(np.exp(gain * sharp).sum(axis=1)) - gain[np.arange(len(own)), own] * sharp))

        model.sharpness = min((0.25, 0.5, 1.0, 2.0, 4.0, 8.0), key=loss)
    return model


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns in ``keep``, ``lang_pred``, ``score`` (belief, 0 to 1), ``entropy``, ``rejected``.

    A null text, one without letters, and any text if no language was learned is
    ``und`` with score 0, and rejected. Rejected texts with letters still name
    the nearest language. Nothing but the text is read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the training sample
    place = keep.index(text) if text in keep else len(keep)  # a text that is kept goes out and back once
    schema = T.StructType(
        [docs.schema[c] for c in keep]
        + list(T.StructType.fromDDL("lang_pred string, score double, entropy double, rejected boolean"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for part, texts in text_slices(batches, place, 500_000):
            names, scores, entropies, rejected = ([x] * len(texts) for x in (UNKNOWN, 0.0, None, True))
            read = [(i, c) for i, t in enumerate(texts) if t and len(c := normal(t))] if fitted.langs else []
            if read:
                entropy, sizes = fitted.scored([c for _, c in read])
                best, belief, out = fitted.judged(entropy, sizes)
                for (i, _), at, score, low, gone in zip(read, best, belief, entropy.min(axis=1), out):
                    names[i], scores[i], entropies[i], rejected[i] = fitted.langs[at], float(score), float(low), bool(gone)
            columns = [part.column(i) for i in range(len(keep))]
            columns += [pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(entropies, pa.float64()), pa.array(rejected, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    given = docs.select(*keep) if text in keep else docs.select(*keep, docs[text].alias("_text"))
    return map_batches(given, run, schema)


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0; a null id is."""
    return F.coalesce(F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(True))
