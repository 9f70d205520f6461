"""Soft-membership mixing: document rates that bring expected domain token totals to targets.

A classifier fitted to a table of labelled documents gives every document a
posterior over domains. Rates, one per document and none negative, start at 1
and follow the projected gradient of the squared distance between the tokens
expected in each domain and their targets, with momentum, until they rest; what
a rate changes weighs a little too (``KEEP``). A step needs the domains' expected
totals alone, one aggregation of a narrow table; a rate is a function of the
posterior and of the steps so far. All of it is built-in expressions.

The classifier is a naive Bayes one over the words and shapes that a document
has. It is fitted to a bounded sample of the labelled rows: about
``TRAIN_DOCS`` documents of each domain, by a hash of their id. It keeps
at most ``MAX_FEATURES`` features, those that tell the domains apart most.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import row_key
from .storage import settle

TRAIN_DOCS = 4_000
MAX_FEATURES = 1_000
MIN_DOCS = 5
#: A feature is kept if a domain has it in this part of its documents: what a few copies say is chance.
COMMON = 0.02
#: Features below this chi-square are noise.
TELLING = 40.0
PRIOR = 2.0
#: Training rows are near copies from this likeness of their word sets on; candidates agree in a band of least hashes.
NEAR_COPY = 0.8
BANDS, BAND_ROWS = 8, 4
SOFTER = (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0)
ROUNDS = 8
#: Steps of the plain form, which weighs no change of rates.
STEPS = 60
CLOSE = 1e-5
WRITE_EVERY = 5
#: What a change of rates weighs beside the distance to the targets. Targets out of reach, as of a domain that every
#: posterior grants a little, would else be neared by dropping all but the purest documents and repeating these.
KEEP = 0.02
#: The steps end once rates, in the mean square over tokens, move by no more than this.
TOLERANCE = 1e-4
MOST_STEPS = 2_000
#: A rate this near to a whole number is that number but for rounding.
NEAR_WHOLE = 1e-6

MARKS = "!#$%&*|="
ENDS = ".,"
EVERY = "\n"  # the feature that every document has; no word can hold it


def _words(text: str) -> Column:
    """Lower-case runs between blanks and line breaks."""
    return F.array_remove(F.split(F.replace(F.lower(F.col(text)), F.lit("\n"), F.lit(" ")), " "), "")


def with_features(docs: DataFrame, id_col: str = "doc_id", text: str = "text", known: list[str] | None = None) -> DataFrame:
    """``key, doc_id, tokens, features`` of every row; of the words, those that are ``known`` if any are given.

    Marks are taken out of the words one kind after the other, which tells how
    thickly each stands, in coarse levels, as does the share of words said once.
    A null text counts as empty.
    """
    rows = docs.select(
        row_key(docs[id_col], docs[text]).alias("key"),
        docs[id_col].alias("doc_id"),
        F.coalesce(docs[text], F.lit("")).alias("b0"),
    )
    for i, mark in enumerate(MARKS + ENDS):
        rows = rows.withColumn(f"b{i + 1}", F.replace(F.col(f"b{i}"), F.lit(mark), F.lit("")))
    size = F.octet_length("b0")

    def level(i: int, mark: str) -> Column:
        n = F.octet_length(f"b{i}") - F.octet_length(f"b{i + 1}")
        return F.concat(F.lit(f"\n{mark}"), F.when(n == 0, -1).otherwise(F.floor(F.log2(1 + 1000 * n / size))).cast("string"))

    shapes = [level(i, mark).alias(f"f{i}") for i, mark in enumerate(MARKS)]
    said = rows.select("key", "doc_id", *shapes, _words(f"b{len(MARKS + ENDS)}").alias("said"))
    said = said.withColumn("kinds", F.array_distinct("said"))
    once = F.floor(10 * F.size("kinds") / F.greatest(F.size("said"), F.lit(1)))
    kept = F.col("kinds") if known is None else F.array_intersect("kinds", F.lit(known).cast("array<string>"))
    marks = [F.col(f"f{i}") for i in range(len(MARKS))]
    return said.select(
        "key",
        "doc_id",
        F.size("said").cast("long").alias("tokens"),
        F.concat(F.array(F.lit(EVERY), *marks, F.concat(F.lit("\nonce"), once.cast("string"))), kept).alias("features"),
    )


def without_near_copies(seen: DataFrame) -> DataFrame:
    """``seen`` (``key, domain, features``, others) without rows whose words are those, or nearly, of a row with a smaller key.

    Words alone are compared, within a domain. Rows that agree in the least hashes of a band of words, or in
    all words, are held against the one of them with the smallest key, and go if the
    sets' likeness is ``NEAR_COPY`` or more: a few links per row, never all pairs.
    """
    words = F.slice("features", len(MARKS) + 3, F.size("features"))  # after what every document has, the marks and "once"
    sets = settle(seen.select("key", "domain", F.transform(words, lambda w: F.xxhash64(w)).alias("words")), "words")
    place = F.pmod(F.shiftright("h", 16), F.lit(BAND_ROWS))
    least = [F.min(F.when(place == i, F.col("h"))).alias(f"m{i}") for i in range(BAND_ROWS)]
    banded = (
        sets.select("key", "domain", F.explode("words").alias("h"))
        .groupBy("key", "domain", F.pmod("h", F.lit(BANDS)).alias("band"))
        .agg(*least)
        .select("key", "domain", "band", F.xxhash64(*[f"m{i}" for i in range(BAND_ROWS)]).alias("sign"))
    )
    whole = sets.where(F.size("words") > 0).select("key", "domain", F.lit(-1).cast("long").alias("band"), F.xxhash64(F.array_sort("words")).alias("sign"))
    signs = settle(banded.union(whole), "signs")
    firsts = signs.groupBy("domain", "band", "sign").agg(F.min("key").alias("first"))
    links = signs.join(firsts, ["domain", "band", "sign"]).where("key != first").select("domain", "key", "first").distinct()
    other = sets.select("domain", F.col("key").alias("first"), F.col("words").alias("others"))
    both = F.size(F.array_intersect("words", "others"))
    like = both / (F.size("words") + F.size("others") - both)
    gone = links.join(sets, ["domain", "key"]).join(other, ["domain", "first"]).where(like >= NEAR_COPY).select("key", "domain").distinct()
    return seen.join(gone, ["key", "domain"], "left_anti")


@dataclass
class Classifier:
    domains: list[str]
    weights: DataFrame  # feature, w0, w1, ...: at most MAX_FEATURES rows, and one for what all documents share
    known: list[str]  # the words among the features
    prior: list[float]
    softer: float = 1.0


def _logits(rows: DataFrame, weights: DataFrame, n: int, *others: str) -> DataFrame:
    """``key``, the columns in ``others``, ``n_rows`` and the domains' scores ``l0, l1, ...``."""
    # no array is empty; the outer form keeps Spark from testing that, which works the features out twice
    met = rows.select("key", *others, F.explode_outer("features").alias("feature")).join(F.broadcast(weights), "feature")
    times = F.sum(F.when(F.col("feature") == EVERY, 1).otherwise(0))
    sums = met.groupBy("key").agg(
        *[F.max(c).alias(c) for c in others], times.alias("n_rows"), *[F.sum(f"w{d}").alias(f"s{d}") for d in range(n)]
    )
    return sums.select("key", *others, "n_rows", *[(F.col(f"s{d}") / F.col("n_rows")).alias(f"l{d}") for d in range(n)])


def _posterior(prior: list[float] | list[Column], softer: float | Column) -> list[Column]:
    logits = [F.col(f"l{d}") / softer + p for d, p in enumerate(prior)]
    top = F.greatest(*logits) if len(logits) > 1 else logits[0]
    parts = [F.exp(x - top) for x in logits]
    total = sum(parts[1:], parts[0])
    return [p / total for p in parts]


def train(
    docs: DataFrame, labels: DataFrame, domains: list[str], id_col: str = "doc_id", text: str = "text", domain: str = "domain"
) -> Classifier:
    """Fit to ``labels`` (id, domain), and soften on a part held back.

    Labels of other domains, null ones and those without a document are not used.
    Without labels every domain is as likely.
    """
    n = len(domains)
    known = labels.where(labels[domain].isin(*domains) & labels[id_col].isNotNull()).select(
        labels[id_col].alias("label_id"), labels[domain].alias("domain")
    )
    counts = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}  # a row per domain
    spread = F.pmod(F.xxhash64("label_id", F.lit("mixing sample")), F.lit(1 << 40))
    below = F.lit(0).cast("long")
    for name, count in counts.items():
        below = F.when(F.col("domain") == name, F.lit(min(1 << 40, (1 << 40) * TRAIN_DOCS // count))).otherwise(below)
    chosen = known.where(spread < below).distinct()
    fold = F.pmod(F.xxhash64("label_id", F.lit("mixing fold")), F.lit(4)) == 0
    wanted = (
        docs.join(F.broadcast(chosen), docs[id_col] == chosen["label_id"])  # about TRAIN_DOCS rows of each domain
        .groupBy(docs[text].alias("text"), "domain")  # copies, and below near copies, would make chance words telling
        .agg(F.min("label_id").alias("label_id"))
        .select(F.lit(None).cast("long").alias("doc_id"), "text", "domain", fold.alias("held"))
    )
    wanted = settle(wanted, "labelled")
    own = wanted.groupBy(row_key(F.col("doc_id"), F.col("text")).alias("key"), "domain").agg(F.min("held").alias("held"))
    seen = settle(with_features(wanted).dropDuplicates(["key"]).join(own, "key"), "features")
    seen = settle(without_near_copies(seen), "unlike")
    fit = seen.where("NOT held")
    sizes = {r["domain"]: r["count"] for r in fit.groupBy("domain").count().collect()}
    size = [sizes.get(d, 0) for d in domains]
    total = max(1, sum(size))
    held = [F.sum(F.when(F.col("domain") == d, 1).otherwise(0)).alias(f"c{i}") for i, d in enumerate(domains)]
    counted = fit.select("domain", F.explode_outer("features").alias("feature")).where(F.col("feature") != EVERY).groupBy("feature").agg(*held)
    every = sum((F.col(f"c{i}") for i in range(1, n)), F.col("c0"))
    usual = [F.col("every") * s / total for s in size]
    chi = sum((F.when(u > 0, (F.col(f"c{i}") - u) ** 2 / u).otherwise(0.0) for i, u in enumerate(usual)), F.lit(0.0))
    share = F.col("every") / total
    within = [(F.col(f"c{i}") + PRIOR * share) / (s + PRIOR) for i, s in enumerate(size)]
    often = F.array_max(F.array(F.lit(0.0), *[F.col(f"c{i}") / s for i, s in enumerate(size) if s]))
    weights = (
        counted.withColumn("every", every)
        .where((F.col("every") >= MIN_DOCS) & (often >= COMMON) & (share < 1))
        .withColumn("chi", chi)
        .where(F.col("chi") >= TELLING)
        .orderBy(F.desc("chi"), "feature")
        .limit(MAX_FEATURES)
        .select(
            "feature",
            *[F.log(p / share).alias(f"w{i}") for i, p in enumerate(within)],
        )
    )
    every_row = docs.sparkSession.createDataFrame([(EVERY, *[0.0] * n)], weights.schema)
    weights = settle(weights.union(every_row), "weights")
    prior = [math.log((s + 1) / (sum(size) + n)) for s in size]
    known = sorted(r["feature"] for r in weights.where(~F.col("feature").startswith("\n")).select("feature").collect())
    scores = settle(_logits(seen.where("held"), weights, n).join(seen.select("key", "domain"), "key"), "held")
    return Classifier(list(domains), weights, known, *_calibrated(scores, domains, prior, counts))


def _calibrated(scores: DataFrame, domains: list[str], prior: list[float], counts: dict[str, int]) -> tuple[list[float], float]:
    """Priors and softness fitted to documents held back: the priors bring mean posteriors to the domains' shares
    among all labels, the softness has the least log loss. Each document stands for its part of its domain's labels."""
    is_in = [(F.col("domain") == d).cast("double") for d in domains]
    here = scores.agg(*[F.sum(x) for x in is_in]).first()
    if not sum(x or 0 for x in here):
        return prior, 1.0
    every = sum(counts.get(d, 0) for d, x in zip(domains, here) if x)
    shares = [counts.get(d, 0) / every if x else 0.0 for d, x in zip(domains, here)]
    stands = sum((x * (s / n if n else 0.0) for x, s, n in zip(is_in, shares, here)), F.lit(0.0))
    tried = [(list(prior), softer) for softer in SOFTER]
    means = [F.sum(p * stands) for p in _tried_posterior(len(domains))]
    for _ in range(ROUNDS):
        for (start, _), mean in zip(tried, _by_trial(scores, tried, means)):
            for d, share in enumerate(shares):
                start[d] += math.log(max(share, 1e-4) / max(mean[d], 1e-4))
    own = sum((p * x for p, x in zip(_tried_posterior(len(domains)), is_in)), F.lit(0.0))
    loss = _by_trial(scores, tried, [F.sum(-F.log(F.greatest(own, F.lit(1e-300))) * stands)])
    return tried[min(range(len(tried)), key=lambda i: loss[i][0])]


def _tried_posterior(n: int) -> list[Column]:
    """The posteriors under the priors and the softness that the row's trial has."""
    return _posterior([F.get("_at", F.lit(d + 1)) for d in range(n)], F.get("_at", F.lit(0)))


def _by_trial(scores: DataFrame, tried: list[tuple[list[float], float]], sums: list[Column]) -> list[list[float]]:
    """The ``sums`` over all scores for each of the priors and softnesses tried, in their order.

    Every row meets every trial, so a plan holds the posteriors once and not for each trial; and as the numbers tried
    are the content of an array, Spark compiles the same code for every round. The driver's memory depends on both.
    """
    trials = F.lit([[softer, *prior] for prior, softer in tried]).cast("array<array<double>>")
    met = scores.select("*", F.posexplode(trials).alias("_trial", "_at"))
    found = met.groupBy("_trial").agg(*sums).collect()  # a row for each trial
    return [list(row[1:]) for row in sorted(found, key=lambda row: row["_trial"])]


def posteriors(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, doc_id, tokens, n_rows, p0, p1, ...``: a row per document."""
    n = len(classifier.domains)
    scores = _logits(with_features(docs, id_col, text, classifier.known), classifier.weights, n, "doc_id", "tokens")
    return scores.select("key", "doc_id", "tokens", "n_rows", *[p.alias(f"p{d}") for d, p in enumerate(_posterior(classifier.prior, classifier.softer))])


def _largest_eigenvalue(m: list[list[float]]) -> float:
    v = [1.0] * len(m)
    size = 1.0
    for _ in range(200):
        v = [sum(a * b for a, b in zip(row, v)) for row in m]
        size = max(map(abs, v)) or 1.0
        v = [x / size for x in v]
    return size


@dataclass(frozen=True)
class Step:
    """One step of all rates: along the posteriors by ``move``, back towards 1 by the part ``pull``, then on by ``drive`` times the way just made."""

    move: list[float]
    pull: float = 0.0
    drive: float = 0.0


def _moved(rows: DataFrame, step: Step) -> DataFrame:
    """``rows`` with ``_new``, the rate after a step from ``_ahead``, and ``_drive``, for posteriors ``p0, p1, ...``.

    The step's numbers are read from an array at places that hang on a column, so that Spark
    compiles the same code for every step instead of a class for each.
    """
    n = len(step.move)
    numbers = F.lit([*step.move, 1 - step.pull, step.pull, step.drive]).cast("array<double>")
    none = F.least(F.col("n_rows"), F.lit(1)) - 1  # 0: every document has a row

    def number(i: int) -> Column:
        return F.get(numbers, (none + i).cast("int"))

    along = sum((F.col(f"p{d}") * number(d) for d in range(n)), F.lit(0.0))
    new = F.greatest(F.col("_ahead") * number(n) + number(n + 1) - along, F.lit(0.0))
    return rows.withColumns({"_new": new, "_drive": number(n + 2)})


def _arrived(moved: DataFrame) -> DataFrame:
    """``rate`` and ``_ahead``, where the next step sets out from, after a step."""
    on = F.col("_new") + (F.col("_new") - F.col("rate")) * F.col("_drive")
    return moved.withColumns({"rate": F.col("_new"), "_ahead": on}).drop("_new", "_drive")


def fit_rates(
    scored: DataFrame, targets: list[float], budget: float | None = None, keep: float = 0.0
) -> tuple[DataFrame, list[Step], list[float]]:
    """``scored`` with ``rate``, the steps of the projected gradient, and the expected totals they lead to.

    ``targets`` are the domains' shares of the tokens wanted. Without a budget of
    tokens it is the largest for which no domain must be repeated as a whole. The
    distance is weighed by each domain's present total, and a document's step by its
    tokens. With ``keep`` half of it times the square of a rate's change from 1 is added per token: one set of rates is
    then the best, accelerated steps near it to ``TOLERANCE``, and it raises if ``MOST_STEPS`` don't suffice. Without
    it ``STEPS`` plain steps are made. Rates are written every ``WRITE_EVERY`` steps, so that a step costs the same early and late.
    """
    n = len(targets)
    load = F.col("tokens") * F.col("n_rows")
    sums = [F.sum(load * F.col(f"p{d}")) for d in range(n)]
    pairs = [F.sum(load * F.col(f"p{a}") * F.col(f"p{b}")) for a in range(n) for b in range(n)]
    got = [x or 0.0 for x in scored.agg(*sums, *pairs, F.sum(load)).first()]
    now, gram, tokens = got[:n], got[n:-1], got[-1]
    scale = [max(x, 1e-12) for x in now]
    if budget is None:
        budget = min((s / t for s, t in zip(now, targets) if t > 0), default=0.0)
    goal = [t * budget for t in targets]
    normal = [[gram[a * n + b] / math.sqrt(scale[a] * scale[b]) for b in range(n)] for a in range(n)]
    steep = max(_largest_eigenvalue(normal), 1e-9) + keep
    drive = (math.sqrt(steep) - math.sqrt(keep)) / (math.sqrt(steep) + math.sqrt(keep)) if keep else 0.0
    at, steps = scored.withColumns({"rate": F.lit(1.0), "_ahead": F.lit(1.0)}), []
    ahead = now  # the totals of where the next step sets out from
    for nth in range(1, (MOST_STEPS if keep else STEPS) + 1):
        off = [(s - g) / c for s, g, c in zip(ahead, goal, scale)]
        if not tokens or (not keep and max(map(abs, off)) < CLOSE):
            break
        step = Step([x / steep for x in off], keep / steep, drive)
        steps.append(step)
        # a projection per step since the last written rates, all in one pass
        moved = _moved(at, step)
        way = F.col("_new") - F.col("_ahead")
        found = moved.agg(*[F.sum(load * F.col("_new") * F.col(f"p{d}")) for d in range(n)], F.sum(load * way * way)).first()
        after = [x or 0.0 for x in found[:n]]
        at = _arrived(moved)
        if nth % WRITE_EVERY == 0:
            at = settle(at, "rates")
        if keep:
            still = math.sqrt((found[n] or 0.0) / tokens) <= TOLERANCE
        else:
            still = max(abs(a - b) / c for a, b, c in zip(after, now, scale)) < CLOSE / 10
        ahead = [a + drive * (a - b) for a, b in zip(after, now)]
        now = after
        if still:
            break
    else:
        if keep:
            raise RuntimeError(f"rates still move by more than {TOLERANCE} after {MOST_STEPS} steps")
    return at.drop("_ahead"), steps, now


def copies(rate: Column, key: Column) -> Column:
    """How often a document is taken: the whole part of its rate, and one more by a hash of its key, as likely as the rest of the rate."""
    chance = F.pmod(F.xxhash64(key, F.lit("mixing draw")), F.lit(1 << 30)) / float(1 << 30)
    near = F.abs(rate - F.round(rate)) <= NEAR_WHOLE
    return F.when(near, F.round(rate)).otherwise(F.floor(rate + chance)).cast("int")


def mix(
    docs: DataFrame,
    labels: DataFrame,
    targets: dict[str, float],
    budget: float | None = None,
    id_col: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``key, doc_id, tokens, n_rows, p_<domain>..., rate, copies``: a row per document.

    Tokens are runs of characters, marks aside, between blanks and line breaks. Rows equal in
    id and text are one document that counts ``n_rows`` times. A null or empty
    text has no tokens, moves no total, and has the rate its posterior gives. An
    empty table has no rows; other columns are left behind.
    """
    domains = sorted(targets)
    classifier = train(docs, labels, domains, id_col, text)
    scored = settle(posteriors(docs, classifier, id_col, text), "posteriors")
    rated, _, _ = fit_rates(scored, [targets[d] for d in domains], budget, KEEP)
    names = [F.col(f"p{i}").alias(f"p_{d}") for i, d in enumerate(domains)]
    return rated.select("key", "doc_id", "tokens", "n_rows", *names, "rate", copies(F.col("rate"), F.col("key")).alias("copies"))


def token_shares(found: DataFrame, targets: dict[str, float]) -> DataFrame:
    """``domain, target, present, expected, drawn`` of the result of ``mix``: shares of the tokens that are there, that
    the rates lead to and that the copies hold, all by posteriors."""
    load = F.col("tokens") * F.col("n_rows")
    takes = {"present": F.lit(1.0), "expected": F.col("rate"), "drawn": F.col("copies").cast("double")}
    domains = sorted(targets)
    sums = found.agg(*[F.sum(load * take * F.col(f"p_{d}")).alias(f"{name}{i}") for name, take in takes.items() for i, d in enumerate(domains)])

    def share(name: str, i: int) -> Column:
        total = sum((F.col(f"{name}{j}") for j in range(1, len(domains))), F.col(f"{name}0"))
        return (F.col(f"{name}{i}") / F.nullif(total, F.lit(0.0))).alias(name)

    rows = [F.struct(F.lit(d).alias("domain"), F.lit(float(targets[d])).alias("target"), *[share(name, i) for name in takes]) for i, d in enumerate(domains)]
    return sums.select(F.inline(F.array(*rows)))


def mixed(docs: DataFrame, labels: DataFrame, targets: dict[str, float], budget: float | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, each as often as its copies say."""
    chosen = mix(docs, labels, targets, budget, id_col, text).where("copies > 0").select("key", "copies")
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key(docs[id_col], docs[text]).alias("key"))
    often = rows.join(chosen, "key").select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("nth"))
    return often.select("row.*")
