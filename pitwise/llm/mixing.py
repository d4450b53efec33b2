"""Mixing documents to target weights of domains, with DataFrame functions only.

A classifier learnt from a table of labelled documents gives every document a posterior over domains, from its typical words and from its shape (how many
words, how long, how many different, signs and capitals), calibrated on labelled documents held out of both. Projected-gradient least squares
then fits a nonnegative rate to every document, so that the expected tokens of each domain (rate x tokens x posterior, summed over all
documents) match the targets. Each step is one aggregation to one number per domain; a document's rate is a fold over the steps so far.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwise.session import materialize

LEXICON = 2000          # typical words that the classifier knows at most
SHRINKAGE = 5.0         # documents with the word's overall share that are added to each domain
LEAST_DOCUMENTS = 4     # labelled documents that a word must occur in
DEVIATIONS = 2.7        # how far above its expected documents a word must be in a domain: a word of four documents that are all of a rare domain is
LEAST_WEIGHT = 0.7      # words that are less than about twice as frequent in one domain as in another say little, and many of them too much


def _words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[ \t-\r]+"), lambda w: w != "")


def _without_copies(labelled_texts: DataFrame) -> DataFrame:
    """Rows of (_labelled_id, domain, text) that share neither of two least hashes of three-word runs with a row of smaller id.

    A group of copies would make all its words look typical of its domain. Texts of fewer words stay.
    """
    words = labelled_texts.withColumn("_w", _words(F.col("text")))
    at = F.when(F.size("_w") >= 3, F.sequence(F.lit(0), F.size("_w") - 3)).otherwise(F.array().cast("array<int>"))
    for seed in range(2):
        hashes = F.transform(at, lambda i: F.xxhash64(F.lit(seed), F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2)))
        words = words.withColumn(f"_k{seed}", F.coalesce(F.array_min(hashes), F.xxhash64(F.lit("short"), "_labelled_id")))
    for seed in range(2):
        words = words.join(words.groupBy(f"_k{seed}").agg(F.min("_labelled_id").alias(f"_first{seed}")), f"_k{seed}")
    return words.where("_labelled_id = _first0 and _labelled_id = _first1").select("_labelled_id", "domain", "text")


def typical_words(of: DataFrame, domains: list[str]) -> tuple[list[tuple[str, list[float]]], list[float]]:
    """(word, weight for each domain against the first) of at most LEXICON words, and each domain's score without any of them, from (domain, text) rows.

    Naive Bayes over which of the words a document has: a weight is the log odds of the word in a domain less those in the first domain, the score
    without words is the log prior and what the absence of all words says. Shares of documents are shrunk towards the word's
    overall share. The words with the largest weight times documents are taken. Rows that are equal count each time, and a domain without
    documents has no words.
    """
    sizes = {r.domain: r["count"] for r in of.groupBy("domain").count().collect()}
    everything = sum(sizes.values())
    priors = [math.log((sizes.get(d, 0) + 1) / (everything + len(domains))) for d in domains]
    if not everything:
        return [], priors
    counts = of.select("domain", F.explode(F.array_distinct(_words(F.col("text")))).alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("domain") == d).alias(f"c{k}") for k, d in enumerate(domains)])
    expected = [F.col("n") * F.lit(sizes.get(d, 0) / everything) for d in domains]
    above = F.greatest(*[(F.col(f"c{k}") - e) / F.sqrt(e + 1) for k, e in enumerate(expected)], F.lit(0.0))
    share = [(F.col(f"c{k}") + SHRINKAGE * F.col("n") / everything) / F.lit(sizes.get(d, 0) + SHRINKAGE) for k, d in enumerate(domains)]
    share = [F.least(p, F.lit(0.99)) for p in share]
    weights = [F.log(p / (1 - p)) - F.log(share[0] / (1 - share[0])) for p in share]
    absent = [F.log(1 - p) - F.log(1 - share[0]) for p in share]
    weighed = counts.where((above >= DEVIATIONS) & (F.col("n") >= LEAST_DOCUMENTS)).select("word", "n", *[w.alias(f"w{k}") for k, w in enumerate(weights)], *[a.alias(f"a{k}") for k, a in enumerate(absent)])
    most = F.greatest(*[F.abs(f"w{k}") for k in range(len(domains))], F.lit(0.0))
    rows = weighed.where(most >= LEAST_WEIGHT).orderBy((most * F.col("n")).desc(), "word").limit(LEXICON).collect()
    scores = [p + sum(r[f"a{k}"] for r in rows) for k, p in enumerate(priors)]
    return [(r.word, [r[f"w{k}"] for k in range(len(domains))]) for r in rows], scores


SHAPES = 5              # features of a text's shape
BUCKETS = 16            # values of a feature
HELD_OUT = 4            # one labelled document in so many calibrates
LEAST_HELD = 40         # fewer held-out documents calibrate nothing
STEPS = 200             # of the calibration


def _shape(text: Column, words: Column, different: Column | None = None) -> Column:
    """Five numbers from 0 to 15: words, their mean length, the share of different ones, and signs and capitals among the characters."""
    text = F.coalesce(text, F.lit(""))
    n, chars = F.size(words), F.length(text)
    rate = lambda pattern: F.floor(2 * F.log2(1000 * F.regexp_count(text, F.lit(pattern)) / F.greatest(chars, F.lit(1)) + 1))
    values = [F.floor(F.log2(n + F.lit(1.0))), F.floor(chars / F.greatest(n, F.lit(1))), F.floor(10 * F.size(F.array_distinct(words) if different is None else different) / F.greatest(n, F.lit(1))),
              rate(r"[!-/:-@\[-`{-~]"), rate("[A-Z]")]
    return F.array(*[F.least(v, F.lit(BUCKETS - 1)).cast("int") for v in values])


def shape_weights(labelled_texts: DataFrame, domains: list[str]) -> list[list[list[float]]]:
    """For each feature of the shape and each of its values, the log odds of every domain against the first; shares are shrunk towards the overall one."""
    shaped = labelled_texts.select("domain", F.posexplode(_shape(F.col("text"), _words(F.col("text")))).alias("feature", "value"))
    counts = {(r.feature, r.value, r.domain): r["count"] for r in shaped.groupBy("feature", "value", "domain").count().collect()}     # features x values x domains
    sizes = [sum(n for (f, _, d), n in counts.items() if f == 0 and d == domain) for domain in domains]
    everything = sum(sizes)
    out = []
    for f in range(SHAPES):
        rows = []
        for v in range(BUCKETS):
            seen = [counts.get((f, v, d), 0) for d in domains]
            share = (sum(seen) + 1 / BUCKETS) / (everything + 1)
            logs = [math.log((c + SHRINKAGE * share) / (size + SHRINKAGE)) for c, size in zip(seen, sizes)]
            rows.append([x - logs[0] for x in logs])
        out.append(rows)
    return out


def _numbers(values: list[float]) -> Column:
    """A constant array of the plan."""
    return F.split(F.lit(",".join(f"{v:.4f}" for v in values)), ",").cast("array<double>")


SLOTS = 1024            # of the typical words, dealt by CRC-32, so that a word of a text is held against few of them


def _slot(word: str) -> int:
    return zlib.crc32(word.encode()) % SLOTS


def _places(different: Column, words: list[str]) -> Column:
    """Places in ``words``, which are in the order of their slots, of those among a text's different words, in the text's order."""
    slots: list[list[str]] = [[] for _ in range(SLOTS)]
    for w in words:
        slots[_slot(w)].append(w)
    starts = [0]
    for held in slots:
        starts.append(starts[-1] + len(held))
    table = F.array(*[F.split(F.lit(" ".join(held)), " ") for held in slots])          # constants of the plan; words hold no spaces and are not empty
    first = F.split(F.lit(" ".join(map(str, starts))), " ").cast("array<int>")

    def place(w: Column) -> Column:
        slot = F.pmod(F.crc32(w), F.lit(SLOTS)).cast("int")
        at = F.array_position(F.get(table, slot), w).cast("int")
        return F.when(at > 0, F.get(first, slot) + at - 1)
    return F.filter(F.transform(different, place), lambda p: p.isNotNull())


def _scored(docs: DataFrame, model: tuple) -> DataFrame:
    """Documents with n_tokens and _scores: one log weight for each domain."""
    words, priors, shapes = model
    words = sorted(words, key=lambda w: _slot(w[0]))
    ids = docs.withColumn("_words", _words(F.col("text"))).withColumn("_different", F.array_distinct("_words"))
    places = _places(F.col("_different"), [w for w, _ in words]) if words else F.array().cast("array<int>")
    ids = ids.withColumn("_places", places).withColumn("_shape", _shape(F.col("text"), F.col("_words"), F.col("_different")))

    def by_words(k: int) -> Column:     # weights are against the first domain
        total = F.lit(float(priors[k] - priors[0]))
        return total + F.aggregate("_places", F.lit(0.0), lambda a, i: a + F.get(_numbers([w[k] for _, w in words]), i)) if words else total

    def by_shape(k: int) -> Column:
        return sum((F.get(_numbers([row[k] for row in rows]), F.get("_shape", F.lit(f))) for f, rows in enumerate(shapes)), F.lit(0.0))
    return ids.select(*docs.columns, F.size("_words").cast("long").alias("n_tokens"),
                      F.array(*[F.array(by_words(k), by_shape(k)) for k in range(1, len(priors))]).cast("array<array<double>>").alias("_scores"))


#: How a domain's log odds against the first follow from those by words and by shape: a constant and two factors.
Scale = tuple[float, float, float]
PLAIN: Scale = (0.0, 1.0, 1.0)


def _odds(scores: list[list[float]], scales: list[Scale]) -> list[float]:
    """Probabilities of all domains."""
    logits = [0.0] + [c + a * w + b * v for (w, v), (c, a, b) in zip(scores, scales)]
    top = max(logits)
    powers = [math.exp(x - top) for x in logits]
    total = sum(powers)
    return [p / total for p in powers]


def calibrate(rows: list[tuple[int, list[list[float]]]], width: int) -> list[Scale]:
    """Scales of the domains but the first that fit (domain, scores) rows best: logistic regression drawn towards PLAIN, by gradient steps with momentum."""
    scales = ahead = [PLAIN] * (width - 1)
    if not rows:
        return scales
    norm = [[1.5 * sum(x * x for x in column) + 1 for column in zip(*[(1.0, *s[k]) for _, s in rows])] for k in range(width - 1)]
    for step in range(STEPS):
        slope = [[x - y for x, y in zip(scale, PLAIN)] for scale in ahead]
        for domain, s in rows:
            for k, p in enumerate(_odds(s, ahead)[1:]):
                e = p - (domain == k + 1)
                for i, x in enumerate((1.0, *s[k])):
                    slope[k][i] += e * x
        moved = [tuple(x - g / n for x, g, n in zip(*three)) for three in zip(ahead, slope, norm)]
        ahead = [tuple(m + step / (step + 3) * (m - x) for m, x in zip(new, old)) for new, old in zip(moved, scales)]
        scales = moved
    return scales


def fit_domains(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> tuple[tuple, list[Scale], dict[str, float]]:
    """(words, scores without words, shape weights), scales of the domains but the first, and held-out figures: rows, accuracy, log loss.

    ``labelled`` is (doc_id, domain) of a bounded sample, which is broadcast; other domains are left out and copies count once. One document in HELD_OUT
    is kept out of the weights and finds the scales; with fewer than LEAST_HELD of those all documents learn, and the scales are plain. Half of the held-out
    documents are scored by scales fitted to the other half for the figures.
    """
    known = labelled.where(F.col("domain").isin(*domains))
    of = docs.join(F.broadcast(known.select(F.col("doc_id").alias("_labelled_id"), "domain")), F.col("doc_id") == F.col("_labelled_id"))
    of = materialize(_without_copies(materialize(of.select("_labelled_id", "domain", "text"))))
    held = F.pmod(F.xxhash64(F.lit("held"), "_labelled_id"), F.lit(HELD_OUT)) == 0
    learn, width = of.where(~held), len(domains)
    if of.where(held).count() < LEAST_HELD:
        learn, held = of, F.lit(False)
    model = (*typical_words(learn, domains), shape_weights(learn, domains))
    tests = [(domains.index(r.domain), r["_scores"]) for r in _scored(of.where(held), model).orderBy("_labelled_id").select("domain", "_scores").collect()]      # of the bounded sample
    if not tests or width < 2:
        return model, [PLAIN] * (width - 1), {"rows": 0}
    judged = []
    for part in (0, 1):
        scales = calibrate(tests[1 - part::2], width)
        judged += [(k, _odds(s, scales)) for k, s in tests[part::2]]
    return model, calibrate(tests, width), {"rows": len(tests), "accuracy": sum(p[k] == max(p) for k, p in judged) / len(judged),
                                            "log_loss": -sum(math.log(max(p[k], 1e-12)) for k, p in judged) / len(judged)}


def domain_posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """Documents with n_tokens and posterior (one probability per domain, in order).

    A naive Bayes sum over the typical words that a document has and lacks and over its shape. Null and empty texts are texts without words; equal texts,
    and so repeated rows, get equal posteriors.
    """
    model, scales, _ = fit_domains(docs, labelled, domains)
    logit = lambda k: F.lit(scales[k][0]) + sum(F.lit(scales[k][i + 1]) * F.get(F.get("_scores", F.lit(k)), F.lit(i)) for i in range(2))
    scored = _scored(docs, model)
    logits = scored.withColumn("_scores", F.array(F.lit(0.0), *[logit(k) for k in range(len(scales))]))
    powers = logits.withColumn("_scores", F.transform("_scores", lambda s: F.exp(s - F.array_max("_scores"))))
    total = F.aggregate("_scores", F.lit(0.0), lambda a, s: a + s)
    return powers.select(*docs.columns, "n_tokens", F.transform("_scores", lambda s: s / total).alias("posterior"))


def least_rate(posterior: Column, whole: int | None) -> Column:
    """The rate that a document has at least: one where ``whole`` is its most probable domain, else zero."""
    return F.lit(0.0) if whole is None else F.when(posterior[whole] == F.array_max(posterior), 1.0).otherwise(0.0)


def _rate(history: list[tuple[list[float], float]], start: float, posterior: Column, whole: int | None = None) -> tuple[Column, Column]:
    """The rate after the steps so far, and the point ahead of it from which the next step sets out.

    A step takes off what its vector says for the posterior and stops at the least rate; the point ahead goes on in the same direction by the step's momentum.
    """
    first = F.greatest(F.lit(float(start)), least_rate(posterior, whole))
    if not history:
        return first, first
    width = len(history[0][0])
    # one constant, which the optimizer folds, instead of a tree of numbers that each step would build anew
    steps = F.transform(F.split(F.lit(";".join(",".join(map(repr, (*map(float, vector), float(momentum)))) for vector, momentum in history)), ";"),
                        lambda x: F.split(x, ",").cast("array<double>"))

    def step(state: Column, e: Column) -> Column:
        moved = F.greatest(least_rate(posterior, whole), state["ahead"] - sum((posterior[k] * e[k] for k in range(1, width)), posterior[0] * e[0]))
        return F.struct(moved.alias("rate"), (moved + e[width] * (moved - state["rate"])).alias("ahead"))
    begin = F.struct(first.alias("rate"), first.alias("ahead"))
    return F.aggregate(steps, begin, step, lambda x: x["rate"]), F.aggregate(steps, begin, step, lambda x: x["ahead"])


def fit_rates(table: DataFrame, weights: list[float], budget: float | None = None, tolerance: float = 1e-5, max_steps: int = 30, whole: int | None = None) -> tuple[list[tuple[list[float], float]], float]:
    """Steps and start of the rates that match ``weights`` x ``budget`` tokens (default: all tokens there are) for (n_tokens, posterior).

    Accelerated projected gradient: the squared misses of the domains are weighted by the inverse of the diagonal of the Gram matrix of
    token-weighted posteriors, a step is one over a bound of its largest eigenvalue, and momentum starts anew when the loss has grown. The fit
    ends when all misses are below ``tolerance`` of the budget, when four steps have left the loss as it was, or after ``max_steps``. Targets that no such rates reach get the
    least-squares answer. Each step is one aggregation to two numbers per domain.

    With the number of a domain as ``whole`` no document that it is most probable for has a rate below one. The default budget is then what those documents alone give
    the domain, over its weight, if that is more than all tokens: at most all tokens over its weight, whatever a single document says.
    """
    width = len(weights)
    p = [F.col("posterior")[k] for k in range(width)]
    n = F.col("n_tokens").cast("double")
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    mine = F.lit(0.0) if whole is None else F.when(least_rate(F.col("posterior"), whole) > 0, n * p[whole]).otherwise(0.0)
    first = table.agg(F.sum(n).alias("n"), F.sum(mine).alias("mine"), *[F.sum(n * p[i] * p[j]).alias(f"g{i}_{j}") for i, j in pairs]).first()
    tokens = first["n"] or 0.0
    if not tokens:
        return [], 0.0
    gram = {(i, j): first[f"g{min(i, j)}_{max(i, j)}"] for i in range(width) for j in range(width)}
    if budget is None:
        budget = max(tokens, first["mine"] * sum(weights) / weights[whole] if whole is not None and weights[whole] else 0.0)
    budget = float(budget)
    targets = [w / sum(weights) * budget for w in weights]
    inverse = [1 / gram[k, k] if gram[k, k] > 0 else 0.0 for k in range(width)]
    bound = max(sum(gram[i, j] * math.sqrt(inverse[i] * inverse[j]) for j in range(width)) for i in range(width))
    history, start, pace, last, still = [], budget / tokens, 1.0, math.inf, 0
    for _ in range(max_steps):
        rate, ahead = _rate(history, start, F.col("posterior"), whole)
        sums = [F.sum(n * F.col(c) * p[k]).alias(f"{c}{k}") for c in ("_r", "_a") for k in range(width)]
        now = table.withColumns({"_r": rate, "_a": ahead}).agg(*sums).first()
        miss = [now[f"_r{k}"] - targets[k] for k in range(width)]
        if max(map(abs, miss)) <= tolerance * budget:
            break
        loss = sum(w * m * m for w, m in zip(inverse, miss))
        still = still + 1 if abs(last - loss) <= 1e-4 * loss else 0
        if still == 4:
            break
        if loss > last and history:         # the step that comes sets out from the rate itself, without momentum
            history[-1], pace = (history[-1][0], 0.0), 1.0
            origin = miss
        else:
            origin = [now[f"_a{k}"] - targets[k] for k in range(width)]
        last = loss
        after = (1 + math.sqrt(1 + 4 * pace * pace)) / 2
        history.append(([inverse[k] * origin[k] / bound for k in range(width)], (pace - 1) / after))
        pace = after
    return history, start


def score_documents(docs: DataFrame, labelled: DataFrame, domains: list[str], seed: int = 0) -> DataFrame:
    """Documents with n_tokens, posterior and draw, a number from 0 to 1 by a hash of seed, id and text (must be free names)."""
    _check_free(docs, "n_tokens", "posterior", "draw")
    draw = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    return domain_posteriors(docs.withColumn("draw", draw), labelled, domains)


def _check_free(docs: DataFrame, *names: str) -> None:
    clash = set(names) & {c.lower() for c in docs.columns}
    if clash:
        raise ValueError(f"documents already have {sorted(clash)}")


def with_rates(scored: DataFrame, history: list[tuple[list[float], float]], start: float, whole: int | None = None) -> DataFrame:
    """Scored documents with rate and copies instead of the draw. ``copies`` is the rate rounded up or down by the draw, so its mean is the rate."""
    draw = F.col("draw")
    copies = lambda r: (F.floor(r) + (draw < r - F.floor(r)).cast("long")).cast("long")
    # one nested expression, in which each part is bound once: as separate columns they would be computed anew wherever they are used
    counted = lambda p: F.transform(F.array(_rate(history, start, p, whole)[0]), lambda r: F.struct(p.alias("posterior"), r.alias("rate"), copies(r).alias("copies")))
    mixed = F.get(F.flatten(F.transform(F.array(F.col("posterior")), counted)), F.lit(0))
    columns = [c for c in scored.columns if c not in ("posterior", "draw")]
    return scored.withColumn("_mixed", mixed).select(*columns, "_mixed.posterior", "_mixed.rate", "_mixed.copies")


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None, seed: int = 0, whole: str | None = None) -> DataFrame:
    """Documents with n_tokens, posterior, rate and copies (must be free names).

    With ``whole`` every document whose most probable domain it is has a rate, and so a copy, of one at least; see ``fit_rates`` for the budget. How far the
    targets are met says ``domain_totals``. Rows that are equal get equal values. Documents without tokens move nothing. An empty table stays empty.
    """
    _check_free(docs, "rate", "copies")
    domains = list(weights)
    scored = materialize(score_documents(docs, labelled, domains, seed))      # kept: a filter on rates would score a document anew at each step of the fold
    own = None if whole is None else domains.index(whole)
    return with_rates(scored, *fit_rates(scored.select("n_tokens", "posterior"), [weights[d] for d in domains], budget, whole=own), own)


def mix_ids(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], budget: float | None = None, seed: int = 0) -> DataFrame:
    """``mix`` without the texts: documents are read and scored once, and what the rates need is kept."""
    domains = list(weights)
    scored = materialize(score_documents(docs.select("doc_id", "text"), labelled, domains, seed).drop("text"))
    return with_rates(scored, *fit_rates(scored.select("n_tokens", "posterior"), [weights[d] for d in domains], budget))


def domain_totals(mixed: DataFrame, weights: dict[str, float]) -> DataFrame:
    """(domain, tokens, share, target, miss): expected tokens of each domain at the fitted rates, its share of them, the wanted share, and the difference."""
    sums = mixed.agg(F.array(*[F.sum(F.col("n_tokens") * F.col("rate") * F.col("posterior")[k]) for k in range(len(weights))]).alias("t"))
    total = F.aggregate("t", F.lit(0.0), lambda a, x: a + x)
    rows = sums.select(F.explode(F.arrays_zip(F.array(*[F.lit(d) for d in weights]).alias("domain"), F.col("t").alias("tokens"),
                                              F.array(*[F.lit(w / sum(weights.values())) for w in weights.values()]).alias("target"))).alias("r"), total.alias("all"))
    share = F.col("r.tokens") / F.col("all")
    return rows.select("r.domain", "r.tokens", share.alias("share"), "r.target", (share - F.col("r.target")).alias("miss"))
