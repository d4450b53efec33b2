"""Language identification, filter interactions and source divergence against brute force."""

import itertools
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import re

from pitwise.llm import divergence, interactions, langid
from pitwise.llm.common import held_out

DOCS = "doc_id long, text string, lang string, source string"


# -- languages ---------------------------------------------------------------------------------

def brute_grams(text):
    counts = Counter()
    for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
        padded = f" {word} "
        counts.update(g for k in (1, 2, 3) for i in range(len(padded) - k + 1) if (g := padded[i:i + k]) != " ")
    return counts


def brute_languages(rows, learn, top):
    profiles = {}
    for doc, text, lang in rows:
        if lang is not None and learn(doc):
            profiles.setdefault(lang, Counter()).update(brute_grams(text))
    ranked = lambda c: [g for g, _ in sorted(c.items(), key=lambda x: (-x[1], x[0]))][:top]
    ranks = {lang: {g: r for r, g in enumerate(ranked(c))} for lang, c in profiles.items() if c}
    out = []
    for doc, text, _ in rows:
        mine = ranked(brute_grams(text))
        if not mine or not ranks:
            out.append((doc, "und", 0.0))
            continue
        distance, lang = min((sum(abs(r - p[g]) if g in p else top for r, g in enumerate(mine)), lang) for lang, p in ranks.items())
        out.append((doc, lang, 1 - distance / (top * len(mine))))
    return sorted(out, key=str)


def language_rows():
    rng = random.Random(1)
    letters = {"aa": "abcdeé", "bb": "defghß", "cc": "мирно", None: "xyz", "silent": "1234"}
    rows = [(i, " ".join("".join(rng.choice(letters[lang]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 40))), lang)
            for i, lang in enumerate(rng.choice(list(letters)) for _ in range(150))]
    return rows + [(900, None, "aa"), (901, "", "bb"), (902, " 12 .,!", "cc"), (903, "Éé" * 30_000, "aa"), (904, "abc def", "aa"), (904, "abc def", "aa"), (None, "abc", "aa"), (905, "q", None)]


def test_languages_equal_brute_force(spark):
    rows = language_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as score", "2 as Lang_Pred").repartition(4)
    profiles = langid.fit_profiles(docs.where(~held_out(3, 1)))
    assert profiles.languages == ["aa", "bb", "cc"]
    got = sorted((tuple(r) for r in langid.predict_languages(docs, profiles).collect()), key=str)
    want = brute_languages(rows, lambda doc: doc is not None and zlib.crc32(str(doc).encode()) % 3 != 1, langid.TOP)
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want])
    assert langid.predict_languages(docs.limit(0), profiles).count() == 0


def test_nothing_learnt_and_ties(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "aa")], "doc_id long, text string, lang string")
    nothing = langid.fit_profiles(docs)
    assert {r.lang_pred for r in langid.predict_languages(docs, nothing).collect()} == {"und"}
    same = langid.fit_profiles(spark.createDataFrame([("abc", "zz"), ("abc", "yy")], "text string, lang string"))
    assert langid.nearest("abc", same) == ("yy", 1.0)


def test_grams_of_pieces_equal_those_of_the_whole(monkeypatch):
    text = "Ab  cé, d" * 50 + "\n1x" + "İq" * 7
    whole = langid.gram_counts(text)
    for size in (1, 2, 3, 7, 64):
        monkeypatch.setattr(langid, "_PIECE", size)
        grams, counts = langid.gram_counts(text)
        assert grams.tolist() == whole[0].tolist() and counts.tolist() == whole[1].tolist()


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    with pytest.raises(ValueError, match="at most 3"):
        langid.fit_profiles(spark.createDataFrame([("abc", f"l{i}") for i in range(4)], "text string, lang string"))


# -- filter interactions -----------------------------------------------------------------------

def test_popcounts_of_any_number_of_words():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 5, 26, 27, 1000):
        words = rng.integers(0, 2 ** 32, n, dtype=np.uint64).astype(np.uint32)
        assert interactions.positional_popcounts(words).tolist() == [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]


def brute_audit(rows, labels):
    good, toxic = ({d for d, q, t in labels if d is not None and (q, t)[k] == 1} for k in (0, 1))
    docs = []
    for doc, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 50 else set()
        fails |= {"B"} if 100 * len(set(words)) < 65 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        fails |= {"E"} if doc is not None and any(d is not None and d < doc and (t or "") == text for d, t, _ in rows) else set()
        docs.append((source or "", fails, doc in good, doc in toxic))
    out = {}
    for part in {d[0] for d in docs}:
        removed_by = Counter()
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            everything = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                removed_by[f] += len(gone)
                failing = [d for d in everything if f in d[1]]
                out[part, order, step] = [len(left), len(gone), len(failing) - len(gone), sum(d[1] == {f} for d in failing), sum(d[2] for d in gone), sum(d[3] for d in gone), f]
        for key in out:
            if key[0] == part:
                out[key][-1] = removed_by[out[key][-1]]
    return {k: tuple(v) for k, v in out.items()}


def audit_rows():
    rng = random.Random(4)
    plain = lambda n, size: " ".join(f"w{rng.randrange(size)}" for _ in range(n))
    rows = [(i, plain(rng.choice((10, 49, 50, 70)), rng.choice((20, 500))) + rng.choice(("", "", " $", " ABCDEFGHIJKLMNOP", " É")), rng.choice(("s0", "s0", "s1", None))) for i in range(80)]
    rows += [(200 + i, rows[3][1], rng.choice(("s0", "s1"))) for i in range(25)]
    return rows + [(3, rows[3][1], "s1"), (300, None, "s1"), (301, "", None), (302, "", "only"), (None, rows[5][1], "s0"), (None, "x", "s0"), (303, "Zz " * 20_000, "s0"), (303, "Zz " * 20_000, "s0")]


def test_audit_equals_all_orders_run(spark):
    rows = audit_rows()
    labels = [(i, i % 2, (i + 1) % 3) for i in range(0, 60)] + [(1, 0, 0), (1, 1, 1), (None, 1, 1), (2, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as part", "2 as Fails", "3 as good").repartition(5)
    got = interactions.audit(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert got.columns == ["part", "filter_order", "step", *interactions.COUNTS]
    assert {tuple(r[:3]): tuple(r[3:]) for r in got.collect()} == brute_audit(rows, labels)


def test_audit_of_nothing_and_without_labels(spark):
    docs = spark.createDataFrame([(1, "x", "s")], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert interactions.audit(docs.limit(0), labels).count() == 0
    got = interactions.audit(docs, labels)
    assert got.count() == 600 and got.where("good_lost > 0 or toxic_lost > 0").count() == 0


# -- source divergence -------------------------------------------------------------------------

def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def divergence_rows():
    rng = random.Random(6)
    pool = ["a", "the", "Of", "eightchr", "ninechars", "sixteen" * 2 + "xy", "seventeen" * 2, "é", "Éé", "straße", "long" * 30, "zΑ", "q" * 17, "q" * 16, "q" * 8]
    rows = []
    for i in range(150):
        lang, source = rng.choice(("en", "en", "de", None)), rng.choice(("s0", "s0", "s0", "s1", "s2", None))
        rows.append((i, rng.choice((" ", ", ", "1", "\n")).join(rng.choice(pool[:rng.randrange(3, len(pool))]) for _ in range(rng.randrange(0, 30))), lang, source))
    return rows + [(500, None, "en", "s0"), (501, "", "fr", "empty"), (502, "only here", "fr", "s1"), (503, "x" * 50_000, "en", "s9"), (504, "the a " * 9_000, "en", "s1"), (7, *rows[7][1:]), (None, "the the", "de", "s2")]


@pytest.mark.parametrize("buffer, held", [(divergence.BUFFER, divergence.HELD), (300, 40), (2_000, 200)])
def test_term_counts(spark, buffer, held):
    rows = divergence_rows()
    docs = spark.createDataFrame(rows, DOCS).fillna("", ["lang", "source"]).repartition(3)
    got = divergence.count_terms(docs, ["lang", "source"], buffer, held).groupBy("lang", "source", "term").sum("n", "documents").collect()
    n, documents = Counter(), Counter()
    for _, text, lang, source in rows:
        n.update((lang or "", source or "", t) for t in terms_of(text))
        documents.update((lang or "", source or "", t) for t in set(terms_of(text)))
    assert {tuple(r[:3]): r[3] for r in got if r.term} == n and {tuple(r[:3]): r[4] for r in got if r.term} == documents
    assert {tuple(r[:2]) for r in got if not r.term} == {(lang or "", source or "") for _, _, lang, source in rows}


def test_radix_order_is_stable():
    rng = np.random.default_rng(3)
    a, b = (rng.integers(0, size, 5000, dtype=np.uint64) << np.uint64(shift) for size, shift in ((3, 40), (1 << 20, 0)))
    order = divergence.radix_order([a, b], np.arange(5000))
    assert order.tolist() == sorted(range(5000), key=lambda i: (a[i], b[i]))


def brute_divergence(rows, least, top):
    rows = [(text or "", lang or "", source or "") for _, text, lang, source in rows]
    out = []
    f = lambda p, q: (p - q) ** 2 // (p + q)
    for lang in {r[1] for r in rows}:
        mine = [(terms_of(t), s) for t, g, s in rows if g == lang]
        have = Counter(t for w, _ in mine for t in set(w))
        kept = sorted(t for t in have if have[t] >= least)
        sources = sorted({s for _, s in mine})
        counts = {s: Counter(t for w, x in mine if x == s for t in w) for s in sources}
        counts[None] = Counter(t for w, _ in mine for t in w)
        p = {s: {t: 1 + 1_000_000_000 * (c[t] + 2) // (sum(c[x] for x in kept) + 2 * len(kept)) for t in kept} for s, c in counts.items()}
        for s in sources:
            pairs = sorted((-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in sources if o != s)
            terms = sorted((-f(p[s][t], p[None][t]), t.encode(), t) for t in kept if counts[s][t] and p[s][t] > p[None][t])[:top]
            out += [(lang, s, part, item, -v, r) for part, found in (("pair", pairs), ("term", terms)) for r, (v, _, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("least, top", [(10, 10), (1, 3), (1000, 10)])
def test_divergence_equals_brute_force(spark, least, top):
    rows = divergence_rows()
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "1 as term", "2 as n", "3 as value").repartition(4)
    got = divergence.divergence(docs, least, top)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"] and dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, least, top)
    assert divergence.divergence(docs.limit(0)).count() == 0


def test_shares_of_huge_counts_are_exact(spark):
    got = spark.sql(f"select {divergence._p('n', 'total', 'v')} as p from values (900000000000000000L, 4000000000000000000L, 3L) as t(n, total, v)").first().p
    assert got == 1 + 1_000_000_000 * (900000000000000000 + 2) // (4000000000000000000 + 6)
