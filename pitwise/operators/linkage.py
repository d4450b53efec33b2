"""Record linkage: fuzzy duplicates inside blocks, entity mapping, key-based matching of two sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from pitwise.functions.similarity import edit_similarity, letter_counts, letters_allow, possible_at, sequence_ratio, without_letters
from pitwise.functions.text import entity_key, normalize_text
from pitwise.operators.cleaning import fitted_modes
from pitwise.operators.joins import block_pairs, large_blocks, outer_with_side
from pitwise.session import materialize


def fuzzy_duplicates(df: DataFrame, *, block: str, key: str, name: str, threshold: float = 0.88, large: int = 20) -> tuple[DataFrame, DataFrame]:
    """Different normalised names inside a block whose ratio reaches the threshold, and a report of blocks above ``large`` members.

    All pairs of a block count, also those of one key with two names. Pairs that cannot reach the threshold by their lengths or by the letters they
    share are dropped inside the join, in the JVM; neither bound loses a pair. The Python ratio runs on what is left. Since the ratio
    depends on the order of its sides, the earlier member by (key, name) is its reference.
    """
    named = df.select(block, F.col(key).alias("key"), F.col(name).alias("name")).dropna().withColumn("norm", normalize_text("name"))
    named = named.withColumn("letters", letter_counts("norm"))

    def possible(x, y):
        return (x("norm") != y("norm")) & possible_at(x("norm"), y("norm"), threshold) & letters_allow(x("letters"), y("letters"), threshold)
    pairs = block_pairs(named, block=block, order_by="key", columns=["key", "name", "norm", "letters"], where=possible)
    scored = pairs.withColumn("ratio", sequence_ratio("left_norm", "right_norm")).where(F.col("ratio") >= threshold)
    found = scored.select(block, "left_key", "left_name", "right_key", "right_name", F.round("ratio", 4).alias("similarity"))
    return found, large_blocks(named, block=block, columns=["key", "name"], above=large)


#: Texts of a block that are compared each with each; of larger blocks, those that agree when up to ``MAX_EDITS`` letters are left out.
COMPARED_TEXTS = 400
MAX_EDITS = 2


def edit_pairs(df: DataFrame, *, block: str, key: str, text: str, threshold: float = 0.88, compared: int = COMPARED_TEXTS) -> DataFrame:
    """``(block, left_key, right_key, similarity)``: all pairs of members of a block whose edit similarity reaches the threshold, the earlier by (key, text) first.

    Equal texts of a block are compared once. In blocks of up to ``compared`` texts each one meets each other. In larger ones two texts of at most d edits
    meet in a text that is left of both without d letters at most, so that the work follows the texts and not their pairs. Texts
    that may differ in more than ``MAX_EDITS`` letters, which are long ones, have too many of those: they still meet each other. No pair is lost.
    """
    members = df.select(F.col(block).alias("block"), F.col(key).alias("key"), F.col(text).alias("text")).where("block is not null and text is not null").distinct()
    members = materialize(members)
    texts = members.select("block", "text").distinct()
    edits = lambda length: F.floor((1 - threshold + 1e-9) * length)
    sizes = texts.groupBy("block").agg(F.count(F.lit(1)).alias("n")).select(F.col("block").alias("b"), (F.col("n") > compared).alias("large"))
    texts = materialize(texts.join(sizes, F.col("block") == F.col("b")).drop("b").withColumn("length", F.length("text")))
    longest = max(n for n in range(1000) if int((1 - threshold + 1e-9) * n) <= MAX_EDITS)        # of a pair that may differ in MAX_EDITS letters

    def alike(x, y):
        return edit_similarity(x, y) >= threshold

    def met(rows: DataFrame, least: int) -> DataFrame:
        """Every pair of texts whose longer one has more than ``least`` letters."""
        def near(x, y):
            long = F.greatest(F.length(x("text")), F.length(y("text")))
            return (long > least) & (F.abs(F.length(x("text")) - F.length(y("text"))) <= edits(long)) & alike(x("text"), y("text"))
        return block_pairs(rows, block="block", order_by="text", columns=["text"], where=near).select("block", F.col("left_text").alias("a"), F.col("right_text").alias("b"))

    short = texts.where(F.col("large") & (F.col("length") <= longest))
    left = F.least(edits(F.col("length") + MAX_EDITS), F.lit(MAX_EDITS)).cast("int")
    cut = short.select("block", "text", F.explode(without_letters("text", left, MAX_EDITS)).alias("cut")).select("block", "text", F.xxhash64("block", "cut").alias("h"))
    one, two = (cut.select(F.col("h").alias(f"h{i}"), F.col("block").alias(f"block{i}"), F.col("text").alias(c)) for i, c in ((1, "a"), (2, "b")))
    same_cut = one.join(two.hint("merge"), (F.col("h1") == F.col("h2")) & (F.col("block1") == F.col("block2")) & (F.col("a") < F.col("b"))).where(alike(F.col("a"), F.col("b")))
    found = met(texts.where(~F.col("large")), -1).unionByName(same_cut.select(F.col("block1").alias("block"), "a", "b").distinct()).unionByName(
        met(texts.where(F.col("large") & (F.col("length") >= longest - MAX_EDITS)), longest))

    sides = [members.select(F.col("block").alias(f"block{i}"), F.col("text").alias(f"text{i}"), F.struct("key", "text").alias(f"m{i}")).hint("merge") for i in (1, 2)]
    both = found.join(sides[0], (F.col("block") == F.col("block1")) & (F.col("a") == F.col("text1"))).join(sides[1], (F.col("block") == F.col("block2")) & (F.col("b") == F.col("text2")))
    different = both.select("block", F.least("m1", "m2").getField("key").alias("left_key"), F.greatest("m1", "m2").getField("key").alias("right_key"), edit_similarity("a", "b").alias("similarity"))
    copies = block_pairs(members.select(F.struct("block", "text").alias("copies"), "key"), block="copies", order_by="key", columns=["key"])
    equal = copies.select(F.col("copies.block").alias("block"), "left_key", "right_key", F.lit(1.0).alias("similarity"))
    return different.unionByName(equal).withColumnRenamed("block", block)


def map_entity(df: DataFrame, candidates: DataFrame, *, name: str, country: str, candidate_id: str, candidate_names: Sequence[str],
               candidate_country: str, threshold: float = 0.55) -> DataFrame:
    """The one candidate for the most frequent name and country of ``df``.

    Candidates of the same country with an equal name or code win, else the most similar one (ties by id).
    """
    found = fitted_modes(df, [name, country])
    if not found:
        raise ValueError("no names to map")
    spark = df.sparkSession
    asked = spark.range(1).select(normalize_text(F.lit(found.get(name, ""))).alias("n"), normalize_text(F.lit(found.get(country, ""))).alias("c")).first()
    pool = candidates.withColumns({f"__n{i}": normalize_text(c) for i, c in enumerate(candidate_names)})
    if asked["c"]:
        pool = pool.where(normalize_text(candidate_country) == asked["c"])
    names = [F.col(f"__n{i}") for i in range(len(candidate_names))]
    exact = F.greatest(*[(n == asked["n"]).cast("int") for n in names]) if len(names) > 1 else (names[0] == asked["n"]).cast("int")
    hidden = [f"__n{i}" for i in range(len(names))]
    equal = pool.withColumn("exact_match", exact).where("exact_match = 1").withColumn("similarity", F.lit(1.0))
    chosen = equal.drop(*hidden).orderBy(candidate_id).limit(1)
    row = chosen.first()
    if row is None:                      # only then are candidates compared letter by letter
        ratios = [sequence_ratio(F.lit(asked["n"]), n) for n in names]
        best = F.greatest(*ratios) if len(ratios) > 1 else ratios[0]
        ranked = pool.withColumns({"exact_match": F.lit(0), "similarity": best}).drop(*hidden)
        chosen = ranked.orderBy(F.col("similarity").desc(), candidate_id).limit(1)
        row = chosen.first()
    if row is None or (row["exact_match"] == 0 and row["similarity"] < threshold):
        raise ValueError(f"no candidate for '{found.get(name, '')}' ({found.get(country, '')})")
    return chosen


def with_entity_keys(df: DataFrame, names: Mapping[str, str], stopwords: Sequence[str], aliases: Mapping[str, str]) -> DataFrame:
    """Add one entity key column per name column."""
    return df.withColumns({key: entity_key(c, stopwords, aliases) for key, c in names.items()})


def match_sources(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> dict[str, DataFrame]:
    """Rows matched on all keys, the leftovers of both sides, and the match rates."""
    outer = outer_with_side(left, right, keys)
    sides = {s: outer.where(F.col("side") == s).drop("side") for s in ("both", "left_only", "right_only")}
    counts = outer.agg(*[F.count_if(F.col("side") == s).alias(s) for s in sides])
    left_rows = F.lit(left.agg(F.count(F.lit(1))).scalar())
    right_rows = F.lit(right.agg(F.count(F.lit(1))).scalar())
    summary = counts.select(
        left_rows.alias("left_rows"), right_rows.alias("right_rows"), F.col("both").alias("matched_rows"),
        F.col("left_only").alias("left_unmatched_rows"), F.col("right_only").alias("right_unmatched_rows"),
        F.round(F.col("both") / F.greatest(left_rows, F.lit(1)) * 100, 4).alias("left_match_rate_pct"),
        F.round(F.col("both") / F.greatest(right_rows, F.lit(1)) * 100, 4).alias("right_match_rate_pct"))
    return {"matched": sides["both"], "unmatched_left": sides["left_only"], "unmatched_right": sides["right_only"], "summary": summary}
