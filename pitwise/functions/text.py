"""Text folding and entity keys as JVM expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping
from functools import lru_cache

from pyspark.sql import Column, functions as F

from pitwise.functions.scalars import col, map_values

_FOLDED_RANGES = ((0x00A0, 0xFFFF), (0x1D400, 0x1D7FF), (0x1F100, 0x1F1FF))


@lru_cache(maxsize=1)
def _folding() -> tuple[str, str, dict[str, str]]:
    """Compatibility decomposition reduced to ASCII, derived from the Unicode database:
    one-to-one pairs for ``translate``, and the few characters that unfold to several."""
    single_from, single_to, multi = [], [], {}
    for low, high in _FOLDED_RANGES:
        for code in range(low, high + 1):
            if 0xD800 <= code <= 0xDFFF:
                continue
            char = chr(code)
            plain = "".join(c for c in unicodedata.normalize("NFKD", char) if ord(c) < 128)
            if len(plain) == 1:
                single_from.append(char)
                single_to.append(plain)
            elif plain:
                multi[char] = plain
    return "".join(single_from), "".join(single_to), multi


def _ranges(chars: Iterable[str], gap: int = 32) -> str:
    """Regex class covering the characters; close neighbours share a range. It may cover a few more,
    which is harmless: the per-character branch it selects is right for every text."""
    spans: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if spans and code - spans[-1][1] <= (gap if code > 0x2024 else 1):
            spans[-1][1] = code
        else:
            spans.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in spans) + "]"


def to_ascii(c) -> Column:
    """Fold accents and compatibility forms to ASCII and drop what has none.

    Plain ASCII rows skip all work; only rows holding a character that unfolds to several letters
    (ligatures, fractions) pay for a per-character lookup. ``when`` keeps these branches lazy.
    """
    c = col(c)
    singles, plains, multi = _folding()
    unfold = F.create_map(*[F.lit(x) for pair in multi.items() for x in pair])
    unfolded = F.array_join(F.transform(F.split(c, ""), lambda ch: F.coalesce(F.try_element_at(unfold, ch), ch)), "")
    drop = r"[^\x00-\x7F]"
    # test only the non-ASCII remainder, which is short, against a few ranges
    has_multi = F.regexp_replace(c, r"[\x00-\x7F]+", "").rlike(_ranges(multi))
    return (F.when(~c.rlike(drop), c)
            .when(~has_multi, F.regexp_replace(F.translate(c, singles, plains), drop, ""))
            .otherwise(F.regexp_replace(F.translate(unfolded, singles, plains), drop, "")))


def normalize_text(c) -> Column:
    """Lower-case ASCII words separated by single spaces; missing text gives ``''``."""
    folded = F.lower(to_ascii(col(c).cast("string")))
    spaced = F.regexp_replace(F.regexp_replace(folded, r"[^a-z0-9\s]", " "), r"\s+", " ")
    return F.coalesce(F.trim(spaced), F.lit(""))


def entity_key(c, stopwords: Iterable[str], aliases: Mapping[str, str]) -> Column:
    """Normalised name without stop-words; an alias replaces the whole remaining key."""
    stop = F.array(*[F.lit(w) for w in stopwords])
    words = F.filter(F.split(normalize_text(c), " "), lambda w: ~F.array_contains(stop, w))
    key = F.array_join(words, " ")
    return map_values(key, aliases, fallback=key) if aliases else key
