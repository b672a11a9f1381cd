"""Language of a cleaned text, from function words."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, functions as F

from textpulse.functions.text import count_in


def detect_language(clean_text: Column, tokens: Column,
                    language_words: Mapping[str, tuple[str, ...]]) -> Column:
    """Language with the most function-word hits; ``unknown`` without hits or under 3 chars.

    Ties go to the language listed first. Comparing (hits, rank, name) structs keeps each
    count evaluated once.
    """
    candidates = [F.struct(F.lit(0).alias("hits"), F.lit(1).alias("rank"),
                           F.lit("unknown").alias("name"))]
    for position, (name, vocabulary) in enumerate(language_words.items()):
        candidates.append(F.struct(count_in(tokens, vocabulary).alias("hits"),
                                   F.lit(-position).alias("rank"), F.lit(name).alias("name")))
    best = F.greatest(*candidates) if len(candidates) > 1 else candidates[0]
    return F.when(F.length(clean_text) >= 3, best.getField("name")).otherwise(F.lit("unknown"))
