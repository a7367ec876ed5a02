"""Prompts from a framework, in this engine's own words. What an answer must look like is the contract that operators/responses.py reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotarium.operators.framework import categories, prompt_blocks

HEAD = """You code documents for a systematic review.

# What to do
Read the attached document and quote every passage to which one of the labels below applies.

# Labels
"""
_SHAPE = """

# Answer
Answer with one JSON object and nothing else, neither a fence nor a comment:
{"findings": [{"label_code": "<code>", "snippet": "<quote>", "reasoning": "<why it applies>"%s}]}

# Rules
1. A snippet is a word-for-word quote of the document, never a paraphrase.
2. Use the codes listed above and no others.
3. Leave a label out if nothing in the document fits it; make nothing up.
4. Quote as much as is needed, one to five sentences.
5. If a passage fits several labels, repeat it as one finding for each.
6. A passage must meet what a label includes and must not meet what it excludes."""
_SURE = """
7. confidence is high if the passage fits beyond doubt, medium if it leaves some, low if it only touches the label."""


def tail(include_confidence: bool) -> str:
    """What follows the labels."""
    return _SHAPE % (', "confidence": "<high, medium or low>"' if include_confidence else "") + (_SURE if include_confidence else "") + "\n"


def analysis_prompts(framework: DataFrame, include_confidence: bool = True) -> DataFrame:
    """category, cat_ord, prompt: one prompt for each category, with the labels of that category alone."""
    return prompt_blocks(framework).select("category", "cat_ord", F.concat(F.lit(HEAD), F.col("blocks"), F.lit(tail(include_confidence))).alias("prompt"))


def summary_prompts(framework: DataFrame) -> DataFrame:
    """category, cat_ord, prompt of an optional second pass that sums up what was found under each code."""
    ask = "You sum up coded findings of a systematic review.\nYou get a JSON object with findings (label_code, snippet, reasoning) from several documents. For each of the codes "
    shape = ' write three to five sentences on the themes of its snippets. Answer with JSON only:\n{"syntheses": [{"label_code": "<code>", "summary": "<text>"}]}\n'
    return categories(framework).select("category", "cat_ord", F.concat(F.lit(ask), F.array_join("codes", ", "), F.lit(shape)).alias("prompt"))
