"""Registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from moodstream.llm import chat, fill_middle, hilbert, html_text, importance, lattice, line_dedup, nearest, packing, pieces, quality, simhash, suffix_dedup
from moodstream.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": packing.op1,
    "op2_sentencepiece": pieces.op2,
    "op3_suffix_dedup": suffix_dedup.op3,
    "op4_chat_formatting": chat.op4,
    "op5_simhash": simhash.op5,
    "op6_html_extraction": html_text.op6,
    "op7_hilbert_sharding": hilbert.op7,
    "op8_nearest": nearest.op8,
    "op9_embedding_dedup": lattice.op9,
    "op10_quality": quality.op10,
    "op11_importance": importance.op11,
    "op12_fill_in_middle": fill_middle.op12,
    "op13_line_dedup": line_dedup.op13,
}
