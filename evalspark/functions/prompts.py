"""Prompt construction (P1-P10) as column expressions.

A template is parsed once on the driver with ``string.Formatter`` and
compiled into a ``concat`` of literals and columns, so prompt building is one
projection (choice lists are formatted by a higher-order function). Python ``str.format`` semantics: a
missing field (or any field form other than a plain name) makes every row
use the fallback text; a null value prints as ``None``.
"""

from __future__ import annotations

import string
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import first_regex_removed, py_str, py_strip

# ---------------------------------------------------------------------------
# Default templates and fallbacks that must equal the reference's.
MCQ_TEMPLATE = "Question: {question}\nChoices:\n{choices_formatted_str}\nAnswer: "
TRANSLATION_TEMPLATE = "Translate the following text from {src} to {tgt}: {{input_text}}"
SST2_TEMPLATE = ("Classify the sentiment of the following review as 'positive' or 'negative'. "
                 "Do not add any other text. Review: \"{input_text}\"\nSentiment:")
SST2_FALLBACK = "Error: Could not format SST-2 prompt."
MRPC_TEMPLATE = ("Are the following two sentences paraphrases? Answer ONLY with 'yes' or 'no'.\n"
                 "Sentence 1: \"{input_text_pair1}\"\nSentence 2: \"{input_text_pair2}\"\nAnswer:")
MRPC_FALLBACK = "Error: Could not format MRPC prompt."
STSB_TEMPLATE = ("Rate the similarity of the following two sentences on a scale of 0.0 to 5.0. "
                 "Provide ONLY the numerical score.\n"
                 "Sentence 1: \"{input_text_pair1}\"\nSentence 2: \"{input_text_pair2}\"\nSimilarity Score:")
STSB_FALLBACK = "Error: Could not format STS-B prompt."
SUMMARY_TEMPLATE = "Summarize the following article:\n\n{article_text}\n\nSummary:"
CREATIVE_TEMPLATE = "Write a creative piece about: {input_text}"
THEME_TEMPLATE = "Expand on this idea with a creative paragraph:\nIdea: {theme}\n\nCreative Paragraph:"
THEME_PREFIX_PATTERN = r"Sample (train|validation|test) text \d+:\s*"
LANGUAGE_NAMES = {"en": "English", "fr": "French", "es": "Spanish", "de": "German", "it": "Italian"}
DEFAULT_SUBJECT = "general knowledge"
# ---------------------------------------------------------------------------


def compile_template(template: str, columns: Iterable[str]) -> Column | None:
    """``template.format(**row)`` as one Column, or None when Python would raise
    for every row (missing field, positional field, bad syntax)."""
    cols = set(columns)
    parts: list[Column] = []
    try:
        parsed = list(string.Formatter().parse(template))
    except ValueError:
        return None
    for literal, field, spec, conv in parsed:
        if literal:
            parts.append(F.lit(literal))
        if field is None:
            continue
        if field == "" or field.isdigit() or "." in field or "[" in field or field not in cols or spec or conv:
            return None
        parts.append(py_str(F.col(field)))
    return F.concat(*parts) if parts else F.lit("")


def fill_template(df: DataFrame, template: str | None, fallback: Column | str, out: str = "prompt") -> DataFrame:
    """Fill ``template`` from the row's columns, else the fallback."""
    fb = F.lit(fallback) if isinstance(fallback, str) else fallback
    compiled = compile_template(template, df.columns) if template is not None else None
    return df.withColumn(out, compiled if compiled is not None else fb)


def primary_text(df: DataFrame) -> Column:
    """``str(item.get('input_text', item.get('question', '')))``."""
    if "input_text" in df.columns:
        return py_str(F.col("input_text"))
    if "question" in df.columns:
        return py_str(F.col("question"))
    return F.lit("")


def generic_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """No template (None or empty) -> raw primary text; else P1 with it as fallback."""
    if not template:
        return df.withColumn(out, primary_text(df))
    return fill_template(df, template, primary_text(df), out)


def format_choices(choices) -> Column:
    """``A) first\\nB) second ...``."""
    c = F.col(choices) if isinstance(choices, str) else choices
    return F.array_join(F.transform(c, lambda x, i: F.concat(F.char(F.lit(65) + i), F.lit(") "), py_str(x))), "\n")


def mcq_prompts(df: DataFrame, template: str | None = None, out: str = "prompt", n_choice_fields: int = 26) -> DataFrame:
    """P3 with N6: the default multiple-choice template; a given ``choices_formatted_str``
    wins over ``choices``; ``choice_A``... fields are added for custom templates."""
    tmpl = template or MCQ_TEMPLATE
    if "choices" in df.columns and "choices_formatted_str" not in df.columns:
        df = df.withColumn("choices_formatted_str", format_choices("choices"))
        if any(f"choice_{chr(65 + j)}" in tmpl for j in range(n_choice_fields)):
            df = df.withColumns({f"choice_{chr(65 + j)}": F.get(F.col("choices"), j) for j in range(n_choice_fields)
                                 if f"{{choice_{chr(65 + j)}}}" in tmpl})
    q = py_str(F.col("question")) if "question" in df.columns else F.lit("N/A")
    cf = py_str(F.col("choices_formatted_str")) if "choices_formatted_str" in df.columns else F.lit("Choices N/A")
    fallback = F.concat(F.lit("Question: "), q, F.lit("\nChoices:\n"), cf, F.lit("\nAnswer: "))
    compiled = compile_template(tmpl, df.columns)
    if compiled is not None:
        # a choice_X field that the item does not have is a missing key -> fallback
        missing = [F.size(F.col("choices")) <= j for j in range(26) if "choices" in df.columns
                   and f"{{choice_{chr(65 + j)}}}" in tmpl]
        for m in missing:
            compiled = F.when(m, fallback).otherwise(compiled)
    return df.withColumn(out, compiled if compiled is not None else fallback)


def language_pair(config: str | None) -> tuple[str, str, str, str]:
    """``'en-fr'`` -> (code, code, name, name); unknown codes print upper-cased."""
    if config and "-" in config:
        src, tgt = config.split("-", 1)
    else:
        src, tgt = "unknown_source", "unknown_target"
    return src, tgt, LANGUAGE_NAMES.get(src, src.upper()), LANGUAGE_NAMES.get(tgt, tgt.upper())


def language_name(code) -> Column:
    """N9 as a column (pair in the data): fixed five-entry map, else upper-cased code."""
    m = F.create_map(*[x for k, v in LANGUAGE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    c = F.col(code) if isinstance(code, str) else code
    return F.coalesce(F.element_at(m, c), F.upper(c))


def translation_prompts(df: DataFrame, pair: str, template: str | None = None, out: str = "prompt") -> DataFrame:
    """Adds the four language fields, default template names the languages."""
    src, tgt, sname, tname = language_pair(pair)
    df = df.withColumns({"source_lang_code": F.lit(src), "target_lang_code": F.lit(tgt),
                         "source_lang_name": F.lit(sname), "target_lang_name": F.lit(tname)})
    default = TRANSLATION_TEMPLATE.format(src=sname, tgt=tname)
    inp = py_str(F.col("input_text")) if "input_text" in df.columns else F.lit("")
    fallback = F.concat(F.lit(default.split("{input_text}")[0]), inp)
    return fill_template(df, template or default, fallback, out)


def _fixed(df, template, default, fallback, out):
    return fill_template(df, default if template is None else template, fallback, out)


def sentiment_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """P5: ``None`` -> default template; an empty template is kept (gives ``''``)."""
    return _fixed(df, template, SST2_TEMPLATE, SST2_FALLBACK, out)


def paraphrase_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """P6."""
    return _fixed(df, template, MRPC_TEMPLATE, MRPC_FALLBACK, out)


def similarity_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """P7."""
    return _fixed(df, template, STSB_TEMPLATE, STSB_FALLBACK, out)


def summary_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """``article_text`` is an alias of ``input_text``."""
    df = df.withColumn("article_text", F.col("input_text"))
    return fill_template(df, template or SUMMARY_TEMPLATE, py_str(F.col("input_text")), out)


def creative_prompts(df: DataFrame, template: str | None = None, out: str = "prompt") -> DataFrame:
    """Labels are ``target_text`` when present, else null."""
    if "target_text" not in df.columns:
        df = df.withColumn("target_text", F.lit(None).cast("string"))
    return fill_template(df, template or CREATIVE_TEMPLATE, py_str(F.col("input_text")), out)


def theme_prompts(df: DataFrame, text_col: str = "text_content", template: str | None = None, out: str = "prompt") -> DataFrame:
    """P10 with N11: strip the first sample prefix, then fill ``{theme}``; label = theme."""
    df = df.withColumn("theme", py_strip(first_regex_removed(F.col(text_col), THEME_PREFIX_PATTERN)))
    return fill_template(df, template or THEME_TEMPLATE, F.lit(""), out).withColumn("label", F.col("theme"))
