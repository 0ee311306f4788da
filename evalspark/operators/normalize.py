"""Normalisation (N1-N3, N5-N8): rename to the standard schema, prune, extract,
repair choice layouts. All are projections / filters except the transposed
choice repair, which groups options per item (bounded by the option count)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.prompts import DEFAULT_SUBJECT
from ..functions.text import py_str

# ---------------------------------------------------------------------------
# Standard fields per task type and known source field names.
STANDARD_FIELDS = {
    "summarization": {"input": "input_text", "target": "target_text"},
    "multiple_choice_qa": {"question": "question", "choices": "choices", "label": "label_index", "subject": "subject"},
    "math_reasoning_generation": {"input": "input_text", "target": "target_text"},
    "translation": {"input": "input_text", "target": "target_text"},
    "classification": {"input": "input_text", "label": "label_index"},
    "text_pair_classification": {"input1": "input_text_pair1", "input2": "input_text_pair2", "label": "label_index"},
}
SOURCE_FIELDS = {
    "summarization": {"input": "article", "target": "highlights"},
    "summarization_cnn_dailymail": {"input": "article", "target": "highlights"},
    "multiple_choice_qa": {"question": "question", "choices": "choices", "label": "answer", "subject": "subject"},
    "math_reasoning_generation_gsm8k": {"input": "question", "target": "answer"},
    "classification_sst2": {"input": "sentence", "label": "label"},
    "classification_cola": {"input": "sentence", "label": "label"},
    "text_pair_classification_mrpc": {"input1": "sentence1", "input2": "sentence2", "label": "label"},
    "text_pair_classification_qqp": {"input1": "question1", "input2": "question2", "label": "label"},
    "text_pair_classification_mnli": {"input1": "premise", "input2": "hypothesis", "label": "label"},
    "text_pair_classification_qnli": {"input1": "question", "input2": "sentence", "label": "label"},
    "text_pair_classification_rte": {"input1": "sentence1", "input2": "sentence2", "label": "label"},
    "text_pair_classification_stsb": {"input1": "sentence1", "input2": "sentence2", "label": "label"},
}
CHOICE_READ_ERROR = "CHOICE_READ_ERROR"
# ---------------------------------------------------------------------------


def source_field(task_type: str, role: str, dataset: str | None, config: str | None,
                 dataset_specific_fields: dict | None) -> str | None:
    """Explicit field map first, then ``{task}_{identifier}``, then ``{task}``;
    the identifier is the config name for glue / super_glue, else the dataset name."""
    if dataset_specific_fields and role in dataset_specific_fields:
        return dataset_specific_fields[role]
    ident = config if dataset in ("glue", "super_glue") and config else dataset
    for key in (f"{task_type}_{ident}", task_type):
        if key in SOURCE_FIELDS and role in SOURCE_FIELDS[key]:
            return SOURCE_FIELDS[key][role]
    return None


def rename_map(columns, task_type: str, dataset: str | None = None, config: str | None = None,
               dataset_specific_fields: dict | None = None) -> dict[str, str]:
    out = {}
    for role, std in STANDARD_FIELDS.get(task_type, {}).items():
        orig = source_field(task_type, role, dataset, config, dataset_specific_fields)
        if orig and orig in columns and orig != std:
            out[orig] = std
    return out


def normalize_fields(df: DataFrame, task_type: str, dataset: str | None = None, config: str | None = None,
                     dataset_specific_fields: dict | None = None, prune: bool = True) -> DataFrame:
    """N1 + N2: rename source fields to the standard schema, then keep only the
    standard fields (only when a rename happened, as in the reference). Catalyst
    prunes the dropped columns out of the scan."""
    if task_type not in STANDARD_FIELDS:
        return df
    if task_type == "translation" and dataset == "opus100":
        return normalize_translation(df, config)
    m = rename_map(df.columns, task_type, dataset, config, dataset_specific_fields)
    if not m:
        return df
    df = df.withColumnsRenamed(m)
    if prune:
        keep = [c for c in df.columns if c in set(STANDARD_FIELDS[task_type].values())]
        df = df.select(*keep)
    return df


def normalize_translation(df: DataFrame, config: str | None, col: str = "translation") -> DataFrame:
    """``translation[src]`` / ``[tgt]`` -> input / target; drop rows missing either.
    Works for a struct or a map column; a bad config leaves the data unchanged."""
    if not config or "-" not in config:
        return df
    src, tgt = config.split("-", 1)
    dt = df.schema[col].dataType
    if isinstance(dt, T.StructType):
        names = set(dt.fieldNames())
        s = F.col(col)[src] if src in names else F.lit(None).cast("string")
        t = F.col(col)[tgt] if tgt in names else F.lit(None).cast("string")
    else:
        s, t = F.element_at(F.col(col), F.lit(src)), F.element_at(F.col(col), F.lit(tgt))
    out = df.select(s.alias("input_text"), t.alias("target_text"))
    return out.where(F.col("input_text").isNotNull() & (F.col("input_text") != "")
                     & F.col("target_text").isNotNull() & (F.col("target_text") != ""))


def choices_from_wide(df: DataFrame, prefix: str = "choice_", out: str = "choices") -> DataFrame:
    """N5, item-wise layout: ``choice_0..choice_k`` columns -> one array column."""
    cols = sorted([c for c in df.columns if c.startswith(prefix) and c[len(prefix):].isdigit()],
                  key=lambda c: int(c[len(prefix):]))
    return df.withColumn(out, F.array(*[F.coalesce(F.col(c).cast("string"), F.lit(CHOICE_READ_ERROR)) for c in cols])) \
        .drop(*cols)


def choices_from_long(options: DataFrame, item: str = "item_id", idx: str = "option_idx", text: str = "text",
                      out: str = "choices", extra: dict | None = None) -> DataFrame:
    """N5, transposed layout: one row per (option, item) -> item-wise arrays in option order.
    Groups hold one item's options (a handful), so the collect is bounded. ``extra`` names
    further aggregates of an item (its subject, say) that the same pass computes."""
    extra = extra or {}
    g = options.groupBy(item).agg(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("i"), F.col(text).alias("t")))).alias("_o"),
                                  *[c.alias(n) for n, c in extra.items()])
    return g.select(item, *extra, F.transform("_o", lambda x: F.coalesce(x["t"].cast("string"), F.lit(CHOICE_READ_ERROR))).alias(out))


def drop_missing_choices(df: DataFrame, custom_template: bool = False, col: str = "choices") -> DataFrame:
    """Items without choices are skipped unless a custom template is set."""
    if custom_template:
        return df
    return df.where(F.col(col).isNotNull() & (F.size(F.col(col)) > 0))


def with_subject(df: DataFrame, default: str | None = None, col: str = "subject") -> DataFrame:
    """Item subject, else the configured default, else ``general knowledge``."""
    fb = F.lit(default if default is not None else DEFAULT_SUBJECT)
    if col in df.columns:
        return df.withColumn(col, F.coalesce(F.col(col).cast("string"), fb))
    return df.withColumn(col, fb)


def choice_fields(df: DataFrame, col: str = "choices", n: int = 26) -> DataFrame:
    """N6 fields ``choice_A``.. (first 26); absent ones are null."""
    return df.withColumns({f"choice_{chr(65 + j)}": F.get(F.col(col), j) for j in range(n)})


def label_of(df: DataFrame) -> Column:
    """Readers of labels take ``label_index``, else ``label``."""
    if "label_index" in df.columns and "label" in df.columns:
        return F.coalesce(F.col("label_index"), F.col("label"))
    if "label_index" in df.columns:
        return F.col("label_index")
    if "label" in df.columns:
        return F.col("label")
    return F.lit(None)


__all__ = ["normalize_fields", "normalize_translation", "choices_from_wide", "choices_from_long",
           "drop_missing_choices", "with_subject", "choice_fields", "rename_map", "label_of", "py_str"]
