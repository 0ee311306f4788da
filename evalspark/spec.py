"""Task and metric specs (plain dataclasses; the YAML / factory layer of the
reference becomes these objects and the registries they name)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class TaskSpec:
    """One evaluation task.

    ``handler`` picks the recipe (U6): classification, summarization, translation,
    multiple_choice_qa, math_reasoning_generation, text_pair_classification,
    glue_classification_prompting, glue_text_pair_prompting,
    creative_text_generation or custom_script.
    """

    name: str
    handler: str
    items: Callable[..., DataFrame] | None = None   # (spark) -> items in the standard schema
    prompt_template: str | None = None
    prompt_builder: str | None = None
    postprocessor: str | None = None
    post_options: dict = field(default_factory=dict)
    metrics: list = field(default_factory=list)
    options: dict = field(default_factory=dict)      # handler options (language pair, default subject...)
    custom: Callable[[DataFrame], DataFrame] | None = None   # U2: items -> (item_id, prompt, label)
    max_samples: int | None = None
    order_key: tuple = ("item_id",)
