"""Prompt and request building.

A template such as ``"Known: {rule_categories}. Classify: {text}"`` is
split once on the driver (``string.Formatter``) into literal and field
parts, then assembled per row with ``concat``. Values are never
re-expanded, so a text holding ``{rule_categories}`` comes out unchanged
(a chained ``replace`` would get that wrong).
"""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

from recsort.constants import (
    DEFAULT_MODEL_NAME,
    DEFAULT_SYSTEM_PROMPT,
    REQUEST_MAX_TOKENS,
    REQUEST_TEMPERATURE,
)

# Our own fixture templates (callers pass their own).
PLAIN_TEMPLATE = "Classify: {text}"
HINT_TEMPLATE = "Known: {rule_categories}. Classify: {text}. Recheck: {rule_categories}"


def template_expr(template: str, fields: dict[str, Column]) -> Column:
    parts: list[Column] = []
    for literal, field, spec, conv in string.Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if field is not None:
            if field not in fields:
                raise KeyError(f"template field {field!r} has no column; known: {sorted(fields)}")
            if spec or conv:
                raise ValueError("format specs and conversions are not supported in templates")
            parts.append(fields[field])
    if not parts:
        return F.lit("")
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def build_prompt(text: Column, rule_categories: Column,
                 plain_template: str = PLAIN_TEMPLATE, hint_template: str = HINT_TEMPLATE) -> Column:
    """Hint template when the cleaned rule categories are non-empty, else the plain one.

    ``text`` is used as given (null -> ''), ``rule_categories`` must be the
    cleaned '||' string.
    """
    t = F.coalesce(text.cast("string"), F.lit(""))
    fields = {"text": t, "rule_categories": rule_categories}
    return F.when(rule_categories != "", template_expr(hint_template, fields)) \
        .otherwise(template_expr(plain_template, fields))


def build_request(prompt: Column, model: str = DEFAULT_MODEL_NAME,
                  system_prompt: str = DEFAULT_SYSTEM_PROMPT,
                  temperature: float = REQUEST_TEMPERATURE,
                  max_tokens: int = REQUEST_MAX_TOKENS) -> Column:
    """Chat-completion request body as JSON text."""
    messages = F.array(
        F.struct(F.lit("system").alias("role"), F.lit(system_prompt).alias("content")),
        F.struct(F.lit("user").alias("role"), prompt.alias("content")),
    )
    return F.to_json(F.struct(
        F.lit(model).alias("model"),
        messages.alias("messages"),
        F.lit(temperature).cast("double").alias("temperature"),
        F.lit(max_tokens).cast("int").alias("max_tokens"),
        F.lit(False).alias("stream"),
    ))
