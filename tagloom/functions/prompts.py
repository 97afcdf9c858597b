"""Prompts and training records as column expressions.

The example bank is passed as one value, ``array<struct<intent, examples>>`` in label order: computed by
Spark from a bank table (:func:`~tagloom.operators.bank.with_bank`) or given by the caller
(:func:`bank_literal`).  So no join touches the big side and the same expressions work on streams.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.fixed_values import (
    CHAT_ROLES,
    CHAT_TEMPLATE,
    DEFAULT_SEED,
    FEW_SHOT_EXAMPLE,
    FEW_SHOT_SEPARATOR,
    FEW_SHOT_TEMPLATE,
    LABELS_PER_PROMPT,
    SERVING_BANK_ENTRIES,
    SERVING_EXAMPLE,
    SERVING_FEW_SHOT_TEMPLATE,
    SYSTEM_PROMPT,
    USER_TURN_PREFIX,
    ZERO_SHOT_TEMPLATE,
)
from tagloom.functions.text import hash_number, seeded_hash
from tagloom.labels import LabelSpace


def label_bullets(labels: LabelSpace) -> str:
    return "\n".join(f"- {label}" for label in labels)


def fill(template: str, **holes: Column | str) -> Column:
    """Template with its holes filled; text holes are merged into the constant parts."""
    for name, value in holes.items():
        if isinstance(value, str):
            template = template.replace("{" + name + "}", value)
    parts: list[Column | str] = [template]
    for name, value in holes.items():
        if not isinstance(value, str):
            parts = [p for part in parts for p in _cut(part, "{" + name + "}", value)]
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _cut(part: Column | str, hole: str, value: Column) -> list[Column | str]:
    if not isinstance(part, str) or hole not in part:
        return [part]
    before, after = part.split(hole, 1)
    return [before, value, after]


def zero_shot_template(labels: LabelSpace) -> str:
    """Template text with the label list filled in and the message hole left open."""
    return ZERO_SHOT_TEMPLATE.replace("{labels}", label_bullets(labels))


def zero_shot_prompt(text: Column, labels: LabelSpace) -> Column:
    return fill(ZERO_SHOT_TEMPLATE, labels=label_bullets(labels), instruction=text)


def bank_literal(bank: Mapping[str, Sequence[str]]) -> Column:
    """The bank as a constant: ``array<struct<intent, examples>>`` in label order."""
    entries = [{"intent": label, "examples": list(bank[label])} for label in sorted(bank)]
    return constant(entries, "array<struct<intent: string, examples: array<string>>>")


def constant(value: object, schema: str) -> Column:
    """A nested constant; Catalyst folds the parsing away, so tasks get a plain literal."""
    return F.from_json(F.lit(json.dumps(value)), schema)


def few_shot_prompt(
    text: Column,
    row_id: Column,
    bank: Column,
    labels: LabelSpace,
    n_labels: int = LABELS_PER_PROMPT,
    seed: int = DEFAULT_SEED,
) -> Column:
    """Prompt showing one example of each of ``n_labels`` labels, drawn per row.

    The draw depends on ``seed + row_id`` and the label only.  Labels without examples
    are not drawn.
    """
    row_seed = row_id + F.lit(seed)
    stocked = F.filter(bank, lambda entry: F.size(entry["examples"]) > 0)
    drawn = F.slice(
        F.array_sort(
            F.transform(
                stocked,
                lambda entry: F.struct(
                    seeded_hash(row_seed, entry["intent"]).alias("draw"),
                    entry["intent"].alias("intent"),
                    entry["examples"].alias("examples"),
                ),
            )
        ),
        1,
        n_labels,
    )
    shown = F.transform(
        drawn,
        lambda entry: fill(
            FEW_SHOT_EXAMPLE,
            example=F.get(
                entry["examples"],
                (hash_number(entry["draw"]) % F.size(entry["examples"])).cast("int"),
            ),
            intent=entry["intent"],
        ),
    )
    return fill(
        FEW_SHOT_TEMPLATE,
        labels=label_bullets(labels),
        examples=F.array_join(shown, FEW_SHOT_SEPARATOR),
        instruction=text,
    )


def fixed_few_shot_prompt(
    text: Column,
    bank: Column | None,
    labels: LabelSpace,
    n_entries: int = SERVING_BANK_ENTRIES,
) -> Column:
    """Serving prompt: first example of the first bank entries; zero-shot without a bank.

    An entry without examples still counts as one of the first ``n_entries``.
    """
    if bank is None:
        return zero_shot_prompt(text, labels)
    shown = F.transform(
        F.filter(F.slice(bank, 1, n_entries), lambda entry: F.size(entry["examples"]) > 0),
        lambda entry: fill(
            SERVING_EXAMPLE, example=F.get(entry["examples"], F.lit(0)), intent=entry["intent"]
        ),
    )
    return fill(
        SERVING_FEW_SHOT_TEMPLATE,
        labels=label_bullets(labels),
        examples=F.array_join(shown, ""),
        instruction=text,
    )


def chat_prompt(text: Column) -> Column:
    """System and user turn with an open assistant turn."""
    return fill(CHAT_TEMPLATE, system=SYSTEM_PROMPT, instruction=text)


def chat_record(text: Column, label: Column) -> Column:
    """Training record: ``array<struct<role, content>>`` of system, user and assistant."""
    contents = (
        F.lit(SYSTEM_PROMPT),
        F.concat(F.lit(USER_TURN_PREFIX), text),
        label,
    )
    return F.array(
        *[
            F.struct(F.lit(role).alias("role"), content.alias("content"))
            for role, content in zip(CHAT_ROLES, contents, strict=True)
        ]
    )


def prompt_for(
    approach: Column,
    text: Column,
    bank: Column | None,
    labels: LabelSpace,
) -> Column:
    """Prompt format by approach; any other approach gets the chat format."""
    return (
        F.when(approach == "zero_shot", zero_shot_prompt(text, labels))
        .when(approach == "few_shot", fixed_few_shot_prompt(text, bank, labels))
        .otherwise(chat_prompt(text))
    )
