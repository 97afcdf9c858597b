from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tagloom.fixed_values import DEFAULT_LABELS, SYSTEM_PROMPT
from tagloom.functions import prompts
from tagloom.labels import DEFAULT_SPACE, LabelSpace
from tagloom.operators import validate

TRICKY = "costs $5 {labels} \\1 {instruction} 'quoted'"
BANK = {"a": ["a one", "a two"], "b": [], "c": ["c one"], "d": ["d one"]}
SMALL = LabelSpace(BANK)


def one(spark, column, text="Where is my order?", row_id=7):
    df = spark.createDataFrame([(row_id, text)], "row_id bigint, text string")
    return df.select(column.alias("out")).first().out


def test_zero_shot_prompt(spark):
    prompt = one(spark, prompts.zero_shot_prompt(F.col("text"), DEFAULT_SPACE))
    assert "Customer message: Where is my order?\nIntent:" in prompt
    assert all(f"- {label}\n" in prompt for label in DEFAULT_LABELS)
    template = prompts.zero_shot_template(DEFAULT_SPACE)
    assert prompt == template.replace("{instruction}", "Where is my order?")


@pytest.mark.parametrize("text", [TRICKY, "", "ünï\ncode"])
def test_text_is_inserted_literally(spark, text):
    for column in (
        prompts.zero_shot_prompt(F.col("text"), SMALL),
        prompts.chat_prompt(F.col("text")),
        prompts.fixed_few_shot_prompt(F.col("text"), prompts.bank_literal(BANK), SMALL),
    ):
        assert text in one(spark, column, text)


def test_few_shot_prompt_draws_stocked_labels(spark):
    bank = prompts.bank_literal(BANK)
    column = prompts.few_shot_prompt(F.col("text"), F.col("row_id"), bank, SMALL, n_labels=2)
    prompt = one(spark, column)
    block = prompt.split("Here are some examples:\n\n")[1].split("\n\nNow classify")[0]
    shown = [part.split("\nIntent: ") for part in block.split("\n\n")]
    assert len(shown) == 2
    for message, label in shown:
        assert message.removeprefix("Customer message: ") in BANK[label]
    assert len({label for _, label in shown}) == 2
    assert one(spark, column) == prompt
    assert len({one(spark, column, row_id=i) for i in range(12)}) > 1


def test_few_shot_prompt_with_fewer_labels_than_asked(spark):
    column = prompts.few_shot_prompt(
        F.col("text"), F.col("row_id"), prompts.bank_literal(BANK), SMALL, n_labels=9
    )
    assert one(spark, column).count("\nIntent: ") == 3


def test_fixed_prompt_counts_empty_entries(spark):
    prompt = one(spark, prompts.fixed_few_shot_prompt(F.col("text"), prompts.bank_literal(BANK), SMALL))
    assert 'Customer message: "a one"\nIntent: a\n\nCustomer message: "c one"\nIntent: c\n\n' in prompt
    assert "d one" not in prompt
    assert prompt.endswith('Customer message: "Where is my order?"\nIntent:')


def test_fixed_prompt_without_bank_is_zero_shot(spark):
    assert one(spark, prompts.fixed_few_shot_prompt(F.col("text"), None, SMALL)) == one(
        spark, prompts.zero_shot_prompt(F.col("text"), SMALL)
    )


def test_dispatch_by_approach(spark):
    bank = prompts.bank_literal(BANK)
    df = spark.createDataFrame(
        [("zero_shot", "t"), ("few_shot", "t"), ("fine_tuned", "t"), ("other", "t")],
        "approach string, text string",
    )
    text = F.col("text")
    made = df.select(
        "approach",
        prompts.prompt_for(F.col("approach"), text, bank, SMALL).alias("p"),
        prompts.zero_shot_prompt(text, SMALL).alias("z"),
        prompts.fixed_few_shot_prompt(text, bank, SMALL).alias("f"),
        prompts.chat_prompt(text).alias("c"),
    )
    expected = {"zero_shot": "z", "few_shot": "f", "fine_tuned": "c", "other": "c"}
    for row in made.collect():
        assert row.p == row[expected[row.approach]]


def test_chat_record_and_prompt(spark):
    record = one(spark, prompts.chat_record(F.col("text"), F.lit("track_order")))
    assert [tuple(m) for m in record] == [
        ("system", SYSTEM_PROMPT),
        ("user", "Customer message: Where is my order?"),
        ("assistant", "track_order"),
    ]
    assert one(spark, prompts.chat_prompt(F.col("text"))) == (
        f"<|system|>\n{SYSTEM_PROMPT}\n<|user|>\nCustomer message: Where is my order?\n<|assistant|>\n"
    )


def test_request_limits(spark):
    df = spark.createDataFrame(
        [(1, "x", None), (2, "", "zero_shot"), (3, "x" * 1000, "few_shot"), (4, "x" * 1001, None), (5, None, None)],
        "request_id bigint, text string, approach string",
    )
    checked = validate.validate_requests(df)
    good = {r.request_id: r.approach for r in validate.accepted(checked).collect()}
    assert good == {1: "fine_tuned", 3: "few_shot"}
    assert {r.request_id for r in validate.quarantined(checked).collect()} == {2, 4, 5}


def test_chat_row_validation(spark):
    schema = "row_id bigint, messages array<struct<role: string, content: string>>"
    good = [("system", "s"), ("user", "u"), ("assistant", "a")]
    df = spark.createDataFrame([(0, good), (1, good[:2]), (2, good[::-1]), (3, None), (4, None)], schema)
    found = {r.row_id: r.is_valid for r in validate.validate_chat_rows(df).collect()}
    assert found == {0: True, 1: False, 2: False, 3: False, 4: False}
    with pytest.raises(ValueError, match="Row 3 "):
        validate.require_chat_rows(df)
    assert validate.require_chat_rows(df.where("row_id < 3")).count() == 3


def test_chat_turn_validation(spark):
    turns = [(1, 0, "system"), (1, 1, "user"), (1, 2, "assistant")]
    turns += [(2, 0, "user"), (2, 1, "system"), (2, 2, "assistant")]
    turns += [(3, 0, "system"), (3, 1, "assistant"), (3, 2, "assistant"), (4, 0, "system")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string")
    found = {r.conv_id: (r.n_messages, r.is_valid) for r in validate.validate_chat_turns(df).collect()}
    assert found == {1: (3, True), 2: (3, False), 3: (3, False), 4: (1, False)}
