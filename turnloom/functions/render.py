"""Prompt rendering (T1, T2) as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The turn markers of the instruct prompt and of the chat template.
START_OF_TURN = "<start_of_turn>"
END_OF_TURN = "<end_of_turn>"
# Chat template applied per message; the model's own template file is not
# available, so this is the documented default (prefix/suffix are parameters).
CHAT_TEMPLATE = START_OF_TURN + "{role}\n{content}" + END_OF_TURN + "\n"


def render_instruct_text(instruction: Column | str, response: Column | str) -> Column:
    """``<start_of_turn>user\\n{instruction}<end_of_turn>\\n<start_of_turn>model\\n{response}<end_of_turn>``."""
    i = F.col(instruction) if isinstance(instruction, str) else instruction
    r = F.col(response) if isinstance(response, str) else response
    return F.concat(
        F.lit(START_OF_TURN + "user\n"), i, F.lit(END_OF_TURN + "\n" + START_OF_TURN + "model\n"), r, F.lit(END_OF_TURN)
    )


def render_messages_text(messages: Column | str, prefix: str = "", suffix: str = "") -> Column:
    """Apply the chat template to every message of an ``array<struct<role,content>>`` and join."""
    m = F.col(messages) if isinstance(messages, str) else messages
    body = F.array_join(
        F.transform(
            m,
            lambda x: F.concat(F.lit(START_OF_TURN), x["role"], F.lit("\n"), x["content"], F.lit(END_OF_TURN + "\n")),
        ),
        "",
    )
    return F.concat(F.lit(prefix), body, F.lit(suffix))


def messages_md5(messages: Column | str) -> Column:
    """md5 of the rendered conversation: a scalar, engine-independent fingerprint for reports."""
    return F.md5(render_messages_text(messages))


def render_instruct(df, out: str = "text", instruction: str = "instruction", response: str = "response"):
    """T1 on a DataFrame: adds the rendered prompt as ``out``."""
    return df.withColumn(out, render_instruct_text(instruction, response))


def render_messages(df, prefix: str = "", suffix: str = "", out: str = "text", messages: str = "messages"):
    """T2 on a DataFrame: chat template over ``messages``, no generation prompt."""
    return df.withColumn(out, render_messages_text(messages, prefix, suffix))
