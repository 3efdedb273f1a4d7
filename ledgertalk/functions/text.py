"""Text, chat-message and token-length column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **values: Column) -> Column:
    """``"Invoice {inv}?"`` plus ``inv=col`` as one ``concat``; NULL in any value gives NULL."""
    parts = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name is not None:
            parts.append(values[name])
    return F.concat(*parts)


def count_text(name: str) -> Column:
    return F.col(name).cast("string")


def money(value: Column) -> Column:
    """Two decimals with grouped thousands."""
    return F.format_number(value, 2)


def chat(**turns: Column) -> Column:
    """``array<struct<role,content>>`` with one element per keyword, in the order given."""
    return F.array(
        *[
            F.struct(F.lit(role).alias("role"), content.alias("content"))
            for role, content in turns.items()
        ]
    )


def messages_json(messages: str = "messages") -> Column:
    return F.to_json(F.struct(F.col(messages).alias("messages")))


def header(role: Column) -> Column:
    # Chat layout markers.
    return F.concat(F.lit("<|start_header_id|>"), role, F.lit("<|end_header_id|>\n\n"))


def render_turn(role: Column, content: Column) -> Column:
    """A turn without content keeps its header, as one with empty content does."""
    return F.concat(
        header(F.coalesce(role, F.lit(""))), F.coalesce(content, F.lit("")), F.lit("<|eot_id|>")
    )


def render_chat(messages: Column) -> Column:
    """Whole conversation as model text; a JVM expression, no Python per row."""
    return F.array_join(F.transform(messages, lambda m: render_turn(m["role"], m["content"])), "")


def render_prompt(messages: Column) -> Column:
    """Turns before the reply, then an open assistant header for generation."""
    asked = F.filter(messages, lambda m: m["role"] != "assistant")
    return F.concat(render_chat(asked), header(F.lit("assistant")))


def tokens_by_chars(text: Column) -> Column:
    return F.ceil(F.length(text) / F.lit(4)).cast("int")


def tokens_by_words(text: Column) -> Column:
    return F.size(F.split(text, r"\s+"))


def approx_tokens(profile: str, text: Column) -> Column:
    return tokens_by_chars(text) if profile == "s" else tokens_by_words(text)
