"""Chat-template rendering as array higher-order functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

MESSAGE = "struct<role:string,content:string>"
MESSAGES = f"array<{MESSAGE}>"


# Fixed values (ChatML): "<|im_start|>" + role + "\n" + content + "<|im_end|>\n";
# generation header "<|im_start|>assistant\n".
@dataclass(frozen=True)
class ChatTemplate:
    """A template that renders each message as
    ``prefix + role + role_sep + content + suffix`` and appends
    ``generation_header`` for a generation prompt. The default is ChatML,
    the format of the default base model family; callers pass the strings
    of another model's template."""

    prefix: str = "<|im_start|>"
    role_sep: str = "\n"
    suffix: str = "<|im_end|>\n"
    assistant_role: str = "assistant"

    @property
    def generation_header(self) -> str:
        return f"{self.prefix}{self.assistant_role}{self.role_sep}"


CHATML = ChatTemplate()


def render(messages: Column, template: ChatTemplate = CHATML, add_generation_prompt: bool = False) -> Column:
    body = F.array_join(
        F.transform(messages, lambda m: F.concat(
            F.lit(template.prefix), m["role"], F.lit(template.role_sep), m["content"], F.lit(template.suffix))),
        "",
    )
    if add_generation_prompt:
        return F.concat(body, F.lit(template.generation_header))
    return body


def all_but_last(messages: Column) -> Column:
    """Every message except the last one, whatever its role."""
    return F.slice(messages, 1, F.greatest(F.size(messages) - 1, F.lit(0)))


def has_system(messages: Column) -> Column:
    return F.exists(messages, lambda m: m["role"] == "system")


def with_default_system(messages: Column, default_prompt: str) -> Column:
    """Prepend a system message iff no message (at any position) has role system."""
    default = F.array(F.struct(F.lit("system").alias("role"), F.lit(default_prompt).alias("content")))
    return F.when(has_system(messages), messages).otherwise(F.concat(default, messages))
