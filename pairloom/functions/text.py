"""String expressions: prompts, delimiters and clean-up."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PromptTemplate:
    """Instruction, input label, input text and response label, one per line."""

    instruction: str
    input_key: str
    response_key: str

    def prompt(self, text: Column) -> Column:
        """The filled template; null where the text is null."""
        return F.concat(
            F.lit(f"{self.instruction}\n{self.input_key}\n"),
            text,
            F.lit(f"\n{self.response_key}\n"),
        )


# The two instruction layouts.
TITLE_TEMPLATE = PromptTemplate(
    instruction="The following is the text of a blog post. "
    "Create a title for the provided blog post.",
    input_key="### Blog:",
    response_key="### Title:",
)
DOCSTRING_TEMPLATE = PromptTemplate(
    instruction="The following is a pyspark function definition. "
    "Write a numpy style docstring for the provided function definition.",
    input_key="### Function definition",
    response_key="### Numpy style docstring",
)

# Clean-up replacements, applied in this order.
CLEAN_UP = [("\\'", "'"), (" ,", ","), (" .", ".")]

DOCSTRING_QUOTES = '"""'


def add_prompt(
    df: DataFrame, template: PromptTemplate, text_col: str, out_col: str = "prompt"
) -> DataFrame:
    return df.withColumn(out_col, template.prompt(F.col(text_col)))


def before_delimiter(col: Column, delim: str = DOCSTRING_QUOTES) -> Column:
    """Text before the first delimiter; all of it where there is none."""
    return F.substring_index(col, delim, 1)


def between_delimiters(col: Column, delim: str = DOCSTRING_QUOTES) -> Column:
    """Text between the first and second delimiter; null where there is none."""
    return F.try_element_at(F.split(col, re.escape(delim)), F.lit(2))


def clean_text(col: Column) -> Column:
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), CLEAN_UP, col)
