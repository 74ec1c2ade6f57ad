"""Text expressions: description cleaning, report lines and description prompts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Java's Unicode white space plus the four separators that Python also counts as blank.
_BLANK = r"[\s\x1c-\x1f]"

# Headings, bold labels and the word that a description must lose.
# d: only \n ends a line; m: ^ matches at each line; U: Unicode white space.
_HEADING = rf"(?dmU)^{_BLANK}*#+ .*"
_BOLD_LABEL = r"(?dmU)\*\*.*?\*\*[:\s\x1c-\x1f]*"
_DESCRIPTION_LABEL = rf"(?dmU)^Description:{_BLANK}*"
_BLANK_RUN = rf"(?U){_BLANK}+"


def clean_description(text: Column) -> Column:
    """Drop headings, bold labels and ``Description:`` prefixes; collapse white space."""
    for pattern in (_HEADING, _BOLD_LABEL, _DESCRIPTION_LABEL):
        text = F.regexp_replace(text, pattern, "")
    return F.coalesce(F.trim(F.regexp_replace(text, _BLANK_RUN, " ")), F.lit(""))


def strip_backticks(text: Column) -> Column:
    return F.translate(text, "`", "")


# The report line and the prompt have a set wording.
_REPORT_LINE = "• *%s*\n   ↳ %s on `%s`: *%s*"
_PROMPT = (
    "Write a single, concise 1-sentence business description for the %s '%s'. "
    "Context: %s. "
    "Rules: Return ONLY the description text. Do NOT use Markdown, headers, or labels like 'Description:'."
)


def report_line(table: Column, column: Column, check_type: Column, value: Column) -> Column:
    return F.format_string(_REPORT_LINE, F.substring_index(table, ".", -1), check_type, column, value)


def description_prompt(item_type: Column, item_name: Column, context: Column) -> Column:
    return F.format_string(_PROMPT, item_type, item_name, context)
