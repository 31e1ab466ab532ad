"""Line tokenising (PRJ-1) with the reference's split semantics.

The reference splits each line on single whitespace characters with a
tokenizer that keeps leading and inner empty tokens but drops trailing ones:
``"a  b "`` -> ``a``, ``""``, ``b``; an all-blank line gives no token and the
empty line gives one empty token.  Whitespace is the ASCII class below (no
Unicode spaces), spelled out so every regex engine agrees.
"""

from __future__ import annotations

from pyspark.sql import functions as F

# fixed value: the ASCII whitespace class of the reference's tokenizer
WS = "[ \\t\\n\\x0B\\f\\r]"


def line_tokens(line):
    """Array of tokens of one line."""
    c = F.col(line) if isinstance(line, str) else line
    return (F.when(c == "", F.array(F.lit("")))
             .when(c.rlike(f"^{WS}+\\z"), F.array().cast("array<string>"))
             .otherwise(F.split(F.regexp_replace(c, f"{WS}+\\z", ""), WS, -1)))


def text_lines(text):
    """Lines of a multi-line text; a final newline does not open a new line."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.regexp_replace(c, "\\n\\z", ""), "\\n", -1)
