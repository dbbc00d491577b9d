"""Line-first quality rules.

Each line is held against rules for punctuation, navigation and boilerplate; the
lines that fail go, and a document that loses too much of its text goes too.
Four figures of the whole text make a base rule beside that.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from punchcard.llm.common import batch_of, columns, in_batches

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_SEPARATOR = re.compile(r"[|»›•·]")

# Phrases of page furniture, in lower case.
BOILERPLATE = (
    "accept cookies",
    "add to cart",
    "all rights reserved",
    "click here",
    "cookie policy",
    "enable javascript",
    "forgot your password",
    "lorem ipsum",
    "privacy policy",
    "read more",
    "share this",
    "sign in",
    "sign up",
    "skip to content",
    "subscribe to our newsletter",
    "terms of service",
    "terms of use",
    "we use cookies",
)
_BOILERPLATE = re.compile("|".join(map(re.escape, BOILERPLATE)))


@dataclass(frozen=True)
class LineRules:
    """Bounds of the rules; shares are of the words of a line or of the text."""

    min_words: int = 50
    max_repeat_percent: int = 50
    max_lost: float = 0.5  # of the characters in words
    marks_per_word: float = 0.5  # symbols and exclamation marks
    separators: int = 3
    words_per_separator: float = 4.0
    shout_words: int = 5
    shout_share: float = 0.7
    bare_words: int = 60  # a line of so many words has some punctuation
    boilerplate_words: int = 12  # longer lines are prose that has such a phrase
    same_words: int = 8
    same_share: float = 0.5


def _fails(line: str, words: list[str], rules: LineRules) -> str | None:
    """The rule that a line with words fails, or None."""
    n = len(words)
    marks = len(_SYMBOL.findall(line)) + line.count("!")
    if marks > 2 and marks > rules.marks_per_word * n:
        separators = len(_SEPARATOR.findall(line))
        return "navigation" if 2 * separators > marks else "punctuation"
    separators = len(_SEPARATOR.findall(line))
    if separators >= rules.separators and n <= rules.words_per_separator * separators:
        return "navigation"
    if n >= rules.shout_words:
        upper = sum(map(str.isupper, line))
        letters = sum(map(str.isalpha, line)) if upper > n else 0
        if letters and upper > rules.shout_share * letters:
            return "punctuation"
    if n >= rules.bare_words and not re.search(r"[^\w\s]", line):
        return "punctuation"
    if n >= rules.same_words:
        same = sum(a == b for a, b in zip(words, words[1:], strict=False))
        if same > rules.same_share * n:
            return "boilerplate"
    if n <= rules.boilerplate_words and _BOILERPLATE.search(line.lower()):
        return "boilerplate"
    return None


def repeat_words(words: list[str]) -> int:
    """Words that stand in a 3-word window which the text holds twice or more."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen: dict[tuple, int] = {}
    for window in windows:
        seen[window] = seen.get(window, 0) + 1
    covered, end = 0, 0
    for start, window in enumerate(windows):
        if seen[window] > 1:
            covered += start + 3 - max(start, end)
            end = start + 3
    return covered


def judge(text: str | None, rules: LineRules) -> tuple:
    """Figures, verdict and remaining text of one document."""
    text = text or ""
    words = WORD.findall(text)
    chars = sum(map(len, words))
    lines = text.split("\n")
    seen: set[str] = set()
    dup_lines = lost = failed = 0
    verdicts: dict[str, tuple[bool, int]] = {}
    left: list[str] = []
    for line in lines:
        if line in seen:
            dup_lines += 1
            bad, size = verdicts[line]
        else:
            own = WORD.findall(line)
            if not own:
                left.append(line)
                continue
            seen.add(line)
            bad, size = verdicts[line] = (
                _fails(line, own, rules) is not None,
                sum(map(len, own)),
            )
        if bad:
            failed += 1
            lost += size
        else:
            left.append(line)
    repeats = repeat_words(words)
    base_failed = (
        len(words) < rules.min_words or 100 * repeats > rules.max_repeat_percent * len(words)
    )
    kept = not base_failed and lost <= rules.max_lost * chars
    return (
        len(words),
        chars,
        len(_SYMBOL.findall(text)),
        dup_lines,
        repeats,
        base_failed,
        len(lines),
        failed,
        lost,
        kept,
        "\n".join(left),
    )


_FIGURES = {
    "n_words": pa.int64(),
    "word_chars": pa.int64(),
    "n_symbols": pa.int64(),
    "n_dup_lines": pa.int64(),
    "n_repeat_words": pa.int64(),
    "base_failed": pa.bool_(),
    "n_lines": pa.int64(),
    "n_failed_lines": pa.int64(),
    "lost_chars": pa.int64(),
    "kept": pa.bool_(),
    "clean_text": pa.string(),
}
_SCHEMA = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, n_lines long, n_failed_lines long, lost_chars long, kept boolean,"
    " clean_text string"
)


def quality_rules(
    docs: DataFrame,
    rules: LineRules | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep_columns: bool = False,
    with_text: bool = True,
) -> DataFrame:
    """Judge every document: ``id_col``, the figures, kept and clean_text.

    clean_text is the text without its failed lines. With ``keep_columns`` all columns
    of ``docs`` come along, in one struct named row. A null or empty text has no words and
    fails the base rule; null and repeated ids each give their row; an empty table
    gives no rows. Other columns are ignored.
    """
    used = rules or LineRules()
    figures = dict(_FIGURES)
    schema = _SCHEMA
    if not with_text:
        figures.pop("clean_text")
        schema = schema.rpartition(",")[0]
    whole = docs.schema.simpleString()
    first = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if keep_columns else F.col(id_col)
    name, kind = ("row", whole) if keep_columns else ("id", docs.schema[id_col].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            (texts,) = columns(batch.select(["text"]))
            found = list(zip(*[judge(text, used) for text in texts], strict=True))
            made = {n: (list(v), t) for (n, t), v in zip(figures.items(), found, strict=False)}
            yield batch_of(**{name: (batch.column(name), None)}, **made)

    rows = docs.select(first.alias(name), F.col(text_col).alias("text"))
    judged = in_batches(rows, run, f"{name} {kind}, {schema}")
    return judged if keep_columns else judged.withColumnRenamed("id", id_col)
