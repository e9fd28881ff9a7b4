"""Quality rules, line first (operator 4).

Every line of a document is judged on its own by three families of rules
(punctuation, navigation, boilerplate). Lines that fail are removed; a document
that loses too much of its text that way is rejected. The document-level base
counts (word characters, symbols, repeated lines, repeated 5-word windows) are
computed over the whole original text in the same pass.

The work is row-local: one ``mapInArrow`` over the scan, no shuffle, bounded by
one Arrow batch.

Defined results: null text counts as empty (no words, so it fails the base rule
and is not kept); repeated rows are judged each on their own; a null doc_id is
passed through; extra columns are ignored by :func:`judge_documents` and kept by
:func:`filter_documents`; an empty table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

WHITE_BYTES = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
SEPARATORS = frozenset(["|", ">", "<", "»", "«", "·", "•", "/", "::", "→"])
_SYMBOL = re.compile(r"[#*$%&|<>]")
_SHOUT = re.compile(r"[!?]{2,}")
_PUNCT = re.compile(r"[.,;:!?…。，、！？؟।]")
_WORD = re.compile(r"[^ \t-\r]+")

# Phrases of page furniture; a short line that is little else is boilerplate.
BOILERPLATE = (
    "accept cookies", "all rights reserved", "click here", "cookie policy", "enable javascript",
    "follow us on", "log in to", "privacy policy", "read more", "share this", "sign up for",
    "skip to content", "subscribe to our", "terms of service", "terms of use", "we use cookies",
)
# Those that also stand inside ordinary sentences.
_RUNNING = frozenset(["log in to", "read more", "share this", "sign up for"])
_BOILERPLATE = re.compile(r"(?<!\w)(?:" + "|".join(BOILERPLATE) + r")(?!\w)")


@dataclass(frozen=True)
class Rules:
    """Thresholds. Shares are of the words of a line, or of a document's words."""

    symbol_words: float = 0.3  # words holding a symbol
    shout_words: float = 0.3  # words holding "!!" or "??" runs
    separator_words: float = 0.2  # words that are only a separator
    min_separators: int = 2
    unpunctuated_words: int = 30  # a line this long without any punctuation is no prose
    boilerplate_words: int = 25  # boilerplate phrases count in lines up to this long
    boilerplate_share: float = 0.5  # of a line's words; its phrases alone make it boilerplate
    own_words: int = 5  # so many words besides the phrases count as a sentence of the line's own
    max_lost: float = 0.5  # reject a document that loses a larger share of its words
    window: int = 5
    min_words: int = 10
    max_repeat_pct: int = 20


DEFAULT_RULES = Rules()

VERDICT_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, n_lines long, n_lines_removed long, lost_words long, text_kept string"
)


def line_failure(line: str, rules: Rules = DEFAULT_RULES) -> str | None:
    """Name of the first rule family that ``line`` fails, else None. Blank lines pass."""
    words = _WORD.findall(line)
    n = len(words)
    if not n:
        return None
    if _SYMBOL.search(line):
        separators = sum(w in SEPARATORS for w in words)
        if separators >= rules.min_separators and separators >= rules.separator_words * n:
            return "navigation"
        if sum(1 for w in words if _SYMBOL.search(w)) > rules.symbol_words * n:
            return "punctuation"
    elif any(s in line for s in "»«·•→/:"):
        separators = sum(w in SEPARATORS for w in words)
        if separators >= rules.min_separators and separators >= rules.separator_words * n:
            return "navigation"
    if _SHOUT.search(line) and sum(1 for w in words if _SHOUT.search(w)) > rules.shout_words * n:
        return "punctuation"
    if n >= rules.unpunctuated_words and not _PUNCT.search(line):
        return "punctuation"
    if n <= rules.boilerplate_words:
        low = line.lower()
        if any(p in low for p in BOILERPLATE) and _is_boilerplate(low, n, rules):
            return "boilerplate"
    return None


def _is_boilerplate(low: str, n: int, rules: Rules) -> bool:
    """Whether a lower-case line of ``n`` words is little but boilerplate phrases:
    they are most of its words, or leave no sentence of its own. A phrase that also
    stands in ordinary sentences counts for the latter only where it begins the line."""
    found = list(_BOILERPLATE.finditer(low))
    phrase = sum(len(m.group().split()) for m in found)
    if not found or phrase >= rules.boilerplate_share * n:
        return bool(found)
    if n - phrase >= rules.own_words:
        return False
    return any(m.group() not in _RUNNING or not low[:m.start()].strip() for m in found)


def repeated_window_words(words: list, size: int) -> int:
    """Words covered by a window of ``size`` consecutive words that occurs twice
    or more in ``words`` (all occurrences count, the first included)."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    grams = list(zip(*(words[i:] for i in range(size))))
    counts = Counter(grams)
    if len(counts) == n:
        return 0
    covered, upto = 0, 0
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered += i + size - max(i, upto)
            upto = i + size
    return covered


def judge_text(text: str | None, rules: Rules = DEFAULT_RULES) -> tuple:
    """The verdict columns after doc_id for one whole text."""
    text = text or ""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes: ASCII white space only
    n_words = len(words)
    white = sum(data.count(bytes([b])) for b in WHITE_BYTES)
    word_chars = len(text) - white
    n_symbols = sum(data.count(bytes([b])) for b in SYMBOLS)
    lines = text.split("\n")
    seen: set[str] = set()
    n_dup = 0
    verdicts: dict[str, tuple[bool, int]] = {}
    kept_lines, removed, lost = [], 0, 0
    for line in lines:
        known = verdicts.get(line)
        if known is None:
            known = verdicts[line] = (line_failure(line, rules) is not None, len(_WORD.findall(line)))
        failed, n = known
        if n:
            if line in seen:
                n_dup += 1
            else:
                seen.add(line)
        if failed:
            removed += 1
            lost += n
        else:
            kept_lines.append(line)
    repeat = repeated_window_words(words, rules.window)
    base_failed = n_words < rules.min_words or 100 * repeat > rules.max_repeat_pct * n_words
    kept = not base_failed and lost <= rules.max_lost * n_words
    return (n_words, word_chars, n_symbols, n_dup, repeat, base_failed, kept, len(lines), removed, lost,
            "\n".join(kept_lines) if removed else text)


SLICE = 500  # texts turned into Python objects at a time
_NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
          "n_lines", "n_lines_removed", "lost_words", "text_kept")
_TYPES = (pa.int64(),) * 5 + (pa.bool_(),) * 2 + (pa.int64(),) * 3 + (pa.string(),)


def judge_documents(docs: DataFrame, rules: Rules = DEFAULT_RULES) -> DataFrame:
    """One verdict row per row of ``docs`` (doc_id, text), see VERDICT_SCHEMA."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            rows = [judge_text(t, rules) for t in batch.column(1).to_pylist()]
            cols = list(zip(*rows)) if rows else [()] * len(_NAMES)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(cols, _TYPES))], names=["doc_id", *_NAMES])

    return docs.selectExpr("cast(doc_id as long) doc_id", "text").mapInArrow(run, VERDICT_SCHEMA)


def filter_documents(docs: DataFrame, rules: Rules = DEFAULT_RULES, text_col: str = "text",
                     n_chars_col: str | None = "n_chars") -> DataFrame:
    """Kept rows of ``docs`` with all their columns; failed lines are gone from
    ``text`` and the character count column, where there is one, follows."""
    names = docs.columns
    at = names.index(text_col)
    chars_at = names.index(n_chars_col) if n_chars_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(a, SLICE) for b in batches for a in range(0, b.num_rows, SLICE)):
            verdicts = [judge_text(t, rules) for t in batch.column(at).to_pylist()]
            batch = batch.filter(pa.array([v[6] for v in verdicts], pa.bool_()))
            texts = [v[10] for v in verdicts if v[6]]
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if chars_at is not None:
                counts = [len(v[10]) if v[8] else c for v, c in zip((v for v in verdicts if v[6]), cols[chars_at].to_pylist())]
                cols[chars_at] = pa.array(counts, batch.schema.field(chars_at).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
