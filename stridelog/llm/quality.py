"""Quality rules on repetition: how much of a text stands inside repeated n-grams and lines."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stridelog.llm.textbatch import NGrams, TextBatch, batches, mix

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class RepetitionRules:
    """Limits on the share of a text's word characters; a text above any of them is rejected.

    ``ngram_chars`` gives for each n-gram length the limit for characters inside n-grams
    that occurred earlier in the text; ``line_chars`` and ``lines`` limit the repeated lines.
    The limits let one repeated line pass in a text of a few lines, which is no fault in itself.
    """

    ngram_chars: dict[int, float] = field(default_factory=lambda: {
        5: 0.30, 6: 0.29, 7: 0.28, 8: 0.27, 9: 0.26, 10: 0.25})
    line_chars: float = 0.30
    lines: float = 0.40
    min_words: int = 50
    max_repeat_percent: int = 50


def _repeats(keys: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurs twice or more: all of them, and those after the first."""
    if len(keys) < 2:
        return places[:0], places[:0]
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    grouped = np.zeros(len(keys), dtype=bool)
    grouped[1:] |= same
    grouped[:-1] |= same
    members = places[order[grouped]]
    if not len(members):
        return members, members
    opens = np.ones(len(members), dtype=bool)
    opens[1:] = ranked[grouped][1:] != ranked[grouped][:-1]
    at = np.flatnonzero(opens)
    first = np.repeat(np.minimum.reduceat(members, at), np.diff(np.append(at, len(members))))
    return members, members[members != first]


def _covered(starts: np.ndarray, n: int, size: int) -> np.ndarray:
    """Which of ``size`` words lie in an n-gram that begins at one of ``starts``."""
    steps = np.zeros(size + 1, dtype=np.int32)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + n, -1)
    return np.cumsum(steps[:-1]) > 0


def measure(batch: TextBatch, lengths: list[int]) -> dict[str, np.ndarray]:
    """Counts per text of a batch; ``ngram_chars_<n>`` for every length, which must be 3 or more."""
    chars = batch.chars()
    word_chars = chars[batch.ends] - chars[batch.starts]
    size, row = len(batch.starts), batch.row_of_word()
    out = {
        "n_words": np.diff(batch.word_bounds),
        "word_chars": batch.sum_words(word_chars),
        "n_symbols": batch.count_in_rows(_SYMBOL[batch.data]),
    }

    # Lines: a text's first line begins with it, the others after a line feed.
    feeds = np.flatnonzero(batch.data == 10)
    begin = np.sort(np.concatenate([batch.bounds[:-1], feeds + 1]))
    line_row = np.searchsorted(batch.bounds[:-1], feeds, side="right") - 1
    line_row = np.sort(np.concatenate([np.arange(batch.rows), line_row]))
    end = np.empty_like(begin)
    end[:-1] = begin[1:] - 1
    if len(end):
        end[-1] = len(batch.data)
        final = np.append(line_row[1:] != line_row[:-1], True)
        end[final] = batch.bounds[1:]
    before = np.searchsorted(batch.starts, begin), np.searchsorted(batch.starts, end)
    solid = np.flatnonzero(before[1] > before[0])
    key = mix(batch.span_hash(begin[solid], end[solid])
              ^ mix(line_row[solid].astype(np.uint64)))
    _, again = _repeats(key, solid)
    word_sums = np.concatenate([[0], np.cumsum(word_chars)])
    line_words = word_sums[before[1][again]] - word_sums[before[0][again]]
    out["n_lines"] = np.bincount(line_row[solid], minlength=batch.rows)
    out["n_dup_lines"] = np.bincount(line_row[again], minlength=batch.rows)
    out["dup_line_chars"] = np.bincount(
        line_row[again], weights=line_words, minlength=batch.rows).astype(np.int64)

    # N-grams: a longer one can only repeat where the shorter one at its place does.
    grams, salt = NGrams(batch.word_hash()), mix(row.astype(np.uint64))
    last = batch.word_bounds[1:][row] if size else np.zeros(0, dtype=np.int64)
    places = np.arange(size)
    for n in sorted({3, *lengths}):
        places = places[places + n <= last[places]]
        keys = grams.between(places, places + n) ^ salt[places]
        places, again = _repeats(keys, places)
        if n == 3:
            out["n_repeat_words"] = batch.sum_words(_covered(places, 3, size))
        if n in lengths:
            out[f"ngram_chars_{n}"] = batch.sum_words(
                np.where(_covered(again, n, size), word_chars, 0))
    return out


def verdicts(found: dict[str, np.ndarray], rules: RepetitionRules) -> dict[str, np.ndarray]:
    words, chars = found["n_words"], found["word_chars"]
    failed = (words < rules.min_words) | (
        100 * found["n_repeat_words"] > rules.max_repeat_percent * words)
    kept = ~failed
    for n, most in rules.ngram_chars.items():
        kept &= found[f"ngram_chars_{n}"] <= most * chars
    kept &= found["dup_line_chars"] <= rules.line_chars * chars
    kept &= found["n_dup_lines"] <= rules.lines * found["n_lines"]
    return {"base_failed": failed, "kept": kept}


def repetition_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      rules: RepetitionRules | None = None) -> DataFrame:
    """One row per row of ``docs``: id, counts, characters in repeats, and the verdict.

    A null or empty text has no words, so it fails on the number of words. Rows are judged
    one by one: repeated rows give repeated results, null ids stay null, other columns are
    ignored. A text is held whole, with some fifty bytes of arrays per byte of text.
    """
    rules = rules or RepetitionRules()
    lengths = sorted(rules.ngram_chars)
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    flags = ["base_failed", "kept"]
    more = ["n_lines", "dup_line_chars", *(f"ngram_chars_{n}" for n in lengths)]
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = ", ".join([f"`{id_col}` {id_type}", *(f"{c} LONG" for c in counts),
                        *(f"{c} BOOLEAN" for c in flags), *(f"{c} LONG" for c in more)])

    def judge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, batch in batches(part.column(1)):
                found = measure(batch, lengths)
                found |= verdicts(found, rules)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(first, end - first)]
                    + [pa.array(found[c].astype(np.int64)) for c in counts]
                    + [pa.array(found[c]) for c in flags]
                    + [pa.array(found[c].astype(np.int64)) for c in more],
                    names=[id_col, *counts, *flags, *more])

    return docs.select(id_col, text_col).mapInArrow(judge, schema)


def drop_repetitive(docs: DataFrame, text_col: str = "text",
                    rules: RepetitionRules | None = None) -> DataFrame:
    """The rows of ``docs`` whose text passes the rules, with all their columns as they are.

    The verdict travels with its row, so no join and no key are needed; columns of ``docs``
    keep their names, whatever they are.
    """
    rules = rules or RepetitionRules()
    lengths, place = sorted(rules.ngram_chars), docs.columns.index(text_col)

    def keep(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for first, end, batch in batches(part.column(place)):
                kept = verdicts(measure(batch, lengths), rules)["kept"]
                yield part.slice(first, end - first).filter(pa.array(kept))

    return docs.mapInArrow(keep, docs.schema)
