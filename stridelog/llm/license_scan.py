"""Licence scan: parts of a text against licence wordings by the Dice coefficient of bigrams.

Lines, paragraphs and the whole text are looked at first. For a licence that none of them matches,
any run of words is a part too, be it some paragraphs of a document or a piece of a line. Wordings
of two or three words, which stand inside sentences by chance, count only as a part of their own.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stridelog.llm.license_templates import TEMPLATES

# What stands between words; letters outside ASCII are parts of words.
BETWEEN = r"[^a-z0-9\x80-\U0010ffff]+"
THRESHOLD = 0.8
# Bigrams that a wording has at least to be looked for inside lines.
RUN_BIGRAMS = 3

_BETWEEN = re.compile(BETWEEN)


def words_of(text: str) -> list[str]:
    """A text in lower case, without punctuation, as words."""
    return _BETWEEN.sub(" ", text.lower()).split()


class Templates:
    """Bigram sets of the wordings, found by the number of bigrams that a part has."""

    def __init__(self, templates: Sequence[tuple[str, str]], threshold: float) -> None:
        self.threshold = threshold
        self.all = [(name, set(zip(w, w[1:]))) for name, w in
                    ((name, words_of(text)) for name, text in templates) if len(w) > 1]
        # 2 |A & B| / (|A| + |B|) is at most 2 min / (|A| + |B|), which bounds the sizes.
        most = max((len(b) for _, b in self.all), default=0) * (2 - threshold) / threshold
        self.by_size = [
            [(name, b) for name, b in self.all
             if 2 * min(n, len(b)) >= threshold * (n + len(b))] for n in range(int(most) + 2)]
        # A part of so many words has at most that many bigrams, and a long one may have few.
        self.least = next((n for n, found in enumerate(self.by_size) if found), 0)
        self.wordings_of: dict[tuple[str, str], list[int]] = {}
        for i, (_, wording) in enumerate(self.all):
            for pair in wording if len(wording) >= RUN_BIGRAMS else ():
                self.wordings_of.setdefault(pair, []).append(i)

    def match(self, words: list[str]) -> list[tuple[str, float]]:
        """Wordings that a part of a text is near enough to."""
        if len(words) <= self.least or not self.all:
            return []
        bigrams = set(zip(words, words[1:]))
        size = len(bigrams)
        if size >= len(self.by_size):
            return []
        out = []
        for name, wording in self.by_size[size]:
            score = 2 * len(bigrams & wording) / (size + len(wording))
            if score >= self.threshold:
                out.append((name, score))
        return out


    def spans(self, words: list[str], found: set[str]) -> Iterator[list[str]]:
        """For each wording of a licence not in ``found`` that a run of words is near enough to,
        the first of the runs that are nearest to it."""
        pairs = list(zip(words, words[1:]))
        shared = Counter(i for pair in self.wordings_of.keys() & set(pairs)
                         for i in self.wordings_of[pair])
        places: tuple[np.ndarray, np.ndarray] | None = None
        for i in sorted(shared):
            name, wording = self.all[i]
            if name in found or not self._enough(shared[i], len(wording)):
                continue
            places = places or _places(pairs)
            hits = np.fromiter((p in wording for p in pairs), bool, len(pairs))
            span = self._nearest(*places, hits, len(wording))
            if span:
                yield words[span[0]:span[1] + 2]

    def _enough(self, shared: int, size: int) -> bool:
        """Whether a run with so many bigrams of a wording could be near enough: it has no others
        at best."""
        return 2 * shared / (shared + size) >= self.threshold

    def _nearest(self, before: np.ndarray, after: np.ndarray, hits: np.ndarray,
                 size: int) -> tuple[int, int] | None:
        """First and last bigram of the run nearest to a wording of ``size`` bigrams, if it is near
        enough. Such a run begins with a bigram of the wording. For each beginning the run goes as
        far as its size allows, and is scored at every end only if it shares enough up to there."""
        most = int(size * (2 - self.threshold) / self.threshold) + 1
        best, out = 0.0, None
        before_, after_, hits_ = before.tolist(), after.tolist(), hits.tolist()
        end, distinct, shared = 0, 0, 0
        for start in range(len(hits_)):
            while end < len(hits_):
                if before_[end] < start:
                    if distinct == most:
                        break
                    distinct += 1
                    shared += hits_[end]
                end += 1
            if hits_[start]:
                if self._enough(shared, size) and 2 * shared / (shared + size) > best:
                    new = before[start:end] < start
                    scores = 2 * np.cumsum(new & hits[start:end]) / (np.cumsum(new) + size)
                    at = int(scores.argmax())
                    if scores[at] > best and scores[at] >= self.threshold:
                        best, out = float(scores[at]), (start, start + at)
            if after_[start] >= end:
                distinct -= 1
                shared -= hits_[start]
        return out

    def read(self, text: str) -> list[tuple[list[str], list[tuple[str, float]]]]:
        """The parts of a text with the wordings that each matches."""
        out = [(part, self.match(part)) for part in _laid_out(text)]
        found = {name for _, matches in out for name, _ in matches}
        out.extend((span, self.match(span)) for span in self.spans(words_of(text), found))
        return out


def _places(pairs: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray]:
    """For each bigram the place of the same one before it (or -1) and after it (or the end)."""
    before, after = np.full(len(pairs), -1), np.full(len(pairs), len(pairs))
    last: dict[tuple[str, str], int] = {}
    for i, pair in enumerate(pairs):
        if pair in last:
            before[i], after[last[pair]] = last[pair], i
        last[pair] = i
    return before, after


def _laid_out(text: str) -> Iterator[list[str]]:
    """Words of each line, of each paragraph of several lines, and of a text of several
    paragraphs. Paragraphs stand between lines without words."""
    paragraphs: list[list[list[str]]] = [[]]
    for line in text.split("\n"):
        words = words_of(line)
        if words:
            yield words
            paragraphs[-1].append(words)
        elif paragraphs[-1]:
            paragraphs.append([])
    paragraphs = [p for p in paragraphs if p]
    for paragraph in paragraphs:
        if len(paragraph) > 1:
            yield [w for line in paragraph for w in line]
    if len(paragraphs) > 1:
        yield [w for paragraph in paragraphs for line in paragraph for w in line]


def parts_of(text: str, known: Templates | None = None) -> Iterator[list[str]]:
    """Words of all parts of a text that are compared: its lines, its paragraphs and the whole, and
    runs of words with a licence that is in none of these."""
    for part, _ in (known or Templates(TEMPLATES, THRESHOLD)).read(text):
        yield part


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: Sequence[tuple[str, str]] = TEMPLATES,
         threshold: float = THRESHOLD) -> DataFrame:
    """A row per row of ``docs`` and licence found in it: id, ``license``, best ``score``, and
    ``n_parts``, the number of lines, paragraphs or whole texts that match a wording of it. Where
    none does, a part is the run of words nearest to a wording.

    A null or empty text, or one without two words in a row, matches nothing and gives no row.
    Repeated rows give repeated results; null ids stay null. Templates are few and go along
    with the task; wordings of fewer than two words are ignored.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    wordings = list(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Templates(wordings, threshold)
        for batch in batches:
            rows, names, scores, counts = [], [], [], []
            for i, text in enumerate(batch.column(1)):
                found: dict[str, list[float]] = {}
                for _, matches in known.read(text.as_py() or ""):
                    for name, score in matches:
                        found.setdefault(name, []).append(score)
                for name, all_scores in found.items():
                    rows.append(i)
                    names.append(name)
                    scores.append(max(all_scores))
                    counts.append(len(all_scores))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(names, pa.string()),
                 pa.array(scores, pa.float64()), pa.array(counts, pa.int64())],
                [id_col, "license", "score", "n_parts"])

    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {id_type}, license STRING, score DOUBLE, n_parts LONG")
