"""Licenses in texts by conditional compression.

A block around words that licenses use is compressed by itself and with each template as a zstandard raw
dictionary.  What a template saves, as a share of its own compressed size, ranks the templates: a
block that holds a template's wording needs next to nothing more once the template is known.  The best
ranked ones are then compared word by word with the block; the one with the fewest differences wins
if at most ``MOST_MISSING`` of its words are missing, none of them one that names the license.  A
winner's words are taken out and the rest of the block is looked at again, so one block can hold several.

Blocks are windows of words around the trigger words, joined where they overlap and cut into pieces of
``PIECE`` words that overlap by more than the longest template, so very long texts and lines are read
whole in bounded steps.

Defined cases: null and empty texts hold nothing; wording differences are over lower-case words, so
case, punctuation and line breaks do not count; repeated rows give repeated results; the same place is
reported once; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from logweir.llm.common import slices
from logweir.llm.license_templates import Template, templates

TRIGGERS = r"(?i)licen[sc]|copyright|\bspdx\b|permission|redistribut|warrant|rights reserved|\bcc[ -](?:by|0)|\bcc0\b|free software|\bgpl"
PIECE, OVERLAP = 900, 320
LEVEL = 19
RANKED = 16
LEAST_SAVING = 0.1
MOST_MISSING = 0.2
GAP = 12
NARROW = 10  # half-overlapping windows of twice as many words, where a wider block shows nothing

WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_TRIGGER = re.compile(TRIGGERS)


class Scanner:
    def __init__(self, known: list[Template] | None = None):
        self.known = known if known is not None else templates()
        self.words = [[w.lower() for w in WORD.findall(t.text)] for t in self.known]
        self.needed = [{w.lower() for w in WORD.findall(t.needed)} for t in self.known]
        # Texts are compared as lower-case words, so letter case and line breaks do not hide a template.
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False)
        self.with_template = []
        for words in self.words:
            raw = zstandard.ZstdCompressionDict(" ".join(words).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            self.with_template.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=raw, write_content_size=False, write_checksum=False))
        # Words that a template may have before its first trigger, and behind one until the next or its end.
        self.before, self.after = 6, 30
        for template in self.known:
            words = [m.start() for m in WORD.finditer(template.text)]
            triggers = [sum(w < m.start() for w in words) for m in _TRIGGER.finditer(template.text)]
            self.before = max([self.before, *triggers[:1]])
            self.after = max([self.after, *[b - a + 2 for a, b in zip(triggers, [*triggers[1:], len(words)])]])
        self.own = [max(1, len(self.plain.compress(" ".join(w).encode())) - 8) for w in self.words]

    def ranked(self, words: list[str]) -> list[tuple[float, int]]:
        """Templates by what they save on the block, as a share of their own size."""
        data = " ".join(words).encode()
        alone = len(self.plain.compress(data))
        savings = [((alone - len(c.compress(data))) / own, k) for k, (c, own) in enumerate(zip(self.with_template, self.own))]
        return sorted(((s, k) for s, k in savings if s >= LEAST_SAVING), key=lambda x: (-x[0], x[1]))

    def compared(self, k: int, words: list[str]) -> tuple[int, int, list[str], list[str]] | None:
        """Where a template lies in the block: first word, behind the last, its missing words, the words put in."""
        template = self.words[k]
        matches = [m for m in SequenceMatcher(None, template, words, autojunk=False).get_matching_blocks() if m.size]
        if not matches:
            return None
        core = max(range(len(matches)), key=lambda i: matches[i].size)
        low = high = core  # matches far from the longest one are chance
        while low and matches[low].b - (matches[low - 1].b + matches[low - 1].size) <= GAP:
            low -= 1
        while high + 1 < len(matches) and matches[high + 1].b - (matches[high].b + matches[high].size) <= GAP:
            high += 1
        used = matches[low:high + 1]
        begin, end = used[0].b, used[-1].b + used[-1].size
        there = {i for m in used for i in range(m.a, m.a + m.size)}
        taken = {i for m in used for i in range(m.b, m.b + m.size)}
        missing = [w for i, w in enumerate(template) if i not in there]
        extra = [words[i] for i in range(begin, end) if i not in taken]
        return begin, end, missing, extra

    def block(self, words: list[str]) -> Iterator[tuple[int, int, int, float, list[str], list[str]]]:
        """Confirmed templates of a block: first word, behind the last, template, saving, missing, extra words."""
        open_ = [(0, len(words))]
        while open_:
            start, stop = open_.pop()
            part = words[start:stop]
            if len(part) < 2 or not _TRIGGER.search(" ".join(part)):
                continue
            best = self.best(part)
            if best is not None:
                _, begin, end, k, saving, missing, extra = best
                yield start + begin, start + end, k, saving, missing, extra
                open_ += [(start, start + begin), (start + end, stop)]
            elif len(part) > 2 * NARROW:  # a short notice may drown in its surroundings
                step = NARROW
                open_ += [(start + i, min(stop, start + i + 2 * step)) for i in range(0, len(part) - step, step)]

    def best(self, part: list[str]) -> tuple | None:
        """The confirmed template with the fewest differences among the best ranked."""
        best = None
        for saving, k in self.ranked(part)[:RANKED]:
            found = self.compared(k, part)
            if found is None:
                continue
            begin, end, missing, extra = found
            if len(missing) > MOST_MISSING * len(self.words[k]) or self.needed[k] & set(missing) or len(extra) > len(self.words[k]):
                continue
            rank = (len(missing) + len(extra) - 0.5 * len(self.words[k]), -saving, k)
            if best is None or rank < best[0]:
                best = (rank, begin, end, k, saving, missing, extra)
        return best

    def text(self, text: str | None) -> list[dict]:
        if not text or not _TRIGGER.search(text):
            return []
        places = [(m.start(), m.end()) for m in WORD.finditer(text)]
        starts = [p[0] for p in places]
        words = [text[a:b].lower() for a, b in places]
        windows: list[list[int]] = []
        at = 0
        for trigger in _TRIGGER.finditer(text):
            while at < len(starts) and places[at][1] <= trigger.start():
                at += 1
            begin, end = max(0, at - self.before), min(len(words), at + self.after)
            if windows and begin <= windows[-1][1]:
                windows[-1][1] = max(windows[-1][1], end)
            else:
                windows.append([begin, end])
        found: dict[tuple[int, int], dict] = {}
        for begin, end in windows:
            for piece in range(begin, max(begin + 1, end - OVERLAP), PIECE - OVERLAP):
                for a, b, k, saving, missing, extra in self.block(words[piece:min(end, piece + PIECE)]):
                    a, b = a + piece, b + piece
                    row = {"license": self.known[k].license, "first_char": places[a][0], "last_char": places[b - 1][1],
                           "saving": round(saving, 4), "exact": not missing and not extra, "n_missing": len(missing), "n_extra": len(extra),
                           "missing": " ".join(missing), "extra": " ".join(extra)}
                    rest = [(p, q) for p, q in found if p < b and a < q]  # the same place seen in two pieces
                    if all(len(missing) + len(extra) < found[r]["n_missing"] + found[r]["n_extra"] for r in rest):
                        for r in rest:
                            del found[r]
                        found[a, b] = row
        return [found[k] for k in sorted(found)]


_scanner: list[Scanner] = []


def scan(docs: DataFrame) -> DataFrame:
    """One row per license found: doc_id, license, first_char and last_char (behind it), saving, exact, the differences."""

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not _scanner:
            _scanner.append(Scanner())
        for batch in rows:
            for part in slices(batch):
                found = [(d, f) for d, t in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()) for f in _scanner[0].text(t)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([d for d, _ in found], part.column("doc_id").type)]
                    + [pa.array([f[name] for _, f in found], kind) for name, kind in FIELDS.items()], names=["doc_id", *FIELDS])

    slim = docs.select("doc_id", "text").filter(F.col("text").rlike(TRIGGERS))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(batches, f"doc_id {kind}, license string, first_char long, last_char long, saving double, exact boolean, "
                                    "n_missing int, n_extra int, missing string, extra string")


FIELDS = {"license": pa.string(), "first_char": pa.int64(), "last_char": pa.int64(), "saving": pa.float64(), "exact": pa.bool_(),
          "n_missing": pa.int32(), "n_extra": pa.int32(), "missing": pa.string(), "extra": pa.string()}
