"""BPE encoding and decoding by a deterministic tokenization automaton.

The automaton's arcs are labelled with tokens; it accepts, for every string, exactly the token sequence
that BPE gives.  It starts as one state with a loop per base symbol.  Each merge (u, v) -> w, in order,
adds a gadget: the state behind u is cloned without its v arc, all u arcs lead to the clone, and every
state with a u arc that could go on with v gets a w arc to where v led.  Two facts follow and keep the
construction small: the state an arc leads to depends on its label only, so a state is named by the
last token read; and an arc w is missing in a state for one of three reasons, each with the time (rank
of the merge) at which it went: the pair (state, w) was itself merged; the state was cloned from one
that lacked w; or the state lacked w's left part when w came up.  ``Automaton.gone`` is that rule.  All
49,000 x 49,000 arcs are never laid out: rows of the transition table are filled when first visited.

Encoding walks a word from left to right.  For every prefix there is one accepted token sequence, so a
table of the last token per prefix, filled by transitions, ends in the word's tokens.  Decoding emits
the arc labels.  The work on texts is per distinct white-space-free chunk; chunks and words are kept in
bounded tables per Python worker, and whole texts are processed, in small slices of an Arrow batch.

Normalisation (NFC, lower case, white space) and the cutting of words are the tokenizer file's rules.

Defined cases: null and empty texts have no tokens and decode to the empty string; the strings of
special tokens in a text are those tokens; repeated rows are encoded alike; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from logweir.llm.common import slices

NEVER = 1 << 60
KEPT_CHUNKS = 300_000
KEPT_ARCS = 1_000_000

# The tokenizer's rule for words, and its white space.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
WHITE = re.compile("[\t-\r \x85\xa0  -     　]+")
PYTHON_WHITE_ONLY = re.compile("[\x1c-\x1f]")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable, else the next free one from 256 on."""
    shown = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class Automaton:
    """Compiled merges of one vocabulary."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], end: str = "</w>"):
        self.vocab, self.end = vocab, end
        self.label = {i: s for s, i in vocab.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.made: dict[int, tuple[int, int, int]] = {}  # token -> (time, left, right)
        self._gone: dict[tuple[int, int], int] = {}
        self.rows: dict[int, dict[int, bool]] = {}
        self.filled = 0
        self.longest = max((len(s.removesuffix(end)) for s in vocab), default=0)
        self.dead: set[int] = set()
        self.parts: set[int] = set()
        for time, (left, right) in enumerate(merges):
            self.add_gadget(time, vocab[left], vocab[right], vocab[left + right])
        self._gone.clear()

    def add_gadget(self, time: int, left: int, right: int, token: int) -> None:
        if token in self.made:
            raise ValueError(f"two merges make {self.label[token]!r}")
        if token in self.parts:
            raise ValueError(f"{self.label[token]!r} is merged before it is made")
        self.parts.update((left, right))
        if self.gone(left, right) < time:  # no state can go left, right any more: the token gets no arc
            self.dead.add(token)
        self.made[token] = (time, left, right)
        self.pair[left, right] = time
        self._gone[left, right] = min(time, self._gone.get((left, right), NEVER))

    def gone(self, state: int, token: int) -> int:
        """The time at which ``state`` lost its ``token`` arc (or would have got it, but did not); NEVER if it has it."""
        known = self._gone.get((state, token))
        if known is not None:
            return known
        born, _, state_right = self.made.get(state, (-1, -1, -1))
        came, token_left, _ = self.made.get(token, (-1, -1, -1))
        time = self.pair.get((state, token), NEVER)
        if born > came:
            if self.gone(state_right, token) < born:
                time = min(time, born)
        elif came > born:
            if self.gone(state, token_left) <= came:
                time = min(time, came)
        elif born >= 0 and self.gone(state_right, token_left) < born:  # the same token twice
            time = min(time, born)
        self._gone[state, token] = time
        return time

    def has_arc(self, state: int, token: int) -> bool:
        row = self.rows.get(state)
        if row is None:
            row = self.rows[state] = {}
        found = row.get(token)
        if found is None:
            found = row[token] = self.gone(state, token) == NEVER
            self.filled += 1
            if self.filled > KEPT_ARCS:
                self.rows, self.filled = {}, 0
                self._gone.clear()
        return found

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Tokens of each word, given as byte symbols in sorted order; a word's last symbol carries the end mark.

        Tokens of a prefix do not depend on what follows, so a word starts where it parts from the one before.
        """
        vocab, dead, rows, longest, end = self.vocab, self.dead, self.rows, self.longest, self.end
        last, start = [-1], [0]  # per prefix of the word before: its last token, and where that begins
        before = ""
        for word in words:
            n = len(word)
            same, most = 0, min(len(before) - 1, n - 1)
            while same < most and before[same] == word[same]:
                same += 1
            del last[same + 1:], start[same + 1:]
            for at in range(same + 1, n + 1):
                # One candidate is accepted for each prefix, so short ones, which are likely, come first.
                for begin in range(at - 1, max(-1, at - 1 - longest), -1):
                    token = vocab.get(word[begin:at] if at < n else word[begin:] + end)
                    if token is None or token in dead:
                        continue
                    if begin:
                        state = last[begin]
                        row = rows.get(state)
                        arc = row.get(token) if row is not None else None
                        if arc is None:
                            arc = self.has_arc(state, token)
                            rows = self.rows
                        if not arc:
                            continue
                    last.append(token)
                    start.append(begin)
                    break
                else:
                    raise ValueError(f"no token for {word[:at]!r}")
            out, at = [], n
            while at:
                out.append(last[at])
                at = start[at]
            yield out[::-1]
            before = word


class Tokenizer:
    """A tokenizer file's normalisation, words and automaton, with bounded tables of what was seen."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = Automaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.label = self.automaton.label | {i: s for s, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.symbols = byte_symbols()
        self.words: dict[str, tuple[int, str, str]] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}

    def parts(self, chunk: str) -> list[str | int]:
        """The words of a chunk without white space, and the special tokens between them."""
        if chunk.isascii():
            if chunk.isalpha():
                return [chunk.lower()]
        elif chunk.isalpha() and unicodedata.is_normalized("NFC", chunk):
            lower = chunk.replace("\u03a3", "\u03c3").lower()
            if lower.isalpha():
                return [lower]
        out: list[str | int] = []
        for part in self.cut.split(chunk) if self.cut else [chunk]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                # Lower case is taken character by character, so a final sigma is a sigma like others.
                lower = unicodedata.normalize("NFC", part).replace("\u03a3", "\u03c3").lower()
                out += [word for free in WHITE.split(lower) for word in WORDS.findall(free)]
        return out

    def learn(self, chunks: list[str]) -> None:
        """Put chunks that are not there yet into the tables."""
        if len(self.chunks) > KEPT_CHUNKS:
            self.chunks.clear()
            self.words.clear()
        new = {c: self.parts(c) for c in set(chunks) if c not in self.chunks}
        unknown = {w for parts in new.values() for w in parts if type(w) is str and w not in self.words}
        symbols = self.symbols
        data = sorted((w if w.isascii() and w.isalnum() else "".join([symbols[b] for b in w.encode()]), w) for w in unknown)
        for (_, word), ids in zip(data, self.automaton.encode_sorted([d for d, _ in data])):
            self.words[word] = (len(ids), " ".join(map(str, ids)), self.decode(ids))
        for chunk, parts in new.items():
            if len(parts) == 1 and type(parts[0]) is str:
                self.chunks[chunk] = self.words[parts[0]]
            else:
                done = [self.words[p] if type(p) is str else (1, str(p), self.label[p]) for p in parts]
                self.chunks[chunk] = (sum(d[0] for d in done), " ".join([d[1] for d in done]), " ".join([d[2] for d in done]))

    def decode(self, ids: list[int]) -> str:
        return " ".join([self.label[i] for i in ids])

    def texts(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Of each text: number of tokens, ids joined by one space, and the decoded text."""
        split = [[] if not t else WHITE.split(t) if PYTHON_WHITE_ONLY.search(t) else t.split() for t in texts]
        self.learn([c for chunks in split for c in chunks])
        table = self.chunks
        for chunks in split:
            done = [d for d in map(table.__getitem__, chunks) if d[0]]
            yield sum([d[0] for d in done]), " ".join([d[1] for d in done]), " ".join([d[2] for d in done])


_loaded: dict[str, Tokenizer] = {}


def tokenizer(path: str) -> Tokenizer:
    """Compiled once per Python process."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids (joined by a space), decoded, and the named columns of ``docs``."""
    names = ["doc_id", *extra]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in rows:
            for part in slices(batch, 512):
                done = list(coder.texts(part.column("_text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array([d[0] for d in done], pa.int64()),
                     pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.string())],
                    names=[*names, "n_tokens", "ids", "decoded"])

    slim = docs.select(*names, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{n}` {slim.schema[n].dataType.simpleString()}" for n in names)
    return slim.mapInArrow(batches, f"{kinds}, n_tokens long, ids string, decoded string")


def digests(docs: DataFrame, path: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """The same with SHA-256 digests in place of ids and text."""
    names = ["doc_id", *extra]

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer(path)
        for batch in rows:
            for part in slices(batch, 512):
                counts, ids, decoded = [], [], []
                for n, joined, back in coder.texts(part.column("_text").to_pylist()):
                    counts.append(n)
                    ids.append(hashlib.sha256(joined.encode()).hexdigest())
                    decoded.append(hashlib.sha256(back.encode()).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(counts, pa.int64()), pa.array(ids), pa.array(decoded)],
                    names=[*names, "n_tokens", "ids_sha256", "decoded_sha256"])

    slim = docs.select(*names, F.col("text").alias("_text"))
    kinds = ", ".join(f"`{n}` {slim.schema[n].dataType.simpleString()}" for n in names)
    return slim.mapInArrow(batches, f"{kinds}, n_tokens long, ids_sha256 string, decoded_sha256 string")
