"""Secrets in texts: fixed patterns, and strings that pass a battery of randomness tests.

Base spans come from three patterns (``assign``, ``access``, ``hex``).  The battery adds ``random`` spans:
runs of 16 and more characters of base64 and its kin that are not inside a base span.  A run's encoding is
the smallest alphabet that holds its characters; over that alphabet three statistics are taken and turned
into probabilities that uniform random symbols look at least as uneven: chi-squared of the symbol counts,
runs of symbol classes (vowels, consonants, capitals, digits, signs), and serial correlation of neighbours.
Fisher's rule joins the three to one.

Short strings of ordinary language look random now and then, so how random is enough depends on the length.
The corpus itself says how its language behaves: from every text, neighbouring short words are joined to
decoys of the lengths asked for and go through the same battery.  A run's p-value is the share of decoys of
its length band (and encoding, where there are enough of them) that look as random; the runs reported are
those that Benjamini and Hochberg's rule accepts over the whole corpus.  The counts behind it are a table
of (band, encoding, score) of fixed size.

Defined cases: null and empty texts have no spans; rows that share a doc_id, or repeat, are scanned on
their own; decimal numbers are never ``random``; a corpus too small to give decoys adds no ``random`` span;
very long texts are scanned whole; spans that start together are ordered by kind; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from logweir.llm.common import slices, stored

RATE = 0.01  # share of false discoveries
ENOUGH = 2_000  # decoys of one encoding and band to judge by them alone
SHORTEST = 16
KINDS = ("assign", "access", "hex", "random")
BANDS = np.array([16, 18, 20, 24, 28, 32, 40, 48, 64, 96])  # least length of each band
DECOY_LENGTHS = np.array([16, 17, 18, 19, 21, 23, 25, 27, 29, 31, 35, 39, 43, 47, 55, 63, 79, 95, 127])
BINS = 256
STEPS = 8  # score bins per halving of the probability

# The patterns of base spans.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile("AKIA[A-Z0-9]+")
HEX = re.compile("[0-9a-f]{32,}")  # maximal runs, so the same as the runs of any length that reach 32
RUN = re.compile("[A-Za-z0-9+/_-]{16,}={0,2}")

# Alphabets, smallest first; the digits alone come first so that numbers are told apart.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "hex_upper": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "lower_digits": "abcdefghijklmnopqrstuvwxyz0123456789",
    "upper_digits": "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "letters": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "alphanumeric": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789",
    "base64": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/",
    "base64url": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789-_",
    "any": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/-_",
}
DECIMAL = 0
CLASSES = ("aeiou", "bcdfghjklmnpqrstvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "+/-_")


class Battery:
    """Tables of the alphabets, and the tests on many strings at once."""

    def __init__(self) -> None:
        sets = list(ALPHABETS.values())
        self.size = np.array([len(s) for s in sets])
        width = 1 + int(self.size.max())
        self.value = np.full((len(sets), 256), width - 1)
        self.width = width
        self.kind = np.zeros(256, np.int64)
        self.allowed = np.zeros(256, np.int64)  # the alphabets that hold a character, as bits
        for k, members in enumerate(CLASSES):
            self.kind[list(members.encode())] = k
        change, spread = [], []
        for e, members in enumerate(sets):
            # Neighbours in the order of classes, so that the change of vowels and consonants is a correlation.
            ordered = sorted(members, key=lambda c: (self.kind[ord(c)], c))
            self.value[e, [ord(c) for c in ordered]] = range(len(ordered))
            self.allowed[list(members.encode())] |= 1 << e
            p = np.bincount([self.kind[ord(c)] for c in members], minlength=len(CLASSES)) / len(members)
            change.append(1 - (p**2).sum())
            spread.append((p * (1 - p) ** 2).sum())  # chance that two neighbouring steps both change class
        self.change, self.twice = np.array(change), np.array(spread)

    def encodings(self, chars: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The first alphabet that holds all characters of each string."""
        common = np.bitwise_and.reduceat(self.allowed[chars], starts)
        return np.log2(common & -common).astype(np.int64)

    def scores(self, chars: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Encoding and probability, under uniform random symbols, of looking as uneven as each string.

        ``chars`` are the strings one after the other, each of two characters or more.
        """
        if not lengths.size:
            return np.zeros(0, np.int64), np.zeros(0)
        starts = np.cumsum(lengths) - lengths
        of = np.repeat(np.arange(lengths.size), lengths)
        encoding = self.encodings(chars, starts)
        n, k = lengths.astype(float), self.size[encoding].astype(float)
        value = self.value[encoding[of], chars]

        counts = np.bincount(of * self.width + value, minlength=lengths.size * self.width).reshape(lengths.size, self.width)
        chi = (counts.astype(float) ** 2).sum(axis=1) * k / n - n
        free = k - 1
        uneven = ((chi / free) ** (1 / 3) - (1 - 2 / (9 * free))) / np.sqrt(2 / (9 * free))

        inside = np.ones(chars.size, bool)
        inside[starts] = False
        changes = np.add.reduceat(inside & (self.kind[chars] != np.roll(self.kind[chars], 1)), starts, dtype=np.int64)
        p, both, steps = self.change[encoding], self.twice[encoding], n - 1
        spread = steps * p * (1 - p) + 2 * (steps - 1) * (both - p * p)
        runs = (changes - steps * p) / np.sqrt(np.maximum(spread, 1e-9))

        away = value - (np.add.reduceat(value, starts) / n)[of]
        before = np.roll(away, 1)
        energy = np.add.reduceat(away * away, starts)
        serial = np.add.reduceat(np.where(inside, away * before, 0), starts) / np.maximum(energy, 1e-9)
        correlation = np.where(energy > 0, (serial + 1 / n) * np.sqrt(n), np.sqrt(n))

        single = p == 0  # one class only: no runs to test
        tails = [upper_tail(uneven), np.where(single, 1.0, 2 * upper_tail(np.abs(runs))), 2 * upper_tail(np.abs(correlation))]
        half = -sum(np.log(np.clip(t, 1e-300, 1.0)) for t in tails)
        return encoding, np.exp(-half) * (1 + half + half * half / 2)


def upper_tail(z: np.ndarray) -> np.ndarray:
    """Probability above z of the normal distribution, by a rational approximation."""
    x = np.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    tail = np.exp(-x * x / 2) / np.sqrt(2 * np.pi) * t * (
        0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return np.where(z >= 0, tail, 1 - tail)


def _stratum(encoding: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return (np.searchsorted(BANDS, lengths, "right") - 1) * len(ALPHABETS) + encoding


def _bin(probability: np.ndarray) -> np.ndarray:
    """0 for what looks most random."""
    return np.minimum(-np.log2(np.clip(probability, 1e-300, 1.0)) * STEPS, BINS - 1).astype(np.int64)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Kind, start and end of every base span, by start and kind."""
    found = [(0, *m.span()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    found += [(1, *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(2, *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], s[0]))


def open_runs(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Runs of encoded-looking characters that no base span holds whole."""
    runs = [m.span() for m in RUN.finditer(text)]
    return [(s, e) for s, e in runs if not any(bs <= s and e <= be for _, bs, be in base)] if runs else []


def plain_letters(text: str) -> np.ndarray:
    """The characters of all words of a text that are neither long runs nor inside base spans, joined."""
    for pattern in (ASSIGN, ACCESS, RUN):
        text = pattern.sub(" ", text)
    chars = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    return chars[((chars | 32) - 97 < 26) | (chars - 48 < 10)]


def decoys(letters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Characters and lengths of the decoys of some texts: each text is cut into the decoy lengths in turn.

    Where a text starts in the row of lengths depends on its own size only, so the decoys of a corpus do not
    depend on how it is partitioned.
    """
    cycle, ends = int(DECOY_LENGTHS.sum()), np.cumsum(DECOY_LENGTHS)
    sizes = np.array([x.size for x in letters], np.int64)
    first = np.cumsum(sizes) - sizes
    text = np.repeat(np.arange(sizes.size), sizes)
    place = np.arange(text.size) - first[text] + (sizes * 7919 % cycle)[text]
    rounds, rest = np.divmod(place, cycle)
    number = rounds * ends.size + np.searchsorted(ends, rest, "right")
    opens = np.flatnonzero(np.r_[True, (number[1:] != number[:-1]) | (text[1:] != text[:-1])][:text.size])
    lengths = np.diff(np.r_[opens, text.size])
    whole = lengths == DECOY_LENGTHS[number[opens] % ends.size] if opens.size else np.zeros(0, bool)
    keep = np.repeat(whole, lengths)
    chars = np.concatenate(letters) if letters else np.zeros(0, np.uint8)
    return chars[keep], lengths[whole]


_HITS = "array<struct<start: int, end: int, stratum: int, bin: int>>"
_SCHEMA = f"base array<struct<kind: int, start: int, end: int>>, runs {_HITS}, decoys array<struct<stratum: int, bin: int, n: bigint>>"


def tested(docs: DataFrame) -> DataFrame:
    """doc_id, base spans, tested runs and (on one row per slice) the decoys' scores; written to the shared folder."""
    slim = docs.select("doc_id", F.col("text").alias("_text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
    hit = pa.list_(pa.struct([(c, pa.int32()) for c in ("start", "end", "stratum", "bin")]))
    tally = pa.list_(pa.struct([("stratum", pa.int32()), ("bin", pa.int32()), ("n", pa.int64())]))

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        battery = Battery()
        for batch in rows:
            for part in slices(batch, 2_048, 1 << 20):
                texts = [t or "" for t in part.column("_text").to_pylist()]
                base = [base_spans(t) for t in texts]
                runs = [open_runs(t, b) for t, b in zip(texts, base)]
                bodies = [t[s:e].rstrip("=").encode() for t, found in zip(texts, runs) for s, e in found]
                lengths = np.array([len(b) for b in bodies], np.int64)
                encoding, chance = battery.scores(np.frombuffer(b"".join(bodies), np.uint8), lengths)
                scored = zip(_stratum(encoding, lengths).tolist(), _bin(chance).tolist())
                hits = [[(s, e, *next(scored)) for s, e in found] for found in runs]

                chars, lengths = decoys([plain_letters(t) for t in texts])
                encoding, chance = battery.scores(chars, lengths)
                cells, n = np.unique(_stratum(encoding, lengths) * BINS + _bin(chance), return_counts=True)
                counts = [(*divmod(c, BINS), k) for c, k in zip(cells.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(base, span), pa.array(hits, hit), pa.array([counts] + [None] * (len(texts) - 1), tally)],
                    names=["doc_id", "base", "runs", "decoys"])

    return stored(slim.mapInArrow(batches, f"doc_id {kind}, {_SCHEMA}"), "secret_runs")


def limits(runs: np.ndarray, decoy: np.ndarray, rate: float = RATE) -> np.ndarray:
    """For each stratum the last score bin that is reported (-1: none).

    ``runs`` and ``decoy`` count strings per stratum and bin.
    """
    shape = (BANDS.size, len(ALPHABETS), BINS)
    runs = runs.reshape(shape).copy()
    runs[:, DECIMAL] = 0
    own = decoy.reshape(shape)
    pooled = np.broadcast_to(own.sum(axis=1, keepdims=True), shape)
    null = np.where(own.sum(axis=2, keepdims=True) >= ENOUGH, own, pooled)
    chance = (1 + null.cumsum(axis=2)) / (1 + null.sum(axis=2, keepdims=True))
    last = np.full(shape[:2], -1)
    for band in range(BANDS.size):  # each length band on its own: long runs do not pay for the many short ones
        p, n = chance[band].ravel(), runs[band].ravel()
        order = np.argsort(p, kind="stable")
        found = np.cumsum(n[order])
        # Equal p-values stand or fall together: the count up to the last of them is what counts.
        found = found[np.searchsorted(p[order], p[order], "right") - 1]
        passes = (p[order] * found[-1] <= rate * found) & (found > 0)
        highest = p[order][passes].max(initial=-1.0)
        last[band] = (chance[band] <= highest).sum(axis=1) - 1
    last[:, DECIMAL] = -1
    return last.ravel()


def _table(counted: DataFrame) -> np.ndarray:
    """Counts per stratum and bin; at most as many rows as there are cells."""
    out = np.zeros(BANDS.size * len(ALPHABETS) * BINS, np.int64)
    rows = counted.groupBy("stratum", "bin").agg(F.sum("n").alias("n")).toArrow()
    if rows.num_rows:
        out[rows.column("stratum").to_numpy() * BINS + rows.column("bin").to_numpy()] = rows.column("n").to_numpy()
    return out


def find(docs: DataFrame, rate: float = RATE) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (kind number, start, end) in code points, end exclusive, in order."""
    rows = tested(docs)
    runs = _table(rows.select(F.explode("runs").alias("r")).select("r.stratum", "r.bin", F.lit(1).alias("n")))
    decoy = _table(rows.select(F.explode("decoys").alias("d")).select("d.*"))
    last = F.array(*map(F.lit, limits(runs, decoy, rate).tolist()))
    random = F.filter("runs", lambda r: r["bin"] <= F.get(last, r["stratum"]))
    added = F.transform(random, lambda r: F.struct(F.lit(KINDS.index("random")).alias("kind"), r["start"].alias("start"), r["end"].alias("end")))
    order = F.transform(F.concat("base", added), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    ordered = F.transform(F.sort_array(order), lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", "base", ordered.alias("spans"))


def _shown(spans: str) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random of every row."""
    found = find(docs)

    def number(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select("doc_id", *(number(k).alias(f"n_{name}") for k, name in enumerate(KINDS[:3])),
                        F.sha2(_shown("base").cast("binary"), 256).alias("base_sha256"), _shown("spans").alias("spans"),
                        number(3).alias("n_random"))
