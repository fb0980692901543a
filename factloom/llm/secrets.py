"""Secret scans: patterns, and a battery of randomness tests on tokens that no pattern names.

A candidate is a run of 16 characters or more of the usual encodings, that isn't a number. Its encoding is the least alphabet that
has all its characters. Three tests of uniform random characters (chi-squared frequencies, runs about the median, serial correlation)
are combined by Fisher's method. Decoys go through the same battery, in the candidate's alphabet and of its length: names made of the words
beside it, written as the candidate is (upper case, capitals, signs between words, its digits at the end). In each class of lengths, and apart for
tokens of one kind of characters and of several, candidates are reported from the score at which the decoys' share among them stays below
`rate`. So a short token has to look more random than a long one, as ordinary names of its length look random more often.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.blocks import trim
from factloom.llm.shared import start, written
from factloom.llm.spans import Taken

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
_FREQUENT = frozenset("etaoinsrhdlETAOINSRHDL")
#: Shorter tokens can't be told from words by three tests: names of that length look random too often.
LEAST = 16
RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % LEAST)
_WORD = re.compile("[A-Za-z]+")
ALPHABETS = {
    "hex": "0123456789abcdef", "HEX": "0123456789ABCDEF", "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "lower": "abcdefghijklmnopqrstuvwxyz", "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ", "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/",
    "base64url": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_", "mixed": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/-_.=",
}


def _grouped(alphabet: str) -> np.ndarray:
    """For each character its cell: digits, signs, and in each case the letters that are frequent in prose and the others."""
    cell = [0 if c.isdigit() else 1 if not c.isalpha() else 2 + 2 * c.isupper() + (c in _FREQUENT) for c in alphabet]
    return np.unique(cell, return_inverse=True)[1]


_GROUPS = {name: _grouped(a) for name, a in ALPHABETS.items()}
_PLACES = {name: {c: i for i, c in enumerate(a)} for name, a in ALPHABETS.items()}
LENGTHS = (20, 24, 32, 48, 64)
STRATA = 2 * (len(LENGTHS) + 1)
BINS = 120


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns in a text, in code points."""
    out = []
    if ":" in text or "=" in text:
        out += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def upper_chi2(x: float, k: int) -> float:
    """P(chi-squared with k degrees of freedom > x), by Wilson and Hilferty."""
    z = ((max(x, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    return 0.5 * math.erfc(z / math.sqrt(2))


def encoding_of(token: str) -> str:
    """The least of the alphabets that has all characters of a token (without its padding)."""
    seen = set(token)
    return next(name for name, a in _PLACES.items() if seen <= a.keys())


def battery(token: str, encoding: str | None = None) -> float:
    """log10 of the probability that random characters of the encoding look as irregular as the token or more; 0 for fewer than two."""
    token = token.rstrip("=")
    if len(token) < 2:
        return 0.0
    encoding = encoding or encoding_of(token)
    place, group = _PLACES[encoding], _GROUPS[encoding]
    k, n = len(place), len(token)
    x = np.array([place[c] for c in token])
    if n < 5 * k:  # too few for a cell of each character
        count, expected = np.bincount(group[x], minlength=group.max() + 1), np.bincount(group) * n / k
    else:
        count, expected = np.bincount(x, minlength=k), np.full(k, n / k)
    chi = upper_chi2(float(((count - expected) ** 2 / expected).sum()), max(1, len(count) - 1))
    high = x >= k / 2
    n1 = int(high.sum())
    n0 = n - n1
    if n0 and n1:
        runs = 1 + int((high[1:] != high[:-1]).sum())
        mean = 2 * n0 * n1 / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        run = math.erfc(abs(runs - mean) / math.sqrt(2 * var))
    else:
        run = 2.0 ** (1 - n)
    centred = x - x.mean()
    square = float((centred**2).sum())
    serial = math.erfc(abs(float((centred[1:] * centred[:-1]).sum()) / square) * math.sqrt(n / 2)) if square else 2.0 ** (1 - n)
    fisher = -2 * sum(math.log(max(p, 1e-300)) for p in (chi, run, serial))
    half = fisher / 2  # the exact tail for 6 degrees of freedom
    return (-half + math.log(1 + half + half * half / 2)) / math.log(10)


def kinds_of(token: str) -> int:
    """How many of digits, lower-case, upper-case letters (after the first character) and signs a token has."""
    body = token.rstrip("=")
    return sum((any(c.isdigit() for c in body), any(c.islower() for c in body), any(c.isupper() for c in body[1:]), any(c in "+/-_" for c in body)))


def _bin(score: float) -> int:
    return int(min(BINS - 1, max(0, -score * 10)))


def stratum(token: str) -> int:
    n = len(token.rstrip("="))
    return 2 * sum(n >= x for x in LENGTHS) + (kinds_of(token) > 1)


def decoy(token: str, near: str) -> str:
    """A name of the words of a text, in the token's alphabet, of its length and with its digits; empty where the text has too few letters."""
    place = _PLACES[encoding_of(token)]
    upper, lower = any(c.isupper() for c in token), any(c.islower() for c in token)
    digits, signs = "".join(c for c in token if c.isdigit()), "".join(c for c in token if c in "+/-_")
    need, out = len(token) - len(digits), []
    for m in _WORD.finditer(near):
        word = m[0].upper() if upper and not lower else m[0].lower()
        word = "".join(c for c in word if c in place or c.upper() in place)
        out.append((word[:1].upper() + word[1:] if upper and lower else word) + signs[len(out) : len(out) + 1])
        need -= len(out[-1])
        if need <= 0:
            return "".join(out)[: len(token) - len(digits)] + digits
    return ""


def candidates(text: str, taken: Sequence[tuple[int, int, int]]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int, int]]]:
    """(start, end, stratum, score bin) of tokens apart from taken spans, and for each of them (hash of token and decoys, stratum, score bin, score
    bins of its two decoys or -1)."""
    found, evidence, held = [], [], Taken((s, e) for _, s, e in taken)
    for m in RUN.finditer(text):
        a, b = m.span()
        token = m.group().rstrip("=")
        if token.isdigit() or held.overlaps(a, b):
            continue
        n, encoding = len(token), encoding_of(token)
        found.append((a, b, stratum(token), _bin(battery(token, encoding))))
        sides = [decoy(token, text[max(0, a - 8 * n) : a]), decoy(token, text[b : b + 8 * n])]
        name = hashlib.blake2b(" ".join([token, *sides]).encode(), digest_size=8).digest()
        evidence.append((int.from_bytes(name, "little", signed=True), *found[-1][2:], *(_bin(battery(x, encoding)) if x else -1 for x in sides)))
    return found, evidence


def tested(text: str, spans: Sequence[tuple[int, int, int]]) -> str:
    """encoding:score of the value of each base span, in their order, joined by commas; score to two digits."""
    out = []
    for kind, a, b in spans:
        value = (ASSIGN.match(text, a)[1] if kind == 0 else text[a + 4 : b] if kind == 1 else text[a:b]).rstrip("=")
        out.append(f"{encoding_of(value)}:{battery(value) + 0.0:.2f}")
    return ",".join(out)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        base, found, evidence, tests = [], [], [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text) if text else []
            more = candidates(text, spans) if text else ([], [])
            base.append([x for s in spans for x in s])
            tests.append(tested(text, spans) if spans else "")
            found.append([x for s in more[0] for x in s])
            evidence.append([x for s in more[1] for x in s])
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "base": pa.array(base, ints), "found": pa.array(found, ints), "evidence": pa.array(evidence, pa.list_(pa.int64())), "tests": pa.array(tests, pa.string())})
        trim()


def thresholds(targets: np.ndarray, decoys: np.ndarray, rate: float) -> np.ndarray:
    """For each stratum the number of score bins that are reported, from the most random one on: the most for which the decoys
    in them (two for each target), and one more, are at most rate of the targets. Both: counts by stratum and bin."""
    up, down = np.cumsum(targets, 1), np.cumsum(decoys, 1)
    ok = (down / 2 + 1) / np.maximum(up, 1) <= rate
    return np.where(ok.any(1), BINS - np.argmax(ok[:, ::-1], 1), 0)


def joined(spans: list[tuple[int, int, int]], kinds: Sequence[str]) -> str:
    return ",".join(f"{kinds[k]}:{a}:{b}" for k, a, b in spans)


def secret_scan(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """One row for each row of docs: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random and base_tests (inferred encoding and battery's
    log10 p-value of each base span's value).

    Spans are kind:start:end in code points; those of kind random come from the battery and overlap no other. Thresholds are worked out from the
    distinct candidates and decoys of all rows. A null or empty text has no spans; a null doc_id stays null; repeated rows give equal rows and
    count once; without candidates, or with fewer than 1 / rate distinct ones in a stratum, none of it is reported; of equal scores all or none are; texts
    and tokens of any length are taken whole; an empty table gives an empty result. Other columns are ignored. One pass over the texts; what it finds is written and is small.
    """
    start(docs)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scanned = written(rows.mapInArrow(_scan, "doc_id long, base array<int>, found array<int>, evidence array<long>, tests string"), "secrets")
    # Copies meet before the shuffle, so a hot one costs no task more than its share.
    each = F.expr("explode(transform(sequence(0, size(evidence) div 5 - 1), i -> slice(evidence, 5 * i + 1, 5)))")
    distinct = scanned.where(F.size("evidence") > 0).select(each.alias("e")).select(*[F.col("e")[i].alias(c) for i, c in enumerate(("hash", "c", "target", "left", "right"))]).distinct()
    bins = distinct.select("c", F.explode(F.array(*[F.struct(F.lit(side).alias("side"), F.col(c).alias("b")) for side, c in ((0, "target"), (1, "left"), (1, "right"))])).alias("x"))
    counts = np.zeros((2, STRATA, BINS), np.int64)
    for r in bins.where("x.b >= 0").groupBy("x.side", "c", "x.b").count().collect():
        counts[r[0], r[1], r[2]] = r[3]
    limits = thresholds(counts[0], counts[1], rate)

    def report(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for p in batches:
            out = []
            for doc_id, base, found, tests in zip(p.doc_id, p.base, p.found, p.tests, strict=True):
                spans = [tuple(map(int, base[i : i + 3])) for i in range(0, len(base), 3)]
                more = [(3, int(found[i]), int(found[i + 1])) for i in range(0, len(found), 4) if found[i + 3] < limits[found[i + 2]]]
                sha = hashlib.sha256(joined(spans, KINDS).encode()).hexdigest()
                every = joined(sorted(spans + more, key=lambda s: (s[1], s[0])), KINDS)
                out.append((None if pd.isna(doc_id) else int(doc_id), *(sum(s[0] == k for s in spans) for k in range(3)), sha, every, len(more), tests))
            yield pd.DataFrame(out, dtype=object, columns=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random", "base_tests"])

    return scanned.select("doc_id", "base", "found", "tests").mapInPandas(
        report, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long, base_tests string"
    )
