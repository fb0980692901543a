"""Personal data: patterns, and a linear-chain conditional random field over word shapes.

The field labels words that hold a digit or an @; other words are O, which is a constraint of the model, so a text falls into runs
of such words between O's, and each run is decoded by itself, exactly. The plain words beside a run are features of its ends. Runs of equal length go through Viterbi together. Training data are a small
table of made-up labelled sentences; the weights are fitted on the driver and sent with the function.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.blocks import LEAD, blocks
from factloom.llm.shared import start
from factloom.llm.spans import Taken

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Where a match at the first digit of a run fails, one at a later digit of it fails too.
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")
_EDGE = ".,;:!?\"'"


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of local@domain, found from each @, so that long runs without one cost nothing."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        s = at
        while s > floor and text[s - 1] in LOCAL:
            s -= 1
        m = DOMAIN.match(text, at + 1) if s < at else None
        if m:
            out.append((s, m.end()))
            floor = m.end()
        at = text.find("@", max(floor, at + 1))
    return out


def valid_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the patterns in a text, in code points, by kind and start."""
    out = [(0, *s) for s in emails(text)]
    if _DIGITS.search(text):
        out += [(1, *m.span()) for m in IP.finditer(text) if valid_ip(m.group())]
        for m in CARD.finditer(text):
            if 13 <= m.end() - m.start():
                digits = re.sub("[ -]", "", m.group())
                if 13 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, *m.span()))
        out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(_DIGITS.findall(m.group())) <= 15]
    return out


def shape(word: str) -> tuple[int, ...]:
    """Features of a word, as numbers below SHAPES: what its characters are, not which."""
    bare = word.strip(_EDGE)
    n, digits = len(bare), sum(c in "0123456789" for c in bare)
    letters = sum(c.isalpha() for c in bare)
    out = [min(digits, 20)]
    out.append(21 + (0 if n == digits else 1 if not letters else 2 if not digits else 3))
    out.append(25 + min(bare.count("."), 4))
    out.append(30 + min(bare.count("-"), 4))
    out.append(35 + min(bare.count("@"), 2))
    if bare.startswith("+"):
        out.append(38)
    if bare.startswith("("):
        out.append(39)
    if bare.endswith(")"):
        out.append(40)
    if bare.count(".") == 3 and digits + 3 == n and all(bare.split(".")):
        out.append(41 if valid_ip(bare) else 42)
    if 13 <= digits <= 19 and all(c in "0123456789-." for c in bare):
        out.append(43 if luhn(re.sub("[-.]", "", bare)) else 44)
    if "@" in bare:
        out.append(45 if "." in bare.split("@", 1)[1] else 46)
    if any(c in bare for c in "$%€£/:=#_"):
        out.append(47)
    if digits == 4 and n == 4 and bare[:2] in ("18", "19", "20"):
        out.append(48)
    return tuple(out)


SHAPES = 49
#: Plain words beside a run of marked ones, by what they announce.
CUES = (
    frozenset("phone tel telephone call calls mobile cell fax whatsapp telefon tél téléphone teléfono llame".split()), frozenset("card visa mastercard amex credit debit carte karte kreditkarte tarjeta".split()),
    frozenset("email e-mail mail mailto contact write correo courriel".split()), frozenset("ip ipv4 host server address addr client from".split()),
    frozenset("isbn issn id order invoice page pages chapter year version total ref account section".split()),
)
#: Features of the word, of the marked ones before and after; of a plain word beside it: none, a plain one, a cue, and one with a colon.
BESIDE = 2 + len(CUES) + 1
FEATURES = 3 * SHAPES + 2 * BESIDE


@lru_cache(maxsize=1 << 16)
def _shape(word: str) -> tuple[int, ...]:
    return shape(word)


@lru_cache(maxsize=1 << 16)
def beside(word: str) -> tuple[int, ...]:
    """Features of the plain word next to a run; empty at the end of the text."""
    if not word:
        return (0,)
    bare = word.strip(_EDGE + "()[]").lower()
    kind = next((2 + i for i, c in enumerate(CUES) if bare in c), 1)
    return (kind, BESIDE - 1) if word[-1] in ":=" else (kind,)


def features(run: list[str], before: str = "", after: str = "") -> list[list[int]]:
    """Features of the words of a run of marked words, with the plain words beside it."""
    out = []
    for i, w in enumerate(run):
        f = list(_shape(w))
        f += [SHAPES + x for x in _shape(run[i - 1])] if i else [3 * SHAPES + x for x in beside(before)]
        f += [2 * SHAPES + x for x in _shape(run[i + 1])] if i + 1 < len(run) else [3 * SHAPES + BESIDE + x for x in beside(after)]
        out.append(f)
    return out


def is_marked(word: str) -> bool:
    return any(c in "0123456789@" for c in word)


def labelled_table(rows: int = 600, seed: int = 5) -> list[tuple[list[str], list[str]]]:
    """Made-up sentences: words and their labels. Half of the numbers that look like personal data at first sight are none. Half of the data
    and of the others are announced by a word; bare digits are a phone number or a card only where one announces them."""
    rng = np.random.default_rng(seed)
    d = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    name = lambda n=6: "".join(rng.choice(list("aeioulnrst"), n))

    def card(good: bool) -> str:
        while True:
            s = str(rng.integers(3, 6)) + d(15)
            if luhn(s) == good:
                return s

    def email() -> list[str]:
        return [f"{name()}.{d(2)}@{name(5)}.{name(3)}" if rng.random() < 0.5 else f"{name()}@{name(4)}{d(1)}.{name(6)}.com"]

    def phone() -> list[str]:
        return [
            [f"+{d(1)}", f"({d(3)})", f"{d(3)}-{d(4)}"], [f"({d(3)})", f"{d(3)}-{d(4)}"], [f"{d(3)}-{d(3)}-{d(4)}"], [f"+{d(2)}", d(3), d(3), d(4)], [f"+{d(11)}"], [f"+{d(2)}-{d(3)}-{d(7)}"],
        ][rng.integers(0, 6)]

    ip = lambda: [".".join(str(x) for x in rng.integers(0, 256, 4))]
    said = [sorted(c) for c in CUES]

    def announced(kind: int) -> str:
        return str(rng.choice(said[{0: 2, 1: 3, 2: 1, 3: 0, -1: 4}[kind]])) + (":" if rng.random() < 0.5 else "")

    bare: list = [(3, lambda: [d(rng.integers(9, 13))]), (2, lambda: [card(True)[:4] + "-" + d(4) + "-" + d(4) + "-" + d(4)])]
    good: list = [(0, email), (1, ip), (2, lambda: [card(True)]), (3, phone)]
    bad: list = [
        lambda: [str(rng.integers(1800, 2030))], lambda: [d(rng.integers(1, 9))], lambda: [f"{d(1)}.{d(1)}.{d(1)}"], lambda: [f"{d(2)}:{d(2)}"], lambda: [f"${d(3)}.{d(2)}"], lambda: [f"{d(2)}%"],
        lambda: [card(False)], lambda: [f"{rng.integers(256, 999)}.{d(2)}.{d(3)}.{d(1)}"], lambda: [f"{d(4)}-{d(2)}-{d(2)}"], lambda: ["@" + name()], lambda: [name() + "@"], lambda: [d(rng.integers(20, 40))],
        lambda: [f"{name(3)}{d(2)}"], lambda: [f"{d(2)}/{d(2)}/{d(4)}"], lambda: [f"{name(2).upper()}{d(6)}{name(1)}"], lambda: [d(3), d(2), d(4)], lambda: [d(rng.integers(10, 13))],
        lambda: [f"{name(8)}={d(6)}{name(3)}{d(8)}"], lambda: [f"#{d(5)}"], lambda: [f"{d(3)}-{d(2)}"], lambda: [f"{name(4)}-{d(4)}"],
    ]
    out = []
    for _ in range(rows):
        words, labels = [], []
        for _ in range(rng.integers(1, 5)):
            for _ in range(rng.integers(0, 5)):
                words.append(name(rng.integers(2, 9)))
                labels.append("O")
            if rng.random() < 0.5:
                must = rng.random() < 0.15
                kind, make = bare[rng.integers(0, len(bare))] if must else good[rng.integers(0, len(good))]
                if must or rng.random() < 0.5:
                    words.append(announced(kind))
                    labels.append("O")
                more = make()
                labels += [f"{'I' if i else 'B'}-{KINDS[kind]}" for i in range(len(more))]
            else:
                if rng.random() < 0.3:
                    words.append(announced(-1))
                    labels.append("O")
                more = bad[rng.integers(0, len(bad))]()
                labels += ["O"] * len(more)
            if rng.random() < 0.3:
                more[-1] += str(rng.choice(list(".,;")))
            words += more
        out.append((words, labels))
    return out


class Field:
    """A linear-chain conditional random field: weights of features by label, and of label pairs."""

    def __init__(self) -> None:
        k = len(LABELS)
        self.w, self.t = np.zeros((FEATURES, k)), np.zeros((k, k))
        self.bar = np.zeros((k, k))  # I-x follows B-x or I-x alone
        for j, name in enumerate(LABELS):
            if name[0] == "I":
                for i, before in enumerate(LABELS):
                    if before[1:] != name[1:] or before == "O":
                        self.bar[i, j] = -1e9

    @staticmethod
    def runs(words: list[str]) -> Iterator[tuple[int, list[list[int]]]]:
        """Runs of marked words: where each begins, and its features."""
        marked = [is_marked(w) for w in words]
        i = 0
        while i < len(words):
            if marked[i]:
                j = i
                while j < len(words) and marked[j]:
                    j += 1
                yield i, features(words[i:j], words[i - 1] if i else "", words[j] if j < len(words) else "")
                i = j
            i += 1

    def fit(self, table: list[tuple[list[str], list[str]]], rounds: int = 150, rate: float = 0.3, decay: float = 1e-3) -> Field:
        """Maximum likelihood with an L2 penalty, by AdaGrad on the whole table; runs of equal length at once."""
        number = {name: i for i, name in enumerate(LABELS)}
        by: dict[int, list] = {}
        for words, labels in table:
            for at, f in self.runs(words):
                x = np.zeros((len(f), FEATURES))
                for i, own in enumerate(f):
                    x[i, own] = 1
                by.setdefault(len(f), []).append((x, [number[v] for v in labels[at : at + len(f)]]))
        groups = [(np.stack([x for x, _ in g]), np.array([y for _, y in g])) for g in by.values()]
        k, total = len(LABELS), sum(len(g[1]) for g in groups)
        seen_w, seen_t = np.full(self.w.shape, 1e-8), np.full(self.t.shape, 1e-8)
        for _ in range(rounds):
            gw, gt = -decay * self.w, -decay * self.t
            for x, y in groups:
                emit = x @ self.w
                n, size = y.shape
                step = self.t + self.bar
                fore = np.empty((n, size, k))
                fore[:, 0] = emit[:, 0] + step[0]
                for i in range(1, size):
                    fore[:, i] = _lse(fore[:, i - 1, :, None] + step, 1) + emit[:, i]
                back = np.empty((n, size, k))
                back[:, -1] = step[:, 0]
                for i in range(size - 2, -1, -1):
                    back[:, i] = _lse(step + (emit[:, i + 1] + back[:, i + 1])[:, None, :], 2)
                z = _lse(fore[:, -1] + back[:, -1], 1)[:, None]
                p = np.exp(fore + back - z[:, :, None])
                one = np.eye(k)[y]
                gw += np.einsum("nif,nik->fk", x, one - p) / total
                ends = np.concatenate([np.zeros((n, 1), int), y, np.zeros((n, 1), int)], 1)
                np.add.at(gt, (ends[:, :-1].ravel(), ends[:, 1:].ravel()), 1 / total)
                gt[0] -= p[:, 0].sum(0) / total
                gt[:, 0] -= p[:, -1].sum(0) / total
                for i in range(1, size):
                    pair = fore[:, i - 1, :, None] + step + (emit[:, i] + back[:, i])[:, None, :] - z[:, :, None]
                    gt -= np.exp(pair).sum(0) / total
            seen_w += gw * gw
            seen_t += gt * gt
            self.w += rate * gw / np.sqrt(seen_w)
            self.t += rate * gt / np.sqrt(seen_t)
        return self

    def decode(self, emit: np.ndarray) -> np.ndarray:
        """The likeliest labels of runs of one length: emit has their scores, run by word by label."""
        n, size, k = emit.shape
        step = self.t + self.bar
        score, back = emit[:, 0] + step[0], np.zeros((size, n, k), np.int8)
        for i in range(1, size):
            each = score[:, :, None] + step
            back[i] = each.argmax(1)
            score = each.max(1) + emit[:, i]
        out = np.empty((n, size), np.int64)
        out[:, -1] = (score + step[:, 0]).argmax(1)
        for i in range(size - 1, 0, -1):
            out[:, i - 1] = back[i, np.arange(n), out[:, i]]
        return out

    def label(self, runs: list[list[list[int]]]) -> list[np.ndarray]:
        """Labels of the words of each run."""
        out: list = [None] * len(runs)
        by: dict[int, list[int]] = {}
        for i, r in enumerate(runs):
            by.setdefault(len(r), []).append(i)
        for size, which in by.items():
            for at in range(0, len(which), max(1, 20_000 // size)):
                part = which[at : at + max(1, 20_000 // size)]
                emit = np.array([[self.w[f].sum(0) for f in runs[i]] for i in part])
                for i, labels in zip(part, self.decode(emit), strict=True):
                    out[i] = labels
        return out


def _lse(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis)) + np.squeeze(top, axis)


Word = tuple[int, int, str, str, str]


def marked_words(column: pa.Array) -> Iterator[tuple[int, list[Word]]]:
    """For each text with any, its marked words: number of the word, start in code points, the word, and the words of the text before and after
    it. A pass over bytes."""
    flag = np.zeros(256, bool)
    flag[list(b"0123456789@")] = True
    for b in blocks(column):
        held = np.zeros(len(b.buf) + 1, np.int32)
        np.cumsum(flag[b.buf], out=held[1:])
        at = np.flatnonzero(held[b.end] > held[b.start])
        if not len(at):
            continue
        wide = np.zeros(len(b.buf) + 1, np.int32)
        np.cumsum(LEAD[b.buf], out=wide[1:])
        doc = np.searchsorted(b.cut, at, "right") - 1
        data = b.buf.tobytes()
        cut = np.append(np.flatnonzero(np.append(True, doc[1:] != doc[:-1])), len(at))
        word = lambda w: data[b.start[w] : b.end[w]].decode()  # noqa: B023, E731
        for i in range(len(cut) - 1):
            d, own = doc[cut[i]], at[cut[i] : cut[i + 1]]
            origin, low, high = wide[b.off[d]], b.cut[d], b.cut[d + 1]
            yield b.first + int(d), [(int(w), int(wide[b.start[w]] - origin), word(w), word(w - 1) if w > low else "", word(w + 1) if w + 1 < high else "") for w in own]


def runs_of(words: list[Word]) -> Iterator[tuple[list[Word], list[list[int]]]]:
    """Runs of words that follow each other, and their features."""
    i = 0
    while i < len(words):
        j = i + 1
        while j < len(words) and words[j][0] == words[j - 1][0] + 1:
            j += 1
        run = words[i:j]
        yield run, features([w[2] for w in run], run[0][3], run[-1][4])
        i = j


def labelled_spans(run: list[Word], labels: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of the labelled words of a run, without punctuation at their ends."""
    i = 0
    while i < len(run):
        name = LABELS[labels[i]]
        if name == "O":
            i += 1
            continue
        j = i + 1
        while j < len(run) and LABELS[labels[j]] == "I-" + name[2:]:
            j += 1
        (_, a, first, *_), (_, z, last, *_) = run[i], run[j - 1]
        yield KINDS.index(name[2:]), a + len(first) - len(first.lstrip(_EDGE)), z + len(last.rstrip(_EDGE))
        i = j


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def find_pii(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, n_email, n_ip, n_card and n_phone (of the patterns), base_sha256, spans and n_added.

    Spans are kind:start:end in code points, by kind and start; those of the field are added where they overlap no pattern's. A null or empty
    text has none; a null doc_id stays null; repeated rows give equal rows; of equally likely labels the first counts; a text or a run of any length
    is decoded whole; an empty table gives an empty result. Other columns are ignored. One pass without a shuffle. field: a fitted one in place of the one that labelled_table() gives.
    """
    start(docs)
    field = field or Field().fit(labelled_table())

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found = [base_spans(t) if t else [] for t in texts]
            more: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            runs, owner, f = [], [], []
            held: dict[int, Taken] = {}
            for i, words in marked_words(batch.column(1)):
                for run, own in runs_of(words):
                    runs.append(run)
                    owner.append(i)
                    f.append(own)
            for i, run, labels in zip(owner, runs, field.label(f), strict=True):
                if labels.any():
                    if i not in held:
                        held[i] = Taken((s, e) for _, s, e in found[i])
                    more[i] += [(k, a, b) for k, a, b in labelled_spans(run, labels) if a < b and not held[i].overlaps(a, b)]
            counts = np.array([[sum(s[0] == k for s in spans) for k in range(4)] for spans in found], np.int64).reshape(-1, 4)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), **{f"n_{name}": pa.array(counts[:, k]) for k, name in enumerate(KINDS)},
                "base_sha256": pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in found], pa.string()),
                "spans": pa.array([joined(sorted(s + m)) for s, m in zip(found, more, strict=True)], pa.string()), "n_added": pa.array([len(m) for m in more], pa.int64()),
            })

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(scan, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")
