"""Parts of speech and chunks. The tagger is a lexicon with rules on endings; another one may be given in its place."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import batches
from factloom.session import sized

TAGGED = "array<struct<word:string,pos:string,lemma:string>>"
UNKNOWN = "<unknown>"
_CLOSED = {
    "DT": "the a an this that these those every each", "IN": "of in on at by for from with about into over under between", "CC": "and or but nor", "PP": "i you he she it we they him her them",
    "MD": "will would can could may might shall should must", "VB": "be am is are was were been have has had do does did", "TO": "to",
}
_WORDS = {w: tag for tag, words in _CLOSED.items() for w in words.split()}
_LEMMAS = {w: "be" for w in "am is are was were been be".split()} | {w: "have" for w in "have has had".split()} | {w: "do" for w in "do does did".split()}
_ENDINGS = (("ing", "VVG"), ("ed", "VVD"), ("ly", "RB"), ("ous", "JJ"), ("ful", "JJ"), ("ive", "JJ"), ("tion", "NN"), ("ness", "NN"), ("s", "NNS"))
Tagger = Callable[[str], list[tuple[str, str, str]]]


_TOKEN, _WORD = re.compile(r"\w+|[^\w\s]"), re.compile(r"\w+")
#: Tags of words inside a sentence and at its beginning, up to SEEN of each.
SEEN = 1 << 17
_seen: tuple[dict[str, tuple[str, str, str]], ...] = ({}, {})


def _tag(w: str, begin: bool) -> tuple[str, str, str]:
    low = w.lower()
    if not w[0].isalnum():
        return w, "SENT" if w in ".!?" else w, w
    if w.isdigit():
        return w, "CD", w
    if low in _WORDS:
        return w, _WORDS[low], _LEMMAS.get(low, low)
    if w[0].isupper() and not begin:
        return w, "NP", w
    ending, pos = next(((e, p) for e, p in _ENDINGS if low.endswith(e) and len(low) > len(e) + 2), ("", "NN"))
    return w, pos, low[: -len(ending)] if ending in ("ing", "ed", "s") else low


def tag(text: str) -> list[tuple[str, str, str]]:
    """(word, part of speech, lemma) of each word; a number is CD, a mark its own tag, a capitalised word inside a sentence NP."""
    out, begin = [], True
    for w in _TOKEN.findall(text):
        seen = _seen[begin]
        t = seen.get(w)
        if t is None:
            if len(seen) >= SEEN:
                seen.clear()
            t = seen[w] = _tag(w, begin)
        out.append(t)
        begin = t[1] == "SENT"
    return out


def _lists(found: list[list[tuple]], names: list[str], kinds: list[pa.DataType]) -> pa.Array:
    """Lists of tuples as an array of lists of structs."""
    offsets = pa.array([0, *accumulate(map(len, found))], pa.int32())
    columns = [pa.array([x[i] for row in found for x in row], kind) for i, kind in enumerate(kinds)]
    return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(columns, names))


def _by_text(f: Callable[[str], list[tuple]], names: list[str], kinds: list[pa.DataType]):  # noqa: ANN202
    """What f gives for each text, of some characters at a time: a batch of long texts is never tagged as a whole."""

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            for part in batches.texts(column):
                yield _lists([[] if t is None else f(t) for t in part.to_pylist()], names, kinds)

    return run


def tagged(text: Column | str, tagger: Tagger = tag) -> Column:
    """The tags of a text, by Arrow batches."""
    return F.arrow_udf(_by_text(tagger, ["word", "pos", "lemma"], [pa.string()] * 3), TAGGED)(text)


def verb_counts(text: Column | str, tagger: Tagger = tag, prefix: str = "V") -> Column:
    """Lemmas of the verbs of a text, without unknown ones, and how often each comes."""

    def counted(t: str) -> list[tuple[str, int]]:
        return list(Counter(lemma for _, pos, lemma in tagger(t) if pos.startswith(prefix) and lemma != UNKNOWN).items())

    return F.arrow_udf(_by_text(counted, ["lemma", "n"], [pa.string(), pa.int64()]), "array<struct<lemma:string,n:long>>")(text)


def known(tags: Column) -> Column:
    """Tags with a lemma."""
    return F.filter(tags, lambda t: t["lemma"] != UNKNOWN)


def verbs(tags: Column, prefix: str = "V") -> Column:
    return F.filter(tags, lambda t: t["pos"].startswith(prefix))


#: Parts of speech as letters, and chunks as a pattern over them: noun phrases, a verb group, noun phrases.
_LETTER = {"DT": "d", "PP": "p", "CD": "c", "JJ": "j", "NN": "n", "NNS": "n", "NP": "n", "CC": "k", "MD": "m", "IN": "i", "TO": "i", "RB": "r"}
#: Repetitions are possessive, so that a long run of nouns is tried once from each start.
_NOUNS = r"(?:[dp]?c?j*+n++k?|p)"
CHUNK = re.compile(rf"{_NOUNS}++m?r?v++i?{_NOUNS}++")


def _letter(pos: str) -> str:
    return _LETTER.get(pos, "v" if pos.startswith("V") else "x")


def _chunks(words: list[str], pos: list[str]) -> list[str]:
    return [" ".join(words[m.start() : m.end()]) for m in CHUNK.finditer("".join(map(_letter, pos)))]


def chunk_texts(tags: list) -> list[str]:
    return _chunks([t["word"] for t in tags], [t["pos"] for t in tags])


def chunks(tags: Column) -> Column:
    """Texts of the chunks of the grammar in a tagged sentence."""

    def run(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in rows:
            for part in batches.parts(column, pc.list_value_length(column), batches.TOKENS):
                yield pa.array([chunk_texts(t or []) for t in part.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(tags)


def sentence_chunks(sentence: Column | str, tokens: frozenset[str] | None = None, tagger: Tagger = tag) -> Column:
    """chunks of a sentence, tagged where they are cut: tags don't leave the worker. tokens: only chunks that hold one of these words in lower case."""

    def cut(t: str) -> list[str]:
        if tokens is not None and tagger is tag:
            low = t.lower()
            if tokens.isdisjoint(_WORD.findall(low) if len(low) == len(t) else map(str.lower, _WORD.findall(t))):
                return []
        tags = tagger(t)
        found = _chunks([x[0] for x in tags], [x[1] for x in tags])
        return found if tokens is None else [c for c in found if not tokens.isdisjoint(c.lower().split(" "))]

    def run(rows: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in rows:
            for part in batches.texts(column):
                yield pa.array([[] if t is None else cut(t) for t in part.to_pylist()], pa.list_(pa.string()))

    return F.arrow_udf(run, "array<string>")(sentence)


def clauses(sentence: Column | str) -> Column:
    """Parts of a sentence between commas, semicolons and conjunctions: a stand-in for the lowest clauses of a parse."""
    return F.filter(F.transform(F.split(sentence, r"[,;:]\s+|\s+(?:and|but|which|who|while|because)\s+"), lambda x: F.trim(x)), lambda x: F.length(x) >= 5)


def grammar_extract(sents: DataFrame, units: DataFrame, tagger: Tagger = tag, held: int = 10_000) -> DataFrame:
    """A row for each chunk of a sentence and lexical unit with a token in it. Up to `held` tokens are known where sentences are tagged, so that only chunks with one of
    them become rows."""
    units = units.select("lemma", "token").distinct()
    known = [r[0] for r in units.select("token").distinct().limit(held + 1).collect()]
    tokens = frozenset(x for x in known if x is not None) if len(known) <= held else None
    each = sents.withColumn("chunk", F.explode(sentence_chunks("sentence", tokens, tagger)))
    words = each.withColumn("token", F.explode(F.array_distinct(F.split(F.lower("chunk"), " "))))
    return words.join(sized(units), "token")


def clause_extract(sents: DataFrame, units: DataFrame) -> DataFrame:
    """Clauses with exactly one token of the lexical units."""
    each = sents.withColumn("clause", F.explode(clauses("sentence")))
    words = each.withColumn("token", F.explode(F.array_distinct(F.split(F.lower("clause"), r"[^\p{L}\p{N}]+"))))
    met = words.join(sized(units.select("lemma", "token").distinct()), "token")
    keys = [c for c in each.columns if c != "clause"]
    return met.groupBy(*keys, "clause").agg(F.count("*").alias("_n"), F.min("lemma").alias("lemma"), F.min("token").alias("token")).where("_n = 1").drop("_n")
