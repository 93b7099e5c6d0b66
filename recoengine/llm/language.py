"""Language ID with spans: scripts, per-word scores, and Viterbi.

A model is the counts of hashed 1- to 3-grams of letters by language, and the
scripts that each language's letters come from, summed by Spark over all
training rows; its size is bounded by ``BUCKETS`` and the number of languages.
A word's script narrows its candidate languages; each candidate scores the word
by its letters' log probabilities. A path through a text's words pays
``PENALTY`` for each change of language; Viterbi finds the best one. A text
whose best single language no other can beat by half the penalty on any run of
words has that language throughout, so most texts need no walk.

Defined results: a text that is null or has no letter is ``und`` with score 0
and no spans; a word of a script that no language was seen in leaves all
languages open; ties go to the first language by code point; without training
rows every text with letters is ``und``; rows with equal ids are labelled each;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recoengine.llm.common import byte_chunks, table
from recoengine.llm.windows import mix

BUCKETS = 1 << 15
PENALTY = 30.0
#: Share of a language's letters from which a script counts as its own.
SCRIPT_SHARE = 0.02

#: First code point of each script's ranges (fixed values of the Unicode
#: blocks); what lies between named ranges is "other".
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "devanagari": [(0x900, 0x97F)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
OTHER = len(SCRIPTS)
_tables: dict[str, np.ndarray] = {}


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    if "letters" not in _tables:
        _tables["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return _tables["letters"]


def _script_of() -> np.ndarray:
    if "script" not in _tables:
        out = np.full(0x110000, OTHER, dtype=np.int8)
        for k, ranges in enumerate(SCRIPTS.values()):
            for a, b in ranges:
                out[a:b + 1] = k
        _tables["script"] = out
    return _tables["script"]


@dataclass
class Words:
    """Letter runs of a chunk of texts: features of each letter, and words."""
    grams: np.ndarray   # (letters, 3) hashed buckets
    script: np.ndarray  # of each letter
    begin: np.ndarray   # of each word, in letters
    length: np.ndarray
    doc: np.ndarray     # of each word
    start: np.ndarray   # of each word, in characters of its text

    @classmethod
    def of(cls, texts: list[str | None]) -> Words:
        low = [(t or "").lower() for t in texts]
        low = [a if len(a) == len(t or "") else (t or "") for a, t in zip(low, texts)]  # places stay
        chars = np.frombuffer("\n".join(["", *low, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        size = np.array([len(t) for t in low], dtype=np.int64)
        first = 1 + np.cumsum(size + 1) - (size + 1)
        is_letter = _letters()[chars]
        x = np.where(is_letter, chars, 0).astype(np.uint64)
        at = np.flatnonzero(is_letter)
        a, b, c = x[at - 1], x[at], x[at + 1]
        grams = np.stack([mix(b), mix(a << np.uint64(21) | b | np.uint64(1 << 60)),
                          mix((a << np.uint64(42)) ^ (b << np.uint64(21)) ^ c ^ np.uint64(1 << 63))], axis=1) % np.uint64(BUCKETS)
        new = np.ones(len(at), dtype=bool)
        new[1:] = at[1:] != at[:-1] + 1
        begin = np.flatnonzero(new)
        doc = np.searchsorted(first, at[begin], side="right") - 1
        return cls(grams.astype(np.int64), _script_of()[chars[at]], begin, np.diff(np.append(begin, len(at))), doc, at[begin] - first[doc])


@dataclass
class Model:
    languages: list[str]
    scores: np.ndarray   # (BUCKETS, languages) log probabilities
    scripts: np.ndarray  # (scripts, languages) whether a language uses it

    def word_scores(self, words: Words) -> np.ndarray:
        """(words, languages); a language that the script rules out scores the
        word as far below the best as a change of language costs."""
        if not len(words.begin):
            return np.zeros((0, len(self.languages)))
        each = self.scores[words.grams[:, 0]] + self.scores[words.grams[:, 1]] + self.scores[words.grams[:, 2]]
        out = np.add.reduceat(each, words.begin, axis=0).astype(np.float64) / 3
        allowed = self.scripts[words.script[words.begin]]
        allowed |= ~allowed.any(axis=1, keepdims=True)
        best = np.where(allowed, out, -np.inf).max(axis=1, keepdims=True)
        return np.where(allowed, out, np.minimum(out, best - PENALTY))


def train(rows: DataFrame, buckets: int = BUCKETS) -> Model:
    """From (text, lang) rows with lang not null."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for chunk in byte_chunks(batches, "text", 2 << 20):
            words = Words.of(chunk.column("text").to_pylist())
            of_doc = np.array(chunk.column("lang").to_pylist(), dtype=object)
            letter_lang = np.repeat(of_doc[words.doc], words.length)
            for lang in set(of_doc):
                mine = letter_lang == lang
                total = sums.setdefault(lang, np.zeros(buckets + OTHER + 1, dtype=np.int64))
                total[:buckets] += np.bincount(words.grams[mine].ravel(), minlength=buckets)
                total[buckets:] += np.bincount(words.script[mine], minlength=OTHER + 1)
        for lang, total in sums.items():
            cell = np.append(np.flatnonzero(total), -1)  # a language without letters is still one
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(cell)), pa.array(cell.astype(np.int32)), pa.array(total[cell])],
                                             ["lang", "cell", "n"])

    counted = rows.select("text", "lang").mapInArrow(count, "lang string, cell int, n long")
    # at most (buckets + scripts) rows a language
    sums = counted.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(sums["lang"].unique())
    counts = np.zeros((buckets + OTHER + 1, len(languages)))
    sums = sums[sums["cell"] >= 0]
    counts[sums["cell"].to_numpy(), np.searchsorted(languages, sums["lang"].to_numpy(dtype=str))] = sums["n"].to_numpy()
    grams, scripts = counts[:buckets] + 0.5, counts[buckets:]
    return Model(languages, np.log(grams / grams.sum(axis=0)).astype(np.float32),
                 scripts >= np.maximum(1, SCRIPT_SHARE * scripts.sum(axis=0)))


def best_path(scores: np.ndarray, penalty: float = PENALTY) -> np.ndarray:
    """Viterbi with one cost for any change of state: state of each word."""
    total = scores.sum(axis=0)
    single = int(total.argmax())
    gain = np.cumsum(scores - scores[:, [single]], axis=0)
    low = np.minimum(np.minimum.accumulate(np.vstack([np.zeros((1, gain.shape[1])), gain[:-1]]), axis=0), 0)
    if (gain - low).max() <= penalty / 2:  # no run of words pays for its change
        return np.full(len(scores), single)
    value = scores[0].copy()
    came = np.empty(scores.shape, dtype=np.int32)
    stay = np.arange(scores.shape[1])
    for t in range(1, len(scores)):
        k = int(value.argmax())
        change = value[k] - penalty > value
        came[t] = np.where(change, k, stay)
        value = np.maximum(value, value[k] - penalty) + scores[t]
    path = np.empty(len(scores), dtype=np.int64)
    path[-1] = value.argmax()
    for t in range(len(scores) - 1, 0, -1):
        path[t - 1] = came[t, path[t]]
    return path


def label(docs: DataFrame, model: Model, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, spans): spans are (start, end, lang) in
    characters, score the share of letters in spans of the main language."""
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())])

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in byte_chunks(batches, "text", 2 << 20):
            texts = chunk.column("text").to_pylist()
            words = Words.of(texts)
            scores = model.word_scores(words)
            cuts = np.searchsorted(words.doc, np.arange(len(texts) + 1))
            langs, shares, spans = [], [], []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if a == b or not model.languages:
                    langs.append("und")
                    shares.append(0.0)
                    spans.append([])
                    continue
                path = best_path(scores[a:b])
                letters = np.bincount(path, words.length[a:b], len(model.languages))
                main = int(letters.argmax())
                langs.append(model.languages[main])
                shares.append(float(letters[main] / letters.sum()))
                edge = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
                last = np.append(edge[1:], b - a) - 1
                spans.append([{"start": int(words.start[a + i]), "end": int(words.start[a + j] + words.length[a + j]),
                               "lang": model.languages[path[i]]} for i, j in zip(edge, last)])
            yield pa.RecordBatch.from_arrays([chunk.column(key), pa.array(langs, pa.string()), pa.array(shares, pa.float64()),
                                              pa.array(spans, pa.list_(span))], [key, "lang_pred", "score", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(
        kernel, f"{key} {kind}, lang_pred string, score double, spans array<struct<start: int, end: int, lang: string>>")


def held_out(key: str = "doc_id") -> Column:
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(3)) == 1


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.where(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull()))
    return label(docs, model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
