"""Quality rules: divergence of a document from its language's usual profile.

Two histograms are compared with references by Jensen-Shannon distance: the classes of a
text's characters, and its most common words. The references are learned from all
documents of the language (a null language counts as its own). Texts or languages with too
few words are not judged by them. The limit of the words is a share of the distance that a
text without any of the common words has, but not below what chance gives a short text.

Nulls and empty texts have no words; they fail the length rule. Repeated rows are judged
alike, and other columns of the input never matter.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from murmur.llm.common import SPACES, byte_values
from murmur.llm.hashing import each_word_hashes, shingle_hashes

#: The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
CLASSES = ("lower", "upper", "digit", "space", "symbol", "punctuation", "wide")
_EMPTY_KEY = ""


@dataclass(frozen=True)
class QualityRules:
    """min_words and max_repeat_percent are the base rules; the others guide the divergence."""

    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 24
    judged_words: int = 80
    reference_words: int = 5_000
    max_class_distance: float = 0.30
    max_word_share: float = 0.70
    chance_factor: float = 1.2


def _class_of_byte() -> np.ndarray:
    """Class per byte; continuation bytes of UTF-8 get none."""
    kinds = np.full(256, len(CLASSES), dtype=np.int64)
    for byte in range(128):
        letter = bytes([byte])
        if letter in SPACES:
            kinds[byte] = 3
        elif letter.islower():
            kinds[byte] = 0
        elif letter.isupper():
            kinds[byte] = 1
        elif letter.isdigit():
            kinds[byte] = 2
        elif byte in SYMBOLS:
            kinds[byte] = 4
        else:
            kinds[byte] = 5
    kinds[0xC0:] = 6
    return kinds


_CLASS_MATRIX = np.zeros((256, len(CLASSES) + 1), dtype=np.int64)
_CLASS_MATRIX[np.arange(256), _class_of_byte()] = 1
#: Lower case for A-Z, blanks for other ASCII characters that are neither letters nor digits.
_PLAIN = bytes(
    ord(chr(b).lower()) if b < 128 and chr(b).isalnum() else (32 if b < 128 else b)
    for b in range(256)
)


def _byte_counts(text: bytes) -> np.ndarray:
    return np.bincount(np.frombuffer(text, np.uint8), minlength=256)


def class_histogram(text: bytes) -> np.ndarray:
    return (_byte_counts(text) @ _CLASS_MATRIX)[: len(CLASSES)]


def distance(counts: np.ndarray, reference: np.ndarray) -> float:
    """Jensen-Shannon distance, 0 to 1; 0 where either side is empty."""
    if not counts.sum() or not reference.sum():
        return 0.0
    p, q = counts / counts.sum(), reference / reference.sum()
    middle = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        left = np.where(p > 0, p * np.log2(p / middle), 0).sum()
        right = np.where(q > 0, q * np.log2(q / middle), 0).sum()
    return float(np.sqrt(max(0.0, (left + right) / 2)))


def repeated_words(words: np.ndarray, width: int = 3) -> int:
    """Words inside windows of ``width`` words that the text holds twice or more."""
    if len(words) <= width:
        return 0
    windows = shingle_hashes(words, width)
    ordered = np.sort(windows)
    repeated = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(repeated):
        return 0
    repeated = np.unique(repeated)
    at = np.minimum(np.searchsorted(repeated, windows), len(repeated) - 1)
    starts = np.flatnonzero(repeated[at] == windows)
    steps = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + width, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def repeated_lines(text: bytes) -> int:
    seen: set[bytes] = set()
    repeats = 0
    for line in text.split(b"\n"):
        if line.strip(SPACES):
            if line in seen:
                repeats += 1
            else:
                seen.add(line)
    return repeats


# Words of a language that a task holds before it sends their counts on; there are several
# languages and two tasks to an executor, at about 150 bytes a word.
_FLUSH = 100_000


def _profile_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words: dict[str, Counter] = {}
    classes: dict[str, np.ndarray] = {}

    def rows(lang: str) -> pa.RecordBatch:
        counts = words.pop(lang)
        names = pa.array(list(counts), pa.binary()).cast(pa.string())
        totals = classes.pop(lang)
        size = len(counts)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * (size + len(CLASSES)), pa.string()),
                pa.array([-1] * size + list(range(len(CLASSES))), pa.int32()),
                pa.concat_arrays([names, pa.array([""] * len(CLASSES))]),
                pa.array([*counts.values(), *totals.tolist()], pa.int64()),
            ],
            names=["language", "char_class", "word", "n"],
        )

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), byte_values(batch.column(1))):
            lang = lang or _EMPTY_KEY
            counts = words.setdefault(lang, Counter())
            counts.update(text.translate(_PLAIN).split())
            classes[lang] = classes.get(lang, 0) + class_histogram(text)
            if len(counts) > _FLUSH:
                yield rows(lang)
    for lang in list(words):
        yield rows(lang)


@dataclass
class Profile:
    classes: np.ndarray
    words: list[bytes]
    counts: np.ndarray
    total: int
    bare: float = 0.0  # word distance of a text that has none of the common words


def language_profiles(docs: DataFrame, rules: QualityRules) -> dict[str, Profile]:
    """Class totals and the most common words of each language, over all documents.

    The driver receives ``common_words`` rows and the class totals per language.
    """
    counted = (
        docs.select("lang", "text")
        .mapInArrow(_profile_rows, "language string, char_class int, word string, n long")
        .groupBy("language", "char_class", "word")
        .agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("language", "char_class").orderBy(F.desc("n"), "word")
    top = (
        counted.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= rules.common_words)
        .drop("rank")
    )
    profiles: dict[str, Profile] = {}
    for row in top.collect():
        profile = profiles.setdefault(
            row["language"], Profile(np.zeros(len(CLASSES)), [], np.zeros(0), 0)
        )
        if row["char_class"] >= 0:
            profile.classes[row["char_class"]] = row["n"]
        else:
            profile.words.append(row["word"].encode())
            profile.counts = np.append(profile.counts, row["n"])
    totals = counted.where("char_class = -1").groupBy("language").agg(F.sum("n").alias("n"))
    for row in totals.collect():
        profile = profiles[row["language"]]
        profile.total = row["n"]
        without = _with_rest(np.zeros(len(profile.counts)), 1)
        profile.bare = distance(without, _with_rest(profile.counts, profile.total))
    return profiles


def _with_rest(common: np.ndarray, total: int) -> np.ndarray:
    return np.append(common, max(0, total - common.sum()))


def word_limit(profile: Profile, n_words: int, rules: QualityRules) -> float:
    """Greatest word distance of kept texts; drawing words by chance gives about ``chance``."""
    chance = math.sqrt(len(profile.words) / (8 * math.log(2) * n_words))
    return max(rules.max_word_share * profile.bare, rules.chance_factor * chance)


def measure(
    lang: str | None, text: bytes, words: np.ndarray, profiles: dict, rules: QualityRules
) -> tuple:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    class_distance, word_distance)."""
    n_words = len(words)
    by_byte = _byte_counts(text)
    classes = (by_byte @ _CLASS_MATRIX)[: len(CLASSES)]
    word_chars = int(classes.sum() - classes[3])
    n_symbols = int(by_byte[list(SYMBOLS)].sum())
    n_repeat = repeated_words(words)
    failed = n_words < rules.min_words or 100 * n_repeat > rules.max_repeat_percent * n_words
    by_class = by_word = 0.0
    limit = 1.0
    profile = profiles.get(lang or _EMPTY_KEY)
    if profile and n_words >= rules.judged_words and profile.total >= rules.reference_words:
        by_class = distance(classes, profile.classes)
        plain = Counter(text.translate(_PLAIN).split())
        common = np.array([plain.get(w, 0) for w in profile.words], dtype=np.float64)
        by_word = distance(
            _with_rest(common, sum(plain.values())), _with_rest(profile.counts, profile.total)
        )
        limit = word_limit(profile, n_words, rules)
    kept = not failed and by_class <= rules.max_class_distance and by_word <= limit
    lines = repeated_lines(text)
    return n_words, word_chars, n_symbols, lines, n_repeat, failed, kept, by_class, by_word


def measured(langs: pa.Array, texts: pa.Array, profiles: dict, rules: QualityRules) -> list:
    hashed = each_word_hashes(byte_values(texts))
    rows = zip(langs.to_pylist(), byte_values(texts), hashed)
    return [measure(lang, text, words, profiles, rules) for lang, text, words in rows]


_TYPES = [
    ("n_words", pa.int64()),
    ("word_chars", pa.int64()),
    ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()),
    ("n_repeat_words", pa.int64()),
    ("base_failed", pa.bool_()),
    ("kept", pa.bool_()),
    ("class_distance", pa.float64()),
    ("word_distance", pa.float64()),
]
_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, class_distance double, "
    "word_distance double"
)


def score_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """One row per document with its counts, distances and verdict."""
    shared = docs.sparkSession.sparkContext.broadcast(language_profiles(docs, rules))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measured(batch.column(1), batch.column(2), shared.value, rules)
            arrays = [
                pa.array([row[i] for row in found], kind) for i, (_, kind) in enumerate(_TYPES)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *arrays], names=["doc_id", *(name for name, _ in _TYPES)]
            )

    picked = docs.select(F.col("doc_id").cast("long"), "lang", "text")
    return picked.mapInArrow(score, _SCHEMA)


def keep_good(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(language_profiles(docs, rules))
    text_at, lang_at = docs.columns.index("text"), docs.columns.index("lang")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measured(batch.column(lang_at), batch.column(text_at), shared.value, rules)
            good = [row[6] for row in found]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)
