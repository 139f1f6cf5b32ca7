"""Secret scans: base patterns and random-looking strings, as spans of code points.

Two character Markov models, of random strings and of ordinary identifiers, are trained
from labelled samples. A token whose mean log-likelihood ratio per transition favours the
random model is a ``random`` span, unless a base span overlaps it. Everything runs as
DataFrame functions within each row; only the training sample is shuffled.

Null and empty texts have no spans. Repeated rows are scanned alike; a null doc_id is
carried through. Very long texts are whole too: positions are added up in chunks of matches, so
the time of a text with many matches is close to linear in their number. An empty table has no
result rows; columns other than doc_id and text are not read by the scan and kept by the redaction.

UUIDs are ordinary identifiers by their form, which is checked after the models.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The base patterns, in the order that breaks ties, and their least lengths.
ASSIGN = (
    r"""(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]"""
    r"""|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?"""
)
VALUE = r"[A-Za-z0-9+/_.=-]+"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Fixed value: the form of a UUID, with words before it.
UUID = r"^(?:[A-Za-z]+[_/=-])*[0-9A-Fa-f]{8}-(?:[0-9A-Fa-f]{4}-){3}[0-9A-Fa-f]{12}$"
KINDS = ("assign", "access", "hex", "random")

_SIZE = 128
#: Matches whose positions are added up together.
_CHUNK = 256


@dataclass(frozen=True)
class SecretRules:
    value_chars: int = 6
    access_chars: int = 20
    hex_chars: int = 24
    token_chars: int = 20
    ratio: float = 0.55
    sample_documents: int = 2_000
    random_strings: int = 4_000
    smoothing: float = 0.1


def _text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def _spans(text: Column, pattern: str, kind: int, tested: Column, least: int) -> Column:
    """Structs (start, kind, end) of the matches of ``pattern`` whose tested part is long enough.

    What lies between matches and the matches themselves alternate, so running sums of
    their lengths are the positions.
    """
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    steps = F.arrays_zip(
        F.slice(gaps, 1, F.size(matches)).alias("gap"), matches.alias("match"), tested.alias("part")
    )
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(state: Column, item: Column) -> Column:
        begin = state["at"] + item["gap"]
        end = begin + item["match"]
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        more = F.concat(state["found"], F.array(span))
        found = F.when(item["part"] >= least, more).otherwise(state["found"])
        return F.struct(end.alias("at"), found.alias("found"))

    def of_chunk(chunk: Column, at: Column) -> Column:
        return F.aggregate(chunk, F.struct(at.alias("at"), empty.alias("found")), step, lambda state: state["found"])

    def in_chunks(items: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _CHUNK).cast("int")),
            lambda i: F.slice(items, i * _CHUNK + 1, _CHUNK),
        )

    def whole(chunks: Column) -> Column:
        lengths = F.transform(
            chunks, lambda c: F.aggregate(c, F.lit(0), lambda at, item: at + item["gap"] + item["match"])
        )
        begins = F.aggregate(
            lengths, F.array(F.lit(0)), lambda at, n: F.concat(at, F.array(F.element_at(at, -1) + n))
        )
        return _bound(begins, lambda known: F.flatten(F.transform(chunks, lambda c, i: of_chunk(c, F.get(known, i)))))

    return _bound(
        steps,
        lambda items: F.when(F.size(items) <= _CHUNK, of_chunk(items, F.lit(0))).otherwise(
            _bound(in_chunks(items), whole)
        ),
    )


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _all_spans(text: Column, pattern: str, kind: int, least: int, group: str = "") -> Column:
    """As ``_spans``; ``group`` is what follows ``pattern`` where only that part is measured."""
    whole = pattern + group
    tested = F.transform(
        F.regexp_extract_all(text, F.lit(f"{pattern}({group})" if group else whole), F.lit(1 if group else 0)),
        F.length,
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    likely = f"{pattern}{group[:-1] if group else ''}" if group else whole[:-1]
    found = F.rlike(text, F.lit(f"{likely}{{{least}}}" if group else f"{likely}{{{max(1, least - _fixed(kind))}}}"))
    return F.when(found, _spans(text, whole, kind, tested, least)).otherwise(none)


def _fixed(kind: int) -> int:
    """Characters that a pattern matches before its repeated class."""
    return 4 if KINDS[kind] == "access" else 0


def base_spans(rules: SecretRules) -> dict[str, Column]:
    text = _text()
    return {
        "assign": _all_spans(text, ASSIGN, 0, rules.value_chars, VALUE),
        "access": _all_spans(text, ACCESS, 1, rules.access_chars),
        "hex": _all_spans(text, HEX, 2, rules.hex_chars),
    }


def _codes(token: Column) -> Column:
    return F.transform(F.split(token, ""), F.ascii)


def _transitions(samples: DataFrame) -> DataFrame:
    """(label, cell, n): how often one ASCII character follows another in each class."""
    codes = samples.where(F.length("token") > 1).select("label", _codes(F.col("token")).alias("c"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.size("c") - 2),
        lambda i: F.get("c", i) * _SIZE + F.get("c", i + 1),
    )
    return codes.select("label", F.explode(pairs).alias("cell")).groupBy("label", "cell").count()


def train_ratio(samples: DataFrame, rules: SecretRules = SecretRules()) -> list[float]:
    """Log-likelihood ratio (random over ordinary) of each transition, as a flat table.

    ``samples`` has token and label (1 random, 0 ordinary). The driver receives at most
    two counts per pair of ASCII characters.
    """
    letters = sorted(map(ord, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."))
    counts = {0: {}, 1: {}}
    for row in _transitions(samples).collect():
        counts[row["label"]][row["cell"]] = row["count"]
    table = [0.0] * (_SIZE * _SIZE)
    for a in letters:
        sums = {
            label: sum(counts[label].get(a * _SIZE + b, 0) for b in letters)
            + rules.smoothing * len(letters)
            for label in counts
        }
        for b in letters:
            cell = a * _SIZE + b
            log = [
                math.log((counts[label].get(cell, 0) + rules.smoothing) / sums[label])
                for label in (0, 1)
            ]
            table[cell] = round(log[1] - log[0], 6)
    return table


def labelled_samples(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """Tokens labelled 1 (random) and 0 (ordinary).

    Ordinary ones are the plain words of at most ``sample_documents`` documents, chosen by
    the hash of doc_id, runs of them joined as identifiers and paths are, and numbers,
    dates, versions and telephone numbers; random ones are base64 digests of counters.
    """
    keys = docs.where("text is not null and doc_id is not null").select(F.col("doc_id").alias("key"))
    few = keys.distinct().orderBy(F.xxhash64("key"), "key").limit(rules.sample_documents)
    chosen = docs.select("doc_id", "text").join(F.broadcast(few), F.col("doc_id") == F.col("key"))
    found = F.filter(F.regexp_extract_all("text", F.lit(r"[A-Za-z_-]{3,}"), F.lit(0)), lambda w: F.length(w) <= 64)
    words = chosen.select(found.alias("words")).where(F.size("words") > 0)
    # each word with the two behind it
    runs = words.select(
        "words",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("words")), lambda i: F.slice("words", i, 3))
        ).alias("run"),
    )
    lower = F.transform("run", lambda w: F.lower(w))
    ordinary = runs.select(
        F.explode(
            F.array(
                F.element_at("run", 1),
                F.array_join(lower, "_"),
                F.array_join("run", "/"),
                F.array_join(lower, "-"),
                F.array_join(F.transform(lower, lambda w: F.initcap(w)), ""),
            )
        ).alias("token"),
        F.lit(0).alias("label"),
    )
    numbers = docs.sparkSession.range(rules.random_strings).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("digest")
    )
    digits = F.concat(*(F.lpad(F.conv(F.substring("digest", at, 14), 16, 10), 17, "0") for at in (1, 15)))
    day = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), (F.col("id") * 4).cast("int")), "yyyy-MM-dd")
    part = lambda at, size: F.substring(digits, at, size)
    plain = numbers.select(
        F.explode(
            F.array(
                digits,
                F.concat_ws("_", F.lit("backup"), day, day),
                F.concat_ws("/", F.lit("data"), F.translate(day, "-", "/"), F.concat(F.lit("part-"), part(4, 5))),
                F.concat_ws("-", part(3, 3), part(6, 3), part(9, 4), part(13, 4), part(17, 4)),
                F.concat(F.lit("release-"), part(3, 1), F.lit("-"), part(5, 2), F.lit("-"), part(8, 1)),
            )
        ).alias("token"),
        F.lit(0).alias("label"),
    )
    coded = F.base64(F.unhex("digest"))
    safe = F.translate(coded, "+/=", "-_")
    upper = F.upper(F.regexp_replace(coded, "[^A-Za-z0-9]", ""))
    random = numbers.select(F.explode(F.array(coded, safe, coded, upper)).alias("token"), F.lit(1).alias("label"))
    return ordinary.union(plain).union(random)


def _random_spans(rules: SecretRules, ratio: list[float]) -> Column:
    text = _text()
    pattern = rf"[A-Za-z0-9+/_=-]{{{rules.token_chars},}}"
    model = F.from_json(F.lit(json.dumps(ratio)), "array<double>")

    def mean_ratio(token: Column) -> Column:
        start = F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("sum"))

        def step(state: Column, code: Column) -> Column:
            gain = F.when(state["last"] < 0, F.lit(0.0)).otherwise(
                F.get(model, state["last"] * _SIZE + code)
            )
            return F.struct(code.alias("last"), (state["sum"] + gain).alias("sum"))

        total = F.aggregate(_codes(token), start, step, lambda state: state["sum"])
        return total / (F.length(token) - 1)

    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tested = F.transform(
        tokens, lambda t: F.when(~F.rlike(t, F.lit(UUID)) & (mean_ratio(t) >= rules.ratio), 1).otherwise(0)
    )
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return F.when(F.rlike(text, F.lit(pattern)), _spans(text, pattern, 3, tested, 1)).otherwise(none)


def with_spans(docs: DataFrame, ratio: list[float], rules: SecretRules = SecretRules()) -> DataFrame:
    """All columns of ``docs`` as a struct ``row``, and the spans by kind and together."""
    base = base_spans(rules)
    spans = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in docs.columns)).alias("row"),
        *(column.alias(f"{name}_spans") for name, column in base.items()),
        _random_spans(rules, ratio).alias("likely"),
    ).withColumn(
        "base_spans", F.array_sort(F.concat("assign_spans", "access_spans", "hex_spans"))
    )
    free = F.filter(
        "likely",
        lambda s: ~F.exists(
            "base_spans", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])
        ),
    )
    return spans.withColumn("all_spans", F.array_sort(F.concat("base_spans", free)))


def written(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])
        ),
        ",",
    )


def scan_secrets(docs: DataFrame, rules: SecretRules = SecretRules()) -> DataFrame:
    """One row per document with the counts, digest and list of its spans."""
    ratio = train_ratio(labelled_samples(docs, rules), rules)
    found = with_spans(docs.select(F.col("doc_id").cast("long"), "text"), ratio, rules)
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.size("assign_spans").cast("long").alias("n_assign"),
        F.size("access_spans").cast("long").alias("n_access"),
        F.size("hex_spans").cast("long").alias("n_hex"),
        F.sha2(written("base_spans"), 256).alias("base_sha256"),
        written("all_spans").alias("spans"),
    )


def redact_secrets(
    docs: DataFrame, rules: SecretRules = SecretRules(), mark: str = "[SECRET]"
) -> DataFrame:
    """The documents with every span replaced by ``mark``; n_chars follows the text."""
    ratio = train_ratio(labelled_samples(docs, rules), rules)
    found = with_spans(docs, ratio, rules)
    text = F.col("row.text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state: Column, span: Column) -> Column:
        # overlapping spans leave one mark
        gap = span["start"] - state["at"]
        piece = F.when(
            gap >= 0, F.concat(F.substring(text, state["at"] + 1, gap), F.lit(mark))
        ).otherwise(F.lit(""))
        return F.struct(
            F.greatest(state["at"], span["end"]).alias("at"),
            F.concat(state["out"], piece).alias("out"),
        )

    clean = F.aggregate(
        "all_spans",
        start,
        step,
        lambda s: F.concat(s["out"], F.substring(text, s["at"] + 1, F.length(text))),
    )
    new_text = F.when(F.size("all_spans") > 0, clean).otherwise(text)
    changed = {"text": new_text}
    if "n_chars" in docs.columns:
        length = F.length(new_text).cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(F.size("all_spans") > 0, length).otherwise(F.col("row.n_chars"))
    return found.select(
        *(changed.get(name, F.col("row").getField(name)).alias(name) for name in docs.columns)
    )
