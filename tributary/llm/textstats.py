"""Statistics of whole texts, and labelled samples of them for the two rule learners.

Counts are over words (runs without blanks and control characters 9 to 13) and lines (split at line ends). Null text counts as empty,
whose counts are all 0. Ratios over nothing are 0. Repeated rows stay repeated; the columns given to `with_stats` are kept, and a column that
has the name of a statistic is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tributary.llm.common import fold_bucket, hash_sample, utf8
from tributary.session import share_code

SYMBOLS = b"#*$%&|<>"
CAPITALS = bytes(range(65, 91))
#: Bytes that are no first byte of a character in a word: blanks and UTF-8 continuation bytes.
NOT_COUNTED = b" \t\n\x0b\x0c\r" + bytes(range(0x80, 0xC0))
WINDOW = 5

COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_distinct", "n_capitals", "n_marks", "n_digits", "top_words",
]

#: Feature: (count, what it is divided by).
RATIOS = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeat_words": ("n_repeat_words", "n_words"),
    "distinct_words": ("n_distinct", "n_words"),
    "capitals": ("n_capitals", "word_chars"),
    "marks_per_word": ("n_marks", "n_words"),
    "digits": ("n_digits", "word_chars"),
    "top_word": ("top_words", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}


def repeated(ids: np.ndarray, kinds: int, size: int = WINDOW) -> int:
    """Words in windows of `size` words that occur twice or more; ids are below `kinds`. Exact: no hashes."""
    if len(ids) <= size:
        return 0
    key, most = ids.astype(np.int64), kinds
    for k in range(1, size):
        if most * kinds >= 1 << 62:
            found, key = np.unique(key, return_inverse=True)
            most = len(found)
        key = key[:-1] * kinds + ids[k:]
        most *= kinds
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
    hit, start = np.zeros(len(ids), bool), twice[at] == key
    for k in range(size):
        hit[k : k + len(start)] |= start
    return int(hit.sum())


def stats(text: bytes) -> tuple[int, ...]:
    """The values of COUNTS."""
    words = text.split()
    if not words:
        return (0, 0, without(text, SYMBOLS), 0, 0, 0, 0, 0, 0, 0, 0)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    return (
        len(words), len(text.translate(None, NOT_COUNTED)), without(text, SYMBOLS), len(lines) - len(set(lines)),
        repeated(ids, len(number)), len(lines), len(number), without(text, CAPITALS), text.count(b"!") + text.count(b"?"),
        without(text, b"0123456789"), int(np.bincount(ids).max()),
    )


def without(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


class Measure:
    """Passes the rows on, with the counts of their last column in its place."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                found = np.array([stats(t.as_py()) for t in batch.column(batch.num_columns - 1)], np.int64)
                counts = [pa.array(found[:, k]) for k in range(len(COUNTS))]
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts], schema=self.schema)
                del batch, counts
                pa.default_memory_pool().release_unused()


def with_stats(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The rows with their counts; `keep` names the columns to keep (all)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    share_code(docs.sparkSession)
    columns = [c for c in (docs.columns if keep is None else keep) if c not in COUNTS]
    given = docs.select(*[F.col(f"`{c}`") for c in columns], utf8(text_col).alias("_t"))
    schema = StructType(given.schema.fields[:-1] + [StructField(c, LongType()) for c in COUNTS])
    return given.mapInArrow(Measure(to_arrow_schema(schema)), schema)


def feature(name: str) -> Column:
    """The Spark side of a feature."""
    top, below = RATIOS[name]
    if below is None:
        return F.col(top).cast("double")
    return F.when(F.col(below) == 0, F.lit(0.0)).otherwise(F.col(top).cast("double") / F.col(below))


def features(counts: np.ndarray) -> np.ndarray:
    """The numpy side: the same numbers, a column per feature."""
    at = {n: counts[:, k].astype(float) for k, n in enumerate(COUNTS)}
    out = []
    for top, below in RATIOS.values():
        if below is None:
            out.append(at[top])
        else:
            out.append(np.divide(at[top], at[below], out=np.zeros(len(counts)), where=at[below] != 0))
    return np.stack(out, axis=1)


def sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, folds: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of at most `rows` labelled rows of the training folds: those with the smallest hash.

    Rows whose crc32(id as text) mod `folds` is 0 are held out. At most `rows`
    ids are broadcast and as many rows of counts collected.
    """
    usable = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & (fold_bucket(id_col, folds) != 0))
    chosen = hash_sample(usable.select(F.col(id_col).alias("_id"), F.col(label).cast("int").alias("_label")), rows)
    found = docs.select(F.col(id_col).alias("_id"), text_col).join(F.broadcast(chosen), "_id")
    table = with_stats(found, text_col, ["_id", "_label"])
    # copies of a document in `docs` may add rows; the same rule bounds them
    got = table.orderBy(F.xxhash64("_id"), "_id", "_label", *COUNTS).limit(rows).select("_label", *COUNTS).toPandas().to_numpy(np.int64)
    return features(got[:, 1:]), got[:, 0]


def cuts(column: np.ndarray, most: int = 64) -> np.ndarray:
    """Thresholds between neighbouring values, at quantiles if there are more than `most`."""
    values = np.unique(column)
    if len(values) > most:
        values = np.unique(np.quantile(column, np.linspace(0, 1, most + 1), method="nearest"))
    return (values[1:] + values[:-1]) / 2


#: A condition is (feature number, True for at most / False for above, threshold).
Condition = tuple[int, bool, float]


def holds(x: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for f, below, at in rule:
        out &= (x[:, f] <= at) if below else (x[:, f] > at)
    return out


def as_column(rule: tuple[Condition, ...]) -> Column:
    """A conjunction as a Spark condition."""
    names, out = list(RATIOS), F.lit(True)
    for f, below, at in rule:
        value = feature(names[f])
        out = out & ((value <= F.lit(float(at))) if below else (value > F.lit(float(at))))
    return out


def as_text(rule: tuple[Condition, ...]) -> str:
    names = list(RATIOS)
    return " and ".join(f"{names[f]} {'<=' if below else '>'} {at:.6g}" for f, below, at in rule)
