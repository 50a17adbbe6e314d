"""Dense features of whole texts, computed chunk by chunk in Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyframe.llm.textvec import CHUNK_BYTES, Words, chunks, multiset

#: Bytes by kind; every other byte (letters of any script, above all) has kind 0.
KINDS = {"upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "symbol": b"#*$%&|<>@_=+~^{}[]\\/", "exclaim": b"!", "stop": b".?",
         "comma": b",;:", "digit": b"0123456789", "blank": b" \t\r\x0b\x0c", "line": b"\n"}
_KIND = np.zeros(256, np.uint8)
for _k, _b in enumerate(KINDS.values(), 1):
    _KIND[list(_b)] = _k

NAMES = ["log_words", "word_length", "upper", "symbol", "exclaim", "stop", "comma", "digit", "blank", "line",
         "symbol_per_word", "exclaim_per_word", "stop_per_word", "distinct", "same_as_last", "repeated_windows", "top_word", "empty"]


def dense(words: Words) -> np.ndarray:
    """One row of features per text; all are bounded, an empty text is zero but for ``empty``."""
    n, size = words.count.astype(float), np.diff(words.offsets).astype(float)
    row = np.repeat(np.arange(words.rows), np.diff(words.offsets))
    kinds = np.bincount(row * 16 + _KIND[words.data], minlength=16 * words.rows).reshape(-1, 16)[:, 1:len(KINDS) + 1]
    one = np.maximum(n, 1)
    share = kinds / np.maximum(size, 1)[:, None]
    first = np.zeros(len(words.hash), bool)
    first[words.at[:-1][words.count > 0]] = True
    same = np.append(False, words.hash[1:] == words.hash[:-1]) & ~first if len(words.hash) else first
    _, word_row, times = multiset(words.hash, words.row)
    top = np.zeros(words.rows)
    np.maximum.at(top, word_row, times.astype(float))
    h, window_row, _ = words.shingles(3)
    _, distinct_row, _ = multiset(h, window_row)
    windows, kinds_of = np.bincount(window_row, minlength=words.rows), np.bincount(distinct_row, minlength=words.rows)
    per_word = lambda k: np.minimum(kinds[:, list(KINDS).index(k)] / one, 4.0)
    length = np.bincount(words.row, (words.end - words.begin).astype(float), minlength=words.rows) / one
    return np.column_stack([
        np.log1p(n), np.minimum(length, 40.0), share,
        per_word("symbol"), per_word("exclaim"), per_word("stop"),
        np.bincount(word_row, minlength=words.rows) / one,
        np.bincount(words.row, same.astype(float), minlength=words.rows) / one,
        1 - kinds_of / np.maximum(windows, 1) * (windows > 0) - (windows == 0),
        top / one * (n >= 20), n == 0,
    ])


def map_texts(docs: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, size: int = CHUNK_BYTES) -> DataFrame:
    """``fn`` on chunks of about ``size`` bytes of text each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, size):
                yield fn(part)

    return docs.mapInArrow(run, schema)


def list_column(values: np.ndarray) -> pa.Array:
    """Rows of a matrix as Arrow lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)), pa.array(values.ravel()))


def featured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``x``, the dense features of ``text``."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields if f.name in keep)

    def fn(part: pa.RecordBatch) -> pa.RecordBatch:
        x = dense(Words(part.column("text"), lower=False))
        return pa.RecordBatch.from_arrays([*[part.column(c) for c in keep], list_column(x)], names=[*keep, "x"])

    return map_texts(docs.select(*keep, "text"), fn, f"{fields}, x array<double>")


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

