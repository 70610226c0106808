"""Token ids and token counts as public tokenizers give them. Tokenizer files are read on each worker.

`token_counts` is the whole-token shortcut. Which vocabulary strings encode alone as one token is proved once from the
model file, by encoding each of them; a stretch that is such a string counts as one token without a look at the merge table. Only
the rest is merged, by the library. Results for short stretches are kept for the next time they occur; what is kept is bounded and
starts over when it is full. Whole texts are counted; null counts as empty. Repeated rows stay repeated, other columns are
not read, an empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import over_batches

#: Stretches whose tokens are remembered, and the longest that is.
KEPT, LONGEST = 300_000, 64

class ByteLevel:
    """Ids of a byte-level BPE as the library `tokenizers` gives them for its file.

    For plain texts the same merges run in `tiktoken`, several times as fast. That
    is sound if the file has the usual byte-level pattern and its merges make ids in rising
    order, which is proved from the file, and if both pattern engines class all
    characters of the text alike: true of those assigned for decades (tests compare
    them one by one). Texts with other characters or with a special token's string,
    and other kinds of files, go to `tokenizers` itself.
    """

    #: A character that is not Latin, spacing modifier, Greek or Cyrillic base letter, or common punctuation.
    OTHER = re.compile("[^\x00-\u02af\u0391-\u03a1\u03a3-\u03ce\u0400-\u045f\u2010-\u2027\u2030-\u205e\u20ac]")
    PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

    def __init__(self, path: str) -> None:
        self.path = path
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        self.special = [t["content"] for t in said["added_tokens"]]
        self.fast = self.same_merges(said)

    def same_merges(self, said: dict):
        """The file's vocabulary as an encoding of `tiktoken`, if both must merge alike; else nothing."""
        import tiktoken

        before, model = said["pre_tokenizer"] or {}, said["model"]
        usual = (
            said["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)
            and not before["add_prefix_space"] and model["type"] == "BPE" and not model.get("dropout")
        )
        if not usual:
            return None
        vocabulary = model["vocab"]
        parts = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [vocabulary[a + b] for a, b in parts]
        singles = {t for t in vocabulary if len(t) == 1}
        if made != sorted(set(made)) or len(singles) != 256 or len(made) + 256 != len(vocabulary.keys() - set(self.special)):
            return None
        byte = byte_of()
        ranks = {bytes(byte[c] for c in t): i for t, i in vocabulary.items() if t not in self.special}
        return tiktoken.Encoding("file", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @cached_property
    def library(self):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)  # loaded by the first text that needs it

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text, without added special tokens."""
        if self.fast is None or self.OTHER.search(text) or any(s in text for s in self.special):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype("<u4", copy=False).tobytes()


def byte_of() -> dict[str, int]:
    """The printable character that such files write for each byte, the other way round."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Pieces:
    """Counts of a sentencepiece model: blanks and the word after them are one stretch, a line end another.

    Safe when no piece has the blank mark behind another character and none
    has a line end, which is proved from the vocabulary; else whole texts go to
    the library.
    """

    MARK = "▁"
    STRETCH = re.compile(f"[ {MARK}]+[^ {MARK}\n]*|[^ {MARK}\n]+|\n")

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        count, mark = self.library.get_piece_size(), self.MARK
        pieces = [
            self.library.id_to_piece(i) for i in range(count)
            if not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_byte(i))
        ]
        self.line = len(self.encode("\n"))
        self.cuts = (
            not any("\n" in p or re.search(f"[^{mark}]{mark}", p) for p in pieces)
            and self.encode("a  b\n c") == self.encode("a") + self.encode(" b") + self.encode("\n")[1:] + self.encode("c")
            and self.encode("") == []
        )
        #: Strings that encode alone as one token, with the blank mark written as a blank too.
        self.proved: dict[str, int] = {}
        if self.cuts:
            for piece in pieces:
                if self.alone(piece) == 1:
                    self.proved[piece] = self.proved[piece.replace(mark, " ")] = 1
        self.kept: dict[str, int] = {}

    def encode(self, text: str) -> list[int]:
        return self.library.encode(text)

    def alone(self, stretch: str) -> int:
        """Tokens of a stretch: the library puts a mark before every text, so one with a mark gives it up first,
        and one without goes behind a line end, whose tokens are taken off."""
        if stretch[0] in (" ", self.MARK):
            return len(self.encode(stretch[1:])) if len(stretch) > 1 else 1
        return len(self.encode("\n" + stretch)) - self.line

    def count(self, text: str) -> int:
        if not text:
            return 0
        if not self.cuts:
            return len(self.encode(text))
        proved, kept, total = self.proved, self.kept, 0
        found = self.STRETCH.findall(self.MARK + text)
        counts = list(map(proved.get, found))
        for at, known in enumerate(counts):
            if known is None:
                stretch = found[at]
                known = kept.get(stretch)
                if known is None:
                    known = self.line - 1 if stretch == "\n" else self.alone(stretch)
                    if len(stretch) <= LONGEST:
                        if len(kept) >= KEPT:
                            kept.clear()
                        kept[stretch] = known
            total += known
        return total


@cache
def byte_level(path: str) -> ByteLevel:
    return ByteLevel(path)


@cache
def pieces(path: str) -> Pieces:
    return Pieces(path)


def token_counts(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes (of UTF-8), n_tokens."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterator[dict]:
        count = pieces(model).count
        numbers = [count(t.as_py()) for t in batch.column(1)]
        yield {"id": batch.column(0), "n_bytes": batch.column(2), "n_tokens": numbers}

    text = F.coalesce(F.col(text_col), F.lit("")).alias("t")
    given = docs.select(F.col(id_col).alias("id"), text, F.octet_length(text).cast("long").alias("n_bytes"))
    return over_batches(given, run, f"id {kind}, n_bytes long, n_tokens long")
