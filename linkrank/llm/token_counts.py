"""Token counts: encode in Arrow batches, return lengths only.

Texts are cut where the pre-tokenizer cuts anyway (see ``units``), so the sum
over the units is the count of the whole; no token, white space run or special
string crosses such a place. Only units that a task has not met yet are
encoded: joined to encoder calls of about ``call_bytes``, so that a call holds
many short units or one long one, and told apart again by the bytes of their
tokens. The table of known units is bounded and starts anew when it is full.

Files of other tokenizers are encoded text by text, in calls of the same size.
"""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkrank.llm.units import Bounded, slices, units

CALL_BYTES = 262_144
TOKEN_LIMIT = 512


def calls(sizes: list[int], call_bytes: int) -> Iterator[slice]:
    """Slices of about ``call_bytes`` in all, at least one entry in each."""
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > call_bytes:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def byte_level_entries(path: str) -> list[bytes | None]:
    """The bytes of each id of a byte-level .json vocabulary; added strings count as they stand."""
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    added = {t["id"]: t["content"].encode() for t in content["added_tokens"]}
    alphabet = byte_alphabet()
    entries: list[bytes | None] = [None] * (max([*content["model"]["vocab"].values(), *added]) + 1)
    for entry, i in content["model"]["vocab"].items():
        entries[i] = added.get(i) or bytes(alphabet[c] for c in entry)
    for i, own in added.items():
        entries[i] = own
    return entries


def cuts_at_blanks(path: str) -> bool:
    """Whether a file is a byte-level .json one that leaves texts as they are, so that units may be encoded one by one."""
    if not path.endswith(".json"):
        return False
    with open(path, encoding="utf-8") as file:
        content = json.load(file)
    before = content.get("pre_tokenizer") or {}
    plain = not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or " " in t["content"] for t in content["added_tokens"])
    return (
        content.get("normalizer") is None
        and before.get("type") == "ByteLevel"
        and not before.get("add_prefix_space")
        and before.get("use_regex", True)
        and content["model"].get("type") in (None, "BPE")
        and plain
    )


def json_tokenizer(path: str):
    """The library's tokenizer for a .json file, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark has one worker for each core already
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encode(tokenizer) -> Callable[[list[str]], list[list[int]]]:
    encode = getattr(tokenizer, "encode_batch_fast", tokenizer.encode_batch)
    return lambda texts: [e.ids for e in encode(texts, add_special_tokens=False)]


class UnitCounter:
    """Counts texts by units, with a bounded table of the units met so far."""

    def __init__(self, path: str, call_bytes: int = CALL_BYTES, table_bytes: int | None = None) -> None:
        self.encode = _encode(json_tokenizer(path))
        self.length = np.array([len(e) if e is not None else 0 for e in byte_level_entries(path)], np.int64)
        self.call_bytes, self.table_bytes = call_bytes, table_bytes
        self.known: dict[str, int] = {}
        self.bound = Bounded(table_bytes)

    def _learn(self, keys: list[str]) -> None:
        """Counts of units that open with a blank, from joined ones. Those that end in white space are encoded alone."""
        alone = [k for k in keys if not k or k[-1].isspace()]
        joined = [k for k in keys if k and not k[-1].isspace()]
        sizes = [len(k.encode()) + 1 for k in joined]
        for part in calls(sizes, self.call_bytes):
            ends = np.cumsum(sizes[part])
            (ids,) = self.encode(["".join([" " + k for k in joined[part]])])
            upto = np.cumsum(self.length[ids])
            at = np.searchsorted(upto, ends)
            if len(upto) and upto[-1] == ends[-1] and (upto[at] == ends).all():
                self.known.update(zip(joined[part], np.diff(at, prepend=-1).tolist(), strict=True))
            else:
                alone += joined[part]
        for part in calls([len(k) for k in alone], self.call_bytes):
            found = self.encode([" " + k for k in alone[part]])
            self.known.update((k, len(ids)) for k, ids in zip(alone[part], found, strict=True))
        self.bound.add(keys)

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text; null and empty ones have none."""
        found: list[int] = []
        for some in slices(texts):
            if self.bound.full():
                self.known, self.bound = {}, Bounded(self.table_bytes)
            rows = [units(t) if t else [""] for t in texts[some]]
            missing = set().union(*[r[1:] for r in rows]).difference(self.known)
            self._learn(list(missing))
            first = self._whole([r[0] for r in rows])
            get = self.known.__getitem__
            found += [n + sum(map(get, r[1:])) for n, r in zip(first, rows, strict=True)]
        return found

    def _whole(self, texts: list[str]) -> list[int]:
        return [len(ids) for part in calls([len(t) for t in texts], self.call_bytes) for ids in self.encode(texts[part])]


class TextCounter:
    """Counts texts one by one, by the library for the file."""

    def __init__(self, path: str, call_bytes: int = CALL_BYTES) -> None:
        self.call_bytes = call_bytes
        if path.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda texts: processor.encode(texts, num_threads=1)
        else:
            self.encode = _encode(json_tokenizer(path))

    def counts(self, texts: list[str | None]) -> list[int]:
        whole = [t or "" for t in texts]
        return [len(ids) for part in calls([len(t) for t in whole], self.call_bytes) for ids in self.encode(whole[part])]


def token_count(text: Column, tokenizer_path: str, call_bytes: int = CALL_BYTES, table_bytes: int | None = None) -> Column:
    """Number of tokens of a text column as a long; null and empty count 0.

    ``tokenizer_path`` names the vocabulary file on every machine.
    ``table_bytes`` bounds the table of units that a task keeps.
    """

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = UnitCounter(tokenizer_path, call_bytes, table_bytes) if cuts_at_blanks(tokenizer_path) else TextCounter(tokenizer_path, call_bytes)
        for batch in batches:
            yield pa.array(counter.counts(batch.to_pylist()), pa.int64())

    return count(text)


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = TOKEN_LIMIT, **options) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs``.

    Null and empty texts have 0 bytes and 0 tokens; texts of any length are
    counted whole; repeated rows and null ids are kept as they are; other
    columns, whatever their names, are ignored; an empty table gives no rows.
    """
    counted = docs.select(
        "doc_id",
        F.coalesce(F.octet_length("text").cast("long"), F.lit(0)).alias("n_bytes"),
        token_count(F.col("text"), tokenizer_path, **options).alias("n_tokens"),
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
