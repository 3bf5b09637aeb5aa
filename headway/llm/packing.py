"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

Documents are tokenised where they are read; only piece lengths travel. Pieces
are dealt by hash into groups of bounded size, each with the same mix of
lengths, and every group is packed on its own, so packing has no single task and
wastes less than one sequence per group. Inside a group a sequence is filled
greedily with the longest piece that fits; what gap is left is then tried with
its smallest piece taken out and two unpacked pieces put in that fit more tightly.

Null texts count as empty; a null ``doc_id`` is carried along. Repeated rows are
packed once each. An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from headway.llm.staging import bounded_batches, staged

CAPACITY = 2048
GROUP_PIECES = 50_000
CACHE_ENTRIES = 300_000
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: The vocabulary's own splitting rule.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of ASCII without information separators, Latin letters and common punctuation can take the same rule in ``re``.
LETTERS = "A-Za-zµÀ-ÖØ-öø-ɏ"
PLAIN_SPLIT = re.compile(rf" ?[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{LETTERS}0-9]+|\s+(?!\S)|\s+")
NOT_PLAIN = re.compile(f"[^\x00-\x1b\x20-\x7e{LETTERS}¡-©«-±´¶-¸»¿×÷‐-‧€]")


def _byte_letters() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies use for bytes."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}


class ByteBpe(dict):
    """Token ids, as little-endian 32-bit bytes, of a vocabulary file of the ``tokenizers`` library.

    A dictionary from split word to the bytes of its ids, filled as words come
    and emptied when full. ``ids`` takes added tokens in a text as ordinary text,
    ``document_ids`` gives them their own ids, as the library does by default.
    """

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocabulary, added = content["model"]["vocab"], content.get("added_tokens", [])
        if any(token[option] for token in added for option in ("single_word", "lstrip", "rstrip")):
            raise ValueError("added tokens with options are not supported")
        self.added = {token["content"]: array("I", [token["id"]]).tobytes() for token in added}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile(f"({'|'.join(map(re.escape, longest_first))})" if added else r"(?!)")
        letters = _byte_letters()
        ranks = {
            bytes(letters[c] for c in token): rank
            for token, rank in vocabulary.items()
            if all(c in letters for c in token) and not token.startswith("<|")
        }
        self.encoding = tiktoken.Encoding("bytes", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, word: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        ids = array("I", self.encoding.encode_ordinary(word)).tobytes()
        if len(word) <= 40:
            self[word] = ids
        return ids

    def ids(self, text: str) -> bytes:
        if NOT_PLAIN.search(text):
            return array("I", self.encoding.encode_ordinary(text)).tobytes()
        return b"".join(map(self.__getitem__, PLAIN_SPLIT.findall(text)))

    def document_ids(self, text: str) -> bytes:
        """The ids of a document's text; added tokens cut it, and each part is split by itself."""
        if not self.at_added.search(text):
            return self.ids(text)
        return b"".join(self.added.get(part) or self.ids(part) for part in self.at_added.split(text) if part)


def pieces(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and the closing id 0, cut where longer than ``capacity``.

    The rest of a cut document is its first piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(vocabulary)
        for batch in batches:
            rows, piece, start, length, crc = [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                ids = bpe.document_ids(text.as_py() or "") + b"\0\0\0\0"
                n = len(ids) // 4
                first = n % capacity or capacity
                for k, (a, b) in enumerate(zip([0, *range(first, n, capacity)], range(first, n + 1, capacity))):
                    rows.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(memoryview(ids)[4 * a : 4 * b]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return narrow.mapInArrow(cut, PIECE_SCHEMA)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece. Which lengths are left is one bit each in an integer."""
    order = np.argsort(lengths, kind="stable")
    sizes, firsts = np.unique(lengths[order], return_index=True)
    left = dict(zip(sizes.tolist(), map(np.ndarray.tolist, np.split(order, firsts[1:]))))
    mask = sum(1 << size for size in left)
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)

    def largest(limit: int) -> int:
        return (mask & ((2 << limit) - 1)).bit_length() - 1 if limit > 0 else -1

    def take(size: int) -> int:
        nonlocal mask
        pile = left[size]
        index = pile.pop()
        if not pile:
            mask ^= 1 << size
        return index

    def give(size: int, index: int) -> None:
        nonlocal mask
        left[size].append(index)
        mask |= 1 << size

    def two_for(limit: int, least: int) -> tuple[int, int] | None:
        """The two sizes left with the largest sum above ``least`` that ``limit`` holds."""
        best, found = least, None
        a = largest(limit)
        while a > 0 and 2 * a > best:
            b = largest(min(a, limit - a))
            if b == a and len(left[a]) < 2:
                b = largest(min(a - 1, limit - a))
            if b > 0 and a + b > best:
                best, found = a + b, (a, b)
                if best == limit:
                    break
            a = largest(a - 1)
        return found

    number = 0
    while mask:
        held, gap = [], capacity
        while (size := largest(gap)) > 0:
            held.append((size, take(size)))
            gap -= size
        if gap and mask:
            smallest = min(held)
            if pair := two_for(gap + smallest[0], smallest[0]):
                held.remove(smallest)
                held += [(size, take(size)) for size in pair]
                give(*smallest)
        at = 0
        for size, index in held:
            bins[index], offsets[index] = number, at
            at += size
        number += 1
    return bins, offsets


def packed(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``sequence_id`` and ``offset`` for every row of a written table of pieces."""
    groups = max(1, -(-cut.count() // group_pieces))
    # the row number keeps rows that repeat from meeting in one group
    dealt = cut.withColumn(
        "bin_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups))
    )

    def pack(table: pa.Table) -> pa.Table:
        bins, offsets = best_two_fit(table.column("length").to_numpy(), capacity)
        group = table.column("bin_group")[0].as_py()
        out = table.drop_columns(["bin_group"])
        out = out.append_column("sequence_id", pa.array(bins + (group << 32), pa.int64()))
        return out.append_column("offset", pa.array(offsets, pa.int64()))

    return dealt.groupBy("bin_group").applyInArrow(pack, PIECE_SCHEMA + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece with its place in a sequence of at most ``capacity`` ids."""
    bounded_batches(docs.sparkSession)
    return packed(staged(pieces(docs, vocabulary, capacity)), capacity)
