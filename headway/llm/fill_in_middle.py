"""Fill-in-middle transformation with a sparse exception index.

A text is cut in three; the middle moves to the end behind marks, in the order
prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``). Cuts fall
between tokens (leading white space and a word, or trailing white space) or
between characters.

Texts stay UTF-8 bytes. Token cuts are found as byte positions and reported as
code points, character cuts the other way round: ``ExceptionIndex`` records the
multibyte characters alone, their positions and excess bytes, and a binary
search counts those before a cut; stretches of ASCII cost nothing but a
subtraction.

Null or empty texts, and texts that hold a mark themselves, stay as they are
(``plain``). A null doc_id draws as an empty one. Rows are independent: repeated
rows give repeated results, other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from headway.llm.kernels import SPACES, slices, utf8
from headway.llm.staging import bounded_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"
_IS_SPACE = np.isin(np.arange(256), SPACES)


class ExceptionIndex:
    """Multibyte characters of some UTF-8 bytes: where they start, and their bytes beyond one, summed."""

    def __init__(self, data: np.ndarray):
        self.at = np.flatnonzero(data >= 0xC0)
        lead = data[self.at]
        excess = 1 + (lead >= 0xE0).astype(np.int64) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess)))
        self.characters = self.at - self.excess[:-1]

    def to_characters(self, position: np.ndarray) -> np.ndarray:
        """Code points before byte positions that start a character."""
        return position - self.excess[np.searchsorted(self.at, position)]

    def to_bytes(self, position: np.ndarray) -> np.ndarray:
        """Byte positions of code-point positions."""
        return position + self.excess[np.searchsorted(self.characters, position)]


def token_ends(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ends of the tokens of texts that lie end to end between ``bounds``."""
    if not len(data):
        return np.empty(0, np.int64)
    space = _IS_SPACE[data]
    ends = np.zeros(len(data) + 1, bool)
    ends[1:-1] = ~space[:-1] & space[1:]
    ends[bounds[1:][np.diff(bounds) > 0]] = True
    return np.flatnonzero(ends)


def _cuts(units: np.ndarray, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first, second = h1 % (units + 1), h2 % (units + 1)
    return np.minimum(first, second), np.maximum(first, second)


def _transformer(rate: int, suffix_first: int, characters: bool):
    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = utf8(batch.column(1))
            draws = [batch.column(2 + k).to_numpy() for k in range(4)]
            for first, last in slices(bounds):
                own = bounds[first : last + 1] - bounds[first]
                part = data[bounds[first] : bounds[last]]
                h1, h2, h3, h4 = (h[first:last] for h in draws)
                index = ExceptionIndex(part)
                if characters:
                    start = index.to_characters(own)
                    n = np.diff(start)
                    low, high = (index.to_bytes(start[:-1] + c) for c in _cuts(n, h1, h2))
                else:
                    ends = np.concatenate(([0], token_ends(part, own)))
                    before = np.searchsorted(ends, own, "right") - 1
                    n = np.diff(before)
                    low, high = (np.maximum(ends[before[:-1] + c], own[:-1]) for c in _cuts(n, h1, h2))
                at = [index.to_characters(p) for p in (own[:-1], low, high)]
                forms, outputs = [], []
                raw = part.tobytes()
                for k in range(last - first):
                    a, b, c, d = own[k], low[k], high[k], own[k + 1]
                    text = raw[a:d]
                    if a == d or h3[k] % 100 >= rate or any(m in text for m in (PREFIX, SUFFIX, MIDDLE)):
                        forms.append(PLAIN)
                        outputs.append(text)
                    elif h4[k] % 100 < suffix_first:
                        forms.append(SPM)
                        outputs.append(b"".join((SUFFIX, raw[c:d], PREFIX, raw[a:b], MIDDLE, raw[b:c])))
                    else:
                        forms.append(PSM)
                        outputs.append(b"".join((PREFIX, raw[a:b], SUFFIX, raw[c:d], MIDDLE, raw[b:c])))
                plain = np.array([f == PLAIN for f in forms])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(n),
                        pa.array(forms, pa.string()),
                        pa.array(at[1] - at[0], mask=plain),
                        pa.array(at[2] - at[1], mask=plain),
                        pa.array(outputs, pa.binary()),
                    ],
                    names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return transform


def draws(seed: int, doc_id: Column) -> list[Column]:
    """Four numbers that depend on seed and id alone: the first digit groups of a digest."""
    identity = F.coalesce(doc_id.cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), identity).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]


def fill_in_middle(
    docs: DataFrame, seed: int = 42, rate: int = 50, suffix_first: int = 80, characters: bool = False
) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and the ``output`` text of every row.

    ``rate`` per cent of the texts are transformed, ``suffix_first`` per cent of
    those as ``spm``. Units are tokens, or code points if ``characters``.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").alias("doc_id"), F.col("text").alias("text"), *draws(seed, F.col("doc_id")))
    out = rows.mapInArrow(
        _transformer(rate, suffix_first, characters),
        "doc_id long, n long, form string, prefix_chars long, middle_chars long, output binary",
    )
    return out.withColumn("output", F.col("output").cast("string"))


def restored(form: Column, output: Column) -> Column:
    """The text an output was made from. Marks stand only where they were put, so splitting finds the parts."""
    body = F.substr(output, F.lit(len(PREFIX) + 1))
    psm = F.split(body, f"{SUFFIX.decode()}|{MIDDLE.decode()}", -1)
    spm = F.split(body, f"{PREFIX.decode()}|{MIDDLE.decode()}", -1)
    return (
        F.when(form == PSM, F.concat(psm[0], psm[2], psm[1]))
        .when(form == SPM, F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )


def digests(rows: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with digests of the output and of the text rebuilt from it, in place of the output."""
    back = restored(F.col("form"), F.col("output"))
    return rows.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
        F.sha2(back.cast("binary"), 256).alias("restored_sha256"),
    )


ORACLE_SQL = r"""
WITH drawn AS (
    SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
    FROM documents
),
cut AS (
    SELECT doc_id, t, units, len(units) AS n,
           ('0x' || d[1:8])::BIGINT % (len(units) + 1) AS a, ('0x' || d[9:16])::BIGINT % (len(units) + 1) AS b,
           CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                     OR ('0x' || d[17:24])::BIGINT % 100 >= 50 THEN 'plain'
                WHEN ('0x' || d[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
),
parts AS (
    SELECT doc_id, t, n, form,
           array_to_string(units[1:least(a, b)], '') AS prefix,
           array_to_string(units[least(a, b) + 1:greatest(a, b)], '') AS middle,
           array_to_string(units[greatest(a, b) + 1:], '') AS suffix
    FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
