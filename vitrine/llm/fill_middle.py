"""Fill-in-the-middle: texts cut at line ends into prefix, middle and suffix, and put together in another order.

Where a cut lies is asked of a learned index: straight segments, each fitted to
as many line ends as it meets within a stated error, predict the byte offset of
the line end with a given rank; the stored difference makes the answer exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.llm.words import blocks, text_bytes

BLOCK = 1 << 20
# The marks in front of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RESULT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


@dataclass
class RankIndex:
    """Segments by their first rank, and what each prediction lacks."""

    firsts: np.ndarray
    bases: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.firsts, ranks, side="right") - 1
        return self.bases[segment] + np.rint(self.slopes[segment] * (ranks - self.firsts[segment])).astype(np.int64)

    def offset(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residuals[ranks]


def fit_index(offsets: np.ndarray, error: int = 64) -> RankIndex:
    """An index over ascending ``offsets`` whose predictions are off by at most ``error`` + 1.

    From the first offset a segment doesn't cover yet, the slopes that pass
    every further one within the error form a cone that only narrows; the
    segment ends where the cone is empty.  Offsets are looked at in runs of
    doubling length, so that long segments cost few steps.
    """
    count = len(offsets)
    firsts, slopes = [], []
    first = 0
    while first < count:
        low, high, end, step = -np.inf, np.inf, first + 1, 16
        while end < count:
            stop = min(end + step, count)
            run = np.arange(end - first, stop - first)
            rise = offsets[end:stop] - offsets[first]
            lows = np.maximum(np.maximum.accumulate((rise - error) / run), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / run), high)
            empty = np.flatnonzero(lows > highs)
            fits = int(empty[0]) if len(empty) else stop - end
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            end += fits
            if len(empty):
                break
            step *= 2
        firsts.append(first)
        slopes.append((low + high) / 2 if end > first + 1 else 0.0)
        first = end
    starts = np.array(firsts, np.int64)
    index = RankIndex(starts, offsets[starts], np.array(slopes, np.float64), np.zeros(0, np.int8))
    missing = offsets - index.predicted(np.arange(count))
    index.residuals = missing.astype(np.int8 if error < 127 else np.int64)
    return index


def line_ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """0 and the offset behind every line of the texts; a text's last line may lack its line feed."""
    ends = data == 0x0A
    ends[offsets[1:][np.diff(offsets) > 0] - 1] = True
    return np.concatenate(([0], np.flatnonzero(ends) + 1))


def fill_in_middle(
    docs: DataFrame, seed: int = 7, rate: int = 100, suffix_first: int = 50, error: int = 64
) -> DataFrame:
    """Every text of ``docs`` (doc_id, text; other columns are not read) with its middle at the end.

    Returns doc_id, n (lines), form, prefix_chars, middle_chars (code points)
    and output.  Two line ends, drawn by the hash of seed and doc_id, cut the
    text.  ``rate`` percent of the texts are cut, ``suffix_first`` percent of
    those become form spm (suffix, prefix, middle), the others psm; the rest,
    empty texts and those that hold a mark themselves stay plain, with null
    counts.

    A null text is an empty one; a null doc_id is hashed as no digits.  Rows
    with the same doc_id and text are cut alike, and equal draws make an empty
    middle.  An empty table gives an empty result.  Texts are read whole, in
    blocks of about a megabyte with one index over all their line ends; a
    longer text is a block of its own.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long").alias(f"h{k + 1}") for k in range(4)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).fill_null("")
            data, offsets = text_bytes(texts)
            h1, h2, h3, h4 = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(2, 6))
            plain = offsets[1:] == offsets[:-1]
            for mark in (PREFIX, SUFFIX, MIDDLE):
                plain |= pc.match_substring(texts, mark).to_numpy(zero_copy_only=False)
            plain |= h3 % 100 >= rate
            forms = np.where(plain, "plain", np.where(h4 % 100 < suffix_first, "spm", "psm"))
            for a, b in blocks(offsets, BLOCK):
                own = data[offsets[a] : offsets[b]]
                bounds = offsets[a : b + 1] - offsets[a]
                ends = line_ends(own, bounds)
                ranks = np.searchsorted(ends, bounds)
                lines = np.diff(ranks)
                index = fit_index(ends, error)
                draw1, draw2 = h1[a:b] % (lines + 1), h2[a:b] % (lines + 1)
                cut1 = index.offset(ranks[:-1] + np.minimum(draw1, draw2))
                cut2 = index.offset(ranks[:-1] + np.maximum(draw1, draw2))
                chars = np.zeros(len(own) + 1, np.int64)
                np.cumsum((own & 0xC0) != 0x80, out=chars[1:])
                form = forms[a:b]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a).cast(pa.int64()),
                        pa.array(lines.astype(np.int64)),
                        pa.array(form.tolist(), pa.string()),
                        pa.array(chars[cut1] - chars[bounds[:-1]], mask=form == "plain"),
                        pa.array(chars[cut2] - chars[cut1], mask=form == "plain"),
                        _joined(own.tobytes(), form.tolist(), bounds, cut1, cut2),
                    ],
                    ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    return docs.select("doc_id", "text", *draws).mapInArrow(run, RESULT)


def _joined(data: bytes, forms: list[str], bounds: np.ndarray, cut1: np.ndarray, cut2: np.ndarray) -> pa.Array:
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    out = []
    for form, a, b, c, d in zip(forms, bounds[:-1].tolist(), cut1.tolist(), cut2.tolist(), bounds[1:].tolist(), strict=True):
        if form == "plain":
            out.append(data[a:d])
        elif form == "psm":
            out.append(b"".join((p, data[a:b], s, data[c:d], m, data[b:c])))
        else:
            out.append(b"".join((s, data[c:d], p, data[a:b], m, data[b:c])))
    return pa.array(out, pa.binary()).cast(pa.string())


def restored(form: Column, output: Column) -> Column:
    """The text that ``fill_in_middle`` was given (a null one as empty), from its form and output."""
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
