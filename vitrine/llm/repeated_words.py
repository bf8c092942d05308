"""Removal of word windows that an earlier document has, found by level-wise doubling.

Windows of half the length are looked at first.  Only where those occur in
several documents are windows of twice their length asked about, and so on up
to the full length; longer repeats are unions of such windows.  At the first
level one fingerprint stands for each full window: the least among its
half-windows.  Equal windows have equal least half-windows, so none is lost,
and neighbours mostly share theirs, so that about a quarter of them travels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vitrine.llm.exchange import among, answer, ask, buckets_of, dealt, distinct, entries, finish, known, send
from vitrine.llm.words import BLANK_SEPARATED, blocks, covered, find_words, mixed, text_bytes, windows

RESULT = "doc_id long, n_words long, n_removed long, kept_text string"
_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())]
)
_FIRST = np.dtype([("key", np.int64), ("check", np.uint32)])


def levels(window: int, first: int | None = None) -> list[int]:
    """Window lengths, each at most twice the one before, the last being ``window``."""
    out = [min(window, first or (window + 1) // 2)]
    while out[-1] < window:
        out.append(min(window, 2 * out[-1]))
    return out


def remove_repeated_words(docs: DataFrame, window: int = 13, first: int | None = None) -> DataFrame:
    """Removes each word in a window of ``window`` words that also starts in a document with a smaller doc_id.

    ``docs`` needs doc_id and text; other columns are not read.  Words are runs
    of bytes other than blank and \\x09-\\x0D.  Returns per row doc_id, n_words,
    n_removed and kept_text, the kept words joined by one blank.

    A null or empty text has no words and keeps "".  A null doc_id counts as
    larger than any.  Rows with the same doc_id are one document for the
    question who is earlier, so they remove nothing from each other.  Texts
    shorter than a window keep all.  An empty table gives an empty result.

    Fingerprints have 64 bits at the lower levels, where a collision costs a
    question, and 96 at the full length, where one would remove a window.
    """
    lengths = levels(window, first)
    buckets = buckets_of(docs)
    dealt_docs = dealt(docs, "doc_id", "text")
    answers = None
    for n, length in enumerate(lengths):
        sender, answerer = _level(lengths, n, window, buckets)
        got = ask(dealt_docs, answers, sender, answerer)
        answers = got if answers is None else answers.unionAll(got)
    return finish(dealt_docs, answers, _removal(lengths, window), RESULT)


def _least(prints: np.ndarray, span: int) -> np.ndarray:
    """The least of each ``span`` consecutive values, mixed once more: buckets are even ranges, least values small."""
    count = max(0, len(prints) - span + 1)
    out = prints[:count].copy()
    if not count:
        return out
    for k in range(1, span):
        np.minimum(out, prints[k : k + count], out=out)
    return mixed(out)


def _candidates(words, lengths: list[int], n: int, window: int, got: pa.Table | None, answered: list[np.ndarray]):
    """Positions and fingerprints of the windows that level ``n`` asks about.

    Level 0 asks with the least half-window of every full window.  Level 1 asks
    about windows within full ones whose least half-window was answered, later
    levels about windows both ends of which were.
    """
    base = lengths[0]
    prints, _ = windows(words, base)
    _, whole = windows(words, window)
    if n == 0:
        least = _least(prints, window - base + 1)[: len(whole)]
        return np.flatnonzero(whole), least
    length = lengths[n]
    own, alive = windows(words, length)
    if n == 1:
        full = np.flatnonzero(whole & among(_least(prints, window - base + 1), answered[0]))
        alive = covered(full, window - length + 1, len(own))
    else:
        before = lengths[n - 1]
        hit = among(windows(words, before)[0], answered[n - 1])
        alive &= hit[: len(own)] & hit[length - before :][: len(own)]
    return np.flatnonzero(alive), own


def _level(lengths: list[int], n: int, window: int, buckets: int):
    final = n == len(lengths) - 1

    def sender(table: pa.Table, got: pa.Table | None):
        data, offsets = text_bytes(table.column("text"))
        keys = table.column("key").to_numpy()
        answered = [known(got, k) for k in range(n)]
        prints, ids, checks = [], [], []
        for a, b in blocks(offsets):
            words = find_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], BLANK_SEPARATED)
            at, own = _candidates(words, lengths, n, window, got, answered)
            found, rows = own[at], words.text[at]
            if n == 0 and len(found):  # neighbours with the same least half-window
                new = np.concatenate(([True], (found[1:] != found[:-1]) | (rows[1:] != rows[:-1])))
                found, rows, at = found[new], rows[new], at[new]
            prints.append(found)
            ids.append(keys[a:b][rows])
            if final:
                checks.append(_check(words, window, at))
        if not prints:
            return
        prints, ids = np.concatenate(prints), np.concatenate(ids)
        ranked, order, first, last = distinct(prints)
        ids = ids[order]
        if not len(ranked):
            return
        least = np.minimum.reduceat(ids, first)
        if final:
            notes = np.empty(len(ranked), _FIRST)
            notes["key"], notes["check"] = least, np.concatenate(checks)[order][first]
        else:
            notes = (least != np.maximum.reduceat(ids, first)).astype(np.uint8)
        yield from send(int(table.column("part")[0].as_py()), n, ranked, notes, buckets)

    def answerer(table: pa.Table):
        sent = entries(table, n, _FIRST if final else np.dtype(np.uint8))
        _, order, first, last = distinct(sent.keys)
        group = np.empty(len(order), np.int64)
        group[order] = np.repeat(np.arange(len(first)), last - first)
        if final:
            exact = _first_of_equal(sent, order)
            yield from answer(sent, n, sent.notes["key"] > exact)
        else:
            several = np.maximum.reduceat(sent.notes[order], first) > 0 if len(first) else np.zeros(0, bool)
            yield from answer(sent, n, (several | (last - first > 1))[group])

    return sender, answerer


def _check(words, window: int, at: np.ndarray) -> np.ndarray:
    return (windows(words, window, salt=1)[0][at] >> np.uint64(32)).astype(np.uint32)


def _first_of_equal(sent, order: np.ndarray) -> np.ndarray:
    """The smallest doc key among the entries with the same fingerprint and check value."""
    order = order[np.lexsort((sent.notes["check"][order], sent.keys[order]))] if len(order) else order
    keys, checks = sent.keys[order], sent.notes["check"][order]
    new = np.concatenate(([True], (keys[1:] != keys[:-1]) | (checks[1:] != checks[:-1]))) if len(keys) else keys
    first = np.flatnonzero(new)
    out = np.empty(len(order), np.int64)
    if len(first):
        least = np.minimum.reduceat(sent.notes["key"][order], first)
        out[order] = np.repeat(least, np.diff(np.append(first, len(order))))
    return out


def _removal(lengths: list[int], window: int):
    top = len(lengths) - 1

    def last(table: pa.Table, got: pa.Table) -> pa.Table:
        data, offsets = text_bytes(table.column("text"))
        keys = table.column("key").to_numpy()
        answered = [known(got, k) for k in range(top + 1)]
        kept_blocks, n_words, n_removed, pending = [], [], [], []
        for a, b in blocks(offsets):
            words = find_words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], BLANK_SEPARATED)
            at, own = _candidates(words, lengths, top, window, got, answered[:top])
            pending.append((a, b, at, own[at], keys[a:b][words.text[at]]))
        prints = np.concatenate([p[3] for p in pending]) if pending else np.zeros(0, np.uint64)
        ids = np.concatenate([p[4] for p in pending]) if pending else np.zeros(0, np.int64)
        _, order, first, end = distinct(prints)
        least = np.empty(len(prints), np.int64)
        if len(first):
            least[order] = np.repeat(np.minimum.reduceat(ids[order], first), end - first)
        gone = (least < ids) | among(prints, answered[top])
        done = 0
        for a, b, at, _, _ in pending:
            block, cuts = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            words = find_words(block, cuts, BLANK_SEPARATED)
            drop = covered(at[gone[done : done + len(at)]], window, len(words.starts))
            done += len(at)
            n_words.append(words.counts(b - a))
            n_removed.append(np.bincount(words.text[drop], minlength=b - a))
            kept_blocks.append(joined(block, words, ~drop, b - a))
        return pa.table(
            [
                table.column("doc_id").cast(pa.int64()),
                pa.array(np.concatenate(n_words), pa.int64()),
                pa.array(np.concatenate(n_removed), pa.int64()),
                pa.chunked_array(kept_blocks, pa.string()),
            ],
            schema=_SCHEMA,
        ) if len(table) else _SCHEMA.empty_table()

    return last


def joined(block: np.ndarray, words, kept: np.ndarray, texts: int) -> pa.Array:
    """The kept words of each text, joined by one blank.

    A kept word before another of its text is followed by a separator, which
    is taken along as the blank.
    """
    starts, ends, text = words.starts[kept], words.ends[kept], words.text[kept]
    more = np.zeros(len(text), bool)
    more[:-1] = text[1:] == text[:-1]
    sizes = ends - starts + more
    out = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    content = block[np.minimum(out, max(0, len(block) - 1))] if len(block) else block
    content[(np.cumsum(sizes) - 1)[more]] = 0x20
    lengths = np.bincount(text, weights=sizes, minlength=texts).astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.StringArray.from_buffers(texts, pa.py_buffer(offsets), pa.py_buffer(content))
