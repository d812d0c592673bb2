"""Evaluation texts inside a corpus: Wu-Manber multi-pattern search over words.

Every stretch of ``run`` words of an item is a pattern.  Blocks of two words
have a shift: how far the search may jump because no pattern can end sooner.
Blocks without a shift select by their hash, together with that of the pattern's
first words, the few places in the items that may end there, and direct
comparison confirms them.  With words as letters the alphabet is so large that
blocks of two suffice at any number of patterns; the second hash keeps frequent
pairs of words from being compared with every place they end in.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspring.llm.mail import readable, take_apart, words

RUN = 25
BLOCK = 2
ITEM_CHARS = 20_000_000  # items whose tables one task holds; more are searched in several passes


def shift_tables(items: list[tuple[int, list[str]]], run: int) -> tuple[dict, dict]:
    """Shift of each block of words, and for blocks of shift 0, by the pattern's first words, the (item, end) places of patterns."""
    shift: dict[tuple[str, str], int] = {}
    bucket: dict[tuple[str, str], dict[tuple[str, str], list[tuple[int, int]]]] = {}
    for at, (_, w) in enumerate(items):
        if len(w) < run:
            continue
        for end in range(1, len(w)):
            block = (w[end - 1], w[end])
            # the earliest pattern holding this block has it nearest to its own end
            far = max(0, run - 1 - end)
            shift[block] = min(shift.get(block, run), far)
            if end >= run - 1:
                prefix = (w[end - run + 1], w[end - run + 2])
                bucket.setdefault(block, {}).setdefault(prefix, []).append((at, end))
    return shift, bucket


def find_items(text: list[str], items: list[tuple[int, list[str]]], shift: dict, bucket: dict, run: int) -> dict[int, tuple[int, int]]:
    """Item id -> (first word's place, longest shared run) for every item with ``run`` words in a row in ``text``."""
    found: dict[int, tuple[int, int]] = {}
    at, n, jump = run - 1, len(text), run - BLOCK + 1
    while at < n:
        block = (text[at - 1], text[at])
        move = shift.get(block, jump)
        if move:
            at += move
            continue
        for k, end in bucket[block].get((text[at - run + 1], text[at - run + 2]), ()):
            item, w = items[k]
            if text[at - run + 1 : at + 1] == w[end - run + 1 : end + 1]:
                size = run
                while at + size - run + 1 < n and end + size - run + 1 < len(w) and text[at + size - run + 1] == w[end + size - run + 1]:
                    size += 1
                place, longest = found.get(item, (at - run + 1, 0))
                found[item] = (place, max(longest, size))
        at += 1
    return found


def mail_words(text: str) -> list[str]:
    """All words of the mail's text parts, with a sign between parts that no item holds."""
    out: list[str] = []
    for kind, part in take_apart(text)["parts"]:
        out += words(readable(kind, part))
        out.append("\n")
    return out


def find_leaks(documents: DataFrame, items: DataFrame, doc_id: str, text: str, item_id: str, item_text: str, run: int = RUN, read: Callable[[str], list[str]] = mail_words) -> DataFrame:
    """``doc_id, item_id, first_word, n_words``: documents that hold ``run`` words in a row of an item.

    Case, punctuation, line breaks, markup, quote marks and transfer encodings
    do not matter.  Null and empty texts, and items of fewer than ``run`` words,
    give no rows; repeated documents each do.  The documents are read once per
    ``ITEM_CHARS`` characters of items and are not shuffled.
    """
    spark = documents.sparkSession
    told = items.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).filter("text is not null")
    chars = told.agg(F.sum(F.length("text"))).first()[0] or 0
    passes = max(1, -(-chars // ITEM_CHARS))
    schema = "doc_id long, item_id long, first_word long, n_words long"
    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).filter("text is not null")

    def search_with(part: list[tuple[int, list[str]]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(part)

        def run_over(batches):
            own = shared.value
            shift, bucket = shift_tables(own, run)
            for b in batches:
                rows = []
                for doc, mail in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                    rows += [(doc, item, place, size) for item, (place, size) in find_items(read(mail), own, shift, bucket, run).items()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in range(4)], names=["doc_id", "item_id", "first_word", "n_words"])

        return docs.mapInArrow(run_over, schema)

    found = []
    for k in range(passes):
        part = told.filter(F.pmod(F.xxhash64("item"), F.lit(passes)) == k).collect()  # at most about ITEM_CHARS
        found.append(search_with([(r.item, words(r.text)) for r in part]))
    return reduce(DataFrame.unionByName, found)
