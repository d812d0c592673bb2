"""Texts cut off by field limits or in transfer.

Two tries over the corpus decide how a text ends.  The trie of words: a final
token that is no known word but a proper prefix of known ones was cut.  The trie
of phrases, whose letters are words: a final line that other lines begin with
and go on from was cut, one that other lines end with (a closing phrase, a
device line) is complete.  Lengths at which a source's texts pile up are the
evidence beside: a text of such a length with an open ending was cut, whatever
its last word.  Structure is checked for headers, multipart bodies, HTML pages
and encoded blocks only.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from wellspring.llm.mail import readable, take_apart, words
from wellspring.session import cut

SENTENCE_END = re.compile(r"[.!?…。][\"'”’»)\]]*$")
LAST_OF_SENTENCE = re.compile(r"([^\W_]+)[.!?…。]")
SIGNATURE_LINES = 4
SHARD = 4  # first letters that words of one trie share
KNOWN = 3  # documents that make a word known
PHRASE_WORDS = 4  # depth of the trie of phrases
RARE = 200


def _phrase(line: str) -> str:
    return " ".join(line.casefold().rstrip(",;: ").split())


def _begins(lines: list[str], k: int) -> bool:
    """Whether line ``k`` begins something: it is the first, follows a blank line or a finished sentence."""
    return k == 0 or not lines[k - 1] or SENTENCE_END.search(lines[k - 1]) is not None


def phrases_of(lines: list[str]) -> tuple[set[str], set[str]]:
    """Of the lines that begin something: the short ones, and the beginnings (1 to ``PHRASE_WORDS`` words) of those that go on."""
    ends, goes_on = set(), set()
    for k, line in enumerate(lines):
        if line and _begins(lines, k):
            found = _phrase(line).split(" ")
            if len(found) <= PHRASE_WORDS and not SENTENCE_END.search(line):
                ends.add(" ".join(found))
            goes_on.update(" ".join(found[:n]) for n in range(1, min(len(found), PHRASE_WORDS + 1)))
    return ends, goes_on


def last_words(text: str) -> dict:
    """How a mail ends: ``missing``, ``place``, ``token``, ``phrase``, and its ``words`` and lines for the vocabulary.

    ``place`` is end (structure closed, full stop, dots or nothing to read),
    name, signature, phrase (a short line of its own, which the trie of phrases
    judges) or open.  ``token`` is the word the text ends with, None if it ends
    with a sign; it is left out of ``words``, which every text would else make known
    itself.  ``stops`` are the words that end a sentence.
    """
    mail = take_apart(text)
    bodies = [readable(kind, part) for kind, part in mail["parts"]]
    out = {"missing": mail["missing"], "place": "end", "token": None, "phrase": None}
    found = [words(body) for body in bodies]
    lines = [[x.strip() for x in body.rstrip().split("\n")] for body in bodies]
    last = lines[-1][-1] if bodies else ""
    if last[-1:].isalnum() and found[-1]:
        tail = found[-1].pop()
    else:
        tail = (words(last) or [""])[-1] if last.endswith("�") else None
    out["words"] = set().union(*found)
    out["stops"] = {w.casefold() for body in bodies for w in LAST_OF_SENTENCE.findall(body)}
    out["lines"] = lines
    head = text.partition("\n\n")[0].lower()
    if mail["missing"] or not bodies or mail["parts"][-1][0] == "text/html" or "content-type: multipart" in head or not last or SENTENCE_END.search(last) or set(last) <= set("_-=*~ "):
        return out
    own, sender = lines[-1], mail["sender"]
    out["token"] = None if tail is None else tail + ("�" if last.endswith("�") else "")
    before = own[-2] if len(own) > 1 else ""
    if sender and last in (sender, sender.split(" ")[0]):
        out["place"] = "name"
    elif sender.startswith(last) and len(own) > 1:
        out["place"] = "open"  # the sender's name breaks off
    elif "--" in own[-SIGNATURE_LINES - 1 : -1]:
        out["place"] = "signature"
    elif before.endswith(",") and len(before.split()) <= 4 and len(last.split()) <= 3 and all(w[:1].isupper() for w in last.split()):
        out["place"] = "name"
    elif last.count("(") > last.count(")"):
        out["place"] = "open"
    elif _begins(own, len(own) - 1) and len(last.split()) <= PHRASE_WORDS:
        out["place"], out["phrase"] = "phrase", _phrase(last)
    else:
        out["place"] = "open"
    return out


EVIDENCE = "doc_id long, source string, n_chars long, n_bytes long, missing string, place string, token string, phrase string, kind string, word string, n long"


def read_endings(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """One pass: a row per document, and per batch the number of documents with each word or phrase.

    Those rows have ``kind`` (word, stops, ends, goes_on), ``word`` and ``n``.
    """

    def run(batches):
        for b in batches:
            seen = {kind: Counter() for kind in ("word", "stops", "ends", "goes_on")}
            rows = []
            for doc, where, body in zip(*(b.column(c).to_pylist() for c in ("doc_id", "source", "text"))):
                e = last_words(body)
                rows.append((doc, where, len(body), len(body.encode("utf-8", "replace")), e["missing"], e["place"], e["token"], e["phrase"], None, None, None))
                seen["word"].update(e["words"])
                seen["stops"].update(e["stops"])
                # an open line at the end of a text tells nothing about how lines go on
                whole = [x if k < len(e["lines"]) - 1 or SENTENCE_END.search(x[-1]) else x[:-1] for k, x in enumerate(e["lines"])]
                shut, open_ = zip(*map(phrases_of, whole)) if whole else ((), ())
                seen["ends"].update(set().union(*shut) | ({e["phrase"]} if e["phrase"] else set()))
                seen["goes_on"].update(set().union(*open_))
            rows += [(None,) * 8 + (kind, w, n) for kind, counts in seen.items() for w, n in counts.items()]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 6, pa.int64())
            cols = list(zip(*rows)) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in EVIDENCE.split(", ")])

    docs = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text")).filter("text is not null")
    return docs.mapInArrow(run, EVIDENCE)


def closing_phrases(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """``phrase``: those of ``asked`` that are complete by the trie of phrases.

    ``counts`` is ``kind, word, n``.  A node of the trie knows how many documents
    have a line that ends there and how many a line that goes on.  Complete is a
    phrase that two documents end a line with and fewer go on from, unless it is
    rare (one in ``RARE``) among the lines that begin with its first word, as
    chance cuts are; of other phrases, one whose first word begins no lines that go on and whose last
    word is not a known one that never ends a sentence.
    """
    asked = asked.select("phrase").filter("phrase is not null").distinct()
    asked = asked.withColumn("first", F.substring_index("phrase", " ", 1)).withColumn("last", F.substring_index("phrase", " ", -1))
    wanted = asked.select(F.explode(F.array("phrase", "first", "last")).alias("word")).distinct()
    of = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0)).alias(kind)
    nodes = counts.join(wanted, "word", "left_semi").groupBy("word").agg(*[of(kind) for kind in ("word", "stops", "ends", "goes_on")])
    nodes = cut(nodes.toDF("at", "known", "stops", "ends", "goes_on"))
    node = lambda name: nodes.select(F.col("at").alias(name), F.struct("known", "stops", "ends", "goes_on").alias(f"{name}_node"))
    for name in ("phrase", "first", "last"):
        asked = asked.join(node(name), name, "left")
    n = lambda name, what: F.coalesce(F.col(f"{name}_node")[what], F.lit(0))
    usual = (n("phrase", "ends") >= 2) & (n("phrase", "ends") > n("phrase", "goes_on")) & (n("phrase", "ends") * RARE >= n("first", "goes_on"))
    begins = n("first", "goes_on") > n("first", "ends")
    inside = (n("last", "known") >= KNOWN) & (n("last", "stops") == 0) & (n("last", "ends") == 0)
    return asked.filter(usual | ~(begins | inside)).select("phrase")


def known_prefixes(tokens: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``token``: those that are no known word but a proper prefix of one.

    ``vocabulary`` is ``word`` (known words).  Tokens of fewer than ``SHARD``
    letters are matched with prefixes of that length; longer ones walk the trie
    of the words that share their first letters.
    """
    tokens = tokens.select("token").filter("token is not null and token <> ''").distinct().join(vocabulary.select(F.col("word").alias("token")), "token", "left_anti")
    short = tokens.filter(F.length("token") < SHARD)
    starts = vocabulary.select(F.explode(F.transform(F.sequence(F.lit(1), F.lit(SHARD - 1)), lambda n: F.when(F.length("word") > n, F.substring("word", F.lit(1), n)))).alias("token")).filter("token is not null").distinct()
    long = tokens.filter(F.length("token") >= SHARD).withColumn("shard", F.substring("token", 1, SHARD))
    shards = vocabulary.filter(F.length("word") > SHARD).withColumn("shard", F.substring("word", 1, SHARD)).join(long.select("shard").distinct(), "shard", "left_semi")

    def walk(asked: pa.Table, known: pa.Table) -> pa.Table:
        trie: dict = {}
        for w in known["word"].to_pylist():
            node = trie
            for letter in w[SHARD:]:
                node = node.setdefault(letter, {})
        hits = []
        for t in asked["token"].to_pylist() if known.num_rows else []:
            node = trie
            for letter in t[SHARD:]:
                node = node.get(letter)
                if node is None:
                    break
            if node:
                hits.append(t)
        return pa.table({"token": pa.array(hits, pa.string())})

    return short.join(starts, "token", "left_semi").unionByName(long.groupBy("shard").cogroup(shards.groupBy("shard")).applyInArrow(walk, "token string"))


def length_limits(lengths: DataFrame) -> DataFrame:
    """``source, unit, length``: lengths that five or more texts share, five times as many as lengths nearby."""
    units = lengths.select("source", F.explode(F.array(F.struct(F.lit("chars").alias("unit"), F.col("n_chars").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.col("n_bytes").alias("length")))).alias("u")).select("source", "u.*")
    counts = units.groupBy("source", "unit", "length").count()
    near = Window.partitionBy("source", "unit").orderBy("length").rangeBetween(-32, 32)
    usual = (F.sum("count").over(near) - F.col("count")) / 64
    return counts.withColumn("usual", usual).filter((F.col("count") >= 5) & (F.col("count") > 5 * F.greatest("usual", F.lit(0.2)))).select("source", "unit", "length")


def find_truncated(documents: DataFrame, doc_id: str, text: str, source: str) -> DataFrame:
    """Every document with the evidence on its ending, what decided and ``truncated``.

    ``doc_id, source, missing, place, word_cut, at_limit, evidence, truncated``.
    ``evidence`` is what decided: structure, word (the trie of words), length (an
    open ending at a length limit of the source) or phrase (the trie of phrases:
    an open ending that is none of the complete ones); null if the text is
    complete.  Null texts are left out; an empty text lacks its headers.  A mail
    that ends with a full stop, dots, a name, a signature or a closing phrase is
    complete, unless its final token is an unknown proper prefix of known words;
    in a signature, where codes abound, such a token counts only at a length
    limit of the source.
    """
    both = cut(read_endings(documents, doc_id, text, source))
    docs = both.filter("kind is null").drop("kind", "word", "n")
    counts = both.filter("kind is not null").select("kind", "word", "n")
    vocabulary = cut(counts.filter("kind = 'word'").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= KNOWN).select("word"))
    whole = F.col("token").isNotNull() & ~F.endswith("token", F.lit("�"))
    prefixes = known_prefixes(docs.filter(whole), vocabulary).withColumn("prefix", F.lit(True))
    closings = closing_phrases(docs, counts).withColumn("closing", F.lit(True))
    limits = cut(length_limits(docs))  # a few per source
    on = lambda unit, name: limits.filter(F.col("unit") == unit).select("source", F.col("length").alias(name), F.lit(True).alias(f"at_{unit}"))
    judged = docs.join(prefixes, "token", "left").join(closings, "phrase", "left")
    judged = judged.join(on("chars", "n_chars"), ["source", "n_chars"], "left").join(on("bytes", "n_bytes"), ["source", "n_bytes"], "left")
    yes = lambda c: F.coalesce(c, F.lit(False))
    place = F.when(F.col("place") != "phrase", F.col("place")).when(yes(F.col("closing")), "closing").otherwise("open")
    judged = judged.withColumn("word_cut", yes(F.col("prefix")) | yes(F.endswith("token", F.lit("�")))).withColumn("at_limit", F.coalesce("at_chars", "at_bytes", F.lit(False))).withColumn("place", place)
    return judged.select("doc_id", "source", "missing", "place", "word_cut", "at_limit", _evidence().alias("evidence"), _evidence().isNotNull().alias("truncated"))


def _evidence() -> Column:
    unfinished = F.col("place") == "open"
    within_word = F.col("word_cut") & (F.col("place").isin("open", "closing", "name") | ((F.col("place") == "signature") & F.col("at_limit")))
    return F.when(F.col("missing").isNotNull(), "structure").when(within_word, "word").when(unfinished & F.col("at_limit"), "length").when(unfinished, "phrase")
