"""Licence scan: ordered signature rules behind a keyword filter, overlaps resolved by priority and containment.

A text becomes its lower-case words with one space between them. Only rules whose keywords all begin words of the text are
tried. Detections are taken tier by tier, highest first, and within a tier longest first from each start;
one that lies inside a detection taken before is suppressed, so a licence named with its version wins over
the bare name in it. Texts are read one by one, whole, in the partitions they lie in: no exchange.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkroute.llm.common import python_workers
from sparkroute.llm.license_rules import compiled

#: Phrases that always count, wherever they stand, with their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: How much a detection of a tier is worth; labels are independent evidence.
WEIGHTS = {1: 0.5, 2: 0.8, 3: 0.95}
#: A word is made of digits, letters and all that is not ASCII; A-Z are lower-cased.
_WORDS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))

Detection = tuple[str, int, int, int]


def words_of(text: str) -> tuple[bytes, int]:
    """A text as words between single spaces, with a space at both ends, and their number."""
    words = text.encode("utf-8", "surrogatepass").translate(_WORDS).split()
    return b" %s " % b" ".join(words), len(words)


def base_places(line: bytes) -> list[tuple[int, str]]:
    """(offset, label) of every place of every base phrase."""
    out = []
    for phrase, label in BASE.items():
        at = line.find(b" %s " % phrase.encode())
        while at >= 0:
            out.append((at, label))
            at = line.find(b" %s " % phrase.encode(), at + 1)
    return sorted(out)


class Rules:
    """The rules by keyword, in the order of the table."""

    def __init__(self, rules=None):
        self.rules = compiled() if rules is None else rules
        self.keywords = sorted({k for _, _, keywords, _ in self.rules for k in keywords})

    def matches(self, line: bytes) -> list[Detection]:
        """(label, tier, start, end) of every match of the rules whose keywords are there."""
        there = {k for k in self.keywords if k in line}
        if not there:
            return []
        return [(label, tier, m.start(), m.end()) for label, tier, keywords, expression in self.rules
                if there.issuperset(keywords) for m in expression.finditer(line)]


def settled(found: list[Detection]) -> list[Detection]:
    """Detections that lie inside none taken before them, in the order of their starts."""
    taken: list[Detection] = []
    for tier in sorted({d[1] for d in found}, reverse=True):
        taken.sort(key=lambda d: d[2])
        starts, reach, new_reach, new = [d[2] for d in taken], list(accumulate((d[3] for d in taken), max)), -1, []
        for d in sorted((d for d in found if d[1] == tier), key=lambda d: (d[2], -d[3])):
            before = bisect_right(starts, d[2])
            if d[3] <= new_reach or before and d[3] <= reach[before - 1]:
                continue
            new.append(d)
            new_reach = d[3]
        taken += new
    return sorted(taken, key=lambda d: (d[2], d[3]))


_FOUND = pa.struct([("label", pa.string()), ("tier", pa.int32()), ("first_word", pa.int64()), ("n_words", pa.int64())])
_BASE = pa.struct([("label", pa.string()), ("first_word", pa.int64())])
_SCAN = pa.struct([("n_words", pa.int64()), ("base", pa.list_(_BASE)), ("found", pa.list_(_FOUND))])
_SCAN_DDL = ("struct<n_words: long, base: array<struct<label: string, first_word: long>>, "
             "found: array<struct<label: string, tier: int, first_word: long, n_words: long>>>")


def scanned(text: str, rules: Rules) -> dict:
    """Words, base places and settled detections of a text."""
    line, n = words_of(text)
    base, found = base_places(line), settled(rules.matches(line))
    if not base and not found:
        return {"n_words": n, "base": [], "found": []}
    spaces = np.flatnonzero(np.frombuffer(line, np.uint8) == 0x20)
    word = lambda at: int(np.searchsorted(spaces, at))
    made = [{"label": label, "tier": tier, "first_word": word(a - 1), "n_words": line.count(b" ", a, b) + 1} for label, tier, a, b in found]
    return {"n_words": n, "base": [{"label": label, "first_word": word(at)} for at, label in base], "found": made}


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: the id, n_words, base (label, first_word) and found (label, tier, first_word, n_words).

    Defined results: a null text is empty; repeated rows and equal or null ids are documents of their own; texts are read whole,
    whatever their length; other columns are not read; an empty table gives no rows.
    """
    python_workers(docs.sparkSession)

    def scan_texts(batches):
        rules = Rules()
        for batch in batches:
            made = [scanned(text.as_py() or "", rules) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, _SCAN)], ["id", "scan"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(scan_texts, f"id {kind}, scan {_SCAN_DDL}").select(F.col("id").alias(id_col), "scan.*")


def joined(labels: Column) -> Column:
    """Distinct labels in order, between commas."""
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def score(found: Column) -> Column:
    """One less the chance that no label is right, each label taken by its best detection."""
    weight = lambda d: F.when(d["tier"] == 3, WEIGHTS[3]).when(d["tier"] == 2, WEIGHTS[2]).otherwise(WEIGHTS[1])
    best = lambda label: F.array_max(F.transform(F.filter(found, lambda d: d["label"] == label), weight))
    labels = F.array_sort(F.array_distinct(F.transform(found, lambda d: d["label"])))
    return F.lit(1.0) - F.aggregate(labels, F.lit(1.0), lambda left, label: left * (1.0 - best(label)))


def labelled(scans: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The scans as one line per document: places and labels of the base phrases, all labels, score."""
    base, found = F.transform("base", lambda b: b["label"]), F.transform("found", lambda d: d["label"])
    places = F.transform("base", lambda b: b["first_word"])
    return scans.select(
        id_col, "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(places).alias("first_word"),
        F.array_max(places).alias("last_word"), joined(base).alias("base_labels"), joined(F.concat(base, found)).alias("labels"),
        score(F.col("found")).alias("score"))
