"""Keyword-stuffed and link-list pages, by block-wise compression.

1. A text is brought to one spelling, and what says as much as any other of its kind (an address, a
   tag, markup, an article number, a price) becomes a run of one mark. What says something new
   whatever it is (a number, a sequence without a blank) becomes bytes that don't compress.
2. Windows of this, one every STEP bytes, are compressed. A window's redundancy is its compression
   ratio over that of usual text of the same language and length in the corpus.
3. A window is flagged where redundancy is extreme, and confirmed by a low density of sentence ends.
   Only ends of sentences count that don't repeat what was said within the window before them.
4. A page's share is that of the flagged windows' own characters.
"""

from __future__ import annotations

import re
import unicodedata
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

WINDOW, STEP = 640, 216
#: The ratio that this share of windows reach at most is taken for usual text's.
USUAL = 0.8
#: So many windows' worth of all languages' are added to each language's, so that rare languages lean on the rest.
LEAN = 100.0
#: A window is extreme below this share of the usual ratio, and confirmed up to so many sentence ends for each 100 bytes.
EXTREME, FEW_ENDS = 0.92, 0.55
#: A sentence has this many bytes at least, of whose pieces of PIECE bytes this share is new.
SENTENCE, PIECE, NEW = 46, 8, 0.45
#: Bytes that stand for a number, and from how many characters on a word without a blank is data.
NUMBER, DATA = 18, 24

_INVISIBLE = re.compile("[​-‏⁠-⁤﻿­]")
_URL = re.compile(rb"(?:https?://|www\.)[^\s<>\"')\]|,;]+")
_MARKUP = re.compile(rb"<[^<>]{0,300}>")
_TAG = re.compile(rb"#[^\s#,|;/]+")
_SPACES = re.compile(rb"[ \t\r\f\v]{2,}|[\t\r\f\v]")
_DOUBLED = re.compile(rb"([a-z])\1+")
_NEWS = re.compile(rb"[!-~]{%d,}|\d+(?:[.,]\d+)*" % DATA)
_LETTERS = bytes.maketrans(b"013457", b"oieast")
_ENDS = re.compile(rb"[.!?](?=\s|$|[\xc0-\xff])|\xe3\x80\x82")
#: A line that states a value is a sentence of its own.
_STATED = re.compile(rb"(?m)^ ?[\w.\x05-]+ ?[:=] ?[^\s,\x01-\x05]+ ?$")
_LETTER = frozenset(b"abcdefghijklmnopqrstuvwxyz")
_BEFORE_LABEL = _LETTER | frozenset(b"_-(#")


def _scrambled(n: int) -> np.ndarray:
    """n numbers from 0 to 63, always the same, in which nothing repeats that compression could use."""
    out, x = np.empty(n, np.uint8), 40503
    for i in range(n):
        x = (x * 6364136223846793005 + 1442695040888963407) & 0xFFFFFFFFFFFFFFFF
        out[i] = x >> 58
    return out


_NOISE = _scrambled(3 << 15)
#: Bytes that count as a character and bytes that don't, as first and further bytes in UTF-8; of each
#: three bytes of the mixture one doesn't, at any place.
_COUNTED, _UNCOUNTED = (_NOISE | 0xC0).tobytes(), (_NOISE | 0x80).tobytes()
_MIXED = (_NOISE | np.where(np.arange(len(_NOISE)) % 3 == np.repeat(_NOISE[::3] % 3, 3), 0x80, 0xC0).astype(np.uint8)).tobytes()


def _number(k: int, chars: int) -> bytes:
    """NUMBER bytes or more, ``chars`` of them characters; others for each k."""
    start = k * 97 % (len(_COUNTED) - 2 * DATA)
    return _COUNTED[start : start + chars] + _UNCOUNTED[start : start + NUMBER - chars]


def _data(k: int, chars: int) -> bytes:
    """Half as many bytes again as characters; others for each k."""
    size, start = chars * 3 // 2, k * 291 % len(_MIXED)
    return (_MIXED[start:] + _MIXED * (size // len(_MIXED) + 1))[:size] if start + size > len(_MIXED) else _MIXED[start : start + size]


def normalised(text: str) -> bytes:
    """The bytes to compress; as many of them as aren't further bytes in UTF-8 are the characters."""
    text = text.lower() if text.isascii() else unicodedata.normalize("NFKC", _INVISIBLE.sub("", text)).lower()
    data = text.encode("utf-8", "replace")
    for hint, pattern, mark in ((b"://", _URL, b"\x01"), (b"www.", _URL, b"\x01"), (b"<", _MARKUP, b"\x02"), (b"#", _TAG, b"\x03")):
        if hint in data:
            data = pattern.sub(lambda m: mark * (m.end() - m.start()), data)  # noqa: B023
    data = _DOUBLED.sub(rb"\1", _SPACES.sub(b" ", data))
    k, size = 0, len(data)

    def said(m: re.Match) -> bytes:
        nonlocal k
        start, stop = m.span()
        word, n = m[0], stop - start
        if n < DATA:
            before, after = data[start - 1] if start else 32, data[stop] if stop < size else 32
            if before in _LETTER and after in _LETTER:  # a letter in disguise
                return word.translate(_LETTERS)
            price = n > 3 and word[-3] == 46 and data[stop : stop + 2].strip()[:1] != b"%"
            if price or before in _BEFORE_LABEL or n < 3 and after in _LETTER:
                return b"\x05" * n
        k += 1
        return _number(k, n) if n < DATA else _data(k, n)

    return _NEWS.sub(said, data)


def sentence_ends(data: bytes) -> list[int]:
    """Where sentences end that say something new."""
    ends, begin = [], 0
    for m in _ENDS.finditer(data):
        end = m.start()
        pieces = (end - begin) // PIECE
        if end - begin >= SENTENCE:
            needed, near = max(2, ceil(NEW * pieces)), max(0, begin - WINDOW)
            spare = pieces - needed
            for at in range(begin, begin + pieces * PIECE, PIECE):
                if data.find(data[at : at + PIECE], near, at) < 0:
                    needed -= 1
                    if not needed:
                        ends.append(end)
                        break
                else:
                    spare -= 1
                    if spare < 0:
                        break
        begin = end + 1
    if b":" in data or b"=" in data:
        ends = sorted(ends + [m.end() - 1 for m in _STATED.finditer(data)])
    return ends


def size_class(n: int) -> int:
    """Lengths of n bytes are compared with within a fifth of n or so."""
    return int(4 * log2(n))


def windows(text: str) -> list[tuple[int, int, float, int]]:
    """(size class, compression ratio in thousandths, sentence ends for each 100 bytes, own characters) of each window.

    A window's own characters are those nearer to its middle than to other windows'.
    """
    data = normalised(text)
    n = len(data)
    if not n:
        return []
    starts = [0] if n <= WINDOW else [*range(0, n - WINDOW, STEP), n - WINDOW]
    ends = sentence_ends(data)
    counted = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    out, before = [], 0
    for i, start in enumerate(starts):
        stop = min(start + WINDOW, n)
        border = n if i == len(starts) - 1 else (stop + starts[i + 1]) // 2
        chars = int(counted[border - 1])
        within = bisect_left(ends, stop) - bisect_left(ends, start)
        size = stop - start
        out.append((size_class(size), 1000 * len(zlib.compress(data[start:stop], 6, wbits=-10)) // size, 100 * within / size, chars - before))
        before = chars
    return out


MEASURED = "key long, lang string, w array<struct<size: int, ratio: int, ends: double, chars: int>>"


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    fields = [("size", pa.int32()), ("ratio", pa.int32()), ("ends", pa.float64()), ("chars", pa.int32())]
    for batch in batches:
        for first in range(0, batch.num_rows, 256):
            part = batch.slice(first, 256)
            found = [windows(t) if t else [] for t in part["text"].to_pylist()]
            offsets = np.cumsum([0, *map(len, found)]).astype(np.int32)
            columns = list(zip(*[w for ws in found for w in ws])) or [[]] * 4
            values = pa.StructArray.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(columns, fields)], fields=[pa.field(*f) for f in fields])
            yield pa.RecordBatch.from_arrays([part["key"], part["lang"], pa.ListArray.from_arrays(pa.array(offsets), values)], names=["key", "lang", "w"])


def usual_ratios(measured: DataFrame) -> DataFrame:
    """lang -> the usual ratio for each size class, in thousandths; over all windows of the corpus.

    Ratios are whole thousandths, so counting them gives the exact share, in any order and at any
    size; LEAN windows of all languages, in proportion, are added to each language's. The result has
    at most 26 * 26 languages and one for the rest, with some hundred size classes each.
    """
    each = measured.select("lang", F.explode("w").alias("w")).select("lang", "w.size", "w.ratio")
    counts = each.groupBy("lang", "size", "ratio").agg(F.count(F.lit(1)).alias("n"))
    every = counts.groupBy("size", "ratio").agg(F.sum("n").alias("n"))
    share = (F.lit(LEAN) * F.col("n") / F.sum("n").over(Window.partitionBy("size"))).alias("weight")
    lent = counts.select("lang", "size").distinct().join(every.select("size", "ratio", share), "size")
    both = counts.select("lang", "size", "ratio", F.col("n").cast("double").alias("weight")).unionByName(lent.select("lang", "size", "ratio", "weight"))
    told = both.groupBy("lang", "size", "ratio").agg(F.sum("weight").alias("weight"))  # two numbers at most
    kind = Window.partitionBy("lang", "size")
    reached = F.sum("weight").over(kind.orderBy("ratio").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("weight").over(kind.orderBy("ratio").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    usual = told.withColumn("reached", reached >= USUAL * total).where("reached").groupBy("lang", "size").agg(F.min("ratio").alias("ratio"))
    return usual.groupBy("lang").agg(F.map_from_entries(F.collect_list(F.struct("size", "ratio"))).alias("usual"))


def stuffed_share(df: DataFrame, key: str, text: str, lang: str) -> DataFrame:
    """key and share: the part of a text's characters in flagged windows' own, from 0 to 1.

    NULL, empty and blank texts have share 0. ``lang`` is a two-letter code in any case; anything
    else, NULL too, is a language of its own. Rows keep their number. Very long texts are measured
    whole, very short ones against texts as short.
    """
    code = F.lower(F.trim(F.col(lang)))
    code = F.when(code.rlike("^[a-z]{2}$"), code).otherwise("und")
    rows = df.select(F.col(key).cast("long").alias("key"), code.alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    measured = settled(rows.mapInArrow(_measured, MEASURED), "windows")
    judged = measured.join(F.broadcast(usual_ratios(measured)), "lang", "left")

    def flagged(w):
        return (w["ratio"] < F.lit(EXTREME) * F.element_at("usual", w["size"])) & (w["ends"] <= FEW_ENDS)

    total = F.aggregate("w", F.lit(0).cast("long"), lambda s, w: s + w["chars"])
    spam = F.aggregate("w", F.lit(0).cast("long"), lambda s, w: s + F.when(flagged(w), w["chars"]).otherwise(0))
    return judged.select(F.col("key").alias(key), F.when(total > 0, spam / total).otherwise(0.0).alias("share"))
