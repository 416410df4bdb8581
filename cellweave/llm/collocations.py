"""Phrase collocations by prefix-free parsing.

A text is cut wherever two words in a row form a trigger, a window whose hash falls into one class of ``every``; a mark
between pieces counts as a word here. A chunk ends with the trigger's two words and the next one starts with them, so chunks
overlap by ``MOST_WORDS - 1`` words, depend on the words alone, and repeated passages give the same chunks wherever they
stand. Distinct chunks with their frequency are the dictionary. Phrases are counted inside distinct chunks, weighted by the
chunk's frequency: one that starts before the closing trigger belongs to this chunk, one that starts with it to the next, so
every occurrence counts once. None holds a mark. Most phrases are rare: they are told apart by bucket counts first, and only
what may be frequent is counted by its words.

A chunk that meets no trigger is cut after ``longest`` words with the same overlap, which changes no count and bounds every
list. Chunk and phrase counts are combined before each shuffle, so a hot passage or word pair is one row per task.

Defined cases: a null, empty or blank text has no words; a null language is ``und``, together with documents that say so;
repeated rows count each; ids and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellweave.llm.common import LOWER, UPPER, stored

MOST_WORDS = 3
# A window of two words is a trigger with a chance of 1 in EVERY.
EVERY = 12
LONGEST = 256

LEAST_COUNT = 10
# A phrase is dropped where a longer one around it has this share of its count, in hundredths.
SHARE = 50
BEST = 2000

# Bytes whose words are hashed at once, bytes of text parsed and of chunks tallied at once.
_HASHED, _BYTES, _TALLIED = 1 << 17, 1 << 20, 4 << 20
# Phrases are first counted in this many buckets (a power of 2), which are dealt by their first bits; the bitmap of those to
# look into has this size at most.
_BUCKET_BITS, _PART_BITS, _MOST_BITS = 40, 10, 28
_LOW_BITS = _BUCKET_BITS - _PART_BITS
# Counts by buckets go no further than this: enough to tell what may be frequent.
_MOST_COUNTED = 64
# Parts of a language that are ranked each for itself first.
_RANKED = 32


class _Hashes:
    """Hashes of words, none of them 0: polynomials over their bytes, for many words at once."""

    def __init__(self) -> None:
        base = 0x9E3779B97F4A7C15
        self.of_byte = np.array([xxhash.xxh64_intdigest(bytes([b])) for b in range(256)], dtype=np.uint64)
        self.powers, self.inverse = (np.cumprod(np.r_[np.uint64(1), np.full(_HASHED, x, dtype=np.uint64)]) for x in (base, pow(base, -1, 2 ** 64)))

    def of(self, words: list[bytes]) -> np.ndarray:
        return self.within(*_places(b"".join(w + b" " for w in words)))

    def within(self, text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Of the words at these bytes, in order."""
        out = np.empty(len(starts), dtype=np.uint64)
        lo = 0
        while lo < len(starts):
            begin = starts[lo]
            hi = int(np.searchsorted(ends, begin + _HASHED, side="right"))
            if hi == lo:  # one word that is longer than a block
                out[lo] = xxhash.xxh64_intdigest(text[begin:ends[lo]].tobytes())
                hi = lo + 1
            else:
                some = self.of_byte[text[begin:ends[hi - 1]]]
                some *= self.powers[:len(some)]
                upto = np.r_[np.uint64(0), np.cumsum(some)]
                out[lo:hi] = (upto[ends[lo:hi] - begin] - upto[starts[lo:hi] - begin]) * self.inverse[starts[lo:hi] - begin]
            lo = hi
        return _mixed(out, np.uint64(0)) | np.uint64(1)


def _places(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of words that one space each follows, and where the words start and end."""
    found = np.frombuffer(text, dtype=np.uint8)
    ends = np.flatnonzero(found == 32)
    return found, np.r_[0, ends[:-1] + 1][:len(ends)], ends


def cuts(hashes: np.ndarray, ends: np.ndarray, every: int = EVERY, longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and number of own starts of every chunk of pieces in a row; ``ends`` are the places after each piece.

    Phrases at a chunk's own starts are counted in it, and lie in it as a whole.
    """
    n = len(hashes)
    first = np.zeros(n, dtype=bool)
    starts = np.r_[0, ends[:-1]]
    first[starts] = True
    last = np.zeros(n, dtype=bool)
    last[ends - 1] = True
    trigger = np.zeros(n, dtype=bool)
    trigger[:-1] = (_mixed(hashes[:-1], hashes[1:]) >> np.uint64(20)) % np.uint64(every) == 0
    begin = np.flatnonzero(first | (trigger & ~last))
    size = np.diff(np.r_[begin, n])
    if size.max() > longest:  # no trigger for long
        begin = np.concatenate([np.arange(b, b + s, longest) for b, s in zip(begin, size, strict=True)])
        size = np.diff(np.r_[begin, n])
    piece_end = ends[np.searchsorted(ends, begin, side="right")]
    return begin, np.minimum(begin + size + MOST_WORDS - 1, piece_end), size


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes in order."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(29))


# Bytes are replaced one by one: ASCII characters are never part of another one, and 0xFF is no part of any. A text ends
# with 0xFF, a piece with a full stop, which no word holds.
_END, _STOP = b"\xff", b"."
_PLAIN = bytes.maketrans(b",;:!?\x0a\x0b\x0c\x0d\x09" + UPPER.encode(), _STOP * 9 + b" " + LOWER.encode())
_DICTIONARY = pa.schema([("lang", pa.string()), ("chunk", pa.string()), ("starts", pa.int32()), ("own", pa.int32())])
_PARTS = pa.schema([("part", pa.int32()), ("buckets", pa.binary())])
_BUCKETS = pa.schema([("bucket", pa.int64())])
_PHRASES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n", pa.int64())])


def _parsed(texts: list[bytes], hashes: _Hashes, every: int, longest: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Chunks of some texts with a space after every word, their own starts and the words among these."""
    plain = _END.join(texts).translate(_PLAIN).replace(_STOP, b" . ").replace(_END, b" \xff ")
    text = b" ".join([*plain.split(), b""])
    found, starts, ends = _places(text)
    over = found[starts] == _END[0]
    at = np.flatnonzero(~over)
    if not len(at):
        return [], at, at
    # Words before the end of each text; empty ones cut nothing.
    stops = np.unique(np.r_[np.flatnonzero(over) - np.arange(len(starts) - len(at)), len(at)])
    starts, ends = starts[at], ends[at]
    first, last, own = cuts(hashes.within(found, starts, ends), stops[stops > 0], every, longest)
    words = np.add.reduceat((found[starts] != _STOP[0]).astype(np.int32), first)
    kept = words > 0
    return [text[s:e] for s, e in zip(starts[first[kept]].tolist(), (ends[last[kept] - 1] + 1).tolist(), strict=True)], own[kept], words[kept]


def _parse(batches: Iterator[pa.RecordBatch], every: int, longest: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for batch in batches:
        langs = batch.column("lang")
        for lang in langs.unique().to_pylist():
            held, size = [], 0
            of = batch.column("text").filter(pc.equal(langs, lang)).cast(pa.binary())
            for k, text in enumerate(of, start=1):
                held.append(text.as_py())
                size += len(held[-1])
                if size >= _BYTES or k == len(of):
                    chunks, own, words = _parsed(held, hashes, every, longest)
                    held, size = [], 0
                    yield pa.record_batch([pa.repeat(pa.scalar(lang, pa.string()), len(chunks)), pa.array(chunks, pa.string()),
                                           pa.array(own, pa.int32()), pa.array(words, pa.int32())], schema=_DICTIONARY)


def dictionary(docs: DataFrame, text: str = "text", lang: str = "lang", every: int = EVERY, longest: int = LONGEST) -> DataFrame:
    """``lang, chunk, starts, own, n``: distinct chunks, their own starts, the words among these, and their frequency."""
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text}`").alias("text"))
    parsed = rows.where("text is not null").mapInArrow(
        lambda batches: _parse(batches, every, longest), "lang string, chunk string, starts int, own int")
    return parsed.groupBy("lang", "chunk", "starts", "own").agg(F.count(F.lit(1)).alias("n"))


class _Chunks:
    """Some distinct chunks as arrays over their words."""

    def __init__(self, rows: pa.Table, hashes: _Hashes) -> None:
        chunks = rows.column("chunk").cast(pa.large_binary()).combine_chunks()
        # Every word is followed by a space, so the chunks in a row are words in a row.
        bounds = np.frombuffer(chunks.buffers()[1], dtype=np.int64)[chunks.offset:chunks.offset + len(chunks) + 1]
        self.text = chunks.buffers()[2].to_pybytes()[bounds[0]:bounds[-1]]
        found, starts, ends = _places(self.text)
        begin = np.searchsorted(starts, bounds - bounds[0])
        length = np.diff(begin)
        self.chunk = np.repeat(np.arange(len(length), dtype=np.int32), length)
        self.word = found[starts] != _STOP[0]
        self.mine = self.word & (np.arange(len(starts)) - begin[self.chunk] < rows.column("starts").to_numpy()[self.chunk])
        self.times = rows.column("n").to_numpy()[self.chunk]
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        self.langs, self.lang = langs.dictionary.to_pylist(), langs.indices.to_numpy().astype(np.int64)
        self.hashes, self.of_lang = hashes.within(found, starts, ends), hashes.of([x.encode().replace(b" ", _END) for x in self.langs])

    def buckets(self, most_words: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per phrase length: the places of all phrases, and their buckets."""
        now, whole = self.of_lang[self.lang][self.chunk], np.ones(len(self.word), dtype=bool)
        for k in range(1, most_words + 1):
            n = max(len(self.word) - k + 1, 0)
            now = _mixed(now[:n], self.hashes[k - 1:])
            whole = whole[:n] & self.word[k - 1:] & (self.chunk[:n] == self.chunk[k - 1:])
            at = np.flatnonzero(whole)
            yield k, at, now[at] >> np.uint64(64 - _BUCKET_BITS)


class _Numbers(dict):
    """Numbers of words in the order they come."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = len(self)
        return found


def _several(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to about ``_TALLIED`` bytes of chunks."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("chunk").nbytes
        if size >= _TALLIED:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _added(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of each distinct key, in the order of the keys, and the sums of their times."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=int)
    return order[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


def _tallies(batches: Iterator[pa.RecordBatch], most_words: int, enough: int) -> Iterator[pa.RecordBatch]:
    """Buckets in parts by their first bits: the other bits, as often as the bucket occurs, but ``enough`` times at most."""
    hashes = _Hashes()
    for rows in _several(batches):
        chunks = _Chunks(rows, hashes)
        # Bucket and count as one number, which sorts fast.
        times = np.minimum(chunks.times, enough).astype(np.uint64)
        keys = np.concatenate([(buckets[chunks.mine[at]] << np.uint64(8)) | times[at[chunks.mine[at]]] for _, at, buckets in chunks.buckets(most_words)])
        del chunks
        keys.sort()
        buckets, times = keys >> np.uint64(8), keys & np.uint64(255)
        first = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]][:len(buckets)])
        if not len(first):
            continue
        buckets = np.repeat(buckets[first], np.minimum(np.add.reduceat(times, first), enough).astype(np.int64))
        part = np.searchsorted(buckets, np.arange((1 << _PART_BITS) + 1, dtype=np.uint64) << np.uint64(_LOW_BITS))
        low = (buckets & np.uint64((1 << _LOW_BITS) - 1)).astype("<u4")
        some = np.flatnonzero(np.diff(part))
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array([low[part[i]:part[i + 1]].tobytes() for i in some.tolist()], pa.binary())], schema=_PARTS)


def _frequent_buckets(rows: pa.Table, enough: int) -> pa.Table:
    """Of one part, the buckets that occur ``enough`` times."""
    low = np.sort(np.frombuffer(b"".join(rows.column("buckets").to_pylist()), dtype="<u4"))
    last = low[enough - 1:]
    often = np.unique(last[last == low[:len(last)]]).astype(np.int64)
    return pa.table([often + (rows.column("part")[0].as_py() << _LOW_BITS)], schema=_BUCKETS)


def _kept(batches: Iterator[pa.RecordBatch], most_words: int, bits: np.ndarray, width: int) -> Iterator[pa.RecordBatch]:
    hashes = _Hashes()
    for rows in _several(batches):
        chunks, number = _Chunks(rows, hashes), _Numbers()
        words = chunks.text.split(b" ")[:-1]
        ids = np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words))

        def counted(k: int, at: np.ndarray) -> pa.RecordBatch:
            # Language and words as one number: phrases of equal numbers are equal.
            key, room = chunks.lang[chunks.chunk[at]], len(chunks.langs)
            for n in range(k):
                if room * len(number) >= 2 ** 62:
                    key = np.unique(key, return_inverse=True)[1].reshape(-1)
                    room = len(key) + 1
                key, room = key * len(number) + ids[at + n], room * len(number)
            first, total = _added(key, chunks.times[at])
            at = at[first]
            return pa.record_batch([pa.array([chunks.langs[i] for i in chunks.lang[chunks.chunk[at]].tolist()], pa.string()),
                                    pa.array([b" ".join(words[i:i + k]) for i in at.tolist()], pa.string()), pa.array(total, pa.int64())], schema=_PHRASES)

        may = np.ones(len(ids) + 1, dtype=bool)
        for k, at, buckets in chunks.buckets(most_words):
            low = (buckets & np.uint64(width - 1)).astype(np.int64)
            # Both phrases inside, one word shorter, may be frequent, and so may this one.
            found = at[(bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1]
            found = found[may[found] & may[found + (k > 1)]]
            may[:] = False
            may[found] = True
            yield counted(k, found[chunks.mine[found]])


def _bitmap(buckets: DataFrame) -> tuple[np.ndarray, int]:
    """Bits at the low part of every bucket's number. Its size follows the number of buckets, up to 2^_MOST_BITS bits."""
    n = buckets.count()
    width = 1 << min(_MOST_BITS, max(15, (64 * n).bit_length()))
    low = F.col("bucket").bitwiseAND(F.lit(width - 1))
    parts = (buckets.groupBy(F.shiftright(low, 15).alias("part"))
             .agg(F.bitmap_construct_agg(low.bitwiseAND(F.lit(0x7FFF))).alias("bits")))
    out = np.zeros(width // 8, dtype=np.uint8)
    for r in parts.toLocalIterator():
        out[r["part"] * 4096:(r["part"] + 1) * 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out, width


def frequent_phrases(parsed: DataFrame, least: int = LEAST_COUNT, most_words: int = MOST_WORDS) -> DataFrame:
    """``lang, phrase, f`` of all phrases of 1 to ``most_words`` words that occur ``least`` times or more.

    Phrases are first counted by buckets of their hashes, many in one row of the shuffle. A bucket below ``least`` holds no
    frequent phrase. Then only phrases whose bucket may be over it, and whose parts' buckets may be, are counted as what they
    are, so the counts are exact whatever the hashes do.
    """
    enough = max(1, min(least, _MOST_COUNTED))
    chunks = parsed.select("lang", "chunk", "starts", "n")
    buckets = stored(chunks.mapInArrow(lambda b: _tallies(b, most_words, enough), "part int, buckets binary")
                     .groupBy("part").applyInArrow(lambda rows: _frequent_buckets(rows, enough), "bucket bigint"))
    bits, width = _bitmap(buckets)
    shared = parsed.sparkSession.sparkContext.broadcast(bits)
    return (chunks.mapInArrow(lambda b: _kept(b, most_words, shared.value, width), "lang string, phrase string, n bigint")
            .groupBy("lang", "phrase").agg(F.sum("n").alias("f")).where(F.col("f") >= least))


def scored(frequent: DataFrame, sizes: DataFrame) -> DataFrame:
    """Candidates ``lang, phrase, a, l, r, n, score`` of phrase counts ``lang, phrase, f`` that hold every candidate's parts.

    The lowest-scoring cut counts, ties to the smallest first part.
    """
    of = lambda *names: frequent.select("lang", F.col("phrase").alias(names[0]), F.col("f").alias(names[1]))
    words = F.split("phrase", " ")
    k = F.col("k")
    cuts = (frequent.withColumn("w", words).where(F.size("w") >= 2)
            .select("lang", "phrase", F.col("f").alias("a"), "w", F.explode(F.sequence(F.lit(1), F.size("w") - 1)).alias("k"))
            .withColumns({"first": F.array_join(F.slice("w", F.lit(1), k), " "), "rest": F.array_join(F.slice("w", k + 1, F.size("w") - k), " ")}).drop("w"))
    counted = cuts.join(of("first", "l"), ["lang", "first"]).join(of("rest", "r"), ["lang", "rest"])
    # a <= l and a <= r, so the quotient is at most 1000000; the products are exact for counts up to 10^15.
    score = F.expr("(cast(a as decimal(16,0)) * cast(a as decimal(16,0)) * cast(1000000 as decimal(7,0))) div (cast(l as decimal(16,0)) * cast(r as decimal(16,0)))")
    lowest = counted.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    return lowest.join(sizes, "lang").select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST_COUNT, share: int = SHARE,
                 best: int = BEST, every: int = EVERY, longest: int = LONGEST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language that no longer phrase stands for."""
    parsed = stored(dictionary(docs, text, lang, every, longest))
    sizes = parsed.groupBy("lang").agg(F.sum(F.col("n") * F.col("own")).alias("n"))
    frequent = stored(frequent_phrases(parsed, least))
    inner = (F.transform(F.sequence(F.lit(2), F.size("w") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.size("w") - m + 1), lambda i: F.array_join(F.slice("w", i, m), " "))))
    around = (frequent.withColumn("w", F.split("phrase", " ")).where(F.size("w") >= 3)
              .select("lang", "f", F.explode(F.array_distinct(F.flatten(inner))).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("f").alias("f")))
    left = (scored(frequent, sizes).join(around, ["lang", "phrase"], "left")
            .where(F.col("f").isNull() | (F.col("f") * 100 < F.col("a") * share)).drop("f"))
    # The best of a language are among the best of its parts, so one task ranks _RANKED times ``best`` rows at most.
    order = lambda *by: Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    top = (left.withColumn("dealt", F.pmod(F.xxhash64("phrase"), F.lit(_RANKED)))
           .withColumn("rank", F.row_number().over(order("lang", "dealt"))).where(F.col("rank") <= best).drop("dealt"))
    return (top.withColumn("rank", F.row_number().over(order("lang"))).where(F.col("rank") <= best)
            .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
