"""Phrase collocations by dynamic itemset counting.

The documents are dealt to ``shards`` shards that are scanned in a cycle, one each step.  Words are counted from the first
step on.  A longer phrase becomes active at the step after the one in which both its subphrases (all words but the last, all
but the first) have reached ``min_count``, wherever in the cycle that is, and is counted until each shard has been scanned
once: lengths are interleaved, and a phrase of four words may start while rare pairs are still being counted.  The scans end
when no phrase is active.

*Which phrases are active* is tested at the text by a filter of FILTER_BITS bits that holds the phrases that have reached the
count, and a second one with those that reached it within the last cycle (others have been counted to the end).  Its size is
fixed; it never misses a phrase, so each active phrase is counted in full, and a wrong hit only costs a row.

*State* between steps is, for each phrase, its 64-bit hash, the count so far, and the step at which it reached the count,
packed in one row for each bucket of hashes and written to the shared folder; a scan's counts reach their bucket as packed
runs.  Buckets grow in number with the text.  Nothing of the corpus is held by the driver but the filters.  Phrases whose
length's cycles have ended below the count are dropped.  Two phrases with one hash, or a phrase counted beyond its cycle
after a wrong hit, can only seem too frequent; so a last scan names the phrases that reached the count and confirms their
counts by words.

Score, cuts and the removal of phrases inside longer ones are joins of the counted phrases.

Defined cases: a null text is empty, a null ``lang`` is ``und``; repeated rows count as often as they occur; ties are
broken by phrase; an empty table gives no row; further columns of any name are ignored.  Texts are cut at breaks into
chunks of CHUNK bytes; a single piece without any break may be longer and is then held whole by one task.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyspark.llm.shared import cleaned_shuffles, removed, written
from tallyspark.session import scratch_path

#: Bits of a filter of phrases; two are set for each phrase.
FILTER_BITS = 1 << 25
#: Bytes of text whose words are counted at once.
CHUNK = 1 << 24
#: Bytes of text for each bucket of phrase hashes, and the fewest buckets.
BUCKET_BYTES, BUCKETS = 1 << 22, 16
#: The low bits of a phrase's hash hold its length less one.
LENGTH_BITS = 3
#: Parts in which the first phrases of a language are chosen before they are ranked together.
RANK_PARTS = 64
BREAKS = bytes.maketrans(b".,;:!?\x0b\x0c\r", b"\n" * 9)
#: Stands for a break between words; no word once texts are lower-cased.
END = b"A"
ODD = np.uint64(0x9E3779B97F4A7C15)
#: Random weights of the bytes of a word.
WEIGHTS = np.random.default_rng(11).integers(0, 1 << 63, 1024, np.uint64) * np.uint64(2) + np.uint64(1)
#: Packed phrases of a bucket: hashes, counts, steps of reaching the count (-1: not yet), hashes that reached it last.
STATE = "bucket int, h binary, c binary, t binary, fresh binary"
NAMED = "bucket int, lang string, phrases array<string>, f array<bigint>"


# ------------------------------------------------------------------ in the tasks

def _pieces(text: bytes):
    """``text``, lower-cased and with its breaks as line feeds, in chunks that end at breaks."""
    text = text.lower().translate(BREAKS)
    start = 0
    while len(text) - start > CHUNK:
        cut = text.rfind(b"\n", start, start + CHUNK)
        if cut < 0:
            cut = text.find(b"\n", start + CHUNK)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut + 1
    yield text[start:]


def _mixed(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    h = (h ^ word) * ODD
    return h ^ (h >> np.uint64(29))


def _sealed(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of a phrase of ``n`` words."""
    h = (h ^ (h >> np.uint64(32))) * ODD
    return (h << np.uint64(LENGTH_BITS)) | np.uint64(n - 1)


def _positions(h):
    """The two bits of a hash in a filter."""
    mask = np.uint64(FILTER_BITS - 1)
    return (h >> np.uint64(LENGTH_BITS)) & mask, (h >> np.uint64(36)) & mask


def _word_hashes(words: pa.StringArray) -> np.ndarray:
    """A hash of each word from Arrow's buffers, all words at once."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]]
    starts, size = ends[:-1] - ends[0], np.diff(ends)
    place = np.arange(len(data)) - np.repeat(starts, size)
    sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * WEIGHTS[place & 1023], starts)
    return _mixed(sums, size.astype(np.uint64))


def _split(h: np.ndarray, buckets: int) -> np.ndarray:
    """Ends of the buckets (a power of two, by the first bits) in sorted hashes: ``buckets`` + 1 places."""
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    return np.append(np.searchsorted(h, np.arange(buckets, dtype=np.uint64) << shift), len(h))


def _inside(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    found = np.ones(len(h), bool)
    for at in _positions(h):
        found &= ((bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


class _Chunk:
    """Words of some texts of a language: ``at`` has the place of each word in ``words``, breaks are at place 0."""

    def __init__(self, lang: str, texts: list[bytes]):
        joined = (END + b" " + b"\n".join(texts)).replace(b"\n", b" " + END + b" ").rstrip()
        # Arrow splits and numbers the words; texts are valid UTF-8.
        coded = pc.ascii_split_whitespace(pa.array([joined], pa.binary()).view(pa.string())).flatten().dictionary_encode()
        self.lang, self.words, self.at = lang, coded.dictionary, coded.indices.to_numpy()
        seed = np.full(1, xxhash.xxh3_64_intdigest(lang.encode()), np.uint64)
        self.of_word = _word_hashes(self.words)
        self.first = _mixed(seed, self.of_word)

    def phrases(self, known: np.ndarray, longest: int, late: np.ndarray | None = None):
        """For each length from 2 on: places where a phrase starts whose subphrases are both in ``known``, one of them in
        ``late`` if that is given, and the phrases' hashes."""
        at, sealed = self.at, _sealed(self.first, 1)
        of = _inside(known, sealed)
        of[0] = False
        reached = of[at]
        newly = None if late is None else (of & _inside(late, sealed))[at]
        chain = self.first[at]
        for n in range(2, longest + 1):
            start = np.flatnonzero(reached[:-1] & reached[1:])
            if not len(start):
                return
            chain[start] = _mixed(chain[start], self.of_word[at[start + n - 1]])
            h = _sealed(chain[start], n)
            active = slice(None) if newly is None else newly[start] | newly[start + 1]
            yield n, start[active], h[active]
            if n < longest:
                held = _inside(known, h)
                reached = np.zeros(len(at), bool)
                reached[start] = held
                if newly is not None:
                    newly = np.zeros(len(at), bool)
                    newly[start] = held & _inside(late, h)

    def hashed_counts(self, known, late, with_words: bool, longest: int, buckets: int):
        """Counts of the active phrases by hash: a packed run for each bucket."""
        runs = []
        if with_words:
            runs.append((_sealed(self.first, 1)[1:], np.bincount(self.at, minlength=len(self.words))[1:]))
        runs += [np.unique(h, return_counts=True) for _, _, h in self.phrases(known, longest, late)]
        h, c = (np.concatenate(x) for x in zip(*runs)) if runs else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        order = np.argsort(h)
        h, c = h[order], c[order].astype(np.int64)
        ends = _split(h, buckets)
        full = np.flatnonzero(np.diff(ends))
        runs = [(h[ends[i]:ends[i + 1]].tobytes(), c[ends[i]:ends[i + 1]].tobytes()) for i in full]
        none = pa.nulls(len(full), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array([r[0] for r in runs], pa.binary()),
                                          pa.array([r[1] for r in runs], pa.binary()), none, none], names=["bucket", "h", "c", "t", "fresh"])

    def named_counts(self, known, longest: int, buckets: int):
        """Counts of the phrases in ``known`` by their words, and of all words under an empty phrase: a list for each bucket."""
        counts = np.bincount(self.at, minlength=len(self.words))
        sealed = _sealed(self.first, 1)
        held = 1 + np.flatnonzero(_inside(known, sealed)[1:])
        found = [(np.zeros(1, np.uint64), pa.array([""]), counts[1:].sum().reshape(1)), (sealed[held], self.words.take(pa.array(held)), counts[held])]
        for n, start, h in self.phrases(known, longest):
            own = _inside(known, h)
            place = start[own]
            if not len(place):
                continue
            code = self.at[place].astype(np.int64)
            for j in range(1, n):
                # Numbers of the phrases so far, and the next word: equal for equal words only.
                code = (np.unique(code, return_inverse=True)[1] if j > 1 else code) << 32 | self.at[place + j]
            _, seen, counts = np.unique(code, return_index=True, return_counts=True)
            parts = [self.words.take(pa.array(self.at[place[seen] + j])) for j in range(n)]
            found.append((h[own][seen], pc.binary_join_element_wise(*parts, " "), counts))
        h = np.concatenate([x[0] for x in found])
        order = np.argsort(h)
        ends = _split(h[order], buckets)
        full = np.flatnonzero(np.diff(ends))
        at = pa.array(np.append(ends[full], ends[-1]).astype(np.int32))
        phrases = pa.concat_arrays([x[1] for x in found]).take(pa.array(order))
        counts = np.concatenate([x[2] for x in found])[order].astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.repeat(pa.scalar(self.lang), len(full)), pa.ListArray.from_arrays(at, phrases),
             pa.ListArray.from_arrays(at, pa.array(counts))], names=["bucket", "lang", "phrases", "f"])


def _joined(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x, kind) for x in column.to_pylist()])


def _merge(step: int, min_count: int, shards: int):
    """Function for applyInArrow: the packed runs and the state of a bucket to its next state, one row."""
    def run(rows: pa.Table) -> pa.Table:
        h, c = _joined(rows["h"], np.uint64), _joined(rows["c"], np.int64)
        # Counts of this scan have no step.
        t = np.concatenate([np.full(len(x) // 8, -1, np.int32) if y is None else np.frombuffer(y, np.int32)
                            for x, y in zip(rows["h"].to_pylist(), rows["t"].to_pylist())])
        if not len(h):
            return rows.slice(0, 0)
        order = np.argsort(h)
        h, c, t = h[order], c[order], t[order]
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        h, c, t = h[first], np.add.reduceat(c, first), np.maximum.reduceat(t, first)
        fresh = (t < 0) & (c >= min_count)
        t = np.where(fresh, np.int32(step), t)
        n = (h & np.uint64((1 << LENGTH_BITS) - 1)).astype(np.int64) + 1
        kept = (t >= 0) | (n * shards - 1 > step)
        blobs = [pa.array([x.tobytes()], pa.binary()) for x in (h[kept], c[kept], t[kept], h[fresh])]
        return pa.table([rows["bucket"].combine_chunks()[:1], *blobs], names=["bucket", "h", "c", "t", "fresh"])
    return run


def _named(min_count: int):
    """Function for applyInArrow: the lists of a bucket to (lang, phrase, f), the rare ones left out."""
    def run(rows: pa.Table) -> pa.Table:
        size = pc.list_value_length(rows["phrases"]).to_numpy()
        lang = rows["lang"].combine_chunks().take(pa.array(np.repeat(np.arange(len(size)), size)))
        flat = pa.table([lang, pc.list_flatten(rows["phrases"]).combine_chunks(), pc.list_flatten(rows["f"]).combine_chunks()], names=["lang", "phrase", "f"])
        sums = flat.group_by(["lang", "phrase"]).aggregate([("f", "sum")])
        sums = sums.filter(pc.or_(pc.equal(sums["phrase"], ""), pc.greater_equal(sums["f_sum"], min_count)))
        return pa.table([sums["lang"], sums["phrase"], sums["f_sum"]], names=["lang", "phrase", "f"])
    return run


def _word_bits(batches):
    """Function for mapInArrow: packed hashes to the words of a filter that they set."""
    for rows in batches:
        at = np.concatenate([np.zeros(0, np.uint64), *(x for b in rows["fresh"].to_pylist() for x in _positions(np.frombuffer(b, np.uint64)))])
        at = np.unique(at)
        word = (at >> np.uint64(6)).astype(np.int64)
        first = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(at) else np.zeros(0, np.int64)
        bits = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first) if len(at) else at
        yield pa.RecordBatch.from_arrays([pa.array(word[first]), pa.array(bits.view(np.int64))], names=["word", "bits"])


def _scan(count):
    """Function for mapInArrow: (lang, text) rows to the batches of ``count(chunk)``, a chunk of texts of a language each."""
    def run(batches):
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}
        for rows in batches:
            for lang, text in zip(rows["lang"].to_pylist(), rows["text"].cast(pa.binary()).to_pylist()):
                for piece in _pieces(text):
                    held.setdefault(lang, []).append(piece)
                    size[lang] = size.get(lang, 0) + len(piece) + 1
                    if size[lang] >= CHUNK:
                        size.pop(lang)
                        yield from count(_Chunk(lang, held.pop(lang)))
                if sum(size.values()) >= 2 * CHUNK:
                    for other in list(held):
                        yield from count(_Chunk(other, held.pop(other)))
                    size = {}
        for lang, texts in held.items():
            yield from count(_Chunk(lang, texts))
    return run


# ------------------------------------------------------------------ the cyclic scans

def _bits(spark: SparkSession, state: DataFrame) -> tuple[np.ndarray, int]:
    """The filter of the phrases that reached the count last, and its set words: at most FILTER_BITS / 64 reach the driver."""
    words = (state.select("fresh").mapInArrow(_word_bits, "word bigint, bits bigint")
             .groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow())
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy().view(np.uint64)
    return out, words.num_rows


def _dealt(docs: DataFrame, shards: int) -> tuple[DataFrame, int]:
    """(lang, text, shard), written once, each shard in a folder of its own, and the number of buckets of phrases.
    Copies of a text go to all shards."""
    path, seen = scratch_path(docs.sparkSession, "collocation-shards"), Observation()
    (docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"),
                 F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int").alias("shard"))
     .observe(seen, F.sum(F.octet_length("text").cast("bigint")).alias("size")).write.partitionBy("shard").parquet(path))
    buckets = max(BUCKETS, 1 << ((seen.get["size"] or 0) // BUCKET_BYTES).bit_length())
    return docs.sparkSession.read.schema("lang string, text string, shard int").parquet(path), buckets


def _reached(dealt: DataFrame, buckets: int, min_count: int, longest: int, shards: int) -> np.ndarray:
    """The cyclic scans: a filter of all words and phrases that reached ``min_count``."""
    spark = dealt.sparkSession
    grown: list[tuple[np.ndarray, int]] = []
    known = np.zeros(FILTER_BITS // 64, np.uint64)
    state, state_path = spark.createDataFrame([], STATE), None
    step = 0
    while step < shards or any(n for _, n in grown[-shards:]):
        late = None if step <= shards else reduce(np.bitwise_or, [b for b, _ in grown[-shards:]])
        filters = spark.sparkContext.broadcast((known, late))
        scan = _scan(lambda chunk, f=filters, w=step < shards: chunk.hashed_counts(*f.value, w, longest, buckets))
        runs = dealt.filter(F.col("shard") == step % shards).select("lang", "text").mapInArrow(scan, STATE)
        next_path = scratch_path(spark, "collocation-state")
        state.unionByName(runs).groupBy("bucket").applyInArrow(_merge(step, min_count, shards), STATE).write.parquet(next_path)
        if state_path is not None:
            removed(spark, state_path)
        state_path = next_path
        state = spark.read.schema(STATE).parquet(state_path)
        grown.append(_bits(spark, state))
        known = known | grown[-1][0]
        filters.unpersist()
        step += 1
    return known


def frequent_phrases(docs: DataFrame, min_count: int = 30, longest: int = 4, shards: int = 3) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, words, f) for every word and phrase with f >= ``min_count``, and (lang, n) with all word occurrences."""
    if not 2 <= longest <= 1 << LENGTH_BITS:
        raise ValueError(f"longest must be from 2 to {1 << LENGTH_BITS}")
    spark = docs.sparkSession
    dealt, buckets = _dealt(docs, shards)
    known = spark.sparkContext.broadcast(_reached(dealt, buckets, min_count, longest, shards))
    named = dealt.select("lang", "text").mapInArrow(_scan(lambda chunk: chunk.named_counts(known.value, longest, buckets)), NAMED)
    counted = written(named.groupBy("bucket").applyInArrow(_named(min_count), "lang string, phrase string, f bigint"), "collocation-named")
    words = F.expr("length(phrase) - length(replace(phrase, ' ', '')) + 1").cast("int")
    phrases = counted.filter("phrase <> ''").select("lang", "phrase", words.alias("words"), "f")
    return phrases, counted.filter("phrase = ''").select("lang", F.col("f").alias("n"))


# ------------------------------------------------------------------ scores

def scored(phrases: DataFrame) -> DataFrame:
    """Candidates (lang, phrase, words, a, l, r, score) of counted phrases: the lowest cut, none inside a longer one that has 80 % of it."""
    parts = phrases.select("lang", "phrase", "f")
    cuts = (phrases.filter("words > 1").withColumnRenamed("f", "a").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("head", F.expr("substring_index(phrase, ' ', k)")).withColumn("tail", F.expr("substring_index(phrase, ' ', k - words)"))
            .join(parts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l")), ["lang", "head"])
            .join(parts.select("lang", F.col("phrase").alias("tail"), F.col("f").alias("r")), ["lang", "tail"]))
    score = F.expr("(cast(a as decimal(20, 0)) * 2000000BD) div (cast(l as decimal(20, 0)) + cast(r as decimal(20, 0)))")
    best = (cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")))
    inner = F.expr("""flatten(transform(sequence(2, words - 1), m -> transform(sequence(0, words - m),
                      i -> array_join(slice(split(phrase, ' '), i + 1, m), ' '))))""")
    within = (phrases.filter("words > 2").select("lang", F.col("f").alias("longer"), F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("longer").alias("longer")))
    kept = best.join(within, ["lang", "phrase"], "left").filter(
        F.coalesce(F.expr("cast(longer as decimal(20, 0)) * 100 < cast(a as decimal(20, 0)) * 80"), F.lit(True)))
    return kept.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, min_count: int = 30, longest: int = 4, shards: int = 3, top: int = 2000) -> DataFrame:
    """The first ``top`` phrases of each language by score, count and phrase: lang, rank, phrase, a, l, r, n, score."""
    with cleaned_shuffles(docs.sparkSession):
        phrases, sizes = frequent_phrases(docs, min_count, longest, shards)
        found = written(scored(phrases), "collocation-scored")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # No task ranks all phrases of a language: the first of every part are ranked together.
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    first = (found.withColumn("part", part).withColumn("p", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
             .filter(F.col("p") <= top))
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(min_count: int = 30, top: int = 2000) -> str:
    """DuckDB SQL of ``collocations`` over ``documents``: all phrases of up to four words counted."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{lower}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
spaced AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
counted AS (
  SELECT lang, m, phrase, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
    FROM spaced, (SELECT unnest([1, 2, 3, 4]) AS m) lengths) x
  GROUP BY lang, m, phrase),
sizes AS (SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang),
frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE f >= {min_count}),
cuts AS (
  SELECT p.lang, p.m, p.phrase, p.f AS a, k, x.f AS l, y.f AS r, (2000000::HUGEINT * p.f) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM frequent WHERE m > 1) p
  JOIN frequent x ON x.lang = p.lang AND x.phrase = array_to_string(p.w[1:k], ' ')
  JOIN frequent y ON y.lang = p.lang AND y.phrase = array_to_string(p.w[k + 1:p.m], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
covered AS (
  SELECT DISTINCT b.lang, b.phrase FROM best b JOIN best c
  ON c.lang = b.lang AND c.m > b.m AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' ') AND 100 * c.a >= 80 * b.a),
kept AS (SELECT * FROM best ANTI JOIN covered USING (lang, phrase)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
       CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN sizes USING (lang) WHERE rank <= {top}"""
