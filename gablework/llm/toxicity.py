"""Toxicity by compression distance: how many bytes a toxic dictionary saves over an ordinary one.

Training picks dictionary content for either class from labelled rows: word beginnings that are
significantly more frequent in toxic texts (counted once per preceding word, so that copies of
one text weigh as one), and the commonest words of ordinary texts. The ordinary dictionary is
the common words; the toxic one has the toxic pieces besides, in place of filler of equal
length, so that distances of common matches are the same in both. A text is cut into windows of words,
each window is compressed under both dictionaries with zstandard, and the largest difference
in length, calibrated on the training rows by monotone regression, is the score.

Defined cases: null and empty texts have no window and get the score of a difference of zero; without any toxic
training row all scores are 0; repeated rows get equal scores; labels that are null are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.pretokens import text_batches

LEAST_PIECE, MOST_PIECE = 4, 10  # characters of a word beginning
LEAD = 24  # bytes of known text before each window, so that every window compresses


@dataclass(frozen=True)
class ToxicityModel:
    toxic: bytes
    ordinary: bytes
    lead: bytes
    scores: tuple[float, ...]  # by largest difference, from 0 up
    window: int = 8

    def differences(self, text: str) -> list[int]:
        toxic, ordinary = _compressors(self)
        words = text.lower().split()
        found = []
        for i in range(0, len(words), self.window):
            part = self.lead + " ".join(["", *words[i : i + self.window], ""]).encode("utf-8", "replace")
            found.append(len(ordinary.compress(part)) - len(toxic.compress(part)))
        return found

    def score(self, differences: list[int]) -> float:
        """The calibrated score; within a step of it, more evidence in other windows counts."""
        if not self.scores:
            return 0.0
        top = min(max([0, *differences]), len(self.scores) - 1)
        low, high = self.scores[top], self.scores[min(top + 1, len(self.scores) - 1)]
        more = sum(d for d in differences if d >= 2)
        return min(1.0, low + (high - low) * 0.9 * more / (more + 40.0))


@lru_cache(maxsize=4)
def _compressors(model: ToxicityModel):
    import zstandard

    def of(content: bytes):
        settings = zstandard.ZstdCompressionParameters(
            window_log=17, chain_log=14, hash_log=15, search_log=1, min_match=5, target_length=0, strategy=1,
            write_content_size=False, write_dict_id=False, write_checksum=False,
        )
        dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)

    return of(model.toxic), of(model.ordinary)


def _word_pairs(rows: DataFrame) -> DataFrame:
    """Distinct (preceding word, word, label) of the training rows."""
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), r"[\s.,!?;:*#$%&|\"()]+", " "))
    words = rows.select("toxic", F.split(plain, " ").alias("words"))
    pairs = words.select(
        "toxic",
        F.explode(
            F.transform(
                "words",
                lambda w, i: F.struct(F.coalesce(F.get("words", i - 1), F.lit("")).alias("before"), w.alias("word")),
            )
        ).alias("pair"),
    )
    return pairs.select("toxic", "pair.*").filter(F.length("word") > 0).distinct()


def _toxic_pieces(pairs: DataFrame, most: int) -> list[tuple[str, int, float]]:
    """Word beginnings significantly more frequent in toxic text: piece, toxic count, evidence."""
    long = pairs.filter(F.length("word") >= LEAST_PIECE)
    sizes = F.sequence(F.lit(LEAST_PIECE), F.least(F.length("word"), F.lit(MOST_PIECE)))
    counts = (
        long.select("toxic", F.explode(F.transform(sizes, lambda k: F.substring("word", F.lit(1), k))).alias("piece"))
        .groupBy("piece")
        .agg(F.sum("toxic").alias("k"), F.sum(1 - F.col("toxic")).alias("m"))
    )
    totals = long.agg(F.sum("toxic").alias("t"), F.count(F.lit(1)).alias("n")).first()
    kinds = counts.filter("k > 0").count()
    if not totals["t"] or totals["t"] == totals["n"]:
        return []
    p = totals["t"] / totals["n"]
    share = F.col("k") / (F.col("k") + F.col("m"))
    evidence = F.col("k") * F.log(share / p) + F.when(F.col("m") > 0, F.col("m") * F.log((1 - share) / (1 - p))).otherwise(0.0)
    found = (
        counts.filter("k > 0")
        .withColumn("evidence", evidence)
        .filter((share > 0.6) & (F.col("evidence") >= math.log(max(kinds, 2)) + 2))
        .orderBy(F.desc("evidence"), "piece")
        .limit(most)
    )
    return [(r["piece"], int(r["k"]), r["evidence"]) for r in found.collect()]


def _select(found: list[tuple[str, int, float]], bytes_: int) -> bytes:
    """The shortest significant beginnings, each drawn out while it keeps half its occurrences."""
    counts = {w: k for w, k, _ in found}
    chosen = []
    for w, k, evidence in found:
        if not any(w[:n] in counts for n in range(LEAST_PIECE, len(w))):
            longer = [x for x in counts if x.startswith(w) and counts[x] * 2 >= k]
            chosen.append((evidence, max(longer, key=lambda x: (len(x), x))))
    content = b""
    for _, w in sorted(chosen, reverse=True):  # strongest nearest to the end
        piece = f" {w}".encode()
        if len(content) + len(piece) < bytes_:
            content = piece + content
    if not content:
        return b""
    # The fast match finder indexes every third place of a dictionary and not its last bytes, so the
    # pieces stand there three times, a byte apart in phase, and some blanks follow.
    content += b" " * ((1 - len(content)) % 3)
    return content * 3 + b" " * 16


def _monotone(totals: list[float], hits: list[float]) -> list[float]:
    """Hit rates by step made non-decreasing by pooling neighbours (isotonic regression)."""
    pools: list[list[float]] = []
    for n, k in zip(totals, hits):
        pools.append([n, k, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n2, k2, c2 = pools.pop()
            pools[-1] = [pools[-1][0] + n2, pools[-1][1] + k2, pools[-1][2] + c2]
    return [k / n for n, k, c in pools for _ in range(int(c))]


def fit(
    train: DataFrame,
    most_rows: int = 8_000,
    toxic_bytes: int = 4_096,
    ordinary_bytes: int = 16_000,
    most_pieces: int = 2_000,
) -> ToxicityModel:
    """Learn dictionaries and calibration from rows of ``text`` and ``toxic`` (0 or 1).

    Training reads a sample of about ``most_rows`` rows, chosen by a hash of the text; what
    reaches the driver are dictionary pieces and counts by step, both bounded.
    """
    usable = train.filter(F.col("toxic").isNotNull()).select("text", F.col("toxic").cast("int").alias("toxic"))
    rows = usable.count()
    if rows > most_rows:
        place = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1_000_000))
        usable = usable.filter(place < F.lit(int(1_000_000 * most_rows / rows) + 1))
    usable = usable.persist()
    try:
        pairs = _word_pairs(usable).persist()
        toxic = _select(_toxic_pieces(pairs, most_pieces), toxic_bytes)
        common = (
            pairs.filter("toxic = 0").groupBy("word").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "word").limit(4_000)
        )
        words = [r["word"] for r in common.collect()]
        pairs.unpersist()
        base = " ".join(words).encode()[:ordinary_bytes]
        lead = base[100 : 100 + LEAD]
        if not toxic:
            return ToxicityModel(base, base, lead, ())
        draft = ToxicityModel(base + toxic, base + b"~" * len(toxic), lead, (0.0,))
        steps = (
            score_rows(usable, draft, ["toxic"]).groupBy("largest", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
        )
    finally:
        usable.unpersist()
    last = max(r["largest"] for r in steps)
    totals, hits = [0.02] * (last + 1), [0.01] * (last + 1)
    for r in steps:
        totals[r["largest"]] += r["n"]
        hits[r["largest"]] += r["n"] * r["toxic"]
    return ToxicityModel(draft.toxic, draft.ordinary, lead, tuple(_monotone(totals, hits)))


def score_rows(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns, ``score``, and ``largest``: the largest difference in bytes."""
    fields = ", ".join([*[f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep], "score double, largest int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in text_batches(batch, text):
                found = [model.differences(t) for t in texts]
                rows = batch.slice(first, len(texts))
                scores = pa.array([model.score(d) for d in found], pa.float64())
                largest = pa.array([max([0, *d]) for d in found], pa.int32())
                yield pa.RecordBatch.from_arrays([*[rows.column(c) for c in keep], scores, largest], [*keep, "score", "largest"])

    return docs.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*keep, text])]).mapInArrow(run, fields)


def held_out(key: str) -> Column:
    """One row in five, by the checksum of the key as text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 0
