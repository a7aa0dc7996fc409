"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

A text is a weighted set of five-word shingles (letters and digits in one case). A shingle weighs
how often it occurs times the mean inverse document frequency of its words; frequencies are
counted over all documents, in a fixed number of hashed slots, so the table does not grow. Word
rather than shingle frequencies keep a passage's weight the same however many near copies it has.

Consistent weighted sampling (Ioffe 2010) draws samples that agree with chance equal to the
weighted Jaccard similarity. Samples are banded; texts that agree in a band, or in two adjacent
bands, are candidates. Small groups are compared in full. In a large one each member is first compared with two
representatives, the member that meets most others in all bands (the middle of a cluster of near copies) and one
chosen by hash, different from band to band. What that leaves apart is settled exactly, by a prefix-filter join over
the members of large groups: shingles in one order for all texts, rare ones first, and the least of them that any
partner at the threshold must share. Only pairs that no links connect so far are made there. Pairs whose samples rule
out the threshold are left out, the others verified by the exact weighted Jaccard similarity of the whole texts.
Classes are the connected components of verified links.

Defined cases: exact copies are one text from the start; null text counts as empty; texts under five words
have no shingle and are near-duplicates of their exact copies alone; of rows with equal key and text one stays;
null keys come after all others; columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gablework.llm.components import components
from gablework.llm.distinct import distinct_texts, text_key
from gablework.llm.pretokens import text_batches
from gablework.llm.words import BASE, OTHER, PLAIN, mix, split
from gablework.sources.scratch import materialize


@dataclass(frozen=True)
class NearDup:
    shingle: int = 5
    similarity: float = 0.8
    bands: int = 14
    rows: int = 4
    slots: int = 1 << 16  # document frequencies
    full: int = 8  # members of a group up to which all its pairs are compared
    shingle_slots: int = 1 << 20  # how common shingles are; sets only the order in which they are joined
    share: int = 2000  # pairs of one text that a task takes; more are dealt over tasks
    # Samples must agree at least this much to be verified: over five standard deviations below the threshold.
    least_agreement: float = 0.5

    @property
    def samples(self) -> int:
        return self.bands * self.rows


class Sampler:
    """Weighted shingles and their consistent samples. Random variates come from tables by bits of the hash."""

    TABLE = 4096

    def __init__(self, rules: NearDup, idf: np.ndarray):
        self.rules, self.idf = rules, idf
        random = np.random.default_rng(11)
        r = random.gamma(2.0, 1.0, self.TABLE)
        self.r, self.inverse = r.astype(np.float32), (1 / r).astype(np.float32)
        self.log_c = np.log(random.gamma(2.0, 1.0, self.TABLE)).astype(np.float32)
        self.beta = random.random(self.TABLE).astype(np.float32)
        self.keys = random.integers(1, 1 << 63, rules.samples, dtype=np.uint64) | np.uint64(1)

    def weigh(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles of all texts, text after text: text, hash, weight."""
        size = self.rules.shingle
        words = split(texts, OTHER, PLAIN)
        n = len(words.hashes)
        counts = np.maximum(np.diff(words.first) - size + 1, 0)
        at = np.arange(counts.sum()) + np.repeat(words.first[:-1] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts)
        if not len(at):
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.float32)
        hashes = words.runs(words.prefix(BASE), BASE, at, np.full(len(at), size))
        rarity = np.concatenate([[0.0], np.cumsum(self.idf[(words.hashes % np.uint64(len(self.idf))).astype(np.int64)], dtype=np.float64)])
        weight = (rarity[at + size] - rarity[at]) / size
        text = np.repeat(np.arange(len(texts)), counts)
        order = np.lexsort((hashes, text))
        text, hashes, weight = text[order], hashes[order], weight[order]
        new = np.ones(len(text), bool)
        new[1:] = (text[1:] != text[:-1]) | (hashes[1:] != hashes[:-1])
        first = np.flatnonzero(new)
        times = np.diff(np.append(first, len(text)))
        return text[first], hashes[first], (weight[first] * times).astype(np.float32)

    def sample(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Sample values per text (row) and sample (column), and whether a text has any shingle."""
        text, hashes, weight = self.weigh(texts)
        out = np.zeros((len(texts), self.rules.samples), np.uint64)
        present = np.bincount(text, minlength=len(texts)) > 0
        if not len(text):
            return out, present
        first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
        sizes = np.diff(np.append(first, len(text)))
        owner = text[first]
        log_w = np.log(weight)
        for k, key in enumerate(self.keys):
            bits = hashes * key
            i = (bits >> np.uint64(52)).astype(np.int64)
            j = ((bits >> np.uint64(40)) & np.uint64(4095)).astype(np.int64)
            r, beta = self.r[i], self.beta[j]
            t = np.floor(log_w * self.inverse[i] + beta)
            log_a = self.log_c[((bits >> np.uint64(28)) & np.uint64(4095)).astype(np.int64)] - r * (t - beta) - r
            least = np.minimum.reduceat(log_a, first)
            hits = np.flatnonzero(log_a == np.repeat(least, sizes))
            # Of shingles tied by the tables, the one with the least hash: they lie in that order.
            hits = hits[np.unique(text[hits], return_index=True)[1]]
            out[owner, k] = mix(hashes[hits] ^ mix(t[hits].astype(np.int64).view(np.uint64)))
        return out, present

    def similarity(self, a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
        _, x, y = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
        both = float(np.minimum(a[1][x], b[1][y]).sum())
        union = float(a[1].sum() + b[1].sum()) - both
        return both / union if union else 0.0


def document_frequencies(texts: DataFrame, rules: NearDup) -> np.ndarray:
    """Inverse document frequency by slot, over all documents; ``slots`` numbers reach the driver."""
    slots = rules.slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        docs = 0
        for batch in batches:
            copies = np.array(batch.column("copies").to_pylist(), np.int64)
            docs += int(copies.sum())
            for first, found in text_batches(batch):
                words = split([t.encode() for t in found], OTHER, PLAIN)
                text = np.repeat(np.arange(len(found)), np.diff(words.first))
                seen = np.unique(text * slots + (words.hashes % np.uint64(slots)).astype(np.int64))
                counts += np.bincount(seen % slots, weights=copies[first + seen // slots], minlength=slots).astype(np.int64)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1)), pa.array(np.append(counts[used], docs))], ["slot", "n"])

    rows = texts.select("text", "copies").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(slots)
    total = 0
    for row in rows:
        if row["slot"] < 0:
            total = row["n"]
        else:
            counts[row["slot"]] = row["n"]
    return (1.0 + np.log((1.0 + total) / (1.0 + counts))).astype(np.float32)


def _signatures(texts: DataFrame, sampler: Sampler) -> DataFrame:
    rules = sampler.rules

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in text_batches(batch):
                samples, present = sampler.sample([t.encode() for t in found])
                kept = np.flatnonzero(present)
                samples = samples[kept]
                bands = np.zeros((len(kept), rules.bands), np.uint64)
                for b in range(rules.bands):
                    value = np.full(len(kept), b + 1, np.uint64)
                    for k in range(b * rules.rows, (b + 1) * rules.rows):
                        value = mix(value * np.uint64(3) + samples[:, k])
                    bands[:, b] = value
                # Two adjacent bands together: finer groups inside large ones.
                double = mix(bands * np.uint64(5) + np.roll(bands, -1, axis=1))
                keys = np.concatenate([bands, double], axis=1).view(np.int64)
                small = (samples & np.uint64(0x7FFFFFFF)).astype(np.int32)
                take = pa.array(kept + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k1").take(take),
                        batch.column("k2").take(take),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel())),
                        pa.ListArray.from_arrays(pa.array(np.arange(len(kept) + 1, dtype=np.int32) * small.shape[1]), pa.array(small.ravel())),
                    ],
                    ["k1", "k2", "keys", "samples"],
                )

    return texts.select("k1", "k2", "text").mapInArrow(run, "k1 bigint, k2 bigint, keys array<bigint>, samples array<int>")


def _ordered(a: Column, b: Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _candidates(signatures: DataFrame, rules: NearDup) -> tuple[DataFrame, DataFrame]:
    """Pairs ``(a, b)`` of text keys, and the keys of all members of large groups.

    Pairs are all of a small group, and a member and a representative of a large one.
    """
    me = F.struct("k1", "k2")
    rows = signatures.select("k1", "k2", F.explode("keys").alias("key"))
    groups = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = materialize(rows.join(groups, "key"), "groups")
    small = shared.filter(F.col("n") <= rules.full).groupBy("key").agg(F.collect_list(me).alias("all"))
    whole = small.select("all", F.explode("all").alias("a")).select("a", F.explode("all").alias("b")).filter("a < b")
    large = shared.filter(F.col("n") > rules.full)
    central = shared.groupBy("k1", "k2").agg(F.sum("n").alias("c"))
    ranked = large.join(central, ["k1", "k2"]).select("key", "c", me.alias("a"))
    speakers = ranked.groupBy("key").agg(
        F.max(F.struct("c", "a")).alias("middle"), F.min(F.struct(F.xxhash64("key", "a"), "a")).alias("other")
    )
    spread = ranked.join(speakers.select("key", F.array("middle.a", "other.a").alias("speakers")), "key")
    pairs = spread.select("a", F.explode("speakers").alias("b")).filter("a <> b")
    pairs = whole.union(pairs.select(*_ordered(F.col("a"), F.col("b")))).distinct()
    return pairs, large.select("k1", "k2").distinct()


def _shingle_counts(texts: DataFrame, sampler: Sampler) -> np.ndarray:
    """In how many texts the shingles of each slot occur; ``shingle_slots`` numbers reach the driver."""
    slots = sampler.rules.shingle_slots

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(slots, np.int64)
        for batch in batches:
            for _, found in text_batches(batch):
                _, hashes, _ = sampler.weigh([t.encode() for t in found])
                counts += np.bincount((hashes % np.uint64(slots)).astype(np.int64), minlength=slots)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["slot", "n"])

    found = texts.select("text").mapInArrow(run, "slot bigint, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(slots, np.float32)
    counts[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return counts


def _prefixes(texts: DataFrame, sampler: Sampler, counts: np.ndarray) -> DataFrame:
    """The rarest shingles of each text, as many as hold more than what a partner may miss.

    ``rest`` is the weight of a shingle and all after it. The first shingle two texts share bounds what they share to
    the lesser rest; texts of weights v and w at similarity t share at least t (v + w) / (1 + t). So the rest is at least
    t times the own weight, and in the lighter text (``lead``) 2 t / (1 + t) times.
    """
    t = sampler.rules.similarity - 1e-4  # sums are rounded
    slots = np.uint64(sampler.rules.shingle_slots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, found in text_batches(batch):
                text, hashes, weight = sampler.weigh([x.encode() for x in found])
                order = np.lexsort((hashes, counts[(hashes % slots).astype(np.int64)], text))
                text, hashes, weight = text[order], hashes[order], weight[order].astype(np.float64)
                total = np.bincount(text, weights=weight, minlength=len(found))
                before = np.concatenate([[0.0], np.cumsum(weight)])[:-1]
                start = np.concatenate([[0.0], np.cumsum(total)])[:-1]
                rest = total[text] - (before - start[text])
                kept = np.flatnonzero(rest >= t * total[text])
                take = pa.array(text[kept] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k1").take(take),
                        batch.column("k2").take(take),
                        batch.column("root").take(take),
                        pa.array(hashes[kept].view(np.int64)),
                        pa.array(rest[kept]),
                        pa.array(total[text[kept]]),
                        pa.array(rest[kept] >= 2 * t / (1 + t) * total[text[kept]]),
                    ],
                    ["k1", "k2", "root", "hash", "rest", "weight", "lead"],
                )

    fields = "k1 bigint, k2 bigint, root struct<k1:bigint,k2:bigint>, hash bigint, rest double, weight double, lead boolean"
    return texts.select("k1", "k2", "text", "root").mapInArrow(run, fields)


def _apart(members: DataFrame, texts: DataFrame, links: DataFrame, sampler: Sampler) -> DataFrame:
    """All pairs ``(a, b)`` of members that may reach the threshold and that no links connect.

    Shingles whose texts are all connected go first. Of the others, components are paired by the bounds of their
    members, then members with components that may hold a partner, then members, so the rows made are the
    pairs that are asked for.
    """
    roots = components(links).select(F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"), "root")
    known = members.join(roots, ["k1", "k2"], "left").withColumn("root", F.coalesce("root", F.struct("k1", "k2")))
    chosen = materialize(texts.select("k1", "k2", "text").join(known, ["k1", "k2"]), "members")
    prefixes = materialize(_prefixes(chosen, sampler, _shingle_counts(chosen, sampler)), "prefixes")
    split_ = prefixes.groupBy("hash").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("lead").alias("lead"))
    rows = materialize(prefixes.join(split_.filter("lead and low <> high").select("hash"), "hash"), "open")
    c = (sampler.rules.similarity - 1e-4) / (1 + sampler.rules.similarity - 1e-4)
    # A pair needs rest >= c (wa + wb) on both sides, so slack >= c times the other's weight; a is the lighter text.
    open_ = rows.withColumn("slack", F.col("rest") - F.lit(c) * F.col("weight"))
    ends = open_.groupBy("hash", "root").agg(
        F.max("slack").alias("head"),
        F.min("weight").alias("light"),
        F.max("weight").alias("heavy"),
        F.max(F.when(F.col("lead"), F.col("slack"))).alias("lead_head"),
        F.min(F.when(F.col("lead"), F.col("weight"))).alias("lead_light"),
    )
    one = ends.filter("lead_light is not null").select("hash", F.col("root").alias("ra"), "lead_head", "lead_light")
    two = ends.select("hash", F.col("root").alias("rb"), "head", "light", "heavy")
    meeting = one.join(two, "hash").filter(
        (F.col("ra") != F.col("rb"))
        & (F.col("lead_light") <= F.col("heavy"))
        & (F.col("lead_head") >= F.lit(c) * F.greatest("light", "lead_light"))
        & (F.col("head") >= F.lit(c) * F.col("lead_light"))
    )
    leads = open_.filter("lead").select("hash", F.col("root").alias("ra"), F.struct("k1", "k2").alias("a"), F.col("slack").alias("xa"), F.col("weight").alias("wa"))
    others = open_.select("hash", F.col("root").alias("rb"), F.struct("k1", "k2").alias("b"), F.col("slack").alias("xb"), F.col("weight").alias("wb"))
    reached = meeting.select("hash", "ra", "rb", "head", "light", "heavy").join(leads, ["hash", "ra"]).filter(
        (F.col("wa") <= F.col("heavy")) & (F.col("xa") >= F.lit(c) * F.greatest("light", "wa")) & (F.col("head") >= F.lit(c) * F.col("wa"))
    )
    pairs = reached.select("hash", "rb", "a", "xa", "wa").join(others, ["hash", "rb"]).filter(
        (F.col("wa") <= F.col("wb")) & (F.col("xa") >= F.lit(c) * F.col("wb")) & (F.col("xb") >= F.lit(c) * F.col("wa"))
    )
    return pairs.select(*_ordered(F.col("a"), F.col("b"))).distinct()


def _hot(pairs: DataFrame, on: list[str], rules: NearDup) -> DataFrame | None:
    """Texts with many of the (written) pairs at one end, and over how many ``parts`` to deal them; none: None.

    Each holds a thousandth of the pairs or more, so there are 1,000 at most, with 2,000 parts in all, whatever the input.
    """
    share = max(rules.share, pairs.count() // 1000)
    counts = pairs.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > share)
    many = materialize(counts.select(*on, F.ceil(F.col("n") / share).cast("int").alias("parts")), "hot")
    return None if many.isEmpty() else F.broadcast(many)


def _beside(pairs: DataFrame, rows: DataFrame, on: list[str], other: list[str], many: DataFrame | None) -> DataFrame:
    """``pairs`` joined to the rows of their texts ``on`` one end.

    The row of a text with many pairs, such as the representative of a large group, is copied, and its pairs are dealt
    over the copies by their ``other`` end. All other rows are joined where they are.
    """
    if many is None:
        return pairs.join(rows, on)
    cold = pairs.join(many, on, "left_anti").join(rows, on)
    part = F.pmod(F.xxhash64(*other), F.col("parts")).cast("int").alias("part")
    hot = pairs.join(many, on).select(*pairs.columns, part)
    copies = rows.join(many, on).select(*rows.columns, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    return cold.unionByName(hot.join(copies, [*on, "part"]).drop("part"))


def _agreeing(pairs: DataFrame, signatures: DataFrame, rules: NearDup) -> DataFrame:
    """Pairs whose samples do not rule out the threshold."""
    samples = signatures.select(F.struct("k1", "k2").alias("node"), "samples")
    one = samples.select(F.col("node").alias("a"), F.col("samples").alias("sa"))
    two = samples.select(F.col("node").alias("b"), F.col("samples").alias("sb"))
    equal = F.aggregate(
        F.zip_with("sa", "sb", lambda x, y: F.when(x == y, F.lit(1)).otherwise(F.lit(0))), F.lit(0), lambda s, x: s + x
    )
    pairs = materialize(pairs, "candidates")
    joined = _beside(pairs, one, ["a"], ["b"], _hot(pairs, ["a"], rules))
    joined = _beside(joined, two, ["b"], ["a"], _hot(pairs, ["b"], rules))
    return joined.filter(equal >= F.lit(int(rules.samples * rules.least_agreement))).select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame, sampler: Sampler) -> DataFrame:
    """Written pairs with at least the similarity asked for, by the whole texts."""
    rules = sampler.rules
    fields = "a1 bigint, a2 bigint, b1 bigint, b2 bigint, similarity double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)
        for batch in batches:
            keys = [batch.column(c) for c in ("a1", "a2", "b1", "b2")]
            found = []
            for i in range(batch.num_rows):
                b = (keys[2][i].as_py(), keys[3][i].as_py())
                if last[0] != b:
                    last = (b, sampler.weigh([batch.column("tb")[i].as_py().encode()])[1:])
                found.append(sampler.similarity(sampler.weigh([batch.column("ta")[i].as_py().encode()])[1:], last[1]))
            yield pa.RecordBatch.from_arrays([*keys, pa.array(found, pa.float64())], ["a1", "a2", "b1", "b2", "similarity"])

    flat = pairs.select(F.col("a.k1").alias("a1"), F.col("a.k2").alias("a2"), F.col("b.k1").alias("b1"), F.col("b.k2").alias("b2"))
    one = texts.select(F.col("k1").alias("a1"), F.col("k2").alias("a2"), F.col("text").alias("ta"))
    two = texts.select(F.col("k1").alias("b1"), F.col("k2").alias("b2"), F.col("text").alias("tb"))
    left, right = ["a1", "a2"], ["b1", "b2"]
    both = _beside(flat, one, left, right, _hot(flat, left, rules))
    both = _beside(both, two, right, left, _hot(flat, right, rules)).select(*left, *right, "ta", "tb")
    scored = both.mapInArrow(run, fields).filter(F.col("similarity") >= F.lit(rules.similarity) - F.lit(1e-6))
    return scored.select(F.struct(F.col("a1").alias("k1"), F.col("a2").alias("k2")).alias("a"), F.struct(F.col("b1").alias("k1"), F.col("b2").alias("k2")).alias("b"), "similarity")


def classes(docs: DataFrame, rules: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per distinct text: key ``(k1, k2)``, ``copies``, ``class_id`` (least key of its class), ``class_size`` (rows), ``links``."""
    spark = docs.sparkSession
    texts = spark.table(distinct_texts(docs, text, key))
    sampler = Sampler(rules, document_frequencies(texts, rules))
    signatures = materialize(_signatures(texts, sampler), "signatures")
    candidates, members = _candidates(signatures, rules)
    pairs = materialize(_agreeing(candidates, signatures, rules), "pairs")
    links = materialize(_verified(pairs, texts, sampler), "links")
    members = materialize(members, "large_groups")
    if not members.isEmpty():
        rest = materialize(_agreeing(_apart(members, texts, links, sampler), signatures, rules), "pairs")
        links = links.union(materialize(_verified(rest, texts, sampler), "links"))
    roots = components(links).select(F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"), "root")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("links"))
    degree = ends.select(F.col("node.k1").alias("k1"), F.col("node.k2").alias("k2"), "links")
    linked = texts.select("k1", "k2", "copies", "key").join(roots, ["k1", "k2"], "left").join(degree, ["k1", "k2"], "left")
    mine = linked.withColumn("root", F.coalesce("root", F.struct("k1", "k2")))
    whole = mine.groupBy("root").agg(F.min("key").alias("class_id"), F.sum("copies").alias("class_size"))
    return mine.join(whole, "root").select("k1", "k2", "copies", "root", "class_id", "class_size", F.coalesce("links", F.lit(0)).cast("long").alias("links"))


def assign(docs: DataFrame, rules: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, ``class_id``, ``class_size``, ``links`` to other texts, ``kept`` (the class's least key)."""
    rows = docs.select(F.col(f"`{key}`"), *text_key(F.col(f"`{text}`")))
    found = rows.join(classes(docs, rules, key, text), ["k1", "k2"])
    return found.select(f"`{key}`", "class_id", "class_size", "links", F.col(f"`{key}`").eqNullSafe(F.col("class_id")).alias("kept"))


def keep_one(docs: DataFrame, rules: NearDup = NearDup(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, that with the least key; the columns of the input."""
    found = materialize(classes(docs, rules, key, text), "classes")
    columns = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")  # whatever their names
    rows = docs.select(*text_key(F.col(f"`{text}`")), F.col(f"`{key}`").alias("id"), columns)
    # The text that holds the least key speaks for its class; of texts with equal keys, the least.
    spoken = rows.select("id", "k1", "k2").join(found.select("k1", "k2", "root", "class_id"), ["k1", "k2"])
    chosen = spoken.filter(F.col("id").eqNullSafe(F.col("class_id"))).groupBy("root").agg(F.min(F.struct("k1", "k2", "id")).alias("best"))
    wanted = chosen.select(F.col("best.k1").alias("w1"), F.col("best.k2").alias("w2"), F.col("best.id").alias("wanted"))
    same = (F.col("k1") == F.col("w1")) & (F.col("k2") == F.col("w2")) & F.col("id").eqNullSafe(F.col("wanted"))
    return rows.join(wanted, same, "left_semi").dropDuplicates(["k1", "k2"]).select("row.*")
