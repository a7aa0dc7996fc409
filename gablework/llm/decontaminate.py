"""Benchmark decontamination: SimHash of item-sized windows, found by multi-index Hamming blocks.

A benchmark item is compared with windows of a document that are as long as the item. Both are bags of
five-word shingles, weighted by how often they occur. A window that reaches over an end of the text is cut
there, as long as enough is left to be similar; so items cut short, and texts shorter than an item, are found.
Windows get a 64-bit SimHash of their shingles; cut into one block more than the radius has bits,
two fingerprints within the radius agree in some block, so joining on blocks misses none of them. What is
within the radius is verified by the exact weighted Jaccard similarity.

Which windows are fingerprinted: a window of similarity s holds at least s of the item's m shingles, so of any
m - ms + 1 of them (its probes: those that fewest items share) it holds one. Texts without any probe are
set aside by one scan; in the others there is a window at every start that has a probe inside it, wherever
in the item that probe stands, so parts that changed places are found too.

Fingerprints of all windows come from running sums of the SimHash counters over the places of a text: a
window costs two rows, whatever its length. Exact similarities come from one sweep over the starts: a
shared shingle counts for an interval of starts, and the running sum of the intervals' ends is
the number of shared shingles of every window. Both are linear in a text's places.

The radius covers what similarity s implies for SimHash: with at most a fraction t of weight
apart, bits differ with chance acos(1 - t) / pi; the default of 19 bits is over three standard
deviations above the mean for s = 0.8. It is a chance all the same: a window beyond it is missed.

Only DataFrame functions. Documents are told apart by their whole text, so null and repeated
keys do no harm. Defined cases: null and empty texts match nothing; items under five words have no
shingle and match nothing; the best window of each (text, item) is reported, ties to the
earliest; repeated rows get equal results; extra columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm.distinct import text_key
from gablework.llm.native import indices, let
from gablework.sources.scratch import materialize

SEPARATOR = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LANES = 32  # SimHash counters of 32 bits, two to a long
EPSILON = 1e-9


@dataclass(frozen=True)
class Decontamination:
    shingle: int = 5
    similarity: float = 0.8
    radius: int = 19
    # Probes up to this many are tested as a set inside the scan; more are joined.
    most_inline_probes: int = 50_000
    # Rows of a few numbers; a table of up to this many is broadcast.
    most_broadcast: int = 1_000_000
    # Beyond that, rows of one shingle are dealt over this many copies of its row.
    salts: int = 16


def plain_words(text: Column) -> Column:
    """The words in lower case, in order."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), rf"^{SEPARATOR}|{SEPARATOR}\z", "")
    return F.when(plain != "", F.split(plain, SEPARATOR, -1)).otherwise(F.array().cast("array<string>"))


def word_hashes(text: Column) -> Column:
    """Hashes of the words in lower case, in order."""
    return F.transform(plain_words(text), lambda w: F.xxhash64(w))


def shingles(hashes: Column, size: int) -> Column:
    """Hash of every run of ``size`` words, by start."""
    return F.transform(
        indices(F.size(hashes) - (size - 1)), lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(size)])
    )


def _counters(hash_: Column, j: int) -> Column:
    """Bits j and j + 32 of a hash, as two counters in one long."""
    return F.shiftrightunsigned(hash_, j).bitwiseAND(F.lit(0x0000000100000001))


def _majority(lanes: list[Column], size: Column) -> Column:
    """The bits that more than half of ``size`` hashes have set."""

    def bit(count: Column, place: int) -> Column:
        return F.when(count * 2 > size, F.shiftleft(F.lit(1).cast("long"), place)).otherwise(F.lit(0).cast("long"))

    halves = [(bit(c.bitwiseAND(F.lit(0xFFFFFFFF)), j), bit(F.shiftrightunsigned(c, 32), j + 32)) for j, c in enumerate(lanes)]
    return reduce(lambda a, b: a.bitwiseOR(b), [x for pair in halves for x in pair])


def simhash(bag: Column) -> Column:
    """64-bit SimHash of a non-empty bag of 64-bit hashes, each as often as it occurs.

    An array has fewer than 2**31 elements, so no counter spills into its neighbour.
    """

    def lane(j: int) -> Column:
        return F.aggregate(bag, F.lit(0).cast("long"), lambda a, h: a + _counters(h, j))

    sums = F.array(*[lane(j) for j in range(LANES)])
    return let(sums, lambda c: _majority([F.get(c, F.lit(j)) for j in range(LANES)], F.size(bag)))


def blocks(fingerprint: Column, radius: int) -> Column:
    """The fingerprint cut into ``radius + 1`` blocks, as (number, value)."""
    n = radius + 1
    cuts = [i * 64 // n for i in range(n + 1)]
    return F.array(
        *[
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"),
            )
            for i, (a, b) in enumerate(zip(cuts, cuts[1:]))
        ]
    )


def prepare_items(benchmark: DataFrame, rules: Decontamination, item: str, text: str) -> DataFrame:
    """One row per usable item: a number, its shingles with their letters, and fingerprint."""
    rows = benchmark.select(F.col(f"`{item}`").alias("item"), plain_words(F.col(f"`{text}`")).alias("words")).distinct()
    long = rows.filter(F.size("words") >= rules.shingle)
    bag = let(F.transform("words", lambda w: F.xxhash64(w)), lambda h: shingles(h, rules.shingle))
    letters = let(
        F.transform("words", lambda w: F.length(w)),
        lambda z: F.transform(
            indices(F.size(z) - (rules.shingle - 1)), lambda i: reduce(lambda a, b: a + b, [F.get(z, i + k) for k in range(rules.shingle)])
        ),
    )
    # Numbers are fixed by being written; ids may be null, repeated or long.
    numbered = long.select(F.monotonically_increasing_id().alias("no"), "item", bag.alias("bag"), letters.alias("letters"))
    return numbered.select("no", "item", F.size("bag").alias("m"), "bag", "letters", simhash(F.col("bag")).alias("fingerprint"))


def choose_probes(items: DataFrame, rules: Decontamination) -> DataFrame:
    """``(m, hash)``: for each item, as many shingles as may be missing, and one more; those of fewest items first."""
    each = items.select("no", "m", F.posexplode(F.arrays_zip("bag", "letters")).alias("offset", "one"))
    each = each.select("no", "m", "offset", F.col("one.bag").alias("hash"), F.col("one.letters").alias("letters"))
    shared = each.groupBy("hash", "no").count().groupBy("hash").agg(F.count(F.lit(1)).alias("items"))
    order = Window.partitionBy("no").orderBy("items", F.desc("letters"), "offset")
    may_miss = F.floor(F.col("m") * F.lit(1 - rules.similarity) + F.lit(EPSILON))
    ranked = each.join(shared, "hash").withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= may_miss + 1).select("m", "hash").distinct()


def _set_aside(docs: DataFrame, probes: DataFrame, rules: Decontamination, text: Column) -> DataFrame:
    """Rows with a probe somewhere.

    Shingles are one expression with bound words: as a column of their own, filters would
    pull its definition into lambdas and hash the text anew for each word.
    """
    bag = let(word_hashes(text), lambda h: shingles(h, rules.shingle))
    found = probes.select("hash").distinct()
    few = found.limit(rules.most_inline_probes + 1).collect()
    if not few:
        return docs.limit(0)
    if len(few) <= rules.most_inline_probes:
        wanted = [r["hash"] for r in few]
        return docs.filter(F.exists(bag, lambda h: h.isin(wanted)))
    spread = docs.select("k1", "k2", F.explode(bag).alias("hash"))
    keys = spread.join(found, "hash", "left_semi").select("k1", "k2").distinct()
    return docs.join(keys, ["k1", "k2"], "left_semi")


def _meet(rows: DataFrame, known: DataFrame, on: list[str], spread_by: str, rules: Decontamination) -> DataFrame:
    """Inner join with a table of small rows: broadcast up to a measured size, else with its rows copied per salt."""
    if known.count() <= rules.most_broadcast:
        return rows.join(F.broadcast(known), on)
    copies = known.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(rules.salts - 1))))
    return rows.withColumn("salt", F.pmod(F.hash(spread_by), F.lit(rules.salts))).join(copies, [*on, "salt"]).drop("salt")


def _places(suspects: DataFrame, probes: DataFrame, rules: Decontamination) -> DataFrame:
    """Places ``(k1, k2, m, size, at, hash)`` of all windows of m shingles with a probe inside, each once."""
    seen = suspects.select("k1", "k2", F.size("bag").alias("size"), F.posexplode("bag").alias("at", "hash"))
    hits = _meet(seen, probes, ["hash"], "at", rules).select("k1", "k2", "size", "m", "at")
    before = F.lag("at").over(Window.partitionBy("k1", "k2", "m").orderBy("at"))
    first = F.greatest(F.col("at") - F.col("m") + 1, F.coalesce(before + F.col("m"), F.lit(0)), F.lit(0))
    last = F.least(F.col("at") + F.col("m"), F.col("size")) - 1
    spans = hits.select("k1", "k2", "size", "m", first.alias("first"), last.alias("last")).filter("first <= last")
    regions = spans.join(suspects, ["k1", "k2"]).select(
        "k1", "k2", "size", "m", "first", F.posexplode(F.slice("bag", F.col("first") + 1, F.col("last") - F.col("first") + 1)).alias("i", "hash")
    )
    return regions.select("k1", "k2", "m", "size", (F.col("first") + F.col("i")).alias("at"), "hash")


def _windows(places: DataFrame, rules: Decontamination) -> DataFrame:
    """Windows ``(k1, k2, m, start, low, width, print)`` whose places are all there.

    ``start`` is below 0 for a window cut at the front of the text. A place adds the counters up to itself
    to windows that end there, and takes those before itself from the one that starts there.
    """
    along = Window.partitionBy("k1", "k2", "m").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own = [_counters(F.col("hash"), j) for j in range(LANES)]
    running = places.select(
        "k1", "k2", "m", "size", "at", "hash", F.row_number().over(Window.partitionBy("k1", "k2", "m").orderBy("at")).alias("nth"),
        *[F.sum(c).over(along).alias(f"c{j}") for j, c in enumerate(own)],
    )
    at, m, size = F.col("at"), F.col("m"), F.col("size")
    least = F.greatest(F.ceil(m * F.lit(rules.similarity) - F.lit(EPSILON)), F.lit(1)).cast("int")
    inside = at - m + 1
    none = F.array().cast("array<int>")
    # All windows cut at the end of the text, and the one that just reaches it, end at its last place.
    from_ = F.greatest(size - m, F.lit(0))
    last = F.when(from_ <= size - least, F.sequence(from_, F.greatest(size - least, from_))).otherwise(none)
    ended = F.when(at == size - 1, last).when(at - F.greatest(inside, F.lit(0)) + 1 >= least, F.array(inside)).otherwise(none)
    started = F.when(at + least <= size, F.array(at)).otherwise(none)
    events = F.concat(
        F.transform(ended, lambda s: F.struct(s.alias("start"), F.lit(1).alias("end"))),
        F.transform(started, lambda s: F.struct(s.alias("start"), F.lit(0).alias("end"))),
    )
    dealt = running.select("*", F.explode(events).alias("event")).select(
        "k1", "k2", "m", "event.*", "at", F.when(F.col("event.end") == 1, F.col("nth")).otherwise(1 - F.col("nth")).alias("places"),
        *[F.when(F.col("event.end") == 1, F.col(f"c{j}")).otherwise(own[j] - F.col(f"c{j}")).alias(f"c{j}") for j in range(LANES)],
    )
    whole = dealt.groupBy("k1", "k2", "m", "start").agg(
        F.max(F.when(F.col("end") == 1, F.col("at"))).alias("high"),
        F.sum(1 - F.col("end")).alias("starts"),
        F.sum("places").alias("places"),
        *[F.sum(f"c{j}").alias(f"c{j}") for j in range(LANES)],
    )
    low = F.greatest("start", F.lit(0))
    width = F.col("high") - low + 1
    sound = whole.withColumn("low", low).withColumn("width", width).filter(
        (F.col("places") == F.col("width")) & ((F.col("starts") == 1) | (F.col("start") < 0))
    )
    return sound.select("k1", "k2", "m", "start", "low", "width", _majority([F.col(f"c{j}") for j in range(LANES)], F.col("width")).alias("print"))


def _near(windows: DataFrame, items: DataFrame, rules: Decontamination) -> DataFrame:
    """Windows and items ``no`` whose fingerprints are at most the radius apart."""
    filed = items.select("no", "m", "fingerprint", F.explode(blocks(F.col("fingerprint"), rules.radius)).alias("key"))
    filed = filed.select("no", "m", "fingerprint", "key.*")
    spread = windows.select("*", F.explode(blocks(F.col("print"), rules.radius)).alias("key")).select("*", "key.*").drop("key")
    pairs = _meet(spread, filed, ["m", "block", "value"], "k1", rules)
    apart = F.col("print").bitwiseXOR(F.col("fingerprint"))
    near = pairs.withColumn("distance", F.bit_count(apart)).filter(F.col("distance") <= rules.radius)
    # A pair that agrees in several blocks counts in the first of them.
    agree = F.filter(F.transform(blocks(apart, rules.radius), lambda z: F.when(z["value"] == 0, z["block"])), lambda x: x.isNotNull())
    return near.filter(F.col("block") == F.get(agree, F.lit(0))).select("k1", "k2", "m", "no", "start", "low", "width", "distance")


def _verified(near: DataFrame, places: DataFrame, items: DataFrame, rules: Decontamination) -> DataFrame:
    """Near windows whose exact weighted Jaccard similarity reaches the threshold.

    A shingle that the item holds k times counts at a place for the windows that hold the place and fewer than
    k equal ones before it: those that start after the k-th equal place before it.
    """
    counted = items.select("no", F.explode("bag").alias("hash")).groupBy("no", "hash").agg(F.count(F.lit(1)).cast("int").alias("times"))
    pairs = near.select("k1", "k2", "m", "no").distinct()
    shared = _meet(places.join(pairs, ["k1", "k2", "m"]), counted, ["no", "hash"], "at", rules)
    equal = shared.groupBy("k1", "k2", "m", "no", "hash", "times").agg(F.sort_array(F.collect_list("at")).alias("at"))
    bounds = let(F.col("at"), lambda ps: F.transform(ps, lambda p, i: F.struct(F.get(ps, i - F.col("times")).alias("after"), p.alias("at"))))
    each = equal.select("k1", "k2", "m", "no", F.explode(bounds).alias("one"))
    first = F.greatest(F.col("one.after"), F.col("one.at") - F.col("m")) + 1  # greatest() passes over nulls
    edges = F.array(F.struct(first.alias("start"), F.lit(1).alias("step")), F.struct((F.col("one.at") + 1).alias("start"), F.lit(-1).alias("step")))
    steps = each.select("k1", "k2", "no", F.explode(edges).alias("edge")).select("k1", "k2", "no", "edge.*")
    steps = steps.groupBy("k1", "k2", "no", "start").agg(F.sum("step").alias("step"))
    swept = steps.unionByName(near.withColumn("step", F.lit(0).cast("long")), allowMissingColumns=True)
    same = F.sum("step").over(Window.partitionBy("k1", "k2", "no").orderBy("start").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    measured = swept.withColumn("same", same).filter(F.col("width").isNotNull())
    value = F.col("same") / (F.col("m") + F.col("width") - F.col("same")).cast("double")
    return measured.withColumn("similarity", value).filter(F.col("similarity") >= F.lit(rules.similarity) - F.lit(1e-12))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    rules: Decontamination = Decontamination(),
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Matches ``(k1, k2, item, similarity, start, distance)`` by text key, best per text and item."""
    whole = F.col(f"`{text}`")
    items = materialize(prepare_items(benchmark, rules, item, item_text), "benchmark")
    probes = materialize(choose_probes(items, rules), "probes")
    keyed = docs.select(*text_key(whole), whole.alias("_text"))
    # Copies of one text are examined once from here on.
    suspects = _set_aside(keyed, probes, rules, F.col("_text")).dropDuplicates(["k1", "k2"])
    suspects = suspects.select("k1", "k2", let(word_hashes(F.col("_text")), lambda h: shingles(h, rules.shingle)).alias("bag"))
    suspects = materialize(suspects, "suspects")
    places = materialize(_places(suspects, probes, rules), "places")
    near = materialize(_near(_windows(places, rules), items, rules), "near")
    verified = _verified(near, places, items, rules).join(items.select("no", "item"), "no")
    order = F.struct("similarity", -F.col("low"), "width", -F.col("distance"))
    best = F.max_by(F.struct("similarity", F.col("low").alias("start"), "distance"), order)
    return verified.groupBy("k1", "k2", "item").agg(best.alias("best")).select("k1", "k2", "item", "best.*")


def matches(docs: DataFrame, benchmark: DataFrame, rules: Decontamination = Decontamination(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row and item it contains: key, ``item_id``, ``similarity``, ``start`` (word), ``distance``."""
    found = find(docs, benchmark, rules, text)
    rows = docs.select(F.struct(F.col(f"`{key}`").alias("key")).alias("row"), *text_key(F.col(f"`{text}`")))
    joined = rows.join(found, ["k1", "k2"])
    return joined.select(F.col("row.key").alias(key), F.col("item").alias("item_id"), "similarity", "start", "distance")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rules: Decontamination = Decontamination(), text: str = "text") -> DataFrame:
    """The rows whose text contains no benchmark item; the columns of the input."""
    found = find(docs, benchmark, rules, text).select("k1", "k2").distinct()
    # The row travels as one column, so no name of its columns can clash.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *text_key(F.col(f"`{text}`")))
    return keyed.join(found, ["k1", "k2"], "left_anti").select("row.*")
