"""Near-duplicate lines over all documents: MinHash bands, exact verification, one line per component.

The signature of a line is taken over all its distinct character shingles by one permutation: the hashes are sorted and
cut into ranges. The smallest hashes of a range make a band, all of them if there are fewer than asked for, and
the next one further on, in a circle, where there are none. Few shingles would leave too few in a range to tell
lines apart, so a shingle of a short line has several hashes; long lines have more shingles in common by chance,
so their bands are of more hashes. What is shuffled is a line's digest, its place and its bands, never its
text; equal lines are one line from then on.

Lines that share a band are compared by the Jaccard similarity of all their shingles. First every line meets
one line, the smallest of all bands it is in, which joins groups of near copies of any size with one
comparison a line. In bands that hold lines of several components even then, all lines of different
components are compared: in pairs if there are few; else with some lines of the band drawn at random, and what
is of different components still, in blocks. So of the lines of a band every two are
compared or already joined. To compare is to look at a sketch of both, which tells most pairs below the
similarity for sure (in blocks also at a wide one, with more bits the longer a line is), and then at all of their shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import settings
from .common import discard, landed, whole_text
from .components import components

SHINGLE = 5
#: Of lines of so many distinct shingles (from, below): hashes a shingle, bands, hashes a band. Lines of similarity s share a
#: band with probability 1 - (1 - s ** hashes) ** bands: 0.995, 0.995 and 0.992 at 0.8. Lines whose numbers differ by
#: a quarter at most, as those of similarity 0.8 do, are both in one of these cases.
CASES = ((0, 40, 8, 10, 4), (32, 200, 1, 10, 4), (160, 1 << 31, 1, 16, 6))
#: A band of so many lines at most is compared pair by pair, each pair once over all such bands; others in blocks.
PAIRED = 8
#: Larger bands first meet so many lines of theirs at random, which joins most of what is similar.
ROUNDS = 2
#: A block of a band holds about so many lines at most; more make a band several blocks.
BLOCK_LINES = 256
#: Words of 64 bits in the sketch of a line; shingles a word and words at most in its wide sketch.
WORDS = 16
FILL, WIDEST = 8, 1024
#: Bits of a filter that spares rows a shuffle. Its size is fixed; it lets more through as it fills.
FILTER_BITS = 1 << 25
#: Bits of a key by which it is told whether several rows may have it. What these bits make equal by chance goes later.
KEY_BITS = 40


def with_bands(lines: DataFrame, line: str = "line") -> DataFrame:
    """``lines`` with ``bands``, the 64-bit keys of the bands of all cases that a line is in, in place of their line.

    The lower borders of the ranges are sorted among the hashes, so a range is what stands between two of them.
    """
    columns = [c for c in lines.columns if c != line]
    # Outside of a lambda, repeated hashes are found by compiled code.
    hashed = lines.select(*columns, F.array_distinct(bound(F.encode(line, "UTF-16BE"), each_hash)).alias("_h"))

    def sorted_in(case: int) -> Column:
        low, below, copies, bands, _ = CASES[case]
        more = [F.transform("_h", lambda x, k=k: F.xxhash64(x, F.lit(k))) for k in range(1, copies)]
        every = F.sort_array(F.concat("_h", *more, F.array(*[F.lit(_border(case, k)) for k in range(bands)])))
        return F.when((F.size("_h") >= low) & (F.size("_h") < below), every).alias(f"_s{case}")

    hashed = hashed.select(*columns, *[sorted_in(n) for n in range(len(CASES))])
    places, firsts, keys = [], [], []
    for n, (*_, bands, rows) in enumerate(CASES):
        place = [F.col(f"_p{n}_{k}") for k in range(bands + 1)]
        first = [F.col(f"_f{n}_{k}") for k in range(bands)]
        places += [F.array_position(f"_s{n}", F.lit(_border(n, k))).cast("int").alias(f"_p{n}_{k}") for k in range(bands)]
        places.append((F.size(f"_s{n}") + 1).alias(f"_p{n}_{bands}"))
        firsts += [F.when(place[k + 1] > place[k] + 1, F.get(f"_s{n}", place[k])).alias(f"_f{n}_{k}") for k in range(bands)]
        held = []
        for k in range(bands):
            some = F.slice(f"_s{n}", place[k] + 1, F.least(place[k + 1] - place[k] - 1, F.lit(rows)))
            following = F.coalesce(*[first[j % bands] for j in range(k + 1, k + bands)])
            held.append(F.when(first[k].isNotNull(), F.xxhash64(F.lit(n), F.lit(k), some)).otherwise(F.xxhash64(F.lit(n), F.lit(k), following)))
        keys.append(F.when(F.col(f"_s{n}").isNotNull(), F.array(*held)).otherwise(F.array().cast("array<bigint>")))
    return hashed.select("*", *places).select("*", *firsts).select(*columns, F.concat(*keys).alias("bands"))


def _border(case: int, k: int) -> int:
    return (k << 64) // CASES[case][3] - (1 << 63)


def fixed_filter(keys: DataFrame, key: str) -> DataFrame:
    """word, bits: a bit for every 64-bit key, in FILTER_BITS / 64 rows at most."""
    bit = F.pmod(F.col(key), F.lit(FILTER_BITS))
    bits = keys.select(F.shiftright(bit, 6).alias("word"), F.expr(f"shiftleft(1L, cast(pmod(`{key}`, {FILTER_BITS}) AS INT) & 63)").alias("bit"))
    return bits.groupBy("word").agg(F.bit_or("bit").alias("bits"))


def passing(rows: DataFrame, key: str, words: DataFrame) -> DataFrame:
    """The rows whose key may be in the filter: all that are, and few others."""
    word = F.shiftright(F.pmod(F.col(key), F.lit(FILTER_BITS)), 6)
    held = F.expr(f"(shiftrightunsigned(bits, cast(pmod(`{key}`, {FILTER_BITS}) AS INT) & 63) & 1) = 1")
    return rows.join(F.broadcast(words), word == F.col("word")).where(held).drop("word", "bits")


def parted(rows: DataFrame, key: str, words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose key may be in the filter, as :func:`passing` has them, and all others."""
    word = F.shiftright(F.pmod(F.col(key), F.lit(FILTER_BITS)), 6)
    held = F.coalesce(F.expr(f"(shiftrightunsigned(_bits, cast(pmod(`{key}`, {FILTER_BITS}) AS INT) & 63) & 1) = 1"), F.lit(False))
    marked = rows.join(F.broadcast(words.toDF("_word", "_bits")), word == F.col("_word"), "left")
    return marked.where(held).drop("_word", "_bits"), marked.where(~held).drop("_word", "_bits")


def held_twice(keyed: DataFrame, key: str) -> DataFrame:
    """The rows whose 64-bit key is in several rows, and few others, landed.

    Keys are counted by KEY_BITS of their bits and without their rows, which is what most of them cost.
    """
    short = F.shiftrightunsigned(key, 64 - KEY_BITS)
    counted = keyed.groupBy(short.alias("_short")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = landed(fixed_filter(counted, "_short"), "several")
    found = landed(passing(keyed.withColumn("_short", short), "_short", several).drop("_short"), "held-twice")
    discard(several)
    return found


def similar(a: Column, b: Column, percent: int = 80) -> Column:
    """Whether two sets of shingle hashes (see :func:`every_hash`) have that Jaccard similarity."""
    return (100 + percent) * F.size(F.array_intersect(a, b)) >= percent * (F.size(a) + F.size(b))


def with_sketch(texts: DataFrame) -> DataFrame:
    """node, key, n_shingles (distinct) and sketch for ``texts`` (node, key, line).

    A sketch has a bit where a line has shingles, so where the bits of two lines differ, one has a shingle that
    the other has not: there are at least as many of these as bits that differ.
    """
    hashed = texts.select("node", "key", bound(F.encode("line", "UTF-16BE"), every_hash).alias("_h"))
    single = hashed.select("node", "key", F.size("_h").alias("n_shingles"), F.explode("_h").alias("_s"))
    word, bit = F.shiftrightunsigned("_s", 6).bitwiseAND(F.lit(WORDS - 1)), F.expr("shiftleft(1L, cast(_s & 63 AS INT))")
    single = single.select("node", "key", "n_shingles", word.alias("_w"), bit.alias("_b"))
    held = [F.bit_or(F.when(F.col("_w") == n, F.col("_b"))).alias(f"_o{n}") for n in range(WORDS)]
    held = single.groupBy("node", "key", "n_shingles").agg(*held)
    return held.select("node", "key", "n_shingles", F.array(*[F.coalesce(f"_o{n}", F.lit(0).cast("bigint")) for n in range(WORDS)]).alias("sketch"))


def with_wide_sketch(texts: DataFrame) -> DataFrame:
    """key and wide for ``texts`` (key, line): a sketch of so many bits that few shingles of a line share one.

    A fixed sketch of a long line is so full that it tells few pairs apart.
    """
    hashed = texts.select("key", bound(F.encode("line", "UTF-16BE"), every_hash).alias("_h"))
    words = F.pow(F.lit(2), F.ceil(F.log2(F.size("_h") / FILL))).cast("int")
    hashed = hashed.select("key", "_h", F.least(F.lit(WIDEST), F.greatest(F.lit(WORDS), words)).alias("_n"))
    word = lambda s: F.shiftrightunsigned(s, 6).bitwiseAND(F.col("_n") - 1)
    # Every word is there, empty or not, so that they can be told by their place.
    every = F.transform(F.sequence(F.lit(0), F.col("_n") - 1), lambda k: F.struct(k.cast("bigint").alias("w"), F.lit(0).cast("bigint").alias("s"), F.lit(False).alias("set")))
    held = F.transform("_h", lambda s: F.struct(word(s).alias("w"), s.alias("s"), F.lit(True).alias("set")))
    single = hashed.select("key", F.explode(F.concat(held, every)).alias("_e")).select("key", "_e.*")
    bit = F.when(F.col("set"), F.expr("shiftleft(1L, cast(s & 63 AS INT))")).otherwise(F.lit(0).cast("bigint"))
    each = single.groupBy("key", "w").agg(F.bit_or(bit).alias("bits"))
    return each.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("w", "bits")))["bits"].alias("wide"))


def wide_can_be_similar(n_a: Column, wide_a: Column, n_b: Column, wide_b: Column, percent: int) -> Column:
    """:func:`can_be_similar` by the wide sketches of lines whose numbers are near. These are of the same width or
    one of twice the other's, which is folded."""
    width = F.least(F.size(wide_a), F.size(wide_b))

    def folded(wide: Column) -> Column:
        halves = F.zip_with(F.slice(wide, 1, width), F.slice(wide, width + 1, width), lambda x, y: x.bitwiseOR(y))
        return F.when(F.size(wide) > width, halves).otherwise(wide)

    differ = F.zip_with(folded(wide_a), folded(wide_b), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differ, F.lit(0), lambda total, x: total + x)
    return (100 + percent) * apart <= (100 - percent) * (n_a + n_b)


def can_be_similar(n_a: Column, sketch_a: Column, n_b: Column, sketch_b: Column, percent: int) -> Column:
    """False only for lines that do not have that similarity, by their numbers of shingles and their sketches: lines
    of that similarity have at most (100 - percent) / (100 + percent) of all their shingles not in common, and the
    smaller number is at least ``percent`` of the larger one."""
    differ = [F.bit_count(F.get(sketch_a, F.lit(k)).bitwiseXOR(F.get(sketch_b, F.lit(k)))) for k in range(WORDS)]
    apart = differ[0]
    for more in differ[1:]:
        apart = apart + more
    near = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return near & ((100 + percent) * apart <= (100 - percent) * (n_a + n_b))


def each_hash(units: Column) -> Column:
    """A hash per shingle of a line given in UTF-16."""
    size = 2 * SHINGLE
    starts = F.sequence(F.lit(1), F.greatest(F.octet_length(units) - size + 1, F.lit(1)), F.lit(2))
    return F.transform(starts, lambda i: F.xxhash64(F.substring(units, i, F.lit(size))))


def every_hash(units: Column) -> Column:
    """A hash per distinct shingle of a line given in UTF-16."""
    return F.array_distinct(each_hash(units))


def bound(value: Column, use) -> Column:
    """``use`` of a value that is worked out once, whatever the optimizer makes of the columns around it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _split(text: str) -> Column:
    return F.split(F.col(text), "\n", -1)


def likely_pairs(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b (keys) that can be similar for pairs x, y of nodes."""

    def side(node: str, key: str) -> DataFrame:
        return sketches.select(F.col("node").alias(node), *[F.col(c).alias(f"{c}_{key}") for c in ("key", "n_shingles", "sketch")])

    both = pairs.join(side("x", "a"), "x").join(side("y", "b"), "y")
    near = can_be_similar(*[F.col(f"{c}_{k}") for k in "ab" for c in ("n_shingles", "sketch")], percent)
    return both.where(near).select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def verified_links(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b (keys) whose lines are similar by all of their shingles."""
    pairs = landed(pairs, "likely")
    # Only lines of pairs are shuffled, and few others.
    ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).select(F.xxhash64("key").alias("_ref"))
    asked = landed(fixed_filter(ends, "_ref"), "asked")
    near = passing(texts.withColumn("_ref", F.xxhash64("key")), "_ref", asked)
    one = near.select(F.col("key").alias("a"), F.col("line").alias("_a"))
    two = near.select(F.col("key").alias("b"), F.col("line").alias("_b"))
    both = pairs.join(one, "a").join(two, "b")
    both = both.select("a", "b", *[bound(F.encode(f"_{c}", "UTF-16BE"), every_hash).alias(f"_{c}") for c in "ab"])
    # As one generated method of a stage, these comparisons are not compiled.
    with settings(texts.sparkSession, spark__sql__codegen__wholeStage="false"):
        links = landed(both.where(similar(F.col("_a"), F.col("_b"), percent)).select("a", "b"), "links")
    for done in (pairs, asked):
        discard(done)
    return links


def paired_candidates(members: DataFrame) -> DataFrame:
    """The pairs x, y (nodes) of lines of different components that share a band of PAIRED lines at most."""
    groups = members.groupBy("band").agg(F.collect_list(F.struct("node", "component")).alias("members"))

    def partners(a: Column) -> Column:
        apart = F.filter("members", lambda b: (a["node"] < b["node"]) & (a["component"] != b["component"]))
        return F.transform(apart, lambda b: F.struct(a["node"].alias("x"), b["node"].alias("y")))

    return groups.select(F.explode(F.flatten(F.transform("members", partners))).alias("p")).select("p.*").distinct()


def block_pairs(members: DataFrame, sketches: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b (keys) of lines of different components that share a band and can be similar.

    ``members``: band, node, key, component. A line is found in as many blocks as its band has; all lines of two
    blocks are compared by their sketches, those that may be similar by their wide ones, and what still may be goes out.
    """
    wide = landed(with_wide_sketch(texts.join(members.select("key").distinct(), "key", "left_semi")), "wide")
    chunks = F.ceil(F.count(F.lit(1)) / BLOCK_LINES).cast("int")
    shape = landed(members.groupBy("band").agg(chunks.alias("chunks")), "shape")
    chunk = F.pmod(F.xxhash64("key", F.lit(1)), F.col("chunks")).cast("int").alias("chunk")
    placed = members.join(shape, "band").select("band", "key", "component", "chunks", chunk)
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    low, high = F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")
    member = F.struct("key", "component", "chunk", "n_shingles", "sketch", "wide").alias("member")
    told = landed(sketches.drop("node").join(wide, "key"), "told")
    placed = placed.join(told, "key").select("band", low, high, member)
    # A number of parts by setting: to compare costs more than the few bytes of a block show.
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = placed.repartition(parts, "band", "low", "high").groupBy("band", "low", "high").agg(F.collect_list("member").alias("members"))

    def partners(a: Column) -> Column:
        def near(b: Column) -> Column:
            apart = (a["key"] < b["key"]) & (a["component"] != b["component"])
            apart = apart & ((F.col("low") == F.col("high")) | (a["chunk"] != b["chunk"]))
            likely = can_be_similar(a["n_shingles"], a["sketch"], b["n_shingles"], b["sketch"], percent)
            still = wide_can_be_similar(a["n_shingles"], a["wide"], b["n_shingles"], b["wide"], percent)
            return F.when(~apart, False).when(~likely, False).otherwise(still)

        return F.transform(F.filter("members", near), lambda b: F.struct(a["key"].alias("a"), b["key"].alias("b")))

    pairs = blocks.select(F.explode(F.flatten(F.transform("members", partners))).alias("p")).select("p.*").distinct()
    pairs = landed(pairs, "pairs")
    for done in (wide, shape, told):
        discard(done)
    return pairs


def random_hubs(members: DataFrame, turn: int) -> DataFrame:
    """The pairs x, y (nodes) of the lines of each band with one of its lines, drawn by hash, of another component."""
    drawn = F.min_by(F.struct("node", "component"), F.xxhash64("node", F.lit(turn))).alias("hub")
    met = members.join(members.groupBy("band").agg(drawn), "band").where("component != hub.component")
    return met.select(F.col("node").alias("x"), F.col("hub.node").alias("y")).distinct()


def _lines(docs: DataFrame) -> DataFrame:
    """place, key, node, line for every line with a word."""
    pieces = docs.select("doc_id", "ref", F.posexplode(_split("text")).alias("_n", "line")).where(F.col("line").rlike(r"[^\x20\x09-\x0D]"))
    place = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "ref", (F.col("_n") + 1).alias("number"))
    placed = pieces.select(place.alias("place"), F.unhex(F.md5("line")).alias("key"), "line")
    return placed.select("place", "key", F.xxhash64("key").alias("node"), "line")


def repeated_lines(docs: DataFrame, percent: int = 80) -> DataFrame:
    """doc_id, ref, removed: the numbers (from 1) of the lines to remove per document of ``docs``
    (doc_id, text, ref)."""
    spark = docs.sparkSession
    every = _lines(docs)
    signed = with_bands(every.select("key", "node", "place", "line"))
    signed = signed.groupBy("key", "node").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.any_value("bands").alias("bands"))
    # The projections of a signature make one method that is too long to be compiled, if they are fused.
    with settings(spark, spark__sql__codegen__wholeStage="false"):
        unique = landed(signed, "unique")

    # Lines by band; a line of two cases has bands of both. Every line of a shared band has its smallest line to meet.
    shared = held_twice(unique.select("node", F.explode("bands").alias("band")), "band")
    met = shared.groupBy("band").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low != high")
    members = landed(shared.join(met.select("band", "low"), "band").select("band", "node", "low"), "members")
    hubs = landed(members.groupBy("node").agg(F.min("low").alias("hub")), "hubs")
    known = landed(fixed_filter(hubs, "node"), "known")
    # The smallest line of a band is in it too, so all that are compared are nodes here.
    compared = passing(unique.select("key", "node", "first", "n"), "node", known).join(hubs.select("node"), "node", "left_semi")
    compared = landed(compared, "compared")
    places = unique.where("n > 1").select("key", "first", "n").unionByName(compared.where("n = 1").select("key", "first", "n"))
    places = landed(places, "places")
    # Of equal lines only the first one is read, and shuffled once.
    read = landed(fixed_filter(compared.select(F.xxhash64("node", "first").alias("_at")), "_at"), "read")
    texts = passing(every.withColumn("_at", F.xxhash64("node", "place")), "_at", read).drop("_at")
    texts = texts.join(compared.select("key", F.col("first").alias("place")), ["key", "place"])
    texts = landed(texts.dropDuplicates(["key", "place"]).select("node", "key", "line"), "texts")
    for done in (unique, shared, known, compared, read):
        discard(done)
    sketches = landed(with_sketch(texts), "sketches")
    pairs = hubs.where("node != hub").select(F.col("node").alias("x"), F.col("hub").alias("y"))
    links = verified_links(likely_pairs(pairs, sketches, percent), texts, percent)
    discard(hubs)
    labels = components(links)

    def mixed_bands(rows: DataFrame) -> DataFrame:
        """band, node, key, component, _m of the lines (band, node, key) of bands with several components; _m: their lines."""
        named = rows.join(labels.withColumnRenamed("node", "key"), "key", "left")
        named = landed(named.select("band", "node", "key", F.coalesce("component", "key").alias("component")), "labelled")
        bands = named.groupBy("band").agg(F.min("component").alias("_low"), F.max("component").alias("_high"), F.count(F.lit(1)).alias("_m"))
        out = landed(named.join(bands.where("_low != _high").select("band", "_m"), "band"), "mixed")
        discard(named)
        return out

    mixed = mixed_bands(members.select("band", "node").join(sketches.select("node", "key"), "node"))
    discard(members)
    for turn in range(ROUNDS):
        found = verified_links(likely_pairs(random_hubs(mixed.where(F.col("_m") > PAIRED), turn), sketches, percent), texts, percent)
        if found.isEmpty():
            break
        links = links.unionByName(found)
        discard(labels)
        labels, before = components(links), mixed
        mixed = mixed_bands(before.select("band", "node", "key"))
        discard(before)
    few = likely_pairs(paired_candidates(mixed.where(F.col("_m") <= PAIRED)), sketches, percent)
    many = block_pairs(mixed.where(F.col("_m") > PAIRED), sketches, texts, percent)
    more = verified_links(few.unionByName(many).distinct(), texts, percent)
    for done in (texts, sketches, mixed, many):
        discard(done)
    if not more.isEmpty():
        discard(labels)
        labels = components(links.unionByName(more))
    for done in (links, more):
        discard(done)

    # Of a component, and of equal lines, the first place stays.
    joined = places.join(labels.withColumnRenamed("node", "key"), "key", "left")
    joined = landed(joined.where("n > 1 or component is not null").select("key", "first", "component"), "joined")
    discard(places)
    kept = joined.where("component is not null").groupBy("component").agg(F.min("first").alias("_kept"))
    joined = landed(joined.join(kept, "component", "left").select("key", F.coalesce("_kept", "first").alias("kept")), "kept")
    again = landed(fixed_filter(joined.select(F.xxhash64("key").alias("node")), "node"), "again")
    gone = passing(every.select("key", "node", "place"), "node", again).join(joined, "key").where("place != kept")
    gone = gone.select("place.doc_id", "place.ref", "place.number")
    removed = landed(gone.groupBy("doc_id", "ref").agg(F.sort_array(F.collect_set("number")).alias("removed")), "removed")
    for done in (joined, again):
        discard(done)
    return removed


def without(lines: Column, removed: Column) -> Column:
    """The array ``lines`` without the places (from 1, in order) in ``removed``: the runs between them."""
    borders = F.concat(F.array(F.lit(0)), removed, F.array(F.size(lines) + 1))

    def run(k: Column) -> Column:
        start, end = F.element_at(borders, k), F.element_at(borders, k + 1)
        return F.slice(lines, start + 1, end - start - 1)

    return F.flatten(F.transform(F.sequence(F.lit(1), F.size(removed) + 1), run))


def deduplicate_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """``docs`` with repeated and near-repeated lines removed from ``text_col``, and n_lines and n_removed.

    Lines are what ``\\n`` separates. Lines of at least ``percent`` Jaccard similarity over their distinct
    character shingles are linked; of each component, over all documents, the first line by id (NULL last)
    and place stays. Lines without a word stay as they are and count as lines. A NULL text stays NULL
    with 0 lines, an empty one empty. Rows with equal id and text are one document: what is removed
    from one is removed from all of them. An empty table gives an empty one. A caller's columns are kept;
    n_lines and n_removed of the caller are replaced.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    text = whole_text(f"`{text_col}`")
    named = docs.select(row, F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("ref"))
    removed = repeated_lines(named.select("doc_id", "text", "ref"), percent).withColumnsRenamed({"doc_id": "_id", "ref": "_ref"})
    # Only documents that may lose lines meet what they lose.
    losing = landed(fixed_filter(removed.select(F.xxhash64("_id", "_ref").alias("_at")), "_at"), "losing")
    some, others = parted(named.select("row", "doc_id", "ref", F.xxhash64("doc_id", "ref").alias("_at")), "_at", losing)
    same = F.col("ref").eqNullSafe(F.col("_ref")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = some.join(removed, same, "left").select("row", "removed")
    joined = joined.unionByName(others.select("row", F.lit(None).cast(removed.schema["removed"].dataType).alias("removed")))
    joined = joined.withColumn("_lines", F.split(whole_text(f"row.`{text_col}`"), "\n", -1))
    left = F.when(F.col("removed").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join(without(F.col("_lines"), F.col("removed")), "\n"))
    columns = [left.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c not in ("n_lines", "n_removed")]
    n_lines = F.when(F.col(f"row.`{text_col}`").isNull(), 0).otherwise(F.size("_lines")).cast("long")
    n_removed = F.coalesce(F.size(F.col("removed")), F.lit(0)).cast("long")
    return joined.select(*columns, n_lines.alias("n_lines"), F.when(F.col("removed").isNull(), 0).otherwise(n_removed).cast("long").alias("n_removed"))


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """The documents with their lines deduplicated and ``size_col`` brought up to date, in their columns.

    A document of which every line with a word was removed says nothing new and goes as a whole.
    """
    done = deduplicate_lines(docs.drop("n_lines", "n_removed"), id_col=id_col, text_col=text_col)
    wordy = F.col(f"`{text_col}`").rlike(r"[^\x20\x09-\x0D]")
    done = done.where((F.col("n_removed") == 0) | wordy)
    if size_col in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.char_length(f"`{text_col}`").cast(docs.schema[size_col].dataType))
        done = done.withColumn(size_col, F.coalesce(changed, F.col(size_col)))
    return done.select(*docs.columns)
