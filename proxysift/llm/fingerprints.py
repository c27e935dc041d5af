"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words, weighted by how often they occur. For each sample and
term three random numbers depend on the hash of both alone: r and c from a Gamma(2, 1)
distribution and b, uniform. With t = floor(ln w / r + b) the term's value is
c * exp(-r * (t - b + 1)), and the sample is the (term, t) with the least value. Two texts
have the same sample with a probability equal to their generalised Jaccard similarity,
sum of min weights / sum of max weights, so the share of equal samples estimates it.

All of it is DataFrame expressions. A pair of term and weight has the same values in every
text, so those of the most frequent pairs are computed once, into a table of bounded
size that is broadcast; which pairs are in it changes the cost and no result. The values of a
text's terms are reduced to its least ones where the text is read. Texts are shuffled once, to
buckets of neighbouring ids; all that follows is grouped by bucket and needs no other shuffle.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from proxysift.llm.common import ascii_lower
from proxysift.session import durable

SAMPLES = 64
# Samples computed in one row; more make methods that the JVM does not compile.
CHUNK = 4
MOST_CHUNKS = 32
MOST_BUCKETS = 1 << 16

# Most frequent terms whose values are broadcast (8 bytes a sample and weight, about 34 MiB for
# 64 samples), and how many candidates each task follows to find them. The weights of a term
# that are in the table fall with its rank. A weight that does not fit its bits is not looked up.
TERMS = 48_000
FOLLOWED = 1 << 18
WEIGHT_POWER = 2.5
WEIGHT_BITS = 8

# The last word of a text, tried only where a word begins.
LAST_WORD = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*+\z"

_ID_BITS = 31
_LOW = 2**32 - 1
_NO_ID = -(1 << 63)
_FIRST_HASH = -1


def hashed_words(text: Column) -> Column:
    """The terms of a text, one per word."""
    words = F.filter(F.split(ascii_lower(text), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.transform(words, term_of)


def term_of(word: Column) -> Column:
    return F.xxhash64(word).bitwiseAND(F.lit(-(1 << WEIGHT_BITS)).cast("bigint"))


def weighted_terms(shared: Column, own: Column, edited: Column) -> Column:
    """``term``, ``weight``, ``edited_weight`` of the distinct words of two texts together.

    Both texts begin with the words of ``shared``, which are read once; one goes on with
    ``own``, the other with ``edited``. The lowest bits of a hash, which are no part of the
    term, tell which of the texts a word is in while all are sorted.
    """
    clear = F.lit(-(1 << WEIGHT_BITS)).cast("bigint")

    def tagged(text: Column, mask: int) -> Column:
        return F.transform(hashed_words(text), lambda h: h.bitwiseOR(F.lit(mask).cast("bigint")))

    hashes = F.sort_array(F.concat(tagged(shared, 3), tagged(own, 1), tagged(edited, 2)))

    def runs(sorted_hashes: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(0), F.size(sorted_hashes) - 1),
            lambda i: (i == 0) | (F.get(sorted_hashes, i) != F.get(sorted_hashes, i - 1)),
        )
        return F.struct(sorted_hashes.alias("hashes"), starts.alias("starts"))

    def entries(found: Column) -> Column:
        n = F.size(found["hashes"])
        return F.transform(found["starts"], lambda at, k: F.struct(
            F.get(found["hashes"], at).bitwiseAND(clear).alias("term"),
            F.get(found["hashes"], at).bitwiseAND(F.lit(3)).alias("mask"),
            (F.coalesce(F.get(found["starts"], k + 1), n) - at).alias("n"),
        ))

    def joined(found: Column) -> Column:
        def one(entry: Column, k: Column) -> Column:
            term = entry["term"]
            # The tags of a term follow each other, 1, 2 and 3 at most.
            others = [F.get(found, k + step) for step in (1, 2)]

            def weight(bit: int) -> Column:
                total = F.when(entry["mask"].bitwiseAND(F.lit(bit)) != 0, entry["n"]).otherwise(0)
                for other in others:
                    counts = (other["term"] == term) & (other["mask"].bitwiseAND(F.lit(bit)) != 0)
                    total += F.when(counts, other["n"]).otherwise(0)
                return total

            first = (k == 0) | (F.get(found, k - 1)["term"] != term)
            return F.when(first, F.struct(term.alias("term"), weight(1).alias("weight"), weight(2).alias("edited_weight")))

        return F.filter(F.transform(found, one), lambda x: x.isNotNull())

    # One-element arrays bind what is used many times to a name.
    bound = F.filter(F.transform(F.array(hashes), lambda h: F.when(F.size(h) > 0, runs(h))), lambda x: x.isNotNull())
    none = F.array().cast("array<struct<term:bigint,weight:int,edited_weight:int>>")
    return F.coalesce(F.get(F.transform(F.transform(bound, entries), joined), F.lit(0)), none)


def _uniform(bits: Column, size: int) -> Column:
    """A number strictly between 0 and 1 from an integer below 2 ** size."""
    return (bits.cast("double") + 0.5) * (0.5**size)


def pair_of(term: Column, weight: Column) -> Column:
    """Term and weight in one number; null for a weight that does not fit."""
    return F.when(weight < (1 << WEIGHT_BITS), term.bitwiseOR(weight.cast("bigint")))


def sample_values(rows: DataFrame, known: Column, kept: list[str]) -> DataFrame:
    """``kept`` and ``v0 ..`` for rows with ``term, weight, chunk``: the chunk's values of the term.

    A value and the id of its (term, t) are packed in one number, the value above, so that the
    least sample is a plain minimum. Where ``known`` holds nothing is computed: all that
    follows from a null hash is null.
    """
    seed = F.col("chunk") * (2 * CHUNK)
    hashes = [F.when(~known, F.xxhash64("term", seed + k)).alias(f"h{k}") for k in range(2 * CHUNK)]
    rows = rows.select(*kept, "term", F.ln(F.col("weight").cast("double")).alias("log"), *hashes)
    numbers = []
    for j in range(CHUNK):
        first, second = F.col(f"h{2 * j}"), F.col(f"h{2 * j + 1}")
        r = -F.ln(_uniform(F.shiftrightunsigned(first, 32), 32) * _uniform(first.bitwiseAND(F.lit(_LOW)), 32))
        c = -F.ln(
            _uniform(F.shiftrightunsigned(second, 40), 24)
            * _uniform(F.shiftrightunsigned(second, 16).bitwiseAND(F.lit(2**24 - 1)), 24)
        )
        b = _uniform(second.bitwiseAND(F.lit(2**16 - 1)), 16)
        numbers += [r.alias(f"r{j}"), F.ln(c).alias(f"c{j}"), b.alias(f"b{j}")]
    rows = rows.select(*kept, "term", "log", *numbers)
    steps = [F.floor(F.col("log") / F.col(f"r{j}") + F.col(f"b{j}")).alias(f"t{j}") for j in range(CHUNK)]
    rows = rows.select("*", *steps)
    packed = []
    for j in range(CHUNK):
        r, c, b, t = (F.col(f"{name}{j}") for name in "rcbt")
        value = F.floor((c - r * (t.cast("double") - b + 1.0) + 128.0) * float(2**24))
        name = F.shiftrightunsigned(F.xxhash64("term", t), 64 - _ID_BITS)
        packed.append(F.shiftleft(value, _ID_BITS).bitwiseOR(name).alias(f"v{j}"))
    return rows.select(*kept, *packed)


def _chunks(samples: int) -> Column:
    return F.sequence(F.lit(0), F.lit(samples // CHUNK - 1))


def frequent_pairs(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """``pair, known``: the most frequent pairs of all texts with their values for all samples.

    Words of all texts are counted, each task with a sketch of bounded size, so what is
    shuffled does not grow with the vocabulary. The word of rank r is in the table with the
    weights w for which r * w ** 2.5 is at most ``TERMS``, as larger weights are rarer. The
    table has at most ``TERMS * 1.4`` rows and is stored.
    """
    words = docs.select(F.explode(F.split(ascii_lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+")).alias("word"))
    terms = words.where("word != ''").select(term_of(F.col("word")).alias("term"))
    top = durable(terms.select(F.expr(f"approx_top_k(term, {TERMS}, {FOLLOWED})").alias("top")))
    ranked = top.select(F.posexplode("top.item").alias("rank", "term"))
    most = F.floor(F.pow(TERMS / (F.col("rank") + 1), 1 / WEIGHT_POWER)).cast("int")
    weights = F.sequence(F.lit(1), F.least(most, F.lit((1 << WEIGHT_BITS) - 1)))
    rows = ranked.select("term", F.explode(weights).alias("weight")).select(
        pair_of(F.col("term"), F.col("weight")).alias("pair"), "term", "weight", F.explode(_chunks(samples)).alias("chunk")
    )
    values = sample_values(rows, F.lit(False), ["pair", "chunk"])
    chunk = F.struct("chunk", F.array(*[f"v{j}" for j in range(CHUNK)]).alias("values"))
    return durable(values.groupBy("pair").agg(
        F.flatten(F.transform(F.sort_array(F.collect_list(chunk)), lambda c: c["values"])).alias("known")
    ))


def fingerprint_text(chunks: Column) -> Column:
    """Hexadecimal text of the samples of one document, 8 digits each, in order; without any, empty."""
    samples = F.flatten(F.transform(F.sort_array(chunks), lambda c: c["samples"]))
    samples = F.filter(samples, lambda s: s.isNotNull())
    return F.array_join(F.transform(samples, lambda s: F.lpad(F.lower(F.hex(s)), 8, "0")), "")


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples of two fingerprints; two without terms are alike, one is not."""
    same = F.size(F.filter(
        F.sequence(F.lit(0), F.lit(samples - 1)),
        lambda i: F.substring(a, i * 8 + 1, F.lit(8)) == F.substring(b, i * 8 + 1, F.lit(8)),
    ))
    return F.when((a == "") | (b == ""), (a == b).cast("double")).otherwise(same.cast("double") / samples)


def _bounds(docs: DataFrame, buckets: int) -> list[tuple[int, int]]:
    """Where buckets begin in the order of falling id and rising hash: at most twice as many pairs.

    Bounds are ids that occur, so the first row of a bucket is known to be there. An id that
    is a bound several times holds the rows of several buckets; these are divided at hashes of
    its texts. Only the bounds come to the driver.
    """
    ids = docs.select(F.coalesce("doc_id", F.lit(_NO_ID)).alias("key"), "text")
    found = ids.agg(
        F.percentile_approx("key", [i / buckets for i in range(1, buckets + 1)], 10 * buckets).alias("bounds"), F.max("key").alias("most")
    ).first()
    shares = Counter(found.bounds or [])
    if found.most is not None:
        shares[found.most] = max(1, shares[found.most])
    bounds = {(key, _FIRST_HASH) for key, n in shares.items() if n == 1}
    hot = {key: n for key, n in shares.items() if n > 1}
    if hot:
        part = F.element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), F.col("key"))
        rows = ids.where(F.col("key").isin(list(hot))).select("key", _text_hash(F.col("text")).alias("hash"))
        # A hash from 0 to 1, in as many parts as the id has buckets; each begins at its least hash.
        place = F.floor(F.col("hash").cast("double") * 0.5**63 * part)
        firsts = rows.groupBy("key", place.alias("place")).agg(F.min("hash").alias("hash"))
        bounds |= {(row.key, row.hash) for row in firsts.collect()}
    return sorted(bounds, key=lambda bound: (-bound[0], bound[1]))


def _text_hash(text: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(text, F.lit(""))), 1)


def neighbours(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows in descending doc_id with the text of the next one, ``bucket, guest, place`` besides.

    A bucket holds the rows from its bound up to the next one; the row at the bound also visits
    the bucket before as a guest, that of the first bucket the last one. So each row finds the
    next one in its own bucket. Rows of one id are ordered by their texts' hashes and may
    fill several buckets.
    """
    bounds = _bounds(docs, buckets)
    last = len(bounds) - 1
    at = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(h).alias("hash")) for k, h in bounds]).cast(
        "array<struct<key:bigint,hash:bigint>>"
    )
    width = max(1, round(len(bounds) ** 0.5))
    every = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(h).alias("hash")) for k, h in bounds[::width]]).cast(
        "array<struct<key:bigint,hash:bigint>>"
    )

    def begun(of: Column) -> Column:
        """How many of these bounds are at the row or before it."""
        return F.size(F.filter(of, lambda b: (b["key"] > F.col("key")) | ((b["key"] == F.col("key")) & (b["hash"] <= F.col("hash")))))

    rows = docs.select("doc_id", F.coalesce("doc_id", F.lit(_NO_ID)).alias("key"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("hash", _text_hash(F.col("text")))
    # First in steps, then between two steps: the square root of the number of bounds each.
    rows = rows.withColumn("step", begun(every))
    low = (F.col("step") - 1) * width
    rows = rows.withColumn("bucket", low + begun(F.slice(at, low + 1, F.lit(width))) - 1)
    bound = F.get(at, F.col("bucket"))
    first = (bound["key"] == F.col("key")) & ((bound["hash"] == F.col("hash")) | (bound["hash"] == _FIRST_HASH))
    host = F.col("bucket")
    home = F.struct(host.alias("bucket"), F.lit(0).alias("guest"))
    visit = F.struct(F.when(host == 0, F.lit(last)).otherwise(host - 1).alias("bucket"), F.lit(1).alias("guest"))
    rows = rows.withColumn("home", F.explode(F.when(first, F.array(home, visit)).otherwise(F.array(home))))
    rows = rows.select("doc_id", "key", "hash", "text", "home.bucket", "home.guest")
    order = Window.partitionBy("bucket").orderBy("guest", F.col("key").desc(), F.col("doc_id").isNull(), "hash", "text")
    return rows.select("*", F.row_number().over(order).alias("place"), F.lead("text").over(order).alias("next_text"))


def _as_numbers(digest: Column) -> list[Column]:
    """64 hexadecimal digits as four signed numbers."""
    return [F.conv(F.substring(digest, 16 * k + 1, 16), 16, -10).cast("bigint") for k in range(4)]


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """Per document its fingerprint, that of its edited text, and likenesses.

    The edited text has the last third of its characters replaced by the first ones of the
    next document in descending doc_id (after the last, the first), as many or all there
    are. A null text is empty; a text without words has the empty fingerprint; repeated rows
    follow each other; a null doc_id comes last. Rows of an id that is a large share of all
    fill several buckets by their texts; only rows that are equal stay together.
    """
    if samples % CHUNK or samples // CHUNK > MOST_CHUNKS - 2:
        raise ValueError(f"samples must be a multiple of {CHUNK}, at most {CHUNK * (MOST_CHUNKS - 2)}")
    known = frequent_pairs(docs, samples)
    buckets = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = neighbours(docs, min(max(buckets, 1), MOST_BUCKETS))
    n = F.char_length("text").cast("bigint")
    third = F.floor(n / 3).cast("int")
    kept = F.expr("left(text, char_length(text) - int(floor(char_length(text) / 3)))")
    edited = F.concat(kept, F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), third))
    # The words that both texts begin with: all before the one that the cut may go through.
    shared = F.regexp_replace(kept, LAST_WORD, "")
    # The facts of a document travel as numbers among its values, in two chunks of their own.
    none = F.lit(0).cast("bigint")
    rows = rows.withColumns({"edited": edited, "shared": shared}).select(
        "bucket", "place", "text", "edited", "shared",
        F.array(F.col("doc_id").cast("bigint"), n, F.col("guest").cast("bigint"), none, *_as_numbers(F.sha2(F.col("edited").cast("binary"), 256))).alias("facts"),
    )
    facts = F.array(F.struct(F.lit(None).cast("bigint").alias("term"), F.lit(1).alias("weight"), F.lit(1).alias("edited_weight")))

    def rest(name: str) -> Column:
        return F.substring(F.col(name), F.char_length("shared") + 1, F.char_length(name))

    terms = rows.select(
        "bucket", "place", "facts", F.explode(F.concat(facts, weighted_terms(F.col("shared"), rest("text"), rest("edited")))).alias("t")
    ).select("bucket", "place", "facts", "t.*")
    # Of a pair that text and edited text share one row serves both.
    shared = F.col("weight") == F.col("edited_weight")
    versions = F.array(
        F.struct(F.col("weight").alias("w"), F.when(shared, 3).otherwise(1).alias("mask")),
        F.struct(F.when(shared, 0).otherwise(F.col("edited_weight")).alias("w"), F.lit(2).alias("mask")),
    )
    terms = terms.select("bucket", "place", "facts", "term", F.explode(versions).alias("v")).where("v.w > 0").select(
        "bucket", "place", "facts", "term", F.col("v.w").alias("weight"), F.col("v.mask").alias("mask")
    )
    terms = terms.withColumn("pair", pair_of(F.col("term"), F.col("weight"))).join(F.broadcast(known), "pair", "left")
    fact = F.col("term").isNull()
    most = samples // CHUNK
    chunks = F.when(fact, F.array(F.lit(MOST_CHUNKS - 2), F.lit(MOST_CHUNKS - 1))).otherwise(_chunks(samples))
    rows = terms.select(
        "bucket", "place", "term", "weight", "mask", F.when(fact, F.col("facts")).otherwise(F.col("known")).alias("known"),
        F.explode(chunks).alias("chunk"),
    )
    at = F.when(F.col("term").isNull(), F.col("chunk") - (MOST_CHUNKS - 2)).otherwise(F.col("chunk")) * CHUNK
    rows = rows.select(
        "bucket", (F.col("place").cast("bigint") * MOST_CHUNKS + F.col("chunk")).alias("slot"), "term", "weight", "mask", "chunk",
        F.col("known").isNotNull().alias("is_known"), *[F.get("known", at + j).alias(f"k{j}") for j in range(CHUNK)],
    )
    computed = sample_values(rows, F.col("is_known"), ["bucket", "slot", "mask", *[f"k{j}" for j in range(CHUNK)]])
    values = computed.select("bucket", "slot", "mask", *[F.coalesce(f"k{j}", f"v{j}").alias(f"v{j}") for j in range(CHUNK)])
    versions = (("s", 1), ("e", 2))
    least = values.groupBy("bucket", "slot").agg(*[
        F.min(F.when(F.col("mask").bitwiseAND(F.lit(bit)) != 0, F.col(f"v{j}"))).alias(f"{name}{j}") for name, bit in versions for j in range(CHUNK)
    ])
    held = F.struct((F.col("slot") % MOST_CHUNKS).alias("chunk"), *[
        F.array(*[f"{name}{j}" for j in range(CHUNK)]).alias(name) for name, _ in versions
    ])
    whole = least.groupBy("bucket", F.expr(f"slot div {MOST_CHUNKS}").alias("place")).agg(F.sort_array(F.collect_list(held)).alias("chunks"))
    low = F.lit(2**_ID_BITS - 1)

    def text_of(version: str) -> Column:
        own = F.filter("chunks", lambda c: c["chunk"] < most)
        return fingerprint_text(F.transform(own, lambda c: F.struct(
            c["chunk"].alias("chunk"), F.transform(c[version], lambda v: v.bitwiseAND(low)).alias("samples")
        )))

    ids, digest = F.element_at("chunks", -2)["s"], F.element_at("chunks", -1)["s"]
    prints = whole.select(
        "bucket", "place", text_of("s").alias("print"), text_of("e").alias("edited_print"),
        F.get(ids, F.lit(0)).alias("doc_id"), F.get(ids, F.lit(1)).alias("n_chars"), F.get(ids, F.lit(2)).alias("guest"),
        F.array_join(F.transform(digest, lambda v: F.lpad(F.lower(F.hex(v)), 16, "0")), "").alias("edited_sha256"),
    )
    order = Window.partitionBy("bucket").orderBy("place")
    lined = prints.select("*", F.lead("print").over(order).alias("next_print")).where("guest = 0")
    return lined.select(
        F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id"), "n_chars", "edited_sha256", F.col("print").alias("fingerprint"),
        F.col("edited_print").alias("edited_fingerprint"),
        likeness(F.col("print"), F.col("edited_print"), samples).alias("near_edited"),
        likeness(F.col("print"), F.col("next_print"), samples).alias("near_next"),
    )
