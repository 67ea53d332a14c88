"""Document fingerprints: a homomorphic hash of the multiset of a text's paragraphs.

Every paragraph is hashed to a wide vector, and a text's fingerprint is the sum of its
paragraphs' vectors. So the order of paragraphs does not matter, a paragraph is put in or
taken out by adding or subtracting its vector, and equal multisets are told by equal sums.

The vector has two parts. ``EXACT_LANES`` lanes hold a hash of the whole paragraph, and
decide equality; they count modulo ``2 ** LANE_BITS``, two to a 64-bit word, with a spare bit
each, so that a sum of words never overflows. ``LIKENESS_LANES`` lanes hold the sum of one bit
each of the hashes of the paragraph's blocks, modulo ``2 ** 14`` and four to a word, so that
paragraphs which differ in one place are still close: the squared distance of two such sums
grows with the blocks only one has. A block ends behind a word whose hash is a multiple of
``BLOCK_WORDS``, or with its paragraph, wherever it stands: what is put in or taken out changes
the blocks it touches and no others.

Only column functions are used, and each text is worked on in its own row. Paragraphs end at
line feeds; blank ones count for nothing. Null texts count as empty, whose fingerprint is all
zeros. Neighbours of repeated ids are told apart by the text's hash.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from balcao.llm.spans import let

EXACT_LANES = 16
LIKENESS_LANES = 180
BLOCK_WORDS = 8  # on average
LANE_BITS = 30
QUANTILES = 512  # of the ids, at most; ranges between them are cut evenly
ROWS_PER_RANGE = 4_000  # neighbours are looked up in ranges of about so many rows

_EXACT_WORDS = EXACT_LANES // 2
_LOW = (1 << LANE_BITS) - 1
_HIGH_AT = LANE_BITS + 1
_MASK = _LOW | (_LOW << _HIGH_AT)
_LIKENESS_WORDS = LIKENESS_LANES // 4
_SHARE = 15  # words that take their bits from one hash, and binary digits from lane to lane
_COUNTS = 14  # binary digits of a likeness lane; the one above is spare
_STARTS = tuple(range(0, 60, _SHARE))
_ENTRY = sum(1 << at for at in _STARTS)
_FOUR = ((1 << _COUNTS) - 1) * _ENTRY
_SPARE = (1 << _COUNTS) * _ENTRY


def _numbers(count: int) -> Column:
    return F.array(*[F.lit(i) for i in range(count)])


def _zeros(count: int) -> Column:
    return F.array(*[F.lit(0).cast("bigint")] * count)


def _parts(vector: Column) -> tuple[Column, Column, Column]:
    """Blocks counted, likeness words, exact words."""
    return (
        F.slice(vector, 1, 1),
        F.slice(vector, 2, _LIKENESS_WORDS),
        F.slice(vector, 2 + _LIKENESS_WORDS, _EXACT_WORDS),
    )


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda p: p != "")


def _exact(text: Column) -> Column:
    """Sum of the paragraphs' own hashes."""

    def add(total: Column, paragraph: Column) -> Column:
        own = F.transform(_numbers(_EXACT_WORDS), lambda i: F.xxhash64(i, paragraph))
        return F.zip_with(
            total, own, lambda t, h: (t + h.bitwiseAND(F.lit(_MASK))).bitwiseAND(F.lit(_MASK))
        )

    return F.aggregate(paragraphs(text), _zeros(_EXACT_WORDS), add)


def _blocks(text: Column) -> Column:
    """Runs of words up to one whose hash says so; none goes on behind a line feed."""
    ends = F.transform(
        F.split(text, " ", -1),
        lambda word: F.concat(word, F.when(F.xxhash64(word) % BLOCK_WORDS == 0, "\n").otherwise(" ")),
    )
    # The last word has no space behind it in the text.
    runs = F.split(F.regexp_replace(F.array_join(ends, ""), "[ \n]\\z", ""), "\n", -1)
    return F.filter(runs, lambda run: run != "")


def _likeness(text: Column) -> Column:
    """Number of blocks, then the sum of their hashes' bits."""

    def word(hashes: Column, shift: int) -> Column:
        def add(total: Column, h: Column) -> Column:
            return (total + F.shiftrightunsigned(h, shift).bitwiseAND(F.lit(_ENTRY))).bitwiseAND(F.lit(_FOUR))

        return F.aggregate(hashes, F.lit(0).cast("bigint"), add)

    def sums(blocks: Column) -> Column:
        seeds = range(_LIKENESS_WORDS // _SHARE)
        hashed = F.struct(*[F.transform(blocks, _hash_with(s)).alias(f"h{s}") for s in seeds])
        count = F.size(blocks).cast("bigint")
        return let(hashed, lambda h: F.array(count, *[word(h[f"h{s}"], j) for s in seeds for j in range(_SHARE)]))

    return let(_blocks(text), sums)


def _hash_with(seed: int) -> Callable[[Column], Column]:
    return lambda block: F.xxhash64(F.lit(seed), block)


def multiset_vector(text: Column) -> Column:
    """The fingerprint as words: blocks counted, likeness lanes, exact lanes."""
    text = F.coalesce(text, F.lit(""))
    return F.concat(_likeness(text), _exact(text))


def _masked(mask: int):
    return lambda x, y: (x + y).bitwiseAND(F.lit(mask))


def combined(a: Column, b: Column) -> Column:
    """Fingerprint of the texts of ``a`` and ``b`` together."""
    (count, near, exact), (count_b, near_b, exact_b) = _parts(a), _parts(b)
    return F.concat(
        F.zip_with(count, count_b, lambda x, y: x + y),
        F.zip_with(near, near_b, _masked(_FOUR)),
        F.zip_with(exact, exact_b, _masked(_MASK)),
    )


def without(a: Column, b: Column) -> Column:
    """Fingerprint of ``a`` after the paragraphs of ``b`` are taken out."""
    spare = (1 << LANE_BITS) | (1 << (LANE_BITS + _HIGH_AT))
    (count, near, exact), (count_b, near_b, exact_b) = _parts(a), _parts(b)
    # A spare bit set before gives what a lane would borrow.
    less = F.zip_with(near, near_b, lambda x, y: x.bitwiseOR(F.lit(_SPARE)) - y)
    return F.concat(
        F.zip_with(count, count_b, lambda x, y: x - y),
        F.transform(less, lambda x: x.bitwiseAND(F.lit(_FOUR))),
        F.zip_with(exact, exact_b, lambda x, y: (x.bitwiseOR(F.lit(spare)) - y).bitwiseAND(F.lit(_MASK))),
    )


def to_text(vector: Column) -> Column:
    """The vector as hexadecimal digits, 16 for each word."""
    return F.array_join(F.transform(vector, lambda w: F.lpad(F.hex(w), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the share of blocks two texts have in common, estimated.

    1 - |a-b|^2 / (|a|^2 + |b|^2) over the lanes' centred values; 1 for two texts without
    blocks. The estimate's standard error is about sqrt(2 / LIKENESS_LANES) of what differs.
    """

    def lanes(vector: Column) -> Column:
        count, words, _ = _parts(vector)

        def lane(at: int) -> Callable[[Column], Column]:
            def centred(word: Column) -> Column:
                # Bits set less bits not set, of which only the last binary digits are known.
                value = 2 * F.shiftright(word, at).bitwiseAND(F.lit((1 << _COUNTS) - 1)) - F.get(count, F.lit(0))
                return (F.pmod(value + (1 << _COUNTS), F.lit(2 << _COUNTS)) - (1 << _COUNTS)).cast("double")

            return centred

        return F.concat(*[F.transform(words, lane(at)) for at in _STARTS])

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0.0), lambda t, v: t + v * v)

    def ratio(both: Column) -> Column:
        apart = total(F.zip_with(both["a"], both["b"], lambda x, y: x - y))
        size = total(both["a"]) + total(both["b"])
        return F.when(size == 0, 1.0).otherwise(F.greatest(F.lit(0.0), 1 - apart / size))

    return let(F.struct(lanes(a).alias("a"), lanes(b).alias("b")), ratio)


def _ranges(docs: DataFrame, id_column: str) -> Column:
    """Number of the id range of a row, falling ids in rising ranges; about equally many rows.

    Quantiles come to the driver, ``QUANTILES`` at most. With more rows than those make ranges of
    the size wanted, each part between two of them is cut into as many equal spans of ids.
    """
    rows = docs.count()
    wanted = max(1, rows // ROWS_PER_RANGE)
    parts = min(QUANTILES, wanted)
    spans = -(-wanted // parts)
    steps = [i / parts for i in range(parts + 1)]
    bounds = docs.agg(F.percentile_approx(id_column, steps, 100 * QUANTILES).alias("b")).first().b if wanted > 1 else []
    edges = sorted(set(bounds or []), reverse=True)
    if len(edges) < 2:
        return F.lit(0).cast("bigint")
    own = F.coalesce(F.col(id_column), F.lit(edges[-1]))
    part = F.size(F.filter(F.array(*[F.lit(b) for b in edges[1:-1]]), lambda edge: edge > own))
    above, below = (F.get(F.array(*[F.lit(float(b)) for b in side]), part) for side in (edges[:-1], edges[1:]))
    span = F.floor((above - own.cast("double")) / (above - below + 1) * spans)
    # Quantiles are approximate: the least and the largest id may lie beyond them.
    return part.cast("bigint") * spans + F.greatest(F.least(span, F.lit(spans - 1)), F.lit(0))


def with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``text_column``, ``vector``, and ``next_text`` and ``next_vector`` of the row
    with the next smaller id; the smallest gets those of the largest. Nulls come last.

    Rows are sorted inside ranges of ids; one row for each range goes on to the range before. Every
    text is hashed once.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.select(id_column, text.alias(text_column)).withColumns(
        {
            "range": _ranges(docs.select(id_column), id_column),
            "tie": F.xxhash64(text_column),
            "vector": multiset_vector(F.col(text_column)),
        }
    )
    order = [F.col(id_column).desc_nulls_last(), "tie", text_column]
    inside = Window.partitionBy("range").orderBy(*order)
    # The first row of a range: largest id, then as sorted above.
    key = F.struct(F.col(id_column).isNotNull(), F.col(id_column), -F.col("tie").cast("decimal(20,0)"))
    heads = rows.groupBy("range").agg(F.max_by(text_column, key).alias("next_head"))
    # Ranges without rows are passed over: a number for each range in one task, and no texts.
    around = Window.partitionBy(F.lit(0)).orderBy("range")
    everything = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follows = rows.select("range").distinct().select(
        "range", F.coalesce(F.lead("range").over(around), F.first("range").over(everything)).alias("next")
    )
    heads = follows.join(heads.withColumnRenamed("range", "next"), "next").select("range", "next_head")
    led = rows.withColumns(
        {"inner": F.lead(text_column).over(inside), "inner_vector": F.lead("vector").over(inside)}
    ).join(heads, "range")
    # Only the last row of a range has to hash the head of the next one.
    return led.select(
        id_column,
        text_column,
        "vector",
        F.coalesce("inner", "next_head").alias("next_text"),
        F.when(F.col("inner").isNotNull(), F.col("inner_vector"))
        .otherwise(multiset_vector(F.col("next_head")))
        .alias("next_vector"),
    )


def edited_text(text: Column, other: Column) -> Column:
    """The last third (rounded down) replaced by as many code points of ``other``, or all."""
    cut = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - cut), F.substring(other, F.lit(1), cut))


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``vector`` (array of words) and ``fingerprint`` of every text."""
    found = docs.select(id_column, multiset_vector(F.col(text_column)).alias("vector"))
    return found.withColumn("fingerprint", to_text(F.col("vector")))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """Fingerprints of ``documents``, of their edited texts, and how near they are."""
    rows = with_next(docs)
    edited = edited_text(F.col("text"), F.col("next_text"))
    rows = rows.select(
        "doc_id",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(edited.cast("binary"), 256).alias("edited_sha256"),
        F.col("vector").alias("own"),
        multiset_vector(edited).alias("edited"),
        F.col("next_vector").alias("following"),
    )
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        to_text(F.col("own")).alias("fingerprint"),
        to_text(F.col("edited")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited")).alias("near_edited"),
        likeness(F.col("own"), F.col("following")).alias("near_next"),
    )
