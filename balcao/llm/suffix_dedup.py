"""Remove byte strings that also occur in a document with a smaller id.

Every string of ``LENGTH`` bytes belongs to the least hashed 16-byte word inside it, its
anchor, which depends on the string alone. So equal strings have equal anchors, and the strings
of one anchor that overlap travel as one piece. Texts are dealt into blocks by id and text,
anchors into buckets by their hash; what a block sends to a bucket is one packed row.

1. Every block sends its different anchors, hashes only. The buckets answer with a bit each:
   whether another block has it too. Strings of other anchors can only repeat inside the block.
2. For anchors that several documents have, the blocks send their different pieces, with the
   smallest id that holds each. A passage in a third of all documents is one piece a block.
3. Each bucket's suffixes are sorted at a time, long ties resolved by difference-cover ranks
   (``suffix_blocks``); an anchor with one piece only needs none of that. The answer to a block
   is a bit for each string: whether a smaller id has it than the smallest of the block's.
4. The blocks cut their texts: a string goes for that bit, or because a smaller id of the same
   block holds the same piece.

Ids must be integers. A null id counts as larger than all others; rows that share an id do not
take from each other. Null texts count as empty. An empty table gives an empty result; other
columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from balcao.llm.shingle_sets import mixed
from balcao.llm.suffix_blocks import LENGTH, smallest_owners

ANCHOR = 16  # bytes of an anchor
BLOCK_BYTES = 16_000_000  # bytes of all texts for each block of texts
BUCKET_BYTES = 8_000_000  # bytes of all texts for each bucket of pieces
ANCHOR_BUCKETS = 4  # buckets of pieces for each bucket of anchors, which are smaller
LEAST_PARTS = 12  # blocks and buckets in addition, so that small tables are several tasks too
LAST_ID = (1 << 63) - 1
_NAME_BITS = 40  # of an anchor's hash; anchors that share them are told apart as pieces
_WORDS = LENGTH - ANCHOR + 1  # anchors to choose from in one string
_SEGMENT = 1 << 16  # positions looked at at a time; places fit into 24 bits
_PLACE = np.uint64((1 << 24) - 1)


def _words(data: bytes) -> np.ndarray:
    """Eight bytes from each place, and from ``ANCHOR`` places behind the end."""
    return np.ndarray((len(data) + ANCHOR,), dtype="<u8", buffer=data + bytes(ANCHOR + 8), strides=(1,))


def anchor_runs(data: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive strings with the same anchor in texts laid end to end.

    ``bounds`` are the texts' borders. Returns for each run its text, its first and last
    string's place, and the hash of its anchor. A run has at most ``_WORDS`` strings.
    """
    words = _words(data)
    sizes = np.diff(bounds)
    tails = np.minimum(sizes, LENGTH - 1)
    whole = np.repeat(np.tile([True, False], len(sizes)), np.column_stack([sizes - tails, tails]).ravel())
    found = []
    for first in range(0, len(data), _SEGMENT):
        # Strings that start here, and the anchors they can have.
        last = min(first + _SEGMENT, len(data))
        reach = min(last + _WORDS - 1, len(data))
        hashes = mixed(words[first:reach] + mixed(words[first + 8 : reach + 8].astype(np.uint64)))
        place = np.arange(reach - first, dtype=np.uint64)
        least = (hashes & ~_PLACE) | place
        width = 1
        while 2 * width <= _WORDS:
            least = np.minimum(least[:-width], least[width:]) if len(least) > width else least[:0]
            width *= 2
        rest = _WORDS - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:]) if len(least) > rest else least[:0]
        if not len(least):
            continue
        inside = whole[first : first + len(least)]
        # The last strings of a text are no whole ones, so texts never touch here.
        other = least[1:] != least[:-1]
        opens = np.flatnonzero(inside & np.append(True, other | ~inside[:-1]))
        closes = np.flatnonzero(inside & np.append(other | ~inside[1:], True))
        anchors = (least[opens] & _PLACE).astype(np.int64)
        names = mixed(hashes[anchors]) >> np.uint64(64 - _NAME_BITS)
        found.append((first + opens, first + closes, first + anchors, names.astype(np.int64)))
    if not found:
        none = np.empty(0, dtype=np.int64)
        return none, none, none, none
    starts, lasts, anchors, names = (np.concatenate(column) for column in zip(*found))
    # A run that a segment's end has cut in two is one.
    fresh = np.append(True, anchors[1:] != anchors[:-1])[: len(anchors)]
    starts, lasts, names = starts[fresh], lasts[np.append(fresh[1:], True)[: len(fresh)]], names[fresh]
    return np.searchsorted(bounds[1:], starts, side="right"), starts, lasts, names


def piece_numbers(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece's bytes: words from both of its ends, which meet."""
    words = _words(data)
    numbers = sizes.astype(np.uint64)
    ends = starts + sizes
    for at in (starts, starts + 16, starts + 32, ends - 48, ends - 32, ends - 16):
        numbers = mixed(numbers ^ mixed(words[at] + mixed(words[at + 8].astype(np.uint64))))
    return numbers


def _packed_texts(rows: DataFrame) -> DataFrame:
    """``rows`` with each ``text`` compressed, as it is shuffled once and read several times."""
    fields = [
        StructField("text", BinaryType()) if field.name == "text" else field for field in rows.schema.fields
    ]
    at = rows.columns.index("text")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in batches:
            texts = batch.column(at).cast(pa.large_binary()).to_pylist()
            packed = pa.array([packer.compress(text) for text in texts], pa.binary())
            columns = [packed if i == at else column for i, column in enumerate(batch.columns)]
            yield pa.record_batch(columns, names=batch.schema.names)

    return rows.mapInArrow(pack, StructType(fields))


def _laid_out(rows: pa.Table) -> tuple[np.ndarray, bytes, np.ndarray]:
    """Ids, all texts' bytes end to end, and their borders."""
    unpacker = zstandard.ZstdDecompressor()
    texts = [unpacker.decompress(text) for text in rows.column("text").to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(text) for text in texts], dtype=np.int64)])
    return np.asarray(rows.column("id")), b"".join(texts), bounds


def _packed_numbers(numbers: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte: high bytes that are alike compress to nothing."""
    return zstandard.compress(np.ascontiguousarray(numbers.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes(), 3)


def _unpacked_numbers(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), dtype=np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def _packed_names(names: np.ndarray) -> bytes:
    """Ascending numbers."""
    return _packed_numbers(np.diff(names, prepend=0))


def _unpacked_names(packed: bytes) -> np.ndarray:
    return np.cumsum(_unpacked_numbers(packed))


def _bucket_cuts(names: np.ndarray, buckets: int) -> list[tuple[int, int, int]]:
    """Bucket, begin and end of ascending names; each bucket has an equal range of them."""
    of_name = (names * buckets) >> _NAME_BITS if len(names) else names
    edges = np.searchsorted(of_name, np.arange(buckets + 1)).tolist()
    return [(bucket, a, b) for bucket, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]


def _table(schema: pa.Schema, rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.table([pa.array(c, kind) for c, kind in zip(columns, schema.types)], schema=schema)


_ANCHORS = pa.schema({"bucket": pa.int64(), "block": pa.int64(), "names": pa.binary()})
_MARKS = pa.schema({"block": pa.int64(), "bucket": pa.int64(), "marks": pa.binary()})
_PIECES = pa.schema(
    {"bucket": pa.int64(), "block": pa.int64(), "names": pa.binary(), "sizes": pa.binary(), "bodies": pa.binary(), "ids": pa.binary()}
)
_TAKEN = pa.schema({"block": pa.int64(), "numbers": pa.binary(), "strings": pa.binary()})


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'bigint'}" for f in schema)


def _shared_in_bucket(rows: pa.Table) -> pa.Table:
    """For each block's anchors, a bit that tells whether another block has it too."""
    bucket = rows.column("bucket")[0].as_py() if len(rows) else 0
    parts = [_unpacked_names(packed) for packed in rows.column("names").to_pylist()]
    names = np.sort(np.concatenate(parts))
    twice = names[1:][names[1:] == names[:-1]]
    twice = twice[np.append(True, twice[1:] != twice[:-1])[: len(twice)]]
    found = []
    for block, part in zip(rows.column("block").to_pylist(), parts):
        at = np.minimum(np.searchsorted(twice, part), max(len(twice) - 1, 0))
        marks = twice[at] == part if len(twice) else np.zeros(len(part), dtype=bool)
        found.append((block, bucket, np.packbits(marks).tobytes()))
    return _table(_MARKS, found)


def _anchor_marks(names: np.ndarray, ids: np.ndarray, marks: pa.Table, buckets: int) -> np.ndarray:
    """Whether each run's anchor (``names``) is one that several documents have."""
    order = np.argsort(names)
    ordered, ids = names[order], ids[order]
    opens = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])[: len(ordered)])
    if not len(opens):
        return np.zeros(0, dtype=bool)
    shared = np.minimum.reduceat(ids, opens) < np.maximum.reduceat(ids, opens)
    answers = dict(zip(marks.column("bucket").to_pylist(), marks.column("marks").to_pylist()))
    for bucket, a, b in _bucket_cuts(ordered[opens], buckets):
        shared[a:b] |= np.unpackbits(np.frombuffer(answers[bucket], dtype=np.uint8), count=b - a).astype(bool)
    found = np.empty(len(names), dtype=bool)
    found[order] = np.repeat(shared, np.diff(np.append(opens, len(names))))
    return found


def _bodies(data: bytes, starts: np.ndarray, sizes: np.ndarray) -> bytes:
    """Parts of ``data``, end to end."""
    before = np.cumsum(sizes) - sizes
    places = np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))
    return np.frombuffer(data, dtype=np.uint8)[places].tobytes()


def _pieces_of_block(rows: pa.Table, marks: pa.Table, anchor_buckets: int, buckets: int) -> pa.Table:
    """Different pieces whose anchors are shared, with the block's smallest id that holds each."""
    block = rows.column("block")[0].as_py()
    ids, data, bounds = _laid_out(rows)
    texts, starts, lasts, names = anchor_runs(data, bounds)
    shared = np.flatnonzero(_anchor_marks(names, ids[texts], marks, anchor_buckets))
    if not len(shared):
        return _table(_PIECES, [])
    texts, starts, names = texts[shared], starts[shared], names[shared]
    sizes = lasts[shared] - starts + LENGTH
    numbers = piece_numbers(data, starts, sizes)
    order = np.lexsort((numbers, names))
    names, numbers = names[order], numbers[order]
    opens = np.flatnonzero(np.append(True, (names[1:] != names[:-1]) | (numbers[1:] != numbers[:-1])))
    low = np.minimum.reduceat(ids[texts][order], opens)
    names, starts, sizes = names[opens], starts[order[opens]], sizes[order[opens]]
    found = []
    for bucket, a, b in _bucket_cuts(names, buckets):
        bodies = zstandard.compress(_bodies(data, starts[a:b], sizes[a:b]), 3)
        packed_sizes = zstandard.compress(sizes[a:b].astype(np.uint8).tobytes(), 3)
        found.append((bucket, block, _packed_names(names[a:b]), packed_sizes, bodies, _packed_numbers(low[a:b])))
    return _table(_PIECES, found)


def _taken_of_bucket(rows: pa.Table) -> pa.Table:
    """For each block's pieces, a bit for each string that an id below the block's smallest holds."""
    column = {name: rows.column(name).to_pylist() for name in rows.column_names}
    bodies = b"".join(zstandard.decompress(packed) for packed in column["bodies"])
    parts = [np.frombuffer(zstandard.decompress(packed), dtype=np.uint8) for packed in column["sizes"]]
    sizes = np.concatenate(parts).astype(np.int64)
    names = np.concatenate([_unpacked_names(packed) for packed in column["names"]])
    low = np.concatenate([_unpacked_numbers(packed) for packed in column["ids"]])
    starts = np.cumsum(sizes) - sizes
    numbers = piece_numbers(bodies, starts, sizes)
    order = np.lexsort((numbers, names))
    other = names[order][1:] != names[order][:-1]
    fresh = np.append(True, other | (numbers[order][1:] != numbers[order][:-1]))
    opens = np.flatnonzero(fresh)
    least = np.minimum.reduceat(low[order], opens)
    piece = np.empty(len(order), dtype=np.int64)
    piece[order] = np.cumsum(fresh) - 1
    counts = sizes - LENGTH + 1
    # An anchor with one piece needs no sorting: the piece's smallest id holds all its strings.
    strings = np.where(least[piece] < low, (np.uint64(1) << counts.astype(np.uint64)) - np.uint64(1), np.uint64(0))
    anchors = names[order[opens]]
    other = anchors[1:] != anchors[:-1]
    several = ~(np.append(True, other) & np.append(other, True))
    if several.any():
        chosen = order[opens[several]]
        _, owners = smallest_owners(_bodies(bodies, starts[chosen], sizes[chosen]), sizes[chosen], least[several])
        of_string = np.full((len(chosen), 8 * -(-_WORDS // 8)), LAST_ID)
        of_string[np.arange(of_string.shape[1]) < counts[chosen][:, None]] = owners
        row = np.cumsum(several) - 1
        members = np.flatnonzero(several[piece])
        for part in np.array_split(members, len(members) // 65536 + 1):
            bits = np.packbits(of_string[row[piece[part]]] < low[part, None], axis=1, bitorder="little")
            wide = np.zeros((len(part), 8), dtype=np.uint8)
            wide[:, : bits.shape[1]] = bits
            strings[part] = wide.view("<u8").ravel()
    found = []
    edges = np.cumsum([0, *map(len, parts)]).tolist()
    for block, a, b in zip(column["block"], edges, edges[1:]):
        taken = a + np.flatnonzero(strings[a:b])
        if len(taken):
            found.append((block, numbers[taken].astype("<u8").tobytes(), _packed_numbers(strings[taken].view(np.int64))))
    return _table(_TAKEN, found)


def covered_bytes(ids: np.ndarray, data: bytes, bounds: np.ndarray, taken: pa.Table) -> np.ndarray:
    """Whether each byte of a block is covered by a string that a smaller id holds too."""
    texts, starts, lasts, _ = anchor_runs(data, bounds)
    edges = np.zeros(len(data) + 1, dtype=np.int32)
    if not len(starts):
        return edges[1:] > 0
    numbers = piece_numbers(data, starts, lasts - starts + LENGTH)
    everything = (np.uint64(1) << (lasts - starts + 1).astype(np.uint64)) - np.uint64(1)
    strings = np.zeros(len(starts), dtype=np.uint64)
    if len(taken):
        known = np.concatenate([np.frombuffer(n, dtype="<u8") for n in taken.column("numbers").to_pylist()])
        masks = np.concatenate([_unpacked_numbers(p) for p in taken.column("strings").to_pylist()]).view(np.uint64)
        order = np.argsort(known)
        known, masks = known[order], masks[order]
        at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
        strings = np.where(known[at] == numbers, masks[at], np.uint64(0))
    # Pieces that a smaller id of this block holds go whole.
    order = np.argsort(numbers)
    opens = np.flatnonzero(np.append(True, numbers[order][1:] != numbers[order][:-1]))
    held = ids[texts][order]
    low = np.repeat(np.minimum.reduceat(held, opens), np.diff(np.append(opens, len(order))))
    later = order[low < held]
    strings[later] = everything[later]
    whole = strings == everything
    edges[starts[whole]] += 1
    edges[lasts[whole] + LENGTH] -= 1
    part = np.flatnonzero((strings > 0) & ~whole)
    counts = lasts[part] - starts[part] + 1
    inside = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    gone = (np.repeat(strings[part], counts) >> inside.astype(np.uint64)) & np.uint64(1) > 0
    places = (np.repeat(starts[part], counts) + inside)[gone]
    edges[places] += 1
    edges[places + LENGTH] -= 1
    return np.cumsum(edges[:-1], dtype=np.int32) > 0


def _without_covered(rows: pa.Table, taken: pa.Table, as_text: bool, names: list[str]) -> pa.Table:
    """The rows of a block as ``without_repeats`` returns them."""
    ids, data, bounds = _laid_out(rows)
    covered = covered_bytes(ids, data, bounds, taken)
    removed = np.concatenate([[0], np.cumsum(covered, dtype=np.int64)])[bounds]
    opens = covered.copy()
    opens[1:] &= ~covered[:-1]
    firsts = bounds[:-1][np.diff(bounds) > 0]
    opens[firsts] = covered[firsts]
    spans = np.diff(np.searchsorted(np.flatnonzero(opens), bounds))
    left = np.frombuffer(data, dtype=np.uint8)[~covered].tobytes()
    edges = (bounds - removed).tolist()
    kept = [left[a:b] for a, b in zip(edges, edges[1:])]
    if as_text:
        kept = [text.decode(errors="ignore") for text in kept]
    rest = rows.column("rest").combine_chunks()
    null = rest.field("__null").to_pylist()
    edges = bounds.tolist()
    whole = [None if gone else data[a:b] for a, b, gone in zip(edges, edges[1:], null)]
    return pa.table(
        [
            *[rest.field(c) for c in names],
            pa.array(whole, pa.binary()).cast(pa.string()),
            pa.array(np.diff(bounds)),
            pa.array(np.diff(removed)),
            pa.array(spans.astype(np.int64)),
            pa.array(kept, pa.string() if as_text else pa.binary()),
        ],
        names=[*names, "text", "n_bytes", "n_removed", "n_spans", "kept"],
    )


def without_repeats(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", as_text: bool = False
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary) added.

    ``as_text`` makes ``kept`` a string; characters that were cut in two are left out of it.
    """
    others = [c for c in docs.columns if c not in (text_column, "n_bytes", "n_removed", "n_spans", "kept")]
    rows = docs.select(
        F.coalesce(F.col(id_column).cast("bigint"), F.lit(LAST_ID)).alias("id"),
        F.coalesce(F.col(text_column), F.lit("")).alias("text"),
        F.struct(F.col(text_column).isNull().alias("__null"), *[F.col(f"`{c}`") for c in others]).alias("rest"),
    )
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks, buckets = (total // size + LEAST_PARTS for size in (BLOCK_BYTES, BUCKET_BYTES))
    anchor_buckets = total // (ANCHOR_BUCKETS * BUCKET_BYTES) + LEAST_PARTS
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    dealt = _packed_texts(rows.select(block.alias("block"), "id", "text", "rest")).groupBy("block")

    def anchors(rows: pa.Table) -> pa.Table:
        _, data, bounds = _laid_out(rows)
        block, names = rows.column("block")[0].as_py(), np.sort(anchor_runs(data, bounds)[3])
        names = names[np.append(True, names[1:] != names[:-1])[: len(names)]]
        cuts = _bucket_cuts(names, anchor_buckets)
        return _table(_ANCHORS, [(bucket, block, _packed_names(names[a:b])) for bucket, a, b in cuts])

    def pieces(rows: pa.Table, marks: pa.Table) -> pa.Table:
        return _pieces_of_block(rows, marks, anchor_buckets, buckets)

    def remove(rows: pa.Table, taken: pa.Table) -> pa.Table:
        return _without_covered(rows, taken, as_text, others)

    marks = (
        dealt.applyInArrow(anchors, _ddl(_ANCHORS))
        .groupBy("bucket")
        .applyInArrow(_shared_in_bucket, _ddl(_MARKS))
    )
    taken = (
        dealt.cogroup(marks.groupBy("block"))
        .applyInArrow(pieces, _ddl(_PIECES))
        .groupBy("bucket")
        .applyInArrow(_taken_of_bucket, _ddl(_TAKEN))
    )
    types = dict(docs.dtypes)
    schema = (
        ", ".join(f"`{c}` {types[c]}" for c in others)
        + f", text string, n_bytes bigint, n_removed bigint, n_spans bigint, kept {'string' if as_text else 'binary'}"
    )
    cut = dealt.cogroup(taken.groupBy("block")).applyInArrow(remove, schema)
    order = [text_column if c == text_column else c for c in docs.columns if c in (*others, text_column)]
    return cut.withColumnRenamed("text", text_column).select(
        *[F.col(f"`{c}`") for c in order], "n_bytes", "n_removed", "n_spans", "kept"
    )


def removal_digest(docs: DataFrame) -> DataFrame:
    """What is removed from each row of ``documents``, and the hash of what is left."""
    found = without_repeats(docs.select("doc_id", "text"))
    return found.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
