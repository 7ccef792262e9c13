"""Removal of repeated passages with suffix arrays over shards of candidate windows.

Every byte covered by a ``width``-byte string that also starts earlier (smaller document number, or the
same document at an earlier start) goes. The work is split so that no task sees a whole hot group:

1. Each ``width``-byte window of a text is assigned to one anchor, the smallest of its ``gram``-byte
   hashes. Windows with one anchor form a segment, so equal windows always meet under an equal anchor.
   Segments that are equal as a whole collapse to their first occurrence, inside a task and then by key.
2. Segments whose anchor has other contexts elsewhere go to shards. A shard drops the windows whose
   surroundings of the anchor differ from all others', concatenates the rest, sorts their suffixes by induction and reads from the permuted common prefixes which windows are equal;
   all but the first of each group are marked.
3. An anchor with more than ``hot`` different segments is split by window offset into quarters under longer
   anchors, again and again, down to single windows, which are merged in salted groups. No rows are dropped.
4. Marks are joined back to the texts and cut out.

Rows that repeat a document number with the same text count as one document and get the same result. A null text is
empty. Rows without a number come before all others, among themselves by 46 bits of a hash of the text. Rows with one
number and different texts are ordered by start and then by 16 bits of a hash of the text, which also tell them apart: the
number of different texts under one number should stay far below 256.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodstream.llm.common import byte_slices, grouped, materialise, partitions_for, ship
from moodstream.llm.suffix import common_prefixes, suffix_array

WIDTH = 100
GRAM = 32
SLICE_BYTES = 2_000_000
HELD_SEGMENTS = 500_000
SHARD_BYTES = 1_000_000
HOT = 5_000
CONTEXTS = 4
BLOCK = 16
_PLACE_BITS = 32

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_LETTER = np.random.default_rng(7).integers(0, 2**64, 256, dtype=np.uint64)
_SEGMENTS = "kind int, route long, key long, dig long, d long, at long"


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 1 << 16)
            inverse = np.uint64(pow(int(_BASE), -1, 2**64))
            with np.errstate(over="ignore"):
                cls.up = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, _BASE)]), dtype=np.uint64)
                cls.down = np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, inverse)]), dtype=np.uint64)
        return cls.up[:n], cls.down[:n]


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * _MIX
        return x ^ (x >> np.uint64(29))


def _place(lo, text_hash, offset, windows):
    """Start, 16 bits of the text's hash, offset of the first window before its anchor, windows: one long."""
    return (np.asarray(lo, np.int64) << 30) | (np.asarray(text_hash, np.int64) << 14) | (np.asarray(offset, np.int64) << 7) | windows


def _fields(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Inverse of ``_place``."""
    return at >> 30, (at >> 14) & 0xFFFF, (at >> 7) & 127, at & 127


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def _anchored(data: np.ndarray, borders: np.ndarray, width: int, gram: int):
    """Segments of a run of texts: text row, start in the run, windows, offset of the first, anchor hash."""
    n = len(data)
    if n < width:
        return None
    up, down = _Powers.get(n + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_LETTER[data] * up[:n], out=sums[1:])
        grams = _mixed((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
    # The same leading bits in every run, then the place: equal windows get their anchors in the same place.
    bits = np.uint64(_PLACE_BITS)
    ranked = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    least = _sliding_least(ranked, width - gram + 1) & ((np.uint64(1) << bits) - np.uint64(1))
    inside = np.zeros(n + 1, np.int32)
    lengths = np.diff(borders)
    fits = lengths >= width
    np.add.at(inside, borders[:-1][fits], 1)
    np.add.at(inside, borders[1:][fits] - width + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(least)])
    if not len(starts):
        return None
    anchor = least[starts].astype(np.int64)
    fresh = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(starts) != 1)]))
    windows = np.diff(np.append(fresh, len(starts)))
    lo, anchor = starts[fresh], anchor[fresh]
    row = np.searchsorted(borders, lo, "right") - 1
    return row, lo, windows, anchor - lo, grams[anchor]


def _number(id_col: str, text_col: str) -> Column:
    """A document's number; rows without one get the lowest numbers there are, by their texts."""
    lowest = F.lit(-(2**63)) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), 18)
    return F.coalesce(F.col(id_col).cast("long"), lowest)


def _find_segments(width: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            numbers = batch.column(0).to_numpy(zero_copy_only=False)
            for first, end, data, borders in byte_slices(batch.column(1), SLICE_BYTES):
                found = _anchored(data, borders, width, gram)
                if found is None:
                    continue
                row, lo, windows, offset, key = found
                raw = memoryview(data.tobytes())
                digest = xxhash.xxh3_64_intdigest
                texts = np.array([digest(raw[a:b]) & 0xFFFF for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())], np.int64)
                dig = np.array([digest(raw[a:b]) for a, b in zip(lo.tolist(), (lo + windows + width - 1).tolist())], np.uint64)
                at = _place(lo - borders[row], texts[row], offset, windows)
                held.append([key.view(np.int64), dig.view(np.int64), numbers[first:end][row].astype(np.int64), at])
                if sum(len(h[0]) for h in held) >= HELD_SEGMENTS:
                    yield from _collapse(held)
                    held = []
        if held:
            yield from _collapse(held)

    return run


def _collapse(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Mark later copies of equal segments; route anchors with many contexts by segment, not by anchor."""
    key, dig, d, at = (np.concatenate(x) for x in zip(*held))
    by = np.lexsort((at, d, dig, key))
    key, dig, d, at = key[by], dig[by], d[by], at[by]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new = new_key | np.concatenate([[True], dig[1:] != dig[:-1]])
    heads = np.flatnonzero(new)
    which = np.cumsum(new) - 1
    copy = (d != d[heads][which]) | (at >> 14 != at[heads][which] >> 14)
    group = np.cumsum(new_key) - 1
    nth = np.cumsum(new) - np.cumsum(new)[np.flatnonzero(new_key)][group]
    many = nth >= CONTEXTS
    route = np.where(many, _mixed((key ^ dig).view(np.uint64)).view(np.int64), key)
    # Marked copies are only carried along, so they are spread evenly.
    route = np.where(copy, _mixed((d * 31 ^ at).view(np.uint64)).view(np.int64), route)
    keep = new | copy
    kind = np.where(copy, 1, np.where(many, 2, 0)).astype(np.int32)
    columns = [kind, route, key, dig, d, at]
    yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], names=["kind", "route", "key", "dig", "d", "at"])


def _settle(segments: DataFrame) -> DataFrame:
    """Copies of a segment (kind 1, to be removed) and first segments of shared anchors (kind 0)."""
    group = Window.partitionBy("route")
    ordered = group.orderBy("dig", "d", "at")
    first = F.struct("key", "dig", "d", F.shiftright("at", 14).alias("at"))
    compared = (
        segments.repartition("route").withColumn("head", F.first(first).over(Window.partitionBy("route", "dig").orderBy("d", "at")))
        .withColumn("least", F.min(F.when(F.col("kind") != 1, F.col("dig"))).over(group))
        .withColumn("most", F.max(F.when(F.col("kind") != 1, F.col("dig"))).over(group))
        .withColumn("nth", F.row_number().over(ordered))
        .withColumn("last", F.lag("dig").over(ordered))
    )
    same = (F.col("head.key") == F.col("key")) & (F.col("head.dig") == F.col("dig"))
    earlier = (F.col("head.d") != F.col("d")) | (F.col("head.at") != F.shiftright("at", 14))
    is_copy = (F.col("kind") == 1) | (same & earlier)
    repeated_row = same & ~earlier & (F.col("nth") > 1) & (F.col("last") == F.col("dig"))
    shared = (F.col("kind") == 2) | (F.col("least") != F.col("most"))
    return compared.select(
        F.when(is_copy, 1).when(shared & ~repeated_row, 0).alias("kind"), "key", "d", "at"
    ).where("kind is not null")


def _packed(docs: DataFrame) -> DataFrame:
    """Rows with their texts as compressed bytes, to halve what a join moves, and ``h``: 16 bits of the text's hash.

    Joined by number and hash, rows that share a number, such as all those without one, meet only what is their own.
    """
    rest = [f"{f.name} {f.dataType.simpleString()}" for f in docs.schema.fields[2:]]

    def run(batches):
        for batch in batches:
            press, z, h = zstandard.ZstdCompressor(level=1), [], []
            for text in batch.column(1).cast(pa.large_binary()):
                raw = text.as_py()
                z.append(press.compress(raw))
                h.append(xxhash.xxh3_64_intdigest(raw) & 0xFFFF)
            columns = [batch.column(0), pa.array(h, pa.int64()), pa.array(z, pa.binary()), *batch.columns[2:]]
            yield pa.RecordBatch.from_arrays(columns, names=["d", "h", "z", *batch.schema.names[2:]])

    return docs.mapInArrow(run, ", ".join(["d long, h long, z binary", *rest]))


def _text_hash(at: str = "at") -> Column:
    return F.shiftright(at, 14).bitwiseAND(F.lit(0xFFFF))


def _unpacked(value: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(value) if value else b""


def _cut_segments(width: int):
    def run(batches):
        for batch in batches:
            key, d, at, seg = [], [], [], []
            for number, packed, items in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()):
                text = _unpacked(packed.as_py())
                own = xxhash.xxh3_64_intdigest(text) & 0xFFFF
                for item in items:
                    place = item["at"]
                    lo, hashed, windows = place >> 30, (place >> 14) & 0xFFFF, place & 127
                    if hashed == own:
                        key.append(item["key"])
                        d.append(number)
                        at.append(place)
                        seg.append(text[lo : lo + windows + width - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key, pa.int64()), pa.array(d, pa.int64()), pa.array(at, pa.int64()), pa.array(seg, pa.binary())],
                names=["key", "d", "at", "seg"],
            )

    return run


def repeated_windows(segments: list[bytes], d: np.ndarray, at: np.ndarray, width: int):
    """Windows that start earlier elsewhere among the given segments: row of the segment, first, number."""
    sizes = np.array([len(s) for s in segments], np.int64)
    base = np.concatenate([[0], np.cumsum(sizes + 1)])
    joined = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    text = joined.astype(np.uint16) + 1
    text[base[1:] - 1] = 0
    order = suffix_array(text, 257)
    shared, _ = common_prefixes(text, order, 0)
    lo, hashed, _, windows = _fields(at)
    row_of = np.repeat(np.arange(len(segments)), sizes + 1)
    local = np.arange(len(text)) - base[row_of]
    is_window = local < windows[row_of]
    group = np.cumsum(shared[order] < width)
    here = is_window[order]
    place, group = order[here], group[here]
    row = row_of[place]
    start = lo[row] + local[place]
    by = np.lexsort((hashed[row], start, d[row], group))
    heads = np.flatnonzero(np.concatenate([[True], np.diff(group[by]) != 0]))
    head = np.repeat(by[heads], np.diff(np.append(heads, len(by))))
    later = (d[row[by]] != d[row[head]]) | (start[by] != start[head]) | (hashed[row[by]] != hashed[row[head]])
    marked = np.zeros(len(text) + 1, bool)
    marked[place[by[later]]] = True
    edge = np.diff(np.concatenate([[0], marked.astype(np.int8)]))
    first, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    return row_of[first], local[first], end - first


def _blocks(seg: bytes, offset: int, windows: int, width: int, block: int):
    """Cut a segment at multiples of ``block`` window offsets.

    Yields first window, its offset, windows, the block's lowest offset and the bytes that all windows of the
    whole block share, which every segment with one of these windows has in the same place.
    """
    done = 0
    while done < windows:
        here = offset - done
        lowest = here // block * block
        many = min(windows - done, here - lowest + 1)
        yield done, here, many, lowest, seg[offset - lowest : offset - lowest + width - block + 1]
        done += many


def _matched_parts(keys: np.ndarray, segments: list[bytes], at: np.ndarray, width: int):
    """Runs of windows whose block is shared under the same key: row, first window, windows."""
    _, _, offset, windows = _fields(at)
    row, first, many, name = [], [], [], []
    for i, (seg, o, w) in enumerate(zip(segments, offset.tolist(), windows.tolist())):
        for done, _, n, lowest, core in _blocks(seg, o, w, width, BLOCK):
            row.append(i)
            first.append(done)
            many.append(n)
            name.append(xxhash.xxh3_64_intdigest(core, lowest))
    row, first, many = np.array(row), np.array(first), np.array(many)
    mixed = _mixed(np.array(name, np.uint64) ^ _mixed(keys[row].view(np.uint64)))
    _, which, count = np.unique(mixed, return_inverse=True, return_counts=True)
    kept = np.flatnonzero(count[which] > 1)
    if not len(kept):
        return kept, kept, kept
    row, first, many = row[kept], first[kept], many[kept]
    fresh = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (first[1:] != first[:-1] + many[:-1])]))
    return row[fresh], first[fresh], np.add.reduceat(many, fresh)


def _shard_marks(width: int):
    def work(rows: pa.Table):
        keys = rows["key"].to_numpy()
        segments = rows["seg"].to_pylist()
        d, at = rows["d"].to_numpy(), rows["at"].to_numpy()
        row, first, many = _matched_parts(keys, segments, at, width)
        if not len(row):
            return
        lo, hashed, _, _ = _fields(at[row])
        segments = [segments[i][a : a + n + width - 1] for i, a, n in zip(row.tolist(), first.tolist(), many.tolist())]
        keys, d, at = keys[row], d[row], _place(lo + first, hashed, 0, many)
        borders = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        borders = np.append(borders, len(keys))
        filled = np.concatenate([[0], np.cumsum([len(s) for s in segments])])
        i = 0
        while i < len(borders) - 1:
            j = max(i + 1, int(np.searchsorted(filled[borders], filled[borders[i]] + SHARD_BYTES, "right")) - 1)
            a, b = borders[i], borders[j]
            row, first, many = repeated_windows(segments[a:b], d[a:b], at[a:b], width)
            lo, hashed, _, _ = _fields(at[a:b][row])
            yield pa.RecordBatch.from_arrays(
                [pa.array(d[a:b][row]), pa.array(_place(lo + first, hashed, 0, many))], names=["d", "at"]
            )
            i = j

    return work


def _split_hot(width: int, block: int):
    """Cut segments at multiples of ``block`` window offsets; the bytes all windows of a block share are the key."""

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for key, d, at, seg in zip(*(c.to_pylist() for c in batch.columns)):
                lo, hashed, offset, windows = at >> 30, (at >> 14) & 0xFFFF, (at >> 7) & 127, at & 127
                for done, here, many, lowest, core in _blocks(seg, offset, windows, width, block):
                    part = seg[done : done + many + width - 1]
                    named = xxhash.xxh3_64(core, seed=lowest * 128 + block)
                    named.update(key.to_bytes(8, "little", signed=True))
                    out[0].append(int.from_bytes(named.digest(), "little", signed=True))
                    out[1].append(d)
                    out[2].append(int(_place(lo + done, hashed, here, many)))
                    out[3].append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.binary())],
                names=["key", "d", "at", "seg"],
            )

    return run


def _hot_marks(rows: DataFrame, width: int, gram: int, hot: int) -> list[DataFrame]:
    """Marks of segments under anchors with more than ``hot`` segments."""
    marks = []
    block = 4 ** ((width - gram).bit_length() // 2 + 1)
    while not rows.isEmpty():
        if block > 1:
            block //= 4
            slim = rows.select("key", "d", "at", "seg")
            rows = slim.mapInArrow(_split_hot(width, block), slim.schema)
        else:
            # Equal single windows, by their bytes: the first of each salted group goes on, the others are marked.
            ranked = rows.withColumn(
                "nth", F.row_number().over(Window.partitionBy("key", "seg", F.pmod(F.xxhash64("d", "at"), F.col("pieces"))).orderBy("d", "at"))
            )
            ranked = materialise(ranked, "windows")
            marks.append(ranked.where("nth > 1").select("d", "at"))
            rows = ranked.where("nth = 1").drop("nth", "pieces")
        rows = materialise(rows.select("key", "d", "at", "seg"), "split")
        count = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
        known = rows.join(count, "key")
        cold = known.where(F.col("n") <= hot).drop("n")
        marks.append(_sharded(cold, rows, width))
        rows = materialise(
            known.where(F.col("n") > hot).withColumn("pieces", F.ceil(F.col("n") / hot)).drop("n"), "hot"
        )
    return marks


def _sharded(cold: DataFrame, sized: DataFrame, width: int) -> DataFrame:
    total = sized.count() * 150
    return grouped(
        cold.select("key", "d", "at", "seg"), "key", partitions_for(total, 4 * SHARD_BYTES),
        _shard_marks(width), "d long, at long", rows=40_000,
    )


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    width: int = WIDTH, gram: int = GRAM, hot: int = HOT,
) -> DataFrame:
    """Marks of windows that start earlier elsewhere: ``d``, ``at`` (see ``_place``)."""
    slim = docs.select(_number(id_col, text_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    segments = slim.mapInArrow(_find_segments(width, gram), _SEGMENTS)
    settled = materialise(_settle(segments), "segments")
    needed = settled.where("kind = 0").select("key", "d", "at")
    crowded = needed.groupBy("key").count().where(F.col("count") > hot).select("key", F.lit(True).alias("crowded"))
    asked = (
        needed.join(crowded, "key", "left")
        .groupBy("d", _text_hash().alias("h"), F.coalesce("crowded", F.lit(False)).alias("crowded"))
        .agg(F.collect_list(F.struct("key", "at")).alias("items"))
    )
    found = asked.join(_packed(slim), ["d", "h"])
    schema = "key long, d long, at long, seg binary"
    cut = materialise(
        found.select("d", "z", "items", "crowded").mapInArrow(_with_flag(_cut_segments(width)), f"{schema}, crowded boolean"), "cut"
    )
    cold = cut.where("not crowded").drop("crowded")
    marks = [settled.where("kind = 1").select("d", "at"), _sharded(cold, cold, width)]
    marks += _hot_marks(cut.where("crowded").drop("crowded"), width, gram, hot)
    out = marks[0]
    for more in marks[1:]:
        out = out.unionByName(more)
    return out


def _with_flag(cut):
    """Run ``cut`` on the first three columns and carry the last one to every row it makes."""

    def run(batches):
        for batch in batches:
            for flag in (False, True):
                part = batch.filter(pc.equal(batch.column(3), flag))
                if part.num_rows:
                    for made in cut(iter([part.select([0, 1, 2])])):
                        yield made.append_column("crowded", pa.array([flag] * made.num_rows))

    return run


def _merge(places: list[int], own: int, size: int, width: int) -> list[tuple[int, int]]:
    at = np.sort(np.array([p for p in places if (p >> 14) & 0xFFFF == own], np.int64))
    lo, _, _, windows = _fields(at)
    end = np.minimum(lo + windows + width - 1, size)
    if not len(lo):
        return []
    reach = np.maximum.accumulate(end)
    fresh = np.flatnonzero(np.concatenate([[True], lo[1:] > reach[:-1]]))
    return list(zip(lo[fresh].tolist(), reach[np.append(fresh[1:], len(lo)) - 1].tolist()))


def _cut_out(width: int, with_text: bool):
    def run(batches):
        for batch in batches:
            rows = []
            for packed, places in zip(batch.column(1), batch.column(2).to_pylist()):
                text = _unpacked(packed.as_py())
                spans = _merge(places, xxhash.xxh3_64_intdigest(text) & 0xFFFF, len(text), width) if places else []
                kept, last = [], 0
                for a, b in spans:
                    kept.append(text[last:a])
                    last = b
                kept.append(text[last:])
                kept = b"".join(kept)
                flat = [x for span in spans for x in span]
                rows.append((len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), flat, kept.decode("utf-8", "ignore") if with_text else None))
            n, gone, spans, sha, flat, text = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(spans, pa.int64()),
                    pa.array(sha, pa.string()), pa.array(flat, pa.list_(pa.int64())), pa.array(text, pa.string()), batch.column(3),
                ],
                names=["d", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept", "row"],
            )

    return run


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True,
    width: int = WIDTH, gram: int = GRAM, hot: int = HOT, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per input row with repeated passages of ``width`` bytes cut out.

    Returns the id, the columns named in ``keep``, ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``,
    ``spans`` (starts and ends of removed runs in bytes, alternating) and ``kept``: the remaining text, where
    a character that lost some of its bytes is left out. Other columns are ignored, so their names cannot clash.
    """
    marks = repeated_spans(docs, id_col, text_col, width, gram, hot)
    places = marks.groupBy("d", _text_hash().alias("h")).agg(F.collect_set("at").alias("places"))
    rows = docs.select(
        _number(id_col, text_col).alias("d"), F.coalesce(F.col(text_col), F.lit("")).alias("t"),
        F.struct(F.col(id_col).alias("_id"), *[F.col(c) for c in keep]).alias("row"),
    )
    row_type = rows.schema["row"].dataType.simpleString()
    schema = (
        "d long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<long>, "
        f"kept string, row {row_type}"
    )
    out = _packed(rows).join(places, ["d", "h"], "left").select("d", "z", "places", "row").mapInArrow(_cut_out(width, with_text), schema)
    return out.select(
        F.col("row").getField("_id").alias(id_col), *[F.col("row").getField(c).alias(c) for c in keep],
        "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", "kept",
    )


def op3(spark, sf_dir: str) -> DataFrame:
    """Repeated 100-byte passages of all documents removed."""
    ship(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return suffix_dedup(docs, with_text=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
